"""Run log, freshness, governance metrics, metric series and alarms."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from custodia.functions import iso_timestamp, json_number
from custodia.session import clock

# -- run log --------------------------------------------------------------------


def run_state(events: DataFrame, key: str, order: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Current state per run: last non-null value of each field, first and last event time.

    ``events`` is append-only; every row is a patch whose untouched fields are NULL.
    """
    at = order[0]
    position = F.struct(*order)
    latest = [F.max_by(f, F.when(F.col(f).isNotNull(), position)).alias(f) for f in fields]
    return events.groupBy(key).agg(
        *latest, F.min(at).alias("started_at"), F.max(at).alias("updated_at")
    )


def recent_runs(runs: DataFrame, started_text: str, as_of: str, hours: int = 24) -> DataFrame:
    """Runs whose ISO start text parses and lies within the last hours."""
    since = clock(as_of) - F.make_dt_interval(F.lit(0), F.lit(hours))
    return runs.withColumn("started_at", iso_timestamp(started_text)).filter(F.col("started_at") >= since)


def run_rates(runs: DataFrame, status: str = "status") -> DataFrame:
    """success_rate, fail_rate, total; rates are NULL without runs."""
    return runs.agg(
        F.avg((F.col(status) == "SUCCEEDED").cast("double")).alias("success_rate"),
        F.avg((F.col(status) == "FAILED").cast("double")).alias("fail_rate"),
        F.count("*").alias("runs"),
    )


def mean_master_age(runs: DataFrame, document: str, path: str = "$.age_hours") -> DataFrame:
    """Mean age over the runs that carry a numeric one."""
    return runs.agg(F.avg(json_number(document, path)).alias("mean_age_hours"))


def governance_metrics(
    runs: DataFrame, document: str, orphan_shares: DataFrame | None = None, dims: str = ""
) -> DataFrame:
    """Long metric rows (metric, value, unit, dims); metrics without a value are left out.

    Run metrics come from one pass over the runs.
    """
    one = runs.agg(
        F.avg((F.col("status") == "SUCCEEDED").cast("double")).alias("a"),
        F.avg((F.col("status") == "FAILED").cast("double")).alias("b"),
        F.when(F.count("*") > 0, F.count("*").cast("double")).alias("c"),
        F.avg(json_number(document, "$.age_hours")).alias("d"),
    )
    named = [
        ("PipelineSuccessRate", "a", "None"),
        ("PipelineFailRate", "b", "None"),
        ("PipelineRuns24h", "c", "Count"),
        ("MasterFreshnessAgeHours", "d", "None"),
    ]
    rows = _metric_rows(one, named)
    if orphan_shares is not None:
        shares = [(f"OrphanRate_{c}", c, "None") for c in orphan_shares.columns]
        rows = rows.unionByName(_metric_rows(orphan_shares, shares))
    return rows.filter("value IS NOT NULL").withColumn("dims", F.lit(dims))


def _metric_rows(one: DataFrame, named) -> DataFrame:
    return one.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(metric).alias("metric"),
                        F.col(c).cast("double").alias("value"),
                        F.lit(unit).alias("unit"),
                    )
                    for metric, c, unit in named
                ]
            )
        )
    )


def freshness(latest: DataFrame, max_age_hours: float = 168) -> DataFrame:
    """(fresh, age_hours, latest_key, last_modified, reason) from ``latest_snapshot``."""
    found = F.col("latest_key").isNotNull()
    return latest.select(
        (found & F.coalesce(F.col("age_hours") <= max_age_hours, F.lit(False))).alias("fresh"),
        "age_hours",
        "latest_key",
        "last_modified",
        F.when(~found, "no_master_snapshots_found").alias("reason"),
    )


def lineage_record(
    counts: DataFrame,
    step: str,
    run_id: str,
    inputs: Sequence[str],
    output: str,
    rules: Sequence[str],
    transformations: Sequence[str],
    as_of: str,
) -> DataFrame:
    """One lineage row from a one-row count frame (rows_in, rows_out, rows_dropped)."""

    def texts(values):
        return F.array(*[F.lit(v) for v in values]).cast("array<string>")

    return counts.select(
        F.lit(run_id).alias("run_id"),
        F.lit(step).alias("step"),
        texts(inputs).alias("inputs"),
        F.lit(output).alias("output"),
        texts(rules).alias("rules"),
        "rows_in",
        "rows_out",
        "rows_dropped",
        texts(transformations).alias("transformations"),
        clock(as_of).alias("recorded_at"),
    )


def lineage_from_observations(spark: SparkSession, seen_in, seen_out, **record) -> DataFrame:
    """Lineage row from the counters of a finished write."""
    rows_in, rows_out = seen_in.get["rows_in"], seen_out.get["rows_out"]
    counts = spark.range(1).select(
        F.lit(rows_in).alias("rows_in"),
        F.lit(rows_out).alias("rows_out"),
        F.lit(rows_in - rows_out).alias("rows_dropped"),
    )
    return lineage_record(counts, **record)


# -- metric series and alarms ---------------------------------------------------


def metric_series(events: DataFrame, ts_col: str, metric: str, value: Column | str, period: str = "5 minutes") -> DataFrame:
    """Tumbling-window sum, average and samples per metric; the same plan serves streams."""
    value = F.col(value) if isinstance(value, str) else value
    return (
        events.groupBy(F.window(ts_col, period).alias("w"), F.col(metric).alias("metric"))
        .agg(F.sum(value).alias("total"), F.avg(value).alias("average"), F.count("*").alias("samples"))
        .select(F.col("w.start").alias("period_start"), F.col("w.end").alias("period_end"), "metric", "total", "average", "samples")
    )


def matching_events(events: DataFrame, source: str, source_value: str, name: str, name_value: str) -> DataFrame:
    """Events of one source and name, as a metric filter sees them."""
    return events.filter((F.col(source) == source_value) & (F.col(name) == name_value))


@dataclass(frozen=True)
class Alarm:
    """Threshold on a statistic over ``periods`` consecutive windows of ``period_seconds``.

    ``missing`` = 'notBreaching': a window without data is a good one;
    'missing': it has the state INSUFFICIENT_DATA and breaks the run.
    """

    name: str
    statistic: str
    op: str
    threshold: float
    periods: int = 1
    period_seconds: int = 300
    missing: str = "notBreaching"

    def breach(self) -> Column:
        value = F.col(self.statistic)
        return {
            ">=": value >= self.threshold,
            ">": value > self.threshold,
            "<": value < self.threshold,
            "<=": value <= self.threshold,
        }[self.op]


def alarm_states(series: DataFrame, alarm: Alarm) -> DataFrame:
    """State per metric and window between its first and last sample.

    A breach is counted in its own and the following ``periods - 1`` windows, and a
    window is in ALARM when it holds ``periods`` breaches. No ordered window over
    a metric's whole history is needed, so a busy metric spreads over tasks.
    """
    step = F.expr(f"INTERVAL {alarm.period_seconds} SECONDS")
    breach = F.coalesce(alarm.breach(), F.lit(False)).cast("int")
    # a window without a breach stands for itself, a breach also for the windows it reaches
    reach = F.when(breach == 1, F.lit(alarm.periods - 1)).otherwise(F.lit(0))
    spread = series.select(
        "metric", "period_start", breach.alias("_breach"), F.explode(F.sequence(F.lit(0), reach)).alias("_ahead")
    )
    own = F.col("_ahead") == 0
    reached = spread.select(
        "metric",
        (F.col("period_start") + F.col("_ahead") * step).alias("period_start"),
        F.when(own, F.col("_breach")).otherwise(0).alias("breach"),
        own.cast("int").alias("seen"),
        F.col("_breach").alias("run"),
        F.lit(0).alias("listed"),
    )
    spans = series.groupBy("metric").agg(F.min("period_start").alias("lo"), F.max("period_start").alias("hi"))
    # one row per metric and day first, so a long span is cut before its windows are listed; windows follow
    # one another from the first sample on, whether or not the period divides a day
    days = spans.select("metric", "lo", "hi", F.explode(F.sequence(F.to_date("lo"), F.to_date("hi"))).alias("day"))
    ahead = F.expr("timestampdiff(SECOND, lo, CAST(day AS TIMESTAMP_NTZ))")
    first = F.greatest(F.lit(0).cast("long"), F.ceil(ahead / alarm.period_seconds))
    last = F.least(F.expr("timestampdiff(SECOND, lo, hi)"), ahead + 86_399)
    days = days.withColumn("first", first).withColumn("last", F.floor(last / alarm.period_seconds)).filter("first <= last")
    grid = (
        days.select("metric", "lo", F.explode(F.sequence("first", "last")).alias("n"))
        .withColumn("period_start", F.col("lo") + F.col("n").cast("int") * step)
        .select("metric", "period_start", F.lit(0).alias("breach"), F.lit(0).alias("seen"), F.lit(0).alias("run"), F.lit(1).alias("listed"))
    )
    merged = reached.unionByName(grid).groupBy("metric", "period_start").agg(
        F.max("breach").alias("breach"),
        F.max("seen").alias("seen"),
        F.sum("run").alias("run"),
        F.max("listed").alias("listed"),
    )
    state = F.when(F.col("run") >= alarm.periods, "ALARM")
    if alarm.missing == "missing":
        state = state.when(F.col("seen") == 0, "INSUFFICIENT_DATA")
    return merged.filter("listed = 1").select(
        F.lit(alarm.name).alias("alarm"), "metric", "period_start", "breach", "seen", state.otherwise("OK").alias("state")
    )
