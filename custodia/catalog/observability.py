"""Queries: run log, freshness metrics, series, alarms, streams, workflow."""

from __future__ import annotations

from pyspark.sql import functions as F

from custodia.catalog.metrics import PICKUP_ONLY
from custodia.catalog.roles import (
    AS_OF, DAILY, LAYOUT, PASSES, SOME_ZONES, TRIPS, ZONES, number, some_zones, table, text, trips, with_ctes, zones,
)
from custodia.catalog.versions import stored_daily
from custodia.operators import metrics, observability, quality, star
from custodia.operators.incremental import DailyState, read_monthly, refresh_monthly, signed, write_monthly
from custodia.operators.observability import Alarm
from custodia.plans.jobs import curated, governed_run, metrics_workflow, run_log_state
from custodia.session import ts, work_dir
from custodia.streaming import event_stream, run_log_stream, series_stream, write_available

ENTRIES = {}


def entry(name, sql=None):
    def add(fn):
        ENTRIES[name] = (fn, sql)
        return fn

    return add


def patches(spark, sf):
    """The events as run-log patches: a user is a run, each event type touches one field."""
    kind = F.col("event_type")
    return table(spark, sf, "events").select(
        F.col("user_id").alias("execution_id"),
        "ts",
        "event_id",
        F.when(kind == "signup", "RUNNING").when(kind == "purchase", "SUCCEEDED").when(kind == "error", "FAILED").alias("status"),
        F.when(kind == "view", F.get_json_object("props", "$.k")).alias("age_hours"),
        F.when(kind == "click", F.col("value")).alias("cost"),
    )


RUN_STATE = """
p AS (
  SELECT user_id AS execution_id, ts, event_id,
         CASE event_type WHEN 'signup' THEN 'RUNNING' WHEN 'purchase' THEN 'SUCCEEDED' WHEN 'error' THEN 'FAILED' END AS status,
         CASE WHEN event_type = 'view' THEN json_extract_string(props, '$.k') END AS age_hours,
         CASE WHEN event_type = 'click' THEN value END AS cost FROM events),
state AS (
  SELECT execution_id, arg_max(status, (ts, event_id)) FILTER (WHERE status IS NOT NULL) AS status,
         arg_max(age_hours, (ts, event_id)) FILTER (WHERE age_hours IS NOT NULL) AS age_hours,
         arg_max(cost, (ts, event_id)) FILTER (WHERE cost IS NOT NULL) AS cost,
         strftime(MIN(ts), '%Y-%m-%d %H:%M:%S') AS started_at, strftime(MAX(ts), '%Y-%m-%d %H:%M:%S') AS updated_at
  FROM p GROUP BY 1)
"""


def state(df):
    out = observability.run_state(df, "execution_id", ["ts", "event_id"], ["status", "age_hours", "cost"])
    return out.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("started_at", "updated_at")})


@entry("run_state", with_ctes(RUN_STATE, body="SELECT * FROM state"))
def run_state(spark, sf):
    return state(patches(spark, sf))


@entry("stream_run_state", with_ctes(RUN_STATE, body="SELECT * FROM state"))
def stream_run_state(spark, sf):
    """The run log filled by a stream, one folder per batch, then reduced to its state."""
    base = work_dir(spark, "runlog")
    schema = table(spark, sf, "events").schema
    log = event_stream(spark, f"{sf}/events.parquet", schema)
    run_log_stream(log, f"{base}/log", f"{base}/checkpoint")
    kind = F.col("event_type")
    stored = spark.read.parquet(f"{base}/log").select(
        F.col("user_id").alias("execution_id"), "ts", "event_id",
        F.when(kind == "signup", "RUNNING").when(kind == "purchase", "SUCCEEDED").when(kind == "error", "FAILED").alias("status"),
        F.when(kind == "view", F.get_json_object("props", "$.k")).alias("age_hours"),
        F.when(kind == "click", F.col("value")).alias("cost"),
    )
    return state(stored)


RUNS_AS_OF = "2024-01-30 23:59:59"


def runs(spark, sf):
    """Each event as a finished run; clicks carry an unreadable start, views a master check."""
    kind = F.col("event_type")
    started = F.when(kind == "click", "not a time").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    return table(spark, sf, "events").select(
        F.col("event_id").alias("execution_id"),
        F.when(kind == "purchase", "SUCCEEDED").when(kind == "error", "FAILED").otherwise("RUNNING").alias("status"),
        started.alias("started_at_utc"),
        F.when(kind == "view", F.regexp_replace("props", '"k"', '"age_hours"'))
        .when(kind == "signup", '{"age_hours": "n/a"}').alias("master_check"),
    )


RUNS = """
runs AS (
  SELECT event_id, event_type, CASE event_type WHEN 'purchase' THEN 'SUCCEEDED' WHEN 'error' THEN 'FAILED' ELSE 'RUNNING' END AS status,
         CASE WHEN event_type = 'view' THEN CAST(json_extract_string(props, '$.k') AS DOUBLE) END AS age,
         date_trunc('second', ts) AS started_at FROM events
  WHERE event_type <> 'click' AND date_trunc('second', ts) >= TIMESTAMP '2024-01-30 23:59:59' - INTERVAL 24 HOUR)
"""


def recent(spark, sf):
    return observability.recent_runs(runs(spark, sf), "started_at_utc", RUNS_AS_OF)


@entry(
    "run_rates",
    with_ctes(RUNS, body="""
SELECT ROUND(AVG(CASE WHEN status = 'SUCCEEDED' THEN 1.0 ELSE 0.0 END), 6) AS success_rate,
       ROUND(AVG(CASE WHEN status = 'FAILED' THEN 1.0 ELSE 0.0 END), 6) AS fail_rate, COUNT(*) AS runs FROM runs"""),
)
def run_rates(spark, sf):
    rates = observability.run_rates(recent(spark, sf))
    return rates.withColumns({c: F.round(c, 6) for c in ("success_rate", "fail_rate")})


@entry(
    "run_success_rate",
    with_ctes(RUNS, body="""
SELECT strftime(started_at, '%Y-%m-%d %H') AS hour,
       ROUND(AVG(CASE WHEN status = 'SUCCEEDED' THEN 1.0 ELSE 0.0 END), 6) AS success_rate, COUNT(*) AS runs FROM runs GROUP BY 1"""),
)
def run_success_rate(spark, sf):
    return recent(spark, sf).groupBy(F.date_format("started_at", "yyyy-MM-dd HH").alias("hour")).agg(
        F.round(F.avg((F.col("status") == "SUCCEEDED").cast("double")), 6).alias("success_rate"),
        F.count("*").alias("runs"),
    )


@entry("mean_master_age", with_ctes(RUNS, body="SELECT ROUND(AVG(age), 6) AS mean_age_hours FROM runs"))
def mean_master_age(spark, sf):
    mean = observability.mean_master_age(recent(spark, sf), "master_check")
    return mean.withColumn("mean_age_hours", F.round("mean_age_hours", 6))


@entry(
    "governance_metrics",
    with_ctes(RUNS, TRIPS, ZONES, SOME_ZONES, body="""
SELECT 'PipelineSuccessRate' AS metric, ROUND(AVG(CASE WHEN status = 'SUCCEEDED' THEN 1.0 ELSE 0.0 END), 6) AS value, 'None' AS unit FROM runs
UNION ALL SELECT 'PipelineFailRate', ROUND(AVG(CASE WHEN status = 'FAILED' THEN 1.0 ELSE 0.0 END), 6), 'None' FROM runs
UNION ALL SELECT 'PipelineRuns24h', CAST(COUNT(*) AS DOUBLE), 'Count' FROM runs
UNION ALL SELECT 'MasterFreshnessAgeHours', ROUND(AVG(age), 6), 'None' FROM runs
UNION ALL SELECT 'OrphanRate_pu_pct', ROUND(100.0 * COUNT(*) FILTER (WHERE location_id IS NULL) / COUNT(*), 6), 'None'
FROM trips LEFT JOIN some_zones ON pu_zone_id = location_id"""),
)
def governance_metrics(spark, sf):
    dim = star.keyed(some_zones(spark, sf), "location_id", "zone_sk")
    fact = star.resolve_keys(trips(spark, sf), {"pu_zone_sk": (dim, "location_id", "zone_sk", "pu_zone_id")})
    shares = metrics.null_share(fact, {"pu_pct": "pu_zone_sk"})
    out = observability.governance_metrics(recent(spark, sf), "master_check", shares)
    return out.select("metric", F.round("value", 6).alias("value"), "unit")


# -- series -------------------------------------------------------------------------

SERIES = """
series AS (
  SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS period_start, event_type AS metric,
         SUM(CAST(value AS DECIMAL(18,2))) AS total, COUNT(*) AS samples FROM events GROUP BY 1, 2)
"""

SHOW_SERIES = """strftime(period_start, '%Y-%m-%d %H:%M:%S') AS period_start, metric, CAST(total AS DOUBLE) AS total,
       ROUND(CAST(total AS DOUBLE) / samples, 4) AS average, samples"""


def show_series(df):
    return df.select(
        F.date_format("period_start", "yyyy-MM-dd HH:mm:ss").alias("period_start"), "metric",
        number("total").alias("total"), F.round(number("total") / F.col("samples"), 4).alias("average"), "samples",
    )


def money():
    return F.col("value").cast("decimal(18,2)")


@entry("metric_series_5m", with_ctes(SERIES, body=f"SELECT {SHOW_SERIES} FROM series"))
def metric_series_5m(spark, sf):
    return show_series(observability.metric_series(table(spark, sf, "events"), "ts", "event_type", money()))


@entry(
    "stream_metric_series",
    with_ctes(SERIES, body=f"""
SELECT {SHOW_SERIES} FROM series
WHERE period_start + INTERVAL 5 MINUTE <= (SELECT date_trunc('milliseconds', MAX(ts)) FROM events) - INTERVAL 10 MINUTE"""),
)
def stream_metric_series(spark, sf):
    """The series as a stream in append mode: windows the watermark has not passed are still open."""
    base = work_dir(spark, "series")
    events = event_stream(spark, f"{sf}/events.parquet", table(spark, sf, "events").schema)
    write_available(series_stream(events, "ts", "event_type", money()), f"{base}/out", f"{base}/checkpoint")
    return show_series(spark.read.parquet(f"{base}/out"))


def deletes(events):
    return observability.matching_events(
        events.withColumn("k", F.get_json_object("props", "$.k")), "event_type", "error", "k", "9"
    )


DELETES = """
SELECT strftime(time_bucket(INTERVAL 5 MINUTE, ts), '%Y-%m-%d %H:%M:%S') AS period_start, COUNT(*) AS n FROM events
WHERE event_type = 'error' AND json_extract_string(props, '$.k') = '9'"""


@entry("delete_event_count", DELETES + " GROUP BY 1")
def delete_event_count(spark, sf):
    series = observability.metric_series(deletes(table(spark, sf, "events")), "ts", "event_type", F.lit(1))
    return series.select(F.date_format("period_start", "yyyy-MM-dd HH:mm:ss").alias("period_start"), F.col("total").alias("n"))


@entry(
    "stream_delete_count",
    DELETES + """ AND time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE <= (
  SELECT date_trunc('milliseconds', MAX(ts)) FROM events
  WHERE event_type = 'error' AND json_extract_string(props, '$.k') = '9') - INTERVAL 10 MINUTE GROUP BY 1""",
)
def stream_delete_count(spark, sf):
    base = work_dir(spark, "deletes")
    events = event_stream(spark, f"{sf}/events.parquet", table(spark, sf, "events").schema)
    write_available(series_stream(deletes(events), "ts", "event_type", F.lit(1)), f"{base}/out", f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/out").select(
        F.date_format("period_start", "yyyy-MM-dd HH:mm:ss").alias("period_start"), F.col("total").alias("n")
    )


def alarm_sql(periods, missing):
    gap = "WHEN n IS NULL THEN 'INSUFFICIENT_DATA'" if missing == "missing" else ""
    return with_ctes(SERIES, f"""spans AS (SELECT metric, MIN(period_start) AS lo, MAX(period_start) AS hi FROM series GROUP BY 1),
grid AS (SELECT metric, unnest(generate_series(lo, hi, INTERVAL 5 MINUTE)) AS period_start FROM spans),
filled AS (
  SELECT g.metric, g.period_start, s.samples AS n, CASE WHEN s.total >= 20 THEN 1 ELSE 0 END AS breach
  FROM grid g LEFT JOIN series s ON g.metric = s.metric AND g.period_start = s.period_start),
runs AS (SELECT *, SUM(breach) OVER (PARTITION BY metric ORDER BY period_start ROWS {periods - 1} PRECEDING) AS run FROM filled)""",
        body=f"""
SELECT metric, strftime(period_start, '%Y-%m-%d %H:%M:%S') AS period_start, breach,
       CASE WHEN run >= {periods} THEN 'ALARM' {gap} ELSE 'OK' END AS state FROM runs""")


def alarms(spark, sf, alarm):
    series = observability.metric_series(table(spark, sf, "events"), "ts", "event_type", money())
    return observability.alarm_states(series, alarm).select(
        "metric", F.date_format("period_start", "yyyy-MM-dd HH:mm:ss").alias("period_start"), "breach", "state"
    )


@entry("alarm_states", alarm_sql(1, "notBreaching"))
def alarm_states(spark, sf):
    return alarms(spark, sf, Alarm("high-total", "total", ">=", 20, 1))


@entry("alarm_states_missing", alarm_sql(2, "missing"))
def alarm_states_missing(spark, sf):
    return alarms(spark, sf, Alarm("high-total-twice", "total", ">=", 20, 2, missing="missing"))


# -- workflow and run ---------------------------------------------------------------


@entry(
    "mv_refresh",
    with_ctes(TRIPS, ZONES, DAILY, body="""
SELECT CAST(CAST(date_trunc('month', trip_date) AS DATE) AS VARCHAR) AS month, "PU_borough",
       CAST(SUM(total_revenue) AS DOUBLE) AS revenue FROM daily GROUP BY 1, 2"""),
)
def mv_refresh(spark, sf):
    """The metrics workflow: upsert of stored metrics, refresh of the monthly table, tests."""
    result = metrics_workflow(
        curated(trips(spark, sf), zones(spark, sf), PICKUP_ONLY), stored_daily(spark, sf), "run-1", AS_OF,
        work_dir(spark, "workflow"),
    )
    return result["monthly"].select(text("month").alias("month"), "PU_borough", number("revenue").alias("revenue"))


HIT = "pickup_ts >= TIMESTAMP '1997-03-01' AND pickup_ts < TIMESTAMP '1997-05-01'"


@entry(
    "mv_incremental",
    with_ctes(TRIPS, ZONES, f"""
kept AS (
  SELECT pickup_ts, pu_zone_id, total_amount FROM trips WHERE order_id % 5 <> 0 AND NOT ({HIT} AND order_id % 11 IN (1, 2)) AND NOT (pickup_ts >= TIMESTAMP '1998-01-01' AND pickup_ts < TIMESTAMP '1998-02-01')
  UNION ALL SELECT pickup_ts, pu_zone_id, total_amount FROM trips WHERE order_id % 5 = 0 AND {HIT}
  UNION ALL SELECT pickup_ts, do_zone_id, 2 * total_amount FROM trips WHERE order_id % 5 <> 0 AND {HIT} AND order_id % 11 = 2)""", body="""
SELECT strftime(pickup_ts, '%Y-%m') AS month, borough, COUNT(*) AS trips, CAST(SUM(COALESCE(total_amount, 0)) AS DOUBLE) AS revenue
FROM kept LEFT JOIN zones ON pu_zone_id = location_id GROUP BY 1, 2"""),
)
def mv_incremental(spark, sf):
    """Stored monthly revenue brought up to date by inserts, deletes, updates that move trips, and a month that becomes empty."""
    path = work_dir(spark, "trips")
    trips(spark, sf).write.parquet(path)
    fact = spark.read.parquet(path)
    lookup = zones(spark, sf)
    base = work_dir(spark, "state")
    state = DailyState(spark, f"{base}/daily", "pickup_ts", "pu_zone_id", {"revenue": F.coalesce("total_amount", F.lit(0))})
    first = fact.where("order_id % 5 <> 0")
    state.build(first)
    write_monthly(state.monthly(lookup, "location_id", "borough", "revenue"), f"{base}/monthly")
    hit = fact.where(HIT.replace("TIMESTAMP '", "TIMESTAMP_NTZ '"))
    old = hit.where("order_id % 5 <> 0 AND order_id % 11 = 2")
    moved = old.withColumns({"pu_zone_id": F.col("do_zone_id"), "total_amount": (F.col("total_amount") * 2).cast("decimal(18,4)")})
    gone = hit.where("order_id % 5 <> 0 AND order_id % 11 = 1").unionByName(first.where("pickup_ts >= TIMESTAMP_NTZ '1998-01-01' AND pickup_ts < TIMESTAMP_NTZ '1998-02-01'"))
    changes = signed(inserted=hit.where("order_id % 5 = 0").unionByName(moved), deleted=gone.unionByName(old))
    refresh_monthly(state, changes, lookup, "location_id", "borough", "revenue", f"{base}/monthly")
    return read_monthly(spark, f"{base}/monthly").select("month", "borough", "trips", number("revenue").alias("revenue"))


@entry(
    "governed_run",
    with_ctes(TRIPS, body=f"""
SELECT 'run-1' AS execution_id, CASE WHEN bad = 0 THEN 'SUCCEEDED' ELSE 'FAILED' END AS status,
       CASE WHEN bad = 0 THEN 'SUCCEEDED' ELSE 'FAILED' END AS dq, 'SUCCEEDED' AS transform_run,
       CASE WHEN bad = 0 THEN 'MASTER_STALE_ALERT' ELSE 'DQ_FAILED' END AS warning, written
FROM (SELECT COUNT(*) FILTER (WHERE total_amount IS NULL) AS bad, COUNT(*) AS written FROM trips WHERE {PASSES})"""),
)
def governed_run_query(spark, sf):
    """Audit, stale master (warns), transform, failing quality gate (blocks), final state."""
    base = work_dir(spark, "run")
    steps = iter(range(100))
    stale = spark.range(1).select(
        F.lit("20240101T000000").alias("latest_key"), ts("2024-01-01 00:00:00").alias("last_modified"),
        F.lit(1440.0).alias("age_hours"),
    )

    def transform():
        quality.promote(trips(spark, sf), LAYOUT.gate()).write.parquet(f"{base}/curated")
        return spark.read.parquet(f"{base}/curated")

    governed_run(
        spark, "run-1", f"{base}/log", stale, transform,
        lambda df: quality.quality_report(df, [quality.NotNull("amount", "total_amount")]),
        lambda: f"2024-03-01T00:00:{next(steps):02d}",
    )
    written = spark.read.parquet(f"{base}/curated").agg(
        F.count("*").alias("written"), F.max(F.lit("run-1")).alias("execution_id")
    )
    final = run_log_state(spark, f"{base}/log").select("execution_id", "status", "dq", "transform_run", "warning")
    return final.join(written, "execution_id")
