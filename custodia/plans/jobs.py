"""The composite jobs a user calls: plain functions over the operators."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from custodia.functions import duration_minutes, normalize_party, normalize_place
from custodia.operators import align, enrich, matching, merging, metrics, observability, quality, star, upsert
from custodia.operators.keys import KeyRegistry
from custodia.session import ts
from custodia.sources import files


@dataclass(frozen=True)
class TripLayout:
    """Column names of a trip-like fact and of its lookup."""

    pickup: str = "pickup_ts"
    dropoff: str = "dropoff_ts"
    distance: str = "trip_distance"
    amount: str = "total_amount"
    roles: Mapping[str, str] = field(default_factory=lambda: {"PU_": "pu_zone_id", "DO_": "do_zone_id"})
    lookup_key: str = "location_id"
    keep: Sequence[str] = ()

    def gate(self) -> list:
        return [
            quality.CompareColumns("pickup<=dropoff", self.pickup, "<=", self.dropoff),
            quality.NumericRange("trip_distance>=0", self.distance, 0),
            quality.NumericRange("total_amount>=0", self.amount, 0),
        ]


def curated(trips: DataFrame, zones: DataFrame, layout: TripLayout) -> DataFrame:
    """Validated trips with partition columns and both zone roles, as one lazy plan."""
    good = quality.promote(trips, layout.gate())
    parted = align.add_year_month(good, layout.pickup)
    both = enrich.enrich_roles(parted, zones, layout.lookup_key, layout.roles)
    return files.keep_columns(both, layout.keep) if layout.keep else both


def curated_trips(
    trips: DataFrame, zones: DataFrame, layout: TripLayout, out: str, lineage_out: str, run_id: str, as_of: str,
    casts: Mapping[str, str] | None = None,
) -> DataFrame:
    """Curated-trips job: align, gate, enrich, write partitioned, write lineage.

    The fact is scanned once: the row counts are observed while the result is written.
    """
    spark = trips.sparkSession
    aligned = align.cast_columns(trips, casts or {})
    good, seen_in, seen_out = quality.promote_observed(aligned, layout.gate(), run_id)
    parted = align.add_year_month(good, layout.pickup)
    both = enrich.enrich_roles(parted, zones, layout.lookup_key, layout.roles)
    result = files.keep_columns(both, layout.keep) if layout.keep else both
    files.write_partitioned(result, out, ["year", "month"], sort_by=layout.pickup)
    lineage = observability.lineage_from_observations(
        spark, seen_in, seen_out, step="curated_trips", run_id=run_id, inputs=["trips", "zones"], output=out,
        rules=[r.name for r in layout.gate()],
        transformations=["filter validated rules", "add partitions year/month", "join both zone roles"],
        as_of=as_of,
    )
    files.write_report(lineage, lineage_out)
    return spark.read.parquet(out)


def monthly_enriched(
    trips: DataFrame, zones: DataFrame, layout: TripLayout, out: str, lineage_out: str, run_id: str, as_of: str
) -> DataFrame:
    """Monthly path: gate, enrich with all fact columns, add the duration, write flat."""
    spark = trips.sparkSession
    good, seen_in, seen_out = quality.promote_observed(trips, layout.gate(), run_id)
    both = enrich.enrich_roles(good, zones, layout.lookup_key, layout.roles)
    timed = both.withColumn("trip_duration_minutes", duration_minutes(layout.pickup, layout.dropoff))
    files.write_flat(timed, out)
    lineage = observability.lineage_from_observations(
        spark, seen_in, seen_out, step="curated_enrichment", run_id=run_id, inputs=["validated", "zones"], output=out,
        rules=[r.name for r in layout.gate()],
        transformations=["join pickup zone", "join dropoff zone", "derive trip_duration_minutes"],
        as_of=as_of,
    )
    files.write_report(lineage, lineage_out)
    return spark.read.parquet(out)


def lookup_gate_job(
    lookup: DataFrame, key: str, required: Sequence[str], value_col: str, allowed: Sequence[str],
    max_bad_pct: float, out: str, report_out: str, write_policy: str = "always",
) -> DataFrame:
    """Gate a reference file; ``write_policy`` 'always' writes before judging, 'on_pass' after."""
    report = quality.lookup_gate(lookup, key, required, value_col, allowed, max_bad_pct)
    files.write_report(report, report_out)
    verdict = lookup.sparkSession.read.json(report_out)
    row = verdict.select("status", "bad_pct").first()
    if write_policy == "always" or row["status"] == "PASS":
        files.write_flat(lookup, out)
    if row["status"] != "PASS":
        raise RuntimeError(f"quality gate failed: bad_pct={row['bad_pct']:.4f} > {max_bad_pct}")
    return verdict


def quality_report_job(
    trips: DataFrame, rules: Sequence, order_by: Sequence[str], columns: Sequence[str], out: str
) -> tuple[DataFrame, DataFrame]:
    """Report and samples, written as JSON below ``out``."""
    report = quality.quality_report(trips, rules)
    samples = quality.violation_samples(trips, rules, order_by, columns)
    files.write_report(report, f"{out}/report")
    files.write_report(samples, f"{out}/samples")
    spark = trips.sparkSession
    return spark.read.json(f"{out}/report"), spark.read.json(f"{out}/samples")


def metrics_workflow(
    curated_df: DataFrame, existing: DataFrame, run_id: str, as_of: str, out: str,
    layout: TripLayout = TripLayout(), strict: bool = False,
) -> dict[str, DataFrame]:
    """Daily metrics upsert -> monthly table refresh -> zero-row tests.

    Each step writes its table and the next one reads it, so the fact is aggregated once.
    """
    spark = curated_df.sparkSession
    role = next(iter(layout.roles))
    key = layout.roles[role]
    daily = metrics.daily_zone_metrics(
        curated_df, layout.pickup, key, [f"{role}zone", f"{role}borough"], layout.amount, layout.distance
    )
    files.write_flat(upsert.upsert_measures(existing, daily, ["trip_date", key], as_of), f"{out}/daily")
    stored = spark.read.parquet(f"{out}/daily")
    files.write_flat(metrics.monthly_rollup(stored, f"{role}borough"), f"{out}/monthly")
    tests = {
        "test_no_negative_revenue": (F.col("total_revenue") < 0, "total_revenue >= 0"),
        "test_not_null_keys": (F.col("trip_date").isNull() | F.col(key).isNull(), "PK columns not null"),
    }
    results = quality.log_tests(quality.zero_row_conditions(stored, tests, run_id, as_of), f"{out}/tests", run_id)
    if strict:
        quality.raise_on_failure(results)
    return {"daily": stored, "monthly": spark.read.parquet(f"{out}/monthly"), "tests": results}


def zone_duplicates_job(
    zones: DataFrame, key: str, borough: str, zone: str, service: str, threshold: float = 0.92
) -> tuple[DataFrame, DataFrame]:
    """Exact duplicate members, and fuzzy pairs within (borough, service)."""
    parts = [normalize_place(borough), normalize_place(zone), normalize_place(service)]
    exact = matching.duplicate_members(zones, key, parts)
    blocked = zones.withColumns({"_b": parts[0], "_s": parts[2]})
    names = matching.distinct_names(blocked, key, normalize_place(zone), ["_b", "_s"])
    fuzzy = matching.similar_pairs(names, "matching_blocks", threshold, ["_b", "_s"])
    return exact, fuzzy.withColumn("score", F.round("score", 4)).withColumnsRenamed(
        {"_b": "borough_n", "_s": "service_n"}
    )


def vendor_dedup_job(
    master: DataFrame, lifecycle: DataFrame, id_col: str, name: str, as_of: str, out: str,
    auto: float = 0.95, review: float = 0.80, block: Sequence[str] = (),
) -> dict[str, DataFrame]:
    """Score pairs, equal names among them, store the queue, merge the automatic ones; the queue is written once and read back."""
    spark = master.sparkSession
    pairs = matching.scored_pairs(master, id_col, normalize_party(name), review, block)
    queue = matching.review_candidates(pairs, auto, review, id_col, ts(as_of), "data_engineer").withColumns(
        {
            "reviewed_at": F.lit(None).cast("timestamp_ntz"),
            "reviewed_by": F.lit(None).cast("string"),
            "decision_notes": F.lit(None).cast("string"),
        }
    )
    files.write_flat(queue, f"{out}/queue")
    stored = spark.read.parquet(f"{out}/queue")
    merge = merging.AutoMerge(
        stored, as_of, auto, left=f"left_{id_col}", right=f"right_{id_col}", id_name=id_col
    )
    return {
        "queue": merge.merged_queue(),
        "master": merge.master(master, name),
        "lifecycle": merge.lifecycle(lifecycle),
        "chained": merge.chained(),
    }


def star_job(
    fact: DataFrame, zones: DataFrame, vendors: DataFrame, vendor_states: DataFrame, layout: TripLayout, out: str,
    vendor_key: str = "vendor_id", existing: Mapping[str, DataFrame] | None = None, registry: str | None = None, build: int = 1,
) -> dict[str, DataFrame]:
    """Dimensions with surrogate keys, written once below ``out``, and the fact with all of them resolved.

    ``existing`` are the dimensions of the last run, by name: their members keep their
    keys and stay in the dimensions. ``registry`` is a folder with the registry of
    each dimension's keys over all builds.
    """
    spark, old = fact.sparkSession, existing or {}
    dims = {
        "dim_date": (star.date_dimension(fact, layout.pickup), "full_date", "date_sk"),
        "dim_zone": (zones, layout.lookup_key, "zone_sk"),
        "dim_vendor": (star.active_dimension(vendors, vendor_states, vendor_key), vendor_key, "vendor_sk"),
    }
    for name, (dim, key, sk) in dims.items():
        known = registry and KeyRegistry(spark, f"{registry}/{name}", {key: dim.schema[key].dataType.simpleString()}, sk)
        dims[name] = star.keyed(dim, key, sk, old.get(name), known, build)
    for name, dim in dims.items():
        files.write_flat(dim, f"{out}/{name}")
        dims[name] = spark.read.parquet(f"{out}/{name}")
    roles = {
        "date_sk": (dims["dim_date"], "full_date", "date_sk", "pickup_date"),
        "vendor_sk": (dims["dim_vendor"], vendor_key, "vendor_sk", vendor_key),
    }
    for prefix, fact_key in layout.roles.items():
        roles[f"{prefix.lower()}zone_sk"] = (dims["dim_zone"], layout.lookup_key, "zone_sk", fact_key)
    keyed = star.resolve_keys(fact.withColumn("pickup_date", F.to_date(layout.pickup)), roles)
    return {**dims, "fact": keyed}


def governed_run(
    spark: SparkSession,
    run_id: str,
    log: str,
    latest: DataFrame,
    transform: Callable[[], DataFrame],
    gate: Callable[[DataFrame], DataFrame],
    as_of: Callable[[], str],
    max_age_hours: float = 168,
) -> str:
    """Audit -> freshness (warns) -> transform -> quality gate (blocks) -> final status.

    Each step appends one patch row to the run log. ``gate`` returns result rows
    with a status column. Retries belong to the scheduler that calls this.
    """
    step = 0

    def record(**patch: str) -> None:
        nonlocal step
        step += 1
        fields = ("status", "master_check", "transform_run", "dq", "warning")
        row = (run_id, as_of(), step, *[patch.get(f) for f in fields])
        schema = "execution_id string, at string, seq int, " + ", ".join(f"{f} string" for f in fields)
        spark.createDataFrame([row], schema).coalesce(1).write.mode("append").parquet(log)

    record(status="RUNNING")
    try:
        check = observability.freshness(latest, max_age_hours).select(
            "fresh", F.to_json(F.struct("fresh", "age_hours", "latest_key", "reason")).alias("doc")
        ).first()
        record(master_check=check["doc"])
        if not check["fresh"]:
            record(warning="MASTER_STALE_ALERT")
        result = transform()
        record(transform_run="SUCCEEDED")
    except Exception:
        record(status="FAILED", warning="PIPELINE_FAILED")
        raise
    try:
        failed = gate(result).filter("status = 'FAIL'").limit(1).count()
    except Exception:
        record(status="FAILED", dq="FAILED", warning="PIPELINE_FAILED")
        raise
    record(dq="FAILED" if failed else "SUCCEEDED")
    status = "FAILED" if failed else "SUCCEEDED"
    record(status=status, **({"warning": "DQ_FAILED"} if failed else {}))
    return status


def run_log_state(spark: SparkSession, log: str) -> DataFrame:
    """Current state of every run in a run log."""
    return observability.run_state(
        spark.read.parquet(log), "execution_id", ["at", "seq"],
        ["status", "master_check", "transform_run", "dq", "warning"],
    )
