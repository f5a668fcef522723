"""Queries: the composite jobs end to end, compared on what they wrote."""

from __future__ import annotations

from pyspark.sql import functions as F

from custodia.catalog.matching import GROUPS, LCS, NAMES, all_active, all_vendors, recursive
from custodia.catalog.roles import (
    AS_OF, CHANGES, CUSTOMERS, LAYOUT, PASSES, SHOW_VERSIONS, SOME_ZONES, STAGE, TRIPS, VERSIONS, ZONES, number,
    show_versions, some_zones, stage, trips, versions, with_ctes, zones,
)
from custodia.catalog.versions import APPLIED
from custodia.plans import curated_trips, lookup_gate_job, monthly_enriched, vendor_dedup_job
from custodia.session import ts, work_dir
from custodia.sources import VersionedTable
from custodia.streaming import apply_changes_stream, event_stream

ENTRIES = {}


def entry(name, sql=None):
    def add(fn):
        ENTRIES[name] = (fn, sql)
        return fn

    return add


@entry(
    "curated_job",
    with_ctes(TRIPS, ZONES, SOME_ZONES, body="""
SELECT order_id, line_no, part_id, CAST(total_amount AS DOUBLE) AS total_amount, p.zone AS "PU_zone", d.borough AS "DO_borough",
       year(pickup_ts) AS year, month(pickup_ts) AS month
FROM trips LEFT JOIN some_zones p ON pu_zone_id = p.location_id
LEFT JOIN some_zones d ON do_zone_id = d.location_id WHERE """ + PASSES),
)
def curated_job(spark, sf):
    """Align, gate, enrich, write partitioned by month, write lineage, read back."""
    base = work_dir(spark, "curated")
    out = curated_trips(
        trips(spark, sf), some_zones(spark, sf), LAYOUT, f"{base}/trips", f"{base}/lineage", "run-1", AS_OF,
        {"pu_zone_id": "int", "do_zone_id": "int"},
    )
    return out.select(
        "order_id", "line_no", "part_id", number("total_amount").alias("total_amount"), "PU_zone", "DO_borough", "year", "month"
    )


@entry(
    "monthly_job",
    with_ctes(TRIPS, ZONES, body="""
SELECT order_id, line_no, part_id, p.zone AS "PU_zone", d.zone AS "DO_zone",
       ROUND((epoch_us(dropoff_ts) - epoch_us(pickup_ts)) / 6e7, 4) AS minutes
FROM trips JOIN zones p ON pu_zone_id = p.location_id JOIN zones d ON do_zone_id = d.location_id WHERE """ + PASSES),
)
def monthly_job(spark, sf):
    base = work_dir(spark, "monthly")
    out = monthly_enriched(
        trips(spark, sf), zones(spark, sf), LAYOUT, f"{base}/trips", f"{base}/lineage", "run-1", AS_OF
    )
    return out.select(
        "order_id", "line_no", "part_id", "PU_zone", "DO_zone", F.round("trip_duration_minutes", 4).alias("minutes")
    )


@entry(
    "lookup_gate_job",
    """SELECT COUNT(*) AS total_rows, COUNT(*) FILTER (WHERE c_mktsegment NOT IN ('BUILDING', 'FURNITURE', 'MACHINERY')) AS bad_total,
       'PASS' AS status FROM customer""",
)
def lookup_gate_query(spark, sf):
    """Customers as a reference file: the report as written by the job."""
    base = work_dir(spark, "gate")
    customer = spark.read.parquet(f"{sf}/customer.parquet")
    report = lookup_gate_job(
        customer, "c_custkey", ["c_name", "c_mktsegment"], "c_mktsegment", ["building", "furniture", "machinery"], 60.0,
        f"{base}/out", f"{base}/report",
    )
    return report.select("total_rows", "bad_total", "status")


@entry(
    "dedup_merge_job",
    recursive(with_ctes(NAMES, LCS, """m AS (
  SELECT left_id AS s, right_id AS t, ROUND(0.55 * jw + 0.45 * ratio, 9) AS confidence FROM rated
  WHERE 0.55 * jw + 0.45 * ratio >= 0.86)""", GROUPS, body="""
SELECT vendor_id, CASE WHEN g.root IS NULL OR length(vendor_name) >= length(partner) THEN vendor_name ELSE partner END AS vendor_name,
       1 + COALESCE(merges, 0) AS version,
       CASE WHEN vendor_id IN (SELECT vendor_id FROM grouped WHERE vendor_id <> root) THEN 'DEPRECATED' ELSE 'ACTIVE' END AS lifecycle_state
FROM spelled LEFT JOIN gains g ON vendor_id = g.root""")),
)
def dedup_merge_job(spark, sf):
    """Score, queue, merge all parts as vendors; the merged masters with their lifecycle state."""
    out = vendor_dedup_job(
        all_vendors(spark, sf), all_active(spark, sf), "vendor_id", "vendor_name", AS_OF, work_dir(spark, "dedup"), auto=0.86, review=0.80
    )
    return out["master"].join(out["lifecycle"].select("vendor_id", "lifecycle_state"), "vendor_id").select(
        "vendor_id", "vendor_name", F.col("version").cast("long").alias("version"), "lifecycle_state",
    )


@entry("stream_scd2_apply", with_ctes(VERSIONS, STAGE, CHANGES, APPLIED, body=f"SELECT {SHOW_VERSIONS} FROM applied"))
def stream_scd2_apply(spark, sf):
    """The stage arrives as a stream; each batch becomes one version of the table."""
    base = work_dir(spark, "scd2")
    table = VersionedTable(spark, f"{base}/table")
    table.create(versions(spark, sf), "2024-02-01 00:00:00")
    incoming = stage(spark, sf).withColumn("loaded_at", ts("2024-02-29 00:00:00"))
    incoming.write.parquet(f"{base}/incoming")
    stream = event_stream(spark, f"{base}/incoming", incoming.schema)
    apply_changes_stream(
        stream, table, CUSTOMERS, lambda batch: AS_OF, f"{base}/checkpoint", "loader", "monthly load", "CRM"
    )
    return show_versions(table.read())
