"""Queries: rules, gates, scorecards, constraints."""

from __future__ import annotations

from pyspark.sql import functions as F

from custodia.catalog.roles import (
    AS_OF, DAILY, LAYOUT, LIFECYCLE, PASSES, SOME_ZONES, TRIPS, VERSIONS, ZONES,
    lifecycle, some_zones, table, text, trips, versions, with_ctes, zones,
)
from custodia.catalog.metrics import daily
from custodia.operators import constraints, enrich, observability, quality
from custodia.session import work_dir
from custodia.sources import write_report

ENTRIES = {}


def entry(name, sql=None):
    def add(fn):
        ENTRIES[name] = (fn, sql)
        return fn

    return add


# The rule file of the trips, as data.
RULES = [
    {"name": "pickup_before_dropoff", "type": "compare_columns", "column_a": "pickup_ts", "op": "<=",
     "column_b": "dropoff_ts", "severity": "high"},
    {"name": "non_negative_trip_distance", "type": "numeric_range", "column": "trip_distance", "min": 0,
     "severity": "medium"},
    {"name": "non_negative_total_amount", "type": "numeric_range", "column": "total_amount", "min": 0,
     "severity": "high"},
    {"name": "pu_location_in_lookup", "type": "fk_membership", "column": "pu_zone_id", "lookup": "zones",
     "lookup_key": "location_id", "severity": "high"},
    {"name": "do_location_in_lookup", "type": "fk_membership", "column": "do_zone_id", "lookup": "zones",
     "lookup_key": "location_id", "severity": "high"},
]

EXPECTATIONS = """{"expectations": [
  {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "pickup_ts"}},
  {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "total_amount"}},
  {"expectation_type": "expect_column_values_to_be_between",
   "kwargs": {"column": "trip_distance", "min_value": 0, "strict_min": false}},
  {"expectation_type": "expect_column_values_to_be_between",
   "kwargs": {"column": "total_amount", "min_value": 0, "strict_min": false}}]}"""

ORDER = ["order_id", "line_no", "part_id", "vendor_id", "dropoff_ts", "fare_amount"]


def rules(spark, sf):
    return quality.rules_from_spec(RULES, {"zones": some_zones(spark, sf)})


# (rule, severity, SQL condition of a violation); the fk conditions need the two lookup joins
BAD = [
    ("pickup_before_dropoff", "high", "pickup_ts > dropoff_ts"),
    ("non_negative_trip_distance", "medium", "COALESCE(trip_distance, 0) < 0"),
    ("non_negative_total_amount", "high", "COALESCE(total_amount, 0) < 0"),
    ("pu_location_in_lookup", "high", "pu_zone_id NOT IN (SELECT location_id FROM some_zones)"),
    ("do_location_in_lookup", "high", "do_zone_id NOT IN (SELECT location_id FROM some_zones)"),
]


def report_sql():
    return " UNION ALL ".join(
        f"SELECT '{name}' AS check_name, '{sev}' AS severity, COUNT(*) AS row_count, "
        f"COUNT(*) FILTER (WHERE {bad}) AS bad_count, "
        f"ROUND(COUNT(*) FILTER (WHERE {bad}) * 100.0 / COUNT(*), 6) AS bad_pct, "
        f"CASE WHEN COUNT(*) FILTER (WHERE {bad}) = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM trips"
        for name, sev, bad in BAD
    )


@entry("quality_report", with_ctes(TRIPS, ZONES, SOME_ZONES, body=report_sql()))
def quality_report(spark, sf):
    return quality.quality_report(trips(spark, sf), rules(spark, sf))


@entry("report_roundtrip", with_ctes(TRIPS, ZONES, SOME_ZONES, body=report_sql()))
def report_roundtrip(spark, sf):
    """The report written as JSON and read back."""
    out = work_dir(spark, "report")
    write_report(quality_report(spark, sf), out)
    return spark.read.schema(
        "check_name string, severity string, row_count long, bad_count long, bad_pct double, status string"
    ).json(out)


def samples_sql(bad):
    parts = " UNION ALL ".join(
        f"SELECT '{name}' AS check_name, order_id, line_no, part_id, vendor_id, dropoff_ts, fare_amount "
        f"FROM trips WHERE {cond}" for name, _, cond in bad
    )
    return f"""
SELECT check_name, order_id, line_no, part_id, vendor_id, CAST(dropoff_ts AS VARCHAR) AS dropoff_ts, fare_amount, position FROM (
  SELECT *, row_number() OVER (PARTITION BY check_name
    ORDER BY order_id, line_no, part_id, vendor_id, dropoff_ts, fare_amount) AS position FROM ({parts}))
WHERE position <= 10"""


@entry("quality_samples", with_ctes(TRIPS, ZONES, SOME_ZONES, body=samples_sql(BAD)))
def quality_samples(spark, sf):
    found = quality.violation_samples(trips(spark, sf), rules(spark, sf), ORDER, ORDER)
    return found.withColumn("dropoff_ts", text("dropoff_ts"))


@entry("first_violations", with_ctes(TRIPS, body=samples_sql(BAD[:1])))
def first_violations(spark, sf):
    column_rules = quality.rules_from_spec(RULES[:1])
    found = quality.violation_samples(trips(spark, sf), column_rules, ORDER, ORDER)
    return found.withColumn("dropoff_ts", text("dropoff_ts"))


ALLOWED = ("boro zone", "yellow zone", "ewr")


@entry(
    "lookup_gate",
    with_ctes(ZONES, body="""
, c AS (
  SELECT COUNT(*) AS total_rows,
         COUNT(*) FILTER (WHERE location_id IS NULL) AS location_id_null_bad,
         COUNT(*) FILTER (WHERE borough IS NULL) AS borough_null_bad,
         COUNT(*) FILTER (WHERE zone IS NULL) AS zone_null_bad,
         COUNT(*) FILTER (WHERE service_zone IS NULL) AS service_zone_null_bad,
         COUNT(*) FILTER (WHERE lower(trim(service_zone)) NOT IN ('boro zone', 'yellow zone')) AS service_zone_allowed_bad,
         COUNT(*) - COUNT(DISTINCT location_id) AS location_id_duplicates_bad,
         COUNT(*) FILTER (WHERE service_zone IS NULL OR lower(trim(service_zone)) NOT IN ('boro zone', 'yellow zone')) AS bad_rows
  FROM zones)
SELECT *, bad_total * 100.0 / total_rows AS bad_pct, CAST(50.0 AS DOUBLE) AS threshold_max_bad_pct,
       CASE WHEN bad_total * 100.0 / total_rows <= 50.0 THEN 'PASS' ELSE 'FAIL' END AS status
FROM (SELECT *, location_id_null_bad + borough_null_bad + zone_null_bad + service_zone_null_bad
             + service_zone_allowed_bad + location_id_duplicates_bad AS bad_total FROM c)"""),
)
def lookup_gate(spark, sf):
    return quality.lookup_gate(
        zones(spark, sf), "location_id", ["borough", "zone", "service_zone"], "service_zone", ALLOWED[:2], 50.0
    )


@entry(
    "fk_orphans",
    with_ctes(TRIPS, ZONES, SOME_ZONES, body="""
SELECT do_zone_id AS key_value, COUNT(*) AS fact_rows FROM trips
WHERE do_zone_id NOT IN (SELECT location_id FROM some_zones) GROUP BY 1"""),
)
def fk_orphans(spark, sf):
    return enrich.orphans(trips(spark, sf), some_zones(spark, sf), "do_zone_id", "location_id")


@entry(
    "quarantine_rows",
    with_ctes(TRIPS, ZONES, SOME_ZONES, body="""
SELECT * FROM (SELECT order_id, line_no, part_id, vendor_id, concat_ws(',',
  CASE WHEN pickup_ts > dropoff_ts THEN 'pickup_before_dropoff' END,
  CASE WHEN COALESCE(trip_distance, 0) < 0 THEN 'non_negative_trip_distance' END,
  CASE WHEN COALESCE(total_amount, 0) < 0 THEN 'non_negative_total_amount' END,
  CASE WHEN pu_zone_id NOT IN (SELECT location_id FROM some_zones) THEN 'pu_location_in_lookup' END,
  CASE WHEN do_zone_id NOT IN (SELECT location_id FROM some_zones) THEN 'do_location_in_lookup' END) AS reasons
FROM trips) WHERE reasons <> ''"""),
)
def quarantine_rows(spark, sf):
    bad = quality.quarantine(trips(spark, sf), rules(spark, sf))
    return bad.select("order_id", "line_no", "part_id", "vendor_id", F.concat_ws(",", "reasons").alias("reasons"))


@entry(
    "gate_accounting",
    with_ctes(TRIPS, body=f"""
SELECT COUNT(*) AS rows_in, COUNT(*) FILTER (WHERE {PASSES}) AS rows_out,
       COUNT(*) - COUNT(*) FILTER (WHERE {PASSES}) AS rows_dropped FROM trips"""),
)
def gate_accounting(spark, sf):
    return quality.gate_accounting(trips(spark, sf), LAYOUT.gate())


@entry(
    "lineage_record",
    with_ctes(TRIPS, body=f"""
SELECT 'run-1' AS run_id, 'validated_promotion' AS step, 'trips' AS inputs, 'validated' AS output,
       'pickup<=dropoff,trip_distance>=0,total_amount>=0' AS rules,
       COUNT(*) AS rows_in, COUNT(*) FILTER (WHERE {PASSES}) AS rows_out,
       COUNT(*) - COUNT(*) FILTER (WHERE {PASSES}) AS rows_dropped FROM trips"""),
)
def lineage_record(spark, sf):
    """Counts observed while the promoted rows were written, as a lineage row."""
    good, seen_in, seen_out = quality.promote_observed(trips(spark, sf), LAYOUT.gate(), "run-1")
    good.write.parquet(work_dir(spark, "validated"))
    record = observability.lineage_from_observations(
        spark, seen_in, seen_out, step="validated_promotion", run_id="run-1", inputs=["trips"], output="validated",
        rules=[r.name for r in LAYOUT.gate()], transformations=["filter validated rules"], as_of=AS_OF,
    )
    return record.select(
        "run_id", "step", F.concat_ws(",", "inputs").alias("inputs"), "output",
        F.concat_ws(",", "rules").alias("rules"), "rows_in", "rows_out", "rows_dropped",
    )


@entry(
    "scorecard",
    with_ctes(TRIPS, ZONES, SOME_ZONES, body="""
, m AS (
  SELECT 100.0 * COUNT(total_amount) / COUNT(*) AS completeness,
         100.0 * COUNT(*) FILTER (WHERE COALESCE(trip_distance, 0) >= 0 AND COALESCE(total_amount, 0) >= 0) / COUNT(*) AS validity,
         100.0 * COUNT(*) FILTER (WHERE pu_zone_id NOT IN (SELECT location_id FROM some_zones)) / COUNT(*) AS orphan,
         (epoch_us(TIMESTAMP '2001-11-05') - epoch_us(MAX(dropoff_ts))) / 3.6e9 AS lag FROM trips)
SELECT 'Completeness' AS dimension, ROUND(completeness, 4) AS measured, '>= 99.9' AS threshold,
       CASE WHEN completeness >= 99.9 THEN 'PASS' ELSE 'FAIL' END AS status, 'Data Steward (Ops)' AS owner,
       CASE WHEN completeness >= 99.9 THEN NULL ELSE 'Block promotion to validated; create ticket' END AS action FROM m
UNION ALL SELECT 'Validity', ROUND(validity, 4), '>= 100.0', CASE WHEN validity >= 100 THEN 'PASS' ELSE 'FAIL' END,
       'Data Owner (Finance)', CASE WHEN validity >= 100 THEN NULL ELSE 'Quarantine bad rows; alert owner' END FROM m
UNION ALL SELECT 'Consistency', ROUND(orphan, 4), '<= 0.1', CASE WHEN orphan <= 0.1 THEN 'PASS' ELSE 'FAIL' END,
       'Data Steward (Ops)', CASE WHEN orphan <= 0.1 THEN NULL ELSE 'Manual review; steward approval required' END FROM m
UNION ALL SELECT 'Timeliness', ROUND(lag, 4), '<= 24.0', CASE WHEN lag <= 24 THEN 'PASS' ELSE 'FAIL' END,
       'Data Custodian (DE)', CASE WHEN lag <= 24 THEN NULL ELSE 'On-call alert; rerun job' END FROM m"""),
)
def scorecard(spark, sf):
    fact = trips(spark, sf)
    ok = (F.coalesce("trip_distance", F.lit(0)) >= 0) & (F.coalesce("total_amount", F.lit(0)) >= 0)
    last = F.timestamp_diff("MICROSECOND", F.max("dropoff_ts"), F.lit("2001-11-05 00:00:00").cast("timestamp_ntz"))
    # one scan for all measures, the lookup one by its grouping set
    totals, named = quality.rule_totals(fact, rules(spark, sf)[3:4], {
        "completeness": F.lit(100.0) * F.count("total_amount") / F.count("*"),
        "validity": F.lit(100.0) * F.count_if(ok) / F.count("*"),
        "lag": last / F.lit(3.6e9),
    })
    one = totals.withColumn("orphan", F.lit(100.0) * F.col(named[0][1]) / F.col("_n"))
    card = quality.scorecard(
        [
            (one, [
                ("completeness", "Completeness", ">=", 99.9, "Data Steward (Ops)", "Block promotion to validated; create ticket"),
                ("validity", "Validity", ">=", 100.0, "Data Owner (Finance)", "Quarantine bad rows; alert owner"),
                ("lag", "Timeliness", "<=", 24.0, "Data Custodian (DE)", "On-call alert; rerun job"),
                ("orphan", "Consistency", "<=", 0.1, "Data Steward (Ops)", "Manual review; steward approval required"),
            ]),
        ]
    )
    return card.withColumn("measured", F.round("measured", 4))


@entry(
    "zero_row_tests",
    with_ctes(TRIPS, ZONES, DAILY, body="""
SELECT 'run-1' AS run_id, test_name, CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END AS status, n AS failing_rows, details FROM (
  SELECT 'test_no_negative_revenue' AS test_name, COUNT(*) AS n, 'total_revenue >= 0' AS details FROM daily WHERE total_revenue < 0
  UNION ALL SELECT 'test_not_null_keys', COUNT(*), 'PK columns not null' FROM daily WHERE trip_date IS NULL OR pu_zone_id IS NULL
  UNION ALL SELECT 'test_min_trips', COUNT(*), 'trip_count >= 2' FROM daily WHERE trip_count < 2)"""),
)
def zero_row_tests(spark, sf):
    tests = {
        "test_no_negative_revenue": (F.col("total_revenue") < 0, "total_revenue >= 0"),
        "test_not_null_keys": (F.col("trip_date").isNull() | F.col("pu_zone_id").isNull(), "PK columns not null"),
        "test_min_trips": (F.col("trip_count") < 2, "trip_count >= 2"),
    }
    return quality.zero_row_conditions(daily(spark, sf), tests, "run-1", AS_OF).drop("ran_at")


@entry(
    "expectation_suite",
    with_ctes(TRIPS, body="""
SELECT 'expect_column_values_to_not_be_null:pickup_ts' AS expectation, COUNT(*) = COUNT(pickup_ts) AS success,
       COUNT(*) AS element_count, COUNT(*) - COUNT(pickup_ts) AS unexpected_count,
       ROUND((COUNT(*) - COUNT(pickup_ts)) * 100.0 / COUNT(*), 6) AS unexpected_percent FROM trips
UNION ALL SELECT 'expect_column_values_to_not_be_null:total_amount', COUNT(*) = COUNT(total_amount), COUNT(*),
       COUNT(*) - COUNT(total_amount), ROUND((COUNT(*) - COUNT(total_amount)) * 100.0 / COUNT(*), 6) FROM trips
UNION ALL SELECT 'expect_column_values_to_be_between:trip_distance', COUNT(*) FILTER (WHERE trip_distance < 0) = 0,
       COUNT(trip_distance), COUNT(*) FILTER (WHERE trip_distance < 0),
       ROUND(COUNT(*) FILTER (WHERE trip_distance < 0) * 100.0 / COUNT(trip_distance), 6) FROM trips
UNION ALL SELECT 'expect_column_values_to_be_between:total_amount', COUNT(*) FILTER (WHERE total_amount < 0) = 0,
       COUNT(total_amount), COUNT(*) FILTER (WHERE total_amount < 0),
       ROUND(COUNT(*) FILTER (WHERE total_amount < 0) * 100.0 / COUNT(total_amount), 6) FROM trips"""),
)
def expectation_suite(spark, sf):
    return quality.expectation_results(trips(spark, sf), quality.rules_from_expectations(EXPECTATIONS))


@entry(
    "constraint_checks",
    with_ctes(VERSIONS, body="""
SELECT 'versions' AS table_name, 'not_null:customer_id' AS constraint_name, COUNT(*) FILTER (WHERE customer_id IS NULL) AS violations FROM versions
UNION ALL SELECT 'versions', 'not_null:segment', COUNT(*) FILTER (WHERE segment IS NULL) FROM versions
UNION ALL SELECT 'versions', 'check:approval_status', COUNT(*) FILTER (WHERE approval_status NOT IN ('APPROVED', 'REJECTED')) FROM versions
UNION ALL SELECT 'versions', 'unique:customer_id', COUNT(*) FROM (SELECT customer_id FROM versions GROUP BY 1 HAVING COUNT(*) > 1)
UNION ALL SELECT 'versions', 'one_current:nation', COUNT(*) FROM (SELECT nation FROM versions WHERE is_current GROUP BY 1 HAVING COUNT(*) > 1)"""),
)
def constraint_checks(spark, sf):
    """Deliberately too strict constraints, so that every kind reports violations."""
    return constraints.constraint_report(
        versions(spark, sf), "versions", ["customer_id"], ["customer_id", "segment"],
        {"approval_status": ["APPROVED", "REJECTED"]}, ["nation"],
    )


@entry(
    "one_current_row",
    with_ctes(VERSIONS, body="""
SELECT customer_id, COUNT(*) AS versions, COUNT(*) FILTER (WHERE is_current) AS current_rows,
       COUNT(*) FILTER (WHERE is_current) <= 1 AS holds FROM versions GROUP BY 1"""),
)
def one_current_row(spark, sf):
    return versions(spark, sf).groupBy("customer_id").agg(
        F.count("*").alias("versions"),
        F.count_if("is_current").alias("current_rows"),
        (F.count_if("is_current") <= 1).alias("holds"),
    )


@entry(
    "master_scorecard",
    with_ctes(LIFECYCLE, """names AS (
  SELECT p_partkey AS id, p_name AS name, p_brand AS brand FROM part)""", body="""
, g AS (SELECT name, COUNT(*) AS n FROM names GROUP BY 1),
m AS (SELECT
  (SELECT 100.0 * SUM(CASE WHEN n > 1 THEN n ELSE 0 END) / SUM(n) FROM g) AS dup,
  (SELECT 100.0 * COUNT(*) FILTER (WHERE l_suppkey NOT IN (SELECT vendor_id FROM lifecycle)) / COUNT(*) FROM lineitem) AS inv,
  (SELECT 100.0 * COUNT(*) FILTER (WHERE b > 1) / COUNT(*) FROM (SELECT name, COUNT(DISTINCT brand) AS b FROM names GROUP BY 1)) AS conf,
  (SELECT (epoch_us(TIMESTAMP '2024-01-01 12:00:00') - epoch_us(MAX(updated_at))) / 3.6e9 FROM lifecycle) AS lag,
  (SELECT 100.0 * COUNT(updated_by) / COUNT(*) FROM lifecycle) AS logged)
SELECT 'Uniqueness' AS dimension, ROUND(dup, 4) AS measured, CASE WHEN dup <= 0.5 THEN 'PASS' ELSE 'FAIL' END AS status FROM m
UNION ALL SELECT 'Validity', ROUND(inv, 4), CASE WHEN inv <= 0 THEN 'PASS' ELSE 'FAIL' END FROM m
UNION ALL SELECT 'Consistency', ROUND(conf, 4), CASE WHEN conf <= 1 THEN 'PASS' ELSE 'FAIL' END FROM m
UNION ALL SELECT 'Timeliness', ROUND(lag, 4), CASE WHEN lag <= 24 THEN 'PASS' ELSE 'FAIL' END FROM m
UNION ALL SELECT 'Auditability', ROUND(logged, 4), CASE WHEN logged >= 100 THEN 'PASS' ELSE 'FAIL' END FROM m"""),
)
def master_scorecard(spark, sf):
    part, states = table(spark, sf, "part"), lifecycle(spark, sf)
    groups = part.groupBy("p_name").agg(F.count("*").alias("n"), F.count_distinct("p_brand").alias("b"))
    dup = groups.agg(
        (F.lit(100.0) * F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)) / F.sum("n")).alias("dup"),
        (F.lit(100.0) * F.count_if(F.col("b") > 1) / F.count("*")).alias("conf"),
    )
    member = quality.Membership("vendor", "l_suppkey", states, "vendor_id")
    inv = quality.quality_report(table(spark, sf, "lineitem"), [member]).select(
        (F.lit(100.0) * F.col("bad_count") / F.col("row_count")).alias("inv")
    )
    newest = F.timestamp_diff("MICROSECOND", F.max("updated_at"), F.lit("2024-01-01 12:00:00").cast("timestamp_ntz"))
    state = states.agg(
        (newest / F.lit(3.6e9)).alias("lag"),
        (F.lit(100.0) * F.count("updated_by") / F.count("*")).alias("logged"),
    )
    card = quality.scorecard(
        [
            (dup, [
                ("dup", "Uniqueness", "<=", 0.5, "Data Steward (Vendor Mgmt)", "Steward review queue"),
                ("conf", "Consistency", "<=", 1.0, "Steward", "Steward arbitration"),
            ]),
            (inv, [("inv", "Validity", "<=", 0.0, "Data Owner (Vendor Mgmt VP)", "Block curated publish")]),
            (state, [
                ("lag", "Timeliness", "<=", 24.0, "Custodian (DE)", "Alert + rerun"),
                ("logged", "Auditability", ">=", 100.0, "Custodian", "Run fails"),
            ]),
        ]
    )
    return card.select("dimension", F.round("measured", 4).alias("measured"), "status")
