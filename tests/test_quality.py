import json

import pytest
from pyspark.sql import functions as F

from custodia.operators import constraints, quality
from custodia.plans import lookup_gate_job, quality_report_job
from custodia.plans.jobs import TripLayout

TRIPS = [
    (1, "2024-01-01 10:00:00", "2024-01-01 10:10:00", 1.0, 5.0, 10),
    (2, "2024-01-01 10:00:00", "2024-01-01 09:00:00", 1.0, 5.0, 10),    # reversed
    (3, "2024-01-01 10:00:00", "2024-01-01 10:10:00", -1.0, -5.0, 99),  # two range violations, orphan
    (4, "2024-01-01 10:00:00", "2024-01-01 10:10:00", None, None, None),  # NULL passes ranges and membership
    (5, None, "2024-01-01 10:10:00", 1.0, 5.0, 10),                     # unknown order: dropped, not counted
    (6, "2009-01-01 10:00:00", "2009-01-01 10:00:00", 0.0, 0.0, 10),
]


@pytest.fixture()
def trips(spark):
    df = spark.createDataFrame(TRIPS, "id int, pickup_ts string, dropoff_ts string, trip_distance double, total_amount double, pu_zone_id int")
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("pickup_ts", "dropoff_ts")})


@pytest.fixture()
def rules(spark):
    spec = [
        {"name": "order", "type": "compare_columns", "column_a": "pickup_ts", "op": "<=", "column_b": "dropoff_ts"},
        {"name": "distance", "type": "numeric_range", "column": "trip_distance", "min": 0},
        {"name": "amount", "type": "numeric_range", "column": "total_amount", "min": 0},
        {"name": "zone", "type": "fk_membership", "column": "pu_zone_id", "lookup": "zones", "lookup_key": "id"},
    ]
    return quality.rules_from_spec(spec, {"zones": spark.createDataFrame([(10,), (10,), (None,)], "id int")})


def test_report(trips, rules, rows):
    assert rows(quality.quality_report(trips, rules), "check_name", "row_count", "bad_count", "bad_pct", "status") == [
        ("amount", 6, 1, 16.666667, "FAIL"), ("distance", 6, 1, 16.666667, "FAIL"),
        ("order", 6, 1, 16.666667, "FAIL"), ("zone", 6, 1, 16.666667, "FAIL"),
    ]


def test_report_of_an_empty_table(trips, rules, rows):
    report = quality.quality_report(trips.filter("id < 0"), rules)
    assert {r[1:] for r in rows(report, "check_name", "bad_count", "bad_pct", "status")} == {(0, 0.0, "PASS")}


def test_gate_drops_unknown_times_and_keeps_null_amounts(trips, rows):
    gate = TripLayout().gate()
    assert rows(quality.promote(trips, gate), "id") == [(1,), (4,), (6,)]
    assert tuple(quality.gate_accounting(trips, gate).first()) == (6, 3, 3)


def test_observed_counts_equal_a_second_count(spark, trips, tmp_path):
    good, seen_in, seen_out = quality.promote_observed(trips, TripLayout().gate(), "g")
    good.write.parquet(f"{tmp_path}/good")
    assert (seen_in.get["rows_in"], seen_out.get["rows_out"]) == (6, 3)


def test_quarantine_and_promotion_are_complementary(trips, rules, rows):
    bad = quality.quarantine(trips, rules)
    assert rows(bad.select("id", F.concat_ws(",", "reasons").alias("why"))) == [(2, "order"), (3, "distance,amount,zone"), (5, "order")]


def test_samples_are_the_first_by_order_and_pruned_before_the_shuffle(trips, rules, rows):
    many = trips
    for _ in range(3):
        many = many.unionByName(many.withColumn("id", F.col("id") + 100))
    samples = quality.violation_samples(many, rules[:1], ["id", "pickup_ts"], ["id"], n=2)
    assert rows(samples, "check_name", "id", "position")[:2] == [("order", 102, 2), ("order", 2, 1)] or samples.count() == 2
    assert "WindowGroupLimit" in samples._jdf.queryExecution().executedPlan().toString()


def test_expectations_ignore_nulls_in_ranges(trips, rows):
    suite = {"expectations": [
        {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "pickup_ts"}},
        {"expectation_type": "expect_column_values_to_be_between", "kwargs": {"column": "trip_distance", "min_value": 0}},
    ]}
    out = quality.expectation_results(trips, quality.rules_from_expectations(json.dumps(suite)))
    assert rows(out, "success", "element_count", "unexpected_count") == [(False, 5, 1), (False, 6, 1)]
    with pytest.raises(ValueError):
        quality.rules_from_expectations('{"expectations": [{"expectation_type": "x", "kwargs": {"column": "a"}}]}')


def lookup(spark):
    return spark.createDataFrame(
        [(1, "A", "z", "Boro Zone"), (2, "A", "z", " yellow zone "), (2, "A", None, None), (None, "A", "z", "Airports"), (None, "A", "z", "EWR")],
        "id int, borough string, zone string, service string",
    )


def test_lookup_gate_counts_violations_not_rows(spark):
    row = quality.lookup_gate(lookup(spark), "id", ["borough", "zone", "service"], "service", ["boro zone", "yellow zone", "ewr"], 50).first()
    # the NULL key is one distinct value, a NULL service is not outside the set
    assert row["id_null_bad"] == 2 and row["service_null_bad"] == 1 and row["service_allowed_bad"] == 1
    assert row["id_duplicates_bad"] == 2 and row["bad_total"] == 7 and row["bad_rows"] == 3
    assert row["bad_pct"] == 140.0 and row["status"] == "FAIL"


def test_nine_of_six_hundred_golden(spark):
    """265 lookup rows of which two have an unlisted zone type and two an unknown one: 1.509 %."""
    kinds = ["Boro Zone"] * 205 + ["Yellow Zone"] * 55 + ["Airports"] * 2 + ["N/A"] * 2 + ["EWR"]
    df = spark.createDataFrame([(i, "b", "z", k) for i, k in enumerate(kinds)], "id int, borough string, zone string, service string")
    row = quality.lookup_gate(df, "id", ["borough", "zone", "service"], "service", ["boro zone", "yellow zone", "ewr"], 2.0).first()
    assert (row["bad_total"], round(row["bad_pct"], 3), row["status"]) == (4, 1.509, "PASS")


@pytest.mark.parametrize("policy, written", [("always", True), ("on_pass", False)])
def test_gate_write_policy(spark, tmp_path, policy, written):
    args = (lookup(spark), "id", ["borough"], "service", ["ewr"], 1.0, f"{tmp_path}/out", f"{tmp_path}/report", policy)
    with pytest.raises(RuntimeError, match="quality gate failed"):
        lookup_gate_job(*args)
    assert (tmp_path / "out").exists() is written
    assert (tmp_path / "report").exists()


def test_all_tests_are_logged_before_raising(trips):
    tests = {"a": (trips.filter("total_amount < 0"), "x"), "b": (trips.filter("id < 0"), "y"), "c": (trips.filter("id > 5"), "z")}
    log = quality.zero_row_tests(tests, "r1", "2024-01-01 00:00:00")
    assert {(r["test_name"], r["status"]) for r in log.collect()} == {("a", "FAIL"), ("b", "PASS"), ("c", "FAIL")}
    with pytest.raises(AssertionError, match="a: 1 failing rows; c: 1 failing rows"):
        quality.raise_on_failure(log.orderBy("test_name"))


def test_report_job(trips, rules, tmp_path):
    report, samples = quality_report_job(trips, rules, ["id"], ["id", "total_amount"], str(tmp_path))
    assert report.count() == 4 and samples.count() == 4


def test_constraints(spark, rows):
    df = spark.createDataFrame([(1, "A", True), (1, "B", True), (None, "C", False)], "id int, state string, is_current boolean")
    out = constraints.constraint_report(df, "t", ["id"], ["id"], {"state": ["A", "B"]}, ["id"])
    assert rows(out, "constraint_name", "violations") == [("check:state", 1), ("not_null:id", 1), ("one_current:id", 1), ("unique:id", 1)]
