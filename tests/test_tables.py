"""Sources, sinks, versions, star schema, observability, governance, composite jobs."""

import json

import pytest
from pyspark.sql import functions as F

from custodia.operators import enrich, governance, keys, metrics, observability, quality, star
from custodia.operators.observability import Alarm
from custodia.plans import curated_trips, governed_run, metrics_workflow, monthly_enriched, run_log_state
from custodia.plans.jobs import TripLayout, curated
from custodia.session import shared_folder, ts, work_dir
from custodia.sources import (
    VersionedTable, append_batched, expired_partitions, latest_snapshot, publish_snapshot, read_declared_partitions,
    read_lookup, read_partitions, snapshot_inventory, write_partitioned,
)

NOW = "2024-03-01 00:00:00"


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert work_dir(spark) != work_dir(spark)


def test_lookup_nulls_are_per_marker_and_keys_never_fail(spark, tmp_path, rows):
    (tmp_path / "z.csv").write_text('"LocationID","Borough","Zone"\n"264","Unknown","N/A"\n"x","N/A","Outside"\n')
    args = (spark, str(tmp_path / "z.csv"), ["LocationID", "Borough", "Zone"], "LocationID", "int")
    assert set(rows(read_lookup(*args))) == {(264, "Unknown", "N/A"), (None, "N/A", "Outside")}
    assert set(rows(read_lookup(*args, ["N/A"]))) == {(264, "Unknown", None), (None, None, "Outside")}


def test_partitioned_rerun_replaces_only_its_partitions(spark, tmp_path, rows):
    path = f"{tmp_path}/t"
    write_partitioned(spark.createDataFrame([(1, 2024, 1), (2, 2024, 2)], "v int, year int, month int"), path, ["year", "month"])
    write_partitioned(spark.createDataFrame([(9, 2024, 2)], "v int, year int, month int"), path, ["year", "month"])
    assert rows(spark.read.parquet(path), "v", "month") == [(1, 1), (9, 2)]
    assert read_declared_partitions(spark, path, {"month": (2, 12)}).count() == 1
    with pytest.raises(ValueError, match="month"):
        read_partitions(spark, path, ["year", "month"], {"year": 2024})
    plan = read_partitions(spark, path, ["year", "month"], {"year": 2024, "month": 2})._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_append_to_a_catalog_table(spark, tmp_path):
    df = spark.range(3)
    append_batched(df, "appended_t", path=f"{tmp_path}/a")
    append_batched(df, "appended_t", path=f"{tmp_path}/a")
    assert spark.table("appended_t").count() == 6


def test_versions(spark, tmp_path, rows):
    t = VersionedTable(spark, f"{tmp_path}/v")
    assert t.create(spark.range(3).toDF("a"), NOW) == 0
    assert t.append(spark.range(2).toDF("a"), NOW) == 1
    # reads the table it overwrites, with another schema
    assert t.overwrite(t.read().withColumn("b", F.lit("x")), NOW) == 2
    assert t.restore(0, NOW) == 3
    assert [t.read(v).count() for v in range(4)] == [3, 5, 5, 3]
    assert t.read().columns == ["a"] and t.read(2).columns == ["a", "b"]
    assert rows(t.history(), "version", "operation", "num_rows", "restored_from") == [
        (0, "CREATE", 3, None), (1, "APPEND", 5, None), (2, "OVERWRITE", 5, None), (3, "RESTORE", 3, 0),
    ]
    with pytest.raises(ValueError):
        t.read(9)
    with pytest.raises(Exception, match="(?i)exists"):
        t._commit(3, t._entry(3)["folders"], "APPEND", NOW)


def test_snapshots_and_freshness(spark, tmp_path):
    base = f"{tmp_path}/s"
    publish_snapshot(spark.range(2), base, "20240101T000000")
    publish_snapshot(spark.range(3), base, "20240229T120000")
    inventory = snapshot_inventory(spark, base)
    latest = latest_snapshot(inventory, NOW)
    assert tuple(observability.freshness(latest, 12).select("fresh", "age_hours", "latest_key").first()) == (True, 12.0, "20240229T120000")
    assert observability.freshness(latest, 11.9).first()["fresh"] is False
    empty = observability.freshness(latest_snapshot(inventory.filter("rows < 0"), NOW)).first()
    assert (empty["fresh"], empty["reason"]) == (False, "no_master_snapshots_found")


def test_retention(spark, rows):
    inv = spark.createDataFrame([("raw/a", "2024-01-31 00:00:00"), ("raw/b", "2024-01-31 00:00:01"), ("curated/c", "2020-01-01 00:00:00")], "path string, m string")
    inv = inv.select("path", F.col("m").cast("timestamp_ntz").alias("modified_at"))
    assert rows(expired_partitions(inv, NOW, 30), "path", "age_days") == [("raw/a", 30)]


# -- enrichment and keys ----------------------------------------------------------


@pytest.mark.parametrize("salts", [1, 5])
def test_enrich_keeps_every_row(spark, salts):
    fact = spark.range(1000).select("id", F.when(F.col("id") < 900, 1).when(F.col("id") < 950, 2).otherwise(F.lit(None)).alias("k"))
    zone = spark.createDataFrame([(1, "one"), (3, "three")], "zid int, zone string")
    out = enrich.enrich(fact, zone, "k", "zid", "PU_", salts)
    assert out.agg(F.count("*"), F.count("PU_zone"), F.count_distinct("id")).first()[:] == (1000, 900, 1000)


def test_orphans_ignore_null_keys(spark, rows):
    fact = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int")
    assert rows(enrich.orphans(fact, spark.createDataFrame([(1,), (None,)], "id int"), "k", "id")) == [(2, 2)]


def test_surrogate_keys_are_unique_new_and_stable(spark):
    df = spark.range(5000).toDF("nk")
    first = keys.surrogate_keys(df, ["nk"], "sk", start=10, buckets=16)
    assert first.agg(F.count_distinct("sk"), F.min("sk") > 10).first()[:] == (5000, True)
    again = keys.surrogate_keys(df.orderBy(F.desc("nk")).repartition(7), ["nk"], "sk", start=10, buckets=16)
    assert first.join(again, ["nk", "sk"]).count() == 5000


def test_date_dimension_is_idempotent_and_counts_from_sunday(spark, rows):
    fact = spark.createDataFrame([("2024-03-03 10:00:00",), ("2024-03-03 11:00:00",), ("2024-03-09 00:00:00",), (None,)], "t string")
    fact = fact.select(F.col("t").cast("timestamp_ntz").alias("pickup_ts"))
    dim = star.date_dimension(fact, "pickup_ts")
    assert rows(dim, "day", "day_of_week") == [(3, 0), (9, 6)]
    assert star.date_dimension(fact, "pickup_ts", dim).count() == 0


def test_kpis_without_fact_rows(spark, rows):
    reg = spark.createDataFrame([("fact",), ("dim",)], "dataset_name string")
    fact = spark.createDataFrame([("2024-02-20 00:00:00", 5.0), ("2024-01-01 00:00:00", 7.0)], "t string, amount double")
    fact = fact.select(F.col("t").cast("timestamp_ntz").alias("t"), "amount")
    args = (reg, fact, "fact", "t", "amount", NOW)
    cols = ("dataset_name", "revenue_30d", "trips_30d")
    assert rows(star.dataset_kpis(*args), *cols) == [("dim", None, 0), ("fact", 5.0, 1)]
    assert rows(star.dataset_kpis(*args, count_missing_as_one=True), *cols) == [("dim", None, 1), ("fact", 5.0, 1)]


def test_profile_and_distribution(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, None)], "x int, y string")
    assert rows(metrics.profile(df)) == [("x", 2, 0, "1", "2"), ("y", 2, 1, "a", "a")]
    assert rows(metrics.value_distribution(df, "y")) == [("UNKNOWN", 1), ("a", 1)]
    assert metrics.null_share(df.filter("x > 9"), {"p": "y"}).first()["p"] is None


# -- observability ----------------------------------------------------------------


def series(spark, rows_):
    df = spark.createDataFrame(rows_, "metric string, p string, total double")
    return df.select("metric", F.col("p").cast("timestamp_ntz").alias("period_start"), "total")


@pytest.mark.parametrize(
    "missing, gap", [("notBreaching", "OK"), ("missing", "INSUFFICIENT_DATA")],
)
def test_alarm_needs_consecutive_breaches(spark, missing, gap):
    s = series(spark, [
        ("m", "2024-01-01 23:50:00", 5.0), ("m", "2024-01-01 23:55:00", 5.0), ("m", "2024-01-02 00:00:00", 5.0),
        ("m", "2024-01-02 00:10:00", 5.0), ("m", "2024-01-02 00:15:00", 1.0), ("m", "2024-01-02 00:20:00", None),
    ])
    out = observability.alarm_states(s, Alarm("a", "total", ">=", 5, 2, missing=missing))
    states = [(str(r["period_start"])[11:16], r["state"]) for r in out.orderBy("period_start").collect()]
    # two in a row across midnight; the gap at 00:05 breaks the run
    assert states == [("23:50", "OK"), ("23:55", "ALARM"), ("00:00", "ALARM"), ("00:05", gap), ("00:10", "OK"), ("00:15", "OK"), ("00:20", "OK")]


def test_run_state_takes_the_last_non_null_patch(spark, rows):
    ev = spark.createDataFrame(
        [("r", "t1", 1, "RUNNING", None), ("r", "t2", 2, None, "x"), ("r", "t3", 3, "FAILED", None), ("r", "t3", 4, None, None)],
        "id string, at string, seq int, status string, note string",
    )
    assert rows(observability.run_state(ev, "id", ["at", "seq"], ["status", "note"])) == [("r", "FAILED", "x", "t1", "t3")]


def test_metrics_of_no_runs_are_left_out(spark):
    runs = spark.createDataFrame([], "status string, doc string")
    assert observability.governance_metrics(runs, "doc").count() == 0


def test_recent_runs_skip_unreadable_starts(spark, rows):
    runs = spark.createDataFrame([(1, "2024-02-29T12:00:00Z"), (2, "2024-02-28T12:00:00Z"), (3, "?"), (4, None)], "id int, s string")
    assert rows(observability.recent_runs(runs, "s", NOW), "id") == [(1,)]


# -- governance -------------------------------------------------------------------


def test_manifests_from_files(spark, tmp_path, rows):
    good = {"dataset": "d", "domain": "x", "layer": "gold", "owner": "o", "classification": "Internal",
            "retention_policy": {"raw_days": 30}, "data_assets": [{"name": "n", "type": "master", "format": "csv"}]}
    bad = {**good, "layer": "brass", "owner": None, "retention_policy": {"raw_days": -1}, "data_assets": [{"name": "n", "type": "odd"}]}
    (tmp_path / "good.json").write_text(json.dumps(good, indent=1))
    (tmp_path / "bad.json").write_text(json.dumps(bad, indent=1))
    found = governance.manifest_violations(governance.read_manifests(spark, f"{tmp_path}/*.json"))
    assert rows(found.filter("manifest NOT LIKE '%bad.json'")) == []
    assert rows(found, "field", "problem") == [
        ("data_assets.format", "missing"), ("data_assets.type", "not_allowed"), ("layer", "not_allowed"),
        ("owner", "missing"), ("retention_policy.raw_days", "not_allowed"),
    ]


def test_table_properties(spark, tmp_path):
    for name in ("curated_x", "raw_x"):
        append_batched(spark.range(1), name, path=f"{tmp_path}/{name}")
    governance.apply_table_tags(spark, ["curated_x", "raw_x"], "curated_", {"data_owner": "de"})
    assert "data_owner" in str(spark.sql("SHOW TBLPROPERTIES curated_x").collect())
    assert "data_owner" not in str(spark.sql("SHOW TBLPROPERTIES raw_x").collect())


# -- jobs -------------------------------------------------------------------------

LAYOUT = TripLayout()


def trips(spark):
    rows_ = [
        (1, "2024-01-31 23:00:00", "2024-02-01 00:30:00", 1.0, 10.0, 1, 2), (2, "2024-02-01 10:00:00", "2024-02-01 09:00:00", 1.0, 10.0, 1, 2),
        (3, "2024-02-02 10:00:00", "2024-02-02 10:10:30", None, None, 9, None), (4, "2024-02-02 11:00:00", "2024-02-02 11:00:00", 2.0, -1.0, 1, 1),
        (5, "2024-02-02 12:00:00", "2024-02-02 12:30:00", 4.0, 20.0, 1, 1),
    ]
    df = spark.createDataFrame(rows_, "id int, pickup_ts string, dropoff_ts string, trip_distance double, total_amount double, pu_zone_id int, do_zone_id int")
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("pickup_ts", "dropoff_ts")})


def zones(spark):
    return spark.createDataFrame([(1, "B", "z1", "s"), (2, "Q", "z2", "s")], "location_id int, borough string, zone string, service_zone string")


def test_curated_job(spark, tmp_path, rows):
    out = curated_trips(trips(spark), zones(spark), LAYOUT, f"{tmp_path}/c", f"{tmp_path}/l", "run-9", NOW, {"pu_zone_id": "int"})
    assert rows(out, "id", "year", "month", "PU_zone", "DO_zone") == [(1, 2024, 1, "z1", "z2"), (3, 2024, 2, None, None), (5, 2024, 2, "z1", "z1")]
    record = spark.read.json(f"{tmp_path}/l").first()
    assert (record["rows_in"], record["rows_out"], record["rows_dropped"]) == (5, 3, 2)


def test_monthly_job_adds_duration(spark, tmp_path, rows):
    out = monthly_enriched(trips(spark), zones(spark), LAYOUT, f"{tmp_path}/m", f"{tmp_path}/l", "run-8", NOW)
    assert rows(out, "id", "trip_duration_minutes") == [(1, 90.0), (3, 10.5), (5, 30.0)]


def test_metrics_workflow(spark, tmp_path, rows):
    good = curated(trips(spark), zones(spark), LAYOUT)
    empty = metrics.daily_zone_metrics(good, "pickup_ts", "pu_zone_id", ["PU_zone", "PU_borough"], "total_amount", "trip_distance").limit(0)
    empty = empty.withColumns({"created_at": ts(NOW), "created_by": F.lit("x")})
    result = metrics_workflow(good, empty, "r", NOW, str(tmp_path), strict=True)
    assert rows(result["daily"], "pu_zone_id", "trip_count", "total_revenue", "avg_distance") == [(1, 1, 10.0, 1.0), (1, 1, 20.0, 4.0), (9, 1, 0.0, 0.0)]
    assert rows(result["monthly"].select(F.col("month").cast("string"), "PU_borough", "revenue")) == [
        ("2024-01-01", "B", 10.0), ("2024-02-01", None, 0.0), ("2024-02-01", "B", 20.0),
    ]
    assert rows(result["tests"], "status") == [("PASS",), ("PASS",)]


def governed(spark, log, transform, age, bad):
    clock = iter(f"2024-03-01T00:00:{i:02d}" for i in range(60))
    latest = spark.range(1).select(F.lit("k").alias("latest_key"), ts(NOW).alias("last_modified"), F.lit(age).alias("age_hours"))
    gate = lambda df: quality.zero_row_tests({"t": (df.filter(bad), "d")}, "r", NOW)
    return governed_run(spark, "r", log, latest, transform, gate, lambda: next(clock))


def test_governed_run(spark, tmp_path):
    ok = f"{tmp_path}/ok"
    assert governed(spark, ok, lambda: trips(spark), 1.0, "id < 0") == "SUCCEEDED"
    state = run_log_state(spark, ok).first()
    assert (state["status"], state["dq"], state["warning"], state["started_at"][-2:]) == ("SUCCEEDED", "SUCCEEDED", None, "00")
    assert json.loads(state["master_check"])["fresh"] is True
    # a stale master only warns, a failing gate ends the run
    bad = f"{tmp_path}/bad"
    assert governed(spark, bad, lambda: trips(spark), 999.0, "id > 0") == "FAILED"
    assert run_log_state(spark, bad).first()["warning"] == "DQ_FAILED"
    assert spark.read.parquet(bad).filter("warning = 'MASTER_STALE_ALERT'").count() == 1
    broken = f"{tmp_path}/broken"
    with pytest.raises(ZeroDivisionError):
        governed(spark, broken, lambda: 1 / 0, 1.0, "id > 0")
    assert run_log_state(spark, broken).first()["status"] == "FAILED"


def test_extended_keys_keep_old_members(spark):
    path_old = keys.surrogate_keys(spark.range(3000).toDF("nk"), ["nk"], "sk", buckets=16)
    new = keys.extend_keys(spark.range(500, 4000).toDF("nk"), ["nk"], "sk", path_old)
    top = path_old.agg(F.max("sk")).first()[0]
    assert new.join(path_old, ["nk", "sk"]).count() == 2500
    assert new.filter("nk >= 3000").agg(F.min("sk") > top, F.count_distinct("sk")).first()[:] == (True, 1000)


@pytest.mark.parametrize("minutes", [7, 11, 1440, 2000])
def test_alarm_windows_of_any_period(spark, minutes):
    start = "TIMESTAMP_NTZ'2024-03-01 00:05:00'"
    series = spark.range(40).selectExpr("'m' AS metric", f"{start} + make_dt_interval(0, 0, CAST(id AS INT) * {minutes}, 0) AS period_start", "10 AS total")
    out = observability.alarm_states(series, Alarm("a", "total", ">=", 5, 1, period_seconds=60 * minutes))
    assert out.agg(F.count("*"), F.sum("seen"), F.count_if(F.col("state") == "ALARM")).first()[:] == (40, 40, 40)


def test_a_raising_gate_ends_the_run_as_failed(spark, tmp_path):
    log = str(tmp_path / "log")
    with pytest.raises(ZeroDivisionError):
        latest = spark.createDataFrame([("k", 1.0)], "latest_key string, age_hours double").selectExpr("*", "TIMESTAMP_NTZ'2024-03-01 00:00:00' AS last_modified")
        clock = iter(f"2024-03-01 00:00:{k:02d}" for k in range(20))
        governed_run(spark, "r", log, latest, lambda: spark.range(1), lambda df: 1 / 0, lambda: next(clock))
    state = run_log_state(spark, log).first()
    assert (state["status"], state["dq"], state["transform_run"]) == ("FAILED", "FAILED", "SUCCEEDED")


def test_strict_bounds_and_no_snapshot(spark, tmp_path):
    suite = '{"expectations": [{"expectation_type": "expect_column_values_to_be_between", "kwargs": {"column": "v", "min_value": 0, "max_value": 5, "strict_min": true}}]}'
    rule = quality.rules_from_expectations(suite)[0]
    assert spark.createDataFrame([(0,), (1,), (5,), (6,), (None,)], "v int").filter(rule.violation()).count() == 2
    from custodia.sources import latest_snapshot, snapshot_inventory

    row = latest_snapshot(snapshot_inventory(spark, str(tmp_path / "none")), "2024-03-01 00:00:00").first()
    assert row["latest_key"] is None and row["age_hours"] is None
