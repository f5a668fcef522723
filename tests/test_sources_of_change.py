"""Logged upserts, footer counts, mergeable profiles, and signals scored once."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from custodia.catalog.metrics import merged_profile
from custodia.functions import normalize_party
from custodia.functions.similarity import blended_of, indel_ratio_of, jaro_winkler_of
from custodia.operators import matching, sketches, upsert
from custodia.session import ts, work_dir
from custodia.sources import footers, latest_snapshot, publish_snapshot, snapshot_inventory

NOW = "2024-03-01 00:00:00"
MASTER = "id long, name string, version int, created_at timestamp_ntz, created_by string, updated_at timestamp_ntz, updated_by string, approved_at timestamp_ntz, approved_by string"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_updates_that_change_nothing_are_logged(spark, rows):
    target = spark.createDataFrame([(k, f"n{k}", 1, None, "x", None, "x", None, None) for k in range(5)], MASTER)
    incoming = spark.createDataFrame([(1, "n1"), (2, "new"), (2, "new"), (7, "n7")], "id long, name string")
    gone = spark.createDataFrame([(3,), (2,), (9,)], "id long")
    new, log = upsert.upsert_logged(target, incoming, ["id"], ["name"], NOW, work_dir(spark, "log"), deleted=gone)
    names = [F.get_json_object(c, "$.name").alias(c) for c in ("old_row", "new_row")]
    assert rows(log.select("op", "id", *names)) == [("DELETE", 3, "n3", None), ("INSERT", 7, None, "n7"), ("UPDATE", 1, "n1", "n1"), ("UPDATE", 2, "n2", "new")]
    assert rows(new, "id", "name", "version") == [(0, "n0", 1), (1, "n1", 2), (2, "new", 2), (4, "n4", 1), (7, "n7", 1)]
    plain = upsert.upsert_type1(target, incoming, ["id"], ["name"], NOW)
    assert rows(new) == rows(plain.filter("id <> 3"))
    # a comparison of the two states, without the audit columns, cannot show it
    assert (1,) not in rows(upsert.change_log(target.select("id", "name"), new.select("id", "name"), ["id"], NOW, "x"), "id")


def test_counts_come_from_footers(spark, rows):
    path = work_dir(spark, "footers")
    df = spark.range(1000).selectExpr("id", "CASE WHEN id % 4 > 0 THEN CAST(id AS DOUBLE) END AS v", "CAST(id AS STRING) AS s", "id % 3 AS part")
    df.write.partitionBy("part").parquet(path)
    counts = footers.footer_counts(spark, path, ["part"])
    assert "PushedAggregation: [COUNT(*)]" in plan_of(counts) and "PushedGroupBy: [part" in plan_of(counts)
    assert rows(counts) == [(0, 334), (1, 333), (2, 333)]
    profile = footers.footer_profile(spark, path, ["id", "v", "s"])
    assert "MAX(id)" in plan_of(profile) and "MIN(v)" in plan_of(profile)
    assert rows(footers.in_session(spark, profile)) == [("id", 1000, 0, "0", "999"), ("s", 1000, 0, None, None), ("v", 1000, 250, "1.0", "999.0")]
    assert spark.conf.get("spark.sql.sources.useV1SourceList").split(",").count("parquet") == 1


def test_snapshots_are_counted_without_a_scan(spark):
    base = work_dir(spark, "snapshots")
    for stamp, n in (("20240226T180000", 5), ("20240225T180000", 7)):
        publish_snapshot(spark.range(n), base, stamp)
    inventory = snapshot_inventory(spark, base)
    assert "FileScan" not in plan_of(inventory) and "BatchScan" not in plan_of(inventory)
    assert {r["snapshot_key"]: r["rows"] for r in inventory.collect()} == {"20240226T180000": 5, "20240225T180000": 7}
    assert latest_snapshot(inventory, NOW).first()["age_hours"] == 78.0


def test_merged_profiles_stay_within_their_error(spark):
    rng = random.Random(4)
    data = [(i % 7, rng.choice([None, rng.randrange(3000)]), f"t{rng.randrange(40)}") for i in range(20_000)]
    df = spark.createDataFrame(data, "part int, v int, s string")
    parts = sketches.profile_parts(df, ["v", "s"], ["part"])
    assert parts.count() == 14
    found = {r["column_name"]: r for r in sketches.read_profiles(sketches.merge_profiles(parts), (0.1, 0.5)).collect()}
    values = sorted(v for _, v, _ in data if v is not None)
    assert (found["v"]["rows"], found["v"]["nulls"]) == (20_000, 20_000 - len(values))
    assert abs(found["v"]["distinct_values"] - len(set(values))) <= sketches.DISTINCT_ERROR * len(set(values))
    assert abs(found["s"]["distinct_values"] - 40) <= 2 and found["s"]["q50"] is None
    for name, share in (("q10", 0.1), ("q50", 0.5)):
        below = sum(v < found["v"][name] for v in values) / len(values)
        up_to = sum(v <= found["v"][name] for v in values) / len(values)
        assert below <= share + sketches.RANK_ERROR and up_to >= share - sketches.RANK_ERROR
    empty = sketches.read_profiles(sketches.merge_profiles(sketches.profile_parts(df.limit(0), ["v"], ["part"])))
    assert empty.count() == 0


def test_merged_profile_counts_each_value_of_a_year_once(spark):
    """Rows are not copied for the table's own profile, and no text of a time is made for each row."""
    rng = random.Random(9)
    day = lambda n: datetime(2023, 12, 1) + timedelta(days=n)
    data = [(rng.choice([None, rng.randrange(40)]), rng.choice([None, 0.0, -0.0, rng.randrange(300) / 4]), day(rng.randrange(60))) for _ in range(2000)]
    data += [(None, None, datetime(1999, 1, 1)), (7, 1.5, None)]
    path = work_dir(spark, "lines")
    spark.createDataFrame(data, "l_partkey long, l_extendedprice double, l_shipdate timestamp_ntz").write.parquet(f"{path}/lineitem.parquet")
    out = merged_profile(spark, path)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "explode(" not in plan and "date_format" not in plan
    want = set()
    for year in ("all", "1999", "2023", "2024"):
        some = [r for r in data if year == "all" or r[2] and str(r[2].year) == year]
        for k, name in enumerate(("l_partkey", "l_extendedprice")):
            known = [r[k] for r in some if r[k] is not None]
            want.add((year, name, len(some), len(some) - len(known), len(set(known)), True, True if known else None))
    assert {tuple(r) for r in out.collect()} == want


def test_signals_are_scored_once_a_pair(spark):
    names = ["acme cab", "acme cabs", "acme cab co", "metro taxi", "metro taxis"]
    df = spark.createDataFrame(list(enumerate(names)), "id long, name string")
    pairs = matching.scored_pairs(df, "id", normalize_party("name"), 0.8)
    queue = matching.review_candidates(pairs, 0.95, 0.8, "vendor_id", ts(NOW), "x")
    plan = queue._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and plan.count("_signals(") >= 1
    for r in pairs.collect():
        a, b = r["left_name"], r["right_name"]
        assert abs(r["score"] - blended_of(a, b)) < 1e-12
        assert abs(r["lev_ratio"] - indel_ratio_of(a, b)) < 1e-12 and abs(r["jaro_winkler"] - jaro_winkler_of(a, b)) < 1e-12
