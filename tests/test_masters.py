"""Upserts, merges, golden records, lifecycle, approvals."""

import pytest
from pyspark.sql import functions as F

from custodia.operators import lifecycle, matching, merging, survivorship, upsert
from custodia.operators.survivorship import FieldRule
from custodia.session import ts

NOW = "2024-03-01 00:00:00"


def master(spark, rows_):
    df = spark.createDataFrame(rows_, "id int, name string, version int, created_by string")
    return df.withColumns(
        {
            "created_at": ts("2024-01-01 00:00:00"), "updated_at": ts("2024-01-01 00:00:00"), "updated_by": F.lit("x"),
            "approved_at": F.lit(None).cast("timestamp_ntz"), "approved_by": F.lit(None).cast("string"),
        }
    )


@pytest.mark.parametrize("only_if_changed, version_of_equal", [(False, 4), (True, 3)])
def test_upsert_type1(spark, rows, only_if_changed, version_of_equal):
    old = master(spark, [(1, "a", 1, "loader"), (2, "b", 3, "loader"), (3, "c", 1, "loader"), (5, None, 1, "loader")])
    new = spark.createDataFrame([(1, "a2"), (2, "b"), (4, "d"), (5, None)], "id int, name string")
    out = upsert.upsert_type1(old, new, ["id"], ["name"], NOW, only_if_changed=only_if_changed)
    assert rows(out, "id", "name", "version", "created_by") == [
        (1, "a2", 2, "loader"), (2, "b", version_of_equal, "loader"), (3, "c", 1, "loader"), (4, "d", 1, "data_engineer"),
        (5, None, 1 if only_if_changed else 2, "loader"),
    ]
    assert out.filter("id = 3").first()["updated_by"] == "x"
    assert out.columns == old.columns


def test_insert_if_absent_keeps_existing(spark, rows):
    old = spark.createDataFrame([(1, "a", "x")], "id int, name string, extra string")
    new = spark.createDataFrame([(1, "z"), (2, "b")], "id int, name string")
    assert rows(upsert.insert_if_absent(old, new, ["id"])) == [(1, "a", "x"), (2, "b", None)]


def test_upsert_measures_keeps_created_and_can_set_null(spark, rows):
    old = spark.createDataFrame([("d1", 1, 5, "first"), ("d2", 1, 5, "first")], "day string, zone int, n int, created_by string")
    old = old.withColumn("created_at", ts("2024-01-01 00:00:00"))
    new = spark.createDataFrame([("d1", 1, None), ("d3", 1, 7)], "day string, zone int, n int")
    out = upsert.upsert_measures(old, new, ["day", "zone"], NOW)
    assert rows(out, "day", "n", "created_by") == [("d1", None, "first"), ("d2", 5, "first"), ("d3", 7, "sql_transform_v1")]


def test_replace_by_key(spark, rows):
    old = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, v int")
    new = spark.createDataFrame([("a", 9), ("c", 8)], "k string, v int")
    assert rows(upsert.replace_by_key(old, new, ["k"])) == [("a", 9), ("b", 3), ("c", 8)]


def test_change_log(spark, rows):
    old = spark.createDataFrame([(1, "a"), (2, None), (3, "c"), (4, None)], "id int, name string")
    new = spark.createDataFrame([(1, "a"), (2, "b"), (4, None), (5, "e")], "id int, name string")
    log = upsert.change_log(old, new, ["id"], NOW, "me")
    assert rows(log, "op", "id", "old_row", "new_row") == [
        ("DELETE", 3, '{"id":3,"name":"c"}', None), ("INSERT", 5, None, '{"id":5,"name":"e"}'),
        ("UPDATE", 2, '{"id":2}', '{"id":2,"name":"b"}'),
    ]


# -- merges ---------------------------------------------------------------------

QUEUE = "review_id long, left_vendor_id int, right_vendor_id int, confidence double, recommendation string, status string"


def queue(spark, rows_):
    return spark.createDataFrame(rows_, QUEUE).withColumns(
        {
            "created_at": ts("2024-02-27 00:00:00"), "reviewed_at": F.lit(None).cast("timestamp_ntz"),
            "reviewed_by": F.lit(None).cast("string"), "decision_notes": F.lit(None).cast("string"),
        }
    )


def vendors(spark, rows_):
    df = spark.createDataFrame(rows_, "vendor_id int, vendor_name string")
    return df.withColumns(
        {"version": F.lit(1), "updated_at": ts("2024-01-01 00:00:00"), "updated_by": F.lit("x"),
         "approved_at": F.lit(None).cast("timestamp_ntz"), "approved_by": F.lit(None).cast("string")}
    )


def test_auto_merge(spark, rows):
    q = queue(spark, [
        (1, 2, 1, 0.99, "AUTO_MERGE", "OPEN"),      # the smaller id survives although it is on the right
        (2, 1, 3, 0.95, "AUTO_MERGE", "OPEN"),      # exactly at the threshold: second partner of 1
        (3, 4, 5, 0.949, "AUTO_MERGE", "OPEN"),     # below
        (4, 6, 7, 0.99, "AUTO_MERGE", "APPROVED"),  # not open
        (5, 8, 9, 0.99, "STEWARD_REVIEW", "OPEN"),
        (6, 10, 11, 0.97, "AUTO_MERGE", "OPEN"),    # equal length: the survivor's name stays
        (7, 12, 13, 0.97, "AUTO_MERGE", "OPEN"),    # NULL name loses
    ])
    names = [(1, "acme"), (2, "acme inc"), (3, "acme incorporated")] + [(i, f"v{i}") for i in range(4, 10)]
    names += [(10, "abc"), (11, "xyz"), (12, None), (13, "long")]
    m = merging.AutoMerge(q, NOW)
    out = m.master(vendors(spark, names), "vendor_name")
    assert rows(out.filter("version > 1"), "vendor_id", "vendor_name", "version") == [
        (1, "acme incorporated", 3), (10, "abc", 2), (12, "long", 2),
    ]
    life = spark.createDataFrame([(i, "ACTIVE", None) for i in (1, 2)], "vendor_id int, lifecycle_state string, state_reason string")
    life = life.withColumns({"updated_at": ts(NOW), "updated_by": F.lit("x"), "approved_at": ts(NOW), "approved_by": F.lit("x")})
    states = m.lifecycle(life)
    assert rows(states, "vendor_id", "lifecycle_state") == [(1, "ACTIVE"), (11, "DEPRECATED"), (13, "DEPRECATED"), (2, "DEPRECATED"), (3, "DEPRECATED")]
    assert states.filter("vendor_id = 3").first()["state_reason"] == "Auto-merged into vendor_id=1 (conf=0.95)"
    closed = m.merged_queue()
    assert rows(closed.filter("status = 'MERGED'"), "review_id") == [(1,), (2,), (6,), (7,)]
    assert closed.filter("review_id = 1").first()["decision_notes"] == "Survivor=1, Deprecated=2"
    assert m.chained().count() == 0


def test_chained_pairs_are_reported(spark, rows):
    q = queue(spark, [(1, 1, 2, 0.99, "AUTO_MERGE", "OPEN"), (2, 2, 3, 0.97, "AUTO_MERGE", "OPEN")])
    assert rows(merging.AutoMerge(q, NOW).chained()) == [(2,)]


def test_decisions_only_touch_open_items(spark, rows):
    q = queue(spark, [(1, 1, 2, 0.9, "STEWARD_REVIEW", "OPEN"), (2, 3, 4, 0.9, "STEWARD_REVIEW", "MERGED")])
    d = spark.createDataFrame([(1, "APPROVED", "s", "yes"), (2, "REJECTED", "s", "no")], "review_id long, decision string, reviewer string, notes string")
    assert rows(merging.decide(q, d, NOW), "review_id", "status", "decision_notes") == [(1, "APPROVED", "yes"), (2, "MERGED", None)]


def test_escalation_after_48_hours(spark, rows):
    q = queue(spark, [(1, 1, 2, 0.9, "STEWARD_REVIEW", "OPEN"), (2, 1, 3, 0.9, "STEWARD_REVIEW", "REJECTED")])
    assert rows(merging.escalations(q, "2024-02-29 00:00:00"), "review_id") == []
    assert rows(merging.escalations(q, "2024-02-29 00:00:01"), "review_id", "escalate_to") == [(1, "owner")]


# -- golden records -------------------------------------------------------------

CLAIMS = [
    (1, 1, "B1", None, "boro zone"), (1, 2, "B2", "long name", "ewr"), (1, 3, "B2", "x", None),
    (2, 2, "M", "aa", "other"), (2, 2, "K", "bb", "EWR "), (2, 3, "K", None, "boro zone"),
    (3, 2, None, None, "other"), (None, 1, "B", "z", "ewr"),
]


def test_golden_records(spark, rows):
    claims = spark.createDataFrame(CLAIMS, "id int, priority int, borough string, zone string, service string")
    rules = {"borough": FieldRule("frequent"), "zone": FieldRule("longest"), "service": FieldRule("allowed", ("boro zone", "ewr"))}
    assert rows(survivorship.golden_records(claims, "id", "priority", rules)) == [
        (1, "B1", "long name", "boro zone", 3), (2, "K", "aa", "EWR ", 3), (3, None, None, None, 1),
    ]


def test_rejected_records(spark, rows):
    ref = spark.createDataFrame([(1, "a"), (2, "b")], "id int, zone string")
    got = spark.createDataFrame([(1, "a"), (9, "b"), (None, "a"), (5, "new")], "id int, zone string")
    assert rows(survivorship.rejected_records(got, "id", ref, ["zone"])) == [(None, "a", "missing_key"), (9, "b", "key_conflict")]


# -- lifecycle ------------------------------------------------------------------


def test_transitions(spark, rows):
    old = spark.createDataFrame([(1, "PROPOSED"), (2, "ACTIVE"), (3, "ACTIVE"), (4, "RETIRED"), (5, "DEPRECATED")], "id int, lifecycle_state string")
    new = spark.createDataFrame(
        [(1, "ACTIVE"), (2, "RETIRED"), (3, "ACTIVE"), (4, "ACTIVE"), (5, "RETIRED"), (6, "ACTIVE"), (7, "RETIRED")],
        "id int, lifecycle_state string",
    )
    assert rows(lifecycle.invalid_transitions(old, new, "id")) == [(2, "RETIRED", "ACTIVE"), (4, "ACTIVE", "RETIRED"), (7, "RETIRED", None)]


def test_approvals_and_overrides(spark, rows):
    changes = spark.createDataFrame(
        [(1, "dev", "schema_change"), (2, "prod", "attribute_change"), (3, "prod", "schema_change"), (4, "prod", "schema_change"),
         (5, "prod", "attribute_change"), (6, "prod", "attribute_change"), (7, "test", "attribute_change")],
        "change_id int, environment string, change_type string",
    )
    given = spark.createDataFrame(
        [(2, "data-steward"), (3, "data-steward"), (4, "data-owner"), (4, "data-owner"), (5, "guest")], "change_id int, approver_role string"
    )
    live = spark.createDataFrame([(5, "incident", "2024-02-01 00:00:00"), (6, "incident", "2024-04-01 00:00:00"), (6, "", "2024-04-01 00:00:00")],
                                 "change_id int, reason string, e string")
    live = live.select("change_id", "reason", F.col("e").cast("timestamp_ntz").alias("expires_at"))
    out = lifecycle.approval_decisions(changes, given, {"dev": 0, "prod": 1}, ["data-owner", "data-steward"], ["schema_change"], live, NOW)
    assert rows(out, "change_id", "decision") == [
        (1, "APPROVED"), (2, "APPROVED"), (3, "BLOCKED_OWNER"), (4, "APPROVED"), (5, "BLOCKED_APPROVALS"),
        (6, "OVERRIDDEN"), (7, "BLOCKED_APPROVALS"),
    ]


def test_duplicate_members_of_a_hot_group(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") < 1000, "hot").otherwise(F.col("id").cast("string")).alias("n"))
    found = matching.duplicate_members(df, "id", [F.col("n")])
    assert found.agg(F.count("*"), F.min("group_size"), F.max("first_id")).first()[:] == (1000, 1000, 0)


def test_twins_are_flagged_not_rejected(spark, rows):
    ref = spark.createDataFrame([(56, "Corona"), (57, "Corona"), (1, "a")], "id int, zone string")
    got = spark.createDataFrame([(56, "Corona"), (57, "Corona"), (9, "Corona"), (9, "Corona"), (2, "new")], "id int, zone string")
    assert rows(survivorship.rejected_records(got, "id", ref, ["zone"])) == [(9, "Corona", "key_conflict")] * 2
    assert rows(survivorship.steward_flags(ref, "id", ["zone"])) == [(56, "Corona", 2), (57, "Corona", 2)]


def test_a_new_key_given_twice_is_one_row(spark, rows):
    old = spark.createDataFrame([(1, "a")], "id int, v string")
    new = spark.createDataFrame([(2, "x"), (2, "y"), (1, "z"), (3, None)], "id int, v string")
    assert rows(upsert.insert_if_absent(old, new, ["id"])) == [(1, "a"), (2, "y"), (3, None)]
