from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from custodia.operators import constraints, scd2
from custodia.operators.scd2 import Scd2
from custodia.sources import VersionedTable
from custodia.streaming import apply_changes_stream, event_stream

ZONE = Scd2("location_id", ("borough", "zone", "service_zone"), "zone")
HASHED = replace(ZONE, by_hash=True)
SCHEMA = "location_id int, borough string, zone string, service_zone string"
T0, T1, T2 = "2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-03-01 00:00:00"

BASE = [(1, "A", "a", "s"), (2, "B", None, "s"), (3, "C", "c", None), (4, "D", "d", "s"), (5, "E", None, "x"), (6, "F", "f", "s")]
CHANGE = [
    (1, "A", "a", "s"),     # unchanged
    (2, "B", "b", "s"),     # NULL -> value
    (3, "C", None, None),   # value -> NULL
    (4, "D", "d2", "s"),    # changed
    (5, "E", "x", None),    # values shifted across a NULL
    (7, "G", "g", "s"),     # new key; 6 is absent
]


def base(spark, layout=ZONE):
    return layout.initial_load(spark.createDataFrame(BASE, SCHEMA), T0, "loader")


def stage(spark, rows_=CHANGE):
    return spark.createDataFrame(rows_, SCHEMA)


@pytest.mark.parametrize("layout", [ZONE, HASHED])
def test_apply(spark, rows, layout):
    out = layout.apply(base(spark, layout), stage(spark), T1, "me", "why", "src").cache()
    assert rows(out.filter("is_current"), "location_id", "version_number", "zone") == [
        (1, 1, "a"), (2, 2, "b"), (3, 2, None), (4, 2, "d2"), (5, 2, "x"), (6, 1, "f"), (7, 1, "g"),
    ]
    old = out.filter("NOT is_current")
    assert rows(old, "location_id") == [(2,), (3,), (4,), (5,)]
    assert old.filter(f"effective_to <> TIMESTAMP_NTZ'{T1}'").count() == 0
    new = out.filter("location_id = 4 AND is_current").first()
    assert (new["change_reason"], new["change_source"], new["approval_status"], new["created_by"]) == ("why", "src", "PENDING", "me")
    assert constraints.several_current(out, ["location_id"]).count() == 0
    assert constraints.version_gaps(out, ["location_id"]).count() == 0


def test_applying_twice_changes_nothing(spark, rows):
    once = ZONE.apply(base(spark), stage(spark), T1)
    assert rows(ZONE.apply(once, stage(spark), T2)) == rows(once)
    assert ZONE.apply_audit(once, stage(spark), T2).count() == 0


def test_stage_reason_beats_default(spark):
    s = stage(spark, [(4, "D", "d9", "s")]).withColumn("change_reason", F.lit("steward fix"))
    row = ZONE.apply(base(spark), s, T1, None, "default").filter("location_id = 4 AND is_current").first()
    assert (row["change_reason"], row["created_by"]) == ("steward fix", "system")


def test_duplicate_stage_keys_are_reported(spark, rows):
    s = stage(spark, [(1, "A", "x", "s"), (1, "A", "y", "s"), (2, "B", "b", "s")])
    assert rows(scd2.unapplied(s, ["location_id"])) == [(1, 2)]


def test_approve(spark, rows):
    asked = spark.createDataFrame([(1, "boss", "ok"), (99, "boss", "ok")], "location_id int, approver string, reason string")
    dim = ZONE.apply(base(spark), stage(spark, [(1, "A", "a2", "s")]), T1, "me", "kept reason")
    out = ZONE.approve(dim, asked, T2)
    assert out.count() == dim.count()
    row = out.filter("location_id = 1 AND is_current").first()
    assert (row["approval_status"], row["approved_by"], row["change_reason"]) == ("APPROVED", "boss", "kept reason")
    # the expired version is not touched
    assert out.filter("location_id = 1 AND NOT is_current").first()["approval_status"] == "PENDING"
    assert rows(ZONE.approve_errors(dim, asked)) == [(99, "no_current_version")]
    assert ZONE.approve_audit(dim, asked, T2).count() == 1


def test_rollback_keeps_history_and_can_change_again(spark, rows):
    dim = ZONE.apply(base(spark), stage(spark), T1)
    asked = spark.createDataFrame(
        [(4, 1, "boss", "bad"), (4 + 90, 1, "boss", "bad"), (1, 7, "boss", "bad")],
        "location_id int, target_version int, actor string, reason string",
    )
    out = ZONE.rollback(dim, asked, T2)
    assert out.count() == dim.count() + 1
    assert rows(out.filter("location_id = 4"), "version_number", "zone", "is_current", "is_rollback", "rollback_from_version") == [
        (1, "d", False, False, None), (2, "d2", False, False, None), (3, "d", True, True, 1),
    ]
    assert rows(ZONE.rollback_errors(dim, asked)) == [(1, 7, "no_target_version"), (94, 1, "no_current_version")]
    again = ZONE.apply(out, stage(spark, [(4, "D", "d4", "s")]), "2024-04-01 00:00:00")
    assert rows(again.filter("location_id = 4 AND is_current"), "version_number", "zone") == [(4, "d4")]
    assert constraints.version_gaps(again, ["location_id"]).count() == 0


def test_history_interval_is_closed(spark, rows):
    dim = ZONE.apply(base(spark), stage(spark), T1)
    asked = spark.createDataFrame([(4, T1, T1), (1, "2023-01-01 00:00:00", "2023-12-31 00:00:00")], "location_id int, f string, t string")
    asked = asked.select("location_id", F.col("f").cast("timestamp_ntz").alias("range_from"), F.col("t").cast("timestamp_ntz").alias("range_to"))
    assert rows(ZONE.history(dim, asked), "location_id", "version_number") == [(4, 1), (4, 2)]


def test_expire(spark, rows):
    out = scd2.expire(base(spark), spark.createDataFrame([(1,), (1,)], "location_id int"), "location_id", T1)
    assert out.count() == len(BASE)
    assert rows(out.filter("NOT is_current"), "location_id") == [(1,)]


def test_changes_from_a_stream(spark, rows, tmp_path):
    table = VersionedTable(spark, f"{tmp_path}/zones")
    table.create(base(spark), T0)
    incoming = spark.createDataFrame(
        [(4, "D", "first", "s", T1), (4, "D", "last", "s", T2), (8, "H", "h", "s", T1)], SCHEMA + ", at string"
    ).withColumn("loaded_at", F.col("at").cast("timestamp_ntz")).drop("at")
    incoming.write.parquet(f"{tmp_path}/in")
    stream = event_stream(spark, f"{tmp_path}/in", incoming.schema)
    apply_changes_stream(stream, table, ZONE, lambda batch: T2, f"{tmp_path}/cp", "stream")
    assert rows(table.read().filter("is_current AND version_number > 1 OR location_id = 8"), "location_id", "zone", "version_number") == [
        (4, "last", 2), (8, "h", 1),
    ]
    assert table.read(0).count() == len(BASE)
