"""Groups of merges: chains, earlier merges, names and versions against a plain union-find."""

import random

import pytest
from pyspark.sql import functions as F

from custodia.operators import merging
from custodia.operators.components import connected
from custodia.plans import vendor_dedup_job
from custodia.session import ts, work_dir

NOW = "2024-03-01 00:00:00"
QUEUE = "review_id long, left_vendor_id int, right_vendor_id int, confidence double, recommendation string, status string"


def queue(spark, rows):
    empty = {c: F.lit(None).cast(t) for c, t in (("reviewed_at", "timestamp_ntz"), ("reviewed_by", "string"), ("decision_notes", "string"))}
    return spark.createDataFrame(rows, QUEUE).withColumns(empty)


def vendors(spark, names):
    df = spark.createDataFrame(names, "vendor_id int, vendor_name string")
    return df.withColumns({
        "version": F.lit(1), "updated_at": ts("2024-01-01 00:00:00"), "updated_by": F.lit("x"),
        "approved_at": F.lit(None).cast("timestamp_ntz"), "approved_by": F.lit(None).cast("string"),
    })


def states(spark, ids):
    return vendors(spark, [(i, "") for i in ids]).selectExpr(
        "vendor_id", "'ACTIVE' AS lifecycle_state", "CAST(NULL AS STRING) AS state_reason", "updated_at", "updated_by", "approved_at", "approved_by"
    )


def roots_of(pairs):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


@pytest.mark.parametrize("seed", range(3))
def test_components_equal_union_find(spark, seed):
    rng = random.Random(seed)
    pairs = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)]
    pairs += [(1000 + k, 1001 + k) for k in range(60)] + [(2000, 2001 + k) for k in range(300)] + [(5, 5)] * 2 + pairs[:9]
    df = spark.createDataFrame([*pairs, (None, 7), (8, None)], "a long, b long")
    found = {r["node"]: r["root"] for r in connected(df, "a", "b", work_dir(spark)).collect()}
    want = roots_of([(a, b) for a, b in pairs if a != b])
    assert found == want


def test_no_pairs(spark):
    assert connected(spark.createDataFrame([], "a long, b long"), "a", "b", work_dir(spark)).count() == 0


def test_three_vendors_end_at_the_smallest(spark, tmp_path):
    """4 and 7 are equal, 3 is similar to their name, which 4 stands for: 3 survives, both others name it."""
    names = [(3, "VeriFone Incs"), (4, "Verifone Inc"), (7, "VeriFone Inc."), (9, "Other")]
    out = vendor_dedup_job(vendors(spark, names), states(spark, [3, 4, 7, 9]), "vendor_id", "vendor_name", NOW, str(tmp_path))
    queued = {(r[0], r[1]) for r in spark.read.parquet(f"{tmp_path}/queue").select("left_vendor_id", "right_vendor_id").collect()}
    assert queued == {(3, 4), (4, 7)}
    life = {r["vendor_id"]: (r["lifecycle_state"], r["state_reason"]) for r in out["lifecycle"].collect()}
    assert life[3][0] == life[9][0] == "ACTIVE"
    assert all(life[k][0] == "DEPRECATED" and "vendor_id=3 " in life[k][1] for k in (4, 7))
    master = {r["vendor_id"]: (r["vendor_name"], r["version"]) for r in out["master"].collect()}
    # the longest name of all three; the survivor's own wins a tie
    assert master == {3: ("VeriFone Incs", 3), 4: ("Verifone Inc", 1), 7: ("VeriFone Inc.", 1), 9: ("Other", 1)}
    notes = {(r["left_vendor_id"], r["right_vendor_id"]): r["decision_notes"] for r in out["queue"].collect()}
    assert notes == {(3, 4): "Survivor=3, Deprecated=4", (4, 7): "Survivor=3, Deprecated=4, 7"}
    assert [r[0] for r in out["chained"].collect()] == [4]


def test_earlier_merges_count_for_later_runs(spark):
    """3 was merged into 2, 6 into 5; now 3-9 and 2-6 arrive: 2 survives them all, and 6 and 5 are pointed at 2."""
    q = queue(spark, [
        (1, 2, 3, 0.99, "AUTO_MERGE", "MERGED"), (2, 5, 6, 0.98, "AUTO_MERGE", "MERGED"), (3, 3, 9, 0.97, "AUTO_MERGE", "OPEN"),
        (4, 6, 2, 0.96, "AUTO_MERGE", "OPEN"), (5, 8, 9, 0.90, "AUTO_MERGE", "OPEN"), (6, 11, 12, 0.99, "AUTO_MERGE", "MERGED"),
    ])
    m = merging.AutoMerge(q, NOW)
    master = {r["vendor_id"]: (r["vendor_name"], r["version"]) for r in m.master(vendors(spark, [(k, "n" * k) for k in (2, 3, 5, 6, 8, 9, 11, 12)]), "vendor_name").collect()}
    # 5 and 9 are newly retired into 2; 6 was retired before and brings no name of its own
    assert master[2] == ("n" * 9, 3) and all(v == 1 for k, (_, v) in master.items() if k != 2)
    life = {r["vendor_id"]: r["state_reason"] for r in m.lifecycle(states(spark, [2, 3, 5, 6, 8, 9, 11, 12])).collect()}
    assert {k for k, why in life.items() if why} == {5, 6, 9}
    assert life[9] == "Auto-merged into vendor_id=2 (conf=0.97)" and life[6] == "Auto-merged into vendor_id=2 (conf=0.96)" and life[5] == "Auto-merged into vendor_id=2"
    closed = {r["review_id"]: (r["status"], r["decision_notes"]) for r in m.merged_queue().collect()}
    assert closed[3] == ("MERGED", "Survivor=2, Deprecated=3, 9") and closed[4] == ("MERGED", "Survivor=2, Deprecated=6")
    assert closed[5][0] == "OPEN" and closed[1] == ("MERGED", None)


@pytest.mark.parametrize("seed", range(2))
def test_every_retired_id_names_a_living_survivor(spark, seed):
    rng = random.Random(seed)
    pairs = {tuple(rng.sample(range(60), 2)) for _ in range(45)}
    rows = [(k, a, b, rng.choice([0.95, 0.96, 0.99]), "AUTO_MERGE", "OPEN") for k, (a, b) in enumerate(sorted(pairs))]
    names = [(k, "x" * rng.randrange(1, 30)) for k in range(60)]
    m = merging.AutoMerge(queue(spark, rows), NOW)
    root = roots_of(pairs)
    life = {r["vendor_id"]: r for r in m.lifecycle(states(spark, range(60))).collect()}
    master = {r["vendor_id"]: r for r in m.master(vendors(spark, names), "vendor_name").collect()}
    for k in range(60):
        if root.get(k, k) == k:
            members = [x for x, r in root.items() if r == k and x != k]
            assert life[k]["lifecycle_state"] == "ACTIVE"
            assert master[k]["version"] == 1 + len(members)
            assert len(master[k]["vendor_name"]) == max(len(names[x][1]) for x in [k, *members])
        else:
            assert f"vendor_id={root[k]} " in life[k]["state_reason"] and life[root[k]]["lifecycle_state"] == "ACTIVE"


def test_pairwise_keeps_the_order_free_rule(spark):
    q = queue(spark, [(1, 1, 2, 0.99, "AUTO_MERGE", "OPEN"), (2, 2, 3, 0.97, "AUTO_MERGE", "OPEN")])
    m = merging.AutoMerge(q, NOW, closure=False)
    why = {r["vendor_id"]: r["state_reason"] for r in m.lifecycle(states(spark, [1, 2, 3])).collect()}
    assert why == {1: None, 2: "Auto-merged into vendor_id=1 (conf=0.99)", 3: "Auto-merged into vendor_id=2 (conf=0.97)"}
    assert [r[0] for r in m.chained().collect()] == [2]
