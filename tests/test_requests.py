"""Ordered folding, key registry, as-of and interval joins, incremental aggregates: against plain loops."""

import glob
import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from custodia.operators import constraints, merging, quality
from custodia.operators.incremental import DailyState, signed
from custodia.operators.intervals import overlap_join
from custodia.operators.keys import KeyRegistry
from custodia.operators.ordered import Ordered, as_of_join
from custodia.operators.scd2 import VERSION_COLUMNS, Scd2
from custodia.operators.star import keyed
from custodia.session import ts, work_dir

NOW = "2024-03-01 00:00:00"
ZONE = Scd2("k", ("a", "b"), "zone")


def empty_dim(spark):
    return spark.createDataFrame([], "k int, a string, b string, " + ", ".join(f"{n} {t}" for n, t in VERSION_COLUMNS))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# -- ordered values --------------------------------------------------------------


@pytest.mark.parametrize("seed", range(2))
def test_running_values_of_a_hot_key(spark, seed):
    """Most rows have one key, so it lies in several ranges; NULL keys are a key of their own."""
    rng = random.Random(seed)
    rows = [(rng.choice([1, 1, 1, 1, 2, 3, None]), i, rng.choice([None, rng.randrange(50)])) for i in range(600)]
    rng.shuffle(rows)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else few rows are one range
    try:
        o = Ordered(spark.createDataFrame(rows, "k int, i int, v int"), ["k"], ["i"], work_dir(spark))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert o.rows.where("k = 1").select("_range").distinct().count() > 1
    out = o.last("up_to", F.col("v")).last("before", F.col("v"), inclusive=False).total("n", F.lit(1)).total("sum", F.col("v"), inclusive=False).plain()
    state = {}
    want = []
    for k, i, v in sorted(rows, key=lambda r: r[1]):
        last, n, total = state.get(k, (None, 0, 0))
        now = last if v is None else v
        want.append((k, i, v, now, last, n + 1, total))
        state[k] = (now, n + 1, total + (v or 0))
    assert sorted(map(tuple, out.collect()), key=str) == sorted(want, key=str)


def test_next_row_of_a_hot_key(spark):
    rng = random.Random(5)
    rows = [(rng.choice([1, 1, 1, 1, 2, 3, None]), i) for i in range(600)]
    rng.shuffle(rows)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else few rows are one range
    try:
        o = Ordered(spark.createDataFrame(rows, "k int, i int"), ["k"], ["i"], work_dir(spark))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert o.rows.where("k = 1").select("_range").distinct().count() > 1
    out = o.next("after", F.struct("i")).plain().select("k", "i", "after.i").collect()
    behind = {}
    want = []
    for k, i in sorted(rows, key=lambda r: -r[1]):
        want.append((k, i, behind.get(k)))
        behind[k] = i
    assert sorted(map(tuple, out), key=str) == sorted(want, key=str)


def test_fold_broadcasts_no_table_that_grows(spark):
    """Steps and changed keys are small here, and yet they are not broadcast; nor are steps joined with themselves."""
    stage = spark.createDataFrame([(k, f"a{n}", "b", None, None, None, n) for k in range(20) for n in range(3)], "k int, a string, b string, change_reason string, change_source string, change_batch_id string, turn int")
    steps = ZONE.steps(empty_dim(spark), stage, ["turn"], NOW)
    assert "Join" not in plan_of(steps)
    plan = plan_of(ZONE.fold(empty_dim(spark), stage, ["turn"], NOW, steps=steps))
    assert "BroadcastExchange" not in plan
    assert steps.where("_more").count() == 40


# -- several requests per key -------------------------------------------------------


def test_repeated_stage_key_without_order_is_left_out(spark, rows):
    stage = spark.createDataFrame([(1, "x", None), (1, "y", None), (2, "z", None), (2, "z", None), (3, "u", "v")], "k int, a string, b string")
    new = ZONE.apply(empty_dim(spark), stage, NOW)
    assert rows(new, "k", "version_number", "is_current") == [(2, 1, True), (3, 1, True)]
    assert rows(ZONE.stage_errors(stage), "k", "rows", "error") == [(1, 2, "repeated_key")]
    assert constraints.several_current(new, ["k"]).count() == 0


@pytest.mark.parametrize("by_hash", [False, True])
def test_fold_equals_one_by_one(spark, by_hash):
    layout = Scd2("k", ("a", "b"), "zone", by_hash)
    rng = random.Random(5)
    dim = layout.apply(empty_dim(spark), spark.createDataFrame([(k, "s", None) for k in range(6)], "k int, a string, b string"), "2024-01-01 00:00:00")
    stage = [(rng.choice([1, 1, 1, 4, 7, 8]), rng.choice(["s", "t", None]), rng.choice([None, "u"]), i, datetime(2024, 2, 1) + timedelta(hours=i // 2)) for i in range(120)]
    df = spark.createDataFrame(stage, "k int, a string, b string, seq int, at timestamp_ntz").repartition(5)
    out = layout.fold(dim, df, ["at", "seq"], NOW, at="at").orderBy("k", "version_number").collect()
    want, state = {}, {k: ("s", None) for k in range(6)}
    for k in range(6):
        want[k] = [("s", None)]
    for k, a, b, _, _ in stage:
        if state.get(k, "none") != (a, b):
            want.setdefault(k, []).append((a, b))
            state[k] = (a, b)
    got = {}
    for r in out:
        got.setdefault(r["k"], []).append((r["a"], r["b"]))
    assert got == want
    for k in got:
        mine = [r for r in out if r["k"] == k]
        assert [r["version_number"] for r in mine] == list(range(1, len(mine) + 1))
        assert [r["is_current"] for r in mine] == [False] * (len(mine) - 1) + [True]
        assert all(x["effective_to"] == y["effective_from"] for x, y in zip(mine, mine[1:], strict=False)) and mine[-1]["effective_to"] is None
    table = spark.createDataFrame(out, dim.schema)
    assert constraints.several_current(table, ["k"]).count() == 0 and constraints.version_gaps(table, ["k"]).count() == 0


def test_repeated_approvals_rollbacks_and_decisions(spark, rows):
    one = spark.createDataFrame([(1, "x", None), (2, "y", None)], "k int, a string, b string")
    dim = ZONE.apply(empty_dim(spark), one, "2024-01-01 00:00:00")
    dim = ZONE.apply(dim, spark.createDataFrame([(1, "z", None)], "k int, a string, b string"), "2024-02-01 00:00:00")
    asked = spark.createDataFrame([(1, "ann", None, 1), (1, "bob", "why", 2), (1, "cid", "later", 3), (9, "ann", None, 1)], "k int, approver string, reason string, seq int")
    assert ZONE.approve(dim, asked, NOW).count() == 3
    assert rows(ZONE.approve_errors(dim, asked), "k", "error") == [(1, "repeated_key"), (9, "no_current_version")]
    folded = ZONE.approve(dim, asked, NOW, order=["seq"])
    assert rows(folded.where("is_current"), "k", "approved_by", "change_reason") == [(1, "cid", "why"), (2, None, None)]
    assert ZONE.approve_audit(dim, asked, NOW, order=["seq"]).count() == 3
    back = spark.createDataFrame([(1, 1, "ann", "r", 1), (1, 2, "ann", "r", 2), (1, 7, "ann", "r", 3), (2, 1, "ann", "r", 1)], "k int, target_version int, actor string, reason string, seq int")
    plain = ZONE.rollback(dim, back, NOW)
    assert rows(plain.where("is_current"), "k", "version_number") == [(1, 2), (2, 2)]
    assert rows(ZONE.rollback_errors(dim, back), "k", "error") == [(1, "repeated_key")]
    done = ZONE.rollback(dim, back, NOW, order=["seq"])
    assert rows(done, "k", "version_number", "a", "is_current") == [
        (1, 1, "x", False), (1, 2, "z", False), (1, 3, "x", False), (1, 4, "z", True), (2, 1, "y", False), (2, 2, "y", True),
    ]
    assert rows(ZONE.rollback_errors(dim, back, order=["seq"]), "k", "target_version", "error") == [(1, 7, "no_target_version")]
    assert ZONE.rollback_audit(dim, back, NOW, order=["seq"]).count() == 3
    queue = spark.createDataFrame([(1, "OPEN"), (2, "OPEN"), (3, "MERGED")], "review_id long, status string").withColumns(
        {"reviewed_at": ts(NOW), "reviewed_by": F.lit(None).cast("string"), "decision_notes": F.lit(None).cast("string")}
    )
    said = spark.createDataFrame([(1, "APPROVED", "a", "n", 2), (1, "REJECTED", "b", "n", 1), (2, "APPROVED", "a", "n", 1), (3, "REJECTED", "a", "n", 1)], "review_id long, decision string, reviewer string, notes string, seq int")
    assert rows(merging.decide(queue, said, NOW), "review_id", "status") == [(1, "OPEN"), (2, "APPROVED"), (3, "MERGED")]
    assert rows(merging.decision_errors(said), "review_id") == [(1,)]
    assert rows(merging.decide(queue, said, NOW, order=["seq"]), "review_id", "status") == [(1, "REJECTED"), (2, "APPROVED"), (3, "MERGED")]


# -- keys --------------------------------------------------------------------------


def test_registry_never_gives_a_key_twice(spark):
    reg = KeyRegistry(spark, work_dir(spark, "registry"), {"nk": "long"}, "sk")
    owners, given = {}, {}
    for build, members in enumerate([range(0, 300), range(50, 250), range(100, 500), range(0, 20), range(0, 500)], 1):
        df = spark.range(members.start, members.stop).toDF("nk")
        got = dict(map(tuple, reg.register(df.unionAll(df.limit(3)), build).select("nk", "sk").distinct().collect()))
        assert set(got) == set(members)
        for nk, sk in got.items():
            assert given.setdefault(nk, sk) == sk and owners.setdefault(sk, nk) == nk
    assert reg.members().where("present").count() == 500
    before = reg.log().count()
    reg.register(spark.range(500).toDF("nk"), 6)
    assert reg.log().count() == before


def test_dimension_keeps_members_that_are_gone(spark, rows):
    first = spark.createDataFrame([(1, "a"), (2, "b")], "nk long, name string")
    reg = KeyRegistry(spark, work_dir(spark, "registry"), {"nk": "long"}, "sk")
    one = keyed(first, "nk", "sk", registry=reg, build=1)
    two = keyed(spark.createDataFrame([(2, "B"), (3, "c")], "nk long, name string"), "nk", "sk", one, reg, 2)
    assert rows(two, "nk", "name") == [(1, "a"), (2, "B"), (3, "c")]
    assert two.select("sk").distinct().count() == 3 and two.join(one, ["nk", "sk"]).count() == 2
    assert keyed(spark.createDataFrame([(2, "B")], "nk long, name string"), "nk", "sk", one).count() == 2


# -- times --------------------------------------------------------------------------


@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_as_of_equals_loop_and_has_no_range_join(spark, coalesce):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    rng = random.Random(2)
    day = lambda n: datetime(2024, 1, 1) + timedelta(days=n)
    versions = []
    for k in (1, 2, 3):
        starts = sorted(rng.sample(range(100), 12))
        for a, b in zip(starts, [*starts[1:], None], strict=True):
            versions.append((k, day(a), day(b if b and rng.random() < 0.8 else a + 2) if b else None, f"{k}-{a}"))
    events = [(rng.choice([1, 1, 1, 1, 1, 2, 4, None]), rng.choice([day(rng.randrange(-5, 120)), None]), i) for i in range(500)] + [(1, day(50), -1)] * 2
    e = spark.createDataFrame(events, "k int, at timestamp_ntz, id int").repartition(4)
    v = spark.createDataFrame(versions, "vk int, a timestamp_ntz, b timestamp_ntz, name string")
    out = as_of_join(e, v, ("k", "vk"), ("at", "a"), "b", ["name"], work_dir(spark, "asof"))
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = []
    for k, at, i in events:
        name = None
        if k is not None and at is not None:
            known = [x for x in versions if x[0] == k and x[1] <= at]
            if known and (known[-1][2] is None or at < known[-1][2]):
                name = known[-1][3]
        want.append((k, at, i, name))
    assert sorted(map(tuple, out.collect()), key=str) == sorted(want, key=str)
    assert "NestedLoop" not in plan_of(out) and "Cartesian" not in plan_of(out)


@pytest.mark.parametrize("finest", [0, 3, 6])
def test_interval_join_equals_loop(spark, finest):
    rng = random.Random(finest)

    def some(n):
        out = []
        for i in range(n):
            a = rng.choice([rng.randrange(-200, 2000), 77, None])
            out.append((i, a, rng.choice([None, -500]) if rng.random() < 0.1 else (a or 0) + rng.choice([0, 0, 1, 5, 40, 900, 100_000])))
        return out

    left, right = some(150), some(120)
    pairs = overlap_join(spark.createDataFrame(left, "i int, a long, b long"), spark.createDataFrame(right, "j int, c long, d long"), ("a", "b"), ("c", "d"), finest)

    def over(x, y):
        top = lambda e: 10**12 if e is None else e
        return None not in (x[1], y[1]) and x[1] <= top(x[2]) and y[1] <= top(y[2]) and x[1] <= top(y[2]) and y[1] <= top(x[2])

    assert sorted((p["l"]["i"], p["r"]["j"]) for p in pairs.collect()) == sorted((x[0], y[0]) for x in left for y in right if over(x, y))
    assert "NestedLoop" not in plan_of(pairs) and "Cartesian" not in plan_of(pairs)


@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_interval_totals_equal_grouped_pairs_without_pairs(spark, coalesce):
    rng = random.Random(7)

    def some(n):
        out = []
        for i in range(n):
            a = rng.choice([rng.randrange(-200, 2000), 77, None])
            out.append((rng.choice([None, i % 40]), a, rng.choice([None, -500]) if rng.random() < 0.1 else (a or 0) + rng.choice([0, 0, 1, 5, 40, 900, 100_000]), rng.choice([None, 2 * i - 90])))
        return out

    left = spark.createDataFrame(some(300), "i int, a long, b long, v int")
    right = spark.createDataFrame([*some(200), (99, 10**9, 10**9 - 1, 1), (98, -(10**9), -(10**9), 1)], "j int, c long, d long, w int")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    try:
        got = overlap_join(left, right, ("a", "b"), ("c", "d"), by=["j"], totals={"n": F.lit(1), "v": F.col("v"), "odd": F.when(F.col("i") == 3, F.col("v"))})
        found = got.collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    pairs = overlap_join(left, right, ("a", "b"), ("c", "d"))
    want = pairs.groupBy("r.j").agg(F.count("*"), F.sum("l.v"), F.sum(F.when(F.col("l.i") == 3, F.col("l.v")))).collect()
    assert sorted(map(tuple, found), key=str) == sorted(map(tuple, want), key=str)
    assert "[at" not in plan_of(got) and "NestedLoop" not in plan_of(got)


def test_interval_join_of_empty_tables(spark):
    none = spark.createDataFrame([], "i int, a timestamp_ntz, b timestamp_ntz")
    assert overlap_join(none, none, ("a", "b"), ("a", "b")).count() == 0
    assert overlap_join(none, none, ("a", "b"), ("a", "b"), by=["i"], totals={"n": F.lit(1)}).count() == 0


# -- incremental aggregates ----------------------------------------------------------


def test_changes_equal_a_full_recompute_and_touch_their_months_only(spark):
    rng = random.Random(8)
    schema = "id long, at timestamp_ntz, k int, amount decimal(12,2)"

    def trip(i):
        return (i, datetime(2024, rng.randrange(1, 7), rng.randrange(1, 28)), rng.choice([1, 1, 1, 2, None]), rng.choice([None, Decimal(rng.randrange(1000)) / 4]))

    rows = {i: trip(i) for i in range(400)}
    amount = {"revenue": F.coalesce("amount", F.lit(0))}
    path = work_dir(spark, "state")
    state = DailyState(spark, path, "at", "k", amount)
    state.build(spark.createDataFrame(list(rows.values()), schema))
    for turn in range(3):
        files = {f for f in glob.glob(f"{path}/month=*/*.parquet")}
        month = turn + 2
        gone = [r for r in rows.values() if r[1].month == month and (turn == 1 or rng.random() < 0.5)]
        fresh = [trip(1000 * (turn + 1) + i) for i in range(40)]
        fresh = [(i, at.replace(month=month + 1), k, a) for i, at, k, a in fresh]
        changes = signed(spark.createDataFrame(fresh, schema), spark.createDataFrame(gone, schema))
        for r in gone:
            del rows[r[0]]
        rows.update({r[0]: r for r in fresh})
        assert state.apply(changes) == [f"2024-{month:02}", f"2024-{month + 1:02}"]
        kept = {f for f in files if f"month=2024-{month:02}" not in f and f"month=2024-{month + 1:02}" not in f}
        assert kept <= set(glob.glob(f"{path}/month=*/*.parquet"))
        other = DailyState(spark, work_dir(spark, "full"), "at", "k", amount)
        other.build(spark.createDataFrame(list(rows.values()), schema))
        found, want = (sorted(map(tuple, s.read().select("trip_date", "k", "trip_count", "revenue").collect()), key=str) for s in (state, other))
        assert found == want
    plan = plan_of(state.touched(["2024-03"]))
    assert "PartitionFilters: [" in plan and "2024-03" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert len(state.touched(["2024-03"]).inputFiles()) >= 1


# -- rules -----------------------------------------------------------------------------


def test_partial_counts_grow_with_the_sum_of_the_key_domains(spark, tmp_path):
    (tmp_path / "zones.csv").write_text('"LocationID","Zone"\n"1","a"\n"2","b"\n"N/A","c"\n')
    df = spark.range(4000).selectExpr("CAST(id % 50 AS INT) AS p", "CAST(id % 41 AS INT) AS d", "CASE WHEN id % 7 > 0 THEN id END AS v")
    spec = [
        {"name": "v", "type": "numeric_range", "column": "v", "min": 5}, {"name": "n", "type": "not_null", "column": "v"},
        *[{"name": c, "type": "fk_membership", "column": c, "lookup_csv": "zones.csv", "lookup_key": "LocationID", "severity": "high"} for c in ("p", "d")],
    ]
    rules = quality.rules_from_spec(spec, spark=spark, folder=str(tmp_path))
    assert quality.partial_counts(df, rules).count() == 50 + 41 + 1
    found = {r["check_name"]: (r["row_count"], r["bad_count"]) for r in quality.quality_report(df, rules).collect()}
    outside = lambda c: df.where(f"{c} NOT IN (1, 2)").count()
    assert found == {"v": (4000, df.where("coalesce(v, 0) < 5").count()), "n": (4000, 572), "p": (4000, outside("p")), "d": (4000, outside("d"))}
    assert quality.quality_report(df.limit(0), rules).select("row_count", "bad_count").distinct().collect()[0][:] == (0, 0)


def test_log_keeps_runs_and_replaces_an_attempt(spark, tmp_path, rows):
    df = spark.range(5)
    for run, limit in (("run 1", 3), ("run/2", 9), ("run 1", 9)):
        results = quality.zero_row_conditions(df, {"small": (F.col("id") >= limit, "id")}, run, NOW)
        assert quality.log_tests(results, str(tmp_path / "log"), run).count() == 1
    assert rows(quality.test_log(spark, str(tmp_path / "log")), "run_id", "status") == [("run 1", "PASS"), ("run/2", "PASS")]
