"""Links and components against all cosines of a label."""

import numpy as np
import pyarrow as pa
import pytest
from custodia.llm import catalog, nndescent


def plain(rows):
    ok = []
    for k, (_, vector, label) in enumerate(rows):
        v = np.array(vector, float) if vector and None not in vector and label is not None else np.zeros(1)
        if np.isfinite(v).all() and (v != 0).any():
            ok.append((k, label, v / np.abs(v).max()))
    near = {k: set() for k in range(len(rows))}
    for label, size in {(label, len(v)) for _, label, v in ok}:
        own = [(k, v / np.linalg.norm(v)) for k, x, v in ok if x == label and len(v) == size]
        x = np.stack([v for _, v in own])
        for i, j in zip(*np.nonzero(x @ x.T >= 0.93), strict=True):
            if i != j:
                near[own[i][0]].add(own[j][0])
    out = []
    for k, (vec, _, _) in enumerate(rows):
        seen, todo = {k}, [k]
        while todo:
            for j in near[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        least = min(ids) if ids else None
        out.append((vec, len(near[k]), least, vec is not None and vec == least))
    return sorted(out, key=str)


def linked(spark, rows):
    vectors = spark.createDataFrame([(*r, 1, 2.0) for r in rows], "vec_id long, embedding array<double>, label int, node int, UNIT double")
    return sorted((tuple(r) for r in nndescent.link(vectors).collect()), key=str)


def groups(seed):
    rng = np.random.default_rng(seed)
    rows = []
    for label, sizes in ((1, [1] * 150 + [2] * 30 + [60]), (2, [3] * 10 + [300])):
        for size in sizes:
            centre = rng.standard_normal(16)
            for _ in range(size):
                rows.append((len(rows) * 7 % 1009, (centre + 0.16 * rng.standard_normal(16)).tolist(), label))
    copy = rows[5][1]
    rows += [(2000 + k, copy, 1) for k in range(40)] + [(3000, copy, 2), (3001, copy, None), (3002, None, 1), (3003, [0.0] * 16, 1)]
    rows += [(3004, [float("nan")] * 16, 1), (3005, [None] * 16, 1), (3006, [], 1), (3007, [float("inf")] + [1.0] * 15, 1), (None, copy, 1)]
    rows += [(3008, [2 * x for x in copy], 1), (3009, copy[:8], 1), (3008, copy, 1), (3010, [1e200 * x for x in copy], 1), (3011, [-x for x in copy], 1)]
    return rows


def test_equals_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(nndescent, "CELL", 32)
    monkeypatch.setattr(nndescent, "BLOCK", 50)
    rows = groups(1)
    got, want = linked(spark, rows), plain(rows)
    assert len(got) == len(want)
    assert sum(g == w for g, w in zip(got, want, strict=True)) / len(want) >= 0.99


def turned(rng, angle, n, size=16):
    """``n`` distinct vectors close to one at ``angle`` degrees from the first axis."""
    centre = np.zeros(size)
    centre[:2] = np.cos(np.radians(angle)), np.sin(np.radians(angle))
    return [(centre + 0.008 * rng.standard_normal(size)).tolist() for _ in range(n)]


def test_links_between_groups_larger_than_lists(spark, monkeypatch):
    rng = np.random.default_rng(3)
    # groups in a row, each with links to the next only; one apart; a label of its own
    vectors = [(v, 1) for angle, n in ((0, 30), (20, 40), (40, 25), (90, 30), (160, 20), (180, 20)) for v in turned(rng, angle, n)]
    vectors += [(v, 2) for v in turned(rng, 20, 30)]
    rows = [(k, v, label) for k, (v, label) in enumerate(vectors)]
    want = plain(rows)
    assert len({w[2] for w in want}) == 4
    monkeypatch.setattr(nndescent, "BLOCK", 16)
    assert linked(spark, rows) == want


def test_odd_tables(spark):
    assert linked(spark, []) == []
    rows = [(1, None, 1), (2, [0.0, 0.0], 1), (3, [1.0, 0.0], None)]
    assert linked(spark, rows) == plain(rows)
    rows = [(9, [1.0, 0.1], 4), (4, [1.0, 0.1], 4), (7, [0.1, 1.0], 4)]
    assert linked(spark, rows) == plain(rows)


def test_audit_counts_lost_links(spark):
    rows = [(k, [1.0, 0.001 * k], 1) for k in range(20)]
    nodes = nndescent.nodes_of(spark.createDataFrame(rows, "vec_id long, vector array<double>, label string").select("vec_id", "label", "vector"))
    none = spark.createDataFrame([], "node long, root long")
    assert nndescent.audit(nodes, none) == 0.0
    assert nndescent.audit(nodes, nodes.selectExpr("node", "1L AS root")) == 1.0


def test_audit_counts_lost_pairs_beside_a_large_group(spark):
    rng = np.random.default_rng(5)
    vectors = turned(rng, 0, 300) + [v for c in rng.standard_normal((100, 16)) for v in ((10 * c).tolist(), (10 * c + 0.1).tolist())]
    rows = [(k, v, "1") for k, v in enumerate(vectors)]
    nodes = nndescent.nodes_of(spark.createDataFrame(rows, "vec_id long, vector array<double>, label string").select("vec_id", "label", "vector"))
    assert nndescent.audit(nodes, nodes.where("vec_id < 300").selectExpr("node", "1L AS root")) < 0.1


def test_failed_audit_is_not_accepted(spark, monkeypatch):
    monkeypatch.setattr(nndescent, "audit", lambda nodes, roots: 0.5)
    monkeypatch.setattr(nndescent, "TURNS", 1, raising=False)
    with pytest.raises(RuntimeError, match="0.5"):
        linked(spark, [(1, [1.0, 0.1], 4), (2, [1.0, 0.2], 4)])


def test_far_neighbours_stay_in_lists():
    table = pa.table({"node": pa.array([1, 2], pa.int64()), "unit": [np.array([1.0, 0.0]).tobytes(), np.array([0.0, 1.0]).tobytes()]})
    assert [b.num_rows for b in nndescent.best(table)] == [2]


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    got, want = sorted(map(tuple, catalog.op6_nndescent(spark, sf).collect()), key=str), plain(rows)
    links = sum(w[1] for w in want)
    assert len(got) == len(want) and sum(min(g[1], w[1]) for g, w in zip(got, want, strict=True)) == pytest.approx(links, rel=0.02)
    assert all(g[1] <= w[1] for g, w in zip(got, want, strict=True))
