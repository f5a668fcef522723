"""Targets against a loop that reshares, draws against their invariants and exact probabilities."""

import re
from math import comb

import pytest
from custodia.llm import catalog, mixing
from pyspark.sql import functions as F


def reshared(words):
    """Targets by resharing the excess by weight until no source is above twice its size."""
    names = sorted(words, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    left, open_, out = 1.5 * sum(words.values()), set(names), {}
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        full = {s for s in open_ if share[s] > 2 * words[s] + 1e-9}
        if not full:
            return out | share
        out |= {s: 2.0 * words[s] for s in full}
        left -= sum(out[s] for s in full)
        open_ -= full
    return out


def check(spark, rows, **options):
    docs = spark.createDataFrame([(*r, 1, "z") for r in rows], "doc_id long, text string, source string, size int, target string")
    got = [r.asDict() for r in mixing.mix(docs, **options).collect()]
    assert len(got) == len(rows)
    words, most, have = {}, {}, {}
    for _, text, source in rows:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
        words[source] = words.get(source, 0) + n
        most[source] = max(most.get(source, 0), n)
    want = reshared(words)
    for r in got:
        assert len(r["draws"]) <= 2 and r["source_size"] == words[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
        have[r["source"]] = have.get(r["source"], 0) + r["size"] * len(r["draws"])
    assert sum(r["size"] for r in got) == sum(words.values())
    for source, n in have.items():
        assert abs(n - want[source]) <= most[source] / 2 + 1e-6
    return got


def test_targets_and_draws(spark):
    rows = [(k, "w " * (k * 37 % 61), f"s{min(k % 9, 4)}") for k in range(700)]
    rows += [(1, None, None), (None, "a b\tc\x0bd", None), (None, None, "empty"), (3, "", "empty"), (5, "x y \x1c", "é"), (5, "x y \x1c", "é")]
    got = check(spark, rows, block_documents=8, shard_words=500)
    sizes = {}
    for r in got:
        for d in r["draws"]:
            sizes[d["shard"]] = sizes.get(d["shard"], 0) + r["size"]
    assert len(sizes) > 16 and max(sizes.values()) < 4 * sum(sizes.values()) / len(sizes)
    again = check(spark, rows[::-1], block_documents=8, shard_words=500)
    assert sorted(map(str, got)) == sorted(map(str, again))
    check(spark, rows)


def test_degenerate_tables(spark):
    assert check(spark, []) == []
    check(spark, [(1, "a b c", "only")])
    check(spark, [(1, None, None), (2, "", "a")])


def test_hypergeometric_law(spark):
    one = mixing.hypergeometric(F.lit(50), F.lit(20), F.lit(25), mixing.uniform(F.lit(1), F.col("id")))
    seen = {r.k: r.n for r in spark.range(20000).select(one.alias("k")).groupBy("k").agg(F.count("*").alias("n")).collect()}
    for k in range(21):
        mean = 20000 * comb(20, k) * comb(30, 25 - k) / comb(50, 25)
        assert abs(seen.get(k, 0) - mean) <= 5 * mean**0.5 + 3
    edges = [(0, 0, 0, 0), (1, 0, 1, 0), (1, 1, 1, 1), (10, 10, 4, 4), (10, 4, 10, 4)]
    for total, good, draws, want in edges:
        assert spark.range(1).select(mixing.hypergeometric(F.lit(total), F.lit(good), F.lit(draws), F.lit(0.5)).alias("k")).first().k == want


def test_halves_are_exact(spark):
    nodes = spark.createDataFrame([([3, 5, 9], 0, [7, 0, 1001])], "numbers array<int>, shard long, counts array<long>")
    left, right = (r.counts for r in mixing.split(nodes, 0, 4).orderBy("shard").collect())
    assert sum(left) == 504 and [a + b for a, b in zip(left, right, strict=True)] == [7, 0, 1001]


def test_query(spark):
    out = catalog.op10_mixing(spark, "/root/testdata/sf0.001").collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert {r.doc_id: r.size for r in out} == {k: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for k, t in texts.items()}
    assert all(r.taken in (0, r.size, 2 * r.size) for r in out)
