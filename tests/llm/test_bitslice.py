"""Ranked search against a plain loop over all documents; bounds and skipped documents of one block."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from custodia.llm import bitslice, catalog

SF = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(docs, items, top):
    """(item_id, rank, doc_id, score) of (id, text) rows."""
    counts = [(d, Counter(terms(t))) for d, t in docs]
    counts = [(d, c, sum(c.values())) for d, c in counts if c]
    n_docs, n_words = len(counts), sum(n for _, _, n in counts)
    held = Counter(t for _, c, _ in counts for t in c)
    out = []
    for item, text in set(items):
        wanted = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held[t] + 1))) for t in set(terms(text)) if held[t]}
        scored = []
        for d, c, n in counts:
            m = 100 - 50 + 50 * n * n_docs // n_words
            score = sum(w * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t, w in wanted.items() if c[t])
            if score > 0:
                scored.append((-score, d is not None, d or 0, d))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=str)


def prose(seed, n, words):
    rng = random.Random(seed)
    usual = [f"w{k}" for k in range(30)] + ["Ünder", "ünder", "été", "東京", "A1"]
    rows = []
    for d in range(n):
        some = [rng.choice(usual) if rng.random() < 0.7 else f"rare{rng.randrange(400)}" for _ in range(rng.randrange(words))]
        rows.append((d, rng.choice([" ", ", ", "\n", "\x00", "_"]).join(some)))
    return rows


DOCS = prose(1, 300, 60) + [
    (None, "w1 w2 rare7"), (None, None), (5, None), (6, ""), (7, " .,-"), (900, "w3 w3 w3"), (901, "w3 w3 w3"), (900, "w3 w3 w3"), (900, "rare8 w3"),
    (902, "w4 " * 5000 + "rare9"), (903, " ".join(f"long{k}" for k in range(20_000)) + " rare9"),
]
ITEMS = [(1, "w1 W2 rare7 rare7"), (2, "rare8"), (3, None), (4, ""), (5, "never"), (6, "w3"), (7, " ".join(t for _, t in prose(2, 5, 60))), (7, "été 東京"), (1, "w1 W2 rare7 rare7"), (8, "rare9 w4 long77"), (None, "ünder Ünder a1")]


def found(spark, docs, items, **more):
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("1 AS term", "2 AS DOC_ID_", "doc_id", "text", "3 AS kind")
    i = spark.createDataFrame(items, "item_id long, text string").selectExpr("text", "4 AS h", "item_id", "5 AS Text_")
    return sorted((tuple(r) for r in bitslice.search(d.repartition(3), i, **more).collect()), key=str)


@pytest.mark.parametrize("top", [1, 4, 50])
def test_equals_loop(spark, top):
    assert found(spark, DOCS, ITEMS, top=top, documents=64) == plain(DOCS, ITEMS, top)


def test_items_in_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(bitslice, "QUERY_TERMS", 8)
    assert found(spark, DOCS, ITEMS, top=5) == plain(DOCS, ITEMS, 5)


def test_empty_tables(spark):
    assert found(spark, [], ITEMS) == []
    assert found(spark, DOCS[:20], []) == []


def test_bounds_hold_and_skip_documents():
    docs = prose(4, 512, 200)
    counts = [Counter(x.encode() for x in terms(t)) for _, t in docs]
    sizes = np.array([max(1, sum(c.values())) for c in counts])
    width = 8192
    block = bitslice._Open(width, 512)
    for k, c in enumerate(counts):
        pairs = [(t, x) for t, n in c.items() for x in bitslice.levels(n)]
        keys, level = bitslice.hashes([t for t, _ in pairs]), np.array([x for _, x in pairs], np.uint64)
        block.add(k, int(sizes[k]), b" ".join(t for t, n in c.items() for _ in range(n)), keys, level)
    row = block.batch()
    slices = np.frombuffer(row.column(6)[0].as_buffer(), np.uint8)
    rows = [(i, t.encode(), 1 + len(t)) for i in range(20) for t in sorted(set(terms(docs[i][1])))]
    queries = bitslice.Queries.of(rows, len(docs), int(sizes.sum()))
    bound = queries.bounds(slices, width, sizes)
    exact = np.array([[queries.score(i, c, m) for c, m in zip(counts, queries.damping(sizes).tolist(), strict=True)] for i in range(queries.items)])
    assert (bound >= exact).all() and (bound.sum() < 1.5 * exact.sum())
    best, scored = bitslice.scan([(width, list(range(512)), sizes, slices, [b" ".join(t for t, n in c.items() for _ in range(n)) for c in counts])], queries, 5)
    assert scored < 0.1 * exact.size
    for i, heap in enumerate(best.heaps):
        assert sorted(s for s, _, _ in heap) == sorted(sorted(x for x in exact[i].tolist() if x)[-5:])


def test_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    assert sorted((tuple(r) for r in catalog.op11_bitslice(spark, SF).collect()), key=str) == plain(docs, items, 50)
