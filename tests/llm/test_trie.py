"""The trie against a plain loop over all prefixes, with bands of a few depths."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from custodia.llm import catalog, trie
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(ts, key=lambda t: (t[0], t[1] or 0, t[2], t[3]))] for c, ts in turns.items()}
    whole = {}
    for c, ts in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        whole[c] = turns.get(c - (c % 100 if c >= 0 else -(-c % 100)), [])[:h] + ts[h:]
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(whole):
        for d in range(len(whole[c]) + 1):
            members[tuple(whole[c][:d])].append(c)
        ends[tuple(whole[c])].append(c)
    children = defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, cs in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(cs) - 1) * len(p[-1][1]) if p else 0
    return [
        (
            cs[0], len(p), members[p[:-1]][0] if p else None, len(cs), children[p], leaves[p], saved[p],
            hashlib.sha256(",".join(map(str, ends[p])).encode()).hexdigest(),
        )
        for p, cs in members.items()
    ]


def built(spark, rows, height, schema=SCHEMA):
    df = spark.createDataFrame(rows, schema) if not hasattr(rows, "columns") else rows
    found = trie.conversations(df, lambda c: c - c % 100, lambda c: F.crc32(c.cast("string")) % 6, height=height)
    return [tuple(r) for r in found.collect()]


def same(a, b):
    assert sorted(a, key=str) == sorted(b, key=str)


def talk(seed, n):
    """Conversations over a few texts, so that many beginnings are shared; ties, nulls, repeats and absent beginnings."""
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        c = rng.choice([rng.randrange(-120, 420), rng.randrange(100, 110), 300])
        for t in range(rng.randrange(9)):
            rows.append((c, rng.choice([t, t, t, None, 3]), rng.choice(["user", "user", None, ""]), rng.choice(["a", "bb", "é\U0001f600", "", None])))
    return rows + rows[:5] + [(None, 1, "user", "lost")]


@pytest.mark.parametrize("height", [1, 3, 32])
def test_equals_loop(spark, height):
    rows = talk(height, 60)
    same(built(spark, rows, height), plain(rows))


def test_long_conversation_crosses_bands_blocks_and_ranges(spark, monkeypatch):
    monkeypatch.setattr(trie, "BLOCK", 8)
    rows = [(100, t, "user", f"t{t % 7}") for t in range(150)] + [(101, t, "user", f"t{t % 7}") for t in range(90)]
    rows += [(7, 0, "user", "x"), (1000, 0, "a", "y")]
    same(built(spark, rows, 4), plain(rows))


def test_many_copies_and_pieces_of_ids(spark, monkeypatch):
    monkeypatch.setattr(trie, "PIECE", 20)
    rows = [(c, 0, "user", "hello") for c in range(5, 400)]
    same(built(spark, rows, 32), plain(rows))


def test_empty_table_and_clashing_columns(spark):
    assert built(spark, [], 32) == []
    rows = talk(9, 10)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("1 AS conv", "2 AS x", "conv_id", "turn AS TURN_", "turn", "role", "text", "3 AS Conv_ID_", "4 AS depth")
    same(built(spark, df, 2), plain(rows))


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    same([tuple(r) for r in catalog.op12_trie(spark, SF).collect()], plain(rows))
