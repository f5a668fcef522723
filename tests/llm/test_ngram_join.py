"""Components against all pairs compared in plain Python."""

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from custodia.llm import catalog, ngram_join
from custodia.llm import components as components_module
from custodia.llm.components import components
from custodia.session import work_dir


def plain(rows):
    made = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        made.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    up = list(range(len(rows)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    lists = {}
    for k, s in enumerate(made):
        for z in s:
            lists.setdefault(z, []).append(k)
    for k, s in enumerate(made):
        for j, both in Counter(j for z in s for j in lists[z] if j > k and rows[j][0] is not None).items():
            if rows[k][0] is not None and 100 * both >= 80 * (len(s) + len(made[j]) - both):
                up[top(k)] = top(j)
    least = {}
    for k, (doc, _) in enumerate(rows):
        if doc is not None:
            least[top(k)] = min(least.get(top(k), doc), doc)
    return sorted(((doc, len(made[k]), None if doc is None else least[top(k)]) for k, (doc, _) in enumerate(rows)), key=str)


def joined(spark, rows):
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, n int, name string")
    return sorted((tuple(r) for r in ngram_join.join(docs).collect()), key=str)


def words(rng, n, kinds=4000):
    return [f"W{rng.randrange(kinds)}" for _ in range(n)]


def near_copies(seed):
    """Groups of edited copies, chains that drift, sets at the threshold, a passage that many share, repeated ids."""
    rng, texts = random.Random(seed), []
    for size in (2, 3, 40, 150):
        base = words(rng, rng.randrange(40, 160))
        for _ in range(size):
            copy = list(base)
            for _ in range(rng.randrange(0, 5)):
                copy[rng.randrange(len(copy))] = f"e{rng.randrange(10**6)}"
            texts.append(" ".join(copy))
    drift = words(rng, 120)
    for _ in range(40):
        drift = drift[3:] + words(rng, 3)
        texts.append("\t".join(drift))
    for n in (14, 24, 49, 104):  # n - 4 shingles, of which a fifth, and one more, is changed at the end
        base, fifth = words(rng, n), (n - 4) // 9
        texts += [" ".join(base), " ".join(base[: n - fifth] + words(rng, fifth)), " ".join(base[: n - fifth - 1] + words(rng, fifth + 1))]
    passage = words(rng, 60)
    texts += [" ".join(words(rng, rng.randrange(5, 200)) + passage + words(rng, rng.randrange(5, 60))) for _ in range(60)]
    texts += ["a b", "A B", "a b c d", "a b c d e", "", " \n", None, None, "a " * 30, "a " * 3000, "b\x1c c\xa0d"]
    rng.shuffle(texts)
    rows = [(k * 3 % 997, t) for k, t in enumerate(texts)]
    return rows + rows[:5] + [(rows[0][0], "another text on a used id here"), (None, rows[3][1]), (None, None), (None, rows[3][1])]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_all_pairs(spark, seed):
    rows = near_copies(seed)
    assert joined(spark, rows) == plain(rows)


def test_equals_all_pairs_without_leaders_or_frequent_list(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "HASHES_PER_KEY", 12)
    monkeypatch.setattr(ngram_join, "ROUNDS", 0)
    monkeypatch.setattr(ngram_join, "LIST_LENGTH", 3)
    monkeypatch.setattr(ngram_join, "MEMBERS_PER_TASK", 3)
    rows = near_copies(3)
    assert joined(spark, rows) == plain(rows)


def test_empty_tables(spark):
    assert joined(spark, []) == []
    assert joined(spark, [(1, None), (2, ""), (None, "a b c d e f")]) == plain([(1, None), (2, ""), (None, "a b c d e f")])


def test_representatives_of_ids_on_several_texts(spark):
    copy, own = "a b c d e f g", "of its own this one is"
    rows = [(1, copy), (2, copy), (2, own), (2, own), (3, "A b c d e f g"), (4, None), (None, copy), (5, own), (2, "")]
    out = ngram_join.representatives(spark.createDataFrame(rows, "doc_id long, text string"))
    want = [(1, copy), (2, own), (4, None), (None, copy), (2, "")]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(want, key=str)


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(k, k + 1) for k in range(1000, 1060)] + [(5, 5)] + [(2000, k) for k in range(2001, 2300)]
    up = {x: x for e in edges for x in e if e[0] != e[1]}
    for _ in range(100):
        for a, b in edges:
            if a != b:
                up[a] = up[b] = min(up[a], up[b])
    found = components(spark.createDataFrame(edges, "a long, b long"), work_dir(spark, "components")).collect()
    assert sorted(map(tuple, found)) == sorted(up.items())


def test_shingles_of_rows_do_not_mix():
    texts = ["a b c d e f", None, "f a", "b c d e f a b c d e", "x", ""]
    whole = ngram_join.sets(pa.array(texts))
    for k, text in enumerate(texts):
        value, first = ngram_join.sets(pa.array([text], pa.string()))
        assert value.tolist() == whole[0][whole[1][k] : whole[1][k + 1]].tolist() and first.tolist() == [0, len(value)]
    assert [len(np.unique(x)) for x in np.split(whole[0], whole[1][1:-1])] == [2, 0, 1, 6, 1, 0]


def test_query_equals_its_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    assert sorted(map(tuple, catalog.op9_ngram_join(spark, sf).collect())) == sorted(con.sql(catalog.OP9_SQL).fetchall())


def test_parities_never_rule_out_a_link(spark):
    """Sets of sizes around the steps of the lists' lengths: similar ones stay possible, far ones of any size do not."""
    rng = np.random.default_rng(4)
    rows, sets_of = [], {}
    for k, n in enumerate((1, 500, 511, 512, 513, 640, 1023, 1024, 1025, 1280, 5000, 6000, 20_000)):
        base = rng.integers(0, 2**63, n).astype(np.uint64)
        for j, keep in enumerate((1.0, 0.9, 0.82, 0.5)):
            own = np.unique(np.concatenate([base[: int(n * keep)], rng.integers(0, 2**63, int(n * 0.02)).astype(np.uint64)]))
            if len(own):
                sets_of[100 * k + j] = own
    value = np.concatenate(list(sets_of.values()))
    first = np.append(0, np.cumsum([len(v) for v in sets_of.values()]))
    lists = ngram_join.parities(value, first).to_pylist()
    rows = [(name, len(v), p) for (name, v), p in zip(sets_of.items(), lists, strict=True)]
    one = spark.createDataFrame(rows, "name long, n long, parity array<long>")
    pairs = spark.createDataFrame([(a, b) for a in sets_of for b in sets_of if a > b], "a long, b long")
    got = {(r.a, r.b): r.possible for r in ngram_join.possible(pairs, one).collect()}
    far = 0
    for (a, b), possible in got.items():
        both = len(np.intersect1d(sets_of[a], sets_of[b]))
        union = len(sets_of[a]) + len(sets_of[b]) - both
        if 100 * both >= 80 * union:
            assert possible
        elif 100 * both < 60 * union and min(len(sets_of[a]), len(sets_of[b])) > 400:
            far += 1
            assert not possible
    assert far > 100


def test_members_of_undecided_clusters_are_not_all_paired(spark, monkeypatch):
    """A large group of near copies and sets just out of its reach: pairs stay in proportion to the sets."""
    rng = random.Random(5)
    base, texts = words(rng, 150, 10**6), []
    for edits, size in ((range(0, 4), 400), (range(3, 7), 80)):
        for _ in range(size):
            copy = list(base)
            for place in rng.sample(range(5, 145, 6), rng.choice(edits)):
                copy[place] = f"e{rng.randrange(10**6)}"
            texts.append(" ".join(copy))
    rng.shuffle(texts)
    rows, met, possible = list(enumerate(texts)), [], ngram_join.possible
    monkeypatch.setattr(ngram_join, "possible", lambda pairs, one: met.append(pairs.count()) or possible(pairs, one))
    assert joined(spark, rows) == plain(rows)
    assert max(met) <= 8 * len(rows)


def test_components_that_are_stars_need_no_round(spark, monkeypatch):
    steps = []
    monkeypatch.setattr(components_module, "stored", lambda df, path, keep=components_module.stored: steps.append(path) or keep(df, path))
    stars = [(k, 1) for k in range(2, 40)] + [(50, 45), (45, 45)]
    found = components(spark.createDataFrame(stars, "a long, b long"), work_dir(spark, "components")).collect()
    assert sorted(map(tuple, found)) == [(1, 1), *((k, 1) for k in range(2, 40)), (45, 45), (50, 45)]
    assert len(steps) == 1
