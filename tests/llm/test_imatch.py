"""Frequencies, neighbours and edits against plain Python; what fingerprints are worth by their likeness."""

import hashlib
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from custodia.llm import catalog, imatch


def edits(rows):
    rows = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    out = []
    for k, (doc, text) in enumerate(rows):
        after, q = rows[(k + 1) % len(rows)][1], len(text) // 4
        edited = text[: len(text) - q] + after[:q]
        out.append((doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), text, edited, after))
    return out


def test_order_and_edits(spark, monkeypatch):
    monkeypatch.setattr(imatch, "BUCKET_DOCUMENTS", 7)
    rows = [(k * 13 % 101 - 20, f"text {k} é\U0001f600 " * (k % 11) + "end of it") for k in range(100)]
    rows += [(None, "no id"), (None, "nor this one"), (5, None), (5, "five again"), (5, "five again"), (900, ""), (-20, "a tie at the start")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, fingerprint string")
    out = imatch.stability(docs).collect()
    assert sorted(map(str, [tuple(r)[:3] for r in out])) == sorted(map(str, [r[:3] for r in edits(rows)]))
    prints = {}
    for r in out:
        prints.setdefault(r.fingerprint, r)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert (r.fingerprint == r.edited_fingerprint) <= (r.near_edited == 1.0)


def test_equal_texts(spark):
    docs = spark.createDataFrame([(1, "same words in both of them"), (2, "same words in both of them"), (3, ""), (4, None)], "doc_id long, text string")
    rows = sorted(imatch.stability(docs).collect())
    assert rows[0].fingerprint == rows[1].fingerprint and rows[0].near_next == 1.0
    assert rows[2].fingerprint == rows[3].fingerprint == "0" * imatch.SUBSETS * imatch.DIGITS and rows[2].near_next == 1.0
    assert rows[1].near_next == 0.0
    one = imatch.stability(docs.limit(1)).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    assert imatch.stability(docs.where("doc_id > 9")).count() == 0


def test_lexicon_equals_counts(spark, monkeypatch):
    monkeypatch.setattr(imatch, "HELD_TERMS", 50)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    counts = Counter()
    for r in docs.collect():
        counts.update(set(re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), r.text or ""))))
    n = docs.count()
    want = sum(0.02 * n <= k <= 0.2 * n for k in counts.values())
    found = imatch.lexicon(docs, n, (0.02, 0.2))
    assert len(found) == want
    words = pa.array([" ".join(w for w, k in counts.items() if 0.02 * n <= k <= 0.2 * n)])
    assert imatch.terms(words)[0].tolist() == found.tolist()


def test_subsets_and_form():
    masks = imatch.subset_masks(np.arange(1, 200_001, dtype=np.uint64))
    for k in (1, 5, 6, 20, 60):
        rate = 2.0 ** -(1 + (k - 1) // imatch.EACH)
        assert abs(float(((masks >> np.uint64(k)) & np.uint64(1)).mean()) / rate - 1) < 0.25
    printer = imatch.Printer(np.zeros(0, np.uint64))
    a, b = printer.prints(pa.array(["some words here", "here some words words"]))
    assert (a == b).all() and len(imatch.text_form(a[None])[0]) == imatch.SUBSETS * imatch.DIGITS


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    want = {r[0]: r for r in edits(rows)}
    out = catalog.op5_imatch(spark, sf).collect()
    assert len(out) == len(rows) and all((r.n_chars, r.edited_sha256) == want[r.doc_id][1:3] for r in out)
    by_text = {}
    for r in out:
        assert by_text.setdefault(want[r.doc_id][3], r.fingerprint) == r.fingerprint
    edited, after = np.array([r.near_edited for r in out]), np.array([r.near_next for r in out])
    other = np.array([want[r.doc_id][3] != want[r.doc_id][5] for r in out])
    assert edited.mean() > 0.5 and after[other].mean() < 0.15 and (edited > after)[other].mean() > 0.95
