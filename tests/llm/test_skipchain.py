"""Base spans against plain regular expressions, message passing against sums over all labellings."""

import hashlib
import itertools
import random
import re
import time

import numpy as np
import pytest
from custodia.llm import catalog, skipchain

SF = "/root/testdata/sf0.001"
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_luhn(digits):
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        total += d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def plain(text):
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    for kind, pattern in ((2, CARD), (3, PHONE)):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m.group())
            if (12 <= len(digits) <= 19 and plain_luhn(digits)) if kind == 2 else 9 <= len(digits) <= 15:
                out.append((m.start(), kind, m.end()))
    return sorted(out)


HARD = [
    "", "@", "a@b", "a@b.c", "x@@y.z", "a@b.c@d.e.f", "%@-.-", "a@b.c.@d.e", "1.2.3.4.5.6.7.8.9", "256.1.1.1.1.1", "0001.02.3.255", "1.2.3", "١٢٣٤",
    "4111 1111 1111 1111", "4111-1111-1111-1111 4111111111111111", "+1 (2) 3-4.5 678 90", "+12", "++49 30 1234567", "+1 5555555555 +1 5555555555",
    "\U0001f600 mail é+x@ü.de a@x.de", "+1 (208) 555-1177 4284896609045836",
]


def test_base_spans_equal_plain_patterns():
    rng = random.Random(3)
    texts = HARD + ["".join(rng.choices("ab.@-+_% ()0123459é\n", k=rng.randrange(60))) for _ in range(4000)]
    texts += ["".join(rng.choices("0123456789 -.", k=rng.randrange(80))) for _ in range(3000)]
    for text in texts:
        assert skipchain.base_spans(text) == plain(text), text


@pytest.mark.parametrize("unit", ["a", "1", "1.", "@", "a@", "+1 ", "+", "1-", "-", "("])
def test_long_texts_take_linear_time(unit):
    text = unit * (300_000 // len(unit))
    start = time.perf_counter()
    skipchain.base_spans(text)
    skipchain.tokens_of(text)
    assert time.perf_counter() - start < 5


def field(seed):
    rng = np.random.default_rng(seed)
    known = np.ones(skipchain.LABELS, bool)
    return skipchain.Field(
        rng.normal(size=(skipchain.FEATURES, skipchain.LABELS)), rng.normal(size=(skipchain.LABELS,) * 2), rng.uniform(0.1, 2, skipchain.LABELS), known
    )


def every_labelling(f, forms, chain, skips):
    """Marginals by summing over all labellings."""
    local = skipchain._rows(forms) @ f.local
    out = np.zeros((len(forms), skipchain.LABELS))
    for y in itertools.product(range(skipchain.LABELS), repeat=len(forms)):
        score = sum(local[i, k] for i, k in enumerate(y))
        for i, k in enumerate(y):
            score += f.step[k, y[i + 1]] if chain[i] else f.step[k, skipchain.OTHER]
            score += 0 if i and chain[i - 1] else f.step[skipchain.OTHER, k]
        score += sum(f.skip[y[a]] for a, b in skips if y[a] == y[b])
        out[range(len(y)), y] += np.exp(score)
    return out / out.sum(1, keepdims=True)


@pytest.mark.parametrize("seed", range(4))
def test_messages_equal_sums_over_labellings(seed):
    """Exact on chains joined by one skip edge; close where skip and chain edges make a cycle."""
    forms = np.array([skipchain.form(t) for t in ("+1", "(2)", "1.2.3.4", "a@b.c", "77")])
    tree = np.array([True, False, True, False, False]), np.array([[1, 4]])
    f = field(seed)
    np.testing.assert_allclose(f.marginals(forms, *tree, turns=200), every_labelling(f, forms, *tree), atol=1e-3)
    cycle = np.array([True, True, True, True, False]), np.array([[0, 4]])
    f.skip *= 0.3
    np.testing.assert_allclose(f.marginals(forms, *cycle, turns=200), every_labelling(f, forms, *cycle), atol=0.1)


def test_repeats_share_their_label():
    """A token that is unsure by itself follows the sure copies elsewhere in the document."""
    graph = skipchain.Graph.of("call 555-1177 or +1 (208) 555-1177 and, again, 555-1177 now")
    assert [graph.spans[a][2] for a, _ in graph.skips] == ["555-1177"] * 2
    f = field(1)
    f.local[:], f.step[:] = 0, 0
    f.local[0] = [0, 0, 0, -0.5, 0]
    f.local[3] = [0, 0, 0, 6, 0]
    f.step[3, 3], f.skip[:] = 4, 2
    linked = f.marginals(graph.forms, graph.chain, graph.skips)
    alone = f.marginals(graph.forms, graph.chain, graph.skips[:0])
    assert linked[0, 3] > alone[0, 3] + 0.2 and linked[-1, 3] > alone[-1, 3] + 0.2


ROWS = [
    (1, "+1 (208) 555-1177 is home, 4284896609045836 pays"), (2, None), (3, ""), (None, "mail x@y.org"), (4, "+1 (208) 555-1177 4284896609045836"),
    (4, "+1 (208) 555-1177 4284896609045836"), (5, "nothing here"), (6, "7 " * 50_000 + "1.2.3.4"),
] + [(100 + k, f"text +1 (2{k:02}) 555-11{k:02} end") for k in range(40)] + [(200 + k, f"from {k}.2.3.4 to") for k in range(40)]


def test_adjoining_numbers_are_added_and_base_stays(spark):
    cards = [(300 + d, f"card 4284896609045{d:03} end") for d in range(1000) if plain_luhn(f"4284896609045{d:03}")]
    df = spark.createDataFrame(ROWS + cards * 3, "DOC_ID long, text string").selectExpr("DOC_ID", "text", "1 AS kind", "2 AS doc_Id", "3 AS spans")
    found = skipchain.label(df, skipchain.fit(df)).collect()
    assert len(found) == len(ROWS) + 3 * len(cards)
    for row in found:
        assert [(s.start, skipchain.KINDS.index(s.kind), s.end) for s in row.base] == plain(row.text or "")
        assert [(s.kind, s.start, s.end) for s in row.spans if not s.added] == [(s.kind, s.start, s.end) for s in row.base]
        if row.text in (None, "", "nothing here"):
            assert row.spans == []
    hard = [row.spans for row in found if row.text == ROWS[4][1]]
    assert len(hard) == 2 and all([(s.kind, s.start, s.end) for s in h] == [("phone", 0, 17), ("card", 18, 34)] for h in hard)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert skipchain.label(empty, skipchain.fit(empty)).count() == 0


def test_query(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = catalog.op13_skipchain(spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        base = [f"{skipchain.KINDS[k]}:{s}:{e}" for s, k, e in plain(docs[r.doc_id])]
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(b.startswith(k) for b in base) for k in skipchain.KINDS]
        assert set(base) <= set(r.spans.split(",")) | {""}
