"""Personal data by a skip-chain conditional random field.

Four patterns give base spans. They miss data whose form is cut by its
neighbourhood (a phone number right before a card number is one run of digits).
The field labels tokens instead: a token is a maximal run of the characters of
addresses and numbers that holds a digit or ``@``; every other token is OTHER by
definition, so it cuts the chain and needs no message.

* Local potentials score the form of a token.
* Chain potentials join tokens with only white space between them; ends of a
  run are joined with OTHER.
* Skip potentials join a token with the next one of the same text, and of the
  same last digits, however far away in the document. Each token meets at most
  the occurrence before and behind it, so k copies have k - 1 edges.

All potentials are learned together by pseudo-likelihood from the base spans of a
bounded sample of whole documents (about ``SAMPLE_DOCUMENTS`` of the documents with
a token, chosen by the hash of the text); an example counts once a document, so
that no long table outweighs the rest. Loopy belief propagation runs over all
tokens of a document. Tokens that are not OTHER with ``least`` probability and
have the form of their kind become added spans; base spans always stay.

Nulls: a null text is empty and has no spans. Repeated rows are each given
their spans. Columns ``base`` and ``spans`` of the input are replaced, all others
are kept.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from custodia.llm import kernels as K
from custodia.llm.common import annotate, pick

KINDS = ("email", "ip", "card", "phone")
OTHER = len(KINDS)
LABELS = len(KINDS) + 1
SAMPLE_DOCUMENTS = 5_000
LEAST = 0.8
TURNS = 30
#: Log potential of a shared label before any repeated token is seen.
SKIP_PRIOR = 1.0
#: Characters of the same digits that make two tokens similar.
SAME_DIGITS = 7
#: Tokens of one message-passing batch; the tokens of a document stay together.
BATCH_TOKENS = 20_000

# Fixed patterns of the base spans.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_HINT = re.compile(r"[0-9@]")
_TOKEN = re.compile(r"(?<![0-9A-Za-z@._%+()\-])[A-Za-z._%+()\-]*+[0-9@][0-9A-Za-z@._%+()\-]*+")
_EDGE = "._%-"
_NOT_DIGIT = re.compile(r"[^0-9]+")
_ADDRESS = re.compile(r"[^@]+@[^@.]+(\.[^@.]+)+")
_QUAD = re.compile(r"[0-9]{1,3}(\.[0-9]{1,3}){3}")
_LETTER = re.compile(r"[A-Za-z]")


def luhn(digits: str) -> bool:
    """The check sum of card numbers."""
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the patterns' matches, leftmost and non-overlapping per kind, by start and kind.

    An address is sought around each ``@`` and a quad only from the start of a run
    of digits: both give what a search from the left gives, in linear time.
    """
    out = []
    if not _HINT.search(text):
        return out
    done = at = 0
    while (at := text.find("@", at)) >= 0:
        begin = at
        while begin > done and _LOCAL.match(text[begin - 1]):
            begin -= 1
        found = _DOMAIN.match(text, at + 1) if begin < at else None
        if found:
            done = found.end()
            out.append((begin, 0, done))
        at = max(at + 1, done)
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m.group())
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def tokens_of(text: str) -> list[tuple[int, int, str]]:
    """(start, end, text) of the tokens that may be personal data."""
    if not _HINT.search(text):
        return []
    out = []
    for m in _TOKEN.finditer(text):
        token = m.group()
        left = len(token) - len(token.lstrip(_EDGE + ")"))
        token = token.strip(_EDGE).lstrip(_EDGE + ")").rstrip(_EDGE + "(+")
        if token:
            out.append((m.start() + left, m.start() + left + len(token), token))
    return out


#: Upper ends of the classes of digit counts.
_DIGIT_CLASSES = (0, 2, 3, 6, 8, 9, 11, 15, 16, 19)


def form(token: str) -> int:
    """The local features of a token as bits; the first is always set."""
    digits = _NOT_DIGIT.sub("", token)
    letters = bool(_LETTER.search(token))
    dots, hyphens = token.count("."), token.count("-")
    n = len(digits)
    bits = [
        True,
        bool(_ADDRESS.fullmatch(token)),
        "@" in token,
        token[0] == "+",
        token[0] == "(",
        token[-1] == ")",
        n == len(token),
        letters,
        letters and n > 0,
        dots == 1, dots == 2, dots == 3, dots > 3,
        hyphens == 1, hyphens > 1,
        bool(_QUAD.fullmatch(token)) and all(int(p) <= 255 for p in token.split(".")),
        12 <= n <= 19 and not letters and luhn(digits),
        "_" in token or "%" in token,
        *[low < n <= high for low, high in zip((-1, *_DIGIT_CLASSES), (*_DIGIT_CLASSES, 1 << 60), strict=False)],
    ]
    return sum(1 << k for k, bit in enumerate(bits) if bit)


FEATURES = 18 + len(_DIGIT_CLASSES) + 1


def _rows(forms: np.ndarray) -> np.ndarray:
    return ((forms[:, None] >> np.arange(FEATURES)) & 1).astype(np.float64)


@dataclass
class Graph:
    """Tokens of documents with their edges: ``chain`` marks a token joined with the one behind it."""

    spans: list[tuple[int, int, str]]
    forms: np.ndarray
    chain: np.ndarray
    skips: np.ndarray

    @staticmethod
    def of(text: str) -> Graph:
        found = tokens_of(text)
        chain = [b[0] - a[1] <= 2 and text[a[1] : b[0]].isspace() for a, b in zip(found, found[1:], strict=False)] + [False] * bool(found)
        last, skips = {}, set()
        for k, (_, _, token) in enumerate(found):
            digits = _NOT_DIGIT.sub("", token)
            keys = [token.lower()] if len(token) > 2 else []
            if len(digits) >= SAME_DIGITS:
                keys.append(("digits", digits[-SAME_DIGITS:]))
            for key in keys:
                if key in last:
                    skips.add((last[key], k))
                last[key] = k
        return Graph(
            found, np.array([form(t) for _, _, t in found], np.int64), np.array(chain, bool), np.array(sorted(skips), np.int64).reshape(-1, 2)
        )

    def labels(self, base: list[tuple[int, int, int]]) -> np.ndarray:
        """The kind of the first base span that meets each token, else OTHER."""
        out, k = np.full(len(self.spans), OTHER), 0
        ordered = sorted(base)
        reach = np.maximum.accumulate([e for _, _, e in ordered]) if ordered else []
        for i, (start, end, _) in enumerate(self.spans):
            while k < len(ordered) and reach[k] <= start:
                k += 1
            for a, kind, b in ordered[k:]:
                if a >= end:
                    break
                if b > start:
                    out[i] = kind
                    break
        return out


def examples(text: str) -> Iterator[tuple[int, ...]]:
    """(form, label, label before, label behind, skip neighbours of each label) of each token."""
    graph = Graph.of(text)
    if not graph.spans:
        return
    y = graph.labels(base_spans(text))
    left, right = np.full(len(y), OTHER), np.full(len(y), OTHER)
    joined = np.flatnonzero(graph.chain)
    left[joined + 1], right[joined] = y[joined], y[joined + 1]
    near = np.zeros((len(y), LABELS), np.int64)
    for a, b in ((graph.skips[:, 0], graph.skips[:, 1]), (graph.skips[:, 1], graph.skips[:, 0])):
        np.add.at(near, (a, y[b]), 1)
    yield from zip(graph.forms.tolist(), y.tolist(), left.tolist(), right.tolist(), *near.T.tolist(), strict=True)


@dataclass
class Field:
    """Log potentials: ``local`` (feature, label), ``step`` (label, label behind), ``skip`` (label shared)."""

    local: np.ndarray
    step: np.ndarray
    skip: np.ndarray
    known: np.ndarray

    @staticmethod
    def fit(rows: np.ndarray, times: np.ndarray, turns: int = 600, rate: float = 0.1, pull: float = 3e-4) -> Field:
        """Maximum pseudo-likelihood of counted ``examples``; kinds never seen stay impossible.

        Potentials are pulled to zero, skip potentials to ``SKIP_PRIOR``, which stands where a sample repeats no token.
        """
        field = Field(np.zeros((FEATURES, LABELS)), np.zeros((LABELS, LABELS)), np.full(LABELS, SKIP_PRIOR), np.zeros(LABELS, bool))
        field.known[OTHER] = True
        if not len(rows):
            return field
        x, (y, left, right), near = _rows(rows[:, 0]), rows[:, 1:4].T, rows[:, 4:].astype(np.float64)
        field.known[np.unique(y)] = True
        share = times / times.sum()
        parts = [field.local, field.step, field.skip]
        first, second = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
        for turn in range(1, turns + 1):
            logit = x @ field.local + field.step[left] + field.step[:, right].T + near * field.skip
            logit[:, ~field.known] = -np.inf
            p = np.exp(logit - logit.max(1, keepdims=True))
            off = p / p.sum(1, keepdims=True)
            off[np.arange(len(y)), y] -= 1
            off *= share[:, None]
            step = np.zeros_like(field.step)
            np.add.at(step, left, off)
            behind = np.zeros_like(field.step)
            np.add.at(behind, right, off)
            for k, slope in enumerate((x.T @ off, step + behind.T, (near * off).sum(0))):
                slope = slope + pull * (parts[k] - (SKIP_PRIOR if k == 2 else 0.0))
                first[k] = 0.9 * first[k] + 0.1 * slope
                second[k] = 0.99 * second[k] + 0.01 * slope**2
                parts[k] -= rate * (first[k] / (1 - 0.9**turn)) / (np.sqrt(second[k] / (1 - 0.99**turn)) + 1e-8)
        return field

    def marginals(self, forms: np.ndarray, chain: np.ndarray, skips: np.ndarray, turns: int = TURNS) -> np.ndarray:
        """Label probabilities of tokens by loopy belief propagation: exact where the edges make no cycle."""
        n = len(forms)
        own = _rows(forms) @ self.local
        own[:, ~self.known] = -1e9
        own += np.where(chain[:, None], 0, self.step[:, OTHER])
        own += np.where(np.append(False, chain[:-1])[:, None], 0, self.step[OTHER])
        a = np.flatnonzero(chain)
        steps, far = len(a), len(skips)
        if not steps + far:
            return _normal(own)
        # messages: chain forward, chain back, skip forward, skip back
        source = np.concatenate([a, a + 1, skips[:, 0], skips[:, 1]])
        target = np.concatenate([a + 1, a, skips[:, 1], skips[:, 0]])
        back = np.concatenate([np.arange(steps) + steps, np.arange(steps), np.arange(far) + 2 * steps + far, np.arange(far) + 2 * steps])
        sent = np.zeros((len(source), LABELS))
        for _ in range(turns):
            belief = own + _sums(target, sent, n)
            held = belief[source] - sent[back]
            fresh = np.empty_like(sent)
            for k in range(LABELS):
                fresh[:steps, k] = np.logaddexp.reduce(held[:steps] + self.step[:, k], axis=1)
                fresh[steps : 2 * steps, k] = np.logaddexp.reduce(held[steps : 2 * steps] + self.step[k], axis=1)
            top = held[2 * steps :]
            every = np.logaddexp.reduce(top, axis=1)[:, None]
            # the sum over all labels with the potential of the shared one
            fresh[2 * steps :] = np.logaddexp(every, top + np.log(np.expm1(np.maximum(self.skip, 1e-9))))
            fresh -= fresh.max(1, keepdims=True)
            change = np.abs(fresh - sent).max()
            sent = 0.5 * sent + 0.5 * fresh if far else fresh
            if change < 1e-4:
                break
        return _normal(own + _sums(target, sent, n))


def _sums(target: np.ndarray, sent: np.ndarray, n: int) -> np.ndarray:
    return np.stack([np.bincount(target, sent[:, k], n) for k in range(LABELS)], axis=1)


def _normal(logs: np.ndarray) -> np.ndarray:
    p = np.exp(logs - logs.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def _fits(kind: int, tokens: list[str]) -> bool:
    """Whether adjoining tokens have the form of one item of the kind."""
    digits = sum(len(_NOT_DIGIT.sub("", t)) for t in tokens)
    if kind == 0:
        return len(tokens) == 1 and bool(_ADDRESS.fullmatch(tokens[0]))
    if kind == 1:
        return len(tokens) == 1 and bool(_QUAD.fullmatch(tokens[0])) and all(int(p) <= 255 for p in tokens[0].split("."))
    if any(_LETTER.search(t) for t in tokens):
        return False
    if kind == 2:
        return 12 <= digits <= 19 and luhn("".join(_NOT_DIGIT.sub("", t) for t in tokens))
    return SAME_DIGITS <= digits <= 15


def added_spans(graph: Graph, p: np.ndarray, base: list[tuple[int, int, int]], least: float) -> list[tuple[int, int, int, float]]:
    """(start, kind, end, least probability) of runs of tokens of one kind that meet no base span."""
    label = np.where(p.max(1) >= least, p.argmax(1), OTHER)
    label[graph.labels(base) != OTHER] = OTHER
    out, k = [], 0
    while k < len(label):
        kind, stop = label[k], k + 1
        if kind == OTHER:
            k += 1
            continue
        while stop < len(label) and graph.chain[stop - 1] and label[stop] == kind and stop - k < 8:
            stop += 1
        # the longest fitting item from here; a phone number does not reach over the next plus sign
        for end in range(stop, k, -1):
            texts = [t for _, _, t in graph.spans[k:end]]
            if _fits(kind, texts) and not any(t[0] == "+" for t in texts[1:]):
                out.append((graph.spans[k][0], int(kind), graph.spans[end - 1][1], float(p[k:end, kind].min())))
                k = end
                break
        else:
            k += 1
    return out


def _with_token(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).rlike("[0-9@]"))


def fit(docs: DataFrame, text: str = "text", sample: int = SAMPLE_DOCUMENTS) -> Field:
    """The field learned from the base spans of about ``sample`` whole documents; without any token it adds nothing."""
    some = _with_token(pick(docs, text=(text, "string")), "text").withColumn("h", F.xxhash64("text"))
    # every n-th hash, so no task gathers the sample
    rows = some.count()
    some = some.where(F.pmod("h", F.lit(max(1, rows))) < sample).select("text").distinct()
    names = ["form", "label", "before", "behind", *[f"near_{k}" for k in range(LABELS)]]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for row in batch.column(0).to_pylist():
                counts.update(set(examples(row)))
        if counts:
            columns = [pa.array(c, pa.int64()) for c in zip(*counts, strict=True)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts.values(), pa.int64())], [*names, "n"])

    found = some.mapInArrow(count, ", ".join(f"{n} long" for n in [*names, "n"])).groupBy(*names).agg(F.sum("n").alias("n")).orderBy(*names)
    rows = np.array([tuple(r) for r in found.collect()], np.int64).reshape(-1, len(names) + 1)
    return Field.fit(rows[:, :-1], rows[:, -1].astype(np.float64))


SPANS = T.StructType([
    T.StructField("base", T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
    T.StructField("spans", T.ArrayType(T.StructType([
        T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("added", T.BooleanType()),
        T.StructField("probability", T.DoubleType()),
    ]))),
])

_BASE_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
_SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("added", pa.bool_()), ("probability", pa.float64())]))


def _label(texts: list[str], field: Field, least: float) -> list[tuple[list, list]]:
    """Base and all spans of each text; graphs of several texts pass messages together."""
    out: list = [([], []) for _ in texts]
    waiting: list[tuple[int, Graph, list]] = []

    def flush() -> None:
        if not waiting:
            return
        at = np.cumsum([0] + [len(g.forms) for _, g, _ in waiting])
        p = field.marginals(
            np.concatenate([g.forms for _, g, _ in waiting]), np.concatenate([g.chain for _, g, _ in waiting]),
            np.concatenate([g.skips + a for (_, g, _), a in zip(waiting, at, strict=False)]),
        )
        for (row, graph, base), a, b in zip(waiting, at, at[1:], strict=False):
            added = added_spans(graph, p[a:b], base, least)
            every = sorted([(s, k, e, False, 1.0) for s, k, e in base] + [(s, k, e, True, q) for s, k, e, q in added])
            out[row] = (
                [{"kind": KINDS[k], "start": s, "end": e} for s, k, e in base],
                [{"kind": KINDS[k], "start": s, "end": e, "added": new, "probability": q} for s, k, e, new, q in every],
            )
        waiting.clear()

    size = 0
    for row, text in enumerate(texts):
        graph = Graph.of(text)
        if not len(graph.forms):
            continue
        waiting.append((row, graph, base_spans(text)))
        size += len(graph.forms)
        if size > BATCH_TOKENS:
            flush()
            size = 0
    flush()
    return out


def label(docs: DataFrame, field: Field, text: str = "text", least: float = LEAST) -> DataFrame:
    """All columns of ``docs`` with ``base`` spans and all ``spans`` (code points, end exclusive), by start and kind."""

    def run(batches: Iterator[pa.RecordBatch], place: int) -> Iterator[tuple[pa.RecordBatch, list]]:
        for batch in K.slices(batches, place):
            found = _label([t or "" for t in batch.column(place).to_pylist()], field, least)
            yield batch, [pa.array([b for b, _ in found], _BASE_TYPE), pa.array([s for _, s in found], _SPAN_TYPE)]

    return annotate(docs, text, run, SPANS)
