"""I-Match fingerprints: hashes of the document's terms in randomised subsets of a lexicon.

The lexicon are the terms whose document frequency lies in a band, given as
shares of all documents. A document has at least one band term in common with
others only so often: the lexicon has at most (mean distinct terms of a document)
/ (lower share) terms at any number of documents, which is what the driver
gathers and broadcasts.

Every term belongs to the whole lexicon and, by a hash, to random subsets: five
each of every rate 1/2, 1/4 ... 1/4096. A fingerprint is, for each subset, a
24-bit hash of the document's sorted distinct terms in it; 0 where it has none.
Rates differ because documents do: of a long one only the small subsets survive
an edit, of a short one only the large ones hold a term. ``likeness`` is the
share of equal hashes (twice the equal ones by all that are not 0), from the
small subsets up until ``OBSERVED`` of them hold terms.

Terms are words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased. A text without band
terms uses all its terms instead; one without words has the empty fingerprint,
all zeros. Equal texts have equal fingerprints and likeness 1. Null texts count
as empty. Null ids come first in the order, equal ids are ordered by their text;
the document after the last is the first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custodia.llm import kernels as K
from custodia.llm.common import pick

BAND = (0.001, 0.1)
RATES, EACH = 12, 5
SUBSETS = 1 + RATES * EACH
OBSERVED = 7
TERM_BITS, PART_BITS = 42, 10
HELD_TERMS = 400_000
BUCKET_DOCUMENTS = 1024
DIGITS = 6


def terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct terms of each row in ascending order with their rows."""
    value, first = K.word_hashes(column)
    value, row = value >> np.uint64(64 - TERM_BITS), K.row_of(first)
    order = np.lexsort((value, row))
    value, row = value[order], row[order]
    keep = np.ones(len(value), bool)
    keep[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
    return value[keep], row[keep]


def lexicon(docs: DataFrame, documents: int, band: tuple[float, float] = BAND) -> np.ndarray:
    """The terms with a document frequency in the band, counted over all documents."""
    low, high = band[0] * documents, band[1] * documents

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for part in K.slices(batches, 0):
            value = terms(part.column(0))[0]
            held, n = _merge(np.concatenate([held, value]), np.concatenate([n, np.ones(len(value), np.int64)]))
            if len(held) > HELD_TERMS:
                yield _parts(held, n)
                held, n = held[:0], n[:0]
        if len(held):
            yield _parts(held, n)

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts, size = None, [], 0
        for batch in batches:
            for part, value, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if part != at:
                    yield from chosen(parts)
                    at, parts, size = part, [], 0
                parts.append((np.frombuffer(value, "<u8"), np.frombuffer(n, "<u4").astype(np.int64)))
                size += len(value)
                if size > 1 << 24:
                    parts = [_merge(*(np.concatenate(x) for x in zip(*parts, strict=True)))]
                    size = len(parts[0][0])
        yield from chosen(parts)

    def chosen(parts: list) -> Iterator[pa.RecordBatch]:
        if parts:
            value, n = _merge(*(np.concatenate(x) for x in zip(*parts, strict=True)))
            yield pa.RecordBatch.from_arrays([pa.array(value[(n >= low) & (n <= high)].view(np.int64))], ["term"])

    counted = docs.select("text").mapInArrow(count, "part int, value binary, n binary")
    found = counted.repartition("part").sortWithinPartitions("part").mapInArrow(total, "term long").toPandas()
    return np.sort(found["term"].to_numpy(np.int64).view(np.uint64))


def _merge(value: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(value, kind="stable")
    value, n = value[order], n[order]
    heads = np.flatnonzero(np.append(True, value[1:] != value[:-1])) if len(value) else np.zeros(0, np.int64)
    return value[heads], np.add.reduceat(n, heads) if len(heads) else n


def _parts(value: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """Sorted terms and counts, one row for each range of terms."""
    part = (value >> np.uint64(TERM_BITS - PART_BITS)).astype(np.int64)
    cuts = np.searchsorted(part, np.arange((1 << PART_BITS) + 1))
    used = np.flatnonzero(np.diff(cuts))
    return pa.RecordBatch.from_arrays(
        [pa.array(used.astype(np.int32)), pa.array([value[cuts[p] : cuts[p + 1]].astype("<u8").tobytes() for p in used], pa.binary()),
         pa.array([n[cuts[p] : cuts[p + 1]].astype("<u4").tobytes() for p in used], pa.binary())],
        ["part", "value", "n"],
    )


def subset_masks(value: np.ndarray) -> np.ndarray:
    """The subsets of each term as bits: bit 0 the whole lexicon, then EACH for every rate."""
    out = np.ones(len(value), np.uint64)
    for k in range(1, SUBSETS):
        rate = 1 + (k - 1) // EACH
        draw = K.mix(value * np.uint64(0x9E3779B97F4A7C15) + np.uint64(k * 0xD1B54A32D192ED03 % 2**64))
        out |= (draw < np.uint64(1 << (64 - rate))).astype(np.uint64) << np.uint64(k)
    return out


class Printer:
    """Fingerprints of texts by one lexicon."""

    def __init__(self, lexicon_terms: np.ndarray):
        self.terms, self.masks = lexicon_terms, subset_masks(lexicon_terms)

    def prints(self, column: pa.Array) -> np.ndarray:
        """One row of SUBSETS hashes for each text."""
        value, row = terms(column)
        at = np.minimum(np.searchsorted(self.terms, value), max(len(self.terms) - 1, 0))
        band = self.terms[at] == value if len(self.terms) else np.zeros(len(value), bool)
        has = np.zeros(len(column), bool)
        has[row[band]] = True
        masks = np.zeros(len(value), np.uint64)
        masks[band] = self.masks[at[band]]
        other = ~has[row]
        masks[other] = subset_masks(value[other])
        used = masks > 0
        value, row, masks = K.mix(value[used]), row[used], masks[used]
        out = np.zeros((len(column), SUBSETS), np.uint32)
        for k in range(SUBSETS):
            some = np.flatnonzero((masks >> np.uint64(k)) & np.uint64(1))
            if len(some):
                rows = row[some]
                heads = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
                hashed = K.mix(np.add.reduceat(value[some], heads) + np.uint64(k)) >> np.uint64(64 - 4 * DIGITS)
                out[rows[heads], k] = np.maximum(hashed, 1)
        return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each pair of rows of hashes, 0 to 1."""
    equal = (a == b) & (a > 0)
    held = (a > 0).astype(np.int64) + (b > 0)
    # from the smallest subsets: every rate from where enough of them hold terms
    count = np.cumsum((held > 0)[:, ::-1], axis=1)
    rate_ends = np.append(np.arange(EACH, SUBSETS, EACH), SUBSETS) - 1
    enough = count[:, rate_ends] >= OBSERVED
    last = np.where(enough.any(axis=1), rate_ends[enough.argmax(axis=1)], SUBSETS - 1)
    row = np.arange(len(a))
    equal = np.cumsum(equal[:, ::-1], axis=1)[row, last]
    held = np.cumsum(held[:, ::-1], axis=1)[row, last]
    out = np.where(held > 0, 2 * equal / np.maximum(held, 1), 0.0)
    out[(a == b).all(axis=1)] = 1.0
    return out


def text_form(prints: np.ndarray) -> list[str]:
    """Each row as hexadecimal text, DIGITS for each subset."""
    raw = prints.astype(">u4").view(np.uint8).reshape(len(prints), SUBSETS, 4)[:, :, 4 - DIGITS // 2 :]
    return [r.tobytes().hex() for r in np.ascontiguousarray(raw)]


def fingerprint(docs: DataFrame, lexicon_terms: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, fingerprint."""
    docs = pick(docs, doc_id=(id_col, "long"), text=(text_col, "string"))
    shared = docs.sparkSession.sparkContext.broadcast(lexicon_terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        printer = Printer(shared.value)
        for part in K.slices(batches, 1):
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(text_form(printer.prints(part.column(1))), pa.string())], ["doc_id", "fingerprint"])

    return docs.mapInArrow(run, "doc_id long, fingerprint string")


def in_order(docs: DataFrame, documents: int) -> DataFrame:
    """Documents dealt to buckets of ascending ids, each with a copy of the next bucket's first document behind its own.

    Bounds of buckets are quantiles, that is ids that exist, so each bucket begins
    with its bound; the last bucket is followed by the first document.
    """
    place = F.coalesce("doc_id", F.lit(-(2**63)))
    count = max(1, documents // BUCKET_DOCUMENTS)
    row = docs.agg(F.min(place), F.percentile_approx(place, [k / count for k in range(1, count)] or [0.5], 20_000)).first()
    bounds = np.unique([x for x in (row[1] or []) if x > row[0]]).astype(np.int64) if row[0] is not None and count > 1 else np.zeros(0, np.int64)
    firsts = np.append(np.int64(row[0] if row[0] is not None else 0), bounds)
    shared = docs.sparkSession.sparkContext.broadcast(firsts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts = shared.value
        for part in K.slices(batches, 1):
            ids = part.column(0).fill_null(-(2**63)).to_numpy()
            bucket = np.searchsorted(firsts, ids, side="right") - 1
            first = np.flatnonzero(firsts[bucket] == ids)
            where = np.concatenate([bucket, (bucket[first] - 1) % len(firsts)])
            which = pa.array(np.concatenate([np.arange(len(ids)), first]))
            tail = pa.array(np.arange(len(where)) >= len(ids))
            ids, texts = part.column(0), part.column(1).fill_null("")
            yield pa.RecordBatch.from_arrays([pa.array(where), tail, ids.take(which), texts.take(which)], ["bucket", "tail", "doc_id", "text"])

    dealt = docs.mapInArrow(run, "bucket long, tail boolean, doc_id long, text string")
    return dealt.repartition("bucket").sortWithinPartitions("bucket", "tail", F.col("doc_id").asc_nulls_first(), "text")


def stability(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", band: tuple[float, float] = BAND) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness.

    In the edited text the last quarter of the code points (rounded down) is
    replaced by as many from the beginning of the next document, or all it has.
    """
    docs = pick(docs, doc_id=(id_col, "long"), text=(text_col, "string"))
    documents = docs.count()
    shared = docs.sparkSession.sparkContext.broadcast(lexicon(docs, documents, band))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        printer = Printer(shared.value)
        waiting = None
        for part in K.slices(batches, 3, K.SLICE_BYTES // 2):
            rows = list(zip(*(c.to_pylist() for c in part.columns), strict=True))
            rows = ([waiting] if waiting else []) + rows
            # of several copies behind a bucket the first one counts
            rows = [r for k, r in enumerate(rows) if not (r[1] and (k == 0 or rows[k - 1][1]))]
            waiting = rows[-1] if rows and not rows[-1][1] else None
            own = [k for k in range(len(rows) - 1) if not rows[k][1]]
            if not own:
                continue
            texts = [r[3] for r in rows]
            quarter = [len(texts[k]) // 4 for k in own]
            edited = [texts[k][: len(texts[k]) - q] + texts[k + 1][:q] for k, q in zip(own, quarter, strict=True)]
            prints, after = printer.prints(pa.array(texts, pa.string())), printer.prints(pa.array(edited, pa.string()))
            at = np.array(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array([rows[k][2] for k in own], pa.int64()), pa.array([len(texts[k]) for k in own], pa.int64()),
                 pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited]), pa.array(text_form(prints[at])), pa.array(text_form(after)),
                 pa.array(likeness(prints[at], after)), pa.array(likeness(prints[at], prints[at + 1]))],
                ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
            )

    return in_order(docs, documents).mapInArrow(
        run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    )
