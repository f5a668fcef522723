"""Ranked lexical search over bit-sliced Bloom signatures.

Index (``build``). Documents of a similar number of keys share a block of at most
``DOCUMENTS`` rows. A key is a term with a level of its count (1, 2, 3, 4, 6, 8, 12,
...): a document holds the keys of all levels its count reaches. Each key sets
``HASHES`` bits of the document's signature; a block stores the signatures by bit
(one bitmap over its documents for each place, a slice), next to the documents' ids,
sizes and normalized words. The same pass counts how many documents hold a term.

Search (``search``). The AND of a key's slices is a bitmap that holds every document
with the key and some others. The highest level present bounds a term's count from
above, so the weighted sum of the bounds is an upper bound of a document's score.
Each task keeps the best ``top`` exact scores of an item; a document is counted and
scored exactly unless its bound is below the last of them, that is unless it provably
is not among the best. The best of all tasks are ranked together. Results are exact:
false positives of the signatures only raise bounds.

Terms are maximal matches of ``[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+``, A-Z
lower-cased. Nulls and empty texts have no terms: such documents are in no result,
such items have none. Each row is a document of its own, also a repeated one; items
are distinct pairs of id and text. A null document id sorts before all others.
Further columns are ignored, whatever their names.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from custodia.llm import kernels as K
from custodia.llm.common import pick
from custodia.llm.components import stored
from custodia.session import work_dir

DOCUMENTS = 256
#: Bits a key has at least in a signature, and hash functions.
BITS = 12
HASHES = 6
LEAST_WIDTH = 512
#: Bytes of slices and of words a block holds at most, if it has more than eight documents (or one).
BLOCK_BYTES = 2 << 20
#: Terms of a task that are counted before they are written.
VOCABULARY = 200_000
#: (item, term) pairs that a task gets at once; a longer item comes alone.
QUERY_TERMS = 50_000
TOP = 50
PARTS = 32


def _normal() -> bytes:
    table = bytearray(b" " * 128 + bytes(range(128, 256)))
    for c in range(128):
        if chr(c).isalnum():
            table[c] = ord(chr(c).lower())
    return bytes(table)


NORMAL = _normal()


def levels(most: int) -> list[int]:
    """The counts that are keys of their own, up to ``most``: 1, 2, 3, 4, 6, 8, 12, 16 ..."""
    out, step = [1], 2
    while step <= most:
        out += [step, step + step // 2] if step > 1 else [step]
        step *= 2
    return [x for x in out if x <= most]


def places(keys: np.ndarray, level: np.ndarray | int, width: int) -> np.ndarray:
    """The ``HASHES`` bits of each key at a level in a signature of ``width`` bits."""
    h = K.mix(keys + np.asarray(level, np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    step = K.mix(h + np.uint64(1)) | np.uint64(1)
    return ((h[:, None] + np.arange(HASHES, dtype=np.uint64) * step[:, None]) & np.uint64(width - 1)).astype(np.int64)


def hashes(terms: list[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(t) for t in terms], np.uint64)


class _Open:
    """A block that is still being filled: bits of its documents by place."""

    def __init__(self, width: int, documents: int):
        self.width, self.documents = width, max(8, min(documents, BLOCK_BYTES * 8 // width) // 8 * 8)
        self.ids: list = []
        self.sizes: list[int] = []
        self.bodies: list[bytes] = []
        self.bits: list[np.ndarray] = []
        self.bytes = 0

    def add(self, doc, size: int, body: bytes, keys: np.ndarray, level: np.ndarray) -> None:
        row = len(self.ids)
        self.bits.append(np.unique(places(keys, level, self.width)) * self.documents + row)
        self.ids.append(doc)
        self.sizes.append(size)
        self.bodies.append(body)
        self.bytes += len(body)

    @property
    def full(self) -> bool:
        return len(self.ids) == self.documents or self.bytes > BLOCK_BYTES

    def batch(self) -> pa.RecordBatch:
        slices = np.zeros(self.width * self.documents // 8, np.uint8)
        at = np.concatenate(self.bits)
        np.bitwise_or.at(slices, at >> 3, np.left_shift(1, at & 7).astype(np.uint8))
        return _row(
            kind=0, width=self.width, documents=len(self.ids), words=sum(self.sizes), ids=self.ids, sizes=self.sizes, slices=slices.tobytes(), bodies=self.bodies
        )


_SCHEMA = pa.schema([
    ("kind", pa.int32()), ("width", pa.int64()), ("documents", pa.int64()), ("words", pa.int64()), ("ids", pa.list_(pa.int64())),
    ("sizes", pa.list_(pa.int64())), ("slices", pa.binary()), ("bodies", pa.list_(pa.binary())), ("terms", pa.list_(pa.binary())), ("held", pa.list_(pa.int64())),
])
_DDL = (
    "kind int, width long, documents long, words long, ids array<long>, sizes array<long>, slices binary, bodies array<binary>, terms array<binary>, "
    "held array<long>"
)


def _row(**values) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([values.get(f.name)], f.type) for f in _SCHEMA], schema=_SCHEMA)


def build(docs: DataFrame, folder: str, doc: str = "doc_id", text: str = "text", documents: int = DOCUMENTS) -> DataFrame:
    """The index of all rows of ``docs`` in one pass, written below ``folder``: blocks (kind 0) and counted terms (kind 1)."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_blocks: dict[int, _Open] = {}
        held: Counter = Counter()
        for batch in K.slices(batches, 1):
            for number, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                terms = (body or "").encode().translate(NORMAL).split()
                if not terms:
                    continue
                counts = Counter(terms)
                held.update(counts.keys())
                times = np.fromiter(counts.values(), np.int64, len(counts))
                keys = hashes(list(counts))
                steps = levels(int(times.max()))
                some = [np.flatnonzero(times >= x) for x in steps]
                keys = keys[np.concatenate(some)]
                width = max(LEAST_WIDTH, 1 << math.ceil(math.log2(len(keys) * BITS)))
                block = open_blocks.setdefault(width, _Open(width, documents))
                block.add(number, len(terms), b" ".join(terms), keys, np.repeat(steps, [len(s) for s in some]))
                if block.full:
                    yield open_blocks.pop(width).batch()
                if len(held) > VOCABULARY:
                    yield _row(kind=1, terms=list(held), held=list(held.values()))
                    held.clear()
                if sum(b.bytes for b in open_blocks.values()) > 8 * BLOCK_BYTES:
                    for block in open_blocks.values():
                        yield block.batch()
                    open_blocks.clear()
        for block in open_blocks.values():
            yield block.batch()
        if held:
            yield _row(kind=1, terms=list(held), held=list(held.values()))
        K.release()

    rows = pick(docs, doc=(doc, "long"), text=(text, "string")).mapInArrow(index, _DDL)
    rows.write.partitionBy("kind").parquet(f"{folder}/index")
    return docs.sparkSession.read.schema(rows.schema).parquet(f"{folder}/index")


@dataclass
class Queries:
    """Items of one search: the distinct terms with their hashes, and (term, item, weight) of all pairs by term."""

    items: int
    terms: list[bytes]
    keys: np.ndarray
    term: np.ndarray
    item: np.ndarray
    weight: np.ndarray
    documents: int
    words: int

    @staticmethod
    def of(rows: list[tuple[int, bytes, int]], documents: int, words: int) -> Queries:
        """From (item number, term, weight)."""
        terms = sorted({t for _, t, _ in rows})
        number = {t: k for k, t in enumerate(terms)}
        rows = sorted((number[t], i, w) for i, t, w in rows)
        term, item, weight = (np.array(c, np.int64) for c in zip(*rows, strict=True))
        return Queries(int(item.max()) + 1, terms, hashes(terms), term, item, weight, documents, words)

    def __post_init__(self) -> None:
        self.by_item = [[] for _ in range(self.items)]
        for t, i, w in zip(self.term.tolist(), self.item.tolist(), self.weight.tolist(), strict=True):
            self.by_item[i].append((self.terms[t], w))
        self.first = np.searchsorted(self.term, np.arange(len(self.terms) + 1))

    def damping(self, sizes: np.ndarray) -> np.ndarray:
        return 50 + 50 * sizes * self.documents // self.words

    def bounds(self, slices: np.ndarray, width: int, sizes: np.ndarray) -> np.ndarray:
        """An upper bound of the score of each document (column) for each item (row)."""
        n = len(sizes)
        bitmaps = slices.reshape(width, -1)
        # most[k, d]: the count of term k in document d is at most this; 0 where the term is surely absent
        rows, cols, steps = [], [], levels(int(sizes.max()))
        alive = np.arange(len(self.terms))
        most: list[np.ndarray] = []
        for k, low in enumerate(steps):
            found = np.bitwise_and.reduce(bitmaps[places(self.keys[alive], low, width)], axis=1)
            present = np.unpackbits(found, axis=1, bitorder="little", count=n).astype(bool)
            if k:
                present &= before[kept]  # noqa: F821 (a level counts only with those below it)
            r, c = np.nonzero(present)
            rows.append(alive[r])
            cols.append(c)
            most.append(np.full(len(r), steps[k + 1] - 1 if k + 1 < len(steps) else 1 << 60))
            kept = np.flatnonzero(present.any(1))
            alive, before = alive[kept], present
            if not len(alive):
                break
        rows, cols, most = np.concatenate(rows), np.concatenate(cols), np.concatenate(most)
        cap = np.minimum(most, sizes[cols])
        part = 1_000_000_000 * cap // (1000 * cap + 20 * self.damping(sizes)[cols])
        # the levels of a term in a document ascend, so the last one is the bound; earlier ones are taken back
        order = np.lexsort((part, cols, rows))
        rows, cols, part = rows[order], cols[order], part[order]
        last = np.append((rows[1:] != rows[:-1]) | (cols[1:] != cols[:-1]), True) if len(rows) else np.zeros(0, bool)
        rows, cols, part = rows[last], cols[last], part[last]
        each = self.first[rows + 1] - self.first[rows]
        pair = K.ragged(self.first[rows], each)
        add = self.weight[pair] * np.repeat(part, each)
        sums = np.bincount(self.item[pair] * n + np.repeat(cols, each), add.astype(np.float64), self.items * n)
        return sums.astype(np.int64).reshape(self.items, n)

    def score(self, item: int, counts: Counter, damping: int) -> int:
        total = 0
        for term, weight in self.by_item[item]:
            times = counts.get(term)
            if times:
                total += weight * (1_000_000_000 * times // (1000 * times + 20 * damping))
        return total


class Best:
    """The best rows of each item met so far: (score, negated id rank, id) in a heap."""

    def __init__(self, items: int, top: int):
        self.heaps: list[list] = [[] for _ in range(items)]
        self.top = top
        self.least = np.ones(items, np.int64)

    def offer(self, item: int, score: int, doc: int | None) -> None:
        entry = (score, math.inf if doc is None else -doc, doc is not None)
        heap = self.heaps[item]
        if len(heap) < self.top:
            heapq.heappush(heap, entry)
        else:
            heapq.heappushpop(heap, entry)
        if len(heap) == self.top:
            self.least[item] = max(heap[0][0], 1)


def scan(blocks: Iterator[tuple[int, list, np.ndarray, np.ndarray, list[bytes]]], queries: Queries, top: int) -> tuple[Best, int]:
    """The best documents of each item in (width, ids, sizes, slices, bodies) blocks, and the pairs scored exactly."""
    best, scored = Best(queries.items, top), 0
    for width, ids, sizes, slices, bodies in blocks:
        bound = queries.bounds(slices, width, sizes)
        damping = queries.damping(sizes).tolist()
        counts: dict[int, Counter] = {}
        for item in np.flatnonzero((bound >= best.least[:, None]).any(1)).tolist():
            row = bound[item]
            for d in np.argsort(-row, kind="stable").tolist():
                if row[d] < best.least[item]:
                    break
                if d not in counts:
                    counts[d] = Counter(bodies[d].split())
                score = queries.score(item, counts[d], damping[d])
                scored += 1
                if score > 0:
                    best.offer(item, score, ids[d])
    return best, scored


def _items(items: DataFrame, item: str, text: str, folder: str) -> DataFrame:
    """Distinct terms of each distinct (id, text): item_id, h (of the text), term."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in K.slices(batches, 2):
            terms = [sorted(set((t or "").encode().translate(NORMAL).split())) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(terms, pa.list_(pa.binary()))], ["item_id", "h", "terms"])

    rows = pick(items, item_id=(item, "long"), text=(text, "string")).select("item_id", F.sha2("text", 256).alias("h"), "text").where("text IS NOT NULL").distinct()
    return stored(rows.mapInArrow(split, "item_id long, h string, terms array<binary>").select("item_id", "h", F.explode("terms").alias("term")), f"{folder}/terms")


def _weighted(spark: SparkSession, terms: DataFrame, index: DataFrame, documents: int, folder: str) -> DataFrame:
    """Terms of the items that some document holds, with their weights."""
    wanted = terms.select("term").distinct()
    seen = index.where("kind = 1").select(F.explode(F.arrays_zip("terms", "held")).alias("z")).select(F.col("z.terms").alias("term"), "z.held")
    held = seen.join(wanted, "term", "left_semi").groupBy("term").agg(F.sum("held").alias("held"))
    ratio = F.lit(2.0 * documents + 2.0) / (F.lit(2.0) * F.col("held") + F.lit(1.0))
    weight = F.floor(F.lit(1000.0) * F.log(ratio)).cast("long")
    return stored(terms.join(held.select("term", weight.alias("weight")), "term"), f"{folder}/weighted")


def search(docs: DataFrame, items: DataFrame, top: int = TOP, doc: str = "doc_id", item: str = "item_id", text: str = "text", documents: int = DOCUMENTS) -> DataFrame:
    """The ``top`` best documents of each item: item_id, rank (int), doc_id, score (long)."""
    spark = docs.sparkSession
    folder = work_dir(spark, "bitslice")
    index = build(docs, folder, doc, text, documents)
    totals = index.where("kind = 0").agg(F.sum("documents").alias("n"), F.sum("words").alias("l")).first()
    n, words = totals["n"] or 0, totals["l"] or 0
    weighted = _weighted(spark, _items(items, item, text, folder), index, n, folder)
    blocks = max(1, math.ceil(weighted.count() / QUERY_TERMS))
    weighted = weighted.withColumn("block", F.pmod(F.xxhash64("item_id", "h"), F.lit(blocks)))
    found = None
    for block in range(blocks):
        hits = _search_block(index, weighted.where(F.col("block") == block), n, words, top)
        if hits is not None:
            found = hits if found is None else found.unionByName(hits)
    if found is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    found = stored(found, f"{folder}/found")
    order = [F.desc("score"), F.asc_nulls_first("doc_id")]
    # the best of a part first, so that no task ranks what all tasks of a search found for an item
    part = Window.partitionBy("item_id", "h", F.pmod(F.xxhash64("doc_id", "score"), F.lit(PARTS))).orderBy(*order)
    some = found.withColumn("r", F.row_number().over(part)).where(F.col("r") <= top)
    whole = some.withColumn("rank", F.row_number().over(Window.partitionBy("item_id", "h").orderBy(*order)))
    return whole.where(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")


def _search_block(index: DataFrame, weighted: DataFrame, n: int, words: int, top: int) -> DataFrame | None:
    """What each task finds for the items of one block; their terms (about ``QUERY_TERMS``, or one item's) go to all tasks."""
    rows = weighted.select("item_id", "h", "term", "weight").collect()
    if not rows:
        return None
    named = sorted({(r["item_id"], r["h"]) for r in rows}, key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    number = {x: k for k, x in enumerate(named)}
    queries = Queries.of([(number[r["item_id"], r["h"]], bytes(r["term"]), r["weight"]) for r in rows], n, words)
    shared = index.sparkSession.sparkContext.broadcast((queries, named))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, named = shared.value

        def blocks() -> Iterator[tuple]:
            for batch in batches:
                for k in range(batch.num_rows):
                    width, ids, sizes, slices, bodies = (batch.column(c)[k] for c in range(5))
                    yield width.as_py(), ids.as_py(), sizes.values.to_numpy(), np.frombuffer(slices.as_buffer(), np.uint8), bodies.as_py()

        best, _ = scan(blocks(), queries, top)
        out = [(*named[i], None if not known else -rank, score) for i, heap in enumerate(best.heaps) for score, rank, known in heap]
        columns = list(zip(*out, strict=True)) or [[], [], [], []]
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["item_id", "h", "doc_id", "score"])
        K.release()

    blocks = index.where("kind = 0").select("width", "ids", "sizes", "slices", "bodies")
    return blocks.mapInArrow(run, "item_id long, h string, doc_id long, score long")
