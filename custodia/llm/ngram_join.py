"""Jaccard self-join of documents by their word n-grams, with set-relation skipping.

A document's set are its distinct shingles of ``WORDS`` words. Equal sets are one
set. The join is exact for components: no link between different sets is lost.

1. Shingles that are frequent in parts of the corpus come last in the global
   order, by frequency (a list of bounded length: it only orders), all others by
   hash. Sets that can be similar share a shingle in their prefixes.
2. Answers of similar sets are derived, not searched: sets with equal min-hashes
   are compared with one leader, then in rounds with a few others of their group;
   linked ones form clusters, and of every member the exact difference to the
   cluster's root is computed.
3. The index holds, for each prefix shingle, clusters instead of sets, with the
   range of sizes and how much follows the shingle. Lists are sorted by size; a
   block of sizes out of reach is skipped, and pairs whose remaining length cannot
   give the overlap. Inside a cluster nothing is compared.
4. For the pairs of clusters left, the overlap of the two roots is computed once.
   It links them, or rules all member pairs out by their differences; of clusters
   that neither decides only members that meet in their own prefixes are compared
   themselves. The root of a large cluster is the member with the fewest shingles
   of its own, so that few clusters stay undecided.

Before a comparison the parities of the two sets' elements, hashed to ``PARITY_BITS``
places or at least two for each element, bound the overlap from above. Texts are fetched again for sets that are
compared; a bitmap of fixed size keeps the others out of the shuffle. Pairs of clusters
that other links connect already are not compared any further. Words are ``[^\\x20\\x09-\\x0D]+``
with A-Z lower-cased; a text of fewer words is one shingle. Null, empty and blank
texts have no shingles, link with nothing and are their own component. Rows with
a null id link with nothing and have no component; repeated ids are rows of
their own, with the component of their text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from custodia.llm import kernels as K
from custodia.llm.common import annotate, binary, pick
from custodia.llm.components import components, stored
from custodia.session import work_dir

WORDS = 5
LIST_LENGTH = 100_000
LOCALLY_FREQUENT = 3
COUNTED_TOGETHER = 3_000_000
KEYS, HASHES_PER_KEY = 4, 3
PAIRS_OF_HASHES = ((0, 3), (1, 6), (4, 9), (7, 10))
ROUNDS, MET_TOGETHER = 3, 8
PARITY_BITS = 1024
MEMBERS_PER_TASK = 256
BITMAP_BITS = 1 << 25
_P = np.uint64(0x100000001B3)


def shingles(column: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of all rows, and the first of each row (n + 1)."""
    word, first = K.word_hashes(column)
    count = np.diff(first)
    full = np.maximum(count - words + 1, 0)
    at = K.ragged(first[:-1], full)
    out = np.zeros(len(at), np.uint64)
    for k in range(words):
        out = out * _P + word[at + k]
    out = K.mix(out)
    few = np.flatnonzero((count > 0) & (full == 0))
    if len(few):
        short = np.zeros(len(few), np.uint64)
        for k in range(words - 1):
            have = count[few] > k
            at = np.minimum(first[:-1][few] + k, len(word) - 1)
            short = np.where(have, short * _P + word[at] + np.uint64(1), short)
        rows = np.concatenate([np.repeat(np.arange(len(count)), full), few])
        out = np.concatenate([out, K.mix(short + np.uint64(0x5BD1E995))])
        out = out[np.argsort(rows, kind="stable")]
        full[few] = 1
    return out, np.append(0, np.cumsum(full))


def sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each row in ascending order, and the first of each row (n + 1)."""
    value, first = shingles(column)
    row = K.row_of(first)
    order = np.lexsort((value, row))
    value, row = value[order], row[order]
    keep = np.ones(len(value), bool)
    keep[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
    value, row = value[keep], row[keep]
    return value, np.searchsorted(row, np.arange(len(first)))


def set_names(value: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A 64-bit name of each set."""
    total = np.append(np.uint64(0), np.cumsum(K.mix(value ^ np.uint64(0xA5A5A5A5))))
    return K.mix((total[first[1:]] - total[first[:-1]]) * _P + np.diff(first).astype(np.uint64)).view(np.int64)


def prefix_length(n: np.ndarray) -> np.ndarray:
    """Shingles of the order's beginning in which sets of similarity 0.8 or more must meet."""
    return n - (4 * n + 4) // 5 + 1


def needed(a, b):  # noqa: ANN001, ANN201
    """Least overlap of sets of sizes a and b: 100 * overlap >= 80 * union."""
    return (4 * (a + b) + 8) // 9


def frequent(docs: DataFrame) -> np.ndarray:
    """The most frequent shingles, by ascending frequency; only their place in the order depends on it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for part in _and_end(K.slices(batches, 0)):
            if part is not None:
                held.append(shingles(part.column(0))[0])
                size += len(held[-1])
            if held and (part is None or size >= COUNTED_TOGETHER):
                value, n = np.unique(np.concatenate(held), return_counts=True)
                often = n >= LOCALLY_FREQUENT
                yield pa.RecordBatch.from_arrays([pa.array(value[often].view(np.int64)), pa.array(n[often])], ["value", "n"])
                held, size = [], 0

    counted = docs.select("text").mapInArrow(run, "value long, n long").groupBy("value").agg(F.sum("n").alias("n"))
    top = counted.orderBy(F.desc("n"), "value").limit(LIST_LENGTH).toPandas()
    return top["value"].to_numpy(np.int64).view(np.uint64)[::-1].copy()


def describe(docs: DataFrame, often: np.ndarray) -> DataFrame:
    """Each document with the size and name of its set, how many of its shingles are not frequent, its prefix in the global order, and its min-hash keys."""
    order = np.argsort(often)
    shared = docs.sparkSession.sparkContext.broadcast((often[order], order))
    seeds = K.mix(np.arange(1, KEYS * HASHES_PER_KEY + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, rank = shared.value
        for part in K.slices(batches, 1):
            value, first = sets(part.column(1))
            n = np.diff(first)
            row = K.row_of(first)
            some = n > 0
            place = np.zeros(len(value), np.int64)
            if len(known) and len(value):
                at = np.minimum(np.searchsorted(known, value), len(known) - 1)
                place = np.where(known[at] == value, rank[at] + 1, 0)
            # by row, place among the frequent ones, hash: within a row the hashes already ascend
            order = np.lexsort((place, row))
            rare = np.bincount(row, place == 0, part.num_rows).astype(np.int64)
            take = np.where(some, prefix_length(n), 0)
            prefix = value[order][K.ragged(first[:-1], take)] >> np.uint64(32)
            least = np.zeros((len(seeds), part.num_rows), np.uint64)
            if some.any():
                for k, seed in enumerate(seeds):
                    least[k, some] = np.minimum.reduceat(K.mix(value ^ seed), first[:-1][some])
            keys = [_chain(least[k * HASHES_PER_KEY : (k + 1) * HASHES_PER_KEY]) for k in range(KEYS)]
            keys = np.stack(keys + [_chain(least[list(x)]) for x in PAIRS_OF_HASHES], axis=1).view(np.int64)
            parity = parities(value, first)
            held = np.append(0, np.cumsum(take)) * 4
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(n.astype(np.int64)), pa.array(set_names(value, first)), pa.array(rare), binary(prefix.astype("<u4").view(np.uint8), held),
                 _lists(keys), parity],
                ["doc_id", "n", "name", "rare", "prefix", "keys", "parity"],
            )
        K.release()

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n long, name long, rare long, prefix binary, keys array<long>, parity array<long>")


def _chain(hashes: np.ndarray) -> np.ndarray:
    out = np.zeros(hashes.shape[1], np.uint64)
    for h in hashes:
        out = out * _P + h
    return K.mix(out)


def parities(value: np.ndarray, first: np.ndarray) -> pa.Array:
    """For each set the parities of its elements by hash, in at least two places for each element: longs of 64 places."""
    n, row = np.diff(first), K.row_of(first)
    bits = np.maximum(PARITY_BITS, 2 << np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64))
    start = np.append(0, np.cumsum(bits))
    odd = np.bincount(start[row] + (value & (bits[row] - 1).astype(np.uint64)).astype(np.int64), minlength=start[-1]) & 1
    words = np.packbits(odd.astype(np.uint8)).view(np.int64)
    return pa.ListArray.from_arrays(pa.array((start // 64).astype(np.int32)), pa.array(words))


def _lists(rows: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]), pa.array(rows.ravel()))


def maybe_among(df: DataFrame, column: Column, ids: DataFrame, name: str) -> DataFrame:
    """``df`` with ``name``: whether ``column`` may be among ``ids`` (one column); false is certain.

    A bitmap of fixed size, however many ids there are: ``BITMAP_BITS`` bits in rows of
    4 KB, which every task gets whole, so nothing of ``df`` is shuffled.
    """
    place = F.pmod(F.xxhash64(F.col(ids.columns[0]).cast("long")), F.lit(BITMAP_BITS)).alias("place")
    bits = ids.select(place).groupBy(F.bitmap_bucket_number("place").alias("_bucket"))
    bits = bits.agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("_bits"))
    hashed = F.pmod(F.xxhash64(F.coalesce(column.cast("long"), F.lit(0).cast("long"))), F.lit(BITMAP_BITS))
    held = df.withColumn("_place", hashed).join(F.broadcast(bits), F.bitmap_bucket_number("_place") == F.col("_bucket"), "left")
    bit = F.bitmap_bit_position("_place")
    byte = F.conv(F.hex(F.substring("_bits", (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    mask = F.call_function("shiftleft", F.lit(1), (bit % 8).cast("int"))
    return held.withColumn(name, F.coalesce(byte.bitwiseAND(mask) > 0, F.lit(False))).drop("_place", "_bucket", "_bits")


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of one document of each group: that with the smallest id; equal rows of one id once.

    Rows with a null id or without shingles stay. Only rows that may go are
    shuffled. Of an id that stands on several texts only the rows of those go that
    have a smaller id.
    """
    joined = stored(_joined(docs, id_col, text_col), f"{work_dir(docs.sparkSession, 'groups')}/components")
    gone = joined.where("doc_id <> component_id").select("doc_id", F.col("name").alias("gone_name")).distinct()
    again = joined.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 AND doc_id IS NOT NULL").select("doc_id")
    odd = f"_{len(docs.columns)}"
    flat = docs.toDF(*[f"_{k}" for k in range(len(docs.columns))])
    own = F.col(f"_{docs.columns.index(id_col)}")
    text = F.col(f"_{docs.columns.index(text_col)}")
    flat = maybe_among(flat, own, gone.select("doc_id").unionAll(again), odd).withColumn(odd, own.isNotNull() & F.col(odd))
    checked = flat.where(F.col(odd)).join(again.select(F.col("doc_id").alias("again")), own == F.col("again"), "left")
    checked = annotate(checked.withColumn("named", F.when(F.col("again").isNotNull(), text.cast("string"))), "named", _names, NAME)
    mine = F.col("again").isNull() | (F.col("name") == F.col("gone_name"))
    checked = checked.join(gone, (own == F.col("doc_id")) & mine, "left_anti").drop("again", "named", "name")
    checked = checked.withColumn(odd, F.sha2(F.coalesce(text, F.lit("")), 256)).dropDuplicates([f"_{docs.columns.index(id_col)}", odd])
    return flat.where(~F.col(odd)).drop(odd).unionAll(checked.drop(odd)).toDF(*docs.columns)


NAME = T.StructType([T.StructField("name", T.LongType())])


def _names(batches: Iterator[pa.RecordBatch], place: int) -> Iterator[tuple[pa.RecordBatch, list]]:
    for part in K.slices(batches, place):
        yield part, [pa.array(set_names(*sets(part.column(place))))]


def overlaps(docs: DataFrame, pairs: DataFrame, one: DataFrame, folder: str) -> DataFrame:
    """Sizes and overlap of each pair (a, b) of sets: the set of b meets those of all its a, of many a in several tasks.

    The text of a set comes from the document that stands for it and is sent
    straight to the tasks that compare it.
    """
    many = pairs.groupBy(F.col("b").alias("of")).agg(F.ceil(F.count("*") / MEMBERS_PER_TASK).alias("tasks"))
    pairs = pairs.join(many, F.col("b") == F.col("of")).withColumn("task", F.pmod(F.xxhash64("a"), F.col("tasks")))
    heads = many.select(
        F.col("of").alias("name"), F.col("of").alias("b"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("tasks") - 1)).alias("task"), F.lit(None).cast("long").alias("a")
    )
    roles = heads.unionByName(pairs.select(F.col("a").alias("name"), "b", "task", "a")).join(one.select("name", F.col("doc_id").alias("of_doc")), "name")
    roles = stored(roles, f"{folder}/roles")
    held = maybe_among(docs.where("doc_id IS NOT NULL"), F.col("doc_id"), roles.select("of_doc"), "maybe").where("maybe")
    rows = held.join(roles, F.col("doc_id") == F.col("of_doc")).select("b", "task", "a", "name", "text")
    rows = rows.repartition("b", "task").sortWithinPartitions("b", "task", F.col("a").asc_nulls_first())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met, head, seen = None, np.zeros(0, np.uint64), None
        for part in K.slices(batches, 4):
            value, first = sets(part.column(4))
            same = set_names(value, first) == part.column(3).to_numpy()  # an id may stand on several texts
            out = []
            for k, (b, t, a) in enumerate(zip(*(part.column(c).to_pylist() for c in range(3)), strict=True)):
                if not same[k] or (b, t, a) == seen:
                    continue
                seen, own = (b, t, a), value[first[k] : first[k + 1]]
                if a is None:
                    met, head = (b, t), own
                elif (b, t) == met:
                    at = np.minimum(np.searchsorted(head, own), max(len(head) - 1, 0))
                    out.append((a, b, len(own), len(head), int((head[at] == own).sum()) if len(head) else 0))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out, strict=True)], ["a", "b", "na", "nb", "both"])

    return rows.mapInArrow(run, "a long, b long, na long, nb long, both long")


def similar(both: Column, na: Column, nb: Column) -> Column:
    return 100 * both >= 80 * (na + nb - both)


def possible(pairs: DataFrame, one: DataFrame) -> DataFrame:
    """Pairs (a, b) with ``possible``: false where the parities of their elements by hash differ in more places than their sets may."""
    for side in ("a", "b"):
        own = one.select(F.col("name").alias(f"of_{side}"), F.col("n").alias(f"n_{side}"), F.col("parity").alias(f"parity_{side}"))
        pairs = pairs.join(own, F.col(side) == F.col(f"of_{side}"))
    # the number of places doubles with the size; where it differs by one step, the longer list is folded once
    least = F.least(F.size("parity_a"), F.size("parity_b"))

    def folded(c: str) -> Column:
        halves = F.zip_with(F.slice(c, F.lit(1), least), F.slice(c, least + 1, least), lambda x, y: x.bitwiseXOR(y))
        return F.when(F.size(c) == least, F.col(c)).otherwise(halves)

    differ = F.aggregate(F.zip_with(folded("parity_a"), folded("parity_b"), lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, n: s + n)
    total = F.col("n_a") + F.col("n_b")
    # lists two steps apart belong to sets of which one is more than twice as large
    near = F.greatest(F.size("parity_a"), F.size("parity_b")) <= 2 * least
    return pairs.withColumn("possible", near & (9 * (total - differ) >= 8 * total)).drop("of_a", "of_b", "n_a", "n_b", "parity_a", "parity_b")


def clusters(docs: DataFrame, one: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """Components of the links found by equal keys, as stars, and every set of two or more linked ones with its root and the sizes of both differences.

    First every set meets the smallest name of the key group it is in most often;
    then, in rounds, sets not yet connected meet one of about ``MET_TOGETHER``
    sets of each of their key groups, others in every round. Pairs are in
    proportion to sets, however large a group is.
    """
    keyed = one.select("name", F.posexplode("keys").alias("k", "key"))
    sizes = stored(keyed.groupBy("k", "key").agg(F.min("name").alias("leader"), F.count("*").alias("n")).where("n > 1"), f"{folder}/key-groups")
    votes = keyed.where(F.col("k") < KEYS).join(sizes, ["k", "key"]).where("name <> leader").groupBy("name", "leader").agg(F.count("*").alias("n"))
    chosen = votes.groupBy("name").agg(F.max_by("leader", F.struct(F.col("n"), -F.col("leader"))).alias("leader"))
    pairs = chosen.select(F.col("name").alias("a"), F.col("leader").alias("b"))
    links, roots = None, None
    for turn in range(ROUNDS + 1):
        pairs = stored(possible(pairs, one).where("possible").drop("possible"), f"{folder}/pairs-{turn}")
        found = overlaps(docs, pairs, one, f"{folder}/met-{turn}").where(similar(F.col("both"), F.col("na"), F.col("nb")))
        found = stored(found, f"{folder}/links-{turn}")
        if turn and found.isEmpty():
            break
        links = found if links is None else links.unionAll(found)
        joined = found if roots is None else stars(roots).unionAll(found.select("a", "b"))
        roots = stored(components(joined, f"{folder}/components-1-{turn}"), f"{folder}/roots-{turn}")
        own = roots.select(F.col("node").alias("of"), "root")
        placed = keyed.join(sizes.select("k", "key", "n"), ["k", "key"]).withColumn("part", F.pmod(F.xxhash64("name", F.lit(turn)), F.ceil(F.col("n") / MET_TOGETHER)))
        placed = placed.join(own, F.col("name") == F.col("of"), "left").select("k", "key", "part", "name", F.coalesce("root", "name").alias("root"))
        placed = stored(placed, f"{folder}/placed-{turn}")
        heads = placed.groupBy("k", "key", "part").agg(F.min(F.struct("name", "root")).alias("head"))
        pairs = placed.join(stored(heads, f"{folder}/heads-{turn}"), ["k", "key", "part"]).where("root <> head.root")
        pairs = pairs.select(F.greatest("name", "head.name").alias("a"), F.least("name", "head.name").alias("b")).distinct()
    # of a large cluster the set with the fewest shingles of its own is the root: the others differ least from it
    own = one.select(F.col("name").alias("of"), "rare")
    middle = roots.join(own, F.col("node") == F.col("of")).groupBy("root").agg(F.count("*").alias("n"), F.min(F.struct("rare", "node")).alias("least"))
    middle = middle.select("root", F.when(F.col("n") > MET_TOGETHER, F.col("least.node")).otherwise(F.col("root")).alias("b"))
    members = roots.join(middle, "root").where("node <> b").select(F.col("node").alias("a"), "b")
    links = links.select("a", "b", "na", "nb", "both")
    known = members.join(links.unionAll(links.select("b", "a", "nb", "na", "both")).dropDuplicates(["a", "b"]), ["a", "b"])
    rest = stored(members.join(known, ["a", "b"], "left_anti"), f"{folder}/far-members")
    diffs = known.select("a", "b", "na", "nb", "both").unionAll(overlaps(docs, rest, one, f"{folder}/met-far").select("a", "b", "na", "nb", "both"))
    diffs = diffs.select(F.col("a").alias("name"), F.col("b").alias("root"), F.col("na").alias("n"), (F.col("na") - F.col("both")).alias("extra"))
    return stars(roots), stored(diffs, f"{folder}/members")


def stars(roots: DataFrame) -> DataFrame:
    """Edges (a, b) from every other node to its root: of the same components, with nothing left to follow."""
    return roots.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))


def candidates(one: DataFrame, members: DataFrame) -> DataFrame:
    """Pairs of clusters (their roots) that meet in a prefix shingle and whose sizes and remaining lengths allow a link."""
    own = members.select(F.col("name").alias("of"), "root")
    placed = one.select("name", "n", "prefix").join(own, F.col("name") == F.col("of"), "left")
    placed = placed.select(F.coalesce("root", "name").alias("root"), "n", "prefix")

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in K.slices(batches, 2, 1 << 20):
            root, n = (part.column(k).to_numpy() for k in range(2))
            raw, at = K.flat(part.column(2))
            value, first = np.ascontiguousarray(raw).view("<u4").astype(np.int64), at // 4
            row = K.row_of(first)
            rest = n[row] - (np.arange(len(value)) - first[row])
            order = np.lexsort((root[row], value))
            value, row, rest = value[order], row[order], rest[order]
            group, size = root[row], n[row]
            head = np.ones(len(value), bool)
            head[1:] = (value[1:] != value[:-1]) | (group[1:] != group[:-1])
            heads = np.flatnonzero(head)
            if len(heads):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(value[heads]), pa.array(group[heads]), pa.array(np.minimum.reduceat(size, heads)),
                     pa.array(np.maximum.reduceat(size, heads)), pa.array(np.maximum.reduceat(rest, heads))],
                    ["value", "root", "least", "most", "rest"],
                )

    postings = placed.mapInArrow(emit, "value long, root long, least long, most long, rest long")
    postings = postings.repartition("value").sortWithinPartitions("value", "least", "root")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = [np.zeros(0, np.int64)] * 5
        for part in _and_end(batches):
            rows = held if part is None else [np.concatenate([h, c.to_numpy()]) for h, c in zip(held, part.columns, strict=True)]
            whole = len(rows[0]) if part is None else int(np.searchsorted(rows[0], rows[0][-1])) if len(rows[0]) else 0
            held = [r[whole:] for r in rows]
            yield from _pairs(*(r[:whole] for r in rows))

    return postings.mapInArrow(meet, "a long, b long").distinct()


def _and_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def _pairs(value: np.ndarray, root: np.ndarray, least: np.ndarray, most: np.ndarray, rest: np.ndarray, block: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Pairs of entries of each list, sorted by size: an entry meets the following ones up to the last size in its reach."""
    if not len(value):
        return
    start = np.flatnonzero(np.append(True, value[1:] != value[:-1]))
    count = np.diff(np.append(start, len(value)))
    shared = np.repeat(count > 1, count)
    value, root, least, most, rest = (x[shared] for x in (value, root, least, most, rest))
    if not len(value):
        return
    for left, right in _within_reach(value, root, least, most, rest, block):
        a, b = np.maximum(root[left], root[right]), np.minimum(root[left], root[right])
        if len(a):
            pairs = np.unique(np.stack([a, b], axis=1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])


def _within_reach(value: np.ndarray, apart: np.ndarray, least: np.ndarray, most: np.ndarray, rest: np.ndarray, block: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of two entries of one list that differ in ``apart`` and whose sizes and remaining lengths allow a link; lists are sorted by least size."""
    # the last entry of the same list whose least size is within most / 0.8
    _, number = np.unique(value, return_inverse=True)
    width = int(least.max()) * 2 + 4
    reach = np.searchsorted(number * width + least, number * width + np.minimum(most * 5 // 4, width - 1), side="right")
    for left, right in _blocks(np.arange(len(value)) + 1, np.maximum(reach - np.arange(len(value)) - 1, 0), block):
        good = (apart[left] != apart[right]) & (5 * most[right] >= 4 * least[left])
        good &= np.minimum(rest[left], rest[right]) >= needed(least[left], least[right])
        yield left[good], right[good]


def _blocks(start: np.ndarray, count: np.ndarray, block: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Each k with start[k] .. start[k] + count[k] - 1, about ``block`` pairs or those of one k at a time."""
    ends, at = np.cumsum(count), 0
    while at < len(count):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + block, side="right")))
        yield np.repeat(np.arange(at, stop), count[at:stop]), K.ragged(start[at:stop], count[at:stop])
        at = stop


def member_pairs(one: DataFrame, inside: DataFrame) -> DataFrame:
    """Pairs (p, q) of sets of two clusters that are not connected, where the sets themselves meet in a prefix shingle and may be similar.

    ``inside`` has name, root of the cluster, what of it is connected (``part``) and
    ``extra``. Clusters meet as wholes first; inside one nothing is compared.
    """
    placed = inside.select(F.col("name").alias("of"), "root", "part", "extra").join(one.select("name", "n", "prefix"), F.col("of") == F.col("name"))
    placed = placed.select("prefix", "root", "part", "name", "n", "extra")

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in K.slices(batches, 0, 1 << 20):
            raw, at = K.flat(part.column(0))
            value, first = np.ascontiguousarray(raw).view("<u4").astype(np.int64), at // 4
            row = K.row_of(first)
            own = [part.column(k).to_numpy()[row] for k in range(1, 6)]
            rest = own[3] - (np.arange(len(value)) - first[row])
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (value, *own, rest)], _POSTING)

    postings = placed.mapInArrow(emit, ", ".join(f"{c} long" for c in _POSTING))
    postings = postings.repartition("value").sortWithinPartitions("value", "root", "name")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = [np.zeros(0, np.int64)] * len(_POSTING)
        for part in _and_end(batches):
            rows = held if part is None else [np.concatenate([h, c.to_numpy()]) for h, c in zip(held, part.columns, strict=True)]
            whole = len(rows[0]) if part is None else int(np.searchsorted(rows[0], rows[0][-1])) if len(rows[0]) else 0
            held = [r[whole:] for r in rows]
            yield from _member_pairs(*(r[:whole] for r in rows))

    return postings.mapInArrow(meet, ", ".join(f"{c} long" for c in _MET)).distinct()


_POSTING = ["value", "root", "part", "name", "n", "extra", "rest"]
_MET = ["a", "b", "p", "q", "n_p", "n_q", "extra_p", "extra_q"]


def _member_pairs(
    value: np.ndarray, root: np.ndarray, part: np.ndarray, name: np.ndarray, n: np.ndarray, extra: np.ndarray, rest: np.ndarray, block: int = 1 << 20
) -> Iterator[pa.RecordBatch]:
    """Of each list, sorted by cluster, the sets of clusters that meet as wholes, one set against a cluster and then against its sets."""
    if not len(value):
        return
    start = np.flatnonzero(np.append(True, (value[1:] != value[:-1]) | (root[1:] != root[:-1])))
    least, most, longest = np.minimum.reduceat(n, start), np.maximum.reduceat(n, start), np.maximum.reduceat(rest, start)
    count = np.diff(np.append(start, len(value)))
    by = np.lexsort((least, value[start]))
    start, count, least, most, longest = (x[by] for x in (start, count, least, most, longest))
    for left, right in _within_reach(value[start], part[start], least, most, longest, block):
        for k, p in _blocks(start[left], count[left], block):
            other = right[k]
            good = (rest[p] >= needed(n[p], least[other])) & (5 * most[other] >= 4 * n[p]) & (5 * n[p] >= 4 * least[other])
            p, other = p[good], other[good]
            for j, q in _blocks(start[other], count[other], block):
                good = np.minimum(rest[p[j]], rest[q]) >= needed(n[p[j]], n[q])
                x, y = p[j][good], q[good]
                if len(x):
                    x, y = np.where(root[x] > root[y], x, y), np.where(root[x] > root[y], y, x)
                    made = [root[x], root[y], name[x], name[y], n[x], n[y], extra[x], extra[y]]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in made], _MET)


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest id reachable by links)."""
    return _joined(docs, id_col, text_col).drop("name")


def _joined(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``join`` with the name of each document's set."""
    docs = pick(docs, doc_id=(id_col, "long"), text=(text_col, "string"))
    folder = work_dir(docs.sparkSession, "ngram-join")
    described = stored(describe(docs, frequent(docs)), f"{folder}/sets")
    held = described.where("n > 0 AND doc_id IS NOT NULL")
    one = held.groupBy("name").agg(F.min(F.struct("doc_id", "n", "rare", "prefix", "keys", "parity")).alias("x")).select("name", "x.*")
    one = stored(one, f"{folder}/one")
    together, members = clusters(docs, one, folder)
    pairs = possible(stored(candidates(one, members), f"{folder}/candidates"), one)
    heads = members.select(F.col("root").alias("head")).distinct().withColumn("many", F.lit(True))
    for side in ("a", "b"):  # of a cluster the root says nothing yet about the others
        pairs = pairs.join(heads.select(F.col("head").alias("h"), F.col("many").alias(f"many_{side}")), F.col(side) == F.col("h"), "left").drop("h")
    pairs = stored(pairs.where("possible OR many_a OR many_b").select("a", "b"), f"{folder}/pairs")
    met = stored(overlaps(docs, pairs, one, f"{folder}/met-roots"), f"{folder}/met")
    linked = met.where(similar(F.col("both"), F.col("na"), F.col("nb"))).select("a", "b")
    roots = stored(components(together.unionAll(linked), f"{folder}/components-2"), f"{folder}/all-roots")

    # pairs of clusters that the roots do not decide, and that are not in one component anyway
    spans = members.groupBy(F.col("root").alias("of")).agg(F.min("n").alias("least"), F.max("n").alias("most"), F.max("extra").alias("extra"))
    spans = stored(spans, f"{folder}/spans")
    open_ = met.where(~similar(F.col("both"), F.col("na"), F.col("nb")))
    for side in ("a", "b"):
        s = spans.select(F.col("of").alias(f"of_{side}"), F.col("least").alias(f"least_{side}"), F.col("extra").alias(f"extra_{side}"))
        open_ = open_.join(s, F.col(side) == F.col(f"of_{side}"), "left")
        open_ = open_.withColumn(f"least_{side}", F.least(F.col(f"n{side}"), f"least_{side}")).fillna(0, [f"extra_{side}"])
    total = F.col("least_a") + F.col("least_b")
    open_ = open_.where("of_a IS NOT NULL OR of_b IS NOT NULL").where(9 * (F.col("both") + F.col("extra_a") + F.col("extra_b")) >= 4 * total)
    for side in ("a", "b"):
        open_ = open_.join(roots.select(F.col("node").alias(f"in_{side}"), F.col("root").alias(f"root_{side}")), F.col(side) == F.col(f"in_{side}"), "left")
    open_ = open_.where(F.coalesce("root_a", "a") != F.coalesce("root_b", "b"))
    open_ = stored(open_.select("a", "b", "na", "nb", "both"), f"{folder}/open")
    if not open_.isEmpty():
        heads = open_.select(F.col("a").alias("head")).unionAll(open_.select("b")).distinct()
        heads = heads.join(roots, F.col("head") == F.col("node"), "left").select("head", F.coalesce("root", "head").alias("part"))
        heads = stored(heads, f"{folder}/open-heads")
        inside = members.join(heads, F.col("root") == F.col("head")).select("name", "root", "part", "extra")
        inside = inside.unionAll(heads.select("head", "head", "part", F.lit(0).cast("long")))
        inner = member_pairs(one, inside).join(open_.select("a", "b", "both"), ["a", "b"]).where("p <> a OR q <> b")
        inner = inner.where(9 * (F.col("both") + F.col("extra_p") + F.col("extra_q")) >= 4 * (F.col("n_p") + F.col("n_q")))
        inner = inner.select(F.greatest("p", "q").alias("a"), F.least("p", "q").alias("b")).distinct()
        inner = stored(possible(inner, one).where("possible").drop("possible"), f"{folder}/inner")
        inner_met = stored(overlaps(docs, inner, one, f"{folder}/met-inner"), f"{folder}/inner-met")
        more = inner_met.where(similar(F.col("both"), F.col("na"), F.col("nb"))).select("a", "b")
        if not more.isEmpty():
            roots = stored(components(stars(roots).unionAll(more), f"{folder}/components-3"), f"{folder}/last-roots")

    of = roots.select(F.col("node").alias("of"), "root")
    placed = stored(one.select("name", "doc_id").join(of, F.col("name") == F.col("of"), "left"), f"{folder}/placed")
    first = placed.groupBy(F.coalesce("root", "name").alias("group")).agg(F.min("doc_id").alias("component_id"))
    first = stored(first, f"{folder}/first")
    by_name = placed.withColumn("group", F.coalesce("root", "name")).join(first, "group").select(F.col("name").alias("of"), "component_id")
    by_name = stored(by_name, f"{folder}/by-name")
    out = described.select("doc_id", "n", "name").join(by_name, (F.col("name") == F.col("of")) & F.col("doc_id").isNotNull() & (F.col("n") > 0), "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), "name")
