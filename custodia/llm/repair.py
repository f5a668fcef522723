"""Token ids as grammar-compressed shard files: Re-Pair rules with expansion lengths, random access by document.

Documents are range-partitioned by id, so shards follow one another in ascending
order. A task tokenizes its texts, appends the end id to each document and
closes a shard after ``shard_ids`` ids. In a shard, rounds of Re-Pair replace
frequent neighbouring ids by nonterminals: a round counts pairs in hash bins, takes
a pair of each of the fullest bins as a rule and replaces its occurrences, the more
frequent of two overlapping ones first; the next round hashes anew, so a pair
behind another one of its bin gets its own. When the bins give few rules, the pairs of
all bins that are full enough are counted exactly. Rounds end when no pair is left ``LEAST_COUNT`` times or the numbers
up to 65,535 are used up. A pair never crosses the end of a document, so any
document, or any of its ids by the expansion lengths, can be decoded alone.

Shard file, little-endian: ``RPG1``, five uint32 (first nonterminal, rules,
symbols, documents, ids), then arrays: document ids int64, their null flags
uint8, first symbol of each document and the end uint32, first id of each
document and the end uint32, rules as two uint16 each, expansion length of each
rule uint32, symbols uint16.

Null and empty texts are the end id alone. Null document ids come first; equal
ids are ordered by their text. Texts are never cut: a shard holds whole
documents, and memory is bounded by a slice of texts and a shard.
"""

from __future__ import annotations

import functools
import itertools
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from custodia.llm import kernels as K
from custodia.llm.common import binary, pick
from custodia.llm.files import attempt_name, get, put, spread

MAGIC = b"RPG1"
SHARD_IDS = 2_000_000
RULES_PER_ROUND = 2_500
LEAST_COUNT = 12
BINS_LOG = 19
CACHE_WORDS = 400_000


def _byte_letters() -> dict[int, int]:
    """The letter that stands for each byte in byte-level vocabularies: itself, if it is visible, else the next one from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {**{b: b for b in visible}, **{b: 256 + k for k, b in enumerate(hidden)}}


@functools.lru_cache(maxsize=1)
def pieces_of(tokenizer_json: str) -> K.PieceIds:
    """The tokenizers library with the pre-tokens that this Python worker has met."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    library = Tokenizer.from_str(tokenizer_json)
    library.encode_special_tokens = True

    plan = json.loads(tokenizer_json)
    before = plan.get("pre_tokenizer") or {}
    # pre-tokens as they are go to the model, if nothing else of the library would touch them
    direct = before.get("type") == "ByteLevel" and not before.get("add_prefix_space") and not plan.get("normalizer") and plan["model"]["type"] == "BPE"
    direct = direct and all(t.get("special") for t in plan.get("added_tokens") or [])
    letters, tokenize = _byte_letters(), library.model.tokenize

    def learn(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if direct:
            found = [[t.id for t in tokenize(p.encode().decode("latin-1").translate(letters))] for p in pieces]
        else:
            found = [x.ids for x in library.encode_batch_fast(pieces, add_special_tokens=False)]
        count = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(itertools.chain.from_iterable(found), np.uint16, int(count.sum())), count

    return K.PieceIds(learn, CACHE_WORDS, np.uint16)


def compress(ids: np.ndarray, last: np.ndarray, first_rule: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rules (n, 2), their expansion lengths and the symbols that remain; ``last`` marks the last id of a document."""
    if first_rule > 1 << 16 or (len(ids) and int(ids.max()) >= first_rule):
        raise ValueError("ids must be below the first rule, and that at most 65,536")
    seq, closed = ids.astype(np.uint32), last.copy()
    rules, sizes = np.zeros((0, 2), np.uint32), np.ones(first_rule, np.uint32)
    chosen = np.empty((1 << BINS_LOG) + 1, np.int32)
    exact, turn = False, 0
    while True:
        room = min(RULES_PER_ROUND, (1 << 16) - first_rule - len(rules))
        if len(seq) < 2 or room < 1:
            break
        turn += 1
        factor = np.uint32((0x9E3779B1 + 2 * 0x3C6EF372 * turn) & 0xFFFFFFFF)
        bins = (seq[:-1] * factor + seq[1:] * np.uint32(0x85EBCA6B)) >> np.uint32(32 - BINS_LOG)
        bins[closed[:-1]] = 1 << BINS_LOG
        counts = np.bincount(bins, minlength=(1 << BINS_LOG) + 1)
        counts[-1] = 0
        if exact:
            at, which, sample = _frequent_pairs(seq, np.flatnonzero((counts >= LEAST_COUNT)[bins]), room)
            if not len(at):
                break
        else:
            top = np.argpartition(counts[:-1], -room)[-room:]
            top = top[counts[top] >= LEAST_COUNT]
            chosen.fill(-1)
            chosen[top] = np.arange(len(top))
            which = chosen[bins]
            at = np.flatnonzero(which >= 0)
            which = which[at]
            pair = (seq[at].astype(np.uint64) << np.uint64(32)) | seq[at + 1]
            sample = np.zeros(len(top), np.uint64)
            sample[which[::-1]] = pair[::-1]  # the first pair of each bin stands for it
            real = pair == sample[which]
            at, which = at[real], which[real]
            heavy = np.bincount(which, minlength=len(top))[which] >= LEAST_COUNT
            at, which = at[heavy], which[heavy]
            if not len(at):
                exact = True
                continue
        top = sample
        weight = np.bincount(which, minlength=len(top))
        order = weight[which]
        # of occurrences that overlap the more frequent pair counts; of equally frequent ones every second
        near, rise = at[1:] == at[:-1] + 1, np.sign(order[1:] - order[:-1])
        head = np.append(True, ~near | (rise != 0))
        begin = np.flatnonzero(head)
        take = (np.arange(len(at)) - np.repeat(begin, np.diff(np.append(begin, len(at))))) % 2 == 0
        take &= ~np.append(False, near & (rise < 0)) & ~np.append(near & (rise > 0), False)
        at, which = at[take], which[take]
        used = np.flatnonzero(np.bincount(which, minlength=len(top)))
        name = np.zeros(len(top), np.uint32)
        name[used] = np.arange(len(used))
        exact = exact or 2 * len(used) < room
        new = np.stack([sample[used] >> np.uint64(32), sample[used] & np.uint64(0xFFFFFFFF)], axis=1).astype(np.uint32)
        seq[at] = first_rule + len(rules) + name[which]
        rules = np.concatenate([rules, new])
        sizes = np.append(sizes, sizes[new[:, 0]] + sizes[new[:, 1]])
        keep = np.ones(len(seq), bool)
        keep[at + 1] = False
        closed[at] = closed[at + 1]
        seq, closed = seq[keep], closed[keep]
    return rules, sizes[first_rule:], seq


def _frequent_pairs(seq: np.ndarray, at: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the places ``at`` those of the ``room`` most frequent pairs that occur ``LEAST_COUNT`` times, their numbers, and the pairs, counted exactly."""
    pair = (seq[at].astype(np.uint64) << np.uint64(32)) | seq[at + 1]
    every, which, counts = np.unique(pair, return_inverse=True, return_counts=True)
    often = np.flatnonzero(counts >= LEAST_COUNT)
    often = often[np.argsort(-counts[often], kind="stable")[:room]]
    number = np.full(len(every), -1)
    number[often] = np.arange(len(often))
    which = number[which]
    return at[which >= 0], which[which >= 0], every[often]


def expansions(rules: np.ndarray, sizes: np.ndarray, first_rule: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where in one array the ids of each symbol stand, how many they are, and the array; a rule names earlier symbols only."""
    size = np.append(np.ones(first_rule, np.int64), sizes)
    start = np.cumsum(size) - size
    out = np.arange(int(size.sum()))
    for k, (left, right) in enumerate(rules.tolist()):
        at, mid = start[first_rule + k], start[first_rule + k] + size[left]
        out[at:mid] = out[start[left] : start[left] + size[left]]
        out[mid : mid + size[right]] = out[start[right] : start[right] + size[right]]
    return start, size, out.astype(np.uint32)


def pack(doc_ids: pa.Array, ids: np.ndarray, at: np.ndarray, first_rule: int) -> bytes:
    """One shard: ``ids`` of documents behind one another and their n + 1 offsets."""
    last = np.zeros(len(ids), bool)
    last[at[1:] - 1] = True
    rules, sizes, symbols = compress(ids, last, first_rule)
    width = np.append(np.ones(first_rule, np.uint32), sizes)[symbols]
    first_symbol = np.searchsorted(np.cumsum(width), at, side="right")
    first_symbol[0] = 0
    head = np.array([first_rule, len(rules), len(symbols), len(at) - 1, len(ids)], "<u4")
    null = doc_ids.is_null().to_numpy(zero_copy_only=False).astype(np.uint8)
    return b"".join([
        MAGIC, head.tobytes(), doc_ids.fill_null(0).to_numpy().astype("<i8").tobytes(), null.tobytes(), first_symbol.astype("<u4").tobytes(),
        at.astype("<u4").tobytes(), rules.astype("<u2").tobytes(), sizes.astype("<u4").tobytes(), symbols.astype("<u2").tobytes(),
    ])


class Shard:
    """A shard file opened for reading."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a shard file")
        self.first_rule, n_rules, n_symbols, self.docs, self.n_ids = np.frombuffer(data, "<u4", 5, 4).tolist()
        place = 24

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal place
            out = np.frombuffer(data, kind, n, place)
            place += out.nbytes
            return out

        self.doc_ids, self.null = take("<i8", self.docs), take("u1", self.docs)
        self.first_symbol, self.at = take("<u4", self.docs + 1), take("<u4", self.docs + 1).astype(np.int64)
        self.rules, self.sizes = take("<u2", 2 * n_rules).reshape(-1, 2), take("<u4", n_rules)
        self.symbols = take("<u2", n_symbols)
        self.table = expansions(self.rules, self.sizes, self.first_rule)
        if place != len(data):
            raise ValueError("shard file has a wrong length")

    def document(self, k: int) -> np.ndarray:
        """The ids of document k alone."""
        return self.documents(k, k + 1)

    def token(self, k: int, n: int) -> int:
        """Id n of document k, by descending one symbol's rules."""
        symbols = self.symbols[self.first_symbol[k] : self.first_symbol[k + 1]].astype(np.int64)
        size = self.table[1]
        ends = np.cumsum(size[symbols])
        j = int(np.searchsorted(ends, n, side="right"))
        symbol, n = int(symbols[j]), n - int(ends[j] - size[symbols[j]])
        while symbol >= self.first_rule:
            left, right = (int(x) for x in self.rules[symbol - self.first_rule])
            symbol, n = (left, n) if n < size[left] else (right, n - int(size[left]))
        return symbol

    def documents(self, begin: int, stop: int) -> np.ndarray:
        """The ids of documents begin to stop - 1 behind one another."""
        symbols = self.symbols[self.first_symbol[begin] : self.first_symbol[stop]]
        start, size, ids = self.table
        return ids[K.ragged(start[symbols], size[symbols])]


def write(
    spark: SparkSession, docs: DataFrame, folder: str, tokenizer_json: str, first_rule: int, end_id: int = 0,
    id_col: str = "doc_id", text_col: str = "text", shard_ids: int = SHARD_IDS,
) -> DataFrame:
    """Tokenize and write all documents in ascending order; returns the stored list of shards."""
    docs = pick(docs, doc_id=(id_col, "long"), text=(text_col, "string"))
    ordered = docs.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    library = spark.sparkContext.broadcast(tokenizer_json)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, held, total, number = pieces_of(library.value), [], 0, 0

        def close() -> pa.RecordBatch:
            names, parts, ends = zip(*held, strict=True)
            shifts = np.cumsum([0, *(len(p) for p in parts)])
            at = np.concatenate([[0], *(e[1:] + s for e, s in zip(ends, shifts, strict=False))])
            data = pack(pa.concat_arrays(names), np.concatenate(parts), at, first_rule)
            name = attempt_name("ids", number) + ".rpg"
            put(f"{folder}/shards", name, data)
            part = int(name.split("-")[1])
            return pa.RecordBatch.from_pydict(
                {"shard": [name], "part": [part], "number": [number], "ids": [int(at[-1])], "documents": [len(at) - 1], "bytes": [len(data)]}
            )

        for given in K.slices(batches, 1):
            ids, at = words.encode(given.column(1).fill_null("").to_pylist())
            count = np.diff(at)
            ended = np.full(len(ids) + len(count), end_id, np.uint16)
            ended[K.ragged(at[:-1] + np.arange(len(count)), count)] = ids
            held.append((given.column(0), ended, at + np.arange(len(at))))
            total += len(ended)
            if total >= shard_ids:
                yield close()
                held, total, number = [], 0, number + 1
        if held:
            yield close()

    listed = ordered.mapInArrow(run, "shard string, part long, number long, ids long, documents long, bytes long")
    listed.write.parquet(f"{folder}/shard_list")
    return spark.read.parquet(f"{folder}/shard_list")


def shard_starts(listed: DataFrame) -> DataFrame:
    """How many ids stand before each shard: a sum inside its partition and one over the partitions' totals."""
    totals = listed.groupBy("part").agg(F.sum("ids").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    placed = listed.select("shard", "part", F.coalesce(F.sum("ids").over(inside), F.lit(0)).alias("inside"))
    return placed.join(totals, "part").select("shard", (F.col("base") + F.col("inside")).alias("shard_start"))


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Every document of the listed shards: doc_id, start (ids of all documents before), ids (little-endian uint32)."""
    listed = spark.read.parquet(f"{folder}/shard_list")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, shard_start in (row for given in batches for row in zip(*(c.to_pylist() for c in given.columns), strict=True)):
            with get(f"{folder}/shards", name) as stored:
                shard = Shard(stored.read())
            begin = 0
            while begin < shard.docs:
                stop = max(begin + 1, int(np.searchsorted(shard.at, shard.at[begin] + K.SLICE_BYTES // 4, side="right")) - 1)
                ids, at = shard.documents(begin, stop), shard.at[begin : stop + 1]
                if len(ids) != at[-1] - at[0]:
                    raise ValueError("expansion has a wrong length")
                doc_ids = pa.array(shard.doc_ids[begin:stop], mask=shard.null[begin:stop].astype(bool))
                columns = [doc_ids, pa.array(shard_start + at[:-1]), binary(ids.astype("<u4").view(np.uint8), (at - at[0]) * 4)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "ids"])
                begin = stop

    return spread(shard_starts(listed), "shard").mapInArrow(run, "doc_id long, start long, ids binary")
