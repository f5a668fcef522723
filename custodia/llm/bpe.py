"""Byte-level BPE: recursive SQL over token positions encodes, an ordered aggregate decodes.

Each Spark task keeps one in-memory DuckDB. A slice of texts is cut into
pre-tokens; those not seen before by the task become rows (word, position,
token). A recursive query joins neighbouring tokens with the merge table and
contracts, in every word, the leftmost pair of the smallest rank, until no pair
of any word is in the table. Ids of a text are the ids of its pre-tokens in
order. Decoding joins ids with the vocabulary and aggregates the bytes by
position.

Nulls and empty texts have no ids and decode to nothing. Repeated rows and
repeated ids each give their own row. Texts are never cut; memory is bounded by
a slice (1 MB of text, or one longer text), a cache of ``CACHE_WORDS`` words and
``STATE_ROWS`` rows of recursion. A single pre-token of n symbols that has no
repeats costs time in the order of n squared.
"""

from __future__ import annotations

import base64
import contextlib
from collections.abc import Callable, Iterator
from pathlib import Path

import duckdb
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custodia.llm import kernels as K
from custodia.llm.common import binary, pick

SLICE_BYTES = 1 << 20
CACHE_WORDS = 400_000
BATCH_WORDS = 12_000
STATE_ROWS = 2_000_000

_CONTRACT = """
WITH RECURSIVE state(w, pos, tok, done, step) AS (
  SELECT w, pos, tok, false, 0 FROM start_rows
  UNION ALL
  (WITH paired AS (
     SELECT w, pos, tok, step, CASE WHEN lead(w) OVER () = w THEN tok::BIGINT * 65536 + lead(tok) OVER () END AS pair
     FROM state WHERE NOT done AND step < $limit),
   ranked AS (
     SELECT p.w, p.pos, p.tok, p.step, m.rank, m.every FROM paired p LEFT JOIN merges m USING (pair)),
   best AS (
     SELECT w, min(rank) AS rank, min((rank::BIGINT << 32) + pos) & 4294967295 AS leftmost
     FROM ranked WHERE rank IS NOT NULL GROUP BY w),
   hits AS (
     SELECT r.w, r.pos, r.tok, r.step, r.rank, b.w IS NULL AS done, row_number() OVER () AS n,
            coalesce(r.rank = b.rank AND (r.every OR r.pos = b.leftmost), false) AS hit
     FROM ranked r LEFT JOIN best b USING (w)),
   taken AS (
     SELECT *, hit AND (n - coalesce(max(CASE WHEN NOT hit THEN n END)
                                     OVER (ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0)) % 2 = 1 AS take
     FROM hits),
   kept AS (
     SELECT *, coalesce(lag(take) OVER (), false) AS inside FROM taken)
   SELECT w, pos, CASE WHEN take THEN rank ELSE tok END, done, step + 1 FROM kept WHERE NOT inside)
)
SELECT w, pos, tok, done FROM state WHERE done OR step = $limit ORDER BY w, pos
"""

_DECODE = """
SELECT d.doc, coalesce(unhex(string_agg(v.piece, '' ORDER BY i.pos)), ''::BLOB) AS bytes, count(v.id) AS n
FROM range($docs) d(doc) LEFT JOIN (id_rows i JOIN vocab v ON v.id = i.id) ON i.doc = d.doc
GROUP BY d.doc ORDER BY d.doc
"""


def read_ranks(vocabulary: bytes) -> dict[bytes, int]:
    """A vocabulary file's content: base64 of the bytes and the rank on each line."""
    return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, vocabulary.splitlines())}


class Tables:
    """The merge table and the vocabulary of one task, with the words it has encoded."""

    def __init__(self, ranks: dict[bytes, int]):
        left, right, rank, early = [], [], [], set()
        for piece, r in ranks.items():
            for cut in range(1, len(piece)):
                a, b = ranks.get(piece[:cut]), ranks.get(piece[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    rank.append(r)
                    early.update(x for x in (a, b) if r < x)
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "512MB", "temp_directory": ""})
        # Where nothing built on a token ranks before it, all its occurrences can be contracted in one step.
        merges = pa.table({
            "pair": np.array(left, np.int64) * 65536 + np.array(right, np.int64),
            "rank": np.array(rank, np.int32),
            "every": np.array([r not in early for r in rank], bool),
        })
        vocab = pa.table({"id": pa.array(list(ranks.values()), pa.int32()), "piece": [p.hex() for p in ranks]})
        for name, rows in (("merges", merges), ("vocab", vocab)):
            self.con.register("given", rows)
            self.con.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
            self.con.unregister("given")
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.pieces = K.PieceIds(self._learn, CACHE_WORDS, np.int32)

    def contract(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces behind one another, and how many each has."""
        sizes = np.array([len(p) for p in pieces], np.int64)
        tok = self.byte_id[np.frombuffer(b"".join(pieces), np.uint8)]
        word = np.repeat(np.arange(len(pieces), dtype=np.int32), sizes)
        pos = K.ragged(np.zeros(len(sizes), np.int64), sizes).astype(np.int32)
        ended = []
        while len(word):
            self.con.register("start_rows", pa.table({"w": word, "pos": pos, "tok": tok}))
            limit = max(4, STATE_ROWS // len(word))
            rows = self.con.sql(_CONTRACT, params={"limit": limit}).to_arrow_table()
            word, pos, tok, done = (rows.column(k).to_numpy() for k in range(4))
            ended.append((word[done], pos[done], tok[done]))
            word, pos, tok = word[~done], pos[~done], tok[~done]
        word, pos, tok = (np.concatenate(x) for x in zip(*ended, strict=True))
        order = np.lexsort((pos, word))
        return tok[order].astype(np.int32), np.bincount(word, minlength=len(pieces))

    def _learn(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        data = [p.encode() for p in pieces]
        ids, count = zip(*(self.contract(data[at : at + BATCH_WORDS]) for at in range(0, len(data), BATCH_WORDS)), strict=True)
        return np.concatenate(ids), np.concatenate(count)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts behind one another, and the n + 1 offsets."""
        return self.pieces.encode(texts)

    def decode(self, ids: np.ndarray, at: np.ndarray) -> pa.Array:
        """The bytes of each document's ids."""
        doc = np.repeat(np.arange(len(at) - 1, dtype=np.int64), np.diff(at))
        self.con.register("id_rows", pa.table({"doc": doc, "pos": np.arange(len(ids)), "id": ids.astype(np.int32)}))
        rows = self.con.sql(_DECODE, params={"docs": len(at) - 1}).to_arrow_table()
        if int(rows.column("n").to_numpy().sum()) != len(ids):
            raise ValueError("an id is not in the vocabulary")
        return rows.column("bytes").combine_chunks().cast(pa.binary())


@contextlib.contextmanager
def tables_of(vocabulary: bytes) -> Iterator[Tables]:
    """The tables of one task; their memory is given back when it ends."""
    tables = Tables(read_ranks(vocabulary))
    try:
        yield tables
    finally:
        tables.con.close()
        vars(tables).clear()  # the caller still holds the object while memory is given back
        K.release()


def encode(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id and ``ids``, little-endian unsigned 32-bit integers."""
    return _run(docs, vocab_path, id_col, text_col, "string", _encode)


def decode(encoded: DataFrame, vocab_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row per document: its id, ``ids`` and ``decoded``, the bytes of its ids; null ids decode to nothing."""
    return _run(encoded, vocab_path, id_col, ids_col, "binary", _decode)


def round_trip(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``decode(encode(docs))`` in the same tasks, with one pair of tables instead of two."""
    return _run(docs, vocab_path, id_col, text_col, "string", lambda tables, column: _decode(tables, _encode(tables, column)[0]))


def _encode(tables: Tables, texts: pa.Array) -> list[pa.Array]:
    ids, at = tables.encode(texts.fill_null("").to_pylist())
    return [binary(ids.astype("<u4").view(np.uint8), at * 4)]


def _decode(tables: Tables, ids: pa.Array) -> list[pa.Array]:
    raw, at = K.flat(ids)
    return [ids, tables.decode(np.ascontiguousarray(raw).view("<u4"), at // 4)]


def _run(df: DataFrame, vocab_path: str, id_col: str, column: str, kind: str, work: Callable[[Tables, pa.Array], list[pa.Array]]) -> DataFrame:
    vocabulary = df.sparkSession.sparkContext.broadcast(Path(vocab_path).read_bytes())
    df = pick(df, doc_id=(id_col, _kind(df, id_col)), value=(column, kind))
    names = ["ids"] if work is _encode else ["ids", "decoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with tables_of(vocabulary.value) as tables:
            for part in K.slices(batches, 1, SLICE_BYTES):
                yield pa.RecordBatch.from_arrays([part.column(0), *work(tables, part.column(1))], ["doc_id", *names])

    out = df.mapInArrow(run, f"doc_id {_kind(df, 'doc_id')}, " + ", ".join(f"{n} binary" for n in names))
    return out.withColumnRenamed("doc_id", id_col)


def _kind(df: DataFrame, column: str) -> str:
    return next(kind for name, kind in df.dtypes if name == column)


def digests(decoded: DataFrame) -> DataFrame:
    return decoded.select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
