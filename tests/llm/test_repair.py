"""Shards against the tokenizers library, and grammar by round trip."""

import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from custodia.llm import catalog, repair
from custodia.llm import kernels as K
from custodia.session import work_dir
from tokenizers import Tokenizer

PATH = public_tokenizers.path(catalog.TOKENIZER)


def library_rows(rows):
    library = Tokenizer.from_file(PATH)
    library.encode_special_tokens = True
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def stored_rows(spark, docs, **options):
    folder = work_dir(spark, "repair")
    repair.write(spark, docs, folder, Path(PATH).read_text(encoding="utf-8"), catalog.TOKENIZER_IDS, **options)
    out = [(r.doc_id, r.start, len(r.ids) // 4, zlib.crc32(r.ids)) for r in repair.read(spark, folder).collect()]
    return sorted(out, key=lambda r: r[1])


def test_equals_the_library(spark):
    rows = [(k, t) for k, t in zip(range(40, 0, -3), [
        None, "", "!", "!!!!!! !", " a  b\n\nc's", "the cat sat on the mat. " * 3000, "é\U0001f600東京 <|endoftext|>", "the cat sat", "x" * 4000,
    ], strict=False)] + [(7, "twice"), (7, "twice"), (7, "other"), (None, "no id"), (-5, "first")]
    docs = spark.createDataFrame([(*r, "y", 3) for r in rows], "doc_id long, text string, ids string, Text int")
    assert stored_rows(spark, docs) == library_rows(rows)
    assert stored_rows(spark, docs, shard_ids=1) == library_rows(rows)


def test_grammar():
    rng = np.random.default_rng(3)
    words = [rng.integers(0, 300, size=rng.integers(1, 9)) for _ in range(40)]
    docs = [np.concatenate([*(words[k] for k in rng.integers(0, 40, size=n)), [0]]).astype(np.uint16) for n in rng.integers(0, 400, size=60) if n]
    docs += [np.zeros(5000, np.uint16), np.array([0], np.uint16)]
    at = np.cumsum([0, *map(len, docs)])
    data = repair.pack(pa.array(range(len(docs))), np.concatenate(docs), at, 300)
    shard = repair.Shard(data)
    assert len(shard.symbols) < len(np.concatenate(docs)) / 3 and len(shard.rules)
    for k, doc in enumerate(docs):
        assert shard.document(k).tolist() == doc.tolist()
        for n in (0, len(doc) // 2, len(doc) - 1):
            assert shard.token(k, n) == doc[n]
    assert (shard.sizes == shard.sizes[0]).any() and shard.sizes.min() == 2


def test_empty_table(spark):
    assert stored_rows(spark, spark.createDataFrame([], "doc_id long, text string")) == []


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    out = [tuple(r) for r in catalog.op8_repair(spark, "/root/testdata/sf0.001").collect()]
    assert sorted(out, key=lambda r: r[1]) == library_rows(rows)


def test_no_frequent_pair_is_left():
    """Every pair that still occurs often enough would have been a rule, unless the numbers are used up."""
    rng = np.random.default_rng(5)
    ids = rng.zipf(1.3, 200_000).clip(max=3000).astype(np.uint16)
    last = np.zeros(len(ids), bool)
    last[49::50] = True
    rules, sizes, symbols = repair.compress(ids, last, 60_000)
    start, size, table = repair.expansions(rules, sizes, 60_000)
    assert (table[K.ragged(start[symbols], size[symbols])] == ids).all()
    ends = np.cumsum(size[symbols])
    inner = ~np.isin(ends[:-1], np.flatnonzero(last) + 1)
    pairs = Counter(zip(symbols[:-1][inner].tolist(), symbols[1:][inner].tolist(), strict=True))
    apart = [p for p, n in pairs.items() if n >= repair.LEAST_COUNT and p[0] != p[1]]
    assert not apart and 0 < len(rules) < 65_536 - 60_000


def test_runs_and_wide_ids():
    ids, last = np.zeros(100_000, np.uint16), np.zeros(100_000, bool)
    last[-1] = True
    rules, sizes, symbols = repair.compress(ids, last, 50_257)
    assert len(symbols) < 200 and int(np.append(np.ones(50_257, np.int64), sizes)[symbols].sum()) == 100_000
    with pytest.raises(ValueError, match="below the first rule"):
        repair.compress(np.array([9, 70_000], np.uint32), np.array([False, True]), 65_000)
    with pytest.raises(ValueError, match="below the first rule"):
        repair.compress(np.array([9], np.uint32), np.array([True]), 100_000)
