"""Encoding against the tiktoken library, decoding by round trip."""

from pathlib import Path

import numpy as np
import public_tokenizers
import tiktoken
from custodia.llm import bpe, catalog

PATH = public_tokenizers.path(catalog.BPE_RANKS)
VOCABULARY = Path(PATH).read_bytes()
TEXTS = [
    None, "", " ", "\n\n  x", "don't we'll 'tis 're 'Re", "été naïve — 東京 42٣ \U0001f600\U0001f600", "a" * 5000, "*" * 33 + " ****",
    "tabs\t\tand \r\n ends ", "\x1c\x85\xa0x", "the " * 20000, "<|endoftext|> is text", "''s 's's  's", "xyzzy" * 300,
]


def test_equals_the_library(spark):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(VOCABULARY), special_tokens={})
    rows = [(k, t, "x", 7) for k, t in enumerate(TEXTS)] + [(None, "no id", None, None), (3, TEXTS[3], "x", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, TEXT2 string, ids int")
    out = bpe.decode(bpe.encode(docs, PATH), PATH).collect()
    assert len(out) == len(rows) and sorted(map(str, bpe.round_trip(docs, PATH).collect())) == sorted(map(str, out))
    want = sorted((str(r[0]), tuple(library.encode_ordinary(r[1] or "")), (r[1] or "").encode()) for r in rows)
    assert sorted((str(r.doc_id), tuple(np.frombuffer(r.ids, "<u4")), bytes(r.decoded)) for r in out) == want


def test_rounds_of_recursion_agree(monkeypatch):
    ranks = bpe.read_ranks(VOCABULARY)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    monkeypatch.setattr(bpe, "STATE_ROWS", 1)
    monkeypatch.setattr(bpe, "CACHE_WORDS", 4)
    tables = bpe.Tables(ranks)
    for text in ("internationalization of everything " * 3, "l" * 77 + "aba" * 9):
        assert tables.encode([text, ""])[0].tolist() == library.encode_ordinary(text)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.digests(bpe.decode(bpe.encode(docs, PATH), PATH)).count() == 0


def test_query(spark):
    out = catalog.op1_bpe(spark, "/root/testdata/sf0.001").collect()
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(VOCABULARY), special_tokens={})
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    import hashlib

    assert len(out) == len(texts)
    for r in out:
        ids = np.array(library.encode_ordinary(texts[r.doc_id]), "<u4")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
