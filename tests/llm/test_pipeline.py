"""The pipeline against its stages in plain Python."""

import hashlib
from pathlib import Path

import corpus_pipeline
import numpy as np
import public_tokenizers
import tiktoken
from custodia.llm import bpe, catalog
from pyspark.sql import functions as F
from test_ngram_join import plain

SF = "/root/testdata/sf0.001"
NOISE = "qzx jkvw xqj zzkq wvxj kqzj xvqk jzwx qkxz vjqw " * 8


def test_pipeline(spark, tmp_path):
    given = spark.read.parquet(f"{SF}/documents.parquet")
    row = given.first()
    odd = [(10**6, NOISE, None, "src0", len(NOISE)), (10**6 + 1, None, "en", None, 0), (10**6 + 2, "", "en", "src1", 0), (10**6 + 3, row.text, "en", "src2", 1)]
    docs = given.unionByName(spark.createDataFrame(odd, given.schema).select(given.columns))
    docs.write.parquet(f"{tmp_path}/sf/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/sf/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)

    kept = stages["language_id"](spark, docs, "")
    assert kept.columns == docs.columns
    assert {r.doc_id for r in docs.collect()} - {r.doc_id for r in kept.collect()} == {10**6, 10**6 + 1, 10**6 + 2}

    single = stages["ngram_jaccard"](spark, kept, "")
    assert single.columns == docs.columns
    rows = {r.doc_id: r for r in kept.collect()}
    want = sorted({c for _, _, c in plain([(r.doc_id, r.text) for r in rows.values()])})
    found = sorted(single.collect())
    assert [r.doc_id for r in found] == want and all(r == rows[r.doc_id] for r in found)

    mixed = stages["source_mix"](spark, single, "")
    assert mixed.columns == docs.columns
    times = {r.doc_id: r.n for r in mixed.groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    assert set(times) <= set(want) and max(times.values()) <= 2
    words = {r.doc_id: len((r.text or "").split()) for r in found}
    assert abs(sum(words[d] * n for d, n in times.items()) / sum(words.values()) - 1.5) < 0.1

    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(Path(public_tokenizers.path(catalog.BPE_RANKS)).read_bytes()), special_tokens={}
    )
    out = corpus_pipeline.run(spark, f"{tmp_path}/sf").collect()
    assert {(r.doc_id, n) for r, n in ((r, sum(x.doc_id == r.doc_id for x in out)) for r in out)} == set(times.items())
    for r in out:
        ids = np.array(library.encode_ordinary(rows[r.doc_id].text), "<u4")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(rows[r.doc_id].text.encode()).hexdigest()


def test_odd_columns(spark):
    """Repeated and null ids, and columns with the names that stages use."""
    rows = [(1, "a b c d e f g h", "x", 1), (1, "a b c d e f g h", "x", 1), (2, "a b c d e f g h", "y", 2), (None, "a b c d e f g h", None, 3), (4, None, "x", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, component_id int")
    left = corpus_pipeline.keep_one_of_each_group(spark, docs, "")
    assert sorted(map(str, left.collect())) == sorted(map(str, docs.where("component_id <> 2").distinct().collect()))
    assert corpus_pipeline.mix_sources(spark, left, "").columns == docs.columns
    empty = docs.limit(0)
    assert corpus_pipeline.mix_sources(spark, corpus_pipeline.keep_one_of_each_group(spark, empty, ""), "").count() == 0
