"""Corpus pipeline over ``documents``: each stage calls one operator of ``custodia.llm``."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from custodia.llm import bpe, catalog, langid, mixing, ngram_join
from custodia.llm.common import read
from custodia.session import work_dir


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that some language model accepts; models learn from the labels of the same documents."""
    found = langid.predict(docs, langid.fit(docs))
    return found.where(~found["rejected"]).select(*docs.columns)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by their 5-word shingles the one with the smallest id."""
    return ngram_join.representatives(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them, shard by shard."""
    return mixing.mixed_rows(docs, mixing.mix(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every document as digests, with that of the decoded text."""
    path = public_tokenizers.path(catalog.BPE_RANKS)
    return bpe.digests(bpe.round_trip(docs, path))


STAGES = [
    ("language_id", keep_known_languages),
    ("ngram_jaccard", keep_one_of_each_group),
    ("source_mix", mix_sources),
    ("byte_bpe", encode),
]
#: Character models, hashed draws and merge loops are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written as Parquet and read again by the next."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = work_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
