"""Registered queries of this folder: each operator over its whole table."""

from __future__ import annotations

from pathlib import Path

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from custodia.llm import article, bitslice, bpe, imatch, langid, mixing, ngram_join, nndescent, ppm, repair, skipchain, trie, warc
from custodia.llm.common import read
from custodia.session import work_dir

BPE_RANKS = "byte_bpe_multi_50k.tiktoken"
TOKENIZER = "byte_bpe_50k.json"
TOKENIZER_IDS = 50_257


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(BPE_RANKS)
    return bpe.digests(bpe.round_trip(read(spark, sf_dir, "documents"), path))


def languages(docs: DataFrame) -> langid.Languages:
    """Models learned from the labels of all documents outside the held-out fold."""
    return langid.fit(docs.where(_fold(3) != 1))


def _fold(parts: int) -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % parts


def op2_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = langid.predict(docs.select("doc_id", "text"), languages(docs))
    return found.withColumn("held_out", _fold(3) == 1).drop("text")


def op3_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    trains = "crc32(coalesce(cast(doc_id AS string), '')) % 7 <> 2"
    return ppm.score(read(spark, sf_dir, "documents"), trains).withColumn("held_out", _fold(7) == 2)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_dir(spark, "warc")
    warc.write(spark, read(spark, sf_dir, "pages"), folder)
    return warc.read(spark, folder, payloads=False).drop("payload")


OP4_SQL = """
WITH sized AS (
  SELECT page_id, url, coalesce(octet_length(encode(html)), 0) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
firsts AS (SELECT payload_digest, min(page_id) AS first_id FROM sized WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT s.page_id, s.url, CASE WHEN s.page_id > f.first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN s.page_id > f.first_id THEN f.first_id END AS refers_to, s.payload_bytes, s.payload_digest
FROM sized s LEFT JOIN firsts f ON f.payload_digest = s.payload_digest AND s.payload_bytes >= 100
"""

def op5_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.stability(read(spark, sf_dir, "documents"))


def op6_nndescent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nndescent.link(read(spark, sf_dir, "embeddings"))


def op7_article(spark: SparkSession, sf_dir: str) -> DataFrame:
    return article.extract(read(spark, sf_dir, "pages"))


def op8_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_dir(spark, "repair")
    tokenizer = Path(public_tokenizers.path(TOKENIZER)).read_text(encoding="utf-8")
    repair.write(spark, read(spark, sf_dir, "documents"), folder, tokenizer, TOKENIZER_IDS)
    stored = repair.read(spark, folder)
    return stored.select("doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(read(spark, sf_dir, "documents"))


OP9_SQL = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
places AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM worded WHERE len(w) > 0),
shingles AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM places),
sized AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
met AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n_shared FROM shingles x JOIN shingles y USING (s) WHERE x.doc_id <> y.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM met JOIN sized p ON p.doc_id = a JOIN sized q ON q.doc_id = b WHERE 100 * n_shared >= 80 * (p.n + q.n - n_shared)),
reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other)
SELECT d.doc_id, coalesce(any_value(s.n), 0) AS n_shingles, min(r.other) AS component_id
FROM documents d JOIN reached r USING (doc_id) LEFT JOIN sized s USING (doc_id) GROUP BY d.doc_id
"""


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(mixing.mix(read(spark, sf_dir, "documents")))


def op11_bitslice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitslice.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


OP11_SQL = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
counts AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY 1, 2),
sizes AS (SELECT doc_id, count(*) AS n FROM words GROUP BY 1),
whole AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_words FROM sizes),
wanted AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
weights AS (
  SELECT term, CAST(floor(1000.0 * ln(CAST(2 * any_value(n_docs) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM counts, whole WHERE term IN (SELECT term FROM wanted) GROUP BY term),
scores AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_words)))) AS BIGINT) AS score
  FROM wanted JOIN weights USING (term) JOIN counts USING (term) JOIN sizes USING (doc_id), whole GROUP BY 1, 2),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST) AS INTEGER) AS rank FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""


def op12_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations")
    return trie.conversations(turns, lambda c: c - c % 100, lambda c: F.crc32(c.cast("string")) % 6)


OP12_SQL = """
WITH RECURSIVE bits(conv_id, s, k, c) AS (
  SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR), 0, CAST(4294967295 AS BIGINT) FROM conversations WHERE conv_id IS NOT NULL
  UNION ALL
  SELECT conv_id, s, k + 1, CASE WHEN t % 2 = 1 THEN xor(t // 2, CAST(3988292384 AS BIGINT)) ELSE t // 2 END
  FROM (SELECT conv_id, s, k, CASE WHEN k % 8 = 0 THEN xor(c, CAST(ascii(substr(s, k // 8 + 1, 1)) AS BIGINT)) ELSE c END AS t
        FROM bits WHERE k < 8 * length(s))),
heads AS (SELECT conv_id, xor(c, CAST(4294967295 AS BIGINT)) % 6 AS h FROM bits WHERE k = 8 * length(s)),
lists AS (
  SELECT conv_id, list(struct_pack(r := coalesce(role, ''), t := coalesce(text, '')) ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
whole AS (
  SELECT a.conv_id, list_concat(CASE WHEN b.conv_id IS NULL THEN a.turns[1:0] ELSE b.turns[1:h] END, a.turns[h + 1:]) AS turns
  FROM lists a JOIN heads USING (conv_id) LEFT JOIN lists b ON b.conv_id = a.conv_id - a.conv_id % 100),
steps AS (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS depth FROM whole),
nodes AS (
  SELECT depth, turns[1:depth] AS prefix, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE depth = len(turns)), '')) AS ends_sha256
  FROM steps GROUP BY 1, 2),
children AS (SELECT depth - 1 AS depth, prefix[1:depth - 1] AS prefix, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1, 2),
counted AS (
  SELECT x.*, coalesce(c.n, 0) AS n_children, CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * length(prefix[depth].t) END AS saved
  FROM nodes x LEFT JOIN children c USING (depth, prefix)),
above AS (SELECT unnest(range(0, depth + 1)) AS top, prefix, n_children, saved FROM counted),
sums AS (
  SELECT top AS depth, prefix[1:top] AS prefix, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(saved) AS saved_tokens FROM above GROUP BY 1, 2)
SELECT x.conv_id, x.depth, p.conv_id AS parent_conv_id, x.n_convs, x.n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, x.ends_sha256
FROM counted x JOIN sums s ON s.depth = x.depth AND s.prefix = x.prefix
LEFT JOIN nodes p ON p.depth = x.depth - 1 AND p.prefix = x.prefix[1:x.depth - 1]
"""


def op13_skipchain(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = skipchain.label(docs, skipchain.fit(docs))

    def joined(column: str) -> Column:
        return F.array_join(F.transform(column, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *[count(k) for k in skipchain.KINDS], F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"),
        F.size(F.filter("spans", lambda x: x["added"])).cast("long").alias("n_added"),
    )


ENTRIES = {
    "op1_bpe": (op1_bpe, None),
    "op2_langid": (op2_langid, None),
    "op3_ppm": (op3_ppm, None),
    "op4_warc": (op4_warc, OP4_SQL),
    "op5_imatch": (op5_imatch, None),
    "op6_nndescent": (op6_nndescent, None),
    "op7_article": (op7_article, None),
    "op8_repair": (op8_repair, None),
    "op9_ngram_join": (op9_ngram_join, OP9_SQL),
    "op10_mixing": (op10_mixing, None),
    "op11_bitslice": (op11_bitslice, OP11_SQL),
    "op12_trie": (op12_trie, OP12_SQL),
    "op13_skipchain": (op13_skipchain, None),
}
