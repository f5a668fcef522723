"""Connected components by alternating stars, in written rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, path: str) -> DataFrame:
    """``df`` written to the shared folder and read again: its lineage ends there, so what it shuffled goes at once."""
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.unset(CLEANUP) if before is None else conf.set(CLEANUP, before)
    return df.sparkSession.read.parquet(path)


def components(edges: DataFrame, folder: str) -> DataFrame:
    """``node`` and ``root``, the smallest node reachable, for every node of the edges (columns a and b).

    A round hangs the larger neighbours of each node on its smallest one, then the
    smaller ones, until all edges are stars; edges do not grow in number, and a node with very many
    neighbours is met by aggregates and joins only, never as a list. Null ends
    and loops are no edges.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges, turn = stored(edges, f"{folder}/edges-0"), 0
    while not _stars(edges):
        turn += 1
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("u"), F.least("a", "b").alias("m"))
        large = both.where("b > a").join(least, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = stored(large, f"{folder}/large-{turn}")
        least = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u")
        small = large.join(least, F.col("a") == F.col("u")).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = stored(least.select(F.col("u").alias("a"), F.col("m").alias("b")).unionAll(small).distinct(), f"{folder}/edges-{turn}")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def _stars(edges: DataFrame) -> bool:
    """Whether every larger end has one edge and is the smaller end of none: then each smaller end is the least of its component."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("larger")).unionAll(edges.select("b", F.lit(0)))
    met = ends.groupBy("node").agg(F.sum("larger").alias("larger"), F.min("larger").alias("least"))
    return met.where("larger > 1 OR larger = 1 AND least = 0").isEmpty()
