"""Connected components of pairs, in written rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("child", "parent").cast("decimal(20,0)"))).first())


def connected(pairs: DataFrame, left: str, right: str, folder: str) -> DataFrame:
    """``node`` and ``root`` (the smallest id reachable) for every id of the pairs.

    Each link leads from a larger id to a smaller one. A round first hangs the larger
    neighbours of an id on the smallest id it touches, then the parents of an id on
    the smallest of them; it ends when every id has one parent and no parent has a
    parent. Rounds are logarithmic in the longest chain. Neighbours are met in
    aggregates and joins only, so an id may have any number of them. Every round is
    written below ``folder`` and read again: lost executors repeat one round at most.
    Null ids and pairs of an id with itself are no links.
    """
    spark = pairs.sparkSession
    links = pairs.where(F.col(left) != F.col(right)).select(F.greatest(left, right).alias("child"), F.least(left, right).alias("parent")).distinct()
    links.write.parquet(f"{folder}/round-0")
    links, turn, before = spark.read.parquet(f"{folder}/round-0"), 0, None
    while True:
        # an id with several parents, or with a parent and children, is still loose
        sides = links.select(F.col("child").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionAll(
            links.select(F.col("parent").alias("id"), F.lit(0).alias("up"), F.lit(1).alias("down"))
        )
        loose = sides.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 OR up = 1 AND down = 1")
        if loose.isEmpty():
            break
        now = _state(links)
        if now == before:
            raise RuntimeError("components did not settle")
        before, turn = now, turn + 1
        # larger neighbours of u hang on the smallest of u and its neighbours
        ends = links.select(F.col("child").alias("u"), F.col("parent").alias("v")).unionAll(links.select(F.col("parent").alias("u"), F.col("child").alias("v")))
        lowest = ends.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
        large = ends.where("v > u").join(lowest, "u").select(F.col("v").alias("child"), F.col("low").alias("parent")).distinct()
        large.write.parquet(f"{folder}/large-{turn}")
        large = spark.read.parquet(f"{folder}/large-{turn}")
        # the parents of an id hang on the smallest of them
        lowest = large.groupBy("child").agg(F.min("parent").alias("low"))
        moved = large.join(lowest, "child").where("parent > low").select(F.col("parent").alias("child"), F.col("low").alias("parent"))
        small = lowest.select("child", F.col("low").alias("parent")).unionAll(moved).distinct()
        small.write.parquet(f"{folder}/round-{turn}")
        links = spark.read.parquet(f"{folder}/round-{turn}")
    roots = links.select(F.col("parent").alias("node"), F.col("parent").alias("root")).distinct()
    return links.select(F.col("child").alias("node"), F.col("parent").alias("root")).unionAll(roots)
