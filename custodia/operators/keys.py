"""Surrogate keys without a global sort or a single-task window."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def surrogate_keys(
    df: DataFrame, natural_key: Sequence[str], name: str, start: int = 0, buckets: int = 1024
) -> DataFrame:
    """Unique keys above ``start`` for rows that are unique on ``natural_key``.

    Rows are numbered inside hash buckets, which a unique key fills evenly, and
    bucket b takes the numbers b + 1, b + 1 + buckets, b + 1 + 2 * buckets ...: one
    shuffle, no second pass for offsets. Like an identity column the keys are
    unique but may have gaps. They depend only on the set of natural keys.
    """
    bucket = F.pmod(F.xxhash64(*natural_key), F.lit(buckets))
    inside = F.row_number().over(Window.partitionBy("_b").orderBy(*natural_key))
    key = F.lit(start).cast("long") + (inside - 1) * F.lit(buckets) + F.col("_b") + 1
    return df.withColumn("_b", bucket).withColumn(name, key).drop("_b")


def extend_keys(df: DataFrame, natural_key: Sequence[str], name: str, existing: DataFrame, above: int = 0) -> DataFrame:
    """Rows of ``df`` with the keys that ``existing`` gives their members; new members get keys above all of these and ``above``.

    ``existing`` knows the members it holds only: one that has left it can lose its
    key to a new one. ``KeyRegistry`` remembers every member; ``above`` is its highest key.
    """
    old = existing.select(*natural_key, name)
    top = max(old.agg(F.coalesce(F.max(name), F.lit(0)).alias("top")).first()["top"], above)
    fresh = surrogate_keys(df.join(old, list(natural_key), "left_anti"), natural_key, name, start=top)
    return df.join(old, list(natural_key)).unionByName(fresh)


class KeyRegistry:
    """Every key ever given, as an append-only table of (natural key, surrogate key, build, present).

    A build appends a row for each member that is new (with a key above the highest
    one ever given), gone (a tombstone) or back (with its old key), and nothing for the
    others. Keys are so never given twice, whoever leaves in between. A build that is
    repeated after a failure finds its members present and appends what is missing.
    Members with a NULL in the natural key get no key.
    """

    def __init__(self, spark: SparkSession, path: str, natural_key: Mapping[str, str], name: str):
        self.spark, self.path, self.name = spark, path, name
        self.natural_key = list(natural_key)
        self.schema = ", ".join([*[f"{c} {t}" for c, t in natural_key.items()], f"{name} long", "build int", "present boolean"])

    def log(self) -> DataFrame:
        """All rows, from the first build on."""
        try:
            return self.spark.read.schema(self.schema).parquet(self.path)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], self.schema)

    def members(self) -> DataFrame:
        """The last state of every member: key, first and last build with a change, whether it is present."""
        return self.log().groupBy(*self.natural_key).agg(
            F.max(self.name).alias(self.name), F.min("build").alias("first_build"), F.max("build").alias("last_build"),
            F.max_by("present", "build").alias("present"),
        )

    def highest(self) -> int:
        return self.log().agg(F.max(self.name)).first()[0] or 0

    def register(self, members: DataFrame, build: int) -> DataFrame:
        """Record the members of a build; gives them back with their keys, those without a key left out."""
        key = self.natural_key
        # equal repeats of a member count once; written to the log before it is read again
        now = members.select(*key).dropna().distinct()
        known = self.members().select(*key, self.name, "present")
        fresh = surrogate_keys(now.join(known, key, "left_anti"), key, self.name, start=self.highest())
        back = now.join(known.where("NOT present"), key).select(*key, self.name)
        gone = known.where("present").join(now, key, "left_anti").select(*key, self.name)
        events = fresh.select(*key, self.name).unionByName(back).withColumn("present", F.lit(True))
        events = events.unionByName(gone.withColumn("present", F.lit(False))).withColumn("build", F.lit(build).cast("int"))
        events.write.mode("append").parquet(self.path)
        return members.join(self.members().select(*key, self.name), key)
