"""Aggregates that are kept up to date from changes instead of computed again.

The state holds sums and counts per (day, key) in folders by month. A change is a
fact row with a sign: +1 for an inserted row, -1 for a deleted one, both for an
updated one. Changes are summed per group first, then only the months they touch are
read, added up and overwritten; all other files stay as they are.

Sums of whole numbers and decimals are exact after any number of changes. Groups
whose rows are all deleted stay with a count of 0, so that a month that becomes empty
is overwritten too; readers skip them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from custodia.session import work_dir

SIGN = "_sign"


def signed(inserted: DataFrame | None = None, deleted: DataFrame | None = None) -> DataFrame:
    """A change set; an updated row is given in both tables, with its old and its new values."""
    parts = [df.withColumn(SIGN, F.lit(s)) for df, s in ((inserted, 1), (deleted, -1)) if df is not None]
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


class DailyState:
    """Counts and sums per (day, key) below ``path``: ``sums`` are {column: value to be summed, an exact number}."""

    def __init__(self, spark: SparkSession, path: str, time: str, key: str, sums: Mapping[str, Column]):
        self.spark, self.path, self.time, self.key, self.sums = spark, path, time, key, dict(sums)

    @property
    def measures(self) -> list[str]:
        return ["trip_count", *self.sums]

    def _grouped(self, rows: DataFrame, sign: Column) -> DataFrame:
        day = F.to_date(self.time)
        sums = [F.sum(sign * value).alias(name) for name, value in self.sums.items()]
        groups = rows.groupBy(day.alias("trip_date"), F.col(self.key)).agg(F.sum(sign).cast("long").alias("trip_count"), *sums)
        return groups.withColumn("month", F.date_format("trip_date", "yyyy-MM"))

    def build(self, fact: DataFrame) -> None:
        """The state of a whole fact table."""
        self._write(self._grouped(fact, F.lit(1)), "overwrite")

    def _write(self, groups: DataFrame, mode: str) -> None:
        kinds = {name: "decimal(38,6)" for name in self.sums}
        typed = groups.withColumns({name: F.col(name).cast(kind) for name, kind in kinds.items()})
        out = typed.hint("rebalance", "month").write.partitionBy("month").mode("overwrite")
        out.option("partitionOverwriteMode", "static" if mode == "overwrite" else "dynamic").parquet(self.path)

    def read(self) -> DataFrame:
        """All groups that have rows."""
        return self._files().where("trip_count <> 0")

    def _files(self) -> DataFrame:
        return self.spark.read.option("basePath", self.path).parquet(self.path).withColumn("month", F.col("month").cast("string"))

    def touched(self, months: Sequence[str]) -> DataFrame:
        """The stored groups of some months: a scan of their folders only."""
        return self.spark.read.parquet(self.path).where(F.col("month").isin(*months))

    def apply(self, changes: DataFrame) -> list[str]:
        """Bring the state up to date; gives the months that were rewritten.

        The sums of the changes and the new groups are written aside first, so a run
        that fails before the last step has changed nothing, and one that fails in it can
        be repeated by ``finish``.
        """
        folder = work_dir(self.spark, "incremental")
        self._grouped(changes, F.col(SIGN)).write.parquet(f"{folder}/delta")
        delta = self.spark.read.parquet(f"{folder}/delta")
        # one row per calendar month
        months = sorted(r[0] for r in delta.where("month IS NOT NULL").select("month").distinct().collect())
        if not months:
            return []
        old = self.touched(months)
        on = ["trip_date", self.key]
        both = old.select(*[F.col(c).alias(f"o_{c}") for c in [*on, *self.measures]]).join(
            delta.where("month IS NOT NULL").select(*[F.col(c).alias(f"d_{c}") for c in [*on, *self.measures]]),
            (F.col("o_trip_date") == F.col("d_trip_date")) & F.col(f"o_{self.key}").eqNullSafe(F.col(f"d_{self.key}")), "full",
        )
        none = F.lit(0)
        # the key may be NULL on either side, so its side is told by the day, which never is
        key = F.when(F.col("o_trip_date").isNotNull(), F.col(f"o_{self.key}")).otherwise(F.col(f"d_{self.key}")).alias(self.key)
        day = F.coalesce("o_trip_date", "d_trip_date").alias("trip_date")
        total = [(F.coalesce(f"o_{c}", none) + F.coalesce(f"d_{c}", none)).alias(c) for c in self.measures]
        fresh = both.select(day, key, *total).withColumn("month", F.date_format("trip_date", "yyyy-MM"))
        fresh.write.parquet(f"{folder}/fresh")
        self.finish(f"{folder}/fresh")
        return months

    def finish(self, fresh: str) -> None:
        """Overwrite the months held by the groups below ``fresh``."""
        self._write(self.spark.read.parquet(fresh), "dynamic")

    def monthly(self, labels: DataFrame, label_key: str, label: str, amount: str, months: Sequence[str] | None = None) -> DataFrame:
        """(month, label, trips, revenue) of some or all months, the label joined to the sums per key; trips may be 0."""
        groups = self._files() if months is None else self.touched(months)
        per_key = groups.groupBy("month", F.col(self.key)).agg(F.sum(amount).alias("_amount"), F.sum("trip_count").alias("_trips"))
        named = per_key.join(labels.select(F.col(label_key).alias("_k"), F.col(label)), F.col(self.key) == F.col("_k"), "left")
        return named.groupBy("month", label).agg(F.sum("_trips").alias("trips"), F.sum("_amount").alias("revenue"))


def refresh_monthly(state: DailyState, changes: DataFrame, labels: DataFrame, label_key: str, label: str, amount: str, path: str) -> list[str]:
    """Apply changes to the daily state and rewrite the touched months of the monthly table below ``path``.

    The first call, when the table does not exist, needs ``build`` and ``write_monthly`` before it.
    """
    months = state.apply(changes)
    if months:
        write_monthly(state.monthly(labels, label_key, label, amount, months), path)
    return months


def write_monthly(monthly: DataFrame, path: str) -> None:
    """Overwrite the months present in ``monthly``; rows of 0 trips stand for labels that a change emptied (see ``read_monthly``)."""
    monthly.coalesce(1).write.partitionBy("month").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def read_monthly(spark: SparkSession, path: str) -> DataFrame:
    """The rows that have trips."""
    return spark.read.parquet(path).where("trips <> 0").withColumn("month", F.col("month").cast("string"))
