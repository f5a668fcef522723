"""Running values per key over an order, without a whole key in one task.

Rows are dealt out by ranges of (key, order) and written once. Windows run inside
a range; what a key's earlier ranges leave over is added from one row per key and
range. A key that lies in one range needs nothing; there are at most as many other
keys as ranges, so those rows are few whatever the size of the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANGE = "_range"


class Ordered:
    """``rows`` of a table by key and order; the order should decide between any two rows of a key."""

    def __init__(self, df: DataFrame, key: Sequence[str], order: Sequence[str], folder: str):
        self.key, self.order = list(key), list(order)
        spark = df.sparkSession
        df.repartitionByRange(*self.key, *self.order).withColumn(RANGE, F.spark_partition_id()).write.parquet(folder)
        self.rows = spark.read.parquet(folder)
        spans = self.rows.groupBy(*self.key).agg(F.min(RANGE).alias("_a"), F.max(RANGE).alias("_b")).where("_a < _b")
        self._cut = spans.select(*[F.col(k).alias(f"_c{i}") for i, k in enumerate(self.key)])

    def _inside(self, inclusive: bool):
        return Window.partitionBy(RANGE, *self.key).orderBy(*self.order).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)

    def _earlier(self, rest: Column, over: str, later: bool = False) -> DataFrame:
        """For each cut key and range what all its earlier (or later) ranges leave over."""
        same = F.lit(True)
        for i, k in enumerate(self.key):
            same = same & F.col(k).eqNullSafe(F.col(f"_c{i}"))
        # at most one cut key per border of two ranges
        left = self.rows.join(F.broadcast(self._cut), same).groupBy(RANGE, *[f"_c{i}" for i in range(len(self.key))]).agg(rest.alias("_rest"))
        frame = (1, Window.unboundedFollowing) if later else (Window.unboundedPreceding, -1)
        before = Window.partitionBy(*[f"_c{i}" for i in range(len(self.key))]).orderBy(RANGE).rowsBetween(*frame)
        return left.select(F.col(RANGE).alias("_r"), *[f"_c{i}" for i in range(len(self.key))], F.expr(over).over(before).alias("_earlier"))

    def _with(self, name: str, inside: Column, earlier: DataFrame, both) -> Ordered:
        same = F.col(RANGE) == F.col("_r")
        for i, k in enumerate(self.key):
            same = same & F.col(k).eqNullSafe(F.col(f"_c{i}"))
        kept = self.rows.columns
        joined = self.rows.withColumn("_inside", inside).join(F.broadcast(earlier), same, "left")
        self.rows = joined.select(*kept, both(F.col("_inside"), F.col("_earlier")).alias(name))
        return self

    def last(self, name: str, value: Column, inclusive: bool = True) -> Ordered:
        """Add the last value that is not null up to each row, or before it."""
        inside = F.last(value, ignorenulls=True).over(self._inside(inclusive))
        rest = F.max_by(value, F.when(value.isNotNull(), F.struct(*self.order)))
        return self._with(name, inside, self._earlier(rest, "last(_rest, true)"), F.coalesce)

    def next(self, name: str, value: Column) -> Ordered:
        """Add the value, which must not be null, of the row behind each row; NULL behind the last one of a key."""
        inside = F.lead(value).over(Window.partitionBy(RANGE, *self.key).orderBy(*self.order))
        return self._with(name, inside, self._earlier(F.min_by(value, F.struct(*self.order)), "first(_rest)", later=True), F.coalesce)

    def total(self, name: str, value: Column, inclusive: bool = True) -> Ordered:
        """Add the sum of the values up to each row, or before it."""
        inside = F.sum(value).over(self._inside(inclusive))
        none = F.lit(0)
        return self._with(name, inside, self._earlier(F.sum(value), "sum(_rest)"), lambda a, b: F.coalesce(a, none) + F.coalesce(b, none))

    def plain(self) -> DataFrame:
        return self.rows.drop(RANGE)


def as_of_join(
    events: DataFrame, versions: DataFrame, key: tuple[str, str], at: tuple[str, str], until: str | None, take: Sequence[str], folder: str
) -> DataFrame:
    """Every event with the columns ``take`` of the version of its key that is valid at its time, NULL where there is none.

    ``key`` and ``at``: the column in the events and in the versions. The version with
    the greatest start not after the event counts, if the event lies before its end
    ``until`` (a NULL end is open). Events and versions are merged in one order, so no
    range condition is tested on pairs and a key with very many events or versions
    is cut by time. Events with a NULL key or time have no version; starts are
    unique per key.
    """
    names = events.columns
    row = F.struct(*[F.col(c) for c in names])
    v = versions.where(F.col(key[1]).isNotNull() & F.col(at[1]).isNotNull())
    end = F.col(until) if until else F.lit(None).cast("timestamp_ntz")
    found = F.struct(end.alias("_until"), *[F.col(c).alias(f"_v{i}") for i, c in enumerate(take)])
    left = events.select(F.col(key[0]).alias("_key"), F.col(at[0]).alias("_at"), F.lit(1).alias("_side"), row.alias("_row"))
    kind = events.schema[key[0]].dataType
    right = v.select(F.col(key[1]).cast(kind).alias("_key"), F.col(at[1]).alias("_at"), F.lit(0).alias("_side"), found.alias("_found"))
    both = left.unionByName(right, allowMissingColumns=True)
    # equal events (repeated rows) may stand in any order: they get the same version
    ordered = Ordered(both, ["_key"], ["_at", "_side"], folder).last("_valid", F.col("_found"))
    valid = F.col("_key").isNotNull() & F.col("_at").isNotNull() & (F.col("_valid._until").isNull() | (F.col("_at") < F.col("_valid._until")))
    return ordered.rows.where("_side = 1").select("_row.*", *[F.when(valid, F.col(f"_valid._v{i}")).alias(c) for i, c in enumerate(take)])
