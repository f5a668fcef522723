"""Counts, revenue and profile metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _zero(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(0))


def total_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("row_count"))


def count_by(df: DataFrame, *cols: str) -> DataFrame:
    """Rows per code, most frequent first, code as tie-break."""
    return df.groupBy(*cols).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), *cols)


def measures_by_key(df: DataFrame, key: str, amount: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("trips"), F.sum(_zero(amount)).alias("revenue"))


def zone_measures(
    fact: DataFrame, zones: DataFrame, fact_key: str, zone_key: str, amount: str, labels: Sequence[str]
) -> DataFrame:
    """Aggregate the fact per key first, then join the few results to the dimension."""
    per_key = measures_by_key(fact, fact_key, amount)
    joined = per_key.join(zones, per_key[fact_key] == zones[zone_key])
    return joined.select(zone_key, *labels, "trips", "revenue")


def top(df: DataFrame, measure: str, n: int, *tie_break: str) -> DataFrame:
    return df.orderBy(F.desc(measure), *tie_break).limit(n)


def rank_within(df: DataFrame, group: str, measure: str, name: str = "rank") -> DataFrame:
    """Dense rank of already aggregated rows, highest measure first."""
    return df.withColumn(name, F.dense_rank().over(Window.partitionBy(group).orderBy(F.desc(measure))))


def number_rows(df: DataFrame, *order: Column | str, name: str = "position") -> DataFrame:
    """Position of each row of a *bounded* listing (after a limit or on a code set)."""
    return df.withColumn(name, F.row_number().over(Window.orderBy(*order)))


def daily_zone_metrics(
    trips: DataFrame, ts_col: str, key: str, labels: Sequence[str], amount: str, distance: str
) -> DataFrame:
    """One row per (day, key): labels, count, revenue and mean distance, NULL as 0."""
    return (
        trips.groupBy(F.to_date(ts_col).alias("trip_date"), F.col(key))
        .agg(
            *[F.max(c).alias(c) for c in labels],
            F.count("*").alias("trip_count"),
            F.sum(_zero(amount)).alias("total_revenue"),
            F.avg(_zero(distance)).alias("avg_distance"),
        )
    )


def monthly_rollup(daily: DataFrame, label: str) -> DataFrame:
    return daily.groupBy(F.trunc("trip_date", "MM").alias("month"), F.col(label)).agg(
        F.sum("total_revenue").alias("revenue")
    )


def uniqueness(df: DataFrame, key: str) -> DataFrame:
    return df.agg(
        F.count("*").alias("rows"),
        F.count_distinct(key).alias("distinct_keys"),
        (F.count_distinct(key) + F.max(F.when(F.col(key).isNull(), 1).otherwise(0))).alias("distinct_with_null"),
    )


def value_distribution(df: DataFrame, col: str) -> DataFrame:
    """Rows per value; NULL is shown as UNKNOWN."""
    return df.groupBy(F.coalesce(F.col(col).cast("string"), F.lit("UNKNOWN")).alias("value")).agg(
        F.count("*").alias("rows")
    )


def distinct_codes(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).dropna().distinct()


def profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, rows, nulls, min, max) in one pass: one aggregate row turned into rows."""
    columns = list(columns or df.columns)
    one = df.agg(
        F.count("*").alias("_n"),
        *[F.count(c).alias(f"_c{i}") for i, c in enumerate(columns)],
        *[F.min(c).cast("string").alias(f"_lo{i}") for i, c in enumerate(columns)],
        *[F.max(c).cast("string").alias(f"_hi{i}") for i, c in enumerate(columns)],
    )
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col("_n").alias("rows"),
            (F.col("_n") - F.col(f"_c{i}")).alias("nulls"),
            F.col(f"_lo{i}").alias("min_value"),
            F.col(f"_hi{i}").alias("max_value"),
        )
        for i, c in enumerate(columns)
    ]
    return one.select(F.inline(F.array(*rows)))


def null_share(df: DataFrame, columns: dict[str, str], where: Column | None = None) -> DataFrame:
    """100 * NULL rows / rows per column, NULL for an empty input: {output name: column}."""
    kept = df.filter(where) if where is not None else df
    return kept.agg(
        *[
            (F.lit(100.0) * F.count_if(F.col(c).isNull()) / F.nullif(F.count("*"), F.lit(0))).alias(name)
            for name, c in columns.items()
        ]
    )
