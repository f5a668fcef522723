"""Column profiles that can be merged: distinct counts and quantiles as sketches per part of a table.

A profile row holds, for one column of one part, exact counts and two sketches.
Profiles of parts are merged to those of months, zones or the whole table without
the data. Errors with the defaults: a distinct count is within 3 * 1.04 / sqrt(2^12),
about 4.9 %, a quantile's rank within about 1.33 % (each in 99 of 100 cases).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PRECISION = 12
DISTINCT_ERROR = 3 * 1.04 / (1 << PRECISION) ** 0.5
RANK_ERROR = 0.0133


def _hashed(df: DataFrame, column: str) -> Column:
    """What the distinct sketch counts, NULL left out: whole numbers as longs, floating ones by hash, others as text."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.IntegralType):
        return F.col(column).cast("long")
    if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType):
        return F.when(F.col(column).isNotNull(), F.xxhash64(F.col(column).cast("double")))  # their text costs most of the pass
    return F.col(column).cast("string")


def _number(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(column).cast("timestamp_ntz")).cast("double")
    return F.col(column).cast("double") if isinstance(kind, T.NumericType) else F.lit(None).cast("double")


def profile_parts(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """One row per part (values of ``by``) and column: rows, values, both sketches. One pass, sketches combined before the shuffle."""
    aggs = [F.count("*").alias("_n")]
    for i, c in enumerate(columns):
        aggs += [
            F.count(c).alias(f"_c{i}"), F.hll_sketch_agg(_hashed(df, c), PRECISION).alias(f"_d{i}"),
            F.kll_sketch_agg_double(_number(df, c)).alias(f"_q{i}"),
        ]
    one = df.groupBy(*by).agg(*aggs)
    rows = [
        F.struct(F.lit(c).alias("column_name"), F.col("_n").alias("rows"), F.col(f"_c{i}").alias("values"), F.col(f"_d{i}").alias("distincts"), F.col(f"_q{i}").alias("quantiles"))
        for i, c in enumerate(columns)
    ]
    return one.select(*by, F.inline(F.array(*rows)))


def merge_profiles(parts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Profiles of larger parts, or of the whole table, from stored ones."""
    return parts.groupBy(*by, "column_name").agg(
        F.sum("rows").alias("rows"), F.sum("values").alias("values"), F.hll_union_agg("distincts").alias("distincts"),
        F.kll_merge_agg_double("quantiles").alias("quantiles"),
    )


def read_profiles(profiles: DataFrame, shares: Sequence[float] = (0.5,)) -> DataFrame:
    """rows, nulls, estimated distinct values and quantiles (NULL for columns without numbers)."""
    filled = F.kll_sketch_get_n_double("quantiles") > 0
    return profiles.select(
        *[c for c in profiles.columns if c not in ("rows", "values", "distincts", "quantiles")], "rows", (F.col("rows") - F.col("values")).alias("nulls"),
        F.hll_sketch_estimate("distincts").alias("distinct_values"),
        *[F.when(filled, F.kll_sketch_get_quantile_double("quantiles", F.lit(float(s)))).alias(f"q{round(100 * s)}") for s in shares],
    )
