"""Row counts, minima and maxima from the footers of parquet files: no data page is read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed set: column types whose extremes the footers give exactly.
_WITH_EXTREMES = (T.BooleanType, T.IntegralType, T.FloatType, T.DoubleType, T.DateType)


def footer_session(spark: SparkSession) -> SparkSession:
    """A session of the same application that hands aggregates down to the parquet files."""
    child = spark.newSession()
    kept = [s for s in spark.conf.get("spark.sql.sources.useV1SourceList").split(",") if s and s != "parquet"]
    child.conf.set("spark.sql.sources.useV1SourceList", ",".join(kept))
    child.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return child


def footer_counts(spark: SparkSession, path: str, by: Sequence[str] = ()) -> DataFrame:
    """``rows`` of a table, or of each partition folder (``by``: partition columns), in a ``footer_session``."""
    files = footer_session(spark).read.parquet(path)
    return files.groupBy(*by).agg(F.count("*").alias("rows")) if by else files.agg(F.count("*").alias("rows"))


def footer_profile(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_name, rows, nulls, min_value, max_value) of a table, in a ``footer_session``.

    Extremes are given for whole numbers, floats, booleans and dates; those of texts
    and timestamps are not exact in footers and are left NULL.
    """
    files = footer_session(spark).read.parquet(path)
    kinds = {f.name: f.dataType for f in files.schema}
    columns = [c for c in columns or files.columns]
    exact = [c for c in columns if isinstance(kinds[c], _WITH_EXTREMES)]
    one = files.agg(
        F.count("*").alias("_n"), *[F.count(c).alias(f"_c{i}") for i, c in enumerate(columns)],
        *[fn(c).alias(f"{name}{columns.index(c)}") for c in exact for name, fn in (("_lo", F.min), ("_hi", F.max))],
    )
    none = F.lit(None).cast("string")
    rows = [
        F.struct(
            F.lit(c).alias("column_name"), F.col("_n").alias("rows"), (F.col("_n") - F.col(f"_c{i}")).alias("nulls"),
            (F.col(f"_lo{i}").cast("string") if c in exact else none).alias("min_value"),
            (F.col(f"_hi{i}").cast("string") if c in exact else none).alias("max_value"),
        )
        for i, c in enumerate(columns)
    ]
    return one.select(F.inline(F.array(*rows)))


def in_session(spark: SparkSession, df: DataFrame) -> DataFrame:
    """The few rows of a footer query as a table of ``spark``: one per column or per folder, which the driver lists anyway."""
    return spark.createDataFrame(df.collect(), df.schema)
