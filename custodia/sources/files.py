"""Reading and writing tables as files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, schema: T.StructType | None = None
) -> DataFrame:
    """Parquet scan; ``columns`` keeps the listed ones that exist and prunes the rest.

    A known ``schema`` saves the job that infers it.
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.parquet(path)
    return keep_columns(df, columns) if columns else df


def read_lookup(
    spark: SparkSession,
    path: str,
    columns: Sequence[str],
    key: str,
    key_type: str = "int",
    null_values: Sequence[str] = (),
) -> DataFrame:
    """Header CSV read as text, markers in ``null_values`` to NULL, key cast without failing."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    raw = spark.read.schema(schema).option("header", True).csv(path)
    cleaned = []
    for name in columns:
        value = F.col(name)
        for marker in null_values:
            value = F.nullif(value, F.lit(marker))
        cleaned.append((value.try_cast(key_type) if name == key else value).alias(name))
    return raw.select(*cleaned)


def keep_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Tolerant projection: wanted columns that exist, in the wanted order."""
    present = set(df.columns)
    return df.select(*[c for c in columns if c in present])


def write_partitioned(df: DataFrame, path: str, by: Sequence[str], sort_by: str | None = None) -> None:
    """Overwrite the partitions present in ``df``.

    The rebalance hint lets AQE merge small partitions and split a hot one, so a
    month that holds a third of the rows is still written by many tasks.
    ``sort_by`` clusters each file for row-group skipping.
    """
    out = df.hint("rebalance", *by)
    if sort_by:
        out = out.sortWithinPartitions(*by, sort_by)
    (
        out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


def write_flat(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def create_partitioned_table(
    spark: SparkSession, source: DataFrame, table: str, path: str, ts_col: str
) -> DataFrame:
    """CTAS into snappy parquet with derived ``year`` and ``month`` partitions."""
    derived = source.withColumns({"year": F.year(ts_col), "month": F.month(ts_col)})
    (
        derived.hint("rebalance", "year", "month")
        .writeTo(table)
        .using("parquet")
        .option("path", path)
        .option("compression", "snappy")
        .partitionedBy(F.col("year"), F.col("month"))
        .create()
    )
    return spark.table(table)


def read_declared_partitions(
    spark: SparkSession, path: str, ranges: Mapping[str, tuple[int, int]]
) -> DataFrame:
    """Table over a folder whose partitions are declared as ranges: others give no rows."""
    df = spark.read.parquet(path)
    for name, (low, high) in ranges.items():
        df = df.filter(F.col(name).between(low, high))
    return df


def read_partitions(
    spark: SparkSession, path: str, required: Sequence[str], where: Mapping[str, object]
) -> DataFrame:
    """Scan with the partition-filter convention: refuses to read without all ``required`` keys."""
    missing = [name for name in required if name not in where]
    if missing:
        raise ValueError(f"partition predicate missing for: {', '.join(missing)}")
    df = spark.read.parquet(path)
    for name, value in where.items():
        df = df.filter(F.col(name) == F.lit(value))
    return df


def load_columns(df: DataFrame, mapping: Mapping[str, str], path: str) -> None:
    """Append the chosen columns (target name -> source name) to a table folder."""
    df.select(*[F.col(src).alias(dst) for dst, src in mapping.items()]).write.mode("append").parquet(path)


def append_batched(
    df: DataFrame,
    table: str,
    jdbc_url: str | None = None,
    batch_rows: int = 5000,
    properties: Mapping[str, str] | None = None,
    path: str | None = None,
) -> None:
    """Append to a warehouse over JDBC in batches, or to a catalog table when no url is given."""
    if jdbc_url:
        options = {**(properties or {}), "batchsize": str(batch_rows)}
        df.write.mode("append").options(**options).jdbc(jdbc_url, table)
        return
    writer = df.write.mode("append").format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def write_report(df: DataFrame, path: str) -> None:
    """Report or lineage rows as JSON lines."""
    df.write.mode("overwrite").json(path)
