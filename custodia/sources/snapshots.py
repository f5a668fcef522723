"""Published golden snapshots: one immutable folder per publication time."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from custodia.functions import age_hours
from custodia.session import clock
from custodia.sources.footers import footer_counts, in_session


def publish_snapshot(df: DataFrame, base: str, stamp: str) -> str:
    """Write ``df`` to its own folder; an existing stamp is never overwritten."""
    path = f"{base}/snapshot_ts={stamp}"
    df.write.mode("errorifexists").parquet(path)
    return path


def snapshot_inventory(spark: SparkSession, base: str) -> DataFrame:
    """One row per published snapshot: (snapshot_key, published_at, rows), counted in the files' footers; none where nothing was published."""
    try:
        counted = footer_counts(spark, base, ["snapshot_ts"])
    except AnalysisException as missing:  # nothing was ever published
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], "snapshot_key string, rows long, published_at timestamp_ntz")
    return (
        in_session(spark, counted)
        .select(F.col("snapshot_ts").cast("string").alias("snapshot_key"), "rows")
        .withColumn("published_at", F.to_timestamp("snapshot_key", "yyyyMMdd'T'HHmmss").cast("timestamp_ntz"))
    )


def latest_snapshot(inventory: DataFrame, as_of: str | Column) -> DataFrame:
    """Newest snapshot and its age; one row even when the inventory is empty."""
    return inventory.agg(
        F.max_by("snapshot_key", F.struct("published_at", "snapshot_key")).alias("latest_key"),
        F.max("published_at").alias("last_modified"),
    ).withColumn("age_hours", age_hours("last_modified", clock(as_of)))
