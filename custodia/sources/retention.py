"""Retention: which partitions have outlived their rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custodia.session import clock


def expired_partitions(
    inventory: DataFrame, as_of: str | Column, days: int = 30, prefix: str = "raw/"
) -> DataFrame:
    """Partitions (path, modified_at) below ``prefix`` that are at least ``days`` old."""
    age = F.floor(F.timestamp_diff("HOUR", F.col("modified_at"), clock(as_of)) / 24)
    return (
        inventory.filter(F.col("path").startswith(prefix))
        .withColumn("age_days", age.cast("long"))
        .filter(F.col("age_days") >= days)
    )
