"""Schema alignment: casts, names, partition columns, pre-filters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast the listed columns that exist; values that do not fit become NULL."""
    present = set(df.columns)
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items() if c in present})


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def add_year_month(df: DataFrame, ts_col: str) -> DataFrame:
    return df.withColumns({"year": F.year(ts_col), "month": F.month(ts_col)})


def not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.dropna(how="any", subset=list(cols))


def project_view(df: DataFrame, allowed: Sequence[str], masks: Mapping[str, object] | None = None) -> DataFrame:
    """Certified view: allow-listed columns plus masked expressions; raw columns stay hidden."""
    masked = [expr.alias(name) for name, expr in (masks or {}).items()]
    return df.select(*allowed, *masked)
