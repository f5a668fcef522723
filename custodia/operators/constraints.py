"""Integrity constraints as violation counts: files enforce none of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    return df.groupBy(*key).agg(F.count("*").alias("rows")).filter("rows > 1")


def several_current(df: DataFrame, key: Sequence[str], flag: str = "is_current") -> DataFrame:
    """Keys with more than one current row."""
    return df.filter(F.col(flag)).groupBy(*key).agg(F.count("*").alias("rows")).filter("rows > 1")


def version_gaps(df: DataFrame, key: Sequence[str], version: str = "version_number") -> DataFrame:
    """Keys whose versions are not 1..n, from three aggregates instead of a window over the history."""
    return (
        df.groupBy(*key)
        .agg(F.min(version).alias("lo"), F.max(version).alias("hi"), F.count_distinct(version).alias("n"))
        .filter("lo <> 1 OR hi <> n")
    )


def constraint_report(
    df: DataFrame,
    table: str,
    key: Sequence[str],
    not_null: Sequence[str] = (),
    allowed: dict[str, Sequence[str]] | None = None,
    current_key: Sequence[str] = (),
) -> DataFrame:
    """(table_name, constraint_name, violations) for PK, NOT NULL, CHECK IN and one-current-row."""
    allowed = allowed or {}
    checks = [(f"not_null:{c}", F.count_if(F.col(c).isNull())) for c in not_null]
    checks += [(f"check:{c}", F.count_if(~F.col(c).isin(*values))) for c, values in allowed.items()]
    named = [(name, expr.alias(f"_v{i}")) for i, (name, expr) in enumerate(checks)]
    out = []
    if named:
        rows = [
            F.struct(F.lit(name).alias("constraint_name"), F.col(f"_v{i}").alias("violations"))
            for i, (name, _) in enumerate(named)
        ]
        out.append(df.agg(*[e for _, e in named]).select(F.inline(F.array(*rows))))

    def counted(name, violating):
        return violating.agg(F.count("*").alias("violations")).select(
            F.lit(name).alias("constraint_name"), "violations"
        )

    out.append(counted(f"unique:{','.join(key)}", duplicate_keys(df, key)))
    if current_key:
        out.append(counted(f"one_current:{','.join(current_key)}", several_current(df, current_key)))
    result = out[0]
    for part in out[1:]:
        result = result.unionByName(part)
    return result.select(F.lit(table).alias("table_name"), "constraint_name", "violations")
