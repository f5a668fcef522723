"""Golden records: one value per field and key, chosen by rule."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class FieldRule:
    """Value of the preferred source, else a fallback: 'none', 'frequent', 'longest' or 'allowed'."""

    fallback: str = "none"
    allowed: tuple[str, ...] = ()


def _smallest(value: Column, *order: Column, when: Column) -> Column:
    """``value`` of the row with the smallest (order..., value), NULLs of ``when`` left out."""
    return F.min(F.when(when, F.struct(*order, value.alias("v"))))["v"]


def golden_records(
    records: DataFrame, key: str, priority: str, rules: Mapping[str, FieldRule], preferred: int = 1
) -> DataFrame:
    """One row per non-null key, plus ``sources`` (record count).

    All choices are min/max aggregates over structs: they combine before the
    shuffle, so a key with many records is never gathered. Ties go to the
    smallest text.
    """
    valid = records.filter(F.col(key).isNotNull())
    aggs = [F.count("*").alias("sources")]
    frequent = []
    for name, rule in rules.items():
        value = F.col(name)
        first = _smallest(value, F.col(priority), when=value.isNotNull() & (F.col(priority) <= preferred))
        aggs.append(first.alias(f"_first_{name}"))
        if rule.fallback == "longest":
            aggs.append(_smallest(value, -F.length(value), when=value.isNotNull()).alias(f"_else_{name}"))
        elif rule.fallback == "allowed":
            ok = F.lower(F.trim(value)).isin(*rule.allowed)
            aggs.append(_smallest(value, F.col(priority), when=ok).alias(f"_else_{name}"))
        elif rule.fallback == "frequent":
            frequent.append(name)
    out = valid.groupBy(key).agg(*aggs)
    for name in frequent:
        counted = valid.filter(F.col(name).isNotNull()).groupBy(key, name).agg(F.count("*").alias("_n"))
        best = counted.groupBy(key).agg(F.min(F.struct(-F.col("_n"), F.col(name).alias("v")))["v"].alias(f"_else_{name}"))
        out = out.join(best, key, "left")
    fields = []
    for name, rule in rules.items():
        fallback = [F.col(f"_else_{name}")] if rule.fallback != "none" else []
        fields.append(F.coalesce(F.col(f"_first_{name}"), *fallback).alias(name))
    return out.select(key, *fields, "sources")


def rejected_records(records: DataFrame, key: str, reference: DataFrame, attributes: Sequence[str]) -> DataFrame:
    """Records without a key, or with a key that is none of those the reference has for their attributes.

    Equal records stay apart; attributes under several keys are for ``steward_flags``.
    """
    by = list(attributes)
    known = reference.select(*by).dropna().distinct().withColumn("_known", F.lit(True))
    same = reference.select(key, *by).dropna().distinct().withColumn("_same", F.lit(True))
    joined = records.join(known, by, "left").join(same, [key, *by], "left")
    conflict = F.col("_known").isNotNull() & F.col("_same").isNull()
    reason = F.when(F.col(key).isNull(), "missing_key").otherwise("key_conflict")
    return joined.filter(F.col(key).isNull() | conflict).withColumn("reject_reason", reason).select(*records.columns, "reject_reason")


def steward_flags(records: DataFrame, key: str, attributes: Sequence[str]) -> DataFrame:
    """Records whose attributes also stand under another key, with the number of keys; they are kept, a steward decides."""
    by = list(attributes)
    twins = records.dropna(subset=[key, *by]).groupBy(*by).agg(F.count_distinct(key).alias("keys")).filter("keys > 1")
    return records.join(twins, by).select(*records.columns, "keys")
