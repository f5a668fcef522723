"""Lookup joins.

No broadcast hint anywhere: Spark broadcasts a lookup when its own size check
allows, and otherwise shuffles, where AQE splits the partitions of a hot key.
``salts`` spreads a known hot key when AQE cannot (or is off).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def prefixed(lookup: DataFrame, prefix: str) -> DataFrame:
    return lookup.select(*[F.col(c).alias(f"{prefix}{c}") for c in lookup.columns])


def enrich(
    fact: DataFrame,
    lookup: DataFrame,
    fact_key: str,
    lookup_key: str,
    prefix: str = "",
    salts: int = 1,
    salt_on: Sequence[str] | None = None,
) -> DataFrame:
    """Left join one role of a lookup; every lookup column gets the role's prefix."""
    role = prefixed(lookup, prefix)
    on = fact[fact_key] == role[f"{prefix}{lookup_key}"]
    if salts <= 1:
        return fact.join(role, on, "left")
    spread = list(salt_on or fact.columns)
    salted = fact.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(salts)))
    copies = role.withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    on = (salted[fact_key] == copies[f"{prefix}{lookup_key}"]) & (salted["_salt"] == copies["_copy"])
    return salted.join(copies, on, "left").drop("_salt", "_copy")


def enrich_roles(
    fact: DataFrame, lookup: DataFrame, lookup_key: str, roles: Mapping[str, str], salts: int = 1
) -> DataFrame:
    """Join the same lookup once per role: {prefix: fact key}."""
    for prefix, fact_key in roles.items():
        fact = enrich(fact, lookup, fact_key, lookup_key, prefix, salts)
    return fact


def orphans(fact: DataFrame, lookup: DataFrame, fact_key: str, lookup_key: str) -> DataFrame:
    """Distinct non-null keys without a lookup row, with their fact row counts.

    Rows are counted per key before the join, so a hot key crosses the shuffle
    as one partial count per task.
    """
    per_key = (
        fact.filter(F.col(fact_key).isNotNull())
        .groupBy(F.col(fact_key).alias("key_value"))
        .agg(F.count("*").alias("fact_rows"))
    )
    known = lookup.select(F.col(lookup_key).alias("key_value")).dropna()
    return per_key.join(known, "key_value", "left_anti")
