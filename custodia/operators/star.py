"""Star schema: dimensions from golden records, fact with surrogate keys."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custodia.functions import date_attributes, pass_fail
from custodia.operators.keys import KeyRegistry, extend_keys, surrogate_keys
from custodia.session import clock


def date_dimension(fact: DataFrame, ts_col: str, existing: DataFrame | None = None) -> DataFrame:
    """Distinct fact dates with calendar attributes; dates already present are kept out."""
    days = fact.select(F.to_date(ts_col).alias("full_date")).dropna().distinct()
    if existing is not None:
        days = days.join(existing.select("full_date"), "full_date", "left_anti")
    return days.withColumns(date_attributes("full_date"))


def approved_dimension(versions: DataFrame, columns: list[str]) -> DataFrame:
    """Current and APPROVED versions only."""
    return versions.filter(F.col("is_current") & (F.col("approval_status") == "APPROVED")).select(*columns)


def active_dimension(master: DataFrame, lifecycle: DataFrame, id_col: str) -> DataFrame:
    """Master rows whose lifecycle state is ACTIVE."""
    active = lifecycle.filter("lifecycle_state = 'ACTIVE'").select(id_col, "lifecycle_state")
    return master.join(active, id_col)


def keyed(dim: DataFrame, natural_key: str, name: str, existing: DataFrame | None = None, registry: KeyRegistry | None = None, build: int = 1) -> DataFrame:
    """The dimension with surrogate keys; members of an ``existing`` one keep theirs and stay, also when ``dim`` lacks them.

    With a ``registry`` the keys come from there, so that a member keeps its key even
    if it was gone from the dimension in between.
    """
    if registry is not None:
        rows = registry.register(dim, build)
    elif existing is not None:
        rows = extend_keys(dim, [natural_key], name, existing)
    else:
        rows = surrogate_keys(dim, [natural_key], name)
    if existing is None:
        return rows
    gone = existing.join(dim.select(natural_key), natural_key, "left_anti")
    return rows.unionByName(gone.select(*[c for c in gone.columns if c in rows.columns]), allowMissingColumns=True)


def resolve_keys(fact: DataFrame, roles: Mapping[str, tuple[DataFrame, str, str, str]]) -> DataFrame:
    """Resolve several dimensions in one plan; unmatched keys give NULL.

    ``roles``: {output column: (dimension, natural key, surrogate key, fact column)}.
    """
    for out, (dim, natural, surrogate, fact_col) in roles.items():
        side = dim.select(F.col(natural).alias("_nk"), F.col(surrogate).alias(out))
        fact = fact.join(side, F.col(fact_col) == F.col("_nk"), "left").drop("_nk")
    return fact


def star_expectations(fact: DataFrame, keys: Mapping[str, str], amount: str, max_orphan_pct: float) -> DataFrame:
    """Orphan share per role and negative amounts, with status."""
    shares = [
        (F.lit(100.0) * F.count_if(F.col(c).isNull()) / F.nullif(F.count("*"), F.lit(0))).alias(name)
        for name, c in keys.items()
    ]
    one = fact.agg(*shares, F.count_if(F.col(amount) < 0).cast("double").alias("_negative"))

    def row(name: str, value, limit: float):
        measured = F.coalesce(F.col(value), F.lit(0.0))
        return F.struct(
            F.lit(name).alias("expectation"), measured.alias("value"), pass_fail(measured <= limit).alias("status")
        )

    rows = [row(name, name, max_orphan_pct) for name in keys] + [row("negative_amount_rows", "_negative", 0.0)]
    return one.select(F.inline(F.array(*rows)))


def dataset_kpis(
    registry: DataFrame,
    fact: DataFrame,
    dataset: str,
    ts_col: str,
    amount: str,
    as_of: str,
    days: int = 30,
    count_missing_as_one: bool = False,
) -> DataFrame:
    """Registry rows with revenue and trips of the last days for the one fact dataset.

    The fact is filtered and aggregated to a single row before the join.
    ``count_missing_as_one`` gives datasets without fact rows one trip, as a
    row count over a left join does.
    """
    since = clock(as_of) - F.make_dt_interval(F.lit(days))
    recent = fact.filter(F.col(ts_col) >= since)
    one = recent.agg(
        F.sum(amount).alias("revenue_30d"),
        F.count("*").alias("trips_30d"),
        # NULL without recent rows; as an aggregate it stays a join key instead of becoming a filter
        F.max(F.lit(dataset)).alias("dataset_name"),
    )
    none = F.lit(1 if count_missing_as_one else 0)
    trips = F.when(F.coalesce("trips_30d", F.lit(0)) > 0, F.col("trips_30d")).otherwise(none)
    return registry.join(one, "dataset_name", "left").withColumn("trips_30d", trips)
