"""Lifecycle states of master records, approvals and policies."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custodia.operators.upsert import insert_if_absent
from custodia.session import clock

# Fixed set of states and the moves between them.
STATES = ("PROPOSED", "ACTIVE", "DEPRECATED", "RETIRED")
TRANSITIONS = (("PROPOSED", "ACTIVE"), ("ACTIVE", "DEPRECATED"), ("DEPRECATED", "RETIRED"))


def seed(lifecycle: DataFrame, master: DataFrame, id_col: str, as_of: str, actor: str = "seed_script") -> DataFrame:
    """Every master id without a state becomes ACTIVE."""
    rows = master.select(
        id_col,
        F.lit("ACTIVE").alias("lifecycle_state"),
        F.lit("Seed active state").alias("state_reason"),
        clock(as_of).alias("updated_at"),
        F.lit(actor).alias("updated_by"),
    )
    return insert_if_absent(lifecycle, rows, [id_col])


def invalid_transitions(old: DataFrame, new: DataFrame, id_col: str) -> DataFrame:
    """State changes that are not one allowed step; a new id must start as PROPOSED or ACTIVE."""
    before = old.select(F.col(id_col), F.col("lifecycle_state").alias("old_state"))
    after = new.select(F.col(id_col), F.col("lifecycle_state").alias("new_state"))
    moved = after.join(before, id_col, "left")
    allowed = F.col("old_state").eqNullSafe(F.col("new_state"))
    allowed = allowed | (F.col("old_state").isNull() & F.col("new_state").isin("PROPOSED", "ACTIVE"))
    for source, target in TRANSITIONS:
        allowed = allowed | F.coalesce(
            (F.col("old_state") == source) & (F.col("new_state") == target), F.lit(False)
        )
    return moved.filter(~allowed)


def with_state(master: DataFrame, lifecycle: DataFrame, id_col: str) -> DataFrame:
    return master.join(lifecycle.select(id_col, "lifecycle_state"), id_col, "left")


def approval_decisions(
    changes: DataFrame,
    approvals: DataFrame,
    required: Mapping[str, int],
    approvers: Sequence[str],
    owner_types: Sequence[str],
    overrides: DataFrame,
    as_of: str,
    owner_role: str = "data-owner",
) -> DataFrame:
    """Decision per pending change (change_id, environment, change_type).

    A change needs the environment's number of distinct approver roles, and the
    owner's for owner-only types. An unexpired override with a reason passes it.
    """
    given = (
        approvals.filter(F.col("approver_role").isin(*approvers))
        .groupBy("change_id")
        .agg(
            F.count_distinct("approver_role").alias("approvals"),
            F.max((F.col("approver_role") == owner_role).cast("int")).alias("_owner"),
        )
    )
    live = (
        overrides.filter((F.col("expires_at") > clock(as_of)) & (F.col("reason") != ""))
        .select("change_id")
        .distinct()
        .withColumn("_override", F.lit(True))
    )
    limits = F.create_map(*[F.lit(x) for item in required.items() for x in item])
    need_owner = F.col("change_type").isin(*owner_types)
    # Missing environments need as many approvals as the strictest one.
    need = F.coalesce(F.try_element_at(limits, F.col("environment")), F.lit(max(required.values())))
    enough = F.coalesce(F.col("approvals"), F.lit(0)) >= need
    owner_ok = ~need_owner | (need == 0) | (F.coalesce(F.col("_owner"), F.lit(0)) == 1)
    override = F.coalesce(F.col("_override"), F.lit(False))
    decision = (
        F.when(override, "OVERRIDDEN")
        .when(enough & owner_ok, "APPROVED")
        .when(~enough, "BLOCKED_APPROVALS")
        .otherwise("BLOCKED_OWNER")
    )
    return (
        changes.join(given, "change_id", "left")
        .join(live, "change_id", "left")
        .select(
            *changes.columns,
            F.coalesce("approvals", F.lit(0)).alias("approvals"),
            need.alias("required"),
            decision.alias("decision"),
        )
    )
