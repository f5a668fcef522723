"""Keyed upserts and change logs: new table = f(old table, incoming rows)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custodia.session import clock


def one_row_per_key(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Of rows with an equal key the one whose other columns are largest, compared in their order.

    The choice depends on the rows alone. The aggregate is partitioned by the key, as is the join behind it.
    """
    rest = [c for c in df.columns if c not in key]
    if not rest:
        return df.distinct()
    return df.groupBy(*key).agg(F.max(F.struct(*rest)).alias("_row")).select(*[F.col(c) if c in key else F.col(f"_row.{c}").alias(c) for c in df.columns])


def _sides(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """Full outer join of two keyed tables as structs ``o`` and ``n``."""
    left = old.select(*[F.col(k).alias(f"_o{i}") for i, k in enumerate(key)], F.struct(*old.columns).alias("o"))
    right = new.select(*[F.col(k).alias(f"_n{i}") for i, k in enumerate(key)], F.struct(*new.columns).alias("n"))
    on = F.lit(True)
    for i in range(len(key)):
        on = on & (F.col(f"_o{i}") == F.col(f"_n{i}"))
    return left.join(right, on, "full").select("o", "n")


def upsert_type1(
    target: DataFrame,
    incoming: DataFrame,
    key: Sequence[str],
    attributes: Sequence[str],
    as_of: str,
    actor: str = "data_engineer",
    approver: str = "data_steward",
    only_if_changed: bool = False,
) -> DataFrame:
    """Insert new keys at version 1; overwrite matched keys and raise their version.

    ``created_*`` survive. A match without any difference raises the version too
    unless ``only_if_changed``. Of several incoming rows of a key one counts (``one_row_per_key``).
    """
    both = _sides(target, one_row_per_key(incoming, key), key)
    return both.select(*_type1_row(target.columns, key, attributes, as_of, actor, approver, only_if_changed))


def _type1_row(
    columns: Sequence[str], key: Sequence[str], attributes: Sequence[str], as_of: str, actor: str, approver: str, only_if_changed: bool
) -> list[Column]:
    """The columns of the new row from the old row ``o`` and the incoming row ``n``, one of which may be missing."""
    now = clock(as_of)
    o, n = F.col("o"), F.col("n")
    update = o.isNotNull() & n.isNotNull()
    if only_if_changed:
        same = F.lit(True)
        for a in attributes:
            same = same & F.col(f"o.{a}").eqNullSafe(F.col(f"n.{a}"))
        update = update & ~same
    write = o.isNull() | update
    filled = {
        "version": F.when(o.isNull(), F.lit(1)).when(update, F.col("o.version") + 1).otherwise(F.col("o.version")),
        "created_at": F.when(o.isNull(), now).otherwise(F.col("o.created_at")),
        "created_by": F.when(o.isNull(), F.lit(actor)).otherwise(F.col("o.created_by")),
        "updated_at": F.when(write, now).otherwise(F.col("o.updated_at")),
        "updated_by": F.when(write, F.lit(actor)).otherwise(F.col("o.updated_by")),
        "approved_at": F.when(write, now).otherwise(F.col("o.approved_at")),
        "approved_by": F.when(write, F.lit(approver)).otherwise(F.col("o.approved_by")),
    }
    out = []
    for c in columns:
        if c in key:
            value = F.coalesce(F.col(f"o.{c}"), F.col(f"n.{c}"))
        elif c in attributes:
            value = F.when(write, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}"))
        else:
            value = filled.get(c, F.col(f"o.{c}"))
        out.append(value.alias(c))
    return out


def upsert_logged(
    target: DataFrame, incoming: DataFrame, key: Sequence[str], attributes: Sequence[str], as_of: str, folder: str,
    actor: str = "data_engineer", approver: str = "data_steward", deleted: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``upsert_type1`` with its change rows: the new table, and (op, key, changed_at, changed_by, old_row, new_row).

    Every row that is written is logged, also an update that leaves all values as they
    were, which no comparison of two states can show. Keys of ``deleted`` are removed and
    logged, unless they come in again. The change set is computed once and written below
    ``folder``; the new table and the log are read from it.
    """
    spark, on = target.sparkSession, list(key)
    fresh = one_row_per_key(incoming, key)
    touched = _sides(target, fresh, key).where("n IS NOT NULL")
    row = F.struct(*_type1_row(target.columns, key, attributes, as_of, actor, approver, False))
    changes = touched.select(F.when(F.col("o").isNull(), "INSERT").otherwise("UPDATE").alias("op"), "o", row.alias("r"))
    if deleted is not None:
        gone = target.join(deleted.select(*on).distinct(), on, "left_semi").join(fresh.select(*on), on, "left_anti").select(*target.columns)
        old = F.struct(*[F.col(c) for c in target.columns])
        changes = changes.unionByName(gone.select(F.lit("DELETE").alias("op"), old.alias("o")), allowMissingColumns=True)
    changes.write.parquet(f"{folder}/changes")
    changes = spark.read.parquet(f"{folder}/changes")
    named = [F.coalesce(F.col(f"o.{k}"), F.col(f"r.{k}")).alias(k) for k in key]
    kept = target.join(changes.select(*named), on, "left_anti").select(*target.columns)
    new = kept.unionByName(changes.where("r IS NOT NULL").select("r.*"))
    log = changes.select("op", *named, clock(as_of).alias("changed_at"), F.lit(actor).alias("changed_by"), F.to_json("o").alias("old_row"), F.to_json("r").alias("new_row"))
    return new, log


def insert_if_absent(target: DataFrame, incoming: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows with new keys are added, one for each key."""
    fresh = one_row_per_key(incoming, key).join(target.select(*key), list(key), "left_anti")
    return target.unionByName(fresh, allowMissingColumns=True)


def upsert_measures(
    target: DataFrame, incoming: DataFrame, key: Sequence[str], as_of: str, actor: str = "sql_transform_v1"
) -> DataFrame:
    """Overwrite the measures of matched keys, insert new ones; ``created_*`` survive. Of several incoming rows of a key one counts."""
    both = _sides(target, one_row_per_key(incoming, key), key)
    missing = {"created_at": clock(as_of), "created_by": F.lit(actor)}
    have = set(incoming.columns)
    out = []
    for c in target.columns:
        if c in key:
            value = F.coalesce(F.col(f"n.{c}"), F.col(f"o.{c}"))
        elif c in missing:
            value = F.when(F.col("o").isNull(), missing[c]).otherwise(F.col(f"o.{c}"))
        elif c in have:
            value = F.when(F.col("n").isNotNull(), F.col(f"n.{c}")).otherwise(F.col(f"o.{c}"))
        else:
            value = F.col(f"o.{c}")
        out.append(value.alias(c))
    return both.select(*out)


def replace_by_key(target: DataFrame, rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """Delete the keys of ``rows`` from the target, then add ``rows``."""
    return target.join(rows.select(*key).distinct(), list(key), "left_anti").unionByName(rows)


def change_log(old: DataFrame, new: DataFrame, key: Sequence[str], as_of: str, actor: str) -> DataFrame:
    """(op, key, changed_at, changed_by, old_row, new_row) between two states of a table.

    A rewrite that leaves a row equal is not a change here.
    """
    both = _sides(old, new, key)
    o, n = F.col("o"), F.col("n")
    op = (
        F.when(o.isNull(), "INSERT")
        .when(n.isNull(), "DELETE")
        .when(~o.eqNullSafe(n), "UPDATE")
    )
    return (
        both.withColumn("op", op)
        .filter(F.col("op").isNotNull())
        .select(
            "op",
            *[F.coalesce(F.col(f"o.{k}"), F.col(f"n.{k}")).alias(k) for k in key],
            clock(as_of).alias("changed_at"),
            F.lit(actor).alias("changed_by"),
            F.to_json("o").alias("old_row"),
            F.to_json("n").alias("new_row"),
        )
    )
