"""Versioned master data (slowly changing dimension, type 2).

Every operation is "new table = f(old table, change set)", one plan, written
once. Expired rows pass through untouched; only current rows, which are unique
per key, take part in a join, so no key is hot there however long its history.

Several requests for a key: with an ``order`` they are folded one after the other
(``fold``, ``approve``, ``rollback``). Without one there is one row per key: equal repeats
count once, and a key with different rows is left out and reported as an error.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custodia.functions import row_hash
from custodia.operators.ordered import Ordered
from custodia.session import clock, work_dir

# Fixed table layout besides key and attributes: (name, type).
VERSION_COLUMNS = (
    ("version_number", "int"),
    ("effective_from", "timestamp_ntz"),
    ("effective_to", "timestamp_ntz"),
    ("is_current", "boolean"),
    ("created_at", "timestamp_ntz"),
    ("created_by", "string"),
    ("approved_at", "timestamp_ntz"),
    ("approved_by", "string"),
    ("approval_status", "string"),
    ("change_reason", "string"),
    ("change_source", "string"),
    ("change_batch_id", "string"),
    ("is_rollback", "boolean"),
    ("rollback_from_version", "int"),
)
STATUSES = ("PENDING", "APPROVED", "REJECTED")
HISTORY_COLUMNS = (
    "version_number",
    "effective_from",
    "effective_to",
    "is_current",
    "approval_status",
    "approved_by",
    "approved_at",
    "change_reason",
    "change_source",
    "change_batch_id",
    "is_rollback",
    "rollback_from_version",
)


@dataclass(frozen=True)
class Scd2:
    """Layout of one versioned table: natural key, attributes, and how change is seen."""

    key: str
    attributes: tuple[str, ...]
    domain: str = "master"
    by_hash: bool = False

    @property
    def columns(self) -> list[str]:
        return [self.key, *self.attributes, *[n for n, _ in VERSION_COLUMNS]]

    def _version_row(self, key: Column, attributes: dict[str, Column], **known: Column) -> Column:
        """One table row as a struct; layout columns not named in ``known`` are NULL."""
        fields = [key.alias(self.key)]
        fields += [attributes[a].alias(a) for a in self.attributes]
        for name, kind in VERSION_COLUMNS:
            fields.append(known.get(name, F.lit(None)).cast(kind).alias(name))
        return F.struct(*fields)

    # -- change detection ---------------------------------------------------

    def changes(self, dim: DataFrame, stage: DataFrame) -> DataFrame:
        """Current rows (struct ``c``) full-outer-joined with the stage (struct ``s``) and two flags."""
        current = self.current(dim)
        mine = [F.col(c) for c in self.columns]
        hashes = [row_hash(self.attributes).alias("_hash")] if self.by_hash else []
        left = current.select(F.col(self.key).alias("_k"), F.struct(*mine, *hashes).alias("c"))
        stage = one_request_per_key(self._staged(stage), self.key)
        right = stage.select(
            F.col(self.key).alias("_sk"), F.struct(*[F.col(c) for c in stage.columns], *hashes).alias("s")
        )
        joined = left.join(right, F.col("_k") == F.col("_sk"), "full")
        if self.by_hash:
            differs = F.col("c._hash") != F.col("s._hash")
        else:
            differs = F.lit(False)
            for a in self.attributes:
                differs = differs | ~F.col(f"c.{a}").eqNullSafe(F.col(f"s.{a}"))
        return joined.select(
            "c",
            "s",
            (F.col("s").isNotNull() & F.col("c").isNull()).alias("is_new"),
            (F.col("s").isNotNull() & F.col("c").isNotNull() & differs).alias("is_changed"),
        )

    def _staged(self, stage: DataFrame, more: Sequence[str] = ()) -> DataFrame:
        """The stage with the optional provenance columns filled in as NULL."""
        wanted = [self.key, *self.attributes, "change_reason", "change_source", "change_batch_id"]
        wanted += [c for c in dict.fromkeys(more) if c not in wanted]
        present = set(stage.columns)
        return stage.select(
            *[F.col(c) if c in present else F.lit(None).cast("string").alias(c) for c in wanted]
        )

    # -- apply --------------------------------------------------------------

    def apply(
        self,
        dim: DataFrame,
        stage: DataFrame,
        as_of: str,
        actor: str | None = None,
        default_reason: str | None = None,
        default_source: str | None = None,
    ) -> DataFrame:
        """New table: version 1 for new keys, expire and version n+1 for changed ones.

        Keys absent from the stage and unchanged keys stay as they are. A key with
        different stage rows stays as it is too (see ``stage_errors``; ``fold`` applies all).
        """
        now = clock(as_of)
        changed = F.col("is_changed")
        old = self._version_row(
            F.col(f"c.{self.key}"),
            {a: F.col(f"c.{a}") for a in self.attributes},
            **{
                n: F.col(f"c.{n}")
                for n, _ in VERSION_COLUMNS
                if n not in ("effective_to", "is_current")
            },
            effective_to=F.when(changed, now).otherwise(F.col("c.effective_to")),
            is_current=~changed,
        )
        new = self._version_row(
            F.col(f"s.{self.key}"),
            {a: F.col(f"s.{a}") for a in self.attributes},
            version_number=F.coalesce(F.col("c.version_number"), F.lit(0)) + 1,
            effective_from=now,
            is_current=F.lit(True),
            created_at=now,
            created_by=F.lit(actor or "system"),
            approval_status=F.lit("PENDING"),
            change_reason=F.coalesce(F.col("s.change_reason"), F.lit(default_reason)),
            change_source=F.coalesce(F.col("s.change_source"), F.lit(default_source)),
            change_batch_id=F.col("s.change_batch_id"),
            is_rollback=F.lit(False),
        )
        rows = F.array_compact(
            F.array(
                F.when(F.col("c").isNotNull(), old),
                F.when(F.col("is_new") | changed, new),
            )
        )
        touched = self.changes(dim, stage).select(F.inline(rows))
        return self._expired(dim).unionByName(touched)

    def stage_errors(self, stage: DataFrame) -> DataFrame:
        """Stage keys that ``apply`` leaves out, with their rows counted."""
        return repeated_requests(self._staged(stage), self.key)

    # -- fold ---------------------------------------------------------------

    def steps(self, dim: DataFrame, stage: DataFrame, order: Sequence[str], as_of: str, at: str | None = None) -> DataFrame:
        """The stage rows that change their key, in order: ``s``, the current row ``c``, the number ``n`` of the change and its times.

        A row counts if its attributes differ from the row before it (from the current
        row, if it is the first). Rows that ``order`` does not part are ordered by their
        other columns. ``at`` names the time of a change; without it all happen at ``as_of``.
        Written to the shared folder, as several branches read it.
        """
        spark, folder = stage.sparkSession, work_dir(stage.sparkSession, "fold")
        staged = self._staged(stage, [*order, *([at] if at else [])])
        state = row_hash(self.attributes) if self.by_hash else F.struct(*self.attributes)
        time = F.col(at).cast("timestamp_ntz") if at else clock(as_of)
        staged = staged.withColumns({"_state": F.struct(state.alias("v")), "_time": time})
        total = [*order, *[c for c in staged.columns if c not in (*order, self.key, "_state")]]
        rows = Ordered(staged, [self.key], total, f"{folder}/rows").last("_before", F.col("_state"), inclusive=False).plain()
        mine = F.struct(state.alias("v"))
        current = self.current(dim).select(F.col(self.key).alias("_k"), F.struct(*self.columns).alias("c"), mine.alias("_now"))
        rows = rows.join(current, F.col(self.key) == F.col("_k"), "left")
        before = F.coalesce("_before", "_now")
        kept = rows.where(before.isNull() | ~F.col("_state").eqNullSafe(before))
        # the next change is read off the order: a join with the steps themselves may broadcast them, however many they are
        numbered = Ordered(kept, [self.key], total, f"{folder}/kept").next("_next", F.struct("_time")).total("n", F.lit(1)).plain()
        numbered.select(
            F.col(self.key).alias("_k"), F.struct(*[c for c in staged.columns if not c.startswith("_")]).alias("s"), "c", F.col("n").cast("int").alias("n"), "_time",
            F.col("_next._time").alias("_until"), F.col("_next").isNotNull().alias("_more"),
        ).write.parquet(f"{folder}/steps")
        return spark.read.parquet(f"{folder}/steps")

    def fold(
        self, dim: DataFrame, stage: DataFrame, order: Sequence[str], as_of: str, actor: str | None = None,
        default_reason: str | None = None, default_source: str | None = None, at: str | None = None, steps: DataFrame | None = None,
    ) -> DataFrame:
        """New table after all stage rows of each key in ``order``: versions n+1 .. n+k, the last one current.

        ``steps`` can hand over the result of ``steps`` where its audit is written as well.
        """
        steps = self.steps(dim, stage, order, as_of, at) if steps is None else steps
        base = F.coalesce(F.col("c.version_number"), F.lit(0))
        new = self._version_row(
            F.col("_k"), {a: F.col(f"s.{a}") for a in self.attributes}, version_number=base + F.col("n"), effective_from=F.col("_time"),
            effective_to=F.col("_until"), is_current=~F.col("_more"), created_at=clock(as_of), created_by=F.lit(actor or "system"), approval_status=F.lit("PENDING"),
            change_reason=F.coalesce(F.col("s.change_reason"), F.lit(default_reason)), change_source=F.coalesce(F.col("s.change_source"), F.lit(default_source)),
            change_batch_id=F.col("s.change_batch_id"), is_rollback=F.lit(False),
        )
        # one row per changed key: never broadcast, whatever its size is guessed from the files
        first = steps.where("n = 1").select(F.col("_k").alias("_changed"), F.col("_time").alias("_since")).hint("merge")
        hit = F.col("_changed").isNotNull()
        current = self.current(dim).join(first, F.col(self.key) == F.col("_changed"), "left").withColumns({
            "effective_to": F.when(hit, F.col("_since")).otherwise(F.col("effective_to")), "is_current": ~hit,
        })
        return self._expired(dim).unionByName(current.select(*self.columns)).unionByName(steps.select(new.alias("r")).select("r.*"))

    def fold_audit(self, steps: DataFrame, as_of: str, actor: str | None = None) -> DataFrame:
        """UPSERT audit rows of ``fold``, one for each version it writes."""
        version = F.coalesce(F.col("c.version_number"), F.lit(0)) + F.col("n")
        batch = F.col("s.change_batch_id").alias("batch")
        details = F.when(version == 1, F.to_json(F.struct(F.lit("insert_new_key").alias("type"), version.alias("version"), batch))).otherwise(
            F.to_json(F.struct(F.lit("attribute_change").alias("type"), (version - 1).alias("from_version"), version.alias("to_version"), batch))
        )
        return self._audit(steps, F.col("_k"), "UPSERT", as_of, F.lit(actor or "system"), details)

    def initial_load(self, incoming: DataFrame, as_of: str, actor: str | None = None) -> DataFrame:
        """Version 1 of every key."""
        empty = incoming.select(
            F.col(self.key),
            *self.attributes,
            *[F.lit(None).cast(t).alias(n) for n, t in VERSION_COLUMNS],
        ).limit(0)
        return self.apply(empty, incoming, as_of, actor)

    def apply_audit(self, dim: DataFrame, stage: DataFrame, as_of: str, actor: str | None = None) -> DataFrame:
        """UPSERT audit rows of ``apply``."""
        hits = self.changes(dim, stage).filter(F.col("is_new") | F.col("is_changed"))
        old_version = F.col("c.version_number")
        details = F.when(
            F.col("is_new"),
            F.to_json(
                F.struct(
                    F.lit("insert_new_key").alias("type"),
                    F.lit(1).alias("version"),
                    F.col("s.change_batch_id").alias("batch"),
                )
            ),
        ).otherwise(
            F.to_json(
                F.struct(
                    F.lit("attribute_change").alias("type"),
                    old_version.alias("from_version"),
                    (old_version + 1).alias("to_version"),
                    F.col("s.change_batch_id").alias("batch"),
                )
            )
        )
        return self._audit(hits, F.col(f"s.{self.key}"), "UPSERT", as_of, F.lit(actor or "system"), details)

    def _audit(self, df, key, action, as_of, actor, details) -> DataFrame:
        return df.select(
            F.lit(self.domain).alias("domain"),
            key.cast("string").alias("natural_key"),
            F.lit(action).alias("action"),
            clock(as_of).alias("action_at"),
            actor.alias("action_by"),
            details.alias("details"),
        )

    # -- views --------------------------------------------------------------

    def current(self, dim: DataFrame) -> DataFrame:
        return dim.filter(F.col("is_current")).select(*self.columns)

    def _expired(self, dim: DataFrame) -> DataFrame:
        return dim.filter(~F.col("is_current")).select(*self.columns)

    def history(self, dim: DataFrame, ranges: DataFrame) -> DataFrame:
        """Versions overlapping [range_from, range_to] per requested key (closed interval)."""
        asked = ranges.select(F.col(self.key).alias("_k"), "range_from", "range_to")
        overlap = (F.col("effective_from") <= F.col("range_to")) & (
            F.col("effective_to").isNull() | (F.col("effective_to") >= F.col("range_from"))
        )
        return dim.join(asked, (F.col(self.key) == F.col("_k")) & overlap).select(self.key, *HISTORY_COLUMNS)

    # -- approve ------------------------------------------------------------

    def _requests(self, dim: DataFrame, requests: DataFrame) -> DataFrame:
        """Requests (struct ``q``) with the current row (struct ``c``) of their key."""
        current = self.current(dim).select(F.col(self.key).alias("_k"), F.struct(*self.columns).alias("c"))
        asked = requests.select(F.col(self.key).alias("_qk"), F.struct(*requests.columns).alias("q"))
        return asked.join(current, F.col("_qk") == F.col("_k"), "left")

    def _approvals(self, approvals: DataFrame, order: Sequence[str] | None) -> DataFrame:
        """One approval per key: folded, the last approver and the first reason given."""
        if order is None:
            return one_request_per_key(approvals.select(self.key, "approver", "reason"), self.key)
        turn = F.struct(*order, "approver", "reason")
        return approvals.groupBy(self.key).agg(
            F.max_by("approver", turn).alias("approver"), F.min_by("reason", F.when(F.col("reason").isNotNull(), turn)).alias("reason")
        )

    def approve(self, dim: DataFrame, approvals: DataFrame, as_of: str, order: Sequence[str] | None = None) -> DataFrame:
        """Approve the current version of each requested key (columns: key, approver, reason)."""
        asked = self._approvals(approvals, order).select(
            F.col(self.key).alias("_k"), F.col("approver").alias("_who"), F.col("reason").alias("_why")
        )
        hit = F.col("_k").isNotNull()
        approved = (
            self.current(dim)
            .join(asked, F.col(self.key) == F.col("_k"), "left")
            .withColumns(
                {
                    "approved_by": F.when(hit, F.col("_who")).otherwise(F.col("approved_by")),
                    "approved_at": F.when(hit, clock(as_of)).otherwise(F.col("approved_at")),
                    "approval_status": F.when(hit, F.lit("APPROVED")).otherwise(F.col("approval_status")),
                    "change_reason": F.when(hit, F.coalesce("change_reason", "_why")).otherwise(
                        F.col("change_reason")
                    ),
                }
            )
            .select(*self.columns)
        )
        return self._expired(dim).unionByName(approved)

    def approve_errors(self, dim: DataFrame, approvals: DataFrame, order: Sequence[str] | None = None) -> DataFrame:
        """Requests that name a key without a current version; without an ``order`` also keys with different requests."""
        missing = self._requests(dim, self._approvals(approvals, order)).filter(F.col("c").isNull())
        errors = missing.select(F.col("_qk").alias(self.key), F.lit("no_current_version").alias("error"))
        if order is None:
            errors = errors.unionByName(repeated_requests(approvals.select(self.key, "approver", "reason"), self.key).select(self.key, "error"))
        return errors

    def approve_audit(self, dim: DataFrame, approvals: DataFrame, as_of: str, order: Sequence[str] | None = None) -> DataFrame:
        """One row per approval that counts; folded approvals each count."""
        each = self._approvals(approvals, order) if order is None else approvals
        hits = self._requests(dim, each).filter(F.col("c").isNotNull())
        details = F.to_json(
            F.struct(
                F.col("c.version_number").alias("approved_version"), F.col("q.reason").alias("reason")
            )
        )
        return self._audit(hits, F.col("_qk"), "APPROVE", as_of, F.col("q.approver"), details)

    # -- roll back ----------------------------------------------------------

    def _asked(self, requests: DataFrame, order: Sequence[str] | None) -> DataFrame:
        return one_request_per_key(requests, self.key) if order is None else requests

    def _rollbacks(self, dim: DataFrame, requests: DataFrame, order: Sequence[str] | None = None) -> DataFrame:
        """Requests with current row ``c`` and target row ``t`` (columns: key, target_version, actor, reason)."""
        return self._requests(dim, self._asked(requests, order)).join(self._targets(dim), self._is_target(), "left")

    def _valid_rollbacks(self, dim: DataFrame, requests: DataFrame, order: Sequence[str] | None) -> DataFrame:
        """Requests that can be done: ``q``, ``t``, ``c``, the number ``n`` of the new version after the current one, and whether more follow."""
        done = self._rollbacks(dim, requests, order).filter(F.col("c").isNotNull() & F.col("t").isNotNull()).select("_qk", "q", "t", "c")
        if order is None:
            return done.withColumns({"n": F.lit(1), "_more": F.lit(False)})
        spark, folder = dim.sparkSession, work_dir(dim.sparkSession, "rollbacks")
        names = [f"_o{i}" for i in range(len(order))]
        done = done.withColumns({name: F.col(f"q.{c}") for name, c in zip(names, order, strict=True)}).withColumn("_rest", F.to_json("q"))
        numbered = Ordered(done, ["_qk"], [*names, "_rest"], f"{folder}/rows").total("n", F.lit(1)).plain()
        numbered.select("_qk", "q", "t", "c", F.col("n").cast("int").alias("n")).write.parquet(f"{folder}/numbered")
        numbered = spark.read.parquet(f"{folder}/numbered")
        # one row per request: never broadcast, whatever its size is guessed from the files
        following = numbered.select(F.col("_qk").alias("_nk"), (F.col("n") - 1).alias("_nn")).hint("merge")
        joined = numbered.join(following, (F.col("_qk") == F.col("_nk")) & (F.col("n") == F.col("_nn")), "left")
        return joined.select("_qk", "q", "t", "c", "n", F.col("_nk").isNotNull().alias("_more"))

    def _targets(self, dim: DataFrame) -> DataFrame:
        return dim.select(
            F.col(self.key).alias("_tk"),
            F.col("version_number").alias("_tv"),
            F.struct(*self.attributes).alias("t"),
        )

    @staticmethod
    def _is_target() -> Column:
        # version_number is part of the join key, so a long history of one key spreads over partitions
        return (F.col("_qk") == F.col("_tk")) & (F.col("q.target_version") == F.col("_tv"))

    def rollback(self, dim: DataFrame, requests: DataFrame, as_of: str, order: Sequence[str] | None = None) -> DataFrame:
        """Append a copy of the target version as the new current one; history is kept.

        Requests without a current row or target are left out (see ``rollback_errors``).
        With an ``order`` all requests of a key are done in turn; targets are versions
        of ``dim``, not of this batch.
        """
        now = clock(as_of)
        done = self._valid_rollbacks(dim, requests, order)
        new = self._version_row(
            F.col("_qk"),
            {a: F.col(f"t.{a}") for a in self.attributes},
            version_number=F.col("c.version_number") + F.col("n"),
            effective_from=now,
            effective_to=F.when(F.col("_more"), now),
            is_current=~F.col("_more"),
            created_at=now,
            created_by=F.col("q.actor"),
            approved_at=now,
            approved_by=F.col("q.actor"),
            approval_status=F.lit("APPROVED"),
            change_reason=F.col("q.reason"),
            change_source=F.lit("ROLLBACK"),
            is_rollback=F.lit(True),
            rollback_from_version=F.col("q.target_version"),
        )
        if order is None:
            # one row per key: the current row is at hand, so expire it and add its successor in one pass
            old = self._version_row(
                F.col(f"c.{self.key}"),
                {a: F.col(f"c.{a}") for a in self.attributes},
                **{n: F.col(f"c.{n}") for n, _ in VERSION_COLUMNS if n not in ("effective_to", "is_current")},
                effective_to=now,
                is_current=F.lit(False),
            )
            touched = done.select("_qk", F.array(old, new).alias("rows"))
            current = self.current(dim).select(F.col(self.key).alias("_k"), F.struct(*self.columns).alias("r"))
            joined = current.join(touched, F.col("_k") == F.col("_qk"), "left")
            return self._expired(dim).unionByName(joined.select(F.inline(F.coalesce("rows", F.array("r")))))
        keys = done.where("n = 1").select(F.col("_qk").alias(self.key))
        return expire(dim.select(*self.columns), keys, self.key, as_of).unionByName(done.select(new.alias("r")).select("r.*"))

    def rollback_errors(self, dim: DataFrame, requests: DataFrame, order: Sequence[str] | None = None) -> DataFrame:
        errors = (
            self._rollbacks(dim, requests, order)
            .filter(F.col("c").isNull() | F.col("t").isNull())
            .select(
                F.col("_qk").alias(self.key),
                F.col("q.target_version").alias("target_version"),
                F.when(F.col("c").isNull(), "no_current_version").otherwise("no_target_version").alias("error"),
            )
        )
        if order is None:
            again = repeated_requests(requests, self.key).select(self.key, F.lit(None).cast("int").alias("target_version"), "error")
            errors = errors.unionByName(again)
        return errors

    def rollback_audit(self, dim: DataFrame, requests: DataFrame, as_of: str, order: Sequence[str] | None = None) -> DataFrame:
        hits = self._valid_rollbacks(dim, requests, order)
        version = F.col("c.version_number") + F.col("n")
        details = F.to_json(
            F.struct(
                (version - 1).alias("from_version"),
                F.col("q.target_version").alias("to_copied_version"),
                version.alias("new_version"),
                F.col("q.reason").alias("reason"),
            )
        )
        return self._audit(hits, F.col("_qk"), "ROLLBACK", as_of, F.col("q.actor"), details)


def _extremes(requests: DataFrame, key: str) -> DataFrame:
    rest = F.struct(*[c for c in requests.columns if c != key])
    return requests.groupBy(key).agg(F.min(rest).alias("_low"), F.max(rest).alias("_high"), F.count("*").alias("rows"))


def one_request_per_key(requests: DataFrame, key: str) -> DataFrame:
    """The rows of keys whose rows are all equal, each once."""
    same = _extremes(requests, key).where(F.col("_low").eqNullSafe(F.col("_high")))
    return same.select(*[F.col(c) if c == key else F.col(f"_low.{c}").alias(c) for c in requests.columns])


def repeated_requests(requests: DataFrame, key: str) -> DataFrame:
    """Keys with different rows, which only an order could resolve."""
    different = _extremes(requests, key).where(~F.col("_low").eqNullSafe(F.col("_high")))
    return different.select(key, "rows", F.lit("repeated_key").alias("error"))


def expire(dim: DataFrame, keys: DataFrame, key: str, as_of: str) -> DataFrame:
    """Close the current rows of the given (distinct) keys: the expire half of a merge."""
    hit = F.col("_hit").isNotNull() & F.col("is_current")
    marked = keys.select(F.col(key).alias("_hit")).distinct()
    return (
        dim.join(marked, F.col(key) == F.col("_hit"), "left")
        .withColumns(
            {
                "effective_to": F.when(hit, clock(as_of)).otherwise(F.col("effective_to")),
                "is_current": F.col("is_current") & F.col("_hit").isNull(),
            }
        )
        .select(*dim.columns)
    )


def unapplied(stage: DataFrame, key: Sequence[str]) -> DataFrame:
    """Stage keys that occur more than once and so cannot be applied."""
    return stage.groupBy(*key).agg(F.count("*").alias("rows")).filter("rows > 1")
