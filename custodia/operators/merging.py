"""Review queue and merges, set-based."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custodia.operators.components import connected
from custodia.operators.scd2 import one_request_per_key, repeated_requests
from custodia.session import clock, work_dir


def open_items(queue: DataFrame) -> DataFrame:
    return queue.filter("status = 'OPEN'").orderBy(F.desc("confidence"), "review_id")


DECISION = ("review_id", "decision", "reviewer", "notes")


def decide(queue: DataFrame, decisions: DataFrame, as_of: str, order: Sequence[str] | None = None) -> DataFrame:
    """Apply steward decisions (review_id, decision, reviewer, notes) to OPEN rows.

    Of several decisions for a review the first in ``order`` counts, as it closes the
    review. Without an order there is one decision per review: equal repeats count
    once, different ones leave the review open (``decision_errors``).
    """
    if order is None:
        decisions = one_request_per_key(decisions.select(*DECISION), "review_id")
    else:
        turn = F.struct(*order, *DECISION[1:])
        first = decisions.groupBy("review_id").agg(F.min_by(F.struct(*DECISION[1:]), turn).alias("d"))
        decisions = first.select("review_id", "d.*")
    d = decisions.select(
        F.col("review_id").alias("_rid"),
        F.col("decision").alias("_decision"),
        F.col("reviewer").alias("_reviewer"),
        F.col("notes").alias("_notes"),
    )
    hit = F.col("_rid").isNotNull() & (F.col("status") == "OPEN")
    return (
        queue.join(d, F.col("review_id") == F.col("_rid"), "left")
        .withColumns(
            {
                "status": F.when(hit, F.col("_decision")).otherwise(F.col("status")),
                "reviewed_at": F.when(hit, clock(as_of)).otherwise(F.col("reviewed_at")),
                "reviewed_by": F.when(hit, F.col("_reviewer")).otherwise(F.col("reviewed_by")),
                "decision_notes": F.when(hit, F.col("_notes")).otherwise(F.col("decision_notes")),
            }
        )
        .select(*queue.columns)
    )


def decision_errors(decisions: DataFrame) -> DataFrame:
    """Reviews with different decisions and no order between them."""
    return repeated_requests(decisions.select(*DECISION), "review_id")


def escalations(queue: DataFrame, as_of: str, hours: int = 48) -> DataFrame:
    """OPEN items older than ``hours``: they go from the steward to the owner."""
    waited = F.timestamp_diff("MICROSECOND", F.col("created_at"), clock(as_of)) / F.lit(3.6e9)
    return (
        queue.filter("status = 'OPEN'")
        .withColumn("open_hours", F.round(waited, 2))
        .filter(waited > hours)
        .withColumn("escalate_to", F.lit("owner"))
    )


class AutoMerge:
    """Merges of OPEN, AUTO_MERGE pairs at or above the threshold.

    Pairs that share ids form a group, also over several pairs and over pairs that
    an earlier run has MERGED. Its smallest id survives and every other id is retired
    into it, so a retired id always names a survivor that is not retired itself. The
    survivor's name becomes the longest of its own and the newly retired names
    (ties: its own, then higher confidence, then smaller id), and its version rises
    by the number of newly retired ids. Groups that earlier runs had merged apart are
    retired into the survivor of both.

    The queue is read several times, so it should be a stored table.

    Without ``closure`` the pairs are merged one by one, as if no id were in two
    groups: an id can then survive one pair and be retired by another (``chained``).
    """

    def __init__(self, queue: DataFrame, as_of: str, threshold: float = 0.95, approver: str = "auto_merge_bot",
                 left: str = "left_vendor_id", right: str = "right_vendor_id", id_name: str = "vendor_id", closure: bool = True):
        self.queue, self.as_of, self.approver = queue, as_of, approver
        self.id_name, self.closure = id_name, closure
        self.eligible = (
            (F.col("status") == "OPEN")
            & (F.col("recommendation") == "AUTO_MERGE")
            & (F.col("confidence") >= threshold)
        )
        self.survivor = F.least(left, right)
        self.retired = F.greatest(left, right)
        self.pairs = queue.filter(self.eligible).select(
            "review_id", "confidence", self.survivor.alias("survivor"), self.retired.alias("retired")
        )
        self._groups: DataFrame | None = None

    def groups(self) -> DataFrame:
        """``node``, its ``root``, the root it had before these merges (``former``) and the extreme confidences of its pairs.

        One row for every id of an eligible pair or of an earlier merge; written once.
        """
        if self._groups is None:
            spark = self.queue.sparkSession
            folder = work_dir(spark, "groups")
            merged = self.queue.filter("status = 'MERGED'").select(self.survivor.alias("survivor"), self.retired.alias("retired"))
            earlier = merged.select(F.col("survivor").alias("node"), F.col("retired").alias("root")).limit(0)
            if not merged.isEmpty():
                earlier = connected(merged, "survivor", "retired", f"{folder}/earlier")
            ends = self.pairs.select(F.col("survivor").alias("node"), "confidence").unionAll(self.pairs.select(F.col("retired").alias("node"), "confidence"))
            seen = ends.groupBy("node").agg(F.max("confidence").alias("best"), F.min("confidence").alias("worst"))
            nodes = seen.join(earlier, "node", "full").withColumn("former", F.coalesce("root", "node")).drop("root")
            nodes.write.parquet(f"{folder}/nodes")
            nodes = spark.read.parquet(f"{folder}/nodes")
            ends = self.pairs.select("survivor", "retired")
            for side in ("survivor", "retired"):
                known = nodes.select(F.col("node").alias(side), F.col("former").alias("_former"))
                ends = ends.join(known, side).drop(side).withColumnRenamed("_former", side)
            now = connected(ends, "survivor", "retired", f"{folder}/now").withColumnRenamed("node", "former")
            self._groups = nodes.join(now, "former", "left").select("node", F.coalesce("root", "former").alias("root"), "former", "best", "worst")
            self._groups.write.parquet(f"{folder}/groups")
            self._groups = spark.read.parquet(f"{folder}/groups")
        return self._groups

    def _retirements(self) -> DataFrame:
        """One row per retired id: ``survivor``, ``retired``, best and worst confidence, whether it is ``fresh``."""
        if not self.closure:
            each = self.pairs.select("survivor", "retired", F.col("confidence").alias("best"), F.col("confidence").alias("worst"), "review_id")
            return each.withColumn("fresh", F.lit(True))
        moved = self.groups().filter("root <> former")
        return moved.select(
            F.col("root").alias("survivor"), F.col("node").alias("retired"), "best", "worst", F.lit(0).cast("long").alias("review_id"),
            (F.col("node") == F.col("former")).alias("fresh"),
        )

    def named_pairs(self, master: DataFrame, name: str) -> DataFrame:
        """Pairs with both names and the name to keep."""
        s = master.select(F.col(self.id_name).alias("survivor"), F.coalesce(name, F.lit("")).alias("survivor_name"))
        r = master.select(F.col(self.id_name).alias("retired"), F.coalesce(name, F.lit("")).alias("retired_name"))
        keep = F.when(
            F.length("survivor_name") >= F.length("retired_name"), F.col("survivor_name")
        ).otherwise(F.col("retired_name"))
        return self.pairs.join(s, "survivor").join(r, "retired").withColumn("new_name", keep)

    def master(self, master: DataFrame, name: str) -> DataFrame:
        partner = F.struct(F.length("retired_name"), F.coalesce("best", F.lit(0.0)), -F.col("retired"))
        names = master.select(F.col(self.id_name).alias("retired"), F.coalesce(name, F.lit("")).alias("retired_name"))
        best = (
            self._retirements()
            .filter("fresh")
            .join(names, "retired")
            .groupBy(F.col("survivor").alias("_sid"))
            .agg(F.max_by("retired_name", partner).alias("_partner"), F.count("*").alias("_merges"))
        )
        hit = F.col("_sid").isNotNull()
        own = F.coalesce(F.col(name), F.lit(""))
        kept = F.when(F.length(own) >= F.length("_partner"), own).otherwise(F.col("_partner"))
        return (
            master.join(best, F.col(self.id_name) == F.col("_sid"), "left")
            .withColumns(
                {
                    name: F.when(hit, kept).otherwise(F.col(name)),
                    "version": F.when(hit, F.col("version") + F.col("_merges")).otherwise(F.col("version")),
                    "updated_at": F.when(hit, clock(self.as_of)).otherwise(F.col("updated_at")),
                    "updated_by": F.when(hit, F.lit("auto_merge")).otherwise(F.col("updated_by")),
                    "approved_at": F.when(hit, clock(self.as_of)).otherwise(F.col("approved_at")),
                    "approved_by": F.when(hit, F.lit(self.approver)).otherwise(F.col("approved_by")),
                }
            )
            .select(*master.columns)
        )

    def lifecycle(self, lifecycle: DataFrame) -> DataFrame:
        """Retired ids become DEPRECATED; the reason names the survivor and the lowest confidence of their merges."""
        last = F.struct(-F.col("worst"), F.col("review_id"))
        conf = F.when(F.col("worst").isNotNull(), F.concat(F.lit(" (conf="), F.round("worst", 4).cast("string"), F.lit(")"))).otherwise("")
        text = F.concat(F.lit(f"Auto-merged into {self.id_name}="), F.col("survivor").cast("string"), conf)
        retired = self._retirements().groupBy(F.col("retired").alias("_rid")).agg(F.max_by(text, last).alias("_why"))
        joined = lifecycle.join(retired, F.col(self.id_name) == F.col("_rid"), "full")
        hit = F.col("_rid").isNotNull()
        new = {
            self.id_name: F.coalesce(F.col(self.id_name), F.col("_rid")),
            "lifecycle_state": F.when(hit, F.lit("DEPRECATED")).otherwise(F.col("lifecycle_state")),
            "state_reason": F.when(hit, F.col("_why")).otherwise(F.col("state_reason")),
            "updated_at": F.when(hit, clock(self.as_of)).otherwise(F.col("updated_at")),
            "updated_by": F.when(hit, F.lit("auto_merge")).otherwise(F.col("updated_by")),
            "approved_at": F.when(hit, clock(self.as_of)).otherwise(F.col("approved_at")),
            "approved_by": F.when(hit, F.lit(self.approver)).otherwise(F.col("approved_by")),
        }
        return joined.select(*[new.get(c, F.col(c)).alias(c) for c in lifecycle.columns])

    def merged_queue(self) -> DataFrame:
        """The queue with merged pairs closed; notes name the survivor of the group and the ids of the pair it replaces."""
        queue = self.queue.withColumn("_hit", F.coalesce(self.eligible, F.lit(False)))
        root = self.survivor
        if self.closure:
            known = self.groups().select(F.col("node").alias("_node"), F.col("root").alias("_root"))
            queue = queue.join(known, F.col("_hit") & (self.survivor == F.col("_node")), "left")
            root = F.col("_root")
        gone = F.when(root == self.survivor, self.retired.cast("string")).otherwise(
            F.concat_ws(", ", self.survivor.cast("string"), F.when(root != self.retired, self.retired.cast("string")))
        )
        notes = F.concat(F.lit("Survivor="), root.cast("string"), F.lit(", Deprecated="), gone)
        return queue.withColumns(
            {
                "status": F.when(F.col("_hit"), F.lit("MERGED")).otherwise(F.col("status")),
                "reviewed_at": F.when(F.col("_hit"), clock(self.as_of)).otherwise(F.col("reviewed_at")),
                "reviewed_by": F.when(F.col("_hit"), F.lit(self.approver)).otherwise(F.col("reviewed_by")),
                "decision_notes": F.when(F.col("_hit"), notes).otherwise(F.col("decision_notes")),
            }
        ).select(*self.queue.columns)

    def chained(self) -> DataFrame:
        """Ids that survive one pair and are retired by another."""
        return (
            self.pairs.select(F.col("survivor").alias(self.id_name))
            .distinct()
            .join(self.pairs.select(F.col("retired").alias(self.id_name)).distinct(), self.id_name, "left_semi")
        )
