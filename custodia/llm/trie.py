"""Prefix trie of conversations with subtree totals, by depth bands.

A node is a distinct sequence of first turns. Its key is the XOR of two 64-bit
hashes per turn and place, so the keys of all prefixes of a conversation are
running sums, cut into blocks of turns: no task needs a whole conversation.

Subtree totals are rolled up in bands of ``height`` depths, the deepest first.
Inside a band a node adds its values to its ancestors of the same band only (at
most ``height`` rows a node); the completed totals of a band's top nodes are then
added to their parents, which end the band above. With D the greatest depth the
bands have max(``HEIGHT``, root of D + 1) depths, so rounds and rows a node are both
bounded by the root of D.

Nulls: a null conversation id is no conversation; a null turn comes first, a null
role or text is empty. Turns of equal number are ordered by role and text;
repeated rows are turns of their own. Without any conversation there is no node,
not even the root. Further columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from custodia.llm.common import pick
from custodia.llm.components import stored
from custodia.session import work_dir

HEIGHT = 32
#: Turns of one running sum, rounded to whole bands.
BLOCK = 1024
#: Bytes of one piece of a list of ids.
PIECE = 8192
#: Turns a conversation can take from another one.
MOST_SHARED = 5


def numbered(turns: DataFrame, folder: str) -> DataFrame:
    """``conv``, ``place`` (from 1), the hashes ``t1`` and ``t2`` of role and text, and the text's code points as ``size``.

    Turns are dealt out by ranges of their order and counted inside each range; a
    conversation that reaches over several ranges gets its earlier ranges' counts
    added. There are at most as many such conversations as ranges.
    """
    order = ["conv", F.col("turn").asc_nulls_first(), "role", "text"]
    content = F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    ranged = turns.repartitionByRange(*order).sortWithinPartitions(*order)
    narrow = ranged.withColumn("c", content).select(
        "conv", F.xxhash64("c").alias("t1"), F.xxhash64(F.lit(1), "c").alias("t2"), F.length("text").cast("long").alias("size")
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, seen = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            conv = batch.column(0).to_numpy()
            if not len(conv):
                continue
            begin = np.flatnonzero(np.append(True, conv[1:] != conv[:-1]))
            run = np.diff(np.append(begin, len(conv)))
            place = np.arange(1, len(conv) + 1) - np.repeat(begin, run)
            if conv[0] == last:
                place[: run[0]] += seen
            last, seen = conv[-1], place[-1]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(conv), part)), pa.array(place)], [*batch.schema.names, "part", "place"])

    local = stored(narrow.mapInArrow(count, "conv long, t1 long, t2 long, size long, part long, place long"), f"{folder}/numbered")
    cut = local.groupBy("conv").agg(F.min("part").alias("a"), F.max("part").alias("b")).where("a < b").select("conv")
    pieces = local.join(F.broadcast(cut), "conv").groupBy("conv", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    earlier = pieces.select("conv", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    # one row for each range that a cut conversation touches
    whole = local.join(F.broadcast(earlier), ["conv", "part"], "left")
    return whole.select("conv", (F.col("place") + F.coalesce("earlier", F.lit(0))).alias("place"), "t1", "t2", "size")


def rebuilt(places: DataFrame, base: Callable[[Column], Column], shared: Callable[[Column], Column], folder: str) -> DataFrame:
    """Steps (``conv``, ``depth``, ``t1``, ``t2``, ``size``, ``last``) of each conversation c with a changed beginning.

    Its first ``shared(c)`` turns (at most ``MOST_SHARED``) are replaced by as many
    first turns of the conversation ``base(c)``, or as that one has. Step 0 is empty.
    """
    conv = F.col("conv")
    turn = F.struct("place", "t1", "t2", "size")
    heads = places.where(F.col("place") <= MOST_SHARED).groupBy(conv.alias("base")).agg(F.sort_array(F.collect_list(turn)).alias("head"))
    convs = places.groupBy("conv").agg(F.count("*").alias("n")).withColumns({"base": base(conv), "shared": shared(conv).cast("int")})
    convs = convs.join(heads, "base", "left").withColumn("head", F.slice(F.coalesce("head", F.array().cast(heads.schema["head"].dataType)), F.lit(1), F.col("shared")))
    convs = convs.withColumn("total", F.size("head") + F.greatest(F.col("n") - F.col("shared"), F.lit(0)))
    convs = stored(convs.select("conv", "shared", "head", "total"), f"{folder}/convs")
    zero = F.lit(0).cast("long")
    first = convs.select("conv", zero.alias("depth"), zero.alias("t1"), zero.alias("t2"), zero.alias("size"), "total")
    taken = convs.select("conv", "total", F.explode("head").alias("h")).select("conv", F.col("h.place").alias("depth"), "h.t1", "h.t2", "h.size", "total")
    own = places.where(F.col("place") > shared(conv)).join(convs.select("conv", "shared", F.size("head").alias("taken"), "total"), "conv")
    own = own.select("conv", (F.col("taken") + F.col("place") - F.col("shared")).alias("depth"), "t1", "t2", "size", "total")
    steps = first.unionByName(taken).unionByName(own)
    return steps.withColumn("last", F.col("depth") == F.col("total")).drop("total")


def _keyed(steps: DataFrame, height: int) -> DataFrame:
    """Steps with the node ``x``, its ``parent``, its ``band`` and the ``path`` of nodes from the band's top to itself."""
    block = height * math.ceil(BLOCK / height)
    some = F.col("depth") > 0
    steps = steps.withColumns({
        "g1": F.when(some, F.xxhash64("t1", "depth")).otherwise(0), "g2": F.when(some, F.xxhash64("depth", "t2")).otherwise(0),
        "block": F.floor(F.col("depth") / block), "band": F.floor(F.col("depth") / height),
    })
    sums = steps.groupBy("conv", "block").agg(F.bit_xor("g1").alias("s1"), F.bit_xor("g2").alias("s2"))
    before = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0).cast("long")
    carry = sums.select("conv", "block", *[F.coalesce(F.bit_xor(f"s{k}").over(before), none).alias(f"s{k}") for k in (1, 2)])
    inside = Window.partitionBy("conv", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    run = steps.select("*", *[F.bit_xor(f"g{k}").over(inside).alias(f"r{k}") for k in (1, 2)]).join(carry, ["conv", "block"])
    x = [F.col(f"r{k}").bitwiseXOR(F.col(f"s{k}")) for k in (1, 2)]
    run = run.withColumns({
        "x": F.struct(x[0].alias("a"), x[1].alias("b")),
        "parent": F.when(some, F.struct(x[0].bitwiseXOR(F.col("g1")).alias("a"), x[1].bitwiseXOR(F.col("g2")).alias("b"))),
    })
    above = Window.partitionBy("conv", "block", "band").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    return run.select("conv", "depth", "band", "x", "parent", "size", "last", F.collect_list("x").over(above).alias("path"))


def _pieces(ends: DataFrame) -> DataFrame:
    """SHA-256 of the ascending, comma-joined ids of each node: text pieces per range of ids, then one pass over a node's pieces.

    Both passes hold one piece at a time, so a node may have any number of ids.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, conv = (batch.column(k).to_pylist() for k in range(3))
            out = []
            for (p, q), rows in groupby(zip(a, b, conv, strict=True), key=lambda r: r[:2]):
                ids, size = [], 0
                for _, _, c in rows:
                    if size > PIECE:
                        out.append((p, q, ids[0], ",".join(map(str, ids))))
                        ids, size = [], 0
                    ids.append(c)
                    size += len(str(c)) + 1
                out.append((p, q, ids[0], ",".join(map(str, ids))))
            if out:
                yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in list(zip(*out, strict=True))[:3]], pa.array([r[3] for r in out])], ["a", "b", "first", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, running = None, None
        for batch in batches:
            done = []
            for a, b, ids in zip(*(batch.column(k).to_pylist() for k in (0, 1, 3)), strict=True):
                if (a, b) != now:
                    if now:
                        done.append((*now, running.hexdigest()))
                    now, running = (a, b), hashlib.sha256(ids.encode())
                else:
                    running.update(f",{ids}".encode())
            yield _digests(done)
        if now:
            yield _digests([(*now, running.hexdigest())])

    ranged = ends.select("x.a", "x.b", "conv").repartitionByRange("a", "b", "conv").sortWithinPartitions("a", "b", "conv")
    pieces = ranged.mapInArrow(cut, "a long, b long, first long, ids string")
    gathered = pieces.repartition("a", "b").sortWithinPartitions("a", "b", "first")
    return gathered.mapInArrow(digest, "a long, b long, ends_sha256 string").select(F.struct("a", "b").alias("x"), "ends_sha256")


def _digests(rows: list[tuple[int, int, str]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[], [], []]
    return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string())], ["a", "b", "ends_sha256"])


def trie(steps: DataFrame, folder: str, height: int = HEIGHT) -> DataFrame:
    """One row per node of the trie of ``steps`` (as ``rebuilt`` gives them, from step 0 on).

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens`` (over the subtree, what copies of
    each node's last text repeat) and ``ends_sha256`` (the conversations that end here).
    """
    spark = steps.sparkSession
    steps = stored(steps, f"{folder}/steps")
    deepest = steps.agg(F.max("depth")).first()[0] or 0
    height = max(height, math.ceil(math.sqrt(deepest + 1)))
    keyed = stored(_keyed(steps, height), f"{folder}/keyed")
    nodes = keyed.groupBy("x").agg(
        F.min("conv").alias("conv_id"), F.count("*").alias("n_convs"), F.max("depth").alias("depth"), F.max("band").alias("band"),
        F.max("size").alias("size"), F.first("parent").alias("parent"), F.first("path").alias("path"),
    )
    nodes = stored(nodes, f"{folder}/nodes")
    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("x")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, "x", "left").withColumns({
        "n_children": F.coalesce("n_children", F.lit(0)), "saved": (F.col("n_convs") - 1) * F.col("size"),
        "leaf": F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long"),
    })
    nodes.write.partitionBy("band").parquet(f"{folder}/bands")
    nodes, below = spark.read.schema(nodes.schema).parquet(f"{folder}/bands"), None  # an empty table has no files
    for band in range(deepest // height, -1, -1):
        values = nodes.where(F.col("band") == band).select("x", "parent", "depth", "path", "leaf", "saved")
        if below is not None:
            values = values.join(below, "x", "left").select(
                "x", "parent", "depth", "path", *[(F.col(c) + F.coalesce(f"{c}_below", F.lit(0))).alias(c) for c in ("leaf", "saved")]
            )
        sums = values.select(F.explode("path").alias("x"), "leaf", "saved").groupBy("x").agg(F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
        totals = stored(sums, f"{folder}/totals/band={band}")
        tops = nodes.where((F.col("band") == band) & (F.col("depth") == band * height)).select("x", "parent").join(totals, "x")
        below = tops.groupBy(F.col("parent").alias("x")).agg(F.sum("n_leaves").alias("leaf_below"), F.sum("saved_tokens").alias("saved_below"))
    totals = spark.read.parquet(f"{folder}/totals").drop("band")
    above = nodes.select(F.col("x").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    ends = _pieces(keyed.where("last").select("x", "conv"))
    out = nodes.join(totals, "x").join(ends, "x", "left").join(above, "parent", "left")
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


def conversations(
    df: DataFrame, base: Callable[[Column], Column], shared: Callable[[Column], Column], conv: str = "conv_id", turn: str = "turn",
    role: str = "role", text: str = "text", height: int = HEIGHT,
) -> DataFrame:
    """The trie of the conversations of ``df``, each rebuilt from the beginning of another one."""
    folder = work_dir(df.sparkSession, "trie")
    turns = pick(df, conv=(conv, "long"), turn=(turn, "long"), role=(role, "string"), text=(text, "string")).where("conv IS NOT NULL")
    turns = turns.withColumns({c: F.coalesce(c, F.lit("")) for c in ("role", "text")})
    return trie(rebuilt(numbered(turns, folder), base, shared, folder), folder, height)
