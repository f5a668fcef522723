"""Mixing sources to target weights: exact block quotas drawn down a splitting tree of output shards.

Every document is hashed to a place in its source; a block is the documents of
one stretch of places, so blocks are random and of bounded size at any number
of rows. A source is taken whole as often as its target allows, then by whole
blocks and, in one last block, by whole documents up to the target. Each pass
over a block is one draw.

All draws together are the root of a binary tree. Each node knows how many
draws of every source it holds and passes an exact half of them to its left
child, split over the sources by the multivariate hypergeometric law: source
after source, by inverting the hypergeometric distribution at a hashed uniform
number. The leaves are the output shards. Within a pass the blocks of a source
are permuted; the shards take disjoint stretches of them, as long as their
quotas, and order their rows by a hash.

All of it is DataFrame functions. What a tree node holds is one array over the
sources, so the number of sources, not of documents, has to fit a row.

Sources order by code point with null last; the weights repeat along that order.
Null and empty texts have size 0 and follow their place like any other row.
Repeated rows and ids are separate documents. No source with words: all targets
are 0 and nothing is taken. Draws depend on ``seed`` and ids alone.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from custodia.llm.common import pick
from custodia.session import work_dir

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
BLOCK_DOCUMENTS = 512
SHARD_WORDS = 2_000_000
TAIL = 10


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the hash of columns."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / F.lit(float(1 << 53))


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 0) -> DataFrame:
    """Each document with its size in words and its place among the documents of its source."""
    docs = pick(docs, doc_id=(id_col, "long"), text=(text_col, "string"), source=(source_col, "string"))
    return docs.select(
        "doc_id",
        "source",
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        uniform(F.lit(seed), F.col("doc_id"), F.xxhash64("text")).alias("place"),
    )


def targets(sized: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """One row per source with its words, documents and target.

    Targets are ``least(most * words, level * weight)`` with one level for all:
    the sources reach their bound in the order of bound by weight, and behind
    each prefix of bounded sources the level is what is left by the weights left.
    """
    one = sized.groupBy("source").agg(F.sum("size").alias("words"), F.count("*").alias("documents"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    one = one.withColumn("number", F.row_number().over(order) - 1)
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    one = one.withColumn("weight", F.element_at(cycle, (F.col("number") % len(weights)).cast("int") + 1))
    one = one.withColumn("bound", most * F.col("words"))
    everything = Window.partitionBy()
    by_bound = Window.orderBy(F.col("bound") / F.col("weight"), "number").rowsBetween(Window.unboundedPreceding, -1)
    level = (share * F.sum("words").over(everything) - F.coalesce(F.sum("bound").over(by_bound), F.lit(0.0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(by_bound), F.lit(0.0))
    )
    one = one.withColumn("level", level).withColumn("open", F.col("level") * F.col("weight") <= F.col("bound"))
    one = one.withColumn("level", F.min(F.when(F.col("open"), F.struct(F.col("bound") / F.col("weight"), F.col("level")))).over(everything)["level"])
    target = F.coalesce(F.least("bound", F.col("level") * F.col("weight")), F.col("bound"))
    return one.select("source", "number", "words", "documents", target.alias("target"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def hypergeometric(total: Column, good: Column, draws: Column, u: Column) -> Column:
    """How many of ``draws`` out of ``total`` are among the ``good`` ones, at the uniform number ``u``.

    Probabilities relative to the mode follow from the ratio of neighbours; they
    are summed over all values within ``TAIL`` standard deviations and more of the
    mode, beyond which doubles hold no probability. The time is in the order of
    the square root of the draws.
    """
    given = F.struct(
        total.cast("double").alias("total"), good.cast("double").alias("good"), draws.cast("double").alias("draws"), u.alias("u"),
        F.greatest(F.lit(0.0), (draws + good - total).cast("double")).alias("low"), F.least(good, draws).cast("double").alias("high"),
    )

    def ratio(v: Column, k: Column) -> Column:  # p(k + 1) / p(k)
        k = k.cast("double")
        return (v["good"] - k) * (v["draws"] - k) / ((k + 1) * (v["total"] - v["good"] - v["draws"] + k + 1))

    def bounds(v: Column) -> Column:
        part = v["good"] / F.greatest(v["total"], F.lit(1.0))
        spread = F.sqrt(v["draws"] * part * (1 - part) * (v["total"] - v["draws"]) / F.greatest(v["total"] - 1, F.lit(1.0)))
        mode = F.least(v["high"], F.greatest(v["low"], F.floor((v["draws"] + 1) * (v["good"] + 1) / (v["total"] + 2)).cast("double")))
        return let(F.struct(mode.alias("mode"), F.ceil(TAIL * spread + TAIL).cast("double").alias("reach")), lambda m: chosen(v, m))

    def chosen(v: Column, m: Column) -> Column:
        ends = F.struct(
            F.greatest(v["low"], m["mode"] - m["reach"]).cast("long").alias("first"),
            F.least(v["high"], m["mode"] + m["reach"]).cast("long").alias("last"),
            m["mode"].cast("long").alias("mode"),
        )
        return let(ends, lambda e: let(weigh(v, e), lambda w: e["first"] + passed(v, e, w)))

    def weigh(v: Column, e: Column) -> Column:
        none = F.array().cast("array<long>")
        start = F.struct(F.lit(1.0).alias("p"), F.lit(0.0).alias("sum"))

        def step(factor: Callable[[Column], Column]) -> Callable[[Column, Column], Column]:
            return lambda s, k: let(s["p"] * factor(k), lambda p: F.struct(p.alias("p"), (s["sum"] + p).alias("sum")))

        down = F.when(e["first"] < e["mode"], F.sequence(e["mode"] - 1, e["first"], F.lit(-1).cast("long"))).otherwise(none)
        up = F.when(e["mode"] < e["last"], F.sequence(e["mode"], e["last"] - 1)).otherwise(none)
        below = F.aggregate(down, start, step(lambda k: 1 / ratio(v, k)))
        above = F.aggregate(up, start, step(lambda k: ratio(v, k)))["sum"]
        return let(below, lambda x: F.struct(x["p"].alias("p"), (x["sum"] + 1 + above).alias("sum")))

    def passed(v: Column, e: Column, w: Column) -> Column:
        start = F.struct(w["p"].alias("p"), F.lit(0.0).alias("sum"), F.lit(0).cast("long").alias("n"))

        def step(s: Column, k: Column) -> Column:
            return let(
                s["sum"] + s["p"],
                lambda t: F.struct(
                    (s["p"] * ratio(v, k)).alias("p"), t.alias("sum"), (s["n"] + F.when(t <= v["u"] * w["sum"], 1).otherwise(0)).alias("n")
                ),
            )

        # the last value needs no ratio to a next one
        before = F.when(e["first"] < e["last"], F.sequence(e["first"], e["last"] - 1)).otherwise(F.array().cast("array<long>"))
        return F.aggregate(before, start, step)["n"]

    return let(given, bounds)


def split(nodes: DataFrame, level: int, seed: int) -> DataFrame:
    """Both children of every node (``shard``, ``counts`` per source): an exact half of the draws each."""
    total = F.aggregate("counts", F.lit(0).cast("long"), lambda s, n: s + n)
    nodes = nodes.withColumn("total", total).withColumn("half", F.floor(F.col("total") / 2).cast("long"))
    start = F.struct(F.col("total").alias("total"), F.col("half").alias("draws"), F.array().cast("array<long>").alias("left"))

    def take(state: Column, item: Column) -> Column:
        u = uniform(F.lit(seed), F.lit(level), F.col("shard"), item["at"])
        return let(
            hypergeometric(state["total"], item["n"], state["draws"], u),
            lambda got: F.struct(
                (state["total"] - item["n"]).alias("total"),
                (state["draws"] - got).alias("draws"),
                F.concat(state["left"], F.array(got)).alias("left"),
            ),
        )

    items = F.transform("counts", lambda n, k: F.struct(n.alias("n"), k.alias("at")))
    nodes = nodes.withColumn("left", F.aggregate(items, start, take)["left"])
    right = F.zip_with("counts", "left", lambda n, x: n - x)
    children = F.array(
        F.struct((F.col("shard") * 2).alias("shard"), F.col("left").alias("counts")),
        F.struct((F.col("shard") * 2 + 1).alias("shard"), right.alias("counts")),
    )
    return nodes.select("numbers", F.inline(children))


def draw(
    sized: DataFrame, sources: DataFrame, folder: str, seed: int = 0, block_documents: int = BLOCK_DOCUMENTS, shard_words: int = SHARD_WORDS
) -> DataFrame:
    """Every document with ``source_size``, ``target`` and ``draws``: an array of (shard, position in it), one for each time taken."""
    spark = sized.sparkSession
    blocks_of = F.ceil(F.col("documents") / block_documents)
    own = sources.select(
        F.col("source").alias("of"), "number", "words", "target", blocks_of.alias("blocks"),
        F.when(F.col("words") > 0, F.floor(F.col("target") / F.col("words"))).otherwise(0).cast("long").alias("passes"),
    )
    own = own.withColumn("rest", F.col("target") - F.col("passes") * F.col("words"))
    placed = sized.join(own, F.col("source").eqNullSafe(F.col("of")), "left").withColumn("block", F.floor(F.col("place") * F.col("blocks")))

    # words of each block, and of the blocks before it in the order of the last pass
    block = placed.groupBy("number", "block").agg(
        F.sum("size").alias("block_words"), *[F.first(c).alias(c) for c in ("passes", "rest")]
    )
    block.write.parquet(f"{folder}/blocks")
    block = spark.read.parquet(f"{folder}/blocks")

    def order(run: Column) -> Column:
        return F.xxhash64(F.lit(seed), F.col("number"), F.col("block"), run)

    last = Window.partitionBy("number").orderBy(order(F.col("passes")), "block")
    before = F.coalesce(F.sum("block_words").over(last.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    block = block.withColumn("before", before).withColumn("rest", F.col("rest") - F.col("before"))
    # a draw: one pass over a block; the last pass reaches the blocks where something is left to take
    runs = F.sequence(F.lit(0).cast("long"), F.col("passes"))
    runs = F.filter(runs, lambda r: (r < F.col("passes")) | (F.col("rest") > 0))
    draws = block.select("number", "block", F.explode(runs).alias("run"))
    permuted = Window.partitionBy("number").orderBy("run", order(F.col("run")), "block")
    draws = draws.withColumn("draw", F.row_number().over(permuted) - 1)
    draws.write.parquet(f"{folder}/draws")
    draws = spark.read.parquet(f"{folder}/draws")

    # the tree, from one row to one row per shard
    counted = draws.groupBy("number").agg(F.count("*").alias("n"))
    root = counted.agg(F.sort_array(F.collect_list(F.struct("number", "n"))).alias("held"))
    nodes = root.select(
        F.col("held")["number"].alias("numbers"), F.lit(0).cast("long").alias("shard"), F.col("held")["n"].cast("array<long>").alias("counts")
    )
    words = sources.agg(F.coalesce(F.sum("target"), F.lit(0.0))).first()[0]
    for level in range(max(0, math.ceil(math.log2(max(1.0, words / shard_words))))):
        nodes = split(nodes, level, seed)
        if level % 4 == 3:  # keep the plan short
            nodes.write.parquet(f"{folder}/nodes-{level}")
            nodes = spark.read.parquet(f"{folder}/nodes-{level}")
    quota = nodes.select("shard", F.inline(F.arrays_zip(F.col("numbers").alias("number"), F.col("counts").alias("quota"))))
    stretch = Window.partitionBy("number").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    quota = quota.withColumn("first", F.coalesce(F.sum("quota").over(stretch), F.lit(0))).where("quota > 0")
    shards = quota.select("number", "shard", F.explode(F.expr("sequence(first, first + quota - 1)")).alias("draw"))

    # back to blocks, then to documents
    drawn = draws.join(shards, ["number", "draw"]).groupBy("number", "block").agg(F.collect_list(F.struct("run", "shard")).alias("runs"))
    block = block.select("number", "block", F.col("rest").alias("left_over"))
    drawn = block.join(drawn, ["number", "block"])
    inner = Window.partitionBy("number", "block").orderBy("place", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("inside", F.coalesce(F.sum("size").over(inner), F.lit(0)))
    joined = placed.join(drawn, ["number", "block"], "left")
    reached = F.col("inside") + F.col("size") / 2 <= F.col("left_over")
    runs = F.filter("runs", lambda r: (r["run"] < F.col("passes")) | ((F.col("left_over") > 0) & reached))
    spots = F.transform(
        runs, lambda r: F.struct(r["shard"].alias("shard"), F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("place"), r["run"]).alias("position"))
    )
    return joined.select(
        "doc_id", "source", "size", F.col("words").alias("source_size"), "target", F.coalesce(spots, F.array().cast(_SPOTS)).alias("draws"), "place"
    )


_SPOTS = "array<struct<shard:bigint,position:bigint>>"


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: Sequence[float] = WEIGHTS,
    share: float = 1.5, most: float = 2.0, seed: int = 0, block_documents: int = BLOCK_DOCUMENTS, shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, place and its ``draws``; order a shard by position."""
    spark = docs.sparkSession
    folder = work_dir(spark, "mixing")
    sizes(docs, id_col, text_col, source_col, seed).write.parquet(f"{folder}/sizes")
    sized = spark.read.parquet(f"{folder}/sizes")
    targets(sized, weights, share, most).write.parquet(f"{folder}/sources")
    return draw(sized, spark.read.parquet(f"{folder}/sources"), folder, seed, block_documents, shard_words)


def taken(mixed: DataFrame) -> DataFrame:
    """The words that the mix takes of every document."""
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.size("draws")).alias("taken"), "source")


def mixed_rows(docs: DataFrame, mixed: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 0) -> DataFrame:
    """All columns of the documents that the mix takes, as often as it does, dealt to its shards and shuffled inside them."""
    flat = docs.toDF(*[f"_{k}" for k in range(len(docs.columns))])
    doc, text = (F.col(f"_{docs.columns.index(c)}") for c in (id_col, text_col))
    flat = flat.withColumn("spot", uniform(F.lit(seed), doc.cast("long"), F.xxhash64(text.cast("string"))))
    drawn = mixed.where(F.size("draws") > 0).dropDuplicates(["doc_id", "place"]).select("doc_id", "place", "draws")
    rows = flat.join(drawn, doc.cast("long").eqNullSafe(F.col("doc_id")) & (F.col("spot") == F.col("place")))
    rows = rows.select(*flat.columns[:-1], F.inline("draws")).repartition("shard").sortWithinPartitions("shard", "position")
    return rows.drop("shard", "position").toDF(*docs.columns)
