"""Links between similar vectors of one label: NN-descent, components, exact counts inside them.

Equal vectors are one node with a weight. Random hyperplanes deal the nodes of a
label to cells of about ``CELL`` (large cells are split at random), and a task
compares all of a cell: the first neighbour lists. Then rounds of NN-descent: the
neighbours and reverse neighbours of every node meet in groups of at most about
``CELL`` and are compared with each other, and every node keeps its ``LIST_LENGTH``
best, however far, until few lists change.

Edges at the threshold make components. A list that is full of links is saturated:
further links of its node may be missing. Saturated nodes of a component are cut into
pieces of near nodes, and two pieces of different components of a label are compared
with each other unless the angles of their centres and the reach around them rule a
link out: this is exact, and components with a link between them are merged. Then
all pairs of a component are compared, block by block, so counts are exact there. An
audit compares ``AUDIT`` random nodes with all nodes of their label, and more of them
(up to ``AUDIT_MOST``) until ``AUDIT_LINKED`` with few links are among them. Each node
counts alike, those with few links and with many apart; while either kind finds less
than ``LEAST_RECALL`` of its links, more hyperplanes and rounds follow, and after
``TURNS`` of them the run fails with the recall reached.

Cosines are of double precision. A vector that is null, empty, zero or has null or
non-finite components, and one without label, links with nothing. Repeated ids and
rows are vectors of their own; a null id has no say in the smallest id. Vectors of
different length never link.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from custodia.llm.common import pick
from custodia.llm.components import components, stored
from custodia.session import work_dir

THRESHOLD = 0.93
LIST_LENGTH = 12
CELL = 128
TABLES = 3
ROUNDS = 4
STILL = 0.005
BLOCK = 512
AUDIT, AUDIT_MOST, AUDIT_LINKED, LEAST_RECALL = 256, 8192, 64, 0.97
TURNS = 12
CODE_BITS = 24


def nodes_of(vectors: DataFrame) -> DataFrame:
    """vec_id, label and, for vectors that can link, the node they are, its space (label and length) and unit vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            labels, node, space, units = part.column(1).to_pylist(), [], [], []
            for label, row in zip(labels, part.column(2).to_pylist(), strict=True):
                v = np.array(row, np.float64) if row and label is not None and None not in row else np.zeros(0)
                top = np.abs(v).max() if len(v) else 0.0
                if not (np.isfinite(top) and top > 0):
                    node.append(None), space.append(None), units.append(None)
                    continue
                v = v / top
                unit = (v / np.sqrt((v * v).sum())).tobytes()
                own = f"{len(v)}:{label}"
                node.append(int.from_bytes(hashlib.blake2b(unit + own.encode(), digest_size=8).digest(), "little", signed=True))
                space.append(own), units.append(unit)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(node, pa.int64()), pa.array(space, pa.string()), pa.array(units, pa.binary())], ["vec_id", "node", "space", "unit"]
            )

    return vectors.mapInArrow(run, "vec_id long, node long, space string, unit binary")


def grouped(df: DataFrame, by: list[str], work: Callable[[pa.Table], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``work`` on the rows of each group; groups are of bounded size."""
    rows = df.repartition(*by).sortWithinPartitions(*by)
    places = [rows.columns.index(c) for c in by]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = list(zip(*(batch.column(k).to_pylist() for k in places), strict=True))
            start = 0
            for k in range(1, len(keys) + 1):
                if k < len(keys) and keys[k] == keys[start]:
                    continue
                if keys[start] != key and held:
                    yield from work(pa.Table.from_batches(held).combine_chunks())
                    held = []
                held.append(batch.slice(start, k - start))
                key, start = keys[start], k
        if held:
            yield from work(pa.Table.from_batches(held).combine_chunks())

    return rows.mapInArrow(run, schema)


def matrix(table: pa.Table, column: str = "unit") -> np.ndarray:
    data = table.column(column).to_pylist()
    return np.frombuffer(b"".join(data), np.float64).reshape(len(data), -1)


def best(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """The nearest other nodes of every node of a group, both ways."""
    node = table.column("node").to_numpy()
    node, first = np.unique(node, return_index=True)
    if len(node) < 2:
        return
    x = matrix(table.take(first))
    cosine = x @ x.T
    np.fill_diagonal(cosine, -2.0)
    k = min(LIST_LENGTH, len(node) - 1)
    near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
    a = np.repeat(np.arange(len(node)), k)
    value = cosine[a, near.ravel()]
    yield pa.RecordBatch.from_arrays([pa.array(node[a]), pa.array(node[near.ravel()]), pa.array(value)], ["a", "b", "cosine"])


EDGES = "a long, b long, cosine double"


def lists(edges: DataFrame) -> DataFrame:
    """The best neighbours of each node."""
    edges = edges.groupBy("a", "b").agg(F.max("cosine").alias("cosine"))
    order = Window.partitionBy("a").orderBy(F.desc("cosine"), "b")
    return edges.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= LIST_LENGTH).drop("rank")


def cut(nodes: DataFrame, by: list[str], size: int, tables: int, turn: int) -> DataFrame:
    """``by``, turn, cell, part, node, unit: the nodes of each group in cells of random hyperplanes, of at most about 2 * ``size``."""
    sizes = nodes.groupBy(*by).agg(F.count("*").alias("n"))
    bits = F.least(F.lit(CODE_BITS), F.greatest(F.lit(0), F.ceil(F.log2(F.col("n") / size)))).cast("int")
    given = nodes.select("node", "unit", *by)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for part in batches:
            units = part.column(1).to_pylist()
            sizes = np.array([len(u) for u in units])
            for size in np.unique(sizes):
                some = np.flatnonzero(sizes == size)
                d = int(size) // 8
                if d not in planes:
                    planes[d] = np.random.default_rng([turn, d]).standard_normal((d, tables * CODE_BITS))
                x = np.frombuffer(b"".join(units[k] for k in some), np.float64).reshape(len(some), d)
                sign = (x @ planes[d] > 0).reshape(len(some), tables, CODE_BITS)
                value = (sign << np.arange(CODE_BITS - 1, -1, -1)).sum(axis=2)
                take = pa.array(some)
                for t in range(tables):
                    yield pa.RecordBatch.from_arrays(
                        [*(part.column(k).take(take) for k in range(2 + len(by))), pa.array(np.full(len(some), t)), pa.array(value[:, t])],
                        ["node", "unit", *by, "turn", "code"],
                    )

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in given.schema.fields)
    coded = given.mapInArrow(code, f"{kinds}, turn long, code long").join(sizes.select(*by, bits.alias("bits")), by)
    coded = coded.withColumn("cell", F.floor(F.col("code") / F.pow(F.lit(2.0), CODE_BITS - F.col("bits"))).cast("long"))
    full = coded.groupBy(*by, "turn", "cell").agg(F.ceil(F.count("*") / (2 * size)).alias("parts"))
    coded = coded.join(full, [*by, "turn", "cell"]).withColumn("part", F.pmod(F.xxhash64("node", "turn"), F.col("parts")))
    return coded.select(*by, "turn", "cell", "part", "node", "unit")


def cells(nodes: DataFrame, folder: str, turn: int) -> DataFrame:
    """Nearest neighbours inside cells of random hyperplanes, from several tables of hyperplanes."""
    return grouped(cut(nodes, ["space"], CELL, TABLES, turn), ["space", "turn", "cell", "part"], best, EDGES)


def descend(graph: DataFrame, nodes: DataFrame, folder: str, tag: str) -> DataFrame:
    """Rounds of local joins: neighbours and reverse neighbours of a node are compared with each other."""
    units = nodes.select(F.col("node").alias("of"), "unit")
    before = None
    for turn in range(ROUNDS):
        around = graph.select(F.col("a").alias("pivot"), F.col("b").alias("node")).unionAll(graph.select("b", "a")).unionAll(
            graph.select("a", F.col("a").alias("node")).distinct()
        )
        around = around.distinct()
        sizes = around.groupBy(F.col("pivot").alias("p")).agg(F.ceil(F.count("*") / CELL).alias("parts"))
        around = around.join(sizes, F.col("pivot") == F.col("p")).withColumn("part", F.pmod(F.xxhash64("node", F.lit(turn)), F.col("parts")))
        met = around.join(units, F.col("node") == F.col("of")).select("pivot", "part", "node", "unit")
        found = grouped(met, ["pivot", "part"], best, EDGES)
        after = stored(lists(graph.unionAll(found)), f"{folder}/graph-{tag}-{turn}")
        now = after.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if now == before:
            return after
        changed = after.join(graph, ["a", "b"], "left_anti").count()
        graph, before = after, now
        if changed <= STILL * max(now[0], 1):
            break
    return graph


def audit(nodes: DataFrame, roots: DataFrame) -> float:
    """The share of its links whose ends are in one component, as a mean over sampled nodes: the lower of nodes with few links and with many."""
    every = nodes.join(roots, "node", "left").select("node", "space", "unit", F.coalesce("root", "node").alias("root"))
    size, total = AUDIT, nodes.count()
    while True:
        found = _sampled_links(every, size)
        few = found[found["links"] <= LIST_LENGTH]
        if len(few) >= AUDIT_LINKED or size >= min(total, AUDIT_MOST):
            break
        size = min(size * 8, AUDIT_MOST)
    many = found[found["links"] > LIST_LENGTH]
    return min([float((kind["good"] / kind["links"]).mean()) for kind in (few, many) if len(kind)], default=1.0)


def _sampled_links(every: DataFrame, size: int) -> pd.DataFrame:
    """node, links, and good ones inside its component, of the nodes with links among ``size`` random ones."""
    sample = every.orderBy(F.xxhash64("node")).limit(size).toPandas()
    held = {s: (p["node"].to_numpy(), p["root"].to_numpy(), np.stack([np.frombuffer(bytes(u)) for u in p["unit"]])) for s, p in sample.groupby("space")}
    shared = every.sparkSession.sparkContext.broadcast(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {s: np.zeros((2, len(own)), np.int64) for s, (own, _, _) in shared.value.items()}
        for part in batches:
            spaces = np.array(part.column(1).to_pylist(), object)
            node, root = part.column(0).to_numpy(), part.column(3).to_numpy()
            for space, (own, own_root, x) in shared.value.items():
                some = np.flatnonzero(spaces == space)
                if len(some):
                    y = matrix(pa.Table.from_batches([part]).take(some))
                    for k in range(0, len(own), BLOCK):
                        at = slice(k, k + BLOCK)
                        near = (x[at] @ y.T >= THRESHOLD) & (own[at, None] != node[some][None])
                        sums[space][0, at] += near.sum(axis=1)
                        sums[space][1, at] += (near & (own_root[at, None] == root[some][None])).sum(axis=1)
        for space, (links, good) in sums.items():
            met = links > 0
            yield pa.RecordBatch.from_arrays([pa.array(shared.value[space][0][met]), pa.array(links[met]), pa.array(good[met])], ["node", "links", "good"])

    found = every.mapInArrow(run, "node long, links long, good long")
    return found.groupBy("node").agg(F.sum("links").alias("links"), F.sum("good").alias("good")).toPandas()


def across(nodes: DataFrame, graph: DataFrame, roots: DataFrame, folder: str) -> DataFrame:
    """Edges that connect all components with a link between saturated nodes of theirs; lists that are full hold no such link."""
    full = graph.where(F.col("cosine") >= THRESHOLD).groupBy(F.col("a").alias("node")).agg(F.count("*").alias("n")).where(F.col("n") >= LIST_LENGTH)
    own = nodes.select("node", "space", "unit").join(full.select("node"), "node", "left_semi").join(roots, "node")
    own = cut(own, ["space", "root"], BLOCK // 2, 1, 0).withColumn("piece", F.xxhash64("space", "root", "cell", "part"))
    own = stored(own.select("space", "root", "piece", "node", "unit"), f"{folder}-pieces")

    def middle(table: pa.Table) -> Iterator[pa.RecordBatch]:
        x = matrix(table)
        centre = x.sum(axis=0)
        size = np.sqrt((centre * centre).sum())
        centre = centre / size if size > 1e-9 else x[0]
        reach = np.arccos(np.clip((x @ centre).min(), -1.0, 1.0))
        yield pa.RecordBatch.from_arrays(
            [*(table.column(c).combine_chunks().slice(0, 1) for c in ("space", "root", "piece")), pa.array([centre.tobytes()], pa.binary()), pa.array([reach])],
            ["space", "root", "piece", "centre", "reach"],
        )

    balls = stored(grouped(own, ["piece"], middle, "space string, root long, piece long, centre binary, reach double"), f"{folder}-balls")
    sizes = balls.groupBy("space").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    rows = balls.join(sizes, "space").withColumn("block", F.pmod(F.xxhash64("piece"), F.col("blocks")))
    others = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    rows = rows.select("space", "root", "piece", "centre", "reach", "block", F.explode(others).alias("other"))
    rows = rows.select("space", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "root", "piece", "centre", "reach", "block")

    def meet(table: pa.Table) -> Iterator[pa.RecordBatch]:
        x, y = table.column("x")[0].as_py(), table.column("y")[0].as_py()
        block, root, piece, reach = (table.column(c).to_numpy() for c in ("block", "root", "piece", "reach"))
        centre = matrix(table, "centre")
        left, right = np.flatnonzero(block == x), np.flatnonzero(block == y)
        angle = np.arccos(np.clip(centre[left] @ centre[right].T, -1.0, 1.0))
        may = (angle <= reach[left][:, None] + reach[right][None] + np.arccos(THRESHOLD) + 1e-6) & (root[left][:, None] != root[right][None])
        i, j = np.nonzero(np.triu(may) if x == y else may)
        yield pa.RecordBatch.from_arrays([pa.array(piece[left[i]]), pa.array(piece[right[j]])], ["p", "q"])

    pairs = stored(grouped(rows, ["space", "x", "y"], meet, "p long, q long"), f"{folder}-pairs")
    sides = pairs.select("p", "q", F.explode(F.array("p", "q")).alias("piece"))
    met = sides.join(own.select("piece", "node", "unit"), "piece")

    def compare(table: pa.Table) -> Iterator[pa.RecordBatch]:
        node, first = table.column("node").to_numpy(), table.column("piece").to_numpy() == table.column("p").to_numpy()
        unit = matrix(table)
        cosine = unit[first] @ unit[~first].T
        i, j = np.unravel_index(cosine.argmax(), cosine.shape)
        if cosine[i, j] >= THRESHOLD:
            yield pa.RecordBatch.from_arrays([pa.array(node[first][[i]]), pa.array(node[~first][[j]])], ["a", "b"])

    return stored(grouped(met, ["p", "q"], compare, "a long, b long"), f"{folder}-edges")


def count_links(nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """node and links (by weight) of all nodes in components, every pair of a component compared in blocks."""
    sizes = roots.groupBy(F.col("root").alias("r")).agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    rows = nodes.join(roots, "node").join(sizes, F.col("root") == F.col("r"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    others = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    rows = rows.select("root", "node", "unit", "weight", "block", F.explode(others).alias("other"))
    rows = rows.select("root", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "node", "unit", "weight", "block")

    def compare(table: pa.Table) -> Iterator[pa.RecordBatch]:
        x, y = table.column("x")[0].as_py(), table.column("y")[0].as_py()
        block, node, weight = (table.column(c).to_numpy() for c in ("block", "node", "weight"))
        unit = matrix(table)
        left, right = np.flatnonzero(block == x), np.flatnonzero(block == y)
        near = unit[left] @ unit[right].T >= THRESHOLD
        if x == y:
            np.fill_diagonal(near, False)
            sums = [(left, near @ weight[right])]
        else:
            sums = [(left, near @ weight[right]), (right, near.T @ weight[left])]
        for at, n in sums:
            yield pa.RecordBatch.from_arrays([pa.array(node[at]), pa.array(n.astype(np.int64))], ["node", "links"])

    return grouped(rows, ["root", "x", "y"], compare, "node long, links long").groupBy("node").agg(F.sum("links").alias("links"))


def link(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per vector: vec_id, n_links, component_id (smallest id reachable), kept."""
    vectors = pick(vectors, vec_id=(id_col, "long"), label=(label_col, "string"), vector=(vector_col, "array<double>"))
    folder = work_dir(vectors.sparkSession, "nn-descent")
    every = stored(nodes_of(vectors), f"{folder}/vectors")
    nodes = every.where("node IS NOT NULL").groupBy("node").agg(F.first("space").alias("space"), F.first("unit").alias("unit"), F.count("*").alias("weight"))
    nodes = stored(nodes, f"{folder}/nodes")
    graph = None
    for turn in range(TURNS):
        new = cells(nodes, folder, turn)
        graph = stored(lists(new if graph is None else graph.unionAll(new)), f"{folder}/cells-{turn}")
        graph = descend(graph, nodes, folder, str(turn))
        edges = graph.where(F.col("cosine") >= THRESHOLD).select("a", "b")
        roots = stored(components(edges, f"{folder}/components-{turn}"), f"{folder}/roots-{turn}")
        more = across(nodes, graph, roots, f"{folder}/across-{turn}")
        if not more.isEmpty():
            roots = stored(components(edges.unionAll(more), f"{folder}/merged-{turn}"), f"{folder}/merged-roots-{turn}")
        recall = audit(nodes, roots)
        if recall >= LEAST_RECALL:
            break
    else:
        raise RuntimeError(f"links found after {TURNS} turns: recall {recall:.4f}, less than {LEAST_RECALL}")
    links = stored(count_links(nodes, roots), f"{folder}/links")
    placed = nodes.join(roots, "node", "left").join(links, "node", "left").select("node", "weight", F.coalesce("root", "node").alias("root"), F.coalesce("links", F.lit(0)).alias("links"))
    placed = stored(placed, f"{folder}/placed")
    own = every.join(placed, "node", "left")
    least = stored(own.where("root IS NOT NULL").groupBy(F.col("root").alias("r")).agg(F.min("vec_id").alias("least")), f"{folder}/least")
    out = own.join(least, F.col("root") == F.col("r"), "left").withColumn("component_id", F.coalesce("least", "vec_id"))
    n_links = F.coalesce(F.col("links") + F.col("weight") - 1, F.lit(0)).cast("long")
    return out.select("vec_id", n_links.alias("n_links"), "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))
