"""Near-duplicate vectors by NN-descent (operator 6).

Vectors with equal components and label are one node. A first neighbour graph comes from random hyperplanes: a few trees of sign codes cut every
label into blocks of about BLOCK nodes (more than that are dealt out by hash), inside which neighbours are exact. Then rounds of NN-descent: neighbours
of neighbours, forward and backward, are compared with a node and the nearest ones kept, as long as a round still finds links.

A list is saturated when all of its entries are links: there may be more. It is then enlarged, to LONG entries that are links, and, as that can be too few too,
every group of nodes that links connect is completed after the rounds. Nobody lists its pairs: tasks compare one cell of the group with another as matrices and
give each node's number of links. In a large group, nodes that lie within half of the threshold's angle from the group's mean direction are linked with one
another (by the triangle inequality of angles) and are counted without being compared.

Last, recall is audited: the links of a bounded sample of nodes are looked for among all nodes, each node with links counts the same, and more trees and
rounds follow while too few of them lie in one group. A result whose recall stays too low is not returned: that is an error.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._components import components
from ._shared import discard, made, split_join, stored, sweep

#: Nodes that a block has on average, neighbours in a list, in an enlarged one, those looked up backward, trees of a first graph.
BLOCK, LIST, LONG, BACK, TREES = 256, 5, 10, 3, 3
#: Nodes on a side of a cell of a group's matrix; groups of no more nodes share a cell with others.
CELL = 4096
#: Angles from the mean direction are known this well, in radians.
SLACK = 1e-6
#: Rounds of NN-descent at most; one that adds less than this share of the links is the last.
ROUNDS, SETTLED = 6, 0.001
#: Nodes whose links are looked for among all nodes, and the share of a node's links that the graph must have on average.
AUDITED, RECALL = 256, 0.95
#: Nodes with links that an audit needs; while it has fewer, more nodes are drawn, WIDER times as many each time, at most WIDENED times.
NEEDED, WIDER, WIDENED = 100, 4, 2
#: Times that trees and rounds are added before a recall that is still lower is an error. Eight make 24 trees, of which one at least keeps a pair of cosine 0.98 together at depth 16 with a chance above 0.999.
ATTEMPTS = 8
#: Trees that have to do where fewer than NEEDED nodes with links were drawn, though not all nodes were: too few to go by their recall alone.
TRUSTED = TREES * ATTEMPTS

log = logging.getLogger(__name__)

EDGES = "a bigint, b bigint, cosine double"


def _lengths(batch: pa.RecordBatch, column: str = "vector") -> Iterator[pa.RecordBatch]:
    """The batch in parts whose vectors have one length each."""
    if batch.num_rows:
        n = np.diff(np.asarray(batch.column(column).offsets))
        for length in np.unique(n):
            yield batch if (n == length).all() else batch.take(pa.array(np.flatnonzero(n == length)))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = np.asarray(column.flatten().cast(pa.float64()))
    return flat.reshape(len(column), -1)


def _cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return (x / np.linalg.norm(x, axis=1)[:, None]) @ (y / np.linalg.norm(y, axis=1)[:, None]).T


def _edges(a: np.ndarray, b: np.ndarray, cosine: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(cosine, pa.float64())], names=["a", "b", "cosine"])


def _near(ids: np.ndarray, vectors: np.ndarray) -> pa.RecordBatch:
    """Edges from each vector of a block to its LIST nearest others."""
    if len(ids) < 2:
        return _edges(ids[:0], ids[:0], np.zeros(0))
    s = _cosines(vectors, vectors)
    np.fill_diagonal(s, -2)
    k = min(LIST, len(ids) - 1)
    j = np.argpartition(-s, k - 1, axis=1)[:, :k].ravel()
    i = np.repeat(np.arange(len(ids)), k)
    return _edges(ids[i], ids[j], s[i, j])


def _blocks(nodes: DataFrame, tree: int) -> DataFrame:
    """Edges inside the blocks of one tree of sign codes. The depth is a label's own; a block's rows come from counts, not from a task that holds it."""
    kind = nodes.schema["vector"].dataType.simpleString()

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for whole in batches:
            for batch in _lengths(whole):
                x = _matrix(batch.column("vector"))
                d = x.shape[1]
                if d not in planes:
                    planes[d] = np.random.default_rng(1000 + tree).standard_normal((16, d))
                signs = (x @ planes[d].T > 0) @ (1 << np.arange(16))
                yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("label"), pa.array(signs, pa.int32()), batch.column("vector")], names=["node", "label", "code", "vector"])

    sizes = nodes.groupBy("label").agg(F.greatest(F.lit(0), F.least(F.lit(16), F.ceil(F.log2(F.count(F.lit(1)) / BLOCK)))).cast("int").alias("depth"), F.count(F.lit(1)).alias("n"))
    sizes = stored(sizes, "sizes")
    coded = nodes.mapInArrow(code, f"node bigint, label string, code int, vector {kind}")
    coded = stored(split_join(coded, sizes.drop("n"), ["label"], F.col("node"), sizes, narrow=True).withColumn("code", F.expr("code & (shiftleft(1, depth) - 1)")), "codes")
    blocks = stored(coded.groupBy("label", "code").agg(F.count(F.lit(1)).alias("n")).withColumn("chunks", F.ceil(F.col("n") / BLOCK)), "blocks")
    coded = split_join(coded, blocks.drop("n"), ["label", "code"], F.col("node"), blocks, narrow=True)
    coded = coded.withColumn("chunk", F.pmod(F.xxhash64("node", F.lit(tree)), "chunks"))

    def inside(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        return pa.Table.from_batches([_near(np.asarray(table.column("node").chunk(0)), _matrix(table.column("vector").chunk(0)))])

    # dealt out by chunk as well: the join alone would leave all chunks of a block with one task
    coded = coded.select("label", "code", "chunk", "node", "vector").repartition("label", "code", "chunk")
    return coded.groupBy("label", "code", "chunk").applyInArrow(inside, EDGES)


def _compared(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(a, b, cosine) of the pairs (a, b)."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _lengths(whole, "vector_a"):
                x, y = _matrix(batch.column("vector_a")), _matrix(batch.column("vector_b"))
                cosine = np.einsum("ij,ij->i", x, y) / (np.linalg.norm(x, axis=1) * np.linalg.norm(y, axis=1))
                yield _edges(np.asarray(batch.column("a")), np.asarray(batch.column("b")), cosine)

    for end in ("a", "b"):
        pairs = pairs.join(nodes.select(F.col("node").alias(end), F.col("vector").alias(f"vector_{end}")), end)
    return pairs.select("a", "b", "vector_a", "vector_b").mapInArrow(each, EDGES)


def _lists(edges: DataFrame, threshold: float, most: int = LIST, long: int = LONG) -> DataFrame:
    """Each node's nearest neighbours, ties by number; beyond ``most`` of them as far as they are links, up to ``long``."""
    order = W.partitionBy("a").orderBy(F.desc("cosine"), "b")
    listed = edges.groupBy("a", "b").agg(F.max("cosine").alias("cosine")).withColumn("n", F.row_number().over(order)).where(F.col("n") <= long)
    return listed.where((F.col("n") <= most) | (F.col("cosine") >= threshold)).drop("n")


def _mirrored(edges: DataFrame) -> DataFrame:
    return edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b"), "cosine"))


def _descend(graph: DataFrame, nodes: DataFrame, before: DataFrame | None, threshold: float) -> DataFrame:
    """(a, b, cosine) of one round: each node with the neighbours, forward and backward, of its neighbours; not where both steps were there before."""
    backward = _lists(graph.select(F.col("b").alias("a"), F.col("a").alias("b"), "cosine"), threshold, BACK, BACK)
    both = graph.select("a", "b").unionAll(backward.select("a", "b")).distinct()
    if before is None:
        both = both.withColumn("new", F.lit(True))
    else:
        both = both.join(before.select("a", "b", F.lit(False).alias("new")), ["a", "b"], "left").withColumn("new", F.coalesce("new", F.lit(True)))
    both = stored(both, "steps")
    # a node may be in very many lists, but its own list is one row
    onward = both.groupBy("a").agg(F.collect_list(F.struct("b", "new")).alias("onward")).withColumnRenamed("a", "b")
    met = split_join(both, onward, ["b"], F.col("a")).select("a", "new", F.explode("onward").alias("to")).where("(new or to.new) and a < to.b")
    found = stored(_compared(met.select("a", F.col("to.b").alias("b")).distinct(), nodes), "descent")
    discard(both)
    return found


def _summed(i: np.ndarray, ids: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    some = np.flatnonzero(n)
    return pa.RecordBatch.from_arrays([pa.array(ids[i[some]], pa.int64()), pa.array(n[some], pa.int64())], names=["node", "others"])


def _count(x: np.ndarray, y: np.ndarray, weight: np.ndarray, threshold: float) -> np.ndarray:
    """For each row of x the weights of the rows of y that it is linked with, itself included if it is there."""
    out = np.zeros(len(x), dtype=np.int64)
    for at in range(0, len(x), 512):
        out[at : at + 512] = (_cosines(x[at : at + 512], y) >= threshold) @ weight
    return out


COUNTS = "node bigint, others bigint"


def _grown(groups: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """(node, others): copies of the other nodes that each node of the groups (node, root) is linked with, all nodes of its group compared."""
    sizes = stored(groups.groupBy("root").agg(F.count(F.lit(1)).alias("n")), "sizes")
    held = stored(split_join(groups, sizes, ["root"], F.col("node"), sizes, narrow=True).join(nodes.select("node", "vector", "copies"), "node"), "members")
    few, many = held.where(F.col("n") <= CELL), held.where(F.col("n") > CELL)
    bins = max(1, -(-few.count() // CELL))

    def together(table: pa.Table) -> pa.Table:
        """Whole groups of one bin."""
        table = table.sort_by("root").combine_chunks()
        out = [pa.RecordBatch.from_pylist([], schema=pa.schema([("node", pa.int64()), ("others", pa.int64())]))]
        root, ids, copies, vectors = (table.column(c).chunk(0) for c in ("root", "node", "copies", "vector"))
        cuts = np.flatnonzero(np.diff(np.asarray(root), prepend=np.asarray(root)[0] - 1))
        for a, b in zip(cuts, np.append(cuts[1:], len(root))):
            x, weight = _matrix(vectors.slice(a, b - a)), np.asarray(copies)[a:b]
            out.append(_summed(np.arange(a, b), np.asarray(ids), _count(x, x, weight, threshold) - weight))
        return pa.Table.from_batches(out)

    counts = few.withColumn("bin", F.pmod(F.xxhash64("root"), F.lit(bins))).select("bin", "root", "node", "copies", "vector").groupBy("bin").applyInArrow(together, COUNTS)
    if many.take(1):
        counts = counts.unionAll(_grown_large(many, threshold))
    return counts.groupBy("node").agg(F.sum("others").alias("others"))


def _grown_large(held: DataFrame, threshold: float) -> DataFrame:
    """(node, others) in parts, for groups of more than CELL nodes (root, node, n, copies, vector)."""
    kind = held.schema["vector"].dataType.simpleString()
    half = float(np.arccos(threshold)) / 2 - SLACK

    def unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row for each group of a task: the sum of its unit vectors."""
        sums: dict[int, np.ndarray] = {}
        for whole in batches:
            for batch in _lengths(whole):
                x, root = _matrix(batch.column("vector")), np.asarray(batch.column("root"))
                x = x / np.linalg.norm(x, axis=1)[:, None]
                for r in np.unique(root):
                    sums[r] = sums.get(r, 0) + x[root == r].sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array([list(v) for v in sums.values()], pa.list_(pa.float64()))], names=["root", "total"])

    # fewer groups than nodes / CELL, and each is one vector
    totals = held.select("root", "vector").mapInArrow(unit, "root bigint, total array<double>")
    mean = totals.select("root", F.posexplode("total").alias("i", "x")).groupBy("root", "i").agg(F.sum("x").alias("x")).groupBy("root").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda p: p.x).alias("mean"))

    def angle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _lengths(whole):
                x, m = _matrix(batch.column("vector")), _matrix(batch.column("mean"))
                along = np.einsum("ij,ij->i", x, m) / np.maximum(np.einsum("ij,ij->i", m, m), 1e-300)
                across = np.linalg.norm(x - along[:, None] * m, axis=1)
                apart = np.arctan2(across, along * np.linalg.norm(m, axis=1))
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("root", "node", "copies", "vector")), pa.array(apart <= half)], names=["root", "node", "copies", "vector", "inner"])

    sized = held.groupBy("root").agg(F.count(F.lit(1)).alias("n"))
    placed = split_join(held.drop("n"), mean, ["root"], F.col("node"), sized).mapInArrow(angle, f"root bigint, node bigint, copies bigint, vector {kind}, inner boolean")
    placed = stored(placed, "placed")
    sizes = placed.groupBy("root").agg(F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col("inner"), F.col("copies")).otherwise(0)).alias("within"), F.sum(F.when(F.col("inner"), 0).otherwise(1)).alias("outer"))
    sizes = stored(sizes.withColumn("across", F.ceil(F.col("n") / CELL).cast("int")).withColumn("down", F.ceil(F.col("outer") / CELL).cast("int")), "sizes")
    placed = split_join(placed, sizes.drop("n"), ["root"], F.col("node"), sizes, narrow=True)
    mutual = placed.where("inner").select("node", (F.col("within") - F.col("copies")).alias("others"))
    # the others are compared with the whole group: every one of ``down`` parts of them with every one of ``across`` parts of all
    deal = lambda parts: F.pmod(F.xxhash64("node"), F.greatest(F.col(parts), F.lit(1))).cast("int")
    below = placed.where("not inner").withColumn("i", deal("down")).withColumn("j", F.explode(F.expr("sequence(0, across - 1)"))).withColumn("asks", F.lit(True))
    beside = placed.where("down > 0").withColumn("j", deal("across")).withColumn("i", F.explode(F.expr("sequence(0, down - 1)"))).withColumn("asks", F.lit(False))
    columns = ["root", "i", "j", "asks", "node", "copies", "inner", "vector"]

    def cell(table: pa.Table) -> pa.Table:
        """Links of those that ask with all that are beside them; those of inner nodes are counted for both ends."""
        table = table.combine_chunks()
        asks = np.asarray(table.column("asks").chunk(0).cast(pa.int8())).astype(bool)
        ids, copies, x = np.asarray(table.column("node").chunk(0)), np.asarray(table.column("copies").chunk(0)), _matrix(table.column("vector").chunk(0))
        inner = np.asarray(table.column("inner").chunk(0).cast(pa.int8())).astype(bool)
        below, beside = np.flatnonzero(asks), np.flatnonzero(~asks)
        if not len(below) or not len(beside):
            return pa.Table.from_batches([_summed(below[:0], ids, copies[:0])])
        own = np.where(np.isin(ids[below], ids[beside]), copies[below], 0)
        back = beside[inner[beside]]
        out = [_summed(below, ids, _count(x[below], x[beside], copies[beside], threshold) - own), _summed(back, ids, _count(x[back], x[below], copies[below], threshold))]
        return pa.Table.from_batches(out)

    cells = below.select(*columns).unionAll(beside.select(*columns)).groupBy("root", "i", "j").applyInArrow(cell, COUNTS)
    return mutual.unionAll(cells)


def _audit(groups: DataFrame, nodes: DataFrame, threshold: float) -> tuple[float, int]:
    """The share of a node's links, found among all nodes, that lie in its group, as a mean over drawn nodes that have links, and how many those are.

    A mean over nodes, as one node of a large group has more links than many pairs. AUDITED nodes are drawn first, more while too few of them have links.
    """
    total = nodes.count()
    rooted = stored(nodes.select("node", "label", "vector").join(groups, "node", "left").withColumn("root", F.coalesce("root", "node")), "rooted")
    for widened in range(WIDENED + 1):
        drawn = AUDITED * WIDER**widened
        recall, linked = _recall(rooted, threshold, drawn)
        if linked >= NEEDED or drawn >= total:
            break
    discard(rooted)
    log.info("recall %.4f over %d nodes with links of %d drawn", recall, linked, min(drawn, total))
    return recall, linked


def _recall(rooted: DataFrame, threshold: float, drawn: int) -> tuple[float, int]:
    by_length: dict[int, list] = {}
    for r in rooted.orderBy(F.xxhash64("node"), "node").limit(drawn).collect():
        by_length.setdefault(len(r["vector"]), []).append(r)
    asked = {d: (np.array([r["node"] for r in rows], dtype=np.int64), np.array([r["root"] for r in rows], dtype=np.int64), np.array([r["label"] for r in rows]), np.array([r["vector"] for r in rows], dtype=np.float64)) for d, rows in by_length.items()}

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each drawn node its links in this task's rows, and those of them in its group."""
        true, found = ({d: np.zeros(len(x[0]), dtype=np.int64) for d, x in asked.items()} for _ in range(2))
        for whole in batches:
            for batch in _lengths(whole):
                x = _matrix(batch.column("vector"))
                if x.shape[1] not in asked:
                    continue
                ids, roots, kinds, vectors = asked[x.shape[1]]
                own, root, label = (np.asarray(batch.column(c)) for c in ("node", "root", "label"))
                for k in range(0, len(ids), AUDITED):
                    some = slice(k, k + AUDITED)
                    link = (_cosines(vectors[some], x) >= threshold) & (kinds[some, None] == label[None, :]) & (ids[some, None] != own[None, :])
                    true[x.shape[1]][some] += link.sum(axis=1)
                    found[x.shape[1]][some] += (link & (roots[some, None] == root[None, :])).sum(axis=1)
        for d, (ids, *_) in asked.items():
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(true[d]), pa.array(found[d])], names=["node", "links", "found"])

    shares = rooted.mapInArrow(near, "node bigint, links bigint, found bigint").groupBy("node").agg(F.sum("links").alias("links"), F.sum("found").alias("found")).where("links > 0")
    recall, linked = shares.agg(F.avg(F.col("found") / F.col("links")), F.count(F.lit(1))).first()
    return (recall if linked else 1.0), linked


def near_vectors(vectors: DataFrame, threshold: float = 0.98) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of vectors (vec_id, embedding, label; other columns are ignored).

    Rows are linked if their labels are equal (as text) and not null, their embeddings have one length, and the cosine of the embeddings, in double precision, is at
    least the threshold. An embedding that is null, empty or zero, or that holds null or a component that is not finite, is linked with nothing, as is a row
    with a null label or vec_id (whose component_id is null and which is kept). n_links: other rows linked directly, repeated rows included; rows that share a
    vec_id count each for itself. component_id: the smallest vec_id that links reach, the row's own included. An empty table gives no rows. RuntimeError: too few of the audited links were found.
    """
    since = made()
    kind = "float" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "double"
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast(f"array<{kind}>").alias("vector"), F.col("label").cast("string").alias("label"))
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0)
    rows = rows.withColumn("fine", F.coalesce(F.expr("vec_id is not null and label is not null") & fine, F.lit(False)))
    alone = rows.where("not fine").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    good = rows.where("fine").select("vec_id", F.concat_ws(":", F.size("vector"), "label").alias("label"), "vector")
    # equal vectors are one node; vec_ids may repeat, so nodes have numbers of their own, fixed once they are written
    nodes = good.groupBy("label", "vector").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"))
    nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()), "vectors")
    if not nodes.take(1):
        return alone

    every, graph, old, tree, n, more = None, None, None, 0, 0, TREES
    for _ in range(ATTEMPTS):
        for at in range(tree, tree + more, TREES):
            edges = [_blocks(nodes.select("node", "label", "vector"), t) for t in range(at, at + TREES)]
            graph = stored(_lists(reduce(DataFrame.unionAll, edges if graph is None else [graph, *edges]), threshold), "lists")
        tree += more
        for _ in range(ROUNDS):
            found = _descend(graph, nodes, old, threshold)
            old, graph = graph, stored(_lists(graph.unionAll(_mirrored(found)), threshold), "lists")
            links = old.unionAll(found).where(F.col("cosine") >= threshold).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
            every = stored((links if every is None else every.unionAll(links)).distinct(), "links")
            discard(found)
            n, before = every.count(), n
            if n - before <= SETTLED * before:
                break
        groups = stored(components(every), "groups")
        recall, linked = _audit(groups, nodes, threshold)
        enough = linked >= NEEDED or nodes.count() <= AUDITED * WIDER**WIDENED
        if recall >= RECALL and (enough or tree >= TRUSTED):
            break
        more = TREES if enough else max(TREES, TRUSTED - tree)
    else:
        raise RuntimeError(f"recall of links is {recall:.4f} over {linked} audited nodes after {tree} trees, below {RECALL}")

    grown = groups.join(_grown(groups, nodes, threshold), "node", "left")
    summary = stored(nodes.join(grown, "node", "left").select("node", "label", "vector", "least", "copies", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "root"), "summary")
    named = stored(summary.where("root is not null").groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("n")), "named")
    linked = split_join(summary.where("root is not null"), named.drop("n"), ["root"], F.col("node"), named, narrow=True)
    single = summary.where("root is null").withColumn("component_id", F.col("least"))
    found = linked.select(single.columns).unionAll(single).select("label", "vector", "n_links", "component_id")
    found = split_join(good, found, ["label", "vector"], F.col("vec_id"), summary.select("label", "vector", F.col("copies").alias("n")))
    sweep(since, summary, named)
    return alone.unionAll(found.select("vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept")))


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """embeddings by links of cosine 0.98 or more within a label."""
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
