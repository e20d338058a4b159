"""Near-duplicate documents by MinHash bands, odd sketches and a check on whole shingle sets (operator 5).

Every document's set of word shingles gives BANDS * ROWS MinHash samples. ROWS samples make a band key; the samples folded into a bitmap of SKETCH
bits by parity make an odd sketch, whose XOR with another one has a number of set bits that tells the similarity closely when it is high.

Documents with equal sets are one class from the start. Classes that share a band key are candidates, but the pairs of a bucket are not all made.
In each of BALLS rounds a bucket has one hub (a member of the fewest balls so far, of these the one that most others share keys with) with which the others are compared:
first by sketches, then by whole sets. A member that the sketch puts into the hub's ball (at most twice the threshold's distance, and a margin) also leaves the shingles
by which it differs from the hub. Members linked with the hub leave the bucket. Links of the others in the ball with anyone in it follow exactly
from those differences, which are few: a join on the rarest of them finds every such pair (prefix filtering), and unrelated edits meet nowhere. Members that are in no
ball together after that meet by the rarest shingles of their whole sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._components import components
from ._shared import made, slices, small, split_join, stored, sweep, text_bytes
from ._words import LOWER, U, Runs, find, hashes, mix

#: A pair with similarity 0.8 shares no band with probability (1 - 0.8**5)**32, which is 3 in a million.
BANDS, ROWS = 32, 5
#: Bits of a sketch, in 64-bit words.
SKETCH = 512
#: Sketches of pairs in a ball tell at least this much less similarity than pairs have that lie twice the threshold's distance apart.
MARGIN = 0.25
#: Rounds with one hub a bucket; what is left then meets by rare shingles.
BALLS = 2
#: Most slots, a power of two, by which shingles of one set only are told from others; a bit each.
SLOTS = 1 << 27

_random = np.random.default_rng(20250101)
_A = _random.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32) | np.uint32(1)
_B = _random.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32)


def shingle_sets(column: pa.Array, size: int) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its runs of ``size`` words, A-Z in lower case; of all its words if they are fewer."""
    data, offsets = text_bytes(column)
    data = LOWER[data]
    starts, ends, first = find(data, offsets)
    runs = Runs(hashes(data, starts, ends))
    at = np.arange(len(starts))
    end = np.minimum(at + size, np.repeat(first[1:], np.diff(first)))
    whole = runs.hash(at, end)
    out = []
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= size:
            out.append(np.unique(whole[a : b - size + 1]))
        elif b > a:
            out.append(mix(whole[a : a + 1], int(b - a)))  # told apart from a run of ``size`` words
        else:
            out.append(whole[:0])
    return out


def minhashes(shingles: np.ndarray) -> np.ndarray:
    """BANDS * ROWS samples of a set that is not empty."""
    x = (shingles >> U(32)).astype(np.uint32)
    least = None
    for at in range(0, len(x), 1024):
        part = (x[at : at + 1024, None] * _A + _B).min(axis=0)
        least = part if least is None else np.minimum(least, part)
    return least


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, n_shingles, set_a, set_b, bands, sketch) for each row; set_a and set_b identify a set, bands and sketch are null for an empty one."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds = mix(np.arange(BANDS * ROWS, dtype=U), 6)
        for batch in slices(batches):
            sets = shingle_sets(batch.column("text"), size)
            n = np.array([len(s) for s in sets])
            flat = np.concatenate(sets)
            sums = [np.concatenate([[U(0)], np.cumsum(mix(flat, k), dtype=U)]) for k in (7, 8)]
            ends = np.cumsum(n)
            ids = [(s[ends] - s[ends - n]).view(np.int64) for s in sums]
            some = np.flatnonzero(n)
            bands, sketches = [None] * len(n), [None] * len(n)
            if len(some):
                samples = np.stack([minhashes(sets[i]) for i in some]).astype(U)
                keys = np.zeros((len(some), BANDS), dtype=U)
                for r in range(ROWS):
                    keys = mix(keys ^ samples[:, r::ROWS], 9 + r)
                keys = mix(keys + np.arange(BANDS, dtype=U), 20).view(np.int64)
                bit = (mix(samples ^ seeds, 21) % U(SKETCH)).astype(np.int64) + np.arange(len(some))[:, None] * SKETCH
                odd = (np.bincount(bit.ravel(), minlength=len(some) * SKETCH) & 1).astype(np.uint8)
                odd = np.packbits(odd.reshape(len(some), SKETCH), axis=1).view(np.int64)
                for row, i in enumerate(some):
                    bands[i], sketches[i] = keys[row], odd[row]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids[0]), pa.array(ids[1]), pa.array(bands, pa.list_(pa.int64())), pa.array(sketches, pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "set_a", "set_b", "bands", "sketch"],
            )

    return docs.mapInArrow(sign, "doc_id bigint, n_shingles bigint, set_a bigint, set_b bigint, bands array<bigint>, sketch array<bigint>")


COMPARED = "hub bigint, node bigint, hub_size bigint, size bigint, linked boolean, apart array<bigint>"


def compared(pairs: DataFrame, size: int, percent: int) -> DataFrame:
    """Of pairs (hub, node, hub_text, text): sizes of the whole sets, whether 100 * |intersection| >= percent * |union|, and the shingles that only one has."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(slices(batches, "hub_text"), "text"):
            hubs, nodes = (shingle_sets(batch.column(c), size) for c in ("hub_text", "text"))
            out = []
            for a, b in zip(hubs, nodes):
                apart = np.setxor1d(a, b, assume_unique=True)
                both = (len(a) + len(b) - len(apart)) // 2
                out.append((len(a), len(b), both > 0 and 100 * both >= percent * (both + len(apart)), apart.view(np.int64)))
            columns = [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.bool_(), pa.list_(pa.int64())))]
            yield pa.RecordBatch.from_arrays([batch.column("hub"), batch.column("node"), *columns], names=["hub", "node", "hub_size", "size", "linked", "apart"])

    return pairs.mapInArrow(check, COMPARED)


def _union(links: list[DataFrame]) -> DataFrame:
    out = links[0]
    for more in links[1:]:
        out = out.unionAll(more)
    return out


def _compare(docs: DataFrame, pairs: DataFrame, sketches: DataFrame, size: int, percent: int, reach: int) -> DataFrame:
    """COMPARED for those of the pairs (hub, node) whose sketches tell no more than reach times the threshold's distance and MARGIN."""
    samples = BANDS * ROWS
    least = max(0.0, 1 - reach * (1 - percent / 100) - MARGIN)
    # samples of sets with similarity J differ in 2 * samples * (1 - J) elements, which set about this many bits
    most = SKETCH / 2 * (1 - (1 - 2 / SKETCH) ** (2 * samples * (1 - least)))
    bits = sum((F.bit_count(F.col("hub_sketch")[i].bitwiseXOR(F.col("sketch")[i])) for i in range(SKETCH // 64)), F.lit(0))
    pairs = pairs.join(sketches, "node").join(sketches.select(F.col("node").alias("hub"), F.col("sketch").alias("hub_sketch")), "hub")
    # not made distinct again: that would keep all rows of a hub in the task that joins them
    pairs = stored(pairs.where(bits <= most).select("hub", "node"), "pairs")
    wanted = stored(pairs.select(F.col("hub").alias("doc_id")).unionAll(pairs.select("node")).distinct(), "wanted")
    texts = stored(docs.join(small(wanted), "doc_id"), "texts")
    both = split_join(pairs, texts.select(F.col("doc_id").alias("hub"), F.col("text").alias("hub_text")), ["hub"], F.col("node")).join(texts.select(F.col("doc_id").alias("node"), "text"), "node")
    return compared(both.select("hub", "node", "hub_text", "text"), size, percent)


def _inside(balls: DataFrame, percent: int) -> DataFrame:
    """(a, b): links between two nodes of one hub's ball at least one of which is not linked with the hub.

    Sets x and y are linked if |x ^ y| <= k * (|x| + |y|) with k = (100 - percent) / (100 + percent), and |x ^ y| is what their differences from the hub have
    apart. So two nodes must share ``need`` of their differences or more, at least one, and their rarest len - need + 1 differences must meet. need grows with
    both numbers of differences: nodes are put into classes by theirs, and each asks for partners of each class by as few differences as that class allows.
    """
    k = (100 - percent) / (100 + percent)
    away = stored(balls.groupBy("hub").agg(F.count(F.lit(1)).alias("n"), F.bool_and("linked").alias("all")).where("not all"), "hubs")
    balls = stored(split_join(balls, away.select("hub"), ["hub"], F.col("node"), away, narrow=True).withColumn("n", F.size("apart")), "balls")
    top = balls.agg(F.max("n")).first()[0] or 0
    lows = sorted({math.ceil(2 ** (i / 4)) - 1 for i in range(4 * top.bit_length() + 5)})
    classes = [F.struct(F.lit(i).alias("i"), F.lit(low).alias("low"), F.lit(high - 1).alias("high")) for i, (low, high) in enumerate(zip(lows, lows[1:]))]
    # a hub with very many nodes lies in one part of the table: its rows are dealt out before each becomes many
    even = balls.repartition(int(balls.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    spread = stored(even.select("hub", "node", "linked", "size", "hub_size", "n", F.explode("apart").alias("shingle")), "differences")
    often = stored(spread.groupBy("hub", "shingle").agg(F.count(F.lit(1)).alias("often")).where("often > 1"), "shared")
    order = F.row_number().over(W.partitionBy("hub", "node").orderBy("often", "shingle"))
    # a difference that only one node has meets nothing, but has its place among the rarest
    placed = spread.join(often, ["hub", "shingle"], "left").withColumn("often", F.coalesce("often", F.lit(1))).withColumn("place", order).where("often > 1")
    own = F.filter(F.array(*classes), lambda c: (c.low <= F.col("n")) & (F.col("n") <= c.high))[0].i
    # rounded down a little, so that no rounding of doubles can lose a pair
    need = lambda c: F.greatest(F.lit(1), F.ceil((F.col("n") - k * (F.col("size") + F.col("hub_size")) + (1 - k) * c.low) / 2 - 1e-6))
    asked = F.filter(F.array(*classes), lambda c: (need(c) <= F.least("n", c.high)) & (F.col("place") <= F.col("n") - need(c) + 1))
    placed = stored(placed.select("hub", "node", "linked", "shingle", own.alias("own"), F.explode(F.transform(asked, lambda c: c.i)).alias("partner")), "placed")
    x, y = placed.where("not linked").alias("x"), placed.alias("y")
    meets = (F.col("x.hub") == F.col("y.hub")) & (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.own") == F.col("y.partner")) & (F.col("x.partner") == F.col("y.own"))
    met = x.join(y, meets & (F.col("y.linked") | (F.col("x.node") < F.col("y.node")))).select(F.col("x.hub").alias("hub"), F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()
    for end in ("a", "b"):
        met = met.join(balls.select("hub", F.col("node").alias(end), F.col("size").alias(f"size_{end}"), F.col("apart").alias(f"apart_{end}")), ["hub", end])
    both = F.size("apart_a") + F.size("apart_b") - 2 * F.size(F.array_intersect("apart_a", "apart_b"))
    total = F.col("size_a") + F.col("size_b")
    return stored(met.where((100 + percent) * both <= (100 - percent) * total).select("a", "b").distinct(), "inside")


def _shared_slots(sets: DataFrame) -> tuple[np.ndarray, int]:
    """(bits, shift): bit ``shingle >> shift`` tells whether that slot holds several shingles of the stored sets (shingles), so a slot without it one shingle of one set.

    There are about 16 slots a shingle, up to SLOTS; with more shingles than slots, fewer slots hold one only. Each batch leaves a row for a block of 2**18 slots.
    """
    spark = sets.sparkSession
    width = min(SLOTS.bit_length() - 1, max(18, (16 * (sets.agg(F.sum("n")).first()[0] or 0)).bit_length()))
    shift, inside = U(64 - width), 18

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slots = np.sort(batch.column("shingles").flatten().to_numpy().view(U) >> shift).astype(np.int32)
            blocks, starts = np.unique(slots >> inside, return_index=True)
            slots = pa.ListArray.from_arrays(pa.array(np.append(starts, len(slots)), pa.int32()), pa.array(slots & ((1 << inside) - 1)))
            yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int32()), slots], names=["block", "slots"])

    def meet(block: pa.Table) -> pa.Table:
        counts = np.bincount(np.concatenate([c.flatten().to_numpy() for c in block["slots"].chunks]), minlength=1 << inside)
        return pa.table({"block": block["block"][:1], "bits": pa.array([np.packbits(counts > 1).tobytes()])})

    bits = np.zeros((1 << (width - inside), 1 << (inside - 3)), dtype=np.uint8)
    dealt = sets.select("shingles").mapInArrow(deal, "block int, slots array<int>")
    for row in dealt.groupBy("block").applyInArrow(meet, "block int, bits binary").collect():  # SLOTS / 8 bytes at most
        bits[row.block] = np.frombuffer(row.bits, dtype=np.uint8)
    return bits.ravel(), int(shift)


def _meetings(docs: DataFrame, rest: DataFrame, size: int, percent: int) -> DataFrame:
    """(hub, node): every pair of nodes left in rest (node, label) with different labels that may be linked, and few others.

    Linked sets share at least percent of the larger one. So a set with more shingles of its own than the rest of that is linked with nothing, and makes no rows.
    Of each other set's shingles, rarest first, those before the last ceil(percent * n / 100) - 1 hold one of the other's (prefix filtering); what many of these
    documents share comes last and joins nothing.
    """
    nodes = stored(rest.groupBy("node").agg(F.min("label").alias("label")), "left")
    texts = docs.join(small(nodes), docs.doc_id == nodes.node).select("node", "label", "text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = shingle_sets(batch.column("text"), size)
            n = pa.array([len(s) for s in sets], pa.int64())
            own = pa.array([mix(s, 7).sum(dtype=U).astype(np.int64) for s in sets], pa.int64())
            columns = [batch.column("node"), batch.column("label"), n, own, pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["node", "label", "n", "own", "shingles"])

    schema = "node bigint, label bigint, n bigint, own bigint, shingles array<bigint>"
    # rows that share a doc_id may have several sets: each has its own order
    sets = stored(texts.mapInArrow(cut, schema).where("n > 0").dropDuplicates(["node", "n", "own"]), "sets")
    bits, shift = _shared_slots(sets)
    told = sets.sparkSession.sparkContext.broadcast(bits)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column("n").to_numpy()
            shingles = batch.column("shingles").flatten()
            slots = shingles.to_numpy().view(U) >> U(shift)
            shared = (told.value[slots >> U(3)] >> (U(7) - (slots & U(7))).astype(np.uint8)) & 1 == 1
            many = np.diff(np.append(0, np.cumsum(shared))[np.append(0, np.cumsum(n))])
            may = 100 * many >= percent * n
            left = shingles.filter(pa.array(shared & np.repeat(may, n)))
            ends = np.append(0, np.cumsum(many[may]))
            columns = [batch.column(c).filter(pa.array(may)) for c in ("node", "label", "n", "own")]
            yield pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), left)], names=batch.schema.names)

    rows = sets.mapInArrow(spread, schema)
    rows = stored(rows.select("node", "label", "n", "own", F.explode("shingles").alias("shingle")), "shingles")
    often = stored(rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("often")).where("often > 1"), "often")
    # shingles that only one set has meet nothing and are the rarest: n tells how many they are, so they make no rows here
    own = W.partitionBy("node", "n", "own")
    place = F.row_number().over(own.orderBy("often", "shingle")) + F.col("n") - F.count(F.lit(1)).over(own)
    placed = rows.join(often, "shingle").withColumn("place", place)
    placed = stored(placed.where(F.col("place") <= F.col("n") - F.ceil(F.col("n") * percent / 100) + 1).select("node", "label", "n", "shingle"), "prefixes")
    x, y = placed.alias("x"), placed.alias("y")
    near = (F.least("x.n", "y.n") * 100 >= F.greatest("x.n", "y.n") * percent) & (F.col("x.label") != F.col("y.label"))
    met = x.join(y, (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.node") < F.col("y.node")) & near)
    return met.select(F.col("x.node").alias("hub"), F.col("y.node").alias("node")).distinct()


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of docs (doc_id, text; other columns are ignored).

    A document's set holds its runs of ``size`` words, A-Z in lower case; with fewer words, all of them as one run; with none, or a null
    text, nothing, and it is linked with nothing. Documents are linked if 100 * |intersection| >= percent * |union|. component_id is the smallest
    doc_id that links reach, the document's own included. Rows that share a doc_id are one document: it has the links of each. A row with
    a null doc_id is linked with nothing, has a null component_id and is kept. An empty table gives no rows.
    """
    since = made()
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    signed = stored(signatures(docs, size), "signatures")
    alike = ["set_a", "set_b", "n_shingles"]
    named = signed.where("doc_id is not null and n_shingles > 0")
    classes = stored(named.groupBy(*alike).agg(F.min("doc_id").alias("node")), "classes")
    nodes = stored(named.join(classes, alike).where("doc_id = node").select("node", "bands", "sketch"), "nodes")
    membership = stored(named.select("doc_id", *alike).join(classes, alike).select("doc_id", "node").distinct(), "membership")
    first = membership.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("z")).where("a != z").select("doc_id", "a")
    links = [stored(membership.join(first, "doc_id").where("a != node").select("a", F.col("node").alias("b")).distinct(), "similar")]

    members = nodes.select("node", F.explode("bands").alias("bucket"))
    shared = stored(members.groupBy("bucket").agg(F.count(F.lit(1)).alias("m")).where("m > 1"), "shared")
    members = stored(members.join(shared, "bucket"), "buckets")
    company = members.groupBy("node").agg((-F.sum("m")).alias("alone"))
    rest = stored(members.join(company, "node").select("bucket", "node", "alone", F.col("node").alias("label"), F.array().cast("array<bigint>").alias("balls")), "rest")
    sketches = nodes.select("node", "sketch")
    for _ in range(BALLS):
        if not rest.take(1):
            break
        hubs = rest.groupBy("bucket").agg(F.min(F.struct(F.size("balls").alias("n"), "alone", "node", "label")).alias("h"))
        hubs = stored(hubs.select("bucket", F.col("h.node").alias("hub"), F.col("h.label").alias("hub_label")), "hubs")
        rows = stored(rest.join(hubs, "bucket").where("label != hub_label").select("bucket", "hub", "node"), "rows")
        # what is linked with a linked node has at most twice the threshold's distance from the hub
        balls = stored(_compare(docs, rows.select("hub", "node").distinct(), sketches, size, percent, reach=2), "compared")
        links += [balls.where("linked").select(F.col("hub").alias("a"), F.col("node").alias("b")), _inside(balls, percent)]
        labels = components(_union(links)).select("node", F.col("root").alias("label"))
        # linked nodes and hubs leave their buckets; buckets that one ball covers or that links hold together are done
        found = rows.join(balls.select("hub", "node", "linked"), ["hub", "node"]).select("bucket", "node", F.col("hub").alias("in"), "linked").dropDuplicates(["bucket", "node"])
        rest = rest.join(found, ["bucket", "node"], "left").where("linked is null or not linked").join(hubs.select("bucket", F.col("hub").alias("node")), ["bucket", "node"], "left_anti")
        rest = rest.withColumn("balls", F.when(F.col("in").isNull(), F.col("balls")).otherwise(F.array_append("balls", F.col("in")))).drop("label", "in", "linked")
        rest = stored(rest.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")).select("bucket", "node", "alone", "label", "balls"), "rest")
        covered = rest.select("bucket", F.explode("balls").alias("ball")).groupBy("bucket", "ball").agg(F.count(F.lit(1)).alias("n")).groupBy("bucket").agg(F.max("n").alias("most"))
        open_ = rest.groupBy("bucket").agg(F.min("label").alias("a"), F.max("label").alias("z"), F.count(F.lit(1)).alias("m")).join(covered, "bucket", "left").where("a != z and m > coalesce(most, 0)").select("bucket")
        rest = stored(rest.join(stored(open_, "open"), "bucket"), "rest")
    if rest.take(1):  # members that no ball holds together are met by their rarest shingles, so no bucket makes all its pairs
        last = _compare(docs, _meetings(docs, rest, size, percent), sketches, size, percent, reach=1)
        links.append(stored(last.where("linked").select(F.col("hub").alias("a"), F.col("node").alias("b")), "linked"))
    roots = components(_union(links))
    found = membership.join(roots, "node", "left").groupBy("doc_id").agg(F.min(F.coalesce("root", "node")).alias("component_id"))
    out = signed.select("doc_id", "n_shingles").join(found, "doc_id", "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))
    out = stored(out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))), "near")
    sweep(since, out)
    return out


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents by components of equal or similar sets of two-word shingles."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), size=2, percent=80)
