"""Packing of documents into sequences of a fixed number of tokens by minimum bin slack (operator 2).

A document longer than a sequence is cut into pieces of full length, the first of which may be shorter. What is to be packed is then
a histogram of at most ``size`` lengths. For each bin the longest piece left is taken and a bitset subset-sum over the lengths
left finds the fullest combination that fits beside it. The combination is taken out as often as its lengths last, so that the plan
has a few thousand combinations however many pieces there are. Pieces of one length are interchangeable: the k-th of them takes the k-th
place for that length, and k comes from counts by file and length, so no task ever holds all pieces of a length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._shared import slices, small, stored
from ._tokens import encoder

PIECES = "doc_id bigint, piece int, start bigint, length int, part int, nth bigint, ids binary"


def fullest(counts: dict[int, int], room: int) -> list[tuple[int, int]]:
    """(length, copies) of the fullest combination of the lengths in counts that fits in room.

    Lengths enter the bitset of reachable sums from the shortest to the longest, and the sum is traced back from the longest: of combinations
    as full as each other the one with the longest pieces is taken, so that short ones, which fit anywhere, are left for later bins.
    """
    mask, reach, steps = (1 << (room + 1)) - 1, 1, []
    for length in sorted(x for x in counts if x <= room):
        copies, block = min(counts[length], room // length), 1
        while copies > 0:  # 1, 2, 4, ... copies at a time reach every number of copies
            block = min(block, copies)
            steps.append((reach, length, block))
            reach |= (reach << (length * block)) & mask
            copies, block = copies - block, 2 * block
    left, used = reach.bit_length() - 1, {}
    for before, length, block in reversed(steps):
        if left >= length * block and before >> (left - length * block) & 1:
            used[length] = used.get(length, 0) + block
            left -= length * block
    return list(used.items())


def plan(histogram: dict[int, int], size: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """(bins, [(length, copies in each bin), ...]) for every combination; together they use each length exactly as often as it occurs."""
    left, made = {k: v for k, v in histogram.items() if v}, []
    while left:
        longest = max(left)
        left[longest] -= 1
        rest = fullest({k: v for k, v in left.items() if v}, size - longest) if size > longest else []
        left[longest] += 1
        use = dict(rest)
        use[longest] = use.get(longest, 0) + 1
        bins = min(left[k] // n for k, n in use.items())
        for k, n in use.items():
            left[k] -= bins * n
            if not left[k]:
                del left[k]
        made.append((bins, sorted(use.items(), reverse=True)))
    return made


def places(made: list[tuple[int, list[tuple[int, int]]]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, low, high, copies, sequence, offset): pieces low to high - 1 of a length go, copies to a bin, to the bins from sequence on."""
    rows, taken, sequence = [], {}, 0
    for bins, use in made:
        offset = 0
        for length, copies in use:
            low = taken.get(length, 0)
            taken[length] = low + bins * copies
            rows.append((length, low, low + bins * copies, copies, sequence, offset))
            offset += length * copies
        sequence += bins
    return rows


def pieces(docs: DataFrame, tokenizer: str, end_id: int, size: int) -> DataFrame:
    """docs (doc_id, text) encoded whole and cut; part and nth number the pieces of each length within a task. See pack()."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seen, e = TaskContext.get().partitionId(), np.zeros(size + 1, dtype=np.int64), encoder(tokenizer)
        for batch in slices(batches):
            ids, offsets = e.encode(batch.column("text").to_pylist())
            ids = np.insert(ids, offsets[1:], end_id).astype("<u4")
            ends = offsets[1:] + np.arange(1, len(offsets))
            lengths = np.diff(ends, prepend=0)
            first = (lengths - 1) % size + 1
            many = (lengths - first) // size + 1
            doc = np.repeat(np.arange(len(lengths)), many)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)
            length = np.where(piece == 0, first[doc], size)
            start = np.where(piece == 0, 0, first[doc] + (piece - 1) * size)
            order = np.argsort(length, kind="stable")
            kinds, at, n = np.unique(length[order], return_index=True, return_counts=True)
            nth = np.empty(len(doc), dtype=np.int64)
            nth[order] = np.arange(len(doc)) - np.repeat(at, n) + np.repeat(seen[kinds], n)
            seen[kinds] += n
            # the pieces follow one another in ids, so their bytes are one buffer
            bounds = np.concatenate([[0], np.cumsum(length)]).astype(np.int32) * 4
            data = pa.Array.from_buffers(pa.binary(), len(doc), [None, pa.py_buffer(bounds), pa.py_buffer(ids.tobytes())])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int32()), pa.array(np.full(len(doc), part), pa.int32()), pa.array(nth), data],
                names=["doc_id", "piece", "start", "length", "part", "nth", "ids"],
            )

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(cut, PIECES)


def pack(docs: DataFrame, tokenizer: str, end_id: int = 2, size: int = 1024) -> DataFrame:
    """(doc_id, piece, start, length, ids, sequence_id, offset) for every piece of docs (doc_id, text; other columns are ignored).

    ids: those of the tokenizers library for the whole text, without added special tokens, and end_id after each document, as little-endian
    unsigned 32-bit integers. A null text is empty and gives one piece with end_id alone. Repeated rows are packed each for itself; a null
    doc_id stays null. An empty table gives no pieces. offset is the piece's place in its sequence; places leave no gap.
    """
    spark = docs.sparkSession
    cut = stored(pieces(docs, tokenizer, end_id, size), "pieces")
    counts = cut.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    counts = stored(counts.withColumn("earlier", F.coalesce(F.sum("n").over(before), F.lit(0))), "piece-counts")
    # at most `size` rows come to the driver, and as many go out again in the plan's few thousand ranges
    histogram = {r[0]: r[1] for r in counts.groupBy("length").agg(F.sum("n")).collect()}
    rows: dict[int, list] = {}
    for length, *place in places(plan(histogram, size)):
        rows.setdefault(length, []).append(tuple(place))
    ranges = spark.createDataFrame(list(rows.items()), "length int, ranges array<struct<low:bigint,high:bigint,copies:bigint,sequence:bigint,offset:bigint>>")
    placed = cut.join(small(counts.select("length", "part", "earlier")), ["length", "part"]).join(F.broadcast(ranges), "length")
    k = F.col("nth") + F.col("earlier")
    placed = placed.withColumn("k", k).withColumn("r", F.filter("ranges", lambda r: (r.low <= F.col("k")) & (F.col("k") < r.high))[0]).drop("ranges")
    at = F.col("k") - F.col("r.low")
    return placed.select(
        "doc_id", "piece", "start", F.col("length").cast("bigint").alias("length"), "ids",
        (F.col("r.sequence") + F.floor(at / F.col("r.copies")).cast("bigint")).alias("sequence_id"),
        (F.col("r.offset") + at % F.col("r.copies") * F.col("length")).alias("offset"),
    )


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents packed into sequences of 1024 tokens: where each piece lies and its checksum."""
    import public_tokenizers

    packed = pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"))
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
