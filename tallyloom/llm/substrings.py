"""Repeated passages across and within documents by seed and extend (operator 3).

A window is ``window`` consecutive words. Winnowing picks, from the ANCHOR-word grams inside each window, the leftmost one with the
smallest hash: equal windows have equal anchors at equal places, so two windows can only be equal if their anchors are. The windows that
pick one anchor follow one another; together with the words that they reach left and right of it they are the anchor's stretch.

Seeds are anchors that occur more than once. Seeds with equal stretches match over all their windows and are taken together as one class,
however many copies there are. Where a seed has several classes, one member of each is extended: for every one of its windows the words left
and right of the anchor are hashed, and classes join on them. Matched windows of neighbouring seeds run into each other; their unions are
the maximal repeats. No step pairs the members of a group: every join has one row a key on one side.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._shared import discard, made, slices, split_join, stored, sweep, text_bytes
from ._words import Runs, find, hashes, mix

#: Words in an anchor; windows pick one of window - ANCHOR + 1 grams.
ANCHOR = 11
NO_ID = -(1 << 63)


def leftmost_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """For each i the leftmost index of the smallest of values[i : i + width]; len(values) - width + 1 entries."""
    best, at, have = values, np.arange(len(values)), 1
    while have < width:
        step = min(have, width - have)
        n = len(best) - step
        right = best[step:] < best[:n]
        best, at = np.where(right, best[step:], best[:n]), np.where(right, at[step:], at[:n])
        have += step
    return at


def _windows(batch: pa.RecordBatch, window: int):
    """Of a slice: first word of each document, runs of words by two independent hashes, and whether a window starts at each word."""
    data, offsets = text_bytes(batch.column("text"))
    starts, ends, first = find(data, offsets)
    words, others = hashes(data, starts, ends), hashes(data, starts, ends, 1)
    left = np.repeat(first[1:], np.diff(first)) - np.arange(len(words))  # words up to the document's end
    return first, Runs(words), Runs(others), left >= window


def stretches(docs: DataFrame, window: int) -> DataFrame:
    """(seed, stretch, key, check, at, n, lead): windows at to at + n - 1 of a document pick the anchor at word at + lead."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            first, grams, context, starts = _windows(batch, window)
            size = len(starts)
            if size < window:
                continue
            at = np.arange(size - ANCHOR + 1)
            anchor = leftmost_minimum(grams.hash(at, at + ANCHOR), window - ANCHOR + 1)
            begin = np.flatnonzero(starts)  # all have their anchor inside their own document
            anchor = anchor[begin]
            new = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (begin[1:] != begin[:-1] + 1)])) if len(begin) else begin
            n = np.diff(np.append(new, len(begin)))
            begin, anchor = begin[new], anchor[new]
            seed = grams.hash(anchor, anchor + ANCHOR)
            lead = anchor - begin
            stretch = mix(context.hash(begin, begin + n - 1 + window, 2) ^ (n * 64 + lead).astype(np.uint64), 3)
            doc = np.searchsorted(first, begin, side="right") - 1
            take = pa.array(doc)
            yield pa.RecordBatch.from_arrays(
                [pa.array(seed.view(np.int64)), pa.array(stretch.view(np.int64)), batch.column("key").take(take), batch.column("check").take(take), pa.array(begin - first[doc], pa.int32()), pa.array(n, pa.int32()), pa.array(lead, pa.int32())],
                names=["seed", "stretch", "key", "check", "at", "n", "lead"],
            )

    return docs.mapInArrow(pick, "seed bigint, stretch bigint, key bigint, check bigint, at int, n int, lead int")


def extend(docs: DataFrame, window: int) -> DataFrame:
    """docs with seeds array<struct<seed, stretch, copies, at, n, lead>>: (seed, stretch, copies, nth, words) for each window of each seed."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            first, _, context, _ = _windows(batch, window)
            lists = batch.column("seeds")
            doc = np.repeat(np.arange(batch.num_rows), np.diff(np.asarray(lists.offsets)))
            flat = lists.flatten()
            seed, stretch, copies, at, n, lead = (flat.field(i) for i in range(6))
            at, n, lead = (np.asarray(x).astype(np.int64) for x in (at, n, lead))
            row = np.repeat(np.arange(len(n)), n)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            begin = first[doc[row]] + at[row] + nth
            words = mix(context.hash(begin, begin + window, 4) ^ (lead[row] - nth).astype(np.uint64), 5)
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays([seed.take(take), stretch.take(take), copies.take(take), pa.array(nth, pa.int32()), pa.array(words.view(np.int64))], names=["seed", "stretch", "copies", "nth", "words"])

    return docs.mapInArrow(each, "seed bigint, stretch bigint, copies bigint, nth int, words bigint")


def cut(docs: DataFrame, window: int, layout: bool) -> DataFrame:
    """docs (row, text, repeats array<struct<at, mask>>): row, number of words, maximal repeats and the text outside them."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = []
            for text, repeats in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("repeats").to_pylist()):
                words, spans = (text or b"").split(), []
                covered = sorted(r["at"] + i for r in repeats or () for i in range(r["mask"].bit_length()) if r["mask"] >> i & 1)
                for at in covered:
                    if spans and at <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], at + window)
                    else:
                        spans.append([at, at + window])
                stays = list(zip([0, *(b for _, b in spans)], [*(a for a, _ in spans), len(words)]))
                if not layout:
                    kept = b" ".join(w for a, b in stays for w in words[a:b])
                elif spans:
                    data = np.frombuffer(text, dtype=np.uint8)
                    begins, ends, _ = find(data, np.array([0, len(data)]))
                    kept = b" ".join(text[begins[a] : ends[b - 1]] for a, b in stays if a < b)
                else:
                    kept = text
                out.append((len(words), [{"begin": a, "end": b} for a, b in spans], sum(b - a for a, b in spans), None if kept is None else kept.decode()))
            yield pa.RecordBatch.from_arrays([batch.column("row"), *(pa.array(c, t) for c, t in zip(zip(*out), OUT))], names=["row", "n_words", "spans", "n_removed", "kept_text"])

    row = docs.schema["row"].dataType.simpleString()
    return docs.mapInArrow(each, f"row {row}, n_words bigint, spans array<struct<begin:bigint,end:bigint>>, n_removed bigint, kept_text string")


OUT = [pa.int64(), pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])), pa.int64(), pa.string()]


def repeated_passages(docs: DataFrame, window: int = 35, carry: Sequence[str] = ("doc_id",), layout: bool = False) -> DataFrame:
    """The columns named in carry, n_words, spans, n_removed and kept_text for every row of docs (doc_id, text and those of carry).

    Words are runs of characters other than space and U+0009 to U+000D. spans: the maximal stretches [begin, end) of words that are
    covered by windows whose words also start anywhere else, the same document included; all copies are covered, the first one too.
    kept_text: the words outside spans joined by one space; with layout, what lies outside spans as it stands in the text, joined by one
    space, and the text itself where nothing is covered. A null text has no words and its kept_text is empty (with layout, null). A text
    shorter than a window is never cut. Repeated rows are each other's copies. A null doc_id stays null. An empty table gives no rows.
    window: words, more than ANCHOR and at most 61 + ANCHOR. Windows are compared by a 64-bit hash of their anchor and an
    independent one of all their words and the anchor's place, each from its own hashes of the words.
    """
    if not ANCHOR < window <= 61 + ANCHOR:
        raise ValueError(f"window must be more than {ANCHOR} and at most {61 + ANCHOR} words")
    since = made()
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # rows are told apart by doc_id and text, so that doc_id need not be unique
    docs = docs.select(F.struct(*carry).alias("row"), "text", F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("key"), F.xxhash64("text").alias("check"))
    every = stored(stretches(docs.select("text", "key", "check"), window), "stretches")
    seeds = stored(every.groupBy("seed").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "repeated")
    place = F.struct("key", "check", "at")
    found = stored(split_join(every, seeds.select("seed"), ["seed"], place, seeds), "seeds")
    discard(every)
    classes = found.groupBy("seed", "stretch").agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("key", "check", "at", "n", "lead")).alias("one"))
    classes = stored(classes.select("seed", "stretch", "copies", "one.*"), "classes")
    several = classes.groupBy("seed").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("seed")
    members = split_join(classes, several, ["seed"], F.col("stretch")).groupBy("key", "check").agg(F.collect_list(F.struct("seed", "stretch", "copies", "at", "n", "lead")).alias("seeds"))

    # both joins with the texts read one and the same shuffle of them, which needs the same columns in both
    texts = docs.repartition(n, "key", "check")
    windows = stored(extend(texts.join(members.hint("shuffle_hash"), ["key", "check"]).select("row", "text", "seeds"), window), "windows")
    matched = windows.groupBy("seed", "words").agg(F.min("stretch").alias("a"), F.max("stretch").alias("b"), F.max("copies").alias("c")).where("a != b or c > 1").select("seed", "words")
    partly = split_join(windows, matched, ["seed", "words"], F.col("stretch")).select("seed", "stretch", F.expr("shiftleft(1L, nth)").alias("mask"))
    wholly = classes.where("copies > 1").select("seed", "stretch", F.expr("shiftleft(1L, n) - 1").alias("mask"))
    masks = stored(partly.unionAll(wholly).groupBy("seed", "stretch").agg(F.bit_or("mask").alias("mask")), "masks")
    repeats = split_join(found, masks, ["seed", "stretch"], place, classes.select("seed", "stretch", F.col("copies").alias("n"))).groupBy("key", "check").agg(F.collect_set(F.struct("at", "mask")).alias("repeats"))
    sweep(since, found, masks)
    return cut(texts.join(repeats.hint("shuffle_hash"), ["key", "check"], "left").select("row", "text", "repeats"), window, layout).select("row.*", "n_words", "spans", "n_removed", "kept_text")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents without the words that lie in a repeated window of 35 words."""
    found = repeated_passages(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
