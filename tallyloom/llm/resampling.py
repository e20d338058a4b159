"""Importance resampling towards the distribution of a target's words, by combined CRCs (operator 12).

A text's features are its runs of 1 to ``longest`` consecutive words; a feature's bucket is the CRC-32 of its words joined by one space, modulo the number of buckets.
Each word's CRC is computed once, for all words of a slice at a time. CRCs are linear over GF(2): the CRC of a + b is that of a, moved on by the length of b, xor that
of b, and moving on by 2**k bytes is a 32 x 32 matrix over GF(2). So a run's CRC follows from that of the run without its last word; no run is ever written out.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._shared import discard, ranked, slices, stored, text_bytes
from ._words import LOWER, find

#: Fixed value: the reflected polynomial of CRC-32.
POLYNOMIAL = 0xEDB88320
#: Words of more bytes are handed to zlib one by one, so that a long word does not hold up all others.
LONG = 32
#: Bytes outside words, after A-Z are lower-case: everything in ASCII but digits and letters.
BETWEEN = np.ones(256, dtype=bool)
BETWEEN[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


def _byte_table() -> np.ndarray:
    """The remainder that each byte leaves."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(POLYNOMIAL), table >> 1)
    return table


TABLE = _byte_table()
_shifts: list[np.ndarray] = []


def _apply(tables: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """A matrix over GF(2), given as what each value of each of the four bytes becomes, applied to CRCs."""
    return tables[0][crc & 255] ^ tables[1][crc >> 8 & 255] ^ tables[2][crc >> 16 & 255] ^ tables[3][crc >> 24]


def _shift_tables(k: int) -> np.ndarray:
    """The matrix that moves a CRC on by 2**k bytes of zeros: one byte by the byte table, then each the square of the one before."""
    while len(_shifts) <= k:
        values = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
        if not _shifts:
            moved = TABLE[values & 255] ^ (values >> 8)
        else:
            moved = _apply(_shifts[-1], _apply(_shifts[-1], values))
        _shifts.append(moved)
    return _shifts[k]


def combine(first: np.ndarray, second: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32 of a + b from those of a and b and the bytes of b."""
    moved, k = first.astype(np.uint32), 0
    while len(length) and int(length.max()) >> k:
        some = np.flatnonzero(length >> k & 1)
        moved[some] = _apply(_shift_tables(k), moved[some])
        k += 1
    return moved ^ second


def word_crcs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of each byte range."""
    lengths = ends - starts
    order = np.argsort(-lengths, kind="stable")
    lengths, at = lengths[order], starts[order]
    out = np.full(len(order), 0xFFFFFFFF, dtype=np.uint32)
    for i in range(min(LONG, int(lengths[0]) if len(lengths) else 0)):
        m = int(np.searchsorted(-lengths, -i, side="left"))  # words of more than i bytes
        out[:m] = TABLE[(out[:m] ^ data[at[:m] + i]) & 255] ^ (out[:m] >> 8)
    out ^= np.uint32(0xFFFFFFFF)
    for i in range(int(np.searchsorted(-lengths, -LONG, side="left"))):
        out[i] = zlib.crc32(data[at[i] : at[i] + lengths[i]])
    back = np.empty_like(out)
    back[order] = out
    return back


def features(batch: pa.RecordBatch, longest: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a slice: number of words of each text, the text of each feature, the bucket of each feature."""
    data, offsets = text_bytes(batch.column("text"))
    data = LOWER[data]
    starts, ends, first = find(data, offsets, BETWEEN)
    words, lengths = word_crcs(data, starts, ends), ends - starts
    text = np.repeat(np.arange(batch.num_rows), np.diff(first))
    left = np.repeat(first[1:], np.diff(first)) - np.arange(len(words))  # words up to the text's end
    at, run = np.arange(len(words)), words
    space = np.full(1, zlib.crc32(b" "), dtype=np.uint32)
    texts, crcs = [text], [words]
    for n in range(2, longest + 1):
        go_on = left[at] >= n
        at, run = at[go_on], run[go_on]
        run = combine(run, np.broadcast_to(space, run.shape), np.ones(len(run), dtype=np.int64))
        run = combine(run, words[at + n - 1], lengths[at + n - 1])
        texts.append(text[at])
        crcs.append(run)
    return np.diff(first), np.concatenate(texts), np.concatenate(crcs) % np.uint32(buckets)


def bucket_counts(docs: DataFrame, longest: int, buckets: int) -> np.ndarray:
    """How many features of all texts lie in each bucket; one row a bucket comes to the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in slices(batches):
            total += np.bincount(features(batch, longest, buckets)[2], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some])], names=["bucket", "n"])

    out = np.zeros(buckets, dtype=np.int64)
    for bucket, n in docs.select("text").mapInArrow(count, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray, scale: int = 1000) -> np.ndarray:
    """For each bucket the logarithm of how much likelier it is in the target, with one feature added to every bucket, times scale, rounded down."""
    n = len(source)
    above = (target + 1).astype(np.float64) * np.float64(int(source.sum()) + n)
    below = (source + 1).astype(np.float64) * np.float64(int(target.sum()) + n)
    return np.floor(scale * np.log(above / below)).astype(np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, longest: int, carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The columns named in carry, n_words, n_features, and weight: the mean gain of a text's features, rounded down, 0 without features."""
    buckets = len(gain)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words, text, bucket = features(batch, longest, buckets)
            n = np.bincount(text, minlength=batch.num_rows)
            # gains are whole numbers far below 2**53, so their sums in doubles are exact
            total = np.bincount(text, weights=gain[bucket], minlength=batch.num_rows).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(words), pa.array(n), pa.array(np.where(n, total // np.maximum(n, 1), 0))], names=["row", "n_words", "n_features", "weight"])

    docs = docs.select(F.struct(*carry).alias("row"), "text")
    return docs.mapInArrow(each, f"row {docs.schema['row'].dataType.simpleString()}, n_words bigint, n_features bigint, weight bigint").select("row.*", "n_words", "n_features", "weight")


def importance_resample(docs: DataFrame, target: DataFrame, longest: int = 2, buckets: int = 10_000, percent: int = 10, least_words: int = 20, seed: int = 2024) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) for every row of docs (doc_id, text; other columns are ignored) against the texts of target (text).

    Words are runs of digits, letters and characters beyond ASCII, with A-Z lower-case; a text's features are its runs of 1 to ``longest`` words, repeats counted.
    weight: the mean of 1000 * log of how much likelier a feature's bucket is in target than in docs. score: weight with Gumbel noise from a hash of seed and doc_id, so that the
    highest scores are a draw without replacement in proportion to exp(weight / 1000). rank: 1, 2, ... for the highest ``percent`` in a hundred of the N texts with
    least_words words or more, rounded down; ties to the smaller doc_id, null last; null for all others.

    A null or empty text has no features and weight 0. A null doc_id is hashed as an empty one. Repeated rows count each for itself and have one score; with one
    id they are ranked in any order. Empty docs give no rows; an empty target makes every bucket's share alike.
    """
    docs, target = docs.select("doc_id", "text"), target.select("text")
    gain = gains(bucket_counts(docs, longest, buckets), bucket_counts(target, longest, buckets))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") + F.lit(0.5)) / F.lit(float(1 << 32)))))
    scored = stored(weigh(docs, gain, longest).withColumn("score", F.col("weight") + noise), "scored")
    enough = F.col("n_words") >= least_words
    drawn = scored.where(enough).count() * percent // 100
    placed = ranked(scored, [enough.desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last()])
    discard(scored)
    return placed.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents scored by single words towards those of benchmark; the best tenth drawn."""
    docs, target = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "benchmark"))
    return importance_resample(docs, target, longest=1).select("doc_id", "n_features", "weight", "score", "rank")


#: CTEs of a recursive query: the remainder that each byte leaves, as one list.
CRC_TABLE_SQL = """steps(n, k, c) AS (
  SELECT n, 0, n::BIGINT FROM range(256) AS r(n)
  UNION ALL
  SELECT n, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM steps WHERE k < 8
),
crc_table AS (SELECT list(c ORDER BY n) AS rest FROM steps WHERE k = 8)
"""


def crc_sql(hexed: str) -> str:
    """DuckDB SQL for the CRC-32 of bytes in hex, where CRC_TABLE_SQL's crc_table is read too."""
    numbers = f"list_transform(range(length({hexed}) // 2), lambda i: ('0x' || substr({hexed}, 2 * i + 1, 2))::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {numbers}), lambda c, b: xor(c >> 8, rest[(xor(c, b) & 255) + 1])), 4294967295)"


OP12_SQL = f"""
WITH RECURSIVE {CRC_TABLE_SQL},
texts AS (SELECT doc_id AS id, true AS ours, text FROM documents UNION ALL SELECT NULL, false, text FROM benchmark),
words AS (
  SELECT id, ours, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS word
  FROM texts
),
counted AS (SELECT id, ours, word, count(*) AS n FROM words GROUP BY ALL),
kinds AS (SELECT word, hex(encode(word)) AS bytes FROM counted GROUP BY ALL),
bucketed AS (SELECT word, {crc_sql('bytes')} % 10000 AS bucket FROM kinds, crc_table),
sums AS (SELECT bucket, coalesce(sum(n) FILTER (ours), 0) AS s, coalesce(sum(n) FILTER (NOT ours), 0) AS t FROM counted JOIN bucketed USING (word) GROUP BY bucket),
gains AS (
  SELECT bucket, floor(1000 * ln(((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE) / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE)))::BIGINT AS gain FROM sums
),
weights AS (
  SELECT id AS doc_id, sum(n)::BIGINT AS n_features, floor(sum(n * gain)::DOUBLE / sum(n))::BIGINT AS weight
  FROM counted JOIN bucketed USING (word) JOIN gains USING (bucket) WHERE ours GROUP BY id
),
scored AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5) / 4294967296)))::BIGINT AS score
  FROM documents LEFT JOIN weights USING (doc_id)
)
SELECT doc_id, n_features, weight, score,
       CASE WHEN n_features >= 20 AND row_number() OVER best <= 10 * count(*) FILTER (n_features >= 20) OVER () // 100 THEN row_number() OVER best END AS rank
FROM scored WINDOW best AS (ORDER BY n_features >= 20 DESC, score DESC, doc_id)
"""
