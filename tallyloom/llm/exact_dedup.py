"""Exact deduplication with an extendible-hash index on shared files (operator 4), in DataFrame operations only.

Every row is written to a page with a 64-bit hash of its normalised text, the text's SHA-256 digest and how many code points it has; rows of one page with equal
hash and digest become one entry, so a text that a third of all rows share is one entry a page. The directory is found as an extendible hash file finds it: it
doubles while some bucket of its hash prefix holds more than ``capacity`` entries, and only overfull buckets split. It tells each entry its bucket;
entries go to the owner of their key range, a task that puts the entries of equal texts in a bucket together and chains different digests under one
hash. Rows find the row that stays by their bucket, hash and digest in this index. Last, the bytes of every text with copies are compared with those of its kept row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._shared import discard, split_join, stored

#: Entries in a bucket before it splits, and hash bits beyond which it overflows instead; the directory has at most 2**MAX_DEPTH rows.
CAPACITY = 1 << 12
MAX_DEPTH = 14


def normalised(text: Column) -> Column:
    """The text without the characters space and U+0009 to U+000D; null is empty."""
    out = F.coalesce(text, F.lit(""))
    for character in (" ", "\t", "\n", "\v", "\f", "\r"):
        out = F.replace(out, F.lit(character), F.lit(""))
    return out


def directory(counts: dict[int, int], capacity: int, max_depth: int) -> tuple[int, list[tuple[int, int, int]]]:
    """The directory's depth, and (prefix, bucket, own depth) for each of its 2**depth prefixes.

    counts: entries by prefix of max_depth bits. A bucket keeps the shortest prefix under which no more than capacity entries lie (at
    max_depth any number), and is named by that prefix, filled up with zeros; the directory is as deep as its deepest bucket.
    """
    levels = [counts]
    for _ in range(max_depth):
        wider: dict[int, int] = {}
        for prefix, n in levels[-1].items():
            wider[prefix >> 1] = wider.get(prefix >> 1, 0) + n
        levels.append(wider)
    levels.reverse()  # by number of bits
    depth = 1
    while depth < max_depth and max(levels[depth].values(), default=0) > capacity:
        depth += 1
    rows = []
    for prefix in range(1 << depth):
        own = next(d for d in range(depth + 1) if d == depth or levels[d].get(prefix >> (depth - d), 0) <= capacity)
        rows.append((prefix, prefix >> (depth - own) << (depth - own), own))
    return depth, rows


def index_entries(pages: DataFrame, capacity: int, max_depth: int) -> tuple[DataFrame, DataFrame]:
    """The index (bucket, hash, digest, chain, group_size, keep_row, keep_id) of pages (page, hash, digest, doc_id, points, row), and its directory (prefix, bucket, depth).

    Of equal texts the row with the most points is kept, then the smallest doc_id (null last), then the smallest row. chain: the place of a digest among those of its hash, from 1.
    """
    spark = pages.sparkSession
    first = F.struct((-F.col("points")).alias("points"), F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("id"), "row", "doc_id")
    entries = stored(pages.groupBy("page", "hash", "digest").agg(F.count(F.lit(1)).alias("n"), F.min(first).alias("keep")).drop("page"), "entries")
    # at most 2**max_depth counts come to the driver and as many rows of the directory go out
    counts = {r[0]: r[1] for r in entries.groupBy(F.shiftrightunsigned("hash", 64 - max_depth).cast("int").alias("prefix")).count().collect()}
    depth, rows = directory(counts, capacity, max_depth)
    buckets = F.broadcast(spark.createDataFrame(rows, "prefix int, bucket int, depth int"))
    # the owner of a range of keys has all entries of each of its hashes, so neither the grouping nor the chains shuffle again
    owned = entries.join(buckets, F.shiftrightunsigned("hash", 64 - depth).cast("int") == buckets["prefix"]).repartitionByRange("bucket", "hash")
    merged = owned.groupBy("bucket", "hash", "digest").agg(F.sum("n").alias("group_size"), F.min("keep").alias("keep"))
    chain = F.row_number().over(W.partitionBy("bucket", "hash").orderBy("digest"))
    index = stored(merged.select("bucket", "hash", "digest", chain.alias("chain"), "group_size", F.col("keep.row").alias("keep_row"), F.col("keep.doc_id").alias("keep_id")), "index")
    discard(entries)
    return index, buckets


def exact_duplicates(docs: DataFrame, capacity: int = CAPACITY, max_depth: int = MAX_DEPTH, compare: bool = True) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256, points, bucket) for every row of docs (doc_id, text; other columns are ignored).

    Texts are equal when they are identical without space and U+0009 to U+000D; null counts as empty, and empty texts equal each other.
    points: code points of the text as it stands. Of equal texts the row with the most of them stays, then the one with the smallest doc_id (null last); of rows alike
    in both, exactly one. An empty table gives no rows. compare: texts of one entry whose bytes differ raise an error.
    """
    text = normalised(F.col("text"))
    keyed = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.length("text"), F.lit(0)).alias("points"), text.alias("norm"))
    keyed = keyed.select("doc_id", "points", "norm", F.xxhash64("norm").alias("hash"), F.sha2("norm", 256).alias("digest"))
    # a number for each row of the pages, fixed once they are written, tells repeated rows apart
    pages = keyed.select(F.spark_partition_id().alias("page"), "hash", F.unhex("digest").alias("digest"), "doc_id", "points", F.monotonically_increasing_id().alias("row"))
    pages = stored(pages, "pages")
    index, buckets = index_entries(pages, capacity, max_depth)

    if compare:
        _compare(keyed, index.where("group_size > 1"))
    depth = 64 - (buckets.count() - 1).bit_length()
    asked = pages.join(buckets.drop("depth"), F.shiftrightunsigned("hash", depth).cast("int") == buckets["prefix"]).drop("prefix", "page")
    out = split_join(asked, index, ["bucket", "hash", "digest"], F.col("row"), index.withColumnRenamed("group_size", "n"))
    return out.select("doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"), "points", "bucket")


def _compare(keyed: DataFrame, copied: DataFrame) -> None:
    """Compares the bytes of every text in keyed that has an entry in copied with those of a row with the kept row's doc_id; an error if two differ."""
    rows = keyed.select("doc_id", "norm", "hash", F.unhex("digest").alias("digest"), F.monotonically_increasing_id().alias("row"))
    counted = copied.select("hash", "digest", F.col("group_size").alias("n"))
    texts = split_join(rows, copied.select("hash", "digest", "keep_id"), ["hash", "digest"], F.col("row"), counted, narrow=True)
    texts = stored(texts.select("hash", "digest", "norm", "row", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("keeper")), "copies")
    keepers = texts.where("keeper").groupBy("hash", "digest").agg(F.first("norm").alias("kept"))
    differ = split_join(texts, keepers, ["hash", "digest"], F.col("row"), counted).where("norm != kept").limit(1).count()
    discard(texts)
    if differ:
        raise ValueError("two texts with the same SHA-256 digest differ")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents with the row that stays of each group of equal texts."""
    return exact_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("points", "bucket")


OP4_SQL = """
WITH t AS (
  SELECT doc_id, coalesce(length(text), 0) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) = 1 AS kept,
       text_sha256
FROM t
"""
