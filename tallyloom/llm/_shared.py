"""The shared folder, tables written to it, and slices of Arrow batches."""

from __future__ import annotations

import atexit
import re
import shutil
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Text bytes that a Python step holds at a time, unless one text alone is longer.
SLICE_BYTES = 1 << 19
#: Rows that a table may have to be broadcast; each is a few longs, so 16 MB or less.
BROADCAST_ROWS = 500_000
#: Parts of a table that one key may fill before it is split, and rows that are worth a part of their own.
PARTS, PART_ROWS = 1000, 512
#: Spark's own setting for it.
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Tables that stored() has written and discard() has not deleted.
_made: list[DataFrame] = []


def shared_dir(spark: SparkSession) -> str:
    """A folder of this application under spark.checkpoint.dir.

    Only a local session, whose executors are the driver, may go without that setting; it then uses /tmp/checkpoints.
    """
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    app = spark.sparkContext.applicationId
    if not folder:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        folder = "/tmp/checkpoints"
        atexit.register(shutil.rmtree, f"{folder}/{app}", ignore_errors=True)
    return f"{folder.rstrip('/')}/{app}"


def stored(df: DataFrame, name: str, tidy: bool = False) -> DataFrame:
    """df written as Parquet to the shared folder and read again: lineage ends there, and no lost executor takes it along.

    tidy: the shuffles of this write are deleted once it is done, instead of when the driver collects its garbage.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    before = spark.conf.get(TIDY)
    if tidy:
        spark.conf.set(TIDY, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(TIDY, before)
    table = spark.read.schema(df.schema).parquet(path)
    table.stored_at = path
    _made.append(table)
    return table


def made() -> int:
    """How many tables there are now; sweep() takes it."""
    return len(_made)


def discard(*tables: DataFrame) -> None:
    """Deletes tables that stored() returned, once nothing that is still to be computed reads them."""
    for table in tables:
        path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(table.stored_at)
        path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
        _made[:] = [t for t in _made if t is not table]


def sweep(since: int, *keep: DataFrame) -> None:
    """Deletes all tables stored since made() was ``since`` but those in keep, which what is returned still reads."""
    discard(*[t for t in _made[since:] if not any(t is k for k in keep)])


def split_join(rows: DataFrame, table: DataFrame, on: list[str], spread: Column, counted: DataFrame | None = None, narrow: bool = False) -> DataFrame:
    """rows joined on the columns ``on`` with table, which has one row a key; a key that very many rows hold is split.

    Keys with more than 1/PARTS of the rows are fewer than PARTS: they come to the driver, are dealt out to as many parts by ``spread``, and table has
    their row once for each part. All other keys are joined as they are. counted: on and n, the number of rows of a key, where that is stored already.
    narrow: table is a stored one of a few longs a row; up to BROADCAST_ROWS of them, it is broadcast and rows do not move.
    """
    if narrow and table.count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(table), on)
    counted = rows.groupBy(*on).agg(F.count(F.lit(1)).alias("n")) if counted is None else counted.select(*on, "n")
    most = max(PART_ROWS, (counted.agg(F.sum("n")).first()[0] or 0) // PARTS)
    counted = counted.where(F.col("n") > most).select(*on, F.ceil(F.col("n") / most).cast("int").alias("parts"))
    hot = counted.collect()  # PARTS at most
    if not hot:
        return rows.join(table, on)
    hot = F.broadcast(rows.sparkSession.createDataFrame(hot, counted.schema))
    rows = rows.join(hot, on, "left").withColumn("part", F.pmod(F.xxhash64(spread), F.coalesce("parts", F.lit(1)))).drop("parts")
    cold = table.join(hot, on, "left_anti").withColumn("part", F.lit(0).cast("bigint"))
    table = cold.unionByName(table.join(hot, on).withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts").cast("bigint") - 1))).drop("parts"))
    return rows.join(table, [*on, "part"]).drop("part")


def ranked(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """df, a stored table, with 1, 2, ... in the order of columns; rows alike in all of them get any of their ranks.

    Ranges of the order, cut at sampled keys, are sorted each for itself; a rank is a row's place in its range and the rows of the ranges before, one count a range.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # rows alike in the order are told apart by a number, so that they can be in several ranges
    keys = [*order, F.col("_tie")]
    ranges = df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(n, *keys).sortWithinPartitions(*keys).drop("_tie")
    ranges = stored(ranges.select("*", F.spark_partition_id().alias("_range"), F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("_place")), "ranges")
    before = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)  # of one row a range
    sizes = ranges.groupBy("_range").agg(F.count(F.lit(1)).alias("_n")).select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return ranges.join(F.broadcast(sizes), "_range").withColumn(name, F.col("_before") + F.col("_place") + 1).drop("_range", "_place", "_before")


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """df, a stored table of a few longs a row, marked for broadcast if it has no more rows than the limit; beyond it, joins shuffle it."""
    return F.broadcast(df) if df.count() <= limit else df


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string array one after another, and n + 1 offsets into them; null is empty."""
    column = column.cast(pa.large_binary()).fill_null(b"") if column.null_count else column.cast(pa.large_binary())
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + n + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each piece has about ``most`` bytes of text, or one row; empty batches are left out."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(batch.schema.get_field_index(text))
        lengths = np.diff(text_bytes(column)[1])
        total = np.cumsum(lengths)
        at = 0
        while at < batch.num_rows:
            before = total[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(total, before + most, side="right")))
            yield batch.slice(at, end - at)
            at = end
