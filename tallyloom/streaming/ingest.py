"""Structured Streaming over tables that arrive as files."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators.integrity import upsert
from ..sources.writers import _hadoop

#: Buckets of keys that latest_by_key() writes for itself.
BUCKETS = 64


def files_stream(spark: SparkSession, path: str, schema: str, kind: str = "parquet", per_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).format(kind).option("maxFilesPerTrigger", per_batch).load(path)


def running_counts(cells: DataFrame, *by: str) -> DataFrame:
    """Cells by class of all slides so far; for output mode complete or update."""
    return cells.groupBy(*by, "class_id").agg(F.count(F.lit(1)).alias("n"))


def windowed_counts(events: DataFrame, time: str, length: str, late: str, *by: str) -> DataFrame:
    """Events by tumbling window; rows later than late behind the latest time are left out."""
    return events.withWatermark(time, late).groupBy(F.window(time, length), *by).agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("start"), *by, "n")


def _versions(spark: SparkSession, path: str, before: int | None = None) -> dict[int, list[int]]:
    """The batches, before a number, that each bucket has a folder of."""
    _, root, fs = _hadoop(spark, path)
    out: dict[int, list[int]] = {}
    for batch in fs.listStatus(root) if fs.exists(root) else ():
        name = batch.getPath().getName()
        if name.isdigit() and (before is None or int(name) < before):
            for bucket in fs.listStatus(batch.getPath()):
                if bucket.getPath().getName().startswith("_bucket="):
                    out.setdefault(int(bucket.getPath().getName()[8:]), []).append(int(name))
    return out


def latest(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows that latest_by_key() keeps now."""
    newest = [f"{path}/{max(v)}/_bucket={b}" for b, v in _versions(spark, path).items()]
    return spark.read.schema(schema).parquet(*newest) if newest else spark.createDataFrame([], schema)


def latest_by_key(stream: DataFrame, path: str, checkpoint: str, keys: list[str], order: list[str]) -> StreamingQuery:
    """Keeps the last row of each key in Parquet below path; latest() reads it.

    Keys are dealt out to BUCKETS buckets; a batch writes anew only the buckets that it has rows of, below its own number, so a batch that runs again writes the same
    folders again. Of each bucket the last two versions stay.
    """

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        spread = batch.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")).persist()
        touched = {r[0] for r in spread.select("_bucket").distinct().collect()}  # BUCKETS at most
        versions = _versions(spark, path, number)
        before = [f"{path}/{max(v)}/_bucket={b}" for b, v in versions.items() if b in touched]
        rows = spread if not before else spread.unionByName(spark.read.schema(batch.schema).parquet(*before).withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")))
        last = upsert(rows.where("false"), rows, ["_bucket", *keys], order)
        last.write.mode("overwrite").partitionBy("_bucket").parquet(f"{path}/{number}")
        spread.unpersist()
        for b in touched & set(versions):
            for old in sorted(versions[b])[:-1]:
                _, folder, fs = _hadoop(spark, f"{path}/{old}/_bucket={b}")
                fs.delete(folder, True)

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


#: What run_markers() needs of a session: states that hold values by key and timers.
STATE_STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


class _Markers(StatefulProcessor):
    """The open run of one slide: since when it works, and its deadline as a timer. One value a slide, whatever number of reports."""

    def __init__(self, limit: int) -> None:
        self.limit = limit

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "since bigint")

    def _since(self) -> int | None:
        return self.open.get()[0] if self.open.exists() else None

    @staticmethod
    def _rows(key: tuple, changes: list[tuple[int, str]]) -> pd.DataFrame:
        texts = pd.DataFrame({"slide_id": [key[0]] * len(changes), "status": [s for _, s in changes]}, dtype=object)
        texts.insert(1, "millis", pd.Series([a for a, _ in changes], dtype="int64"))
        return texts

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        changes = []
        reports = pd.concat(list(rows))  # those of one slide in one batch
        before = since = self._since()
        for at, ends in sorted(zip(reports["millis"].tolist(), (reports["report"] != "started").tolist())):
            if since is not None and at >= since + self.limit:
                changes.append((since + self.limit, "expired"))
                since = None
            if not ends:
                since = at
                changes.append((at, "withdrawn"))
            elif since is not None:
                since = None
                changes.append((at, "published"))
        # every call to the store is a round trip: one read and one write a batch, not some a report
        if since != before:
            if before is not None:
                self.handle.deleteTimer(before + self.limit)
            if since is None:
                self.open.clear()
            else:
                self.open.update((since,))
                self.handle.registerTimer(since + self.limit)
        yield self._rows(key, changes)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        since = self._since()
        if since is None or since + self.limit != expiredTimerInfo.getExpiryTimeInMs():
            yield self._rows(key, [])
            return
        self.open.clear()
        yield self._rows(key, [(since + self.limit, "expired")])

    def close(self) -> None:
        pass


def run_markers(reports: DataFrame, limit: int, late: str) -> DataFrame:
    """(slide_id, at, status): changes of slides' completion markers, from a stream of reports (slide_id, at timestamp, report started or finished).

    A start withdraws the marker at once (withdrawn), also while another run is open, which it replaces; the end of an open run publishes it (published), ends of no open run are passed
    over. A run that is still open limit milliseconds after its start, by the stream's own time, has expired: its end no longer publishes. Times are counted in milliseconds; of reports of
    one slide at one time starts come first. Reports more than late behind the latest time are left out; null times and slides and other reports too. The state holds one value for each
    slide that has an open run and survives restarts. Output mode append; the session needs STATE_STORE when the query starts.
    """
    kept = reports.where("slide_id is not null and at is not null and report in ('started', 'finished')").select(F.col("slide_id").cast("string").alias("slide_id"), "at", F.unix_millis("at").alias("millis"), "report")
    grouped = kept.withWatermark("at", late).groupBy("slide_id")
    changes = grouped.transformWithStateInPandas(_Markers(limit), "slide_id string, millis bigint, status string", "append", "eventTime")
    return changes.select("slide_id", F.timestamp_millis("millis").alias("at"), "status")


def markers(changes: DataFrame) -> DataFrame:
    """(slide_id, at, status): the last change of each slide; of changes at one time an expiry or an end comes before a start."""
    order = F.struct("at", F.col("status") == "withdrawn")
    return changes.groupBy("slide_id").agg(F.max_by(F.struct("at", "status"), order).alias("m")).select("slide_id", "m.at", "m.status")
