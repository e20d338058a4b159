"""Queries through sinks and sources: what is written in a format and read back equals what went in; and through streams."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import cohort, linkage
from ..sources import arrays, readers, scans, writers
from ..streaming import ingest
from . import views as v
from .queries import _audit, _long, _pivot, query
from .release_queries import _TYPED, _pairs


def _path(spark, name: str) -> str:
    return f"{writers.shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


@query(f"WITH {v.LONG} SELECT * FROM long")
def counts_csv_round_trip(spark, sf_dir):
    """Long counts as one ordered CSV file, read back as text with required columns and typed."""
    path = _path(spark, "long")
    writers.csv_single(_long(spark, sf_dir), path, [F.col("sample_id"), *cohort.matrix_order()])
    t = readers.text_table(spark, path, ["sample_id", "class_id", "cell_type", "n"], exact=True)
    return t.select("sample_id", tx.parse_int(F.col("class_id")).cast("int").alias("class_id"), "cell_type", tx.parse_int(F.col("n")).alias("n"))


@query(f"WITH {v.LONG} SELECT sample_id, class_id, printf('%.10g', n / sum(n) OVER (PARTITION BY sample_id)) AS fraction FROM long")
def fractions_csv_round_trip(spark, sf_dir):
    """Fractions with ten significant digits in a gzipped tab-separated file."""
    path = _path(spark, "fractions")
    f = cohort.fractions(_long(spark, sf_dir)).select("sample_id", "class_id", writers.significant(F.col("fraction")).alias("fraction"))
    writers.csv_single(f, path, sep="\t", gzip=True)
    t = readers.text_table(spark, path, ["sample_id", "class_id", "fraction"], sep="\t")
    return t.select("sample_id", F.col("class_id").cast("int").alias("class_id"), "fraction")


@query(f"WITH {v.LONG}, m AS (SELECT class_id, cell_type, {_pivot} FROM long GROUP BY ALL) SELECT class_id, cell_type, sample_id, n FROM (UNPIVOT m ON {', '.join(v.SAMPLES)} INTO NAME sample_id VALUE n)")
def matrix_csv_round_trip(spark, sf_dir):
    """The counts matrix as CSV, read back and made long again."""
    path = _path(spark, "matrix")
    writers.csv_single(cohort.matrix(_long(spark, sf_dir), v.SAMPLES), path, cohort.matrix_order())
    t = readers.text_table(spark, path, ["class_id", "cell_type"])
    long = cohort.unpivoted(t, ["class_id", "cell_type"])
    return long.select(F.col("class_id").cast("int").alias("class_id"), "cell_type", "sample_id", tx.parse_int(F.col("n")).alias("n"))


@query(f"WITH {v.AUDIT} SELECT slide_id, included, status, coalesce(reason, '') AS reason, total_cells FROM audit")
def audit_csv_round_trip(spark, sf_dir):
    """The audit as CSV: blanks are null again, not zero."""
    path = _path(spark, "audit")
    columns = ["slide_id", "included", "status", "reason", "total_cells"]
    writers.csv_single(_audit(spark, sf_dir).select(*columns), path, [F.col("slide_id")])
    t = readers.text_table(spark, path, columns)
    return t.select("slide_id", tx.parse_bool(F.col("included"), "strict").alias("included"), "status", F.coalesce("reason", F.lit("")).alias("reason"), tx.parse_int(F.col("total_cells")).alias("total_cells"))


@query("SELECT 'slide_' || n_nationkey AS sample_id, n_name AS name, CAST(n_regionkey AS BIGINT) AS region FROM nation")
def json_document_round_trip(spark, sf_dir):
    """A small table as one JSON object of rows in order, read back."""
    path = _path(spark, "document")
    n = v.read(spark, sf_dir, "nation").select(F.concat(F.lit("slide_"), F.col("n_nationkey").cast("string")).alias("sample_id"), F.col("n_name").alias("name"), F.col("n_regionkey").cast("bigint").alias("region"))
    writers.json_document(n, path, "slides", ["sample_id"])
    d = readers.json_documents(spark, path, "slides array<struct<sample_id:string,name:string,region:bigint>>")
    return d.where("_corrupt_record is null").select(F.inline("slides"))


@query("SELECT c_custkey AS k, c_name AS name, CASE WHEN c_custkey % 4 <> 0 THEN c_acctbal END AS balance FROM customer")
def json_lines_round_trip(spark, sf_dir):
    """Rows as JSON lines, read as text and parsed; a null field is null again."""
    path = _path(spark, "lines")
    c = v.read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.when(F.col("c_custkey") % 4 != 0, F.col("c_acctbal")).alias("balance"))
    writers.json_lines(c, path)
    return spark.read.text(path).select(readers.parsed(F.col("value"), "k bigint, name string, balance double").alias("r")).select("r.*")


@query("SELECT s_suppkey AS k, CASE s_suppkey % 4 WHEN 0 THEN 'valid' WHEN 1 THEN 'array' WHEN 2 THEN 'broken' ELSE 'blank' END AS kind, CASE WHEN s_suppkey % 4 = 0 THEN s_suppkey * 2 END AS n_cells FROM supplier")
def resume_summaries(spark, sf_dir):
    """Summaries read so that broken ones and ones that are no objects are null, not errors."""
    k = F.col("s_suppkey")
    text = F.when(k % 4 == 0, F.concat(F.lit('{"n_cells": '), (k * 2).cast("string"), F.lit("}"))).when(k % 4 == 1, "[1]").when(k % 4 == 2, '{"n_cells": ').otherwise("")
    kind = F.when(k % 4 == 0, "valid").when(k % 4 == 1, "array").when(k % 4 == 2, "broken").otherwise("blank")
    return v.read(spark, sf_dir, "supplier").select(k.alias("k"), kind.alias("kind"), readers.parsed(text, "n_cells bigint").n_cells.alias("n_cells"))


@query(f"WITH {v.CELLS} SELECT cell_id, class_id, class_name, round(CAST(x AS FLOAT)::DOUBLE, 3) AS x, round(CAST(x AS FLOAT)::DOUBLE - 2, 2) AS x0 FROM cells")
def cell_table_round_trip(spark, sf_dir):
    """Cells as CSV under other column names, read by aliases; boxes that are not given lie around the centroid."""
    path = _path(spark, "cells")
    c = v.cells(spark, sf_dir).select(F.col("cell_id").alias("object_id"), F.col("class_id").alias("class_idx"), F.lit("unknown").alias("label"), F.col("x").alias("cx"), F.col("y").alias("cy"), F.lit("[[0,0]]").alias("polygon"))
    c.write.option("header", True).option("compression", "gzip").csv(path)
    t = readers.cell_table(spark, path)
    return t.select("cell_id", "class_id", "class_name", F.round(F.col("centroid_x").cast("double"), 3).alias("x"), F.round(F.col("bbox_x0").cast("double"), 2).alias("x0"))


@query(f"WITH {v.CELLS} SELECT class_id, class_name, count(*) AS n FROM cells GROUP BY ALL")
def staged_round_trip(spark, sf_dir):
    """A table that is published twice under one path: readers get the last version."""
    path = _path(spark, "staged")
    counts = cohort.class_counts(v.cells(spark, sf_dir))
    writers.staged(counts.where("n < 0"), path)
    writers.staged(counts, path)
    return writers.current(spark, path)


@query(f"WITH {_TYPED} SELECT sha256 || '  ' || filename AS value FROM t")
def checksum_lines(spark, sf_dir):
    """Lines of a checksum file, written as text and read back."""
    path = _path(spark, "sums")
    writers.checksum_lines(_pairs(spark, sf_dir), "sha256", "filename").write.text(path)
    return spark.read.text(path)


@query("SELECT CAST(l_orderkey AS DOUBLE) AS x, CAST(l_extendedprice AS DOUBLE) AS y FROM lineitem")
def partitioned_arrays(spark, sf_dir):
    """Pairs of coordinates written as parts of an array, and read in ranges of 64 KB."""
    path = _path(spark, "arrays")
    arrays.register(spark)
    pairs = v.read(spark, sf_dir, "lineitem").select(F.array(F.col("l_orderkey").cast("double"), F.col("l_extendedprice").cast("double")).alias("values"))
    pairs.write.format("npy").mode("append").save(path)
    return arrays.arrays(spark, path, 1 << 16).select(F.col("values")[0].alias("x"), F.col("values")[1].alias("y"))


#: Words whose every occurrence is looked for, with their bytes.
MARKERS = ["the ", "und", "://", "@", "license", "ü"]
_MARKED = ", ".join(f"('{m}')" for m in MARKERS)


@query(f"SELECT m AS marker, CAST(sum((length(text) - length(replace(text, m, ''))) // length(m)) AS BIGINT) AS n FROM documents, (VALUES {_MARKED}) AS v(m) GROUP BY 1 HAVING n > 0")
def marker_counts(spark, sf_dir):
    """Texts written as files and searched in ranges of 64 KB by one automaton."""
    path = _path(spark, "texts")
    v.read(spark, sf_dir, "documents").select(F.coalesce("text", F.lit("")).alias("value")).write.text(path)
    hits = scans.marker_hits(spark, path, [m.encode() for m in MARKERS], "*.txt", size=1 << 16)
    return hits.groupBy(F.decode("marker", "UTF-8").alias("marker")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT user_id, event_type, event_id, round(value, 6) AS value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1")
def stream_latest_state(spark, sf_dir):
    """events as a stream of files: the last row of each user and type, kept in a state that survives restarts."""
    path, schema = _path(spark, "state"), "event_id bigint, ts timestamp, user_id bigint, event_type string, value double"
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    ingest.latest_by_key(stream, f"{path}/state", f"{path}/progress", ["user_id", "event_type"], ["ts", "event_id"]).awaitTermination()
    return ingest.latest(spark, f"{path}/state", schema).select("user_id", "event_type", "event_id", F.round("value", 6).alias("value"))


@query("SELECT event_type, time_bucket(INTERVAL '1 hour', ts) AS start, count(*) AS n FROM events GROUP BY 1, 2")
def stream_windowed_counts(spark, sf_dir):
    """events as a stream: counts by type and hour, as the last update of each window has them."""
    path, schema = _path(spark, "windows"), "event_id bigint, ts timestamp, user_id bigint, event_type string, value double"
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    counts = ingest.windowed_counts(stream, "ts", "1 hour", "365 days", "event_type")
    updates = counts.writeStream.outputMode("update").foreachBatch(lambda df, n: df.withColumn("batch", F.lit(n)).write.mode("overwrite").parquet(f"{path}/out/{n}"))
    updates.option("checkpointLocation", f"{path}/progress").trigger(availableNow=True).start().awaitTermination()
    seen = spark.read.schema("start timestamp, event_type string, n bigint, batch bigint").option("recursiveFileLookup", True).parquet(f"{path}/out")
    return seen.groupBy("event_type", "start").agg(F.max_by("n", "batch").alias("n"))


@query("SELECT c_custkey AS id, upper(c_name) AS key FROM customer")
def unicode_keys(spark, sf_dir):
    """Ids in full-width letters and with ligatures and odd separators link with plain ones."""
    k = F.col("c_custkey")
    name = F.regexp_replace(F.upper("c_name"), "#", "-")
    wide = F.translate(name, "CUSTOMER0123456789", "ＣＵＳＴＯＭＥＲ０１２３４５６７８９")
    ids = v.read(spark, sf_dir, "customer").select(k.alias("id"), F.when(k % 2 == 0, wide).otherwise(F.replace(name, F.lit("-"), F.lit(" _"))).alias("raw"))
    return linkage.keyed(ids, "raw").select("id", F.replace("key", F.lit("-"), F.lit("#")).alias("key"))
