"""Scans of listings, delimited text, JSON documents, array payloads and image headers."""

from __future__ import annotations

import io
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators.ranking import ordered
from ..operators.validate import ConstraintError
from ..operators.validate import columns as column_problems

#: Columns under other names, in the order in which they are looked for.
ALIASES = {
    "cell_id": ["cell_id", "instance_id", "object_id", "id"],
    "class_id": ["class_id", "class_idx", "label_id", "type_id", "cell_type_id"],
    "class_name": ["class_name", "class", "cell_type", "celltype", "label", "classification", "type", "name"],
    "centroid_x": ["centroid_x", "x", "center_x", "cx"],
    "centroid_y": ["centroid_y", "y", "center_y", "cy"],
    "bbox_x0": ["bbox_x0", "minx", "x0", "left"],
    "bbox_y0": ["bbox_y0", "miny", "y0", "top"],
    "bbox_x1": ["bbox_x1", "maxx", "x1", "right"],
    "bbox_y1": ["bbox_y1", "maxy", "y1", "bottom"],
}


def files(spark: SparkSession, root: str, patterns: list[str], excluded: list[str] = ()) -> DataFrame:
    """(path, relative_path, length, modified) of the files below root that match a pattern, without hidden folders and excluded subtrees, in natural order."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", "length", F.col("modificationTime").alias("modified"))
    path = F.regexp_replace("path", "^file:/+", "/")
    prefix = root.removeprefix("file://").rstrip("/") + "/"
    listing = listing.withColumn("relative_path", F.regexp_replace(path, "^.*?" + prefix.replace(".", "\\."), ""))
    name = F.element_at(F.split("relative_path", "/"), -1)
    kept = listing.where(tx.matches(name, list(patterns))).where(~F.col("relative_path").rlike(r"(^|/)\.[^/]"))
    for e in excluded:
        kept = kept.where(~tx.within(F.col("relative_path"), e))
    return tx.in_natural_order(kept.dropDuplicates(["path"]), "relative_path")


def text_table(spark: SparkSession, path: str | list[str], required: list[str], exact: bool = False, sep: str | None = None) -> DataFrame:
    """A delimited file with a header, all columns as trimmed strings, blank as null. Wrong columns raise ConstraintError."""
    first = path if isinstance(path, str) else path[0]
    sep = sep or ("\t" if first.endswith((".tsv", ".tsv.gz")) else ",")
    df = spark.read.option("header", True).option("sep", sep).option("inferSchema", False).option("multiLine", True).option("escape", '"').csv(path)
    df = df.toDF(*[c.lstrip("﻿").strip() for c in df.columns])
    if wrong := column_problems(df, required, exact):
        raise ConstraintError("; ".join(wrong))
    return df.select(*[F.when(F.trim(f"`{c}`") != "", F.trim(f"`{c}`")).alias(c) for c in df.columns])


def header_check(df: DataFrame, wanted: str, aliases: list[str] | None = None, taken: tuple[str, ...] = ()) -> str | None:
    """The first alias of a column that df has and that is not taken by another one."""
    lower = {c.lower(): c for c in reversed(df.columns)}
    return next((lower[a] for a in aliases or ALIASES[wanted] if a in lower and lower[a] not in taken), None)


def cell_table(spark: SparkSession, path: str) -> DataFrame:
    """Cells of a CSV file, gzipped or not, by aliases of its columns: only those columns are read.

    Rows without a centroid are dropped. Coordinates are floats. A box that is not given is 2 pixels around the centroid. A known class id decides the name, else a known
    name decides the id, else id -1. Without a column of ids, cells are numbered ``cell_%09d`` in the order of slices of the file, from 1.
    """
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    found: dict[str, str | None] = {}
    for c in ALIASES:
        found[c] = header_check(raw, c, taken=tuple(v for v in found.values() if v))
    if not (found["centroid_x"] and found["centroid_y"]):
        raise ConstraintError("a cell table needs centroids")
    get = lambda c: F.col(f"`{found[c]}`") if found[c] else F.lit(None).cast("string")
    number = lambda c: get(c).try_cast("float")
    x, y = number("centroid_x"), number("centroid_y")
    name = tx.class_name(get("class_name"))
    given = get("class_id").try_cast("double").cast("int")
    known = F.when(given.between(0, len(tx.CLASS_NAMES) - 1), given)
    by_name = tx.class_id(name)
    class_id = F.coalesce(known, F.when(by_name >= 0, by_name), given, F.lit(-1))
    columns = [
        get("cell_id").alias("cell_id"), class_id.alias("class_id"), F.when(known.isNotNull(), tx.name_of_class(known)).otherwise(F.coalesce(name, tx.name_of_class(class_id))).alias("class_name"),
        x.alias("centroid_x"), y.alias("centroid_y"), *[F.coalesce(number(f"bbox_{c}"), (x if c[0] == "x" else y) + F.lit(-2 if c[1] == "0" else 2).cast("float")).alias(f"bbox_{c}") for c in ("x0", "y0", "x1", "y1")],
    ]
    df = raw.select(*columns)
    if not found["cell_id"]:
        where = raw.select(F.struct(F.col("_metadata.file_path").alias("p"), F.col("_metadata.file_block_start").alias("s"), F.monotonically_increasing_id().alias("i")).alias("_at"), "*")
        df = ordered(where, [F.col("_at")], "_n").select(F.format_string("cell_%09d", "_n").alias("cell_id"), *columns[1:])
    return df.where(F.col("centroid_x").isNotNull() & F.col("centroid_y").isNotNull() & ~F.isnan("centroid_x") & ~F.isnan("centroid_y"))


def count_tables(spark: SparkSession, root: str) -> DataFrame:
    """(slide_id, class_id, class_name, count) as text of every root/<slide>/cell_types/class_counts.csv; tables deeper down are not read."""
    df = spark.read.option("header", True).schema("class_id string, class_name string, count string").csv(f"{root}/*/cell_types/class_counts.csv")
    return df.withColumn("slide_id", F.regexp_extract(F.col("_metadata.file_path"), r"/([^/]+)/cell_types/class_counts\.csv$", 1))


def json_documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One row a file with the fields of schema, and _corrupt_record where a file is no JSON object."""
    return spark.read.schema(f"{schema}, _corrupt_record string").option("multiLine", True).option("mode", "PERMISSIVE").json(path)


def slide_summaries(spark: SparkSession, root: str) -> DataFrame:
    """Summary documents of root/<slide>/summary/summary.json with their sampling fields; a missing struct gives nulls."""
    df = json_documents(spark, f"{root}/*/summary/summary.json", "slide_id string, n_cells bigint, zero_detections boolean, tile_sampling struct<percent_slide:double,random_seed:bigint,n_tiles_total:bigint,n_tiles_sampled:bigint>")
    return df.select("slide_id", "n_cells", "zero_detections", "tile_sampling.*", F.col("_metadata.file_path").alias("path"))


def parsed(column: Column, schema: str) -> Column:
    """A struct of a JSON text, null where it doesn't parse."""
    return F.from_json(column, schema, {"mode": "PERMISSIVE"})


def _binary(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path)


def array_payload(spark: SparkSession, path: str, array: str, dtype: str = "float64") -> DataFrame:
    """(path, i, value) of a one-dimensional array in .npz or .npy files; pickled payloads are refused. A file is one row of bytes, so one task reads it."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            for p, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                loaded = np.load(io.BytesIO(content), allow_pickle=False)
                values = np.asarray(loaded[array] if hasattr(loaded, "files") else loaded, dtype=dtype).ravel()
                for at in range(0, len(values), 100_000):
                    part = values[at : at + 100_000].astype("float64")
                    yield pa.RecordBatch.from_arrays([pa.array([p] * len(part)), pa.array(np.arange(at, at + len(part))), pa.array(part)], names=["path", "i", "value"])

    return _binary(spark, path, "*.np[yz]").select("path", "content").mapInArrow(read, "path string, i bigint, value double")


def opened(path: str):
    """A file of any store that pyarrow reads (local, HDFS, S3, GCS), for reading ranges inside a task."""
    from pyarrow import fs

    store, inner = fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", path) if path.startswith("file:") else path)
    return store.open_input_file(inner)


def _tiff(read) -> dict:
    """Levels, tiling and the first level's size of a TIFF file, of which read(offset, length) gives ranges; error instead of an exception."""
    try:
        head = read(0, 16)
        order = {b"II": "<", b"MM": ">"}[head[:2]]
        big = struct.unpack(order + "H", head[2:4])[0] == 43
        at = struct.unpack(order + ("Q" if big else "I"), head[8:16] if big else head[4:8])[0]
        out: dict = {"levels": 0, "tiled": False, "bigtiff": big, "width": None, "height": None, "error": None}
        while at and out["levels"] < 1000:
            n = struct.unpack_from(order + ("Q" if big else "H"), read(at, 8))[0]
            start, size = 0, 20 if big else 12
            if n > 65_535:
                raise struct.error("more tags than a directory may have")
            head = read(at + (8 if big else 2), n * size + 8)
            for i in range(n):
                tag, kind = struct.unpack_from(order + "HH", head, start + i * size)
                value = struct.unpack_from(order + {3: "H", 4: "I", 16: "Q"}.get(kind, "I"), head, start + i * size + (12 if big else 8))[0]
                if out["levels"] == 0 and tag in (256, 257):
                    out["width" if tag == 256 else "height"] = value
                out["tiled"] |= out["levels"] == 0 and tag == 322
            out["levels"] += 1
            at = struct.unpack_from(order + ("Q" if big else "I"), head, start + n * size)[0]
        return out
    except (KeyError, struct.error, OSError) as e:
        return {"levels": None, "tiled": None, "bigtiff": None, "width": None, "height": None, "error": f"{type(e).__name__}: {e}"}


def tiff_layout(spark: SparkSession, path: str) -> DataFrame:
    """(path, levels, tiled, bigtiff, width, height, error) of TIFF files; what can't be read has its error as a value. Only headers and tag directories are read."""
    kinds = {"levels": pa.int32(), "tiled": pa.bool_(), "bigtiff": pa.bool_(), "width": pa.int64(), "height": pa.int64(), "error": pa.string()}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for p in batch.column("path").to_pylist():
                try:
                    with opened(p) as f:
                        rows.append(_tiff(lambda at, n, f=f: bytes(f.read_at(n, at))))
                except OSError as e:
                    rows.append(dict.fromkeys(kinds) | {"error": f"{type(e).__name__}: {e}"})
            yield pa.RecordBatch.from_arrays([batch.column("path"), *(pa.array([r[k] for r in rows], t) for k, t in kinds.items())], names=["path", *kinds])

    return _binary(spark, path, "*.tif*").select("path").mapInArrow(read, "path string, levels int, tiled boolean, bigtiff boolean, width bigint, height bigint, error string")


def digests(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, size, sha256, md5) of files, read in chunks, whatever their size."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        for batch in batches:
            out = []
            for p in batch.column("path").to_pylist():
                size, sha256, md5 = 0, hashlib.sha256(), hashlib.md5(usedforsecurity=False)
                with opened(p) as f:
                    while chunk := f.read(8 << 20):
                        size += len(chunk)
                        sha256.update(chunk)
                        md5.update(chunk)
                out.append((p, size, sha256.hexdigest(), md5.hexdigest()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["path", "size", "sha256", "md5"])

    return _binary(spark, path, pattern).select("path").mapInArrow(read, "path string, size bigint, sha256 string, md5 string")
