"""NumPy arrays as a Spark data source, ``npy``: read by ranges of rows, written as parts that one manifest publishes.

    register(spark)
    spark.read.format("npy").load(path)                          # i bigint, value double, or values array<double> for tables
    df.write.format("npy").option("palette", json).mode("append").save(path)  # df(value) or df(values)

path is a .npy file, or a folder: the parts that its manifest names, or all its .npy files if it has none.
"""

from __future__ import annotations

import ast
import json
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage

MANIFEST = "_manifest.json"
#: Bytes of an array that a task reads, and rows of a batch.
RANGE, ROWS = 64 << 20, 100_000


def store(path: str):
    """The file system of a path, and the path inside it."""
    import re

    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", path)) if ":" in path.split("/")[0] else (fs.LocalFileSystem(), path)


def header(read) -> tuple[np.dtype, tuple[int, ...], int]:
    """dtype, shape and first data byte of a .npy file, of which read(offset, length) gives bytes; what is not a plain array in row order is refused by name."""
    head = read(0, 12)
    if head[:6] != b"\x93NUMPY":
        raise ValueError("not a .npy file")
    wide = head[6] > 1
    size = struct.unpack("<I" if wide else "<H", head[8:12] if wide else head[8:10])[0]
    begin = 12 if wide else 10
    said = ast.literal_eval(read(begin, size).decode("utf-8" if head[6] > 2 else "latin-1"))
    dtype = np.dtype(said["descr"])
    if dtype.hasobject:
        raise ValueError("a pickled object payload is refused: its bytes could run code")
    if dtype.kind not in "biuf" or said["fortran_order"] and len(said["shape"]) > 1 or len(said["shape"]) not in (1, 2):
        raise ValueError(f"an array of {dtype} with shape {said['shape']} in {'column' if said['fortran_order'] else 'row'} order is not supported")
    return dtype, tuple(said["shape"]), begin + size


@dataclass
class Part(InputPartition):
    """Rows first to last - 1 of a file, numbered from base on."""

    path: str
    offset: int
    dtype: str
    width: int
    first: int
    last: int
    base: int

    def __init__(self, *values):
        self.path, self.offset, self.dtype, self.width, self.first, self.last, self.base = values


class Reader(DataSourceReader):
    def __init__(self, files: list[tuple], flat: bool, size: int):
        self.files, self.flat, self.size = files, flat, size
        self.low, self.high = 0, 1 << 62

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Bounds of i choose the rows that are read; all other filters are left to Spark."""
        for f in filters:
            if getattr(f, "attribute", None) == ("i",) and isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)):
                if isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual)):
                    self.low = max(self.low, f.value + isinstance(f, GreaterThan))
                if isinstance(f, (EqualTo, LessThan, LessThanOrEqual)):
                    self.high = min(self.high, f.value + (not isinstance(f, LessThan)))
            else:
                yield f

    def partitions(self) -> list[Part]:
        out, base = [], 0
        for path, dtype, shape, offset in self.files:
            width = shape[1] if len(shape) > 1 else 1
            each = max(1, self.size // max(1, np.dtype(dtype).itemsize * width))
            low, high = max(0, self.low - base), min(shape[0], self.high - base)
            out += [Part(path, offset, dtype, width, at, min(at + each, high), base) for at in range(low, high, each)]
            base += shape[0]
        return out or [Part("", 0, "f8", 1, 0, 0, 0)]

    def read(self, part: Part) -> Iterator[pa.RecordBatch]:
        if part.first >= part.last:
            return
        files, inner = store(part.path)
        dtype = np.dtype(part.dtype)
        with files.open_input_file(inner) as f:
            for at in range(part.first, part.last, ROWS):
                rows = min(ROWS, part.last - at)
                wide = dtype.itemsize * part.width
                values = np.frombuffer(f.read_at(rows * wide, part.offset + at * wide), dtype=dtype).astype("f8")
                column = pa.array(values) if self.flat else pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * part.width), pa.array(values))
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(at, at + rows) + part.base), column], names=["i", "value" if self.flat else "values"])


@dataclass
class Written(WriterCommitMessage):
    name: str
    rows: int


class Writer(DataSourceArrowWriter):
    """Each task writes a part of its own into this write's folder; commit() names the parts in the manifest, which it moves into place, so readers see all of a write or nothing.

    The folder is made before tasks start and by none of them: a task that is still writing when abort() has deleted it fails too, and leaves nothing.
    """

    def __init__(self, path: str, flat: bool, overwrite: bool, palette: str | None):
        self.path, self.flat, self.overwrite, self.palette, self.version = path, flat, overwrite, palette, uuid.uuid4().hex[:12]
        files, inner = store(path)
        files.create_dir(f"{inner}/write-{self.version}", recursive=True)

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        """A row's values must be as many as those of the other rows; a null value becomes NaN."""
        from pyspark import TaskContext

        task = TaskContext.get()
        held, width = [], None
        for batch in batches:
            column = batch.column("value" if self.flat else "values")
            if self.flat:
                held.append(column.cast(pa.float64()).to_numpy(zero_copy_only=False))
                continue
            if column.null_count:
                raise ValueError("a row without values cannot be written to an array")
            sizes = set(np.diff(np.asarray(column.offsets)).tolist())
            width = width if width is not None else next(iter(sizes), None)
            if sizes - {width}:
                raise ValueError("rows of different lengths cannot be written to one array")
            held.append(column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, width or 0))
        held = [h for h in held if len(h)]
        if not held:
            return Written("", 0)
        name = f"write-{self.version}/part-{task.partitionId():05d}-{task.taskAttemptId()}.npy"
        files, inner = store(self.path)
        rows = sum(map(len, held))
        with files.open_output_stream(f"{inner}/{name}") as out:
            np.lib.format.write_array_header_1_0(out, {"descr": "<f8", "fortran_order": False, "shape": (rows,) if self.flat else (rows, held[0].shape[1])})
            for h in held:
                out.write(np.ascontiguousarray(h, dtype="<f8").tobytes())
        return Written(name, rows)

    def commit(self, messages: list[Written | None]) -> None:
        files, inner = store(self.path)
        before = _manifest(files, inner) if not self.overwrite else None
        parts = (before or {"parts": []})["parts"] + [{"name": m.name, "rows": m.rows} for m in messages if m and m.rows]
        said = json.dumps({"parts": parts, "palette": json.loads(self.palette) if self.palette else (before or {}).get("palette")})
        with files.open_output_stream(f"{inner}/{MANIFEST}.{self.version}") as out:
            out.write(said.encode())
        files.move(f"{inner}/{MANIFEST}.{self.version}", f"{inner}/{MANIFEST}")

    def abort(self, messages: list[Written | None]) -> None:
        """Deletes the folder of this write, with the parts of tasks that failed before they could report theirs; again if a task put one there meanwhile."""
        files, inner = store(self.path)
        for left in (2, 1, 0):
            try:
                files.delete_dir(f"{inner}/write-{self.version}")
            except FileNotFoundError:
                return
            except OSError:
                if not left:
                    raise


def _manifest(files, inner: str) -> dict | None:
    from pyarrow import fs

    if files.get_file_info(f"{inner}/{MANIFEST}").type == fs.FileType.NotFound:
        return None
    with files.open_input_file(f"{inner}/{MANIFEST}") as f:
        return json.loads(f.read())


class NpySource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "npy"

    def files(self) -> list[tuple]:
        """(path, dtype, shape, first data byte) of every file, in order; headers are read on the driver."""
        from pyarrow import fs

        path = self.options["path"]
        files, inner = store(path)
        if files.get_file_info(inner).type == fs.FileType.File:
            names = [path]
        elif said := _manifest(files, inner):
            names = [f"{path.rstrip('/')}/{p['name']}" for p in said["parts"]]
        else:
            names = sorted(f"{path.rstrip('/')}/{e.base_name}" for e in files.get_file_info(fs.FileSelector(inner)) if e.base_name.endswith(".npy"))
        out = []
        for name in names:
            files, inner = store(name)
            with files.open_input_file(inner) as f:
                try:
                    dtype, shape, offset = header(lambda at, n, f=f: bytes(f.read_at(n, at)))
                except ValueError as e:
                    raise ValueError(f"{name}: {e}") from None
            out.append((name, dtype.str, shape, offset))
        return out

    def schema(self) -> str:
        files = self.files()
        return "i bigint, value double" if not files or len(files[0][2]) == 1 else "i bigint, values array<double>"

    def reader(self, schema) -> Reader:
        return Reader(self.files(), "value" in schema.names, int(self.options.get("bytes", RANGE)))

    def writer(self, schema, overwrite: bool) -> Writer:
        if {"value", "values"} & set(schema.names) == set():
            raise ValueError("a column value or values is needed")
        return Writer(self.options["path"], "value" in schema.names, overwrite, self.options.get("palette"))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(NpySource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def palette(path: str) -> dict | None:
    """The palette that the last write with one left: {name: colour}."""
    files, inner = store(path)
    return (_manifest(files, inner) or {}).get("palette")


def arrays(spark: SparkSession, path: str, size: int = RANGE) -> DataFrame:
    """spark.read of an array or a folder of them; size: bytes of a partition."""
    register(spark)
    return spark.read.format("npy").option("bytes", size).load(path)
