"""Markers in files of any size: every occurrence, found by one automaton over byte ranges, alone or together with the files' digests."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .readers import _binary, opened

#: Bytes that a task reads at a time, and bytes of a range.
CHUNK, RANGE = 8 << 20, 64 << 20


def variants(markers: Sequence[str], least: int = 4) -> list[bytes]:
    """Each marker of at least so many characters in UTF-8 and in little-endian UTF-16, sorted, each once."""
    return sorted({m.encode(code) for m in markers if len(m) >= least for code in ("utf-8", "utf-16le")})


def automaton(markers: Sequence[bytes]):
    """One automaton for all markers; bytes stand as the characters with their numbers."""
    import ahocorasick

    found = ahocorasick.Automaton()
    for marker in markers:
        if marker:
            found.add_word(marker.decode("latin-1"), marker)
    found.make_automaton()
    return found


def occurrences(read: Callable[[int, int], bytes], start: int, end: int, markers: Sequence[bytes], chunk: int = CHUNK, seen: Callable[[bytes], None] | None = None) -> Iterator[tuple[int, bytes]]:
    """(offset, marker) of all occurrences, also overlapping ones, that begin in bytes start to end - 1; ``read(offset, length)`` gives bytes.

    The automaton keeps its state from chunk to chunk, and reads on behind end by one byte less than the longest marker. seen gets every chunk up to end.
    """
    longest = max(map(len, markers), default=0)
    search = automaton(markers).iter("") if longest else None
    at, stop = start, end + max(longest - 1, 0)
    while at < stop:
        data = bytes(read(at, min(chunk, stop - at)))
        if not data:
            return
        if seen and at < end:
            seen(data[: end - at])
        if search:
            search.set(data.decode("latin-1"), at == start)
            for last, marker in search:
                # the iterator counts from the first chunk on
                begin = start + last - len(marker) + 1
                if begin < end:
                    yield begin, marker
        at += len(data)


def marker_hits(spark: SparkSession, path: str, markers: Sequence[bytes], pattern: str = "*", size: int = RANGE, chunk: int = CHUNK) -> DataFrame:
    """(path, offset, marker) of every occurrence of markers in files. A file is cut into ranges of ``size`` bytes, a row each, so many tasks read one large file."""
    found = list(dict.fromkeys(m for m in markers if m))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p, start, end in zip(*(batch.column(c).to_pylist() for c in ("path", "start", "end"))):
                with opened(p) as f:
                    hits = list(occurrences(lambda at, n, f=f: f.read_at(n, at), start, end, found, chunk))
                if hits:
                    yield pa.RecordBatch.from_arrays([pa.array([p] * len(hits)), pa.array([h[0] for h in hits]), pa.array([h[1] for h in hits], pa.binary())], names=["path", "offset", "marker"])

    files = _binary(spark, path, pattern).select("path", "length").where("length > 0")
    starts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("length") - 1, F.lit(size).cast("bigint"))).alias("start")
    ranges = files.select("path", "length", starts).select("path", "start", F.least(F.col("start") + size, "length").alias("end"))
    return ranges.repartition(F.col("path"), F.col("start")).mapInArrow(scan, "path string, offset bigint, marker binary")


def digest_and_scan(spark: SparkSession, path: str, markers: Sequence[bytes], pattern: str = "*", chunk: int = CHUNK) -> DataFrame:
    """(path, size, sha256, md5, clean, hits array<struct<offset, marker>>, changed) of files: digests and markers from one pass over a file in chunks, whatever its size.

    clean: no marker occurs. changed: the file's length was another one after the pass than before it, so that what is said of it does not hold. No markers: clean.
    """
    found = list(dict.fromkeys(m for m in markers if m))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.bool_(), pa.list_(pa.struct([("offset", pa.int64()), ("marker", pa.binary())])), pa.bool_()]
        for batch in batches:
            for p, length in zip(batch.column("path").to_pylist(), batch.column("length").to_pylist()):
                sha256, md5, size = hashlib.sha256(), hashlib.md5(usedforsecurity=False), [0]

                def seen(data: bytes) -> None:
                    sha256.update(data)
                    md5.update(data)
                    size[0] += len(data)

                with opened(p) as f:
                    hits = list(occurrences(lambda at, n: f.read_at(n, at), 0, length, found, chunk, seen))
                    after = f.size()
                row = (p, size[0], sha256.hexdigest(), md5.hexdigest(), not hits, [{"offset": a, "marker": m} for a, m in hits], not size[0] == length == after)
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, kinds)], names=["path", "size", "sha256", "md5", "clean", "hits", "changed"])

    return _binary(spark, path, pattern).select("path", "length").mapInArrow(scan, "path string, size bigint, sha256 string, md5 string, clean boolean, hits array<struct<offset:bigint,marker:binary>>, changed boolean")
