"""Token ids in compressed files with a shared dictionary and an index for reading single documents (operator 1).

File format: a Parquet table of blocks, in ascending order of ids of documents, and beside it a table with the one dictionary.
A block holds ``frames`` (zstandard frames one after another, one for each document, made with the shared dictionary),
``documents`` (for each frame its doc_id, its byte offset and length in ``frames`` and its number of ids), ``tokens_before``
(ids of all blocks before it in its file) and ``dictionary_hash``. Ids are little-endian unsigned integers of ``width`` bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._shared import shared_dir, slices
from ._tokens import encoder

#: Documents whose ids may train the dictionary, the longest text among them in characters, and the size of the dictionary: those
#: with the smallest hashes of their ids, and of those the ones that are not longer, so that a rerun takes the same ones.
TRAINING_DOCUMENTS = 1024
TRAINING_CHARACTERS = 20_000
DICTIONARY_BYTES = 64 << 10
#: Bytes of frames after which a block ends, and documents in it.
BLOCK_BYTES = 1 << 20
BLOCK_DOCUMENTS = 4096
LEVEL = 3

DOCUMENT = "struct<doc_id:bigint,offset:bigint,length:bigint,n_tokens:bigint>"
BLOCKS = f"part int, block int, dictionary_hash string, width int, tokens_before bigint, tokens bigint, documents array<{DOCUMENT}>, frames binary"


def _ids(path: str, end_id: int, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Slices of the batches and the ids of their documents, each with the end id."""
    e = encoder(path)
    for batch in slices(batches):
        ids, offsets = e.encode(batch.column("text").to_pylist())
        ids = np.insert(ids, offsets[1:], end_id)
        yield batch, np.split(ids, (offsets[1:] + np.arange(1, len(offsets)))[:-1])


def train_dictionary(docs: DataFrame, tokenizer: str, end_id: int) -> bytes:
    """A zstandard dictionary trained on the serialized ids of a bounded sample; without 8 samples or enough data, b""."""
    chosen = docs.where(F.col("doc_id").isNotNull()).select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAINING_DOCUMENTS)
    chosen = [r[0] for r in chosen.collect()]
    sample = docs.where(F.col("doc_id").isin(chosen) & (F.length("text") <= TRAINING_CHARACTERS))
    # one text for each id, as ids may repeat without bound
    sample = sample.groupBy("doc_id").agg(F.min("text").alias("text")).select("text")

    def serialize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, parts in _ids(tokenizer, end_id, batches):
            yield pa.RecordBatch.from_arrays([pa.array([p.tobytes() for p in parts], pa.binary())], names=["ids"])

    samples = [bytes(r[0]) for r in sample.mapInArrow(serialize, "ids binary").collect()]
    if len(samples) < 8:
        return b""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:  # too little data to train on
        return b""


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int, partitions: int | None = None) -> None:
    """Encodes every whole text of docs (doc_id, text; other columns are ignored) and writes the files to path.

    A document's ids are those of the tokenizers library without added special tokens, then end_id; a null text is empty and has
    the end id alone. Documents are written in ascending order of doc_id, null first; rows with equal ids keep any order.
    An empty table gives an empty table of blocks. partitions: files to write, else as many as the session shuffles to.
    """
    spark = docs.sparkSession
    dictionary = train_dictionary(docs, tokenizer, end_id)
    digest = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame([(digest, dictionary)], "dictionary_hash string, dictionary binary").coalesce(1).write.parquet(f"{path}/dictionary")
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, block, before = TaskContext.get().partitionId(), 0, 0
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        if shared:
            shared.precompute_compress(level=LEVEL)  # else each frame would digest the dictionary anew
        packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared)
        rows, frames, at, tokens, width = [], [], 0, 0, encoder(tokenizer).dtype.itemsize

        def close() -> pa.RecordBatch:
            row = {"part": part, "block": block, "dictionary_hash": digest, "width": width, "tokens_before": before, "tokens": tokens, "documents": rows, "frames": b"".join(frames)}
            return pa.RecordBatch.from_pylist([row], schema=SCHEMA)

        for batch, parts in _ids(tokenizer, end_id, batches):
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), parts):
                frame = packer.compress(ids.tobytes())
                rows.append({"doc_id": doc_id, "offset": at, "length": len(frame), "n_tokens": len(ids)})
                frames.append(frame)
                at, tokens = at + len(frame), tokens + len(ids)
                if at >= BLOCK_BYTES or len(rows) >= BLOCK_DOCUMENTS:
                    yield close()
                    block, before = block + 1, before + tokens
                    rows, frames, at, tokens = [], [], 0, 0
        if rows:
            yield close()

    # rows that share an id, or have none, are dealt out by number, so that no file need hold them all
    order = [F.col("doc_id").asc_nulls_first(), F.col("tie")]
    sorted_docs = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("tie")).repartitionByRange(n, *order).sortWithinPartitions(*order).select("doc_id", "text")
    # frames are compressed already; row groups of a few blocks let a reader fetch the one with its document
    blocks = sorted_docs.mapInArrow(compress, BLOCKS)
    blocks.write.option("compression", "none").option("parquet.block.size", 8 << 20).parquet(f"{path}/blocks")


_document = pa.struct([("doc_id", pa.int64()), ("offset", pa.int64()), ("length", pa.int64()), ("n_tokens", pa.int64())])
SCHEMA = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("dictionary_hash", pa.string()), ("width", pa.int32()), ("tokens_before", pa.int64()), ("tokens", pa.int64()), ("documents", pa.list_(_document)), ("frames", pa.binary())])


def _dictionary(spark: SparkSession, path: str) -> tuple[str, bytes]:
    digest, dictionary = spark.read.parquet(f"{path}/dictionary").first()
    if hashlib.sha256(dictionary).hexdigest() != digest:
        raise ValueError(f"the dictionary in {path} does not have the hash that is written beside it")
    return digest, bytes(dictionary)


def index(spark: SparkSession, path: str) -> DataFrame:
    """(part, block, doc_id, offset, length, n_tokens) of every document, without reading any frame."""
    return spark.read.schema(BLOCKS).parquet(f"{path}/blocks").select("part", "block", F.inline("documents"))


def read(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """(doc_id, start, n_tokens, ids) from the files: ids as little-endian unsigned 32-bit integers, start the ids of all documents before.

    doc_ids: only these documents; of their blocks only their frames are decompressed. A frame made with another dictionary is an error.
    """
    digest, dictionary = _dictionary(spark, path)
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    # one row a file: how many ids the files before it hold
    totals = blocks.groupBy("part").agg(F.sum("tokens").alias("n"))
    earlier = totals.withColumn("first", F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1))).select("part", F.coalesce("first", F.lit(0)).alias("first"))
    wanted = None if doc_ids is None else frozenset(doc_ids)
    if wanted is not None:
        blocks = blocks.where(F.exists("documents", lambda d: d.doc_id.isin(list(wanted))))

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
        for batch in batches:
            for row in range(batch.num_rows):  # a block is about a megabyte
                block = batch.slice(row, 1)
                if block.column("dictionary_hash")[0].as_py() != digest:
                    raise ValueError("a block was written with another dictionary")
                kind, frames = f"<u{block.column('width')[0].as_py()}", memoryview(block.column("frames")[0].as_buffer())
                start, out = block.column("tokens_before")[0].as_py() + block.column("first")[0].as_py(), []
                for d in block.column("documents")[0].as_py():
                    if wanted is None or d["doc_id"] in wanted:
                        ids = np.frombuffer(unpacker.decompress(frames[d["offset"] : d["offset"] + d["length"]]), dtype=kind).astype("<u4")
                        if len(ids) != d["n_tokens"]:
                            raise ValueError(f"document {d['doc_id']} has {len(ids)} ids; its index entry has {d['n_tokens']}")
                        out.append((d["doc_id"], start, len(ids), ids.tobytes()))
                    start += d["n_tokens"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * 4, TYPES)], names=["doc_id", "start", "n_tokens", "ids"])

    return blocks.join(F.broadcast(earlier), "part").mapInArrow(expand, "doc_id bigint, start bigint, n_tokens bigint, ids binary")


TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents encoded, written and read back: where each document's ids start, how many they are and their checksum."""
    import uuid

    import public_tokenizers

    path = f"{shared_dir(spark)}/token-files-{uuid.uuid4().hex[:12]}"
    write(spark.read.parquet(f"{sf_dir}/documents.parquet"), path, public_tokenizers.path("byte_bpe_50k.json"), 2)
    return read(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


__all__ = ["index", "op1_token_files", "read", "train_dictionary", "write"]
