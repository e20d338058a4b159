"""Document quality by attention-based multiple-instance learning (operator 8).

A document is a bag of passages of PASSAGE words. Each passage becomes a vector of character-class shares, word statistics and hashed words; a
learned layer encodes it, gated attention weighs it, and a logistic unit scores the weighted mean of the encoded passages. Only
documents carry labels; the attention is learned from them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._shared import discard, slices, stored, text_bytes
from ._words import LOWER, U, find, hashes

PASSAGE = 64
#: Hashed-word features; width of the encoding and of the attention.
WORDS, HIDDEN, GATE = 64, 24, 12
#: Labelled documents of each class that the model is fitted on at most, and their longest text: those with the smallest hashes of their ids among the ones that are not longer.
TRAINING_DOCUMENTS = 1500
TRAINING_CHARACTERS = 50_000
STEPS, RATE, DECAY = 300, 0.02, 1e-4
HELD_OUT = 5

#: Characters 0 to 127 by what they are: each ASCII punctuation mark for itself, then lower, upper, digit, white space, control, beyond ASCII.
_KINDS = np.full(256, 37, dtype=np.int64)
_marks = [c for c in range(33, 127) if not chr(c).isalnum()]
_KINDS[_marks] = np.arange(len(_marks))
_KINDS[97:123], _KINDS[65:91], _KINDS[48:58], _KINDS[[9, 10, 11, 12, 13, 32]], _KINDS[[*range(9), *range(14, 32), 127]] = 32, 33, 34, 35, 36
KINDS = 38
FEATURES = KINDS + 6 + WORDS


def passages(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A row of FEATURES for every passage, and n + 1 offsets of the texts into the rows; a text without words has one row of zeros."""
    data, offsets = text_bytes(column)
    starts, ends, first = find(data, offsets)
    count = np.diff(first)
    rows = np.maximum(1, -(-count // PASSAGE))
    bounds = np.concatenate([[0], np.cumsum(rows)])
    n = int(bounds[-1])
    word_row = np.repeat(bounds[:-1], count) + (np.arange(len(starts)) - np.repeat(first[:-1], count)) // PASSAGE
    length = ends - starts
    # bytes from a word's start to the next word of its text go with the word
    byte_row = np.repeat(word_row, np.diff(np.append(starts, len(data)))) if len(starts) else np.zeros(0, np.int64)
    shares = np.bincount(byte_row * KINDS + _KINDS[data[starts[0] :]], minlength=n * KINDS).reshape(n, KINDS) if len(starts) else np.zeros((n, KINDS))
    size = np.maximum(1, shares.sum(axis=1, keepdims=True))
    word = hashes(LOWER[data], starts, ends)
    words = np.maximum(1, np.bincount(word_row, minlength=n))
    same = np.concatenate([[False], (word[1:] == word[:-1]) & (word_row[1:] == word_row[:-1])]) if len(word) else np.zeros(0, bool)
    order = np.lexsort((word, word_row))
    fresh = np.concatenate([[True], (word[order][1:] != word[order][:-1]) | (word_row[order][1:] != word_row[order][:-1])]) if len(word) else np.zeros(0, bool)
    distinct = np.bincount(word_row[order][fresh], minlength=n)
    last = _KINDS[data[ends - 1]] if len(ends) else np.zeros(0, np.int64)
    mean = np.bincount(word_row, length, n) / words
    extra = np.stack([
        np.bincount(word_row, same, n) / words, distinct / words, np.minimum(mean, 40) / 10,
        np.bincount(word_row, last < 32, n) / words, np.bincount(word_row, length == 1, n) / words, np.minimum(words, PASSAGE) / PASSAGE,
    ], axis=1)
    bag = np.bincount(word_row * WORDS + (word % U(WORDS)).astype(np.int64), minlength=n * WORDS).reshape(n, WORDS)
    out = np.concatenate([np.sqrt(shares / size), extra, np.sqrt(bag / words[:, None])], axis=1)
    out[np.repeat(count == 0, rows)] = 0
    return out, bounds


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    encode: np.ndarray
    bias: np.ndarray
    tanh: np.ndarray
    gate: np.ndarray
    attend: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    LEARNED = ("encode", "bias", "tanh", "gate", "attend", "out", "out_bias")

    def normal(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) / self.scale

    def forward(self, x: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
        """Scores of bags x[bounds[i] : bounds[i + 1]] of normal() passages, and what the gradient needs."""
        h = np.tanh(x @ self.encode + self.bias)
        t, g = np.tanh(h @ self.tanh), 1 / (1 + np.exp(-(h @ self.gate)))
        e = (t * g) @ self.attend
        bag = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        e = np.exp(e - np.maximum.reduceat(e, bounds[:-1])[bag])
        a = e / np.add.reduceat(e, bounds[:-1])[bag]
        z = np.add.reduceat(a[:, None] * h, bounds[:-1], axis=0)
        score = 1 / (1 + np.exp(-np.clip(z @ self.out + self.out_bias, -40, 40)))
        return {"h": h, "t": t, "g": g, "a": a, "z": z, "bag": bag, "score": score}

    def gradient(self, x: np.ndarray, bounds: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        """Of the cross-entropy of bags of normal() passages with labels y, each times its weight, by each learned array."""
        f = self.forward(x, bounds)
        h, t, g, a, bag = (f[k] for k in ("h", "t", "g", "a", "bag"))
        d = weight * (f["score"] - y)
        dz = d[:, None] * self.out
        da = np.einsum("ij,ij->i", dz[bag], h)
        de = a * (da - np.add.reduceat(a * da, bounds[:-1])[bag])
        dt, dg = de[:, None] * self.attend * g * (1 - t * t), de[:, None] * self.attend * t * g * (1 - g)
        dh = (a[:, None] * dz[bag] + dt @ self.tanh.T + dg @ self.gate.T) * (1 - h * h)
        return {"out": f["z"].T @ d, "out_bias": np.array([d.sum()]), "attend": (t * g).T @ de, "tanh": h.T @ dt, "gate": h.T @ dg, "encode": x.T @ dh, "bias": dh.sum(axis=0)}


def started(mean: np.ndarray, scale: np.ndarray, kind: type = np.float32) -> Model:
    """A model before its first step."""
    r = np.random.default_rng(8)
    draw = lambda *shape: (r.standard_normal(shape) / np.sqrt(shape[0])).astype(kind)
    return Model(mean, scale, draw(FEATURES, HIDDEN), np.zeros(HIDDEN, kind), draw(HIDDEN, GATE), draw(HIDDEN, GATE), draw(GATE), draw(HIDDEN), np.zeros(1, kind))


def fit(x: np.ndarray, bounds: np.ndarray, y: np.ndarray) -> Model:
    """A model for bags with labels 0 or 1, by Adam on the mean cross-entropy with both classes weighing the same; all in single precision."""
    m = started(x.mean(axis=0, dtype=np.float64).astype(np.float32), (x.std(axis=0, dtype=np.float64) + 1e-3).astype(np.float32))
    x = m.normal(x)
    weight = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum())).astype(np.float32)
    first, second = ({k: np.zeros_like(getattr(m, k)) for k in Model.LEARNED} for _ in range(2))
    for step in range(1, STEPS + 1):
        for k, v in m.gradient(x, bounds, y, weight).items():
            p = getattr(m, k)
            v = v + np.float32(DECAY) * p
            first[k] = np.float32(0.9) * first[k] + np.float32(0.1) * v
            second[k] = np.float32(0.999) * second[k] + np.float32(0.001) * v * v
            p -= np.float32(RATE) * (first[k] / np.float32(1 - 0.9**step)) / (np.sqrt(second[k] / np.float32(1 - 0.999**step)) + np.float32(1e-8))
    return m


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """Whether crc32 of the id as text leaves no remainder by HELD_OUT; a null id is not held out."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % HELD_OUT == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame) -> Model | None:
    """A model fitted on labelled documents (labels: doc_id, quality) that are not held out; None without documents of both classes."""
    usable = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out()).select("doc_id", "quality").groupBy("doc_id").agg(F.min("quality").alias("a"), F.max("quality").alias("quality")).where("a = quality")
    order = F.xxhash64("doc_id", F.lit(8))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where(F.length("text") <= TRAINING_CHARACTERS)
    usable = stored(texts.select("doc_id").join(usable.select("doc_id", F.col("quality").cast("int").alias("quality")), "doc_id").distinct(), "labelled")
    # at most 2 * TRAINING_DOCUMENTS ids and their passages come to the driver: one text for each id, as ids may repeat without bound
    chosen = {r[0]: r[1] for c in (0, 1) for r in usable.where(F.col("quality") == c).orderBy(order, "doc_id").limit(TRAINING_DOCUMENTS).collect()}
    discard(usable)
    if len(set(chosen.values())) < 2:
        return None
    ids = F.broadcast(docs.sparkSession.createDataFrame([(k,) for k in chosen], "doc_id bigint"))
    sample = texts.join(ids, "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            x, bounds = passages(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([x[a:b].astype("<f4").tobytes() for a, b in zip(bounds[:-1], bounds[1:])], pa.binary())], names=["doc_id", "x"])

    rows = sorted((r[0], bytes(r[1])) for r in sample.mapInArrow(encode, "doc_id bigint, x binary").collect())
    if len({chosen[k] for k, _ in rows}) < 2:
        return None
    y = np.array([chosen[k] for k, _ in rows], dtype=np.float32)
    lengths = [len(v) // (4 * FEATURES) for _, v in rows]
    x = np.frombuffer(b"".join(v for _, v in rows), dtype="<f4").reshape(-1, FEATURES)
    return fit(x, np.concatenate([[0], np.cumsum(lengths)]), y)


def _scores(model: Model, column: pa.Array) -> np.ndarray:
    x, bounds = passages(column)
    return model.forward(model.normal(x), bounds)["score"].astype(np.float64)


def score(docs: DataFrame, model: Model | None, carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The columns of docs named in carry, and score (double, 0 to 1): higher where label 1 is likelier; without a model 1.

    Every passage of the whole text counts; nothing but the text does. A null text is empty; empty texts have a score too. Repeated rows have the
    same score, an empty table no rows.
    """
    # the carried columns travel as one struct, so that no name of theirs can clash
    rows = docs.select(F.struct(*carry).alias("row"), F.col("text").cast("string").alias("text"))
    if model is None:
        return rows.select("row.*", F.lit(1.0).alias("score"))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(_scores(model, batch.column("text")))], names=["row", "score"])

    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(each, f"row {kind}, score double").select("row.*", "score")


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by a model of labels.quality that has not seen the held-out fold."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model).select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
