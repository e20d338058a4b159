"""Repeated byte strings by a sorted suffix array in ranges (operator 13).

A window is ``length`` bytes of one text; all of its bytes go if the same window starts earlier. Sorting a suffix for every byte would ship each text many times over, so
suffixes are sampled by content first: in every window the leftmost ANCHOR-byte gram with the smallest hash is its anchor, so equal windows have equal anchors at
equal places, and the windows of one anchor follow one another; the bytes that they reach are the anchor's stretch.

1. Anchors that occur once cannot repeat. Where equal stretches occur, all but the first go as a whole, without being sorted.
2. The first stretch of each kind, where an anchor has several kinds, goes with its bytes to a range of the suffix order: sampled splitters cut the order of the suffixes that
   start at the anchors by their leading bytes, between anchors unless one anchor alone fills a range. Each range sorts the suffixes at all of its windows by multikey quicksort, 8 bytes at a time and only among windows
   that are equal so far, and neighbours that agree over ``length`` bytes are one group, of which the first stays.
3. An anchor so common that several ranges share it stands at their edges; what is left of its windows is compared across the boundaries by the bytes themselves.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ._shared import PART_ROWS, PARTS, discard, made, slices, stored, sweep, text_bytes
from ._words import U, mix
from .substrings import leftmost_minimum

#: Bytes in an anchor; a multiple of 8 that is a power of two.
ANCHOR = 32
#: Bytes of a suffix, from its anchor on, by which ranges are cut; more of the same are cut by their stretches' hashes.
LEADING = 48
#: Bytes of text that are hashed at a time; a longer text is taken in overlapping pieces. Anchors that are compared at a time before they are shuffled.
PIECE, CHUNK = 1 << 19, 1 << 19
#: Documents, about, whose anchors show which are very common; rows of suffixes that a range should have, and rows that are drawn for each splitter.
SAMPLE, RANGE_ROWS, DRAWN = 2000, 20_000, 10
NO_ID = (1 << 63) - 1

Arrays = dict[str, np.ndarray]


def _eights(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each byte on as one little-endian number, zeros beyond the end."""
    padded = np.zeros(len(data) + 8, dtype=np.uint8)
    padded[: len(data)] = data
    return np.ndarray((len(data),), dtype="<u8", buffer=padded.data, strides=(1,))


def _pieces(batch: pa.RecordBatch, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """(rows, bytes, n + 1 offsets, first byte) of the texts of a slice; a long text comes in pieces that share length - 1 bytes, so each window is in one."""
    data, offsets = text_bytes(batch.column("text"))
    if batch.num_rows > 1 or len(data) <= PIECE:
        yield np.arange(batch.num_rows), data, offsets, 0
        return
    for at in range(0, max(len(data) - length + 1, 1), PIECE):
        part = data[at : at + PIECE + length - 1]
        yield np.zeros(1, dtype=np.int64), part, np.array([0, len(part)]), at


def _anchors(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """For each run of windows with one anchor: text, first byte, number of windows, anchor's distance from the first byte, hashes of the anchor and of the stretch."""
    left = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(len(data))
    begin = np.flatnonzero(left >= length)
    if not len(begin):
        return (begin,) * 6
    whole = {8: mix(_eights(data).copy(), 11)}
    width = 8
    while 2 * width <= length:
        below = whole[width]
        whole[2 * width] = mix(mix(below[:-width], 12) + below[width:], 13)
        width *= 2
    grams = whole[ANCHOR]
    anchor = leftmost_minimum(grams[: len(data) - ANCHOR + 1], length - ANCHOR + 1)[begin]
    new = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (begin[1:] != begin[:-1] + 1)]))
    n = np.diff(np.append(new, len(begin)))
    begin, anchor = begin[new], anchor[new]
    # a stretch is covered by grams of `width` bytes, the last one moved back to its end
    size, stretch = n - 1 + length, mix((n * 4096 + anchor - begin).astype(U), 14)
    for done in range(0, int(size.max()), width):
        some = np.flatnonzero(size > done)
        at = begin[some] + np.minimum(done, size[some] - width)
        stretch[some] = mix(stretch[some] + mix(whole[width][at], 15), 16)
    return np.searchsorted(offsets, begin, side="right") - 1, begin, n, anchor - begin, grams[anchor], stretch


def _columns(batches: Sequence[pa.RecordBatch], names: Sequence[str]) -> Arrays:
    return {name: np.concatenate([np.asarray(b.column(name)) for b in batches]) for name in names}


def _earliest(columns: Arrays) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order by anchor, stretch and place; which rows of it begin a new anchor or stretch, and which are alike in place to the first of their stretch."""
    order = np.lexsort([columns[c] for c in ("at", "sub", "id", "stretch", "seed")])
    seed, stretch = columns["seed"][order], columns["stretch"][order]
    new = np.concatenate([[True], (seed[1:] != seed[:-1]) | (stretch[1:] != stretch[:-1])]) if len(order) else np.zeros(0, bool)
    first = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    same = np.ones(len(order), dtype=bool)
    for c in ("id", "sub", "at"):
        values = columns[c][order]
        same &= values == values[first]
    return order, new, same


ANCHOR_ROW = "home bigint, seed bigint, stretch bigint, id bigint, sub bigint, at int, n short, lead short"
FIELDS = ["seed", "stretch", "id", "sub", "at", "n", "lead"]


def anchors(docs: DataFrame, length: int, common: Sequence[int] = ()) -> DataFrame:
    """ANCHOR_ROW for docs (id, sub, text). home: rows with equal ones belong together. Rows that repeat one before them in the same chunk have lead -1 and any home.

    common: anchors that very many texts have; each kind of their stretches has a home of its own.
    """
    frequent = np.sort(np.array(common, dtype=np.int64))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in slices(batches, most=PIECE):
            ids, subs = np.asarray(batch.column("id")), np.asarray(batch.column("sub"))
            for rows, data, offsets, base in _pieces(batch, length):
                doc, begin, n, lead, seed, stretch = _anchors(data, offsets, length)
                if not len(begin):
                    continue
                row = rows[doc]
                held.append((seed.view(np.int64), stretch.view(np.int64), ids[row], subs[row], (begin - offsets[doc] + base).astype(np.int32), n.astype(np.int16), lead.astype(np.int16)))
                size += len(begin)
                if size >= CHUNK:
                    yield combined(held)
                    held, size = [], 0
        if held:
            yield combined(held)

    def combined(held: list) -> pa.RecordBatch:
        c = dict(zip(FIELDS, map(np.concatenate, zip(*held))))
        order, _, same = _earliest(c)
        c = {k: v[order] for k, v in c.items()}
        c["lead"] = np.where(same, c["lead"], -1).astype(np.int16)
        own = ~same | (np.isin(c["seed"], frequent) if len(frequent) else False)
        spread = mix(c["stretch"].view(U) ^ np.where(same, 0, mix(c["id"].view(U) + c["at"].astype(U), 17)).astype(U), 18)
        home = np.where(own, spread.view(np.int64), c["seed"])
        return pa.RecordBatch.from_arrays([pa.array(home), *(pa.array(c[k]) for k in FIELDS)], names=["home", *FIELDS])

    return docs.mapInArrow(pick, ANCHOR_ROW)


def candidates(homes: DataFrame, common: Sequence[int] = ()) -> DataFrame:
    """Of anchors() with equal homes in one partition: stretches to go as a whole (lead -1), and the first of each kind where an anchor has several kinds."""
    frequent = np.sort(np.array(common, dtype=np.int64))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]  # one partition of anchors, a few longs each
        if not held:
            return
        c = _columns(held, FIELDS)
        gone = c["lead"] < 0
        rest = {k: v[~gone] for k, v in c.items()}
        order, new, same = _earliest(rest)
        rest = {k: v[order] for k, v in rest.items()}
        edges = np.flatnonzero(np.concatenate([[True], rest["seed"][1:] != rest["seed"][:-1]])) if len(order) else order
        sizes = np.diff(np.append(edges, len(order)))
        several = np.repeat(np.add.reduceat(new.astype(np.int64), edges) > 1 if len(edges) else edges, sizes).astype(bool)
        if len(frequent):
            several |= np.isin(rest["seed"], frequent)
        rest["lead"] = np.where(same, rest["lead"], -1).astype(np.int16)
        stays = ~same | several
        out = [np.concatenate([c[k][gone], rest[k][stays]]) for k in FIELDS[2:]]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], names=FIELDS[2:])

    return homes.mapInArrow(judge, "id bigint, sub bigint, at int, n short, lead short")


def suffixes(texts: DataFrame, length: int) -> DataFrame:
    """(leading, id, sub, at, n, lead, bytes) for texts (id, sub, text, wanted array<struct<at, n, lead>>): the bytes of each stretch that is wanted.

    leading: the first bytes of the suffix at its anchor, and a hash of the stretch, which tells apart suffixes that agree over LEADING bytes.
    """

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()  # rows alike in id and text lie in one partition; one of them is enough
        for batch in slices(batches):
            out = []
            for i, s, text, wanted in zip(*(batch.column(c).to_pylist() for c in ("id", "sub")), batch.column("text").cast(pa.binary()).to_pylist(), batch.column("wanted").to_pylist()):
                if (i, s) in seen:
                    continue
                seen.add((i, s))
                for w in wanted:
                    at, n, lead = w["at"], w["n"], w["lead"]
                    part = text[at : at + n - 1 + length]
                    out.append((part[lead : lead + LEADING], i, s, at, n, lead, part))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int16(), pa.int16(), pa.binary()))], names=["leading", "id", "sub", "at", "n", "lead", "bytes"])

    return texts.mapInArrow(take, "leading binary, id bigint, sub bigint, at int, n short, lead short, bytes binary").withColumn("leading", F.concat("leading", F.unhex(F.lpad(F.hex(F.xxhash64("bytes")), 16, "0"))))


def splitters(kinds: DataFrame, ranges: int, rows: int) -> tuple[list[bytes], set[bytes]]:
    """At most ranges - 1 keys, from a sample of DRAWN rows for each, that cut the order of leading evenly, and the anchors that they cut."""
    if ranges < 2:
        return [], set()
    drawn = sorted(bytes(r[0]) for r in kinds.select("leading").sample(min(1.0, DRAWN * ranges / rows), seed=1).collect())
    keys = drawn[DRAWN::DRAWN]
    heads = [k[:ANCHOR] for k in keys]
    # an anchor at which only one key stands moves on whole to the range after it
    inside = [i > 0 and heads[i - 1] == h for i, h in enumerate(heads)]
    return sorted({k if cut else k[:ANCHOR] for k, cut in zip(keys, inside)}), {h for h, cut in zip(heads, inside) if cut}


def ranged(kinds: DataFrame, cuts: list[bytes]) -> DataFrame:
    """kinds with each range of their order in one partition."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.append_column("range", pa.array([bisect_right(cuts, k) for k in batch.column("leading").to_pylist()], pa.int32()))

    schema = StructType([*kinds.schema.fields, StructField("range", IntegerType())])
    return kinds.mapInArrow(place, schema).repartitionById(len(cuts) + 1, F.col("range"))


def equal_windows(data: np.ndarray, starts: np.ndarray, group: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Multikey quicksort of the suffixes at starts inside groups, as far as ``length`` bytes. Gives the order of those that equal a neighbour, and the number of their run."""
    eights = _eights(np.concatenate([data, np.zeros(8, np.uint8)]))
    order = np.argsort(group, kind="stable")
    group = group[order]
    for depth in range(0, length, 8):
        # only windows that are equal to others so far are looked at again
        alone = np.ones(len(order), dtype=bool)
        alone[1:] &= group[1:] != group[:-1]
        alone[:-1] &= group[1:] != group[:-1]
        order, group = order[~alone], group[~alone]
        if not len(order):
            break
        token = eights[starts[order] + depth].byteswap()  # in the order of bytes
        if length - depth < 8:
            token = token >> U(8 * (8 - length + depth))
        by = np.lexsort((token, group))
        order, group, token = order[by], group[by], token[by]
        group = np.cumsum(np.concatenate([[0], (group[1:] != group[:-1]) | (token[1:] != token[:-1])]))
    alone = np.ones(len(order), dtype=bool)
    alone[1:] &= group[1:] != group[:-1]
    alone[:-1] &= group[1:] != group[:-1]
    return order[~alone], group[~alone]


FOUND = "id bigint, sub bigint, at int, n int, window binary"


def sort_ranges(ranges: DataFrame, shared: set[bytes], length: int) -> DataFrame:
    """FOUND for ranged(): runs of windows that go (window null), and the windows left of anchors that several ranges share."""

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]  # one range of suffixes
        if not held:
            return
        c = _columns(held, ["id", "sub", "at", "n", "lead"])
        text = pa.chunked_array([b.column("bytes") for b in held]).combine_chunks()
        data, offsets = text_bytes(text)
        n, lead, first = c["n"].astype(np.int64), c["lead"].astype(np.int64), offsets[:-1]
        # the suffixes at the anchors, sorted as far as the anchor reaches; equal ones have equal numbers
        tokens = _eights(data)
        keys = [tokens[first + lead + i].byteswap() for i in range(ANCHOR - 8, -8, -8)]
        by = np.lexsort(keys)
        new = np.zeros(len(by), dtype=bool)
        for k in keys:
            new[1:] |= k[by][1:] != k[by][:-1]
        anchor = np.empty(len(by), dtype=np.int64)
        anchor[by] = np.cumsum(new)
        edge = np.zeros(len(by), dtype=bool)
        for i in np.flatnonzero(np.concatenate([[True], new[1:]])) if shared else ():
            begin = first[by[i]] + lead[by[i]]
            if data[begin : begin + ANCHOR].tobytes() in shared:
                edge |= anchor == anchor[by[i]]
        # a suffix for every window: those of one anchor whose anchor is as far away can be equal
        row = np.repeat(np.arange(len(n)), n)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        start = first[row] + nth
        order, run = equal_windows(data, start, anchor[row] * 4096 + lead[row] - nth, length)
        place = np.lexsort((c["at"][row[order]] + nth[order], c["sub"][row[order]], c["id"][row[order]], run))
        order, run = order[place], run[place]
        where = [c["id"][row[order]], c["sub"][row[order]], c["at"][row[order]] + nth[order]]
        head = np.maximum.accumulate(np.where(np.concatenate([[True], run[1:] != run[:-1]]) if len(run) else np.zeros(0, bool), np.arange(len(run)), 0))
        later = np.zeros(len(run), dtype=bool)
        for x in where:
            later |= x != x[head]
        gone = np.zeros(len(row), dtype=bool)
        gone[order[later]] = True
        # runs of windows that go
        begins = np.flatnonzero(gone & ~np.concatenate([[False], gone[:-1] & (row[1:] == row[:-1])]))
        ends = np.flatnonzero(gone & ~np.concatenate([gone[1:] & (row[1:] == row[:-1]), [False]]))
        if len(begins):
            yield found(c, row[begins], nth[begins], ends - begins + 1, pa.nulls(len(begins), pa.binary()))
        # kinds of windows that another range may have too; of rows alike one is enough
        left = np.flatnonzero(edge[row] & ~gone)
        for at in range(0, len(left), 10_000):
            some = left[at : at + 10_000]
            yield found(c, row[some], nth[some], np.ones(len(some)), pa.array([data[s : s + length].tobytes() for s in start[some]], pa.binary()))

    def found(c: Arrays, row: np.ndarray, nth: np.ndarray, n: np.ndarray, window: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c["id"][row]), pa.array(c["sub"][row]), pa.array((c["at"][row] + nth).astype(np.int32)), pa.array(n.astype(np.int32)), window], names=["id", "sub", "at", "n", "window"])

    return ranges.mapInArrow(sort, FOUND)


def cut(docs: DataFrame, length: int) -> DataFrame:
    """docs (row, text, repeats array<struct<at, n>>): row, number of bytes, spans of the windows that go, and the bytes outside them."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = []
            for text, repeats in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("repeats").to_pylist()):
                text, spans = text or b"", []
                for at, n in sorted((r["at"], r["n"]) for r in repeats or ()):
                    if spans and at <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], at + n - 1 + length)
                    else:
                        spans.append([at, at + n - 1 + length])
                kept = b"".join(text[a:b] for a, b in zip([0, *(b for _, b in spans)], [*(a for a, _ in spans), len(text)]))
                out.append((len(text), [{"begin": a, "end": b} for a, b in spans], len(text) - len(kept), kept))
            yield pa.RecordBatch.from_arrays([batch.column("row"), *(pa.array(x, t) for x, t in zip(zip(*out), OUT))], names=["row", "n_bytes", "spans", "n_removed", "kept"])

    row = docs.schema["row"].dataType.simpleString()
    return docs.mapInArrow(each, f"row {row}, n_bytes bigint, spans array<struct<begin:bigint,end:bigint>>, n_removed bigint, kept binary")


OUT = [pa.int64(), pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])), pa.int64(), pa.binary()]


def numbered(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """docs with id and sub, and a stored table that it reads; by which texts are ordered: id is doc_id or, if null, NO_ID; sub is 0, or the text's hash where ids are null or repeat."""
    again = stored(docs.where("doc_id is not null").groupBy(F.col("doc_id").cast("bigint").alias("again")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("again"), "ids")
    known, unsure = F.col("doc_id").cast("bigint"), F.lit(False)
    if again.take(1):
        docs = docs.join(again, known == F.col("again"), "left")
        unsure = F.col("again").isNotNull()
    sub = F.when(known.isNull() | unsure, F.xxhash64(F.coalesce("text", F.lit("")))).otherwise(F.lit(0).cast("bigint"))
    return docs.withColumns({"id": F.coalesce(known, F.lit(NO_ID)), "sub": sub}), again


def later_repeats(docs: DataFrame, length: int = 100, carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The columns named in carry, n_bytes, spans, n_removed and kept for every row of docs (doc_id, text and those of carry).

    Texts are taken as UTF-8 bytes. spans: the maximal stretches [begin, end) of bytes that are covered by strings of ``length`` bytes which also start earlier: in a text
    with a smaller doc_id, or before in the same text; the first place of every string stays. kept: the bytes outside spans, which may part a character.

    A null or empty text has no bytes. Texts without an id come last, and these and texts that share an id are ordered by a hash of the text, the same in every run; rows
    alike in id and text are one text: each keeps and loses the same bytes. An empty table gives no rows. length: from 64 to 255 bytes. Stretches that are taken as
    equal without being sorted have equal 64-bit hashes of their anchors and of all their bytes.
    """
    if not 2 * ANCHOR <= length <= 255:
        raise ValueError(f"length must be from {2 * ANCHOR} to 255 bytes")
    since, spark = made(), docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs, again = numbered(docs.select(F.struct(*carry).alias("row"), "doc_id", "text"))
    docs = docs.select("row", "text", "id", "sub")
    long = docs.where(F.octet_length("text") >= length)

    # a bounded sample shows which anchors are common; it only decides how evenly tasks are filled
    rows = docs.count()
    sample = long.where(F.pmod(F.xxhash64("id", "sub"), F.lit(max(1, rows // SAMPLE))) == 0)
    common = anchors(sample.select("id", "sub", "text"), length).where("lead >= 0").groupBy("seed").agg(F.countDistinct("stretch").alias("k")).where("k > 20")
    common = [r[0] for r in common.orderBy(F.desc("k")).limit(PARTS).collect()]
    homes = anchors(long.select("id", "sub", "text"), length, common).repartition(n, "home")
    found = stored(candidates(homes, common), "candidates", tidy=True)

    # both joins with the texts read one and the same shuffle of them; a text that very many rows hold is dealt out
    most = max(PART_ROWS, rows // PARTS)
    hot = long.groupBy("id", "sub").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most).select("id", "sub", F.ceil(F.col("n") / most).cast("int").alias("parts"))
    hot = F.broadcast(spark.createDataFrame(hot.collect(), hot.schema))  # PARTS at most
    part = F.pmod(F.monotonically_increasing_id(), F.coalesce("parts", F.lit(1)).cast("bigint"))
    texts = long.join(hot, ["id", "sub"], "left").withColumn("part", part).drop("parts").repartition(n, "id", "sub", "part")
    dealt = lambda table: table.join(hot, ["id", "sub"], "left").withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("parts", F.lit(1)).cast("bigint") - 1))).drop("parts").hint("shuffle_hash")
    wanted = found.where("lead >= 0").groupBy("id", "sub").agg(F.collect_set(F.struct("at", "n", "lead")).alias("wanted"))
    kinds = stored(suffixes(texts.join(dealt(wanted), ["id", "sub", "part"]).select("id", "sub", "text", "wanted"), length), "suffixes", tidy=True)
    rows = kinds.count()
    cuts, shared = splitters(kinds, min(rows // RANGE_ROWS + 1, 4 * n), rows)
    judged = stored(sort_ranges(ranged(kinds, cuts), shared, length), "ranges", tidy=True)
    discard(kinds)
    left = judged.where("window is not null")
    firsts = left.groupBy("window").agg(F.min(F.struct("id", "sub", "at")).alias("first"), F.max(F.struct("id", "sub", "at")).alias("last")).where("first != last").select("window", "first")
    across = left.join(firsts, "window").where(F.struct("id", "sub", "at") != F.col("first")).select("id", "sub", "at", "n")
    gone = found.where("lead < 0").select("id", "sub", "at", F.col("n").cast("int").alias("n")).unionAll(judged.where("window is null").select("id", "sub", "at", "n")).unionAll(across)
    repeats = gone.groupBy("id", "sub").agg(F.collect_set(F.struct("at", "n")).alias("repeats"))
    sweep(since, found, judged, again)
    whole = texts.join(dealt(repeats), ["id", "sub", "part"], "left").select("row", "text", "repeats")
    short = docs.where(F.coalesce(F.octet_length("text"), F.lit(0)) < length).select("row", "text", F.lit(None).cast(repeats.schema["repeats"].dataType).alias("repeats"))
    return cut(whole.unionAll(short), length).select("row.*", "n_bytes", "spans", "n_removed", "kept")


def op13_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents without the bytes of each 100-byte string that starts earlier."""
    found = later_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


OP13_SQL = """
WITH bytes AS (SELECT doc_id, encode(coalesce(text, '')) AS t, hex(encode(coalesce(text, ''))) AS b FROM documents),
starts AS (SELECT doc_id, t, unnest(range(length(b) // 2 - 99)) AS pos FROM bytes WHERE length(b) >= 200),
again AS (
  SELECT doc_id, pos FROM (SELECT doc_id, pos, row_number() OVER (PARTITION BY array_slice(t, pos + 1, pos + 100) ORDER BY doc_id, pos) AS nth FROM starts) WHERE nth > 1
),
runs AS (
  SELECT doc_id, pos, sum(new) OVER (PARTITION BY doc_id ORDER BY pos) AS run
  FROM (SELECT doc_id, pos, CASE WHEN pos - lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) <= 100 THEN 0 ELSE 1 END AS new FROM again)
),
spans AS (SELECT doc_id, min(pos) AS a, max(pos) + 100 AS e FROM runs GROUP BY doc_id, run),
kept AS (
  SELECT doc_id, b, a, e, lag(e, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS since FROM bytes JOIN spans USING (doc_id)
),
cut AS (
  SELECT doc_id, any_value(b) AS b, sum(e - a) AS gone, count(*) AS n, max(e) AS last, string_agg(substr(b, 2 * since + 1, 2 * (a - since)), '' ORDER BY a) AS front FROM kept GROUP BY doc_id
)
SELECT doc_id, length(bytes.b) // 2 AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed, coalesce(n, 0) AS n_spans,
       sha256(unhex(coalesce(front || substr(bytes.b, 2 * last + 1), bytes.b))) AS kept_sha256
FROM bytes LEFT JOIN cut USING (doc_id)
"""
