"""Manifest, importance resampling and suffix-array deduplication against plain versions of the same."""

import random
import zlib

import duckdb
import numpy as np
import pytest
from brute import later_bytes, merkle, resample
from pyspark.sql import functions as F

from tallyloom.llm import suffixes
from tallyloom.llm.merkle import fold, merkle_manifest, op11_merkle_manifest
from tallyloom.llm.resampling import combine, importance_resample, op12_importance_resampling, word_crcs
from tallyloom.llm.queries import ORACLE_SQL, QUERIES
from tallyloom.llm.suffixes import equal_windows, later_repeats, op13_suffix_array_dedup

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def table(n=230, seed=5):
    r = random.Random(seed)
    words = ["alpha", "Beta,", "gamma's", "delta", "übung", "12", "epsilon.", "zeta", "日本語", "O'Neil"]
    text = lambda k: " ".join(r.choice(words) + r.choice(["", "", str(r.randrange(9))]) for _ in range(k))
    base, passage = text(150), text(30)
    out = []
    for i in range(n):
        t = r.choice([text(r.choice([0, 3, 25, 60])), base, base[: r.randrange(400)] + text(3) + base[r.randrange(400) :], text(4) + " " + passage + " " + text(2), passage])
        out.append((i * 3 + r.randrange(3), t, r.choice(["en", "en", "en", "de", None, ""]), r.choice(["web", None]), len(t)))
    return out + [(5000, None, "xx", None, None), (5001, "", "yy", "web", 0), (5002, "x" * 5000 + " word", "en", "web", 5005)]


def saved(spark, path, rows, target=("alpha 12 zeta " * 30, None, "")):
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    return saved(spark, tmp_path_factory.mktemp("tables"), table())


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_manifest_query(spark, folder):
    want = [(d, leaf, sub, root, proof, folded, folded == root) for d, (leaf, sub, root, proof, folded) in merkle(table()).items()]
    got = rows(op11_merkle_manifest(spark, folder), "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    assert got == sorted(want, key=str) and {w[-1] for w in want} == {True, False}


@pytest.mark.parametrize("n,fan", [(0, 8), (1, 8), (2, 2), (9, 3), (64, 8), (65, 8), (700, 2), (700, 8)])
def test_manifest_shapes(spark, n, fan):
    """One group of every awkward size, over four ranges: every path leads to the one root, and only from its own leaf."""
    docs = spark.createDataFrame([(i, f"t{i}", "en", "s", 2) for i in range(n)], SCHEMA)
    got = merkle_manifest(docs, fan=fan).withColumn("folded", fold(F.col("leaf"), F.col("places"), F.col("siblings"))).collect()
    want = merkle([(i, f"t{i}", "en", "s", 2) for i in range(n)], fan)
    assert len(got) == n and all(r.folded == r.root == want[r.doc_id][2] and r.leaf == want[r.doc_id][0] and r.subroot == want[r.doc_id][1] for r in got)


def test_manifest_odd_rows(spark):
    """A third of the rows alike without an id, null groups, columns with names of the operator's own, another order than that of ids."""
    docs = [(None, "same", None, None, None)] * 40 + [(i % 5, f"t{i}", "en", None, 1) for i in range(60)]
    df = spark.createDataFrame(docs, SCHEMA).withColumn("leaf", F.lit("x")).withColumn("row", F.lit(1)).withColumn("group", F.lit(2)).withColumn("order", F.lit(3))
    got = merkle_manifest(df, carry=["doc_id", "row", "group"]).withColumn("folded", fold(F.col("leaf"), F.col("places"), F.col("siblings"))).collect()
    assert len(got) == 100 and len({r.root for r in got}) == 1 and all(r.folded == r.root and (r.row, r.group) == (1, 2) for r in got)
    assert {r.doc_id is None: r.subroot for r in got}.keys() == {True, False} and len({r.subroot for r in got}) == 2


def test_crc_algebra():
    r = np.random.default_rng(1)
    words = [r.integers(0, 256, size=k, dtype=np.uint8).tobytes() for k in (0, 1, 2, 7, 8, 31, 32, 33, 300, 5000, 4)]
    data = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    crcs = word_crcs(data, ends - [len(w) for w in words], ends)
    assert crcs.tolist() == [zlib.crc32(w) for w in words]
    pairs = [(a, b) for a in range(len(words)) for b in range(len(words))]
    got = combine(crcs[[a for a, _ in pairs]], crcs[[b for _, b in pairs]], np.array([len(words[b]) for _, b in pairs]))
    assert got.tolist() == [zlib.crc32(words[a] + words[b]) for a, b in pairs]


def test_resampling_query(spark, folder):
    want = resample([r[:2] for r in table()], ["alpha 12 zeta " * 30, None, ""])
    assert rows(op12_importance_resampling(spark, folder), "doc_id", "n_features", "weight", "score", "rank") == sorted(want, key=str)


@pytest.mark.parametrize("longest,buckets,percent,least", [(2, 10_000, 10, 20), (4, 97, 100, 0), (3, 10_000, 50, 1)])
def test_resampling_of_runs(spark, longest, buckets, percent, least):
    docs = [r[:2] for r in table(80, 9)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("rank", F.lit("x")).withColumn("score", F.lit(0)).withColumn("row", F.lit(1))
    target = ["gamma's delta epsilon.", "zeta 12 12 日本語 delta epsilon zeta"]
    got = importance_resample(df, spark.createDataFrame([(t,) for t in target], "text string"), longest, buckets, percent, least)
    assert rows(got, "doc_id", "n_features", "weight", "score", "rank") == sorted(resample(docs, target, longest, buckets, percent, least), key=str)


def test_resampling_odd_rows(spark):
    """Rows without an id or with one id, an empty target, empty docs."""
    docs = spark.createDataFrame([(None, "one two three")] * 30 + [(7, "one two")] * 30 + [(8, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "text string")
    got = importance_resample(docs, none, 1, least_words=2, percent=50).collect()
    assert len(got) == 61 and sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 31)) and [r.n_features for r in got if r.doc_id == 8] == [0]
    assert importance_resample(docs.where("false"), none).count() == 0


@pytest.mark.parametrize("name", ["op11_merkle_manifest", "op12_importance_resampling", "op13_suffix_array_dedup"])
def test_same_rows_as_sql(spark, folder, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet/*.parquet'")
    cursor = con.execute(ORACLE_SQL[name])
    want = cursor.fetchall()
    assert rows(QUERIES[name](spark, folder), *[c[0] for c in cursor.description]) == sorted(want, key=str)


def cuts(docs, length=100, **more):
    got = later_repeats(docs, length).withColumn("sha", F.sha2("kept", 256)).collect()
    return sorted((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), r.sha) for r in got)


def test_suffixes_query(spark, folder):
    want = later_bytes([r[:2] for r in table()])
    got = rows(op13_suffix_array_dedup(spark, folder), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == sorted(want, key=str) and sum(w[2] for w in want) > 10_000


def overlapping(seed, n=150):
    r = random.Random(seed)
    text = lambda k: "".join(r.choice("abcdefgh ü日") for _ in range(k))
    base, out = text(700), []
    for i in range(n):
        a, b = sorted((r.randrange(700), r.randrange(700)))
        out.append((i, r.choice([text(r.randrange(300)), base[a:b], text(30) + base[a:b] + text(20), base[:a] + "X" + base[a:], base, "ab" * r.randrange(200), "z" * r.randrange(500), None, ""])))
    return out


@pytest.mark.parametrize("length,range_rows", [(100, 20_000), (100, 7), (64, 7), (255, 11)])
def test_suffixes_across_ranges(spark, monkeypatch, length, range_rows):
    """Overlaps, periods and edits; small ranges put one anchor into several of them."""
    monkeypatch.setattr(suffixes, "RANGE_ROWS", range_rows)
    docs = overlapping(length)
    assert cuts(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), length) == later_bytes(docs, length)


def test_suffixes_of_common_anchors(spark, monkeypatch):
    """One phrase in very many short texts, each with other words around it: its anchor has a home for each kind, in chunks of a few anchors."""
    monkeypatch.setattr(suffixes, "RANGE_ROWS", 20)
    monkeypatch.setattr(suffixes, "CHUNK", 40)
    r = random.Random(2)
    phrase = "the phrase that every one of them has, and it is fairly long as phrases go, all in all"
    docs = [(i, f"{r.randrange(50)} {r.choice('abc')} {phrase} {r.choice('xyz')} {r.randrange(30)} and on it goes {r.randrange(9)}") for i in range(400)]
    assert cuts(spark.createDataFrame(docs, "doc_id long, text string").repartition(5)) == later_bytes(docs)


def test_suffixes_of_a_long_text(spark):
    """A text of several pieces that repeats parts of itself over their bounds, and of a shorter one."""
    r = random.Random(4)
    text = "".join(r.choice("abcdefghij") for _ in range(1_300_000))
    text = text[: (1 << 19) + 300] + text[1000:90_000] + text[(1 << 19) - 5000 :]
    docs = [(1, text[7000:9000]), (2, text), (3, "q" + text[600_000:600_500])]
    assert cuts(spark.createDataFrame(docs, "doc_id long, text string")) == later_bytes(docs)


def test_suffixes_odd_rows(spark):
    """Ids null or shared, rows alike in both (a third of the table), columns with names of the operator's own, an empty table."""
    a, b = "abcdefghij" * 5 + "0123456789" * 10, "klmnopqrst" * 3 + "0123456789" * 12
    docs = spark.createDataFrame([(None, a)] * 40 + [(None, b), (None, None), (3, a), (3, b), (3, ""), (4, a + b)] + [(9, "other " + b)] * 2, "doc_id long, text string")
    clash = docs.selectExpr("*", "1 AS id", "2 AS sub", "'x' AS row", "3 AS part", "5 AS again", "6 AS n")
    got = rows(later_repeats(clash, carry=["doc_id", "text", "id"]).withColumn("kept", F.sha2("kept", 256)), "doc_id", "text", "id", "n_removed", "kept")
    texts = docs.distinct().selectExpr("doc_id", "text", "xxhash64(coalesce(text, '')) AS h").collect()
    texts = sorted(texts, key=lambda t: (t.doc_id is None, t.doc_id or 0, t.h if t.doc_id in (None, 3, 9) else 0))
    want = {tuple(t)[:2]: w for t, w in zip(texts, later_bytes([(i, t.text) for i, t in enumerate(texts)]))}
    assert got == sorted(((r.doc_id, r.text, 1, want[tuple(r)][2], want[tuple(r)][4]) for r in docs.collect()), key=str) and sum(g[3] for g in got) > 40 * len(a)
    assert later_repeats(docs.where("false")).count() == 0


def test_multikey_quicksort():
    r = np.random.default_rng(0)
    data = r.integers(97, 99, size=3000, dtype=np.uint8)
    data[1500:1900] = data[100:500]
    starts, group = np.arange(2900), r.integers(0, 2, size=2900)
    order, run = equal_windows(data, starts, group, 100)
    key = [(int(group[i]), data[i : i + 100].tobytes()) for i in range(2900)]
    count = {k: key.count(k) for k in set(key)}
    assert sorted(order.tolist()) == [i for i in range(2900) if count[key[i]] > 1]
    assert all((key[a] == key[b]) == (x == y) and key[a] <= key[b] for a, b, x, y in zip(order, order[1:], run, run[1:]))
