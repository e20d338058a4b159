import hashlib
import random
import re

import numpy as np
import pytest
from brute import near, repeats, roots, shingles
from pyspark.sql import functions as F

from tallyloom.llm import _shared, _words, embedding_dedup, exact_dedup, near_dedup, substrings
from tallyloom.llm._components import components
from tallyloom.llm.embedding_dedup import near_vectors

DOCS = "doc_id long, text string"
ODD = [(None, "a b c d"), (7, None), (8, ""), (9, " \t\n"), (10, "one"), (11, "one"), (12, "Zwei Wörter hier"), (13, "one  ")]


def corpus(seed=1, n=60):
    r = random.Random(seed)
    words = ["w%d" % i for i in range(200)]
    passage = [r.choice(words) for _ in range(60)]
    docs = []
    for i in range(n):
        w = [r.choice(words) for _ in range(r.choice([5, 34, 35, 36, 80, 150]))]
        if i % 4 == 0:
            a = r.randrange(0, 20)
            w[len(w) // 2 : len(w) // 2] = passage[a : a + r.randrange(30, 41)]
        if i % 7 == 0 and docs:
            w = docs[r.randrange(len(docs))][1].split()
            w[r.randrange(len(w))] = "edited"
        docs.append((i + 100, r.choice([" ", "\n"]).join(w)))
    docs.append((500, docs[3][1]))
    docs.append((501, " ".join(["same"] * 90)))
    docs.append((502, " ".join(passage + ["x"] + passage)))
    docs.append((503, "Über " * 40 + "ende\v" + "straße " * 50))
    return docs


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_repeats_like_brute_force(spark):
    docs = corpus() + ODD[1:]
    got = substrings.repeated_passages(spark.createDataFrame(docs, DOCS).repartition(5))
    got = got.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256))
    assert rows(got) == sorted(repeats(docs), key=str)


@pytest.mark.parametrize("window", [12, 20, 50])
def test_other_windows(spark, window):
    docs = corpus(window)
    got = substrings.repeated_passages(spark.createDataFrame(docs, DOCS), window).select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256))
    assert rows(got) == sorted(repeats(docs, window), key=str)


def test_repeated_rows_ids_and_layout(spark):
    text = " ".join(f"u{i}" for i in range(40))
    df = spark.createDataFrame([(1, text, "x"), (1, text, "x"), (2, "alone\n\nhere", "y"), (None, None, "z"), (1, "head " + text + " tail", "q")], DOCS + ", seeds string")
    got = substrings.repeated_passages(df, carry=["doc_id", "seeds"], layout=True).orderBy("seeds").collect()
    assert [(r.seeds, r.n_removed, r.kept_text) for r in got] == [("q", 40, "head tail"), ("x", 40, ""), ("x", 40, ""), ("y", 0, "alone\n\nhere"), ("z", 0, None)]
    assert [(s.begin, s.end) for s in got[0].spans] == [(1, 41)]
    assert substrings.repeated_passages(spark.createDataFrame([], DOCS)).count() == 0
    with pytest.raises(ValueError):
        substrings.repeated_passages(df, 5)


def test_leftmost_minimum():
    r = np.random.default_rng(0)
    for width in (1, 2, 7, 25):
        v = r.integers(0, 9, 80).astype(np.uint64)
        assert substrings.leftmost_minimum(v, width).tolist() == [i + int(np.argmin(v[i : i + width])) for i in range(80 - width + 1)]


def exact(docs):
    groups = {}
    for i, (d, t) in enumerate(docs):
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), 2**63 if d is None else d, i))
    out = []
    for norm, members in groups.items():
        keep = min(members)
        out += [(docs[i][0], docs[keep[2]][0], len(members), i == keep[2], hashlib.sha256(norm.encode()).hexdigest()) for _, _, i in members]
    return sorted(out, key=str)


def test_exact_like_brute_force(spark):
    docs = corpus() + ODD + [(3, "q q"), (3, "q q"), (3, "qq"), (2, "q\tq")]
    df = spark.createDataFrame([(d, t, "x") for d, t in docs], DOCS + ", hash string").repartition(3)
    got = exact_dedup.exact_duplicates(df, capacity=4, max_depth=5)
    assert got.select("bucket").distinct().count() > 1
    assert rows(got.drop("bucket", "points")) == exact(docs)
    assert exact_dedup.exact_duplicates(spark.createDataFrame([], DOCS)).count() == 0


def test_directory_splits_only_overfull_buckets():
    counts = {0b00000: 9, 0b00001: 1, 0b10000: 2}
    depth, entries = exact_dedup.directory(counts, 3, 5)
    assert depth == 5 and len(entries) == 32
    own = {p: d for p, _, d in entries}
    assert own[0] == 5 and own[0b10000] == 1 and own[0b01000] == 2
    assert exact_dedup.directory({}, 3, 5) == (1, [(0, 0, 0), (1, 0, 0)])
    for p, b, d in entries:
        assert p >> (5 - d) << (5 - d) == b


@pytest.mark.parametrize(("size", "percent"), [(2, 80), (5, 80), (3, 50)])
def test_near_like_brute_force(spark, size, percent):
    r = random.Random(size)
    docs = corpus(9) + ODD[1:]
    base = docs[0][1].split()
    for i in range(25):  # a chain and a cloud of edits
        w = list(base)
        for _ in range(i % 6 + 1):
            w[r.randrange(len(w))] = f"e{r.randrange(50)}"
        docs.append((900 + i, " ".join(w).upper()))
    docs = [(d, t.replace("W", "w") if t else t) for d, t in docs]
    got = near_dedup.near_duplicates(spark.createDataFrame(docs, DOCS).repartition(4), size, percent)
    assert rows(got) == sorted(near(docs, size, percent), key=str)


@pytest.mark.parametrize("size", [2, 5])
def test_meetings_hold_every_link_and_few_others(spark, size):
    r = random.Random(4)
    passage = ["p%d" % i for i in range(40)]
    own = [[r.choice("abcdefghijk") + str(r.randrange(40)) for _ in range(r.choice([3, 30, 90]))] for _ in range(40)]
    own += [[*w[:-1], "edited"] for w in own[::3]] + [own[1], own[1][:-1]]
    docs = [(i, " ".join(passage + w)) for i, w in enumerate(own)] + [(5, "one other text of the same id")]
    rest = spark.createDataFrame([(i, i) for i in range(len(own))], "node long, label long")
    found = {tuple(p) for p in near_dedup._meetings(spark.createDataFrame(docs, DOCS), rest, size, 80).collect()}
    sets = [(i, shingles(text, size)) for i, text in docs]
    linked = {(i, j) for i, x in sets for j, y in sets if i < j and 100 * len(x & y) >= 80 * len(x | y)}
    assert linked and linked <= found
    assert len(found) < len(own) * (len(own) - 1) / 2


def test_near_odd_rows(spark):
    docs = [(None, "a b c"), (1, "a b c"), (1, "x y z"), (5, "x y z"), (6, "A B C"), (7, None), (None, None)]
    got = near_dedup.near_duplicates(spark.createDataFrame([(d, t, 1) for d, t in docs], DOCS + ", node int"), 2)
    assert rows(got.select("doc_id", "component_id", "kept")) == sorted([(None, None, True), (1, 1, True), (1, 1, True), (5, 1, False), (6, 1, False), (7, 7, True), (None, None, True)], key=str)
    assert near_dedup.near_duplicates(spark.createDataFrame([], DOCS)).count() == 0


def test_sketches_tell_the_similarity():
    r = np.random.default_rng(3)
    a = r.integers(0, 1 << 63, 400).astype(np.uint64)
    for same in (400, 360, 300):
        b = np.concatenate([a[:same], r.integers(0, 1 << 63, 400 - same).astype(np.uint64)])
        j = same / (800 - same)
        assert abs((near_dedup.minhashes(a) == near_dedup.minhashes(b)).mean() - j) < 0.12


@pytest.mark.parametrize("links", [[], [(1, 2), (2, 3), (9, 8), (3, 3)], [(i, i + 1) for i in range(40)] + [(None, 4)], [(0, i) for i in range(1, 30)] + [(100, 29), (100, 101)]])
def test_components(spark, links):
    real = [(a, b) for a, b in links if a is not None and a != b]
    want = {n: r for n, r in roots({x for e in real for x in e}, real).items()}
    assert {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()} == want


def test_vectors_like_brute_force(spark):
    r = np.random.default_rng(5)
    v, labels = [], []
    for i in range(700):
        x = r.standard_normal(16)
        if i % 5 == 0:
            x = np.ones(16) + 0.05 * r.standard_normal(16)
        if i % 50 == 1:
            x = np.array(v[i - 1])
        v.append([float(np.float32(c)) for c in x])
        labels.append(int(i % 3))
    table = [(i, x, k) for i, (x, k) in enumerate(zip(v, labels))]
    bad = [(800, None, 1), (801, [0.0] * 16, 1), (802, [1.0] * 15 + [None], 1), (803, [float("nan")] * 16, 1), (804, [1.0] * 16, None), (805, [1.0] * 3, 0), (None, [1.0] * 16, 0), (806, [], 0)]
    df = spark.createDataFrame([(*t, "x") for t in table + bad], "vec_id long, embedding array<float>, label int, node string")
    e = np.array(v)
    e /= np.linalg.norm(e, axis=1)[:, None]
    k = np.array(labels)
    link = (e @ e.T >= 0.98) & (k[:, None] == k[None, :])
    np.fill_diagonal(link, False)
    root = roots(range(700), zip(*map(np.ndarray.tolist, np.nonzero(link))))
    want = [(i, int(link[i].sum()), root[i], root[i] == i) for i in range(700)] + [(i, 0, i, True) for i, _, _ in bad]
    assert rows(near_vectors(df)) == sorted(want, key=str)
    assert near_vectors(df.where("vec_id >= 800")).count() == 7 and near_vectors(df.limit(0)).count() == 0


def vectors_brute(table, threshold=0.98):
    """(vec_id, n_links, component_id, kept) by comparing every two rows."""
    linked, n = [], len(table)
    for i in range(n):
        for j in range(i):
            (_, x, k), (_, y, m) = table[i], table[j]
            if k == m and len(x) == len(y) and np.dot(x, y) >= threshold * np.linalg.norm(x) * np.linalg.norm(y):
                linked.append((i, j))
    root = roots(range(n), linked)
    least = {}
    for i, r in root.items():
        least[r] = min(least.get(r, table[i][0]), table[i][0])
    count = [sum(i in e for e in linked) for i in range(n)]
    return sorted(((t[0], count[i], least[root[i]], t[0] == least[root[i]]) for i, t in enumerate(table)), key=str)


def test_repeated_ids_lengths_and_text_labels(spark):
    r = np.random.default_rng(9)
    table = []
    for length in (4, 7):
        for i in range(30):
            axis = np.zeros(length)
            axis[i % 3] = 1
            table.append((i // 2, [float(c) for c in axis + 0.06 * r.standard_normal(length)], "left" if i % 4 else "right"))
    table += [(99, table[0][1], "left"), (99, table[0][1], "left"), (98, table[40][1], "left")]
    df = spark.createDataFrame(table, "vec_id long, embedding array<double>, label string")
    assert rows(near_vectors(df)) == vectors_brute(table)


def test_large_groups_are_counted_without_pairs(spark, monkeypatch):
    """Groups over CELL nodes: part within half of the angle from the mean, part not, with copies and a second large group."""
    monkeypatch.setattr(embedding_dedup, "CELL", 40)
    r = np.random.default_rng(2)
    table, n = [], 0
    for axis, spread, size, label in ((0, 0.03, 120, 1), (1, 0.012, 90, 1), (2, 0.05, 20, 2), (0, 0.04, 60, 2)):
        for _ in range(size):
            x = 0.0 * np.ones(16)
            x[axis] = 1
            x += spread * r.standard_normal(16)
            table.append((n, [float(c) for c in x], label))
            n += 1
    table += [(n + i, table[i * 7][1], table[i * 7][2]) for i in range(25)]
    df = spark.createDataFrame(table, "vec_id long, embedding array<double>, label int")
    assert rows(near_vectors(df)) == vectors_brute(table)


def audited(spark, groups, alone=0):
    """(nodes, groups (node, root)) of unit vectors: groups are sizes, each member of a group near its own axis."""
    r = np.random.default_rng(3)
    rows, members, n = [], [], 0
    for size in [*groups, *[1] * alone]:
        axis = r.standard_normal(64)
        rows += [(n + i, "0", [float(c) for c in axis + 0.01 * r.standard_normal(64)]) for i in range(size)]
        members += [(n + i, n) for i in range(size)] if size > 1 else []
        n += size
    return spark.createDataFrame(rows, "node long, label string, vector array<double>"), members


def test_audit_sees_small_groups_beside_a_large_one(spark):
    nodes, members = audited(spark, [150, *[2] * 50])
    rooted = lambda x: spark.createDataFrame(x, "node long, root long")
    assert embedding_dedup._audit(rooted(members), nodes, 0.98) == (1.0, 250)
    recall, n = embedding_dedup._audit(rooted([x for x in members if x[0] < 150]), nodes, 0.98)
    assert n == 250 and abs(recall - 0.6) < 1e-9


def test_audit_draws_on_until_nodes_have_links(spark):
    nodes, _ = audited(spark, [2] * 10, alone=980)
    recall, n = embedding_dedup._audit(spark.createDataFrame([], "node long, root long"), nodes, 0.98)
    assert (recall, n) == (0.0, 20)


def test_low_recall_is_an_error(spark, monkeypatch):
    nodes, _ = audited(spark, [2] * 10)
    monkeypatch.setattr(embedding_dedup, "_audit", lambda *a: (0.5, 20))
    monkeypatch.setattr(embedding_dedup, "ATTEMPTS", 1)
    with pytest.raises(RuntimeError, match="0.5000 over 20"):
        embedding_dedup.near_vectors(nodes.select(F.col("node").alias("vec_id"), F.col("vector").alias("embedding"), "label"))


def thue_morse(n):
    """Two words of n letters that polynomials modulo 2**64 with any odd base cannot tell apart from 1,024 letters on."""
    a, b = "a", "b"
    while len(a) < n:
        a, b = a + b, b + a
    return a, b


@pytest.mark.parametrize("n", [1024, 2048])
def test_patterned_words_are_told_apart(spark, n):
    a, b = thue_morse(n)
    around = " ".join(f"w{i}" for i in range(34))
    docs = [(1, a), (2, b), (3, f"{around} {a}"), (4, f"{around} {b}"), (5, " ".join(a)), (6, " ".join(b))]
    df = spark.createDataFrame(docs, DOCS)
    got = substrings.repeated_passages(df).select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256))
    assert rows(got) == sorted(repeats(docs), key=str)
    assert {r.doc_id: r.n_removed for r in substrings.repeated_passages(df.where("doc_id < 5")).collect()} == {1: 0, 2: 0, 3: 0, 4: 0}
    for size in (2, 5):
        assert rows(near_dedup.near_duplicates(df, size)) == sorted(near(docs, size), key=str)


def test_hashes_of_words_and_runs():
    data = b"a b aa ab ba abcdefgh abcdefghabcdefgh abcdefgh\x00 h\xc3\xa9 abcdefghi iabcdefgh"
    array = np.frombuffer(data, dtype=np.uint8)
    starts, ends, _ = _words.find(array, np.array([0, len(array)]))
    one, other = _words.hashes(array, starts, ends), _words.hashes(array, starts, ends, 1)
    assert len(set(one.tolist())) == len(set(other.tolist())) == len(data.split(b" ")) and not set(one.tolist()) & set(other.tolist())
    again = np.concatenate([np.frombuffer(b"x ", dtype=np.uint8), array])
    assert (_words.hashes(again, starts + 2, ends + 2) == one).all()
    r = np.random.default_rng(0)
    values = r.integers(0, 2, 400).astype(np.uint64)
    a = r.integers(0, 300, 3000)
    b = a + r.integers(1, 90, 3000)
    same = {}
    for h, i, j in zip(_words.Runs(values).hash(a, b).tolist(), a, b):
        assert same.setdefault(h, values[i:j].tolist()) == values[i:j].tolist()
    assert len(same) == len({tuple(values[i:j].tolist()) for i, j in zip(a, b)})


def test_split_join_splits_hot_keys(spark, monkeypatch):
    monkeypatch.setattr(_shared, "PART_ROWS", 10)
    table = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "k int, v string")
    left = spark.range(200).select(F.when(F.col("id") < 150, 1).otherwise(F.col("id") % 4).cast("int").alias("k"), "id")
    want = rows(left.join(table, "k"))
    assert rows(_shared.split_join(left, table, ["k"], F.col("id"))) == want
    assert rows(_shared.split_join(left, table, ["k"], F.col("id"), left.groupBy("k").agg(F.count("*").alias("n")))) == want
    assert rows(_shared.split_join(left, table, ["k"], F.col("id"), narrow=True)) == want
    assert rows(_shared.split_join(left.limit(0), table, ["k"], F.col("id"))) == []


def test_exact_rows_come_through_the_index(spark, monkeypatch):
    """Splitting at every bucket changes nothing; a directory that sends keys to other buckets than the entries' loses rows."""
    docs = [(i, f"t {i % 40}") for i in range(200)]
    df = spark.createDataFrame(docs, DOCS)
    assert rows(exact_dedup.exact_duplicates(df, capacity=1).drop("bucket", "points")) == exact(docs)
    index, _ = exact_dedup.index_entries(df.select(F.lit(0).alias("page"), F.lit(5).cast("long").alias("hash"), F.expr("cast(text as binary)").alias("digest"), "doc_id", F.lit(1).alias("points"), F.col("doc_id").alias("row")), 4, 6)
    assert sorted(r.chain for r in index.collect()) == list(range(1, 41)) and index.select("bucket").distinct().count() == 1
    monkeypatch.setattr(exact_dedup, "index_entries", lambda pages, *a: (lambda i, d: (i.withColumn("bucket", F.col("bucket") + 1), d))(*kept(pages, *a)))
    assert exact_dedup.exact_duplicates(df, capacity=4).count() == 0


kept = exact_dedup.index_entries


def test_few_links_among_many_vectors(spark, monkeypatch):
    """Pairs of just the threshold's cosine that a few trees part: an audit with few linked nodes does not pass before all trees are there."""
    monkeypatch.setattr(embedding_dedup, "BLOCK", 8)
    r = np.random.default_rng(7)
    x = r.standard_normal((5000, 32))
    x /= np.linalg.norm(x, axis=1)[:, None]
    for i in range(20):
        away = r.standard_normal(32)
        away -= away @ x[i] * x[i]
        x[100 + i] = 0.9805 * x[i] + np.sqrt(1 - 0.9805**2) * away / np.linalg.norm(away)
    asked, audit = [], embedding_dedup._audit
    monkeypatch.setattr(embedding_dedup, "_audit", lambda *a: asked.append(audit(*a)) or asked[-1])
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r.component_id for r in embedding_dedup.near_vectors(df).where("n_links > 0").collect()}
    assert got == {i + k: i for i in range(20) for k in (0, 100)}
    assert len(asked) == 2 and asked[0][1] < embedding_dedup.NEEDED


def test_sets_that_nothing_can_be_linked_with_make_no_rows(spark, monkeypatch):
    """Of sets that share a passage, but have most shingles for themselves, none leaves rows for the last meetings; the links do, however full the slots are."""
    made, stored = {}, near_dedup.stored
    monkeypatch.setattr(near_dedup, "stored", lambda df, name, *a: made.setdefault(name, []).append(stored(df, name, *a)) or made[name][-1])
    docs = [(i, " ".join([f"p{k}" for k in range(10)] + [f"{i}w{k}" for k in range(40)])) for i in range(200)]
    docs += [(200, docs[7][1] + " more"), (201, "a b"), (3, "one other text of the same id"), (4, " "), (5, None)]
    rest = spark.createDataFrame([(i, i) for i in range(202)], "node long, label long")
    meetings = lambda: near_dedup._meetings(spark.createDataFrame(docs, DOCS), rest, 2, 80).collect()
    assert list(map(tuple, meetings())) == [(7, 200)]
    assert sum(len(shingles(t, 2)) for _, t in docs) > 9800 and 98 <= made["shingles"][-1].count() <= 100
    monkeypatch.setattr(near_dedup, "_shared_slots", lambda sets: (np.full(1 << 15, 255, np.uint8), 46))
    assert (7, 200) in set(map(tuple, meetings())) and made["shingles"][-1].count() > 9800
    none = spark.createDataFrame([(4, 4), (5, 5)], "node long, label long")
    monkeypatch.undo()
    assert near_dedup._meetings(spark.createDataFrame([(4, " "), (5, None)], DOCS), none, 2, 80).count() == 0
