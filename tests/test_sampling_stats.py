import hashlib
import math
import random
from itertools import combinations
import re

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import features, ml, ranking, sampling, stats
from tallyloom.plans.queries import QUERIES


def scored(n=300, seed=1):
    r = random.Random(seed)
    return [(i, int(r.random() < 0.4), round(r.random(), 2)) for i in range(n)]


def test_ranks_are_a_permutation_in_digest_order(spark):
    df = spark.range(500).withColumn("g", F.col("id") % 3)
    got = ranking.hash_ranked(df, F.md5(F.col("id").cast("string")), "id", by=("g",)).withColumn("d", F.md5(F.col("id").cast("string"))).collect()
    for g in range(3):
        rows = sorted((r for r in got if r.g == g), key=lambda r: r["rank"])
        assert [r["rank"] for r in rows] == list(range(1, len(rows) + 1)) and [r.d for r in rows] == sorted(r.d for r in rows)


@pytest.mark.parametrize("descending", [False, True])
def test_running_sums(spark, descending):
    rows = [(float(i * 37 % 101), i % 7) for i in range(101)]
    got = {r.k: r.s for r in ranking.running(spark.createDataFrame(rows, "k double, v int"), "k", {"v": "s"}, descending=descending, parts=8).collect()}
    assert got == {k: sum(w for j, w in rows if (j >= k if descending else j <= k)) for k, _ in rows}


@pytest.mark.parametrize(("percent", "want"), [(10, 50), (0.01, 1), (99.99, 500)])
def test_exact_sample_size(spark, percent, want):
    df = spark.range(500)
    a, b = (sorted(r.id for r in sampling.exact_sample(d, "id", percent, 3).collect()) for d in (df, df.repartition(7)))
    assert a == b and len(a) == want


def test_full_sample_counts_nothing(spark):
    assert sampling.exact_sample(spark.range(5), "id", 100).select("n_total").distinct().collect()[0][0] is None
    assert sampling.exact_sample(spark.range(0), "id", 10).count() == 0


def test_allocation():
    out = sampling.allocation({"a": 10_000, "b": 100, "c": 3}, 200, 50)
    assert sum(out.values()) == 200 and out["c"] == 3 and out["a"] > out["b"] >= 17
    assert sampling.allocation({"a": 5, "b": 5}, 100) == {"a": 5, "b": 5}
    assert sum(sampling.allocation({str(i): 100 for i in range(10)}, 4).values()) == 10


def test_folds_are_stratified(spark):
    df = spark.createDataFrame(scored(), "id int, y int, p double")
    folds = sampling.stratified_folds(df, "id", "y", 5).groupBy("y", "fold").count().collect()
    for y in (0, 1):
        n = [r["count"] for r in folds if r.y == y]
        assert len(n) == 5 and max(n) - min(n) <= 1
    g = sampling.grouped_folds(df.withColumn("g", F.col("id") % 20), "g", "y", 4).groupBy("g").agg(F.countDistinct("fold").alias("k"))
    assert g.agg(F.max("k")).first()[0] == 1


def test_bootstrap_keeps_strata(spark):
    df = spark.createDataFrame(scored(), "id int, y int, p double")
    want = {r.y: r["count"] for r in df.groupBy("y").count().collect()}
    for r in sampling.bootstrap_draws(df, "id", "y", 3).groupBy("repeat", "y").count().collect():
        assert r["count"] == want[r.y]


def test_auc_ap_and_u(spark):
    rows = scored()
    df = spark.createDataFrame(rows, "id int, y int, p double")
    pos, neg = ([p for _, y, p in rows if y == k] for k in (1, 0))
    u = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg)
    assert abs(stats.roc_auc(df).first().auc - u / len(pos) / len(neg)) < 1e-12
    ap = last = 0.0
    for t in sorted({p for _, _, p in rows}, reverse=True):
        tp, k = sum(y for _, y, p in rows if p >= t), sum(p >= t for _, _, p in rows)
        ap, last = ap + (tp - last) / len(pos) * tp / k, tp
    assert abs(stats.average_precision(df).first().ap - ap) < 1e-12
    m = stats.mann_whitney(df.select(F.lit("f").alias("feature"), F.col("p").alias("value"), F.col("y").alias("outcome"))).first()
    assert m.u == u and abs(m.effect - (2 * u / len(pos) / len(neg) - 1)) < 1e-12
    assert stats.roc_auc(df.where("y = 1")).first().auc is None


def test_exact_tests(spark):
    t = spark.createDataFrame([("f", 3, 1, 1, 3), ("zero", 0, 5, 5, 0)], "feature string, a int, b int, c int, d int")
    got = {r.feature: r for r in stats.fisher(t).collect()}
    assert abs(got["f"].p - 0.48571428571428565) < 1e-9 and got["f"].odds == 9 and got["zero"].effect is None
    u = spark.createDataFrame([(0.0, 3, 3), (4.0, 3, 3)], "u double, a int, b int").select(stats.exact_u("u", "a", "b").alias("p")).collect()
    assert [round(r.p, 6) for r in u] == [0.1, 1.0]
    x = spark.createDataFrame([(3.841458820694124, 1), (10.0, 4), (0.0, 2)], "x double, k int").select(stats.chi2_p("x", "k").alias("p")).collect()
    assert abs(x[0].p - 0.05) < 1e-9 and abs(x[1].p - 0.04042768199451279) < 1e-9 and x[2].p == 1


def test_benjamini_hochberg(spark):
    p = [("a", 0.01), ("b", 0.04), ("c", 0.03), ("d", None), ("e", 0.9)]
    got = {r.feature: r.q for r in stats.benjamini_hochberg(spark.createDataFrame(p, "feature string, p double")).collect()}
    assert got["d"] is None and {k: round(v, 6) for k, v in got.items() if v is not None} == {"a": 0.04, "c": 0.053333, "b": 0.053333, "e": 0.9}


def test_univariate_kinds(spark):
    rows = [("n", str(i), i % 2) for i in range(20)] + [("c", "xy"[i % 2], (i // 2) % 2) for i in range(20)] + [("k", "xyz"[i % 3], i % 2) for i in range(20)] + [("one", "x", i % 2) for i in range(5)] + [("n", " ", 1)]
    got = {r.feature: r for r in stats.univariate(spark.createDataFrame(rows, "feature string, value string, outcome int")).collect()}
    assert {k: r.kind for k, r in got.items()} == {"n": "mann_whitney", "c": "fisher", "k": "chi_square", "one": "not_testable"}
    assert got["one"].p is None and all(0 <= got[k].p <= got[k].q + 1e-12 and got[k].q <= 1 for k in "nck")


def test_benjamini_hochberg_deals_out_ranks(spark, capsys):
    """Against a loop over sorted p, with ties; and no window holds all p values in one task."""
    r = random.Random(6)
    p = [(f"f{i}", None if i % 9 == 0 else r.choice([0.0, 0.5, 1.0]) if i % 5 == 0 else r.random() ** 3) for i in range(700)]
    known, want, low = sorted((x for x in p if x[1] is not None), key=lambda x: x[1]), {}, 1.0
    for i in range(len(known), 0, -1):
        low = min(low, known[i - 1][1] * len(known) / i)
        want[known[i - 1][0]] = low
    out = stats.benjamini_hochberg(spark.createDataFrame(p, "feature string, p double"))
    got = {x.feature: x.q for x in out.collect()}
    assert len(got) == 700 and got == {f: want.get(f) for f, _ in p}
    out.explain("formatted")
    tables = re.findall(r"\n\(\d+\) Window\nInput \[\d+\]: (.*)\nArguments: .*?windowspecdefinition\((\S+)", capsys.readouterr().out)
    assert tables and all("_part" in held and ("_t_" in held or "_part" in first) for held, first in tables), tables

def test_confusion_of_one_side(spark):
    m = stats.confusion(spark.createDataFrame([(1, 0.1), (1, 0.2)], "y int, p double")).first()
    assert (m.sensitivity, m.precision, m.f1, m.specificity, m.npv) == (0, 0, 0, None, 0)


def test_clr_of_zeros_and_sums(spark):
    long = spark.createDataFrame([("a", 0.5), ("a", 0.5), ("b", 0.0), ("b", 0.0), ("c", 0.9), ("c", 0.1)], "sample_id string, fraction double")
    got = features.clr(long).groupBy("sample_id").agg(F.sum("clr").alias("s"), F.max("clr").alias("m")).collect()
    assert all(abs(r.s) < 1e-9 for r in got) and {r.sample_id: round(r.m, 3) for r in got}["b"] == 0
    with pytest.raises(ValueError):
        features.clr(long, pseudocount=0)


def test_zscores_of_odd_values(spark):
    long = spark.createDataFrame([(1, 1.0), (1, 3.0), (2, 5.0), (2, 5.0), (3, math.nan), (3, None)], "j int, v double")
    got = sorted((r.j, r.z) for r in features.zscores(long).collect())
    assert got == [(1, -1.0), (1, 1.0), (2, 0.0), (2, 0.0), (3, 0.0), (3, 0.0)]


def test_nested_cv_learns(spark):
    r = random.Random(2)
    rows = [(i, y := i % 2, r.gauss(3 * y, 1), "ab"[y] if r.random() < 0.9 else None) for i in range(60)]
    df = spark.createDataFrame(rows, "id int, y int, x double, c string")
    out = ml.nested_cv(df, "id", ["x"], ["c"], "elastic_net", outer=2, inner=2, grid=[{"c": 1.0, "l1": 0.5}])
    assert out.count() == 60 and stats.roc_auc(out, parts=1).first().auc > 0.9
    with pytest.raises(ValueError):
        ml.nested_cv(df.where("y = 1 or id = 0"), "id", ["x"], [], "dummy", outer=2)
    moved = ml.permuted(df, "id", "x", 1)
    assert sorted(r.x for r in moved.collect()) == sorted(r[2] for r in rows)


def test_nested_cv_picks_the_clear_winner(spark):
    """The inner search has to leave the first option, which shrinks every coefficient to 0."""
    r = random.Random(3)
    df = spark.createDataFrame([(i, i % 2, r.gauss(3 * (i % 2), 1)) for i in range(60)], "id int, y int, x double")
    out = ml.nested_cv(df, "id", ["x"], [], "elastic_net", outer=2, inner=2, grid=[{"c": 1e-6, "l1": 1.0}, {"c": 1.0, "l1": 0.5}])
    assert stats.roc_auc(out, parts=1).first().auc > 0.9


def test_model_queries_search_the_whole_grids(spark, monkeypatch):
    assert {(g["c"], g["l1"]) for g in ml.GRIDS["elastic_net"]} == {(c, x) for c in (0.01, 0.1, 1.0, 10.0) for x in (0.0, 0.5, 1.0)}
    assert {(g["depth"], g["leaf"], g["features"]) for g in ml.GRIDS["random_forest"]} == {(d, n, f) for d in (3, 30) for n in (2, 5) for f in ("sqrt", "0.5")}
    forest = ml.model("random_forest", ml.GRIDS["random_forest"][1], 10, 1)
    assert (forest.getNumTrees(), forest.getFeatureSubsetStrategy()) == (300, "0.5")
    searched = []

    def spy(df, *a, grid=None, **k):
        searched.append(grid or ml.GRIDS[a[3]])
        return spark.createDataFrame([(0, 0, 0.1), (0, 1, 0.9)], "fold int, y int, p double")

    monkeypatch.setattr(ml, "nested_cv", spy)
    for name in ("elastic_net_auc", "random_forest_auc"):
        assert QUERIES[name](spark, "/root/testdata/sf0.001").first().auc == 1
    assert searched == [ml.GRIDS["elastic_net"], [o | {"trees": 40} for o in ml.GRIDS["random_forest"]]]


def test_importances_like_a_plain_loop(spark):
    """One pass gives what dealing out a feature, scoring and ranking give one after another; the feature that decides is worth most."""
    r = random.Random(5)
    rows = [(i, y := r.randrange(2), r.gauss(2 * y, 1) if i % 7 else None, r.gauss(0, 1), "ab"[y] if r.random() < 0.6 else r.choice(["c", None])) for i in range(120)]
    df = spark.createDataFrame(rows, "id int, y int, x double, noise double, c string")
    train, test = df.where("id < 80").cache(), df.where("id >= 80").cache()
    found = {r.feature: r for r in ml.permutation_importance(train, test, "id", ["x", "noise"], ["c"], "elastic_net", {"c": 1.0, "l1": 0.5}, repeats=3, seed=6).collect()}
    p = ml.fit_preprocessor(train, ["x", "noise"], ["c"])

    def auc(rows):
        out = ml.predicted(ml.transform(train, p), ml.transform(rows, p), "elastic_net", {"c": 1.0, "l1": 0.5}, 6).select("y", "p").collect()
        pairs = [(a.p > b.p) + (a.p == b.p) / 2 for a in out for b in out if a.y > b.y]
        return sum(pairs) / len(pairs)

    base, held = auc(test), {t.id: t for t in test.collect()}
    for f in ("x", "noise", "c"):
        lost = []
        for k in range(3):
            order = {end: sorted(held, key=lambda i, end=end: hashlib.md5(f"{i}|6|{f}|{k}|{end}".encode()).hexdigest()) for end in ("to", "from")}
            gets = {to: held[giver][f] for to, giver in zip(order["to"], order["from"])}
            lost.append(base - auc(spark.createDataFrame([tuple(gets[t.id] if c == f else t[c] for c in df.columns) for t in held.values()], df.schema)))
        mean = sum(lost) / 3
        assert abs(found[f].mean - mean) < 1e-9 and abs(found[f].deviation - math.sqrt(sum((x - mean) ** 2 for x in lost) / 3)) < 1e-9
    assert found["x"].mean > found["noise"].mean and len(found) == 3
    alone = ml.permutation_importance(train.where("y = 1"), test, "id", ["x"], ["c"], "elastic_net", {"c": 1.0, "l1": 0.5}, repeats=2).collect()
    assert {r.mean for r in alone} == {0.0}


def test_exact_u_of_unequal_groups(spark):
    """8 against 60, as counted one value at a time; small groups by listing all of them."""
    ways = {(0, 0): 1}  # (values of the smaller group so far, U) among the ranks so far
    for rank in range(68):
        more = dict(ways)
        for (k, u), n in ways.items():
            if k < 8:
                more[k + 1, u + rank - k] = more.get((k + 1, u + rank - k), 0) + n
        ways = more
    p = 2 * sum(n for (k, u), n in ways.items() if k == 8 and u <= 150) / math.comb(68, 8)
    got = spark.createDataFrame([(150.0, 8, 60), (330.0, 60, 8), (3.0, 3, 4), (2.5, 3, 4), (1.0, 3000, 3000)], "u double, a int, b int").select(stats.exact_u("u", "a", "b").alias("p")).collect()
    assert abs(got[0].p - p) < 1e-12 and got[0].p == got[1].p and got[3].p is None and got[4].p is None
    assert abs(got[2].p - 2 * sum(sum(c) - 6 <= 3 for c in combinations(range(1, 8), 3)) / 35) < 1e-12
    long = [("f", float(i), int(i < 60)) for i in range(68)]
    u = stats.univariate(spark.createDataFrame([(f, str(v), y) for f, v, y in long], "feature string, value string, outcome int")).first()
    assert u.kind == "mann_whitney" and u.statistic == 0 and abs(u.p - 2 / math.comb(68, 8)) < 1e-15
