"""Every registered query with SQL gives DuckDB's rows on the smallest tables."""

import math
from collections import Counter

import duckdb
import numpy as np
import pytest

from tallyloom.plans import QUERIES, SQL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return con


def plain(x):
    if type(x).__name__ == "Decimal":
        x = float(x)
    return ("nan" if math.isnan(x) else float(f"{x:.9g}")) if isinstance(x, float) else x


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    cursor = duck.execute(SQL[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    want = sorted((tuple(plain(r[columns.index(c)]) for c in sorted(columns)) for r in cursor.fetchall()), key=str)
    got = sorted((tuple(plain(r[c]) for c in sorted(columns)) for r in df.collect()), key=str)
    assert got == want


def test_stratified_sample(spark, duck):
    """As many cells of each class as the allocation has."""
    from tallyloom.functions.text import CLASS_NAMES
    from tallyloom.operators.sampling import allocation

    counts = dict(duck.execute("SELECT l_partkey % 15, count(*) FROM lineitem GROUP BY 1").fetchall())
    want = sorted(allocation({CLASS_NAMES[k]: n for k, n in counts.items()}, 1200).values())
    rows = QUERIES["stratified_sample"](spark, SMALL).collect()
    assert sorted(Counter(r.class_name for r in rows).values()) == want == sorted(r.alloc for r in QUERIES["stratified_sample_sizes"](spark, SMALL).collect())
    assert len(rows) == sum(want)
    thin = QUERIES["thinned_region"](spark, SMALL).collect()
    assert 0 < len(thin) <= 1000 and len({r.class_id for r in thin}) == len(counts)


def test_fisher_by_counting(spark, duck):
    """The chances of all tables with the same margins, counted with whole numbers."""
    rows = duck.execute("SELECT lang, n_chars > 2000, quality, count(*) FROM documents JOIN labels USING (doc_id) WHERE quality IS NOT NULL GROUP BY ALL").fetchall()
    for r in QUERIES["fisher_exact"](spark, SMALL).collect():
        n = {(long, y): sum(k for lang, a, b, k in rows if (lang, a, b) == (r.feature, long, y)) for long in (True, False) for y in (1, 0)}
        a, b, c, d = n[True, 1], n[True, 0], n[False, 1], n[False, 0]
        ways = lambda x: math.comb(a + b, x) * math.comb(c + d, a + c - x)
        possible = [ways(x) for x in range(max(0, a - d), min(a + b, a + c) + 1)]
        assert abs(r.p - sum(w for w in possible if w <= ways(a)) / sum(possible)) < 1e-9


def test_components_like_singular_vectors(spark, duck):
    x = np.array([r[0] for r in duck.execute("SELECT embedding FROM embeddings ORDER BY vec_id").fetchall()], dtype=np.float64)
    x -= x.mean(axis=0)
    u, s, _ = np.linalg.svd(x, full_matrices=False)
    got = np.array([(r.c1, r.c2) for r in QUERIES["pca_embedding"](spark, SMALL).orderBy("id").collect()])
    assert np.allclose(got, np.abs(u[:, :2] * s[:2]), atol=2e-4)


def test_univariate_parts(spark):
    got = {r.feature: r for r in QUERIES["univariate_tests"](spark, SMALL).collect()}
    m = {r.feature: r for r in QUERIES["mann_whitney_u"](spark, SMALL).collect()}
    x = {r.feature: r for r in QUERIES["chi_square_cramers_v"](spark, SMALL).collect()}
    assert got["n_chars"].kind == "mann_whitney" and got["n_chars"].statistic == m["n_chars"].u and abs(got["n_chars"].p - math.erfc(abs(m["n_chars"].z) / math.sqrt(2))) < 1e-6
    assert all(got[f].kind == "chi_square" and abs(got[f].statistic - x[f].chi2) < 1e-5 for f in ("lang", "source"))
    ranked = sorted(got.values(), key=lambda r: r.p)
    assert abs(ranked[-1].q - ranked[-1].p) < 1e-8 and all(a.q <= b.q + 1e-12 for a, b in zip(ranked, ranked[1:]))
