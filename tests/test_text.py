import pytest
from pyspark.sql import functions as F

from tallyloom.functions import text as tx


def values(spark, column, *inputs):
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], "i int, x string").select("i", column(F.col("x")).alias("y"))
    return [r.y for r in rows.orderBy("i").collect()]


def test_slugs(spark):
    assert values(spark, tx.slug, "a b/c", "__x-", "ü é", None) == ["a_b_c", "x", "", None]
    assert values(spark, lambda c: tx.slug(c, "_", True, "case", 5), "  a   b  ", "///", "abcdefgh") == ["a_b", "case", "abcde"]
    assert values(spark, tx.sample_id, "case 1/slide_L0_rgb.tif", "a/b.tif", "A_l0_RGB.TIFF") == ["case_1_slide", "a_b", "A"]


def test_keys(spark):
    assert values(spark, tx.slide_key, " s_1.svs", "S 1 L0 RGB HE 1", "s--1_he-1", "a-HE-2") == ["S-1", "S-1", "S-1", "A-HE-2"]
    assert values(spark, tx.feature_slug, "Año de É", "--", "a  b") == ["ANO_DE_E", "FEATURE", "A_B"]


@pytest.mark.parametrize(("dialect", "want"), [("cohort", [True, False, None, None, None]), ("clinical", [True, False, True, None, None]), ("strict", [None, None, None, None, None]), ("truthy", [True, False, False, False, False])])
def test_booleans(spark, dialect, want):
    assert values(spark, lambda c: tx.parse_bool(c, dialect), " YES ", "no" if dialect != "strict" else "x", "sí", "maybe", "")[:5] == (want if dialect != "strict" else [None] * 5)


def test_integers(spark):
    assert values(spark, tx.parse_int, " 7 ", "7.0", "7.5", "inf", "x", "", None) == [7, 7, None, None, None, None, None]


def test_class_names(spark):
    assert values(spark, tx.class_id, "cancer-CELLS", "RBC", "what", None) == [1, -1, -1, -1]
    assert values(spark, tx.class_name, "rbc", "Smooth  muscle cells", " Other ") == ["Red blood cell", "Muscle Cell", "Other"]


def test_globs(spark):
    assert values(spark, lambda c: tx.matches(c, ["a*", "b?[!0-9]"], ["*z"]), "abc", "bxy", "bx1", "az", "c", "a.b") == [True, True, False, False, False, True]


def test_natural_order(spark):
    names = ["s10", "s2", "S1", "s2a", "2", "10"]
    df = spark.createDataFrame([(n,) for n in names], "n string").orderBy(tx.natural_key(F.col("n")), "n")
    assert [r.n for r in df.collect()] == ["2", "10", "S1", "s2", "s2a", "s10"]


def test_tiles_and_digests(spark):
    assert [r and (r.row, r.column) for r in values(spark, tx.tile_position, "3_4", "3", "3_4_5", "-1_2", "a_b")] == [(3, 4), None, None, None, None]
    assert values(spark, tx.md5_of, "md5:" + "A" * 32, "b" * 32, "x") == ["a" * 32, "b" * 32, None]


def test_paths_and_urls(spark):
    assert values(spark, lambda c: tx.relative(c, "/r"), "/r/a/b", "/rx/a", None) == ["a/b", "/rx/a", ""]
    assert values(spark, tx.https_origin, "https://h/x", "http://h/x", "https://u@h/x", "https://h/x?q", "https://h:8/") == [True, False, False, False, True]
    assert values(spark, tx.host, "https://U@Host:1/x", "nothing") == ["host", ""]
