import hashlib
import json
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom import sources, streaming
from tallyloom.functions import geometry as geo
from tallyloom.operators import integrity, linkage, validate
from tallyloom.sources import readers, writers


def test_reconcile(spark):
    w = spark.createDataFrame([(1, 10, "a"), (2, 10, "b"), (3, 10, "c"), (4, 10, "d")], "key int, size int, md5 string")
    t = spark.createDataFrame([(1, 10, "a"), (2, None, None), (3, 11, "c"), (5, 1, "e")], "key int, size int, md5 string")
    assert {r.key: r.status for r in integrity.reconcile(w, t).collect()} == {1: "verified", 2: "verified", 3: "differs", 4: "pending", 5: "extra"}
    assert {(r.side, r.key) for r in integrity.two_sided_except(w, t).collect()} == {("missing", 4), ("extra", 5)}


def test_upsert_and_pending(spark):
    s = spark.createDataFrame([("a", 1, "x"), ("b", 1, "y")], "k string, t int, v string")
    c = spark.createDataFrame([("a", 2, "z"), ("c", 1, "n")], "k string, t int, v string")
    assert sorted(tuple(r) for r in integrity.upsert(s, c, ["k"], ["t"]).collect()) == [("a", 2, "z"), ("b", 1, "y"), ("c", 1, "n")]
    e = spark.createDataFrame([("a", "1"), ("b", "1"), ("c", "1")], "k string, signature string")
    st = spark.createDataFrame([("a", "1", True), ("b", "2", True), ("c", "1", False)], "k string, signature string, valid boolean")
    assert {r.k for r in integrity.pending(e, st, "k").collect()} == {"b", "c"}


def test_linkage_reasons(spark):
    c = spark.createDataFrame([("a", 1), ("b", None), ("d", 0)], "key string, outcome int")
    m = spark.createDataFrame([("a",), ("b",), ("c",)], "key string")
    a = spark.createDataFrame([("a", True), ("b", False), ("d", True)], "key string, completed boolean")
    got = {r.key: (r.included, r.reason) for r in linkage.linkage(c, m, a).collect()}
    assert got == {"a": (True, ""), "b": (False, "slide_not_completed;missing_or_unmapped_outcome"), "c": (False, "missing_clinical_row;missing_audit_row;missing_or_unmapped_outcome"), "d": (False, "missing_matrix_column")}
    with pytest.raises(ValueError):
        linkage.roster_with(c, c)


def test_rules_of_text_counts(spark):
    df = spark.createDataFrame([("ok", "1", "a", "3"), ("frac", "1.5", "a", "3"), ("neg", "1", "a", "-1"), ("zero", "1", "a", "0"), ("blank", "1", " ", "1"), ("inf", "1", "a", "inf")], "k string, class_id string, class_name string, count string")
    got = {(r.key, r.code) for r in validate.violations(df, "k", validate.count_rules()).collect()}
    assert got == {("frac", "class_id_not_integral"), ("neg", "count_negative"), ("zero", "count_zero"), ("blank", "blank_class_name"), ("inf", "count_not_integral")}
    with pytest.raises(validate.ConstraintError, match="blank_class_name"):
        validate.enforce(validate.violations(df, "k", validate.count_rules()))
    assert validate.columns(df, ["k", "z"], exact=True) == ["missing column z", "unknown column class_id", "unknown column class_name", "unknown column count"]


def test_files_and_tables(spark, tmp_path):
    for s, rows in (("s1", "1,a,3\n"), ("s2", "")):
        (tmp_path / s / "cell_types").mkdir(parents=True)
        (tmp_path / s / "cell_types/class_counts.csv").write_text("class_id,class_name,count\n" + rows)
        (tmp_path / s / "summary").mkdir()
        (tmp_path / s / "summary/summary.json").write_text(json.dumps({"slide_id": s, "n_cells": 3, "tile_sampling": {"percent_slide": 10.0}} if s == "s1" else {"slide_id": s}))
    (tmp_path / "s1/qc/cell_types").mkdir(parents=True)
    (tmp_path / "s1/qc/cell_types/class_counts.csv").write_text("class_id,class_name,count\n9,x,9\n")
    assert [(r.slide_id, r["count"]) for r in sources.count_tables(spark, str(tmp_path)).collect()] == [("s1", "3")]
    assert {r.slide_id: r.percent_slide for r in sources.slide_summaries(spark, str(tmp_path)).collect()} == {"s1": 10.0, "s2": None}
    names = [r.relative_path for r in sources.files(spark, str(tmp_path), ["*.csv"], ["s1/qc"]).collect()]
    assert names == ["s1/cell_types/class_counts.csv", "s2/cell_types/class_counts.csv"]
    (tmp_path / "t.tsv").write_text("﻿a\tb\n 1 \t\n")
    assert tuple(sources.text_table(spark, str(tmp_path / "t.tsv"), ["a"]).first()) == ("1", None)
    with pytest.raises(validate.ConstraintError):
        sources.text_table(spark, str(tmp_path / "t.tsv"), ["c"])


def test_cell_table_precedence(spark, tmp_path):
    (tmp_path / "c.csv").write_text("id,class_idx,label,cx,cy,polygon\n1,2,Cancer cells,5,6,x\n2,77,Macrophage,7,8,x\n3,,other,9,1,x\n4,1,a,,2,x\n")
    got = {r.cell_id: (r.class_id, r.class_name, r.bbox_x0) for r in readers.cell_table(spark, str(tmp_path / "c.csv")).collect()}
    assert got == {"1": (2, "Lymphocytes", 3.0), "2": (7, "Macrophages", 5.0), "3": (-1, "other", 7.0)}
    (tmp_path / "d.csv").write_text("x,y\n" + "".join(f"{i},1\n" for i in range(30)))
    rows = readers.cell_table(spark, str(tmp_path / "d.csv")).orderBy("cell_id").collect()
    assert [(r.cell_id, r.centroid_x) for r in rows[:2]] == [("cell_000000001", 0.0), ("cell_000000002", 1.0)] and {(r.class_id, r.class_name) for r in rows} == {(-1, "Class -1")} and len(rows) == 30


def test_arrays_and_headers(spark, tmp_path):
    np.savez(tmp_path / "a.npz", x=np.arange(5.0))
    assert [r.value for r in sources.array_payload(spark, str(tmp_path), "x").orderBy("i").collect()] == [0, 1, 2, 3, 4]
    entry = lambda tag, v: struct.pack("<HHII", tag, 4, 1, v)
    (tmp_path / "t.tif").write_bytes(b"II*\0" + struct.pack("<I", 8) + struct.pack("<H", 3) + entry(256, 640) + entry(257, 480) + entry(322, 256) + struct.pack("<I", 0))
    (tmp_path / "bad.tif").write_bytes(b"nope")
    got = {r.path.rpartition("/")[2]: r for r in sources.tiff_layout(spark, str(tmp_path)).collect()}
    assert {r.path.rpartition("/")[2]: (r.size, r.sha256) for r in readers.digests(spark, str(tmp_path)).collect()}["bad.tif"] == (4, hashlib.sha256(b"nope").hexdigest())
    assert (got["t.tif"].levels, got["t.tif"].tiled, got["t.tif"].width, got["t.tif"].height) == (1, True, 640, 480) and got["bad.tif"].error


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("b", 0.1 + 0.2), ("a", 1e-20)], "k string, v double")
    out = df.select("k", writers.significant(F.col("v")).alias("v"))
    sources.csv_single(out, f"{tmp_path}/o", [F.col("k")])
    assert next(tmp_path.glob("o/*.csv")).read_text() == "k,v\na,1e-20\nb,0.3\n"
    sources.staged(df, f"{tmp_path}/p")
    sources.staged(df.limit(1), f"{tmp_path}/p")
    assert sources.current(spark, f"{tmp_path}/p").count() == 1 and len(list(tmp_path.glob("p/v-*"))) == 2
    sources.staged(df, f"{tmp_path}/p")
    assert sources.current(spark, f"{tmp_path}/p").count() == 2 and len(list(tmp_path.glob("p/v-*"))) == 2
    with pytest.raises(Exception):  # a write that fails leaves the current version
        sources.staged(df.select(F.raise_error(F.lit("broken")).alias("x")), f"{tmp_path}/p")
    assert sources.current(spark, f"{tmp_path}/p").count() == 2
    sources.json_document(df, f"{tmp_path}/j", "rows", ["k"])
    assert [r["k"] for r in json.loads(next(tmp_path.glob("j/*.txt")).read_text())["rows"]] == ["a", "b"]


def test_geometry(spark):
    square = [[(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0)], [(0.0, 0.0), (1.0, 1.0)]]
    df = spark.createDataFrame([(square,)], "rings array<array<struct<x:double,y:double>>>")
    f = df.select(*[c.alias(n) for n, c in geo.polygon_features(F.col("rings"), 0.5).items()]).first()
    assert (f.area, f.perimeter, f.vertices) == (1.0, 4.0, 4) and abs(f.compactness - 0.7853981633974483) < 1e-12
    assert df.select(geo.nearest_multiple(F.lit(21), 14), geo.nearest_multiple(F.lit(3), 14)).first()[:] == (14, 14)
    assert df.select(geo.rgb_of_hex(F.lit("#0A10ff"))).first()[0] == [10, 16, 255]


def test_stream_keeps_the_latest(spark, tmp_path):
    schema = "k string, t int, v string"
    for i, rows in enumerate([[("a", 1, "x"), ("b", 1, "y")], [("a", 3, "z"), ("a", 2, "w")]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = streaming.ingest.files_stream(spark, f"{tmp_path}/in", schema)
        streaming.latest_by_key(stream, f"{tmp_path}/out", f"{tmp_path}/cp", ["k"], ["t"]).awaitTermination()
    assert sorted(tuple(r) for r in streaming.latest(spark, f"{tmp_path}/out", schema).collect()) == [("a", 3, "z"), ("b", 1, "y")]
    for i in range(4, 8):
        spark.createDataFrame([("a", i, "n")], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        streaming.latest_by_key(streaming.ingest.files_stream(spark, f"{tmp_path}/in", schema), f"{tmp_path}/out", f"{tmp_path}/cp", ["k"], ["t"]).awaitTermination()
    assert sorted(tuple(r) for r in streaming.latest(spark, f"{tmp_path}/out", schema).collect()) == [("a", 7, "n"), ("b", 1, "y")]
    assert len(list(tmp_path.glob("out/*/_bucket=*"))) == 3  # two versions of one bucket, one of the other
