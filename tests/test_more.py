import pytest
from pyspark.sql import functions as F

from tallyloom.operators import matrices, spatial, validate
from tallyloom.plans import pipelines
from tallyloom.sources import discovery


def test_discovery(spark, tmp_path):
    for p in ("c2/a_L0_rgb.tif", "c2/a_L2_rgb.tif", "c10/a_L0_rgb.tif", ".hidden/x_L0_rgb.tif", "out/y_L0_rgb.tif"):
        (tmp_path / p).parent.mkdir(exist_ok=True)
        (tmp_path / p).write_bytes(b"x" * len(p))
    got = discovery.discover(spark, str(tmp_path), ["*_L?_rgb.tif"], ["out"], "optional").collect()
    assert [(r.sample_id, r.l2_state) for r in got] == [("c2_a", "present"), ("c10_a", "missing")] and len(got[0].fingerprint) == 16
    with pytest.raises(validate.ConstraintError, match="companion_missing"):
        discovery.discover(spark, str(tmp_path), ["*_L?_rgb.tif"], ["out"], "required")
    with pytest.raises(validate.ConstraintError, match="no slide"):
        discovery.discover(spark, str(tmp_path), ["*.nothing"])
    got = discovery.discover(spark, str(tmp_path), ["*_L0_rgb.tif"], ["out"], include=["c1*"]).collect()
    assert [r.sample_id for r in got] == ["c10_a"] and got[0].l2_state == "not_used"


def test_repeated_ids_are_refused(spark):
    found = spark.createDataFrame([("a b.tif", 1), ("a_b.tif", 1)], "relative_path string, length long").withColumn("modified", F.timestamp_seconds(F.lit(0)))
    with pytest.raises(validate.ConstraintError):
        discovery.manifest(found)


def test_rosters_and_caches(spark):
    w, r = spark.createDataFrame([("a",), ("b",)], "sample_id string"), spark.createDataFrame([("a", "counts"), ("a", "summary"), ("b", "counts")], "sample_id string, artifact string")
    assert {x.sample_id: x.completed for x in discovery.workflow_roster(w, r).collect()} == {"a": True, "b": False}
    a = spark.createDataFrame([("s", "x", 1, True), ("s", "y", 0, True), ("t", "x", 1, True), ("t", "y", 2, True)], "slide_id string, artifact string, length long, ok boolean")
    assert {x.slide_id: (x.complete, x.missing) for x in discovery.artifacts_complete(a, ["x", "y"]).collect()} == {"s": (False, "y"), "t": (True, "")}
    c = spark.createDataFrame([(True, True, None), (False, True, True), (False, True, False), (False, False, None)], "tiled boolean, cached boolean, provenance_matches boolean")
    assert [x.action for x in discovery.cache_decision(c).collect()] == ["use_source", "reuse", "rebuild", "build"]


def test_thinning_a_region(spark):
    rows = [("s", f"c{i}", int(i % 10 == 0), float(i % 40), float(i // 40)) for i in range(800)]
    cells = spark.createDataFrame(rows, "slide_id string, cell_id string, class_id int, x double, y double")
    assert spatial.thinned(cells, 1000, 5, 0, 0).count() == 800
    n = spatial.thinned(cells, 60, 2, 0, 0, 1, 10)
    assert n.count() == 60 and n.where("class_id = 1").count() >= 10


def test_matrices(spark):
    long = spark.createDataFrame([("a", "x", 2), ("b", "y", 3)], "sample_id string, cell_type string, n long")
    samples = spark.createDataFrame([("a",), ("b",), ("none",)], "sample_id string")
    got = {r.sample_id: (r.x, r.y, r.has_counts) for r in matrices.sample_rows(long, samples, matrices.class_order(long)).collect()}
    assert got == {"a": (2, 0, True), "b": (0, 3, True), "none": (None, None, False)} and matrices.class_order(long) == ["y", "x"]
    f = spark.createDataFrame([("a", 0.5), ("a", 0.5), ("b", 0.0), ("c", 0.4)], "sample_id string, fraction double")
    assert [r.sample_id for r in matrices.total_problems(f).collect()] == ["c"]
    s = spark.createDataFrame([("k", 0, 1.0, "x"), ("l", 0, 1.0, "x")], "k string, level int, mpp double, sha string")
    e = spark.createDataFrame([("k", 0, 1.0 + 1e-12, "x"), ("l", 0, 1.1, "x"), ("m", 0, 1.0, "x")], "k string, level int, mpp double, sha string")
    assert {(r.k, r.problem) for r in matrices.entry_problems(s, e, ["k", "level"], ["sha"], ["mpp"]).collect()} == {("l", "mpp"), ("m", "missing")}


def test_analysis(spark):
    rows = [(f"case {i}.svs", "Yes" if i % 2 else "no", float(i % 2 * 5 + i % 7), "ab"[i % 2]) for i in range(40)] + [("case 90", "Yes", 1.0, None)]
    clinical = spark.createDataFrame(rows, "id string, status string, age double, sex string")
    samples = spark.createDataFrame([(f"CASE-{i}",) for i in range(40)], "sample_id string")
    audit = spark.createDataFrame([(f"case_{i}", i != 3) for i in range(40)], "sample_id string, included boolean")
    out = pipelines.analyse(clinical, "id", "status", "yes", "NO", samples, audit, ["age"], ["sex"], model="dummy", folds=3, repeats=20)
    assert out.cohort.count() == 39 and out.predictions.count() == 39
    reasons = {r.key: r.reason for r in out.linked.where("not included").collect()}
    assert reasons == {"CASE-3": "slide_not_completed", "CASE-90": "missing_matrix_column;missing_audit_row"}
    assert {r.feature: r.kind for r in out.univariate.collect()} == {"age": "mann_whitney", "sex": "fisher"}
    spans = {r.metric: r for r in out.intervals.collect()}
    assert len(spans) == 10 and all(r.n_units == 39 for r in spans.values()) and spans["roc_auc"].low <= spans["roc_auc"].point <= spans["roc_auc"].high
    assert out.problems.count() == 0 and {r.source_column: r.n_levels for r in out.manifest.collect()} == {"age": None, "sex": 2}
    assert out.flow.first().asDict() == {"clinical": 41, "completed": 39, "included": 39, "negative": 20, "positive": 19}
    with pytest.raises(validate.ConstraintError):
        pipelines.analyse(clinical.unionAll(clinical.limit(1)), "id", "status", "yes", "no", samples, audit, ["age"], ["sex"])


def test_reports(spark):
    cells = spark.createDataFrame([("s", f"c{i}", i % 3, float(i % 20 * 10), float(i // 20 * 10), 0.0, 0.0, float(i % 5 + 1), float(i % 7 + 1)) for i in range(200)], "slide_id string, cell_id string, class_id int, x double, y double, bbox_x0 double, bbox_y0 double, bbox_x1 double, bbox_y1 double")
    boxes, by_class = pipelines.spatial_report(cells, 50, 3, 200, 100)
    assert boxes.count() == 3 and by_class.count() >= 3
    assert pipelines.embedding_report(cells, 50).count() == 50
    e = spark.createDataFrame([("a", "1"), ("b", "2")], "k string, signature string")
    s = spark.createDataFrame([("a", "1", True)], "k string, signature string, valid boolean")
    assert {r.k: r.todo for r in pipelines.resume_plan(e, s, "k").collect()} == {"a": False, "b": True}
