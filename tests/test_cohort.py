import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tallyloom.operators import cohort, validate

COUNTS = "slide_id string, class_id int, class_name string, n long"
SUMMARY = "slide_id string, n_cells long, zero_detections boolean"
MANIFEST = "slide_id string, completed boolean, selected boolean, returncode int"


def tables(spark, counts, summaries, manifest):
    return spark.createDataFrame(counts, COUNTS), spark.createDataFrame(summaries, SUMMARY), spark.createDataFrame(manifest, MANIFEST)


BASE = (
    [("s10", 1, "Cancer cell", 3), ("s10", 2, "Lymphocytes", 1), ("s2", 1, "Cancer cell", 5), ("stale", 1, "Cancer cell", 9)],
    [("s10", 4, False), ("s2", 5, False), ("zero", 0, True), ("stale", 9, False)],
    [("s10", True, None, 0), ("s2", True, True, None), ("zero", True, True, 0), ("bad", False, True, 1), ("skip", True, False, 0)],
)


def test_failed_slides_are_audited_and_have_no_column(spark):
    out = cohort.aggregate(*tables(spark, *BASE))
    assert out.counts.columns == ["class_id", "cell_type", "s2", "s10", "zero"]
    assert [tuple(r) for r in out.counts.collect()] == [(1, "Cancer cell", 5, 3, 0), (2, "Lymphocytes", 0, 1, 0)]
    audit = {r.slide_id: (r.included, r.status, r.reason, r.total_cells) for r in out.audit.collect()}
    assert audit["bad"] == (False, "excluded_incomplete", "incomplete", None)
    assert audit["skip"] == (False, "excluded_unselected", "unselected", None)
    assert audit["zero"] == (True, "included", None, 0) and "stale" not in audit
    fractions = [tuple(r)[2:] for r in out.fractions.collect()]
    assert fractions == [(1.0, 0.75, 0.0), (0.0, 0.25, 0.0)]
    assert tuple(out.summary.first()) == (5, 3, 2, 9, 2, 2)


def test_slides_are_pooled(spark):
    m = spark.createDataFrame([(s, "pool") for s in ("s10", "s2", "zero", "bad", "skip")], "slide_id string, sample_id string")
    out = cohort.aggregate(*tables(spark, *BASE), sample_map=m)
    assert [tuple(r) for r in out.counts.collect()] == [(1, "Cancer cell", 8), (2, "Lymphocytes", 1)]


@pytest.mark.parametrize(
    ("counts", "summaries", "code"),
    [
        ([("s2", 1, "a", 5)], [("s2", 6, False)], "total_differs"),
        ([("s2", 1, "a", 5)], [], "no_summary"),
        ([], [("s2", 0, False)], "no_counts"),
        ([("s2", 1, "a", 5)], [("s2", 5, True)], "zero_flag_differs"),
    ],
)
def test_broken_slides_are_refused(spark, counts, summaries, code):
    with pytest.raises(validate.ConstraintError, match=code):
        cohort.aggregate(*tables(spark, counts, summaries, [("s2", True, True, 0)]))


def test_map_must_cover_the_roster_and_not_be_reserved(spark):
    for rows in ([("s2", "x")], [(s, "Class_ID") for s in ("s10", "s2", "zero", "bad", "skip")]):
        with pytest.raises(validate.ConstraintError):
            cohort.aggregate(*tables(spark, *BASE), sample_map=spark.createDataFrame(rows, "slide_id string, sample_id string"))


def test_class_mapping_must_be_a_function(spark):
    bad = spark.createDataFrame([(1, "a"), (2, "a"), (-1, "x"), (-1, "y")], "class_id int, class_name string")
    assert [tuple(r) for r in validate.class_mapping(bad).collect()] == [("name_has_ids", "a", 2)]


@pytest.mark.parametrize(
    ("rows", "expected", "mixed", "want"),
    [
        ([(100.0, 1), (None, 1)], 100.0, False, "missing_percent"), ([(10.0, 1)], 100.0, False, "unexpected_percent"), ([(10.0, None)], None, False, "missing_seed"),
        ([(10.0, 1), (None, None)], None, False, "legacy_and_sampled"), ([(10.0, 1), (20.0, 1)], None, False, "mixed_sampling"), ([(100.0, 1), (100.0, 2)], None, False, "mixed_sampling"),
        ([(10.0, 1), (20.0, 1)], None, True, None), ([(100.0, None), (100.0, None)], 100.0, False, None),
    ],
)
def test_sampling_rules_in_order(spark, rows, expected, mixed, want):
    df = spark.createDataFrame(rows, "percent_slide double, random_seed long")
    assert cohort.homogeneity(df, expected, mixed).first().violation == want


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 3), st.integers(0, 50)), min_size=1, max_size=12, unique_by=lambda r: r[:2]))
def test_fractions_add_up_to_one_or_nothing(spark, rows):
    long = spark.createDataFrame([(s, c, f"n{c}", n) for s, c, n in rows], "sample_id string, class_id int, cell_type string, n long")
    shares = cohort.fractions(long).collect()
    for s in {r.sample_id for r in shares}:
        total = sum(r.fraction for r in shares if r.sample_id == s)
        assert abs(total - (1 if sum(n for t, _, n in rows if t == s) else 0)) < 1e-12
    wide = cohort.matrix(long, ["a", "b", "c"])
    back = {(r.sample_id, r.class_id): r.n for r in cohort.unpivoted(wide, ["class_id", "cell_type"]).collect() if r.n}
    assert back == {(s, c): n for s, c, n in rows if n}


def test_no_samples_give_a_header_only(spark):
    out = cohort.aggregate(*tables(spark, [], [], [("bad", False, True, 1)]))
    assert out.counts.columns == ["class_id", "cell_type"] and out.counts.count() == 0
