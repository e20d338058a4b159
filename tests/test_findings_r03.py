"""Findings of round 3: rows that differed from SQL, and steps that grew faster than their input or held it in one task."""

import duckdb

from tallyloom.plans import QUERIES, SQL


def rows_of(spark, folder, name, tables):
    """A query's rows by Spark and by DuckDB, sorted."""
    con = duckdb.connect()
    for t in tables:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet/*.parquet')")
    cursor = con.execute(SQL[name])
    columns = [c[0] for c in cursor.description]
    return sorted(map(tuple, QUERIES[name](spark, str(folder)).select(*columns).collect())), sorted(cursor.fetchall())


def test_draw_order_below_a_pixel(spark, tmp_path):
    """Areas that differ by less than 1 are in order, against that of the ids."""
    rows = "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double"
    spark.createDataFrame([(k, 1, 1, 1, 1.0, 0.0, d, 0.0) for k, d in [(1, 0.0102), (2, 0.0101), (3, 0.0101), (4, 0.01)]], rows).write.parquet(f"{tmp_path}/lineitem.parquet")
    got, want = rows_of(spark, tmp_path, "draw_order", ["lineitem"])
    assert got == want and [r[1] for r in got] == [4, 2, 3, 1]


def test_counts_of_draws(spark):
    """Rows counted by value without a row a draw are those that the draws themselves give, over several chunks and blocks."""
    from pyspark.sql import functions as F

    from tallyloom.operators import sampling

    df = spark.range(1500).select(F.col("id"), F.when(F.col("id") % 7 != 0, F.col("id") % 2).alias("y"), (F.col("id") % 5 / 5).alias("p"))
    held, sampling.HELD = sampling.HELD, 100 * 20
    try:
        got = sampling.bootstrap_counts(df, "id", "y", 20, 4, ["y", "p"])
        plan = got._jdf.queryExecution().executedPlan().toString()
        got = sorted(map(tuple, got.select("repeat", "y", "p", "drawn").collect()))
    finally:
        sampling.HELD = held
    draws = sampling.bootstrap_draws(df, "id", "y", 20, 4).groupBy("repeat", "y", "p").agg(F.count(F.lit(1)).alias("drawn"))
    assert got == sorted(map(tuple, draws.collect()))
    assert "FlatMapCoGroupsInArrow" in plan and "Generate explode(sequence(1, 20" not in plan


def below_first_exchange(plan):
    """Whether an aggregate stands between a plan's scan and the exchange above it."""
    lines = [x for x in plan.split("== Initial Plan ==")[-1].splitlines()]
    at = max(i for i, x in enumerate(lines) if "Scan" in x)
    while "Exchange" not in lines[at]:
        if "Aggregate" in lines[at]:
            return True
        at -= 1
    return False


def test_files_are_dealt_out_before_they_are_grouped(spark):
    """A task that reads files or lines groups none of them, so its memory doesn't grow with a file."""
    from tallyloom.operators import artifacts, release

    files = spark.createDataFrame([(1, 1, "a", True), (1, 1, "a", True), (1, 1, "b", True), (1, 2, "a", True), (1, 2, "b", False), (2, 1, "a", True)], "slide int, patch int, artifact string, valid boolean")
    got = artifacts.patch_reports(files, spark.createDataFrame([(1, 2), (2, 0), (3, 1)], "slide int, n int"), ["a", "b"])
    assert sorted(map(tuple, got.collect())) == [(1, False, 1), (2, False, None), (3, False, 2)]
    assert not below_first_exchange(artifacts.patch_reports(files, files.select("slide", "patch").withColumnRenamed("patch", "n"), ["a"])._jdf.queryExecution().executedPlan().toString())
    lines = spark.createDataFrame([("0" * 64 + "  x",), ("1" * 64 + "  x",), ("none",)], "value string")
    rows = spark.createDataFrame([("x", "1" * 64), ("y", "2" * 64)], "filename string, sha256 string")
    got = release.checksum_problems(lines, rows)
    assert sorted(map(tuple, got.collect())) == [("bad_line", "none"), ("duplicate", "x"), ("missing", "y")]
    assert "REPARTITION_BY_COL" in got._jdf.queryExecution().executedPlan().toString()


def test_one_read_and_write_of_a_state_a_batch():
    """However many reports a slide has in a batch."""
    import pandas as pd

    from tallyloom.streaming import ingest

    class Value:
        def __init__(self):
            self.value, self.calls = None, 0

        def exists(self):
            self.calls += 1
            return self.value is not None

        def get(self):
            self.calls += 1
            return self.value

        def update(self, value):
            self.calls, self.value = self.calls + 1, value

        def clear(self):
            self.calls, self.value = self.calls + 1, None

    class Handle:
        def __init__(self):
            self.state, self.timers, self.calls = Value(), set(), 0

        def getValueState(self, *_):
            return self.state

        def registerTimer(self, at):
            self.calls += 1
            self.timers.add(at)

        def deleteTimer(self, at):
            self.calls += 1
            self.timers.remove(at)

    m, h = ingest._Markers(10), Handle()
    m.init(h)
    batch = lambda *r: [tuple(x) for x in next(m.handleInputRows(("s",), iter([pd.DataFrame(r, columns=["millis", "report"])]), None)).itertuples(index=False)]
    reports = [(i * 20, "started") for i in range(50)] + [(i * 20 + 5, "finished") for i in range(49)]
    out = batch(*reports)
    assert len(out) == 99 and out[:2] == [("s", 0, "withdrawn"), ("s", 5, "published")] and h.state.value == (980,) and h.timers == {990}
    assert h.state.calls + h.calls <= 6
    # another start replaces the open run, whose end then comes too late
    assert batch((985, "started"), (999, "finished")) == [("s", 985, "withdrawn"), ("s", 995, "expired")]
    assert h.state.value is None and not h.timers


def test_sort_key_is_made_once_a_row(spark):
    from tallyloom.functions import text as tx

    df = tx.in_natural_order(spark.createDataFrame([("s10",), ("s9",), ("S2",)], "id string"), "id")
    assert [r.id for r in df.collect()] == ["S2", "s9", "s10"]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp" not in next(x for x in plan.splitlines() if "Sort" in x)


def test_medians_of_all_columns_together(spark):
    from pyspark.sql import functions as F

    from tallyloom.operators import features as ft

    df = spark.range(9).select("id", *[F.when(F.col("id") % (i + 2) != 0, F.col("id") * 1.5 + i).alias(f"c{i}") for i in range(4)], F.lit(None).cast("double").alias("none"))
    got = ft.median_filled(df, ["c0", "c1", "c2", "c3", "none"]).where("id = 0").select("c0", "c1", "c2", "c3", "none").first()
    assert got.none is None
    for i in range(4):
        assert got[i] == sorted(r[0] for r in df.where(f"c{i} is not null").selectExpr(f"percentile(c{i}, 0.5)").collect())[0]
    assert "Join" not in ft.median_filled(df, ["c0", "c1"])._jdf.queryExecution().optimizedPlan().toString()
