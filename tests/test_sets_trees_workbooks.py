"""Tables of one run under one pointer, tree listings against a walk, workbooks, and completion markers of runs."""

import io
import os
import zipfile

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyloom.operators import artifacts
from tallyloom.operators.validate import ConstraintError
from tallyloom.sources import workbooks, writers
from tallyloom.streaming import ingest


def tables(spark, run, n=8):
    return {f"t{i}": spark.createDataFrame([(run, i)], "run int, i int") for i in range(n)}


def test_a_set_changes_as_one(spark, tmp_path):
    path = str(tmp_path / "set")
    with pytest.raises(FileNotFoundError):
        writers.current_set(spark, path)
    writers.staged_set(tables(spark, 1), path)
    old = writers.current_set(spark, path)
    broken = tables(spark, 2)
    broken["t5"] = broken["t5"].withColumn("run", F.raise_error(F.lit("no disk")).cast("int"))
    with pytest.raises(Exception, match="no disk"):
        writers.staged_set(broken, path)
    now = writers.current_set(spark, path)
    assert sorted(now) == [f"t{i}" for i in range(8)] and {t.first().run for t in now.values()} == {1}
    assert len([p for p in os.listdir(path) if p.startswith("v-")]) == 1  # what was written of the broken run is gone
    writers.staged_set(tables(spark, 3, 5), path)
    now = writers.current_set(spark, path)
    assert sorted(now) == [f"t{i}" for i in range(5)] and {t.first().run for t in now.values()} == {3}
    assert {t.first().run for t in old.values()} == {1}  # a reader that began before still reads its own run
    for bad in ({}, {"a/b": broken["t1"]}, {"_a": broken["t1"]}):
        with pytest.raises(ValueError):
            writers.staged_set(bad, path)


def walked(paths, depth, lines, shown):
    """The listing by folders in memory, one at a time."""
    out, todo = [], [()]
    files = {tuple(p.split("/")) for p in paths if p}
    while todo:
        at = todo.pop(0)
        inside = {f[len(at):] for f in files if f[: len(at)] == at and len(f) > len(at)}
        folders = sorted({f[0] for f in inside if len(f) > 1 and not f[0].startswith(".")}) if len(at) < depth else []
        here = sorted(f[0] for f in inside if len(f) == 1 and not f[0].startswith("."))
        out += [("  " * len(at) + f"├── {d}/", True) for d in folders] + [("  " * len(at) + f"├── {f}", True) for f in here[:shown]]
        out += [("  " * len(at) + f"└── ... {len(here) - shown} more file(s)", False)] if len(here) > shown else []
        todo = [(*at, d) for d in folders] + todo
    for i, (_, counted) in enumerate(out):
        if counted and i + 1 >= lines:
            return [x for x, _ in out[:i]] + ["  ... [truncated]"]
    return [x for x, _ in out]


@pytest.mark.parametrize("depth,lines,shown", [(4, 500, 25), (2, 500, 3), (1, 6, 2), (0, 9, 2), (3, 12, 1), (4, 4, 2), (4, 5, 2), (4, 1, 25)])
def test_tree_like_a_walk(spark, depth, lines, shown):
    paths = ["a/b/c/d/e/f.txt", "a/z.txt", "a/b.txt", "a/b/x", "top", ".hid/x", "a/.h/y", "a/b/.z", "ü/1", "a-/q", "b/1", "b/2", "b/3", "b/4", "b/c/1", "top", None, "a/b/c/9", "only/.h/x"]
    rows = [("r", p) for p in paths] + [("s", "one"), (None, "two"), ("t", None)]
    got = {}
    for r in artifacts.tree_lines(spark.createDataFrame(rows, "root string, relative_path string"), "root", depth, lines, shown).orderBy("place").collect():
        got.setdefault(r.root, []).append(r.line)
    assert got["r"] == ["r", *walked(paths, depth, lines, shown)]
    assert got["s"] == ["s", *walked(["one"], depth, lines, shown)] and got[None] == ["", *walked(["two"], depth, lines, shown)] and got["t"] == ["t"]


def test_tree_of_nothing(spark):
    assert artifacts.tree_lines(spark.createDataFrame([], "root string, relative_path string"), "root").count() == 0


def by_hand(sheet_xml, shared="", styles="", sheets='<sheet name="A" r:id="r1"/><sheet name="B &amp; C" r:id="r2"/>', properties=""):
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f"<workbook {main}>{properties}<sheets>{sheets}</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="r1" Target="worksheets/sheet1.xml"/><Relationship Id="r2" Target="/xl/worksheets/sheet2.xml"/></Relationships>')
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {main}><sheetData/></worksheet>")
        z.writestr("xl/worksheets/sheet2.xml", f"<worksheet {main}><sheetData>{sheet_xml}</sheetData></worksheet>")
        if shared:
            z.writestr("xl/sharedStrings.xml", f"<sst {main}>{shared}</sst>")
        if styles:
            z.writestr("xl/styles.xml", f"<styleSheet {main}>{styles}</styleSheet>")
    return out.getvalue()


def test_cells_of_every_kind(spark):
    shared = "<si><t>plain</t></si><si><r><t>ri</t></r><r><t>ch</t></r><rPh><t>no</t></rPh></si>"
    styles = """<numFmts><numFmt numFmtId="170" formatCode="yyyy\\-mm"/><numFmt numFmtId="171" formatCode="0.0&quot;days&quot;"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="170"/><xf numFmtId="171"/></cellXfs>"""
    row = """<row r="3"><c r="A3" t="s"><v>0</v></c><c r="C3" t="s"><v>1</v></c><c r="D3" t="b"><v>1</v></c><c r="E3" t="e"><v>#N/A</v></c><c r="F3"><v>0.10</v></c><c r="G3" s="1"><v>45000</v></c><c r="H3" s="2"><v>45000.5</v></c><c r="I3" s="3"><v>2</v></c><c r="AB3" t="str"><v>far</v></c></row><row><c><v>7</v></c><c t="inlineStr"><is><t> in </t></is></c></row>"""
    books = spark.createDataFrame([("a", by_hand(row, shared, styles)), ("b", b"PK no"), ("c", None), ("d", by_hand('<row r="1"><c><v>1</v></c></row><row'))], "path string, content binary")
    got = {(r.path, r.row): r for r in workbooks.sheet_rows(books, "B & C").collect()}
    assert got["a", 3].cells == ["plain", None, "rich", "true", None, "0.10", "2023-03-15", "2023-03-15 12:00:00", "2", *[None] * 18, "far"]
    assert got["a", 4].cells == ["7", " in "] and got["d", 1].cells == ["1"]
    assert all(got[p, -1].problem.startswith("not_a_workbook") for p in "bcd") and len(got) == 6
    missing = workbooks.sheet_rows(books.where("path = 'a'"), "gone").first()
    assert (missing.row, missing.problem) == (0, "sheet_missing") and workbooks.sheet_rows(books.where("path = 'a'")).count() == 0
    old = by_hand('<row><c s="1"><v>1</v></c></row>', styles=styles, properties='<workbookPr date1904="1"/>')
    assert workbooks.sheet_rows(spark.createDataFrame([("o", old)], "path string, content binary"), "B & C").first().cells == ["1904-01-02"]


def test_tables_of_workbooks(spark):
    line = lambda *v: "<row>" + "".join(f'<c t="inlineStr"><is><t>{x}</t></is></c>' if x else "<c/>" for x in v) + "</row>"
    made = {
        "good": line("", "") + line("ＩＤ", " big   size ", "") + line("x", "1", "z") + line("", " ") + line("y"),
        "turned": line("big size", "ID") + line("2", "w"), "twice": line("ID", "ID", "big size") + line("1"), "short": line("ID") + line("1"), "empty": line("", ""),
    }
    books = spark.createDataFrame([(k, by_hand(x)) for k, x in made.items()] + [("bad", b"x")], "path string, content binary")
    got = sorted((r.path, r.row, r.ID, r["big size"], (r.problem or "")[:14]) for r in workbooks.workbook_tables(books, ["ID", "big size"], "B & C").collect())
    assert got == [("bad", -1, None, None, "not_a_workbook"), ("empty", 0, None, None, "no_header"), ("good", 3, "x", "1", ""), ("good", 5, "y", None, ""), ("short", 1, None, None, "header_lacks"), ("turned", 2, "w", "2", ""), ("twice", 1, None, None, "header_repeats")]


def test_clinical_workbook(spark, tmp_path):
    table = pd.DataFrame({"Patient  ID": ["a<b", "c", None], "Age": [61, 70, None], "Fit": [True, False, None]})
    (tmp_path / "w.xlsx").write_bytes(workbooks.workbook(table, 'The "one"'))
    t = workbooks.clinical_workbook(spark, str(tmp_path / "w.xlsx"), required=["Age"])
    assert t.columns == ["Patient ID", "Age", "Fit"] and [tuple(r) for r in t.collect()] == [("a<b", "61.0", "true"), ("c", "70.0", "false")]
    assert workbooks.clinical_workbook(spark, str(tmp_path / "w.xlsx"), 'The "one"').count() == 2
    with pytest.raises(ConstraintError, match="sheet_missing"):
        workbooks.clinical_workbook(spark, str(tmp_path / "w.xlsx"), "other")
    with pytest.raises(ConstraintError, match="missing column Sex"):
        workbooks.clinical_workbook(spark, str(tmp_path / "w.xlsx"), required=["Sex"])
    (tmp_path / "v.xlsx").write_bytes(workbooks.workbook(pd.DataFrame([[1, 2]], columns=["a", "a"])))
    with pytest.raises(ConstraintError, match="more than once"):
        workbooks.clinical_workbook(spark, str(tmp_path / "v.xlsx"))


def test_markers_over_batches_and_restarts(spark, tmp_path):
    """The changes of each batch by a run that ends and starts anew between all of them; then those of one batch of all."""
    at = lambda minute: pd.Timestamp("2024-01-01") + pd.Timedelta(minutes=minute)
    batches = [
        [("a", 0, "started"), ("b", 0, "finished"), ("c", 1, "started"), (None, 1, "started"), ("d", 2, "other")],
        [("a", 3, "finished"), ("c", 4, "started"), ("e", 5, "started")],  # a ends after a restart
        [("f", 40, "started"), ("f", 41, "finished"), ("f", 42, "finished")],  # c and e have gone past 30 minutes once time is there
        [("e", 41, "finished"), ("a", 43, "started"), ("z", 44, "started")],
        [("z", 200, "finished"), ("y", 201, "started")],
    ]
    store, value = ingest.STATE_STORE
    before = spark.conf.get(store, None)
    spark.conf.set(store, value)
    try:
        def run(name):
            stream = ingest.files_stream(spark, str(tmp_path / name), "slide_id string, at timestamp, report string")
            changes = ingest.run_markers(stream, 30 * 60_000, "0 seconds")
            q = changes.writeStream.format("parquet").outputMode("append").option("checkpointLocation", str(tmp_path / f"{name}-progress")).trigger(availableNow=True).start(str(tmp_path / f"{name}-out"))
            q.awaitTermination()
            return spark.read.schema("slide_id string, at timestamp, status string").parquet(str(tmp_path / f"{name}-out"))

        for i, rows in enumerate(batches):
            pdf = pd.DataFrame([(s, at(m), k) for s, m, k in rows], columns=["slide_id", "at", "report"])
            spark.createDataFrame(pdf, "slide_id string, at timestamp, report string").coalesce(1).write.mode("append").parquet(str(tmp_path / "many"))
            got = run("many")
            if i == 1:
                assert sorted((r.slide_id, r.status) for r in ingest.markers(got).collect()) == [("a", "published"), ("c", "withdrawn"), ("e", "withdrawn")]
        spark.read.parquet(str(tmp_path / "many")).coalesce(1).write.parquet(str(tmp_path / "one"))
        want = [("a", 0, "withdrawn"), ("a", 3, "published"), ("a", 43, "withdrawn"), ("a", 73, "expired"), ("c", 1, "withdrawn"), ("c", 4, "withdrawn"), ("c", 34, "expired"), ("e", 5, "withdrawn"), ("e", 35, "expired"),
                ("f", 40, "withdrawn"), ("f", 41, "published"), ("y", 201, "withdrawn"), ("z", 44, "withdrawn"), ("z", 74, "expired")]
        shown = lambda df: sorted((r.slide_id, (pd.Timestamp(r.at) - pd.Timestamp("2024-01-01")).total_seconds() / 60, r.status) for r in df.collect())
        assert shown(got) == want
        assert shown(run("one")) == want
    finally:
        spark.conf.set(store, before) if before else spark.conf.unset(store)
