"""Workbooks: zipped XML sheets as rows of text, read from binary columns by many tasks; and a plain writer of them."""

from __future__ import annotations

import datetime as dt
import io
import re
import unicodedata
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from xml.etree import ElementTree
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.validate import ConstraintError

#: The format's namespaces, and the numbers of its built-in formats that show dates.
MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
RELATION = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
DATE_FORMATS = {14, 15, 16, 17, 18, 19, 20, 21, 22, 45, 46, 47}

ROWS = "path string, sheet string, row int, cells array<string>, problem string"
#: Rows that a task hands over at a time.
BATCH = 1000


def _column(reference: str) -> int:
    """AB12 to 27."""
    n = 0
    for c in reference:
        if not c.isalpha():
            break
        n = n * 26 + ord(c.upper()) - 64
    return n - 1


def _texts(part) -> list[str]:
    """Shared strings; runs of rich text are joined, reading aids are left out."""
    out = []
    for _, e in ElementTree.iterparse(part):
        if e.tag == MAIN + "rPh":
            e.clear()
        elif e.tag == MAIN + "si":
            out.append("".join(t.text or "" for t in e.iter(MAIN + "t")))
            e.clear()
    return out


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    """Numbers of the cell styles that show a date or a time."""
    if "xl/styles.xml" not in book.namelist():
        return set()
    root = ElementTree.fromstring(book.read("xl/styles.xml"))
    dates = set(DATE_FORMATS)
    for f in root.iter(MAIN + "numFmt"):
        code = re.sub(r'"[^"]*"|\\.|\[[^\]]*\]', "", f.get("formatCode", ""))
        if re.search("[dmyhs]", code.lower()) and "general" not in code.lower():
            dates.add(int(f.get("numFmtId")))
    styles = root.find(MAIN + "cellXfs")
    return {i for i, x in enumerate(styles if styles is not None else ()) if int(x.get("numFmtId", 0)) in dates}


def _date(serial: float, from_1904: bool) -> str:
    """Days since the workbook's epoch as text; its 29 February 1900, a day that never was, is the 1 March."""
    epoch = dt.datetime(1904, 1, 1) if from_1904 else dt.datetime(1899, 12, 31) if serial < 60 else dt.datetime(1899, 12, 30)
    at = epoch + dt.timedelta(seconds=round(serial * 86400))
    return at.strftime("%Y-%m-%d" if at.time() == dt.time() else "%Y-%m-%d %H:%M:%S")


def _sheet_rows(content: bytes, wanted: str | None) -> Iterator[tuple[str | None, int, list[str | None] | None, str | None]]:
    """(sheet, row, cells, problem) of one workbook; only its shared strings are held whole."""
    try:
        book = zipfile.ZipFile(io.BytesIO(content))
        root = ElementTree.fromstring(book.read("xl/workbook.xml"))
        links = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
        sheets = [(s.get("name"), links[s.get(RELATION)]) for s in root.iter(MAIN + "sheet")]
        found = next((s for s in sheets if wanted is None or s[0] == wanted), None)
        if found is None:
            yield wanted, 0, None, "sheet_missing"
            return
        name, target = found
        properties = root.find(MAIN + "workbookPr")
        from_1904 = properties is not None and properties.get("date1904") in ("1", "true")
        dates = _date_styles(book)
        shared = _texts(book.open("xl/sharedStrings.xml")) if "xl/sharedStrings.xml" in book.namelist() else []
        part = target.lstrip("/") if target.startswith("/") else f"xl/{target}"
        at = 0
        for _, e in ElementTree.iterparse(book.open(part)):
            if e.tag != MAIN + "row":
                continue
            at = int(e.get("r", at + 1))
            cells: list[str | None] = []
            for c in e.iter(MAIN + "c"):
                i = _column(c.get("r", "")) if c.get("r") else len(cells)
                cells += [None] * (i + 1 - len(cells))
                kind, value = c.get("t", "n"), c.findtext(MAIN + "v")
                if kind == "inlineStr":
                    cells[i] = "".join(t.text or "" for t in c.iter(MAIN + "t"))
                elif value is None or kind == "e":
                    cells[i] = None
                elif kind == "s":
                    cells[i] = shared[int(value)]
                elif kind == "b":
                    cells[i] = "true" if value == "1" else "false"
                elif kind == "n" and int(c.get("s", 0)) in dates:
                    cells[i] = _date(float(value), from_1904)
                else:
                    cells[i] = value
            yield name, at, cells, None
            e.clear()
    except (zipfile.BadZipFile, zlib.error, ElementTree.ParseError, KeyError, ValueError, IndexError, EOFError, OverflowError) as wrong:
        yield wanted, -1, None, f"not_a_workbook: {type(wrong).__name__}"


@F.pandas_udf(T.ArrayType(T.StringType()))
def _names(x: pd.Series) -> pd.Series:
    """Headers in normal form NFKC with single spaces; blank ones null."""
    return x.map(lambda v: None if v is None else [None if n is None else " ".join(unicodedata.normalize("NFKC", n).split()) or None for n in v])


def sheet_rows(books: DataFrame, sheet: str | None = None) -> DataFrame:
    """(path, sheet, row, cells, problem) of books (path, content): the rows of one sheet, by default the first, cells as text.

    Whole numbers and decimals stay as they are written in the file, truth values are true or false, dates are ISO text, errors and empty cells null; rows are numbered from 1 and may
    have gaps. A content that is no workbook, null or damaged is one row with problem and row -1 after the rows read before the damage; a sheet that is missing one with row 0.
    A workbook is read by one task; many are spread.
    """

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path, content in zip(frame["path"], frame["content"]):
                rows = []
                for name, row, cells, problem in _sheet_rows(content or b"", sheet):
                    rows.append((path, name, row, cells, problem))
                    if len(rows) == BATCH:
                        yield pd.DataFrame(rows, columns=["path", "sheet", "row", "cells", "problem"])
                        rows = []
                yield pd.DataFrame(rows, columns=["path", "sheet", "row", "cells", "problem"])

    return books.select("path", "content").mapInPandas(read, ROWS)


def workbook_tables(books: DataFrame, columns: list[str], sheet: str | None = None) -> DataFrame:
    """path, row and columns as text, of workbooks whose sheets have a header with those columns, each in its own order; (path, problem) rows are kept with null columns.

    The header is a sheet's first row; names are NFKC text with single spaces. A problem is that of sheet_rows(), header_repeats, header_lacks or no_header. Rows without any value
    are left out, blank texts are null.
    """
    rows = sheet_rows(books, sheet)
    text = F.transform("cells", lambda c: F.when(F.trim(c) != "", F.trim(c)))
    filled = rows.withColumn("cells", text).where(F.col("problem").isNotNull() | F.exists("cells", lambda c: c.isNotNull()))
    first = filled.where("problem is null").groupBy("path").agg(F.min_by(F.col("cells"), F.col("row")).alias("_names"), F.min("row").alias("_first"))
    names = first.select("path", "_first", _names("_names").alias("_names"))
    known = F.filter("_names", lambda n: n.isNotNull())
    lacks = F.size(F.array_except(F.array(*[F.lit(c) for c in columns]), "_names")) > 0
    names = names.withColumn("_wrong", F.when(F.size(F.array_distinct(known)) < F.size(known), "header_repeats").when(lacks, "header_lacks"))
    body = filled.where("problem is null").join(names.where("_wrong is null"), "path").where(F.col("row") > F.col("_first"))
    value = lambda c: F.get("cells", (F.array_position("_names", c) - 1).cast("int")).alias(c)
    good = body.select("path", "row", *[value(c) for c in columns], F.lit(None).cast("string").alias("problem"))
    none = [F.lit(None).cast("string").alias(c) for c in columns]
    bad = filled.where("problem is not null").select("path", "row", *none, "problem")
    headers = names.where("_wrong is not null").select("path", F.col("_first").alias("row"), *none, F.col("_wrong").alias("problem"))
    empty = books.select("path").distinct().join(filled.select("path").distinct(), "path", "left_anti").select("path", F.lit(0).alias("row"), *none, F.lit("no_header").alias("problem"))
    return good.unionByName(bad).unionByName(headers).unionByName(empty)


def clinical_workbook(spark: SparkSession, path: str, sheet: str | None = None, required: list[str] = ()) -> DataFrame:
    """One workbook's sheet as a table of text with the columns of its header, for small clinical tables. Runs jobs for its header and problems.

    Raises ConstraintError for a file that is no workbook, a missing sheet, an empty sheet, repeated or missing columns. Columns without a name are left out.
    """
    books = spark.read.format("binaryFile").load(path).select("path", "content")
    rows = sheet_rows(books, sheet)
    if wrong := rows.where("problem is not null").first():
        raise ConstraintError(f"{path}: {wrong.problem}" + (f" {sheet}" if wrong.problem == "sheet_missing" else ""))
    header = rows.where(F.exists("cells", lambda c: F.trim(c) != "")).groupBy().agg(F.min_by("cells", "row").alias("names")).select(_names("names").alias("names")).first().names
    names = [n for n in header or [] if n]
    problems = [f"missing column {c}" for c in required if c not in names] + [f"column {c} occurs more than once" for c in sorted({n for n in names if names.count(n) > 1})]
    if not names or problems:
        raise ConstraintError(f"{path}: {'; '.join(problems) if names else 'no header'}")
    return workbook_tables(books, names, sheet).select("row", *[F.col(f"`{n}`") for n in names]).orderBy("row").drop("row")


def workbook(table: pd.DataFrame, sheet: str = "Sheet1") -> bytes:
    """A table as a workbook of one sheet: numbers as numbers, truth values as such, other values as text, missing ones left out."""
    letters = []
    for i in range(len(table.columns)):
        name, n = "", i + 1
        while n:
            n, rest = divmod(n - 1, 26)
            name = chr(65 + rest) + name
        letters.append(name)

    def cell(i: int, row: int, value) -> str:
        if value is None or value is pd.NaT or value != value:
            return ""
        at = f'r="{letters[i]}{row}"'
        if isinstance(value, bool) or type(value).__name__ == "bool_":
            return f'<c {at} t="b"><v>{int(value)}</v></c>'
        if isinstance(value, (int, float)) or type(value).__name__.startswith(("int", "float", "uint")):
            return f"<c {at}><v>{value!s}</v></c>"
        return f'<c {at} t="inlineStr"><is><t xml:space="preserve">{escape(str(value))}</t></is></c>'

    lines = [[str(c) for c in table.columns], *table.itertuples(index=False)]
    body = "".join(f'<row r="{r}">{"".join(cell(i, r, x) for i, x in enumerate(line))}</row>' for r, line in enumerate(lines, 1))
    main, office, package = MAIN[1:-1], RELATION[1:-3], "http://schemas.openxmlformats.org/package/2006"
    kind = "application/vnd.openxmlformats-officedocument.spreadsheetml"
    files = {
        "[Content_Types].xml": f'<Types xmlns="{package}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Override PartName="/xl/workbook.xml" ContentType="{kind}.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="{kind}.worksheet+xml"/></Types>',
        "_rels/.rels": f'<Relationships xmlns="{package}/relationships"><Relationship Id="rId1" Type="{office}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        "xl/workbook.xml": f'<workbook xmlns="{main}" xmlns:r="{office}"><sheets><sheet name="{escape(sheet, {chr(34): "&quot;"})}" sheetId="1" r:id="rId1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{package}/relationships"><Relationship Id="rId1" Type="{office}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
        "xl/worksheets/sheet1.xml": f'<worksheet xmlns="{main}"><sheetData>{body}</sheetData></worksheet>',
    }
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in files.items():
            z.writestr(name, text)
    return out.getvalue()


def workbooks(df: DataFrame, sheet: str = "Sheet1", rows: int = 1000) -> DataFrame:
    """(path, content): df as workbooks of at most rows rows, each task its own; paths are unique names."""

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for i in range(0, len(frame), rows):
                yield pd.DataFrame({"path": [f"{uuid.uuid4().hex}.xlsx"], "content": [workbook(frame.iloc[i : i + rows], sheet)]})

    return df.mapInPandas(write, "path string, content binary")
