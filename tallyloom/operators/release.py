"""Release manifests, sample sheets, checksum files, reports and uploads, checked as tables of violations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from .validate import Rule, duplicates, violations

#: The columns of a manifest of image pairs, and of one of slide containers.
PAIR_COLUMNS = ["alias", "level", "source_mpp", "filename", "dataset_path", "size_bytes", "sha256", "md5", "width", "height", "channels", "dtype", "photometric", "is_tiled"]
CONTAINER_COLUMNS = ["schema_version", "alias", "filename", "size_bytes", "sha256", "md5", "source_mpp", "level_count", "level_dimensions", "pixel_stream_count", "pixel_sample_sha256", "pixel_full_sha256", "profile"]
#: Patterns of digests, of safe names and of placeholders that a release must not hold.
SHA256, MD5, SAFE_NAME = "^[0-9a-f]{64}$", "^[0-9a-f]{32}$", r"^[A-Za-z0-9][A-Za-z0-9._-]*$"
PLACEHOLDER = r"\{\{[^{}\n]+\}\}|\bPENDING(?:_[A-Z0-9_]+)?\b|\b(?:REPLACE|TODO|TBD)_[A-Z0-9_]+\b"


def _text(c: str) -> Column:
    return F.trim(F.coalesce(F.col(c).cast("string"), F.lit("")))


def _not(test: Column) -> Column:
    """A rule's violation where the test is false or unknown."""
    return ~F.coalesce(test, F.lit(False))


def pairs(raw: DataFrame) -> DataFrame:
    """A pair manifest read as text, typed; what doesn't parse is null. Digests are in lower case."""
    number = lambda c, kind: (tx.parse_int(F.col(c)).cast(kind) if kind != "double" else _text(c).try_cast("double")).alias(c)
    kinds = {"level": "int", "source_mpp": "double", "size_bytes": "bigint", "width": "bigint", "height": "bigint", "channels": "int"}
    rest = [c for c in raw.columns if c not in PAIR_COLUMNS]
    columns = [number(c, kinds[c]) if c in kinds else tx.parse_bool(F.col(c), "strict").alias(c) if c == "is_tiled" else (F.lower(_text(c)) if c in ("sha256", "md5") else _text(c)).alias(c) for c in PAIR_COLUMNS]
    return raw.select(*rest, *columns)


def pair_rules(alias: str) -> list[Rule]:
    """Rules of the rows of pairs(); alias: the pattern of public aliases."""
    level = F.col("level").cast("string")
    positive = lambda *c: F.greatest(*[F.when(F.col(x) > 0, 0).otherwise(1) for x in c], F.lit(0)) == 0
    return [
        Rule("bad_alias", _not(F.col("alias").rlike(alias))),
        Rule("bad_level", _not(F.col("level").isin(0, 2))),
        Rule("bad_mpp", _not(tx.valid_mpp(F.col("source_mpp")))),
        Rule("bad_size", _not(F.col("size_bytes") > 0)),
        Rule("bad_shape", _not(positive("width", "height") & F.col("channels").isin(1, 3, 4))),
        Rule("bad_path", _not((F.col("filename") == F.concat("alias", F.lit("_L"), level, F.lit("_rgb.tif"))) & (F.col("dataset_path") == F.concat(F.lit("slides/"), "alias", F.lit("/1_L"), level, F.lit("_rgb.tif"))))),
        Rule("bad_checksum", _not(F.col("sha256").rlike(SHA256) & F.col("md5").rlike(MD5))),
        Rule("bad_tiled", F.col("is_tiled").isNull()),
    ]


def containers(raw: DataFrame) -> DataFrame:
    """A container manifest read as text, typed, with dataset_path and dimensions array<array<bigint>>."""
    whole = ["schema_version", "size_bytes", "level_count", "pixel_stream_count"]
    digests = ["sha256", "md5", "pixel_sample_sha256", "pixel_full_sha256"]
    rest = [c for c in raw.columns if c not in CONTAINER_COLUMNS]
    columns = [tx.positive_int(F.col(c)).alias(c) if c in whole else _text(c).try_cast("double").alias(c) if c == "source_mpp" else (F.lower(_text(c)) if c in digests else _text(c)).alias(c) for c in CONTAINER_COLUMNS]
    return raw.select(*rest, *columns, F.concat(F.lit("raw/"), _text("alias"), F.lit("/1.mds")).alias("dataset_path"), tx.dimensions(F.col("level_dimensions")).alias("dimensions"))


def container_rules(alias: str, version: int, profile: str) -> list[Rule]:
    """Rules of the rows of containers()."""
    return [
        Rule("bad_version", _not(F.col("schema_version") == version)),
        Rule("bad_alias", _not(F.col("alias").rlike(alias))),
        Rule("bad_filename", _not(F.col("filename") == F.concat("alias", F.lit(".mds")))),
        Rule("bad_size", F.col("size_bytes").isNull()),
        Rule("bad_levels", _not(F.col("level_count") >= 3)),
        Rule("bad_streams", F.col("pixel_stream_count").isNull()),
        Rule("bad_mpp", _not(tx.valid_mpp(F.col("source_mpp")))),
        Rule("bad_dimensions", _not(F.size("dimensions") == F.col("level_count"))),
        Rule("bad_checksum", _not(F.col("sha256").rlike(SHA256) & F.col("md5").rlike(MD5))),
        Rule("bad_pixel_checksum", _not(F.col("pixel_sample_sha256").rlike(SHA256) & F.col("pixel_full_sha256").rlike(SHA256))),
        Rule("bad_profile", _not(F.col("profile") == profile)),
    ]


def manifest_problems(rows: DataFrame, key: str, rules: list[Rule], unique: list[str], levels: list[int] | None = None, digits: int = 9) -> DataFrame:
    """(code, key) of a typed manifest: broken rules by row; values of the unique columns that occur again (duplicate_<column>); aliases without just these
    levels (incomplete_levels); more than one source_mpp, compared with so many digits (mixed_mpp); and an empty manifest (empty). One row each, null key for the last two."""
    out = violations(rows, key, rules).select("code", "key")
    for c in unique:
        out = out.unionAll(duplicates(rows, c).select(F.lit(f"duplicate_{c}").alias("code"), F.col(c).cast("string").alias("key")))
    if levels is not None:
        sets = rows.groupBy("alias").agg(F.array_sort(F.collect_set("level")).alias("have"))
        out = out.unionAll(sets.where(F.col("have") != F.array(*[F.lit(x) for x in sorted(levels)])).select(F.lit("incomplete_levels").alias("code"), F.col("alias").alias("key")))
    whole = rows.agg(F.count(F.lit(1)).alias("n"), F.countDistinct(F.format_string(f"%.{digits}f", "source_mpp")).alias("mpps"))
    code = F.when(F.col("n") == 0, "empty").when(F.col("mpps") != 1, "mixed_mpp")
    return out.unionAll(whole.select(code.alias("code"), F.lit(None).cast("string").alias("key")).where("code is not null"))


def sample_sheet(rows: DataFrame) -> DataFrame:
    """(sample_id, slide_path) of the first levels of a pair manifest."""
    return rows.where("level = 0").select(F.col("alias").alias("sample_id"), F.regexp_replace("dataset_path", "^slides/", "").alias("slide_path"))


def container_sheet(rows: DataFrame) -> DataFrame:
    """(sample_id, container_path, source_mpp as text with six digits) of a container manifest."""
    return rows.select(F.col("alias").alias("sample_id"), F.regexp_replace("dataset_path", "^raw/", "").alias("container_path"), F.format_string("%.6f", "source_mpp").alias("source_mpp"))


def sheet_problems(sheet: DataFrame, wanted: DataFrame) -> DataFrame:
    """(side, sample_id, slide_path): rows that the sheet lacks or has too many of, repeated rows included."""
    columns = ["sample_id", "slide_path"]
    a, b = sheet.select(*columns), wanted.select(*columns)
    return b.exceptAll(a).select(F.lit("missing").alias("side"), *columns).unionAll(a.exceptAll(b).select(F.lit("extra").alias("side"), *columns))


def checksum_entries(lines: DataFrame, pattern: str = SHA256, value: str = "value") -> DataFrame:
    """lines with digest (lower case) and filename of ``digest  name``; both null where a line is none such."""
    digest, name = F.lower(F.regexp_extract(value, r"^([^ ]*)  (.*)$", 1)), F.regexp_extract(value, r"^([^ ]*)  (.*)$", 2)
    good = digest.rlike(pattern) & name.rlike(SAFE_NAME)
    return lines.withColumn("digest", F.when(good, digest)).withColumn("filename", F.when(good, name))


def checksum_problems(lines: DataFrame, rows: DataFrame, field: str = "sha256", value: str = "value") -> DataFrame:
    """(code, key): lines that are no entries (bad_line), names with several (duplicate), and differences from the manifest (missing, extra, differs)."""
    entries = checksum_entries(lines, SHA256 if field == "sha256" else MD5, value)
    bad = entries.where("digest is null").select(F.lit("bad_line").alias("code"), F.col(value).alias("key"))
    # dealt out before they are grouped: no task that reads lines holds all their names
    good = entries.where("digest is not null").repartition("filename")
    again = duplicates(good, "filename").select(F.lit("duplicate").alias("code"), F.col("filename").alias("key"))
    have = good.groupBy("filename").agg(F.max("digest").alias("have"))
    both = rows.select("filename", F.col(field).alias("want")).join(have, "filename", "full_outer")
    code = F.when(F.col("have").isNull(), "missing").when(F.col("want").isNull(), "extra").when(F.col("have") != F.col("want"), "differs")
    return bad.unionAll(again).unionAll(both.select(code.alias("code"), F.col("filename").alias("key")).where("code is not null"))


def upload_problems(public: DataFrame, private: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """(keys, code) of public rows: no private row (no_source), several (duplicate_source), or the first field that differs; and of private rows that are not public (unlisted)."""
    own = private.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *[F.min(f).alias(f"_p_{f}") for f in fields])
    both = public.select(*keys, F.lit(True).alias("_public"), *fields).join(own, keys, "full_outer")
    code = F.when(F.col("_public").isNull(), "unlisted").when(F.col("_n").isNull(), "no_source").when(F.col("_n") > 1, "duplicate_source")
    for f in fields:
        code = code.when(~F.col(f).eqNullSafe(F.col(f"_p_{f}")), f)
    return both.select(*keys, code.alias("code")).where("code is not null")


def upload_limits(uploads: DataFrame, most_files: int, most_bytes: int) -> DataFrame:
    """(code, key) of uploads (name, size_bytes): duplicate names, files that are too large, and too many files (null key)."""
    again = duplicates(uploads, "name").select(F.lit("duplicate_name").alias("code"), F.col("name").alias("key"))
    large = uploads.where(F.col("size_bytes") > most_bytes).select(F.lit("too_large"), "name")
    many = uploads.agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most_files).select(F.lit("too_many_files"), F.lit(None).cast("string"))
    return again.unionAll(large).unionAll(many)


def totals_problem(rows: DataFrame, files: int, size: int) -> DataFrame:
    """(code, found): another number of files or of bytes than the ones asked for."""
    t = rows.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("bytes"))
    return t.where(F.col("files") != files).select(F.lit("file_count").alias("code"), F.col("files").alias("found")).unionAll(t.where(F.col("bytes") != size).select(F.lit("byte_total"), "bytes"))


def report_problems(report: DataFrame, rows: DataFrame, fields: list[str], zero: list[str]) -> DataFrame:
    """(alias, level, code) between a validation report's files and a pair manifest: missing, unknown, repeated, not_passed, a field that differs, or a counter that is not 0."""
    have = report.groupBy("alias", "level").agg(F.count(F.lit(1)).alias("_n"), F.min("status").alias("_status"), *[F.min(f).alias(f"_r_{f}") for f in fields], *[F.max(z).alias(f"_z_{z}") for z in zero])
    both = rows.select("alias", "level", F.lit(True).alias("_m"), *fields).join(have, ["alias", "level"], "full_outer")
    code = F.when(F.col("_n").isNull(), "missing").when(F.col("_m").isNull(), "unknown").when(F.col("_n") > 1, "repeated").when(F.coalesce(F.col("_status") != "passed", F.lit(True)), "not_passed")
    for f in fields:
        code = code.when(~F.col(f).eqNullSafe(F.col(f"_r_{f}")), f)
    for z in zero:
        code = code.when(F.coalesce(F.col(f"_z_{z}") != 0, F.lit(True)), z)
    return both.select("alias", "level", code.alias("code")).where("code is not null")


def remote_files(payload: DataFrame, column: str = "payload") -> DataFrame:
    """payload's other columns with name, size_bytes, md5 (null unless 32 hex digits) and url of each file of its JSON text {"files": [...]}; entries without a name are left out."""
    schema = "files array<struct<filename:string,key:string,filesize:string,size:string,checksum:string,links:struct<self:string>>>"
    rest = [c for c in payload.columns if c != column]
    f = payload.select(*rest, F.explode(F.from_json(column, schema).files).alias("f"))
    name = F.trim(F.coalesce(F.when(F.col("f.filename") != "", F.col("f.filename")), F.col("f.key"), F.lit("")))
    out = f.select(*rest, name.alias("name"), tx.parse_int(F.coalesce("f.filesize", "f.size")).alias("size_bytes"), tx.md5_of(F.col("f.checksum")).alias("md5"), F.when(F.trim("f.links.self") != "", F.trim("f.links.self")).alias("url"))
    return out.where("name != ''")


METADATA = "title string, description string, upload_type string, access_right string, license string, creators array<struct<name:string>>"


def metadata_rules(restricted: bool = False) -> list[Rule]:
    """Rules of a struct column m (METADATA). A restricted release needs the access right restricted and may do without a license."""
    blank = lambda f: F.coalesce(F.trim(f"m.{f}") == "", F.lit(True))
    required = ["title", "description", "upload_type", "access_right"] + ([] if restricted else ["license"])
    rules = [Rule("not_json", F.col("m").isNull())] + [Rule(f"blank_{f}", blank(f)) for f in required]
    rules += [Rule("not_a_dataset", F.lower(F.trim("m.upload_type")) != "dataset"), Rule("no_creator", F.coalesce(F.size("m.creators") <= 0, F.lit(True)))]
    rules += [Rule("unnamed_creator", F.exists("m.creators", lambda c: F.coalesce(F.trim(c["name"]) == "", F.lit(True))))]
    return rules + ([Rule("not_restricted", F.coalesce(F.lower(F.trim("m.access_right")) != "restricted", F.lit(True)))] if restricted else [])


def authorization_rules(confirmations: list[str], license: Column, fingerprint: Column) -> list[Rule]:
    """Rules of an authorization a (confirmations map<string,string>, authorized_by, authorized_at, license, fingerprint): all confirmed, by somebody, at an instant with a zone, for this release."""
    text = lambda f: F.trim(F.coalesce(f"a.{f}", F.lit("")))
    return [
        *[Rule(f"unconfirmed_{c}", ~F.coalesce(F.col("a.confirmations")[c] == "true", F.lit(False))) for c in confirmations],
        Rule("no_author", (text("authorized_by") == "") | (text("authorized_at") == "")),
        Rule("bad_time", (text("authorized_at") != "") & tx.instant(F.col("a.authorized_at")).isNull()),
        Rule("other_license", text("license") != F.trim(F.coalesce(license, F.lit("")))),
        Rule("other_release", ~F.lower(text("fingerprint")).eqNullSafe(fingerprint)),
    ]


def placeholders(text: Column) -> Column:
    """Whether a text holds an unresolved placeholder."""
    return F.coalesce(text.rlike(PLACEHOLDER), F.lit(False))


def draft_differences(draft: DataFrame, expected: DataFrame, key: str, fields: list[str], html: tuple[str, ...] = ()) -> DataFrame:
    """(key, field) of the fields that differ between two tables of documents; those in html are compared after character references are decoded."""
    a = expected.select(key, *[F.col(f).alias(f"_e_{f}") for f in fields])
    b = draft.select(key, *[F.col(f).alias(f"_d_{f}") for f in fields])
    same = lambda f: tx.same_text(F.col(f"_d_{f}"), F.col(f"_e_{f}")) if f in html else F.col(f"_d_{f}").eqNullSafe(F.col(f"_e_{f}"))
    found = F.array(*[F.when(~same(f), F.lit(f)) for f in fields])
    return a.join(b, key, "left").select(key, F.explode(F.array_compact(found)).alias("field"))


def broken_links(documents: DataFrame) -> DataFrame:
    """(name, target) of links to Markdown files that are not among documents (name, text)."""
    links = documents.select("name", F.explode(F.regexp_extract_all("text", F.lit(r"\]\(([^)#?]+[.]md)(?:#[^)]+)?\)"), 1)).alias("path"))
    links = links.select("name", F.element_at(F.split("path", "/"), -1).alias("target")).distinct()
    return links.join(documents.select(F.col("name").alias("target")), "target", "left_anti").select("name", "target")


def absent(there: DataFrame, required: list[str], by: str, name: str = "name") -> DataFrame:
    """(by, missing, extra): of each group's names the required ones that it lacks and those that are not required, each sorted and joined by semicolons."""
    want = F.array(*[F.lit(r) for r in required])
    have = there.groupBy(by).agg(F.collect_set(name).alias("_h"))
    joined = lambda c: F.array_join(F.array_sort(c), ";")
    return have.select(by, joined(F.array_except(want, "_h")).alias("missing"), joined(F.array_except("_h", want)).alias("extra"))


def write_actions(there: DataFrame, wanted: DataFrame, key: str = "name", digest: str = "sha256", overwrite: bool = False) -> DataFrame:
    """(key, action) for files to write: write where there is none, keep where the digest is the same, else overwrite, or refuse without leave."""
    both = wanted.select(key, F.col(digest).alias("_w")).join(there.select(key, F.col(digest).alias("_t")), key, "left")
    return both.select(key, F.when(F.col("_t").isNull(), "write").when(F.col("_t") == F.col("_w"), "keep").otherwise("overwrite" if overwrite else "refuse").alias("action"))
