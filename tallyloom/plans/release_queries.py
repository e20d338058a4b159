"""Queries over release manifests, uploads, reports and documents, on views of the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import release as rl
from . import views as v
from .queries import query


class View:
    """A projection of a table by expressions that Spark and DuckDB read alike; sql is the same as a common table expression."""

    def __init__(self, name: str, table: str, columns: dict[str, str]):
        self.table, self.columns = table, columns
        self.sql = f"{name} AS (SELECT {', '.join(f'{e} AS {c}' for c, e in columns.items())} FROM {table})"

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return v.read(spark, sf_dir, self.table).select(*[F.expr(e).alias(c) for c, e in self.columns.items()])


ALIAS = "^case_[0-9]{9}$"
_alias = "CASE WHEN o_orderkey % 211 = 5 THEN 'case 1' ELSE concat('case_', lpad(CAST(CAST(floor(o_orderkey / 2) AS BIGINT) AS STRING), 9, '0')) END"
_level = "CASE WHEN o_orderkey % 2 = 0 THEN '0' ELSE '2' END"
_hash = lambda salt: f"md5(concat(CAST(o_orderkey AS STRING), '{salt}'))"
#: orders as the text of a pair manifest: two levels a case, and faults here and there.
RAW = View("raw", "orders", {
    "line": "o_orderkey", "alias": _alias, "level": "CASE WHEN o_orderkey % 307 = 1 THEN '1' WHEN o_orderkey % 2 = 0 THEN '0' ELSE ' 2 ' END",
    "source_mpp": "CASE WHEN o_orderkey % 401 = 2 THEN 'nan' WHEN o_orderkey % 503 = 3 THEN '-0.5' WHEN o_orderkey % 613 = 4 THEN 'wide' ELSE '0.25' END",
    "filename": f"CASE WHEN o_orderkey % 601 = 4 THEN '../x.tif' ELSE concat({_alias}, '_L', {_level}, '_rgb.tif') END", "dataset_path": f"concat('slides/', {_alias}, '/1_L', {_level}, '_rgb.tif')",
    "size_bytes": "CASE WHEN o_orderkey % 701 = 6 THEN '0' ELSE CAST(o_orderkey + 1000 AS STRING) END", "sha256": f"CASE WHEN o_orderkey % 809 = 7 THEN 'zz' ELSE upper(concat({_hash('a')}, {_hash('b')})) END",
    "md5": _hash("c"), "width": "CASE WHEN o_orderkey % 907 = 8 THEN '-3' ELSE '4096' END", "height": "'2048'", "channels": "CASE WHEN o_orderkey % 1009 = 9 THEN '2' ELSE '3' END", "dtype": "'uint8'", "photometric": "'RGB'",
    "is_tiled": "CASE WHEN o_orderkey % 11 = 0 THEN 'False' WHEN o_orderkey % 1103 = 10 THEN 'maybe' ELSE 'True' END",
})
_TYPED = f"""{RAW.sql}, t AS (SELECT line, trim(alias) AS alias, TRY_CAST(trim(level) AS INTEGER) AS level, TRY_CAST(trim(source_mpp) AS DOUBLE) AS source_mpp, trim(filename) AS filename, trim(dataset_path) AS dataset_path,
TRY_CAST(trim(size_bytes) AS BIGINT) AS size_bytes, lower(sha256) AS sha256, lower(md5) AS md5, TRY_CAST(width AS BIGINT) AS width, TRY_CAST(height AS BIGINT) AS height, TRY_CAST(channels AS INTEGER) AS channels, dtype, photometric,
CASE lower(is_tiled) WHEN 'true' THEN true WHEN 'false' THEN false END AS is_tiled FROM raw)"""
_sha, _md5 = "'^[0-9a-f]{64}$'", "'^[0-9a-f]{32}$'"


def _pairs(spark, sf_dir):
    return rl.pairs(RAW(spark, sf_dir))


@query(f"""WITH {_TYPED} SELECT code, CAST(line AS VARCHAR) AS key FROM (
SELECT 'bad_alias' AS code, line FROM t WHERE NOT regexp_full_match(alias, 'case_[0-9]{{9}}') UNION ALL SELECT 'bad_level', line FROM t WHERE level IS NULL OR level NOT IN (0, 2)
UNION ALL SELECT 'bad_mpp', line FROM t WHERE source_mpp IS NULL OR isnan(source_mpp) OR source_mpp <= 0 UNION ALL SELECT 'bad_size', line FROM t WHERE NOT coalesce(size_bytes > 0, false)
UNION ALL SELECT 'bad_shape', line FROM t WHERE NOT (width > 0 AND height > 0 AND channels IN (1, 3, 4)) UNION ALL SELECT 'bad_path', line FROM t WHERE NOT coalesce(filename = alias || '_L' || level || '_rgb.tif' AND dataset_path = 'slides/' || alias || '/1_L' || level || '_rgb.tif', false)
UNION ALL SELECT 'bad_checksum', line FROM t WHERE NOT (regexp_matches(sha256, {_sha}) AND regexp_matches(md5, {_md5})) UNION ALL SELECT 'bad_tiled', line FROM t WHERE is_tiled IS NULL)
UNION ALL SELECT 'duplicate_filename', filename FROM t GROUP BY 2 HAVING count(*) > 1 UNION ALL SELECT 'duplicate_dataset_path', dataset_path FROM t GROUP BY 2 HAVING count(*) > 1
UNION ALL SELECT 'incomplete_levels', alias FROM t GROUP BY 2 HAVING NOT coalesce(list_sort(list(DISTINCT level) FILTER (level IS NOT NULL)) = [0, 2], false)
UNION ALL SELECT 'mixed_mpp', NULL FROM t HAVING count(DISTINCT printf('%.9f', source_mpp)) <> 1""")
def pair_manifest_problems(spark, sf_dir):
    """A closed manifest of image pairs: rules by row, unique files, complete levels, one scale."""
    return rl.manifest_problems(_pairs(spark, sf_dir), "line", rl.pair_rules(ALIAS), ["filename", "dataset_path"], [0, 2])


@query(f"WITH {_TYPED} SELECT line, alias, level, CASE WHEN isnan(source_mpp) THEN NULL ELSE source_mpp END AS source_mpp, size_bytes, sha256, width, channels, is_tiled FROM t")
def pair_manifest_rows(spark, sf_dir):
    """The typed rows of the manifest."""
    return _pairs(spark, sf_dir).select("line", "alias", "level", F.nanvl("source_mpp", F.lit(None)).alias("source_mpp"), "size_bytes", "sha256", "width", "channels", "is_tiled")


@query(f"WITH {_TYPED} SELECT alias AS sample_id, replace(dataset_path, 'slides/', '') AS slide_path FROM t WHERE level = 0")
def sample_sheet(spark, sf_dir):
    return rl.sample_sheet(_pairs(spark, sf_dir))


@query(f"WITH {_TYPED}, w AS (SELECT alias AS sample_id, replace(dataset_path, 'slides/', '') AS slide_path, line FROM t WHERE level = 0), s AS (SELECT sample_id, CASE WHEN line % 90 = 0 THEN 'moved.tif' ELSE slide_path END AS slide_path FROM w WHERE line % 70 <> 0) SELECT side, sample_id, slide_path FROM (SELECT 'missing' AS side, * FROM (SELECT sample_id, slide_path FROM w EXCEPT ALL SELECT * FROM s) UNION ALL SELECT 'extra', * FROM (SELECT * FROM s EXCEPT ALL SELECT sample_id, slide_path FROM w))")
def sample_sheet_problems(spark, sf_dir):
    rows = _pairs(spark, sf_dir)
    wanted = rl.sample_sheet(rows)
    sheet = rows.where("level = 0 and line % 70 != 0").select(F.col("alias").alias("sample_id"), F.when(F.col("line") % 90 == 0, "moved.tif").otherwise(F.regexp_replace("dataset_path", "^slides/", "")).alias("slide_path"))
    return rl.sheet_problems(sheet, wanted)


_line = "CASE WHEN line % 131 = 1 THEN concat(sha256, ' ', filename) WHEN line % 137 = 2 THEN concat(reverse(sha256), '  ', filename) ELSE concat(sha256, '  ', filename) END"


@query(f"""WITH {_TYPED}, l AS (SELECT {_line} AS value, filename, sha256, line % 131 <> 1 AND regexp_matches(sha256, {_sha}) AND regexp_full_match(filename, '[A-Za-z0-9][A-Za-z0-9._-]*') AS good, CASE WHEN line % 137 = 2 THEN reverse(sha256) ELSE sha256 END AS d FROM t WHERE line % 139 <> 3),
h AS (SELECT filename, max(d) AS have FROM l WHERE good GROUP BY 1)
SELECT 'bad_line' AS code, value AS key FROM l WHERE NOT good UNION ALL SELECT 'duplicate', filename FROM l WHERE good GROUP BY 2 HAVING count(*) > 1
UNION ALL SELECT CASE WHEN have IS NULL THEN 'missing' WHEN t.filename IS NULL THEN 'extra' ELSE 'differs' END, coalesce(t.filename, h.filename) FROM t FULL JOIN h ON t.filename = h.filename WHERE have IS NULL OR t.filename IS NULL OR have <> sha256""")
def checksum_file_problems(spark, sf_dir):
    """Lines of a checksum file against the manifest."""
    rows = _pairs(spark, sf_dir)
    lines = rows.where("line % 139 != 3").select(F.expr(_line).alias("value"))
    return rl.checksum_problems(lines, rows)


@query(f"""WITH {_TYPED}, p AS (SELECT alias, level, filename, CASE WHEN line % 61 = 1 THEN 'x' ELSE sha256 END AS sha256, CASE WHEN line % 67 = 2 THEN NULL ELSE md5 END AS md5 FROM t WHERE level IN (0, 2) AND line % 59 <> 0 UNION ALL SELECT alias, level, filename, sha256, md5 FROM t WHERE level = 0 AND line % 71 = 4 AND line % 59 <> 0 UNION ALL SELECT 'other', 0, 'f', 's', 'm'),
g AS (SELECT alias, level, count(*) AS n, min(filename) AS f, min(sha256) AS s, min(md5) AS m FROM p GROUP BY 1, 2), u AS (SELECT * FROM t WHERE level IN (0, 2) AND alias <> 'case 1')
SELECT coalesce(u.alias, g.alias) AS alias, coalesce(u.level, g.level) AS level, CASE WHEN u.alias IS NULL THEN 'unlisted' WHEN n IS NULL THEN 'no_source' WHEN n > 1 THEN 'duplicate_source' WHEN u.filename IS DISTINCT FROM f THEN 'filename' WHEN u.sha256 IS DISTINCT FROM s THEN 'sha256' WHEN u.md5 IS DISTINCT FROM m THEN 'md5' END AS code
FROM u FULL JOIN g ON u.alias = g.alias AND u.level = g.level WHERE code IS NOT NULL""")
def upload_source_problems(spark, sf_dir):
    """Public rows against the private mapping of their sources, both ways."""
    rows = _pairs(spark, sf_dir).where("level in (0, 2)")
    columns = ["alias", "level", "filename", "sha256", "md5"]
    own = rows.where("line % 59 != 0").withColumn("sha256", F.expr("if(line % 61 = 1, 'x', sha256)")).withColumn("md5", F.expr("if(line % 67 = 2, null, md5)"))
    again = rows.where("level = 0 and line % 71 = 4 and line % 59 != 0")
    other = spark.createDataFrame([("other", 0, "f", "s", "m")], "alias string, level int, filename string, sha256 string, md5 string")
    private = own.select(*columns).unionAll(again.select(*columns)).unionAll(other)
    return rl.upload_problems(rows.where("alias != 'case 1'"), private, ["alias", "level"], ["filename", "sha256", "md5"])


@query(f"""WITH {_TYPED}, r AS (SELECT alias, level, width + CASE WHEN line % 83 = 1 THEN 1 ELSE 0 END AS width, CASE WHEN line % 89 = 2 THEN 'failed' ELSE 'passed' END AS status, CASE WHEN line % 97 = 3 THEN 2 ELSE 0 END AS hits FROM t WHERE level IN (0, 2) AND line % 101 <> 4 AND alias <> 'case 1'), m AS (SELECT * FROM t WHERE level IN (0, 2) AND line % 103 <> 5 AND alias <> 'case 1')
SELECT coalesce(m.alias, r.alias) AS alias, coalesce(m.level, r.level) AS level, CASE WHEN r.alias IS NULL THEN 'missing' WHEN m.alias IS NULL THEN 'unknown' WHEN status <> 'passed' THEN 'not_passed' WHEN m.width <> r.width THEN 'width' WHEN hits <> 0 THEN 'hits' END AS code FROM m FULL JOIN r ON m.alias = r.alias AND m.level = r.level WHERE code IS NOT NULL""")
def validation_report_problems(spark, sf_dir):
    """A validation report against the manifest: a bijection whose fields agree and whose counters are 0."""
    rows = _pairs(spark, sf_dir).where("level in (0, 2) and alias != 'case 1'")
    report = rows.where("line % 101 != 4").select("alias", "level", F.expr("width + if(line % 83 = 1, 1, 0)").alias("width"), F.expr("if(line % 89 = 2, 'failed', 'passed')").alias("status"), F.expr("if(line % 97 = 3, 2, 0)").alias("hits"))
    return rl.report_problems(report, rows.where("line % 103 != 5"), ["width"], ["hits"])


@query(f"WITH {_TYPED}, u AS (SELECT CASE WHEN line % 151 = 1 THEN 'same.tif' ELSE filename END AS name, size_bytes FROM t) SELECT 'duplicate_name' AS code, name AS key FROM u GROUP BY 2 HAVING count(*) > 1 UNION ALL SELECT 'too_large', name FROM u WHERE size_bytes > 15900 UNION ALL SELECT 'too_many_files', NULL FROM u HAVING count(*) > 100")
def upload_limit_problems(spark, sf_dir):
    u = _pairs(spark, sf_dir).select(F.expr("if(line % 151 = 1, 'same.tif', filename)").alias("name"), "size_bytes")
    return rl.upload_limits(u, 100, 15900)


@query(f"WITH {_TYPED} SELECT 'file_count' AS code, count(*) AS found FROM t HAVING count(*) <> 21 UNION ALL SELECT 'byte_total', CAST(sum(size_bytes) AS BIGINT) FROM t HAVING sum(size_bytes) <> 17370771968")
def release_totals(spark, sf_dir):
    """An exact number of files and of bytes is asked for."""
    return rl.totals_problem(_pairs(spark, sf_dir), 21, 17370771968)


_dims = "CASE WHEN p_partkey % 13 = 1 THEN '[[4096, 2048], [1024, 512]]' WHEN p_partkey % 17 = 2 THEN '[[4096, 2048], [1024.0, 512], [256, 128]]' WHEN p_partkey % 19 = 3 THEN '[[4096, 2048], [\"1024\", 512], [256, 128]]' WHEN p_partkey % 23 = 4 THEN 'none' ELSE '[[4096,2048],[1024,512],[256,128]]' END"
_digest = lambda salt: f"concat(md5(concat(CAST(p_partkey AS STRING), '{salt}')), md5(concat(CAST(p_partkey AS STRING), '{salt}2')))"
_code = "concat('case_', lpad(CAST(p_partkey AS STRING), 9, '0'))"
#: part as the text of a container manifest.
BOXES = View("raw", "part", {
    "line": "p_partkey", "schema_version": "CASE WHEN p_partkey % 53 = 1 THEN '1' ELSE ' 2' END", "alias": _code, "filename": f"concat({_code}, CASE WHEN p_partkey % 59 = 2 THEN '.MDS' ELSE '.mds' END)",
    "size_bytes": "CASE WHEN p_partkey % 61 = 3 THEN '12.5' ELSE CAST(p_partkey + 1 AS STRING) END", "sha256": _digest("s"), "md5": "md5(CAST(p_partkey AS STRING))", "source_mpp": "CASE WHEN p_partkey % 67 = 4 THEN '0.2617809' ELSE '0.2617808' END",
    "level_count": "CASE WHEN p_partkey % 13 = 1 THEN '2' ELSE '3' END", "level_dimensions": _dims, "pixel_stream_count": "CASE WHEN p_partkey % 71 = 5 THEN '-1' ELSE '8' END", "pixel_sample_sha256": _digest("p"),
    "pixel_full_sha256": f"CASE WHEN p_partkey % 73 = 6 THEN 'ff' ELSE {_digest('f')} END", "profile": "CASE WHEN p_partkey % 79 = 7 THEN 'v1' ELSE 'v2' END",
})


@query(f"""WITH {BOXES.sql} SELECT code, CAST(line AS VARCHAR) AS key FROM (SELECT 'bad_version' AS code, line FROM raw WHERE line % 53 = 1 UNION ALL SELECT 'bad_filename', line FROM raw WHERE filename <> alias || '.mds' UNION ALL SELECT 'bad_size', line FROM raw WHERE size_bytes = '12.5'
UNION ALL SELECT 'bad_levels', line FROM raw WHERE level_count = '2' UNION ALL SELECT 'bad_streams', line FROM raw WHERE pixel_stream_count = '-1' UNION ALL SELECT 'bad_dimensions', line FROM raw WHERE level_dimensions = 'none' OR contains(level_dimensions, '"') OR contains(level_dimensions, '.0')
UNION ALL SELECT 'bad_pixel_checksum', line FROM raw WHERE pixel_full_sha256 = 'ff' UNION ALL SELECT 'bad_profile', line FROM raw WHERE profile <> 'v2') UNION ALL SELECT 'mixed_mpp', NULL FROM raw HAVING count(DISTINCT source_mpp) > 1""")
def container_manifest_problems(spark, sf_dir):
    """A closed manifest of slide containers with dimensions as JSON."""
    return rl.manifest_problems(rl.containers(BOXES(spark, sf_dir)), "line", rl.container_rules(ALIAS, 2, "v2"), ["alias", "filename"])


@query(f"WITH {BOXES.sql}, d AS (SELECT line, CASE WHEN level_dimensions = 'none' OR contains(level_dimensions, '\"') OR contains(level_dimensions, '.0') THEN NULL ELSE CAST(level_dimensions AS BIGINT[][]) END AS d FROM raw) SELECT line, l - 1 AS level, d[l][1] AS width, d[l][2] AS height FROM d, range(1, 4) r(l) WHERE l <= len(d)")
def container_levels(spark, sf_dir):
    """A row for each level of each container whose dimensions are fine."""
    c = rl.containers(BOXES(spark, sf_dir)).select("line", F.posexplode("dimensions").alias("level", "d"))
    return c.select("line", F.col("level").cast("bigint").alias("level"), F.col("d")[0].alias("width"), F.col("d")[1].alias("height"))


@query(f"WITH {BOXES.sql} SELECT alias AS sample_id, alias || '/1.mds' AS container_path, printf('%.6f', CAST(source_mpp AS DOUBLE)) AS source_mpp FROM raw")
def container_sheet(spark, sf_dir):
    return rl.container_sheet(rl.containers(BOXES(spark, sf_dir)))


@query("""WITH f AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 7 = 1 THEN '' ELSE 'f' || o_orderkey END AS name FROM orders) SELECT k, CASE WHEN name = '' THEN 'k' || k ELSE name END AS name, CASE WHEN k % 5 = 2 THEN NULL ELSE k + 10 END AS size_bytes, CASE WHEN k % 3 = 0 THEN md5(CAST(k AS VARCHAR)) END AS md5, CASE WHEN k % 4 <> 0 THEN 'https://files.example/' || k END AS url FROM f WHERE k % 11 <> 0""")
def remote_file_rows(spark, sf_dir):
    """Files of JSON payloads: names under either key, sizes under either, checksums with a prefix, links."""
    k = F.col("o_orderkey")
    text = F.concat(
        F.lit('{"files": [{"filename": "'), F.when(k % 7 == 1, "").otherwise(F.concat(F.lit("f"), k.cast("string"))), F.lit('", "key": "'), F.when(k % 11 == 0, "").otherwise(F.concat(F.lit("k"), k.cast("string"))), F.lit('", "'),
        F.when(k % 2 == 0, "filesize").otherwise("size"), F.lit('": '), F.when(k % 5 == 2, F.lit("null")).otherwise((k + 10).cast("string")), F.lit(', "checksum": "'), F.when(k % 3 == 0, F.concat(F.lit("MD5:"), F.md5(k.cast("string")))).otherwise("md5:00"),
        F.lit('", "links": '), F.when(k % 4 == 0, F.lit("{}")).otherwise(F.concat(F.lit('{"self": "https://files.example/'), k.cast("string"), F.lit('"}'))), F.lit("}]}"),
    )
    o = v.read(spark, sf_dir, "orders").where("o_orderkey % 11 != 0")
    return rl.remote_files(o.select(k.alias("k"), text.alias("payload")))


_META = View("meta", "customer", {
    "k": "c_custkey", "title": "CASE WHEN c_custkey % 7 = 1 THEN ' ' ELSE c_name END", "upload_type": "CASE WHEN c_custkey % 11 = 2 THEN 'software' ELSE 'Dataset' END", "access_right": "CASE WHEN c_custkey % 13 = 3 THEN 'open' ELSE 'restricted' END",
    "license": "CASE WHEN c_custkey % 5 = 4 THEN '' ELSE 'cc-by-4.0' END", "creator": "CASE WHEN c_custkey % 17 = 5 THEN '' ELSE c_name END", "n": "c_custkey % 19",
})


def _metadata(spark, sf_dir):
    m = _META(spark, sf_dir)
    creators = F.when(F.col("n") == 6, F.array().cast("array<struct<name:string>>")).otherwise(F.array(F.struct(F.lit("first").alias("name")), F.struct(F.col("creator").alias("name"))))
    text = F.to_json(F.struct("title", F.lit("about").alias("description"), "upload_type", "access_right", "license", creators.alias("creators")))
    return m.select("k", F.from_json(F.when(F.col("n") == 7, "no json").otherwise(text), rl.METADATA, {"mode": "FAILFAST"} if False else {}).alias("m"))


@query(f"""WITH {_META.sql}, g AS (SELECT * FROM meta WHERE n <> 7) SELECT code, CAST(k AS VARCHAR) AS key FROM (SELECT 'blank_title' AS code, k FROM g WHERE trim(title) = '' UNION ALL SELECT 'blank_license', k FROM g WHERE license = '' UNION ALL SELECT 'not_a_dataset', k FROM g WHERE lower(upload_type) <> 'dataset'
UNION ALL SELECT 'no_creator', k FROM g WHERE n = 6 UNION ALL SELECT 'unnamed_creator', k FROM g WHERE n <> 6 AND creator = '' UNION ALL SELECT unnest(['blank_title', 'blank_description', 'blank_upload_type', 'blank_access_right', 'blank_license', 'no_creator']), k FROM meta WHERE n = 7)""")
def metadata_problems(spark, sf_dir):
    """Rules of a release's metadata as JSON; what is no JSON breaks all that ask for a field."""
    from ..operators.validate import violations

    return violations(_metadata(spark, sf_dir), "k", rl.metadata_rules()).select("code", "key")


@query(f"""WITH {_META.sql}, g AS (SELECT * FROM meta WHERE n <> 7) SELECT code, CAST(k AS VARCHAR) AS key FROM (SELECT 'blank_title' AS code, k FROM g WHERE trim(title) = '' UNION ALL SELECT 'not_a_dataset', k FROM g WHERE lower(upload_type) <> 'dataset' UNION ALL SELECT 'no_creator', k FROM g WHERE n = 6
UNION ALL SELECT 'unnamed_creator', k FROM g WHERE n <> 6 AND creator = '' UNION ALL SELECT 'not_restricted', k FROM g WHERE access_right <> 'restricted' UNION ALL SELECT unnest(['blank_title', 'blank_description', 'blank_upload_type', 'blank_access_right', 'no_creator', 'not_restricted']), k FROM meta WHERE n = 7)""")
def restricted_metadata_problems(spark, sf_dir):
    from ..operators.validate import violations

    return violations(_metadata(spark, sf_dir), "k", rl.metadata_rules(restricted=True)).select("code", "key")


_AUTH = View("auth", "customer", {
    "k": "c_custkey", "a": "CASE WHEN c_custkey % 7 = 1 THEN 'false' ELSE 'true' END", "author": "CASE WHEN c_custkey % 11 = 2 THEN ' ' ELSE c_name END",
    "moment": "CASE WHEN c_custkey % 5 = 0 THEN '2024-05-01T10:20:30Z' WHEN c_custkey % 5 = 1 THEN '2024-05-01T10:20:30+02:00' WHEN c_custkey % 5 = 2 THEN '2024-05-01T10:20:30' WHEN c_custkey % 5 = 3 THEN 'today' ELSE '2024-05-01 10:20:30.25-05:30' END",
    "license": "CASE WHEN c_custkey % 13 = 3 THEN 'mit' ELSE 'cc' END", "fingerprint": "CASE WHEN c_custkey % 17 = 4 THEN 'other' ELSE upper(md5(CAST(c_custkey AS STRING))) END",
})


@query(f"""WITH {_AUTH.sql} SELECT code, CAST(k AS VARCHAR) AS key FROM (SELECT 'unconfirmed_reviewed' AS code, k FROM auth WHERE a <> 'true' UNION ALL SELECT 'no_author', k FROM auth WHERE trim(author) = '' UNION ALL SELECT 'bad_time', k FROM auth WHERE k % 5 IN (2, 3)
UNION ALL SELECT 'other_license', k FROM auth WHERE license <> 'cc' UNION ALL SELECT 'other_release', k FROM auth WHERE fingerprint = 'other')""")
def authorization_problems(spark, sf_dir):
    """An authorization holds for one release: confirmed, signed, at an instant with a zone, for its license and fingerprint."""
    from ..operators.validate import violations

    a = F.struct(F.create_map(F.lit("reviewed"), F.col("a")).alias("confirmations"), F.col("author").alias("authorized_by"), F.col("moment").alias("authorized_at"), "license", "fingerprint")
    rows = _AUTH(spark, sf_dir).withColumn("a", a)
    return violations(rows, "k", rl.authorization_rules(["reviewed"], F.lit("cc"), F.md5(F.col("k").cast("string")))).select("code", "key")


@query(f"WITH {_AUTH.sql} SELECT k, moment, CASE k % 5 WHEN 0 THEN 1714558830000000 WHEN 1 THEN 1714551630000000 WHEN 4 THEN 1714578630250000 END AS micros FROM auth")
def instants(spark, sf_dir):
    """ISO 8601 instants, only with a zone."""
    return _AUTH(spark, sf_dir).select("k", "moment", F.unix_micros(tx.instant(F.col("moment"))).alias("micros"))


@query("SELECT doc_id, doc_id % 4 = 1 OR doc_id % 9 = 2 OR regexp_matches(text, '\\{\\{[^{}\\n]+\\}\\}|\\bPENDING(_[A-Z0-9_]+)?\\b|\\b(REPLACE|TODO|TBD)_[A-Z0-9_]+\\b') AS unresolved FROM documents")
def unresolved_placeholders(spark, sf_dir):
    d = v.read(spark, sf_dir, "documents")
    text = F.concat(F.coalesce("text", F.lit("")), F.when(F.col("doc_id") % 4 == 1, " see {{version}} here").when(F.col("doc_id") % 9 == 2, " license PENDING_REVIEW.").otherwise(" SPENDING TODO"))
    return d.select("doc_id", rl.placeholders(text).alias("unresolved"))


@query("SELECT k, field FROM (SELECT c_custkey AS k, 'title' AS field FROM customer WHERE c_custkey % 7 = 3 UNION ALL SELECT c_custkey, 'description' FROM customer WHERE c_custkey % 5 = 4 UNION ALL SELECT c_custkey, 'license' FROM customer WHERE c_custkey % 9 = 0)")
def draft_metadata_differences(spark, sf_dir):
    """Fields of a draft that differ from the ones that were asked for; descriptions are compared with their references decoded."""
    k = F.col("c_custkey")
    c = v.read(spark, sf_dir, "customer")
    expected = c.select(k.alias("k"), F.col("c_name").alias("title"), F.lit("a < b & \"c\"").alias("description"), F.lit("cc").alias("license"))
    draft = c.select(k.alias("k"), F.when(k % 7 == 3, "x").otherwise(F.col("c_name")).alias("title"), F.when(k % 5 == 4, "a b").when(k % 2 == 0, "a &lt; b &amp; &quot;c&quot;").otherwise("a < b & &#34;c\"").alias("description"), F.when(k % 9 != 0, "cc").alias("license"))
    return rl.draft_differences(draft, expected, "k", ["title", "description", "license"], html=("description",))


@query("SELECT 'doc' || p_partkey || '.md' AS name, 'doc' || (p_partkey + 7) || '.md' AS target FROM part WHERE p_partkey + 7 NOT IN (SELECT p_partkey FROM part) UNION ALL SELECT 'doc' || p_partkey || '.md', 'gone.md' FROM part WHERE p_partkey % 10 = 3")
def broken_document_links(spark, sf_dir):
    """Links of staged documents whose targets are not staged, after names were rewritten."""
    k = F.col("p_partkey")
    body = F.concat(F.lit("see [next](sub/PAGE"), (k + 7).cast("string"), F.lit(".md#top) and [site](https://x.example/a)"), F.when(k % 10 == 3, " and [old](gone.md)").otherwise(""))
    docs = v.read(spark, sf_dir, "part").select(F.concat(F.lit("doc"), k.cast("string"), F.lit(".md")).alias("name"), tx.replaced(body, {"PAGE": "doc"}).alias("text"))
    return rl.broken_links(docs)


@query("WITH f AS (SELECT s_suppkey AS root, n AS name FROM supplier, (SELECT unnest(['manifest.csv', 'samples.csv', 'SHA256SUMS', 'MD5SUMS', 'report.json', 'notes.txt']) AS n) WHERE (s_suppkey * 5 + length(n)) % 4 <> 0), w AS (SELECT unnest(['manifest.csv', 'samples.csv', 'SHA256SUMS', 'MD5SUMS', 'report.json']) AS name) SELECT root, coalesce((SELECT string_agg(w.name, ';' ORDER BY w.name) FROM w WHERE w.name NOT IN (SELECT f.name FROM f WHERE f.root = r.root)), '') AS missing, coalesce((SELECT string_agg(f.name, ';') FROM f WHERE f.root = r.root AND f.name = 'notes.txt'), '') AS extra FROM (SELECT DISTINCT root FROM f) r")
def required_artifacts(spark, sf_dir):
    """Generated files that a release folder lacks, and what else lies in it."""
    required = ["manifest.csv", "samples.csv", "SHA256SUMS", "MD5SUMS", "report.json"]
    names = F.explode(F.array(*[F.lit(n) for n in [*required, "notes.txt"]]))
    f = v.read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("root"), names.alias("name")).where((F.col("root") * 5 + F.length("name")) % 4 != 0)
    return rl.absent(f, required, "root")


@query("SELECT o_orderkey AS name, CASE WHEN o_orderkey % 3 = 0 THEN 'write' WHEN o_orderkey % 5 = 0 THEN 'refuse' ELSE 'keep' END AS action FROM orders")
def write_decisions(spark, sf_dir):
    """Files are written where there is none, kept where they are the same, and never replaced without leave."""
    k = F.col("o_orderkey")
    o = v.read(spark, sf_dir, "orders")
    wanted = o.select(k.alias("name"), F.sha2(k.cast("string"), 256).alias("sha256"))
    there = o.where("o_orderkey % 3 != 0").select(k.alias("name"), F.when(k % 5 == 0, "older").otherwise(F.sha2(k.cast("string"), 256)).alias("sha256"))
    return rl.write_actions(there, wanted)
