"""Queries over result files of slides and cases, names, levels and shapes."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geometry as geo
from ..functions import hashing as hs
from ..functions import text as tx
from ..operators import artifacts as af
from ..operators import matrices, ranking
from ..sources import discovery
from . import views as v
from .queries import query
from .release_queries import View

# ---- files of cases

_PATHS = [*af.ASSETS["overview_pdf"][:2], *af.ASSETS["overview_png"], *af.ASSETS["roi_pdf"], *af.ASSETS["counts_csv"], *af.ASSETS["summary_json"], "cell_types/cell_type_coordinates.csv.gz", "old/cell_type_coordinates.csv", "cell_type_coordinates.npy"]
_list = "[" + ", ".join(f"'{p}'" for p in _PATHS) + "]"
#: customer as folders with some of these files.
_FILES = f"files AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 50 = 7 THEN 'run/_case ' || c_custkey WHEN c_custkey % 50 = 8 THEN 'run/case ' || (c_custkey - 1) || '/deep/case ' || c_custkey WHEN c_custkey % 50 = 9 THEN 'run/overlays' ELSE 'run/case ' || c_custkey END AS folder, i, ({_list})[i] AS path FROM customer, range(1, {len(_PATHS) + 1}) r(i) WHERE (c_custkey * 7 + i * i) % 5 < 2)"


def _files(spark, sf_dir):
    k = F.col("c_custkey")
    name = lambda x: F.concat(F.lit("run/case "), x.cast("string"))
    folder = F.when(k % 50 == 7, F.concat(F.lit("run/_case "), k.cast("string"))).when(k % 50 == 8, F.concat(name(k - 1), F.lit("/deep/case "), k.cast("string"))).when(k % 50 == 9, "run/overlays").otherwise(name(k))
    at = F.posexplode(F.array(*[F.lit(p) for p in _PATHS])).alias("i", "path")
    f = v.read(spark, sf_dir, "customer").select(k.alias("k"), folder.alias("folder"), at).withColumn("i", F.col("i") + 1)
    return f.where((F.col("k") * 7 + F.col("i") * F.col("i")) % 5 < 2)


def _best(name: str) -> str:
    return f"arg_min(path, list_position([{', '.join(repr(p) for p in af.ASSETS[name])}], path)) FILTER (list_position([{', '.join(repr(p) for p in af.ASSETS[name])}], path) > 0)"


_CASES = f"""{_FILES}, c AS (SELECT folder AS "case", {", ".join(f"{_best(a)} AS {a}" for a in af.ASSETS)} FROM files GROUP BY 1),
d AS (SELECT * FROM c WHERE coalesce(overview_pdf, overview_png, roi_pdf, embedding_pdf, counts_csv) IS NOT NULL AND NOT starts_with(split_part("case", '/', -1), '_') AND split_part("case", '/', -1) <> 'overlays'),
cases AS (SELECT * FROM d WHERE NOT EXISTS (SELECT 1 FROM d o WHERE starts_with(d."case", o."case" || '/')))"""


def _cases(spark, sf_dir):
    return af.cases(_files(spark, sf_dir).withColumnRenamed("folder", "case"))


@query(f"WITH {_CASES} SELECT * FROM cases")
def case_assets(spark, sf_dir):
    """Cases below a root with the best of each of their files; no case lies inside another."""
    return _cases(spark, sf_dir)


@query(f"""WITH {_CASES} SELECT "case", overview_pdf, row_number() OVER (ORDER BY CAST(regexp_extract("case", '(\\d+)$', 1) AS BIGINT)) AS place FROM cases WHERE "case" NOT LIKE '%deep%' AND regexp_matches("case", '[13579]$') ORDER BY place LIMIT 20""")
def first_cases(spark, sf_dir):
    """The first cases in natural order whose names match a pattern."""
    found = af.cases(_files(spark, sf_dir).where("folder not like '%deep%'").withColumnRenamed("folder", "case"), include=["*[13579]"]).select("case", "overview_pdf")
    return af.first_rows(found, [tx.natural_key(F.col("case")), F.col("case")], 20)


_has = ", ".join(f"{a} IS NOT NULL AS has_{a}" for a in af.ASSETS)


@query(f"""WITH {_CASES}, n AS (SELECT 'run/case ' || o_custkey AS "case", count(*) AS total FROM orders GROUP BY 1) SELECT "case", total, {_has} FROM cases LEFT JOIN n USING ("case")""")
def case_availability(spark, sf_dir):
    """Cells of each case, null without counts, and which files are there."""
    counts = v.read(spark, sf_dir, "orders").select(F.concat(F.lit("run/case "), F.col("o_custkey").cast("string")).alias("case"), F.lit(1).alias("n"))
    return af.availability(_cases(spark, sf_dir), counts)


@query(f"""WITH {_CASES}, e AS (SELECT "case", 1 AS n_section, CAST(counts_csv IS NOT NULL AS BIGINT) AS n_counts, CAST(coalesce(overview_pdf, overview_png) IS NOT NULL AS BIGINT) AS n_overview, least(length("case") % 9, 4) AS n_roi, length("case") % 3 AS n_embedding, CAST(ceil((length("case") % 7) / 2.0) AS BIGINT) AS n_spotlight FROM cases) SELECT *, n_section + n_counts + n_overview + n_roi + n_embedding + n_spotlight AS total FROM e""")
def case_slide_estimate(spark, sf_dir):
    """How many slides the parts of each case take, with a cap on pages (0: none)."""
    n = F.length("case")
    c = _cases(spark, sf_dir).withColumn("roi_pages", n % 9).withColumn("embedding_pages", n % 3).withColumn("spotlights", n % 7)
    return af.estimate(c, most_roi=4)


@query("SELECT p_partkey AS id, i AS page FROM part, range(0, 6) r(i) WHERE i < least(p_size % 8, 5)")
def included_pages(spark, sf_dir):
    p = v.read(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("id"), F.explode(af.page_numbers(F.col("p_size") % 8, 5)).alias("page"))


@query(f"""WITH {_FILES}, s AS (SELECT folder AS slide, bool_or(path IN ('cell_types/cell_type_coordinates.csv', 'cell_types/cell_type_coordinates.csv.gz')) AS is_, min(CASE path WHEN 'cell_types/cell_type_coordinates.csv.gz' THEN path END) AS best, min(CASE WHEN path = 'old/cell_type_coordinates.csv' THEN path END) AS other, min(CASE path WHEN 'cell_type_coordinates.npy' THEN path END) AS coordinates_npy, min(CASE path WHEN 'summary/summary.json' THEN path END) AS summary_json FROM files GROUP BY 1)
SELECT slide, coalesce(best, other) AS coordinates_csv, coordinates_npy, summary_json FROM s WHERE is_ AND slide NOT LIKE '%\\_case%' ESCAPE '\\'""")
def slide_folders(spark, sf_dir):
    """Result folders of slides with their coordinate tables and summaries, by name patterns."""
    return af.slide_folders(_files(spark, sf_dir).withColumnRenamed("folder", "slide"), exclude=["*_case*"])


@query("SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN 'a.tif' WHEN c_custkey % 5 = 0 THEN 'b.tif' WHEN c_custkey % 7 = 0 THEN 'd.tif' END AS slide FROM customer")
def source_slides(spark, sf_dir):
    """The first of the paths in a summary that is there."""
    k = F.col("c_custkey")
    text = F.concat(F.lit('{"processing_slide_path": "'), F.when(k % 3 == 0, "a.tif").otherwise("gone.tif"), F.lit('", "outputs": '), F.when(k % 5 == 0, '{"pyramidal_processing_slide": "b.tif"}').otherwise("{}"), F.lit(', "pyramidal_conversion": '), F.when(k % 7 == 0, '{"processing_l0_path": "c.tif", "source_l0_path": "d.tif"}').otherwise("null"), F.lit("}"))
    return v.read(spark, sf_dir, "customer").select(k.alias("id"), af.source_slide(text, F.array(F.lit("a.tif"), F.lit("b.tif"), F.lit("d.tif"))).alias("slide"))


_SPOTS = "files AS (SELECT p_brand AS \"case\", CASE p_partkey % 4 WHEN 0 THEN 'overlays/Tumor-Spot ' WHEN 1 THEN 'post_visualization/spatial_rois/r' WHEN 2 THEN 'overlays/tumor_spot/x' ELSE 'overlays/other' END || p_partkey || CASE p_partkey % 3 WHEN 0 THEN '.PNG' WHEN 1 THEN '.pdf' ELSE '.csv' END AS path FROM part)"


@query(f"""WITH {_SPOTS}, s AS (SELECT "case", path, row_number() OVER (PARTITION BY "case" ORDER BY CASE WHEN path LIKE 'overlays/Tumor-Spot %' THEN 1 WHEN path LIKE 'overlays/t%' THEN 2 ELSE 3 END, CAST(regexp_extract(path, '(\\d+)\\.', 1) AS BIGINT)) AS place FROM files WHERE path NOT LIKE '%.csv' AND path NOT LIKE '%other%') SELECT * FROM s WHERE place <= 9""")
def spotlight_files(spark, sf_dir):
    """Pictures by terms in any spelling, or in the regions' folder, in natural order, so many a case."""
    k = F.col("p_partkey")
    path = F.concat(F.when(k % 4 == 0, "overlays/Tumor-Spot ").when(k % 4 == 1, "post_visualization/spatial_rois/r").when(k % 4 == 2, "overlays/tumor_spot/x").otherwise("overlays/other"), k.cast("string"), F.when(k % 3 == 0, ".PNG").when(k % 3 == 1, ".pdf").otherwise(".csv"))
    files = v.read(spark, sf_dir, "part").select(F.col("p_brand").alias("case"), path.alias("path"))
    return af.spotlights(files, ["tumor spot", ""], [".png", ".pdf"], ["overview"], broad=True, most=9)


@query("SELECT p_brand || '/' || (p_size % 5) AS folder, bool_or(p_partkey % 3 = 0) AS has FROM part GROUP BY 1")
def raw_slide_folders(spark, sf_dir):
    k = F.col("p_partkey")
    path = F.concat("p_brand", F.lit("/"), (F.col("p_size") % 5).cast("string"), F.lit("/f."), k.cast("string"), F.when(k % 3 == 0, ".SVS").otherwise(".txt"))
    return af.folders_with(v.read(spark, sf_dir, "part").select(path.alias("path")), ["svs", ".mds"])


@query("SELECT CASE WHEN count(DISTINCT n_name) = 1 THEN min(n_name) END AS found, CASE WHEN count(DISTINCT n_name) > 1 THEN 'ambiguous' WHEN count(*) = 0 THEN 'none' END AS code FROM nation WHERE n_name IN ('NATION_3', 'NATION_99') UNION ALL SELECT NULL, 'ambiguous'")
def manifest_choice(spark, sf_dir):
    """The one manifest of two well-known names; two of them are no choice."""
    names = v.read(spark, sf_dir, "nation").select(F.col("n_name").alias("name"))
    return af.only_manifest(names, ["NATION_3", "NATION_99"]).unionAll(af.only_manifest(names, ["NATION_3", "NATION_4"]))


_CONTENT = View("files", "part", {
    "id": "p_partkey", "path": "concat('f', CAST(p_partkey AS STRING), CASE p_partkey % 5 WHEN 0 THEN '.csv' WHEN 1 THEN '.json' WHEN 2 THEN '.png' WHEN 3 THEN '.npy' ELSE '.txt' END)",
    "body": "CASE WHEN p_partkey % 5 = 0 THEN CASE WHEN p_partkey % 10 = 0 THEN 'a,b' ELSE ' ,,' END WHEN p_partkey % 5 = 1 THEN CASE WHEN p_partkey % 10 = 1 THEN '{\"a\": [1, null]}' ELSE '{\"a\": ' END ELSE CASE WHEN p_partkey % 7 = 0 THEN '' ELSE 'text' END END",
})


@query(f"WITH {_CONTENT.sql} SELECT id, CASE id % 5 WHEN 0 THEN id % 10 = 0 WHEN 1 THEN id % 10 = 1 WHEN 2 THEN id % 4 = 2 WHEN 3 THEN id % 4 = 3 ELSE body <> '' END AS valid FROM files")
def artifact_checks(spark, sf_dir):
    """Artifacts that are not empty and are what their suffix says."""
    head = F.when((F.col("id") % 5 == 2) & (F.col("id") % 4 == 2), F.lit(af.PNG)).when((F.col("id") % 5 == 3) & (F.col("id") % 4 == 3), F.lit(af.NPY)).otherwise(F.encode("body", "UTF-8"))
    f = _CONTENT(spark, sf_dir).withColumn("content", head).withColumn("length", F.octet_length("content"))
    return af.file_checks(f).select("id", "valid")


@query("SELECT s_name AS folder, max(l_quantity) > 49 AS nonempty FROM supplier JOIN lineitem ON l_suppkey = s_suppkey GROUP BY 1")
def nonempty_folders(spark, sf_dir):
    files = v.read(spark, sf_dir, "supplier").join(v.read(spark, sf_dir, "lineitem"), F.col("s_suppkey") == F.col("l_suppkey"))
    return af.nonempty_folders(files.select(F.col("s_name").alias("folder"), F.when(F.col("l_quantity") > 49, 1).otherwise(0).alias("length")))


@query("WITH w AS (SELECT c_custkey AS slide, c_custkey % 6 AS n FROM customer), f AS (SELECT slide, p AS patch, a FROM w, range(1, 7) r(p), (SELECT unnest(['rgb.tif', 'rgb.png', 'metadata.json']) AS a) WHERE (slide * 3 + p + length(a)) % 17 <> 0) SELECT slide, n > 0 AND count(patch) = n * 3 AS complete, CASE WHEN n > 0 THEN n * 3 - count(patch) END AS lacking FROM w LEFT JOIN f USING (slide) WHERE patch IS NULL OR patch <= n OR n = 0 GROUP BY slide, n")
def patch_report_checks(spark, sf_dir):
    """Each of n expected patches has all of its artifacts."""
    w = v.read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("slide"), (F.col("c_custkey") % 6).alias("n"))
    names = ["rgb.tif", "rgb.png", "metadata.json"]
    f = w.select("slide", F.explode(F.sequence(F.lit(1), F.lit(6))).alias("patch")).select("slide", "patch", F.explode(F.array(*[F.lit(a) for a in names])).alias("artifact"))
    f = f.where((F.col("slide") * 3 + F.col("patch") + F.length("artifact")) % 17 != 0).withColumn("valid", F.lit(True))
    return af.patch_reports(f, w, names)


@query("WITH a AS (SELECT c_custkey AS k, n FROM customer, (SELECT unnest(['counts', 'summary', 'plot']) AS n) WHERE (c_custkey + length(n)) % 4 <> 0) SELECT c_custkey AS sample_id, coalesce(bool_or(n = 'counts'), false) AS counts_exist, coalesce(bool_or(n = 'summary'), false) AS summary_exists, coalesce(bool_or(n = 'counts') AND bool_or(n = 'summary'), false) AS completed FROM customer LEFT JOIN a ON k = c_custkey GROUP BY 1")
def workflow_roster(spark, sf_dir):
    """Wanted samples with which results exist."""
    c = v.read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("sample_id"))
    have = c.select("sample_id", F.explode(F.array(*[F.lit(a) for a in ("counts", "summary", "plot")])).alias("artifact")).where((F.col("sample_id") + F.length("artifact")) % 4 != 0)
    return discovery.workflow_roster(c, have)


@query("WITH a AS (SELECT c_custkey AS slide_id, n, CASE WHEN (c_custkey + length(n)) % 5 = 0 THEN 0 ELSE 9 END AS length, (c_custkey * 3 + length(n)) % 7 <> 0 AS ok FROM customer, (SELECT unnest(['counts', 'plot', 'palette']) AS n)) SELECT slide_id, count(*) FILTER (length > 0 AND ok) = 3 AS complete, coalesce(string_agg(n, ';' ORDER BY n) FILTER (NOT (length > 0 AND ok)), '') AS missing FROM a GROUP BY 1")
def complete_exports(spark, sf_dir):
    """Slides whose required exports are there, not empty and valid."""
    names = ["counts", "plot", "palette"]
    a = v.read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("slide_id"), F.explode(F.array(*[F.lit(n) for n in names])).alias("artifact"))
    a = a.withColumn("length", F.when((F.col("slide_id") + F.length("artifact")) % 5 == 0, 0).otherwise(9)).withColumn("ok", (F.col("slide_id") * 3 + F.length("artifact")) % 7 != 0)
    return discovery.artifacts_complete(a, names)


@query("SELECT p_partkey AS id, CASE WHEN p_partkey % 4 = 0 THEN 'use_source' WHEN p_partkey % 3 = 0 AND coalesce(p_partkey % 5 = 0, false) THEN 'reuse' WHEN p_partkey % 3 = 0 THEN 'rebuild' ELSE 'build' END AS action FROM part")
def cache_decisions(spark, sf_dir):
    k = F.col("p_partkey")
    rows = v.read(spark, sf_dir, "part").select(k.alias("id"), (k % 4 == 0).alias("tiled"), (k % 3 == 0).alias("cached"), F.when(k % 7 != 0, k % 5 == 0).when(k % 5 == 0, True).alias("provenance_matches"))
    return discovery.cache_decision(rows).select("id", "action")


_LISTING = "f AS (SELECT o_orderkey AS k, 'set ' || (o_custkey % 9) || '/S' || (o_orderkey // 2) || CASE WHEN o_orderkey % 2 = 0 THEN '_L0_rgb.tif' ELSE '_L2_rgb.tif' END AS relative_path FROM (SELECT *, o_orderkey // 2 AS o_custkey FROM (SELECT o_orderkey FROM orders)) WHERE o_orderkey % 31 <> 1)"


@query(f"WITH {_LISTING} SELECT regexp_replace(regexp_replace(a.relative_path, '_L0_rgb.tif$', ''), '[^A-Za-z0-9._-]+', '_', 'g') AS sample_id, a.relative_path, a.k AS size_bytes, replace(a.relative_path, '_L0_', '_L2_') AS l2_path, b.relative_path IS NOT NULL AS l2_exists, CASE WHEN b.relative_path IS NULL THEN 'missing' ELSE 'present' END AS l2_state FROM f a LEFT JOIN f b ON b.relative_path = replace(a.relative_path, '_L0_', '_L2_') WHERE a.relative_path LIKE '%_L0_%'")
def discovered_manifest(spark, sf_dir):
    """A validated manifest of a listing: ids from paths, companions, fingerprints."""
    k = F.col("o_orderkey")
    half = F.floor(k / 2).cast("bigint")
    path = F.concat(F.lit("set "), (half % 9).cast("string"), F.lit("/S"), half.cast("string"), F.when(k % 2 == 0, "_L0_rgb.tif").otherwise("_L2_rgb.tif"))
    listing = v.read(spark, sf_dir, "orders").where("o_orderkey % 31 != 1").select(path.alias("relative_path"), k.alias("length"), F.lit("2024-01-01 00:00:00").cast("timestamp").alias("modified"))
    return discovery.manifest(listing, "optional").select("sample_id", "relative_path", "size_bytes", "l2_path", "l2_exists", "l2_state")


@query("SELECT count(*) AS rows, count(*) FILTER (o_orderstatus <> 'F') AS ok, count(*) FILTER (o_orderstatus = 'F') AS failed FROM orders")
def run_tally(spark, sf_dir):
    """Failed and other rows of a run's manifest; no status is no failure."""
    status = F.when(F.col("o_orderstatus") == "F", "failed").when(F.col("o_orderstatus") == "O", "done")
    return af.run_tally(v.read(spark, sf_dir, "orders").select(status.alias("status")))


# ---- names and numbers

_NAMES = View("n", "part", {
    "id": "p_partkey", "list": "concat(' a, ', p_brand, ',, ', CAST(p_size AS STRING), ' ')", "grid": "CASE p_partkey % 5 WHEN 0 THEN '3x3' WHEN 1 THEN ' 4 X 4 ' WHEN 2 THEN '3x4' WHEN 3 THEN '0x0' ELSE 'big' END",
    "number": "CASE p_partkey % 5 WHEN 0 THEN ' 12 ' WHEN 1 THEN '0' WHEN 2 THEN '-4' WHEN 3 THEN '1.5' ELSE CAST(p_size AS STRING) END",
    "record": "CASE p_partkey % 5 WHEN 0 THEN '123/' WHEN 1 THEN '10.5281/repo.456' WHEN 2 THEN 'https://repo.example/records/789?x=1' WHEN 3 THEN 'https://repo.example/record/12' ELSE 'none 5' END",
    "ext": "CASE p_partkey % 3 WHEN 0 THEN 'TIF' WHEN 1 THEN '.Svs' ELSE 'mds' END", "remote": "CASE p_partkey % 4 WHEN 0 THEN ' ok-1.csv ' WHEN 1 THEN '../up' WHEN 2 THEN '.hidden' ELSE p_brand END",
    "length": "CAST(p_partkey * 7 % 4001 AS DOUBLE)",
})


@query(f"""WITH {_NAMES.sql} SELECT id, array_to_string(list_filter(list_transform(string_split(list, ','), lambda x: trim(x)), lambda x: x <> ''), '|') AS items, CASE id % 5 WHEN 0 THEN 3 WHEN 1 THEN 4 END AS grid, CASE WHEN TRY_CAST(number AS DOUBLE) > 0 AND number <> '1.5' THEN CAST(trim(number) AS BIGINT) END AS number,
CASE id % 5 WHEN 0 THEN '123' WHEN 1 THEN '456' WHEN 2 THEN '789' WHEN 3 THEN '12' END AS record, CASE id % 3 WHEN 0 THEN '.tif' WHEN 1 THEN '.svs' ELSE '.mds' END AS ext, CASE id % 4 WHEN 0 THEN 'ok-1.csv' WHEN 3 THEN CASE WHEN regexp_full_match(remote, '[A-Za-z0-9][A-Za-z0-9._-]*') THEN remote END END AS remote,
CASE WHEN length < 1000 THEN CAST(length AS BIGINT) || ' um' WHEN length % 1000 = 0 THEN CAST(length / 1000 AS BIGINT) || ' mm' ELSE printf('%.1f', length / 1000) || ' mm' END AS label FROM n""")
def parsed_names(spark, sf_dir):
    """Lists, grids, numbers, record ids, extensions, file names and lengths as text."""
    n = _NAMES(spark, sf_dir)
    c = F.col
    return n.select("id", F.array_join(tx.items(c("list")), "|").alias("items"), tx.square_grid(c("grid")).alias("grid"), tx.positive_int(c("number")).alias("number"), tx.record_number(c("record"), "repo").alias("record"), tx.extension(c("ext")).alias("ext"), tx.safe_name(c("remote")).alias("remote"), tx.scale_label(c("length")).alias("label"))


@query("SELECT p_partkey AS id, CASE p_partkey % 3 WHEN 0 THEN 'case_' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') WHEN 1 THEN 'case_000000007' ELSE 'odd_name_' || p_partkey END AS sample_id, CASE p_partkey % 3 WHEN 0 THEN 'x/case ' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') WHEN 1 THEN 'x/case 000000007/1' ELSE 'x/odd (name) ' || p_partkey END AS label FROM part")
def container_ids(spark, sf_dir):
    """Sample ids of container files, and short labels of their paths."""
    k = F.col("p_partkey")
    path = F.when(k % 3 == 0, F.concat(F.lit("x/case_"), F.lpad(k.cast("string"), 9, "0"), F.lit(".mds"))).when(k % 3 == 1, "x/case_000000007/1.MDS").otherwise(F.concat(F.lit("x/odd (name) "), k.cast("string"), F.lit(".mds")))
    return v.read(spark, sf_dir, "part").select(k.alias("id"), tx.container_id(path, "^case_[0-9]{9}$").alias("sample_id"), tx.short_label(F.concat(F.lit("/root/post/"), path), "/root", ["post/"]).alias("label"))


@query("SELECT p_partkey AS id, list_sort(list_distinct([encode('set_' || p_size), encode('run/set_' || p_size || '/s' || p_partkey), encode('run/set_' || p_size)]))::VARCHAR AS utf8, 2 * (length('set_' || p_size) + length('run/set_' || p_size || '/s' || p_partkey) + length('run/set_' || p_size)) AS wide_bytes, array_to_string(list_sort(['run/set_' || p_size, lower(p_brand || p_name)]), '|') AS markers FROM part")
def source_marker_sets(spark, sf_dir):
    """Bytes and texts that could betray a source."""
    path = F.concat(F.lit("run/set_"), F.col("p_size").cast("string"), F.lit("/s"), F.col("p_partkey").cast("string"))
    variants = tx.marker_variants(path)
    # of each text both encodings are there; the wide ones hold a zero as their second byte
    narrow = F.filter(variants, lambda b: F.substring(b, 2, 1) != F.lit(b"\0"))
    wide = F.filter(variants, lambda b: F.substring(b, 2, 1) == F.lit(b"\0"))
    total = F.aggregate(wide, F.lit(0), lambda a, b: a + F.octet_length(b)).cast("bigint")
    markers = tx.source_markers(F.concat("p_brand", "p_name"), F.lit("1.mds"), F.concat(F.lit("run/set_"), F.col("p_size").cast("string")), F.lit(None).cast("string"))
    shown = F.concat(F.lit("["), F.array_join(F.transform(narrow, lambda b: F.decode(b, "UTF-8")), ", "), F.lit("]"))
    return v.read(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), shown.alias("utf8"), total.alias("wide_bytes"), F.array_join(markers, "|").alias("markers"))


@query("SELECT p_partkey AS id, greatest(14, CASE WHEN p_partkey % 14 <= 14 - p_partkey % 14 THEN p_partkey // 14 * 14 ELSE p_partkey // 14 * 14 + 14 END) AS tile, round(0.25::DOUBLE * p_size / (1 + p_partkey % 7), 9) AS mpp, round(10000 / (0.25::DOUBLE * p_size / (1 + p_partkey % 7)), 6) AS ppcm, round(p_partkey / (1.0::DOUBLE + p_size), 9) AS ratio, CASE WHEN p_partkey % 3 = 0 THEN 0.5 WHEN p_partkey % 3 = 1 AND p_partkey % 2 = 0 THEN 0.25 END AS chosen FROM part")
def level_scales(spark, sf_dir):
    """Tile edges, scales of levels, and the scale of a source: an override, else what is embedded, never a target's."""
    k, size = F.col("p_partkey"), F.col("p_size")
    mpp = geo.level_mpp(F.lit(0.25), size, 1 + k % 7)
    override = F.when(k % 3 == 0, F.lit(0.5)).when(k % 3 == 2, F.lit(float("nan")))
    chosen = geo.chosen_mpp(override, F.when(k % 2 == 0, F.lit(0.25)).otherwise(F.lit(float("inf"))))
    return v.read(spark, sf_dir, "part").select(k.alias("id"), geo.nearest_multiple(k, 14).alias("tile"), F.round(mpp, 9).alias("mpp"), F.round(geo.pixels_per_centimetre(mpp), 6).alias("ppcm"), F.round(geo.rational(k, 1 + size), 9).alias("ratio"), chosen.alias("chosen"))


@query("SELECT p_partkey AS id, CASE p_partkey % 5 WHEN 1 THEN 'deflate' WHEN 2 THEN 'deflate' WHEN 3 THEN 'lzw' END AS codec, CASE WHEN p_partkey % 5 IN (1, 2) THEN p_size % 12 END AS level FROM part WHERE NOT (p_partkey % 5 IN (1, 2) AND p_size % 12 > 9)")
def compression_settings(spark, sf_dir):
    k = F.col("p_partkey")
    name = F.when(k % 5 == 0, " None").when(k % 5 == 1, "ZLIB").when(k % 5 == 2, "deflate").when(k % 5 == 3, "LZW").otherwise("uncompressed")
    c = v.read(spark, sf_dir, "part").select(k.alias("id"), tx.compression(name, F.col("p_size") % 12).alias("c")).where("c is not null")
    return c.select("id", "c.codec", "c.level")


@query("WITH l AS (SELECT p_brand AS file, CASE WHEN p_partkey % 3 = 0 THEN 'Level ' || p_partkey ELSE CAST(p_partkey / 4.0 AS VARCHAR) END AS name, p_partkey FROM part) SELECT file, p_partkey AS id, CAST(row_number() OVER (PARTITION BY file ORDER BY p_partkey % 3 = 0, CASE WHEN p_partkey % 3 <> 0 THEN -p_partkey END, lower(name)) - 1 AS BIGINT) AS place FROM l")
def level_name_order(spark, sf_dir):
    """Level names: numbers first, the greatest first, then text."""
    from pyspark.sql import Window as W

    k = F.col("p_partkey")
    name = F.when(k % 3 == 0, F.concat(F.lit("Level "), k.cast("string"))).otherwise((k / 4).cast("string"))
    p = v.read(spark, sf_dir, "part").select(F.col("p_brand").alias("file"), k.alias("id"), name.alias("name"))
    return p.select("file", "id", (F.row_number().over(W.partitionBy("file").orderBy(*tx.natural_level(F.col("name")))) - 1).cast("bigint").alias("place"))


@query("WITH s AS (SELECT p_brand AS level, list(p_partkey ORDER BY p_partkey) AS a FROM part GROUP BY 1) SELECT level, a[1] || CASE WHEN len(a) > 1 AND len(a) // 2 <> len(a) - 1 THEN ',' || a[len(a) // 2 + 1] ELSE '' END || CASE WHEN len(a) > 1 THEN ',' || a[len(a)] ELSE '' END AS n FROM s")
def sampled_streams(spark, sf_dir):
    """The first, middle and last stream of each level."""
    s = v.read(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("level")).agg(F.array_sort(F.collect_list("p_partkey")).alias("a"))
    return s.select("level", F.array_join(tx.sampled(F.col("a")).cast("array<string>"), ",").alias("n"))


@query("SELECT p_partkey AS id, p_partkey % 4 <> 1 AND p_partkey % 5 <> 2 AS same FROM part")
def creator_comparison(spark, sf_dir):
    """Lists of creators agree place by place in the fields that are given."""
    k = F.col("p_partkey")
    one = lambda name, orcid: F.struct(name.alias("name"), orcid.alias("orcid"))
    none = F.lit(None).cast("string")
    wanted = F.array(one(F.lit("a"), F.lit("1")), one(F.lit("b"), none))
    have = F.when(k % 5 == 2, F.array(one(F.lit("a"), F.lit("1")))).otherwise(F.array(one(F.lit("a"), F.when(k % 4 == 1, none).otherwise(F.lit("1"))), one(F.lit("b"), F.lit("9"))))
    return v.read(spark, sf_dir, "part").select(k.alias("id"), tx.matching_structs(have, wanted, ["name", "orcid"]).alias("same"))


@query("SELECT p_partkey AS id, 'model=' || p_brand || ';rev=' || CASE WHEN p_partkey % 3 = 0 THEN '' ELSE p_type END || ';px=' || p_size AS identity, CASE p_partkey % 3 WHEN 1 THEN '{\"available\":false}' WHEN 2 THEN '{\"available\":true,\"sha256\":\"' || md5(p_name) || '\"}' END AS companion, hex(encode(left(p_name, p_size::INTEGER))) || repeat('00', greatest(0, p_size - length(p_name))::INTEGER) AS padded FROM part")
def identity_documents(spark, sf_dir):
    """Identities as text and JSON, and neutral bytes of a size."""
    k = F.col("p_partkey")
    identity = af.signature({"model": F.col("p_brand"), "rev": F.when(k % 3 != 0, F.col("p_type")), "px": F.col("p_size")})
    companion = af.companion_fingerprint(k % 3 != 0, k % 3 == 2, F.md5("p_name"))
    return v.read(spark, sf_dir, "part").select(k.alias("id"), identity.alias("identity"), companion.alias("companion"), F.hex(tx.padded(F.col("p_name"), F.col("p_size"))).alias("padded"))


@query("SELECT o_orderkey AS id, sha256('{\"customer\":' || o_custkey || ',\"status\":\"' || o_orderstatus || '\"}') AS signature FROM orders")
def processing_signatures(spark, sf_dir):
    """Digests of canonical JSON documents."""
    o = v.read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("customer"), F.col("o_orderstatus").alias("status"))
    return o.select("id", F.sha2(hs.canonical_json("status", "customer"), 256).alias("signature"))


# ---- shapes


@query(f"WITH {v.CELLS} SELECT cell_id, round(bbox_x0, 6) AS x0, round(bbox_y0, 6) AS y0, round(bbox_x1, 6) AS x1, round(bbox_y1, 6) AS y1, round(x / 120000, 9) AS nx, round(y / 60000, 9) AS ny FROM cells")
def polygon_bounds(spark, sf_dir):
    """Boxes of polygons, and coordinates as shares of the slide."""
    corner = lambda x, y: F.struct(F.col(f"bbox_{x}").alias("x"), F.col(f"bbox_{y}").alias("y"))
    b = geo.bounds(F.array(F.array(corner("x0", "y0"), corner("x1", "y0"), corner("x1", "y1"), corner("x0", "y1"))))
    norm = lambda c, n: F.round(geo.normalised(F.col(c), F.lit(n)), 9)
    return v.cells(spark, sf_dir).select("cell_id", *[F.round(c, 6).alias(n) for n, c in b.items()], norm("x", 120000).alias("nx"), norm("y", 60000).alias("ny"))


@query(f"WITH {v.CELLS} SELECT cell_id, round(greatest(0, least(bbox_x1, 60000) - greatest(bbox_x0, 30000)) * greatest(0, least(bbox_y1, 30000) - greatest(bbox_y0, 20000)), 3) AS area FROM cells WHERE bbox_x1 > 30000 AND bbox_x0 < 60000 AND bbox_y1 > 20000 AND bbox_y0 < 30000")
def clipped_polygons(spark, sf_dir):
    """Polygons cut to a region, by their areas."""
    corner = lambda x, y: F.struct(F.col(f"bbox_{x}").alias("x"), F.col(f"bbox_{y}").alias("y"))
    ring = F.array(corner("x0", "y0"), corner("x1", "y0"), corner("x1", "y1"), corner("x0", "y1"))
    inside = v.cells(spark, sf_dir).where("bbox_x1 > 30000 and bbox_x0 < 60000 and bbox_y1 > 20000 and bbox_y0 < 30000")
    cut = geo.clipped(ring, F.lit(30000), F.lit(20000), F.lit(60000), F.lit(30000))
    return inside.select("cell_id", cut.alias("ring")).select("cell_id", F.round(geo.ring_area(F.col("ring")), 3).alias("area"))


@query("SELECT p_partkey AS id, CASE WHEN p_partkey % 4 = 0 THEN 0 WHEN p_partkey % 4 = 1 THEN 1 ELSE 2 END AS rings, CASE WHEN p_partkey % 4 = 0 THEN '[]' WHEN p_partkey % 4 = 1 THEN '[[[' || p_size || '.0,0.0],[1.0,2.0]]]' ELSE '[[[' || p_size || '.0,0.0],[1.0,2.0]],[[5.0,6.0]]]' END AS coordinates FROM part")
def exterior_rings(spark, sf_dir):
    """Exterior rings of collections of polygons, as JSON; holes and empty parts are left out."""
    k = F.col("p_partkey")
    point = lambda x, y: F.struct(F.lit(x).cast("double").alias("x") if not hasattr(x, "cast") else x.cast("double").alias("x"), F.lit(y).cast("double").alias("y"))
    outer = F.array(point(F.col("p_size"), 0), point(1, 2))
    one = F.array(outer, F.array(point(9, 9)))  # with a hole
    kind = "array<array<array<struct<x:double,y:double>>>>"
    polygons = F.when(k % 4 == 0, F.array().cast(kind)).when(k % 4 == 1, F.array(one, F.array().cast("array<array<struct<x:double,y:double>>>"))).otherwise(F.array(one, F.array(F.array(point(5, 6)))))
    rings = geo.exteriors(polygons)
    return v.read(spark, sf_dir, "part").select(k.alias("id"), F.size(rings).alias("rings"), geo.coordinates_json(rings).alias("coordinates"))


@query("SELECT p_partkey AS id, ('0x' || substr(c, 2, 2))::INTEGER AS r, ('0x' || substr(c, 4, 2))::INTEGER AS g, ('0x' || substr(c, 6, 2))::INTEGER AS b FROM (SELECT p_partkey, '#' || substr(md5(CAST(p_partkey AS VARCHAR)), 1, 6) AS c FROM part)")
def colour_channels(spark, sf_dir):
    k = F.col("p_partkey")
    c = geo.rgb_of_hex(F.concat(F.lit("#"), F.substring(F.md5(k.cast("string")), 1, 6)))
    return v.read(spark, sf_dir, "part").select(k.alias("id"), c.alias("c")).select("id", *[F.col("c")[i].alias(n) for i, n in enumerate("rgb")])


@query(f"WITH {v.CELLS} SELECT cell_id, CAST(row_number() OVER (ORDER BY (bbox_x1 - bbox_x0) * (bbox_y1 - bbox_y0) // 1, cell_id) AS BIGINT) AS place FROM cells")
def draw_order(spark, sf_dir):
    """All cells by area; ties by id."""
    area = (F.col("bbox_x1") - F.col("bbox_x0")) * (F.col("bbox_y1") - F.col("bbox_y0"))  # of doubles DuckDB's // is the plain quotient
    return af.first_rows(v.cells(spark, sf_dir).select("cell_id", area.alias("area")), [F.col("area"), F.col("cell_id")], 0).select("cell_id", "place")


@query("SELECT p_type AS id, arg_min(p_name, p_partkey) AS name FROM part GROUP BY 1")
def first_name_wins(spark, sf_dir):
    return af.first_name(v.read(spark, sf_dir, "part"), "p_type", [F.col("p_partkey")], "p_name").select(F.col("p_type").alias("id"), F.col("p_name").alias("name"))


@query("SELECT c_custkey AS id, CAST((row_number() OVER (ORDER BY lower(c_name), c_custkey) - 1) // 64 AS INTEGER) AS batch FROM customer")
def batches(spark, sf_dir):
    """A roster in batches of 64."""
    return matrices.batches(v.read(spark, sf_dir, "customer"), [F.lower("c_name"), F.col("c_custkey")], 64).select(F.col("c_custkey").alias("id"), "batch")


@query("SELECT o_orderkey AS id, CAST(row_number() OVER (ORDER BY CASE WHEN o_orderstatus <> 'F' THEN o_orderstatus END NULLS LAST, o_totalprice, o_orderkey) AS BIGINT) AS place FROM orders")
def nulls_last_order(spark, sf_dir):
    """A stable order by several keys, nulls last, over a whole table."""
    status = F.when(F.col("o_orderstatus") != "F", F.col("o_orderstatus"))
    o = ranking.ordered(v.read(spark, sf_dir, "orders"), [status.isNull(), F.coalesce(status, F.lit("")), F.col("o_totalprice"), F.col("o_orderkey")], "place")
    return o.select(F.col("o_orderkey").alias("id"), "place")
