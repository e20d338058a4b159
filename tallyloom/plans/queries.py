"""Queries by name: each applies one operator to a view of the driver's tables; SQL holds the same for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import geometry as geo
from ..functions import hashing as hs
from ..functions import text as tx
from ..operators import cohort, integrity, linkage, matrices, ranking, sampling, spatial, stats, validate
from ..operators import features as ft
from ..operators import ml as mlx
from . import views as v

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def _long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cohort.pooled(cohort.class_counts(v.cells(spark, sf_dir), "slide_id"), v.sample_map(spark, sf_dir))


# ---- counts, fractions, matrices


@query(f"WITH {v.CELLS} SELECT slide_id, class_id, class_name, count(*) AS n FROM cells GROUP BY ALL")
def class_counts_by_slide(spark, sf_dir):
    return cohort.class_counts(v.cells(spark, sf_dir), "slide_id")


@query(f"WITH {v.LONG} SELECT * FROM long")
def celltype_counts_long(spark, sf_dir):
    return _long(spark, sf_dir)


@query(f"WITH {v.LONG} SELECT sample_id, class_id, cell_type, n, round(n / sum(n) OVER (PARTITION BY sample_id), 10) AS fraction FROM long")
def celltype_fractions_long(spark, sf_dir):
    return cohort.fractions(_long(spark, sf_dir)).withColumn("fraction", F.round("fraction", 10))


_pivot = ", ".join(f"CAST(coalesce(sum(n) FILTER (sample_id = '{s}'), 0) AS BIGINT) AS {s}" for s in v.SAMPLES)


@query(f"WITH {v.LONG} SELECT class_id, cell_type, {_pivot} FROM long GROUP BY ALL")
def celltype_counts_matrix(spark, sf_dir):
    return cohort.matrix(_long(spark, sf_dir), v.SAMPLES)


_shares = ", ".join(f"coalesce(round(sum(f) FILTER (sample_id = '{s}'), 10), 0) AS {s}" for s in v.SAMPLES)


@query(f"WITH {v.LONG} SELECT class_id, cell_type, {_shares} FROM (SELECT *, n / sum(n) OVER (PARTITION BY sample_id) AS f FROM long) GROUP BY ALL")
def celltype_fractions_matrix(spark, sf_dir):
    wide = cohort.matrix(cohort.fractions(_long(spark, sf_dir)), v.SAMPLES, "fraction", 0.0)
    return wide.withColumns({s: F.round(s, 10) for s in v.SAMPLES})


@query(f"WITH {v.LONG}, part AS (SELECT * FROM long WHERE class_id % 4 <> 1 OR sample_id <> 'sample_3') SELECT s.sample_id, c.class_id, c.cell_type, coalesce(n, 0) AS n FROM (SELECT DISTINCT sample_id FROM sample_map) s CROSS JOIN (SELECT DISTINCT class_id, cell_type FROM long) c LEFT JOIN part p ON p.sample_id = s.sample_id AND p.class_id = c.class_id")
def sample_class_dense_grid(spark, sf_dir):
    long = _long(spark, sf_dir)
    return cohort.dense(long.where("class_id % 4 <> 1 or sample_id <> 'sample_3'"), v.sample_map(spark, sf_dir), long)


def _audit(spark, sf_dir):
    base = v.roster(spark, sf_dir)
    totals = v.read(spark, sf_dir, "lineitem").groupBy(F.concat(F.lit("supplier_"), F.col("l_suppkey").cast("string")).alias("slide_id")).agg(F.count(F.lit(1)).alias("total"))
    return cohort.audit(base, totals)


@query(f"WITH {v.AUDIT} SELECT slide_id, included, status, reason, total_cells FROM audit")
def slide_audit(spark, sf_dir):
    return _audit(spark, sf_dir).select("slide_id", "included", "status", "reason", "total_cells")


@query(f"WITH {v.AUDIT} SELECT status, coalesce(reason, '') AS reason, count(*) AS n FROM audit GROUP BY ALL")
def audit_status_histogram(spark, sf_dir):
    return _audit(spark, sf_dir).groupBy("status", F.coalesce("reason", F.lit("")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {v.AUDIT}, {v.LONG} SELECT a.*, b.* FROM (SELECT count(*) AS n_slides, count_if(included) AS n_included, count_if(NOT included) AS n_excluded, CAST(sum(total_cells) AS BIGINT) AS total_cells FROM audit) a CROSS JOIN (SELECT count(DISTINCT sample_id) AS n_samples, count(DISTINCT cell_type) AS n_cell_types FROM long) b")
def cohort_rollup(spark, sf_dir):
    return cohort.rollup(_audit(spark, sf_dir), _long(spark, sf_dir))


@query(f"WITH {v.LONG} SELECT cell_type, CAST(sum(n) AS BIGINT) AS n, round(sum(n) * 100.0 / sum(sum(n)) OVER (), 8) AS percent FROM long GROUP BY 1 ORDER BY n DESC, cell_type LIMIT 12")
def aggregate_top_classes(spark, sf_dir):
    return cohort.top_classes(_long(spark, sf_dir), 12).withColumn("percent", F.round("percent", 8))


@query(f"WITH {v.SUMMARIES} SELECT array_to_string(list_sort(list(DISTINCT CAST(percent_slide AS INTEGER)) FILTER (percent_slide IS NOT NULL)), ',') AS percents, array_to_string(list_sort(list(DISTINCT random_seed) FILTER (random_seed IS NOT NULL)), ',') AS seeds, CASE WHEN bool_or(percent_slide < 100 AND random_seed IS NULL) THEN 'missing_seed' WHEN bool_or(percent_slide IS NULL) AND bool_or(percent_slide < 100) THEN 'legacy_and_sampled' WHEN count(DISTINCT percent_slide) > 1 OR count(DISTINCT random_seed) > 1 THEN 'mixed_sampling' END AS violation FROM summaries")
def sampling_homogeneity(spark, sf_dir):
    h = cohort.homogeneity(v.summaries(spark, sf_dir))
    return h.select(F.array_join(F.col("percents").cast("array<int>").cast("array<string>"), ",").alias("percents"), F.array_join(F.col("seeds").cast("array<string>"), ",").alias("seeds"), "violation")


# ---- constraints

_CLASSES = "classes AS (SELECT p_size AS class_id, p_brand AS class_name FROM part)"


@query(f"WITH {_CLASSES} SELECT 'name_has_ids' AS kind, class_name AS key, count(DISTINCT class_id) AS n FROM classes GROUP BY 2 HAVING n > 1 UNION ALL SELECT 'id_has_names', CAST(class_id AS VARCHAR), count(DISTINCT class_name) AS n FROM classes WHERE class_id >= 0 GROUP BY 2 HAVING n > 1")
def class_mapping_violations(spark, sf_dir):
    return validate.class_mapping(v.read(spark, sf_dir, "part").select(F.col("p_size").alias("class_id"), F.col("p_brand").alias("class_name")))


@query("WITH o AS (SELECT l_orderkey, count(*) AS observed FROM lineitem GROUP BY 1) SELECT o_orderkey AS slide_id, 4 AS declared, coalesce(observed, 0) AS observed FROM orders LEFT JOIN o ON l_orderkey = o_orderkey WHERE coalesce(observed, 0) <> 4")
def count_total_mismatch(spark, sf_dir):
    observed = v.read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("observed"))
    declared = v.read(spark, sf_dir, "orders").select("o_orderkey", F.lit(4).alias("declared"))
    both = declared.join(observed, F.col("l_orderkey") == F.col("o_orderkey"), "left").withColumn("observed", F.coalesce("observed", F.lit(0)))
    return both.where("declared <> observed").select(F.col("o_orderkey").alias("slide_id"), "declared", "observed")


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING n > 1")
def duplicate_key_violations(spark, sf_dir):
    return validate.duplicates(v.read(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")


@query("SELECT DISTINCT c_custkey AS id FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def roster_anti_join(spark, sf_dir):
    return validate.missing(v.read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id")), v.read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id")), "id")


@query("SELECT code, key FROM (SELECT 'blank_source' AS code, CAST(doc_id AS VARCHAR) AS key FROM documents WHERE trim(source) = '' UNION ALL SELECT 'short_text', CAST(doc_id AS VARCHAR) FROM documents WHERE n_chars < 300 UNION ALL SELECT 'unknown_language', CAST(doc_id AS VARCHAR) FROM documents WHERE lang NOT IN ('en', 'de', 'fr'))")
def rule_violations(spark, sf_dir):
    rules = [validate.Rule("blank_source", F.trim("source") == ""), validate.Rule("short_text", F.col("n_chars") < 300), validate.Rule("unknown_language", ~F.col("lang").isin("en", "de", "fr"))]
    return validate.violations(v.read(spark, sf_dir, "documents"), "doc_id", rules).select("code", "key")


# ---- reconciling


@query(f"WITH {v.MANIFEST} SELECT coalesce(w.key, t.key) AS key, CASE WHEN t.key IS NULL THEN 'pending' WHEN w.key IS NULL THEN 'extra' WHEN coalesce(w.size <> t.size, false) OR coalesce(w.md5 <> t.md5, false) THEN 'differs' ELSE 'verified' END AS status FROM wanted w FULL JOIN there t ON w.key = t.key")
def manifest_remote_reconcile(spark, sf_dir):
    return integrity.reconcile(*v.manifest(spark, sf_dir))


@query(f"WITH {v.MANIFEST} SELECT 'missing' AS side, key FROM wanted WHERE key NOT IN (SELECT key FROM there) UNION ALL SELECT 'extra', key FROM there WHERE key NOT IN (SELECT key FROM wanted)")
def manifest_two_sided_except(spark, sf_dir):
    return integrity.two_sided_except(*v.manifest(spark, sf_dir))


@query(f"WITH {v.MANIFEST}, s AS (SELECT CASE WHEN t.key IS NULL THEN 'pending' WHEN w.key IS NULL THEN 'extra' WHEN coalesce(w.size <> t.size, false) OR coalesce(w.md5 <> t.md5, false) THEN 'differs' ELSE 'verified' END AS status, w.size FROM wanted w FULL JOIN there t ON w.key = t.key) SELECT status, count(*) AS files, CAST(coalesce(sum(size), 0) AS BIGINT) AS bytes FROM s GROUP BY 1")
def transfer_plan(spark, sf_dir):
    return integrity.transfer_plan(*v.manifest(spark, sf_dir))


@query(f"WITH {v.MANIFEST} SELECT coalesce(w.key, t.key) AS key, CASE WHEN w.key IS NULL THEN 'missing_left' WHEN t.key IS NULL THEN 'missing_right' WHEN w.size IS DISTINCT FROM t.size THEN 'size' WHEN w.md5 IS DISTINCT FROM t.md5 THEN 'md5' END AS problem FROM wanted w FULL JOIN there t ON w.key = t.key WHERE problem IS NOT NULL")
def field_mismatches(spark, sf_dir):
    return integrity.matched(*v.manifest(spark, sf_dir), ["key"], ["size", "md5"])


@query("SELECT o_custkey AS key, array_to_string(list_sort(list(DISTINCT o_orderpriority)), '|') AS levels FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') GROUP BY 1 HAVING count(DISTINCT o_orderpriority) = 2")
def complete_pairs(spark, sf_dir):
    pairs = integrity.complete_sets(v.read(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "key"), "key", "o_orderpriority", ["1-URGENT", "2-HIGH"])
    return pairs.select("key", F.array_join("levels", "|").alias("levels"))


# ---- space

_GRID = f"""{v.CELLS}, k AS (SELECT slide_id, class_id, count(*) AS c FROM cells GROUP BY ALL),
w AS (SELECT slide_id, class_id, sqrt(sum(c) OVER (PARTITION BY slide_id) / greatest(c, 1)) AS raw FROM k),
r AS (SELECT slide_id, class_id, CAST(raw / greatest(1.0, max(raw) OVER (PARTITION BY slide_id)) AS FLOAT) AS rarity FROM w),
g AS (SELECT slide_id, CAST(floor(x / 12000.0) AS BIGINT) AS gx, CAST(floor(y / 12000.0) AS BIGINT) AS gy, count(*) AS n, median(x) AS medx, median(y) AS medy,
             count(DISTINCT class_id) AS n_classes, sum(CAST(rarity AS DOUBLE)) AS rare_sum FROM cells JOIN r USING (slide_id, class_id) GROUP BY 1, 2, 3)"""


@query(f"WITH {_GRID} SELECT slide_id, gx, gy, n, round(medx, 4) AS medx, round(medy, 4) AS medy, n_classes, round(rare_sum, 5) AS rare_sum, round(n * (1 + 0.20 * n_classes) + 0.35 * rare_sum, 5) AS score FROM g")
def density_grid(spark, sf_dir):
    g = spatial.density_grid(v.cells(spark, sf_dir), 12000)
    return g.withColumns({c: F.round(c, 4 if c.startswith("med") else 5) for c in ("medx", "medy", "rare_sum", "score")})


_ZOOM = f"""{v.CELLS}, b AS (SELECT slide_id, floor(x / 8000) AS gx, floor(y / 8000) AS gy, count(*) AS n, median(x) AS mx, median(y) AS my FROM cells GROUP BY 1, 2, 3),
f AS (SELECT slide_id, CAST(round_even(mx, 0) AS BIGINT) AS cx, CAST(round_even(my, 0) AS BIGINT) AS cy FROM b QUALIFY row_number() OVER (PARTITION BY slide_id ORDER BY n DESC, gx, gy) = 1),
l AS (SELECT slide_id, greatest(0, least(120000 - 8000, cx - 4000)) AS x0, greatest(0, least(60000 - 8000, cy - 4000)) AS y0 FROM f)"""


@query(f"WITH {_ZOOM} SELECT slide_id, x0, y0, least(120000, x0 + 8000) AS x1, least(60000, y0 + 8000) AS y1 FROM l")
def zoom_box(spark, sf_dir):
    return spatial.zoom_box(v.cells(spark, sf_dir), 120000, 60000, 8000)


def _greedy(size: int, most: int, distance: float, relaxed: bool) -> str:
    """Recursive SQL that takes the boxes of ranked (slide_id, place, cx, cy) one after the other."""
    box = lambda c, edge: f"greatest(0, least({edge} - {size}, CAST(round_even({c} - {size} / 2.0, 0) AS BIGINT)))"
    near = f"len(list_filter(taken, lambda t: (t.cx - r.cx) * (t.cx - r.cx) + (t.cy - r.cy) * (t.cy - r.cy) < {distance * distance})) = 0"
    first = f"""g AS (SELECT DISTINCT slide_id, 0::BIGINT AS place, CAST([] AS STRUCT(cx DOUBLE, cy DOUBLE)[]) AS taken FROM ranked UNION ALL
SELECT g.slide_id, r.place, CASE WHEN len(taken) < {most} AND {near} THEN list_append(taken, {{'cx': r.cx, 'cy': r.cy}}) ELSE taken END FROM g JOIN ranked r ON r.slide_id = g.slide_id AND r.place = g.place + 1),
t AS (SELECT slide_id, arg_max(taken, place) AS taken FROM g GROUP BY 1), b AS (SELECT slide_id, list_transform(taken, lambda p: {{'x0': {box('p.cx', 120000)}, 'y0': {box('p.cy', 60000)}}}) AS boxes FROM t)"""
    second = f""", h AS (SELECT slide_id, 0::BIGINT AS place, boxes FROM b UNION ALL SELECT h.slide_id, r.place, CASE WHEN len(boxes) < {most} AND NOT list_contains(boxes, {{'x0': {box('r.cx', 120000)}, 'y0': {box('r.cy', 60000)}}}) THEN list_append(boxes, {{'x0': {box('r.cx', 120000)}, 'y0': {box('r.cy', 60000)}}}) ELSE boxes END
FROM h JOIN ranked r ON r.slide_id = h.slide_id AND r.place = h.place + 1), z AS (SELECT slide_id, arg_max(boxes, place) AS boxes FROM h GROUP BY 1)"""
    source = "z" if relaxed else "b"
    return f"{first}{second if relaxed else ''} SELECT slide_id, CAST(i AS INTEGER) AS rank, boxes[i].x0 AS x0, boxes[i].y0 AS y0, least(120000, boxes[i].x0 + {size}) AS x1, least(60000, boxes[i].y0 + {size}) AS y1 FROM {source}, range(1, {most + 1}) r(i) WHERE i <= len(boxes)"


@query(f"""WITH RECURSIVE {v.CELLS}, n AS (SELECT slide_id, floor(x / 6000) AS gx, floor(y / 6000) AS gy, count(*) AS n, median(x) AS cx, median(y) AS cy FROM cells GROUP BY 1, 2, 3), ranked AS (SELECT slide_id, row_number() OVER (PARTITION BY slide_id ORDER BY n DESC, gx, gy) AS place, cx, cy FROM n), {_greedy(6000, 5, 9000.0, False)}""")
def qc_patches_greedy(spark, sf_dir):
    return spatial.qc_patches(v.cells(spark, sf_dir), 6000, 5, 1.5, 120000, 60000)


@query(f"""WITH RECURSIVE {_GRID}, ranked AS (SELECT slide_id, row_number() OVER (PARTITION BY slide_id ORDER BY round(n * (1 + 0.20::DOUBLE * n_classes) + 0.35::DOUBLE * rare_sum, 9) DESC, gx, gy) AS place, medx AS cx, medy AS cy FROM g0), {_greedy(12000, 6, 10200.0, True)}""".replace("g AS (SELECT slide_id, CAST(floor(x / 12000.0)", "g0 AS (SELECT slide_id, CAST(floor(x / 12000.0)"))
def roi_selection(spark, sf_dir):
    return spatial.rois(v.cells(spark, sf_dir), 12000, 6, 120000, 60000)


@query(f"WITH {v.CELLS}, {v.BOXES} SELECT roi, class_id, count(*) AS n FROM cells c JOIN boxes b ON c.slide_id = b.slide_id AND x >= x0 AND x < x1 AND y >= y0 AND y < y1 GROUP BY ALL")
def roi_class_counts(spark, sf_dir):
    return spatial.contained(v.cells(spark, sf_dir), v.boxes(spark, sf_dir), 3000).groupBy("roi", "class_id").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {v.CELLS}, {v.BOXES} SELECT roi, class_id, count(*) AS n FROM cells c JOIN boxes b ON c.slide_id = b.slide_id AND bbox_x1 > x0 AND bbox_x0 < x1 AND bbox_y1 > y0 AND bbox_y0 < y1 GROUP BY ALL")
def roi_overlap_counts(spark, sf_dir):
    return spatial.overlapping(v.cells(spark, sf_dir), v.boxes(spark, sf_dir), 3000, reach=20).groupBy("roi", "class_id").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {v.CELLS}, {v.PATCHES}, h AS (SELECT cell_id, arg_min(p, patch_id) AS p FROM cells JOIN patches p ON x >= mosaic_x0 AND x < mosaic_x0 + width AND y >= mosaic_y0 AND y < mosaic_y0 + height GROUP BY 1) SELECT cell_id, coalesce(p.patch_id, -1) AS patch_id, round(x + (p.source_x0 - p.mosaic_x0), 4) AS x, round(y + (p.source_y0 - p.mosaic_y0), 4) AS y FROM cells LEFT JOIN h USING (cell_id)")
def patch_remap(spark, sf_dir):
    moved = spatial.patch_remap(v.cells(spark, sf_dir), v.patches(spark, sf_dir), 2600)
    return moved.select("cell_id", "patch_id", F.round("x", 4).alias("x"), F.round("y", 4).alias("y"))


@query(f"WITH {v.CELLS} SELECT cell_id, slide_id, class_id FROM cells QUALIFY row_number() OVER (PARTITION BY slide_id, class_id, floor(x / 6000), floor(y / 6000) ORDER BY md5(cell_id || '|7'), cell_id) = 1")
def grid_thinning(spark, sf_dir):
    cells = v.cells(spark, sf_dir).withColumn("digest", hs.rank_hash(F.col("cell_id"), seed=7))
    return spatial.grid_thinned(cells, 6000, "digest").select("cell_id", "slide_id", "class_id")


_TILES = "tiles AS (SELECT DISTINCT p_brand AS brand, CAST(p_partkey % 7 AS INTEGER) AS r, CAST(p_size % 5 AS INTEGER) AS c FROM part)"


@query(f"WITH {_TILES}, e AS (SELECT brand, max(r) AS mr, max(c) AS mc FROM tiles GROUP BY 1), g AS (SELECT brand, r.r, c.c FROM e, range(0, 7) r(r), range(0, 5) c(c) WHERE r.r <= mr AND c.c <= mc) SELECT g.brand, CAST(g.r AS INTEGER) AS \"row\", CAST(g.c AS INTEGER) AS \"column\", t.r IS NOT NULL AS filled FROM g LEFT JOIN tiles t ON t.brand = g.brand AND t.r = g.r AND t.c = g.c")
def dense_tile_scan(spark, sf_dir):
    p = v.read(spark, sf_dir, "part").select(F.col("p_brand").alias("brand"), (F.col("p_partkey") % 7).cast("int").alias("row"), (F.col("p_size") % 5).cast("int").alias("column"))
    return spatial.dense_tiles(p, "brand")


# ---- samples


@query(f"WITH {v.CELLS} SELECT cell_id, slide_id, n_total, n_keep FROM (SELECT *, count(*) OVER (PARTITION BY slide_id) AS n_total, CAST(greatest(1, least(count(*) OVER (PARTITION BY slide_id), ceil(count(*) OVER (PARTITION BY slide_id) * 10.0 / 100))) AS BIGINT) AS n_keep, row_number() OVER (PARTITION BY slide_id ORDER BY md5(cell_id || '|11'), cell_id) AS r FROM cells) WHERE r <= n_keep")
def tile_sample_exact(spark, sf_dir):
    return sampling.exact_sample(v.cells(spark, sf_dir).select("cell_id", "slide_id"), "cell_id", 10.0, 11, ("slide_id",)).select("cell_id", "slide_id", "n_total", "n_keep")


@query()
def stratified_sample_sizes(spark, sf_dir):
    counts = v.cells(spark, sf_dir).groupBy("class_name").agg(F.count(F.lit(1)).alias("n"))
    return sampling.allocations(counts, "class_name", 1200).select("class_name", F.col("alloc").cast("int").alias("alloc"))


@query()
def stratified_sample(spark, sf_dir):
    return sampling.stratified_sample(v.cells(spark, sf_dir).select("cell_id", "class_name"), "cell_id", "class_name", 1200, 5)


@query(f"WITH {v.CLINICAL} SELECT doc_id, CAST((row_number() OVER (PARTITION BY outcome ORDER BY md5(doc_id || '|0|3'), doc_id) - 1) % 5 AS INTEGER) AS fold FROM clinical WHERE outcome IS NOT NULL")
def stratified_folds(spark, sf_dir):
    return sampling.stratified_folds(v.clinical(spark, sf_dir).where("outcome is not null").select("doc_id", "outcome"), "doc_id", "outcome", 5, 3).select("doc_id", "fold")


_AUC = "(sum(CASE WHEN y = 1 THEN r END) - sum(y) * (sum(y) + 1) / 2.0) / (sum(y) * (count(*) - sum(y)))"


@query(f"""WITH {v.SCORES}, n AS (SELECT *, row_number() OVER (PARTITION BY y ORDER BY md5(doc_id || '|9'), doc_id) AS i, count(*) OVER (PARTITION BY y) AS size FROM scores),
d AS (SELECT b.b, n.y, CAST(('0x' || substr(md5(concat_ws('|', b.b, n.y, n.i, 9)), 1, 8)) AS BIGINT) % n.size + 1 AS i FROM n, range(1, 1001) b(b)),
s AS (SELECT d.b, n.y, n.p, rank() OVER (PARTITION BY d.b ORDER BY n.p) + (count(*) OVER (PARTITION BY d.b, n.p) - 1) / 2.0 AS r FROM d JOIN n ON n.y = d.y AND n.i = d.i),
a AS (SELECT b, {_AUC} AS auc FROM s GROUP BY 1) SELECT 'roc_auc' AS metric, round(quantile_cont(auc, 0.025), 8) AS low, round(quantile_cont(auc, 0.975), 8) AS high FROM a""")
def bootstrap_auc_ci(spark, sf_dir):
    draws = sampling.bootstrap_counts(v.scores(spark, sf_dir).select("doc_id", "y", "p"), "doc_id", "y", 1000, 9, ["y", "p"])
    auc = stats.metrics(draws, by=("repeat",), weight="drawn").select("repeat", F.col("roc_auc").alias("auc"))
    return stats.intervals(auc, "auc").select(F.lit("roc_auc").alias("metric"), F.round("low", 8).alias("low"), F.round("high", 8).alias("high"))


# ---- features


@query(f"WITH {v.CELLS}, b AS (SELECT cell_id, greatest(bbox_x1 - bbox_x0, 0) AS w, greatest(bbox_y1 - bbox_y0, 0) AS h FROM cells) SELECT cell_id, round(w, 5) AS w, round(h, 5) AS h, round(w * h, 4) AS area, round(CASE WHEN h > 0 THEN w / h END, 5) AS aspect, round(ln(1 + w * h), 5) AS log_area FROM b")
def bbox_features(spark, sf_dir):
    f = geo.box_features(*[F.col(f"bbox_{c}") for c in ("x0", "y0", "x1", "y1")])
    return v.cells(spark, sf_dir).select("cell_id", *[F.round(c, 4 if n == "area" else 5).alias(n) for n, c in f.items()])


@query(f"WITH {v.CELLS}, b AS (SELECT cell_id, bbox_x1 - bbox_x0 AS w, bbox_y1 - bbox_y0 AS h FROM cells) SELECT cell_id, round(w * h * 0.25, 4) AS area, round(2 * (w + h) * 0.5, 4) AS perimeter, 4 AS vertices, round(4 * pi() * w * h / (4 * (w + h) * (w + h)), 6) AS compactness FROM b")
def polygon_features(spark, sf_dir):
    corner = lambda x, y: F.struct(F.col(f"bbox_{x}").alias("x"), F.col(f"bbox_{y}").alias("y"))
    ring = F.array(corner("x0", "y0"), corner("x1", "y0"), corner("x1", "y1"), corner("x0", "y1"))
    f = geo.polygon_features(F.array(ring), 0.5)
    return v.cells(spark, sf_dir).select("cell_id", F.round(f["area"], 4).alias("area"), F.round(f["perimeter"], 4).alias("perimeter"), f["vertices"].alias("vertices"), F.round(f["compactness"], 6).alias("compactness"))


_RGB = "c AS (SELECT p_partkey, (p_partkey * 7 % 256) / 255.0::DOUBLE AS r, (p_partkey * 13 % 256) / 255.0::DOUBLE AS g, (p_size * 5 % 256) / 255.0::DOUBLE AS b FROM part)"


@query(f"WITH {_RGB}, d AS (SELECT *, 0.299::DOUBLE * r + 0.587::DOUBLE * g + 0.114::DOUBLE * b AS gray FROM c) SELECT p_partkey AS id, round(gray, 6) AS gray, round((greatest(r, g, b) - least(r, g, b)) / greatest(greatest(r, g, b), 1e-6::DOUBLE), 6) AS saturation, round((r + b) / 2 - g, 6) AS purple, round(r - b, 6) AS eosin, round(1 - gray, 6) AS darkness FROM d")
def stain_proxies(spark, sf_dir):
    p = v.read(spark, sf_dir, "part")
    channel = lambda c, k: (F.col(c) * k % 256) / F.lit(255.0)
    shades = geo.stain_proxies(channel("p_partkey", 7), channel("p_partkey", 13), channel("p_size", 5))
    return p.select(F.col("p_partkey").alias("id"), *[F.round(c, 6).alias(n) for n, c in shades.items()])


@query(f"WITH {v.FEATURES}, m AS (SELECT j, avg(v::DOUBLE) AS m, stddev_pop(v::DOUBLE) AS s FROM features GROUP BY 1) SELECT vec_id AS id, j, round((v - m) / CASE WHEN s <= 1e-8 THEN 1 ELSE s END, 5) AS z FROM features JOIN m USING (j)")
def zscore_features(spark, sf_dir):
    return ft.zscores(v.features(spark, sf_dir)).select(F.col("vec_id").alias("id"), "j", F.round("z", 5).alias("z"))


@query(f"WITH {v.CELLS} SELECT cell_id AS id, " + ", ".join(f"CAST(class_id = {i} AS INTEGER) AS class_{i}" for i in range(15)) + " FROM cells")
def one_hot_classes(spark, sf_dir):
    return ft.one_hot(v.cells(spark, sf_dir).select(F.col("cell_id").alias("id"), "class_id"), "class_id", list(range(15))).drop("class_id")


@query()
def pca_embedding(spark, sf_dir):
    pc = ft.principal_components(v.read(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return pc.select(F.col("vec_id").alias("id"), F.round(F.abs(F.col("components")[0]), 5).alias("c1"), F.round(F.abs(F.col("components")[1]), 5).alias("c2"))


@query(f"WITH {v.LONG}, f AS (SELECT sample_id, class_id, n / sum(n) OVER (PARTITION BY sample_id) AS f FROM long) SELECT sample_id, class_id, round(ln(f + 1e-6) - avg(ln(f + 1e-6)) OVER (PARTITION BY sample_id), 7) AS clr FROM f")
def clr_transform(spark, sf_dir):
    return ft.clr(cohort.fractions(_long(spark, sf_dir))).select("sample_id", "class_id", F.round("clr", 7).alias("clr"))


@query(f"WITH {v.LONG} SELECT sample_id, class_id, round(ln(1 + n), 8) AS v, CAST(sum(n) OVER (PARTITION BY sample_id) = 0 AS INTEGER) AS zero FROM long")
def log1p_counts(spark, sf_dir):
    return ft.log_counts(_long(spark, sf_dir)).select("sample_id", "class_id", F.round("v", 8).alias("v"), "zero")


# ---- linkage

_LINK = f"""{v.CLINICAL}, c AS (SELECT 'DOC-' || doc_id AS key, outcome FROM clinical WHERE doc_id % 10 <> 1),
m AS (SELECT 'DOC-' || doc_id AS key FROM documents WHERE doc_id % 10 <> 2), a AS (SELECT 'DOC-' || doc_id AS key, doc_id % 10 <> 4 AS completed FROM documents WHERE doc_id % 10 <> 3),
linked AS (SELECT key, c.key IS NOT NULL AS in_clinical, m.key IS NOT NULL AS in_matrix, a.key IS NOT NULL AS in_audit, coalesce(completed, false) AS completed, outcome,
  c.key IS NOT NULL AND m.key IS NOT NULL AND coalesce(completed, false) AND outcome IS NOT NULL AS included,
  concat_ws(';', CASE WHEN c.key IS NULL THEN 'missing_clinical_row' END, CASE WHEN m.key IS NULL THEN 'missing_matrix_column' END,
    CASE WHEN a.key IS NULL THEN 'missing_audit_row' WHEN NOT coalesce(completed, false) THEN 'slide_not_completed' END, CASE WHEN outcome IS NULL THEN 'missing_or_unmapped_outcome' END) AS reason
  FROM c FULL JOIN m USING (key) FULL JOIN a USING (key))"""


def _linked(spark, sf_dir):
    # ids as they come: other separators, case and suffixes than the key
    c = linkage.keyed(v.clinical(spark, sf_dir).where("doc_id % 10 <> 1").withColumn("id", F.concat(F.lit("doc_"), "doc_id", F.lit(".svs"))), "id")
    d = v.read(spark, sf_dir, "documents")
    m = linkage.keyed(d.where("doc_id % 10 <> 2").select(F.concat(F.lit(" Doc "), "doc_id", F.lit(" L0 RGB HE 1")).alias("id")), "id")
    a = linkage.keyed(d.where("doc_id % 10 <> 3").select(F.concat(F.lit("DOC-"), "doc_id", F.lit("_HE_1")).alias("id"), (F.col("doc_id") % 10 != 4).alias("completed")), "id")
    return linkage.linkage(c, m, a)


@query(f"WITH {_LINK} SELECT * FROM linked")
def linkage_audit(spark, sf_dir):
    return _linked(spark, sf_dir)


@query(f"WITH {_LINK} SELECT unnest(string_split(reason, ';')) AS reason, count(*) AS n FROM linked WHERE reason <> '' GROUP BY 1")
def exclusion_reasons(spark, sf_dir):
    return linkage.reason_histogram(_linked(spark, sf_dir))


@query("SELECT c_custkey AS key, c_mktsegment AS segment, n_orders, total FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1) ON o_custkey = c_custkey")
def all_roster_augmented(spark, sf_dir):
    c = v.read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.col("c_mktsegment").alias("segment"))
    o = v.read(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("key")).agg(F.count(F.lit(1)).alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    return linkage.roster_with(c, o)


@query(f"WITH {_LINK} SELECT key, outcome, lang, n_chars FROM (SELECT key, outcome FROM linked WHERE included) JOIN (SELECT 'DOC-' || doc_id AS key, lang, n_chars FROM documents) USING (key)")
def analysis_cohort(spark, sf_dir):
    d = v.read(spark, sf_dir, "documents").select(F.concat(F.lit("DOC-"), "doc_id").alias("key"), "lang", "n_chars")
    return linkage.analysis_cohort(_linked(spark, sf_dir), d)


@query(f"WITH {v.CLINICAL} SELECT feature, n_missing, n_missing / n AS fraction FROM (SELECT 'lang' AS feature, count_if(lang IS NULL OR trim(lang) = '') AS n_missing, count(*) AS n FROM clinical UNION ALL SELECT 'n_chars', count_if(n_chars IS NULL), count(*) FROM clinical UNION ALL SELECT 'outcome', count_if(outcome IS NULL), count(*) FROM clinical)")
def missingness(spark, sf_dir):
    return linkage.missingness(v.clinical(spark, sf_dir), ["lang", "n_chars", "outcome"])


@query(f"WITH {v.CLINICAL} SELECT lang AS value, count_if(outcome = 0) AS n0, count_if(outcome = 1) AS n1 FROM clinical GROUP BY 1")
def crosstab_outcome(spark, sf_dir):
    return linkage.crosstab(v.clinical(spark, sf_dir), "lang")


# ---- tests and metrics

_NUM = f"{v.CLINICAL}, x AS (SELECT 'n_chars' AS feature, CAST(n_chars AS DOUBLE) AS value, outcome FROM clinical UNION ALL SELECT 'bucket', CAST(n_chars // 500 AS DOUBLE), outcome FROM clinical)"
_MWU = f"""{_NUM}, k AS (SELECT *, rank() OVER (PARTITION BY feature ORDER BY value) + (count(*) OVER (PARTITION BY feature, value) - 1) / 2.0 AS r, count(*) OVER (PARTITION BY feature, value) AS t FROM x WHERE outcome IS NOT NULL),
s AS (SELECT feature, count(*)::DOUBLE AS n, sum(outcome)::DOUBLE AS n1, sum(CASE WHEN outcome = 1 THEN r END) AS r1, sum(t * t - 1)::DOUBLE AS ties FROM k GROUP BY 1),
u AS (SELECT *, n - n1 AS n0, r1 - n1 * (n1 + 1) / 2 AS u FROM s)"""


def _numbers(spark, sf_dir):
    c = v.clinical(spark, sf_dir)
    one = lambda name, x: c.select(F.lit(name).alias("feature"), x.cast("double").alias("value"), "outcome")
    return one("n_chars", F.col("n_chars")).unionAll(one("bucket", F.floor(F.col("n_chars") / 500)))


@query(f"WITH {_MWU} SELECT feature, CAST(n0 AS BIGINT) AS n0, CAST(n1 AS BIGINT) AS n1, u, round(2 * u / (n1 * n0) - 1, 8) AS effect, round((u - n0 * n1 / 2 - sign(u - n0 * n1 / 2) * 0.5) / sqrt(n0 * n1 / 12 * (n + 1 - ties / (n * (n - 1)))), 6) AS z FROM u")
def mann_whitney_u(spark, sf_dir):
    m = stats.mann_whitney(_numbers(spark, sf_dir))
    return m.select("feature", "n0", "n1", "u", F.round("effect", 8).alias("effect"), F.round("z", 6).alias("z"))


_CAT = f"{v.CLINICAL}, x AS (SELECT 'lang' AS feature, lang AS value, outcome FROM clinical WHERE outcome IS NOT NULL UNION ALL SELECT 'source', source, outcome FROM clinical WHERE outcome IS NOT NULL)"


@query(f"""WITH {_CAT}, o AS (SELECT feature, value, outcome, count(*) AS o FROM x GROUP BY ALL), t AS (SELECT feature, sum(o) AS n, count(DISTINCT value) AS r, count(DISTINCT outcome) AS c FROM o GROUP BY 1),
e AS (SELECT a.feature, a.value, b.outcome, a.rn * b.cn / n AS e, n, r, c FROM (SELECT feature, value, sum(o) AS rn FROM o GROUP BY 1, 2) a JOIN (SELECT feature, outcome, sum(o) AS cn FROM o GROUP BY 1, 2) b USING (feature) JOIN t USING (feature)),
q AS (SELECT feature, n, r, c, sum((coalesce(o, 0) - e) * (coalesce(o, 0) - e) / e) AS x FROM e LEFT JOIN o USING (feature, value, outcome) GROUP BY 1, 2, 3, 4)
SELECT feature, round(x, 6) AS chi2, CAST((r - 1) * (c - 1) AS INTEGER) AS dof, round(sqrt(x / (n * (least(r, c) - 1))), 6) AS v FROM q""")
def chi_square_cramers_v(spark, sf_dir):
    c = v.clinical(spark, sf_dir).where("outcome is not null")
    x = c.select(F.lit("lang").alias("feature"), F.col("lang").alias("value"), "outcome").unionAll(c.select(F.lit("source"), "source", "outcome"))
    return stats.chi_square(x).select("feature", F.round("chi2", 6).alias("chi2"), "dof", F.round("v", 6).alias("v"))


@query()
def fisher_exact(spark, sf_dir):
    c = v.clinical(spark, sf_dir).where("outcome is not null")
    cell = lambda long, y: F.count_if((F.col("n_chars") > 2000 if long else F.col("n_chars") <= 2000) & (F.col("outcome") == y))
    table = c.groupBy(F.col("lang").alias("feature")).agg(cell(True, 1).alias("a"), cell(True, 0).alias("b"), cell(False, 1).alias("c"), cell(False, 0).alias("d"))
    return stats.fisher(table)


_P = "p AS (SELECT 'f' || p_partkey AS feature, CASE WHEN p_partkey % 9 <> 0 THEN (p_partkey * 7919 % 10007) / 10007.0::DOUBLE END AS p FROM part)"


@query(f"WITH {_P}, r AS (SELECT *, row_number() OVER (ORDER BY p, feature) AS r, count(*) OVER () AS m FROM p WHERE p IS NOT NULL) SELECT feature, round(p, 9) AS p, round(least(1, min(p * m / r) OVER (ORDER BY r DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)), 9) AS q FROM r UNION ALL SELECT feature, p, NULL FROM p WHERE p IS NULL")
def bh_fdr(spark, sf_dir):
    k = F.col("p_partkey")
    p = v.read(spark, sf_dir, "part").select(F.concat(F.lit("f"), k.cast("string")).alias("feature"), F.when(k % 9 != 0, k * 7919 % 10007 / F.lit(10007.0)).alias("p"))
    return stats.benjamini_hochberg(p).select("feature", F.round("p", 9).alias("p"), F.round("q", 9).alias("q"))


@query()
def univariate_tests(spark, sf_dir):
    c = v.clinical(spark, sf_dir)
    one = lambda n: c.select(F.lit(n).alias("feature"), F.col(n).cast("string").alias("value"), "outcome")
    return stats.univariate(one("lang").unionAll(one("source")).unionAll(one("n_chars"))).select("feature", "kind", F.round("statistic", 6).alias("statistic"), F.round("effect", 6).alias("effect"), F.round("p", 9).alias("p"), F.round("q", 9).alias("q"))


@query(f"""WITH {v.SCORES}, c AS (SELECT count_if(p >= 0.5 AND y = 1)::DOUBLE AS tp, count_if(p >= 0.5 AND y = 0)::DOUBLE AS fp, count_if(p < 0.5 AND y = 0)::DOUBLE AS tn, count_if(p < 0.5 AND y = 1)::DOUBLE AS fn, avg((p - y) * (p - y)) AS brier FROM scores)
SELECT round((tp / (tp + fn) + tn / (tn + fp)) / 2, 8) AS balanced_accuracy, round(tp / (tp + fn), 8) AS sensitivity, round(tn / (tn + fp), 8) AS specificity, round(tp / (tp + fp), 8) AS "precision", round(tn / (tn + fn), 8) AS npv,
round(2 * tp / (2 * tp + fp + fn), 8) AS f1, round((tp * tn - fp * fn) / sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)), 8) AS mcc, round(brier, 8) AS brier FROM c""")
def confusion_metrics(spark, sf_dir):
    m = stats.confusion(v.scores(spark, sf_dir))
    return m.select(*[F.round(c, 8).alias(c) for c in m.columns])


@query(f"WITH {v.SCORES}, s AS (SELECT y, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0 AS r FROM scores) SELECT round({_AUC}, 8) AS value FROM s")
def roc_auc_exact(spark, sf_dir):
    return stats.roc_auc(v.scores(spark, sf_dir)).select(F.round("auc", 8).alias("value"))


@query(f"WITH {v.SCORES}, g AS (SELECT p, count(*) AS n, sum(y) AS pos FROM scores GROUP BY 1), c AS (SELECT pos, sum(pos) OVER w AS tp, sum(n) OVER w AS k, sum(pos) OVER () AS n1 FROM g WINDOW w AS (ORDER BY p DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) SELECT round(sum(pos / n1 * tp / k), 8) AS value FROM c")
def average_precision_exact(spark, sf_dir):
    return stats.average_precision(v.scores(spark, sf_dir)).select(F.round("ap", 8).alias("value"))


@query(f"WITH {v.SCORES}, g AS (SELECT p, count(*) AS n, sum(y) AS pos FROM scores GROUP BY 1), c AS (SELECT p, sum(pos) OVER w AS tp, sum(n) OVER w AS k, sum(pos) OVER () AS n1, sum(n) OVER () AS al FROM g WINDOW w AS (ORDER BY p DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) SELECT round(p, 6) AS threshold, round((k - tp) / (al - n1), 8) AS fpr, round(tp / n1, 8) AS tpr, round(tp / k, 8) AS \"precision\" FROM c")
def roc_curve_points(spark, sf_dir):
    return stats.roc_points(v.scores(spark, sf_dir)).select(F.round("threshold", 6).alias("threshold"), F.round("fpr", 8).alias("fpr"), F.round("tpr", 8).alias("tpr"), F.round("precision", 8).alias("precision"))


_edges = ", ".join(str(i / 10) for i in range(1, 10))


@query(f"WITH {v.SCORES}, e AS (SELECT quantile_cont(p, [{_edges}]) AS e FROM scores) SELECT CAST(len(list_filter(e, lambda x: x < p)) + 1 AS INTEGER) AS bin, count(*) AS n, round(avg(p), 8) AS mean_p, round(avg(y), 8) AS observed FROM scores, e GROUP BY 1")
def calibration_bins(spark, sf_dir):
    return stats.calibration(v.scores(spark, sf_dir)).select("bin", "n", F.round("mean_p", 8).alias("mean_p"), F.round("observed", 8).alias("observed"))


@query(f"WITH {_NUM} SELECT feature, outcome, count(value) AS n, median(value) AS median, quantile_cont(value, 0.25) AS q25, quantile_cont(value, 0.75) AS q75 FROM x WHERE outcome IS NOT NULL GROUP BY 1, 2")
def median_iqr(spark, sf_dir):
    return stats.quartiles(_numbers(spark, sf_dir).where("outcome is not null"), by=("feature", "outcome"))


def _predictions(spark, sf_dir):
    s = v.scores(spark, sf_dir)
    one = lambda name, c, k: s.select(F.col("doc_id").alias("analysis_id"), F.lit(k).alias("repeat"), F.lit(name).alias("feature_set"), F.lit("m").alias("model"), F.col("y").alias("y_true"), F.col(c).alias("y_probability"))
    return one("base", "p", 0).unionAll(one("base", "p2", 1)).unionAll(one("more", "p2", 0))


@query(f"""WITH {v.SCORES}, a AS (SELECT doc_id, y, (p + p2) / 2 AS base, p2 AS more FROM scores),
k AS (SELECT *, rank() OVER (ORDER BY base) + (count(*) OVER (PARTITION BY base) - 1) / 2.0 AS rb, rank() OVER (ORDER BY more) + (count(*) OVER (PARTITION BY more) - 1) / 2.0 AS rm FROM a)
SELECT 'm' AS model, 'roc_auc' AS metric, round((sum(CASE WHEN y = 1 THEN rm - rb END)) / (sum(y) * (count(*) - sum(y))), 8) AS delta FROM k UNION ALL SELECT 'm', 'brier', round(avg((base - y) * (base - y)) - avg((more - y) * (more - y)), 8) FROM a""")
def oof_average_and_delta(spark, sf_dir):
    return stats.paired_delta(stats.averaged(_predictions(spark, sf_dir)), "base", "more", 8).withColumn("delta", F.round("delta", 8))


# ---- text


@query("SELECT s_name AS id, row_number() OVER (ORDER BY CAST(regexp_extract(s_name, '(\\d+)', 1) AS BIGINT), s_name) AS rank FROM supplier")
def natural_sort_rank(spark, sf_dir):
    names = v.read(spark, sf_dir, "supplier").select(F.col("s_name").alias("id"))
    return ranking.ordered(names, [tx.natural_key(F.col("id")), F.col("id")])


_URL = "SELECT DISTINCT url AS raw FROM pages"


@query(f"SELECT raw, regexp_replace(regexp_replace(raw, '[^A-Za-z0-9._-]+', '_', 'g'), '^[._-]+|[._-]+$', '', 'g') AS out FROM ({_URL})")
def slug_ids(spark, sf_dir):
    return v.read(spark, sf_dir, "pages").select(F.col("url").alias("raw")).distinct().withColumn("out", tx.slug(F.col("raw")))


@query("SELECT c_name AS raw, trim(regexp_replace(upper(c_name), '[-_\\s]+', '-', 'g'), '-') AS out FROM customer")
def normalized_ids(spark, sf_dir):
    return v.read(spark, sf_dir, "customer").select(F.col("c_name").alias("raw")).withColumn("out", tx.slide_key(F.col("raw")))


@query("SELECT DISTINCT p_type AS raw, upper(trim(regexp_replace(p_type, '[^A-Za-z0-9]+', '_', 'g'), '_')) AS out FROM part")
def feature_slugs(spark, sf_dir):
    return v.read(spark, sf_dir, "part").select(F.col("p_type").alias("raw")).distinct().withColumn("out", tx.feature_slug(F.col("raw")))


_BOOLS = ["true", " Yes", "NO", "1", "0", "si", "sí", "y", "n", "maybe", ""]
_pick = "[" + ", ".join(f"'{b}'" for b in _BOOLS) + "]"
_in = lambda d, i: ", ".join(f"'{x}'" for x in tx.BOOLEANS[d][i])
_dialects = ", ".join(f"CASE WHEN t IN ({_in(d, 0)}) THEN true WHEN t IN ({_in(d, 1)}) THEN false END AS {d}" for d in ("cohort", "clinical", "strict"))


@query(f"SELECT id, raw, {_dialects}, t IN ({_in('truthy', 0)}) AS truthy FROM (SELECT id, raw, lower(trim(raw)) AS t FROM (SELECT p_partkey AS id, ({_pick})[p_partkey % {len(_BOOLS)} + 1] AS raw FROM part))")
def parse_bool_dialects(spark, sf_dir):
    raw = F.array(*[F.lit(b) for b in _BOOLS])[(F.col("p_partkey") % len(_BOOLS)).cast("int")]
    return v.read(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), raw.alias("raw")).withColumns({d: tx.parse_bool(F.col("raw"), d) for d in tx.BOOLEANS})


_FORMS = ["cancer CELLS", "Lymphocyte", "fibro-blasts", "RBC", "Erythrocytes", "Minor stromal cell", "Endothelial  Cells", "unknown thing", "mitosis", "Epithelial"]
_forms = "[" + ", ".join(f"'{b}'" for b in _FORMS) + "]"
_compact = {"".join(c for c in n.lower() if c.isalnum()): i for i, n in enumerate(tx.CLASS_NAMES)} | tx.COMPACT_ALIASES
_ids = "MAP {" + ", ".join(f"'{k}': {i}" for k, i in _compact.items()) + "}"
_spaced = {n.lower(): n for n in tx.CLASS_NAMES[1:]} | {k: tx.CLASS_NAMES[i] for k, i in tx.SPACED_ALIASES.items()}
_namemap = "MAP {" + ", ".join(f"'{k}': '{n}'" for k, n in _spaced.items()) + "}"


@query(f"SELECT id, raw, coalesce({_namemap}[trim(regexp_replace(lower(raw), '[^a-z0-9]+', ' ', 'g'))], trim(raw)) AS name, coalesce({_ids}[regexp_replace(lower(raw), '[^a-z0-9]', '', 'g')], -1) AS class_id FROM (SELECT p_partkey AS id, ({_forms})[p_partkey % {len(_FORMS)} + 1] AS raw FROM part)")
def class_alias_lookup(spark, sf_dir):
    raw = F.array(*[F.lit(b) for b in _FORMS])[(F.col("p_partkey") % len(_FORMS)).cast("int")]
    return v.read(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), raw.alias("raw")).select("id", "raw", tx.class_name(F.col("raw")).alias("name"), tx.class_id(F.col("raw")).alias("class_id"))


@query("SELECT p_partkey AS id, p_name AS name FROM part WHERE (p_name GLOB '*[aeiou]*n*' OR p_name GLOB '*1?') AND NOT p_name GLOB '*00*'")
def glob_filter(spark, sf_dir):
    return v.read(spark, sf_dir, "part").where(tx.matches(F.col("p_name"), ["*[aeiou]*n*", "*1?"], ["*00*"])).select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))


_MARKERS = ["password", "api_key", "licensed under", "@example"]


@query("SELECT doc_id, m AS marker FROM documents, (SELECT unnest(['" + "', '".join(_MARKERS) + "']) AS m) WHERE contains(lower(text), m)")
def marker_leak_scan(spark, sf_dir):
    return v.read(spark, sf_dir, "documents").select("doc_id", F.explode(tx.mentions(F.col("text"), _MARKERS)).alias("marker"))


@query("SELECT page_id, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)) AS host, regexp_matches(url, '^https://[^/?#@:]+(:\\d+)?(/[^?#]*)?$') AS ok FROM pages")
def url_origin_check(spark, sf_dir):
    return v.read(spark, sf_dir, "pages").select("page_id", tx.host(F.col("url")).alias("host"), tx.https_origin(F.col("url")).alias("ok"))


# ---- digests, states


@query("SELECT o_orderkey AS id, substr(sha256(concat_ws(chr(0), o_orderkey, o_custkey, o_orderstatus)), 1, 16) AS sha256 FROM orders")
def row_fingerprints(spark, sf_dir):
    return v.read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), hs.fingerprint(F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus"), digits=16).alias("sha256"))


_parts = " || ':' || ".join(f"sum(CAST(('0x' || substr(d, {1 + 8 * i}, 8)) AS BIGINT))::VARCHAR" for i in range(8))


@query(f"SELECT count(*) AS n, sha256(count(*)::VARCHAR || ':' || {_parts}) AS sha256 FROM (SELECT sha256(concat_ws(chr(0), o_orderkey, o_custkey)) AS d FROM orders)")
def release_fingerprint(spark, sf_dir):
    return hs.table_fingerprint(v.read(spark, sf_dir, "orders"), "o_orderkey", "o_custkey")


@query("SELECT event_id AS id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_state_projection(spark, sf_dir):
    return v.read(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.from_json("props", "k bigint").k.alias("k"))


@query("SELECT user_id, event_type, event_id, round(value, 6) AS value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1")
def latest_state_upsert(spark, sf_dir):
    e = v.read(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "ts", "value")
    state, changes = e.where("event_id % 2 = 0"), e.where("event_id % 2 = 1")
    return integrity.upsert(state, changes, ["user_id", "event_type"], ["ts", "event_id"]).select("user_id", "event_type", "event_id", F.round("value", 6).alias("value"))


@query("WITH e AS (SELECT o_orderkey AS key, md5(o_orderkey || '|' || o_orderpriority) AS signature FROM orders), s AS (SELECT o_orderkey AS key, CASE WHEN o_orderkey % 4 = 0 THEN 'old' ELSE md5(o_orderkey || '|' || o_orderpriority) END AS signature, o_orderkey % 6 <> 0 AS valid FROM orders WHERE o_orderkey % 5 <> 0) SELECT key FROM e WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.valid AND s.key = e.key AND s.signature = e.signature)")
def resume_pending(spark, sf_dir):
    k = F.col("o_orderkey")
    signature = F.md5(F.concat_ws("|", k.cast("string"), "o_orderpriority"))
    o = v.read(spark, sf_dir, "orders")
    state = o.where("o_orderkey % 5 <> 0").select(k.alias("key"), F.when(k % 4 == 0, "old").otherwise(signature).alias("signature"), (k % 6 != 0).alias("valid"))
    return integrity.pending(o.select(k.alias("key"), signature.alias("signature")), state, "key").select("key")


@query("SELECT conv_id, turn, role, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS occurrence, 'turn_' || lpad(CAST(turn AS VARCHAR), 9, '0') AS name FROM conversations")
def conversation_turn_numbering(spark, sf_dir):
    from pyspark.sql import Window as W

    c = v.read(spark, sf_dir, "conversations")
    return c.select("conv_id", "turn", "role", F.row_number().over(W.partitionBy("conv_id", "role").orderBy("turn")).cast("bigint").alias("occurrence"), F.concat(F.lit("turn_"), F.lpad(F.col("turn").cast("string"), 9, "0")).alias("name"))


@query("SELECT 'job' AS kind, s_name AS name, s_nationkey AS nation, NULL::DOUBLE AS size FROM supplier UNION ALL SELECT 'source', p_name, NULL, CAST(p_size AS DOUBLE) FROM part")
def tagged_union_report(spark, sf_dir):
    jobs = v.read(spark, sf_dir, "supplier").select(F.lit("job").alias("kind"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"))
    sources = v.read(spark, sf_dir, "part").select(F.lit("source").alias("kind"), F.col("p_name").alias("name"), F.col("p_size").cast("double").alias("size"))
    return jobs.unionByName(sources, allowMissingColumns=True)


@query("SELECT p_partkey AS source, level, 'slides/' || p_partkey || '_L' || level || '_rgb.tif' AS path FROM part, (SELECT unnest([0, 1, 2]) AS level)")
def cross_join_plan(spark, sf_dir):
    p = v.read(spark, sf_dir, "part").select(F.col("p_partkey").alias("source"))
    levels = spark.createDataFrame([(0,), (1,), (2,)], T.StructType([T.StructField("level", T.IntegerType())]))
    return p.crossJoin(F.broadcast(levels)).withColumn("path", F.concat(F.lit("slides/"), F.col("source").cast("string"), F.lit("_L"), F.col("level").cast("string"), F.lit("_rgb.tif")))


# ---- matrices and rosters


@query(f"WITH {v.LONG}, f AS (SELECT sample_id, class_id, n / sum(n) OVER (PARTITION BY sample_id) + CASE WHEN class_id = 3 AND sample_id = 'sample_2' THEN 0.01 ELSE 0 END AS fraction FROM long QUALIFY NOT (class_id = 5 AND sample_id = 'sample_1')), c AS (SELECT sample_id, class_id, n / sum(n) OVER (PARTITION BY sample_id) AS share FROM long) SELECT coalesce(c.sample_id, f.sample_id) AS sample_id, coalesce(c.class_id, f.class_id) AS class_id, CASE WHEN share IS NULL THEN 'missing_count' WHEN fraction IS NULL THEN 'missing_fraction' WHEN NOT abs(fraction - share) <= 1e-8 + 1e-7 * abs(share) THEN 'fraction_differs' END AS problem FROM c FULL JOIN f ON c.sample_id = f.sample_id AND c.class_id = f.class_id WHERE problem IS NOT NULL")
def matrix_mismatches(spark, sf_dir):
    long = _long(spark, sf_dir)
    shares = cohort.fractions(long).withColumn("fraction", F.col("fraction") + F.when((F.col("class_id") == 3) & (F.col("sample_id") == "sample_2"), 0.01).otherwise(0.0))
    return matrices.mismatches(long, shares.where("not (class_id = 5 and sample_id = 'sample_1')"))


_colors = "[" + ", ".join(f"'{c}'" for c in tx.CLASS_COLORS) + "]"


@query(f"WITH {v.CELLS} SELECT class_id, class_name, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 9) AS share, ({_colors})[class_id + 1] AS color FROM cells GROUP BY 1, 2")
def detected_celltypes(spark, sf_dir):
    return matrices.detected(cohort.class_counts(v.cells(spark, sf_dir))).withColumn("share", F.round("share", 9))


@query("SELECT s_name AS name, printf('case_%05d', row_number() OVER (ORDER BY lower(s_name), s_suppkey)) AS alias FROM supplier")
def alias_numbering(spark, sf_dir):
    return matrices.numbered(v.read(spark, sf_dir, "supplier"), [F.lower("s_name"), F.col("s_suppkey")], "case_%05d").select(F.col("s_name").alias("name"), "alias")


@query("SELECT p_partkey AS id, p_name || CASE WHEN r > 1 THEN '__' || r ELSE '' END AS unique_name FROM (SELECT *, row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) AS r FROM part)")
def unique_names(spark, sf_dir):
    return matrices.occurrence_names(v.read(spark, sf_dir, "part"), "p_name", "p_partkey").select(F.col("p_partkey").alias("id"), "unique_name")


@query("SELECT p_brand AS file, p_partkey AS level, CAST(row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice * 1000 + p_partkey DESC) - 1 AS INTEGER) AS \"index\" FROM part")
def level_index(spark, sf_dir):
    p = v.read(spark, sf_dir, "part").select(F.col("p_brand").alias("file"), F.col("p_partkey").alias("level"), (F.col("p_retailprice") * 1000 + F.col("p_partkey")).alias("scale"))
    return matrices.level_index(p).select("file", "level", "index")


@query(f"WITH {v.CLINICAL}, g AS (SELECT DISTINCT source, min(outcome) OVER (PARTITION BY source) AS y FROM clinical WHERE outcome IS NOT NULL), f AS (SELECT source, CAST((row_number() OVER (PARTITION BY y ORDER BY md5(source || '|0|2'), source) - 1) % 4 AS INTEGER) AS fold FROM g) SELECT doc_id, source, fold FROM clinical JOIN f USING (source) WHERE outcome IS NOT NULL")
def grouped_folds(spark, sf_dir):
    rows = v.clinical(spark, sf_dir).where("outcome is not null").select("doc_id", "source", "outcome")
    return sampling.grouped_folds(rows, "source", "outcome", 4, 2).select("doc_id", "source", "fold")


@query(f"WITH {v.CLINICAL} SELECT source, min(outcome) AS outcome, min(outcome) <> max(outcome) AS mixed FROM clinical GROUP BY 1")
def group_outcomes(spark, sf_dir):
    return matrices.group_outcomes(v.clinical(spark, sf_dir), "source", "outcome")


_CANDIDATES = """candidates AS (SELECT 'slide_' || n_nationkey AS slide_id, x.x * 1000 AS x0, y.y * 800 AS y0 FROM nation, range(0, 12) x(x), range(0, 9) y(y))"""


@query(f"WITH {_CANDIDATES}, r AS (SELECT *, row_number() OVER (PARTITION BY slide_id ORDER BY md5(concat_ws('|', slide_id, x0, y0, 6)), x0, y0) AS patch_id FROM candidates) SELECT slide_id, x0, y0, patch_id, (patch_id - 1) // 5 AS mosaic_row, (patch_id - 1) % 5 AS mosaic_column FROM r WHERE patch_id <= 22")
def patch_selection(spark, sf_dir):
    slides = v.read(spark, sf_dir, "nation").select(F.concat(F.lit("slide_"), F.col("n_nationkey").cast("string")).alias("slide_id"), F.lit(12).alias("nx"), F.lit(9).alias("ny"))
    grid = slides.withColumn("x0", F.explode(F.expr("transform(sequence(0, nx - 1), i -> i * 1000L)"))).withColumn("y0", F.explode(F.expr("transform(sequence(0, ny - 1), i -> i * 800L)")))
    return spatial.patch_selection(grid.select("slide_id", "x0", "y0"), 20.0, 6)


@query("SELECT p_partkey AS id, CASE WHEN raw SIMILAR TO '[0-9]+_[0-9]+' THEN CAST(split_part(raw, '_', 1) AS INTEGER) END AS tile_row, CASE WHEN raw SIMILAR TO '[0-9]+_[0-9]+' THEN CAST(split_part(raw, '_', 2) AS INTEGER) END AS tile_column FROM (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_size || '_' || p_partkey WHEN 1 THEN p_size || '_' WHEN 2 THEN p_size || '_1_2' ELSE '-1_' || p_size END AS raw FROM part)")
def tile_names(spark, sf_dir):
    k, size = F.col("p_partkey"), F.col("p_size").cast("string")
    raw = F.when(k % 4 == 0, F.concat_ws("_", size, k.cast("string"))).when(k % 4 == 1, F.concat(size, F.lit("_"))).when(k % 4 == 2, F.concat(size, F.lit("_1_2"))).otherwise(F.concat(F.lit("-1_"), size))
    at = tx.tile_position(raw)
    return v.read(spark, sf_dir, "part").select(k.alias("id"), at["row"].alias("tile_row"), at["column"].alias("tile_column"))


@query("WITH l AS (SELECT unnest([10.0, 20, 25, 50, 100, 200, 250, 500, 1000, 2000, 5000]) AS p) SELECT p_partkey AS id, arg_min(p, abs(p - p_size * 40 * 0.5 * 0.2) * 1000000 + p)::DOUBLE AS bar FROM part, l GROUP BY 1")
def scale_bars(spark, sf_dir):
    return v.read(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), matrices.scale_bar(F.col("p_size") * 40, F.lit(0.5)).alias("bar"))


@query(f"WITH {v.CELLS}, s AS (SELECT 'slide_' || n_nationkey AS slide_id, CASE WHEN n_nationkey % 3 = 0 THEN 5000 END AS hw, CASE WHEN n_nationkey % 3 = 1 THEN 6000 END AS sw FROM nation), r AS (SELECT slide_id, ceil(max(x) + 1000) AS x, ceil(max(y) + 1000) AS y FROM cells GROUP BY 1) SELECT slide_id, CAST(coalesce(hw, sw, x) AS BIGINT) AS width, CAST(coalesce(hw, sw, y) AS BIGINT) AS height FROM s LEFT JOIN r USING (slide_id)")
def slide_dimensions(spark, sf_dir):
    k = F.col("n_nationkey")
    slides = v.read(spark, sf_dir, "nation").select(F.concat(F.lit("slide_"), k.cast("string")).alias("slide_id"), F.when(k % 3 == 0, 5000).alias("hw"), F.when(k % 3 == 1, 6000).alias("sw"))
    return spatial.slide_size(("hw", "hw"), ("sw", "sw"), v.cells(spark, sf_dir), slides)


@query("SELECT event_type AS cell_type, round(sum(value), 4) AS n, round(sum(value) * 100 / sum(sum(value)) OVER (), 6) AS percent FROM events WHERE value > 0 GROUP BY 1")
def inferred_counts(spark, sf_dir):
    e = v.read(spark, sf_dir, "events").select(F.concat(F.lit(" "), "event_type").alias("name"), F.col("value").cast("string").alias("count"))
    return matrices.inferred_counts(e, "name", "count").select("cell_type", F.round("n", 4).alias("n"), F.round("percent", 6).alias("percent"))


# ---- models


def _model_table(spark, sf_dir):
    return v.clinical(spark, sf_dir).where("outcome is not null").select("doc_id", F.col("outcome").alias("y"), "lang", F.col("n_chars").cast("double").alias("n_chars"))


def _cv(spark, sf_dir, name, grid=None):
    out = mlx.nested_cv(_model_table(spark, sf_dir), "doc_id", ["n_chars"], ["lang"], name, outer=3, inner=2, seed=4, grid=grid)
    return stats.roc_auc(out, by=("fold",), parts=1).select("fold", F.round("auc", 4).alias("auc"))


@query()
def elastic_net_auc(spark, sf_dir):
    return _cv(spark, sf_dir, "elastic_net")


@query()
def random_forest_auc(spark, sf_dir):
    """All eight options, but with 40 trees a forest: MLlib's time for small tables goes with the trees, not with rows or depth (see the README)."""
    return _cv(spark, sf_dir, "random_forest", [o | {"trees": 40} for o in mlx.GRIDS["random_forest"]])


@query()
def model_importances(spark, sf_dir):
    """How much AUC each feature is worth to a model of two folds on the third."""
    dealt = sampling.stratified_folds(_model_table(spark, sf_dir), "doc_id", "y", 3, 4).cache()
    found = mlx.permutation_importance(dealt.where("fold != 0"), dealt.where("fold = 0"), "doc_id", ["n_chars"], ["lang"], "elastic_net", {"c": 1.0, "l1": 0.5}, repeats=5, seed=4)
    return found.select("feature", F.round("mean", 6).alias("mean"), F.round("deviation", 6).alias("deviation"))
