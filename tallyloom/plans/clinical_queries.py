"""Queries over clinical predictors, predictions by patient group, and summaries of features and embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import clinical as cl
from ..operators import cohort, matrices, sampling, spatial, stats, validate
from ..operators import features as ft
from ..operators import linkage
from . import views as v
from .queries import _LINK, _linked, _long, _predictions, query

# ---- predictors

_TABLE = "c AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 90 = 1 THEN 'n/a' WHEN c_custkey % 9 = 2 THEN ' ' ELSE CAST(c_acctbal AS VARCHAR) END AS \"Serum level\", CASE c_custkey % 6 WHEN 0 THEN ' F ' WHEN 1 THEN 'Mujer' WHEN 2 THEN 'MALE' WHEN 3 THEN 'None' WHEN 4 THEN '' ELSE 'other' END AS \"Sexo\", 'Stage  ' || (c_custkey % 40) AS \"stage\" FROM customer)"
TYPES = {"Serum level": "numeric", "Sexo": "categorical", "stage": "categorical"}


def _table(spark, sf_dir):
    k = F.col("c_custkey")
    level = F.when(k % 90 == 1, "n/a").when(k % 9 == 2, " ").otherwise(F.col("c_acctbal").cast("string"))
    sex = F.when(k % 6 == 0, " F ").when(k % 6 == 1, "Mujer").when(k % 6 == 2, "MALE").when(k % 6 == 3, "None").when(k % 6 == 4, "").otherwise("other")
    return v.read(spark, sf_dir, "customer").select(k.alias("k"), level.alias("Serum level"), sex.alias("Sexo"), F.concat(F.lit("Stage  "), (k % 40).cast("string")).alias("stage"))


@query(f"WITH {_TABLE} SELECT k, round(TRY_CAST(trim(\"Serum level\") AS DOUBLE), 6) AS CLIN__SERUM_LEVEL, CASE lower(trim(\"Sexo\")) WHEN 'f' THEN 'female' WHEN 'mujer' THEN 'female' WHEN 'male' THEN 'male' WHEN 'other' THEN 'other' END AS CLIN__SEXO, replace(lower(\"stage\"), '  ', ' ') AS CLIN__STAGE FROM c")
def prepared_predictors(spark, sf_dir):
    """Predictors by their declared types: numbers, and categories cleaned with sex labels mapped."""
    p = cl.prepared(_table(spark, sf_dir), TYPES, "k")
    return p.withColumn("CLIN__SERUM_LEVEL", F.round("CLIN__SERUM_LEVEL", 6))


@query(f"WITH {_TABLE} SELECT 'Serum level' AS feature, 'not_numeric' AS code, count(*) AS n FROM c WHERE \"Serum level\" = 'n/a' HAVING n > 0 UNION ALL SELECT 'stage', 'too_many_levels', count(DISTINCT \"stage\") AS n FROM c HAVING n > 20")
def predictor_problems(spark, sf_dir):
    types = cl.feature_types(list(TYPES), ["Serum level"], ["Sexo", "stage"])
    return cl.feature_problems(_table(spark, sf_dir), types, 20)


@query(f"WITH {_TABLE} SELECT unnest(['CLIN__SERUM_LEVEL', 'CLIN__SEXO', 'CLIN__STAGE']) AS feature_name, 'clinical' AS source, unnest(['Serum level', 'Sexo', 'stage']) AS source_column, unnest(['numeric', 'categorical', 'categorical']) AS transformation, unnest([NULL, 3, (SELECT count(DISTINCT \"stage\") FROM c)])::BIGINT AS n_levels")
def predictor_manifest(spark, sf_dir):
    return cl.feature_manifest(_table(spark, sf_dir), TYPES)


@query("WITH g AS (SELECT CASE WHEN o_orderkey % 50 <> 3 THEN 'patient ' || (o_orderkey - o_orderkey % 3) END AS key FROM orders WHERE o_orderkey % 3 = 0 OR o_orderkey % 21 = 1) SELECT CASE WHEN key IS NULL THEN 'missing' ELSE 'repeated' END AS code, key, count(*) AS n FROM g GROUP BY 2 HAVING key IS NULL OR n > 1")
def patient_group_problems(spark, sf_dir):
    """Rows without a patient, and patients with several rows; ids in full-width digits and with odd spaces are the same patient."""
    k = F.col("o_orderkey")
    base = (k - k % 3).cast("string")
    wide = F.translate(base, "0123456789", "０１２３４５６７８９")
    patient = F.when(k % 50 != 3, F.concat(F.lit(" patient  "), F.when(k % 2 == 0, base).otherwise(wide)))
    return cl.group_problems(v.read(spark, sf_dir, "orders").where("o_orderkey % 3 = 0 or o_orderkey % 21 = 1").select(patient.alias("patient")), "patient")


@query("SELECT CASE WHEN doc_id % 7 = 3 THEN 'uncovered' ELSE 'duplicate' END AS code, CAST(doc_id AS VARCHAR) AS key FROM documents WHERE doc_id % 7 = 3 OR doc_id % 11 = 4")
def group_lookup_problems(spark, sf_dir):
    """Ids without a group, or with two rows in the table of groups."""
    d = v.read(spark, sf_dir, "documents").select(F.col("doc_id").alias("analysis_id"))
    groups = d.where("analysis_id % 7 != 3").withColumn("group", F.lit("g"))
    return cl.lookup_problems(d, groups.unionAll(groups.where("analysis_id % 11 = 4")))


@query(f"WITH {_LINK} SELECT count_if(in_clinical) AS clinical, count_if(completed) AS completed, count_if(included) AS included, count_if(included AND outcome = 0) AS negative, count_if(included AND outcome = 1) AS positive FROM linked")
def cohort_flow(spark, sf_dir):
    return cl.flow(_linked(spark, sf_dir))


@query(f"WITH {v.CLINICAL}, n AS (SELECT outcome, lang, count(*) AS n FROM clinical WHERE outcome IS NOT NULL AND lang IS NOT NULL GROUP BY 1, 2) SELECT outcome, '{{' || string_agg('\"' || lang || '\":' || n, ',' ORDER BY lang) || '}}' AS counts FROM n GROUP BY 1")
def level_counts(spark, sf_dir):
    """Counts by level as JSON with sorted keys."""
    return cl.level_counts(v.clinical(spark, sf_dir).where("outcome is not null"), "lang", "outcome")


@query(f"WITH {_LINK}, x AS (SELECT key, reason FROM linked WHERE in_matrix AND NOT included) SELECT unnest(string_split(reason, ';')) AS reason, count(*) AS n FROM x GROUP BY 1")
def matrix_exclusions(spark, sf_dir):
    """Matrix samples that are not eligible, by reason."""
    return linkage.reason_histogram(_linked(spark, sf_dir).where("in_matrix and not included"))


# ---- metrics by group

_UNITS = f"{v.SCORES}, g AS (SELECT y || '-' || (doc_id // 4) AS eid, y, round(avg((p + p2) / 2), 9) AS base, round(avg(p2), 9) AS more FROM scores GROUP BY 1, 2)"
_DRAWN = f"""{_UNITS}, n AS (SELECT *, row_number() OVER (PARTITION BY y ORDER BY md5(eid || '|5'), eid) AS i, count(*) OVER (PARTITION BY y) AS size FROM g),
d AS (SELECT b.b, n.y, CAST(('0x' || substr(md5(concat_ws('|', b.b, n.y, n.i, 5)), 1, 8)) AS BIGINT) % n.size + 1 AS i FROM n, range(1, 1001) b(b)),
s AS (SELECT d.b, n.y, n.base, n.more FROM d JOIN n ON n.y = d.y AND n.i = d.i UNION ALL SELECT 0, y, base, more FROM g)"""
_auc = lambda r: f"(sum(CASE WHEN y = 1 THEN {r} END) - sum(y) * (sum(y) + 1) / 2.0) / (sum(y) * (count(*) - sum(y)))"
_rank = lambda p: f"rank() OVER (PARTITION BY b ORDER BY {p}) + (count(*) OVER (PARTITION BY b, {p}) - 1) / 2.0"
_balanced = lambda p: f"(count(*) FILTER (y = 1 AND {p} >= 0.5) / sum(y) + count(*) FILTER (y = 0 AND {p} < 0.5) / (count(*) - sum(y))) / 2"
_MEASURED = f"""{_DRAWN}, r AS (SELECT *, {_rank('base')} AS rb, {_rank('more')} AS rm FROM s),
m AS (SELECT b, {_auc('rb')} AS auc_base, {_auc('rm')} AS auc_more, {_balanced('base')} AS ba_base, {_balanced('more')} AS ba_more, avg((base - y) * (base - y)) AS br_base, avg((more - y) * (more - y)) AS br_more FROM r GROUP BY 1)"""


def _units(spark, sf_dir):
    s = v.scores(spark, sf_dir)
    averaged = stats.averaged(_predictions(spark, sf_dir))
    groups = s.select(F.col("doc_id").alias("analysis_id"), F.concat_ws("-", F.col("y").cast("string"), F.floor(F.col("doc_id") / 4).cast("string")).alias("group"))
    return cl.evaluation_units(averaged, groups).withColumn("p", F.round("p", 9))


@query(f"WITH {_UNITS} SELECT eid AS evaluation_id, 'base' AS feature_set, 'm' AS model, y, round(base, 8) AS p FROM g UNION ALL SELECT eid, 'more', 'm', y, round(more, 8) FROM g")
def evaluation_units(spark, sf_dir):
    """One probability for each patient group, feature set and model."""
    return _units(spark, sf_dir).withColumn("p", F.round("p", 8))


@query(f"""WITH {_MEASURED}, l AS (SELECT 'base' AS feature_set, 'roc_auc' AS metric, b, auc_base AS v FROM m UNION ALL SELECT 'base', 'balanced_accuracy', b, ba_base FROM m UNION ALL SELECT 'base', 'brier', b, br_base FROM m UNION ALL SELECT 'more', 'roc_auc', b, auc_more FROM m UNION ALL SELECT 'more', 'balanced_accuracy', b, ba_more FROM m UNION ALL SELECT 'more', 'brier', b, br_more FROM m)
SELECT feature_set, metric, round(max(v) FILTER (b = 0), 7) AS point, round(quantile_cont(v, 0.025) FILTER (b > 0), 7) AS low, round(quantile_cont(v, 0.975) FILTER (b > 0), 7) AS high, (SELECT count(*) FROM g) AS n_units FROM l GROUP BY 1, 2""")
def group_metric_intervals(spark, sf_dir):
    """Metrics of each feature set with intervals from 1000 draws of whole patient groups."""
    m = cl.metric_intervals(_units(spark, sf_dir), 1000, 5).where(F.col("metric").isin(list(cl.COMPARED)))
    return m.select("feature_set", "metric", *[F.round(c, 7).alias(c) for c in ("point", "low", "high")], "n_units")


@query(f"""WITH {_MEASURED}, l AS (SELECT 'roc_auc' AS metric, b, auc_more - auc_base AS v FROM m UNION ALL SELECT 'balanced_accuracy', b, ba_more - ba_base FROM m UNION ALL SELECT 'brier', b, br_base - br_more FROM m)
SELECT metric, round(max(v) FILTER (b = 0), 7) AS point, round(quantile_cont(v, 0.025) FILTER (b > 0), 7) AS low, round(quantile_cont(v, 0.975) FILTER (b > 0), 7) AS high FROM l GROUP BY 1""")
def paired_group_intervals(spark, sf_dir):
    """How much better one feature set is than another, over the same draws of patient groups."""
    p = cl.paired_intervals(_units(spark, sf_dir), [("more", "base"), ("absent", "base")], 1000, 5)
    return p.select("metric", *[F.round(c, 7).alias(c) for c in ("point", "low", "high")])


@query(f"""WITH {v.SCORES}, k AS (SELECT doc_id % 3 AS fold, y, p, rank() OVER (PARTITION BY doc_id % 3 ORDER BY p) + (count(*) OVER (PARTITION BY doc_id % 3, p) - 1) / 2.0 AS r FROM scores),
m AS (SELECT fold, {_auc('r')} AS roc_auc, avg((p - y) * (p - y)) AS brier FROM k GROUP BY 1) SELECT metric, round(avg(v), 8) AS mean, round(stddev_samp(v), 8) AS std FROM (SELECT 'roc_auc' AS metric, roc_auc AS v FROM m UNION ALL SELECT 'brier', brier FROM m) GROUP BY 1""")
def fold_metric_summary(spark, sf_dir):
    """Mean and deviation of metrics over folds."""
    m = stats.metrics(v.scores(spark, sf_dir).withColumn("fold", F.col("doc_id") % 3), by=("fold",))
    s = matrices.fold_summary(m.withColumn("feature_set", F.lit("f")).withColumn("model", F.lit("m")), ["roc_auc", "brier"])
    return s.select("metric", F.round("mean", 8).alias("mean"), F.round("std", 8).alias("std"))


@query(f"WITH {v.SCORES}, m AS (SELECT doc_id % 2 AS s, doc_id % 3 AS f, avg((p - y) * (p - y)) AS brier FROM scores GROUP BY 1, 2) SELECT 'set_' || s AS feature_set, round(avg(brier) FILTER (f = 0), 8) AS model_0, round(avg(brier) FILTER (f = 1), 8) AS model_1, round(avg(brier) FILTER (f = 2), 8) AS model_2 FROM m GROUP BY 1")
def metric_heat_table(spark, sf_dir):
    """A metric with feature sets as rows and models as columns."""
    rows = v.scores(spark, sf_dir).select(F.concat(F.lit("set_"), (F.col("doc_id") % 2).cast("string")).alias("feature_set"), F.concat(F.lit("model_"), (F.col("doc_id") % 3).cast("string")).alias("model"), "y", "p")
    m = stats.metrics(rows, by=("feature_set", "model"))
    wide = m.groupBy("feature_set").pivot("model", ["model_0", "model_1", "model_2"]).agg(F.avg("brier"))
    return wide.select("feature_set", *[F.round(f"model_{i}", 8).alias(f"model_{i}") for i in range(3)])


@query("SELECT p_brand AS feature, round(avg(p_retailprice), 8) AS mean, round(coalesce(stddev_samp(p_retailprice), 0), 6) AS std FROM part GROUP BY 1 ORDER BY avg(p_retailprice) DESC, 1 LIMIT 20")
def top_importances(spark, sf_dir):
    """The most important features over draws."""
    i = cl.importances(v.read(spark, sf_dir, "part").select(F.col("p_brand").alias("feature"), F.col("p_retailprice").alias("importance")))
    return i.select("feature", F.round("mean", 8).alias("mean"), F.round("std", 6).alias("std"))


# ---- features


@query("WITH e AS (SELECT label, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL) SELECT CAST(label AS BIGINT) AS label, count(*) AS n, round(median(x), 7) AS x, round(median(y), 7) AS y, round(quantile_cont(x, 0.1), 7) AS x10, round(quantile_cont(x, 0.9), 7) AS x90, round(quantile_cont(y, 0.1), 7) AS y10, round(quantile_cont(y, 0.9), 7) AS y90 FROM e GROUP BY 1")
def embedding_centres(spark, sf_dir):
    """Median and spread of each class in two dimensions of an embedding."""
    e = v.read(spark, sf_dir, "embeddings").where("label is not null and embedding is not null").select(F.col("label").cast("bigint").alias("label"), F.col("embedding")[0].cast("double").alias("x"), F.col("embedding")[1].cast("double").alias("y"))
    c = ft.centres(e, "label", ["x", "y"])
    return c.select("label", "n", *[F.round(n, 7).alias(n) for n in ("x", "y", "x10", "x90", "y10", "y90")])


@query(f"WITH {v.CELLS} SELECT round(quantile_cont(x, 0.02), 6) AS low, round(quantile_cont(x, 0.98), 6) AS high FROM cells")
def clip_range(spark, sf_dir):
    """The 2nd and 98th percentiles of a feature over all cells."""
    return ft.clip_range(v.cells(spark, sf_dir), "x").select(F.round("low", 6).alias("low"), F.round("high", 6).alias("high"))


@query("SELECT c_custkey AS id, round(coalesce(CASE WHEN c_custkey % 5 <> 0 THEN c_acctbal END, (SELECT median(c_acctbal) FROM customer WHERE c_custkey % 5 <> 0)), 6) AS balance, round(coalesce(CASE WHEN c_custkey % 3 = 0 THEN c_nationkey END, (SELECT median(c_nationkey) FROM customer WHERE c_custkey % 3 = 0)), 6) AS nation FROM customer")
def median_imputation(spark, sf_dir):
    k = F.col("c_custkey")
    c = v.read(spark, sf_dir, "customer").select(k.alias("id"), F.when(k % 5 != 0, F.col("c_acctbal")).alias("balance"), F.when(k % 3 == 0, F.col("c_nationkey")).cast("double").alias("nation"))
    return ft.median_filled(c, ["balance", "nation"]).select("id", F.round("balance", 6).alias("balance"), F.round("nation", 6).alias("nation"))


@query(f"WITH {v.CELLS}, a AS (SELECT cell_id, sqrt((bbox_x1 - bbox_x0) * (bbox_y1 - bbox_y0)) AS r FROM cells) SELECT cell_id, round(greatest(0.35 * 4, least(3.2 * 4, 4 * r / (SELECT median(r) FROM a))), 6) AS size FROM a")
def marker_sizes(spark, sf_dir):
    """Marker sizes by the root of area over its median."""
    c = v.cells(spark, sf_dir).select("cell_id", ((F.col("bbox_x1") - F.col("bbox_x0")) * (F.col("bbox_y1") - F.col("bbox_y0"))).alias("area"))
    return ft.marker_sizes(c, 4.0).select("cell_id", F.round("size", 6).alias("size"))


@query(f"WITH {v.LONG}, f AS (SELECT sample_id, class_id, n / sum(n) OVER (PARTITION BY sample_id) AS f FROM long), c AS (SELECT sample_id, class_id, ln(f + 1e-6) - avg(ln(f + 1e-6)) OVER (PARTITION BY sample_id) AS clr FROM f) SELECT sample_id, class_id, round((clr - avg(clr) OVER w) / CASE WHEN stddev_pop(clr) OVER w <= 1e-8 THEN 1 ELSE stddev_pop(clr) OVER w END, 5) AS z FROM c WINDOW w AS (PARTITION BY class_id)")
def standardised_clr(spark, sf_dir):
    """Compositions, standardised by class: what components are taken of."""
    c = ft.clr(cohort.fractions(_long(spark, sf_dir)))
    return ft.zscores(c, "class_id", "clr").select("sample_id", "class_id", F.round("z", 5).alias("z"))


@query(f"WITH {v.LONG}, f AS (SELECT sample_id, class_id, n, n / sum(n) OVER (PARTITION BY sample_id) AS f FROM long) SELECT sample_id, " + ", ".join(f"CAST(coalesce(sum(n) FILTER (class_id = {i}), 0) AS BIGINT) AS count_{i}, round(coalesce(sum(f) FILTER (class_id = {i}), 0), 9) AS fraction_{i}" for i in range(15)) + " FROM f GROUP BY 1")
def wide_features(spark, sf_dir):
    """Counts and fractions of all classes side by side, a row a sample."""
    f = cohort.fractions(_long(spark, sf_dir))
    sides = [f.groupBy("sample_id").pivot("class_id", list(range(15))).agg(F.sum(c)).select("sample_id", *[F.coalesce(F.col(f"`{i}`"), F.lit(0)).alias(f"{name}_{i}") for i in range(15)]) for c, name in (("n", "count"), ("fraction", "fraction"))]
    wide = linkage.roster_with(sides[0], sides[1], key="sample_id")
    return wide.select("sample_id", *[x for i in range(15) for x in (F.col(f"count_{i}"), F.round(f"fraction_{i}", 9).alias(f"fraction_{i}"))])


@query(f"WITH {v.LONG} SELECT class_id, cell_type, sample_id, n, CAST(row_number() OVER (ORDER BY class_id < 0, class_id, lower(cell_type), sample_id) AS BIGINT) AS place FROM long")
def matrix_row_order(spark, sf_dir):
    """A matrix's rows in order: known classes by id, unmapped ones by name."""
    from ..operators.ranking import ordered

    return ordered(_long(spark, sf_dir), [*cohort.matrix_order(), F.col("sample_id")], "place").select("class_id", "cell_type", "sample_id", "n", "place")


# ---- rules


@query("SELECT code, key FROM (SELECT 'blank_class_name' AS code, CAST(p_partkey AS VARCHAR) AS key FROM part WHERE p_partkey % 7 = 0 UNION ALL SELECT 'class_id_not_integral', CAST(p_partkey AS VARCHAR) FROM part WHERE p_partkey % 11 = 1 UNION ALL SELECT 'count_not_integral', CAST(p_partkey AS VARCHAR) FROM part WHERE p_partkey % 13 = 2 UNION ALL SELECT 'count_negative', CAST(p_partkey AS VARCHAR) FROM part WHERE p_partkey % 13 <> 2 AND p_partkey % 17 = 3 UNION ALL SELECT 'count_zero', CAST(p_partkey AS VARCHAR) FROM part WHERE p_partkey % 13 <> 2 AND p_partkey % 17 <> 3 AND p_partkey % 19 = 4)")
def count_table_problems(spark, sf_dir):
    """Rules of a table of counts read as text."""
    k = F.col("p_partkey")
    t = v.read(spark, sf_dir, "part").select(k.alias("k"), F.when(k % 7 == 0, " ").otherwise(F.col("p_name")).alias("class_name"), F.when(k % 11 == 1, "x").otherwise(F.col("p_size").cast("string")).alias("class_id"), F.when(k % 13 == 2, "1.5").when(k % 17 == 3, "-2").when(k % 19 == 4, "0").otherwise("3").alias("count"))
    return validate.violations(t, "k", validate.count_rules()).select("code", "key")


@query("SELECT code, key FROM (SELECT 'blank_id' AS code, CAST(s_suppkey AS VARCHAR) AS key FROM supplier WHERE s_suppkey % 9 = 0 UNION ALL SELECT 'reserved_id', CAST(s_suppkey AS VARCHAR) FROM supplier WHERE s_suppkey % 9 = 1)")
def reserved_id_problems(spark, sf_dir):
    k = F.col("s_suppkey")
    t = v.read(spark, sf_dir, "supplier").select(k.alias("k"), F.when(k % 9 == 0, " ").when(k % 9 == 1, " Slides.TSV").otherwise(F.col("s_name")).alias("sample_id"))
    return validate.violations(t, "k", validate.id_rules("sample_id")).select("code", "key")


@query("SELECT o_orderkey AS folder, 'slide_' || (o_orderkey + 1) AS slide_id FROM orders WHERE o_orderkey % 20 = 3")
def summary_folder_mismatches(spark, sf_dir):
    """Summaries whose slide id is not their folder's name."""
    k = F.col("o_orderkey")
    s = v.read(spark, sf_dir, "orders").select(k.alias("folder"), F.concat(F.lit("slide_"), F.when(k % 20 == 3, k + 1).otherwise(k).cast("string")).alias("slide_id"))
    return s.where(F.col("slide_id") != F.concat(F.lit("slide_"), F.col("folder").cast("string")))


@query("WITH a AS (SELECT c_nationkey AS key, c_custkey % 9 <> 0 AS included FROM customer WHERE c_nationkey % 2 = 0 OR c_custkey % 9 <> 0) SELECT key, bool_and(included) AS completed, count(*) AS n_slides, bool_and(included) <> bool_or(included) AS mixed FROM a GROUP BY 1")
def pooled_audit(spark, sf_dir):
    """An audit by sample; mixed where some slides are included and others are not."""
    a = v.read(spark, sf_dir, "customer").where("c_nationkey % 2 = 0 or c_custkey % 9 != 0").select(F.col("c_nationkey").alias("key"), (F.col("c_custkey") % 9 != 0).alias("included"))
    return linkage.pooled_audit(a, "key")


@query("SELECT c_custkey AS id, c_custkey % 4 <> 1 AND (c_custkey % 3 <> 0 OR c_custkey % 5 = 0) AS same FROM customer")
def sampling_match(spark, sf_dir):
    """Whether a summary's sampling is the one asked for."""
    from ..operators.integrity import sampling_matches

    k = F.col("c_custkey")
    percent = F.when(k % 4 == 1, 20.0).otherwise(10.0)
    same = sampling_matches(percent, 10.0, F.when((k % 3 != 0) | (k % 5 == 0), F.lit(7)).otherwise(F.lit(8)).cast("bigint"), 7)
    return v.read(spark, sf_dir, "customer").select(k.alias("id"), same.alias("same"))


@query("SELECT o_orderkey AS key, CASE WHEN o_orderkey % 6 = 0 THEN 'missing' WHEN o_orderkey % 10 = 1 THEN 'status' WHEN o_orderkey % 15 = 2 THEN 'price' END AS problem FROM orders WHERE o_orderkey % 6 = 0 OR o_orderkey % 10 = 1 OR o_orderkey % 15 = 2")
def state_entry_problems(spark, sf_dir):
    """State entries against the expected ones: exact fields, and numbers within 1e-9."""
    k = F.col("o_orderkey")
    o = v.read(spark, sf_dir, "orders").select(k.alias("key"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"))
    key = F.col("key")
    state = o.where("key % 6 != 0").withColumn("status", F.when(key % 10 == 1, "?").otherwise(F.col("status"))).withColumn("price", F.when(key % 15 == 2, F.col("price") * 1.001).otherwise(F.col("price") * (1 + 1e-12)))
    return matrices.entry_problems(state, o, ["key"], ["status"], ["price"])


@query("SELECT o_custkey AS \"group\" FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderkey % 5) > 1")
def leaked_groups(spark, sf_dir):
    """Groups that lie in more than one fold."""
    o = v.read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("group"), (F.col("o_orderkey") % 5).alias("fold"))
    return matrices.leaked(o, "group")


@query("SELECT s_suppkey AS id, CASE WHEN s_suppkey % 3 = 0 THEN 'a/b_' || s_suppkey ELSE '/other/' || s_suppkey END AS path, s_suppkey % 3 = 0 AS inside FROM supplier")
def relative_paths(spark, sf_dir):
    """Paths below a root, without it; others as they are."""
    k = F.col("s_suppkey")
    path = F.when(k % 3 == 0, F.concat(F.lit("/data/root/a/b_"), k.cast("string"))).otherwise(F.concat(F.lit("/other/"), k.cast("string")))
    return v.read(spark, sf_dir, "supplier").select(k.alias("id"), tx.relative(path, "/data/root").alias("path"), tx.within(path, "/data/root/").alias("inside"))


@query("SELECT p_partkey AS id, CASE p_partkey % 4 WHEN 0 THEN p_size WHEN 1 THEN -3 END AS whole, CASE p_partkey % 3 WHEN 0 THEN md5(p_name) WHEN 1 THEN md5(p_brand) END AS digest, trim(regexp_replace(lower(p_name), '\\s+', ' ', 'g')) AS label FROM part")
def optional_values(spark, sf_dir):
    """Optional integers, digests with or without a prefix, and labels."""
    k = F.col("p_partkey")
    whole = F.when(k % 4 == 0, F.col("p_size").cast("string")).when(k % 4 == 1, " -3.0 ").when(k % 4 == 2, "").otherwise("1.5")
    digest = F.when(k % 3 == 0, F.concat(F.lit("MD5:"), F.md5("p_name"))).when(k % 3 == 1, F.upper(F.md5("p_brand"))).otherwise("sha1:0")
    return v.read(spark, sf_dir, "part").select(k.alias("id"), tx.parse_int(whole).alias("whole"), tx.md5_of(digest).alias("digest"), tx.label(F.concat(F.lit(" "), F.replace("p_name", F.lit(" "), F.lit("\t ")))).alias("label"))


@query("SELECT s_name AS slide_id, x0, y0 FROM (SELECT s_name, unnest(list_distinct([0, 1000, 2000, s_suppkey % 900 + 2000])) AS x0 FROM supplier), (SELECT unnest([0, 500]) AS y0)")
def candidate_grid(spark, sf_dir):
    """Every place of a patch on each slide; the last column and row are moved inside."""
    slides = v.read(spark, sf_dir, "supplier").select(F.col("s_name").alias("slide_id"), (F.col("s_suppkey") % 900 + 3000).cast("int").alias("width"), F.lit(1500).alias("height"))
    return sampling.candidate_grid(slides, 1000).select("slide_id", F.col("x0").cast("bigint").alias("x0"), F.col("y0").cast("bigint").alias("y0"))


@query()
def thinned_region(spark, sf_dir):
    """A region's cells thinned to about 800 by classes and distance."""
    return spatial.thinned(v.cells(spark, sf_dir).select("cell_id", "slide_id", "class_id", "x", "y"), 800, 500, 0.0, 0.0, 3).select("cell_id", "slide_id", "class_id")
