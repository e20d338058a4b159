"""Queries over whole runs: cohort reports from written inputs, their tables under one pointer, listings, workbooks, digests of files and completion markers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.text import CLASS_NAMES
from ..operators import artifacts as af
from ..operators import cohort
from ..operators import features as ft
from ..sources import discovery, readers, workbooks, writers
from ..streaming import ingest
from . import pipelines
from . import views as v
from .artifact_queries import _LISTING
from .io_queries import _path
from .queries import _LINK, query

# ---- a cohort from written inputs, its tables under one pointer

#: nation as a manifest of 25 slides, of which the last has no cells, and some failed or were not selected.
_MANIFEST = "manifest AS (SELECT 'slide_' || n_nationkey AS slide_id, n_nationkey % 6 <> 5 AS completed, n_nationkey % 7 <> 6 AS selected, CASE WHEN n_nationkey % 8 = 3 THEN 1 WHEN n_nationkey % 2 = 0 THEN 0 END AS returncode FROM nation)"
_COHORT = f"""{v.CELLS}, {v.SAMPLE_MAP}, {_MANIFEST}, t AS (SELECT slide_id, count(*) AS n FROM cells GROUP BY 1), audit AS (
  SELECT slide_id, CASE WHEN NOT selected THEN 'excluded_unselected' WHEN NOT completed OR returncode <> 0 THEN 'excluded_incomplete' ELSE 'included' END AS status, coalesce(n, 0) AS n FROM manifest LEFT JOIN t USING (slide_id)),
long AS (SELECT sample_id, class_id, class_name, count(*) AS n FROM cells JOIN audit USING (slide_id) JOIN sample_map USING (slide_id) WHERE status = 'included' GROUP BY ALL)"""


def _cohort(spark, sf_dir):
    """The cohort of counts, summaries, and a manifest and a sample map that went through CSV files."""
    counts = cohort.class_counts(v.cells(spark, sf_dir), "slide_id")
    k = F.col("n_nationkey")
    n = v.read(spark, sf_dir, "nation").select(
        F.concat(F.lit(" slide_"), k.cast("string")).alias("slide_id"), F.when(k % 6 != 5, "Yes").otherwise("no").alias("completed"), F.when(k % 7 == 6, "0").alias("selected"),
        F.when(k % 8 == 3, 1).when(k % 2 == 0, 0).alias("returncode"),
    )
    writers.csv_single(n, path := _path(spark, "manifest"))
    t = readers.text_table(spark, path, ["slide_id", "completed"])
    manifest = t.select("slide_id", tx.parse_bool(F.col("completed")).alias("completed"), tx.parse_bool(F.col("selected")).alias("selected"), tx.parse_int(F.col("returncode")).cast("int").alias("returncode"))
    writers.csv_single(v.sample_map(spark, sf_dir), path := _path(spark, "samples"), sep="\t")
    sample_map = readers.text_table(spark, path, ["slide_id", "sample_id"], sep="\t")
    totals = counts.groupBy("slide_id").agg(F.sum("n").alias("n_cells"))
    summaries = manifest.select("slide_id").join(totals, "slide_id", "left").select("slide_id", F.coalesce("n_cells", F.lit(0)).alias("n_cells"), F.col("n_cells").isNull().alias("zero_detections"))
    return cohort.aggregate(counts, summaries, manifest, sample_map)


@query(f"""WITH {_COHORT} SELECT 'audit' AS name, slide_id AS key, status AS label, CASE WHEN status = 'included' THEN n END AS n FROM audit
UNION ALL SELECT 'long', sample_id || '|' || class_id, class_name, n FROM long
UNION ALL SELECT 'summary', 'all', CAST((SELECT count(*) FILTER (status = 'included') FROM audit) AS VARCHAR), (SELECT sum(n) FILTER (status = 'included') FROM audit)""")
def cohort_run_tables(spark, sf_dir):
    """A cohort's audit, long counts and summary, published as one set after an older set: readers get tables of one run."""
    c = _cohort(spark, sf_dir)
    path = _path(spark, "run")
    tables = {"audit": c.audit, "long": c.long, "summary": c.summary}
    writers.staged_set({n: t.where("false") for n, t in tables.items()}, path)
    writers.staged_set(tables, path)
    got = writers.current_set(spark, path)
    row = lambda name, key, label, n: got[name].select(F.lit(name).alias("name"), key.alias("key"), label.cast("string").alias("label"), F.col(n).cast("bigint").alias("n"))
    audit = row("audit", F.col("slide_id"), F.col("status"), "total_cells")
    long = row("long", F.concat_ws("|", "sample_id", "class_id"), F.col("cell_type"), "n")
    return audit.unionByName(long).unionByName(row("summary", F.lit("all"), F.col("n_included"), "total_cells"))


@query(f"WITH {_COHORT}, s AS (SELECT DISTINCT sample_id FROM audit JOIN sample_map USING (slide_id) WHERE status = 'included'), k AS (SELECT DISTINCT class_id, class_name FROM long), d AS (SELECT class_id, class_name, sample_id, coalesce(n, 0) AS n FROM s CROSS JOIN k LEFT JOIN long USING (sample_id, class_id, class_name)) SELECT class_id, class_name AS cell_type, sample_id, n, round(CASE WHEN sum(n) OVER (PARTITION BY sample_id) > 0 THEN n / sum(n) OVER (PARTITION BY sample_id) ELSE 0 END, 9) AS fraction FROM d")
def cohort_matrices(spark, sf_dir):
    """The matrices of that cohort, made long again: a sample whose only completed slide has no cells has a column of zeros, one without completed slides has none."""
    c = _cohort(spark, sf_dir)
    n, f = cohort.unpivoted(c.counts, ["class_id", "cell_type"]), cohort.unpivoted(c.fractions, ["class_id", "cell_type"], "fraction")
    return n.join(f, ["class_id", "cell_type", "sample_id"]).select("class_id", "cell_type", "sample_id", F.col("n").cast("bigint").alias("n"), F.round("fraction", 9).alias("fraction"))


# ---- listings

DEPTH, LINES, SHOWN = 2, 60, 7
_PLACES = """f AS (SELECT 'run_' || (o_orderkey % 6) AS root, string_split('d' || (o_custkey % 4) || CASE o_orderkey % 4 WHEN 0 THEN '/.h/f' WHEN 1 THEN '/f' WHEN 2 THEN '/e' || (o_orderkey % 7) || '/f' ELSE '/e' || (o_orderkey % 5) || '/g/h/f' END || o_orderkey, '/') AS p FROM orders)"""


@query(f"""WITH {_PLACES}, u AS (SELECT DISTINCT root, p[1:i] AS a FROM f, range(1, {DEPTH + 1}) r(i) WHERE i < len(p)),
folders AS (SELECT root, a[1:len(a) - 1] AS above, 0 AS kind, a[len(a)] AS name FROM u WHERE '/' || array_to_string(a, '/') NOT LIKE '%/.%'),
listed AS (SELECT DISTINCT root, p[1:len(p) - 1] AS above, p[len(p)] AS name FROM f WHERE len(p) <= {DEPTH + 1} AND '/' || array_to_string(p, '/') NOT LIKE '%/.%'),
entries AS (SELECT * FROM folders UNION ALL SELECT root, above, 1, name FROM listed QUALIFY row_number() OVER (PARTITION BY root, above ORDER BY name) <= {SHOWN}
  UNION ALL SELECT root, above, 2, '... ' || (count(*) - {SHOWN}) || ' more file(s)' FROM listed GROUP BY root, above HAVING count(*) > {SHOWN}),
placed AS (SELECT *, row_number() OVER (PARTITION BY root ORDER BY above, kind, name) AS place FROM entries),
cuts AS (SELECT root, min(place) AS cut FROM placed WHERE place >= {LINES} AND kind <> 2 GROUP BY 1)
SELECT root, 0 AS place, root AS line FROM f GROUP BY 1 UNION ALL
SELECT root, CAST(place AS INTEGER), CASE WHEN place = cut THEN '  ... [truncated]' ELSE repeat('  ', len(above)) || CASE kind WHEN 2 THEN '└── ' ELSE '├── ' END || name || CASE kind WHEN 0 THEN '/' ELSE '' END END FROM placed LEFT JOIN cuts USING (root) WHERE cut IS NULL OR place <= cut""")
def tree_listing(spark, sf_dir):
    """orders as files of six folders, listed as indented trees of so many lines."""
    k = F.col("o_orderkey")
    text = lambda x: x.cast("string")
    inner = F.when(k % 4 == 0, "/.h/f").when(k % 4 == 1, "/f").when(k % 4 == 2, F.concat(F.lit("/e"), text(k % 7), F.lit("/f"))).otherwise(F.concat(F.lit("/e"), text(k % 5), F.lit("/g/h/f")))
    path = F.concat(F.lit("d"), text(F.col("o_custkey") % 4), inner, text(k))
    files = v.read(spark, sf_dir, "orders").select(F.concat(F.lit("run_"), text(k % 6)).alias("root"), path.alias("relative_path"))
    return af.tree_lines(files, "root", DEPTH, LINES, SHOWN)


@query(f"WITH {_LISTING} SELECT 'case_' || a.k AS sample_id, a.relative_path, a.k AS size_bytes, replace(a.relative_path, '_L0_', '_L2_') AS l2_path, b.relative_path IS NOT NULL AS l2_exists FROM f a LEFT JOIN f b ON b.relative_path = replace(a.relative_path, '_L0_', '_L2_') WHERE a.relative_path LIKE '%_L0_%' AND a.k % 6 = 0")
def sheet_manifest(spark, sf_dir):
    """A sample sheet as a CSV file against a listing: its slides with sizes, and companions that only the listing has."""
    k = F.col("o_orderkey")
    half = F.floor(k / 2).cast("bigint")
    path = F.concat(F.lit("set "), (half % 9).cast("string"), F.lit("/S"), half.cast("string"), F.when(k % 2 == 0, "_L0_rgb.tif").otherwise("_L2_rgb.tif"))
    listing = v.read(spark, sf_dir, "orders").where("o_orderkey % 31 != 1").select(path.alias("relative_path"), k.alias("length"), F.lit("2024-01-01 00:00:00").cast("timestamp").alias("modified"))
    wanted = listing.where("length % 6 = 0").select(F.concat(F.lit("case_"), F.col("length").cast("string")).alias("sample_id"), F.concat(F.lit(" "), "relative_path").alias("slide_path"))
    wanted.write.option("header", True).csv(sheet := _path(spark, "sheet"))
    return discovery.from_sheet(spark, sheet, listing, "optional").select("sample_id", "relative_path", "size_bytes", "l2_path", "l2_exists")


@query("WITH t AS (SELECT c_custkey // 50 AS folder, string_agg(c_name, chr(10) ORDER BY c_custkey) || chr(10) AS x FROM customer GROUP BY 1) SELECT folder, CAST(strlen(x) AS BIGINT) AS size_bytes, sha256(x) AS sha256, md5(x) AS md5 FROM t WHERE folder % 4 <> 3")
def discovered_digests(spark, sf_dir):
    """Files of 50 names each, found below a root but for some folders, with sizes and digests."""
    c = v.read(spark, sf_dir, "customer").select(F.floor(F.col("c_custkey") / 50).cast("bigint").alias("folder"), "c_custkey", "c_name")
    names = F.array_sort(F.collect_list(F.struct("c_custkey", "c_name")))  # 50 at most
    texts = c.groupBy("folder").agg(F.array_join(F.transform(names, lambda r: r.c_name), "\n").alias("value"))
    texts.write.partitionBy("folder").text(root := _path(spark, "files"))
    number = lambda p: F.regexp_extract(p, r"folder=(\d+)/", 1).cast("bigint")
    found = discovery.discover(spark, root, ["*.txt"]).select(number("relative_path").alias("folder"), "size_bytes")
    sums = readers.digests(spark, root, "*.txt").select(number("path").alias("folder"), "size", "sha256", "md5")
    return found.join(sums, "folder").where("size = size_bytes and folder % 4 != 3").select("folder", "size_bytes", "sha256", "md5")


# ---- workbooks


@query("SELECT c_custkey AS k, c_name AS name, CASE WHEN c_custkey % 4 <> 0 THEN CAST(c_acctbal AS DOUBLE) END AS balance, c_custkey % 3 = 0 AS fit FROM customer")
def workbook_round_trip(spark, sf_dir):
    """Rows as workbooks of 200 rows, stored, and their sheets read back by the names of their columns."""
    k = F.col("c_custkey")
    c = v.read(spark, sf_dir, "customer").select(k.alias("Cust  key"), F.col("c_name").alias("name"), F.when(k % 4 != 0, F.col("c_acctbal").cast("double")).alias("balance"), (k % 3 == 0).alias("fit"))
    workbooks.workbooks(c, "clinical", 200).write.parquet(path := _path(spark, "workbooks"))
    t = workbooks.workbook_tables(spark.read.parquet(path), ["name", "Cust key", "fit", "balance"], "clinical")
    return t.where("problem is null").select(F.col("Cust key").cast("bigint").alias("k"), "name", F.col("balance").cast("double").alias("balance"), F.col("fit").cast("boolean").alias("fit"))


# ---- completion markers

#: A run may take so long, in milliseconds.
LIMIT = 3 * 86_400_000


@query(f"""WITH r AS (SELECT CAST(user_id AS VARCHAR) AS slide_id, epoch_us(ts) // 1000 AS ms, event_type = 'purchase' AS ends FROM events WHERE event_type IN ('view', 'signup', 'purchase') AND user_id IS NOT NULL AND ts IS NOT NULL),
s AS (SELECT slide_id, max(ms) AS since FROM r WHERE NOT ends GROUP BY 1),
e AS (SELECT s.slide_id, since, min(ms) FILTER (ms < since + {LIMIT}) AS done, bool_or(ms >= since + {LIMIT}) AS past FROM s LEFT JOIN r ON r.slide_id = s.slide_id AND ends AND ms >= since GROUP BY ALL)
SELECT slide_id, CASE WHEN done IS NOT NULL THEN 'published' WHEN past OR since + {LIMIT} <= (SELECT max(ms) - 86400000 FROM r) THEN 'expired' ELSE 'withdrawn' END AS status,
       CAST(CASE WHEN done IS NOT NULL THEN done WHEN past OR since + {LIMIT} <= (SELECT max(ms) - 86400000 FROM r) THEN since + {LIMIT} ELSE since END AS BIGINT) AS at_ms FROM e""")
def stream_run_markers(spark, sf_dir):
    """events as reports of runs: a marker is withdrawn by a start, published by the end of a run, and expires with a timer."""
    path, schema = _path(spark, "markers"), "event_id bigint, ts timestamp, user_id bigint, event_type string, value double"
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    kind = F.when(F.col("event_type").isin("view", "signup"), "started").when(F.col("event_type") == "purchase", "finished")
    changes = ingest.run_markers(stream.select(F.col("user_id").cast("string").alias("slide_id"), F.col("ts").alias("at"), kind.alias("report")), LIMIT, "1 day")
    store, value = ingest.STATE_STORE
    before = spark.conf.get(store, None)
    spark.conf.set(store, value)
    try:
        running = changes.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{path}/progress").trigger(availableNow=True).start(f"{path}/out")
        running.awaitTermination()
    finally:
        spark.conf.set(store, before) if before else spark.conf.unset(store)
    seen = spark.read.schema("slide_id string, at timestamp, status string").parquet(f"{path}/out")
    return ingest.markers(seen).select("slide_id", "status", F.unix_millis("at").alias("at_ms"))


# ---- features of cells, a whole analysis

WIDTH, HEIGHT, MPP = 100000, 60000, 0.25
_SHADE = "0.299::DOUBLE * r + 0.587::DOUBLE * g + 0.114::DOUBLE * b"
#: Each feature of a cell in SQL; every fifth cell has no polygon.
_FEATURES = {
    "x_norm": f"x::DOUBLE / {WIDTH}", "y_norm": f"y::DOUBLE / {HEIGHT}", "bbox_w_um": f"w * {MPP}", "bbox_h_um": f"h * {MPP}", "bbox_area_um2": f"w * h * {MPP * MPP}", "log_area": "ln(1 + w * h)", "aspect": "w / h",
    "he_r": "r", "he_g": "g", "he_b": "b", "he_gray": f"({_SHADE}) / 255", "he_saturation": "(greatest(r, g, b) - least(r, g, b)) / 255 / greatest(greatest(r, g, b) / 255, 1e-6::DOUBLE)",
    "he_purple": "((r + b) / 2 - g) / 255", "he_eosin": "(r - b) / 255", "he_darkness": f"1 - ({_SHADE}) / 255",
    "poly_area_um2": f"coalesce(area, median(area) OVER ()) * {MPP * MPP}", "poly_perimeter_um": f"coalesce(around, median(around) OVER ()) * {MPP}", "poly_vertices": "3.0::DOUBLE",
    "poly_compactness": "coalesce(4 * pi() * area / (around * around), median(4 * pi() * area / (around * around)) OVER ())",
}
_FEATURES |= {f"class_{n}": f"CAST(class_name = '{n}' AS DOUBLE)" for n in CLASS_NAMES}
_made = ", ".join(f'{x} AS "{n}"' for n, x in _FEATURES.items())
_scored = ", ".join(f'round(("{n}" - avg("{n}") OVER ()) / CASE WHEN stddev_pop("{n}") OVER () > 1e-8 THEN stddev_pop("{n}") OVER () ELSE 1 END, 4) + 0.0 AS "{n}"' for n in _FEATURES)


@query(f"""WITH {v.CELLS}, c AS (SELECT cell_id, class_name, x, y, (bbox_x1 - bbox_x0)::DOUBLE AS w, (bbox_y1 - bbox_y0)::DOUBLE AS h, (floor(x) % 256)::DOUBLE AS r, (floor(y) % 256)::DOUBLE AS g, (class_id * 17)::DOUBLE AS b, floor(x) % 5 <> 0 AS shaped FROM cells),
s AS (SELECT *, CASE WHEN shaped THEN w * h / 2 END AS area, CASE WHEN shaped THEN w + h + sqrt(w * w + h * h) END AS around FROM c), f AS (SELECT cell_id, {_made} FROM s) SELECT cell_id, {_scored} FROM f""")
def embedding_features(spark, sf_dir):
    """Standard scores of all features of all cells: place, box, colour, polygon (three corners of the box; the median where there is none) and class."""
    x, y = F.floor("x"), F.floor("y")
    corner = lambda a, b: F.struct(F.col(f"bbox_{a}").cast("double").alias("x"), F.col(f"bbox_{b}").cast("double").alias("y"))
    ring = F.array(corner("x0", "y0"), corner("x1", "y0"), corner("x1", "y1"))
    c = v.cells(spark, sf_dir).withColumns({"r": x % 256, "g": y % 256, "b": F.col("class_id") * 17, "rings": F.when(x % 5 != 0, F.array(ring))})
    made, names = ft.cell_features(c, WIDTH, HEIGHT, MPP, ("r", "g", "b"), "rings")
    z = ft.standardised(made, "cell_id", names)
    return z.select("cell_id", *[(F.round(F.col("vector")[i], 4) + 0.0).alias(n) for i, n in enumerate(names)])


@query(f"""WITH {_LINK}, d AS (SELECT 'DOC-' || doc_id AS key, lang, n_chars FROM documents), r AS (SELECT outcome, lang, n_chars FROM linked JOIN d USING (key) WHERE included),
u AS (SELECT outcome, n_chars, rank() OVER (ORDER BY n_chars) + (count(*) OVER (PARTITION BY n_chars) - 1) / 2.0 AS p FROM r WHERE n_chars IS NOT NULL)
SELECT 'flow' AS name, unnest(['clinical', 'completed', 'included', 'negative', 'positive']) AS key, unnest([count_if(in_clinical), count_if(completed), count_if(included), count_if(included AND outcome = 0), count_if(included AND outcome = 1)])::DOUBLE AS value FROM linked
UNION ALL SELECT 'missing', 'lang', count_if(lang IS NULL OR trim(lang) = '') FROM r UNION ALL SELECT 'missing', 'n_chars', count_if(n_chars IS NULL) FROM r
UNION ALL SELECT 'levels', 'CLIN__LANG', count(DISTINCT lower(lang)) FROM r UNION ALL SELECT 'levels', 'CLIN__N_CHARS', NULL
UNION ALL SELECT 'statistic', 'n_chars', round(sum(p) FILTER (outcome = 1) - count_if(outcome = 1) * (count_if(outcome = 1) + 1) / 2.0, 4) FROM u""")
def analysis_report(spark, sf_dir):
    """A whole analysis without a model: linkage of clinical ids, samples and audit, its flow, missing values, levels and the test of a number."""
    d = v.read(spark, sf_dir, "documents")
    c = v.clinical(spark, sf_dir).where("doc_id % 10 <> 1").withColumn("outcome", F.when(F.col("outcome") == 1, " Good").when(F.col("outcome") == 0, "bad"))
    c = c.withColumn("id", F.concat(F.lit("doc_"), "doc_id", F.lit(".svs"))).withColumnRenamed("outcome", "status").select("id", "status", "lang", "n_chars")
    samples = d.where("doc_id % 10 <> 2").select(F.concat(F.lit(" Doc "), "doc_id", F.lit(" L0 RGB HE 1")).alias("sample_id"))
    audit = d.where("doc_id % 10 <> 3").select(F.concat(F.lit("DOC-"), "doc_id", F.lit("_HE_1")).alias("sample_id"), (F.col("doc_id") % 10 != 4).alias("included"))
    a = pipelines.analyse(c, "id", "status", "good", "bad", samples, audit, ["n_chars"], ["lang"])
    row = lambda df, name, key, value: df.select(F.lit(name).alias("name"), key.alias("key"), F.col(value).cast("double").alias("value"))
    flow = a.flow.unpivot([], a.flow.columns, "key", "value")
    tests = a.univariate.where("feature = 'n_chars'").withColumn("statistic", F.round("statistic", 4))
    out = row(flow, "flow", F.col("key"), "value").unionByName(row(a.missing, "missing", F.col("feature"), "n_missing"))
    return out.unionByName(row(a.manifest, "levels", F.col("feature_name"), "n_levels")).unionByName(row(tests, "statistic", F.col("feature"), "statistic"))
