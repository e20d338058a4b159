"""The driver's tables as cohort tables: projections only, each also as a SQL common table expression."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import CLASS_NAMES


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as detected cells of 24 slides."""
    t = read(spark, sf_dir, "lineitem")
    x, y, reach = F.col("l_extendedprice"), F.col("l_quantity") * 1000 + F.col("l_tax") * 10000, 2 + F.col("l_discount") * 100
    cls = (F.col("l_partkey") % 15).cast("int")
    return t.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("cell_id"),
        F.concat(F.lit("slide_"), (F.col("l_suppkey") % 24).cast("string")).alias("slide_id"), cls.alias("class_id"),
        F.array(*[F.lit(n) for n in CLASS_NAMES])[cls].alias("class_name"), x.alias("x"), y.alias("y"),
        (x - reach).alias("bbox_x0"), (y - reach).alias("bbox_y0"), (x + reach).alias("bbox_x1"), (y + reach).alias("bbox_y1"),
    )


_names = ", ".join(f"'{n}'" for n in CLASS_NAMES)
CELLS = f"""cells AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS cell_id, 'slide_' || (l_suppkey % 24) AS slide_id,
         CAST(l_partkey % 15 AS INTEGER) AS class_id, ([{_names}])[l_partkey % 15 + 1] AS class_name,
         l_extendedprice AS x, l_quantity * 1000 + l_tax * 10000 AS y,
         l_extendedprice - (2 + l_discount * 100) AS bbox_x0, l_quantity * 1000 + l_tax * 10000 - (2 + l_discount * 100) AS bbox_y0,
         l_extendedprice + (2 + l_discount * 100) AS bbox_x1, l_quantity * 1000 + l_tax * 10000 + (2 + l_discount * 100) AS bbox_y1
  FROM lineitem)"""


def sample_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """slide_id to sample_id: eight samples of the slides, from the nations' keys."""
    n = read(spark, sf_dir, "nation")
    return n.select(F.concat(F.lit("slide_"), F.col("n_nationkey").cast("string")).alias("slide_id"), F.concat(F.lit("sample_"), (F.col("n_nationkey") % 8).cast("string")).alias("sample_id"))


SAMPLE_MAP = "sample_map AS (SELECT 'slide_' || n_nationkey AS slide_id, 'sample_' || (n_nationkey % 8) AS sample_id FROM nation)"
LONG = f"""{CELLS}, {SAMPLE_MAP}, long AS (
  SELECT sample_id, class_id, class_name AS cell_type, CAST(count(*) AS BIGINT) AS n FROM cells JOIN sample_map USING (slide_id) GROUP BY ALL)"""
SAMPLES = [f"sample_{i}" for i in range(8)]


def roster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """supplier as a manifest of slides, one a supplier."""
    s = read(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    return s.select(
        F.concat(F.lit("supplier_"), k.cast("string")).alias("slide_id"), (F.col("s_acctbal") > 0).alias("completed"), (k % 7 != 0).alias("selected"),
        F.when(k % 5 != 0, F.lit(0)).when(k % 2 == 0, F.lit(1)).cast("int").alias("returncode"), (k % 11 != 0).alias("has_summary"), (k % 13 != 0).alias("in_manifest"), k.alias("suppkey"),
    )


ROSTER = """roster AS (
  SELECT 'supplier_' || s_suppkey AS slide_id, s_acctbal > 0 AS completed, s_suppkey % 7 <> 0 AS selected,
         CASE WHEN s_suppkey % 5 <> 0 THEN 0 WHEN s_suppkey % 2 = 0 THEN 1 END AS returncode,
         s_suppkey % 11 <> 0 AS has_summary, s_suppkey % 13 <> 0 AS in_manifest, s_suppkey AS suppkey
  FROM supplier)"""
AUDIT = f"""{ROSTER}, totals AS (SELECT l_suppkey, count(*) AS total FROM lineitem GROUP BY 1), audit AS (
  SELECT slide_id, included,
         CASE WHEN included THEN 'included' WHEN in_manifest AND NOT selected THEN 'excluded_unselected' ELSE 'excluded_incomplete' END AS status,
         CASE WHEN included THEN NULL WHEN in_manifest AND NOT selected THEN 'unselected' WHEN in_manifest AND NOT completed THEN 'incomplete'
              WHEN in_manifest AND NOT (returncode IS NULL OR returncode = 0) THEN 'returncode' ELSE 'missing_summary' END AS reason,
         CASE WHEN included THEN coalesce(total, 0) END AS total_cells
  FROM (SELECT *, CASE WHEN in_manifest THEN selected AND completed AND (returncode IS NULL OR returncode = 0) ELSE has_summary END AS included FROM roster)
  LEFT JOIN totals ON l_suppkey = suppkey)"""


def summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as slide summaries with their sampling."""
    k = F.col("o_orderkey")
    return read(spark, sf_dir, "orders").select(k.cast("string").alias("slide_id"), F.when(k % 3 == 0, 10.0).when(k % 3 == 1, 100.0).alias("percent_slide"), F.when(k % 4 != 0, k % 2).cast("bigint").alias("random_seed"))


SUMMARIES = """summaries AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS slide_id, CASE o_orderkey % 3 WHEN 0 THEN 10.0::DOUBLE WHEN 1 THEN 100.0::DOUBLE END AS percent_slide,
         CASE WHEN o_orderkey % 4 <> 0 THEN o_orderkey % 2 END AS random_seed FROM orders)"""


def clinical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as a clinical table: numbers and categories, and labels.quality as the outcome of some."""
    d, q = read(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars"), read(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("outcome"))
    return d.join(q, "doc_id", "left")


CLINICAL = "clinical AS (SELECT doc_id, lang, source, n_chars, quality AS outcome FROM (SELECT doc_id, lang, source, n_chars FROM documents) LEFT JOIN labels USING (doc_id))"


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents with a score of 0 to 1 from their length, with many ties."""
    return clinical(spark, sf_dir).where("outcome is not null").select("doc_id", F.col("outcome").alias("y"), (F.floor(F.col("n_chars") / 100) % 50 / F.lit(50.0)).alias("p"), (F.floor(F.col("n_chars") / 77) % 40 / F.lit(40.0)).alias("p2"))


SCORES = f"""{CLINICAL}, scores AS (
  SELECT doc_id, outcome AS y, floor(n_chars / 100) % 50 / 50.0::DOUBLE AS p, floor(n_chars / 77) % 40 / 40.0::DOUBLE AS p2 FROM clinical WHERE outcome IS NOT NULL)"""


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """embeddings, a row for each component."""
    return read(spark, sf_dir, "embeddings").select("vec_id", F.posexplode("embedding").alias("j", "v"))


FEATURES = "features AS (SELECT vec_id, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS j, unnest(embedding) AS v FROM embeddings)"


def patches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part as patches of a mosaic: a grid, 40 wide, of squares of 2600 by 1250 that overlap a little; at large scales most lie beyond the slide."""
    k = F.col("p_partkey")
    return read(spark, sf_dir, "part").select(
        k.cast("int").alias("patch_id"), (k % 40 * 2600).alias("mosaic_x0"), (F.floor(k / 40) * 1250).cast("bigint").alias("mosaic_y0"), (k * 7).alias("source_x0"), (k * 3).alias("source_y0"), F.lit(2650).alias("width"), F.lit(1300).alias("height")
    )


PATCHES = """patches AS (
  SELECT CAST(p_partkey AS INTEGER) AS patch_id, p_partkey % 40 * 2600 AS mosaic_x0, p_partkey // 40 * 1250 AS mosaic_y0, p_partkey * 7 AS source_x0,
         p_partkey * 3 AS source_y0, 2650 AS width, 1300 AS height FROM part)"""


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer as regions of the slides, some 60 a slide at the smallest scale."""
    k = F.col("c_custkey")
    t = read(spark, sf_dir, "customer")
    return t.select(
        F.concat(F.lit("slide_"), (k % 24).cast("string")).alias("slide_id"), k.alias("roi"), (k * 37 % 90000).cast("double").alias("x0"), (k * 53 % 45000).cast("double").alias("y0"),
        (k * 37 % 90000 + 3000).cast("double").alias("x1"), (k * 53 % 45000 + 2000).cast("double").alias("y1"),
    )


BOXES = """boxes AS (
  SELECT 'slide_' || (c_custkey % 24) AS slide_id, c_custkey AS roi, (c_custkey * 37 % 90000)::DOUBLE AS x0, (c_custkey * 53 % 45000)::DOUBLE AS y0,
         (c_custkey * 37 % 90000 + 3000)::DOUBLE AS x1, (c_custkey * 53 % 45000 + 2000)::DOUBLE AS y1 FROM customer)"""


def manifest(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """orders as files that are wanted, and a shifted copy of them as files that are there."""
    o = read(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    wanted = o.where("o_orderkey % 10 <> 3").select(k.alias("key"), k.alias("size"), F.md5(k.cast("string")).alias("md5"))
    there = o.where("o_orderkey % 10 <> 7").select(k.alias("key"), F.when(k % 10 == 5, k + 1).otherwise(k).alias("size"), F.when(k % 10 != 8, F.md5(k.cast("string"))).alias("md5"))
    return wanted, there


MANIFEST = """wanted AS (SELECT o_orderkey AS key, o_orderkey AS size, md5(CAST(o_orderkey AS VARCHAR)) AS md5 FROM orders WHERE o_orderkey % 10 <> 3),
there AS (SELECT o_orderkey AS key, CASE WHEN o_orderkey % 10 = 5 THEN o_orderkey + 1 ELSE o_orderkey END AS size,
                 CASE WHEN o_orderkey % 10 <> 8 THEN md5(CAST(o_orderkey AS VARCHAR)) END AS md5 FROM orders WHERE o_orderkey % 10 <> 7)"""
