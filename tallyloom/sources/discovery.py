"""Slide files to a validated manifest: scan, ids, companions, fingerprints, natural order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import hashing as hs
from ..functions import text as tx
from ..operators import validate as v
from .readers import files, text_table

POLICIES = ("ignore", "optional", "required")


def companions(found: DataFrame, policy: str = "ignore", suffix: tuple[str, str] = ("_L0_", "_L2_"), listing: DataFrame | None = None) -> DataFrame:
    """found (relative_path, length) with l2_path, l2_exists and l2_state: not_used, present or missing, looked up in listing or else in found. Nothing is looked up under the policy ignore."""
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {', '.join(POLICIES)}")
    if policy == "ignore":
        return found.withColumn("l2_path", F.lit(None).cast("string")).withColumn("l2_exists", F.lit(False)).withColumn("l2_state", F.lit("not_used"))
    other = (listing or found).select(F.col("relative_path").alias("l2_path"), F.lit(True).alias("_there"))
    out = found.where(F.col("relative_path").contains(suffix[0])).withColumn("_l2", F.replace("relative_path", F.lit(suffix[0]), F.lit(suffix[1])))
    out = out.join(other, F.col("_l2") == F.col("l2_path"), "left").withColumn("l2_exists", F.coalesce("_there", F.lit(False)))
    return out.withColumn("l2_path", F.col("_l2")).withColumn("l2_state", F.when(F.col("l2_exists"), "present").otherwise("missing")).drop("_l2", "_there")


def manifest(found: DataFrame, policy: str = "ignore", include: list[str] = (), exclude: list[str] = (), listing: DataFrame | None = None) -> DataFrame:
    """(sample_id, relative_path, size_bytes, modified, fingerprint, l2_*) of found files (relative_path, length, modified[, sample_id]) in natural order of their ids.

    Raises ConstraintError for blank, reserved or repeated ids, repeated paths, an empty table, and companions that the policy requires and that are missing.
    """
    rows = companions(found, policy, listing=listing)
    if "sample_id" not in rows.columns:
        rows = rows.withColumn("sample_id", tx.sample_id(F.col("relative_path")))
    rows = rows.where(tx.matches(F.col("sample_id"), list(include), list(exclude)))
    broken = v.violations(rows, "relative_path", v.id_rules("sample_id") + [v.Rule("companion_missing", F.lit(policy == "required") & ~F.col("l2_exists"))])
    none = rows.limit(1).agg(F.count(F.lit(1)).alias("n")).where("n = 0").select(F.lit("no slide was found").alias("problem"))
    v.enforce(broken, v.duplicates(rows, "sample_id"), v.duplicates(rows, "relative_path"), none)
    mark = hs.fingerprint(F.col("relative_path"), F.col("length"), F.unix_micros("modified"), digits=16)
    out = rows.select("sample_id", "relative_path", F.col("length").alias("size_bytes"), "modified", mark.alias("fingerprint"), "l2_path", "l2_exists", "l2_state")
    return tx.in_natural_order(out, "sample_id")


def discover(spark: SparkSession, root: str, patterns: list[str], excluded: list[str] = (), policy: str = "ignore", include: list[str] = (), exclude: list[str] = ()) -> DataFrame:
    """manifest() of the files below root that match a pattern."""
    return manifest(files(spark, root, patterns, excluded), policy, include, exclude)


def from_sheet(spark: SparkSession, sheet: str, listing: DataFrame, policy: str = "ignore") -> DataFrame:
    """manifest() of a sample sheet (sample_id, slide_path relative to the listing's root); paths that the listing lacks raise ConstraintError. Companions are looked up in the listing."""
    rows = text_table(spark, sheet, ["sample_id", "slide_path"]).withColumnRenamed("slide_path", "relative_path")
    v.enforce(v.violations(rows, "sample_id", [v.Rule("blank_path", F.col("relative_path").isNull())]), v.missing(rows, listing, "relative_path"))
    return manifest(rows.select("sample_id", "relative_path").join(listing, "relative_path"), policy, listing=listing)


def workflow_roster(wanted: DataFrame, results: DataFrame) -> DataFrame:
    """wanted (sample_id) with counts_exist, summary_exists and completed, from results (sample_id, artifact)."""
    have = results.groupBy("sample_id").agg(F.bool_or(F.col("artifact") == "counts").alias("_c"), F.bool_or(F.col("artifact") == "summary").alias("_s"))
    out = wanted.join(have, "sample_id", "left").withColumn("counts_exist", F.coalesce("_c", F.lit(False))).withColumn("summary_exists", F.coalesce("_s", F.lit(False)))
    return out.withColumn("completed", F.col("counts_exist") & F.col("summary_exists")).drop("_c", "_s")


def artifacts_complete(artifacts: DataFrame, required: list[str]) -> DataFrame:
    """(slide_id, complete, missing): whether every required artifact (slide_id, artifact, length, ok) is there, not empty and valid."""
    good = F.collect_set(F.when((F.col("length") > 0) & F.col("ok"), F.col("artifact")))
    lacking = F.array_except(F.array(*[F.lit(r) for r in required]), good)
    return artifacts.groupBy("slide_id").agg(lacking.alias("_m")).select("slide_id", (F.size("_m") == 0).alias("complete"), F.array_join(F.array_sort("_m"), ";").alias("missing"))


def cache_decision(rows: DataFrame) -> DataFrame:
    """rows (tiled, cached, provenance_matches) with action: use_source, reuse, rebuild or build."""
    action = F.when(F.col("tiled"), "use_source").when(F.col("cached") & F.coalesce("provenance_matches", F.lit(False)), "reuse").when(F.col("cached"), "rebuild").otherwise("build")
    return rows.withColumn("action", action)
