"""Cohort tables: rosters with an audit, class counts by sample, fractions and matrices.

A class that a completed sample does not have is 0. A sample that failed is no column of any matrix and stays in the audit; its totals are null.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F



def class_counts(cells: DataFrame, *by: str) -> DataFrame:
    """Rows by class, null classes included."""
    return cells.groupBy(*by, "class_id", "class_name").agg(F.count(F.lit(1)).alias("n"))


def eligibility(selected: Column, completed: Column, returncode: Column, has_summary: Column, in_manifest: Column) -> dict[str, Column]:
    """included, status and reason of a roster row. selected may be null, which counts as true; without a manifest row the summary decides."""
    chosen = F.coalesce(selected, F.lit(True))
    done = F.coalesce(completed, F.lit(False))
    clean = returncode.isNull() | (returncode == 0)
    included = F.when(in_manifest, chosen & done & clean).otherwise(has_summary)
    status = F.when(included, "included").when(in_manifest & ~chosen, "excluded_unselected").otherwise("excluded_incomplete")
    reason = F.when(included, F.lit(None)).when(in_manifest & ~chosen, "unselected").when(in_manifest & ~done, "incomplete").when(in_manifest & ~clean, "returncode").otherwise("missing_summary")
    return {"included": included, "status": status, "reason": reason.cast("string")}


def roster(counts: DataFrame, summaries: DataFrame, manifest: DataFrame | None, key: str = "slide_id") -> DataFrame:
    """One row a slide with has_counts, has_summary and in_manifest: the manifest's slides if there is one, else those of either table."""
    have_counts = counts.select(key).distinct().withColumn("has_counts", F.lit(True))
    have_summary = summaries.withColumn("has_summary", F.lit(True))
    if manifest is not None:
        base = manifest.withColumn("in_manifest", F.lit(True)).join(have_counts, key, "left").join(have_summary, key, "left")
    else:
        base = have_counts.join(have_summary, key, "full_outer").withColumn("in_manifest", F.lit(False))
    return base.withColumns({c: F.coalesce(c, F.lit(False)) for c in ("has_counts", "has_summary")})


def audit(base: DataFrame, totals: DataFrame, key: str = "slide_id") -> DataFrame:
    """base (completed, selected, returncode, has_summary, in_manifest) with included, status, reason and, where included, total_cells (0 without cells)."""
    out = base.join(totals.select(key, F.col("total").alias("_total")), key, "left")
    out = out.withColumns(eligibility(F.col("selected"), F.col("completed"), F.col("returncode"), F.col("has_summary"), F.col("in_manifest")))
    return out.withColumn("total_cells", F.when(F.col("included"), F.coalesce("_total", F.lit(0)))).drop("_total")


def pooled(counts: DataFrame, sample_map: DataFrame | None, key: str = "slide_id") -> DataFrame:
    """(sample_id, class_id, cell_type, n): slides' counts summed up by sample; slides that the map does not name are samples of their own."""
    if sample_map is not None:
        counts = counts.join(sample_map.select(key, F.col("sample_id").alias("_sample")), key, "left").withColumn("sample_id", F.coalesce("_sample", key))
    else:
        counts = counts.withColumn("sample_id", F.col(key))
    return counts.groupBy("sample_id", "class_id", F.col("class_name").alias("cell_type")).agg(F.sum("n").alias("n"))


def fractions(long: DataFrame, by: str = "sample_id", value: str = "n") -> DataFrame:
    """long with fraction of the sample's total; 0 where the total is 0."""
    return long.withColumn("_total", F.sum(value).over(W.partitionBy(by))).withColumn("fraction", F.coalesce(F.try_divide(F.col(value), F.when(F.col("_total") != 0, F.col("_total"))), F.lit(0.0))).drop("_total")


def dense(long: DataFrame, samples: DataFrame, classes: DataFrame, value: str = "n") -> DataFrame:
    """A row for each sample of samples and class of classes, 0 where long has none. classes is a small dimension."""
    grid = samples.select("sample_id").distinct().crossJoin(classes.select("class_id", "cell_type").distinct())
    return grid.join(long, ["sample_id", "class_id", "cell_type"], "left").withColumn(value, F.coalesce(value, F.lit(0)))


def matrix(long: DataFrame, samples: list[str], value: str = "n", zero: float | int = 0) -> DataFrame:
    """A row a class and a column for each of the samples, in that order, 0 where long has none; samples that are not listed get no column."""
    wide = long.where(F.col("sample_id").isin(samples)).groupBy("class_id", "cell_type").pivot("sample_id", samples).agg(F.sum(value))
    return wide.fillna(zero, subset=samples) if samples else wide


def matrix_order() -> list[Column]:
    """Order of a matrix's rows: known classes by id, then unmapped ones by name."""
    return [F.col("class_id") < 0, F.greatest("class_id", F.lit(0)), F.lower("cell_type")]


def unpivoted(wide: DataFrame, keys: list[str], value: str = "n") -> DataFrame:
    return wide.unpivot(keys, [c for c in wide.columns if c not in keys], "sample_id", value)


def feature_rows(long: DataFrame, prefix: str, features: list[str], value: str = "n") -> DataFrame:
    """Sample rows with one column for each of the features PREFIX__id__SLUG."""
    from ..functions.text import feature_slug

    name = F.concat(F.lit(f"{prefix}__"), F.col("class_id").cast("string"), F.lit("__"), feature_slug(F.col("cell_type")))
    return long.withColumn("feature", name).groupBy("sample_id").pivot("feature", features).agg(F.sum(value))


def homogeneity(summaries: DataFrame, expected: float | None = None, allow_mixed: bool = False) -> DataFrame:
    """One row: sorted distinct percents and seeds, and the first rule on sampling that the cohort breaks, or null."""
    percent, seed = F.col("percent_slide"), F.col("random_seed")
    none = F.lit(False)
    tests = [
        ("missing_percent", F.bool_or(percent.isNull()) if expected is not None else F.bool_or(none)),
        ("unexpected_percent", F.bool_or(F.abs(percent - expected) > 1e-9) if expected is not None else F.bool_or(none)),
        ("missing_seed", F.bool_or((percent < 100) & seed.isNull())),
        ("legacy_and_sampled", F.bool_or(percent.isNull()) & F.bool_or(percent < 100)),
        ("mixed_sampling", F.lit(not allow_mixed) & ((F.countDistinct(percent) > 1) | (F.countDistinct(seed) > 1))),
    ]
    code = F.coalesce(*[F.when(t, name) for name, t in tests])
    return summaries.agg(F.array_sort(F.collect_set(percent)).alias("percents"), F.array_sort(F.collect_set(seed)).alias("seeds"), code.alias("violation"))


def top_classes(long: DataFrame, most: int = 15) -> DataFrame:
    """The classes with the most cells, ties by name, with their percent of all cells."""
    sums = long.groupBy("cell_type").agg(F.sum("n").alias("n"))
    total = sums.agg(F.sum("n").alias("_total"))
    return sums.crossJoin(F.broadcast(total)).withColumn("percent", F.col("n") * 100.0 / F.col("_total")).drop("_total").orderBy(F.desc("n"), "cell_type").limit(most)


@dataclass(frozen=True)
class Cohort:
    """What aggregate() makes."""

    audit: DataFrame
    long: DataFrame
    counts: DataFrame
    fractions: DataFrame
    summary: DataFrame


def aggregate(counts: DataFrame, summaries: DataFrame, manifest: DataFrame | None = None, sample_map: DataFrame | None = None) -> Cohort:
    """Validated cohort tables of per-slide class counts (slide_id, class_id, class_name, n) and summaries (slide_id, n_cells, zero_detections).

    Runs jobs: constraints are enforced, and the included samples, one a column of the matrices, are listed.
    """
    from ..functions.text import natural_key
    from . import validate as v

    base = roster(counts, summaries.select("slide_id", "n_cells", "zero_detections"), manifest)
    for c, kind in (("completed", "boolean"), ("selected", "boolean"), ("returncode", "int")):
        if c not in base.columns:
            base = base.withColumn(c, F.lit(None).cast(kind))
    totals = counts.groupBy("slide_id").agg(F.sum("n").alias("total"))
    table = audit(base, totals)
    included = table.where("included")
    rules = [
        v.Rule("no_counts", ~F.col("has_counts") & ~F.coalesce("zero_detections", F.lit(False))),
        v.Rule("no_summary", ~F.col("has_summary")),
        v.Rule("total_differs", F.col("n_cells") != F.col("total_cells")),
        v.Rule("zero_flag_differs", F.coalesce("zero_detections", F.lit(False)) != (F.col("total_cells") == 0)),
    ]
    v.enforce(v.duplicates(table, "slide_id"), v.violations(included, "slide_id", rules))
    if sample_map is not None:
        v.enforce(v.duplicates(sample_map, "slide_id"), v.missing(table, sample_map, "slide_id"), v.violations(sample_map, "sample_id", v.id_rules("sample_id")))
    used = counts.join(included.select("slide_id"), "slide_id", "left_semi")
    long = pooled(used, sample_map)
    v.enforce(v.class_mapping(long.withColumnRenamed("cell_type", "class_name")))
    names = included.select("slide_id") if sample_map is None else included.join(sample_map, "slide_id")
    names = names.select(F.col("slide_id" if sample_map is None else "sample_id").alias("sample_id")).distinct()
    samples = [r[0] for r in names.orderBy(natural_key(F.col("sample_id")), "sample_id").collect()]
    shares = fractions(long)
    return Cohort(table, long, matrix(long, samples).orderBy(*matrix_order()), matrix(shares, samples, "fraction", 0.0).orderBy(*matrix_order()), rollup(table, long))


def rollup(table: DataFrame, long: DataFrame) -> DataFrame:
    """One row of counts over an audit and its long table."""
    a = table.agg(F.count(F.lit(1)).alias("n_slides"), F.count_if("included").alias("n_included"), F.count_if(~F.col("included")).alias("n_excluded"), F.coalesce(F.sum("total_cells"), F.lit(0)).alias("total_cells"))
    b = long.agg(F.countDistinct("sample_id").alias("n_samples"), F.countDistinct("cell_type").alias("n_cell_types"))
    return a.crossJoin(b)
