"""Checks between count and fraction matrices, and tables of classes for display."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import color_of_class, natural_key
from .ranking import ordered
from .validate import close


def mismatches(counts: DataFrame, fractions: DataFrame, key: tuple[str, ...] = ("sample_id", "class_id")) -> DataFrame:
    """(key, problem) of two long tables n and fraction: rows that one of them lacks, and fractions that are not the count's share of its sample."""
    totals = counts.groupBy(key[0]).agg(F.sum("n").alias("_t"))
    a = counts.join(totals, key[0]).select(*key, F.coalesce(F.try_divide("n", F.when(F.col("_t") != 0, F.col("_t"))), F.lit(0.0)).alias("_share"))
    both = a.join(fractions.select(*key, "fraction"), list(key), "full_outer")
    off = ~(F.abs(F.col("fraction") - F.col("_share")) <= 1e-8 + 1e-7 * F.abs("_share"))
    problem = F.when(F.col("_share").isNull(), "missing_count").when(F.col("fraction").isNull(), "missing_fraction").when(F.coalesce(off, F.lit(True)), "fraction_differs")
    return both.select(*key, problem.alias("problem")).where("problem is not null")


def total_problems(fractions: DataFrame, by: str = "sample_id") -> DataFrame:
    """(by, total) of the samples whose fractions add up to neither 1 (within 1e-6) nor 0 (within 1e-12)."""
    totals = fractions.groupBy(by).agg(F.sum("fraction").alias("total"))
    return totals.where(~((F.abs(F.col("total") - 1) <= 1e-6) | (F.abs("total") <= 1e-12)))


def detected(counts: DataFrame) -> DataFrame:
    """counts (class_id, class_name, n) with each class's share of all and its colour."""
    total = counts.agg(F.sum("n").alias("_t"))
    share = F.coalesce(F.try_divide("n", F.when(F.col("_t") != 0, F.col("_t"))), F.lit(0.0))
    return counts.crossJoin(F.broadcast(total)).withColumn("share", share).withColumn("color", color_of_class(F.col("class_id"))).drop("_t")


def inferred_counts(df: DataFrame, name: str, count: str) -> DataFrame:
    """(cell_type, n, percent) of a table read as text: what is no positive number is left out, equal names are put together."""
    number = F.trim(count).try_cast("double")
    sums = df.where((number > 0) & (F.trim(name) != "")).groupBy(F.trim(name).alias("cell_type")).agg(F.sum(number).alias("n"))
    return sums.crossJoin(F.broadcast(sums.agg(F.sum("n").alias("_t")))).withColumn("percent", F.col("n") * 100 / F.col("_t")).drop("_t")


def sample_rows(long: DataFrame, samples: DataFrame, classes: list[str]) -> DataFrame:
    """A row a sample with a column for each class: 0 for a class that a counted sample lacks, null all along for a sample without counts."""
    wide = long.groupBy("sample_id").pivot("cell_type", classes).agg(F.sum("n")).fillna(0, classes).withColumn("has_counts", F.lit(True))
    return samples.select("sample_id").distinct().join(wide, "sample_id", "left").withColumn("has_counts", F.coalesce("has_counts", F.lit(False)))


def class_order(long: DataFrame) -> list[str]:
    """Class names by their sums, the greatest first, then in natural order. A few rows come to the driver."""
    sums = long.groupBy("cell_type").agg(F.sum("n").alias("n"))
    return [r.cell_type for r in sums.orderBy(F.desc("n"), natural_key(F.col("cell_type"))).select("cell_type").collect()]


def numbered(df: DataFrame, order: list[Column], pattern: str, name: str = "alias") -> DataFrame:
    """df with aliases from a pattern such as ``case_%03d`` in an order."""
    return ordered(df, order, "_at").withColumn(name, F.format_string(pattern, F.col("_at"))).drop("_at")


def occurrence_names(df: DataFrame, base: str, position: str, name: str = "unique_name") -> DataFrame:
    """df with names made unique: the second of equal ones gets __2, the third __3."""
    n = F.row_number().over(W.partitionBy(base).orderBy(position))
    return df.withColumn(name, F.when(n == 1, F.col(base)).otherwise(F.concat(F.col(base), F.lit("__"), n.cast("string"))))


def batches(df: DataFrame, order: list[Column], size: int) -> DataFrame:
    """df with batch 0, 1, ... of size rows each, in an order."""
    return ordered(df, order, "_at").withColumn("batch", F.floor((F.col("_at") - 1) / size).cast("int")).drop("_at")


def level_index(levels: DataFrame, by: str = "file", scale: str = "scale") -> DataFrame:
    """levels with index 0, 1, ... from the greatest scale down in each file."""
    return levels.withColumn("index", F.row_number().over(W.partitionBy(by).orderBy(F.desc(scale))) - 1)


def fold_summary(metrics: DataFrame, names: list[str]) -> DataFrame:
    """(feature_set, model, metric, mean, std): sample deviations over folds."""
    long = metrics.unpivot(["feature_set", "model"], names, "metric", "value")
    return long.groupBy("feature_set", "model", "metric").agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"))


def group_outcomes(df: DataFrame, group: str, outcome: str) -> DataFrame:
    """(group, outcome, mixed): one outcome for each group, and whether its rows disagree."""
    return df.groupBy(group).agg(F.min(outcome).alias(outcome), (F.min(outcome) != F.max(outcome)).alias("mixed"))


def leaked(folds: DataFrame, group: str, fold: str = "fold") -> DataFrame:
    """Groups that lie in more than one fold."""
    return folds.groupBy(group).agg(F.countDistinct(fold).alias("n")).where("n > 1").select(group)


def entry_problems(state: DataFrame, expected: DataFrame, keys: list[str], exact: list[str], near: list[str]) -> DataFrame:
    """(keys, problem) of state entries that are not the expected ones: exact fields null-safe, near ones within 1e-9."""
    s, e = state.select(*keys, *[F.col(c).alias(f"_s_{c}") for c in exact + near], F.lit(True).alias("_s")), expected.select(*keys, *[F.col(c).alias(f"_e_{c}") for c in exact + near])
    problem = F.when(F.col("_s").isNull(), F.lit("missing"))
    for c in exact:
        problem = problem.when(~F.col(f"_s_{c}").eqNullSafe(F.col(f"_e_{c}")), F.lit(c))
    for c in near:
        problem = problem.when(~F.coalesce(close(F.col(f"_s_{c}"), F.col(f"_e_{c}"), 1e-9, 1e-9), F.col(f"_s_{c}").isNull() & F.col(f"_e_{c}").isNull()), F.lit(c))
    return e.join(s, keys, "left").select(*keys, problem.alias("problem")).where("problem is not null")


def scale_bar(width_px: Column, mpp: Column, presets: tuple[float, ...] = (10, 20, 25, 50, 100, 200, 250, 500, 1000, 2000, 5000)) -> Column:
    """Of the preset lengths in micrometres the one nearest to a fifth of the width (the first of two as near)."""
    target = width_px * mpp * 0.2
    options = F.array(*[F.struct(F.abs(F.lit(float(p)) - target).alias("d"), F.lit(i).alias("i"), F.lit(float(p)).alias("p")) for i, p in enumerate(presets)])
    return F.array_min(options).p
