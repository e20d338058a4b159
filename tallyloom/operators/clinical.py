"""Clinical predictors with declared types, patient groups, and metrics of predictions with intervals by resampled groups."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from . import sampling, stats
from .validate import ConstraintError


def feature_types(features: list[str], numeric: list[str], categorical: list[str]) -> dict[str, str]:
    """numeric or categorical for each feature; ConstraintError names features that are repeated, typed twice, typed without being features, or not typed."""
    problems = []
    for name, values in (("features", features), ("numeric", numeric), ("categorical", categorical)):
        problems += [f"{v} is repeated in {name}" for v, n in sorted(Counter(values).items()) if n > 1]
    a, b, known = set(numeric), set(categorical), set(features)
    problems += [f"{v} has two types" for v in sorted(a & b)] + [f"{v} is no feature" for v in sorted((a | b) - known)] + [f"{v} has no type" for v in sorted(known - a - b)]
    if problems:
        raise ConstraintError("; ".join(problems))
    return {f: "numeric" if f in a else "categorical" for f in features}


def feature_names(features: list[str], prefix: str = "CLIN__") -> list[str]:
    """A name for each column: the prefix and its slug in upper case; the second of equal ones gets __2, and so on."""
    import re
    import unicodedata

    seen: Counter[str] = Counter()
    out = []
    for f in features:
        plain = "".join(c for c in unicodedata.normalize("NFKD", f) if not unicodedata.combining(c))
        name = prefix + (re.sub("[^A-Za-z0-9]+", "_", plain).strip("_").upper() or "FEATURE")
        seen[name] += 1
        out.append(name if seen[name] == 1 else f"{name}__{seen[name]}")
    return out


def feature_problems(df: DataFrame, types: dict[str, str], most_levels: int = 20) -> DataFrame:
    """(feature, code, n): numeric features with values that are neither blank nor numbers, and categorical ones with too many levels. One pass."""
    out = []
    for f, kind in types.items():
        value = F.col(f).cast("string")
        if kind == "numeric":
            out.append(F.struct(F.lit(f).alias("feature"), F.lit("not_numeric").alias("code"), F.count_if((F.trim(value) != "") & F.trim(value).try_cast("double").isNull()).alias("n"), F.lit(0).alias("most")))
        else:
            out.append(F.struct(F.lit(f).alias("feature"), F.lit("too_many_levels").alias("code"), F.countDistinct(tx.category(value, f)).alias("n"), F.lit(most_levels).alias("most")))
    return df.agg(F.array(*out).alias("p")).select(F.inline("p")).where("n > most").select("feature", "code", "n")


def prepared(df: DataFrame, types: dict[str, str], *keep: str) -> DataFrame:
    """The columns of keep and the features under their feature_names(): numbers as doubles, categories cleaned."""
    one = lambda f: F.trim(F.col(f).cast("string")).try_cast("double") if types[f] == "numeric" else tx.category(F.col(f).cast("string"), f)
    return df.select(*keep, *[one(f).alias(n) for f, n in zip(types, feature_names(list(types)))])


def feature_manifest(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """(feature_name, source, source_column, transformation, n_levels): n_levels for categories only."""
    levels = [F.countDistinct(tx.category(F.col(f).cast("string"), f)) if kind == "categorical" else F.lit(None) for f, kind in types.items()]
    names = zip(feature_names(list(types)), types, types.values(), levels)
    rows = [F.struct(F.lit(n).alias("feature_name"), F.lit("clinical").alias("source"), F.lit(f).alias("source_column"), F.lit(k).alias("transformation"), x.cast("bigint").alias("n_levels")) for n, f, k, x in names]
    return df.agg(F.array(*rows).alias("p")).select(F.inline("p"))


def group_problems(df: DataFrame, patient: str) -> DataFrame:
    """(code, key, n): rows without a patient (missing, null key) and patients with several rows (repeated)."""
    group = tx.squeezed(tx.compatible(F.col(patient).cast("string")))
    n = df.groupBy(F.when(group != "", group).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    return n.where("key is null or n > 1").select(F.when(F.col("key").isNull(), "missing").otherwise("repeated").alias("code"), "key", "n")


def lookup_problems(ids: DataFrame, groups: DataFrame, key: str = "analysis_id", group: str = "group") -> DataFrame:
    """(code, key) of ids without a group (uncovered) and of ids that groups (key, group) holds more than once (duplicate)."""
    n = groups.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.max(group).alias("_g"))
    both = ids.select(key).distinct().join(n, key, "left")
    code = F.when(F.col("_g").isNull(), "uncovered").when(F.col("_n") > 1, "duplicate")
    return both.select(code.alias("code"), F.col(key).cast("string").alias("key")).where("code is not null")


def evaluation_units(averaged: DataFrame, groups: DataFrame | None = None, key: str = "analysis_id") -> DataFrame:
    """(evaluation_id, feature_set, model, y, p): one unit a group of groups (key, group) with the mean probability, or one an id. averaged has key, feature_set, model, y and p."""
    if groups is None:
        return averaged.select(F.col(key).cast("string").alias("evaluation_id"), "feature_set", "model", "y", "p")
    rows = averaged.join(groups.select(key, F.col("group").cast("string").alias("evaluation_id")), key)
    return rows.groupBy("evaluation_id", "feature_set", "model").agg(F.min("y").alias("y"), F.avg("p").alias("p"))


def bootstrap_counts(units: DataFrame, repeats: int, seed: int) -> DataFrame:
    """(feature_set, model, y, p, repeat, drawn): how often units (evaluation_id, y) with these values are drawn, with replacement inside their outcome, as many as there are."""
    one = units.groupBy("evaluation_id").agg(F.min("y").alias("stratum"))
    return sampling.bootstrap_counts(one, "evaluation_id", "stratum", repeats, seed, ["feature_set", "model", "y", "p"], units)


def metric_intervals(units: DataFrame, repeats: int = 1000, seed: int = 0) -> DataFrame:
    """(feature_set, model, metric, point, low, high, n_units) for each metric of stats.METRICS: over all units, and the 2.5 and 97.5 percentiles of bootstrap draws of units."""
    keys = ["feature_set", "model"]
    point = stats.metrics(units, by=tuple(keys)).unpivot(keys, list(stats.METRICS), "metric", "point")
    drawn = bootstrap_counts(units, repeats, seed)
    values = stats.metrics(drawn, by=(*keys, "repeat"), weight="drawn").unpivot([*keys, "repeat"], list(stats.METRICS), "metric", "value")
    size = units.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_units"))
    return point.join(stats.intervals(values, "value", (*keys, "metric")), [*keys, "metric"], "left").join(size, keys)


#: Metrics of a comparison, and whether more is better.
COMPARED = {"roc_auc": 1, "balanced_accuracy": 1, "brier": -1}


def paired_intervals(units: DataFrame, pairs: list[tuple[str, str]], repeats: int = 1000, seed: int = 0) -> DataFrame:
    """(model, candidate, reference, metric, point, low, high) for pairs of feature sets: how much better the candidate is, over the units that both have, and its interval.

    Both sets of a pair are drawn together. Pairs of which a feature set has no units give no rows.
    """
    out = None
    for candidate, reference in pairs:
        both = units.where(F.col("feature_set") == candidate).select("evaluation_id", "model").join(units.where(F.col("feature_set") == reference).select("evaluation_id", "model"), ["evaluation_id", "model"], "left_semi")
        sides = units.where(F.col("feature_set").isin(candidate, reference)).join(both, ["evaluation_id", "model"], "left_semi")
        whole = sides.select("feature_set", "model", "y", "p", F.lit(0).alias("repeat"), F.lit(1).cast("bigint").alias("drawn"))
        drawn = bootstrap_counts(sides, repeats, seed).unionByName(whole)
        m = stats.metrics(drawn, by=("model", "repeat", "feature_set"), weight="drawn").unpivot(["model", "repeat", "feature_set"], list(COMPARED), "metric", "value")
        value = lambda s: F.max(F.when(F.col("feature_set") == s, F.col("value")))
        sign = F.when(F.col("metric") == "brier", -1.0).otherwise(1.0)
        delta = m.groupBy("model", "repeat", "metric").agg(((value(candidate) - value(reference)) * F.first(sign)).alias("delta"))
        point = delta.where("repeat = 0").select("model", "metric", F.col("delta").alias("point"))
        low = stats.intervals(delta.where("repeat > 0"), "delta", ("model", "metric"))
        one = point.join(low, ["model", "metric"], "left").select("model", F.lit(candidate).alias("candidate"), F.lit(reference).alias("reference"), "metric", "point", "low", "high")
        out = one if out is None else out.unionAll(one)
    return out


def importances(draws: DataFrame, most: int = 20) -> DataFrame:
    """(feature, mean, std) of draws (feature, importance): the most important features, ties by name."""
    means = draws.groupBy("feature").agg(F.avg("importance").alias("mean"), F.coalesce(F.stddev_samp("importance"), F.lit(0.0)).alias("std"))
    return means.orderBy(F.desc("mean"), "feature").limit(most)


def flow(linked: DataFrame) -> DataFrame:
    """One row: clinical rows, completed slides, included ones and their outcomes."""
    return linked.agg(
        F.count_if("in_clinical").alias("clinical"), F.count_if("completed").alias("completed"), F.count_if("included").alias("included"),
        F.count_if(F.col("included") & (F.col("outcome") == 0)).alias("negative"), F.count_if(F.col("included") & (F.col("outcome") == 1)).alias("positive"),
    )


def level_counts(df: DataFrame, value: str, by: str) -> DataFrame:
    """(by, counts) with the rows by value as a JSON object with sorted keys."""
    n = df.where(F.col(value).isNotNull()).groupBy(by, F.col(value).cast("string").alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    return n.groupBy(by).agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("_v", "_n"))))).alias("counts"))
