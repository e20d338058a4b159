"""Composite verbs: from input tables to all tables of a report."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import name_of_class
from ..operators import clinical as clinic
from ..operators import cohort, features, integrity, linkage, ml, sampling, spatial, stats, validate
from ..operators.cohort import aggregate  # noqa: F401  (the cohort verb)
from ..sources.writers import stored


@dataclass(frozen=True)
class Analysis:
    """What analyse() makes."""

    linked: DataFrame
    cohort: DataFrame
    missing: DataFrame
    univariate: DataFrame
    problems: DataFrame
    manifest: DataFrame
    flow: DataFrame
    predictions: DataFrame | None
    metrics: DataFrame | None
    intervals: DataFrame | None


def slide_tables(cells: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A slide's cells in export order, and its class counts."""
    return cells.orderBy("class_id", "y", "x", "cell_id"), cohort.class_counts(cells, "slide_id")


def spatial_report(cells: DataFrame, size: int, most: int, width: int, height: int) -> tuple[DataFrame, DataFrame]:
    return spatial.roi_report(cells, size, most, width, height)


def embedding_report(cells: DataFrame, most: int, seed: int = 0, width: int = 1, height: int = 1, mpp: float = 1.0, rgb: tuple[str, str, str] | None = None, rings: str | None = None) -> DataFrame:
    """(cell_id, components) of a stratified sample of cells by the standardised features of cell_features(). Runs jobs."""
    drawn = sampling.stratified_sample(cells, "cell_id", "class_id", most, seed)
    drawn = drawn if "class_name" in drawn.columns else drawn.withColumn("class_name", name_of_class(F.col("class_id")))
    made, names = features.cell_features(drawn, width, height, mpp, rgb, rings)
    return features.principal_components(features.standardised(made, "cell_id", names), "cell_id", "vector")


def analyse(clinical: DataFrame, id_column: str, outcome_column: str, positive: str, negative: str, matrix_samples: DataFrame, audit: DataFrame, numeric: list[str], categorical: list[str], model: str | None = None, folds: int = 5, seed: int = 0, repeats: int = 1000) -> Analysis:
    """Linkage, eligible cohort, its flow and missingness, problems and manifest of the predictors by their declared types, univariate tests and, for a model, out-of-fold predictions
    with their metrics and the intervals of so many bootstrap repeats.

    clinical has the id and outcome as text and the features; matrix_samples (sample_id) and audit (sample_id, included) come from a cohort. Repeated keys and samples of
    which some slides are included and others are not raise ConstraintError. The linkage and the cohort are stored, as every other table starts from them.
    """
    keyed = linkage.keyed(clinical, id_column).withColumn("outcome", linkage.outcome_of(F.col(outcome_column), positive, negative))
    m = linkage.keyed(matrix_samples, "sample_id")
    pooled = linkage.pooled_audit(linkage.keyed(audit, "sample_id"), "key")
    validate.enforce(validate.duplicates(keyed, "key"), validate.duplicates(m, "key"), pooled.where("mixed").select("key"))
    linked = stored(linkage.linkage(keyed, m, pooled), "linked")
    rows = stored(linkage.analysis_cohort(linked, keyed.select("key", *numeric, *categorical)), "cohort")
    long = rows.select("key", "outcome", *[F.col(c).cast("string").alias(c) for c in numeric + categorical]).unpivot(["key", "outcome"], numeric + categorical, "feature", "value")
    types = clinic.feature_types(numeric + categorical, numeric, categorical)
    texts = rows.select("key", *[F.col(c).cast("string").alias(c) for c in types])
    predictions = metrics = intervals = None
    if model:
        table = rows.withColumnRenamed("outcome", "y")
        predictions = ml.nested_cv(table, "key", numeric, categorical, model, outer=folds, seed=seed)
        metrics = stats.confusion(predictions).crossJoin(stats.roc_auc(predictions)).crossJoin(stats.average_precision(predictions))
        units = predictions.select(F.col("key").cast("string").alias("evaluation_id"), F.lit("clinical").alias("feature_set"), F.lit(model).alias("model"), "y", "p")
        intervals = clinic.metric_intervals(units, repeats, seed)
    tables = clinic.feature_problems(texts, types), clinic.feature_manifest(texts, types), clinic.flow(linked)
    return Analysis(linked, rows, linkage.missingness(rows, numeric + categorical), stats.univariate(long), *tables, predictions, metrics, intervals)


def resume_plan(expected: DataFrame, state: DataFrame, key: str) -> DataFrame:
    """expected with todo: whether there is no valid state of the same signature."""
    todo = integrity.pending(expected, state, key).select(key, F.lit(True).alias("todo"))
    return expected.join(todo, key, "left").withColumn("todo", F.coalesce("todo", F.lit(False)))


def release_report(wanted: DataFrame, there: DataFrame) -> dict[str, DataFrame]:
    """Status of each file, totals by status and what only one side has."""
    return {"status": integrity.reconcile(wanted, there), "totals": integrity.transfer_plan(wanted, there), "one_sided": integrity.two_sided_except(wanted, there)}
