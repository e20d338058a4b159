"""Linking a clinical table, a matrix and its audit by a normalised key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import compatible, slide_key


def outcome_of(x: Column, positive: str, negative: str) -> Column:
    """1, 0 or null for a label, whatever its case."""
    text = F.lower(F.trim(x))
    return F.when(text == positive.lower(), 1).when(text == negative.lower(), 0)


def pooled_audit(audit: DataFrame, key: str = "sample_id") -> DataFrame:
    """(key, completed, n_slides, mixed): an audit by sample; mixed where some slides are included and others are not, which linkage doesn't take."""
    return audit.groupBy(key).agg(F.min("included").alias("completed"), F.count(F.lit(1)).alias("n_slides"), (F.min("included") != F.max("included")).alias("mixed"))


def linkage(clinical: DataFrame, matrix: DataFrame, audit: DataFrame) -> DataFrame:
    """One row for each key of clinical (key, outcome), matrix (key) and audit (key, completed): where it is, whether it is included, and why not."""
    c = clinical.select("key", "outcome", F.lit(True).alias("in_clinical"))
    m = matrix.select("key", F.lit(True).alias("in_matrix"))
    a = audit.select("key", "completed", F.lit(True).alias("in_audit"))
    out = c.join(m, "key", "full_outer").join(a, "key", "full_outer").fillna(False, ["in_clinical", "in_matrix", "in_audit"])
    done = F.coalesce("completed", F.lit(False))
    reasons = F.concat_ws(
        ";",
        F.when(~F.col("in_clinical"), "missing_clinical_row"),
        F.when(~F.col("in_matrix"), "missing_matrix_column"),
        F.when(~F.col("in_audit"), "missing_audit_row").when(~done, "slide_not_completed"),
        F.when(F.col("outcome").isNull(), "missing_or_unmapped_outcome"),
    )
    included = F.col("in_clinical") & F.col("in_matrix") & done & F.col("outcome").isNotNull()
    return out.select("key", "in_clinical", "in_matrix", "in_audit", done.alias("completed"), "outcome", included.alias("included"), reasons.alias("reason"))


def keyed(df: DataFrame, column: str) -> DataFrame:
    """df with key, the normalised form of an id column: compatible letters in upper case, separators as one hyphen. An id of which nothing is left is an error, a null one is null."""
    key = slide_key(F.col("_id"))
    out = df.withColumn("_id", compatible(F.col(column).cast("string"))).withColumn("key", key).drop("_id")
    return out.withColumn("key", F.when(F.col("key") == "", F.raise_error(F.concat(F.lit("no key is left of the id "), F.col(column).cast("string"))).cast("string")).otherwise(F.col("key")))


def roster_with(clinical: DataFrame, *tables: DataFrame, key: str = "key") -> DataFrame:
    """Every clinical row with the columns of the tables; where one has no row its columns are null, never 0. Clashing columns are an error."""
    out = clinical
    for t in tables:
        if clash := sorted((set(out.columns) & set(t.columns)) - {key}):
            raise ValueError(f"columns in more than one table: {', '.join(clash)}")
        out = out.join(t, key, "left")
    return out


def analysis_cohort(linked: DataFrame, *tables: DataFrame, key: str = "key") -> DataFrame:
    """The included keys with their outcome and the columns of all tables."""
    out = linked.where("included").select(key, "outcome")
    for t in tables:
        out = out.join(t, key)
    return out


def missingness(df: DataFrame, features: list[str]) -> DataFrame:
    """(feature, n_missing, fraction): null and blank values; one pass, one row a feature."""
    blank = lambda c: F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == "")
    counts = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(blank(c)).alias(c) for c in features])
    return counts.unpivot(["_n"], features, "feature", "n_missing").select("feature", "n_missing", F.coalesce(F.try_divide("n_missing", "_n"), F.lit(0.0)).alias("fraction"))


def crosstab(df: DataFrame, value: str, outcome: str = "outcome") -> DataFrame:
    """(value, n0, n1): rows by outcome."""
    return df.groupBy(F.col(value).alias("value")).agg(F.count_if(F.col(outcome) == 0).alias("n0"), F.count_if(F.col(outcome) == 1).alias("n1"))


def reason_histogram(linked: DataFrame) -> DataFrame:
    return linked.where("reason != ''").select(F.explode(F.split("reason", ";")).alias("reason")).groupBy("reason").count().withColumnRenamed("count", "n")
