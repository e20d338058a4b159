"""Nested cross-validation with MLlib: preprocessing fitted inside each fold, models by name, importance by permutation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import sampling, stats

MISSING = "__MISSING__"
RARE = "__RARE__"

#: The grids that are searched, the reference's. 30 is MLlib's greatest depth and stands for no limit.
GRIDS = {
    "elastic_net": [{"c": c, "l1": l1} for c in (0.01, 0.1, 1.0, 10.0) for l1 in (0.0, 0.5, 1.0)],
    "random_forest": [{"depth": d, "leaf": leaf, "features": f} for d in (3, 30) for leaf in (2, 5) for f in ("sqrt", "0.5")],
    "dummy": [{}],
}


def fit_preprocessor(train: DataFrame, numeric: list[str], categorical: list[str], least: int = 2) -> dict:
    """Medians, means and deviations of numbers and the frequent levels of categories; a few values a feature. Runs jobs."""
    out: dict = {"numeric": {}, "categorical": {}}
    if numeric:
        medians = train.agg(*[F.median(c).alias(c) for c in numeric]).first()
        filled = [F.coalesce(F.col(c).cast("double"), F.lit(medians[c] or 0.0)) for c in numeric]
        m = train.agg(*[F.avg(x).alias(f"m{i}") for i, x in enumerate(filled)], *[F.stddev_pop(x).alias(f"s{i}") for i, x in enumerate(filled)]).first()
        out["numeric"] = {c: (medians[c] or 0.0, m[f"m{i}"] or 0.0, m[f"s{i}"] or 1.0) for i, c in enumerate(numeric)}
    for c in categorical:
        rows = train.groupBy(F.coalesce(F.col(c).cast("string"), F.lit(MISSING)).alias("v")).count().where(F.col("count") >= least).select("v")
        out["categorical"][c] = sorted(r[0] for r in rows.collect())
    return out


def transform(df: DataFrame, p: dict) -> DataFrame:
    """df with features: standardised numbers with a flag where they were missing, and 0/1 for frequent levels and for all rare ones together."""
    from pyspark.ml.functions import array_to_vector

    columns = []
    for c, (median, mean, deviation) in p["numeric"].items():
        columns += [(F.coalesce(F.col(c).cast("double"), F.lit(median)) - mean) / (deviation or 1.0), F.col(c).isNull().cast("double")]
    for c, levels in p["categorical"].items():
        value = F.coalesce(F.col(c).cast("string"), F.lit(MISSING))
        columns += [(value == level).cast("double") for level in levels] + [(~value.isin(levels)).cast("double")]
    return df.withColumn("features", array_to_vector(F.array(*columns)))


def model(name: str, params: dict, n: int, seed: int):
    from pyspark.ml.classification import LogisticRegression, RandomForestClassifier

    if name == "elastic_net":
        return LogisticRegression(labelCol="y", weightCol="weight", elasticNetParam=params["l1"], regParam=1 / (params["c"] * max(1, n)), standardization=False, maxIter=200)
    if name == "random_forest":
        return RandomForestClassifier(labelCol="y", weightCol="weight", numTrees=params.get("trees", 300), maxDepth=params["depth"], minInstancesPerNode=params["leaf"], featureSubsetStrategy=params.get("features", "auto"), seed=seed)
    raise ValueError(f"unknown model {name}")


def predicted(train: DataFrame, test: DataFrame, name: str, params: dict, seed: int) -> DataFrame:
    """test with p, the probability of y = 1; classes weigh the same in training."""
    from pyspark.ml.functions import vector_to_array

    n, positive = train.agg(F.count(F.lit(1)), F.sum("y")).first()
    positive = positive or 0
    if name == "dummy" or not 0 < positive < n:
        return test.withColumn("p", F.lit(positive / max(1, n)))
    weighted = train.withColumn("weight", F.when(F.col("y") == 1, n / (2.0 * positive)).otherwise(n / (2.0 * (n - positive))))
    fitted = model(name, params, n, seed).fit(weighted)
    return fitted.transform(test).withColumn("p", vector_to_array("probability")[1])


#: Rows of a training table that are worth a part of their own, and fits that run side by side.
PART_ROWS, THREADS = 50_000, 8


def _kept(rows: DataFrame) -> DataFrame:
    """rows cached in parts by their number: trees and gradients make one job a level or step, each with one task a part."""
    return rows.coalesce(max(1, -(-rows.count() // PART_ROWS))).cache()


def _side_by_side(spark, task, items: list, threads: int) -> list:
    from multiprocessing.pool import ThreadPool

    from pyspark.util import inheritable_thread_target

    with ThreadPool(max(1, min(threads, len(items)))) as pool:
        return pool.map(inheritable_thread_target(spark)(task), items)


def _prepared(train: DataFrame, test: DataFrame, numeric: list[str], categorical: list[str], *keep: str) -> tuple[DataFrame, DataFrame]:
    """The features of both, with the preprocessor that fits train."""
    p = fit_preprocessor(train, numeric, categorical)
    return tuple(_kept(transform(x, p).select("y", *keep, "features")) for x in (train, test))


def best_options(trains: list[DataFrame], key: str, numeric: list[str], categorical: list[str], name: str, options: list[dict], inner: int, repeats: list[int], seed: int, threads: int = THREADS) -> list[dict]:
    """For each training table the option with the best mean AUC over its inner folds, the first of equal ones.

    Each inner fold's tables are prepared once; the fits of all tables, folds and options run side by side, and all their predictions are scored by one job.
    """
    if len(options) == 1:
        return [options[0]] * len(trains)
    spark = trains[0].sparkSession

    def fold_tables(at: tuple[int, int]) -> tuple:
        i, fold = at
        return i, fold, *_prepared(dealt[i].where(F.col("fold") != fold), dealt[i].where(F.col("fold") == fold), numeric, categorical)

    dealt = [sampling.stratified_folds(t, key, "y", inner, seed + 1 + i, repeat).cache() for i, (t, repeat) in enumerate(zip(trains, repeats))]
    tables = _side_by_side(spark, fold_tables, [(i, fold) for i in range(len(trains)) for fold in range(inner)], threads)

    def fit(task: tuple) -> DataFrame:
        (i, fold, train, test), o = task
        return predicted(train, test, name, options[o], seed).select(F.lit(i).alias("i"), F.lit(o).alias("o"), F.lit(fold).alias("fold"), "y", "p")

    every = _side_by_side(spark, fit, [(t, o) for t in tables for o in range(len(options))], threads)
    while len(every) > 1:  # a union of unions, not a chain of them
        every = [a.unionAll(b) for a, b in zip(every[::2], every[1::2])] + every[len(every) & ~1 :]
    scores = stats.roc_auc(every[0], by=("i", "o", "fold"), parts=1).groupBy("i", "o").agg(F.avg("auc").alias("auc")).collect()  # one row a table and option
    score = {(r.i, r.o): r.auc if r.auc is not None else 0.0 for r in scores}
    for table in [*dealt, *(t for x in tables for t in x[2:])]:
        table.unpersist()
    return [options[max(range(len(options)), key=lambda o: score.get((i, o), 0.0))] for i in range(len(trains))]


def nested_cv(df: DataFrame, key: str, numeric: list[str], categorical: list[str], name: str, outer: int = 5, inner: int = 3, repeats: int = 1, seed: int = 0, grid: list[dict] | None = None, group: str | None = None) -> DataFrame:
    """(key, repeat, fold, y, p): out-of-fold probabilities of df (key, y, features). Each outer fold picks the parameters with the best inner AUC."""
    if support := df.groupBy("y").count().where(F.col("count") < outer).count():
        raise ValueError(f"{support} classes have fewer rows than there are folds")
    folds = []
    for repeat in range(repeats):
        dealt = sampling.grouped_folds(df, group, "y", outer, seed, repeat) if group else sampling.stratified_folds(df, key, "y", outer, seed, repeat)
        dealt = dealt.cache()
        folds += [(repeat, fold, dealt.where(F.col("fold") != fold).drop("fold"), dealt.where(F.col("fold") == fold)) for fold in range(outer)]
    best = best_options([f[2] for f in folds], key, numeric, categorical, name, grid or GRIDS[name], inner, [f[0] for f in folds], seed)

    def fit(task: tuple) -> DataFrame:
        (repeat, fold, train, test), option = task
        train, test = _prepared(train, test, numeric, categorical, key)
        return predicted(train, test, name, option, seed).select(key, F.lit(repeat).alias("repeat"), F.lit(fold).alias("fold"), "y", "p")

    out = None
    for done in _side_by_side(df.sparkSession, fit, list(zip(folds, best)), THREADS):
        out = done if out is None else out.unionAll(done)
    return out


def permutation_importance(train: DataFrame, test: DataFrame, key: str, numeric: list[str], categorical: list[str], name: str, params: dict, repeats: int = 5, seed: int = 0) -> DataFrame:
    """(feature, mean, deviation) of how much AUC on test (key, y, features) is lost when a feature's values are dealt out anew, over repeats; deviation of the population.

    One model is fitted on train. test comes once for each feature and repeat, in long form: ranks by two digests pair every row with the row whose value it gets, so
    one join, one pass of the model and one ranking of scores serve all of them, whatever their number. A null auc, of one class only, gives nulls. key tells the rows of test apart.
    """
    from pyspark.ml.functions import vector_to_array

    from ..functions.hashing import rank_hash
    from .ranking import hash_ranked

    features = [*numeric, *categorical]
    p = fit_preprocessor(train, numeric, categorical)
    n, positive = train.agg(F.count(F.lit(1)), F.sum("y")).first()
    positive = positive or 0
    rounds = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.lit(r).alias("repeat")) for f in features for r in range(repeats)])).alias("_round")
    long = test.select(key, "y", *features, rounds).select("*", "_round.*").drop("_round")
    digest = lambda end: rank_hash(F.col(key), F.lit(seed), F.col("feature"), F.col("repeat"), seed=end)
    to = hash_ranked(long, digest("to"), key, by=("feature", "repeat"), name="_i")
    giver = hash_ranked(long, digest("from"), key, by=("feature", "repeat"), name="_i").select("feature", "repeat", "_i", F.struct(*features).alias("_from"))
    dealt = to.join(giver, ["feature", "repeat", "_i"]).withColumns({f: F.when(F.col("feature") == f, F.col(f"_from.{f}")).otherwise(F.col(f)) for f in features})
    rows = dealt.select("feature", "repeat", "y", *features).unionByName(test.select(F.lit(None).cast("string").alias("feature"), F.lit(None).cast("int").alias("repeat"), "y", *features))
    if name == "dummy" or not 0 < positive < n:
        scored = rows.withColumn("p", F.lit(positive / max(1, n)))
    else:
        weighted = train.withColumn("weight", F.when(F.col("y") == 1, n / (2.0 * positive)).otherwise(n / (2.0 * (n - positive))))
        fitted = model(name, params, n, seed).fit(_kept(transform(weighted, p).select("y", "weight", "features")))
        scored = fitted.transform(transform(rows, p)).withColumn("p", vector_to_array("probability")[1])
    # what is not dealt out has a name of its own, as nulls join with nothing
    scored = scored.select(F.coalesce("feature", F.lit("")).alias("feature"), F.coalesce("repeat", F.lit(-1)).alias("repeat"), "y", "p")
    auc = stats.roc_auc(scored, by=("feature", "repeat"), parts=1)
    base = auc.where("repeat = -1").select(F.col("auc").alias("base"))  # one row
    lost = auc.where("repeat >= 0").crossJoin(F.broadcast(base)).withColumn("lost", F.col("base") - F.col("auc"))
    return lost.groupBy("feature").agg(F.avg("lost").alias("mean"), F.stddev_pop("lost").alias("deviation"))


def permuted(df: DataFrame, key: str, column: str, seed: int) -> DataFrame:
    """df with the column's values dealt out anew: row of rank i by one digest gets the value of row of rank i by another."""
    from ..functions.hashing import rank_hash
    from .ranking import hash_ranked

    a = hash_ranked(df, rank_hash(F.col(key), seed=f"{seed}-to"), key, name="_i").drop(column)
    b = hash_ranked(df.select(key, column), rank_hash(F.col(key), seed=f"{seed}-from"), key, name="_i").select("_i", column)
    return a.join(b, "_i").drop("_i")
