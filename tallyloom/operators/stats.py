"""Tests, discovery control and rank metrics, exact and over tables of any size."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .ranking import edges, quantiles, running


def tied(df: DataFrame, value: str, outcome: str, by: tuple[str, ...] = (), parts: int = 64) -> DataFrame:
    """(by, value, n, pos, up_n, up_pos): rows and positive rows at each value, and up to and with it; every metric by rank comes from this table."""
    groups = df.where(F.col(value).isNotNull() & F.col(outcome).isin(0, 1)).groupBy(*by, F.col(value).cast("double").alias("value")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(outcome)).alias("pos"))
    return running(groups, "value", {"n": "up_n", "pos": "up_pos"}, by, parts=parts)


def mann_whitney(df: DataFrame, value: str = "value", outcome: str = "outcome", by: tuple[str, ...] = ("feature",), parts: int = 1) -> DataFrame:
    """(by, n0, n1, u, effect, z): U of outcome 1, rank-biserial effect 2U / (n1 n0) - 1, and z with tie and continuity correction; nulls where a side is empty."""
    t = tied(df, value, outcome, by, parts)
    rank = F.col("up_n") - F.col("n") + (F.col("n") + 1) / 2.0
    sums = t.groupBy(*by).agg(F.sum("n").alias("n"), F.sum("pos").alias("n1"), F.sum(rank * F.col("pos")).alias("r1"), F.sum((F.col("n") * F.col("n") * F.col("n") - F.col("n")).cast("double")).alias("ties"))
    n, n1 = F.col("n").cast("double"), F.col("n1").cast("double")
    n0 = n - n1
    some = (n0 > 0) & (n1 > 0)
    u = F.when(some, F.col("r1") - n1 * (n1 + 1) / 2)
    spread = F.sqrt(n0 * n1 / 12.0 * ((n + 1) - F.try_divide(F.col("ties"), n * (n - 1))))
    away = u - n0 * n1 / 2
    z = F.when(spread > 0, (away - F.signum(away) * 0.5) / spread)
    return sums.select(*by, n0.cast("bigint").alias("n0"), n1.cast("bigint").alias("n1"), u.alias("u"), F.when(some, 2 * u / (n1 * n0) - 1).alias("effect"), F.when(some, z).alias("z"))


@F.pandas_udf(T.DoubleType())
def two_sided(z: pd.Series) -> pd.Series:
    """Two-sided p of a standard normal z."""
    return z.map(lambda x: None if x is None or math.isnan(x) else math.erfc(abs(x) / math.sqrt(2)))


#: n0 * n1 up to which exact_u counts; beyond it the smaller group has thousands of neighbours for each of its at most 8 values.
COUNTED = 4_000_000


def u_tail(low: int, a: int, b: int) -> int:
    """In how many ways a values among a + b have a U of low or less.

    The numbers by U are the coefficients of the product of (1 - q**(b + i)) / (1 - q**i) for i from 1 to a; a factor above is one subtraction of a shifted
    row, one below a running sum in steps of i. Coefficients up to low are enough; whole numbers, so nothing cancels.
    """
    ways = np.zeros(low + 1, dtype=object)
    ways[0] = 1
    for i in range(1, min(a, b) + 1):
        shift = max(a, b) + i
        if shift <= low:
            ways[shift:] = ways[shift:] - ways[: low + 1 - shift]
        for start in range(min(i, low + 1)):
            ways[start::i] = np.add.accumulate(ways[start::i])
    return int(ways.sum())


@F.pandas_udf(T.DoubleType())
def exact_u(u: pd.Series, n0: pd.Series, n1: pd.Series) -> pd.Series:
    """Two-sided p of U without ties from its exact distribution; null where n0 * n1 is above COUNTED or U is not whole."""

    def p(u: float, a: int, b: int) -> float | None:
        if u is None or math.isnan(u) or not 0 < a * b <= COUNTED or u != int(u):
            return None
        low, all_ways = min(int(u), a * b - int(u)), math.comb(a + b, a)
        return min(1.0, 2 * u_tail(low, a, b) / all_ways)

    return pd.Series([p(*x) for x in zip(u, n0, n1)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def fisher_p(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.Series:
    """Two-sided p of a 2 x 2 table: the chances of all tables with its margins that are no likelier."""

    def log_choose(n: int, k: int) -> float:
        return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)

    def p(a: int, b: int, c: int, d: int) -> float:
        rows, column, n = a + b, a + c, a + b + c + d
        chance = lambda x: log_choose(rows, x) + log_choose(n - rows, column - x) - log_choose(n, column)
        here, least, most = chance(a), max(0, column - (n - rows)), min(rows, column)
        peak = min(most, max(least, (rows + 1) * (column + 1) // (n + 2)))

        def tail(x: int, step: int) -> float:
            """Chances from x outward, as long as they add anything; they only fall from the peak on."""
            total = 0.0
            while least <= x <= most:
                v = chance(x)
                if v <= here + 1e-7:
                    total += (term := math.exp(v))
                    if term < total * 1e-17 or v < -745:
                        break
                x += step
            return total

        def first(x: int, step: int) -> int:
            """From the peak outward the first place that is no likelier, by halving."""
            near, far = x, most if step > 0 else least
            if chance(far) > here + 1e-7:
                return far + step
            while abs(far - near) > 1:
                middle = (near + far) // 2
                near, far = (middle, far) if chance(middle) > here + 1e-7 else (near, middle)
            return near if chance(near) <= here + 1e-7 else far

        return min(1.0, tail(first(peak, 1), 1) + tail(first(peak - 1, -1) if peak > least else least - 1, -1))

    return pd.Series([p(*map(int, x)) for x in zip(a, b, c, d)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def chi2_p(x: pd.Series, k: pd.Series) -> pd.Series:
    """Upper tail of chi-squared x with k degrees of freedom."""

    def p(x: float, k: int) -> float | None:
        if x is None or math.isnan(x) or not k > 0:
            return None
        a, y = k / 2, x / 2
        if y <= 0:
            return 1.0
        front = math.exp(-y + a * math.log(y) - math.lgamma(a))
        if y < a + 1:
            term = total = 1 / a
            n = a
            while term > total * 1e-15:
                n += 1
                term *= y / n
                total += term
            return max(0.0, 1 - front * total)
        b = y + 1 - a
        c, d = 1e300, 1 / b
        h = d
        for i in range(1, 10_000):
            an = -i * (i - a)
            b += 2
            d = 1 / (an * d + b)
            c = b + an / c
            h *= d * c
            if abs(d * c - 1) < 1e-15:
                break
        return front * h

    return pd.Series([p(*v) for v in zip(x, k)], dtype="float64")


def fisher(table: DataFrame) -> DataFrame:
    """table (feature, a, b, c, d) with odds = ad / bc, effect = its logarithm (null unless positive and finite) and p."""
    odds = F.try_divide(F.col("a") * F.col("d").cast("double"), F.when(F.col("b") * F.col("c") != 0, F.col("b") * F.col("c")))
    return table.select("feature", odds.alias("odds"), F.when(odds > 0, F.log(odds)).alias("effect"), fisher_p("a", "b", "c", "d").alias("p"))


def chi_square(df: DataFrame, feature: str = "feature", value: str = "value", outcome: str = "outcome") -> DataFrame:
    """(feature, chi2, dof, v): statistic of value by outcome, degrees of freedom and Cramer's V; null where either has one level."""
    cells = df.where(F.col(value).isNotNull() & F.col(outcome).isNotNull()).groupBy(feature, value, outcome).agg(F.count(F.lit(1)).alias("o"))
    total = cells.groupBy(feature).agg(F.sum("o").alias("n"), F.countDistinct(value).alias("r"), F.countDistinct(outcome).alias("c"))
    rows = cells.groupBy(feature, value).agg(F.sum("o").alias("rn"))
    columns = cells.groupBy(feature, outcome).agg(F.sum("o").alias("cn"))
    grid = rows.join(columns, feature).join(cells, [feature, value, outcome], "left").join(total, feature)
    e = F.col("rn") * F.col("cn").cast("double") / F.col("n")
    stat = grid.groupBy(feature, "n", "r", "c").agg(F.sum((F.coalesce("o", F.lit(0)) - e) * (F.coalesce("o", F.lit(0)) - e) / e).alias("x"))
    fine = (F.col("r") > 1) & (F.col("c") > 1)
    return stat.select(feature, F.when(fine, F.col("x")).alias("chi2"), ((F.col("r") - 1) * (F.col("c") - 1)).cast("int").alias("dof"), F.when(fine, F.sqrt(F.col("x") / (F.col("n") * (F.least("r", "c") - 1)))).alias("v"))


def benjamini_hochberg(df: DataFrame, p: str = "p", parts: int = 64) -> DataFrame:
    """df with q: the least p * m / rank from its rank on, at most 1; null p stay null and don't count.

    Equal p have one q, that of the last of them, so ranks are running counts over distinct p and no task holds them all.
    """
    known = df.where(F.col(p).isNotNull())
    groups = known.groupBy(F.col(p).cast("double").alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    cuts = edges(groups, "_p", parts)
    ranked = running(groups, "_p", {"_n": "_r"}, cuts=cuts).crossJoin(F.broadcast(known.agg(F.count(F.lit(1)).alias("_m"))))
    least = running(ranked.withColumn("_s", F.col("_p") * F.col("_m") / F.col("_r")), "_p", {"_s": "_q"}, descending=True, cuts=cuts, least=True)
    q = least.select("_p", F.greatest(F.lit(0.0), F.least(F.lit(1.0), "_q")).alias("q"))
    done = known.withColumn("_p", F.col(p).cast("double")).join(q, "_p").drop("_p")
    return done.unionByName(df.where(F.col(p).isNull()).withColumn("q", F.lit(None).cast("double")))


def confusion(df: DataFrame, y: str = "y", p: str = "p", by: tuple[str, ...] = (), threshold: float = 0.5) -> DataFrame:
    """Eight metrics at a threshold: sensitivity, precision and F1 are 0 where undefined, specificity, NPV and MCC null or 0 as their rule is."""
    hit = F.col(p) >= threshold
    c = df.groupBy(*by).agg(
        F.count_if(hit & (F.col(y) == 1)).cast("double").alias("tp"), F.count_if(hit & (F.col(y) == 0)).cast("double").alias("fp"),
        F.count_if(~hit & (F.col(y) == 0)).cast("double").alias("tn"), F.count_if(~hit & (F.col(y) == 1)).cast("double").alias("fn"),
        F.avg((F.col(p) - F.col(y)) * (F.col(p) - F.col(y))).alias("brier"),
    )
    tp, fp, tn, fn = (F.col(x) for x in ("tp", "fp", "tn", "fn"))
    ratio = lambda a, b: F.try_divide(a, F.when(b != 0, b))
    zero = lambda x: F.coalesce(x, F.lit(0.0))
    sens, spec = zero(ratio(tp, tp + fn)), ratio(tn, tn + fp)
    mcc = zero(ratio(tp * tn - fp * fn, F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))))
    return c.select(
        *by, ((sens + spec) / 2).alias("balanced_accuracy"), sens.alias("sensitivity"), spec.alias("specificity"), zero(ratio(tp, tp + fp)).alias("precision"),
        ratio(tn, tn + fn).alias("npv"), zero(ratio(2 * tp, 2 * tp + fp + fn)).alias("f1"), mcc.alias("mcc"), "brier",
    )


def roc_auc(df: DataFrame, y: str = "y", p: str = "p", by: tuple[str, ...] = (), parts: int = 64) -> DataFrame:
    """(by, auc): ties count half; null with one class only."""
    t = tied(df, p, y, by, parts)
    below = F.col("up_n") - F.col("n") - (F.col("up_pos") - F.col("pos"))
    sums = t.groupBy(*by).agg(F.sum("n").alias("n"), F.sum("pos").alias("n1"), F.sum((below + (F.col("n") - F.col("pos")) / 2.0) * F.col("pos")).alias("wins"))
    return sums.select(*by, F.try_divide(F.col("wins"), F.when((F.col("n1") > 0) & (F.col("n1") < F.col("n")), (F.col("n1") * (F.col("n") - F.col("n1"))).cast("double"))).alias("auc"))


def average_precision(df: DataFrame, y: str = "y", p: str = "p", by: tuple[str, ...] = (), parts: int = 64) -> DataFrame:
    """(by, ap): the sum of precision at each distinct score by the recall that it adds."""
    groups = df.groupBy(*by, F.col(p).cast("double").alias("value")).agg(F.count(F.lit(1)).alias("n"), F.sum(y).alias("pos"))
    t = running(groups, "value", {"n": "down_n", "pos": "down_pos"}, by, descending=True, parts=parts)
    sums = t.groupBy(*by).agg(F.sum(F.col("pos") * F.col("down_pos") / F.col("down_n").cast("double")).alias("s"), F.sum("pos").alias("n1"))
    return sums.select(*by, F.try_divide(F.col("s"), F.when(F.col("n1") > 0, F.col("n1").cast("double"))).alias("ap"))


def roc_points(df: DataFrame, y: str = "y", p: str = "p", parts: int = 64) -> DataFrame:
    """(threshold, fpr, tpr, precision) at each distinct score, from the highest down."""
    groups = df.groupBy(F.col(p).cast("double").alias("threshold")).agg(F.count(F.lit(1)).alias("n"), F.sum(y).alias("pos"))
    t = running(groups, "threshold", {"n": "dn", "pos": "dp"}, descending=True, parts=parts)
    total = groups.agg(F.sum("n").alias("tn"), F.sum("pos").alias("tp"))
    t = t.crossJoin(F.broadcast(total))
    return t.select("threshold", F.try_divide(F.col("dn") - F.col("dp"), F.when(F.col("tn") != F.col("tp"), F.col("tn") - F.col("tp"))).alias("fpr"), F.try_divide(F.col("dp"), F.when(F.col("tp") != 0, F.col("tp"))).alias("tpr"), (F.col("dp") / F.col("dn")).alias("precision"))


def calibration(df: DataFrame, y: str = "y", p: str = "p", bins: int | None = None) -> DataFrame:
    """(bin, n, mean_p, observed) between the exact quantiles of p; a value on an edge is in the bin below, the least one in bin 1.

    bins: by default a fifth of the rows, at least 2 and at most 10. Runs a job for their number and one for the quantiles.
    """
    bins = bins or min(10, max(2, df.count() // 5))
    cuts = quantiles(df, p, [i / bins for i in range(1, bins)], name="_e").select("_e")
    b = (F.size(F.filter("_e", lambda e: e < F.col(p))) + 1).alias("bin")
    return df.crossJoin(F.broadcast(cuts)).groupBy(b).agg(F.count(F.lit(1)).alias("n"), F.avg(p).alias("mean_p"), F.avg(F.col(y).cast("double")).alias("observed"))


def quartiles(df: DataFrame, value: str = "value", by: tuple[str, ...] = ("feature",)) -> DataFrame:
    """(by, n, median, q25, q75) of the values that are not null; n is 0 and the others null for a group without any."""
    q = quantiles(df, value, [0.25, 0.5, 0.75], by, name="_q").withColumnRenamed("count", "_n")
    q = df.select(*by).distinct().join(q, list(by), "left")
    return q.select(*by, F.coalesce("_n", F.lit(0)).alias("n"), F.col("_q")[1].alias("median"), F.col("_q")[0].alias("q25"), F.col("_q")[2].alias("q75"))


def intervals(draws: DataFrame, value: str, by: tuple[str, ...] = ()) -> DataFrame:
    """(by, low, high): the 2.5 and 97.5 percentiles of finite values."""
    fine = draws.where(F.col(value).isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf")))
    return fine.groupBy(*by).agg(F.percentile(value, F.array(F.lit(0.025), F.lit(0.975))).alias("_q")).select(*by, F.col("_q")[0].alias("low"), F.col("_q")[1].alias("high"))


METRICS = ("roc_auc", "average_precision", "balanced_accuracy", "sensitivity", "specificity", "precision", "npv", "f1", "mcc", "brier")


def metrics(df: DataFrame, y: str = "y", p: str = "p", by: tuple[str, ...] = (), weight: str | None = None, threshold: float = 0.5, parts: int = 1) -> DataFrame:
    """(by, METRICS) in one pass over rows that count ``weight`` times: undefined sensitivity, precision, F1 and MCC are 0, the others null.

    Rows are summed up by distinct score first, so that draws of a bootstrap cost as much as there are scores.
    """
    w = F.col(weight) if weight else F.lit(1)
    known = df.where(F.col(p).isNotNull() & F.col(y).isin(0, 1))
    g = known.groupBy(*by, F.col(p).cast("double").alias("_v")).agg(F.sum(w).alias("_n"), F.sum(w * F.col(y)).alias("_pos"))
    g = running(g, "_v", {"_n": "_un", "_pos": "_up"}, by, parts=parts)
    total = g.groupBy(*by).agg(F.sum("_n").alias("_tn"), F.sum("_pos").alias("_tp"))
    g = g.join(total, list(by)) if by else g.crossJoin(F.broadcast(total))
    n, pos, neg = (x.cast("double") for x in (F.col("_n"), F.col("_pos"), F.col("_n") - F.col("_pos")))
    lower = (F.col("_un") - F.col("_up")).cast("double") - neg
    above, above_pos = F.col("_tn") - F.col("_un") + F.col("_n"), F.col("_tp") - F.col("_up") + F.col("_pos")
    hit = F.col("_v") >= threshold
    c = g.groupBy(*by).agg(
        F.first("_tn").cast("double").alias("n"), F.first("_tp").cast("double").alias("n1"), F.sum(pos * (lower + neg / 2)).alias("wins"), F.sum(pos * above_pos / above).alias("ap"),
        F.sum(F.when(hit, pos).otherwise(0.0)).alias("tp"), F.sum(F.when(hit, neg).otherwise(0.0)).alias("fp"), F.sum(pos * (F.col("_v") - 1) * (F.col("_v") - 1) + neg * F.col("_v") * F.col("_v")).alias("error"),
    )
    c = c.withColumn("fn", F.col("n1") - F.col("tp")).withColumn("tn", F.col("n") - F.col("n1") - F.col("fp"))
    tp, fp, tn, fn, n1, n = (F.col(x) for x in ("tp", "fp", "tn", "fn", "n1", "n"))
    ratio = lambda a, b: F.try_divide(a, F.when(b != 0, b))
    zero = lambda x: F.coalesce(x, F.lit(0.0))
    sens, spec = zero(ratio(tp, tp + fn)), ratio(tn, tn + fp)
    return c.select(
        *by, ratio(F.col("wins"), n1 * (n - n1)).alias("roc_auc"), ratio(F.col("ap"), n1).alias("average_precision"), ((sens + spec) / 2).alias("balanced_accuracy"), sens.alias("sensitivity"), spec.alias("specificity"),
        zero(ratio(tp, tp + fp)).alias("precision"), ratio(tn, tn + fn).alias("npv"), zero(ratio(2 * tp, 2 * tp + fp + fn)).alias("f1"),
        zero(ratio(tp * tn - fp * fn, F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)))).alias("mcc"), ratio(F.col("error"), n).alias("brier"),
    )


def averaged(predictions: DataFrame) -> DataFrame:
    """Out-of-fold predictions by analysis_id, feature_set and model: mean probability over repeats and the label at 0.5."""
    out = predictions.groupBy("analysis_id", "feature_set", "model").agg(F.first("y_true").alias("y"), F.avg("y_probability").alias("p"))
    return out.withColumn("y_predicted", (F.col("p") >= 0.5).cast("int"))


def paired_delta(mean: DataFrame, reference: str, candidate: str, parts: int = 64) -> DataFrame:
    """(model, metric, delta) of two feature sets over the ids that both have: candidate less reference for AUC, reference less candidate for the Brier score."""
    wide = mean.where(F.col("feature_set").isin(reference, candidate)).groupBy("analysis_id", "model", "y").pivot("feature_set", [reference, candidate]).agg(F.first("p"))
    wide = wide.where(F.col(reference).isNotNull() & F.col(candidate).isNotNull())
    a, b = (roc_auc(wide, "y", c, ("model",), parts).withColumnRenamed("auc", n) for c, n in ((reference, "ra"), (candidate, "ca")))
    auc = a.join(b, "model").select("model", F.lit("roc_auc").alias("metric"), (F.col("ca") - F.col("ra")).alias("delta"))
    error = lambda c: F.avg((F.col(c) - F.col("y")) * (F.col(c) - F.col("y")))
    brier = wide.groupBy("model").agg((error(reference) - error(candidate)).alias("delta")).select("model", F.lit("brier").alias("metric"), "delta")
    return auc.unionAll(brier)


def univariate(long: DataFrame, least_numeric: float = 0.8) -> DataFrame:
    """(feature, kind, statistic, effect, p, q) of long (feature, value as text, outcome): numbers where at least that share of values parse, else categories.

    Numbers: Mann-Whitney U, by its exact distribution where one group has at most 8 values and none repeats (and n0 * n1 is at most COUNTED). Categories: Fisher for two levels, chi-squared for more. One level or
    one outcome: kind not_testable and nulls. q is over all features.
    """
    text = F.when(F.trim("value") != "", F.trim("value"))
    rows = long.select("feature", text.alias("value"), text.try_cast("double").alias("number"), "outcome").where(F.col("value").isNotNull() & F.col("outcome").isNotNull())
    kinds = rows.groupBy("feature").agg((F.count("number") / F.count(F.lit(1)) >= least_numeric).alias("numeric"), F.countDistinct("value").alias("levels"), F.countDistinct("outcome").alias("sides"))
    kinds = kinds.withColumn("kind", F.when((F.col("sides") < 2) | (~F.col("numeric") & (F.col("levels") < 2)), "not_testable").when(F.col("numeric"), "mann_whitney").when(F.col("levels") == 2, "fisher").otherwise("chi_square"))
    rows = rows.join(kinds.select("feature", "kind"), "feature")
    numbers = rows.where("kind = 'mann_whitney' and number is not null")
    repeated = numbers.groupBy("feature", "number").count().groupBy("feature").agg((F.max("count") > 1).alias("ties"))
    u = mann_whitney(numbers.withColumn("value", F.col("number"))).join(repeated, "feature")
    exact = F.when(~F.col("ties") & (F.least("n0", "n1") <= 8), exact_u("u", "n0", "n1"))
    u = u.select("feature", F.col("u").alias("statistic"), "effect", F.coalesce(exact, two_sided("z")).alias("p"))
    pair = rows.where("kind = 'fisher'")
    low = pair.groupBy("feature").agg(F.min("value").alias("_low"))
    cell = lambda level, y: F.count_if((F.col("value") == F.col("_low") if level else F.col("value") != F.col("_low")) & (F.col("outcome") == y))
    table = pair.join(low, "feature").groupBy("feature").agg(cell(True, 1).alias("a"), cell(True, 0).alias("b"), cell(False, 1).alias("c"), cell(False, 0).alias("d"))
    f = fisher(table).select("feature", F.col("odds").alias("statistic"), "effect", "p")
    x = chi_square(rows.where("kind = 'chi_square'")).select("feature", F.col("chi2").alias("statistic"), F.col("v").alias("effect"), chi2_p("chi2", "dof").alias("p"))
    tested = kinds.select("feature", "kind").join(u.unionAll(f).unionAll(x), "feature", "left")
    return benjamini_hochberg(tested, parts=1)
