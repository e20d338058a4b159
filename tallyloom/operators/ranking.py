"""Ranks and running sums over a whole table without one task that holds it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Hex digits of a digest that number its bucket; 16**3 buckets.
DIGITS = 3


def hash_ranked(df: DataFrame, digest: Column, *ties: str, by: tuple[str, ...] = (), name: str = "rank") -> DataFrame:
    """df with 1, 2, ... in the order of a hex digest, then of ties, within each group of by.

    Leading digits of the digest are buckets of even size. A rank is a row's place in its bucket and the rows of the buckets before, of
    which there are at most 4096 a group.
    """
    keyed = df.withColumn("_digest", digest).withColumn("_bucket", F.substring("_digest", 1, DIGITS))
    sizes = keyed.groupBy(*by, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy(*by).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    sizes = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    place = F.row_number().over(W.partitionBy(*by, "_bucket").orderBy("_digest", *ties))
    on = [*by, "_bucket"]
    same = None
    sizes = sizes.select(*[F.col(c).alias(f"_s{i}") for i, c in enumerate(on)], "_before")
    for i, c in enumerate(on):
        test = F.col(c).eqNullSafe(F.col(f"_s{i}"))
        same = test if same is None else same & test
    placed = keyed.withColumn("_place", place).join(sizes, same).withColumn(name, (F.col("_place") + F.col("_before")).cast("bigint"))
    return placed.drop("_digest", "_bucket", "_place", "_before", *[f"_s{i}" for i in range(len(on))])


def ordered(df: DataFrame, order: list[Column], name: str = "rank", parts: int = 64) -> DataFrame:
    """df with 1, 2, ... in an order of columns, without one task that holds all rows.

    The keys are cut into parts at those of a bounded sample (its size decides how even the parts are, nothing else); a rank is a row's place in its part and
    the rows of the parts before, of which there are at most ``parts``. Rows alike in all of order get any of their ranks.
    """
    key = F.struct(*[c.alias(f"k{i}") for i, c in enumerate(order)])
    each = 20
    sample = df.select(key.alias("_key")).orderBy(F.xxhash64("_key"), "_key").limit(parts * each)
    cuts = sample.agg(F.filter(F.sort_array(F.collect_set("_key")), lambda _, i: i % each == each - 1).alias("_cuts"))
    keyed = df.withColumn("_key", key).crossJoin(F.broadcast(cuts)).withColumn("_part", F.size(F.filter("_cuts", lambda c: c < F.col("_key")))).drop("_cuts")
    sizes = keyed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)  # of one row a part
    sizes = F.broadcast(sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")))
    place = F.row_number().over(W.partitionBy("_part").orderBy("_key"))
    return keyed.withColumn("_place", place).join(sizes, "_part").withColumn(name, (F.col("_place") + F.col("_before")).cast("bigint")).drop("_part", "_key", "_place", "_before")


def quantiles(df: DataFrame, value: str, shares: list[float], by: tuple[str, ...] = (), parts: int = 64, name: str = "quantiles") -> DataFrame:
    """(by, count, quantiles array<double>): exact quantiles, interpolated between neighbours, of values that are not null; null elements without values.

    Values are counted first, so a value that a third of all rows share is one row, and running counts in parts place each quantile: no task holds all values.
    """
    known = df.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    total = known.groupBy(*by).agg(F.sum("_n").alias("count"))
    ran = running(known, "_v", {"_n": "_up"}, by, parts=parts)
    ran = ran.join(total, list(by)) if by else ran.crossJoin(F.broadcast(total))
    at = [(F.col("count") - 1) * F.lit(float(q)) for q in shares]
    low = [F.min(F.when(F.col("_up") > F.floor(a), F.col("_v"))).alias(f"_l{i}") for i, a in enumerate(at)]
    high = [F.min(F.when(F.col("_up") > F.ceil(a), F.col("_v"))).alias(f"_h{i}") for i, a in enumerate(at)]
    found = ran.groupBy(*by).agg(F.first("count").alias("count"), *low, *high)
    return found.select(*by, "count", F.array(*[F.col(f"_l{i}") + (F.col(f"_h{i}") - F.col(f"_l{i}")) * (a - F.floor(a)) for i, a in enumerate(at)]).alias(name))


def edges(df: DataFrame, order: str, parts: int) -> list[float]:
    """Approximate quantiles that cut the values of order into parts. Runs a job unless there is one part."""
    return sorted(set(df.approxQuantile(order, [i / parts for i in range(1, parts)], 0.001))) if parts > 1 else []


def running(df: DataFrame, order: str, sums: dict[str, str], by: tuple[str, ...] = (), descending: bool = False, parts: int = 64, cuts: list[float] | None = None, least: bool = False) -> DataFrame:
    """df, one row for each value of order in a group, with running sums up to and with each row: {column: name of its running sum}; minima instead if least.

    The values are cut at approximate quantiles (or at cuts) into parts; each part is summed up alone and the parts' totals, at most ``parts`` a group,
    are added. Runs one job for the quantiles.
    """
    cuts = edges(df, order, parts) if cuts is None else cuts
    part = F.lit(0)
    if cuts:
        part = F.size(F.filter(F.array(*[F.lit(e) for e in cuts]), lambda e: e < F.col(order)))
    fold = F.min if least else F.sum
    keyed = df.withColumn("_part", -part if descending else part)
    key = F.desc(order) if descending else F.asc(order)
    totals = keyed.groupBy(*by, "_part").agg(*[fold(c).alias(f"_t_{c}") for c in sums])
    before = W.partitionBy(*by).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    totals = totals.select(*by, "_part", *[fold(f"_t_{c}").over(before).alias(f"_b_{c}") for c in sums])
    inside = W.partitionBy(*by, "_part").orderBy(key).rowsBetween(W.unboundedPreceding, 0)
    out = keyed.select("*", *[fold(c).over(inside).alias(f"_i_{c}") for c in sums]).join(totals, [*by, "_part"])
    both = lambda c: F.least(f"_i_{c}", f"_b_{c}") if least else F.col(f"_i_{c}") + F.coalesce(f"_b_{c}", F.lit(0))
    return out.select(*df.columns, *[both(c).alias(name) for c, name in sums.items()])
