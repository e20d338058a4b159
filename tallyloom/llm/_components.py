"""Connected components of a link table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import discard, stored


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node with a link to another one; root is the smallest node that it reaches.

    Each round keeps at most one row for each link, joins on a node with its smallest neighbour (one row a node, dealt out anew
    before the join, so that Spark can split a hub's rows) and is written to the shared folder. Null ends and loops are ignored; no links give no rows.
    """
    x, y = F.col(a), F.col(b)
    edges = stored(links.where(x != y).select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).distinct(), "links")
    state, parts = _state(edges), int(links.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    while state[0]:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")).repartition(parts)
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m")).repartition(parts)
        moved = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        before, edges = edges, stored(moved.unionAll(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        discard(before)
        if (now := _state(edges)) == state:
            break
        state = now
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionAll(roots.select(F.col("root").alias("node"), "root").distinct())
