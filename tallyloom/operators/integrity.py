"""Reconciling manifests with what is there, keyed states and resumption."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def reconcile(wanted: DataFrame, there: DataFrame, key: str = "key", fields: tuple[str, ...] = ("size", "md5")) -> DataFrame:
    """(key, status): verified, differs, pending (not there) or extra (not wanted). Fields that either side doesn't know don't differ."""
    a = wanted.select(F.col(key), F.lit(True).alias("_w"), *[F.col(f).alias(f"_w_{f}") for f in fields])
    b = there.select(F.col(key), F.lit(True).alias("_t"), *[F.col(f).alias(f"_t_{f}") for f in fields])
    differs = F.lit(False)
    for f in fields:
        differs = differs | F.coalesce(F.col(f"_w_{f}") != F.col(f"_t_{f}"), F.lit(False))
    status = F.when(F.col("_t").isNull(), "pending").when(F.col("_w").isNull(), "extra").when(differs, "differs").otherwise("verified")
    return a.join(b, key, "full_outer").select(key, status.alias("status"))


def two_sided_except(left: DataFrame, right: DataFrame, key: str = "key") -> DataFrame:
    """(side, key) of the keys that only one side has."""
    a, b = left.select(key).distinct(), right.select(key).distinct()
    return a.join(b, key, "left_anti").select(F.lit("missing").alias("side"), key).unionAll(b.join(a, key, "left_anti").select(F.lit("extra").alias("side"), key))


def complete_sets(rows: DataFrame, key: str, level: str, wanted: list) -> DataFrame:
    """(key, levels) of the keys that have all wanted levels; levels sorted."""
    sets = rows.where(F.col(level).isin(wanted)).groupBy(key).agg(F.array_sort(F.collect_set(level)).alias("levels"))
    return sets.where(F.size("levels") == len(wanted))


def upsert(state: DataFrame, changes: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row for each key: the last by order of state and changes together. Aggregated before it is shuffled, so a busy key is no burden."""
    both = state.unionByName(changes)
    rest = [c for c in both.columns if c not in keys]
    last = both.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    return last.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


def pending(expected: DataFrame, state: DataFrame, key: str, signature: str = "signature", valid: str = "valid") -> DataFrame:
    """Expected rows to run: those without a valid state row of the same signature."""
    done = state.where(F.col(valid)).select(F.col(key).alias("_k"), F.col(signature).alias("_s"))
    return expected.join(done, F.col(key).eqNullSafe(F.col("_k")) & F.col(signature).eqNullSafe(F.col("_s")), "left_anti")


def sampling_matches(percent, wanted_percent: float, seed, wanted_seed: int | None, grid=None, wanted_grid: int | None = None):
    """Whether a summary's sampling is the one asked for: percent within 1e-9 (null is 100), the seed where less than 100, and the same grid."""
    have = F.coalesce(percent, F.lit(100.0))
    same = F.abs(have - wanted_percent) <= 1e-9
    if wanted_percent < 100:
        same = same & seed.eqNullSafe(F.lit(wanted_seed))
    return same & (F.lit(True) if grid is None else grid.eqNullSafe(F.lit(wanted_grid)))


def matched(left: DataFrame, right: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """(keys, problem): missing_left, missing_right, or the first field that differs; rows alike on both sides are left out."""
    a = left.select(*keys, F.lit(True).alias("_l"), *[F.col(f).alias(f"_l_{f}") for f in fields])
    b = right.select(*keys, F.lit(True).alias("_r"), *[F.col(f).alias(f"_r_{f}") for f in fields])
    problem = F.when(F.col("_l").isNull(), F.lit("missing_left")).when(F.col("_r").isNull(), F.lit("missing_right"))
    for f in fields:
        problem = problem.when(~F.col(f"_l_{f}").eqNullSafe(F.col(f"_r_{f}")), F.lit(f))
    return a.join(b, keys, "full_outer").select(*keys, problem.alias("problem")).where("problem is not null")


def transfer_plan(manifest: DataFrame, remote: DataFrame, keys: list[str] | None = None, key: str = "key") -> DataFrame:
    """One row: files and bytes by status, for the manifest's rows or only those asked for."""
    wanted = manifest if keys is None else manifest.where(F.col(key).isin(keys))
    status = reconcile(wanted, remote, key).join(wanted.select(key, F.col("size").alias("_size")), key, "left")
    return status.groupBy("status").agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("_size"), F.lit(0)).alias("bytes"))


def manifest_rules() -> list:
    """Rules of a release manifest: alias, level, filename, size_bytes, sha256, md5, source_mpp."""
    from .validate import Rule

    # fixed values: the patterns of aliases, digests and file names
    return [
        Rule("bad_alias", ~F.col("alias").rlike(r"^[A-Za-z0-9][A-Za-z0-9._-]*$")),
        Rule("bad_level", ~F.col("level").isin(0, 2)),
        Rule("bad_size", ~(F.col("size_bytes") > 0)),
        Rule("bad_mpp", ~(F.col("source_mpp") > 0) | F.isnan("source_mpp") | (F.col("source_mpp") == float("inf"))),
        Rule("bad_sha256", ~F.col("sha256").rlike("^[0-9a-f]{64}$")),
        Rule("bad_md5", ~F.col("md5").rlike("^[0-9a-f]{32}$")),
        Rule("unsafe_filename", ~F.col("filename").rlike(r"^[A-Za-z0-9][A-Za-z0-9._-]*$")),
        Rule("escapes_root", F.col("filename").rlike(r"(^|/)\.\.(/|$)|^/")),
    ]
