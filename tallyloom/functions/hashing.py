"""Digests of rows, files and documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fingerprint(*columns: Column, digits: int = 64) -> Column:
    """SHA-256 of the texts of the columns joined by NUL, null as empty; the first digits of it."""
    joined = F.concat_ws("\0", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])
    return F.substring(F.sha2(joined, 256), 1, digits)


def canonical_json(*names: str) -> Column:
    """The columns as compact JSON with sorted keys; null values are left out."""
    return F.to_json(F.struct(*[F.col(n) for n in sorted(names)]))


def rank_hash(*columns: Column, seed: int | str = 0) -> Column:
    """A seeded md5 digest by which rows are put in a random but fixed order."""
    return F.md5(F.concat_ws("|", *[c.cast("string") for c in columns], F.lit(str(seed))))


def table_fingerprint(df: DataFrame, *names: str) -> DataFrame:
    """One row: digest over all rows' digests and their number, whatever order the rows have.

    Rows' digests are summed up in 64 groups of 32 bits, so nothing is gathered in one place.
    """
    digest = fingerprint(*[F.col(n) for n in names])
    parts = [F.sum(F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("decimal(38,0)")) for i in range(8)]
    joined = F.concat_ws(":", F.count(F.lit(1)).cast("string"), *[F.coalesce(p, F.lit(0)).cast("decimal(38,0)").cast("string") for p in parts])
    return df.agg(F.count(F.lit(1)).alias("n"), F.sha2(joined, 256).alias("sha256"))
