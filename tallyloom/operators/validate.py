"""Constraints as tables of violations; nothing passes silently."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sample ids that name something else in results.
RESERVED_IDS = ["aggregated_celltypes", "workflow_metadata", "class_id", "cell_type", "slides.tsv", "slides.json", "workflow_aggregation_manifest.csv", "workflow_bin"]


class ConstraintError(ValueError):
    """Raised by enforce(); the message names the first rule that is broken and some of the keys."""


@dataclass(frozen=True)
class Rule:
    """A row breaks a rule where ``broken`` is true; null is no violation."""

    code: str
    broken: Column


def violations(df: DataFrame, key: str, rules: list[Rule]) -> DataFrame:
    """(rank, code, key) for every rule that a row breaks; rank is the rule's place in the list."""
    found = F.array(*[F.when(r.broken, F.struct(F.lit(i).alias("rank"), F.lit(r.code).alias("code"))) for i, r in enumerate(rules, 1)])
    return df.select(F.col(key).cast("string").alias("key"), F.explode(F.filter(found, lambda x: x.isNotNull())).alias("v")).select("v.rank", "v.code", "key")


def duplicates(df: DataFrame, *key: str) -> DataFrame:
    """(key columns, n) of the keys that occur more than once."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def missing(wanted: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Keys of wanted that known doesn't have."""
    return wanted.select(key).distinct().join(known.select(key), key, "left_anti")


def dependency(df: DataFrame, left: str, right: str) -> DataFrame:
    """(left, n) of the values of left that stand beside several values of right."""
    return df.groupBy(left).agg(F.countDistinct(right).alias("n")).where("n > 1")


def class_mapping(df: DataFrame, class_id: str = "class_id", class_name: str = "class_name") -> DataFrame:
    """(kind, key, n): names with several ids, and ids from 0 on with several names."""
    names = dependency(df, class_name, class_id).select(F.lit("name_has_ids").alias("kind"), F.col(class_name).cast("string").alias("key"), "n")
    ids = dependency(df.where(F.col(class_id) >= 0), class_id, class_name).select(F.lit("id_has_names").alias("kind"), F.col(class_id).cast("string").alias("key"), "n")
    return names.unionAll(ids)


def count_rules() -> list[Rule]:
    """Rules of a table of counts read as text: class_id, class_name, count."""
    whole = lambda c: F.col(c).try_cast("double").isNull() | (F.abs(F.col(c).try_cast("double")) == float("inf")) | F.isnan(F.col(c).try_cast("double")) | (F.col(c).try_cast("double") % 1 != 0)
    return [
        Rule("blank_class_name", F.coalesce(F.trim("class_name") == "", F.lit(True))),
        Rule("class_id_not_integral", whole("class_id")),
        Rule("count_not_integral", whole("count")),
        Rule("count_negative", F.col("count").try_cast("double") < 0),
        Rule("count_zero", F.col("count").try_cast("double") == 0),
    ]


def id_rules(name: str, reserved: list[str] = RESERVED_IDS) -> list[Rule]:
    return [Rule("blank_id", F.coalesce(F.trim(name) == "", F.lit(True))), Rule("reserved_id", F.lower(F.trim(name)).isin([r.lower() for r in reserved]))]


def columns(df: DataFrame, required: list[str], exact: bool = False) -> list[str]:
    """What is wrong with a table's columns; an empty list if nothing is."""
    out = [f"missing column {c}" for c in required if c not in df.columns]
    out += [f"column {c} occurs more than once" for c in sorted({c for c in df.columns if df.columns.count(c) > 1})]
    return out + ([f"unknown column {c}" for c in df.columns if c not in required] if exact else [])


def enforce(*tables: DataFrame, shown: int = 10) -> None:
    """Raises ConstraintError if any table of violations has rows; the first table, and in it the rule of lowest rank, is named.

    One job for all tables, so what they share is made once. A table of the one column problem is told as it is.
    """
    found = None
    for i, table in enumerate(tables):
        order = [c for c in ("rank", "code", "key") if c in table.columns] or table.columns
        shows = [F.coalesce(F.col(c).cast("string"), F.lit("None")) for c in table.columns]
        text = shows[0] if table.columns == ["problem"] else F.concat_ws(", ", *[F.concat(F.lit(f"{c}="), x) for c, x in zip(table.columns, shows)])
        one = table.orderBy(*order).limit(shown).select(F.lit(i).alias("table"), F.monotonically_increasing_id().alias("at"), text.alias("text"))
        found = one if found is None else found.unionAll(one)
    rows = sorted(found.collect()) if found is not None else []  # shown rows of each table at most
    if rows:
        raise ConstraintError("; ".join(r.text for r in rows if r.table == rows[0].table))


def close(a: Column, b: Column, relative: float = 1e-9, absolute: float = 0.0) -> Column:
    return F.abs(a - b) <= F.greatest(F.lit(absolute), F.lit(relative) * F.greatest(F.abs(a), F.abs(b)))


def all_of(*tests: Column) -> Column:
    return reduce(lambda a, b: a & b, tests)
