"""Sinks: text tables, JSON documents, and tables whose new version is published by one rename."""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.StringType())
def _significant(x: pd.Series) -> pd.Series:
    return x.map(lambda v: None if pd.isna(v) else f"{v:.10g}")


def significant(column: Column) -> Column:
    """A double as text with up to ten significant digits and no trailing zeros; for sinks only."""
    return _significant(column.cast("double"))


def csv_single(df: DataFrame, path: str, order: list[Column] | None = None, sep: str = ",", gzip: bool = False) -> None:
    """A small table as one delimited file with a header, in order."""
    df = df.orderBy(*order) if order else df
    df.coalesce(1).write.mode("overwrite").option("header", True).option("sep", sep).option("compression", "gzip" if gzip else "none").csv(path)


def json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def json_document(df: DataFrame, path: str, name: str, order: list[str]) -> None:
    """A small table as one JSON object {name: [rows in order]}."""
    rows = F.transform(F.array_sort(F.collect_list(F.struct(F.struct(*order).alias("k"), F.struct(*df.columns).alias("v")))), lambda r: r.v)
    df.agg(rows.alias(name)).select(F.to_json(F.struct(name)).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def shared_folder(spark: SparkSession) -> str:
    """A folder of this application that all executors share: below spark.checkpoint.dir; only a local session may go without that setting."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        folder = "/tmp/checkpoints"
    return f"{folder.rstrip('/')}/{spark.sparkContext.applicationId}/tables"


def stored(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder, read back: what follows starts from files that outlive executors. Runs a job."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def replace_file(spark: SparkSession, path: str, text: str) -> None:
    """Puts a small text file in place of another by one rename that overwrites: readers see the old one or the new one."""
    jvm, target, fs = _hadoop(spark, path)
    beside = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex[:8]}")
    out = fs.create(beside, True)
    out.write(bytearray(text.encode()))
    out.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.makeQualified(target).toUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(fs.makeQualified(beside), fs.makeQualified(target), how)


def _pointed(spark: SparkSession, path: str) -> str | None:
    """The version that the file ``CURRENT`` below path names, or None before the first."""
    jvm, _, fs = _hadoop(spark, path)
    return spark.read.text(f"{path}/CURRENT").first()[0] if fs.exists(jvm.org.apache.hadoop.fs.Path(f"{path}/CURRENT")) else None


def _publish(spark: SparkSession, path: str, version: str) -> None:
    """Makes a version current by one rename and deletes all others but the one before, so that running readers may finish."""
    before = _pointed(spark, path)
    replace_file(spark, f"{path}/CURRENT", version)
    _, target, fs = _hadoop(spark, path)
    for status in fs.listStatus(target):
        name = status.getPath().getName()
        if name.startswith("v-") and name not in (version, before):
            fs.delete(status.getPath(), True)


def staged(df: DataFrame, path: str, kind: str = "parquet") -> None:
    """Writes df as a new version below path, then makes it the current one by replacing the file ``CURRENT`` in one rename.

    Readers by current() see the version before or this one, also when the write fails. Older versions but the one before are deleted, so that running readers may finish.
    """
    version = f"v-{uuid.uuid4().hex[:12]}"
    df.write.format(kind).save(f"{path}/{version}")
    _publish(df.sparkSession, path, version)


def current(spark: SparkSession, path: str, kind: str = "parquet") -> DataFrame:
    """The version of a staged() table that is current now."""
    return spark.read.format(kind).load(f"{path}/{_pointed(spark, path)}")


def staged_set(tables: dict[str, DataFrame], path: str, kind: str = "parquet") -> None:
    """Writes all tables of a run as one version below path, then makes them current together by replacing one file.

    Names are letters, digits and underscores. If any table fails, what was written of the version is deleted, the error is raised and the old set stays. Versions but the
    last two are deleted. One writer a path at a time.
    """
    if not tables:
        raise ValueError("a set needs tables")
    if wrong := [n for n in tables if not (n.isidentifier() and n.isascii()) or n.startswith("_")]:  # Spark takes files with a leading underscore for hidden
        raise ValueError(f"not names of tables: {', '.join(sorted(wrong))}")
    spark = next(iter(tables.values())).sparkSession
    version = f"v-{uuid.uuid4().hex[:12]}"
    try:
        for name, df in tables.items():
            df.write.format(kind).save(f"{path}/{version}/{name}")
    except BaseException:
        _, half, fs = _hadoop(spark, f"{path}/{version}")
        fs.delete(half, True)
        raise
    _publish(spark, path, version)


def current_set(spark: SparkSession, path: str, kind: str = "parquet") -> dict[str, DataFrame]:
    """The tables of the version that is current now, by name: the pointer is read once, so all are of one run. FileNotFoundError before the first run."""
    version = _pointed(spark, path)
    if version is None:
        raise FileNotFoundError(f"no set of tables below {path}")
    _, folder, fs = _hadoop(spark, f"{path}/{version}")
    names = sorted(s.getPath().getName() for s in fs.listStatus(folder))
    return {n: spark.read.format(kind).load(f"{path}/{version}/{n}") for n in names}


def checksum_lines(df: DataFrame, digest: str = "sha256", path: str = "path") -> DataFrame:
    """(value) lines of a checksum file: digest, two spaces, path."""
    return df.orderBy(path).select(F.concat_ws("  ", digest, path).alias("value"))
