"""Sinks: tables, JSON with public missing values, resumable upserts, verified copies, inventories."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.clean import scalar_text
from tidemark.sources.readers import exists


def csv(df: DataFrame, path: str, order: Sequence[str] = (), one_file: bool = False) -> None:
    """Arrays and structs become text; a report may be one ordered file."""
    flat = df.select(*[scalar_text(f"`{f.name}`", f.dataType.simpleString()).alias(f.name) if not isinstance(f.dataType, T.AtomicType) else F.col(f"`{f.name}`") for f in df.schema])
    flat = flat.orderBy(*order) if order else flat
    (flat.coalesce(1) if one_file else flat).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def json_lines(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def public_records(df: DataFrame, key: str) -> DataFrame:
    """key, record: each row as public JSON. Types stay as they are until here."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    text = F.to_json(row, {"ignoreNullFields": "false"})
    return df.select(F.col(key), F.regexp_replace(text, r'(?<=[:\[,])null(?=[,}\]])', '"none"').alias("record"))


def append_checked(df: DataFrame, path: str, archive: str) -> None:
    """Appends rows; a table of other columns is first moved aside."""
    spark = df.sparkSession
    if exists(spark, path) and spark.read.parquet(path).columns != df.columns:
        p = lambda x: spark._jvm.org.apache.hadoop.fs.Path(x)
        p(path).getFileSystem(spark._jsc.hadoopConfiguration()).rename(p(path), p(archive))
    df.write.mode("append").parquet(path)


def upsert(df: DataFrame, path: str, key: str, version: int) -> str:
    """The old table's rows whose keys aren't new, and the new rows, as the next version; returns its path.

    Versions are written beside each other and never in place, so a job that dies leaves the last one whole.
    """
    spark, last, now = df.sparkSession, f"{path}/v{version - 1}", f"{path}/v{version}"
    if version > 1 and exists(spark, last):
        df = spark.read.parquet(last).join(df.select(key).distinct(), key, "left_anti").unionByName(df)
    df.write.mode("overwrite").parquet(now)
    return now


def remaining(events: DataFrame, done: DataFrame, key: str, statuses: Sequence[str] = ()) -> DataFrame:
    """Events without a finished row; statuses say what counts as finished, all if none are given."""
    done = done.filter(F.col("status").isin(*statuses)) if statuses else done
    return events.join(done.select(key).distinct(), key, "left_anti")


def inventory(files: DataFrame) -> DataFrame:
    """path, length and SHA-256 of files."""
    return files.select("path", "length", F.sha2("content", 256).alias("sha256"))


def changed(before: DataFrame, after: DataFrame) -> DataFrame:
    """Files that are new, gone or different between two inventories."""
    a, b = before.select("path", F.col("sha256").alias("old")), after.select("path", F.col("sha256").alias("new"))
    return a.join(b, "path", "full").filter(~F.col("old").eqNullSafe(F.col("new"))).withColumn("change", F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed").otherwise("changed"))


def many(outputs: Mapping[str, DataFrame], root: str) -> None:
    """Several tables of one pass."""
    for name, df in outputs.items():
        df.write.mode("overwrite").parquet(f"{root}/{name}")
