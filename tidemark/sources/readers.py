"""Scans: tables as text, keyed records, JSON lines, event JSON, binary assets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.clean import clean_text, first_column

ID_NAMES = ("event_id", "DisNo.", "emdat_disaster_id", "disaster_id", "id")


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, in any store that Spark reads."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def text_table(spark: SparkSession, path: str, required: bool = True) -> DataFrame | None:
    """A CSV file with all columns as text. A file that isn't there is an error, or None where it isn't required."""
    if not exists(spark, path):
        if required:
            raise FileNotFoundError(path)
        return None
    df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("encoding", "UTF-8").csv(path)
    return df.toDF(*[c.lstrip("﻿") for c in df.columns])


def typed_table(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """A CSV file under a given schema; types are never guessed."""
    return spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"').csv(path)


def table(spark: SparkSession, path: str, schema: str | T.StructType | None = None) -> DataFrame:
    """A table by its suffix: Parquet, ORC, JSON lines, Excel (through pandas, where an engine is installed), else CSV."""
    low = path.lower()
    if not exists(spark, path):
        raise FileNotFoundError(path)
    if low.endswith(".parquet"):
        return spark.read.parquet(path)
    if low.endswith(".orc"):
        return spark.read.orc(path)
    if low.endswith((".jsonl", ".ndjson")):
        return json_lines(spark, path, schema or "event_id string", strict=True)
    if low.endswith((".xlsx", ".xls")):
        import pandas as pd  # a sheet is bounded (about a million rows) and read by the driver

        frame = pd.read_excel(path, dtype=object).astype("string")
        return spark.createDataFrame(frame.where(frame.notna(), None), ", ".join(f"`{c}` string" for c in frame.columns))
    return typed_table(spark, path, schema) if schema else text_table(spark, path)


def json_lines(spark: SparkSession, path: str, schema: str | T.StructType, strict: bool = False) -> DataFrame:
    """JSON lines; bad ones are an error if strict, else they are dropped. Blank lines never count."""
    return spark.read.schema(schema).option("mode", "FAILFAST" if strict else "DROPMALFORMED").json(path)


def unique_records(df: DataFrame, key: str) -> DataFrame:
    """The rows, after a check that every id is there and none twice."""
    bad = df.groupBy(clean_text(key).alias("k")).agg(F.count(F.lit(1)).alias("n")).filter("k = '' or n > 1").limit(5).collect()
    if bad:
        raise ValueError("missing or repeated ids: " + ", ".join(repr(b["k"]) for b in bad))
    return df


def id_column(df: DataFrame, names: Sequence[str] = ID_NAMES) -> str:
    found = first_column(df, names)
    if found is None:
        raise ValueError("no id column among " + ", ".join(names))
    return found


def event_documents(spark: SparkSession, path: str) -> DataFrame:
    """event_id, record (JSON text), place: from files that hold one object by id, or a list of objects.

    Objects with repeated keys and texts that aren't JSON are errors.
    """
    whole = spark.read.text(path, wholetext=True).select(F.regexp_replace("value", "^﻿", "").alias("value"))
    parsed = whole.withColumn("ok", F.try_parse_json("value").isNotNull())
    checked = parsed.withColumn("value", F.when(F.col("ok"), F.col("value")).otherwise(F.raise_error(F.lit("not JSON, or repeated keys")).cast("string")))
    listed = F.ltrim("value").startswith("[")
    by_key = checked.filter(~listed).select(F.explode(F.from_json("value", "map<string,string>")).alias("event_id", "record")).withColumn("place", F.lit(None).cast("int"))
    in_list = checked.filter(listed).select(F.posexplode(F.from_json("value", "array<string>")).alias("place", "record"))
    names = [F.get_json_object("record", f"$['{n}']") for n in ID_NAMES]
    in_list = in_list.select(F.coalesce(*names, F.col("place").cast("string")).alias("event_id"), "record", "place")
    return by_key.select("event_id", "record", "place").unionByName(in_list)


def json_ok(c: str):
    """Whether a text is JSON without repeated keys."""
    return F.try_parse_json(c).isNotNull()


def files(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """path, length and content of files below a folder."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)


def image_kind(content: str = "content"):
    """TIFF, BigTIFF or PNG by the first bytes; null for others or empty files."""
    head = F.hex(F.substring(content, 1, 8))
    return F.when(head.startswith("49492A00") | head.startswith("4D4D002A") | head.startswith("49492B00") | head.startswith("4D4D002B"), "tiff").when(head == "89504E470D0A1A0A", "png")


def features(spark: SparkSession, path: str, pattern: str = "*.{json,geojson}") -> DataFrame:
    """file, properties (map) and geometry (JSON text) of GeoJSON features."""
    whole = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(path, wholetext=True)
    each = whole.select(F.input_file_name().alias("file"), F.explode(F.from_json(F.get_json_object(F.regexp_replace("value", "^﻿", ""), "$.features"), "array<string>")).alias("f"))
    return each.select("file", F.from_json(F.get_json_object("f", "$.properties"), "map<string,string>").alias("properties"), F.get_json_object("f", "$.geometry").alias("geometry"))


def keyed_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table, or an empty one of the schema where there is none yet."""
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)
