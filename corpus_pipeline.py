"""A training corpus from raw documents, in five stages; each is written as Parquet and read again by the next one.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before it kept. All but the last return the
columns of documents.

Defined results: a null text counts as an empty one; the classifier scores an empty text like any other and the mix takes
nothing of a text without words; rows with a null doc_id are judged one by one and never grouped; equal rows and rows with
one doc_id each stay a row, except that the Jaccard stage keeps, of a group of near copies, the rows with its smallest id;
columns beside those of documents pass through unchanged, whatever they are called; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.decontaminate import without_contaminated
from tidemark.llm.grouping import materialised, trim_driver
from tidemark.llm.jaccard_join import jaccard_components
from tidemark.llm.mixture import copies_in_order
from tidemark.llm.quality_rules import learn, scored
from tidemark.llm.token_files import token_digest


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    rules = learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    trim_driver(spark)
    whole = docs.select(F.struct("*").alias("_doc"), "doc_id", "text")
    return scored(whole, rules).filter("predicted = 1").select("_doc.*")


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id; documents without words or id stay as they are."""
    found = jaccard_components(docs)
    gone = found.filter("n_shingles > 0 and component_id <> doc_id").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, F.col("doc_id") == F.col("_gone"), "left_anti")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    trim_driver(spark)
    return without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, in whole copies, sorted by each copy's position in the curriculum."""
    return copies_in_order(docs)


#: Bytes of words that an encoder remembers here, fewer than in ``op5``: the stages before leave the executors' heaps full.
REMEMBERED = 32_000_000


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token files of the mix in its order, each copy at its place, digested by copy.

    The mix was written range-sorted by position: its files' names and the rows in them give that order. Rows that come
    from elsewhere have none, and stand by doc_id.
    """
    trim_driver(spark)
    name = F.col("_metadata.file_name")
    try:
        placed = docs.select("doc_id", "text", F.length(name).alias("_long"), name.alias("_file"), F.col("_metadata.row_index").alias("_row"))
    except AnalysisException:
        return token_digest(docs, remembered=REMEMBERED)
    return token_digest(placed, order=("_long", "_file", "_row"), remembered=REMEMBERED)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", keep_quality),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", decontaminate),
    ("mixing sources to target weights", mix_sources),
    ("token-ID / binary output", encode),
]

#: SQL can't express the classifier, nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialised(stage(spark, docs, sf_dir), name.split()[0])
    return STAGES[-1][1](spark, docs, sf_dir)
