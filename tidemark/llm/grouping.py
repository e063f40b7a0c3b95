"""Shared parts of the operators: text groups of bounded size, and the folder that all executors see."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.words import give_back

#: Mean bytes of text, and mean rows, of one group of documents.
GROUP_BYTES = 2_000_000
GROUP_ROWS = 20_000
#: Rows, and bytes, at most, that go to a Python worker together while a table is written; texts are long, and memory is small.
BATCH_ROWS, BATCH_BYTES = 2000, 4 << 20
#: Bytes where workers and executors hold much besides; a batch stands in both, in an executor outside its heap.
FEW_BYTES = 1 << 20


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new path in the folder that ``spark.checkpoint.dir`` names; that setting is made only where there is none, in local mode.

    On a cluster a folder of the driver's would be another one on each machine, so there its absence is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def small_batches(spark: SparkSession, batch_bytes: int = BATCH_BYTES) -> Iterator[None]:
    """While this lasts, plans that start send texts to Python workers in small batches. Results don't depend on it."""
    batches = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_ROWS), "spark.sql.execution.arrow.maxBytesPerBatch": str(batch_bytes)}
    before = {k: spark.conf.get(k, None) for k in batches}
    for k, v in batches.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def trim_driver(spark: SparkSession) -> bool:
    """Has the driver return the memory that it freed outside the JVM's heap, which the C library would otherwise keep; whether its JVM was told.

    Results don't depend on it; the JVM's part is left out where the JVM lacks the command (or the session has no JVM).
    """
    give_back()
    try:
        jvm = spark._jvm
        # By reflection, as the server's own class isn't open to callers; its interface is.
        invoke = next(m for m in jvm.java.lang.Class.forName("javax.management.MBeanServer").getMethods() if m.getName() == "invoke")
        said = spark.sparkContext._gateway.new_array(jvm.java.lang.Object, 4)
        said[0], said[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
        invoke.invoke(jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), said)
    except (AttributeError, Py4JError):
        return False
    return True


def materialised(df: DataFrame, name: str, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """The rows, written to the shared folder and read again, so that lineage ends there."""
    path = shared_dir(df.sparkSession, name)
    with small_batches(df.sparkSession, batch_bytes):
        df.write.parquet(path)
    trim_driver(df.sparkSession)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def group_of(column: str, groups: int) -> Column:
    return F.pmod(F.xxhash64(F.col(column)), F.lit(groups)).cast("int")


def text_groups(docs: DataFrame, group_bytes: int = GROUP_BYTES) -> tuple[DataFrame, int]:
    """(g, doc_id, text), and the number of groups, with ``g`` a hash of doc_id onto as many groups as the texts' size asks for.

    Every plan that groups this frame by ``g`` has the same exchange, which Spark then runs once.
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    total, rows = slim.agg(F.sum(F.octet_length("text")), F.count(F.lit(1))).first()
    groups = 1 + max((total or 0) // group_bytes, rows // GROUP_ROWS)
    return slim.select(group_of("doc_id", groups).alias("g"), "doc_id", "text"), groups


def in_order(group: pa.Table) -> pa.Table:
    """Rows by doc_id (null first), then text, so that each run over a group sees the same order."""
    by = [("doc_id", "ascending"), ("text", "ascending")]
    if not group["doc_id"].null_count:
        return group.sort_by(by)
    return pa.concat_tables([group.filter(pc.is_null(group["doc_id"])).sort_by(by[1:]), group.filter(pc.is_valid(group["doc_id"])).sort_by(by)])
