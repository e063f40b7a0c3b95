"""Mixing sources to target weights over a time-varying curriculum.

Each source has a schedule: weights at equally spaced times of training, straight lines between them. Its integral
up to t is the share of the source's words that training has asked for by then. A source's documents stand in a
fixed random order; a document's first word is asked for at the time at which the integral, times the source's
target, reaches the words before it. Inverting the integral (a quadratic in each piece) gives that position, and
documents are range-sorted by it. What lies beyond the target is not taken; after the last document the source
starts again.

The random order is the md5 of the doc_id. Prefix sums are taken in two steps, over 4096 ranges of the hash and then
inside each, so that a hot source is many small groups; only built-in functions are used.

Targets are shares of the total by weight. A source whose share is above ``most`` times its size stops there and the
excess goes to the others by weight; the end of that is found directly: sources reach their limit in the order of
limit / weight.

Defined results: a null or blank text has size 0 and nothing is taken of it; a null source is a source of its own, the
last in order; a null doc_id is ordered as the empty string; rows with one doc_id are separate documents; equal rows
may change places; an empty table gives none; columns that the operator adds replace columns of these names in
``mixed``, which keeps all others, whatever they are called; ``copies_in_order`` keeps every column as it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.grouping import materialised

#: Weights of the sources in order, repeating, and each one's schedule, as weights at times 0, 1/2 and 1 before scaling.
WEIGHTS = (3.0, 1.0, 2.0)
SCHEDULES = ((2.0, 1.0, 0.5), (0.5, 1.0, 2.0), (1.0, 1.0, 1.0))
TOTAL = 1.5
MOST = 2.0
_WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, total: float = TOTAL, most: float = MOST) -> DataFrame:
    """source, source_size, k (place in the order of sources), target, for (source, source_size). One row per source, so one task is enough."""
    n = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    placed = sizes.withColumn("k", n).withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("k") % len(weights) + 1).cast("int")))
    by = Window.orderBy(F.col("source_size") / F.col("weight"), "k")
    whole = Window.partitionBy()
    before, since = by.rowsBetween(Window.unboundedPreceding, -1), by.rowsBetween(0, Window.unboundedFollowing)
    left = F.sum("source_size").over(whole) * total - F.coalesce(F.sum("source_size").over(before), F.lit(0)) * most
    level = placed.withColumn("level", left / F.sum("weight").over(since)).withColumn("limit", F.col("source_size") * most)
    # The level of the first source that stays below its limit holds for all that come after it.
    open_ = F.min(F.when(F.col("level") * F.col("weight") <= F.col("limit"), F.struct(F.col("limit") / F.col("weight"), "k", "level"))).over(whole)["level"]
    return level.select("source", "source_size", "k", F.least("limit", F.coalesce(open_ * F.col("weight"), F.col("limit"))).alias("target"))


def _position(share: Column, schedule: Column) -> Column:
    """The time at which the integral of a schedule (three weights) has reached ``share`` of the whole."""
    w = [schedule[i] for i in range(3)]
    half = [(w[0] + w[1]) / 4, (w[1] + w[2]) / 4]
    asked = share * (half[0] + half[1])
    second = asked > half[0]
    a = F.when(second, asked - half[0]).otherwise(asked)
    start, slope = F.when(second, w[1]).otherwise(w[0]), F.when(second, w[2] - w[1]).otherwise(w[1] - w[0]) * 2
    # start * t + slope * t^2 / 2 = a, in the form that is also right for a flat piece.
    t = F.try_divide(2 * a, start + F.sqrt(F.greatest(start * start + 2 * slope * a, F.lit(0.0))))
    return F.coalesce(F.when(second, F.lit(0.5)).otherwise(F.lit(0.0)) + F.coalesce(t, F.lit(0.0)), F.lit(0.0))


def mixed(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, schedules: tuple[tuple[float, float, float], ...] = SCHEDULES, total: float = TOTAL, most: float = MOST) -> DataFrame:
    """The documents' rows with size, source_size, target, taken (words, repeats counted), copies (whole ones), position and positions.

    The last document that a source needs is taken in part, so that ``taken`` sums up to the target; ``copies`` rounds
    each document's part to whole copies. ``position`` is the time of the first copy, between 0 and 1, and ``positions`` has
    that of each.
    """
    return _mixed(docs, weights, schedules, total, most).select(F.expr("_doc.*"), *ADDED).select(*[c for c in docs.columns if c not in ADDED], *ADDED)


#: The columns that the operator adds.
ADDED = ("size", "source_size", "target", "taken", "copies", "position", "positions")


def _mixed(docs: DataFrame, weights, schedules, total: float, most: float) -> DataFrame:
    """``mixed`` with the whole row as one column, ``_doc``, so that no name of it can clash with the operator's own."""
    text, doc_id, source = (F.col(k).cast("string") for k in ("text", "doc_id", "source"))
    slim = docs.select(F.struct(*[c for c in docs.columns if c not in ADDED]).alias("_doc"), source.alias("source"), n_words(text).alias("size"), _key(doc_id).alias("_key"))
    return _placed(slim.withColumn("_part", F.substring("_key", 1, 3)), weights, schedules, total, most)


def copies_in_order(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, schedules: tuple[tuple[float, float, float], ...] = SCHEDULES, total: float = TOTAL, most: float = MOST) -> DataFrame:
    """Each document's row as often as the mix takes it, in whole copies, all of its columns as they are; sorted by each copy's position, then doc_id."""
    text, doc_id, source = (F.col(k).cast("string") for k in ("text", "doc_id", "source"))
    slim = docs.select(F.struct("*").alias("_doc"), source.alias("source"), n_words(text).alias("size"), _key(doc_id).alias("_key")).withColumn("_part", F.substring("_key", 1, 3))
    taken = _placed(slim, weights, schedules, total, most).filter("copies > 0")
    return taken.select("_doc", F.explode(F.slice("positions", F.lit(1), F.col("copies"))).alias("_at")).orderBy("_at", "_doc.doc_id").select("_doc.*")


def _key(doc_id: Column) -> Column:
    return F.md5(F.coalesce(doc_id, F.lit("")))


def _placed(sized: DataFrame, weights, schedules, total: float, most: float) -> DataFrame:
    """The rows of (source, size, _key, _part and others) with what the mix makes of them."""
    parts = sized.groupBy("source", "_part").agg(F.sum("size").alias("part_size"))
    ahead = Window.partitionBy("source").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_ahead", F.coalesce(F.sum("part_size").over(ahead), F.lit(0)))
    sources = source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, total, most)
    parts = parts.withColumnRenamed("source", "_s").withColumnRenamed("_part", "_p").drop("part_size")
    sources = sources.withColumnRenamed("source", "_t")
    table = parts.join(sources, F.col("_s").eqNullSafe(F.col("_t"))).drop("_t")
    inside = Window.partitionBy("source", "_part").orderBy("_key", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = sized.withColumn("_within", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    placed = placed.join(table, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_part") == F.col("_p"))).drop("_s", "_p")
    at, wanted = F.col("_ahead") + F.col("_within"), F.floor(F.col("target") + 0.5)
    lap = lambda i: F.greatest(F.lit(0), F.least(F.col("size"), wanted - i * F.col("source_size") - at))
    laps = [lap(i) for i in range(int(-(-most // 1)))]
    taken = sum(laps[1:], laps[0]).cast("long")
    schedule = F.element_at(F.array(*[F.array(*map(F.lit, s)) for s in schedules]), (F.col("k") % len(schedules) + 1).cast("int"))
    return (
        placed.withColumn("taken", taken)
        .withColumn("copies", F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size") + 0.5)).otherwise(0).cast("int"))
        .withColumn("position", _position(F.when(F.col("target") > 0, at / F.col("target")), schedule))
        .withColumn("positions", F.array(*[_position(F.when(F.col("target") > 0, (at + i * F.col("source_size")) / F.col("target")), schedule) for i in range(len(laps))]))
        .drop("_key", "_part", "_within", "_ahead", "k")
    )


def op8_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    return mixed_slim(docs).orderBy("position").select("doc_id", "size", "source_size", "target", "taken", "copies", *[F.round(F.col("positions")[i], 9).alias(f"position_{i + 1}") for i in range(2)])


def mixed_slim(docs: DataFrame) -> DataFrame:
    """``mixed`` without the texts, which are read once for their sizes and not shuffled."""
    slim = docs.select("doc_id", F.col("source").cast("string").alias("source"), n_words(F.col("text").cast("string")).alias("size"))
    slim = materialised(slim, "sizes").withColumn("_key", _key(F.col("doc_id").cast("string"))).withColumn("_part", F.substring("_key", 1, 3))
    return _placed(slim, WEIGHTS, SCHEDULES, TOTAL, MOST)


OP8_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size, md5(coalesce(doc_id::VARCHAR, '')) AS key FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS k FROM d GROUP BY source
), w AS (SELECT *, [3.0, 1.0, 2.0][k % 3 + 1]::DOUBLE AS weight, source_size * 2.0::DOUBLE AS cap FROM s),
l AS (
  SELECT *, ((sum(source_size) OVER ())::DOUBLE * 1.5 - coalesce(sum(source_size) OVER (ORDER BY source_size / weight, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE * 2.0)
    / sum(weight) OVER (ORDER BY source_size / weight, k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w
), t AS (
  SELECT source, source_size, k, least(cap, coalesce((SELECT arg_min(level, cap / weight) FROM l WHERE level * weight <= cap) * weight, cap)) AS target FROM l
), p AS (
  SELECT doc_id, source, size, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS ahead FROM d
), x AS (
  SELECT *, unnest([0, 1]) AS lap FROM (
    SELECT doc_id, size, t.source_size, target, k, ahead,
      (greatest(0, least(size, floor(target + 0.5)::BIGINT - ahead)) + greatest(0, least(size, floor(target + 0.5)::BIGINT - t.source_size - ahead)))::BIGINT AS taken
    FROM p JOIN t ON p.source IS NOT DISTINCT FROM t.source
  )
), y AS (
  SELECT *, CASE WHEN target > 0 THEN (ahead + lap * source_size) / target END AS share,
    [[2.0, 1.0, 0.5], [0.5, 1.0, 2.0], [1.0, 1.0, 1.0]][k % 3 + 1]::DOUBLE[] AS sch FROM x
), z AS (SELECT *, (sch[1] + sch[2]) / 4 AS h1, share * ((sch[1] + sch[2]) / 4 + (sch[2] + sch[3]) / 4) AS asked FROM y),
q AS (
  SELECT *, asked > h1 AS late, CASE WHEN asked > h1 THEN asked - h1 ELSE asked END AS a,
    CASE WHEN asked > h1 THEN sch[2] ELSE sch[1] END AS v, CASE WHEN asked > h1 THEN sch[3] - sch[2] ELSE sch[2] - sch[1] END * 2 AS slope FROM z
), u AS (
  SELECT *, round(coalesce(CASE WHEN late THEN 0.5::DOUBLE ELSE 0::DOUBLE END + coalesce(2 * a / nullif(v + sqrt(greatest(v * v + 2 * slope * a, 0::DOUBLE)), 0), 0), 0), 9) AS position FROM q
)
SELECT doc_id, size, source_size, target, taken, (CASE WHEN size > 0 THEN floor(taken / size + 0.5) ELSE 0 END)::INTEGER AS copies,
  max(CASE WHEN lap = 0 THEN position END) AS position_1, max(CASE WHEN lap = 1 THEN position END) AS position_2
FROM u GROUP BY doc_id, size, source_size, target, taken, ahead, k
"""
