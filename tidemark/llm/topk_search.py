"""Exact top-k search by inner product: columnar branch-and-bound.

Vectors are turned into whole numbers and packed in cells, dimension by dimension (vertical layout). Queries are packed
in blocks. For each block and cell the scores are accumulated block by block of dimensions; after each, a candidate stays
only if its score so far, plus the most that the remaining dimensions can add (the product of the two remaining norms),
reaches the query's k-th best score; survivors are compacted before the next block. A query's first scores come from
the candidates with the largest bounds, counted in full, so that there is a k-th best score from the start.

Cells hold vectors of like norm, the largest first: vectors are shuffled once, by norm, and written. Queries come in batches of
bounded size, each broadcast to the cells, which stay where they are. The first cells, counted alone, give each query a floor
under its k-th best score; a whole cell is passed over by a query whose norm, times the cell's largest, stays below that
floor, and only scores that reach it leave a cell. The rest is a maximum by query. A task holds one cell and one batch.

Defined results: vectors that are null or hold null or non-finite components take no part, nor do rows without a vec_id;
a vector shorter than another one is taken as if it ended in zeros; a row is never its own candidate, nor is another
row with its vec_id; repeated rows are candidates each and, as queries, one; with no vector or no query there are no
rows. Scores are exact as long as they fit into 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.grouping import materialised, shared_dir, small_batches

CELL = 8192
#: Queries of a batch, about: the number is even over hashes. What is broadcast is cut at twice that.
QUERIES = 8192
#: Cells that give the floors.
SEEDS = 2
DIMS = 16
SCALE = 64
QUERY_EVERY = 20


def whole_vectors(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, v (array of long): floor(scale * x), for the rows that take part."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    usable = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return rows.filter(usable).select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda c: F.floor(c * scale).cast("long")).alias("v"))


def _matrix(ids: pa.Array, lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """ids, and one row of the result for each dimension."""
    size = np.diff(lists.offsets.to_numpy())
    wide = np.zeros((len(size), int(size.max()) if len(size) else 0), dtype=np.int64)
    row = np.repeat(np.arange(len(size)), size)
    wide[row, np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)] = lists.flatten().to_numpy()
    return ids.to_numpy(), np.ascontiguousarray(wide.T)


_CELL = "cell long, norm double, kind string, ids binary, data binary"


def _cells(size: int):
    """Packs vectors, in the order in which they come, into cells of the vertical layout, in the narrowest whole numbers."""

    def pack(parts: list[pa.RecordBatch], cell: int) -> pa.RecordBatch:
        t = pa.Table.from_batches(parts).combine_chunks()
        ids, x = _matrix(t["vec_id"].chunk(0), t["v"].chunk(0))
        most = int(max(x.max(initial=0), -1 - x.min(initial=0)))
        kind = next(k for k in ("<i1", "<i2", "<i4", "<i8") if most <= np.iinfo(k).max)
        row = [cell, float(t["norm"].to_numpy().max()), kind, ids.astype("<i8").tobytes(), x.astype(kind).tobytes()]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, (pa.int64(), pa.float64(), pa.string(), pa.binary(), pa.binary()), strict=True)], [c.split()[0] for c in _CELL.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, many, cell = [], 0, TaskContext.get().partitionId() << 32
        for batch in batches:
            while len(batch):
                piece = batch.slice(0, size - many)
                held.append(piece)
                many += len(piece)
                batch = batch.slice(len(piece))
                if many == size:
                    yield pack(held, cell)
                    held, many, cell = [], 0, cell + 1
        if held:
            yield pack(held, cell)

    return run


def _rest(m: np.ndarray) -> np.ndarray:
    """For each block of dimensions the norm of what comes from there on, and a last row of zeros."""
    squares = np.add.reduceat(m.astype(np.float64) ** 2, np.arange(0, len(m), DIMS), axis=0)
    return np.sqrt(np.concatenate([np.cumsum(squares[::-1], axis=0)[::-1], np.zeros((1, m.shape[1]))]))


def search(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int, floors: np.ndarray | None = None) -> list[tuple[int, int, int, int]]:
    """(query's place, query_id, vec_id, score): for each query its k best candidates, ties to the smaller vec_id.

    Candidates whose score is under the query's floor, if there are floors, may be left out. Floors are raised to what
    k candidates reach here.
    """
    dims = max(len(q), len(x))
    q, x = (np.concatenate([m, np.zeros((dims - len(m), m.shape[1]), np.int64)]) for m in (q, x))
    order = np.argsort(ids, kind="stable")
    ids, x = ids[order], x[:, order]
    # Doubles add whole numbers exactly, and fast, while no sum can pass 2**53.
    most = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * dims
    kind = np.float64 if most < 2**53 else np.int64
    q, x = q.astype(kind), x.astype(kind)
    q_rest, x_rest = _rest(q), _rest(x)
    out: list[tuple[int, int, int, int]] = []
    floors = np.full(len(q_ids), -np.inf) if floors is None else floors
    # The whole cell is passed over where its largest norm can't reach the floor.
    for i in np.flatnonzero(q_rest[0] * x_rest[0].max(initial=0) * (1 + 1e-9) + 1e-6 >= floors).tolist():
        query = int(q_ids[i])
        alive = np.flatnonzero((ids != query) & (q_rest[0, i] * x_rest[0] * (1 + 1e-9) + 1e-6 >= floors[i]))
        if not len(alive):
            continue
        seed = alive if len(alive) <= k else alive[np.argpartition(-x_rest[0, alive], k - 1)[:k]]
        best = np.sort(q[:, i] @ x[:, seed])[::-1]
        floor = max(floors[i], best[k - 1] if len(best) >= k else -np.inf)
        score = np.zeros(len(alive), dtype=kind)
        for b, at in enumerate(range(0, dims, DIMS)):
            score = score + q[at : at + DIMS, i] @ x[at : at + DIMS, alive]
            # A little slack, as the norms are rounded: a candidate too many does no harm.
            bound = score + q_rest[b + 1, i] * x_rest[b + 1, alive] * (1 + 1e-9) + 1e-6
            stay = bound >= floor
            if not stay.all():
                alive, score = alive[stay], score[stay]
            if len(alive) > k:
                # What surely is reached by k of them lifts the floor.
                sure = score - q_rest[b + 1, i] * x_rest[b + 1, alive] * (1 + 1e-9) - 1e-6
                floor = max(floor, np.partition(sure, -k)[-k])
        top = np.lexsort((ids[alive], -score))[:k]
        if len(top) == k:
            floors[i] = max(floors[i], float(score[top[-1]]))
        out += [(i, query, int(ids[alive[t]]), int(score[t])) for t in top if score[t] >= floors[i]]
    return out


def _searched(cells: DataFrame, q_ids: np.ndarray, q: np.ndarray, floors: np.ndarray, k: int) -> DataFrame:
    """(place, query_id, vec_id, score): the candidates of each cell for the batch's queries."""
    batch = cells.sparkSession.sparkContext.broadcast((q_ids, q, floors))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q_ids, q, floors = batch.value
        floors = floors.copy()  # raised from cell to cell of the task
        for part in batches:
            for kind, ids, data in zip(part["kind"].to_pylist(), part["ids"], part["data"], strict=True):
                ids = np.frombuffer(ids.as_buffer(), "<i8")
                x = np.frombuffer(data.as_buffer(), kind).reshape(-1, len(ids)).astype(np.int64)
                got = np.array(search(q_ids, q, ids, x, k, floors), dtype=np.int64).reshape(-1, 4)
                yield pa.RecordBatch.from_arrays([pa.array(got[:, i].copy()) for i in range(4)], ["place", "query_id", "vec_id", "score"])

    return cells.mapInArrow(run, "place long, query_id long, vec_id long, score long")


def _best(found: DataFrame, by: str, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(by).orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k)


def top_k(rows: DataFrame, k: int = 20, every: int = QUERY_EVERY) -> DataFrame:
    """query_id, rank, vec_id, score for the queries: the rows whose vec_id is divisible by ``every``."""
    spark = rows.sparkSession
    whole = whole_vectors(rows)
    n, m = whole.select(F.count(F.lit(1)), F.count_if(F.col("vec_id") % every == 0)).first()
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double")))
    ranged = whole.withColumn("norm", norm).repartitionByRange(-(-n // CELL) or 1, F.desc("norm"), "vec_id").sortWithinPartitions(F.desc("norm"), "vec_id")
    cells = materialised(ranged.mapInArrow(_cells(CELL), _CELL), "cells")
    seeds = [r[0] for r in cells.select("cell", "norm").orderBy(F.desc("norm"), "cell").limit(SEEDS).collect()]
    batches = -(-m // QUERIES) or 1
    number: Column = F.pmod(F.xxhash64("vec_id", "v"), F.lit(batches)).cast("int")
    queries = whole.filter(F.col("vec_id") % every == 0).distinct().withColumn("batch", number)
    # By batch, so that reading one of them reads few files' statistics and no more.
    queries = materialised(queries.repartitionByRange("batch").sortWithinPartitions("batch"), "queries")
    path = shared_dir(spark, "found")
    for i in range(batches):
        table = queries.filter(F.col("batch") == i).select("vec_id", "v").toArrow().combine_chunks()
        for at in range(0, max(len(table), 1), 2 * QUERIES):
            part = table.slice(at, 2 * QUERIES).combine_chunks()
            ids, lists = (part[c].combine_chunks() for c in ("vec_id", "v"))
            q_ids, q = _matrix(*(x if isinstance(x, pa.Array) else pa.concat_arrays(x.chunks) if x.num_chunks else pa.array([], x.type) for x in (ids, lists)))
            floors = np.full(len(q_ids), -np.inf)
            first = _searched(cells.filter(F.col("cell").isin(seeds)), q_ids, q, floors, k)
            first = materialised(_best(first, "place", k), "seeds")
            for place, floor in first.filter(F.col("rank") == k).select("place", "score").collect():  # one row for each query of the batch
                floors[place] = floor
            rest = _searched(cells.filter(~F.col("cell").isin(seeds)), q_ids, q, floors, k)
            with small_batches(spark):
                rest.unionByName(first.drop("rank")).select("query_id", "vec_id", "score").write.mode("append").parquet(path)
    found = spark.read.schema("query_id long, vec_id long, score long").parquet(path)
    return _best(found, "query_id", k).select("query_id", "rank", "vec_id", "score")


def op2_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


OP2_SQL = """
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda c: floor(64 * c::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))::BIGINT AS score
  FROM e q JOIN e c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 20
"""
