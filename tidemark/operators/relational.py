"""Joins, set algebra, metrics and rollups of event tables."""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.ordered import first_seen, joined_in_order, keep_first
from tidemark.sources.shared import written

def left_join(master: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """A left join in which the master's columns win; the source has one row for each key."""
    overlap = [c for c in source.columns if c in master.columns and c != key]
    return master.join(source.drop(*overlap), key, "left")


def left_join_chain(master: DataFrame, sources: Sequence[DataFrame | None], key: str) -> DataFrame:
    """Left joins one after another; a source that isn't there is passed over. The number of rows stays."""
    for source in sources:
        if source is not None:
            master = left_join(master, source, key)
    return master


def fill_from(left: DataFrame, right: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Nulls of the columns are filled from the right side."""
    filled = right.select(key, *[F.col(c).alias(f"_{c}") for c in columns])
    out = left.join(filled, key, "left")
    return out.withColumns({c: F.coalesce(c, f"_{c}") for c in columns}).drop(*[f"_{c}" for c in columns])


def novel_columns(base: DataFrame, known: Sequence[str], prefix: str = "base_") -> DataFrame:
    """Only columns whose names, compared by letters and digits, aren't known; prefixed."""
    plain = lambda c: re.sub("[^a-z0-9]", "", c.lower())
    have = {plain(c) for c in known}
    return base.select(*[F.col(f"`{c}`").alias(prefix + c) for c in base.columns if plain(c) not in have])


def in_order(df: DataFrame, preferred: Sequence[str]) -> DataFrame:
    first = [c for c in preferred if c in df.columns]
    return df.select(*[F.col(f"`{c}`") for c in [*first, *[c for c in df.columns if c not in first]]])


def renamed(df: DataFrame, names: Mapping[str, str], keep: Sequence[str]) -> DataFrame:
    present = {a: b for a, b in names.items() if a in df.columns}
    out = df.withColumnsRenamed(present)
    return out.select(*[c for c in keep if c in out.columns])


def two_key_merge(left: DataFrame, right: DataFrame, keys: Sequence[str], group: str, order: str, firsts: Sequence[str], joined: Sequence[str]) -> DataFrame:
    """Inner join on two keys, then a row for each group: first values seen, and texts joined in order. Null groups go."""
    both = left.join(right, list(keys)).filter(F.col(group).isNotNull())
    return both.groupBy(group).agg(*[first_seen(c, order).alias(c) for c in firsts], *[joined_in_order(c, order).alias(c) for c in joined])


def best_per_group(df: DataFrame, keys: Sequence[str], status: str, ranked: Sequence[str], score: str, order: str) -> DataFrame:
    """One row for each group: by the status's rank, then the higher score (missing is -9999), then order."""
    from tidemark.operators.ordered import priority

    return keep_first(df, keys, priority(status, ranked).asc(), F.coalesce(score, F.lit(-9999.0)).desc(), F.col(order).asc())


def id_flags(key: str, sets: Mapping[str, DataFrame]) -> DataFrame:
    """One row for each id with a flag for each set: all set algebra over ids is a filter or a count on it."""
    tagged = None
    for name, df in sets.items():
        one = df.select(F.col(key), *[F.lit(n == name).alias(n) for n in sets]).filter(F.col(key).isNotNull())
        tagged = one if tagged is None else tagged.unionByName(one)
    return tagged.groupBy(key).agg(*[F.bool_or(n).alias(n) for n in sets])


def metric_rows(df: DataFrame, metrics: Mapping[str, Column]) -> DataFrame:
    """metric, count, percent: how many rows meet each condition, in one pass."""
    one = df.agg(F.count(F.lit(1)).alias("_total"), *[F.count_if(c).alias(k) for k, c in metrics.items()])
    rows = F.array(*[F.struct(F.lit(k).alias("metric"), F.col(k).alias("count"), F.coalesce(F.try_divide(100.0 * F.col(k), F.col("_total")), F.lit(0.0)).alias("percent")) for k in metrics])
    return one.select(F.inline(rows))


def shares(df: DataFrame, *keys: str) -> DataFrame:
    """Counts by keys, null groups kept, and percent of all."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))
    return counted.withColumn("percent", 100.0 * F.col("count") / F.sum("count").over(Window.partitionBy()))


def unambiguous(df: DataFrame, keys: Sequence[str], unit: str, order: str) -> DataFrame:
    """A lookup table of the keys that stand for one unit only."""
    from tidemark.operators.ordered import first_row

    one = df.groupBy(*keys).agg(F.count_distinct(unit).alias("_units"), first_row([c for c in df.columns if c not in keys], order).alias("_r"))
    return one.filter("_units = 1").select(*keys, "_r.*")


def lookup_cascade(rows: DataFrame, key: str, tables: Sequence[tuple[str, DataFrame, Sequence[str]]], value: str) -> DataFrame:
    """The value from the first table that has the row's keys: (method, table, keys), tables with unique keys."""
    out = rows
    for method, table, keys in tables:
        out = out.join(table.select(*keys, F.col(value).alias(f"_{method}")), list(keys), "left")
    found = F.coalesce(*[F.col(f"_{m}") for m, _, _ in tables])
    method = F.coalesce(*[F.when(F.col(f"_{m}").isNotNull(), F.lit(m)) for m, _, _ in tables], F.lit("no_match"))
    return out.withColumn(value, found).withColumn("match_method", method).drop(*[f"_{m}" for m, _, _ in tables])


def query_rollup(rows: DataFrame, key: str, event: str, representative: Sequence[Column], text: str, day: str) -> DataFrame:
    """A row for each query key: a representative text, events, rows, dates; ranked by events, then last date, then text."""
    grouped = rows.groupBy(key).agg(
        F.min_by(text, F.struct(*representative)).alias("query"),
        F.count_distinct(event).alias("event_count"),
        F.count(F.lit(1)).alias("row_count"),
        F.min(day).alias("first_day"),
        F.max(day).alias("last_day"),
    )
    rank = F.row_number().over(Window.orderBy(F.desc("event_count"), F.desc("last_day"), "query", key))
    return grouped.withColumn("query_rank", rank.cast("int"))


def precision(groups: Sequence[Column], label: str = "label") -> list[Column]:
    """Aggregates: reviewed, strict and lenient precision of labels correct, wrong and uncertain."""
    n = lambda v: F.count_if(F.col(label) == v)
    zero = F.lit(0.0)
    return [
        F.count(label).alias("reviewed"),
        F.coalesce(F.try_divide(n("correct").cast("double"), n("correct") + n("wrong")), zero).alias("strict"),
        F.coalesce(F.try_divide(n("correct") + 0.5 * n("uncertain"), F.count(label)), zero).alias("lenient"),
    ]


def pending(events: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return events.join(done.select(key).distinct(), key, "left_anti")


#: Candidates that the driver weighs at once, fewer where they meet in more sets than it may hold. 2 ** 16 sets is the most of 16.
CANDIDATES, MOST_SETS = (128, 16), 2**16
#: Pairs, about, that one task takes at once: it holds 8 bytes for each, and 12 more while it reads them.
MOST_PAIRS = 40_000_000


def greedy_cover(pairs: DataFrame, item: str, member: str) -> DataFrame:
    """Items in the order of a greedy cover: at each step the one with most members that aren't covered yet, the smallest of equals.

    Members that are in the same items are one row with their number. Each round looks at the items that lead by their
    open members and at the sets of them that members are in; with these the driver takes items in turn while the best
    is sure to come before all others, whose counts can only fall. So a round gives many items, and at least one.
    As soon as MOST_PAIRS or fewer are open, which is at once for most tables, one task takes all steps that are left.
    A null item or member makes no pair.
    """
    of_member = pairs.select(item, member).dropna().groupBy(member).agg(F.sort_array(F.collect_set(item)).alias("_items"))
    left = written(of_member.groupBy("_items").agg(F.count(F.lit(1)).alias("_n")), "open")
    kind = left.schema["_items"].dataType.elementType.simpleString()
    chosen: list[tuple] = []
    since: list = []  # chosen since the open sets were written
    size = None
    few = lambda: (left.agg(F.sum(F.size("_items")).alias("n")).first()["n"] or 0) <= MOST_PAIRS
    last = few()
    while not last:
        still = left.filter(~F.arrays_overlap("_items", _array(since, kind))) if since else left
        counts = still.select(F.explode("_items").alias("i"), "_n").groupBy("i").agg(F.sum("_n").alias("n"))
        lead = [(-r["n"], r["i"]) for r in counts.orderBy(F.desc("n"), "i").head(CANDIDATES[0] + 1)]
        if not lead:
            break
        took = _leaders(still, lead, kind)
        chosen += took
        since += [i for i, _ in took]
        size = size or -lead[0][0]
        if -lead[0][0] * 2 <= size or len(since) >= 512:
            left, since, size = written(left.filter(~F.arrays_overlap("_items", _array(since, kind))), "open"), [], None
            last = few()
    schema = f"step int, {item} {kind}, newly_covered long"
    first = pairs.sparkSession.createDataFrame([(k, *x) for k, x in enumerate(chosen, 1)], schema)
    if not last:
        return first
    rest = left.repartition(1).mapInArrow(_all_steps(len(chosen), item), schema)
    return first.unionByName(rest) if chosen else rest


def _all_steps(before: int, item: str):
    """All steps of a greedy cover of (_items, _n), numbered from the ones before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat, many, weights = [], [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for batch in batches:
            flat.append(batch["_items"].flatten())
            many.append(batch["_items"].value_lengths().to_numpy(zero_copy_only=False).astype(np.int32))
            weights.append(batch["_n"].to_numpy(zero_copy_only=False).astype(np.int64))
        if not flat:
            return
        coded = pa.chunked_array(flat).dictionary_encode().combine_chunks()
        del flat
        names, ids = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
        order = pc.sort_indices(names).to_numpy()
        rank = np.empty(len(names), np.int32)
        rank[order] = np.arange(len(names), dtype=np.int32)
        ids = rank[ids]
        del coded
        size, weight = np.concatenate(many), np.concatenate(weights)
        at = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
        begin = np.concatenate([[0], np.cumsum(np.bincount(ids, minlength=len(names)))])
        # The sets of each item, filled in a part at a time.
        sets, fill, count = np.empty(len(ids), np.int32), begin[:-1].copy(), np.zeros(len(names), np.int64)
        for a in range(0, len(size), 1 << 19):
            b = min(a + (1 << 19), len(size))
            mine, own = ids[at[a] : at[b]], np.repeat(np.arange(a, b, dtype=np.int32), size[a:b])
            by_item = np.argsort(mine, kind="stable")
            each = np.bincount(mine, minlength=len(names))
            placed = np.repeat(fill - (np.cumsum(each) - each), each) + np.arange(len(mine))
            sets[placed] = own[by_item]
            fill += each
            np.add.at(count, mine, weight[own])
        is_open = np.ones(len(size), bool)
        heap = list(zip((-count).tolist(), range(len(names)), strict=True))
        heapq.heapify(heap)
        took: list[tuple[int, int]] = []
        while heap:
            n, best = heap[0]
            now = int(count[best])
            if now != -n:  # counts only fall, so what stands in the heap is the most it can be
                heapq.heapreplace(heap, (-now, best))
                continue
            if now == 0:
                break
            heapq.heappop(heap)
            took.append((best, now))
            mine = sets[begin[best] : begin[best + 1]]
            mine = mine[is_open[mine]]
            is_open[mine] = False
            long = size[mine].astype(np.int64)
            step = np.arange(long.sum()) + np.repeat(at[mine] - (np.cumsum(long) - long), long)
            np.subtract.at(count, ids[step], np.repeat(weight[mine], long))
        chosen = names.take(pa.array(order[[k for k, _ in took]], pa.int64())) if took else names.slice(0, 0)
        steps = pa.array(np.arange(before + 1, before + 1 + len(took), dtype=np.int32))
        yield pa.RecordBatch.from_arrays([steps, chosen, pa.array([n for _, n in took], pa.int64())], ["step", item, "newly_covered"])

    return run


def _array(values: list, kind: str) -> Column:
    return F.array(*map(F.lit, values)).cast(f"array<{kind}>")


def _leaders(still: DataFrame, lead: list[tuple], kind: str) -> list[tuple]:
    """(item, newly covered) of the next steps of a greedy cover, for (-count, item) of the leading items in order."""
    for many in CANDIDATES:
        tried, other = [i for _, i in lead[:many]], lead[many] if len(lead) > many else None
        met = still.select(F.array_intersect("_items", _array(tried, kind)).alias("s"), "_n").filter(F.size("s") > 0)
        rows = met.groupBy("s").agg(F.sum("_n").alias("n")).limit(MOST_SETS + 1).collect()
        if len(rows) <= MOST_SETS:
            break
    sets = {k: (tuple(r["s"]), r["n"]) for k, r in enumerate(rows)}
    of_item: dict = {i: set() for i in tried}
    for k, (s, _) in sets.items():
        for i in s:
            of_item[i].add(k)
    count = {i: -n for n, i in lead[:many]}
    took = []
    while count:
        n, best = min((-n, i) for i, n in count.items())
        if n == 0 or (other and (n, best) > other):
            break
        took.append((best, -n))
        for k in of_item[best]:
            for i in sets[k][0]:
                if i != best and i in count:
                    count[i] -= sets[k][1]
                    of_item[i].discard(k)
        del count[best]
    return took
