"""Order-dependent relational operators, made deterministic by an explicit order column.

Row order carries meaning in event tables ("keep the last", "first value seen"). Each of these takes the columns that say
what the order is, and ends in one shuffle by the key at most.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.clean import clean_text


def _one(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    n = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_n", n).filter("_n = 1").drop("_n")


def keep_first(df: DataFrame, keys: Sequence[str], *order: Column | str) -> DataFrame:
    return _one(df, keys, [F.col(c).asc() if isinstance(c, str) else c for c in order])


def keep_last(df: DataFrame, keys: Sequence[str], *order: str) -> DataFrame:
    """The last row of each key."""
    return _one(df, keys, [F.col(c).desc() for c in order])


def keep_last_in_first_place(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The last row of each key, with the order value of the first one, as overwriting an entry does."""
    first = F.min(order).over(Window.partitionBy(*keys))
    return keep_last(df.withColumn("_first", first), keys, order).withColumn(order, F.col("_first")).drop("_first")


def clean_ids(df: DataFrame, key: str, order: str) -> DataFrame:
    """Cleaned ids; blank ones go, the last row of each stays."""
    return keep_last(df.withColumn(key, clean_text(key)).filter(F.col(key) != ""), [key], order)


def first_seen(c: str, order: str) -> Column:
    """Aggregate: the first value in order that isn't null."""
    return F.min_by(c, F.when(F.col(c).isNotNull(), F.col(order)))


def joined_in_order(c: str, order: str, separator: str = " | ") -> Column:
    """Aggregate: the distinct non-blank texts in the order in which they are first seen."""
    pairs = F.array_sort(F.collect_list(F.when(clean_text(c) != "", F.struct(F.col(order).alias("o"), clean_text(c).alias("v")))))
    return F.array_join(F.array_distinct(F.transform(pairs, lambda x: x["v"])), separator)


def first_row(columns: Sequence[str], order: str) -> Column:
    """Aggregate: the first row's values, nulls included."""
    return F.min_by(F.struct(*columns), order)


def top_k(df: DataFrame, keys: Sequence[str], k: int, *order: Column) -> DataFrame:
    n = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("rank", n).filter(F.col("rank") <= k)


def priority(c: Column | str, ranked: Sequence[str], other: int | None = None) -> Column:
    """0, 1, 2 ... for the values in order, else the next number."""
    column = F.col(c) if isinstance(c, str) else c
    out = F.lit(len(ranked) if other is None else other)
    for i, v in reversed(list(enumerate(ranked))):
        out = F.when(column == v, i).otherwise(out)
    return out


def offset_limit(df: DataFrame, order: Sequence[str], offset: int = 0, limit: int = 0) -> DataFrame:
    """A stretch of the ordered rows; 0 for all the rest."""
    out = df.orderBy(*order).offset(offset)
    return out.limit(limit) if limit else out


def first_failing(checks: Sequence[tuple[str, Column]], passed: str = "selected") -> Column:
    """The name of the first check that fails; the checks are in order."""
    out = F.lit(passed)
    for name, ok in reversed(checks):
        out = F.when(~F.coalesce(ok, F.lit(False)), name).otherwise(out)
    return out


def running_budget(df: DataFrame, keys: Sequence[str], order: Sequence[Column], size: str, budget: int, least: int = 0) -> DataFrame:
    """Rows up to a running total: each gets ``given``; the one that goes over gets the rest if that is at least ``least``."""
    before = F.coalesce(F.sum(size).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.lit(budget) - before
    given = F.when(F.col(size) <= left, F.col(size)).when((left > 0) & (left >= least), left)
    return df.withColumn("given", given.cast("long")).filter("given is not null")
