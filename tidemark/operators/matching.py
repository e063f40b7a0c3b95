"""Fuzzy names: similarity, blocked fuzzy joins, contained terms."""

from __future__ import annotations

import difflib
from collections import Counter
from collections.abc import Sequence
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ratio(a: str, b: str) -> float:
    """Twice the matched characters by all characters, of longest blocks found in turn."""
    return difflib.SequenceMatcher(None, a, b).ratio()


@F.pandas_udf(T.DoubleType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([ratio(x or "", y or "") for x, y in zip(a, b, strict=True)])


def token_similarity(a: str, b: str) -> float:
    """The larger of the Dice share of words and the similarity of the texts."""
    x, y = set(a.split()), set(b.split())
    dice = 2 * len(x & y) / (len(x) + len(y)) if x and y else 0.0
    return max(dice, ratio(a, b))


class Similar:
    """Whether words in a row of a text are similar to a value, for many texts at once. All texts are keys of one kind."""

    def __init__(self, texts: Sequence[str], threshold: float = 0.86):
        self.texts, self.threshold = texts, threshold
        self.whole = "\n".join(texts)
        signs = np.frombuffer(self.whole.encode("utf-32-le"), np.uint32)
        words = [t.split() for t in texts]
        self.words = list(chain.from_iterable(words))
        self.doc = np.repeat(np.arange(len(texts)), [len(w) for w in words])
        gap = (signs == ord(" ")) | (signs == ord("\n"))
        edge = np.diff(np.concatenate([[True], gap, [True]]).astype(np.int8))
        self.start, self.end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        self.signs = signs
        self.counts: dict[str, np.ndarray] = {}
        self.windows: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.known: dict[tuple[str, str], bool] = {}

    def _count(self, sign: str) -> np.ndarray:
        """How often the sign stands before each place."""
        if sign not in self.counts:
            self.counts[sign] = np.concatenate([np.zeros(1, np.int32), np.cumsum(self.signs == ord(sign), dtype=np.int32)])
        return self.counts[sign]

    def _window(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """The first words of rows of so many words in one text, and the rows' lengths, shorter rows first."""
        if size not in self.windows:
            n = max(len(self.doc) - size + 1, 0)
            at = np.flatnonzero(self.doc[:n] == self.doc[size - 1 : size - 1 + n])
            length = self.end[at + size - 1] - self.start[at]
            order = np.argsort(length, kind="stable")
            self.windows[size] = at[order], length[order]
        return self.windows[size]

    def _near(self, value: str, window: str) -> bool:
        if (value, window) not in self.known:
            self.known[value, window] = ratio(value, window) >= self.threshold
        return self.known[value, window]

    def _check(self, value: str, hit: np.ndarray) -> None:
        t, long, own = self.threshold, len(value), set(value.split())
        # Rare signs first, which leave few rows to the others.
        signs, n = sorted(Counter(value).items(), key=lambda x: self._count(x[0])[-1]), len(value.split())
        lengths = [k for k in range(1, int(long * 2 / t) + 2) if 2 * min(k, long) >= t * (k + long)]
        mine = np.fromiter((w in own for w in self.words), np.int32, len(self.words)) if n > 1 else None
        for size in range(max(1, n - 1), n + 4):
            first, length = self._window(size)
            if mine is not None:
                left = ~hit[self.doc[first]]
                # Enough of the words, in any order.
                shared = np.concatenate([[0], np.cumsum(mine)])
                for k in first[left & ((shared[first + size] - shared[first]) * (2 - t) >= t * len(own))].tolist():
                    other = set(self.words[k : k + size])
                    if 2 * len(own & other) >= t * (len(own) + len(other)):
                        hit[self.doc[k]] = True
            if not lengths:
                continue
            # Rows of a length that allows the ratio, and with enough of the same signs, are compared.
            at = first[np.searchsorted(length, lengths[0]) : np.searchsorted(length, lengths[-1], "right")]
            at = at[~hit[self.doc[at]]]
            a, b = self.start[at], self.end[at + size - 1]
            lost, most = np.zeros(len(at), np.int32), long - t * (b - a + long) / 2 + 1e-6
            for sign, many in signs:
                c = self._count(sign)
                lost += many - np.minimum(c[b] - c[a], many)
                keep = np.flatnonzero(lost <= most)
                at, a, b, lost, most = at[keep], a[keep], b[keep], lost[keep], most[keep]
            for k in np.flatnonzero(2.0 * (long - lost) / (b - a + long) >= t).tolist():
                d = self.doc[at[k]]
                if not hit[d] and self._near(value, self.whole[a[k] : b[k]]):
                    hit[d] = True

    def any_of(self, values: Sequence[str], hit: np.ndarray) -> np.ndarray:
        """For each text whether it has one of the values; those with a hit already are passed over."""
        hit = hit.copy()
        for value in filter(None, values):
            for d in np.flatnonzero(~hit).tolist():
                if value in self.texts[d]:
                    hit[d] = True
        for value in filter(None, values):
            if hit.all():
                break
            self._check(value, hit)
        return hit


#: Characters, about, of the texts that are looked through at once.
_AT_ONCE = 1 << 18


def similar_any(texts: Sequence[str], values: Sequence[Sequence[Sequence[str]]]) -> list[list[bool]]:
    """For each list of terms, one for each text, whether the text has one of its terms, spelt a little differently or not."""
    out = [[False] * len(texts) for _ in values]
    groups: dict[tuple, list[int]] = {}
    for k, said in enumerate(zip(*values, strict=True)):
        groups.setdefault(tuple(tuple(v) for v in said), []).append(k)
    for terms, rows in groups.items():
        a = 0
        while a < len(rows):
            b, size = a, 0
            while b < len(rows) and (b == a or size + len(texts[rows[b]]) <= _AT_ONCE):
                size += len(texts[rows[b]])
                b += 1
            some = Similar([texts[k] for k in rows[a:b]])
            for found, mine in zip(out, terms, strict=True):
                for k, yes in zip(rows[a:b], some.any_of(mine, np.zeros(b - a, bool)).tolist(), strict=True):
                    found[k] = yes
            a = b
    return out


def contains_fuzzy(text: str, values: Sequence[str], threshold: float = 0.86) -> bool:
    """Whether a value is in the text, or is similar to some words in a row of about as many as it has."""
    return bool(Similar([" ".join(text.split())], threshold).any_of(values, np.zeros(1, bool))[0])


@F.pandas_udf(T.BooleanType())
def fuzzy_mentions(text: pd.Series, values: pd.Series) -> pd.Series:
    return pd.Series([contains_fuzzy(t or "", list(v) if v is not None else []) for t, v in zip(text, values, strict=True)])


def mentions_in_any_script(text: str, terms: Sequence[str]) -> bool:
    """Whether a term of two characters at least is in the text, with or without its white space (multilingual keys)."""
    close = "".join(text.split())
    return any(len(t) >= 2 and (t in text or "".join(t.split()) in close) for t in terms)


def fuzzy_join(left: DataFrame, right: DataFrame, block: Sequence[str], left_key: str, right_key: str, right_id: str, threshold: float = 0.92, margin: float = 0.02, least: int = 4) -> DataFrame:
    """left ⟕ the best similar key of the right side within a block, if it stands out by the margin from the next unit's.

    A block is the join key; within it only keys whose lengths allow the threshold are compared (the ratio is at most
    2 * min / (min + max)), so most pairs never reach Python. ``threshold`` of 1 or more turns it off.
    """
    names = right.select(*block, F.col(right_key).alias("_key"), F.col(right_id).alias("_id")).filter(F.length("_key") >= least).distinct()
    wanted = left.select(*block, left_key).distinct()
    a, b = F.length(left_key), F.length("_key")
    near = 2.0 * F.least(a, b) / (a + b) >= threshold
    tried = wanted.filter((a >= least) & F.lit(threshold < 1)).join(names, list(block)).filter(near)
    by_unit = tried.withColumn("_score", similarity(F.col(left_key), F.col("_key"))).groupBy(*block, left_key, "_id").agg(F.max("_score").alias("_score"))
    pair = F.array_sort(F.collect_list(F.struct((-F.col("_score")).alias("s"), F.col("_id").alias("id"))))
    best = by_unit.filter(F.col("_score") >= threshold - margin).groupBy(*block, left_key).agg(F.slice(pair, 1, 2).alias("_p"))
    first, second = F.get("_p", F.lit(0)), F.get("_p", F.lit(1))
    ok = (-first["s"] >= threshold) & (second.isNull() | (second["s"] - first["s"] >= margin))
    found = best.select(*block, left_key, F.when(ok, first["id"]).alias("match_id"), F.when(ok, -first["s"]).alias("match_score"))
    return left.join(found, [*block, left_key], "left")


def _near_keys(left: DataFrame, right: DataFrame, block: str, left_key: str, right_key: str, most: int) -> DataFrame:
    """(_b, _x, _y, distance): a block, and a left and a right key of it that are near enough, once each."""
    parts = most + 1
    names = left.select(F.col(block).alias("_b"), F.col(left_key).alias("_x")).dropna().distinct()
    keys = right.select(F.col(block).alias("_b"), F.col(right_key).alias("_y")).dropna().distinct()
    index = F.sequence(F.lit(0), F.lit(most))
    at = lambda long, i: F.floor(long * i / parts).cast("int")
    part = lambda text, start, size: F.substring(text, start + 1, size)
    size = lambda long, i: at(long, i + 1) - at(long, i)
    y, x = F.length("_y"), F.length("_x")
    held = keys.select("_b", "_y", y.alias("_n"), F.posexplode(F.transform(index, lambda i: part(F.col("_y"), at(y, i), size(y, i)))).alias("_i", "_p"))
    lengths = names.select("_b", "_x", F.explode(F.sequence(F.greatest(x - most, F.lit(0)), x + most)).alias("_n"))
    places = lengths.select("_b", "_x", "_n", F.explode(index).alias("_i"))
    n, i = F.col("_n"), F.col("_i")
    first = F.greatest(-i, x - n - (most - i), -at(n, i))
    last = F.least(i, x - n + (most - i), x - size(n, i) - at(n, i))
    moved = places.filter(first <= last).select("_b", "_x", "_n", "_i", F.explode(F.sequence(first, last)).alias("_m"))
    tried = moved.select("_b", "_x", "_n", "_i", part(F.col("_x"), at(n, i) + F.col("_m"), size(n, i)).alias("_p")).distinct()
    met = tried.join(held, ["_b", "_n", "_i", "_p"]).select("_b", "_x", "_y").distinct()
    return met.withColumn("distance", F.levenshtein("_x", "_y", most)).filter("distance >= 0")


def edit_join(left: DataFrame, right: DataFrame, block: str, left_id: str, left_key: str, right_id: str, right_key: str, most: int = 3) -> DataFrame:
    """All (left_id, right_id, distance) of one block whose keys are at most so many edits apart.

    A key is worked on once a block, however many rows have it. Right keys are cut into ``most`` + 1 parts, of which one stands
    unchanged in a left key that is near enough, moved by no more than the edits on its one side and on its other allow; so
    keys meet by parts, and only those that do are measured. Null keys and blocks match nothing. The columns have four names.
    """
    near = _near_keys(left, right, block, left_key, right_key, most)
    # Few bytes come in where many pairs come out, so partitions must not be coalesced by their size.
    many = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = left.select(F.col(block).alias("_b"), F.col(left_key).alias("_x"), left_id).join(near, ["_b", "_x"]).select("_b", "_y", left_id, "distance")
    units = right.select(F.col(block).alias("_b"), F.col(right_key).alias("_y"), right_id).repartition(many, "_b", "_y")
    return rows.repartition(many, "_b", "_y").join(units, ["_b", "_y"]).select(left_id, right_id, "distance")


def edit_class_join(left: DataFrame, right: DataFrame, block: str, left_id: str, left_key: str, right_id: str, right_key: str, most: int = 3) -> DataFrame:
    """``edit_join`` of classes: rows of one side that have one block and key are a class, named by its smallest id.

    A pair of classes is one row and stands for each row of the one with each row of the other, so what comes out doesn't grow
    with the square of a key's rows. ``key_classes`` has the classes of all rows. Ids aren't null, and one id has one key.
    """
    near = _near_keys(left, right, block, left_key, right_key, most)
    named = lambda df, key, x, i: df.groupBy(F.col(block).alias("_b"), F.col(key).alias(x)).agg(F.min(i).alias(i))
    rows = near.join(named(left, left_key, "_x", left_id), ["_b", "_x"])
    return rows.join(named(right, right_key, "_y", right_id), ["_b", "_y"]).select(left_id, right_id, "distance")


def key_classes(rows: DataFrame, block: str, row_id: str, key: str, name: str) -> DataFrame:
    """Every row's id and, under ``name``, the smallest id that has its block and key; null where one of the two is."""
    least = rows.groupBy(block, key).agg(F.min(row_id).alias(name))
    return rows.join(least, [block, key], "left").select(row_id, name)


def edit_similarity(a: Column | str, b: Column | str) -> Column:
    """A built-in measure for blocks of candidates: 1 less the edit distance by the longer length."""
    x, y = (F.col(c) if isinstance(c, str) else c for c in (a, b))
    return 1.0 - F.levenshtein(x, y) / F.greatest(F.length(x), F.length(y), F.lit(1))
