"""Removal of long repeats by recompression.

Every text is parsed in the same way, round by round: first runs of one word, then pairs of neighbours are
replaced by a new symbol whose name is a hash of its parts. Which neighbours are paired follows from their
names alone, so names are global without a dictionary, and equal word sequences have equal symbols in their
interior. Each symbol keeps its context: the words on which its being there depends. A window of ``size``
words that holds the whole context of a symbol can repeat only if that symbol does. So:

1. each group of documents gives its distinct symbols; Spark finds those that other groups have too;
2. windows that hold a symbol found nowhere else are settled. The rest are verified: each group gives a
   96-bit hash of every such window, once, and Spark finds the smallest document of each;
3. each group removes the words of windows that start earlier in it or in another group.

The texts are shuffled once (the three steps share the exchange); besides them only symbols, about 0.23 a
word, and windows left over travel. A hot passage gives one row for each group of documents at most.

Defined results: a null or blank text has no words (n_words 0, the hash of the empty string); a null doc_id
counts as smaller than any other; rows with one doc_id are ordered by their text and each gets its row, equal
rows in any order; extra columns are ignored; an empty table gives none.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.grouping import group_of, in_order, text_groups
from tidemark.llm.words import mix, text_chunks, window_hashes, window_starts

#: Rounds of pairing. After four a symbol has about three words, and nearly every window of 20 holds the context of one.
ROUNDS = 4
_LEAST = -(2**63)
_LOW = np.uint64(0xFFFFFFFF)


class Symbols:
    """The symbols of some documents after all rounds: names, and contexts as word spans."""

    def __init__(self, words: np.ndarray, first: np.ndarray, rounds: int = ROUNDS):
        n = len(words)
        at = np.arange(n)
        doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
        name, lo, hi, doc = self._runs(words, at, doc)
        for r in range(rounds):
            name, lo, hi, doc = self._pairs(name, lo, hi, doc, r)
        self.name, self.lo, self.hi = name, lo, hi

    @staticmethod
    def _runs(name: np.ndarray, at: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, ...]:
        """Runs of one word become one symbol; that a run ends shows only with the words around it."""
        n = len(name)
        if not n:
            return name, at, at, doc
        new = np.ones(n, dtype=bool)
        new[1:] = (name[1:] != name[:-1]) | (doc[1:] != doc[:-1])
        start = np.flatnonzero(new)
        end = np.append(start[1:], n)
        size = (end - start).astype(np.uint64)
        named = np.where(size > 1, mix(name[start] + size * np.uint64(0x9E3779B97F4A7C15)), name[start])
        return named, start - 1, end + 1, doc[start]

    @staticmethod
    def _pairs(name: np.ndarray, lo: np.ndarray, hi: np.ndarray, doc: np.ndarray, r: int) -> tuple[np.ndarray, ...]:
        """A symbol of the left class and one of the right class after it become one symbol."""
        n = len(name)
        if n < 2:
            return name, lo, hi, doc
        left = (mix(name + np.uint64(7919 * (r + 1))) >> np.uint64(17)) & np.uint64(1) == 1
        near = doc[1:] == doc[:-1]
        pair = np.zeros(n, dtype=bool)
        pair[:-1] = left[:-1] & ~left[1:] & near
        eaten = np.zeros(n, dtype=bool)
        eaten[1:] = pair[:-1]
        # What stays as it is depends on the neighbour with which its class could have paired it.
        wide_hi, wide_lo = hi.copy(), lo.copy()
        wide_hi[:-1] = np.where(left[:-1] & near, np.maximum(hi[:-1], hi[1:]), hi[:-1])
        wide_lo[1:] = np.where(~left[1:] & near & ~eaten[1:], np.minimum(lo[1:], lo[:-1]), lo[1:])
        named = name.copy()
        both = np.flatnonzero(pair)
        named[both] = mix(name[both] * np.uint64(3) + mix(name[both + 1] + np.uint64(r)))
        keep = ~eaten
        return named[keep], wide_lo[keep], wide_hi[keep], doc[keep]


def _numbers(group: pa.Table, second: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes of a group's documents, the first word of each, and the second hashes if asked for."""
    one, two, first, n = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)], 0
    for _, _, w in text_chunks(group["text"]):
        one.append(w.hashes())
        if second:
            two.append(w.hashes(1))
        first.append(w.first[1:] + n)
        n += len(w.start)
    return np.concatenate(one), np.concatenate(first), np.concatenate(two)


def _useful(s: Symbols, first: np.ndarray, size: int) -> np.ndarray:
    """Indexes of symbols whose context some window of one document holds."""
    if not len(s.name):
        return np.zeros(0, np.int64)
    doc = np.searchsorted(first, np.clip(s.lo + 1, 0, None), "right") - 1
    return np.flatnonzero((s.hi - s.lo <= size) & (s.lo >= first[doc]) & (s.hi <= first[doc + 1]))


def _once(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First index of each distinct value, and how often it occurs."""
    _, index, count = np.unique(values, return_index=True, return_counts=True)
    return index, count


def repeated_words(docs: DataFrame, size: int = 20, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, n_words, n_removed, kept (string: the words left, joined by one space) and its SHA-256, per document.

    A word goes if a window of ``size`` words that covers it also starts earlier in the corpus: in a document
    with a smaller doc_id, or further up in the same one.
    """
    low = lambda c: F.col(c).bitwiseAND(F.lit(0xFFFFFFFF)).cast("int")
    grouped, groups = text_groups(docs)

    def names(group: pa.Table) -> pa.Table:
        group = in_order(group)
        h, first, _ = _numbers(group, False)
        s = Symbols(h, first, rounds)
        use = _useful(s, first, size)
        index, _ = _once(s.name[use])
        g = group["g"][0].as_py() if len(group) else 0
        return pa.table({"name": s.name[use][index].view(np.int64), "place": (index + (g << 32)).astype(np.int64)})

    symbols = grouped.groupBy("g").applyInArrow(names, "name long, place long")
    shared = symbols.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("name"))).filter("n > 1").select(F.shiftright("place", 32).cast("int").alias("g"), low("place").alias("at"))

    def windows(group: pa.Table, found: pa.Table) -> pa.Table:
        group = in_order(group)
        h, first, second = _numbers(group, True)
        s = Symbols(h, first, rounds)
        use = _useful(s, first, size)
        index, count = _once(s.name[use])
        single = np.zeros(len(use), dtype=bool)
        single[index[count == 1]] = True
        single[found["at"].to_numpy()] = False
        settled = np.zeros(len(h) + 2, dtype=np.int32)
        alone = use[single]
        np.add.at(settled, np.maximum(s.hi[alone] - size, 0), 1)
        np.add.at(settled, s.lo[alone] + 1, -1)
        open_ = np.flatnonzero(window_starts(first, size) & (np.cumsum(settled)[: len(h)] == 0))
        one, two = window_hashes(h, size), window_hashes(second, size, np.uint64(0xA24BAED4963EE407))
        index, _ = _once(one[open_])
        at = open_[index]
        doc = group["doc_id"].fill_null(_LEAST).to_numpy()[np.searchsorted(first, at, "right") - 1] if len(at) else np.zeros(0, np.int64)
        return pa.table({"h1": one[at].view(np.int64), "place": ((two[at] & ~_LOW) + at.astype(np.uint64)).view(np.int64), "doc": pa.array(doc)})

    # What travels is narrow: the second hash shares a column with the place, and the group follows from the document.
    tried = grouped.groupBy("g").cogroup(shared.groupBy("g")).applyInArrow(windows, "h1 long, place long, doc long").repartition("h1")
    least = F.min("doc").over(Window.partitionBy("h1", "h2"))
    later = tried.withColumn("h2", F.shiftright("place", 32)).withColumn("least", least).filter("doc > least").select(group_of("doc", groups).alias("g"), low("place").alias("at"))

    def kept(group: pa.Table, found: pa.Table) -> pa.Table:
        group = in_order(group)
        h, first, _ = _numbers(group, False)
        place = np.flatnonzero(window_starts(first, size))
        index, _ = _once(window_hashes(h, size)[place])
        again = np.ones(len(place), dtype=bool)
        again[index] = False
        cover = np.zeros(len(h) + 1, dtype=np.int32)
        for starts in (place[again], found["at"].to_numpy()):
            np.add.at(cover, starts, 1)
            np.add.at(cover, starts + size, -1)
        keep = np.cumsum(cover)[: len(h)] == 0
        texts, sums = [], []
        for a, b, w in text_chunks(group["text"]):
            for doc in range(a, b):
                mark = keep[first[doc] : first[doc + 1]]
                texts.append(w.text(doc - a, None if mark.all() else mark))
                sums.append(hashlib.sha256(texts[-1]).hexdigest())
        total = np.diff(first)
        left = np.diff(np.concatenate([[0], np.cumsum(keep)])[first])
        return pa.table({"doc_id": group["doc_id"], "n_words": pa.array(total), "n_removed": pa.array(total - left), "kept": pa.array(texts, pa.binary()).cast(pa.string()), "kept_sha256": pa.array(sums, pa.string())})

    return grouped.groupBy("g").cogroup(later.groupBy("g")).applyInArrow(kept, "doc_id long, n_words long, n_removed long, kept string, kept_sha256 string")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_words(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "n_words", "n_removed", "kept_sha256")
