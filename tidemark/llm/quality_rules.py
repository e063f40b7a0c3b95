"""Quality classifier: a sparse rule ensemble.

Statistics of the whole text are Spark columns. Shallow boosted trees are grown on a bounded sample of labelled rows;
every path from a root to a node is a conjunctive rule over statistics; lasso logistic regression gives most rules the
weight 0 (its penalty is chosen by cross-validation among the rows that may be learnt from); the others are compiled into one Spark column expression, so scoring stays in generated JVM code.

Labels, lang, source and doc_id are never inputs of a score; doc_id only decides which labels may be learnt from.

Defined results: a null text counts as empty and is scored like one; a null doc_id isn't held out; labels that are
null, or of which one doc_id has both, aren't learnt from; each row of the documents gets one row, with repeated
doc_ids too; extra columns are kept by ``scored`` unless they bear the names of what it adds; where no label can be
learnt from, every score is 0.5, and where all are the same, the share of ones, smoothed; an empty table gives none.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Labelled rows that the rules are fitted on, at most: those whose ids have the least hashes.
SAMPLE = 20_000
TREES, DEPTH, RATE, CUTS, GAPS = 24, 3, 0.3, 64, 24
#: Penalties to choose from, and the rounds that each gets for that and in the end.
PENALTIES, TRIAL_ROUNDS, ROUNDS = (1e-4, 3e-4, 1e-3, 3e-3), 150, 400
KEEP_FROM = 0.7


def _without(text: Column, chars: str) -> Column:
    """How many characters of a class a text has."""
    return F.length(F.regexp_replace(text, f"[^{chars}]+", ""))


def statistics(text: Column) -> dict[str, Column]:
    """The statistics that rules are made of; shares are of the text's characters or words."""
    n = F.greatest(F.length(text), F.lit(1)).cast("double")
    words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))
    w = F.greatest(words, F.lit(1)).cast("double")
    return {
        "chars": F.length(text).cast("double"),
        "capitals": (F.length(text) - F.length(F.regexp_replace(text, r"[A-Z\xC0-\xDE]{3,}", ""))) / n,  # in runs
        "digits": _without(text, "0-9") / n,
        "shouts": _without(text, "!") / n,
        "bars": _without(text, "|") / n,
        "symbols": _without(text, r"#$%&*+=<>@^_~{}\[\]\\") / n,
        "lines": _without(text, r"\n") / n,
        # Words that are the same as the word before them.
        "echoes": F.regexp_count(text, F.lit(r"(?<!\S)(\S++)\s(?=\1(?!\S))")) / w,
    }


@dataclass(frozen=True)
class Rules:
    """score = logistic(bias + sum of the weights of the rules that hold)."""

    bias: float
    rules: tuple[tuple[float, tuple[tuple[str, bool, float], ...]], ...]

    def score(self) -> Column:
        total = F.lit(self.bias)
        for weight, parts in self.rules:
            holds = None
            for name, above, cut in parts:
                one = F.col(f"_s_{name}") > cut if above else F.col(f"_s_{name}") <= cut
                holds = one if holds is None else holds & one
            total = total + F.when(holds, F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 4 == 2


def _tree(x: np.ndarray, cuts: list[np.ndarray], g: np.ndarray, h: np.ndarray, rows: np.ndarray, depth: int, path: tuple, out: list, step: np.ndarray) -> None:
    """Grows one tree on gradients; adds the path of every node to ``out`` and each leaf's value to ``step``."""
    best = (1e-6, -1, 0.0)
    total_g, total_h = g[rows].sum(), h[rows].sum() + 1.0
    if depth and len(rows) > 3:
        for f, at in enumerate(cuts):
            if not len(at):
                continue
            place = np.searchsorted(at, x[rows, f])  # x <= at[i] holds for place <= i
            left_g = np.cumsum(np.bincount(place, g[rows], len(at) + 1))[:-1]
            left_h = np.cumsum(np.bincount(place, h[rows], len(at) + 1))[:-1] + 1.0
            right_h = total_h - left_h + 1.0
            gain = left_g**2 / left_h + (total_g - left_g) ** 2 / right_h - total_g**2 / total_h
            i = int(gain.argmax())
            if gain[i] > best[0]:
                best = (float(gain[i]), f, float(at[i]))
    if best[1] < 0:
        step[rows] = -total_g / total_h
        return
    _, f, cut = best
    low = x[rows, f] <= cut
    for above, part in ((False, rows[low]), (True, rows[~low])):
        if len(part):
            out.append((*path, (f, above, cut)))
            _tree(x, cuts, g, h, part, depth - 1, out[-1], out, step)


def _lasso(z: np.ndarray, y: np.ndarray, penalty: float, rounds: int = ROUNDS) -> tuple[float, np.ndarray]:
    """Accelerated proximal gradient for logistic loss with an L1 penalty on all but the bias."""
    n, k = z.shape
    one = np.concatenate([np.ones((n, 1)), z], axis=1)
    step = 4.0 / max(float(np.linalg.eigvalsh(one.T @ one)[-1]) / n, 1e-9)
    w = v = np.zeros(k + 1)
    t = 1.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(one @ v, -30, 30)))
        new = v - step * (one.T @ (p - y) / n)
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - step * penalty, 0)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v = new + (t - 1) / t_new * (new - w)
        w, t = new, t_new
    return float(w[0]), w[1:]


Path = tuple[tuple[int, bool, float], ...]


def _holds(x: np.ndarray, paths: list[Path]) -> np.ndarray:
    return np.stack([np.logical_and.reduce([(x[:, f] > c) == above for f, above, c in path]) for path in paths], axis=1).astype(float)


def _paths(x: np.ndarray, y: np.ndarray) -> list[Path]:
    """The paths of all trees; of those that hold for the same rows the first."""
    cuts = []
    for f in range(x.shape[1]):
        v = np.unique(x[:, f])
        mid = (v[1:] + v[:-1]) / 2
        # Where there are many values: evenly by rank, and in the widest gaps, where a cut has most room on both sides.
        wide = np.argsort(v[:-1] - v[1:], kind="stable")[:GAPS]
        cuts.append(mid if len(mid) <= CUTS else np.unique(np.concatenate([mid[:2], mid[wide], np.quantile(mid, np.linspace(0, 1, CUTS))])))
    score, paths = np.full(len(y), np.log(y.mean() / (1 - y.mean()))), []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-score))
        step = np.zeros(len(y))
        _tree(x, cuts, p - y, p * (1 - p), np.arange(len(y)), DEPTH, (), paths, step)
        score = score + RATE * step
    paths = list(dict.fromkeys(paths))
    if not paths:
        return []
    _, first = np.unique(_holds(x, paths), axis=1, return_index=True)
    return [paths[i] for i in np.sort(first).tolist()]


def _penalty(x: np.ndarray, y: np.ndarray, fold: np.ndarray) -> float:
    """The penalty with the least loss on rows of folds that it wasn't fitted on; the larger one of equals."""
    loss = dict.fromkeys(PENALTIES, 0.0)
    for f in np.unique(fold).tolist():
        fit, rest = fold != f, fold == f
        if len(np.unique(y[fit])) < 2 or not (paths := _paths(x[fit], y[fit])):
            continue
        inside, outside = _holds(x[fit], paths), _holds(x[rest], paths)
        for penalty in PENALTIES:
            bias, weights = _lasso(inside, y[fit], penalty, TRIAL_ROUNDS)
            margin = (bias + outside @ weights) * (2 * y[rest] - 1)
            loss[penalty] += float(np.logaddexp(0, -margin).sum())
    return min(PENALTIES, key=lambda p: (loss[p], -p))


def fit_rules(x: np.ndarray, y: np.ndarray, names: list[str], fold: np.ndarray | None = None) -> Rules:
    """``fold`` numbers the parts for cross-validation; without it they follow the rows' places."""
    if len(np.unique(y)) < 2 or not (paths := _paths(x, y)):
        share = (y.sum() + 0.5) / (len(y) + 1)
        return Rules(float(np.log(share / (1 - share))), ())
    bias, weights = _lasso(_holds(x, paths), y, _penalty(x, y, np.arange(len(y)) % 3 if fold is None else fold))
    kept = [(float(w), tuple((names[f], above, float(c)) for f, above, c in path)) for w, path in zip(weights, paths, strict=True) if abs(w) > 1e-6]
    return Rules(bias, tuple(kept))


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Rules:
    """Rules from the labels that aren't held out; at most ``sample`` rows come to the driver, as statistics."""
    known = labels.filter("quality is not null and doc_id is not null").filter(~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").alias("_id")).agg(F.min("quality").alias("_y"), F.max("quality").alias("_z")).filter("_y = _z")
    known = known.orderBy(F.xxhash64("_id"), "_id").limit(sample).select("_id", "_y")
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(F.broadcast(known), F.col("doc_id") == F.col("_id"))
    stats = statistics(F.col("text"))
    made = rows.select(F.col("_y").cast("double").alias("y"), "_id", (F.crc32(F.col("_id").cast("string")) % 4).alias("fold"), *[c.alias(k) for k, c in stats.items()])
    # A doc_id may have many rows: the bound holds for rows, too.
    got = made.orderBy(F.xxhash64("_id"), "_id", *stats).limit(sample).toArrow()
    x = np.stack([got[k].to_numpy().astype(float) for k in stats], axis=1) if len(got) else np.zeros((0, len(stats)))
    return fit_rules(x, got["y"].to_numpy().astype(float), list(stats), got["fold"].to_numpy())


def scored(docs: DataFrame, rules: Rules) -> DataFrame:
    """The documents with held_out, score and predicted (1: kept)."""
    used = {name for _, parts in rules.rules for name, _, _ in parts}
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    full = docs.drop("held_out", "score", "predicted")
    # The row number keeps a filter on the score from being moved below the statistics, where each rule would make them anew.
    with_stats = full.select("*", *[c.alias(f"_s_{k}") for k, c in statistics(text).items() if k in used], F.monotonically_increasing_id().alias("_s_row"))
    return (
        with_stats.withColumn("score", F.when(F.col("_s_row") >= 0, rules.score()))
        .withColumn("held_out", held_out(F.col("doc_id")))
        .withColumn("predicted", F.when(F.col("score") >= KEEP_FROM, 1).otherwise(0))
        .select(*full.columns, "held_out", "score", "predicted")
    )


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rules = learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored(docs.select("doc_id", "text"), rules).select("doc_id", "held_out", "score", "predicted")
