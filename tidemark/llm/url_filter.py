"""URL filters: one trie over reversed host labels and path segments, longest match between allow and block entries.

A node stands for host labels from the right; below it is a trie of path segments. The last segment of a rule is a
prefix of one, unless the rule ends with a slash. Of the rules that fit a url the one with most host labels wins, and of
these the one with the longest path; an entry that is both allowed and blocked is blocked. The trie is broadcast to the
Python workers; its size is checked, and beyond ``TRIE_RULES`` rules the same answer comes from a join on all suffixes
of the host and prefixes of the path, whose longest match is picked by a maximum.

Defined results: a null url or one without ``://`` has an empty host and path, fits no rule and gets the default
verdict; hosts are compared as they are written, A-Z lower-cased, so a port or a trailing dot makes another host;
rows may repeat and page_id may be null; extra columns are kept, but host, path, rule and verdict are replaced.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rules up to which the trie is broadcast: about 100 MB of Python objects.
TRIE_RULES = 500_000
DEFAULT = "allow"
#: (verdict, host, path)
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))


@dataclass
class Node:
    below: dict[str, Node] = field(default_factory=dict)
    paths: PathNode | None = None


@dataclass
class PathNode:
    below: dict[str, PathNode] = field(default_factory=dict)
    #: Rules that end here, by the part of the next segment that they ask for, longest first.
    ends: list[tuple[str, str, str]] = field(default_factory=list)


def build(rules: Iterable[tuple[str, str, str]]) -> Node:
    top = Node()
    for verdict, host, path in rules:
        node = top
        for label in reversed(host.split(".")):
            node = node.below.setdefault(label, Node())
        node.paths = node.paths or PathNode()
        at = node.paths
        *segments, last = path.split("/")
        for segment in segments:
            at = at.below.setdefault(segment, PathNode())
        at.ends.append((last, host + path, verdict))
        at.ends.sort(key=lambda e: (-len(e[0]), e[0], e[2] != "block"))
    return top


def _longest(node: PathNode, segments: list[str], i: int = 0) -> tuple[str, str] | None:
    """The longest rule whose path the segments start with."""
    best, at = None, node
    while at is not None:
        rest = "/".join(segments[i : i + 1]) if i < len(segments) else None
        if rest is not None:
            best = next(((rule, verdict) for last, rule, verdict in at.ends if rest.startswith(last)), best)
        at = at.below.get(segments[i]) if i < len(segments) - 1 else None
        i += 1
    return best


def match(top: Node, host: str, path: str) -> tuple[str | None, str | None]:
    best, node, segments = None, top, path.split("/")
    for label in reversed(host.split(".")):
        node = node.below.get(label)
        if node is None:
            break
        if node.paths:
            best = _longest(node.paths, segments) or best
    return best or (None, None)


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    parts = lambda i: F.coalesce(F.regexp_extract(rest, r"(?s)^([^/?#]*)([^?#]*)", i), F.lit(""))
    return F.translate(parts(1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), parts(2)


def filtered(pages: DataFrame, rules: DataFrame | Iterable[tuple[str, str, str]] = RULES, default: str = DEFAULT) -> DataFrame:
    """The pages with host, path, rule (as host and path, null if none) and verdict."""
    spark = pages.sparkSession
    host, path = host_and_path(F.col("url").cast("string"))
    split = pages.drop("host", "path", "rule", "verdict").withColumn("host", host).withColumn("path", path)
    if isinstance(rules, DataFrame):
        if rules.count() > TRIE_RULES:
            return _by_join(split, rules, default)
        rules = [tuple(r) for r in rules.select("verdict", "host", "path").collect()]
    trie = spark.sparkContext.broadcast(build(rules))

    @F.pandas_udf("rule string, verdict string")
    def verdicts(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for hosts, paths in parts:
            got = [match(trie.value, h, p) for h, p in zip(hosts, paths, strict=True)]
            yield pd.DataFrame(got, columns=["rule", "verdict"], dtype=object)

    found = split.withColumn("_v", verdicts("host", "path"))
    return found.select(*split.columns, F.col("_v.rule").alias("rule"), F.coalesce("_v.verdict", F.lit(default)).alias("verdict"))


def _by_join(split: DataFrame, rules: DataFrame, default: str) -> DataFrame:
    """The same for rules of any number: urls are joined by every host suffix and the path lengths that rules have."""
    named = rules.select(F.col("verdict").alias("_verdict"), F.col("host").alias("_host"), F.col("path").alias("_path")).distinct()
    lengths = [r[0] for r in named.select(F.length("_path")).distinct().collect()]
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    prefixes = F.array_distinct(F.array(*[F.substring("path", 1, n) for n in lengths]))
    keyed = split.withColumn("_row", F.monotonically_increasing_id())
    tried = keyed.select("_row", F.explode(suffixes).alias("_host"), prefixes.alias("p")).select("_row", "_host", F.explode("p").alias("_path"))
    rank = F.struct(F.size(F.split("_host", r"\.")).alias("labels"), F.length("_path").alias("length"), (F.col("_verdict") == "block").alias("block"), F.concat("_host", "_path").alias("rule"), "_verdict")
    best = tried.join(named, ["_host", "_path"]).groupBy("_row").agg(F.max(rank).alias("m"))
    return keyed.join(best, "_row", "left").select(*split.columns, F.col("m.rule").alias("rule"), F.coalesce("m._verdict", F.lit(default)).alias("verdict"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filtered(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict")


OP6_SQL = r"""
WITH u AS (
  SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages
), p AS (
  SELECT page_id, translate(coalesce(regexp_extract(rest, '^([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM u
), r(verdict, rh, rp) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
m AS (
  SELECT p.*, r.*, row_number() OVER (PARTITION BY page_id ORDER BY len(rh) DESC NULLS LAST, len(rp) DESC NULLS LAST) AS k
  FROM p LEFT JOIN r ON (host = rh OR host LIKE '%.' || rh) AND starts_with(path, rp)
)
SELECT page_id, host, path, rh || rp AS rule, coalesce(verdict, 'allow') AS verdict FROM m WHERE k = 1
"""
