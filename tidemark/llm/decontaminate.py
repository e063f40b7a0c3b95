"""Benchmark decontamination: a broadcast hash table of normalised test n-grams, and a scan of every training window.

Only built-in functions are used. Words are looked up by window: an array of 64-bit window hashes is made per
document, exploded and joined with the hash table; a hit is then verified word by word against the window itself.
Only hits (and one row for each document) are shuffled. The table of test windows is broadcast while its size,
which is checked, stays under ``BROADCAST_BYTES``; beyond that window hashes are shuffled, without the words.

Defined results: a null text has no words and hits nothing; items without words have no window; an item with a null
item_id marks words but is not listed; repeated items count once; each row of the documents gets one row, also
where doc_id is null or repeated; extra columns are ignored; with an empty benchmark nothing is hit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What a word consists of, after A-Z is lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Estimated bytes of the test windows up to which they are broadcast.
BROADCAST_BYTES = 64_000_000
_NO_WINDOW = 0


def words_of(text: Column) -> Column:
    return F.coalesce(F.regexp_extract_all(F.translate(text, _UPPER, _LOWER), F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def _hash(word_hashes: Column, at: Column | int, length: int) -> Column:
    return F.xxhash64(*[F.get(word_hashes, F.lit(at) + k if isinstance(at, int) else at + k) for k in range(length)])


def _window_hashes(length: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.size("wh") - length), lambda i: _hash(F.col("wh"), i, length))


def benchmark_windows(benchmark: DataFrame, size: int) -> DataFrame:
    """hash, length, window (its words), items: every distinct window of the items; a shorter item is one window."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), words_of(F.col("text").cast("string")).alias("words")).filter(F.size("words") > 0)
    length = F.least(F.size("words"), F.lit(size))
    starts = F.sequence(F.lit(1), F.size("words") - length + 1)
    rows = items.select("item", F.explode(F.transform(starts, lambda i: F.slice("words", i, length))).alias("window"))
    tests = rows.groupBy("window").agg(F.collect_set("item").alias("items")).withColumn("length", F.size("window")).withColumn("wh", F.transform("window", lambda w: F.xxhash64(w)))
    value = F.lit(None).cast("long")
    for n in range(1, size + 1):
        value = F.when(F.col("length") == n, _hash(F.col("wh"), 0, n)).otherwise(value)
    return tests.select(value.alias("hash"), "length", "window", "items")


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = 10) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items (sorted ids) and contaminated, one row for each row of the documents."""
    return _scan(docs.select("doc_id", F.col("text").cast("string").alias("text")), benchmark, size)


def _place_of(sizes: list[int], many: Column) -> Column:
    """The first word of a window, from its place in the array of all windows, which stand by length after one blank."""
    at, before = F.lit(None).cast("int"), F.lit(1)
    for n in sizes:
        at = F.when(F.col("length") == n, F.col("place") - before).otherwise(at)
        before = before + F.greatest(many - (n - 1), F.lit(0))
    return at


def _met_by_broadcast(hashed: DataFrame, tests: DataFrame, sizes: list[int]) -> DataFrame:
    """row, doc_id, n_words, at, length, items, hit; hits are verified word by word."""
    many = F.size("words")
    each = [F.when(many >= n, _window_hashes(n)).otherwise(F.array().cast("array<long>")) for n in sizes]
    # The array is a column of its own, so that exploding it and the join stay in generated code; the outer form, for
    # which Spark infers no filter on the array's size that would make the array a second time.
    hashed = hashed.withColumn("hashes", F.concat(F.array(F.lit(_NO_WINDOW).cast("long")), *each))
    placed = hashed.select("doc_id", "row", "words", F.posexplode_outer("hashes").alias("place", "at_hash"))
    # The join alone decides which windows go on; its rows are few, and only they are made with their document's words.
    met = placed.join(F.broadcast(tests), F.col("at_hash") == F.col("hash")).withColumn("at", _place_of(sizes, many))
    same = F.forall(F.sequence(F.lit(0), F.col("length") - 1), lambda k: F.coalesce(F.get("words", F.col("at") + k) == F.get("window", k), F.lit(False)))
    return met.withColumn("n_words", many).withColumn("hit", F.when(F.col("window").isNotNull() & (F.col("at") >= 0), same).otherwise(F.lit(False)))


def _met_by_shuffle(hashed: DataFrame, tests: DataFrame, sizes: list[int]) -> DataFrame:
    """The same for any number of tests. No words travel: hits are verified by a second hash."""
    many = F.size("words")
    second = lambda wh, at, n: F.hash(*[F.get(wh, at + k) for k in range(n)])
    pair = lambda n: F.transform(F.sequence(F.lit(0), many - n), lambda i: F.struct(_hash(F.col("wh"), i, n).alias("h"), second("wh", i, n).alias("h2")))
    kind = "array<struct<h:long,h2:int>>"
    each = [F.when(many >= n, pair(n)).otherwise(F.array().cast(kind)) for n in sizes]
    blank = F.array(F.struct(F.lit(_NO_WINDOW).cast("long").alias("h"), F.lit(0).alias("h2")))
    made = hashed.withColumn("hashes", F.concat(blank, *each)).withColumn("n_words", many)
    placed = made.select("doc_id", "row", "n_words", F.posexplode_outer("hashes").alias("place", "x")).select("doc_id", "row", "n_words", "place", "x.h", "x.h2")
    # A document's own row needs no partner; apart from it no row of a document is there without a hit.
    own = placed.filter("place = 0").select("doc_id", "row", "n_words", F.lit(None).cast("int").alias("at"), F.lit(None).cast("int").alias("length"), F.lit(None).cast("array<string>").alias("items"), F.lit(False).alias("hit"))
    test_hash = F.lit(None).cast("int")
    for n in sizes:
        test_hash = F.when(F.col("length") == n, second(F.transform("window", lambda w: F.xxhash64(w)), F.lit(0), n)).otherwise(test_hash)
    keyed = tests.filter("window is not null").withColumn("h2", test_hash).withColumnRenamed("hash", "h").drop("window")
    met = placed.filter("place > 0").join(keyed, ["h", "h2"]).withColumn("at", _place_of(sizes, F.col("n_words")))
    hits = met.filter("at >= 0 and at + length <= n_words").select("doc_id", "row", "n_words", "at", "length", "items", F.lit(True).alias("hit"))
    return own.unionByName(hits)


def _scan(docs: DataFrame, benchmark: DataFrame, size: int) -> DataFrame:
    tests = benchmark_windows(benchmark, size)
    sizes, n_bytes = tests.agg(F.collect_set("length"), F.sum(F.aggregate("window", F.lit(40), lambda a, w: a + F.octet_length(w) + 16) + 24 * F.size("items"))).first()
    sizes = sorted(sizes or [])
    # A row without a window stands for the document itself, hit or not: one entry of each document has its hash.
    none = tests.sparkSession.range(1).select(F.lit(_NO_WINDOW).alias("hash"), F.lit(0).alias("length"), F.lit(None).cast("array<string>").alias("window"), F.lit(None).cast("array<string>").alias("items"))
    tests = tests.unionByName(none)
    words = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), words_of(F.col("text")).alias("words"))
    hashed = words.withColumn("wh", F.transform("words", lambda w: F.xxhash64(w)))
    met = _met_by_broadcast(hashed, tests, sizes) if (n_bytes or 0) <= BROADCAST_BYTES else _met_by_shuffle(hashed, tests, sizes)
    span = F.when(F.col("hit"), F.struct("at", "length"))
    found = met.groupBy("row", "doc_id").agg(
        F.max("n_words").cast("long").alias("n_words"),
        F.sort_array(F.collect_set(span)).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.when(F.col("hit"), F.col("items")))))).alias("items"),
    )
    # Spans are sorted by place: each adds what reaches beyond the ones before it.
    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    covered = F.aggregate(
        "spans", start,
        lambda a, s: F.struct(F.greatest(a["end"], s["at"] + s["length"]).alias("end"), (a["n"] + F.greatest(s["at"] + s["length"] - F.greatest(a["end"], s["at"]), F.lit(0))).alias("n")),
    )
    return found.withColumn("n_hit", covered["n"].cast("long")).select(
        "row", "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items", (F.col("n_hit") > 0).alias("contaminated")
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, size: int = 10) -> DataFrame:
    """The documents that hold no test window, with all their columns.

    Each row is judged for itself, whatever its doc_id: hits depend on the text alone, so that rows are known by 128 bits
    of its hashes, which are the same wherever a row is read again. The hashes of contaminated documents are broadcast
    only where Spark finds them small at run time.
    """
    text = F.col("text").cast("string")
    key = F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit("tidemark"), text).alias("b"))
    bad = _scan(docs.select(key.alias("doc_id"), text.alias("text")), benchmark, size).filter("contaminated").select("doc_id.a", "doc_id.b").distinct()
    keyed = docs.withColumns({"_a": key["a"], "_b": key["b"]})
    return keyed.join(bad, (F.col("_a") == F.col("a")) & (F.col("_b") == F.col("b")), "left_anti").drop("_a", "_b")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


OP4_SQL = r"""
WITH b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)
), d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), lens AS (SELECT DISTINCT n FROM bw), dw AS (
  SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lens WHERE len(w) >= n)
), hits AS (SELECT doc_id, i, dw.n, item_id FROM dw JOIN bw USING (n, g)), marked AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM hits)) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN marked USING (doc_id) LEFT JOIN named USING (doc_id)
"""
