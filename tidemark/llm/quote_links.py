"""Chat formatting by quotation linking.

A line's quote level is the number of ``>`` at its start. Lines without any are a message's own words; a line like
``On ... wrote:`` right before a quote belongs to the quote. Passages are hashed with their conversation: all lines of a level,
runs of lines of one level, their paragraphs, and lines of ``LINE_WORDS`` words or more; normalised, that is with marks
off, letters lower-cased and white space one space. A passage at level n is joined to the latest earlier turn that has it
at level n - 1: what is quoted once is that turn's own, what is quoted twice it had quoted. Every passage found votes for
its turn with its words; the turn with most (ties: the later) is what the message replies to, and without any the message
before it is. A line of one word links only where it is a passage of its own.

A conversation is a tree of replies; its reply order goes through it from the first message on, each message right before the
replies to it, in turn order, with all that follows on each. Messages that go on where the one before them ended form pieces;
the pieces' places come from a tour of their tree by pointer doubling, in rounds that grow with the logarithm of its size.

A conversation of any length is fine: messages are range-partitioned by (conv_id, turn), and what comes before a row is
carried over partition bounds; linking looks back by blocks of ``TURNS`` turns, with one row for each passage and turn.
No passage, parent or conversation is gathered in one task.

Defined results: a null text has no lines and becomes empty; messages with a null conv_id are one conversation; messages with
a null turn come first and take no part in links; equal turns of one conversation stand in the order of role and text (equal
rows in any), and can't quote one another; extra columns are ignored; an empty table gives none.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.grouping import materialised

TURNS = 1024
#: Words of a line, at least, that is looked for apart from the passage that it is in.
LINE_WORDS = 2
_MARKS = re.compile(r"[ \t\x0b\f]*>[ \t\x0b\f>]*")
_SAYS = re.compile(r"\s*on\b.*\bwrote:\s*\Z", re.I)
_ENDS = re.compile(r"\r\n|\r|\n")


def levels_of(text: str) -> list[tuple[int, str]]:
    """(level, line) of every line; a line that announces a quote has the level -1."""
    out = []
    for line in _ENDS.split(text):
        marks = _MARKS.match(line)
        out.append((marks[0].count(">") if marks else 0, line))
    for i in range(len(out) - 1):
        if out[i][0] == 0 and out[i + 1][0] > 0 and _SAYS.match(out[i][1]):
            out[i] = (-1, out[i][1])
    return out


def passages(lines: list[tuple[int, str]]) -> list[tuple[int, str, list[int]]]:
    """(level, normalised text, its lines' places) of every passage, each text of a level once."""
    found: dict[tuple[int, str], list[int]] = {}
    plain = [" ".join((_MARKS.sub("", line, count=1) if level > 0 else line).split()).lower() for level, line in lines]
    wholes: dict[int, list[int]] = {}

    def add(level: int, at: list[int], least: int = 1) -> None:
        text = " ".join(plain[i] for i in at if plain[i])
        if text and text.count(" ") + 1 >= least:
            found.setdefault((level, text), at)

    i = 0
    while i < len(lines):
        level, start = lines[i][0], i
        while i < len(lines) and lines[i][0] == level:
            i += 1
        if level < 0:
            continue
        run = [k for k in range(start, i) if plain[k]]
        wholes.setdefault(level, []).extend(run)
        add(level, run)
        paragraph: list[int] = []
        for k in range(start, i + 1):
            if k < i and plain[k]:
                paragraph.append(k)
                add(level, [k], LINE_WORDS)
            elif paragraph:
                add(level, paragraph)
                paragraph = []
    for level, at in wholes.items():
        add(level, at)
    return [(level, text, at) for (level, text), at in found.items()]


_PARSED = "id long, text string, n_quoted long, levels int, units array<struct<level:int,key:binary,at:array<int>,words:int>>"


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unit = pa.list_(pa.struct([("level", pa.int32()), ("key", pa.binary()), ("at", pa.list_(pa.int32())), ("words", pa.int32())]))
    for batch in batches:
        rows = []
        for conv, text in zip(batch["conv_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
            lines = levels_of(text or "")
            own = re.sub(r"\n{3,}", "\n\n", "\n".join(line.rstrip(" ") for level, line in lines if level == 0)).strip(" ").strip("\n")
            start = f"{conv}\n".encode()
            units = [{"level": level, "key": hashlib.blake2b(start + p.encode(errors="surrogatepass"), digest_size=16).digest(), "at": at, "words": p.count(" ") + 1} for level, p, at in passages(lines)]
            rows.append((own, sum(level > 0 for level, _ in lines), max(0, *(level for level, _ in lines)), units))
        texts, quoted, deepest, units = zip(*rows, strict=True) if rows else ((),) * 4
        yield pa.RecordBatch.from_arrays(
            [batch["id"], pa.array(texts, pa.string()), pa.array(quoted, pa.int64()), pa.array(deepest, pa.int32()), pa.array(units, unit)],
            ["id", "text", "n_quoted", "levels", "units"],
        )


def _partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _ordered(messages: DataFrame) -> DataFrame:
    """The messages with a number, id, that follows (conv_id, turn), their partition, and said: their place in the conversation, from 0."""
    kind = messages.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    order = ["conv_id", "turn", "role", "text"]
    placed = kind.repartitionByRange(_partitions(messages.sparkSession), "conv_id", "turn").sortWithinPartitions(*order).withColumn("part", F.spark_partition_id()).withColumn("id", F.monotonically_increasing_id())
    placed = materialised(placed, "messages")
    # One row for each partition: its first and last conversation, how much of the last it has, and its last message.
    ends = placed.groupBy("part").agg(F.min_by("conv_id", "id").alias("first"), F.max_by("conv_id", "id").alias("last"), F.max("id").alias("last_id"))
    tails = placed.join(F.broadcast(ends.select("part", "last")), "part").filter(F.col("conv_id").eqNullSafe(F.col("last"))).groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    carried, seen, was = [], 0, None
    for b in ends.join(tails, "part").orderBy("part").collect():
        goes_on = was is not None and b["first"] == was["last"]
        carried.append((b["part"], seen if goes_on else 0, was["last_id"] if goes_on else None))
        seen = b["n"] + (seen if goes_on and b["first"] == b["last"] else 0)
        was = b
    carry = messages.sparkSession.createDataFrame(carried, "part int, ahead long, id_ahead long").join(F.broadcast(ends.select("part", "first")), "part")
    row = F.row_number().over(Window.partitionBy("part", "conv_id").orderBy("id")) - 1
    leads = F.col("conv_id").eqNullSafe(F.col("first"))
    return (
        placed.join(F.broadcast(carry), "part").withColumn("row", row)
        .withColumn("said", F.col("row") + F.when(leads, F.col("ahead")).otherwise(F.lit(0)))
        .withColumn("before", F.when((F.col("row") == 0) & leads, F.col("id_ahead")).when(F.col("row") > 0, F.col("id") - 1))
        .select("id", "part", "conv_id", "turn", "role", "text", "said", "before")
    )


def _sources(units: DataFrame) -> DataFrame:
    """key, level, turn, source (turn, id): for each quoted passage the latest earlier turn that has it one level up, if any."""
    quotes = units.filter("level > 0").select("key", (F.col("level") - 1).alias("level"), "turn").distinct().withColumn("mine", F.lit(None).cast("struct<turn:long,id:long>"))
    given = units.join(quotes.select("key", "level").distinct(), ["key", "level"], "left_semi").groupBy("key", "level", "turn").agg(F.max("id").alias("id"))
    rows = quotes.unionByName(given.select("key", "level", "turn", F.struct("turn", "id").alias("mine"))).withColumn("block", F.floor(F.col("turn") / TURNS))
    # In a block: what earlier turns have. At equal turns quotes come first, so they don't see each other.
    near = F.max("mine").over(Window.partitionBy("key", "level", "block").orderBy("turn", F.col("mine").isNotNull()).rowsBetween(Window.unboundedPreceding, -1))
    by_block = rows.groupBy("key", "level", "block").agg(F.max("mine").alias("last"))
    far = F.max("last").over(Window.partitionBy("key", "level").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    by_block = by_block.select("key", "level", "block", far.alias("far")).filter("far is not null")
    found = rows.withColumn("near", near).filter("mine is null").join(by_block, ["key", "level", "block"], "left")
    return found.select("key", (F.col("level") + 1).alias("level"), "turn", F.coalesce("near", "far").alias("source")).filter("source is not null")


def _next_in_group(rows: DataFrame, group: str, order: str) -> DataFrame:
    """The rows with ``next``: the next larger ``order`` of the same group. No group is gathered; partitions hand on one row each."""
    spark = rows.sparkSession
    placed = materialised(rows.repartitionByRange(_partitions(spark), group, order).sortWithinPartitions(group, order).withColumn("_part", F.spark_partition_id()), "ranged")
    heads = sorted(map(tuple, placed.groupBy("_part").agg(F.min(F.struct(group, order)).alias("h")).select("_part", f"h.{group}", f"h.{order}").collect()))
    after = [(a[0], b[1], b[2]) for a, b in zip(heads, heads[1:], strict=False)]
    over = spark.createDataFrame(after, "_part int, _group long, _order long")
    inside = F.lead(order).over(Window.partitionBy("_part", group).orderBy(order))
    found = placed.withColumn("_in", inside).join(F.broadcast(over), "_part", "left")
    return found.withColumn("next", F.coalesce("_in", F.when(F.col("_group") == F.col(group), F.col("_order")))).drop("_part", "_in", "_group", "_order")


def _reply_order(messages: DataFrame, jumps: DataFrame) -> DataFrame:
    """id, piece, rest (messages from the piece's first on, in reply order) for the messages (id, part, conv_id, said, before) of
    conversations in which some message, in jumps (id, parent), doesn't answer the one before it."""
    spark = messages.sparkSession
    heads = jumps.select(F.col("id").alias("_head"), F.col("parent").alias("_to"))
    forks = jumps.select(F.col("parent").alias("_fork")).distinct()
    concerned = messages.join(heads, F.col("id") == F.col("_head")).select(F.col("conv_id").alias("_conv")).distinct()
    mine = messages.join(concerned, F.col("conv_id").eqNullSafe(F.col("_conv")), "left_semi").select("id", "part", "said", "before")
    cut = (F.col("said") == 0) | F.col("_head").isNotNull() | F.col("_fork").isNotNull()
    mine = mine.join(heads, F.col("id") == F.col("_head"), "left").join(forks, F.col("before") == F.col("_fork"), "left")
    mine = materialised(mine.select("id", "part", F.coalesce("_to", "before").alias("parent"), F.when(cut, F.col("id")).alias("cut")), "cuts")
    # The piece of a message is the last cut up to it; what a partition begins with may go on from the ones before it.
    carried, last = [], None
    for part, most in sorted(map(tuple, mine.groupBy("part").agg(F.max("cut")).collect())):
        carried.append((part, last))
        last = most if most is not None else last
    carry = spark.createDataFrame(carried, "part int, _ahead long")
    inside = F.max("cut").over(Window.partitionBy("part").orderBy("id"))
    pieced = mine.withColumn("_in", inside).join(F.broadcast(carry), "part").select("id", F.coalesce("_in", "_ahead").alias("piece"), "parent")
    pieced = materialised(pieced, "pieces")
    # Every piece hangs on the last message of another one, as a message with a fork ends its piece.
    pieces = pieced.groupBy("piece").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("end"), F.min_by("parent", "id").alias("parent"))
    pieces = materialised(pieces, "tree")
    ends = pieces.select(F.col("end").alias("_end"), F.col("piece").alias("above"))
    hung = pieces.join(ends, F.col("parent") == F.col("_end"), "left").select("piece", "n", "above")
    below = _next_in_group(hung.filter("above is not null").select("above", "piece"), "above", "piece").select("above", "piece", "next")
    first = below.groupBy("above").agg(F.min("piece").alias("first")).withColumnRenamed("above", "piece")
    # The tour: into a piece (2 * piece) and out of it (2 * piece + 1), each with what comes next; a sum to its end, by doubling.
    into, out = (lambda c: F.col(c) * 2), (lambda c: F.col(c) * 2 + 1)
    tree = materialised(hung.join(first, "piece", "left").join(below.select("piece", "next"), "piece", "left"), "tour")
    tour = tree.select(into("piece").alias("at"), F.coalesce(into("first"), out("piece")).alias("to"), F.col("n").alias("rest"))
    tour = tour.unionByName(tree.select(out("piece").alias("at"), F.coalesce(into("next"), out("above")).alias("to"), F.lit(0).cast("long").alias("rest")))
    tour = materialised(tour, "tour")
    while tour.filter("to is not null").head(1):
        ahead = tour.select(F.col("at").alias("to"), F.col("to").alias("_to"), F.col("rest").alias("_rest"))
        tour = materialised(tour.join(ahead, "to", "left").select("at", F.col("_to").alias("to"), (F.col("rest") + F.coalesce("_rest", F.lit(0))).alias("rest")), "tour")
    left = tour.filter("at % 2 = 0").select((F.col("at") / 2).cast("long").alias("piece"), "rest")
    return pieced.select("id", "piece").join(left, "piece")


def linked(messages: DataFrame) -> DataFrame:
    """conv_id, turn, role, position (reply order), said (turn order), reply_to (turn), by_quote, n_quoted, n_found (quoted lines), levels and text (own lines), a row for each message."""
    ordered = materialised(_ordered(messages), "ordered")
    parsed = materialised(ordered.select("id", "conv_id", "text").mapInArrow(_parse, _PARSED), "parsed")
    turns = ordered.select("id", "turn")
    units = parsed.select("id", F.explode("units").alias("u")).select("id", "u.*").join(turns, "id").filter("turn is not null")
    units = materialised(units, "units")
    votes = units.filter("level > 0").join(_sources(units), ["key", "level", "turn"])
    by_turn = votes.groupBy("id", "source").agg(F.sum("words").alias("words"), F.collect_list("at").alias("at"))
    best = by_turn.groupBy("id").agg(F.max(F.struct("words", F.col("source.id").alias("parent"), F.col("source.turn").alias("turn"))).alias("b"), F.size(F.array_distinct(F.flatten(F.flatten(F.collect_list("at"))))).alias("n_found"))
    best = materialised(best.select("id", "b.parent", F.col("b.turn").alias("to_turn"), "n_found"), "best")
    rows = ordered.drop("text").join(best, "id", "left").join(parsed.drop("units"), "id")
    before = turns.select(F.col("id").alias("before"), F.col("turn").alias("turn_before"))
    rows = rows.join(before, "before", "left")
    jumps = materialised(ordered.select("id", "before").join(best.select("id", "parent"), "id").filter("parent <> before").select("id", "parent"), "jumps")
    position = F.col("said")
    if jumps.head(1):
        placed = _reply_order(ordered.select("id", "part", "conv_id", "said", "before"), jumps)
        # A conversation's messages are numbered from its first one on; said counts them in a piece.
        heads = ordered.select(F.col("id").alias("piece"), F.col("said").alias("_head"))
        sizes = ordered.groupBy("conv_id").agg(F.count(F.lit(1)).alias("_all")).withColumnRenamed("conv_id", "_conv")
        rows = rows.join(placed.join(heads, "piece").select("id", "rest", "_head"), "id", "left").join(sizes, F.col("conv_id").eqNullSafe(F.col("_conv")))
        position = F.when(F.col("rest").isNotNull(), F.col("_all") - F.col("rest") + F.col("said") - F.col("_head")).otherwise(F.col("said"))
    return rows.select(
        "conv_id", "turn", "role", position.alias("position"), "said", F.when(F.col("parent").isNotNull(), F.col("to_turn")).otherwise(F.col("turn_before")).alias("reply_to"),
        F.col("parent").isNotNull().alias("by_quote"), "n_quoted", F.coalesce("n_found", F.lit(0)).cast("long").alias("n_found"), "levels", "text",
    )


def op10_quote_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
