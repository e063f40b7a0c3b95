"""Exact n-gram Jaccard self-join by set-relation skipping.

A document's set holds the hashes of its distinct shingles. Documents with equal sets are one class; the rest
of the work is on one representative of each class. Shingles have one order for all sets, rare ones first, and
two sets with a Jaccard similarity of t or more share a shingle among the first n - ceil(t n) + 1 of each.

Skipping by answers: the least hash in each part of the hash space proposes a centre to each set; sets that are
exactly found to be linked with centres form first components. One of each component's sets is its root, and every
member keeps its exact distance from it. What is then known of the root holds for a member up to that distance
(Jaccard distance is a metric): sets of one component are never compared; of two components only the roots are, and
single members only where the roots' distance leaves it open.

Pairs are never listed one by one: a set is sent, with the list of those it may be linked with, once to each group of
documents that holds some of them, and only links come back (and distances of roots that leave their members open).

Before sets are counted, signatures are: the parities of a set's shingles by hash slot, two to four slots a shingle. Each
slot in which two sets differ stands for a shingle of one of them alone, so the slots bound the intersection from above,
and a pair whose bound is too low is done with. Signatures of different lengths are folded to the shorter one.

Skipping in the index: lists of sets by shingle keep the sets' sizes and the shingle's place in them. A list
is sorted by size, in blocks by place, and a block is skipped from the first place on at which too few
shingles are left for a sufficient overlap.

Intersections are counted on whole sets, so no link depends on the proposals. Texts are never shuffled as a whole:
sketches and index entries are made where a text is read, and to count intersections only texts that are in some pair
travel. They are picked by a broadcast table of hash slots of doc_ids, 64 in a row and ``SLOTS`` rows at most whatever the
input; what it lets pass by chance is dropped by the join after it.

Defined results: a null, empty or blank text has an empty set, no links and itself as its component; a null
doc_id takes no part in links and keeps a null component; rows with one doc_id are one
document, linked where one of their texts is, and each gets a row with the size of its own set; extra columns are ignored; an empty table gives none. Sets hold 48-bit
hashes: two different shingles of one document or pair are taken for one with a chance of about n*n / 2**49.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.grouping import FEW_BYTES, group_of, materialised
from tidemark.llm.words import Words, give_back, mix, text_chunks, window_hashes, window_starts

BITS = np.uint64(48)
_MASK = (np.uint64(1) << BITS) - np.uint64(1)
BANDS = 8
#: Shingles known to be frequent; the others count as rare and come in the order of their hashes. Only the order of
#: the index depends on it, no result.
HOT = 400_000
#: Shingles, about, that a task holds while it counts them.
COUNTED = 2_000_000
#: Bytes of text that are turned into shingles at a time; the arrays made of them meanwhile are many times larger.
CHUNK = 500_000


def shingle_sets(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct 48-bit shingle hashes of all documents, and the first of each document."""
    h, first = w.hashes(), w.first
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first)).astype(np.uint64)
    ok = window_starts(first, size)[: max(len(h) - size + 1, 0)]
    keys = [(doc[: len(ok)][ok] << BITS) | (window_hashes(h, size)[ok] >> np.uint64(16))]
    for n in range(1, size):  # a document of fewer words is one shingle
        at = first[:-1][w.counts == n]
        if len(at):
            keys.append((doc[at] << BITS) | (mix(window_hashes(h, n)[at] + np.uint64(n)) >> np.uint64(16)))
    keys = np.sort(np.concatenate(keys))
    if len(keys):
        keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])]
    return keys & _MASK, np.searchsorted(keys, np.arange(len(first), dtype=np.uint64) << BITS)


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    out = np.zeros(len(first) - 1, dtype=np.uint64)
    full = np.diff(first) > 0
    if full.any():
        out[full] = np.add.reduceat(values, first[:-1][full])
    return out


def _fingerprints(sets: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = np.diff(first).astype(np.uint64)
    return mix(_sums(mix(sets), first) + n).view(np.int64), mix(_sums(mix(sets ^ np.uint64(0x5BF03635)), first) + n).view(np.int64)


def _bands(sets: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each document the least shingle, plus one, in each of BANDS parts of the hash space; 0 where a part is empty."""
    n = len(first) - 1
    doc = np.repeat(np.arange(n), np.diff(first))
    place = doc * BANDS + (sets * np.uint64(BANDS) >> BITS).astype(np.int64)
    lead = np.concatenate([[True], place[1:] != place[:-1]]) if len(place) else np.zeros(0, bool)
    least = np.zeros(n * BANDS, dtype=np.uint64)
    least[place[lead]] = sets[lead] + np.uint64(1)
    return least.reshape(n, BANDS).view(np.int64)


def _signatures(sets: np.ndarray, first: np.ndarray) -> list[bytes]:
    """For each document the parity of the shingles in each of 2**k hash slots, the least k of 6 and more that gives two a shingle."""
    n = np.diff(first)
    slots = np.left_shift(1, np.maximum(6, np.ceil(np.log2(2 * np.maximum(n, 1))).astype(np.int64)))
    begin = np.concatenate([[0], np.cumsum(slots)])
    place = np.repeat(begin[:-1], n) + (sets.astype(np.int64) & np.repeat(slots - 1, n))
    packed = np.packbits((np.bincount(place, minlength=int(begin[-1])) & 1).astype(np.uint8)).tobytes()
    return [packed[a // 8 : b // 8] for a, b in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True)]


def _differing(x: np.ndarray, y: np.ndarray) -> int:
    """Slots in which two signatures differ: as many shingles, at least, are in one of the sets only."""
    if len(x) > len(y):
        x, y = y, x
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


_SKETCH = "hot boolean, doc_id long, n long, f1 long, f2 long, " + ", ".join(f"b{i} long" for i in range(BANDS)) + ", sig binary"


def _sketches(size: int):
    """Rows of two kinds: for each document its size, set hashes, bands and signature; for each frequent shingle of a batch its count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: list[np.ndarray] = []
        held, docs, many = np.zeros(0, np.int64), 0, 0

        def frequent() -> pa.RecordBatch:
            every = np.concatenate(seen)
            seen.clear()
            every.sort()
            # Only those that are the same as the one before them; most occur once.
            value, count = np.unique(every[1:][every[1:] == every[:-1]], return_counts=True)
            often = count + 1 >= max(2, docs // 4000)
            n = int(often.sum())
            return _rows(True, pa.nulls(n, pa.int64()), count[often] + 1, value[often].view(np.int64), np.zeros(n, np.int64), np.zeros((n, BANDS), np.int64), pa.nulls(n, pa.binary()))

        for batch in batches:
            for a, b, w in text_chunks(batch["text"], lower=True, limit=CHUNK):
                sets, first = shingle_sets(w, size)
                n, (f1, f2), bands = np.diff(first), _fingerprints(sets, first), _bands(sets, first)
                yield _rows(False, batch["doc_id"].slice(a, b - a), n, f1, f2, bands, pa.array(_signatures(sets, first), pa.binary()))
                _, once = np.unique(f1, return_index=True)
                new = np.zeros(len(n), dtype=bool)
                new[once] = True
                new &= ~np.isin(f1, held)
                held = np.concatenate([held, f1[new]])
                docs += int(new.sum())
                seen.append(sets[np.repeat(new, n)])
                many += len(seen[-1])
                if many >= COUNTED:
                    yield frequent()
                    held, docs, many = np.zeros(0, np.int64), 0, 0
        if seen:
            yield frequent()
        held = np.zeros(0, np.int64)
        give_back()

    return run


def _rows(hot: bool, doc, n, f1, f2, bands, sig) -> pa.RecordBatch:
    if isinstance(doc, pa.ChunkedArray):
        doc = doc.combine_chunks()
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(n), hot)), doc, pa.array(n.astype(np.int64)), pa.array(f1), pa.array(f2)] + [pa.array(bands[:, i].copy()) for i in range(BANDS)] + [sig], ["hot", "doc_id", "n", "f1", "f2"] + [f"b{i}" for i in range(BANDS)] + ["sig"])


def _chosen(group: pa.Table, docs: np.ndarray, size: int) -> dict[int, list[np.ndarray]]:
    """The sets of the rows with these doc_ids."""
    found: dict[int, list[np.ndarray]] = {}
    rows = group.filter(pa.array(np.isin(group["doc_id"].to_numpy(), docs)))
    ids = rows["doc_id"].to_pylist()
    for a, b, w in text_chunks(rows["text"], lower=True, limit=CHUNK):
        sets, first = shingle_sets(w, size)
        for i in range(b - a):
            if first[i + 1] > first[i]:
                found.setdefault(ids[a + i], []).append(sets[first[i] : first[i + 1]])
    return found


def _lists(column: pa.ChunkedArray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Offsets, and the fields of the values, of a column of lists of structs."""
    whole = pa.concat_arrays(column.chunks) if column.num_chunks != 1 else column.chunk(0)
    offsets = whole.offsets.to_numpy()
    values = whole.values.slice(offsets[0], offsets[-1] - offsets[0])
    return offsets - offsets[0], [values.field(i).to_numpy(zero_copy_only=False) for i in range(values.type.num_fields)]


def _bytes(values: np.ndarray) -> bytes:
    return values.view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _values(raw: bytes) -> np.ndarray:
    six = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    wide = np.zeros((len(six), 8), np.uint8)
    wide[:, :6] = six
    return wide.view(np.uint64).ravel()


def _overlap(x: list[np.ndarray], y: list[np.ndarray]) -> tuple[int, int, int]:
    """(intersection, sizes) of the two most similar sets of two documents."""
    best = (0, 1, 1)
    for s in x:
        for t in y:
            place = np.minimum(np.searchsorted(s, t), len(s) - 1)
            got = (int((s[place] == t).sum()), len(s), len(t))
            if got[0] * (best[1] + best[2] - best[0]) > best[0] * (got[1] + got[2] - got[0]):
                best = got
    return best


#: Rows, at most, of the table by which texts are picked; each row has 64 slots.
SLOTS = 1 << 18
#: Documents in a group while intersections are counted.
GROUP = 200


def _picked(docs: DataFrame, ids: DataFrame, column: str = "text") -> tuple[DataFrame, int]:
    """(g, doc_id, text, or another column) of the documents with these ids, and few more, and the number of groups."""
    slot = lambda c: F.pmod(F.xxhash64(c), F.lit(64 * SLOTS)).cast("int")
    ids = materialised(ids.distinct(), "ids")
    groups = max(1, -(-ids.count() // GROUP))
    slots = ids.select(slot("id").alias("slot")).select(F.expr("slot div 64").cast("int").alias("row"), F.expr("shiftleft(1L, slot % 64)").alias("bit"))
    used = slots.groupBy("row").agg(F.bit_or("bit").alias("bits"))
    placed = docs.select("doc_id", column, slot("doc_id").alias("slot"))
    picked = placed.join(F.broadcast(used), F.expr("slot div 64").cast("int") == F.col("row")).filter("(shiftrightunsigned(bits, slot % 64) & 1) = 1")
    return picked.select(group_of("doc_id", groups).alias("g"), "doc_id", column), groups


def _concerned(tries: DataFrame) -> DataFrame:
    """The ids of both sides of (a, bs)."""

    def distinct_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate([batch["a"].to_numpy(), batch["bs"].flatten().to_numpy()])))], ["id"])

    return tries.select("a", F.transform("bs", lambda x: x["b"]).alias("bs")).mapInArrow(distinct_ids, "id long")


def _sent(tries: DataFrame, grouped: DataFrame, groups: int, raws) -> DataFrame:
    """(g, a, wide, sets, b, b_wide): for each a of the tries, once to each group that holds some of its bs, what ``raws`` has of it."""
    to = lambda x: F.struct(F.pmod(F.xxhash64(x["b"]), F.lit(groups)).cast("int").alias("g"), x["b"].alias("b"), x["wide"].alias("wide"))
    routed = tries.select(group_of("a", groups).alias("g"), "a", "wide", F.transform("bs", to).alias("bs"))
    fields = [("g", pa.int32()), ("a", pa.int64()), ("wide", pa.float64()), ("sets", pa.list_(pa.binary())), ("b", pa.list_(pa.int64())), ("b_wide", pa.list_(pa.float64()))]

    def send(group: pa.Table, wanted: pa.Table) -> pa.Table:
        if not len(wanted):
            return pa.table({name: pa.array([], kind) for name, kind in fields})
        ids, wide = wanted["a"].to_numpy(), wanted["wide"].to_numpy()
        raw = raws(group, ids)
        start, (g, b, b_wide) = _lists(wanted["bs"])
        row = np.repeat(np.arange(len(ids)), np.diff(start))
        order = np.lexsort((g, row))
        row, g, b, b_wide = row[order], g[order], b[order], b_wide[order]
        cut = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (g[1:] != g[:-1])]))
        ends = np.append(cut, len(row))
        out = pa.table([
            pa.array(g[cut].astype(np.int32)), pa.array(ids[row[cut]]), pa.array(wide[row[cut]]), pa.array([raw[a] for a in ids[row[cut]].tolist()], pa.list_(pa.binary())),
            pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(b)), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(b_wide)),
        ], [name for name, _ in fields])
        give_back()
        return out

    return grouped.groupBy("g").cogroup(routed.groupBy("g")).applyInArrow(send, "g int, a long, wide double, sets array<binary>, b array<long>, b_wide array<double>")


def _possible(tries: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """(a, wide, bs) without the pairs whose signatures leave neither a link nor, within their widths, an open pair."""
    tries = materialised(tries, "tries", FEW_BYTES)
    signed = sketches.filter("not hot and n > 0").select("doc_id", F.struct("n", "sig").alias("sig"))
    grouped, groups = _picked(signed, _concerned(tries), "sig")

    def chosen(group: pa.Table, docs: np.ndarray) -> dict[int, list[tuple[int, bytes]]]:
        found: dict[int, list[tuple[int, bytes]]] = {}
        rows = group.filter(pa.array(np.isin(group["doc_id"].to_numpy(), docs)))
        for doc, sig in zip(rows["doc_id"].to_pylist(), rows["sig"].to_pylist(), strict=True):
            found.setdefault(doc, []).append((sig["n"], sig["sig"]))
        return found

    def raws(group: pa.Table, docs: np.ndarray) -> dict[int, list[bytes]]:
        return {a: [n.to_bytes(8, "little") + sig for n, sig in sigs] for a, sigs in chosen(group, docs).items()}

    def bound(group: pa.Table, wanted: pa.Table) -> pa.Table:
        out: list[tuple] = []
        words = lambda raw: np.frombuffer(raw, np.uint64)
        own = chosen(group, np.unique(wanted["b"].combine_chunks().flatten().to_numpy())) if len(wanted) else {}
        sigs = {b: [(n, words(sig)) for n, sig in of] for b, of in own.items()}
        for a, a_wide, raws, others, widths in zip(*(wanted[k] for k in ("a", "wide", "sets", "b", "b_wide")), strict=True):
            mine, a_wide, left = [(int(w[0]), w[1:]) for w in map(words, raws.as_py())], a_wide.as_py(), []
            for b, wide in zip(others.as_py(), widths.as_py(), strict=True):
                for (na, x), (nb, y) in ((x, y) for x in mine for y in sigs[b]):
                    most = min(na, nb, (na + nb - _differing(x, y)) // 2)
                    reach = a_wide + wide
                    if 100 * most >= percent * (na + nb - most) or (reach > 0 and 1 - most / (na + nb - most) - reach <= 1 - percent / 100 + 1e-9):
                        left.append({"b": b, "wide": wide})
                        break
            if left:
                out.append((a.as_py(), a_wide, left))
        a, wide, bs = zip(*out, strict=True) if out else ((), (), ())
        kind = pa.list_(pa.struct([("b", pa.int64()), ("wide", pa.float64())]))
        return pa.table({"a": pa.array(a, pa.int64()), "wide": pa.array(wide, pa.float64()), "bs": pa.array(bs, kind)})

    left = grouped.groupBy("g").cogroup(_sent(tries, grouped, groups, raws).groupBy("g")).applyInArrow(bound, "a long, wide double, bs array<struct<b:long,wide:double>>")
    return left.groupBy("a", "wide").agg(F.flatten(F.collect_list("bs")).alias("bs"))


def _verified(tries: DataFrame, docs: DataFrame, size: int, percent: int, all_pairs: bool) -> DataFrame:
    """a, b, apart, linked for (a, wide, bs: array of (b, wide)): links, and other pairs if they are asked for or open.

    A pair is open if its distance, less the two widths, is within the limit: then members may be linked.
    """
    tries = materialised(tries, "tries", FEW_BYTES)
    grouped, groups = _picked(docs, _concerned(tries))
    sent = _sent(tries, grouped, groups, lambda group, ids: {a: [_bytes(v) for v in vs] for a, vs in _chosen(group, ids, size).items()})

    def count(group: pa.Table, wanted: pa.Table) -> pa.Table:
        out: list[tuple] = []
        sets = _chosen(group, np.unique(wanted["b"].combine_chunks().flatten().to_numpy()), size) if len(wanted) else {}
        for a, a_wide, raws, others, widths in zip(*(wanted[k] for k in ("a", "wide", "sets", "b", "b_wide")), strict=True):
            mine, a, a_wide = [_values(raw) for raw in raws.as_py()], a.as_py(), a_wide.as_py()
            for b, wide in zip(others.as_py(), widths.as_py(), strict=True):
                same, na, nb = _overlap(mine, sets[b])
                linked, apart, reach = 100 * same >= percent * (na + nb - same), 1 - same / (na + nb - same), a_wide + wide
                if linked or all_pairs or (reach > 0 and apart - reach <= 1 - percent / 100 + 1e-9):
                    out.append((a, b, apart, linked))
        a, b, apart, linked = zip(*out, strict=True) if out else ((), (), (), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "apart": pa.array(apart, pa.float64()), "linked": pa.array(linked, pa.bool_())})

    return materialised(grouped.groupBy("g").cogroup(sent.groupBy("g")).applyInArrow(count, "a long, b long, apart double, linked boolean"), "verified")


def _members_linked(open_: DataFrame, members: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Links (a, b) between members of the open pairs of roots, one at least for each member that has any.

    Each member of the smaller component is sent to the groups that hold members of the larger one, and compared there with
    those that the distances from the roots leave open, until a link is found.
    """
    slack = 1 - percent / 100 + 1e-9
    sizes = members.groupBy("root").agg(F.count(F.lit(1)).alias("n"))
    size_of = lambda k: sizes.select(F.col("root").alias(k), F.col("n").alias(f"n_{k}"))
    sided = open_.join(size_of("a"), "a").join(size_of("b"), "b")
    small = F.col("n_a") <= F.col("n_b")
    sided = sided.select(F.when(small, F.col("a")).otherwise(F.col("b")).alias("from"), F.when(small, F.col("b")).otherwise(F.col("a")).alias("to"), "apart")
    sided = materialised(sided, "sided")
    concerned = sided.select(F.explode(F.array("from", "to")).alias("root")).distinct()
    members = materialised(members.join(concerned, "root"), "members")
    grouped, groups = _picked(docs, members.select(F.col("node").alias("id")))
    placed = members.withColumn("g", group_of("node", groups))
    holders = placed.groupBy("root").agg(F.collect_set("g").alias("gs")).withColumnRenamed("root", "to")
    routed = sided.join(holders, "to").join(placed.withColumnRenamed("root", "from"), "from").select("g", F.col("node").alias("a"), "to", (F.col("apart") - F.col("far")).alias("apart"), "gs")

    def send(group: pa.Table, wanted: pa.Table) -> pa.Table:
        sets = _chosen(group, wanted["a"].to_numpy(), size) if len(wanted) else {}
        raw = {a: [_bytes(v) for v in vs] for a, vs in sets.items()}
        rows = [(g, r["a"], r["to"], r["apart"], raw[r["a"]]) for r in wanted.to_pylist() for g in r["gs"]]
        g, a, to, apart, values = zip(*rows, strict=True) if rows else ((),) * 5
        return pa.table({"g": pa.array(g, pa.int32()), "node": pa.array(a, pa.int64()), "root": pa.array(to, pa.int64()), "far": pa.array(apart, pa.float64()), "sets": pa.array(values, pa.list_(pa.binary()))})

    sent = grouped.groupBy("g").cogroup(routed.groupBy("g")).applyInArrow(send, "g int, node long, root long, far double, sets array<binary>")
    local = placed.select("g", "node", "root", "far", F.lit(None).cast("array<binary>").alias("sets"))

    def find(group: pa.Table, wanted: pa.Table) -> pa.Table:
        rows = wanted.to_pylist()
        own: dict[int, list[tuple[int, float]]] = {}
        for r in rows:
            if r["sets"] is None:
                own.setdefault(r["root"], []).append((r["node"], r["far"]))
        coming = [r for r in rows if r["sets"] is not None]
        needed = [node for r in {r["root"] for r in coming} for node, _ in own.get(r, ())]
        sets = _chosen(group, np.array(needed, np.int64), size) if needed else {}
        out = []
        for r in coming:
            mine = [_values(raw) for raw in r["sets"]]
            for node, far in own.get(r["root"], ()):
                if r["far"] - far <= slack:
                    same, na, nb = _overlap(mine, sets[node])
                    if 100 * same >= percent * (na + nb - same):
                        out.append((r["node"], node))
                        break
        a, b = zip(*out, strict=True) if out else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return materialised(grouped.groupBy("g").cogroup(sent.unionByName(local).groupBy("g")).applyInArrow(find, "a long, b long"), "found")


def _entries(size: int, percent: int, hot: np.ndarray, times: np.ndarray):
    """The first shingles, in the common order, of each set; a task gives equal sets once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: set[int] = set()
        for batch in batches:
            for _, _, w in text_chunks(pa.chunked_array([batch["text"]]), lower=True, limit=CHUNK):
                sets, first = shingle_sets(w, size)
                nodes = _fingerprints(sets, first)[0].tolist()
                new = np.zeros(len(nodes), dtype=bool)
                for i, node in enumerate(nodes):
                    if first[i + 1] > first[i] and node not in held:
                        held.add(node)
                        new[i] = True
                n = np.diff(first)
                doc = np.repeat(np.arange(len(n)), n)
                if len(hot):
                    place = np.minimum(np.searchsorted(hot, sets), len(hot) - 1)
                    rate = np.where(hot[place] == sets, times[place], 0)
                    often = rate > 0
                    # Rare ones are in order; where a set has frequent ones, it is sorted anew.
                    for i in np.unique(doc[often]).tolist():
                        a, b = first[i], first[i + 1]
                        sets[a:b] = sets[a:b][np.argsort(rate[a:b], kind="stable")]
                place = np.arange(len(sets)) - np.repeat(first[:-1], n)
                reach = n - (percent * n + 99) // 100 + 1
                use = new[doc] & (place < reach[doc])
                ids = np.array(nodes, dtype=np.int64)[doc[use]]
                yield pa.RecordBatch.from_arrays([pa.array(sets[use].view(np.int64)), pa.array(ids), pa.array((n[doc[use]] << 32) + place[use])], ["h", "f1", "place"])

    return run


#: Sets in a block of an index list.
BLOCK = 256


def _list_pairs(root: np.ndarray, n: np.ndarray, place: np.ndarray, percent: int) -> np.ndarray:
    """Pairs of different roots in one index list that size and place leave open."""
    order = np.lexsort((place, n))
    root, n, place = root[order], n[order], place[order]
    rest = n - place  # shingles from here on, this one included
    found = []
    for lo in range(0, len(n), BLOCK):  # larger sets, a block at a time
        hi = min(lo + BLOCK, len(n))
        least = np.searchsorted(n, -(-percent * n[lo] // 100))
        for at in range(least - least % BLOCK, hi, BLOCK):  # smaller or equal ones
            to = min(at + BLOCK, hi)
            # The whole block is skipped if even its best place leaves too few shingles for its smallest set.
            if min(rest[at:to].max(), rest[lo:hi].max()) * (100 + percent) < percent * (n[at] + n[lo]):
                continue
            x, y = np.ix_(np.arange(at, to), np.arange(lo, hi))
            ok = (root[x] != root[y]) & (100 * n[x] >= percent * n[y]) & (np.minimum(rest[x], rest[y]) * (100 + percent) >= percent * (n[x] + n[y])) & (x < y)
            i, j = np.nonzero(ok)
            if len(i):
                pairs = np.stack([root[at + i], root[lo + j]], axis=1)
                found.append(np.unique(np.sort(pairs, axis=1), axis=0))
    return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), np.int64)


#: Pairs of roots that a task holds before equal ones are merged.
HELD = 200_000


def _scan_lists(percent: int):
    """(a, bs): candidate pairs of roots, from rows sorted by shingle; a list may go on in the next batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        found: list[np.ndarray] = []

        many = 0

        def scan(rows: np.ndarray) -> None:
            nonlocal many
            bounds = np.concatenate([[0], np.flatnonzero(rows[1:, 0] != rows[:-1, 0]) + 1, [len(rows)]])
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                if b - a > 1 and (rows[a:b, 1] != rows[a, 1]).any():
                    found.append(_list_pairs(rows[a:b, 1], rows[a:b, 2] >> 32, rows[a:b, 2] & 0xFFFFFFFF, percent))
                    many += len(found[-1])
                    if many > HELD:
                        merged = np.unique(np.concatenate(found), axis=0)
                        found[:] = [merged]
                        if len(merged) > HELD // 2:
                            ready.append(merged)
                            found.clear()
                        many = sum(map(len, found))

        def give(pairs: np.ndarray) -> pa.RecordBatch:
            a, start = np.unique(pairs[:, 0], return_index=True)
            b = pairs[:, 1]
            far = lambda roots: np.fromiter((width.get(x, 0.0) for x in roots.tolist()), np.float64, len(roots))
            partners = pa.StructArray.from_arrays([pa.array(b.copy()), pa.array(far(b))], ["b", "wide"])
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(far(a)), pa.ListArray.from_arrays(pa.array(np.append(start, len(b)), pa.int32()), partners)], ["a", "wide", "bs"])

        width: dict[int, float] = {}  # of roots with members
        ready: list[np.ndarray] = []
        for batch in batches:
            rows = np.stack([batch[k].to_numpy(zero_copy_only=False) for k in ("h", "root", "place")], axis=1)
            if not len(rows):
                continue
            wide = batch["wide"].to_numpy()
            for i in np.flatnonzero(wide).tolist():
                width[int(rows[i, 1])] = float(wide[i])
            cut = int(np.searchsorted(rows[:, 0], rows[-1, 0]))
            if cut:
                scan(np.concatenate([*held, rows[:cut]]))
                held = []
            held.append(rows[cut:])
            while ready:
                yield give(ready.pop())
        if held:
            scan(np.concatenate(held))
        if sum(map(len, found)):
            ready.append(np.unique(np.concatenate(found), axis=0))
        while ready:
            yield give(ready.pop())

    return run


def links(docs: DataFrame, size: int = 5, percent: int = 75) -> tuple[DataFrame, DataFrame]:
    """(members, edges): each document with its size and node (the smallest doc_id with an equal set), and edges (u, v) between nodes.

    The edges tie all nodes that links tie. Links inside a component that is known already aren't counted one by one.
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketches = materialised(slim.mapInArrow(_sketches(size), _SKETCH), "sketches", FEW_BYTES)
    bands = [f"b{i}" for i in range(BANDS)]
    usable = sketches.filter("not hot and n > 0 and doc_id is not null")
    classes = usable.groupBy("f1", "f2").agg(F.min(F.struct("doc_id", "n", *bands)).alias("r")).select("f1", "f2", "r.*").withColumnRenamed("doc_id", "node")
    classes = materialised(classes, "classes")
    members = usable.select("doc_id", "n", "f1", "f2").join(classes.select("f1", "f2", "node"), ["f1", "f2"]).select("doc_id", "n", "node")
    others = sketches.filter("not hot and (n = 0 or doc_id is null)").select("doc_id", "n", F.lit(None).cast("long").alias("node"))
    top = sketches.filter("hot").groupBy("f1").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "f1").limit(HOT).toArrow().sort_by("f1")
    hot, times = top["f1"].to_numpy().view(np.uint64), top["n"].to_numpy()

    # Several texts of one doc_id tie their classes.
    same_id = members.groupBy("doc_id").agg(F.min("node").alias("u"), F.collect_set("node").alias("vs")).filter("size(vs) > 1").select("u", F.explode("vs").alias("v"))
    # Centres: in each band the node with the smallest id.
    by_band = classes.select("node", "n", F.posexplode(F.array(*bands)).alias("band", "key")).filter("key <> 0")
    centre = by_band.groupBy("band", "key").agg(F.min(F.struct("node", "n")).alias("c"), F.count(F.lit(1)).alias("many")).filter("many > 1")
    proposed = by_band.join(centre, ["band", "key"]).filter(f"node <> c.node and 100 * least(n, c.n) >= {percent} * greatest(n, c.n)").select(F.col("c.node").alias("a"), F.col("node").alias("b")).distinct()
    single = lambda pairs: pairs.select("a", F.lit(0.0).alias("wide"), F.array(F.struct("b", F.lit(0.0).alias("wide"))).alias("bs"))
    first = _verified(_possible(single(proposed), sketches, percent), slim, size, percent, True)
    roots = materialised(components(first.filter("linked").select(F.col("a").alias("u"), F.col("b").alias("v"))), "roots")
    # Every member's distance from its root, counted unless it was already.
    rooted = roots.select(F.col("root").alias("a"), F.col("node").alias("b"))
    rest = _verified(single(rooted.join(first, ["a", "b"], "left_anti")), slim, size, percent, True)
    far = rooted.join(first.unionByName(rest), ["a", "b"]).select(F.col("a").alias("root"), F.col("b").alias("node"), F.col("apart").alias("far"))
    far = materialised(far.unionByName(roots.select("root", F.col("root").alias("node"), F.lit(0.0).alias("far")).distinct()), "far")
    wide = far.groupBy("root").agg(F.max("far").alias("wide"))

    entries = slim.filter("doc_id is not null").mapInArrow(_entries(size, percent, hot, times), "h long, f1 long, place long").repartition("h")
    # Lists of one set, or of the sets of one component, are settled. The rest are few.
    differ = lambda c: F.min(c).over(Window.partitionBy("h")) != F.max(c).over(Window.partitionBy("h"))
    lists = entries.withColumn("differ", differ("f1")).filter("differ").select("h", "f1", "place")
    rooted_as = far.join(wide, "root").select("node", "root", "wide")
    named = classes.select("f1", "node").join(rooted_as, "node", "left").select("f1", F.coalesce("root", "node").alias("root"), F.coalesce("wide", F.lit(0.0)).alias("wide"))
    lists = lists.join(named, "f1").select("h", "root", "place", "wide")
    lists = lists.withColumn("differ", differ("root")).filter("differ").select("h", "root", "place", "wide").sortWithinPartitions("h")
    found = lists.mapInArrow(_scan_lists(percent), "a long, wide double, bs array<struct<b:long,wide:double>>")
    tries = found.groupBy("a", "wide").agg(F.array_distinct(F.flatten(F.collect_list("bs"))).alias("bs"))
    second = _verified(_possible(tries, sketches, percent), slim, size, percent, False)
    edges = same_id.unionByName(first.unionByName(rest).unionByName(second).filter("linked").select(F.col("a").alias("u"), F.col("b").alias("v")))
    # Where the distance of two roots leaves it open, their members are compared, as far as the distances allow.
    open_ = second.filter("not linked").select("a", "b", "apart")
    if open_.head(1):
        alone = open_.select(F.explode(F.array("a", "b")).alias("root")).distinct().join(far, "root", "left_anti")
        full = far.unionByName(alone.select("root", F.col("root").alias("node"), F.lit(0.0).alias("far")))
        edges = edges.unionByName(_members_linked(open_, full, slim, size, percent).select(F.col("a").alias("u"), F.col("b").alias("v")))
    return members.unionByName(others), edges


def jaccard_components(docs: DataFrame, size: int = 5, percent: int = 75) -> DataFrame:
    """doc_id, n_shingles, component_id: the smallest doc_id that links of at least ``percent`` / 100 reach."""
    members, edges = links(docs, size, percent)
    roots = components(edges)
    return members.join(roots, "node", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("root", "node", "doc_id").alias("component_id"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
