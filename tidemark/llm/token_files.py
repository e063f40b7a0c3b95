"""Token ids in files of patched frame-of-reference blocks.

``write_tokens`` range-partitions documents by doc_id, encodes them, and writes a folder of Parquet files whose rows are
segments: about ``SEGMENT_IDS`` ids of whole documents, with an index of the documents and of the block starts. A
segment's ids are cut into blocks of ``BLOCK`` ids. A block keeps its least id, a width that a set share of its
ids (less the least one) fit into, those ids' low bits at that width, and the rest as a list of exceptions.

A segment's bytes, little-endian: magic ``TMK1``, number of ids (u32), of blocks (u32), of exceptions (u32); for each
block its least id (u32), width (u8) and number of exceptions (u16); packed ids, four 64-bit words for each bit of
the width; for each exception its place in the block (u8) and its id less the least one (u32). ``block_starts`` has
the byte at which each block's packed ids begin.

Spark's own writer commits the files, so tasks that are run again, or twice, leave one result, and any store will do.

Defined results: a null or empty text has the end id alone; documents stand in ascending doc_id order, a null doc_id
first; rows with one doc_id follow each other in any order; extra columns are ignored; an empty table gives none.
"""

from __future__ import annotations

import codecs
import json
import os
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.grouping import FEW_BYTES, shared_dir, small_batches
from tidemark.llm.words import give_back

BLOCK = 256
#: Share of a block's ids that the width must hold.
PERCENTILE = 0.9
SEGMENT_IDS = 1 << 18
END_ID = 1
#: Bytes, about, of the words whose ids an encoder remembers, in two halves: when the newer one is full it becomes the
#: older one, whose words are taken over when they come again.
REMEMBERED = 96_000_000
#: What a remembered word takes besides its own bytes: its object, its place in the table and its bounds; about.
_ENTRY = 160
_LANES = 64
#: Fixed value: how the tokenizer's file splits a text into pieces.
PIECE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Maps bytes to a space for white space, ``p`` for other ASCII signs, ``q`` for leading bytes beyond Latin-1 letters, else ``a``.
_SIGNS = bytes(
    ord(" ") if b in (9, 10, 11, 12, 13, 32) else ord("q") if b > 0xC3 or b in (0xC0, 0xC1, 0xC2) else ord("a") if b > 127 or chr(b).isalnum() else ord("p") for b in range(256)
)
#: The leading bytes of characters beyond Latin-1.
_BEYOND = re.compile(rb"[\xc4-\xff]").search
# Byte-level models write a byte as a printable sign: itself where that is printable in Latin-1, else the next free one.
_PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTE_SIGNS = {b: b for b in _PRINTED} | {b: 0x100 + i for i, b in enumerate(x for x in range(256) if x not in _PRINTED)}
_SIGN_OF_BYTE = "".join(chr(_BYTE_SIGNS[b]) for b in range(256))


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """(blocks, BLOCK) values below 2**width -> (blocks, BLOCK * width / 64) words."""
    lanes = values.reshape(len(values), BLOCK // _LANES, _LANES)
    out = np.zeros((len(values), BLOCK // _LANES, width), dtype=np.uint64)
    for j in range(_LANES):
        word, off = divmod(j * width, 64)
        out[:, :, word] |= lanes[:, :, j] << np.uint64(off)
        if off + width > 64:
            out[:, :, word + 1] |= lanes[:, :, j] >> np.uint64(64 - off)
    return out.reshape(len(values), -1)


def _unpack(words: np.ndarray, width: int) -> np.ndarray:
    packed = words.reshape(len(words), BLOCK // _LANES, width)
    out = np.empty((len(words), BLOCK // _LANES, _LANES), dtype=np.uint64)
    mask = np.uint64((1 << width) - 1)
    for j in range(_LANES):
        word, off = divmod(j * width, 64)
        got = packed[:, :, word] >> np.uint64(off)
        if off + width > 64:
            got = got | (packed[:, :, word + 1] << np.uint64(64 - off))
        out[:, :, j] = got & mask
    return out.reshape(len(words), BLOCK)


def pack_segment(ids: np.ndarray) -> tuple[bytes, np.ndarray]:
    """A segment's bytes and its block starts. ``ids`` are unsigned 32-bit."""
    n, blocks = len(ids), -(-len(ids) // BLOCK)
    full = np.full(blocks * BLOCK, ids[-1] if n else 0, dtype=np.uint64)
    full[:n] = ids
    full = full.reshape(blocks, BLOCK)
    least = full.min(axis=1) if blocks else np.zeros(0, np.uint64)
    full = full - least[:, None]
    bits = np.frexp(full.astype(np.float64))[1].astype(np.uint8)
    at = max(int(np.ceil(PERCENTILE * BLOCK)) - 1, 0)
    width = np.maximum(np.partition(bits, at, axis=1)[:, at], 1) if blocks else np.zeros(0, np.uint8)
    odd = bits > width[:, None]
    row, place = np.nonzero(odd)
    low = full & ((np.uint64(1) << width.astype(np.uint64)) - np.uint64(1))[:, None]
    sizes = width.astype(np.int64) * (BLOCK // _LANES)
    start = np.concatenate([[0], np.cumsum(sizes)])
    words = np.zeros(int(start[-1]), dtype=np.uint64)
    for w in np.unique(width).tolist():
        which = np.flatnonzero(width == w)
        words[start[which][:, None] + np.arange(w * (BLOCK // _LANES))] = _pack(low[which], w)
    head = b"TMK1" + np.array([n, blocks, len(row)], "<u4").tobytes()
    head += least.astype("<u4").tobytes() + width.astype("u1").tobytes() + odd.sum(axis=1).astype("<u2").tobytes()
    data = head + words.astype("<u8").tobytes() + place.astype("u1").tobytes() + full[row, place].astype("<u4").tobytes()
    return data, len(head) + start[:-1] * 8


def unpack_segment(data: bytes | pa.Buffer) -> np.ndarray:
    if bytes(data[:4]) != b"TMK1":
        raise ValueError("not a segment of token ids")
    n, blocks, extra = np.frombuffer(data, "<u4", 3, 4).tolist()
    at = 16
    parts = []
    for kind, many in (("<u4", blocks), ("u1", blocks), ("<u2", blocks)):
        parts.append(np.frombuffer(data, kind, many, at))
        at += parts[-1].nbytes
    least, width, odd = parts
    start = np.concatenate([[0], np.cumsum(width.astype(np.int64) * (BLOCK // _LANES))])
    words = np.frombuffer(data, "<u8", int(start[-1]), at)
    at += words.nbytes
    place = np.frombuffer(data, "u1", extra, at)
    value = np.frombuffer(data, "<u4", extra, at + extra)
    out = np.zeros((blocks, BLOCK), dtype=np.uint64)
    for w in np.unique(width).tolist():
        which = np.flatnonzero(width == w)
        out[which] = _unpack(words[start[which][:, None] + np.arange(w * (BLOCK // _LANES))], w)
    out[np.repeat(np.arange(blocks), odd), place] = value
    return (out + least.astype(np.uint64)[:, None]).reshape(-1)[:n].astype(np.uint32)


class Encoder:
    """A tokenizer of the tokenizers library, with a memory of words.

    White space always splits for this kind of tokenizer, so a text's ids are those of its words in turn. ASCII capitals
    are lower-cased first where that can't matter: no combining marks, no strings of special tokens.
    """

    def __init__(self, path: str, remembered: int | None = None):
        self.remembered = REMEMBERED if remembered is None else remembered
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model.tokenize  # each access to a tokenizer's model makes an object
        give_back()

        def parts(of: object, many: str) -> list[dict]:
            said = json.loads(of.__getstate__()) if of else {}  # this part alone: the whole file as objects takes more than the tokenizer
            return said.get(many) or ([said] if said else [])

        normal, kinds = parts(self.tokenizer.normalizer, "normalizers"), parts(self.tokenizer.pre_tokenizer, "pretokenizers")
        # Words are taken one by one, and pieces split here, only where the file says how, and that way is this one; else
        # the library gets whole texts.
        self.split = None
        if [k["type"] for k in normal] == ["NFC", "Replace", "Lowercase"] and normal[1]["pattern"].get("Regex") == r"\s+" and normal[1]["content"] == " ":
            if [k["type"] for k in kinds] == ["Split", "ByteLevel"] and kinds[0]["pattern"].get("Regex") == PIECE:
                self.split = regex.compile(PIECE).findall
        self.older: tuple[dict[bytes, int], np.ndarray, np.ndarray] = ({}, np.zeros(0, np.uint32), np.zeros(1, np.int64))
        self.pieces: dict[str, list[int]] = {}
        self._begin()

    def _begin(self) -> None:
        self.known: dict[bytes, int] = {}
        self.ids = np.zeros(1 << 20, dtype=np.uint32)
        self.bounds = np.zeros(1 << 18, dtype=np.int64)
        self.n = self.size = self.end = 0
        self.ids[0], self.bounds[1], self.n = END_ID, 1, 1  # the end id, at place ``end``; no word has it

    def _add(self, words: list[bytes], ids: list[list[int]]) -> None:
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        a, end = int(self.bounds[self.n]), self.n + len(ids)
        b = a + int(sizes.sum())
        if b > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(max(len(self.ids), b - a), np.uint32)])
        if end + 1 > len(self.bounds):
            self.bounds = np.concatenate([self.bounds, np.zeros(max(len(self.bounds), len(ids) + 1), np.int64)])
        self.ids[a:b] = np.fromiter(chain.from_iterable(ids), np.uint32, b - a)
        self.bounds[self.n + 1 : end + 1] = a + np.cumsum(sizes)
        self.known.update(zip(words, range(self.n, end), strict=True))
        self.n = end
        self.size += sum(map(len, words)) + _ENTRY * len(words)

    def _ids(self, piece: str) -> list[int]:
        raw = piece if piece.isascii() else codecs.charmap_decode(piece.encode(), "strict", _SIGN_OF_BYTE)[0]
        return [x.id for x in self.model(raw)]

    def _piece(self, piece: str) -> list[int]:
        """The ids of a part of a word; words that are one piece are remembered as words."""
        got = self.pieces.get(piece)
        if got is None:
            got = self.pieces[piece] = self._ids(piece)
        return got

    def _learn(self, words: list[bytes]) -> None:
        """Remembers the ids of new words. Latin-1 words are normal as they are, and the library's model takes their pieces."""
        if len(self.pieces) * 8 * _ENTRY > self.remembered:
            self.pieces.clear()
        plain, other, ids, piece, model = [], [], [], self._piece, self.model
        held, held_ids, bounds = self.older
        for w in words:
            at = held.get(w) if held else None
            if at is not None:
                plain.append(w)
                ids.append(held_ids[bounds[at] : bounds[at + 1]].tolist())
                continue
            text = w.decode()
            if w.isalpha():  # ASCII letters
                plain.append(w)
                ids.append([x.id for x in model(text.lower())])
            elif w[:-1].isalpha() and w[-1:] in b",.!":
                plain.append(w)
                ids.append(piece(text[:-1].lower()) + piece(text[-1]))
            elif not _BEYOND(w) and text.isprintable() and "<|" not in text:
                plain.append(w)
                text = text.lower()
                ids.append(self._ids(text) if text.isalpha() else list(chain.from_iterable(map(piece, self.split(text)))))
            else:
                other.append(w)
        self._add(plain, ids)
        self._add(other, [e.ids for e in self.tokenizer.encode_batch([w.decode() for w in other], add_special_tokens=False)])

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, each with the end id after it, and how many each text has."""
        if not self.split:
            ids = [[*e.ids, END_ID] for e in self.tokenizer.encode_batch([t.decode() for t in texts], add_special_tokens=False)]
            return np.fromiter(chain.from_iterable(ids), np.uint32), np.array([len(x) for x in ids], dtype=np.int64)
        words: list[bytes] = []
        counts = np.zeros(len(texts), dtype=np.int64)
        for i, text in enumerate(texts):
            plain = b"\xcc" not in text and b"\xcd" not in text and b"<|" not in text
            if plain:
                text = text.lower()
                # A stop beside no other sign is a piece of its own; set apart, words have fewer forms. Only where all
                # characters are ASCII or Latin-1 letters can that be told from bytes.
                signs = text.translate(_SIGNS)
                if b"pp" not in signs and b"q" not in signs and b"\xc3\x97" not in text and b"\xc3\xb7" not in text:
                    text = text.replace(b",", b" , ").replace(b".", b" . ")
            mine = text.split()
            words += mine
            counts[i] = len(mine)
        if self.size > self.remembered // 2:
            self.older = (self.known, self.ids[: self.bounds[self.n]].copy(), self.bounds[: self.n + 1].copy())
            self._begin()
        at = np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(at < 0)
        if len(new):
            unknown = [words[i] for i in new.tolist()]
            self._learn(list(set(unknown)))
            at[new] = np.fromiter(map(self.known.__getitem__, unknown), np.int64, len(unknown))
        lo, size = self.bounds[at], self.bounds[at + 1] - self.bounds[at]
        # An end id is a word of its own after each document's words, so that one gather makes all ids in order.
        ends = np.cumsum(counts)
        lo, size = np.insert(lo, ends, self.bounds[self.end]), np.insert(size, ends, 1)
        upto = np.cumsum(size)
        out = self.ids[np.repeat(lo - upto + size, size) + np.arange(int(upto[-1]) if len(upto) else 0)]
        each = np.diff(upto[ends + np.arange(len(texts))], prepend=0)
        return out, each


@lru_cache(maxsize=2)
def encoder(path: str, remembered: int | None = None) -> Encoder:
    return Encoder(path, remembered)


_SEGMENT = "file int, seg_start long, n_ids long, doc_ids array<long>, doc_sizes array<long>, block_starts array<int>, data binary"


def _segments(path: str, remembered: int | None = None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, start = TaskContext.get().partitionId(), 0
        held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []
        kind = [pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary()]

        def segment() -> pa.RecordBatch:
            nonlocal start
            ids, sizes = np.concatenate([x[1] for x in held]), np.concatenate([x[2] for x in held])
            data, starts = pack_segment(ids)
            row = [file, start, len(ids), pa.concat_arrays([x[0] for x in held]).to_pylist(), sizes.tolist(), starts.tolist(), data]
            start += len(ids)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kind, strict=True)], _names(_SEGMENT))

        for batch in batches:
            a = 0
            docs, texts = batch["doc_id"], batch["text"].cast(pa.large_binary())
            sizes = np.diff(np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]) if len(texts) else np.zeros(0, np.int64)
            while a < len(texts):
                b = max(a + 1, a + int(np.searchsorted(np.cumsum(sizes[a:]), SEGMENT_IDS)))
                ids, each = encoder(path, remembered).encode(texts.slice(a, b - a).to_pylist())
                held.append((docs.slice(a, b - a), ids, each))
                a = b
                if sum(len(x[1]) for x in held) >= SEGMENT_IDS:
                    yield segment()
                    give_back()
        if held:
            yield segment()

    return run


def _names(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


def write_tokens(docs: DataFrame, path: str, tokenizer: str, order: Sequence[str] = ("doc_id",), remembered: int | None = None) -> None:
    """Encodes the texts and writes them to ``path``, in ascending order (by doc_id, if not told) over the files' numbers.

    ``remembered``: bytes of words that an encoder remembers, ``REMEMBERED`` if not told; only time and memory depend on it.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *[F.col(k) for k in order if k != "doc_id"])
    ranged = slim.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order).sortWithinPartitions(*order).select("doc_id", "text")
    with small_batches(spark, FEW_BYTES):
        ranged.mapInArrow(_segments(tokenizer, remembered), _SEGMENT).write.parquet(path)


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    # A worker that has encoded would keep the encoder as long as it lives, in later stages too.
    encoder.cache_clear()
    give_back()
    for batch in batches:
        for i in range(len(batch)):
            row = {k: batch[k][i] for k in ("file", "seg_start", "doc_ids", "doc_sizes", "data")}
            ids = unpack_segment(row["data"].as_buffer())
            size = row["doc_sizes"].values.to_numpy()
            at = np.concatenate([[0], np.cumsum(size)])
            raw = pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer((at * 4).astype(np.int64).tobytes()), pa.py_buffer(ids.astype("<u4").tobytes())])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(size), row["file"].as_py(), np.int32)), row["doc_ids"].values, pa.array(row["seg_start"].as_py() + at[:-1]), pa.array(size), raw.cast(pa.binary())], ["file", "doc_id", "start", "n_tokens", "ids"])


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids (binary, little-endian unsigned 32-bit)."""
    files = spark.read.schema(_SEGMENT).parquet(path)
    # One row for each file that was written, so as many as there were shuffle partitions: the size of what is broadcast.
    sizes = files.groupBy("file").agg(F.sum("n_ids").alias("n"))
    base = sizes.select(F.col("file").alias("f"), F.coalesce(F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))

    docs = files.select("file", "seg_start", "doc_ids", "doc_sizes", "data").mapInArrow(_unpacked, "file int, doc_id long, start long, n_tokens long, ids binary")
    return docs.join(F.broadcast(base), F.col("file") == F.col("f")).select("doc_id", (F.col("start") + F.col("base")).alias("start"), "n_tokens", "ids")


def token_digest(docs: DataFrame, tokenizer: str | None = None, order: Sequence[str] = ("doc_id",), remembered: int | None = None) -> DataFrame:
    """Writes the documents' token files to the shared folder, in the given order, reads them back and digests what they hold."""
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    spark = docs.sparkSession
    path = shared_dir(spark, "tokens")
    write_tokens(docs, path, tokenizer, order, remembered)
    return read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digest(spark.read.parquet(f"{sf_dir}/documents.parquet"))
