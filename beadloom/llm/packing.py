"""Packing of documents into sequences along a space-filling curve.

A document is the ids of its words and an end id. The ids are hashed into a vector of FEATURES signed counts, whose roots
are projected to a few dimensions; the place there becomes a Hilbert key, and the rows are sorted into ranges of that key, so that neighbours on the curve are
neighbours in a range. Each range is one stream of ids, cut every `size` ids; what is left at its end is cut into powers
of two, which need no padding.

Defined cases: a null text is empty, and an empty document is its end id alone; equal texts have equal keys and go by
doc_id (null first) and then by their place in the table of ids, so that any number of copies and of repeated rows
spreads over ranges; a text of any length is cut into as many sequences as it needs; other columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import gc
import string
import struct
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SegmentCache, map_batches, materialise

SIZE = 2048
DIMENSIONS, BITS = 4, 12
#: Of a document's hashed vector.
FEATURES = 4096
#: Bytes of packed ids of a range, about, and ranges at most.
RANGE_BYTES, MAX_RANGES = 4 << 20, 20_000
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
#: Words of each generation of a task's cache.
CACHED = 400_000
#: Marks that can stand behind a word; a run of them is a piece of its own (the apostrophe begins other pieces).
_MARKS = "".join(c for c in string.punctuation if c != "'")


class WordEncoder:
    """Ids by the tokenizers library, for a vocabulary whose words are parted by white space, with bounded caches.

    Its normaliser turns line ends and tabs into spaces and no word of it reaches over a space, so texts are cut
    there. Words of Latin letters, whose lower case is plain, and marks behind them are looked up apart. A text that holds
    the string of an added token goes to the library as a whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        # strings of added tokens are found in the text itself, over any borders of words
        self.added = [x.content.lower() for x in self.tokenizer.get_added_tokens_decoder().values()]
        self.begins = sorted({a[:2] for a in self.added})
        self.char = "H" if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "I"
        self.dtype = np.dtype("<u2" if self.char == "H" else "<u4")
        # what the byte-level step makes of each Latin letter; a lower-case word then goes straight to the model
        split = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.tokenize = self.tokenizer.model.tokenize
        self.letters = {c: split(chr(c))[0][0] for c in range(0x21, 0x100) if not 0x7F <= c <= 0xA0}
        # words as they stand in texts, and in lower case without marks, of which most are words themselves: one entry for both
        self.words = SegmentCache(self._word, CACHED)

    @property
    def stems(self) -> SegmentCache:
        """What words are looked up by, which is kept among them."""
        return self.words

    def _stem(self, stem: str) -> bytes:
        """A run of lower-case Latin letters, or of marks."""
        return array(self.char, [t.id for t in self.tokenize(stem if stem.isascii() else stem.translate(self.letters))]).tobytes()

    def _encode(self, word: str) -> bytes:
        ids = self.tokenizer.encode(word, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}{self.char}", *ids)

    def _word(self, word: str) -> bytes:
        if word.isalpha() and (word.isascii() or max(word) < "Ā"):
            return self._stem(word) if word.islower() else self.words[word.lower()]
        stem = word.rstrip(_MARKS)
        if not stem:
            return self._stem(word)
        if len(stem) < len(word) and stem.isalpha() and (stem.isascii() or max(stem) < "Ā"):
            return self.words[stem.lower()] + self.words[word[len(stem) :]]
        return self._encode(word)

    def packed(self, text: str | None) -> bytes:
        if not text:
            return b""
        if any(a in text for a in self.begins) and any(a in text.lower() for a in self.added):
            return self._encode(text)
        return b"".join(map(self.words.__getitem__, text.replace("\n", " ").replace("\t", " ").split(" ")))


@lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    e = WordEncoder(path)
    gc.freeze()
    gc.set_threshold(200_000, 20, 50)
    return e


@lru_cache(maxsize=1)
def _axes() -> np.ndarray:
    return np.random.default_rng(3).standard_normal((FEATURES, DIMENSIONS)).astype(np.float32)


@lru_cache(maxsize=1)
def _hashed() -> tuple[np.ndarray, np.ndarray]:
    """(feature, sign) of each id below 2^16; larger ids share theirs."""
    x = np.arange(1 << 16, dtype=np.uint64)
    for m in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9):
        x = x * np.uint64(m) & np.uint64((1 << 64) - 1)
        x ^= x >> np.uint64(31)
    return (x % np.uint64(FEATURES)).astype(np.int64), np.where(x >> np.uint64(63), 1.0, -1.0)


def place(ids: np.ndarray) -> np.ndarray:
    """A document's place in few dimensions: its hashed vector of signed root counts, of unit length, projected at random."""
    feature, sign = _hashed()
    at = ids.astype(np.int64) & 0xFFFF
    vector = np.bincount(feature[at], sign[at], FEATURES)
    used = np.flatnonzero(vector)
    roots = np.sign(vector[used]) * np.sqrt(np.abs(vector[used]))
    return (roots @ _axes()[used] / max(1.0, np.sqrt(np.abs(vector[used]).sum()))).astype(np.float32)


def hilbert_keys(places: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place along the Hilbert curve of points of about unit spread, each axis cut into 2^bits parts of [-4, 4)."""
    n, dims = places.shape
    x = np.clip((places.astype(np.float64) + 4) / 8 * (1 << bits), 0, (1 << bits) - 1).astype(np.int64).T.copy()
    q = 1 << (bits - 1)
    while q > 1:  # undo the turns of the curve, from the coarsest level
        p = q - 1
        for i in range(dims):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros(n, np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        turn ^= np.where(x[dims - 1] & q, q - 1, 0)
        q >>= 1
    x ^= turn
    key = np.zeros(n, np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = key << 1 | (x[i] >> b & 1)
    return key


def tokenise(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """documents -> doc_id, key (on the curve), ids (packed, with the end id)."""

    def make():
        e = word_encoder(path)
        end = struct.pack(f"<{e.char}", end_id)

        def run(batch: dict) -> dict:
            packed = [e.packed(t) for t in batch["text"]]
            places = np.stack([place(np.frombuffer(x, e.dtype)) for x in packed])
            return {"doc_id": batch["doc_id"], "key": hilbert_keys(places).tolist(), "ids": [x + end for x in packed]}

        return run

    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), make, "doc_id long, key long, ids binary")


class Packer:
    """Cuts a stream of documents into sequences; pieces of a sequence come out once it is full."""

    def __init__(self, first_sequence: int, size: int = SIZE):
        self.sequence, self.size, self.used = first_sequence, size, 0
        self.held: list[tuple] = []

    def _emit(self, held: list[tuple]) -> list[tuple]:
        out, at = [], 0
        for doc_id, start, ids, total in held:
            out.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total, self.sequence, at))
            at += len(ids)
        self.sequence += 1
        return out

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[tuple]:
        start = 0
        while start < len(ids):
            part = ids[start : start + self.size - self.used]
            self.held.append((doc_id, start, part, len(ids)))
            start += len(part)
            self.used += len(part)
            if self.used == self.size:
                yield from self._emit(self.held)
                self.held, self.used = [], 0

    def finish(self) -> Iterator[tuple]:
        """The rest as sequences of powers of two, the longest first."""
        rest = self.held
        for b in range(self.used.bit_length() - 1, -1, -1):
            room = 1 << b
            if not self.used & room:
                continue
            now = []
            while room:
                doc_id, start, ids, total = rest[0]
                now.append((doc_id, start, ids[:room], total))
                rest = rest[1:] if len(ids) <= room else [(doc_id, start + room, ids[room:], total), *rest[1:]]
                room -= len(now[-1][2])
            yield from self._emit(now)
        self.held, self.used = [], 0


def pack(docs: DataFrame, path: str, end_id: int = 1, size: int = SIZE) -> DataFrame:
    """documents -> one row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    rows = materialise(tokenise(docs, path, end_id))
    total = rows.agg(F.sum(F.octet_length("ids"))).first()[0] or 0
    ranges = min(MAX_RANGES, max(1, -(-total // RANGE_BYTES)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dtype = word_encoder(path).dtype
        packer = Packer(TaskContext.get().partitionId() << 40, size)
        fields = [x.split()[0] for x in PIECES.split(", ")]

        def table(pieces: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*pieces)], names=fields)

        for batch in batches:
            pieces: list[tuple] = []
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), batch.column("ids")):
                pieces += packer.add(doc_id, np.frombuffer(ids.as_buffer(), dtype))
            # what is held over must not keep the batch alive
            packer.held = [(d, s, i.copy(), n) for d, s, i, n in packer.held]
            if pieces:
                yield table(pieces)
        if last := list(packer.finish()):
            yield table(last)

    # the place in the written table parts repeated rows; a task that is run again reads the same places
    order = [F.col("key"), F.col("doc_id").asc_nulls_first(), F.col("at")]
    sorted_ = rows.withColumn("at", F.monotonically_increasing_id()).repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    return sorted_.select("doc_id", "ids").mapInArrow(run, PIECES)
