"""Fill-in-middle transformation by an index of distinct texts.

Rows are dealt and sorted by the text itself, in one shuffle, so equal texts follow each other. Each group of texts that
are equal character by character gets the list of its line boundaries once, as an Elias-Fano code (two bits and the low
bits of a mean line a boundary). A merge by content joins the list to the group's documents, and each document's two cuts
are selected from it without looking for lines again.

A text of which more than a thousandth of all rows are copies is dealt over all tasks by a salt, so its list is computed
once per task. Hashes of such texts, at most a thousand, are the only thing that is broadcast.

Defined cases: a null text is empty; an empty text, and one that holds a marker, stays plain; a text of any length or
number of lines is taken whole; cuts that tie give an empty middle; equal rows and ids each give a row; a null doc_id
draws from the seed and an empty id; other columns pass through unchanged, whatever their names; no rows give no rows.
"""

from __future__ import annotations

import struct

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import append_batches, fresh

# The marks of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = MARKERS = ("<P>", "<S>", "<M>")
#: A text is hot if more than 1/HOT_SHARE of all rows, and at least LEAST_HOT, have it.
HOT_SHARE, LEAST_HOT = 1000, 100
_HEAD = struct.Struct("<qqB")
_ONES = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def boundaries(text: str) -> np.ndarray:
    """Ends of the lines of a text, in code points."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    ends = np.flatnonzero(raw == 10) + 1
    if len(raw) != len(text):
        ends = np.cumsum((raw & 0xC0) != 0x80)[ends - 1]
    return np.append(ends, len(text)) if text and text[-1] != "\n" else ends


def encode(ends: np.ndarray) -> bytes:
    """An ascending list as Elias-Fano: low bits packed, the rest as gaps in unary."""
    n = len(ends)
    if not n:
        return _HEAD.pack(0, 0, 0)
    last = int(ends[-1])
    low = max(0, (last // n).bit_length() - 1)
    bits = ((ends[:, None] >> np.arange(low)) & 1).astype(np.uint8)
    high = np.zeros((last >> low) + n, np.uint8)
    high[(ends >> low) + np.arange(n)] = 1
    return _HEAD.pack(n, last, low) + np.packbits(bits.reshape(-1), bitorder="little").tobytes() + np.packbits(high, bitorder="little").tobytes()


class Boundaries:
    """An encoded list, read by place."""

    def __init__(self, code: bytes):
        self.n, self.last, self.low = _HEAD.unpack_from(code)
        at = _HEAD.size + (self.n * self.low + 7) // 8
        self._low, self._high = np.frombuffer(code[_HEAD.size : at], np.uint8), np.frombuffer(code[at:], np.uint8)
        self._ones = np.cumsum(_ONES[self._high])

    def select(self, k: int) -> int:
        """The k-th boundary, from 1; the 0-th is 0."""
        if not k:
            return 0
        byte = int(np.searchsorted(self._ones, k))
        rest = k - (int(self._ones[byte - 1]) if byte else 0)
        place = 8 * byte + int(np.flatnonzero(np.unpackbits(self._high[byte : byte + 1], bitorder="little"))[rest - 1])
        start = (k - 1) * self.low
        window = int.from_bytes(self._low[start // 8 : (start + self.low + 7) // 8].tobytes(), "little") >> start % 8
        return (place - (k - 1)) << self.low | window & ((1 << self.low) - 1)


def cut(text: str, lines: Boundaries, draws: list[int], rate: int, spm: int) -> tuple[str, str, int | None, int | None]:
    """(form, output, characters of the prefix, of the middle) of a text whose boundaries are known."""
    if not text or draws[2] % 100 >= rate or any(m in text for m in MARKERS):
        return "plain", text, None, None
    first, second = sorted((draws[0] % (lines.n + 1), draws[1] % (lines.n + 1)))
    a, b = lines.select(first), lines.select(second)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if draws[3] % 100 < spm:
        return "spm", f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}", a, b - a
    return "psm", f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}", a, b - a


def restore(output: Column, form: Column) -> Column:
    """The exact text of an output and its form. A mark is found at its first place: the parts hold none, and no part's
    end and a mark's beginning make one."""

    def parts(second: str) -> tuple[Column, Column, Column]:
        head = F.substring_index(output, second, 1)
        rest = F.substring(output, F.length(head) + 4, F.length(output))
        mid = F.substring_index(rest, MIDDLE, 1)
        return F.substring(head, F.lit(4), F.length(head)), mid, F.substring(rest, F.length(mid) + 4, F.length(rest))

    psm, spm = parts(SUFFIX), parts(PREFIX)
    return F.when(form == "psm", F.concat(psm[0], psm[2], psm[1])).when(form == "spm", F.concat(spm[1], spm[2], spm[0])).otherwise(output)


def _by_content(docs: DataFrame) -> DataFrame:
    """docs dealt and sorted by text: equal texts follow each other in a task, hot ones in every task."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    mark, hot, salt = (fresh(docs, c) for c in ("__hash", "__hot", "__salt"))
    rows = docs.withColumn(mark, F.xxhash64("text"))
    counts = docs.groupBy(F.xxhash64("text").alias(mark)).agg(F.count("*").alias("n"))
    limit = max(LEAST_HOT, docs.count() // HOT_SHARE)
    keys = counts.filter(F.col("n") > limit).select(F.col(mark), F.lit(True).alias(hot))  # at most HOT_SHARE
    rows = rows.join(F.broadcast(keys), mark, "left").withColumn(salt, F.when(F.col(hot), F.spark_partition_id() % parts))
    return rows.drop(mark, hot).repartition(parts, "text", salt).sortWithinPartitions("text").drop(salt)


class DistinctTexts:
    """The index of a task: the boundaries of each distinct text, made when a text first comes. Rows come sorted, so the
    documents that share a text are joined with its list by comparing each text with the one before, character by character."""

    def __init__(self):
        self.text, self.lines, self.made = None, None, 0

    def lookup(self, text: str) -> Boundaries:
        if self.lines is None or text != self.text:
            self.text, self.lines = text, Boundaries(encode(boundaries(text)))
            self.made += 1
        return self.lines


def transform(docs: DataFrame, rate: int = 100, spm: int = 50, seed: int = 7) -> DataFrame:
    """docs with fim_lines (number of lines), fim_form, fim_output, fim_prefix and fim_middle (characters).

    `rate` of 100 documents are transformed, `spm` of 100 of those with the suffix first. Where docs have such a column
    already, the new one gets an underscore more; `columns` tells the names.
    """
    draw = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    draws, names = fresh(docs, "__draws"), columns(docs)

    def make():
        index = DistinctTexts()

        def run(batch: dict) -> dict:
            out: dict[str, list] = {c: [] for c in names.values()}
            for t, d in zip(batch["text"], batch[draws]):
                t = t or ""
                lines = index.lookup(t)
                for column, value in zip(out.values(), (lines.n, *cut(t, lines, d, rate, spm))):
                    column.append(value)
            return out

        return run

    rows = _by_content(docs).withColumn(draws, F.array(*[F.conv(F.substring(draw, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]))
    found = append_batches(rows, make, ", ".join(f"{n} {k}" for n, k in zip(names.values(), ("long", "string", "string", "long", "long"))), ["text", draws])
    return found.select(*docs.columns, *names.values())


def columns(docs: DataFrame) -> dict[str, str]:
    """The names of the columns that transform() adds."""
    return {c: fresh(docs, c) for c in ("fim_lines", "fim_form", "fim_output", "fim_prefix", "fim_middle")}
