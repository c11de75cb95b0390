"""Codes of vectors by product quantisation, trained by Lloyd's rounds with Elkan's bounds.

A vector is cut into equal parts, and each part position has a codebook. Every part keeps an upper bound of the distance to
its entry and a lower bound of the distance to each entry of its codebook. When entries move, the bounds are shifted by
how far; an entry whose lower bound, or half of whose distance to the part's own entry, is strictly above the upper bound
can't be nearest and can't tie. What is left is compared by exact integer distances, ties to the lower index.

All is integers: upper bounds and movements are rounded up, lower bounds down, so a bound never lies. Lower bounds are kept
as levels of a step per codebook, at most LEVELS of them, as a bound above that rules an entry out all the same. The
state, a row per vector, is a table in the shared folder; a round reads the last one and writes the next, and the one
before is deleted. What reaches the driver is a sum and a count per entry.

Defined cases: rows whose vector is null or holds null or non-finite components are dropped; shorter vectors are filled up
with zeros to the length of the longest, and that to a multiple of the number of parts (an empty vector is all zeros);
components are held between -2 ** 28 and 2 ** 28; fewer kept rows than entries give fewer entries; of equal vec_ids that
of the least vector comes first, null vec_ids last; equal rows each give a row; null labels are one label; a table
without kept rows gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import attach, discard, materialise

PARTS, ENTRIES, ROUNDS = 16, 64, 2
SCALE, LARGEST = 256, 1 << 28
#: Levels of a lower bound; few, so that the state stays small.
LEVELS = 15
#: Vectors that are compared at once.
CHUNK = 1024


def integers(embeddings: DataFrame) -> DataFrame:
    """vec_id, label, v: kept rows with components as floor(256 * x)."""
    x = F.col("embedding").cast("array<double>")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(math.inf)))
    whole = F.transform(x, lambda c: F.floor(F.least(F.greatest(c * SCALE, F.lit(float(-LARGEST))), F.lit(float(LARGEST)))).cast("int"))
    return embeddings.filter(F.col("embedding").isNotNull() & ~bad).select("vec_id", "label", whole.alias("v"))


@dataclass
class Codebooks:
    """entries[part, index, place]; step[part] is that of its lower bounds' levels."""

    entries: np.ndarray
    step: np.ndarray

    def text(self) -> str:
        return ",".join(map(str, self.entries.reshape(-1).tolist()))


def roots(squares: np.ndarray, up: bool) -> np.ndarray:
    """Square roots of integers, rounded up or down, exactly."""
    r = np.sqrt(squares.astype(np.float64)).astype(np.int64)
    r -= r * r > squares
    r += (r + 1) * (r + 1) <= squares
    return r + (r * r < squares) if up else r


def first_codebooks(rows: DataFrame, parts: int, entries: int) -> Codebooks:
    """The parts of the vectors with the smallest ids, in order."""
    width = rows.agg(F.max(F.size("v"))).first()[0]
    width = -(-max(width or 0, 1) // parts) * parts
    first = [r.v for r in rows.select("vec_id", "v").orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).collect()]
    whole = np.array([v + [0] * (width - len(v)) for v in first], np.int64).reshape(len(first), parts, width // parts)
    entries_ = np.ascontiguousarray(whole.transpose(1, 0, 2))
    apart = roots(((entries_[:, :, None] - entries_[:, None]) ** 2).sum(-1), True) if len(first) else np.zeros((parts, 1, 1), np.int64)
    # LEVELS of a sixteenth of the widest distance: entries farther than nearly that are ruled out in any case
    return Codebooks(entries_, np.maximum(1, apart.max((1, 2)) // (LEVELS + 1)))


def nearest(v: np.ndarray, c: Codebooks) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index, squared distance, levels of all lower bounds) of parts v[row, part, place], by all distances."""
    squares = ((v[:, :, None, :] - c.entries[None]) ** 2).sum(-1)
    best = squares.argmin(-1)  # the first of the least
    levels = np.minimum(roots(squares, False) // c.step[:, None], LEVELS)
    return best, np.take_along_axis(squares, best[..., None], -1)[..., 0], levels


@dataclass
class Movement:
    """From one round's codebooks to the next's: how far entries moved, rounded up, and half of how far apart the new ones are,
    rounded down."""

    new: Codebooks
    moved: np.ndarray
    half: np.ndarray

    @classmethod
    def between(cls, old: Codebooks, new: np.ndarray) -> Movement:
        apart = roots(((new[:, :, None] - new[:, None]) ** 2).sum(-1), False) // 2
        return cls(Codebooks(new, old.step), roots(((new - old.entries) ** 2).sum(-1), True), apart)


def improve(v: np.ndarray, best: np.ndarray, upper: np.ndarray, levels: np.ndarray, m: Movement) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(index, squared distance, levels, number of distances worked out) after a movement, from the bounds before it."""
    rows, parts = best.shape
    p = np.arange(parts)
    step = m.new.step[:, None]
    lower = np.maximum(levels * step - m.moved, 0)
    bound = upper + m.moved[p, best]
    # strictly above: an entry at the same distance is still compared
    open_ = (lower <= bound[..., None]) & (m.half[p, best] <= bound[..., None])
    open_[np.arange(rows)[:, None], p, best] = False
    own = ((v - m.new.entries[p, best]) ** 2).sum(-1)
    bound = roots(own, True)  # the bound made tight, for what is still open
    open_ &= (lower <= bound[..., None]) & (m.half[p, best] <= bound[..., None])
    r, q, j = np.nonzero(open_)
    squares = ((v[r, q] - m.new.entries[q, j]) ** 2).sum(-1)
    lower[r, q, j] = roots(squares, False)
    lower[np.arange(rows)[:, None], p, best] = roots(own, False)
    least = own.copy()
    np.minimum.at(least, (r, q), squares)
    tie = squares == least[r, q]
    index = np.where(own == least, best, lower.shape[2])
    np.minimum.at(index, (r[tie], q[tie]), j[tie])
    return index, least, np.minimum(lower // step, LEVELS), rows * parts + len(r)


def _packed(levels: np.ndarray) -> np.ndarray:
    """Two levels in a byte."""
    flat = levels.astype(np.uint8).reshape(len(levels), -1)
    flat = np.pad(flat, ((0, 0), (0, flat.shape[1] % 2)))
    return flat[:, ::2] | flat[:, 1::2] << 4


def _unpacked(raw: np.ndarray, parts: int, entries: int) -> np.ndarray:
    flat = np.stack((raw & 15, raw >> 4), -1).reshape(len(raw), -1)
    return flat[:, : parts * entries].reshape(len(raw), parts, entries).astype(np.int64)


def _binary(column: pa.Array, kind: type) -> np.ndarray:
    """Values of one length each, as rows."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


def _values(rows: np.ndarray) -> pa.Array:
    return pa.array([x.tobytes() for x in rows], pa.binary())


STATE = "vec_id long, label {label}, v array<int>, best binary, upper binary, lower binary, error long, worked long"


def _assign(rows: DataFrame, books: Codebooks, movement: Movement | None, keep: bool = True) -> DataFrame:
    """The state after an assignment: of all parts by all distances, or after a movement by the bounds of `rows`."""
    parts, entries, width = books.entries.shape
    label = rows.schema["label"].dataType.simpleString()
    schema = rows.sparkSession.createDataFrame([], STATE.replace("{label}", label)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, CHUNK):
                batch = whole.slice(at, CHUNK)
                found = batch.column("v")
                if movement is None:
                    v = np.zeros((len(found), parts * width), np.int64)
                    for i, x in enumerate(found.to_pylist()):
                        v[i, : len(x)] = x
                    v = v.reshape(-1, parts, width)
                    best, error, levels = nearest(v, books)
                    worked = np.full(len(found), parts * entries)
                else:
                    v = found.flatten().to_numpy().astype(np.int64).reshape(-1, parts, width)
                    levels = _unpacked(_binary(batch.column("lower"), np.uint8), parts, entries)
                    best, error, levels, n = improve(v, _binary(batch.column("best"), np.uint16).astype(np.int64), _binary(batch.column("upper"), np.int32).astype(np.int64), levels, movement)
                    worked = np.full(len(found), n // len(found))
                put = pa.ListArray.from_arrays(pa.array(np.arange(len(v) + 1, dtype=np.int32) * (parts * width)), pa.array(v.reshape(-1).astype(np.int32)))
                none = pa.nulls(len(v), pa.binary())
                bounds = (_values(roots(error, True).astype(np.int32)), _values(_packed(levels))) if keep else (none, none)
                columns = [batch.column("vec_id"), batch.column("label"), put, _values(best.astype(np.uint16)), *bounds, pa.array(error.sum(1)), pa.array(worked.astype(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(run, schema)


def _moved(state: DataFrame, books: Codebooks) -> Movement:
    """Entries as the floor of the mean of their parts; those without parts stay. A row per part position and entry."""
    parts, entries, width = books.entries.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((parts, entries, width), np.int64), np.zeros((parts, entries), np.int64)
        for batch in batches:
            v = batch.column("v").flatten().to_numpy().astype(np.int64).reshape(-1, parts, width)
            best = _binary(batch.column("best"), np.uint16).astype(np.int64)
            p = np.broadcast_to(np.arange(parts), best.shape)
            np.add.at(sums, (p, best), v)
            np.add.at(counts, (p, best), 1)
        p, e = np.nonzero(counts)
        if len(p):
            totals = pa.ListArray.from_arrays(pa.array(np.arange(len(p) + 1, dtype=np.int32) * width), pa.array(sums[p, e].reshape(-1)))
            yield pa.RecordBatch.from_arrays([pa.array(p), pa.array(e), pa.array(counts[p, e]), totals], names=["part", "entry", "n", "sums"])

    partial = state.select("v", "best").mapInArrow(run, "part long, entry long, n long, sums array<long>")
    totals = partial.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(width)])
    new = books.entries.copy()
    for r in totals.collect():  # at most parts * entries rows
        new[r.part, r.entry] = [r[f"s{i}"] // r.n for i in range(width)]
    return Movement.between(books, new)


def quantise(embeddings: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, Codebooks]:
    """(vec_id, label, best (indexes as 16-bit numbers), error, worked (distances worked out); codebooks)."""
    rows = integers(embeddings)
    books = first_codebooks(rows, parts, entries)
    state = None
    movement = None
    for turn in range(rounds + 1):
        found = _assign(rows if state is None else state, books, movement, turn < rounds)
        if turn == rounds:
            found = found.select("vec_id", "label", "best", "error", "worked")
        written = materialise(found)
        if state is not None:
            discard(state)
        state = written
        if turn < rounds:
            movement = _moved(state, books)
            books = movement.new
    return state, books


def with_label_error(codes: DataFrame) -> DataFrame:
    """codes with label_error, the sum of error over rows of the same label; null labels are one."""
    keyed = codes.withColumn("__label", F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit("")))
    sums = keyed.groupBy("__label").agg(F.sum("error").alias("label_error"), F.count("*").alias("__n"))
    return attach(keyed, sums, "__label", "__n", codes.count()).drop("__label")


def codes(embeddings: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256."""
    found, books = quantise(embeddings)
    text = hashlib.sha256(books.text().encode()).hexdigest()
    low = [F.substring("best", 2 * i + 1, 1) for i in range(PARTS)]  # indexes are below 256
    code = F.lower(F.concat(*[F.hex(b) for b in low]))
    return with_label_error(found).select("vec_id", code.alias("code"), "error", "label_error", F.lit(text).alias("codebooks_sha256"))
