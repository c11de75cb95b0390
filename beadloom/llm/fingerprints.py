"""Document fingerprints: invertible Bloom lookup sketches of hashed paragraphs.

A document is the multiset of its paragraphs (lines; long ones are cut further at word boundaries that their own
content chooses, so that an edit changes few pieces). Each piece is a key of 64 bits: a digest, and its length. A sketch has three
groups of cells of (count, key xor, check xor). Two sketches subtract cell by cell; peeling cells with a single key
gives the pieces that differ. If peeling fails, both are built anew with four times the cells. Likeness is
1 - (code points in differing pieces) / (code points in all pieces of both).

Defined cases: a null text is empty; empty texts have no pieces, two of them have likeness 1 (as equal texts have); the
next document of the last is the first, that of a single row is itself; a null doc_id sorts first; rows of equal doc_id
go by a hash of the text, then by text; repeated rows give a row each, whose next document but for the last is the same
text; texts of any length are taken whole; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Cells of the fingerprint itself; must be a multiple of 3.
CELLS = 24
#: Ranges of doc_id at most, whatever the size of the table: what the driver holds of them is bounded.
MAX_RANGES = 20_000
#: Lines up to this many code points are one piece.
LONG = 160
#: A word whose hash has these bits zero ends a piece of a longer line.
CUT = 7
LENGTH_BITS = 16
#: Share of cells in use beyond which peeling is not tried.
FULL = 0.92
_WORDS = re.compile(r"\S+\s*")


def pieces(text: str) -> list[str]:
    """The paragraphs of a text, long ones in parts; what is blank is no piece."""
    found = []
    for line in text.split("\n"):
        if len(line) <= LONG:
            if line and not line.isspace():
                found.append(line)
            continue
        at = size = 0
        for m in _WORDS.finditer(line):
            size = m.end() - at
            if size >= 24 and (not xxhash.xxh3_64_intdigest(m.group()) & CUT or size >= 4 * LONG):
                found.append(line[at : m.end()])
                at = m.end()
        if line[at:].strip():
            found.append(line[at:])
    return found


def keys(text: str) -> np.ndarray:
    """Distinct 64-bit keys of a text's pieces: 48 bits of digest (with the occurrence number of a repeated piece), 16 of length."""
    seen: dict[str, int] = {}
    digest = xxhash.xxh3_64_intdigest
    top = (1 << LENGTH_BITS) - 1
    out = []
    for p in pieces(text):
        n = seen.get(p, 0)
        seen[p] = n + 1
        out.append((digest(p, n) >> LENGTH_BITS << LENGTH_BITS) | min(len(p), top))
    return np.unique(np.array(out, np.uint64))


def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(32)
    return x


def check(k: np.ndarray) -> np.ndarray:
    return _mix(k, 0xC3EC) & np.uint64(0xFFFFFFFF)


def places(k: np.ndarray, cells: int) -> np.ndarray:
    """(3, n) cells of each key, one in each third."""
    third = cells // 3
    return np.stack([(_mix(k, 0xA1 + i) % np.uint64(third)).astype(np.int64) + i * third for i in range(3)])


class Sketches:
    """Sketches of many documents at once: arrays of (documents, cells)."""

    def __init__(self, count: np.ndarray, key: np.ndarray, chk: np.ndarray):
        self.count, self.key, self.chk = count, key, chk

    @classmethod
    def build(cls, sets: list[np.ndarray], cells: int) -> Sketches:
        n = len(sets)
        sizes = np.array([len(s) for s in sets])
        k = np.concatenate([*sets, np.zeros(0, np.uint64)])
        row = np.repeat(np.arange(n), sizes)
        flat = (places(k, cells) + row * cells).ravel()
        count = np.bincount(flat, minlength=n * cells).astype(np.int32)
        key, chk = np.zeros(n * cells, np.uint64), np.zeros(n * cells, np.uint64)
        np.bitwise_xor.at(key, flat, np.tile(k, 3))
        np.bitwise_xor.at(chk, flat, np.tile(check(k), 3))
        return cls(count.reshape(n, cells), key.reshape(n, cells), chk.reshape(n, cells))

    def minus(self, other: Sketches) -> Sketches:
        return Sketches(self.count - other.count, self.key ^ other.key, self.chk ^ other.chk)

    def rows(self, at: np.ndarray) -> Sketches:
        return Sketches(self.count[at], self.key[at], self.chk[at])

    def text(self, i: int) -> str:
        """A sketch as a string of one line."""
        data = self.count[i].astype("<i4").tobytes() + self.key[i].astype("<u8").tobytes() + self.chk[i].astype("<u4").tobytes()
        return base64.b64encode(data).decode()

    @classmethod
    def parse(cls, texts: list[str]) -> Sketches:
        raw = [base64.b64decode(t) for t in texts]
        m = len(raw[0]) // 16
        return cls(
            np.stack([np.frombuffer(r, "<i4", m) for r in raw]),
            np.stack([np.frombuffer(r, "<u8", m, 4 * m) for r in raw]),
            np.stack([np.frombuffer(r, "<u4", m, 12 * m).astype(np.uint64) for r in raw]),
        )


def peel(diff: Sketches) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, key, sign of each recovered key; per row, whether all were recovered)."""
    n, cells = diff.count.shape
    count, key, chk = diff.count.copy(), diff.key.copy(), diff.chk.copy()
    rows, found, signs = [], [], []
    # of a sketch with hardly an empty cell nothing can be peeled
    alive = np.flatnonzero((key != 0).mean(1) < FULL)
    for _ in range(4 * cells):
        r, c = np.nonzero(np.abs(count[alive]) == 1)
        r = alive[r]
        pure = check(key[r, c]) == chk[r, c]
        r, c = r[pure], c[pure]
        if not len(r):
            break
        alive = np.unique(r)
        k, s = key[r, c], count[r, c]
        # a key can be alone in up to three of its cells at once: take it once
        order = np.lexsort((k, r))
        r, k, s = r[order], k[order], s[order]
        first = np.ones(len(r), bool)
        first[1:] = (r[1:] != r[:-1]) | (k[1:] != k[:-1])
        r, k, s = r[first], k[first], s[first]
        for p in places(k, cells):
            np.subtract.at(count, (r, p), s)
            np.bitwise_xor.at(key, (r, p), k)
            np.bitwise_xor.at(chk, (r, p), check(k))
        rows.append(r)
        found.append(k)
        signs.append(s)
    whole = ~(count.any(1) | key.any(1) | chk.any(1))
    cat = lambda x, t: np.concatenate(x) if x else np.zeros(0, t)
    return cat(rows, np.int64), cat(found, np.uint64), cat(signs, np.int32), whole


def _total(k: np.ndarray) -> int:
    return int((k & np.uint64((1 << LENGTH_BITS) - 1)).sum())


def likeness(a: list[np.ndarray], b: list[np.ndarray], sketch_a: Sketches | None = None, sketch_b: Sketches | None = None) -> np.ndarray:
    """Likeness (0 to 1) of each pair of documents, from the keys that peeling the difference of sketches recovers."""
    n = len(a)
    out = np.zeros(n)
    total = np.array([_total(x) + _total(y) for x, y in zip(a, b)], float)
    open_, cells = np.arange(n), CELLS
    while len(open_):
        if cells == CELLS and sketch_a is not None and sketch_b is not None:
            diff = sketch_a.minus(sketch_b)
        else:
            diff = Sketches.build([a[i] for i in open_], cells).minus(Sketches.build([b[i] for i in open_], cells))
        rows, found, _, whole = peel(diff)
        lost = np.bincount(rows, (found & np.uint64((1 << LENGTH_BITS) - 1)).astype(float), minlength=len(open_))
        done = open_[whole]
        out[done] = np.where(total[done] > 0, 1 - lost[whole] / np.maximum(total[done], 1), 1.0)
        open_ = open_[~whole]
        cells *= 4
        # the difference has at least as many keys as the sizes differ, so smaller sketches are bound to fail
        while len(open_) and all(abs(len(a[i]) - len(b[i])) > cells for i in open_):
            cells *= 4
    return np.clip(out, 0, 1)


def edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _bounds(ids: DataFrame, parts: int) -> list[float]:
    """Quantiles of doc_id: the borders of ranges of about equally many rows."""
    if parts < 2:
        return []
    return sorted(set(ids.approxQuantile("doc_id", [i / parts for i in range(1, parts)], 0.2 / parts)))


def _heavy(rows: DataFrame, limit: int) -> list[tuple[int | None, int]]:
    """(id, distinct texts) of the ids with more than `limit` rows; at most one per range, so a bounded list."""
    many = rows.groupBy("doc_id").agg(F.count("*").alias("n")).filter(F.col("n") > limit).select("doc_id", F.lit(True).alias("many"))
    if many.isEmpty():
        return []
    found = rows.join(F.broadcast(many), rows.doc_id.eqNullSafe(many.doc_id), "left_semi")
    return [(r.doc_id, r.n) for r in found.select("doc_id", "h").distinct().groupBy("doc_id").agg(F.count("*").alias("n")).collect()]


def compare_with_next(docs: DataFrame, rows_per_range: int = 1000) -> DataFrame:
    """Fingerprints of every document and of its text edited with the next document's, and both likenesses.

    Ranges of (doc_id, hash of the text) go to tasks, each range sorted; of the next range only its first row is copied, so
    the texts are shuffled once. An id with more rows than a range has ranges of its own, cut by the hash, and its equal
    rows are counted before the shuffle, and multiplied again behind the comparison. The driver sees the borders and first
    ids of ranges, not of rows.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    ids = rows.select("doc_id")
    ranges = min(MAX_RANGES, max(1, -(-ids.count() // rows_per_range)))
    heavy = _heavy(rows.select("doc_id", "h"), max(rows_per_range, -(-ids.count() // ranges)))
    hot = [i for i, _ in heavy if i is not None]
    # a hot id lies between borders of its own
    borders = sorted({*_bounds(ids.filter("doc_id IS NOT NULL"), ranges), *map(float, hot), *(float(i + 1) for i in hot)})
    cuts = F.array(*[F.lit(b) for b in borders]) if len(borders) < 50 else None
    if not borders:
        base = lambda df: df.withColumn("base", F.when(F.col("doc_id").isNull(), 0).otherwise(1))
    elif cuts is not None:
        base = lambda df: df.withColumn("base", F.when(F.col("doc_id").isNull(), 0).otherwise(F.size(F.filter(cuts, lambda b: b <= F.col("doc_id").cast("double"))) + 1))
    else:
        from pyspark.ml.feature import Bucketizer

        inner = Bucketizer(splits=[-float("inf"), *borders, float("inf")], inputCol="at", outputCol="base", handleInvalid="keep")
        base = lambda df: inner.transform(df.withColumn("at", F.col("doc_id").cast("double"))).drop("at").withColumn("base", F.when(F.col("doc_id").isNull(), 0).otherwise(F.col("base").cast("int") + 1))
    parts = {(0 if i is None else bisect.bisect_right(borders, float(i)) + 1): max(1, -(-n // rows_per_range)) for i, n in heavy}
    offsets, total = [], 0
    for k in range(len(borders) + 2):
        offsets.append((k, total, parts.get(k, 1)))
        total += offsets[-1][2]
    places = F.broadcast(spark.createDataFrame(offsets, "base int, first int, parts int"))  # a row per range
    # a hash's place among `parts` equal slices of the 64-bit numbers
    slice_ = F.least(F.floor((F.col("h") / F.lit(2.0**64) + F.lit(0.5)) * F.col("parts")), F.col("parts") - 1)
    spread = lambda df: base(df).join(places, "base").withColumn("bucket", (F.col("first") + slice_).cast("int")).drop("base", "first", "parts")
    if heavy:
        names = F.broadcast(spark.createDataFrame([(i,) for i, _ in heavy], "id long"))
        same = rows.doc_id.eqNullSafe(names.id)
        many = rows.join(names, same, "left_semi").groupBy("doc_id", "text", "h").agg(F.count("*").alias("times"))
        rows = rows.join(names, same, "left_anti").withColumn("times", F.lit(1).cast("long")).unionByName(many)
    else:
        rows = rows.withColumn("times", F.lit(1).cast("long"))
    heads = {r["bucket"]: r["first"] for r in spread(rows.select("doc_id", "h")).groupBy("bucket").agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "h")).alias("first")).collect()}
    order = sorted(heads)
    placed = spread(rows).withColumn("copy", F.lit(0))
    if order:
        before = {order[i]: order[i - 1] for i in range(len(order))}  # the first's is the last
        # ties: of rows with the head's id and hash only the first by text is the head; all are copied, the task takes the least
        lookup = F.broadcast(spark.createDataFrame([(b, before[b], heads[b]["doc_id"], heads[b]["h"]) for b in order], "b int, to int, id long, hash long"))  # one row per range
        heads_only = placed.join(lookup, (F.col("bucket") == F.col("b")) & F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("h") == F.col("hash"))).select("doc_id", "text", "h", "times", F.col("to").alias("bucket"), F.lit(1).alias("copy"))
        placed = placed.unionByName(heads_only)
    dealt = placed.repartition(max(1, len(order)), "bucket").sortWithinPartitions("bucket", "copy", F.col("doc_id").asc_nulls_first(), "h", "text")
    found = dealt.select("doc_id", "text", "bucket", "copy", "times").mapInArrow(_compare, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, times int")
    each = found.select(*[c for c in found.columns if c != "times"], F.explode(F.sequence(F.lit(1), F.col("times"))).alias("time"))
    return each.drop("time")


#: Rows that one row stands for at most.
TIMES = 10_000


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stream of (bucket, rows in order, then the copied head of the next bucket)."""

    def pairs():
        held = None
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "bucket", "copy", "times"))):
                if held is not None and held[2] == row[2]:
                    left = held[4] - 1
                    while left > 0:  # the equal rows but the last are followed by their own text
                        yield held[0], held[1], held[1], min(left, TIMES)
                        left -= TIMES
                    yield held[0], held[1], row[1], 1
                held = row if not row[3] else None
        if held is not None:
            raise RuntimeError(f"range {held[2]} lacks the copy of the next range's first row")

    chunk: list = []
    size = 0
    for p in pairs():
        chunk.append(p)
        size += len(p[1])
        if len(chunk) >= 256 or size > 1_000_000:
            yield _fingerprint_chunk(chunk)
            chunk, size = [], 0
    if chunk:
        yield _fingerprint_chunk(chunk)


def _fingerprint_chunk(chunk: list[tuple]) -> pa.RecordBatch:
    """Fingerprints of consecutive (doc_id, text, next text, times)."""
    own = [keys(t) for _, t, _, _ in chunk]
    nexts = [own[i + 1] if i + 1 < len(chunk) and chunk[i + 1][1] is n else keys(n) for i, (_, _, n, _) in enumerate(chunk)]
    changed = [edited(t, n) for _, t, n, _ in chunk]
    other = [keys(t) for t in changed]
    a, b, c = Sketches.build(own, CELLS), Sketches.build(other, CELLS), Sketches.build(nexts, CELLS)
    same = np.array([x == y for (_, x, _, _), y in zip(chunk, changed)])
    same_next = np.array([x == y for _, x, y, _ in chunk])
    near = np.where(same, 1.0, likeness(own, other, a, b))
    near_next = np.where(same_next, 1.0, likeness(own, nexts, a, c))
    return pa.RecordBatch.from_pydict(
        {
            "doc_id": pa.array([d for d, _, _, _ in chunk], pa.int64()),
            "n_chars": pa.array([len(t) for _, t, _, _ in chunk], pa.int64()),
            "edited_sha256": pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in changed]),
            "fingerprint": pa.array([a.text(i) for i in range(len(chunk))]),
            "edited_fingerprint": pa.array([b.text(i) for i in range(len(chunk))]),
            "near_edited": pa.array(near, pa.float64()),
            "near_next": pa.array(near_next, pa.float64()),
            "times": pa.array([n for _, _, _, n in chunk], pa.int32()),
        }
    )
