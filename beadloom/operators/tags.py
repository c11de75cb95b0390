"""Finding tags in sequences with bounded mismatches.

A mismatch-tolerant lookup is an equality join: every tag is expanded to all strings within its distance once, and the
windows of a read meet those strings by a hash join. No pair of read and tag is ever compared base by base.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import names, walking
from ..functions.names import MISSING

# The layout's measures.
SPACER = 7
LAXITY = 6
TAG_SPAN = 17


def hamming_ball(tags: DataFrame, k: int = 1, alphabet: str = "ACGT", carry: tuple[str, ...] = ("ord", "name"), tolerance: str | None = None) -> DataFrame:
    """tags (carry..., tag) -> carry..., tag, neighbour: every string within k substitutions, the tag itself included.

    With `tolerance`, a column of it says how many substitutions each tag allows, at most k.
    """
    allowed = F.col(tolerance) if tolerance else F.lit(k)
    ball = tags.select(*carry, "tag", F.col("tag").alias("neighbour"), allowed.alias("__k"))
    for step in range(k):
        spots = ball.withColumn("p", F.explode(F.when(F.col("__k") > step, F.sequence(F.lit(1), F.length("tag"))).otherwise(F.array(F.lit(0)))))
        changed = spots.withColumn("c", F.explode(F.array(*[F.lit(c) for c in alphabet])))
        put = F.when(F.col("p") > 0, F.overlay("neighbour", "c", "p", F.lit(1))).otherwise(F.col("neighbour"))
        ball = changed.select(*carry, "tag", put.alias("neighbour"), "__k").distinct()
    return ball.drop("__k")


def nearest(ball: DataFrame, last_wins: bool = True) -> DataFrame:
    """One tag per neighbour: of several the last (or first) of the table's order."""
    pick = F.max_by if last_wins else F.min_by
    return ball.groupBy("neighbour").agg(pick("name", "ord").alias("name"))


def ambiguous(ball: DataFrame) -> DataFrame:
    """Neighbours of more than one tag."""
    return ball.groupBy("neighbour").agg(F.countDistinct("name").alias("n_names"), F.min("name").alias("first_name"), F.max("name").alias("last_name")).filter("n_names > 1")


def attach_tag(rows: DataFrame, seq: str, offset: int, near: DataFrame, sizes: list[int], name: str, advance: str | None = None) -> DataFrame:
    """Rows with the tag at a fixed place of a sequence, the shorter first; a join per length, so nothing is exploded.

    `near` has one name per neighbour. NOT_FOUND goes on by the longest length.
    """
    sizes = sorted(sizes)
    for n in sizes:
        key = F.when(F.length(seq) >= offset + n, F.substring(seq, offset + 1, n))
        rows = rows.withColumn(f"__key{n}", key).join(near.select(F.col("neighbour").alias(f"__key{n}"), F.col("name").alias(f"__hit{n}")), f"__key{n}", "left").drop(f"__key{n}")
    found = {name: F.coalesce(*[F.col(f"__hit{n}") for n in sizes], F.lit(MISSING))}
    if advance:
        found[advance] = F.coalesce(*[F.when(F.col(f"__hit{n}").isNotNull(), F.lit(n)) for n in sizes], F.lit(max(sizes)))
    return rows.withColumns(found).drop(*[f"__hit{n}" for n in sizes])


def exact(tags: DataFrame) -> DataFrame:
    """neighbour, name of tags that allow no mismatch: of equal tags the last."""
    return tags.groupBy(F.col("tag").alias("neighbour")).agg(F.max_by("name", "ord").alias("name"))


def lookup_at(reads: DataFrame, tags: DataFrame, offset: int, sizes: list[int]) -> DataFrame:
    """rec_no, name, advance: the tag at a fixed offset, the shorter first; NOT_FOUND goes on by the longest length."""
    return attach_tag(reads.select("rec_no", "seq"), "seq", offset, exact(tags), sizes, "name", "advance").select("rec_no", "name", "advance")


def _grid(sizes: list[int], laxity: int) -> Column:
    return F.array(*[F.struct(F.lit(o).alias("o"), F.lit(n).alias("size")) for o in range(laxity + 1) for n in sizes])


def lookup_window(starts: DataFrame, near: DataFrame, sizes: list[int], laxity: int = LAXITY, keys: tuple[str, ...] = ("rec_no", "slot")) -> DataFrame:
    """Slots (keys..., seq, start) -> keys..., name, hit_end of the first tag found; only slots with a tag are returned.

    Offsets 0 to laxity are tried in order, at each the shorter windows first. The first window that overruns the read
    ends the search, so later windows count only if the longest at the offset before still fitted.
    """
    longest = max(sizes)
    w = starts.select(*keys, "seq", "start", F.inline(_grid(sizes, laxity)))
    fits = (F.col("start") + F.col("o") + F.col("size") <= F.length("seq")) & ((F.col("o") == 0) | (F.col("start") + F.col("o") - 1 + longest <= F.length("seq")))
    w = w.filter(fits).withColumn("neighbour", F.substring("seq", F.col("start") + F.col("o") + 1, F.col("size")))
    hits = w.join(near, "neighbour")
    return hits.groupBy(*keys).agg(F.min(F.struct("o", "size", "name", (F.col("start") + F.col("o") + F.col("size")).alias("hit_end"))).alias("hit")).select(*keys, "hit.name", "hit.hit_end")


def lookup_next(starts: DataFrame, near: DataFrame, sizes: list[int], laxity: int = LAXITY) -> DataFrame:
    """Starts (rec_no, slot, seq, start) -> rec_no, name, next_start: the variant that goes on at a match's own end."""
    hits = lookup_window(starts, near, sizes, laxity)
    return starts.select("rec_no", "start").join(hits, "rec_no", "left").select("rec_no", F.coalesce("name", F.lit(MISSING)).alias("name"), F.coalesce("hit_end", "start").cast("long").alias("next_start"))


def _slots(layout: str, spacer: int, span: int) -> list[tuple[int, str, int, bool]]:
    """(number, kind, distance behind the first tag, is the first) of a layout's slots other than a terminal or bead tag."""
    found, at = [], 0
    for i, p in enumerate(x.strip() for x in layout.split("|")):
        if p == "SPACER":
            at += spacer
        elif p in ("Y", "DPM"):
            if i:
                raise ValueError("a terminal tag or a bead's comes first")
        elif p in ("ODD", "EVEN"):
            found.append((len(found), p, at, i == 0))
            at += span
        else:
            raise ValueError(f"no such part of a layout: {p}")
    return found


def walk_layout(reads: DataFrame, layout: str, near: dict[str, DataFrame], sizes: dict[str, list[int]], offset: int = 0, spacer: int = SPACER, span: int = TAG_SPAN, laxity: int = LAXITY, carry: tuple[str, ...] = ()) -> DataFrame:
    """rec_no, barcode, carry...: the tags of a layout such as "Y|SPACER|ODD", as far as the read reaches, then NOT_FOUND.

    Only the terminal tag's length depends on the data, so each slot's start is that plus a constant. One pass over the
    reads: all windows of all slots meet all kinds' neighbours in one join; hits, and one row per read with what is carried,
    are brought together by read in one shuffle. A slot after the first is looked at if `span` bases are left. Offsets 0
    to laxity are tried in order, at each the shorter windows first; the first window that overruns the read ends a slot.
    """
    slots = _slots(layout, spacer, span)
    head = layout.split("|")[0].strip()
    terminal = head in ("Y", "DPM")
    rows = reads.select("rec_no", "seq", *carry)
    rows = attach_tag(rows, "seq", offset, near[head], sizes[head], "terminal", "advance") if terminal else rows.withColumns({"terminal": F.lit(None).cast("string"), "advance": F.lit(0)})
    windows = [(-1, "", 0, True, 0, 0, 0), *((s, kind, at, first, o, n, max(sizes[kind])) for s, kind, at, first in slots for o in range(laxity + 1) for n in sorted(sizes[kind]))]
    fields = ("slot", "kind", "at", "is_first", "o", "size", "longest")
    grid = F.array(*[F.struct(*[F.lit(v).alias(f) for f, v in zip(fields, w)]) for w in windows])
    w = rows.select("rec_no", "seq", "advance", F.struct("terminal", *carry).alias("carried"), F.inline(grid))
    start, length = F.lit(offset) + F.col("advance") + F.col("at"), F.length("seq")
    reached = F.col("is_first") | (length - start >= span)
    fits = (start + F.col("o") + F.col("size") <= length) & ((F.col("o") == 0) | (start + F.col("o") - 1 + F.col("longest") <= length))
    w = w.filter((F.col("slot") < 0) | (reached & fits)).withColumn("neighbour", F.when(F.col("slot") >= 0, F.concat("kind", F.substring("seq", (start + F.col("o") + 1).cast("int"), F.col("size")))))
    if not slots:
        return rows.select("rec_no", F.array("terminal").alias("barcode"), *carry)
    lookup = reduce(DataFrame.unionByName, [near[k].select(F.concat(F.lit(k), "neighbour").alias("neighbour"), "name") for k in sorted({k for _, k, _, _ in slots})])
    hits = w.join(lookup, "neighbour", "left").filter((F.col("slot") < 0) | F.col("name").isNotNull())
    hits = hits.select("rec_no", "slot", "o", "size", "name", F.when(F.col("slot") < 0, F.col("carried")).alias("carried"))
    best = [F.min(F.when(F.col("slot") == s, F.struct("o", "size", "name"))).alias(f"slot{s}") for s, _, _, _ in slots]
    one = hits.groupBy("rec_no").agg(F.first("carried", ignorenulls=True).alias("carried"), *best)
    names_ = ([F.col("carried.terminal")] if terminal else []) + [F.coalesce(F.col(f"slot{s}.name"), F.lit(MISSING)) for s, _, _, _ in slots]
    return one.select("rec_no", F.array(*names_).alias("barcode"), *[F.col(f"carried.{c}").alias(c) for c in carry])


#: Neighbours up to which a lookup table is broadcast; a tag of 15 bases that allows two mismatches has 991.
BROADCAST_NEIGHBOURS = 500_000


def lookups(config: DataFrame, most: int = 3) -> tuple[dict[str, DataFrame], dict[str, list[int]]]:
    """(neighbours, lengths) by kind of a tag configuration (type, name, tag, tolerance, ord).

    Beads (DPM) are exact; the others allow each tag's own tolerance, up to `most`. ODD and EVEN have the lengths of ODD
    tags. A small job reads kinds, lengths and tolerances, a row for each combination, and with them the size that decides
    on a broadcast.
    """
    facts = config.filter(F.col("type").isin("DPM", "Y", "ODD", "EVEN")).groupBy("type", F.length("tag").alias("n"), F.when(F.col("type") == "DPM", 0).otherwise(F.least("tolerance", F.lit(most))).alias("k")).agg(F.count("*").alias("tags")).collect()
    sizes = {kind: sorted({r.n for r in facts if r.type == kind}) for kind in ("DPM", "Y", "ODD", "EVEN")}
    if sizes["ODD"]:
        sizes["EVEN"] = sizes["ODD"]
    near = {}
    for kind in sizes:
        rows = config.filter(F.col("type") == kind)
        k = max((r.k for r in facts if r.type == kind), default=0)
        table = exact(rows) if not k else nearest(hamming_ball(rows, k, tolerance="tolerance"))
        expected = sum(r.tags * sum(math.comb(r.n, j) * 3**j for j in range(r.k + 1)) for r in facts if r.type == kind)
        near[kind] = F.broadcast(table) if expected <= BROADCAST_NEIGHBOURS else table
    return near, sizes


def identify(pairs: DataFrame, config: DataFrame, layout1: str = "DPM", layout2: str = "Y|SPACER|ODD|SPACER|EVEN", offset1: int = 0, offset2: int = 0, most: int = 3) -> DataFrame:
    """Pairs (rec_no, name1, seq1, name2, seq2, ...) with the barcode found in both mates, and annotated names.

    With the bead's tag alone in mate 1, it is looked up and the layout is walked in mate 2: one pass over the pairs and one
    shuffle by record. Any other layout of mate 1 is walked, too, which takes a shuffle more. A part that is no kind of tag is
    an error. The barcode is put behind both names.
    """
    near, sizes = lookups(config, most)
    rest = tuple(c for c in pairs.columns if c != "rec_no")
    parts1 = [x.strip() for x in layout1.split("|")]
    _slots(layout1, SPACER, TAG_SPAN)
    if parts1[0] == "DPM" and set(parts1[1:]) <= {"SPACER"}:
        first = attach_tag(pairs, "seq1", offset1, near["DPM"], sizes["DPM"], "bead") if sizes["DPM"] else pairs.withColumn("bead", F.lit(MISSING))
        first = first.withColumn("bead", F.array("bead"))
    else:
        first = walk_layout(pairs.withColumn("seq", F.col("seq1")), layout1, near, sizes, offset1, carry=rest).withColumnRenamed("barcode", "bead")
    walked = walk_layout(first.withColumn("seq", F.col("seq2")), layout2, near, sizes, offset2, carry=("bead", *rest))
    out = walked.withColumn("barcode", F.concat("bead", "barcode"))
    return out.withColumns({c: names.annotate(F.col(c), F.col("barcode")) for c in ("name1", "name2")}).select("rec_no", *rest, "barcode")


@dataclass(frozen=True)
class Layout:
    """What a configuration says of the reads: the parts of both mates, the spacer's length, and how far a tag may be displaced."""

    read1: tuple[str, ...]
    read2: tuple[str, ...]
    spacer: int = 6
    laxity: int = 6

    def kinds(self) -> list[str]:
        return sorted({p for p in (*self.read1, *self.read2) if p != "SPACER"})


#: Neighbours up to which tasks hold all of them (about 30 bytes each); with more, slots are looked up by joins.
TASK_NEIGHBOURS = 1_000_000


def _near_any(config: DataFrame, kinds: list[str], most: int, alphabet: str) -> tuple[dict[str, DataFrame], dict[str, list[int]], int]:
    """(neighbours, lengths, expected number of neighbours) of each kind, each tag with its own tolerance."""
    facts = config.filter(F.col("type").isin(kinds)).groupBy("type", F.length("tag").alias("n"), F.least("tolerance", F.lit(most)).alias("k")).agg(F.count("*").alias("tags")).collect()  # a row per kind, length and tolerance
    missing = [k for k in kinds if all(r.type != k for r in facts)]
    if missing:
        raise ValueError(f"no tags of kind {', '.join(missing)}")
    near = {}
    for kind in kinds:
        k = max(r.k for r in facts if r.type == kind)
        near[kind] = nearest(hamming_ball(config.filter(F.col("type") == kind).withColumn("tolerance", F.least("tolerance", F.lit(most))), k, alphabet, tolerance="tolerance"))
    expected = sum(r.tags * sum(math.comb(r.n, j) * (len(alphabet) - 1) ** j for j in range(r.k + 1)) for r in facts)
    return near, {kind: sorted({r.n for r in facts if r.type == kind}) for kind in kinds}, expected


def walk_in_tasks(pairs: DataFrame, near: dict[str, DataFrame], layout: Layout) -> DataFrame:
    """pairs with `barcode`: every task holds all neighbours and walks batches of reads, slot by slot; rows stay where they are."""
    table = reduce(DataFrame.unionByName, [near[k].select(F.lit(k).alias("kind"), "neighbour", "name") for k in near]).toArrow()  # at most TASK_NEIGHBOURS rows
    coded = table["name"].combine_chunks().dictionary_encode()
    known, tag, kind = coded.dictionary.to_pylist(), coded.indices.to_numpy(), np.array(table["kind"].to_pylist())
    neighbours = table["neighbour"].to_pylist()
    built = {k: walking.Kind.build([neighbours[i] for i in np.flatnonzero(kind == k)], tag[kind == k].astype(np.int64)) for k in near}
    shared = pairs.sparkSession.sparkContext.broadcast((known, built))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, built = shared.value
        for batch in batches:
            found = [walking.walk(batch.column(c), parts, built, layout.spacer, layout.laxity) for c, parts in (("seq1", layout.read1), ("seq2", layout.read2))]
            yield pa.RecordBatch.from_arrays([*batch.columns, walking.names_of(np.concatenate(found), known)], names=[*batch.schema.names, "barcode"])

    return pairs.mapInArrow(run, T.StructType([*pairs.schema.fields, T.StructField("barcode", T.ArrayType(T.StringType()))]))


def walk_by_joins(pairs: DataFrame, near: dict[str, DataFrame], sizes: dict[str, list[int]], layout: Layout) -> DataFrame:
    """pairs with `barcode`: a join and a shuffle per slot, for tables of any number of neighbours."""
    rows = pairs.withColumns({"__found": F.array().cast("array<string>")})
    for seq, parts in (("seq1", layout.read1), ("seq2", layout.read2)):
        rows = rows.withColumn("__at", F.lit(0))
        for i, part in enumerate(parts):
            if part == "SPACER":
                rows = rows.withColumn("__at", F.least(F.col("__at") + layout.spacer, F.length(seq)))
                continue
            reach = layout.laxity if i else 0
            windows = rows.select("rec_no", F.col(seq).alias("s"), "__at", F.inline(_grid(sizes[part], reach))).filter(F.col("__at") + F.col("o") + F.col("size") <= F.length("s"))
            hits = windows.withColumn("neighbour", F.substring("s", F.col("__at") + F.col("o") + 1, F.col("size"))).join(near[part], "neighbour")
            best = hits.groupBy("rec_no").agg(F.min(F.struct("o", "size", "name")).alias("__hit"))
            missed = F.least(F.col("__at") + reach + max(sizes[part]), F.length(seq))
            rows = rows.join(best, "rec_no", "left").withColumns(
                {"__at": F.coalesce(F.col("__at") + F.col("__hit.o") + F.col("__hit.size"), missed), "__found": F.concat("__found", F.array(F.coalesce("__hit.name", F.lit(MISSING))))}
            ).drop("__hit")
    return rows.withColumnRenamed("__found", "barcode").drop("__at")


def identify_any_layout(pairs: DataFrame, config: DataFrame, layout: Layout, most: int = 3, alphabet: str = "ACGTN") -> DataFrame:
    """Pairs (rec_no, name1, seq1, name2, seq2, ...) with the barcode of any layout on either mate, and annotated names.

    A tag is looked for from where the one before it ended, so a slot's place depends on all before it. Each tag allows its own
    tolerance of substitutions, of N too; of two tags near the same string the last of the configuration counts. A part
    without tags in the configuration is an error.
    """
    near, sizes, expected = _near_any(config, layout.kinds(), most, alphabet)
    out = walk_in_tasks(pairs, near, layout) if expected <= TASK_NEIGHBOURS else walk_by_joins(pairs, near, sizes, layout)
    return out.withColumns({c: names.annotate(F.col(c), F.col("barcode")) for c in ("name1", "name2")})
