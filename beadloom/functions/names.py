"""Columns over read names, barcodes and sequences."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words of the name format.
MISSING = "NOT_FOUND"
TAG = r"\[([a-zA-Z0-9_\-]+)\]"
BEAD = r"\[BEAD_([a-zA-Z0-9_\-]+)\]"


def tags(name: Column) -> Column:
    """All tags of a name, in order."""
    return F.regexp_extract_all(name, F.lit(TAG), F.lit(1))


def barcode_tags(name: Column, num_tags: int) -> Column:
    """The num_tags tags behind '::'; an error for a name without them."""
    pattern = "^" + TAG * num_tags
    tail = F.substring_index(name, "::", -1)
    found = F.array(*[F.regexp_extract(tail, pattern, i + 1) for i in range(num_tags)])
    return F.when(F.contains(name, F.lit("::")) & tail.rlike(pattern), found).otherwise(F.raise_error(F.concat(F.lit("no barcode in "), name)).cast("array<string>"))


def barcode_key(name: Column, num_tags: int, library: Column) -> Column:
    """Tags but the first, and the library, joined by dots."""
    return F.concat_ws(".", F.slice(barcode_tags(name, num_tags), 2, num_tags - 1), library)


def rest(tags_: Column) -> Column:
    """Tags but the first."""
    return F.slice(tags_, 2, F.greatest(F.size(tags_) - 1, F.lit(0)))


def read_class(name: Column) -> Column:
    """short if a tag behind the first is missing, else BPM with a bead, else RPM."""
    return F.when(F.array_contains(rest(tags(name)), MISSING), "short").when(F.contains(name, F.lit("BEAD")), "BPM").otherwise("RPM")


def read_class_dpm(name: Column) -> Column:
    """The older classes: short if any tag is missing, then DPM, BPM by what the name holds, else other."""
    return F.when(F.array_contains(tags(name), MISSING), "short").when(F.contains(name, F.lit("DPM")), "DPM").when(F.contains(name, F.lit("BEAD")), "BPM").otherwise("other")


def umi_code(seq: Column) -> Column:
    """The first 8 bases as a number of digits 1-4 (N is 0); what is no number is 0."""
    return F.coalesce(F.translate(F.substring(seq, 1, 8), "ACGTN", "12340").try_cast("int"), F.lit(0))


def bead_name(name: Column) -> Column:
    return F.regexp_extract(name, BEAD, 1)


def annotate(name: Column, tags_: Column) -> Column:
    """A name up to its first space, with its tags behind '::'."""
    return F.concat(F.substring_index(name, " ", 1), F.lit("::"), F.array_join(F.transform(tags_, lambda t: F.concat(F.lit("["), t, F.lit("]"))), ""))


def pad(tags_: Column, size: int) -> Column:
    """Tags filled up with NOT_FOUND; an error if there are more than `size`."""
    filled = F.concat(tags_, F.array_repeat(F.lit(MISSING), F.greatest(F.lit(size) - F.size(tags_), F.lit(0)).cast("int")))
    return F.when(F.size(tags_) > size, F.raise_error(F.lit("too many tags")).cast("array<string>")).otherwise(filled)


def condition(last_tag: Column) -> Column:
    """The middle part of a last tag: ROUND1_CNTRL_A1 -> CNTRL."""
    return F.regexp_extract(last_tag, "_([^_]+)_", 1)


def strip_library(barcode: Column) -> Column:
    """A barcode without its last part."""
    return F.regexp_replace(barcode, r"\.[^.]*$", "")


def rename_rpm(name: Column) -> Column:
    return F.replace(name, F.lit(MISSING), F.lit("RPM"))


def oligo_sequence(name: Column) -> Column:
    """What stands behind a name's last underscore."""
    return F.substring_index(name, "_", -1)


def position_score(read_type: Column, chrom: Column) -> Column:
    """Order of positions in a rendered cluster: bead, RNA on chromosomes, other RNA, the rest."""
    return F.when(read_type == "BPM", 1).when((read_type == "RPM") & F.startswith(chrom, F.lit("chr")), 2).when(read_type == "RPM", 3).otherwise(4)


def position_text(read_type: Column, feature: Column, chrom: Column, start: Column, end: Column) -> Column:
    return F.concat(read_type, F.lit("["), feature, F.lit("]_"), chrom, F.lit(":"), start.cast("string"), F.lit("-"), end.cast("string"))


def hamming(a: Column, b: Column) -> Column:
    """Places in which two strings of one length differ; null for different lengths."""
    unequal = F.aggregate(F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: (x != y).cast("int")), F.lit(0), lambda s, d: s + d)
    return F.when(F.length(a) == F.length(b), unequal)


def chrom_name(ref: Column) -> Column:
    """A reference name with chr in front, unless it has one."""
    return F.when(F.contains(ref, F.lit("chr")), ref).otherwise(F.concat(F.lit("chr"), ref))


def trim_exact(seq: Column, adapters: list[str]) -> Column:
    """A sequence up to the first place of any adapter."""
    ends = [F.when(F.instr(seq, a) > 0, F.instr(seq, a) - 1).otherwise(F.length(seq)) for a in adapters]
    return F.substring(seq, F.lit(1), reduce(F.least, ends) if len(ends) > 1 else ends[0])


def strand(flag: Column) -> Column:
    return F.when(flag.bitwiseAND(F.lit(16)) == 0, "+").otherwise("-")


def is_mapped(flag: Column) -> Column:
    return flag.bitwiseAND(F.lit(4)) == 0


def bead_of_position(text: Column) -> Column:
    """The bead of a position's text: what stands behind the first underscore of its part before the colon."""
    return F.regexp_extract(F.substring_index(text, ":", 1), r"^[^_]*_(.*)$", 1)


def insert_blank(tag: Column) -> Column:
    """A tag's name with BLANK as its second part."""
    return F.array_join(F.array_insert(F.split(tag, "_"), 2, F.lit("BLANK")), "_")


def adapter_place(seq: Column, adapter: str, errors: int = 0) -> Column:
    """The first place (from 1) where a sequence is the adapter but for `errors` substitutions; 0 without one."""
    if not errors:
        return F.instr(seq, adapter)
    n = len(adapter)
    # of errors + 1 parts of the adapter one is without a substitution, so only windows with such a part are compared base by base
    cuts = [n * k // (errors + 1) for k in range(errors + 2)]
    parts = [(a, adapter[a:b]) for a, b in zip(cuts, cuts[1:])]
    has_part = lambda at: reduce(lambda a, b: a | b, [F.substring(seq, at + i, F.lit(len(part))) == part for i, part in parts])
    wrong = lambda at: reduce(lambda a, b: a + b, [(F.substring(seq, at + i, F.lit(1)) != c).cast("int") for i, c in enumerate(adapter)])
    possible = reduce(lambda a, b: a | b, [F.contains(seq, F.lit(part)) for _, part in parts]) & (F.length(seq) >= n)
    places = F.when(possible, F.sequence(F.lit(1), F.length(seq) - n + 1)).otherwise(F.array().cast("array<int>"))
    return F.coalesce(F.try_element_at(F.filter(places, lambda at: has_part(at) & (wrong(at) <= errors)), F.lit(1)), F.lit(0))


def seconds(text: Column) -> Column:
    """h:m:s as seconds."""
    parts = F.split(text, ":")
    return parts[0].cast("long") * 3600 + parts[1].cast("long") * 60 + parts[2].cast("long")


def right_bin(value: Column, edges: list[float]) -> Column:
    """Number of edges below the value (bins closed on the right)."""
    return sum((F.when(value > e, 1).otherwise(0) for e in edges), F.lit(0))


def left_bin(value: Column, edges: list[float]) -> Column:
    """Number of edges at or below the value (bins closed on the left)."""
    return sum((F.when(value >= e, 1).otherwise(0) for e in edges), F.lit(0))
