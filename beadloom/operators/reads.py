"""Aligned and barcoded reads: pairing, routing to labels, de-duplication, trimming."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import alignment, names

# The assay's adapters, at the 3' end of mate 1, at the 5' end of mate 2, and at the 5' end of bead reads; the
# least length.
ADAPTER_1, ADAPTER_2 = "ATCAGCACTTAGCGTCAG", "CTGACGCTAAGTGCTGAT"
BEAD_ADAPTERS = ["GGTGGTCTTT", "GCCTCTTGTT"]
LEAST_LENGTH = 20
#: Errors per adapter base, and least adapter bases, of an alignment that counts; sequences that are aligned at once.
ERROR_RATE, OVERLAP, BATCH = 0.1, 3, 2048


def aligned(positions: DataFrame) -> DataFrame:
    """Positions of RNA reads with the mate flag."""
    return positions.filter("read_type = 'RPM'").withColumn("is_read1", F.col("ord2") % 2 == 1)


def pair_mates(r1: DataFrame, r2: DataFrame) -> DataFrame:
    """Mates by record number; what has no mate is dropped."""
    return r1.select("rec_no", F.col("name").alias("name1"), F.col("seq").alias("seq1")).join(r2.select("rec_no", F.col("name").alias("name2"), F.col("seq").alias("seq2")), "rec_no")


def paired_only(reads: DataFrame, name: str = "name") -> DataFrame:
    """Reads of names that occur exactly twice."""
    twice = reads.groupBy(name).agg(F.count("*").alias("n")).filter("n = 2").select(name)
    return reads.join(twice, name, "left_semi")


def label_reads(reads: DataFrame, labels: DataFrame, start_only: bool = False) -> DataFrame:
    """Reads with label and fate: skipped without a labelled cluster, written the first time a position is seen in a
    barcode, else duplicate. Mates have keys of their own (the ends change places), unless only starts count."""
    rows = reads.join(labels.select("barcode", "label"), "barcode", "left")
    place = F.concat_ws("_", "chrom", "start_pos") if start_only else F.when(F.col("is_read1"), F.concat_ws("_", "chrom", "start_pos", "end_pos")).otherwise(F.concat_ws("_", "chrom", "end_pos", "start_pos"))
    rows = rows.withColumn("place", place)
    first = Window.partitionBy("barcode", "place").orderBy("ord1", "ord2", "ord3", "ord4", "feature", "chunk")
    rows = rows.withColumn("turn", F.row_number().over(first))
    return rows.withColumn("fate", F.when(F.col("label").isNull(), "skipped").when(F.col("turn") == 1, "written").otherwise("duplicate")).drop("turn")


def summary(labelled: DataFrame) -> DataFrame:
    """Reads per fate and label."""
    return labelled.groupBy("fate", F.coalesce("label", F.lit("")).alias("label")).agg(F.count("*").alias("n"))


def label_by_prefix(reads: DataFrame, keys: DataFrame) -> DataFrame:
    """Reads with the label of clusters that carry it in front of their barcode (label.barcode); others are dropped."""
    shape = r"^([^.]*)\.(.*)$"
    given = keys.select(F.regexp_extract("key", shape, 2).alias("barcode"), F.regexp_extract("key", shape, 1).alias("label"))
    return reads.join(given, "barcode")


def full_barcodes(reads: DataFrame) -> DataFrame:
    """rec_no, barcode, seq, qual of reads with all tags: RPM in front of RNA reads; a bead read's sequence is its name's end."""
    bead = F.contains("name", F.lit("BEAD"))
    t = names.tags(F.col("name"))
    first = F.when(bead, F.element_at(t, 1)).otherwise("RPM")
    seq = F.when(bead, names.oligo_sequence(F.col("name"))).otherwise(F.col("seq"))
    rows = reads.select("rec_no", F.array_join(F.concat(F.array(first), names.rest(t)), "|").alias("barcode"), seq.alias("seq"), F.repeat(F.lit("F"), F.length(seq)).alias("qual"))
    return rows.filter(~F.contains("barcode", F.lit(names.MISSING)))


def antibody_oligos(reads: DataFrame) -> DataFrame:
    """rec_no, seq (the name's end), name with PPM for a missing tag."""
    return reads.select("rec_no", names.oligo_sequence(F.col("name")).alias("seq"), F.replace("name", F.lit(names.MISSING), F.lit("PPM")).alias("name"))


def merge_alignments(first: DataFrame, second: DataFrame) -> DataFrame:
    """Alignments of two aligners under each other."""
    return first.unionByName(second)


def dedup_pairs(pairs: DataFrame) -> DataFrame:
    """One pair per pair of sequences, the first by record, and how many there were."""
    return pairs.groupBy("seq1", "seq2").agg(F.min("rec_no").alias("rec_no"), F.count("*").alias("copies"))


def keep_assembly(reads: DataFrame, assembly: DataFrame, ref: str = "ref", keep_mt: bool = False) -> DataFrame:
    """Reads on an assembly's chromosomes, with their names normalised; MT only if asked for, as chrM."""
    chrom = names.chrom_name(F.col(ref))
    if keep_mt:
        chrom = F.when(F.col(ref) == "MT", "chrM").otherwise(chrom)
    return reads.withColumn("chrom", chrom).join(assembly.select("chrom"), "chrom", "left_semi")


def sort_by(rows: DataFrame, *order: str) -> DataFrame:
    """Rows in order: ranges to as many tasks as the session's shuffles have, each range sorted there, spilling if need be."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)


def coordinate_sort(reads: DataFrame) -> DataFrame:
    """Reads in order of place."""
    return sort_by(reads, "chrom", "start_pos", "end_pos")


def name_sort(reads: DataFrame, name: str = "name", flag: str = "flag") -> DataFrame:
    """Reads in order of name, of a pair the first mate before the second."""
    mate = F.col(flag).bitwiseAND(F.lit(192))  # 64 and 128 mark the mates
    return sort_by(reads.withColumn("__mate", mate), name, "__mate").drop("__mate")


def trim(reads: DataFrame, adapters: list[str], least: int = LEAST_LENGTH) -> DataFrame:
    """Sequences cut at the first adapter; those left shorter than `least` go."""
    return reads.withColumn("seq", names.trim_exact(F.col("seq"), adapters)).filter(F.length("seq") >= least)


def trim_front(reads: DataFrame, adapters: list[str], least: int = 0) -> DataFrame:
    """Sequences from behind the first adapter found in them on; without one they stay whole."""
    starts = [F.when(F.instr("seq", a) > 0, F.instr("seq", a) + len(a)) for a in adapters]
    start = F.coalesce(F.least(*starts) if len(starts) > 1 else starts[0], F.lit(1))
    return reads.withColumn("seq", F.substring("seq", start, F.length("seq"))).filter(F.length("seq") >= least)


def trim_pairs(pairs: DataFrame, least: int = LEAST_LENGTH, errors: int = 0) -> DataFrame:
    """Pairs (seq1, seq2): of mate 1 what stands before its 3' adapter, of mate 2 what stands behind its 5' adapter; a pair
    stays if both are long enough. `errors` substitutions are allowed in an adapter."""
    one, two = names.adapter_place(F.col("seq1"), ADAPTER_1, errors), names.adapter_place(F.col("seq2"), ADAPTER_2, errors)
    # rows of a generator, not columns: the filter below would else be pushed under the search and repeat it, with all that makes up the sequences, per base
    at = pairs.select("*", F.inline(F.array(F.struct(one.alias("__one"), two.alias("__two")))))
    first = F.when(F.col("__one") > 0, F.substring("seq1", F.lit(1), F.col("__one") - 1)).otherwise(F.col("seq1"))
    second = F.when(F.col("__two") > 0, F.substring("seq2", F.col("__two") + len(ADAPTER_2), F.length("seq2"))).otherwise(F.col("seq2"))
    cut = at.withColumns({"seq1": first, "seq2": second}).drop("__one", "__two")
    return cut.filter((F.length("seq1") >= least) & (F.length("seq2") >= least))


def adapter_cuts(reads: DataFrame, ends: dict[str, tuple[list[str], bool]], rate: float = ERROR_RATE, overlap: int = OVERLAP) -> DataFrame:
    """reads with a column `<name>_cut` per column of sequences in `ends`: name -> (adapters, whether they are at the 3' end).

    Adapters are aligned with insertions, deletions and substitutions, up to `rate` per adapter base, and may be cut off at
    that end of the sequence if `overlap` bases are left. The cut is where a 3' adapter begins (else the length), or where
    a 5' adapter ends (else 0). Python aligns batches; a row goes in and out where it is, without a shuffle.
    """
    from pyspark.sql.types import IntegerType, StructField, StructType

    names_ = {c: f"{c}_cut" for c in ends}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH):
                part = whole.slice(at, BATCH)
                more = [pa.array(alignment.cuts(part.column(c), adapters, at_3, rate, overlap), pa.int32()) for c, (adapters, at_3) in ends.items()]
                yield pa.RecordBatch.from_arrays([*part.columns, *more], names=[*part.schema.names, *names_.values()])

    return reads.mapInArrow(run, StructType([*reads.schema.fields, *[StructField(n, IntegerType()) for n in names_.values()]]))


def trim_aligned(pairs: DataFrame, first: list[str] = [ADAPTER_1], second: list[str] = [ADAPTER_2], least: int = LEAST_LENGTH, rate: float = ERROR_RATE, overlap: int = OVERLAP) -> DataFrame:  # noqa: B006
    """Pairs (seq1, seq2, and qual1, qual2 if there): mate 1 up to its 3' adapter, mate 2 from behind its 5' adapter, both aligned
    with errors and where they are cut off at the end; a pair stays if both mates are long enough."""
    cut = adapter_cuts(pairs, {"seq1": (first, True), "seq2": (second, False)}, rate, overlap)
    one = lambda c: F.substring(c, F.lit(1), F.col("seq1_cut"))
    two = lambda c: F.substring(c, F.col("seq2_cut") + 1, F.length(c))
    kept = {c: f(c) for c, f in (("seq1", one), ("qual1", one), ("seq2", two), ("qual2", two)) if c in pairs.columns}
    return cut.withColumns(kept).drop("seq1_cut", "seq2_cut").filter((F.length("seq1") >= least) & (F.length("seq2") >= least))


def trim_front_aligned(reads: DataFrame, adapters: list[str] = BEAD_ADAPTERS, least: int = 0, rate: float = ERROR_RATE, overlap: int = OVERLAP) -> DataFrame:
    """Reads (seq, and qual if there) from behind the best of several 5' adapters, aligned with errors."""
    cut = adapter_cuts(reads, {"seq": (adapters, False)}, rate, overlap)
    kept = {c: F.substring(c, F.col("seq_cut") + 1, F.length(c)) for c in ("seq", "qual") if c in reads.columns}
    return cut.withColumns(kept).drop("seq_cut").filter(F.length("seq") >= least)


def quality_trim(reads: DataFrame, cutoff: int = 20, offset: int = 33) -> DataFrame:
    """The 3' end cut where the running sum of (cutoff - quality), from the end, is greatest; seq and qual alike.

    Scores are folded in the JVM: state is (sum so far, best sum, bases to cut at the best, bases seen).
    """
    step = lambda s, c: F.struct(
        (s["sum"] + F.lit(cutoff + offset) - F.ascii(c)).alias("sum"),
        F.greatest(s["best"], s["sum"] + F.lit(cutoff + offset) - F.ascii(c)).alias("best"),
        F.when((s["sum"] + F.lit(cutoff + offset) - F.ascii(c) > s["best"]), s["seen"] + 1).otherwise(s["cut"]).alias("cut"),
        (s["seen"] + 1).alias("seen"),
        (s["open"] & (s["sum"] + F.lit(cutoff + offset) - F.ascii(c) >= 0)).alias("open"),
    )
    start = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("best"), F.lit(0).alias("cut"), F.lit(0).alias("seen"), F.lit(True).alias("open"))
    guarded = lambda s, c: F.when(s["open"], step(s, c)).otherwise(s)
    cut = F.aggregate(F.reverse(F.split("qual", "")), start, guarded)["cut"]
    kept = F.greatest(F.length("seq") - cut, F.lit(0))
    return reads.withColumns({"seq": F.substring("seq", F.lit(1), kept), "qual": F.substring("qual", F.lit(1), kept)})
