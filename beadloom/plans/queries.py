"""Every operator as a query over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import names
from ..operators import clusters, genome, qc, reads, tags
from ..sources import bam, chunks, fastq, store, tables
from ..streaming import logs
from .adapters import view

ADAPTERS = ["ATCAGC", "CTGACG"]
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable) -> Callable:
    QUERIES[f.__name__] = f
    return f


def over(name: str) -> Callable:
    """A query that is a function of one view."""

    def wrap(f: Callable[[DataFrame], DataFrame]) -> Callable:
        QUERIES[f.__name__] = lambda spark, sf_dir: f(view(spark, sf_dir, name))
        return f

    return wrap


# sources


@over("reads_v")
def fastq_record_framing(r):
    lines = r.select(F.lit("sim").alias("file"), "rec_no", F.posexplode(F.array("name", "seq", F.lit("+"), F.repeat(F.lit("F"), F.length("seq")))).alias("i", "line"))
    found = fastq.frame_lines(lines.select("file", (F.col("rec_no") * 4 + F.col("i")).alias("line_no"), "line"))
    return found.select("rec_no", "name", "seq", "plus", F.length("qual").cast("long").alias("qual_length"))


def _records(r: DataFrame) -> DataFrame:
    return r.select("name", "seq", F.lit("+").alias("plus"), F.repeat(F.lit("F"), F.length("seq")).alias("qual"))


@query
def fastq_round_trip(spark, d):
    """Reads written as plain and as packed FASTQ, and read back."""
    r, folder = view(spark, d, "reads_v"), store.scratch(spark)
    fastq.write(_records(r.filter("chunk < 4")), folder)
    fastq.write(_records(r.filter("chunk >= 4")), folder, packed=True)
    return fastq.read(spark, folder).select(F.endswith("file", F.lit(".gz")).alias("packed"), "name", "seq", "plus", F.length("qual").cast("long").alias("qual_length"))


@query
def fastq_split(spark, d):
    """Plain FASTQ read in ranges of 128 KB, records numbered within their file."""
    folder = store.scratch(spark)
    fastq.write(_records(view(spark, d, "reads_v")), folder)
    rows = fastq.read(spark, folder, split_bytes=1 << 17)
    files = rows.groupBy("file").agg(((F.count("*") == F.max("rec_no") + 1) & (F.countDistinct("rec_no") == F.count("*"))).alias("gapless"))
    return rows.join(F.broadcast(files), "file").select("name", "seq", F.length("qual").cast("long").alias("qual_length"), "gapless")  # a row per file


REFERENCES = [(f"chr{i}", 44444444) for i in range(1, 23)] + [("chrX", 44444444), ("45S", 44444444), ("MT", 44444444)]


def _alignments(p: DataFrame) -> DataFrame:
    """Positions of RNA reads as alignments of 20 or more bases."""
    span = (F.col("end_pos") - F.col("start_pos")).cast("int")
    flag = F.when(F.col("feature") == "-", 16).otherwise(0) + F.when(F.col("ord2") % 2 == 1, 64).otherwise(128)
    return p.filter("read_type = 'RPM'").select(
        F.concat_ws(":", "ord1", "ord2", "ord3", "ord4").alias("qname"), flag.cast("int").alias("flag"), F.col("chrom").alias("ref_name"), F.col("start_pos").cast("int").alias("ref_start"), F.col("end_pos").cast("int").alias("ref_end"),
        F.concat(span.cast("string"), F.lit("M")).alias("cigar"), F.repeat(F.lit("A"), span).alias("seq"), F.lit("").alias("qual"), F.create_map(F.lit("BC"), F.col("barcode")).alias("tags"), "barcode",
    )


@query
def bam_round_trip(spark, d):
    """Alignments written as BAM files and read back."""
    folder = store.scratch(spark)
    bam.write(_alignments(view(spark, d, "positions_v")), folder, REFERENCES)
    rows = bam.read(spark, folder)
    return rows.select("qname", F.col("flag").cast("long").alias("flag"), "ref_name", F.col("ref_start").cast("long").alias("ref_start"), F.col("ref_end").cast("long").alias("ref_end"), "cigar", F.element_at("tags", "BC").alias("barcode"))


REGIONS = [("chr3", 500, 1200), ("chrX", 0, 300), ("45S", 2000, 2001)]


@query
def bam_region(spark, d):
    """Alignments written in ranges of the genome with an index each, and three regions fetched by the index."""
    folder = store.scratch(spark)
    bam.write_sorted(_alignments(view(spark, d, "positions_v")), folder, REFERENCES)
    found = [bam.fetch(spark, folder, *r).select(F.lit(r[0]).alias("region"), "qname", F.col("flag").cast("long").alias("flag"), F.col("ref_start").cast("long").alias("ref_start"), F.col("ref_end").cast("long").alias("ref_end")) for r in REGIONS]
    return found[0].unionByName(found[1]).unionByName(found[2])


@query
def bam_header(spark, d):
    """The headers of files per library, written from a template with other lines, merged over the files."""
    p, folder = view(spark, d, "positions_v"), store.scratch(spark)
    template = bam.Header.build(REFERENCES, ["template"])
    bam.write_by(_alignments(p).join(p.select("barcode", "library").distinct(), "barcode"), folder, template, "library")
    return bam.header_lines(spark, folder).groupBy("kind", "name").agg(F.max("length").alias("length")).filter("kind <> 'HD'")


@query
def bam_typed_tags(spark, d):
    """Tags of four types, mates and mapping qualities, written and read back."""
    folder = store.scratch(spark)
    p = _alignments(view(spark, d, "positions_v").withColumn("n", F.col("ord4") - 100))
    start = F.col("ref_start").cast("string")
    values = F.create_map(F.lit("BC"), F.col("barcode"), F.lit("NM"), (F.col("ref_start") - 100).cast("string"), F.lit("ZS"), F.when(F.col("flag") > 100, "x").otherwise("y"), F.lit("ZB"), F.concat_ws(",", start, F.lit("-1")))
    types = F.create_map(*[F.lit(x) for x in ("BC", "Z", "NM", "i", "ZS", "A", "ZB", "Bi")])
    more = {"tags": values, "tag_types": types, "mapq": F.col("ref_start") % 61, "mate_ref": F.col("ref_name"), "mate_start": F.col("ref_end"), "insert_size": -F.col("ref_start")}
    bam.write(p.withColumns(more), folder, bam.Header.build(REFERENCES))
    rows = bam.read(spark, folder)
    tag = lambda c, k: F.element_at(c, k)
    return rows.select(
        "qname", tag("tags", "BC").alias("barcode"), tag("tags", "NM").cast("long").alias("nm"), tag("tags", "ZS").alias("zs"), tag("tags", "ZB").alias("zb"),
        F.concat_ws(",", *[tag("tag_types", k) for k in ("BC", "NM", "ZS", "ZB")]).alias("types"), F.col("mapq").cast("long").alias("mapq"), "mate_ref", F.col("mate_start").cast("long").alias("mate_start"), F.col("insert_size").cast("long").alias("insert_size"),
    )


@query
def bam_by_label(spark, d):
    """Alignments routed to BAM files per label of their cluster, with read groups, and read back."""
    p, folder = view(spark, d, "positions_v"), store.scratch(spark)
    labels = clusters.label(clusters.build(p)).select("barcode", "label")
    bam.write_by(_alignments(p).join(labels, "barcode"), folder, REFERENCES, "label")
    rows = bam.read(spark, folder)
    folder_label = F.regexp_extract("file", "label=([^/]*)/", 1)
    return rows.groupBy(F.element_at("tags", "RG").alias("label")).agg(F.count("*").alias("n"), F.count_if(folder_label != F.element_at("tags", "RG")).alias("elsewhere"))


@query
def strand_of_alignments(spark, d):
    rows = _alignments(view(spark, d, "positions_v"))
    return rows.groupBy("ref_name", names.strand(F.col("flag")).alias("strand")).agg(F.count("*").alias("n"))


@query
def cluster_files(spark, d):
    """Clusters written as text lines, streamed from sorted positions, and read back."""
    folder = store.scratch(spark)
    tables.write_clusters(clusters.build(view(spark, d, "positions_v")), folder)
    return tables.read_clusters(spark, folder)


@query
def tag_tables(spark, d):
    """A tag configuration written as text with comments and short lines, and read back."""
    folder = store.scratch(spark)
    lines = view(spark, d, "tags_v").select(F.concat_ws("\n", F.array_sort(F.collect_list(F.concat_ws("\t", F.lit("ODD"), "name", "tag", (F.col("ord") % 3).cast("string"))))).alias("t"))
    text = F.concat(F.lit("READ1 = DPM\nREAD2 = Y|SPACER|ODD\n\n# type\tname\n"), "t", F.lit("\nODD\tshort\nODD\tbad\tACGT\tmany\n"))
    lines.select(text.alias("value")).coalesce(1).write.text(folder)
    return tables.tag_config(spark, folder).select("type", "name", "tag", F.col("tolerance").cast("long").alias("tolerance"))


@query
def round_tables(spark, d):
    """Allowed positions written as tab-separated text, and read back both ways."""
    folder = store.scratch(spark)
    view(spark, d, "format_v").select(F.col("pos").cast("int").alias("pos"), "name", F.lit("x").alias("more")).write.csv(folder, sep="\t")
    one = tables.rounds(spark, folder).groupBy("pos").agg(F.countDistinct("name").alias("names"))
    two = tables.tab_separated(spark, folder, "pos int, name string, more string").groupBy("pos").agg(F.min("name").alias("first"))
    return one.join(two, "pos").withColumn("pos", F.col("pos").cast("long"))


@query
def manifests(spark, d):
    """A JSON manifest of files, and nested settings, written and read back."""
    folder, other = store.scratch(spark), store.scratch(spark)
    r = view(spark, d, "reads_v").select(F.concat(F.lit("S"), (F.col("rec_no") % 9).cast("string")).alias("sample"), (F.col("rec_no") % 5).cast("string").alias("k")).distinct()
    each = r.groupBy("sample").agg(F.array_sort(F.collect_list("k")).alias("k"))
    entry = F.struct("sample", F.create_map(F.lit("R1"), F.transform("k", lambda x: F.concat(F.lit("/a/"), x)), F.lit("R2"), F.transform("k", lambda x: F.concat(F.lit("/b/"), x))).alias("r"))
    each.select(F.to_json(F.map_from_entries(F.collect_list(entry))).alias("value")).coalesce(1).write.text(folder)
    nested = r.groupBy("sample").agg(F.count("*").alias("n")).groupBy().agg(F.array_join(F.array_sort(F.collect_list(F.concat(F.lit("  - name: "), "sample", F.lit("\n    reads: ["), F.col("n").cast("string"), F.lit(", 'R1, R2']")))), "\n").alias("l"))
    head = "# settings\nassembly: mm10\nnum_tags: 6  # tags\nbID: 'config.txt'\nsamples:\n"
    nested.select(F.concat(F.lit(head), "l").alias("value")).coalesce(1).write.text(other)
    found = tables.settings(spark, other).filter("value <> ''").select(F.lit("settings").alias("sample"), F.col("key").alias("read"), F.col("value").alias("path"))
    return tables.manifest(spark, folder).unionByName(found)


@over("positions_v")
def render_clusters(p):
    return clusters.render(clusters.build(p))


@over("positions_v")
def parse_cluster_lines(p):
    return clusters.parse(clusters.render(clusters.build(p)))


@query
def discover_samples(spark, d):
    """Reads written as files named after sample, lane and mate, and the samples found by the names; those of mate 3 are none."""
    r, folder = view(spark, d, "reads_v"), store.scratch(spark)
    file = F.concat(F.lit("S"), (F.col("rec_no") % 7).cast("string"), F.lit("_L"), (F.col("chunk") % 2).cast("string"), F.lit("_R"), (F.col("rec_no") % 3 + 1).cast("string"), F.when(F.col("rec_no") % 2 == 0, ".fastq.gz").otherwise(".fq"))
    fastq.write_named(r.select(file.alias("file"), "name", "seq", F.lit("+").alias("plus"), F.repeat(F.lit("F"), F.length("seq")).alias("qual")), folder, "file")
    found = fastq.discover(spark, folder)
    return found.select("sample", "read", F.array_join(F.transform(F.split("paths", ","), lambda p: F.element_at(F.split(p, "/"), -1)), ",").alias("paths"))


@over("positions_v")
def route_by_label(p):
    built = clusters.build(p)
    return reads.label_reads(reads.aligned(built), clusters.label(built)).filter("fate = 'written'").groupBy("label").agg(F.count("*").alias("n"), F.countDistinct("barcode").alias("barcodes"))


@query
def concat_reports(spark, d):
    """Five reports written as text files in a folder each, and read under each other with the name of their folder."""
    folder = store.scratch(spark)
    r = view(spark, d, "log_v")
    text = F.concat(F.col("line_no").cast("string"), F.lit("\t"), "line").alias("value")
    r.select(F.concat(F.lit("report_"), (F.col("line_no") % 5).cast("string"), F.lit(".txt")).alias("report"), text).write.partitionBy("report").text(folder)
    line = F.substring_index("line", "\t", -1)
    return tables.reports(spark, folder).select(F.regexp_extract("folder", "^report=(.*)$", 1).alias("file"), F.upper(F.trim(line)).alias("line"), F.substring_index("line", "\t", 1).cast("long").alias("line_no"))


@over("positions_v")
def paired_only(p):
    rows = p.select(F.concat_ws("_", "ord1", "ord3").alias("name"), "ord2", "chrom")
    return reads.paired_only(rows).groupBy("name").agg(F.count("*").alias("n"), F.sum("ord2").alias("mates"))


# tags


@over("tags_v")
def hamming_ball(t):
    return tags.hamming_ball(t).select("name", "neighbour")


@query
def bead_lookup(spark, d):
    return tags.lookup_at(view(spark, d, "reads_v"), view(spark, d, "tags_v"), 3, [7, 8]).select("rec_no", "name")


@query
def terminal_lookup(spark, d):
    return tags.lookup_at(view(spark, d, "reads_v"), view(spark, d, "tags_v"), 0, [7, 8]).select("rec_no", "name", F.col("advance").cast("long").alias("advance"))


@query
def fuzzy_tag_lookup(spark, d):
    near = tags.nearest(tags.hamming_ball(view(spark, d, "tags_v")))
    starts = view(spark, d, "reads_v").select("rec_no", F.lit(0).alias("slot"), "seq", F.lit(10).alias("start"))
    hits = tags.lookup_window(starts, near, [7, 8])
    return starts.select("rec_no").join(hits, "rec_no", "left").select("rec_no", F.coalesce("name", F.lit(names.MISSING)).alias("name"))


@query
def fuzzy_tag_lookup_n(spark, d):
    """With N in the alphabet, and the next start at the match's own end."""
    near = tags.nearest(tags.hamming_ball(view(spark, d, "tags_v"), 1, "ACGTN"))
    starts = view(spark, d, "reads_v").select("rec_no", F.lit(0).alias("slot"), "seq", F.lit(10).alias("start"))
    return tags.lookup_next(starts, near, [7, 8])


LAYOUT = "Y|SPACER|ODD|SPACER|ODD|SPACER|ODD"


def _barcodes(spark, d):
    t = view(spark, d, "tags_v")
    return tags.walk_layout(view(spark, d, "reads_v"), LAYOUT, {"Y": tags.exact(t), "ODD": tags.nearest(tags.hamming_ball(t))}, {"Y": [7, 8], "ODD": [7, 8]})


@query
def barcode_layout(spark, d):
    return _barcodes(spark, d).select("rec_no", F.array_join("barcode", "|").alias("barcode"))


def tag_config(spark: SparkSession, d: str) -> DataFrame:
    """The tags as a configuration: four kinds, tolerances 0, 1 and 2."""
    kinds = F.element_at(F.array(*[F.lit(k) for k in ("DPM", "Y", "ODD", "EVEN")]), (F.col("ord") % 4 + 1).cast("int"))
    return view(spark, d, "tags_v").select(kinds.alias("type"), "name", F.substring("tag", F.lit(1), (6 + F.floor(F.col("ord") / 4) % 2).cast("int")).alias("tag"), (F.floor(F.col("ord") / 4) % 3).cast("int").alias("tolerance"), "ord")


@query
def identify(spark, d):
    """Both mates against beads, terminal, odd and even tags of tolerance 0 to 2; names annotated."""
    r = view(spark, d, "reads_v").withColumn("bare", F.concat(F.substring_index("name", "::", 1), F.lit(" 1:N:0")))
    pairs = r.select("rec_no", F.col("bare").alias("name1"), F.col("seq").alias("seq1"), F.col("bare").alias("name2"), F.reverse("seq").alias("seq2"))
    found = tags.identify(pairs, tag_config(spark, d), "DPM", "Y|SPACER|ODD|SPACER|EVEN|SPACER|ODD", 2, 1)
    return found.select("rec_no", "name1", "name2", F.array_join("barcode", "|").alias("barcode"))


def _any_layout(spark, d):
    """Pairs with some N, a tag configuration and a layout of both mates, both read back from a file."""
    folder = store.scratch(spark)
    rows = tag_config(spark, d).select(F.concat_ws("\t", "type", "name", "tag", F.col("tolerance").cast("string")).alias("value"), "ord")
    lines = ["READ1 = DPM | SPACER | ODD", "READ2 = Y|SPACER|ODD|EVEN|SPACER|ODD", "SPACER = 4", "LAXITY = 3", "# tags"]
    first = rows.limit(1).select(F.explode(F.array(*[F.struct(F.lit(x).alias("value"), F.lit(i - 9).cast("long").alias("ord")) for i, x in enumerate(lines)])).alias("x")).select("x.*")
    rows.unionByName(first).coalesce(1).sortWithinPartitions("ord").select("value").write.text(folder)  # a configuration is one small file
    r = view(spark, d, "reads_v").withColumn("bare", F.concat(F.substring_index("name", "::", 1), F.lit(" 1:N:0")))
    noisy = F.when(F.col("rec_no") % 5 == 0, F.overlay("seq", F.lit("N"), F.lit(9), F.lit(1))).otherwise(F.col("seq"))
    pairs = r.select("rec_no", F.col("bare").alias("name1"), F.substring(noisy, F.lit(1), (20 + F.col("rec_no") % 45).cast("int")).alias("seq1"), F.col("bare").alias("name2"), F.reverse(noisy).alias("seq2"))
    return pairs, tables.tag_config(spark, folder, skip=0), tables.layout(spark, folder)


@query
def identify_any_layout(spark, d):
    """Both mates by the layout of a configuration; each tag is looked for from the end of the one before."""
    found = tags.identify_any_layout(*_any_layout(spark, d))
    return found.select("rec_no", "name1", F.array_join("barcode", "|").alias("barcode"))


@over("reads_v")
def pad_barcode(r):
    return r.select("rec_no", F.array_join(names.pad(names.tags(F.col("name")), 6), "|").alias("barcode"))


@over("reads_v")
def annotate_name(r):
    bare = F.concat(F.substring_index("name", "::", 1), F.lit(" 1:N:0"))
    return r.select("rec_no", names.annotate(bare, names.tags(F.col("name"))).alias("name"))


@over("tags_v")
def tag_ambiguity(t):
    return tags.ambiguous(tags.hamming_ball(t))


@over("reads_v")
def hamming_distance(r):
    return r.select("rec_no", names.hamming(F.substring("seq", 1, 32), F.substring("seq", 33, 32)).cast("long").alias("distance"))


# names


@over("reads_v")
def extract_tags(r):
    return r.select("rec_no", F.array_join(names.tags(F.col("name")), ",").alias("tags"))


@over("reads_v")
def barcode_key(r):
    return r.select("rec_no", names.barcode_key(F.col("name"), 4, F.concat(F.lit("EXP"), F.col("chunk").cast("string"))).alias("barcode"))


@over("reads_v")
def classify_reads(r):
    return r.select("rec_no", names.read_class(F.col("name")).alias("read_class"))


@over("reads_v")
def classify_reads_dpm(r):
    return r.select("rec_no", names.read_class_dpm(F.col("name")).alias("read_class"))


@over("reads_v")
def full_barcodes(r):
    return reads.full_barcodes(r)


@over("reads_v")
def umi_encode(r):
    return r.select("rec_no", names.umi_code(F.when(F.col("rec_no") % 9 == 0, F.lower("seq")).otherwise(F.col("seq"))).cast("long").alias("umi"))


@over("reads_v")
def bead_name(r):
    return r.select("rec_no", names.bead_name(F.col("name")).alias("bead")).filter("bead <> ''")


@over("reads_v")
def ab_oligo(r):
    return reads.antibody_oligos(r)


@over("reads_v")
def rpm_rename(r):
    return r.filter(F.contains("name", F.lit(names.MISSING))).select("rec_no", names.rename_rpm(F.col("name")).alias("name"))


@query
def chrom_filter(spark, d):
    p = view(spark, d, "positions_v").filter("read_type = 'RPM'").select(F.when(F.col("ord1") % 2 == 0, F.replace("chrom", F.lit("chr"), F.lit(""))).otherwise(F.col("chrom")).alias("ref"))
    return reads.keep_assembly(p, genome.assembly(spark, "hg38")).groupBy("chrom").agg(F.count("*").alias("n"))


@over("positions_v")
def flag_filter(p):
    flag = (F.when(F.col("chrom") == "MT", 4).otherwise(0) + F.when(F.col("feature") == "-", 16).otherwise(0)).alias("flag")
    rows = p.select("chrom", flag)
    return rows.groupBy(names.is_mapped(F.col("flag")).alias("mapped"), names.strand(F.col("flag")).alias("strand")).agg(F.count("*").alias("n"))


@over("positions_v")
def bead_of_position(p):
    text = names.position_text(F.col("read_type"), F.col("feature"), F.col("chrom"), F.col("start_pos"), F.col("end_pos"))
    return p.filter("read_type = 'BPM'").groupBy(names.bead_of_position(text).alias("bead")).agg(F.count("*").alias("n"))


@over("positions_v")
def position_score(p):
    return p.select(names.position_score(F.col("read_type"), F.col("chrom")).cast("long").alias("score")).groupBy("score").agg(F.count("*").alias("n"))


@over("positions_v")
def condition_split(p):
    return p.groupBy(names.condition(F.col("tag3")).alias("cond")).agg(F.count("*").alias("n"), F.countDistinct("barcode").alias("barcodes"))


@over("positions_v")
def condition_discovery(p):
    return clusters.conditions(p)


@over("positions_v")
def strip_library(p):
    return p.groupBy(names.strip_library(F.col("barcode")).alias("barcode")).agg(F.count("*").alias("n"))


@over("reads_v")
def cdna_length_hist(r):
    rows = qc.sequence_lengths(r.withColumn("seq", F.substring("seq", F.instr("seq", "ACG") + 1, F.length("seq"))), (F.col("chunk") % 2 + 1).alias("mate"))
    return qc.equal_width_histogram(rows, "len", ["mate"]).select("mate", F.col("bin").cast("long").alias("bin"), "n")


@over("positions_v")
def cluster_category(p):
    s = clusters.sizes(clusters.build(p))
    return s.select(clusters.category(F.col("n_bpm"), F.col("n_rpm")).alias("category")).groupBy("category").agg(F.count("*").alias("n"))


@over("positions_v")
def fix_blank_tag(p):
    t = p.select("tag3").distinct()
    return t.select("tag3", names.insert_blank(F.col("tag3")).alias("fixed"))


@over("reads_v")
def adapter_trim_exact(r):
    return reads.trim(r.select("rec_no", "seq"), ADAPTERS, 20)


def _with_adapters(r: DataFrame, one: str, two: str) -> DataFrame:
    """Pairs with an adapter within mate 1 and one within mate 2 of most reads."""
    at1, at2 = (F.col("rec_no") % 45).cast("int"), (F.col("rec_no") % 50).cast("int")
    first = F.when(F.col("rec_no") % 6 > 0, F.concat(F.substring("seq", F.lit(1), at1), F.lit(one), F.lit("GGGG"))).otherwise(F.col("seq"))
    second = F.when(F.col("rec_no") % 5 > 0, F.concat(F.substring("seq", F.lit(1), at2), F.lit(two), F.substring("seq", at2 + 1, F.lit(64)))).otherwise(F.col("seq"))
    return r.select("rec_no", first.alias("seq1"), second.alias("seq2"))


@over("reads_v")
def trim_pairs(r):
    return reads.trim_pairs(_with_adapters(r, reads.ADAPTER_1, reads.ADAPTER_2))


@over("reads_v")
def trim_pairs_mismatch(r):
    """Adapters with one base changed, and one mismatch allowed."""
    return reads.trim_pairs(_with_adapters(r, "T" + reads.ADAPTER_1[1:], reads.ADAPTER_2[:9] + "C" + reads.ADAPTER_2[10:]), errors=1)


@over("reads_v")
def trim_aligned(r):
    """Adapters with a base too many, a base too few or a wrong one, and cut off at the read's end in every fourth pair."""
    k = F.col("rec_no")
    one, two = reads.ADAPTER_1, reads.ADAPTER_2
    variants = lambda a: F.element_at(F.array(*[F.lit(x) for x in (a, a[:7] + "A" + a[7:], a[:11] + a[12:], a[:4] + "N" + a[5:])]), (k % 4 + 1).cast("int"))
    whole1 = F.concat(F.substring("seq", F.lit(1), (k % 45).cast("int")), variants(one), F.lit("GGGG"))
    part1 = F.concat(F.substring("seq", F.lit(1), F.lit(30)), F.substring(F.lit(one), F.lit(1), (k % 19).cast("int")))
    whole2 = F.concat(F.substring("seq", F.lit(1), (k % 9).cast("int")), variants(two), F.substring("seq", F.lit(10), F.lit(50)))
    part2 = F.concat(F.substring(F.lit(two), (k % 19 + 1).cast("int"), F.lit(18)), F.substring("seq", F.lit(20), F.lit(40)))
    pairs = r.select("rec_no", F.when(k % 4 == 0, part1).otherwise(whole1).alias("seq1"), F.when(k % 4 == 0, part2).otherwise(whole2).alias("seq2"))
    return reads.trim_aligned(pairs)


@over("reads_v")
def trim_front(r):
    """Bead reads from behind the first exact adapter."""
    k = F.col("rec_no")
    made = F.concat(F.substring("seq", F.lit(1), (k % 12).cast("int")), F.element_at(F.array(*[F.lit(a) for a in reads.BEAD_ADAPTERS]), (k % 2 + 1).cast("int")), F.substring("seq", F.lit(20), F.lit(20)))
    return reads.trim_front(r.select("rec_no", F.when(k % 5 > 0, made).otherwise(F.col("seq")).alias("seq")), reads.BEAD_ADAPTERS)


@over("reads_v")
def quality_trim(r):
    """Qualities made from the bases, so that tails differ."""
    qual = F.translate(F.concat(F.substring("seq", 1, 40), F.substring("seq", 41, 24)), "ACGT", "I5+#")
    return reads.quality_trim(r.select("rec_no", "seq", qual.alias("qual")), 20)


@over("log_v")
def hms_to_seconds(r):
    text = F.concat_ws(":", (F.col("line_no") % 30).cast("string"), (F.col("line_no") % 60).cast("string"), (F.col("line_no") % 59).cast("string"))
    return r.select("line_no", names.seconds(text).alias("seconds"))


# joins


@over("reads_v")
def pair_mates(r):
    return reads.pair_mates(r, r.withColumn("seq", F.reverse("seq"))).select("rec_no", "seq1", "seq2")


def _labelled(p: DataFrame, start_only: bool = False) -> DataFrame:
    return reads.label_reads(reads.aligned(p), clusters.label(clusters.build(p)).filter("label <> 'none'"), start_only)


@over("positions_v")
def label_reads(p):
    return reads.summary(_labelled(p))


@over("positions_v")
def label_reads_startonly(p):
    return reads.summary(_labelled(p, True))


@over("positions_v")
def label_summary(p):
    return _labelled(p).groupBy("fate").agg(F.count("*").alias("n"))


@over("positions_v")
def label_reads_prelabelled(p):
    keys = clusters.label(clusters.build(p)).select(F.concat_ws(".", "label", "barcode").alias("key"))
    return reads.label_by_prefix(reads.aligned(p), keys).groupBy("label").agg(F.count("*").alias("n"))


@query
def split_complete(spark, d):
    return clusters.split_complete(view(spark, d, "positions_v"), view(spark, d, "format_v")).select("barcode", F.col("n_bad").cast("long").alias("n_bad"), "complete")


@over("positions_v")
def leave_one_out(p):
    return qc.leave_one_out(p.select(F.concat("library", F.lit("_"), F.col("chunk").cast("string")).alias("bam")), "bam")


@over("positions_v")
def dedup_reads(p):
    return _labelled(p).filter("fate = 'written'").groupBy("barcode").agg(F.count("*").alias("n"), F.min("place").alias("first_place"))


@over("positions_v")
def assignment_distribution(p):
    return clusters.assignment(clusters.label(clusters.build(p)))


# aggregation


@over("positions_v")
def cluster_build(p):
    return clusters.build(p).select("barcode", "read_type", "feature", "chrom", "start_pos", "end_pos")


@over("positions_v")
def position_dedup(p):
    return clusters.dedup_positions(p).groupBy("barcode").agg(F.count("*").alias("n"), F.count_if(F.expr("feature = '+'")).alias("plus"), F.sum("ord2").alias("ord2"))


@over("positions_v")
def cluster_sizes(p):
    return clusters.sizes(clusters.build(p))


@over("positions_v")
def bpm_rpm_counts(p):
    return clusters.sizes(clusters.build(p)).select("barcode", F.col("n_bpm").alias("BPM"), F.col("n_rpm").alias("RPM"))


@over("positions_v")
def coverage(p):
    return clusters.coverage(clusters.build(p), "RPM")


@over("positions_v")
def contains_bead(p):
    return clusters.contains_bead(p, "L3")


@over("positions_v")
def stripped_lookup(p):
    return clusters.stripped_lookup(clusters.build(p))


@over("positions_v")
def cluster_merge(p):
    """Built by chunk in one pass, then merged."""
    merged = clusters.merge(clusters.build_chunks(p, "chunk"))
    return merged.groupBy("barcode", "read_type").agg(F.count("*").alias("n"), F.sum("start_pos").alias("starts"), F.count_if(F.expr("feature = '-'")).alias("minus"))


@query
def cluster_merge_sorted(spark, d):
    """Clusters of each chunk kept in buckets of barcodes, sorted; merged without a shuffle."""
    folder = store.scratch(spark)
    table = f"clusters_{folder[-32:]}"
    p = view(spark, d, "positions_v")
    for part in ("chunk < 2", "chunk >= 2"):  # two runs add to one table
        chunks.write_clusters(p.filter(part), table, folder, 8)
    return chunks.merge_clusters(spark, table).groupBy("barcode", "read_type").agg(F.count("*").alias("n"), F.sum("start_pos").alias("starts"), F.count_if(F.expr("feature = '-'")).alias("minus"))


@over("positions_v")
def cluster_label(p):
    return clusters.label(clusters.build(p))


@over("reads_v")
def ligation_by_count(r):
    return qc.ligation_by_count(r).withColumn("n_found", F.col("n_found").cast("long"))


@over("reads_v")
def ligation_by_position(r):
    return qc.ligation_by_position(r).withColumn("pos", F.col("pos").cast("long"))


@over("reads_v")
def barcode_completeness(r):
    return qc.completeness(r)


@over("reads_v")
def read_counts(r):
    return qc.read_totals(r)


@over("reads_v")
def reads_per_chunk(r):
    return qc.chunk_counts(r)


@over("positions_v")
def distinct_reads(p):
    return qc.name_totals(p.filter("read_type = 'RPM'"), "ord1")


def _umis(p: DataFrame) -> DataFrame:
    return p.filter("read_type = 'BPM'").select("barcode", F.concat_ws("_", "chrom", "start_pos").alias("umi"))


@over("positions_v")
def umi_duplication(p):
    return qc.umi_duplication(_umis(p))


@over("positions_v")
def duplication_rate(p):
    return qc.duplication_rate(_umis(p))


@over("positions_v")
def reads_in_clusters(p):
    return qc.reads_in_clusters(clusters.build(p))


@over("positions_v")
def reads_assigned(p):
    return qc.assigned_reads(_labelled(p))


@over("positions_v")
def splitbam_stats(p):
    return qc.output_counts(_labelled(p))


@over("positions_v")
def cluster_statistics(p):
    return qc.library_statistics(clusters.build(p))


@over("positions_v")
def beads_per_barcode(p):
    return clusters.beads_per_barcode(clusters.build(p))


@over("positions_v")
def bead_matrix(p):
    return clusters.bead_matrix(clusters.build(p), [f"L{i}" for i in range(20)])


@over("log_v")
def consolidate_benchmarks(r):
    a = r.select((F.col("line_no") * 2).alias("s"), (F.col("line_no") + 1).alias("max_rss"))
    b = r.select((F.col("line_no") * 3).alias("s"), (F.col("line_no") % 7).alias("io_in"))
    return tables.consolidate([("A", "trim", a), ("A", "align", b), ("B", "trim", a)])


@over("positions_v")
def config_condition_diff(p):
    found = p.select(names.condition(F.col("tag3")).alias("cond"))
    wanted = p.select(F.explode(F.array(F.lit("CNTRL"), F.lit("TORIN"), F.lit("HEAT"))).alias("cond"))
    return qc.set_difference(found, wanted, "cond")


@over("reads_v")
def dedup_pairs(r):
    """Whole sequences, and copies of them under other numbers."""
    pairs = r.select("rec_no", F.col("seq").alias("seq1"), F.reverse("seq").alias("seq2"))
    copies = pairs.withColumn("n", F.explode(F.sequence(F.lit(1), (F.col("rec_no") % 3 + 1).cast("int")))).select((F.col("rec_no") + F.col("n") * 100000000).alias("rec_no"), "seq1", "seq2")
    return reads.dedup_pairs(pairs.unionByName(copies))


@over("positions_v")
def subsample_cumulative(p):
    return clusters.subsample_curves(p, 4).withColumn("n_chunk", F.col("n_chunk").cast("long"))


@query
def subsample_cached(spark, d):
    """The same curves from counts kept per chunk; the second update counts the new chunks only."""
    folder = store.scratch(spark)
    view(spark, d, "positions_v").select("barcode", "read_type", "chunk").write.partitionBy("chunk").parquet(f"{folder}/chunks")
    cache = chunks.CurveCache(spark, f"{folder}/cache")
    read = lambda s, path: s.read.parquet(path)
    for upto in (2, 4):
        cache.update({c: f"{folder}/chunks/chunk={c}" for c in range(upto)}, read)
    return cache.curves().withColumn("n_chunk", F.col("n_chunk").cast("long"))


@over("positions_v")
def merge_alignments(p):
    first, second = p.filter("chrom = '45S'"), p.filter("read_type = 'RPM' AND chrom <> '45S'")
    return reads.merge_alignments(first, second).groupBy("library", "chrom").agg(F.count("*").alias("n"))


# order, windows, samples


@over("positions_v")
def coord_sort(p):
    rows = reads.aligned(p).select("chrom", "start_pos", "end_pos", "ord1", "ord2")
    return reads.coordinate_sort(rows)


@query
def name_sort(spark, d):
    rows = reads.name_sort(_alignments(view(spark, d, "positions_v")), "qname")
    return rows.select("qname", F.col("flag").cast("long").alias("flag"))


@over("positions_v")
def sort_by_barcode(p):
    return reads.sort_by(p.select("barcode", "read_type", "chrom", "start_pos"), "barcode")


@over("positions_v")
def unique_positions(p):
    """Positions written once, whatever number of reads has them."""
    once = clusters.dedup_positions(p.unionByName(p))
    return once.groupBy("barcode").agg(F.count("*").alias("n"), F.min("feature").alias("feature"))


@over("reads_v")
def split_manifest(r):
    files = r.select(F.concat(F.lit("S"), F.col("chunk").cast("string")).alias("sample"), F.lit("R1").alias("read"), F.concat(F.lit("/d/"), F.lpad(F.col("rec_no").cast("string"), 9, "0")).alias("path"))
    return fastq.split_manifest(files, 4).select("sample", "path", F.col("chunk").cast("long").alias("chunk"))


@query
def assembly_registry(spark, d):
    """The chromosomes of all assemblies in order, with the RNA positions on each."""
    every = [genome.assembly(spark, name).select(F.lit(name).alias("assembly"), F.col("ord").cast("long").alias("ord"), "chrom", "size") for name in genome.SIZES]
    registry = tables.consolidate([("", "", e) for e in every]).drop("sample", "rule")
    on = view(spark, d, "positions_v").filter("read_type = 'RPM'").groupBy("chrom").agg(F.count("*").alias("n"))
    return registry.join(on, "chrom", "left").select("assembly", "ord", "chrom", "size", F.coalesce("n", F.lit(0)).alias("n"))


@over("positions_v")
def top_bead(p):
    return clusters.top_beads(clusters.build(p))


@over("positions_v")
def mixing_ratio(p):
    kept = qc.hash_sample(p.filter("read_type = 'RPM'"), ["barcode", "chrom", "start_pos", "ord1"], 0.3).unionByName(p.filter("read_type = 'BPM'"))
    return clusters.sizes(kept)


@over("reads_v")
def chunk_assign(r):
    return tables.assign_chunks(r.select("rec_no"), "rec_no", 8)


@over("log_v")
def error_blocks(r):
    return qc.error_blocks(r).withColumn("block", F.col("block").cast("long"))


@query
def error_blocks_stream(spark, d):
    """Three logs that arrive in three runs of a stream, which goes on from its checkpoint each time."""
    lines = view(spark, d, "log_v").select((F.col("line_no") % 3).alias("log_no"), "line_no", "line")
    ends = lines.groupBy("log_no").agg((F.max("line_no") + 1).alias("line_no")).withColumn("line", F.lit(None).cast("string"))
    folder = store.scratch(spark)
    cuts = [0, *lines.approxQuantile("line_no", [0.3, 0.7], 0.01), float(1 << 60)]
    for a, b in zip(cuts, cuts[1:]):
        lines.unionByName(ends).filter((F.col("line_no") >= a) & (F.col("line_no") < b)).write.mode("append").parquet(f"{folder}/in")
        arriving = spark.readStream.schema(lines.schema).parquet(f"{folder}/in")
        found = logs.error_blocks(arriving, "log_no")
        found.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{folder}/out")


# distributions


@over("positions_v")
def size_distribution(p):
    return qc.size_distribution(clusters.build(p))


@over("positions_v")
def max_rep_ecdf(p):
    return qc.ecdf(qc.max_representation(clusters.build(p)), "share").withColumnRenamed("share", "ecdf")


@over("positions_v")
def max_rep_counts(p):
    return qc.ecdf(qc.max_representation(clusters.build(p)), "top").withColumnRenamed("share", "ecdf")


@over("positions_v")
def max_rep_ecdf_all(p):
    return qc.ecdf(qc.max_representation(clusters.build(p), 1, True), "share").withColumnRenamed("share", "ecdf")


@over("positions_v")
def cluster_size_hist(p):
    return qc.cluster_size_histogram(clusters.build(p)).withColumn("at_least", F.col("at_least").cast("long"))


@query
def genome_bin(spark, d):
    p = view(spark, d, "positions_v").filter("read_type = 'RPM'").withColumn("start_pos", F.col("start_pos") * 30000)
    return genome.bin_index(p, genome.assembly(spark, "hg38"), 1000000).groupBy("bin").agg(F.count("*").alias("n"))


@query
def genome_bin_inverse(spark, d):
    bins = view(spark, d, "reads_v").select((F.col("rec_no") % 3000).alias("bin")).distinct()
    return genome.bin_position(bins, "hg38", 1000000)


@over("positions_v")
def bpm_rpm_ratio(p):
    return qc.type_ratio(clusters.build(p))
