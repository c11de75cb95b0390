"""Quality-control tables: counts, rates, distributions, logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import names
from . import clusters, order


def ligation_by_count(reads: DataFrame) -> DataFrame:
    """Reads per number of tags found, with the share in percent."""
    found = F.size(F.filter(names.tags(F.col("name")), lambda t: t != names.MISSING))
    rows = reads.select(found.alias("n_found")).groupBy("n_found").agg(F.count("*").alias("reads"))
    return rows.withColumn("percent", F.round(100 * F.col("reads") / F.sum("reads").over(Window.partitionBy(F.lit(0))), 1))  # a row per count


def ligation_by_position(reads: DataFrame) -> DataFrame:
    """Per place in the barcode: reads with a tag there, and the share of all."""
    rows = reads.select(F.posexplode(names.tags(F.col("name"))).alias("pos", "tag")).groupBy("pos").agg(F.count_if(F.col("tag") != names.MISSING).alias("found"), F.count("*").alias("total"))
    return rows.select("pos", "found", F.round(100 * F.col("found") / F.col("total"), 1).alias("percent"))


def completeness(reads: DataFrame) -> DataFrame:
    """Reads whose barcode but the bead is full, and those that lack a tag."""
    lacks = F.array_contains(names.rest(names.tags(F.col("name"))), names.MISSING)
    return reads.agg(F.count_if(~lacks).alias("full"), F.count_if(lacks).alias("incomplete"))


def chunk_counts(reads: DataFrame) -> DataFrame:
    """Reads per class and chunk and, with a null chunk, per class."""
    return reads.select(names.read_class(F.col("name")).alias("read_class"), "chunk").rollup("read_class", "chunk").agg(F.count("*").alias("reads"), F.grouping("read_class").alias("g")).filter("g = 0").drop("g")


def umi_counts(umis: DataFrame) -> DataFrame:
    """barcode, umi, n: reads of each molecule."""
    return umis.groupBy("barcode", "umi").agg(F.count("*").alias("n"))


def umi_totals(umis: DataFrame) -> DataFrame:
    """Per barcode: distinct molecules, reads, duplicates."""
    rows = umi_counts(umis).groupBy("barcode").agg(F.count("*").alias("unique_umis"), F.sum("n").alias("total"))
    return rows.withColumn("duplicates", F.col("total") - F.col("unique_umis"))


def umi_duplication(umis: DataFrame) -> DataFrame:
    """`umi_totals` with a barcode's `umi_counts` as one text, umi_n in order; for barcodes whose molecules fit in a value."""
    rows = umi_counts(umis).groupBy("barcode").agg(F.count("*").alias("unique_umis"), F.sum("n").alias("total"), F.array_sort(F.collect_list(F.struct("umi", "n"))).alias("l"))
    return rows.select("barcode", "unique_umis", "total", (F.col("total") - F.col("unique_umis")).alias("duplicates"), F.array_join(F.transform("l", lambda r: F.concat_ws("_", r["umi"], r["n"].cast("string"))), ",").alias("umi_counts"))


def duplication_rate(umis: DataFrame) -> DataFrame:
    """Duplicates over reads, of all barcodes; null without reads."""
    per = umis.groupBy("barcode", "umi").agg(F.count("*").alias("n"))
    return per.agg(F.round(F.try_divide(F.sum(F.col("n") - 1).cast("double"), F.sum("n")), 6).alias("rate"))


def library_statistics(positions: DataFrame) -> DataFrame:
    """Per library: clusters and positions by type."""
    counts = [F.count_if(F.col("read_type") == t).alias(f"n_{t.lower()}") for t in ("BPM", "RPM", "DPM")]
    return positions.groupBy("library", "barcode").agg(*counts).groupBy("library").agg(F.count("*").alias("clusters"), *[F.sum(f"n_{t}").alias(f"n_{t}") for t in ("bpm", "rpm", "dpm")])


# Edges of the size tables.
SIZE_EDGES = [0, 1, 5, 10, 20, 50, 100, 200]
SIZE_LABELS = ["0", "1", "2-5", "6-10", "11-20", "21-50", "51-100", "101-200", "201+"]
LEFT_EDGES = [0, 1, 2, 5, 10, 20, 50, 100, 1000, 100000]


def size_distribution(positions: DataFrame, read_type: str = "BPM") -> DataFrame:
    """Clusters and reads per size bin of one type, by library, with shares of the library."""
    per = positions.groupBy("library", "barcode").agg(F.count_if(F.col("read_type") == read_type).alias("n")).filter("n > 0")
    rows = per.groupBy("library", names.right_bin(F.col("n"), SIZE_EDGES).alias("bin")).agg(F.count("*").alias("clusters"), F.sum("n").alias("reads"))
    w = Window.partitionBy("library")  # a row per bin
    label = F.element_at(F.array(*[F.lit(x) for x in SIZE_LABELS]), F.col("bin") + 1)
    share = lambda c: F.round(F.col(c) / F.sum(c).over(w), 6)
    return rows.select("library", label.alias("size_bin"), "clusters", "reads", share("clusters").alias("cluster_share"), share("reads").alias("read_share"))


def cluster_size_histogram(positions: DataFrame) -> DataFrame:
    """Clusters and positions per left-closed size bin."""
    per = clusters.sizes(positions)
    edges = F.array(*[F.lit(e) for e in LEFT_EDGES])
    at = F.least(names.left_bin(F.col("size"), LEFT_EDGES), F.lit(len(LEFT_EDGES) - 1))
    return per.groupBy(F.element_at(edges, at).alias("at_least")).agg(F.count("*").alias("clusters"), F.sum("size").alias("positions"))


def max_representation(positions: DataFrame, min_bpm: int = 2, include_none: bool = False) -> DataFrame:
    """Per cluster of at least min_bpm bead positions: the top bead's count and share; without beads 0, if asked for."""
    top = clusters.top_beads(positions).filter(F.col("total") >= min_bpm).select("barcode", F.col("n").alias("top"), F.round(F.col("n") / F.col("total"), 6).alias("share"))
    if include_none:
        bare = positions.groupBy("barcode").agg(F.count_if(F.expr("read_type = 'BPM'")).alias("b")).filter("b = 0").select("barcode", F.lit(0).cast("long").alias("top"), F.lit(0.0).alias("share"))
        top = top.unionByName(bare)
    return top


def ecdf(rows: DataFrame, value: str) -> DataFrame:
    """Value and share of rows at or below it, per distinct value; rows are counted per value before the running sum, which is
    over ranges of values."""
    per = rows.groupBy(F.col(value).alias("value")).agg(F.count("*").alias("n"))
    upto = order.running_sums(per, "value", {"__upto": "n"})
    return upto.select("value", "n", F.round(F.col("__upto") / F.lit(rows.count()), 6).alias("share"))


def equal_width_histogram(rows: DataFrame, value: str, by: list[str], bins: int = 50) -> DataFrame:
    """Equal-width bins between the least and greatest value per group, the last one closed."""
    edges = rows.groupBy(*by).agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    joined = rows.join(edges, by)
    width = (F.col("hi") - F.col("lo")) / F.lit(bins)
    at = F.when(F.col("hi") == F.col("lo"), 0).otherwise(F.least(F.floor((F.col(value) - F.col("lo")) / width), F.lit(bins - 1)))
    return joined.withColumn("bin", at.cast("int")).groupBy(*by, "bin").agg(F.count("*").alias("n"))


# What a run log's lines look like.
RULE, JOBID, LOG, FINISHED = r"Error in rule\s+(\w+):", r"jobid:\s*(\d+)", r"log:\s*([^\s()]+)", "Finished job"


def error_blocks(lines: DataFrame, by: list[str] = []) -> DataFrame:  # noqa: B006
    """Blocks of a run log: a start line, then the last jobid and log before a blank line, a finished job or the next start.

    `by` names the columns that tell files apart. Blocks and their ends are running counts over ranges of lines, so a file
    of any length spreads over tasks; lines behind a block's end differ from it in the count of ends.
    """
    start = F.col("line").rlike(RULE)
    fields = F.col("line").rlike(JOBID) | F.col("line").rlike(LOG)
    stop = ~start & ~fields & ((F.trim("line") == "") | F.contains("line", F.lit(FINISHED)))
    rows = order.running_sums(lines.withColumns({"__start": start.cast("long"), "__stop": stop.cast("long")}), "line_no", {"block": "__start", "__ends": "__stop"}, by)
    jobid, log = F.regexp_extract("line", JOBID, 1), F.regexp_extract("line", LOG, 1)
    each = rows.filter("block > 0").groupBy(*by, "block", "__ends").agg(
        F.min("line_no").alias("line_no"),
        F.max(F.regexp_extract("line", RULE, 1)).alias("rule"),
        F.max_by(F.when(jobid != "", jobid), F.when(jobid != "", F.col("line_no"))).alias("jobid"),
        F.max_by(F.when((jobid == "") & (log != ""), log), F.when((jobid == "") & (log != ""), F.col("line_no"))).alias("log"),
    )
    first = each.groupBy(*by, "block").agg(F.min(F.struct("__ends", "line_no", "rule", "jobid", "log")).alias("first"))
    return first.select(*by, "block", "first.line_no", "first.rule", "first.jobid", "first.log")


def sequence_lengths(reads: DataFrame, *carry: Column) -> DataFrame:
    """Lengths of the sequences, with what is carried."""
    return reads.select(*carry, F.length("seq").cast("long").alias("len"))


def read_totals(reads: DataFrame) -> DataFrame:
    """Reads and bases."""
    return reads.agg(F.count("*").alias("reads"), F.sum(F.length("seq")).alias("bases"))


def name_totals(alignments: DataFrame, name: str) -> DataFrame:
    """Distinct read names, and alignments."""
    return alignments.agg(F.countDistinct(name).alias("names"), F.count("*").alias("alignments"))


def reads_in_clusters(positions: DataFrame) -> DataFrame:
    """RNA positions of all clusters."""
    return clusters.sizes(positions).agg(F.sum("n_rpm").alias("reads"))


# Labels of clusters without a bead of their own, as counts of assigned reads leave them out.
UNASSIGNED = ("ambiguous", "none", "uncertain")


def assigned_reads(labelled: DataFrame) -> DataFrame:
    """Written reads with a label that counts as assigned ("filtered" does)."""
    return labelled.filter((F.col("fate") == "written") & ~F.col("label").isin(*UNASSIGNED)).agg(F.count("*").alias("reads"))


def output_counts(labelled: DataFrame) -> DataFrame:
    """Written reads per output, label_library."""
    return labelled.filter("fate = 'written'").groupBy(F.concat_ws("_", "label", "library").alias("output")).agg(F.count("*").alias("reads"))


def type_ratio(positions: DataFrame) -> DataFrame:
    """Bead and RNA positions of all clusters, and their ratio."""
    s = clusters.sizes(positions).agg(F.sum("n_bpm").alias("bpm"), F.sum("n_rpm").alias("rpm"))
    return s.withColumn("ratio", F.round(F.try_divide(F.col("bpm").cast("double"), F.col("rpm")), 6))


def hash_sample(rows: DataFrame, key: list[str], fraction: float) -> DataFrame:
    """About that share of the rows, by a digest of their key: the same rows on every run and engine."""
    point = F.conv(F.substring(F.md5(F.concat_ws("|", *key)), 1, 8), 16, 10).cast("long")
    return rows.filter(point < F.lit(int(fraction * (1 << 32))))


def set_difference(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    """Values on one side only."""
    a, b = left.select(column).distinct(), right.select(column).distinct()
    return a.exceptAll(b).withColumn("side", F.lit("left")).unionByName(b.exceptAll(a).withColumn("side", F.lit("right")))


def leave_one_out(groups: DataFrame, key: str) -> DataFrame:
    """Each of a few names with all the others, joined by commas."""
    whole = groups.agg(F.array_sort(F.collect_set(key)).alias("names"))  # names of files, a handful
    return whole.select(F.explode("names").alias(key), "names").select(key, F.array_join(F.filter("names", lambda x: x != F.col(key)), ",").alias("others"))
