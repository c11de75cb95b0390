"""Clusters: rows of positions under a barcode. Nothing here collects a cluster; all is aggregation and windows by barcode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import names

POSITION = ["barcode", "read_type", "chrom", "start_pos", "end_pos"]
#: What orders the rows of one position; the first stays.
ORDER = ["ord1", "ord2", "ord3", "ord4", "feature"]
TAG_COLUMNS = ["tag0", "tag1", "tag2", "tag3"]


def dedup_positions(positions: DataFrame, order: list[str] = ORDER) -> DataFrame:
    """The first row of each position; strand is no part of the key. A minimum combines before the shuffle."""
    others = [c for c in positions.columns if c not in POSITION]
    first = F.min(F.struct(*order, *[c for c in others if c not in order])).alias("first")
    return positions.groupBy(*POSITION).agg(first).select(*POSITION, *[F.col(f"first.{c}").alias(c) for c in others])


def build(reads: DataFrame, order: list[str] = ORDER) -> DataFrame:
    """Typed reads -> distinct positions of clusters. Rows without an end or of unknown type are no positions."""
    known = reads.filter(F.col("end_pos").isNotNull() & F.col("read_type").isin("BPM", "RPM", "DPM"))
    return dedup_positions(known, order)


def build_chunks(reads: DataFrame, chunk: str, order: list[str] = ORDER) -> DataFrame:
    """Clusters built within each chunk, as separate jobs would: a position may come once per chunk. One pass."""
    known = reads.filter(F.col("end_pos").isNotNull() & F.col("read_type").isin("BPM", "RPM", "DPM"))
    others = [c for c in known.columns if c not in POSITION and c != chunk]
    first = F.min(F.struct(*order, *[c for c in others if c not in order])).alias("first")
    return known.groupBy(*POSITION, chunk).agg(first).select(*POSITION, chunk, *[F.col(f"first.{c}").alias(c) for c in others])


def merge(*parts: DataFrame) -> DataFrame:
    """The union of clusters built from chunks: same barcode, set union of positions."""
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    return dedup_positions(whole)


def sizes(positions: DataFrame, by: list[str] = ["barcode"]) -> DataFrame:  # noqa: B006
    """Per cluster: size, and BPM, RPM and DPM counts."""
    counts = [F.count_if(F.col("read_type") == t).alias(f"n_{t.lower()}") for t in ("BPM", "RPM", "DPM")]
    return positions.groupBy(*by).agg(F.count("*").alias("size"), *counts)


def coverage(positions: DataFrame, read_type: str | None = None) -> DataFrame:
    """Positions per cluster and chromosome."""
    rows = positions if read_type is None else positions.filter(F.col("read_type") == read_type)
    return rows.groupBy("barcode", "chrom").agg(F.count("*").alias("n"))


def contains_bead(positions: DataFrame, bead: str) -> DataFrame:
    """Clusters with a bead position of that name."""
    return positions.groupBy("barcode").agg(F.coalesce(F.bool_or((F.col("read_type") == "BPM") & (F.col("chrom") == bead)), F.lit(False)).alias("has_bead"))


def bead_counts(positions: DataFrame, extra: list[Column] = []) -> DataFrame:  # noqa: B006
    """barcode, bead, n over bead positions."""
    return positions.filter("read_type = 'BPM'").groupBy("barcode", F.col("chrom").alias("bead")).agg(F.count("*").alias("n"), *extra)


def top_beads(positions: DataFrame) -> DataFrame:
    """Per barcode: the bead with most positions (ties: the least name), its count and the count of all; two aggregations."""
    by_bead = bead_counts(positions)
    return by_bead.groupBy("barcode").agg(F.min(F.struct((-F.col("n")).alias("minus"), "bead")).alias("t"), F.sum("n").alias("total")).select("barcode", F.col("t.bead").alias("bead"), (-F.col("t.minus")).alias("n"), "total")


def label(positions: DataFrame, min_oligos: int = 2, proportion: float = 0.6, max_size: int = 13) -> DataFrame:
    """Per barcode its label: none without beads; filtered if more than max_size other positions; uncertain if the top
    bead has fewer than min_oligos; ambiguous if its share is below proportion; else the top bead.

    All in aggregations by barcode: positions are first counted per (barcode, bead), so a giant cluster is a few rows.
    """
    per_bead = positions.groupBy("barcode", F.when(F.col("read_type") == "BPM", F.col("chrom")).alias("bead"), (F.col("read_type") == "BPM").alias("is_bead")).agg(F.count("*").alias("n"))
    top = F.min(F.when(F.col("is_bead"), F.struct((-F.col("n")).alias("minus"), "bead"))).alias("top")
    rows = per_bead.groupBy("barcode").agg(F.sum("n").alias("size"), F.coalesce(F.sum(F.when(F.col("is_bead"), F.col("n"))), F.lit(0)).alias("n_bpm"), top)
    best = -F.col("top.minus")
    named = (
        F.when(F.col("n_bpm") == 0, "none")
        .when(F.col("size") - F.col("n_bpm") > max_size, "filtered")
        .when(best < min_oligos, "uncertain")
        .when(best / F.col("n_bpm") < proportion, "ambiguous")
        .otherwise(F.col("top.bead"))
    )
    return rows.select("barcode", "size", "n_bpm", named.alias("label"))


def assignment(labels: DataFrame) -> DataFrame:
    """Per label: clusters, reads other than beads, reads per cluster."""
    rows = labels.groupBy("label").agg(F.count("*").alias("clusters"), F.sum(F.col("size") - F.col("n_bpm")).alias("reads"))
    return rows.withColumn("reads_per_cluster", F.round(F.col("reads") / F.col("clusters"), 6))


def split_complete(positions: DataFrame, allowed: DataFrame, columns: list[str] = TAG_COLUMNS) -> DataFrame:
    """Per barcode: how many tags stand where the rounds don't allow them, and whether none does (base-0 positions)."""
    barcodes = positions.select("barcode", *columns).distinct()
    tags_ = barcodes.select("barcode", F.posexplode(F.array(*columns)).alias("pos", "name"))
    bad = tags_.join(allowed, ["pos", "name"], "left_anti").groupBy("barcode").agg(F.count("*").alias("n_bad"))
    rows = barcodes.select("barcode").distinct().join(bad, "barcode", "left").withColumn("n_bad", F.coalesce("n_bad", F.lit(0)))
    return rows.select("barcode", "n_bad", (F.col("n_bad") == 0).alias("complete"))


def rendered(positions: DataFrame) -> DataFrame:
    """barcode, score, text of each position: a cluster line in long form, for clusters of any size."""
    text = names.position_text(F.col("read_type"), F.col("feature"), F.col("chrom"), F.col("start_pos"), F.col("end_pos"))
    return positions.select("barcode", names.position_score(F.col("read_type"), F.col("chrom")).alias("score"), text.alias("text"))


def render(positions: DataFrame) -> DataFrame:
    """Cluster lines: barcode, then its positions by score and text, joined by tabs. A line is a value, so a cluster has to
    fit in one; `sources.tables.write_clusters` writes lines of any length from `rendered`."""
    rows = rendered(positions).groupBy("barcode").agg(F.array_sort(F.collect_list(F.struct("score", "text"))).alias("rows"))
    return rows.select(F.concat_ws("\t", "barcode", F.array_join(F.transform("rows", lambda r: r["text"]), "\t")).alias("line"))


def parse(lines: DataFrame) -> DataFrame:
    """Cluster lines -> barcode, read_type, feature, chrom, start_pos, end_pos; an error for a malformed position."""
    parts = lines.select(F.split("line", "\t").alias("p"))
    rows = parts.select(F.element_at("p", 1).alias("barcode"), F.explode(F.slice("p", 2, F.greatest(F.size("p") - 1, F.lit(0)))).alias("text"))
    shape = r"^([a-zA-Z0-9]+)\[(.*)\]_(.+):([0-9]+)\-([0-9]+)$"
    get = [F.regexp_extract("text", shape, i) for i in range(1, 6)]
    ok = F.when(F.col("text").rlike(shape), get[0]).otherwise(F.raise_error(F.concat(F.lit("malformed position "), F.col("text"))).cast("string"))
    return rows.select("barcode", ok.alias("read_type"), get[1].alias("feature"), get[2].alias("chrom"), get[3].cast("long").alias("start_pos"), get[4].cast("long").alias("end_pos"))


def stripped_lookup(positions: DataFrame) -> DataFrame:
    """Barcode without library -> number of its distinct positions, the first and the last of them; `lookup` has all."""
    return lookup(positions).groupBy("barcode").agg(F.count("*").alias("n_positions"), F.min("position").alias("first_position"), F.max("position").alias("last_position"))


def lookup(positions: DataFrame, stripped: bool = True) -> DataFrame:
    """barcode (without library), position: the set of rendered positions of each barcode, a row per member, so of any size."""
    text = names.position_text(F.col("read_type"), F.col("feature"), F.col("chrom"), F.col("start_pos"), F.col("end_pos"))
    key = names.strip_library(F.col("barcode")) if stripped else F.col("barcode")
    return positions.select(key.alias("barcode"), text.alias("position")).distinct()


def conditions(positions: DataFrame, round_tag: str = "ROUND1_") -> DataFrame:
    """The distinct conditions that barcodes name in the tags of a round."""
    t = positions.select(F.explode(F.filter(F.split("barcode", r"\."), lambda x: F.startswith(x, F.lit(round_tag)))).alias("tag")).distinct()
    return t.select(F.element_at(F.split("tag", "_"), 2).alias("cond")).distinct()


def category(n_bpm: Column, n_rpm: Column) -> Column:
    return F.when((n_bpm > 0) & (n_rpm > 0), "BPM_and_RPM").when(n_bpm > 0, "BPM_ONLY").when(n_rpm > 0, "RPM_ONLY")


def beads_per_barcode(positions: DataFrame) -> DataFrame:
    """Per barcode its beads in order and their counts, as lists joined by commas."""
    rows = bead_counts(positions).groupBy("barcode").agg(F.array_sort(F.collect_list(F.struct("bead", "n"))).alias("l"))  # a row per distinct bead
    return rows.select("barcode", F.array_join(F.transform("l", lambda r: r["bead"]), ",").alias("beads"), F.array_join(F.transform("l", lambda r: r["n"].cast("string")), ",").alias("counts"))


def bead_matrix(positions: DataFrame, beads: list[str]) -> DataFrame:
    """A column of counts per bead of a given panel; none is 0."""
    return positions.filter("read_type = 'BPM'").groupBy("barcode").agg(*[F.count_if(F.col("chrom") == b).alias(b) for b in beads])


def chunk_counts(positions: DataFrame, *chunk: str) -> DataFrame:
    """Per barcode without library (and chunk): bead, RNA and all positions."""
    counts = [F.count_if(F.expr("read_type = 'BPM'")).alias("bpm"), F.count_if(F.expr("read_type = 'RPM'")).alias("rpm"), F.count("*").alias("n")]
    return positions.select(names.strip_library(F.col("barcode")).alias("b"), "read_type", *chunk).groupBy("b", *chunk).agg(*counts)


def curves(per: DataFrame, chunks: int) -> DataFrame:
    """`subsample_curves` from counts per (barcode, chunk)."""
    one = per.groupBy("b").agg(*[F.coalesce(F.sum(F.when(F.col("chunk") == c, F.col(k))), F.lit(0)).alias(f"{k}{c}") for c in range(chunks) for k in ("bpm", "rpm", "n")])
    upto = lambda k, c: sum((F.col(f"{k}{i}") for i in range(c + 1)), F.lit(0))
    steps = F.array(*[F.struct(F.lit(c).alias("n_chunk"), category(upto("bpm", c), upto("rpm", c)).alias("category"), upto("n", c).alias("reads")) for c in range(chunks)])
    rows = one.select(F.inline(steps)).filter("category IS NOT NULL").groupBy("n_chunk", "category").agg(F.count("*").alias("clusters"), F.sum("reads").alias("reads"))
    w = Window.partitionBy("n_chunk")  # three rows each
    share = lambda c: F.round(F.try_divide(F.col(c).cast("double"), F.sum(c).over(w)), 6)
    return rows.withColumns({"cluster_share": share("clusters"), "read_share": share("reads")})


def subsample_curves(positions: DataFrame, chunks: int) -> DataFrame:
    """For n = 0 .. chunks-1: categories of clusters seen in chunks 0..n, by cluster and by read.

    A cluster's counts per chunk are running sums over at most `chunks` rows, so no chunk is joined with its predecessors.
    """
    return curves(chunk_counts(positions, "chunk"), chunks)
