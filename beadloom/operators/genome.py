"""Assemblies and genome bins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Chromosome lengths of four public assemblies, chr1 onwards, then X, Y and M.
SIZES = {
    "mm9": [197195432, 181748087, 159599783, 155630120, 152537259, 149517037, 152524553, 131738871, 124076172, 129993255, 121843856, 121257530, 120284312, 125194864, 103494974, 98319150, 95272651, 90772031, 61342430, 166650296, 15902555, 16299],
    "mm10": [195471971, 182113224, 160039680, 156508116, 151834684, 149736546, 145441459, 129401213, 124595110, 130694993, 122082543, 120129022, 120421639, 124902244, 104043685, 98207768, 94987271, 90702639, 61431566, 171031299, 91744698, 16299],
    "hg19": [249250621, 243199373, 198022430, 191154276, 180915260, 171115067, 159138663, 146364022, 141213431, 135534747, 135006516, 133851895, 115169878, 107349540, 102531392, 90354753, 81195210, 78077248, 59128983, 63025520, 48129895, 51304566, 155270560, 59373566, 16571],
    "hg38": [248956422, 242193529, 198295559, 190214555, 181538259, 170805979, 159345973, 145138636, 138394717, 133797422, 135086622, 133275309, 114364328, 107043718, 101991189, 90338345, 83257441, 80373285, 58617616, 64444167, 46709983, 50818468, 156040895, 57227415, 16569],
}


def chromosomes(name: str) -> list[tuple[int, str, int]]:
    """(order, chromosome, length) of an assembly; ValueError for others."""
    if name not in SIZES:
        raise ValueError(f"unknown assembly {name}")
    sizes = SIZES[name]
    labels = [f"chr{i + 1}" for i in range(len(sizes) - 3)] + ["chrX", "chrY", "chrM"]
    return [(i, c, n) for i, (c, n) in enumerate(zip(labels, sizes))]


def assembly(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame(chromosomes(name), "ord int, chrom string, size long")


def offsets(table: DataFrame, resolution: int) -> DataFrame:
    """The assembly with each chromosome's first bin and number of bins. The window is over one assembly's few rows."""
    bins = F.ceil(F.col("size") / F.lit(resolution)).cast("long")
    before = Window.partitionBy(F.lit(0)).orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)
    return table.withColumn("bins", bins).withColumn("offset", F.coalesce(F.sum("bins").over(before), F.lit(0)))


def bin_index(rows: DataFrame, table: DataFrame, resolution: int) -> DataFrame:
    """Rows with the genome bin of (chrom, start_pos); null on chromosomes that the assembly lacks."""
    at = F.broadcast(offsets(table, resolution).select("chrom", "offset"))  # some twenty rows
    return rows.join(at, "chrom", "left").withColumn("bin", (F.floor(F.col("start_pos") / resolution) + F.col("offset")).cast("long")).drop("offset")


def bin_position(bins: DataFrame, name: str, resolution: int) -> DataFrame:
    """Bin -> chromosome and position: the last offset that isn't above it. The assembly's rows go as one small literal."""
    at, entries = 0, []
    for _, chrom, size in chromosomes(name):
        entries.append(F.struct(F.lit(at).cast("long").alias("offset"), F.lit(chrom).alias("chrom")))
        at += -(-size // resolution)
    hit = F.element_at(F.filter(F.array(*entries), lambda x: x["offset"] <= F.col("bin")), -1)
    return bins.withColumn("__hit", hit).select(*bins.columns, F.col("__hit.chrom").alias("chrom"), ((F.col("bin") - F.col("__hit.offset")) * resolution).alias("pos"))
