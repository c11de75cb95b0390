"""Token counts from flat token files without an index, by a vectorised scan for the end-of-document id.

A flat file is nothing but ids, each document closed by the end-of-document id. Files are read in blocks of fixed
size. Per block the separators are found with numpy; a document that crosses blocks is stitched by a prefix scan:
the tokens it has left in earlier blocks are a running sum since the last block with a separator.

Defined cases: null and empty texts are documents of no tokens; texts of any length are counted whole, over as many
blocks as they fill; repeated rows give a row each, equal texts at places of their own; a null doc_id stays null; other
columns are ignored; an empty table gives an empty result. Tokens after a file's last separator are no document, and are
reported by `scan` as the tail of its last block. Files that no manifest row names (of tasks that were lost) are never
opened. A separator that the vocabulary uses, and ids too large for the type of the files, are errors.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bpe import encoder
from .common import materialise, open_store, shared_dir

#: Bytes of a block of the scan, and of a file after which the writer begins another.
BLOCK = 1 << 21
FILE = 1 << 26


def write_flat(docs: DataFrame, folder: str, ranks_path: str, pattern: str, separator: int, dtype: str = "<u2", file_bytes: int = FILE) -> DataFrame:
    """Write flat token files; returns the manifest doc_id, file, ordinal.

    A task writes files of names of its own, so a task run twice leaves files that no manifest row names. The
    manifest is written as a table, so that its rows and the files come from the same run of each task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(ranks_path, pattern)
        if separator in e.machine.bytes_of:
            raise ValueError(f"{separator} is a token's id, so it can't part documents")
        if max(separator, *e.machine.bytes_of) > np.iinfo(dtype).max:
            raise ValueError(f"ids don't fit {dtype}")
        end = np.array([separator], dtype).tobytes()
        fs, root = open_store(folder)
        out, name, size, ordinal = None, "", 0, 0
        try:
            for batch in batches:
                names, places = [], []
                for text in batch.column("text").to_pylist():
                    if out is None or size >= file_bytes:
                        if out is not None:
                            out.close()
                        name = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.tok"
                        out, size, ordinal = fs.open_output_stream(f"{root}/{name}"), 0, 0
                    ids = e.packed(text)
                    if np.dtype(dtype) != e.dtype:
                        ids = np.frombuffer(ids, e.dtype).astype(dtype).tobytes()
                    out.write(ids + end)
                    names.append(name)
                    places.append(ordinal)
                    size, ordinal = size + len(ids) + len(end), ordinal + 1
                yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id").cast(pa.int64()), "file": pa.array(names, pa.string()), "ordinal": pa.array(places, pa.int64())})
        finally:
            if out is not None:
                out.close()

    return materialise(docs.select("doc_id", "text").mapInArrow(run, "doc_id long, file string, ordinal long"))


def scan_block(ids: np.ndarray, separator: int) -> tuple[int, int, list[int]]:
    """(tokens before the first separator, tokens after the last, lengths between separators).

    Without a separator all tokens are in the second figure.
    """
    at = np.flatnonzero(ids == separator)
    if not len(at):
        return 0, len(ids), []
    return int(at[0]), int(len(ids) - at[-1] - 1), (np.diff(at) - 1).tolist()


def blocks(spark: SparkSession, folder: str, manifest: DataFrame, block: int = BLOCK) -> DataFrame:
    """file, path, block, start, length of each block of the flat files that a manifest names."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.tok").load(folder).select(F.element_at(F.split("path", "/"), -1).alias("file"), "path", "length")
    files = files.join(manifest.select("file").distinct(), "file", "left_semi")
    n = F.ceil(F.col("length") / F.lit(block)).cast("int")
    each = files.filter("length > 0").select("file", "path", "length", F.explode(F.sequence(F.lit(0), n - 1)).alias("block"))
    return each.select("file", "path", "block", (F.col("block").cast("long") * block).alias("start"), F.least(F.lit(block).cast("long"), F.col("length") - F.col("block").cast("long") * block).alias("length"))


def scan(spark: SparkSession, folder: str, manifest: DataFrame, separator: int, dtype: str = "<u2", block: int = BLOCK) -> DataFrame:
    """Per block: file, block, head, tail, n_seps, inner (lengths of documents wholly inside)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict = {}
        for batch in batches:
            rows = batch.to_pylist()
            found = []
            for r in rows:
                if r["path"] not in kept:
                    kept.clear()
                    fs, p = open_store(r["path"])
                    kept[r["path"]] = fs, p
                fs, p = kept[r["path"]]
                with fs.open_input_file(p) as f:
                    f.seek(r["start"])
                    data = f.read(r["length"])
                found.append(scan_block(np.frombuffer(data, dtype), separator))
            yield pa.RecordBatch.from_pydict(
                {
                    "file": pa.array([r["file"] for r in rows], pa.string()), "block": pa.array([r["block"] for r in rows], pa.int32()),
                    "head": pa.array([x[0] for x in found], pa.int64()), "tail": pa.array([x[1] for x in found], pa.int64()),
                    "has_sep": pa.array([bool(x[2]) or x[0] + x[1] + 1 == r["length"] // np.dtype(dtype).itemsize for x, r in zip(found, rows)], pa.bool_()),
                    "inner": pa.array([x[2] for x in found], pa.list_(pa.int64())),
                }
            )

    parts = max(8, spark.sparkContext.defaultParallelism * 2)
    rows = blocks(spark, folder, manifest, block).repartition(parts, "file", "block")
    return rows.mapInArrow(run, "file string, block int, head long, tail long, has_sep boolean, inner array<long>")


def stitch(scanned: DataFrame) -> DataFrame:
    """Block figures -> file, ordinal, n_tokens of every document, by prefix scans over each file's blocks."""
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    n_seps = F.when(F.col("has_sep"), F.size("inner") + 1).otherwise(0)
    rows = scanned.withColumn("ordinal0", F.coalesce(F.sum(n_seps).over(before), F.lit(0)))
    rows = rows.withColumn("run", F.coalesce(F.sum(F.col("has_sep").cast("int")).over(before), F.lit(0)))
    # tokens left open since the last block with a separator
    open_since = Window.partitionBy("file", "run").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    last = Window.partitionBy("file").orderBy("block")
    carried = F.coalesce(F.sum(F.when(~F.col("has_sep"), F.col("tail"))).over(open_since), F.lit(0))
    left = F.coalesce(F.max(F.when(F.col("has_sep"), F.struct("block", "tail"))).over(last.rowsBetween(Window.unboundedPreceding, -1)).getField("tail"), F.lit(0))
    rows = rows.filter("has_sep OR tail > 0").withColumn("carry", carried + left).filter("has_sep")
    lengths = F.concat(F.array(F.col("head") + F.col("carry")), F.col("inner"))
    return rows.select("file", "ordinal0", F.posexplode(lengths).alias("i", "n_tokens")).select("file", (F.col("ordinal0") + F.col("i")).cast("long").alias("ordinal"), "n_tokens")


def count_tokens(docs: DataFrame, ranks_path: str, pattern: str, separator: int, block: int = BLOCK) -> DataFrame:
    """documents -> doc_id, n_tokens, file, ordinal: writes flat files, then counts by scanning them."""
    spark = docs.sparkSession
    folder = shared_dir(spark)
    manifest = write_flat(docs, folder, ranks_path, pattern, separator)
    counts = stitch(scan(spark, folder, manifest, separator, block=block))
    # both sides have a row per document; their repeated names compress so well that a broadcast would look cheap
    return manifest.join(counts.hint("merge"), ["file", "ordinal"], "left").select("doc_id", "n_tokens", "file", "ordinal")
