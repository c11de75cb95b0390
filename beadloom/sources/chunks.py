"""What is kept per chunk of an experiment, so that a new chunk is added to it and old ones aren't done again.

Clusters are kept in a table in buckets of barcodes: each chunk's are built and sorted once, and merging them needs no
shuffle, as all chunks' positions of a barcode are in buckets of the same number. Counts for the subsampling curves are
kept per chunk, with a manifest of the files that they cover.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession

from ..operators import clusters
from .store import list_files, locate


def write_clusters(reads: DataFrame, table: str, path: str, buckets: int, chunk: str = "chunk") -> None:
    """Clusters of each chunk of typed reads, added to a table at `path` that is in `buckets` of barcodes, sorted in them.

    Reads are dealt by barcode once, which serves the build and the buckets. A chunk that is there already would be there twice:
    chunks are added once.
    """
    built = clusters.build_chunks(reads.repartition(buckets, "barcode"), chunk)
    built.write.format("parquet").partitionBy(chunk).bucketBy(buckets, "barcode").sortBy("barcode").option("path", path).mode("append").saveAsTable(table)


def merge_clusters(spark: SparkSession, table: str, chunk: str = "chunk") -> DataFrame:
    """The union of the clusters of all chunks: a scan by bucket and an aggregation within it."""
    return clusters.merge(spark.table(table).drop(chunk))


@dataclass
class CurveCache:
    """Counts per (barcode, chunk) below a folder: a subfolder of counts and an entry of the manifest per chunk.

    An entry is written behind its counts and names both them and the files that they cover, with their sizes; so counts of a run
    that failed are never read, and a chunk whose files have changed is counted anew.
    """

    spark: SparkSession
    folder: str

    def _entries(self) -> dict[int, dict]:
        fs, p = locate(f"{self.folder}/manifest")
        if fs.get_file_info(p).type != pafs.FileType.Directory:
            return {}
        out = {}
        for f in list_files(f"{self.folder}/manifest"):
            fs, p = locate(f)
            with fs.open_input_stream(p) as s:
                entry = json.loads(s.read())
            out[entry["chunk"]] = entry
        return out

    @staticmethod
    def _print(path: str) -> str:
        """A text that changes with the names and sizes of a chunk's files, or when they are written anew."""
        found = []
        for f in list_files(path):
            fs, p = locate(f)
            info = fs.get_file_info(p)
            found.append(f"{f}:{info.size}:{info.mtime_ns}")
        return hashlib.sha256("\n".join(found).encode()).hexdigest()

    def update(self, chunks: dict[int, str], read: Callable[[SparkSession, str], DataFrame]) -> list[int]:
        """Count the chunks (number -> path) that the manifest lacks or that have changed; returns their numbers."""
        known, added = self._entries(), []
        for chunk, path in sorted(chunks.items()):
            mark = self._print(path)
            if known.get(chunk, {}).get("files") == mark:
                continue
            counts = f"{self.folder}/counts/{chunk}-{uuid.uuid4().hex}"
            clusters.chunk_counts(read(self.spark, path)).write.parquet(counts)
            fs, root = locate(f"{self.folder}/manifest")
            fs.create_dir(root, recursive=True)
            with fs.open_output_stream(f"{root}/.{chunk}", compression=None) as s:
                s.write(json.dumps({"chunk": chunk, "files": mark, "counts": counts}).encode())
            fs.move(f"{root}/.{chunk}", f"{root}/{chunk}")
            added.append(chunk)
        return added

    def curves(self) -> DataFrame:
        """Curves over all chunks of the manifest, which must be numbered from 0 without a gap."""
        entries = self._entries()
        if not entries or sorted(entries) != list(range(len(entries))):
            raise ValueError(f"chunks are {sorted(entries)}")
        from pyspark.sql import functions as F

        whole = None
        for chunk, e in sorted(entries.items()):
            part = self.spark.read.parquet(e["counts"]).withColumn("chunk", F.lit(chunk))
            whole = part if whole is None else whole.unionByName(part)
        return clusters.curves(whole, len(entries))
