"""Files of any store that pyarrow knows, by the paths that Spark uses."""

from __future__ import annotations

import gzip
import io
import os
import tempfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow.fs as pafs
from pyspark.sql import SparkSession


def locate(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" not in path:
        scheme, sep, rest = path.partition(":/")
        path = f"{scheme}:///{rest.lstrip('/')}" if sep else f"file://{os.path.abspath(path)}"
    return pafs.FileSystem.from_uri(path)


def scratch(spark: SparkSession) -> str:
    """A new folder below the session's spark.checkpoint.dir, which driver and executors share; it goes with the application.

    Only a session on one machine gets a folder of its own where that is unset.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="beadloom-")
    path = f"{base.rstrip('/')}/beadloom-files-{uuid.uuid4().hex}"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)  # lives as long as the application
    return path


@dataclass
class Written:
    """A file that a task wrote under a hidden name."""

    folder: str
    name: str
    records: int


def show(path: str, files: list[Written]) -> None:
    """Give files of tasks that counted their names; called once, by the driver, so a task that ran twice leaves nothing."""
    fs, root = locate(path)
    for f in files:
        folder = f"{root}/{f.folder}" if f.folder else root
        fs.move(f"{folder}/.{f.name}", f"{folder}/{f.name}")


def list_files(path: str) -> list[str]:
    """The file itself, or the files below a folder, in order; hidden ones left out."""
    fs, p = locate(path)
    info = fs.get_file_info(p)
    if info.type == pafs.FileType.File:
        return [path]
    prefix = path.rstrip("/")
    found = [x.path for x in fs.get_file_info(pafs.FileSelector(p, recursive=True)) if x.type == pafs.FileType.File and not os.path.basename(x.path).startswith(("_", "."))]
    return sorted(prefix + f[len(p.rstrip("/")) :] for f in found)


def open_maybe_gzip(path: str) -> io.BufferedReader:
    """A byte stream, unpacked if its first bytes are gzip's, whatever the name says."""
    fs, p = locate(path)
    with fs.open_input_file(p) as f:
        packed = f.read(2) == b"\x1f\x8b"
    raw = fs.open_input_stream(p, compression=None)
    return io.BufferedReader(gzip.GzipFile(fileobj=raw) if packed else raw, 1 << 20)


def lines(path: str) -> Iterator[bytes]:
    with open_maybe_gzip(path) as f:
        for line in f:
            yield line.rstrip(b"\r\n")
