"""Shared pieces of the training-data operators: shared-folder tables, text batches, skew-safe lookups."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A key with more than 1/HEAVY_SHARE of all rows is heavy, so at most HEAVY_SHARE keys are.
HEAVY_SHARE = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table `name` of a data folder, through Spark's reader (any store that Spark reads).

    A table of fewer pieces than there are cores (a file of one row group can't be split) is dealt out first.
    """
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


def shared_dir(spark: SparkSession) -> str:
    """A new path in the folder that driver and executors share.

    The folder is the session's spark.checkpoint.dir. Where that is unset, a session on one machine (tests) gets a
    folder of its own; on a cluster executors and driver would each write to their own disk, so that is an error.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base:
        known = spark.sparkContext.getCheckpointDir()
        if not known and not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = os.path.dirname(known.rstrip("/")) if known else "file://" + tempfile.mkdtemp(prefix="beadloom-")
        if not known:
            spark.sparkContext.setCheckpointDir(base)
    path = f"{base.rstrip('/')}/beadloom-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(hadoop)
    fs.deleteOnExit(hadoop)  # lives as long as the application, whose frames read it
    return path


def open_store(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path as Spark writes it (scheme:/path, scheme://host/path or a plain path), and the path there."""
    if "://" not in path:
        scheme, sep, rest = path.partition(":/")
        path = f"{scheme}:///{rest.lstrip('/')}" if sep else f"file://{os.path.abspath(path)}"
    return pafs.FileSystem.from_uri(path)


def materialise(df: DataFrame) -> DataFrame:
    """Write df once to the shared folder and read it back: cuts the lineage and survives lost executors."""
    path = f"{shared_dir(df.sparkSession)}/t"
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a frame made by materialise() that nothing reads any more."""
    spark = df.sparkSession
    for name in df.inputFiles()[:1]:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name).getParent().getParent()
        if "beadloom-" in path.getName():
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def map_batches(df: DataFrame, make: Callable[[], Callable[[dict], dict]], schema: str) -> DataFrame:
    """Apply a dict-of-lists function to Arrow batches. `make` runs once per task and returns the function."""
    target = df.sparkSession.createDataFrame([], schema).schema
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(target)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for batch in batches:
            if batch.num_rows:
                # short slices keep the Python copies of a batch of long texts small
                for at in range(0, batch.num_rows, 512):
                    out = f(batch.slice(at, 512).to_pydict())
                    yield pa.RecordBatch.from_arrays([pa.array(out[x.name], x.type) for x in arrow], schema=arrow)

    return df.mapInArrow(run, target)


def append_batches(df: DataFrame, make: Callable[[], Callable[[dict], dict]], schema: str, inputs: list[str]) -> DataFrame:
    """df with all its columns plus those of `schema`, computed from the columns `inputs` batch by batch.

    The names in `schema` must not clash with the frame's; `fresh` makes such.
    """
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    more = df.sparkSession.createDataFrame([], schema).schema
    arrow = to_arrow_schema(more)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                out = f({c: part.column(part.schema.get_field_index(c)).to_pylist() for c in inputs})
                arrays = [pa.array(out[x.name], x.type) for x in arrow]
                yield pa.RecordBatch.from_arrays([*part.columns, *arrays], names=[*part.schema.names, *arrow.names])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, *more.fields]))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the frame doesn't have, letter case aside."""
    known = {c.lower() for c in df.columns}
    while name.lower() in known:
        name += "_"
    return name


#: Longer words aren't remembered: text without spaces (other scripts, encoded data) is one word of any length.
LONGEST_CACHED = 64


class SegmentCache(dict):
    """word -> computed value, of two generations: after `cap` new words the old generation goes.

    Lookups of known words stay in C (dict with __missing__); memory is bounded by 2 * cap words of LONGEST_CACHED
    characters.
    """

    def __init__(self, compute: Callable, cap: int = 250_000):
        super().__init__()
        self.compute, self.cap, self.old = compute, cap, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
            if len(key) > LONGEST_CACHED:
                return value
        if len(self) >= self.cap:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def attach(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int, how: str = "inner") -> DataFrame:
    """rows joined with one row per key of `groups`, whatever the skew of `key`.

    `size` is the column of `groups` with the number of rows of each key, `total` the number of all rows.
    Keys with more than total/HEAVY_SHARE rows are at most HEAVY_SHARE, so they are broadcast; each of the
    others has at most total/HEAVY_SHARE rows, so a shuffle on the key is even. Mostly there is no heavy key; then nothing
    is broadcast and the rows are read once. `groups` is read for that first, so it should be a written table.
    """
    limit = max(1000, total // HEAVY_SHARE)
    if (groups.agg(F.max(size)).first()[0] or 0) <= limit:
        return rows.join(groups.drop(size).hint("merge"), key, how)
    heavy = groups.filter(F.col(size) > limit)
    light = groups.filter(F.col(size) <= limit).drop(size)
    mark = fresh(rows, "__heavy")
    marked = rows.join(F.broadcast(heavy.select(F.col(key), F.lit(True).alias(mark))), key, "left")
    hot = marked.filter(F.col(mark)).drop(mark).join(F.broadcast(heavy.drop(size)), key, "inner")
    rest = marked.filter(F.col(mark).isNull()).drop(mark).join(light.hint("merge"), key, how)
    return hot.unionByName(rest)
