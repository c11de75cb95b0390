"""FASTQ as a Spark data source, and read in ranges of bytes.

Fields: file, rec_no (from 0, within the file), name, seq, plus, qual. A record that is cut short or malformed is an error.

`read` cuts plain files into ranges. As a line that begins with "@" may be one of qualities, no range can tell from its own
bytes where a record begins; so a first pass counts line ends per range, a running sum over the ranges of a file gives the
number of each range's first line, and thereby both the place of its first record and that record's number. A packed file is
one range, as it can't be read from the middle. Small ranges share tasks, as the driver keeps account of every task. spark.read.format("fastq").load(path)
reads a file per task, in one pass.
The writer packs with .option("compression", "gzip").
"""

from __future__ import annotations

import gzip
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from ..operators import order
from .ragged import places, strings
from .store import Written, list_files, locate, open_maybe_gzip, show

SCHEMA = "file string, rec_no long, name string, seq string, plus string, qual string"


ARROW = pa.schema([("file", pa.string()), ("rec_no", pa.int64()), *((c, pa.string()) for c in ("name", "seq", "plus", "qual"))])
#: Bytes of text that are taken apart at once, and of a range.
CHUNK, SPLIT_BYTES = 4 << 20, 64 << 20
#: Bytes that are read at least.
LEAST_READ = 64 << 10
#: Tasks at most that ranges are dealt to.
MOST_TASKS = 20_000


def frame(data: bytes, ends: np.ndarray, file: str, rec_no: int) -> pa.RecordBatch:
    """Whole records: data begins with one, and `ends` are the places of its line ends, four per record."""
    raw = np.frombuffer(data, np.uint8)
    begin = np.concatenate((np.zeros(1, np.int64), ends[:-1] + 1))
    stop = ends.copy()
    while (cr := (stop > begin) & (raw[np.maximum(stop - 1, 0)] == 13)).any():
        stop -= cr
    first = np.where(stop > begin, raw[np.minimum(begin, len(raw) - 1)], 0).reshape(-1, 4)
    size = (stop - begin).reshape(-1, 4)
    bad = (first[:, 0] != ord("@")) | (first[:, 2] != ord("+")) | (size[:, 1] != size[:, 3])
    if bad.any():
        raise ValueError(f"{file}: record {rec_no + int(bad.argmax())} is malformed")
    texts = [strings(raw[places(begin[i::4], size[:, i])], size[:, i]) for i in range(4)]
    for t in texts:
        t.validate(full=True)
    n = len(size)
    return pa.RecordBatch.from_arrays([pa.array([file] * n, pa.string()), pa.array(np.arange(rec_no, rec_no + n)), *texts], schema=ARROW)


def parse(f, file: str, rec_no: int = 0, skip: int = 0, records: int | None = None, first_read: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """Records of a stream behind `skip` line ends: `records` of them, or all. The last line may lack its end.

    The first read is of `first_read` bytes at most, each later one twice the one before, up to CHUNK.
    """
    data, ended, step = b"", False, min(first_read, CHUNK)
    while not ended and records != 0:
        more = f.read(step)
        step = min(2 * step, CHUNK)
        ended = not more
        data += more
        if ended and data and data[-1:] != b"\n":
            data += b"\n"
        ends = np.flatnonzero(np.frombuffer(data, np.uint8) == 10)
        if skip:
            cut = min(skip, len(ends))
            if cut:
                data = data[ends[cut - 1] + 1 :]
                ends = ends[cut:] - (ends[cut - 1] + 1)
            skip -= cut
            if skip:
                data, ends = b"", ends[:0]
        n = len(ends) // 4 if records is None else min(len(ends) // 4, records)
        if n:
            yield frame(data, ends[: 4 * n], file, rec_no)
            data = data[ends[4 * n - 1] + 1 :]
            rec_no += n
            records = None if records is None else records - n
    if records or (records is None and data):
        raise ValueError(f"{file}: record {rec_no} is cut short")


@dataclass
class FilePart(InputPartition):
    path: str


class _Reader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[FilePart]:
        return [FilePart(p) for p in list_files(self.path)]

    def read(self, partition: FilePart) -> Iterator[pa.RecordBatch]:
        with open_maybe_gzip(partition.path) as f:
            yield from parse(f, partition.path)


@dataclass
class _Message(WriterCommitMessage):
    file: Written


class _Writer(DataSourceWriter):
    """Each task writes a file of its own under a hidden name; the commit shows those of the tasks that counted."""

    def __init__(self, path: str, packed: bool):
        self.path, self.packed = path, packed

    def write(self, rows: Iterator) -> _Message:
        fs, root = locate(self.path)
        fs.create_dir(root, recursive=True)
        name, n = f"part-{uuid.uuid4().hex}.fastq{'.gz' if self.packed else ''}", 0
        with fs.open_output_stream(f"{root}/.{name}", compression=None) as raw:
            out = gzip.GzipFile(fileobj=raw, mode="wb", mtime=0) if self.packed else raw
            for r in rows:
                out.write(f"{r.name}\n{r.seq}\n{r.plus}\n{r.qual}\n".encode())
                n += 1
            if self.packed:
                out.close()
        return _Message(Written("", name, n))

    def commit(self, messages: list) -> None:
        show(self.path, [m.file for m in messages])

    def abort(self, messages: list) -> None:
        fs, root = locate(self.path)
        for m in messages:
            if m is not None:
                fs.delete_file(f"{root}/.{m.file.name}")


class FastqSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "fastq"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"])

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return _Writer(self.options["path"], self.options.get("compression", "none").lower() == "gzip")


def _ranges(spark: SparkSession, path: str, split_bytes: int) -> tuple[DataFrame, int]:
    """(file, start, stop, size of each range, dealt over tasks; number of tasks).

    The number of tasks goes by bytes and cores, that of ranges by `split_bytes`; the driver holds a row per file.
    """
    found = []
    for p in list_files(path):
        fs, q = locate(p)
        if size := fs.get_file_info(q).size:
            found.append((p, size))
    enough = max(8, 2 * spark.sparkContext.defaultParallelism, -(-sum(size for _, size in found) // SPLIT_BYTES))
    parts = max(1, min(sum(-(-size // split_bytes) for _, size in found), enough, MOST_TASKS))
    starts = F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(split_bytes).cast("long"))
    ranges = spark.createDataFrame(found, "file string, size long").select("file", F.explode(starts).alias("start"), "size")
    return ranges.select("file", "start", F.least(F.col("start") + split_bytes, "size").alias("stop"), "size").repartition(parts, "file", "start"), parts


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Line ends in each range of a plain file; a packed file's first range stands for all of it, with -1."""
    for batch in batches:
        for r in batch.to_pylist():
            fs, p = locate(r["file"])
            with fs.open_input_file(p) as f:
                n = -1
                if f.read(2) == b"\x1f\x8b":
                    if r["start"]:
                        continue
                    r["stop"] = r["size"]
                else:
                    n, at = 0, r["start"]
                    f.seek(at)
                    while at < r["stop"]:
                        data = f.read(min(CHUNK, r["stop"] - at))
                        n += data.count(b"\n")
                        at += len(data)
                    if at == r["size"] and data[-1:] != b"\n":
                        n += 1  # the last line lacks its end
            yield pa.RecordBatch.from_pylist([r | {"lines": n}])


def _read_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records that follow a line end in each range, and the first of a file."""
    for batch in batches:
        for r in batch.to_pylist():
            file, before, lines = r["file"], r["before"], r["lines"]
            if lines < 0:
                with open_maybe_gzip(file) as f:
                    yield from parse(f, file)
                continue
            # record r follows the line end 4 * r, counted from 1; the first follows none
            first = before // 4 + 1 if r["start"] else 0
            last = min((before + lines) // 4 + 1, -(-r["total"] // 4))
            fs, p = locate(file)
            with fs.open_input_file(p) as f:
                f.seek(r["start"])
                yield from parse(f, file, first, 4 * first - before, max(last - first, 0), max(r["stop"] - r["start"], LEAST_READ))


def read(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The records of a file or folder, in ranges of `split_bytes`."""
    spark.dataSource.register(FastqSource)  # so that records can be written as the format from here on
    ranges, parts = _ranges(spark, path, split_bytes)
    counted = ranges.mapInArrow(_count, "file string, start long, stop long, size long, lines long")
    file = Window.partitionBy("file")  # a row per range
    before = F.sum("lines").over(file.orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    numbered = counted.withColumns({"before": F.coalesce(before, F.lit(0)), "total": F.sum("lines").over(file)})
    return numbered.repartition(parts, "file", "start").mapInArrow(_read_ranges, SCHEMA)


def write(records: DataFrame, path: str, packed: bool = False) -> None:
    """name, seq, plus, qual as FASTQ files below a folder, packed if asked for."""
    spark = records.sparkSession
    spark.dataSource.register(FastqSource)
    records.select("name", "seq", "plus", "qual").write.format("fastq").option("compression", "gzip" if packed else "none").mode("append").save(path)


def write_named(records: DataFrame, path: str, column: str) -> DataFrame:
    """name, seq, plus, qual as a file per value of a column, which is its name; packed if that ends in .gz. Returns name and number
    of records of each. A file is written by one task, as its rows come sorted by name."""
    spark = records.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = records.select(column, "name", "seq", "plus", "qual").repartition(parts, column).sortWithinPartitions(column, "name")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = locate(path)
        fs.create_dir(root, recursive=True)
        out, raw, done = None, None, []

        def close() -> None:
            if out is not None:
                out.close()
                if raw is not out:
                    raw.close()

        for batch in batches:
            for file, *record in zip(*(c.to_pylist() for c in batch.columns)):
                if not done or done[-1][0] != file:
                    close()
                    mark = uuid.uuid4().hex
                    done.append([file, mark, 0])
                    raw = fs.open_output_stream(f"{root}/.{mark}", compression=None)
                    out = gzip.GzipFile(fileobj=raw, mode="wb", mtime=0) if file.endswith(".gz") else raw
                out.write("\n".join([*record, ""]).encode())
                done[-1][2] += 1
        close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), (pa.string(), pa.string(), pa.int64()))], names=["file", "mark", "records"])

    found = rows.mapInArrow(run, "file string, mark string, records long").collect()  # a row per file
    fs, root = locate(path)
    for r in found:
        fs.move(f"{root}/.{r.mark}", f"{root}/{r.file}")
    return spark.createDataFrame([(r.file, r.records) for r in found], "file string, records long")


def frame_lines(rows: DataFrame) -> DataFrame:
    """Numbered lines (file, line_no from 0, line) -> records; for text that is already a table."""
    part = F.col("line_no") % 4
    pick = lambda i: F.max(F.when(part == i, F.col("line")))
    return rows.groupBy("file", F.floor(F.col("line_no") / 4).cast("long").alias("rec_no")).agg(pick(0).alias("name"), pick(1).alias("seq"), pick(2).alias("plus"), pick(3).alias("qual"))


def discover(spark: SparkSession, path: str) -> DataFrame:
    """Samples of a folder by file name: sample, read, paths in order. File names only, whatever their number of bytes."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path")
    return group_samples(files)


# The shape of a file name.
FILE_NAME = r"^(.+)_(R[12])\.(fastq\.gz|fq\.gz|fastq|fq)$"


def group_samples(files: DataFrame) -> DataFrame:
    base = F.element_at(F.split("path", "/"), -1)
    found = files.select("path", F.regexp_extract(base, FILE_NAME, 1).alias("sample"), F.regexp_extract(base, FILE_NAME, 2).alias("read")).filter("sample <> ''")
    return found.groupBy("sample", "read").agg(F.array_join(F.array_sort(F.collect_list("path")), ",").alias("paths"))


def split_manifest(files: DataFrame, k: int) -> DataFrame:
    """sample, read, path -> with chunk: a sample's files in order, cut at the k-th parts of their number (halves to even)."""
    by = ["sample", "read"]
    numbered = order.running_sums(files.withColumn("__one", F.lit(1).cast("long")), "path", {"__i": "__one"}, by)
    rows = numbered.join(files.groupBy(*by).agg(F.count("*").alias("__n")), by)
    cuts = sum((F.when(F.col("__i") > F.bround(F.col("__n") * F.lit(i / k), 0), 1).otherwise(0) for i in range(1, k)), F.lit(0))
    return rows.withColumn("chunk", cuts).drop("__i", "__n", "__one")
