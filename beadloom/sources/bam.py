"""BAM as a Spark data source, after the published format: spark.read.format("bam").load(path).

Fields: file, voffset (virtual offset, which rises with the place in the file), qname, flag, ref_name, ref_start, ref_end (null
if unplaced), cigar, seq, qual, tags (as text), mapq, mate_ref, mate_start, insert_size, tag_types (the type letter of each tag).

A file is read in pieces of `splitBytes`: a task looks for the first block in its piece and for the first record in it, and
reads the records that begin in its blocks. Where a sorted file has an index beside it, filters on ref_name, ref_start and
ref_end are pushed into the source, which then opens only the chunks of that region; `fetch` makes such filters.

`write` gives each partition a file of its own, `write_by` one per value of a column, `write_sorted` ranges of the genome
with an index each; files get their names on the driver, once all tasks are done.
"""

from __future__ import annotations

import io
import uuid
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, IsNotNull, LessThan, LessThanOrEqual

from . import blocks
from .bam_index import Index
from .bam_records import ARROW, MORE, SCHEMA, Header, Short, decode, decode_header, encode, field, first_start, starts
from .ragged import offsets
from .store import Written, list_files, locate, open_maybe_gzip, show

__all__ = ["SCHEMA", "Header", "fetch", "header", "header_lines", "read", "write", "write_by", "write_sorted"]

#: Uncompressed bytes that are decoded at once, and that the first record of a piece is looked for in.
BATCH_BYTES, GUESS_BYTES = 2 << 20, 256 << 10
SPLIT_BYTES = 32 << 20
BLOCK_BYTES = 60_000
END = 1 << 63


# reading


def read_header(f, name: str) -> tuple[Header, int]:
    """(header, virtual offset of the first record)."""
    data, marks = b"", []
    for place, content in blocks.read(f, 0, 1 << 16):
        marks.append((len(data), place))
        data += content
        try:
            header, at = decode_header(data, name)
        except Short:
            continue
        k = bisect_right(marks, (at, END)) - 1
        return header, marks[k][1] << 16 | at - marks[k][0] if at < len(data) else (place << 16) + len(content)
    raise ValueError(f"{name} is no BAM file")


def records(f, header: Header, name: str, begin: int, stop: int) -> Iterator[pa.RecordBatch]:
    """The records that begin at virtual offsets from `begin` on, where one does, and before `stop`."""
    held: list[bytes] = []
    marks: list[tuple[int, int]] = []  # (place in what is held, file offset) of blocks
    size, at, limit = 0, begin & 0xFFFF, None  # limit: the place of `stop` in what is held, once it is known
    source = blocks.read(f, begin >> 16)
    while True:
        ended, enough = False, size + (BATCH_BYTES if limit is None else 1)
        while size < enough:
            block = next(source, None)
            if block is None:
                ended, limit = True, size if limit is None else limit
                break
            place, content = block
            if limit is None and place >= stop >> 16:
                limit = size + (stop & 0xFFFF if place == stop >> 16 else 0)
                enough = size + 1
            marks.append((size, place))
            held.append(content)
            size += len(content)
        data = b"".join(held)
        found, behind = starts(data, at, limit)
        if found:
            places = np.array([p for p, _ in marks])
            k = np.searchsorted(places, found, side="right") - 1
            yield decode(data, found, header, name, np.array([c for _, c in marks], np.int64)[k] << 16 | (np.array(found) - places[k]))
        if limit is not None and behind >= limit:
            return
        if ended:
            raise ValueError(f"{name}: a record is cut short")
        cut = min(behind, size)  # a record that goes on in blocks to come stays
        marks = [(p - cut, c) for p, c in marks[max(bisect_right(marks, (cut, END)) - 1, 0) :]]
        held, size, at = [data[cut:]], size - cut, behind - cut
        limit = None if limit is None else limit - cut


def piece(f, name: str, start: int, stop: int, size: int) -> Iterator[pa.RecordBatch]:
    """The records that begin in blocks that begin in [start, stop) of a file."""
    header, first = read_header(f, name)
    begin = first
    if start > first >> 16:
        block = blocks.find(f, start, min(stop, size))
        if block is None:
            return
        data, whole = b"", True
        marks = []
        for place, content in blocks.read(f, block):
            marks.append((len(data), place))
            data += content
            if len(data) >= GUESS_BYTES and (at := first_start(data, len(header.references), False)) is not None:
                whole = False
                break
        if whole:
            at = first_start(data, len(header.references), True)
            if at >= len(data):
                return
        k = bisect_right(marks, (at, END)) - 1
        begin = marks[k][1] << 16 | at - marks[k][0]
    if begin < stop << 16:
        yield from records(f, header, name, begin, stop << 16)


@dataclass
class Piece(InputPartition):
    """A range of file offsets, or, with an index, of virtual offsets."""

    path: str
    start: int
    stop: int
    size: int
    chunk: bool = False


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.split = int(options.get("splitBytes", SPLIT_BYTES))
        self.region: dict = {}

    def files(self) -> list[tuple[str, int]]:
        out = []
        for path in list_files(self.path):
            if not path.endswith(".bai"):
                fs, p = locate(path)
                out.append((path, fs.get_file_info(p).size))
        return out

    def partitions(self) -> list[Piece]:
        out = []
        for path, size in self.files():
            chunks = self.chunks(path) if self.region else None
            if chunks is None:
                out += [Piece(path, a, min(a + self.split, size), size) for a in range(0, size, self.split)]
            else:
                out += [Piece(path, a, b, size, True) for a, b in chunks]
        return out or [Piece("", 0, 0, 0)]

    def chunks(self, path: str) -> list[tuple[int, int]] | None:
        """What a region needs of a file; None without an index."""
        fs, p = locate(path + ".bai")
        if not fs.get_file_info(p).is_file:
            return None
        with fs.open_input_file(p) as f:
            index = Index.decode(f.read())
        fs, p = locate(path)
        with fs.open_input_file(p) as f:
            header, first = read_header(f, path)
        if "ref" not in self.region:
            return [(first, index.placed_end)] if index.placed_end > first else []
        names = [n for n, _ in header.references]
        if self.region["ref"] not in names:
            return []
        return index.region(names.index(self.region["ref"]), self.region.get("begin", 0), self.region.get("end", 1 << 29))

    def read(self, partition: Piece) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        fs, p = locate(partition.path)
        with fs.open_input_file(p) as f:
            if partition.chunk:
                yield from records(f, read_header(f, partition.path)[0], partition.path, partition.start, partition.stop)
                return
            if blocks.head(f.read(64), 0) is not None:
                yield from piece(f, partition.path, partition.start, partition.stop, partition.size)
                return
        if partition.start == 0:  # plain, or packed as a whole: a stream, so one task
            with open_maybe_gzip(partition.path) as whole:
                yield from _stream(whole, partition.path)


def _stream(f: io.BufferedReader, name: str) -> Iterator[pa.RecordBatch]:
    data = f.read(BATCH_BYTES)
    while True:
        try:
            header, at = decode_header(data, name)
            break
        except Short:
            more = f.read(BATCH_BYTES)
            if not more:
                raise ValueError(f"{name} is no BAM file") from None
            data += more
    base = 0
    while True:
        found, behind = starts(data, at)
        if found:
            yield decode(data, found, header, name, np.array(found) + base)
        more = f.read(BATCH_BYTES)
        if not more and behind < len(data):
            raise ValueError(f"{name}: a record is cut short")
        if not more:
            return
        base, data, at = base + behind, data[behind:] + more, 0


class _FilteredReader(_Reader):
    """With filters on the place pushed down. All are evaluated again by Spark, as chunks hold a little more."""

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        lows, highs = [], []
        for x in filters:
            column, value = x.attribute[0], getattr(x, "value", None)
            if column == "ref_name" and isinstance(x, EqualTo):
                self.region["ref"] = value
            elif column == "ref_name" and isinstance(x, IsNotNull):
                self.region["placed"] = True
            elif column == "ref_start" and isinstance(x, (LessThan, LessThanOrEqual, EqualTo)):
                highs.append(value + (not isinstance(x, LessThan)))
            if column in ("ref_start", "ref_end") and isinstance(x, (GreaterThan, GreaterThanOrEqual)):
                lows.append(value - (isinstance(x, GreaterThanOrEqual) and column == "ref_end"))
            if column == "ref_start" and isinstance(x, EqualTo):
                lows.append(value)
        if lows:
            self.region["begin"] = max(lows)
        if highs:
            self.region["end"] = min(highs)
        if "ref" not in self.region and "placed" not in self.region:
            self.region = {}  # places mean nothing without a reference
        return filters


class BamSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "bam"

    def schema(self) -> str:
        return f"{SCHEMA}, {MORE}"

    def reader(self, schema) -> DataSourceReader:
        return (_FilteredReader if self.options.get("pushdown") == "true" else _Reader)(self.options)


PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


def read(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES, pushdown: bool = True) -> DataFrame:
    """The alignments of a file or folder. With `pushdown`, the session is told to push filters into Python sources."""
    spark.dataSource.register(BamSource)
    if pushdown:
        spark.conf.set(PUSHDOWN, "true")
    return spark.read.format("bam").option("splitBytes", split_bytes).option("pushdown", str(pushdown).lower()).load(path)


def fetch(spark: SparkSession, path: str, ref: str | None = None, begin: int | None = None, end: int | None = None) -> DataFrame:
    """The placed alignments that touch [begin, end) of a reference, or all placed ones."""
    where: Column = F.col("ref_name").isNotNull() if ref is None else F.col("ref_name") == ref
    if end is not None:
        where &= F.col("ref_start") < end
    if begin is not None:
        where &= F.col("ref_end") > begin
    return read(spark, path).filter(where)


def header_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, line_no, kind (HD, SQ, RG, PG, CO), name, length, line of the headers of all files; read by tasks."""
    files = [(i, p) for i, p in enumerate(list_files(path)) if not p.endswith(".bai")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for no, p in zip(*(c.to_pylist() for c in batch.columns)):
                fs, q = locate(p)
                with fs.open_input_file(q) as f:
                    h, _ = read_header(f, p)
                rows = [(no, p, "HD", None, None, h.first)] + [(no, p, "SQ", n, s, f"@SQ\tSN:{n}\tLN:{s}") for n, s in h.references]
                rows += [(no, p, x[1:3], field(x, "ID") or None, None, x) for x in h.lines]
                yield pa.RecordBatch.from_pylist([dict(zip(names, (*r[:2], i, *r[2:]))) for i, r in enumerate(rows)], schema=schema)

    names = ["file_no", "file", "line_no", "kind", "name", "length", "line"]
    schema = pa.schema(list(zip(names, [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()])))
    parts = max(1, min(len(files), spark.sparkContext.defaultParallelism))
    return spark.createDataFrame(files, "no long, path string").repartition(parts).mapInArrow(run, "file_no long, file string, line_no long, kind string, name string, length long, line string")


def header(spark: SparkSession, path: str) -> Header:
    """The header of all files of a folder as one: what is equal in several comes to the driver once."""
    rows = header_lines(spark, path).groupBy("kind", "name", "length", "line").agg(F.min(F.struct("file_no", "line_no")).alias("at")).orderBy("at").collect()
    parts = [Header(tuple((r.name, r.length) for r in rows if r.kind == "SQ" and r.name == n)) for n in dict.fromkeys(r.name for r in rows if r.kind == "SQ")]
    first = next((r.line for r in rows if r.kind == "HD"), Header().first)
    return Header((), first, tuple(r.line for r in rows if r.kind not in ("HD", "SQ"))).merged(*[Header((x,)) for p in parts for x in p.references])


# writing


class _File:
    """A file that is being written, block by block, with an index of what is in it."""

    def __init__(self, out, header: Header, indexed: bool, block_bytes: int):
        self.out, self.header, self.size = out, header, block_bytes
        self.index = Index() if indexed else None
        self.held, self.total, self.places = bytearray(), 0, [0]
        self.put(header.encode())

    def put(self, data: bytes) -> None:
        self.held += data
        self.total += len(data)
        at = 0
        while len(self.held) - at >= self.size:
            self._block(bytes(self.held[at : at + self.size]))
            at += self.size
        del self.held[:at]

    def _block(self, data: bytes) -> None:
        packed = blocks.pack(data)
        self.out.write(packed)
        self.places.append(self.places[-1] + len(packed))

    def add(self, batch: pa.RecordBatch, numbers: dict[str, int]) -> None:
        found = encode(batch, numbers)
        ends = offsets(found.size) + self.total
        self.put(found.data)
        if self.index is not None:
            v = np.array(self.places, np.int64)[ends // self.size] << 16 | ends % self.size
            self.index.add(found.ref, found.begin, found.end, v[:-1], v[1:])

    def close(self) -> None:
        if self.held:
            self._block(bytes(self.held))
        self.out.write(blocks.END)
        self.out.close()


def _write(rows: DataFrame, path: str, header: Header, by: str | None, indexed: bool, block_bytes: int) -> DataFrame:
    """Files of runs of rows with one value of `by`, each below a folder of that value; the driver shows them at the end."""
    numbers = {n: i for i, (n, _) in enumerate(header.references)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = locate(path)
        value, out, done = None, None, []

        def close() -> None:
            if out is not None:
                out.close()
                if out.index is not None:
                    with fs.open_output_stream(f"{root}/.{done[-1].name}.bai", compression=None) as f:
                        f.write(out.index.encode(len(header.references)))

        for batch in batches:
            if not batch.num_rows:
                continue
            cuts = [0, batch.num_rows]
            if by:
                codes = batch.column(by).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
                cuts = [0, *(np.flatnonzero(np.diff(codes)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                part = batch.slice(a, b - a)
                mine = part.column(by)[0].as_py() if by else None
                if out is None or (by and mine != value):
                    close()
                    value = mine
                    folder = f"{by}={quote(str(value), safe='').replace('%', '=')}" if by else ""  # a percent sign would be read as part of a URL
                    done.append(Written(folder, f"part-{uuid.uuid4().hex}.bam", 0))
                    fs.create_dir(f"{root}/{folder}" if folder else root, recursive=True)
                    raw = fs.open_output_stream(f"{root}/{folder}/.{done[-1].name}" if folder else f"{root}/.{done[-1].name}", compression=None)
                    out = _File(raw, header.with_group(str(value)) if by else header, indexed, block_bytes)
                out.add(part, numbers)
                done[-1].records += part.num_rows
        close()
        yield pa.RecordBatch.from_pydict({"folder": pa.array([w.folder for w in done], pa.string()), "name": pa.array([w.name for w in done], pa.string()), "records": pa.array([w.records for w in done], pa.int64())})

    found = [Written(*r) for r in rows.mapInArrow(run, "folder string, name string, records long").collect()]  # a row per file
    if indexed:
        show(path, [Written(w.folder, f"{w.name}.bai", 0) for w in found])
    show(path, found)
    return rows.sparkSession.createDataFrame([(w.folder, w.name, w.records) for w in found], "folder string, file string, records long")


def _header(references: list[tuple[str, int]] | Header, groups: list[str] | None = None) -> Header:
    return references if isinstance(references, Header) else Header.build(references, groups or [])


def write(rows: DataFrame, path: str, references: list[tuple[str, int]] | Header, groups: list[str] | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One BAM file per partition with rows under `path`; returns name and number of records of each. `references` are those of
    the header, or a whole header, such as that of the files that the rows come from."""
    return _write(rows, path, _header(references, groups), None, False, block_bytes).drop("folder")


def write_sorted(rows: DataFrame, path: str, references: list[tuple[str, int]] | Header, groups: list[str] | None = None, files: int | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Files of ranges of the genome, each sorted by place and with an index; unplaced rows come last."""
    head = _header(references, groups).sorted_by("coordinate")
    parts = files or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    number = F.array_position(F.array(*[F.lit(n) for n, _ in head.references]).cast("array<string>"), F.col("ref_name"))
    order = ["__ref", "__start", "qname", "flag"]
    keyed = rows.withColumns({"__ref": F.coalesce(F.nullif(number, F.lit(0)), F.lit(len(head.references) + 1)), "__start": F.coalesce("ref_start", F.lit(-1))})
    return _write(keyed.repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("__ref", "__start"), path, head, None, True, block_bytes).drop("folder")


def write_by(rows: DataFrame, path: str, references: list[tuple[str, int]] | Header, by: str, files: int = 8) -> DataFrame:
    """BAM files per value of a column, such as a label, up to `files` each, with the value as read group and as RG tag.

    A value with very many rows is dealt over `files` tasks by a hash of the name, so both mates are in one file.
    """
    rg = F.create_map(F.lit("RG"), F.col(by).cast("string"))
    none = F.create_map().cast("map<string,string>")
    tagged = rows.withColumn("tags", F.map_concat(F.map_filter(F.coalesce(F.col("tags"), none), lambda k, _: k != "RG"), rg))
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = tagged.withColumn("__deal", F.pmod(F.xxhash64("qname"), F.lit(files))).repartition(parts, by, "__deal").drop("__deal")
    return _write(dealt.sortWithinPartitions(by), path, _header(references), by, False, BLOCK_BYTES)
