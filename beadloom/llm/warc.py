"""WARC archives with a Zstandard dictionary: a writer, a reader, and de-duplication by payload digest.

Each archive starts with a skippable frame that holds a dictionary trained from records of that archive; each record
is a frame of its own behind it, so that a record can be read alone at its offset, given the dictionary. Records with
payloads seen before (of at least `min_payload` bytes) are revisits, which carry the HTTP header only.

Defined cases: null html is an empty payload; rows of one page_id and equal payloads are of one type; a row with a
null page_id can't be referred to, so it is a response unless a row with an id has its payload; a null url is written
as an empty one; payloads of any length are written whole (one longer than ARCHIVE closes its archive); of equal
payloads the smallest page_id is the response, and other columns are ignored; an empty table writes no archive and gives
an empty result. The dictionary is trained from slices spread over all records of its archive; where they are too few or
too much alike to train from, the slices themselves are the dictionary (raw content), so every archive has one, unless
its records are all empty.
"""

from __future__ import annotations

import hashlib
import io
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import attach, materialise, open_store, shared_dir

#: Of the skippable frame that holds a dictionary.
DICTIONARY_MAGIC = 0x184D2A5D
#: Bytes of records after which the writer closes an archive and begins another.
ARCHIVE = 16 << 20
#: Bytes of a dictionary, and of the records of an archive that it is trained from, at most.
DICTIONARY = 32 << 10
TRAINED_FROM = 2 << 20
SLICE = 8 << 10
#: Tasks that read archives back, at most; beyond, a task has several.
READERS = 20_000
LEVEL = 6
DATE = "2026-01-01T00:00:00Z"


def _name(page_id: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A response record, or a revisit if `refers_to` is given."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + (payload if refers_to is None else b"")
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_name(page_id) if page_id is not None else f'<urn:uuid:{uuid.uuid4()}>'}"]
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    uri = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    head += [f"WARC-Target-URI: {uri}", f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha256:{digest}"]
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {_name(refers_to)}", f"X-Refers-To-Page: {refers_to}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def train(records: list[bytes]) -> bytes:
    """A dictionary from slices of an archive's records, TRAINED_FROM bytes at most, spread evenly over all of them."""
    slices = [(r, at) for r in records for at in range(0, len(r), SLICE)]
    step = max(1, -(-len(slices) * SLICE // TRAINED_FROM))
    samples = [r[at : at + SLICE] for r, at in slices[::step]]
    if len(samples) >= 16:
        try:
            return zstandard.train_dictionary(min(DICTIONARY, max(1024, sum(map(len, samples)) // 8)), samples, d=8, k=256, steps=1, level=LEVEL).as_bytes()
        except zstandard.ZstdError:
            pass  # e.g. all samples alike
    # what stands last in a raw dictionary is nearest, so the first record's head goes there
    return b"".join(x[: max(64, DICTIONARY // max(1, len(samples)))] for x in reversed(samples))[-DICTIONARY:]


def write_archive(records: list[bytes], out) -> list[tuple[int, int]]:
    """Write an archive to a file object; (offset, length) of each record's frame."""
    d = train(records)
    lead = struct.pack("<II", DICTIONARY_MAGIC, len(d)) + d
    out.write(lead)
    packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(d) if d else None, write_checksum=True)
    places, at = [], len(lead)
    for r in records:
        frame = packer.compress(r)
        out.write(frame)
        places.append((at, len(frame)))
        at += len(frame)
    return places


def read_dictionary(f) -> zstandard.ZstdDecompressor:
    """The decompressor of an archive whose file object stands at its start."""
    magic, size = struct.unpack("<II", f.read(8))
    if magic != DICTIONARY_MAGIC:
        raise ValueError("an archive starts with a dictionary frame")
    d = f.read(size)
    return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(d) if d else None)


def _parse(f) -> tuple[dict[str, str], bytes] | None:
    """The next record's headers and block from a stream of records."""
    line = f.readline()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"no record starts here: {line[:40]!r}")
    headers = {}
    while line := f.readline().rstrip(b"\r\n"):
        k, _, v = line.partition(b": ")
        headers[k.decode()] = v.decode("utf-8", "surrogatepass")
    n = int(headers["Content-Length"])
    block = f.read(n)
    if len(block) != n or f.read(4) != b"\r\n\r\n":
        raise ValueError("a record is cut short")
    return headers, block


def read_archive(f) -> Iterator[tuple[dict[str, str], bytes]]:
    """All records of an archive, as a stream."""
    stream = io.BufferedReader(read_dictionary(f).stream_reader(f, read_across_frames=True), 1 << 16)
    while (found := _parse(stream)) is not None:
        yield found


def read_record(f, offset: int, length: int) -> tuple[dict[str, str], bytes]:
    """One record by its place, without reading those before it."""
    unpacker = read_dictionary(f)
    f.seek(offset)
    found = _parse(io.BytesIO(unpacker.decompress(f.read(length))))
    assert found is not None
    return found


def describe(headers: dict[str, str], block: bytes) -> dict:
    """What a record says of its page; a response's digest is computed from its payload."""
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(next(x for x in http.split(b"\r\n") if x.startswith(b"Content-Length: "))[16:])
    stored = headers["WARC-Payload-Digest"].removeprefix("sha256:")
    response = headers["WARC-Type"] == "response"
    if response and (len(payload) != size or hashlib.sha256(payload).hexdigest() != stored):
        raise ValueError("a payload differs from its digest")
    return {
        "page_id": int(headers["X-Page-Id"]) if "X-Page-Id" in headers else None, "url": headers["WARC-Target-URI"], "payload_bytes": size, "payload_digest": stored,
        "record_type": headers["WARC-Type"], "refers_to": int(headers["X-Refers-To-Page"]) if "X-Refers-To-Page" in headers else None,
    }


def originals(pages: DataFrame, min_payload: int = 100) -> DataFrame:
    """digest, refers_to (the least page_id), n of the payloads of at least `min_payload` bytes that several rows have. Only digests
    are shuffled."""
    digests = pages.select(F.col("page_id").cast("long").alias("page_id"), F.sha2("html", 256).alias("digest")).filter(F.octet_length("html") >= min_payload)
    return materialise(digests.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")).filter("n > 1 AND refers_to IS NOT NULL"))


def write(pages: DataFrame, folder: str, min_payload: int = 100) -> DataFrame:
    """Write the pages as archives under `folder`; returns the index page_id, file, offset, length.

    Names of files are those of a task's own run; only files that the index (a table) names count.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html")).withColumn("digest", F.sha2("html", 256))
    # payloads of very many rows are looked up where their rows are, the others by a join on the digest alone
    found = attach(rows, originals(rows, min_payload), "digest", "n", rows.count(), "left")
    refers_to = F.when(F.col("page_id").isNull() | (F.col("page_id") != F.col("refers_to")), F.col("refers_to"))
    rows = found.select("page_id", "url", "html", "digest", refers_to.alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_store(folder)
        held: list[bytes] = []
        ids: list = []
        size = 0

        def flush() -> pa.RecordBatch:
            name = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.zst"
            with fs.open_output_stream(f"{root}/{name}", compression=None) as out:
                places = write_archive(held, out)
            return pa.RecordBatch.from_pydict({"page_id": pa.array(ids, pa.int64()), "file": pa.array([name] * len(ids), pa.string()), "offset": pa.array([p for p, _ in places], pa.int64()), "length": pa.array([n for _, n in places], pa.int64())})

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                for page_id, url, html, digest, refers_to in zip(*(c.to_pylist() for c in part.columns)):
                    r = record(page_id, url, html.encode("utf-8", "surrogatepass"), digest, refers_to)
                    held.append(r)
                    ids.append(page_id)
                    size += len(r)
                    if size >= ARCHIVE:
                        yield flush()
                        held, ids, size = [], [], 0
        if held:
            yield flush()

    return materialise(rows.mapInArrow(run, "page_id long, file string, offset long, length long"))


def read(index: DataFrame, folder: str) -> DataFrame:
    """The records of the archives that an index names, read back from the files, one row each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_store(folder)
        for batch in batches:
            for name in batch.column("file").to_pylist():
                with fs.open_input_stream(f"{root}/{name}", compression=None, buffer_size=1 << 16) as f:
                    rows = [describe(*x) for x in read_archive(f)]
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])
    files = materialise(index.select("file").distinct())
    # names are a few bytes but stand for archives, so adaptive coalescing must not pack them together
    return files.repartition(min(READERS, max(1, files.count())), "file").mapInArrow(run, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long")


def archive_round_trip(pages: DataFrame, min_payload: int = 100) -> DataFrame:
    folder = shared_dir(pages.sparkSession)
    return read(write(pages, folder, min_payload), folder)
