"""Small tables beside the reads: tag configuration, rounds, counts, manifests; and cluster text."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clusters, order
from ..operators.tags import Layout
from .store import Written, locate, show


def tag_config(spark: SparkSession, path: str, skip: int = 3) -> DataFrame:
    """type, name, tag, tolerance, ord (place in the file) of a tag table behind `skip` lines; '#' lines and short ones left out."""
    raw = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", r"\r?\n")).alias("ord", "line"))
    rows = raw.filter((F.col("ord") >= skip) & ~F.startswith("line", F.lit("#"))).select("ord", F.split("line", "\t").alias("f")).filter(F.size("f") >= 4)
    return rows.select(F.col("f")[0].alias("type"), F.col("f")[1].alias("name"), F.col("f")[2].alias("tag"), F.col("f")[3].try_cast("int").alias("tolerance"), "ord").dropna()


def layout(spark: SparkSession, path: str) -> Layout:
    """The layout that a tag table begins with: lines READ1, READ2, SPACER and LAXITY, "name = value"; an error without READ1
    or READ2, or for a number that is none."""
    rows = spark.read.text(path).select(F.regexp_extract("value", r"^(READ1|READ2|SPACER|LAXITY)\s*=\s*(.*?)\s*$", 1).alias("k"), F.regexp_extract("value", r"^\w+\s*=\s*(.*?)\s*$", 1).alias("v"))
    found = {r.k: r.v for r in rows.filter("k <> ''").collect()}  # four lines
    if not {"READ1", "READ2"} <= found.keys():
        raise ValueError(f"{path} has no line READ1 or no line READ2")
    parts = [tuple(p.strip() for p in found[k].split("|")) for k in ("READ1", "READ2")]
    if any(not p for x in parts for p in x):
        raise ValueError(f"{path} has an empty part in a layout")
    return Layout(*parts, **{k.lower(): int(found[k]) for k in ("SPACER", "LAXITY") if k in found})


def rounds(spark: SparkSession, path: str) -> DataFrame:
    """pos, name of a rounds table; further columns are ignored."""
    rows = spark.read.text(path).select(F.split("value", "\t").alias("f")).filter(F.size("f") >= 2)
    return rows.select(F.col("f")[0].cast("int").alias("pos"), F.col("f")[1].alias("name"))


def tab_separated(spark: SparkSession, path: str, schema: str, header: bool = False) -> DataFrame:
    return spark.read.csv(path, sep="\t", schema=schema, header=header)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """sample, read, path of a JSON object {sample: {R1: [...], R2: [...]}}."""
    whole = spark.read.text(path, wholetext=True).select(F.from_json("value", "map<string,map<string,array<string>>>").alias("m"))
    return whole.select(F.explode("m").alias("sample", "r")).select("sample", F.explode("r").alias("read", "p")).select("sample", "read", F.explode("p").alias("path"))


def settings(spark: SparkSession, path: str) -> DataFrame:
    """key, value of a YAML file: a row per scalar, the key of a nested one being its path (a.b[0].c), quotes taken off, comments
    left out. Maps and lists in blocks or in brackets are read; an empty value is an empty text."""
    text = spark.read.text(path, wholetext=True).first()  # one small file
    return spark.createDataFrame(yaml_scalars(text[0] if text else ""), "key string, value string")


def yaml_scalars(text: str) -> list[tuple[str, str]]:
    """(path, value) of the scalars of a YAML text of block and bracketed maps and lists; an error for what else is there."""
    rows = []
    for line in text.split("\n"):
        bare = _uncommented(line).rstrip()
        if bare.strip() and bare.strip() not in ("---", "..."):
            rows.append((len(bare) - len(bare.lstrip(" ")), bare.strip()))
    out: list[tuple[str, str]] = []
    end = _block(rows, 0, -1, "", out)
    if end != len(rows):
        raise ValueError(f"can't read: {rows[end][1]}")
    return out


def _uncommented(line: str) -> str:
    quote = ""
    for i, c in enumerate(line):
        if quote:
            quote = "" if c == quote else quote
        elif c in "\"'" and (not i or line[i - 1] in " [{,:"):
            quote = c
        elif c == "#" and (not i or line[i - 1] in " \t"):
            return line[:i]
    return line


def _key(text: str) -> tuple[str, str] | None:
    """(key, rest) of "key: rest"."""
    m = re.match(r"""("[^"]*"|'[^']*'|[^\s"'\[\]{},#&*!|>%@`-][^:#]*?|-[^\s:][^:#]*?)\s*:(?:\s+(.*)|$)""", text)
    return (_bare(m.group(1)), m.group(2) or "") if m else None


def _bare(text: str) -> str:
    text = text.strip()
    return text[1:-1].replace("''", "'") if len(text) > 1 and text[0] == text[-1] and text[0] in "\"'" else text


def _block(rows: list[tuple[int, str]], i: int, above: int, path: str, out: list[tuple[str, str]]) -> int:
    """Reads the rows that are indented more than `above`, all alike; returns the number of the row behind them."""
    if i == len(rows) or rows[i][0] <= above:
        return i
    depth, item = rows[i][0], 0
    dash = lambda x: x == "-" or x.startswith("- ")
    is_list = dash(rows[i][1])
    while i < len(rows) and rows[i][0] == depth and dash(rows[i][1]) == is_list:
        text = rows[i][1]
        if is_list:
            here, rest = f"{path}[{item}]", text[1:].strip()
            item += 1
            if rest and rest[0] not in "[{" and (rest.startswith("- ") or _key(rest)):
                rows[i] = (depth + len(text) - len(text[1:].lstrip()), rest)  # a map or list that begins behind the dash
                i = _block(rows, i, depth, here, out)
                continue
        elif found := _key(text):
            here, rest = f"{path}.{found[0]}" if path else found[0], found[1].strip()
        else:
            raise ValueError(f"can't read: {text}")
        i += 1
        if rest:
            _flow(rest, here, out)
        else:
            # a list may stand as deep as its key
            deeper = depth - 1 if i < len(rows) and rows[i][0] == depth and rows[i][1][:1] == "-" and text[:1] != "-" else depth
            start = i
            i = _block(rows, i, deeper, here, out) if deeper == depth or rows[i][0] == depth else i
            if i == start:
                out.append((here, ""))
    return i


def _flow(text: str, path: str, out: list[tuple[str, str]]) -> None:
    """A scalar, or a bracketed list or map."""
    if text[0] not in "[{":
        out.append((path, _bare(text)))
        return
    if text[-1] != {"[": "]", "{": "}"}[text[0]]:
        raise ValueError(f"can't read: {text}")
    parts, depth, quote, start = [], 0, "", 1
    for i, c in enumerate(text[1:-1] + ",", 1):
        if quote:
            quote = "" if c == quote else quote
        elif c in "\"'":
            quote = c
        elif c in "[{":
            depth += 1
        elif c in "]}":
            depth -= 1
        elif c == "," and not depth:
            parts.append(text[start:i].strip())
            start = i + 1
    for k, part in enumerate(x for x in parts if x):
        if text[0] == "[":
            _flow(part, f"{path}[{k}]", out)
        else:
            key, rest = _key(part) or (_bare(part), "")
            if rest:
                _flow(rest, f"{path}.{key}", out)
            else:
                out.append((f"{path}.{key}", ""))


def read_clusters(spark: SparkSession, path: str) -> DataFrame:
    return clusters.parse(spark.read.text(path).withColumnRenamed("value", "line"))


def write_clusters(positions: DataFrame, path: str) -> DataFrame:
    """Cluster lines as text files below a folder; returns name and number of lines of each.

    A task streams its sorted positions, so a line may be of any length; the driver shows the files once all are done.
    """
    parts = int(positions.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = clusters.rendered(positions).repartition(parts, "barcode").sortWithinPartitions("barcode", "score", "text").select("barcode", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = locate(path)
        fs.create_dir(root, recursive=True)
        name, n, last, out = f"part-{uuid.uuid4().hex}.clusters", 0, None, None
        for batch in batches:
            for barcode, text in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    out = fs.open_output_stream(f"{root}/.{name}", compression=None, buffer_size=1 << 20)
                if barcode != last:
                    out.write((("\n" if n else "") + barcode).encode())
                    last, n = barcode, n + 1
                out.write(f"\t{text}".encode())
        if out is not None:
            out.write(b"\n")
            out.close()
            yield pa.RecordBatch.from_pydict({"file": [name], "lines": pa.array([n], pa.int64())})

    found = rows.mapInArrow(run, "file string, lines long").collect()  # a row per file
    show(path, [Written("", r.file, r.lines) for r in found])
    return positions.sparkSession.createDataFrame([tuple(r) for r in found], "file string, lines long")


def write_by(rows: DataFrame, path: str, column: str, files: int = 8) -> None:
    """A folder per value of a column, such as label or condition, with up to `files` files each, however many tasks there are."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    deal = F.floor(F.rand(17) * files)
    rows.withColumn("__deal", deal).repartition(parts, column, "__deal").drop("__deal").write.partitionBy(column).parquet(path)


def reports(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text reports with the file that they are from, and its folder."""
    place = F.split("_metadata.file_path", "/")
    return spark.read.option("recursiveFileLookup", "true").text(path).select(F.element_at(place, -1).alias("file"), F.element_at(place, -2).alias("folder"), F.col("value").alias("line"))


def consolidate(parts: list[tuple[str, str, DataFrame]]) -> DataFrame:
    """Tables of (sample, rule) under each other; a column that one lacks is null there."""
    whole = None
    for sample, rule, df in parts:
        df = df.select(F.lit(sample).alias("sample"), F.lit(rule).alias("rule"), "*")
        whole = df if whole is None else whole.unionByName(df, allowMissingColumns=True)
    return whole


def assign_chunks(rows: DataFrame, by: str, k: int) -> DataFrame:
    """Contiguous chunks of floor(n/k)+1 rows in an order, without sorting all rows in one task."""
    size = rows.count() // k + 1
    numbered = order.running_sums(rows.withColumn("__one", F.lit(1).cast("long")), by, {"__i": "__one"})
    return numbered.withColumn("chunk_no", F.floor((F.col("__i") - 1) / F.lit(size)).cast("long")).drop("__one", "__i")
