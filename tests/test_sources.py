"""Files written here and read back."""

import gzip
import io
import json

import pyarrow as pa
import pytest

from beadloom.operators import order
from beadloom.sources import bam, fastq, tables

RECORDS = [("@r1 x", "ACGT", "+", "@III"), ("@r2", "", "+r2", ""), ("@r3", "NN", "+", "##")]


def as_text(records):
    return "".join("\n".join(r) + "\n" for r in records)


def test_fastq_plain_and_packed(spark, tmp_path):
    (tmp_path / "a_R1.fastq").write_text(as_text(RECORDS))
    (tmp_path / "b_R1.fq").write_bytes(gzip.compress(as_text(RECORDS[:2]).encode()))  # packed, whatever its name says
    df = fastq.read(spark, str(tmp_path))
    got = sorted((r.file.split("/")[-1], r.rec_no, r.name, r.seq, r.plus, r.qual) for r in df.collect())
    assert got == [("a_R1.fastq", i, *r) for i, r in enumerate(RECORDS)] + [("b_R1.fq", i, *r) for i, r in enumerate(RECORDS[:2])]


def test_fastq_cut_short(spark, tmp_path):
    (tmp_path / "a.fastq").write_text("@r\nACGT\n+\n")
    with pytest.raises(Exception, match="cut short"):
        fastq.read(spark, str(tmp_path / "a.fastq")).collect()


def test_fastq_written(spark, tmp_path):
    (tmp_path / "a.fastq").write_text(as_text(RECORDS))
    df = fastq.read(spark, str(tmp_path / "a.fastq"))
    df.write.format("fastq").mode("append").save(str(tmp_path / "out"))
    back = fastq.read(spark, str(tmp_path / "out"))
    assert sorted((r.name, r.seq, r.qual) for r in back.collect()) == sorted((n, s, q) for n, s, _, q in RECORDS)


def test_discovery(spark, tmp_path):
    for n in ("s1_R1.fastq.gz", "s1_R2.fq", "sub/s1_R1.fastq", "s2_R1xfastq", "x.txt"):
        (tmp_path / n).parent.mkdir(exist_ok=True)
        (tmp_path / n).write_text("x")
    got = {(r.sample, r.read): r.paths.count(",") + 1 for r in fastq.discover(spark, str(tmp_path)).collect()}
    assert got == {("s1", "R1"): 2, ("s1", "R2"): 1}


def test_bam_round_trip(spark, tmp_path):
    rows = [("f", i, f"q{i}", 4 if i % 7 == 0 else 16 * (i % 2), None if i % 7 == 0 else "chr1", None if i % 7 == 0 else i * 10, None if i % 7 == 0 else i * 10 + 6, "*" if i % 7 == 0 else "2S3M1D2M", "ACGTACN"[: 7], "IIIIIII", {"RG": f"L{i % 3}"}) for i in range(3000)]
    df = spark.createDataFrame(rows, bam.SCHEMA).repartition(2)
    assert sum(r.records for r in bam.write(df, str(tmp_path / "out"), [("chr1", 1000000)], ["L0"]).collect()) == 3000
    back = bam.read(spark, str(tmp_path / "out"))
    assert back.select("file").distinct().count() == 2
    key = lambda r: (r.qname, r.flag, r.ref_name, r.ref_start, r.ref_end, r.cigar, r.seq, r.qual, tuple(sorted(r.tags.items())))
    assert sorted(map(key, back.collect()), key=str) == sorted(map(key, df.collect()), key=str)


def test_small_tables(spark, tmp_path):
    (tmp_path / "c.txt").write_text("READ1 = DPM\nREAD2 = Y\n\nODD\tO1\tACGT\t2\n# note\nbad line\nY\tY1\tAC\t0\n")
    assert [(r.type, r.name, r.tag, r.tolerance) for r in tables.tag_config(spark, str(tmp_path / "c.txt")).orderBy("ord").collect()] == [("ODD", "O1", "ACGT", 2), ("Y", "Y1", "AC", 0)]
    (tmp_path / "m.json").write_text(json.dumps({"s": {"R1": ["a", "b"], "R2": ["c"]}}))
    assert tables.manifest(spark, str(tmp_path / "m.json")).count() == 3
    (tmp_path / "r.tsv").write_text("0\tA\tx\n1\tB\n")
    assert {(r.pos, r.name) for r in tables.rounds(spark, str(tmp_path / "r.tsv")).collect()} == {(0, "A"), (1, "B")}


def test_manifest_chunks(spark):
    df = spark.createDataFrame([("s", "R1", f"f{i}") for i in range(5)] + [("t", "R1", "g")], "sample string, read string, path string")
    got = {r.path: r.chunk for r in fastq.split_manifest(df, 2).collect()}
    assert got == {"f0": 0, "f1": 0, "f2": 1, "f3": 1, "f4": 1, "g": 1}  # round(2.5) and round(0.5) go to even


def test_packed_writer(spark, tmp_path):
    df = spark.createDataFrame(RECORDS, "name string, seq string, plus string, qual string").coalesce(1)
    fastq.write(df, str(tmp_path / "out"), packed=True)
    (name,) = [p.name for p in (tmp_path / "out").iterdir() if p.suffix == ".gz"]
    assert gzip.decompress((tmp_path / "out" / name).read_bytes()).decode() == as_text([(n, s, "+" if p == "+" else p, q) for n, s, p, q in RECORDS])
    assert [r.name for r in fastq.read(spark, str(tmp_path / "out")).orderBy("rec_no").collect()] == [r[0] for r in RECORDS]


def alignments(spark, n):
    return spark.createDataFrame([("f", i, f"q{i // 2}", 64 if i % 2 else 128, "chr1", i, i + 4, "4M", "ACGT", "", {"XX": "1"}, "hot" if i % 10 else f"L/{i % 3}") for i in range(n)], bam.SCHEMA + ", label string")


def test_bam_by_label(spark, tmp_path):
    out = str(tmp_path / "out")
    files = bam.write_by(alignments(spark, 2000).repartition(3), out, [("chr1", 10000)], "label", files=4).collect()
    assert sum(r.records for r in files) == 2000 and 2 <= sum(r.folder == "label=hot" for r in files) <= 4
    back = bam.read(spark, out).collect()
    assert {(r.tags["RG"], r.file.split("label=")[1].split("/")[0].replace("=2F", "/")) for r in back} == {(x, x) for x in ("hot", "L/0", "L/1", "L/2")}
    assert len(back) == 2000 and all(r.tags["XX"] == "1" for r in back)
    by = {}
    for r in back:
        by.setdefault((r.qname, r.tags["RG"]), set()).add(r.file)
    assert all(len(v) == 1 for v in by.values())


def test_files_of_lost_tasks_stay_hidden(spark, tmp_path):
    """A task that ran twice has written two files; only the one that the driver was told of is read."""
    out = tmp_path / "out"
    bam.write(alignments(spark, 10).drop("label").coalesce(1), str(out), [("chr1", 100)])
    (out / ".part-again.bam").write_bytes(next(out.glob("part-*.bam")).read_bytes())
    assert bam.read(spark, str(out)).count() == 10


def test_settings_and_cluster_files(spark, tmp_path):
    (tmp_path / "c.yaml").write_text("# all\nassembly: \"mm10\"\nmax_size: 13   # reads\nempty:\nlist:\n  - a\nurl: http://x:1/y\n")
    assert {r.key: r.value for r in tables.settings(spark, str(tmp_path / "c.yaml")).collect()} == {"assembly": "mm10", "max_size": "13", "empty": "", "list[0]": "a", "url": "http://x:1/y"}
    p = spark.createDataFrame([(b, "RPM", "+", "chr1", i, i + 9) for b, n in (("a.b", 20000), ("c", 1)) for i in range(n)], "barcode string, read_type string, feature string, chrom string, start_pos int, end_pos int")
    assert sum(r.lines for r in tables.write_clusters(p, str(tmp_path / "k")).collect()) == 2
    assert tables.read_clusters(spark, str(tmp_path / "k")).groupBy("barcode").count().orderBy("barcode").collect() == [("a.b", 20000), ("c", 1)]


def test_values_get_few_files(spark, tmp_path):
    rows = spark.range(4000).selectExpr("id", "CASE WHEN id % 10 = 0 THEN 'b' ELSE 'a' END AS label").repartition(8)
    tables.write_by(rows, str(tmp_path / "w"), "label", files=2)
    assert all(1 <= len(list((tmp_path / "w" / f"label={x}").glob("*.parquet"))) <= 2 for x in "ab") and spark.read.parquet(str(tmp_path / "w")).count() == 4000


TRICKY = [("@a", "@+@+", "+", "@@@@"), ("@+", "+", "+@", "@"), ("@", "", "+", ""), ("@@", "@", "+", "+"), ("@x", "+A", "+x", "@+")] * 3


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_fastq_cut_at_every_offset(spark, tmp_path, end):
    """Lines of all kinds begin with @ or +, so only the number of a line tells what it is."""
    text = "".join(end.join(r) + end for r in TRICKY)
    for name, data in (("whole", text), ("open", text[: -len(end)])):
        (tmp_path / f"{name}.fastq").write_bytes(data.encode())
    want = sorted((n, i, *r) for n in ("whole.fastq", "open.fastq") for i, r in enumerate(TRICKY))
    rows = lambda df: sorted((r.file.split("/")[-1], r.rec_no, r.name, r.seq, r.plus, r.qual) for r in df.collect())
    for size in (1, 7, 10_000):
        assert rows(fastq.read(spark, str(tmp_path), split_bytes=size)) == want
    # each cut of a file in two, without Spark
    path = str(tmp_path / "open.fastq")
    size = (tmp_path / "open.fastq").stat().st_size
    for cut in range(1, size):
        ranges = [{"file": path, "start": a, "stop": b, "size": size} for a, b in ((0, cut), (cut, size))]
        counted = [b.to_pylist()[0] for b in fastq._count([pa.RecordBatch.from_pylist(ranges)])]
        total = sum(r["lines"] for r in counted)
        parts = [r | {"before": b, "total": total} for r, b in zip(counted, (0, counted[0]["lines"]))]
        got = [tuple(r.values())[1:] for b in fastq._read_ranges([pa.RecordBatch.from_pylist(parts)]) for r in b.to_pylist()]
        assert got == [(i, *r) for i, r in enumerate(TRICKY)], cut
    assert fastq.read(spark, path, split_bytes=9).rdd.getNumPartitions() > 8


def test_small_fastq_ranges_share_tasks(spark, tmp_path):
    """The number of tasks goes by bytes and cores; a range reads little more than its own bytes."""
    records = [(f"@r{i}", "ACGT" * (i % 9), "+", "@+II" * (i % 9)) for i in range(3000)]
    (tmp_path / "a.fastq").write_text(as_text(records))
    df = fastq.read(spark, str(tmp_path), split_bytes=100)
    assert (tmp_path / "a.fastq").stat().st_size > 100 * 1000 and df.rdd.getNumPartitions() <= 2 * spark.sparkContext.defaultParallelism
    assert sorted((r.rec_no, r.name, r.seq, r.plus, r.qual) for r in df.collect()) == [(i, *r) for i, r in enumerate(records)]

    class Counted(io.BytesIO):
        taken = 0

        def read(self, n=-1):
            data = super().read(n)
            self.taken += len(data)
            return data

    f = Counted(as_text(records).encode())
    got = [r for b in fastq.parse(f, "a", 0, 0, 50, 2000) for r in b.to_pylist()]
    assert [r["name"] for r in got] == [r[0] for r in records[:50]] and f.taken < 10_000
    long = [("@x", "A" * 50_000, "+", "I" * 50_000)]  # over many reads
    assert [b.to_pylist()[0]["seq"] for b in fastq.parse(Counted(as_text(long).encode()), "a", first_read=10)] == [long[0][1]]


@pytest.mark.parametrize(("text", "message"), [("@r\nACGT\n+\n", "cut short"), ("@r\nA\n+\nI\n\n", "cut short"), ("@r\nA\n+\nI\n@s\nAC\n+\nI\n", "record 1 is malformed"), ("r\nA\n+\nI\n", "malformed"), ("@r\nA\n-\nI\n", "malformed")])
def test_fastq_errors(spark, tmp_path, text, message):
    (tmp_path / "a.fastq").write_text(text)
    for read in (lambda: fastq.read(spark, str(tmp_path), split_bytes=3), lambda: spark.read.format("fastq").load(str(tmp_path))):
        spark.dataSource.register(fastq.FastqSource)
        with pytest.raises(Exception, match=message):
            read().collect()


def test_fastq_without_records(spark, tmp_path):
    (tmp_path / "a.fastq").write_text("")
    (tmp_path / "b.fastq.gz").write_bytes(gzip.compress(b""))
    assert fastq.read(spark, str(tmp_path)).count() == 0


def test_running_sums_over_texts(spark):
    rows = spark.createDataFrame([(f"{i * 7919 % 5000:05}", "ab"[i % 10 == 0], 1) for i in range(5000)], "k string, g string, n long")
    got = order.running_sums(rows, "k", {"s": "n"}, ["g"], 6).collect()
    for g in "ab":
        mine = sorted((r.k, r.s) for r in got if r.g == g)
        assert [s for _, s in mine] == list(range(1, len(mine) + 1))


YAML = """# head
a: 1
b:
  - x: "q: #1"   # a comment
    y: [1, {k: v, e: }, 'it''s, ok']
  - plain text # more
  -
    deep: {m: [], n: z}
list:
- one
- - inner
  - 'two'
url: http://h:80/p#frag
"quoted key": -5
none:
last:
    nested:
        value: end
"""


def test_nested_settings(spark, tmp_path):
    (tmp_path / "c.yaml").write_text(YAML)
    got = dict(tuple(r) for r in tables.settings(spark, str(tmp_path / "c.yaml")).collect())
    assert got == {
        "a": "1", "b[0].x": "q: #1", "b[0].y[0]": "1", "b[0].y[1].k": "v", "b[0].y[1].e": "", "b[0].y[2]": "it's, ok", "b[1]": "plain text", "b[2].deep.n": "z", "list[0]": "one", "list[1][0]": "inner", "list[1][1]": "two",
        "url": "http://h:80/p#frag", "quoted key": "-5", "none": "", "last.nested.value": "end",
    }
    assert tables.yaml_scalars("") == tables.yaml_scalars("# x\n\n---\n") == []
    for bad in ("a: 1\n  b: 2\n c: 3", "just text", "a: [1, 2", "a: 1\n- b"):
        with pytest.raises(ValueError, match="can't read"):
            tables.yaml_scalars(bad)


def test_named_files(spark, tmp_path):
    rows = [(f, *r) for f in ("s_R1.fq.gz", "s_R2.fq") for r in RECORDS]
    found = fastq.write_named(spark.createDataFrame(rows, "file string, name string, seq string, plus string, qual string"), str(tmp_path / "n"), "file")
    assert sorted(tuple(r) for r in found.collect()) == [("s_R1.fq.gz", 3), ("s_R2.fq", 3)]
    assert sorted(p.name for p in (tmp_path / "n").iterdir() if p.name[0] != ".") == ["s_R1.fq.gz", "s_R2.fq"]
    assert gzip.decompress((tmp_path / "n/s_R1.fq.gz").read_bytes()) == (tmp_path / "n/s_R2.fq").read_bytes() == as_text(RECORDS).encode()
