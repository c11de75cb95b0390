"""Small cases of clusters, labels, reads and distributions, worked out by hand."""

from pyspark.sql import functions as F

from beadloom.functions import names
from beadloom.operators import clusters, genome, qc, reads
from beadloom.plans.adapters import view

SCHEMA = "barcode string, read_type string, feature string, chrom string, start_pos int, end_pos int, library string, chunk int, ord1 int, ord2 int, ord3 int, ord4 int"


def positions(spark, rows):
    return spark.createDataFrame([(b, t, f, c, s, e, "E", i % 3, i, 1, 0, 0) for i, (b, t, f, c, s, e) in enumerate(rows)], SCHEMA)


def test_label_precedence(spark):
    rows = [("none", "RPM", "+", "chr1", 1, 2)]
    rows += [("big", "BPM", "", "L1", i, 0) for i in range(9)] + [("big", "RPM", "+", "chr1", i, i + 1) for i in range(14)]
    rows += [("few", "BPM", "", "L1", 1, 0)]
    rows += [("mixed", "BPM", "", "L1", i, 0) for i in range(2)] + [("mixed", "BPM", "", "L2", i, 0) for i in range(2)]
    rows += [("good", "BPM", "", "L2", i, 0) for i in range(3)] + [("good", "BPM", "", "L1", 1, 0)]
    got = {r.barcode: r.label for r in clusters.label(positions(spark, rows)).collect()}
    assert got == {"none": "none", "big": "filtered", "few": "uncertain", "mixed": "ambiguous", "good": "L2"}
    tie = clusters.label(positions(spark, rows), proportion=0.5)
    assert {r.label for r in tie.filter("barcode = 'mixed'").collect()} == {"L1"}


def test_strand_is_no_part_of_a_position(spark):
    p = positions(spark, [("a", "RPM", "-", "chr1", 1, 5), ("a", "RPM", "+", "chr1", 1, 5), ("a", "RPM", "+", "chr1", 1, 6), ("a", "XXX", "+", "chr1", 1, 6)])
    assert sorted((r.feature, r.end_pos) for r in clusters.build(p).collect()) == [("+", 6), ("-", 5)]


def test_merging_chunks_is_building_the_whole(spark, sf_dir):
    p = view(spark, sf_dir, "positions_v")
    whole = clusters.build(p)
    merged = clusters.merge(*[clusters.build(p.filter(F.col("chunk") == c)) for c in range(4)])
    assert whole.exceptAll(merged.select(whole.columns)).isEmpty() and whole.count() == merged.count()
    assert clusters.build(whole).count() == whole.count()


def test_text_round_trip(spark, sf_dir):
    built = clusters.build(view(spark, sf_dir, "positions_v")).select("barcode", "read_type", "feature", "chrom", "start_pos", "end_pos")
    back = clusters.parse(clusters.render(built))
    assert back.exceptAll(built).isEmpty() and back.count() == built.count()


def test_every_read_has_one_fate(spark, sf_dir):
    p = view(spark, sf_dir, "positions_v")
    rows = reads.label_reads(reads.aligned(p), clusters.label(clusters.build(p)))
    fates = {r.fate: r.n for r in rows.groupBy("fate").agg(F.count("*").alias("n")).collect()}
    assert sum(fates.values()) == reads.aligned(p).count() and set(fates) <= {"written", "duplicate", "skipped"}


def test_bins(spark):
    values = [0, 1, 2, 5, 6, 10, 11, 200, 201]
    df = spark.createDataFrame([(v,) for v in values], "v int")
    assert [r[0] for r in df.orderBy("v").select(names.right_bin(F.col("v"), qc.SIZE_EDGES)).collect()] == [0, 1, 2, 2, 3, 3, 4, 7, 8]
    assert [r[0] for r in df.orderBy("v").select(names.left_bin(F.col("v"), qc.LEFT_EDGES)).collect()] == [1, 2, 3, 4, 4, 5, 5, 8, 8]


def test_umi_code(spark):
    df = spark.createDataFrame([("ACGTNACG",), ("acgtacgt",), ("",), ("NA",)], "s string")
    assert [r[0] for r in df.select(names.umi_code(F.col("s"))).collect()] == [12340123, 0, 0, 1]


def test_quality_trim(spark):
    # the classic example: qualities with a bad tail
    df = spark.createDataFrame([("ACGTACGT", "IIIII###"), ("ACGT", "####"), ("ACGT", "IIII"), ("ACGTA", "II#I#")], "seq string, qual string")
    assert [r.seq for r in reads.quality_trim(df, 20).collect()] == ["ACGTA", "", "ACGT", "ACGT"]


def test_pairs_and_trim(spark):
    df = spark.createDataFrame([(1, "a", "AAAATTTTGGGG"), (2, "b", "CC")], "rec_no int, name string, seq string")
    assert [r.seq for r in reads.trim(df, ["TTTT", "GGG"], 3).collect()] == ["AAAA"]
    assert reads.pair_mates(df, df.filter("rec_no = 2")).count() == 1
    assert [r.name for r in reads.paired_only(df.union(df.limit(1))).select("name").distinct().collect()] == ["a"]


def test_front_and_pair_adapters(spark):
    df = spark.createDataFrame([("AAGGTGGTCTTTCCC",), ("GCCTCTTGTTGGTGGTCTTTA",), ("ACGT",)], "seq string")
    assert [r.seq for r in reads.trim_front(df, reads.BEAD_ADAPTERS).collect()] == ["CCC", "GGTGGTCTTTA", "ACGT"]
    pairs = spark.createDataFrame([("A" * 20 + reads.ADAPTER_1, "C" * 25), ("A" * 30, "C" * 30 + reads.ADAPTER_2 + "G"), ("A" * 30, "T" * 9 + reads.ADAPTER_2 + "G" * 21)], "seq1 string, seq2 string")
    # the adapter of mate 2 stands in front: what is before it goes, too
    assert [(r.seq1, r.seq2) for r in reads.trim_pairs(pairs).collect()] == [("A" * 20, "C" * 25), ("A" * 30, "G" * 21)]
    near = spark.createDataFrame([("A" * 20 + "T" + reads.ADAPTER_1[1:], "T" * 9 + reads.ADAPTER_2[:-1] + "C" + "G" * 21)], "seq1 string, seq2 string")
    assert [len(r.seq1) for r in reads.trim_pairs(near).collect()] == [38] and [(len(r.seq1), r.seq2) for r in reads.trim_pairs(near, errors=1).collect()] == [(20, "G" * 21)]


def test_genome_bins_invert(spark):
    t = genome.assembly(spark, "mm10")
    rows = spark.createDataFrame([("chr1", 5), ("chr2", 2_500_000), ("chrM", 3), ("odd", 1)], "chrom string, start_pos int")
    found = genome.bin_index(rows, t, 1_000_000)
    assert {(r.chrom, r.bin) for r in found.filter("chrom <> 'chrM'").collect()} == {("chr1", 0), ("chr2", 198), ("odd", None)}
    back = genome.bin_position(found.filter("bin IS NOT NULL").select("bin", F.col("chrom").alias("was")), "mm10", 1_000_000)
    assert back.filter("chrom <> was").isEmpty()


def test_error_blocks_per_file(spark):
    lines = ["x", "Error in rule a:", "    jobid: 1", "    jobid: 2", "", "    log: late", "Error in rule b:", "    log: l.txt", "Finished job 1.", "Error in rule c:"]
    df = spark.createDataFrame([(f, i, x) for f in "pq" for i, x in enumerate(lines)], "file string, line_no int, line string")
    got = sorted((r.file, r.rule, r.jobid, r.log) for r in qc.error_blocks(df, ["file"]).collect())
    assert got == sorted((f, *x) for f in "pq" for x in [("a", "2", None), ("b", None, "l.txt"), ("c", None, None)])


def test_long_log_over_ranges(spark):
    """A log cut into many ranges of lines gives the blocks of a plain walk, with one file and with several."""
    import random

    rng = random.Random(5)
    kinds = ["x", "", "Error in rule r{}:", "    jobid: {}", "    log: l{}.txt (see)", "Finished job {}.", "jobid: {} log: m.txt"]
    lines = [rng.choice(kinds).format(i) for i in range(3000)]

    def walk(rows):
        out, now = [], None
        for line in rows:
            if line.startswith("Error in rule"):
                now = [line[14:-1], None, None]
                out.append(now)
            elif now is not None and "jobid:" in line:
                now[1] = line.split("jobid: ")[1].split()[0]
            elif now is not None and "log:" in line:
                now[2] = line.split("log: ")[1].split(" ")[0]
            elif now is not None and (not line.strip() or "Finished job" in line):
                now = None
        return sorted(map(tuple, out), key=str)

    df = spark.createDataFrame([(f, i, x) for f in "pq" for i, x in enumerate(lines if f == "p" else lines[::-1])], "file string, line_no int, line string").repartition(4)
    got = {f: sorted(((r.rule, r.jobid, r.log) for r in qc.error_blocks(df, ["file"]).filter(F.col("file") == f).collect()), key=str) for f in "pq"}
    assert got == {"p": walk(lines), "q": walk(lines[::-1])}
    assert sorted(((r.rule, r.jobid, r.log) for r in qc.error_blocks(df.filter("file = 'p'")).collect()), key=str) == walk(lines)


def test_molecule_totals_without_lists(spark, sf_dir):
    from beadloom.plans.queries import _umis

    u = _umis(view(spark, sf_dir, "positions_v"))
    with_list = qc.umi_duplication(u)
    assert qc.umi_totals(u).exceptAll(with_list.drop("umi_counts")).isEmpty()
    assert qc.umi_counts(u).count() == with_list.agg(F.sum("unique_umis")).first()[0]
