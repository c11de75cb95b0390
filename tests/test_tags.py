"""Tag lookup: counts of neighbourhoods, and the join form against a walk over each read."""

import random
from math import comb

import pytest
from pyspark.sql import functions as F

from beadloom.operators import tags

BASES = "ACGT"


@pytest.mark.parametrize("length,k", [(8, 1), (9, 2)])
def test_ball_size(spark, length, k):
    df = spark.createDataFrame([(0, "T", "ACGTACGTA"[:length])], "ord int, name string, tag string")
    assert tags.hamming_ball(df, k).count() == sum(comb(length, i) * 3**i for i in range(k + 1))


def walk(seq, layout, y, near, sizes, spacer, span, laxity):
    """The layout over one read, step by step."""
    parts = layout.split("|")
    at, found = 0, []
    for p in parts:
        if p == "SPACER":
            at += spacer
        elif p == "Y":
            for n in sizes:
                if at + n <= len(seq) and seq[at : at + n] in y:
                    found.append(y[seq[at : at + n]])
                    at += n
                    break
            else:
                found.append("NOT_FOUND")
                at += sizes[-1]
        else:
            hit = None
            for o in range(laxity + 1):
                for n in sizes:
                    if at + o + n > len(seq):
                        hit = "NOT_FOUND"
                        break
                    if seq[at + o : at + o + n] in near:
                        hit = near[seq[at + o : at + o + n]]
                        break
                if hit:
                    break
            found.append(hit or "NOT_FOUND")
            at += span
        if len(seq) - at < span:
            break
    return found + ["NOT_FOUND"] * (sum(p != "SPACER" for p in parts) - len(found))


def test_layout_equals_walk(spark):
    rng = random.Random(4)
    word = lambda n: "".join(rng.choice(BASES) for _ in range(n))
    table = [(i, f"T{i}", word(5 if i % 2 else 6)) for i in range(60)]
    reads = [(i, word(rng.randint(4, 70))) for i in range(1500)]
    t = spark.createDataFrame(table, "ord int, name string, tag string")
    r = spark.createDataFrame(reads, "rec_no int, seq string")
    layout = "Y|SPACER|ODD|SPACER|ODD"
    got = {x.rec_no: x.barcode for x in tags.walk_layout(r, layout, {"Y": tags.exact(t), "ODD": tags.nearest(tags.hamming_ball(t))}, {"Y": [5, 6], "ODD": [5, 6]}).collect()}
    y, near = {}, {}
    for _, name, tag in table:
        y[tag] = name
        for i in range(len(tag)):
            for c in BASES:
                near[tag[:i] + c + tag[i + 1 :]] = name  # the last row wins
    assert got == {i: walk(s, layout, y, near, [5, 6], 7, 17, 6) for i, s in reads}


def test_lookup_is_an_equality_join(spark):
    t = spark.createDataFrame([(0, "T", "ACGTAC")], "ord int, name string, tag string")
    r = spark.createDataFrame([(0, 0, "ACGTACGT", 0)], "rec_no int, slot int, seq string, start int")
    plan = tags.lookup_window(r, tags.nearest(tags.hamming_ball(t)), [6])._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_ambiguous(spark):
    t = spark.createDataFrame([(0, "A", "AAAA"), (1, "B", "AACC")], "ord int, name string, tag string")
    assert {r.neighbour for r in tags.ambiguous(tags.hamming_ball(t)).collect()} == {"AACA", "AAAC"}
    assert {r.name for r in tags.nearest(tags.hamming_ball(t)).filter(F.col("neighbour") == "AACA").collect()} == {"B"}
    assert {r.name for r in tags.nearest(tags.hamming_ball(t), last_wins=False).filter(F.col("neighbour") == "AACA").collect()} == {"A"}


def test_tolerance_per_tag(spark):
    t = spark.createDataFrame([(0, "a", "AAAA", 0), (1, "b", "CCCC", 1), (2, "c", "GGGG", 2)], "ord int, name string, tag string, tolerance int")
    got = {}
    for r in tags.hamming_ball(t, 2, tolerance="tolerance").collect():
        got.setdefault(r.name, set()).add(r.neighbour)
    assert {k: len(v) for k, v in got.items()} == {"a": 1, "b": 13, "c": 1 + 12 + 54}


def test_identify_is_one_pass(spark, sf_dir):
    """One scan of the reads and one shuffle of them, whatever the number of slots and lengths."""
    import re

    from beadloom.plans.queries import QUERIES

    df = QUERIES["identify"](spark, sf_dir)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert len(re.findall(r"FileScan parquet .*orders.parquet", plan)) == 1
    # tags shuffle for their tables; of the reads' records one shuffle
    assert len(re.findall(r"hashpartitioning\(rec_no", plan)) == 1


def test_identify_without_beads_or_short_reads(spark):
    config = spark.createDataFrame([("Y", "Y1", "ACG", 0, 0), ("ODD", "O1", "TTTTT", 1, 1)], "type string, name string, tag string, tolerance int, ord int")
    pairs = spark.createDataFrame([(1, "@a x", "A", "@a y", "ACG" + "C" * 7 + "TTTAT" + "G" * 17), (2, "@b", "", "@b", "ACG")], "rec_no int, name1 string, seq1 string, name2 string, seq2 string")
    got = {r.rec_no: (r.name1, r.barcode) for r in tags.identify(pairs, config, "DPM", "Y|SPACER|ODD").collect()}
    assert got == {1: ("@a::[NOT_FOUND][Y1][O1]", ["NOT_FOUND", "Y1", "O1"]), 2: ("@b::[NOT_FOUND][Y1][NOT_FOUND]", ["NOT_FOUND", "Y1", "NOT_FOUND"])}
