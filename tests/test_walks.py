"""Layouts on both mates, and adapters with errors, against plain loops over single reads."""

import random

import numpy as np
import pyarrow as pa
import pytest

from beadloom.functions import alignment, walking
from beadloom.operators import reads, tags
from beadloom.sources import tables


def mismatches(a, b):
    return sum(x != y for x, y in zip(a, b))


def walk_by_hand(seq, parts, config, spacer, laxity):
    """config: (kind, name, tag, tolerance) in order."""
    at, out = 0, []
    for i, part in enumerate(parts):
        if part == "SPACER":
            at = min(at + spacer, len(seq))
            continue
        mine = [c for c in config if c[0] == part]
        sizes = sorted({len(c[2]) for c in mine})
        reach, hit = laxity if i else 0, None
        for o in range(reach + 1):
            for n in sizes:
                w = seq[at + o : at + o + n]
                near = [c for c in mine if len(c[2]) == n == len(w) and mismatches(c[2], w) <= c[3] and set(w) <= set("ACGTN")]
                if near and hit is None:
                    hit = near[-1][1], at + o + n
        out.append(hit[0] if hit else "NOT_FOUND")
        at = hit[1] if hit else min(at + reach + sizes[-1], len(seq))
    return out


def made(seed, n=400):
    rng = random.Random(seed)
    config = [(k, f"{k}{i}", "".join(rng.choice("ACGT") for _ in range(rng.choice(sizes))), tol) for k, sizes, tol in (("DPM", [5], 0), ("Y", [4, 6, 7], 0), ("ODD", [7], 1), ("EVEN", [6, 8], 2), ("RPM", [23], 1)) for i in range(6)]
    config.append(("ODD", "again", config[12][2], 1))  # the same tag under another name: the last counts
    by = {k: [c for c in config if c[0] == k] for k in ("DPM", "Y", "ODD", "EVEN", "RPM")}

    def read(parts):
        out = ""
        for p in parts:
            tag = "".join(rng.choice("ACGT") for _ in range(5)) if p == "SPACER" else rng.choice(by[p])[2]
            if p in ("ODD", "EVEN") and rng.random() < 0.4:
                k = rng.randrange(len(tag))
                tag = tag[:k] + rng.choice("ACGTN.") + tag[k + 1 :]
            out += tag + "".join(rng.choice("ACGT") for _ in range(rng.choice([0, 0, 0, 1, 3])))
        return out[: rng.choice([len(out), len(out) + 9, rng.randrange(len(out) + 1)])]

    return config, read


LAYOUTS = [(("DPM", "SPACER", "ODD"), ("Y", "SPACER", "ODD", "EVEN")), (("EVEN",), ("SPACER", "ODD", "SPACER", "EVEN", "RPM")), (("RPM", "ODD", "ODD"), ("SPACER",))]


@pytest.mark.parametrize("layout", LAYOUTS)
def test_any_layout_against_a_walk_per_read(spark, layout):
    config, read = made(1)
    seqs = [(i, read(layout[0]), read(layout[1])) for i in range(400)] + [(900, "", "A"), (901, None, None)]
    pairs = spark.createDataFrame([(i, f"@r{i} x", a, f"@r{i} y", b, "more") for i, a, b in seqs], "rec_no long, name1 string, seq1 string, name2 string, seq2 string, extra string")
    table = spark.createDataFrame([(*c, i) for i, c in enumerate(config)], "type string, name string, tag string, tolerance int, ord int")
    given = tags.Layout(*layout, spacer=5, laxity=4)
    want = {i: walk_by_hand(a or "", layout[0], config, 5, 4) + walk_by_hand(b or "", layout[1], config, 5, 4) for i, a, b in seqs}
    found = tags.identify_any_layout(pairs, table, given)
    got = found.collect()
    assert found.columns == [*pairs.columns, "barcode"] and {r.rec_no: r.barcode for r in got} == want
    assert all(r.name1 == f"@r{r.rec_no}::" + "".join(f"[{t}]" for t in want[r.rec_no]) for r in got)
    near, sizes, expected = tags._near_any(table, given.kinds(), 3, "ACGTN")
    assert expected >= sum(n.count() for n in near.values())
    joined = tags.walk_by_joins(pairs.filter("seq1 IS NOT NULL"), near, sizes, given)
    assert {r.rec_no: r.barcode for r in joined.collect()} == {i: w for i, w in want.items() if i != 901}
    assert "Exchange" not in tags.walk_in_tasks(pairs, near, given)._jdf.queryExecution().executedPlan().toString()


def test_unknown_parts_are_errors(spark):
    config, _ = made(2)
    table = spark.createDataFrame([(*c, i) for i, c in enumerate(config)], "type string, name string, tag string, tolerance int, ord int")
    pairs = spark.createDataFrame([(1, "@a", "ACGT", "@a", "ACGT")], "rec_no long, name1 string, seq1 string, name2 string, seq2 string")
    with pytest.raises(ValueError, match="LIGTAG"):
        tags.identify_any_layout(pairs, table, tags.Layout(("DPM",), ("LIGTAG",)))
    for layout1 in ("NONSENSE", "ODD|Y", "SPACER|DPM"):
        with pytest.raises(ValueError, match="part|first"):
            tags.identify(pairs, table, layout1)


def test_identify_walks_other_layouts_of_mate_1(spark):
    config = [("DPM", "D1", "ACGTA", 0), ("Y", "Y1", "CCCC", 0), ("ODD", "O1", "GGTTAAC", 1), ("EVEN", "E1", "TTGGCCA", 1)]
    table = spark.createDataFrame([(*c, i) for i, c in enumerate(config)], "type string, name string, tag string, tolerance int, ord int")
    one, two = "ACGTA" + "CACACAC" + "GGTTAAC" + "T" * 12, "CCCC" + "A" * 7 + "GGTTAAC" + "A" * 17 + "TTGGCCA" + "A" * 12
    pairs = spark.createDataFrame([(1, "@a b", one, "@a c", two), (2, "@c", "T" * 40, "@c", "A" * 60)], "rec_no long, name1 string, seq1 string, name2 string, seq2 string")
    got = {r.rec_no: r for r in tags.identify(pairs, table, "DPM|SPACER|ODD").collect()}
    assert got[1].barcode == ["D1", "O1", "Y1", "O1", "E1"] and got[1].name2 == "@a::[D1][O1][Y1][O1][E1]"
    assert got[2].barcode == ["NOT_FOUND"] * 5 and got[1].seq1 == one
    assert {r.rec_no: r.barcode for r in tags.identify(pairs, table, "DPM").collect()}[1] == ["D1", "Y1", "O1", "E1"]


def test_layout_lines(spark, tmp_path):
    (tmp_path / "c").write_text("# head\nREAD1 = DPM\nREAD2 = Y | SPACER|ODD\nLAXITY = 3\nODD\tO1\tACGT\t1\n")
    assert tables.layout(spark, str(tmp_path / "c")) == tags.Layout(("DPM",), ("Y", "SPACER", "ODD"), 6, 3)
    for text, message in (("READ1 = DPM\n", "READ2"), ("READ1 = DPM\nREAD2 = Y||ODD\n", "empty"), ("READ1 = A\nREAD2 = B\nSPACER = x\n", "invalid literal")):
        (tmp_path / "d").write_text(text)
        with pytest.raises(ValueError, match=message):
            tables.layout(spark, str(tmp_path / "d"))


def test_long_tags_have_letters_for_keys():
    k = walking.Kind.build(["ACGTA" * 5, "A" * 25], np.array([3, 4]))
    got = walking.walk(pa.array(["ACGTA" * 5, "A" * 26, "C" * 30, None]), ("K",), {"K": k}, 6, 6)
    assert got.tolist() == [[3, 4, -1, -1]]


# adapters


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return row


def cut_by_hand(seq, adapter, rate, overlap):
    """Where a 3' adapter begins: every start, every part of the adapter, whole distances."""
    best, found = 0, len(seq)
    for s in range(len(seq)):
        options = []
        for n in range(len(adapter) + 1):
            row = edits(adapter[:n], seq[s:])
            options.append((row[-1] if n < len(adapter) else min(row), -n))
        errors, n = min(options)
        n = -n
        if n >= overlap and errors <= int(rate * n + 1e-9) and n - errors > best:
            best, found = n - errors, s
    return best, found


@pytest.mark.parametrize(("rate", "overlap"), [(0.1, 3), (0.2, 1), (0.0, 5), (0.34, 4)])
def test_alignment_by_whole_distances(rate, overlap):
    rng = random.Random(5)
    adapter = "ACGTTGCATC"
    seqs = ["", "A", adapter, adapter[:4], "T" + adapter[:9]]
    for _ in range(250):
        a = list(adapter[: rng.choice([10, 10, 3, 6, 8])])
        for _ in range(rng.choice([0, 1, 1, 2])):
            i = rng.randrange(len(a) or 1)
            a[i : i + rng.choice([0, 1])] = rng.choice(["", "A", "CG", "T"])
        seqs.append("".join(rng.choice("ACGT") for _ in range(rng.randrange(12))) + "".join(a) + "".join(rng.choice("ACGT") for _ in range(rng.choice([0, 0, 4]))))
    want = [cut_by_hand(s, adapter, rate, overlap) for s in seqs]
    assert alignment.cuts(pa.array(seqs), [adapter], True, rate, overlap).tolist() == [w for _, w in want]
    # a 5' adapter is the mirror, but for ties: there the leftmost end counts
    back = [s[::-1] for s in seqs]
    scores, _ = alignment.place(*alignment.letters(pa.array(back), False), adapter[::-1], rate, overlap, False)
    assert scores.tolist() == [b for b, _ in want]


def test_adapters_cut_off_and_with_errors(spark):
    one, two = reads.ADAPTER_1, reads.ADAPTER_2
    body = "ACCGGTTTACCAGGATTTACCGGA"
    rows = [
        (1, body + one + "GG", two + body, body, body), (2, body + one[:7], two[9:] + body, body, body), (3, body + one[:9] + one[10:], two[:5] + "A" + two[5:] + body, body, body),
        (4, body, body, body, body), (5, body + one[:2], two[16:] + body, body + one[:2], two[16:] + body), (6, one, body, None, None), (7, None, body, None, None),
    ]
    pairs = spark.createDataFrame([(i, a, b, a and "".join(chr(40 + k % 30) for k in range(len(a)))) for i, a, b, _, _ in rows], "rec_no int, seq1 string, seq2 string, qual1 string")
    got = {r.rec_no: r for r in reads.trim_aligned(pairs).collect()}
    assert {i: (r.seq1, r.seq2) for i, r in got.items()} == {i: (a, b) for i, _, _, a, b in rows if a}
    assert all(len(r.qual1) == len(r.seq1) for r in got.values())
    fronts = spark.createDataFrame([(i, s) for i, s in enumerate(["AAGGTGGTCTTTCCC", "GCCTCTGTTCCC", "TTTCCC", "CTTTCCC", "ACGACG", None])], "rec_no int, seq string")
    assert {r.rec_no: r.seq for r in reads.trim_front_aligned(fronts).collect()} == {0: "CCC", 1: "CCC", 2: "CCC", 3: "CCC", 4: "ACGACG"}
    assert "Exchange" not in reads.trim_aligned(pairs)._jdf.queryExecution().executedPlan().toString()
