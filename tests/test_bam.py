"""BAM files cut anywhere, read by region, and kept as they are: header, types of tags, mates."""

import io
import random
import struct
import zlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from beadloom.sources import bam, bam_index, blocks, store
from beadloom.sources.bam_records import ARROW, Header, Short, bins, decode_header, encode

REFS = [("chr1", 1 << 28), ("chr2", 1 << 28), ("45S", 20000)]


def rows(n, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        length = rng.choice([0, 1, 2, 7, 50, 300])
        placed = rng.random() > 0.1
        start = rng.choice([rng.randrange(20000), rng.randrange(1 << 27)]) if placed else None
        tags = {"NM": str(rng.randrange(-9, 9)), "RG": "L1", "ZB": "1,-2,300"} if i % 3 else ({"AS": "1.5", "XA": "c"} if i % 2 else {})
        types = {"NM": "i", "RG": "Z", "ZB": "Bs", "AS": "f", "XA": "A"}
        out.append(
            dict(
                file="f", voffset=i, qname=f"q{i}@" + "x" * rng.randrange(20), flag=0 if placed else 4, ref_name=rng.choice(REFS)[0] if placed else None, ref_start=start, ref_end=start + max(length, 1) if placed else None,
                cigar=f"{length}M" if length and placed else "*", seq="".join(rng.choice("ACGTN") for _ in range(length)), qual="".join(chr(rng.randrange(33, 74)) for _ in range(length)) if i % 4 else "", tags=list(tags.items()),
                mapq=rng.randrange(61), mate_ref="chr2" if placed and i % 2 else None, mate_start=5 if placed and i % 2 else None, insert_size=rng.randrange(-500, 500), tag_types=[(k, types[k]) for k in tags],
            )
        )
    return out


def file_of(data, block_bytes, header=None):
    header = header or Header.build(REFS, ["L1"])
    out = io.BytesIO()
    keep = out.close
    out.close = lambda: None
    w = bam._File(out, header, True, block_bytes)
    w.add(pa.RecordBatch.from_pylist(data, ARROW), {n: i for i, (n, _) in enumerate(header.references)})
    w.close()
    raw = out.getvalue()
    keep()
    return raw, w.index


def plain(batches):
    return [{k: (sorted(v) if isinstance(v, list) else v) for k, v in r.items() if k not in ("file", "voffset")} for b in batches for r in b.to_pylist()]


def expected(data):
    return plain([pa.RecordBatch.from_pylist(data, ARROW)])


@pytest.mark.parametrize(("block_bytes", "n"), [(97, 10), (700, 14), (60000, 12)])
def test_cut_at_every_offset(block_bytes, n):
    data = rows(n)
    raw, _ = file_of(data, block_bytes)
    want = expected(data)
    for cut in range(1, len(raw)):
        got = [list(bam.piece(io.BytesIO(raw), "f", a, b, len(raw))) for a, b in ((0, cut), (cut, len(raw)))]
        assert plain(got[0]) + plain(got[1]) == want, cut
    data = rows(60)
    raw, _ = file_of(data, block_bytes)
    parts = [bam.piece(io.BytesIO(raw), "f", a, min(a + 37, len(raw)), len(raw)) for a in range(0, len(raw), 37)]
    assert [x for p in parts for x in plain(p)] == expected(data)


def test_records_longer_than_pieces():
    data = rows(6) + [dict(rows(1)[0], qname="long", seq="ACGTA" * 40000, qual="", cigar="*")] + rows(6, 2)
    raw, _ = file_of(data, 5000)
    for size in (1000, 9000, 50000):
        parts = [bam.piece(io.BytesIO(raw), "f", a, min(a + size, len(raw)), len(raw)) for a in range(0, len(raw), size)]
        assert [x for p in parts for x in plain(p)] == expected(data)


def test_against_a_plain_parser():
    """Bytes of the format, field by field."""
    data = rows(80, 5)
    raw, _ = file_of(data, 60000)
    body = b"".join(c for _, c in blocks.read(io.BytesIO(raw), 0))
    header, at = decode_header(body, "f")
    assert header.references == tuple(REFS) and header.groups() == ["L1"]
    for r in data:
        (size,) = struct.unpack_from("<i", body, at)
        ref, pos, l_name, mapq, bin_, n_cigar, flag, l_seq, mate, mate_pos, insert = struct.unpack_from("<iiBBHHHiiii", body, at + 4)
        assert (ref, pos, mapq, flag, l_seq) == (-1 if r["ref_name"] is None else [n for n, _ in REFS].index(r["ref_name"]), -1 if r["ref_start"] is None else r["ref_start"], r["mapq"], r["flag"], len(r["seq"]))
        assert body[at + 36 : at + 36 + l_name] == r["qname"].encode() + b"\0" and insert == r["insert_size"]
        seq = body[at + 36 + l_name + 4 * n_cigar :][: (l_seq + 1) // 2]
        assert "".join("=ACMGRSVTWYHKDBN"[b >> 4] + "=ACMGRSVTWYHKDBN"[b & 15] for b in seq)[:l_seq] == r["seq"]
        begin, end = max(pos, -1), (pos + max(1, sum(int(c[:-1]) for c in [r["cigar"]] if c != "*"))) if pos >= 0 else 0
        want = next((((1 << b) - 1) // 7 + (begin >> s) for s, b in ((14, 15), (17, 12), (20, 9), (23, 6), (26, 3)) if begin >> s == end - 1 >> s), 0)
        assert bin_ == want & 0xFFFF
        at += 4 + size
    assert at == len(body)


def test_damage_and_short_files():
    raw, _ = file_of(rows(30), 500)
    at = len(raw) // 2
    with pytest.raises((ValueError, zlib.error)):
        list(bam.piece(io.BytesIO(raw[:at] + bytes([raw[at] ^ 255]) + raw[at + 1 :]), "f", 0, len(raw), len(raw)))
    with pytest.raises(ValueError, match="cut short"):
        list(bam.piece(io.BytesIO(raw[:-40]), "f", 0, len(raw), len(raw) - 40))
    with pytest.raises(ValueError, match="no BAM"):
        decode_header(b"BAM?....", "f")
    with pytest.raises(Short):
        decode_header(b"BAM\1", "f")
    with pytest.raises(KeyError):
        encode(pa.RecordBatch.from_pylist(rows(3), ARROW), {})


def test_regions_of_the_index():
    data = sorted(rows(1500, 3), key=lambda r: ([n for n, _ in REFS].index(r["ref_name"]) if r["ref_name"] else 9, r["ref_start"] or 0))
    raw, index = file_of(data, 800)
    again = bam_index.Index.decode(index.encode(3))
    assert again.unplaced == sum(r["ref_name"] is None for r in data) and again.placed_end == index.placed_end
    header, first = bam.read_header(io.BytesIO(raw), "f")
    rng = random.Random(8)
    for _ in range(60):
        ref, a = rng.randrange(3), rng.choice([rng.randrange(20000), rng.randrange(1 << 27)])
        b = a + rng.choice([1, 100, 5000, 1 << 20])
        got = [x for p, q in again.region(ref, a, b) for x in plain(bam.records(io.BytesIO(raw), header, "f", p, q))]
        touching = [r for r in expected(data) if r["ref_name"] == REFS[ref][0] and r["ref_start"] < b and r["ref_end"] > a]
        assert [r for r in got if r in touching] == touching and len(got) < len(data)
    placed = plain(bam.records(io.BytesIO(raw), header, "f", first, again.placed_end))
    assert placed == [r for r in expected(data) if r["ref_name"]]


def frame(spark, data):
    return spark.createDataFrame([tuple(dict(r[f.name]) if f.name in ("tags", "tag_types") else r[f.name] for f in ARROW) for r in data], f"{bam.SCHEMA}, {bam.MORE}")


def keys(found):
    return sorted(str({k: (sorted(v.items()) if isinstance(v, dict) else v) for k, v in r.asDict().items() if k not in ("file", "voffset")}) for r in found)


def test_one_file_in_many_tasks(spark, tmp_path):
    df = frame(spark, rows(3000))
    bam.write(df.coalesce(1), str(tmp_path / "a"), REFS, ["L1"])
    back = bam.read(spark, str(tmp_path / "a"), split_bytes=30_000)
    assert back.rdd.getNumPartitions() > 4
    assert keys(back.collect()) == keys(df.collect())
    assert back.select("file").distinct().count() == 1 and back.select("voffset").distinct().count() == 3000
    assert back.select("tags").where("tag_types['NM'] = 'i'").count() == df.where("tag_types['NM'] = 'i'").count()


def test_a_region_opens_its_chunks_only(spark, tmp_path):
    df = frame(spark, rows(6000, 4))
    out = tmp_path / "s"
    bam.write_sorted(df, str(out), REFS, files=3, block_bytes=4000)
    assert len(list(out.glob("*.bam"))) == len(list(out.glob("*.bam.bai"))) == 3
    want = df.filter("ref_name = 'chr2' AND ref_start < 9000 AND ref_end > 4000")
    got = bam.fetch(spark, str(out), "chr2", 4000, 9000)
    assert 0 < want.count() < 600 and keys(got.collect()) == keys(want.collect())
    assert keys(bam.read(spark, str(out)).filter("ref_name = 'chr2' AND ref_start < 9000 AND ref_end > 4000").collect()) == keys(want.collect())
    assert keys(bam.fetch(spark, str(out)).collect()) == keys(df.filter("ref_name IS NOT NULL").collect())
    assert bam.fetch(spark, str(out), "chr9").count() == 0
    # damage all blocks that the region has no part in
    spoiled = 0
    for path in out.glob("*.bam"):
        raw = bytearray(path.read_bytes())
        index = bam_index.Index.decode((out / f"{path.name}.bai").read_bytes())
        wanted = index.region(1, 4000, 9000)
        _, first = bam.read_header(io.BytesIO(bytes(raw)), "f")
        for place, _ in list(blocks.read(io.BytesIO(bytes(raw)), 0)):
            if place > first >> 16 and not any(a >> 16 <= place <= b >> 16 for a, b in wanted) and raw[place + 20 : place + 22] != b"\0\0":
                raw[place + 20] ^= 255
                spoiled += 1
        path.write_bytes(bytes(raw))
    assert spoiled > 20 and keys(bam.fetch(spark, str(out), "chr2", 4000, 9000).collect()) == keys(want.collect())
    with pytest.raises(Exception, match="damaged|decompress|invalid"):
        bam.read(spark, str(out)).agg(F.sum(F.length("seq"))).collect()


def test_sorted_files_in_order(spark, tmp_path):
    out = str(tmp_path / "s")
    bam.write_sorted(frame(spark, rows(2000, 6)), out, REFS, files=4)
    seen = []
    for path in store.list_files(out):
        if path.endswith(".bam"):
            mine = [(r.ref_name, r.ref_start) for r in bam.read(spark, path).orderBy("voffset").collect()]
            seen.append([([n for n, _ in REFS].index(a) if a else 9, b if b is not None else -1) for a, b in mine])
    assert all(x == sorted(x) for x in seen) and sorted(x for s in seen for x in s) == [x for s in sorted(seen) for x in s]


def test_headers(spark, tmp_path):
    one = Header((("1", 100), ("MT", 5), ("chr2", 7), ("GL9", 1)), "@HD\tVN:1.5\tSO:unsorted", ("@RG\tID:a\tSM:a", "@PG\tID:p\tPN:x", "@CO\tnote\twith tab"))
    two = Header((("chr2", 7), ("new", 9)), lines=("@RG\tID:b\tSM:b", "@PG\tID:p\tPN:x"))
    both = one.merged(two)
    assert both.references == (("1", 100), ("MT", 5), ("chr2", 7), ("GL9", 1), ("new", 9)) and both.groups() == ["a", "b"]
    assert both.lines == ("@RG\tID:a\tSM:a", "@PG\tID:p\tPN:x", "@CO\tnote\twith tab", "@RG\tID:b\tSM:b")
    assert one.for_assembly(["chr1", "chr2"]).references == (("chr1", 100), ("chrM", 5), ("chr2", 7))
    assert decode_header(one.encode(), "f") == (one, len(one.encode()))
    with pytest.raises(ValueError, match="two lengths"):
        one.merged(Header((("1", 101),)))
    df = frame(spark, [dict(r, ref_name="chr2" if r["ref_name"] else None, mate_ref=None, mate_start=None) for r in rows(40)])
    bam.write(df.limit(20).coalesce(1), str(tmp_path / "h/x"), one)
    bam.write(df.limit(20).coalesce(1), str(tmp_path / "h/y"), two)
    found = bam.header(spark, str(tmp_path / "h"))
    assert found.references == both.references and set(found.lines) == set(both.lines) and found.first.startswith("@HD")
    # template of one file, types kept
    bam.write(bam.read(spark, str(tmp_path / "h/x")), str(tmp_path / "t"), bam.header(spark, str(tmp_path / "h/x")))
    assert bam.header(spark, str(tmp_path / "t")) == one
    assert keys(bam.read(spark, str(tmp_path / "t")).collect()) == keys(bam.read(spark, str(tmp_path / "h/x")).collect())


def test_packed_as_a_whole(spark, tmp_path):
    """No blocks of the format: plain, or gzip of all."""
    import gzip

    raw, _ = file_of(rows(50), 3000)
    body = b"".join(c for _, c in blocks.read(io.BytesIO(raw), 0))
    (tmp_path / "a.bam").write_bytes(body)
    (tmp_path / "b.bam").write_bytes(gzip.compress(body))
    back = bam.read(spark, str(tmp_path), split_bytes=1000)
    assert back.count() == 100 and back.select("qname").distinct().count() == 50


def test_no_rows(spark, tmp_path):
    df = frame(spark, rows(5)).limit(0)
    (tmp_path / "none").mkdir()
    assert bam.write(df, str(tmp_path / "none"), REFS).count() == 0 and bam.read(spark, str(tmp_path / "none")).count() == 0
    assert bins(__import__("numpy").array([-1]), __import__("numpy").array([0]))[0] == 4680
