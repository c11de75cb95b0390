"""Alignment records as Arrow batches and back, many at once by numpy; and the header, as a value."""

from __future__ import annotations

import struct
from collections.abc import Iterable
from dataclasses import dataclass, replace
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .ragged import offsets, pieces, places, strings

#: What a row has to have to be written; of the other columns of ARROW those that lack are left at their defaults.
SCHEMA = "file string, voffset long, qname string, flag int, ref_name string, ref_start int, ref_end int, cigar string, seq string, qual string, tags map<string,string>"
MORE = "mapq int, mate_ref string, mate_start int, insert_size int, tag_types map<string,string>"
_TEXTS = pa.map_(pa.string(), pa.string())
ARROW = pa.schema(
    [
        ("file", pa.string()), ("voffset", pa.int64()), ("qname", pa.string()), ("flag", pa.int32()), ("ref_name", pa.string()), ("ref_start", pa.int32()), ("ref_end", pa.int32()),
        ("cigar", pa.string()), ("seq", pa.string()), ("qual", pa.string()), ("tags", _TEXTS), ("mapq", pa.int32()), ("mate_ref", pa.string()), ("mate_start", pa.int32()), ("insert_size", pa.int32()), ("tag_types", _TEXTS),
    ]
)
# Codes of the format.
BASES = "=ACMGRSVTWYHKDBN"
OPS = "MIDNSHP=X"
#: Operations that go forward on the reference.
FORWARD = np.array([1, 0, 1, 1, 0, 0, 0, 1, 1] + [0] * 7, bool)
NUMBERS = {"c": "i1", "C": "u1", "s": "<i2", "S": "<u2", "i": "<i4", "I": "<u4", "f": "<f4"}
FIXED = np.dtype([("ref", "<i4"), ("pos", "<i4"), ("l_name", "u1"), ("mapq", "u1"), ("bin", "<u2"), ("n_cigar", "<u2"), ("flag", "<u2"), ("l_seq", "<i4"), ("mate_ref", "<i4"), ("mate_pos", "<i4"), ("size", "<i4")])
_HEAD = struct.Struct("<iiiBBHHHiiii")
_PAIRS = np.array([[ord(BASES[i >> 4]), ord(BASES[i & 15])] for i in range(256)], np.uint8)
_CODE = np.full(256, 15, np.uint8)
for _i, _c in enumerate(BASES):
    _CODE[ord(_c)] = _CODE[ord(_c.lower())] = _i
_WIDTH = np.zeros(256, np.int64)
for _c, _form in NUMBERS.items():
    _WIDTH[ord(_c)] = np.dtype(_form).itemsize
_WIDTH[ord("A")] = 1


# header


@dataclass(frozen=True)
class Header:
    """References (name, length) in order, and the other lines: of the file, read groups, programs, comments."""

    references: tuple[tuple[str, int], ...] = ()
    first: str = "@HD\tVN:1.6"
    lines: tuple[str, ...] = ()

    @classmethod
    def build(cls, references: Iterable[tuple[str, int]], groups: Iterable[str] = ()) -> Header:
        return cls(tuple(references), lines=tuple(f"@RG\tID:{g}\tSM:{g}" for g in groups))

    def groups(self) -> list[str]:
        return [field(x, "ID") for x in self.lines if x.startswith("@RG")]

    def with_group(self, group: str) -> Header:
        return self if group in self.groups() else replace(self, lines=(*self.lines, f"@RG\tID:{group}\tSM:{group}"))

    def sorted_by(self, order: str) -> Header:
        kept = [x for x in self.first.split("\t") if not x.startswith("SO:")]
        return replace(self, first="\t".join([*kept, f"SO:{order}"]))

    def merged(self, *others: Header) -> Header:
        """The union over inputs: references by name, in order of first sight, and lines once; an error if lengths differ."""
        sizes, lines = dict(self.references), dict.fromkeys(self.lines)
        for h in others:
            for name, size in h.references:
                if sizes.setdefault(name, size) != size:
                    raise ValueError(f"{name} has two lengths")
            lines.update(dict.fromkeys(h.lines))
        return replace(self, references=tuple(sizes.items()), lines=tuple(lines))

    def for_assembly(self, chromosomes: Iterable[str]) -> Header:
        """Names with chr in front where that is a chromosome of the assembly, MT as chrM; other names without chr go."""
        known = set(chromosomes)
        named = [(n if "chr" in n else f"chr{n}" if f"chr{n}" in known else "chrM" if n == "MT" else None, size) for n, size in self.references]
        return replace(self, references=tuple((n, size) for n, size in named if n))

    def text(self) -> str:
        return "".join(f"{x}\n" for x in (self.first, *(f"@SQ\tSN:{n}\tLN:{size}" for n, size in self.references), *self.lines))

    def encode(self) -> bytes:
        text = self.text().encode()
        out = [b"BAM\1", struct.pack("<i", len(text)), text, struct.pack("<i", len(self.references))]
        for n, size in self.references:
            out += [struct.pack("<i", len(n.encode()) + 1), n.encode(), b"\0", struct.pack("<i", size)]
        return b"".join(out)


def field(line: str, key: str) -> str:
    """A field of a header line, or an empty text."""
    return next((x[3:] for x in line.split("\t")[1:] if x[:3] == f"{key}:"), "")


class Short(Exception):
    """More data is needed."""


def decode_header(data: bytes, name: str) -> tuple[Header, int]:
    """(header, bytes it takes)."""
    try:
        if data[:4] != b"BAM\1":
            if len(data) < 4:
                raise Short
            raise ValueError(f"{name} is no BAM file")
        (size,) = struct.unpack_from("<i", data, 4)
        (n,) = struct.unpack_from("<i", data, 8 + size)
        text, at, refs = data[8 : 8 + size].rstrip(b"\0").decode(), 12 + size, []
        for _ in range(n):
            (length,) = struct.unpack_from("<i", data, at)
            refs.append((data[at + 4 : at + 3 + length].decode(), struct.unpack_from("<i", data, at + 4 + length)[0]))
            at += 8 + length
    except struct.error:
        raise Short from None
    lines = [x for x in text.split("\n") if x and not x.startswith("@SQ")]
    first = next((x for x in lines if x.startswith("@HD")), "@HD\tVN:1.6")
    return Header(tuple(refs), first, tuple(x for x in lines if not x.startswith("@HD"))), at


# records


def starts(data: bytes, at: int, stop: int | None = None) -> tuple[list[int], int]:
    """(places of the records that are whole, from `at` on and before `stop`; the place behind them)."""
    out, end = [], len(data)
    stop = end if stop is None else stop
    while at < stop and at + 4 <= end:
        behind = at + 4 + int.from_bytes(data[at : at + 4], "little")
        if behind > end:
            break
        out.append(at)
        at = behind
    return out, at


def _tags_end(data: bytes, at: int, end: int) -> bool:
    """Whether well-formed tags fill [at, end)."""
    while at + 3 <= end:
        if not (chr(data[at]).isalpha() and chr(data[at + 1]).isalnum()):
            return False
        kind = chr(data[at + 2])
        at += 3
        if kind in "ZH":
            at = data.find(b"\0", at, end) + 1
            if not at:
                return False
        elif kind == "B":
            if at + 5 > end or chr(data[at]) not in NUMBERS:
                return False
            at += 5 + _WIDTH[data[at]] * int.from_bytes(data[at + 1 : at + 5], "little")
        elif _WIDTH[ord(kind)]:
            at += int(_WIDTH[ord(kind)])
        else:
            return False
    return at == end


def _possible(data: bytes, at: int, n_refs: int) -> int | None:
    """The place behind a record that may begin here, or None; the record is checked as far as the data goes."""
    if at + 36 > len(data):
        return at + 36
    size, ref, pos, l_name, _, _, n_cigar, _, l_seq, mate, mate_pos, _ = _HEAD.unpack_from(data, at)
    least = 32 + l_name + 4 * n_cigar + (l_seq + 1) // 2 + l_seq
    if not (-1 <= ref < n_refs and -1 <= mate < n_refs and pos >= -1 and mate_pos >= -1 and l_name > 0 and l_seq >= 0 and least <= size < 1 << 30):
        return None
    name = data[at + 36 : at + 36 + l_name]
    if len(name) == l_name and (name[-1] or not all(33 <= c <= 126 for c in name[:-1])):
        return None
    behind = at + 4 + size
    return behind if behind > len(data) or _tags_end(data, at + 4 + least, behind) else None


def first_start(data: bytes, n_refs: int, whole: bool, chain: int = 12) -> int | None:
    """Where the first record begins in data from within a file: the first place from which records follow each other, for
    `chain` of them or to the end of the data, each with a name, lengths and tags that fit. None asks for more data;
    `whole` says that there is none, in which case it is the data's end if no record begins."""
    for at in range(len(data)):
        place, seen = at, 0
        while place is not None and place < len(data) and seen < chain:
            place, seen = _possible(data, place, n_refs), seen + 1
        if place is None:
            continue
        if place > len(data) and seen == 1 and not whole:
            return None  # the first record may be longer than the data
        if place <= len(data) or seen > 1 or not whole:
            return at
    return len(data) if whole else None


@lru_cache(maxsize=1 << 16)
def _cigar_text(raw: bytes) -> str:
    return "".join(f"{c >> 4}{OPS[c & 15]}" for c in np.frombuffer(raw, "<u4").tolist()) or "*"


@lru_cache(maxsize=1 << 16)
def _cigar_codes(text: str) -> bytes:
    out, n = [], ""
    for c in "" if text == "*" else text:
        if c.isdigit():
            n += c
        else:
            out.append(int(n) << 4 | OPS.index(c))
            n = ""
    return np.array(out, "<u4").tobytes()


def _map(record: list[np.ndarray], keys: list, values: list, n: int) -> pa.MapArray:
    """Entries of a map per record; entries of one record are in the order of the lists."""
    whole = np.concatenate(record) if record else np.zeros(0, np.int64)
    order = pa.array(np.argsort(whole, kind="stable"))
    ends = pa.array(offsets(np.bincount(whole, minlength=n)).astype(np.int32))
    join = lambda x: pa.concat_arrays(x).take(order) if x else pa.array([], pa.string())
    return pa.MapArray.from_arrays(ends, join(keys), join(values))


def _decode_tags(raw: np.ndarray, at: np.ndarray, end: np.ndarray) -> tuple[pa.MapArray, pa.MapArray]:
    """(values, types) of all records' tags: the first tags of all records at once, then the second ones, and so on."""
    n = len(at)
    record, keys, values, types = [], [], [], []
    live = np.flatnonzero(at < end)
    zeros = np.flatnonzero(raw == 0)
    at = at.copy()
    while len(live):
        here = at[live]
        kind = raw[here + 2]
        for k in np.unique(kind).tolist():
            mine = live[kind == k]
            p = at[mine] + 3
            letter = chr(k)
            label = [letter] * len(mine)
            if letter in "ZH":
                stop = zeros[np.searchsorted(zeros, p)]
                values.append(strings(raw[places(p, stop - p)], stop - p))
                at[mine] = stop + 1
            elif letter == "B":
                texts, ends = [], []
                label = []
                for i in p.tolist():
                    form, count = chr(raw[i]), int.from_bytes(raw[i + 1 : i + 5].tobytes(), "little")
                    size = np.dtype(NUMBERS[form]).itemsize * count
                    texts.append(",".join(map(str, np.frombuffer(raw[i + 5 : i + 5 + size].tobytes(), NUMBERS[form]).tolist())))
                    ends.append(i + 5 + size)
                    label.append("B" + form)
                values.append(pa.array(texts, pa.string()))
                at[mine] = ends
            else:
                width = int(_WIDTH[k])
                if not width:
                    raise ValueError(f"no such type of a tag: {letter}")
                data = raw[places(p, np.full(len(p), width))]
                values.append(strings(data, np.ones(len(p), np.int64)) if letter == "A" else pa.array(data.view(NUMBERS[letter])).cast(pa.string()))
                at[mine] = p + width
            record.append(mine)
            keys.append(strings(raw[places(p - 3, np.full(len(p), 2))], np.full(len(p), 2)))
            types.append(pa.array(label, pa.string()))
        live = live[at[live] < end[live]]
    return _map(record, keys, values, n), _map(record, keys, types, n)


def decode(data: bytes, at: list[int], header: Header, file: str, voffsets: np.ndarray) -> pa.RecordBatch:
    """The records at these places as a batch of ARROW."""
    raw = np.frombuffer(data, np.uint8)
    at_ = np.array(at, np.int64)
    n = len(at_)
    f = raw[at_[:, None] + np.arange(4, 36)].copy().view(FIXED)[:, 0] if n else np.zeros(0, FIXED)
    size = raw[at_[:, None] + np.arange(4)].copy().view("<u4")[:, 0].astype(np.int64) if n else np.zeros(0, np.int64)
    l_name, n_cigar, l_seq = (f[c].astype(np.int64) for c in ("l_name", "n_cigar", "l_seq"))
    name = at_ + 36
    cigar = name + l_name
    seq = cigar + 4 * n_cigar
    qual = seq + (l_seq + 1) // 2
    tags = qual + l_seq
    ops = raw[places(cigar, 4 * n_cigar)].copy().view("<u4")
    spans = np.concatenate((np.zeros(1, np.int64), np.cumsum((ops >> 4).astype(np.int64) * FORWARD[ops & 15])))
    ends = offsets(n_cigar)
    span = spans[ends[1:]] - spans[ends[:-1]]
    cigars = [_cigar_text(data[a:b]) for a, b in zip(cigar.tolist(), seq.tolist())]
    half = (l_seq + 1) // 2
    letters = _PAIRS[raw[places(seq, half)]].reshape(-1)
    letters = letters[places(offsets(2 * half)[:-1], l_seq)]
    given = l_seq * (raw[np.minimum(qual, len(raw) - 1)] != 255) if n else l_seq
    names = np.array([r for r, _ in header.references] + [""], object)
    texts = pa.array(names[:-1], pa.string()) if len(names) > 1 else pa.array([], pa.string())
    ref = lambda c: texts.take(pa.array(f[c].astype(np.int64), mask=f[c] < 0))
    placed = (f["ref"] >= 0) & (f["flag"] & 4 == 0)
    pos = f["pos"].astype(np.int32)
    values, types = _decode_tags(raw, tags, at_ + 4 + size)
    columns = [
        pa.array([file] * n, pa.string()), pa.array(voffsets), strings(raw[places(name, l_name - 1)], l_name - 1), pa.array(f["flag"].astype(np.int32)), ref("ref"), pa.array(pos, mask=pos < 0),
        pa.array((pos + np.maximum(span, 1)).astype(np.int32), mask=~placed), pa.array(cigars, pa.string()), strings(letters, l_seq), strings(raw[places(qual, given)] + np.uint8(33), given), values,
        pa.array(f["mapq"].astype(np.int32)), ref("mate_ref"), pa.array(f["mate_pos"].astype(np.int32), mask=f["mate_pos"] < 0), pa.array(f["size"].astype(np.int32)), types,
    ]
    return pa.RecordBatch.from_arrays(columns, schema=ARROW)


def bins(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The smallest bin of the format that holds [begin, end)."""
    last = end - 1
    out = np.zeros(len(begin), np.int64)
    done = np.zeros(len(begin), bool)
    for shift, first in ((14, 4681), (17, 585), (20, 73), (23, 9), (26, 1)):
        hit = ~done & (begin >> shift == last >> shift)
        out[hit] = first + (begin[hit] >> shift)
        done |= hit
    return out


def _encode_tags(tags: pa.MapArray, types: pa.MapArray | None) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all records' tags, length of each record's). Types come with the values, in any order; Z is the default."""
    n = len(tags)
    ends = np.asarray(tags.offsets).astype(np.int64)
    keys, items = tags.keys.slice(ends[0], ends[-1] - ends[0]), tags.items.slice(ends[0], ends[-1] - ends[0])
    count = np.diff(ends)
    if tags.null_count:  # a null map has no entries
        none = np.asarray(tags.is_null())
        kept = places((ends - ends[0])[:-1][~none], count[~none])
        keys, items, count = keys.take(pa.array(kept)), items.take(pa.array(kept)), np.where(none, 0, count)
    keys, items = keys.cast(pa.string()), items.cast(pa.string()).fill_null("")
    letters = None
    if types is not None and len(keys):
        if types.keys.cast(pa.string()).equals(keys) and np.array_equal(np.diff(np.asarray(types.offsets)), count):
            letters = types.items.cast(pa.string())
        else:
            known = [dict(x or []) for x in types.to_pylist()]
            letters = pa.array([known[r].get(k) for r, k in zip(np.repeat(np.arange(n), count).tolist(), keys.to_pylist())], pa.string())
    kinds = np.full(len(keys), "Z", object) if letters is None else np.array(letters.fill_null("Z").to_pylist(), object)
    wide = pa.array(np.arange(len(keys)))
    parts, order = [], []
    for kind in sorted(set(kinds.tolist())):
        mine = np.flatnonzero(kinds == kind)
        values = items.take(wide.take(pa.array(mine)))
        if kind in ("Z", "H"):
            body = pc.binary_join_element_wise(values.cast(pa.binary()), b"\0", b"")
        elif kind == "A":
            body = values.cast(pa.binary())
        elif kind in NUMBERS:
            numbers = values.cast(pa.float32() if kind == "f" else pa.int64()).to_numpy().astype(NUMBERS[kind])
            body = pa.array([x.tobytes() for x in numbers], pa.binary())
        elif kind[:1] == "B" and kind[1:] in NUMBERS:
            arrays = [np.array([float(x) if kind[1] == "f" else int(x) for x in v.split(",") if x], NUMBERS[kind[1]]) for v in values.to_pylist()]
            body = pa.array([kind[1].encode() + struct.pack("<i", len(a)) + a.tobytes() for a in arrays], pa.binary())
        else:
            raise ValueError(f"no such type of a tag: {kind}")
        parts.append(pc.binary_join_element_wise(keys.take(pa.array(mine)).cast(pa.binary()), kind[:1].encode(), body, b""))
        order.append(mine)
    if not parts:
        return np.zeros(0, np.uint8), np.zeros(n, np.int64)
    whole = pa.concat_arrays(parts).take(pa.array(np.argsort(np.concatenate(order), kind="stable")))
    data, size = pieces(whole)
    sums = offsets(size)
    ends = offsets(count)
    return data, sums[ends[1:]] - sums[ends[:-1]]


@dataclass
class Encoded:
    """Records as bytes, and of each its length and its place."""

    data: bytes
    size: np.ndarray
    ref: np.ndarray
    begin: np.ndarray
    end: np.ndarray


def encode(batch: pa.RecordBatch, numbers: dict[str, int]) -> Encoded:
    """Rows of SCHEMA, and of MORE as far as there, as records. A name that is no reference is an error."""
    n = batch.num_rows
    get = lambda c: batch.column(c) if c in batch.schema.names else None

    def whole(c: str, default: int) -> np.ndarray:
        x = get(c)
        return np.full(n, default, np.int64) if x is None else x.cast(pa.int64()).fill_null(default).to_numpy()

    def refs(c: str) -> np.ndarray:
        x = get(c)
        if x is None:
            return np.full(n, -1, np.int64)
        d = x.dictionary_encode()
        known = np.array([numbers[v] if v is not None else -1 for v in d.dictionary.to_pylist()] + [-1], np.int64)
        return known[d.indices.fill_null(len(known) - 1).to_numpy(zero_copy_only=False)]

    name, l_name = pieces(batch.column("qname"))
    cigars = [_cigar_codes(c or "*") for c in batch.column("cigar").to_pylist()]
    cigar = np.frombuffer(b"".join(cigars), np.uint8)
    n_cigar = np.array([len(c) for c in cigars], np.int64) // 4
    seq, l_seq = pieces(batch.column("seq"))
    qual, l_qual = pieces(batch.column("qual"))
    if (l_name > 254).any() or ((l_qual != l_seq) & (l_qual > 0)).any():
        raise ValueError("a name is too long, or qualities don't fit their sequence")
    half = (l_seq + 1) // 2
    codes = np.zeros(int(half.sum()) * 2, np.uint8)
    codes[places(offsets(2 * half)[:-1], l_seq)] = _CODE[seq]
    quals = np.full(int(l_seq.sum()), 255, np.uint8)
    quals[places(offsets(l_seq)[:-1], l_qual)] = qual - np.uint8(33)
    tags, l_tags = _encode_tags(batch.column("tags"), get("tag_types"))
    ops = cigar.view("<u4")
    spans = np.concatenate((np.zeros(1, np.int64), np.cumsum((ops >> 4).astype(np.int64) * FORWARD[ops & 15])))
    ends = offsets(n_cigar)
    begin, ref = whole("ref_start", -1), refs("ref_name")
    end = begin + np.maximum(spans[ends[1:]] - spans[ends[:-1]], 1)
    f = np.zeros(n, FIXED)
    for c, v in (("ref", ref), ("pos", begin), ("l_name", l_name + 1), ("mapq", whole("mapq", 0)), ("n_cigar", n_cigar), ("flag", whole("flag", 0)), ("l_seq", l_seq), ("mate_ref", refs("mate_ref")), ("mate_pos", whole("mate_start", -1)), ("size", whole("insert_size", 0))):
        f[c] = v
    f["bin"] = bins(np.maximum(begin, -1), np.where(begin < 0, 0, end)) & 0xFFFF  # 4680 without a place
    body = 32 + l_name + 1 + 4 * n_cigar + half + l_seq + l_tags
    size = body + 4
    at = offsets(size)[:-1]
    out = np.zeros(int(size.sum()), np.uint8)
    out[at[:, None] + np.arange(4)] = body.astype("<u4").view(np.uint8).reshape(n, 4)
    out[at[:, None] + np.arange(4, 36)] = f.view(np.uint8).reshape(n, 32)
    place = at + 36
    for data, length, step in ((name, l_name, l_name + 1), (cigar, 4 * n_cigar, 4 * n_cigar), (codes[::2] << 4 | codes[1::2], half, half), (quals, l_seq, l_seq), (tags, l_tags, l_tags)):
        out[places(place, length)] = data
        place = place + step
    return Encoded(out.tobytes(), size, ref, begin, end)
