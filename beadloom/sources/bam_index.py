"""Index of a coordinate-sorted BAM file: bins and a linear index over virtual offsets, as a .bai file beside it."""

from __future__ import annotations

import struct
from dataclasses import dataclass, field

import numpy as np

from .bam_records import bins
from .ragged import places

#: Positions of a window of the linear index.
WINDOW = 14


@dataclass
class Index:
    """Chunks (first and last virtual offset) by reference and bin, the first offset by reference and window, and where the
    records without a reference begin."""

    chunks: dict[tuple[int, int], list[list[int]]] = field(default_factory=dict)
    windows: dict[int, dict[int, int]] = field(default_factory=dict)
    placed_end: int = 0
    unplaced: int = 0

    def add(self, ref: np.ndarray, begin: np.ndarray, end: np.ndarray, first: np.ndarray, last: np.ndarray) -> None:
        """Records in the order of the file; first and last are their virtual offsets."""
        there = ref >= 0
        self.unplaced += int((~there).sum())
        ref, begin, end, first, last = (x[there] for x in (ref, begin, end, first, last))
        if not len(ref):
            return
        self.placed_end = int(last[-1])
        b = bins(begin, end)
        cuts = np.flatnonzero(np.diff(ref, prepend=-2) | np.diff(b, prepend=-2))
        for i, j in zip(cuts.tolist(), [*cuts[1:].tolist(), len(ref)]):
            mine = self.chunks.setdefault((int(ref[i]), int(b[i])), [])
            if mine and mine[-1][1] == first[i]:
                mine[-1][1] = int(last[j - 1])
            else:
                mine.append([int(first[i]), int(last[j - 1])])
        w, n = begin >> WINDOW, ((end - 1) >> WINDOW) - (begin >> WINDOW) + 1
        keys = np.repeat(ref << 32, n) + places(w, n)
        at = np.repeat(np.arange(len(ref)), n)
        found, i = np.unique(keys, return_index=True)
        for k, v in zip(found.tolist(), first[at[i]].tolist()):
            self.windows.setdefault(k >> 32, {}).setdefault(k & 0xFFFFFFFF, v)

    def encode(self, n_refs: int) -> bytes:
        out = [b"BAI\1", struct.pack("<i", n_refs)]
        by_ref: dict[int, list] = {}
        for (ref, b), chunks in sorted(self.chunks.items()):
            by_ref.setdefault(ref, []).append((b, chunks))
        for ref in range(n_refs):
            mine = by_ref.get(ref, [])
            out.append(struct.pack("<i", len(mine)))
            for b, chunks in mine:
                out.append(struct.pack("<Ii", b, len(chunks)))
                out += [struct.pack("<QQ", *c) for c in chunks]
            w = self.windows.get(ref, {})
            line, known = [], 0
            for i in range(max(w, default=-1) + 1):
                known = w.get(i, known)  # an empty window has the offset of the one before
                line.append(known)
            out += [struct.pack("<i", len(line)), struct.pack(f"<{len(line)}Q", *line)]
        out.append(struct.pack("<Q", self.unplaced))
        return b"".join(out)

    @classmethod
    def decode(cls, data: bytes) -> Index:
        if data[:4] != b"BAI\1":
            raise ValueError("no index")
        out, at = cls(), 8
        for ref in range(struct.unpack_from("<i", data, 4)[0]):
            (n,) = struct.unpack_from("<i", data, at)
            at += 4
            for _ in range(n):
                b, m = struct.unpack_from("<Ii", data, at)
                numbers = struct.unpack_from(f"<{2 * m}Q", data, at + 8)
                at += 8 + 16 * m
                if b < 37450:  # others hold counts
                    out.chunks[ref, b] = [list(numbers[i : i + 2]) for i in range(0, 2 * m, 2)]
                    out.placed_end = max(out.placed_end, *numbers[1::2])
            (n,) = struct.unpack_from("<i", data, at)
            out.windows[ref] = dict(enumerate(struct.unpack_from(f"<{n}Q", data, at + 4)))
            at += 4 + 8 * n
        if at + 8 <= len(data):
            (out.unplaced,) = struct.unpack_from("<Q", data, at)
        return out

    def region(self, ref: int, begin: int, end: int) -> list[tuple[int, int]]:
        """Ranges of virtual offsets that hold all records that touch [begin, end) of a reference, in order, apart."""
        begin, end = max(begin, 0), min(end, 1 << 29)
        if end <= begin:
            return []
        line = self.windows.get(ref, {})
        least = line.get(begin >> WINDOW, line.get(max(line), 0) if line else 0)
        wanted = [0]
        for shift, first in ((26, 1), (23, 9), (20, 73), (17, 585), (14, 4681)):
            wanted += range(first + (begin >> shift), first + (end - 1 >> shift) + 1)
        found = sorted((max(a, least), b) for w in wanted for a, b in self.chunks.get((ref, w), []) if b > least)
        out: list[list[int]] = []
        for a, b in found:
            if out and a <= out[-1][1]:
                out[-1][1] = max(out[-1][1], b)
            else:
                out.append([a, b])
        return [(a, b) for a, b in out]
