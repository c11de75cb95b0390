"""A walk over reads in which each tag is looked for from where the one before it ended; a batch of reads at once."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa

from .names import MISSING

#: Tags of up to so many letters have a number for a key.
SHORT = 21
_DIGIT = np.zeros(256, np.int64)
for _i, _c in enumerate("ACGTN"):
    _DIGIT[ord(_c)] = _i + 1


def keys(windows: np.ndarray) -> np.ndarray:
    """A key per row of letters: a number of three bits a letter (0 for a letter that no tag has), or the letters."""
    n = windows.shape[1]
    if n <= SHORT:
        return _DIGIT[windows] @ (8 ** np.arange(n, dtype=np.int64))
    return np.ascontiguousarray(windows).view(f"S{n}")[:, 0]


@dataclass
class Kind:
    """Strings near the tags of one kind, by length in ascending order: (length, sorted keys, tag of each)."""

    by_length: list[tuple[int, np.ndarray, np.ndarray]] = field(default_factory=list)

    @classmethod
    def build(cls, neighbours: list[str], tag: np.ndarray) -> Kind:
        size = np.array([len(x) for x in neighbours])
        out = cls()
        for n in sorted(set(size.tolist())):
            mine = np.flatnonzero(size == n)
            found = keys(np.frombuffer("".join(neighbours[i] for i in mine).encode(), np.uint8).reshape(-1, n))
            order = np.argsort(found)
            out.by_length.append((n, found[order], tag[mine][order]))
        return out


def walk(reads: pa.Array, layout: tuple[str, ...], kinds: dict[str, Kind], spacer: int, laxity: int, offset: int = 0) -> np.ndarray:
    """Numbers of tags [slot, read], -1 where none is found.

    The first part stands at the start; later tags are looked for at 0 to `laxity` bases on, at each the shorter ones first. A
    tag is left behind at its own end; a missing one as if the longest had stood at the last place.
    """
    texts = [x or "" for x in reads.to_pylist()]
    size = np.array([len(x) for x in texts], np.int64)
    bases = np.zeros((len(texts), int(size.max(initial=0)) + 1), np.uint8)
    bases[np.repeat(np.arange(len(texts)), size), np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)] = np.frombuffer("".join(texts).encode("latin-1", "replace"), np.uint8)
    at = np.minimum(np.full(len(texts), offset, np.int64), size)
    found = []
    for i, part in enumerate(layout):
        if part == "SPACER":
            at = np.minimum(at + spacer, size)
            continue
        tag, end = np.full(len(texts), -1, np.int64), np.zeros(len(texts), np.int64)
        reach = laxity if i else 0
        for advance in range(reach + 1):
            for n, known, tags in kinds[part].by_length:
                open_ = np.flatnonzero((tag < 0) & (at + advance + n <= size))
                if not len(open_):
                    continue
                k = keys(bases[open_[:, None], (at[open_] + advance)[:, None] + np.arange(n)])
                place = np.minimum(np.searchsorted(known, k), len(known) - 1)
                hit = known[place] == k
                tag[open_[hit]] = tags[place[hit]]
                end[open_[hit]] = at[open_[hit]] + advance + n
        longest = kinds[part].by_length[-1][0]
        at = np.where(tag >= 0, end, np.minimum(at + reach + longest, size))
        found.append(tag)
    return np.array(found, np.int64).reshape(len(found), len(texts))


def names_of(found: np.ndarray, names: list[str]) -> pa.ListArray:
    """Tags by read, as names."""
    slots, n = found.shape
    values = pa.array([*names, MISSING], pa.string()).take(pa.array(np.where(found < 0, len(names), found).T.reshape(-1)))
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * slots), values)
