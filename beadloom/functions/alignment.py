"""Adapters in sequences by semi-global alignment: substitutions, insertions and deletions, and adapters cut off at an end.

A batch of sequences is aligned at once, a base of all of them per step. A cell of the alignment is the number of errors and,
below it, the number of adapter bases that hang over the sequence's end; so the least cell has the fewest errors, and of those
the longest part of the adapter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Of a cell: errors above these bits, overhang in them.
BITS = 10
ERROR = 1 << BITS


def letters(sequences: pa.Array, backwards: bool) -> tuple[np.ndarray, np.ndarray]:
    """(a row of bases per step, length of each sequence); behind a sequence's end are zeros."""
    size = np.array([len(s) for s in (x or "" for x in sequences.to_pylist())], np.int64)
    raw = np.frombuffer("".join(x or "" for x in sequences.to_pylist()).encode("latin-1", "replace"), np.uint8)
    out = np.zeros((len(size), int(size.max(initial=0))), np.uint8)
    rows, at = np.repeat(np.arange(len(size)), size), np.arange(len(raw)) - np.repeat(np.cumsum(size) - size, size)
    out[rows, size[rows] - 1 - at if backwards else at] = raw
    return np.ascontiguousarray(out.T), size


def place(bases: np.ndarray, size: np.ndarray, adapter: str, rate: float, overlap: int, last: bool) -> tuple[np.ndarray, np.ndarray]:
    """(score, bases up to the adapter's far end) of the best alignment per sequence; score 0 is none.

    The adapter's beginning may hang over the sequence's. A part of `n` adapter bases counts with up to floor(rate * n)
    errors, if n is at least `overlap`; the score is n minus the errors. Of equal scores the one that ends last counts, or
    first.
    """
    word = np.frombuffer(adapter.encode(), np.uint8)[:, None]
    m, rows = len(adapter), bases.shape[1]
    step = np.arange(m + 1, dtype=np.int32)[:, None] * ERROR
    cell = np.repeat(np.arange(m + 1, dtype=np.int32)[:, None], rows, 1)
    # errors that a part of n bases may have; one is more than any
    allowed = np.array([int(np.floor(rate * n + 1e-9)) if n >= overlap else -1 for n in range(m + 1)], np.int32)
    best, end = np.zeros(rows, np.int32), np.zeros(rows, np.int32)
    for j in range(bases.shape[0]):
        base = np.empty_like(cell)
        base[0] = 0
        np.minimum(cell[:-1] + (word != bases[j]) * np.int32(ERROR), cell[1:] + np.int32(ERROR), out=base[1:])
        # a base of the adapter that the sequence lacks: the least of all cells above, an error for each step
        cell = np.minimum.accumulate(base - step, 0) + step
        errors, part = cell[m] >> BITS, m - (cell[m] & (ERROR - 1))
        score = np.where((errors <= allowed[part]) & (j < size), part - errors, 0)
        better = (score >= best) & (score > 0) if last else score > best
        best = np.where(better, score, best)
        end = np.where(better, j + 1, end)
    return best, end


def cuts(sequences: pa.Array, adapters: list[str], at_3: bool, rate: float, overlap: int) -> np.ndarray:
    """Bases to keep up to the best adapter's begin (3' end), or to drop up to its end (5' end); of adapters with equal scores
    the first. Of equal places in a sequence the leftmost counts."""
    bases, size = letters(sequences, at_3)
    best, end = np.zeros(len(size), np.int32), np.zeros(len(size), np.int64)
    for a in adapters:
        score, at = place(bases, size, a[::-1] if at_3 else a, rate, overlap, at_3)
        end = np.where(score > best, at, end)
        best = np.maximum(best, score)
    return size - end if at_3 else end
