"""Byte-level BPE by a lazily determinised finite-state transducer, and streaming decoding.

A token sequence is the BPE encoding of its bytes exactly when each neighbouring pair of its tokens is the encoding
of that pair's bytes. So the encodings of all strings are the paths of a nondeterministic transducer whose states
are (tokens not yet emitted, place in the vocabulary's trie), and whose token boundaries are allowed by that pair
test. Its subsets are determinised on demand into a subsequential transducer: a state is the tuple of live hypotheses with
what each has yet to emit, an arc reads one byte and emits the tokens that all hypotheses then share, so the lookahead lasts
only as long as hypotheses disagree. Matches of any length go through it, a lookup a byte.

Defined cases: null and empty texts have no tokens; a null doc_id stays null; texts of any length are encoded whole (one
match of the pattern, however long, is a stream through the transducer, and only its undecided tokens are held); other
columns are ignored; repeated rows give a row each; an empty table gives an empty result. There are no ties: an encoding
is unique.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import struct
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import regex
from pyspark.sql import DataFrame

from .common import SegmentCache, map_batches

#: Determinised states kept at most; beyond, the table is emptied and grows anew.
MAX_STATES = 400_000
NODE_BITS, LAST_BITS = 24, 24
NODE, LAST, TOP = (1 << NODE_BITS) - 1, (1 << LAST_BITS) - 1, NODE_BITS + LAST_BITS


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Steps(dict):
    """state << 8 | byte -> state << 8 behind it, or ~number of an arc that emits tokens; worked out when first asked for."""

    def __init__(self, work_out: Callable[[int], int]):
        super().__init__()
        self.work_out = work_out

    def __missing__(self, key: int) -> int:
        to = self[key] = self.work_out(key)
        return to


class Transducer:
    """Encoder of one pre-token at a time, from a table of ranks.

    A hypothesis is (last whole token, trie node of the open token, tokens that it hasn't emitted). After each byte at most one
    token can end, as every prefix has one encoding.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {i: t for t, i in ranks.items()}
        self.length = {i: len(t) for t, i in ranks.items()}
        # edges of the trie by node << 8 | byte: (child, token that ends there or -1)
        child: dict[int, int] = {}
        token_at, inner = [-1], {0}
        for token, rank in ranks.items():
            node = 0
            for b in token:
                nxt = child.get(node << 8 | b)
                if nxt is None:
                    nxt = child[node << 8 | b] = len(token_at)
                    token_at.append(-1)
                    inner.add(node)
                node = nxt
            token_at[node] = rank
        self.edge = {k: (c, token_at[c], c in inner) for k, c in child.items()}
        self.spines: dict[int, tuple[list, list]] = {}
        self._reset()

    def _reset(self) -> None:
        # a hypothesis is packed: number of the tokens not emitted << TOP | (last token + 1) << NODE_BITS | node
        start = (0,)
        self.number = {start: 0}
        self.state = [start]
        self.held: list[tuple] = [()]
        self.held_number: dict[tuple, int] = {(): 0}
        self.final: list[tuple] = [()]  # of a state: what is left to emit if the match ends there
        self.arcs: list[tuple[int, tuple]] = []  # arcs that emit: (state << 8 behind it, tokens)
        self.step = Steps(self._advance)
        self.pairs: dict[int, bool] = {}

    def _hold(self, tokens: tuple) -> int:
        found = self.held_number.get(tokens)
        if found is None:
            found = self.held_number[tokens] = len(self.held)
            self.held.append(tokens)
        return found << TOP

    def merge(self, data: bytes, below: int = 1 << 60) -> list[bytes]:
        """BPE by repeated merging of the pair with the lowest rank, leftmost first; for one token's bytes."""
        parts = [data[i : i + 1] for i in range(len(data))]
        rank = self.ranks.get
        while len(parts) > 1:
            best, at = min((rank(parts[i] + parts[i + 1], below), i) for i in range(len(parts) - 1))
            if best >= below:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _spines(self, token: int) -> tuple[list, list]:
        """The tokens that stand at a token's right and left edge while it is merged, each with the rank that ends it."""
        found = self.spines.get(token)
        if found is None:
            right, left = [(token, 1 << 60)], [(token, 1 << 60)]
            if len(self.bytes_of[token]) > 1:
                halves = self.merge(self.bytes_of[token], token)
                x, y = self.ranks[halves[0]], self.ranks[halves[-1]]
                right += [(t, min(r, token)) for t, r in self._spines(y)[0]]
                left += [(t, min(r, token)) for t, r in self._spines(x)[1]]
            found = self.spines[token] = right, left
        return found

    def follows(self, a: int, b: int) -> bool:
        """Whether tokens a, b may stand side by side: no pair of edge tokens alive at once merges across the border.

        Of equal ranks the left pair merges first, hence < for a's side and <= for b's.
        """
        xs, ys = self._spines(a)[0], self._spines(b)[1]
        text, rank = self.bytes_of, self.ranks.get
        i = j = 0
        while True:
            (x, x_end), (y, y_end) = xs[i], ys[j]
            r = rank(text[x] + text[y])
            if r is not None and r < x_end and r <= y_end:
                return False
            # back in time: undo the later of the two merges
            if i + 1 < len(xs) and (x > y or j + 1 == len(ys)):
                i += 1
            elif j + 1 < len(ys):
                j += 1
            else:
                return True

    def _advance(self, key: int) -> int:
        """The arc of a key of `step`, from the hypotheses of its state."""
        live, ended, final = [], -1, ()
        edge, pairs, held = self.edge.get, self.pairs, self.held
        byte = key & 255
        for h in self.state[key >> 8]:
            node = h & NODE
            found = edge(node << 8 | byte)
            if found is not None:
                nxt, token, inner = found
                if token >= 0 and ended < 0:
                    last = h >> NODE_BITS & LAST
                    sides = True
                    if last:
                        pair = last << LAST_BITS | token
                        sides = pairs.get(pair)
                        if sides is None:
                            sides = pairs[pair] = self.follows(last - 1, token)
                    if sides:
                        final = (*held[h >> TOP], token)
                        ended = self._hold(final) | (token + 1) << NODE_BITS
                if inner:
                    live.append(h + nxt - node)
        if ended >= 0:
            live.append(ended)
        # what all hypotheses share goes out on the arc
        kinds = {h >> TOP for h in live}
        out: tuple = ()
        if len(kinds) == 1:
            out = held[kinds.pop()]
            if out:
                live = [h & (1 << TOP) - 1 for h in live]
        elif 0 not in kinds:
            least, most = min(held[k] for k in kinds), max(held[k] for k in kinds)
            n = next((i for i, (a, b) in enumerate(zip(least, most)) if a != b), min(len(least), len(most)))
            if n:
                out, moved = least[:n], {k: self._hold(held[k][n:]) for k in kinds}
                live = [h & (1 << TOP) - 1 | moved[h >> TOP] for h in live]
        new = tuple(live)
        to = self.number.get(new)
        if to is None:
            to = self.number[new] = len(self.state)
            self.state.append(new)
            self.final.append(final[len(out) :] if ended >= 0 else ())
        if not out:
            return to << 8
        self.arcs.append((to << 8, out))
        return ~(len(self.arcs) - 1)

    def encode(self, data: bytes) -> list[int]:
        """Token ids of one pre-token."""
        if len(self.state) > MAX_STATES:
            self._reset()
        ids: list[int] = []
        at, step, arcs = 0, self.step, self.arcs
        for b in data:
            at = step[at | b]
            if at < 0:
                at, tokens = arcs[~at]
                ids += tokens
        ids += self.final[at >> 8]
        if len(ids) > 1 and (whole := self.ranks.get(data)) is not None:
            return [whole]  # a token that no merges make: a match that is one is that token all the same
        return ids

    def stream(self, data: Iterable[int]) -> Iterator[list[int]]:
        """Tokens of a stream of bytes, given out by the arcs as they are passed."""
        at, step, arcs = 0, self.step, self.arcs
        for b in data:
            at = step[at | b]
            if at < 0:
                at, tokens = arcs[~at]
                yield list(tokens)
        if self.final[at >> 8]:
            yield list(self.final[at >> 8])


_MARKS = frozenset(".,;:!?|")


class TextEncoder:
    """Whole texts: split by the pattern, each match through the transducer, with bounded caches.

    A match always ends before a space that is followed by a character that isn't white space, so the text is
    cut there first, and the parts of frequent words come from a cache.
    """

    def __init__(self, ranks_path: str, pattern: str, dtype: str = "<u2"):
        self.machine = Transducer(read_ranks(ranks_path))
        if max(self.machine.bytes_of) >= 2 ** (8 * np.dtype(dtype).itemsize):
            dtype = "<u4"
        self.dtype = np.dtype(dtype)
        self.find = regex.compile(pattern).findall
        self.pieces = SegmentCache(self._piece, 150_000)
        self.parts = SegmentCache(self._part, 250_000)
        self.splittable = regex.compile(r" (?=\s|$)").search

    def _piece(self, piece: str) -> list[int]:
        return self.machine.encode(piece.encode("utf-8", "surrogatepass"))

    def pack(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{self.dtype.char}", *ids)

    def _part(self, part: str) -> bytes:
        if part.isascii():  # most parts: a word, perhaps with one mark behind it; what the pattern would find
            word = part[1:] if part[0] == " " else part
            if word.isalpha():  # a match as it is
                return self.pack(self.machine.encode(part.encode()))
            if word[-1:] in _MARKS and word[:-1].isalpha():
                return self.pack(self.pieces[part[:-1]] + self.pieces[word[-1]])
        found = self.find(part)
        if len(found) == 1:
            ids = self.pieces[found[0]]
        else:
            ids = []
            for piece in found:
                ids += self.pieces[piece]
        return self.pack(ids)

    def packed(self, text: str | None) -> bytes:
        """The ids as packed little-endian unsigned integers."""
        if not text:
            return b""
        if self.splittable(text):
            return self._part(text)
        first, *rest = text.split(" ")
        parts = self.parts
        head = parts[first] if first else b""
        return head + b"".join([parts[" " + x] for x in rest])

    def ids(self, text: str | None) -> np.ndarray:
        return np.frombuffer(self.packed(text), self.dtype)


def utf8_states() -> np.ndarray:
    """The UTF-8 state machine: next[state, byte], state 0 between characters, 8 after an error."""
    bad = 8
    t = np.full((9, 256), bad, np.uint8)
    t[0, :0x80] = 0
    t[0, 0xC2:0xE0] = 1  # one continuation byte to come
    t[0, 0xE1:0xF0] = 2  # two
    t[0, 0xF1:0xF4] = 3  # three
    t[0, 0xE0], t[0, 0xED], t[0, 0xF0], t[0, 0xF4] = 4, 5, 6, 7
    t[1, 0x80:0xC0] = 0
    t[2, 0x80:0xC0] = 1
    t[3, 0x80:0xC0] = 2
    t[4, 0xA0:0xC0] = 1  # no overlong forms
    t[5, 0x80:0xA0] = 1  # no surrogates
    t[6, 0x90:0xC0] = 2
    t[7, 0x80:0x90] = 2
    return t


UTF8 = utf8_states().tolist()


class StreamDecoder:
    """ids in, bytes of whole characters out; an unfinished character waits for the next call.

    The state machine runs over tokens: most tokens lead from state 0 to state 0, and only runs of the others
    are walked byte by byte. Bytes that are no UTF-8 pass unchanged, and `valid` turns false.
    """

    def __init__(self, bytes_of: dict[int, bytes], table: tuple | None = None):
        self.tokens, self.size, self.closed = table or self.tables(bytes_of)
        self.next = UTF8
        self.state, self.valid, self.held = 0, True, b""

    @staticmethod
    def tables(bytes_of: dict[int, bytes]) -> tuple:
        n = max(bytes_of) + 1
        tokens = [bytes_of.get(i, b"") for i in range(n)]
        size = np.array([len(t) for t in tokens], np.int64)

        def closed(t: bytes) -> bool:
            try:
                t.decode("utf-8")
            except UnicodeDecodeError:
                return False
            return True

        return tokens, size, np.array([closed(t) for t in tokens])

    def feed(self, ids: np.ndarray) -> bytes:
        if not len(ids):
            return b""
        tokens = self.tokens
        data = b"".join([tokens[i] for i in ids.tolist()])
        is_open = np.flatnonzero(~self.closed[ids])
        if not len(is_open) and not self.state:
            return data
        n = self.size[ids]
        ends = np.cumsum(n)
        # bytes that the machine has to see: those of open tokens, and of closed ones inside a character
        state, table = self.state, self.next
        walk = np.union1d(is_open, [0]) if state else is_open
        done = -1
        for i in walk.tolist():
            if i <= done:
                continue
            j = i
            while True:
                for b in data[ends[j] - n[j] : ends[j]]:
                    state = table[state][b]
                    if state == 8:
                        self.valid, state = False, 0
                done = j
                j += 1
                if not state or j == len(ids):
                    break
        self.state = state
        raw = self.held + data
        if state:  # the last character's lead byte is at most three bytes back
            boundary = next(len(raw) - k for k in range(1, 5) if raw[-k] >= 0xC0)
            raw, self.held = raw[:boundary], raw[boundary:]
        else:
            self.held = b""
        return raw

    def finish(self) -> bytes:
        rest, self.held = self.held, b""
        self.valid &= not self.state
        self.state = 0
        return rest


@lru_cache(maxsize=4)
def encoder(ranks_path: str, pattern: str) -> TextEncoder:
    e = TextEncoder(ranks_path, pattern)
    # a worker's tables are millions of objects without cycles: keep the collector from walking them all the time
    gc.freeze()
    gc.set_threshold(200_000, 20, 50)
    return e


@lru_cache(maxsize=4)
def decode_tables(ranks_path: str) -> tuple:
    return StreamDecoder.tables({i: t for t, i in read_ranks(ranks_path).items()})


def decode_stream(ids: np.ndarray, tables: tuple, step: int = 8192) -> Iterator[bytes]:
    d = StreamDecoder({}, tables)
    for at in range(0, len(ids), step):
        yield d.feed(ids[at : at + step])
    yield d.finish()


def text_of(ids: np.ndarray, words: list[bytes]) -> bytes:
    return b" ".join([words[i] for i in ids.tolist()])


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """documents -> doc_id, ids (packed), n_tokens. Main interface for users of the encoder."""

    def make():
        e = encoder(ranks_path, pattern)

        def run(batch: dict) -> dict:
            packed = [e.packed(t) for t in batch["text"]]
            return {"doc_id": batch["doc_id"], "ids": packed, "n_tokens": [len(x) // e.dtype.itemsize for x in packed]}

        return run

    return map_batches(docs.select("doc_id", "text"), make, "doc_id long, ids binary, n_tokens long")


def round_trip(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """documents -> doc_id, n_tokens, ids_sha256, decoded_sha256, decoded_valid."""

    def make():
        e = encoder(ranks_path, pattern)
        tables = decode_tables(ranks_path)
        words = [b"%d" % i for i in range(max(e.machine.bytes_of) + 1)]

        def run(batch: dict) -> dict:
            out: dict[str, list] = {"doc_id": batch["doc_id"], "n_tokens": [], "ids_sha256": [], "decoded_sha256": [], "decoded_valid": []}
            for t in batch["text"]:
                ids = e.ids(t)
                decoded, d = hashlib.sha256(), StreamDecoder({}, tables)
                for at in range(0, len(ids), 8192):
                    decoded.update(d.feed(ids[at : at + 8192]))
                decoded.update(d.finish())
                out["n_tokens"].append(len(ids))
                out["ids_sha256"].append(hashlib.sha256(text_of(ids, words)).hexdigest())
                out["decoded_sha256"].append(decoded.hexdigest())
                out["decoded_valid"].append(d.valid)
            return out

        return run

    return map_batches(docs.select("doc_id", "text"), make, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, decoded_valid boolean")


def encode_all(texts: Iterable[str], ranks_path: str, pattern: str) -> list[list[int]]:
    e = encoder(ranks_path, pattern)
    return [e.ids(t).tolist() for t in texts]
