"""Secrets in texts: fixed patterns, and random strings found by two character Markov models.

The models give the chance of a character after the two before it, one of random strings and one of ordinary identifiers.
A candidate is a run of identifier characters; it is a secret if the logarithm of the ratio of both chances, over the whole
run, is above a threshold for any run, and above one per character. Both are trained here, from labelled samples: strings that a base pattern marks are labelled
random (if they mix letters and digits), as are generated strings of common alphabets; identifiers outside of the base spans,
and each three words of a text put together as programs do, are labelled ordinary. Samples are counted over all documents, as numbers of character triples, so what reaches the driver
is a row per triple that occurs, of at most 2 * 67 ** 3, however many documents there are.

Defined cases: a null or empty text has no spans; texts of any length are taken whole; of spans that tie in their start the
kind as listed decides; an added span never overlaps a base span; equal rows give a row each; a null doc_id stays null;
other columns are ignored; a table without any base match is scored by the generated random strings and its own
identifiers; a table without rows gives none.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches

# The base patterns; the last number is the least length of the group that counts.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "random")
LEAST_ASSIGN, LEAST_ACCESS = 6, 20
# Characters of identifiers, and alphabets that random strings are made of.
CHARACTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
ALPHABETS = ("0123456789abcdef", "0123456789ABCDEF", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", CHARACTERS[:62], CHARACTERS[:64], CHARACTERS[:62] + "_-")
_CANDIDATE = re.compile(r"(?<![\w+/=-])[A-Za-z0-9_+/-]{16,}={0,2}(?![\w+/=-])")
_IDENTIFIER = re.compile(r"(?<![\w+/=-])[A-Za-z0-9_+/-]{8,}={0,2}(?![\w+/=-])")
_WORD = re.compile(r"(?<!\w)[A-Za-z]{2,}(?!\w)")
_UUID = re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$")
#: 0 stands for both ends of a string; any other character can't be in one.
SIZE = len(CHARACTERS) + 1
_CODES = np.zeros(256, np.uint8)
for _i, _c in enumerate(CHARACTERS):
    _CODES[ord(_c)] = _i + 1
ORDINARY, RANDOM = 0, 1


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base patterns, each kind's leftmost matches that don't overlap; those that fail are dropped."""
    found = []
    low = text.lower()
    if "token" in low or "secret" in low or "passw" in low or "api" in low:
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= LEAST_ASSIGN]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return in_order(found)


def in_order(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    return sorted(spans, key=lambda x: (x[1], KINDS.index(x[0])))


def mixed(s: str) -> bool:
    """Whether a string has letters and digits, or capitals within, as random strings of some length nearly always do."""
    digits = sum("0" <= c <= "9" for c in s)
    return 0 < digits < len(s) or (not s.islower() and not s.isupper() and not s[1:].islower() and any(c.isalpha() for c in s))


def outside(text: str, spans: list[tuple[str, int, int]], pattern: re.Pattern) -> list[tuple[int, int]]:
    """Matches of a pattern that touch none of the spans, which are in order of their starts."""
    out, k, reach = [], 0, 0
    for m in pattern.finditer(text):
        while k < len(spans) and spans[k][1] < m.end():
            reach = max(reach, spans[k][2])
            k += 1
        if reach <= m.start():
            out.append(m.span())
    return out


def triples(strings: list[str]) -> np.ndarray:
    """Numbers (first, second, third) of the character triples of strings, ends included."""
    if not strings:
        return np.zeros(0, np.int64)
    codes = _CODES[np.frombuffer(("  " + "  ".join(strings) + " ").encode("ascii"), np.uint8)].astype(np.int64)
    t = (codes[:-2] * SIZE + codes[1:-1]) * SIZE + codes[2:]
    return t[(codes[1:-1] > 0) | (codes[2:] > 0)]  # not the two blanks between strings


def composed(words: list[str]) -> list[str]:
    """Identifiers as programs, paths and hosts have them, made of each three words in turn: a style for each."""
    out = []
    for i in range(0, len(words) - 2, 3):
        a, b, c = (w.lower() for w in words[i : i + 3])
        n = len(a) * 7 + len(b) * 31 + len(c)
        style = i // 3 % 9
        if style == 0:
            out.append(a + b.capitalize() + c.capitalize())
        elif style == 1:
            out.append(a.capitalize() + b.capitalize() + c.capitalize())
        elif style == 2:
            out.append(f"{a}_{b}_{c}")
        elif style == 3:
            out.append(f"{a}_{b}_{c}".upper())
        elif style == 4:
            out.append(f"{a}-{b}-{c}")
        elif style == 5:
            out.append(f"/{a}/{b}/{c}{n % 10}")
        elif style == 6:
            out.append(f"{a}_{b}{n}_{c}")
        elif style == 7:
            out.append(f"{1990 + n % 40}-{n % 12 + 1:02}-{n % 28 + 1:02}-{a}-{b}")
        else:
            out.append(f"{a}-{n * 7919}-{b}/{c}-{n}")
    return out


def samples(text: str) -> tuple[list[str], list[str]]:
    """(ordinary identifiers, random strings) of a text, labelled by the base patterns."""
    spans = base_spans(text)
    random_ = []
    for kind, s, e in spans:
        if kind != "hex" or not any(k == "assign" and a <= s and e <= b for k, a, b in spans):
            value = ASSIGN.match(text, s).group(2) if kind == "assign" else text[s:e]
            value = value.rstrip("=.")
            if len(value) >= 16 and mixed(value) and "." not in value and "=" not in value:
                random_.append(value)
    ordinary = [text[s:e].rstrip("=") for s, e in outside(text, spans, _IDENTIFIER)]
    return [x for x in ordinary if not x.isdigit()] + composed(_WORD.findall(text)), random_


def generated(per_alphabet: int, seed: int = 11) -> list[str]:
    """Random strings of the common alphabets, 20 to 64 characters long."""
    rng = random.Random(seed)
    return ["".join(rng.choices(a, k=rng.randint(20, 64))) for a in ALPHABETS for _ in range(per_alphabet)]


@dataclass
class Model:
    """The logarithm of the ratio of both models' chances for each triple, and the threshold of a sum of those."""

    ratios: np.ndarray
    threshold: float
    per_character: float

    def ratio(self, s: str) -> float:
        return float(self.ratios[triples([s.rstrip("=")])].sum())

    def is_random(self, s: str) -> bool:
        s = s.rstrip("=")
        if s.isdigit() or not mixed(s) or _UUID.match(s):
            return False
        ratio = self.ratio(s)
        return ratio > self.threshold and ratio > self.per_character * len(s)


def chances(counts: np.ndarray) -> np.ndarray:
    """Logarithms of P(third | first, second), drawn towards P(third | second), and that towards P(third) and even chances."""
    c3 = counts.reshape(SIZE, SIZE, SIZE).astype(np.float64)
    c2, c1 = c3.sum(0), c3.sum((0, 1))
    p1 = (c1 + 1) / (c1.sum() + SIZE)
    p2 = (c2 + 20 * p1) / (c2.sum(1, keepdims=True) + 20)
    p3 = (c3 + 10 * p2) / (c3.sum(2, keepdims=True) + 10)
    return np.log(p3).reshape(-1)


def fit(ordinary: np.ndarray, random_: np.ndarray, per_alphabet: int = 400, prior: float = 1e-4, recall: float = 0.995) -> Model:
    """Models from counts of triples. `prior` is the expected share of random strings among candidates; the threshold per
    character is what a share of `recall` of other generated strings is above, but at most 2."""
    made = np.bincount(triples(generated(per_alphabet)), minlength=SIZE**3)
    # labelled strings weigh at most as much as the generated, so that one common format doesn't hide the others
    weight = min(1.0, made.sum() / max(1, random_.sum()))
    ratios = chances(random_ * weight + made) - chances(ordinary)
    model = Model(ratios.astype(np.float32), math.log((1 - prior) / prior), 0.0)
    other = [model.ratio(s) / len(s) for s in generated(per_alphabet, 12) if mixed(s)]
    model.per_character = min(2.0, float(np.quantile(other, 1 - recall)))
    return model


def learn(docs: DataFrame, per_alphabet: int = 400, prior: float = 1e-4, recall: float = 0.995) -> Model:
    """The models, from counts over all documents."""

    def run(batches):
        counts = np.zeros((2, SIZE**3), np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                found: tuple[list, list] = ([], [])
                for text in batch.column(0).slice(at, 512).to_pylist():
                    if text:
                        for all_, more in zip(found, samples(text)):
                            all_ += more
                for k in (ORDINARY, RANDOM):
                    cells, n = np.unique(triples(found[k]), return_counts=True)
                    counts[k, cells] += n
        for k in (ORDINARY, RANDOM):
            cells = np.flatnonzero(counts[k])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(cells), k, np.int32)), pa.array(cells.astype(np.int32)), pa.array(counts[k, cells])], names=["label", "cell", "n"])

    rows = docs.select("text").mapInArrow(run, "label int, cell int, n long").groupBy("label", "cell").agg(F.sum("n").alias("n"))
    table = rows.toArrow()  # at most a row per label and triple
    counts = np.zeros((2, SIZE**3), np.int64)
    counts[table["label"].to_numpy(), table["cell"].to_numpy()] = table["n"].to_numpy()
    return fit(counts[ORDINARY], counts[RANDOM], per_alphabet, prior, recall)


def find(text: str | None, model: Model) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """(base spans, all spans), in order of start, then kind."""
    text = text or ""
    base = base_spans(text)
    more = [("random", s, e) for s, e in outside(text, base, _CANDIDATE) if model.is_random(text[s:e])]
    return base, in_order(base + more) if more else base


def detect(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, base (base spans), spans (all spans) of documents; a span has kind, start and end, in code points."""
    known = docs.sparkSession.sparkContext.broadcast(model or learn(docs))  # a number per triple

    def make():
        def run(batch: dict) -> dict:
            found = [find(t, known.value) for t in batch["text"]]
            return {"doc_id": batch["doc_id"], **{c: [[dict(zip(("kind", "start", "end"), x)) for x in f[i]] for f in found] for i, c in enumerate(("base", "spans"))}}

        return run

    span = "array<struct<kind:string,start:long,end:long>>"
    return map_batches(docs.select("doc_id", "text"), make, f"doc_id long, base {span}, spans {span}")


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def digest(spans: list[tuple[str, int, int]]) -> str:
    return hashlib.sha256(joined(spans).encode()).hexdigest()
