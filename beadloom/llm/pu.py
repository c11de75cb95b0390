"""Classifiers from positive and unlabelled texts by the non-negative unbiased risk estimator.

Known are trusted positives and texts without a label, a mixture with an unknown share (the prior) of positives. With
the logistic loss l, the risk pi * P[l(+f)] + max(0, U[l(-f)] - pi * P[l(-f)]) is minimised; where the second part turns
negative, its gradient is followed upwards instead, as over-fitting has begun. The prior comes from the data: classifiers
of positives against unlabelled texts rank both, and the share of unlabelled texts in a region of high rank over the share
of positives there can't be below the prior, so the least such ratio estimates it.

Only texts are inputs. Models are linear over hashed features of words (the word, its beginnings of 4 and 5 bytes, its end, the marks behind it) and
over dense measurements. What is counted, is counted over all documents by Spark: in how many each hashed feature occurs,
which tells the features that set positives apart, and how many score above each threshold that the prior is read from
(two classifiers, each for the half of the texts that it wasn't trained on). Only the gradient steps, with numpy on the
driver, and the share of texts that a threshold is lowered to, use samples: at most `max_positive` and `max_unlabelled` texts, one per id, drawn by a hash of the id.

Defined cases: null and empty texts have no features and measurements 0 and get a score like others; texts of any length
are taken whole; repeated rows and doc_ids give a row each, and count once in a sample (by the least text); a null doc_id
is in no fold (held_out null) and never trained on; labels that are null or of unknown ids are ignored, an id with several
labels is a positive if one of them is 1; ties in the sampling hash go by doc_id; without at least two positives all
scores are 0; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import append_batches, discard, fresh, map_batches, materialise

#: Texts that are taken at once.
SLICE = 512
HASH_BITS = 18
HASHES = 1 << HASH_BITS
#: Beginnings of words, in bytes, that are features besides the word itself.
PREFIXES = (4, 5)
#: Measurements of a text. All are shares or logarithms, none is cut at a bound of a rule.
DENSE = ("n_words", "symbols", "bangs", "pipes", "upper", "digits", "mean_word", "distinct", "window_repeats", "line_repeats")
# Marks that are stripped from words.
_STRIP = b".,;:!?\"'()[]{}*#$%&|<>-+=/"
#: Words from which on features weigh less, and words at which they weigh 1.
FEW, UNIT = 20, 60
#: Bytes of text whose words are hashed at once; a longer word counts in pieces.
PIECE = 1 << 20


@dataclass(frozen=True)
class Config:
    hashed: bool
    #: Names of DENSE that are used.
    dense: tuple[str, ...] = ()
    #: Features of a word's last three bytes, and of the marks behind it with whether it is in capitals.
    shapes: bool = False
    #: Whether features that are rarer in positives count, too, not only those that are more frequent.
    both_ways: bool = False
    max_positive: int = 5000
    max_unlabelled: int = 10000
    epochs: int = 40
    rate: float = 0.02
    decay: float = 1e-4
    batch: int = 1500
    seed: int = 11
    #: Hashed features used: at least so many standard deviations more frequent in positives than in all documents (or
    #: rarer), and in at least so many positives (or documents of a sample of that size).
    least_z: float = 6.0
    least_texts: int = 4
    #: Power of the number of words (at least FEW) by which a text's hashed features weigh less, so that a few in a long text
    #: say less than in a short one; needs n_words among the measurements.
    per_words: float = 0.0
    #: The threshold is lowered until so much of the prior is above it among the unlabelled texts, but at most half the way to
    #: texts without any feature that counts; 0: not at all.
    above_share: float = 0.0


@dataclass
class Model:
    config: Config
    prior: float
    weights: np.ndarray
    bias: float
    centre: np.ndarray = field(default_factory=lambda: np.zeros(0))
    scale: np.ndarray = field(default_factory=lambda: np.ones(0))


def _table(of: Callable[[int], int]) -> np.ndarray:
    return np.array([of(c) for c in range(256)], np.uint8)


_SPACE = _table(lambda c: c in b" \t\n\v\f\r")
_MARK = _table(lambda c: c in _STRIP)
_LOW = _table(lambda c: c + 32 if 65 <= c <= 90 else c)
_SMALL, _CAPITAL = _table(lambda c: 97 <= c <= 122), _table(lambda c: 65 <= c <= 90)
_BASE = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xBF58476D1CE4E5B9)


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2^64, and of its inverse: a stretch of bytes is hashed by a difference of sums."""
    n = 2 * PIECE + 2
    with np.errstate(over="ignore"):
        return tuple(np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(n, b, np.uint64)])) for b in (_BASE, pow(_BASE, -1, 1 << 64)))


def _sums(data: np.ndarray) -> np.ndarray:
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers()[0][: len(data)], out=out[1:])
    return out


def _stretches(sums: np.ndarray, start: np.ndarray, end: np.ndarray, salt: int) -> np.ndarray:
    """64-bit hashes of data[start:end]."""
    x = ((sums[end] - sums[start]) * _powers()[1][start] ^ np.uint64(salt * 0x632BE59BD9B4E019 % (1 << 64))) * _MIX
    x ^= x >> np.uint64(31)
    return x * _MIX ^ (x >> np.uint64(29))


def _hash_words(data: np.ndarray, shapes: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, 64-bit identity, features) of each word of a text in bytes; features are one column each, HASHES for none."""
    edges = np.flatnonzero(np.diff(np.concatenate([[1], _SPACE[data], [1]])))
    start, end = edges[::2], edges[1::2]
    low = _LOW[data]
    # capitals of Latin letters with accents: 0xC3 and 0x80 to 0x9E
    accent = np.flatnonzero((data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[:-1] == 0xC3)) + 1
    low[accent] += 32
    raw, lower = _sums(data), _sums(low)
    n, at, plain = len(data), np.arange(len(data)), _MARK[data] == 0
    first = np.minimum(np.minimum.accumulate(np.where(plain, at, n)[::-1])[::-1][start], end)
    last = np.maximum(np.maximum.accumulate(np.where(plain, at, -1))[end - 1] + 1, first)
    size = last - first

    def feature(hashes: np.ndarray, there: np.ndarray) -> np.ndarray:
        return np.where(there, (hashes >> np.uint64(64 - HASH_BITS)).astype(np.int32), HASHES)

    found = [feature(_stretches(lower, first, last, 1), size > 0)]
    found += [feature(_stretches(lower, first, np.minimum(first + k, last), k), size > k) for k in PREFIXES]
    if shapes:
        small, capital = (np.concatenate([[0], np.cumsum(t[data])]) for t in (_SMALL, _CAPITAL))
        loud = (small[last] == small[first]) & (capital[last] > capital[first])
        found.append(feature(_stretches(raw, np.maximum(start, end - 3), end, 101), size >= 0))
        found.append(feature(_stretches(raw, last, np.minimum(last + 3, end), 102) + loud.astype(np.uint64) * _MIX, size >= 0))
    return start, _stretches(raw, start, end, 0), np.stack(found, 1).astype(np.int32)


def _groups(texts: list[bytes]) -> Iterator[list[tuple[int, bytes]]]:
    """(number, text) in groups of up to PIECE bytes; longer texts in pieces cut at white space, if there is any."""
    held, size = [], 0
    for i, t in enumerate(texts):
        while len(t) > PIECE:
            cut = max(t.rfind(c, 0, PIECE) for c in (b" ", b"\n", b"\t"))
            cut = cut if cut > 0 else PIECE
            yield [(i, t[:cut])]
            t = t[cut:]
        if held and size + len(t) > PIECE:
            yield held
            held, size = [], 0
        held.append((i, t))
        size += len(t) + 1
    if held:
        yield held


def hash_texts(texts: list[str | None], shapes: bool) -> tuple[np.ndarray, np.ndarray]:
    """(number of the text, features) of the distinct words of each text, by text; a beginning that several words of a text
    share comes as often. Features are a row per word, HASHES where there is none."""
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    docs, names, rows = [], [], []
    for group in _groups(raw):
        data = np.frombuffer(b"\n".join([*(t for _, t in group), b""]), np.uint8)
        at, name, found = _hash_words(data, shapes)
        begins = np.cumsum([0, *(len(t) + 1 for _, t in group)])[:-1]
        doc = np.array([i for i, _ in group])[np.searchsorted(begins, at, "right") - 1] if len(at) else np.zeros(0, np.int64)
        docs.append(doc)
        names.append(name)
        rows.append(found)
    if not docs:
        return np.zeros(0, np.int64), np.zeros((0, 1), np.int32)
    doc, name = np.concatenate(docs), np.concatenate(names)
    # sorted by text, then by word: of equal words the first stays
    order = np.lexsort((name, doc)) if len(docs) > 1 or len(doc) < 2 else _order(doc, name)
    doc, name = doc[order], name[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (name[1:] != name[:-1])
    return doc[new], np.concatenate(rows)[order[new]]


def _order(doc: np.ndarray, name: np.ndarray) -> np.ndarray:
    """As lexsort, by one sort: the top bits are the text's number, the others of the word's hash decide but for accidents."""
    bits = np.uint64(max(1, int(doc[-1]).bit_length()))
    return np.argsort(doc.astype(np.uint64) << (np.uint64(64) - bits) | name >> bits)


def hash_each(texts: list[str | None], shapes: bool) -> list[np.ndarray]:
    """Features of each text."""
    doc, found = hash_texts(texts, shapes)
    cuts = np.searchsorted(doc, np.arange(len(texts) + 1))
    return [x[x < HASHES] for x in (found[a:b].ravel() for a, b in zip(cuts, cuts[1:]))]


def dense(raw: bytes, words: list[bytes], names: tuple[str, ...]) -> np.ndarray:
    """The named measurements of a text; none other is worked out."""
    n = len(words)
    if not n:
        return np.zeros(len(names))
    joined = b"".join(words)
    share = lambda k, of: math.sqrt(k / of)
    but = lambda drop: len(joined) - len(joined.translate(None, drop))

    def lines() -> float:
        found = [x for x in raw.split(b"\n") if x.strip()]
        return share(len(found) - len(set(found)), len(found))

    m: dict[str, Callable[[], float]] = {
        "n_words": lambda: np.log1p(n), "mean_word": lambda: len(joined) / n, "distinct": lambda: len(set(words)) / n, "symbols": lambda: share(but(b"#*$%&<>"), n),
        "bangs": lambda: share(joined.count(b"!!"), n), "pipes": lambda: share(joined.count(b"|"), n), "upper": lambda: share(but(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), len(joined)),
        "digits": lambda: share(but(b"0123456789"), len(joined)), "window_repeats": lambda: share(n - 2 - len(set(zip(words, words[1:], words[2:]))), n - 2) if n > 2 else 0.0, "line_repeats": lines,
    }
    return np.array([m[k]() for k in names])


def measurements(texts: list[str | None], names: tuple[str, ...]) -> list[np.ndarray]:
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts] if names else []
    return [dense(r, r.split(), names) for r in raw] if names else [np.zeros(0)] * len(texts)


def inputs(texts: list[str | None], config: Config) -> list[tuple[np.ndarray, np.ndarray]]:
    """(hashed features, measurements) of each text."""
    found = hash_each(texts, config.shapes) if config.hashed else [np.zeros(0, np.int32)] * len(texts)
    return list(zip(found, measurements(texts, config.dense)))


class Rows:
    """Inputs of many texts in flat arrays."""

    def __init__(self, items: list[tuple[np.ndarray, np.ndarray]]):
        self.sizes = np.array([len(i) for i, _ in items], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.ids = np.concatenate([*(i for i, _ in items), np.zeros(0, np.int32)])
        self.dense = np.stack([d for _, d in items]) if items else np.zeros((0, 0))

    @classmethod
    def of(cls, sizes: np.ndarray, ids: np.ndarray, dense: np.ndarray) -> Rows:
        out = cls([])
        out.sizes, out.starts, out.ids, out.dense = sizes, np.cumsum(sizes) - sizes, ids, dense
        return out

    def take(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        sizes = self.sizes[at]
        ends = np.cumsum(sizes)
        flat = np.repeat(self.starts[at] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)
        return self.ids[flat], np.repeat(np.arange(len(at)), sizes), self.dense[at]


def _softplus(x: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, x)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def risk(fp: np.ndarray, fu: np.ndarray, prior: float | None) -> tuple[float, np.ndarray, np.ndarray]:
    """(non-negative risk, direction of its slope at the positives' scores, and at the others').

    Where the second part is negative, the direction is that of its growth. Prior None: plain classification.
    """
    a, b = 1 / len(fp), 1 / len(fu)
    if prior is None:
        return float(_softplus(-fp).mean() + _softplus(fu).mean()), -_sigmoid(-fp) * a, _sigmoid(fu) * b
    plus, rest = prior * _softplus(-fp).mean(), _softplus(fu).mean() - prior * _softplus(fp).mean()
    rest_p, rest_u = -prior * _sigmoid(fp) * a, _sigmoid(fu) * b
    if rest < 0:
        return float(plus), -rest_p, -rest_u
    return float(plus + rest), rest_p - prior * _sigmoid(-fp) * a, rest_u


def scales(config: Config, measured: np.ndarray) -> np.ndarray:
    """What a text's hashed features are multiplied by."""
    if not config.per_words:
        return np.ones(len(measured))
    n = np.expm1(measured[:, config.dense.index("n_words")])
    return (UNIT / np.maximum(n, FEW)) ** config.per_words


class Linear:
    """Scores of a linear model and their slope: weights are those of the hashed features, of the measurements, and a bias."""

    def __init__(self, n_hashed: int, centre: np.ndarray, scale: np.ndarray, config: Config = Config(hashed=True)):
        self.hashes, self.centre, self.scale, self.config = n_hashed, centre, scale, config
        self.size = n_hashed + len(centre) + 1

    def score(self, w: np.ndarray, x: tuple) -> np.ndarray:
        ids, row, dn = x
        f = np.bincount(row, w[ids], len(dn)) * scales(self.config, dn) if self.hashes else np.zeros(len(dn))
        return f + ((dn - self.centre) / self.scale) @ w[self.hashes : -1] + w[-1]

    def slope(self, x: tuple, g: np.ndarray) -> np.ndarray:
        ids, row, dn = x
        out = np.zeros(self.size)
        if self.hashes:
            out[: self.hashes] = np.bincount(ids, (g * scales(self.config, dn))[row], self.hashes)
        out[self.hashes : -1] = g @ ((dn - self.centre) / self.scale)
        out[-1] = g.sum()
        return out


def fit(positive: Rows, unlabelled: Rows, config: Config, prior: float | None) -> Model:
    """Minimise the non-negative risk; prior None: plain classification of positive against unlabelled.

    Only hashed features that occur in the rows are trained; the others' weights are 0.
    """
    rng = np.random.default_rng(config.seed)
    both = np.concatenate([positive.dense, unlabelled.dense])
    used = np.unique(np.concatenate([positive.ids, unlabelled.ids]))
    positive, unlabelled = (Rows.of(r.sizes, np.searchsorted(used, r.ids), r.dense) for r in (positive, unlabelled))
    line = Linear(len(used), both.mean(0), both.std(0) + 1e-3, config)
    w, m, v = np.zeros(line.size), np.zeros(line.size), np.zeros(line.size)
    n_p, n_u = len(positive.sizes), len(unlabelled.sizes)
    steps = max(1, -(-n_u // config.batch))
    share = max(1, n_p // steps)
    t = 0
    for epoch in range(config.epochs):
        pu, pp = rng.permutation(n_u), rng.permutation(n_p)
        rate = config.rate * (1 - epoch / config.epochs) + config.rate * 0.05
        for s in range(steps):
            xp, xu = positive.take(pp[s * share : (s + 1) * share] if share * steps <= n_p else pp), unlabelled.take(pu[s::steps])
            _, gp, gu = risk(line.score(w, xp), line.score(w, xu), prior)
            g = line.slope(xp, gp) + line.slope(xu, gu) + config.decay * w
            t += 1
            m = 0.9 * m + 0.1 * g
            v = 0.999 * v + 0.001 * g * g
            w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    whole = np.zeros(HASHES * config.hashed)
    whole[used] = w[: len(used)]
    return Model(config, prior or 0.5, np.concatenate([whole, w[len(used) :]]), float(w[-1]), line.centre, line.scale)


def logits(model: Model, rows: Rows) -> np.ndarray:
    ids, row, dn = rows.take(np.arange(len(rows.sizes)))
    hashes = HASHES * model.config.hashed
    f = np.bincount(row, model.weights[ids], len(dn)) * scales(model.config, dn) if model.config.hashed else np.zeros(len(dn))
    return f + ((dn - model.centre) / model.scale) @ model.weights[hashes:-1] + model.bias


#: Thresholds that the prior is read from are at these shares of the positives, from all down to 40 %.
CUTS = np.linspace(0.0, 0.6, 41)
LEAST_PRIOR = 0.001
#: A text of the sample: whether it is a positive, its half, a hash of its id, features and measurements.
SAMPLE = "positive boolean, half int, at long, ids binary, dense binary"


def estimate_prior(positive: list[np.ndarray], above: Callable[[list[np.ndarray]], tuple[np.ndarray, int]]) -> float:
    """The least share of all documents over share of positives above a threshold.

    `positive` are the positives' scores by each classifier, `above` counts the documents at or above given thresholds
    (one row per classifier), and all documents.
    """
    cuts = [np.quantile(p, CUTS) for p in positive]
    counts, n = above(cuts)
    u = counts / max(1, n)
    p = sum((x[:, None] >= c).sum(0) for x, c in zip(positive, cuts)) / sum(map(len, positive))
    # a standard deviation of either share on top, as the least of many noisy ratios is too low
    spread = np.sqrt(u * (1 - u) / max(1, n)) + u * np.sqrt((1 - p) / p / sum(map(len, positive)))
    return float(np.clip(((u + spread) / p).min(), LEAST_PRIOR, 0.99))


def apart(p: np.ndarray, n_p: int, n_texts: np.ndarray, n: int, config: Config) -> np.ndarray:
    """Which hashed features set positives apart, by the numbers of n_p positives and of all n documents with each."""
    rate = (n_texts + 1) / (n + 2)
    z = (p / n_p - rate) / np.sqrt(rate * (1 - rate) / n_p)
    used = (z >= config.least_z) & (p >= config.least_texts)
    return used | ((z <= -config.least_z) & (rate * n_p >= config.least_texts)) if config.both_ways else used


def mark(positive: list, n_texts: np.ndarray, n: int, config: Config) -> np.ndarray:
    """Which hashed features set positives apart; without this, a few positives are learned by heart.

    `n_texts` tells in how many of all n documents each feature occurs.
    """
    p = np.zeros(HASHES)
    for ids, _ in positive:
        p[np.unique(ids)] += 1
    return apart(p, len(positive), n_texts, n, config)


def train(positive: list, unlabelled: list, config: Config, n_texts: np.ndarray, n: int, above: Callable) -> Model:
    """The prior from two classifiers, each trained on one half and read on the other, then the non-negative risk over all."""

    def fitted(p: list, u: list, prior: float | None) -> Model:
        if config.hashed:
            used = mark(p, n_texts, n, config)
            p, u = ([(ids[used[ids]], d) for ids, d in rows] for rows in (p, u))
        return fit(Rows(p), Rows(u), config, prior)

    halves = [fitted(positive[k::2], unlabelled[k::2], None) for k in (0, 1)]
    scores = [logits(m, Rows(positive[1 - k :: 2])) for k, m in enumerate(halves)]
    prior = estimate_prior(scores, lambda cuts: above(halves, cuts))
    model = fitted(positive, unlabelled, prior)
    if config.above_share:
        rows = Rows(unlabelled)
        found = logits(model, rows)  # weights of features that aren't used are 0, so all features may be counted
        ids, row, _ = rows.take(np.arange(len(rows.sizes)))
        bare = found[np.bincount(row, model.weights[ids] != 0, len(found)) == 0]
        # never more than half the way to texts without any feature that counts
        least = min(0.0, float(bare.max()) / 2) if len(bare) else 0.0
        model.bias -= min(0.0, max(least, float(np.quantile(found, 1 - min(1.0, config.above_share * prior)))))
    return model


def _sample(ids: DataFrame, at_most: int, salt: int) -> DataFrame:
    """At most at_most distinct ids, those with the least hash; all if there are fewer."""
    n = ids.count()
    mark = F.pmod(F.xxhash64(F.lit(salt), "doc_id"), F.lit(1 << 30))
    # some more than needed by a threshold, in which no id is left out for its number of rows
    share = min(1.0, 2 * (at_most + 100) / max(1, n))
    few = ids.withColumn("mark", mark).filter(F.col("mark") < int(share * (1 << 30))).distinct()
    return few.orderBy("mark", "doc_id").limit(at_most).select("doc_id")


def _count_features(docs: DataFrame, config: Config) -> tuple[np.ndarray, int]:
    """(in how many documents each hashed feature occurs, number of documents): one pass, a sum per feature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, n = np.zeros(HASHES + 1, np.int64), 0
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                texts = batch.column("text").slice(at, SLICE).to_pylist()
                doc, found = hash_texts(texts, config.shapes)
                # distinct pairs of text and feature
                pairs = np.sort((doc[:, None] * (HASHES + 1) + found).ravel().astype(np.int32))
                counts += np.bincount(pairs[np.concatenate([[True], pairs[1:] != pairs[:-1]])[: len(pairs)]] % (HASHES + 1), minlength=HASHES + 1)
                n += len(texts)
        counts = counts[:HASHES]
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict({"feature": pa.array([*at.tolist(), -1], pa.int32()), "n": pa.array([*counts[at].tolist(), n], pa.int64())})

    rows = docs.select("text").mapInArrow(run, "feature int, n long").groupBy("feature").agg(F.sum("n").alias("n")).toArrow()
    feature, n = rows["feature"].to_numpy(), rows["n"].to_numpy()
    out = np.zeros(HASHES, np.int64)
    out[feature[feature >= 0]] = n[feature >= 0]
    return out, int(n[feature < 0].sum())


def _views(column: pa.Array, dtype: type) -> list[np.ndarray]:
    """Binary values as arrays over the column's own memory."""
    _, offsets, data = column.buffers()
    cuts = np.frombuffer(offsets, np.int32, len(column) + 1, 4 * column.offset)
    raw, size = memoryview(data) if data is not None else memoryview(b""), np.dtype(dtype).itemsize
    return [np.frombuffer(raw, dtype, (b - a) // size, a) if b > a else np.zeros(0, dtype) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]


def _half(doc_id: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(3), doc_id), F.lit(2)).cast("int")


def _count_above(docs: DataFrame, models: list[Model], cuts: list[np.ndarray]) -> tuple[np.ndarray, int]:
    """(documents at or above each threshold, number of documents): each is scored by the model that hasn't seen its half."""
    scorers = [_scorer(m, False) for m in models]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score, counts, n = [make() for make in scorers], np.zeros(len(CUTS), np.int64), 0
        for batch in batches:
            half, texts = batch.column("half").to_numpy(), batch.column("text")
            for k in (0, 1):
                own = np.flatnonzero(half != k)
                for at in range(0, len(own), SLICE):
                    found = np.array(score[k]([texts[i].as_py() for i in own[at : at + SLICE].tolist()]))
                    counts += (found[:, None] >= cuts[k]).sum(0)
            n += len(half)
        yield pa.RecordBatch.from_pydict({"k": pa.array(range(-1, len(CUTS)), pa.int32()), "n": pa.array([n, *counts.tolist()], pa.int64())})

    half = F.coalesce(_half(F.col("doc_id")), F.lit(0))
    rows = docs.select(half.alias("half"), "text").mapInArrow(run, "k int, n long").groupBy("k").agg(F.sum("n").alias("n")).collect()
    by = {r.k: r.n for r in rows}
    return np.array([by.get(k, 0) for k in range(len(CUTS))]), by.get(-1, 0)


def _turns(rows: pa.Table, config: Config) -> tuple[Column, int]:
    """(which of the sample's texts `interleave` takes: up to a hash for each flag and half, positives of a half; 0 if one has none)."""
    if rows.num_rows > config.max_positive + config.max_unlabelled:
        raise RuntimeError("more texts on the driver than the sample's bounds")
    flags, halves, at = (np.array(rows.column(c).to_pylist(), t) for c, t in (("positive", bool), ("half", np.int32), ("at", np.int64)))
    taken, turns = F.lit(False), 0
    for flag in (False, True):
        own = [np.sort(at[(flags == flag) & (halves == k)]) for k in (0, 1)]
        turns = min(map(len, own))
        for k, found in enumerate(own):
            if len(found):
                taken |= (F.col("positive") == flag) & (F.col("half") == k) & (F.col("at") <= int(found[turns - 1]))
    return taken, turns


def _count_by_half(positive: DataFrame) -> np.ndarray:
    """In how many texts of each half each hashed feature occurs: a sum per feature and half."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(2 * HASHES, np.int64)
        for batch in batches:
            for half, ids in zip(batch.column("half").to_pylist(), batch.column("ids").to_pylist()):
                counts[half * HASHES + np.unique(np.frombuffer(ids, np.int32))] += 1
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict({"feature": pa.array(at, pa.int32()), "n": pa.array(counts[at], pa.int64())})

    rows = positive.select("half", "ids").mapInArrow(run, "feature int, n long").groupBy("feature").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(2 * HASHES, np.int64)
    out[rows["feature"].to_numpy()] = rows["n"].to_numpy()
    return out.reshape(2, HASHES)


def _usable(sample: DataFrame, turns: int, n_texts: np.ndarray, n: int, config: Config) -> DataFrame:
    """The sample with the features that `mark` finds for all its positives or those of a half: what `train` goes by.

    Those are few; all of a text's features are most of what it weighs.
    """
    if not (config.hashed and turns):
        return sample
    counts = _count_by_half(sample.filter("positive"))
    used = np.logical_or.reduce([apart(p, n_p, n_texts, n, config) for p, n_p in ((counts[0], turns), (counts[1], turns), (counts.sum(0), 2 * turns))])
    bits = np.packbits(used)

    def make():
        known = np.unpackbits(bits).astype(bool)

        def run(batch: dict) -> dict:
            each = (np.frombuffer(x, np.int32) for x in batch["ids"])
            return batch | {"ids": [x[known[x]].tobytes() for x in each]}

        return run

    return map_batches(sample, make, SAMPLE)


def learn(docs: DataFrame, labels: DataFrame, label: str, may_learn: Column, config: Config) -> Model | None:
    """A model from labels of the ids that `may_learn` holds for; None without positives."""
    trusted = labels.filter((F.col(label) == 1) & may_learn & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    chosen = _sample(trusted, config.max_positive, 1).withColumn("positive", F.lit(True))
    others = _sample(docs.select("doc_id").filter("doc_id IS NOT NULL"), config.max_unlabelled, 2).withColumn("positive", F.lit(False))
    # ids, bounded by the two parameters, so the join is a broadcast; of an id's rows one stays
    wanted = materialise(chosen.unionByName(others))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(wanted.select("doc_id").distinct()), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"))
    texts = texts.join(F.broadcast(wanted), "doc_id").select("positive", "text", _half(F.col("doc_id")).alias("half"), F.xxhash64("doc_id").alias("at"))

    def make():
        def run(batch: dict) -> dict:
            found = inputs(batch["text"], config)
            return {"positive": batch["positive"], "half": batch["half"], "at": batch["at"], "ids": [i.tobytes() for i, _ in found], "dense": [d.tobytes() for _, d in found]}

        return run

    sample = materialise(map_batches(texts, make, SAMPLE))
    drawn = sample.select("positive", "half", "at").toArrow()
    if min(drawn["positive"].to_pylist().count(flag) for flag in (True, False)) < 2:
        return None
    taken, turns = _turns(drawn, config)
    n_texts, n = _count_features(docs, config) if config.hashed else (np.zeros(0), docs.count())
    rows = _usable(sample.filter(taken), turns, n_texts, n, config).toArrow()
    discard(sample)
    # views of what was received, no copies
    items, flags, halves, at = [], [], [], []
    for batch in rows.to_batches():
        ids, measured = (_views(batch.column(c), t) for c, t in (("ids", np.int32), ("dense", np.float64)))
        items += zip(ids, measured)
        for found, c in ((flags, "positive"), (halves, "half"), (at, "at")):
            found += batch.column(c).to_pylist()
    order = np.lexsort((flags, at)).tolist()
    items, flags, halves = ([x[i] for i in order] for x in (items, flags, halves))
    positive, unlabelled = (interleave([[x for x, p, h in zip(items, flags, halves) if p == want and h == k] for k in (0, 1)]) for want in (True, False))
    model = train(positive, unlabelled, config, n_texts, n, lambda models, cuts: _count_above(docs, models, cuts))
    # the sample's memory goes back to the system, not to the pool that received it
    del rows, batch, ids, measured, items, positive, unlabelled
    pa.default_memory_pool().release_unused()
    return model


def interleave(halves: list[list]) -> list:
    """Texts of the two halves by turns, as long as both last, so that every second one is of the same half."""
    n = min(map(len, halves))
    return [x for pair in zip(*halves) for x in pair] if n else [x for h in halves for x in h]


def _scorer(model: Model | None, squash: bool = True) -> Callable[[], Callable[[list], list[float]]]:
    """What a task calls once for its scoring function. Only weights that aren't zero go to the tasks, a few hundred."""
    if model is None:
        return lambda: lambda texts: [0.0] * len(texts)
    hashes, names, shapes = HASHES * model.config.hashed, model.config.dense, model.config.shapes
    used = np.flatnonzero(model.weights[:hashes])
    values = model.weights[used]
    wd = model.weights[hashes:-1] / model.scale
    offset = model.bias - float(wd @ model.centre)
    config = model.config

    def make():
        weights = np.zeros(HASHES + 1)
        weights[used] = values

        def run(texts: list) -> list[float]:
            f, measured = np.full(len(texts), offset), np.array(measurements(texts, names)).reshape(len(texts), -1)
            if hashes:
                doc, found = hash_texts(texts, shapes)
                f += np.bincount(doc, weights[found].sum(1), len(texts)) * scales(config, measured)
            if len(wd):
                f += measured @ wd
            return (_sigmoid(f) if squash else f).tolist()

        return run

    return make


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """documents -> doc_id, score."""
    scorer = _scorer(model)

    def make():
        run = scorer()
        return lambda batch: {"doc_id": batch["doc_id"], "score": run(batch["text"])}

    return map_batches(docs.select("doc_id", "text"), make, "doc_id long, score double")


def keep(docs: DataFrame, model: Model | None, least: float = 0.5) -> DataFrame:
    """The documents with a score of at least `least`, all columns as they were; without a model all stay."""
    if model is None:
        return docs
    scorer = _scorer(model)

    def make():
        run = scorer()
        return lambda batch: {name: run(batch["text"])}

    name = fresh(docs, "__score")
    return append_batches(docs, make, f"{name} double", ["text"]).filter(F.col(name) >= least).select(docs.columns)


def fold(modulus: int) -> Column:
    """crc32 of the id as text, by a modulus."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(modulus))


def predict(docs: DataFrame, labels: DataFrame, label: str, modulus: int, held_out: Callable[[Column], Column], config: Config) -> DataFrame:
    """doc_id, held_out, score, predicted for every document, labels learned only from ids that are not held out."""
    model = learn(docs, labels, label, ~held_out(fold(modulus)), config)
    rows = score(docs, model)
    return rows.select("doc_id", held_out(fold(modulus)).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).cast("int").alias("predicted"))


QUALITY = Config(hashed=True, dense=DENSE, shapes=True, both_ways=True, epochs=60)
TOXICITY = Config(hashed=True, dense=("n_words",), epochs=30, rate=0.03, least_z=5.0, per_words=0.5, above_share=0.91)
