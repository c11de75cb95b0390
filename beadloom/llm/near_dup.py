"""Near-duplicate documents by HyperMinHash, with links confirmed on full shingle sets.

1. Each document becomes a set of 64-bit hashes of five-word shingles; equal sets fall into one class, of which one
   representative goes on.
2. The hashes are dealt into buckets; a bucket's minimum is kept as a register of leading-zero count and mantissa
   bits. Empty buckets borrow from others. Bands of registers are keys; documents that share a key are candidates.
3. Each representative goes to the group of the leader (the least id of a key) that it shares most keys with. A group,
   in blocks that the leader's text is copied to, is linked in its tasks: the collision-corrected estimate of registers
   sorts out pairs, the others are confirmed on whole sets, unless earlier links connect the two already.
4. Keys whose documents are by then neither all connected nor all compared are gone through pair by pair, in blocks,
   with the same test; pairs of one component, of one block of step 3, or of an earlier common key are skipped.
   So no list of pairs is ever made, and documents meet only through a key that they share.
5. Components of the confirmed links, by alternating large-star and small-star steps.

Defined cases: null and empty texts, and texts without words, have empty sets and are linked with nothing; texts of any
length are taken whole (blocks are bounded by shingles as well as by documents; one text alone may exceed a block);
repeated rows and repeated doc_ids give a row each (equal ids belong together by what their texts link to); a row with a
null doc_id is linked with rows of an equal set only, is never a component's name, and is kept only if no row with an id
has its set; other columns are ignored; an empty table gives an empty result. Ties between leaders go to the least id.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SegmentCache, append_batches, attach, discard, fresh, map_batches, materialise

WORDS = 5
#: Links need 100 * intersection >= PERCENT * union.
PERCENT = 85
BUCKETS = 128
BUCKET_BITS = 7
MANTISSA = 10
#: Bands of ROWS registers. Two sets of likeness 0.85 share none of them once in two million pairs.
BANDS, ROWS = 25, 5
#: Sets of fewer shingles reach 85 % only if they are equal: 5 of 6 are 83 %, 6 of 7 are 86 %.
LEAST = 6
#: Documents and shingles of a block, about; a task compares at most two blocks.
BLOCK, BLOCK_SHINGLES = 128, 1 << 20
#: Estimates this many standard deviations below the threshold are not verified.
SIGMAS = 5.0

_P = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD)]


@lru_cache(maxsize=1)
def _words() -> SegmentCache:
    return SegmentCache(xxhash.xxh3_64_intdigest, 250_000)


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles. Only A-Z is lower-cased, only six ASCII characters part words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    h = np.array(list(map(_words().__getitem__, words)), np.uint64)
    k = min(n, WORDS)
    with np.errstate(over="ignore"):
        x = np.full(n - k + 1, k, np.uint64)
        for i in range(k):
            x = (x ^ h[i : n - k + 1 + i]) * _P[i]
            x ^= x >> np.uint64(31)
        x *= _P[0]
        x ^= x >> np.uint64(29)
    return np.unique(x)


@lru_cache(maxsize=1)
def _donors() -> np.ndarray:
    """For each try, the bucket that an empty one looks at."""
    return np.random.default_rng(7).integers(0, BUCKETS, (96, BUCKETS))


def registers(hashes: np.ndarray) -> tuple[np.ndarray, int]:
    """(registers as leading-zero count and mantissa bits, number of buckets with hashes of their own)."""
    starts = np.arange(BUCKETS, dtype=np.uint64) << np.uint64(64 - BUCKET_BITS)
    at = np.searchsorted(hashes, starts)
    low = hashes[np.minimum(at, len(hashes) - 1)]
    own = (at < len(hashes)) & ((low >> np.uint64(64 - BUCKET_BITS)) == np.arange(BUCKETS, dtype=np.uint64))
    fraction, exponent = np.frexp((low << np.uint64(BUCKET_BITS)).astype(np.float64))
    out = ((64 - exponent) << MANTISSA | ((fraction * (2 << MANTISSA)).astype(np.int64) & ((1 << MANTISSA) - 1))).astype(np.uint16)
    n = int(own.sum())
    empty = np.flatnonzero(~own)
    for donors in _donors():
        if not len(empty):
            break
        found = own[donors[empty]]
        out[empty[found]] = out[donors[empty[found]]]
        empty = empty[~found]
    if len(empty):  # next bucket with hashes, going round
        full = np.flatnonzero(own)
        out[empty] = out[full[np.searchsorted(full, empty) % n]]
    return out, n


def band_keys(reg: np.ndarray) -> list[int]:
    return [xxhash.xxh3_64_intdigest(reg[i * ROWS : (i + 1) * ROWS].tobytes(), i) - (1 << 63) for i in range(BANDS)]


def estimate(agree: np.ndarray) -> np.ndarray:
    """Jaccard likeness from the share of equal registers, less the share that is equal by chance.

    Unequal minima of a bucket fall on one register if leading zeros and mantissa agree: about 1/3 of the pairs have
    equal zeros, and of those one in 2^MANTISSA an equal mantissa.
    """
    chance = 1 / (3 << MANTISSA)
    return (agree - chance) / (1 - chance)


def _digest(s: np.ndarray) -> bytes | None:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None


def sketch(docs: DataFrame) -> DataFrame:
    """documents -> doc_id, n_shingles, digest (null for an empty set), bands (null for sets too small to differ)."""

    def make():
        def run(batch: dict) -> dict:
            out: dict[str, list] = {"doc_id": batch["doc_id"], "n_shingles": [], "digest": [], "bands": []}
            for text in batch["text"]:
                s = shingles(text)
                out["n_shingles"].append(len(s))
                out["digest"].append(_digest(s))
                out["bands"].append(band_keys(registers(s)[0]) if len(s) >= LEAST else None)
            return out

        return run

    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), make, "doc_id long, n_shingles long, digest binary, bands array<long>")


def _settled(edges: DataFrame) -> bool:
    """Whether each u has one edge, and no v has any: the edges are stars of whole components."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(edges.select(F.col("v").alias("x"), F.lit(0).alias("out"), F.lit(1).alias("into")))
    return ends.groupBy("x").agg(F.sum("out").alias("out"), F.max("into").alias("into")).filter("out > 1 OR (out > 0 AND into > 0)").isEmpty()


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One large-star or small-star step over edges u > v."""
    rows = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = materialise(rows.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")))
    total = least.agg(F.sum("n")).first()[0] or 0
    found = attach(rows, least, "u", "n", total)
    if large:
        new = found.filter("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
    else:
        new = found.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    out = materialise(new.distinct())
    discard(least)
    return out


def components(edges: DataFrame) -> DataFrame:
    """Edges u, v -> id, component (the least id reachable) for every id in an edge.

    Large-star and small-star steps by turns, until each id has one edge, to the least of its component.
    """
    edges = materialise(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    while not _settled(edges):
        half = _star(edges, True)
        new = _star(half, False)
        discard(edges)
        discard(half)
        edges = new
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())


def link(sets: list[np.ndarray], known: list | None = None, apart: Callable[[int], np.ndarray] | None = None, percent: int = PERCENT) -> list[tuple[int, int]]:
    """Links that connect what all links among the sets connect (a spanning forest of their graph).

    Sets of equal `known` names are connected already; `apart(i)` says for the sets behind the i-th which of them
    need no comparison with it.
    """
    n = len(sets)
    regs = [registers(s) for s in sets]
    matrix = np.stack([r for r, _ in regs])
    size = np.array([len(s) for s in sets])
    own = np.array([k for _, k in regs])
    first: dict = {}
    parent = [first.setdefault(k, i) for i, k in enumerate(known)] if known else list(range(n))
    group = np.array(parent)

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    pairs = []
    share = percent / 100
    for i in range(n - 1):
        low, high = np.minimum(size[i], size[i + 1 :]), np.maximum(size[i], size[i + 1 :])
        ok = (100 * low >= percent * high) & (group[i + 1 :] != group[i])
        if apart is not None:
            ok &= ~apart(i)
        j = np.flatnonzero(ok) + i + 1
        near = estimate((matrix[j] == matrix[i]).mean(1))
        # sets of a few shingles have few buckets of their own, and a wide spread
        j, near = (x[near >= share - SIGMAS * np.sqrt(share * (1 - share) / np.minimum(own[i], own[j]))] for x in (j, near))
        pairs.append(np.stack([np.full(len(j), i), j, -(near * 1e6).astype(np.int64)], 1))
    if not pairs:
        return []
    rows = np.concatenate(pairs)
    links = []
    for i, j, _ in rows[np.argsort(rows[:, 2], kind="stable")].tolist():
        a, b = root(i), root(j)
        if a != b:
            both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                parent[b] = a
                links.append((i, j))
    return links


def _links(ids: list, found: list[tuple[int, int]]) -> pa.Table:
    return pa.table({"u": pa.array([ids[i] for i, _ in found], pa.int64()), "v": pa.array([ids[j] for _, j in found], pa.int64())})


def _link_group(table: pa.Table) -> pa.Table:
    return _links(table.column("rep").to_pylist(), link([shingles(t) for t in table.column("text").to_pylist()]))


def _link_key(table: pa.Table) -> pa.Table:
    """Links between the components of a key's documents, or of two blocks of them."""
    rep, hub, home, block = (table.column(c).to_numpy() for c in ("rep", "hub", "home", "block"))
    sets = [shingles(t) for t in table.column("text").to_pylist()]
    keys = np.array([band_keys(registers(s)[0]) for s in sets])
    # pairs that an earlier key has, too, are that key's
    before = int(np.argmax((keys == table.column("band")[0].as_py()).any(0)))
    two = len(set(block.tolist())) > 1

    def apart(i: int) -> np.ndarray:
        rest = slice(i + 1, None)
        out = (home[rest] == home[i]) | (hub[rest] == rep[i]) | (rep[rest] == hub[i]) | (keys[rest, :before] == keys[i, :before]).any(1)
        return out | (block[rest] == block[i]) if two else out

    components_ = table.column("component").to_pylist()
    return _links(components_, link(sets, components_, apart))


def _blocks() -> Column:
    """Number of blocks for n documents with `weight` shingles."""
    return F.ceil(F.greatest(F.col("n") / F.lit(BLOCK), F.col("weight") / F.lit(BLOCK_SHINGLES), F.lit(1.0))).cast("int")


def _parts(df: DataFrame) -> int:
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 12)


def _place(members: DataFrame, sizes: DataFrame) -> DataFrame:
    """Members of keys -> rep, hub, block, blocks: the group of each, and its block there."""
    # equal numbers of shared keys: the least leader
    votes = members.filter("rep <> leader").groupBy("rep", "leader").agg(F.count("*").alias("n"))
    hubs = votes.groupBy("rep").agg(F.max_by("leader", F.struct("n", -F.col("leader"))).alias("hub"))
    placed = materialise(sizes.join(hubs, "rep", "left").select("rep", F.coalesce("hub", "rep").alias("hub"), "n_shingles"))
    groups = materialise(placed.groupBy("hub").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("weight")).withColumn("blocks", _blocks()).drop("weight"))
    found = attach(placed, groups, "hub", "n", placed.count())
    return materialise(found.select("rep", "hub", "n_shingles", "blocks", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int").alias("block")))


def _links_of_groups(texts: DataFrame, placed: DataFrame) -> DataFrame:
    """Links of each block of a group; the leader is in all of its blocks."""
    own = placed.filter("rep <> hub").select("rep", "hub", "block")
    leaders = placed.filter("rep <> hub").groupBy("hub").agg(F.max("blocks").alias("blocks"))
    copies = leaders.select(F.col("hub").alias("rep"), "hub", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    rows = texts.join(own.unionByName(copies), "rep")
    return rows.repartition(_parts(texts), "hub", "block").groupBy("hub", "block").applyInArrow(_link_group, "u long, v long")


def _open_keys(members: DataFrame, known: DataFrame) -> DataFrame:
    """band, rep, hub, home, component, n_shingles of the keys that still have pairs to compare."""
    rows = materialise(members.join(known, "rep"))
    other = F.col("rep") != F.col("leader")
    seen = rows.groupBy("band").agg(
        F.count("*").alias("n"), (F.min("component") == F.max("component")).alias("connected"), F.min("leader").alias("leader"),
        F.min(F.when(other, F.col("home"))).alias("least"), F.max(F.when(other, F.col("home"))).alias("most"),
        F.min(F.when(other, F.col("hub"))).alias("hub"), F.max(F.when(~other, F.col("home"))).alias("at"),
    )
    # one block of a group has all but the leader, which is that group's leader or in the block, too
    compared = (F.col("least") == F.col("most")) & ((F.col("hub") == F.col("leader")) | F.coalesce(F.col("at") == F.col("least"), F.lit(False)))
    open_ = materialise(seen.filter(~F.col("connected") & ~compared).select("band", "n"))
    return materialise(attach(rows.drop("leader"), open_, "band", "n", rows.count()))


def _links_of_keys(texts: DataFrame, rows: DataFrame) -> DataFrame:
    """Links between components within each open key.

    A component with more than BLOCK documents of a key has blocks of its own there, which are never paired with each
    other; the documents of small ones share blocks. Each pair of blocks that is left is a task.
    """
    each = rows.groupBy("band", "component").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("weight"))
    part = each.withColumn("large", F.when(F.col("n") > BLOCK, F.col("component")))
    cuts = part.groupBy("band", "large").agg(F.sum("n").alias("n"), F.sum("weight").alias("weight")).withColumn("blocks", _blocks())
    by_key = Window.partitionBy("band").orderBy(F.col("large").asc_nulls_first())  # a row per large component
    whole = Window.partitionBy("band")
    cuts = cuts.select("band", "large", "blocks", (F.sum("blocks").over(by_key) - F.col("blocks")).alias("from_"), F.sum("blocks").over(whole).alias("all_"))
    names = materialise(part.select("band", "component", "n", "large").alias("p").join(cuts.alias("c"), (F.col("p.band") == F.col("c.band")) & F.col("p.large").eqNullSafe(F.col("c.large"))).select(F.xxhash64("p.band", "p.component").alias("name"), "p.n", "c.large", "blocks", "from_", "all_"))
    found = attach(rows.withColumn("name", F.xxhash64("band", "component")), names, "name", "n", rows.count())
    found = found.withColumn("block", (F.col("from_") + F.pmod(F.xxhash64("rep"), F.col("blocks"))).cast("int"))
    other = F.explode(F.filter(F.sequence(F.lit(0).cast("long"), F.col("all_") - 1), lambda x: F.col("large").isNull() | (x < F.col("from_")) | (x >= F.col("from_") + F.col("blocks")))).alias("other")
    found = found.select("band", "rep", "hub", "home", "component", "block", other).withColumns({"a": F.least("block", "other"), "b": F.greatest("block", "other")})
    found = texts.join(found, "rep").select("band", "a", "b", "rep", "text", "hub", "home", "component", "block")
    return found.repartition(_parts(texts), "band", "a", "b").groupBy("band", "a", "b").applyInArrow(_link_key, "u long, v long")


def _classes(docs: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """(sketches; digest, n, component of each distinct set; number of rows)."""
    sketches = materialise(sketch(docs))
    total = sketches.count()
    classes = materialise(sketches.filter("digest IS NOT NULL AND doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")))
    # an id of several rows stands for the classes of all of them
    reps = sketches.filter("bands IS NOT NULL").select("doc_id", "digest", "bands", "n_shingles").join(classes.select("digest", F.col("rep").alias("doc_id")), ["doc_id", "digest"]).select(F.col("doc_id").alias("rep"), "bands", "n_shingles")
    bands = materialise(reps.select("rep", "n_shingles", F.explode("bands").alias("band")).groupBy("rep", "band").agg(F.max("n_shingles").alias("n_shingles")))
    keys = materialise(bands.groupBy("band").agg(F.min("rep").alias("leader"), F.count("*").alias("n")).filter("n > 1"))
    members = materialise(attach(bands, keys, "band", "n", bands.count()))
    discard(bands)
    placed = _place(members, members.groupBy("rep").agg(F.max("n_shingles").alias("n_shingles")))
    # only texts with candidates go on; of equal rows one
    texts = materialise(docs.select(F.col("doc_id").cast("long").alias("rep"), "text").join(placed.select("rep"), "rep").groupBy("rep", "text").agg(F.lit(1).alias("one")).drop("one"))
    first = materialise(components(materialise(_links_of_groups(texts, placed))))
    known = placed.join(first.select(F.col("id").alias("rep"), "component"), "rep", "left")
    # a leader of one block is in it; that of several blocks is in all, which the comparison of keys knows by its hub
    home = F.when((F.col("rep") == F.col("hub")) & (F.col("blocks") > 1), F.xxhash64("rep", F.lit(-1))).otherwise(F.xxhash64("hub", "block"))
    known = known.select("rep", "hub", home.alias("home"), F.coalesce("component", "rep").alias("component"))
    open_ = _open_keys(members.drop("n"), known)
    second = components(materialise(_links_of_keys(texts, open_)))
    names = classes.join(first.withColumnRenamed("id", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    named = names.join(second.select(F.col("id").alias("component"), F.col("component").alias("least")), "component", "left")
    return sketches, materialise(named.select("digest", "n", F.coalesce("least", "component").alias("component"))), total


def near_duplicates(docs: DataFrame) -> DataFrame:
    """documents -> doc_id, n_shingles, component_id, kept."""
    sketches, named, total = _classes(docs)
    rows = attach(sketches.select("doc_id", "n_shingles", "digest"), named, "digest", "n", total, "left")
    component: Column = F.coalesce("component", "doc_id")
    return rows.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True) & component.isNull()).alias("kept"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents less all but one row of each component: the first by doc_id, of equal ids one row.

    Rows whose id is unique are judged by that id. The rest, with repeated or null ids, are judged by their own sets and
    then brought down to a row per component in a minimum, which combines before the shuffle. Rows without words all stay.
    """
    sketches, named, total = _classes(docs)
    rows = attach(sketches.select("doc_id", "digest"), named, "digest", "n", total, "left")
    key, odd, digest, component = (fresh(docs, x) for x in ("__id", "__odd", "__digest", "__component"))
    ids = rows.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias(key)).agg(F.count("*").alias("n"), F.first(F.coalesce(F.col("component") != F.col("doc_id"), F.lit(False))).alias("drop"))
    judged = materialise(ids.filter("drop OR n > 1").select(key, "n", (F.col("n") > 1).alias(odd)))
    found = attach(docs.withColumn(key, F.col("doc_id").cast("long")), judged, key, "n", total, "left")
    single = found.filter(F.col(odd).isNull() & F.col(key).isNotNull()).select(docs.columns)

    def make():
        return lambda batch: {digest: [_digest(shingles(t)) for t in batch["text"]]}

    rest = append_batches(found.filter(F.col(odd) | F.col(key).isNull()).select(*docs.columns, key), make, f"{digest} binary", ["text"])
    rest = attach(rest, named.withColumnsRenamed({"digest": digest, "component": component}), digest, "n", total, "left")
    empty = rest.filter(F.col(digest).isNull()).select(docs.columns)
    least = rest.filter(F.col(digest).isNotNull() & (F.col(component).isNull() | (F.col(component) == F.col(key))))
    one = least.groupBy(F.coalesce(F.col(component).cast("string"), F.hex(digest)).alias("name")).agg(F.min_by(F.struct(*docs.columns), F.struct(digest, "text")).alias("row")).select("row.*")
    return single.unionByName(empty).unionByName(one)


def miss_rate(likeness: float) -> float:
    """Chance that two sets of a likeness share no band."""
    return math.pow(1 - likeness**ROWS, BANDS)
