"""MinHash near-duplicates with SetSketch registers (operator 13).

A document is the set of its distinct k-word shingles (64-bit hashes).  A
register holds the integer logarithm, to a base ``BASE`` little above 1, of the
smallest of as many exponential variates as the set has members, truncated to
0 .. ``TOP``.  Registers of a union are the maxima of registers, and two sets
agree in a register with a probability of at least their Jaccard similarity J
(nearly equal to it at this base).

1. Registers are taken ``ROWS`` at a time as a band's key, ``BANDS`` bands:
   sets that agree in all registers of a band meet in a bucket.  At J = 0.8 a
   pair misses all buckets with a probability below 2e-8, at J = 0.9 below
   1e-19; that is the only approximation.
2. A bucket's centre is its heaviest member (weight: the sizes of the buckets
   that a set is in), which is near the middle of a group of copies.  It is
   paired with every other member, so a group of m near copies costs about m
   pairs, not their square; the links found give components.
   What is left are buckets with members of several components.  Components of
   at most ``SMALL`` sets meet inside their buckets, in packs of
   members that carry their registers: a task compares packs and gives only
   pairs that step 3 lets pass.  Larger components are cut into blocks of
   sets, and every set of another component that shares a bucket with one is
   compared with all its blocks, exactly and inside tasks, each of which gives
   at most a link for a set.  After that no two sets that share a bucket are
   left uncompared; nothing is capped.
3. A pair's J is estimated by maximum likelihood from the registers in which
   the one, the other or neither set is ahead, given the two known sizes.  A
   pair is dropped here only if the likelihood at the threshold lies
   ``SLACK`` / 2 below the maximum (about seven standard deviations).
4. What is left is verified on the full sets, by exact intersection.

Equal sets (by a 128-bit hash of their members) are one node, named by the
least row number.  Only texts in pairs that pass step 3 are read again.

Defined results: null, empty and blank texts have an empty set and link with
nothing; a text of fewer than k words is one shingle; rows that repeat a
doc_id are rows of their own; a component without any doc_id is named null,
and its rows count as kept; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .jaccard_rtree import Limit, _common, shingle_set
from .set_blocks import asked_of_large, links_with_large, pack_of, packed, side_of
from .tables import batches_of, stored
from .words import UnitCache

BANDS, ROWS = 60, 6
REGISTERS = BANDS * ROWS
BASE, RATE, TOP = 1.001, 20.0, (1 << 16) - 1  # of the registers: b, a and q + 1
SLACK = 50.0
SMALL = 48
BATCH = 256
_MULTIPLY = np.random.default_rng(13).integers(1, 1 << 63, REGISTERS, np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = np.random.default_rng(14).integers(0, 1 << 63, REGISTERS, np.uint64)
SKETCH = "uid long, doc_id long, n long, digest binary, registers binary"


def registers(tokens: np.ndarray) -> np.ndarray:
    """SetSketch registers of a set of 64-bit hashes (not empty)."""
    least = np.full(REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(tokens), 128):
        np.minimum(least, (tokens[at:at + 128, None] * _MULTIPLY + _ADD).min(axis=0), out=least)
    smallest = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**64) / RATE
    smallest = np.maximum(smallest, 1e-300)
    return np.clip(np.floor(1.0 - np.log(smallest) / math.log(BASE)), 0, TOP).astype("<u2")


def _set_of(text: str | None, k: int, cache: UnitCache) -> np.ndarray:
    return shingle_set(text, k, cache)


def _digest(tokens: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(tokens.tobytes())


def _cache() -> UnitCache:
    return UnitCache(xxhash.xxh3_64_intdigest, 200_000)


def _sketches(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, known = _cache(), UnitCache(lambda _: b"", 20_000)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                out = []
                for text in part.column("text"):
                    tokens = _set_of(text.as_py(), k, cache)
                    digest = _digest(tokens)
                    if len(tokens) and not known[digest]:
                        known[digest] = registers(tokens).tobytes()
                    out.append((len(tokens), digest, known[digest]))
                n, digest, regs = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([part.column("uid"), part.column("doc_id"), pa.array(n, pa.int64()), pa.array(digest, pa.binary()),
                                                  pa.array(regs, pa.binary())], ["uid", "doc_id", "n", "digest", "registers"])
    return run


def _ahead(x: np.ndarray) -> np.ndarray:
    """Probability that one set's register is ahead, of the share of the union
    that it has alone."""
    return -np.log1p(-np.clip(x, 0.0, 1.0) * (BASE - 1) / BASE) / math.log(BASE)


def log_likelihood(j, share, ahead, behind, same):
    """Of similarity ``j``, where the first set has ``share`` of the sum of
    both sizes and is ahead, behind or the same in so many registers."""
    more, less = _ahead(share - (1 - share) * j), _ahead((1 - share) - share * j)
    tiny = 1e-12
    return (ahead * np.log(np.maximum(more, tiny)) + behind * np.log(np.maximum(less, tiny))
            + same * np.log(np.maximum(1 - more - less, tiny)))


def estimate(share: np.ndarray, ahead: np.ndarray, behind: np.ndarray, same: np.ndarray) -> np.ndarray:
    """The most likely similarity, by golden section (the likelihood has one
    maximum in j)."""
    low, high = np.zeros(len(share)), np.minimum(share / (1 - share), (1 - share) / share)
    golden = (math.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - golden * (high - low), low + golden * (high - low)
        left = log_likelihood(a, share, ahead, behind, same) >= log_likelihood(b, share, ahead, behind, same)
        low, high = np.where(left, low, a), np.where(left, b, high)
    return (low + high) / 2


def likely(a_regs: np.ndarray, b_regs: np.ndarray, a_n: np.ndarray, b_n: np.ndarray, threshold: float) -> np.ndarray:
    """Pairs whose registers do not rule out a similarity of ``threshold``."""
    share = a_n / (a_n + b_n)
    ahead, behind = (a_regs > b_regs).sum(axis=1), (a_regs < b_regs).sum(axis=1)
    same = REGISTERS - ahead - behind
    found = estimate(share, ahead, behind, same)
    at = np.minimum(threshold, np.minimum(share / (1 - share), (1 - share) / share))
    gap = 2 * (log_likelihood(found, share, ahead, behind, same) - log_likelihood(at, share, ahead, behind, same))
    return (found >= threshold) | (gap <= SLACK)


def _likely(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                regs = [np.frombuffer(b"".join(part.column(f"{x}_registers").to_pylist()), "<u2").reshape(part.num_rows, REGISTERS) for x in "ab"]
                n = [part.column(f"{x}_n").to_numpy().astype(np.float64) for x in "ab"]
                yield part.select(["a", "b"]).filter(pa.array(likely(*regs, *n, threshold)))
    return run


def _tokens(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _cache()
        for batch in batches:
            for text in batch.column("text"):
                tokens = _set_of(text.as_py(), k, cache)
                yield pa.RecordBatch.from_pydict({"digest": [_digest(tokens)], "tokens": [tokens.tobytes()]})
    return run


def _linked(limit: Limit):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for mine, other in zip(batch.column("a_tokens"), batch.column("b_tokens"), strict=True):
                x, y = np.frombuffer(mine.as_buffer(), np.uint64), np.frombuffer(other.as_buffer(), np.uint64)
                found.append(limit.linked(_common(x, y), len(x), len(y)))
            yield batch.select(["a", "b"]).filter(pa.array(found, pa.bool_()))
    return run


def _sizes_allow(limit: Limit, x, y):
    """Whether sets of these sizes can link at all (NumPy or columns)."""
    if isinstance(x, Column):
        return F.lit(limit.den) * F.least(x, y) >= F.lit(limit.num) * F.greatest(x, y)
    return limit.den * np.minimum(x, y) >= limit.num * np.maximum(x, y)


def _verified(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, k: int, limit: Limit) -> DataFrame:
    """The pairs (a, b) that link: by likelihood first, then on the sets."""
    side = lambda c: nodes.select(F.col("node").alias(c), F.col("n").alias(f"{c}_n"), F.col("registers").alias(f"{c}_registers"))
    close = stored(pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(_likely(limit.num / limit.den), "a long, b long"), "likely")
    return _exact(close, nodes, texts, k, limit)


def _sets(wanted: DataFrame, nodes: DataFrame, texts: DataFrame, k: int) -> DataFrame:
    """(node, tokens) of the nodes in ``wanted``, made of their texts again:
    the texts by doc_id (null-safe), then the sets by their digest."""
    wanted = stored(wanted.select("node").distinct().join(nodes.select("node", "digest", "doc_id"), "node"), "wanted")
    key = [F.coalesce("doc_id", F.lit(0)).alias("k1"), F.col("doc_id").isNull().alias("k2")]
    some = texts.select("text", *key).join(wanted.select(*key).distinct(), ["k1", "k2"], "left_semi")
    sets = some.select("text").mapInArrow(_tokens(k), "digest binary, tokens binary")
    return stored(sets.join(wanted.select("digest", "node"), "digest").groupBy("node").agg(F.first("tokens").alias("tokens")), "sets")


def _exact(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, k: int, limit: Limit) -> DataFrame:
    sets = _sets(pairs.select(F.col("a").alias("node")).union(pairs.select("b")), nodes, texts, k)
    side = lambda c: sets.select(F.col("node").alias(c), F.col("tokens").alias(f"{c}_tokens"))
    with batches_of(texts.sparkSession, BATCH):
        return stored(pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(_linked(limit), "a long, b long"), "links")


def _close(held: list[tuple[np.ndarray, ...]], limit: Limit) -> pa.RecordBatch:
    """The pairs that may link, by likelihood, the lesser node first."""
    a, b, *sides = (np.concatenate(x) for x in zip(*held, strict=True))
    ok = likely(*sides, limit.num / limit.den)
    a, b = a[ok], b[ok]
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])


def _close_in_packs(limit: Limit):
    """Two packs of a bucket -> pairs of different components that may link,
    by size and likelihood."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: list[tuple[np.ndarray, ...]] = []  # a, b, registers and sizes of the pairs of several rows
            for row in batch.to_pylist():
                (a, n_a, part_a), (b, n_b, part_b) = pack_of(row, "a"), pack_of(row, "b")
                use = (part_a[:, None] != part_b) & _sizes_allow(limit, n_a[:, None], n_b)
                i, j = np.nonzero(np.triu(use, 1) if row["a_no"] == row["b_no"] else use)
                regs = [np.frombuffer(row[f"{x}_data"], "<u2").reshape(-1, REGISTERS) for x in "ab"]
                for at in range(0, len(i), 4096):
                    x, y = i[at:at + 4096], j[at:at + 4096]
                    held.append((a[x], b[y], regs[0][x], regs[1][y], n_a[x].astype(float), n_b[y].astype(float)))
                    if sum(len(h[0]) for h in held) >= 4096:
                        yield _close(held, limit)
                        held = []
            if held:
                yield _close(held, limit)
    return run


def _band_keys() -> Column:
    width = 2 * ROWS
    return F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)),
                       lambda i: F.xxhash64(i, F.substring(F.col("registers"), i * width + 1, F.lit(width))))


def _buckets(nodes: DataFrame) -> DataFrame:
    """(bucket, node, n) of the buckets of two sets or more."""
    placed = nodes.select("node", "n", F.explode(_band_keys()).alias("bucket"))
    shared = stored(placed.groupBy("bucket").agg(F.count("*").alias("m")).where("m > 1").select("bucket"), "shared")
    return stored(placed.join(shared, "bucket"), "buckets")


def _stars(placed: DataFrame, limit: Limit) -> DataFrame:
    """Pairs of every bucket's heaviest member with its others."""
    size = stored(placed.groupBy("bucket").agg(F.count("*").alias("m")), "bucket-sizes")
    weight = stored(placed.join(size, "bucket").groupBy("node").agg(F.sum("m").alias("w")), "weights")
    heavy = placed.join(weight, "node").groupBy("bucket").agg(F.max(F.struct("w", "node", "n")).alias("c"))
    centre = stored(heavy.select("bucket", F.col("c.node").alias("c_node"), F.col("c.n").alias("c_n")), "centres")
    met = placed.join(centre, "bucket").where((F.col("node") != F.col("c_node")) & _sizes_allow(limit, F.col("n"), F.col("c_n")))
    return met.select(F.least("node", "c_node").alias("a"), F.greatest("node", "c_node").alias("b")).distinct()


def _links(nodes: DataFrame, texts: DataFrame, k: int, limit: Limit) -> DataFrame:
    """Edges between nodes, enough to connect all that links connect."""
    spark = texts.sparkSession
    placed = _buckets(nodes)
    links = _verified(stored(_stars(placed, limit), "stars"), nodes, texts, k, limit)
    parts = stored(components(links), "parts").select(F.col("node").alias("of"), "component")
    members = placed.join(parts, F.col("node") == F.col("of"), "left").select("bucket", "node", "n", F.coalesce("component", "node").alias("part"))
    members = stored(members, "members")
    mixed = members.groupBy("bucket").agg(F.min("part").alias("x"), F.max("part").alias("y")).where("x != y").select("bucket")
    members = stored(members.join(stored(mixed, "mixed"), "bucket"), "mixed-members")
    large = stored(parts.groupBy("component").agg(F.count("*").alias("m")).where(F.col("m") > SMALL).select(F.col("component").alias("target")), "large")

    # sets of small components meet inside their buckets
    few = members.join(large, F.col("part") == F.col("target"), "left_anti").join(nodes.select("node", F.col("registers").alias("data")), "node")
    packs = stored(packed(few.withColumnRenamed("bucket", "key"), 1 << 20), "bucket-packs")
    with batches_of(spark, BATCH):
        met = side_of(packs, "a").join(side_of(packs, "b"), "key").where("a_no <= b_no").mapInArrow(_close_in_packs(limit), "a long, b long")
        pairs = stored(met.distinct(), "pairs")
    links = links.union(_exact(pairs, nodes, texts, k, limit))

    # a set of any component meets the whole of a large one that it shares a bucket with
    asked = asked_of_large(members.withColumnRenamed("bucket", "place"), large)
    owned = parts.join(large, F.col("component") == F.col("target")).select("target", F.col("of").alias("node"))
    return links.union(links_with_large(asked, owned, nodes.select("node", "n"), lambda wanted: _sets(wanted, nodes, texts, k), limit))


def near_duplicates(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles,
    component_id (least doc_id of the component), kept (doc_id is it)."""
    limit = Limit(num, den)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    numbered = texts.withColumn("uid", F.monotonically_increasing_id())  # written once, with all that is joined by it
    rows = stored(numbered.mapInArrow(_sketches(k), SKETCH), "sketches")
    nodes = stored(rows.where("n > 0").groupBy("digest").agg(F.min(F.struct("uid", "doc_id", "n", "registers")).alias("s")).select(
        "digest", F.col("s.uid").alias("node"), "s.doc_id", "s.n", "s.registers"), "nodes")
    parts = stored(components(_links(nodes, texts, k, limit)), "parts")
    named = nodes.join(parts, "node", "left").select("digest", F.coalesce("component", "node").alias("part"))
    named = rows.select("uid", "doc_id", "n", "digest").join(named, "digest", "left").select(
        "doc_id", "n", F.when(F.col("n") > 0, F.col("part")).otherwise(-1 - F.col("uid")).alias("part"))
    named = stored(named, "named")
    least = stored(named.groupBy("part").agg(F.min("doc_id").alias("component_id")), "least")
    return named.join(least, "part").select("doc_id", F.col("n").alias("n_shingles"), "component_id",
                                            F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
