"""n-gram Jaccard join over a count-vector R-tree (operator 10).

A document is the set of its distinct k-word shingles (64-bit hashes).  The
tokens are hashed into groups, and the counts per group are a point.  Two sets
share at most the sum of the coordinate minima of their points; the same bound
over the upper corners of two R-tree nodes rules out all pairs below them.

In as many dimensions as texts need, the boxes of an R-tree over the whole
corpus overlap too much to rule out anything, so its top level is a partition
that no linked pair can fall through: sets that link differ in at most D
tokens, so of D + 1 (or more) groups at least one is the same in both.  Sets
that share a group, with its content, meet in a subtree (the most common
shingles are left out of the contents where a set has enough others); a set lies in as many
subtrees as it shares groups.  Subtrees are cut into leaves of ``LEAF`` points
in order of size.  Then:

1. every member is compared with the centre of its leaf and of its subtree, the
   members that lie in most subtrees: if the sum of coordinate minima allows a
   link, the exact intersection decides; the links found so far give parts;
2. in subtrees with members of more than one small part, pairs of leaves whose
   upper corners pass the bound are joined, pairs of points of different parts
   that pass it are kept once, and these verified on the sets;
3. a part of more than ``LARGE`` sets is cut into blocks, and every set outside
   it that shares a subtree with one of its members is compared with all of
   them, exactly and inside tasks: the few members of a large group that no
   centre reaches cost no pairs as rows.

A point has about one group for every eight tokens, so that the bound tells
long texts apart as well as short ones; points of different detail are
compared in the coarser.  Only the sets of documents in pairs that pass the
bound are ever moved.

Equal sets are one point, so copies cost nothing after the first pass.  A
group of m near copies costs m checks if its centre links them; only points of
different parts are ever paired, never all pairs of a group.

Defined results: null, empty and blank texts have an empty set and link with
nothing; a text of fewer than k words is one shingle; rows that repeat a
doc_id are rows of their own; a null doc_id is never a component's name unless
no member has another; an empty table gives no rows; other columns are
ignored.  Rows are numbered once, in a stored copy.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import frequent
from .components import components
from .set_blocks import asked_of_large, links_with_large
from .tables import batches_of, numbered, rows_of, stored
from .words import UnitCache

GROUPS = 64  # of the corners; a point has as many or more
LEAF = 64
LARGE = 64  # sets of a part from which on it is met as a whole
TEXTS, SIGNED = 500, 2500  # texts, or texts and signatures, in a batch
BATCH = 128  # leaves, or pairs of sets, in a task's memory at once
COMMON, COMMON_ROWS, COMMON_SEEN = 1 << 18, 8000, 4
MARKS = 1 << 23  # bits that tell which texts a step may want
_U = np.uint64
_ODD = [_U(x) for x in np.random.default_rng(7).integers(1, 1 << 63, 64, np.uint64) * _U(2) + _U(1)]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingle_set(text: str | None, k: int, cache: dict) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's k-word shingles."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))
    if len(h) < k:
        return _mix(np.array([sum(int(x) * int(_ODD[i]) for i, x in enumerate(h)) + len(h) & 0xFFFFFFFFFFFFFFFF], np.uint64))
    n = len(h) - k + 1
    total = np.full(n, _U(k))
    for i in range(k):
        total += h[i:i + n] * _ODD[i]
    return np.unique(_mix(total))


class Limit:
    """Jaccard of at least num / den, in whole numbers."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.starts = [1]
        while self.starts[-1] < 1 << 40:
            self.starts.append(max(self.starts[-1] + 1, -(-self.starts[-1] * den // num)))

    def linked(self, common: int, a: int, b: int) -> bool:
        return self.den * common >= self.num * (a + b - common)

    def least_common(self, a, b):
        """Fewest common tokens of linked sets of these sizes."""
        return -(-self.num * (a + b) // (self.num + self.den))

    def band(self, n: int) -> int:
        return bisect_right(self.starts, n) - 1

    def groups(self, band: int) -> tuple[int, int]:
        """Groups for pairs whose larger set lies in a band, and how many of
        them may be empty in a set that signs by its other groups alone (more
        than in most); no groups if only equal sets link."""
        differ = 2 * (self.starts[band + 1] - 1) * (self.den - self.num) // (self.den + self.num)
        if not differ:
            return 0, 0
        count = differ + 1
        for _ in range(3):
            mean = self.starts[max(band - 1, 0)] / count
            spare = 2 + math.ceil(1.5 * count * math.exp(-mean))
            count = differ + 1 + spare
        return count, spare


def _signed_groups(tokens: np.ndarray, count: int, spare: int, salt: int, fall_back: bool) -> tuple[np.ndarray, bool]:
    """Hashes of (salt, group, content) of the groups that hold tokens, and
    whether more than ``spare`` are empty; these sign as well if so and
    ``fall_back``."""
    group = tokens % _U(count)
    order = np.argsort(group.astype(np.uint16) if count < 65536 else group, kind="stable")
    group = group[order]
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else np.empty(0, np.int64)
    content = np.add.reduceat(_mix(tokens ^ _U(0x9E3779B97F4A7C15))[order], first) if len(group) else np.empty(0, np.uint64)
    present = group[first]
    many_empty = count - len(present) > spare
    if many_empty and fall_back:
        missing = np.setdiff1d(np.arange(count, dtype=np.uint64), present)
        present, content = np.r_[present, missing], np.r_[content, np.zeros(len(missing), np.uint64)]
    return _mix(content + _mix(present + _U(salt << 40))), many_empty


def signatures(tokens: np.ndarray, limit: Limit, common: np.ndarray) -> np.ndarray:
    """What linked sets that differ have in common at least once.

    Groups are compared without the tokens of ``common`` (any sorted set will
    do), so that a passage that many documents share does not make a group
    equal by itself.  Sets of which too much is common sign again with all
    their tokens: of two linked sets, either one has enough groups without
    them, or both have signed again."""
    out, band = [], limit.band(len(tokens))
    at = np.searchsorted(common, tokens)
    at[at == len(common)] = 0
    own = tokens[common[at] != tokens] if len(common) else tokens
    for b in (band, band + 1):
        count, spare = limit.groups(b)
        if count:
            sigs, mostly_common = _signed_groups(own, count, spare, 2 * b, False)
            out.append(sigs)
            if mostly_common:
                out.append(_signed_groups(tokens, count, spare, 2 * b + 1, True)[0])
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def _set_id(tokens: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(tokens.tobytes())).astype(np.int64))


def _word_cache() -> UnitCache:
    return UnitCache(xxhash.xxh3_64_intdigest, 200_000)


def _table(schema: list[tuple[str, pa.DataType]], *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, schema, strict=True)], [n for n, _ in schema])


def _sizes(k: int):
    fields = [("uid", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()), ("sid", pa.int64()), ("point", pa.binary())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _word_cache()
        for batch in batches:
            sets = [shingle_set(t.as_py(), k, cache) for t in batch.column("text")]
            yield _table(fields, batch.column("uid"), batch.column("doc_id"), [len(s) for s in sets], [_set_id(s) for s in sets],
                         [_stored_point(_point(s)) for s in sets])
    return run


def _signed(k: int, limit: Limit, common):
    fields = [("sig", pa.int64()), ("sid", pa.int64()), ("n", pa.int64())]

    def pack(rows):
        if not rows:
            return _table(fields, [], [], [])
        times = [len(s) for s, _, _ in rows]
        columns = [np.repeat(np.array([r[i] for r in rows], np.int64), times) for i in (1, 2)]
        return _table(fields, np.concatenate([s for s, _, _ in rows]).view(np.int64), *columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, seen = _word_cache(), set()
        for batch in batches:
            rows, held = [], 0
            for t in batch.column("text"):
                tokens = shingle_set(t.as_py(), k, cache)
                sid = _set_id(tokens)
                if sid in seen or not len(tokens):
                    continue  # a copy within this task: the same rows again
                if len(seen) > 1_000_000:
                    seen.clear()
                seen.add(sid)
                rows.append((signatures(tokens, limit, common.value), sid, len(tokens)))
                held += len(rows[-1][0])
                if held > 200_000:
                    yield pack(rows)
                    rows, held = [], 0
            yield pack(rows)
    return run


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Leaves of the subtrees with two members or more, from rows sorted by
    sig, n, sid.  Subtrees of one leaf are named by their members."""
    fields = [("cell", pa.int64()), ("leaf", pa.int64()), ("members", pa.list_(pa.int64()))]
    state = {"sig": None, "leaf": 0, "held": []}
    out: list[tuple] = []

    def close():
        held = state["held"]
        if len(held) > 1 or (held and state["leaf"]):
            cell = state["sig"] if state["leaf"] else _set_id(np.array(held, np.int64))
            out.append((cell, state["leaf"], held))

    for batch in batches:
        sig, sid = batch.column("sig").to_numpy(), batch.column("sid").to_numpy()
        pair = np.r_[False, (sig[1:] == sig[:-1]) & (sid[1:] != sid[:-1])] if len(sig) else np.empty(0, bool)
        use = pair | np.r_[pair[1:], False]
        if len(sig):
            use[0] = use[-1] = True
        for g, m in zip(sig[use].tolist(), sid[use].tolist(), strict=True):
            if g != state["sig"]:
                close()
                state.update(sig=g, leaf=0, held=[])
            elif state["held"] and state["held"][-1] == m:
                continue
            elif len(state["held"]) >= LEAF:
                out.append((g, state["leaf"], state["held"]))
                state.update(leaf=state["leaf"] + 1, held=[])
            state["held"].append(m)
        if len(out) > 10_000:
            yield _table(fields, *([r[i] for r in out] for i in range(3)))
            out.clear()
    close()
    yield _table(fields, *([r[i] for r in out] for i in range(3)))


def _tokens(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _word_cache()
        for batch in batches:
            sets = [shingle_set(t.as_py(), k, cache).tobytes() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("sid"), pa.array(sets, pa.large_binary()).cast(pa.binary())], ["sid", "tokens"])
    return run


def _point(tokens: np.ndarray) -> np.ndarray:
    """Counts of tokens per group; the number of groups is a power of two."""
    groups = max(GROUPS, 1 << max(len(tokens) // 8, 1).bit_length())
    return np.bincount((tokens >> _U(7)).astype(np.int64) & (groups - 1), minlength=groups).astype("<i4")


def _stored_point(point: np.ndarray) -> bytes:
    """Counts in as few bytes as they need, after a byte that tells how many."""
    width = next(w for w in (1, 2, 4) if point.max() < 1 << 8 * w)
    return bytes([width]) + point.astype(f"<u{width}").tobytes()


def _read_point(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype("<i4")


def _folded(point: np.ndarray, groups: int) -> np.ndarray:
    return point.reshape(-1, groups).sum(axis=0)


def _overlap_bound(a: np.ndarray, b: np.ndarray) -> int:
    groups = min(len(a), len(b))
    return int(np.minimum(_folded(a, groups), _folded(b, groups)).sum())


def _common(a: np.ndarray, b: np.ndarray) -> int:
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def _verified(limit: Limit):
    """Pairs (a, b) with both sets: those that link."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for mine, other in zip(batch.column("a_tokens"), batch.column("b_tokens"), strict=True):
                x, y = np.frombuffer(mine.as_buffer(), np.uint64), np.frombuffer(other.as_buffer(), np.uint64)
                found.append(limit.linked(_common(x, y), len(x), len(y)))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(found, pa.bool_()))
    return run


def _mark(uid: np.ndarray) -> np.ndarray:
    return (_mix(uid.astype(np.uint64)) & _U(MARKS - 1)).astype(np.int64)


def _marks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        marks = np.unique(_mark(batch.column("uid").to_numpy()))
        yield _table([("byte", pa.int64()), ("bits", pa.int64())], marks >> 3, 1 << (marks & 7))


def _marks(rows: DataFrame) -> np.ndarray:
    """A bitmap of ``MARKS`` bits, that of every uid's hash set: what it does
    not tell apart is left to a join."""
    found = rows.select("uid").mapInArrow(_marks_of, "byte long, bits long").groupBy("byte").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(MARKS // 8, np.uint8)
    out[found["byte"].to_numpy()] = found["bits"].to_numpy()
    return out


def _marked(marks):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = _mark(batch.column("uid").to_numpy())
            yield batch.filter(pa.array((marks.value[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)))
    return run


def _sets(wanted: DataFrame, texts: DataFrame, member: DataFrame, k: int) -> DataFrame:
    """(sid, tokens) of the sets ``wanted`` (sid); few other texts are moved."""
    wanted = stored(wanted.distinct().join(member, "sid").select("uid", "sid"), "wanted")
    marks = texts.sparkSession.sparkContext.broadcast(_marks(wanted))
    marked = texts.select("uid", "text").mapInArrow(_marked(marks), "uid long, text string")
    with batches_of(texts.sparkSession, TEXTS):
        return stored(marked.join(wanted, "uid").select("sid", "text").mapInArrow(_tokens(k), "sid long, tokens binary"), "tokens")


def _verify(pairs: DataFrame, texts: DataFrame, member: DataFrame, k: int, limit: Limit) -> DataFrame:
    """The pairs (a, b) that link; only the texts in them are read as sets."""
    sets = _sets(pairs.select(F.col("a").alias("sid")).union(pairs.select("b")), texts, member, k)
    side = lambda c: sets.select(F.col("sid").alias(c), F.col("tokens").alias(f"{c}_tokens"))
    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(_verified(limit), "a long, b long")


_MEMBERS = "cell long, leaf long, members array<struct<sid:long,w:long,n:long,point:binary>>"
_PAIR = [("a", pa.int64()), ("b", pa.int64())]


def _pairs_of(found: list) -> pa.RecordBatch:
    """Pairs of a batch, each once."""
    a, b = (np.concatenate([p[i] for p in found]) if found else np.empty(0, np.int64) for i in (0, 1))
    once = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
    return _table(_PAIR, once[0], once[1])


def _matrix(members: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, sizes and points (in the detail of the coarsest) of members."""
    points = [_read_point(m["point"]) for m in members]
    groups = min(map(len, points))
    return (np.array([m["sid"] for m in members], np.int64), np.array([m["n"] for m in members], np.int64),
            np.array([_folded(p, groups) for p in points]))


def _may_link(limit: Limit, point, n, points, sizes) -> np.ndarray:
    need = limit.least_common(n, sizes)
    at = np.flatnonzero(np.minimum(sizes, n) >= need)
    groups = min(len(point), points.shape[1])
    mine, others = _folded(point, groups), points[at].reshape(len(at), points.shape[1] // groups, groups).sum(axis=1)
    return at[np.minimum(mine, others).sum(axis=1) >= need[at]]


def _stars(limit: Limit):
    """Members that may link with the centre of their leaf, or of the subtree."""
    def near(members):
        sid, n, points = _matrix(members)
        centre = max(range(len(members)), key=lambda i: (members[i]["w"], members[i]["sid"]))
        at = _may_link(limit, points[centre], n[centre], points, n)
        at = at[at != centre]
        return sid[at], np.full(len(at), sid[centre])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _pairs_of([near(m) for m in batch.column("members").to_pylist()])
    return run


def _corners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Leaves with the upper corner of their box and their smallest set."""
    for batch in batches:
        held = [_matrix(m) for m in batch.column("members").to_pylist()]
        corner = [_folded(points.max(axis=0), GROUPS) if len(points) else [] for _, _, points in held]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([n.min() for _, n, _ in held], pa.int64()), pa.array(corner, pa.list_(pa.int64()))],
                                         [*batch.schema.names, "least_n", "corner"])


def _part_of(members: list[dict], parts: list[dict]) -> np.ndarray:
    part = {p["sid"]: p["part"] for p in parts}
    return np.array([part[m["sid"]] for m in members], np.int64)


def _leaf_pairs(limit: Limit):
    """Pairs of points of different parts that may link."""
    def near(row):
        same = row["left_leaf"] == row["right_leaf"]
        (a, n_a, left), (b, n_b, right) = (_matrix(row[f"{side}_members"]) for side in ("left", "right"))
        part_a, part_b = (_part_of(row[f"{side}_members"], row[f"{side}_parts"]) for side in ("left", "right"))
        need = limit.least_common(n_a[:, None], n_b[None])
        use = (part_a[:, None] != part_b[None]) & (np.minimum(n_a[:, None], n_b[None]) >= need)
        i, j = np.nonzero(np.triu(use, 1) if same else use)
        for groups in (GROUPS, min(left.shape[1], right.shape[1])):  # coarse first, then in detail
            x, y = (p.reshape(len(p), p.shape[1] // groups, groups).sum(axis=1, dtype=np.int32) for p in (left, right))
            bound = [np.minimum(x[i[c:c + 1024]], y[j[c:c + 1024]]).sum(axis=1) for c in range(0, len(i), 1024)]
            keep = np.concatenate(bound) >= need[i, j] if bound else np.empty(0, bool)
            i, j = i[keep], j[keep]
        return a[i], b[j]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _pairs_of([near(row) for row in batch.to_pylist()])
    return run


def _listed(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _word_cache()
        for batch in batches:
            for t in batch.column("text"):
                yield pa.RecordBatch.from_arrays([pa.array(shingle_set(t.as_py(), k, cache).view(np.int64))], ["token"])
    return run


def common_shingles(texts: DataFrame, rows: DataFrame, k: int) -> np.ndarray:
    """Shingles that several of about ``COMMON_ROWS`` rows share; it takes no
    more than ``COMMON`` of them.  They only spare work: links do not depend on
    which shingles are here."""
    n = rows.count()
    some = texts.where(F.pmod(F.xxhash64("uid"), F.lit(1 << 20)) < int((1 << 20) * min(1.0, COMMON_ROWS / max(n, 1))))
    seen = some.select("text").mapInArrow(_listed(k), "token long").groupBy("token").agg(F.count("*").alias("n"))
    with batches_of(texts.sparkSession, TEXTS):
        seen = stored(seen.where(F.col("n") >= COMMON_SEEN), "seen")
    top = frequent(seen, COMMON).select("token").toArrow()
    return np.sort(top["token"].to_numpy().view(np.uint64))


def _links(texts: DataFrame, rows: DataFrame, k: int, limit: Limit) -> DataFrame:
    """Edges (a, b) between ids of different sets, enough to connect all that
    are connected by links."""
    common = texts.sparkSession.sparkContext.broadcast(common_shingles(texts, rows, k))
    signed = texts.select("text").mapInArrow(_signed(k, limit, common), "sig long, sid long, n long")
    cells = signed.repartition("sig").sortWithinPartitions("sig", "n", "sid").mapInArrow(_cells, "cell long, leaf long, members array<long>")
    with batches_of(texts.sparkSession, SIGNED):
        cells = stored(cells.distinct(), "cells")
    placed = cells.select("cell", "leaf", F.explode("members").alias("sid"))
    weight = stored(placed.groupBy("sid").agg(F.count("*").alias("w")), "weights")
    member = rows.where("n > 0").groupBy("sid").agg(F.min("uid").alias("uid"))
    point = stored(weight.join(member, "sid").join(rows.select("uid", "n", "point"), "uid").select("sid", "w", "n", "point"), "points")

    # subtrees of several leaves: their centre joins every leaf
    several = placed.join(stored(cells.where("leaf > 0").select("cell").distinct(), "several"), "cell", "left_semi")
    centre = stored(several.join(weight, "sid").groupBy("cell").agg(F.max(F.struct("w", "sid"))["sid"].alias("sid")), "centres")
    placed = placed.union(cells.select("cell", "leaf").join(centre, "cell").select("cell", "leaf", "sid")).distinct()
    leaves = stored(placed.join(point, "sid").groupBy("cell", "leaf").agg(
        F.collect_list(F.struct("sid", "w", "n", "point")).alias("members")), "leaves")  # LEAF + 1 at most
    with batches_of(texts.sparkSession, BATCH):
        stars = stored(leaves.mapInArrow(_stars(limit), "a long, b long").distinct(), "stars")
        linked = stored(_verify(stars, texts, member, k, limit), "star-links")

    parts = stored(components(linked), "star-parts")
    split = placed.join(parts, placed["sid"] == parts["node"], "left").select("cell", "leaf", "sid", F.coalesce("component", "sid").alias("part"))
    split = stored(split, "split")
    large = stored(parts.groupBy("component").agg(F.count("*").alias("m")).where(F.col("m") > LARGE).select(F.col("component").alias("target")), "large")
    few = stored(split.join(large, F.col("part") == F.col("target"), "left_anti"), "small-parts")
    mixed = stored(few.groupBy("cell").agg(F.min("part").alias("x"), F.max("part").alias("y")).where("x != y").select("cell"), "mixed")
    grouped = few.join(mixed, "cell").join(point, "sid").groupBy("cell", "leaf").agg(  # LEAF + 1 at most
        F.collect_list(F.struct("sid", "w", "n", "point")).alias("members"), F.collect_list(F.struct("sid", "part")).alias("parts"))
    with batches_of(texts.sparkSession, BATCH):
        boxes = stored(grouped.mapInArrow(
            _corners, f"{_MEMBERS}, parts array<struct<sid:long,part:long>>, least_n long, corner array<long>"), "boxes")
        sides = [boxes.select("cell", *(F.col(c).alias(f"{side}_{c}") for c in ("leaf", "members", "parts", "least_n", "corner")))
                 for side in ("left", "right")]
        overlap = F.aggregate(F.zip_with("left_corner", "right_corner", lambda x, y: F.least(x, y)), F.lit(0).cast("long"), lambda s, x: s + x)
        need = F.ceil((F.col("left_least_n") + F.col("right_least_n")) * limit.num / (limit.num + limit.den))
        pairs = sides[0].join(sides[1], "cell").where("left_leaf <= right_leaf").where(overlap >= need)
        pairs = stored(pairs.mapInArrow(_leaf_pairs(limit), "a long, b long").distinct(), "pairs")
        more = stored(_verify(pairs, texts, member, k, limit), "more-links")
    # every set that shares a subtree with a large part, and is not in it, meets the whole part
    asked = asked_of_large(split.select(F.col("cell").alias("place"), F.col("sid").alias("node"), "part"), large)
    owned = parts.join(large, F.col("component") == F.col("target")).select("target", "node")
    sets_of = lambda wanted: _sets(wanted.withColumnRenamed("node", "sid"), texts, member, k).withColumnRenamed("sid", "node")
    met = links_with_large(asked, owned, point.select(F.col("sid").alias("node"), "n"), sets_of, limit)
    return linked.unionByName(more).unionByName(met)


def _texts(docs: DataFrame, uid: str) -> DataFrame:
    return docs.select(F.col(uid).alias("uid"), F.col("doc_id").cast("long").alias("doc_id"), "text")


def jaccard_components(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One row per row of ``docs``: uid (the row's number in the scan), doc_id,
    n_shingles, component_id (least doc_id of the component), first (this row
    is the one that stays of its component)."""
    return _components_of(_texts(*numbered(docs.select("doc_id", "text"))), k, num, den)


def _components_of(texts: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    limit = Limit(num, den)
    with batches_of(texts.sparkSession, TEXTS):
        rows = stored(texts.mapInArrow(_sizes(k), "uid long, doc_id long, n long, sid long, point binary"), "sets")
    parts = components(_links(texts, rows, k, limit))
    alone = F.col("n") == 0
    named = rows.join(parts, rows["sid"] == parts["node"], "left").select(
        "uid", "doc_id", "n", alone.alias("alone"),
        F.when(alone, F.col("uid")).otherwise(F.coalesce("component", "sid")).alias("part"))
    named = stored(named, "parts")
    least = stored(named.groupBy("alone", "part").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "uid")).alias("least")), "least")
    return named.join(least, ["alone", "part"]).select(
        "uid", "doc_id", F.col("n").alias("n_shingles"), F.col("least.doc_id").alias("component_id"),
        (F.col("uid") == F.col("least.uid")).alias("first"))


def drop_near_copies(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` that stay, one of each component, all columns."""
    rows, uid = numbered(docs)
    return rows_of(rows, uid, _components_of(_texts(rows, uid), **settings).where("first"))
