"""Hard negatives from Hilbert-ordered blocks with zone maps (operator 11).

Vectors become integers, floor(256 x); a row's score for an anchor is their
inner product.  An anchor's positives are its first rows of the same label; for
each positive a window of scores is searched for the first rows of any other
label (higher scores first, ties by smaller vec_id).

* Candidates are range-sorted by label and by their place on a Hilbert curve
  through the dimensions of largest variance, and stored in Parquet as blocks
  of at most ``BLOCK`` rows of one label, one row a block, with the least and
  greatest value of every dimension (the zone map, read without the vectors).
  A label or a vector that a third of all rows have is many blocks.
* Anchors are packed in the same order, ``PACK`` to a row.  Interval arithmetic
  on a zone map bounds the scores of its block for an anchor from both sides;
  a block is read for the anchors of a pack with a window that its interval
  meets.  The bound is exact, so no candidate is ever missed.
* Each search reads twice: first the ``SEEDS`` blocks of highest bound for an
  anchor, whose results raise the lower ends of its windows, then all blocks
  that may still hold a better row.  A read gives at most ``TOP`` rows a window.

Packs meet zone maps in groups of about ``ZONES``, keyed by group and one of
``SALTS`` copies, so no task holds all maps and none is broadcast.  In many
dimensions zone maps of unclustered vectors exclude little: the work is then
that of scoring all anchors against all rows, in blocks.

Defined results: rows take no part whose label, vec_id or vector is null or
whose vector holds null or non-finite components; a vector shorter than others
is zero beyond its end; rows that repeat a vec_id are rows of their own, as
anchors and as candidates; an anchor without positives, or a positive without
rows in its window, gives no rows; an empty table gives none; other columns are
ignored.  A score that does not fit 64 bits fails the query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import batches_of, stored

BLOCK, PACK, ZONES, SALTS, SEEDS, TOP = 256, 128, 1024, 16, 4, 5
CURVE_DIMS, CURVE_BITS = 12, 5
FAR = 1 << 62
BATCH = 64  # blocks, or pairs of a pack and a block, in a task's memory at once

_BLOCKS = "block long, label long, n long, ids array<long>, anchors array<boolean>, vectors binary, low array<long>, high array<long>"
_PACKS = "pack long, ids array<long>, labels array<long>, blocks array<long>, places array<int>, vectors binary"
_FOUND = "pack long, anchor int, w int, score long, vec_id long, block long, place int"
_WINDOWS = "array<struct<anchor:int,w:int,low:long,high:long>>"


def hilbert_key(levels: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of points with ``bits`` bits a dimension
    (Skilling's transform from axes to the transposed index, 2004)."""
    x = [levels[:, i].astype(np.int64) for i in range(levels.shape[1])]
    q = 1 << (bits - 1)
    while q > 1:
        for i in range(len(x)):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & (q - 1))
            x[0] = np.where(high, x[0] ^ (q - 1), x[0] ^ swap)
            if i:
                x[i] = x[i] ^ swap
        q >>= 1
    for i in range(1, len(x)):
        x[i] = x[i] ^ x[i - 1]
    flip, q = np.zeros(len(levels), np.int64), 1 << (bits - 1)
    while q > 1:
        flip = np.where((x[-1] & q) != 0, flip ^ (q - 1), flip)
        q >>= 1
    key = np.zeros(len(levels), np.int64)
    for bit in range(bits - 1, -1, -1):
        for axis in x:
            key = (key << 1) | (((axis ^ flip) >> bit) & 1)
    return key


def encode(matrix: np.ndarray) -> bytes:
    """Rows of integers in the narrowest type that holds them, after one byte
    with its width."""
    most = max(int(matrix.max(initial=0)), -int(matrix.min(initial=0)))
    width = 2 if most < 1 << 15 else 4 if most < 1 << 31 else 8
    return bytes([width]) + matrix.astype(f"<i{width}").tobytes()


def decode(data: bytes, rows: int) -> np.ndarray:
    return np.frombuffer(data, f"<i{data[0]}", offset=1).reshape(rows, -1).astype(np.int64)


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact a b' of whole numbers: in doubles while all sums fit them."""
    size = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * a.shape[1]
    if size < 1 << 53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    exact = a.astype(object) @ b.T.astype(object)
    if any(abs(x) >= FAR for x in exact.flat):
        raise OverflowError("a score does not fit 64 bits")
    return exact.astype(np.int64)


def prepared(vectors: DataFrame, anchors: Column) -> DataFrame:
    """The rows that take part: vec_id, label, v (whole numbers), anchor."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        F.transform("embedding", lambda x: F.floor(x.cast("double") * 256)).alias("v"), F.coalesce(anchors, F.lit(False)).alias("anchor"))


def _keyed(dims: list[int], low: list[int], step: list[float]):
    fields = ["vec_id", "label", "v", "anchor"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("v").to_pylist()
            x = np.array([[v[d] if d < len(v) else 0 for d in dims] for v in lists], np.float64).reshape(len(lists), len(dims))
            levels = np.clip((x - low) / step, 0, (1 << CURVE_BITS) - 1).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in fields), pa.array(hilbert_key(levels, CURVE_BITS), pa.int64())], [*fields, "curve"])
    return run


def _cut_blocks(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        task, number, label, held = TaskContext.get().partitionId(), 0, None, []
        out: list[tuple] = []

        def close():
            nonlocal number, held
            if held:
                matrix = np.zeros((len(held), width), np.int64)
                for i, (_, v, _) in enumerate(held):
                    matrix[i, :len(v)] = v
                out.append(((task << 32) + number, label, len(held), [h[0] for h in held], [h[2] for h in held], encode(matrix),
                            matrix.min(axis=0).tolist(), matrix.max(axis=0).tolist()))
                number, held = number + 1, []

        def drain():
            types = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            rows, names = list(out), [f.split()[0] for f in _BLOCKS.split(", ")]
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("vec_id", "label", "v", "anchor")), strict=True):
                if row[1] != label or len(held) == BLOCK:
                    close()
                    label = row[1]
                held.append((row[0], row[2], row[3]))
            if len(out) >= BATCH:
                yield drain()
        close()
        yield drain()
    return run


def blocks_of(rows: DataFrame) -> tuple[DataFrame, int]:
    """The stored blocks of ``prepared`` rows and the vectors' length."""
    spread = rows.select(F.posexplode("v").alias("d", "x")).groupBy("d").agg(
        F.min("x").alias("low"), F.max("x").alias("high"), F.var_pop("x").alias("var")).collect()  # a row a dimension
    width = max((r.d for r in spread), default=-1) + 1
    chosen = sorted(spread, key=lambda r: (-r["var"], r.d))[:CURVE_DIMS] or [None]
    if chosen == [None]:
        keyed = rows.withColumn("curve", F.lit(0).cast("long"))
    else:
        step = [(r.high - r.low + 1) / (1 << CURVE_BITS) for r in chosen]
        keyed = rows.mapInArrow(_keyed([r.d for r in chosen], [r.low for r in chosen], step),
                                "vec_id long, label long, v array<long>, anchor boolean, curve long")
    ordered = keyed.repartitionByRange("label", "curve", "vec_id").sortWithinPartitions("label", "curve", "vec_id")
    return stored(ordered.mapInArrow(_cut_blocks(width), _BLOCKS), "blocks"), width


def _cut_packs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors of blocks in order, ``PACK`` a row."""
    from pyspark import TaskContext
    task, number, held = TaskContext.get().partitionId(), 0, []

    def pack():
        nonlocal number, held
        columns = [[(task << 32) + number], *([[h[i] for h in held]] for i in range(4)), [encode(np.array([h[4] for h in held]))]]
        types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary()]
        number, held = number + 1, []
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], [f.split()[0] for f in _PACKS.split(", ")])

    for batch in batches:
        for row in batch.to_pylist():
            matrix = decode(row["vectors"], row["n"])
            for place in np.flatnonzero(row["anchors"]).tolist():
                held.append((row["ids"][place], row["label"], row["block"], place, matrix[place]))
                if len(held) == PACK:
                    yield pack()
    if held:
        yield pack()


def _bounds(anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of each anchor with any point of each
    box, widened by what rounding may take away."""
    up, down = np.maximum(anchors, 0).astype(np.float64), np.minimum(anchors, 0).astype(np.float64)
    low, high = low.astype(np.float64), high.astype(np.float64)
    slip = 1e-12 * (np.abs(anchors).astype(np.float64) @ np.maximum(np.abs(low), np.abs(high)).T)
    return up @ low.T + down @ high.T - slip, up @ high.T + down @ low.T + slip


def _window_arrays(windows: list[dict], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper ends by anchor and window; absent windows are empty."""
    count = max((w["w"] for w in windows), default=-1) + 1
    low, high = np.full((n, count), FAR), np.full((n, count), -FAR)
    for w in windows:
        low[w["anchor"], w["w"]], high[w["anchor"], w["w"]] = w["low"], w["high"]
    return low, high


def _choose(same: bool, seeds: bool):
    """Blocks that a group of zone maps offers a pack: the best ``SEEDS`` of
    every anchor (pack, block, anchor, worth), or all that a window needs
    (pack, block, needed)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                n, zones = len(row["ids"]), row["zones"]
                anchors, labels = decode(row["vectors"], n), np.array(row["labels"])
                box = {c: np.array([z[c] for z in zones], np.int64).reshape(len(zones), -1) for c in ("low", "high")}
                block, label = (np.array([z[c] for z in zones], np.int64) for c in ("block", "label"))
                least, most = _bounds(anchors, box["low"], box["high"])
                low, high = _window_arrays(row["windows"], n)
                use = (labels[:, None] == label) == same
                meets = np.zeros_like(use)
                for w in range(low.shape[1]):
                    meets |= (most >= low[:, w, None]) & (least <= high[:, w, None]) & (low[:, w] <= high[:, w])[:, None]
                use &= meets
                if seeds:
                    worth = np.where(use, most, -np.inf)
                    best = np.argsort(-worth, axis=1, kind="stable")[:, :SEEDS]
                    a = np.repeat(np.arange(n), best.shape[1])
                    b, keep = best.reshape(-1), use[np.repeat(np.arange(n), best.shape[1]), best.reshape(-1)]
                    a, b = a[keep], b[keep]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(a), row["pack"]), pa.int64()), pa.array(block[b], pa.int64()),
                                                      pa.array(a, pa.int32()), pa.array(worth[a, b], pa.float64())], ["pack", "block", "anchor", "worth"])
                else:
                    at = np.flatnonzero(use.any(axis=0))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), row["pack"]), pa.int64()), pa.array(block[at], pa.int64()),
                                                      pa.array([np.flatnonzero(use[:, i]) for i in at], pa.list_(pa.int32()))], ["pack", "block", "needed"])
    return run


def _first(score: np.ndarray, ids: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the first ``TOP`` allowed scores of each row."""
    worth = np.where(allowed, score, -FAR)
    k = min(TOP, worth.shape[1])
    least = np.partition(worth, worth.shape[1] - k, axis=1)[:, worth.shape[1] - k]
    rows, cols = np.nonzero(allowed & (worth >= least[:, None]))
    order = np.lexsort((ids[cols], -worth[rows, cols], rows))
    rows, cols = rows[order], cols[order]
    rank = np.arange(len(rows)) - np.searchsorted(rows, rows)
    return rows[rank < k], cols[rank < k]


def _read(same: bool):
    """A block's rows against the anchors of a pack that need it."""
    names = [f.split()[0] for f in _FOUND.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                needed, ids = np.array(row["needed"]), np.array(row["block_ids"], np.int64)
                score = _product(decode(row["vectors"], len(row["ids"]))[needed], decode(row["block_vectors"], len(ids)))
                low, high = _window_arrays(row["windows"], len(row["ids"]))
                allowed = (np.array(row["labels"])[needed] == row["block_label"])[:, None] == np.full(len(ids), same)
                if same:  # not the anchor itself
                    mine = np.flatnonzero(np.array(row["blocks"])[needed] == row["block"])
                    allowed[mine, np.array(row["places"])[needed][mine]] = False
                found = []
                for w in range(low.shape[1]):
                    a, b = _first(score, ids, allowed & (score >= low[needed, w, None]) & (score <= high[needed, w, None]))
                    found.append((needed[a], np.full(len(a), w), score[a, b], ids[b], b))
                a, w, s, v, b = (np.concatenate([f[i] for f in found]) for i in range(5))
                columns = [np.full(len(a), row["pack"]), a, w, s, v, np.full(len(a), row["block"]), b]
                types = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)
    return run


def _best(found: DataFrame) -> DataFrame:
    """The first ``TOP`` rows of every window, each row once, with its rank."""
    order = Window.partitionBy("pack", "anchor", "w").orderBy(F.desc("score"), "vec_id", "block", "place")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= TOP)


def _search(packs: DataFrame, blocks: DataFrame, same: bool, name: str) -> DataFrame:
    """First rows of every window of the packs' anchors, among blocks of the
    anchor's label (``same``) or of the others."""
    spark = packs.sparkSession
    groups = max(1, -(-blocks.count() // ZONES))
    zones = blocks.select(F.pmod(F.xxhash64("block"), F.lit(groups)).alias("zone_group"), F.struct("block", "label", "low", "high").alias("z"))
    zones = zones.groupBy("zone_group").agg(F.collect_list("z").alias("zones"))  # about ZONES, spread by hash
    zones = stored(zones.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), "zones")

    def chosen(packs, seeds):
        spread = packs.withColumn("salt", F.pmod(F.xxhash64("pack"), F.lit(SALTS)).cast("int")).withColumn(
            "zone_group", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))
        met = spread.join(zones, ["zone_group", "salt"]).select("pack", "ids", "labels", "vectors", "windows", "zones")
        return met.mapInArrow(_choose(same, seeds), "pack long, block long, " + ("anchor int, worth double" if seeds else "needed array<int>"))

    def read(packs, wanted):
        whole = blocks.select("block", F.col("label").alias("block_label"), F.col("ids").alias("block_ids"), F.col("vectors").alias("block_vectors"))
        rows = wanted.join(packs, "pack").join(whole, "block")
        return _best(rows.mapInArrow(_read(same), _FOUND))

    with batches_of(spark, BATCH):
        per_anchor = Window.partitionBy("pack", "anchor").orderBy(F.desc("worth"), "block")
        seeds = chosen(packs, True).withColumn("r", F.row_number().over(per_anchor)).where(F.col("r") <= SEEDS)
        seeds = seeds.groupBy("pack", "block").agg(F.collect_list("anchor").alias("needed"))  # PACK at most
        first = stored(read(packs, seeds), f"{name}-seeds")
        raised = first.where(F.col("rank") == TOP).select("pack", "anchor", "w", F.col("score").alias("raised"))
        windows = packs.select("pack", F.explode("windows").alias("x")).select("pack", "x.*").join(raised, ["pack", "anchor", "w"], "left")
        windows = windows.groupBy("pack").agg(F.collect_list(F.struct(
            "anchor", "w", F.greatest("low", F.coalesce("raised", "low")).alias("low"), "high")).alias("windows"))
        closer = stored(packs.drop("windows").join(windows, "pack"), f"{name}-packs")
        return stored(read(closer, chosen(closer, False)), name)


def hard_negatives(vectors: DataFrame, anchors: Column, least_percent: int = 80) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score: for the rows of ``vectors`` (vec_id, label, embedding) that
    the condition ``anchors`` names, the first ``TOP`` positives and, for each,
    the first ``TOP`` rows of other labels that have at least ``least_percent``
    of a hundred of the positive's score and no more than it."""
    spark = vectors.sparkSession
    blocks, _ = blocks_of(prepared(vectors, anchors))
    with batches_of(spark, BATCH):
        with_anchors = blocks.where(F.exists("anchors", lambda x: x)).repartitionByRange("block").sortWithinPartitions("block")
        packs = stored(with_anchors.mapInArrow(_cut_packs, _PACKS), "packs")
    whole = F.transform(F.sequence(F.lit(0), F.size("ids") - 1), lambda i: F.struct(
        i.alias("anchor"), F.lit(0).alias("w"), F.lit(-FAR).alias("low"), F.lit(FAR).alias("high")))
    positives = _search(packs.withColumn("windows", whole.cast(_WINDOWS)), blocks, True, "positives")
    windows = positives.where(F.col("score") >= 0).groupBy("pack").agg(F.collect_list(F.struct(
        "anchor", (F.col("rank") - 1).alias("w"), F.expr(f"score div 100 * {least_percent} + (score % 100 * {least_percent} + 99) div 100").alias("low"), F.col("score").alias("high"))
    ).cast(_WINDOWS).alias("windows"))  # PACK * TOP at most; a negative score's window is empty
    negatives = _search(packs.join(windows, "pack"), blocks, False, "negatives")
    of = positives.select("pack", "anchor", (F.col("rank") - 1).alias("w"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    names = packs.select("pack", F.posexplode("ids").alias("anchor", "anchor_id"))
    return negatives.join(of, ["pack", "anchor", "w"]).join(names, ["pack", "anchor"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
