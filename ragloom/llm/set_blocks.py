"""Sets in packs and blocks, compared inside tasks.

A pack is a row of several sets (their hashes, or sketches of them) of one key;
a task that holds two packs compares all their pairs and gives what it found,
so pairs are never rows.  ``links_with_large`` compares sets with the whole of
a large component that way, exactly, and gives at most one link for a set and
block: enough for components.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import batches_of, stored

PACK, PACK_BYTES, SALTS, BLOCKS_A_TASK = 128, 1 << 22, 16, 4
BATCH = 16  # pairs of a pack and a block in a task's memory at once
PACKED = "key long, no long, nodes array<long>, ns array<long>, parts array<long>, sizes array<long>, data binary"


def _packs(rows: int, size: int):
    """Rows sorted by key -> packs of one key, of so many rows and bytes (or
    a single row)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        no, key, held, held_size = TaskContext.get().partitionId() << 32, None, [], 0

        def pack():
            nonlocal no, held, held_size
            columns = [[key], [no], *([[h[i] for h in held]] for i in range(3)), [[len(h[3]) for h in held]], [b"".join(h[3] for h in held)]]
            types = [pa.int64(), pa.int64(), *[pa.list_(pa.int64())] * 4, pa.binary()]
            no, held, held_size = no + 1, [], 0
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], [f.split()[0] for f in PACKED.split(", ")])

        for batch in batches:
            lists = [batch.column(c).to_pylist() for c in ("key", "node", "n", "part")]
            for at, *row in zip(*lists, batch.column("data"), strict=True):
                data = row[-1].as_py()
                if held and (at != key or len(held) == rows or held_size + len(data) > size):
                    yield pack()
                key = at
                held.append((*row[:-1], data))
                held_size += len(data)
        if held:
            yield pack()
    return run


def packed(rows: DataFrame, size: int) -> DataFrame:
    """``rows`` (key, node, n, part, data) in packs; equal keys are spread by
    node over as many tasks as they need."""
    ordered = rows.select("key", "node", "n", "part", "data").repartitionByRange("key", "node").sortWithinPartitions("key", "node")
    return ordered.mapInArrow(_packs(PACK, size), PACKED)


def side_of(packs: DataFrame, name: str) -> DataFrame:
    return packs.select("key", *(F.col(c).alias(f"{name}_{c}") for c in packs.columns if c != "key"))


def pack_of(row: dict, side: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return tuple(np.array(row[f"{side}_{c}"], np.int64) for c in ("nodes", "ns", "parts"))


def overlaps(a: list[np.ndarray], b: list[np.ndarray], columns: int = 2048) -> np.ndarray:
    """Sizes of the intersections of all sets of ``a`` with all of ``b``: the
    product of their membership matrices over the tokens both sides have."""
    flat = [np.concatenate(x) if x else np.empty(0, np.uint64) for x in (a, b)]
    rows = [np.repeat(np.arange(len(x)), [len(t) for t in x]) for x in (a, b)]
    shared = np.intersect1d(*flat)
    out = np.zeros((len(a), len(b)), np.int64)
    placed = []
    for tokens, row in zip(flat, rows, strict=True):
        at = np.searchsorted(shared, tokens)
        at[at == len(shared)] = 0
        known = shared[at] == tokens if len(shared) else np.zeros(len(tokens), bool)
        at, row = at[known], row[known]
        order = np.argsort(at, kind="stable")
        placed.append((at[order], row[order]))
    for low in range(0, len(shared), columns):
        sides = []
        for (at, row), n in zip(placed, out.shape, strict=True):
            x, y = np.searchsorted(at, (low, low + columns))
            m = np.zeros((n, min(columns, len(shared) - low)), np.float32)
            m[row[x:y], at[x:y] - low] = 1
            sides.append(m)
        out += (sides[0] @ sides[1].T).astype(np.int64)  # sums below 2^24: exact
    return out


def _linked_blocks(limit: Limit):
    """A pack of sets and a block of a component -> for each set of the pack
    that links with any of the block, one such link."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                (a, n_a, _), (b, n_b, _) = pack_of(row, "a"), pack_of(row, "b")
                sets = [np.split(np.frombuffer(row[f"{x}_data"], np.uint64), np.cumsum(row[f"{x}_sizes"])[:-1] // 8) for x in "ab"]
                common = overlaps(*sets)
                hit = limit.den * common >= limit.num * (n_a[:, None] + n_b - common)
                x = np.flatnonzero(hit.any(axis=1))
                y = b[hit[x].argmax(axis=1)]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a[x], y)), pa.array(np.maximum(a[x], y))], ["a", "b"])
    return run


def asked_of_large(members: DataFrame, large: DataFrame) -> DataFrame:
    """(target, node): the sets that share a place with a large component
    ``target`` and are not in it; of two large ones, one side asks.

    ``members`` (place, node, part), ``large`` (target)."""
    there = members.join(large, F.col("part") == F.col("target")).select("place", "target").distinct()
    is_large = large.select(F.col("target").alias("own"))
    asked = members.join(there, "place").where("part != target").join(is_large, F.col("part") == F.col("own"), "left")
    return stored(asked.where("own IS NULL OR own < target").select("target", "node").distinct(), "asked")


def links_with_large(asked: DataFrame, owned: DataFrame, sizes: DataFrame, sets_of: Callable[[DataFrame], DataFrame], limit) -> DataFrame:
    """Edges (a, b) between the sets ``asked`` (target, node) and members of
    their target's component, ``owned`` (target, node).

    ``sizes`` (node, n); ``sets_of`` gives (node, tokens) for nodes.  Packs of
    asked sets meet the blocks of a component in up to ``SALTS`` tasks, or more
    where adaptive execution splits them."""
    spark = asked.sparkSession
    owned = stored(owned.join(asked.select("target").distinct(), "target", "left_semi"), "owned")
    sets = sets_of(asked.select("node").union(owned.select("node"))).withColumnRenamed("tokens", "data")

    def in_packs(rows, name):
        rows = rows.join(sizes, "node").join(sets, "node").withColumn("part", F.col("target")).withColumnRenamed("target", "key")
        return stored(packed(rows, PACK_BYTES), name)
    blocks = in_packs(owned, "component-blocks")
    # a task for every few blocks of a component; packs are copied as often
    tasks = stored(blocks.groupBy("key").agg(F.least(F.lit(SALTS), F.ceil(F.count("*") / BLOCKS_A_TASK).cast("int")).alias("tasks")), "tasks")
    blocks = blocks.join(tasks, "key").withColumn("salt", F.pmod(F.xxhash64("no"), F.col("tasks")).cast("int")).drop("tasks")
    packs = in_packs(asked, "asked-packs").join(tasks, "key").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("tasks") - 1))).drop("tasks")
    left, right = side_of(packs, "a"), side_of(blocks, "b")
    with batches_of(spark, BATCH):
        met = left.join(right, (left["key"] == right["key"]) & (F.col("a_salt") == F.col("b_salt"))).drop("key", "a_salt", "b_salt")
        return stored(met.mapInArrow(_linked_blocks(limit), "a long, b long").distinct(), "component-links")
