"""Connected components of an edge table.

Every task first reduces its edges to a forest of stars; then rounds of
large-star and small-star joins (Kiveris et al., 2014) shrink the diameter
until no edge changes.  The least neighbour of a node is a partial aggregate,
and is stored before it is joined with the edges, so that Spark can split that
join at a hub.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import stored

EDGE = "a long, b long"


class Forest:
    """Union-find whose roots are the least members."""

    def __init__(self):
        self.parent: dict = {}

    def find(self, x):
        root = x
        while (up := self.parent.get(root, root)) != root:
            root = up
        while x != root:
            self.parent[x], x = root, self.parent.get(x, x)
        return root

    def join(self, x, y) -> bool:
        x, y = self.find(x), self.find(y)
        if x != y:
            self.parent[max(x, y)] = min(x, y)
        return x != y


def _local_stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    forest, limit = Forest(), 1_000_000

    def drain():
        nodes = list(forest.parent)
        a, b = np.array(nodes, np.int64), np.array([forest.find(x) for x in nodes], np.int64)
        forest.parent = {}
        return pa.RecordBatch.from_arrays([pa.array(a[a != b]), pa.array(b[a != b])], ["a", "b"])

    for batch in batches:
        for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            forest.join(x, y)
        if len(forest.parent) > limit:
            yield drain()
    yield drain()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = stored(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = stored(down.groupBy("a").agg(F.min("b").alias("m")), "least")
    moved = down.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b): component is the
    least node reachable.  Loops and repeated edges do no harm; no edges give
    no rows."""
    clean = edges.where("a != b")
    now = stored(clean.mapInArrow(_local_stars, EDGE).distinct(), "edges")
    before = None
    while True:
        sums = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.expr("(a = b)::int"))).first()
        if sums == before or not sums[0]:
            break
        before = sums
        now = stored(_small_star(_large_star(now).where("a != b").distinct()).distinct(), "edges")
    found = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return found.union(now.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
