"""Approximate nearest neighbours by NN-descent (operator 1).

Equal vectors are one node with the smallest ids that carry them, so that a
large group of copies neither fills the neighbour lists nor meets in one task.
Nodes are numbered in order of their smallest id.

Building: random hyperplanes, fitted to a bounded sample, cut the nodes into
cells, some times over; neighbours within a cell start the graph.  Then rounds
of NN-descent: every node joins with its neighbours and reverse neighbours, and
all of these, being neighbours of neighbours, are compared with each other;
a pair goes on only if it beats the farthest neighbour that one of the two has
now.  The lists are merged, and rounds end only when few of them change (a
list only ever gets nearer, so they do).  Messages
carry the vectors in half precision; a list keeps ``DEGREE`` neighbours and at
most ``REVERSE`` reverse ones, the nearest, so every join is bounded by the
number of nodes.

Searching: greedy graph search for all queries at once.  A query starts from
its own node, so that it is in its own cluster however small that is, and from
the nearest of ``ENTRIES`` nodes.  It holds a beam of the nearest nodes seen;
each round joins its best unexpanded nodes with the
graph and the new ones with the vectors, until no node of the beam is left to
expand.  Scores are Euclidean distances in double precision on the original
vectors.

Defined results: vectors null, zero or with null or non-finite components, or
of another length than most, take no part, as queries or candidates; a query
finds other rows with its own vector at distance 0; rows that repeat a vec_id
are one candidate or query at the smallest distance that one of its vectors
has; components are taken as floats; fewer candidates than ``k`` give fewer rows; an empty table gives
none; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .tables import stored

DEGREE = 24
REVERSE = 24
EMIT = 6
LEAST_CHANGE = 0.02
TREES = 4
CELL = 64
LARGEST_CELL = 512
SAMPLE = 20_000
ENTRIES = 1024
BEAM = 128
EXPAND = 16
SALTS = 8
TASK_ROWS = 50_000  # rows that make a task of their own worth while


def usable(vector: Column) -> Column:
    """Not null, not zero, all components finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    """The rows of each key, from batches sorted by it."""
    rest = None
    for batch in batches:
        if rest is not None:
            batch = pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0] if batch.num_rows else rest
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy()
        cuts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]).tolist()
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield batch.slice(a, b - a)
        rest = batch.slice(cuts[-1])
    if rest is not None and rest.num_rows:
        yield rest


def _matrix(column, dtype) -> np.ndarray:
    return np.array([np.frombuffer(x.as_buffer(), dtype) for x in column])


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((x * x).sum(1)[:, None] + (y * y).sum(1)[None] - 2 * x @ y.T, 0))


EDGES = [("u", pa.int64()), ("v", pa.int64()), ("d", pa.float32())]
EDGE_SQL = "u long, v long, d float"


def _batch(fields, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields, strict=True)], [n for n, _ in fields])


def _edges(parts: list) -> pa.RecordBatch:
    return _batch(EDGES, *(np.concatenate([p[i] for p in parts]) if parts else [] for i in range(3)))


def _flushed(found: Iterator[tuple], rows: int = 50_000) -> Iterator[pa.RecordBatch]:
    held, n = [], 0
    for part in found:
        held.append(part)
        n += len(part[0])
        if n >= rows:
            yield _edges(held)
            held, n = [], 0
    yield _edges(held)


def tasks_for(spark: SparkSession, rows: int) -> int:
    """The most tasks that so many rows are worth.  There are dozens of joins,
    so for a small table what tasks cost by themselves would be most of the
    time; beyond the shuffle's own number of partitions it changes nothing."""
    return max(2 * spark.sparkContext.defaultParallelism, -(-rows // TASK_ROWS))


# nodes

def _merge_equal(keep: int):
    """Per task: each different vector with its smallest ids."""
    def drain(seen):
        return pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.binary()), pa.array([sorted(set(i))[:keep] for i in seen.values()], pa.list_(pa.int64()))], ["vec", "ids"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, list] = {}
        for batch in batches:
            for i, vec in zip(batch.column("vec_id").to_pylist(), batch.column("vector"), strict=True):
                ids = seen.setdefault(vec.values.to_numpy().astype("<f4").tobytes(), [])
                ids.append(i)
                if len(ids) > 8 * keep:
                    ids[:] = sorted(set(ids))[:keep]
            if len(seen) > 100_000:
                yield drain(seen)
                seen = {}
        yield drain(seen)
    return run


def nodes_of(vectors: DataFrame, k: int) -> DataFrame:
    """node (a number), vec (binary of floats), ids (the k + 1 smallest)."""
    rows = vectors.mapInArrow(_merge_equal(k + 1), "vec binary, ids array<long>")
    merged = rows.groupBy("vec").agg(F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, k + 1).alias("ids"))
    # an id may have several vectors, so it can't name a node
    return stored(merged.orderBy(F.get("ids", F.lit(0)), "vec").select(F.monotonically_increasing_id().alias("node"), "vec", "ids"), "nodes")


# building

def _cells(normals: np.ndarray, offsets: np.ndarray):
    """(tree, cell) of every node; ``normals`` is trees x planes x length."""
    fields = [("cell", pa.int64()), ("node", pa.int64()), ("vec", pa.binary())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, node = _matrix(batch.column("vec"), "<f4"), batch.column("node").to_numpy()
            half = pa.array([r.tobytes() for r in x.astype("<f2")], pa.binary())
            for tree in range(len(normals)):
                bits = (x @ normals[tree].T > offsets[tree]).astype(np.int64)
                code = bits @ (1 << np.arange(bits.shape[1], dtype=np.int64)) + (tree << 40)
                yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(node), half], [n for n, _ in fields])
    return run


def _within_cells(degree: int):
    def near(rows):
        node, x = rows.column("node").to_numpy(), _matrix(rows.column("vec"), "<f2").astype(np.float32)
        order = np.argsort(x @ np.random.default_rng(len(x)).standard_normal(x.shape[1]).astype(np.float32))
        for start in range(0, len(x), LARGEST_CELL):  # a cell larger than that, in order along a random line
            own = order[start:start + LARGEST_CELL]
            if len(own) < 2:
                own = order[-2:]
            d = _distances(x[own], x[own])
            np.fill_diagonal(d, np.inf)
            top = np.argsort(d, axis=1)[:, :min(degree, len(own) - 1)]
            yield np.repeat(node[own], top.shape[1]), node[own][top].ravel(), np.take_along_axis(d, top, 1).ravel().astype(np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _flushed(part for rows in runs(batches, "cell") if rows.num_rows > 1 for part in near(rows))
    return run


def _nearest(limit: int):
    """The ``limit`` nearest different v of each u, from rows sorted by u, d, v."""
    def first(rows):
        v = rows.column("v").to_numpy()
        at = np.sort(np.unique(v, return_index=True)[1])[:limit]
        return rows.column("u").to_numpy()[at], v[at], rows.column("d").to_numpy()[at]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _flushed(first(rows) for rows in runs(batches, "u"))
    return run


def _lists(edges: DataFrame, limit: int, tasks: int) -> DataFrame:
    return edges.repartition("u").coalesce(tasks).sortWithinPartitions("u", "d", "v").select("u", "v", "d").mapInArrow(_nearest(limit), EDGE_SQL)


def _reverse(edges: DataFrame, limit: int, tasks: int) -> DataFrame:
    """The nearest reverse neighbours; a node that many point to is first
    reduced in parts."""
    turned = edges.select(F.col("v").alias("u"), F.col("u").alias("v"), "d")
    part = turned.repartition("u", F.pmod("v", F.lit(SALTS))).coalesce(tasks).sortWithinPartitions("u", F.pmod("v", F.lit(SALTS)), "d", "v")
    return _lists(part.select("u", "v", "d").mapInArrow(_nearest(limit), EDGE_SQL), limit, tasks)


def _local_join(emit: int):
    """All members around a node compared: for each the nearest others that
    beat its farthest neighbour."""
    def near(rows):
        member, at = np.unique(rows.column("member").to_numpy(), return_index=True)
        x = _matrix(rows.column("vec"), "<f2").astype(np.float32)[at]
        radius = rows.column("radius").to_numpy()[at]
        d = _distances(x, x)
        np.fill_diagonal(d, np.inf)
        top = np.argpartition(d, min(emit, len(d) - 1), axis=1)[:, :emit]
        value = np.take_along_axis(d, top, 1)
        i, j = np.nonzero(value < radius[:, None])
        return member[i], member[top[i, j]], value[i, j].astype(np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _flushed(near(rows) for rows in runs(batches, "centre") if rows.num_rows > 1)
    return run


def _halves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        half = [np.frombuffer(x.as_buffer(), "<f4").astype("<f2").tobytes() for x in batch.column("vec")]
        yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(half, pa.binary())], ["node", "vec"])


def build_graph(nodes: DataFrame, degree: int = DEGREE) -> DataFrame:
    """Edges (u, v, d): the nearest neighbours found of every node."""
    spark = nodes.sparkSession
    n = nodes.count()
    sample = nodes.orderBy(F.xxhash64("node")).limit(SAMPLE).select("vec").collect()  # SAMPLE vectors
    if n < 2:
        return spark.createDataFrame([], EDGE_SQL)
    x = np.array([np.frombuffer(r["vec"], "<f4") for r in sample])
    rng, planes = np.random.default_rng(1), max(int(np.ceil(np.log2(max(n / CELL, 1)))), 1)
    normals = x[rng.integers(0, len(x), (TREES, planes))] - x[rng.integers(0, len(x), (TREES, planes))]
    normals += 1e-6 * rng.standard_normal(normals.shape).astype(np.float32)
    offsets = np.median(np.einsum("nd,tpd->tpn", x, normals), axis=2)
    cells = nodes.select("node", "vec").mapInArrow(_cells(normals, offsets), "cell long, node long, vec binary")
    tasks = tasks_for(spark, n * (degree + REVERSE + 1))
    start = cells.repartition("cell").coalesce(tasks).sortWithinPartitions("cell").mapInArrow(_within_cells(degree), EDGE_SQL)
    edges = stored(_lists(start, degree, tasks), "graph")
    halves = stored(nodes.select("node", "vec").mapInArrow(_halves, "node long, vec binary"), "halves")
    while True:
        radius = edges.groupBy("u").agg(F.when(F.count("*") >= degree, F.max("d")).otherwise(float("inf")).cast("float").alias("radius"))
        members = halves.join(radius, halves["node"] == radius["u"], "left").select(
            F.col("node").alias("member"), "vec", F.coalesce("radius", F.lit(float("inf")).cast("float")).alias("radius"))
        around = edges.select(F.col("u").alias("centre"), F.col("v").alias("member")).union(
            _reverse(edges, REVERSE, tasks).select("u", "v")).union(nodes.select("node", "node"))
        met = (around.join(members, "member").coalesce(tasks).repartition("centre").coalesce(tasks).sortWithinPartitions("centre")
               .select("centre", "member", "vec", "radius").mapInArrow(_local_join(EMIT), EDGE_SQL))
        better = stored(_lists(edges.union(met), degree, tasks), "graph")
        changed = better.join(edges, ["u", "v"], "left_anti").coalesce(tasks).count()
        edges = better
        if changed < LEAST_CHANGE * n * degree:
            break
    return edges


# searching

_STATE_SQL = "query_id long, vec binary, seen array<long>, beam array<long>, dist array<double>, open array<boolean>"
_STATE = [("query_id", pa.int64()), ("vec", pa.binary()), ("seen", pa.list_(pa.int64())), ("beam", pa.list_(pa.int64())),
          ("dist", pa.list_(pa.float64())), ("open", pa.list_(pa.bool_()))]


def exact_distance(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    delta = x.astype(np.float64) - y.astype(np.float64)
    return np.sqrt((delta * delta).sum(-1))


def _begin(entries):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes, x = entries.value
        for batch in batches:
            rows = []
            for q, vec, own in zip(*(batch.column(c).to_pylist() for c in ("query_id", "vec", "own")), strict=True):
                d = exact_distance(np.frombuffer(vec, "<f4"), x)
                top = np.lexsort((nodes, d))[:EXPAND]
                ids, dist = nodes[top], d[top]
                if own is not None:
                    other = ids != own
                    ids, dist = np.r_[own, ids[other]], np.r_[0.0, dist[other]]
                rows.append((q, vec, ids, ids, dist, [True] * len(ids)))
            yield _batch(_STATE, *([r[i] for r in rows] for i in range(6)))
    return run


def _advance(beam: int):
    """The query's state (the row with a beam) and the nodes met in a round."""
    def step(rows):
        at = int(np.flatnonzero(rows.column("beam").is_valid().to_numpy(zero_copy_only=False))[0])
        q, vec = rows.column("query_id")[at].as_py(), rows.column("vec")[at].as_py()
        seen, ids, dist, is_open = (np.array(rows.column(c)[at].as_py(), t) for c, t in (("seen", np.int64), ("beam", np.int64), ("dist", np.float64), ("open", bool)))
        is_open[np.flatnonzero(is_open)[:EXPAND]] = False  # these were expanded in this round
        node = rows.column("node").to_numpy(zero_copy_only=False)
        other = [i for i in range(rows.num_rows) if i != at]
        if other:
            met, first = np.unique(np.array([node[i] for i in other], np.int64), return_index=True)
            new = ~np.isin(met, seen)
            met, first = met[new], first[new]
            if len(met):
                x = np.array([np.frombuffer(rows.column("node_vec")[other[i]].as_buffer(), "<f4") for i in first])
                seen = np.r_[seen, met]
                ids, dist, is_open = np.r_[ids, met], np.r_[dist, exact_distance(np.frombuffer(vec, "<f4"), x)], np.r_[is_open, np.ones(len(met), bool)]
        top = np.lexsort((ids, dist))[:beam]
        return q, vec, seen, ids[top], dist[top], is_open[top]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for rows in runs(batches, "query_id"):
            held.append(step(rows))
            if len(held) >= 256:
                yield _batch(_STATE, *([r[i] for r in held] for i in range(6)))
                held = []
        yield _batch(_STATE, *([r[i] for r in held] for i in range(6)))
    return run


def search(queries: DataFrame, nodes: DataFrame, graph: DataFrame, beam: int = BEAM) -> DataFrame:
    """query_id, node, score: the beam of every query (query_id, vec, own: its
    node, null if it has none)."""
    spark = queries.sparkSession
    tasks = tasks_for(spark, graph.count())
    links = stored(graph.select("u", "v").union(_reverse(graph, REVERSE, tasks).select("u", "v")).distinct()
                   .groupBy("u").agg(F.collect_list("v").alias("next")).coalesce(tasks), "links")  # DEGREE + REVERSE at most
    first = nodes.orderBy(F.xxhash64("node")).limit(ENTRIES).select("node", "vec").collect()  # ENTRIES vectors
    if not first:
        return spark.createDataFrame([], "query_id long, node long, score double")
    entries = spark.sparkContext.broadcast((np.array([r["node"] for r in first], np.int64), np.array([np.frombuffer(r["vec"], "<f4") for r in first])))
    state = stored(queries.select("query_id", "vec", "own").mapInArrow(_begin(entries), _STATE_SQL), "beams")
    tasks = tasks_for(spark, state.count() * EXPAND * (DEGREE + REVERSE))
    vectors = nodes.select("node", F.col("vec").alias("node_vec"))
    while True:
        to_expand = F.slice(F.filter("beam", lambda x, i: F.get("open", i)), 1, EXPAND)
        frontier = state.select("query_id", F.explode(to_expand).alias("u"))
        if not frontier.take(1):
            break
        met = frontier.join(links, "u").select("query_id", F.explode("next").alias("node")).coalesce(tasks).distinct().coalesce(tasks).join(vectors, "node").coalesce(tasks)
        rows = state.withColumns({"node": F.lit(None).cast("long"), "node_vec": F.lit(None).cast("binary")}).unionByName(met, allowMissingColumns=True)
        state = stored(rows.repartition("query_id").coalesce(tasks).sortWithinPartitions("query_id").mapInArrow(_advance(beam), _STATE_SQL), "beams")
    return state.select("query_id", F.explode(F.arrays_zip("beam", "dist")).alias("e")).select(
        "query_id", F.col("e.beam").alias("node"), F.col("e.dist").alias("score"))


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found of every row of
    ``vectors`` (vec_id, ``vector``) that ``is_query`` holds for, among all other
    rows."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).cast("array<float>").alias("vector"),
                          F.coalesce(is_query, F.lit(False)).alias("is_query")).where(usable(F.col("vector")) & F.col("vec_id").isNotNull())
    lengths = rows.groupBy(F.size("vector").alias("length")).agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "length").first()
    rows = rows.where(F.size("vector") == (lengths["length"] if lengths else 0))
    nodes = nodes_of(rows.select("vec_id", "vector"), k)
    queries = rows.where("is_query").select(F.col("vec_id").alias("query_id"), "vector").mapInArrow(_as_bytes, "query_id long, vec binary").distinct()
    queries = stored(queries.join(nodes.select("vec", F.col("node").alias("own")), "vec", "left").withColumn("search", F.monotonically_increasing_id()), "queries")
    found = search(queries.select(F.col("search").alias("query_id"), "vec", "own"), nodes, build_graph(nodes), max(BEAM, k + 1))
    each = (found.withColumnRenamed("query_id", "search").join(queries.select("search", "query_id"), "search").join(nodes.select("node", "ids"), "node")
            .select("query_id", "score", F.explode("ids").alias("vec_id")).where("vec_id != query_id"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (each.groupBy("query_id", "vec_id").agg(F.min("score").alias("score")).withColumn("rank", F.row_number().over(order))
            .where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))


def _as_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        vecs = [v.values.to_numpy().astype("<f4").tobytes() for v in batch.column("vector")]
        yield pa.RecordBatch.from_arrays([batch.column("query_id"), pa.array(vecs, pa.binary())], ["query_id", "vec"])
