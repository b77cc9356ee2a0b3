"""Exact nearest neighbours over a stored metric index (R1, J2 at scale).

The index cuts the corpus into cells around centres and the cells into blocks:

* **centres** are at most ``MAX_CENTRES`` corpus vectors (those of smallest
  hashed id, so a rerun picks the same); their number follows the square root
  of the corpus, their bytes are bounded by ``CENTRE_BYTES``.
* every vector belongs to its nearest centre; a cell's vectors are sorted by
  their distance to the centre and cut into **blocks** of bounded size, each
  with the ring ``[inner, outer]`` of these distances.  A cell that a third of
  the corpus falls into is many blocks; there are at most about ``MAX_BLOCKS``.
* blocks are rows of a Parquet table (ids, vectors, carried columns); the
  headers (cell, ring) are what a search holds of them.

A search visits blocks by their lower bound.  For a query at distance ``d`` of
a cell's centre, the triangle inequality puts every vector of a block at least
``max(d - outer, inner - d)`` away.  The nearest ``FIRST_VISITS`` blocks give a
first k-th distance; after that only blocks whose bound does not exceed it are
visited.  The bound is never above the true distance (it is widened by the
rounding of the distance to the centre), so the result is exact, ties included.

The first round shuffles (block, query) visits, packed ``PACK`` queries to a
row, and joins them with the blocks they visit.  What remains may be every
block for every query (vectors without clusters), so it is no longer moved by
visits: the blocks are cut into regions and the queries into slices, both of
bounded bytes, and a task meets one slice with one region.  A query goes once to
each region that may hold a neighbour, a region once to each slice that asks
for it, and inside the task the bounds still skip blocks.

Distances are first estimated by a product of matrices in single precision
(:func:`nearest`); what rounding may have hidden is kept, and only pairs that
may be among the k nearest get an exact distance, in doubles.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ragloom.session import batches_of, cut_lineage

MAX_CENTRES = 4096
CENTRE_BYTES = 32 * 1024 * 1024
MAX_BLOCKS = 1 << 18          # headers: 32 bytes each, 8 MiB
BLOCK_ROWS = 256              # rows of a block while the corpus needs no more than MAX_BLOCKS
PACK = 256                    # queries of a visit row
FIRST_VISITS = 2              # blocks a query visits before the regions
TILE_BOUNDS = 1 << 20         # (query, block) bounds computed at once
GRID_BYTES = 32 * 1024 * 1024 # vectors of a slice of queries, or of a region of blocks
PAIR_TILE = 1 << 20           # (query, vector) distances computed at once
MANY = 8                      # times k: more pairs of a query than that are cut by its k-th best estimate
SINGLE = (1e-20, 1e20)        # squared norms that single precision holds with room for their products
PAIR_BYTES = 16 * 1024 * 1024 # differences re-ranked at once
BATCH_BYTES = 32 * 1024 * 1024  # vectors of the visits in an Arrow batch
MAX_TASKS = 4096              # in which slices meet regions, or a few for each core

HIT = "query_id bigint, corpus_id bigint, distance double"


def _matrix(column, dtype=np.float64) -> np.ndarray:
    """Vectors of an Arrow list column, one row each, in doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(dtype)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0), dtype)


def _width(df: DataFrame, vector: str = "embedding") -> type:
    """What holds the components as they come: floats stay floats when stored."""
    return np.float32 if df.schema[vector].dataType.elementType.simpleString() == "float" else np.float64


def _sq(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances of all pairs by the expanded form, and the most that
    rounding may have moved them by."""
    an, bn = np.einsum("ij,ij->i", a, a), np.einsum("ij,ij->i", b, b)
    slip = 8 * (a.shape[1] + 2) * np.finfo(np.float64).eps * (an[:, None] + bn)
    return np.maximum(an[:, None] + bn - 2.0 * (a @ b.T), 0.0), slip


@dataclass
class MetricIndex:
    """``blocks`` (block, cell, ids, vectors, carried columns) as stored, the
    centres, the headers (block, cell, inner, outer, n), and what the vectors
    are stored as."""

    blocks: DataFrame
    centres: np.ndarray
    headers: np.ndarray
    carry: tuple[str, ...]
    dtype: type = np.float64

    @property
    def n_blocks(self) -> int:
        return len(self.headers)


def usable(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """Rows whose vector is there, not empty, and finite throughout."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return df.where(F.col(vector).isNotNull() & (F.size(vector) > 0) & finite)


# ------------------------------------------------------------------- build --

def _assign(centres, carry):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = centres.value
        for batch in batches:
            x = _matrix(batch.column("embedding"))
            cell, dist = np.zeros(len(x), np.int32), np.zeros(len(x))
            for a in range(0, len(x), 1024):
                part = x[a:a + 1024]
                near = _sq(part, c)[0].argmin(axis=1)
                d = part - c[near]
                cell[a:a + 1024], dist[a:a + 1024] = near, np.sqrt(np.einsum("ij,ij->i", d, d))
            yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(dist), *batch.columns], ["cell", "dist", *batch.schema.names])
    return run


def _cut(rows_per_block: int, schema: pa.Schema, dtype: type):
    """Rows sorted by (cell, dist, corpus_id) -> blocks of one cell."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        task, number, held, size, at = TaskContext.get().partitionId(), 0, [], 0, None

        def close():
            nonlocal number, held, size
            block = pa.Table.from_batches(held).combine_chunks()
            dist = block.column("dist").to_numpy()
            lists = [pa.array([block.column(n).to_pylist()], schema.field(n).type) for n in block.column_names if n not in ("cell", "dist", "embedding")]
            vectors = _matrix(block.column("embedding").combine_chunks(), dtype)
            out = [pa.array([(task << 32) + number], pa.int64()), pa.array([at], pa.int32()), pa.array([dist.min()]), pa.array([dist.max()]),
                   pa.array([len(dist)], pa.int64()), pa.array([vectors.tobytes()], pa.binary()), *lists]
            number, held, size = number + 1, [], 0
            return pa.RecordBatch.from_arrays(out, schema=schema)

        for batch in batches:
            cells = batch.column("cell").to_numpy()
            start = 0
            while start < len(cells):
                if size and (cells[start] != at or size == rows_per_block):
                    yield close()
                at = cells[start]
                end = min(int(np.searchsorted(cells, at, side="right")), start + rows_per_block - size)
                held.append(batch.slice(start, end - start))
                size, start = size + end - start, end
        if size:
            yield close()
    return run


def build_index(corpus: DataFrame, carry: tuple[str, ...] = (), n_centres: int | None = None,
                rows_per_block: int | None = None) -> MetricIndex:
    """Index of ``corpus`` (corpus_id, embedding, carried columns)."""
    spark = corpus.sparkSession
    carry = tuple(carry)
    rows = usable(corpus).select(F.col("corpus_id").cast("bigint").alias("corpus_id"), "embedding", *carry)
    stats = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max(F.size("embedding")), F.lit(0)).alias("d")).first()
    n, dim = stats["n"], stats["d"]
    if n_centres is None:
        n_centres = max(1, min(MAX_CENTRES, CENTRE_BYTES // max(8 * dim, 1), int(n ** 0.5 / 2)))
    if rows_per_block is None:
        rows_per_block = max(BLOCK_ROWS, -(-n // MAX_BLOCKS))
    # n_centres rows at most reach the driver
    picked = rows.orderBy(F.xxhash64("corpus_id"), "corpus_id").limit(n_centres).select("embedding").toArrow()
    vectors = np.vstack([_matrix(c) for c in picked.column(0).chunks if len(c)]) if picked.num_rows else np.zeros((1, dim))
    centres = spark.sparkContext.broadcast(np.unique(vectors, axis=0))

    fields = [(f.name, f.dataType.simpleString()) for f in rows.schema.fields]
    assigned = rows.mapInArrow(_assign(centres, carry), "cell int, dist double, " + ", ".join(f"`{a}` {t}" for a, t in fields))
    ordered = assigned.repartitionByRange("cell", "dist", "corpus_id").sortWithinPartitions("cell", "dist", "corpus_id")
    kept = [(a, t) for a, t in fields if a != "embedding"]
    ddl = ("block bigint, cell int, inner double, outer double, n bigint, vectors binary, "
           + ", ".join(f"`{a}` array<{t}>" for a, t in kept))
    from pyspark.sql.pandas.types import to_arrow_schema
    schema = to_arrow_schema(spark.createDataFrame([], ddl).schema)
    blocks = cut_lineage(ordered.mapInArrow(_cut(rows_per_block, schema, _width(rows)), ddl))
    headers = blocks.select("block", "cell", "inner", "outer", "n").toPandas().sort_values("block")  # MAX_BLOCKS, and a block for each cell and task, at most
    packed = np.rec.fromarrays([headers["block"].to_numpy("int64"), headers["cell"].to_numpy("int64"), headers["inner"].to_numpy("float64"),
                                headers["outer"].to_numpy("float64"), headers["n"].to_numpy("int64")], names="block,cell,inner,outer,n")
    return MetricIndex(blocks, centres.value, packed, carry, _width(rows))


# ------------------------------------------------------------------ search --

def lower_bounds(queries: np.ndarray, centres: np.ndarray, headers: np.ndarray) -> np.ndarray:
    """Squared distance that no vector of a block is nearer than, for each
    query and block."""
    sq, slip = _sq(queries, centres)
    low, high = np.sqrt(np.maximum(sq - slip, 0.0))[:, headers["cell"]], np.sqrt(sq + slip)[:, headers["cell"]]
    # the stored rings are direct sums, right to a few units in the last place
    gap = np.maximum(low - headers["outer"] * (1 + 1e-12), headers["inner"] * (1 - 1e-12) - high)
    return np.square(np.maximum(gap, 0.0)) * (1 - 1e-12)


def _visit(shared):
    """(block, query) visits: the first blocks of each query in order of
    their bound."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, headers = shared.value
        tile = max(1, min(256, TILE_BOUNDS // max(len(headers), 1)))
        for batch in batches:
            for a in range(0, batch.num_rows, tile):
                part = batch.slice(a, tile)
                bound = lower_bounds(_matrix(part.column("embedding")), centres, headers)
                order = np.argsort(bound, axis=1, kind="stable")[:, :FIRST_VISITS]
                taken = part.take(pa.array(np.repeat(np.arange(part.num_rows), order.shape[1])))
                yield pa.RecordBatch.from_arrays([pa.array(headers["block"][order.reshape(-1)], pa.int64()), taken.column("query_id"),
                                                  taken.column("embedding")], ["block", "query_id", "embedding"])
    return run


def _route(shared, regions: np.ndarray):
    """Queries with their k-th distance so far -> a row for each region that
    may hold a neighbour, with the number of its blocks that may."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, headers = shared.value
        starts = np.flatnonzero(np.r_[True, regions[1:] != regions[:-1]]) if len(regions) else np.empty(0, np.int64)
        tile = max(1, min(256, TILE_BOUNDS // max(len(headers), 1)))
        for batch in batches:
            for a in range(0, batch.num_rows if len(starts) else 0, tile):
                part = batch.slice(a, tile)
                bound = lower_bounds(_matrix(part.column("embedding")), centres, headers)
                worst = np.nan_to_num(part.column("worst").to_numpy(zero_copy_only=False), nan=np.inf)
                open_ = np.add.reduceat((bound <= worst[:, None]).astype(np.int64), starts, axis=1)
                q, r = np.nonzero(open_)
                taken = part.take(pa.array(q))
                yield pa.RecordBatch.from_arrays([pa.array(regions[starts[r]], pa.int32()), pa.array(open_[q, r]), *taken.columns],
                                                 ["region", "visits", *taken.schema.names])
    return run


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Visits sorted by block -> rows of one block and at most PACK queries."""
    names = ["block", "query_ids", "vectors"]

    def row(block, rows):
        table = pa.Table.from_batches(rows).combine_chunks()
        x = np.vstack([_matrix(c) for c in table.column("embedding").chunks])
        return pa.RecordBatch.from_arrays([
            pa.array([block], pa.int64()), pa.array([table.column("query_id").to_numpy()], pa.list_(pa.int64())),
            pa.array([x.tobytes()], pa.binary())], names)

    held, size, at = [], 0, None
    for batch in batches:
        blocks = batch.column("block").to_numpy()
        start = 0
        while start < len(blocks):
            if size and (blocks[start] != at or size == PACK):
                yield row(at, held)
                held, size = [], 0
            at = int(blocks[start])
            end = min(int(np.searchsorted(blocks, at, side="right")), start + PACK - size)
            held.append(batch.slice(start, end - start))
            size, start = size + end - start, end
    if size:
        yield row(at, held)


def _score(k: int, dtype: type, exclude_self: bool):
    """Packed visits with their blocks -> the k nearest of each visit."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                get = lambda c: batch.column(c)[i]  # noqa: E731, B023
                ids, qids = get("corpus_id").values.to_numpy(), get("query_ids").values.to_numpy()
                c = np.frombuffer(get("vectors").as_buffer(), dtype).reshape(len(ids), -1)
                q = np.frombuffer(get("query_vectors").as_buffer(), np.float64).reshape(len(qids), -1)
                rows, _, exact = nearest(q, squares(q), qids if exclude_self else None, c, squares(c), ids, np.full(len(qids), np.inf), k)
                yield pa.RecordBatch.from_arrays([pa.array(qids[rows]), pa.array(exact)], ["query_id", "distance"])
    return run


def squares(x: np.ndarray) -> np.ndarray:
    """Squared norms, summed in doubles."""
    return np.einsum("ij,ij->i", x, x, dtype=np.float64)


def _estimated(q: np.ndarray, q_sq: np.ndarray, same: np.ndarray | None, c: np.ndarray, c_sq: np.ndarray,
               worst: np.ndarray, k: int, dtype: type) -> tuple[np.ndarray, np.ndarray]:
    """(query, place in ``c``) of all pairs that may be among the k nearest of
    the query and no farther than ``worst``, however many tie, by estimates
    q.c - |c|^2 / 2 in ``dtype``: the larger, the nearer."""
    value = q.astype(dtype, copy=False) @ c.astype(dtype, copy=False).T
    value -= (c_sq / 2).astype(dtype)
    if same is not None:
        value[same] = -np.inf
    # twice what the rounding of components, products and sums may amount to
    slip = 2 * (c.shape[1] + 8) * np.finfo(dtype).eps * (q_sq + c_sq.max())
    below = lambda x: np.nextafter(x.astype(dtype), dtype(-np.inf))
    least = below((q_sq - worst) / 2 - slip)
    many = np.isinf(worst)
    for _ in range(2):
        if len(c) > k and many.any():
            kth = np.partition(value[many], len(c) - k, axis=1)[:, len(c) - k]
            least[many] = np.maximum(least[many], below(kth - 2 * slip[many]))
        rows, cols = np.divmod(np.flatnonzero(value >= least[:, None]), len(c))
        many = ~many & (np.bincount(rows, minlength=len(q)) > MANY * k)
        if not many.any():
            break
    if same is not None:
        other = ~same[rows, cols]
        rows, cols = rows[other], cols[other]
    return rows, cols


def nearest(q: np.ndarray, q_sq: np.ndarray, own: np.ndarray | None, c: np.ndarray, c_sq: np.ndarray, ids: np.ndarray,
            worst: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k nearest of each query among ``c`` that are no farther than
    ``worst``, ties by id: (query, place in ``c``, distance), by query.
    ``q_sq`` and ``c_sq`` are the squared norms; ``own`` are the queries' ids,
    if a query is not to meet its own vector."""
    same = None if own is None else own[:, None] == ids
    top = c_sq.max()
    rows = cols = None
    if SINGLE[0] <= top <= SINGLE[1] and q_sq.max() <= SINGLE[1]:
        rows, cols = _estimated(q, q_sq, same, c, c_sq, worst, k, np.float32)
    if rows is None or len(rows) > 4 * MANY * k * len(q):  # near ones that single precision does not tell apart
        rows, cols = _estimated(q, q_sq, same, c, c_sq, worst, k, np.float64)
    exact = np.empty(len(rows))
    step = max(1, PAIR_BYTES // (8 * max(q.shape[1], 1)))
    for a in range(0, len(rows), step):
        d = np.subtract(q[rows[a:a + step]], c[cols[a:a + step]], dtype=np.float64)
        exact[a:a + step] = np.einsum("ij,ij->i", d, d)
    keep = (exact <= worst[rows]) & (exact < np.inf)
    rows, cols, exact = rows[keep], cols[keep], exact[keep]
    order = np.lexsort((ids[cols], exact, rows))
    rows, cols, exact = rows[order], cols[order], exact[order]
    first = np.arange(len(rows)) - np.searchsorted(rows, rows) < k
    return rows[first], cols[first], exact[first]


def by_query(rows: np.ndarray, k: int, *columns: tuple[np.ndarray, object]) -> tuple[np.ndarray, list[np.ndarray]]:
    """What :func:`nearest` found as a row of ``k`` places for each query that
    has any: the queries, and each column (values, what fills empty places)."""
    hit, back = np.unique(rows, return_inverse=True)
    slot = np.arange(len(rows)) - np.searchsorted(rows, rows)
    out = []
    for values, empty in columns:
        table = np.full((len(hit), k), empty, values.dtype)
        table[back, slot] = values
        out.append(table)
    return hit, out


def _meet(k: int, carry: tuple[str, ...], exclude_self: bool, shared, dtype: type, width: type, types: pa.Schema):
    """A slice of queries and the blocks of a region -> the k nearest of each
    query there, none farther than its k-th distance so far."""
    def run(asked: pa.Table, blocks: pa.Table) -> pa.Table:
        if not asked.num_rows or not blocks.num_rows:
            return types.empty_table()
        centres, headers = shared.value
        at = headers[np.searchsorted(headers["block"], np.sort(blocks.column("block").to_numpy()))]
        blocks = blocks.sort_by("block")
        ids = blocks.column("corpus_id").combine_chunks().flatten()
        ids = ids.to_numpy(zero_copy_only=False)
        data = [np.frombuffer(v.as_buffer(), dtype).reshape(n, -1) for v, n in zip(blocks.column("vectors"), at["n"], strict=True)]
        sizes = [squares(d) for d in data]
        ends = np.r_[0, np.cumsum(at["n"])]
        x = np.vstack([_matrix(p, width) for p in asked.column("embedding").chunks if len(p)])
        near = _nearest_cell(x, centres[np.unique(at["cell"])])
        order = np.argsort(near, kind="stable")  # queries of one cell share the blocks that they need
        x, qids = x[order], asked.column("query_id").to_numpy()[order]
        worst = np.nan_to_num(asked.column("worst").to_numpy()[order], nan=np.inf)
        n_q = len(qids)
        best_d, best_i = np.full((n_q, k), np.inf), np.zeros((n_q, k), np.int64)  # place in the region
        per = max(1, PAIR_TILE // 1024)
        for a in range(0, n_q, per):
            q, limit = x[a:a + per], worst[a:a + per]
            bound, q_sq = lower_bounds(q.astype(np.float64), centres, at), squares(q)
            held = np.arange(len(q))
            todo = np.argsort(bound.min(axis=0), kind="stable")  # the nearest blocks first
            for group in (todo[b:b + 4] for b in range(0, len(todo), 4)):
                far = np.minimum(limit, best_d[a:a + per, -1])
                group = group[(bound[:, group] <= far[:, None]).any(axis=0)]
                if not len(group):
                    continue
                some = held[(bound[:, group] <= far[:, None]).any(axis=1)]
                place = np.concatenate([np.arange(ends[g], ends[g + 1]) for g in group])
                c, c_sq = np.concatenate([data[g] for g in group]), np.concatenate([sizes[g] for g in group])
                mine = slice(None) if len(some) == len(q) else some
                rows, cols, exact = nearest(q[mine], q_sq[mine], qids[a:a + per][mine] if exclude_self else None, c, c_sq, ids[place], far[mine], k)
                if not len(rows):
                    continue
                # the found ones and those so far, the k first of each query
                hit, (d, i) = by_query(rows, k, (exact, np.inf), (place[cols], 0))
                to = a + some[hit]
                d, i = np.concatenate([best_d[to], d], axis=1), np.concatenate([best_i[to], i], axis=1)
                first = np.lexsort((ids[i], d), axis=1)[:, :k]
                best_d[to], best_i[to] = np.take_along_axis(d, first, axis=1), np.take_along_axis(i, first, axis=1)
        rows, slot = np.nonzero(np.isfinite(best_d))
        place = best_i[rows, slot]
        carried = [blocks.column(n).combine_chunks().flatten().take(pa.array(place)) for n in carry]
        out = [pa.array(qids[rows]), pa.array(ids[place]), pa.array(best_d[rows, slot]), *carried]
        return pa.Table.from_arrays([v.cast(f.type) for v, f in zip(out, types, strict=True)], schema=types)
    return run


def _nearest_cell(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.concatenate([_sq(x[a:a + 1024].astype(np.float64), centres)[0].argmin(axis=1) for a in range(0, len(x), 1024)])


def _regions(headers: np.ndarray, row_bytes: int, least: int) -> np.ndarray:
    """The region of each block, in order: runs of blocks of GRID_BYTES of
    vectors at most (or one block), ``least`` of them where there are as many
    blocks."""
    total = int(headers["n"].sum())
    count = max(-(-total * row_bytes // GRID_BYTES), least)
    rows = max(1, -(-total // count))
    return ((np.cumsum(headers["n"]) - headers["n"]) // rows).astype(np.int32)


def search_index(queries: DataFrame, index: MetricIndex, k: int, exclude_self: bool = False,
                 visited: list | None = None) -> DataFrame:
    """Exact k nearest of every query (query_id, embedding): query_id, rank,
    corpus_id, distance (squared L2) and the carried columns.

    ``visited``, if given, receives the number of (query, block) visits of
    each round."""
    spark = queries.sparkSession
    shared = spark.sparkContext.broadcast((index.centres, index.headers))  # bounded at the build
    q = usable(queries).select(F.col("query_id").cast("bigint").alias("query_id"), "embedding")
    vector = q.schema["embedding"].dataType.simpleString()
    # written once: a row keeps its number, and with it its slice
    q = cut_lineage(q.withColumn("at", F.monotonically_increasing_id()))
    carried = [f"`{c}` {index.blocks.schema[c].dataType.elementType.simpleString()}" for c in index.carry]
    ddl = ", ".join([HIT, *carried])
    from pyspark.sql.pandas.types import to_arrow_schema
    types = to_arrow_schema(spark.createDataFrame([], ddl).schema)
    best = Window.partitionBy("query_id").orderBy("distance", "corpus_id")

    # the k-th distance in the nearest blocks
    spread = q.mapInArrow(_visit(shared), f"block bigint, query_id bigint, embedding {vector}")
    spread = spread.repartitionByRange("block", "query_id").sortWithinPartitions("block", "query_id")
    packs = cut_lineage(spread.mapInArrow(_pack, "block bigint, query_ids array<bigint>, vectors binary"))
    if visited is not None:
        visited.append(packs.agg(F.coalesce(F.sum(F.size("query_ids")), F.lit(0))).first()[0])
    near = packs.withColumnRenamed("vectors", "query_vectors").join(index.blocks.select("block", "vectors", "corpus_id"), "block")
    near = near.mapInArrow(_score(k, index.dtype, exclude_self), "query_id bigint, distance double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("distance"))
    kth = near.withColumn("rank", rank).where(F.col("rank") == k).select("query_id", F.col("distance").alias("worst"))
    dim, n_q = index.centres.shape[1], q.count()
    widest = (PACK + int(index.headers["n"].max(initial=1))) * max(dim, 1) * 8
    with batches_of(spark, max(1, BATCH_BYTES // widest)):
        kth = cut_lineage(kth)

    # slices of queries meet the regions that may hold their neighbours
    least = int(np.ceil(np.sqrt(2 * spark.sparkContext.defaultParallelism)))  # a few tasks a core
    width = _width(q)
    slices = max(-(-n_q * dim * np.dtype(width).itemsize // GRID_BYTES), least)
    regions = _regions(index.headers, dim * np.dtype(index.dtype).itemsize, least)
    asked = q.join(kth, "query_id", "left").select(F.pmod("at", F.lit(slices)).cast("int").alias("slice"), "query_id", "embedding", "worst")
    routed = cut_lineage(asked.mapInArrow(_route(shared, regions), f"region int, visits bigint, slice int, query_id bigint, embedding {vector}, worst double"))
    if visited is not None:
        visited.append(routed.agg(F.coalesce(F.sum("visits"), F.lit(0))).first()[0])
    of = spark.createDataFrame(pa.table({"block": pa.array(index.headers["block"], pa.int64()), "region": pa.array(regions, pa.int32())}))
    wanted = routed.select(F.col("region").alias("in_region"), F.col("slice").alias("for_slice")).distinct()  # slices x regions at most
    sent = (index.blocks.select("block", "vectors", "corpus_id", *index.carry).join(F.broadcast(of), "block")
            .join(F.broadcast(wanted), F.col("region") == F.col("in_region")).drop("region"))
    # about a task for each slice and region, so that no core is left with several at the end
    tasks = max(spark.sparkContext.defaultParallelism * 4, min(slices * int(regions.max(initial=0) + 1), MAX_TASKS))
    found = (routed.repartition(tasks, "slice", "region").groupBy("slice", "region")
             .cogroup(sent.repartition(tasks, "for_slice", "in_region").groupBy("for_slice", "in_region"))
             .applyInArrow(_meet(k, index.carry, exclude_self, shared, index.dtype, width, types), ddl))
    hits = found.withColumn("rank", F.row_number().over(best).cast("bigint")).where(F.col("rank") <= k)
    return cut_lineage(hits.select("query_id", "rank", "corpus_id", "distance", *index.carry))
