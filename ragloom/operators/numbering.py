"""Running numbers by sort (P3, page numbering of S1).

``row_number() over (order by ...)`` with no partition sends every row to one
task.  Here the keys alone (no text) are range-partitioned by the order, sorted,
and written once with their running sums inside the partition; one aggregate
gives a row per partition, and the sums before each partition -- as many values
as there are tasks -- are added up on the driver and looked up by partition.
There is no window, so nothing depends on how ids are spread: one row per
source, hashed ids, and a source with a third of all rows cost the same.

The numbers are then joined to the rows by the keys, which moves every row once
(with the text only where the caller reads it).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ragloom.session import cut_lineage


def _changes(columns: list, last: list | None, n: int) -> np.ndarray:
    """Rows whose key (any of ``columns``) differs from that of the row before
    (``last``: the key before the first; None where there is none)."""
    out = np.zeros(n, bool)
    for i, col in enumerate(columns):
        null = pc.is_null(col).to_numpy(zero_copy_only=False)
        if n > 1:
            same = pc.fill_null(pc.equal(col[1:], col[:-1]), False).to_numpy(zero_copy_only=False) | (null[1:] & null[:-1])
            out[1:] |= ~same
        if last is not None and n:
            out[0] |= last[i] != col[0].as_py()
    if last is None and n:
        out[0] = True
    return out


def _running(keys: list[str], weights: list[str], reset: dict[str, list[str]]):
    """Keys in order -> with, for each weight, the sum before the row in this
    partition (``e_``; restarted where its reset key changes) and whether the
    row is in the partition's first reset group (``f_``); the partition, the
    place in it, and whether the whole key repeats the one before."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        task, place = TaskContext.get().partitionId(), 0
        last: dict = {}  # key columns -> their values in the row before
        total, leading = dict.fromkeys(weights, 0), dict.fromkeys(weights, True)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            new = {}
            for cols in {tuple(keys), *map(tuple, reset.values())}:
                columns = [batch.column(c) for c in cols]
                new[cols] = _changes(columns, last.get(cols), n)
                last[cols] = [c[n - 1].as_py() for c in columns]
            out, names = list(batch.columns), list(batch.schema.names)
            for w in weights:
                value = batch.column(f"w_{w}").to_numpy(zero_copy_only=False).astype(np.int64)
                before = np.cumsum(value) - value + total[w]
                starts = np.flatnonzero(new[tuple(reset[w])]) if reset[w] else np.empty(0, np.int64)
                if not place:
                    starts = starts[starts > 0]  # the partition's first row opens its first group
                first = np.full(n, leading[w])
                if len(starts):
                    first[starts[0]:] = leading[w] = False
                    before[starts[0]:] -= np.repeat(before[starts], np.diff(np.r_[starts, n]))
                total[w] = int(before[-1] + value[-1])
                out += [pa.array(before), pa.array(first)]
                names += [f"e_{w}", f"f_{w}"]
            out += [pa.array(np.full(n, task), pa.int32()), pa.array(np.arange(place, place + n)), pa.array(~new[tuple(keys)])]
            place += n
            yield pa.RecordBatch.from_arrays(out, [*names, "part", "place", "again"])
    return run


def _before(parts: list, weights: list[str], reset: dict[str, list[str]]) -> list[tuple]:
    """For each partition, in order: what each weight had summed up to before
    it (where the first group goes on from the partition before, else 0)."""
    out, carry, open_key = [], dict.fromkeys(weights, 0), dict.fromkeys(weights)
    for p in sorted(parts, key=lambda r: r["part"]):
        row = [p["part"]]
        for w in weights:
            goes_on = not reset[w] or open_key[w] == p[f"first_{w}"]
            base = carry[w] if goes_on else 0
            row.append(base)
            carry[w] = p[f"tail_{w}"] + (base if p[f"one_{w}"] else 0)
            open_key[w] = p[f"last_{w}"]
        out.append(tuple(row))
    return out


def ordered_offsets(df: DataFrame, by: list[str], num: str,
                    weights: dict[str, Column], reset_by: dict[str, list[str]] | None = None,
                    then: list[str] | None = None) -> DataFrame:
    """Add, for each ``name -> weight``, the exclusive running sum of ``weight``
    over the order ``(by..., num, then...)``.

    ``reset_by[name]`` (a prefix of ``by``) restarts that sum for each distinct
    value; default is a global running sum.  Weights are cast to BIGINT, null
    counts 0.  Nulls come first.  Rows that repeat a whole key follow each
    other in an arbitrary order, each with numbers of its own.
    """
    spark = df.sparkSession
    then = list(then or [])
    keys = [*by, num, *then]
    names = list(weights)
    reset = {name: list((reset_by or {}).get(name, [])) for name in names}
    for name, cols in reset.items():
        if cols != list(by[:len(cols)]):
            raise ValueError(f"reset_by[{name}] must be a prefix of {by}")

    weighed = {name: F.coalesce(w.cast("bigint"), F.lit(0).cast("bigint")) for name, w in weights.items()}
    narrow = df.select(*keys, *[w.alias(f"w_{n}") for n, w in weighed.items()])
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema.fields)
    ddl = fields + "".join(f", `e_{n}` bigint, `f_{n}` boolean" for n in names) + ", part int, place bigint, again boolean"
    ordered = narrow.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = cut_lineage(ordered.mapInArrow(_running(keys, names, reset), ddl))

    whole = lambda n: F.struct(*reset[n]) if reset[n] else F.lit(0)
    parts = placed.groupBy("part").agg(
        F.max("again").alias("again"),
        *[F.max_by(F.col(f"e_{n}") + F.col(f"w_{n}"), "place").alias(f"tail_{n}") for n in names],
        *[F.min(f"f_{n}").alias(f"one_{n}") for n in names],
        *[F.min_by(whole(n), "place").alias(f"first_{n}") for n in names],
        *[F.max_by(whole(n), "place").alias(f"last_{n}") for n in names]).collect()  # a row a task
    offsets = spark.createDataFrame(_before(parts, names, reset), "part int" + "".join(f", `b_{n}` bigint" for n in names))
    final = placed.join(F.broadcast(offsets), "part").select(
        *[F.col(k).alias(f"__k_{k}") for k in keys], *[F.col(f"w_{n}").alias(f"__w_{n}") for n in names], F.col("place").alias("__place"),
        *[(F.col(f"e_{n}") + F.when(F.col(f"f_{n}"), F.col(f"b_{n}")).otherwise(0)).alias(n) for n in names])

    if set(df.columns) <= set(keys):  # nothing to attach the numbers to
        return final.select(*[F.col(f"__k_{k}").alias(k) for k in df.columns], *names)
    repeats = any(p["again"] for p in parts)
    on = lambda left, right: [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right, strict=True)]
    if not repeats:
        return df.join(final, on(keys, [f"__k_{k}" for k in keys])).select(*df.columns, *names)
    # rows with the same whole key: the r-th of the one side takes the r-th
    # number of the other, among rows of equal weights
    rank = lambda cols: F.row_number().over(Window.partitionBy(*cols).orderBy(F.lit(0)))
    left = df.select("*", *[w.alias(f"__v_{n}") for n, w in weighed.items()])
    left = left.withColumn("__r", rank([*keys, *[f"__v_{n}" for n in names]]))
    right = final.withColumn("__s", F.row_number().over(
        Window.partitionBy(*[f"__k_{k}" for k in keys], *[f"__w_{n}" for n in names]).orderBy("__place")))
    return left.join(right, on([*keys, *[f"__v_{n}" for n in names], "__r"], [*[f"__k_{k}" for k in keys], *[f"__w_{n}" for n in names], "__s"])
                     ).select(*df.columns, *names)
