"""Best-fit packing of token sequences, bulk-synchronous (operator 6).

Documents longer than a sequence are cut into full pieces and a rest; all
others stay whole.  The pieces are range-sorted by length: their rank among
the pieces of the same length is counted per task and shifted by the counts of
the tasks before, so no length, however frequent, meets in one task.

Gaps are open sequences sorted by the room left.  A sweep goes from the
longest pieces to the shortest.  For a length it looks up the successor gap,
the smallest that holds it; pieces and gaps of these sizes are matched by
rank, so that no two pieces claim one sequence; the gaps shrink, and what is
left of the pieces repeats with the next successor, or opens sequences.
Pieces of a length and sequences with the same room are runs of ranks, so a
sweep handles at most ``capacity`` lengths whatever the number of documents,
and its matches (length, first rank, count, first sequence, offset) are a
table bounded by the capacity, not by the data; the pieces find their match in
it by length and rank, each task for its own rows.

Defined results: a null text is an empty text (its end id alone, one piece);
rows that repeat a doc_id are packed each for itself; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import batches_of, stored, worker_state
from .words import flat_lists, library_ids, library_tokenizer, parts_of, plain_unit_lists

CAPACITY = 4096
AT_ONCE = 1000  # documents in a batch that holds their texts
PART, CACHED = 1 << 20, 75_000  # bytes of texts that are encoded at a call, words in a task's memory with their ids
PIECES = "uid long, doc_id long, piece int, start long, length long, ids_crc32 long, task long, nth long"


def _pieces(tokenizer_path: str, end_id: int, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        task = TaskContext.get().partitionId()
        cache = library_ids(worker_state(f"tokenizer of {tokenizer_path}", lambda: library_tokenizer(tokenizer_path)), "<u4", CACHED)
        seen, end = [0] * (capacity + 1), np.array([end_id], "<u4").tobytes()
        fields = [("uid", pa.int64()), ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                  ("length", pa.int64()), ("ids_crc32", pa.int64()), ("task", pa.int64()), ("nth", pa.int64())]
        for batch in batches:
            rows, keys = [], zip(batch.column("uid").to_pylist(), batch.column("doc_id").to_pylist(), strict=True)
            for part in parts_of(batch.column("text"), PART):
                units, offsets = flat_lists(plain_unit_lists(part))
                found = units.dictionary_encode()
                for ids in cache.lists(found.dictionary, found.indices.to_numpy(), offsets[1:]):
                    uid, doc_id = next(keys)
                    ids += end
                    for piece, start in enumerate(range(0, len(ids), 4 * capacity)):
                        own = ids[start:start + 4 * capacity]
                        n = len(own) // 4
                        rows.append((uid, doc_id, piece, start // 4, n, zlib.crc32(own), task, seen[n]))
                        seen[n] += 1
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(fields)], [n for n, _ in fields])
    return run


class Gaps:
    """Open sequences by the room left: runs (first sequence, count)."""

    def __init__(self):
        self._rooms: list[int] = []
        self._runs: dict[int, list[tuple[int, int]]] = {}

    def put(self, room: int, first: int, count: int) -> None:
        if room not in self._runs:
            insort(self._rooms, room)
            self._runs[room] = []
        self._runs[room].append((first, count))

    def take(self, length: int, count: int) -> tuple[int, int, int] | None:
        """(room, first sequence, how many) of the successor gap of a length."""
        i = bisect_left(self._rooms, length)
        if i == len(self._rooms):
            return None
        room = self._rooms[i]
        first, n = self._runs[room].pop()
        if n > count:
            self._runs[room].append((first + count, n - count))
        elif not self._runs[room]:
            del self._runs[room], self._rooms[i]
        return room, first, min(n, count)


def sweep(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Matches (length, first rank, count, first sequence, offset) of all
    pieces, given the number of pieces of each length."""
    gaps, matches, opened = Gaps(), [], 0
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            found = gaps.take(length, left)
            if found is None:  # no gap holds it: as many new sequences as pieces of this length fill
                found = capacity, opened, -(-left // (capacity // length))
                opened += found[2]
            room, first, n = found
            matches.append((length, rank, n, first, capacity - room))
            gaps.put(room - length, first, n) if room > length else None
            rank, left = rank + n, left - n
    return matches


def _place(matches):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length, rank, _, first, offset = (np.array(x, np.int64) for x in matches.value)
        key = length << 40 | rank  # sorted; ranks stay below 2 ** 40
        for batch in batches:
            mine = {c: batch.column(c).to_numpy() for c in ("length", "rank")}
            at = np.searchsorted(key, mine["length"] << 40 | mine["rank"], side="right") - 1
            columns = [batch.column(c) for c in ("uid", "doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(first[at] + mine["rank"] - rank[at]), pa.array(offset[at])],
                ["uid", "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])
    return run


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 1, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: uid (the document's number in the scan), doc_id,
    piece, start, length, ids_crc32, sequence_id, offset."""
    texts = docs.select(F.monotonically_increasing_id().alias("uid"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    with batches_of(docs.sparkSession, AT_ONCE):
        pieces = stored(texts.mapInArrow(_pieces(tokenizer_path, end_id, capacity), PIECES), "pieces")
    per_task = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    shifts = per_task.select("length", "task", F.coalesce(before, F.lit(0)).alias("shift"))
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # capacity rows at most
    matches = sorted(sweep(counts, capacity))
    columns = docs.sparkSession.sparkContext.broadcast([list(c) for c in zip(*matches, strict=True)] or [[]] * 5)
    ranked = pieces.join(shifts, ["length", "task"]).withColumn("rank", F.col("nth") + F.col("shift"))
    return ranked.mapInArrow(_place(columns), "uid long, doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
