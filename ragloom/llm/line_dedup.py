"""Line deduplication by pairwise alignment (operator 2).

Of two documents, the blocks they share are deleted from the later one.  A
block is a run of lines that follow each other in both (blanks at their ends
apart) and hold at least ``least_chars`` characters together, be it one line
or many short ones, wherever it lies in either document and however often.

Partners: the keys of a document are the hashes of its shortest runs of that
length, from every line onwards and up to every line.  A block has such a run
around each of its lines: up to a line if what lies before it in the block is
long enough, else from the block's start.  One aggregation finds the first
document of every key; a document's partners are the first documents of its
keys.  So copies form a star around the first of them, never pairs among
themselves, and no key is too common to count; the join of keys and first
documents is an inner join of stored tables, which Spark splits at a frequent
key, and the pairs of a frequent partner are dealt to ``SALTS`` parts.

Alignment: a pair's lines (128 bits of hash each) are matched by patience
diff, and aligned blocks of the length are marked.  What shares a run with
the partner and stays unmarked (blocks in another order, stretches without a
line that is unique in both) is aligned again with the whole partner, while
every round halves it; the rest, lines that repeat, is compared with the
partner run by run.  In the end every line of the later document that is in a
block shared with the partner is marked, whatever path the diff took.

Order of documents: doc_id (null last), then the row's number in the scan.
Defined results: null and empty texts have one empty line and stay as they
are; what only one document repeats stays; rows that repeat a doc_id are
documents of their own; an empty table gives no rows; other columns are kept
by ``dedup_lines``.  ``docs`` is read once, to be numbered and written.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import numbered, stored, unused

LEAST_CHARS = 40
DEPTH = 64  # levels of the diff; what lies deeper is compared run by run
SALTS = 256  # parts that the pairs of one partner are dealt to
BASE = 0x9E3779B97F4A7C15  # odd, 5 mod 8


def lines_of(text: str | None) -> list[str]:
    return (text or "").split("\n")


def _once(a: list, start: int, end: int) -> dict:
    counts = Counter(a[start:end])
    return {x: i for i, x in enumerate(a[start:end], start) if counts[x] == 1}


def _longest_order(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest part of pairs (sorted by the first) that rises in the second."""
    tops, piles, back = [], [], [-1] * len(pairs)
    for n, (_, j) in enumerate(pairs):
        pile = bisect_left(tops, j)
        back[n] = piles[pile - 1] if pile else -1
        if pile == len(tops):
            tops.append(j)
            piles.append(n)
        else:
            tops[pile], piles[pile] = j, n
    out, n = [], piles[-1] if piles else -1
    while n >= 0:
        out.append(pairs[n])
        n = back[n]
    return out[::-1]


def patience(a: list, b: list) -> list[tuple[int, int]]:
    """Matched positions of two sequences, in order."""
    found, todo = [], [(0, len(a), 0, len(b), 0)]
    while todo:
        a0, a1, b0, b1, depth = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            found.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            found.append((a1, b1))
        if a0 == a1 or b0 == b1 or depth == DEPTH:
            continue
        once_a, once_b = _once(a, a0, a1), _once(b, b0, b1)
        anchors = _longest_order([(i, once_b[x]) for x, i in once_a.items() if x in once_b])
        found += anchors
        for (i, j), (k, m) in zip([(a0 - 1, b0 - 1), *anchors], [*anchors, (a1, b1)], strict=True) if anchors else ():
            if i + 1 < k and j + 1 < m:
                todo.append((i + 1, k, j + 1, m, depth + 1))
    return sorted(found)


# lines and runs

def line_hashes(text: str | None) -> tuple[bytes, np.ndarray]:
    """The 16-byte hashes of a text's lines without blanks at their ends, and their lengths."""
    own = [x.strip() for x in lines_of(text)]
    return b"".join(xxhash.xxh3_128_digest(x.encode("utf-8", "surrogatepass")) for x in own), np.array([len(x) for x in own], "<i4")


def _shortest(sums: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Start and end of the shortest runs of ``least`` characters: first those
    from every line onwards, whose number is the third, then those up to every line."""
    ends = np.searchsorted(sums, sums[:-1] + least)  # len(sums) if the rest is too short
    starts = np.searchsorted(sums, sums[1:] - least, "right") - 1  # -1 if what is before is too short
    lead, trail = np.flatnonzero(ends < len(sums)), np.flatnonzero(starts >= 0)
    return np.concatenate([lead, starts[trail]]), np.concatenate([ends[lead], trail + 1]), len(lead)


def _run_keys(hashes: bytes, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    h = np.frombuffer(hashes, "<u8")[::2]
    powers = (np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(h), x, np.uint64)])) for x in (BASE, pow(BASE, -1, 1 << 64)))
    up, down = powers
    prefix = np.concatenate([[np.uint64(0)], np.cumsum(h * up[:-1], dtype=np.uint64)])
    return ((prefix[end] - prefix[start]) * down[start]).astype(np.int64)


def runs_of(hashes: bytes, chars: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Start, end and key of a document's shortest runs, and how many of them are from a line onwards."""
    start, end, leads = _shortest(np.concatenate([[0], np.cumsum(chars, dtype=np.int64)]), least)
    return start, end, _run_keys(hashes, start, end), leads


def _keys(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [line_hashes(text) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column("uid"), batch.column("doc_id"), pa.array([x for x, _ in rows], pa.binary()), pa.array([c.tobytes() for _, c in rows], pa.binary()),
                pa.array([np.unique(runs_of(x, c, least)[2]) for x, c in rows], pa.list_(pa.int64()))], ["uid", "doc_id", "lines", "chars", "keys"])
    return run


# alignment of a pair

def _blocks(pairs: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Start and end, in the first sequence, of the matches that follow each other in both."""
    at = 0
    for n in range(1, len(pairs) + 1):
        if n == len(pairs) or pairs[n][0] != pairs[n - 1][0] + 1 or pairs[n][1] != pairs[n - 1][1] + 1:
            yield pairs[at][0], pairs[n - 1][0] + 1
            at = n


def _compared(a: list, b: list, runs: list[tuple[int, int, int]], first_to_last: bool) -> Iterator[tuple[int, int]]:
    """The runs (start, end, place in b) that are equal in both; those inside the one found before are passed over."""
    done = None
    for s, e, j in runs if first_to_last else reversed(runs):
        if done is not None and (e <= done if first_to_last else s >= done):
            continue
        if a[s:e] == b[j:j + e - s]:
            done = e if first_to_last else s
            yield s, e


def _ranges(marks: list[bool]) -> list[tuple[int, int]]:
    out, at = [], None
    for i, marked in enumerate([*marks, False]):
        if marked and at is None:
            at = i
        elif not marked and at is not None:
            out.append((at, i))
            at = None
    return out


class Side:
    """A document's lines, with its runs where an alignment needs them."""

    def __init__(self, hashes: bytes, chars: bytes, least: int):
        self.hashes, self.chars, self.least = hashes, np.frombuffer(chars, "<i4"), least
        self.lines = [hashes[i:i + 16] for i in range(0, len(hashes), 16)]
        self.sums = [0, *np.cumsum(self.chars, dtype=np.int64).tolist()]

    def runs(self) -> tuple[list, list]:
        """(start, end, key) of the runs from every line onwards, and of those up to every line."""
        if not hasattr(self, "_runs"):
            start, end, key, leads = runs_of(self.hashes, self.chars, self.least)
            rows = list(zip(start.tolist(), end.tolist(), key.tolist(), strict=True))
            self._runs = rows[:leads], rows[leads:]
        return self._runs

    def places(self) -> tuple[dict, dict]:
        """Where a run of each key starts."""
        if not hasattr(self, "_places"):
            self._places = tuple({key: s for s, _, key in reversed(rows)} for rows in self.runs())
        return self._places


def aligned(a: Side, b: Side) -> list[tuple[int, int]]:
    """The ranges of a's lines that are in a block shared with b."""
    least, marks = a.least, [False] * len(a.lines)
    lines, place, before = a.lines, range(len(a.lines)), None
    while True:
        for s, e in _blocks(patience(lines, b.lines)):
            i, j = place[s], place[e - 1] + 1  # a block never holds a stretch's end, which b has nowhere
            if a.sums[j] - a.sums[i] >= least:
                marks[i:j] = [True] * (j - i)
        if all(marks):
            break
        unmarked = [0]
        for m in marks:
            unmarked.append(unmarked[-1] + (not m))
        left = [[(s, e, at[key]) for s, e, key in runs if unmarked[e] > unmarked[s] and key in at]
                for runs, at in zip(a.runs(), b.places(), strict=True)]
        if not any(left):
            break
        open_ = [False] * len(marks)
        for rows, order in zip(left, (True, False), strict=True):
            for s, e in _compared(a.lines, b.lines, rows, order):
                open_[s:e] = [True] * (e - s)
        stretches = _ranges(open_)
        size = sum(e - s for s, e in stretches)
        if before is not None and 2 * size > before:
            marks = [m or o for m, o in zip(marks, open_, strict=True)]
            break
        lines, place, before = [], [], size
        for s, e in stretches:
            lines += [*a.lines[s:e], None]
            place += [*range(s, e), -1]
    return _ranges(marks)


def _align(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partner, name = None, None
        for batch in batches:
            uids, cuts = [], []
            for uid, lines, chars, other, its_lines, its_chars in zip(*(batch.column(c) for c in ("uid", "lines", "chars", "partner", "its_lines", "its_chars")), strict=True):
                if other.as_py() != name:  # pairs with one partner mostly follow each other
                    name, partner = other.as_py(), Side(its_lines.as_py(), its_chars.as_py(), least)
                ranges = aligned(Side(lines.as_py(), chars.as_py(), least), partner)
                if ranges:
                    uids.append(uid.as_py())
                    cuts.append([x for r in ranges for x in r])
            yield pa.RecordBatch.from_arrays([pa.array(uids, pa.int64()), pa.array(cuts, pa.list_(pa.int32()))], ["uid", "cuts"])
    return run


def shared_blocks(docs: DataFrame, uid: str, least_chars: int = LEAST_CHARS) -> DataFrame:
    """uid (the row's number, ``uid`` in ``docs``) and cuts (start, end, start, end ... of
    line ranges, which may overlap) of the documents that lose lines."""
    least = max(least_chars, 1)
    texts = docs.select(F.col(uid).alias("uid"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = stored(texts.mapInArrow(_keys(least), "uid long, doc_id long, lines binary, chars binary, keys array<long>"), "lines")
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("uid"))
    keyed = rows.select("uid", order.alias("place"), F.explode("keys").alias("key"))
    shared = stored(keyed.groupBy("key").agg(F.min("place")["uid"].alias("partner"), F.count("*").alias("n")).where("n > 1").drop("n"), "shared-runs")
    pairs = stored(keyed.select("uid", "key").join(shared, "key").where("uid != partner").select(
        "uid", "partner", F.pmod(F.xxhash64("uid"), F.lit(SALTS)).alias("salt")).distinct(), "pairs")
    later = rows.select("uid", "lines", "chars").join(pairs, "uid")
    copies = pairs.select("partner", "salt").distinct().join(
        rows.select(F.col("uid").alias("partner"), F.col("lines").alias("its_lines"), F.col("chars").alias("its_chars")), "partner")
    met = later.join(copies, ["partner", "salt"]).select("uid", "lines", "chars", "partner", "its_lines", "its_chars")
    cuts = met.mapInArrow(_align(least), "uid long, cuts array<int>")
    return cuts.groupBy("uid").agg(F.flatten(F.collect_list("cuts")).alias("cuts"))  # a row for each partner, of which a document has at most its runs


def _cut(column: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, lost = [], []
            for text, cuts in zip(batch.column("text").to_pylist(), batch.column(column), strict=True):
                if cuts.is_valid:
                    lines = lines_of(text)
                    ranges, marks = cuts.values.to_numpy(), np.zeros(len(lines) + 1, np.int64)
                    np.add.at(marks, ranges[::2], 1)
                    np.add.at(marks, ranges[1::2], -1)
                    kept = np.cumsum(marks)[:-1] == 0
                    lost.append(int((~kept).sum()))
                    text = "\n".join(x for x, k in zip(lines, kept.tolist(), strict=True) if k)
                else:
                    lost.append(0)
                out.append(text)
            batch = batch.set_column(batch.schema.get_field_index("text"), "text", pa.array(out, pa.string()))
            yield batch.drop_columns([column]).append_column("n_deleted", pa.array(lost, pa.int64()))
    return run


def dedup_lines(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """``docs`` with the shared blocks cut from ``text``, and n_deleted."""
    docs = docs.drop("n_deleted")
    rows, uid = numbered(docs)
    cut = unused(docs, "__cuts")
    blocks = stored(shared_blocks(rows, uid, least_chars).select(F.col("uid").alias(uid), F.col("cuts").alias(cut)), "blocks")
    marked = rows.join(blocks.hint("merge"), uid, "left").drop(uid)  # the same join at every size
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return marked.mapInArrow(_cut(cut), f"{schema}, n_deleted long")
