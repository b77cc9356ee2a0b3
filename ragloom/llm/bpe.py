"""Byte-level BPE encoding and decoding (operator 8).

The corpus's frequent words are merged in Spark's higher-order functions: a
word is an array of byte
values, folded with ``aggregate``; every step merges the leftmost pair of
lowest rank.  The rank map is a literal column, a hash table laid out as an
array of small buckets, so that a lookup touches one bucket only.

Every distinct word is merged once for the corpus when it is among the
``vocabulary`` most frequent ones (a documented size: that table is the only
thing broadcast, at most ``vocabulary`` words of at most ``MAX_WORD`` bytes),
otherwise in the Arrow step of the documents it occurs in, by the same rule and
the same rank map, many words at a call, and at most once while a task holds it.
Decoding concatenates the binary pieces of the ids.

Defined results: a null text is an empty text (no ids, hashes of empty bytes);
repeated rows and repeated or null ids give one result row each, in any
table layout; extra columns are ignored; an empty table gives no rows.  Words
longer than ``MAX_FOLD`` bytes are merged by the same rule with a heap, because
the other ways copy the word's ids at every merge.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import batches_of, stored, worker_state
from .words import GPT2_PATTERN, WHITE, BatchIds, WordCounts, gpt2_unit_lists, parts_of, plain_parts, plain_words, spelled

EDGE = 1 << 16  # more than any id; EDGE - 1 is the guard
NO_MERGE = 1 << 20  # more than any rank
MAX_WORD = 64
MAX_FOLD = 256
VOCABULARY = 1 << 19
COUNTED = 200_000  # words in a task's memory at once
TEXTS = 1000  # documents in a batch that holds their texts
AT_ONCE = 256  # documents in a batch that holds their ids and decoded bytes
CACHED = 150_000  # words in a task's memory with their ids


def load_ranks(path: str) -> list[bytes]:
    """Token bytes by rank, from a file of base64 token and rank per line."""
    pairs = (line.split() for line in open(path, "rb") if line.strip())
    table = {int(r): base64.b64decode(t) for t, r in pairs}
    return [table[i] for i in range(len(table))]


def pair_ranks(tokens: list[bytes]) -> dict[tuple[int, int], int]:
    """(left id, right id) -> id of the merged token, for every way to cut a
    token into two tokens."""
    ids = {t: i for i, t in enumerate(tokens)}
    out = {}
    for i, t in enumerate(tokens):
        for cut in range(1, len(t)):
            left, right = ids.get(t[:cut]), ids.get(t[cut:])
            if left is not None and right is not None:
                out[left, right] = i
    return out


class RankMap:
    """The rank file as literal columns.

    The pairs are stored by row displacement: the row of a left id starts at
    ``base[left]``, its entries do not touch those of other rows, and the
    entry of (left, right) lies at ``base[left] + right`` with the left id
    beside it as a check.  One lookup reads two array elements.
    """

    SLOTS = 1 << 19

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        ids = {t: i for i, t in enumerate(tokens)}
        self.byte_ids = [ids[bytes([b])] for b in range(256)]
        rows: dict[int, list[tuple[int, int]]] = {}
        for (left, right), merged in pair_ranks(tokens).items():
            rows.setdefault(left, []).append((right, merged))
        rng = np.random.default_rng(0)
        used = np.zeros(self.SLOTS, bool)
        self.base, self.slots = np.zeros(EDGE, np.int64), np.full(self.SLOTS, -1, np.int64)
        for left in sorted(rows, key=lambda x: (-len(rows[x]), x)):
            at = np.array([right for right, _ in rows[left]])
            while True:
                start = int(rng.integers(0, self.SLOTS - EDGE))
                if not used[start + at].any():
                    break
            used[start + at] = True
            self.base[left] = start
            self.slots[start + at] = left * EDGE + np.array([merged for _, merged in rows[left]])

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What ``merge_words`` looks pairs up in."""
        return self.base, self.slots, np.array(self.byte_ids, np.int64)

    def column(self) -> Column:
        table = json.dumps({"base": self.base.tolist(), "slots": self.slots.tolist(), "bytes": self.byte_ids}, separators=(",", ":"))
        return F.from_json(F.lit(table), "base array<bigint>, slots array<bigint>, bytes array<bigint>")


def _let(value: Column, body) -> Column:
    """``body`` of a value that is evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def fold_merges(word: Column, ranks: RankMap) -> Column:
    """Token ids of a word given as array<int> of byte values.

    A token is one number, the rank of its merge with the next token in the
    high part and its id in the low part, so the least number is the next
    merge and the rank of a pair is the id of its merger.  A guard that merges
    with nothing stands at either end.
    """
    def bind(table: Column) -> Column:
        def packed(left: Column, right: Column) -> Column:
            entry = F.get(table["slots"], F.get(table["base"], left) + right)
            merged = F.when(F.shiftright(entry, 16) == left, entry.bitwiseAND(EDGE - 1)).otherwise(NO_MERGE)
            return F.shiftleft(merged, 16) + left

        def token(acc: Column, i: Column) -> Column:
            return F.get(acc, i).bitwiseAND(EDGE - 1)

        def merge(acc: Column, least: Column, at: Column) -> Column:
            merged = F.shiftright(least, 16)
            new = F.array(packed(token(acc, at - 2), merged), packed(merged, token(acc, at + 1)))
            return F.concat(F.slice(acc, F.lit(1), at - 2), new, F.slice(acc, at + 2, F.size(acc)))

        def step(acc: Column, _: Column) -> Column:
            return _let(F.array_min(acc), lambda least: F.when(least >= NO_MERGE << 16, acc).otherwise(
                _let(F.array_position(acc, least).cast("int"), lambda at: merge(acc, least, at))))

        guard = F.lit(EDGE - 1).cast("bigint")
        plain = F.transform(word, lambda b: F.get(table["bytes"], b))
        ids = F.concat(F.array(guard), plain, F.array(guard))
        start = _let(ids, lambda x: F.concat(
            F.transform(F.sequence(F.lit(0), F.size(x) - 2), lambda i: packed(F.get(x, i), F.get(x, i + 1))),
            F.array(F.lit((NO_MERGE << 16) + EDGE - 1).cast("bigint"))))
        done = F.aggregate(F.slice(word, 2, F.size(word)), start, step)
        return F.transform(F.slice(done, F.lit(2), F.size(done) - 2), lambda x: x.bitwiseAND(EDGE - 1).cast("int"))

    return _let(ranks.column(), bind)


def merge_bytes(word: bytes, ids: dict[bytes, int]) -> list[int]:
    """The same merges for one very long word, with a heap."""
    parts = [bytes([b]) for b in word]
    after, before = list(range(1, len(parts))) + [-1], list(range(-1, len(parts) - 1))
    heap = [(r, i, a + b) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if (r := ids.get(a + b)) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, merged = heapq.heappop(heap)
        j = after[i] if parts[i] is not None else -1
        if j < 0 or parts[i] + parts[j] != merged:
            continue
        parts[i], parts[j] = merged, None
        after[i] = after[j]
        if after[i] >= 0:
            before[after[i]] = i
        for left in (before[i], i):
            right = after[left] if left >= 0 else -1
            if right >= 0 and (r := ids.get(parts[left] + parts[right])) is not None:
                heapq.heappush(heap, (r, left, parts[left] + parts[right]))
    return [ids[p] for p in parts if p is not None]


def merge_words(words: list[bytes], table: tuple[np.ndarray, ...], at_once: int = 4096) -> list[bytes]:
    """The same merges for many words, ids as bytes: words of like length are
    rows of a matrix, and every step merges the leftmost pair of lowest rank of
    each row that still has one."""
    out: list = [b""] * len(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(lengths, kind="stable")
    for at in range(0, len(words), at_once):
        rows = order[at:at + at_once]
        for row, ids in zip(rows.tolist(), _merge_rows([words[i] for i in rows], lengths[rows], *table), strict=True):
            out[row] = ids
    return out


def _merge_rows(words: list[bytes], n: np.ndarray, base: np.ndarray, slots: np.ndarray, byte_ids: np.ndarray) -> Iterator[bytes]:
    def merged(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        entry = slots[base[left] + right]
        return np.where(entry >> 16 == left, entry & (EDGE - 1), NO_MERGE)

    width, ends = int(n[-1]) if len(n) else 0, np.cumsum(n)
    done = np.full((len(words), width + 1), EDGE - 1, np.int64)  # a guard at every row's end
    inside = np.arange(width + 1) < n[:, None]
    done[inside] = byte_ids[np.frombuffer(b"".join(words), np.uint8)]
    left, rows, ids = n.copy(), np.arange(len(words)), done
    ranks = merged(ids[:, :-1], ids[:, 1:]) if width else np.full((len(words), 1), NO_MERGE)
    while len(rows):
        best = ranks.argmin(axis=1) if ranks.shape[1] else np.zeros(len(rows), np.int64)
        new = ranks[np.arange(len(rows)), best]
        more = new < NO_MERGE
        if not more.all():
            done[rows[~more], :ids.shape[1]] = ids[~more]
            rows, ids, ranks, best, new = rows[more], ids[more], ranks[more], best[more], new[more]
            if not len(rows):
                break
        k = np.arange(len(rows))
        ids[k, best] = new
        columns = np.arange(ids.shape[1] - 1)
        ids = np.take_along_axis(ids, columns + (columns > best[:, None]), 1)  # what follows moves up; the last column was a guard
        columns = columns[:-1]
        ranks = np.take_along_axis(ranks, columns + (columns > best[:, None]), 1)
        for pair in (best - 1, best):
            use = (pair >= 0) & (pair < ranks.shape[1])
            ranks[k[use], pair[use]] = merged(ids[k[use], pair[use]], ids[k[use], pair[use] + 1])
        left[rows] -= 1
    flat, stops = done[np.arange(width + 1) < left[:, None]].astype("<i4").tobytes(), np.cumsum(left) * 4
    return (flat[a:b] for a, b in zip([0, *stops.tolist()], stops.tolist(), strict=False))


def word_pattern(pattern: str):
    """The tokenizer's pattern with its white space spelled out."""
    import regex
    return regex.compile(pattern.replace(r"[^\s", "[^" + WHITE).replace(r"\S", f"[^{WHITE}]").replace(r"\s", f"[{WHITE}]"))


def word_cutter(pattern: str) -> Callable[[str], list[str]]:
    """The pattern's matches in a unit; most units need no pattern for that."""
    matches = word_pattern(pattern).findall
    return (lambda unit: plain_words(unit) or matches(unit)) if pattern == GPT2_PATTERN else matches


def _count_words(pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matches, counts = word_pattern(pattern).findall, WordCounts(COUNTED)
        for batch in batches:
            for part in parts_of(batch.column("text")):
                units, codes, _ = spelled(gpt2_unit_lists(part))
                times, other = np.bincount(codes, minlength=len(units)), np.arange(len(units))
                if pattern == GPT2_PATTERN:
                    numbers, distinct, other = plain_parts(units)
                    plain = times.copy()
                    plain[other] = 0
                    for own, words in zip(numbers, distinct, strict=True):
                        add(counts, words, np.bincount(own, plain, len(words)).astype(np.int64))  # below 2 ** 53: exact
                cut = list(map(matches, units.take(pa.array(other)).to_pylist()))
                add(counts, pa.array(list(chain(*cut)), pa.string()), np.repeat(times[other], list(map(len, cut))))
                if counts.full():
                    yield from counts.drain()
        yield from counts.drain()

    def add(counts: WordCounts, words: pa.Array, n: np.ndarray) -> None:
        size = pc.binary_length(words).to_numpy(zero_copy_only=False)
        kept = pa.array(np.flatnonzero((n > 0) & (size > 0) & (size <= MAX_WORD)))
        counts.add(words.take(kept).cast(pa.binary()), pa.array(n, pa.int64()).take(kept))
    return run


def _top(rows: DataFrame, key: Column, limit: int) -> DataFrame:
    """The rows whose ``key`` (a long, not negative) is above the least value
    for which they are no more than ``limit``.  A histogram of the leading bits
    finds the step at the limit, and finer ones within that step the value."""
    low, high, shift, room = 0, 1 << 63, 48, limit
    while True:
        inside = rows.where((key >= low) & (key <= high - 1)).groupBy(F.shiftright(key, shift).alias("step")).agg(F.count("*").alias("rows"))
        for step, n in sorted(((r["step"], r["rows"]) for r in inside.collect()), reverse=True):  # 65,536 rows at most
            if n > room:
                break
            room -= n
        else:
            return rows.where(key >= low)
        if shift == 0:
            return rows.where(key > step)
        low, high, shift = step << shift, (step + 1) << shift, max(shift - 16, 0)


def frequent(counts: DataFrame, limit: int, ties: str | None = None) -> DataFrame:
    """Rows of the most frequent words (word, n), ``limit`` at most: all words
    above the least count for which they are no more than that, and, if
    ``ties`` names the column that tells rows apart, as many of those that have
    this count as there is room for, in order of that column's hash.  Nothing
    is sorted in one task."""
    top = _top(counts, F.col("n"), limit)
    if ties is None:
        return top
    room, least = limit - top.count(), top.agg(F.min("n")).first()[0]
    tied = counts if least is None else counts.where(F.col("n") < least)
    step = tied.agg(F.max("n")).first()[0]
    if not room or step is None:
        return top
    return top.unionByName(_top(tied.where(F.col("n") == step), F.shiftrightunsigned(F.xxhash64(ties), 1), room))


def pack_words(words: pa.Array, ids: pa.Array) -> tuple[np.ndarray, ...]:
    """Words and their ids as flat arrays in order of the words' hashes: in a
    worker they take a few bytes more than their contents."""
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w.as_buffer()) for w in words), np.uint64, len(words))
    order = np.argsort(hashes, kind="stable")
    words, ids = words.cast(pa.large_binary()).take(order), ids.take(order)
    ends = [np.cumsum(np.r_[0, pc.fill_null(f(x), 0).to_numpy()], dtype=np.int64) for f, x in ((pc.binary_length, words), (pc.list_value_length, ids))]
    text = np.frombuffer(words.buffers()[2] or b"", np.uint8)[:ends[0][-1]]
    return hashes[order], ends[0], text, ends[1], ids.flatten().to_numpy().astype(np.int32)


class Vocabulary:
    """Look-up in what ``pack_words`` returns."""

    def __init__(self, packed: tuple[np.ndarray, ...]):
        self._hashes, self._word_ends, words, self._id_ends, ids = packed
        self._words, self._ids = memoryview(words), memoryview(ids)

    def get(self, word: bytes) -> bytes | None:
        return self.find([word])[0]

    def find(self, words: list[bytes]) -> list[bytes | None]:
        """The ids of words, None for those that are not in it."""
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
        first, last = (np.searchsorted(self._hashes, hashes, side).tolist() for side in ("left", "right"))
        return [self._among(word, a, b) if a < b else None for word, a, b in zip(words, first, last, strict=True)]

    def _among(self, word: bytes, first: int, last: int) -> bytes | None:
        for i in range(first, last):
            if self._words[self._word_ends[i]:self._word_ends[i + 1]] == word:
                return self._ids[self._id_ends[i]:self._id_ends[i + 1]].tobytes()
        return None


def in_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of ``AT_ONCE`` documents at most."""
    return (b.slice(i, AT_ONCE) for b in batches for i in range(0, max(b.num_rows, 1), AT_ONCE))


def _encoder(pattern: str, known, ranks, table):
    """Documents -> their ids.  Words are looked up among the merged ones; the
    others are merged here, many at a call, and kept for the documents after."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matches, vocabulary, merges = word_pattern(pattern).findall, Vocabulary(known.value), table.value
        ids = worker_state("bpe_ids", lambda: {t: i for i, t in enumerate(ranks.value)})

        def of_words(words: list[str]) -> list[bytes]:
            words = [w.encode("utf-8") for w in words]
            out, fold = vocabulary.find(words), []
            for i in [i for i, found in enumerate(out) if found is None]:
                w = words[i]
                if w in ids:
                    out[i] = np.array([ids[w]], "<i4").tobytes()
                elif len(w) > MAX_FOLD:
                    out[i] = np.array(merge_bytes(w, ids), "<i4").tobytes()
                else:
                    fold.append(i)
            for i, found in zip(fold, merge_words([words[i] for i in fold], merges), strict=True):
                out[i] = found
            return out

        def of_units(units: list[str]) -> list[bytes]:
            cut = list(map(matches, units))
            words = list(dict.fromkeys(chain.from_iterable(cut)))
            found = dict(zip(words, of_words(words), strict=True))
            return [b"".join(map(found.__getitem__, ws)) for ws in cut]

        cache = BatchIds("<i4", of_words if pattern == GPT2_PATTERN else None, of_units, limit=CACHED)
        for batch in batches:
            keys, start = [batch.column(c) for c in ("uid", "doc_id")], 0
            for part in parts_of(batch.column("text")):
                found = cache.lists(*spelled(gpt2_unit_lists(part)))
                yield pa.RecordBatch.from_arrays([*(k.slice(start, len(part)) for k in keys), pa.array(found, pa.binary())], ["uid", "doc_id", "ids"])
                start += len(part)
    return run


def encode(docs: DataFrame, ranks_path: str, pattern: str, vocabulary: int = VOCABULARY) -> DataFrame:
    """uid, doc_id and ids (little-endian 32-bit, as binary) of every row."""
    return _texts(docs).mapInArrow(_word_ids(docs, ranks_path, pattern, vocabulary), "uid long, doc_id long, ids binary")


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.monotonically_increasing_id().alias("uid"), F.col("doc_id").cast("long").alias("doc_id"), "text")


def _word_ids(docs: DataFrame, ranks_path: str, pattern: str, vocabulary: int):
    """The step that encodes documents, with the merged words of the corpus."""
    broadcast = docs.sparkSession.sparkContext.broadcast
    ranks = RankMap(load_ranks(ranks_path))
    with batches_of(docs.sparkSession, TEXTS):
        counted = stored(docs.select("text").mapInArrow(_count_words(pattern), "word binary, n long")
                         .groupBy("word").agg(F.sum("n").alias("n")), "words")
    common = frequent(counted, vocabulary)
    as_bytes = common.mapInArrow(_as_ints, "word binary, bytes array<int>")
    merged = stored(as_bytes.repartition(docs.sparkSession.sparkContext.defaultParallelism * 2)
                    .select("word", fold_merges(F.col("bytes"), ranks).alias("ids")), "merged-words")
    found = merged.toArrow()  # bounded: ``vocabulary`` words of MAX_WORD bytes
    known = pack_words(found["word"].combine_chunks(), found["ids"].combine_chunks())
    return _encoder(pattern, broadcast(known), broadcast(ranks.tokens), broadcast(ranks.arrays()))


def _as_ints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ints = [np.frombuffer(w, np.uint8).astype(np.int32) for w in batch.column("word").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("word"), pa.array(ints, pa.list_(pa.int32()))], ["word", "bytes"])


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """``encoded`` with the column ``decoded``: the binary pieces of its ids,
    one after the other."""
    tokens = encoded.sparkSession.sparkContext.broadcast(load_ranks(ranks_path))
    return encoded.mapInArrow(_decoder(tokens), "uid long, doc_id long, ids binary, decoded binary")


def _decoder(tokens):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece = tokens.value.__getitem__
        for batch in batches:
            out = [b"".join(map(piece, np.frombuffer(s.as_buffer(), np.int32).tolist())) for s in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], ["uid", "doc_id", "ids", "decoded"])
    return run


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    digit = [str(i).encode() for i in range(EDGE)].__getitem__
    for batch in batches:
        ids = [s.as_buffer() for s in batch.column("ids")]
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id"), pa.array([s.size // 4 for s in ids], pa.int64()),
            pa.array([hashlib.sha256(b",".join(map(digit, np.frombuffer(s, np.int32).tolist()))).hexdigest() for s in ids], pa.string()),
            pa.array([hashlib.sha256(s.as_buffer()).hexdigest() for s in batch.column("decoded")], pa.string())],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, **settings) -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256 (of the decimal ids joined by
    commas), decoded_sha256 (of the decoded bytes)."""
    tokens = docs.sparkSession.sparkContext.broadcast(load_ranks(ranks_path))

    word_ids = _word_ids(docs, ranks_path, pattern, settings.get("vocabulary", VOCABULARY))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:  # one Python worker for the three steps
        return _digests(_decoder(tokens)(in_parts(word_ids(batches))))
    with batches_of(docs.sparkSession, TEXTS):
        return stored(_texts(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"), "digests")
