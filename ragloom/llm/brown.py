"""Language-model scores from Brown classes (operator 9).

The model is a class bigram: P(token | previous) = P(class | previous class) *
P(token | class).  Words, their counts and the class transitions come from all
training documents.  The ``vocabulary`` most frequent words (a documented size;
equally frequent ones in order of their hash)
are assigned to classes by exchange clustering: starting from frequency order,
each round takes the bigram table and, for every word, the counts of its
neighbours' classes on either side, and moves the word to the class that
raises the likelihood of the class bigrams most.  All words of a round decide
on the same counts, one half of them per round, so that two neighbours do not
swap for ever.  All other words share one class, the end of a text has its own.

Every word's own count enters: frequent words are looked up in a broadcast
table (bounded by ``vocabulary``), the rest, a (document, word) row for each
occurrence in counts, are joined with the word table, and only sums per
document come back.

Smoothing: transitions add ``ALPHA`` spread over the classes by their share;
emissions add 0.1 to every word's count and to one unseen word.

Defined results: a null text is an empty text (one token, its end); rows that
repeat a doc_id are scored and learned from each; a null doc_id is training
data; with no training rows N and V are 0 and every token has the probability
of an unknown one; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bpe import frequent
from .tables import stored
from .words import WordCounts, flat_lists, parts_of, word_lists

VOCABULARY = 50_000
MAX_WORD = 64
CLASSES = 64
ROUNDS = 4
ALPHA = 1.0
ADD = 0.1


def held_out(doc_id: Column, folds: int) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))


def _numbered(texts: pa.Array, known: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The words of texts, their numbers in ``known`` (its size for others),
    and where each text's words begin and the last one's end."""
    words, offsets = flat_lists(word_lists(texts))
    return words, pc.fill_null(pc.index_in(words, value_set=known), len(known)).to_numpy().astype(np.int64), offsets


def _with_ends(x: np.ndarray, offsets: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the words of texts with an end after each text, and where
    each text begins in them and the last one ends."""
    texts = len(offsets) - 1
    at = offsets + np.arange(texts + 1)
    out = np.full(len(x) + texts, end, np.int64)
    inside = np.ones(len(out), bool)
    inside[at[1:] - 1] = False
    out[inside] = x
    return out, at


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = WordCounts()
    for batch in batches:
        for part in parts_of(batch.column("text")):
            found = pc.value_counts(flat_lists(word_lists(part))[0])
            counts.add(found.field("values"), found.field("counts"))
            if counts.full():
                yield from counts.drain()
    yield from counts.drain()


def _bigrams(ids):
    """Counts of adjacent word numbers; the end stands before the first word,
    words outside the vocabulary share a number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, size = ids.value, len(ids.value)
        base, held, total = size + 2, [], 0

        def drain():
            pairs, n = np.unique(np.concatenate(held), return_counts=True) if held else (np.empty(0, np.int64),) * 2
            return pa.RecordBatch.from_arrays([pa.array(pairs // base), pa.array(pairs % base), pa.array(n.astype(np.int64))], ["l", "r", "n"])

        for batch in batches:
            for part in parts_of(batch.column("text")):
                _, x, offsets = _numbered(part, known)
                x, _ = _with_ends(x, offsets, size + 1)
                held.append(np.r_[size + 1, x[:-1]] * base + x)
                total += len(x)
                if total > 4_000_000:
                    yield drain()
                    held, total = [], 0
        yield drain()
    return run


def _xlogx(x: np.ndarray) -> np.ndarray:
    return np.where(x > 0, x * np.log(np.maximum(x, 1e-300)), 0.0)


def best_class(own: int, after: np.ndarray, before: np.ndarray, loops: float, table: np.ndarray, classes: int) -> int:
    """The class (of the first ``classes``) that gives the greatest likelihood
    of the class bigrams ``table`` when a word moves there from ``own``.
    ``after`` / ``before``: counts of the classes right and left of the word,
    without ``loops``, the times it follows itself."""
    t = table.copy()
    t[own] -= after
    t[:, own] -= before
    t[own, own] -= loops
    # what precedes the word stays in its rows wherever the word goes, what follows in its columns
    rows, columns = t.sum(1) + before, t.sum(0) + after
    n_after, n_before = after.sum() + loops, before.sum() + loops
    c = np.arange(classes)
    gain = (_xlogx(t[c] + after) - _xlogx(t[c])).sum(1) + (_xlogx(t[:, c].T + before) - _xlogx(t[:, c].T)).sum(1)
    corner, a, b = t[c, c], after[c], before[c]  # counted in a row and in a column above
    gain += _xlogx(corner + a + b + loops) - _xlogx(corner + a) - _xlogx(corner + b) + _xlogx(corner)
    gain -= _xlogx(rows[c] + n_after) - _xlogx(rows[c]) + _xlogx(columns[c] + n_before) - _xlogx(columns[c])
    best = int(np.argmax(gain))
    return best if gain[best] > gain[own] + 1e-9 else own


def _moves(classes_of, table: np.ndarray, classes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = classes_of.value
        for batch in batches:
            words, new = [], []
            for word, sides in zip(batch.column("word").to_pylist(), batch.column("sides").to_pylist(), strict=True):
                counts, loops = np.zeros((2, len(table))), 0.0
                for s in sides:
                    if s["loop"]:
                        loops = float(s["n"])
                    else:
                        counts[s["side"], s["c"]] += s["n"]
                words.append(word)
                new.append(best_class(int(own[word]), counts[0], counts[1], loops, table, classes))
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.int64()), pa.array(new, pa.int64())], ["word", "c"])
    return run


def _class_table(bigrams: DataFrame, class_of: Column, size: int) -> np.ndarray:
    """Counts of class bigrams; ``size`` by ``size``."""
    out = np.zeros((size, size))
    rows = bigrams.groupBy(F.get(class_of, F.col("l")).alias("cl"), F.get(class_of, F.col("r")).alias("cr")).agg(F.sum("n").alias("n"))
    for r in rows.collect():  # size ** 2 rows at most
        out[r["cl"], r["cr"]] = r["n"]
    return out


def exchange(bigrams: DataFrame, words: int, classes: int, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """(class of every word number, counts of class bigrams).  Numbers
    ``words`` and ``words + 1`` keep the classes ``classes`` and ``classes + 1``."""
    spark = bigrams.sparkSession
    now = np.r_[np.arange(words) % classes, classes, classes + 1].astype(np.int64)
    as_column = lambda: F.from_json(F.lit(str(now.tolist())), "array<int>")
    table = _class_table(bigrams, as_column(), classes + 2)
    for turn in range(rounds):
        column, loop = as_column(), F.col("l") == F.col("r")
        moving = lambda w: (F.col(w) < words) & (F.col(w) % 2 == turn % 2)
        ends = F.array(
            F.struct(F.col("l").alias("word"), F.lit(0).alias("side"), F.get(column, F.col("r")).alias("c"), loop.alias("loop"), moving("l").alias("use")),
            F.struct(F.col("r").alias("word"), F.lit(1).alias("side"), F.get(column, F.col("l")).alias("c"), loop.alias("loop"), (moving("r") & ~loop).alias("use")))
        sides = (bigrams.select("n", F.explode(F.filter(ends, lambda e: e["use"])).alias("e"))
                 .groupBy("e.word", "e.side", "e.c", "e.loop").agg(F.sum("n").alias("n"))
                 .groupBy("word").agg(F.collect_list(F.struct("side", "c", "loop", "n")).alias("sides")))  # 2 * classes + 5 at most
        moves = sides.mapInArrow(_moves(spark.sparkContext.broadcast(now), table, classes), "word long, c long").toArrow()  # ``words`` rows at most
        now = now.copy()
        now[moves["word"].to_numpy()] = moves["c"].to_numpy()
        table = _class_table(bigrams, as_column(), classes + 2)
    return now, table


def _score(model):
    fields = [("uid", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()), ("score", pa.float64()), ("rare", pa.list_(pa.binary())), ("times", pa.list_(pa.int32()))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        known, size = m["ids"], len(m["ids"])
        for batch in batches:
            start = 0
            for part in parts_of(batch.column("text")):
                words, own, offsets = _numbered(part, known)
                rare = np.flatnonzero(own == size)
                others = words.take(pa.array(rare)).dictionary_encode()
                x, at = _with_ends(own, offsets, size + 1)
                c = m["classes"][x]
                before = np.r_[0, c[:-1]]
                before[at[:-1]] = len(m["transition"]) - 1
                kinds = [m["known"][x], m["base"][x], m["transition"][before, c], m["emission"][x]]
                sums = [[k[i:j].sum() for i, j in zip(at, at[1:], strict=False)] for k in kinds]
                # (text, word) of the words outside the vocabulary, and how often
                text = np.searchsorted(offsets, rare, side="right") - 1
                pairs, times = np.unique(text << 32 | others.indices.to_numpy(), return_counts=True)
                ends = pa.array(np.searchsorted(pairs >> 32, np.arange(len(part) + 1)), pa.int32())
                spelling = others.dictionary.take(pa.array(pairs & 0xFFFFFFFF))
                columns = [*(batch.column(k).slice(start, len(part)) for k in ("uid", "doc_id", "held_out")), pa.array(np.diff(at), pa.int64()),
                           pa.array(np.array(sums[0], np.int64)), pa.array(np.array(sums[1], float)), pa.array(np.array(sums[2], float) + np.array(sums[3], float)),
                           pa.ListArray.from_arrays(ends, spelling), pa.ListArray.from_arrays(ends, pa.array(times, pa.int32()))]
                yield pa.RecordBatch.from_arrays([x.cast(t) for x, (_, t) in zip(columns, fields, strict=True)], [n for n, _ in fields])
                start += len(part)
    return run


def brown_scores(docs: DataFrame, folds: int = 10, vocabulary: int = VOCABULARY, classes: int = CLASSES, rounds: int = ROUNDS) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score (log10 probability of the text)."""
    spark = docs.sparkSession
    texts = docs.select(F.monotonically_increasing_id().alias("uid"), F.col("doc_id").cast("long").alias("doc_id"),
                        held_out(F.col("doc_id"), folds).alias("held_out"), "text")
    training = texts.where("not held_out").select("text")
    counts = stored(training.mapInArrow(_count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")), "word-counts")
    sums = counts.agg(F.sum("n"), F.count("*")).first()
    ends = training.count()
    total, distinct = (sums[0] or 0) + ends, sums[1] + (ends > 0)

    common = frequent(counts.where(F.octet_length("word") <= MAX_WORD), vocabulary, "word").orderBy(F.col("n").desc(), "word").toArrow()  # ``vocabulary`` rows at most
    n = np.array(common["n"].to_pylist(), np.float64)
    ids = common["word"].combine_chunks().cast(pa.binary())
    size = len(ids)
    bigrams = stored(training.mapInArrow(_bigrams(spark.sparkContext.broadcast(ids)), "l long, r long, n long")
                     .groupBy("l", "r").agg(F.sum("n").alias("n")), "bigrams")
    class_of, table = exchange(bigrams, size, classes, rounds)

    share = (table.sum(0) + ADD) / (table.sum() + ADD * len(table))
    transition = np.log10((table + ALPHA * share) / (table.sum(1, keepdims=True) + ALPHA))
    rare_mass, rare_words = (sums[0] or 0) - n.sum(), max(sums[1] - size, 0)
    mass, members = np.bincount(class_of[:size], n, classes), np.bincount(class_of[:size], minlength=classes)
    own = class_of[:size]
    log_total = math.log10(total + ADD * (distinct + 1))
    rare_base = math.log10(rare_mass + ADD * (rare_words + 1))
    model = {
        "ids": ids, "classes": class_of, "transition": transition,
        "known": np.r_[np.ones(size, int), 0, int(ends > 0)],
        # a rare word's own part, log10(count + 0.1), comes from the join below
        "base": np.r_[np.log10(n + ADD), 0, math.log10(ends + ADD)] - log_total,
        "emission": np.r_[np.log10(n + ADD) - np.log10(mass[own] + ADD * members[own]), -rare_base, 0],
    }
    scored = stored(texts.mapInArrow(
        _score(spark.sparkContext.broadcast(model)),
        "uid long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, rare array<binary>, times array<int>"), "scored")
    rare = scored.select("uid", F.explode(F.arrays_zip("rare", "times")).alias("e")).select("uid", F.col("e.rare").alias("word"), F.col("e.times").alias("times"))
    seen = F.col("n").isNotNull()
    parts = rare.join(counts, "word", "left").groupBy("uid").agg(
        F.sum(F.when(seen, F.col("times")).otherwise(0)).alias("rare_known"),
        F.sum(F.col("times") * F.log10(F.coalesce(F.col("n"), F.lit(0)) + ADD)).alias("rare_log"))
    rows = scored.drop("rare", "times").join(parts, "uid", "left")
    extra = F.coalesce(F.col("rare_log"), F.lit(0.0))
    return rows.select("doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
                       F.lit(total).cast("long").alias("train_tokens"), (F.col("base") + extra).alias("base_score"), (F.col("score") + extra).alias("score"))
