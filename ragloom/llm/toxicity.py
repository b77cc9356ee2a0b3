"""Toxicity by compression distance (operator 4).

Two zstandard dictionaries are trained, one on toxic and one on ordinary
text.  Both end in the same common words, so that ordinary text compresses
equally well under either; before these stand the words that set the class
apart, found by support in labelled documents (copies of a document count
once, as one context).  A text is cut into windows of whole words; a window's
gain is its compressed length under the ordinary dictionary less that under
the toxic one.  The largest gains and the number of windows give the score, by
a logistic curve calibrated on labelled documents that took no part in the
dictionaries and weighted to the share of toxic labels among all training rows.

Training reads at most ``SAMPLE`` labelled rows of each class, chosen by a
hash of doc_id, for the dictionaries and as many for the curve, and of these
only texts of at most ``SAMPLE_BYTES`` bytes.  Scoring reads every whole text.

Defined results: a null text is scored as an empty one; a document labelled
more than once counts as toxic if one label says so; labels other than 0 and 1
are ignored; without training rows of both classes every score is the share of
toxic rows, 0 if there are no labels; repeated rows and null doc_ids are
scored each for itself (a null doc_id is not held out); an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .brown import held_out
from .tables import batches_of, stored, unused

FOLDS = 5
SAMPLE = 3000
SAMPLE_BYTES = 32_768
WINDOW = 64
LEVEL = 7
BASE_WORDS = 40_000
LEAST_SUPPORT = 5
LEAST_RATIO = 10.0
_WORD = re.compile(rb"[a-z\x80-\xff]+")
_AT_ONCE = 4096
AT_ONCE = 1000  # documents in a batch that holds their texts


def _lower(text: str | None) -> bytes:
    return (text or "").lower().encode("utf-8", "surrogatepass")


def windows(text: bytes, width: int = WINDOW) -> Iterator[bytes]:
    """Whole words, ``width`` bytes and the rest of the last word."""
    at, n = 0, len(text)
    while at < n:
        end = text.find(b" ", at + width, at + 2 * width) if at + width < n else n
        end = end if end >= 0 else at + width
        yield text[at:end]
        at = end


def _support(texts: list[str]) -> dict[bytes, int]:
    """In how many different contexts documents first use a word: copies of a
    document share theirs."""
    contexts: dict[bytes, set] = defaultdict(set)
    for text in texts:
        words, seen = _WORD.findall(_lower(text)), set()
        for before, word in zip([b"", *words], words, strict=False):
            if word not in seen:
                seen.add(word)
                contexts[word].add(before)
    return {w: len(c) for w, c in contexts.items()}


def train_dictionaries(toxic: list[str], ordinary: list[str]) -> tuple[bytes, bytes]:
    """Contents of the toxic and of the ordinary dictionary."""
    t, o = _support(toxic), _support(ordinary)

    def ratio(own, n_own, other, n_other):
        return lambda w: ((own.get(w, 0) + 0.5) / n_own) / ((other.get(w, 0) + 0.5) / n_other)

    def marked(own, rate):
        return sorted((w for w in own if own[w] >= LEAST_SUPPORT and rate(w) >= LEAST_RATIO), key=lambda w: (-rate(w), w))

    marks = marked(t, ratio(t, len(toxic), o, len(ordinary)))
    clean = marked(o, ratio(o, len(ordinary), t, len(toxic)))[:max(len(marks), 1)]
    apart = {*marks, *clean}
    common = sorted((w for w in {*t, *o} if w not in apart), key=lambda w: (-t.get(w, 0) - o.get(w, 0), w))[:BASE_WORDS]
    join = lambda words: b" " + b" ".join(reversed(words)) + b" "
    return join(marks) + join(common), join(clean) + join(common)


class Gains:
    """Gains of a text's windows under two dictionaries."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        self._toxic, self._ordinary = self._compressor(toxic), self._compressor(ordinary)

    @staticmethod
    def _compressor(content: bytes) -> zstandard.ZstdCompressor:
        settings = zstandard.ZstdCompressionParameters.from_level(LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False)
        dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        dictionary.precompute_compress(compression_params=settings)
        return zstandard.ZstdCompressor(dict_data=dictionary, compression_params=settings)

    def features(self, text: str | None) -> np.ndarray:
        """1, largest gain, mean of the three largest, windows that gain two
        bytes or more (log), windows (log)."""
        top, several, n, held = np.zeros(3), 0, 0, []
        cut = windows(_lower(text))
        while True:
            held = [w for _, w in zip(range(_AT_ONCE), cut, strict=False)]
            if not held:
                break
            sizes = [[len(x) for x in c.multi_compress_to_buffer(held, threads=0)] for c in (self._ordinary, self._toxic)]
            gains = np.array(sizes[0]) - np.array(sizes[1])
            n, several = n + len(gains), several + int((gains >= 2).sum())
            top = np.sort(np.r_[top, gains])[-3:]
        return np.array([1.0, top[2], top.mean(), np.log1p(several), np.log1p(n) / 4])


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def calibrate(features: np.ndarray, toxic: np.ndarray, share: float, penalty: float = 0.1) -> np.ndarray:
    """Weights of the logistic curve, by Newton's method."""
    weight = np.where(toxic == 1, share / max(toxic.mean(), 1e-9), (1 - share) / max(1 - toxic.mean(), 1e-9))
    beta = np.zeros(features.shape[1])
    ridge = penalty * np.eye(len(beta))
    ridge[0, 0] = 1e-6
    for _ in range(50):
        p = logistic(features @ beta)
        gradient = features.T @ (weight * (toxic - p)) - ridge @ beta
        hessian = (features * (weight * p * (1 - p))[:, None]).T @ features + ridge
        step = np.linalg.solve(hessian, gradient)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return beta


def train(docs: DataFrame, labels: DataFrame, folds: int = FOLDS, sample: int = SAMPLE) -> dict:
    """The model: dictionaries and weights, or the share of toxic rows alone."""
    known = (labels.where("toxic in (0, 1) and doc_id is not null").where(~held_out(F.col("doc_id").cast("long"), folds))
             .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic")))
    counts = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = counts.get(1, 0) / max(sum(counts.values()), 1)
    if len(counts) < 2:
        return {"share": share}
    order = F.xxhash64("doc_id")
    chosen = None
    for label in (0, 1):
        part = known.where(F.col("toxic") == label).orderBy(order, "doc_id").limit(2 * sample)
        chosen = part if chosen is None else chosen.unionByName(part)
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.octet_length("text") <= SAMPLE_BYTES)
            .join(F.broadcast(chosen), "doc_id").select("doc_id", "toxic", "text", F.crc32(order.cast("string").cast("binary")).alias("at"))
            .collect())  # 4 * sample rows of SAMPLE_BYTES at most
    rows.sort(key=lambda r: (r["at"], r["doc_id"], r["text"]))
    parts = [[r for r in rows if r["at"] % 2 == half] for half in (0, 1)]
    texts = [[r["text"] for r in parts[0] if r["toxic"] == label] for label in (0, 1)]
    if not texts[0] or not texts[1] or len({r["toxic"] for r in parts[1]}) < 2:
        return {"share": share}
    toxic, ordinary = train_dictionaries(texts[1], texts[0])
    gains = Gains(toxic, ordinary)
    features = np.array([gains.features(r["text"]) for r in parts[1]])
    return {"toxic": toxic, "ordinary": ordinary, "weights": calibrate(features, np.array([r["toxic"] for r in parts[1]]), share)}


def _score(model, name: str = "score", kept: list[str] | None = None):
    """Adds the score of the column ``text`` to the columns ``kept`` (all others)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        gains = Gains(m["toxic"], m["ordinary"]) if "weights" in m else None
        for batch in batches:
            if gains is None:
                scores = np.full(batch.num_rows, m["share"])
            else:
                scores = logistic(np.array([gains.features(t.as_py()) for t in batch.column("text")]).reshape(-1, 5) @ m["weights"])
            columns = [c for c in batch.schema.names if c != "text"] if kept is None else kept
            yield pa.RecordBatch.from_arrays([*map(batch.column, columns), pa.array(scores, pa.float64())], [*columns, name])
    return run


def toxicity(docs: DataFrame, labels: DataFrame, folds: int = FOLDS) -> DataFrame:
    """One row per row of ``docs``: uid (the row's number in the scan), doc_id,
    held_out, score, predicted."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, folds))
    texts = docs.select(F.monotonically_increasing_id().alias("uid"), F.col("doc_id").cast("long").alias("doc_id"),
                        held_out(F.col("doc_id").cast("long"), folds).alias("held_out"), "text")
    scored = texts.mapInArrow(_score(model), "uid long, doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` that are not toxic by their score, all columns."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, **settings))
    score = unused(docs, "__score")
    names = [f"__{i}" for i in range(len(docs.columns))]
    names[[c.lower() for c in docs.columns].index("text")] = "text"
    schema = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, docs.schema, strict=True))
    scored = docs.toDF(*names).mapInArrow(_score(model, score, names), f"{schema}, {score} double")
    with batches_of(docs.sparkSession, AT_ONCE):
        return stored(scored.where(F.col(score) < 0.5).drop(score).toDF(*docs.columns), "ordinary")
