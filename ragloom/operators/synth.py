"""Synthetic test-set generation.

The default case generator is offline and relational: keywords are the top
TF-IDF six-letter-or-longer words of a chunk against the whole chunk corpus.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ragloom.functions.text import KEYWORD_PATTERN, let, lower_tokens
from ragloom.operators.generation import attempt
from ragloom.session import cut_lineage

NUM_SAMPLES = 5        # fixed value of the reference: five sampled chunks
N_CASE_KEYWORDS = 5    # cases carry 3 to 5 keywords
WORD_SALT = 32         # tasks one word's rows are spread over in the tf-idf join
MAX_BROADCAST_WORDS = 2_000_000   # vocabulary rows (word, count) shipped to every task
RARE = 1024            # a word of fewer chunks may be looked up by a join instead


def sample_rows(df: DataFrame, n: int = NUM_SAMPLES, seed: int = 42,
                id_col: str = "chunk_id") -> DataFrame:
    """L2: ``min(n, count)`` rows without replacement, reproducible for a seed.

    Rows are ordered by ``md5(seed:id)`` and limited: Spark plans a
    ``TakeOrderedAndProject`` (a per-task top-n, then a merge of n rows per
    task), so no task ever holds more than n rows of the sort.
    """
    key = F.md5(F.concat(F.lit(str(seed)), F.lit(":"), F.col(id_col).cast("string")))
    return df.withColumn("sample_key", key).orderBy("sample_key", id_col).limit(n)


def word_counts(words) -> Column:
    """Distinct words of an array with their counts, within the row: the words
    sorted, a word's count is the distance between where it and the next start."""
    def counts(s):
        starts = F.filter(F.sequence(F.lit(1), F.size(s)), lambda i: (i == 1) | (s[i - 1] != s[F.greatest(i - 2, F.lit(0))]))
        return let(starts, lambda at: F.zip_with(
            at, F.concat(F.slice(at, 2, F.size(at)), F.array(F.size(s) + 1)),
            lambda i, e: F.struct(s[i - 1].alias("token"), (e - i).alias("tf"))))
    none = F.array().cast("array<struct<token:string,tf:int>>")
    return let(F.array_sort(words), lambda s: F.when(F.size(s) > 0, counts(s)).otherwise(none))


def _find(hashes: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each key is in the sorted ``hashes``, and whether it is there."""
    if not len(hashes):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(hashes, keys), len(hashes) - 1)
    return at, hashes[at] == keys


def _frequencies(listed: tuple, rare: tuple, keys: np.ndarray) -> np.ndarray:
    """Chunks that hold each word: as listed, else as looked up, else one."""
    df = np.ones(len(keys))
    for hashes, counts in (rare, listed):
        at, there = _find(hashes, keys)
        df[there] = counts[at[there]]
    return df


def _least_listed(vocabulary: DataFrame, limit: int) -> int | None:
    """The smallest frequency such that the words of it or more are ``limit``
    at most; None if there is none up to ``RARE``."""
    counts = vocabulary.groupBy(F.least("df", F.lit(RARE)).alias("df")).agg(F.count(F.lit(1)).alias("n")).collect()  # RARE rows at most
    of = {r["df"]: r["n"] for r in counts}
    left = sum(of.values())
    for least in range(1, RARE + 1):
        if left <= limit:
            return least
        left -= of.get(least, 0)
    return None


def _unlisted(vocabulary, key: str):
    """Rows with their words' hashes -> (key, word) of those not listed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column("words")
            parent = pc.list_parent_indices(words).to_numpy(zero_copy_only=False)
            there = _find(vocabulary.value[0], batch.column("hashes").flatten().to_numpy(zero_copy_only=False))[1]
            yield pa.RecordBatch.from_arrays([batch.column(key).take(pa.array(parent[~there])), words.flatten().filter(pa.array(~there))],
                                             [key, "token"])
    return run


def _top_words(vocabulary, n_docs: int, n: int):
    """Rows with their words' hashes and counts -> the ``n`` best words of each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, tf, keys = (batch.column(c) for c in ("words", "tfs", "hashes"))
            parent = pc.list_parent_indices(words).to_numpy(zero_copy_only=False)
            rare = np.empty(0, np.int64), np.empty(0)
            if "rare" in batch.schema.names:
                found = batch.column("rare").flatten()
                hashes, first = np.unique(found.field("h").to_numpy(zero_copy_only=False), return_index=True)
                rare = hashes, found.field("df").to_numpy(zero_copy_only=False)[first]
            df = _frequencies(vocabulary.value, rare, keys.flatten().to_numpy(zero_copy_only=False))
            score = np.round(tf.flatten().to_numpy(zero_copy_only=False) * np.log(float(n_docs) / df), 9)
            flat = words.flatten()
            order = pc.sort_indices(pa.table({"p": parent, "s": score, "w": flat}),
                                    sort_keys=[("p", "ascending"), ("s", "descending"), ("w", "ascending")]).to_numpy()
            parent = parent[order]
            best = order[np.arange(len(order)) - np.searchsorted(parent, parent) < n]
            sizes = np.minimum(np.bincount(parent, minlength=batch.num_rows), n)
            kept = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)], pa.int32()), flat.take(pa.array(best)))
            rest = [c for c in batch.schema.names if c not in ("words", "tfs", "hashes", "rare")]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), kept], [*rest, "keywords"])
    return run


def tfidf_keywords(chunks: DataFrame, n: int = N_CASE_KEYWORDS, key: str = "chunk_id",
                   text: str = "text", n_docs: int | None = None,
                   carry_text: bool = False, salt: int = WORD_SALT,
                   max_broadcast_words: int = MAX_BROADCAST_WORDS) -> DataFrame:
    """G1 keyword part: the ``n`` words of highest tf * ln(N / df) per chunk,
    ties by the word; (key, keywords ARRAY<STRING>, n_keywords[, text]).

    * Term counts are made inside the row by array functions; the chunks with
      their distinct words and counts are written once.
    * Document frequencies are the one shuffle: only distinct words are
      exploded, and a word common to a third of all chunks is pre-aggregated
      per task.  The vocabulary is written, and its row count decides the rest.
    * The (hash, frequency) columns, 16 bytes a word, of the most frequent
      words, ``max_broadcast_words`` at most, go to every task and every row
      ranks its own words.  Mostly all words, or all but those of a single
      chunk, are listed: a word that is not has the frequency one, and no row
      moves.  Should words of two or more chunks be left out as well, they are
      the rare ones: only their rows are looked up in a join, and the few
      frequencies found go back to their chunks.  Should two words share a
      64-bit hash (or too many words be frequent), words meet their frequencies
      in a join keyed by (word, salt), so the rows of a hot word are spread over
      ``salt`` tasks.
    * A chunk without any word has an empty list.
    ``N`` (number of chunks) is one count unless the caller knows it.
    """
    spark = chunks.sparkSession
    if n_docs is None:
        n_docs = chunks.count()
    words = F.coalesce(lower_tokens(text, KEYWORD_PATTERN), F.array().cast("array<string>"))
    carried = [text] if carry_text else []
    counted = chunks.select(key, *carried, word_counts(words).alias("c"))
    counted = cut_lineage(counted.select(key, *carried, F.col("c.token").alias("words"), F.col("c.tf").alias("tfs")))
    vocabulary = cut_lineage(counted.select(F.explode("words").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("df")))
    least = _least_listed(vocabulary, max_broadcast_words)
    hashed = vocabulary.select(F.xxhash64("token").alias("h"), "df")
    if least and not hashed.groupBy("h").count().where("count > 1").head(1):
        table = hashed.where(F.col("df") >= least).toArrow()  # bounded: 16 bytes a word
        hashes, df = table.column("h").to_numpy(), table.column("df").to_numpy().astype(np.float64)
        order = np.argsort(hashes)
        shared = spark.sparkContext.broadcast((hashes[order], df[order]))
        rows = counted.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
        ddl = {f.name: f"`{f.name}` {f.dataType.simpleString()}" for f in counted.schema.fields}
        if least > 2:  # words of 2 .. least - 1 chunks are not listed
            rare = vocabulary.where((F.col("df") > 1) & (F.col("df") < least))
            found = (rows.select(key, "words", "hashes").mapInArrow(_unlisted(shared, key), f"{ddl[key]}, token string").join(rare, "token")
                     .groupBy(F.col(key).alias("__key")).agg(F.collect_set(F.struct(F.xxhash64("token").alias("h"), "df")).alias("rare")))
            rows = rows.join(found, F.col(key).eqNullSafe(F.col("__key")), "left").drop("__key")
        out = [ddl[c] for c in (key, *carried)]
        kw = rows.mapInArrow(_top_words(shared, n_docs, n), ", ".join([*out, "keywords array<string>"]))
        return kw.select(key, "keywords", *carried, F.size("keywords").cast("bigint").alias("n_keywords"))
    pairs = counted.select(key, F.explode(F.arrays_zip("words", "tfs")).alias("p")).select(
        key, F.col("p.words").alias("token"), F.col("p.tfs").alias("tf"), F.pmod(F.xxhash64(key), F.lit(salt)).alias("__salt"))
    salted = vocabulary.withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salt - 1).cast("bigint"))))
    score = F.round(F.col("tf").cast("double") * F.log(F.lit(float(n_docs)) / F.col("df").cast("double")), 9)
    w = Window.partitionBy(key).orderBy(F.desc("score"), F.asc("token"))
    top = pairs.join(salted, ["token", "__salt"]).withColumn("score", score).withColumn("r", F.row_number().over(w)).where(F.col("r") <= n)
    kw = top.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("r", "token"))).alias("__k"))  # n at most
    empty = F.array().cast("array<string>")
    return counted.select(key, *carried).join(kw, key, "left").select(
        key, F.coalesce(F.transform("__k", lambda s: s["token"]), empty).alias("keywords"), *carried
    ).withColumn("n_keywords", F.size("keywords").cast("bigint"))


def case_batches(chunks_kw: DataFrame, text: str = "text", key: str = "chunk_id") -> DataFrame:
    """G1 (offline generator): one nested batch per chunk with one retrieval,
    one generation and one reasoning case (the reference's batch schema)."""
    kw = F.col("keywords")
    retrieval = F.struct(
        F.concat(F.lit("Which passage mentions "), F.array_join(kw, ", "), F.lit("?")).alias("query"),
        kw.alias("expected_keywords"))
    generation = F.struct(
        F.concat(F.lit("Summarise what the passage says about "),
                 F.coalesce(F.try_element_at(kw, F.lit(1)), F.lit("it")), F.lit(".")).alias("query"),
        F.slice(kw, 1, 3).alias("expected_keywords"))
    reasoning = F.struct(
        F.concat(F.lit("Explain how "), F.coalesce(F.try_element_at(kw, F.lit(1)), F.lit("the passage")),
                 F.lit(" relates to "), F.coalesce(F.try_element_at(kw, F.lit(2)), F.lit("its context")),
                 F.lit(".")).alias("query"),
        F.col(text).alias("ground_truth"))
    return chunks_kw.select(
        key,
        F.struct(F.array(retrieval).alias("retrieval_cases"),
                 F.array(generation).alias("generation_cases"),
                 F.array(reasoning).alias("ragas_cases")).alias("batch"))


BATCH_SCHEMA = ("struct<retrieval_cases:array<struct<query:string,expected_keywords:array<string>>>,"
                "generation_cases:array<struct<query:string,expected_keywords:array<string>>>,"
                "ragas_cases:array<struct<query:string,ground_truth:string>>>")


def generated_batches(chunks: DataFrame, make_generator: Callable, text: str = "text", key: str = "chunk_id") -> DataFrame:
    """G1 with a model: ``make_generator()`` returns ``chunk text -> JSON`` of
    the batch schema (or the same over lists, if marked as taking batches).
    Returns (key, batch, error): a chunk whose call fails, or whose JSON does
    not parse, has the error and a null batch (it is skipped, not fatal)."""
    raw = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chunks.select(key).schema.fields) + ", raw string, error string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        gen = make_generator()
        for pdf in batches:
            got = attempt(gen, [list(pdf[text])])
            failed = [isinstance(g, BaseException) for g in got]
            yield pd.DataFrame({key: pdf[key], "raw": [None if f else g for g, f in zip(got, failed, strict=True)],
                                "error": [f"{type(g).__name__}: {g}" if f else None for g, f in zip(got, failed, strict=True)]})
    made = cut_lineage(chunks.select(key, text).mapInPandas(run, raw))  # each model is called once
    batch = F.from_json("raw", BATCH_SCHEMA, {"mode": "PERMISSIVE"})
    shape = F.coalesce(F.col("batch.retrieval_cases"), F.col("batch.generation_cases")).isNull() & F.col("batch.ragas_cases").isNull()
    return made.withColumn("batch", batch).select(
        key, F.when(~shape, F.col("batch")).alias("batch"),
        F.when(F.col("error").isNull() & shape, F.lit("no batch of cases in the answer")).otherwise(F.col("error")).alias("error"))


def flatten_batches(batches: DataFrame, key: str = "chunk_id") -> dict[str, DataFrame]:
    """The per-chunk case lists concatenated into three flat tables."""
    return {
        "retrieval": batches.select(key, F.inline("batch.retrieval_cases")),
        "generation": batches.select(key, F.inline("batch.generation_cases")),
        "ragas": batches.select(key, F.inline("batch.ragas_cases")),
    }


CASE_SCHEMA = "query string, expected_keywords array<string>"


def quarantine(cases: DataFrame) -> DataFrame:
    """Cases with the declared shape but a missing query or no keywords
    go to quarantine instead of failing the load."""
    bad = (F.col("query").isNull() | (F.length("query") == 0)
           | F.col("expected_keywords").isNull() | (F.size("expected_keywords") == 0))
    return cases.withColumn("status", F.when(bad, F.lit("quarantine")).otherwise(F.lit("good")))


def truth_quarantine(cases: DataFrame) -> DataFrame:
    """G2 for reference-answer cases: a missing query or reference answer."""
    bad = (F.coalesce(F.length("query"), F.lit(0)) == 0) | (F.coalesce(F.length("ground_truth"), F.lit(0)) == 0)
    return cases.withColumn("status", F.when(bad, F.lit("quarantine")).otherwise(F.lit("good")))
