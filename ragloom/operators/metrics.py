"""Row-level metrics (M1-M7) and their aggregates (A1-A3).

All metrics are column expressions or relational jobs; the lexical judge
(M7 default) decides a statement by substring containment, so nothing here
leaves the JVM.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, StringType, StructField, StructType

from ragloom.functions.text import KEYWORD_PATTERN, keyword_recall, let, lower_tokens
from ragloom.operators.generation import attempt
from ragloom.session import cut_lineage

PRECISION_EPS = 1e-10   # fixed value of the judged context-precision formula
METRICS = ("context_precision", "context_recall", "faithfulness", "answer_relevancy")


# ---------------------------------------------------------------- filters --

def retrieval_case_filter(cases: DataFrame) -> DataFrame:
    """Skip a case without query or without keywords."""
    return cases.where((F.length("query") > 0)
                       & F.col("expected_keywords").isNotNull()
                       & (F.size("expected_keywords") > 0))


def generation_case_filter(cases: DataFrame) -> DataFrame:
    """P5: skip only a case without query (empty keywords later score 0)."""
    return cases.where(F.length("query") > 0)


def judged_case_filter(cases: DataFrame, reference: str = "ground_truth") -> DataFrame:
    """Skip a case without query; a missing reference becomes ''."""
    out = cases.where(F.length("query") > 0)
    if reference in cases.columns:
        out = out.withColumn(reference, F.coalesce(F.col(reference), F.lit("")))
    return out


# ------------------------------------------------------------- M1 / M2 -----

def retrieval_recall(cases: DataFrame, contexts: DataFrame) -> DataFrame:
    """M1 over cases (case_id, query, expected_keywords) and one lower-cased,
    space-joined retrieved text per case (case_id, context)."""
    c = retrieval_case_filter(cases)
    j = c.join(contexts, "case_id", "left")
    hay = F.coalesce(F.col("context"), F.lit(""))
    return j.select(
        "case_id",
        F.size("expected_keywords").cast("bigint").alias("n_keywords"),
        F.size(F.filter("expected_keywords", lambda k: F.contains(hay, F.lower(k))))
         .cast("bigint").alias("n_found"),
        keyword_recall("expected_keywords", hay).alias("recall"))


def generation_recall(cases: DataFrame, answer: str = "answer") -> DataFrame:
    """M2 (+M10): keyword recall over the answer; a missing answer (error
    result) counts as ''; an empty keyword list scores 0."""
    c = generation_case_filter(cases)
    hay = F.lower(F.coalesce(F.col(answer), F.lit("")))
    return c.select(
        "case_id",
        F.size("expected_keywords").cast("bigint").alias("n_keywords"),
        F.size(F.filter("expected_keywords", lambda k: F.contains(hay, F.lower(k))))
         .cast("bigint").alias("n_found"),
        keyword_recall("expected_keywords", hay, empty_is_zero=True).alias("recall"))


def mean_score(scores: DataFrame, col: str = "recall", out: str = "score") -> DataFrame:
    """A1 / A2: mean over the scored cases, 0.0 when there is none."""
    return scores.agg(F.coalesce(F.avg(col), F.lit(0.0)).alias(out))


# ------------------------------------------------------------------ M3 -----

def context_precision(verdicts: DataFrame, key: str = "query_id") -> DataFrame:
    """M3 over ranked verdict rows (key, rank, verdict 0/1):
    sum_i(P@i * v_i) / (sum_i v_i + 1e-10), P@i = hits up to i / i.

    The running sum is partitioned by sample; a sample holds its k ranked
    contexts only, so the window partitions are bounded by k.
    """
    w = Window.partitionBy(key).orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    v = F.col("verdict").cast("double")
    p_at = F.sum(v).over(w) / F.col("rank").cast("double")
    return (verdicts.withColumn("__term", p_at * v)
            .groupBy(key)
            .agg((F.sum("__term") / (F.sum(v) + F.lit(PRECISION_EPS))).alias("context_precision")))


# -------------------------------------------------------------- M4 / M5 -----

def statement_support(samples: DataFrame, statements: str, context: str,
                      key: str = "case_id", out: str = "score") -> DataFrame:
    """Share of the six-letter-or-longer statements of ``statements`` that the lexical
    judge finds in ``context`` (both lower-cased); no statement gives null.

    M4 (context recall) uses the reference answer as statements, M5
    (faithfulness) the generated answer; the context is the retrieved text.
    """
    toks = lower_tokens(statements, KEYWORD_PATTERN)
    ctx = F.lower(F.coalesce(F.col(context), F.lit("")))
    return samples.select(
        key,
        F.size(toks).cast("bigint").alias("n_statements"),
        # the text is lower-cased once for the row, not for each statement
        let(ctx, lambda c: F.size(F.filter(toks, lambda t: F.contains(c, t)))).cast("bigint").alias("n_supported"),
    ).withColumn(out, F.try_divide(F.col("n_supported").cast("double"),
                                   F.nullif(F.col("n_statements"), F.lit(0)).cast("double")))


# ------------------------------------------------------------------ M6 -----

def answer_relevancy(samples: DataFrame, question: str = "query", answer: str = "answer",
                     key: str = "case_id") -> DataFrame:
    """M6 (lexical): cosine between the bag-of-words of the question and of the
    answer; 0 when either side has no word (a non-committal answer).

    One pass, no join: the tokens of both sides are exploded together with a
    side tag (plus one sentinel row, so that a sample without any token still
    appears), counted per (sample, token) -- a partial aggregation, so a hot
    word or a huge sample is pre-aggregated map-side -- and the squared norms
    and the dot product are summed per sample in a second partial aggregation.
    """
    tagged = F.concat(
        F.transform(F.coalesce(lower_tokens(question), F.array().cast("array<string>")),
                    lambda t: F.struct(F.lit(1).alias("q"), F.lit(0).alias("a"), t.alias("token"))),
        F.transform(F.coalesce(lower_tokens(answer), F.array().cast("array<string>")),
                    lambda t: F.struct(F.lit(0).alias("q"), F.lit(1).alias("a"), t.alias("token"))),
        F.array(F.struct(F.lit(0).alias("q"), F.lit(0).alias("a"),
                         F.lit(None).cast("string").alias("token"))))
    per_token = (samples.select(key, F.inline(tagged))
                 .groupBy(key, "token")
                 .agg(F.sum("q").alias("qc"), F.sum("a").alias("ac")))
    per_sample = per_token.groupBy(key).agg(
        F.sum(F.col("qc") * F.col("qc")).alias("qn"),
        F.sum(F.col("ac") * F.col("ac")).alias("an"),
        F.sum(F.col("qc") * F.col("ac")).alias("dot"))
    cos = F.col("dot").cast("double") / (F.sqrt(F.col("qn").cast("double")) * F.sqrt(F.col("an").cast("double")))
    return per_sample.select(key, F.when((F.col("qn") == 0) | (F.col("an") == 0), F.lit(0.0))
                             .otherwise(cos).alias("answer_relevancy"))


def regenerated_relevancy(samples: DataFrame, make_questions: Callable, embed: Callable,
                          question: str = "query", answer: str = "answer", key: str = "case_id") -> DataFrame:
    """M6 with models: the mean cosine between the question and the questions
    that a plug-in makes of the answer, 0 for a non-committal answer (or one
    that gives no question), in steps of nested batches:

    answer -> (questions, non-committal) -> one row a question -> vectors of
    all questions, asked and made, by the one embedder -> cosine per pair.

    ``make_questions()`` returns ``answer -> (questions, non-committal)``, or
    the same over lists if marked as taking batches; ``embed(df, text, out)``
    is the run's embedder.  ``key`` is unique.
    """
    schema = StructType([*samples.select(key, question, answer).schema.fields, StructField("made", ArrayType(StringType())),
                         StructField("evasive", BooleanType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ask = make_questions()
        for pdf in batches:
            got = attempt(ask, [list(pdf[answer])])
            for g in got:
                if isinstance(g, BaseException):
                    raise g
            pdf["made"] = [list(g[0]) for g in got]
            pdf["evasive"] = [bool(g[1]) for g in got]
            yield pdf
    made = cut_lineage(samples.select(key, question, answer).mapInPandas(run, schema))
    asked = made.where(~F.col("evasive") & (F.size("made") > 0))
    texts = asked.select(F.col(key), F.explode(F.concat(
        F.array(F.struct(F.lit(True).alias("asked"), F.col(question).alias("t"))),
        F.transform("made", lambda m: F.struct(F.lit(False).alias("asked"), m.alias("t"))))).alias("q")).select(key, "q.asked", "q.t")
    vectors = cut_lineage(embed(texts, "t", "v").select(key, "asked", F.transform("v", lambda x: x.cast("double")).alias("v")))
    norm = lambda c: F.sqrt(F.aggregate(c, F.lit(0.0), lambda s, x: s + x * x))
    dot = F.aggregate(F.zip_with("v", "u", lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
    length = norm(F.col("v")) * norm(F.col("u"))
    pairs = vectors.where(~F.col("asked")).select(key, "v").join(vectors.where("asked").select(key, F.col("v").alias("u")), key)
    means = pairs.groupBy(key).agg(F.avg(F.coalesce(F.try_divide(dot, F.nullif(length, F.lit(0.0))), F.lit(0.0))).alias("answer_relevancy"))
    return made.select(key).join(means, key, "left").select(key, F.coalesce("answer_relevancy", F.lit(0.0)).alias("answer_relevancy"))


# ------------------------------------------------------------------ A3 -----

def mean_of_means(metric_long: DataFrame) -> DataFrame:
    """A3 over (metric, value): per-metric mean with nulls skipped, then the
    unweighted mean of the metric means that exist; 0.0 when none does."""
    per = metric_long.groupBy("metric").agg(F.avg("value").alias("m"))
    return per.agg(F.coalesce(F.avg("m"), F.lit(0.0)).alias("ragas"))


def to_metric_long(df: DataFrame, key: str, metric_cols) -> DataFrame:
    """Wide judged table -> (key, metric, value), NaN normalised to null."""
    arr = F.array(*[F.struct(F.lit(m).alias("metric"),
                             F.when(F.isnan(F.col(m)), F.lit(None).cast("double"))
                              .otherwise(F.col(m).cast("double")).alias("value"))
                    for m in metric_cols])
    return df.select(key, F.explode(arr).alias("s")).select(key, "s.metric", "s.value")
