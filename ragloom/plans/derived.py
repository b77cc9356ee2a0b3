"""Evaluation inputs derived from the driver tables.

Each function takes ``(spark, sf_dir)`` and returns a DataFrame whose work
grows with the tables.  The same definitions are written in SQL in
:mod:`ragloom.plans.oracle` so that DuckDB can check every query.

* ``keyword_cases`` -- one case per benchmark item: the item text is the
  query, the expected keywords are all the words of six letters or more of the
  lower-cased text (duplicates kept).
* ``vec_queries`` / ``vec_corpus`` -- leave-one-out retrieval over the whole
  embeddings table: every vector is a query (for case ``vec_id``) against all
  other vectors; vector ``v`` carries the text of document ``v % N`` with N
  the number of documents, so the corpus texts span the document table.
* ``qa_cases`` -- a user turn answered by the next (assistant) turn; its
  query vector is the embedding whose id is the case id modulo their number.
* ``impact_rows`` -- the tidy question x prompt-version fact table: document
  ``d`` is the answer of question ``q(d div 5)`` under ``prompt_v(d % 5)``;
  its scores come from the document and its labels.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ragloom.functions.scoring import grade, rqi
from ragloom.functions.text import KEYWORD_PATTERN, lower_tokens
from ragloom.operators.chunking import page_docs as _page_docs
from ragloom.sources.tables import read_table, spread_small_scan

VERSIONS_PER_QUESTION = 5
TURNS = 1_000_000   # case ids: conversation * TURNS + turn


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def page_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _page_docs(documents(spark, sf_dir))


def keyword_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = read_table(spark, sf_dir, "benchmark")
    return b.select(F.col("item_id").alias("case_id"), F.col("text").alias("query"),
                    lower_tokens("text", KEYWORD_PATTERN).alias("expected_keywords"))


def vec_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding as a query; its case is the item with the same id."""
    e = read_table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("query_id"), F.col("vec_id").alias("case_id"),
                    "label", "embedding")


def n_documents(spark: SparkSession, sf_dir: str) -> int:
    """Number of documents (answered from the files' footers)."""
    return documents(spark, sf_dir).count()


def vec_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding as a corpus vector (id, label, embedding, doc_id) --
    no text, so the kNN scan reads the narrowest possible rows; text is
    attached to the k hits afterwards (late materialisation).  The search
    excludes a query's own vector (leave-one-out)."""
    e = read_table(spark, sf_dir, "embeddings")
    n = max(n_documents(spark, sf_dir), 1)
    return e.select(F.col("vec_id").alias("corpus_id"), "label", "embedding",
                    F.pmod(F.col("vec_id"), F.lit(n)).alias("doc_id"))


def qa_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turn + the assistant turn that follows it.

    Turns are dense positions inside a conversation, so "the next turn" is an
    equi-join on ``turn + 1``: unique keys, no window over a conversation and
    therefore no task that must hold a whole (possibly huge) conversation.
    """
    c = read_table(spark, sf_dir, "conversations")
    u = c.where(F.col("role") == "user").select(
        "conv_id", "turn", F.col("text").alias("query"))
    a = c.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer"))
    case_id = F.col("conv_id") * TURNS + F.col("turn")
    n = max(read_table(spark, sf_dir, "embeddings").count(), 1)  # from the files' footers
    return (u.join(a, ["conv_id", "turn"], "inner")
            .select(case_id.alias("case_id"), F.pmod(case_id, F.lit(n)).alias("vec_id"),
                    "conv_id", "turn", "query", "answer"))


def impact_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tidy impact rows."""
    d = documents(spark, sf_dir).select("doc_id", "n_chars")
    lab = read_table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    q = F.concat(F.lit("q"), F.expr(f"doc_id div {VERSIONS_PER_QUESTION}").cast("string"))
    v = F.concat(F.lit("prompt_v"), (F.col("doc_id") % VERSIONS_PER_QUESTION).cast("string"))
    df = (d.join(lab, "doc_id", "left")
          .select("doc_id",
                  q.alias("question_id"), q.alias("question_text"), v.alias("prompt_version"),
                  F.least(F.col("n_chars").cast("double") / F.lit(4000.0), F.lit(1.0)).alias("retrieval"),
                  F.col("quality").cast("double").alias("generation"),
                  (F.lit(1.0) - F.lit(0.5) * F.col("toxic").cast("double")).alias("ragas")))
    df = df.withColumn("rqi", rqi("retrieval", "generation", "ragas"))
    return df.select("doc_id", "question_id", "question_text", "prompt_version",
                     grade("rqi").alias("grade"), "rqi", "ragas", "retrieval", "generation",
                     F.col("prompt_version").alias("model_name"))


def impact_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(question_text, prompt_version, response): the document text is the
    answer given under that version."""
    # every response is tokenized right after the scan (before the pairing
    # shuffle): an under-split scan is spread over the cores first
    d = spread_small_scan(documents(spark, sf_dir)).select("doc_id", "text")
    q = F.concat(F.lit("q"), F.expr(f"doc_id div {VERSIONS_PER_QUESTION}").cast("string"))
    v = F.concat(F.lit("prompt_v"), (F.col("doc_id") % VERSIONS_PER_QUESTION).cast("string"))
    return d.select(q.alias("question_text"), v.alias("prompt_version"),
                    F.col("text").alias("response"))


def run_scores(spark: SparkSession, sf_dir: str, missing=None) -> DataFrame:
    """Long score table (run, metric, value): per source of the documents the
    mean of each metric (null when a source has no labelled document; the
    report reads a null or absent score as 0).  ``missing=(run, metric)``
    removes one entry, for tests of the absent-score default."""
    imp = impact_rows(spark, sf_dir)
    src = documents(spark, sf_dir).select("doc_id", "source")
    per_run = (imp.join(src, "doc_id").groupBy(F.col("source").alias("run"))
               .agg(F.avg("retrieval").alias("retrieval"),
                    F.avg("generation").alias("generation"),
                    F.avg("ragas").alias("ragas")))
    long = per_run.select("run", F.explode(F.array(
        *[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value"))
          for m in ("retrieval", "generation", "ragas")])).alias("s"))
    long = long.select("run", "s.metric", "s.value")
    if missing:
        long = long.where(~((F.col("run") == missing[0]) & (F.col("metric") == missing[1])))
    return long


def run_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per (model = language, run_no = number of the source) the metric means."""
    imp = impact_rows(spark, sf_dir)
    docs = documents(spark, sf_dir).select("doc_id", "lang", "source")
    return (imp.join(docs, "doc_id")
            .groupBy(F.col("lang").alias("model"),
                     F.regexp_extract("source", "([0-9]+)$", 1).try_cast("bigint").alias("run_no"))
            .agg(F.avg("retrieval").alias("retrieval"),
                 F.avg("generation").alias("generation"),
                 F.avg("ragas").alias("ragas")))
