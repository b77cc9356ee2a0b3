"""Registered queries with Python-side or ML operators.

``recursive_coverage``, ``hash_embed`` and ``extractive_answers`` have SQL; the others are
checked by row count, and in the tests by their invariants and brute force
(chunk length and overlap bounds, unit norms, kNN).
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ragloom.functions.text import round6
from ragloom.operators import chunking, embedding, generation, impact, prompts, retrieval
from ragloom.plans import derived, queries
from ragloom.session import cut_lineage
from ragloom.sources.tables import spread_small_scan


def q_recursive_chunks(spark, sf):
    """P1 + P3: recursive separator chunks of every page with global ids."""
    # the splitter runs right after the scan (no shuffle before it): an
    # under-split scan is spread over the cores first
    docs = spread_small_scan(derived.documents(spark, sf))
    ch = chunking.recursive_chunks(chunking.document_pages(docs))
    return ch.select("chunk_id", "chunk_no", "doc_id", "source", "page", "pos",
                     F.length("text").cast("bigint").alias("n_chars"))


# White space as the splitter trims it, for both regex engines.
BLANK = r"[\s\x0b\x1c-\x1f\x85\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def q_recursive_coverage(spark, sf):
    """What the recursive chunks of every document that has any keep of
    it: whether all are within the size and share no more than the overlap,
    and the characters other than white space, counted and digested in order,
    each taken from the first chunk that holds it."""
    docs = spread_small_scan(derived.documents(spark, sf))
    ch = chunking.recursive_chunks(chunking.document_pages(docs)).select("doc_id", "pos", "start", "text")
    w = Window.partitionBy("doc_id").orderBy("pos")  # the chunks of one document
    ends = F.coalesce(F.lag(F.col("start") + F.length("text")).over(w), F.lit(0).cast("bigint"))
    ch = ch.withColumn("shared", F.greatest(ends - F.col("start"), F.lit(0).cast("bigint")))
    new = F.regexp_replace(F.expr("substring(text, int(shared) + 1)"), BLANK, "")
    per_doc = ch.groupBy("doc_id").agg(
        (F.max(F.length("text")) <= chunking.CHUNK_SIZE).alias("within_size"),
        (F.max("shared") <= chunking.CHUNK_OVERLAP).alias("within_overlap"),
        F.array_sort(F.collect_list(F.struct("pos", new.alias("t")))).alias("parts"))  # one document's text
    whole = F.array_join(F.transform("parts", lambda x: x["t"]), "")
    return per_doc.select("doc_id", "within_size", "within_overlap", F.length(whole).cast("bigint").alias("solid_chars"),
                          F.md5(whole).alias("solid_md5"))


def _embedded_chunks(spark, sf):
    ch = queries._window_chunks(spark, sf).select("chunk_no", "source", "text")
    return embedding.hashed_embedding(ch)


def q_hash_embed(spark, sf):
    """Hashed bag-of-words vector of every chunk (unit norm)."""
    e = _embedded_chunks(spark, sf)
    return e.select("chunk_no", F.size("embedding").cast("bigint").alias("dim"),
                    round6(F.sqrt(F.aggregate("embedding", F.lit(0.0).cast("double"),
                                              lambda a, x: a + x.cast("double") * x.cast("double"))))
                    .alias("norm"))


def q_text_retrieval(spark, sf):
    """E2 + R1: the qa questions embedded with the same model, top-3 chunks."""
    # both are written once: the search reads them several times
    qs = cut_lineage(embedding.hashed_embedding(derived.qa_cases(spark, sf).select(
        F.col("case_id").alias("query_id"), F.col("query").alias("text"))).select("query_id", "embedding"))
    corpus = cut_lineage(_embedded_chunks(spark, sf).select(F.col("chunk_no").alias("corpus_id"), "embedding"))
    hits = retrieval.knn_topk(qs, corpus)
    return hits.select(F.col("query_id").alias("case_id"), "rank", F.col("corpus_id").alias("chunk_no"),
                       round6("distance").alias("distance"))


def q_pca_points(spark, sf):
    """2-D projection of the corpus vectors with their source label."""
    corpus = derived.vec_corpus(spark, sf).join(
        derived.documents(spark, sf).select("doc_id", "source"), "doc_id", "left")
    pts = embedding.pca_points(corpus)
    return pts.select("corpus_id", "source", round6("x").alias("x"), round6("y").alias("y"))


def q_extractive_answers(spark, sf):
    """An answer for every (case, prompt version) from its context."""
    hits = queries._hits_with_text(spark, sf, queries._case_search(spark, sf))
    ctx = prompts.format_context(hits).join(
        derived.vec_queries(spark, sf).select("query_id", "case_id"), "query_id")
    cases = (derived.keyword_cases(spark, sf).where(F.length("query") > 0)
             .select("case_id", "query").join(ctx.select("case_id", "context"), "case_id", "left"))
    per_version = impact.expand_versions(cases, sorted(prompts.PROMPT_VERSIONS))
    with_prompt = per_version.join(F.broadcast(prompts.catalogue(spark)), "prompt_version", "left")
    ans = generation.generate_answers(with_prompt)
    return ans.select("case_id", "prompt_version", F.length("answer").cast("bigint").alias("answer_chars"),
                      "error")


ROWS_ONLY_QUERIES = {
    "recursive_chunks": q_recursive_chunks,
    "recursive_coverage": q_recursive_coverage,
    "hash_embed": q_hash_embed,
    "text_retrieval": q_text_retrieval,
    "pca_points": q_pca_points,
    "extractive_answers": q_extractive_answers,
}
