"""Registered queries: one per operator of the inventory.

Every query takes ``(spark, sf_dir)``, reads the driver tables (or data Spark
derives from them) and returns a DataFrame with aliased, rounded columns so
that :mod:`ragloom.plans.oracle` can check it in DuckDB.  Doubles are rounded
to 6 places (4 half-to-even where the operator says so); integers are BIGINT.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ragloom.functions.text import lower_tokens, round6
from ragloom.operators import chunking, impact, metrics, prompts, report, retrieval, runs, synth
from ragloom.plans import derived

Query = Callable[[SparkSession, str], DataFrame]


# ------------------------------------------------------------ ingestion ----

def q_page_docs(spark, sf):
    # the length is taken at the scan; the page numbering shuffles narrow rows
    docs = derived.documents(spark, sf).withColumn("n_chars", F.length("text").cast("bigint"))
    return chunking.page_docs(docs, text_col=None, keep=("lang", "n_chars")).select(
        "doc_id", "source", "page", "lang", "n_chars")


def _window_chunks(spark, sf):
    return chunking.window_chunks(derived.documents(spark, sf))


def q_window_chunks(spark, sf):
    return _window_chunks(spark, sf).select("doc_id", "source", "page", "pos", "start", "text")


def q_chunk_ids(spark, sf):
    return _window_chunks(spark, sf).select("chunk_id", "chunk_no", "doc_id", "source", "page", "pos")


# ------------------------------------------------------------ retrieval ----

def _search(spark, sf):
    """Top-3 hits per query vector with the corpus doc_id and label carried
    along, plus the proven bound n_queries * 3 on their number."""
    return retrieval.knn_search(derived.vec_queries(spark, sf), derived.vec_corpus(spark, sf),
                                carry=("doc_id", "label"), exclude_self=True)


def _hits(spark, sf):
    return _search(spark, sf)[0]


def _case_search(spark, sf):
    """The search limited to what is asked: the query vectors that a case with
    a query names, chosen before the search."""
    cases = metrics.generation_case_filter(derived.keyword_cases(spark, sf)).select("case_id")
    asked = derived.vec_queries(spark, sf).join(cases, "case_id", "left_semi")
    return retrieval.knn_search(asked, derived.vec_corpus(spark, sf), carry=("doc_id", "label"), exclude_self=True)


def _hits_with_text(spark, sf, found=None):
    """Late materialisation: only the documents the hits point at are read
    into the join (semi-join reduction under the proven bound).  ``found``:
    hits with their bound; default all vectors' hits."""
    hits, bound = found if found is not None else _search(spark, sf)
    return retrieval.fetch_rows(hits, derived.documents(spark, sf), "doc_id", ["text"], bound)


def _contexts_of(spark, sf, ids, found=None):
    """(query_id, context): lower-cased hit texts joined by one space, of the
    query vectors ``ids`` (query_id); ``found``: all vectors' hits with their
    bound, if they are there, else these vectors alone are searched for."""
    ids = ids.distinct()
    if found is None:
        found = retrieval.knn_search(derived.vec_queries(spark, sf).join(ids, "query_id", "left_semi"),
                                     derived.vec_corpus(spark, sf), carry=("doc_id", "label"), exclude_self=True)
    else:
        found = (found[0].join(ids, "query_id", "left_semi"), found[1])
    return retrieval.joined_context(_hits_with_text(spark, sf, found), sep=" ", lower=True)


def _case_ids(spark, sf):
    return metrics.generation_case_filter(derived.keyword_cases(spark, sf)).select(F.col("case_id").alias("query_id"))


def _qa_ids(qa):
    return metrics.judged_case_filter(qa).select(F.col("vec_id").alias("query_id"))


def _case_contexts(spark, sf):
    """(case_id, context) of the cases' query vectors."""
    return _contexts_of(spark, sf, _case_ids(spark, sf)).withColumnRenamed("query_id", "case_id")


def q_knn_topk(spark, sf):
    return _hits(spark, sf).select("query_id", "rank", "corpus_id", round6("distance").alias("distance"))


# Bound of the indexed-path query: small enough that both sides of the driver
# tables exceed it, so the corpus is indexed and the queries visit its blocks
# (the path taken at scale) instead of one side being broadcast.
KNN_BLOCK_BYTES = 128 * 1024


def q_knn_block(spark, sf):
    """R1, indexed physical path: same result as ``knn_topk``."""
    hits = retrieval.knn_topk(derived.vec_queries(spark, sf), derived.vec_corpus(spark, sf),
                              carry=("doc_id", "label"), exclude_self=True,
                              max_broadcast_bytes=KNN_BLOCK_BYTES)
    return hits.select("query_id", "rank", "corpus_id", round6("distance").alias("distance"))


def q_cited_sources(spark, sf):
    hits, bound = _search(spark, sf)
    pages = derived.page_docs(spark, sf).select("doc_id", "source", "page")
    with_src = retrieval.fetch_rows(hits, pages, "doc_id", ["source", "page"], bound)
    return retrieval.cited_sources(with_src)


def q_vector_listing(spark, sf):
    corpus = derived.vec_corpus(spark, sf).join(
        derived.documents(spark, sf).select("doc_id", "source"), "doc_id", "left")
    out = retrieval.vector_listing(corpus)
    return out.select("corpus_id", "source", "dim", round6("norm").alias("norm"))


def q_context_format(spark, sf):
    ctx = prompts.format_context(_hits_with_text(spark, sf))
    return ctx.select("query_id", F.length("context").cast("bigint").alias("context_chars"),
                      F.md5("context").alias("context_md5"))


def q_prompt_render(spark, sf):
    hits = _hits_with_text(spark, sf, _case_search(spark, sf))
    ctx = prompts.format_context(hits).join(
        derived.vec_queries(spark, sf).select("query_id", "case_id"), "query_id")
    cases = metrics.generation_case_filter(derived.keyword_cases(spark, sf)).select("case_id", "query")
    per_version = impact.expand_versions(cases.join(ctx, "case_id", "left"),
                                         sorted(prompts.PROMPT_VERSIONS))
    out = prompts.render_prompt(per_version, prompts.catalogue(spark))
    return out.select("case_id", "prompt_version",
                      F.length("prompt").cast("bigint").alias("prompt_chars"),
                      F.md5("prompt").alias("prompt_md5"))


# ---------------------------------------------------------- evaluation -----

def _retrieval_recall(spark, sf, ctx=None):
    ctx = ctx if ctx is not None else _case_contexts(spark, sf)
    return metrics.retrieval_recall(derived.keyword_cases(spark, sf), ctx)


def q_retrieval_recall(spark, sf):
    r = _retrieval_recall(spark, sf)
    return r.select("case_id", "n_keywords", "n_found", round6("recall").alias("recall"))


def q_retrieval_score(spark, sf):
    return metrics.mean_score(_retrieval_recall(spark, sf)).select(round6("score").alias("score"))


def _qa_keyword_cases(spark, sf, qa=None):
    qa = qa if qa is not None else derived.qa_cases(spark, sf)
    return qa.withColumn("expected_keywords",
                         lower_tokens("query"))


def _generation_recall(spark, sf, qa=None):
    return metrics.generation_recall(_qa_keyword_cases(spark, sf, qa))


def q_generation_recall(spark, sf):
    r = _generation_recall(spark, sf)
    return r.select("case_id", "n_keywords", "n_found", round6("recall").alias("recall"))


def q_generation_score(spark, sf):
    return metrics.mean_score(_generation_recall(spark, sf)).select(round6("score").alias("score"))


def _verdict_rows(spark, sf, hits=None):
    """M7 verdict of a retrieved context: the corpus label (carried by the
    kNN) equals the query label (one lookup per query)."""
    h = hits if hits is not None else _hits(spark, sf)
    ql = derived.vec_queries(spark, sf).select("query_id", F.col("label").alias("q_label"))
    return (h.withColumnRenamed("label", "c_label").join(ql, "query_id")
            .withColumn("verdict", (F.col("q_label") == F.col("c_label")).cast("int")))


def _context_precision(spark, sf, hits=None):
    return metrics.context_precision(_verdict_rows(spark, sf, hits))


def q_context_precision(spark, sf):
    return _context_precision(spark, sf).select(
        "query_id", round6("context_precision").alias("context_precision"))


def _context_recall(spark, sf, ctx=None):
    cases = metrics.judged_case_filter(derived.keyword_cases(spark, sf).withColumn("ground_truth", F.col("query")))
    ctx = ctx if ctx is not None else _case_contexts(spark, sf)
    s = cases.join(ctx, "case_id", "left")
    return metrics.statement_support(s, "ground_truth", "context", out="context_recall")


def q_context_recall(spark, sf):
    return _context_recall(spark, sf).select("case_id", "n_statements", "n_supported",
                                             round6("context_recall").alias("context_recall"))


def _faithfulness(spark, sf, qa=None, contexts=None):
    """M5: the answer's statements against the text retrieved for the case."""
    qa = qa if qa is not None else derived.qa_cases(spark, sf)
    ctx = contexts if contexts is not None else _contexts_of(spark, sf, _qa_ids(qa))
    s = metrics.judged_case_filter(qa).join(ctx.withColumnRenamed("query_id", "vec_id"), "vec_id", "left")
    return metrics.statement_support(s, "answer", "context", out="faithfulness")


def q_faithfulness(spark, sf):
    return _faithfulness(spark, sf).select("case_id", "n_statements", "n_supported",
                                           round6("faithfulness").alias("faithfulness"))


def _answer_relevancy(spark, sf, qa=None):
    qa = qa if qa is not None else derived.qa_cases(spark, sf)
    return metrics.answer_relevancy(metrics.judged_case_filter(qa))


def q_answer_relevancy(spark, sf):
    return _answer_relevancy(spark, sf).select("case_id", round6("answer_relevancy").alias("answer_relevancy"))


def _judged_long(spark, sf, hits=None, qa=None, contexts=None):
    def lng(df, key, col):
        return df.select(F.col(key).cast("bigint").alias("sample_id"), F.lit(col).alias("metric"),
                         F.col(col).cast("double").alias("value"))
    ctx = contexts.withColumnRenamed("query_id", "case_id") if contexts is not None else None
    return (lng(_context_precision(spark, sf, hits), "query_id", "context_precision")
            .unionByName(lng(_context_recall(spark, sf, ctx), "case_id", "context_recall"))
            .unionByName(lng(_faithfulness(spark, sf, qa, contexts), "case_id", "faithfulness"))
            .unionByName(lng(_answer_relevancy(spark, sf, qa), "case_id", "answer_relevancy")))


def _shared_inputs(spark, sf):
    """What several metrics read, materialised once under the cluster's
    checkpoint folder: the kNN hits, the question-answer cases, and the
    retrieved contexts of both kinds of cases, so that the document table is
    scanned for hit texts once."""
    from ragloom.session import cut_lineage
    found = _search(spark, sf)
    qa = cut_lineage(derived.qa_cases(spark, sf))
    contexts = cut_lineage(_contexts_of(spark, sf, _case_ids(spark, sf).union(_qa_ids(qa)), found))
    return found[0], qa, contexts


def q_judged_mean_of_means(spark, sf):
    return metrics.mean_of_means(_judged_long(spark, sf, *_shared_inputs(spark, sf))).select(round6("ragas").alias("ragas"))


def evaluation_report(spark, sf, name: str = "offline") -> DataFrame:
    """Lifecycle A as one lineage: retrieval (R1 -> M1 -> A1), generation
    (M2 -> A2), judged (M3-M6 -> A3) -> Q1-Q4, over shared inputs."""
    hits, qa, contexts = _shared_inputs(spark, sf)
    r = metrics.mean_score(_retrieval_recall(spark, sf, contexts.withColumnRenamed("query_id", "case_id")))
    g = metrics.mean_score(_generation_recall(spark, sf, qa))
    j = metrics.mean_of_means(_judged_long(spark, sf, hits, qa, contexts))
    rep = report.single_run_report(r, g, j, name)
    return rep.select("model_name", *[round6(c).alias(c) for c in ("retrieval", "generation", "ragas", "rqi")],
                      "grade", "justification")


def q_evaluation_report(spark, sf):
    return evaluation_report(spark, sf)


# -------------------------------------------------------------- reports ----

def _run_report(spark, sf):
    return report.with_justification(report.report(report.scores_wide(derived.run_scores(spark, sf))))


def q_rqi_report(spark, sf):
    rep = _run_report(spark, sf)
    return rep.select("model_name", *[round6(c).alias(c) for c in ("retrieval", "generation", "ragas", "rqi")],
                      "grade")


def q_rqi_justification(spark, sf):
    return _run_report(spark, sf).select("model_name", "justification")


def q_console_report(spark, sf):
    return report.console_report(_run_report(spark, sf))


# --------------------------------------------------------------- impact ----

def _impact(spark, sf):
    return derived.impact_rows(spark, sf).drop("doc_id")


def q_impact_rows(spark, sf):
    flat = impact.flatten_impact(impact.nest_impact(_impact(spark, sf)))
    return flat.select("question_id", "question_text", "prompt_version", "grade",
                       *[round6(c).alias(c) for c in impact.NUMERIC_COLS], "model_name")


def q_prompt_summary(spark, sf):
    return impact.prompt_summary(_impact(spark, sf))


def q_question_pivot(spark, sf):
    return impact.question_pivot(_stored_impact(spark, sf))


def _stored_impact(spark, sf):
    """The fact table written once, for what reads it several times."""
    from ragloom.session import cut_lineage
    return cut_lineage(_impact(spark, sf))


def q_delta_all_baselines(spark, sf):
    out = impact.delta_vs_baselines(_stored_impact(spark, sf))
    return out.select(*[round6(c).alias(c) if c in impact.NUMERIC_COLS else F.col(c) for c in out.columns])


def q_distinct_versions(spark, sf):
    return _impact(spark, sf).select("prompt_version").where(
        F.col("prompt_version").isNotNull()).distinct()


def q_attach_scores(spark, sf):
    rows = _stored_impact(spark, sf)
    out = impact.attach_scores(rows, impact.version_reports(rows))
    return out.select("question_id", "prompt_version", "model_name",
                      *[round6(c).alias(c) for c in ("retrieval", "generation", "ragas", "rqi")], "grade")


def q_pending_generation(spark, sf):
    rows = _stored_impact(spark, sf)
    questions = rows.select("question_text").distinct()
    existing = rows.where(F.col("rqi").isNotNull())
    return impact.pending_pairs(questions, sorted(prompts.PROMPT_VERSIONS), existing)


UPSERT_VERSION = "prompt_v2"


def q_upsert_results(spark, sf):
    rows = _stored_impact(spark, sf)
    existing = rows.where(F.col("rqi").isNotNull())
    new_rows = rows.where(F.col("rqi").isNull() & (F.col("prompt_version") == UPSERT_VERSION))
    rep = impact.version_reports(rows).where(F.col("prompt_version") == UPSERT_VERSION)
    out = impact.upsert_results(existing, new_rows, UPSERT_VERSION, rep)
    return out.select("question_text", "prompt_version", round6("rqi").alias("rqi"), "grade", "state")


def _pairs(spark, sf):
    return impact.baseline_pairs(derived.impact_responses(spark, sf))


def q_baseline_pairs(spark, sf):
    return _pairs(spark, sf).select("question_text", "prompt_version",
                                    F.md5("base_response").alias("base_md5"),
                                    F.md5("response").alias("new_md5"))


def q_answer_diff(spark, sf):
    out = impact.answer_diff(derived.impact_responses(spark, sf))
    return out.select("question_text", "prompt_version", "base_chars", "new_chars", "len_delta",
                      round6("jaccard").alias("jaccard"), round6("new_token_share").alias("new_token_share"))


def leading_generator():
    """A model for the registered impact run: the first characters of the
    context, as many as the system prompt has."""
    from ragloom.operators.generation import takes_batches
    return takes_batches(lambda queries, contexts, prompts: [(c or "")[:len(p or "")] for c, p in zip(contexts, prompts, strict=True)])


def q_prompt_impact(spark, sf):
    """Lifecycle B: every keyword case under every prompt version, answered by
    a batched plug-in from its retrieved documents, compared with its baseline
    answer, scored by the suite of its version, committed as a snapshot and
    read back, once through the nested document."""
    from ragloom.operators import generation
    from ragloom.plans import pipelines
    from ragloom.session import cut_lineage, scratch_path
    cases = derived.keyword_cases(spark, sf)
    valid = metrics.generation_case_filter(cases)
    hits, bound = _case_search(spark, sf)
    pages = derived.page_docs(spark, sf).select("doc_id", "source", "page", "text")
    hits = retrieval.fetch_rows(hits, pages, "doc_id", ["source", "page", "text"], bound)
    hits = cut_lineage(hits.select(F.col("query_id").alias("case_id"), "rank", F.concat(F.lit("doc_"), "doc_id").alias("chunk_id"),
                                   "source", "page", "text"))
    versions = sorted(prompts.PROMPT_VERSIONS)
    new = pipelines.answer_versions(valid.select("case_id", F.col("query").alias("question_text")), hits, versions,
                                    make_generator=leading_generator)
    rows = (impact.expand_versions(pipelines.with_contexts(valid, hits), versions)
            .join(F.broadcast(prompts.catalogue(spark)), "prompt_version", "left"))
    answers = generation.generate_answers(rows, leading_generator)
    recall = metrics.retrieval_recall(cases, retrieval.joined_context(hits, key="case_id"))
    reports = pipelines.version_scores(answers, answers.withColumn("ground_truth", F.col("query")), recall)
    table = pipelines.commit_impact(spark, scratch_path(spark, "impact"), new, reports)
    back = impact.flatten_impact(impact.nest_impact(table))
    return back.select(F.md5("question_text").alias("question_md5"), "prompt_version", F.md5("response").alias("response_md5"),
                       F.size("retrieved_chunks").cast("bigint").alias("n_chunks"),
                       F.array_join(F.transform("retrieved_metadata", lambda m: m["chunk_id"]), ",").alias("chunk_ids"),
                       F.col("change_summary").isNotNull().alias("has_summary"), "model_name",
                       *[round6(c).alias(c) for c in impact.NUMERIC_COLS], "grade")


def q_table_counts(spark, sf):
    """Row counts of the evaluation tables as one long table; the chunks
    are counted from the documents' lengths, no text is read for it."""
    chunks = chunking.window_chunk_total(derived.documents(spark, sf))
    parts = [("query_vectors", derived.vec_queries(spark, sf)),
             ("corpus_vectors", derived.vec_corpus(spark, sf)),
             ("keyword_cases", derived.keyword_cases(spark, sf)),
             ("qa_cases", derived.qa_cases(spark, sf)),
             ("impact_rows", _impact(spark, sf))]
    out = chunks.select(F.lit("chunks").alias("table_name"), "n")
    for name, df in parts:
        out = out.unionByName(df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n"))
    return out


# ----------------------------------------------------------- synthetic -----

def q_sample_chunks(spark, sf):
    s = synth.sample_rows(_window_chunks(spark, sf))
    return s.select("chunk_id", "source", "page", "pos", "sample_key")


def q_case_quarantine(spark, sf):
    q = synth.quarantine(derived.keyword_cases(spark, sf))
    return q.select("case_id", "status", F.size("expected_keywords").cast("bigint").alias("n_keywords"))


def _chunk_keywords(spark, sf, carry_text=False):
    ch = _window_chunks(spark, sf).select("chunk_id", "text")
    n = chunking.window_chunk_total(derived.documents(spark, sf)).first()["n"]
    return synth.tfidf_keywords(ch, n_docs=n, carry_text=carry_text)


def q_synthetic_keywords(spark, sf):
    kw = _chunk_keywords(spark, sf)
    return kw.select("chunk_id", F.array_join("keywords", ",").alias("keywords"), "n_keywords")


def q_synthetic_cases(spark, sf):
    flat = synth.flatten_batches(synth.case_batches(_chunk_keywords(spark, sf, carry_text=True)))
    r = flat["retrieval"].select("chunk_id", F.lit("retrieval").alias("case_type"), "query",
                                 F.array_join("expected_keywords", ",").alias("expected"))
    g = flat["generation"].select("chunk_id", F.lit("generation").alias("case_type"), "query",
                                  F.array_join("expected_keywords", ",").alias("expected"))
    j = flat["ragas"].select("chunk_id", F.lit("ragas").alias("case_type"), "query",
                             F.md5("ground_truth").alias("expected"))
    return r.unionByName(g).unionByName(j)


# ---------------------------------------------------------------- runs -----

def _run_reports(spark, sf):
    return runs.run_reports(derived.run_history(spark, sf))


def q_run_average(spark, sf):
    out = runs.run_average(_run_reports(spark, sf))
    return out.select("model", round6("rqi_mean").alias("rqi_mean"), round6("rqi_std").alias("rqi_std"),
                      F.col("n_runs").cast("bigint").alias("n_runs"))


def q_run_compare(spark, sf):
    out = runs.run_compare(_run_reports(spark, sf))
    return out.select("run_no", *[round6(c).alias(c) for c in out.columns if c != "run_no"])


def q_quality_gate(spark, sf):
    out = runs.quality_gate(_run_reports(spark, sf))
    return out.select("model", "run_no", round6("rqi").alias("rqi"), "grade", "passed")


def q_quality_trend(spark, sf):
    out = runs.quality_trend(_run_reports(spark, sf))
    return out.select("model", "run_no", *[round6(c).alias(c) for c in
                                           ("rqi", "prev_rqi", "rqi_change", "rqi_moving_avg")])


QUERIES: dict[str, Query] = {
    "page_docs": q_page_docs,
    "window_chunks": q_window_chunks,
    "chunk_ids": q_chunk_ids,
    "knn_topk": q_knn_topk,
    "knn_block": q_knn_block,
    "cited_sources": q_cited_sources,
    "vector_listing": q_vector_listing,
    "context_format": q_context_format,
    "prompt_render": q_prompt_render,
    "retrieval_recall": q_retrieval_recall,
    "retrieval_score": q_retrieval_score,
    "generation_recall": q_generation_recall,
    "generation_score": q_generation_score,
    "context_precision": q_context_precision,
    "context_recall": q_context_recall,
    "faithfulness": q_faithfulness,
    "answer_relevancy": q_answer_relevancy,
    "judged_mean_of_means": q_judged_mean_of_means,
    "evaluation_report": q_evaluation_report,
    "rqi_report": q_rqi_report,
    "rqi_justification": q_rqi_justification,
    "console_report": q_console_report,
    "impact_rows": q_impact_rows,
    "prompt_summary": q_prompt_summary,
    "question_pivot": q_question_pivot,
    "delta_all_baselines": q_delta_all_baselines,
    "distinct_versions": q_distinct_versions,
    "attach_scores": q_attach_scores,
    "pending_generation": q_pending_generation,
    "upsert_results": q_upsert_results,
    "baseline_pairs": q_baseline_pairs,
    "answer_diff": q_answer_diff,
    "prompt_impact": q_prompt_impact,
    "table_counts": q_table_counts,
    "sample_chunks": q_sample_chunks,
    "case_quarantine": q_case_quarantine,
    "synthetic_keywords": q_synthetic_keywords,
    "synthetic_cases": q_synthetic_cases,
    "run_average": q_run_average,
    "run_compare": q_run_compare,
    "quality_gate": q_quality_gate,
    "quality_trend": q_quality_trend,
}
