"""End-to-end runs: the reference's entry points as DataFrame lineages.

| reference entry                | here                                   |
|--------------------------------|----------------------------------------|
| load and chunk pages           | :func:`load_and_chunk`                  |
| create and save the index      | :func:`create_vectors`                  |
| search one query               | :func:`search` (a table of queries)     |
| evaluate retrieval             | :func:`evaluate_retrieval`              |
| evaluate generation            | :func:`evaluate_generation`             |
| judged evaluation              | :func:`evaluate_judged`                 |
| aggregate scores               | :func:`aggregate`                       |
| the standard suite             | :func:`run_suite`                       |
| prompt-version impact run      | :func:`run_prompt_impact`               |
| synthetic cases                | :func:`generate_synthetic`              |
| export + dashboard             | :func:`dashboard`                       |

Cases are tables (case_id, query, expected_keywords | ground_truth); the
model calls are the only Python, inside ``mapInPandas`` (embedder,
generator, judge plug-ins).  Everything else is Catalyst-planned.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ragloom.functions.text import KEYWORD_PATTERN, lower_tokens
from ragloom.operators import chunking, embedding, generation, impact, judge, metrics, prompts, report, retrieval, synth
from ragloom.session import cut_lineage
from ragloom.sources import io, snapshots

Embedder = Callable[[DataFrame, str, str], DataFrame]


def _default_embed(df: DataFrame, text_col: str = "text", out: str = "embedding") -> DataFrame:
    return embedding.hashed_embedding(df, text_col, out)


# ------------------------------------------------------------- lifecycle C --

def load_and_chunk(documents: DataFrame, chunker: str = "recursive", size: int = chunking.CHUNK_SIZE,
                   overlap: int = chunking.CHUNK_OVERLAP, out_path: str | None = None) -> DataFrame:
    """S1 + P1/P2 + P3 (+ S2): documents -> numbered chunks."""
    if chunker == "recursive":
        ch = chunking.recursive_chunks(chunking.document_pages(documents), size, overlap)
    elif chunker == "window":
        ch = chunking.window_chunks(documents, size, overlap)
    else:
        raise ValueError(f"unknown chunker {chunker!r}")
    if out_path:
        io.write_chunks(ch, out_path)
    return ch


def create_vectors(chunks: DataFrame, embed: Embedder = _default_embed,
                   out_path: str | None = None) -> DataFrame:
    """E1 (+ S12): chunks -> vectors (chunk_no, chunk_id, source, page, text, embedding)."""
    v = embed(chunks.select("chunk_no", "chunk_id", "source", "page", "text"), "text", "embedding")
    if out_path:
        io.save_vectors(v, out_path)
    return v


def search(queries: DataFrame, vectors: DataFrame, k: int = retrieval.TOP_K,
           embed: Embedder = _default_embed) -> DataFrame:
    """E2 + R2: (query_id, query) -> ranked hits with distance and metadata."""
    q = embed(queries.select("query_id", F.col("query").alias("__qt")), "__qt", "embedding")
    corpus = vectors.select(F.col("chunk_no").alias("corpus_id"), "embedding")
    hits, bound = retrieval.knn_search(q, corpus, k)
    meta = vectors.select(F.col("chunk_no").alias("corpus_id"), "chunk_id", "source", "page", "text")
    return retrieval.fetch_rows(hits, meta, "corpus_id", ["chunk_id", "source", "page", "text"], bound)


def _contexts(cases: DataFrame, vectors: DataFrame, k: int, embed: Embedder) -> DataFrame:
    hits = search(cases.select(F.col("case_id").alias("query_id"), "query"), vectors, k, embed)
    return hits.withColumnRenamed("query_id", "case_id")


# ------------------------------------------------------------- lifecycle A --

def evaluate_retrieval(cases: DataFrame, vectors: DataFrame, k: int = retrieval.TOP_K,
                       embed: Embedder = _default_embed) -> tuple[DataFrame, DataFrame]:
    """S4 cases -> P4 -> R1 -> M1 -> A1: (per-case scores, one-row mean)."""
    valid = metrics.retrieval_case_filter(cases)
    hits = _contexts(valid, vectors, k, embed)
    ctx = retrieval.joined_context(hits, sep=" ", lower=True, key="case_id")
    scores = metrics.retrieval_recall(valid, ctx)
    return scores, metrics.mean_score(scores)


def answer_cases(cases: DataFrame, vectors: DataFrame, k: int = retrieval.TOP_K,
                 embed: Embedder = _default_embed,
                 make_generator: Callable | None = None,
                 system_prompt: str | None = None, prompt_version: str = prompts.DEFAULT_VERSION) -> DataFrame:
    """R1 + P8 + P10 + M8-M10: one answer per case with its ranked contexts."""
    valid = metrics.generation_case_filter(cases)
    text, version = prompts.resolve_run(cases.sparkSession, system_prompt, prompt_version)
    rows = (with_contexts(valid, _contexts(valid, vectors, k, embed))
            .withColumn("system_prompt", F.lit(text).cast("string"))
            .withColumn("prompt_version", F.lit(version)))
    return generation.generate_answers(rows, make_generator)


def with_contexts(cases: DataFrame, hits: DataFrame) -> DataFrame:
    """The cases with what was retrieved for each: ``contexts`` in rank order
    (rank, chunk_id, source, page, text; at most k) and ``context``, P8's text;
    null where nothing was."""
    listing = (hits.groupBy("case_id")
               .agg(F.array_sort(F.collect_list(F.struct("rank", "chunk_id", "source", "page", "text")))
                    .alias("contexts")))
    joined = F.array_join(F.transform("contexts", lambda c: F.coalesce(c["text"], F.lit(""))), prompts.CONTEXT_SEPARATOR)
    return cases.join(listing.withColumn("context", joined), "case_id", "left")


def evaluate_generation(cases: DataFrame, vectors: DataFrame, **kw) -> tuple[DataFrame, DataFrame]:
    """P5 -> M8 -> M2 -> A2; answers are materialised once."""
    answers = cut_lineage(answer_cases(cases, vectors, **kw))
    scores = metrics.generation_recall(answers)
    return scores, metrics.mean_score(scores)


def judged_metrics(answers: DataFrame, make_judge: Callable | None = None, make_questions: Callable | None = None,
                   embed: Embedder = _default_embed, key: str = "case_id") -> DataFrame:
    """M3-M7 over answers (key, query, answer, contexts, ground_truth[, error]):
    one row per answer without an error (M10: the others are scored by none of
    the four), with context_precision, context_recall, faithfulness and
    answer_relevancy.

    Without plug-ins the verdicts are lexical and stay in the JVM.  A judge
    decides statements (M4, M5) and contexts (M3); a question plug-in makes M6
    the similarity of regenerated questions, by the run's embedder.
    """
    ok = generation.answered(answers)
    ref = F.coalesce(F.col("ground_truth"), F.lit("")).alias("reference")
    # M3: a context is relevant when it holds a statement of the reference
    ctx_rows = ok.select(key, ref, F.explode("contexts").alias("c")).select(
        F.col(key).alias("query_id"), "reference", F.col("c.rank").alias("rank"), F.coalesce("c.text", F.lit("")).alias("text"))
    joined_ctx = F.array_join(F.transform("contexts", lambda c: F.coalesce(c["text"], F.lit(""))), prompts.CONTEXT_SEPARATOR)
    base = ok.select(key, "query", "answer", ref, joined_ctx.alias("context"))
    if make_judge is None:
        ref_toks = lower_tokens("reference", KEYWORD_PATTERN)
        verdicts = ctx_rows.select("query_id", "rank", F.exists(ref_toks, lambda t: F.contains(F.lower("text"), t)).cast("int").alias("verdict"))
        cr = metrics.statement_support(base, "reference", "context", key=key, out="context_recall")
        ff = metrics.statement_support(base, "answer", "context", key=key, out="faithfulness")
    else:
        verdicts = judge.judge_contexts(ctx_rows, make_judge)
        cr = judge.verdict_share(judge.judge_samples(judge.statements_of(base, "reference"), make_judge),
                                 "context_recall")
        ff = judge.verdict_share(judge.judge_samples(judge.statements_of(base, "answer"), make_judge),
                                 "faithfulness")
    cp = metrics.context_precision(verdicts).withColumnRenamed("query_id", key)
    if make_questions is None:
        ar = metrics.answer_relevancy(base, "query", "answer", key=key)
    else:
        ar = metrics.regenerated_relevancy(base, make_questions, embed, "query", "answer", key=key)
    return (base.select(key).join(cp, key, "left").join(cr.select(key, "context_recall"), key, "left")
            .join(ff.select(key, "faithfulness"), key, "left").join(ar, key, "left"))


def evaluate_judged(cases: DataFrame, vectors: DataFrame, make_judge: Callable | None = None,
                    make_questions: Callable | None = None, **kw) -> tuple[DataFrame, DataFrame]:
    """P6 -> M8 -> M3-M7 -> A3: the per-sample judged table and one row with
    the mean of the metric means (ragas), n_samples and n_failed (answers with
    an error, which have no metric and count in no mean)."""
    valid = metrics.judged_case_filter(cases)
    answers = cut_lineage(answer_cases(valid, vectors, **kw))
    scored = judged_metrics(answers, make_judge, make_questions, kw.get("embed", _default_embed))
    table = answers.select(
        "case_id", F.col("query").alias("user_input"),
        F.transform("contexts", lambda c: c["text"]).alias("retrieved_contexts"),
        F.col("answer").alias("response"), F.coalesce(F.col("ground_truth"), F.lit("")).alias("reference"))
    table = table.join(scored, "case_id", "left")
    long = metrics.to_metric_long(table, "case_id", metrics.METRICS)
    counts = answers.agg(F.count(F.lit(1)).alias("n_samples"), F.count("error").alias("n_failed")).first()
    mean = metrics.mean_of_means(long).withColumns({c: F.lit(counts[c]).cast("bigint") for c in ("n_samples", "n_failed")})
    return table, mean


def aggregate(retrieval_mean: DataFrame, generation_mean: DataFrame, judged_mean: DataFrame,
              name: str = "default", reports_path: str | None = None) -> DataFrame:
    """S5 + Q1-Q4 (+ S6): one report row with grade and rule codes."""
    rep = report.single_run_report(retrieval_mean, generation_mean, judged_mean, name)
    if reports_path:
        io.write_reports(rep, reports_path)
    return rep


def run_suite(retrieval_cases: DataFrame, generation_cases: DataFrame, judged_cases: DataFrame,
              vectors: DataFrame, name: str = "default", out_dir: str | None = None,
              make_judge: Callable | None = None, make_questions: Callable | None = None, **kw) -> DataFrame:
    """Lifecycle A: the three evaluations and the report, one lineage each;
    no sleeps, the model calls batched per partition.  ``kw``: embed, k,
    make_generator, system_prompt, prompt_version (see :func:`answer_cases`)."""
    search_kw = {c: kw[c] for c in ("k", "embed") if c in kw}
    _, r = evaluate_retrieval(retrieval_cases, vectors, **search_kw)
    _, g = evaluate_generation(generation_cases, vectors, **kw)
    table, j = evaluate_judged(judged_cases, vectors, make_judge, make_questions, **kw)
    if out_dir:
        io.write_judged_csv(table, f"{out_dir}/judged_samples")
    return aggregate(r, g, j, name, f"{out_dir}/reports" if out_dir else None)


# ------------------------------------------------------------- lifecycle B --

EXISTING_SCHEMA = "question_text string, prompt_version string, response string"


def answer_versions(questions: DataFrame, hits: DataFrame, versions: list[str], existing: DataFrame | None = None,
                    make_generator: Callable | None = None, catalogue: dict | None = None,
                    make_summariser: Callable | None = generation.offline_summariser) -> DataFrame:
    """J8 -> J5 -> M8 -> J6 + M11: answers for every (question, version) not
    answered yet, with what was retrieved and, against the question's baseline
    answer (of this run or an earlier one), the change columns.

    ``questions`` (case_id, question_text), ``hits`` (case_id, rank, chunk_id,
    source, page, text), ``existing`` (question_text, prompt_version, response).
    """
    spark = questions.sparkSession
    if existing is None:
        existing = spark.createDataFrame([], EXISTING_SCHEMA)
    todo = impact.pending_pairs(questions, versions, existing)
    rows = (with_contexts(todo, hits)
            .join(F.broadcast(prompts.catalogue(spark, catalogue)), "prompt_version", "left")
            .withColumnRenamed("question_text", "query"))
    new = (generation.generate_answers(rows, make_generator)
           .select(F.col("query").alias("question_text"), "prompt_version",
                   F.col("answer").alias("response"), "error", "contexts"))
    new = cut_lineage(new)
    # only the new answers are compared: the baselines of their questions
    # (from earlier runs or this one) and the new non-baseline answers, so an
    # incremental run does not re-tokenize and re-pair everything answered
    # before
    text = ["question_text", "prompt_version", "response"]
    base_v = F.lit(impact.BASELINE_VERSION)
    allr = existing.select(*text).unionByName(new.where(F.col("error").isNull()).select(*text))
    scope = (allr.where(F.col("prompt_version") == base_v)
             .join(new.select("question_text").distinct(), "question_text", "left_semi")
             .unionByName(new.where((F.col("prompt_version") != base_v) & F.col("error").isNull()).select(*text)))
    out = new.join(impact.answer_diff(scope), ["question_text", "prompt_version"], "left")
    if make_summariser is not None:
        # A sentence for each new non-baseline answer that has a baseline
        summaries = generation.summarise_changes(impact.baseline_pairs(scope), make_summariser).select(
            "question_text", "prompt_version", "change_summary")
        out = out.join(summaries, ["question_text", "prompt_version"], "left")
    return out


def run_prompt_versions(spark: SparkSession, cases: DataFrame, vectors: DataFrame, versions_spec: str,
                        existing: DataFrame | None = None, make_generator: Callable | None = None,
                        catalogue: dict | None = None,
                        make_summariser: Callable | None = generation.offline_summariser,
                        k: int = retrieval.TOP_K, embed: Embedder = _default_embed) -> DataFrame:
    """P11 -> R1 -> :func:`answer_versions`: the new answers of the requested
    versions (question_text, prompt_version, response, error, contexts, change
    columns ...)."""
    versions = prompts.validate_versions(spark, versions_spec, catalogue)
    questions = metrics.generation_case_filter(cases).select("case_id", F.col("query").alias("question_text"))
    pending = questions if existing is None else questions.join(
        impact.pending_pairs(questions, versions, existing).select("case_id").distinct(), "case_id", "left_semi")
    hits = _contexts(pending.select("case_id", F.col("question_text").alias("query")), vectors, k, embed)
    return answer_versions(questions, hits, versions, existing, make_generator, catalogue, make_summariser)


def version_scores(generation_answers: DataFrame, judged_answers: DataFrame, retrieval_scores: DataFrame,
                   make_judge: Callable | None = None, make_questions: Callable | None = None,
                   embed: Embedder = _default_embed) -> DataFrame:
    """One report per prompt version: the mean retrieval score (the same for
    all), the version's mean generation score over ``generation_answers``, the
    mean of its judged means over ``judged_answers``, index and grade.

    Answers: case_id, prompt_version, query, answer, error, contexts, and
    expected_keywords or ground_truth; unique by (case_id, prompt_version).
    """
    def keyed(df):
        return df.withColumn("__id", F.concat_ws("\x01", "prompt_version", F.col("case_id").cast("string")))
    of_id = lambda df: df.select("__id", "prompt_version")
    g_answers, j_answers = keyed(generation_answers), keyed(judged_answers)
    gen = metrics.generation_recall(g_answers.drop("case_id").withColumnRenamed("__id", "case_id")).withColumnRenamed("case_id", "__id")
    g = gen.join(of_id(g_answers), "__id").groupBy("prompt_version").agg(F.avg("recall").alias("value"))
    judged = judged_metrics(j_answers.where(F.length("query") > 0), make_judge, make_questions, embed, key="__id")
    long = metrics.to_metric_long(judged.join(of_id(j_answers), "__id"), "prompt_version", metrics.METRICS)
    j = (long.groupBy("prompt_version", "metric").agg(F.avg("value").alias("m"))
         .groupBy("prompt_version").agg(F.avg("m").alias("value")))
    retrieval_mean = metrics.mean_score(retrieval_scores).first()["score"]  # one value
    versions = generation_answers.select("prompt_version").union(judged_answers.select("prompt_version")).distinct()
    r = versions.withColumn("value", F.lit(retrieval_mean))
    long = None
    for name, part in (("retrieval", r), ("generation", g), ("ragas", j)):
        part = part.select("prompt_version", F.lit(name).alias("metric"), "value")
        long = part if long is None else long.unionByName(part)
    return report.report(report.scores_wide(long, "prompt_version")).withColumn("prompt_version", F.col("model_name"))


IMPACT_SCHEMA = ("question_id string, question_text string, prompt_version string, grade string, rqi double, ragas double, "
                 "retrieval double, generation double, model_name string, response string, change_summary string, "
                 "retrieved_chunks array<string>, retrieved_metadata array<struct<chunk_id:string,source:string,page:bigint>>, run_order bigint")


def commit_impact(spark: SparkSession, root: str, new: DataFrame, reports: DataFrame) -> DataFrame:
    """I2 + J4 as one commit: the new answers join the table at ``root``, the
    scores of every version that has a report are put on all its questions,
    those of earlier runs too, and versions without one stay as they are.  An
    entry that the table has is not replaced, unless its answer is null.
    Returns the table's rows."""
    state = snapshots.manifest(spark, root)
    versions = [r[0] for r in reports.select("prompt_version").collect()]  # of the catalogue
    old = snapshots.read_snapshot(spark, root, IMPACT_SCHEMA, versions, state)
    keep = ["question_id", "question_text", "prompt_version", "response", "change_summary", *impact.CONTEXT_COLS]
    add = new.where(F.col("error").isNull()).select(
        F.col("question_text").alias("question_id"), "question_text", "prompt_version", "response", "change_summary",
        F.transform("contexts", lambda c: c["text"]).alias("retrieved_chunks"),
        F.transform("contexts", lambda c: F.struct(c["chunk_id"].cast("string").alias("chunk_id"), c["source"].alias("source"),
                                                   c["page"].cast("bigint").alias("page"))).alias("retrieved_metadata"))
    both = (old.select(*keep, "run_order").unionByName(add.withColumn("run_order", F.lit(state["number"] + 1).cast("bigint")))
            .where(F.col("prompt_version").isin(versions)))
    # first come first served: what is there stays, the earliest run order wins
    rest = [c for c in keep if c not in ("question_id", "prompt_version")]
    first = both.groupBy("question_id", "prompt_version").agg(
        F.min(F.struct(F.col("response").isNull().alias("none"), "run_order", *rest)).alias("e"))
    rows = first.select("question_id", "prompt_version", *[F.col(f"e.{c}").alias(c) for c in (*rest, "run_order")])
    cols = [c.split()[0] for c in IMPACT_SCHEMA.split(", ")]
    scored = impact.attach_scores(rows, reports).select(*cols)
    state = snapshots.replace_parts(spark, root, scored, "prompt_version", state)
    return snapshots.read_snapshot(spark, root, IMPACT_SCHEMA, state=state)


def run_prompt_impact(spark: SparkSession, retrieval_cases: DataFrame, generation_cases: DataFrame, judged_cases: DataFrame,
                      vectors: DataFrame, versions_spec: str, root: str, make_generator: Callable | None = None,
                      make_judge: Callable | None = None, make_questions: Callable | None = None,
                      make_summariser: Callable | None = generation.offline_summariser, catalogue: dict | None = None,
                      k: int = retrieval.TOP_K, embed: Embedder = _default_embed) -> DataFrame:
    """Lifecycle B end to end: answers of the requested versions for the
    questions that have none, their changes against the baseline, the suite
    under each version, its scores on every question of the version, and one
    commit of the impact table under ``root``.  Returns the table's rows; run twice it gives what it gave once."""
    versions = prompts.validate_versions(spark, versions_spec, catalogue)
    state = snapshots.manifest(spark, root)
    existing = snapshots.read_snapshot(spark, root, IMPACT_SCHEMA, state=state)
    new = cut_lineage(run_prompt_versions(spark, generation_cases, vectors, versions_spec, existing, make_generator, catalogue,
                                          make_summariser, k, embed))
    r_scores, _ = evaluate_retrieval(retrieval_cases, vectors, k, embed)
    per_version = None
    catalogue_of = catalogue or prompts.PROMPT_VERSIONS
    for cases, filled in ((generation_cases, "generation"), (judged_cases, "judged")):
        shape = cases.select("case_id", "query",
                             (F.col("expected_keywords") if filled == "generation" else F.array().cast("array<string>")).alias("expected_keywords"),
                             (F.col("ground_truth") if filled == "judged" else F.lit(None).cast("string")).alias("ground_truth"),
                             F.lit(filled).alias("suite"))
        per_version = shape if per_version is None else per_version.unionByName(shape)
    valid = metrics.generation_case_filter(per_version)
    asked = valid.select("query").distinct().withColumn("case_id", F.xxhash64("query"))
    hits = _contexts(asked, vectors, k, embed)
    rows = with_contexts(valid.withColumnRenamed("case_id", "suite_case").withColumn("case_id", F.xxhash64("query")), hits)
    rows = (impact.expand_versions(rows, versions)
            .join(F.broadcast(prompts.catalogue(spark, catalogue_of)), "prompt_version", "left"))
    answers = cut_lineage(generation.generate_answers(rows, make_generator))
    answers = answers.drop("case_id").withColumnRenamed("suite_case", "case_id")
    reports = cut_lineage(version_scores(answers.where("suite = 'generation'"), answers.where("suite = 'judged'"), r_scores,
                                         make_judge, make_questions, embed))
    return commit_impact(spark, root, new, reports)


def generate_synthetic(chunks: DataFrame, out_root: str | None = None, n: int = synth.NUM_SAMPLES, seed: int = 42,
                       make_generator: Callable | None = None) -> dict[str, DataFrame]:
    """L2 -> G1 -> U1 -> G2 -> G3: cases for a seeded sample of chunks.

    Without a plug-in the keywords of a sampled chunk are its best by tf-idf
    over all chunks.  Returns the good cases of the three kinds, ``quarantine``
    (kind, key, query: of the wrong shape) and ``skipped`` (chunk, error);
    with ``out_root`` the three are written as JSON, the other two beside them.
    """
    sample = cut_lineage(synth.sample_rows(chunks.select("chunk_id", "text"), n, seed).select("chunk_id", "text"))
    if make_generator is None:
        kw = synth.tfidf_keywords(chunks.select("chunk_id", "text"))
        made = synth.case_batches(sample.join(kw, "chunk_id")).withColumn("error", F.lit(None).cast("string"))
    else:
        made = synth.generated_batches(sample, make_generator)
    made = cut_lineage(made)
    flat = synth.flatten_batches(made.where(F.col("batch").isNotNull()))
    out, bad = {}, None
    for kind, cases in flat.items():
        status = synth.quarantine(cases) if "expected_keywords" in cases.columns else synth.truth_quarantine(cases)
        out[kind] = status.where("status = 'good'").drop("status")
        part = status.where("status = 'quarantine'").select(F.lit(kind).alias("kind"), "chunk_id", "query")
        bad = part if bad is None else bad.unionByName(part)
    if out_root:
        io.write_case_tables(out, out_root)
        io.write_table(bad, f"{out_root}/quarantine")
    return {**out, "quarantine": bad, "skipped": made.where(F.col("error").isNotNull()).select("chunk_id", "error")}


def dashboard(rows: DataFrame, out_root: str | None = None) -> dict[str, DataFrame]:
    """I4 + S10: raw rows, prompt summary, question x version pivot and the
    deltas against every baseline; the fact table is materialised once."""
    rows = cut_lineage(rows)
    tables = {"Raw_Data": rows,
              "Prompt_Summary": impact.prompt_summary(rows).orderBy("prompt_version"),
              "Question_RQI": impact.question_pivot(rows).orderBy("question_text"),
              "Delta_Analysis": impact.delta_vs_baselines(rows)}
    if out_root:
        io.write_bundle(tables, out_root)
    return tables
