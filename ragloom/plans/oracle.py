"""DuckDB SQL oracles for the registered queries.

Each statement reads the pre-registered views (documents, embeddings,
benchmark, conversations, labels, ...) and re-derives its inputs with the
same definitions as :mod:`ragloom.plans.derived`, written independently in
plain SQL (window ``row_number`` / ``lead`` / cross products are fine here:
the oracle only runs at test scale).
"""

from __future__ import annotations

from ragloom.operators.prompts import CONTEXT_SEPARATOR, HUMAN_PREFIX, PROMPT_VERSIONS, QUESTION_PREFIX

VERSIONS = sorted(PROMPT_VERSIONS)
MODELS = ["de", "en", "es", "fr"]


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


BASENAME = "coalesce(nullif(string_split(source, '/')[-1], ''), 'unknown')"

PAGE_DOCS = f"""page_docs AS (
  SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS page, text, lang
  FROM (SELECT doc_id, {BASENAME} AS source, text, lang FROM documents))"""

CHUNKS = PAGE_DOCS + """,
page_n AS (
  SELECT *, CASE WHEN coalesce(length(text), 0) = 0 THEN 0
                 WHEN length(text) <= 1000 THEN 1
                 ELSE 1 + (length(text) - 1000 + 799) // 800 END AS n
  FROM page_docs),
chunk_pos AS (SELECT doc_id, source, page, text, unnest(range(0, n)) AS pos FROM page_n WHERE n > 0),
chunks AS (
  SELECT doc_id, source, page, pos, pos * 800 AS start,
         row_number() OVER (ORDER BY source, page, pos) - 1 AS chunk_no,
         'chunk_' || (row_number() OVER (ORDER BY source, page, pos) - 1) AS chunk_id,
         substr(text, pos * 800 + 1, 1000) AS text
  FROM chunk_pos)"""

KEYWORD_CASES = """keyword_cases AS (
  SELECT item_id AS case_id,
         text AS query, regexp_extract_all(lower(text), '\\p{L}{6,}') AS expected_keywords
  FROM benchmark)"""

VECS = """vec_queries AS (
  SELECT vec_id AS query_id, vec_id AS case_id, label, embedding FROM embeddings),
vec_corpus AS (
  SELECT vec_id AS corpus_id, label, embedding, vec_id % (SELECT count(*) FROM documents) AS doc_id
  FROM embeddings)"""

HITS = VECS + """,
dists AS (
  SELECT q.query_id, c.corpus_id,
         list_sum(list_transform(range(1, len(q.embedding) + 1),
             lambda i: (q.embedding[i]::DOUBLE - c.embedding[i]::DOUBLE)
                     * (q.embedding[i]::DOUBLE - c.embedding[i]::DOUBLE))) AS distance
  FROM vec_queries q, vec_corpus c
  WHERE q.query_id <> c.corpus_id),
hits AS (
  SELECT query_id, rank, corpus_id, distance FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, corpus_id) AS rank FROM dists)
  WHERE rank <= 3),
hit_text AS (
  SELECT h.*, d.text FROM hits h JOIN vec_corpus c USING (corpus_id) LEFT JOIN documents d ON d.doc_id = c.doc_id),
case_ctx AS (
  SELECT q.case_id, string_agg(lower(coalesce(t.text, '')), ' ' ORDER BY t.rank) AS context
  FROM hit_text t JOIN vec_queries q USING (query_id) GROUP BY q.case_id)"""

QA = """qa_cases AS (
  SELECT conv_id * 1000000 + turn AS case_id, (conv_id * 1000000 + turn) % (SELECT count(*) FROM embeddings) AS vec_id, conv_id, turn, text AS query, next_text AS answer
  FROM (SELECT conv_id, turn, role, text,
               lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS next_role,
               lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS next_text
        FROM conversations)
  WHERE role = 'user' AND next_role = 'assistant')"""

IMPACT = """impact0 AS (
  SELECT d.doc_id, 'q' || (d.doc_id // 5) AS question_id, 'q' || (d.doc_id // 5) AS question_text,
         'prompt_v' || (d.doc_id % 5) AS prompt_version,
         least(d.n_chars::DOUBLE / 4000.0, 1.0) AS retrieval,
         l.quality::DOUBLE AS generation,
         1.0 - 0.5 * l.toxic::DOUBLE AS ragas
  FROM documents d LEFT JOIN labels l USING (doc_id)),
impact AS (
  SELECT *, retrieval * 0.4 + generation * 0.3 + ragas * 0.3 AS rqi,
         'prompt_v' || (doc_id % 5) AS model_name
  FROM impact0),
impact2 AS (SELECT *, {grade_rqi} AS grade FROM impact)"""


def _grade(x: str) -> str:
    return (f"CASE WHEN {x} IS NULL THEN NULL WHEN {x} >= 0.9 THEN 'A+' WHEN {x} >= 0.8 THEN 'A' "
            f"WHEN {x} >= 0.7 THEN 'B' WHEN {x} >= 0.6 THEN 'C' WHEN {x} >= 0.5 THEN 'D' ELSE 'F' END")


def _just(r: str, g: str, j: str) -> str:
    return (f"concat_ws(chr(10), CASE WHEN {r} < 0.6 THEN 'RETRIEVAL_BOTTLENECK' ELSE 'RETRIEVAL_HEALTHY' END, "
            f"CASE WHEN {g} < 0.6 THEN 'GENERATION_LOW' WHEN {g} > 0.8 THEN 'GENERATION_HIGH' END, "
            f"CASE WHEN {j} < 0.6 THEN 'JUDGED_POOR' WHEN {j} > 0.8 THEN 'JUDGED_STRONG' END, "
            f"CASE WHEN {r} > 0.8 AND {j} < 0.5 THEN 'RAG_PARADOX' END)")


def _rqi(r: str, g: str, j: str) -> str:
    return f"({r} * 0.4 + {g} * 0.3 + {j} * 0.3)"


def _br4(x: str) -> str:
    return f"round_even(round({x}, 12), 4)"


IMPACT = IMPACT.replace("{grade_rqi}", _grade("rqi"))
KW_RE = "'\\p{L}{6,}'"

JUDGED = """cp AS (
  SELECT query_id AS sample_id, sum(pat * v) / (sum(v) + 1e-10) AS value FROM (
    SELECT query_id, rank, v,
           sum(v) OVER (PARTITION BY query_id ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::DOUBLE / rank AS pat
    FROM (SELECT h.query_id, h.rank, CASE WHEN q.label = c.label THEN 1 ELSE 0 END AS v
          FROM hits h JOIN vec_queries q USING (query_id) JOIN vec_corpus c USING (corpus_id)))
  GROUP BY query_id),
cr_toks AS (
  SELECT k.case_id, regexp_extract_all(lower(coalesce(k.query, '')), '\\p{L}{6,}') AS toks,
         lower(coalesce(c.context, '')) AS ctx
  FROM keyword_cases k LEFT JOIN case_ctx c USING (case_id) WHERE k.query <> ''),
cr AS (
  SELECT case_id, len(toks)::BIGINT AS n_statements,
         len(list_filter(toks, lambda t: contains(ctx, t)))::BIGINT AS n_supported FROM cr_toks),
ff_toks AS (
  SELECT a.case_id, regexp_extract_all(lower(a.answer), '\\p{L}{6,}') AS toks, coalesce(c.context, '') AS ctx
  FROM qa_cases a LEFT JOIN case_ctx c ON c.case_id = a.vec_id WHERE a.query <> ''),
ff AS (
  SELECT case_id, coalesce(len(toks), 0)::BIGINT AS n_statements,
         coalesce(len(list_filter(toks, lambda t: contains(ctx, t))), 0)::BIGINT AS n_supported FROM ff_toks),
qtok AS (SELECT case_id, unnest(regexp_extract_all(lower(query), '\\p{L}{6,}')) AS token FROM qa_cases WHERE query <> ''),
atok AS (SELECT case_id, unnest(regexp_extract_all(lower(answer), '\\p{L}{6,}')) AS token FROM qa_cases WHERE query <> ''),
qc AS (SELECT case_id, token, count(*) AS c FROM qtok GROUP BY case_id, token),
ac AS (SELECT case_id, token, count(*) AS c FROM atok GROUP BY case_id, token),
qn AS (SELECT case_id, sum(c * c) AS n FROM qc GROUP BY case_id),
an AS (SELECT case_id, sum(c * c) AS n FROM ac GROUP BY case_id),
dot AS (SELECT qc.case_id, sum(qc.c * ac.c) AS d FROM qc JOIN ac USING (case_id, token) GROUP BY qc.case_id),
ar AS (
  SELECT s.case_id,
         CASE WHEN qn.n IS NULL OR an.n IS NULL THEN 0.0
              ELSE coalesce(dot.d, 0)::DOUBLE / (sqrt(qn.n::DOUBLE) * sqrt(an.n::DOUBLE)) END AS value
  FROM qa_cases s LEFT JOIN qn USING (case_id) LEFT JOIN an USING (case_id) LEFT JOIN dot USING (case_id)
  WHERE s.query <> ''),
judged_long AS (
  SELECT 'context_precision' AS metric, value FROM cp
  UNION ALL SELECT 'context_recall', CASE WHEN n_statements = 0 THEN NULL ELSE n_supported::DOUBLE / n_statements END FROM cr
  UNION ALL SELECT 'faithfulness', CASE WHEN n_statements = 0 THEN NULL ELSE n_supported::DOUBLE / n_statements END FROM ff
  UNION ALL SELECT 'answer_relevancy', value FROM ar),
judged AS (SELECT coalesce(avg(m), 0.0) AS ragas FROM (SELECT metric, avg(value) AS m FROM judged_long GROUP BY metric))"""

RETRIEVAL = """rr AS (
  SELECT k.case_id, len(k.expected_keywords)::BIGINT AS n_keywords,
         len(list_filter(k.expected_keywords, lambda w: contains(coalesce(c.context, ''), lower(w))))::BIGINT AS n_found
  FROM keyword_cases k LEFT JOIN case_ctx c USING (case_id)
  WHERE length(k.query) > 0 AND len(k.expected_keywords) > 0)"""

GENERATION = """gr AS (
  SELECT case_id, len(kw)::BIGINT AS n_keywords,
         len(list_filter(kw, lambda w: contains(lower(coalesce(answer, '')), lower(w))))::BIGINT AS n_found
  FROM (SELECT *, regexp_extract_all(lower(query), '\\p{L}{6,}') AS kw FROM qa_cases)
  WHERE length(query) > 0),
gr2 AS (SELECT *, CASE WHEN n_keywords = 0 THEN 0.0 ELSE n_found::DOUBLE / n_keywords END AS recall FROM gr)"""

RUN_SCORES = IMPACT + """,
per_run AS (
  SELECT d.source AS run, avg(i.retrieval) AS retrieval, avg(i.generation) AS generation, avg(i.ragas) AS ragas
  FROM impact2 i JOIN documents d USING (doc_id) GROUP BY d.source),
long AS (
  SELECT run, 'retrieval' AS metric, retrieval AS value FROM per_run
  UNION ALL SELECT run, 'generation', generation FROM per_run
  UNION ALL SELECT run, 'ragas', ragas FROM per_run),
wide AS (
  SELECT run AS model_name,
         coalesce(max(CASE WHEN metric = 'retrieval' THEN value END), 0.0) AS retrieval,
         coalesce(max(CASE WHEN metric = 'generation' THEN value END), 0.0) AS generation,
         coalesce(max(CASE WHEN metric = 'ragas' THEN value END), 0.0) AS ragas
  FROM long GROUP BY run),
rep AS (SELECT *, """ + _rqi("retrieval", "generation", "ragas") + """ AS rqi FROM wide)"""

RUNS = IMPACT + """,
history AS (
  SELECT d.lang AS model, TRY_CAST(regexp_extract(d.source, '([0-9]+)$', 1) AS BIGINT) AS run_no,
         avg(i.retrieval) AS retrieval, avg(i.generation) AS generation, avg(i.ragas) AS ragas
  FROM impact2 i JOIN documents d USING (doc_id) GROUP BY 1, 2),
reports AS (
  SELECT model, run_no, r, g, j, """ + _rqi("r", "g", "j") + """ AS rqi FROM (
    SELECT model, run_no, coalesce(retrieval, 0.0) AS r, coalesce(generation, 0.0) AS g,
           coalesce(ragas, 0.0) AS j FROM history))"""

RESPONSES = """responses AS (
  SELECT 'q' || (doc_id // 5) AS question_text, 'prompt_v' || (doc_id % 5) AS prompt_version, text AS response
  FROM documents),
pairs AS (
  SELECT n.question_text, n.prompt_version, b.response AS base_response, n.response
  FROM responses n JOIN responses b ON b.question_text = n.question_text AND b.prompt_version = 'prompt_v0'
  WHERE n.prompt_version <> 'prompt_v0')"""

TFIDF = CHUNKS + """,
toks AS (SELECT chunk_id, unnest(regexp_extract_all(lower(text), '\\p{L}{6,}')) AS token FROM chunks),
tf AS (SELECT chunk_id, token, count(*) AS tf FROM toks GROUP BY chunk_id, token),
dfreq AS (SELECT token, count(*) AS df FROM tf GROUP BY token),
ndocs AS (SELECT count(*) AS n FROM chunks),
scored AS (
  SELECT tf.chunk_id, tf.token, round(tf.tf::DOUBLE * ln(ndocs.n::DOUBLE / dfreq.df::DOUBLE), 9) AS score
  FROM tf JOIN dfreq USING (token), ndocs),
top AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY chunk_id ORDER BY score DESC, token ASC) AS r FROM scored)
  WHERE r <= 5),
chunk_kw AS (
  SELECT c.chunk_id, c.text,
         coalesce(list(t.token ORDER BY t.r) FILTER (WHERE t.token IS NOT NULL), []::VARCHAR[]) AS kw
  FROM chunks c LEFT JOIN top t USING (chunk_id) GROUP BY c.chunk_id, c.text)"""


def _versions_values() -> str:
    rows = ", ".join(f"({_lit(v)}, {_lit(PROMPT_VERSIONS[v])})" for v in VERSIONS)
    return f"catalogue AS (SELECT * FROM (VALUES {rows}) t(prompt_version, system_prompt))"


def _delta_sql() -> str:
    base_cols = ", ".join(f"max(CASE WHEN prompt_version = {_lit(b)} THEN {m} END) AS {m}__{b}"
                          for b in VERSIONS for m in ("rqi", "ragas"))
    deltas = ", ".join(f"{_br4(f'i.{m} - b.{m}__{b}')} AS {m}_delta_vs_{b}"
                       for b in VERSIONS for m in ("rqi", "ragas"))
    return (_with(IMPACT, f"base AS (SELECT question_text, {base_cols} FROM impact2 GROUP BY question_text)")
            + "SELECT i.question_id, i.question_text, i.prompt_version, i.grade, round(round(i.rqi, 12), 6) AS rqi, "
              "round(round(i.ragas, 12), 6) AS ragas, round(round(i.retrieval, 12), 6) AS retrieval, round(round(i.generation, 12), 6) AS generation, "
              f"i.model_name, {deltas} "
              "FROM impact2 i LEFT JOIN base b ON i.question_text IS NOT DISTINCT FROM b.question_text")


def _pivot_sql() -> str:
    cols = ", ".join(f"{_br4(f'avg(rqi) FILTER (WHERE prompt_version = {_lit(v)})')} AS {v}" for v in VERSIONS)
    return _with(IMPACT) + f"SELECT question_text, {cols} FROM impact2 WHERE rqi IS NOT NULL GROUP BY question_text"


def _prompt_sql() -> str:
    human = (f"{_lit(HUMAN_PREFIX)} || coalesce(x.context, '') || {_lit(QUESTION_PREFIX)} || coalesce(x.query, '')")
    prompt = f"c.system_prompt || {_lit(chr(10) + chr(10))} || {human}"
    return (_with(HITS, KEYWORD_CASES, _versions_values(),
                  f"ctx AS (SELECT query_id, string_agg(coalesce(text, ''), {_lit(CONTEXT_SEPARATOR)} ORDER BY rank) "
                  "AS context FROM hit_text GROUP BY query_id)",
                  "x AS (SELECT k.case_id, k.query, c.context FROM keyword_cases k "
                  "LEFT JOIN (SELECT q.case_id, ctx.context FROM ctx JOIN vec_queries q USING (query_id)) c "
                  "USING (case_id) WHERE length(k.query) > 0)")
            + f"SELECT x.case_id, c.prompt_version, length({prompt})::BIGINT AS prompt_chars, "
              f"md5({prompt}) AS prompt_md5 FROM x, catalogue c")


def _impact_run_sql() -> str:
    tok = "regexp_extract_all(lower({}), '\\p{{L}}{{6,}}')"
    share = "len(list_filter({0}, lambda t: contains(lower(x.context), t)))::DOUBLE / nullif(len({0}), 0)"
    return _with(
        HITS, KEYWORD_CASES, _versions_values(), RETRIEVAL,
        f"ctx AS (SELECT query_id AS case_id, string_agg(coalesce(h.text, ''), {_lit(CONTEXT_SEPARATOR)} ORDER BY rank) AS context, "
        "count(*) AS n_chunks, string_agg('doc_' || c.doc_id, ',' ORDER BY rank) AS chunk_ids "
        "FROM hit_text h JOIN vec_corpus c USING (corpus_id) GROUP BY query_id)",
        "x AS (SELECT k.case_id, k.query, k.expected_keywords, v.prompt_version, coalesce(c.context, '') AS context, c.n_chunks, c.chunk_ids, "
        "substr(coalesce(c.context, ''), 1, length(v.system_prompt)) AS answer "
        "FROM keyword_cases k CROSS JOIN catalogue v LEFT JOIN ctx c USING (case_id) WHERE length(k.query) > 0)",
        "verdicts AS (SELECT k.case_id, h.rank, CASE WHEN len(list_filter(" + tok.format("k.query")
        + ", lambda t: contains(lower(coalesce(h.text, '')), t))) > 0 THEN 1 ELSE 0 END AS v "
        "FROM keyword_cases k JOIN hit_text h ON h.query_id = k.case_id WHERE length(k.query) > 0)",
        "cp AS (SELECT case_id, sum(pat * v) / (sum(v) + 1e-10) AS cp FROM (SELECT *, sum(v) OVER (PARTITION BY case_id ORDER BY rank "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::DOUBLE / rank AS pat FROM verdicts) GROUP BY case_id)",
        f"tk AS (SELECT x.*, {tok.format('x.query')} AS qt, {tok.format('x.answer')} AS wt FROM x)",
        "long AS (SELECT prompt_version, case_id, unnest(qt) AS t, 1 AS q, 0 AS a FROM tk UNION ALL "
        "SELECT prompt_version, case_id, unnest(wt), 0, 1 FROM tk)",
        "n AS (SELECT prompt_version, case_id, t, sum(q) AS q, sum(a) AS a FROM long GROUP BY ALL)",
        "cos AS (SELECT prompt_version, case_id, CASE WHEN sum(q) = 0 OR sum(a) = 0 THEN 0.0 ELSE sum(q * a)::DOUBLE / (sqrt(sum(q * q)::DOUBLE) "
        "* sqrt(sum(a * a)::DOUBLE)) END AS ar FROM n GROUP BY ALL)",
        "m AS (SELECT x.prompt_version, avg(cp.cp) AS cp, avg(" + share.format("x.qt") + ") AS cr, avg(" + share.format("x.wt") + ") AS ff, "
        "avg(coalesce(cos.ar, 0.0)) AS ar, avg(CASE WHEN len(x.expected_keywords) = 0 THEN 0.0 ELSE len(list_filter(x.expected_keywords, "
        "lambda w: contains(lower(x.answer), lower(w))))::DOUBLE / len(x.expected_keywords) END) AS g "
        "FROM tk x LEFT JOIN cp USING (case_id) LEFT JOIN cos USING (prompt_version, case_id) GROUP BY x.prompt_version)",
        "s AS (SELECT prompt_version, (SELECT coalesce(avg(n_found::DOUBLE / n_keywords), 0.0) FROM rr) AS r, g, list_avg([cp, cr, ff, ar]) AS j FROM m)",
        f"rep AS (SELECT *, {_rqi('r', 'g', 'j')} AS rqi FROM s)",
        "entry AS (SELECT query, prompt_version, min({'answer': answer, 'n': n_chunks, 'ids': chunk_ids}) AS e FROM x GROUP BY ALL)",
    ) + ("SELECT md5(query) AS question_md5, prompt_version, md5(e.answer) AS response_md5, e.n::BIGINT AS n_chunks, e.ids AS chunk_ids, "
         "prompt_version <> 'prompt_v0' AS has_summary, prompt_version AS model_name, round(round(rqi, 12), 6) AS rqi, round(round(j, 12), 6) AS ragas, "
         "round(round(r, 12), 6) AS retrieval, round(round(g, 12), 6) AS generation, " + _grade("rqi") + " AS grade "
         "FROM entry JOIN rep USING (prompt_version)")


def _run_compare_sql() -> str:
    cols = ", ".join(f"round(round(max(rqi) FILTER (WHERE model = {_lit(m)}), 12), 6) AS {m}" for m in MODELS)
    return _with(RUNS) + f"SELECT run_no, {cols} FROM reports GROUP BY run_no"


def _counts_sql() -> str:
    return (_with(CHUNKS, VECS, KEYWORD_CASES, QA, IMPACT)
            + "SELECT 'chunks' AS table_name, count(*)::BIGINT AS n FROM chunks "
              "UNION ALL SELECT 'query_vectors', count(*)::BIGINT FROM vec_queries "
              "UNION ALL SELECT 'corpus_vectors', count(*)::BIGINT FROM vec_corpus "
              "UNION ALL SELECT 'keyword_cases', count(*)::BIGINT FROM keyword_cases "
              "UNION ALL SELECT 'qa_cases', count(*)::BIGINT FROM qa_cases "
              "UNION ALL SELECT 'impact_rows', count(*)::BIGINT FROM impact2")


def _upsert_sql() -> str:
    rep = ("rep AS (SELECT " + _rqi("coalesce(avg(retrieval), 0.0)", "coalesce(avg(generation), 0.0)",
                                    "coalesce(avg(ragas), 0.0)") + " AS rqi FROM impact2 WHERE prompt_version = 'prompt_v2')")
    allrows = ("allrows AS (SELECT question_text, prompt_version, rqi, grade, 'kept' AS state FROM impact2 "
               "WHERE rqi IS NOT NULL UNION ALL SELECT question_text, prompt_version, rqi, grade, 'added' "
               "FROM impact2 WHERE rqi IS NULL AND prompt_version = 'prompt_v2')")
    return (_with(IMPACT, rep, allrows)
            + "SELECT question_text, prompt_version, round(round(rqi, 12), 6) AS rqi, grade, state FROM allrows "
              "WHERE prompt_version <> 'prompt_v2' "
              f"UNION ALL SELECT a.question_text, a.prompt_version, round(round(r.rqi, 12), 6), {_grade('r.rqi')}, a.state "
              "FROM allrows a, rep r WHERE a.prompt_version = 'prompt_v2'")


def _evaluation_sql() -> str:
    r, g, j = "s.r", "s.g", "s.j"
    return (_with(HITS, KEYWORD_CASES, QA, RETRIEVAL, GENERATION, JUDGED,
                  "s0 AS (SELECT (SELECT coalesce(avg(CASE WHEN n_keywords = 0 THEN NULL ELSE n_found::DOUBLE / n_keywords END), 0.0) FROM rr) AS r, "
                  "(SELECT coalesce(avg(recall), 0.0) FROM gr2) AS g, (SELECT ragas FROM judged) AS j)",
                  f"s AS (SELECT r, g, j, {_rqi('r', 'g', 'j')} AS rqi FROM s0)")
            + f"SELECT 'offline' AS model_name, round(round({r}, 12), 6) AS retrieval, round(round({g}, 12), 6) AS generation, "
              f"round(round({j}, 12), 6) AS ragas, round(round(s.rqi, 12), 6) AS rqi, {_grade('s.rqi')} AS grade, "
              f"{_just(r, g, j)} AS justification FROM s")


ORACLE_SQL: dict[str, str] = {
    "page_docs": _with(PAGE_DOCS)
    + "SELECT doc_id, source, page, lang, length(text)::BIGINT AS n_chars FROM page_docs",

    "window_chunks": _with(CHUNKS) + "SELECT doc_id, source, page, pos, start, text FROM chunks",

    "chunk_ids": _with(CHUNKS) + "SELECT chunk_id, chunk_no, doc_id, source, page, pos FROM chunks",

    "knn_topk": _with(HITS) + "SELECT query_id, rank, corpus_id, round(round(distance, 12), 6) AS distance FROM hits",
    # the blocked physical path computes the same hits
    "knn_block": _with(HITS) + "SELECT query_id, rank, corpus_id, round(round(distance, 12), 6) AS distance FROM hits",

    "cited_sources": _with(HITS, PAGE_DOCS)
    + "SELECT h.query_id, h.rank, h.corpus_id, coalesce(nullif(string_split(p.source, '/')[-1], ''), 'unknown') AS source, "
      "p.page::BIGINT AS page FROM hits h JOIN vec_corpus c USING (corpus_id) LEFT JOIN page_docs p ON p.doc_id = c.doc_id",

    "vector_listing": _with(VECS)
    + "SELECT c.corpus_id, coalesce(nullif(string_split(d.source, '/')[-1], ''), 'unknown') AS source, "
      "len(c.embedding)::BIGINT AS dim, "
      "round(round(sqrt(list_sum(list_transform(c.embedding, lambda x: x::DOUBLE * x::DOUBLE))), 12), 6) AS norm "
      "FROM vec_corpus c LEFT JOIN documents d USING (doc_id)",

    "context_format": _with(HITS)
    + f"SELECT query_id, length(context)::BIGINT AS context_chars, md5(context) AS context_md5 FROM ("
      f"SELECT query_id, string_agg(coalesce(text, ''), {_lit(CONTEXT_SEPARATOR)} ORDER BY rank) AS context "
      "FROM hit_text GROUP BY query_id)",

    "prompt_render": _prompt_sql(),

    "retrieval_recall": _with(HITS, KEYWORD_CASES, RETRIEVAL)
    + "SELECT case_id, n_keywords, n_found, round(round(n_found::DOUBLE / n_keywords, 12), 6) AS recall FROM rr",

    "retrieval_score": _with(HITS, KEYWORD_CASES, RETRIEVAL)
    + "SELECT round(round(coalesce(avg(n_found::DOUBLE / n_keywords), 0.0), 12), 6) AS score FROM rr",

    "generation_recall": _with(QA, GENERATION)
    + "SELECT case_id, n_keywords, n_found, round(round(recall, 12), 6) AS recall FROM gr2",

    "generation_score": _with(QA, GENERATION)
    + "SELECT round(round(coalesce(avg(recall), 0.0), 12), 6) AS score FROM gr2",

    "context_precision": _with(HITS, KEYWORD_CASES, QA, JUDGED)
    + "SELECT sample_id AS query_id, round(round(value, 12), 6) AS context_precision FROM cp",

    "context_recall": _with(HITS, KEYWORD_CASES, QA, JUDGED)
    + "SELECT case_id, n_statements, n_supported, round(round(CASE WHEN n_statements = 0 THEN NULL "
      "ELSE n_supported::DOUBLE / n_statements END, 12), 6) AS context_recall FROM cr",

    "faithfulness": _with(HITS, KEYWORD_CASES, QA, JUDGED)
    + "SELECT case_id, n_statements, n_supported, round(round(CASE WHEN n_statements = 0 THEN NULL "
      "ELSE n_supported::DOUBLE / n_statements END, 12), 6) AS faithfulness FROM ff",

    "answer_relevancy": _with(HITS, KEYWORD_CASES, QA, JUDGED)
    + "SELECT case_id, round(round(value, 12), 6) AS answer_relevancy FROM ar",

    "judged_mean_of_means": _with(HITS, KEYWORD_CASES, QA, JUDGED)
    + "SELECT round(round(ragas, 12), 6) AS ragas FROM judged",

    "evaluation_report": _evaluation_sql(),

    "rqi_report": _with(RUN_SCORES)
    + "SELECT model_name, round(round(retrieval, 12), 6) AS retrieval, round(round(generation, 12), 6) AS generation, "
      f"round(round(ragas, 12), 6) AS ragas, round(round(rqi, 12), 6) AS rqi, {_grade('rqi')} AS grade FROM rep",

    "rqi_justification": _with(RUN_SCORES)
    + f"SELECT model_name, {_just('retrieval', 'generation', 'ragas')} AS justification FROM rep",

    "console_report": _with(RUN_SCORES)
    + "SELECT model_name, '0.40' AS retrieval_weight, '0.30' AS generation_weight, '0.30' AS ragas_weight, "
      "printf('%.2f', retrieval) AS retrieval_txt, printf('%.2f', generation) AS generation_txt, "
      "printf('%.2f', ragas) AS ragas_txt, printf('%.2f', rqi) AS rqi_txt, " + _grade("rqi") + " AS grade FROM rep",

    "impact_rows": _with(IMPACT)
    + "SELECT question_id, question_text, prompt_version, grade, round(round(rqi, 12), 6) AS rqi, round(round(ragas, 12), 6) AS ragas, "
      "round(round(retrieval, 12), 6) AS retrieval, round(round(generation, 12), 6) AS generation, model_name FROM impact2",

    "prompt_summary": _with(IMPACT)
    + "SELECT prompt_version, " + ", ".join(f"{_br4(f'avg({c})')} AS {c}" for c in ("rqi", "ragas", "retrieval", "generation"))
    + " FROM impact2 WHERE prompt_version IS NOT NULL GROUP BY prompt_version",

    "question_pivot": _pivot_sql(),

    "delta_all_baselines": _delta_sql(),

    "distinct_versions": _with(IMPACT)
    + "SELECT DISTINCT prompt_version FROM impact2 WHERE prompt_version IS NOT NULL",

    "attach_scores": _with(IMPACT, "reports AS (SELECT prompt_version, coalesce(avg(retrieval), 0.0) AS r, "
                           "coalesce(avg(generation), 0.0) AS g, coalesce(avg(ragas), 0.0) AS j FROM impact2 "
                           "GROUP BY prompt_version)",
                           "rep AS (SELECT *, " + _rqi("r", "g", "j") + " AS rqi FROM reports)")
    + "SELECT i.question_id, i.prompt_version, rep.prompt_version AS model_name, round(round(rep.r, 12), 6) AS retrieval, "
      "round(round(rep.g, 12), 6) AS generation, round(round(rep.j, 12), 6) AS ragas, round(round(rep.rqi, 12), 6) AS rqi, "
      + _grade("rep.rqi") + " AS grade FROM impact2 i LEFT JOIN rep USING (prompt_version)",

    "pending_generation": _with(IMPACT, "vers AS (SELECT * FROM (VALUES "
                                + ", ".join(f"({_lit(v)})" for v in VERSIONS) + ") t(prompt_version))")
    + "SELECT q.question_text, v.prompt_version FROM (SELECT DISTINCT question_text FROM impact2) q, vers v "
      "WHERE NOT EXISTS (SELECT 1 FROM impact2 e WHERE e.rqi IS NOT NULL AND e.question_text = q.question_text "
      "AND e.prompt_version = v.prompt_version)",

    "upsert_results": _upsert_sql(),

    "baseline_pairs": _with(RESPONSES)
    + "SELECT question_text, prompt_version, md5(base_response) AS base_md5, md5(response) AS new_md5 FROM pairs",

    "answer_diff": _with(RESPONSES, """tk AS (
  SELECT question_text, prompt_version, length(base_response)::BIGINT AS base_chars, length(response)::BIGINT AS new_chars,
         list_distinct(regexp_extract_all(lower(base_response), '\\p{L}{6,}')) AS bt,
         list_distinct(regexp_extract_all(lower(response), '\\p{L}{6,}')) AS nt
  FROM pairs)""")
    + "SELECT question_text, prompt_version, base_chars, new_chars, new_chars - base_chars AS len_delta, "
      "round(round(CASE WHEN len(list_distinct(list_concat(bt, nt))) = 0 THEN NULL "
      "ELSE len(list_intersect(bt, nt))::DOUBLE / len(list_distinct(list_concat(bt, nt))) END, 12), 6) AS jaccard, "
      "round(round(CASE WHEN len(nt) = 0 THEN NULL ELSE (len(nt) - len(list_intersect(nt, bt)))::DOUBLE / len(nt) END, 12), 6) "
      "AS new_token_share FROM tk",

    "prompt_impact": _impact_run_sql(),

    "table_counts": _counts_sql(),

    "sample_chunks": _with(CHUNKS)
    + "SELECT chunk_id, source, page, pos, md5('42:' || chunk_id) AS sample_key FROM chunks "
      "ORDER BY sample_key, chunk_id LIMIT 5",

    "case_quarantine": _with(KEYWORD_CASES)
    + "SELECT case_id, CASE WHEN query IS NULL OR length(query) = 0 OR expected_keywords IS NULL "
      "OR len(expected_keywords) = 0 THEN 'quarantine' ELSE 'good' END AS status, "
      "len(expected_keywords)::BIGINT AS n_keywords FROM keyword_cases",

    "synthetic_keywords": _with(TFIDF)
    + "SELECT chunk_id, array_to_string(kw, ',') AS keywords, len(kw)::BIGINT AS n_keywords FROM chunk_kw",

    "synthetic_cases": _with(TFIDF)
    + "SELECT chunk_id, 'retrieval' AS case_type, 'Which passage mentions ' || array_to_string(kw, ', ') || '?' AS query, "
      "array_to_string(kw, ',') AS expected FROM chunk_kw "
      "UNION ALL SELECT chunk_id, 'generation', 'Summarise what the passage says about ' || coalesce(kw[1], 'it') || '.', "
      "array_to_string(kw[1:3], ',') FROM chunk_kw "
      "UNION ALL SELECT chunk_id, 'ragas', 'Explain how ' || coalesce(kw[1], 'the passage') || ' relates to ' "
      "|| coalesce(kw[2], 'its context') || '.', md5(text) FROM chunk_kw",

    "extractive_answers": _with(HITS, KEYWORD_CASES, _versions_values(),
                                f"ctx AS (SELECT query_id AS case_id, string_agg(coalesce(text, ''), {_lit(CONTEXT_SEPARATOR)} ORDER BY rank) "
                                "AS context FROM hit_text GROUP BY query_id)",
                                """lines AS (
  SELECT k.case_id, list_distinct(regexp_extract_all(lower(k.query), '\\p{L}{3,}')) AS qw,
         list_filter(list_transform(string_split(coalesce(c.context, ''), chr(10)), lambda x: trim(x, ' ' || chr(9) || chr(13))), lambda x: x <> '') AS l
  FROM keyword_cases k LEFT JOIN ctx c USING (case_id) WHERE length(k.query) > 0),
best AS (
  SELECT case_id, list_sort(list_transform(range(1, len(l) + 1), lambda i: {
           's': -len(list_filter(list_distinct(regexp_extract_all(lower(l[i]), '\\p{L}{3,}')), lambda w: list_contains(qw, w))), 'i': i}))[1:3] AS b, l
  FROM lines),
answers AS (
  SELECT case_id, CASE WHEN len(l) = 0 THEN 'I don''t know.'
                       ELSE array_to_string(list_transform(list_sort(list_transform(b, lambda t: t.i)), lambda i: l[i]), ' ') END AS answer FROM best)""")
    + "SELECT a.case_id, c.prompt_version, length(a.answer)::BIGINT AS answer_chars, NULL::VARCHAR AS error FROM answers a, catalogue c",

    "hash_embed": _with(CHUNKS)
    + "SELECT chunk_no, 256::BIGINT AS dim, CASE WHEN regexp_matches(text, '[\\p{L}\\p{N}]') THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS norm FROM chunks",

    "recursive_coverage": (
        "WITH s AS (SELECT doc_id, regexp_replace(text, '[\\s\\x0b\\x1c-\\x1f\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}"
        "\\x{202f}\\x{205f}\\x{3000}]+', '', 'g') AS t FROM documents) "
        "SELECT doc_id, true AS within_size, true AS within_overlap, length(t)::BIGINT AS solid_chars, md5(t) AS solid_md5 FROM s WHERE t <> ''"),

    "run_average": _with(RUNS)
    + "SELECT model, round(round(avg(rqi), 12), 6) AS rqi_mean, round(round(stddev_samp(rqi), 12), 6) AS rqi_std, "
      "count(*)::BIGINT AS n_runs FROM reports GROUP BY model",

    "run_compare": _run_compare_sql(),

    "quality_gate": _with(RUNS)
    + f"SELECT model, run_no, round(round(rqi, 12), 6) AS rqi, {_grade('rqi')} AS grade, rqi >= 0.7 AS passed FROM reports",

    "quality_trend": _with(RUNS)
    + "SELECT model, run_no, round(round(rqi, 12), 6) AS rqi, round(round(lag(rqi) OVER w, 12), 6) AS prev_rqi, "
      "round(round(rqi - lag(rqi) OVER w, 12), 6) AS rqi_change, "
      "round(round(avg(rqi) OVER (PARTITION BY model ORDER BY run_no ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 12), 6) "
      "AS rqi_moving_avg FROM reports WINDOW w AS (PARTITION BY model ORDER BY run_no)",
}
