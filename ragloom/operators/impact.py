"""Prompt-impact reporting.

The fact table is ``impact_rows`` (question_id, question_text,
prompt_version, grade, rqi, ragas, retrieval, generation, model_name).
Everything is grouping, pivoting and equi-joins on it; the only values
brought to the driver are the sorted distinct prompt versions (the pivot
header, bounded by the prompt catalogue).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ragloom.functions.scoring import grade, rqi
from ragloom.functions.text import KEYWORD_PATTERN, bround_stable, lower_tokens

# The names of the tidy table's and the impact document's fields.
IDENTITY_COLS = ["question_id", "question_text", "prompt_version", "grade",
                 "rqi", "ragas", "retrieval", "generation", "model_name"]
NUMERIC_COLS = ["rqi", "ragas", "retrieval", "generation"]
TEXT_COLS = ["response", "change_summary"]
CONTEXT_COLS = {"retrieved_chunks": "array<string>",
                "retrieved_metadata": "array<struct<chunk_id:string,source:string,page:bigint>>"}
ORDER_COL = "run_order"
DELTA_METRICS = ("rqi", "ragas")
BASELINE_VERSION = "prompt_v0"

NESTED_SCHEMA = (
    "STRUCT<question: STRING, prompt_results: MAP<STRING, STRUCT<"
    "response: STRING, change_summary: STRING, "
    "metadata: STRUCT<query: STRING, retrieved_chunks: ARRAY<STRING>, "
    "retrieved_metadata: ARRAY<STRUCT<chunk_id: STRING, source: STRING, page: BIGINT>>, prompt_version: STRING>, "
    "scores: STRUCT<model_name: STRING, retrieval: STRING, generation: STRING, "
    "ragas: STRING, rqi: STRING, grade: STRING, prompt_version: STRING>>>>")


def numeric(c) -> Column:
    """Unparsable -> null, NaN -> null (Spark 4 ANSI: plain cast raises)."""
    x = F.expr(f"try_cast({c} AS DOUBLE)") if isinstance(c, str) else c.try_cast("double")
    return F.when(F.isnan(x), F.lit(None).cast("double")).otherwise(x)


def select_existing(df: DataFrame, wanted) -> DataFrame:
    """Keep those of the wanted columns that exist, in the wanted order."""
    return df.select(*[c for c in wanted if c in df.columns])


# ------------------------------------------------------------- I1 / S7 / S8 --

def nest_impact(rows: DataFrame, order: str = ORDER_COL) -> DataFrame:
    """Tidy rows -> one JSON document per question (the reference's nested
    question -> version -> {response, metadata, change_summary, scores} form;
    what ``rows`` has no column for is null, retrieved chunks and their
    metadata included).

    A repeated (question, version) keeps its last entry: the one of the
    greatest ``order`` (a column of ``rows``, if there is one), else and among
    equals the greatest by value, so the result does not depend on the order
    of the rows.  The merge by (question, version) comes first, so a question's
    group has one entry per version and is bounded by the catalogue.  A row
    without a version has no key in the document and is left out.
    """
    scores = F.struct(*[F.col(c).cast("string").alias(c) if c in NUMERIC_COLS else F.col(c)
                        for c in ("model_name", "retrieval", "generation", "ragas", "rqi", "grade")],
                      F.col("prompt_version"))
    have = lambda c, t: (F.col(c) if c in rows.columns else F.lit(None)).cast(t).alias(c)
    contexts = [have(c, t) for c, t in CONTEXT_COLS.items()]
    last = (F.col(order) if order in rows.columns else F.lit(0)).alias("order")
    value = F.struct(*[have(c, "string") for c in TEXT_COLS],
                     F.struct(F.col("question_text").alias("query"), *contexts, F.col("prompt_version")).alias("metadata"),
                     scores.alias("scores"))
    entries = (rows.where(F.col("prompt_version").isNotNull()).groupBy("question_id", "prompt_version")
               .agg(F.max(F.struct(last, F.col("question_text").alias("question"), value.alias("value"))).alias("e")))
    return (entries.groupBy("question_id")
            .agg(F.max("e.question").alias("question"),
                 F.map_from_entries(F.collect_list(F.struct(F.col("prompt_version").alias("key"), F.col("e.value").alias("value"))))
                  .alias("prompt_results"))
            .select("question_id",
                    F.to_json(F.struct("question", "prompt_results")).alias("document")))


def flatten_impact(nested: DataFrame, key: str = "question_id", doc: str = "document") -> DataFrame:
    """I1 + P13: (question key, JSON document) -> one row per (question,
    version).  ``question_text`` is the inner field or else the key; missing
    scores are null; a question without results gives no row."""
    parsed = nested.select(F.col(key).alias("question_id"),
                           F.from_json(F.col(doc), NESTED_SCHEMA).alias("d"))
    exploded = parsed.select(
        "question_id",
        F.coalesce(F.col("d.question"), F.col("question_id")).alias("question_text"),
        F.explode("d.prompt_results").alias("prompt_version", "r"))
    s = "r.scores"
    return exploded.select(
        "question_id", "question_text", "prompt_version",
        F.col(f"{s}.grade").alias("grade"),
        numeric(F.col(f"{s}.rqi")).alias("rqi"),
        numeric(F.col(f"{s}.ragas")).alias("ragas"),
        numeric(F.col(f"{s}.retrieval")).alias("retrieval"),
        numeric(F.col(f"{s}.generation")).alias("generation"),
        F.col(f"{s}.model_name").alias("model_name"),
        *[F.col(f"r.{c}").alias(c) for c in TEXT_COLS],
        *[F.col(f"r.metadata.{c}").alias(c) for c in CONTEXT_COLS])


def flatten_impact_document(spark, path: str) -> DataFrame:
    """S7 for the reference's single-file form: one JSON object mapping
    question -> {question, prompt_results}.  The file is one value, so this
    path is for small exported documents; at scale write and read the JSON
    Lines form of :func:`nest_impact` instead."""
    raw = spark.read.text(path, wholetext=True)
    m = raw.select(F.from_json("value", f"MAP<STRING, {NESTED_SCHEMA}>").alias("m"))
    per_q = m.select(F.explode("m").alias("question_id", "d"))
    return flatten_impact(per_q.select("question_id", F.to_json("d").alias("document")))


# ------------------------------------------------------------- A4 / A5 / A6 --

def prompt_summary(rows: DataFrame) -> DataFrame:
    """A4 + I5: mean of each metric per prompt version (nulls skipped, null
    version dropped), half-to-even 4 places; partial aggregation map-side."""
    return (rows.where(F.col("prompt_version").isNotNull())
            .groupBy("prompt_version")
            .agg(*[bround_stable(F.avg(F.col(c))).alias(c)
                   for c in NUMERIC_COLS]))


def distinct_versions(rows: DataFrame, where: Column | None = None) -> list[str]:
    """Sorted distinct versions (a handful of values: the pivot header)."""
    df = rows if where is None else rows.where(where)
    return header_values(df, "prompt_version")


MAX_HEADER = 1000


def header_values(rows: DataFrame, col: str) -> list:
    """Sorted distinct values that become columns.  More than ``MAX_HEADER``
    is no header but a mistake (a key in the place of a version), and fails
    before the values reach the driver."""
    found = [r[0] for r in rows.select(col).where(F.col(col).isNotNull()).distinct().orderBy(col).limit(MAX_HEADER + 1).collect()]
    if len(found) > MAX_HEADER:
        raise ValueError(f"{col} has more than {MAX_HEADER} distinct values, too many for columns")
    return found


def question_pivot(rows: DataFrame, versions: list[str] | None = None) -> DataFrame:
    """A5: question x version mean rqi.  Rows whose rqi is null take no part,
    so a question or a version without any rqi disappears, as in the
    reference's pivot table."""
    valid = rows.where(F.col("rqi").isNotNull())
    vs = versions if versions is not None else distinct_versions(valid)
    p = valid.groupBy("question_text").pivot("prompt_version", vs).agg(F.avg("rqi"))
    return p.select("question_text", *[bround_stable(F.col(f"`{v}`")).alias(v) for v in vs])


# ------------------------------------------------------------------ I3 / J1 --

def delta_vs_baselines(rows: DataFrame, versions: list[str] | None = None,
                       metrics=DELTA_METRICS, mode: str = "unique") -> DataFrame:
    """For every version b (sorted) and metric m, ``m - m_b`` of the same
    question, half-to-even 4 places after the subtraction, null if either
    side is null.  Null question keys match each other, as in pandas.

    ``mode="unique"`` (default) needs one row per (question, version): the
    baselines of all versions come from one partial aggregation per question
    and one left join, so no key holds more than one row per version.  The
    same aggregation counts the rows of each version and the query fails
    (``raise_error``, no extra job) when a key repeats -- use ``fanout`` then.
    ``mode="fanout"`` reproduces the reference on duplicated keys: one left
    join per baseline version, each multiplying the duplicates.
    """
    vs = versions if versions is not None else distinct_versions(rows)
    ids = [c for c in IDENTITY_COLS if c in rows.columns]
    delta_cols = []
    if mode == "unique":
        # null-safe key as two plain columns: the aggregate's shuffle then
        # already partitions the baselines the way the join needs them
        nk = [F.coalesce(F.col("question_text"), F.lit("")).alias("__k1"),
              F.col("question_text").isNull().alias("__k2")]
        per_version = [F.count(F.when(F.col("prompt_version") == F.lit(b), F.lit(1))) for b in vs]
        base = rows.groupBy(*nk).agg(*[
            F.max(F.when(F.col("prompt_version") == F.lit(b), F.col(m))).alias(f"__{m}__{b}")
            for b in vs for m in metrics],
            (F.greatest(*per_version) if len(per_version) > 1 else per_version[0]).alias("__dup"))
        # a filter (not a dropped column) so that the check is always evaluated
        base = base.where(F.when(F.col("__dup") > 1, F.raise_error(F.lit(
            "delta_vs_baselines(mode='unique'): a (question, version) pair repeats; use mode='fanout'")))
            .isNull()).drop("__dup")
        keyed = rows.select("*", *nk)
        out = keyed.join(base, ["__k1", "__k2"], "left")
        for b in vs:
            for m in metrics:
                name = f"{m}_delta_vs_{b}"
                out = out.withColumn(name, bround_stable(F.col(m) - F.col(f"`__{m}__{b}`")))
                delta_cols.append(name)
        return out.select(*ids, *delta_cols)
    if mode != "fanout":
        raise ValueError("mode must be 'unique' or 'fanout'")
    out = rows
    for b in vs:
        sub = rows.where(F.col("prompt_version") == F.lit(b)).select(
            F.col("question_text").alias("__q"), *[F.col(m).alias(f"__{m}__{b}") for m in metrics])
        out = out.join(sub, F.col("question_text").eqNullSafe(F.col("__q")), "left").drop("__q")
        for m in metrics:
            name = f"{m}_delta_vs_{b}"
            out = out.withColumn(name, bround_stable(F.col(m) - F.col(f"`__{m}__{b}`")))
            delta_cols.append(name)
    return out.select(*ids, *delta_cols)


# ------------------------------------------------------------ J4 / J5 / I2 --

def version_reports(rows: DataFrame) -> DataFrame:
    """One report per prompt version (the scores a run of that version gives):
    metric means, missing -> 0, index and grade."""
    r = (rows.groupBy("prompt_version")
         .agg(*[F.coalesce(F.avg(c), F.lit(0.0)).alias(c)
                for c in ("retrieval", "generation", "ragas")]))
    r = r.withColumn("rqi", rqi()).withColumn("grade", grade())
    return r.withColumn("model_name", F.col("prompt_version"))


def attach_scores(rows: DataFrame, reports: DataFrame) -> DataFrame:
    """The version's report copied to every question having that version.
    A plain join: the reports are a row a version, which adaptive execution
    broadcasts by their measured size."""
    keep = [c for c in rows.columns if c not in
            ("grade", "rqi", "ragas", "retrieval", "generation", "model_name")]
    rep = reports.select("prompt_version", "model_name", "retrieval", "generation",
                         "ragas", "rqi", "grade")
    return rows.select(*keep).join(rep, "prompt_version", "left")


def expand_versions(cases: DataFrame, versions: list[str]) -> DataFrame:
    """Every case under every requested version -- a generator over a
    literal array (no join), the version list being a validated parameter."""
    return cases.withColumn("prompt_version",
                            F.explode(F.array(*[F.lit(v) for v in versions])))


def pending_pairs(cases: DataFrame, versions: list[str], existing: DataFrame,
                  key: str = "question_text") -> DataFrame:
    """(case, version) pairs not yet present in ``existing``; one whose
    only answers are errors is still pending."""
    wanted = expand_versions(cases, versions)
    done = existing.where(F.col("error").isNull()) if "error" in existing.columns else existing
    have = done.select(key, "prompt_version")
    return wanted.join(have, [key, "prompt_version"], "left_anti")


def upsert_results(existing: DataFrame, new_rows: DataFrame, version: str,
                   report_row: DataFrame) -> DataFrame:
    """Keep every existing entry, add the new (question, version) entries,
    and overwrite the scores of ``version`` on all its questions with the
    report of the run just made."""
    cols = IDENTITY_COLS
    add = new_rows.join(existing.select("question_text", "prompt_version"),
                        ["question_text", "prompt_version"], "left_anti")
    allrows = (existing.select(*cols).withColumn("state", F.lit("kept"))
               .unionByName(add.select(*cols).withColumn("state", F.lit("added"))))
    other = allrows.where(F.col("prompt_version") != F.lit(version))
    this = attach_scores(allrows.where(F.col("prompt_version") == F.lit(version)), report_row)
    return other.unionByName(this.select(*cols, "state"))


# -------------------------------------------------------------- J6 / M11 --

def baseline_pairs(responses: DataFrame, baseline: str = BASELINE_VERSION,
                   key: str = "question_text") -> DataFrame:
    """Every non-baseline answer paired with the baseline answer of the
    same question (inner: no baseline, no pair)."""
    base = responses.where(F.col("prompt_version") == F.lit(baseline)).select(
        key, F.col("response").alias("base_response"))
    new = responses.where(F.col("prompt_version") != F.lit(baseline))
    return new.join(base, key, "inner")


def answer_diff(responses: DataFrame, baseline: str = BASELINE_VERSION,
                key: str = "question_text") -> DataFrame:
    """J6 + M11 (offline form): how each answer differs from the baseline
    answer of its question -- length change, token Jaccard and the share of
    tokens new to the answer.

    Every response is tokenized once (distinct six-letter-or-longer words) before the
    pairing, so the join moves the narrow token sets, not the answer texts,
    and a baseline text is not re-tokenized for each version paired with it.
    """
    toks = responses.select(key, "prompt_version",
                            F.length("response").cast("bigint").alias("n_chars"),
                            F.array_distinct(lower_tokens("response", KEYWORD_PATTERN)).alias("toks"))
    base = toks.where(F.col("prompt_version") == F.lit(baseline)).select(
        key, F.col("n_chars").alias("base_chars"), F.col("toks").alias("__bt"))
    new = toks.where(F.col("prompt_version") != F.lit(baseline)).select(
        key, "prompt_version", F.col("n_chars").alias("new_chars"), F.col("toks").alias("__nt"))
    df = new.join(base, key, "inner")
    inter = F.size(F.array_intersect("__bt", "__nt")).cast("double")
    union = F.size(F.array_union("__bt", "__nt")).cast("double")
    fresh = F.size(F.array_except("__nt", "__bt")).cast("double")
    return df.select(
        key, "prompt_version", "base_chars", "new_chars",
        (F.col("new_chars") - F.col("base_chars")).alias("len_delta"),
        F.try_divide(inter, F.nullif(union, F.lit(0.0))).alias("jaccard"),
        F.try_divide(fresh, F.nullif(F.size("__nt").cast("double"), F.lit(0.0))).alias("new_token_share"))
