"""Prompt catalogue, validation, resolution and rendering.

The catalogue is a five-row table; joining it is a broadcast of a table whose
size is fixed by the catalogue, never by the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The reference's prompt catalogue, version -> system prompt.
PROMPT_VERSIONS = {
    "prompt_v0": "You are a helpful assistant. Answer the user’s question clearly and concisely.",
    "prompt_v1": ("You are a helpful assistant.\n"
                  "Answer the user’s question clearly, using well-structured sentences.\n"
                  "Prefer concise explanations, but include key details when helpful."),
    "prompt_v2": ("You are a factual assistant.\n"
                  "Answer the question using only the information provided in the retrieved context.\n"
                  "If the context is insufficient, say that explicitly instead of guessing."),
    "prompt_v3": ("You are an expert assistant.\n"
                  "First, reason internally about what information from the retrieved context is relevant.\n"
                  "Then provide a complete, well-explained answer grounded in that context.\n"
                  "Avoid speculation and unsupported claims."),
    "prompt_v4": ("You are an expert, evaluation-aware assistant.\n\n"
                  "Instructions:\n"
                  "- Ground every claim strictly in the retrieved context\n"
                  "- Be complete but avoid unnecessary verbosity\n"
                  "- Do not introduce external knowledge\n"
                  "- If multiple interpretations exist, state them clearly\n"
                  "- If the context is insufficient, say that explicitly\n\n"
                  "Produce a clear, faithful, and well-structured answer."),
}
DEFAULT_VERSION = "prompt_v0"

# Our human-message template (context first, then the question).
HUMAN_PREFIX = "Use nothing but these passages for your answer.\n"
QUESTION_PREFIX = "\n\nQuestion: "
CONTEXT_SEPARATOR = "\n\n"


def catalogue(spark: SparkSession, versions: dict | None = None) -> DataFrame:
    v = versions or PROMPT_VERSIONS
    return spark.createDataFrame(sorted(v.items()), "prompt_version string, system_prompt string")


def parse_versions(spec: str) -> list[str]:
    """P11 part 1: comma list, trimmed, empty items dropped, order kept."""
    return [s.strip() for s in spec.split(",") if s.strip()]


def validate_versions(spark: SparkSession, spec: str, versions: dict | None = None) -> list[str]:
    """An unknown version aborts the run (left-anti join to the catalogue)."""
    wanted = parse_versions(spec)
    req = spark.createDataFrame([(w,) for w in wanted], "prompt_version string")
    unknown = [r[0] for r in req.join(catalogue(spark, versions), "prompt_version", "left_anti").collect()]
    if unknown:
        known = sorted((versions or PROMPT_VERSIONS).keys())
        raise ValueError(f"Unknown prompt version(s) {unknown}; available: {known}")
    return wanted


def resolve_prompt(explicit: Column | None = None, run_conf: Column | None = None,
                   default: str | None = None) -> Column:
    """P10 on a table: explicit argument, else the run configuration, else the
    default."""
    parts = [c for c in (explicit, run_conf) if c is not None]
    return F.coalesce(*parts, F.lit(default)) if parts else F.lit(default)


# Session settings of a run (the reference takes them from its environment).
PROMPT_SETTING = "ragloom.systemPrompt"
VERSION_SETTING = "ragloom.promptVersion"


def resolve_run(spark: SparkSession, system_prompt: str | None = None,
                prompt_version: str = DEFAULT_VERSION) -> tuple[str | None, str]:
    """P10 for a run: system prompt and version together.  A prompt given as an argument
    comes with the argument's version; else both come from the run's settings
    (a setting that is absent leaves the default: no system prompt, and the
    argument's version)."""
    if system_prompt is not None:
        return system_prompt or None, prompt_version
    return spark.conf.get(PROMPT_SETTING, None) or None, spark.conf.get(VERSION_SETTING, None) or prompt_version


def format_context(hits_with_text: DataFrame, key: str = "query_id") -> DataFrame:
    """Chunk texts in rank order joined by a blank line (one row per
    query; a group is the k hits of one query)."""
    return (hits_with_text.groupBy(key)
            .agg(F.array_sort(F.collect_list(F.struct("rank", F.coalesce("text", F.lit("")).alias("t"))))
                 .alias("__r"))
            .select(key, F.array_join(F.transform("__r", lambda s: s["t"]), CONTEXT_SEPARATOR)
                    .alias("context")))


def render_prompt(cases: DataFrame, prompts: DataFrame) -> DataFrame:
    """P9 + J7: (case, prompt_version, query, context) -> rendered prompt.

    With a system prompt: system message, blank line, human message; without
    one (a version missing from the catalogue): the human message alone.
    The catalogue is broadcast (its size is the catalogue's, not the data's).
    """
    j = cases.join(F.broadcast(prompts), "prompt_version", "left")
    human = F.concat(F.lit(HUMAN_PREFIX), F.coalesce(F.col("context"), F.lit("")),
                     F.lit(QUESTION_PREFIX), F.coalesce(F.col("query"), F.lit("")))
    return j.withColumn(
        "prompt",
        F.when(F.col("system_prompt").isNull(), human)
         .otherwise(F.concat(F.col("system_prompt"), F.lit("\n\n"), human)))
