"""Answer generation (M8), rate-limit retry by rounds (M9), error results.

The default answer is extractive and stays in the JVM: the (at most three)
context lines that share the most words with the question, in context order.

A model is a plug-in: ``make_generator()`` runs once per Python task and
returns ``(query, context, system_prompt) -> answer``, or, marked with
:func:`takes_batches`, the same over lists.  A failure of a row becomes its
``error`` (the reference returns an ``{error}`` record) and never kills the job.

Rate limits are waited out between Spark rounds, not inside a task: a round
calls the model once for every row it has, its results are written, and the
rows that were limited are the next round's rows, after one wait on the driver.
No task sleeps, and a lost executor repeats at most one round's calls.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from ragloom.functions.text import lower_tokens
from ragloom.session import cut_lineage

# Fixed values of the reference's retry policy: five attempts; only errors
# mentioning 429, "Rate limit" or "quota" are retried; the wait before retry
# i (0-based) is 20 * (i + 1) + 60 seconds.
MAX_RETRIES = 5
BASE_DELAY = 20
EXTRA_DELAY = 60
MAX_SENTENCES = 3
NO_ANSWER = "I don't know."

# Rows and characters of context that one call of a batched plug-in gets.
CALL_ROWS = 64
CALL_CHARS = 1 << 20

# Words of three letters or more, of any script (of the answer and its lines).
WORD_PATTERN = r"\p{L}{3,}"
_WORD = re.compile(r"[^\W\d_]{3,}")


def takes_batches(call):
    """Mark a plug-in: it takes lists and returns a list, a value or an
    exception for each row."""
    call.batch = True
    return call


def call_batches(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose sizes (characters) and number stay within one call."""
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if i > start and (held + n > CALL_CHARS or i - start >= CALL_ROWS):
            yield start, i
            start, held = i, 0
        held += n
    if start < len(sizes):
        yield start, len(sizes)


def attempt(gen, columns: list[list]) -> list:
    """One call per row, or per batch, of a plug-in: a value or an exception
    for each row."""
    if not getattr(gen, "batch", False):
        out = []
        for row in zip(*columns, strict=True):
            try:
                out.append(gen(*row))
            except Exception as e:  # noqa: BLE001
                out.append(e)
        return out
    out = []
    for a, b in call_batches([sum(len(c[i]) for c in columns if isinstance(c[i], str)) for i in range(len(columns[0]))]):
        try:
            part = list(gen(*[c[a:b] for c in columns]))
            if len(part) != b - a:
                raise ValueError(f"{len(part)} results for {b - a} rows")
        except Exception as e:  # noqa: BLE001
            part = [e] * (b - a)
        out += part
    return out


def is_rate_limited(err: BaseException) -> bool:
    msg = str(err)
    return "429" in msg or "Rate limit" in msg or "quota" in msg.lower()


def with_retry(call: Callable[[], str], sleep: Callable[[float], None] = time.sleep,
               retries: int = MAX_RETRIES) -> tuple[str | None, str | None]:
    """M9: run ``call``; retry rate-limit errors with the reference's back-off.
    Returns (answer, error); other errors are returned as the row's error."""
    for attempt in range(retries):
        try:
            return call(), None
        except Exception as e:  # noqa: BLE001
            if not is_rate_limited(e):
                return None, f"{type(e).__name__}: {e}"
            sleep(BASE_DELAY * (attempt + 1) + EXTRA_DELAY)
    return None, f"still rate limited, gave up after {retries} retries"


def extractive_answer(query: str = "query", context: str = "context") -> Column:
    """The default answer as a column: built-ins only."""
    words = F.array_distinct(F.coalesce(lower_tokens(query, WORD_PATTERN), F.array().cast("array<string>")))
    lines = F.filter(F.transform(F.split(F.coalesce(F.col(context), F.lit("")), "\n"), lambda x: F.btrim(x, F.lit(" \t\r"))),
                     lambda x: F.length(x) > 0)
    scored = F.transform(lines, lambda x, i: F.struct(
        (-F.size(F.array_intersect(words, F.regexp_extract_all(F.lower(x), F.lit(WORD_PATTERN), F.lit(0))))).alias("s"), i.alias("i"), x.alias("x")))
    best = F.slice(F.array_sort(scored), 1, MAX_SENTENCES)  # most shared words first, then the first line
    in_order = F.array_sort(F.transform(best, lambda t: F.struct(t["i"].alias("i"), t["x"].alias("x"))))
    return F.when(F.size(in_order) > 0, F.array_join(F.transform(in_order, lambda t: t["x"]), " ")).otherwise(F.lit(NO_ANSWER))


def extractive_generator():
    """The same as a plug-in."""
    def generate(query: str, context: str, system_prompt: str | None) -> str:
        words = set(_WORD.findall((query or "").lower()))
        lines = [x for x in (ln.strip(" \t\r") for ln in (context or "").split("\n")) if x]
        if not lines:
            return NO_ANSWER
        scored = [(len(words & set(_WORD.findall(ln.lower()))), -i) for i, ln in enumerate(lines)]
        best = sorted(range(len(lines)), key=lambda i: scored[i], reverse=True)[:MAX_SENTENCES]
        return " ".join(lines[i] for i in sorted(best))
    return generate


def _round(df: DataFrame, make_generator: Callable, columns: list[str | None]) -> DataFrame:
    """One call for every row: answer, error, and whether it was limited."""
    schema = StructType([*df.schema.fields, StructField("answer", StringType()), StructField("error", StringType()),
                         StructField("__limited", BooleanType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        gen = make_generator()
        for pdf in batches:
            values = [list(pdf[c]) if c else [None] * len(pdf) for c in columns]
            got = attempt(gen, values)
            failed = [isinstance(g, BaseException) for g in got]
            pdf["answer"] = [None if f else g for g, f in zip(got, failed, strict=True)]
            pdf["error"] = [f"{type(g).__name__}: {g}" if f else None for g, f in zip(got, failed, strict=True)]
            pdf["__limited"] = [f and is_rate_limited(g) for g, f in zip(got, failed, strict=True)]
            yield pdf
    return df.mapInPandas(run, schema)


def generate_answers(df: DataFrame, make_generator: Callable | None = None,
                     query: str = "query", context: str = "context",
                     system_prompt: str = "system_prompt",
                     sleep: Callable[[float], None] = time.sleep, rounds: int = MAX_RETRIES) -> DataFrame:
    """M8 + M9 + M10 over rows (..., query, context, system_prompt): the rows
    with answer and error.  Without a plug-in the answer is extractive; with
    one the rounds run here, and the result is what they have written."""
    if make_generator is None:
        return df.withColumn("answer", extractive_answer(query, context)).withColumn("error", F.lit(None).cast("string"))
    columns = [query, context, system_prompt if system_prompt in df.columns else None]
    out, todo = None, df
    for i in range(rounds):
        got = cut_lineage(_round(todo, make_generator, columns))
        limited = F.col("__limited")
        last = i + 1 == rounds
        done = got if last else got.where(~limited)
        gave_up = F.concat(F.lit(f"still rate limited, gave up after {rounds} retries: "), F.col("error"))
        done = done.withColumn("error", F.when(limited, gave_up).otherwise(F.col("error"))).drop("__limited")
        out = done if out is None else out.unionByName(done)
        if last or got.where(limited).isEmpty():
            return out
        sleep(BASE_DELAY * (i + 1) + EXTRA_DELAY)
        todo = got.where(limited).select(*df.columns)
    return out


def failures(answers: DataFrame) -> DataFrame:
    """The error table: the rows that have an error, without an answer."""
    return answers.where(F.col("error").isNotNull()).drop("answer")


def answered(answers: DataFrame) -> DataFrame:
    """The rows that the judged metrics score; all of them if there is no
    error column."""
    return answers.where(F.col("error").isNull()) if "error" in answers.columns else answers


def result_metadata(results: DataFrame, answer: str = "answer", out: str = "metadata") -> DataFrame:
    """Every field of a result except the answer, as one struct."""
    keep = [c for c in results.columns if c != answer]
    return results.withColumn(out, F.struct(*keep))


# Fixed value: the text recorded when a change summary cannot be produced.
SUMMARY_FAILED = "Comparison failed."


def offline_summariser():
    """Default change summariser (deterministic): states the length change and
    the share of words the new answer shares with the baseline."""
    def summarise(base: str, new: str) -> str:
        b, n = set(_WORD.findall((base or "").lower())), set(_WORD.findall((new or "").lower()))
        shared = len(b & n) / len(b | n) if (b | n) else 1.0
        delta = len(new or "") - len(base or "")
        longer = "longer" if delta > 0 else "shorter" if delta < 0 else "the same length"
        return f"The new answer is {longer} ({delta:+d} characters) and shares {shared:.0%} of its words with the baseline."
    return summarise


def summarise_changes(pairs: DataFrame, make_summariser: Callable = offline_summariser,
                      base: str = "base_response", new: str = "response") -> DataFrame:
    """M11 with a model: one sentence per (answer, baseline answer) pair; a
    failing call records the fixed failure text."""
    schema = StructType(list(pairs.schema.fields) + [StructField("change_summary", StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        summarise = make_summariser()
        for pdf in batches:
            got = attempt(summarise, [list(pdf[base]), list(pdf[new])])
            pdf["change_summary"] = [SUMMARY_FAILED if isinstance(g, BaseException) else g for g in got]
            yield pdf
    return pairs.mapInPandas(run, schema)
