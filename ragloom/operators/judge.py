"""Verdict production (M7) behind a plug-in protocol.

The default judge is lexical and runs inside the JVM (see
:func:`ragloom.operators.metrics.statement_support`).  A model judge plugs in
here: ``make_judge()`` runs once per Python task and returns
``(statements: list[str], context: str) -> list[int]`` (1 = supported), or,
marked with :func:`ragloom.operators.generation.takes_batches`,
``(statements: list[str], contexts: list[str]) -> list[int]`` over the
statements of many samples at once.

A sample travels as one row, its statements as an array next to their context,
so a context is shipped once per sample.  The statements of an Arrow batch are
laid end to end, handed to a batched judge in calls of bounded size, and their
verdicts go back to the samples by position.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from ragloom.functions.text import KEYWORD_PATTERN, lower_tokens
from ragloom.operators.generation import call_batches


def lexical_judge():
    """The default verdict as a Python plug-in (same rule as the JVM path)."""
    def judge(statements: list[str], context: str) -> list[int]:
        ctx = (context or "").lower()
        return [int(s in ctx) for s in statements]
    return judge


def _verdicts(judge, statements: list[list], contexts: list) -> list[list[int]]:
    if not getattr(judge, "batch", False):
        return [[int(v) for v in judge(st, ctx)] for st, ctx in zip(statements, contexts, strict=True)]
    flat = [s for st in statements for s in st]
    of = [ctx or "" for st, ctx in zip(statements, contexts, strict=True) for _ in st]
    got: list[int] = []
    for a, b in call_batches([len(s) + len(c) for s, c in zip(flat, of, strict=True)]):
        part = [int(v) for v in judge(flat[a:b], of[a:b])]
        if len(part) != b - a:
            raise ValueError(f"{len(part)} verdicts for {b - a} statements")
        got += part
    out, at = [], 0
    for st in statements:
        out.append(got[at:at + len(st)])
        at += len(st)
    return out


def judge_samples(samples: DataFrame, make_judge: Callable = lexical_judge,
                  statements: str = "statements", context: str = "context") -> DataFrame:
    """Adds ``verdicts ARRAY<INT>`` aligned with ``statements``."""
    schema = StructType(list(samples.schema.fields) + [StructField("verdicts", ArrayType(IntegerType()))])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        judge = make_judge()
        for pdf in batches:
            lists = [list(st) if st is not None else [] for st in pdf[statements]]
            pdf["verdicts"] = _verdicts(judge, lists, list(pdf[context]))
            yield pdf
    return samples.mapInPandas(run, schema)


def judge_contexts(contexts: DataFrame, make_judge: Callable, reference: str = "reference", text: str = "text") -> DataFrame:
    """M7 for M3: whether each ranked context (one row) supports a statement
    of the reference; the rows with ``verdict`` 0 / 1."""
    judged = judge_samples(statements_of(contexts, reference, "__statements"), make_judge, "__statements", text)
    return judged.withColumn("verdict", F.exists("verdicts", lambda v: v > 0).cast("int")).drop("__statements", "verdicts")


def statements_of(df: DataFrame, text: str, out: str = "statements") -> DataFrame:
    """Statements of a text: its six-letter-or-longer words (offline decomposition)."""
    return df.withColumn(out, lower_tokens(text, KEYWORD_PATTERN))


def verdict_share(judged: DataFrame, out: str) -> DataFrame:
    """M4 / M5 from verdict arrays: supported share, null without statements."""
    n = F.size("verdicts")
    hit = F.aggregate("verdicts", F.lit(0), lambda a, v: a + v)
    return judged.withColumn(out, F.when(n > 0, hit.cast("double") / n.cast("double")))
