"""Run reports (S5, Q1-Q5): scores -> weighted index -> grade -> rule codes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ragloom.functions.scoring import WEIGHTS, grade, justification_codes, rqi

SCORE_METRICS = ("retrieval", "generation", "ragas")


def scores_wide(scores_long: DataFrame, run: str = "run") -> DataFrame:
    """Long (run, metric, value) -> one row per run; a missing metric of a
    run is 0.0 (the reference's default for a missing score file or key).
    Partial aggregation keeps a run with very many score rows cheap."""
    aggs = [F.coalesce(F.max(F.when(F.col("metric") == m, F.col("value"))), F.lit(0.0)).alias(m)
            for m in SCORE_METRICS]
    return scores_long.groupBy(F.col(run).alias("model_name")).agg(*aggs)


def report(scores: DataFrame, weights: dict | None = None) -> DataFrame:
    """Q1, Q2, Q4: (model_name, retrieval, generation, ragas) -> + rqi, grade."""
    w = weights or WEIGHTS
    return (scores.withColumn("rqi", rqi("retrieval", "generation", "ragas", w))
            .withColumn("grade", grade("rqi")))


def with_justification(rep: DataFrame, sep: str = "\n") -> DataFrame:
    """Q3: rule codes of the report, in the reference's order."""
    return rep.withColumn("justification",
                          justification_codes("retrieval", "generation", "ragas", sep))


def console_report(rep: DataFrame, weights: dict | None = None) -> DataFrame:
    """Q5: scores with two decimals, next to their weights in the index."""
    w = weights or WEIGHTS
    return rep.select(
        "model_name",
        *[F.format_number(F.lit(float(w[m])), 2).alias(f"{m}_weight") for m in SCORE_METRICS],
        F.format_number("retrieval", 2).alias("retrieval_txt"),
        F.format_number("generation", 2).alias("generation_txt"),
        F.format_number("ragas", 2).alias("ragas_txt"),
        F.format_number("rqi", 2).alias("rqi_txt"),
        "grade")


def single_run_report(retrieval: DataFrame, generation: DataFrame, judged: DataFrame,
                      name: str = "default") -> DataFrame:
    """Assemble one report row from three one-row score frames without a
    join: the three scalars are unioned as long rows and pivoted (S5)."""
    long = (retrieval.select(F.lit("retrieval").alias("metric"), F.col("score").alias("value"))
            .unionByName(generation.select(F.lit("generation").alias("metric"),
                                           F.col("score").alias("value")))
            .unionByName(judged.select(F.lit("ragas").alias("metric"),
                                       F.col("ragas").alias("value")))
            .withColumn("run", F.lit(name)))
    return with_justification(report(scores_wide(long)))
