"""Cross-run analysis (X1-X4) over a table of run reports.

A run report is one row per (model, run_no); the windows below are
partitioned by model over those report rows, so a partition holds the runs of
one model, not data rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ragloom.functions.scoring import grade, rqi
from ragloom.operators.impact import header_values

QUALITY_GATE = 0.7   # fixed value: an index below 0.7 blocks a release


def run_reports(history: DataFrame) -> DataFrame:
    """(model, run_no, retrieval, generation, ragas) -> + rqi, grade
    (a missing score counts 0, as in the single-run report)."""
    h = history
    for m in ("retrieval", "generation", "ragas"):
        h = h.withColumn(m, F.coalesce(F.col(m), F.lit(0.0)))
    return h.withColumn("rqi", rqi()).withColumn("grade", grade())


def run_average(reports: DataFrame) -> DataFrame:
    """Mean, sample standard deviation and number of runs per model."""
    return reports.groupBy("model").agg(
        F.avg("rqi").alias("rqi_mean"),
        F.stddev_samp("rqi").alias("rqi_std"),
        F.count(F.lit(1)).alias("n_runs"))


def run_compare(reports: DataFrame, models: list[str] | None = None) -> DataFrame:
    """The models side by side per run number (a pivot, not a pair join)."""
    ms = models if models is not None else header_values(reports, "model")
    return reports.groupBy("run_no").pivot("model", ms).agg(F.max("rqi"))


def quality_gate(reports: DataFrame, threshold: float = QUALITY_GATE) -> DataFrame:
    """A run passes when its index reaches the threshold."""
    return reports.select("model", "run_no", "rqi", "grade",
                          (F.col("rqi") >= F.lit(threshold)).alias("passed"))


def quality_trend(reports: DataFrame, window: int = 3) -> DataFrame:
    """Change against the previous run and a moving mean per model."""
    w = Window.partitionBy("model").orderBy("run_no")
    return reports.select(
        "model", "run_no", "rqi",
        F.lag("rqi").over(w).alias("prev_rqi"),
        (F.col("rqi") - F.lag("rqi").over(w)).alias("rqi_change"),
        F.avg("rqi").over(w.rowsBetween(-(window - 1), 0)).alias("rqi_moving_avg"))
