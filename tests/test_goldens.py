"""Arithmetic goldens published with the reference's stored runs (values
inlined here; the tests never read the reference at run time)."""

import pytest
from pyspark.sql import functions as F

from ragloom.functions.scoring import grade, rqi
from ragloom.operators import metrics, report

# Stored run reports: retrieval, generation, judged -> index, grade
REPORTS = [
    ("groq_run1", 0.5333333333333333, 0.8666666666666667, 0.45416666666145833, 0.6095833333317708, "C"),
    ("gemini_result", 0.5333333333333333, 0.7, 0.7167414234698958, 0.6383557603743021, "C"),
    ("prompt_v0", 0.5333333333333333, 1.0, 0.7019025493102923, 0.723904098126421, "B"),
    ("prompt_v1", 0.5333333333333333, 1.0, 0.7061027230168938, 0.7251641502384014, "B"),
]

# Judged samples (context_precision, context_recall, faithfulness, answer_relevancy)
JUDGED = [
    (1, 0.0, 0.0, 1.0, 0.8373977617471611),
    (2, 0.99999999995, 0.4, None, 0.9569546259384742),
    (3, 0.9999999999, 1.0, 0.25, 0.6096390774259443),
    (4, 0.9999999999, 0.75, 0.8333333333333334, 0.9658743256309438),
]


def test_weighted_index_and_grade(spark):
    df = spark.createDataFrame([r[:4] for r in REPORTS], "model_name string, retrieval double, generation double, ragas double")
    out = {r["model_name"]: r for r in report.report(df).collect()}
    for name, _, _, _, idx, g in REPORTS:
        assert out[name]["rqi"] == pytest.approx(idx, abs=1e-15)
        assert out[name]["grade"] == g
    assert out["prompt_v1"]["rqi"] == 0.7251641502384014


def test_mean_of_means_skips_blank(spark):
    df = spark.createDataFrame(JUDGED, "sample long, context_precision double, context_recall double, "
                                       "faithfulness double, answer_relevancy double")
    long = metrics.to_metric_long(df, "sample", metrics.METRICS)
    val = metrics.mean_of_means(long).first()["ragas"]
    assert val == pytest.approx(0.7061027230168938, abs=1e-15)


def test_mean_of_means_nan_is_skipped(spark):
    rows = [(1, 1.0), (2, float("nan"))]
    df = spark.createDataFrame(rows, "sample long, faithfulness double")
    long = metrics.to_metric_long(df, "sample", ["faithfulness"])
    assert metrics.mean_of_means(long).first()["ragas"] == 1.0


@pytest.mark.parametrize("verdicts,expected", [
    ([1, 0, 0], 0.9999999999),
    ([1, 1, 0], 0.99999999995),
    ([0, 0, 0], 0.0),
])
def test_context_precision_goldens(spark, verdicts, expected):
    rows = [(1, i + 1, v) for i, v in enumerate(verdicts)]
    df = spark.createDataFrame(rows, "query_id long, rank long, verdict int")
    got = metrics.context_precision(df).first()["context_precision"]
    assert got == pytest.approx(expected, abs=1e-16)


@pytest.mark.parametrize("x,g", [(0.9, "A+"), (0.8999999, "A"), (0.8, "A"), (0.7, "B"), (0.6, "C"),
                                 (0.5, "D"), (0.4999, "F"), (None, None)])
def test_grade_boundaries(spark, x, g):
    df = spark.createDataFrame([(x,)], "rqi double")
    assert df.select(grade("rqi").alias("g")).first()["g"] == g


def test_rqi_weights_are_parameters(spark):
    df = spark.createDataFrame([(1.0, 0.0, 0.0)], "retrieval double, generation double, ragas double")
    w = {"retrieval": 0.5, "generation": 0.25, "ragas": 0.25}
    assert df.select(rqi(weights=w).alias("x")).first()["x"] == 0.5
    assert df.select(F.round(rqi(), 10).alias("x")).first()["x"] == 0.4
