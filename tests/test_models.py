"""Plug-in models: retry by rounds, judged batches, regenerated questions."""

import json
import os
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from ragloom.operators import generation, judge, metrics, prompts
from ragloom.plans import pipelines


# the plug-ins below use this module's helpers inside tasks
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _log(path, **what):
    with open(path, "a") as f:
        f.write(json.dumps(what) + "\n")


def _logged(path):
    if not os.path.exists(path):
        return []
    with open(path) as f:
        return [json.loads(line) for line in f]


def _questions(spark, n=12):
    return spark.createDataFrame([(i, f"q{i}", f"ctx {i}") for i in range(n)], "case_id long, query string, context string").repartition(3)


# ------------------------------------------------------------- M9 / M10 --

def test_limited_rows_are_asked_again_in_later_rounds(spark, tmp_path):
    log, waits = str(tmp_path / "calls"), []

    def make():
        def gen(q, c, s):
            before = sum(1 for x in _logged(log) if x["q"] == q)
            _log(log, q=q)
            if q in ("q3", "q7") and before < 2:
                raise RuntimeError("HTTP 429 Too Many Requests")
            if q == "q5":
                raise ValueError("bad request")
            return f"answer of {q}"
        return gen
    out = generation.generate_answers(_questions(spark), make, sleep=waits.append)
    rows = {r["query"]: r for r in out.collect()}
    assert len(rows) == 12
    assert rows["q3"]["answer"] == "answer of q3" and rows["q7"]["error"] is None
    assert rows["q5"]["answer"] is None and "bad request" in rows["q5"]["error"]
    calls = [x["q"] for x in _logged(log)]
    assert {q: calls.count(q) for q in rows} == {q: 3 if q in ("q3", "q7") else 1 for q in rows}
    assert waits == [80, 100]          # on the driver, once a round, not per row
    assert [r["query"] for r in generation.failures(out).collect()] == ["q5"]
    assert generation.answered(out).count() == 11
    assert calls == [x["q"] for x in _logged(log)]    # reading the result calls no model


def test_rows_that_stay_limited_become_errors(spark):
    waits = []

    def make():
        def gen(q, c, s):
            if q == "q1":
                raise RuntimeError("Quota exceeded")
            return "ok"
        return gen
    out = generation.generate_answers(_questions(spark, 3), make, sleep=waits.append)
    rows = {r["query"]: r for r in out.collect()}
    assert rows["q1"]["answer"] is None and "gave up after 5 retries" in rows["q1"]["error"] and "Quota" in rows["q1"]["error"]
    assert rows["q0"]["answer"] == "ok" and waits == [80, 100, 120, 140]
    assert generation.generate_answers(_questions(spark, 3).where("false"), make).count() == 0


def test_batched_generator_gets_bounded_calls(spark, tmp_path, monkeypatch):
    log = str(tmp_path / "calls")
    monkeypatch.setattr(generation, "CALL_ROWS", 5)

    def make():
        def gen(qs, cs, ss):
            _log(log, n=len(qs))
            return [ValueError("odd") if q == "q4" else q.upper() for q in qs]
        return generation.takes_batches(gen)
    out = generation.generate_answers(_questions(spark).coalesce(1), make)
    rows = {r["query"]: r for r in out.collect()}
    assert rows["q2"]["answer"] == "Q2" and "odd" in rows["q4"]["error"]
    sizes = [x["n"] for x in _logged(log)]
    assert sum(sizes) == 12 and max(sizes) <= 5 and len(sizes) == 3


def test_call_batches_hold_rows_and_characters(monkeypatch):
    monkeypatch.setattr(generation, "CALL_CHARS", 10)
    monkeypatch.setattr(generation, "CALL_ROWS", 3)
    assert list(generation.call_batches([4, 4, 4, 30, 1, 1, 1, 1])) == [(0, 2), (2, 3), (3, 4), (4, 7), (7, 8)]
    assert list(generation.call_batches([])) == []


def test_extractive_column_equals_the_plug_in(spark):
    rows = [("Où est la clé été?", "  la clé est ici\n\nété hiver\t\nrien\nla porte été clé"), ("x", ""), (None, "a\nb"), ("q", None),
            ("one two three", "three\ntwo\none\nfour two three one\nthree")]
    df = spark.createDataFrame(rows, "query string, context string")
    native = [r["answer"] for r in generation.generate_answers(df).collect()]
    plug_in = [r["answer"] for r in generation.generate_answers(df, generation.extractive_generator).collect()]
    gen = generation.extractive_generator()
    assert native == [gen(q, c, None) for q, c in rows]
    assert sorted(native) == sorted(plug_in)


# ------------------------------------------------------------- M3 - M7 --

def _answers(spark):
    ctx = [(1, "c1", "s", 0, "Gravity bends light strongly"), (2, "c2", "s", 1, "nothing here")]
    rows = [(1, "gravity question", "gravity bends things", "light strongly bends", ctx, None),
            (2, "other question", None, "nothing", ctx, "ValueError: x"),
            (3, "third question", "unrelated planets", None, [], None)]
    return spark.createDataFrame(rows, "case_id long, query string, answer string, ground_truth string, "
                                       "contexts array<struct<rank:int,chunk_id:string,source:string,page:int,text:string>>, error string")


def test_failed_answers_are_scored_by_no_metric(spark):
    got = {r["case_id"]: r for r in pipelines.judged_metrics(_answers(spark)).collect()}
    assert set(got) == {1, 3}
    assert got[1]["faithfulness"] == 0.5           # gravity; things is not in the contexts
    assert got[1]["context_recall"] == 1.0 and got[1]["context_precision"] == pytest.approx(1.0)
    assert got[3]["faithfulness"] == 0.0 and got[3]["context_recall"] is None and got[3]["context_precision"] is None


def test_failures_are_counted_beside_the_mean(spark):
    docs = spark.createDataFrame([(1, "gravity bends light", "s"), (2, "planets orbit", "s")], "doc_id long, text string, source string")
    vectors = pipelines.create_vectors(pipelines.load_and_chunk(docs, chunker="window"))
    cases = spark.createDataFrame([(1, "gravity", "gravity bends"), (2, "planets", "planets orbit"), (3, None, "x")],
                                  "case_id long, query string, ground_truth string")

    def make():
        def gen(q, c, s):
            if q == "planets":
                raise ValueError("no")
            return "gravity bends everything"
        return gen
    table, mean = pipelines.evaluate_judged(cases, vectors, make_generator=make)
    rows = {r["case_id"]: r for r in table.collect()}
    assert rows[2]["faithfulness"] is None and rows[2]["answer_relevancy"] is None and rows[2]["context_precision"] is None
    one = mean.first()
    assert (one["n_samples"], one["n_failed"]) == (2, 1)
    scored = [rows[1][m] for m in metrics.METRICS]
    assert one["ragas"] == pytest.approx(sum(scored) / 4)


def test_batched_judge_gets_statements_of_many_samples(spark, tmp_path):
    log = str(tmp_path / "calls")

    def make():
        def decide(statements, contexts):
            _log(log, n=len(statements))
            return [int(s in c.lower()) for s, c in zip(statements, contexts)]
        return generation.takes_batches(decide)
    rows = [(i, ["gravity", "absent", "light"][: i % 4], f"gravity and light {i}") for i in range(20)] + [(99, None, None)]
    df = spark.createDataFrame(rows, "case_id long, statements array<string>, context string").coalesce(1)
    batched = {r["case_id"]: list(r["verdicts"]) for r in judge.judge_samples(df, make).collect()}
    single = {r["case_id"]: list(r["verdicts"]) for r in judge.judge_samples(df, judge.lexical_judge).collect()}
    assert batched == single and batched[3] == [1, 0, 1] and batched[99] == []
    assert [x["n"] for x in _logged(log)] == [sum(len(r[1] or []) for r in rows)]     # one call


def test_judge_decides_contexts_too(spark):
    seen = pipelines.judged_metrics(_answers(spark), make_judge=lambda: (lambda st, ctx: [int("nothing" in ctx) for _ in st]))
    got = {r["case_id"]: r for r in seen.collect()}
    assert got[1]["context_precision"] == pytest.approx(0.5)     # the second of two contexts
    lexical = {r["case_id"]: r["context_precision"] for r in pipelines.judged_metrics(_answers(spark)).collect()}
    assert lexical[1] == pytest.approx(1.0)


def test_relevancy_of_regenerated_questions(spark):
    rows = [(1, "aa", "first"), (2, "bb", "evasive"), (3, "cc", "none"), (4, "aa", "far")]
    df = spark.createDataFrame(rows, "case_id long, query string, answer string")

    def make():
        def ask(answers):
            known = {"first": (["aa", "ab"], False), "evasive": (["bb"], True), "none": ([], False), "far": (["bb"], False)}
            return [known[a] for a in answers]
        return generation.takes_batches(ask)

    def embed(d, text, out):
        count = lambda ch: (F.length(text) - F.length(F.replace(F.col(text), F.lit(ch), F.lit("")))).cast("float")
        return d.withColumn(out, F.array(count("a"), count("b"), count("c")))
    got = {r["case_id"]: r["answer_relevancy"] for r in metrics.regenerated_relevancy(df, make, embed).collect()}
    assert got[1] == pytest.approx((1 + 0.5 ** 0.5) / 2)
    assert got[2] == 0.0 and got[3] == 0.0 and got[4] == 0.0
    assert metrics.regenerated_relevancy(df.where("false"), make, embed).count() == 0


# ------------------------------------------------------------------ P10 --

def test_prompt_and_version_are_resolved_together(spark):
    resolve = prompts.resolve_run
    assert resolve(spark) == (None, "prompt_v0")
    assert resolve(spark, "be brief", "prompt_v3") == ("be brief", "prompt_v3")
    spark.conf.set(prompts.PROMPT_SETTING, "from the run")
    spark.conf.set(prompts.VERSION_SETTING, "prompt_v2")
    try:
        assert resolve(spark) == ("from the run", "prompt_v2")
        assert resolve(spark, "explicit", "prompt_v1") == ("explicit", "prompt_v1")
        cases = spark.createDataFrame([(1, "gravity", ["x"])], "case_id long, query string, expected_keywords array<string>")
        docs = spark.createDataFrame([(1, "gravity", "s")], "doc_id long, text string, source string")
        vectors = pipelines.create_vectors(pipelines.load_and_chunk(docs, chunker="window"))
        row = pipelines.answer_cases(cases, vectors).first()
        assert (row["system_prompt"], row["prompt_version"]) == ("from the run", "prompt_v2")
    finally:
        spark.conf.unset(prompts.PROMPT_SETTING)
        spark.conf.unset(prompts.VERSION_SETTING)
