"""Sources and sinks: round-trips and the reference's loading rules."""

import json

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from ragloom.operators import chunking, impact, report
from ragloom.plans import derived
from ragloom.sources import io


def test_chunk_jsonl_roundtrip_and_failfast(spark, tmp_path):
    ch = chunking.window_chunks(derived.documents(spark, SF001))
    p = str(tmp_path / "chunks")
    io.write_chunks(ch, p)
    back = io.read_chunks(spark, p)
    assert back.count() == ch.count()
    assert back.exceptAll(ch.select("chunk_id", "text", "source", "page")).count() == 0
    bad = tmp_path / "bad.jsonl"
    bad.write_text('{"chunk_id": "c1", "text": "ok", "source": "s", "page": 0}\n{"chunk_id": "c2"}\n')
    with pytest.raises(Exception, match="missing 'text'"):
        io.read_chunks(spark, str(bad)).collect()
    broken = tmp_path / "broken.jsonl"
    broken.write_text('{"chunk_id": "c1", "text": "ok"\n')
    with pytest.raises(Exception):
        io.read_chunks(spark, str(broken)).collect()


def test_case_file_with_wrong_shaped_item(spark, tmp_path):
    items = [{"query": "q1", "expected_keywords": ["a", "b"]},
             {"generation_cases": [{"query": "nested", "expected_keywords": ["x"]}]},
             {"query": "q3", "expected_keywords": []}]
    f = tmp_path / "test_retrieval_synthetic.json"
    f.write_text(json.dumps(items))
    cases = io.read_cases(spark, str(f))
    rows = cases.collect()
    assert len(rows) == 3 and sum(r["query"] is None for r in rows) == 1
    assert {r["dataset"] for r in rows} == {"test_retrieval_synthetic"}
    assert io.select_dataset(cases, synthetic=True).count() == 3
    assert io.select_dataset(cases, synthetic=False).count() == 0


def test_score_files_with_missing_file_and_key(spark, tmp_path):
    (tmp_path / "retrieval_score.json").write_text(json.dumps({"retrieval_score": 0.5333333333333333}))
    (tmp_path / "generation_score.json").write_text(json.dumps({"other": 1}))
    long = io.read_score_files(spark, str(tmp_path))
    rep = report.report(report.scores_wide(long)).first()
    assert rep["retrieval"] == 0.5333333333333333
    assert rep["generation"] == 0.0 and rep["ragas"] == 0.0       # missing key, missing file
    empty = io.read_score_files(spark, str(tmp_path / "nothing"))
    assert report.scores_wide(empty).count() == 0
    (tmp_path / "no_scores").mkdir()
    assert io.read_score_files(spark, str(tmp_path / "no_scores")).count() == 0


def test_reports_partitioned_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([("a", 0.1, 0.2, 0.3, 0.19, "F"), ("b", 1.0, 1.0, 1.0, 1.0, "A+")],
                               "model_name string, retrieval double, generation double, ragas double, rqi double, grade string")
    p = str(tmp_path / "reports")
    io.write_reports(df, p)
    io.write_reports(df.where("model_name = 'b'").withColumn("grade", F.lit("A")), p)   # dynamic overwrite
    back = {r["model_name"]: r for r in io.read_reports(spark, p).collect()}
    assert back["a"]["grade"] == "F" and back["b"]["grade"] == "A"
    assert io.read_reports(spark, p, ["a"]).count() == 1


def test_impact_documents_roundtrip(spark, tmp_path):
    rows = derived.impact_rows(spark, SF001).drop("doc_id")
    p = str(tmp_path / "docs")
    io.write_impact_documents(impact.nest_impact(rows), p)
    flat = impact.flatten_impact(io.read_impact_documents(spark, p))
    cols = impact.IDENTITY_COLS
    assert flat.select(*cols).exceptAll(rows.select(*cols)).count() == 0
    assert flat.count() == rows.count()
    io.write_impact(rows, str(tmp_path / "impact"))
    assert io.read_impact(spark, str(tmp_path / "impact"), ["prompt_v0"]).count() == rows.where(
        "prompt_version = 'prompt_v0'").count()


def test_impact_documents_keep_answers_and_summaries(spark, tmp_path):
    want = [("q1", "q1", "v0", "A", 0.9, 0.8, 0.7, 0.6, "m", "an answer\nin \"two\" lines", None),
            ("q1", "q1", "v1", "B", 0.5, None, 0.7, 0.6, "m", "", "shorter"),
            ("q2", "q2", "v0", None, None, None, None, None, None, None, None)]
    cols = [*impact.IDENTITY_COLS, *impact.TEXT_COLS]
    rows = spark.createDataFrame(want, ", ".join(f"{c} {'double' if c in impact.NUMERIC_COLS else 'string'}" for c in cols))
    io.write_impact_documents(impact.nest_impact(rows), str(tmp_path / "docs"))
    back = impact.flatten_impact(io.read_impact_documents(spark, str(tmp_path / "docs"))).select(cols)
    assert sorted(map(tuple, back.collect()), key=lambda r: r[::2][:2]) == want


def test_impact_document_round_trip_of_all_fields(spark, tmp_path):
    cols = [*impact.IDENTITY_COLS, *impact.TEXT_COLS, *impact.CONTEXT_COLS]
    want = [("q1", "q one", "v0", "A", 0.9, 0.8, 0.7, 0.6, "m", "ans", None, ["c1", "c \"2\"\n"], [("k1", "f.pdf", 3), ("k2", None, None)]),
            ("q1", "q one", "v1", "B", 0.5, None, 0.7, 0.6, "m", "", "shorter", [], []),
            ("q2", "q two", "v0", None, None, None, None, None, None, None, None, None, None)]
    types = {**{c: "double" for c in impact.NUMERIC_COLS}, **impact.CONTEXT_COLS}
    rows = spark.createDataFrame(want, ", ".join(f"{c} {types.get(c, 'string')}" for c in cols))
    io.write_impact_documents(impact.nest_impact(rows), str(tmp_path / "docs"))
    back = impact.flatten_impact(io.read_impact_documents(spark, str(tmp_path / "docs"))).select(cols)
    got = sorted((tuple(r) for r in back.collect()), key=lambda r: (r[0], r[2]))
    assert got == want


def test_repeated_entry_of_a_document_keeps_the_last(spark):
    """A repeated (question, version) does not abort; the greatest run order
    counts, whatever the order of the rows; a row without a version is left out."""
    schema = ("question_id string, question_text string, prompt_version string, grade string, rqi double, ragas double, "
              "retrieval double, generation double, model_name string, response string, run_order int")
    rows = [("q", "q", "v0", "A", 0.9, 0.9, 0.9, 0.9, "m", "first", 1), ("q", "q", "v0", "F", 0.1, 0.1, 0.1, 0.1, "m", "last", 7),
            ("q", "q", "v0", "B", 0.7, 0.7, 0.7, 0.7, "m", "middle", 3), ("q", "q", "v1", "C", 0.6, 0.6, 0.6, 0.6, "m", "other", 2),
            ("q", "q", None, "C", 0.6, 0.6, 0.6, 0.6, "m", "none", 9)]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, schema).repartition(3)
        got = {r["prompt_version"]: (r["response"], r["rqi"]) for r in impact.flatten_impact(impact.nest_impact(df)).collect()}
        assert got == {"v0": ("last", 0.1), "v1": ("other", 0.6)}
        # without a run order the result is still the same for any order of rows
        plain = {r["prompt_version"]: r["response"] for r in impact.flatten_impact(impact.nest_impact(df.drop("run_order"))).collect()}
        assert plain == {"v0": "middle", "v1": "other"}


def test_single_file_impact_document(spark, tmp_path):
    doc = {"What is X?": {"question": "What is X?", "prompt_results": {
        "prompt_v0": {"response": "x", "scores": {"rqi": 0.7, "grade": "B", "model_name": "prompt_v0"}},
        "prompt_v1": {"response": "y"}}},
        "Empty": {"question": "Empty", "prompt_results": {}}}
    f = tmp_path / "impact.json"
    f.write_text(json.dumps(doc))
    rows = {r["prompt_version"]: r for r in impact.flatten_impact_document(spark, str(f)).collect()}
    assert set(rows) == {"prompt_v0", "prompt_v1"}
    assert rows["prompt_v0"]["rqi"] == 0.7 and rows["prompt_v1"]["rqi"] is None


def test_judged_csv_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([("q, with comma", ["ctx \"one\"", "two\nlines"], "r", "ref", 0.9999999999, 0.4, None, 0.5)],
                               "user_input string, retrieved_contexts array<string>, response string, reference string, "
                               "context_precision double, context_recall double, faithfulness double, answer_relevancy double")
    p = str(tmp_path / "judged")
    io.write_judged_csv(df, p)
    back = io.read_judged_csv(spark, p).first()
    assert back["user_input"] == "q, with comma"
    assert json.loads(back["retrieved_contexts"]) == ["ctx \"one\"", "two\nlines"]
    assert back["faithfulness"] is None and back["context_precision"] == 0.9999999999


def test_vector_store_roundtrip_and_table_csv(spark, tmp_path):
    v = spark.createDataFrame([("c0", "s", 0, "t", [0.6, 0.8])],
                              "chunk_id string, source string, page bigint, text string, embedding array<float>")
    io.save_vectors(v, str(tmp_path / "vec"), partition_by="source")
    assert io.load_vectors(spark, str(tmp_path / "vec")).count() == 1
    io.write_table(v.drop("embedding"), str(tmp_path / "csv"), fmt="csv")
    back = io.read_table_file(spark, str(tmp_path / "csv"), fmt="csv",
                              schema="chunk_id string, source string, page bigint, text string")
    assert back.first()["page"] == 0


def test_case_tables_and_observed_counts(spark, tmp_path):
    from ragloom.operators import counts, synth
    ch = chunking.window_chunks(derived.documents(spark, SF001)).select("chunk_id", "text")
    kw = synth.tfidf_keywords(ch, carry_text=True)
    flat = synth.flatten_batches(synth.case_batches(kw))
    paths = io.write_case_tables(flat, str(tmp_path))
    assert len(paths) == 3
    n = ch.count()
    for p in paths:
        assert spark.read.json(p).count() == n
    obs_df, obs = counts.observed(ch, "chunks")
    obs_df.write.format("noop").mode("overwrite").save()
    assert obs.get["chunks"] == n


def test_page_text_directory(spark, tmp_path):
    empty = tmp_path / "empty"
    empty.mkdir()
    assert io.read_page_texts(spark, str(empty)).count() == 0
    d = tmp_path / "pages"
    d.mkdir()
    (d / "a.txt").write_text("first page\nline two")
    (d / "b.txt").write_text("second")
    rows = sorted((r["source"].rsplit("/", 1)[-1], r["text"]) for r in io.read_page_texts(spark, str(d)).collect())
    assert rows == [("a.txt", "first page\nline two"), ("b.txt", "second")]


def test_page_files_give_pages_and_an_error_table(spark, tmp_path):
    """One pass over the files: real page numbers, and the damaged file's name
    and error in the second table."""
    d = tmp_path / "pages"
    d.mkdir()
    (d / "a.txt").write_bytes("one é\nmore\ftwo\f\fthree\f".encode())
    (d / "b.txt").write_bytes(b"")
    (d / "c.txt").write_bytes(b"ok \xff\xfe broken")
    (d / "d.pdf").write_bytes(b"not asked for")
    pages, errors = io.read_pages(spark, str(d))
    got = sorted((r["source"].rsplit("/", 1)[-1], r["page"], r["text"]) for r in pages.collect())
    assert got == [("a.txt", 0, "one é\nmore"), ("a.txt", 1, "two"), ("a.txt", 2, ""), ("a.txt", 3, "three")]
    assert [(r["source"].rsplit("/", 1)[-1], r["error"]) for r in errors.collect()] == [("c.txt", "not valid UTF-8")]
    assert io.read_page_texts(spark, str(d)).count() == 4


def test_unreadable_and_overlong_page_files_are_reported(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(io, "MAX_FILE_BYTES", 10)
    d = tmp_path / "pages"
    d.mkdir()
    (d / "a.txt").write_text("short")
    (d / "b.txt").write_text("far too long for a page file")
    pages, errors = io.read_pages(spark, str(d))
    assert [r["text"] for r in pages.collect()] == ["short"]
    assert [(r["source"].rsplit("/", 1)[-1], r["error"]) for r in errors.collect()] == [("b.txt", "longer than a page file may be")]
    missing = io.read_pages(spark, str(tmp_path / "none"))
    assert missing[0].count() == 0 and missing[1].count() == 0


def test_sinks_return_the_rows_they_wrote(spark, tmp_path):
    df = spark.createDataFrame([(f"c{i}", "t", "s", i) for i in range(7)], "chunk_id string, text string, source string, page int")
    assert io.write_chunks(df, str(tmp_path / "chunks")) == 7
    vec = df.withColumn("embedding", F.array(F.lit(1.0)))
    assert io.save_vectors(vec, str(tmp_path / "v")) == 7 and io.save_vectors(vec.where("page < 0"), str(tmp_path / "w")) == 0
    assert sorted(io.write_case_tables({"a": df, "b": df.limit(2)}, str(tmp_path)).values()) == [2, 7]
