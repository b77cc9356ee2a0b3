"""Commits of result tables: old state or new state, nothing in between."""

import pytest
from pyspark.sql import functions as F

from ragloom.operators import impact
from ragloom.plans import pipelines
from ragloom.sources import snapshots

SCHEMA = "question_text string, prompt_version string, response string, n int"


def _rows(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def _read(spark, root, **kw):
    return sorted((tuple(r) for r in snapshots.read_snapshot(spark, root, SCHEMA, **kw).collect()), key=repr)


KEYS = ["question_text", "prompt_version"]


def test_upsert_adds_replaces_and_keeps(spark, tmp_path):
    root = str(tmp_path / "t")
    assert _read(spark, root) == []
    snapshots.upsert(spark, root, _rows(spark, ("a", "v0", "x", 1), ("b", "v0", "y", 1), ("a", "v1", "z", 1)), KEYS, "prompt_version")
    before = snapshots.manifest(spark, root)
    snapshots.upsert(spark, root, _rows(spark, ("b", "v0", "new", 2), ("c", "v0", "w", 2)), KEYS, "prompt_version")
    after = snapshots.manifest(spark, root)
    assert _read(spark, root) == [("a", "v0", "x", 1), ("a", "v1", "z", 1), ("b", "v0", "new", 2), ("c", "v0", "w", 2)]
    assert after["number"] == before["number"] + 1
    # the part that no row touched is not written again
    assert after["parts"]["v1"] == before["parts"]["v1"] and after["parts"]["v0"] != before["parts"]["v0"]
    assert _read(spark, root, parts=["v1"]) == [("a", "v1", "z", 1)]
    # a state that was read stays readable
    assert _read(spark, root, state=before) == [("a", "v0", "x", 1), ("a", "v1", "z", 1), ("b", "v0", "y", 1)]


def test_repeated_keys_keep_the_last_and_odd_part_values_work(spark, tmp_path):
    root = str(tmp_path / "t")
    rows = _rows(spark, ("a", "v/0 =%", "x", 1), ("a", "v/0 =%", "y", 5), ("a", "v/0 =%", "z", 3), (None, None, "n", 1), (None, None, "m", 0))
    snapshots.upsert(spark, root, rows.repartition(3), KEYS, "prompt_version", order=F.col("n"))
    assert set(_read(spark, root)) == {("a", "v/0 =%", "y", 5), (None, None, "n", 1)}
    state = snapshots.upsert(spark, root, rows.where("false"), KEYS, "prompt_version")
    assert state == snapshots.manifest(spark, root)


def test_failure_between_write_and_switch_leaves_the_old_state(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    snapshots.upsert(spark, root, _rows(spark, ("a", "v0", "x", 1)), KEYS, "prompt_version")
    change = _rows(spark, ("a", "v0", "changed", 2), ("b", "v1", "y", 2))

    def lost(*_):
        raise RuntimeError("driver lost")
    with monkeypatch.context() as m:
        m.setattr(snapshots, "_switch", lost)
        with pytest.raises(RuntimeError, match="driver lost"):
            snapshots.upsert(spark, root, change, KEYS, "prompt_version")
    assert _read(spark, root) == [("a", "v0", "x", 1)]
    snapshots.upsert(spark, root, change, KEYS, "prompt_version")   # the run again
    snapshots.upsert(spark, root, change, KEYS, "prompt_version")   # and once more
    assert _read(spark, root) == [("a", "v0", "changed", 2), ("b", "v1", "y", 2)]


def test_second_commit_from_the_same_state_is_refused(spark, tmp_path):
    root = str(tmp_path / "t")
    state = snapshots.manifest(spark, root)
    snapshots.replace_parts(spark, root, _rows(spark, ("a", "v0", "x", 1)), "prompt_version", state)
    with pytest.raises(snapshots.ConcurrentCommit):
        snapshots.replace_parts(spark, root, _rows(spark, ("b", "v0", "y", 1)), "prompt_version", state)
    assert _read(spark, root) == [("a", "v0", "x", 1)]


# ------------------------------------------------------------- impact run --

def _cases(spark):
    words = ["alpha", "bravo", "charlie", "deltas", "echoes", "foxtrot"]
    docs = spark.createDataFrame([(i, f"{w} passage about {w} matters\nsecond line of {w}", f"s/{w}.pdf") for i, w in enumerate(words)],
                                 "doc_id long, text string, source string")
    vectors = pipelines.create_vectors(pipelines.load_and_chunk(docs, chunker="window")).cache()
    cases = spark.createDataFrame([(i, f"what matters about {w}", [w], f"{w} passage matters") for i, w in enumerate(words[:4])]
                                  + [(9, None, ["x"], "y"), (10, "", [], "")],
                                  "case_id long, query string, expected_keywords array<string>, ground_truth string")
    return cases, vectors


def test_impact_run_end_to_end(spark, tmp_path):
    cases, vectors = _cases(spark)
    root = str(tmp_path / "impact")

    def run(spec, **kw):
        table = pipelines.run_prompt_impact(spark, cases, cases, cases, vectors, spec, root, **kw)
        return {(r["question_text"], r["prompt_version"]): r for r in table.collect()}
    first = run("prompt_v0,prompt_v1")
    assert len(first) == 8
    for (q, v), r in first.items():
        assert r["question_id"] == q and r["model_name"] == v and r["run_order"] == 0
        assert len(r["retrieved_chunks"]) == len(r["retrieved_metadata"]) == 3
        assert r["retrieved_metadata"][0]["source"].endswith(".pdf")
        assert 0 <= r["rqi"] <= 1 and r["retrieval"] == 1.0 and r["grade"]
        assert (r["change_summary"] is not None) == (v != "prompt_v0")
    assert run("prompt_v0,prompt_v1") == first                      # twice is once
    assert snapshots.manifest(spark, root)["number"] == 1
    v0_folder = snapshots.manifest(spark, root)["parts"]["prompt_v0"]
    third = run("prompt_v3")
    assert len(third) == 12 and {k: r for k, r in third.items() if k[1] != "prompt_v3"} == first
    assert all(r["change_summary"] for k, r in third.items() if k[1] == "prompt_v3")
    assert snapshots.manifest(spark, root)["parts"]["prompt_v0"] == v0_folder
    nested = impact.flatten_impact(impact.nest_impact(snapshots.read_snapshot(spark, root, pipelines.IMPACT_SCHEMA)))
    assert nested.count() == 12
    with pytest.raises(ValueError):
        run("prompt_v9")


def test_failed_answers_stay_pending_and_join_later(spark, tmp_path):
    cases, vectors = _cases(spark)
    root = str(tmp_path / "impact")

    def broken():
        def gen(q, c, s):
            if "bravo" in q:
                raise ValueError("model failure")
            return c
        return gen
    table = pipelines.run_prompt_impact(spark, cases, cases, cases, vectors, "prompt_v0", root, make_generator=broken)
    assert sorted(r["question_text"].split()[-1] for r in table.collect()) == ["alpha", "charlie", "deltas"]
    table = pipelines.run_prompt_impact(spark, cases, cases, cases, vectors, "prompt_v0", root)
    got = {r["question_text"].split()[-1]: r["run_order"] for r in table.collect()}
    assert got == {"alpha": 0, "charlie": 0, "deltas": 0, "bravo": 1}


def test_embedder_and_k_reach_every_search(spark, tmp_path):
    """A plug-in embedder of three dimensions: any search that used the
    default one would mix two spaces and fail."""
    cases, _ = _cases(spark)
    docs = spark.createDataFrame([(i, t, "s") for i, t in enumerate(["aaa", "bbbbbb", "c", "dd ddd"])], "doc_id long, text string, source string")
    calls = []

    def embed(df, text, out):
        calls.append(text)
        n = F.length(F.coalesce(F.col(text), F.lit(""))).cast("float")
        return df.withColumn(out, F.array(n, n * 2, F.lit(1.0).cast("float")))
    vectors = pipelines.create_vectors(pipelines.load_and_chunk(docs, chunker="window"), embed)
    table = pipelines.run_prompt_impact(spark, cases, cases, cases, vectors, "prompt_v0", str(tmp_path / "i"), k=2, embed=embed)
    assert all(len(r["retrieved_chunks"]) == 2 for r in table.collect())
    assert len(calls) >= 4
    rep = pipelines.run_suite(cases, cases, cases, vectors, k=2, embed=embed)
    assert rep.count() == 1


def test_header_values_are_bounded(spark, monkeypatch):
    df = spark.createDataFrame([(f"v{i}",) for i in range(5)], "prompt_version string")
    assert impact.distinct_versions(df) == [f"v{i}" for i in range(5)]
    monkeypatch.setattr(impact, "MAX_HEADER", 4)
    with pytest.raises(ValueError, match="more than 4"):
        impact.distinct_versions(df)
