"""The registered queries without a SQL form, checked against brute force on
the small tables or by their invariants."""

import numpy as np
from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SF001
from ragloom.operators import embedding, generation, prompts
from ragloom.plans import derived, queries


def test_pca_points_equal_numpy(spark):
    """Spark ML PCA points = the vectors projected on the two leading
    eigenvectors of their covariance, each axis signed so that its largest
    loading is positive."""
    corpus = derived.vec_corpus(spark, SF001).withColumn("source", F.lit("s"))
    pts = {r["corpus_id"]: (r["x"], r["y"]) for r in embedding.pca_points(corpus).collect()}
    rows = sorted(corpus.select("corpus_id", "embedding").collect())
    ids = [r[0] for r in rows]
    x = np.array([r[1] for r in rows], dtype=np.float64)
    vals, vecs = np.linalg.eigh(np.cov(x, rowvar=False))
    pc = vecs[:, np.argsort(vals)[::-1][:2]]
    pc = pc * np.sign(pc[np.abs(pc).argmax(axis=0), [0, 1]])
    want = x @ pc                                   # the model projects the vectors as they are
    got = np.array([pts[i] for i in ids])
    assert np.allclose(got, want, atol=1e-6)
    assert entry.queries()["pca_points"](spark, SF001).count() == len(ids)


def test_text_retrieval_equals_brute_force(spark):
    """E2 + R1: questions and chunks embedded with the same hashed model; the
    top 3 chunks by squared L2 (ties by chunk number) equal a numpy scan."""
    got = sorted((r["case_id"], r["rank"], r["chunk_no"], r["distance"])
                 for r in entry.queries()["text_retrieval"](spark, SF001).collect())
    qs = embedding.hashed_embedding(derived.qa_cases(spark, SF001).select(
        F.col("case_id"), F.col("query").alias("text"))).collect()
    cs = queries._window_chunks(spark, SF001).select("chunk_no", "text")
    cs = sorted(embedding.hashed_embedding(cs).select("chunk_no", "embedding").collect())
    cid = np.array([r[0] for r in cs])
    cm = np.array([r[1] for r in cs], dtype=np.float64)
    want = []
    for q in qs:
        d = ((cm - np.asarray(q["embedding"], dtype=np.float64)) ** 2).sum(axis=1)
        order = np.lexsort((cid, d))[:3]
        want += [(q["case_id"], rank + 1, int(cid[j]), round(float(d[j]), 6)) for rank, j in enumerate(order)]
    assert [g[:3] for g in got] == [w[:3] for w in sorted(want)]
    assert np.allclose([g[3] for g in got], [w[3] for w in sorted(want)], atol=1e-6)


def test_extractive_answers_one_per_case_and_version(spark):
    """M8: every case with a query is answered under every prompt version,
    without errors."""
    out = entry.queries()["extractive_answers"](spark, SF001)
    n_cases = derived.keyword_cases(spark, SF001).where(F.length("query") > 0).count()
    rows = out.collect()
    assert len(rows) == n_cases * len(prompts.PROMPT_VERSIONS)
    assert len({(r["case_id"], r["prompt_version"]) for r in rows}) == len(rows)
    assert all(r["error"] is None and r["answer_chars"] > 0 for r in rows)


def test_extractive_generator_takes_best_context_lines():
    gen = generation.extractive_generator()
    ctx = "alpha beta gamma\nnothing here\nbeta gamma delta\nzeta\ngamma only"
    ans = gen("beta gamma delta?", ctx, None)
    # the three best lines by shared words, in context order
    assert ans == "alpha beta gamma beta gamma delta gamma only"
    assert gen("anything", "", None) == "I don't know."
