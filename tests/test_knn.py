"""The kNN join equals brute force, on every physical path."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ragloom.operators.retrieval import knn_topk


def _frames(spark, nq=30, nc=400, d=16, seed=3, dup=False):
    rng = np.random.default_rng(seed)
    q = rng.normal(size=(nq, d)).astype(np.float32)
    c = rng.normal(size=(nc, d)).astype(np.float32)
    if dup:
        c[1::2] = c[0::2]       # exact duplicates: ties broken by id
    qdf = spark.createDataFrame([(i, q[i].tolist()) for i in range(nq)], "query_id long, embedding array<float>")
    cdf = spark.createDataFrame([(1000 + j, c[j].tolist()) for j in range(nc)],
                                "corpus_id long, embedding array<float>").repartition(7)
    return q, c, qdf, cdf


def _brute(q, c, k):
    out = {}
    for i in range(len(q)):
        d = ((q[i].astype(np.float64) - c.astype(np.float64)) ** 2).sum(axis=1)
        order = sorted(range(len(c)), key=lambda j: (d[j], j))[:k]
        out[i] = [(1000 + j, d[j]) for j in order]
    return out


@pytest.mark.parametrize("max_bytes", [64 * 1024 * 1024, 512])
@pytest.mark.parametrize("dup", [False, True])
def test_knn_equals_brute_force(spark, max_bytes, dup):
    q, c, qdf, cdf = _frames(spark, dup=dup)
    k = 5
    got = {}
    for r in knn_topk(qdf, cdf, k=k, max_broadcast_bytes=max_bytes).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["corpus_id"], r["distance"]))
    exp = _brute(q, c, k)
    assert set(got) == set(exp)
    for i, lst in got.items():
        lst.sort()
        assert [x[0] for x in lst] == list(range(1, k + 1))
        assert [x[1] for x in lst] == [e[0] for e in exp[i]]
        assert np.allclose([x[2] for x in lst], [e[1] for e in exp[i]], rtol=0, atol=1e-9)


def test_knn_fewer_corpus_rows_than_k(spark):
    q, c, qdf, cdf = _frames(spark, nq=3, nc=2)
    out = knn_topk(qdf, cdf, k=3).collect()
    assert len(out) == 6


@pytest.mark.parametrize("max_bytes", [64 * 1024 * 1024, 512])
def test_leave_one_out_with_carried_columns(spark, max_bytes):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(120, 8)).astype(np.float32)
    x[5] = x[6]                      # an exact copy is still a neighbour; only the same id is skipped
    df = spark.createDataFrame([(i, x[i].tolist(), i % 7, f"d{i}") for i in range(len(x))],
                               "vec_id long, embedding array<float>, label int, tag string")
    q = df.select(F.col("vec_id").alias("query_id"), "embedding")
    c = df.select(F.col("vec_id").alias("corpus_id"), "embedding", "label", "tag").repartition(5)
    out = knn_topk(q, c, k=3, max_broadcast_bytes=max_bytes, carry=("label", "tag"), exclude_self=True).collect()
    got = {}
    for r in out:
        got.setdefault(r["query_id"], []).append((r["rank"], r["corpus_id"], r["label"], r["tag"]))
    xd = x.astype(np.float64)
    for i in range(len(x)):
        d = ((xd[i] - xd) ** 2).sum(axis=1)
        order = [j for j in sorted(range(len(x)), key=lambda j: (d[j], j)) if j != i][:3]
        lst = sorted(got[i])
        assert [t[1] for t in lst] == order
        assert [t[2] for t in lst] == [j % 7 for j in order]
        assert [t[3] for t in lst] == [f"d{j}" for j in order]
    assert sorted(got[5])[0][1] == 6 and sorted(got[6])[0][1] == 5


def test_hub_document_join_is_split_by_adaptive_skew_join(spark):
    """Beyond the broadcast bound, the hits of one hub document (a third of
    all hits) are joined in several tasks, not one."""
    from pyspark.sql import functions as F

    from ragloom.operators.retrieval import fetch_rows

    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            # many partitions, as on a cluster: one third of the rows in one
            # partition is then far above the skew factor times the median
            "spark.sql.shuffle.partitions": "64"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        n = 300_000
        hits = spark.range(n).select(
            F.col("id").alias("query_id"), F.lit(1).cast("bigint").alias("rank"),
            F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 5000).alias("doc_id"))
        docs = spark.range(5000).select(F.col("id").alias("doc_id"),
                                        F.concat(F.lit("doc "), F.col("id").cast("string")).alias("text"))
        out = fetch_rows(hits, docs, "doc_id", ["text"], hit_rows_bound=None)
        got = out.groupBy().agg(F.count("text").alias("n"),
                                F.sum(F.when(F.col("text") == "doc 7", 1).otherwise(0)).alias("hub")).first()
        hub = sum(1 for i in range(n) if i % 3 == 0 or i % 5000 == 7)
        assert got["n"] == n and got["hub"] == hub
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan
        out.collect()  # runs this DataFrame's own adaptive plan
        final = out._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in final or "isSkewJoin=true" in final, final
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


@pytest.mark.parametrize("dup", [False, True])
def test_broadcast_corpus_path_equals_brute_force(spark, dup):
    """Queries above the bound, corpus within it: the corpus is broadcast and
    each query's top-k is final inside its task (no ranking window)."""
    q, c, qdf, cdf = _frames(spark, nq=400, nc=30, dup=dup)
    k = 5
    df = knn_topk(qdf.repartition(6), cdf, k=k, max_broadcast_bytes=4096)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "MapInPandas" in plan and "Window" not in plan and "CoGroup" not in plan
    got = {}
    for r in df.collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["corpus_id"], r["distance"]))
    exp = _brute(q, c, k)
    assert set(got) == set(exp)
    for i, lst in got.items():
        lst.sort()
        assert [x[0] for x in lst] == list(range(1, k + 1))
        assert [x[1] for x in lst] == [e[0] for e in exp[i]]
        assert np.allclose([x[2] for x in lst], [e[1] for e in exp[i]], rtol=0, atol=1e-9)


def test_broadcast_corpus_path_leave_one_out_with_carry(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(200, 4)).astype(np.float32)
    df = spark.createDataFrame([(i, x[i].tolist(), i % 3) for i in range(len(x))],
                               "vec_id long, embedding array<float>, label int")
    q = df.select(F.col("vec_id").alias("query_id"), "embedding").repartition(4)
    c = df.where(F.col("vec_id") < 40).select(F.col("vec_id").alias("corpus_id"), "embedding", "label")
    # queries 200 x 4 x 8 B > 4096 >= corpus 40 x (4 x 8 + 16) B
    out = knn_topk(q, c, k=3, max_broadcast_bytes=4096, carry=("label",), exclude_self=True).collect()
    got = {}
    for r in out:
        got.setdefault(r["query_id"], []).append((r["rank"], r["corpus_id"], r["label"]))
    xd = x.astype(np.float64)
    for i in range(len(x)):
        d = ((xd[i] - xd[:40]) ** 2).sum(axis=1)
        order = [j for j in sorted(range(40), key=lambda j: (d[j], j)) if j != i][:3]
        lst = sorted(got[i])
        assert [t[0] for t in lst] == [1, 2, 3]
        assert [t[1] for t in lst] == order and [t[2] for t in lst] == [j % 3 for j in order]


def test_topk_keeps_the_smallest_ids_of_many_ties():
    """More equal distances than k, in any order and batching."""
    import numpy as np

    from ragloom.operators.retrieval import _TopK
    rng = np.random.default_rng(0)
    q = rng.standard_normal((2, 8))
    corpus = np.vstack([np.tile(q[0], (40, 1)), rng.standard_normal((300, 8))])
    for trial in range(10):
        order = rng.permutation(len(corpus))
        for step in (7, 64, len(corpus)):
            top = _TopK(2, 3)
            for a in range(0, len(order), step):
                part = order[a:a + step]
                top.offer(q, (q * q).sum(1), corpus[part], part.astype("int64"))
            assert top.ids[0].tolist() == [0, 1, 2], (trial, step)


# ------------------------------------------------------------ metric index --

def _clustered(spark, rng, n=3000, d=12, groups=25):
    centre = rng.normal(size=(groups, d)) * 12
    x = (centre[rng.integers(0, groups, n)] + rng.normal(size=(n, d))).astype(np.float32)
    x[: n // 3] = x[0] + rng.normal(size=(n // 3, d)).astype(np.float32) * 0.01   # one cell with a third of all rows
    x[100:160] = x[100]                                                            # and many exact copies
    return x, spark.createDataFrame([(i, x[i].tolist(), f"t{i}") for i in range(n)], "corpus_id long, embedding array<float>, tag string")


def test_index_visits_few_blocks_and_is_exact(spark):
    from ragloom.operators.metric_index import build_index, search_index
    rng = np.random.default_rng(7)
    x, corpus = _clustered(spark, rng)
    ask = [int(i) for i in rng.choice(len(x), 40, replace=False)] + [100, 101]
    queries = corpus.where(F.col("corpus_id").isin(ask)).select(F.col("corpus_id").alias("query_id"), "embedding")
    index = build_index(corpus.repartition(6), ("tag",), rows_per_block=64)
    visited = []
    got = {}
    for r in search_index(queries, index, 4, exclude_self=True, visited=visited).collect():
        assert r["tag"] == f"t{r['corpus_id']}"
        got.setdefault(r["query_id"], []).append((r["rank"], r["corpus_id"], r["distance"]))
    xd = x.astype(np.float64)
    for i in set(ask):
        d = ((xd[i] - xd) ** 2).sum(axis=1)
        want = [j for j in sorted(range(len(x)), key=lambda j: (d[j], j)) if j != i][:4]
        lst = sorted(got[i])
        assert [t[1] for t in lst] == want
        assert np.allclose([t[2] for t in lst], d[want], rtol=1e-12, atol=0)
    # a block holds rows of one cell, none is lost or copied
    rows = index.blocks.selectExpr("n", "size(corpus_id) AS m", "corpus_id").collect()
    assert all(r["n"] == r["m"] <= 64 for r in rows)
    assert sorted(i for r in rows for i in r["corpus_id"]) == list(range(len(x)))
    assert sum(visited) < 0.5 * index.n_blocks * len(set(ask)), (visited, index.n_blocks)


def test_queries_without_clusters_are_not_copied_for_each_block(spark, monkeypatch):
    """Where every block may hold a neighbour, a query is written once for
    each region of blocks, not once for each block."""
    from ragloom.operators import metric_index
    rng = np.random.default_rng(9)
    x = rng.normal(size=(600, 32)).astype(np.float32)
    corpus = spark.createDataFrame([(i, x[i].tolist()) for i in range(len(x))], "corpus_id long, embedding array<float>")
    index = metric_index.build_index(corpus, rows_per_block=8)
    written, cut = [], metric_index.cut_lineage

    def counted(df):
        out = cut(df)
        if "vectors" in out.columns:
            written.append(out.agg(F.sum(F.size("query_ids"))).first()[0])
        elif "embedding" in out.columns:
            written.append(out.count())
        return out
    monkeypatch.setattr(metric_index, "cut_lineage", counted)
    visited = []
    got = metric_index.search_index(corpus.withColumnRenamed("corpus_id", "query_id"), index, 2, exclude_self=True, visited=visited)
    xd = x.astype(np.float64)
    dist = ((xd[:, None] - xd[None]) ** 2).sum(axis=2)
    np.fill_diagonal(dist, np.inf)
    assert sorted((r["query_id"], r["rank"], r["corpus_id"]) for r in got.collect()) == [
        (i, r + 1, int(np.argsort(dist[i], kind="stable")[r])) for i in range(len(x)) for r in range(2)]
    assert sum(visited) > 0.5 * index.n_blocks * len(x)  # nothing to skip
    assert sum(written) < 0.2 * index.n_blocks * len(x), (written, index.n_blocks)


def test_index_bounds_never_exceed_a_distance(spark):
    from ragloom.operators.metric_index import build_index, lower_bounds
    rng = np.random.default_rng(8)
    x, corpus = _clustered(spark, rng, n=800)
    x, corpus = x * 1000, corpus.withColumn("embedding", F.transform("embedding", lambda v: (v * 1000).cast("float")))
    index = build_index(corpus, rows_per_block=16)
    xd = np.array([r["embedding"] for r in corpus.orderBy("corpus_id").collect()], np.float64)
    bound = lower_bounds(xd, index.centres, index.headers)
    for r in index.blocks.select("block", "corpus_id").collect():
        at = int(np.flatnonzero(index.headers["block"] == r["block"])[0])
        for j in r["corpus_id"]:
            assert (bound[:, at] <= ((xd - xd[j]) ** 2).sum(axis=1)).all()


@pytest.mark.parametrize("max_bytes", [64 * 1024 * 1024, 64])
def test_rows_without_a_usable_vector_take_no_part(spark, max_bytes):
    rows = [(1, [0.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [float("nan"), 0.0]), (5, [None, 1.0]), (6, []), (7, [float("inf"), 0.0]), (8, [3.0, 0.0])]
    q = spark.createDataFrame(rows, "query_id long, embedding array<float>")
    c = spark.createDataFrame(rows, "corpus_id long, embedding array<float>")
    got = knn_topk(q, c, k=2, exclude_self=True, max_broadcast_bytes=max_bytes)
    assert sorted((r["query_id"], r["rank"], r["corpus_id"]) for r in got.collect()) == [
        (1, 1, 2), (1, 2, 8), (2, 1, 1), (2, 2, 8), (8, 1, 2), (8, 2, 1)]
    empty = c.where("corpus_id < 0")
    assert knn_topk(q, empty, k=2, max_broadcast_bytes=max_bytes).count() == 0
    assert knn_topk(q.where("query_id < 0"), c, k=2, max_broadcast_bytes=max_bytes).count() == 0


def test_scan_of_a_large_batch_holds_small_tiles():
    """A whole Arrow batch against many queries: distances are computed and
    hits returned in parts, with the carried values of the right rows."""
    import tracemalloc
    from types import SimpleNamespace

    import pandas as pd

    from ragloom.operators.retrieval import _scan_with_broadcast
    rng = np.random.default_rng(4)
    q, c = rng.normal(size=(9000, 8)), rng.normal(size=(6000, 8))
    label = [None if i % 5 == 0 else i * 3 for i in range(3000)]
    tags = [pd.DataFrame({"embedding": list(c[:3000]), "corpus_id": np.arange(3000), "n": np.arange(3000) * 3, "label": pd.Series(label, dtype=object)}),
            pd.DataFrame({"embedding": list(c[3000:]), "corpus_id": np.arange(3000, 6000), "n": np.arange(3000, 6000) * 3,
                          "label": pd.Series(np.arange(3000, 6000) * 3)})]
    run = _scan_with_broadcast(SimpleNamespace(value=(np.arange(9000), q)), 3, ("n", "label"))
    tracemalloc.start()
    parts = list(run(iter(tags)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60e6, peak
    out = pd.concat(parts)
    assert max(map(len, parts)) < len(out) == 27000
    d = ((q[:50, None] - c[None]) ** 2).sum(axis=2)
    want = np.argsort(d, axis=1)[:, :3].reshape(-1)
    head = out.head(150)
    assert head["corpus_id"].tolist() == want.tolist() and head["n"].tolist() == (want * 3).tolist()
    assert head["label"].tolist() == [None if i < 3000 and i % 5 == 0 else i * 3 for i in want]
