"""TF-IDF keyword paths, the tokenizer and the scan / lineage helpers."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from ragloom.functions.text import KEYWORD_PATTERN, lower_tokens, tokens
from ragloom.operators import synth
from ragloom.plans import queries
from ragloom.session import checkpoint_dir, cut_lineage
from ragloom.sources.tables import spread_small_scan


def _rows(df):
    return sorted((r["chunk_id"], tuple(r["keywords"]), r["n_keywords"], r["text"]) for r in df.collect())


def test_salted_join_equals_broadcast_join(spark):
    """The vocabulary join gives the same keywords whether the vocabulary is
    broadcast or joined by (word, salt) -- with a word present in every chunk
    (hot key) and chunks without any word (sentinel rows)."""
    ch = queries._window_chunks(spark, SF001).select(
        "chunk_id", F.concat(F.col("text"), F.lit(" everywhere")).alias("text"))
    extra = spark.createDataFrame([("chunk_x1", "12 34 !!"), ("chunk_x2", None)], "chunk_id string, text string")
    ch = ch.unionByName(extra)
    n = ch.count()
    small = synth.tfidf_keywords(ch, n_docs=n, carry_text=True)
    salted = synth.tfidf_keywords(ch, n_docs=n, carry_text=True, max_broadcast_words=0, salt=4)
    a, b = _rows(small), _rows(salted)
    assert a == b
    got = {r[0]: r for r in a}
    assert got["chunk_x1"][1] == () and got["chunk_x1"][3] == "12 34 !!"
    assert got["chunk_x2"][1] == () and got["chunk_x2"][2] == 0
    assert all(len(set(r[1])) == len(r[1]) == r[2] <= synth.N_CASE_KEYWORDS for r in a)


def test_word_runs_equal_regex_tokens(spark):
    rnd = random.Random(7)
    alphabet = "abcdefghijklmnopqrstuvwxyzABCDEFZ  \n\t,.-'0123456789éİß"
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 400))) for _ in range(300)]
    texts += ["", "abcdef", "abcde", "abcdefghij klmnop", "ABCDEFG-hijklmn", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    out = df.select("id", lower_tokens("t").alias("a"),
                    tokens(F.lower("t"), KEYWORD_PATTERN).alias("b")).collect()
    assert all(r["a"] == r["b"] for r in out)


def test_small_scan_is_spread_large_is_not(spark, tmp_path):
    want = spark.sparkContext.defaultParallelism
    p = str(tmp_path / "one")
    spark.range(1000).coalesce(1).write.parquet(p)
    one = spark.read.parquet(p)
    assert one.rdd.getNumPartitions() < want
    spread = spread_small_scan(one)
    assert spread.rdd.getNumPartitions() == want
    assert sorted(r[0] for r in spread.collect()) == list(range(1000))
    many = spark.range(0, 1000, numPartitions=want * 2)
    assert spread_small_scan(many) is many


def test_cut_lineage_writes_under_checkpoint_dir(spark):
    df = spark.range(50).withColumn("sq", F.col("id") * F.col("id"))
    out = cut_lineage(df)
    files = out.inputFiles()
    assert files and all(checkpoint_dir(spark).rstrip("/").split("/")[-1] in f for f in files)
    assert sorted(r["sq"] for r in out.collect()) == [i * i for i in range(50)]


def test_word_counts_within_the_row(spark):
    rows = [(["b", "a", "b", "c", "b", "a"],), ([],), (["x"],), (None,)]
    got = [{c["token"]: c["tf"] for c in r["c"]} if r["c"] is not None else None
           for r in spark.createDataFrame(rows, "w array<string>").select(synth.word_counts(F.col("w")).alias("c")).collect()]
    assert got[:3] == [{"a": 2, "b": 3, "c": 1}, {}, {"x": 1}]


def test_generated_cases_end_to_end(spark, tmp_path):
    """Sample -> model -> skipped failures -> quarantine -> three sinks."""
    import json

    from ragloom.plans import pipelines
    chunks = spark.createDataFrame([(f"chunk_{i}", f"text {i}") for i in range(20)], "chunk_id string, text string")
    sampled = sorted(r["chunk_id"] for r in synth.sample_rows(chunks, 8).collect())
    bad, odd, shape = sampled[0], sampled[1], sampled[2]

    def make():
        def gen(text):
            name = "chunk_" + text.split()[1]
            if name == bad:
                raise ValueError("model failure")
            if name == odd:
                return "no json"
            case = {"query": f"q {name}", "expected_keywords": ["k"]}
            wrong = [{"expected_keywords": ["k"]}] if name == shape else []
            return json.dumps({"retrieval_cases": [case, *wrong], "generation_cases": [case], "ragas_cases": [{"query": "r", "ground_truth": "g"}]})
        return gen
    out = pipelines.generate_synthetic(chunks, str(tmp_path), n=8, make_generator=make)
    assert {k: out[k].count() for k in ("retrieval", "generation", "ragas")} == {"retrieval": 6, "generation": 6, "ragas": 6}
    skipped = {r["chunk_id"]: r["error"] for r in out["skipped"].collect()}
    assert set(skipped) == {bad, odd} and "model failure" in skipped[bad] and "no batch" in skipped[odd]
    assert [(r["kind"], r["chunk_id"], r["query"]) for r in out["quarantine"].collect()] == [("retrieval", shape, None)]
    assert spark.read.json(str(tmp_path / "test_retrieval_synthetic")).count() == 6
    assert spark.read.parquet(str(tmp_path / "quarantine")).count() == 1


def test_default_cases_come_from_the_sample(spark):
    from ragloom.plans import pipelines
    ch = queries._window_chunks(spark, SF001).select("chunk_id", "text")
    want = sorted(r["chunk_id"] for r in synth.sample_rows(ch).collect())
    out = pipelines.generate_synthetic(ch)
    for kind in ("retrieval", "generation", "ragas"):
        assert sorted(r["chunk_id"] for r in out[kind].collect()) == want
    all_kw = {r["chunk_id"]: r["keywords"] for r in synth.tfidf_keywords(ch).collect()}
    assert all(list(r["expected_keywords"]) == list(all_kw[r["chunk_id"]]) for r in out["retrieval"].collect())


@pytest.mark.parametrize("limit", [0, 1, 2, 4, 7])
def test_keywords_with_a_part_of_the_vocabulary_listed(spark, limit):
    """Fewer words may be shipped than there are: the frequent ones are, those
    of one chunk need no list, the rest are looked up; no row of a frequent word moves."""
    import math
    common = ["alphabet", "building"]
    pairs = ["cabinet", "daylight"]
    texts = {f"c{i}": " ".join([*common, "single" + "abcdefghij"[i] * 3, pairs[i // 2 % 2], "evening" if i % 3 == 0 else "evening evening"])
             for i in range(10)}
    texts["none"] = "a b"
    df = spark.createDataFrame([*texts.items(), ("null", None)], "chunk_id string, text string").repartition(3)
    out = synth.tfidf_keywords(df, n=3, max_broadcast_words=limit, carry_text=True)
    n_docs = 12
    seen = {}
    for t in texts.values():
        for w in set(t.split()):
            seen[w] = seen.get(w, 0) + 1
    got = {r["chunk_id"]: r for r in out.collect()}
    assert len(got) == n_docs
    for key, t in {**texts, "null": None}.items():
        words = [w for w in (t or "").split() if len(w) >= 6]
        want = sorted(set(words), key=lambda w: (-round(words.count(w) * math.log(n_docs / seen[w]), 9), w))[:3]
        assert got[key]["keywords"] == want and got[key]["text"] == t
    assert "__salt" not in out._jdf.queryExecution().toString()
