"""Texts reach the workers in batches that a task can hold."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import functions as F

from ragloom.llm import bpe, jaccard_rtree, toxicity


def _bounded(make, rows):
    """``make``'s step, which fails on batches of more rows."""
    def made(*args, **settings):
        step = make(*args, **settings)

        def run(batches):
            def checked():
                for b in batches:
                    assert b.num_rows <= rows, b.num_rows
                    yield b
            return step(checked())
        return run
    return made


def _documents(spark, n):
    return spark.range(n).coalesce(1).select(F.lit(1).alias("__0"), F.concat(F.lit("text "), "id").alias("Text"), F.col("id").alias("doc_id"))


def test_drop_toxic_scores_small_batches_and_keeps_the_columns(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "_score", _bounded(toxicity._score, 1000))
    docs, before = _documents(spark, 2500), spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == ["__0", "Text", "doc_id"]
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, docs.collect()))
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


def test_jaccard_reads_texts_in_small_batches(spark, monkeypatch):
    monkeypatch.setattr(jaccard_rtree, "_sizes", _bounded(jaccard_rtree._sizes, 500))
    monkeypatch.setattr(jaccard_rtree, "_links", lambda texts, *_: texts.sparkSession.createDataFrame([], "a long, b long"))
    found = jaccard_rtree.jaccard_components(_documents(spark, 1300).withColumnRenamed("Text", "text"), k=2)
    assert found.where("component_id = doc_id and n_shingles = 1").count() == 1300


def test_bpe_steps_take_small_parts_and_find_words_together():
    batch = pa.RecordBatch.from_arrays([pa.array(range(600))], ["x"])
    parts = list(bpe.in_parts(iter([batch, batch.slice(0, 0)])))
    assert [p.num_rows for p in parts] == [256, 256, 88, 0]
    words = [b"a", b"ab", bytes(range(64))]
    known = bpe.Vocabulary(bpe.pack_words(pa.array(words, pa.binary()), pa.array([[1], [2, 3], [4]], pa.list_(pa.int32()))))
    assert known.find([b"ab", b"none", b"a", b""]) == [bpe.np.array([2, 3], "<i4").tobytes(), None, bpe.np.array([1], "<i4").tobytes(), None]
    cut, whole = bpe.word_cutter(bpe.GPT2_PATTERN), bpe.word_pattern(bpe.GPT2_PATTERN).findall
    for unit in (" Foo,", "\nfoo", " it's", " x9", "", " ", "é!?"):
        assert cut(unit) == whole(unit)
