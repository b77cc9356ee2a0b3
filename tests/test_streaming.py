"""Incremental answering over a file stream of case files."""

import json

from pyspark.sql import functions as F

from conftest import SF001
from ragloom.plans import derived, pipelines
from ragloom.streaming.incremental import start_incremental_answers


def test_stream_answers_only_new_pairs(spark, tmp_path):
    vectors = pipelines.create_vectors(
        pipelines.load_and_chunk(derived.documents(spark, SF001), chunker="window")).cache()
    cases_dir = tmp_path / "cases"
    cases_dir.mkdir()
    texts = [r["text"] for r in derived.documents(spark, SF001).orderBy("doc_id").limit(3).collect()]
    (cases_dir / "a.json").write_text(json.dumps([{"query": texts[0]}, {"query": texts[1]},
                                                  {"generation_cases": []}]))
    out = str(tmp_path / "answers")
    ck = str(tmp_path / "ck")
    q = start_incremental_answers(spark, str(cases_dir), vectors, "prompt_v0,prompt_v1", out, checkpoint=ck)
    q.awaitTermination(300)
    first = spark.read.parquet(out)
    assert first.count() == 4                      # 2 valid cases x 2 versions
    # a second file repeats one question and adds one
    (cases_dir / "b.json").write_text(json.dumps([{"query": texts[1]}, {"query": texts[2]}]))
    q = start_incremental_answers(spark, str(cases_dir), vectors, "prompt_v0,prompt_v1", out, checkpoint=ck)
    q.awaitTermination(300)
    second = spark.read.parquet(out)
    assert second.count() == 6                     # only the new question's 2 pairs
    assert second.groupBy("question_text", "prompt_version").count().where(F.col("count") > 1).count() == 0
    assert second.where(F.col("error").isNotNull()).count() == 0
