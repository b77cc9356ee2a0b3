"""Incremental evaluation with Structured Streaming.

The reference resumes an interrupted prompt-version run by skipping every
(question, version) already present in its result document and rewriting the
document after each new answer.  Here new case files are a file stream; each
micro-batch is expanded to the requested versions (J8), reduced to the pairs
not yet in the answers table (J5), answered (M8) and appended to the table
partitioned by prompt version (S8).

Exactly-once in effect: the stream's checkpoint records which files were
processed, and a micro-batch replayed after a failure first anti-joins against
what the sink already holds, so it never writes a pair twice.  The checkpoint
lives under the cluster's shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ragloom.operators import generation, impact, metrics, prompts, retrieval
from ragloom.session import checkpoint_dir, cut_lineage
from ragloom.sources.io import read_or_empty

CASE_STREAM_SCHEMA = "query STRING, expected_keywords ARRAY<STRING>, ground_truth STRING"
ANSWER_SCHEMA = "question_text STRING, prompt_version STRING, response STRING, error STRING"


def _existing(spark: SparkSession, path: str) -> DataFrame:
    """The (question, version) pairs the answers table already holds; none
    before its first write.  With the schema given, an empty folder reads as
    no rows and a missing one is caught."""
    schema = "question_text string, prompt_version string, error string"
    return read_or_empty(spark, lambda: spark.read.schema(schema).parquet(path), schema)


def answer_batch(batch: DataFrame, vectors: DataFrame, versions: list[str], out_path: str,
                 make_generator: Callable | None = None, k: int = retrieval.TOP_K, embed: Callable | None = None) -> int:
    """One micro-batch: pending pairs only, answered and appended."""
    from ragloom.plans import pipelines

    spark = batch.sparkSession
    cases = (metrics.generation_case_filter(batch)
             .select(F.xxhash64("query").alias("case_id"), F.col("query").alias("question_text"))
             .dropDuplicates(["question_text"]))
    todo = cut_lineage(impact.pending_pairs(cases, versions, _existing(spark, out_path)))
    n = todo.count()  # of what was written
    if not n:
        return 0
    hits = pipelines._contexts(todo.select("case_id", F.col("question_text").alias("query")).distinct(),
                               vectors, k, embed or pipelines._default_embed)
    rows = (pipelines.with_contexts(todo, hits).drop("contexts")
            .join(F.broadcast(prompts.catalogue(spark)), "prompt_version", "left")
            .withColumnRenamed("question_text", "query"))
    out = (generation.generate_answers(rows, make_generator)
           .select(F.col("query").alias("question_text"), "prompt_version",
                   F.col("answer").alias("response"), "error"))
    out.write.mode("append").partitionBy("prompt_version").parquet(out_path)
    return n


def start_incremental_answers(spark: SparkSession, cases_dir: str, vectors: DataFrame,
                              versions_spec: str, out_path: str, name: str = "incremental_answers",
                              checkpoint: str | None = None, available_now: bool = True,
                              make_generator: Callable | None = None, k: int = retrieval.TOP_K,
                              embed: Callable | None = None) -> StreamingQuery:
    """Start the stream over JSON-array case files arriving in ``cases_dir``;
    ``embed`` must be the embedder that ``vectors`` were made with."""
    versions = prompts.validate_versions(spark, versions_spec)
    root = checkpoint or checkpoint_dir(spark)
    if not root:
        raise ValueError("spark.checkpoint.dir is not set and no checkpoint location was given")
    stream = (spark.readStream.schema(CASE_STREAM_SCHEMA).option("multiLine", True)
              .option("maxFilesPerTrigger", 100).json(cases_dir))
    writer = (stream.writeStream.queryName(name)
              .option("checkpointLocation", os.path.join(root, name))
              .foreachBatch(lambda df, _epoch: answer_batch(df, vectors, versions, out_path, make_generator, k, embed)))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
