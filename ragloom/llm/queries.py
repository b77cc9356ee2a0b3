"""One query per operator, over whole tables and with production parameters."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, brown, exact_dedup, fill_middle, hard_negatives, jaccard_rtree, line_dedup, nn_descent, packing,
               setsketch, token_files, toxicity, warc)

#: Where the public tokenizers' files lie; the package that holds them, if unset.
TOKENIZERS = os.environ.get("RAGLOOM_TOKENIZERS")


def tokenizer(name: str) -> str:
    if TOKENIZERS:
        return os.path.join(TOKENIZERS, name)
    import public_tokenizers
    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nn_descent.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = line_dedup.dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    kept = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", "n_deleted", F.length(kept).cast("long").alias("kept_chars"), F.sha2(kept.cast("binary"), 256).alias("kept_sha256"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archives(_table(spark, sf_dir, "pages"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json")).drop("uid")


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files(_table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return bpe.round_trip(_table(spark, sf_dir, "documents"), tokenizer("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op9_brown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown.brown_scores(_table(spark, sf_dir, "documents"))


def op10_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_rtree.jaccard_components(_table(spark, sf_dir, "documents"), k=4, num=85, den=100)
    return found.select("doc_id", "n_shingles", "component_id")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(vectors.withColumn("label", moved), F.col("vec_id") % 100 == 0)


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = fill_middle.restore(fill_middle.fill_in_middle(_table(spark, sf_dir, "documents")))
    digest = lambda c: F.sha2(F.col(c).cast("binary"), 256)
    return cut.select("doc_id", "n", "form", F.col("prefix_units").alias("prefix_chars"), F.col("middle_units").alias("middle_chars"),
                      digest("output").alias("output_sha256"), digest("text").alias("restored_sha256"))


def op13_setsketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setsketch.near_duplicates(_table(spark, sf_dir, "documents"), k=2, num=80, den=100)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_nn_descent, op2_line_dedup, op3_exact_dedup, op4_toxicity, op5_warc, op6_packing,
                            op7_token_files, op8_byte_bpe, op9_brown, op10_jaccard, op11_hard_negatives, op12_fill_middle,
                            op13_setsketch, pipeline)
}
