"""Scans of the parquet tables (S1, S12 inputs).

Every scan is a plain ``spark.read.parquet``; projections and filters written
downstream reach the scan through Catalyst (``ReadSchema`` / ``PushedFilters``).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table.  A damaged file fails the read: rows are never lost
    without an error."""
    return spark.read.parquet(table_path(sf_dir, name))


def spread_small_scan(df: DataFrame) -> DataFrame:
    """Give a scan with fewer splits than the session has cores one partition
    per core -- for a scan whose rows get heavy per-row work (tokenizing
    whole texts) before any shuffle.

    A table stored as a few large files or row groups is read by that many
    tasks, and every narrow step after the scan would run on them alone.
    Such a scan is spread round-robin (skew-free whatever the keys; Spark
    sorts before a round-robin exchange, so a retried task gets the same
    rows).  A table on a cluster has far more splits than cores and is
    returned unchanged -- no shuffle.  Filters and column pruning still reach
    the scan through the exchange.  Call it on a plain scan: counting its
    splits lists the files and runs no job (on a plan with shuffles, adaptive
    execution would run them).  Where a shuffle or a selective filter follows
    the scan anyway, do not call it: the extra exchange would only move the
    table twice.
    """
    want = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(want) if df.rdd.getNumPartitions() < want else df


def register_views(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    """Expose the tables as temp views for ``spark.sql``."""
    from pyspark.errors import AnalysisException
    for n in names:
        try:
            read_table(spark, sf_dir, n).createOrReplaceTempView(n)
        except AnalysisException as e:   # a table the folder does not have
            if "PATH_NOT_FOUND" not in str(e):
                raise
