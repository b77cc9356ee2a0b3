"""Shared folder, stored tables and file access for the operators here."""

from __future__ import annotations

import sys
import tempfile
import types
import uuid

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ragloom.session import batches_of, checkpoint_dir  # noqa: F401


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder's URI under ``spark.checkpoint.dir``.

    Only a local session that names none gets one of its own; on a cluster a
    folder of one machine would be no use to the others.
    """
    base = checkpoint_dir(spark) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="ragloom-")
        spark.conf.set("spark.checkpoint.dir", base)
    if "://" not in base and not base.startswith("file:"):
        base = f"file://{base}"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: later stages
    start from the files, whichever executors are lost."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with the number of each row, written once, and that column's
    name.  The number depends on how the scan is split, which may differ from
    one scan to the next, so what is joined by it must be read from this table."""
    name = unused(docs, "__uid")
    return stored(docs.withColumn(name, F.monotonically_increasing_id()), "numbered"), name


def rows_of(docs: DataFrame, name: str, uids: DataFrame) -> DataFrame:
    """The rows of ``docs`` (``numbered``, by column ``name``) whose number is
    in ``uids`` (uid), without the number."""
    return docs.join(uids.select(F.col("uid").alias(name)), name, "left_semi").drop(name)


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder's URI, for code inside tasks."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def worker_state(name: str, make):
    """What ``make`` returns, kept for the life of the Python worker, so that
    the tasks it runs one after the other share caches and loaded models."""
    module = sys.modules.setdefault("_ragloom_worker_state", types.ModuleType("_ragloom_worker_state"))
    if not hasattr(module, name):
        setattr(module, name, make())
    return getattr(module, name)
