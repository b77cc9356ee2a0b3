"""Session construction and lineage helpers.

The library never creates a machine-local scratch folder on its own: a
reliable checkpoint directory must come from the cluster configuration
(``spark.checkpoint.dir``).  Only tests and the local bench set one when it
is missing.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

# Defaults that matter at scale; every one of them can be overridden by the
# cluster configuration because ``getOrCreate`` keeps existing settings.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, app: str = "ragloom",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the engine's defaults."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    bind_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder named by the cluster, if any."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    return d or None


def bind_checkpoint_dir(spark: SparkSession) -> str | None:
    """Point ``SparkContext`` checkpoints at ``spark.checkpoint.dir``."""
    d = checkpoint_dir(spark)
    if d:
        spark.sparkContext.setCheckpointDir(d)
    return d


def set_checkpoint_dir_if_unset(spark: SparkSession, path: str) -> str:
    """For tests and local runs only: use ``path`` when the session names none."""
    d = checkpoint_dir(spark)
    if not d:
        spark.conf.set("spark.checkpoint.dir", path)
        d = path
    spark.sparkContext.setCheckpointDir(d)
    return d


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Materialise ``df`` reliably so that a lost executor does not force a
    recomputation of the whole upstream plan, and so that several consumers
    read it instead of recomputing it.

    When the session names a shared checkpoint folder, ``df`` is written once
    as a parquet table under it and read back: one computation (an eager
    ``Dataset.checkpoint`` of an unpersisted plan computes it twice, once to
    count and once to write), columnar and compressed, and the scan of the
    written files carries real size statistics for the planner.  Without a
    folder it falls back to a disk-backed ``persist`` (lineage is kept, so a
    lost block is recomputed rather than lost).
    """
    spark = df.sparkSession
    d = bind_checkpoint_dir(spark)
    if d:
        path = f"{d.rstrip('/')}/ragloom-{uuid.uuid4().hex}"
        df.write.parquet(path)
        return spark.read.parquet(path)
    out = df.persist(StorageLevel.MEMORY_AND_DISK)
    if eager:
        out.count()
    return out


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder's path under the session's shared checkpoint folder."""
    d = bind_checkpoint_dir(spark) or spark.sparkContext.getCheckpointDir()
    if not d:
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return f"{d.rstrip('/')}/ragloom-{name}-{uuid.uuid4().hex}"


@contextmanager
def batches_of(spark: SparkSession, rows: int):
    """Arrow batches of at most ``rows`` rows for what runs inside: for tables
    whose rows are large, so that a task holds little of them at once."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)
