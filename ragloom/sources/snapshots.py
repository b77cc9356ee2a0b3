"""Result tables that change by commits.

A table is a folder of immutable data and of numbered manifests.  A manifest
names, for each value of the table's part column (the prompt version, say),
the folder with its rows; the highest number is the table's state.

A commit writes the rows of the parts that it changes into a new folder, then
a manifest that points to it and to the untouched folders of the state it began
from, under a temporary name, and renames that to the next number.  The rename
is the switch: a driver or an executor lost before it leaves the old state
whole (with some files that nothing refers to), one lost after it has
committed.  Two commits from the same state meet at the same number and the
second is refused.

Files are reached through Spark's own file systems only.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class ConcurrentCommit(RuntimeError):
    """Another commit came first; read the new state and try again."""


def _files(spark: SparkSession, root: str):
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return jvm, path.getFileSystem(conf), jvm.org.apache.hadoop.fs.FileContext.getFileContext(path.getFileSystem(conf).getUri(), conf)


def _path(jvm, *parts: str):
    return jvm.org.apache.hadoop.fs.Path("/".join(p.rstrip("/") for p in parts))


def manifest(spark: SparkSession, root: str) -> dict:
    """The state: {"number": n, "parts": {value: folder}}; number -1 before the
    first commit."""
    jvm, fs, _ = _files(spark, root)
    folder = _path(jvm, root, "manifests")
    if not fs.exists(folder):
        return {"number": -1, "parts": {}}
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    numbers = [int(n[:-len(".json")]) for n in names if n.endswith(".json") and not n.startswith((".", "_"))]
    if not numbers:
        return {"number": -1, "parts": {}}
    stream = fs.open(_path(jvm, root, "manifests", f"{max(numbers):012d}.json"))
    try:
        return json.loads(bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8"))
    finally:
        stream.close()


def _switch(spark: SparkSession, root: str, state: dict) -> None:
    """Make ``state`` the table's, unless its number is taken."""
    jvm, fs, context = _files(spark, root)
    folder = _path(jvm, root, "manifests")
    fs.mkdirs(folder)
    draft = _path(jvm, root, "manifests", f".{uuid.uuid4().hex}.tmp")
    stream = fs.create(draft, True)
    stream.write(bytearray(json.dumps(state, sort_keys=True).encode("utf-8")))
    stream.close()
    none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(draft, _path(jvm, root, "manifests", f"{state['number']:012d}.json"), none)
    except Exception as e:
        if "AlreadyExists" in str(e):
            raise ConcurrentCommit(f"{root}: commit {state['number']} was made by another run") from e
        raise


def read_snapshot(spark: SparkSession, root: str, schema: str, parts: list[str] | None = None,
                  state: dict | None = None) -> DataFrame:
    """The table's rows, or those of some parts (only their folders are read)."""
    state = state if state is not None else manifest(spark, root)
    folders = [f for v, f in sorted(state["parts"].items()) if parts is None or v in parts]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{root.rstrip('/')}/{f}" for f in folders])


def replace_parts(spark: SparkSession, root: str, rows: DataFrame, part: str, state: dict,
                  emptied: list[str] | None = None) -> dict:
    """Commit ``rows`` as the whole content of every part that they have rows
    of (and of ``emptied``, which may have none); other parts stay as in
    ``state``, the manifest that the caller has read.  Returns the new one."""
    folder = f"data/{uuid.uuid4().hex}"
    key = F.coalesce(F.col(part).cast("string"), F.lit(""))
    marked = rows.withColumn("__part", F.md5(key))
    marked.write.partitionBy("__part").parquet(f"{root.rstrip('/')}/{folder}")
    back = spark.read.schema(rows.schema).parquet(f"{root.rstrip('/')}/{folder}")
    # one value a part: bounded by the part column's catalogue
    values = [r[0] for r in back.select(F.coalesce(F.col(part).cast("string"), F.lit(""))).distinct().collect()]
    kept = {v: f for v, f in state["parts"].items() if v not in (emptied or [])}
    kept.update({v: f"{folder}/__part={_md5(v)}" for v in values})
    new = {"number": state["number"] + 1, "parts": kept}
    _switch(spark, root, new)
    return new


def _md5(value: str) -> str:
    import hashlib
    return hashlib.md5(value.encode("utf-8")).hexdigest()


def upsert(spark: SparkSession, root: str, rows: DataFrame, keys: list[str], part: str,
           order: Column | None = None) -> dict:
    """Commit ``rows`` over the table: a row replaces the one with its keys, a
    new one is added, everything else stays; of ``rows`` that repeat their keys
    the last counts (greatest ``order``, then greatest by value).  Only the
    parts of ``rows`` are read and written again."""
    state = manifest(spark, root)
    cols = rows.columns
    last = order if order is not None else F.lit(0)
    rest = [c for c in cols if c not in keys]
    once = rows.groupBy(*keys).agg(F.max(F.struct(last.alias("__order"), *rest)).alias("__last")).select(
        *keys, *[F.col(f"__last.{c}").alias(c) for c in rest]).select(*cols)
    touched = [r[0] for r in rows.select(F.coalesce(F.col(part).cast("string"), F.lit(""))).distinct().collect()]
    if not touched:
        return state
    schema = rows.schema
    before = read_snapshot(spark, root, schema, touched, state).select(*cols)
    same = [before[k].eqNullSafe(once[k]) for k in keys]
    stays = before.join(once.select(*keys), same, "left_anti")
    return replace_parts(spark, root, stays.unionByName(once), part, state)
