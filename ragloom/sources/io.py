"""File sources and sinks of the evaluation.

Every sink is a DataFrame writer (parallel, one file per task); every source
is a DataFrame reader with a declared schema (no inference pass).
"""

from __future__ import annotations

import logging
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ragloom.operators.counts import counted
from ragloom.session import cut_lineage

log = logging.getLogger(__name__)

CHUNK_SCHEMA = "chunk_id STRING, text STRING, source STRING, page BIGINT"
CASE_SCHEMA = ("query STRING, expected_keywords ARRAY<STRING>, ground_truth STRING, "
               "generation_cases STRING")
VECTOR_SCHEMA = "chunk_id STRING, source STRING, page BIGINT, text STRING, embedding ARRAY<FLOAT>"
REPORT_COLS = ["model_name", "retrieval", "generation", "ragas", "rqi", "grade"]
SCORE_KEYS = {"retrieval": "retrieval_score", "generation": "generation_score", "ragas": "ragas_score"}
JUDGED_SCHEMA = ("user_input STRING, retrieved_contexts STRING, response STRING, reference STRING, "
                 "context_precision DOUBLE, context_recall DOUBLE, faithfulness DOUBLE, "
                 "answer_relevancy DOUBLE")
BUNDLE_SHEETS = ("Raw_Data", "Prompt_Summary", "Question_RQI", "Delta_Analysis")


def read_or_empty(spark: SparkSession, read, schema: str) -> DataFrame:
    """``read()``, or no rows of ``schema`` when its path does not exist.

    The existence test is Spark's own (the file system of the path, whatever
    it is), not a check of the driver's local disk."""
    from pyspark.errors import AnalysisException
    try:
        return read()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def _required(col: str, what: str):
    """Lazy not-null check: the job fails on the first row missing ``col``
    (the reference aborts on a missing key) without a separate pass."""
    return F.when(F.col(col).isNull(), F.raise_error(F.lit(f"{what}: missing '{col}'"))).otherwise(F.col(col))


# ------------------------------------------------------------ S2 / S3 -----

def write_chunks(chunks: DataFrame, path: str) -> int:
    """One JSON object per line: chunk_id, text, source, page.  Returns
    the number of chunks (A7), counted while they are written."""
    rows = chunks.select("chunk_id", "text", "source", F.col("page").cast("bigint").alias("page"))
    return counted(rows, lambda df: df.write.mode("overwrite").json(path))


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """S3: JSON Lines with a fixed schema; malformed JSON or a missing
    chunk_id / text aborts the job (FAILFAST + lazy not-null check)."""
    df = spark.read.schema(CHUNK_SCHEMA).option("mode", "FAILFAST").json(path)
    return df.select(_required("chunk_id", "chunk file").alias("chunk_id"),
                     _required("text", "chunk file").alias("text"), "source", "page")


# ------------------------------------------------------------------ S4 -----

def read_cases(spark: SparkSession, path: str, dataset: str | None = None) -> DataFrame:
    """Whole-file JSON array(s) of test cases.  A wrongly shaped item
    survives the load with a null ``query`` (dropped later by the evaluators'
    filters or sent to quarantine).  ``dataset`` (P16) tags the rows, e.g.
    ``synthetic`` / ``curated``; default: the file name without extension."""
    files = spark.read.option("pathGlobFilter", "*.json").text(path, wholetext=True)
    items = F.posexplode(F.from_json("value", f"array<struct<{CASE_SCHEMA}>>"))
    df = (files.select(F.col("_metadata.file_name").alias("__file"), items.alias("__at", "__case"))
          .select("__file", "__at", "__case.*"))
    tag = F.lit(dataset) if dataset else F.regexp_replace("__file", r"\.json$", "")
    return (df.withColumn("dataset", tag)
            .withColumn("case_id", F.xxhash64("__file", "query", "__at"))
            .drop("__file", "__at", "generation_cases"))


def select_dataset(cases: DataFrame, synthetic: bool = True) -> DataFrame:
    """Pick the synthetic or the curated test set by its file suffix."""
    is_syn = F.col("dataset").endswith("_synthetic")
    return cases.where(is_syn if synthetic else ~is_syn)


# ------------------------------------------------------------------ S5 -----

def read_score_files(spark: SparkSession, results_dir: str) -> DataFrame:
    """The three scalar score files -> long (run, metric, value).  A
    missing file contributes no row (the report then uses 0.0); a file
    without its key gives a null value (also 0.0 in the report).  One read of
    a glob over the three names: a missing file simply matches nothing."""
    names = ",".join(SCORE_KEYS)
    pattern = f"{results_dir.rstrip('/')}/{{{names}}}_score.json"
    schema = ", ".join(f"{k} DOUBLE" for k in SCORE_KEYS.values())
    out_schema = "run STRING, metric STRING, value DOUBLE"

    def read():
        df = spark.read.schema(schema).json(pattern).withColumn("__f", F.col("_metadata.file_name"))
        metric = F.regexp_extract("__f", r"^(.*)_score\.json$", 1)
        value = F.coalesce(*[F.when(metric == F.lit(m), F.col(k)) for m, k in SCORE_KEYS.items()])
        return df.select(F.lit("default").alias("run"), metric.alias("metric"), value.alias("value"))
    return read_or_empty(spark, read, out_schema)


# ------------------------------------------------------------------ S6 -----

def write_reports(reports: DataFrame, path: str) -> None:
    """One table of run reports partitioned by model name (replaces one
    file per run); overwriting only the partitions written."""
    (reports.select(*REPORT_COLS).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("model_name").parquet(path))


def read_reports(spark: SparkSession, path: str, models: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    if models is not None:
        df = df.where(F.col("model_name").isin(models))   # partition pruning
    return df.select(*REPORT_COLS)


# ------------------------------------------------------------ S7 / S8 -----

def write_impact(rows: DataFrame, path: str) -> None:
    """Tidy impact rows partitioned by prompt version; a rerun of one
    version replaces only that version's partition (dynamic overwrite)."""
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("prompt_version").parquet(path))


def read_impact(spark: SparkSession, path: str, versions: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    if versions is not None:
        df = df.where(F.col("prompt_version").isin(versions))
    return df


def write_impact_documents(nested: DataFrame, path: str) -> None:
    """S8 (JSON edge): one line per question: {"question_id", "document"}."""
    nested.write.mode("overwrite").json(path)


def read_impact_documents(spark: SparkSession, path: str) -> DataFrame:
    """S7 (JSON edge, scalable form): the lines written above."""
    return spark.read.schema("question_id STRING, document STRING").json(path)


# ------------------------------------------------------------ S9 / S10 ----

def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """A flat table as parquet (default) or CSV with a header."""
    w = df.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.parquet(path)


def read_table_file(spark: SparkSession, path: str, fmt: str = "parquet", schema: str | None = None) -> DataFrame:
    if fmt == "csv":
        r = spark.read.option("header", True)
        return (r.schema(schema) if schema else r.option("inferSchema", True)).csv(path)
    return spark.read.parquet(path)


def write_bundle(tables: dict[str, DataFrame], root: str) -> list[str]:
    """The named report tables, one directory each."""
    written = []
    for name in BUNDLE_SHEETS:
        if name in tables:
            p = os.path.join(root, name)
            write_table(tables[name], p)
            written.append(p)
    return written


# ------------------------------------------------------------------ S11 ----

def write_judged_csv(judged: DataFrame, path: str) -> None:
    """The per-sample judged table as CSV; array columns as JSON text."""
    cols = []
    for f in judged.schema.fields:
        if f.dataType.typeName() in ("array", "map", "struct"):
            cols.append(F.to_json(F.col(f.name)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    judged.select(*cols).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def read_judged_csv(spark: SparkSession, path: str) -> DataFrame:
    """Read a judged-sample CSV (quoted multi-line cells, doubled quotes);
    blank metric cells are null, NaN is normalised to null."""
    df = (spark.read.option("header", True).option("multiLine", True).option("escape", '"')
          .schema(JUDGED_SCHEMA).csv(path))
    for m in ("context_precision", "context_recall", "faithfulness", "answer_relevancy"):
        df = df.withColumn(m, F.when(F.isnan(m), F.lit(None).cast("double")).otherwise(F.col(m)))
    return df


# ------------------------------------------------------------------ S12 ----

def save_vectors(vectors: DataFrame, path: str, partition_by: str | None = None) -> int:
    """The vector store is a parquet table with a fixed schema (metadata
    and vector in the same row, so no id -> document map is needed).  Returns
    the number of vectors, counted while they are written."""
    def write(df):
        w = df.write.mode("overwrite")
        (w.partitionBy(partition_by) if partition_by else w).parquet(path)
    return counted(vectors, write)


def load_vectors(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


# ------------------------------------------------------------------ G3 -----

def write_case_tables(tables: dict[str, DataFrame], root: str) -> dict[str, int]:
    """The three generated case tables (retrieval, generation, ragas),
    each as JSON under ``root/test_<name>_synthetic``.  Returns the number of
    cases by path, counted while they are written."""
    paths = {os.path.join(root, f"test_{name}_synthetic"): df for name, df in tables.items()}
    return {p: counted(df, lambda d, p=p: d.write.mode("overwrite").json(p)) for p, df in paths.items()}


# ------------------------------------------------------------------ S1 -----

PAGE_SCHEMA = "source STRING, page BIGINT, text STRING"
ERROR_SCHEMA = "source STRING, error STRING"
PAGE_BREAK = "\f"                       # as text extractors put between pages
MAX_FILE_BYTES = 1 << 30                # a file is one value until its pages are split


def read_pages(spark: SparkSession, path: str, pattern: str = "*.txt") -> tuple[DataFrame, DataFrame]:
    """S1 for a directory of extracted texts, one file per document with form
    feeds between its pages: (pages, errors).

    Every file is read once, as bytes, into one stored table.  A file that is
    valid UTF-8 gives a row per page (source = the file's path, page from 0; a
    form feed at the end opens no page); one that is not, that is longer than
    ``MAX_FILE_BYTES``, or that could not be read at all (it was listed, and
    its bytes never came) is a row of the error table, with its name and what
    is wrong, and stops nothing.  An empty file has no page, an empty directory
    gives two empty tables.
    """
    listed = read_or_empty(spark, lambda: spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select("path", "length"),
                           "path string, length bigint")
    listed = cut_lineage(listed)

    def read():
        raw = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("ignoreCorruptFiles", "true").load(path)
        return raw.where(F.col("length") <= MAX_FILE_BYTES).select("path", "content")
    text = F.decode("content", "utf-8")
    whole = F.is_valid_utf8(F.col("content").cast("string"))
    parts = F.split(F.regexp_replace(text, PAGE_BREAK + "\\z", ""), PAGE_BREAK)
    rows = read_or_empty(spark, read, "path string, content binary").select(
        "path", F.posexplode(F.when(whole, parts).otherwise(F.array(F.lit(None).cast("string")))).alias("page", "text"))
    rows = cut_lineage(rows)
    pages = rows.where(F.col("text").isNotNull()).select(F.col("path").alias("source"), F.col("page").cast("bigint").alias("page"), "text")
    damaged = rows.where(F.col("text").isNull()).select(F.col("path").alias("source"), F.lit("not valid UTF-8").alias("error"))
    lost = listed.join(rows.select("path").distinct(), "path", "left_anti").select(
        F.col("path").alias("source"), F.when(F.col("length") > MAX_FILE_BYTES, F.lit("longer than a page file may be"))
        .otherwise(F.lit("could not be read")).alias("error"))
    return pages, damaged.unionByName(lost)


def read_page_texts(spark: SparkSession, path: str, pattern: str = "*.txt") -> DataFrame:
    """The pages of :func:`read_pages`; bad files are skipped, and reported
    through the log."""
    pages, errors = read_pages(spark, path, pattern)
    bad = errors.limit(20).collect()
    for r in bad:
        log.warning("page file skipped: %s: %s", r["source"], r["error"])
    return pages
