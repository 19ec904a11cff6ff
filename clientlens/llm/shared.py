"""Helpers of the training-data operators: shared scratch folder, table
reading, learning folds, Arrow batching.

Scratch tables go to the folder that the cluster names in
``spark.checkpoint.dir`` (shared by driver and executors). Only a local master
without that setting (tests) gets a folder of its own; a cluster without it is
an error, because a machine-local folder would lose blocks with its executor.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: words of the contracts: runs of anything but ASCII white space (Java regex)
WORD = r"[^\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: the same mapping for Python's str.translate
ASCII_LOWER = {ord(u): ord(l) for u, l in zip(_UPPER, _LOWER)}


def shared_dir(spark: SparkSession) -> str:
    """The shared folder: ``spark.checkpoint.dir``, else the context's
    checkpoint folder, else (local master only) a folder made for the session."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d.rstrip("/")
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="clientlens-llm-"))
    return sc.getCheckpointDir().rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path for one scratch table, under ``<shared>/llm/<application>``."""
    return f"{shared_dir(spark)}/llm/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts the
    lineage in a way that survives the loss of executors."""
    spark = df.sparkSession
    path = path or scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """At most ``rows`` texts in a batch sent to Python (Spark's default is
    10,000, which long texts turn into more memory than a worker should hold).
    A smaller setting of the session stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold(doc_id: Column | str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null ids give null."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(c.cast("string").cast("binary")) % folds


def held_out(doc_id: Column | str, folds: int) -> Column:
    """True in fold 1; a null id is never held out."""
    return F.coalesce(fold(doc_id, folds) == 1, F.lit(False))


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased, every other character kept."""
    return F.translate(c, _UPPER, _LOWER)


def temp_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have (case-insensitively)."""
    have = {c.lower() for c in df.columns}
    name = f"__{base}"
    while name.lower() in have:
        name = f"_{name}"
    return name


def text_blocks(texts, max_chars: int = 2_000_000):
    """Split a list of texts (None allowed) into runs of bounded total length;
    a single longer text is a run of its own. Yields (start, texts)."""
    start, total = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if i > start and total + n > max_chars:
            yield start, texts[start:i]
            start, total = i, 0
        total += n
    if start < len(texts):
        yield start, texts[start:]
