"""Readers. Paths are URIs (hdfs://, gs://, s3a://, file:); the file system
connector is session configuration, never hard-coded here."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType


def read_csv(spark: SparkSession, path: str, schema: StructType | None = None,
             header: bool = True, infer: bool = False, date_format: str = "yyyy-MM-dd",
             malformed: str = "FAILFAST") -> DataFrame:
    """CSV, one row per line. With a schema nothing is inferred (one pass less).

    A file with a header is bound by its names: the columns of the schema are
    taken wherever they stand, others are ignored, a missing one is an error,
    and so is a second file whose header differs from the first's. A cell that
    does not fit its type fails the job (``malformed="PERMISSIVE"`` reads it as
    null instead). ``infer=True`` reproduces ``inferSchema`` for ad-hoc files."""
    r = spark.read.option("header", header).option("dateFormat", date_format)
    if schema is None:
        return (r.option("inferSchema", True) if infer else r).csv(path)
    r = r.option("mode", malformed)
    if not header:
        return r.schema(schema).csv(path)
    names = spark.read.option("header", True).csv(path).columns   # reads the first line only
    missing = [f.name for f in schema.fields if f.name not in names]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}; its header is {', '.join(names)}")
    kinds = {f.name: f.dataType for f in schema.fields}
    found = StructType([StructField(n, kinds.get(n, StringType())) for n in names])
    return r.option("enforceSchema", False).schema(found).csv(path).select(*[f.name for f in schema.fields])


def read_json_lines(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """One JSON object per line, split across tasks like any text file."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
