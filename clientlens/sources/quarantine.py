"""CSV with bad lines: good rows load, bad lines are kept apart with their
place, and a load with too many of them fails."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StringType, StructField, StructType

_BAD = "_bad_line"


class TooManyBadLines(ValueError):
    """A load whose bad lines pass a limit; the quarantine table is written."""


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """line text, its file, the split it is in and its place among the lines of
    its task (lines of a split are read in order by one task)."""
    return spark.read.text(path).select(
        F.col("value").alias("_line"), F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_split"), F.monotonically_increasing_id().alias("_at"))


def _parsed(lines: DataFrame, names: list[str], schema: StructType, date_format: str) -> DataFrame:
    kinds = {f.name: f.dataType for f in schema.fields}
    found = StructType([StructField(n, kinds.get(n, StringType())) for n in names] + [StructField(_BAD, StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD, "dateFormat": date_format}
    spec = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in found.fields)
    return lines.withColumn("_row", F.from_csv("_line", spec, options))


def load_csv(spark: SparkSession, path: str, schema: StructType, quarantine: str, max_bad: int | None = None,
             max_bad_share: float | None = None, date_format: str = "yyyy-MM-dd") -> DataFrame:
    """The rows of the CSV files at ``path`` that fit ``schema``; the others go to
    the table ``quarantine`` (Parquet, overwritten): file, line (from 1, the
    header included) and record.

    One row per line. The first line of every file is its header; columns are
    bound by name as in ``read_csv``, and a file whose header differs from the
    first one's is an error. A line is bad if a cell does not fit its type or
    the number of cells differs from the header's; blank lines are skipped. With
    more than ``max_bad`` bad lines, or more than ``max_bad_share`` of all
    lines, the load fails after the quarantine table is written.

    Lines are parsed in two scans: one finds the bad ones and counts, the result
    is the other. Line numbers cost no shuffle of lines: a bad line's place is
    its place in its task, less its split's first, plus the lines of the file's
    earlier splits - a table of one row per split."""
    names = spark.read.option("header", True).csv(path).columns   # reads the first line only
    missing = [f.name for f in schema.fields if f.name not in names]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}; its header is {', '.join(names)}")
    lines = _lines(spark, path)
    header = spark.read.text(path).first()[0]   # of the same first file as the names
    blank = F.length(F.trim("_line")) == 0
    like_header: Column = F.col("_line") == F.lit(header)
    parsed = _parsed(lines, names, schema, date_format)
    bad = F.col(f"_row.{_BAD}").isNotNull() & ~blank
    # every line that is no good row: bad ones, and those that read like the header
    odd = parsed.where(bad | like_header).select("_file", "_split", "_at", "_line")
    splits = lines.groupBy("_file", "_split").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"),
                                                  F.min_by("_line", "_at").alias("_top"))
    before = Window.partitionBy("_file").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    tops = splits.where("_split = 0").select("_file", "_top").where(F.col("_top") != F.lit(header))
    other = tops.take(1)
    if other:
        raise ValueError(f"{other[0]['_file']} has another header: {other[0]['_top']}")
    table = odd.join(splits, ["_file", "_split"]).select(
        F.col("_file").alias("file"), (F.col("_before") + F.col("_at") - F.col("_first") + 1).alias("line"), F.col("_line").alias("record"))
    table.where("line > 1").write.mode("overwrite").parquet(quarantine)
    n = spark.read.schema(table.schema).parquet(quarantine).count()
    if max_bad is not None and n > max_bad:
        raise TooManyBadLines(f"{n} bad lines in {path}, {max_bad} allowed; see {quarantine}")
    if max_bad_share is not None:
        every = splits.agg(F.sum("_n"), F.count(F.when(F.col("_split") == 0, 1))).first()
        if n > max_bad_share * max(1, (every[0] or 0) - every[1]):
            raise TooManyBadLines(f"{n} of {every[0] - every[1]} lines of {path} are bad, a share of {max_bad_share} allowed; see {quarantine}")
    good = parsed.where(F.col(f"_row.{_BAD}").isNull() & ~blank & ~like_header)
    return good.select(*[F.col("_row").getField(f.name).alias(f.name) for f in schema.fields])
