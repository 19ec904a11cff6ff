"""Tables laid out by key, so that later jobs on the key need no exchange."""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from clientlens.sources.files import Files

_ABOUT = "_layout.json"


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int, name: str, sort: str | None = None) -> str:
    """Write ``df`` as Parquet at ``path``, hashed by ``key`` into ``buckets``,
    rows of a bucket in order of ``key`` and ``sort``; overwrites. ``name`` is its
    table name in the session's catalog. The layout is noted in the folder, so
    that another application opens it by its path (``read_bucketed``).

    The rows are exchanged once, here, so that a bucket is one file. A client
    holding a large share of all rows makes its bucket as large: such tables
    should be left to the analyses' own exchanges."""
    order = [key, sort] if sort else [key]
    files = Files(df.sparkSession, path)
    files.remove(_ABOUT)
    (df.repartition(buckets, key).write.mode("overwrite").format("parquet").option("path", path)
       .bucketBy(buckets, key).sortBy(*order).saveAsTable(name))
    files.publish_text(_ABOUT, json.dumps({"key": key, "buckets": buckets, "sort": order, "schema": df.schema.json()}))
    return path


def read_bucketed(spark: SparkSession, path: str, name: str | None = None) -> DataFrame:
    """The table at ``path`` with its layout, registered in the session's
    catalog under ``name`` (default: made from the path) if it isn't yet."""
    about = json.loads(Files(spark, path).read_text(_ABOUT))
    name = name or "bucketed_" + re.sub(r"\W", "_", path)
    if not spark.catalog.tableExists(name):
        schema = StructType.fromJson(json.loads(about["schema"]))
        columns = ", ".join(f"{_q(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
        order = ", ".join(map(_q, about["sort"]))
        spark.sql(f"CREATE TABLE {_q(name)} ({columns}) USING parquet LOCATION '{path}' "
                  f"CLUSTERED BY ({_q(about['key'])}) SORTED BY ({order}) INTO {about['buckets']} BUCKETS")
    return spark.table(_q(name))


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
