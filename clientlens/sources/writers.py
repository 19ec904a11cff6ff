"""Sinks: named tables to parquet/JSON folders, overwrite semantics."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame


def write_tables(tables: Mapping[str, DataFrame], out: str, fmt: str = "parquet",
                 partition_by: Mapping[str, list[str]] | None = None,
                 order_by: Mapping[str, str] | None = None) -> dict[str, str]:
    """Write each DataFrame to ``<out>/<name>`` (overwrite), one folder per table.

    Written by the executors in parallel; the driver only commits. A table in
    ``order_by`` is chart data (a row per bar or point): it is written as one
    file in the order of that column. Returns the paths written.
    """
    paths = {}
    for name, df in tables.items():
        if name in (order_by or {}):
            df = df.coalesce(1).sortWithinPartitions(order_by[name])
        w = df.write.mode("overwrite").format(fmt)
        cols = (partition_by or {}).get(name)
        if cols:
            w = w.partitionBy(*cols)
        p = f"{out.rstrip('/')}/{name}"
        w.save(p)
        paths[name] = p
    return paths


def write_one_row_json(df: DataFrame, path: str) -> str:
    """A one-row statistics DataFrame as a single JSON-lines file (overwrite).

    ``coalesce(1)`` is safe here only because the input is one aggregated row.
    """
    df.coalesce(1).write.mode("overwrite").json(path)
    return path
