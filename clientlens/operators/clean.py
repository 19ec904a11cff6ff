"""Cleaning: one row per key, null removal, distinct counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def dedupe(df: DataFrame, key: str | Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Keep the first row of each key under an explicit order.

    ``row_number() = 1`` is planned with a partial WindowGroupLimit before the
    shuffle, so each map task ships at most one row per key: a hot key costs
    one row per task, not its whole group.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if not order:
        raise ValueError("dedupe needs an explicit order; any-row dedupe is not reproducible")
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def latest_first(df: DataFrame, ts: str) -> list[Column]:
    """A total order of rows: the latest time first, rows without one last; the
    other columns break ties, so that which row is kept never depends on the
    partitioning (rows that agree in all columns are the same row)."""
    return [F.desc_nulls_last(ts), *[F.asc_nulls_last(c) for c in df.columns if c != ts]]


def drop_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a null in any column of ``subset`` (all columns by default)."""
    return df.na.drop(how="any", subset=list(subset) if subset else None)


def clean_customers(df: DataFrame, key: str | Sequence[str], order: Sequence[Column | str],
                    subset: Sequence[str] | None = None, complete_first: bool = False) -> DataFrame:
    """Dedupe then drop nulls (the reference order: a key whose kept row has a
    null disappears). ``complete_first=True`` drops incomplete rows first, so a
    key keeps its first complete row instead."""
    if complete_first:
        return dedupe(drop_nulls(df, subset), key, order)
    return drop_nulls(dedupe(df, key, order), subset)


def distinct_count(df: DataFrame, col: str, alias: str | None = None, approx: bool = False) -> DataFrame:
    """Number of distinct non-null values of ``col`` as a one-row DataFrame.

    Exact: a two-level aggregation (distinct values first, partial per task);
    ``approx=True`` uses a HyperLogLog++ sketch of fixed size.
    """
    name = alias or f"n_{col}"
    f = F.approx_count_distinct(col) if approx else F.countDistinct(col)
    return df.agg(f.alias(name))


def distinct_sketches(df: DataFrame, period: Column, col: str, lg_k: int = 12) -> DataFrame:
    """period, sketch, rows: a mergeable HyperLogLog sketch (at most 2^lg_k
    bytes) of the non-null values of ``col`` in every period, for storing. A
    period is sketched once; counts over any periods come from their sketches."""
    return df.groupBy(period.alias("period")).agg(F.hll_sketch_agg(F.col(col), F.lit(lg_k)).alias("sketch"),
                                                  F.count(col).alias("rows"))


def distinct_from_sketches(sketches: DataFrame, by: Column | None = None, name: str = "period") -> DataFrame:
    """Distinct values over stored sketches, per ``by`` (a coarser period, say) or
    over all: n_distinct (relative standard error about 1.04 / sqrt(2^lg_k),
    1.6 % at 12) and rows. Reads sketches only, never the rows behind them."""
    aggs = [F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_distinct"), F.sum("rows").alias("rows")]
    return sketches.agg(*aggs) if by is None else sketches.groupBy(by.alias(name)).agg(*aggs)


def distinct_per_period(df: DataFrame, period: Column, col: str) -> DataFrame:
    """period, n_distinct: the exact counts beside the sketched ones."""
    return df.groupBy(period.alias("period")).agg(F.countDistinct(col).alias("n_distinct"))
