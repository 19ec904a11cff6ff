"""Exact quantiles per group, without sorting or shuffling the column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from clientlens.operators.summary import PERCENTILES, _pname, _value
from clientlens.session import checkpoint_dir


def describe_by(df: DataFrame, key: str, column: str, percentiles: Sequence[float] = PERCENTILES, accuracy: int = 10000,
                bracket_rows: int = 1_000_000) -> DataFrame:
    """key, count, mean, std (sample), min, exact linear percentiles, max of
    ``column`` for every value of ``key`` (null is one). Null and NaN are missing;
    a group without values has count 0 and nulls.

    1. One scan aggregates per group: the statistics and, from a fixed-size
       quantile sketch, a bracket of values around every target rank.
    2. One scan joins the rows to their group's brackets (a table of one row
       per group; Spark broadcasts it if it is small) and counts rows below and
       values inside them. Only values inside a bracket, about ``6 / accuracy``
       of the rows, are groups of their own; all else is a partial count per
       task, group and bracket. A running count finds the target ranks' values.

    While a group's bracket may hold more than ``bracket_rows`` rows, one more
    scan narrows all brackets by a sketch of their insides. Should a sketch miss
    a rank, that bracket is opened to the whole group and counted again. The
    tables between the scans are checkpointed (``spark.checkpoint.dir``); the
    driver sees the largest count and whether a rank is missing."""
    checkpoint_dir(df.sparkSession)
    probs, width = [float(p) for p in percentiles], 2.0 / accuracy
    asked = [f for p in probs for f in (max(0.0, p - width), min(1.0, p + width))]
    rows = df.select(F.col(key).alias("_g"), _value(column).alias("_x"))
    stats = rows.groupBy("_g").agg(F.count("_x").alias("count"), F.avg("_x").alias("mean"), F.stddev("_x").alias("std"),
                                   F.min("_x").alias("min"), F.max("_x").alias("max"),
                                   F.percentile_approx("_x", asked, accuracy).alias("_q")).checkpoint()

    def bracket(j: int, p: float) -> Column:
        at = (F.col("count") - 1) * F.lit(p)
        lo = F.col("min") if p <= width else F.col("_q")[2 * j]
        hi = F.col("max") if p >= 1 - width else F.col("_q")[2 * j + 1]
        return F.struct(F.lit(j).alias("j"), lo.alias("lo"), hi.alias("hi"), F.floor(at).alias("a"), F.ceil(at).alias("b"),
                        F.col("count").alias("n"))

    brackets = stats.where("count > 0").select("_g", F.inline(F.array(*[bracket(j, p) for j, p in enumerate(probs)]))) \
        if probs else None
    found = None
    if probs:
        most = 6 * (stats.agg(F.max("count")).first()[0] or 0) / accuracy
        while most > bracket_rows:
            brackets = _narrowed(rows, brackets, accuracy).checkpoint()
            most /= 32   # two of the grid's 64 steps
        found = _ranked(rows, brackets).checkpoint()
        missed = "va is null or vb is null"
        if found.where(missed).take(1):
            whole = stats.select(F.col("_g").alias("_h"), "min", "max")
            again = found.where(missed).join(whole, F.col("_g").eqNullSafe(F.col("_h"))) \
                .select("_g", "j", F.col("min").alias("lo"), F.col("max").alias("hi"), "a", "b", "n")
            found = found.where(f"not ({missed})").unionByName(_ranked(rows, again)).checkpoint()
    out = stats
    if probs:
        at = (F.col("n") - 1) * F.element_at(F.array(*[F.lit(p) for p in probs]), F.col("j") + 1)
        value = F.when(F.col("va") == F.col("vb"), F.col("va")).otherwise(F.col("va") + (F.col("vb") - F.col("va")) * (at - F.col("a")))
        wide = found.groupBy(F.col("_g").alias("_k")).agg(*[F.max(F.when(F.col("j") == j, value)).alias(_pname(p)) for j, p in enumerate(probs)])
        out = stats.join(wide, F.col("_g").eqNullSafe(F.col("_k")), "left")
    return out.select(F.col("_g").alias(key), "count", "mean", "std", "min", *[_pname(p) for p in probs], "max")


def _met(rows: DataFrame, brackets: DataFrame) -> DataFrame:
    """Every row at or below the upper end of a bracket of its group, with the
    bracket; ``v`` is its value if it lies inside."""
    per = brackets.groupBy("_g").agg(F.collect_list(F.struct("j", "lo", "hi")).alias("_b")) \
        .select(F.col("_g").alias("_h"), "_b")
    met = rows.where("_x is not null").join(per, F.col("_g").eqNullSafe(F.col("_h"))).select("_g", "_x", F.explode("_b").alias("_b"))
    return met.where("_x <= _b.hi").select("_g", F.col("_b.j").alias("j"), F.when(F.col("_x") >= F.col("_b.lo"), F.col("_x")).alias("v"))


def _same(a: DataFrame, b: DataFrame) -> DataFrame:
    """``a`` with ``b``'s columns for its (_g, j); ``b`` has them as _h, i."""
    return a.join(b, F.col("_g").eqNullSafe(F.col("_h")) & (F.col("j") == F.col("i")), "left").drop("_h", "i")


def _ranked(rows: DataFrame, brackets: DataFrame) -> DataFrame:
    """_g, j, a, b, n and the values va, vb at the ranks a and b (null if a
    bracket does not hold the rank)."""
    counts = _met(rows, brackets).groupBy(F.col("_g").alias("_h"), F.col("j").alias("i"), "v").agg(F.count(F.lit(1)).alias("c"))
    run = Window.partitionBy("_h", "i").orderBy(F.col("v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = counts.withColumn("end", F.sum("c").over(run)).where("v is not null")
    at = _same(brackets, counts)

    def value(rank: str) -> Column:
        return F.max(F.when((F.col(rank) >= F.col("end") - F.col("c")) & (F.col(rank) < F.col("end")), F.col("v")))
    return at.groupBy("_g", "j", "a", "b", "n").agg(value("a").alias("va"), value("b").alias("vb"))


def _narrowed(rows: DataFrame, brackets: DataFrame, accuracy: int) -> DataFrame:
    """Brackets drawn closer around their ranks by a sketch of their insides."""
    grid = [i / 64 for i in range(65)]
    inside = _met(rows, brackets).groupBy(F.col("_g").alias("_h"), F.col("j").alias("i")) \
        .agg(F.count(F.when(F.col("v").isNull(), 1)).alias("below"), F.count("v").alias("m"))
    placed = _same(brackets, inside)
    low, high = (F.col("a") - F.col("below")) / F.col("m") - 2.0 / accuracy, (F.col("b") + 1 - F.col("below")) / F.col("m") + 2.0 / accuracy
    fractions = placed.select("_g", "j", "lo", "hi", "a", "b", "n", low.alias("fl"), high.alias("fh"))
    # a sketch's fractions are constants: those of the grid around the wanted ones
    sketch = _met(rows, brackets).where("v is not null").groupBy(F.col("_g").alias("_h"), F.col("j").alias("i")) \
        .agg(F.percentile_approx("v", grid, accuracy).alias("q"))
    both = _same(fractions, sketch)
    lo = F.when(F.col("fl") <= 0, F.col("lo")).otherwise(F.get("q", F.floor(F.col("fl") * 64).cast("int")))
    hi = F.when(F.col("fh") >= 1, F.col("hi")).otherwise(F.get("q", F.ceil(F.col("fh") * 64).cast("int")))
    return both.select("_g", "j", F.coalesce(lo, "lo").alias("lo"), F.coalesce(hi, "hi").alias("hi"), "a", "b", "n")
