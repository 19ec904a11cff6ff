"""Bootstrap intervals of group means in one pass (the error bars of a bar chart)."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

#: modulus of the weights' generator: a prime whose squares fit a long
PRIME = 2_147_483_647


def poisson_steps(prime: int = PRIME) -> list[int]:
    """A uniform number below ``prime`` has as many of these at or below it as
    a Poisson variable of mean 1 counts."""
    steps, term, total = [], math.exp(-1), 0.0
    for k in range(1, 40):
        total += term
        step = round(total * prime)
        if step >= prime:
            break
        steps.append(step)
        term /= k
    return steps


def _weighted(rows: DataFrame) -> DataFrame:
    """``rows`` with the Poisson(1) weight ``_w`` of (row, replicate), from the
    row's two 28-bit seeds: integer arithmetic only, so every engine and
    partitioning agrees. Replicate 0 weighs 1. A column a step, since each step
    uses the last one twice."""
    p = F.lit(PRIME).cast("long")
    r, x = F.col("replicate"), F.col("_u")
    rows = rows.withColumn("_u", (F.col("_a") + r * F.col("_b")) % p)
    rows = rows.withColumn("_u", (x * x + F.col("_a") + r * 48_271) % p)
    rows = rows.withColumn("_u", (x * x + F.col("_b") + r * 69_621) % p)
    steps = poisson_steps()
    weight = F.lit(len(steps))
    for k in range(len(steps) - 1, -1, -1):
        weight = F.when(x < steps[k], k).otherwise(weight)
    return rows.withColumn("_w", F.when(r == 0, 1).otherwise(weight))


def bootstrap_sums(df: DataFrame, key: str, value: str, row_id: str, replicates: int = 200, seed: int = 0) -> DataFrame:
    """key, replicate, weight, total: for each replicate the sums of the rows'
    weights and weighted values; replicate 0 is the data itself. Null and NaN
    values are missing.

    A replicate draws every row a Poisson(1) number of times, the limit of
    drawing n of n rows with replacement, and needs no n: rows are weighted
    where they are read. The weights come from the md5 of ``row_id`` (a unique
    column) and ``seed``, so a result does not depend on the partitioning. Map
    tasks ship one row per key and replicate, whatever a key's size."""
    x = F.col(value).cast("double")
    h = F.md5(F.concat(F.lit(f"{seed}|"), F.col(row_id).cast("string")).cast("binary"))
    part = lambda i: F.conv(F.substring(h, i, 7), 16, 10).cast("long")
    rows = df.where(x.isNotNull() & ~F.isnan(x)).select(F.col(key).alias(key), x.alias("_x"), part(1).alias("_a"), part(8).alias("_b"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(replicates).cast("long"))).alias("replicate"))
    return (_weighted(rows).where("_w > 0").groupBy(key, "replicate")
                .agg(F.sum("_w").cast("long").alias("weight"), F.sum(F.col("_w") * F.col("_x")).alias("total")))


def bootstrap_interval(df: DataFrame, key: str, value: str, row_id: str, replicates: int = 200, level: float = 0.95,
                       seed: int = 0) -> DataFrame:
    """key, n, mean, ci_low, ci_high: the percentile interval of the
    replicates' means (linear between order statistics)."""
    sums = bootstrap_sums(df, key, value, row_id, replicates, seed)
    tail = (1 - level) / 2
    mean = F.col("total") / F.col("weight")
    drawn = F.when(F.col("replicate") > 0, mean)
    return sums.groupBy(key).agg(F.max(F.when(F.col("replicate") == 0, F.col("weight"))).alias("n"),
                                 F.max(F.when(F.col("replicate") == 0, mean)).alias("mean"),
                                 F.percentile(drawn, F.lit(tail)).alias("ci_low"),
                                 F.percentile(drawn, F.lit(1 - tail)).alias("ci_high"))
