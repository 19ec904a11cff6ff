"""Distribution summaries and per-customer summaries (the data behind charts)."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from clientlens.roles import Roles

PERCENTILES = (0.25, 0.5, 0.75)


# ---------------------------------------------------------------- describe
def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _value(name: str):
    """A column as double; null and NaN are missing values, as in pandas."""
    x = F.col(_quoted(name)).cast("double")
    return F.when(~F.isnan(x), x)


def _pname(p: float) -> str:
    return "p" + f"{p * 100:g}".replace(".", "_")


def describe(df: DataFrame, columns: Sequence[str], percentiles: Sequence[float] = PERCENTILES,
             accuracy: int = 10000, bracket_rows: int = 1_000_000, approx: bool = False) -> DataFrame:
    """count, mean, std (sample), min, exact linear percentiles, max per column.

    Long form, one row per column (``variable``). The percentiles are exact
    (linear interpolation between order statistics, as pandas ``describe``) and
    need no sort and no shuffle of the column:

    1. one scan gives count, mean, std, min, max and, from a fixed-size quantile
       sketch per column, a bracket of values around every target rank (about
       ``6 / accuracy`` of the rows lie in one);
    2. one scan counts the rows below, between and inside the brackets. Only
       values inside are kept apart, so what is shuffled is a partial count per
       task and segment plus the brackets' values; a running count over them
       finds the values of the target ranks.

    While a bracket may hold more than ``bracket_rows`` rows (past 1.6e9 rows of
    input at the defaults), step 1 is repeated inside the brackets, which
    narrows each by a factor of about ``accuracy / 6``; all sizes take the same
    path. The driver holds one row of statistics. The jobs run while the result
    is built; it is a local table of one row per column.

    ``approx=True`` stops after the first scan and takes the percentiles from
    the sketch (rank error about n / ``accuracy``).
    """
    cols, probs = list(columns), [float(p) for p in percentiles]
    spark, width = df.sparkSession, 2.0 / accuracy
    asked = [f for p in probs for f in (max(0.0, p - width), p, min(1.0, p + width))]
    aggs = [e for c in cols for e in (F.count(_value(c)), F.avg(_value(c)), F.stddev(_value(c)), F.min(_value(c)),
                                      F.max(_value(c)), F.percentile_approx(_value(c), asked, accuracy))]
    flat = df.agg(*[e.alias(f"_{i}") for i, e in enumerate(aggs)]).first()
    stats = [flat[6 * i:6 * i + 6] for i in range(len(cols))]

    found: dict[tuple[int, int], float] = {}
    if approx:
        quant = {(i, j): s[5][3 * j + 1] for i, s in enumerate(stats) if s[0] for j in range(len(probs))}
    else:
        brackets = []   # [column, low, high, target ranks]
        for i, (n, _, _, lo, hi, q) in enumerate(stats):
            for j, p in enumerate(probs if n else ()):
                pos = (n - 1) * p
                brackets.append([i, lo if p <= width else q[3 * j], hi if p >= 1 - width else q[3 * j + 2],
                                 {math.floor(pos), math.ceil(pos)}])
        size = {i: 6 * s[0] / accuracy for i, s in enumerate(stats)}
        while brackets and max(size[b[0]] for b in brackets) > bracket_rows:
            narrower = _narrowed(df, cols, brackets, accuracy)
            if narrower == brackets:   # a few values hold all the rows: they are one group each below
                break
            brackets = narrower
            size = {i: 6 * v / accuracy for i, v in size.items()}
        while brackets:
            found |= _ranked(df, cols, brackets)
            brackets = [b for b in brackets if any((b[0], t) not in found for t in b[3])]
            for b in brackets:   # the sketch missed a rank: look in the whole column
                b[1], b[2] = stats[b[0]][3], stats[b[0]][4]
        quant = {}
        for i, s in enumerate(stats):
            for j, p in enumerate(probs if s[0] else ()):
                pos = (s[0] - 1) * p
                a, b = found[(i, math.floor(pos))], found[(i, math.ceil(pos))]
                quant[(i, j)] = a if a == b else a + (b - a) * (pos - math.floor(pos))
    rows = [(c, int(s[0]), s[1], s[2], s[3], *[quant.get((i, j)) for j in range(len(probs))], s[4])
            for i, (c, s) in enumerate(zip(cols, stats))]
    kinds = ", ".join(f"{n} double" for n in ("mean", "std", "min", *map(_pname, probs), "max"))
    return spark.createDataFrame(rows, f"variable string, count long, {kinds}")


def _segments(brackets: Sequence[list]) -> dict[int, list[tuple[float, float]]]:
    """Per column, the brackets as disjoint ascending ranges."""
    out: dict[int, list[tuple[float, float]]] = {}
    for i, lo, hi, _ in sorted(brackets, key=lambda b: (b[0], b[1], b[2])):
        have = out.setdefault(i, [])
        if have and lo <= have[-1][1]:
            have[-1] = (have[-1][0], max(have[-1][1], hi))
        else:
            have.append((lo, hi))
    return out


def _ranked(df: DataFrame, cols: Sequence[str], brackets: Sequence[list]) -> dict[tuple[int, int], float]:
    """{(column, rank): value} of the target ranks that lie in the brackets.
    Segments alternate: below a bracket (even, only counted), inside it (odd,
    one group per value)."""
    ranges, want = _segments(brackets), {}
    for i, _, _, ranks in brackets:
        want.setdefault(i, set()).update(ranks)
    rows = []
    for i, parts in ranges.items():
        x, seg = _value(cols[i]), F.lit(2 * len(parts))
        for k in range(len(parts) - 1, -1, -1):
            lo, hi = parts[k]
            seg = F.when(x < F.lit(lo), 2 * k).when(x <= F.lit(hi), 2 * k + 1).otherwise(seg)
        rows.append(F.struct(F.lit(i).alias("v"), seg.cast("int").alias("seg"), x.alias("x")))
    long = df.select(F.inline(F.array(*rows))).where("x IS NOT NULL")
    counts = long.groupBy("v", "seg", F.when(F.col("seg") % 2 == 1, F.col("x")).alias("x")).agg(F.count(F.lit(1)).alias("n"))
    run = Window.partitionBy("v").orderBy("seg", "x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    targets = F.element_at(F.create_map(*[e for i, r in want.items() for e in (
        F.lit(i), F.array(*[F.lit(t).cast("long") for t in sorted(r)]))]), F.col("v"))
    ends = counts.withColumn("end", F.sum("n").over(run)).where("seg % 2 = 1")
    hits = ends.select("v", "x", F.explode(F.filter(targets, lambda t: (t >= F.col("end") - F.col("n")) & (t < F.col("end")))).alias("t"))
    return {(r.v, r.t): r.x for r in hits.collect()}   # one row per column and target rank


def _narrowed(df: DataFrame, cols: Sequence[str], brackets: Sequence[list], accuracy: int) -> list[list]:
    """The brackets drawn closer around their ranks: one scan counts the rows
    below and inside each, another sketches the values inside."""
    def inside(b):
        x = _value(cols[b[0]])
        return F.when((x >= F.lit(b[1])) & (x <= F.lit(b[2])), x)

    counted = df.agg(*[e.alias(f"_{k}_{m}") for k, b in enumerate(brackets) for m, e in enumerate((
        F.count(F.when(_value(cols[b[0]]) < F.lit(b[1]), 1)), F.count(inside(b))))]).first()
    asked = []
    for k, b in enumerate(brackets):
        below, m = counted[2 * k], max(1, counted[2 * k + 1])
        lo, hi = ((t - below) / m for t in (min(b[3]), max(b[3]) + 1))
        asked.append((lo - 2 / accuracy, hi + 2 / accuracy))
    got = df.agg(*[F.percentile_approx(inside(b), [min(1.0, max(0.0, f)) for f in fr], accuracy).alias(f"_{k}")
                   for k, (b, fr) in enumerate(zip(brackets, asked))]).first()
    out = []
    for b, fr, q in zip(brackets, asked, got):
        out.append([b[0], b[1] if fr[0] <= 0 or not q else q[0], b[2] if fr[1] >= 1 or not q else q[1], b[3]])
    return out


# ---------------------------------------------------------------- histogram
def histogram(df: DataFrame, col: str, bins: int = 20) -> DataFrame:
    """``bins`` equal-width bins over [min, max], the last bin closed; all bins
    are returned, empty ones with count 0. Bin of x: ``floor((x-lo)*bins/(hi-lo))``
    capped at ``bins-1``. When min = max the range is widened by 0.5 on both
    sides (numpy's rule), so the single value lands in the middle bin. Null and
    NaN are missing; the range is that of the finite values, and -inf counts in
    the first bin, inf in the last.

    min/max are one aggregated row (collected while the plan is built: two
    numbers), so the counting pass is a single scan with a partial aggregation
    on the bin number; the bin axis is ``bins`` rows. Rows come in bin order.
    """
    x, top = _value(col), float("inf")
    finite = F.when((x > -top) & (x < top), x)
    lo0, hi0 = df.select(F.min(finite), F.max(finite)).first()
    lo, hi = (0.0, 1.0) if lo0 is None else (lo0, hi0) if hi0 > lo0 else (lo0 - 0.5, hi0 + 0.5)
    scale = float(bins) / (hi - lo)
    width = (hi - lo) / float(bins)
    b = F.when(x == -top, 0).when(x == top, bins - 1) \
         .otherwise(F.least(F.floor((x - F.lit(lo)) * F.lit(scale)), F.lit(bins - 1))).cast("int")
    counts = df.where(x.isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    axis = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    edge = (lambda e: F.lit(None).cast("double")) if lo0 is None else (lambda e: e)   # no finite value: no edges
    return (axis.join(F.broadcast(counts), "bin", "left")   # counts: <= bins rows
                .select("bin",
                        edge(F.lit(lo) + F.col("bin") * F.lit(width)).alias("bin_start"),
                        edge(F.when(F.col("bin") == bins - 1, F.lit(hi))
                              .otherwise(F.lit(lo) + (F.col("bin") + 1) * F.lit(width))).alias("bin_end"),
                        F.coalesce(F.col("count"), F.lit(0).cast("long")).alias("count"))
                .orderBy("bin"))


# ---------------------------------------------------------------- bar data
def mean_interval(df: DataFrame, key: str, value: str, z: float = 1.96) -> DataFrame:
    """Per key: n, mean, sample std and the normal interval mean +- z*sd/sqrt(n)."""
    half = F.lit(z) * F.col("std") / F.sqrt(F.col("n"))
    return (df.groupBy(key).agg(F.count(value).alias("n"), F.avg(value).alias("mean"),
                                F.stddev(value).alias("std"))
              .withColumn("ci_low", F.col("mean") - half)
              .withColumn("ci_high", F.col("mean") + half))


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str],
         var: str = "metric", val: str = "value") -> DataFrame:
    """Wide to long (values cast to double so they share one column)."""
    casted = df.select(*ids, *[F.col(v).cast("double").alias(v) for v in values])
    return casted.unpivot(list(ids), list(values), var, val)


# ---------------------------------------------------------------- per-customer summary
def customer_summary(df: DataFrame, r: Roles) -> DataFrame:
    """``customer_id, category, total_amount, purchase_count``: one row per
    (client, category), the input of the spending analyses."""
    return (df.groupBy(F.col(r.client).alias("customer_id"), F.col(r.category).alias("category"))
              .agg(F.sum(r.amount).alias("total_amount"),
                   F.count(F.lit(1)).alias("purchase_count")))


def category_spending(summary: DataFrame) -> DataFrame:
    """Per non-null category: mean, sum and count of ``total_amount``, mean of
    ``purchase_count``, rounded half-to-even to 2 decimals, sorted by category."""
    return (summary.where(F.col("category").isNotNull())
                   .groupBy("category")
                   .agg(F.bround(F.avg("total_amount"), 2).alias("total_amount_mean"),
                        F.bround(F.coalesce(F.sum("total_amount"), F.lit(0.0)), 2).alias("total_amount_sum"),
                        F.count("total_amount").alias("total_amount_count"),
                        F.bround(F.avg("purchase_count"), 2).alias("purchase_count_mean"))
                   .orderBy("category"))


def top_customers(summary: DataFrame, n: int = 10, by: str = "total_amount") -> DataFrame:
    """The ``n`` largest rows by ``by`` (nulls last; ties by customer, category).
    Planned as TakeOrderedAndProject: each task keeps its own top n."""
    return (summary.orderBy(F.desc_nulls_last(by), F.asc_nulls_last("customer_id"),
                            F.asc_nulls_last("category"))
                   .limit(n)
                   .select("customer_id", "category", "total_amount", "purchase_count"))


def scatter_points(summary: DataFrame, fraction: float = 1.0, seed: int = 42) -> DataFrame:
    """Points (purchase_count, total_amount, category); ``fraction < 1`` draws a
    Bernoulli sample for plotting (the sampling is the feature)."""
    pts = summary.select("purchase_count", "total_amount", "category")
    return pts if fraction >= 1.0 else pts.sample(fraction=fraction, seed=seed)


def global_stats(summary: DataFrame, with_time: bool = False) -> DataFrame:
    """One row: transactions, distinct categories and customers, mean/max/min spending."""
    out = summary.agg(F.count(F.lit(1)).alias("total_transactions"),
                      F.countDistinct("category").alias("unique_categories"),
                      F.countDistinct("customer_id").alias("unique_customers"),
                      F.avg("total_amount").alias("average_spending"),
                      F.max("total_amount").alias("max_spending"),
                      F.min("total_amount").alias("min_spending"))
    if with_time:
        out = out.withColumn("generated_at", F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss"))
    return out
