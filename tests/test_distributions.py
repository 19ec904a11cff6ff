"""Bootstrap intervals, grouped quantiles and stored distinct-count sketches."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from clientlens.operators import (bootstrap_interval, bootstrap_sums, describe_by, distinct_from_sketches, distinct_per_period,
                                  distinct_sketches)
from clientlens.operators.bootstrap import PRIME, poisson_steps


# ---------------------------------------------------------------- bootstrap
def test_poisson_steps():
    steps = [0, *poisson_steps(), PRIME]
    share = np.diff(steps) / PRIME
    want = [math.exp(-1) / math.factorial(k) for k in range(len(share))]
    assert np.allclose(share[:-1], want[:-1], atol=1e-9) and sorted(steps) == steps


def _amounts(spark, n=4000):
    r = random.Random(3)
    rows = [(i, r.choice("ab") if i % 3 else "hot", r.lognormvariate(3, 1)) for i in range(n)]
    rows += [(n, "a", None), (n + 1, "a", float("nan")), (n + 2, None, 5.0), (n + 3, "none", None)]
    return spark.createDataFrame(rows, "id long, k string, x double"), rows


def test_bootstrap_is_deterministic_and_near_numpy_resampling(spark):
    df, rows = _amounts(spark)
    a = {r.k: r for r in bootstrap_interval(df.repartition(7), "k", "x", "id", replicates=300).collect()}
    b = {r.k: r for r in bootstrap_interval(df.orderBy(F.desc("id")).coalesce(1), "k", "x", "id", replicates=300).collect()}
    assert set(a) == {"hot", "a", "b", None}   # a group without values has no bar
    gen = np.random.default_rng(0)
    for k, r in a.items():
        assert (r.n, round(r.mean, 9), round(r.ci_low, 9), round(r.ci_high, 9)) == \
            (b[k].n, round(b[k].mean, 9), round(b[k].ci_low, 9), round(b[k].ci_high, 9))
        x = np.array([v for _, kk, v in rows if kk == k and v is not None and not math.isnan(v)])
        assert r.n == len(x) and r.mean == pytest.approx(x.mean())
        if len(x) > 1:
            means = x[gen.integers(0, len(x), (2000, len(x)))].mean(1)
            low, high = np.percentile(means, [2.5, 97.5])
            assert r.ci_low == pytest.approx(low, abs=0.25 * (high - low)) and r.ci_high == pytest.approx(high, abs=0.25 * (high - low))


def test_weights_are_independent_poisson(spark):
    df = spark.range(3000).selectExpr("id", "'k' as k", "1.0D as x")
    sums = bootstrap_sums(df, "k", "x", "id", replicates=400).where("replicate > 0").toPandas()
    z = (sums.weight - 3000) / math.sqrt(3000)
    assert abs(z.mean()) < 0.2 and 0.85 < z.std() < 1.15
    one = bootstrap_sums(spark.range(400).selectExpr("id", "id as k", "1.0D as x"), "k", "x", "id", replicates=200).toPandas()
    w = one[one.replicate > 0].pivot(index="k", columns="replicate", values="weight").fillna(0).to_numpy()
    corr = np.corrcoef(w.T)
    assert np.abs(corr[~np.eye(len(corr), dtype=bool)]).mean() < 0.06


def test_bootstrap_pre_aggregates(spark):
    df, _ = _amounts(spark, 300)
    plan = bootstrap_sums(df, "k", "x", "id")._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and "Python" not in plan


# ---------------------------------------------------------------- grouped quantiles
def _grouped(seed):
    r = random.Random(seed)
    rows = [("hot", r.gauss(0, 1)) for _ in range(5000)] + [("ties", float(r.randrange(4))) for _ in range(900)]
    rows += [(f"g{i}", r.random()) for i in range(6) for _ in range(i + 1)]
    return rows + [("one", 7.5), ("none", None), ("none", float("nan")), (None, 1.0), (None, 4.0), ("hot", None), ("inf", float("inf")), ("inf", 1.0)]


@pytest.mark.parametrize("accuracy, bracket_rows", [(10000, 10 ** 6), (100, 10 ** 6), (200, 20)])
def test_describe_by_equals_pandas(spark, accuracy, bracket_rows):
    rows = _grouped(accuracy)
    df = spark.createDataFrame(rows, "k string, x double").repartition(5)
    got = {r.k: r for r in describe_by(df, "k", "x", percentiles=(0.0, 0.25, 0.5, 0.9, 1.0), accuracy=accuracy,
                                       bracket_rows=bracket_rows).collect()}
    pdf = pd.DataFrame(rows, columns=["k", "x"])
    assert set(got) == set(pdf.k.where(pdf.k.notna(), None).unique())
    for k, r in got.items():
        x = pdf.x[pdf.k.isna() if k is None else pdf.k == k].dropna()
        assert r["count"] == len(x)
        for p, v in zip((0.0, 0.25, 0.5, 0.9, 1.0), (r.p0, r.p25, r.p50, r.p90, r.p100)):
            if not len(x):
                assert v is None and r["mean"] is None
            elif np.isfinite(x).all():
                assert v == pytest.approx(float(np.percentile(x, 100 * p)), rel=1e-12)


def test_describe_by_does_not_shuffle_the_column(spark):
    """Map tasks ship counts and the brackets' values, a small share of the rows."""
    import clientlens.operators.quantiles as q
    df = spark.range(200_000).selectExpr("id % 3 as k", "cast(hash(id) as double) as x")
    seen = []
    real = q._ranked

    def spy(rows, brackets):
        counts = q._met(rows, brackets).groupBy("_g", "j", "v").count()
        seen.append(counts.count())
        return real(rows, brackets)
    q._ranked = spy
    try:
        describe_by(df, "k", "x").collect()
    finally:
        q._ranked = real
    assert len(seen) == 1 and seen[0] < 200_000 * 3 * 10 / 10_000


# ---------------------------------------------------------------- sketches
def test_sketches_merge_over_periods(spark):
    r = random.Random(5)
    rows = [(d, r.randrange(20_000)) for d in range(30) for _ in range(3000)] + [(3, None), (31, None)]
    df = spark.createDataFrame(rows, "day int, u long").repartition(6)
    stored = distinct_sketches(df, F.col("day"), "u").checkpoint()
    exact = {x.period: x.n_distinct for x in distinct_per_period(df, F.col("day"), "u").collect()}
    for x in distinct_from_sketches(stored, F.col("period")).collect():
        assert abs(x.n_distinct - exact[x.period]) <= 5 * 1.04 / 64 * max(1, exact[x.period])
        assert x.rows == sum(1 for d, u in rows if d == x.period and u is not None)
    week = {x.week: x.n_distinct for x in distinct_from_sketches(stored, F.expr("period div 7"), "week").collect()}
    for w, n in week.items():
        true = len({u for d, u in rows if d // 7 == w and u is not None})
        assert abs(n - true) <= 5 * 1.04 / 64 * max(1, true)
    whole = distinct_from_sketches(stored).first().n_distinct
    assert abs(whole - len({u for _, u in rows if u is not None})) <= 5 * 1.04 / 64 * 20_000
    # any grouping of the days gives the same union
    assert distinct_from_sketches(stored.repartition(1)).first().n_distinct == whole
