"""Distribution summaries against numpy/pandas computed on the same rows."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from clientlens.operators import (category_spending, describe, global_stats, histogram, mean_interval,
                                  melt, scatter_points, top_customers)
from clientlens.sources import CUSTOMER_SUMMARY


def _pandas_describe(values):
    s = pd.Series(values, dtype="float64").dropna()
    d = s.describe()
    return [d["count"], d["mean"], d["std"], d["min"], d["25%"], d["50%"], d["75%"], d["max"]]


@pytest.mark.parametrize("accuracy, rows", [(10, 1), (40, 5), (10000, 1_000_000)])
def test_describe_matches_pandas(spark, accuracy, rows):
    rng = np.random.default_rng(3)
    a = [float(v) for v in rng.integers(0, 20, 500)]       # many ties
    b = [float(v) for v in np.round(rng.exponential(10, 500), 3)]  # skewed
    b[::50] = [None] * 10
    c = [7.0] * 500                                         # one hot value
    df = spark.createDataFrame(list(zip(a, b, c)), "a double, b double, c double")
    out = {r["variable"]: r for r in describe(df, ["a", "b", "c"], accuracy=accuracy, bracket_rows=rows).collect()}
    for name, vals in (("a", a), ("b", b), ("c", c)):
        want = _pandas_describe(vals)
        r = out[name]
        got = [r["count"], r["mean"], r["std"], r["min"], r["p25"], r["p50"], r["p75"], r["max"]]
        assert got == pytest.approx(want, rel=1e-9, abs=1e-9), name


def test_describe_small_and_null_columns(spark):
    df = spark.createDataFrame([(1.0, None), (None, None)], "x double, y double")
    out = {r["variable"]: r for r in describe(df, ["x", "y"]).collect()}
    assert out["x"]["count"] == 1 and out["x"]["p50"] == 1.0 and out["x"]["std"] is None
    assert out["y"]["count"] == 0 and out["y"]["mean"] is None


def test_describe_odd_column_names(spark):
    names = ["l'âge", "a.b", "c`d", "e \"f\""]
    df = spark.createDataFrame([(float(i), float(-i), 1.0, float(i * i)) for i in range(9)], names)
    out = {r["variable"]: r["p50"] for r in describe(df, names).collect()}
    assert out == {names[0]: 4.0, names[1]: -4.0, names[2]: 1.0, names[3]: 16.0}


def test_describe_shuffles_brackets_only(spark):
    """100,000 distinct values: what crosses the shuffle is the brackets' share."""
    df = spark.range(100_000).select((F.col("id") * 7919 % 100_003).cast("double").alias("v")).repartition(4)
    import clientlens.operators.summary as m
    seen, real = [], m._ranked

    def spy(d, cols, brackets):
        seen.extend(brackets)
        return real(d, cols, brackets)
    m._ranked = spy
    try:
        r = describe(df, ["v"]).first()
    finally:
        m._ranked = real
    vals = [i * 7919 % 100_003 for i in range(100_000)]
    assert [r["p25"], r["p50"], r["p75"]] == pytest.approx(list(np.percentile(vals, [25, 50, 75])))
    assert len(seen) == 3 and all(hi - lo < 200 for _, lo, hi, _ in seen)


def test_describe_hot_values_at_the_bracket_ends(spark):
    vals = [0.0] * 300 + [float(i) / 7 for i in range(50)] + [9.0] * 400 + [float("-inf")] * 3
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    for accuracy, rows in ((10, 1), (10000, 10)):
        r = describe(df, ["v"], percentiles=(0.0, 0.1, 0.43, 0.5, 0.999, 1.0), accuracy=accuracy, bracket_rows=rows).first()
        s = sorted(vals)
        at = lambda p: s[math.floor((len(s) - 1) * p)], lambda p: s[math.ceil((len(s) - 1) * p)]
        for p, name in ((0.0, "p0"), (0.1, "p10"), (0.43, "p43"), (0.5, "p50"), (0.999, "p99_9"), (1.0, "p100")):
            assert at[0](p) <= r[name] <= at[1](p)


def test_histogram_matches_numpy(spark):
    vals = list(np.round(np.random.default_rng(1).normal(50, 20, 2000), 2))
    df = spark.createDataFrame([(float(v),) for v in vals] + [(None,)], "v double")
    out = histogram(df, "v", 20).collect()
    counts, edges = np.histogram(vals, bins=20)
    assert [r["count"] for r in out] == list(counts)
    assert [r["bin_start"] for r in out] == pytest.approx(list(edges[:-1]))
    assert out[-1]["bin_end"] == max(vals)


def test_histogram_single_value_and_empty_bins(spark):
    df = spark.createDataFrame([(5.0,), (5.0,)], "v double")
    out = histogram(df, "v", 20).collect()
    counts, _ = np.histogram([5.0, 5.0], bins=20)
    assert [r["count"] for r in out] == list(counts)
    df2 = spark.createDataFrame([(0.0,), (10.0,)], "v double")
    out2 = histogram(df2, "v", 10).collect()
    assert len(out2) == 10 and [r["count"] for r in out2] == [1] + [0] * 8 + [1]


def test_mean_interval(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 2.0)], "k string, v double")
    out = {r["k"]: r for r in mean_interval(df, "k", "v").collect()}
    assert out["a"]["mean"] == 2.0 and out["a"]["ci_low"] == pytest.approx(2.0 - 1.96 * np.sqrt(2) / np.sqrt(2))
    assert out["b"]["std"] is None and out["b"]["ci_high"] is None


@pytest.fixture(scope="module")
def summary(spark):
    rows = [(f"u{i:02d}", "abc"[i % 3], float(100 - i), i + 1) for i in range(14)]
    rows += [("u90", "a", 92.0, 3),            # ties u08's 92.0 at rank 10/11
             ("u91", None, 500.0, 2),          # null category
             ("u92", "b", None, 4),            # null amount
             ("u93", "c", 0.005, 1)]           # half a cent
    return spark.createDataFrame(rows, CUSTOMER_SUMMARY).cache()


def test_category_spending_matches_pandas(summary):
    pdf = summary.toPandas()
    want = pdf.groupby("category").agg({"total_amount": ["mean", "sum", "count"],
                                        "purchase_count": "mean"}).round(2)
    got = category_spending(summary).collect()
    assert [r["category"] for r in got] == list(want.index)
    for r in got:
        w = want.loc[r["category"]]
        assert r["total_amount_mean"] == pytest.approx(w[("total_amount", "mean")])
        assert r["total_amount_sum"] == pytest.approx(w[("total_amount", "sum")])
        assert r["total_amount_count"] == w[("total_amount", "count")]
        assert r["purchase_count_mean"] == pytest.approx(w[("purchase_count", "mean")])


def test_top_customers(summary):
    got = top_customers(summary, 10).collect()
    assert len(got) == 10
    assert got[0]["customer_id"] == "u91" and got[0]["total_amount"] == 500.0
    amounts = [r["total_amount"] for r in got]
    assert amounts == sorted(amounts, reverse=True)
    # tie at 92.0 between u08 and u90 for the last place: resolved by customer id
    assert [r["customer_id"] for r in got if r["total_amount"] == 92.0] == ["u08"]


def test_global_stats_and_scatter(summary):
    r = global_stats(summary, with_time=True).first()
    assert r["total_transactions"] == 18 and r["unique_categories"] == 3 and r["unique_customers"] == 18
    assert r["max_spending"] == 500.0 and r["min_spending"] == 0.005
    assert len(r["generated_at"]) == 19
    assert scatter_points(summary).count() == 18


def test_melt(spark):
    df = spark.createDataFrame([(0, 30.0, 100.0), (1, 40.0, 200.0)], "cluster int, age_moyen double, montant_moyen double")
    got = sorted(tuple(r) for r in melt(df, ["cluster"], ["age_moyen", "montant_moyen"]).collect())
    assert got == [(0, "age_moyen", 30.0), (0, "montant_moyen", 100.0), (1, "age_moyen", 40.0),
                   (1, "montant_moyen", 200.0)]


def test_describe_approx(spark):
    vals = [float(v) for v in np.random.default_rng(5).normal(0, 1, 3000)]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    a = describe(df, ["v"], approx=True).first()
    e = describe(df, ["v"]).first()
    assert a["count"] == e["count"] == 3000 and a["mean"] == pytest.approx(e["mean"])
    assert a["std"] == pytest.approx(e["std"]) and (a["min"], a["max"]) == (e["min"], e["max"])
    srt = sorted(vals)
    for p, name in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75")):
        rank = srt.index(a[name])            # the sketch returns an input value
        assert abs(rank - p * 2999) <= 3000 / 10000 + 2


def test_category_spending_half_cent_means_round_half_even(spark):
    # category means 0.125 and 0.375 (exact in binary): half-to-even gives 0.12 and 0.38, as pandas
    rows = [("u1", "x", 0.125, 1), ("u2", "x", 0.125, 1), ("u3", "y", 0.25, 1), ("u4", "y", 0.5, 2)]
    df = spark.createDataFrame(rows, CUSTOMER_SUMMARY)
    got = {r["category"]: (r["total_amount_mean"], r["purchase_count_mean"]) for r in category_spending(df).collect()}
    pdf = df.toPandas().groupby("category").agg({"total_amount": "mean", "purchase_count": "mean"}).round(2)
    assert got == {"x": (0.12, 1.0), "y": (0.38, 1.5)}
    assert got == {k: (pdf.loc[k, "total_amount"], pdf.loc[k, "purchase_count"]) for k in ("x", "y")}


def test_describe_narrows_large_brackets(spark):
    # sketches of 12 values and brackets of one row: several rounds of narrowing
    vals = [float(v) for v in np.random.default_rng(8).integers(0, 500, 1500)]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    r = describe(df, ["v"], accuracy=12, bracket_rows=1).first()
    want = _pandas_describe(vals)
    got = [r["count"], r["mean"], r["std"], r["min"], r["p25"], r["p50"], r["p75"], r["max"]]
    assert got == pytest.approx(want, rel=1e-9, abs=1e-9)


@pytest.mark.parametrize("bracket_rows", [1_000_000, 2])
def test_describe_with_infinity(spark, bracket_rows):
    vals = [float(v) for v in range(40)] + [float("inf")] * 3
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    r = describe(df, ["v"], accuracy=10, bracket_rows=bracket_rows).first()
    s = pd.Series(vals)
    assert r["count"] == 43 and r["max"] == float("inf") and r["mean"] == float("inf")
    assert [r["p25"], r["p50"]] == list(np.percentile(s, [25, 50]))


@pytest.mark.parametrize("approx", [False, True])
def test_describe_nan_is_missing(spark, approx):
    vals = [1.0, 2.0, float("nan"), 4.0, None]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    r = describe(df, ["v"], approx=approx).first()
    s = pd.Series(vals, dtype="float64")
    assert r["count"] == s.count() == 3 and r["mean"] == pytest.approx(s.mean())
    if not approx:
        assert r["p50"] == s.median()


def test_histogram_nan_and_infinity(spark):
    inf, nan = float("inf"), float("nan")
    df = spark.createDataFrame([(v,) for v in (1.0, 2.0, 3.0, nan, None)], "v double")
    assert [tuple(r) for r in histogram(df, "v", 2).collect()] == [(0, 1.0, 2.0, 1), (1, 2.0, 3.0, 2)]
    df = spark.createDataFrame([(v,) for v in (1.0, 2.0, 3.0, inf, -inf, -inf)], "v double")
    assert [tuple(r) for r in histogram(df, "v", 2).collect()] == [(0, 1.0, 2.0, 3), (1, 2.0, 3.0, 3)]
    df = spark.createDataFrame([(v,) for v in (inf, -inf, nan)], "v double")
    assert [tuple(r) for r in histogram(df, "v", 2).collect()] == [(0, None, None, 1), (1, None, None, 1)]
