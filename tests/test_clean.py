"""Cleaning semantics: dedupe order, dedupe-then-drop versus drop-then-dedupe."""

import pytest
from pyspark.sql import functions as F

from clientlens.operators import clean_customers, dedupe, distinct_count


@pytest.fixture(scope="module")
def rows(spark):
    # key 1: first row (by seq) has a null, second is complete; key 2 complete
    return spark.createDataFrame([(1, 1, None), (1, 2, 5), (2, 1, 7)], "k int, seq int, v int")


def test_dedupe_then_drop_loses_key(rows):
    got = sorted(tuple(r) for r in clean_customers(rows, "k", ["seq"]).collect())
    assert got == [(2, 1, 7)]


def test_drop_then_dedupe_keeps_first_complete(rows):
    got = sorted(tuple(r) for r in clean_customers(rows, "k", ["seq"], complete_first=True).collect())
    assert got == [(1, 2, 5), (2, 1, 7)]


def test_dedupe_order_and_required(rows):
    got = sorted(tuple(r) for r in dedupe(rows, "k", [F.desc("seq")]).collect())
    assert got == [(1, 2, 5), (2, 1, 7)]
    with pytest.raises(ValueError):
        dedupe(rows, "k", [])


def test_distinct_counts(spark):
    df = spark.range(5000).select((F.col("id") % 123).alias("c"))
    assert distinct_count(df, "c").first()[0] == 123
    assert abs(distinct_count(df, "c", approx=True).first()[0] - 123) <= 6
