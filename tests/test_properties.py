"""Property tests: the two custom distributed plans (split transitions,
exact describe) against brute force on random small tables."""

import datetime as dt
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from clientlens.operators import category_transitions, describe
from clientlens.roles import Roles
from clientlens.sources import PURCHASE

R = Roles()
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

row = st.tuples(st.sampled_from(["a", "b", "c", None]),            # client
                st.integers(0, 6),                                  # minute (many ties)
                st.sampled_from(["x", "y", "z", None]))             # category


@SETTINGS
@given(rows=st.lists(row, min_size=0, max_size=60), seconds=st.sampled_from([1, 60, 130, 10**7]))
def test_transitions_property(spark, rows, seconds):
    data = [(i, c, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m), 1.0, k) for i, (c, m, k) in enumerate(rows)]
    by = {}
    for pid, c, ts, _, k in data:
        by.setdefault(c, []).append((ts, pid, k))
    want = Counter()
    for seq in by.values():
        seq.sort(key=lambda t: (t[0], t[1]))
        for (_, _, p), (_, _, k) in zip(seq, seq[1:]):
            if p is not None:
                want[(p, k)] += 1
    df = spark.createDataFrame(data, PURCHASE)
    got = Counter({(r[0], r[1]): r[2] for r in
                   category_transitions(df, R, slice_seconds=seconds).collect()})
    assert got == want


@SETTINGS
@given(vals=st.lists(st.one_of(st.none(), st.integers(-5, 5).map(float),
                               st.floats(-1e3, 1e3, allow_nan=False).map(lambda v: round(v, 2))),
                     min_size=0, max_size=80),
       accuracy=st.sampled_from([10, 25, 10000]))
def test_describe_property(spark, vals, accuracy):
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    r = describe(df, ["v"], accuracy=accuracy, bracket_rows=2).first()
    s = pd.Series(vals, dtype="float64").dropna()
    assert r["count"] == len(s)
    if len(s) == 0:
        assert r["p50"] is None
        return
    got = [r["mean"], r["min"], r["p25"], r["p50"], r["p75"], r["max"]]
    want = [s.mean(), s.min(), *np.percentile(s, [25, 50, 75]), s.max()]
    assert got == pytest.approx(want, rel=1e-9, abs=1e-9)
    if len(s) > 1:
        assert r["std"] == pytest.approx(s.std(), rel=1e-9, abs=1e-9)
