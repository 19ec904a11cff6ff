"""Purchase analyses: threshold edges, ties, nulls, and the split transition
plan against a brute-force reference."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import Window, functions as F

from clientlens.operators import (category_transitions, client_loyalty,
                                  hourly_patterns, retention_by_year, rfm, weekday_patterns)
from clientlens.roles import Roles
from clientlens.sources import PURCHASE

R = Roles()  # client_id, date_achat, montant_achat, categorie_produit, purchase_id
AS_OF = dt.date(2024, 12, 31)


def _rows():
    """(purchase_id, client, ts, amount, category)."""
    rows, pid = [], 0

    def add(client, ts, amount, cat):
        nonlocal pid
        pid += 1
        rows.append((pid, client, ts, amount, cat))

    # recency edges: last purchase 30/31/60/61/90/91/180/181 days before AS_OF
    for d in (30, 31, 60, 61, 90, 91, 180, 181):
        add(f"r{d}", dt.datetime.combine(AS_OF - dt.timedelta(days=d), dt.time(12)), 10.0, "A")
    # frequency edges: 2,3,4,5,6,7,9,10 purchases
    for n in (2, 3, 4, 5, 6, 7, 9, 10):
        for i in range(n):
            add(f"f{n}", dt.datetime(2024, 1, 1 + i, 8), 1.0, "AB"[i % 2])
    # monetary edges (single purchase each)
    for a in (249.99, 250.0, 499.99, 500.0, 749.99, 750.0, 999.99, 1000.0):
        add(f"m{a}", dt.datetime(2024, 3, 1, 9), a, "C")
    # two purchases at the same instant: the id decides the order
    add("tie", dt.datetime(2024, 5, 5, 10), 5.0, "X")
    add("tie", dt.datetime(2024, 5, 5, 10), 6.0, "Y")
    add("tie", dt.datetime(2024, 5, 6, 10), 7.0, "Z")
    # null amount, null category
    add("nul", dt.datetime(2024, 6, 1, 23), None, "A")
    add("nul", dt.datetime(2024, 6, 2, 23), 3.0, None)
    add("nul", dt.datetime(2024, 6, 3, 23), 4.0, "B")
    return rows


@pytest.fixture(scope="module")
def purchases(spark):
    rows = _rows()
    data = [(pid, c, ts, a, k) for pid, c, ts, a, k in rows]
    return spark.createDataFrame(data, PURCHASE).cache()


def test_rfm_edges(purchases):
    out = {r["client_id"]: r for r in rfm(purchases, R, as_of=AS_OF).collect()}
    assert [out[f"r{d}"]["r_score"] for d in (30, 31, 60, 61, 90, 91, 180, 181)] == [5, 4, 4, 3, 3, 2, 2, 1]
    assert [out[f"f{n}"]["f_score"] for n in (2, 3, 4, 5, 6, 7, 9, 10)] == [1, 2, 2, 3, 3, 4, 4, 5]
    assert [out[f"m{a}"]["m_score"] for a in (249.99, 250.0, 499.99, 500.0, 749.99, 750.0, 999.99, 1000.0)] \
        == [1, 2, 2, 3, 3, 4, 4, 5]
    # a null amount is skipped by the sum
    assert out["nul"]["montant_total"] == 7.0


def test_rfm_null_total_scores_one(spark):
    df = spark.createDataFrame([(1, "z", dt.datetime(2024, 1, 1), None, "A")], PURCHASE)
    r = rfm(df, R, as_of=AS_OF).first()
    assert r["montant_total"] is None and r["m_score"] == 1


def brute_transitions(rows):
    by = {}
    for pid, c, ts, a, k in rows:
        by.setdefault(c, []).append((ts, pid, k))
    cnt = Counter()
    for seq in by.values():
        seq.sort(key=lambda t: (t[0], t[1]))
        for (_, _, p), (_, _, k) in zip(seq, seq[1:]):
            if p is not None:
                cnt[(p, k)] += 1
    return cnt


def as_counter(df):
    return Counter({(r[0], r[1]): r[2] for r in df.collect()})


def test_transitions_ties_and_nulls(purchases):
    got = as_counter(category_transitions(purchases, R))
    want = brute_transitions(_rows())
    assert got == want
    assert got[("X", "Y")] == 1 and got[("Y", "Z")] == 1   # id breaks the same-instant tie
    assert got[("A", None)] == 1 and (None, "B") not in got  # null previous category dropped


def transitions_by_window(df):
    """The readable definition: one ``lag`` per client."""
    w = Window.partitionBy(R.client).orderBy(R.ts, R.id)
    return (df.withColumn("p", F.lag(R.category).over(w)).where("p IS NOT NULL").groupBy("p", R.category).count())


@pytest.mark.parametrize("seconds", [1, 60, 1000, 3600, 7 * 86_400, 10**9])
def test_transitions_hot_client_matches_brute_force(spark, seconds):
    rnd = random.Random(7)
    rows = []
    base = dt.datetime(2024, 1, 1)
    for pid in range(3000):
        # a third of all rows belong to one client; some clients are null
        c = "hot" if pid % 3 == 0 else (None if pid % 97 == 0 else f"c{rnd.randint(0, 40)}")
        ts = base + dt.timedelta(minutes=rnd.randint(0, 500))   # many equal times
        k = rnd.choice(["a", "b", "c", None])
        rows.append((pid, c, ts, 1.0, k))
    df = spark.createDataFrame(rows, PURCHASE)
    want = brute_transitions(rows)
    assert as_counter(category_transitions(df, R, slice_seconds=seconds)) == want
    assert as_counter(transitions_by_window(df)) == want


def test_transitions_one_exchange_of_the_rows(spark):
    """One exchange on (client, slice) serves the window; no range sampling."""
    rows = [(i, "hot", dt.datetime(2024, 1, 1) + dt.timedelta(seconds=i), 1.0, "ab"[i % 2]) for i in range(4000)]
    df = category_transitions(spark.createDataFrame(rows, PURCHASE), R, slice_seconds=100)
    assert as_counter(df) == Counter({("a", "b"): 2000, ("b", "a"): 1999})
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("hashpartitioning(_c") == 1 and "rangepartitioning(_c" not in plan


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date", "bigint"])
def test_transitions_time_types_and_missing_times(spark, kind):
    rows, rnd = [], random.Random(3)
    for i in range(400):
        ts = None if i % 37 == 0 else dt.datetime(1969, 12, 20) + dt.timedelta(hours=rnd.randrange(900))
        rows.append((i, f"c{i % 3}", ts, 1.0, rnd.choice("xyz")))
    df = spark.createDataFrame(rows, PURCHASE)
    made = {"timestamp": "date_achat", "timestamp_ntz": "cast(date_achat as timestamp_ntz)", "date": "to_date(date_achat)",
            "bigint": "cast(unix_seconds(date_achat) as bigint)"}[kind]
    df = df.withColumn("date_achat", F.expr(made))
    assert as_counter(category_transitions(df, R, slice_seconds=86_400)) == as_counter(transitions_by_window(df))


def test_patterns_and_loyalty(purchases):
    n = purchases.count()
    assert sum(r["nombre_achats"] for r in weekday_patterns(purchases, R).collect()) == n
    hours = {r["heure"]: r["nombre_achats"] for r in hourly_patterns(purchases, R).collect()}
    assert sum(hours.values()) == n and hours[23] == 3
    loy = {r["client_id"]: r for r in client_loyalty(purchases, R).collect()}
    assert loy["f10"]["duree_relation"] == 9 and loy["f10"]["nombre_achats"] == 10
    assert loy["tie"]["duree_relation"] == 1
    ret = retention_by_year(client_loyalty(purchases, R)).collect()
    assert sum(r["nouveaux_clients"] for r in ret) == len(loy)
