"""Purchases as a stream: re-sent rows, and pairs of consecutive categories."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql.types import StructType

from clientlens.operators import category_transitions
from clientlens.roles import Roles
from clientlens.sources import PURCHASE as BY_ID
from clientlens.streaming.purchases import STATE_STORE, dedupe_stream, transition_counts, transitions_stream

R = Roles()
PURCHASE = StructType([*BY_ID.fields[1:], BY_ID.fields[0]])   # the id last
T0 = dt.datetime(2024, 3, 1)


@pytest.fixture()
def state_store(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    spark.conf.set(key, STATE_STORE)
    yield
    spark.conf.unset(key) if before is None else spark.conf.set(key, before)


@pytest.fixture(autouse=True)
def _workers_import_the_repository(spark):
    spark.sparkContext.environment["PYTHONPATH"] = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _add(spark, folder, batches, start=0):
    """One file per batch, in order of modification time."""
    os.makedirs(folder, exist_ok=True)
    for i, rows in enumerate(batches):
        have = set(os.listdir(folder))
        spark.createDataFrame(rows, PURCHASE).coalesce(1).write.mode("append").parquet(folder)
        for f in set(os.listdir(folder)) - have:
            os.utime(f"{folder}/{f}", (1_700_000_000 + 100 * (start + i),) * 2)


def _stream(spark, folder):
    return spark.readStream.schema(PURCHASE).option("maxFilesPerTrigger", 1).parquet(folder)


def _run(df, out, ck):
    q = df.writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", ck) \
        .trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def test_resent_purchases_count_once_across_a_restart(spark, tmp_dir):
    src, out, ck = (f"{tmp_dir}/dd_{x}" for x in ("in", "out", "ck"))
    m = lambda x: T0 + dt.timedelta(minutes=x)
    first = [[("c1", m(0), 10.0, "x", 1), ("c1", m(0), 9.0, "x", 1), ("c2", m(1), 5.0, "y", 2), ("c1", m(0), None, "x", 1)],
             [("c2", m(2), 1.0, "a", 2), ("c3", m(3), 7.0, "z", 3)]]
    _add(spark, src, first)
    _run(dedupe_stream(_stream(spark, src), R.id, R.ts, watermark="1 hour"), out, ck)
    _add(spark, src, [[("c3", m(3), 7.0, "z", 3), ("c4", m(4), 2.0, "z", 4)], [("c1", m(0), 10.0, "x", 1)]], start=2)
    _run(dedupe_stream(_stream(spark, src), R.id, R.ts, watermark="1 hour"), out, ck)
    got = spark.read.parquet(out).collect()
    # batch order first; within a batch the earliest time, then the least of the other columns, nulls last
    assert sorted((r[R.id], r[R.client], r[R.amount]) for r in got) == [(1, "c1", 9.0), (2, "c2", 5.0), (3, "c3", 7.0), (4, "c4", 2.0)]


def test_duplicates_state_is_dropped_behind_the_watermark(spark, tmp_dir):
    src, out, ck = (f"{tmp_dir}/ds_{x}" for x in ("in", "out", "ck"))
    _add(spark, src, [[(f"c{i}", T0 + dt.timedelta(hours=h), 1.0, "x", 100 * h + i) for i in range(50)] for h in range(0, 12, 2)])
    q = _run(dedupe_stream(_stream(spark, src), R.id, R.ts, watermark="1 hour"), out, ck)
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
    assert spark.read.parquet(out).count() == 300 and max(kept) <= 150


def _purchases(n, seed):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        t = T0 + dt.timedelta(minutes=2 * i + r.randrange(25))    # out of order by up to half an hour
        rows.append((r.choice(["hot"] * 4 + [f"c{k}" for k in range(6)]), t, 1.0, r.choice(["x", "y", "z", None]), i))
    rows += [(rows[5][0], rows[5][1], 1.0, "x", n + 1), (rows[5][0], rows[5][1], 1.0, "z", n)]   # one instant: the id decides
    return rows


def _key(rows):
    return sorted(map(tuple, rows), key=str)


def test_stream_transitions_equal_batch_over_closed_time_and_restarts(spark, tmp_dir, state_store):
    src, out, ck = (f"{tmp_dir}/tr_{x}" for x in ("in", "out", "ck"))
    rows = _purchases(200, seed=1)
    rows[0:0] = rows[-2:]
    del rows[-2:]
    cuts = [rows[i:i + 40] for i in range(0, len(rows), 40)]
    _add(spark, src, cuts[:3])
    _run(transitions_stream(_stream(spark, src), R, watermark="2 hours"), out, ck)
    _add(spark, src, cuts[3:], start=3)
    _run(transitions_stream(_stream(spark, src), R, watermark="2 hours"), out, ck)
    end = max(t for _, t, *_ in rows) + dt.timedelta(days=1)
    _add(spark, src, [[("closing", end, 1.0, "x", 10 ** 6)], [("closing", end, 1.0, "x", 10 ** 6 + 1)]], start=10)
    _run(transitions_stream(_stream(spark, src), R, watermark="2 hours"), out, ck)
    pairs = spark.read.parquet(out)
    want = category_transitions(spark.createDataFrame(rows, PURCHASE), R)
    got = transition_counts(pairs, R)
    assert _key(got.collect()) == _key((r[0], r[1], r[2]) for r in want.collect())
    # each pair once, with the purchase it belongs to
    per_row = {(r[R.client], r[R.id]): (r["categorie_precedente"], r[R.category]) for r in pairs.collect()}
    by, expect = {}, {}
    for c, t, _, k, i in sorted(rows, key=lambda x: (x[1], x[4])):
        if by.get(c) is not None:
            expect[c, i] = (by[c], k)
        by[c] = k
    assert per_row == expect and pairs.count() == len(expect)


def test_late_purchases_are_dropped(spark, tmp_dir, state_store):
    src, out, ck = (f"{tmp_dir}/late_{x}" for x in ("in", "out", "ck"))
    h = lambda x: T0 + dt.timedelta(hours=x)
    _add(spark, src, [[("c", h(0), 1.0, "a", 1), ("c", h(1), 1.0, "b", 2)],
                      [("d", h(10), 1.0, "x", 3)],                       # the watermark passes hour 1
                      [("c", h(0.5), 1.0, "late", 4), ("c", h(9.5), 1.0, "c", 5), (None, h(9.5), 1.0, "n", 6)],
                      [("d", h(30), 1.0, "y", 7)], [("d", h(30), 1.0, "y", 8)]])
    _run(transitions_stream(_stream(spark, src), R, watermark="1 hour"), out, ck)
    got = {(r[R.client], r[R.id], r["categorie_precedente"], r[R.category]) for r in spark.read.parquet(out).collect()}
    assert got == {("c", 2, "a", "b"), ("c", 5, "b", "c")}


def test_purchases_pass_the_processor_packed(spark, tmp_dir, state_store):
    """A client's purchases of a micro-batch are one row, in parts of 10,000;
    without an id they come first at their instant, as in a batch."""
    src, out, ck = (f"{tmp_dir}/pk_{x}" for x in ("in", "out", "ck"))
    m = lambda x: T0 + dt.timedelta(minutes=x)
    rows = [("hot", m(i * 7919 % 12_000), 1.0, "xyz"[i % 3], i) for i in range(12_000)] + [(f"c{i % 5}", m(i), 1.0, "a\"b\u00e9"[i % 4], i) for i in range(60)]
    rows += [("n", m(1), 1.0, "x", 7), ("n", m(1), 1.0, "y", None), ("n", m(2), 1.0, None, 8), ("n", m(3), 1.0, "z", 9), (None, m(1), 1.0, "x", 1), ("n", None, 1.0, "x", 2)]
    end = m(20_000)
    _add(spark, src, [rows, [("closing", end, 1.0, "x", 1)], [("closing", end, 1.0, "x", 2)]])
    _run(transitions_stream(_stream(spark, src), R, watermark="2 hours"), out, ck)
    want = category_transitions(spark.createDataFrame(rows[:-2], PURCHASE), R)
    pairs = spark.read.parquet(out)
    assert _key(transition_counts(pairs, R).collect()) == _key((r[0], r[1], r[2]) for r in want.collect())
    assert sorted(tuple(r)[3:] for r in pairs.where("client_id = 'n'").collect()) == [("x", None), ("y", "x")]
