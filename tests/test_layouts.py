"""Quarantine of bad CSV lines, tables bucketed by client, the incremental
client store."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from clientlens.operators import category_transitions, client_loyalty, client_rfm_base
from clientlens.plans.incremental import ClientStore
from clientlens.roles import Roles
from clientlens.sources import PURCHASE as BY_ID
from clientlens.sources.bucketed import read_bucketed, write_bucketed
from clientlens.sources.files import Files
from clientlens.sources.quarantine import TooManyBadLines, load_csv
from pyspark.sql.types import DateType, DoubleType, LongType, StringType, StructField, StructType

SALES = StructType([StructField("id", LongType()), StructField("client", StringType()), StructField("day", DateType()),
                    StructField("amount", DoubleType())])


def _csv(folder, **files):
    os.makedirs(folder)
    for name, lines in files.items():
        with open(f"{folder}/{name}.csv", "w") as f:
            f.write("\n".join(lines) + "\n")


# ---------------------------------------------------------------- quarantine
HEADER = "client,amount,extra,id,day"


def _sales(tmp_dir, name):
    folder = f"{tmp_dir}/{name}"
    _csv(folder, a=[HEADER, "c1,10.5,x,1,2024-01-02", "c2,much,x,2,2024-01-02", "", '"c, 3",1,x,3,2024-01-03', "c4,1"],
         b=[HEADER, "c5,2,x,5,2024-02-30", HEADER, "c6,,x,6,", "c7,1,x,7,2024-01-01,more", ",,,,"])
    return folder


def test_bad_lines_are_kept_apart(spark, tmp_dir):
    folder = _sales(tmp_dir, "sales")
    good = load_csv(spark, folder, SALES, f"{tmp_dir}/bad1")
    assert good.columns == ["id", "client", "day", "amount"]
    assert sorted(map(tuple, good.collect()), key=str) == sorted([
        (1, "c1", dt.date(2024, 1, 2), 10.5), (3, "c, 3", dt.date(2024, 1, 3), 1.0), (6, "c6", None, None), (None, None, None, None)], key=str)
    bad = spark.read.parquet(f"{tmp_dir}/bad1").collect()
    assert {(os.path.basename(r.file), r.line, r.record) for r in bad} == {
        ("a.csv", 3, "c2,much,x,2,2024-01-02"), ("a.csv", 6, "c4,1"), ("b.csv", 2, "c5,2,x,5,2024-02-30"), ("b.csv", 3, HEADER),
        ("b.csv", 5, "c7,1,x,7,2024-01-01,more")}


def test_limits_of_bad_lines(spark, tmp_dir):
    folder = _sales(tmp_dir, "sales2")
    assert load_csv(spark, folder, SALES, f"{tmp_dir}/bad2", max_bad=5, max_bad_share=0.6).count() == 4
    for limit in ({"max_bad": 4}, {"max_bad_share": 0.4}):
        with pytest.raises(TooManyBadLines):
            load_csv(spark, folder, SALES, f"{tmp_dir}/bad3", **limit)
        assert spark.read.parquet(f"{tmp_dir}/bad3").count() == 5   # written all the same
    _csv(f"{tmp_dir}/clean", a=[HEADER, "c1,1,x,1,2024-01-01"])
    assert load_csv(spark, f"{tmp_dir}/clean", SALES, f"{tmp_dir}/bad4", max_bad=0, max_bad_share=0.0).count() == 1
    assert spark.read.parquet(f"{tmp_dir}/bad4").count() == 0


def test_headers_must_agree(spark, tmp_dir):
    _csv(f"{tmp_dir}/other", a=[HEADER, "c1,1,x,1,2024-01-01"], b=["id,client,day,amount,extra", "1,c1,2024-01-01,1,x"])
    with pytest.raises(ValueError, match="another header"):
        load_csv(spark, f"{tmp_dir}/other", SALES, f"{tmp_dir}/bad5")
    _csv(f"{tmp_dir}/short", a=["id,client", "1,c1"])
    with pytest.raises(ValueError, match="no column"):
        load_csv(spark, f"{tmp_dir}/short", SALES, f"{tmp_dir}/bad6")


def test_line_numbers_over_splits(spark, tmp_dir):
    """A file read in many splits: every bad line has its own place."""
    r = random.Random(2)
    lines = [HEADER] + [f"c{i},{'bad' if r.random() < 0.02 else i},{'y' * r.randrange(60)},{i},2024-01-01" for i in range(5000)]
    _csv(f"{tmp_dir}/long", a=lines, b=lines[:700])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
        good = load_csv(spark, f"{tmp_dir}/long", SALES, f"{tmp_dir}/bad7")
        n = good.count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    got = {(os.path.basename(x.file), x.line): x.record for x in spark.read.parquet(f"{tmp_dir}/bad7").collect()}
    want = {(f, i + 1): x for f, part in (("a.csv", lines), ("b.csv", lines[:700])) for i, x in enumerate(part) if ",bad," in x}
    assert got == want and n == 5700 - 1 - len(want)


# ---------------------------------------------------------------- bucketed tables
R = Roles()
PURCHASE = StructType([*BY_ID.fields[1:], BY_ID.fields[0]])   # the id last


def _purchases(spark, n=600, days=9, seed=3):
    r = random.Random(seed)
    t0 = dt.datetime(2024, 2, 1)
    rows = [(f"c{r.randrange(40)}" if i % 3 else "hot", t0 + dt.timedelta(days=r.randrange(days), minutes=r.randrange(1440)),
             float(r.randrange(1, 500)), r.choice(["x", "y", "z"]), i) for i in range(n)]
    return spark.createDataFrame(rows, PURCHASE)


def _exchanges(df):
    plan = df._jdf.queryExecution().executedPlan()
    return [line for line in plan.toString().splitlines() if "Exchange hashpartitioning" in line]


def test_jobs_on_a_bucketed_table_need_no_exchange_by_client(spark, tmp_dir):
    df = _purchases(spark)
    write_bucketed(df, f"{tmp_dir}/by_client", R.client, 8, "purchases_by_client", sort=R.ts)
    table = read_bucketed(spark, f"{tmp_dir}/by_client", "purchases_by_client")
    key = lambda rows: sorted(map(tuple, rows), key=str)
    for job in (lambda d: client_rfm_base(d, R), lambda d: client_loyalty(d, R)):
        assert not _exchanges(job(table)) and _exchanges(job(df))
        assert key(job(table).collect()) == key(job(df).collect())
    assert key(category_transitions(table, R).collect()) == key(category_transitions(df, R).collect())
    assert not any("_s" in e or R.client in e for e in _exchanges(category_transitions(table, R)))
    joined = client_rfm_base(table, R).join(client_loyalty(table, R), R.client)
    assert not _exchanges(joined)


def test_another_session_opens_a_bucketed_table_by_its_path(spark, tmp_dir):
    df = _purchases(spark)
    write_bucketed(df, f"{tmp_dir}/moved", R.client, 4, "moved_first")
    spark.sql("DROP TABLE moved_first")   # external: the files stay
    table = read_bucketed(spark, f"{tmp_dir}/moved")
    assert not _exchanges(client_loyalty(table, R)) and table.count() == df.count()
    assert read_bucketed(spark, f"{tmp_dir}/moved").count() == df.count()   # registered once
    write_bucketed(df.limit(5), f"{tmp_dir}/moved", R.client, 4, "moved_second")
    assert Files(spark, f"{tmp_dir}/moved").exists("_layout.json")


# ---------------------------------------------------------------- incremental client store
def _files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def _same(a, b):
    def key(rows):
        return sorted(tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in rows)
    assert a.columns == b.columns and a.dtypes == b.dtypes
    assert key(a.collect()) == key(b.collect())


def test_daily_loads_equal_one_run(spark, tmp_dir):
    df = _purchases(spark, days=3)
    store = ClientStore(spark, f"{tmp_dir}/clients", R, buckets=6)
    with pytest.raises(FileNotFoundError):
        store.loyalty()
    for d in range(3):
        store.load_day(f"2024-02-0{d + 1}", df.where(F.dayofmonth(R.ts) == d + 1))
    _same(store.loyalty(), client_loyalty(df, R))
    _same(store.rfm_base(), client_rfm_base(df, R))
    again = ClientStore(spark, f"{tmp_dir}/clients", R, buckets=99)   # the store's own number counts
    assert again.buckets == 6
    _same(again.loyalty(), client_loyalty(df, R))


def test_untouched_buckets_are_not_rewritten(spark, tmp_dir):
    df = _purchases(spark, days=2)
    path = f"{tmp_dir}/untouched"
    store = ClientStore(spark, path, R, buckets=16)
    store.load_day("d1", df.where(F.dayofmonth(R.ts) == 1))
    before, state = _files(f"{path}/clients"), store._manifest()
    few = df.where(F.dayofmonth(R.ts) == 2).where(F.col(R.client).isin("c1", "c2"))
    touched = store.load_day("d2", few)
    assert 1 <= len(touched) <= 2
    after, now = _files(f"{path}/clients"), store._manifest()
    assert all(after[f] == t for f, t in before.items())                   # no file changed
    assert {os.path.dirname(f) for f in after.keys() - before.keys()} == {f"{path}/clients/version=2/bucket={b}" for b in touched}
    assert {b: v for b, v in now["clients"].items() if int(b) not in touched} == \
        {b: v for b, v in state["clients"].items() if int(b) not in touched}
    _same(store.loyalty(), client_loyalty(df.where(F.dayofmonth(R.ts) == 1).unionByName(few), R))
    # an empty day changes nothing
    assert store.load_day("d3", df.limit(0)) == []
    _same(store.loyalty(), client_loyalty(df.where(F.dayofmonth(R.ts) == 1).unionByName(few), R))


def test_day_loaded_again_replaces_itself(spark, tmp_dir):
    df = _purchases(spark, days=3, seed=8)
    day = lambda d: df.where(F.dayofmonth(R.ts) == d)
    store = ClientStore(spark, f"{tmp_dir}/again", R, buckets=5)
    store.load_day("1", day(1).limit(30))    # incomplete, and with a client that the full day hasn't
    store.load_day("2", day(2).unionByName(spark.createDataFrame([("gone", dt.datetime(2024, 2, 2), 1.0, "x", 9999)], PURCHASE)))
    store.load_day("3", day(3))
    store.load_day("1", day(1))
    store.load_day("2", day(2))
    _same(store.loyalty(), client_loyalty(df, R))
    store.clean()
    _same(store.loyalty(), client_loyalty(df, R))
    store.load_day("3", day(3).limit(0))
    store.clean()
    _same(store.loyalty(), client_loyalty(day(1).unionByName(day(2)), R))


def test_killed_load_changes_nothing(spark, tmp_dir, monkeypatch):
    df = _purchases(spark, days=2, seed=9)
    store = ClientStore(spark, f"{tmp_dir}/killed", R, buckets=5)
    store.load_day("1", df.where(F.dayofmonth(R.ts) == 1))
    want = client_loyalty(df.where(F.dayofmonth(R.ts) == 1), R)
    with monkeypatch.context() as m:
        def killed(*a):
            raise KeyboardInterrupt
        m.setattr(Files, "publish_text", killed)
        with pytest.raises(KeyboardInterrupt):
            store.load_day("2", df.where(F.dayofmonth(R.ts) == 2))
    _same(store.loyalty(), want)
    store.load_day("2", df.where(F.dayofmonth(R.ts) == 2))
    _same(store.loyalty(), client_loyalty(df, R))
