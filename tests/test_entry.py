"""Driver contract: the flagship runs, every query has an oracle (except the
rows-only k-means fit), and every query equals its oracle at sf0.001."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

import __spark_entry__ as entry  # noqa: E402
from oracle_check import TABLES, rows_key  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "rfm_score" in df.columns


def test_oracle_coverage():
    assert set(entry._QUERIES) | set(entry._JOBS) == set(entry.ORACLE_SQL)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(entry.ORACLE_SQL))
def test_query_equals_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    res = duck.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    orows = [tuple(r[ocols.index(c)] for c in df.columns) for r in res.fetchall()]
    assert rows_key([tuple(r) for r in df.collect()]) == rows_key(orows)


def test_some_messages_combine_several_alerts(spark):
    rows = entry.queries()["alert_messages"](spark, "/root/testdata/sf0.01").collect()
    assert max(r["n_alerts"] for r in rows) > 1


def test_queries_under_driver_like_settings(spark, duck):
    """Non-UTC session zone and 200 shuffle partitions (Spark defaults): every
    query still equals its oracle."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        for name, sql in sorted(entry.ORACLE_SQL.items()):
            df = entry.queries()[name](spark, SF)
            res = duck.execute(sql)
            ocols = [d[0] for d in res.description]
            orows = [tuple(r[ocols.index(c)] for c in df.columns) for r in res.fetchall()]
            assert rows_key([tuple(r) for r in df.collect()]) == rows_key(orows), name
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
