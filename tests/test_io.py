"""Sources and sinks: declared-schema CSV and JSON lines, table folders,
one-row JSON stats, and the insights report written end to end."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from clientlens.operators import customer_summary, global_stats
from clientlens.plans import insights_report
from clientlens.sources import (CUSTOMER_PURCHASE, CUSTOMER_SUMMARY, read_csv, read_json_lines, write_one_row_json, write_tables)
from harness_tables import EVENTS, read_table

SF = "/root/testdata/sf0.001"


def test_csv_schema_and_inference(spark, tmp_dir):
    p = os.path.join(tmp_dir, "a.csv")
    with open(p, "w") as f:
        f.write("client_id,n,d\nC1,3,2024-01-15\nC2,,2024-01-16\n")
    df = read_csv(spark, p, infer=True)
    assert [t for _, t in df.dtypes] == ["string", "int", "date"]
    assert df.where(F.col("n").isNull()).count() == 1


def test_json_lines(spark, tmp_dir):
    p = os.path.join(tmp_dir, "s.json")
    with open(p, "w") as f:
        for i in range(12):
            f.write(json.dumps({"customer_id": f"u{i}", "category": "ab"[i % 2], "total_amount": i * 1.5,
                                "purchase_count": i}) + "\n")
    df = read_json_lines(spark, p, CUSTOMER_SUMMARY)
    assert df.count() == 12 and dict(df.dtypes)["purchase_count"] == "bigint"
    out = write_one_row_json(global_stats(df), os.path.join(tmp_dir, "stats"))
    back = spark.read.json(out).first()
    assert back["total_transactions"] == 12 and back["unique_categories"] == 2


def test_write_tables_round_trip(spark, tmp_dir):
    ev = read_table(spark, SF, "events")
    summ = customer_summary(ev, EVENTS)
    paths = write_tables({"summary": summ}, tmp_dir)
    back = spark.read.parquet(paths["summary"])
    assert back.count() == summ.count()
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, summ.collect()))


def test_insights_report(spark, tmp_dir):
    ev = read_table(spark, SF, "events")
    paths = insights_report(ev, EVENTS, os.path.join(tmp_dir, "insights"), as_of=dt.date(2024, 2, 1))
    assert set(paths) == {"client_loyalty", "rfm", "purchase_profile", "rfm_describe", "rfm_histogram", "retention_by_year",
                          "weekday_patterns", "hourly_patterns", "category_revenue", "category_transitions"}
    n = ev.count()
    hours = spark.read.parquet(paths["hourly_patterns"])
    assert hours.agg(F.sum("nombre_achats")).first()[0] == n
    trans = spark.read.parquet(paths["category_transitions"]).agg(F.sum("count")).first()[0]
    assert trans == n - ev.select("user_id").distinct().count()   # one fewer pair than purchases per client
    hist = spark.read.parquet(paths["rfm_histogram"])
    assert hist.count() == 20 and hist.agg(F.sum("count")).first()[0] == ev.select("user_id").distinct().count()
    assert spark.read.parquet(paths["rfm_describe"]).count() == 7


def test_spending_report(spark, tmp_dir):
    from clientlens.plans import spending_report
    p = os.path.join(tmp_dir, "summary.json")
    with open(p, "w") as f:
        for i in range(25):
            f.write(json.dumps({"customer_id": f"u{i}", "category": ["a", "b", None][i % 3],
                                "total_amount": None if i == 7 else i * 10.0, "purchase_count": i % 5}) + "\n")
    paths = spending_report(spark, p, os.path.join(tmp_dir, "spend"))
    assert spark.read.parquet(paths["top_customers"]).count() == 10
    assert spark.read.parquet(paths["category_spending"]).count() == 2      # null category dropped
    assert spark.read.parquet(paths["scatter_points"]).count() == 25
    st = spark.read.json(paths["analysis_stats"]).first()
    assert (st["total_transactions"], st["unique_categories"], st["unique_customers"]) == (25, 2, 25)
    assert st["max_spending"] == 240.0 and st["min_spending"] == 0.0


def test_insights_report_reads_the_purchases_three_times(spark, tmp_dir):
    """By the event log of an application of its own."""
    import glob
    import subprocess
    import sys
    repo, log = os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.join(tmp_dir, "log")
    os.makedirs(log)
    code = f"""
import sys, datetime as dt
sys.path.insert(0, {repo!r})
from clientlens.session import build_session
from clientlens.plans import insights_report
from harness_tables import EVENTS, read_table
spark = build_session("local[2]", shuffle_partitions=2, extra={{"spark.eventLog.enabled": "true", "spark.eventLog.dir": "file://{log}",
    "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false"}})
ev = read_table(spark, {SF!r}, "events")
print("ROWS", ev.count())
spark.sparkContext.setJobGroup("report", "report")
insights_report(ev, EVENTS, {os.path.join(tmp_dir, "out")!r}, as_of=dt.date(2024, 2, 1))
spark.stop()
"""
    out = subprocess.run([sys.executable, "-c", code], check=True, capture_output=True, text=True, timeout=300).stdout
    rows, stages, scans = int(out.split("ROWS")[1].split()[0]), {}, set()
    for line in open(glob.glob(f"{log}/*")[0]):
        e = json.loads(line)
        if e["Event"] == "SparkListenerJobStart" and e.get("Properties", {}).get("spark.jobGroup.id") == "report":
            scans.update(e["Stage IDs"])
        elif e["Event"] == "SparkListenerTaskEnd" and e["Stage ID"] in scans:
            n = e["Task Metrics"]["Input Metrics"]["Records Read"]
            stages[e["Stage ID"]] = stages.get(e["Stage ID"], 0) + n
    # the purchases are the only input of that many rows; tables written by the report are smaller
    assert sum(1 for n in stages.values() if n == rows) == 3


def test_chart_tables_come_in_order(spark, tmp_dir):
    ev = read_table(spark, SF, "events")
    paths = insights_report(ev, EVENTS, os.path.join(tmp_dir, "charts"), as_of=dt.date(2024, 2, 1))
    for name, x in (("weekday_patterns", "jour_semaine"), ("hourly_patterns", "heure"), ("rfm_histogram", "bin")):
        got = [r[x] for r in spark.read.parquet(paths[name]).collect()]
        assert got == sorted(got) and len(got) > 5


CUSTOMERS = "client_id,age,genre,ville,produit_achete,montant_achat,date_achat,segment_client"


def _csv(tmp_dir, name, header, *rows):
    p = os.path.join(tmp_dir, name)
    os.makedirs(p, exist_ok=True)
    with open(os.path.join(p, "a.csv"), "w") as f:
        f.write("\n".join([header, *rows]) + "\n")
    return p


def test_csv_is_bound_by_its_header(spark, tmp_dir):
    p = _csv(tmp_dir, "swapped", "genre,client_id,extra,age,ville,produit_achete,date_achat,montant_achat,segment_client",
             "F,C1,zz,35,Lyon,x,2024-01-15,10.5,A")
    r = read_csv(spark, p, CUSTOMER_PURCHASE)
    assert r.columns == CUSTOMERS.split(",")
    assert tuple(r.first()) == ("C1", 35, "F", "Lyon", "x", 10.5, dt.date(2024, 1, 15), "A")


def test_csv_missing_column_and_bad_cell_fail(spark, tmp_dir):
    with pytest.raises(ValueError, match="no column age"):
        read_csv(spark, _csv(tmp_dir, "short", CUSTOMERS.replace(",age", ""), "C1,F,L,x,1.0,2024-01-15,A"), CUSTOMER_PURCHASE)
    p = _csv(tmp_dir, "bad", CUSTOMERS, "C1,abc,F,L,x,1.0,2024-01-15,A")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|abc"):
        read_csv(spark, p, CUSTOMER_PURCHASE).collect()
    assert read_csv(spark, p, CUSTOMER_PURCHASE, malformed="PERMISSIVE").first()["age"] is None
    blank = _csv(tmp_dir, "blank", CUSTOMERS, "C1,,F,L,x,1.0,,A")
    assert read_csv(spark, blank, CUSTOMER_PURCHASE).first()["age"] is None


def test_csv_files_of_one_folder_must_agree(spark, tmp_dir):
    p = _csv(tmp_dir, "two", CUSTOMERS, "C1,30,F,L,x,1.0,2024-01-15,A")
    with open(os.path.join(p, "b.csv"), "w") as f:
        f.write(CUSTOMERS.replace("age,genre", "genre,age") + "\nC2,F,31,L,x,1.0,2024-01-15,A\n")
    with pytest.raises(Exception):
        read_csv(spark, p, CUSTOMER_PURCHASE).collect()
