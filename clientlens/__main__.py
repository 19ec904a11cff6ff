"""Command line: the batch jobs and the monitor.

  python -m clientlens segment   --input customers.csv --output OUT [--k 3]
  python -m clientlens analyze   --input processed/ --output OUT
  python -m clientlens insights  --input purchases/ --output OUT [--as-of 2024-02-15] [--roles c,t,a,k,id]
  python -m clientlens spending  --input summaries.jsonl --output OUT
  python -m clientlens monitor   --input samples/ --output OUT [--once]

Paths are URIs; cluster settings come from spark-submit (``segment`` needs
spark.checkpoint.dir). The session zone is UTC unless --zone says otherwise.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from clientlens.operators import latest_first
from clientlens.plans import (analyze_segments, insights_report, segment_customers, segment_report,
                              spending_report)
from clientlens.roles import Roles
from clientlens.session import build_session
from clientlens.sources import CUSTOMER_PURCHASE, read_csv
from clientlens.streaming import start_monitor


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    ap = argparse.ArgumentParser(prog="clientlens")
    ap.add_argument("job", choices=["segment", "analyze", "insights", "spending", "monitor"])
    ap.add_argument("--input", required=True)
    ap.add_argument("--output", required=True)
    ap.add_argument("--k", type=int, default=3)
    ap.add_argument("--as-of", default=None)
    ap.add_argument("--roles", default=None, help="client,time,amount,category,id column names")
    ap.add_argument("--once", action="store_true", help="monitor: process what is there, then stop")
    ap.add_argument("--zone", default="UTC", help="session time zone (hours, weekdays and days of timestamps)")
    a = ap.parse_args(argv)
    spark = spark or build_session(app=f"clientlens-{a.job}", extra={"spark.sql.session.timeZone": a.zone})

    if a.job == "segment":
        raw = read_csv(spark, a.input, CUSTOMER_PURCHASE)
        return segment_report(segment_customers(raw, "client_id", latest_first(raw, "date_achat"), k=a.k), a.output)
    if a.job == "analyze":
        return segment_report(analyze_segments(spark.read.parquet(a.input)), a.output)
    if a.job == "insights":
        roles = Roles(*a.roles.split(",")) if a.roles else Roles()
        return insights_report(spark.read.parquet(a.input), roles, a.output, as_of=a.as_of)
    if a.job == "spending":
        return spending_report(spark, a.input, a.output)
    qs = start_monitor(spark, a.input, a.output, available_now=a.once)
    for q in qs.values():
        q.awaitTermination()
    return {n: f"{a.output}/{n}" for n in qs}


if __name__ == "__main__":
    main(sys.argv[1:])
