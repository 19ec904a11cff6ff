"""Task balance of the transition plans under a hot client.

usage: python scripts/skew_check.py [sf_dir]

Derives a purchase table from ``events`` in which one client holds a third of
all rows (every third event is re-assigned to client -1), runs the split
transition plan and the per-client ``lag`` window, and reports, from Spark's
event log (written to a fresh scratch folder), the largest and median task
input (records) of the stage that evaluates the window (AQE partition
coalescing is off so the layout is the one a large input gets). Also checks
that both give the same pairs. Then reports how much of the hot client reaches the
final stage of RFM (partial aggregation) and of ordered dedupe (partial
WindowGroupLimit) when the input is spread over 16 map tasks.
"""

from __future__ import annotations

import glob
import io
import json
import os
import statistics
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import zstandard  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from pyspark.sql import Window  # noqa: E402

from clientlens.operators import category_transitions, dedupe, rfm  # noqa: E402
from harness_tables import EVENTS  # noqa: E402
from clientlens.session import build_session  # noqa: E402


def _events(log_dir: str):
    for f in sorted(glob.glob(f"{log_dir}/*/events_*")):
        raw = open(f, "rb").read()
        if f.endswith(".zstd"):
            raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
        for line in raw.decode().splitlines():
            yield json.loads(line)


def split(df, r):
    return category_transitions(df, r, slice_seconds=3 * 3600)


def per_client(df, r):
    """The plain form: one lag per client."""
    w = Window.partitionBy(r.client).orderBy(r.ts, r.id)
    return df.withColumn("_p", F.lag(r.category).over(w)).where("_p IS NOT NULL").groupBy("_p", r.category).count()


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="clientlens-skew-")
    # coalescing off: at this size AQE would merge every shuffle into one task and hide the layout
    spark = build_session("local[8]", shuffle_partitions=16,
                          extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{log_dir}",
                                 "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    ev = spark.read.parquet(f"{sf}/events.parquet")
    hot = ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(-1)).otherwise(F.col("user_id")))
    sc = spark.sparkContext
    results = {}
    for name, fn in (("split", split), ("per_client_window", per_client)):
        sc.setJobGroup(name, name)
        results[name] = {(r[0], r[1]): r[2] for r in fn(hot, EVENTS).collect()}
    # map-side reduction of a hot key: input spread over 16 map tasks first
    spread = hot.repartition(16)
    sc.setJobGroup("rfm", "rfm")
    spread_rfm = rfm(spread, EVENTS, as_of="2024-02-01").collect()
    sc.setJobGroup("dedupe", "dedupe")
    spread_dd = dedupe(spread, "user_id", [F.desc("ts"), F.desc("event_id")]).collect()
    spark.stop()

    stage_group, tasks = {}, {}
    for e in _events(log_dir):
        if e["Event"] == "SparkListenerJobStart":
            g = e.get("Properties", {}).get("spark.jobGroup.id")
            for s in e["Stage IDs"]:
                stage_group[s] = g
        elif e["Event"] == "SparkListenerTaskEnd" and e.get("Task Metrics"):
            m = e["Task Metrics"]
            rec = m["Shuffle Read Metrics"]["Total Records Read"]
            tasks.setdefault(e["Stage ID"], []).append(rec)
    print(f"{sum(results['split'].values())} pairs counted; plans agree: "
          f"{results['split'] == results['per_client_window']}")
    for g in ("split", "per_client_window"):
        # the window stage reads the most shuffle records among this plan's stages
        st = [s for s, gg in stage_group.items() if gg == g and s in tasks]
        s = max(st, key=lambda x: sum(tasks[x]))
        t = tasks[s]
        print(f"{g:18s} window stage: {len(t)} tasks, records read max {max(t)}, "
              f"median {int(statistics.median(t))}, total {sum(t)}")
    for g, n in (("rfm", len(spread_rfm)), ("dedupe", len(spread_dd))):
        # the stage after the round-robin spread: reads the partial (map-side reduced) rows
        st = sorted(s for s, gg in stage_group.items() if gg == g and s in tasks)
        t = tasks[st[-1]]
        print(f"{g:18s} final stage: {len(t)} tasks, records read max {max(t)}, total {sum(t)} "
              f"(100000 input rows, {n} clients out)")


if __name__ == "__main__":
    main()
