"""Metric samples: alerts at the exact thresholds, combined messages, latest
values, windowed history; the same operators on Structured Streaming."""

import datetime as dt
import os

import pytest

from clientlens.operators import alert_messages, latest_metric, metric_alerts, metric_history
from clientlens.sources import METRIC_SAMPLE
from clientlens.streaming import alerts_stream, history_stream, latest_stream, messages_stream, \
    read_metric_stream, start_query

T0 = dt.datetime(2024, 1, 1, 10, 0)


def _samples():
    m = lambda minute: T0 + dt.timedelta(minutes=minute)
    return [
        (m(0), "n1", "cpu", 80.0), (m(0), "n1", "memory", 85.0), (m(0), "n1", "disk", 90.0),   # at thresholds
        (m(1), "n1", "cpu", 95.5), (m(1), "n1", "memory", 86.0), (m(1), "n1", "disk", 10.0),   # two breaches
        (m(1), "n2", "disk", 90.5), (m(1), "n2", "cpu", 3.0),
        (m(70), "n1", "cpu", 81.0),
    ]


@pytest.fixture(scope="module")
def samples(spark):
    return spark.createDataFrame(_samples(), METRIC_SAMPLE).cache()


def test_alerts_strictly_greater(samples):
    got = sorted((r["node"], r["metric"], r["message"]) for r in metric_alerts(samples).collect())
    assert got == [("n1", "cpu", "High CPU usage: 81.0%"), ("n1", "cpu", "High CPU usage: 95.5%"),
                   ("n1", "memory", "High Memory usage: 86.0%"), ("n2", "disk", "High Disk usage: 90.5%")]


def test_combined_messages(samples):
    msgs = {(r["node"], r["ts"]): r for r in alert_messages(metric_alerts(samples)).collect()}
    two = msgs[("n1", T0 + dt.timedelta(minutes=1))]
    assert two["n_alerts"] == 2 and two["message"] == "High CPU usage: 95.5%\nHigh Memory usage: 86.0%"


def test_latest_and_history(samples):
    latest = {(r["node"], r["metric"]): r["value"] for r in latest_metric(samples).collect()}
    assert latest[("n1", "cpu")] == 81.0 and latest[("n1", "disk")] == 10.0
    hist = {(r["window_start"], r["metric"]): r for r in metric_history(samples, "1 hour").collect()}
    cpu10 = hist[(T0, "cpu")]
    assert (cpu10["n"], cpu10["min"], cpu10["max"]) == (3, 3.0, 95.5)
    assert hist[(T0 + dt.timedelta(hours=1), "cpu")]["n"] == 1


def _write_batches(spark, d, batches):
    """One parquet file per batch; modification times pinned so the file
    source reads them in batch order (one file per trigger)."""
    seen = set()
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, METRIC_SAMPLE).coalesce(1).write.mode("append").parquet(d)
        new = [f for f in os.listdir(d) if f.endswith(".parquet") and f not in seen]
        for f in new:
            os.utime(os.path.join(d, f), (1_700_000_000 + 100 * i, 1_700_000_000 + 100 * i))
        seen.update(new)


def test_stream_alerts_equal_batch(spark, tmp_dir, samples):
    src = f"{tmp_dir}/in"
    rows = _samples()
    _write_batches(spark, src, [rows[:4], rows[4:]])
    stream = read_metric_stream(spark, src, max_files_per_trigger=1)
    q = start_query(alerts_stream(stream), "alerts_t", checkpoint=f"{tmp_dir}/ck1", available_now=True)
    q.awaitTermination()
    got = sorted(tuple(r) for r in spark.sql("SELECT ts, node, metric, value FROM alerts_t").collect())
    want = sorted(tuple(r) for r in metric_alerts(samples).select("ts", "node", "metric", "value").collect())
    assert got == want

    q = start_query(latest_stream(stream), "latest_t", output_mode="complete",
                    checkpoint=f"{tmp_dir}/ck2", available_now=True)
    q.awaitTermination()
    got = {(r["node"], r["metric"]): r["value"] for r in spark.sql("SELECT * FROM latest_t").collect()}
    assert got[("n1", "cpu")] == 81.0


def test_stream_history_watermark_drops_late_rows(spark, tmp_dir):
    src = f"{tmp_dir}/in2"
    m = lambda minute: T0 + dt.timedelta(minutes=minute)
    _write_batches(spark, src, [
        [(m(0), "n1", "cpu", 10.0), (m(30), "n1", "cpu", 20.0)],
        [(m(200), "n1", "cpu", 30.0)],                 # moves the watermark past 10:00-11:00
        [(m(210), "n1", "cpu", 30.0)],                 # late rows are judged by the previous batch's watermark
        [(m(5), "n1", "cpu", 99.0)],                   # late: behind the watermark, dropped
        [(m(400), "n1", "cpu", 40.0)],                 # closes 13:00-14:00
    ])
    stream = read_metric_stream(spark, src, max_files_per_trigger=1)
    q = start_query(history_stream(stream, "1 hour", "10 minutes"), "hist_t",
                    checkpoint=f"{tmp_dir}/ck3", available_now=True)
    q.awaitTermination()
    rows = {r["window_start"].replace(tzinfo=None): r for r in spark.sql("SELECT * FROM hist_t").collect()}
    first = rows[T0]
    assert (first["n"], first["max"]) == (2, 20.0)      # the late 99.0 is not counted
    assert T0 + dt.timedelta(hours=6) not in rows     # still open: not emitted in append mode

    q = start_query(messages_stream(stream, "10 minutes"), "msg_t", checkpoint=f"{tmp_dir}/ck4",
                    available_now=True)
    q.awaitTermination()
    assert spark.sql("SELECT * FROM msg_t").count() == 0  # only the dropped late row breached


def test_monitor_loop(spark, tmp_dir, samples):
    from clientlens.streaming import read_latest, start_monitor
    src = f"{tmp_dir}/mon_in"
    rows = _samples()
    _write_batches(spark, src, [rows[:4], rows[4:8], rows[8:]])
    qs = start_monitor(spark, src, f"{tmp_dir}/mon_out", name="mon_t", available_now=True,
                       max_files_per_trigger=1, watermark="5 minutes")
    for q in qs.values():
        q.awaitTermination()
    alerts = spark.read.parquet(f"{tmp_dir}/mon_out/alerts")
    assert alerts.count() == metric_alerts(samples).count() == 4
    latest = {(r["node"], r["metric"]): r["value"] for r in read_latest(spark, f"{tmp_dir}/mon_out/latest").collect()}
    assert latest == {(r["node"], r["metric"]): r["value"] for r in latest_metric(samples).collect()}
    # the 10:00 window closed once the 11:10 sample moved the watermark
    hist = spark.read.parquet(f"{tmp_dir}/mon_out/history").where("metric = 'cpu' AND node = 'n1'").collect()
    assert [(r["n"], r["max"]) for r in hist] == [(2, 95.5)]
    msgs = spark.read.parquet(f"{tmp_dir}/mon_out/messages").collect()
    assert sorted(r["n_alerts"] for r in msgs) == [1, 2]


@pytest.mark.parametrize("ts_type", ["timestamp", "timestamp_ntz", "date", "bigint"])
def test_latest_packed_tie_break(spark, ts_type):
    src = {"timestamp": "ts", "timestamp_ntz": "CAST(ts AS timestamp_ntz)", "date": "CAST(ts AS date)",
           "bigint": "CAST(unix_seconds(ts) AS bigint)"}[ts_type]
    rows = [("a", dt.datetime(2024, 1, 1, 10), -5, 1.0), ("a", dt.datetime(2024, 1, 1, 10), 7, 2.0),
            ("a", dt.datetime(2023, 12, 31, 9), 99, 3.0), ("b", dt.datetime(1969, 7, 20, 20), -2 ** 63, 4.0),
            ("b", dt.datetime(1969, 7, 20, 20), 2 ** 63 - 1, 5.0)]
    df = spark.createDataFrame(rows, "k string, ts timestamp, id bigint, v double").selectExpr(
        "k", f"{src} AS t", "id", "v")
    out = latest_metric(df, keys=("k",), ts="t", value="v", tie="id")
    assert "SortAggregate" not in out._jdf.queryExecution().executedPlan().toString()
    assert {r["k"]: r["v"] for r in out.collect()} == {"a": 2.0, "b": 5.0}


def test_stream_over_events_equals_batch(spark, tmp_dir):
    """The registered alert and latest-value queries, run as streams over the
    events table, give the batch results."""
    from harness_tables import EVENT_THRESHOLDS, TEST_TABLE_SCHEMAS, read_table
    sf = "/root/testdata/sf0.001"
    stream = (spark.readStream.schema(TEST_TABLE_SCHEMAS["events"])
              .option("pathGlobFilter", "events.parquet").parquet(sf))
    cols = dict(ts="ts", node="user_id", metric="event_type", value="value")
    q = start_query(alerts_stream(stream, EVENT_THRESHOLDS, **cols), "ev_alerts_t",
                    checkpoint=f"{tmp_dir}/ck_ev1", available_now=True)
    q.awaitTermination()
    batch = read_table(spark, sf, "events")
    want = sorted(map(tuple, metric_alerts(batch, EVENT_THRESHOLDS, **cols).collect()))
    assert sorted(map(tuple, spark.sql("SELECT * FROM ev_alerts_t").collect())) == want and want
    q = start_query(latest_stream(stream, keys=("user_id", "event_type"), ts="ts", value="value", tie="event_id"),
                    "ev_latest_t", output_mode="complete", checkpoint=f"{tmp_dir}/ck_ev2", available_now=True)
    q.awaitTermination()
    want = sorted(map(tuple, latest_metric(batch, keys=("user_id", "event_type"), ts="ts", value="value",
                                           tie="event_id").collect()))
    assert sorted(map(tuple, spark.sql("SELECT * FROM ev_latest_t").collect())) == want


def test_watermarked_streams_over_events_equal_batch(spark, tmp_dir):
    """History windows and combined messages over the events table: every
    emitted row equals the batch row, and all windows/samples closed by the
    final watermark are emitted."""
    from harness_tables import EVENT_THRESHOLDS, TEST_TABLE_SCHEMAS, read_table
    sf = "/root/testdata/sf0.001"
    stream = (spark.readStream.schema(TEST_TABLE_SCHEMAS["events"])
              .option("pathGlobFilter", "events.parquet").parquet(sf))
    batch = read_table(spark, sf, "events")
    q = start_query(history_stream(stream, "1 hour", "10 minutes", keys=("event_type",), ts="ts", value="value"),
                    "ev_hist_t", checkpoint=f"{tmp_dir}/ck_h", available_now=True)
    q.awaitTermination()
    wm = max(r["ts"] for r in batch.select("ts").collect()) - dt.timedelta(minutes=10)
    got = {(r["window_start"], r["event_type"]): (r["n"], r["mean"], r["min"], r["max"])
           for r in spark.sql("SELECT * FROM ev_hist_t").collect()}
    want = {(r["window_start"], r["event_type"]): (r["n"], r["mean"], r["min"], r["max"])
            for r in metric_history(batch, "1 hour", keys=("event_type",), ts="ts", value="value").collect()}
    assert got and all(want[k][0] == v[0] and want[k][2:] == v[2:] and want[k][1] == pytest.approx(v[1])
                       for k, v in got.items())
    assert {k for k in want if k[0] + dt.timedelta(hours=1) <= wm} <= set(got)

    q = start_query(messages_stream(stream, "10 minutes", EVENT_THRESHOLDS, ts="ts", node="user_id",
                                    metric="event_type", value="value"),
                    "ev_msg_t", checkpoint=f"{tmp_dir}/ck_m", available_now=True)
    q.awaitTermination()
    got = {(r["user_id"], r["ts"]): r["message"] for r in spark.sql("SELECT * FROM ev_msg_t").collect()}
    want = {(r["user_id"], r["ts"]): r["message"] for r in alert_messages(
        metric_alerts(batch, EVENT_THRESHOLDS, ts="ts", node="user_id", metric="event_type", value="value"),
        ts="ts", node="user_id").collect()}
    assert got and all(want[k] == v for k, v in got.items())
    assert {k for k in want if k[1] < wm} <= set(got)


_APPLICATION = """
import sys
sys.path.insert(0, sys.argv[1])
from clientlens.__main__ import main
from clientlens.session import build_session
spark = build_session("local[2]", shuffle_partitions=2, extra={"spark.checkpoint.dir": sys.argv[4]})
main(["monitor", "--input", sys.argv[2], "--output", sys.argv[3], "--once"], spark)
spark.stop()
"""


def test_monitor_resumes_in_another_application(spark, tmp_dir):
    """Two applications, new samples in between: everything exactly once."""
    import subprocess
    import sys

    from clientlens.streaming import read_latest
    src, out = f"{tmp_dir}/res_in", f"{tmp_dir}/res_out"
    rows, late = _samples(), T0 + dt.timedelta(hours=30)
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    more = [(late, "n3", "cpu", 99.0), (late, "n3", "cpu", 97.0), (late, "n1", "disk", 91.0)]
    for i, part in enumerate((rows, more, [(late + dt.timedelta(hours=9), "n9", "cpu", 1.0)])):
        _write_batches(spark, src, [part])
        subprocess.run([sys.executable, "-c", _APPLICATION, repo, src, out, f"{tmp_dir}/shared"], check=True, timeout=300)
    every = spark.createDataFrame(rows + more + [(late + dt.timedelta(hours=9), "n9", "cpu", 1.0)], METRIC_SAMPLE)
    key = lambda df, *c: sorted(tuple(r) for r in df.select(*c).collect())
    assert key(spark.read.parquet(f"{out}/alerts"), "ts", "node", "metric", "value") \
        == key(metric_alerts(every), "ts", "node", "metric", "value")
    msgs = alert_messages(metric_alerts(every))
    assert key(spark.read.parquet(f"{out}/messages"), "node", "ts", "n_alerts") == key(msgs, "node", "ts", "n_alerts")
    hist = metric_history(every, "1 hour", keys=("node", "metric")).where("node <> 'n9'")  # n9's window is still open
    assert key(spark.read.parquet(f"{out}/history"), "window_start", "node", "metric", "n", "max") \
        == key(hist, "window_start", "node", "metric", "n", "max")
    assert key(read_latest(spark, f"{out}/latest"), "node", "metric", "ts", "value") \
        == key(latest_metric(every, tie="value"), "node", "metric", "ts", "value")
    assert {r["value"] for r in read_latest(spark, f"{out}/latest").where("node = 'n3'").collect()} == {99.0}


def test_query_names_its_checkpoint(spark, tmp_dir):
    with pytest.raises(TypeError):
        start_query(spark.range(1), "no_checkpoint")


def test_shared_folder_is_never_made_up(spark, monkeypatch):
    from clientlens import session
    monkeypatch.setattr(type(spark.sparkContext), "getCheckpointDir", lambda self: None)
    old = spark.conf.get("spark.checkpoint.dir")
    monkeypatch.setattr(type(spark.conf), "get", lambda self, k, d=None: None)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(spark)
    assert old


def test_repeated_readings_of_one_metric_count_once(spark):
    rows = _samples()
    again = spark.createDataFrame(rows + rows + [(T0 + dt.timedelta(minutes=1), "n1", "cpu", 96.5)], METRIC_SAMPLE)
    msgs = {(r["node"], r["ts"]): r for r in alert_messages(metric_alerts(again)).collect()}
    two = msgs[("n1", T0 + dt.timedelta(minutes=1))]
    assert two["n_alerts"] == 2 and two["message"] == "High CPU usage: 96.5%\nHigh Memory usage: 86.0%"
