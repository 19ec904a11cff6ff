"""Command line jobs, run in-process on the test session."""

import os

from clientlens.__main__ import main
from clientlens.streaming import read_latest

from test_sample_fixture import SAMPLE_CSV


def test_cli_segment_then_analyze(spark, tmp_dir):
    p = os.path.join(tmp_dir, "c.csv")
    with open(p, "w") as f:
        f.write(SAMPLE_CSV)
    seg = main(["segment", "--input", p, "--output", os.path.join(tmp_dir, "seg")], spark)
    ana = main(["analyze", "--input", seg["processed_data"], "--output", os.path.join(tmp_dir, "ana")], spark)
    a = sorted(map(tuple, spark.read.parquet(seg["cluster_stats"]).collect()))
    b = sorted(map(tuple, spark.read.parquet(ana["cluster_stats"]).collect()))
    assert a == b and len(a) == 3


def test_cli_insights_on_events(spark, tmp_dir):
    out = main(["insights", "--input", "/root/testdata/sf0.001/events.parquet", "--output",
                os.path.join(tmp_dir, "ins"), "--as-of", "2024-02-01",
                "--roles", "user_id,ts,value,event_type,event_id"], spark)
    assert spark.read.parquet(out["weekday_patterns"]).count() == 7


def test_cli_monitor_once(spark, tmp_dir):
    from test_metrics import _samples, _write_batches
    src = os.path.join(tmp_dir, "samples")
    _write_batches(spark, src, [_samples()])
    out = main(["monitor", "--input", src, "--output", os.path.join(tmp_dir, "mon"), "--once"], spark)
    assert spark.read.parquet(out["alerts"]).count() == 4
    assert read_latest(spark, out["latest"]).count() == 5   # (node, metric) keys: n1 x 3, n2 x 2
