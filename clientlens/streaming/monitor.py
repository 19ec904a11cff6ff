"""Metric samples as a stream: the batch operators of ``operators.metrics``
applied to a streaming DataFrame, plus a small ``start_query`` helper.

* alerts: stateless, append mode;
* combined messages and windowed history: watermark on ``ts``, append mode
  (a window/sample is emitted once the watermark passes it; later rows dropped).
  Messages are two stateful steps in a row: the largest reading of each metric
  of a sample, then the sample's message;
* latest value: keyed state, update mode: a batch writes only the keys it
  changed, and every few batches are merged (``streaming.latest``).

Every query keeps its checkpoint in a folder that the caller names (or beside
its output), never in a folder of the running application, so a monitor that is
started again goes on where the last one stopped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from clientlens.operators.metrics import (DEFAULT_THRESHOLDS, alert_messages, latest_metric,
                                          metric_alerts, metric_history)
from clientlens.sources.schemas import METRIC_SAMPLE
from clientlens.streaming.latest import latest_writer


def read_metric_stream(spark: SparkSession, path: str, schema: StructType = METRIC_SAMPLE,
                       fmt: str = "parquet", max_files_per_trigger: int | None = None) -> DataFrame:
    """File stream of metric samples (any file format; schema declared)."""
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def _event_time(df: DataFrame, ts: str, watermark: str) -> DataFrame:
    # watermarks need TIMESTAMP (not TIMESTAMP_NTZ)
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, watermark)


def alerts_stream(stream: DataFrame, thresholds: Sequence[tuple] = DEFAULT_THRESHOLDS, **cols) -> DataFrame:
    return metric_alerts(stream, thresholds, **cols)


def messages_stream(stream: DataFrame, watermark: str = "10 minutes",
                    thresholds: Sequence[tuple] = DEFAULT_THRESHOLDS, ts: str = "ts",
                    node: str = "node", **cols) -> DataFrame:
    alerts = metric_alerts(_event_time(stream, ts, watermark), thresholds, ts=ts, node=node,
                           after_watermark=True, **cols)
    return alert_messages(alerts, ts=ts, node=node)


def latest_stream(stream: DataFrame, **kw) -> DataFrame:
    return latest_metric(stream, **kw)


def history_stream(stream: DataFrame, width: str = "1 hour", watermark: str = "10 minutes",
                   **kw) -> DataFrame:
    return metric_history(stream, width=width, watermark=watermark, **kw)


def start_query(df: DataFrame, name: str, checkpoint: str, output_mode: str = "append", sink: str = "memory",
                path: str | None = None, available_now: bool = False,
                processing_time: str | None = None) -> StreamingQuery:
    """Start a streaming query. ``checkpoint`` is its own folder: started again
    with the same one, the query resumes; with another, it starts over."""
    w = df.writeStream.queryName(name).outputMode(output_mode).format(sink).option("checkpointLocation", checkpoint)
    if path:
        w = w.option("path", path)
    return _triggered(w, available_now, processing_time).start()


def _triggered(writer, available_now: bool, processing_time: str | None):
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=processing_time) if processing_time else writer


def start_monitor(spark: SparkSession, source: str, out: str,
                  thresholds: Sequence[tuple] = DEFAULT_THRESHOLDS, width: str = "1 hour",
                  watermark: str = "10 minutes", schema: StructType = METRIC_SAMPLE,
                  fmt: str = "parquet", name: str = "monitor", available_now: bool = False,
                  processing_time: str = "60 seconds", max_files_per_trigger: int | None = None,
                  ts: str = "ts", node: str = "node", metric: str = "metric",
                  value: str = "value", checkpoint: str | None = None, compact_every: int = 20) -> dict[str, StreamingQuery]:
    """The monitoring loop as four streaming queries over one source of
    metric samples (default trigger: every 60 s):

    * ``alerts``   one row per breach, appended to ``<out>/alerts``;
    * ``messages`` one combined message per (node, ts), appended once the
      watermark passes the sample;
    * ``history``  closed ``width`` windows per (node, metric), appended;
    * ``latest``   latest value per (node, metric); of several at one time the
      largest. Update mode: each batch writes the keys it changed to
      ``<out>/latest``; every ``compact_every`` batches are merged into a
      snapshot, and ``read_latest`` gives one row per key.

    Each query's checkpoint is ``<checkpoint>/<query>``, by default
    ``<out>/_checkpoints/<query>``: started again on the same output, every
    query resumes where it stopped, whatever application ran it before.
    """
    ck = checkpoint or f"{out.rstrip('/')}/_checkpoints"
    stream = read_metric_stream(spark, source, schema, max_files_per_trigger=max_files_per_trigger)
    cols = dict(ts=ts, node=node, metric=metric, value=value)
    trig = dict(available_now=available_now, processing_time=processing_time)
    qs = {
        "alerts": start_query(alerts_stream(stream, thresholds, **cols), f"{name}_alerts", f"{ck}/alerts",
                              sink=fmt, path=f"{out}/alerts", **trig),
        "messages": start_query(messages_stream(stream, watermark, thresholds, **cols), f"{name}_messages",
                                f"{ck}/messages", sink=fmt, path=f"{out}/messages", **trig),
        "history": start_query(history_stream(stream, width, watermark, keys=(node, metric), ts=ts, value=value),
                               f"{name}_history", f"{ck}/history", sink=fmt, path=f"{out}/history", **trig),
    }
    w = (latest_stream(stream, keys=(node, metric), ts=ts, value=value, tie=value).writeStream
         .queryName(f"{name}_latest").outputMode("update")
         .option("checkpointLocation", f"{ck}/latest")
         .foreachBatch(latest_writer(f"{out}/latest", (node, metric), fmt, compact_every)))
    qs["latest"] = _triggered(w, available_now, processing_time).start()
    return qs
