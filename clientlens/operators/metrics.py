"""Metric samples ``(ts, node, metric, value)``: threshold alerts, combined
messages, latest values and windowed history. Each function works on a batch
DataFrame and on a streaming one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, IntegerType, IntegralType, StringType, StructField, StructType

from clientlens.functions.calendar import epoch_micros

# Alert thresholds in percent (alert when strictly greater) and labels.
DEFAULT_THRESHOLDS = (
    ("cpu", "CPU", 80.0),
    ("memory", "Memory", 85.0),
    ("disk", "Disk", 90.0),
)

THRESHOLD_SCHEMA = StructType([
    StructField("ordinal", IntegerType()), StructField("metric", StringType()),
    StructField("label", StringType()), StructField("threshold", DoubleType()),
])


def thresholds_frame(spark: SparkSession, thresholds: Sequence[tuple] = DEFAULT_THRESHOLDS) -> DataFrame:
    """Threshold table ``ordinal, metric, label, threshold`` (one row per metric)."""
    rows = [(i, m, lab, float(t)) for i, (m, lab, t) in enumerate(thresholds)]
    return spark.createDataFrame(rows, THRESHOLD_SCHEMA)


def metric_alerts(df: DataFrame, thresholds: Sequence[tuple] = DEFAULT_THRESHOLDS, ts: str = "ts",
                  node: str = "node", metric: str = "metric", value: str = "value",
                  after_watermark: bool = False) -> DataFrame:
    """One row per breach (``value > threshold``) with the message
    ``High <label> usage: <value>%``. The threshold table has one row per
    metric given by the caller, so broadcasting it is bounded; stateless, so it
    runs in append mode on a stream.

    On a stream with a watermark, ``after_watermark`` ties the conditions to
    ``ts``: the optimizer then leaves them above the watermark, which moves with
    every sample and not with breaches only."""
    def holds(cond: Column) -> Column:
        return F.when(cond, F.col(ts)).isNotNull() if after_watermark else cond

    t = F.broadcast(thresholds_frame(df.sparkSession, thresholds))
    # implied literal filter: reaches the parquet scan (row-group skipping)
    # before the join re-checks each row against its own threshold
    df = df.where(holds(F.col(metric).isin([m for m, _, _ in thresholds])
                        & (F.col(value) > F.lit(min(float(x) for _, _, x in thresholds)))))
    return (df.join(t, df[metric] == t["metric"])
              .where(holds(df[value] > t["threshold"]))
              .select(df[ts].alias(ts), df[node].alias(node), df[metric].alias(metric),
                      df[value].alias(value), t["threshold"], t["ordinal"],
                      F.concat(F.lit("High "), t["label"], F.lit(" usage: "),
                               df[value].cast(StringType()), F.lit("%")).alias("message")))


def alert_messages(alerts: DataFrame, ts: str = "ts", node: str = "node", value: str = "value") -> DataFrame:
    """One combined message per sample (node, ts): breaches in threshold order
    joined by newlines, one per metric. A reading that is sent again, or several
    of one metric at one time, count once: the largest speaks for the metric.

    Two aggregations in a row: the largest breach of each (node, ts, threshold),
    then the sample's message from at most one row per threshold. Neither holds
    more than one value per metric, however many readings differ. On a stream,
    give ``alerts`` a watermark on ``ts`` first (append mode): the second step
    gets a metric's breach once the watermark has passed the sample."""
    each = alerts.groupBy(node, ts, "ordinal").agg(F.max_by("message", value).alias("_message"))
    return (each.groupBy(node, ts).agg(F.array_sort(F.collect_list(F.struct("ordinal", "_message"))).alias("_each"))
                .select(node, ts, F.size("_each").cast("long").alias("n_alerts"),
                        F.concat_ws("\n", F.transform("_each", lambda s: s["_message"])).alias("message")))


def _packed_order(df: DataFrame, ts: str, tie: str) -> Column | None:
    """Exact single-value ordering key for (ts, tie): ``micros(ts) * 10^20 +
    (tie + 2^63)`` as decimal(38,0), for a timestamp / timestamp_ntz / date /
    integral ``ts`` and an integral ``tie``; None otherwise. A decimal buffer
    is mutable in place, so ``max_by`` over it stays a hash aggregation (a
    struct key forces a sort-based one). The ntz epoch offset is taken without
    any time zone, so the key is monotone in ``ts`` whatever the session zone."""
    micros = epoch_micros(df.schema[ts].dataType, ts)
    if micros is None or not isinstance(df.schema[tie].dataType, IntegralType):
        return None
    d = "DECIMAL(38,0)"
    return F.expr(f"CAST({micros} AS {d}) * CAST('100000000000000000000' AS {d}) "
                  f"+ (CAST(`{tie}` AS {d}) + CAST('9223372036854775808' AS {d}))")


def latest_metric(df: DataFrame, keys: Sequence[str] = ("node", "metric"), ts: str = "ts",
                  value: str = "value", tie: str | None = None) -> DataFrame:
    """Latest reading per key (a gauge): ``max_by`` over (ts, tie), a hash
    aggregation with a partial step, so each task ships one row per key.
    Without ``tie`` equal times resolve arbitrarily; with an integral ``tie``
    the pair is packed into one exact decimal key; other tie types use a
    struct key (sort-based aggregation, still partial)."""
    if tie is None:
        order = F.col(ts)
    else:
        order = _packed_order(df, ts, tie)
        if order is None:
            order = F.struct(ts, tie)
    return df.groupBy(*keys).agg(F.max(ts).alias(ts), F.max_by(value, order).alias(value))


def metric_history(df: DataFrame, width: str = "1 hour", keys: Sequence[str] = ("metric",),
                   ts: str = "ts", value: str = "value", watermark: str | None = None) -> DataFrame:
    """Tumbling-window count/mean/min/max per key. With ``watermark`` (streams),
    ``ts`` is cast to ``timestamp`` and windows are emitted once closed."""
    src = df
    if watermark:
        src = df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, watermark)
    return (src.groupBy(F.window(ts, width).alias("w"), *keys)
               .agg(F.count(value).alias("n"), F.avg(value).alias("mean"),
                    F.min(value).alias("min"), F.max(value).alias("max"))
               .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                       *keys, "n", "mean", "min", "max"))
