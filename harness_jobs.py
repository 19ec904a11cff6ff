"""Registered queries of the jobs that write, reload or stream the test tables,
with their DuckDB SQL. Each runs a whole job over a whole table in the shared
folder and returns what a later reader would see. Not part of the bench, whose
queries are single analyses."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType, TimestampNTZType

from clientlens.operators import (category_revenue, client_loyalty, customer_summary, distinct_from_sketches, distinct_per_period,
                                  distinct_sketches, rfm, weekday_patterns)
from clientlens.plans import spending_report
from clientlens.plans.incremental import ClientStore
from clientlens.sources import read_csv, read_json_lines, CUSTOMER_SUMMARY
from clientlens.sources.bucketed import read_bucketed, write_bucketed
from clientlens.sources.quarantine import load_csv
from clientlens.sources.writers import write_tables
from clientlens.streaming import latest_stream, latest_writer, messages_stream, read_latest
from clientlens.streaming.purchases import STATE_STORE, dedupe_stream, transition_counts, transitions_stream
from harness_tables import AS_OF_ORDERS, EVENT_THRESHOLDS, EVENTS, ORDERS, ORDERS_MONETARY, read_table

Job = Callable[[SparkSession, str, str], DataFrame]

EVENT_CSV = StructType([StructField("event_id", LongType()), StructField("user_id", LongType()), StructField("event_type", StringType()),
                        StructField("value", DoubleType()), StructField("ts", TimestampNTZType())])


# ------------------------------------------------------------------ sources and sinks
def csv_revenue(spark: SparkSession, sf: str, folder: str) -> DataFrame:
    """events as CSV with a header in another column order, read back by name."""
    read_table(spark, sf, "events").select("value", "ts", "event_type", "event_id", "user_id") \
        .write.csv(f"{folder}/events", header=True)
    return category_revenue(read_csv(spark, f"{folder}/events", EVENT_CSV), EVENTS)


def csv_quarantine(spark: SparkSession, sf: str, folder: str) -> DataFrame:
    """events as CSV in which every error event has text for its value: the
    others load, the errors are kept apart."""
    ev = read_table(spark, sf, "events")
    value = F.when(F.col("event_type") == "error", "broken").otherwise(F.col("value").cast("string"))
    ev.select("event_id", "user_id", "event_type", value.alias("value"), "ts").write.csv(f"{folder}/events", header=True)
    good = load_csv(spark, f"{folder}/events", EVENT_CSV, f"{folder}/bad")
    bad = spark.read.parquet(f"{folder}/bad")
    loaded = good.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    kept = bad.groupBy(F.split("record", ",")[2].alias("event_type")).agg(F.countDistinct("file", "line").alias("n"), F.lit(None).cast("double").alias("total"))
    return loaded.withColumn("loaded", F.lit(True)).unionByName(kept.withColumn("loaded", F.lit(False)))


def json_summary(spark: SparkSession, sf: str, folder: str) -> DataFrame:
    """Customer summaries of events as JSON lines, read back with their schema."""
    customer_summary(read_table(spark, sf, "events"), EVENTS).write.json(f"{folder}/summary")
    return read_json_lines(spark, f"{folder}/summary", CUSTOMER_SUMMARY)


def spending_stats(spark: SparkSession, sf: str, folder: str) -> DataFrame:
    """The spending report's statistics row, read back from its JSON file; the
    generation time must be of this run."""
    customer_summary(read_table(spark, sf, "events"), EVENTS).write.json(f"{folder}/summary")
    paths = spending_report(spark, f"{folder}/summary", f"{folder}/report")
    stats = spark.read.json(paths["analysis_stats"])
    age = F.current_timestamp().cast("long") - F.to_timestamp("generated_at", "yyyy-MM-dd HH:mm:ss").cast("long")
    return stats.select("total_transactions", "unique_categories", "average_spending", "max_spending", "min_spending",
                        age.between(-5, 3600).alias("just_generated"))


def rfm_today(spark: SparkSession, sf: str, folder: str) -> DataFrame:
    """Recency against today, less the days that the reference day lies back."""
    scored = rfm(read_table(spark, sf, "orders"), ORDERS, monetary=ORDERS_MONETARY)
    since = F.datediff(F.current_date(), F.lit(AS_OF_ORDERS).cast("date"))
    return scored.select("o_custkey", (F.col("recence") - since).alias("recence"))


def chart_weekdays(spark: SparkSession, sf: str, folder: str) -> DataFrame:
    """Chart data as written: the bars with their place in the file."""
    paths = write_tables({"weekdays": weekday_patterns(read_table(spark, sf, "events"), EVENTS)}, folder, order_by={"weekdays": "jour_semaine"})
    return spark.read.parquet(paths["weekdays"]).select("jour_semaine", "nombre_achats", F.monotonically_increasing_id().alias("place"))


def bucketed_rfm(spark: SparkSession, sf: str, folder: str) -> DataFrame:
    """RFM of orders over a table bucketed by customer."""
    name = f"orders_{uuid.uuid4().hex}"
    write_bucketed(read_table(spark, sf, "orders"), f"{folder}/orders", ORDERS.client, 8, name, sort=ORDERS.ts)
    return rfm(read_bucketed(spark, f"{folder}/orders", name), ORDERS, as_of=AS_OF_ORDERS, monetary=ORDERS_MONETARY)


# ------------------------------------------------------------------ incremental
def incremental_loyalty(spark: SparkSession, sf: str, folder: str) -> DataFrame:
    """Loyalty of orders from three loads, the second of them made twice."""
    orders = read_table(spark, sf, "orders")
    store = ClientStore(spark, f"{folder}/clients", ORDERS, buckets=8)
    parts = {"until 1996": "o_orderdate < '1997-01-01'", "1997": "year(o_orderdate) = 1997", "from 1998": "o_orderdate >= '1998-01-01'"}
    store.load_day("until 1996", orders.where(parts["until 1996"]))
    store.load_day("1997", orders.where("o_orderdate >= '1997-05-01' and year(o_orderdate) = 1997"))
    store.load_day("from 1998", orders.where(parts["from 1998"]))
    store.load_day("1997", orders.where(parts["1997"]))
    return store.loyalty()


def distinct_users(spark: SparkSession, sf: str, folder: str) -> DataFrame:
    """Users per month: the exact count, and whether the union of the stored
    daily sketches is within five standard errors of it."""
    ev = read_table(spark, sf, "events")
    path = f"{folder}/sketches"
    distinct_sketches(ev, F.to_date("ts"), "user_id").write.parquet(path)
    near = distinct_from_sketches(spark.read.parquet(path), F.date_trunc("month", F.col("period")).cast("date"), "month")
    exact = distinct_per_period(ev, F.date_trunc("month", F.col("ts")).cast("date"), "user_id")
    off = F.abs(F.col("near.n_distinct") - F.col("exact.n_distinct"))
    return exact.alias("exact").join(near.alias("near"), F.col("exact.period") == F.col("near.month")).select(
        F.col("exact.period").alias("month"), F.col("exact.n_distinct").alias("n_users"), F.col("near.rows").alias("rows"),
        (off <= F.greatest(F.lit(1.0), 5 * 1.04 / 64 * F.col("exact.n_distinct"))).alias("sketch_is_near"))


# ------------------------------------------------------------------ streams
#: longer than the tables' time, so that no row is late whatever the files' order
SPAN = "4000 days"


def _as_stream(spark: SparkSession, rows: DataFrame, folder: str, ts: str, marks: dict) -> DataFrame:
    """``rows`` written as a file per core of the cluster (at least 4) and
    streamed in two halves; two rows far behind the last time (``marks``: their
    columns) follow and close everything."""
    files = 2 * max(2, spark.sparkContext.defaultParallelism // 2)
    rows.repartition(files, *rows.columns).write.parquet(folder)
    end = rows.agg((F.max(ts).cast("timestamp") + F.expr("INTERVAL 9000 DAYS")).cast(rows.schema[ts].dataType).alias(ts))
    for _ in range(2):
        end.select(*[(F.col(ts) if f.name == ts else F.lit(marks.get(f.name)).cast(f.dataType)).alias(f.name) for f in rows.schema.fields]) \
            .write.mode("append").parquet(folder)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files // 2).parquet(folder)


def _until_done(writer, folder: str) -> None:
    """Run a stream over all there is, with one state store per core of the
    cluster (a stream keeps the number it starts with)."""
    spark = writer._spark
    settings = {"spark.sql.streaming.stateStore.providerClass": STATE_STORE,
                "spark.sql.shuffle.partitions": str(spark.sparkContext.defaultParallelism)}
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        writer.option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _run(df: DataFrame, folder: str) -> DataFrame:
    _until_done(df.writeStream.outputMode("append").format("parquet").option("path", f"{folder}/out"), folder)
    return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/out")


def stream_transitions(spark: SparkSession, sf: str, folder: str) -> DataFrame:
    """Category transitions of events by the streaming operator."""
    rows = read_table(spark, sf, "events").select("user_id", "ts", "event_id", "event_type")
    pairs = _run(transitions_stream(_as_stream(spark, rows, f"{folder}/in", "ts", {"user_id": -1}), EVENTS, SPAN), folder)
    return transition_counts(pairs.where("user_id >= 0"), EVENTS)


def stream_messages(spark: SparkSession, sf: str, folder: str) -> DataFrame:
    """Combined messages of events by the streaming operator; a sample is a
    user's day, with as many readings of a metric as there are."""
    rows = read_table(spark, sf, "events").select(F.date_trunc("day", "ts").alias("ts"), "user_id", "event_type", "value")
    stream = _as_stream(spark, rows, f"{folder}/in", "ts", {"user_id": -1, "event_type": "view", "value": 0.0})
    out = messages_stream(stream, SPAN, EVENT_THRESHOLDS, ts="ts", node="user_id", metric="event_type", value="value")
    return _run(out, folder).select("user_id", F.to_date("ts").alias("day"), "n_alerts", "message")


def stream_latest(spark: SparkSession, sf: str, folder: str) -> DataFrame:
    """The latest-value table that a stream over events keeps, compacted on the way."""
    rows = read_table(spark, sf, "events").select("user_id", "event_type", "ts", "value")
    stream = _as_stream(spark, rows, f"{folder}/in", "ts", {"user_id": -1})
    keys = ("user_id", "event_type")
    _until_done(latest_stream(stream, keys=keys, ts="ts", value="value", tie="value").writeStream.outputMode("update")
                .foreachBatch(latest_writer(f"{folder}/latest", keys, compact_every=2)), folder)
    return read_latest(spark, f"{folder}/latest", keys, "ts", "value").where("user_id >= 0")


def stream_dedupe(spark: SparkSession, sf: str, folder: str) -> DataFrame:
    """Revenue per category of events that are all sent twice."""
    rows = read_table(spark, sf, "events").select("event_id", "ts", "event_type", "value")
    twice = rows.unionByName(rows)
    out = _run(dedupe_stream(_as_stream(spark, twice, f"{folder}/in", "ts", {"event_id": -1}), "event_id", "ts", watermark=SPAN), folder)
    return category_revenue(out.where("event_id >= 0"), EVENTS)


JOBS: dict[str, Job] = {f.__name__: f for f in (
    csv_revenue, csv_quarantine, json_summary, spending_stats, rfm_today, chart_weekdays, bucketed_rfm, incremental_loyalty, distinct_users,
    stream_transitions, stream_messages, stream_latest, stream_dedupe)}


def queries(shared: Callable[[SparkSession], str]) -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every job in a folder of its own under the shared one."""
    def bound(name: str, job: Job):
        def run(spark: SparkSession, sf: str) -> DataFrame:
            # Python workers import this repository wherever the driver was started
            env, here = spark.sparkContext.environment, os.path.dirname(os.path.abspath(__file__))
            if here not in env.get("PYTHONPATH", "").split(os.pathsep):
                env["PYTHONPATH"] = os.pathsep.join(x for x in (here, env.get("PYTHONPATH", "")) if x)
            return job(spark, sf, f"{shared(spark)}/{name}-{uuid.uuid4().hex}")
        run.__name__ = name
        return run
    return {name: bound(name, job) for name, job in JOBS.items()}


# ------------------------------------------------------------------ SQL
_REVENUE_SQL = "SELECT event_type, count(*) AS nombre_achats, sum(value) AS revenu_total, avg(value) AS montant_moyen FROM events GROUP BY event_type"


def raw_sql(shared: dict[str, str]) -> dict[str, str]:
    """SQL by query; ``shared``: SQL of other queries with the same result."""
    thresholds = ", ".join(f"({i}, '{m}', '{label}', {float(t)!r}::DOUBLE)" for i, (m, label, t) in enumerate(EVENT_THRESHOLDS))
    return {
        "csv_revenue": _REVENUE_SQL,
        "csv_quarantine": """
SELECT event_type, count(*) AS n, CASE WHEN event_type = 'error' THEN NULL ELSE sum(value) END AS total,
       event_type <> 'error' AS loaded FROM events GROUP BY event_type""",
        "json_summary": f"SELECT * REPLACE (customer_id::VARCHAR AS customer_id) FROM ({shared['customer_summary']}) s",
        "spending_stats": f"""
SELECT count(*) AS total_transactions, count(DISTINCT category) AS unique_categories, avg(total_amount) AS average_spending,
       max(total_amount) AS max_spending, min(total_amount) AS min_spending, true AS just_generated
FROM ({shared["customer_summary"]}) s""",
        "rfm_today": f"SELECT o_custkey, recence FROM ({shared['rfm_scores']}) r",
        "chart_weekdays": """
SELECT jour_semaine, nombre_achats, row_number() OVER (ORDER BY jour_semaine) - 1 AS place
FROM (SELECT (dayofweek(ts) + 1)::INTEGER AS jour_semaine, count(*) AS nombre_achats FROM events GROUP BY 1) w""",
        "bucketed_rfm": shared["rfm_scores"],
        "incremental_loyalty": shared["client_loyalty"],
        "distinct_users": """
SELECT date_trunc('month', ts)::DATE AS month, count(DISTINCT user_id) AS n_users, count(user_id) AS rows, true AS sketch_is_near
FROM events GROUP BY 1""",
        "stream_transitions": shared["category_transitions"],
        "stream_messages": f"""
WITH t(ordinal, metric, label, threshold) AS (VALUES {thresholds}),
l AS (SELECT user_id, event_type, ts::DATE AS day, max(value) AS value FROM events GROUP BY 1, 2, 3)
SELECT user_id, day, count(*) AS n_alerts,
       string_agg('High ' || label || ' usage: ' || CAST(value AS VARCHAR) || '%', chr(10) ORDER BY ordinal) AS message
FROM l JOIN t ON l.event_type = t.metric WHERE value > threshold GROUP BY user_id, day""",
        "stream_latest": """
SELECT user_id, event_type, max(ts) AS ts, arg_max(value, (ts, value)) AS value FROM events GROUP BY user_id, event_type""",
        "stream_dedupe": _REVENUE_SQL,
    }


#: double columns, rounded as those of the other queries
DOUBLES = {
    "csv_revenue": ["revenu_total", "montant_moyen"], "csv_quarantine": ["total"], "json_summary": ["total_amount"],
    "spending_stats": ["average_spending", "max_spending", "min_spending"], "bucketed_rfm": ["montant_total", "rfm_score"],
    "incremental_loyalty": ["montant_total"], "stream_latest": ["value"], "stream_dedupe": ["revenu_total", "montant_moyen"],
}
