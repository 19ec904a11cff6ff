"""

Role mapping onto the test tables:
  events: client=user_id, time=ts, amount=value, category=event_type, id=event_id
  orders: client=o_custkey, time=o_orderdate, amount=o_totalprice,
          category=o_orderpriority, id=o_orderkey

Every registered query reads whole tables. Double outputs are rounded to 4
decimals on both sides, the same way (``round_doubles`` / ``round(CAST(x AS
DECIMAL(38,10)), 4)``), so the summation order of two engines cannot change the
compared values.
"""

from __future__ import annotations

import os
import sys
import tempfile
import uuid
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession, functions as F

from clientlens.functions.numeric import round_doubles
from clientlens.operators import (alert_messages, assemble_scale, bootstrap_interval, bootstrap_sums, category_revenue,
                                  category_spending,
                                  category_transitions, clean_customers, client_loyalty,
                                  cluster_stats, customer_summary, describe, describe_by, distinct_count, encode_flag,
                                  fit_checks, global_stats, histogram, hourly_patterns, kmeans_assign, kmeans_fit,
                                  label_segments, latest_first, latest_metric, mean_interval, melt, metric_alerts,
                                  metric_history, processing_stats, retention_by_year, rfm, scatter_points,
                                  segment_members, segment_profile, standardize, top_customers,
                                  vector_columns, weekday_patterns)
from clientlens.operators.bootstrap import PRIME, poisson_steps
from clientlens.session import checkpoint_dir
from clientlens.plans import insights_report, segment_customers, segment_report
from clientlens.plans.insights import RFM_DESCRIBED
import harness_jobs
from harness_tables import (AS_OF_ORDERS, EVENT_THRESHOLDS, EVENTS, FIXED_CENTRES, ORDERS, ORDERS_MONETARY,
                            read_table)

SMOKE_DIR = "/root/testdata/sf0.001"


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return read_table(spark, sf, name)


def _shared(spark: SparkSession) -> str:
    """The cluster's shared folder; where none is set, as in a bare local
    session, one for this session."""
    if not spark.conf.get("spark.checkpoint.dir", None) and spark.sparkContext.getCheckpointDir() is None \
            and spark.sparkContext.master.startswith("local["):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="clientlens-entry-"))
    return checkpoint_dir(spark)


# ------------------------------------------------------------------ purchases
def q_rfm_scores(spark, sf):
    return rfm(_t(spark, sf, "orders"), ORDERS, as_of=AS_OF_ORDERS, monetary=ORDERS_MONETARY)


def q_weekday_patterns(spark, sf):
    return weekday_patterns(_t(spark, sf, "events"), EVENTS)


def q_hourly_patterns(spark, sf):
    return hourly_patterns(_t(spark, sf, "events"), EVENTS)


def q_category_revenue(spark, sf):
    return category_revenue(_t(spark, sf, "events"), EVENTS)


def q_category_transitions(spark, sf):
    return category_transitions(_t(spark, sf, "events"), EVENTS)


def q_priority_transitions(spark, sf):
    # orders hold same-day orders of one customer: the id tie-break decides
    return category_transitions(_t(spark, sf, "orders"), ORDERS)


def q_client_loyalty(spark, sf):
    return client_loyalty(_t(spark, sf, "orders"), ORDERS)


def q_retention_by_year(spark, sf):
    return retention_by_year(client_loyalty(_t(spark, sf, "orders"), ORDERS))


# ------------------------------------------------------------------ cleaning, scalars
def _events_with_nulls(spark, sf):
    ev = _t(spark, sf, "events")
    return ev.select("event_id", "user_id", "ts",
                     F.expr("nullif(event_type, 'error')").alias("event_type"), "value")


def q_clean_customers(spark, sf):
    return clean_customers(_events_with_nulls(spark, sf), "user_id",
                           [F.desc("ts"), F.desc("event_id")])


def q_encode_flag(spark, sf):
    ev = _t(spark, sf, "events")
    return encode_flag(ev, "event_type", "purchase", "is_purchase").select("event_id", "is_purchase")


def q_distinct_categories(spark, sf):
    return distinct_count(_t(spark, sf, "events"), "event_type")


# ------------------------------------------------------------------ features, clusters
def _event_features(spark, sf):
    ev = _t(spark, sf, "events")
    ev = encode_flag(ev, "event_type", "purchase", "is_purchase")
    return ev.withColumn("hour", F.hour("ts").cast("double"))


FEATURES = ("value", "hour", "is_purchase")


def q_scaled_features(spark, sf):
    scaled, _ = assemble_scale(_event_features(spark, sf), FEATURES)
    return vector_columns(scaled, "scaled_features", ["z_value", "z_hour", "z_flag"]) \
        .select("event_id", "z_value", "z_hour", "z_flag")


def _assigned(spark, sf):
    z = standardize(_event_features(spark, sf), FEATURES)
    return kmeans_assign(z, ["z_value", "z_hour", "z_is_purchase"], FIXED_CENTRES)


def q_kmeans_assign(spark, sf):
    return _assigned(spark, sf).select("event_id", "cluster")


def q_segment_profile(spark, sf):
    p = segment_profile(_assigned(spark, sf), "cluster", "hour", "value", "event_type")
    # the sorted (label, count) array as text, which every engine writes alike
    return p.withColumn("segments", F.concat_ws(",", F.transform(
        "segments", lambda x: F.concat_ws(":", x["segment"], x["n"].cast("string")))))


def q_segment_members(spark, sf):
    return segment_members(_assigned(spark, sf), "cluster", "event_type")


def q_cluster_stats(spark, sf):
    return cluster_stats(_assigned(spark, sf), "cluster", "value", age="hour")


def q_cluster_amount_stats(spark, sf):
    # the statistics table the segmentation job saves (no age column)
    return cluster_stats(_assigned(spark, sf), "cluster", "value")


def q_processing_stats(spark, sf):
    return processing_stats(_assigned(spark, sf), "cluster")


def q_segment_long(spark, sf):
    return melt(q_cluster_stats(spark, sf), ["cluster"], ["age_moyen", "montant_moyen"])


def q_segment_labels(spark, sf):
    return label_segments(q_cluster_stats(spark, sf))


def q_kmeans_fit(spark, sf):
    _shared(spark)
    scaled = assemble_scale(_event_features(spark, sf), FEATURES)[0].select("scaled_features").checkpoint()
    return fit_checks(scaled, kmeans_fit(scaled, "scaled_features", k=3, seed=42))


# ------------------------------------------------------------------ summaries
def q_describe_amount(spark, sf):
    return describe(_t(spark, sf, "events"), ["value"])


def q_rfm_describe(spark, sf):
    return describe(q_rfm_scores(spark, sf), list(RFM_DESCRIBED))


def q_amount_histogram(spark, sf):
    return histogram(_t(spark, sf, "events"), "value", 20)


def q_rfm_histogram(spark, sf):
    return histogram(q_rfm_scores(spark, sf), "rfm_score", 20)


def q_category_mean_interval(spark, sf):
    return mean_interval(_t(spark, sf, "events"), "event_type", "value")


def q_category_bootstrap(spark, sf):
    return bootstrap_interval(_t(spark, sf, "events"), "event_type", "value", "event_id")


def q_category_bootstrap_sums(spark, sf):
    return bootstrap_sums(_t(spark, sf, "events"), "event_type", "value", "event_id")


def q_describe_by_category(spark, sf):
    _shared(spark)
    return describe_by(_t(spark, sf, "events"), "event_type", "value")


def q_customer_summary(spark, sf):
    return customer_summary(_t(spark, sf, "events"), EVENTS)


def q_category_spending(spark, sf):
    return category_spending(q_customer_summary(spark, sf))


def q_top_customers(spark, sf):
    return top_customers(customer_summary(_t(spark, sf, "orders"), ORDERS), 10)


def q_global_stats(spark, sf):
    return global_stats(q_customer_summary(spark, sf))


def q_scatter_points(spark, sf):
    return scatter_points(q_customer_summary(spark, sf))


# ------------------------------------------------------------------ metric samples
_M = dict(ts="ts", node="user_id", metric="event_type", value="value")


def q_metric_alerts(spark, sf):
    return metric_alerts(_t(spark, sf, "events"), EVENT_THRESHOLDS, **_M)


def q_alert_messages(spark, sf):
    # a sample is a user's day: the latest reading of each metric on it
    ev = _t(spark, sf, "events").withColumn("day", F.to_date("ts"))
    latest = latest_metric(ev, keys=("user_id", "event_type", "day"), ts="ts", value="value", tie="event_id")
    alerts = metric_alerts(latest, EVENT_THRESHOLDS, **_M | {"ts": "day"})
    return alert_messages(alerts, ts="day", node="user_id")


def q_latest_metric(spark, sf):
    return latest_metric(_t(spark, sf, "events"), keys=("user_id", "event_type"), ts="ts",
                         value="value", tie="event_id")


def q_metric_history(spark, sf):
    return metric_history(_t(spark, sf, "events"), "1 hour", keys=("event_type",), ts="ts", value="value")


# ------------------------------------------------------------------ composite jobs
def _insights(spark, sf, name):
    """One table of the whole report, read back from where it was written."""
    paths = insights_report(_t(spark, sf, "orders"), ORDERS, f"{_shared(spark)}/insights-{uuid.uuid4().hex}",
                            as_of=AS_OF_ORDERS, rfm_kwargs={"monetary": ORDERS_MONETARY})
    return spark.read.parquet(paths[name])


def q_insights_rfm_describe(spark, sf):
    return _insights(spark, sf, "rfm_describe")


def q_insights_weekday(spark, sf):
    return _insights(spark, sf, "weekday_patterns")


def q_insights_transitions(spark, sf):
    return _insights(spark, sf, "category_transitions")


def _segment_report(spark, sf):
    """The segmentation job over the users of ``events``: the latest complete
    row of each, flag on purchases."""
    raw = _events_with_nulls(spark, sf).withColumn("hour", F.hour("ts").cast("double"))
    _shared(spark)
    result = segment_customers(raw, "user_id", latest_first(raw, "ts"), flag_col="event_type", flag_value="purchase",
                               flag_out="is_purchase", inputs=FEATURES, age="hour", amount="value", label="event_type")
    return segment_report(result, f"{_shared(spark)}/segments-{uuid.uuid4().hex}", age="hour", amount="value", label="event_type")


def q_segment_report_stats(spark, sf):
    return spark.read.parquet(_segment_report(spark, sf)["processing_stats"])


def q_segment_report_totals(spark, sf):
    # k-means decides the clusters, but their statistics must add up to the cleaned table
    s = spark.read.parquet(_segment_report(spark, sf)["cluster_stats"])
    return s.agg(F.sum("nombre_clients").alias("nombre_clients"),
                 (F.sum(F.col("montant_moyen") * F.col("nombre_clients")) / F.sum("nombre_clients")).alias("montant_moyen"),
                 (F.sum(F.col("age_moyen") * F.col("nombre_clients")) / F.sum("nombre_clients")).alias("age_moyen"))


_QUERIES = {
    "rfm_scores": q_rfm_scores,
    "weekday_patterns": q_weekday_patterns,
    "hourly_patterns": q_hourly_patterns,
    "category_revenue": q_category_revenue,
    "category_transitions": q_category_transitions,
    "priority_transitions": q_priority_transitions,
    "client_loyalty": q_client_loyalty,
    "retention_by_year": q_retention_by_year,
    "clean_customers": q_clean_customers,
    "encode_flag": q_encode_flag,
    "distinct_categories": q_distinct_categories,
    "scaled_features": q_scaled_features,
    "kmeans_assign": q_kmeans_assign,
    "segment_profile": q_segment_profile,
    "segment_members": q_segment_members,
    "cluster_stats": q_cluster_stats,
    "cluster_amount_stats": q_cluster_amount_stats,
    "processing_stats": q_processing_stats,
    "segment_long": q_segment_long,
    "segment_labels": q_segment_labels,
    "kmeans_fit": q_kmeans_fit,
    "describe_amount": q_describe_amount,
    "rfm_describe": q_rfm_describe,
    "amount_histogram": q_amount_histogram,
    "rfm_histogram": q_rfm_histogram,
    "category_mean_interval": q_category_mean_interval,
    "category_bootstrap": q_category_bootstrap,
    "category_bootstrap_sums": q_category_bootstrap_sums,
    "describe_by_category": q_describe_by_category,
    "customer_summary": q_customer_summary,
    "category_spending": q_category_spending,
    "top_customers": q_top_customers,
    "global_stats": q_global_stats,
    "scatter_points": q_scatter_points,
    "metric_alerts": q_metric_alerts,
    "alert_messages": q_alert_messages,
    "latest_metric": q_latest_metric,
    "metric_history": q_metric_history,
    "insights_rfm_describe": q_insights_rfm_describe,
    "insights_weekday": q_insights_weekday,
    "insights_transitions": q_insights_transitions,
    "segment_report_stats": q_segment_report_stats,
    "segment_report_totals": q_segment_report_totals,
}

#: jobs that write, reload or stream a table (registered, but not benched)
_JOBS = harness_jobs.queries(_shared)


def _rounded(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return round_doubles(fn(spark, sf_dir), 4)
    run.__name__ = fn.__name__
    return run


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: RFM scores of the sf0.001 orders."""
    return q_rfm_scores(spark, SMOKE_DIR)


def _importable(fn):
    """Python workers import this repository wherever the driver was started
    (a cluster gets it by --py-files)."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        env, here = spark.sparkContext.environment, os.path.dirname(os.path.abspath(__file__))
        if here not in env.get("PYTHONPATH", "").split(os.pathsep):
            env["PYTHONPATH"] = os.pathsep.join(x for x in (here, env.get("PYTHONPATH", "")) if x)
        return fn(spark, sf_dir)
    return run


def _training_data() -> tuple[dict, dict]:
    """Queries and SQL of the training-data operators, if that subpackage and
    its pipeline are there (the only place that allows for their absence)."""
    try:
        from clientlens.llm.queries import ORACLE_SQL as sql, QUERIES as named
        import corpus_pipeline
    except ModuleNotFoundError as e:
        if e.name in ("clientlens.llm", "clientlens.llm.queries", "corpus_pipeline"):
            return {}, {}
        raise
    named = named | {"pipeline": corpus_pipeline.run}
    if corpus_pipeline.ORACLE_SQL is not None:
        sql = sql | {"pipeline": corpus_pipeline.ORACLE_SQL}
    return {k: _importable(v) for k, v in named.items()}, sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: _rounded(v) for k, v in (_QUERIES | _JOBS).items()} | _training_data()[0]


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL) | _training_data()[1]


# ---------------------------------------------------------------------------
# Oracle SQL (DuckDB). Built from the same parameters as the Spark queries.
# DuckDB: dayofweek is Sunday=0 (Spark: Sunday=1); date parts are BIGINT and
# date_diff BIGINT, cast to the Spark INTEGER.

def _ladder(col: str, ts: tuple, op: str) -> str:
    top = len(ts) + 1
    arms = " ".join(f"WHEN {col} {op} {float(t)!r} THEN {top - i}" for i, t in enumerate(ts))
    return f"(CASE {arms} ELSE 1 END)"


_RFM_SQL = f"""
WITH b AS (SELECT o_custkey, max(o_orderdate) AS dernier_achat, count(*) AS frequence,
                  sum(o_totalprice) AS montant_total FROM orders GROUP BY o_custkey),
s AS (SELECT *, date_diff('day', CAST(dernier_achat AS DATE), DATE '{AS_OF_ORDERS}')::INTEGER AS recence FROM b),
t AS (SELECT *, {_ladder('recence', (30, 60, 90, 180), '<=')} AS r_score,
                {_ladder('frequence', (10, 7, 5, 3), '>=')} AS f_score,
                {_ladder('montant_total', ORDERS_MONETARY, '>=')} AS m_score FROM s)
SELECT o_custkey, dernier_achat, frequence, montant_total, recence, r_score, f_score, m_score,
       (r_score + f_score + m_score) / 3.0::DOUBLE AS rfm_score FROM t"""

_LOYALTY_SQL = """
SELECT o_custkey, min(o_orderdate) AS premier_achat, max(o_orderdate) AS dernier_achat,
       count(*) AS nombre_achats, sum(o_totalprice) AS montant_total,
       date_diff('day', CAST(min(o_orderdate) AS DATE), CAST(max(o_orderdate) AS DATE))::INTEGER AS duree_relation
FROM orders GROUP BY o_custkey"""

_EV_FEATURES_SQL = """
SELECT *, hour(ts)::DOUBLE AS hour, CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS is_purchase FROM events"""

_Z_SQL = f"""
WITH f AS ({_EV_FEATURES_SQL})
SELECT f.*,
  CASE WHEN (SELECT stddev_samp(value) FROM f) = 0 THEN 0.0
       ELSE (value - (SELECT avg(value) FROM f)) / (SELECT stddev_samp(value) FROM f) END AS z_value,
  CASE WHEN (SELECT stddev_samp(hour) FROM f) = 0 THEN 0.0
       ELSE (hour - (SELECT avg(hour) FROM f)) / (SELECT stddev_samp(hour) FROM f) END AS z_hour,
  CASE WHEN (SELECT stddev_samp(is_purchase) FROM f) = 0 THEN 0.0
       ELSE (is_purchase - (SELECT avg(is_purchase) FROM f)) / (SELECT stddev_samp(is_purchase) FROM f) END
    AS z_is_purchase
FROM f"""


def _dist(j: int, c) -> str:
    return " + ".join(f"(({x}) - ({float(v)!r})) * (({x}) - ({float(v)!r}))"
                      for x, v in zip(("z_value", "z_hour", "z_is_purchase"), c))


def _nearest_sql() -> str:
    k = len(FIXED_CENTRES)
    ds = ", ".join(f"{_dist(j, c)} AS d{j}" for j, c in enumerate(FIXED_CENTRES))
    arms = []
    for j in range(k - 1):
        conds = " AND ".join([f"d{j} < d{i}" for i in range(j)] + [f"d{j} <= d{i}" for i in range(j + 1, k)])
        arms.append(f"WHEN {conds} THEN {j}")
    case = f"CASE {' '.join(arms)} ELSE {k - 1} END"
    return f"""
WITH z AS ({_Z_SQL}), d AS (SELECT *, {ds} FROM z)
SELECT *, ({case})::INTEGER AS cluster FROM d"""


_ASSIGNED_SQL = _nearest_sql()

_CLUSTER_STATS_SQL = f"""
SELECT cluster, count(*) AS nombre_clients, avg(hour) AS age_moyen, avg(value) AS montant_moyen,
       stddev_samp(value) AS ecart_type_montant FROM ({_ASSIGNED_SQL}) a GROUP BY cluster"""

_SUMMARY_EVENTS_SQL = """
SELECT user_id AS customer_id, event_type AS category, sum(value) AS total_amount,
       count(*) AS purchase_count FROM events GROUP BY user_id, event_type"""

_THRESHOLDS_VALUES = ", ".join(f"({i}, '{m}', '{lab}', {float(t)!r}::DOUBLE)"
                               for i, (m, lab, t) in enumerate(EVENT_THRESHOLDS))

_ALERTS_SQL = f"""
WITH t(ordinal, metric, label, threshold) AS (VALUES {_THRESHOLDS_VALUES})
SELECT e.ts, e.user_id, e.event_type, e.value, t.threshold, t.ordinal::INTEGER AS ordinal,
       'High ' || t.label || ' usage: ' || CAST(e.value AS VARCHAR) || '%' AS message
FROM events e JOIN t ON e.event_type = t.metric WHERE e.value > t.threshold"""


def _describe_sql(src: str, cols) -> str:
    parts = [f"""SELECT '{c}' AS variable, count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std,
       min({c})::DOUBLE AS min, quantile_cont({c}, 0.25) AS p25, quantile_cont({c}, 0.5) AS p50,
       quantile_cont({c}, 0.75) AS p75, max({c})::DOUBLE AS max FROM src""" for c in cols]
    return f"WITH src AS ({src})\n" + "\nUNION ALL\n".join(parts)


def _histogram_sql(src: str, col: str, bins: int) -> str:
    b = float(bins)
    lo = (f"(SELECT CASE WHEN max({col}) > min({col}) THEN min({col}) ELSE min({col}) - 0.5 END FROM src)")
    hi = (f"(SELECT CASE WHEN max({col}) > min({col}) THEN max({col}) ELSE max({col}) + 0.5 END FROM src)")
    return f"""
WITH src AS ({src}),
c AS (SELECT LEAST(FLOOR(({col} - {lo}) * ({b!r}::DOUBLE / ({hi} - {lo}))), {bins - 1})::INTEGER AS bin,
             count(*) AS n
      FROM src WHERE {col} IS NOT NULL GROUP BY 1),
axis AS (SELECT range::INTEGER AS bin FROM range({bins}))
SELECT axis.bin, {lo} + axis.bin * (({hi} - {lo}) / {b!r}::DOUBLE) AS bin_start,
       CASE WHEN axis.bin = {bins - 1} THEN {hi} ELSE {lo} + (axis.bin + 1) * (({hi} - {lo}) / {b!r}::DOUBLE) END
         AS bin_end,
       coalesce(c.n, 0)::BIGINT AS count
FROM axis LEFT JOIN c ON axis.bin = c.bin"""


def _transitions_sql(table: str, client: str, ts: str, id_: str, cat: str) -> str:
    return f"""
SELECT categorie_precedente, {cat}, count(*) AS count FROM (
  SELECT lag({cat}) OVER (PARTITION BY {client} ORDER BY {ts}, {id_}) AS categorie_precedente, {cat}
  FROM {table}) x
WHERE categorie_precedente IS NOT NULL GROUP BY 1, 2"""


def _labels_sql() -> str:
    from clientlens.operators.clustering import SEGMENT_ADVICE, SEGMENT_NAMES

    def arms(vals):
        return " ".join("WHEN {} THEN '{}'".format(i + 1, v.replace("'", "''")) for i, v in enumerate(vals))
    return f"""
SELECT cluster, rang, CASE rang {arms(SEGMENT_NAMES)} ELSE 'Segment ' || CAST(rang AS VARCHAR) END AS segment,
       CASE rang {arms(SEGMENT_ADVICE)} ELSE NULL END AS recommandation
FROM (SELECT cluster, row_number() OVER (ORDER BY montant_moyen DESC NULLS LAST, cluster)::INTEGER AS rang
      FROM ({_CLUSTER_STATS_SQL}) s) r"""


_CLEAN_SQL = """
SELECT event_id, user_id, ts, event_type, value FROM (
  SELECT event_id, user_id, ts, nullif(event_type, 'error') AS event_type, value,
         row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) d
WHERE rn = 1 AND event_id IS NOT NULL AND user_id IS NOT NULL AND ts IS NOT NULL
  AND event_type IS NOT NULL AND value IS NOT NULL"""

# Poisson weights as in operators.bootstrap: the seeds of a row, then integer arithmetic
_BOOTSTRAP_SQL = f"""
WITH s AS (SELECT event_type, value, md5('0|' || event_id::VARCHAR) AS h FROM events WHERE value IS NOT NULL AND NOT isnan(value)),
a AS (SELECT event_type, value, ('0x' || substr(h, 1, 7))::BIGINT AS a, ('0x' || substr(h, 8, 7))::BIGINT AS b,
             unnest(range(201)) AS replicate FROM s),
x0 AS (SELECT *, (a + replicate * b) % {PRIME} AS x FROM a),
x1 AS (SELECT * REPLACE ((x * x + a + replicate * 48271) % {PRIME} AS x) FROM x0),
x2 AS (SELECT * REPLACE ((x * x + b + replicate * 69621) % {PRIME} AS x) FROM x1),
w AS (SELECT event_type, replicate, value,
             CASE WHEN replicate = 0 THEN 1 ELSE {" + ".join(f"(x >= {t})::BIGINT" for t in poisson_steps())} END AS w FROM x2)
SELECT event_type, replicate, sum(w)::BIGINT AS weight, sum(w * value) AS total FROM w WHERE w > 0 GROUP BY event_type, replicate"""

_RAW_SQL = {
    "rfm_scores": _RFM_SQL,
    "weekday_patterns": """
SELECT (dayofweek(ts) + 1)::INTEGER AS jour_semaine, count(*) AS nombre_achats, avg(value) AS montant_moyen,
       sum(value) AS montant_total FROM events GROUP BY 1""",
    "hourly_patterns": """
SELECT hour(ts)::INTEGER AS heure, count(*) AS nombre_achats, avg(value) AS montant_moyen FROM events GROUP BY 1""",
    "category_revenue": """
SELECT event_type, count(*) AS nombre_achats, sum(value) AS revenu_total, avg(value) AS montant_moyen
FROM events GROUP BY event_type""",
    "category_transitions": _transitions_sql("events", "user_id", "ts", "event_id", "event_type"),
    "priority_transitions": _transitions_sql("orders", "o_custkey", "o_orderdate", "o_orderkey",
                                             "o_orderpriority"),
    "client_loyalty": _LOYALTY_SQL,
    "retention_by_year": f"""
SELECT year(premier_achat)::INTEGER AS annee_acquisition, count(*) AS nouveaux_clients,
       avg(duree_relation) AS duree_moyenne_relation, avg(nombre_achats) AS nombre_moyen_achats
FROM ({_LOYALTY_SQL}) l GROUP BY 1""",
    "clean_customers": _CLEAN_SQL,
    "encode_flag": """
SELECT event_id, CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS is_purchase FROM events""",
    "distinct_categories": "SELECT count(DISTINCT event_type) AS n_event_type FROM events",
    "scaled_features": f"""
SELECT event_id, z_value, z_hour, z_is_purchase AS z_flag FROM ({_Z_SQL}) z""",
    "kmeans_assign": f"SELECT event_id, cluster FROM ({_ASSIGNED_SQL}) a",
    "segment_profile": f"""
SELECT cluster, sum(n)::BIGINT AS nombre_clients, sum(sh) / sum(n) AS age_moyen, sum(sv) / sum(cv) AS montant_moyen,
       string_agg(event_type || ':' || n::VARCHAR, ',' ORDER BY event_type) AS segments
FROM (SELECT cluster, event_type, count(*) AS n, sum(hour) AS sh, sum(value) AS sv, count(value) AS cv
      FROM ({_ASSIGNED_SQL}) a GROUP BY cluster, event_type) g GROUP BY cluster""",
    "segment_members": f"""
SELECT cluster, event_type AS segment, count(*) AS n FROM ({_ASSIGNED_SQL}) a GROUP BY cluster, event_type""",
    "cluster_stats": _CLUSTER_STATS_SQL,
    "cluster_amount_stats": f"""
SELECT cluster, count(*) AS nombre_clients, avg(value) AS montant_moyen,
       stddev_samp(value) AS ecart_type_montant FROM ({_ASSIGNED_SQL}) a GROUP BY cluster""",
    "processing_stats": f"""
SELECT count(*) AS nombre_clients, count(DISTINCT cluster) AS nombre_segments FROM ({_ASSIGNED_SQL}) a""",
    "segment_long": f"""
SELECT cluster, 'age_moyen' AS metric, age_moyen AS value FROM ({_CLUSTER_STATS_SQL}) s
UNION ALL
SELECT cluster, 'montant_moyen' AS metric, montant_moyen AS value FROM ({_CLUSTER_STATS_SQL}) s""",
    "segment_labels": _labels_sql(),
    "describe_amount": _describe_sql("SELECT value FROM events", ["value"]),
    "rfm_describe": _describe_sql(_RFM_SQL, list(RFM_DESCRIBED)),
    "amount_histogram": _histogram_sql("SELECT value FROM events", "value", 20),
    "rfm_histogram": _histogram_sql(_RFM_SQL, "rfm_score", 20),
    "category_mean_interval": """
SELECT event_type, count(value) AS n, avg(value) AS mean, stddev_samp(value) AS std,
       avg(value) - 1.96::DOUBLE * stddev_samp(value) / sqrt(count(value)) AS ci_low,
       avg(value) + 1.96::DOUBLE * stddev_samp(value) / sqrt(count(value)) AS ci_high
FROM events GROUP BY event_type""",
    "category_bootstrap_sums": _BOOTSTRAP_SQL,
    "category_bootstrap": f"""
SELECT event_type, max(weight) FILTER (replicate = 0) AS n, max(total / weight) FILTER (replicate = 0) AS mean,
       quantile_cont(total / weight, 0.025) FILTER (replicate > 0) AS ci_low,
       quantile_cont(total / weight, 0.975) FILTER (replicate > 0) AS ci_high
FROM ({_BOOTSTRAP_SQL}) b GROUP BY event_type""",
    "describe_by_category": """
SELECT event_type, count(value) AS count, avg(value) AS mean, stddev_samp(value) AS std, min(value) AS min,
       quantile_cont(value, 0.25) AS p25, quantile_cont(value, 0.5) AS p50, quantile_cont(value, 0.75) AS p75, max(value) AS max
FROM events GROUP BY event_type""",
    "customer_summary": _SUMMARY_EVENTS_SQL,
    "category_spending": f"""
SELECT category, round_even(avg(total_amount), 2) AS total_amount_mean,
       round_even(coalesce(sum(total_amount), 0.0), 2) AS total_amount_sum,
       count(total_amount) AS total_amount_count, round_even(avg(purchase_count), 2) AS purchase_count_mean
FROM ({_SUMMARY_EVENTS_SQL}) s WHERE category IS NOT NULL GROUP BY category""",
    "top_customers": """
SELECT customer_id, category, total_amount, purchase_count FROM (
  SELECT o_custkey AS customer_id, o_orderpriority AS category, sum(o_totalprice) AS total_amount,
         count(*) AS purchase_count FROM orders GROUP BY 1, 2) s
ORDER BY total_amount DESC NULLS LAST, customer_id NULLS LAST, category NULLS LAST LIMIT 10""",
    "global_stats": f"""
SELECT count(*) AS total_transactions, count(DISTINCT category) AS unique_categories,
       count(DISTINCT customer_id) AS unique_customers, avg(total_amount) AS average_spending,
       max(total_amount) AS max_spending, min(total_amount) AS min_spending
FROM ({_SUMMARY_EVENTS_SQL}) s""",
    "scatter_points": f"SELECT purchase_count, total_amount, category FROM ({_SUMMARY_EVENTS_SQL}) s",
    "metric_alerts": _ALERTS_SQL,
    "alert_messages": f"""
WITH t(ordinal, metric, label, threshold) AS (VALUES {_THRESHOLDS_VALUES}),
l AS (SELECT user_id, event_type, CAST(ts AS DATE) AS day, arg_max(value, (ts, event_id)) AS value
      FROM events GROUP BY 1, 2, 3)
SELECT user_id, day, count(*) AS n_alerts,
       string_agg('High ' || label || ' usage: ' || CAST(value AS VARCHAR) || '%', chr(10) ORDER BY ordinal) AS message
FROM l JOIN t ON l.event_type = t.metric WHERE value > threshold GROUP BY user_id, day""",
    "latest_metric": """
SELECT user_id, event_type, max(ts) AS ts, arg_max(value, (ts, event_id)) AS value
FROM events GROUP BY user_id, event_type""",
    "metric_history": """
SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
       event_type, count(value) AS n, avg(value) AS mean, min(value) AS min, max(value) AS max
FROM events GROUP BY 1, 2, 3""",
    "kmeans_fit": """
SELECT count(*) AS n, 3::BIGINT AS k, true AS sizes_add_up, true AS all_nearest, true AS centres_are_means FROM events""",
    "insights_rfm_describe": _describe_sql(_RFM_SQL, list(RFM_DESCRIBED)),
    "insights_weekday": """
SELECT (dayofweek(o_orderdate) + 1)::INTEGER AS jour_semaine, count(*) AS nombre_achats, avg(o_totalprice) AS montant_moyen,
       sum(o_totalprice) AS montant_total FROM orders GROUP BY 1""",
    "insights_transitions": _transitions_sql("orders", "o_custkey", "o_orderdate", "o_orderkey", "o_orderpriority"),
    "segment_report_stats": f"SELECT count(*) AS nombre_clients, 3::BIGINT AS nombre_segments FROM ({_CLEAN_SQL}) c",
    "segment_report_totals": f"""
SELECT count(*) AS nombre_clients, avg(value) AS montant_moyen, avg(hour(ts)::DOUBLE) AS age_moyen FROM ({_CLEAN_SQL}) c""",
}

_RAW_SQL |= harness_jobs.raw_sql(_RAW_SQL)


# Double output columns per query, rounded to 4 decimals as ``round_doubles``
# does: fixed to decimal(38,10) first, then rounded half up.
_DOUBLES = {
    "rfm_scores": ["montant_total", "rfm_score"],
    "weekday_patterns": ["montant_moyen", "montant_total"],
    "hourly_patterns": ["montant_moyen"],
    "category_revenue": ["revenu_total", "montant_moyen"],
    "client_loyalty": ["montant_total"],
    "retention_by_year": ["duree_moyenne_relation", "nombre_moyen_achats"],
    "clean_customers": ["value"],
    "scaled_features": ["z_value", "z_hour", "z_flag"],
    "segment_profile": ["age_moyen", "montant_moyen"],
    "cluster_stats": ["age_moyen", "montant_moyen", "ecart_type_montant"],
    "cluster_amount_stats": ["montant_moyen", "ecart_type_montant"],
    "segment_long": ["value"],
    "describe_amount": ["mean", "std", "min", "p25", "p50", "p75", "max"],
    "rfm_describe": ["mean", "std", "min", "p25", "p50", "p75", "max"],
    "amount_histogram": ["bin_start", "bin_end"],
    "rfm_histogram": ["bin_start", "bin_end"],
    "category_mean_interval": ["mean", "std", "ci_low", "ci_high"],
    "category_bootstrap": ["mean", "ci_low", "ci_high"],
    "category_bootstrap_sums": ["total"],
    "describe_by_category": ["mean", "std", "min", "p25", "p50", "p75", "max"],
    "customer_summary": ["total_amount"],
    "category_spending": ["total_amount_mean", "total_amount_sum", "purchase_count_mean"],
    "top_customers": ["total_amount"],
    "global_stats": ["average_spending", "max_spending", "min_spending"],
    "scatter_points": ["total_amount"],
    "metric_alerts": ["value", "threshold"],
    "latest_metric": ["value"],
    "metric_history": ["mean", "min", "max"],
    "insights_rfm_describe": ["mean", "std", "min", "p25", "p50", "p75", "max"],
    "insights_weekday": ["montant_moyen", "montant_total"],
    "segment_report_totals": ["montant_moyen", "age_moyen"],
}
_DOUBLES |= harness_jobs.DOUBLES


def _round_sql(name: str, sql: str) -> str:
    cols = _DOUBLES.get(name)
    if not cols:
        return sql.strip()
    rep = ", ".join(f"round(CAST({c} AS DECIMAL(38,10)), 4)::DOUBLE AS {c}" for c in cols)
    return f"SELECT * REPLACE ({rep}) FROM ({sql.strip()}\n) q"


ORACLE_SQL = {k: _round_sql(k, v) for k, v in _RAW_SQL.items()}
