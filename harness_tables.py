"""The driver's test tables: schemas, column roles and the parameters of the
analyses on them. Harness data of the entry, scripts and tests; the library
does not import it.

orders span 1995-01-01..2001-08-01 with order totals of 1e3..5e5, so the
reference day is the day after the last order and the amount thresholds are
the default ones times 2,500; with these every score 1..5 occurs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import (DoubleType, LongType, StringType, StructField, StructType,
                               TimestampNTZType)

from clientlens.roles import Roles

EVENTS = Roles(client="user_id", ts="ts", amount="value", category="event_type", id="event_id")
ORDERS = Roles(client="o_custkey", ts="o_orderdate", amount="o_totalprice",
               category="o_orderpriority", id="o_orderkey")

AS_OF_ORDERS = "2001-08-02"
ORDERS_MONETARY = (2_500_000.0, 1_875_000.0, 1_250_000.0, 625_000.0)

# Alert thresholds per event type (event value read as a percentage reading);
# purchases carry no threshold, so they never alert.
EVENT_THRESHOLDS = (
    ("view", "View", 150.0),
    ("click", "Click", 150.0),
    ("signup", "Signup", 150.0),
    ("error", "Error", 100.0),
)

# Three fixed centres in the standardised (value, hour, is_purchase) space.
FIXED_CENTRES = (
    (-0.5, -1.0, -0.5),
    (1.5, 0.0, -0.5),
    (0.0, 0.5, 2.0),
)

# Declared: opening a table then needs no footer read for schema inference.
TEST_TABLE_SCHEMAS = {
    "events": StructType([
        StructField("event_id", LongType()),
        StructField("ts", TimestampNTZType()),
        StructField("user_id", LongType()),
        StructField("event_type", StringType()),
        StructField("value", DoubleType()),
        StructField("props", StringType()),
    ]),
    "orders": StructType([
        StructField("o_orderkey", LongType()),
        StructField("o_custkey", LongType()),
        StructField("o_orderstatus", StringType()),
        StructField("o_totalprice", DoubleType()),
        StructField("o_orderdate", TimestampNTZType()),
        StructField("o_orderpriority", StringType()),
    ]),
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """``<sf_dir>/<name>.parquet``, with its declared schema when known."""
    r = spark.read
    if name in TEST_TABLE_SCHEMAS:
        r = r.schema(TEST_TABLE_SCHEMAS[name])
    return r.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
