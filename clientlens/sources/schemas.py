"""Declared schemas of the four entities.

Declaring them saves the inference pass over the input and pins types across
Spark versions (a ``yyyy-MM-dd`` CSV column infers as date in 4.x).
"""

from pyspark.sql.types import (DoubleType, IntegerType, LongType, StringType, StructField,
                               StructType, TimestampType, DateType)

# One row per customer purchase, as in the sample CSV.
CUSTOMER_PURCHASE = StructType([
    StructField("client_id", StringType()),
    StructField("age", IntegerType()),
    StructField("genre", StringType()),
    StructField("ville", StringType()),
    StructField("produit_achete", StringType()),
    StructField("montant_achat", DoubleType()),
    StructField("date_achat", DateType()),
    StructField("segment_client", StringType()),
])

PURCHASE = StructType([
    StructField("purchase_id", LongType()),
    StructField("client_id", StringType()),
    StructField("date_achat", TimestampType()),
    StructField("montant_achat", DoubleType()),
    StructField("categorie_produit", StringType()),
])

CUSTOMER_SUMMARY = StructType([
    StructField("customer_id", StringType()),
    StructField("category", StringType()),
    StructField("total_amount", DoubleType()),
    StructField("purchase_count", LongType()),
])

METRIC_SAMPLE = StructType([
    StructField("ts", TimestampType()),
    StructField("node", StringType()),
    StructField("metric", StringType()),
    StructField("value", DoubleType()),
])
