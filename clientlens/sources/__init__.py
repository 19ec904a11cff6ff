"""Readers and writers (declared schemas, no inference at scale)."""

from clientlens.sources.schemas import (CUSTOMER_PURCHASE, PURCHASE, CUSTOMER_SUMMARY, METRIC_SAMPLE)
from clientlens.sources.readers import read_csv, read_json_lines, read_parquet
from clientlens.sources.bucketed import read_bucketed, write_bucketed
from clientlens.sources.quarantine import TooManyBadLines, load_csv
from clientlens.sources.writers import write_one_row_json, write_tables

__all__ = ["CUSTOMER_PURCHASE", "PURCHASE", "CUSTOMER_SUMMARY", "METRIC_SAMPLE",
           "read_csv", "read_json_lines", "read_parquet",
           "load_csv", "TooManyBadLines", "read_bucketed", "write_bucketed",
           "write_tables", "write_one_row_json"]
