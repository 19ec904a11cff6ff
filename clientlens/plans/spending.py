"""Spending report over per-customer summaries (customer_id, category,
total_amount, purchase_count): category spending, top customers, scatter
points and the global statistics as one JSON row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clientlens.operators.summary import (category_spending, global_stats, mean_interval, scatter_points,
                                          top_customers)
from clientlens.sources.readers import read_json_lines
from clientlens.sources.schemas import CUSTOMER_SUMMARY
from clientlens.sources.writers import write_one_row_json, write_tables


def spending_tables(summary: DataFrame, top_n: int = 10, fraction: float = 1.0) -> dict[str, DataFrame]:
    return {
        "category_spending": category_spending(summary),
        "category_interval": mean_interval(summary.where("category IS NOT NULL"), "category", "total_amount"),
        "top_customers": top_customers(summary, top_n),
        "scatter_points": scatter_points(summary, fraction),
    }


def spending_report(spark: SparkSession, summary_path: str, out: str, top_n: int = 10,
                    fraction: float = 1.0) -> dict[str, str]:
    """Read JSON-lines summaries (declared schema), write the tables to
    ``<out>/<table>`` and the statistics (with generation time) to
    ``<out>/analysis_stats`` as one JSON row."""
    summary = read_json_lines(spark, summary_path, CUSTOMER_SUMMARY)
    paths = write_tables(spending_tables(summary, top_n, fraction), out, order_by={"category_spending": "category", "category_interval": "category"})
    paths["analysis_stats"] = write_one_row_json(global_stats(summary, with_time=True),
                                                 f"{out.rstrip('/')}/analysis_stats")
    return paths
