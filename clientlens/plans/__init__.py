"""Composite analyses: the insights report, the segmentation pipeline and the incremental client store."""

from clientlens.plans.incremental import ClientStore
from clientlens.plans.insights import client_tables, insights_report, profile_tables, rfm_from_loyalty
from clientlens.plans.segmentation import (analyze_segments, customer_features, segment_customers,
                                           segment_report)
from clientlens.plans.spending import spending_report, spending_tables

__all__ = ["ClientStore", "analyze_segments", "client_tables", "insights_report", "profile_tables", "rfm_from_loyalty", "customer_features", "segment_customers",
           "segment_report", "spending_report", "spending_tables"]
