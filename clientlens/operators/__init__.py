"""DataFrame -> DataFrame analyses."""

from clientlens.operators.bootstrap import bootstrap_interval, bootstrap_sums
from clientlens.operators.clean import (dedupe, drop_nulls, clean_customers, distinct_count, distinct_from_sketches, distinct_per_period,
                                        distinct_sketches, latest_first)
from clientlens.operators.rfm import rfm, client_rfm_base, score_rfm
from clientlens.operators.patterns import weekday_patterns, from_profile, hourly_patterns, purchase_profile
from clientlens.operators.categories import category_revenue, category_transitions
from clientlens.operators.loyalty import client_loyalty, retention_by_year
from clientlens.operators.summary import (describe, histogram, mean_interval, melt,
                                          customer_summary, category_spending, top_customers,
                                          scatter_points, global_stats)
from clientlens.operators.quantiles import describe_by
from clientlens.operators.features import encode_flag, assemble_scale, standardize, vector_columns
from clientlens.operators.clustering import (kmeans_fit, centres_frame, fit_checks, kmeans_assign, stable_numbering,
                                             segment_profile, segment_members, cluster_stats,
                                             label_segments, processing_stats)
from clientlens.operators.metrics import (thresholds_frame, metric_alerts, alert_messages,
                                          latest_metric, metric_history)
