"""Customer segmentation pipeline: clean, encode, scale, cluster, profile."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from clientlens.operators.clean import clean_customers
from clientlens.operators.clustering import (cluster_stats, kmeans_fit, label_segments, processing_stats,
                                             segment_profile, stable_numbering)
from clientlens.operators.features import assemble_scale, encode_flag
from clientlens.operators.summary import melt
from clientlens.session import checkpoint_dir
from clientlens.sources.writers import write_tables


#: Chart tables and the column their rows are written in the order of.
CHARTS = {"segment_analysis": "cluster", "cluster_stats": "cluster", "segment_long": "cluster", "segment_labels": "rang"}


def customer_features(df: DataFrame, flag_col: str = "genre", flag_value="M",
                      flag_out: str = "genre_numeric",
                      inputs: Sequence[str] = ("age", "montant_achat", "genre_numeric")):
    """Flag encoding + assembled + standardised feature vector. Returns (df, model)."""
    return assemble_scale(encode_flag(df, flag_col, flag_value, flag_out), inputs)


def segment_customers(raw: DataFrame, key: str, order: Sequence[Column | str], k: int = 3,
                      seed: int = 42, flag_col: str = "genre", flag_value="M", flag_out: str = "genre_numeric",
                      inputs: Sequence[str] = ("age", "montant_achat", "genre_numeric"),
                      age: str = "age", amount: str = "montant_achat",
                      label: str = "segment_client", subset: Sequence[str] | None = None) -> dict:
    """The batch segmentation job.

    The cleaned table is checkpointed to the cluster's checkpoint folder before
    the scaler and k-means: both then re-read a written table, the dedupe runs
    once, and a lost executor never repeats it. Clusters are renumbered by
    descending mean amount (the k means are collected once) so the numbering is
    stable across runs and partitionings.
    """
    spark = raw.sparkSession
    checkpoint_dir(spark)
    clean = clean_customers(raw, key, order, subset).checkpoint(eager=True)
    feats, scaler = customer_features(clean, flag_col, flag_value, flag_out, inputs)
    model = kmeans_fit(feats, "scaled_features", k=k, seed=seed)
    assigned = stable_numbering(model.transform(feats), "cluster", amount)
    return {"model": model, "scaler": scaler, "processed_data": assigned,
            **analyze_segments(assigned, "cluster", age, amount, label)}


def analyze_segments(processed: DataFrame, cluster: str = "cluster", age: str = "age",
                     amount: str = "montant_achat", label: str | None = "segment_client") -> dict:
    """Segment tables of an already clustered table: profile (with member
    labels), statistics, their long form and the segment names."""
    stats = cluster_stats(processed, cluster, amount, age)
    out = {
        "cluster_stats": stats,
        "segment_long": melt(stats, [cluster], ["age_moyen", "montant_moyen"]),
        "segment_labels": label_segments(stats, cluster),
    }
    if label:
        out["segment_analysis"] = segment_profile(processed, cluster, age, amount, label)
    return out


def segment_report(result: dict, out: str, fmt: str = "parquet", age: str = "age", amount: str = "montant_achat",
                   label: str | None = "segment_client") -> dict[str, str]:
    """Write the tables of ``segment_customers`` / ``analyze_segments`` to
    ``<out>/<table>``. A clustered table is written first and the others are made
    from it as written; ``processing_stats`` holds the job's closing numbers."""
    names = ("segment_analysis", "cluster_stats", "segment_long", "segment_labels")
    if "processed_data" not in result:
        return write_tables({n: result[n] for n in names if n in result}, out, fmt, order_by=CHARTS)
    paths = write_tables({"processed_data": result["processed_data"]}, out, fmt)
    done = result["processed_data"].sparkSession.read.format(fmt).load(paths["processed_data"])
    tables = analyze_segments(done, "cluster", age, amount, label) | {"processing_stats": processing_stats(done, "cluster")}
    return paths | write_tables(tables, out, fmt, order_by=CHARTS)
