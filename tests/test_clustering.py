"""Features and clustering: scaler values, k-means invariants, fixed-centre
assignment, labels, and the segmentation pipeline end to end."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from clientlens.operators import (assemble_scale, centres_frame, cluster_stats, kmeans_assign, kmeans_fit,
                                  label_segments, segment_profile, stable_numbering, standardize)
from clientlens.operators.clustering import SEGMENT_NAMES
from clientlens.plans import segment_customers, segment_report
from clientlens.sources import CUSTOMER_PURCHASE

from test_sample_fixture import SAMPLE_CSV


def test_scaler_values(spark):
    df = spark.createDataFrame([(1.0, 3.0), (2.0, 3.0), (4.0, 3.0)], "a double, b double")
    scaled, _ = assemble_scale(df, ["a", "b"])
    got = [r[0] for r in scaled.select(vector_to_array("scaled_features")).collect()]
    assert [round(g[0], 4) for g in got] == [-0.8729, -0.2182, 1.0911]
    assert {g[1] for g in got} == {0.0}
    z = standardize(df, ["a", "b"]).orderBy("a").collect()
    assert [round(r["z_a"], 4) for r in z] == [-0.8729, -0.2182, 1.0911] and {r["z_b"] for r in z} == {0.0}


def test_assemble_rejects_nulls(spark):
    df = spark.createDataFrame([(1.0,), (None,)], "a double")
    with pytest.raises(Exception):
        assemble_scale(df, ["a"])[0].collect()


def test_kmeans_invariants(spark):
    rng = np.random.default_rng(0)
    pts = np.vstack([rng.normal(c, 0.3, (100, 2)) for c in ((0, 0), (5, 5), (0, 5))])
    df = spark.createDataFrame([(float(x), float(y)) for x, y in pts], "x double, y double")
    scaled, _ = assemble_scale(df, ["x", "y"])
    model = kmeans_fit(scaled, "scaled_features", k=3, seed=42)
    cent = centres_frame(model, ["cx", "cy"]).collect()
    assert len(cent) == 3 and sum(r["size"] for r in cent) == 300
    pred = model.transform(scaled).select(vector_to_array("scaled_features").alias("v"), "cluster").collect()
    centres = np.array(model.clusterCenters())
    for r in pred:   # each point sits at its nearest centre
        d = ((centres - np.array(r["v"])) ** 2).sum(axis=1)
        assert d[r["cluster"]] == pytest.approx(d.min())
    for j, c in enumerate(centres):  # each centre is the mean of its members
        mem = np.array([r["v"] for r in pred if r["cluster"] == j])
        assert np.allclose(mem.mean(axis=0), c, atol=1e-6)


def test_fixed_centre_assignment_ties_lowest_id(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 0.0), (3.0, 0.0)], "x double, y double")
    out = kmeans_assign(df, ["x", "y"], [(0.0, 0.0), (2.0, 0.0), (3.0, 0.0)]).orderBy("x").collect()
    assert [r["cluster"] for r in out] == [0, 0, 2]   # x=1 is equidistant from 0 and 1: lowest id


def test_stable_numbering_and_labels(spark):
    df = spark.createDataFrame([(0, 10.0, 30), (1, 500.0, 40), (2, 100.0, 50), (1, 700.0, 20)],
                               "cluster int, amount double, age int")
    renum = stable_numbering(df, "cluster", "amount")
    assert {(r["amount"], r["cluster"]) for r in renum.collect()} == {(10.0, 2), (500.0, 0), (700.0, 0), (100.0, 1)}
    stats = cluster_stats(renum, "cluster", "amount", age="age")
    lab = {r["cluster"]: r for r in label_segments(stats).collect()}
    assert lab[0]["segment"] == SEGMENT_NAMES[0] and lab[2]["rang"] == 3
    prof = {r["cluster"]: r for r in segment_profile(renum.withColumn("lbl", F.lit("x")), "cluster", "age",
                                                     "amount", "lbl").collect()}
    assert prof[0]["nombre_clients"] == 2 and [tuple(s) for s in prof[0]["segments"]] == [("x", 2)]


def test_segmentation_pipeline(spark, tmp_dir):
    p = f"{tmp_dir}/sample.csv"
    with open(p, "w") as f:
        f.write(SAMPLE_CSV)
    raw = spark.read.schema(CUSTOMER_PURCHASE).option("header", True).csv(p)
    res = segment_customers(raw, "client_id", ["date_achat"], k=3, seed=42)
    paths = segment_report(res, f"{tmp_dir}/out")
    processed = spark.read.parquet(paths["processed_data"])
    assert processed.count() == 10 and processed.select("cluster").distinct().count() == 3
    seg = spark.read.parquet(paths["segment_analysis"]).collect()
    assert sum(r["nombre_clients"] for r in seg) == 10
    assert sum(s["n"] for r in seg for s in r["segments"]) == 10
    stats = spark.read.parquet(paths["cluster_stats"]).orderBy("cluster").collect()
    means = [r["montant_moyen"] for r in stats]
    assert means == sorted(means, reverse=True)   # cluster 0 = highest mean amount
    assert spark.read.parquet(paths["segment_long"]).count() == 6
    assert spark.read.parquet(paths["segment_labels"]).count() == 3


def test_one_row_scales_to_zero_like_the_scaler(spark):
    from clientlens.operators import standardize
    df = spark.createDataFrame([(3.0, None)], "a double, b double")
    r = standardize(df, ["a", "b"]).first()
    assert r["z_a"] == 0.0 and r["z_b"] is None
    ml, _ = assemble_scale(df, ["a"])
    assert list(ml.first()["scaled_features"]) == [0.0]


def test_centres_of_a_model_without_summary_and_of_huge_clusters(spark, tmp_dir):
    from pyspark.ml.clustering import KMeansModel

    from clientlens.operators import centres_frame
    df, _ = assemble_scale(spark.createDataFrame([(float(i % 2), float(i)) for i in range(20)], "a double, b double"), ["a", "b"])
    model = kmeans_fit(df, k=2)
    model.save(f"{tmp_dir}/m")
    got = centres_frame(KMeansModel.load(f"{tmp_dir}/m"), ["x", "y"])
    assert got.count() == 2 and got.where("size IS NULL").count() == 2 and dict(got.dtypes)["size"] == "bigint"

    class Huge:
        hasSummary = True
        summary = type("S", (), {"clusterSizes": [3_000_000_000]})
        clusterCenters = staticmethod(lambda: [[0.5]])
    assert centres_frame(Huge(), ["x"]).first()["size"] == 3_000_000_000


def test_fit_checks_see_a_wrong_fit(spark):
    from clientlens.operators import fit_checks
    df, _ = assemble_scale(spark.createDataFrame([(float(i % 5), float(i)) for i in range(60)], "a double, b double"), ["a", "b"])
    model = kmeans_fit(df, k=3)
    assert tuple(fit_checks(df, model).first()) == (60, 3, True, True, True)
    moved, _ = assemble_scale(spark.createDataFrame([(float(i % 5), float(i) + 9.0) for i in range(30)], "a double, b double"), ["a", "b"])
    r = fit_checks(moved.limit(20), model).first()
    assert not r["sizes_add_up"] and not r["centres_are_means"]


def test_segment_profile_in_one_scan(spark):
    from clientlens.operators import segment_profile
    df = spark.createDataFrame([(0, 20.0, 1.0, "a"), (0, None, 3.0, "b"), (0, 40.0, None, "a"), (1, 5.0, 5.0, None)],
                               "cluster int, age double, amount double, label string")
    out = segment_profile(df, "cluster", "age", "amount", "label")
    got = {r["cluster"]: (r[1], r[2], r[3], [tuple(x) for x in r["segments"]]) for r in out.collect()}
    assert got == {0: (3, 30.0, 2.0, [("a", 2), ("b", 1)]), 1: (1, 5.0, 5.0, [(None, 1)])}


def test_segmentation_keeps_the_latest_complete_row(spark):
    from clientlens.operators import clean_customers, latest_first
    rows = [("C1", None, 9.0), ("C1", "2024-01-02", 1.0), ("C2", "2024-01-05", 2.0), ("C2", "2024-01-05", 1.5), ("C3", None, 4.0)]
    df = spark.createDataFrame(rows, "client_id string, d string, v double").withColumn("d", F.to_date("d"))
    for part in (df, df.orderBy(F.desc("v")).repartition(3)):
        got = {r["client_id"]: r["v"] for r in clean_customers(part, "client_id", latest_first(part, "d")).collect()}
        assert got == {"C1": 1.0, "C2": 1.5}
