"""Samples, splits and models checked by properties and closed forms."""

import math

import pytest
from pyspark.sql import functions as F

from tablewright.operators import ml as ML
from tablewright.operators import sampling as SM
from tablewright.sources import standins as SI

from conftest import SF001


@pytest.fixture(scope="module")
def orders(spark):
    return spark.read.parquet(f"{SF001}/orders.parquet").select("o_orderkey", "o_totalprice")


def test_hash_sample_exact_size_and_repeatable(orders):
    n = orders.count()
    a = SM.hash_sample(orders, "o_orderkey", 0.1, 1000)
    b = SM.hash_sample(orders.repartition(7), "o_orderkey", 0.1, 1000)
    ka = {r["o_orderkey"] for r in a.collect()}
    assert len(ka) == int(0.1 * n)
    assert ka == {r["o_orderkey"] for r in b.collect()}


def test_split_exact_sizes_disjoint_cover(orders):
    n = orders.count()
    parts = {r["part"]: r["c"] for r in SM.split_exact(orders, "o_orderkey", 100)
             .groupBy("part").agg(F.count(F.lit(1)).alias("c")).collect()}
    assert parts["train"] == int(0.6 * n)
    assert parts["train"] + parts["validation"] == int(0.8 * n)
    assert sum(parts.values()) == n


def test_split_bucket_cover_and_stable(orders):
    s = SM.split_bucket(orders, ["o_orderkey"], 7000)
    assert s.count() == orders.count()
    again = SM.split_bucket(orders.repartition(5), ["o_orderkey"], 7000)
    assert s.exceptAll(again).count() == 0


def test_split_random_cover(orders):
    s = SM.split_random(orders, ["o_orderkey"], (0.6, 0.2, 0.2), 100)
    assert s.count() == orders.count()
    assert s.select("o_orderkey").distinct().count() == orders.count()


def test_kmeans_elbow_properties(spark):
    t = ML.standardize(SI.trips(spark, SF001), SI.TRIP_FEATURES, keep=[])
    rows = ML.kmeans_elbow(t, SI.TRIP_FEATURES, [1, 2, 3, 4], seed=1).orderBy("k").collect()
    tss = rows[0]["wss"]
    # standardised with the sample sd: TSS = d * (n - 1)
    n = t.count()
    assert tss == pytest.approx(len(SI.TRIP_FEATURES) * (n - 1), rel=1e-9)
    assert rows[0]["r2_pct"] == pytest.approx(0.0)
    for r in rows[1:]:
        assert 0 <= r["wss"] <= tss * (1 + 1e-9)
        assert r["r2_pct"] == pytest.approx(100 * (tss - r["wss"]) / tss)


def test_pca_ratios_sum_to_one(spark):
    t = SI.trips(spark, SF001)
    rows = ML.pca_explained(t, SI.TRIP_FEATURES).orderBy("component").collect()
    assert sum(r["ratio"] for r in rows) == pytest.approx(1.0, abs=1e-5)
    assert rows[-1]["cumulative"] == pytest.approx(1.0, abs=1e-5)
    assert all(rows[i]["ratio"] >= rows[i + 1]["ratio"] for i in range(len(rows) - 1))
    n = t.count()
    for r in rows:
        assert r["singular_value"] == pytest.approx(math.sqrt(r["eigenvalue"] * (n - 1)), rel=1e-4)


def test_logit_one_binary_feature_closed_form(spark):
    rows = [(0.0, 1)] * 30 + [(0.0, 0)] * 70 + [(1.0, 1)] * 60 + [(1.0, 0)] * 40
    df = spark.createDataFrame(rows, "x double, y int")
    t = {r["term"]: r["estimate"] for r in ML.glm_table(df, ["x"], "y", "binomial", "logit").collect()}
    b0 = math.log(0.3 / 0.7)
    assert t["(intercept)"] == pytest.approx(b0, abs=1e-7)
    assert t["x"] == pytest.approx(math.log(0.6 / 0.4) - b0, abs=1e-7)


def test_regularization_sweep_rows(spark):
    t = SM.split_bucket(SI.trips(spark, SF001), ["l_orderkey", "l_linenumber"], 7000)
    res = ML.regularization_sweep(t.filter(F.col("part") == "train"),
                                  t.filter(F.col("part") == "validation"),
                                  SI.TRIP_FEATURES, "fare", [0.0, 1.0]).collect()
    assert len(res) == 2 and all(r["rmse"] > 0 for r in res)
