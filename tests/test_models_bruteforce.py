"""Rows-only model queries checked against numpy on the small sf0.001
tables (brute force on a fixture, where SQL cannot state the result)."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.operators import ml as ML
from tablewright.operators import sampling as SM
from tablewright.sources import standins as SI

from conftest import SF001

FEATS = SI.TRIP_FEATURES


@pytest.fixture(scope="module")
def trips_pdf(spark):
    return SI.trips(spark, SF001).toPandas()


def test_linreg_summary_matches_normal_equations(spark, trips_pdf):
    got = {r["term"]: r for r in ML.linreg_coefficients(SI.trips(spark, SF001), FEATS, "fare").collect()}
    X = np.column_stack([trips_pdf[c].to_numpy() for c in FEATS] + [np.ones(len(trips_pdf))])
    y = trips_pdf["fare"].to_numpy()
    beta, *_ = np.linalg.lstsq(X, y, rcond=None)
    resid = y - X @ beta
    sigma2 = resid @ resid / (len(y) - X.shape[1])
    se = np.sqrt(np.diag(sigma2 * np.linalg.inv(X.T @ X)))
    for i, t in enumerate(FEATS + ["(intercept)"]):
        assert got[t]["estimate"] == pytest.approx(beta[i], rel=1e-6, abs=1e-6)
        assert got[t]["std_error"] == pytest.approx(se[i], rel=1e-6)
        assert got[t]["t_value"] == pytest.approx(beta[i] / se[i], rel=1e-5, abs=1e-6)


def test_pca_all_features_matches_eigenvalues(spark, trips_pdf):
    got = ML.pca_explained(SI.trips(spark, SF001), FEATS).orderBy("component").collect()
    Z = np.column_stack([trips_pdf[c].to_numpy() for c in FEATS])
    eig = np.sort(np.linalg.eigvalsh(np.corrcoef(Z, rowvar=False)))[::-1]
    n = len(trips_pdf)
    for r, e in zip(got, eig):
        assert r["ratio"] == pytest.approx(e / eig.sum(), abs=2e-6)
        assert r["eigenvalue"] == pytest.approx(e, abs=2e-6)
        assert r["singular_value"] == pytest.approx(math.sqrt(e * (n - 1)), rel=1e-5)


def test_regularization_sweep_zero_is_least_squares(spark):
    t = SM.split_bucket(SI.trips(spark, SF001), ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], 7000)
    tr = t.filter(F.col("part") == "train").toPandas()
    va = t.filter(F.col("part") == "validation").toPandas()
    got = ML.regularization_sweep(t.filter(F.col("part") == "train"),
                                  t.filter(F.col("part") == "validation"),
                                  FEATS, "fare", [0.0]).collect()[0]
    Xt = np.column_stack([tr[c] for c in FEATS] + [np.ones(len(tr))])
    beta, *_ = np.linalg.lstsq(Xt, tr["fare"].to_numpy(), rcond=None)
    Xv = np.column_stack([va[c] for c in FEATS] + [np.ones(len(va))])
    err = va["fare"].to_numpy() - Xv @ beta
    assert got["rmse"] == pytest.approx(math.sqrt(np.mean(err ** 2)), abs=1e-3)


def test_kmeans_centres_are_cluster_means(spark):
    d = ML.standardize(SI.trips(spark, SF001), FEATS, keep=[])
    model, labelled = ML.kmeans_fit(d, FEATS, 3, seed=1)
    pdf = labelled.toPandas()
    for i, c in enumerate(model.clusterCenters()):
        members = pdf[pdf.cluster == i]
        assert len(members) > 0
        # Lloyd's steps stop at maxIter=20 / tol=1e-4, so the final centres
        # sit within a small step of their members' means
        np.testing.assert_allclose(members[FEATS].mean().to_numpy(), c, atol=0.01)
