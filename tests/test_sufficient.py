"""Moments, fits from them, and chunked states against numpy and the
estimators of ``pyspark.ml``."""

import math

import numpy as np
import pytest
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from tablewright.operators import chunked as CH
from tablewright.operators import ml as ML
from tablewright.operators import sufficient as SS
from tablewright.session import scratch_path

COLUMNS = ["y", "a", "b", "c"]


@pytest.fixture(scope="module")
def data():
    r = np.random.default_rng(2)
    x = r.normal(size=(400, 3)) * [1, 50, 0.01] + [1e6, -3, 0.5]
    y = 3 + x @ [2.0, -0.1, 40.0] + r.normal(size=400)
    return np.column_stack([y, x])


@pytest.fixture(scope="module")
def frame(spark, data):
    rows = [(*map(float, v), i % 7 if i % 7 else None, i) for i, v in enumerate(data)]
    rows += [(1.0, None, 2.0, 3.0, 1, -1), (None, 1.0, 2.0, 3.0, None, -2)]
    return spark.createDataFrame(rows, "y double, a double, b double, c double, g int, i long").repartition(5)


def read(df):
    return SS.read_moments(df, COLUMNS)[None]


def test_moments_and_merge(spark, frame, data):
    m = read(SS.moments(frame, COLUMNS))
    assert m.n == 400
    np.testing.assert_allclose(m.mean, data.mean(0))
    np.testing.assert_allclose(m.cross, np.cov(data, rowvar=False) * 399, rtol=1e-8, atol=1e-6)
    parts = SS.moments(frame, COLUMNS, ["g"])
    assert parts.count() == 7                            # the null group too
    merged = read(SS.merge_moments(parts, 4))
    np.testing.assert_allclose(merged.cross, m.cross, rtol=1e-8, atol=1e-6)
    two = parts.withColumn("h", F.col("g") > 3)           # null, false, true
    got = {r.h: r.n for r in SS.merge_moments(two, 4, ["h"]).collect()}
    assert sum(got.values()) == 400 and set(got) == {None, False, True}
    assert read(SS.moments(frame.limit(0), COLUMNS)).n == 0
    assert SS.merge_moments(parts.limit(0), 4).count() == 0


def test_least_squares(data, frame):
    fit = SS.least_squares(read(SS.moments(frame, COLUMNS)), COLUMNS[1:], "y")
    x = np.column_stack([data[:, 1:] - data[:, 1:].mean(0), np.ones(400)])
    b, *_ = np.linalg.lstsq(x, data[:, 0], rcond=None)
    np.testing.assert_allclose(fit.coefficients, b[:3], rtol=1e-6)
    res = data[:, 0] - x @ b
    se = np.sqrt(np.diag(np.linalg.inv(x.T @ x)) * (res @ res) / 396)
    np.testing.assert_allclose(fit.std_errors[:3], se[:3], rtol=1e-6)
    assert fit.table()[-1][0] == "(intercept)"


def test_constant_and_dependent_features(spark):
    rows = [(2.0 * i + (i % 2), float(i), 3.0 * i, 5.0) for i in range(20)]
    m = read(SS.moments(spark.createDataFrame(rows, "y double, a double, b double, c double"), COLUMNS))
    fit = SS.least_squares(m, COLUMNS[1:], "y")
    assert fit.coefficients[2] == 0 and fit.std_errors[2] is None
    want = np.polyfit([r[1] for r in rows], [r[0] for r in rows], 1)
    assert fit.coefficients[0] + 3 * fit.coefficients[1] == pytest.approx(want[0])
    none = SS.least_squares(SS.Moments.of(COLUMNS, 0, None, None), COLUMNS[1:], "y")
    assert none.coefficients.tolist() == [0, 0, 0] and none.std_errors == [None] * 4


@pytest.mark.parametrize("reg,elastic", [(0.0, 0.0), (0.5, 0.0), (20.0, 0.0), (0.5, 1.0), (0.3, 0.4), (500.0, 1.0)])
def test_penalised_equals_the_estimator(frame, reg, elastic):
    frame = frame.withColumn("a", F.col("a") - 1e6)      # the estimator's plain sums lose digits so far from 0
    b, b0 = SS.penalised(read(SS.moments(frame, COLUMNS)), COLUMNS[1:], "y", reg, elastic)
    feats = ML.assemble(frame.select(*COLUMNS).na.drop(), COLUMNS[1:])
    m = LinearRegression(featuresCol="features", labelCol="y", regParam=reg, elasticNetParam=elastic, tol=1e-12, maxIter=5000).fit(feats)
    np.testing.assert_allclose(b, m.coefficients.toArray(), rtol=1e-4, atol=1e-6)
    assert b0 == pytest.approx(m.intercept, rel=1e-4)


def test_sweep_is_one_scan_and_judges(spark, frame, data):
    parts = frame.withColumn("part", F.when(F.col("i") % 3 == 0, "v").otherwise("t"))
    got = SS.sweep(parts, "part", "t", "v", COLUMNS[1:], "y", [1.0, 0.0]).collect()
    assert [r.reg_param for r in got] == [1.0, 0.0]
    tr, va = (data[[i % 3 != 0 for i in range(400)]], data[[i % 3 == 0 for i in range(400)]])
    mu = tr[:, 1:].mean(0)
    b, *_ = np.linalg.lstsq(np.column_stack([tr[:, 1:] - mu, np.ones(len(tr))]), tr[:, 0], rcond=None)
    res = va[:, 0] - np.column_stack([va[:, 1:] - mu, np.ones(len(va))]) @ b
    assert got[1].rmse == pytest.approx(math.sqrt(np.mean(res ** 2)), abs=1e-3)
    assert got[1].r2 == pytest.approx(1 - (res @ res) / ((va[:, 0] - va[:, 0].mean()) ** 2).sum(), abs=1e-5)
    empty = SS.sweep(parts.limit(0), "part", "t", "v", COLUMNS[1:], "y", [0.0]).first()
    assert tuple(empty) == (0.0, None, None)


def test_student_p():
    # two-sided p values of textbook quantiles
    for t, df, p in ((12.706, 1, 0.05), (2.228, 10, 0.05), (2.576, 100_000, 0.01), (0.0, 5, 1.0), (3.169, 10, 0.01)):
        assert SS.student_p(t, df) == pytest.approx(p, abs=2e-5)
    assert SS.student_p(60.0, 500) == pytest.approx(0, abs=1e-12)


def test_chunks_go_on(spark, frame):
    path = scratch_path(spark, "state")
    d = frame.withColumn("chunk", F.col("g"))
    CH.add_chunks(d.where("g <= 2"), COLUMNS, "chunk", path)
    CH.add_chunks(d.where("g = 2"), COLUMNS, "chunk", path)          # there already: nothing is added
    state = CH.add_chunks(d, COLUMNS, "chunk", path)                # the rest, the null chunk too
    assert sorted((r.chunk is None, r.chunk or 0) for r in state.collect()) == [(False, i) for i in range(1, 7)] + [(True, 0)]
    whole = SS.least_squares(read(SS.moments(frame, COLUMNS)), COLUMNS[1:], "y")
    fit = CH.fit_chunks(state, COLUMNS, COLUMNS[1:], "y")
    np.testing.assert_allclose(fit.coefficients, whole.coefficients, rtol=1e-8)
    np.testing.assert_allclose(fit.std_errors, whole.std_errors, rtol=1e-6)


def test_logistic_passes_go_on(spark, frame):
    r = np.random.default_rng(4)
    x = r.normal(size=(500, 2))
    y = (r.random(500) < 1 / (1 + np.exp(-(0.5 + x @ [1.0, -2.0])))).astype(float)
    d = spark.createDataFrame([(*map(float, v), float(t)) for v, t in zip(x, y)] + [(None, 1.0, 1.0)], "a double, b double, y double")
    path = scratch_path(spark, "state")
    first = CH.logistic_passes(d, ["a", "b"], "y", path, passes=2)
    assert first.passes == 2 and not first.converged
    fit = CH.logistic_passes(d, ["a", "b"], "y", path, passes=20)
    assert fit.converged and fit.n == 500
    assert [r["pass"] for r in spark.read.parquet(path).orderBy("pass").collect()] == list(range(1, fit.passes + 1))
    want = {t.term: t for t in ML.glm_table(d, ["a", "b"], "y", "binomial", "logit").collect()}
    for term, b, se in fit.table():
        assert b == pytest.approx(want[term].estimate, rel=1e-5)
        if se is not None:
            assert se == pytest.approx(want[term].std_error, rel=1e-4)
    scores = CH.score_equations(d, ["a", "b"], "y", fit.coefficients).collect()
    assert all(abs(s.score) < 1e-9 for s in scores) and len(scores) == 3
    again = CH.logistic_passes(d, ["a", "b"], "y", path, passes=0)
    assert again.coefficients.tolist() == fit.coefficients.tolist()
    none = CH.logistic_passes(d.limit(0), ["a", "b"], "y", scratch_path(spark, "state"))
    assert none.coefficients.tolist() == [0, 0, 0] and none.n == 0


def test_kmeans_clusters(spark, frame):
    d = ML.standardize(frame.select(*COLUMNS), COLUMNS, keep=[])
    rows = ML.kmeans_clusters(d, COLUMNS, [3, 1, 2]).collect()
    assert [(r.k, r.cluster) for r in rows] == [(1, 0), (2, 0), (2, 1), (3, 0), (3, 1), (3, 2)]
    for e in ML.kmeans_elbow(d, COLUMNS, [2, 3]).collect():          # without k = 1 too
        assert e.tss == pytest.approx(e.wss + e.between) and e.n == 400
        assert e.wss == pytest.approx(sum(r.within for r in rows if r.k == e.k))
    assert ML.kmeans_clusters(d.limit(0), COLUMNS, [1, 2]).count() == 0


def test_concurrently(spark):
    assert ML.concurrently([lambda i=i: spark.range(i).count() for i in range(9)], 3) == list(range(9))
    with pytest.raises(ZeroDivisionError):
        ML.concurrently([lambda: 1 / 0, lambda: 1], 2)
    assert ML.concurrently([]) == []


def test_kmeans_of_many_k_share_their_passes(spark, frame):
    d = frame
    jobs = {}
    for name, ks in (("few", [2, 3]), ("many", list(range(1, 10)))):
        spark.sparkContext.setJobGroup(f"kmeans-{name}", name)
        rows = ML.kmeans_clusters(d, COLUMNS, ks, max_iter=3).collect()
        jobs[name] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"kmeans-{name}"))
        assert sorted({r.k for r in rows}) == ks
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs["many"] <= jobs["few"] + 8


def test_kmeans_clusters_are_lloyds_fixed_point(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(m, 0.2, (60, 2)) for m in ((0, 0), (5, 0), (0, 5))])
    d = spark.createDataFrame([(float(a), float(b)) for a, b in x] + [(None, 1.0)], "a double, b double")
    rows = [r for r in ML.kmeans_clusters(d, ["a", "b"], [3, 1]).collect()]
    c = np.array([r.centre for r in rows if r.k == 3])
    apart = ((x[:, None] - c[None]) ** 2).sum(axis=2)
    near = apart.argmin(axis=1)
    for j, r in enumerate(r for r in rows if r.k == 3):
        assert r.n == (near == j).sum() == 60
        assert np.allclose(r.centre, x[near == j].mean(axis=0))
        assert np.isclose(r.within, apart[near == j, j].sum())
    same = spark.createDataFrame([(1.0,)] * 7, "a double")     # fewer distinct points than k
    assert [(r.k, r.n, r.within) for r in ML.kmeans_clusters(same, ["a"], [2]).collect()] == [(2, 7, 0.0)]
