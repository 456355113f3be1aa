"""Tall-skinny QR against numpy, and where a covariance matrix fails."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.operators import sufficient as SS
from tablewright.operators import tall_qr as QR
from tablewright.sources.files import stored

COLUMNS = ["a", "b", "c", "d"]
SCHEMA = ", ".join(f"{c} double" for c in COLUMNS)


def near_collinear(n=1500):
    """d differs from a + b by a billionth."""
    r = np.random.default_rng(3)
    x = r.normal(size=(n, 4)) * [1, 2, 5, 1e-9] + [3, 0, -1, 0]
    x[:, 3] += x[:, 0] + x[:, 1]
    return x


def frame(spark, x, parts=7):
    rows = [tuple(map(float, v)) for v in x]
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def standard(x):
    return (x - x.mean(0)) / x.std(0, ddof=1)


@pytest.mark.parametrize("fan", [2, 3, 64])
def test_factor_of_the_tree(spark, fan):
    """R'R = X'X for every fan; the number of rows is kept."""
    x = np.random.default_rng(1).normal(size=(300, 4))
    n, r = QR.r_factor(frame(spark, x, 11), COLUMNS, fan)
    assert n == 300 and r.shape == (4, 4)
    assert np.allclose(r.T @ r, x.T @ x, rtol=1e-12) and np.allclose(np.tril(r, -1), 0)


def test_tree_narrows_to_the_fan(spark):
    f = stored(QR.partition_factors(frame(spark, np.ones((200, 4)), 20), COLUMNS))
    assert 2 < f.count() <= 20
    up = QR.merge_factors(f, 4, fan=2)
    assert up.count() <= 2 and up.agg(F.sum("n")).first()[0] == 200


def test_near_collinear_columns(spark):
    """The smallest singular value is found to 4 digits; the root of the
    covariance matrix's smallest eigenvalue is not."""
    x = near_collinear()
    df = frame(spark, x)
    want = np.linalg.svd(standard(x), compute_uv=False)
    assert want[-1] < 1e-8 * want[0]
    got = QR.components(df, COLUMNS)
    assert np.allclose(got.values, want, rtol=1e-4, atol=0)
    m = SS.read_moments(SS.moments(df, COLUMNS), COLUMNS)[None]
    sd = np.sqrt(np.diag(m.cross))
    eigen = np.linalg.eigvalsh(m.cross / np.outer(sd, sd)) * (m.n - 1)
    assert not np.allclose(np.sqrt(np.abs(eigen))[::-1], want, rtol=1e-4, atol=0)
    v = np.linalg.svd(standard(x))[2].T
    assert np.allclose(np.abs(got.loadings), np.abs(v), atol=1e-6)
    assert all(c[np.argmax(np.abs(c) >= np.abs(c).max() - 1e-9)] > 0 for c in got.loadings.T)


def test_least_squares_of_near_collinear_features(spark):
    """Coefficients of columns that moments cannot tell apart. The label is
    made without noise, so they are known."""
    x = near_collinear()
    x[:, 2] = 2 * x[:, 0] - x[:, 1] + 5e8 * (x[:, 3] - x[:, 0] - x[:, 1])
    df = frame(spark, x)
    fit = QR.least_squares_qr(df, ["a", "b", "d"], "c")
    want = np.linalg.lstsq(np.column_stack([x[:, [0, 1, 3]], np.ones(len(x))]), x[:, 2], rcond=None)[0]
    assert np.allclose(fit.coefficients, want[:3], rtol=1e-4)
    assert np.allclose(fit.coefficients[2], 5e8, rtol=1e-4)
    m = SS.read_moments(SS.moments(df, COLUMNS), COLUMNS)[None]
    assert not np.allclose(SS.least_squares(m, ["a", "b", "d"], "c").coefficients, want[:3], rtol=1e-4)


def test_least_squares_equals_moments(spark):
    r = np.random.default_rng(5)
    x = r.normal(size=(400, 4)) * [1, 50, 0.01, 1] + [1e4, -3, 0.5, 0]
    x[:, 3] += 3 + x[:, :3] @ [2.0, -0.1, 40.0]
    df = frame(spark, x)
    m = SS.read_moments(SS.moments(df, COLUMNS), COLUMNS)[None]
    a, b = QR.least_squares_qr(df, COLUMNS[:3], "d"), SS.least_squares(m, COLUMNS[:3], "d")
    assert (a.freedom, len(a.table())) == (b.freedom, 4)
    for s, t in zip(a.table(), b.table()):
        assert s[0] == t[0] and np.allclose(s[1:], t[1:], rtol=1e-6)
    assert np.isclose(a.sse, b.sse, rtol=1e-8) and np.isclose(a.tss, b.tss, rtol=1e-8)


def test_edges(spark):
    """Nulls, fewer rows than columns, constant and dependent columns, none."""
    df = spark.createDataFrame([(1.0, 2.0, 0.0, 7.0), (3.0, 1.0, 0.0, 7.0), (None, 1.0, 1.0, 1.0),
                                (float("nan"), 1.0, 1.0, 1.0)], SCHEMA)
    c = QR.components(df, COLUMNS)
    assert c.n == 2 and np.allclose(c.values, [np.sqrt(2), 0, 0, 0])
    rows = QR.pca_explained_qr(df, COLUMNS).collect()
    assert [r.ratio for r in rows] == [1.0, 0.0, 0.0, 0.0]
    empty = df.where("a > 100")
    assert [(r.ratio, r.eigenvalue, r.singular_value) for r in QR.pca_explained_qr(empty, COLUMNS).collect()] == [(None, None, 0.0)] * 4
    assert [r.estimate for r in QR.linreg_table_qr(empty, COLUMNS[:3], "d").collect()] == [0.0] * 4
    one = QR.pca_explained_qr(df.where("a = 1"), COLUMNS).collect()
    assert all(r.ratio is None for r in one)
    x = np.random.default_rng(6).normal(size=(50, 4))
    x[:, 1], x[:, 2] = 2 * x[:, 0], 4.0
    fit = QR.least_squares_qr(frame(spark, x), COLUMNS[:3], "d")
    slope = np.polyfit(x[:, 0], x[:, 3], 1)[0]
    assert fit.coefficients[2] == 0 and np.isclose(fit.coefficients[0] + 2 * fit.coefficients[1], slope)
    extra = frame(spark, x).selectExpr("*", "1 AS part", "2 AS n", "array(0d) AS r", "0d AS x0")
    assert np.allclose(QR.components(extra, COLUMNS).values, QR.components(frame(spark, x), COLUMNS).values)
