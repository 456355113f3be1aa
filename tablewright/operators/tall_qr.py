"""Tall-skinny QR (L6, L7, L9): singular values, loadings and least squares
from a tree of partition factors.

Each partition of the rows X (n x p, p small) is reduced to the R of its QR
factorisation, batch by batch: at most p x p numbers, whatever the partition
holds. R factors stacked and factored again give the R of the rows together,
so ``FAN`` of them at a time go up a tree until at most ``FAN`` are left; those
reach the driver. R has the singular values and right singular vectors of X,
and no product X'X is ever formed: that would square the condition number, and
columns that differ by less than the root of the machine precision would
become the same.

No task and no tree node holds more than one batch of rows or ``FAN`` factors;
a lost task repeats its partition, or its few factors, alone.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.operators.ml import _component_signs, column_moments, standardize
from tablewright.operators.sufficient import LinearFit
from tablewright.sources.files import stored

#: Factors that one node of the tree merges.
FAN = 64

_SCHEMA = "part long, n long, r array<double>"


def _stacked(r: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The R of what ``r`` stands for with ``rows`` below it."""
    return np.linalg.qr(np.vstack([r, rows]), mode="r")


def partition_factors(df: DataFrame, columns: list[str]) -> DataFrame:
    """(part, n, r): for each partition with rows their number and the R
    factor, row by row, of their ``columns`` (doubles). Rows with a null or a
    NaN in a column do not count."""
    p = len(columns)

    def factor(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext
        n, r = 0, np.zeros((0, p))
        for b in batches:
            if b.num_rows:
                n += b.num_rows
                r = _stacked(r, np.column_stack([c.to_numpy(zero_copy_only=False) for c in b.columns]))
        if n:
            part = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int64()), pa.array([n], pa.int64()), pa.array([r.ravel().tolist()], pa.list_(pa.float64()))],
                names=["part", "n", "r"])

    x = df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(columns)]).na.drop()
    return x.mapInArrow(factor, _SCHEMA)


def _one_factor(n: list, r: list, p: int) -> tuple[int, np.ndarray]:
    out = np.zeros((0, p))
    for v in r:
        out = _stacked(out, np.array(v, float).reshape(-1, p))
    return int(sum(n)), out


def merge_factors(factors: DataFrame, p: int, fan: int = FAN) -> DataFrame:
    """Rows of ``partition_factors`` over ``p`` columns merged up a tree to at
    most ``fan`` rows: factors whose ``part`` is equal after division by the
    fan are one factor on the next level. ``factors`` must be stored, as its
    largest part is asked for first."""
    def node(key, t):
        import pyarrow as pa
        n, r = _one_factor(t.column("n").to_pylist(), t.column("r").to_pylist(), p)
        return pa.table({"part": pa.array([key[0].as_py()], pa.int64()), "n": pa.array([n], pa.int64()),
                         "r": pa.array([r.ravel().tolist()], pa.list_(pa.float64()))})

    parts = (factors.agg(F.max("part")).first()[0] or 0) + 1
    while parts > fan:
        up = factors.withColumn("part", F.floor(F.col("part") / fan))
        factors = up.groupBy("part").applyInArrow(node, _SCHEMA)
        parts = -(-parts // fan)
    return factors


def r_factor(df: DataFrame, columns: list[str], fan: int = FAN) -> tuple[int, np.ndarray]:
    """(rows, R): a p x p upper triangle with R'R = X'X, rows of zeros where
    there are fewer rows than columns."""
    p = len(columns)
    rows = merge_factors(stored(partition_factors(df, columns)), p, fan).collect()
    n, r = _one_factor([x.n for x in rows], [x.r for x in rows], p)
    return n, np.vstack([r, np.zeros((p - len(r), p))])


@dataclass
class Components:
    n: int
    values: np.ndarray          # singular values, largest first
    loadings: np.ndarray        # a column for each component


def components(df: DataFrame, columns: list[str], fan: int = FAN) -> Components:
    """Singular values and loadings of the standardised columns: one scan for
    means and deviations, one for the factors. Of a component the loading
    largest in size is positive. A constant column counts as zeros; no rows:
    all values 0."""
    clean = df.select(*columns).na.drop()
    m = column_moments(clean, columns, ddof=1)
    if not m["n"]:
        return Components(0, np.zeros(len(columns)), np.eye(len(columns)))
    n, r = r_factor(standardize(clean, columns, ddof=1, keep=[], moments=m), columns, fan)
    _, s, vt = np.linalg.svd(r)
    return Components(n, s, vt.T * _component_signs(vt.T))


def pca_explained_qr(df: DataFrame, columns: list[str], digits: int = 6, fan: int = FAN) -> DataFrame:
    """L6/L7 without a covariance matrix: (component, ratio, cumulative,
    eigenvalue, singular_value). Null ratios where no column varies."""
    c = components(df, columns, fan)
    total, rows, upto = float(c.values @ c.values), [], 0.0
    for j, s in enumerate(map(float, c.values)):
        upto += s * s
        rows.append((j + 1, *[round(v / total, digits) if total else None for v in (s * s, upto)],
                     round(s * s / (c.n - 1), digits) if c.n > 1 else None, round(s, 4)))
    return df.sparkSession.createDataFrame(
        rows, "component int, ratio double, cumulative double, eigenvalue double, singular_value double")


def pca_loadings_qr(df: DataFrame, columns: list[str], fan: int = FAN) -> DataFrame:
    """(component, name, loading, eigenvalue), a row for each component
    and column."""
    c = components(df, columns, fan)
    eigen = [float(s * s / (c.n - 1)) if c.n > 1 else None for s in c.values]
    rows = [(j + 1, name, float(c.loadings[i, j]), eigen[j]) for j in range(len(columns)) for i, name in enumerate(columns)]
    return df.sparkSession.createDataFrame(rows, "component int, name string, loading double, eigenvalue double")


def least_squares_qr(df: DataFrame, features: list[str], label: str, fan: int = FAN) -> LinearFit:
    """L9 by orthogonal factors: least squares with an intercept from the R of
    the standardised features and label, so nearly collinear features keep
    their coefficients. A constant feature gets coefficient 0 and no standard
    error; among exactly dependent ones the solution of least norm is taken.
    No rows: all coefficients 0."""
    columns, p = [*features, label], len(features)
    clean = df.select(*columns).na.drop()
    m = column_moments(clean, columns, ddof=1)
    if not m["n"]:
        return LinearFit(list(features), np.zeros(p), 0.0, [None] * (p + 1), -1, 0.0, 0.0)
    n, r = r_factor(standardize(clean, columns, ddof=1, keep=[], moments=m), columns, fan)
    sd = np.array([m["sd"][c] or 0.0 for c in columns])
    mean = np.array([m["mean"][c] for c in columns])
    live = sd[:p] > 0
    scale = np.where(live, sd[:p], 1.0)
    inverse = np.linalg.pinv(r[:p, :p], rcond=1e-14)
    z = r[:p, p]
    b = inverse @ z
    sse = float((np.sum((z - r[:p, :p] @ b) ** 2) + r[p, p] ** 2) * sd[p] ** 2)
    b = b * sd[p] / scale * live
    freedom = n - int(live.sum()) - 1
    errors: list[float | None] = [None] * (p + 1)
    if freedom > 0 and sse > 0:
        rows = inverse / scale[:, None]             # its rows' products are the inverse of X'X
        sigma2 = sse / freedom
        for i in np.flatnonzero(live):
            errors[i] = math.sqrt(sigma2 * float(rows[i] @ rows[i]))
        at = np.where(live, mean[:p], 0.0) @ rows
        errors[-1] = math.sqrt(sigma2 * (1 / n + float(at @ at)))
    return LinearFit(list(features), b, float(mean[p] - b @ mean[:p]), errors, freedom, sse, float((n - 1) * sd[p] ** 2))


def linreg_table_qr(df: DataFrame, features: list[str], label: str, fan: int = FAN) -> DataFrame:
    """(term, estimate, std_error, t_value, p_value), intercept last."""
    return df.sparkSession.createDataFrame(
        least_squares_qr(df, features, label, fan).table(),
        "term string, estimate double, std_error double, t_value double, p_value double")
