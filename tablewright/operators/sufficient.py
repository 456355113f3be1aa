"""Linear models from sufficient statistics.

``moments`` reduces rows to count, means and centred cross products, one row
for each part of the data, in one aggregate. Such rows merge without the rows
they came from (``merge_moments``), may be stored, and hold all that least
squares, ridge, lasso and elastic-net fits, their standard errors, and the
RMSE and R2 of any coefficients on any part need. So a sweep over strengths,
judged on a validation part, reads the data once. Only rows of p * (p + 5) / 2
+ 1 numbers for p columns reach the driver, one for each part asked for.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _pairs(p: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(p) for j in range(i, p)]


def moments(df: DataFrame, columns: list[str], by: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """One row for each value of ``by`` (one row in all without it): ``by``,
    ``n``, ``mean`` of each column, ``cross``: the sums of products of
    deviations for each pair of columns i <= j. Rows with a null in a column
    do not count; the one row over no rows has n = 0 and nulls."""
    d = df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns]).na.drop(subset=columns)
    n = F.count(F.lit(1))
    means = F.array(*[F.avg(c) for c in columns])
    cross = F.array(*[F.covar_pop(columns[i], columns[j]) * n for i, j in _pairs(len(columns))])
    return d.groupBy(*by).agg(n.alias("n"), means.alias("mean"), cross.alias("cross"))


def merge_moments(m: DataFrame, p: int, by: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """Rows of ``moments`` over ``p`` columns merged to one row for each value
    of ``by``: the rows that ``moments`` gives for the parts together, without
    the data. Two aggregates over the rows of moments: the common means first,
    then what each part adds around them (no difference of large sums)."""
    m = m.where("n > 0")
    at = lambda c, i: F.col(c)[i]
    total = m.groupBy(*by).agg(
        F.sum("n").alias("_n"), F.array(*[F.sum(F.col("n") * at("mean", i)) / F.sum("n") for i in range(p)]).alias("_mean"))
    if by:
        keyed = total.select(*[F.col(c).alias(f"_by_{c}") for c in by], "_n", "_mean")
        same = F.lit(True)
        for c in by:
            same = same & m[c].eqNullSafe(keyed[f"_by_{c}"])
        both = m.join(keyed, same)
    else:                                       # one row, brought back as literals
        t = total.first()
        both = m.withColumns({"_n": F.lit(t["_n"]).cast("long"), "_mean": F.lit(t["_mean"]).cast("array<double>")})
    off = lambda i: at("mean", i) - at("_mean", i)
    return (both.groupBy(*by, "_n", "_mean")
            .agg(F.array(*[F.sum(at("cross", k) + F.col("n") * off(i) * off(j)) for k, (i, j) in enumerate(_pairs(p))]).alias("cross"))
            .select(*by, F.col("_n").alias("n"), F.col("_mean").alias("mean"), "cross"))


@dataclass
class Moments:
    columns: list[str]
    n: int
    mean: np.ndarray
    cross: np.ndarray

    @classmethod
    def of(cls, columns: list[str], n: int, mean, cross) -> Moments:
        p = len(columns)
        c = np.zeros((p, p))
        for (i, j), v in zip(_pairs(p), cross if n else [0.0] * (p * (p + 1) // 2)):
            c[i, j] = c[j, i] = v
        return cls(list(columns), int(n), np.array(mean if n else [0.0] * p, float), c)

    def parts(self, features: list[str], label: str):
        """(feature means, label mean, X'X, X'y, y'y), centred."""
        f, y = [self.columns.index(c) for c in features], self.columns.index(label)
        return self.mean[f], self.mean[y], self.cross[np.ix_(f, f)], self.cross[f, y], self.cross[y, y]


def read_moments(m: DataFrame, columns: list[str], by: str | None = None) -> dict:
    """The rows of ``moments`` by the value of ``by`` (by None: the one row
    under the key None). As many rows as parts reach the driver."""
    return {r[by] if by else None: Moments.of(columns, r["n"], r["mean"], r["cross"]) for r in m.collect()}


# --- fits -------------------------------------------------------------------------

@dataclass
class LinearFit:
    features: list[str]
    coefficients: np.ndarray
    intercept: float
    std_errors: list[float | None]      # the intercept's last
    freedom: int
    sse: float
    tss: float

    def table(self) -> list[tuple]:
        """(term, estimate, std_error, t_value, p_value), intercept last."""
        out = []
        for t, b, s in zip([*self.features, "(intercept)"], [*self.coefficients, self.intercept], self.std_errors):
            v = float(b / s) if s else None
            out.append((t, float(b), s, v, None if v is None else student_p(v, self.freedom)))
        return out


def least_squares(m: Moments, features: list[str], label: str) -> LinearFit:
    """Least squares with an intercept. A constant feature gets coefficient 0
    and no standard error; among linearly dependent features the solution of
    least norm (in standardised features) is taken. Standard errors are null
    where no degree of freedom is left; no rows: all coefficients 0."""
    mx, my, xx, xy, yy = m.parts(features, label)
    sd = np.sqrt(np.diag(xx))
    live = sd > 0
    scale = np.where(live, sd, 1.0)
    r = xx / np.outer(scale, scale)
    inverse = np.linalg.pinv(r, rcond=1e-12, hermitian=True)
    b = inverse @ (xy / scale) / scale * live
    sse = max(0.0, float(yy - b @ xy))
    freedom = m.n - int(live.sum()) - 1
    errors: list[float | None] = [None] * (len(features) + 1)
    if freedom > 0 and sse > 0:
        sigma2, inv = sse / freedom, inverse / np.outer(scale, scale)
        for i in np.flatnonzero(live):
            errors[i] = math.sqrt(sigma2 * inv[i, i])
        at = np.where(live, mx, 0.0)
        errors[-1] = math.sqrt(sigma2 * (1 / m.n + at @ inv @ at))
    return LinearFit(list(features), b, float(my - b @ mx), errors, freedom, sse, float(yy))


def penalised(m: Moments, features: list[str], label: str, reg: float, elastic: float = 0.0,
              start: np.ndarray | None = None, tol: float = 1e-12, rounds: int = 100_000) -> tuple[np.ndarray, float]:
    """(coefficients, intercept) of a fit with penalty ``reg`` times
    (1 - elastic) / 2 |b|^2 + elastic |b|_1 on standardised features, the label
    scaled to standard deviation 1 (the convention of ``pyspark.ml``).

    Ridge (elastic 0) is one linear system; else coordinate descent on the
    correlations, which never needs the rows again. ``start``: coefficients of
    a neighbouring strength."""
    mx, my, xx, xy, yy = m.parts(features, label)
    sd, sy = np.sqrt(np.diag(xx) / max(m.n, 1)), math.sqrt(yy / max(m.n, 1))
    live = np.flatnonzero(sd > 0)
    out = np.zeros(len(features))
    if sy > 0 and len(live):
        s = sd[live]
        r = xx[np.ix_(live, live)] / m.n / np.outer(s, s)
        c, lam = xy[live] / m.n / s / sy, reg / sy
        if elastic == 0:
            a = r + lam * np.eye(len(s))
            b = np.linalg.solve(a, c) if lam > 0 else np.linalg.pinv(a, rcond=1e-12, hermitian=True) @ c
        else:
            b = np.zeros(len(s)) if start is None else start[live] * s / sy
            for _ in range(rounds):
                before = b.copy()
                for i in range(len(s)):
                    u = c[i] - r[i] @ b + r[i, i] * b[i]
                    b[i] = math.copysign(max(abs(u) - lam * elastic, 0.0), u) / (r[i, i] + lam * (1 - elastic))
                if np.abs(b - before).max() <= tol:
                    break
        out[live] = b * sy / s
    return out, float(my - out @ mx)


def judged(m: Moments, features: list[str], label: str, b: np.ndarray, intercept: float) -> tuple[float | None, float | None]:
    """(RMSE, R2) of coefficients on the rows behind ``m``."""
    if not m.n:
        return None, None
    mx, my, xx, xy, yy = m.parts(features, label)
    off = my - intercept - b @ mx
    sse = max(0.0, float(yy - 2 * b @ xy + b @ xx @ b + m.n * off * off))
    return math.sqrt(sse / m.n), float(1 - sse / yy) if yy > 0 else None


def sweep(parts: DataFrame, part: str, train: str, valid: str, features: list[str], label: str,
          regs: list[float], elastic: float = 0.0) -> DataFrame:
    """(reg_param, rmse, r2) for each strength: fitted on the rows whose
    ``part`` is ``train``, judged on those where it is ``valid``. One scan and
    one aggregate of ``parts``, however many strengths."""
    columns = [label, *features]
    d = parts.where(F.col(part).isin(train, valid))
    m = read_moments(moments(d, columns, [part]), columns, part)
    none = Moments.of(columns, 0, None, None)
    t, v = m.get(train, none), m.get(valid, none)
    out, b = {}, None
    for reg in sorted(regs, reverse=True):       # strongest first: each starts the next
        b, b0 = penalised(t, features, label, reg, elastic, b)
        rmse, r2 = judged(v, features, label, b, b0)
        out[reg] = (float(reg), None if rmse is None else round(rmse, 4), None if r2 is None else round(r2, 6))
    return parts.sparkSession.createDataFrame([out[r] for r in regs], "reg_param double, rmse double, r2 double")


def linear_prediction(features: list[str], b, intercept: float) -> Column:
    """The fitted value of a row as a column expression."""
    out = F.lit(float(intercept))
    for c, v in zip(features, b):
        out = out + F.lit(float(v)) * F.col(c)
    return out


# --- Student's t -------------------------------------------------------------------

def student_p(t: float, freedom: int) -> float:
    """Two-sided p value: the regularised incomplete beta function at
    freedom / (freedom + t^2), by its continued fraction."""
    x = freedom / (freedom + t * t)
    a, b = freedom / 2, 0.5
    if x >= 1:
        return 1.0
    if x <= 0:
        return 0.0
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1) / (a + b + 2):
        return min(1.0, front * _beta_fraction(a, b, x) / a)
    return max(0.0, 1 - front * _beta_fraction(b, a, 1 - x) / b)


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Lentz's evaluation of the continued fraction of the beta integral."""
    tiny = 1e-300
    c, d = 1.0, 1 - (a + b) * x / (a + 1)
    d = 1 / (d if abs(d) > tiny else tiny)
    h = d
    for k in range(1, 10_000):
        for num in (k * (b - k) * x / ((a + 2 * k - 1) * (a + 2 * k)),
                    -(a + k) * (a + b + k) * x / ((a + 2 * k) * (a + 2 * k + 1))):
            d = 1 + num * d
            d = 1 / (d if abs(d) > tiny else tiny)
            c = 1 + num / c
            c = c if abs(c) > tiny else tiny
            h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return h
