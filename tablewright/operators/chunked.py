"""Fits over chunks that go on from a stored state.

Linear: the state is a table with one row of moments for each chunk seen
(``sufficient.moments``). New chunks are added without reading the old ones,
and the fit over all chunks follows from the table. A chunk that is there
already is left out, so a run that is repeated after a failure adds nothing
twice.

Logistic: the state is a table with one row for each pass over the data: the
coefficients it started from, and sums over the rows at these (deviance,
gradient, information), from which the next coefficients follow. A later call
goes on from the last pass. A pass is one aggregate: every task sums up its
rows, whatever their number.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.operators import sufficient as SS


def _state(spark: SparkSession, path: str) -> DataFrame | None:
    """The state table at ``path``, or None before anything is written."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def add_chunks(df: DataFrame, columns: list[str], chunk: str, path: str) -> DataFrame:
    """The moments of each new value of ``chunk`` appended to the state at
    ``path``; returns the state. Rows of chunks that the state has are not
    counted again; a null in ``chunk`` is a chunk of its own. Only chunks with
    a row without nulls in ``columns`` get a row."""
    spark = df.sparkSession
    known = _state(spark, path)
    if known is not None:
        seen = known.select(F.col(chunk).alias("_seen"))
        df = df.join(seen, df[chunk].eqNullSafe(F.col("_seen")), "left_anti")
    SS.moments(df, columns, [chunk]).write.mode("append").parquet(path)
    return spark.read.parquet(path)


def fit_chunks(state: DataFrame, columns: list[str], features: list[str], label: str) -> SS.LinearFit:
    """Least squares over all chunks of a state, from its rows alone."""
    m = SS.read_moments(SS.merge_moments(state, len(columns)), columns)
    return SS.least_squares(m.get(None) or SS.Moments.of(columns, 0, None, None), features, label)


# --- logistic ----------------------------------------------------------------------

@dataclass
class LogisticState:
    """After ``passes`` passes: the coefficients (intercept last) that the
    last one ended with, and the deviance and information it saw."""

    features: list[str]
    passes: int
    coefficients: np.ndarray
    n: int
    deviance: float
    information: np.ndarray
    converged: bool

    def table(self) -> list[tuple]:
        """(term, estimate, std_error): intercept last, then deviance and AIC."""
        try:
            se = np.sqrt(np.diag(np.linalg.inv(self.information)))
        except np.linalg.LinAlgError:
            se = [None] * len(self.coefficients)
        rows = [(t, float(b), None if s is None else float(s))
                for t, b, s in zip([*self.features, "(intercept)"], self.coefficients, se)]
        return [*rows, ("deviance", self.deviance, None), ("aic", self.deviance + 2 * len(rows), None)]


_PASS = "pass int, before array<double>, n bigint, deviance double, gradient array<double>, information array<double>, after array<double>, converged boolean"


def _sums(df: DataFrame, features: list[str], label: str, b: np.ndarray):
    """One aggregate: rows, deviance, gradient and information at ``b``."""
    x = [F.col(c) for c in features] + [F.lit(1.0)]
    eta = SS.linear_prediction(features, b[:-1], b[-1])
    d = df.withColumn("_eta", eta)
    e, y = F.col("_eta"), F.col(label)
    p = F.when(e >= 0, 1 / (1 + F.exp(-e))).otherwise(F.exp(e) / (1 + F.exp(e)))
    d = d.withColumn("_p", p)
    w = F.col("_p") * (1 - F.col("_p"))
    loss = F.log1p(F.exp(-F.abs(e))) + F.when(e >= 0, e).otherwise(0.0) - y * e
    return d.agg(F.count(F.lit(1)).alias("n"), (2 * F.sum(loss)).alias("deviance"),
                 F.array(*[F.sum((y - F.col("_p")) * v) for v in x]).alias("gradient"),
                 F.array(*[F.sum(w * x[i] * x[j]) for i, j in SS._pairs(len(x))]).alias("information")).first()


def _square(packed: list[float], p: int) -> np.ndarray:
    out = np.zeros((p, p))
    for (i, j), v in zip(SS._pairs(p), packed):
        out[i, j] = out[j, i] = v
    return out


def _step(h: np.ndarray, g: np.ndarray) -> np.ndarray:
    """The Fisher step, with rows and columns scaled to a unit diagonal."""
    s = np.sqrt(np.where(np.diag(h) > 0, np.diag(h), 1.0))
    return np.linalg.pinv(h / np.outer(s, s), rcond=1e-12, hermitian=True) @ (g / s) / s


def logistic_passes(df: DataFrame, features: list[str], label: str, path: str, passes: int = 10,
                    tol: float = 1e-9) -> LogisticState:
    """Up to ``passes`` Fisher steps of a logistic fit of a 0/1 label on from
    the state at ``path`` (none: from zero coefficients), each appended to the
    state; fewer if the deviance changes by less than ``tol`` of itself. A
    step that raised the deviance is taken back by half. Rows with a null in
    the label or a feature do not count; no rows: coefficients stay 0.

    ``df`` may have more rows than in an earlier call: the passes then go on
    from the coefficients reached, over the rows there are now."""
    spark, p = df.sparkSession, len(features) + 1
    d = df.select(*[F.col(c).cast("double").alias(c) for c in [label, *features]]).na.drop()
    known = _state(spark, path)
    last = known.orderBy(F.desc("pass")).first() if known is not None else None
    at = last["pass"] if last else 0
    b = np.array(last["after"] if last else [0.0] * p)
    before, deviance, n = (np.array(last["before"]), last["deviance"], last["n"]) if last else (b, None, None)
    for _ in range(passes):
        s = _sums(d, features, label, b)
        if not s["n"]:
            return LogisticState(features, at, b, 0, 0.0, np.zeros((p, p)), True)
        if n == s["n"] and s["deviance"] > deviance * (1 + 1e-9) + 1e-9:
            after, done = (before + b) / 2, False
        else:
            after = b + _step(_square(s["information"], p), np.array(s["gradient"]))
            done = n == s["n"] and abs(deviance - s["deviance"]) <= tol * (abs(s["deviance"]) + 0.1)
            before = b
        at += 1
        spark.createDataFrame([(at, before.tolist(), s["n"], s["deviance"], s["gradient"], s["information"], after.tolist(), done)],
                              _PASS).coalesce(1).write.mode("append").parquet(path)
        b, deviance, n, last = after, s["deviance"], s["n"], s
        if done:
            break
    info = _square(last["information"], p) if last else np.zeros((p, p))
    return LogisticState(features, at, b, n or 0, deviance or 0.0, info, bool(last) and done if passes else False)


def score_equations(df: DataFrame, features: list[str], label: str, b) -> DataFrame:
    """(term, n, score): for each term the mean of residual times term at the
    coefficients ``b`` (intercept last), which a fit makes 0."""
    d = df.select(*[F.col(c).cast("double").alias(c) for c in [label, *features]]).na.drop()
    s = _sums(d, features, label, np.asarray(b, float))
    rows = [(t, s["n"], float(g) / s["n"] if s["n"] else None) for t, g in zip([*features, "(intercept)"], s["gradient"])]
    return df.sparkSession.createDataFrame(rows, "term string, n bigint, score double")
