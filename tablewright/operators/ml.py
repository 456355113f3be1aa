"""Model fitting on ``pyspark.ml``.

The estimators are Spark's distributed ones: k-means (k-means|| start,
Lloyd steps as partial sums per task), PCA (covariance by a tree
aggregate, d x d eigen-decomposition on the driver), linear and generalised
linear models (normal equations / IRLS, d x d systems on the driver). Only
model-sized results (k centres, d loadings, p coefficients) reach the
driver; rows stay distributed. Frames that a loop fits many times are
persisted for the loop and released after it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager
from threading import Lock

from pyspark import InheritableThread, StorageLevel, TaskContext
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GeneralizedLinearRegression, LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.operators import sufficient as SS


# --- features -------------------------------------------------------------------

def column_moments(df: DataFrame, columns: list[str], ddof: int = 1) -> dict:
    """One aggregate: row count, and mean and sd (sample for ``ddof=1``,
    population for 0) of each column. 1 + 2 * len(columns) numbers."""
    sd = F.stddev_samp if ddof == 1 else F.stddev_pop
    row = df.agg(F.count(F.lit(1)).alias("n"),
                 *[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)],
                 *[sd(c).alias(f"s{i}") for i, c in enumerate(columns)]).collect()[0]
    return {"n": row["n"],
            "mean": {c: row[f"m{i}"] for i, c in enumerate(columns)},
            "sd": {c: row[f"s{i}"] for i, c in enumerate(columns)}}


def standardize(df: DataFrame, columns: list[str], ddof: int = 1,
                keep: list[str] | None = None, suffix: str = "",
                moments: dict | None = None) -> DataFrame:
    """L1: (x - mean) / sd per column; ``ddof=1`` divides by the sample sd
    (R, Spark's StandardScaler), ``ddof=0`` by the population sd (sklearn).
    A constant column gives 0, as StandardScaler does. The means and sds
    come from one aggregate and are applied as literals."""
    mom = moments or column_moments(df, columns, ddof)
    keep = [c for c in df.columns if c not in columns] if keep is None else keep
    out = []
    for c in columns:
        m, s = mom["mean"][c], mom["sd"][c]
        if s is None or s == 0:
            out.append(F.when(F.col(c).isNotNull(), F.lit(0.0)).alias(c + suffix))
        else:
            out.append(((F.col(c) - F.lit(m)) / F.lit(s)).alias(c + suffix))
    return df.select(*keep, *out)


@contextmanager
def held(df: DataFrame, spread: bool = False):
    """Persist a frame (memory, spilling to disk) while an estimator makes
    several passes over it and its summary is read; release it after. The
    lineage stays, so a lost executor's blocks are recomputed.

    ``spread``: for many passes; a frame in fewer partitions than there are
    cores (one small file) is dealt out over all of them once."""
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    cores = df.sparkSession.sparkContext.defaultParallelism
    first = kept
    if spread and kept.rdd.getNumPartitions() < cores:
        kept = kept.repartition(cores).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()
        first.unpersist()


def assemble(df: DataFrame, columns: list[str], out: str = "features") -> DataFrame:
    """The feature columns as one vector column; the label stays a
    column of the same frame (never two frames aligned by position)."""
    return VectorAssembler(inputCols=columns, outputCol=out).transform(df)


def total_sum_squares(df: DataFrame, columns: list[str]) -> float:
    """Sum over columns of squared distances to the column mean."""
    row = df.agg(F.count(F.lit(1)).alias("n"),
                 *[F.var_pop(c).alias(c) for c in columns]).collect()[0]
    return float(sum((row[c] or 0.0) for c in columns) * row["n"])


# --- k-means ---------------------------------------------------------------------

def kmeans_fit(df: DataFrame, columns: list[str], k: int, seed: int = 1,
               max_iter: int = 20):
    """L2: fit k-means on the columns; returns (model, rows with a
    ``cluster`` column)."""
    feats = assemble(df, columns)
    with held(feats.select("features"), spread=True) as points:
        model = KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol="features",
                       predictionCol="cluster").fit(points)
    return model, model.transform(feats).drop("features")


def kmeans_centres(df: DataFrame, columns: list[str], k: int, seed: int = 1,
                   digits: int = 4) -> DataFrame:
    """L2: centres and sizes of a k-means fit, one row per cluster (k rows;
    the sizes come from the fit's own summary, no extra pass)."""
    with held(assemble(df.select(*columns).na.drop(), columns).select("features"), spread=True) as feats:
        model = KMeans(k=k, seed=seed, featuresCol="features").fit(feats)
        sizes = list(model.summary.clusterSizes)
        centres = [[float(x) for x in c] for c in model.clusterCenters()]
    rows = [(*[round(x, digits) for x in c], int(sizes[i])) for i, c in enumerate(centres)]
    return df.sparkSession.createDataFrame(
        rows, ", ".join(f"`{c}` double" for c in columns) + ", size bigint")


def concurrently(tasks: list, workers: int = 4) -> list:
    """The results of ``tasks`` (functions that run Spark jobs), called from
    several driver threads with the session's local properties, so that cores
    which one task's small stages leave idle serve another. The first error is
    raised once all threads have ended."""
    out: list = [None] * len(tasks)
    errors: list[BaseException] = []
    left = iter(range(len(tasks)))
    lock = Lock()

    def work() -> None:
        while not errors:
            with lock:
                i = next(left, None)
            if i is None:
                return
            try:
                out[i] = tasks[i]()
            except BaseException as e:  # noqa: BLE001 - raised below, in the caller's thread
                errors.append(e)

    threads = [InheritableThread(target=work) for _ in range(min(workers, len(tasks)))]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    if errors:
        raise errors[0]
    return out


def _points(batches: Iterator) -> Iterator:
    """The rows of each Arrow batch of numbers as an array, a column a row."""
    import numpy as np
    for b in batches:
        if b.num_rows:
            yield np.array([c.to_numpy(zero_copy_only=False) for c in b.columns])


def _nearest(x, groups: list) -> Iterator:
    """For each array of centres in ``groups`` the place in it of the centre
    that is closest to each of the points ``x``: one product for all groups."""
    import numpy as np
    c = np.concatenate(groups)
    far = np.column_stack([-2.0 * c, (c * c).sum(axis=1)]) @ np.vstack([x, np.ones(x.shape[1])])
    at = 0
    for g in groups:
        yield far[at:at + len(g)].argmin(axis=0)
        at += len(g)


def _tallies(points: DataFrame, groups: list, origin, squares: bool = False) -> dict:
    """One pass for all ``groups`` of centres: {(group, place): (n, sums,
    within)} of the rows closest to each centre: their number, the sums of
    their differences from ``origin``, or with ``squares`` from their centre,
    and the sum of their squares. As many rows as centres reach the driver."""
    d = len(origin)

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        sums = [np.zeros((d + 2, len(g))) for g in groups]
        for x in _points(batches):
            x = x - origin[:, None]
            for g, s, near in zip(groups, sums, _nearest(x, groups)):
                off = x - g.T[:, near] if squares else x
                s[0] += np.bincount(near, minlength=len(g))
                for j in range(d):
                    s[1 + j] += np.bincount(near, weights=off[j], minlength=len(g))
                if squares:
                    s[-1] += np.bincount(near, weights=(off * off).sum(axis=0), minlength=len(g))
        flat = np.concatenate(sums, axis=1)
        yield pa.RecordBatch.from_arrays(
            [pa.array([i for i, g in enumerate(groups) for _ in g], pa.int32()),
             pa.array([j for g in groups for j in range(len(g))], pa.int32()),
             pa.array(flat[0].astype(np.int64)), *[pa.array(v) for v in flat[1:]]],
            names=["g", "c", "n", *[f"s{j}" for j in range(d)], "q"])

    parts = points.mapInArrow(run, f"g int, c int, n long, {', '.join(f's{j} double' for j in range(d))}, q double")
    rows = parts.groupBy("g", "c").agg(*[F.sum(v).alias(v) for v in parts.columns[2:]]).collect()
    return {(r.g, r.c): (r.n, [r[f"s{j}"] for j in range(d)], r.q) for r in rows}


def _candidates(points: DataFrame, k: int, origin, squares: float, seed: int, steps: int = 2) -> tuple:
    """The start of k-means||: (candidates, rows closest to each). A random
    row, and in each step rows drawn with a chance in proportion to their
    squared distance from the candidates so far, 2 ``k`` of them on average.
    The draws are seeded by step and partition, as Spark's own are.
    ``squares``: the sum of squares around ``origin``, the mean."""
    import numpy as np
    columns = points.columns
    kind = ", ".join(f"`{c}` double" for c in columns)

    def rows(x, names, *first):
        import pyarrow as pa
        return pa.RecordBatch.from_arrays([*map(pa.array, first), *map(pa.array, x)], names=names)

    def generator(step: int):
        return np.random.default_rng([seed % (1 << 32), step, TaskContext.get().partitionId()])

    def lowest(batches: Iterator) -> Iterator:
        draws = generator(0)
        for x in _points(batches):
            u = draws.random(x.shape[1])
            i = [int(u.argmin())]
            yield rows(x[:, i], ["_u", *columns], u[i])

    def cost(x, c):
        return ((x - c.T[:, next(_nearest(x, [c]))]) ** 2).sum(axis=0)

    first = points.mapInArrow(lowest, f"_u double, {kind}").orderBy("_u", *columns).first()
    found = np.array([first[1:]]) - origin
    n = points.count()
    for step in range(1, steps + 1):
        if step == 1:
            total = squares + n * float((found ** 2).sum())
        else:
            def costs(batches: Iterator, c=found) -> Iterator:
                yield rows([[float(sum(cost(x - origin[:, None], c).sum() for x in _points(batches)))]], ["cost"])
            total = points.mapInArrow(costs, "cost double").agg(F.sum("cost")).first()[0]
        if not total > 0:
            break

        def drawn(batches: Iterator, c=found, step=step, total=total) -> Iterator:
            draws = generator(step)
            for x in _points(batches):
                keep = draws.random(x.shape[1]) * total < 2.0 * k * cost(x - origin[:, None], c)
                yield rows(x[:, keep], columns)
        more = points.mapInArrow(drawn, kind).collect()     # about 2 k rows
        if more:
            found = np.unique(np.concatenate([found, np.array([tuple(r) for r in more]) - origin]), axis=0)
    held_by = _tallies(points, [found], origin)
    return found, np.array([held_by.get((0, i), (0,))[0] for i in range(len(found))], dtype=float)


def _start(candidates, weights, k: int, seed: int, tries: int = 10, rounds: int = 30):
    """k-means++ and Lloyd's steps over the few weighted candidates, the best
    of ``tries``; with no more candidates than ``k``, these."""
    import numpy as np
    if len(candidates) <= k:
        return candidates
    draws, best = np.random.default_rng([seed % (1 << 32), k]), None
    apart = lambda c: ((candidates[:, None] - c[None]) ** 2).sum(axis=2)
    for _ in range(tries):
        c = candidates[[draws.choice(len(candidates), p=weights / weights.sum())]]
        while len(c) < k:
            p = weights * apart(c).min(axis=1)
            if not p.sum() > 0:
                break
            c = np.concatenate([c, candidates[[draws.choice(len(candidates), p=p / p.sum())]]])
        for _ in range(rounds):
            near = apart(c).argmin(axis=1)
            new = np.array([np.average(candidates[near == j], axis=0, weights=weights[near == j])
                            if weights[near == j].sum() > 0 else c[j] for j in range(len(c))])
            if np.array_equal(new, c):
                break
            c = new
        loss = float((weights * apart(c).min(axis=1)).sum())
        if best is None or loss < best[0]:
            best = (loss, c)
    return best[1]


def kmeans_clusters(df: DataFrame, columns: list[str], ks: list[int], seed: int = 1,
                    max_iter: int = 20, tol: float = 1e-4) -> DataFrame:
    """L3/L4: (k, cluster, n, centre, within) for each k and cluster: the rows
    that the fit assigns to it, their mean, and their sum of squared distances
    to it. All k are fitted together over one held frame: the candidates of one
    k-means|| start, for the largest k, serve every k, and a pass makes a
    Lloyd step of each k whose centres still move by more than ``tol``. So the
    passes do not grow with the number of k. k = 1 needs no fit. Rows with a
    null in a column do not count; k must be positive. No rows: no clusters."""
    import numpy as np
    spark = df.sparkSession
    schema = "k int, cluster int, n bigint, centre array<double>, within double"
    if min(ks, default=1) < 1:
        raise ValueError("k must be positive")
    clean = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).na.drop()
    with held(clean, spread=True) as points:
        whole = points.agg(F.count(F.lit(1)).alias("n"), *[F.avg(c) for c in columns],
                           *[F.var_pop(c) for c in columns]).first()       # fills the cache
        n, d = whole["n"], len(columns)
        if not n:
            return spark.createDataFrame([], schema)
        origin, squares = np.array(whole[1:1 + d]), float(sum(whole[1 + d:]) * n)
        found = {1: [(1, 0, n, origin.tolist(), squares)]}
        fits = sorted({int(k) for k in ks} - {1})
        if fits:
            candidates, weights = _candidates(points, fits[-1], origin, squares, seed)
            centres = {k: _start(candidates, weights, k, seed) for k in fits}
            moving = list(fits)
            for _ in range(max_iter):
                if not moving:
                    break
                got = _tallies(points, [centres[k] for k in moving], origin)
                still = []
                for i, k in enumerate(moving):
                    new = centres[k].copy()
                    for j in range(len(new)):
                        if (i, j) in got and got[i, j][0]:
                            new[j] = np.array(got[i, j][1]) / got[i, j][0]
                    if ((new - centres[k]) ** 2).sum(axis=1).max() > tol * tol:
                        still.append(k)
                    centres[k] = new
                moving = still
            got = _tallies(points, [centres[k] for k in fits], origin, squares=True)
            for i, k in enumerate(fits):
                found[k] = []
                for j, c in enumerate(centres[k]):
                    many, sums, within = got.get((i, j), (0, None, None))
                    if many:
                        off = np.array(sums) / many
                        found[k].append((k, j, many, (origin + c + off).tolist(),
                                         max(0.0, float(within - many * (off @ off)))))
    return spark.createDataFrame([r for k in sorted(ks) for r in found[int(k)]], schema)


def kmeans_elbow(df: DataFrame, columns: list[str], ks: list[int], seed: int = 1,
                 max_iter: int = 20) -> DataFrame:
    """For each k the within-cluster sum of squares (WSS), the total
    (TSS), that between the centres (from centres and sizes alone), and the
    share of variance explained, 100 * (TSS - WSS) / TSS. The
    rows are those of ``kmeans_clusters``, a few dozen."""
    found = kmeans_clusters(df, columns, ks, seed, max_iter).collect()
    rows = []
    for k in ks:
        own = [r for r in found if r.k == k]
        n = sum(r.n for r in own)
        if not n:
            continue
        wss = float(sum(r.within for r in own))
        mean = [sum(r.n * r.centre[i] for r in own) / n for i in range(len(columns))]
        between = float(sum(r.n * sum((x - m) ** 2 for x, m in zip(r.centre, mean)) for r in own))
        rows.append((int(k), n, wss, between))
    total = [float(r.within) for r in found if r.k == 1]
    if rows and not total:
        total = [total_sum_squares(df.select(*columns).na.drop(), columns)]
    rows = [(k, n, wss, between, total[0], 100.0 * (total[0] - wss) / total[0] if total[0] else None)
            for k, n, wss, between in rows]
    return df.sparkSession.createDataFrame(
        rows, "k int, n bigint, wss double, between double, tss double, r2_pct double")


def cluster_profile(df: DataFrame, cluster: str, columns: list[str],
                    digits: int = 4) -> DataFrame:
    """Each cluster described on the original variables."""
    aggs = [F.count(F.lit(1)).alias("n")]
    for c in columns:
        aggs += [F.round(F.avg(c), digits).alias(f"{c}_mean"),
                 F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max")]
    return df.groupBy(cluster).agg(*aggs)


# --- PCA -------------------------------------------------------------------------

def pca_explained(df: DataFrame, columns: list[str], k: int | None = None,
                  digits: int = 6) -> DataFrame:
    """Per component: explained-variance ratio, cumulative ratio,
    eigenvalue of the sample covariance of the standardised columns, and
    the singular value sqrt(eigenvalue * (n - 1)). Each standardised
    non-constant column has sample variance 1, so the covariance trace is
    their number and no extra pass is needed."""
    k = k or len(columns)
    clean = df.select(*columns).na.drop()
    mom = column_moments(clean, columns, ddof=1)
    n = mom["n"]
    trace = float(sum(1 for c in columns if mom["sd"][c]))
    scaled = standardize(clean, columns, ddof=1, keep=[], moments=mom)
    with held(assemble(scaled, columns).select("features")) as feats:
        model = PCA(k=k, inputCol="features", outputCol="pcs").fit(feats)
    rows, cum = [], 0.0
    for j, r in enumerate(model.explainedVariance.toArray()):
        cum += float(r)
        eig = float(r) * trace
        rows.append((j + 1, round(float(r), digits), round(cum, digits), round(eig, digits),
                     round(math.sqrt(max(eig, 0.0) * (n - 1)), 4)))
    return df.sparkSession.createDataFrame(
        rows, "component int, ratio double, cumulative double, eigenvalue double, singular_value double")


def _component_signs(pc) -> list[float]:
    """One sign per component, so that the loading largest in size is positive;
    of loadings equal in size (to 1e-9) the first column's decides, so rounding
    in another partitioning cannot turn a component round."""
    signs = []
    for j in range(pc.shape[1]):
        size = abs(pc[:, j])
        first = next(i for i in range(len(size)) if size[i] >= size.max() - 1e-9)
        signs.append(-1.0 if pc[first, j] < 0 else 1.0)
    return signs


def _pca_scored(df: DataFrame, columns: list[str], keep: list[str], k: int):
    """(loadings with fixed signs, rows with ``keep`` and an array ``_s`` of
    their ``k`` scores)."""
    scaled = standardize(df.select(*keep, *columns).na.drop(subset=columns), columns, ddof=1, keep=keep)
    feats = assemble(scaled, columns)
    model = PCA(k=k, inputCol="features", outputCol="pcs").fit(feats)
    pc = model.pc.toArray()
    signs = _component_signs(pc)
    arr = vector_to_array(F.col("pcs"))
    rows = model.transform(feats).select(*keep, F.array(*[arr[j] * F.lit(signs[j]) for j in range(k)]).alias("_s"))
    return pc * signs, rows


def pca_scores(df: DataFrame, columns: list[str], keep: list[str], k: int | None = None,
               digits: int = 4) -> DataFrame:
    """The scores of all rows on the first ``k`` components, ``pc1``,
    ``pc2``, ..., signs fixed. Rows with a null in ``columns`` have none."""
    k = k or len(columns)
    _, rows = _pca_scored(df, columns, keep, k)
    return rows.select(*keep, *[F.round(F.col("_s")[j], digits).alias(f"pc{j + 1}") for j in range(k)])


def pca_biplot(df: DataFrame, columns: list[str], key: list[str], sample_fraction: float = 0.1,
               seed: int = 1, digits: int = 4) -> DataFrame:
    """Data for a biplot of the first two components: the scores of a
    hash-sampled set of rows (``point``) and each variable's loadings scaled
    by the largest score on each axis (``arrow``), signs fixed."""
    from tablewright.operators.sampling import bernoulli_sample
    pc, rows = _pca_scored(df, columns, key, 2)
    scores = rows.select(*key, F.col("_s")[0].alias("x"), F.col("_s")[1].alias("y"))
    with held(scores) as scores:
        mx = scores.agg(F.max("x").alias("mx"), F.max("y").alias("my")).collect()[0]
        arrows = df.sparkSession.createDataFrame(
            [("arrow", c, round(float(pc[i, 0] * mx["mx"]), digits),
              round(float(pc[i, 1] * mx["my"]), digits)) for i, c in enumerate(columns)],
            "kind string, name string, x double, y double")
    pts = (bernoulli_sample(scores, key, sample_fraction, seed)
           .select(F.lit("point").alias("kind"), F.concat_ws("-", *key).alias("name"),
                   F.round("x", digits).alias("x"), F.round("y", digits).alias("y")))
    return arrows.unionByName(pts)


# --- linear and generalised linear models ----------------------------------------

def _coef_table(spark, names, coefs, intercept, se=None, tv=None, pv=None):
    """Model-sized table (one row per term); Spark's summaries list the
    intercept last."""
    rows = []
    terms = list(names) + ["(intercept)"]
    est = list(coefs) + [intercept]
    for i, t in enumerate(terms):
        rows.append((t, float(est[i]),
                     None if se is None else float(se[i]),
                     None if tv is None else float(tv[i]),
                     None if pv is None else float(pv[i])))
    return spark.createDataFrame(
        rows, "term string, estimate double, std_error double, t_value double, p_value double")


def linreg_fit(df: DataFrame, features: list[str], label: str, reg: float = 0.0,
               elastic: float = 0.0):
    """Least squares (normal equations, so the summary has standard
    errors, t and p values)."""
    feats = assemble(df.select(label, *features).na.drop(), features)
    lr = LinearRegression(featuresCol="features", labelCol=label, solver="normal",
                          regParam=reg, elasticNetParam=elastic)
    return lr.fit(feats)


def linreg_coefficients(df: DataFrame, features: list[str], label: str) -> DataFrame:
    """The coefficient table: estimate, standard error, t, p. One scan:
    all of it follows from the moments of label and features."""
    columns = [label, *features]
    fit = SS.least_squares(SS.read_moments(SS.moments(df, columns), columns)[None], features, label)
    return df.sparkSession.createDataFrame(
        fit.table(), "term string, estimate double, std_error double, t_value double, p_value double")


def predict(model, df: DataFrame, features: list[str], out: str = "prediction") -> DataFrame:
    """Score new rows with a fitted model (a narrow transform)."""
    return model.transform(assemble(df, features)).withColumnRenamed(
        model.getPredictionCol(), out).drop("features")


def glm_fit(df: DataFrame, features: list[str], label: str, family: str = "gaussian",
            link: str | None = None, max_iter: int = 25, reg: float = 0.0):
    """Generalised linear model by IRLS."""
    feats = assemble(df.select(label, *features).na.drop(), features)
    kw = dict(family=family, featuresCol="features", labelCol=label, maxIter=max_iter,
              regParam=reg)
    if link:
        kw["link"] = link
    return GeneralizedLinearRegression(**kw).fit(feats)


def glm_table(df: DataFrame, features: list[str], label: str, family: str = "gaussian",
              link: str | None = None) -> DataFrame:
    """Coefficients with standard errors, t/z and p values, plus
    fit rows: deviance, null deviance, their ratio and AIC."""
    with held(df.select(label, *features)) as d:
        m = glm_fit(d, features, label, family, link)
        s = m.summary
        se, tv, pv = s.coefficientStandardErrors, s.tValues, s.pValues
        dev, null_dev, aic = float(s.deviance), float(s.nullDeviance), float(s.aic)
    coef = _coef_table(df.sparkSession, features, m.coefficients.toArray(), m.intercept,
                       se, tv, pv)
    fit = df.sparkSession.createDataFrame(
        [("deviance", dev),
         ("null_deviance", null_dev),
         ("deviance_ratio", dev / null_dev if null_dev else None),
         ("aic", aic)],
        "term string, estimate double")
    return coef.unionByName(fit, allowMissingColumns=True)


def logistic_fit(df: DataFrame, features: list[str], label: str, reg: float = 0.0,
                 max_iter: int = 100):
    """Logistic regression (L-BFGS on partial gradients per task)."""
    from pyspark.ml.classification import LogisticRegression
    with held(assemble(df.select(label, *features).na.drop(), features), spread=True) as feats:
        return LogisticRegression(featuresCol="features", labelCol=label, regParam=reg,
                                  maxIter=max_iter).fit(feats)


def predict_probability(model, df: DataFrame, features: list[str],
                        out: str = "probability") -> DataFrame:
    """The fitted probability of class 1 as a double column (the
    response scale, not the log-odds)."""
    scored = model.transform(assemble(df, features))
    return scored.withColumn(out, vector_to_array(F.col("probability"))[1]).drop(
        "features", "rawPrediction", "probability", "prediction")


def regularization_sweep(train: DataFrame, valid: DataFrame, features: list[str],
                         label: str, regs: list[float], elastic: float = 0.0) -> DataFrame:
    """Fit on the training part for each regularisation strength and
    score the validation part (RMSE, R2), from one aggregate over both.
    Parts of one table that a column tells apart: ``sufficient.sweep``."""
    parts = [d.select(F.lit(name).alias("_part"), label, *features) for name, d in (("t", train), ("v", valid))]
    return SS.sweep(parts[0].unionByName(parts[1]), "_part", "t", "v", features, label, regs, elastic)


def logistic_sweep(train: DataFrame, valid: DataFrame, features: list[str], label: str,
                   regs: list[float], max_iter: int = 100) -> DataFrame:
    """L21 for logistic regression: fit on the training part for each strength,
    area under the ROC curve on the validation part."""
    from pyspark.ml.classification import LogisticRegression
    from tablewright.operators.metrics import roc_auc
    rows = []
    with (held(assemble(train.select(label, *features).na.drop(), features)) as tr,
          held(valid.select(label, *features).na.drop()) as va):
        for r in regs:
            m = LogisticRegression(featuresCol="features", labelCol=label, regParam=r,
                                   maxIter=max_iter).fit(tr)
            auc = roc_auc(predict_probability(m, va, features, "p1"), label, "p1").collect()[0]
            rows.append((float(r), auc["n_pos"], auc["n_neg"], auc["auc"]))
    return train.sparkSession.createDataFrame(
        rows, "reg_param double, n_pos bigint, n_neg bigint, auc double")
