"""Model quality measures.

Each is an ordinary aggregate over (label, prediction) rows; the AUC uses
Spark's own binary-classification metrics without down-sampling, which
sort the distinct scores across tasks and add up per-partition counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.functions.columns import ratio, safe_corr
from tablewright.operators.prefix import running_sums
from tablewright.operators.stats import contingency, shares


def regression_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """L12-L14, one row: n, MSE, RMSE, MAE, R2 = 1 - SSE/SST (null for a
    constant label) and R2 as the squared correlation (caret's default)."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    err2 = (y - p) * (y - p)
    agg = df.agg(F.count(F.lit(1)).alias("n"),
                 F.avg(err2).alias("mse"),
                 F.avg(F.abs(y - p)).alias("mae"),
                 F.sum(err2).alias("sse"),
                 (F.var_pop(y) * F.count(F.lit(1))).alias("sst"),
                 safe_corr(y, p).alias("r"))
    return agg.select(
        "n",
        F.round("mse", 2).alias("mse"),
        F.round(F.sqrt("mse"), 4).alias("rmse"),
        F.round("mae", 4).alias("mae"),
        F.round(F.lit(1.0) - ratio(F.col("sse"), F.col("sst")), 6).alias("r2"),
        F.round(F.col("r") * F.col("r"), 6).alias("r2_corr"))


def classify(df: DataFrame, score: str, threshold: float = 0.5,
             out: str = "prediction") -> DataFrame:
    """Class 1 where the score (a probability) is above the threshold."""
    return df.withColumn(out, F.when(F.col(score) > F.lit(threshold), F.lit(1))
                         .otherwise(F.lit(0)).cast("int"))


def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """The 2x2 table with empty cells as 0, in counts and in
    percent of all rows (rounded to 0.1)."""
    c = contingency(df.select(F.col(label).cast("int").alias(label),
                              F.col(prediction).cast("int").alias(prediction)),
                    label, prediction, [0, 1], [0, 1])
    return shares(c, "n", 1)


def accuracy_precision(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """L18/L19, one row: accuracy = (tp+tn)/n; precision = tp/(tp+fp), null
    when nothing is predicted positive; recall likewise."""
    y, p = F.col(label).cast("int"), F.col(prediction).cast("int")
    agg = df.agg(F.count(F.lit(1)).alias("n"),
                 F.count_if((y == 1) & (p == 1)).alias("tp"),
                 F.count_if((y == 0) & (p == 0)).alias("tn"),
                 F.count_if((y == 0) & (p == 1)).alias("fp"),
                 F.count_if((y == 1) & (p == 0)).alias("fn"))
    return agg.select(
        "n", "tp", "tn", "fp", "fn",
        F.round(ratio(F.col("tp") + F.col("tn"), F.col("n")), 6).alias("accuracy"),
        F.round(ratio(F.col("tp"), F.col("tp") + F.col("fp")), 6).alias("precision"),
        F.round(ratio(F.col("tp"), F.col("tp") + F.col("fn")), 6).alias("recall"))


def roc_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """A point for each distinct score, from the highest: ``score``, the
    true and false positives (``tp``, ``fp``) where it is the threshold, and
    their rates, null for a class without rows. Running sums over range
    partitions: as many distinct scores as rows are no load on one task."""
    y = F.col(label).cast("int")
    d = df.select(F.col(score).cast("double").alias("score"), y.alias("_y")).na.drop()
    points = d.groupBy("score").agg(F.count_if(F.col("_y") == 1).alias("_pos"), F.count_if(F.col("_y") == 0).alias("_neg"))
    sums = running_sums(points, [F.col("score").desc()], {"tp": "_pos", "fp": "_neg"})
    last = sums.agg(F.max("tp").alias("p"), F.max("fp").alias("n")).first()
    p, n = (F.lit(v or 0).cast("long") for v in last)
    return sums.select("score", "tp", "fp", ratio(F.col("tp"), p).alias("tpr"), ratio(F.col("fp"), n).alias("fpr"))


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Area under the ROC curve, ties counted half (the rank-sum
    statistic), as one row. Null when only one class is present."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    d = df.select(F.col(score).cast("double").alias("_s"),
                  F.col(label).cast("double").alias("_y")).na.drop()
    counts = d.agg(F.count_if(F.col("_y") == 1).alias("pos"),
                   F.count_if(F.col("_y") == 0).alias("neg")).collect()[0]
    spark = df.sparkSession
    if counts["pos"] == 0 or counts["neg"] == 0:
        auc = None
    else:
        ev = BinaryClassificationEvaluator(rawPredictionCol="_s", labelCol="_y",
                                           metricName="areaUnderROC", numBins=0)
        auc = round(float(ev.evaluate(d)), 6)
    return spark.createDataFrame([(counts["pos"], counts["neg"], auc)],
                                 "n_pos bigint, n_neg bigint, auc double")
