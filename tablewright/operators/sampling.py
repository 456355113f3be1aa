"""Samples and train/validation/test splits.

Repeatable forms hash a key with a seed (``hash60``): a row's fate depends
on its key only, not on partitioning or on how many tasks ran, so a rerun
after a lost executor gives the same rows. Exact sizes (an exact 10 %
sample, a cut at exactly 60 % / 80 %) are reached without a global sort:
the cut hash is found by ``order_stats.first_k_condition`` and rows are
then kept by comparison. Nothing here depends on Spark's own sampler.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.functions.columns import bucket100, hash60
from tablewright.operators.order_stats import (
    first_k_condition, first_k_conditions, select_ranks)


def hash_sample(df: DataFrame, key: str, fraction: float | None, seed: int,
                size: int | None = None) -> DataFrame:
    """M1/M3: exactly ``int(fraction * n)`` rows (or exactly ``size`` rows)
    without replacement, the ones with the smallest seeded hash of ``key``
    (ties by key). ``key`` must be numeric and unique per row."""
    n = df.count()
    k = int(size) if size is not None else int(fraction * n)
    h = df.withColumn("_tw_h", hash60(seed, key))
    return h.filter(first_k_condition(h, ["_tw_h", key], k, n=n)).drop("_tw_h")


def bernoulli_sample(df: DataFrame, key: str | list[str], fraction: float, seed: int) -> DataFrame:
    """M2: each row kept with probability ``fraction``: its seeded 60-bit hash
    is below that share of all hashes. The size varies; which rows does not
    depend on partitioning, unlike ``DataFrame.sample``. A narrow filter."""
    keys = [key] if isinstance(key, str) else key
    return df.filter(hash60(seed, *keys) < F.lit(int(fraction * (1 << 60))))


def draw_with_replacement(df: DataFrame, key: str, size: int, seed: int) -> DataFrame:
    """M3 with replacement: exactly ``size`` draws, numbered ``draw`` from 0:
    draw i takes the row whose ``key`` (numeric, unique) has rank
    ``hash(seed, i) mod n + 1``. The wanted ranks are found by
    ``select_ranks``, and their rows by a join with at most ``size`` keys."""
    n = df.count()
    if not n:
        return df.withColumn("draw", F.lit(0).cast("bigint")).limit(0)
    draws = df.sparkSession.range(size).select(
        F.col("id").alias("draw"), (hash60(seed, F.col("id")) % n + 1).alias("rank"))
    ranks = draws.select("rank").distinct().select(
        F.col("rank").cast("bigint").alias("tid"), "rank", F.lit(n).cast("bigint").alias("n"))
    found = select_ranks(df.select(key), key, ranks).select("rank", key)
    return df.join(draws.join(found, "rank"), key).drop("rank")


def split_exact(df: DataFrame, key: str, seed: int, cuts=(0.6, 0.8),
                labels=("train", "validation", "test"), out: str = "part") -> DataFrame:
    """M4: shuffle by a seeded hash and cut at exactly floor(0.6 n) and
    floor(0.8 n) rows. ``key`` numeric and unique."""
    n = df.count()
    h = df.withColumn("_tw_h", hash60(seed, key))
    c1, c2 = first_k_conditions(h, ["_tw_h", key], [int(cuts[0] * n), int(cuts[1] * n)], n=n)
    part = F.when(c1, F.lit(labels[0])).when(c2, F.lit(labels[1])).otherwise(F.lit(labels[2]))
    return h.withColumn(out, part).drop("_tw_h")


def split_bucket(df: DataFrame, keys: list[str], seed: int, weights=(60, 20, 20),
                 labels=("train", "test", "validation"), out: str = "part") -> DataFrame:
    """M6 (and the scalable M5): each row's part from its key's hash bucket
    0..99; bucket < 60 is the first part, < 80 the second, else the third.
    A narrow transform: no shuffle, no count."""
    b = bucket100(seed, *keys)
    w1, w2 = weights[0], weights[0] + weights[1]
    part = F.when(b < w1, F.lit(labels[0])).when(b < w2, F.lit(labels[1])).otherwise(F.lit(labels[2]))
    return df.withColumn(out, part)


def split_random(df: DataFrame, keys: list[str], weights=(0.6, 0.2, 0.2), seed: int = 100,
                 labels=("train", "validation", "test"), out: str = "part") -> DataFrame:
    """M5: parts of about the given weights from one hashed label column: one
    scan, no sort, and the same parts on every run (``randomSplit`` scans and
    sorts once per part)."""
    h = hash60(seed, *keys)
    part, upto = F.lit(labels[-1]), 1.0
    for label, w in reversed(list(zip(labels[:-1], weights[:-1]))):
        upto = sum(weights[:labels.index(label) + 1]) / sum(weights)
        part = F.when(h < F.lit(int(upto * (1 << 60))), F.lit(label)).otherwise(part)
    return df.withColumn(out, part)
