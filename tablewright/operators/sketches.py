"""Quantiles and distinct counts from stored, mergeable sketches.

One pass makes a row of sketches for each group of a fine key (state and date,
say) and stores them as a table. Answers for any coarser group come from
merging those rows; the data are not read again, and a new date's rows are one
more part of the table (``unionByName``). A sketch's size is bounded by its
parameter and not by the rows, and Spark aggregates it in part before the
shuffle, so a group with a third of all rows is no hot task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.sources.files import write_table

#: Size of a quantile sketch and logarithm of the registers of a count sketch.
KLL_K = 800
HLL_LG_K = 12


def rank_error(k: int = KLL_K) -> float:
    """The share of rows by which the rank of one estimated quantile may be
    off, at 99 % confidence (the published fit for this sketch)."""
    return 2.296 / k ** 0.9723


def count_error(lg_k: int = HLL_LG_K) -> float:
    """Standard error of an estimated distinct count, as a share of it."""
    return 1.04 / 2 ** (lg_k / 2)


def sketch_table(df: DataFrame, by: Sequence[str], value: str, distinct: str,
                 k: int = KLL_K, lg_k: int = HLL_LG_K) -> DataFrame:
    """A stored row for each group of ``by`` (nulls are one): ``n`` (values that
    are not null), ``ranks`` (quantile sketch of ``value``) and ``ids`` (count
    sketch of ``distinct``; nulls are not counted). No rows give none."""
    made = df.groupBy(*by).agg(
        F.count(value).alias("n"), F.kll_sketch_agg_double(F.col(value).cast("double"), k).alias("ranks"),
        F.hll_sketch_agg(distinct, lg_k).alias("ids"))
    return write_table(made, "sketches")


def merge_sketches(table: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows of ``sketch_table``, or of several in one, merged to the groups
    of ``by``; without ``by`` to one row. Merging draws at random, within the
    bound: store the estimates before reading them twice."""
    return table.groupBy(*by).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("ranks").alias("ranks"),
                                  F.hll_union_agg("ids").alias("ids"))


def quantile_estimates(merged: DataFrame, by: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """A row for each group and probability: ``n``, ``p``, ``quantile`` (a
    value of the group; null without values) and ``n_distinct``."""
    at = F.array(*[F.lit(float(p)) for p in probabilities])
    found = F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("ranks", at))
    each = merged.select(*by, "n", F.hll_sketch_estimate("ids").alias("n_distinct"),
                         F.posexplode_outer(F.coalesce(F.arrays_zip(at.alias("p"), found.alias("q")),
                                                       F.transform(at, lambda p: F.struct(p.alias("p"), F.lit(None).cast("double").alias("q"))))))
    return each.select(*by, "n", F.col("col.p").alias("p"), F.col("col.q").alias("quantile"), "n_distinct")


def quantile_errors(df: DataFrame, estimates: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """``estimates`` with ``rank_off``: by what share of the group's rows each
    quantile misses its rank, counted over the rows themselves. A value that
    many rows share holds all ranks from those below it to those up to it.
    ``by`` names at least one column."""
    if not by:
        raise ValueError("by names no column")
    keyed = estimates.select(*[F.col(c).alias(f"_by_{c}") for c in by], "p", "quantile")
    same = F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    v = F.col(value)
    counted = (df.where(v.isNotNull()).join(keyed, same).groupBy(*by, "p")
               .agg(F.count(F.lit(1)).alias("_n"), F.count_if(v < F.col("quantile")).alias("_below"),
                    F.count_if(v <= F.col("quantile")).alias("_upto")))
    off = F.greatest(F.col("_below") / F.col("_n") - F.col("_p"), F.col("_p") - F.col("_upto") / F.col("_n"), F.lit(0.0))
    counts = counted.withColumnsRenamed({c: f"_by_{c}" for c in by} | {"p": "_p"})
    met = F.col("p") == F.col("_p")
    for c in by:
        met = met & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    return estimates.join(counts, met, "left").select(*estimates.columns, off.alias("rank_off"))
