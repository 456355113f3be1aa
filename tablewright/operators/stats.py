"""Table shape, column and group statistics.

Aggregates are plain ``groupBy().agg()``: Spark computes partial aggregates
map-side and shuffles one small buffer per group and task, so a hot group
costs no more than a cold one. Several columns' statistics are computed in
one pass by unpivoting to (column, x) and grouping by the column name.
Exact quantiles go through ``order_stats`` (never a value map of a whole
column in one task); ``percentile_approx`` keeps its bounded sketch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.columns import ratio, safe_corr
from tablewright.operators.clean import unpivot_numeric
from tablewright.operators.order_stats import exact_column_quantiles, exact_quantiles

APPROX_ACCURACY = 10_000   # Spark's default: rank error at most n / 10,000, a small sketch


# --- shape -------------------------------------------------------------------

def table_shape(df: DataFrame) -> DataFrame:
    """One row (n_rows, n_cols)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.lit(len(df.columns)).cast("bigint").alias("n_cols"))


def schema_profile(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type and non-null count. The
    counts come from one aggregate over the table."""
    counts = df.agg(*[F.count(F.col(c)).alias(f"_nn{i}") for i, c in enumerate(df.columns)])
    rows = [F.struct(F.lit(i).alias("position"), F.lit(c).alias("column_name"),
                     F.lit(t).alias("data_type"), F.col(f"_nn{i}").alias("non_null"))
            for i, (c, t) in enumerate(df.dtypes)]
    return counts.select(F.inline(F.array(*rows)))


def head_rows(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """The first ``n`` rows by ``order`` (a top-n; bounded ``n``).
    Spark plans ``TakeOrderedAndProject``: each task keeps its own top n."""
    return df.orderBy(*order).limit(n)


# --- distinct counts, mean, medians -----------------------------------------

def distinct_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """A2/A3: distinct values per column, all in one aggregate."""
    return df.agg(*[F.count_distinct(F.col(c)).alias(c) for c in columns])


def mean_and_medians(df: DataFrame, column: str,
                     accuracy: int = APPROX_ACCURACY) -> DataFrame:
    """A4-A7 on one column, one row: mean; the exact median that is a data
    value (``approxQuantile(c,[.5],0)``); ``percentile_approx`` with an
    explicit accuracy; the exact interpolated median. The two exact medians
    are single numbers from ``order_stats`` and join the one-row aggregate
    as literals."""
    med = {r["kind"]: r["q"] for r in
           exact_quantiles(df, column, [0.5, 0.5], kind=["disc", "cont"]).collect()}
    return df.agg(F.avg(column).alias("mean_value"),
                  F.lit(med.get("disc")).cast("double").alias("median_exact"),
                  F.percentile_approx(column, F.lit(0.5), accuracy).cast("double")
                  .alias("median_approx"),
                  F.lit(med.get("cont")).cast("double").alias("median_interp"))


# --- grouped statistics --------------------------------------------------------

def group_stats(df: DataFrame, by: str, column: str, accuracy: int = APPROX_ACCURACY,
                digits: int = 4, var_digits: int = 2) -> DataFrame:
    """Per group: count, mean, approximate median, sample variance
    (null for a one-row group)."""
    return df.groupBy(by).agg(
        F.count(F.col(by)).alias("num_cases"),
        F.round(F.avg(column), digits).alias("mean_score"),
        F.percentile_approx(column, F.lit(0.5), accuracy).cast("double").alias("median_score"),
        F.round(F.var_samp(column), var_digits).alias("variance_score"))


def group_stats_exact(df: DataFrame, by: str, column: str, digits: int = 4,
                      var_digits: int = 2) -> DataFrame:
    """A8 with A7 per group: count, mean, exact interpolated median and
    sample variance per group. The median comes from ``order_stats`` (never
    one group's rows in one task beyond a checked size); the two per-group
    tables are joined on the key."""
    agg = df.groupBy(by).agg(
        F.count(F.col(by)).alias("num_cases"),
        F.round(F.avg(column), digits).alias("mean_score"),
        F.round(F.var_samp(column), var_digits).alias("variance_score"))
    med = exact_quantiles(df, column, [0.5], by=[by]).select(
        by, F.round("q", digits).alias("median_score"))
    return agg.join(med, by, "left")


def group_counts(df: DataFrame, by: str, name: str = "count") -> DataFrame:
    """Rows per group."""
    return df.groupBy(by).agg(F.count(F.lit(1)).alias(name))


def most_dispersed(df: DataFrame, by: str, column: str, digits: int = 2) -> DataFrame:
    """The group with the largest sample variance (ties by name): a
    top-1 over the per-group table, which has one row per group."""
    per = df.groupBy(by).agg(F.round(F.var_samp(column), digits).alias("variance_score"))
    return (per.filter(F.col("variance_score").isNotNull())
            .orderBy(F.desc("variance_score"), F.asc(by)).limit(1))


# --- column summaries ---------------------------------------------------------

def column_stats(df: DataFrame, columns: list[str], stats: dict) -> DataFrame:
    """Per-column statistics in long form (one row per column), computed
    side by side in one aggregate over the original rows. ``stats`` maps an
    output name to a function from column to aggregate expression. Text that
    is no number counts as null (``describe_mixed`` keeps text)."""
    agg = df.agg(*[fn(F.col(c).try_cast("double")).alias(f"_{j}_{i}")
                   for i, c in enumerate(columns) for j, fn in enumerate(stats.values())])
    rows = [F.struct(F.lit(c).alias("column"),
                     *[F.col(f"_{j}_{i}").alias(name) for j, name in enumerate(stats)])
            for i, c in enumerate(columns)]
    return agg.select(F.inline(F.array(*rows)))


def describe_columns(df: DataFrame, columns: list[str], digits: int = 4) -> DataFrame:
    """Per column: count, mean, sample sd, min, max (typed, long form)."""
    return column_stats(df, columns, {
        "count": F.count,
        "mean": lambda x: F.round(F.avg(x), digits),
        "stddev": lambda x: F.round(F.stddev_samp(x), digits),
        "min": F.min,
        "max": F.max})


def _quantile_columns(df: DataFrame, columns: list[str], probs: list[float],
                      names: list[str], digits: int) -> DataFrame:
    q = exact_column_quantiles(df, columns, probs)
    return q.groupBy("column").agg(*[
        F.round(F.max(F.when(F.col("p") == F.lit(p), F.col("q"))), digits).alias(n)
        for p, n in zip(probs, names)])


def summary_quartiles(df: DataFrame, columns: list[str], digits: int = 4) -> DataFrame:
    """``describe`` plus exact interpolated quartiles."""
    qs = _quantile_columns(df, columns, [0.25, 0.5, 0.75], ["q25", "q50", "q75"], digits)
    return describe_columns(df, columns, digits).join(qs, "column", "inner")


def column_profile(df: DataFrame, columns: list[str], digits: int = 4) -> DataFrame:
    """Per column min, max, mean and exact median."""
    base = column_stats(df, columns, {
        "min": F.min, "max": F.max, "mean": lambda x: F.round(F.avg(x), digits)})
    return base.join(_quantile_columns(df, columns, [0.5], ["median"], digits), "column", "inner")


def describe_mixed(df: DataFrame, columns: list[str] | None = None,
                   digits: int = 4) -> DataFrame:
    """A12 on columns of any type, as ``DataFrame.describe`` prints them: count
    of non-null values, mean and sample sd (null for text), smallest and
    largest value as text (text compares by code point)."""
    columns = columns or df.columns
    numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)}
    aggs = []
    for i, c in enumerate(columns):
        num = c in numeric
        x = F.col(c).cast("double") if num else F.lit(None).cast("double")
        v = F.col(c).cast("double") if num else F.col(c).cast("string")
        aggs += [F.count(c).alias(f"_n{i}"), F.round(F.avg(x), digits).alias(f"_m{i}"),
                 F.round(F.stddev_samp(x), digits).alias(f"_s{i}"),
                 F.min(v).cast("string").alias(f"_a{i}"), F.max(v).cast("string").alias(f"_z{i}")]
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"_n{i}").alias("count"),
                     F.col(f"_m{i}").alias("mean"), F.col(f"_s{i}").alias("stddev"),
                     F.col(f"_a{i}").alias("min"), F.col(f"_z{i}").alias("max"))
            for i, c in enumerate(columns)]
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def summary_selected(df: DataFrame, columns: list[str], statistics: list[str],
                     digits: int = 4) -> DataFrame:
    """Chosen statistics only, long form (column, statistic, value).
    Names as in ``DataFrame.summary``: count, mean, stddev, min, max and
    percentiles such as "50%" (exact, interpolated)."""
    long = unpivot_numeric(df, columns)
    simple = {"count": F.count("x").cast("double"), "mean": F.avg("x"),
              "stddev": F.stddev_samp("x"), "min": F.min("x"), "max": F.max("x")}
    wanted = [s for s in statistics if s in simple]
    pcts = [s for s in statistics if s.endswith("%")]
    parts = []
    if wanted:
        agg = long.groupBy("column").agg(*[simple[s].alias(f"_s{i}") for i, s in enumerate(wanted)])
        parts.append(agg.select("column", F.inline(F.array(*[
            F.struct(F.lit(s).alias("statistic"),
                     F.round(F.col(f"_s{i}"), digits).alias("value"))
            for i, s in enumerate(wanted)]))))
    if pcts:
        probs = [float(s[:-1]) / 100 for s in pcts]
        q = exact_column_quantiles(df, columns, probs)
        label = F.lit(None).cast("string")
        for s_, p_ in zip(pcts, probs):     # the caller's own names ("2.5%")
            label = F.when(F.col("p") == F.lit(p_), F.lit(s_)).otherwise(label)
        parts.append(q.select("column", label.alias("statistic"),
                              F.round("q", digits).alias("value")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# --- histograms, correlation, contingency ---------------------------------------

def histogram_equal_width(df: DataFrame, column: str, bins: int) -> DataFrame:
    """``bins`` equal-width bins from min to max; left-closed, the last
    bin closed, empty bins present with count 0. A constant column gives
    one bin holding every row."""
    mm = df.agg(F.min(column).alias("lo"), F.max(column).alias("hi")).collect()[0]
    lo, hi = mm["lo"], mm["hi"]
    spark = df.sparkSession
    if lo is None:
        return spark.createDataFrame([], "bin int, bin_start double, bin_end double, n bigint")
    lo, hi = float(lo), float(hi)
    nb = bins if hi > lo else 1
    width = (hi - lo) / nb if hi > lo else 0.0
    x = F.col(column).cast("double")
    idx = F.when(F.lit(width) > 0, F.least(F.floor(F.try_divide(x - F.lit(lo), F.lit(width))),
                                           F.lit(nb - 1))).otherwise(F.lit(0)).cast("int")
    counts = (df.filter(F.col(column).isNotNull()).select(idx.alias("bin"))
              .groupBy("bin").agg(F.count(F.lit(1)).alias("n")))
    # the bin frame has exactly ``nb`` rows: a bounded side for the join
    frame = spark.range(nb).select(F.col("id").cast("int").alias("bin"))
    frame = frame.select("bin", (F.lit(lo) + F.col("bin") * F.lit(width)).alias("bin_start"),
                         (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("bin_end"))
    return (frame.join(counts, "bin", "left")
            .select("bin", F.round("bin_start", 6).alias("bin_start"),
                    F.round("bin_end", 6).alias("bin_end"),
                    F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n")))


def histogram_fixed_width(df: DataFrame, column: str, width: float) -> DataFrame:
    """A17, fixed bin width: bin = floor(x / width). Every occupied bin is a
    row with its count; a run of empty bins between two of them is one row
    (``bins`` of them, count 0), so two far values do not list millions of
    empty bins. The window runs over the occupied bins, not the rows."""
    x = F.col(column).cast("double")
    counts = (df.filter(x.isNotNull()).select(F.floor(x / F.lit(width)).cast("bigint").alias("bin"))
              .groupBy("bin").agg(F.count(F.lit(1)).alias("n")))
    ahead = F.lead("bin").over(Window.orderBy("bin"))
    one = F.lit(1).cast("bigint")
    rows = counts.withColumn("_next", ahead).select(F.inline(F.filter(F.array(
        F.struct(F.col("bin"), one.alias("bins"), F.col("n")),
        F.struct((F.col("bin") + 1).alias("bin"), (F.col("_next") - F.col("bin") - 1).alias("bins"),
                 F.lit(0).cast("bigint").alias("n"))), lambda r: r["bins"] > 0)))
    return rows.select("bin", "bins", F.round(F.col("bin") * F.lit(width), 6).alias("bin_start"), "n")


def correlations(df: DataFrame, pairs: list[tuple[str, str]], digits: int = 4) -> DataFrame:
    """Pearson correlation per column pair in one aggregate; null for
    a constant column."""
    row = df.agg(*[safe_corr(a, b).alias(f"_r{i}") for i, (a, b) in enumerate(pairs)])
    rows = [F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"),
                     F.round(F.col(f"_r{i}"), digits).alias("corr"))
            for i, (a, b) in enumerate(pairs)]
    return row.select(F.inline(F.array(*rows)))


def contingency(df: DataFrame, a: str, b: str, levels_a: list | None = None,
                levels_b: list | None = None) -> DataFrame:
    """Counts per (a, b). With known levels, every cell is listed (0
    when empty); the level grid is bounded by the given lists."""
    counts = df.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))
    if levels_a is None or levels_b is None:
        return counts
    spark = df.sparkSession
    grid = spark.createDataFrame([(x, y) for x in levels_a for y in levels_b],
                                 [a, b]).select(*[F.col(c).cast(df.schema[c].dataType).alias(c)
                                                  for c in (a, b)])
    return (grid.join(counts, [a, b], "left")
            .select(a, b, F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n")))


def shares(counts: DataFrame, n: str = "n", digits: int = 1) -> DataFrame:
    """Each count as a percentage of the total, rounded. The total is a
    one-row aggregate over the small count table, in the same plan."""
    total = F.sum(n).over(Window.partitionBy(F.lit(0)))
    return (counts.withColumn("_total", total)
            .withColumn("pct", F.round(ratio(F.col(n) * 100.0, F.col("_total")), digits)).drop("_total"))
