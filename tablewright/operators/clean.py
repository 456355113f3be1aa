"""Projections and cleaning.

All are narrow transforms (no shuffle) except where a statistic of the
whole column is needed: the IQR fence and the median label first compute
that statistic with the exact order-statistic operator, bring back a
handful of numbers (one pair per column), and then apply a plain filter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.functions.columns import field_at, to_number
from tablewright.operators.order_stats import exact_column_quantiles


# --- projections -----------------------------------------------------------

def split_fields(df: DataFrame, fields: dict[str, int], line: str = "value",
                 sep: str = "\t", keep_line: bool = False) -> DataFrame:
    """P1 (+P2): lift fields of a delimited line to named columns in one
    ``select``; a missing field is null. The line column is dropped unless
    ``keep_line``."""
    keep = [c for c in df.columns if c != line or keep_line]
    return df.select(*keep, *[field_at(line, sep, i).alias(name)
                              for name, i in fields.items()])


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns by name."""
    return df.drop(*names)


def keep_columns(df: DataFrame, *names: str) -> DataFrame:
    """Keep named columns."""
    return df.select(*names)


def keep_positions(df: DataFrame, positions: list[int], drop: bool = False) -> DataFrame:
    """Keep (or, with ``drop``, remove) columns by 0-based position."""
    cols = df.columns
    chosen = [c for i, c in enumerate(cols) if (i in positions) != drop]
    return df.select(*chosen)


def rename_all(df: DataFrame, names: list[str]) -> DataFrame:
    """P5: rename every column at once (names taken from another frame)."""
    return df.toDF(*names)


def cast_number(df: DataFrame, column: str, kind: str = "double",
                alias: str | None = None) -> DataFrame:
    """Text to number. ``kind="decimal(10,0)"`` is what ``numeric``
    means (fractions rounded away); ``"double"`` keeps them. Bad text gives
    null rather than an ANSI error."""
    return df.withColumn(alias or column, to_number(column, kind))


def split_to_array(df: DataFrame, line: str = "value", sep: str = "\t",
                   alias: str = "tokens") -> DataFrame:
    """A delimited line as an array of strings."""
    return df.select("*", F.split(F.col(line), sep).alias(alias))


def token_vocabulary(df: DataFrame, tokens: str = "tokens") -> DataFrame:
    """The distinct tokens over all arrays, as a distributed distinct
    (never collected)."""
    return df.select(F.explode(F.col(tokens)).alias("token")).distinct()


def token_flags(df: DataFrame, vocabulary: list[str], tokens: str = "tokens",
                keep: list[str] | None = None) -> DataFrame:
    """P9 for a vocabulary that the caller knows: one boolean column per
    token: is it in the row's array."""
    keep = keep if keep is not None else [c for c in df.columns if c != tokens]
    return df.select(*keep, *[F.array_contains(F.col(tokens), F.lit(t)).alias(t)
                              for t in vocabulary])


def token_flags_sparse(df: DataFrame, keep: list[str], tokens: str = "tokens") -> DataFrame:
    """P9 over the whole vocabulary, in sparse long form: ``keep``, ``token``,
    ``present``: one row for every token that a row holds. A flag that is not
    listed is false. No vocabulary reaches the driver and no column is made
    per token, however many there are; a narrow transform."""
    return (df.select(*keep, F.explode(F.array_distinct(tokens)).alias("token"))
            .withColumn("present", F.lit(True)))


def checked_fields(df: DataFrame, places: dict[str, int], kinds: dict[str, str] | None = None,
                   line: str = "value", sep: str = "\t") -> DataFrame:
    """P1 and P6 with the faults named: the line, its fields at ``places`` (cast
    to ``kinds`` where given) and ``reason``: null for a good line, ``fields``
    for one too short or null, else the first column whose text is not of its
    kind. Empty text is null and no fault. A narrow transform: filter on
    ``reason`` for the good rows and for the rejected lines."""
    parts = F.split(F.col(line), sep, -1)
    reason = F.when(F.coalesce(F.size(parts), F.lit(0)) <= max(places.values()), F.lit("fields"))
    fields = []
    for name, i in places.items():
        text = F.nullif(F.get(parts, F.lit(i)), F.lit(""))
        kind = (kinds or {}).get(name)
        if kind:
            reason = reason.when(text.isNotNull() & text.try_cast(kind).isNull(), F.lit(f"{name}: not {kind}"))
            text = text.try_cast(kind)
        fields.append(text.alias(name))
    return df.select(line, *fields, reason.alias("reason"))


# --- filters ---------------------------------------------------------------

def drop_header_rows(df: DataFrame, column: str, header_value: str) -> DataFrame:
    """remove header lines read as data. As with ``!=`` in the original,
    a null in ``column`` is dropped too."""
    return df.filter(F.col(column) != F.lit(header_value))


def drop_nulls(df: DataFrame, how: str = "any", subset: list[str] | None = None) -> DataFrame:
    """F2 (``how="any"``) / F3 (``how="all"``). Blank strings are not null."""
    return df.na.drop(how=how, subset=subset)


def drop_sentinel(df: DataFrame, column: str, sentinel: str = "Not Available") -> DataFrame:
    """drop rows carrying a placeholder text."""
    return df.filter(F.col(column) != F.lit(sentinel))


def above(df: DataFrame, column: str, threshold) -> DataFrame:
    """keep rows strictly above a number (pushed to the scan when the
    number is a literal)."""
    return df.filter(F.col(column) > F.lit(threshold))


def clean_cases(cases: DataFrame, kind: str = "double") -> DataFrame:
    """F2, F4, P3, P6 on the case table: drop nulls, drop the sentinel, cast
    the score. Output: hospital, state, measure_name, measure_id,
    comparison, score."""
    d = drop_nulls(cases, "any")
    d = drop_sentinel(d, "comparison")
    return d.select("hospital", "state", "measure_name", "measure_id", "comparison",
                    to_number("score_text", kind).alias("score"))


# --- whole-column statistics used as filters --------------------------------

def column_quantiles(df: DataFrame, columns: list[str], probs: list[float],
                     kind: str = "cont") -> DataFrame:
    """Exact quantiles of several numeric columns (long form: column, p,
    kind, q), computed together (see ``exact_column_quantiles``)."""
    return exact_column_quantiles(df, columns, probs, kind=kind)


def unpivot_numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, x) rows, x as double: several columns' statistics then become
    one grouped aggregate instead of one pass per column."""
    return df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [], columns, "column", "x")


def iqr_bounds(df: DataFrame, columns: list[str], k: float = 1.5) -> dict[str, tuple]:
    """Per column: (q25 - k*IQR, q75 + k*IQR) from exact interpolated
    quartiles, nulls skipped. Two numbers per column reach the driver."""
    q = column_quantiles(df, columns, [0.25, 0.75]).collect()
    by = {}
    for r in q:
        by.setdefault(r["column"], {})[r["p"]] = r["q"]
    out = {}
    for c in columns:
        q25, q75 = by.get(c, {}).get(0.25), by.get(c, {}).get(0.75)
        if q25 is None or q75 is None:
            out[c] = (None, None)
        else:
            iqr = q75 - q25
            out[c] = (q25 - k * iqr, q75 + k * iqr)
    return out


def fence_expr(column: str, low, high) -> Column:
    """The value if inside [low, high] (bounds kept), else null."""
    c = F.col(column)
    if low is None:
        return c
    return F.when((c >= F.lit(low)) & (c <= F.lit(high)), c)


def iqr_fence(df: DataFrame, columns: list[str], k: float = 1.5,
              drop: bool = True) -> DataFrame:
    """Values outside [q25 - k*IQR, q75 + k*IQR] become null, each
    column fenced by its own original values; then (``drop``) rows with a
    null in those columns are removed. One function from column to column
    expression applied to every column in a single ``select``."""
    bounds = iqr_bounds(df, columns, k)
    fenced = df.select(*[fence_expr(c, *bounds[c]).alias(c) if c in bounds else F.col(c)
                         for c in df.columns])
    return fenced.na.drop("any", subset=columns) if drop else fenced


def median_label(df: DataFrame, column: str, out: str = "label",
                 drop_source: bool = False) -> DataFrame:
    """P10: 1 where the value is strictly above the exact (interpolated)
    median, else 0; rows on the median get 0, a null value no label."""
    q = column_quantiles(df, [column], [0.5]).collect()
    med = F.lit(q[0]["q"] if q else None).cast("double")
    lab = F.when(F.col(column) > med, F.lit(1)).when(F.col(column).isNotNull(), F.lit(0))
    res = df.withColumn(out, lab.cast("int"))
    return res.drop(column) if drop_source else res
