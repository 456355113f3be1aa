"""Column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def field_at(line, sep: str, index: int) -> Column:
    """Field ``index`` (0-based) of a delimited string; null when the line has
    fewer fields. ``F.get`` instead of ``getItem``: under ANSI mode the latter
    raises on a short line, and the cleaning step expects a null."""
    return F.get(F.split(_c(line), sep), F.lit(index))


def to_number(c, kind: str = "double") -> Column:
    """Text to number; unparsable text ("Not Available", "") becomes null
    instead of failing under ANSI mode. ``kind`` is ``"double"`` or a SQL
    type such as ``"decimal(10,0)"`` (what ``cast("numeric")`` means)."""
    return _c(c).try_cast(kind)


def hash60(seed: int, *cols) -> Column:
    """A seeded 60-bit non-negative hash of ``cols``: the first 15 hex digits
    of md5 over ``seed:col1:col2...``. Chosen over xxhash64 because DuckDB
    computes the same md5, so samples and splits can be checked row by row."""
    parts = [F.lit(str(seed))] + [_c(c).cast("string") for c in cols]
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 15), 16, 10).cast("bigint")


def bucket100(seed: int, *cols) -> Column:
    """Bucket 0..99 from ``hash60``; a row's bucket depends on its key only,
    never on partitioning."""
    return (hash60(seed, *cols) % 100).cast("int")


def ratio(num, den) -> Column:
    """num / den, null when den is 0 (no ``DIVIDE_BY_ZERO`` under ANSI)."""
    return F.try_divide(_c(num), _c(den))


def safe_corr(a, b) -> Column:
    """Pearson correlation, null when either column is constant (``corr`` of a
    constant column raises ``DIVIDE_BY_ZERO`` under ANSI, and a CASE around
    an aggregate does not stop the aggregate from being evaluated)."""
    a, b = _c(a), _c(b)
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))


def rounded(c, digits: int = 4) -> Column:
    """Round to ``digits`` after the point and return a double."""
    return F.round(_c(c).cast("double"), digits)
