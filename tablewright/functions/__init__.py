"""Column-expression helpers. All are Spark built-ins under the hood, so
they stay inside whole-stage code generation; none is a Python UDF."""

from tablewright.functions.columns import (
    field_at,
    hash60,
    bucket100,
    to_number,
    safe_corr,
    ratio,
    rounded,
)

__all__ = ["field_at", "hash60", "bucket100", "to_number", "safe_corr",
           "ratio", "rounded"]
