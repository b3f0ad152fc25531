"""Small column helpers shared by every module."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c) -> Column:
    """Accept a column name or a Column."""
    return F.col(c) if isinstance(c, str) else c


def typed_null(dtype: str) -> Column:
    """A NULL of a given type, e.g. ``NULL::bigint``."""
    return F.lit(None).cast(dtype)


def zero(c) -> Column:
    """``COALESCE(x, 0)`` (M3)."""
    return F.coalesce(as_col(c), F.lit(0))


def safe_div(num, den) -> Column:
    """``num / NULLIF(den, 0)``: never divides by zero under ANSI mode."""
    return as_col(num) / F.nullif(as_col(den), F.lit(0))


def any_positive(*cols) -> Column:
    """``(a > 0 OR b > 0 OR ...)``."""
    cond = None
    for c in cols:
        term = as_col(c) > 0
        cond = term if cond is None else (cond | term)
    return cond
