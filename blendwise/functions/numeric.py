"""Money and measure helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from blendwise.constants import SESSION_FACTOR
from blendwise.functions.columns import as_col, safe_div, zero


def as_double(c) -> Column:
    """``x::float`` -- the warehouse float is 8 bytes, so DoubleType (M4)."""
    return as_col(c).cast("double")


def parse_money(c, strict: bool = False) -> Column:
    """Money text such as ``'$1,234.50'`` to double (M5).

    ``try_cast`` turns blanks and junk into NULL instead of failing the job
    under ANSI mode; ``count_unparsed`` reports how many values that hit.
    ``strict`` fails the job on the first such value, as a plain cast does.
    """
    cleaned = F.replace(F.replace(as_col(c), F.lit("$"), F.lit("")), F.lit(","), F.lit(""))
    return cleaned.cast("double") if strict else cleaned.try_cast("double")


def count_unparsed(c) -> Column:
    """Aggregate: number of non-NULL money texts that ``parse_money`` rejects."""
    return F.sum(F.when(as_col(c).isNotNull() & parse_money(c).isNull(), 1).otherwise(0))


def count_blank(c) -> Column:
    """Aggregate: number of non-NULL money texts that hold no digit, such as ``''`` or ``'$'``."""
    return F.sum(F.when(as_col(c).isNotNull() & ~as_col(c).rlike("[0-9]"), 1).otherwise(0))


def micro_units(c, scale: float = 1_000_000.0) -> Column:
    """Platform micro-currency to currency units."""
    return as_double(c) / F.lit(float(scale))


def tax_net(amount, tax, total) -> Column:
    """``amount * (1 - COALESCE(tax / NULLIF(total, 0), 0))``."""
    return as_col(amount) * (F.lit(1) - F.coalesce(safe_div(tax, total), F.lit(0)))


def merge_shared_items(own, shared) -> Column:
    """``COALESCE(own, 0) + COALESCE(shared, 0)``."""
    return zero(own) + zero(shared)


def scale_estimate(c, factor: float = SESSION_FACTOR) -> Column:
    """A measure scaled by a constant, e.g. ``0.8 * SUM(sessions)``."""
    return F.lit(float(factor)) * as_col(c)


def exact_sum(c, scale: int = 12) -> Column:
    """Order-independent sum, added as ``decimal(38, scale)`` and returned as double.

    The result does not depend on partitioning or on the order in which partial
    sums meet. Only digits beyond ``scale`` decimals of an addend are rounded; an
    addend or total of 10^(38 - scale) or more fails the job under ANSI mode.
    """
    return F.sum(as_col(c).cast(f"decimal(38,{scale})")).cast("double")
