"""Store metrics.

``order_counts`` counts distinct orders in two steps: first one row per
``(keys, order_id)`` carrying ``max(is_first)``, then plain counts. Both steps
are ordinary hash aggregates with map-side combine, so unlike the
``Expand``-based plan Spark builds for two ``COUNT(DISTINCT)`` in one
aggregate, no row is duplicated and a hot key is pre-reduced before any
shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blendwise.functions.aggs import Agg  # noqa: F401  (type of ``extra``)
from blendwise.functions.columns import as_col, zero
from blendwise.functions.text import imatch


def sales_components(prefix: str = "") -> dict[str, Column]:
    """Order-grain sales arithmetic, all inputs zero-filled.

    ``prefix`` selects the twin columns (``'first_order_'``). Returns
    ``total_sales_amount`` (gross - discounts + tax + shipping - shipping
    discounts), ``sales_amount`` (gross - discounts), ``total_refund_amount``
    (subtotal - shipping + tax refunds) and ``refund_amount`` (subtotal refunds).
    """
    c = lambda n: zero(F.col(prefix + n))
    return {
        "total_sales_amount": c("gross_sales") - c("subtotal_discounts") + c("tax_sales")
        + c("shipping_revenue") - c("shipping_discounts"),
        "sales_amount": c("gross_sales") - c("subtotal_discounts"),
        "total_refund_amount": c("subtotal_refunds") - c("shipping_refunds") + c("tax_refunds"),
        "refund_amount": c("subtotal_refunds"),
    }


def period_refund(prefix: str = "") -> Column:
    """Period-grain refund: ``subtotal_refund - shipping_refunds + tax_refunds``."""
    return (F.col(prefix + "subtotal_refund") - F.col(prefix + "shipping_refunds")
            + F.col(prefix + "tax_refunds"))


def net_new(new_revenue, new_refunds) -> Column:
    """``COALESCE(new,0) - COALESCE(refunds,0)``."""
    return zero(new_revenue) - zero(new_refunds)


def returning_orders(orders, first_orders) -> Column:
    """``COALESCE(orders,0) - COALESCE(first_orders,0)``."""
    return zero(orders) - zero(first_orders)


def order_counts(lines: DataFrame, keys: Sequence[str], order_col: str, is_first: Column,
                 orders_name: str = "orders", first_name: str = "first_orders",
                 extra: Mapping[str, "Agg"] | None = None) -> DataFrame:
    """Distinct orders and distinct first orders per key.

    Equivalent to ``COUNT(DISTINCT order_id)`` and
    ``COUNT(DISTINCT CASE WHEN is_first THEN order_id END)``, computed as two
    map-side-combined aggregates: one row per (keys, order) first, then plain
    counts. ``extra`` adds decomposable measures (``Agg`` specs such as
    ``sum_(x, fill=0)``) over all rows, including rows without an order id,
    carried through the same two steps, so the input is read once.
    """
    extra = dict(extra or {})
    oid = F.col(order_col)
    partial = {f"__x{i}": a for i, a in enumerate(extra.values())}
    per_order = lines.groupBy(*keys, order_col).agg(
        F.max(F.when(is_first, 1).otherwise(0)).alias("__first"),
        *[a.partial().alias(n) for n, a in partial.items()])
    out = per_order.groupBy(*keys).agg(
        F.count(oid).alias(orders_name),
        F.coalesce(F.sum(F.when(oid.isNotNull(), F.col("__first"))), F.lit(0)).cast("long")
        .alias(first_name),
        *[a.merge(n).alias(name) for (n, a), name in zip(partial.items(), extra)])
    return out


def unit_values(title, quantity, families: Mapping[str, Sequence]) -> dict[str, Column]:
    """A row's units per product family.

    ``families`` maps a measure name to ordered rules, each a dict with one of
    ``title`` (exact), ``titles`` (list) or ``pattern`` (``~*``) and an
    optional ``multiplier`` (a 3-pack counts 3). Rows matching no rule give 0.
    """
    t, q = as_col(title), as_col(quantity)
    out = {}
    for name, rules in families.items():
        expr = None
        for rule in rules:
            if "title" in rule:
                cond = t == F.lit(rule["title"])
            elif "titles" in rule:
                cond = t.isin(list(rule["titles"]))
            else:
                cond = imatch(t, rule["pattern"])
            mult = rule.get("multiplier", 1)
            val = q if mult == 1 else q * F.lit(mult)
            expr = F.when(cond, val) if expr is None else expr.when(cond, val)
        out[name] = expr.otherwise(F.lit(0))
    return out


def product_units(title, quantity, families: Mapping[str, Sequence]) -> dict[str, Column]:
    """``{name: SUM(units)}`` aggregate columns of ``unit_values``."""
    return {name: F.sum(value) for name, value in unit_values(title, quantity, families).items()}
