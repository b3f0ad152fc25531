"""Input contracts of the report models (schemas inferred from column use).

A report validates its inputs on entry: every contract column must exist with
a compatible type. Extra columns are allowed (they are pruned by Catalyst).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import (
    BooleanType, DateType, DoubleType, IntegerType, LongType, StringType, StructField,
    StructType, TimestampNTZType,
)

_NUMERIC = {"tinyint", "smallint", "int", "bigint", "float", "double"}
_TYPES = {"string": StringType(), "date": DateType(), "double": DoubleType(),
          "bigint": LongType(), "int": IntegerType(), "boolean": BooleanType(),
          "timestamp_ntz": TimestampNTZType()}


def _schema(spec: str) -> StructType:
    """``"name type, name type"`` with the simple types above (no session needed)."""
    fields = []
    for item in spec.split(","):
        name, dtype = item.split()
        fields.append(StructField(name.strip("`"), _TYPES[dtype]))
    return StructType(fields)


ADS = _schema(
    "date date, date_granularity string, account string, campaign_id string, "
    "campaign_name string, campaign_country string, campaign_type_default string, "
    "campaign_type_custom string, adset_id string, adset_name string, ad_name string, "
    "product string, location string, service string, country string, spend double, "
    "impressions bigint, clicks bigint, link_clicks bigint, add_to_cart bigint, "
    "checkout_initiated bigint, leads bigint, purchases bigint, revenue double")

STORE_PERIOD = _schema(
    "date date, date_granularity string, orders bigint, first_orders bigint, gross_sales double, "
    "net_sales double, total_net_sales double, first_order_gross_sales double, "
    "first_order_net_sales double, first_order_total_net_sales double, subtotal_discount double, "
    "subtotal_refund double, shipping_refunds double, tax_refunds double, "
    "first_order_subtotal_refund double, first_order_shipping_refunds double, "
    "first_order_tax_refunds double")

STORE_ORDER = _schema(
    "order_id string, date date, orders bigint, first_orders bigint, gross_sales double, "
    "subtotal_discounts double, tax_sales double, shipping_revenue double, "
    "shipping_discounts double, subtotal_refunds double, shipping_refunds double, "
    "tax_refunds double, first_order_gross_sales double, first_order_subtotal_discounts double, "
    "first_order_tax_sales double, first_order_shipping_revenue double, "
    "first_order_shipping_discounts double, first_order_subtotal_refunds double, "
    "first_order_shipping_refunds double, first_order_tax_refunds double")

TOUCHES = _schema(
    "order_id string, source string, campaign_id string, click_date timestamp_ntz, type string, "
    "`index` int, _fivetran_deleted boolean")

ORDERS = _schema("order_id string, order_date timestamp_ntz")

WEB_SESSIONS = _schema(
    "date date, date_granularity string, session_source_medium string, "
    "session_campaign_id string, sessions bigint, engaged_sessions bigint, "
    "conversions_purchase bigint, purchase_revenue double")

TRACKER = _schema(
    "date date, forecasted_spend double, forecasted_revenue double, actual_total_spend double, "
    "sessions bigint")


def _kind(t: str) -> str:
    if t in _NUMERIC or t.startswith("decimal"):
        return "number"
    if t.startswith("timestamp") or t == "date":
        return "temporal"
    return t


def validate(df: DataFrame, contract: StructType, columns=None) -> DataFrame:
    """Check that ``df`` carries the contract columns (all, or ``columns``).

    Numeric widths and date/timestamp flavours are compatible with each other;
    text must be text. Returns ``df`` unchanged so it can sit in a chain.
    """
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    wanted = [f for f in contract.fields if columns is None or f.name in columns]
    problems = []
    for f in wanted:
        if f.name not in have:
            problems.append(f"missing {f.name}")
        elif _kind(have[f.name]) != _kind(f.dataType.simpleString()) and have[f.name] != "void":
            problems.append(f"{f.name}: {have[f.name]} is not {f.dataType.simpleString()}")
    if problems:
        raise ValueError("input does not match contract: " + "; ".join(problems))
    return df
