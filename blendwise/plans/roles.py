"""Driver tables in the roles of the reports' inputs.

The studied reports read marketing tables (ad platforms, store, web analytics)
that the test data does not have. These functions derive each input contract
from the TPC-H-like tables with ordinary Spark jobs, so every report runs over
the whole given tables and its work grows with them:

* ad platform facts: ``lineitem`` by ship date and supplier (the campaign),
  one platform per return flag; campaign names from ``supplier``
  (NULL for suppliers with a negative balance, to exercise NULL names);
* web sessions: ``lineitem`` lines with return flag 'N' by ship date and supplier;
* store sales: ``orders`` (a customer's earliest order is their first order);
* touches: ``lineitem`` lines as clicks on orders.

Money is ``floor(price)`` so every sum is a sum of whole numbers: exact in
doubles, whatever the order in which partial sums meet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blendwise.functions.aggs import count_, sum_
from blendwise.functions.dates import GRAINS
from blendwise.operators.calendar import granularity_rollup

# Return flag of each ad platform role.
PLATFORM_FLAGS = {"meta": "R", "google": "A", "web": "N"}


def money(c) -> F.Column:
    """Whole-number money from a price column."""
    return F.floor(F.col(c) if isinstance(c, str) else c).cast("double")


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """``df`` with its double columns rounded, for comparing weighted results."""
    return df.select(*[F.round(n, digits).alias(n) if t == "double" else F.col(n) for n, t in df.dtypes])


def tables_in_range(tables, date_range):
    """The driver tables with the facts of a range of days (widened as in ``plans.date_ranges``).

    ``lineitem``, ``orders`` and ``events`` are cut to it. ``lineitem_open`` has the lines from a look-back before it on
    (clicks), ``lineitem_of_orders`` the lines of the range's orders, whenever they ship (a semi-join);
    ``orders_all`` is whole, for customers' first orders.
    """
    from blendwise.operators.calendar import touches_range
    from blendwise.plans.date_ranges import not_before
    from blendwise.operators.joins import reduce_to
    lines, orders = tables["lineitem"], tables["orders"]
    ordered = orders.filter(touches_range("o_orderdate", date_range)).select(F.col("o_orderkey").alias("l_orderkey"))
    return {**tables, "lineitem_of_orders": reduce_to(lines, ordered, ["l_orderkey"]), "lineitem": lines.filter(touches_range("l_shipdate", date_range)), "orders": orders.filter(touches_range("o_orderdate", date_range)),
            "events": tables["events"].filter(touches_range("ts", date_range)),
            "lineitem_open": lines.filter(not_before("l_shipdate", date_range)), "orders_all": orders}


def campaign_names(tables) -> DataFrame:
    """``(campaign_id, campaign_name)``; NULL name where the supplier balance is negative."""
    s = tables["supplier"]
    return s.select(F.col("s_suppkey").cast("string").alias("campaign_id"),
                    F.when(F.col("s_acctbal") >= 0, F.col("s_name")).alias("campaign_name"))


def ad_lines(tables, flag: str) -> DataFrame:
    """Line-level ad rows of one platform: date, campaign, measures."""
    li = tables["lineitem"]
    return li.filter(F.col("l_returnflag") == F.lit(flag)).select(
        F.col("l_shipdate").cast("date").alias("date"),
        F.col("l_suppkey").cast("string").alias("campaign_id"),
        money("l_extendedprice").alias("spend"),
        F.col("l_quantity").cast("long").alias("link_clicks"),
        F.when(F.col("l_linestatus") == "F", 1).otherwise(0).alias("purchases"),
        money(F.col("l_extendedprice") * (F.lit(1) - F.col("l_discount"))).alias("revenue"),
        F.col("l_partkey"),
    )


def ad_facts(tables, flag: str, grains=GRAINS) -> DataFrame:
    """Reporting-layer ad facts: one row per campaign, period and grain.

    Columns: ``date, date_granularity, campaign_id, campaign_name, spend,
    link_clicks, clicks, impressions, purchases, revenue``.
    """
    rolled = granularity_rollup(
        ad_lines(tables, flag), "date", ["campaign_id"],
        {"spend": sum_("spend"), "link_clicks": sum_("link_clicks"),
         "impressions": count_(), "purchases": sum_("purchases"),
         "revenue": sum_("revenue")},
        grains=grains)
    named = rolled.join(campaign_names(tables), "campaign_id", "left")
    return named.select("date", "date_granularity", "campaign_id", "campaign_name", "spend",
                        "link_clicks", F.col("link_clicks").alias("clicks"), "impressions",
                        F.col("purchases").cast("long").alias("purchases"), "revenue")


def web_sessions(tables) -> DataFrame:
    """Daily web-analytics rows: ``date, session_campaign_id, sessions, ...``."""
    li = tables["lineitem"]
    return (li.filter(F.col("l_returnflag") == F.lit(PLATFORM_FLAGS["web"]))
            .groupBy(F.col("l_shipdate").cast("date").alias("date"),
                     F.col("l_suppkey").cast("string").alias("session_campaign_id"))
            .agg(F.count(F.lit(1)).alias("sessions"),
                 F.count(F.when(F.col("l_linestatus") == "O", 1)).alias("engaged_sessions"),
                 F.sum(F.col("l_quantity").cast("long")).alias("conversions_purchase"),
                 F.sum(money("l_extendedprice")).alias("purchase_revenue")))


def first_orders(tables) -> DataFrame:
    """Orders flagged with ``is_first``: the customer's earliest (date, key) order.

    A per-customer minimum (map-side combined, so a customer with a huge
    share of orders is pre-reduced) joined back on the unique order key,
    instead of a window over each customer's orders.
    """
    o = tables["orders"]
    firsts = (tables.get("orders_all", o).groupBy("o_custkey")
              .agg(F.min(F.struct("o_orderdate", "o_orderkey")).alias("__f"))
              .select(F.col("__f.o_orderkey").alias("o_orderkey"), F.lit(True).alias("is_first")))
    return (o.join(firsts, "o_orderkey", "left")
            .withColumn("is_first", F.coalesce(F.col("is_first"), F.lit(False))))


def store_period(tables, grains=GRAINS) -> DataFrame:
    """Period-grain store sales (the ``store_period`` contract) from ``orders``."""
    o = first_orders(tables).select(
        F.col("o_orderdate").cast("date").alias("date"),
        F.col("is_first"),
        money("o_totalprice").alias("gross"),
        money(F.col("o_totalprice") * F.lit(0.9)).alias("net"),
        money(F.col("o_totalprice") * F.lit(0.05)).alias("disc"),
        money(F.col("o_totalprice") * F.lit(0.02)).alias("refund"),
    )
    first = lambda c: F.when(F.col("is_first"), F.col(c)).otherwise(F.lit(0.0))
    return granularity_rollup(
        o, "date", [],
        {"orders": count_(),
         "first_orders": sum_(F.col("is_first").cast("long")),
         "gross_sales": sum_("gross"), "net_sales": sum_("net"),
         "total_net_sales": sum_(F.col("gross") - F.col("disc")),
         "first_order_gross_sales": sum_(first("gross")),
         "first_order_net_sales": sum_(first("net")),
         "first_order_total_net_sales": sum_(first("gross") - first("disc")),
         "subtotal_discount": sum_("disc"),
         "subtotal_refund": sum_("refund"),
         "shipping_refunds": sum_(F.lit(0.0)),
         "tax_refunds": sum_(F.floor(F.col("refund") / 2).cast("double")),
         "first_order_subtotal_refund": sum_(first("refund")),
         "first_order_shipping_refunds": sum_(F.lit(0.0)),
         "first_order_tax_refunds": sum_(F.floor(first("refund") / 2).cast("double"))},
        grains=grains)


def touches(tables) -> DataFrame:
    """Attribution touches from ``lineitem``: each line is a click on its order.

    ``source`` by return flag, blank campaign id on line 7, a different model
    type on line 6, soft-deleted when the discount is the maximum 0.10.
    """
    li = tables.get("lineitem_open", tables["lineitem"])
    return li.select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.when(F.col("l_returnflag") == "R", F.lit("facebook-ads"))
        .when(F.col("l_returnflag") == "A", F.lit("google-ads"))
        .otherwise(F.lit("applovin")).alias("source"),
        F.when(F.col("l_linenumber") == 7, F.lit("")).otherwise(
            F.col("l_suppkey").cast("string")).alias("campaign_id"),
        F.col("l_shipdate").alias("click_date"),
        F.when(F.col("l_linenumber") == 6, F.lit("ORDERS_FIRST_CLICK"))
        .otherwise(F.lit("ORDERS_LINEAR_ALL")).alias("type"),
        F.col("l_linenumber").alias("index"),
        (F.col("l_discount") >= 0.1).alias("_fivetran_deleted"))


def attribution_orders(tables) -> DataFrame:
    """``orders(order_id, order_date)``."""
    return tables["orders"].select(F.col("o_orderkey").cast("string").alias("order_id"),
                                   F.col("o_orderdate").alias("order_date"))


# Attribution channels: (source, channel, needs a non-blank campaign id).
from blendwise.constants import ATTRIBUTION_CHANNELS_THREE as ATTRIBUTION_CHANNELS  # noqa: E402
