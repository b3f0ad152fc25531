"""Platform-style facts derived from the driver tables, as Spark frames and as SQL.

``ad_period`` builds a reporting-layer ad table (period grain, chosen
dimensions, the full measure set) from ``lineitem`` joined to ``supplier``
and ``part``; ``ad_period_sql`` renders the same derivation for the oracle.
Both are generated from the one description below, so a report's Spark input
and its oracle input cannot drift apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blendwise.functions.aggs import sum_
from blendwise.functions.dates import GRAINS
from blendwise.operators.calendar import granularity_rollup
from blendwise.plans.oracle import per_grain, trunc

# Dimensions: name -> (Spark expression builder, SQL expression).
_DIMS = {
    "flag": (lambda: F.col("l_returnflag"), "l_returnflag"),
    "status": (lambda: F.col("l_linestatus"), "l_linestatus"),
    "campaign_id": (lambda: F.col("l_suppkey").cast("string"), "CAST(l_suppkey AS VARCHAR)"),
    "campaign_num": (lambda: F.col("l_suppkey"), "l_suppkey"),
    "campaign_name": (lambda: F.when(F.col("s_acctbal") >= 0, F.col("s_name")),
                      "CASE WHEN s_acctbal >= 0 THEN s_name END"),
    "adset_id": (lambda: F.col("p_type"), "p_type"),
    "adset_name": (lambda: F.concat(F.lit("adset "), F.col("p_type")), "'adset ' || p_type"),
    "ad_name": (lambda: F.col("p_name"), "p_name"),
    "account": (lambda: F.when(F.col("l_linestatus") == "F", F.lit("Direct")).otherwise(F.lit("Retail")),
                "CASE WHEN l_linestatus = 'F' THEN 'Direct' ELSE 'Retail' END"),
    "campaign_country": (lambda: F.when(F.col("s_nationkey") < 12, F.lit("US")).otherwise(F.lit("CA")),
                         "CASE WHEN s_nationkey < 12 THEN 'US' ELSE 'CA' END"),
    "country": (lambda: F.when(F.col("l_linestatus") == "F", F.lit("US")).otherwise(F.lit("INTL")),
                "CASE WHEN l_linestatus = 'F' THEN 'US' ELSE 'INTL' END"),
    "campaign_type_default": (
        lambda: F.when(F.col("p_type") == "PROMO", F.lit("Prospecting"))
        .when(F.col("p_type") == "ECONOMY", F.lit("retargeting")).otherwise(F.lit("awareness")),
        "CASE p_type WHEN 'PROMO' THEN 'Prospecting' WHEN 'ECONOMY' THEN 'retargeting' "
        "ELSE 'awareness' END"),
    "region": (
        lambda: F.when(F.col("s_nationkey") < 6, F.lit("US")).when(F.col("s_nationkey") < 11, F.lit("AUS"))
        .when(F.col("s_nationkey") < 16, F.lit("EU")).when(F.col("s_nationkey") < 21, F.lit("UK"))
        .otherwise(F.lit("Other")),
        "CASE WHEN s_nationkey < 6 THEN 'US' WHEN s_nationkey < 11 THEN 'AUS' "
        "WHEN s_nationkey < 16 THEN 'EU' WHEN s_nationkey < 21 THEN 'UK' ELSE 'Other' END"),
    "campaign_type_custom": (
        lambda: F.when(F.col("p_type") == "PROMO", F.lit("Youtube"))
        .when(F.col("p_type") == "ECONOMY", F.lit("Amazon"))
        .when(F.col("p_type") == "LARGE", F.lit("Demand Gen")).otherwise(F.lit("Search")),
        "CASE p_type WHEN 'PROMO' THEN 'Youtube' WHEN 'ECONOMY' THEN 'Amazon' "
        "WHEN 'LARGE' THEN 'Demand Gen' ELSE 'Search' END"),
    "location": (lambda: F.concat(F.lit("loc_"), F.col("s_nationkey").cast("string")),
                 "'loc_' || CAST(s_nationkey AS VARCHAR)"),
    "service": (lambda: F.col("p_brand"), "p_brand"),
    "product": (lambda: F.col("p_brand"), "p_brand"),
}

# Measures: name -> (Spark builder, SQL expression, SQL type); summed per group.
_MEASURES = {
    "spend": (lambda: F.floor("l_extendedprice").cast("double"),
              "floor(l_extendedprice)::DOUBLE", "DOUBLE"),
    "link_clicks": (lambda: F.col("l_quantity").cast("long"), "CAST(l_quantity AS BIGINT)", "BIGINT"),
    "clicks": (lambda: F.col("l_quantity").cast("long"), "CAST(l_quantity AS BIGINT)", "BIGINT"),
    "impressions": (lambda: F.lit(1).cast("long"), "1", "BIGINT"),
    "purchases": (lambda: F.when(F.col("l_linestatus") == "F", 1).otherwise(0).cast("long"),
                  "CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END", "BIGINT"),
    "revenue": (lambda: F.floor(F.col("l_extendedprice") * (F.lit(1) - F.col("l_discount"))).cast("double"),
                "floor(l_extendedprice * (1 - l_discount))::DOUBLE", "DOUBLE"),
    "add_to_cart": (lambda: F.when(F.col("l_quantity") > 25, 1).otherwise(0).cast("long"),
                    "CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END", "BIGINT"),
    "checkout_initiated": (lambda: F.when(F.col("l_quantity") > 40, 1).otherwise(0).cast("long"),
                           "CASE WHEN l_quantity > 40 THEN 1 ELSE 0 END", "BIGINT"),
    "leads": (lambda: F.when(F.col("l_linenumber") == 1, 1).otherwise(0).cast("long"),
              "CASE WHEN l_linenumber = 1 THEN 1 ELSE 0 END", "BIGINT"),
    "VS-01 WK": (lambda: F.when(F.col("l_tax") > 0.05, 1).otherwise(0).cast("long"),
                 "CASE WHEN l_tax > 0.05 THEN 1 ELSE 0 END", "BIGINT"),
    "appointments_scheduled": (lambda: F.when(F.col("l_discount") > 0.05, 1).otherwise(0).cast("long"),
                               "CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END", "BIGINT"),
    "booked_appointment": (lambda: F.when(F.col("l_linenumber") == 2, 1).otherwise(0).cast("long"),
                           "CASE WHEN l_linenumber = 2 THEN 1 ELSE 0 END", "BIGINT"),
    "completed_appointment": (lambda: F.when(F.col("l_linenumber") == 3, 1).otherwise(0).cast("long"),
                              "CASE WHEN l_linenumber = 3 THEN 1 ELSE 0 END", "BIGINT"),
    "booking_complete": (lambda: F.when(F.col("l_linenumber") == 4, 1).otherwise(0).cast("long"),
                         "CASE WHEN l_linenumber = 4 THEN 1 ELSE 0 END", "BIGINT"),
    "app_install": (lambda: F.when(F.col("l_linenumber") <= 3, 1).otherwise(0).cast("long"),
                    "CASE WHEN l_linenumber <= 3 THEN 1 ELSE 0 END", "BIGINT"),
    "trial_started": (lambda: F.when(F.col("l_linenumber") <= 2, 1).otherwise(0).cast("long"),
                      "CASE WHEN l_linenumber <= 2 THEN 1 ELSE 0 END", "BIGINT"),
    "trial_converted": (lambda: F.when(F.col("l_linenumber") == 1, 1).otherwise(0).cast("long"),
                        "CASE WHEN l_linenumber = 1 THEN 1 ELSE 0 END", "BIGINT"),
    "initial_purchase": (
        lambda: F.when((F.col("l_linenumber") == 1) & (F.col("l_linestatus") == "F"), 1)
        .otherwise(0).cast("long"),
        "CASE WHEN l_linenumber = 1 AND l_linestatus = 'F' THEN 1 ELSE 0 END", "BIGINT"),
    "trial_converted_value": (lambda: F.floor(F.col("l_extendedprice") * F.lit(0.01)).cast("double"),
                              "floor(l_extendedprice * 0.01::DOUBLE)::DOUBLE", "DOUBLE"),
    "initial_purchase_value": (lambda: F.floor(F.col("l_extendedprice") * F.lit(0.02)).cast("double"),
                               "floor(l_extendedprice * 0.02::DOUBLE)::DOUBLE", "DOUBLE"),
    "purchases_shared_items": (lambda: F.when(F.col("l_quantity") > 45, 1).cast("long"),
                               "CASE WHEN l_quantity > 45 THEN 1 END", "BIGINT"),
    "revenue_shared_items": (
        lambda: F.when(F.col("l_quantity") > 45, F.floor(F.col("l_extendedprice") * F.lit(0.1))).cast("double"),
        "CASE WHEN l_quantity > 45 THEN floor(l_extendedprice * 0.1::DOUBLE) END::DOUBLE", "DOUBLE"),
}

BASE_MEASURES = ("spend", "link_clicks", "clicks", "impressions", "purchases", "revenue")


def _where_spark(flags, status):
    cond = F.col("l_returnflag").isin(list(flags))
    if status is not None:
        cond = cond & (F.col("l_linestatus") == F.lit(status))
    return cond


def _where_sql(flags, status):
    cond = "l_returnflag IN (" + ", ".join(f"'{f}'" for f in flags) + ")"
    if status is not None:
        cond += f" AND l_linestatus = '{status}'"
    return cond


def ad_period(t, flags, dims=(), measures=BASE_MEASURES, grains=GRAINS,
              status: str | None = None) -> DataFrame:
    """Period-grain ad facts: ``date, date_granularity, *dims, *measures``."""
    li, s, p = t["lineitem"], t["supplier"], t["part"]
    lines = (li.filter(_where_spark(flags, status))
             .join(s, F.col("l_suppkey") == F.col("s_suppkey"), "inner")
             .join(p, F.col("l_partkey") == F.col("p_partkey"), "inner"))
    keys = [_DIMS[d][0]().alias(d) for d in dims]
    return granularity_rollup(lines, "l_shipdate", keys,
                              {m: sum_(_MEASURES[m][0]()) for m in measures}, grains=grains)


def ad_period_sql(flags, dims=(), measures=BASE_MEASURES, grains=GRAINS,
                  status: str | None = None) -> str:
    """SQL body (a SELECT) for the same facts as ``ad_period``."""
    dim_sql = "".join(f"{_DIMS[d][1]} AS {d}, " for d in dims)
    meas_sql = ", ".join(f'{_MEASURES[m][1]} AS "{m}"' for m in measures)
    src = (f"SELECT CAST(l_shipdate AS DATE) AS d, {dim_sql}{meas_sql} "
           "FROM lineitem JOIN supplier ON l_suppkey = s_suppkey "
           f"JOIN part ON l_partkey = p_partkey WHERE {_where_sql(flags, status)}")
    n = len(dims)
    group = ", ".join(str(i) for i in range(1, n + 3))
    dim_cols = "".join(f"{d}, " for d in dims)
    sums = ", ".join(f'CAST(SUM("{m}") AS {_MEASURES[m][2]}) AS "{m}"' for m in measures)
    body = per_grain("SELECT " + trunc("{g}", "d") + " AS date, '{g}' AS date_granularity, "
                     + dim_cols + sums + f" FROM src GROUP BY {group}", grains)
    return f"SELECT * FROM (WITH src AS ({src})\n{body})"
