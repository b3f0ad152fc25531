"""Driver queries for blends, scenarios and store metrics, each with its DuckDB oracle."""

from __future__ import annotations

from pyspark.sql import functions as F

from blendwise.functions.aggs import count_, sum_
from blendwise.functions.columns import typed_null
from blendwise.functions.dates import GRAINS, period_start
from blendwise.functions.numeric import count_unparsed, exact_sum, micro_units, parse_money, tax_net
from blendwise.functions.text import not_imatch
from blendwise.operators import (
    cutover, full_outer_blend, goal_rollup, granularity_rollup, order_counts, product_units,
    returning_orders, spine, spine_join, split_spend, stack_channels, stack_scenarios,
    store_block, unpivot_regions,
)
from blendwise.plans import roles
from blendwise.plans.oracle import NAMES_CTE, SQL, per_grain, store_cte, trunc
from blendwise.plans.queries import query, tables
from blendwise.plans.roles import money, rounded


def _sd():
    return F.col("l_shipdate").cast("date")


def _od():
    return F.col("o_orderdate").cast("date")


def _month(c):
    return period_start(c, "month")


# ------------------------------------------------------------ R12, J5, J6 --

@query("full_outer_blend_two")
def q_full_outer_blend_two(spark, sf):
    o = tables(spark, sf)["orders"]
    keys = [_month(_od()).alias("date"), F.col("o_orderpriority").alias("priority")]
    left = (o.filter(F.col("o_orderstatus") == "F").groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("f_orders")))
    right = (o.filter(F.col("o_orderstatus") != "F").groupBy(*keys)
             .agg(F.sum(money("o_totalprice")).alias("spend")))
    return full_outer_blend([(left, None), (right, ["date", "priority"])],
                            fill_measures=["f_orders", "spend"])


SQL["full_outer_blend_two"] = f"""
WITH l AS (SELECT {trunc('month', 'o_orderdate')} AS date, o_orderpriority AS priority,
                  COUNT(*) AS f_orders FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2),
r AS (SELECT {trunc('month', 'o_orderdate')} AS date, o_orderpriority AS priority,
             SUM(floor(o_totalprice)::DOUBLE) AS spend FROM orders WHERE o_orderstatus != 'F'
      GROUP BY 1, 2)
SELECT date, priority, COALESCE(f_orders, 0) AS f_orders, COALESCE(spend, 0) AS spend
FROM l FULL OUTER JOIN r USING (date, priority)"""


def _chain_inputs(t):
    li = t["lineitem"]
    names = roles.campaign_names(t)
    channel = F.when(F.col("l_linestatus") == "F", F.lit("Facebook")).otherwise(F.lit("Google Ads"))
    cid = F.when(F.col("l_suppkey") % 10 == 0, typed_null("string")).otherwise(
        F.col("l_suppkey").cast("string"))
    base = li.select(_sd().alias("date"), channel.alias("channel"), cid.alias("campaign_id"),
                     F.col("l_suppkey").cast("string").alias("supp"), "l_returnflag",
                     money("l_extendedprice").alias("price"))
    base = base.join(names.withColumnRenamed("campaign_id", "supp"), "supp", "left")
    k4 = ["date", "channel", "campaign_id", "campaign_name"]
    conv = (base.filter(F.col("l_returnflag") == "R").groupBy(*k4)
            .agg(F.count(F.lit(1)).alias("purchases")))
    paid = (base.filter(F.col("l_returnflag") == "A").groupBy(*k4)
            .agg(F.sum("price").alias("spend")))
    web = (base.filter(F.col("l_returnflag") == "N").groupBy(*k4[:3])
           .agg(F.count(F.lit(1)).alias("sessions")))
    tracker = (t["orders"].groupBy(_od().alias("date"), F.lit("Other").alias("channel"),
                                   F.lit("(not set)").alias("campaign_id"))
               .agg(F.sum(money("o_totalprice")).alias("forecast")))
    return conv, paid, web, tracker


@query("full_outer_blend_chain")
def q_full_outer_blend_chain(spark, sf):
    conv, paid, web, tracker = _chain_inputs(tables(spark, sf))
    k3 = ["date", "channel", "campaign_id"]
    return full_outer_blend(
        [(conv, None), (paid, k3 + ["campaign_name"]), (web, k3), (tracker, k3)],
        fill_measures=["purchases", "spend", "sessions", "forecast"])


SQL["full_outer_blend_chain"] = f"""
WITH {NAMES_CTE},
base AS (
  SELECT CAST(l_shipdate AS DATE) AS date,
         CASE WHEN l_linestatus = 'F' THEN 'Facebook' ELSE 'Google Ads' END AS channel,
         CASE WHEN l_suppkey % 10 = 0 THEN NULL ELSE CAST(l_suppkey AS VARCHAR) END AS campaign_id,
         n.campaign_name, l_returnflag, floor(l_extendedprice)::DOUBLE AS price
  FROM lineitem LEFT JOIN names n ON CAST(l_suppkey AS VARCHAR) = n.campaign_id),
conv AS (SELECT date, channel, campaign_id, campaign_name, COUNT(*) AS purchases
         FROM base WHERE l_returnflag = 'R' GROUP BY 1, 2, 3, 4),
paid AS (SELECT date, channel, campaign_id, campaign_name, SUM(price) AS spend
         FROM base WHERE l_returnflag = 'A' GROUP BY 1, 2, 3, 4),
web AS (SELECT date, channel, campaign_id, COUNT(*) AS sessions
        FROM base WHERE l_returnflag = 'N' GROUP BY 1, 2, 3),
tracker AS (SELECT CAST(o_orderdate AS DATE) AS date, 'Other' AS channel,
                   '(not set)' AS campaign_id, SUM(floor(o_totalprice)::DOUBLE) AS forecast
            FROM orders GROUP BY 1, 2, 3)
SELECT date, channel, campaign_id, campaign_name,
       COALESCE(purchases, 0) AS purchases, COALESCE(spend, 0) AS spend,
       COALESCE(sessions, 0) AS sessions, COALESCE(forecast, 0) AS forecast
FROM conv
FULL OUTER JOIN paid USING (date, channel, campaign_id, campaign_name)
FULL OUTER JOIN web USING (date, channel, campaign_id)
FULL OUTER JOIN tracker USING (date, channel, campaign_id)"""


# ------------------------------------------------------------ R15, R16 --

@query("store_block_stack")
def q_store_block_stack(spark, sf):
    t = tables(spark, sf)
    contract = [("channel", "string"), ("date", "date"), ("date_granularity", "string"),
                ("spend", "double"), ("shopify_orders", "bigint"), ("shopify_sales", "double")]
    measures = ["spend", "shopify_orders", "shopify_sales"]
    ads = (roles.ad_lines(t, "R").groupBy(_month("date").alias("date"))
           .agg(F.sum("spend").alias("spend"))
           .withColumns({"channel": F.lit("Meta"), "date_granularity": F.lit("month")}))
    store = store_block(roles.store_period(t, grains=["month"]), contract, measures,
                        rename={"orders": "shopify_orders", "total_net_sales": "shopify_sales"})
    return stack_channels([{"df": ads}], contract, measures).unionByName(store)


SQL["store_block_stack"] = f"""
WITH {store_cte(('month',))}
SELECT 'Meta' AS channel, {trunc('month', 'l_shipdate')} AS date, 'month' AS date_granularity,
       SUM(floor(l_extendedprice)::DOUBLE) AS spend, CAST(0 AS BIGINT) AS shopify_orders,
       0.0::DOUBLE AS shopify_sales
FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2, 3
UNION ALL
SELECT 'Shopify', date, date_granularity, 0.0, orders, total_net_sales FROM store"""


@query("returning_orders")
def q_returning_orders(spark, sf):
    sp = roles.store_period(tables(spark, sf), grains=["month"])
    return sp.select("date", "orders", "first_orders",
                     returning_orders("orders", "first_orders").alias("returning_orders"))


SQL["returning_orders"] = f"""WITH {store_cte(('month',))}
SELECT date, orders, first_orders,
       COALESCE(orders, 0) - COALESCE(first_orders, 0) AS returning_orders FROM store"""


# ------------------------------------------------------------ R17-R20 --

@query("calendar_spine_join")
def q_calendar_spine_join(spark, sf):
    o = tables(spark, sf)["orders"]
    daily = o.groupBy(_od().alias("date")).agg(
        F.count(F.lit(1)).alias("orders"), F.sum(money("o_totalprice")).alias("revenue"))
    return spine_join(spine(spark, "1995-01-01", "2001-09-30"), daily, ["date"])


SQL["calendar_spine_join"] = """
WITH days AS (SELECT CAST(d AS DATE) AS date
              FROM generate_series(DATE '1995-01-01', DATE '2001-09-30', INTERVAL 1 DAY) t(d)),
daily AS (SELECT CAST(o_orderdate AS DATE) AS date, COUNT(*) AS orders,
                 SUM(floor(o_totalprice)::DOUBLE) AS revenue FROM orders GROUP BY 1)
SELECT * FROM days LEFT JOIN daily USING (date)"""


@query("stack_scenarios")
def q_stack_scenarios(spark, sf):
    o = tables(spark, sf)["orders"]

    def monthly(factor):
        price = F.col("o_totalprice") if factor == 1 else F.col("o_totalprice") * F.lit(factor)
        return o.groupBy(_month(_od()).alias("date")).agg(
            F.count(F.lit(1)).alias("orders"), F.sum(money(price)).alias("revenue"))

    contract = [("date", "date"), ("data_type", "string"), ("orders", "bigint"),
                ("revenue", "double")]
    return stack_scenarios({"Actual": monthly(1), "Forecasted": monthly(1.1),
                            "Stretch": monthly(1.2)}, contract)


SQL["stack_scenarios"] = "\nUNION ALL\n".join(
    f"SELECT {trunc('month', 'o_orderdate')} AS date, '{label}' AS data_type, COUNT(*) AS orders, "
    f"SUM(floor(o_totalprice{mult})::DOUBLE) AS revenue FROM orders GROUP BY 1, 2"
    for label, mult in (("Actual", ""), ("Forecasted", " * 1.1::DOUBLE"),
                        ("Stretch", " * 1.2::DOUBLE")))


def _region_orders(t):
    o, c, n, r = t["orders"], t["customer"], t["nation"], t["region"]
    return (o.join(c, F.col("o_custkey") == F.col("c_custkey"), "inner")
            .join(n, F.col("c_nationkey") == F.col("n_nationkey"), "inner")
            .join(r, F.col("n_regionkey") == F.col("r_regionkey"), "inner"))


@query("unpivot_regions")
def q_unpivot_regions(spark, sf):
    ro = _region_orders(tables(spark, sf))
    price = money("o_totalprice")
    wide = ro.groupBy(_od().alias("date")).agg(
        F.sum(F.when(F.col("r_name") == "AMERICA", price)).alias("us_revenue"),
        F.count(F.when(F.col("r_name") == "AMERICA", 1)).alias("us_orders"),
        F.sum(F.when(F.col("r_name") == "EUROPE", price)).alias("eu_revenue"),
        F.count(F.when(F.col("r_name") == "EUROPE", 1)).alias("eu_orders"),
        F.sum(F.when(F.col("r_name") == "ASIA", price)).alias("asia_revenue"))
    mapping = {"US": {"revenue": "us_revenue", "orders": "us_orders"},
               "EU": {"revenue": "eu_revenue", "orders": F.col("eu_orders") / 2},
               "ASIA": {"revenue": "asia_revenue"}}
    return unpivot_regions(wide, ["date"], mapping, ["revenue", "orders"])


SQL["unpivot_regions"] = """
WITH wide AS (
  SELECT CAST(o_orderdate AS DATE) AS date,
         SUM(CASE WHEN r_name = 'AMERICA' THEN floor(o_totalprice)::DOUBLE END) AS us_revenue,
         COUNT(CASE WHEN r_name = 'AMERICA' THEN 1 END) AS us_orders,
         SUM(CASE WHEN r_name = 'EUROPE' THEN floor(o_totalprice)::DOUBLE END) AS eu_revenue,
         COUNT(CASE WHEN r_name = 'EUROPE' THEN 1 END) AS eu_orders,
         SUM(CASE WHEN r_name = 'ASIA' THEN floor(o_totalprice)::DOUBLE END) AS asia_revenue
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey GROUP BY 1)
SELECT date, 'US' AS region, us_revenue::DOUBLE AS revenue, us_orders::DOUBLE AS orders FROM wide
UNION ALL SELECT date, 'EU', eu_revenue::DOUBLE, eu_orders / 2 FROM wide
UNION ALL SELECT date, 'ASIA', asia_revenue::DOUBLE, 0.0::DOUBLE FROM wide"""


@query("goal_rollup")
def q_goal_rollup(spark, sf):
    o = tables(spark, sf)["orders"]
    sheet = o.select(_od().alias("date"), money("o_totalprice").alias("spend"),
                     money(F.col("o_totalprice") * F.lit(0.4)).alias("acq_spend"),
                     money(F.col("o_totalprice") * F.lit(0.3)).alias("ft_revenue"),
                     money(F.col("o_totalprice") * F.lit(0.5)).alias("ret_revenue"))
    out = goal_rollup(sheet, "date", GRAINS, {
        "spend": F.sum("spend"), "acq_spend": F.sum("acq_spend"),
        "ret_spend": F.sum("spend") - F.sum("acq_spend"),
        "total_sales": F.sum(F.col("ft_revenue") + F.col("ret_revenue"))})
    return out.withColumn("impressions", typed_null("bigint"))


SQL["goal_rollup"] = """WITH sheet AS (
  SELECT CAST(o_orderdate AS DATE) AS d, floor(o_totalprice)::DOUBLE AS spend,
         floor(o_totalprice * 0.4::DOUBLE)::DOUBLE AS acq_spend,
         floor(o_totalprice * 0.3::DOUBLE)::DOUBLE AS ft_revenue,
         floor(o_totalprice * 0.5::DOUBLE)::DOUBLE AS ret_revenue FROM orders)
""" + per_grain(
    "SELECT " + trunc("{g}", "d") + " AS date, '{g}' AS date_granularity, SUM(spend) AS spend, "
    "SUM(acq_spend) AS acq_spend, SUM(spend) - SUM(acq_spend) AS ret_spend, "
    "SUM(ft_revenue + ret_revenue) AS total_sales, NULL::BIGINT AS impressions "
    "FROM sheet GROUP BY 1, 2")


# ------------------------------------------------------------ R21, R22 --

@query("split_spend_brand")
def q_split_spend_brand(spark, sf):
    t = tables(spark, sf)
    lp = t["lineitem"].join(t["part"], F.col("l_partkey") == F.col("p_partkey"), "inner")
    spend = money("l_extendedprice")
    acq_b, ret_b = split_spend("p_name", spend, "red", 0.34, null_name="null")
    acq_k, ret_k = split_spend("p_name", spend, "blue", 0.0, null_name="zero")
    return rounded(lp.groupBy(_month(_sd()).alias("date")).agg(
        F.sum(spend).alias("spend"), exact_sum(acq_b).alias("acq_brand"),
        exact_sum(ret_b).alias("ret_brand"), exact_sum(acq_k).alias("acq_kw"),
        exact_sum(ret_k).alias("ret_kw")))


SQL["split_spend_brand"] = f"""
WITH x AS (SELECT l_shipdate, p_name, floor(l_extendedprice)::DOUBLE AS s
           FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT {trunc('month', 'l_shipdate')} AS date, SUM(s) AS spend,
  round(fsum(CASE WHEN NOT regexp_matches(p_name, 'red', 'i') THEN s
                ELSE (CASE WHEN regexp_matches(p_name, 'red', 'i') THEN s END) * 0.34::DOUBLE END), 4) AS acq_brand,
  round(fsum(CASE WHEN regexp_matches(p_name, 'red', 'i') THEN s * 0.66::DOUBLE ELSE 0 END), 4) AS ret_brand,
  round(fsum(CASE WHEN NOT regexp_matches(p_name, 'blue', 'i') THEN s
                WHEN regexp_matches(p_name, 'blue', 'i') THEN s * 0.0::DOUBLE ELSE 0 END), 4) AS acq_kw,
  round(fsum(CASE WHEN regexp_matches(p_name, 'blue', 'i') THEN s * 1.0::DOUBLE ELSE 0 END), 4) AS ret_kw
FROM x GROUP BY 1"""


@query("cutover_sources")
def q_cutover_sources(spark, sf):
    o = tables(spark, sf)["orders"]
    aggs = {"orders": count_(), "revenue": sum_(money("o_totalprice"))}
    old = granularity_rollup(o.filter(F.col("o_orderstatus") == "F"), "o_orderdate", [], aggs)
    new = granularity_rollup(o.filter(F.col("o_orderstatus") != "F"), "o_orderdate", [], aggs)
    return cutover(old, new, "1998-06-30")


SQL["cutover_sources"] = "SELECT * FROM (" + per_grain(
    "SELECT " + trunc("{g}", "o_orderdate") + " AS date, '{g}' AS date_granularity, "
    "COUNT(*) AS orders, SUM(floor(o_totalprice)::DOUBLE) AS revenue FROM orders "
    "WHERE o_orderstatus = 'F' GROUP BY 1, 2") + ") WHERE date <= DATE '1998-06-30'\nUNION ALL\n" \
    "SELECT * FROM (" + per_grain(
    "SELECT " + trunc("{g}", "o_orderdate") + " AS date, '{g}' AS date_granularity, "
    "COUNT(*) AS orders, SUM(floor(o_totalprice)::DOUBLE) AS revenue FROM orders "
    "WHERE o_orderstatus != 'F' GROUP BY 1, 2") + ") WHERE date > DATE '1998-06-30'"


# ------------------------------------------------------------ R23, R24, M5 --

def _region_of():
    return (F.when(F.col("r_name") == "AMERICA", F.lit("US"))
            .when(F.col("r_name") == "ASIA", F.lit("AUS"))
            .when(F.col("r_name") == "EUROPE", F.lit("UK"))
            .when(F.col("r_name") == "AFRICA", F.lit("EU")).otherwise(F.lit("Other")))


@query("regional_paid_spend")
def q_regional_paid_spend(spark, sf):
    ro = _region_orders(tables(spark, sf)).select(
        _od().alias("date"), F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("campaign_name"), _region_of().alias("region"),
        money("o_totalprice").alias("spend"))
    from blendwise.operators import regional_paid_spend
    ro = ro.withColumns({"revenue": F.lit(0.0), "purchases": F.lit(0)})
    name, status, region = F.col("campaign_name"), F.col("status"), F.col("region")
    core = region.isin("US", "AUS") & not_imatch(name, "not specified")
    other = region.isin("EU", "UK")
    s = F.col("spend")
    branches = [
        {"df": ro, "where": (status == "F") & core,
         "paid": F.when(not_imatch(name, "urgent") & ~name.isin("5-LOW"), s).otherwise(F.lit(0.0))},
        {"df": ro, "where": (status == "O") & core,
         "paid": F.when(not_imatch(name, "high"), s).otherwise(F.lit(0.0))},
        {"df": ro, "where": status.isin("F", "O") & other},
        {"df": ro, "where": (status == "P") & region.isin("US", "AUS", "UK")},
    ]
    return regional_paid_spend(branches).select("region", "date", "spend", "paid_spend")


SQL["regional_paid_spend"] = """
WITH ro AS (
  SELECT CAST(o_orderdate AS DATE) AS date, o_orderstatus AS status,
         o_orderpriority AS campaign_name,
         CASE r_name WHEN 'AMERICA' THEN 'US' WHEN 'ASIA' THEN 'AUS' WHEN 'EUROPE' THEN 'UK'
                     WHEN 'AFRICA' THEN 'EU' ELSE 'Other' END AS region,
         floor(o_totalprice)::DOUBLE AS spend
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey),
s AS (
  SELECT region, date, spend,
         CASE WHEN NOT regexp_matches(campaign_name, 'urgent', 'i')
                   AND campaign_name NOT IN ('5-LOW') THEN spend ELSE 0.0 END AS paid_spend
  FROM ro WHERE status = 'F' AND region IN ('US', 'AUS')
    AND NOT regexp_matches(campaign_name, 'not specified', 'i')
  UNION ALL
  SELECT region, date, spend,
         CASE WHEN NOT regexp_matches(campaign_name, 'high', 'i') THEN spend ELSE 0.0 END
  FROM ro WHERE status = 'O' AND region IN ('US', 'AUS')
    AND NOT regexp_matches(campaign_name, 'not specified', 'i')
  UNION ALL
  SELECT region, date, spend, spend FROM ro WHERE status IN ('F', 'O') AND region IN ('EU', 'UK')
  UNION ALL
  SELECT region, date, spend, spend FROM ro WHERE status = 'P' AND region IN ('US', 'AUS', 'UK'))
SELECT region, date, COALESCE(SUM(spend), 0) AS spend, COALESCE(SUM(paid_spend), 0) AS paid_spend
FROM s WHERE region != 'Other' GROUP BY 1, 2"""


@query("micro_units")
def q_micro_units(spark, sf):
    o = tables(spark, sf)["orders"]
    micro = F.floor("o_totalprice").cast("long") * F.lit(1_000_000)
    return o.groupBy(_month(_od()).alias("date")).agg(F.sum(micro_units(micro)).alias("spend"))


SQL["micro_units"] = f"""
SELECT {trunc('month', 'o_orderdate')} AS date,
       SUM(CAST(CAST(floor(o_totalprice) AS BIGINT) * 1000000 AS DOUBLE) / 1000000.0::DOUBLE) AS spend
FROM orders GROUP BY 1"""


@query("parse_money")
def q_parse_money(spark, sf):
    o = tables(spark, sf)["orders"]
    text = F.when(F.col("o_orderstatus") == "P", F.lit("")).otherwise(
        F.concat(F.lit("$"), F.format_number("o_totalprice", 2)))
    return rounded(o.withColumn("cost", text).groupBy(_month(_od()).alias("date"))
                   .agg(exact_sum(parse_money("cost")).alias("spend"),
                        count_unparsed("cost").cast("long").alias("unparsed")))


SQL["parse_money"] = f"""
WITH x AS (SELECT o_orderdate,
                  CASE WHEN o_orderstatus = 'P' THEN ''
                       ELSE '$' || format('{{:,.2f}}', o_totalprice) END AS cost FROM orders)
SELECT {trunc('month', 'o_orderdate')} AS date,
       round(fsum(TRY_CAST(replace(replace(cost, '$', ''), ',', '') AS DOUBLE)), 4) AS spend,
       CAST(SUM(CASE WHEN cost IS NOT NULL
                      AND TRY_CAST(replace(replace(cost, '$', ''), ',', '') AS DOUBLE) IS NULL
                     THEN 1 ELSE 0 END) AS BIGINT) AS unparsed
FROM x GROUP BY 1"""


# ------------------------------------------------------------ R25-R27 --

@query("order_counts_distinct")
def q_order_counts_distinct(spark, sf):
    li = tables(spark, sf)["lineitem"].withColumn("date", _month(_sd()))
    return order_counts(li, ["date"], "l_orderkey", F.col("l_linenumber") == 1)


SQL["order_counts_distinct"] = f"""
SELECT {trunc('month', 'l_shipdate')} AS date, COUNT(DISTINCT l_orderkey) AS orders,
       COUNT(DISTINCT CASE WHEN l_linenumber = 1 THEN l_orderkey END) AS first_orders
FROM lineitem GROUP BY 1"""


@query("tax_net_revenue")
def q_tax_net_revenue(spark, sf):
    li = tables(spark, sf)["lineitem"]
    amount = money("l_extendedprice")
    tax = money(F.col("l_extendedprice") * F.col("l_tax"))
    total = money(F.col("l_extendedprice") * F.col("l_discount"))
    return rounded(li.groupBy(_month(_sd()).alias("date")).agg(
        exact_sum(tax_net(amount, tax, total)).alias("net_revenue")))


SQL["tax_net_revenue"] = f"""
WITH x AS (SELECT l_shipdate, floor(l_extendedprice)::DOUBLE AS amount,
                  floor(l_extendedprice * l_tax)::DOUBLE AS tax,
                  floor(l_extendedprice * l_discount)::DOUBLE AS total FROM lineitem)
SELECT {trunc('month', 'l_shipdate')} AS date,
       round(fsum(amount * (1 - COALESCE(tax / NULLIF(total, 0), 0))), 4)
         AS net_revenue
FROM x GROUP BY 1"""

# Product families for the driver query: exact title, title list, pattern, bundle.
_FAMILIES = {
    "ring_units": [{"title": "small ring"}, {"title": "red ring", "multiplier": 3}],
    "gear_units": [{"pattern": "GEAR"}],
    "widget_units": [{"titles": ["blue widget", "red widget"]}],
}


@query("product_units_bundle")
def q_product_units_bundle(spark, sf):
    t = tables(spark, sf)
    lp = t["lineitem"].join(t["part"], F.col("l_partkey") == F.col("p_partkey"), "inner")
    units = product_units("p_name", F.col("l_quantity").cast("long"), _FAMILIES)
    return lp.groupBy(_month(_sd()).alias("date")).agg(*[c.alias(n) for n, c in units.items()])


SQL["product_units_bundle"] = f"""
SELECT {trunc('month', 'l_shipdate')} AS date,
  CAST(SUM(CASE WHEN p_name = 'small ring' THEN CAST(l_quantity AS BIGINT)
                WHEN p_name = 'red ring' THEN CAST(l_quantity AS BIGINT) * 3 ELSE 0 END) AS BIGINT)
    AS ring_units,
  CAST(SUM(CASE WHEN regexp_matches(p_name, 'GEAR', 'i') THEN CAST(l_quantity AS BIGINT) ELSE 0 END)
       AS BIGINT) AS gear_units,
  CAST(SUM(CASE WHEN p_name IN ('blue widget', 'red widget') THEN CAST(l_quantity AS BIGINT)
                ELSE 0 END) AS BIGINT) AS widget_units
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1"""
