"""DuckDB oracle SQL for every registered driver query.

Each string is an independent formulation of the same result over the same
Parquet tables, written directly in SQL (UNION per grain, window functions,
plain joins) rather than by the Spark code path. Integer sums are cast to
BIGINT (DuckDB widens them to HUGEINT), period starts to DATE.
"""

from __future__ import annotations

GRAINS = ("day", "week", "month", "quarter", "year")

SQL: dict[str, str] = {}


def per_grain(template: str, grains=GRAINS) -> str:
    """``UNION ALL`` of a SELECT written with ``{g}`` for the grain name."""
    return "\nUNION ALL\n".join(template.format(g=g) for g in grains)


def trunc(g: str, col: str) -> str:
    return f"CAST(date_trunc('{g}', CAST({col} AS DATE)) AS DATE)"


GRAIN_LIST = "grain_list AS (SELECT unnest([" + ", ".join(f"'{g}'" for g in GRAINS) + "]) AS g)"


def period_start(g: str, col: str, sunday: bool = False) -> str:
    """Start of the period that holds ``col``, for a column ``g`` of grain names."""
    if sunday:
        return (f"CASE {g} WHEN 'week' THEN CAST(date_trunc('week', CAST({col} AS DATE) + 1) AS DATE) - 1 "
                f"ELSE CAST(date_trunc({g}, CAST({col} AS DATE)) AS DATE) END")
    return f"CAST(date_trunc({g}, CAST({col} AS DATE)) AS DATE)"


def sunday_week(col: str) -> str:
    return f"CAST(date_trunc('week', CAST({col} AS DATE) + 1) AS DATE) - 1"


# ------------------------------------------------------------------ roles --

NAMES_CTE = """names AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS campaign_id,
         CASE WHEN s_acctbal >= 0 THEN s_name END AS campaign_name
  FROM supplier)"""

AD_LINES_CTE = """ad_lines AS (
  SELECT l_returnflag AS flag, CAST(l_shipdate AS DATE) AS d,
         CAST(l_suppkey AS VARCHAR) AS campaign_id,
         CAST(floor(l_extendedprice) AS DOUBLE) AS spend,
         CAST(l_quantity AS BIGINT) AS link_clicks,
         CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS purchases,
         CAST(floor(l_extendedprice * (1 - l_discount)) AS DOUBLE) AS revenue,
         l_partkey
  FROM lineitem)"""


def ads_cte(grains=GRAINS) -> str:
    body = per_grain(
        "  SELECT flag, " + trunc("{g}", "d") + " AS date, '{g}' AS date_granularity, campaign_id,\n"
        "         SUM(spend) AS spend, CAST(SUM(link_clicks) AS BIGINT) AS link_clicks,\n"
        "         COUNT(*) AS impressions, CAST(SUM(purchases) AS BIGINT) AS purchases,\n"
        "         SUM(revenue) AS revenue\n"
        "  FROM ad_lines GROUP BY 1, 2, 3, 4", grains)
    return f"""ads_raw AS (
{body}),
ads AS (
  SELECT a.flag, a.date, a.date_granularity, a.campaign_id, n.campaign_name, a.spend,
         a.link_clicks, a.link_clicks AS clicks, a.impressions, a.purchases, a.revenue
  FROM ads_raw a LEFT JOIN names n USING (campaign_id))"""


WEB_DAILY_CTE = """web_daily AS (
  SELECT CAST(l_shipdate AS DATE) AS date, CAST(l_suppkey AS VARCHAR) AS campaign_id,
         COUNT(*) AS sessions,
         COUNT(CASE WHEN l_linestatus = 'O' THEN 1 END) AS engaged_sessions,
         CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS ga4_purchases,
         SUM(CAST(floor(l_extendedprice) AS DOUBLE)) AS ga4_revenue
  FROM lineitem WHERE l_returnflag = 'N' GROUP BY 1, 2)"""

ORDERS_FIRST_CTE = """o_first AS (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1
            AS is_first
  FROM orders)"""


def fee_sql(rows: str, switch: str) -> str:
    """``rows`` (a SELECT) with the monthly fee pool shared out by spend, from three rule tables.

    A row's part of its month's spend, per channel, market and breakdown, times the pool for
    its grain; campaigns of the fee's kind also carry the uplift.
    """
    return f"""
WITH spent AS ({rows}),
kind_rule(channel, market, campaign_type) AS (VALUES ('Google Ads', 'US', 'Demand Gen'), ('Google Ads', 'US', 'Youtube')),
pool_rule(first_day, pool) AS (VALUES (DATE '0001-01-01', 10000.0::DOUBLE), (DATE '{switch}', 17000.0::DOUBLE)),
span_rule(date_granularity, months, days) AS (VALUES ('day', NULL, 1), ('week', NULL, 7), ('month', 1, NULL), ('quarter', 3, NULL), ('year', 12, NULL)),
sorted AS (
  SELECT s.*, CAST(date_trunc('month', date) AS DATE) AS month_start,
         CASE WHEN k.channel IS NOT NULL AND google_campaign IS NOT NULL THEN
           CASE WHEN regexp_matches(google_campaign, 'image', 'i') THEN 'image' ELSE 'video' END END AS kind
  FROM spent s LEFT JOIN kind_rule k ON k.channel = s.channel AND k.market = s.market AND k.campaign_type = s.campaign_type),
month_total AS (
  SELECT month_start, channel, market, kind IS NOT DISTINCT FROM 'video' AS video, SUM(spend) AS total FROM sorted GROUP BY ALL)
SELECT s.* EXCLUDE (kind), p.pool AS monthly_fee_pool, total AS total_spend,
       CAST(s.month_start + INTERVAL 1 MONTH AS DATE) - s.month_start AS days_in_month,
       CAST(date_trunc('quarter', date) + INTERVAL 3 MONTH AS DATE) - CAST(date_trunc('quarter', date) AS DATE) AS days_in_quarter,
       CAST(date_trunc('year', date) + INTERVAL 1 YEAR AS DATE) - CAST(date_trunc('year', date) AS DATE) AS days_in_year,
       CASE WHEN t.video THEN 'DG Video' ELSE 'Other' END AS dg_breakdown,
       CASE kind WHEN 'video' THEN spend * 1.02565::DOUBLE + spend / NULLIF(total, 0) * COALESCE(
                   pool * months, pool / (CAST(s.month_start + INTERVAL 1 MONTH AS DATE) - s.month_start) * days)
                 WHEN 'image' THEN spend * 1.02565::DOUBLE ELSE 0 END AS spend_with_fees
FROM sorted s
JOIN month_total t ON t.month_start = s.month_start AND t.channel IS NOT DISTINCT FROM s.channel AND t.market IS NOT DISTINCT FROM s.market
  AND t.video = (kind IS NOT DISTINCT FROM 'video')
ASOF JOIN pool_rule p ON date >= p.first_day
LEFT JOIN span_rule USING (date_granularity)"""


def store_cte(grains=GRAINS) -> str:
    body = per_grain(
        "  SELECT " + trunc("{g}", "d") + " AS date, '{g}' AS date_granularity,\n"
        "    COUNT(*) AS orders, CAST(SUM(CAST(is_first AS BIGINT)) AS BIGINT) AS first_orders,\n"
        "    SUM(gross) AS gross_sales, SUM(net) AS net_sales, SUM(gross - disc) AS total_net_sales,\n"
        "    SUM(CASE WHEN is_first THEN gross ELSE 0.0 END) AS first_order_gross_sales,\n"
        "    SUM(CASE WHEN is_first THEN net ELSE 0.0 END) AS first_order_net_sales,\n"
        "    SUM(CASE WHEN is_first THEN gross ELSE 0.0 END - CASE WHEN is_first THEN disc ELSE 0.0 END)"
        " AS first_order_total_net_sales,\n"
        "    SUM(disc) AS subtotal_discount, SUM(refund) AS subtotal_refund,\n"
        "    SUM(0.0) AS shipping_refunds, SUM(floor(refund / 2)) AS tax_refunds,\n"
        "    SUM(CASE WHEN is_first THEN refund ELSE 0.0 END) AS first_order_subtotal_refund,\n"
        "    SUM(0.0) AS first_order_shipping_refunds,\n"
        "    SUM(floor(CASE WHEN is_first THEN refund ELSE 0.0 END / 2)) AS first_order_tax_refunds\n"
        "  FROM store_src GROUP BY 1, 2", grains)
    return f"""{ORDERS_FIRST_CTE},
store_src AS (
  SELECT CAST(o_orderdate AS DATE) AS d, is_first,
         CAST(floor(o_totalprice) AS DOUBLE) AS gross,
         CAST(floor(o_totalprice * CAST(0.9 AS DOUBLE)) AS DOUBLE) AS net,
         CAST(floor(o_totalprice * CAST(0.05 AS DOUBLE)) AS DOUBLE) AS disc,
         CAST(floor(o_totalprice * CAST(0.02 AS DOUBLE)) AS DOUBLE) AS refund
  FROM o_first),
store AS (
{body})"""


def _sql(name: str):
    def deco(fn):
        SQL[name] = fn()
        return fn
    return deco
