"""More report models on the driver tables, with their SQL oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from blendwise.functions.aggs import count_, sum_
from blendwise.operators.calendar import granularity_rollup
from blendwise.plans import reports, roles
from blendwise.plans.driver_facts import ad_period
from blendwise.plans.oracle import GRAIN_LIST, ORDERS_FIRST_CTE, SQL, period_start
from blendwise.plans.queries import grain_by_grain, query, report_query, tables
from blendwise.plans.roles import money

_SWITCH = "1998-06-30"
_AS_OF = "2001-12-31"


# ----------------------------------------------------- actual_goal_stretch --

def _daily_orders(t):
    fo = roles.first_orders(t)
    first, p = F.col("is_first"), F.col("o_totalprice")
    return fo, first, p


def _goal_sheet(t, factor):
    fo, first, p = _daily_orders(t)
    return fo.groupBy(F.col("o_orderdate").cast("date").alias("date")).agg(
        F.sum(money(p * F.lit(0.3 * factor))).alias("spend"),
        F.sum(money(p * F.lit(0.1 * factor))).alias("acq_spend"),
        F.sum(first.cast("long")).alias("ft_orders"),
        F.sum(F.when(first, money(p)).otherwise(0.0)).alias("ft_revenue"),
        F.sum(F.when(~first, money(p * F.lit(factor))).otherwise(0.0)).alias("ret_revenue"),
        F.sum((~first).cast("long")).alias("ret_orders"))


@report_query("actual_goal_stretch")
def q_actual_goal_stretch(spark, t, **options):
    fo, first, p = _daily_orders(t)
    day = F.col("o_orderdate").cast("date").alias("date")
    cost = money(p * F.lit(0.05))
    affiliate_old = fo.groupBy(day).agg(
        F.sum(F.when(first, cost).otherwise(0.0)).alias("ft_spend"),
        F.sum(F.when(~first, cost).otherwise(0.0)).alias("ret_spend"))
    status = (F.when(first, F.lit("New")).when(F.col("o_orderstatus") == "P", F.lit("Other"))
              .otherwise(F.lit("Existing")))
    affiliate_new = granularity_rollup(
        fo, "o_orderdate", [status.alias("customer_status")],
        {"action_cost": sum_(cost), "actions": count_(), "revenue": sum_(money(p))})
    bi = fo.groupBy(day).agg(
        F.sum(first.cast("long")).alias("ft_orders"),
        F.sum(F.when(first, money(p)).otherwise(0.0)).alias("ft_sales"),
        F.sum(F.when(~first, money(p)).otherwise(0.0)).alias("ret_sales"),
        F.sum(money(p)).alias("total_sales"), F.sum((~first).cast("long")).alias("ret_orders"))
    return reports.actual_goal_stretch(
        {"meta": ad_period(t, ["R"], ["campaign_name"]),
         "google": ad_period(t, ["A"], ["campaign_name"]), "pinterest": ad_period(t, ["N"]),
         "affiliate_old": affiliate_old, "affiliate_new": affiliate_new, "bi": bi,
         "goal": _goal_sheet(t, 1.0), "stretch": _goal_sheet(t, 1.2)},
        as_of=_AS_OF, switch_date=_SWITCH, social_retention_pattern="0$",
        search_brand_pattern="[13579]$", brand_acq_share=0.25, **options)


SQL["actual_goal_stretch"] = f"""
WITH {GRAIN_LIST},
{ORDERS_FIRST_CTE},
pattern(flag, hit_pattern) AS (VALUES ('R', '0$'), ('A', '[13579]$'), ('N', NULL)),
split(flag, hit, to_acq, to_ret) AS (VALUES
  ('R', 'yes', 0.0, 1.0), ('R', 'no', 1.0, 0.0), ('R', 'unnamed', 0.0, 0.0),
  ('A', 'yes', 0.25, 0.75), ('A', 'no', 1.0, 0.0), ('A', 'unnamed', NULL, 0.0),
  ('N', 'unnamed', 1.0, 0.0)),
sheet(data_type, spend_share, acq_share, growth, counts_returning) AS (VALUES
  ('Goal', 0.3::DOUBLE, 0.1::DOUBLE, 1.0::DOUBLE, 1),
  ('Stretch', {0.3 * 1.2!r}::DOUBLE, {0.1 * 1.2!r}::DOUBLE, 1.2::DOUBLE, 0)),
named AS (
  SELECT lineitem.*, hit_pattern, CASE WHEN s_acctbal >= 0 THEN s_name END AS campaign
  FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN part ON p_partkey = l_partkey
  JOIN pattern ON flag = l_returnflag),
ad AS (
  SELECT CAST(l_shipdate AS DATE) AS d, floor(l_extendedprice)::DOUBLE AS cost, to_acq::DOUBLE AS to_acq,
         to_ret::DOUBLE AS to_ret, CAST(l_quantity AS BIGINT) AS clicks, (l_linestatus = 'F')::BIGINT AS bought,
         floor(l_extendedprice * (1 - l_discount))::DOUBLE AS income
  FROM named JOIN split ON flag = l_returnflag AND hit = CASE regexp_matches(campaign, hit_pattern, 'i')
    WHEN TRUE THEN 'yes' WHEN FALSE THEN 'no' ELSE 'unnamed' END),
sold AS (
  SELECT g, {period_start('g', 'o_orderdate')} AS start, is_first, NOT is_first AS again, o_orderstatus = 'P' AS other,
         o_totalprice AS price, floor(o_totalprice)::DOUBLE AS sales, floor(o_totalprice * 0.05::DOUBLE)::DOUBLE AS fee
  FROM o_first, grain_list),
fact AS (
  SELECT {period_start('g', 'd')} AS start, g, 'Actual' AS kind, cost, cost * to_acq AS acq, cost * to_ret AS ret,
         1 AS shown, clicks, bought, income, NULL::BIGINT AS n_new, NULL::DOUBLE AS new_sales,
         NULL::DOUBLE AS more_sales, NULL::DOUBLE AS all_sales, NULL::BIGINT AS n_more
  FROM ad, grain_list
  UNION ALL
  SELECT start, g, 'Actual', fee, is_first::INT * fee, (again AND NOT (other AND start > DATE '{_SWITCH}'))::INT * fee,
         0, 0, (start > DATE '{_SWITCH}')::BIGINT, (start > DATE '{_SWITCH}')::INT * sales,
         is_first::BIGINT, is_first::INT * sales, again::INT * sales, sales, again::BIGINT
  FROM sold
  UNION ALL
  SELECT start, g, data_type, floor(price * spend_share)::DOUBLE, floor(price * acq_share)::DOUBLE,
         floor(price * spend_share)::DOUBLE - floor(price * acq_share)::DOUBLE, NULL, NULL, NULL, NULL,
         is_first::BIGINT, is_first::INT * sales, again::INT * floor(price * growth)::DOUBLE,
         CASE WHEN is_first THEN sales ELSE floor(price * growth)::DOUBLE END, again::BIGINT * counts_returning
  FROM sold, sheet)
SELECT start AS date, g AS date_granularity, kind AS data_type, SUM(cost) AS spend, SUM(acq) AS acq_spend,
       SUM(ret) AS ret_spend, CAST(SUM(shown) AS BIGINT) AS impressions, CAST(SUM(clicks) AS BIGINT) AS clicks,
       CAST(SUM(bought) AS BIGINT) AS purchases, SUM(income) AS revenue, CAST(SUM(n_new) AS BIGINT) AS acquisitions,
       SUM(new_sales) AS first_time_sales, SUM(more_sales) AS repurchase_sales, SUM(all_sales) AS total_sales,
       CAST(SUM(n_more) AS BIGINT) AS repurchase_orders
FROM fact WHERE start <= DATE '{_AS_OF}' GROUP BY ALL"""


# -------------------------------------------------------- app_install_blend --

# App platform rules for the driver query: supplier-name patterns (first match wins).
_APP_RULES = [("[02468]$", "iOS"), ("[13]$", "Android"), ("5$", "Web")]


def _mmp(t):
    li, s = t["lineitem"], t["supplier"]
    src = (F.when(F.col("l_returnflag") == "R", F.lit("Facebook Ads"))
           .when(F.col("l_returnflag") == "A", F.lit("googleadwords_int"))
           .when(F.col("l_linestatus") == "F", F.lit("af_app_invites")).otherwise(F.lit("organic")))
    return (li.join(s, F.col("l_suppkey") == F.col("s_suppkey"), "inner").select(
        F.col("l_shipdate").cast("date").alias("date"),
        F.when(F.col("l_linenumber") % 2 == 0, F.lit("iOS")).otherwise(F.lit("Android")).alias("app"),
        src.alias("source"), F.col("s_name").alias("campaign_name"),
        F.lit(1).alias("sessions"), F.when(F.col("l_linenumber") <= 3, 1).otherwise(0).alias("installs"),
        F.when(F.col("l_linenumber") <= 2, 1).otherwise(0).alias("rc_trial_started_users"),
        F.when(F.col("l_linenumber") == 1, 1).otherwise(0).alias("rc_trial_converted_users"),
        F.when(F.col("l_linestatus") == "F", 1).otherwise(0).alias("rc_initial_purchase_users"),
        money(F.col("l_extendedprice") * F.lit(0.01)).alias("revenue"),
        F.col("l_tax")))


_APP_MEASURES = ["spend", "link_clicks", "clicks", "impressions", "app_install", "trial_started",
                 "trial_converted", "initial_purchase", "trial_converted_value",
                 "initial_purchase_value"]


@report_query("app_install_blend")
def q_app_install_blend(spark, t, **options):
    mmp = _mmp(t)
    skan = mmp.filter(F.col("l_tax") > 0.04).select("date", "source", "campaign_name", "installs")
    dims = ["campaign_id", "campaign_name"]
    raw = (t["lineitem"].filter(F.col("l_returnflag") == "N")
           .join(t["supplier"], F.col("l_suppkey") == F.col("s_suppkey"), "inner")
           .select(F.col("l_shipdate").alias("stat_time_day"), F.col("l_suppkey").alias("campaign_id"),
                   F.col("s_name").alias("campaign_name"), money("l_extendedprice").alias("spend"),
                   F.col("l_quantity").cast("long").alias("clicks"), F.lit(1).alias("impressions"),
                   F.when(F.col("l_linenumber") <= 3, 1).otherwise(0).alias("skan_app_install"),
                   F.when(F.col("l_linenumber") <= 2, 1).otherwise(0).alias("skan_start_trial")))
    return grain_by_grain(spark, lambda grains: reports.app_install_blend(
        {"mmp": mmp, "skan": skan, "meta": ad_period(t, ["R"], dims, _APP_MEASURES, grains),
         "google": ad_period(t, ["A"], dims, _APP_MEASURES, grains), "video_raw": raw}, _APP_RULES, grains=grains, **options))


SQL["app_install_blend"] = f"""
WITH {GRAIN_LIST},
ad_rule(flag, platform, sunday) AS (VALUES ('R', 'Meta', FALSE), ('A', 'Google Ads', FALSE), ('N', 'Tiktok Ads', TRUE)),
os_rule(rank, name_pattern, os) AS (VALUES (1, '[02468]$', 'iOS'), (2, '[13]$', 'Android'), (3, '5$', 'Web')),
source_rule(flag, status, medium, own_count) AS (VALUES
  ('R', 'F', 'Meta', 0), ('R', 'O', 'Meta', 0), ('A', 'F', 'Google Ads', 0), ('A', 'O', 'Google Ads', 0),
  ('N', 'F', 'af_app_invites', 1), ('N', 'O', 'organic', 1)),
line AS (
  SELECT *, CAST(l_shipdate AS DATE) AS d, (l_linenumber <= 3)::BIGINT AS installed, (l_linenumber <= 2)::BIGINT AS tried,
         (l_linenumber = 1)::BIGINT AS stayed, (l_linestatus = 'F')::BIGINT AS bought
  FROM lineitem JOIN supplier ON s_suppkey = l_suppkey),
named AS (
  SELECT line.*, platform, sunday, CASE WHEN sunday OR s_acctbal >= 0 THEN s_name END AS campaign
  FROM line JOIN ad_rule ON flag = l_returnflag JOIN part ON p_partkey = l_partkey),
os_of AS (
  SELECT campaign, COALESCE(arg_min(os, rank), 'Other') AS os
  FROM (SELECT DISTINCT campaign FROM named) LEFT JOIN os_rule ON regexp_matches(campaign, name_pattern, 'i')
  GROUP BY campaign),
ad AS (
  SELECT platform, os, n.campaign, CAST(l_suppkey AS VARCHAR) AS id, g,
         CASE WHEN sunday THEN {period_start('g', 'd', sunday=True)} ELSE {period_start('g', 'd')} END AS start,
         SUM(floor(l_extendedprice)::DOUBLE) AS cost, SUM(CAST(l_quantity AS BIGINT)) AS clicks, COUNT(*) AS shown,
         SUM(installed) AS installed, SUM(tried) AS tried, COALESCE(SUM(stayed) FILTER (NOT sunday), 0) AS stayed,
         COALESCE(SUM(stayed * bought) FILTER (NOT sunday), 0) AS bought,
         COALESCE(SUM(floor(l_extendedprice * 0.01::DOUBLE)::DOUBLE + floor(l_extendedprice * 0.02::DOUBLE)::DOUBLE)
                  FILTER (NOT sunday), 0) AS income
  FROM named n JOIN os_of o ON o.campaign IS NOT DISTINCT FROM n.campaign, grain_list GROUP BY ALL),
entry AS (
  SELECT d, medium, CASE WHEN l_linenumber % 2 = 0 THEN 'iOS' ELSE 'Android' END AS os, s_name AS campaign,
         1 AS visits, own_count * installed AS installed, tried, stayed, bought,
         floor(l_extendedprice * 0.01::DOUBLE)::DOUBLE AS income
  FROM line JOIN source_rule ON flag = l_returnflag AND status = l_linestatus
  UNION ALL
  SELECT d, CASE sign WHEN 1 THEN medium ELSE 'af_app_invites' END, 'iOS',
         CASE WHEN sign = 1 AND medium <> 'af_app_invites' THEN s_name ELSE 'not set' END, 0, sign * installed, 0, 0, 0, 0
  FROM line JOIN source_rule ON flag = l_returnflag AND status = l_linestatus, (VALUES (1), (-1)) AS booking(sign)
  WHERE l_tax > 0.04),
used AS (
  SELECT medium AS platform, os, campaign, g, {period_start('g', 'd', sunday=True)} AS start, SUM(visits) AS visits,
         SUM(installed) AS installed, SUM(tried) AS tried, SUM(stayed) AS stayed, SUM(bought) AS bought,
         SUM(income) AS income
  FROM entry, grain_list GROUP BY ALL),
both_sides AS (
  SELECT ad.platform, ad.os, ad.campaign, ad.id, ad.start, ad.g, cost, clicks, shown, ad.installed, ad.tried, ad.stayed,
         ad.bought, ad.income, u.visits, u.installed AS u_installed, u.tried AS u_tried, u.stayed AS u_stayed,
         u.bought AS u_bought, u.income AS u_income
  FROM ad LEFT JOIN used u USING (platform, os, campaign, start, g)
  UNION ALL
  SELECT platform, os, campaign, '(not set)', start, g, 0, 0, 0, 0, 0, 0, 0, 0, visits, installed, tried, stayed,
         bought, income
  FROM used ANTI JOIN ad USING (platform, os, campaign, start, g))
SELECT platform AS channel, os AS app, campaign AS campaign_name, id AS campaign_id, start AS date,
       g AS date_granularity, SUM(cost) AS spend, CAST(SUM(clicks) AS BIGINT) AS clicks,
       CAST(SUM(shown) AS BIGINT) AS impressions, CAST(SUM(installed) AS BIGINT) AS installs,
       CAST(COALESCE(SUM(visits), 0) AS BIGINT) AS sessions, SUM(income) AS revenue,
       COALESCE(SUM(u_income), 0) AS apps_revenue, CAST(SUM(bought) AS BIGINT) AS initial_purchase,
       CAST(SUM(stayed) AS BIGINT) AS trial_converted, CAST(SUM(tried) AS BIGINT) AS trial_started,
       CAST(COALESCE(SUM(u_installed), 0) AS BIGINT) AS apps_installs,
       CAST(COALESCE(SUM(u_bought), 0) AS BIGINT) AS apps_initial_purchase,
       CAST(COALESCE(SUM(u_stayed), 0) AS BIGINT) AS apps_trial_converted,
       CAST(COALESCE(SUM(u_tried), 0) AS BIGINT) AS apps_trial_started
FROM both_sides GROUP BY ALL"""
