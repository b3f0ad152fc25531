"""One driver query per operator recipe, each with its DuckDB oracle.

Roles: ``lineitem`` lines are ad rows / clicks / touches (return flag = platform,
supplier = campaign, ship date = day), ``orders`` is the store, ``part`` names
are campaign or product names, ``events`` is web analytics and CRM.
Money is summed as whole numbers (``floor``) or as decimals, so both engines
produce identical digits.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from blendwise.functions.aggs import count_, sum_
from blendwise.functions.columns import typed_null
from blendwise.functions.dates import period_start
from blendwise.operators import (
    active_rows, attribute_measures, bucket_exact, campaign_dimension, cap_at, classify,
    granularity_rollup, label_unpaid, linear_attribution, lookback, normalise_channel, repair_names,
    sales_components, soft_delete, stack_channels,
)
from blendwise.plans import roles
from blendwise.plans.oracle import (
    ORDERS_FIRST_CTE, SQL, per_grain, sunday_week, trunc,
)
from blendwise.plans.queries import query, tables
from blendwise.plans.roles import money, rounded


def _sd():
    return F.col("l_shipdate").cast("date")


def _od():
    return F.col("o_orderdate").cast("date")


def _month(c):
    return period_start(c, "month")


# ---------------------------------------------------------------- R1, R2 --

@query("granularity_rollup")
def q_granularity_rollup(spark, sf):
    o = tables(spark, sf)["orders"]
    return granularity_rollup(o, "o_orderdate", [F.col("o_orderstatus").alias("status")],
                              {"orders": count_(), "revenue": sum_(money("o_totalprice"))})


SQL["granularity_rollup"] = per_grain(
    "SELECT " + trunc("{g}", "o_orderdate") + " AS date, '{g}' AS date_granularity, "
    "o_orderstatus AS status, COUNT(*) AS orders, SUM(floor(o_totalprice)::DOUBLE) AS revenue "
    "FROM orders GROUP BY 1, 2, 3")


@query("granularity_rollup_sunday")
def q_granularity_rollup_sunday(spark, sf):
    o = tables(spark, sf)["orders"]
    return granularity_rollup(o, "o_orderdate", [F.col("o_orderpriority").alias("priority")],
                              {"orders": count_(), "revenue": sum_(money("o_totalprice"))},
                              grains=["week"], week_start="sunday")


SQL["granularity_rollup_sunday"] = (
    "SELECT " + sunday_week("o_orderdate") + " AS date, 'week' AS date_granularity, "
    "o_orderpriority AS priority, COUNT(*) AS orders, SUM(floor(o_totalprice)::DOUBLE) AS revenue "
    "FROM orders GROUP BY 1, 2, 3")


# ------------------------------------------------------------ R3, P1-P4 --

_STACK_CONTRACT = [("channel", "string"), ("market", "string"), ("date", "date"),
                   ("spend", "double"), ("clicks", "bigint"), ("paid_purchases", "bigint")]
_STACK_MEASURES = ["spend", "clicks", "paid_purchases"]


def _platform_frames(t):
    li = t["lineitem"]
    meta = li.filter(F.col("l_returnflag") == "R").select(
        _sd().alias("date"), money("l_extendedprice").alias("spend"),
        F.col("l_quantity").cast("long").alias("link_clicks"),
        F.when(F.col("l_linestatus") == "F", 1).otherwise(0).alias("purchases"),
        F.col("l_linestatus").alias("account"))
    google = li.filter(F.col("l_returnflag") == "A").select(
        _sd().alias("date"), money("l_extendedprice").alias("spend"),
        F.col("l_quantity").cast("long").alias("clicks"),
        F.when(F.col("l_linestatus") == "F", 1).otherwise(0).alias("conversions"))
    video = li.filter(F.col("l_returnflag") == "N").select(
        _sd().alias("date"), money("l_extendedprice").alias("cost"),
        F.col("l_quantity").cast("long").alias("clicks"))
    return meta, google, video


def _stacked(t):
    meta, google, video = _platform_frames(t)
    return stack_channels([
        {"df": meta, "rename": {"link_clicks": "clicks", "purchases": "paid_purchases",
                                "account": "market"}, "const": {"channel": "Meta"}},
        {"df": google, "rename": {"conversions": "paid_purchases"},
         "const": {"channel": "Google Ads", "market": "US"}},
        {"df": video, "rename": {"cost": "spend"}, "const": {"channel": "Video"}},
    ], _STACK_CONTRACT, _STACK_MEASURES)


@query("stack_channels")
def q_stack_channels(spark, sf):
    return (_stacked(tables(spark, sf))
            .groupBy("channel", _month("date").alias("date"))
            .agg(F.sum("spend").alias("spend"), F.sum("clicks").alias("clicks"),
                 F.sum("paid_purchases").alias("paid_purchases")))


_STACK_SQL = """stacked AS (
  SELECT 'Meta' AS channel, l_linestatus AS market, CAST(l_shipdate AS DATE) AS date,
         floor(l_extendedprice)::DOUBLE AS spend, CAST(l_quantity AS BIGINT) AS clicks,
         CAST(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS BIGINT) AS paid_purchases
  FROM lineitem WHERE l_returnflag = 'R'
  UNION ALL
  SELECT 'Google Ads', 'US', CAST(l_shipdate AS DATE), floor(l_extendedprice)::DOUBLE,
         CAST(l_quantity AS BIGINT), CAST(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS BIGINT)
  FROM lineitem WHERE l_returnflag = 'A'
  UNION ALL
  SELECT 'Video', NULL, CAST(l_shipdate AS DATE), floor(l_extendedprice)::DOUBLE,
         CAST(l_quantity AS BIGINT), CAST(0 AS BIGINT)
  FROM lineitem WHERE l_returnflag = 'N')"""

SQL["stack_channels"] = f"""WITH {_STACK_SQL}
SELECT channel, {trunc('month', 'date')} AS date, SUM(spend) AS spend,
       CAST(SUM(clicks) AS BIGINT) AS clicks, CAST(SUM(paid_purchases) AS BIGINT) AS paid_purchases
FROM stacked GROUP BY 1, 2"""


@query("align_zero_pad")
def q_align_zero_pad(spark, sf):
    s = _stacked(tables(spark, sf))
    return (s.groupBy("channel", "market", F.year("date").cast("long").alias("year"))
            .agg(F.count(F.lit(1)).alias("rows"), F.sum("paid_purchases").alias("paid_purchases"),
                 F.sum("spend").alias("spend")))


SQL["align_zero_pad"] = f"""WITH {_STACK_SQL}
SELECT channel, market, CAST(year(date) AS BIGINT) AS year, COUNT(*) AS rows,
       CAST(SUM(paid_purchases) AS BIGINT) AS paid_purchases, SUM(spend) AS spend
FROM stacked GROUP BY 1, 2, 3"""


# ------------------------------------------------------------ R4, R5, R6 --

# Rule lists for the driver queries (part names play campaign names).
_KEYWORD_RULES = [("small ring", "Small Ring"), ("ring", "Ring"), ("^red", "Red"),
                  ("widget|gizmo", "Gadget")]


def _lines_parts(t):
    return t["lineitem"].join(t["part"], F.col("l_partkey") == F.col("p_partkey"), "inner")


@query("classify_keywords")
def q_classify_keywords(spark, sf):
    lp = _lines_parts(tables(spark, sf))
    return (lp.groupBy(classify("p_name", _KEYWORD_RULES, "Other").alias("label"))
            .agg(F.count(F.lit(1)).alias("lines"),
                 F.sum(F.col("l_quantity").cast("long")).alias("quantity")))


SQL["classify_keywords"] = """
SELECT CASE WHEN regexp_matches(p_name, 'small ring', 'i') THEN 'Small Ring'
            WHEN regexp_matches(p_name, 'ring', 'i') THEN 'Ring'
            WHEN regexp_matches(p_name, '^red', 'i') THEN 'Red'
            WHEN regexp_matches(p_name, 'widget|gizmo', 'i') THEN 'Gadget'
            ELSE 'Other' END AS label,
       COUNT(*) AS lines, CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1"""

_BUCKETS = {"Big": ["LARGE", "MEDIUM"], "Small": ["SMALL"]}


@query("bucket_exact")
def q_bucket_exact(spark, sf):
    lp = _lines_parts(tables(spark, sf))
    return (lp.groupBy(bucket_exact("p_type", _BUCKETS, "Other").alias("bucket"))
            .agg(F.count(F.lit(1)).alias("lines"),
                 F.sum(money("l_extendedprice")).alias("spend")))


SQL["bucket_exact"] = """
SELECT CASE WHEN p_type IN ('LARGE', 'MEDIUM') THEN 'Big' WHEN p_type = 'SMALL' THEN 'Small'
            ELSE 'Other' END AS bucket,
       COUNT(*) AS lines, SUM(floor(l_extendedprice)::DOUBLE) AS spend
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1"""

_CHANNEL_RULES = [("facebook-ads", "Facebook", True), ("google-ads", "Google Ads", False)]


@query("normalise_channel")
def q_normalise_channel(spark, sf):
    li = tables(spark, sf)["lineitem"]
    src = (F.when(F.col("l_returnflag") == "R", F.lit("facebook-ads"))
           .when(F.col("l_returnflag") == "A", F.lit("google-ads")).otherwise(F.lit("other")))
    cid = F.when(F.col("l_suppkey") % 7 == 0, F.lit("")).otherwise(F.col("l_suppkey").cast("string"))
    channel, campaign = normalise_channel(src, cid, _CHANNEL_RULES)
    return (li.groupBy(channel.alias("channel"), campaign.alias("campaign_id"))
            .agg(F.count(F.lit(1)).alias("lines")))


SQL["normalise_channel"] = """
WITH t AS (
  SELECT CASE l_returnflag WHEN 'R' THEN 'facebook-ads' WHEN 'A' THEN 'google-ads'
              ELSE 'other' END AS source,
         CASE WHEN l_suppkey % 7 = 0 THEN '' ELSE CAST(l_suppkey AS VARCHAR) END AS campaign_id
  FROM lineitem)
SELECT CASE WHEN source = 'facebook-ads' AND campaign_id != '' THEN 'Facebook'
            WHEN source = 'google-ads' THEN 'Google Ads' ELSE 'Other' END AS channel,
       CASE WHEN source IN ('facebook-ads', 'google-ads') AND campaign_id != ''
            THEN campaign_id ELSE '(not set)' END AS campaign_id,
       COUNT(*) AS lines
FROM t GROUP BY 1, 2"""


# ------------------------------------------------------------ R32, R14 --

@query("repair_names")
def q_repair_names(spark, sf):
    lp = _lines_parts(tables(spark, sf))
    fixed = repair_names("p_name", [("red ", "red+"), ("small", "tiny")], cut_at=" g",
                         renames={"hot rod": "hotrod"})
    return lp.groupBy(fixed.alias("name")).agg(F.count(F.lit(1)).alias("lines"))


SQL["repair_names"] = """
SELECT CASE WHEN p_name = 'hot rod' THEN 'hotrod'
            ELSE split_part(replace(replace(p_name, 'red ', 'red+'), 'small', 'tiny'), ' g', 1)
       END AS name,
       COUNT(*) AS lines
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1"""


@query("label_unpaid")
def q_label_unpaid(spark, sf):
    t = tables(spark, sf)
    facts = (t["lineitem"].groupBy(F.col("l_partkey").alias("campaign_id"))
             .agg(F.sum(money("l_extendedprice")).alias("spend"))
             .withColumn("channel", F.lit("Paid")))
    names = t["part"].select(F.col("p_partkey").alias("campaign_id"),
                             F.when(F.col("p_size") <= 25, F.col("p_name")).alias("campaign_name"))
    blended = label_unpaid(facts.join(names, "campaign_id", "left"))
    return (blended.groupBy("channel", "campaign_name")
            .agg(F.count(F.lit(1)).alias("campaigns"), F.sum("spend").alias("spend")))


SQL["label_unpaid"] = """
WITH facts AS (SELECT l_partkey AS campaign_id, SUM(floor(l_extendedprice)::DOUBLE) AS spend
               FROM lineitem GROUP BY 1),
names AS (SELECT p_partkey AS campaign_id, CASE WHEN p_size <= 25 THEN p_name END AS campaign_name FROM part)
SELECT CASE WHEN campaign_name IS NULL THEN 'Not Paid' ELSE 'Paid' END AS channel, campaign_name,
       COUNT(*) AS campaigns, SUM(spend) AS spend
FROM facts LEFT JOIN names USING (campaign_id) GROUP BY 1, 2"""


# ------------------------------------------------------------ R7, F3, F9 --

@query("active_rows")
def q_active_rows(spark, sf):
    li = tables(spark, sf)["lineitem"].select(
        "l_returnflag", (F.col("l_discount") - F.lit(0.09)).alias("d"),
        (F.col("l_tax") - F.lit(0.07)).alias("x"), (F.col("l_quantity") - F.lit(45)).alias("q"),
        "l_quantity")
    return (active_rows(li, ["d", "x", "q"]).groupBy("l_returnflag")
            .agg(F.count(F.lit(1)).alias("lines"),
                 F.sum(F.col("l_quantity").cast("long")).alias("quantity")))


SQL["active_rows"] = """
SELECT l_returnflag, COUNT(*) AS lines, CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
FROM lineitem
WHERE (l_discount - 0.09::DOUBLE > 0 OR l_tax - 0.07::DOUBLE > 0 OR l_quantity - 45 > 0)
GROUP BY 1"""


@query("soft_delete_filter")
def q_soft_delete_filter(spark, sf):
    li = tables(spark, sf)["lineitem"].withColumn(
        "_fivetran_deleted", F.col("l_linestatus") == F.lit("F"))
    return (soft_delete(li).groupBy("l_returnflag")
            .agg(F.count(F.lit(1)).alias("lines"), F.sum(money("l_extendedprice")).alias("spend")))


SQL["soft_delete_filter"] = """
SELECT l_returnflag, COUNT(*) AS lines, SUM(floor(l_extendedprice)::DOUBLE) AS spend
FROM lineitem WHERE (l_linestatus = 'F') = FALSE GROUP BY 1"""


@query("lookback_filter")
def q_lookback_filter(spark, sf):
    t = tables(spark, sf)
    j = t["lineitem"].join(t["orders"], F.col("l_orderkey") == F.col("o_orderkey"), "left")
    kept = j.filter(lookback(_sd(), _od()))
    return (kept.groupBy(_month(_od()).alias("date"))
            .agg(F.count(F.lit(1)).alias("lines"),
                 F.count_distinct("l_orderkey").alias("orders")))


SQL["lookback_filter"] = f"""
SELECT {trunc('month', 'o_orderdate')} AS date, COUNT(*) AS lines,
       COUNT(DISTINCT l_orderkey) AS orders
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
WHERE CAST(l_shipdate AS DATE) >= CAST(o_orderdate AS DATE) - 28
GROUP BY 1"""


@query("date_range_as_of")
def q_date_range_as_of(spark, sf):
    o = tables(spark, sf)["orders"].withColumn("date", _od())
    kept = cap_at(o, as_of="1998-12-31", start="1996-01-01")
    return kept.groupBy(_month("date").alias("date")).agg(F.count(F.lit(1)).alias("orders"))


SQL["date_range_as_of"] = f"""
SELECT {trunc('month', 'o_orderdate')} AS date, COUNT(*) AS orders FROM orders
WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1998-12-31' GROUP BY 1"""


# ------------------------------------------------------------ R8-R11, R13 --

def _attributed(t):
    return linear_attribution(roles.touches(t), roles.attribution_orders(t),
                              roles.ATTRIBUTION_CHANNELS)


_TOUCH_SQL = """touches AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id,
         CASE l_returnflag WHEN 'R' THEN 'facebook-ads' WHEN 'A' THEN 'google-ads'
              ELSE 'applovin' END AS source,
         CASE WHEN l_linenumber = 7 THEN '' ELSE CAST(l_suppkey AS VARCHAR) END AS campaign_id,
         l_shipdate AS click_date,
         CASE WHEN l_linenumber = 6 THEN 'ORDERS_FIRST_CLICK' ELSE 'ORDERS_LINEAR_ALL' END AS type,
         l_discount >= 0.1 AS _fivetran_deleted
  FROM lineitem),
att_orders AS (SELECT CAST(o_orderkey AS VARCHAR) AS order_id, o_orderdate AS order_date FROM orders),
tw AS (
  SELECT order_id, order_date,
         CASE WHEN source = 'facebook-ads' AND campaign_id != '' THEN 'Facebook'
              WHEN source = 'applovin' AND campaign_id != '' THEN 'App Lovin'
              WHEN source = 'google-ads' THEN 'Google Ads' ELSE 'Other' END AS channel,
         CASE WHEN source IN ('facebook-ads', 'applovin', 'google-ads') AND campaign_id != ''
              THEN campaign_id ELSE '(not set)' END AS campaign_id,
         COUNT(*) OVER (PARTITION BY order_id) AS order_index
  FROM touches LEFT JOIN att_orders USING (order_id)
  WHERE _fivetran_deleted = FALSE AND type = 'ORDERS_LINEAR_ALL'
    AND CAST(click_date AS DATE) >= CAST(order_date AS DATE) - 28)"""


@query("linear_attribution")
def q_linear_attribution(spark, sf):
    a = _attributed(tables(spark, sf))
    return a.groupBy("order_index", "channel").agg(F.sum("touches").alias("touches"))


SQL["linear_attribution"] = f"""WITH {_TOUCH_SQL}
SELECT order_index, channel, COUNT(*) AS touches FROM tw GROUP BY 1, 2"""


def _order_sales(t):
    return t["orders"].select(F.col("o_orderkey").cast("string").alias("order_id"),
                              F.col("o_orderdate").alias("date"),
                              money("o_totalprice").alias("total"), F.lit(1).alias("orders"))


@query("attribute_measures")
def q_attribute_measures(spark, sf):
    t = tables(spark, sf)
    return rounded(attribute_measures(_order_sales(t), _attributed(t),
                                      {"revenue": F.col("total"), "purchases": F.col("orders")},
                                      keys=("channel", "campaign_id"), exact_scale=2))


SQL["attribute_measures"] = f"""WITH {_TOUCH_SQL},
s AS (SELECT CAST(o_orderkey AS VARCHAR) AS order_id, floor(o_totalprice)::DOUBLE AS total,
             1 AS orders FROM orders)
SELECT COALESCE(channel, 'Other') AS channel, COALESCE(campaign_id, '(not set)') AS campaign_id,
       round(fsum(total / COALESCE(order_index, 1)), 4) AS revenue,
       round(fsum(orders::DOUBLE / COALESCE(order_index, 1)), 4) AS purchases
FROM s LEFT JOIN tw USING (order_id) GROUP BY 1, 2"""


def _order_components(t):
    li = t.get("lineitem_of_orders", t["lineitem"])
    returned = F.col("l_returnflag") == "R"
    per_order = li.groupBy(F.col("l_orderkey").cast("string").alias("order_id")).agg(
        F.sum(money("l_extendedprice")).alias("gross_sales"),
        F.sum(money(F.col("l_extendedprice") * F.col("l_discount"))).alias("subtotal_discounts"),
        F.sum(money(F.col("l_extendedprice") * F.col("l_tax"))).alias("tax_sales"),
        (F.count(F.lit(1)) * 10).cast("double").alias("shipping_revenue"),
        F.sum(F.when(returned, money("l_extendedprice"))).alias("subtotal_refunds"),
        F.sum(F.when(returned, money(F.col("l_extendedprice") * F.col("l_tax"))))
        .alias("tax_refunds"))
    return per_order.withColumns({"shipping_discounts": typed_null("double"),
                                  "shipping_refunds": F.lit(0.0)})


_COMPONENTS_SQL = """per_order AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id,
         SUM(floor(l_extendedprice)::DOUBLE) AS gross_sales,
         SUM(floor(l_extendedprice * l_discount)::DOUBLE) AS subtotal_discounts,
         SUM(floor(l_extendedprice * l_tax)::DOUBLE) AS tax_sales,
         (COUNT(*) * 10)::DOUBLE AS shipping_revenue,
         SUM(CASE WHEN l_returnflag = 'R' THEN floor(l_extendedprice)::DOUBLE END) AS subtotal_refunds,
         SUM(CASE WHEN l_returnflag = 'R' THEN floor(l_extendedprice * l_tax)::DOUBLE END)
           AS tax_refunds,
         NULL::DOUBLE AS shipping_discounts, 0.0::DOUBLE AS shipping_refunds
  FROM lineitem GROUP BY 1)"""


@query("sales_components")
def q_sales_components(spark, sf):
    po = _order_components(tables(spark, sf))
    return po.select("order_id", *[c.alias(n) for n, c in sales_components().items()])


SQL["sales_components"] = f"""WITH {_COMPONENTS_SQL}
SELECT order_id,
  COALESCE(gross_sales, 0) - COALESCE(subtotal_discounts, 0) + COALESCE(tax_sales, 0)
    + COALESCE(shipping_revenue, 0) - COALESCE(shipping_discounts, 0) AS total_sales_amount,
  COALESCE(gross_sales, 0) - COALESCE(subtotal_discounts, 0) AS sales_amount,
  COALESCE(subtotal_refunds, 0) - COALESCE(shipping_refunds, 0) + COALESCE(tax_refunds, 0)
    AS total_refund_amount,
  COALESCE(subtotal_refunds, 0) AS refund_amount
FROM per_order"""


@query("net_new_revenue")
def q_net_new_revenue(spark, sf):
    t = tables(spark, sf)
    firsts = roles.first_orders(t).filter(F.col("is_first"))
    lines = t["lineitem"].join(firsts, F.col("l_orderkey") == F.col("o_orderkey"), "inner")
    from blendwise.operators import net_new
    by_month = lines.groupBy(_month(_od()).alias("date")).agg(
        F.sum(money("l_extendedprice")).alias("new_revenue"),
        F.sum(F.when(F.col("l_returnflag") == "R", money("l_extendedprice"))).alias("new_refunds"))
    return by_month.select("date", "new_revenue", "new_refunds",
                           net_new("new_revenue", "new_refunds").alias("net_new_revenue"))


SQL["net_new_revenue"] = f"""WITH {ORDERS_FIRST_CTE}
SELECT {trunc('month', 'o_orderdate')} AS date,
       SUM(floor(l_extendedprice)::DOUBLE) AS new_revenue,
       SUM(CASE WHEN l_returnflag = 'R' THEN floor(l_extendedprice)::DOUBLE END) AS new_refunds,
       COALESCE(SUM(floor(l_extendedprice)::DOUBLE), 0)
         - COALESCE(SUM(CASE WHEN l_returnflag = 'R' THEN floor(l_extendedprice)::DOUBLE END), 0)
         AS net_new_revenue
FROM lineitem JOIN o_first ON l_orderkey = o_orderkey WHERE is_first GROUP BY 1"""


@query("campaign_dimension")
def q_campaign_dimension(spark, sf):
    t = tables(spark, sf)
    names = roles.campaign_names(t)
    fb = roles.ad_lines(t, "R").join(names, "campaign_id", "left")
    al = roles.ad_lines(t, "N").join(names, "campaign_id", "left")
    dim = campaign_dimension([(fb, "Facebook", "campaign_id", "campaign_name"),
                              (al, "App Lovin", "campaign_id", "campaign_name")])
    conv = rounded(attribute_measures(_order_sales(t), _attributed(t), {"revenue": F.col("total")},
                                      keys=("channel", "campaign_id"), exact_scale=2))
    return conv.join(dim, ["channel", "campaign_id"], "left")


SQL["campaign_dimension"] = f"""WITH {_TOUCH_SQL},
s AS (SELECT CAST(o_orderkey AS VARCHAR) AS order_id, floor(o_totalprice)::DOUBLE AS total
      FROM orders),
conv AS (
  SELECT COALESCE(channel, 'Other') AS channel, COALESCE(campaign_id, '(not set)') AS campaign_id,
         round(fsum(total / COALESCE(order_index, 1)), 4) AS revenue
  FROM s LEFT JOIN tw USING (order_id) GROUP BY 1, 2),
names AS (SELECT CAST(s_suppkey AS VARCHAR) AS campaign_id,
                 CASE WHEN s_acctbal >= 0 THEN s_name END AS campaign_name FROM supplier),
dim AS (
  SELECT 'Facebook' AS channel, CAST(l_suppkey AS VARCHAR) AS campaign_id, campaign_name
  FROM lineitem LEFT JOIN names ON CAST(l_suppkey AS VARCHAR) = names.campaign_id
  WHERE l_returnflag = 'R' GROUP BY 1, 2, 3
  UNION
  SELECT 'App Lovin', CAST(l_suppkey AS VARCHAR), campaign_name
  FROM lineitem LEFT JOIN names ON CAST(l_suppkey AS VARCHAR) = names.campaign_id
  WHERE l_returnflag = 'N' GROUP BY 1, 2, 3)
SELECT * FROM conv LEFT JOIN dim USING (channel, campaign_id)"""


# ---------------------------------------------------- R1 at line grain --

def lineitem_rollup(spark, sf, strategy="lattice"):
    """Five-grain roll-up of every line by supplier (the benchmark's roll-up)."""
    li = tables(spark, sf)["lineitem"]
    return granularity_rollup(
        li, "l_shipdate", [F.col("l_suppkey").alias("supplier")],
        {"lines": count_(), "quantity": sum_(F.col("l_quantity").cast("long")),
         "spend": sum_(money("l_extendedprice"))}, strategy=strategy)


@query("granularity_rollup_lineitem")
def q_granularity_rollup_lineitem(spark, sf):
    return lineitem_rollup(spark, sf)


SQL["granularity_rollup_lineitem"] = per_grain(
    "SELECT " + trunc("{g}", "l_shipdate") + " AS date, '{g}' AS date_granularity, "
    "l_suppkey AS supplier, COUNT(*) AS lines, CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) "
    "AS quantity, SUM(floor(l_extendedprice)::DOUBLE) AS spend FROM lineitem GROUP BY 1, 2, 3")


# ------------------------------------------------------------------- D10 --

@query("date_parts")
def q_date_parts(spark, sf):
    from blendwise.functions.dates import with_date_parts
    o = tables(spark, sf)["orders"].select(F.col("o_orderdate").cast("date").alias("d")).distinct()
    return with_date_parts(o, "d")


SQL["date_parts"] = """
SELECT d, d AS day, CAST(date_trunc('week', d) AS DATE) AS week,
       CAST(date_trunc('month', d) AS DATE) AS month, CAST(date_trunc('quarter', d) AS DATE) AS quarter,
       CAST(date_trunc('year', d) AS DATE) AS year
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)"""
