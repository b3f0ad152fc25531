"""Driver queries for publishing, mergeable distinct counts, split joins and gap filling, each with its DuckDB oracle."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from blendwise.functions.aggs import count_, sum_
from blendwise.operators import (
    cap_at, days_of_periods, dense_ids, distinct_rollup, full_outer, gap_fill, granularity_rollup, reduce_to, split_full_outer,
)
from blendwise.plans import roles
from blendwise.plans.oracle import GRAIN_LIST, ORDERS_FIRST_CTE, SQL, period_start
from blendwise.plans.queries import query, tables
from blendwise.plans.roles import money
from blendwise.session import ensure_checkpoint_dir
from blendwise.sources import publish
from blendwise.sources.bucketed import bucketed_table, write_bucketed


def _new_folder(spark) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/driver-{uuid.uuid4().hex}"


# ------------------------------------------------------------------ S4, O1 --

def _status_rollup(t):
    return granularity_rollup(t["orders"], "o_orderdate", [F.col("o_orderstatus").alias("status")],
                              {"orders": count_(), "revenue": sum_(money("o_totalprice"))})


@query("publish_read_back")
def q_publish_read_back(spark, sf):
    """Published by grain, then one grain replaced alone, then read back."""
    path, rows = _new_folder(spark), _status_rollup(tables(spark, sf))
    publish(rows, path=path)
    publish(rows.where("date_granularity = 'month'"), path=path, replace="touched")
    return spark.read.schema(rows.schema).parquet(path).select(*rows.columns)


SQL["publish_read_back"] = f"""
WITH {GRAIN_LIST}
SELECT {period_start('g', 'o_orderdate')} AS date, g AS date_granularity, o_orderstatus AS status, COUNT(*) AS orders,
       SUM(floor(o_totalprice)::DOUBLE) AS revenue
FROM orders, grain_list GROUP BY ALL"""


@query("publish_in_order")
def q_publish_in_order(spark, sf):
    """Line items published in date order, several files each: rows and days per grain, and files whose days overlap by more than an end."""
    li = tables(spark, sf)["lineitem"].select(F.col("l_shipdate").cast("date").alias("date"), F.col("l_linestatus").alias("date_granularity"),
                                              "l_orderkey", "l_linenumber", "l_quantity")
    path = _new_folder(spark)
    publish(li, path=path, order_by=["date"], file_bytes=64 * 1024)  # small, so that the test tables make several files
    back = spark.read.schema(li.schema).parquet(path)
    files = back.groupBy("date_granularity", F.col("_metadata.file_name").alias("file")).agg(
        F.min("date").alias("first"), F.max("date").alias("last"), F.count(F.lit(1)).alias("n"))
    pairs = files.alias("a").join(files.alias("b"), (F.col("a.date_granularity") == F.col("b.date_granularity")) & (F.col("a.file") < F.col("b.file"))
                                  & (F.col("a.last") > F.col("b.first")), "left_semi")
    wrong = pairs.groupBy("date_granularity").agg(F.count(F.lit(1)).alias("wrong"))
    return (files.groupBy("date_granularity").agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sum("n").alias("rows"))
            .join(wrong, "date_granularity", "left")
            .select(F.col("date_granularity").alias("status"), "first", "last", "rows",
                    F.coalesce("wrong", F.lit(0)).alias("files_out_of_order")))


SQL["publish_in_order"] = """
SELECT l_linestatus AS status, CAST(min(l_shipdate) AS DATE) AS first, CAST(max(l_shipdate) AS DATE) AS last, COUNT(*) AS rows,
       CAST(0 AS BIGINT) AS files_out_of_order
FROM lineitem GROUP BY 1"""


# ------------------------------------------------------------- A6, A7, R25 --

@query("distinct_orders_rollup")
def q_distinct_orders_rollup(spark, sf):
    """Distinct orders and first orders that shipped in each period, by status: an order ships on several days."""
    t = tables(spark, sf)
    orders = roles.first_orders(t).select("o_orderkey", "o_orderdate", "is_first")
    numbers = dense_ids(orders, "o_orderkey", "o_orderdate", "number").withColumnRenamed("o_orderkey", "id")
    known = orders.join(numbers, F.col("o_orderkey") == F.col("id")).select(F.col("o_orderkey").alias("key"), "number", "is_first")
    lines = t["lineitem"].join(known, F.col("l_orderkey") == F.col("key"))
    return distinct_rollup(lines, "l_shipdate", [F.col("l_returnflag").alias("flag")], "number",
                           {"orders": None, "first_orders": F.col("is_first")},
                           {"lines": count_(), "quantity": sum_(F.col("l_quantity").cast("long"))})


SQL["distinct_orders_rollup"] = f"""
WITH {GRAIN_LIST},
{ORDERS_FIRST_CTE}
SELECT {period_start('g', 'l_shipdate')} AS date, g AS date_granularity, l_returnflag AS flag, COUNT(DISTINCT l_orderkey) AS orders,
       COUNT(DISTINCT CASE WHEN is_first THEN l_orderkey END) AS first_orders, COUNT(*) AS lines,
       CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
FROM lineitem JOIN o_first ON o_orderkey = l_orderkey, grain_list GROUP BY ALL"""


# --------------------------------------------------------------------- J6 --

def _hot_sides(t):
    """Campaign facts by (day, campaign), of which the reduced key keeps the month alone; a third have no month."""
    li = t["lineitem"]
    month = F.when(F.col("l_returnflag") == "R", F.lit("1990-01-01").cast("date")).when(
        F.col("l_returnflag") == "A", F.trunc(F.col("l_shipdate").cast("date"), "month"))
    facts = li.groupBy(month.alias("month"), F.col("l_shipdate").cast("date").alias("day"), F.col("l_suppkey").alias("campaign")).agg(
        F.sum(money("l_extendedprice")).alias("spend"))
    hot = F.when(F.col("o_orderstatus") == "P", F.lit("1990-01-01").cast("date")).otherwise(F.trunc(F.col("o_orderdate").cast("date"), "month"))
    tracker = t["orders"].groupBy(hot.alias("month")).agg(F.sum(money("o_totalprice")).alias("forecast"))
    return facts, tracker


@query("full_outer_hot_key")
def q_full_outer_hot_key(spark, sf):
    facts, tracker = _hot_sides(tables(spark, sf))
    return split_full_outer(facts, tracker, ["month"], min_rows=0, parts=64)


SQL["full_outer_hot_key"] = """
WITH facts AS (
  SELECT CASE l_returnflag WHEN 'R' THEN DATE '1990-01-01' WHEN 'A' THEN CAST(date_trunc('month', l_shipdate) AS DATE) END AS month,
         CAST(l_shipdate AS DATE) AS day, l_suppkey AS campaign, SUM(floor(l_extendedprice)::DOUBLE) AS spend
  FROM lineitem GROUP BY ALL),
tracker AS (
  SELECT CASE o_orderstatus WHEN 'P' THEN DATE '1990-01-01' ELSE CAST(date_trunc('month', o_orderdate) AS DATE) END AS month,
         SUM(floor(o_totalprice)::DOUBLE) AS forecast
  FROM orders GROUP BY ALL)
SELECT month, day, campaign, spend, forecast FROM facts FULL OUTER JOIN tracker USING (month)"""


# ----------------------------------------------------------------- J1, J5 --

@query("full_outer_bucketed")
def q_full_outer_bucketed(spark, sf):
    """Two facts kept in bucketed tables, aggregated and joined on the bucket keys without a shuffle."""
    t = tables(spark, sf)
    name = f"blendwise_{uuid.uuid4().hex}"
    keys = ["date", "campaign_id"]
    for flag, measure in (("R", "spend"), ("N", "sessions")):
        rows = t["lineitem"].where(F.col("l_returnflag") == flag).select(
            F.col("l_shipdate").cast("date").alias("date"), F.col("l_suppkey").alias("campaign_id"), money("l_extendedprice").alias(measure))
        write_bucketed(rows, f"{name}_{measure}", keys, 8, path=f"{_new_folder(spark)}/{measure}")
    spend, web = (bucketed_table(spark, f"{name}_{m}", keys, 8) for m in ("spend", "sessions"))
    paid = spend.groupBy(*keys).agg(F.sum("spend").alias("spend"))
    seen = web.groupBy(*keys).agg(F.count(F.lit(1)).alias("sessions"))
    return full_outer(paid, seen, keys)


SQL["full_outer_bucketed"] = """
SELECT CAST(l_shipdate AS DATE) AS date, l_suppkey AS campaign_id,
       SUM(floor(l_extendedprice)::DOUBLE) FILTER (l_returnflag = 'R') AS spend,
       NULLIF(COUNT(*) FILTER (l_returnflag = 'N'), 0) AS sessions
FROM lineitem WHERE l_returnflag IN ('R', 'N') GROUP BY 1, 2"""


# --------------------------------------------------------------------- J4 --

def _adjusted_periods(t):
    """Periods that an adjustment sheet holds: months and quarters with an order of the highest priority over a large sum."""
    big = t["orders"].where((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_totalprice") > 300_000))
    return granularity_rollup(big, "o_orderdate", [], {"n": count_()}, grains=("month", "quarter")).select("date", "date_granularity")


@query("reduce_to_periods")
def q_reduce_to_periods(spark, sf):
    """Sales of the adjusted periods: the days they cover filter the orders below the roll-up, the periods its result."""
    t = tables(spark, sf)
    periods = _adjusted_periods(t)
    days = days_of_periods(periods)
    orders = t["orders"].select(F.col("o_orderdate").cast("date").alias("day"), money("o_totalprice").alias("gross"))
    rolled = granularity_rollup(reduce_to(orders, days, ["day"]), "day", [], {"orders": count_(), "gross_sales": sum_("gross")},
                                grains=("month", "quarter"))
    return reduce_to(rolled, periods, ["date", "date_granularity"])


SQL["reduce_to_periods"] = """
WITH p AS (
  SELECT DISTINCT g, date_trunc(g, o_orderdate) AS start FROM orders, (VALUES ('month'), ('quarter')) AS v(g)
  WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 300000)
SELECT CAST(start AS DATE) AS date, g AS date_granularity, COUNT(*) AS orders, SUM(floor(o_totalprice)::DOUBLE) AS gross_sales
FROM p JOIN orders ON date_trunc(g, o_orderdate) = start GROUP BY ALL"""


# ---------------------------------------------------------------- J8, R17 --

@query("gap_fill_periods")
def q_gap_fill_periods(spark, sf):
    """Urgent sales per clerk group, with the periods between a group's first and last one that had none."""
    t = tables(spark, sf)
    rare = t["orders"].where((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_totalprice") > 250_000))
    rolled = granularity_rollup(rare, "o_orderdate", [F.col("o_orderstatus").alias("status")], {"orders": count_()})
    return gap_fill(rolled, ["status"])


SQL["gap_fill_periods"] = f"""
WITH {GRAIN_LIST},
facts AS (
  SELECT {period_start('g', 'o_orderdate')} AS date, g, o_orderstatus AS status, COUNT(*) AS orders
  FROM orders, grain_list WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 250000 GROUP BY ALL),
bounds AS (SELECT status, g, min(date) AS lo, max(date) AS hi FROM facts GROUP BY ALL),
periods AS (
  SELECT DISTINCT status, g, {period_start('g', 'd')} AS date
  FROM (SELECT status, g, unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS d FROM bounds))
SELECT date, g AS date_granularity, status, orders FROM periods LEFT JOIN facts USING (status, g, date)"""


# --------------------------------------------------------------------- D8 --

@query("capped_at_today")
def q_capped_at_today(spark, sf):
    """Orders moved 28 years on, up to the current date."""
    moved = tables(spark, sf)["orders"].select(F.add_months(F.col("o_orderdate").cast("date"), 336).alias("date"), "o_orderkey")
    return cap_at(moved, start="2021-01-01").groupBy(F.trunc("date", "month").alias("month")).agg(F.count(F.lit(1)).alias("orders"))


SQL["capped_at_today"] = """
SELECT CAST(date_trunc('month', d) AS DATE) AS month, COUNT(*) AS orders
FROM (SELECT CAST(o_orderdate + INTERVAL 28 YEAR AS DATE) AS d FROM orders) WHERE d BETWEEN DATE '2021-01-01' AND current_date GROUP BY 1"""
