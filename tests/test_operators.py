"""Hand-written edge cases for the operators (quirk register Q-numbers in comments)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from blendwise.functions import (
    count_, count_distinct, days_in_month, days_in_quarter, days_in_year, parse_money,
    period_start, sum_, tax_net,
)
from blendwise.operators import (
    allocate_fee, attribute_measures, campaign_dimension, cutover, full_outer_blend,
    granularity_rollup, label_unpaid, linear_attribution, normalise_channel, order_counts,
    product_units, repair_names, split_channels, split_spend, stack_relations,
    unpivot_regions,
)

D = dt.date


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


# ------------------------------------------------------------- dates, R1 --

def test_period_starts_monday_and_sunday_weeks(spark):
    df = spark.createDataFrame([(D(2024, 3, 9),), (D(2024, 3, 10),), (D(2024, 3, 11),),
                                (D(2024, 12, 31),)], "d date")
    out = df.select("d", period_start("d", "week").alias("mon"),
                    period_start("d", "week", "sunday").alias("sun"),
                    period_start("d", "quarter").alias("q")).collect()
    got = {r.d: (r.mon, r.sun, r.q) for r in out}
    assert got[D(2024, 3, 9)] == (D(2024, 3, 4), D(2024, 3, 3), D(2024, 1, 1))   # Saturday
    assert got[D(2024, 3, 10)] == (D(2024, 3, 4), D(2024, 3, 10), D(2024, 1, 1))  # Sunday
    assert got[D(2024, 3, 11)] == (D(2024, 3, 11), D(2024, 3, 10), D(2024, 1, 1))  # Monday
    assert got[D(2024, 12, 31)] == (D(2024, 12, 30), D(2024, 12, 29), D(2024, 10, 1))


def test_days_in_period(spark):
    df = spark.createDataFrame([(D(2024, 2, 10),), (D(2023, 11, 5),)], "d date")
    got = {r.d: (r.m, r.q, r.y) for r in df.select(
        "d", days_in_month("d").alias("m"), days_in_quarter("d").alias("q"),
        days_in_year("d").alias("y")).collect()}
    assert got[D(2024, 2, 10)] == (29, 91, 366)
    assert got[D(2023, 11, 5)] == (30, 92, 365)


@pytest.mark.parametrize("strategy", ["union", "cascade", "cascade_union", "explode"])
def test_rollup_strategies_agree_and_totals_equal_per_grain(spark, strategy):
    df = spark.createDataFrame(
        [(D(2024, 1, 1), "a", 1.0), (D(2024, 1, 1), "a", 2.0), (D(2024, 1, 8), "a", 3.0),
         (D(2024, 2, 29), "b", None), (D(2023, 12, 31), "b", 5.0)], "d date, k string, v double")
    out = granularity_rollup(df, "d", ["k"], {"n": count_(), "v": sum_("v", fill=0)},
                             strategy=strategy)
    totals = {r.date_granularity: (r.n, r.v) for r in
              out.groupBy("date_granularity").agg(F.sum("n").alias("n"), F.sum("v").alias("v"))
              .collect()}
    assert set(totals) == {"day", "week", "month", "quarter", "year"}
    assert all(t == (5, 11.0) for t in totals.values())
    # all-NULL group is zero-filled (A10)
    feb = out.filter((F.col("date_granularity") == "month") & (F.col("k") == "b")
                     & (F.col("date") == D(2024, 2, 1))).collect()
    assert feb[0].v == 0.0 and feb[0].n == 1


def test_rollup_count_distinct_uses_explode(spark):
    df = spark.createDataFrame([(D(2024, 1, 1), 1), (D(2024, 1, 2), 1), (D(2024, 1, 2), 2)],
                               "d date, o int")
    out = granularity_rollup(df, "d", [], {"orders": count_distinct("o")}, grains=["day", "month"])
    assert rows(out, "date_granularity", "date", "orders") == [
        ("day", D(2024, 1, 1), 1), ("day", D(2024, 1, 2), 2), ("month", D(2024, 1, 1), 2)]
    with pytest.raises(ValueError):
        granularity_rollup(df, "d", [], {"orders": count_distinct("o")}, strategy="cascade")


def test_cutover_on_period_start(spark):
    # Q33: the quarter containing the switch date comes wholly from the old source.
    old = spark.createDataFrame([(D(2025, 4, 1), "quarter", 10), (D(2025, 4, 28), "day", 1),
                                 (D(2025, 4, 29), "day", 2)], "date date, g string, v int")
    new = spark.createDataFrame([(D(2025, 4, 1), "quarter", 99), (D(2025, 4, 28), "day", 7),
                                 (D(2025, 4, 29), "day", 8)], "date date, g string, v int")
    got = rows(cutover(old, new, "2025-04-28"), "g", "date", "v")
    assert got == [("day", D(2025, 4, 28), 1), ("day", D(2025, 4, 29), 8),
                   ("quarter", D(2025, 4, 1), 10)]


# ------------------------------------------------------------ classifiers --

def test_normalise_channel_blank_and_null_ids(spark):
    df = spark.createDataFrame(
        [("facebook-ads", "11"), ("facebook-ads", ""), ("facebook-ads", None),
         ("google-ads", ""), ("google-ads", None), ("tiktok", "5")], "source string, cid string")
    ch, cid = normalise_channel("source", "cid", [("facebook-ads", "Facebook", True),
                                                  ("google-ads", "Google Ads", False)])
    got = [tuple(r) for r in df.select(ch, cid).collect()]
    assert got == [("Facebook", "11"), ("Other", "(not set)"), ("Other", "(not set)"),
                   ("Google Ads", "(not set)"), ("Google Ads", "(not set)"),
                   ("Other", "(not set)")]


def test_repair_names_order(spark):
    df = spark.createDataFrame([("DS01 A SC - Copy 2",), ("fixed",), (None,)], "n string")
    col = repair_names("n", [("A SC", "A+SC")], cut_at=" - Copy", renames={"fixed": "renamed"})
    assert [r[0] for r in df.select(col).collect()] == ["DS01 A+SC", "renamed", None]


def test_label_unpaid_hits_null_names_only(spark):
    # Q16: a paid row with a NULL name is labelled too.
    df = spark.createDataFrame([("Meta", "x"), ("Meta", None), (None, None)], "channel string, campaign_name string")
    assert [r.channel for r in label_unpaid(df).collect()] == ["Meta", "Not Paid", "Not Paid"]


def test_split_spend_null_names(spark):
    # Q34: NULL name -> keyword form gives 0/0, brand form gives NULL/0.
    df = spark.createDataFrame([("Brand x", 100.0), ("other", 100.0), (None, 100.0)], "n string, s double")
    a1, r1 = split_spend("n", "s", "brand", 0.34, null_name="null")
    a2, r2 = split_spend("n", "s", "react", 0.0, null_name="zero")
    got = [tuple(r) for r in df.select(a1, r1, a2, r2).collect()]
    assert got[0] == (pytest.approx(34.0), pytest.approx(66.0), 100.0, 0.0)
    assert got[1] == (100.0, 0.0, 100.0, 0.0)
    assert got[2][0] is None and got[2][1] == 0 and got[2][2] == 0 and got[2][3] == 0


def test_split_channels_keeps_union_semantics(spark):
    # Overlapping rules emit the row once per rule; NULL names match neither arm (Q22).
    df = spark.createDataFrame([("Direct", "traffic ad", 1.0), ("Direct", "sale", 2.0),
                                ("Direct", None, 4.0)], "account string, name string, spend double")
    from blendwise.functions import imatch, not_imatch
    out = split_channels(df, [("Meta", (F.col("account") == "Direct") & not_imatch("name", "traffic")),
                              ("Traffic", (F.col("account") == "Direct") & imatch("name", "traffic")),
                              ("All", F.col("account") == "Direct")])
    got = rows(out.groupBy("channel").agg(F.sum("spend").alias("s")), "channel", "s")
    assert got == [("All", 7.0), ("Meta", 2.0), ("Traffic", 1.0)]


# ------------------------------------------------------------ money --

def test_parse_money_and_tax_net(spark):
    df = spark.createDataFrame([("$1,234.50", 100.0, 10.0, 110.0), ("", 50.0, 5.0, 0.0),
                                (None, 50.0, None, None)], "c string, a double, t double, tot double")
    got = df.select(parse_money("c").alias("p"), tax_net("a", "t", "tot").alias("n")).collect()
    assert got[0].p == 1234.5 and got[1].p is None and got[2].p is None
    assert got[0].n == pytest.approx(100.0 * (1 - 10.0 / 110.0))
    assert got[1].n == 50.0 and got[2].n == 50.0   # zero or NULL tax base: no netting


# ------------------------------------------------------------ blends --

def test_full_outer_null_keys_never_match(spark):
    a = spark.createDataFrame([("d1", "c1", 1), ("d1", None, 2)], "date string, cid string, x int")
    b = spark.createDataFrame([("d1", "c1", 10), ("d1", None, 20), ("d2", "c2", 30)],
                              "date string, cid string, y int")
    out = full_outer_blend([(a, None), (b, ["date", "cid"])], fill_measures=["x", "y"])
    assert out.columns == ["date", "cid", "x", "y"]
    got = sorted((tuple(r) for r in out.collect()), key=lambda t: tuple(str(v) for v in t))
    assert got == sorted([("d1", "c1", 1, 10), ("d1", None, 2, 0), ("d1", None, 0, 20),
                          ("d2", "c2", 0, 30)], key=lambda t: tuple(str(v) for v in t))


def test_shrinking_key_chain_fans_out(spark):
    # Q12: sessions keyed on (date, channel, id) repeat for every campaign name of that id.
    conv = spark.createDataFrame([("d", "FB", "1", "n1", 1.0), ("d", "FB", "1", "n2", 2.0)],
                                 "date string, channel string, campaign_id string, campaign_name string, rev double")
    web = spark.createDataFrame([("d", "FB", "1", 5)], "date string, channel string, campaign_id string, sessions int")
    out = full_outer_blend([(conv, None), (web, ["date", "channel", "campaign_id"])])
    assert out.agg(F.sum("sessions")).first()[0] == 10
    dim = campaign_dimension([(conv, "FB", "campaign_id", "campaign_name")], dedupe_names=True)
    assert dim.count() == 1


def test_stack_relations_rejects_schema_drift(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    b = spark.createDataFrame([("x", 1)], "b string, a int")
    with pytest.raises(ValueError):
        stack_relations([a, b])
    assert stack_relations([a, a]).count() == 2


def test_unpivot_regions_expressions_and_zeros(spark):
    df = spark.createDataFrame([(D(2024, 1, 1), 10.0, 6.0, 3.0)], "date date, us_s double, us_wn double, uk_s double")
    out = unpivot_regions(df, ["date"], {"US": {"spend": "us_s", "bear": F.col("us_wn") / 2},
                                         "UK": {"spend": "uk_s"}}, ["spend", "bear"])
    assert rows(out, "region", "spend", "bear") == [("UK", 3.0, 0.0), ("US", 10.0, 3.0)]


# ------------------------------------------------------------ attribution --

def test_linear_attribution_filters_and_weights(spark):
    ts = lambda d: dt.datetime.combine(d, dt.time(12))
    touches = spark.createDataFrame([
        ("o1", "facebook-ads", "11", ts(D(2024, 1, 3)), "ORDERS_LINEAR_ALL", 1, False),   # -28 days: kept
        ("o1", "facebook-ads", "12", ts(D(2024, 1, 2)), "ORDERS_LINEAR_ALL", 2, False),   # -29 days: dropped
        ("o1", "google-ads", "", ts(D(2024, 2, 5)), "ORDERS_LINEAR_ALL", 3, False),       # after order: kept
        ("o1", "facebook-ads", "13", ts(D(2024, 1, 20)), "OTHER", 4, False),               # other model
        ("o1", "facebook-ads", "14", ts(D(2024, 1, 20)), "ORDERS_LINEAR_ALL", 5, True),   # deleted
        ("o1", "facebook-ads", "15", ts(D(2024, 1, 20)), "ORDERS_LINEAR_ALL", 6, None),   # NULL flag
        ("o9", "facebook-ads", "16", ts(D(2024, 1, 20)), "ORDERS_LINEAR_ALL", 1, False),  # no order row
    ], "order_id string, source string, campaign_id string, click_date timestamp_ntz, type string, "
       "index int, _fivetran_deleted boolean")
    orders = spark.createDataFrame([("o1", ts(D(2024, 1, 31))), ("o2", ts(D(2024, 1, 31)))],
                                   "order_id string, order_date timestamp_ntz")
    att = linear_attribution(touches, orders, [("facebook-ads", "Facebook", True),
                                               ("google-ads", "Google Ads", False)])
    assert rows(att, "channel", "campaign_id", "order_index") == [
        ("Facebook", "11", 2), ("Google Ads", "(not set)", 2)]
    sales = spark.createDataFrame([("o1", D(2024, 1, 31), 100.0), ("o2", D(2024, 1, 31), 40.0)],
                                  "order_id string, date date, total double")
    out = attribute_measures(sales, att, {"revenue": F.col("total"), "orders": F.lit(1)})
    got = rows(out, "channel", "campaign_id", "revenue", "orders")
    assert got == [("Facebook", "11", 50.0, 0.5), ("Google Ads", "(not set)", 50.0, 0.5),
                   ("Other", "(not set)", 40.0, 1.0)]
    assert sum(r[2] for r in got) == 140.0   # weights of an order sum to 1


# ------------------------------------------------------------ commerce --

def test_order_counts_distinct_first(spark):
    df = spark.createDataFrame([("r", "a", 1), ("r", "a", 2), ("r", "b", 2), ("r", None, 1)],
                               "region string, order_id string, idx int")
    out = order_counts(df, ["region"], "order_id", F.col("idx") == 1)
    assert rows(out, "region", "orders", "first_orders") == [("r", 2, 1)]


def test_product_units_bundle_multiplier(spark):
    df = spark.createDataFrame([("Blanket 3 Pack", 2), ("Blanket", 1), ("Bear plush", 4), ("x", 9)],
                               "t string, q int")
    units = product_units("t", "q", {"blankets": [{"titles": ["Blanket"]},
                                                 {"title": "Blanket 3 Pack", "multiplier": 3}],
                                     "bear": [{"pattern": "bear"}]})
    got = df.agg(*[c.alias(n) for n, c in units.items()]).first()
    assert (got.blankets, got.bear) == (7, 4)


# ------------------------------------------------------------ fees --

def test_allocate_fee_shares_within_grain(spark):
    # Q43 with share_within_grain=True: month rows of a partition receive the whole pool.
    df = spark.createDataFrame([
        ("Google Ads", "US", "Youtube", "video a", D(2024, 3, 1), "month", 60.0),
        ("Google Ads", "US", "Youtube", "video b", D(2024, 3, 1), "month", 40.0),
        ("Google Ads", "US", "Youtube", "image c", D(2024, 3, 1), "month", 10.0),
        ("Meta", None, None, "x", D(2024, 3, 1), "month", 5.0),
    ], "channel string, market string, campaign_type string, google_campaign string, date date, "
       "date_granularity string, spend double")
    from blendwise.operators import video_masks
    video, image = video_masks("channel", "market", "campaign_type", "google_campaign")
    out = allocate_fee(df, video, image, share_within_grain=True)
    got = {r.google_campaign: r.spend_with_fees for r in out.collect()}
    assert got["video a"] + got["video b"] == pytest.approx(100.0 * 1.02565 + 10000.0)
    assert got["image c"] == pytest.approx(10.0 * 1.02565)
    assert got["x"] == 0.0


def test_allocate_fee_pool_switch_and_null_mask(spark):
    df = spark.createDataFrame([
        ("Google Ads", "US", "Demand Gen", None, D(2025, 8, 1), "day", 10.0),
    ], "channel string, market string, campaign_type string, google_campaign string, date date, "
       "date_granularity string, spend double")
    from blendwise.operators import video_masks
    video, image = video_masks("channel", "market", "campaign_type", "google_campaign")
    r = allocate_fee(df, video, image).first()
    assert r.monthly_fee_pool == 17000.0
    assert r.spend_with_fees == 0.0        # Q25: NULL name fails both mask arms
    assert r.dg_breakdown == "Other"


def test_contract_validation_reports_missing_and_mistyped(spark):
    from blendwise.sources import contracts as C
    df = spark.createDataFrame([("1", "x")], "order_id string, order_date string")
    with pytest.raises(ValueError, match="order_date"):
        C.validate(df, C.ORDERS)
    ok = spark.createDataFrame([("1", dt.datetime(2024, 1, 1))], "order_id string, order_date timestamp")
    assert C.validate(ok, C.ORDERS) is ok
    with pytest.raises(ValueError, match="missing"):
        C.validate(ok.drop("order_date"), C.ORDERS)


def test_content_replacements_cover_every_fixed_repair(spark):
    from blendwise import constants as K
    from blendwise.functions.text import replace_all
    df = spark.createDataFrame([("UnsubscribedEmail SMS",), ("A SC USA CAN",)], "c string")
    got = [r[0] for r in df.select(replace_all("c", K.CONTENT_REPLACEMENTS)).collect()]
    assert got == ["UnsubscribedEmail+SMS", "A+SC USA+CAN"]


def test_full_outer_adds_no_shuffle_and_no_key(spark):
    from pyspark.sql import functions as F
    from blendwise.operators.blend import full_outer
    rows = spark.range(100).select((F.col("id") % 7).alias("k"), F.col("id").cast("double").alias("x"))
    left = rows.groupBy("k").agg(F.sum("x").alias("a"))
    right = rows.groupBy("k").agg(F.max("x").alias("b"))
    plan = full_outer(left, right, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(k") == 2 and plan.count("Exchange") == 2


# ------------------------------------------------------ exactness, hot order --

def test_exact_sum_keeps_sub_cent_addends(spark):
    from blendwise.functions.numeric import exact_sum
    got = spark.range(1000).select(exact_sum(F.lit(0.004)).alias("s")).first().s
    assert got == 4.0


def test_parse_money_strict_fails_on_junk(spark):
    from blendwise.functions.numeric import parse_money
    df = spark.createDataFrame([("$1,000.50",), ("n/a",)], "cost string")
    assert [r[0] for r in df.select(parse_money("cost")).collect()] == [1000.5, None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        df.select(parse_money("cost", strict=True)).collect()


def test_hot_order_is_collapsed_before_the_join(spark):
    # half of the touches lie on one order; thirds of 100 add up again
    touches = spark.range(20_000).select(
        F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(F.concat(F.lit("o"), (F.col("id") % 3000).cast("string")))
        .alias("order_id"), F.lit("google-ads").alias("source"), (F.col("id") % 3).cast("string").alias("campaign_id"),
        F.lit(dt.datetime(2024, 1, 20)).alias("click_date"), F.lit("ORDERS_LINEAR_ALL").alias("type"),
        F.lit(False).alias("_fivetran_deleted"))
    orders = touches.select("order_id").distinct().withColumn("order_date", F.lit(D(2024, 1, 31)))
    att = linear_attribution(touches, orders, [("google-ads", "Google Ads", False)])
    hot = att.filter("order_id = 'hot'")
    assert hot.count() == 3 and {r.order_index for r in hot.collect()} == {10_000}
    plan = att._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join Inner") < plan.index("count(1)")   # the count lies below the join
    assert "InMemoryRelation" not in plan
    out = attribute_measures(orders.select("order_id", F.col("order_date").alias("date"), F.lit(100.0).alias("total")),
                             att, {"revenue": F.col("total")}, exact_scale=2)
    assert out.agg(F.sum(F.round("revenue", 6))).first()[0] == pytest.approx(100.0 * orders.count(), abs=1e-5)
    touch = linear_attribution(touches, orders, [("google-ads", "Google Ads", False)], per_touch=True)
    assert touch.count() == 20_000
