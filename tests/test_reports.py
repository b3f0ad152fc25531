"""Report models on hand-written fixtures (schemas from FIXTURES.md)."""

import datetime as dt

import pytest

from pyspark.sql import functions as F

from blendwise.plans import reports

D = dt.date(2024, 1, 1)
ADS = ("date date, date_granularity string, campaign_id string, campaign_name string, spend double, "
       "link_clicks bigint, clicks bigint, impressions bigint, purchases bigint, revenue double")


def test_campaign_web_store_fan_out_and_not_paid(spark):
    meta = spark.createDataFrame([(D, "day", "1", "A", 10.0, 2, 2, 100, 1, 20.0)], ADS)
    google = spark.createDataFrame([(D, "day", "1", None, 5.0, 1, 1, 50, 0, 0.0)], ADS)
    web = spark.createDataFrame([(D, "1", 3, 2, 1, 7.0), (D, "9", 2, 1, 0, 0.0)],
                                "date date, session_campaign_id string, sessions bigint, "
                                "engaged_sessions bigint, conversions_purchase bigint, "
                                "purchase_revenue double")
    store = spark.createDataFrame([(D, "day", 4, 1, 40.0, 10.0, 36.0, 9.0)],
                                  "date date, date_granularity string, orders bigint, first_orders bigint, "
                                  "total_net_sales double, first_order_total_net_sales double, "
                                  "net_sales double, first_order_net_sales double")
    out = reports.campaign_web_store({"meta": meta, "google": google, "web": web, "store": store},
                                     grains=["day"])
    got = {(r.channel, r.campaign_name): r for r in out.collect()}
    assert set(got) == {("Meta", "A"), ("Not Paid", None), ("Shopify", "(not set)")}
    # campaign 1's sessions join both the Meta and the (unnamed) Google row: fan-out as in SQL
    assert got[("Meta", "A")].sessions == 3 and got[("Meta", "A")].spend == 10.0
    # the unnamed Google row and the unmatched web campaign both become 'Not Paid'
    assert got[("Not Paid", None)].sessions == 3 + 2 and got[("Not Paid", None)].spend == 5.0
    shop = got[("Shopify", "(not set)")]
    assert (shop.shopify_orders, shop.shopify_sales, shop.spend, shop.sessions) == (4, 40.0, 0.0, 0)


def test_adset_store_blend_pads_google_adsets(spark):
    meta = spark.createDataFrame([(D, "day", "1", "A", "s1", "set", 1.0, 1, 1, 1, 0, 0.0)],
                                 "date date, date_granularity string, campaign_id string, "
                                 "campaign_name string, adset_id string, adset_name string, spend double, "
                                 "link_clicks bigint, clicks bigint, impressions bigint, purchases bigint, "
                                 "revenue double")
    google = spark.createDataFrame([(D, "day", "2", "B", 2.0, 1, 1, 1, 0, 0.0)], ADS)
    store = spark.createDataFrame([(D, "day", 3, 1, 30.0, 10.0, 27.0, 9.0)],
                                  "date date, date_granularity string, orders bigint, first_orders bigint, "
                                  "gross_sales double, first_order_gross_sales double, net_sales double, "
                                  "first_order_net_sales double")
    out = reports.adset_store_blend({"meta": meta, "google": google, "store": store})
    got = {r.channel: r for r in out.collect()}
    assert (got["Google Ads"].adset_id, got["Google Ads"].adset_name) == ("(not set)", "(not set)")
    assert got["Shopify"].shopify_sales == 30.0 and got["Shopify"].campaign_id == "(not set)"
    assert out.agg(F.sum("spend")).first()[0] == 3.0


def test_channel_store_web_stack_labels_shared_items_and_sales_filter(spark):
    # a numeric campaign id beyond 32 bits; J4: the inner join to the optional sales_adj.
    big = 1861822514294002
    video = spark.createDataFrame([(D, "day", big, 1.0, 1, 1, 0, 0.0), (D, "day", 7, 2.0, 1, 1, 0, 0.0)],
                                  "date date, date_granularity string, campaign_num bigint, spend double, "
                                  "clicks bigint, impressions bigint, purchases bigint, revenue double")
    meta = spark.createDataFrame([(D, "day", "Direct", "sale", 3.0, 1, 1, 1, 2.0, None, None),
                                  (D, "day", "Direct", "traffic", 4.0, 1, 1, None, None, 2, 5.0)],
                                 "date date, date_granularity string, account string, campaign_name string, "
                                 "spend double, link_clicks bigint, impressions bigint, purchases bigint, "
                                 "revenue double, purchases_shared_items bigint, revenue_shared_items double")
    from blendwise.functions import imatch, not_imatch
    rules = [("meta", "Meta", (F.col("account") == "Direct") & not_imatch("campaign_name", "traffic")),
             ("meta", "Meta with Traffic", (F.col("account") == "Direct") & imatch("campaign_name", "traffic")),
             ("video", "Tiktok", F.col("campaign_num") != F.lit(big)),
             ("video", "Tiktok Special", F.col("campaign_num") == F.lit(big))]
    store = spark.createDataFrame([(D, "day", 2, 1, 50.0, 5.0, 40.0, 45.0),
                                   (dt.date(2024, 1, 2), "day", 9, 9, 9.0, 0.0, 9.0, 9.0)],
                                  "date date, date_granularity string, orders bigint, first_orders bigint, "
                                  "gross_sales double, subtotal_discount double, net_sales double, "
                                  "total_net_sales double")
    web = spark.createDataFrame([(D, "day", 10)], "date date, date_granularity string, sessions bigint")
    sales_adj = spark.createDataFrame([(D, "day")], "date date, date_granularity string")
    out = reports.channel_store_web_stack({"paid": {"meta": meta, "video": video}, "store": store,
                                           "web": web, "sales_adj": sales_adj}, rules)
    got = {r.channel: r for r in out.collect()}
    assert set(got) == {"Meta", "Meta with Traffic", "Tiktok", "Tiktok Special", "Shopify", "GA4"}
    assert got["Tiktok Special"].spend == 1.0 and got["Tiktok"].spend == 2.0
    assert (got["Meta"].paid_purchases, got["Meta"].paid_revenue) == (1, 2.0)
    assert (got["Meta with Traffic"].paid_purchases, got["Meta with Traffic"].paid_revenue) == (2, 5.0)
    assert got["Shopify"].shopify_subtotal_sales_adj == 45.0 and got["Shopify"].shopify_orders == 2
    assert got["GA4"].ga4_sessions_adjusted == 8.0


def test_orders_without_date_lose_their_touches(spark):
    # Q10: LEFT JOIN orders + predicate on order_date acts as an inner join.
    from blendwise.operators import linear_attribution
    ts = dt.datetime(2024, 1, 10)
    touches = spark.createDataFrame(
        [("o1", "google-ads", "5", ts, "ORDERS_LINEAR_ALL", 1, False),
         ("o2", "google-ads", "6", ts, "ORDERS_LINEAR_ALL", 1, False)],
        "order_id string, source string, campaign_id string, click_date timestamp_ntz, type string, "
        "index int, _fivetran_deleted boolean")
    orders = spark.createDataFrame([("o1", dt.datetime(2024, 1, 20)), ("o2", None)],
                                   "order_id string, order_date timestamp_ntz")
    att = linear_attribution(touches, orders, [("google-ads", "Google Ads", False)])
    assert [r.order_id for r in att.collect()] == ["o1"]


def test_calendar_spine_blend_joins_spend_on_date_only(spark):
    # Q17: a spine date without spend keeps no grain, so its traffic and store rows are lost.
    day1, day2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    meta = spark.createDataFrame([(day1, "day", "US", "Prospecting", 10.0, 1, 1, 0.0, 0)],
                                 "date date, date_granularity string, campaign_country string, "
                                 "campaign_type_default string, spend double, link_clicks bigint, "
                                 "impressions bigint, revenue double, purchases bigint")
    google = spark.createDataFrame([], "date date, date_granularity string, campaign_country string, "
                                       "spend double, clicks bigint, impressions bigint, revenue double, "
                                       "purchases bigint")
    bing = spark.createDataFrame([], "date date, date_granularity string, spend double, clicks bigint, "
                                     "impressions bigint, revenue double, purchases bigint")
    web = spark.createDataFrame([("p", day1, "day", 5), ("p", day2, "day", 7)],
                                "profile string, date date, date_granularity string, sessions bigint")
    store = spark.createDataFrame([(day2, "day", "new", 9.0, 1)],
                                  "dg date, date_granularity string, order_type string, revenue double, orders bigint")
    out = reports.calendar_spine_blend({"meta": meta, "google": google, "bing": bing, "web": web,
                                        "store_by_type": store}, spine_start=day1, as_of=day2)
    got = {r.date: r for r in out.collect()}
    assert got[day1].spend == 10.0 and got[day1].acquisition_spend == 10.0 and got[day1].traffic == 5
    assert got[day2].date_granularity is None and got[day2].traffic is None
    assert got[day2].new_revenue is None          # store row of day 2 is lost (as-is)
    assert got[day1].new_revenue is None           # no 'new' orders on day 1: NULL, not 0 (A9)


def test_fee_share_total_spans_grains_by_default(spark):
    # Q24: without share_within_grain, day and month rows of one month share one total.
    from blendwise.operators import allocate_fee, video_masks
    rows = [("Google Ads", "US", "Youtube", "v", dt.date(2024, 3, 1), "month", 100.0),
            ("Google Ads", "US", "Youtube", "v", dt.date(2024, 3, 5), "day", 100.0)]
    df = spark.createDataFrame(rows, "channel string, market string, campaign_type string, "
                                     "google_campaign string, date date, date_granularity string, "
                                     "spend double")
    video, image = video_masks("channel", "market", "campaign_type", "google_campaign")
    diluted = {r.date_granularity: r for r in allocate_fee(df, video, image).collect()}
    assert diluted["month"].total_spend == 200.0
    assert diluted["month"].spend_with_fees == pytest.approx(100 * 1.02565 + 0.5 * 10000.0)
    within = {r.date_granularity: r for r in allocate_fee(df, video, image, share_within_grain=True).collect()}
    assert within["month"].total_spend == 100.0
    assert within["day"].spend_with_fees == pytest.approx(100 * 1.02565 + 10000.0 / 31)


def test_adjusted_sessions_stay_null_without_sessions(spark):
    # Q21: COALESCE(SUM(x)) with one argument leaves NULL while its sibling gives 0.
    paid = {"google": spark.createDataFrame([], "date date, date_granularity string, spend double, "
                                                "clicks bigint, impressions bigint, purchases bigint, "
                                                "revenue double")}
    store = spark.createDataFrame([], "date date, date_granularity string, orders bigint, "
                                      "first_orders bigint, gross_sales double, subtotal_discount double, "
                                      "net_sales double, total_net_sales double")
    web = spark.createDataFrame([(D, "day", None)], "date date, date_granularity string, sessions bigint")
    out = reports.channel_store_web_stack({"paid": paid, "store": store, "web": web},
                                          [("google", "Google Ads", F.lit(True))]).collect()
    assert len(out) == 1 and out[0].ga4_sessions == 0 and out[0].ga4_sessions_adjusted is None
