"""The report models: each takes ``dict[str, DataFrame]`` inputs and returns a lazy DataFrame.

Input keys name the relations a report reads (platform reporting tables, store
sales, web analytics, sheets). Client-specific literals (campaign names,
account ids, product titles) are arguments with the reference values as
defaults only where they define the report's semantics.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from blendwise.functions.aggs import sum_
from blendwise.functions.dates import GRAINS
from blendwise.operators.blend import align_to, full_outer, full_outer_blend, stack, stack_channels
from blendwise.operators.calendar import granularity_rollup, in_range, touches_range
from blendwise.operators.classify import label_unpaid
from blendwise import constants as K
from blendwise.plans.date_ranges import with_date_range
from blendwise.sources import contracts as C

PAID_MEASURES = ("spend", "clicks", "impressions", "paid_purchases", "paid_revenue")
STORE_MEASURES = ("shopify_first_orders", "shopify_orders", "shopify_first_sales",
                  "shopify_sales", "shopify_first_net_sales", "shopify_net_sales")
WEB_MEASURES = ("sessions", "engaged_sessions", "ga4_purchases", "ga4_revenue")

_COUNTS = {"clicks", "impressions", "paid_purchases", "shopify_first_orders", "shopify_orders",
           "sessions", "engaged_sessions", "ga4_purchases", "add_to_cart"}


def _typed(names: Sequence[str]) -> list[tuple[str, str]]:
    return [(n, "bigint" if n in _COUNTS else "double") for n in names]


def _zero_sum(names: Sequence[str]) -> list:
    return [F.sum(F.coalesce(F.col(n), F.lit(0))).alias(n) for n in names]


def _coalesce_sum(names: Sequence[str]) -> list:
    return [F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names]


def _each_channel(branches: Sequence[Mapping], total) -> DataFrame:
    """``total`` of the stacked branches of each channel, stacked.

    Rows of different channels share no key, so a channel is summed by itself: a branch that a roll-up has
    brought together by its other keys is summed where it lies, and is not shuffled with all the others.
    """
    channels: dict = {}
    for b in branches:
        channels.setdefault(b["const"]["channel"], []).append(b)
    return stack([total(same) for same in channels.values()])


# --------------------------------------------------------------------------
# campaign_web_store: paid campaigns + web sessions (full outer) + store block
# --------------------------------------------------------------------------

# Store columns feeding the store block: (output, source column).
STORE_NET_MAP = (("shopify_first_orders", "first_orders"), ("shopify_orders", "orders"),
                 ("shopify_first_sales", "first_order_total_net_sales"),
                 ("shopify_sales", "total_net_sales"),
                 ("shopify_first_net_sales", "first_order_net_sales"),
                 ("shopify_net_sales", "net_sales"))
STORE_GROSS_MAP = (("shopify_first_orders", "first_orders"), ("shopify_orders", "orders"),
                   ("shopify_first_sales", "first_order_gross_sales"),
                   ("shopify_sales", "gross_sales"),
                   ("shopify_first_net_sales", "first_order_net_sales"),
                   ("shopify_net_sales", "net_sales"))

_PAID_RENAMES = {"link_clicks": "clicks", "purchases": "paid_purchases", "revenue": "paid_revenue",
                 "atc": "add_to_cart"}


def paid_branch(df: DataFrame, channel: str, **extra) -> dict:
    """A paid platform branch with the usual reporting-table renames."""
    rename = {k: v for k, v in _PAID_RENAMES.items() if k in df.columns}
    if "link_clicks" in rename and "clicks" in df.columns:
        df = df.drop("clicks")
    return {"df": df, "rename": rename, "const": {"channel": channel, **extra}}


def paid_web_store(paid_branches: Sequence[Mapping], web: DataFrame, store: DataFrame,
                   grains: Sequence[str] = GRAINS, extra_measures: Sequence[str] = (),
                   web_at_grain: bool = False, store_map=STORE_NET_MAP,
                   store_fill: bool = True, web_strategy: str = "auto", date_range=None) -> DataFrame:
    """Paid campaigns full-outer-joined to web sessions by campaign id, plus a store block.

    Paid rows are stacked into one contract and summed per (channel, id,
    name, date, grain). Web sessions (daily, rolled up to ``grains``, or
    already at grain with ``web_at_grain``) join on ``(date, grain, id)``;
    rows with no campaign name become channel 'Not Paid', and the id is dropped
    by re-aggregation. Store rows are channel 'Shopify', name '(not set)',
    their measures taken per ``store_map`` (zero-filled if ``store_fill``).
    ``date_range``, a pair of first and last day, keeps the periods that touch it;
    every input is filtered before the joins, as no filter passes a full outer join.
    """
    if date_range is not None:
        cut = lambda df: df.filter(touches_range("date", date_range, grains))
        blended = paid_web_store([{**b, "df": cut(b["df"])} for b in paid_branches], cut(web), cut(store), grains,
                                 extra_measures, web_at_grain, store_map, store_fill, web_strategy)
        return blended.filter(in_range("date", "date_granularity", date_range, grains))
    paid_measures = [*PAID_MEASURES[:3], *extra_measures, *PAID_MEASURES[3:]]
    keys = [("channel", "string"), ("campaign_id", "string"), ("campaign_name", "string"),
            ("date", "date"), ("date_granularity", "string")]
    contract = keys + _typed(paid_measures)
    paid = (stack_channels(paid_branches, contract, paid_measures)
            .groupBy(*[k for k, _ in keys]).agg(*_coalesce_sum(paid_measures)))

    cols = [F.col("date").cast("date").alias("date"),
            F.col("session_campaign_id").cast("string").alias("campaign_id"),
            "sessions", "engaged_sessions",
            # relations that are at grain already name these otherwise
            F.col("conversions_purchase" if "conversions_purchase" in web.columns else "purchase").alias("ga4_purchases"),
            F.col("purchase_revenue" if "purchase_revenue" in web.columns else "purchase_value").alias("ga4_revenue")]
    if web_at_grain:
        web_g = (web.select("date_granularity", *cols)
                 .groupBy("date", "date_granularity", "campaign_id")
                 .agg(*[F.sum(m).alias(m) for m in WEB_MEASURES]))
    else:
        web_g = granularity_rollup(web.select(*cols), "date", ["campaign_id"],
                                   {m: sum_(m) for m in WEB_MEASURES}, grains=grains,
                                   strategy=web_strategy)

    blended = full_outer_blend([(paid, None), (web_g, ["date", "date_granularity", "campaign_id"])])
    all_measures = [*paid_measures, *WEB_MEASURES]
    paid_web = (label_unpaid(blended)
                .groupBy("channel", "campaign_name", "date", "date_granularity")
                .agg(*_zero_sum(all_measures)))

    out_cols = ["channel", "campaign_name", "date", "date_granularity", *paid_measures,
                *STORE_MEASURES, *WEB_MEASURES]
    out_contract = [("channel", "string"), ("campaign_name", "string"), ("date", "date"),
                    ("date_granularity", "string"), *_typed([*paid_measures, *STORE_MEASURES,
                                                             *WEB_MEASURES])]
    if grains is not None:
        store = store.filter(F.col("date_granularity").isin(list(grains)))
    fill = (lambda c: F.coalesce(F.col(c), F.lit(0))) if store_fill else F.col
    store_rows = store.select(
        F.lit(K.STORE_CHANNEL).alias("channel"), F.lit(K.NOT_SET).alias("campaign_name"),
        F.col("date").cast("date").alias("date"), "date_granularity",
        *[fill(src).alias(out) for out, src in store_map])
    return stack([align_to(paid_web, out_contract, [*all_measures, *STORE_MEASURES]),
                  align_to(store_rows, out_contract, [*paid_measures, *WEB_MEASURES])]
                 ).select(*out_cols)


def campaign_web_store(inputs: Mapping[str, DataFrame], grains: Sequence[str] = GRAINS,
                       web_strategy: str = "auto", date_range=None) -> DataFrame:
    """Meta and Google campaigns + web sessions + store block.

    Inputs: ``meta``, ``google`` (ads facts at period grain), ``web`` (daily
    sessions: ``date, session_campaign_id, sessions, engaged_sessions,
    conversions_purchase, purchase_revenue``), ``store`` (store_period).
    The store's refund-adjusted columns are the projected net columns (Q14).
    """
    C.validate(inputs["web"], C.WEB_SESSIONS, ["date", "session_campaign_id", "sessions",
                                               "engaged_sessions", "conversions_purchase",
                                               "purchase_revenue"])
    C.validate(inputs["store"], C.STORE_PERIOD, ["date", "date_granularity", "orders", "first_orders",
                                                 "total_net_sales", "first_order_total_net_sales",
                                                 "net_sales", "first_order_net_sales"])
    for k in ("meta", "google"):
        C.validate(inputs[k], C.ADS, ["date", "date_granularity", "campaign_id", "campaign_name",
                                      "spend", "impressions", "purchases", "revenue"])
    branches = [paid_branch(inputs["meta"], "Meta"), paid_branch(inputs["google"], "Google Ads")]
    return paid_web_store(branches, inputs["web"], inputs["store"], grains,
                          web_strategy=web_strategy, date_range=date_range)


@with_date_range
def campaign_web_store_raw_grain(inputs: Mapping[str, DataFrame],
                                 grains: Sequence[str] = GRAINS) -> DataFrame:
    """As ``campaign_web_store`` with add-to-cart, a short-video platform at
    period grain plus its raw daily feed rolled up here, and a search platform.

    Inputs: ``meta``, ``google``, ``video`` (period grain, ``atc``),
    ``video_raw`` (``stat_time_day, campaign_id, campaign_name, spend``),
    ``bing``, ``web`` (already at grain: ``date, date_granularity, ...``),
    ``store``. Store measures are gross sales and stay NULL when missing.
    """
    raw = granularity_rollup(inputs["video_raw"], "stat_time_day",
                             [F.col("campaign_id").cast("string").alias("campaign_id"),
                              "campaign_name"], {"spend": sum_("spend")}, grains=grains)
    branches = [paid_branch(inputs["meta"], "Meta"), paid_branch(inputs["google"], "Google Ads"),
                paid_branch(inputs["video"], "Tiktok Ads"), paid_branch(raw, "Tiktok Ads"),
                paid_branch(inputs["bing"], "Bing")]
    for b in branches[4:]:
        b["df"] = b["df"].drop("add_to_cart")  # the search platform reports no add-to-cart
    return paid_web_store(branches, inputs["web"], inputs["store"], grains,
                          extra_measures=["add_to_cart"], web_at_grain=True,
                          store_map=STORE_GROSS_MAP, store_fill=False)


# --------------------------------------------------------------------------
# adset_store_blend: ad-set-level paid rows + store block, stacked and summed
# --------------------------------------------------------------------------

@with_date_range
def adset_store_blend(inputs: Mapping[str, DataFrame]) -> DataFrame:
    """Meta ad-set rows and Google campaign rows ('(not set)' ad set) plus store rows,
    stacked and summed at 7 keys (R3, R15, A18).

    Inputs: ``meta`` (``adset_id, adset_name`` present), ``google``, ``store``.
    """
    keys = ["channel", "campaign_id", "campaign_name", "adset_id", "adset_name", "date",
            "date_granularity"]
    measures = [*PAID_MEASURES, *STORE_MEASURES]
    contract = [(k, "date" if k == "date" else "string") for k in keys] + _typed(measures)
    branches = [paid_branch(inputs["meta"], "Meta"),
                paid_branch(inputs["google"], "Google Ads", adset_id=K.NOT_SET,
                            adset_name=K.NOT_SET)]
    paid = _each_channel(branches, lambda same: stack_channels(same, contract, measures)
                         .groupBy(*keys).agg(*_coalesce_sum(PAID_MEASURES)))
    store = inputs["store"].select(
        F.lit(K.STORE_CHANNEL).alias("channel"), *[F.lit(K.NOT_SET).alias(k) for k in keys[1:5]],
        F.col("date").cast("date").alias("date"), "date_granularity",
        *[F.col(src).alias(out) for out, src in STORE_GROSS_MAP])
    # The store is a channel of its own, and the paid rows are summed by the same keys already.
    store = align_to(store, contract, measures).groupBy(*keys).agg(*_zero_sum(measures))
    summed = align_to(paid, contract, measures).withColumns({m: F.coalesce(F.col(m), F.lit(0)) for m in measures})
    return stack([summed, store])


# --------------------------------------------------------------------------
# channel_store_web_stack: labelled paid channels, store block, web block
# --------------------------------------------------------------------------

@with_date_range
def channel_store_web_stack(inputs: Mapping[str, DataFrame], channel_rules: Sequence[tuple],
                            session_factor: float = K.SESSION_FACTOR) -> DataFrame:
    """Paid channels split from shared sources by labelled filters, a store block
    and a web block, stacked without blending (R40, R41, R15, R42).

    ``channel_rules`` holds ``(source_key, label, condition)``: each source in
    ``inputs['paid'][source_key]`` is scanned once and every row emitted once
    per satisfied rule. Shared-item purchases and revenue are added to the
    platform's own (zero-filled). Inputs: ``paid`` (dict of sources with
    ``date, date_granularity, spend, clicks|link_clicks, impressions,
    purchases, revenue`` and optional ``*_shared_items``), ``store``, ``web``
    (``date, date_granularity, sessions``), optional ``sales_adj`` (Q20).
    """
    from blendwise.functions.numeric import merge_shared_items
    from blendwise.operators.blend import split_channels

    measures = ["spend", "clicks", "impressions", "paid_purchases", "paid_revenue",
                "shopify_total_sales", "shopify_orders", "shopify_first_orders",
                "shopify_subtotal_sales_adj", "shopify_net_sales", "shopify_gross_sales",
                "ga4_sessions", "ga4_sessions_adjusted"]
    types = {m: ("bigint" if m in ("clicks", "impressions", "paid_purchases", "shopify_orders",
                                   "shopify_first_orders", "ga4_sessions") else "double")
             for m in measures}
    contract = [("channel", "string"), ("date", "date"), ("date_granularity", "string")] + \
        [(m, types[m]) for m in measures]
    parts = []
    by_source: dict[str, list] = {}
    for source_key, label, cond in channel_rules:
        by_source.setdefault(source_key, []).append((label, cond))
    for source_key, rules in by_source.items():
        src = inputs["paid"][source_key]
        clicks = "link_clicks" if "link_clicks" in src.columns else "clicks"
        purchases = (merge_shared_items("purchases", "purchases_shared_items")
                     if "purchases_shared_items" in src.columns else F.col("purchases"))
        revenue = (merge_shared_items("revenue", "revenue_shared_items")
                   if "revenue_shared_items" in src.columns else F.col("revenue"))
        labelled = split_channels(src, rules).select(
            "channel", F.col("date").cast("date").alias("date"), "date_granularity", "spend",
            F.col(clicks).alias("clicks"), "impressions", purchases.alias("paid_purchases"),
            revenue.alias("paid_revenue"))
        parts.append(labelled)
    paid = (stack(parts).groupBy("channel", "date", "date_granularity")
            .agg(*_coalesce_sum(["spend", "clicks", "impressions", "paid_purchases",
                                 "paid_revenue"])))
    store = inputs["store"]
    if inputs.get("sales_adj") is not None:  # an inner join used as a filter (J4, Q20)
        from blendwise.operators.joins import reduce_to
        store = reduce_to(store, inputs["sales_adj"], ["date", "date_granularity"])
    store_rows = store.select(
        F.lit(K.STORE_CHANNEL).alias("channel"), F.col("date").cast("date").alias("date"),
        "date_granularity", F.col("total_net_sales").alias("shopify_total_sales"),
        F.col("orders").alias("shopify_orders"), F.col("first_orders").alias("shopify_first_orders"),
        (F.col("gross_sales") - F.col("subtotal_discount")).alias("shopify_subtotal_sales_adj"),
        F.col("net_sales").alias("shopify_net_sales"), F.col("gross_sales").alias("shopify_gross_sales"))
    web = inputs["web"].groupBy(F.col("date").cast("date").alias("date"), "date_granularity").agg(
        F.coalesce(F.sum("sessions"), F.lit(0)).alias("ga4_sessions"),
        # one-argument COALESCE leaves NULL where its sibling gives 0 (Q21)
        (F.lit(float(session_factor)) * F.coalesce(F.sum("sessions"))).alias("ga4_sessions_adjusted"))
    web = web.withColumn("channel", F.lit(K.WEB_CHANNEL))
    return stack([align_to(paid, contract, measures), align_to(store_rows, contract, measures),
                  align_to(web, contract, measures)])


# --------------------------------------------------------------------------
# actual_vs_forecast: actual spend / store vs forecast and adjusted forecast
# --------------------------------------------------------------------------

@with_date_range
def actual_vs_forecast(inputs: Mapping[str, DataFrame], grains: Sequence[str] = GRAINS,
                       excluded_campaigns: Sequence[str] = (), sort: bool = False) -> DataFrame:
    """Actual spend and store results beside a forecast sheet and its adjusted
    version, at every grain (R10, R16, R3, R1, R18).

    Inputs: ``meta`` (with ``campaign_name``), ``google``, ``store``
    (store_period), ``forecast`` (daily sheet: ``date, original_spend,
    acquisitions, returning, revenue, adjusted_spend, adjusted_acquisitions,
    adjusted_returning, adjusted_revenue``). ``excluded_campaigns`` are meta
    names left out with ``!=`` (NULL names drop too, Q4).
    """
    from blendwise.operators.commerce import period_refund, returning_orders
    from blendwise.operators.scenario import goal_rollup

    meta = inputs["meta"]
    if excluded_campaigns:
        cond = None
        for name in excluded_campaigns:
            term = F.col("campaign_name") != F.lit(name)
            cond = term if cond is None else cond & term
        meta = meta.filter(cond)
    contract = [("date", "date"), ("date_granularity", "string"), ("data_type", "string"),
                ("spend", "double"), ("first_orders", "bigint"), ("returning_orders", "bigint"),
                ("subtotal_sales", "double"), ("first_subtotal_sales", "double")]
    measures = [c for c, _ in contract[3:]]
    spend_rows = [df.groupBy(F.col("date").cast("date").alias("date"), "date_granularity")
                  .agg(F.sum("spend").alias("spend")) for df in (meta, inputs["google"])]
    store = inputs["store"]
    store_rows = store.select(
        F.col("date").cast("date").alias("date"), "date_granularity",
        F.col("first_orders"),
        returning_orders("orders", "first_orders").alias("returning_orders"),
        (F.coalesce(F.col("total_net_sales"), F.lit(0))
         - F.coalesce(period_refund(), F.lit(0))).alias("subtotal_sales"),
        (F.coalesce(F.col("first_order_total_net_sales"), F.lit(0))
         - F.coalesce(period_refund("first_order_"), F.lit(0))).alias("first_subtotal_sales"))
    actual = (stack([align_to(df.withColumn("data_type", F.lit("Actual")), contract, measures)
                     for df in [*spend_rows, store_rows]])
              .filter(F.col("date_granularity").isin(list(grains)))
              .groupBy("date", "date_granularity", "data_type")
              .agg(F.sum("spend").alias("original_spend"), F.sum("spend").alias("spend"),
                   F.sum("first_orders").alias("first_orders"),
                   F.sum("returning_orders").alias("returning_orders"),
                   F.sum("subtotal_sales").alias("total_sales"),
                   F.sum("first_subtotal_sales").alias("first_total_sales")))

    def sheet(prefix, label):
        p = prefix
        out = goal_rollup(inputs["forecast"], "date", grains, {
            "original_spend": F.sum(f"{p}spend" if p else "original_spend"),
            "spend": F.sum(f"{p}spend" if p else "original_spend"),
            "first_orders": F.sum(f"{p}acquisitions"),
            "returning_orders": F.sum(f"{p}returning"),  # by name, not position (Q3)
            "total_sales": F.sum(f"{p}revenue"),
            "first_total_sales": F.sum(F.lit(0))})
        return out.withColumn("data_type", F.lit(label))

    out_contract = [("date", "date"), ("date_granularity", "string"), ("data_type", "string"),
                    ("original_spend", "double"), ("spend", "double"), ("first_orders", "bigint"),
                    ("returning_orders", "bigint"), ("total_sales", "double"),
                    ("first_total_sales", "double")]
    out = stack([align_to(df, out_contract) for df in
                 (actual, sheet("", "Forecasted"), sheet("adjusted_", "Adjusted Forecasted"))])
    return out.orderBy(F.desc("date")) if sort else out


# --------------------------------------------------------------------------
# actual_goal_stretch: spend stack with splits and a cut-over, goals, stretch
# --------------------------------------------------------------------------

@with_date_range
def actual_goal_stretch(inputs: Mapping[str, DataFrame], as_of=None,
                        switch_date=K.AFFILIATE_SWITCH_DATE, grains: Sequence[str] = GRAINS,
                        purchases_how: str = "left",
                        social_retention_pattern: str = K.SOCIAL_RETENTION_PATTERN,
                        search_brand_pattern: str = K.SEARCH_BRAND_PATTERN,
                        brand_acq_share: float = K.BRAND_ACQUISITION_SHARE,
                        sort: bool = False) -> DataFrame:
    """Actual spend (acquisition / retention split) and purchases beside goal and
    stretch sheets, capped at ``as_of`` (R1, R21, R22, R20, R18, F7, J2).

    Inputs: ``meta``, ``google``, ``pinterest`` (ads facts with campaign_name),
    ``affiliate_old`` (daily ``date, ft_spend, ret_spend``), ``affiliate_new``
    (period grain ``date, date_granularity, action_cost, customer_status,
    actions, revenue``), ``bi`` (daily purchases sheet), ``goal`` and
    ``stretch`` (daily sheets). The old affiliate source serves periods
    starting on or before ``switch_date``, the new one later periods (Q33).
    Purchases are left-joined to spend (``purchases_how``, Q35).
    """
    from blendwise.operators.allocate import split_spend
    from blendwise.operators.calendar import cap_at, cutover
    from blendwise.operators.scenario import goal_rollup

    contract = [("date", "date"), ("date_granularity", "string"), ("spend", "double"),
                ("acq_spend", "double"), ("ret_spend", "double"), ("impressions", "bigint"),
                ("clicks", "bigint"), ("purchases", "bigint"), ("revenue", "double")]
    measures = [c for c, _ in contract[2:]]

    def platform(df, pattern, share, null_name, clicks="clicks"):
        acq, ret = split_spend("campaign_name", "spend", pattern, share, null_name)
        return df.select(F.col("date").cast("date").alias("date"), "date_granularity", "spend",
                         acq.alias("acq_spend"), ret.alias("ret_spend"), "impressions",
                         F.col(clicks).alias("clicks"), "purchases", "revenue")

    meta = platform(inputs["meta"], social_retention_pattern, 0.0, "zero", "link_clicks")
    google = platform(inputs["google"], search_brand_pattern, brand_acq_share, "null")
    pin = inputs["pinterest"].select(F.col("date").cast("date").alias("date"), "date_granularity",
                                     "spend", F.col("spend").alias("acq_spend"),
                                     F.lit(0.0).alias("ret_spend"), "impressions", "clicks",
                                     "purchases", "revenue")
    old = goal_rollup(inputs["affiliate_old"], "date", grains, {
        "spend": F.sum(F.col("ft_spend") + F.col("ret_spend")),
        "acq_spend": F.sum("ft_spend"), "ret_spend": F.sum("ret_spend")})
    new_src = inputs["affiliate_new"].filter(F.col("date_granularity").isin(list(grains)))
    status = F.col("customer_status")
    new = new_src.groupBy(F.col("date").cast("date").alias("date"), "date_granularity").agg(
        F.sum("action_cost").alias("spend"),
        F.sum(F.when(status == "New", F.col("action_cost")).otherwise(0)).alias("acq_spend"),
        F.sum(F.when(status == "Existing", F.col("action_cost")).otherwise(0)).alias("ret_spend"),
        F.sum("actions").alias("purchases"), F.sum("revenue").alias("revenue"))
    affiliate = cutover(align_to(old, contract, measures), align_to(new, contract, measures),
                        switch_date)
    spend = (stack([align_to(df, contract, measures) for df in (meta, google, pin)] + [affiliate])
             .filter(F.col("date_granularity").isin(list(grains)))
             .groupBy("date", "date_granularity")
             .agg(*[F.sum(m).alias(m) for m in measures])
             .withColumn("data_type", F.lit("Actual")))
    purchases = goal_rollup(inputs["bi"], "date", grains, {
        "acquisitions": F.sum("ft_orders"), "first_time_sales": F.sum("ft_sales"),
        "repurchase_sales": F.sum("ret_sales"), "total_sales": F.sum("total_sales"),
        "repurchase_orders": F.sum("ret_orders")}).withColumn("data_type", F.lit("Actual"))
    actual = spend.join(purchases, ["date", "date_granularity", "data_type"], purchases_how)

    def goals(df, label, ret_orders):
        out = goal_rollup(df, "date", grains, {
            "spend": F.sum("spend"), "acq_spend": F.sum("acq_spend"),
            "ret_spend": F.sum("spend") - F.sum("acq_spend"),
            "acquisitions": F.sum("ft_orders"), "first_time_sales": F.sum("ft_revenue"),
            "repurchase_sales": F.sum("ret_revenue"),
            "total_sales": F.sum(F.col("ft_revenue") + F.col("ret_revenue")),
            "repurchase_orders": ret_orders})
        return out.withColumn("data_type", F.lit(label))

    out_contract = [("date", "date"), ("date_granularity", "string"), ("data_type", "string"),
                    ("spend", "double"), ("acq_spend", "double"), ("ret_spend", "double"),
                    ("impressions", "bigint"), ("clicks", "bigint"), ("purchases", "bigint"),
                    ("revenue", "double"), ("acquisitions", "bigint"),
                    ("first_time_sales", "double"), ("repurchase_sales", "double"),
                    ("total_sales", "double"), ("repurchase_orders", "bigint")]
    parts = [actual, goals(inputs["goal"], "Goal", F.sum("ret_orders")),
             goals(inputs["stretch"], "Stretch", F.sum(F.lit(0)))]
    out = stack([cap_at(align_to(df, out_contract), as_of) for df in parts])
    return out.orderBy(F.desc("date")) if sort else out  # O1, presentation only


# --------------------------------------------------------------------------
# calendar_spine_blend: every date, spend / traffic / new-vs-recurring store
# --------------------------------------------------------------------------

@with_date_range
def calendar_spine_blend(inputs: Mapping[str, DataFrame], spine_start=None, as_of=None,
                         market: str = "US", profile: str | None = None, spine_grains: bool = False) -> DataFrame:
    """Calendar spine left-joined to spend (on date only), then traffic and
    store-by-type on (date, grain) (R3, R45, R43, R44, R17, Q17).

    Inputs: ``meta`` (with ``campaign_country, campaign_type_default``),
    ``google`` (with ``campaign_country``), ``bing``, ``web`` (``profile, date,
    date_granularity, sessions``), ``store_by_type`` (``dg, date_granularity,
    order_type, revenue, orders``). Measures stay NULL where nothing joins.
    With ``spine_grains`` the spine holds every period of every grain, from the grain's first to its last
    one in any of the facts, and all facts join it on (date, grain): no traffic or
    store row is lost for want of spend (Q17 repaired); ``spine_start`` is not needed then.
    """
    from blendwise.operators.calendar import cap_at, spine as make_spine
    from blendwise.operators.classify import acquisition_spend
    from blendwise.operators.funnel import new_vs_recurring

    contract = [("date", "date"), ("date_granularity", "string"), ("acquisition_spend", "double"),
                ("spend", "double"), ("clicks", "bigint"), ("impressions", "bigint"),
                ("revenue", "double"), ("purchases", "bigint")]
    measures = [c for c, _ in contract[2:]]
    meta = inputs["meta"].filter(F.col("campaign_country") == F.lit(market)).select(
        "date", "date_granularity",
        acquisition_spend("campaign_type_default", "spend").alias("acquisition_spend"),
        "spend", F.col("link_clicks").alias("clicks"), "impressions", "revenue", "purchases")
    google = inputs["google"].filter(F.col("campaign_country") == F.lit(market))
    spend = (stack([align_to(df, contract, measures) for df in (meta, google, inputs["bing"])])
             .groupBy("date", "date_granularity")
             .agg(*[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in measures])
             .withColumnRenamed("purchases", "paid_purchases"))
    web = inputs["web"]
    if profile is not None:
        web = web.filter(F.col("profile") == F.lit(profile))
    traffic = (web.groupBy(F.col("date").cast("date").alias("date"), "date_granularity")
               .agg(F.sum("sessions").alias("traffic")))
    store = new_vs_recurring(inputs["store_by_type"],
                             [F.col("dg").cast("date").alias("date"), "date_granularity"])
    if spine_grains:
        from blendwise.operators.joins import gap_fill
        facts = ["acquisition_spend", "spend", "clicks", "impressions", "revenue", "paid_purchases", "traffic",
                 "new_revenue", "returning_revenue", "new_purchases", "returning_purchases"]
        fact_contract = [("date", "date"), ("date_granularity", "string"),
                         *[(c, t) for c, t in (*spend.dtypes, *traffic.dtypes, *store.dtypes) if c in facts]]
        merged = (stack([align_to(df, fact_contract) for df in (spend, traffic, store)])
                  .groupBy("date", "date_granularity").agg(*[F.max(c).alias(c) for c in facts]))  # one row a source and period
        out = gap_fill(merged, [])
    else:
        spine = make_spine(inputs["web"].sparkSession, spine_start, as_of)
        out = (spine.join(spend, ["date"], "left")
               .join(traffic, ["date", "date_granularity"], "left")
               .join(store, ["date", "date_granularity"], "left"))
    out = cap_at(out, as_of)
    return out.select("date", "date_granularity", "spend", "acquisition_spend", "clicks",
                      "impressions", "revenue", "paid_purchases", "traffic", "new_revenue",
                      "returning_revenue", "new_purchases", "returning_purchases")


# --------------------------------------------------------------------------
# subsource_stack: stack same-schema upstream relations
# --------------------------------------------------------------------------

@with_date_range
def subsource_stack(inputs: Mapping[str, DataFrame]) -> DataFrame:
    """Stack upstream sub-source relations that share one schema."""
    from blendwise.operators.blend import stack_relations
    return stack_relations(list(inputs.values()))


# --------------------------------------------------------------------------
# attributed_campaign_blend / attributed_spend_blend
# --------------------------------------------------------------------------

def _attributed_store(inputs, channel_rules, measures, exact_scale, shared):
    from blendwise.operators.attribution import attribute_measures, linear_attribution
    C.validate(inputs["touches"], C.TOUCHES, ["order_id", "source", "campaign_id", "click_date",
                                              "type", "_fivetran_deleted"])
    C.validate(inputs["orders"], C.ORDERS)
    C.validate(inputs["store_order"], C.STORE_ORDER)
    touches = linear_attribution(inputs["touches"], inputs["orders"], channel_rules)
    sales, touches = (_step(df, shared) for df in (inputs["store_order"], touches))
    conv = _step(attribute_measures(sales, touches, measures, exact_scale=exact_scale), shared)
    if shared is not None:
        shared.drop(sales, touches)
    return conv


def _daily_paid(df, channel, clicks_col, extra=()):
    """Day-grain paid rows with any activity, summed per campaign."""
    from blendwise.operators.blend import active_rows
    day = df.filter(F.col("date_granularity") == "day")
    day = active_rows(day, ["spend", clicks_col, "impressions"])
    return day.groupBy(F.lit(channel).alias("channel"),
                       F.col("campaign_id").cast("string").alias("campaign_id"), "campaign_name",
                       F.col("date").cast("date").alias("date")).agg(
        F.sum("spend").alias("spend"), F.sum("impressions").alias("impressions"),
        F.sum(clicks_col).alias("clicks"), *[F.sum(src).alias(dst) for src, dst in extra])


def _step(df, shared):
    """``df`` written before what comes after it, so that its shuffle files are gone by then (``shared``), or as it is."""
    return df if shared is None else shared.written(df)


@with_date_range
def attributed_campaign_blend(inputs: Mapping[str, DataFrame], exact_scale: int | None = None,
                              dedupe_names: bool = False, shared=None) -> DataFrame:
    """Linear-attributed store revenue by campaign, blended with paid, web and
    tracker facts in a chain of full outer joins with shrinking keys
    (R6, R8, R10, R9, R11, R7, R43, R12, R13; Q10, Q11, Q12).

    Inputs: ``touches``, ``orders`` (``order_id, order_date``), ``store_order``
    (order grain), ``meta`` (campaign grain, period facts), ``meta_ads``
    (ad grain: campaign ids and names for the name lookup; without it those of ``meta``), ``google``,
    ``web`` (``date, session_source_medium, session_campaign_id, sessions,
    engaged_sessions, conversions_purchase, purchase_revenue``), ``tracker``. With ``shared`` (a
    ``session.Shared`` that the caller releases) a platform that gives both spend and names is derived once, and sales, touches and
    conversions are written one after the other.
    """
    from blendwise.operators.blend import campaign_dimension
    from blendwise.operators.commerce import sales_components

    rules = K.ATTRIBUTION_CHANNELS_TWO
    c, f = sales_components(), sales_components("first_order_")
    measures = {
        "revenue": c["sales_amount"], "total_revenue": c["total_sales_amount"],
        "new_revenue": f["sales_amount"], "total_new_revenue": f["total_sales_amount"],
        "refunds": c["refund_amount"], "total_refunds": c["total_refund_amount"],
        "new_refunds": f["refund_amount"], "total_new_refunds": f["total_refund_amount"],
        "net_revenue": c["sales_amount"] - c["refund_amount"],
        "total_net_revenue": c["total_sales_amount"] - c["total_refund_amount"],
        "purchases": F.col("orders"), "new_purchases": F.col("first_orders")}
    conv = _attributed_store(inputs, rules, measures, exact_scale, shared)
    google = _step(inputs["google"], shared)
    meta = meta_ads = inputs["meta"]
    if "meta_ads" in inputs:
        meta_ads = inputs["meta_ads"]
    else:
        meta = meta_ads = _step(meta, shared)
    dim = campaign_dimension([(meta_ads, "Facebook", "campaign_id", "campaign_name"),
                              (google, "Google Ads", "campaign_id", "campaign_name")],
                             dedupe_names=dedupe_names)
    conversion = conv.join(dim, ["channel", "campaign_id"], "left")
    paid = stack([
        _daily_paid(meta, "Facebook", "link_clicks",
                    [("purchases", "paid_purchases"), ("revenue", "paid_revenue")]),
        _daily_paid(google, "Google Ads", "clicks",
                    [("purchases", "paid_purchases"), ("revenue", "paid_revenue")])])
    from blendwise.operators.classify import bucket_exact
    web_channel = bucket_exact("session_source_medium",
                               {label: [medium] for medium, label in K.WEB_MEDIUM_CHANNELS}, K.OTHER)
    web = inputs["web"].groupBy(
        F.col("date").cast("date").alias("date"), web_channel.alias("channel"),
        F.col("session_campaign_id").cast("string").alias("campaign_id")).agg(
        F.sum("sessions").alias("sessions"), F.sum("engaged_sessions").alias("engaged_sessions"),
        F.sum("conversions_purchase").alias("ga4_purchases"),
        F.sum("purchase_revenue").alias("ga4_revenue"))
    tracker = inputs["tracker"].groupBy(
        F.col("date").cast("date").alias("date"), F.lit("Other").alias("channel"),
        F.lit(K.NOT_SET).alias("campaign_id")).agg(
        F.sum("forecasted_spend").alias("forecasted_spend"),
        F.sum("forecasted_revenue").alias("forecasted_revenue"),
        F.sum("actual_total_spend").alias("tw_spend"), F.sum("sessions").alias("tw_sessions"))
    k3 = ["date", "channel", "campaign_id"]
    # web and tracker have a row per key: met first, they join the wide rows in one shuffle instead of two
    blended = full_outer_blend([(_step(conversion, shared), None), (_step(paid, shared), k3 + ["campaign_name"]),
                                (_step(full_outer(web, tracker, k3), shared), k3)])
    z = lambda n: F.coalesce(F.col(n), F.lit(0))
    return blended.select(
        "date", "channel", "campaign_id", "campaign_name",
        *[z(n).alias(n) for n in ("spend", "impressions", "clicks", "paid_purchases",
                                  "paid_revenue", "net_revenue", "revenue", "total_net_revenue",
                                  "total_revenue")],
        (z("new_revenue") - z("new_refunds")).alias("net_new_revenue"), z("new_revenue").alias("new_revenue"),
        (z("total_new_revenue") - z("total_new_refunds")).alias("total_net_new_revenue"),
        z("total_new_revenue").alias("total_new_revenue"),
        *[z(n).alias(n) for n in ("purchases", "new_purchases", "sessions", "engaged_sessions",
                                  "ga4_purchases", "ga4_revenue", "forecasted_spend",
                                  "forecasted_revenue", "tw_spend", "tw_sessions")])


@with_date_range
def attributed_spend_blend(inputs: Mapping[str, DataFrame], exact_scale: int | None = None,
                           pmax_pattern: str = "Pmax", strict_money: bool = False, rejects: Observation | None = None,
                           shared=None) -> DataFrame:
    """Attributed store revenue blended with three paid platforms, one of which
    reports money as text and soft-deletes rows (R8-R11, R7, M5, F3, F12).

    Inputs: ``touches``, ``orders``, ``store_order``, ``meta_ads`` (ad grain),
    ``google`` (campaign grain), ``google_ads`` (ad grain), ``network``
    (``day, campaign_id_external, campaign, cost, impressions, clicks,
    _fivetran_deleted``). Sales here are the full totals (with tax and
    shipping); refunds the full refund totals. A cost text that is no number
    counts as no cost, or fails the job with ``strict_money``. ``rejects``, an ``Observation``, gets ``costs``,
    ``unreadable_costs`` and ``blank_costs`` (rows of the network) with the first action on
    the result, without another pass. With ``shared`` (a ``session.Shared`` that the caller
    releases) each platform's daily rows are written once for spend and names, and sales, touches and conversions one after the other.
    """
    from blendwise.functions.numeric import count_blank, count_unparsed, parse_money
    from blendwise.operators.blend import campaign_dimension, soft_delete
    from blendwise.operators.commerce import sales_components

    rules = K.ATTRIBUTION_CHANNELS_THREE
    c, f = sales_components(), sales_components("first_order_")
    sales, first = c["total_sales_amount"], f["total_sales_amount"]
    refund, first_refund = c["total_refund_amount"], f["total_refund_amount"]
    measures = {"revenue": sales, "new_revenue": first, "refunds": refund,
                "new_refunds": first_refund, "net_revenue": sales - refund,
                "purchases": F.col("orders"), "new_purchases": F.col("first_orders")}
    conv = _attributed_store(inputs, rules, measures, exact_scale, shared)
    network = soft_delete(inputs["network"])
    net_named = network.select(F.col("campaign_id_external").cast("string").alias("campaign_id"),
                               F.col("campaign").alias("campaign_name"))
    meta_ads, google = (_step(inputs[k], shared) for k in ("meta_ads", "google"))
    dim = campaign_dimension([(meta_ads, "Facebook", "campaign_id", "campaign_name"),
                              (google, "Google Ads", "campaign_id", "campaign_name"),
                              (net_named, "App Lovin", "campaign_id", "campaign_name")])
    conversion = conv.join(dim, ["channel", "campaign_id"], "left")
    from blendwise.functions.text import imatch
    pmax = google.filter(imatch("campaign_name", pmax_pattern))
    if rejects is not None:
        network = network.observe(rejects, F.count("cost").alias("costs"), count_unparsed("cost").alias("unreadable_costs"),
                                  count_blank("cost").alias("blank_costs"))
    net_paid = network.groupBy(
        F.lit("App Lovin").alias("channel"),
        F.col("campaign_id_external").cast("string").alias("campaign_id"),
        F.col("campaign").alias("campaign_name"), F.col("day").cast("date").alias("date")).agg(
        F.sum(parse_money("cost", strict_money)).alias("spend"), F.sum("impressions").alias("impressions"),
        F.sum("clicks").alias("clicks"))
    paid = stack([_daily_paid(meta_ads, "Facebook", "link_clicks"),
                  _daily_paid(pmax, "Google Ads", "clicks"),
                  _daily_paid(inputs["google_ads"], "Google Ads", "clicks"), net_paid])
    if rejects is None:  # they are counted by the first action on the result
        paid = _step(paid, shared)
    blended = full_outer_blend([(_step(conversion, shared), None),
                                (paid, ["date", "channel", "campaign_id", "campaign_name"])])
    z = lambda n: F.coalesce(F.col(n), F.lit(0))
    return blended.select(
        "date", "channel", "campaign_id", "campaign_name",
        *[z(n).alias(n) for n in ("spend", "impressions", "clicks", "net_revenue", "revenue")],
        (z("new_revenue") - z("new_refunds")).alias("net_new_revenue"),
        *[z(n).alias(n) for n in ("new_revenue", "purchases", "new_purchases")])


# --------------------------------------------------------------------------
# crm_lead_funnel: CRM funnel per grain stacked with two platforms
# --------------------------------------------------------------------------

CRM_MEASURES = ("spend", "impressions", "clicks", "crm_leads", "crm_replied", "crm_appointments",
                "platform_appointments", "platform_leads", "booked_appointment",
                "completed_appointment", "booking_complete")
CRM_KEYS = ("date", "date_granularity", "channel", "location", "campaign_type", "campaign_name",
            "adset_name", "ad_name", "service")


@with_date_range
def crm_lead_funnel(inputs: Mapping[str, DataFrame], service_rules: Sequence[tuple],
                    meta_buckets: Mapping[str, Sequence[str]], search_rules: Sequence[tuple],
                    grains: Sequence[str] = GRAINS) -> DataFrame:
    """CRM leads per grain beside social and search platform facts.

    Inputs: ``leads`` (CRM sheet), ``meta`` (ad grain with ``location,
    service, appointments_scheduled, leads, booked_appointment,
    completed_appointment, booking_complete``), ``google`` (campaign grain with
    ``appointments_scheduled``). Social campaign types come from exact-name
    buckets (default 'Other'), search types from keyword rules (no default).
    Leads of other mediums drop out (Q41).
    """
    from blendwise.operators.classify import bucket_exact, classify
    from blendwise.operators.funnel import crm_funnel

    funnel = crm_funnel(inputs["leads"], service_rules, grains).withColumnsRenamed(
        {"leads": "crm_leads", "replied": "crm_replied", "appointments": "crm_appointments"})
    contract = [(k, "date" if k == "date" else "string") for k in CRM_KEYS] + [
        (m, "double" if m == "spend" else "bigint") for m in CRM_MEASURES]
    meta = inputs["meta"].filter(F.col("date_granularity").isin(list(grains))).select(
        F.col("date").cast("date").alias("date"), "date_granularity", "location", "campaign_name",
        "adset_name", "ad_name", "service", "spend", "impressions",
        F.col("link_clicks").alias("clicks"),
        F.col("appointments_scheduled").alias("platform_appointments"),
        F.col("leads").alias("platform_leads"), "booked_appointment", "completed_appointment",
        "booking_complete").withColumn("channel", F.lit("Facebook"))

    google = inputs["google"].filter(F.col("date_granularity").isin(list(grains))).select(
        F.col("date").cast("date").alias("date"), "date_granularity", "campaign_name", "spend",
        "impressions", "clicks", F.col("appointments_scheduled").alias("platform_appointments")
    ).withColumn("channel", F.lit("Google"))
    # Search leads count by campaign alone. The channel is a key, so that one roll-up
    # of the leads and one aggregate serve both platforms (Q40).
    social = F.col("channel") == F.lit("Facebook")
    crm = funnel.filter(F.col("channel").isin("Facebook", "Google")).withColumns(
        {k: F.when(social, F.col(k)) for k in ("location", "adset_name", "ad_name", "service")})
    stacked = stack([align_to(df, contract, CRM_MEASURES) for df in (meta, google, crm)])
    kind = F.when(social, bucket_exact("campaign_name", meta_buckets, "Other")).otherwise(
        classify("campaign_name", search_rules))
    return (stacked.withColumn("campaign_type", kind).groupBy(*CRM_KEYS)
            .agg(*_coalesce_sum(CRM_MEASURES)).select(*CRM_KEYS, *CRM_MEASURES))


# --------------------------------------------------------------------------
# app_install_blend: paid app campaigns vs MMP installs with a SKAN correction
# --------------------------------------------------------------------------

APP_CHANNELS = K.APP_CHANNELS


@with_date_range
def app_install_blend(inputs: Mapping[str, DataFrame], app_rules: Sequence[tuple],
                      grains: Sequence[str] = GRAINS, week_start: str = K.APP_WEEK_START) -> DataFrame:
    """Paid app campaigns full-outer-joined to MMP installs with the SKAN
    offset, at every grain with Sunday weeks (R2, R36, R4, R37, R38; Q29-Q31).

    Inputs: ``mmp`` (``date, app, source, campaign_name, sessions, installs,
    rc_trial_started_users, rc_trial_converted_users, rc_initial_purchase_users,
    revenue``), ``skan`` (``date, source, campaign_name, installs``), ``meta``
    and ``google`` (period facts with app measures), ``video_raw``
    (``stat_time_day, campaign_id, campaign_name, spend, clicks, impressions,
    skan_app_install, skan_start_trial``). ``app_rules`` map campaign names to
    an app platform (default 'Other').
    """
    from blendwise.functions.aggs import sum_ as s_
    from blendwise.operators.classify import classify

    self_attr = [src for src, _ in APP_CHANNELS]

    def channel_of(src):
        out = None
        for value, label in APP_CHANNELS:
            out = F.when(src == value, F.lit(label)) if out is None else out.when(src == value, F.lit(label))
        return out.otherwise(src)

    src = F.col("source")
    mmp_keys = [F.col("app"), channel_of(src).alias("channel"), F.col("campaign_name")]
    mmp = granularity_rollup(inputs["mmp"], "date", mmp_keys, {
        "sessions": s_("sessions"),
        "apps_installs": s_(F.when(src.isin(self_attr), F.lit(0)).otherwise(F.col("installs"))),
        "apps_trial_started": s_("rc_trial_started_users"),
        "apps_trial_converted": s_("rc_trial_converted_users"),
        "apps_initial_purchase": s_("rc_initial_purchase_users"),
        "apps_revenue": s_("revenue")}, grains=grains, week_start=week_start)
    skan_keys = [F.lit("iOS").alias("app"), channel_of(src).alias("channel"),
                 F.when(src == K.SKAN_OFFSET_CHANNEL, F.lit(K.NOT_SET_BARE)).otherwise(F.col("campaign_name"))
                 .alias("campaign_name")]
    skan = granularity_rollup(inputs["skan"], "date", skan_keys,
                              {"apps_installs": s_("installs")}, grains=grains,
                              week_start=week_start)
    # The negated SKAN total per period, merged from the SKAN roll-up (no second scan).
    offset = (skan.groupBy("date", "date_granularity")
              .agg((-F.sum("apps_installs")).alias("apps_installs"))
              .withColumns({"app": F.lit("iOS"), "channel": F.lit(K.SKAN_OFFSET_CHANNEL),
                            "campaign_name": F.lit(K.NOT_SET_BARE)}))
    mmp_measures = ["sessions", "apps_installs", "apps_trial_started", "apps_trial_converted",
                    "apps_initial_purchase", "apps_revenue"]
    k5 = ["date_granularity", "date", "app", "channel", "campaign_name"]
    mmp_contract = [("date_granularity", "string"), ("date", "date"), ("app", "string"),
                    ("channel", "string"), ("campaign_name", "string")] + \
        [(m, "double" if m == "apps_revenue" else "bigint") for m in mmp_measures]
    mmp_all = (stack([align_to(d, mmp_contract, mmp_measures) for d in (mmp, skan, offset)])
               .groupBy(*k5).agg(*[F.sum(F.coalesce(F.col(m), F.lit(0))).alias(m)
                                   for m in mmp_measures]))

    app = classify("campaign_name", app_rules, "Other")
    paid_measures = ["spend", "clicks", "impressions", "installs", "trial_started",
                     "trial_converted", "initial_purchase", "trial_converted_value",
                     "initial_purchase_value"]
    paid_contract = [("channel", "string"), ("campaign_id", "string"), ("campaign_name", "string"),
                     ("date", "date"), ("date_granularity", "string"), ("app", "string")] + \
        [(m, "bigint" if m not in ("spend", "trial_converted_value", "initial_purchase_value")
          else "double") for m in paid_measures]
    platform = []
    for key, label, clicks in (("meta", "Meta", "link_clicks"), ("google", "Google Ads", "clicks")):
        df = inputs[key].filter(F.col("date_granularity").isin(list(grains)))
        platform.append(align_to(df.select(
            F.lit(label).alias("channel"), F.col("campaign_id").cast("string").alias("campaign_id"),
            "campaign_name", F.col("date").cast("date").alias("date"), "date_granularity",
            app.alias("app"), "spend", F.col(clicks).alias("clicks"), "impressions",
            F.col("app_install").alias("installs"), "trial_started", "trial_converted",
            "initial_purchase", "trial_converted_value", "initial_purchase_value"),
            paid_contract, paid_measures))
    raw = granularity_rollup(
        inputs["video_raw"], "stat_time_day",
        [F.lit("Tiktok Ads").alias("channel"), F.col("campaign_id").cast("string").alias("campaign_id"),
         "campaign_name", app.alias("app")],
        {"spend": s_("spend", fill=0), "clicks": s_("clicks", fill=0),
         "impressions": s_("impressions", fill=0), "installs": s_("skan_app_install", fill=0),
         "trial_started": s_("skan_start_trial", fill=0)},
        grains=grains, week_start=week_start)
    platform.append(align_to(raw, paid_contract, paid_measures))
    pkeys = [c for c, _ in paid_contract[:6]]
    # each platform is a channel of its own and is summed where its roll-up lies, without another shuffle
    paid = stack([p.groupBy(*pkeys).agg(
        *[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in paid_measures[:7]],
        (F.coalesce(F.sum("trial_converted_value"), F.lit(0))
         + F.coalesce(F.sum("initial_purchase_value"), F.lit(0))).alias("revenue")) for p in platform])

    from blendwise.operators.blend import app_blend
    out_measures = ["spend", "clicks", "impressions", "installs", "sessions", "revenue",
                    "apps_revenue", "initial_purchase", "trial_converted", "trial_started",
                    "apps_installs", "apps_initial_purchase", "apps_trial_converted",
                    "apps_trial_started"]
    agg = app_blend(paid, mmp_all, ["channel", "date", "date_granularity", "campaign_name", "app"],
                    out_measures)
    return agg.select("channel", "app", "campaign_name", "campaign_id", "date", "date_granularity",
                      *out_measures)


# --------------------------------------------------------------------------
# regional_commerce_forecast: regional paid spend + store metrics vs forecast
# --------------------------------------------------------------------------

@with_date_range
def regional_commerce_forecast(inputs: Mapping[str, DataFrame], spend_branches: Sequence[Mapping],
                               regions: Mapping[str, str], families: Mapping[str, Mapping],
                               forecasts: Sequence[tuple], spine_start=None, as_of=None,
                               regions_from: str = "spend", sort: bool = False) -> DataFrame:
    """Paid spend by region, store orders / revenue / product units by region,
    on a calendar spine, stacked with unpivoted regional forecasts
    (R23, R24, R25, R26, R27, R17, R19, R18; Q36-Q39).

    Inputs: ``orders`` (order rows) and ``lines`` (line rows), both with ``region``
    and ``date``: the region is a key, so each is read once for all regions.
    ``spend_branches``: dicts with ``df`` (``date, region, spend, revenue,
    purchases``), optional ``where`` (row filter), ``paid`` (Column for
    ``paid_spend``; default spend). Regions 'Other' are dropped.
    ``regions[name]``: ``'tax_net'`` (orders netted of tax) or ``'lines'``
    (gross minus discounts from line sales, counts from lines).
    ``families[name]``: product-unit rules per family for that region (R27).
    ``forecasts``: ``(sheet, mapping)`` pairs for ``unpivot_regions``.
    The spine runs from ``spine_start`` to ``as_of``, or over the days that the one row of
    ``inputs["days"]`` (``first, last``) names. Spend joins it on date, store
    rows on (date, region), so region comes from spend and sales of a region without
    spend that day are lost (Q36); ``regions_from='both'`` keeps them.
    """
    from blendwise.functions.numeric import tax_net
    from blendwise.operators.blend import full_outer, regional_paid_spend
    from blendwise.operators.calendar import cap_at, spine as make_spine, spine_between
    from blendwise.operators.commerce import order_counts, unit_values
    from blendwise.operators.scenario import unpivot_regions

    if regions_from not in ("spend", "both"):
        raise ValueError("regions_from is 'spend' or 'both'")
    spend_cols = ["spend", "paid_spend", "paid_revenue", "paid_purchases"]
    spend = regional_paid_spend(spend_branches)

    family_names = list(next(iter(families.values())).keys())
    by_lines = F.col("region").isin([r for r, how in regions.items() if how == "lines"])
    first = F.col("customer_order_index") == 1
    day = F.col("date").cast("date").alias("date")
    orders = inputs["orders"].where(F.col("region").isin(list(regions)) & ~by_lines).withColumn("date", day)
    net = lambda c: tax_net(c, "total_tax", "total_revenue")
    sold = order_counts(orders, ["region", "date"], "order_id", first,
                        extra={"gross_revenue": sum_(net("gross_revenue"), fill=0),
                               "total_discounts": sum_(net("subtotal_discount"), fill=0)})
    units = {n: F.lit(0).cast("long") for n in family_names}
    for region, rules in families.items():
        own = unit_values("product_title", "quantity", rules)
        units = {n: F.when(F.col("region") == region, own[n]).otherwise(units[n]) for n in family_names}
    lines = inputs["lines"].where(F.col("region").isin(list(regions))).withColumn("date", day)
    shipped = order_counts(lines, ["region", "date"], "order_id", first,
                           extra={"gross_revenue": sum_("gross_sales", fill=0),
                                  "total_discounts": sum_(F.col("gross_sales") - F.col("subtotal_sales"), fill=0),
                                  **{n: sum_(c) for n, c in units.items()}})
    # Units join the day's order rows; line counts and sales hold where a region takes them from lines.
    money_cols = ["orders", "first_orders", "gross_revenue", "total_discounts"]
    stacked = stack([
        sold.select("region", "date", F.lit(True).alias("__sold"), *money_cols,
                    *[F.lit(None).cast("long").alias(n) for n in family_names]),
        shipped.select("region", "date", by_lines.alias("__sold"), *[F.when(by_lines, F.col(c)).alias(c) for c in money_cols], *family_names)])
    merged = stacked.groupBy("region", "date").agg(F.max("__sold").alias("__sold"), *[F.sum(c).alias(c) for c in (*money_cols, *family_names)])
    store_measures = ["orders", "first_orders", "revenue", *family_names]
    store = merged.where("__sold").select(
        "region", "date", *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("orders", "first_orders")],
        F.coalesce(F.col("gross_revenue") - F.col("total_discounts"), F.lit(0.0)).alias("revenue"),
        *[F.coalesce(F.col(n), F.lit(0)).alias(n) for n in family_names])

    if inputs.get("days") is not None:
        spine = spine_between(inputs["days"])
    else:
        spine = cap_at(make_spine(spend.sparkSession, spine_start, as_of), as_of, start=spine_start)
    if regions_from == "both":
        actual = spine.join(full_outer(spend, store, ["date", "region"]), ["date"], "left")
    else:
        actual = spine.join(spend, ["date"], "left").join(store, ["date", "region"], "left")
    actual = actual.withColumn("type", F.lit("Actual"))

    measures = [*spend_cols, *store_measures]
    forecast_parts = []
    for sheet, mapping in forecasts:
        long = unpivot_regions(sheet.withColumn("date", F.col("date").cast("date")), ["date"],
                               mapping, measures)
        forecast_parts.append(long)
    forecast = (stack(forecast_parts).groupBy("region", "date")
                .agg(*[F.sum(m).alias(m) for m in measures]).withColumn("type", F.lit("Forecasted")))
    cols = ["type", "region", "date", *measures]
    contract = [("type", "string"), ("region", "string"), ("date", "date")] + \
        [(m, "double") for m in measures]
    out = stack([align_to(actual.select(*cols), contract), align_to(forecast.select(*cols), contract)])
    return out.orderBy(F.desc("date")) if sort else out  # O1, presentation only


# --------------------------------------------------------------------------
# touch_orders_fee_allocation: touch orders + five paid branches + fee pool
# --------------------------------------------------------------------------

SE_KEYS = ("channel", "date", "date_granularity", "market", "product", "google_campaign",
           "bing_campaign", "utm_campaign", "campaign_type", "utm_content", "utm_term")
SE_MEASURES = ("spend", "impressions", "clicks", "add_to_cart", "checkout_initiated", "leads",
               "purchases", "VS-01 WK", "revenue", "ft_orders", "lt_orders")


def default_campaign_type_rules():
    """Touch campaign types from Google / Bing names and the utm (C4); first match wins.

    Keywords come from ``constants.CAMPAIGN_TYPE_KEYWORDS``; this function only
    says which fields each keyword is tested on.
    """
    from blendwise.functions.text import imatch as m
    kw = {entry[0]: entry[1:] for entry in K.CAMPAIGN_TYPE_KEYWORDS}
    g, b, u, ch = "google_campaign", "bing_campaign", "utm_campaign", "channel"

    def either(cols, pattern):
        return m(cols[0], pattern) | m(cols[1], pattern)

    shop, brand = kw["Shopping - Brand"]
    return [
        (either((g, b), kw["Amazon"][0]), "Amazon"),
        (either((g, u), kw["Demand Gen"][0]), "Demand Gen"),
        (m(g, kw["Youtube"][0]) | m(ch, kw["Youtube"][1]), "Youtube"),
        ((m(g, shop) & m(g, brand)) | (m(b, shop) & m(b, brand)), "Shopping - Brand"),
        (m(g, kw["Shopping - Non Brand"][0]) & ~m(g, kw["Shopping - Non Brand"][1]),
         "Shopping - Non Brand"),
        (m(g, kw["PMax"][0]) | m(g, kw["PMax"][1]), "PMax"),
        (either((g, b), kw["Non Brand"][0]), "Non Brand"),
        (either((g, b), kw["Branded"][0]), "Branded"),
        (m(u, kw["Prospecting"][0]) | m(u, kw["Prospecting"][1]), "Prospecting"),
        (m(u, kw["Retargeting"][0]), "Retargeting"),
    ]


@with_date_range
def touch_orders_fee_allocation(
    inputs: Mapping[str, DataFrame], product_rules: Sequence[tuple],
    grains: Sequence[str] = GRAINS, utm_renames: Mapping[str, str] | None = None,
    content_replacements: Sequence[tuple] = K.CONTENT_REPLACEMENTS,
    term_cut: str = K.TERM_CUT, utm_rewrite: tuple | None = None,
    google_rename: tuple | None = None, campaign_type_rules=None,
    share_within_grain: bool = False, pool_switch=K.FEE_POOL_SWITCH, shared=None,
) -> DataFrame:
    """First/last-touch subscription orders per grain, stacked with five paid
    branches that borrow utm fields from the touches, summed at 11 keys, with
    the monthly fee pool allocated by share of spend
    (R30, R31, R35, R32, R3, A10, R33, W2, R34; Q23-Q28, Q43, Q44).

    Inputs: ``touch_export`` (``activation_date, channel, utm_campaign,
    utm_content, utm_term, fta_subs, lta_subs``), ``utm_map`` (``channel,
    campaign_name, utm_campaign``), ``meta`` (ad grain with ``product,
    adset_name, ad_name, add_to_cart, leads, "VS-01 WK"``), ``google``
    (campaign grain with ``country, product, campaign_type_custom,
    checkout_initiated, add_to_cart``), ``bing``.
    ``utm_rewrite`` = ``(must_match, must_not_match_list, replacement)``;
    ``google_rename`` = ``(content, campaign, new_campaign)``. With ``shared`` (a
    ``session.Shared`` that the caller releases) what two steps read is written once.
    """
    from blendwise.functions.text import imatch, replace_all, split_part
    from blendwise.operators.allocate import allocate_fee, video_masks
    from blendwise.operators.attribution import join_spend_to_touch, map_utm
    from blendwise.operators.classify import classify

    touches = inputs["touch_export"].filter(F.col("utm_campaign").isNotNull())
    mapped = map_utm(touches, inputs["utm_map"])
    utm = F.col("utm_campaign").cast("string")
    fixed_utm = utm
    for old, new in (utm_renames or {}).items():
        fixed_utm = F.when(utm == F.lit(old), F.lit(new)).otherwise(fixed_utm)
    rules = campaign_type_rules or default_campaign_type_rules()
    keys = [fixed_utm.alias("utm_campaign"), "google_campaign", "bing_campaign", "utm_content",
            "utm_term",
            classify("channel", [("meta", "Meta"), ("google", "Google Ads"), ("youtube", "Youtube"),
                                 ("bing", "Bing")]).alias("channel_adj"),
            F.when(imatch("utm_campaign", "INTL"), F.lit("INTL")).otherwise(F.lit("US")).alias("market"),
            classify("utm_campaign", product_rules, "Other").alias("product"),
            classify(None, rules, "Other").alias("campaign_type")]
    # The paid branches borrow utm names, which no grain changes: one small aggregate of the touches.
    names = mapped.select(keys[0], "google_campaign", "bing_campaign").distinct()
    if shared is not None:
        names = shared.written(names)

    contract = [(k, "date" if k == "date" else "string") for k in SE_KEYS] + \
        [(m, "double" if m in ("spend", "revenue") else "bigint") for m in SE_MEASURES]

    # No key of a touch row depends on its grain, so the output's keys are made before the roll-up: search rows, which
    # lose content and term, are merged once a day instead of after the fan-out.
    touch_keys = mapped.select("activation_date", *keys, "fta_subs", "lta_subs")
    ch = F.when(F.col("channel_adj").isin("Google Ads", "Youtube"), F.lit("Google Ads")) \
        .otherwise(F.col("channel_adj"))
    searchy = ch.isin("Google Ads", "Bing")
    g_name = F.col("google_campaign")
    if google_rename is not None:
        content, campaign, new_campaign = google_rename
        g_name = F.when((F.col("utm_content") == F.lit(content)) & (g_name == F.lit(campaign)),
                        F.lit(new_campaign)).otherwise(g_name)
    new_utm = replace_all("utm_campaign", K.UTM_REPLACEMENTS)
    if utm_rewrite is not None:
        must, must_not, replacement = utm_rewrite
        cond = imatch("utm_campaign", must)
        for p in must_not:
            cond = cond & ~imatch("utm_campaign", p)
        new_utm = F.when(cond, F.lit(replacement)).otherwise(new_utm)
    touch_rows_of = [ch.alias("channel"), "market", "product", g_name.alias("google_campaign"), "bing_campaign",
                     new_utm.alias("utm_campaign"), "campaign_type",
                     F.when(searchy, F.lit(None)).otherwise(replace_all("utm_content", content_replacements)).alias("utm_content"),
                     F.when(searchy, F.lit(None)).otherwise(split_part("utm_term", term_cut, 1)).alias("utm_term")]
    touch_days = touch_keys.select("activation_date", *touch_rows_of, "fta_subs", "lta_subs")
    if shared is not None:
        touch_days = shared.written(touch_days.groupBy(F.col("activation_date").cast("date").alias("activation_date"), *[k for k in SE_KEYS if k not in ("date", "date_granularity")])
                                    .agg(F.sum("fta_subs").alias("fta_subs"), F.sum("lta_subs").alias("lta_subs")))
    measures = list(SE_MEASURES)

    def rows_of(grains):
        meta = inputs["meta"].filter(F.col("date_granularity").isin(list(grains))).select(
            F.lit("Meta").alias("channel"), F.col("date").cast("date").alias("date"), "date_granularity",
            "product", F.col("campaign_name").cast("string").alias("utm_campaign"),
            classify("campaign_name", [(imatch("campaign_name", "Prospect") | imatch("campaign_name", "Interest"),
                                        "Prospecting"), ("Retarget", "Retargeting")]).alias("campaign_type"),
            F.col("adset_name").alias("utm_content"), F.col("ad_name").alias("utm_term"),
            "spend", "impressions", F.col("link_clicks").alias("clicks"), "add_to_cart", "leads",
            "purchases", "`VS-01 WK`")

        google = inputs["google"].filter(F.col("date_granularity").isin(list(grains)))
        sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in
                ("spend", "impressions", "clicks", "checkout_initiated", "add_to_cart", "purchases",
                 "revenue")]
        gk = ["date", "date_granularity", F.col("country").alias("market"), "product",
              F.col("campaign_type_custom").alias("campaign_type")]
        # CASE WHEN type = 'Amazon' THEN name ELSE COALESCE(matched google_campaign, name) END:
        # a match means google_campaign = name, so every arm is the campaign name. Ids of one name are summed before the
        # join, which repeats a row for every utm of its name; the names are distinct, so none is to be summed after it.
        search = google.filter(F.col("campaign_type_custom") != "Youtube").groupBy(
            *gk, F.col("campaign_name").cast("string").alias("campaign_name")).agg(*sums)
        search = (join_spend_to_touch(search, names, "campaign_name", "google_campaign", ["utm_campaign"])
                  .withColumnRenamed("campaign_name", "google_campaign").withColumn("channel", F.lit("Google Ads")))
        yt_side = names.select("utm_campaign").distinct()
        yt = google.filter(F.col("campaign_type_custom") == "Youtube")
        yt = (yt.join(yt_side, yt["campaign_id"].cast("string") == yt_side["utm_campaign"], "left")
              .groupBy(*gk, F.col("campaign_name").cast("string").alias("google_campaign"), "utm_campaign")
              .agg(*sums).withColumn("channel", F.lit("Google Ads")))
        bing_src = inputs["bing"].filter(F.col("date_granularity").isin(list(grains)))
        bing = join_spend_to_touch(bing_src, names, "campaign_name", "bing_campaign", ["utm_campaign"])
        bing = bing.withColumn("bing_campaign", F.when(F.col("utm_campaign").isNotNull(),
                                                       F.col("campaign_name").cast("string")))
        bing = (bing.groupBy("date", "date_granularity", F.col("country").cast("string").alias("market"),
                             F.col("product").cast("string").alias("product"), "bing_campaign",
                             "utm_campaign",
                             F.col("campaign_type_custom").cast("string").alias("campaign_type"))
                .agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in
                       ("spend", "impressions", "clicks", "purchases", "revenue")])
                .withColumn("channel", F.lit("Bing")))

        touch_rows = granularity_rollup(
            touch_days, "activation_date", [k for k in SE_KEYS if k not in ("date", "date_granularity")],
            {"ft_orders": sum_("fta_subs", fill=0), "lt_orders": sum_("lta_subs", fill=0)}, grains=grains)
        stacked = stack([align_to(df, contract, measures) for df in (meta, search, yt, bing, touch_rows)])
        return stacked.groupBy(*SE_KEYS).agg(
            *[F.coalesce(F.sum(f"`{m}`"), F.lit(0)).alias(m) for m in measures])

    # The fee step reads these rows twice: rows, and share totals that need few of its columns. Rows of different grains never
    # meet, so each grain's are written by themselves: the shuffle files of one are gone before the next begins.
    final = rows_of(grains) if shared is None else stack([shared.written(rows_of([g])) for g in grains])
    video, image = video_masks("channel", "market", "campaign_type", "google_campaign")
    return allocate_fee(final, video, image, share_within_grain=share_within_grain,
                        pool_switch=pool_switch, shared=shared)
