"""Attribution operators.

``linear_attribution`` counts the surviving touches of each order per channel
and campaign; ``attribute_measures`` spreads every order's measures evenly over
its touches. Touches are counted per (order, day, channel, campaign) before they
join the orders (map-side combined), so an order with a huge number of touches is
a handful of rows in the join and in the window that adds up its touch count.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blendwise import constants as K
from blendwise.functions.columns import as_col, zero
from blendwise.functions.dates import GRAINS, to_date
from blendwise.operators.classify import normalise_channel


def linear_attribution(
    touches: DataFrame,
    orders: DataFrame,
    channel_rules: Sequence[tuple],
    lookback_days: int = K.LOOKBACK_DAYS,
    model_type: str | None = K.LINEAR_MODEL,
    order_col: str = "order_id",
    order_date_col: str = "order_date",
    click_col: str = "click_date",
    source_col: str = "source",
    campaign_col: str = "campaign_id",
    type_col: str = "type",
    deleted_col: str | None = "_fivetran_deleted",
    cap_at_order_date: bool = False,
    per_touch: bool = False,
) -> DataFrame:
    """Surviving touches per order with their touch count.

    Filters: not soft-deleted, of ``model_type``, clicked no earlier than
    ``order_date - lookback_days`` (no upper bound unless
    ``cap_at_order_date``). The reference writes a LEFT JOIN to orders followed
    by a predicate on the order date, which is an inner join; it is written as
    one here. Output: ``order_id, channel, campaign_id, touches, order_index``,
    where ``touches`` counts those of the channel and campaign and
    ``order_index`` those of the order. ``per_touch`` gives one row per touch
    and click day instead, ``order_id, click_date, channel, campaign_id,
    order_index``; a hot order's touches are then generated in one task.
    """
    t = touches
    if deleted_col is not None:
        t = t.filter(F.col(f"`{deleted_col}`") == F.lit(False))
    if model_type is not None:
        t = t.filter(F.col(type_col) == F.lit(model_type))
    channel, campaign = normalise_channel(source_col, campaign_col, channel_rules)
    t = (t.groupBy(F.col(order_col), to_date(click_col).alias("click_date"), channel.alias("channel"),
                   campaign.alias("campaign_id"))
         .agg(F.count(F.lit(1)).alias("touches")))
    joined = t.join(orders.select(order_col, to_date(order_date_col).alias("__ordered")), order_col, "inner")
    cond = lookback(F.col("click_date"), F.col("__ordered"), lookback_days)
    if cap_at_order_date:
        cond = cond & (F.col("click_date") <= F.col("__ordered"))
    keys = [order_col, "channel", "campaign_id"] + (["click_date"] if per_touch else [])
    kept = joined.filter(cond).groupBy(*keys).agg(F.sum("touches").alias("touches"))
    kept = kept.withColumn("order_index", F.sum("touches").over(Window.partitionBy(order_col)))
    if not per_touch:
        return kept
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("touches")))
    return kept.withColumn("__copy", copies).select(order_col, "click_date", "channel", "campaign_id", "order_index")


def lookback(click_day: Column, order_day: Column, days: int = K.LOOKBACK_DAYS) -> Column:
    """Clicked no earlier than ``days`` before the order (F9); NULL days fail."""
    return click_day >= F.date_sub(order_day, days)


def attribute_measures(
    sales: DataFrame,
    attributed: DataFrame,
    measures: Mapping[str, Column],
    date_col: str = "date",
    order_col: str = "order_id",
    other: str = K.OTHER,
    not_set: str = K.NOT_SET,
    keys=("date", "channel", "campaign_id"),
    exact_scale: int | None = None,
) -> DataFrame:
    """Spread order measures over touches and sum by date, channel, campaign.

    ``measures`` maps output names to per-order expressions over ``sales``.
    Orders without surviving touches count once under ``other`` /
    ``not_set``. Weights of one order sum to 1, so totals are preserved.
    ``keys`` chooses the output grain (any of ``date, channel, campaign_id``).
    ``exact_scale``, the number of decimals the measures have, sums exactly: as
    decimals per key and touch count, divided once, then added with 12 decimals,
    so that the result depends on neither partitioning nor order. Without it the
    weighted values are added as doubles.
    """
    s = sales.select(F.col(order_col), to_date(date_col).alias("date"),
                     *[expr.alias(f"__v_{name}") for name, expr in measures.items()])
    touches = attributed.select(order_col, "channel", "campaign_id", "touches", "order_index")
    j = s.join(touches, order_col, "left")
    j = j.withColumns({"channel": F.coalesce(F.col("channel"), F.lit(other)),
                       "campaign_id": F.coalesce(F.col("campaign_id"), F.lit(not_set)),
                       "__n": F.coalesce(F.col("order_index"), F.lit(1)),
                       "__k": F.coalesce(F.col("touches"), F.lit(1))})
    if exact_scale is None:
        return j.groupBy(*keys).agg(*[
            F.sum(F.col(f"__v_{name}").cast("double") / F.col("__n") * F.col("__k")).alias(name) for name in measures])
    per_count = j.groupBy(*keys, "__n").agg(*[
        F.sum(F.col(f"__v_{name}").cast(f"decimal(20,{exact_scale})") * F.col("__k").cast("decimal(10,0)")).alias(name)
        for name in measures])
    return per_count.groupBy(*keys).agg(*[
        F.sum((F.col(name).cast("double") / F.col("__n")).cast("decimal(38,12)")).cast("double").alias(name)
        for name in measures])


def map_utm(touches: DataFrame, mapping: DataFrame, google_value: str = "google",
            bing_value: str = "bing", youtube_pattern: str = "demandgen") -> DataFrame:
    """Attach Google and Bing campaign names to touch rows.

    The mapping sheet (``channel, campaign_name, utm_campaign``) is split in a
    Google part, whose channel becomes 'YOUTUBE' when the utm matches
    ``youtube_pattern`` else 'GOOGLE', and a Bing part with channel 'BING'.
    Both are left-joined on ``(channel, utm_campaign)``. A utm mapped to two
    names repeats the touch row, as in the reference.
    """
    google = (mapping.filter((F.col("channel") == F.lit(google_value)) & F.col("utm_campaign").isNotNull())
              .select(F.when(F.col("utm_campaign").rlike("(?i)" + youtube_pattern), F.lit("YOUTUBE"))
                      .otherwise(F.lit("GOOGLE")).alias("channel"),
                      F.col("campaign_name").cast("string").alias("google_campaign"),
                      F.col("utm_campaign").cast("string").alias("utm_campaign")))
    bing = (mapping.filter((F.col("channel") == F.lit(bing_value)) & F.col("utm_campaign").isNotNull())
            .select(F.lit("BING").alias("channel"),
                    F.col("campaign_name").cast("string").alias("bing_campaign"),
                    F.col("utm_campaign").cast("string").alias("utm_campaign")))
    return (touches.join(google, ["channel", "utm_campaign"], "left")
            .join(bing, ["channel", "utm_campaign"], "left"))


def join_spend_to_touch(spend: DataFrame, touch: DataFrame, spend_key: str, touch_key: str,
                        carry: Sequence[str], on_multi: str = "all") -> DataFrame:
    """Left join paid rows to the distinct touch campaigns to borrow utm fields.

    The touch side is reduced to distinct ``(touch_key, *carry)`` first.
    ``on_multi='all'`` keeps every match (a name mapped to two utms repeats the
    spend, as the reference does); ``'first'`` keeps the smallest per key.
    """
    right = touch.select(touch_key, *carry).distinct()
    if on_multi == "first":
        right = right.groupBy(touch_key).agg(*[F.min(c).alias(c) for c in carry])
    cond = F.col(f"__s.{spend_key}") == F.col(f"__t.{touch_key}")
    return (spend.alias("__s").join(right.alias("__t"), cond, "left")
            .select("__s.*", *[F.col(f"__t.{c}").alias(c) for c in carry]))


def touch_orders(touches: DataFrame, date_col: str, keys: Sequence, grains=GRAINS,
                 ft_col: str = "fta_subs", lt_col: str = "lta_subs") -> DataFrame:
    """First- and last-touch counts by dimensions and grain, zero-filled."""
    from blendwise.functions.aggs import sum_
    from blendwise.operators.calendar import granularity_rollup
    return granularity_rollup(touches, date_col, keys,
                              {"ft_orders": sum_(ft_col, fill=0), "lt_orders": sum_(lt_col, fill=0)},
                              grains=grains)


def skan_offset(mmp: DataFrame, skan: DataFrame, keys: Sequence[str], installs_col: str,
                self_attributing: Sequence[str], source_col: str = "source",
                offset_channel: str = K.SKAN_OFFSET_CHANNEL, offset_keys: Mapping[str, object] | None = None,
                channel_col: str = "channel") -> DataFrame:
    """SKAN install correction.

    Self-attributing sources get 0 installs in the MMP feed, SKAN installs are
    added per channel, and the SKAN total is subtracted once under
    ``offset_channel`` so the grand total is unchanged. Returns the three
    stacked blocks with an ``installs`` measure; callers aggregate.
    """
    mmp_part = mmp.select(*keys, F.when(F.col(source_col).isin(list(self_attributing)), F.lit(0))
                          .otherwise(F.col(installs_col)).alias("installs"))
    skan_part = skan.select(*keys, F.col(installs_col).alias("installs"))
    offset_keys = {channel_col: offset_channel, **dict(offset_keys or {})}
    offset_cols = []
    for k in keys:
        if k in offset_keys:
            offset_cols.append(F.lit(offset_keys[k]).alias(k))
        else:
            offset_cols.append(F.col(k))
    offset_part = skan.select(*offset_cols, (-F.col(installs_col)).alias("installs"))
    return mmp_part.unionByName(skan_part).unionByName(offset_part)


def trial_revenue(a, b) -> Column:
    """``COALESCE(SUM(a),0) + COALESCE(SUM(b),0)``."""
    return zero(F.sum(as_col(a))) + zero(F.sum(as_col(b)))


__all__ = [
    "linear_attribution", "attribute_measures", "map_utm", "join_spend_to_touch",
    "lookback", "touch_orders", "skan_offset", "trial_revenue",
]
