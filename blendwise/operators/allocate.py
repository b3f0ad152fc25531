"""Spend splits and fee allocation.

``allocate_fee`` needs a total per (channel, market, breakdown, month). That
total is computed as an aggregate and joined back instead of a window, because
a window puts every row of a partition into one task: with one hot partition
(a third of all rows) that task would hold a third of the table. The
aggregate is combined map-side and is tiny (one row per partition key), so
Spark's broadcast threshold or AQE broadcasts it and the big side is never
shuffled for the join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blendwise import constants as K
from blendwise.functions.columns import as_col, safe_div
from blendwise.functions.dates import (
    date_lit, days_in_month, days_in_quarter, days_in_year, to_date,
)
from blendwise.functions.text import imatch


def split_spend(name, spend, pattern: str, match_share: float = 0.0,
                null_name: str = "zero") -> tuple[Column, Column]:
    """Acquisition / retention split of spend by a name keyword.

    Names not matching ``pattern`` are all acquisition. Matching names give
    ``match_share`` of spend to acquisition and the rest to retention.
    A NULL name gives retention 0 and acquisition 0 (``null_name='zero'``) or
    NULL (``'null'``): the two forms the reference uses.
    """
    m = imatch(name, pattern)
    s = as_col(spend)
    if null_name == "zero":
        acq = F.when(~m, s).when(m, s * F.lit(float(match_share))).otherwise(F.lit(0))
    else:
        acq = F.when(~m, s).otherwise(F.when(m, s) * F.lit(float(match_share)))
    # round: 1 - 0.34 is 0.6599999999999999 in binary; the literal 0.66 is meant
    ret = F.when(m, s * F.lit(round(1.0 - float(match_share), 12))).otherwise(F.lit(0))
    return acq, ret


def days_in_period(df: DataFrame, date_col: str = "date") -> DataFrame:
    """Add ``month_start, days_in_month, days_in_quarter, days_in_year``."""
    d = to_date(date_col)
    return df.withColumns({
        "month_start": F.trunc(d, "month"),
        "days_in_month": days_in_month(d),
        "days_in_quarter": days_in_quarter(d),
        "days_in_year": days_in_year(d),
    })


def share_of_total(df: DataFrame, value_col: str, partition: Sequence, total_name: str = "total",
                   share_name: str | None = "share", shared=None) -> DataFrame:
    """``SUM(value) OVER (PARTITION BY ...)`` and ``value / NULLIF(total, 0)``.

    ``partition`` holds column names or Columns (e.g. a month start). Computed
    as a map-side-combined aggregate joined back on the partition keys. NULL
    partition values form their own group, as in a window. With ``shared`` (a ``session.Shared`` that the caller releases) the
    totals are written first, so that their size is known when the join is planned: small ones are broadcast and ``df`` is not shuffled.
    """
    parts = [as_col(p) for p in partition]
    names = [f"__k{i}" for i in range(len(parts))]
    keyed = df.withColumns(dict(zip(names, parts)))
    totals = keyed.groupBy(*names).agg(F.sum(value_col).alias(total_name))
    if shared is not None:
        totals = shared.written(totals)
    cond = None
    for n in names:
        term = F.col(f"__l.{n}").eqNullSafe(F.col(f"__r.{n}"))
        cond = term if cond is None else cond & term
    out = (keyed.alias("__l").join(totals.alias("__r"), cond, "left")
           .select("__l.*", F.col(f"__r.{total_name}")).drop(*names))
    if share_name:
        out = out.withColumn(share_name, safe_div(value_col, total_name))
    return out


def allocate_fee(
    df: DataFrame,
    mask: Column,
    image_mask: Column,
    share_keys: Sequence = ("channel", "market", "dg_breakdown"),
    pool_before: float = K.FEE_POOL_BEFORE,
    pool_after: float = K.FEE_POOL_AFTER,
    pool_switch=K.FEE_POOL_SWITCH,
    uplift: float = K.FEE_UPLIFT,
    share_within_grain: bool = False,
    date_col: str = "date",
    grain_col: str = "date_granularity",
    spend_col: str = "spend",
    shared=None,
) -> DataFrame:
    """Monthly fee pool allocated by share of spend.

    Adds ``month_start, days_in_month, days_in_quarter, days_in_year,
    monthly_fee_pool, dg_breakdown, total_spend, spend_with_fees``.
    Rows in ``mask`` get ``spend * uplift + share * pool_for_grain``; rows in
    ``image_mask`` get the uplift only; others 0. The share total is per
    ``share_keys`` and month start, across grains unless ``share_within_grain``. ``shared``: see ``share_of_total``.
    """
    d = F.col(date_col)
    base = days_in_period(df, date_col).withColumns({
        "monthly_fee_pool": F.when(d < date_lit(pool_switch), F.lit(float(pool_before)))
        .otherwise(F.lit(float(pool_after))),
        "dg_breakdown": F.when(mask, F.lit(K.FEE_BREAKDOWN_LABELS[0]))
        .otherwise(F.lit(K.FEE_BREAKDOWN_LABELS[1])),
    })
    partition = [*share_keys, F.trunc(to_date(date_col), "month")]
    if share_within_grain:
        partition.append(grain_col)
    with_total = share_of_total(base, spend_col, partition, "total_spend", share_name=None, shared=shared)
    pool = F.col("monthly_fee_pool")
    dim = F.col("days_in_month")
    g = F.col(grain_col)
    factor = dict(K.FEE_GRAIN_FACTORS)
    per_grain = (F.when(g == "day", pool / dim).when(g == "week", pool / dim * factor["week"])
                 .when(g == "month", pool).when(g == "quarter", pool * factor["quarter"])
                 .when(g == "year", pool * factor["year"]).otherwise(pool / dim))
    s = F.col(spend_col)
    fees = (F.when(mask, s * F.lit(uplift) + safe_div(s, F.col("total_spend")) * per_grain)
            .when(image_mask, s * F.lit(uplift)).otherwise(F.lit(0.0)))
    return with_total.withColumn("spend_with_fees", fees)


def video_masks(channel, market, campaign_type, campaign_name,
                channel_value: str = K.FEE_CHANNEL, market_value: str = K.FEE_MARKET,
                types: Sequence[str] = K.FEE_CAMPAIGN_TYPES,
                image_pattern: str = K.FEE_IMAGE_PATTERN) -> tuple[Column, Column]:
    """The two arms of the fee mask: video campaigns, and image campaigns (Q25)."""
    base = ((as_col(channel) == F.lit(channel_value)) & (as_col(market) == F.lit(market_value))
            & as_col(campaign_type).isin(list(types)))
    return base & ~imatch(campaign_name, image_pattern), base & imatch(campaign_name, image_pattern)
