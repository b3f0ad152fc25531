"""Labelling operators.

Rules are configuration: lists of (pattern or condition, label) evaluated in
order, first match wins, exactly like a searched CASE. They compile to one
``CASE WHEN`` column that Spark evaluates inside whole-stage codegen, once per
row; call them before any grain fan-out so they are not evaluated per grain.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blendwise import constants as K
from blendwise.functions.columns import as_col
from blendwise.functions.text import imatch, replace_all, split_part


def _condition(c, rule) -> Column:
    if isinstance(rule, Column):
        return rule
    return imatch(c, rule)


def classify(c, rules: Sequence[tuple], default=None) -> Column:
    """Ordered case-insensitive keyword rules; first match wins.

    ``rules`` holds ``(pattern, label)`` pairs. A pattern is a regex matched
    with ``~*`` semantics, or a ready boolean Column (for AND/OR of several
    tests, C4). A label may be a literal or a Column. ``default=None`` leaves
    unmatched rows NULL (C2).
    """
    out = None
    for rule, label in rules:
        cond = _condition(c, rule)
        val = label if isinstance(label, Column) else F.lit(label)
        out = F.when(cond, val) if out is None else out.when(cond, val)
    if out is None:
        return F.lit(default)
    if default is not None:
        out = out.otherwise(default if isinstance(default, Column) else F.lit(default))
    return out


def bucket_exact(c, buckets: Mapping[str, Sequence[str]], default=None) -> Column:
    """Exact-name buckets: ``CASE WHEN c IN (...) THEN label ... END``.

    For very large maps, join to a mapping table instead (Spark broadcasts it
    when its size is below the broadcast threshold).
    """
    col = as_col(c)
    out = None
    for label, names in buckets.items():
        names = list(names)
        cond = col.isin(names) if len(names) != 1 else (col == F.lit(names[0]))
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    if out is None:
        return F.lit(default)
    return out.otherwise(F.lit(default)) if default is not None else out


def normalise_channel(source, campaign_id, channel_rules: Sequence[tuple],
                      other: str = K.OTHER, not_set: str = K.NOT_SET) -> tuple[Column, Column]:
    """Attribution source to (channel, campaign_id).

    ``channel_rules`` holds ``(source_value, channel_label, needs_id)``. A rule
    with ``needs_id`` applies only when the campaign id is non-blank
    (``campaign_id != ''``, so NULL ids fail it too). The campaign id is kept
    for every listed source whose id is non-blank, else ``not_set``.
    """
    src, cid = as_col(source), as_col(campaign_id)
    has_id = cid != F.lit("")
    channel = None
    for value, label, needs_id in channel_rules:
        cond = (src == F.lit(value)) & has_id if needs_id else (src == F.lit(value))
        channel = F.when(cond, F.lit(label)) if channel is None else channel.when(cond, F.lit(label))
    channel = F.lit(other) if channel is None else channel.otherwise(F.lit(other))
    sources = [v for v, _, _ in channel_rules]
    campaign = F.when(src.isin(sources) & has_id, cid).otherwise(F.lit(not_set))
    return channel, campaign


def repair_names(c, replacements: Sequence[tuple[str, str]] = (), cut_at: str | None = None,
                 renames: Mapping[str, str] | None = None) -> Column:
    """Literal name fixes (R32): fixed renames, nested REPLACE, cut at a marker."""
    col = as_col(c)
    out = replace_all(col, replacements)
    if cut_at is not None:
        out = split_part(out, cut_at, 1)
    if renames:
        fixed = None
        for old, new in renames.items():
            cond = col == F.lit(old)
            fixed = F.when(cond, F.lit(new)) if fixed is None else fixed.when(cond, F.lit(new))
        out = fixed.otherwise(out)
    return out


def label_unpaid(df: DataFrame, name_col: str = "campaign_name", channel_col: str = "channel",
                 label: str = K.NOT_PAID) -> DataFrame:
    """``channel := label`` when the campaign name is NULL after a blend.

    Also hits paid rows whose name is NULL (reference behaviour).
    """
    return df.withColumn(channel_col, F.when(F.col(name_col).isNull(), F.lit(label))
                         .otherwise(F.col(channel_col)))


def acquisition_spend(type_col, spend, patterns: Sequence[str] = K.ACQUISITION_TYPE_PATTERNS) -> Column:
    """Spend when the campaign type matches any pattern, else 0."""
    cond = None
    for p in patterns:
        term = imatch(type_col, p)
        cond = term if cond is None else (cond | term)
    return F.when(cond, as_col(spend)).otherwise(F.lit(0))
