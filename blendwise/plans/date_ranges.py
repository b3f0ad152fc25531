"""``date_range`` for every report: the rows of a range of days, reading only what these need.

Bounds on each input come before any roll-up or join, because no filter on a result passes a
full outer join or the roll-up's generator. The range is widened to the whole periods of the coarsest grain, so that period sums and the
totals over a month's rows are those of the full report; the result is cut to the range at the end.

Look-ups that a report takes from its own inputs (campaign names of paid rows, utm names of touches) are
those of the widened range.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import wraps
from inspect import signature

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blendwise import constants as K
from blendwise.functions.dates import GRAINS, date_lit
from blendwise.operators.calendar import in_range, touches_range

# The column that dates a row, by order of preference; clicks reach back by the look-back.
DATE_COLUMNS = ("date", "dg", "order_date", "day", "created_on", "activation_date", "stat_time_day")
CLICK_COLUMN = "click_date"


def not_before(date, date_range, lookback_days: int = K.LOOKBACK_DAYS, grains=GRAINS, week_start: str = "monday"):
    """Clicks that an order of the widened range can count: no upper bound, as late clicks count too."""
    from blendwise.functions.dates import period_start
    first = date_lit(date_range[0])
    low = F.least(*[period_start(first, g, week_start) for g in grains]) if len(grains) > 1 else period_start(first, grains[0], week_start)
    return F.col(date) >= F.date_sub(low, lookback_days)


def bounded(inputs, date_range, grains=GRAINS, week_start: str = "monday"):
    """``inputs`` (frames, and mappings or lists of them) with every dated frame cut to the widened range.

    Frames without a known date column (mappings, dimensions) stay whole.
    """
    if isinstance(inputs, DataFrame):
        if CLICK_COLUMN in inputs.columns:
            return inputs.filter(not_before(CLICK_COLUMN, date_range, grains=grains, week_start=week_start))
        dated = next((c for c in DATE_COLUMNS if c in inputs.columns), None)
        return inputs if dated is None else inputs.filter(touches_range(dated, date_range, grains, week_start))
    if isinstance(inputs, Mapping):
        return {k: bounded(v, date_range, grains, week_start) for k, v in inputs.items()}
    if isinstance(inputs, (list, tuple)):
        return type(inputs)(bounded(v, date_range, grains, week_start) for v in inputs)
    return inputs


def cut(report: DataFrame, date_range, grains=GRAINS, week_start: str = "monday") -> DataFrame:
    """Rows whose period touches the range; days in the range where rows have no grain."""
    if "date_granularity" in report.columns:
        return report.filter(in_range("date", "date_granularity", date_range, grains, week_start))
    first, last = (date_lit(d) for d in date_range)
    return report.filter((F.col("date") >= first) & (F.col("date") <= last))


def with_date_range(report):
    """The report function with a keyword ``date_range``, a pair of first and last day."""

    @wraps(report)
    def run(inputs, *args, date_range=None, **options):
        if date_range is None:
            return report(inputs, *args, **options)
        chosen = {p.name: p.default for p in signature(report).parameters.values()} | options
        grains, week_start = tuple(chosen.get("grains") or GRAINS), chosen.get("week_start", "monday")
        args = [bounded(a, date_range, grains, week_start) if _holds_frames(a) else a for a in args]
        return cut(report(bounded(inputs, date_range, grains, week_start), *args, **options), date_range, grains, week_start)

    run.__doc__ = (report.__doc__ or "").rstrip() + "\n\n    ``date_range`` keeps the periods that touch it: see ``plans.date_ranges``.\n    "
    return run


def _holds_frames(value) -> bool:
    if isinstance(value, DataFrame):
        return True
    if isinstance(value, Mapping):
        return any(_holds_frames(v) for v in value.values())
    return isinstance(value, (list, tuple)) and any(_holds_frames(v) for v in value)
