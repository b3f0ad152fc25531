"""Joins that hold at scale where the plain form does not.

``split_full_outer``
    Adaptive execution does not split a skewed full outer join, as an unmatched row of either
    side must come out once. In a chain with shrinking keys the left side has many rows per
    reduced key, so one key can hold half of them. Here the keys with more than a ``1 / parts`` share of the
    left rows are found first (there are fewer than ``parts`` of them, whatever the data), their left rows are dealt over as many salts as
    their share asks for, and their right rows, one per key, are repeated once per salt. Rows of the right side without any
    match come from an anti-join. No task gets more than about a ``1 / parts`` share of the left rows through a key.
``reduce_to``
    An inner join that only filters, as a semi-join.
``gap_fill``
    The missing periods of each key and grain between its first and last one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blendwise.functions.columns import as_col

PARTS = 1024
MIN_ROWS = 100_000  # of a key, before splitting it is worth anything
_STEP = {"day": "INTERVAL 1 DAY", "week": "INTERVAL 7 DAY", "month": "INTERVAL 1 MONTH", "quarter": "INTERVAL 3 MONTH",
         "year": "INTERVAL 12 MONTH"}


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def hot_keys(df: DataFrame, keys: Sequence[str], parts: int = PARTS, min_rows: int = MIN_ROWS) -> DataFrame:
    """``(*keys, __salts)`` of the keys that hold more than ``1 / parts`` of the rows, and more than ``min_rows``: fewer than ``parts`` keys.

    ``__salts`` is the number of shares of that size the key has. Null keys are a key like any other.
    """
    counts = df.groupBy(*[_q(k) for k in keys]).agg(F.count(F.lit(1)).alias("__n"))
    share = (counts.select(F.sum("__n")).scalar() / F.lit(parts))
    return counts.where((F.col("__n") > share) & (F.col("__n") > min_rows)).select(*[_q(k) for k in keys], F.ceil(F.col("__n") / share).cast("int").alias("__salts"))


def split_full_outer(left: DataFrame, right: DataFrame, keys: Sequence[str], parts: int = PARTS,
                     min_rows: int = MIN_ROWS) -> DataFrame:
    """``left FULL OUTER JOIN right USING (keys)``, as ``blend.full_outer``, with hot keys of ``left`` split.

    ``right`` holds a key at most once, or few times (each of its rows is repeated once per salt of a hot key).
    Rows with a null in a key match nothing and come out once.
    """
    keys = list(keys)
    left_cols, right_cols = [c for c in left.columns if c not in keys], [c for c in right.columns if c not in keys]
    hot = F.broadcast(hot_keys(left, keys, parts, min_rows))  # fewer than ``parts`` rows

    def salted(df: DataFrame, salt: Column) -> DataFrame:
        found = df.alias("__d").join(hot.alias("__h"), _all_equal("__d", "__h", keys, null_safe=True), "left")
        return found.select("__d.*", salt.alias("__salt"))

    salts = F.coalesce(F.col("__h.__salts"), F.lit(1))
    spread = salted(left, F.pmod(F.xxhash64(*[F.col(f"__d.`{c}`") for c in left.columns]), salts).cast("int"))
    copies = salted(right, F.explode(F.sequence(F.lit(0), salts - 1)))
    on = _all_equal("__l", "__r", [*keys, "__salt"])
    matched = spread.alias("__l").join(copies.alias("__r"), on, "left").select(
        *[F.col(f"__l.`{c}`") for c in (*keys, *left_cols)], *[F.col(f"__r.`{c}`") for c in right_cols])
    seen = left.select(*[_q(k) for k in keys]).distinct()
    types = dict(left.dtypes)
    alone = right.alias("__r").join(seen.alias("__s"), _all_equal("__r", "__s", keys), "left_anti").select(
        *[F.col(f"__r.`{k}`") for k in keys], *[F.lit(None).cast(types[c]).alias(c) for c in left_cols], *[F.col(f"__r.`{c}`") for c in right_cols])
    return matched.unionByName(alone)


def _all_equal(one: str, two: str, keys: Sequence[str], null_safe: bool = False) -> Column:
    out = None
    for k in keys:
        a, b = F.col(f"{one}.`{k}`"), F.col(f"{two}.`{k}`")
        term = a.eqNullSafe(b) if null_safe else a == b
        out = term if out is None else out & term
    return out


def reduce_to(facts: DataFrame, allowed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``facts`` whose keys occur in ``allowed`` (J4): an inner join used as a filter.

    A semi-join needs no distinct ``allowed``, never repeats a fact, and lets Spark put a runtime Bloom
    filter of the allowed keys on the scan of the facts when these are large and the allowed few.
    """
    return facts.join(allowed.select(*[_q(k) for k in keys]), list(keys), "left_semi")


def days_of_periods(periods: DataFrame, date_col: str = "date", grain_col: str = "date_granularity", name: str = "day") -> DataFrame:
    """The days that the periods ``(date, date_granularity)`` cover, each once.

    As the ``allowed`` of ``reduce_to`` they filter daily facts below a roll-up whose periods will be reduced anyway.
    """
    start = as_col(date_col).cast("date")
    after = None
    for grain, step in _STEP.items():
        arm = start + F.expr(step)
        after = F.when(as_col(grain_col) == grain, arm) if after is None else after.when(as_col(grain_col) == grain, arm)
    last = F.date_sub(after.cast("date"), 1)
    return periods.where(last.isNotNull()).select(F.explode(F.sequence(start, last)).alias(name)).distinct()


def periods_between(bounds: DataFrame, first: str, last: str, grain_col: str = "date_granularity", name: str = "date") -> DataFrame:
    """``bounds`` with one row per period from ``first`` to ``last`` (period starts of the row's grain), named ``name``."""
    arms = None
    for grain, step in _STEP.items():
        periods = F.expr(f"sequence(`{first}`, `{last}`, {step})")
        arms = F.when(_q(grain_col) == grain, periods) if arms is None else arms.when(_q(grain_col) == grain, periods)
    return bounds.withColumn(name, F.explode(arms)).drop(first, last)


def gap_fill(df: DataFrame, keys: Sequence[str], date_col: str = "date", grain_col: str = "date_granularity") -> DataFrame:
    """``df``, one row per (keys, grain, period start), with the missing periods of each (keys, grain) added.

    Periods run from the first to the last one of that key and grain; added rows have null in the other columns. Bounds
    are one map-side-combined aggregate, the periods come from ``sequence`` per bound, so there is no cross join with a
    calendar. Null keys are a key; rows whose date or grain is null or whose grain is unknown stay as they are.
    """
    by = [*keys, grain_col]
    known = _q(grain_col).isin(list(_STEP)) & _q(date_col).isNotNull()
    bounds = df.where(known).groupBy(*[_q(k) for k in by]).agg(F.min(date_col).alias("__first"), F.max(date_col).alias("__last"))
    spine = periods_between(bounds, "__first", "__last", grain_col, date_col)
    rest = [c for c in df.columns if c not in (*by, date_col)]
    on = _all_equal("__s", "__d", [*by, date_col], null_safe=True)
    filled = spine.alias("__s").join(df.where(known).alias("__d"), on, "left").select(
        *[F.col(f"__s.`{c}`") for c in (*by, date_col)], *[F.col(f"__d.`{c}`") for c in rest])
    return filled.unionByName(df.where(~F.coalesce(known, F.lit(False)))).select(*[_q(c) for c in df.columns])
