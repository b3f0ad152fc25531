"""Granularity roll-up and calendar spine.

``granularity_rollup`` turns daily facts into one row set per grain: the date is
replaced by the period start, a ``date_granularity`` label is added, measures
are aggregated, and the grains are stacked.

Strategies (all give the same rows):

``cascade`` (default for several grains when every measure is decomposable)
    Aggregate raw rows once to day grain (map-side combined), bring the day rows of a
    key together, fan each out to its period starts with one generator, and merge in
    one aggregate without another shuffle. One scan and two shuffles, both of rows that
    day grain has; a key is at most one row per day there, so no key is hot. A filter that a consumer puts on the period start or grain
    cannot move below the generator, so the source is still read once.
``lattice``
    As ``cascade``, but every coarser grain merges the one below it (day to week; day to
    month to quarter to year) and day rows are given out as they are. The day shuffle and the month and quarter shuffles are shared
    by the branches, also under a consumer's filter. The cheapest form when the roll-up is the result (1.2 times the
    union form, which scans the source five times); inside joins its branches make large plans, so ``cascade`` stays the default.
``cascade_union``
    As ``cascade`` but each coarser grain merges the day aggregate in its own
    branch. Spark shares the day exchange between branches, unless a later
    filter on the date is pushed into the branches differently; then every
    branch scans the source again.
``explode``
    Fan every raw row out to its grains and aggregate once. One scan, one
    shuffle; the only choice for ``COUNT(DISTINCT ...)``.
``union``
    One aggregate per grain over the source, stacked (default for a single grain). Scans the source once per
    grain, but a later ``date_granularity`` filter prunes whole branches.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blendwise.functions.aggs import Agg
from blendwise.functions.columns import as_col
from blendwise.functions.dates import GRAINS, calendar_spine, date_lit, period_start, to_date


_STEPS = {"month": 1, "quarter": 3, "year": 12}


def _next_period(start: Column, grain: str) -> Column:
    if grain in _STEPS:
        return F.add_months(start, _STEPS[grain])
    return F.date_add(start, 7 if grain == "week" else 1)


def _extreme(pick, cols: list[Column]) -> Column:
    return pick(*cols) if len(cols) > 1 else cols[0]


def touches_range(date, date_range, grains: Sequence[str] = GRAINS, week_start: str = "monday") -> Column:
    """Days that some period of ``grains`` touching ``date_range`` needs.

    The range ``(first day, last day)`` is widened to whole periods. The bounds are
    constants compared with the bare column, so that they reach the scan.
    """
    first, last = (date_lit(d) for d in date_range)
    low = _extreme(F.least, [period_start(first, g, week_start) for g in grains])
    high = _extreme(F.greatest, [_next_period(period_start(last, g, week_start), g) for g in grains])
    return (as_col(date) >= low) & (as_col(date) < high)


def in_range(date, grain, date_range, grains: Sequence[str] = GRAINS, week_start: str = "monday") -> Column:
    """Rows whose period, starting on ``date`` at ``grain``, touches ``date_range``."""
    first, last = (date_lit(d) for d in date_range)
    earliest = F.lit(None).cast("date")
    for g in grains:
        earliest = F.when(as_col(grain) == F.lit(g), period_start(first, g, week_start)).otherwise(earliest)
    return (as_col(date) >= earliest) & (as_col(date) <= last)


def _key_cols(keys) -> list[Column]:
    return [as_col(k) for k in keys]


def key_names_of(df: DataFrame, keys) -> list[str]:
    names = []
    for k in keys:
        if isinstance(k, str):
            names.append(k)
        else:  # an aliased Column: resolve its output name
            names.append(df.select(k).columns[0])
    return names


def _finer(grain: str, grains: Sequence[str]) -> str:
    """The coarsest grain of ``grains`` whose periods make up those of ``grain`` (weeks only days)."""
    chain = ["day", "month", "quarter", "year"]
    below = chain[:chain.index(grain)] if grain in chain else ["day"]
    return next((g for g in reversed(below) if g in grains), "day")


def stack_levels(daily: DataFrame, grains: Sequence[str], week_start: str, key_names: Sequence[str], merged: Sequence[Column],
                 finished: Sequence[Column], date_name: str = "date", grain_name: str = "date_granularity") -> DataFrame:
    """Day rows ``(__day, *keys, partials)`` merged up the lattice of grains and stacked.

    Weeks merge days, months days, quarters months, years quarters; day rows are given out as they
    are. Each level is aggregated once and its shuffle shared by its own branch and the levels above. The period start goes through a
    generator of one row: a consumer's filter on the date stays above it, as it would otherwise reach each branch's
    source in a form of its own and no shuffle could be shared.
    """
    levels = {"day": daily}
    for g in sorted(grains, key=["day", "week", "month", "quarter", "year"].index):
        if g != "day":
            start = period_start("__day", g, week_start).alias("__day")
            levels[g] = levels[_finer(g, grains)].groupBy(start, *key_names).agg(*merged)
    parts = [levels[g].select(F.inline(F.array(F.struct(F.col("__day").alias(date_name)))), F.lit(g).alias(grain_name), *key_names, *finished)
             for g in grains]
    return reduce(DataFrame.unionByName, parts)


def granularity_rollup(
    df: DataFrame,
    date_col,
    keys: Sequence = (),
    aggs: Mapping[str, Agg] | None = None,
    grains: Sequence[str] = GRAINS,
    week_start: str = "monday",
    strategy: str = "auto",
    date_name: str = "date",
    grain_name: str = "date_granularity",
    date_range=None,
) -> DataFrame:
    """Aggregate ``df`` at every grain in ``grains`` and stack the results.

    ``date_range``, a pair of first and last day, keeps the periods that touch it
    and reads only the days of those (``date_col`` must then be a date or timestamp).

    Output columns: ``date_name, grain_name, *keys, *aggs`` (dates are DateType).
    ``keys`` may be names or aliased Columns (computed once, before the fan-out).
    """
    aggs = dict(aggs or {})
    grains = list(grains)
    if not grains:
        raise ValueError("at least one granularity is required")
    decomposable = all(a.decomposable for a in aggs.values())
    if strategy == "auto":
        # the rows of one grain are one aggregate: nothing to fan out, one shuffle
        strategy = "explode" if not decomposable else "union" if len(grains) == 1 else "cascade"
    if strategy == "cascade" and not decomposable:
        raise ValueError("cascade needs decomposable aggregates (no COUNT DISTINCT)")

    if date_range is not None:
        rolled = granularity_rollup(df.filter(touches_range(date_col, date_range, grains, week_start)), date_col, keys,
                                    aggs, grains, week_start, strategy, date_name, grain_name)
        return rolled.filter(in_range(date_name, grain_name, date_range, grains, week_start))

    # Evaluate keys and measure inputs once, before any fan-out.
    key_exprs = _key_cols(keys)
    key_names = key_names_of(df, keys)
    day = to_date(date_col).alias("__day")
    measure_inputs = {f"__m{i}": a for i, a in enumerate(aggs.values())}
    projected = df.select(
        day, *key_exprs,
        *[(F.lit(1) if a.expr is None else as_col(a.expr)).alias(n)
          for n, a in measure_inputs.items()])
    rebound = {name: Agg(a.kind, None if a.expr is None else F.col(n), a.fill)
               for (name, a), n in zip(aggs.items(), measure_inputs)}
    out_cols = [date_name, grain_name, *key_names, *aggs]

    if strategy == "union":
        parts = []
        for g in grains:
            parts.append(
                projected.groupBy(period_start("__day", g, week_start).alias(date_name),
                                  *key_names)
                .agg(*[a.one_step().alias(n) for n, a in rebound.items()])
                .withColumn(grain_name, F.lit(g))
                .select(*out_cols))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    fan = F.inline(F.array(*[
        F.struct(F.lit(g).alias(grain_name),
                 period_start("__day", g, week_start).alias(date_name))
        for g in grains]))

    if strategy == "explode":
        return (projected.select("*", fan)
                .groupBy(date_name, grain_name, *key_names)
                .agg(*[a.one_step().alias(n) for n, a in rebound.items()])
                .select(*out_cols))

    if strategy == "lattice":
        partial_names = {n: f"__p_{i}" for i, n in enumerate(rebound)}
        daily = (projected.groupBy("__day", *key_names)
                 .agg(*[a.partial().alias(partial_names[n]) for n, a in rebound.items()]))
        return stack_levels(daily, grains, week_start, key_names,
                            [a.merge_partial(partial_names[n]).alias(partial_names[n]) for n, a in rebound.items()],
                            [a.finish(partial_names[n]).alias(n) for n, a in rebound.items()], date_name, grain_name)

    if strategy in ("cascade", "cascade_union"):
        partial_names = {n: f"__p_{i}" for i, n in enumerate(rebound)}
        daily = (projected.groupBy("__day", *key_names)
                 .agg(*[a.partial().alias(partial_names[n]) for n, a in rebound.items()]))
        if strategy == "cascade":
            # A key's days meet in one partition, at most one row a day, so the fan-out is merged where it is
            # made; hashed by day too, five rows for each day row would be shuffled and none merged before.
            by_key = daily.repartition(*[F.col(f"`{k}`") for k in key_names]) if key_names else daily
            return (by_key.select("*", fan)
                    .groupBy(date_name, grain_name, *key_names)
                    .agg(*[a.merge(partial_names[n]).alias(n) for n, a in rebound.items()])
                    .select(*out_cols))
        parts = []
        for g in grains:
            if g == "day":
                part = daily.select(F.col("__day").alias(date_name), *key_names,
                                    *[a.finish(partial_names[n]).alias(n)
                                      for n, a in rebound.items()])
            else:
                part = (daily.groupBy(period_start("__day", g, week_start).alias(date_name),
                                      *key_names)
                        .agg(*[a.merge(partial_names[n]).alias(n) for n, a in rebound.items()]))
            parts.append(part.withColumn(grain_name, F.lit(g)).select(*out_cols))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    raise ValueError(f"unknown strategy {strategy!r}")


def spine_join(spine: DataFrame, facts: DataFrame, keys=("date",), how: str = "left") -> DataFrame:
    """Keep every spine row and attach optional facts.

    The spine is the preserved side, so it cannot be the broadcast side of a
    left join; the facts side is broadcast by Spark only when its size is
    below the broadcast threshold.
    """
    return spine.join(facts, list(keys), how)


def spine(spark: SparkSession, start, as_of=None, name: str = "date") -> DataFrame:
    """Calendar from ``start`` to ``as_of`` inclusive (default today)."""
    return calendar_spine(spark, start, as_of, name)


def spine_between(bounds: DataFrame, first: str = "first", last: str = "last", name: str = "date") -> DataFrame:
    """Calendar over the days that the one row of ``bounds``, an aggregate over the facts, names; empty if it holds nulls."""
    known = bounds.where(F.col(first).isNotNull() & F.col(last).isNotNull())
    return known.select(F.explode(F.sequence(to_date(first), to_date(last))).alias(name))


def cap_at(df: DataFrame, as_of=None, date_col: str = "date", start=None) -> DataFrame:
    """``date <= as_of`` and optionally ``date >= start``."""
    end = F.current_date() if as_of is None else date_lit(as_of)
    cond = F.col(date_col) <= end
    if start is not None:
        cond = cond & (F.col(date_col) >= date_lit(start))
    return df.filter(cond)


def cutover(old: DataFrame, new: DataFrame, switch_date, date_col: str = "date",
            on: str = "period_start", day_col: str | None = None) -> DataFrame:
    """Old source up to and including ``switch_date``, new source after.

    ``on='period_start'`` compares the period start in ``date_col`` (the
    reference behaviour: a quarter or year that contains the switch date comes
    wholly from the old source). ``on='day'`` compares ``day_col`` instead.
    Both inputs must share column names; the result is their stacked union.
    """
    col = date_col if on == "period_start" else (day_col or date_col)
    d = date_lit(switch_date)
    return old.filter(F.col(col) <= d).unionByName(new.filter(F.col(col) > d))
