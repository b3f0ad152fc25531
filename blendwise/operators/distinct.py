"""Exact distinct counts at every grain from one pass.

``COUNT(DISTINCT id)`` per day cannot be added up to weeks or months, as an id may come on several days. The facts are
reduced once to a row per (id, day, keys), the rows of an id are brought together, fanned out to their periods and reduced to a
row per (id, period, keys) where they lie; what is left is to count rows. Work and shuffles grow with the facts, whether an id's
days are near each other or not, and no task holds more than the ids dealt to it.

``dense_ids`` numbers ids in the order of their own date.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blendwise.functions.aggs import Agg
from blendwise.functions.columns import as_col
from blendwise.functions.dates import GRAINS, period_start, to_date
from blendwise.operators.calendar import key_names_of

PER_PART = 1 << 20  # ids that are numbered together


def dense_ids(ids: DataFrame, id_col: str, order_col: str, name: str = "dense_id", per_part: int = PER_PART) -> DataFrame:
    """``(id, name)``: distinct non-null ids numbered 1, 2, ... in the order of their smallest ``order_col``.

    A date's ids are cut by hash into parts of about ``per_part``; a part is numbered by itself and starts where the
    parts before it end. Only part sizes, one row per date and ``per_part`` ids, meet in one place. Null dates come first.
    """
    each = ids.where(as_col(id_col).isNotNull()).groupBy(as_col(id_col).alias(id_col)).agg(F.min(to_date(order_col)).alias("__day"))
    sizes = each.groupBy("__day").agg(F.count(F.lit(1)).alias("__n"))
    split = sizes.select(F.coalesce(F.datediff("__day", F.lit("1970-01-01").cast("date")), F.lit(-2147483648)).alias("__of"),
                         F.ceil(F.col("__n") / per_part).cast("int").alias("__parts"))
    each = each.withColumn("__at", F.coalesce(F.datediff("__day", F.lit("1970-01-01").cast("date")), F.lit(-2147483648)))
    dealt = each.join(split, F.col("__at") == F.col("__of")).withColumn("__part", F.pmod(F.xxhash64(id_col), F.col("__parts")))
    part_sizes = dealt.groupBy("__at", "__part").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__at", "__part").rowsBetween(Window.unboundedPreceding, -1)  # a row per date and per_part ids
    offsets = part_sizes.select(F.col("__at").alias("__oa"), F.col("__part").alias("__op"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    place = F.row_number().over(Window.partitionBy("__at", "__part").orderBy(id_col))
    numbered = dealt.withColumn("__place", place).join(offsets, (F.col("__at") == F.col("__oa")) & (F.col("__part") == F.col("__op")))
    return numbered.select(id_col, (F.col("__before") + F.col("__place")).alias(name))


def distinct_rollup(df: DataFrame, date_col, keys: Sequence, dense_col: str, distinct: Mapping[str, Column | None],
                    aggs: Mapping[str, Agg] | None = None, grains: Sequence[str] = GRAINS, week_start: str = "monday",
                    date_name: str = "date", grain_name: str = "date_granularity") -> DataFrame:
    """Distinct counts and decomposable measures of ``df`` at every grain, stacked.

    ``dense_col`` holds numbers from ``dense_ids`` (null: no id). ``distinct`` maps an output name to the condition under which a row's
    id counts, or None for every row. ``aggs`` are measures over all rows, rows without an id included. Output
    columns: ``date_name, grain_name, *keys, *distinct, *aggs``.
    """
    aggs = dict(aggs or {})
    bad = [n for n, a in aggs.items() if not a.decomposable]
    if bad:
        raise ValueError(f"{bad} are not decomposable; give distinct counts in ``distinct``")
    key_names = key_names_of(df, keys)
    flags = {f"__b{i}": F.lit(True) if cond is None else F.coalesce(cond, F.lit(False)) for i, cond in enumerate(distinct.values())}
    inputs = {f"__m{i}": a for i, a in enumerate(aggs.values())}
    projected = df.select(to_date(date_col).alias("__day"), *[as_col(k) for k in keys], as_col(dense_col).cast("long").alias("__id"),
                          *[c.alias(n) for n, c in flags.items()],
                          *[(F.lit(1) if a.expr is None else as_col(a.expr)).alias(n) for n, a in inputs.items()])
    rebound = {n: Agg(a.kind, None if a.expr is None else F.col(n), a.fill) for n, a in inputs.items()}
    daily = projected.groupBy("__id", "__day", *key_names).agg(
        *[F.max(n).alias(n) for n in flags], *[a.partial().alias(n) for n, a in rebound.items()])
    fan = F.inline(F.array(*[F.struct(F.lit(g).alias(grain_name), period_start("__day", g, week_start).alias(date_name)) for g in grains]))
    # an id has a row per day and key at most, so none is hot; its periods are merged without another shuffle
    each = daily.repartition("__id").select("*", fan).groupBy("__id", date_name, grain_name, *key_names).agg(
        *[F.max(n).alias(n) for n in flags], *[a.merge_partial(n).alias(n) for n, a in rebound.items()])
    return each.groupBy(date_name, grain_name, *key_names).agg(
        *[F.count_if(F.col(n) & F.col("__id").isNotNull()).alias(name) for n, name in zip(flags, distinct)],
        *[a.merge(n).alias(name) for (n, a), name in zip(rebound.items(), aggs)])
