"""Actual / forecast / goal stacking."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blendwise.functions.columns import as_col
from blendwise.operators.blend import align_to, stack


def stack_scenarios(scenarios: Mapping[str, DataFrame], contract, measures: Sequence[str] = (),
                    label_col: str = "data_type") -> DataFrame:
    """Stack labelled scenario frames (Actual, Forecasted, Goal, ...) into one contract."""
    parts = [align_to(df.withColumn(label_col, F.lit(label)), contract, measures)
             for label, df in scenarios.items()]
    return stack(parts)


def unpivot_regions(df: DataFrame, id_cols: Sequence[str],
                    mapping: Mapping[str, Mapping[str, object]],
                    measures: Sequence[str], region_col: str = "region",
                    dtype: str = "double") -> DataFrame:
    """Wide per-region sheet to long rows.

    ``mapping[region][measure]`` is a column name, a Column expression (e.g.
    ``col('us_white_noise') / 2``) or a number (a constant such as 0). Missing
    measures are 0. One ``inline(array(struct ...))`` generator, so the sheet
    is read once and each row becomes one row per region.
    """
    structs = []
    for region, cols in mapping.items():
        fields = [F.lit(region).alias(region_col)]
        for m in measures:
            v = cols.get(m, 0)
            c = as_col(v) if isinstance(v, (str, Column)) else F.lit(v)
            fields.append(c.cast(dtype).alias(m))
        structs.append(F.struct(*fields))
    return df.select(*id_cols, F.inline(F.array(*structs)))


def goal_rollup(df: DataFrame, date_col: str, grains: Sequence[str], sums: Mapping[str, Column],
                week_start: str = "monday") -> DataFrame:
    """Roll a sheet to every grain with arbitrary aggregate expressions.

    ``sums`` maps names to aggregate Columns such as
    ``F.sum('spend') - F.sum('acq_spend')``. Each row is fanned out to its
    period starts by one generator and aggregated once: one scan, one shuffle,
    and a later filter on the date cannot split the plan into one scan per
    grain. Output: ``date, date_granularity, *sums``.
    """
    from blendwise.functions.dates import period_start
    fan = F.inline(F.array(*[
        F.struct(F.lit(g).alias("__grain"), period_start(date_col, g, week_start).alias("__period"))
        for g in grains]))
    return (df.select("*", fan).groupBy("__period", "__grain")
            .agg(*[e.alias(n) for n, e in sums.items()])
            .select(F.col("__period").alias("date"), F.col("__grain").alias("date_granularity"),
                    *sums))
