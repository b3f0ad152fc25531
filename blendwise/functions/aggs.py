"""Measure specifications for roll-ups that may aggregate in two steps.

A roll-up to five grains can aggregate the raw rows once to day grain and then
merge those partial results into the coarser grains. That is only valid for
decomposable aggregates, so each measure states how it merges:

===============  ======================  ===================
kind             first step              merge step
===============  ======================  ===================
sum              SUM(x)                  SUM(partial)
count            COUNT(x) / COUNT(*)     SUM(partial)
min / max        MIN(x) / MAX(x)         MIN / MAX(partial)
count_distinct   COUNT(DISTINCT x)       not decomposable
===============  ======================  ===================

``fill`` applies ``COALESCE(agg, fill)`` on the final value (A10).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from blendwise.functions.columns import as_col


@dataclass(frozen=True)
class Agg:
    kind: str
    expr: object = None  # column name, Column, or None for COUNT(*)
    fill: object = None  # value for COALESCE on the final aggregate

    @property
    def decomposable(self) -> bool:
        return self.kind in ("sum", "exact_sum", "count", "min", "max")

    def _input(self) -> Column:
        return F.lit(1) if self.expr is None else as_col(self.expr)

    def _fill(self, c: Column) -> Column:
        return c if self.fill is None else F.coalesce(c, F.lit(self.fill))

    @staticmethod
    def _exact(c: Column) -> Column:
        return F.sum(c.cast("decimal(38,12)"))

    def one_step(self) -> Column:
        """The aggregate computed directly on raw rows."""
        if self.kind == "sum":
            agg = F.sum(self._input())
        elif self.kind == "exact_sum":
            agg = self._exact(self._input()).cast("double")
        elif self.kind == "count":
            agg = F.count(F.lit(1)) if self.expr is None else F.count(as_col(self.expr))
        elif self.kind == "count_distinct":
            agg = F.count_distinct(self._input())
        elif self.kind == "min":
            agg = F.min(self._input())
        elif self.kind == "max":
            agg = F.max(self._input())
        else:
            raise ValueError(f"unknown aggregate kind {self.kind!r}")
        return self._fill(agg)

    def partial(self) -> Column:
        """First step of a two-step aggregation (no fill yet)."""
        if not self.decomposable:
            raise ValueError(f"{self.kind} cannot be aggregated in two steps")
        if self.kind == "exact_sum":
            return self._exact(self._input())
        return Agg(self.kind, self.expr).one_step()

    def merge_partial(self, partial_col: str) -> Column:
        """Partial results merged into a partial result of a coarser key."""
        c = F.col(partial_col)
        if self.kind == "exact_sum":
            return self._exact(c)
        return {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}[self.kind](c)

    def merge(self, partial_col: str) -> Column:
        """Second step over the partial results."""
        merged = self.merge_partial(partial_col)
        return self._fill(merged.cast("double") if self.kind == "exact_sum" else merged)

    def finish(self, partial_col: str) -> Column:
        """A partial result used as the final value (same grain)."""
        c = F.col(partial_col)
        return self._fill(c.cast("double") if self.kind == "exact_sum" else c)


def sum_(expr, fill=None) -> Agg:
    return Agg("sum", expr, fill)


def exact_sum_(expr, fill=None) -> Agg:
    """A sum of doubles whose result does not depend on the order of adding."""
    return Agg("exact_sum", expr, fill)


def count_(expr=None, fill=None) -> Agg:
    return Agg("count", expr, fill)


def count_distinct(expr) -> Agg:
    return Agg("count_distinct", expr)


def min_(expr) -> Agg:
    return Agg("min", expr)


def max_(expr) -> Agg:
    return Agg("max", expr)
