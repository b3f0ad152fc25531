"""Registry of driver-table queries: one per operator recipe and per report.

Each entry is ``fn(spark, sf_dir) -> DataFrame``. It reads the whole given
tables (or data Spark derives from them) and returns a lazy DataFrame.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from blendwise.functions.dates import GRAINS
from blendwise.operators.blend import stack
from blendwise.session import Shared
from blendwise.sources import DRIVER_TABLES, read_tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


RANGE = ("1997-03-10", "1997-04-20")


def report_query(name: str):
    """Register a report builder ``fn(spark, tables, **options)`` as ``name``, and over RANGE as ``name_range``."""
    def deco(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(spark, tables(spark, sf_dir))

        def ranged(spark, sf_dir):
            from blendwise.plans.roles import tables_in_range
            return fn(spark, tables_in_range(tables(spark, sf_dir), RANGE), date_range=RANGE)

        QUERIES[f"{name}_range"] = ranged
        RANGED.append(name)
        return fn
    return deco


RANGED: list[str] = []


def grain_by_grain(spark, report: Callable[[list[str]], DataFrame]) -> DataFrame:
    """``report(grains)`` for one grain after the other, each written before the next begins.

    Rows of different grains never meet in the reports that use this. What is shuffled for one grain is gone
    when it is written, so the disk holds the shuffles of one grain instead of all five.
    """
    shared = Shared(spark)
    return stack([shared.written(report([g])) for g in GRAINS])


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return read_tables(spark, sf_dir, DRIVER_TABLES)
