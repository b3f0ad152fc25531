"""Sources and sinks.

The reference reads warehouse tables by logical name and publishes each model
under an alias. Here a report takes ``dict[str, DataFrame]`` (any Spark source:
catalog tables, Parquet, JDBC) and returns a lazy DataFrame; ``publish`` (see
``publishing``) writes it partitioned by granularity so readers that filter one grain prune the rest.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from blendwise.sources.publishing import Published, PublishError, publish  # noqa: F401

# The driver's test tables (TPC-H-like star schema plus an events table).
DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
                 "lineitem", "events")


def read_table(spark: SparkSession, name: str, base: str | None = None, fmt: str = "parquet",
               options: dict | None = None) -> DataFrame:
    """Read one relation: a catalog table (S1, S3) or ``{base}/{name}.{fmt}``.

    ``options`` go to the reader (e.g. ``header`` for CSV, or ``url`` /
    ``dbtable`` with ``fmt='jdbc'``, in which case ``base`` is ignored).
    """
    if fmt == "jdbc":
        return spark.read.format("jdbc").options(**(options or {})).load()
    if base is None:
        return spark.table(name)
    return spark.read.format(fmt).options(**(options or {})).load(f"{base.rstrip('/')}/{name}.{fmt}")


def read_tables(spark: SparkSession, base: str, names: Iterable[str] = DRIVER_TABLES,
                fmt: str = "parquet") -> dict[str, DataFrame]:
    """Lazy readers for several relations under one folder."""
    return {n: read_table(spark, n, base, fmt) for n in names}
