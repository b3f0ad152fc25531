"""Bucketed tables as a source contract (J1, J5): blends on the bucket keys need no shuffle.

A fact that many reports aggregate and join on the same keys is written once, bucketed and sorted by
them. An aggregate on the keys and a join of two such aggregates then read
matching buckets side by side. The number of buckets is the number of tasks of such a join; a table's buckets should hold about 128 MB each.
A key that holds a large share of the rows makes one large bucket: use plain tables for such keys, whose shuffles AQE can split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class ContractError(ValueError):
    """A table is not bucketed as its contract says."""


def write_bucketed(df: DataFrame, table: str, keys: Sequence[str], buckets: int, path: str | None = None) -> None:
    """Write ``df`` as the catalog table ``table``, bucketed and sorted by ``keys``; one file per bucket."""
    dealt = df.repartition(buckets, *[F.col(f"`{k}`") for k in keys])
    writer = dealt.write.mode("overwrite").format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
    (writer.option("path", path) if path else writer).saveAsTable(table)


def bucketing(spark: SparkSession, table: str) -> tuple[int, list[str]]:
    """(number of buckets, bucket columns) of a catalog table; (0, []) if it has none."""
    described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    columns = described.get("Bucket Columns", "[]").strip("[]")
    return int(described.get("Num Buckets", 0)), [c.strip().strip("`") for c in columns.split(",") if c.strip()]


def bucketed_table(spark: SparkSession, table: str, keys: Sequence[str], buckets: int | None = None) -> DataFrame:
    """The catalog table, after checking that it is bucketed by ``keys`` (and into ``buckets``)."""
    found, columns = bucketing(spark, table)
    if columns != list(keys) or (buckets is not None and found != buckets):
        raise ContractError(f"{table} has {found} buckets by {columns}; expected {buckets or 'some'} by {list(keys)}")
    return spark.table(table)
