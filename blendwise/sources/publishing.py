"""Publishing a report (S4, O1): staged, checked, then committed in files of a planned size.

1. The result is written once to a staging folder in ``spark.checkpoint.dir``, rebalanced by the
   partition column, while its rows and a checksum of them are observed.
2. The staged files are read back: rows and checksum have to agree, and the bytes of each
   partition value give its number of files. The target is still untouched.
3. The staged rows go to the target, ``ceil(bytes / file_bytes)`` files per partition value: each row
   carries the number of its file, so neither a large value (the day grain) nor a hot key becomes one task.
   With ``order_by`` the rows are range-partitioned by (partition value, order, hash of the row) instead and sorted
   within files: a date that holds half of all rows is cut by the hash, and the files' ranges follow each other. A file's range may begin in one
   partition value and end in the next, so there is at most one more file per value.
4. The target is counted per partition value; a difference is an error.

A lost executor costs the tasks it ran; a failure before step 3 leaves the target as it was.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from blendwise.session import ensure_checkpoint_dir, remove_path

FILE_BYTES = 128 * 1024 * 1024
REPLACE = ("all", "touched")


class PublishError(RuntimeError):
    """What was read back differs from what was written."""


@dataclass(frozen=True)
class Published:
    """What a publication wrote: rows and planned files per value of the partition column (None: no partitioning)."""

    rows: int
    files: dict = field(default_factory=dict)
    rows_by: dict = field(default_factory=dict)


def _digest(df: DataFrame) -> Column:
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])


def _by(partition_by: str | None) -> Column:
    return F.col(f"`{partition_by}`") if partition_by else F.lit(None).cast("string")


def _stage(df: DataFrame, folder: str, partition_by: str | None) -> tuple[DataFrame, int, int]:
    seen = Observation(f"publish-{uuid.uuid4().hex}")
    even = df.hint("rebalance", F.col(f"`{partition_by}`")) if partition_by else df.hint("rebalance")
    # an exchange below the observed node ends before it, so a repeated task is not counted twice
    writer = even.observe(seen, F.count(F.lit(1)).alias("rows"), F.bit_xor(_digest(df)).alias("checksum")).write
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(folder)
    staged = df.sparkSession.read.schema(df.schema).parquet(folder).select(*[F.col(f"`{c}`") for c in df.columns])
    return staged, seen.get["rows"], seen.get["checksum"] or 0


def _checked_sizes(staged: DataFrame, partition_by: str | None, rows: int, checksum: int) -> tuple[dict, dict]:
    """(bytes, rows) per partition value of what was staged; an error if it is not what was written."""
    per_file = staged.select(_by(partition_by).alias("value"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"),
                             _digest(staged).alias("digest")).groupBy("value", "file").agg(
        F.max("size").alias("size"), F.count(F.lit(1)).alias("n"), F.bit_xor("digest").alias("digest"))
    found = per_file.groupBy("value").agg(F.sum("size").alias("size"), F.sum("n").alias("n"), F.bit_xor("digest").alias("digest")).collect()
    read_rows, read_sum = sum(r.n for r in found), 0
    for r in found:
        read_sum ^= r.digest
    if (read_rows, read_sum) != (rows, checksum):
        raise PublishError(f"staged {read_rows} rows, checksum {read_sum}; written were {rows}, {checksum}")
    return {r.value: r.size for r in found}, {r.value: r.n for r in found}


def _dealt(staged: DataFrame, partition_by: str | None, files: dict, order_by: Sequence[str]) -> DataFrame:
    """Rows of ``staged``, one Spark partition per planned file."""
    total = max(1, sum(files.values()))
    if order_by:
        lead = [partition_by] if partition_by else []
        keys = [F.col(f"`{c}`") for c in (*lead, *(c for c in order_by if c not in lead))]
        return staged.repartitionByRange(total, *keys, _digest(staged)).sortWithinPartitions(*keys, _digest(staged))
    number, first = F.lit(0), 0
    for value, n in files.items():
        number = F.when(_by(partition_by).eqNullSafe(F.lit(value)), F.pmod(_digest(staged), F.lit(n)) + first).otherwise(number)
        first += n
    return staged.repartitionById(total, number.cast("int"))


@contextmanager
def _dynamic_overwrite(spark: SparkSession):
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def publish(df: DataFrame, target: str | None = None, partition_by: str | None = "date_granularity", replace: str = "all", path: str | None = None,
            fmt: str = "parquet", file_bytes: int = FILE_BYTES, order_by: Sequence[str] = ()) -> Published:
    """Write a report to the catalog table ``target``, or to the folder ``path``.

    ``partition_by`` (ignored if ``df`` has no such column) makes a folder per value, so that
    readers of one grain skip the others. ``replace='all'`` replaces the whole target; ``'touched'`` only the values of the
    partition column that ``df`` holds (dynamic partition overwrite), so a late week can be published alone. ``order_by`` keeps
    the files in that order. An empty result is written too: 'all' then empties the target, 'touched' changes nothing. Null
    partition values are a value of their own. The staging folder is removed in any case.
    """
    if (target is None) == (path is None):
        raise ValueError("give either a target table or a path")
    if replace not in REPLACE:
        raise ValueError(f"replace is one of {REPLACE}")
    if partition_by not in df.columns:
        partition_by = None
    spark = df.sparkSession
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/publish-{uuid.uuid4().hex}"
    try:
        staged, rows, checksum = _stage(df, folder, partition_by)
        sizes, counts = _checked_sizes(staged, partition_by, rows, checksum)
        files = {value: max(1, math.ceil(size / file_bytes)) for value, size in sizes.items()}
        dealt = _dealt(staged, partition_by, files, order_by)
        dynamic = replace == "touched" and partition_by is not None
        if target is not None and spark.catalog.tableExists(target) and dynamic:
            with _dynamic_overwrite(spark):  # insertInto asks the session, not the writer
                dealt.select(*spark.table(target).columns).write.insertInto(target, overwrite=True)
        else:
            writer = dealt.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic" if dynamic else "static")
            writer = writer.partitionBy(partition_by) if partition_by else writer
            if target is not None:
                writer.saveAsTable(target)
            else:
                writer.save(path)
        _check_target(spark.table(target) if target is not None else spark.read.format(fmt).schema(df.schema).load(path), partition_by, counts, replace)
    finally:
        remove_path(spark, folder)
    return Published(rows, files, counts)


def _check_target(table: DataFrame, partition_by: str | None, counts: dict, replace: str) -> None:
    """The rows of each partition value, which parquet answers from its footers."""
    found = {r.value: r.n for r in table.groupBy(_by(partition_by).alias("value")).agg(F.count(F.lit(1)).alias("n")).collect()}
    if replace == "touched" and partition_by is not None:
        found = {value: n for value, n in found.items() if value in counts}
    if found != counts:
        raise PublishError(f"the target holds {found}; staged were {counts}")
