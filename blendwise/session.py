"""SparkSession settings the blends are designed for.

Nothing here is required: every operator takes and returns plain DataFrames and
works on any session. ``configure`` only sets what the operators rely on for
correctness (UTC session time zone, ANSI mode) and what they rely on for scale
(AQE with partition coalescing, skew-join splitting and runtime broadcast
conversion, whose size threshold is the check that guards every broadcast).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that matter for correct results.
CORRECTNESS_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Settings that matter at scale. The broadcast thresholds are the size check:
# Spark broadcasts a join side only when its estimated (static) or measured
# (AQE, runtime) size is below them and falls back to a sort-merge join above. A task
# accounts for the whole broadcast side, which as a hash table is many times its rows' size.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(8 * 1024 * 1024),
    "spark.sql.autoBroadcastJoinThreshold": str(8 * 1024 * 1024),
    # compressed shuffle bytes that one task gets: a roll-up makes five rows in memory of each it reads
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(4 * 1024 * 1024),
    # compressed file bytes that one task gets: those that aggregate what they scan hold its groups
    "spark.sql.files.maxPartitionBytes": str(32 * 1024 * 1024),
    "spark.sql.parquet.filterPushdown": "true",
}


def shuffle_partitions_for(shuffle_bytes: int, target_bytes: int = 128 * 1024 * 1024,
                           minimum: int = 200) -> int:
    """Initial shuffle partition count so each partition holds about ``target_bytes``.

    AQE can merge small shuffle partitions but cannot split large ones (other
    than skewed join partitions), so the initial count must fit the largest
    shuffle: 100 TB at 128 MB each is about 800,000 partitions.
    """
    return max(minimum, -(-int(shuffle_bytes) // int(target_bytes)))


def partitions_for_input(spark: SparkSession, folder: str, target_bytes: int = 4 * 1024 * 1024) -> int:
    """One shuffle partition per ``target_bytes`` of the files in ``folder``, wherever Spark can read.

    A task then aggregates, joins and sorts as many rows over large tables as over small ones.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    held = path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
    return shuffle_partitions_for(held, target_bytes, minimum=1)


def configure_for(spark: SparkSession, folder: str) -> SparkSession:
    """``configure``, with shuffles that start with as many partitions as the tables in ``folder`` ask for.

    Only the start is set; partitions that end up small are merged again (AQE).
    """
    configure(spark)
    wanted = max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), partitions_for_input(spark, folder))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(wanted))
    return spark


def configure(spark: SparkSession, expected_shuffle_bytes: int | None = None) -> SparkSession:
    """Apply the runtime settings above to an existing session.

    With ``expected_shuffle_bytes`` (the largest shuffle of the job, e.g. the
    raw fact volume before the first aggregation) the shuffle partition count
    is raised to fit it; AQE then coalesces the partitions that end up small.
    """
    for key, value in {**CORRECTNESS_CONF, **SCALE_CONF}.items():
        spark.conf.set(key, value)
    if expected_shuffle_bytes:
        wanted = shuffle_partitions_for(expected_shuffle_bytes)
        current = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
        spark.conf.set("spark.sql.shuffle.partitions", str(max(current, wanted)))
    return spark


def local_session(cores: int = 8, shuffle_partitions: int | None = None,
                  app: str = "blendwise") -> SparkSession:
    """A local session for tests and benchmarks (UI off, no extra ports)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BLENDWISE_DRIVER_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in {**CORRECTNESS_CONF, **SCALE_CONF}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, setting a scratch one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is; a cluster session without it is an error. Only a local session without
    it (tests, local runs) gets a fresh temporary folder.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir() if hasattr(
            spark.sparkContext, "getCheckpointDir") else None
    if not current:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        current = tempfile.mkdtemp(prefix="blendwise-ckpt-")  # local runs and tests only
        spark.conf.set("spark.checkpoint.dir", current)
    spark.sparkContext.setCheckpointDir(current)
    return current


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def write_step(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` to ``path`` and read it back. The shuffle files of that work go when it is written,
    not when the driver happens to collect its garbage."""
    spark = df.sparkSession
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of the session's own making, wherever Spark can write; nothing if it is not there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


class Shared:
    """Relations that several branches of one report read (S2): written once, removed by their owner.

    ``with Shared(spark) as shared: report(inputs, shared=shared).write...`` - the tables live in
    the folder that the cluster names in ``spark.checkpoint.dir``, so branches do not depend on the executors that
    wrote them, and go when the block ends. Nothing is kept in the process.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.folder = spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/shared-{uuid.uuid4().hex}"
        self.tables = 0

    def __enter__(self) -> Shared:
        return self

    def __exit__(self, *_) -> None:
        self.release()

    def written(self, df: DataFrame) -> DataFrame:
        """``df`` as a written table; its branches read the table instead of repeating the work."""
        path = f"{self.folder}/{self.tables}"
        self.tables += 1
        return write_step(df, path)

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables of ``written`` after their last reader."""
        for path in {f.rsplit("/", 1)[0] for t in tables for f in t.inputFiles()}:
            remove_path(self.spark, path)

    def release(self) -> None:
        remove_path(self.spark, self.folder)
