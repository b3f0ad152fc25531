"""Helpers shared by the operators: the shared folder, written tables, connected components."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

import numpy as np
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blendwise.session import ensure_checkpoint_dir, remove_path, write_step

DOC_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
BATCH_BYTES = 4 << 20  # what a task sends to its Python worker at a time; both ends hold a batch of texts more than once


def ship(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of ``spark``.

    A zip of it goes through Spark's own file distribution, once per context; not
    needed where PYTHONPATH, which workers inherit, already leads to the package.
    """
    root = Path(__file__).resolve().parents[2]
    paths = {Path(p).resolve() for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p}
    context = spark.sparkContext
    if root in paths or getattr(context, "_blendwise_shipped", False):
        return
    archive = Path(tempfile.mkdtemp(prefix="blendwise-ship-")) / "blendwise.zip"  # the driver serves it to all workers
    with zipfile.ZipFile(archive, "w") as z:
        for source in sorted((root / "blendwise").rglob("*.py")):
            z.write(source, source.relative_to(root))
    context.addPyFile(str(archive))
    context._blendwise_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder or spark.sparkContext.getCheckpointDir() is None:
        folder = ensure_checkpoint_dir(spark)
    return folder.rstrip("/")


def new_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/blendwise-{tag}-{uuid.uuid4().hex}"


def unused(name: str, taken) -> str:
    """``name``, with as many underscores before it as ``taken`` column names ask for."""
    taken = {c.lower() for c in taken}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def bounded_slices(batch, column: int, most: int):
    """Slices of an Arrow batch of which the texts in ``column`` hold about ``most`` bytes; a longer text is a slice."""
    sizes = np.array([0 if n is None else n for n in pc.binary_length(batch.column(column)).to_pylist()], np.int64)
    ends, lo = np.cumsum(sizes), 0
    while lo < batch.num_rows:
        hi = max(int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + most, "right")), lo + 1)
        yield batch.slice(lo, hi - lo)
        lo = hi


def drop_written(df: DataFrame) -> None:
    """Delete a table of ``written`` after its last reader."""
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        remove_path(df.sparkSession, path)


def written(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later steps neither
    repeat its work nor depend on the executors that did it. The shuffle files of
    that work go when it is written, not when the driver happens to collect its garbage."""
    return write_step(df, new_path(df.sparkSession, tag))


def checkpointed(df: DataFrame) -> DataFrame:
    """A step's table, written and read back.

    ``DataFrame.checkpoint`` would keep the plan's size estimate, and a join's is the product of its
    sides': over the rounds of an iteration it becomes a number of millions of digits, which fills the driver.
    A written table has the size of its files.
    """
    return written(df, "step")


def _mins_joined(pairs: DataFrame) -> DataFrame:
    """``pairs (u, v)`` with ``m``, the smallest v of u.

    The join key is ``~u``, not ``u``: the minimum is already hashed by ``u``
    and Spark would join in place, where a node with very many neighbours sits
    in one task. With a key of its own each side gets a plain shuffle, which
    AQE splits when it is skewed.
    """
    mins = pairs.groupBy("u").agg(F.min("v").alias("m")).select(F.bitwise_not("u").alias("k"), "m")
    return pairs.withColumn("k", F.bitwise_not("u")).join(mins, "k").select("u", "v", "m")


def _ordered(edges: DataFrame) -> DataFrame:
    return edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()


def _star_round(current: DataFrame) -> DataFrame:
    """One large-star and one small-star step over edges (u, v) with u > v; components stay."""
    both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
    large = (_mins_joined(both).where("v > u")
             .select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct())
    small = _mins_joined(large).select(
        F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")),
                          F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")
    ).select("e.u", "e.v").where("u <> v").distinct()
    return checkpointed(small)


def _next_round(current: DataFrame) -> DataFrame:
    """``_star_round`` of a written table, which goes."""
    after = _star_round(current)
    drop_written(current)
    return after


def contracted(edges: DataFrame, rounds: int = 2) -> DataFrame:
    """``edges (a, b)`` of the same components after some star rounds, a > b.

    Most nodes then have one edge, to the smallest node of their component.
    """
    current = checkpointed(_ordered(edges))
    for _ in range(rounds):
        current = _next_round(current)
    return current.select(F.col("u").alias("a"), F.col("v").alias("b"))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges (a long, b long)`` as ``(node, root)``.

    ``root`` is the smallest node of the component. Alternating large-star and
    small-star steps (Kiveris et al. 2014): each round is two map-side-combined
    minima and two joins, and is written to the shared folder. Self loops
    and repeated edges do no harm; an empty input gives an empty result.
    """
    current = checkpointed(_ordered(edges))
    before = None
    for _ in range(max_rounds):
        current = _next_round(current)
        now = current.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if before is not None and tuple(now) == before:
            break
        before = tuple(now)
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
