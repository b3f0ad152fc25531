"""Merkle manifest of a dataset by a nested-struct rollup.

Every row is a leaf: a SHA-256 over its fields, each with its length. The leaves of a
group stand in order of their id; every ``FAN`` consecutive nodes become one, until one
is left (the group's subroot). The subroots become the leaves of one more tree, whose
last node is the root of the dataset.

1. One scan hashes the rows; from here on a row is its id and its digests.
2. Rows get their rank in the group: a range partitioning by (group, id), the
   position within each range, and the sums of the ranges before. A group that holds
   a third of all rows is many ranges.
3. The rank in base ``FAN`` is ``DIGITS`` digit columns and a block number. Rows are
   shuffled by (group, block) once; then the digit columns are grouped away one after the other,
   the lowest first, and each group-by nests its rows as a list of child structs
   into the node above. A row is then a block of at most ``FAN ** DIGITS`` leaves with its
   whole subtree, however large the group is.
4. The blocks' nodes are the leaves of the next tier (a 729th of the rows), which is
   rolled up the same way, until each group is one block.
5. Proofs: a transform over a block's nested lists writes each leaf's steps (what stands left and
   right of it in its run, level by level), and an explode makes them rows, without a
   join of leaves. Between tiers only the block rows meet: each takes the steps above it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blendwise.llm.common import written

FAN, DIGITS = 3, 6
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_digest(fields: dict[str, Column]) -> Column:
    """SHA-256 (hex) of the fields in order: ``-`` for null, else UTF-8 byte count, ``:``, value."""
    parts = []
    for value in fields.values():
        value = value.cast("string")
        parts += [F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))]
    return F.sha2(F.concat(*parts), 256)


def _ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows (tree, ...)`` with ``rank`` (from 0, by ``order``) and ``size`` of their tree.

    Rows that are equal in ``order`` are numbered in some order of their own, so that
    many of them do not gather in one range.
    """
    ranged = written(rows.withColumn("salt", F.monotonically_increasing_id())
                     .repartitionByRange("tree", *order, "salt").withColumn("part", F.spark_partition_id()), "merkle-ranges")
    ranges = ranged.groupBy("tree", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.select(F.col("tree").alias("of_tree"), F.col("part").alias("of_part"),
                            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"),
                            F.sum("n").over(Window.partitionBy("tree")).alias("size"))
    at = F.row_number().over(Window.partitionBy("tree", "part").orderBy(*order, "salt"))
    placed = ranged.withColumn("at", at)
    return (placed.join(offsets, (F.col("tree") == F.col("of_tree")) & (F.col("part") == F.col("of_part")))
            .withColumn("rank", F.col("offset") + F.col("at") - 1)
            .drop("salt", "part", "of_tree", "of_part", "offset", "at"))


def _has_level(level: int) -> Column:
    """Whether a tree of ``size`` leaves still has several nodes at ``level``."""
    return F.col("size") > FAN ** level


def _blocks(nodes: DataFrame, payload: list[str], digits: int) -> DataFrame:
    """``nodes (tree, size, rank, h, *payload)`` as ``(tree, size, block, h, kids)``.

    ``kids`` nests ``digits`` levels of child structs; ``h`` is the node above them.
    """
    digit = [F.expr(f"cast(rank div {FAN ** i} % {FAN} as int)").alias(f"d{i}") for i in range(digits)]
    rows = nodes.select("tree", "size", F.expr(f"rank div {FAN ** digits}").alias("block"), "h", *payload, *digit)
    rows = rows.repartition("tree", "block")  # holds for every group-by below
    inner = payload
    for level in range(digits):
        kids = F.array_sort(F.collect_list(F.struct(F.col(f"d{level}").alias("d"), "h", *inner)))
        rows = (rows.groupBy("tree", "size", "block", *[f"d{i}" for i in reversed(range(level + 1, digits))])
                .agg(kids.alias("kids"))
                .withColumn("h", F.when(_has_level(level), F.sha2(F.array_join("kids.h", ""), 256))
                            .otherwise(F.element_at("kids.h", 1))))
        inner = ["kids"]
    return rows


def _steps(kids: Column, level: int, above: Column, payload: list[str]) -> Column:
    """Array of ``(h, *payload, steps)``, one per leaf below ``kids``, in order of rank."""

    def node(kid, i):
        hashes = F.transform(kids, lambda x: x["h"])
        step = F.struct(F.array_join(F.slice(hashes, F.lit(1), i), "").alias("left"),
                        F.array_join(F.slice(hashes, i + 2, F.lit(FAN)), "").alias("right"))
        steps = F.when(_has_level(level), F.concat(F.array(step), above)).otherwise(above)
        if level:
            return _steps(kid["kids"], level - 1, steps, payload)
        return F.array(F.struct(kid["h"].alias("h"), *[kid[c].alias(c) for c in payload], steps.alias("steps")))

    return F.flatten(F.transform(kids, node))


class _Forest:
    """Trees over ``nodes (tree, size, rank, h, *payload)``, tier by tier, each written."""

    def __init__(self, nodes: DataFrame, payload: list[str], digits: int):
        self.payload, self.digits, self.tiers = payload, digits, []
        largest = nodes.agg(F.max("size")).first()[0] or 0
        while True:
            self.tiers.append(written(_blocks(nodes, [] if self.tiers else payload, digits), "merkle-blocks"))
            if largest <= FAN ** digits:
                break
            largest = -(-largest // FAN ** digits)
            size = F.expr(f"(size + {FAN ** digits - 1}) div {FAN ** digits}")
            nodes = self.tiers[-1].select("tree", size.alias("size"), F.col("block").alias("rank"), "h")
        self.tops = self.tiers[-1].select("tree", "h")

    def proofs(self, tops: DataFrame) -> DataFrame:
        """The leaves with ``steps``; ``tops (tree, steps, *carried)`` has the steps above each tree."""
        carried = [c for c in tops.columns if c not in ("tree", "steps")]
        current = tops.withColumn("rank", F.lit(0).cast("long"))
        for i, tier in reversed(list(enumerate(self.tiers))):
            payload = [] if i else self.payload
            above = current.select(F.col("tree").alias("of_tree"), F.col("rank").alias("of_block"), F.col("steps").alias("above"), *carried)
            rows = tier.join(above, (F.col("tree") == F.col("of_tree")) & (F.col("block") == F.col("of_block")))
            leaves = _steps(F.col("kids"), self.digits - 1, F.col("above"), payload)
            current = rows.select("tree", "block", *carried, F.posexplode(leaves).alias("at", "leaf")).select(
                "tree", (F.col("block") * FAN ** self.digits + F.col("at")).alias("rank"), "leaf.h", *[f"leaf.{c}" for c in payload],
                "leaf.steps", *carried)
        return current


def manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, group_col: str = "source", id_col: str = "doc_id",
             also: dict[str, Column] | None = None, digits: int = DIGITS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, tree, rank, leaf, steps, subroot, root`` and ``also``.

    ``steps`` is the proof, an array of (left, right): what stands beside the node in its
    run at each level from leaf to root; ``fold`` recomputes the root from it. ``also``
    are more columns computed from a row of ``docs`` and carried along (small ones: they travel through
    the rollup). ``tree`` is the group's value after ``=``, empty for null.

    Null fields enter the digest as ``-``; null and empty texts differ. Null groups are one group, the
    first; null ids come first in it. Rows of one id stand in order of their digests, so repeated
    rows are leaves of their own and the result does not depend on the order of the input.
    Texts of any length are hashed whole. Columns outside ``fields`` are not read and may
    have any name. An empty table gives an empty result.
    """
    also = also or {}
    leaves = written(docs.select(
        F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit("")).alias("tree"), F.col(id_col).alias("id"),
        leaf_digest({c: F.col(c) for c in fields}).alias("h"), *[c.alias(f"also_{name}") for name, c in also.items()]), "merkle-leaves")
    payload = ["id", *[f"also_{name}" for name in also]]
    groups = _Forest(_ranked(leaves, ["id", "h"]), payload, digits)
    subroots = groups.tops.select(F.lit("").alias("tree"), F.col("tree").alias("of"), "h")
    whole = _Forest(_ranked(subroots, ["of"]), ["of"], digits)
    above = whole.proofs(whole.tops.select("tree", F.expr("cast(array() as array<struct<left: string, right: string>>)").alias("steps"),
                                           F.col("h").alias("root")))
    tops = above.select(F.col("of").alias("tree"), "steps", F.col("h").alias("subroot"), "root")
    return groups.proofs(tops).select(F.col("id").alias(id_col), "tree", "rank", F.col("h").alias("leaf"), "steps", "subroot", "root",
                                      *[F.col(f"also_{name}").alias(name) for name in also])


def fold(leaf: Column, steps: Column) -> Column:
    """The root that ``leaf`` and the steps of its proof give."""
    return F.aggregate(steps, leaf, lambda node, step: F.sha2(F.concat(step["left"], node, step["right"]), 256))


def proof_digest(steps: Column) -> Column:
    """SHA-256 of all siblings of a proof, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(steps, lambda s: F.concat(s["left"], s["right"])), ""), 256)
