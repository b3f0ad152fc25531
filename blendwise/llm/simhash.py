"""SimHash near-dedup with covering locality-sensitive hashing.

A fingerprint is 64 majority bits over the XXH64 values of a document's word
shingles. Two fingerprints are linked if at most ``radius`` bits differ.

Covering tables (Pagh 2016): every bit position i gets a vector m(i) over
GF(2)^(radius+1); the mask of a vector v keeps the positions with <m(i), v> = 1.
The at most ``radius`` differing positions of a linked pair span a space of
dimension ``radius`` or less, so some v other than 0 is orthogonal to all of
them: under its mask the two fingerprints are equal. The 2^(radius+1) - 1 tables
therefore hold every linked pair in one bucket at least, with certainty.

Work inside a bucket stays linear in its members. Up to ``PAIR_LIMIT`` distinct
fingerprints are compared in pairs. Larger buckets are split further: members
that share a point at most radius/2 flips away (flips of the bits the mask
leaves open) are within the radius of each other, and each linked pair shares
such a point, so the members of a point, whose number the ball size bounds, are
linked as a star. Both ways give the same components.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blendwise.llm.common import checkpointed, components, written, unused

BITS = 64
SEED = 42
PAIR_LIMIT = 64  # bucket size up to which members are compared in pairs


def shingle_hashes(text: str | None, width: int) -> np.ndarray:
    """XXH64 (seed 42) of each ``width``-word shingle, repeats included.

    Only A-Z are lower-cased; words are separated by ASCII white space
    (bytes.split). Fewer words than ``width``: one shingle; none: no hash.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], SEED)
                     for a, b in zip(starts[: 1 - width].tolist(), ends[width - 1:].tolist())],
                    np.uint64)


def majority(hashes: np.ndarray) -> int:
    """64 bits, each 1 if set in over half the hashes; as a signed long."""
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):  # bounded memory for very long texts
        block = hashes[at:at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprint_column(text, width: int = 3):
    """Column of fingerprints (long) of a string column; null and empty texts give 0."""

    @F.pandas_udf("long")
    def fingerprint(texts: pd.Series) -> pd.Series:
        return pd.Series([majority(shingle_hashes(t, width)) for t in texts], dtype="int64")

    return fingerprint(text)


def covering_masks(radius: int) -> list[int]:
    """The bit masks of the covering tables, as unsigned 64-bit numbers."""
    vectors = (1 << (radius + 1)) - 1
    of = [1 + i % vectors for i in range(BITS)]
    return [sum(1 << i for i in range(BITS) if bin(of[i] & v).count("1") % 2)
            for v in range(1, vectors + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _points(mask: int, radius: int) -> list[tuple[int, int]]:
    """(kept bits, flips) pairs: x maps to the point (kept, (x ^ flips) & kept).

    Even radius 2h: flips of up to h open bits. Odd radius 2h + 1: the same, with
    one open bit left out of the point.
    """
    open_bits = [1 << i for i in range(BITS) if not mask >> i & 1]
    flips = [sum(c) for h in range(radius // 2 + 1) for c in combinations(open_bits, h)]
    full = (1 << BITS) - 1
    if radius % 2 == 0:
        return [(full, f) for f in flips]
    return [(full & ~b, f) for b in open_bits for f in flips if not f & b]


def links(fingerprints: DataFrame, radius: int) -> DataFrame:
    """Edges (a, b) whose components are those of all pairs within ``radius``.

    ``fingerprints`` has one distinct long column ``fp``.
    """
    masks = covering_masks(radius)
    tables = F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
                       for t, m in enumerate(masks)])
    rows = fingerprints.select("fp", F.explode(tables).alias("b")).select("b.t", "b.key", "fp")
    sizes = rows.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1")
    shared = checkpointed(rows.join(sizes, ["t", "key"]))
    few = shared.where(F.col("n") <= PAIR_LIMIT)
    left = few.select("t", "key", F.col("fp").alias("a"))
    right = few.select("t", "key", F.col("fp").alias("b"))
    pairs = left.join(
        right, (left.t == right.t) & (left.key == right.key) & (left.a < right.b)
        & (F.bit_count(left.a.bitwiseXOR(right.b)) <= radius)).select("a", "b").distinct()
    per_table = F.array(*[F.array(*[F.struct(F.lit(_signed(keep)).alias("keep"), F.lit(_signed(flip)).alias("flip"))
                                    for keep, flip in _points(m, radius)]) for m in masks])
    # one point is reached from at most a ball of fingerprints, so the sets are bounded
    stars = (shared.where(F.col("n") > PAIR_LIMIT)
             .select("fp", F.explode(F.element_at(per_table, F.col("t") + 1)).alias("p"))
             .select("fp", "p.keep", F.col("fp").bitwiseXOR(F.col("p.flip")).bitwiseAND(F.col("p.keep")).alias("z"))
             .groupBy("keep", "z").agg(F.sort_array(F.collect_set("fp")).alias("members"))
             .where(F.size("members") > 1)
             .select(F.element_at("members", 1).alias("a"),
                     F.explode(F.slice("members", 2, 1 << 30)).alias("b")).distinct())
    return pairs.unionByName(stars)


def simhash_components(docs: DataFrame, width: int = 3, radius: int = 2,
                       id_col: str = "doc_id", text_col: str = "text", row_key: Column | None = None) -> DataFrame:
    """Per row of ``docs``: ``doc_id, fingerprint (long), component_id``.

    With ``row_key``, an expression over ``docs``, also ``row_key`` and ``component``, a
    fingerprint of the component that tells components apart whatever ids they hold.

    ``component_id`` is the smallest doc_id among all documents reachable by
    links of at most ``radius`` differing bits. Texts that are null, empty or
    only white space have fingerprint 0 and are linked like any other. Repeated
    rows stay as rows of one component. Null ids stay null and never become a
    component id unless the component holds no other. Extra columns are not
    read, whatever their names. An empty table gives an empty result.
    """
    keyed = [] if row_key is None else ["row_key"]
    prints = written(docs.select(F.col(id_col).alias("doc_id"), fingerprint_column(F.col(text_col), width).alias("fingerprint"),
                                 *[row_key.alias(c) for c in keyed]), "simhash")
    distinct = prints.groupBy(F.col("fingerprint").alias("fp")).agg(F.min("doc_id").alias("first_id"))
    roots = components(links(distinct.select("fp"), radius))
    rooted = (distinct.join(roots, distinct.fp == roots.node, "left")
              .select("fp", "first_id", F.coalesce("root", "fp").alias("root")))
    ids = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = rooted.join(ids, "root").select("fp", "component_id", F.col("root").alias("component"))
    return (prints.join(classes, prints.fingerprint == classes.fp, "left")
            .select("doc_id", "fingerprint", "component_id", *[c for k in keyed for c in (k, "component")]))


def one_of_each(docs: DataFrame, width: int = 3, radius: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` per component, all columns: that of the smallest id, null ids last.

    Of rows with that id the one of the smallest hash stays. Components are told apart by
    their fingerprints, so groups that share an id each keep a row.
    """
    key, chosen_key = unused("row_key", docs.columns), unused("chosen", docs.columns)
    hashed = docs.withColumn(key, F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]))
    found = simhash_components(hashed, width, radius, id_col, text_col, F.col(f"`{key}`"))
    chosen = found.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key")).alias("row")).select(
        F.bitwise_not("row.row_key").alias(chosen_key))
    kept = hashed.join(chosen, F.bitwise_not(F.col(f"`{key}`")) == F.col(f"`{chosen_key}`"), "left_semi")
    return kept.dropDuplicates([key]).select(*[F.col(f"`{c}`") for c in docs.columns])
