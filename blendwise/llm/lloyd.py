"""Product codes of vectors: Lloyd's rounds on dual trees, in integers throughout.

A vector's components become integers and are cut into consecutive parts; every part
position has a codebook, and a vector's code is the index of the nearest entry per part.

1. One scan makes blocks of at most ``BLOCK`` vectors. For every part position of a block a balanced
   tree over its parts is built once and written: the parts in tree order and, per node,
   the bounding box, the number of parts and their sum.
2. A round takes the codebooks (a few KB) to the blocks. The entries of a codebook get a
   tree too, and both trees are descended together: for a pair of nodes the least and greatest distance
   between their boxes are known, and entry nodes farther than the least of the greatest distances are
   pruned for that part node and all below it. A part node with one entry left is assigned whole: its
   cached count and sum are added. Leaves that stay uncertain compare their parts with the entries left. All distances
   are 64-bit integers, so pruning never decides a tie: equal distances reach the leaves, where the lower index wins.
3. A task returns one count and sum per entry; Spark adds them up and the driver divides. Vectors
   are never shuffled.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from blendwise.llm.common import written

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
BLOCK = 4096  # vectors of a block
LEAF = 32  # parts of a leaf
LARGEST = 1 << 27  # of an integer component: squared distances of a part of 8 fit 64 bits by far
FAR = np.iinfo(np.int64).max


def kept(vector: Column) -> Column:
    """Whether a vector takes part: not null, not empty, every component a finite number."""
    return F.coalesce((F.size(vector) > 0) & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def integers(vectors: pa.Array, dims: int, scale: int) -> np.ndarray:
    """(n, dims) integers floor(scale * x) of lists that all have ``dims`` finite components."""
    x = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)
    x = np.floor(x * scale)
    if len(x) and np.abs(x).max() >= LARGEST:
        raise ValueError(f"a component is beyond {LARGEST // scale}: distances would not fit 64 bits")
    return x.astype(np.int64)


class Tree:
    """Balanced tree over points; level l has 2**l nodes of equally many points.

    The number of points is filled up with copies of the last one, which do not count
    (``order`` numbers them from n on) and do not widen a box.
    """

    def __init__(self, order: np.ndarray, points: np.ndarray, n: int, levels: list):
        self.order, self.points, self.n, self.levels = order, points, n, levels

    @classmethod
    def over(cls, points: np.ndarray, leaf: int) -> Tree:
        n, width = points.shape
        depth = max(0, (-(-n // leaf) - 1).bit_length())
        total = -(-n // 2 ** depth) * 2 ** depth
        filled = np.concatenate([points, np.repeat(points[-1:], total - n, axis=0)])
        order = np.arange(total)
        for level in range(depth):
            rows = filled[order].reshape(2 ** level, -1, width)
            widest = (rows.max(1) - rows.min(1)).argmax(1)
            keys = np.take_along_axis(rows, widest[:, None, None], 2)[:, :, 0]
            within = np.argsort(keys, axis=1, kind="stable")
            order = np.take_along_axis(order.reshape(2 ** level, -1), within, 1).ravel()
        return cls(order, filled[order], n, [cls._level(filled, order, n, level) for level in range(depth + 1)])

    @staticmethod
    def _level(filled, order, n, level):
        rows = filled[order].reshape(2 ** level, -1, filled.shape[1])
        real = (order < n).reshape(2 ** level, -1)
        return rows.min(1), rows.max(1), real.sum(1), (rows * real[:, :, None]).sum(1)

    def packed(self) -> dict:
        """As binary columns; the points are 32-bit."""
        return {"order": self.order.astype("<i4").tobytes(), "points": self.points.astype("<i4").tobytes(),
                "nodes": np.concatenate([np.concatenate([lo, hi, count[:, None], total], axis=1) for lo, hi, count, total in self.levels]).astype("<i8").tobytes()}

    @classmethod
    def unpacked(cls, row: dict, n: int, width: int) -> Tree:
        order = np.frombuffer(row["order"], "<i4").astype(np.int64)
        points = np.frombuffer(row["points"], "<i4").astype(np.int64).reshape(-1, width)
        nodes = np.frombuffer(row["nodes"], "<i8").reshape(-1, 3 * width + 1)
        levels, at = [], 0
        while at < len(nodes):
            part = nodes[at:2 * at + 1]
            levels.append((part[:, :width], part[:, width:2 * width], part[:, 2 * width], part[:, 2 * width + 1:]))
            at = 2 * at + 1
        return cls(order, points, n, levels)


def _box_distances(lo, hi, entry_lo, entry_hi):
    """Least and greatest squared distance between each box and each entry box."""
    lo, hi, entry_lo, entry_hi = lo[:, None], hi[:, None], entry_lo[None], entry_hi[None]
    gap = np.maximum(np.maximum(entry_lo - hi, lo - entry_hi), 0)
    reach = np.maximum(np.abs(hi - entry_lo), np.abs(entry_hi - lo))
    return (gap * gap).sum(2), (reach * reach).sum(2)


def nearest(tree: Tree, entries: np.ndarray, each: bool = False):
    """(count, sum) per entry of the parts nearest to it, or with ``each`` every part's entry.

    Of entries at equal distance the lowest index is taken. ``each`` is in the order of
    the points that the tree was built over.
    """
    book, width = Tree.over(entries, 1), entries.shape[1]
    counts, sums = np.zeros(len(entries), np.int64), np.zeros((len(entries), width), np.int64)
    codes = np.zeros(len(tree.order), np.int64)
    nodes, alive = np.zeros(1, np.int64), np.ones((1, 1), bool)
    for level, (lo, hi, count, total) in enumerate(tree.levels):
        while True:
            depth = alive.shape[1].bit_length() - 1
            entry_lo, entry_hi, real = book.levels[depth][:3]
            least, greatest = _box_distances(lo[nodes], hi[nodes], entry_lo, entry_hi)
            alive &= real > 0
            bound = np.where(alive, greatest, FAR).min(1, keepdims=True)
            alive &= least <= bound
            last = depth == len(book.levels) - 1
            if not last:
                alive = np.repeat(alive, 2, axis=1)
            if last or level < len(tree.levels) - 1:
                break  # at the leaves the entries are descended to the end
        if last:
            sure = alive.sum(1) == 1
            entry = book.order[alive[sure].argmax(1)]
            np.add.at(counts, entry, count[nodes[sure]])
            np.add.at(sums, entry, total[nodes[sure]])
            size = len(tree.order) >> level
            codes[(nodes[sure, None] * size + np.arange(size)).ravel()] = np.repeat(entry, size)
            nodes, alive = nodes[~sure], alive[~sure]
        if not len(nodes):
            break
        if level < len(tree.levels) - 1:
            nodes, alive = (nodes[:, None] * 2 + np.arange(2)).ravel(), np.repeat(alive, 2, axis=0)
            continue
        size = len(tree.order) >> level
        at = (nodes[:, None] * size + np.arange(size)).ravel()
        open_entries = np.zeros((len(nodes), len(entries)), bool)
        columns = np.flatnonzero(book.order < book.n)
        open_entries[:, book.order[columns]] = alive[:, columns]
        best, entry = np.full(len(at), FAR), np.zeros(len(at), np.int64)
        for j, value in enumerate(entries):
            rows = np.flatnonzero(np.repeat(open_entries[:, j], size))
            apart = tree.points[at[rows]] - value
            apart = (apart * apart).sum(1)
            closer = apart < best[rows]
            best[rows[closer]], entry[rows[closer]] = apart[closer], j
        codes[at] = entry
        real = tree.order[at] < tree.n
        np.add.at(counts, entry[real], 1)
        np.add.at(sums, entry[real], tree.points[at[real]])
    if not each:
        return counts, sums
    out = np.empty(len(codes), np.int64)
    out[tree.order] = codes
    return out[:tree.n]


def _blocks(dims: int, parts: int, scale: int, block: int, leaf: int, schema: pa.Schema):
    """Makes a row per block: its ids and labels, and a tree per part position."""
    width = dims // parts

    def rows(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, block):
                part = batch.slice(lo, block)
                x = integers(part.column("vector"), dims, scale)
                trees = [Tree.over(x[:, p * width:(p + 1) * width], leaf).packed() for p in range(parts)]
                yield pa.RecordBatch.from_pylist([{"ids": part.column("id").to_pylist(), "labels": part.column("label").to_pylist(), "trees": trees}], schema)

    return rows


def _unpacked(batches, width: int):
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            yield row, [Tree.unpacked(t, len(row["ids"]), width) for t in row["trees"]]


def _round(blocks: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round."""
    parts, entries, width = books.shape

    def partial(batches):
        counts, sums = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), np.int64)
        for _, trees in _unpacked(batches, width):
            for p, tree in enumerate(trees):
                count, total = nearest(tree, books[p])
                counts[p] += count
                sums[p] += total
        p, e = np.nonzero(counts)
        yield pa.RecordBatch.from_pydict({"part": pa.array(p, pa.int32()), "entry": pa.array(e, pa.int32()), "n": pa.array(counts[p, e], pa.int64()),
                                          "sums": pa.array(sums[p, e].tolist(), pa.list_(pa.int64()))})

    found = blocks.select("ids", "labels", "trees").mapInArrow(partial, "part int, entry int, n long, sums array<long>").groupBy("part", "entry").agg(
        F.sum("n").alias("n"), *[F.sum(F.col("sums")[i].cast("decimal(20,0)")).alias(f"s{i}") for i in range(width)])
    new = books.copy()
    for row in found.collect():  # a row per part position and entry
        new[row.part, row.entry] = [int(row[f"s{i}"]) // row.n for i in range(width)]
    return new


def codebook_digest(books: np.ndarray) -> str:
    """SHA-256 (hex) of all components, by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def product_codes(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
                  id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                  block: int = BLOCK, leaf: int = LEAF) -> tuple[DataFrame, np.ndarray]:
    """``(vec_id, code, error, label, label_error)`` per vector, and the codebooks (parts, entries, width).

    The codebooks start as the parts of the vectors with the smallest ids (``entries`` of them; fewer
    vectors make fewer entries). ``code`` is a list of indices, ``error`` the squared distance to what the code
    stands for, ``label_error`` its sum over the vectors of one label.

    Vectors that are null or empty, or hold a null or non-finite component, take no part; nor do
    those of another length than the vector of the smallest id. Null ids come last when the
    entries are chosen, repeated ids in the order of their vectors; repeated rows count each.
    Null labels are one label. Equal entries stay, the lower index is used. No vector at
    all gives an empty result and no entry. Columns besides the three are not read. Components
    beyond 2**27 / scale raise an error, as their distances would not fit 64 bits.
    """
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"), F.col(label_col).alias("label")).where(kept(F.col("vector")))
    first = rows.select("id", "vector").orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).collect()
    dims = len(first[0].vector) if first else parts
    if dims % parts:
        raise ValueError(f"{dims} components can't be cut into {parts} equal parts")
    width = dims // parts
    first = [r.vector for r in first if len(r.vector) == dims]
    books = integers(pa.array(first, pa.list_(pa.float64())), dims, scale).reshape(-1, parts, width).transpose(1, 0, 2).copy()

    kinds = {f.name: f.dataType for f in rows.schema}
    tree = T.StructType([T.StructField(c, T.BinaryType()) for c in ("order", "points", "nodes")])
    schema = T.StructType([T.StructField("ids", T.ArrayType(kinds["id"])), T.StructField("labels", T.ArrayType(kinds["label"])),
                           T.StructField("trees", T.ArrayType(tree))])
    blocks = written(rows.where(F.size("vector") == dims).mapInArrow(_blocks(dims, parts, scale, block, leaf, to_arrow_schema(schema)), schema), "lloyd-blocks")
    for _ in range(rounds if first else 0):
        books = _round(blocks, books)

    out = T.StructType([T.StructField("id", kinds["id"]), T.StructField("code", T.ArrayType(T.IntegerType())), T.StructField("error", T.LongType()),
                        T.StructField("label", kinds["label"])])
    arrow = to_arrow_schema(out)

    def coded(batches):
        for row, trees in _unpacked(batches, width):
            codes = np.stack([nearest(t, books[p], each=True) for p, t in enumerate(trees)], axis=1)
            error = np.zeros(len(codes), np.int64)
            for p, t in enumerate(trees):
                points = np.empty_like(t.points)
                points[t.order] = t.points
                apart = points[:t.n] - books[p][codes[:, p]]
                error += (apart * apart).sum(1)
            yield pa.RecordBatch.from_arrays([pa.array(row["ids"], arrow.field("id").type), pa.array(codes.astype(np.int32).tolist(), pa.list_(pa.int32())),
                                              pa.array(error, pa.int64()), pa.array(row["labels"], arrow.field("label").type)], schema=arrow)

    codes = written(blocks.mapInArrow(coded, out), "lloyd-codes")
    # an array is a key for null labels too, and not the key that the sums are hashed by: AQE may split the join
    sums = codes.groupBy("label").agg(F.sum("error").alias("label_error")).select(F.array("label").alias("of"), "label_error")
    return (codes.join(sums, F.array("label") == F.col("of"))
            .select(F.col("id").alias(id_col), "code", "error", F.col("label").alias(label_col), "label_error")), books
