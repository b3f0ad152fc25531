"""Exact top-k by inner product over a pivot-distance index.

Vectors x become points (x, sqrt(R^2 - |x|^2)) on a sphere of the largest norm R, queries q points (q, 0): the
squared distance of the two is |q|^2 + R^2 - 2 q.x, so the highest inner products are the nearest points, and the triangle
inequality over a pivot p bounds them: d(q, x) >= |d(q, p) - d(x, p)|.

1. Equal vectors are one vector with its k + 1 smallest ids: no other copy can reach a result, as
   ties go to smaller ids and a query leaves out its own row only.
2. ``PIVOTS`` pivots are chosen, far from each other, in a sample of ``SAMPLE`` vectors drawn by hash. Every vector is
   keyed by its nearest pivot and its distance to it; the distances of a pivot are cut at their quantiles into at most
   ``RINGS`` annuli. The directory of annuli (count, least and greatest distance) has a bounded size and goes to every task.
3. The index: vectors sorted by (annulus, distance), in blocks of at most ``BLOCK`` with their own bounds of the distance.
4. Queries (distinct vectors) first visit the annuli nearest to their own key until these hold k + 1 rows, which
   gives each a score to beat. Then they expand to all other annuli whose bound reaches that score, and stop there: the rest
   can't hold a result. In an annulus, a block whose own bound is too low is skipped.
5. A visit is an equi-join of chunks of queries with blocks on the annulus; each pair is one matrix product. Annuli of many
   blocks or queries are many rows, which AQE splits. The k + 1 best of each pair meet in a ranking whose limit
   Spark applies before the shuffle.
6. Every query row takes its vector's list, leaves out itself and numbers the rest.

Products are exact: sums of products of integers below 2**53 in doubles. Bounds carry a slack far above the rounding
of square roots, so rounding never prunes a result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blendwise.llm.common import written
from blendwise.llm.lloyd import kept

K, SCALE = 10, 1024
SAMPLE, PIVOTS, RINGS = 2048, 32, 8  # few annuli: a query that visits all of them is sent 256 times
BLOCK, CHUNK = 2048, 512
EXACT = 2.0 ** 53
SLACK = 1e-6  # of |q|^2 + R^2: a small distance is the root of a rounded difference and errs by 1e-7 R at most
INDEX = "annulus int, lo double, hi double, vectors binary, ids array<array<long>>"
CHUNKS = "annulus int, qids array<long>, vectors binary, beats array<double>"


def _integers(scale: int):
    """Makes (id, query, v, square): v holds floor(scale * x) as 32-bit integers, square is its squared norm."""

    def rows(batches):
        for batch in batches:
            lists = batch.column("vector")
            values = np.floor(lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
            if len(values) and np.abs(values).max() >= 2 ** 31:
                raise ValueError(f"a component is beyond {2 ** 31 // scale}: products would not be exact")
            data, ends = values.astype("<i4").tobytes(), np.cumsum(lists.value_lengths().to_numpy())
            edges = np.concatenate([[0], ends]) * 4
            v = [data[a:b] for a, b in zip(edges[:-1], edges[1:])]
            squares = np.add.reduceat(values * values, np.concatenate([[0], ends[:-1]])) if len(v) else np.zeros(0)
            if len(v) and squares.max() >= EXACT:
                raise ValueError("a squared norm is beyond 2**53: products would not be exact")
            yield pa.record_batch([batch.column("id"), batch.column("query"), pa.array(v, pa.binary()), pa.array(squares, pa.float64())],
                                  names=["id", "query", "v", "square"])

    return rows


def _matrix(blobs: list[bytes], dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), "<i4").reshape(-1, dims).astype(np.float64)


def choose_pivots(sample: np.ndarray, pivots: int) -> np.ndarray:
    """Rows of ``sample`` that are far from each other: each next one is the farthest from those before."""
    chosen, apart = [], np.full(len(sample), np.inf)
    at = 0
    while len(chosen) < min(pivots, len(sample)) and apart[at] > 0:
        chosen.append(at)
        apart = np.minimum(apart, ((sample - sample[at]) ** 2).sum(1))
        at = int(apart.argmax())
    return sample[chosen]


class Space:
    """The pivots and the sphere: distances of vectors and of queries to the pivots."""

    def __init__(self, pivots: np.ndarray, largest: float):
        self.pivots, self.largest = pivots, largest
        self.lift = self._lifted(pivots)

    def _lifted(self, x):
        return np.sqrt(np.maximum(self.largest - (x * x).sum(1), 0))

    def vectors(self, x: np.ndarray) -> np.ndarray:
        """(n, pivots) distances of lifted vectors."""
        return np.sqrt(np.maximum(2 * self.largest - 2 * (x @ self.pivots.T + np.outer(self._lifted(x), self.lift)), 0))

    def queries(self, q: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum((q * q).sum(1)[:, None] + self.largest - 2 * q @ self.pivots.T, 0))

    def bound(self, squares: np.ndarray, distance: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Greatest inner product of queries with vectors whose distance to a pivot is in lo..hi,
        given the queries' distances to it; shapes are broadcast."""
        both = squares + self.largest
        gap = np.maximum(np.maximum(lo - distance, distance - hi), 0)
        return (both - gap * gap) / 2 + SLACK * both + 1


class Directory:
    """Annuli of all pivots: number, pivot, least and greatest distance, rows (copies up to k + 1 counted)."""

    def __init__(self, rows: list):
        rows = sorted(rows, key=lambda r: r.annulus)
        self.number = np.array([r.annulus for r in rows], np.int64)
        self.lo, self.hi = np.array([r.lo for r in rows], float), np.array([r.hi for r in rows], float)
        self.rows = np.array([r.n for r in rows], np.int64)

    def bounds(self, space: Space, q: np.ndarray) -> np.ndarray:
        """(queries, annuli) greatest inner products."""
        distance = space.queries(q)[:, self.number // RINGS]
        return space.bound((q * q).sum(1)[:, None], distance, self.lo, self.hi)

    def first(self, space: Space, q: np.ndarray, need: int) -> np.ndarray:
        """(queries, annuli): those nearest to each query's own place until they hold ``need`` rows."""
        order = np.argsort(-self.bounds(space, q), axis=1, kind="stable")
        before = np.cumsum(self.rows[order], axis=1) - self.rows[order]
        out = np.zeros(order.shape, bool)
        np.put_along_axis(out, order, before < need, 1)
        return out


def _annuli(space: Space, dims: int, cuts: np.ndarray | None):
    """Makes (annulus, distance, v, ids, n): without ``cuts`` (pivots, RINGS - 1) the annulus is the pivot's first."""

    def rows(batches):
        for batch in batches:
            if batch.num_rows:
                far = space.vectors(_matrix(batch.column("v").to_pylist(), dims))
                pivot = far.argmin(1)
                distance = far[np.arange(len(far)), pivot]
                ring = 0 if cuts is None else (cuts[pivot] < distance[:, None]).sum(1)
                yield pa.record_batch([pa.array(pivot * RINGS + ring, pa.int32()), pa.array(distance, pa.float64()), batch.column("v"),
                                       batch.column("ids"), batch.column("n")], names=["annulus", "distance", "v", "ids", "n"])

    return rows


def _gathered(names: list[str], most: int, row):
    """Cuts a sorted partition at changes of the annulus, and after ``most`` rows; ``row`` makes one row of each run."""

    def rows(batches):
        held, annulus = [], None
        for batch in batches:
            for r in zip(*[batch.column(c).to_pylist() for c in names]):
                if held and (r[0] != annulus or len(held) == most):
                    yield row(annulus, held)
                    held = []
                annulus = r[0]
                held.append(r)
        if held:
            yield row(annulus, held)

    return rows


def _block_row(annulus, held):
    return pa.record_batch([pa.array([annulus], pa.int32()), pa.array([held[0][1]], pa.float64()), pa.array([held[-1][1]], pa.float64()),
                            pa.array([b"".join(h[2] for h in held)], pa.binary()), pa.array([[h[3] for h in held]], pa.list_(pa.list_(pa.int64())))],
                           names=["annulus", "lo", "hi", "vectors", "ids"])


def _chunk_row(annulus, held):
    return pa.record_batch([pa.array([annulus], pa.int32()), pa.array([[h[1] for h in held]], pa.list_(pa.int64())),
                            pa.array([b"".join(h[2] for h in held)], pa.binary()), pa.array([[h[3] for h in held]], pa.list_(pa.float64()))],
                           names=["annulus", "qids", "vectors", "beats"])


def _chunks(space: Space, directory: Directory, queries: DataFrame, dims: int, need: int, expand: bool) -> DataFrame:
    """``queries (qid, v, beat)`` gathered in chunks for the annuli they visit: the first ones, or all others
    whose bound reaches the score to beat."""

    def visits(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, CHUNK):
                part = batch.slice(lo, CHUNK)
                q = _matrix(part.column("v").to_pylist(), dims)
                to = directory.first(space, q, need)
                if expand:
                    to = ~to & (directory.bounds(space, q) >= np.array(part.column("beat").to_pylist())[:, None])
                row, column = np.nonzero(to)
                take = pa.array(row, pa.int64())
                yield pa.record_batch([pa.array(directory.number[column], pa.int32()), *[part.column(c).take(take) for c in ("qid", "v", "beat")]],
                                      names=["annulus", "qid", "v", "beat"])

    visited = queries.select("qid", "v", "beat").mapInArrow(visits, "annulus int, qid long, v binary, beat double")
    dealt = visited.repartitionByRange("annulus", "qid").sortWithinPartitions("annulus", "qid")
    return dealt.mapInArrow(_gathered(["annulus", "qid", "v", "beat"], CHUNK, _chunk_row), CHUNKS)


def _searched(space: Space, index: DataFrame, chunks: DataFrame, dims: int, need: int) -> DataFrame:
    """``qid, score, id, same`` of the ``need`` best of each pair of a chunk and a block of one annulus."""

    def best(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                r = {c: batch.column(c)[i].as_py() for c in ("annulus", "lo", "hi", "qids", "beats")}
                q, beats = _matrix([batch.column("queries")[i].as_py()], dims), np.array(r["beats"])
                squares, distance = (q * q).sum(1), space.queries(q)[:, r["annulus"] // RINGS]
                reach = np.flatnonzero(space.bound(squares, distance, r["lo"], r["hi"]) >= beats)
                if not len(reach):
                    continue
                x, ids = _matrix([batch.column("vectors")[i].as_py()], dims), batch.column("ids")[i].as_py()
                own = (x * x).sum(1)
                scores = q[reach] @ x.T
                if len(x) > need:
                    cut = -np.partition(-scores, need - 1, axis=1)[:, need - 1]
                else:
                    cut = np.full(len(reach), -np.inf)
                rows, columns = np.nonzero(scores >= np.maximum(cut, beats[reach])[:, None])
                # of vectors at equal scores, those with the smallest ids: a vector before another has a row before all of its rows
                smallest = np.array([np.iinfo(np.int64).max if i[0] is None else i[0] for i in ids])
                order = np.lexsort((smallest[columns], -scores[rows, columns], rows))
                rows, columns = rows[order], columns[order]
                begins = np.searchsorted(rows, rows)
                few = np.arange(len(rows)) - begins < need
                rows, columns = rows[few], columns[few]
                value = scores[rows, columns]
                same = (value == squares[reach[rows]]) & (value == own[columns])
                qids = np.array(r["qids"], np.int64)[reach[rows]]
                counts = np.array([len(ids[c]) for c in columns.tolist()], np.int64)
                out = {"qid": np.repeat(qids, counts), "score": np.repeat(value, counts).astype(np.int64),
                       "id": [i for c in columns.tolist() for i in ids[c]], "same": np.repeat(same, counts)}
                yield pa.record_batch([pa.array(out["qid"], pa.int64()), pa.array(out["score"], pa.int64()), pa.array(out["id"], pa.int64()),
                                       pa.array(out["same"], pa.bool_())], names=["qid", "score", "id", "same"])

    # a query is sent to up to 256 annuli, which no size estimate of the chunks knows of: without the hint they are sent to the driver and broadcast
    pairs = chunks.select(F.col("annulus").alias("of"), "qids", "beats", F.col("vectors").alias("queries")).hint("merge").join(
        index, F.col("of") == F.col("annulus")).select("annulus", "lo", "hi", "vectors", "ids", "qids", "queries", "beats")
    return pairs.mapInArrow(best, "qid long, score long, id long, same boolean")


def _best(found: DataFrame, need: int) -> DataFrame:
    order = Window.partitionBy("qid").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("same").desc())
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= need)


def top_k(vectors: DataFrame, is_query: Column, k: int = K, scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding",
          pivots: int = PIVOTS, sample: int = SAMPLE) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` highest inner products of every row that ``is_query`` marks.

    Components count as floor(scale * x). Candidates are all rows but the query's own; ties go to the smaller id, a null
    id comes last. Fewer candidates give fewer rows. Vectors that are null or empty, or hold a null or non-finite component,
    take no part; vectors of different lengths do not meet, each length is searched for itself. Rows that repeat an id or a
    vector are candidates of each other, and each query row has a result of its own. Columns that are not named are not read.
    An empty table gives an empty result. Components of 2**31 / scale or more, or squared norms of 2**53, raise an
    error, as the products would not be exact.
    """
    taken = vectors.select(F.col(id_col).cast("long").alias("id"), F.coalesce(is_query, F.lit(False)).alias("query"),
                           F.col(vector_col).alias("vector")).where(kept(F.col("vector")))
    rows = written(taken.mapInArrow(_integers(scale), "id long, query boolean, v binary, square double"), "topk-rows")
    lengths = [r.bytes for r in rows.groupBy(F.octet_length("v").alias("bytes")).count().where("count > 1").orderBy("bytes").collect()]
    found = [_of_length(rows.where(F.octet_length("v") == n), n // 4, k, pivots, sample) for n in lengths]
    out = found[0] if found else rows.limit(0).select(F.col("id").alias("query_id"), F.lit(0).alias("rank"), "id", F.lit(0).cast("long").alias("score"))
    for more in found[1:]:
        out = out.unionByName(more)
    return out.withColumnRenamed("id", id_col)


def _of_length(rows: DataFrame, dims: int, k: int, pivots: int, sample: int) -> DataFrame:
    need = k + 1
    copies = Window.partitionBy("v").orderBy(F.col("id").asc_nulls_last())
    distinct = written(rows.select("v", "id", "square").withColumn("place", F.row_number().over(copies)).where(F.col("place") <= need)
                       .groupBy("v").agg(F.sort_array(F.collect_list(F.struct(F.col("id").isNull().alias("none"), "id"))).alias("ids"),
                                         F.max("square").alias("square"))
                       .select("v", "square", F.col("ids.id").alias("ids"), F.size("ids").cast("long").alias("n")), "topk-vectors")
    largest = distinct.agg(F.max("square")).first()[0]
    # written first: collecting a limit sends each task's rows to the driver, a sample for every partition
    drawn = written(distinct.orderBy(F.xxhash64("v"), "v").limit(sample).select("v"), "topk-sample").orderBy(F.xxhash64("v"), "v").collect()
    space = Space(choose_pivots(_matrix([bytes(r.v) for r in drawn], dims), pivots), largest)

    keyed = "annulus int, distance double, v binary, ids array<long>, n long"
    quantiles = [i / RINGS for i in range(1, RINGS)]
    cut = distinct.mapInArrow(_annuli(space, dims, None), keyed).groupBy("annulus").agg(F.percentile_approx("distance", quantiles, 1000).alias("cuts"))
    cuts = np.zeros((len(space.pivots), RINGS - 1))
    for r in cut.collect():  # a row per pivot
        cuts[r.annulus // RINGS] = r.cuts
    placed = distinct.mapInArrow(_annuli(space, dims, cuts), keyed)
    # the bounds of the ranges come from rows that are sent to the driver: a hash breaks ties there, not the vector
    index = written(placed.repartitionByRange("annulus", "distance", F.xxhash64("v")).sortWithinPartitions("annulus", "distance", "v")
                    .mapInArrow(_gathered(["annulus", "distance", "v", "ids"], BLOCK, _block_row), INDEX), "topk-index")
    counted = index.groupBy("annulus").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"),
                                           F.sum(F.aggregate("ids", F.lit(0).cast("long"), lambda n, x: n + F.size(x))).alias("n"))
    directory = Directory(counted.collect())  # a row per annulus

    asked = rows.where("query")
    queries = written(asked.select("v").distinct().select(F.monotonically_increasing_id().alias("qid"), "v", F.lit(float("-inf")).alias("beat")), "topk-queries")
    first = written(_best(_searched(space, index, _chunks(space, directory, queries, dims, need, False), dims, need), need).drop("place"), "topk-first")
    beat = first.groupBy("qid").agg(F.count("*").alias("n"), F.min("score").cast("double").alias("least")).where(F.col("n") >= need).select(
        F.col("qid").alias("of"), "least")
    expanding = queries.join(beat, F.col("qid") == F.col("of"), "left").select("qid", "v", F.coalesce("least", "beat").alias("beat"))
    rest = _searched(space, index, _chunks(space, directory, expanding, dims, need, True), dims, need)
    lists = _best(first.unionByName(rest), need).groupBy("qid").agg(F.array_sort(F.collect_list(F.struct("place", "id", "score", "same"))).alias("list"))

    of_vector = queries.select("qid", F.col("v").alias("of_v")).join(lists.withColumnRenamed("qid", "of"), F.col("qid") == F.col("of")).select("of_v", "list")
    joined = asked.select(F.col("id").alias("query_id"), "v").join(of_vector, F.col("v") == F.col("of_v"))
    own = F.get(F.expr("filter(list, x -> x.same and x.id <=> query_id)"), F.lit(0))["place"]  # null: its copies of smaller ids fill the list
    others = F.slice(F.filter("list", lambda x: F.coalesce(x["place"] != own, F.lit(True))), 1, k)
    return joined.select("query_id", F.posexplode(others).alias("at", "hit")).select(
        "query_id", (F.col("at") + 1).alias("rank"), F.col("hit.id").alias("id"), F.col("hit.score").alias("score"))
