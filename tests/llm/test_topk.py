import numpy as np
import pytest
from pyspark.sql import functions as F

from blendwise.llm import topk as K


def brute(rows, marked, k, scale):
    """rows: (id, vector); results of each marked row by plain loops."""
    usable = [(i, [int(np.floor(np.float64(v) * scale)) for v in x]) for i, x in rows
              if x and all(v is not None and np.isfinite(v) for v in x)]
    out = []
    for n, (i, q) in enumerate(usable):
        if marked(i):
            found = sorted(((-sum(a * b for a, b in zip(q, x)), j is None, j or 0) for m, (j, x) in enumerate(usable)
                            if m != n and len(x) == len(q)))[:k]
            out += [(i, r + 1, None if none else j, -s) for r, (s, none, j) in enumerate(found)]
    return sorted(out, key=str)


def frame(spark, rows, kind="array<float>", parts=3):
    names = "rank int, score int, id int, v int, ids int, n int, list int, place int, qid int, query int, annulus int"
    return spark.createDataFrame([(*r, *range(11)) for r in rows], f"vec_id long, embedding {kind}, {names}").repartition(parts)


def check(spark, rows, k=5, scale=64, every=10, **more):
    marked = lambda i: i is not None and i % every == 0
    found = K.top_k(frame(spark, rows), F.col("vec_id") % every == 0, k=k, scale=scale, **more)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute(rows, marked, k, scale)


def vectors(rng, n, dims, clusters, spread):
    centres = rng.normal(size=(clusters, dims))
    return [[float(np.float32(v)) for v in centres[rng.integers(clusters)] + spread * rng.normal(size=dims)] for _ in range(n)]


@pytest.mark.parametrize("clusters,spread", [(1, 1.0), (6, 0.05)])
def test_equals_brute_force(spark, clusters, spread):
    rng = np.random.default_rng(clusters)
    check(spark, list(enumerate(vectors(rng, 400, 6, clusters, spread))), pivots=8, sample=100)


def test_copies_ties_and_awkward_rows(spark):
    rng = np.random.default_rng(9)
    rows = list(enumerate(vectors(rng, 60, 4, 3, 0.3)))
    rows += [(1000 + i, [0.5] * 4) for i in range(40)]  # copies, some of them queries
    rows += [(2000 + i, [0.0] * 4) for i in range(30)]  # everything ties
    rows += [(10, [0.5] * 4), (10, [0.5] * 4), (20, rows[20][1]), (None, [0.5] * 4), (None, rows[3][1])]
    rows += [(30, None), (40, []), (50, [None, 1.0, 1.0, 1.0]), (60, [float("nan")] * 4), (70, [float("inf"), 0.0, 0.0, 0.0])]
    rows += [(80, [1.0, 2.0]), (90, [2.0, 1.0]), (110, [1.0] * 3)]
    check(spark, rows, pivots=4, sample=50)


def test_few_rows_and_no_rows(spark):
    check(spark, [(0, [1.0, 2.0]), (10, [2.0, 1.0]), (3, [1.0, 1.0])], k=10)
    check(spark, [(0, [1.0, 2.0])])
    check(spark, [])
    check(spark, [(1, [1.0, 2.0]), (2, [2.0, 1.0])])


def test_far_annuli_are_not_visited():
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.integers(-5, 5, (200, 3)) + c for c in ([1000, 0, 0], [0, 1000, 0], [0, 0, 1000])]).astype(float)
    largest = float((x * x).sum(1).max())
    space = K.Space(K.choose_pivots(x, 3), largest)
    far = space.vectors(x)
    nearest = far.argmin(1)
    for p in range(3):
        own = x[nearest == p]
        lo, hi = far[nearest == p, p].min(), far[nearest == p, p].max()
        for q in x[::50]:
            bound = space.bound(np.array([q @ q]), space.queries(q[None])[:, p], lo, hi)[0]
            best = (own @ q).max()
            assert bound >= best and (abs(best) < 100_000) == (bound < 500_000)


def test_chunks_are_not_sent_to_the_driver(spark):
    """A query goes to up to 256 annuli, so chunks are far larger than the estimate of the queries they come from."""
    rng = np.random.default_rng(5)
    space, directory = K.Space(np.eye(4), 4.0), K.Directory([])
    queries = spark.createDataFrame([(i, bytes(rng.integers(0, 9, 4).astype("<i4")), 0.0) for i in range(9)], "qid long, v binary, beat double")
    index = spark.createDataFrame([], K.INDEX)
    plan = K._searched(space, index, K._chunks(space, directory, queries, 4, 3, False), 4, 3)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_samples_at_the_driver_hold_no_vectors(spark):
    rng = np.random.default_rng(6)
    seen, by_range = [], type(spark.range(0)).repartitionByRange
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(type(spark.range(0)), "repartitionByRange", lambda self, *cols: seen.append(self.select(*cols).dtypes) or by_range(self, *cols))
        check(spark, list(enumerate(vectors(rng, 60, 4, 3, 0.5))))
    assert len(seen) == 3 and "binary" not in {kind for columns in seen for _, kind in columns}
