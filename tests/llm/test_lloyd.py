import numpy as np
import pytest

from blendwise.llm import lloyd as L


def brute(points, entries):
    d = ((points[:, None].astype(object) - entries[None]) ** 2).sum(2)
    return np.array([min(range(len(entries)), key=lambda j: (row[j], j)) for row in d])


def codebooks(x, n_entries, rounds):
    """Plain Lloyd over the rows of x (n, parts, width), which stand in the order of their ids."""
    books = [x[:n_entries, p].copy() for p in range(x.shape[1])]
    for _ in range(rounds):
        for p, book in enumerate(books):
            codes = brute(x[:, p], book)
            for j in set(codes.tolist()):
                own = x[codes == j, p]
                book[j] = [sum(map(int, c)) // len(own) for c in own.T]
    codes = np.stack([brute(x[:, p], b) for p, b in enumerate(books)], axis=1)
    error = sum(((x[:, p] - b[codes[:, p]]) ** 2).sum(1) for p, b in enumerate(books))
    return codes, error, np.stack(books)


@pytest.mark.parametrize("n", [1, 2, 31, 33, 500])
@pytest.mark.parametrize("spread", [0, 1, 1000])
def test_tree_assignment_equals_brute_force(n, spread):
    rng = np.random.default_rng(n + spread)
    centres = rng.integers(-5000, 5000, (6, 4))
    points = centres[rng.integers(0, 6, n)] + rng.integers(-spread, spread + 1, (n, 4))
    for k in (1, 2, 3, 7, 16):
        entries = np.concatenate([points, points])[:k] if k == 7 else rng.integers(-3, 3, (k, 4)) * 1000
        tree = L.Tree.over(points, 4)
        tree = L.Tree.unpacked(tree.packed(), n, 4)
        want = brute(points, entries)
        assert (L.nearest(tree, entries, each=True) == want).all()
        counts, sums = L.nearest(tree, entries)
        assert (counts == np.bincount(want, minlength=len(entries))).all()
        for j in range(len(entries)):
            assert (sums[j] == points[want == j].sum(0)).all()


def test_whole_nodes_are_assigned_without_their_points():
    rng = np.random.default_rng(1)
    points = np.concatenate([rng.integers(-10, 10, (512, 4)) + 10_000 * i for i in range(4)])
    tree = L.Tree.over(points, 8)
    tree.points = None  # would be read by a leaf
    counts, _ = L.nearest(tree, np.array([[10_000 * i] * 4 for i in range(4)]))
    assert counts.tolist() == [512] * 4


def frame(spark, rows, kind="array<float>"):
    return spark.createDataFrame(rows, f"vec_id long, embedding {kind}, label int, code int, error int, id int, ids int, trees int, n int")


def test_awkward_rows(spark):
    rng = np.random.default_rng(3)
    good = [(i, [float(np.float32(v)) for v in rng.normal(size=8)], None if i % 3 else i % 2) for i in range(70)]
    good += [(5, good[5][1], 1), (5, good[5][1], 1), (None, good[7][1], None)]
    bad = [(100, None, 1), (-1, [None] + [0.5] * 7, 1), (-2, [float("nan")] + [0.5] * 7, 1), (-3, [float("inf")] * 8, 1), (-4, [], 1), (200, [1.0] * 9, 1)]
    df = frame(spark, [(*r, 1, 2, 3, 4, 5, 6) for r in good + bad]).repartition(3)
    coded, books = L.product_codes(df, parts=4, entries=5, rounds=3, scale=64, block=16, leaf=4)
    assert coded.columns == ["vec_id", "code", "error", "label", "label_error"]
    order = sorted(good, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    x = np.floor(np.array([r[1] for r in order], np.float64) * 64).astype(np.int64).reshape(-1, 4, 2)
    codes, error, want = codebooks(x, 5, 3)
    assert (books == want).all()
    totals = {}
    for r, e in zip(order, error):
        totals[r[2]] = totals.get(r[2], 0) + int(e)
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:3], str(r[3]))
    assert sorted(((r.vec_id, r.code, r.error, r.label, r.label_error) for r in coded.collect()), key=key) == sorted(
        ((r[0], c.tolist(), int(e), r[2], totals[r[2]]) for r, c, e in zip(order, codes, error)), key=key)


def test_few_and_no_vectors(spark):
    rows = [(1, [1.0] * 8, 1, 0, 0, 0, 0, 0, 0)]
    coded, books = L.product_codes(frame(spark, rows))
    assert books.shape == (8, 1, 1) and [r.error for r in coded.collect()] == [0]
    coded, books = L.product_codes(frame(spark, []))
    assert books.shape[1] == 0 and coded.count() == 0


def test_one_vector_holds_most_rows(spark):
    rows = [(i, [0.25] * 8 if i % 3 else [i / 7.0] * 8, 4, 0, 0, 0, 0, 0, 0) for i in range(300)]
    coded, books = L.product_codes(frame(spark, rows, "array<double>"), entries=4, block=50)
    x = np.floor(np.array([r[1] for r in rows]) * 4096).astype(np.int64).reshape(-1, 8, 1)
    codes, error, want = codebooks(x, 4, 6)
    assert (books == want).all()
    assert sorted((r.vec_id, r.code, r.error) for r in coded.collect()) == [(i, c.tolist(), int(e)) for i, (c, e) in enumerate(zip(codes, error))]
