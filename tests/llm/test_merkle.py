import hashlib
import zlib

import pytest
from helpers import AWKWARD, EXTRA, SCHEMA, documents
from pyspark.sql import functions as F

from blendwise.llm import merkle as M


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return digest(*["-" if row[c] is None else f"{len(str(row[c]).encode())}:{row[c]}" for c in M.FIELDS])


def tree(nodes):
    """(root, siblings of each leaf level by level as (left, right)) by a plain loop."""
    steps = [[] for _ in nodes]
    owners = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        new, new_owners = [], []
        for lo in range(0, len(nodes), 3):
            run = nodes[lo:lo + 3]
            for i, own in enumerate(owners[lo:lo + 3]):
                for o in own:
                    steps[o].append(("".join(run[:i]), "".join(run[i + 1:])))
            new.append(digest(*run))
            new_owners.append([o for own in owners[lo:lo + 3] for o in own])
        nodes, owners = new, new_owners
    return nodes[0], steps


def brute(rows):
    by = {}
    for r in rows:
        by.setdefault(r["source"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    subs = {s: tree([x[2] for x in sorted(by[s])]) for s in order}
    root, above = tree([subs[s][0] for s in order])
    return in_order((x[1] if x[0] else None, x[2], subs[s][0], root, tuple(subs[s][1][i] + above[k]))
                    for k, s in enumerate(order) for i, x in enumerate(sorted(by[s])))


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1:]))


def got(df):
    return in_order((r.doc_id, r.leaf, r.subroot, r.root, tuple((s.left, s.right) for s in r.steps)) for r in df.collect())


@pytest.mark.parametrize("digits", [1, 2, 6])
@pytest.mark.parametrize("sizes", [(1,), (40, 1, 9, 28), (3, 3, 3, 3)])
def test_tiers_equal_a_plain_tree(spark, sizes, digits):
    rows = [(i * 7 % 101, f"text {i}\n", "en", f"s{k}" if k else None, i) for k, n in enumerate(sizes) for i in range(n)]
    df = spark.createDataFrame(rows, SCHEMA)
    result = M.manifest(df, digits=digits)
    assert got(result) == brute([r.asDict() for r in df.collect()])
    assert result.where(M.fold(F.col("leaf"), F.col("steps")) != F.col("root")).count() == 0


def test_awkward_rows_and_clashing_names(spark):
    clash = EXTRA | dict(tree="t", rank=1, size=2, block=3, h="h", kids="k", steps="s", leaf="l", id=4, salt=5, offset=6, at=7, also_x=8, d0=9, root="r")
    df = documents(spark, AWKWARD, **clash)
    result = M.manifest(df, also={"x": F.lit(1)})
    assert got(result) == brute([r.asDict() for r in df.collect()])
    assert result.columns[-1] == "x" and M.manifest(df.limit(0)).count() == 0


def test_a_hot_group_and_one_repeated_id(spark):
    rows = [(5, "same", "en", "hot", 4)] * 400 + [(i, f"t{i}", "en", f"s{i % 3}", 2) for i in range(60)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert got(M.manifest(df, digits=2)) == brute([r.asDict() for r in df.collect()])


def test_query_finds_tampering(spark):
    from blendwise.llm.queries import op12_merkle_manifest
    found = op12_merkle_manifest(spark, "/root/testdata/sf0.001").collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert len(found) == len(texts) and len({r.root for r in found}) == 1
    for r in found:
        changed = zlib.crc32(str(r.doc_id).encode()) % 2 == 0 and "\n" in (texts[r.doc_id] or "")
        assert r.verified is not changed and (r.folded_root == r.root) == r.verified
