import random
from itertools import combinations

import pytest
import xxhash
from helpers import AWKWARD, EXTRA, documents

from blendwise.llm import simhash as S


def fingerprint(text, width):
    words = [w for w in __import__("re").split(rb"[\x20\x09-\x0d]+", (text or "").encode().lower()) if w]
    shingles = [b" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(ids, prints, radius):
    root = {i: i for i in range(len(ids))}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in combinations(range(len(ids)), 2):
        if bin(prints[i] ^ prints[j]).count("1") <= radius:
            root[find(i)] = find(j)
    groups = {}
    for i in root:
        groups.setdefault(find(i), []).append(ids[i])
    return [min((x for x in groups[find(i)] if x is not None), default=None) for i in range(len(ids))]


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_masks_cover_every_pair_of_the_radius(radius):
    masks = S.covering_masks(radius)
    assert len(masks) == 2 ** (radius + 1) - 1
    for d in range(radius + 1):
        for bits in combinations(range(0, 64, 1 if d < 3 else 3), d):
            flips = sum(1 << b for b in bits)
            assert any(m & flips == 0 for m in masks)


@pytest.mark.parametrize("radius,limit", [(2, 64), (2, 1), (3, 64), (3, 1), (1, 1), (0, 1)])
def test_links_have_the_components_of_all_pairs(spark, monkeypatch, radius, limit):
    monkeypatch.setattr(S, "PAIR_LIMIT", limit)
    rng = random.Random(radius)
    prints = set()
    for _ in range(12):
        x = rng.getrandbits(64)
        for _ in range(9):
            prints.add(x)
            for _ in range(rng.randint(1, 3)):
                x ^= 1 << rng.randrange(64)
    prints = sorted(prints)
    frame = spark.createDataFrame([(S._signed(p),) for p in prints], "fp long")
    edges = [tuple(r) for r in S.links(frame, radius).collect()]
    unsigned = lambda v: v & (1 << 64) - 1
    assert all(bin(unsigned(a) ^ unsigned(b)).count("1") <= radius for a, b in edges)
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        root[find(unsigned(a))] = find(unsigned(b))
    want = classes(prints, prints, radius)
    lowest = {}
    for p in prints:
        lowest.setdefault(find(p), []).append(p)
    assert [min(lowest[find(p)]) for p in prints] == want


def test_awkward_rows(spark):
    docs = documents(spark, AWKWARD, **EXTRA)
    rows = S.simhash_components(docs, 3, 2).collect()
    ids, prints = [i for i, _ in AWKWARD], [fingerprint(t, 3) for _, t in AWKWARD]
    want = sorted(zip(ids, map(S._signed, prints), classes(ids, prints, 2)), key=str)
    assert sorted(map(tuple, rows), key=str) == want
    assert S.simhash_components(docs.limit(0)).count() == 0
