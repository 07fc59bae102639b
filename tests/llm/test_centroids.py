"""Integer k-means against a plain version, and the search against measuring every centroid."""

from __future__ import annotations

import random
from hashlib import sha256
from math import floor, inf, isfinite, nan

import numpy as np
import pytest
from fixtures import rows

from eventlake.llm import centroids

SCHEMA = "vec_id bigint, embedding array<float>, cluster string, key string, v int"
LONG = 2**63 - 1


def table(spark, vectors, kind="float"):
    """Vectors with three further columns whose names clash with results."""
    schema = SCHEMA.replace("float", kind)
    return spark.createDataFrame([(key, v, "x", "y", 1) for key, v in vectors], schema).repartition(5)


def plain(vectors, size, k=8, rounds=10):
    """The same by loops over Python's integers."""
    kept = [
        (key, [floor(1024 * x) for x in v])
        for key, v in vectors
        if v is not None and len(v) == size and all(x is not None and isfinite(x) for x in v)
    ]
    hashed = sorted((sha256(f"3:{key}".encode()).hexdigest(), v) for key, v in kept if key is not None)
    middle = [v for _, v in hashed[:k]]
    apart = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda v: min((apart(v, c), i) for i, c in enumerate(middle))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        middle = [[sum(x) // len(groups[i]) for x in zip(*groups[i])] if i in groups else c for i, c in enumerate(middle)]
    found = [(key, near(v)[1], near(v)[0]) for key, v in kept] if middle else []
    inertia = {i: sum(d for _, c, d in found if c == i) for _, i, _ in found}
    digest = [sha256(",".join(map(str, c)).encode()).hexdigest() for c in middle]
    total = sum(inertia.values())
    return [(key, i, min(LONG, d), min(LONG, inertia[i]), min(LONG, total), digest[i]) for key, i, d in found]


def same(found, wanted):
    order = lambda r: (r[0] is None, *map(str, r))
    assert sorted(rows(found), key=order) == sorted(wanted, key=order)


def test_equals_the_plain_version(spark):
    rng = random.Random(5)
    vectors = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(300)]
    vectors += [(i, [0.25] * 6) for i in range(300, 400)]  # A group of copies, ties and all.
    vectors += [(7, [1.0] * 6), (7, [1.0] * 6), (None, [0.5] * 6)]
    vectors = [(key, np.array(v, np.float32).tolist()) for key, v in vectors]
    same(centroids.cluster(table(spark, vectors), dimensions=6), plain(vectors, 6))


def test_vectors_that_take_no_part(spark):
    odd = [(1, None), (2, []), (3, [1.0, 2.0]), (4, [1.0, None, 2.0]), (5, [1.0, nan, 2.0]), (6, [1.0, inf, 2.0])]
    vectors = [*odd, (7, [1.0, 2.0, 3.0]), (8, [-1.0, -2.0, -0.001])]
    same(centroids.cluster(table(spark, vectors), dimensions=3), plain(vectors, 3))
    for left in (odd, []):
        found = centroids.cluster(table(spark, left), dimensions=3)
        assert rows(found) == [] and found.columns[0] == "vec_id"


def test_no_key_starts_a_centroid(spark):
    assert rows(centroids.cluster(table(spark, [(None, [1.0, 2.0])]), dimensions=2)) == []


def test_values_beyond_64_bits(spark):
    vectors = [(1, [3e9, -4e9]), (2, [3e9, 4e9]), (3, [-2e12, 5.0]), (4, [1.0, 1.0]), (5, [2.0, 1.0])]
    same(centroids.cluster(table(spark, vectors, "double"), dimensions=2, k=2), plain(vectors, 2, k=2))
    huge = centroids.cluster(table(spark, [(1, [1e300, 0.0]), (2, [0.0, 0.0])], "double"), dimensions=2, k=1)
    assert max(r[2] for r in rows(huge)) == LONG


@pytest.mark.parametrize("size", [1, 3, 40])
@pytest.mark.parametrize("spread", [3, 2000, 2**20, 2**40])
def test_search_equals_measuring_every_centroid(size, spread):
    rng = np.random.default_rng(size * spread)
    x = rng.integers(-spread, spread + 1, (400, size))
    c = np.concatenate([rng.integers(-spread, spread + 1, (30, size)), x[:5], x[:5]])
    number, squared = centroids.nearest(x, c)
    wide = x.astype(object)[:, None] - c.astype(object)[None]
    all_of_them = (wide * wide).sum(axis=2)
    assert squared.tolist() == all_of_them.min(axis=1).tolist()
    assert number.tolist() == [row.index(min(row)) for row in all_of_them.tolist()]


def test_bounds_spare_centroids(monkeypatch):
    """With means far apart, a vector is measured against few centroids."""
    rng = np.random.default_rng(1)
    c = np.repeat(np.arange(200)[:, None] * 1000, 8, axis=1)
    x = c[rng.integers(0, 200, 1000)] + rng.integers(-50, 50, (1000, 8))
    looked = []
    maximum = np.maximum
    monkeypatch.setattr(centroids.np, "maximum", lambda a, b, *m: looked.append(np.size(b)) or maximum(a, b, *m))
    centroids.nearest(x, c)
    assert sum(looked) < 200 * 1000 / 10
