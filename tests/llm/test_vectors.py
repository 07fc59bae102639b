"""Vector searches against all distances and products."""

from __future__ import annotations

import numpy as np
import pytest
from fixtures import rows

from eventlake.llm import inner_products, mih, vectors

NAN, INF = float("nan"), float("inf")
AWKWARD = [
    (None, [1.0, 0.0]),
    (0, None),
    (100, [1.0, None]),
    (200, [NAN, 1.0]),
    (300, [INF, 1.0]),
    (400, [0.0, 0.0]),
    (500, [0.5, 0.5]),
    (500, [0.5, 0.5]),
    (501, [0.5, 0.5]),
    (502, [0.5, 0.5]),
    (503, [-0.25, 1.0]),
    (504, [1.0, 2.0, 3.0]),
    (600, [1.0, 2.0, 2.5]),
    (700, []),
]


def table(spark, data):
    return spark.createDataFrame(
        [(key, v, "x", 1) for key, v in data], "vec_id bigint, embedding array<double>, score string, v int"
    )


def many(n, d=16, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)) * rng.uniform(0.1, 3, (n, 1))
    x[n // 2 : n // 2 + n // 3] = x[0]  # one vector holds a third of all rows
    return [(i, [float(c) for c in v]) for i, v in enumerate(x)]


def best_products(data, every, k):
    whole = {key: [int(np.floor(256 * c)) for c in v] for key, v in data}
    out = []
    for q in (q for q in whole if q % every == 0):
        scored = [(-sum(a * b for a, b in zip(whole[q], w)), c) for c, w in whole.items() if c != q and len(w) == len(whole[q])]
        out += [(q, i + 1, c, -s) for i, (s, c) in enumerate(sorted(scored)[:k])]
    return sorted(out)


@pytest.mark.parametrize("tile", [4096, 64])
def test_norm_topk(spark, monkeypatch, tile):
    monkeypatch.setattr(vectors, "TILE_ROWS", tile)
    monkeypatch.setattr(vectors, "TILE_QUERIES", max(3, tile // 16))
    monkeypatch.setattr(inner_products, "LONGEST", 16)
    data = many(400)
    assert sorted(rows(inner_products.norm_topk(table(spark, data), every=20))) == best_products(data, 20, 5)


def test_norm_topk_awkward(spark):
    found = sorted(rows(inner_products.norm_topk(table(spark, AWKWARD), every=100)))
    usable = dict((k, v) for k, v in AWKWARD if k is not None and v is not None and k not in (100, 200, 300))
    assert found == best_products(list(usable.items()), 100, 5)


def test_huge_components_stay_exact():
    q, x = np.array([[2.0**40, 3.0]]), np.array([[2.0**40, 5.0], [1.0, 1.0], [2.0**10, 7.0]])
    assert inner_products.products(q, x).tolist() == [[2**63 - 1, 2**40 + 3, 2**50 + 21]]


@pytest.mark.parametrize("tile", [4096, 128])
def test_mih_recall_and_scores(spark, monkeypatch, tile):
    monkeypatch.setattr(vectors, "TILE_ROWS", tile)
    data = many(1500, seed=3)
    x = {key: np.array(v) for key, v in data}
    found = {}
    for q, rank, key, score in rows(mih.mih_search(table(spark, data), every=50)):
        assert score == np.sqrt(((x[key] - x[q]) ** 2).sum())
        found.setdefault(q, {})[rank] = (score, key)
    hits = total = 0
    for q in range(0, 1500, 50):
        exact = sorted((float(np.sqrt(((v - x[q]) ** 2).sum())), key) for key, v in x.items() if key != q)[:10]
        mine = [found[q][r] for r in range(1, 11)]
        assert mine == sorted(mine)
        hits += len({k for _, k in exact} & {k for _, k in mine})
        total += 10
    assert hits / total >= 0.9


def test_probing_finds_every_code_within_the_radius():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 256, (300, 4), dtype=np.uint8), rng.integers(0, 256, (40, 4), dtype=np.uint8)
    for radius in (0, 5, 11):
        assert (mih.within_radius(a, b, radius) == (mih.distances(b, a) <= radius)).all()


def test_mih_awkward(spark):
    found = sorted(rows(mih.mih_search(table(spark, AWKWARD), every=100)))
    assert [r[:3] for r in found] == [(500, 1, 501), (500, 2, 502), (500, 3, 503), (600, 1, 504)]


def test_empty_tables(spark):
    assert rows(mih.mih_search(table(spark, []))) == []
    assert rows(inner_products.norm_topk(table(spark, []))) == []
