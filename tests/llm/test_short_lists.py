"""Queries that find too little within the fitted radius."""

from __future__ import annotations

import numpy as np
from fixtures import rows

from eventlake.llm import mih


def table(spark, x):
    return spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")


def test_an_outlier_among_dense_clusters_gets_its_list(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(20, 32))
    x = centres[rng.integers(0, 20, 800)] + rng.normal(scale=1e-4, size=(800, 32))
    x[0] = -centres.mean(axis=0) - 3 * centres[0]
    found = rows(mih.mih_search(table(spark, x), every=100))
    assert sorted(r[:2] for r in found) == [(q, rank) for q in range(0, 800, 100) for rank in range(1, 11)]
    assert all(score == np.sqrt(((x[key] - x[q]) ** 2).sum()) for q, _, key, score in found)


def test_few_vectors_are_all_candidates(spark):
    x = np.random.default_rng(5).normal(size=(9, 32))
    found = sorted(rows(mih.mih_search(table(spark, x), every=2)))
    for q in range(0, 9, 2):
        exact = sorted((float(np.sqrt(((v - x[q]) ** 2).sum())), i) for i, v in enumerate(x) if i != q)
        assert [r[2] for r in found if r[0] == q] == [i for _, i in exact]
