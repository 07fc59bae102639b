"""Word vectors, pooled features and scores against a plain version that looks at one word at a time."""

from __future__ import annotations

import math
from itertools import groupby
from zlib import crc32

import numpy as np
import pytest
from fixtures import LONG, documents, prose, rows

from eventlake.llm import quality

TEXTS = ["", None, "one", "a b a b a", "Émile, dit: «non»!! $$", "x\n\n y\tz  z z", "___ 12ab--cd", " ", prose(1, 80), prose(2, 40) * 2, "a b a b a"]


def plain_words(text):
    """Bucket of each run of word bytes or of other signs."""

    def kind(byte):
        if byte in b" \t\n\r\v\f":
            return 0
        return 1 if byte > 127 or chr(byte).isalnum() else 2

    found = []
    for sort, run in groupby(text.encode(), kind):
        if sort:
            total = sum((byte + 1) * int(quality._POWERS[i & 255]) for i, byte in enumerate(run))
            found.append((total * int(quality._MIX) % 2**64) >> 51)
    return found


def plain_index():
    table = [[0.0] * quality.SIZE for _ in range(quality.BUCKETS)]
    for bucket in range(quality.BUCKETS):
        for place, sign in zip(quality._PLACES[bucket], quality._SIGNS[bucket]):
            table[bucket][place] += sign
    return table


def plain_vectors(texts, index):
    """Each bucket's neighbours' index vectors added up, at length one."""
    total = {}
    for text in texts:
        found = plain_words(text or "")
        for i, word in enumerate(found):
            for j in range(max(0, i - quality.WINDOW), min(len(found), i + quality.WINDOW + 1)):
                if j != i:
                    row = total.setdefault(word, [0.0] * quality.SIZE)
                    total[word] = [a + b for a, b in zip(row, index[found[j]])]
    return {word: [x / max(1e-9, math.hypot(*row)) for x in row] for word, row in total.items()}


def plain_features(text, vectors, index):
    found = plain_words(text or "")
    n = max(1, len(found))
    context = [sum(vectors.get(w, [0.0] * quality.SIZE)[i] for w in found) / n for i in range(quality.SIZE)]
    own = [sum(index[w][i] for w in found) / n for i in range(quality.SIZE)]
    again = [sum(a == b for a, b in zip(found, found[step:])) / n for step in range(1, quality.WINDOW + 1)]
    return context + own + again + [math.log(1 + len(found))]


def plain_score(x, net):
    z = [min(8, max(-8, (a - m) / s)) for a, m, s in zip(x, net.mean, net.scale)]
    hidden = [max(0.0, sum(a * w for a, w in zip(z, column)) + b) for column, b in zip(net.w1.T, net.b1)]
    odds = sum(h * w for h, w in zip(hidden, net.w2)) + net.b2
    return 1 / (1 + math.exp(-min(60, max(-60, odds / net.temperature))))


@pytest.fixture(scope="module")
def index():
    return plain_index()


def test_words(index):
    assert np.array_equal(quality.index_vectors(), index)
    whole = [t for t in TEXTS if t is not None]
    bucket, of = quality.words([t.encode() for t in whole])
    assert [bucket[of == i].tolist() for i in range(len(whole))] == [plain_words(t) for t in whole]


def test_vectors_and_features(spark, index):
    table = documents(spark, [(i, t, None, None, None) for i, t in enumerate(TEXTS)]).repartition(3)
    found = quality.word_vectors(table)
    expected = plain_vectors(TEXTS, index)
    assert set(np.flatnonzero(found.any(axis=1))) == {w for w, row in expected.items() if any(row)}
    assert all(np.allclose(found[w], row, atol=1e-5) for w, row in expected.items())
    both = np.concatenate([found, quality.index_vectors()], axis=1)
    pooled = quality.features([t if t is None else t.encode() for t in TEXTS], both)
    assert np.allclose(pooled, [plain_features(t, expected, index) for t in TEXTS], atol=1e-4)


def test_scores(spark, index):
    """Every score is the plain one under the fitted network, a long text's too."""
    texts = [*TEXTS, LONG, *(prose(i, 30) if i % 3 else prose(i, 30).upper() + "$$" * 9 for i in range(60))]
    table = documents(spark, [(i, t, None, None, None) for i, t in enumerate(texts)])
    known = spark.createDataFrame([(i, int(i % 2 > 0), 0) for i in range(len(texts))], "doc_id bigint, quality int, toxic int")
    scorer, vectors = quality.learn(table, known), plain_vectors(texts, index)
    found = rows(quality.predict_quality(table, known))
    assert len(found) == len(texts)
    for key, held, score, predicted in found:
        assert score == pytest.approx(plain_score(plain_features(texts[key], vectors, index), scorer.network), abs=1e-3)
        assert held == (crc32(str(key).encode()) % 5 == 0) and predicted == (score >= quality.THRESHOLD)


def test_temperature_fits_the_rows_held_back():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 5))
    y = (x[:, 0] + 0.3 * rng.normal(size=400) > 0).astype(float)
    held = np.arange(400) % 5 == 0
    net = quality.fit(x, y, held)
    odds, truth = net.odds(x[held]), y[held]

    def loss(temperature):
        chances = [1 / (1 + math.exp(-o / temperature)) for o in odds]
        return -sum(math.log(p if t else 1 - p) for p, t in zip(chances, truth))

    assert all(loss(net.temperature) <= loss(c) + 1e-9 for c in np.geomspace(0.25, 8, 60))
    assert ((net.scores(x[held]) > 0.5) == truth).mean() > 0.7
