"""Links of whole texts by the exact similarity of their shingles."""

from __future__ import annotations

import random

import numpy as np
import pytest
from fixtures import documents, rows

from eventlake.llm import simhash

#: Shingles in common and of each text's own.
CASES = [(4, 0, 1), (5, 1, 1), (12, 1, 2), (20, 5, 0), (27, 3, 4), (28, 3, 4), (40, 8, 8), (799, 100, 100), (800, 100, 100)]


def pair(rng, common, first, second):
    words = lambda n: [f"{rng.getrandbits(60):x}" for _ in range(n)]
    shared = words(common + 4)
    return " ".join(shared + words(first)), " ".join(shared + words(second))


def shingles(text):
    words = text.split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


@pytest.mark.parametrize("tile_rows", [1 << 15, 7])
def test_pairs_above_and_below_the_similarity(spark, monkeypatch, tile_rows):
    monkeypatch.setattr(simhash, "WIDE_TILE_ROWS", tile_rows)
    rng, texts = random.Random(11), []
    for case in CASES:
        for _ in range(20):
            texts += pair(rng, *case)
    table = documents(spark, [(i, t, None, None, None) for i, t in enumerate(texts)])
    found = {key: group for key, _, group in rows(simhash.similar_texts(table))}
    for i in range(0, len(texts), 2):
        a, b = shingles(texts[i]), shingles(texts[i + 1])
        assert (found[i] == found[i + 1]) == (5 * len(a & b) >= 4 * len(a | b)), CASES[i // 40]
        assert found[i] == i


def test_group_that_meets_in_one_text_only(spark):
    """Copies are alike to the original, hardly to each other; and nothing else may pull them in."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    texts = []
    for _ in range(60):
        copy = list(words)
        for place in rng.sample(range(5, 295), 6):
            copy[place] = f"x{rng.getrandbits(50)}"
        texts.append(" ".join(copy))
    texts.append(" ".join(words))
    table = documents(spark, [(i, t, None, None, None) for i, t in enumerate(texts)])
    found = {key: group for key, _, group in rows(simhash.similar_texts(table))}
    sets, root = [shingles(t) for t in texts], list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]) and root[i] != root[j]:
                old, new = max(root[i], root[j]), min(root[i], root[j])
                root = [new if r == old else r for r in root]
    assert found == dict(enumerate(root))


def unlike(n, common, own):
    """Texts that share ``common`` shingles and have ``own`` each."""
    shared = [f"w{i}" for i in range(common + 4)]
    return [" ".join(shared + [f"x{i}y{j}" for j in range(own)]) for i in range(n)]


@pytest.mark.parametrize("tile_rows, cell_bytes", [(1 << 15, 64 << 20), (300, 60_000)])
def test_large_group_below_the_similarity(spark, monkeypatch, tile_rows, cell_bytes):
    """2,000 texts, each pair at 0.75: no links, and the rows on the way are as many as the texts, not as the pairs."""
    monkeypatch.setattr(simhash, "WIDE_TILE_ROWS", tile_rows)
    monkeypatch.setattr(simhash, "CELL_BYTES", cell_bytes)
    counted = []
    flagged = simhash._flagged
    monkeypatch.setattr(simhash, "_flagged", lambda *a: counted.append(flagged(*a)) or counted[-1])
    texts = unlike(2000, 60, 10)
    texts += [texts[7] + " one", texts[1200] + " two three"]
    table = documents(spark, [(i, t, None, None, None) for i, t in enumerate(texts)])
    found = {key: group for key, _, group in rows(simhash.similar_texts(table))}
    assert found == {**{i: i for i in range(2000)}, 2000: 7, 2001: 1200}
    chunks = -(-len(texts) // tile_rows) + 1
    assert counted[0].count() <= 2 * chunks * len(texts)


def test_large_group_of_near_copies_and_long_texts(spark):
    long = " ".join(f"v{i}" for i in range(200_000))
    texts = [t + " end" for t in unlike(500, 95, 3)] + [long, long + " more", None, "", None]
    table = documents(spark, [(i, t, None, None, None) for i, t in enumerate(texts)])
    found = {key: group for key, _, group in rows(simhash.similar_texts(table))}
    assert found == {**dict.fromkeys(range(500), 0), 500: 500, 501: 500, 502: 502, 503: 502, 504: 502}


def test_links_of_a_row_are_those_of_measuring_all():
    rng = random.Random(8)
    for _ in range(50):
        base = rng.sample(range(10**6), 40)
        sets = [np.unique(rng.sample(base, rng.randint(30, 40)) + rng.sample(range(10**6, 2 * 10**6), rng.randint(0, 8))) for _ in range(60)]
        forest, mine = simhash.Forest(60), sets[0]
        forest.label = np.array([rng.randrange(12) for _ in range(60)])
        before = forest.label.copy()
        alike = [i for i, s in enumerate(sets) if 5 * len(np.intersect1d(mine, s)) >= 4 * len(np.union1d(mine, s))]
        found = simhash._alike(mine, np.arange(60), sets, forest, None, 0.8)
        assert set(found) <= set(alike)
        assert sorted(before[found]) == sorted({before[i] for i in alike})
        assert len({forest.label[i] for i in alike}) == 1
