"""SimHash against comparing all pairs in plain Python."""

from __future__ import annotations

import random
import re

import pytest
import xxhash
from fixtures import AWKWARD, LONG, documents, prose, rows

from eventlake.llm import simhash
from eventlake.llm.components import components


def plain_fingerprint(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints, radius):
    """Smallest key reachable, by trying all pairs."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= radius:
                root[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(prints):
        if key is not None:
            least[find(i)] = min(key, least.get(find(i), key))
    return [(key, f"{p:016x}", least.get(find(i))) for i, (key, p) in enumerate(prints)]


def test_awkward_rows_and_fingerprints(spark):
    found = rows(simhash.near_duplicates(documents(spark)))
    expected = plain_groups([(r[0], plain_fingerprint(r[1])) for r in AWKWARD], 2)
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(found, key=key) == sorted(expected, key=key)


@pytest.mark.parametrize("tile_rows", [4096, 3])
def test_links_of_random_fingerprints(spark, monkeypatch, tile_rows):
    monkeypatch.setattr(simhash, "TILE_ROWS", tile_rows)
    rng = random.Random(5)
    values = [0, (1 << 64) - 1]
    for _ in range(60):
        value = rng.getrandbits(64)
        for _ in range(rng.randint(1, 8)):
            values.append(value)
            value ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, 3)))
    values = sorted(set(values))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    table = spark.createDataFrame([(v,) for v in signed], "fingerprint bigint")
    roots = dict(rows(components(simhash.links(table))))
    of = {}
    for key, digits, group in plain_groups(list(enumerate(values)), 2):
        of.setdefault(group, set()).add(roots.get(signed[key], signed[key]))
    assert all(len(found) == 1 for found in of.values())
    assert len(set().union(*of.values())) == len(of)


def test_long_texts_are_hashed_whole():
    assert simhash.fingerprint(LONG.encode()) == plain_fingerprint(LONG).to_bytes(8, "big")
    text = prose(1, 70_000)
    assert simhash.fingerprint(text.encode()) == plain_fingerprint(text).to_bytes(8, "big")


def test_empty_table(spark):
    assert rows(simhash.near_duplicates(documents(spark, []))) == []
    assert rows(simhash.similar_texts(documents(spark, []))) == []


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 130)] + [(7, 7), (3, 2)]
    found = dict(rows(components(spark.createDataFrame(edges, "u bigint, v bigint"))))
    assert found == {i: 0 for i in range(51)} | {i: 100 for i in range(100, 130)}


@pytest.mark.parametrize("tile_rows", [1 << 15, 4])
def test_similar_texts(spark, monkeypatch, tile_rows):
    monkeypatch.setattr(simhash, "WIDE_TILE_ROWS", tile_rows)
    texts = []
    for group in range(12):
        words = prose(group, 300).split()
        for copy in range(4):
            changed = list(words)
            changed[40 + copy] = f"new{copy}"
            changed[200] = f"other{copy}"
            texts.append((4 * group + copy, " ".join(changed)))
    table = documents(spark, [(i, t, None, None, None) for i, t in texts] + [(None, "", None, None, 0)])
    found = {key: group for key, _, group in rows(simhash.similar_texts(table))}
    assert found == {i: i - i % 4 for i in range(48)} | {None: None}
