"""The mix: its targets, its schedule and what it takes."""

from __future__ import annotations

from collections import Counter

from fixtures import documents, prose, rows

from eventlake.llm import mixing


def targets(sizes):
    """Share out by weight, cap, and share out the excess again until none is above."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    left, open_, out = sum(sizes.values()), set(names), {}
    while open_:
        share = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        over = {s for s in open_ if share[s] > 3 * sizes[s]}
        if not over:
            return out | share
        for s in over:
            out[s] = 3.0 * sizes[s]
            left -= out[s]
        open_ -= over
    return out


DATA = [(i, prose(i, 5 + i * 7 % 90), None, f"s{i % 7}" if i % 3 else "s0", None) for i in range(300)]
DATA += [(1000, "one", None, "tiny", 3), (1001, None, None, "none", 0), (1002, "a b c", None, None, 5)]
DATA += [(None, "x y", None, "s1", 3), (5, "x y", None, "s1", 3), (5, "x y", None, "s1", 3)]


def test_targets_and_taken(spark):
    found = rows(mixing.mixture(documents(spark, DATA), slot_words=16))
    assert len(found) == len(DATA)
    sizes = Counter()
    for _, text, _, source, _ in DATA:
        sizes[source] += len((text or "").split())
    expected, taken = targets(sizes), Counter()
    for _, source, size, source_size, target, took in found:
        assert source_size == sizes[source]
        assert abs(target - expected[source]) < 1e-6
        assert 0 <= took <= 3 * size
        taken[source] += took
    assert all(abs(taken[s] - expected[s]) <= 1 for s in sizes)


def test_slots_are_spread(spark):
    _, segments = mixing.mix(documents(spark, DATA), slot_words=16)
    by_slot = {}
    for row in segments.collect():
        by_slot.setdefault(row["slot"], set()).add(row["number"])
    assert all(len(numbers) == 1 for numbers in by_slot.values())
    order = [min(by_slot[slot]) for slot in sorted(by_slot)]
    half = Counter(order[: len(order) // 2])
    for number, n in Counter(order).items():
        assert abs(half[number] - n / 2) <= 2


def test_reruns_agree(spark):
    again = [sorted(map(str, rows(mixing.mixture(documents(spark, data))))) for data in (DATA, DATA[::-1])]
    assert again[0] == again[1]


def test_without_words_and_empty(spark):
    assert rows(mixing.mixture(documents(spark, [])) ) == []
    found = rows(mixing.mixture(documents(spark, [(1, None, None, "a", 0), (2, " ", None, None, 1)])))
    assert sorted(r[:2] + r[2:] for r in found) == [(1, "a", 0, 0, 0.0, 0), (2, None, 0, 0, 0.0, 0)]
