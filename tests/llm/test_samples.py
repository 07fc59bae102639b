"""Samples of texts where most rows are copies, or where single texts are long."""

from __future__ import annotations

from fixtures import prose

from pyspark.sql import functions as F

from eventlake.llm.common import LAST_SLOT, hash_slot, sample_texts, sampled_share

WANTED = 10_000


def table(spark, data):
    return spark.createDataFrame(data, "label string, text string")


def test_copies_do_not_shrink_the_sample(spark):
    data = [("a", prose(i, 20)) for i in range(400)] + 20_000 * [("a", prose(1000, 20))]
    found = sample_texts(table(spark, data), WANTED)["a"]
    assert len(found) == len(set(found))
    assert WANTED / 2 <= sum(map(len, found)) <= 2 * WANTED


def test_every_label_has_a_sample(spark):
    data = [(f"l{i}", prose(100 * i + j, 1400)[:9000]) for i in range(12) for j in range(40)]
    data += [("long", prose(9000 + j, 9000) + "\u00e9") for j in range(3)] + [("none", None), ("none", ""), (None, "x")]
    found = sample_texts(table(spark, data), WANTED)
    assert sorted(found) == sorted([f"l{i}" for i in range(12)] + ["long"])
    texts = {text.encode() for _, text in data if text}
    assert all(set(found[f"l{i}"]) <= texts for i in range(12))
    assert WANTED / 2 <= sum(map(len, found["long"])) <= 4 * WANTED
    assert all(any(piece in text for text in texts) for piece in found["long"])


def test_shares_are_bounded_at_every_size(spark):
    for rows in (10, 10**6, 10**9, 10**12, 10**18):
        for wanted in (5000, 1 << 20):
            share = sampled_share(rows, wanted)
            kept = rows * (share + 1) / 2**63
            assert share == LAST_SLOT if rows <= wanted else wanted - 1 <= kept <= wanted + 1
    places = spark.range(20_000).select(hash_slot(F.col("id")).alias("p"))
    low, high, mean = places.agg(F.min("p"), F.max("p"), F.avg("p")).first()
    assert 0 <= low < 2**50 and 2**62 < high <= LAST_SLOT and abs(mean / 2**62 - 1) < 0.03
