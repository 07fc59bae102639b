"""Byte models against their definition, and the classifiers on awkward and held-out rows."""

from __future__ import annotations

from collections import Counter
from math import log2

import numpy as np
import pytest
from fixtures import AWKWARD, LONG, documents, prose, rows

from eventlake.llm import grams, language, quality, urls


@pytest.mark.parametrize("blended", [False, True])
def test_code_lengths(blended, monkeypatch):
    monkeypatch.setattr(grams, "_STEP", 7)
    classes = [[b"abracadabra", b"xyz"], [b"banana band", b""], []]
    texts = [b"abrab zzb", b"", b"ana", b"\xff\x00abra"]
    model = grams.ByteModel(classes, 2, blended)

    def probability(texts, context, byte, k):
        if k < 0:
            return 1 / 256
        seen = Counter()
        for text in (b"\n\n" + t for t in texts):
            seen.update(text[i] for i in range(2, len(text)) if text[i - k : i] == context[2 - k :])
        n, d = sum(seen.values()), len(seen)
        if not n:
            return probability(texts, context, byte, k - 1)
        escaped = d / (n + d) * probability(texts, context, byte, k - 1)
        return seen[byte] / (n + d) + escaped * blended if seen[byte] else escaped

    padded = [b"\n\n" + t for t in texts]
    expected = [
        [sum(-log2(probability(c, p[i : i + 2], p[i + 2], 2)) for i in range(len(p) - 2)) for c in classes] for p in padded
    ]
    assert np.allclose(model.bits(texts), expected, atol=1e-5)


def test_lookup_finds_what_it_holds():
    codes = np.unique(np.random.default_rng(0).integers(0, 5000, 3000, dtype=np.uint64))
    found = grams.Lookup(codes).find(np.arange(5000, dtype=np.uint64))
    assert {int(c) for c in codes} == set(np.flatnonzero(found >= 0).tolist())
    assert (codes[found[found >= 0]] == np.flatnonzero(found >= 0)).all()


def test_letters():
    yes, no = ["a", "1é", "日本", "___x"], [None, "", "12 !\n", "٣", "😀"]
    assert all(language.has_letters(t.encode()) for t in yes)
    assert not any(language.has_letters(t and t.encode()) for t in no)


def test_language(spark):
    letters = {"aa": "abcdefgh", "bb": "efghijkl", "cc": "opqrstuv"}
    data = [(i, prose(i, 40, letters[lang]), lang, None, None) for i, lang in enumerate(list(letters) * 40)]
    found = {r[0]: r[1:4] for r in rows(language.predict_languages(documents(spark, data + [(500, "xyz", None, None, 3)])))}
    held = [i for i in range(120) if found[i][0]]
    assert 20 < len(held) < 60
    assert sum(found[i][1] == data[i][2] for i in held) >= 0.98 * len(held)
    assert all(0 <= score <= 1 for _, _, score in found.values())


def test_language_awkward_and_empty(spark):
    found = rows(language.predict_languages(documents(spark)))
    assert len(found) == len(AWKWARD)
    by = {}
    for key, held, pred, score, _ in found:
        by.setdefault(key, []).append((held, pred, score))
    assert [by[k][0][1:] for k in (1, 2, 6, 8)] == [("und", 0.0)] * 4
    assert by[None][0][0] is False
    assert len(set(by[4])) == 1
    assert rows(language.predict_languages(documents(spark, []))) == []
    nothing = documents(spark, [(1, "abc", None, None, 3)])
    assert [r[2:4] for r in rows(language.predict_languages(nothing))] == [("und", 0.0)]


def labels(spark, data):
    return spark.createDataFrame(data, "doc_id bigint, quality int, toxic int, score string")


def test_quality_held_out(spark):
    data = []
    for i in range(300):
        text = prose(i, 60)
        data.append((i, text if i % 3 else text.replace(" ", "$$$ ").upper(), None, None, None))
    known = labels(spark, [(i, int(i % 3 > 0), 0, "x") for i in range(300)])
    found = rows(quality.predict_quality(documents(spark, data), known))
    held = [(p, int(i % 3 > 0)) for i, h, _, p in found if h]
    assert len(found) == 300 and len(held) > 30
    assert sum(a == b for a, b in held) >= 0.95 * len(held)


def test_quality_awkward_and_empty(spark):
    known = labels(spark, [(2, 1, 0, "x"), (4, 0, 0, "x"), (4, 1, 0, "x"), (5, None, 0, "x"), (None, 1, 0, "x"), (7, 9, 0, "x")])
    found = rows(quality.predict_quality(documents(spark), known))
    assert sorted(str(r[0]) for r in found) == sorted(str(r[0]) for r in AWKWARD)
    assert all(0 <= score <= 1 and predicted == (score >= 0.3) for _, _, score, predicted in found)
    assert {r[2] for r in rows(quality.predict_quality(documents(spark), labels(spark, [])))} == {0.5}
    assert rows(quality.predict_quality(documents(spark, []), known)) == []


def test_long_texts_in_pieces():
    text = LONG.encode() * 20
    assert b"".join(quality.pieces(text)) == text
    table = np.concatenate([quality.index_vectors()] * 2, axis=1)
    whole, part = quality.features([text], table)[0], quality.features([LONG.encode()], table)[0]
    assert np.allclose(whole[: quality.SIZE], part[: quality.SIZE], atol=1e-4)


RULED = [
    ("http://a.net/x", "a.net", "/x", "net/", "block"),
    ("http://NET/x?y://z", "net", "/x", "net/", "block"),
    ("http://a.net", "a.net", "", None, None),
    ("https://www.Example.NET/en/1#t", "www.example.net", "/en/1", "example.net/en/", "allow"),
    ("x://example.com/de/", "example.com", "/de/", "example.com/de/", "block"),
    ("x://notexample.com/de/", "notexample.com", "/de/", None, None),
    ("x://a.org/fr/?q", "a.org", "/fr/", "org/fr/", "allow"),
    ("x://a.org/fr", "a.org", "/fr", None, None),
    ("x://a\nb/c", "a\nb", "/c", None, None),
    ("no scheme", "", "", None, None),
    ("", "", "", None, None),
    (None, "", "", None, None),
]


def pages(spark, urls_):
    data = [(i, u, "<html>", "x") for i, u in enumerate(urls_)]
    return spark.createDataFrame(data, "page_id bigint, url string, html string, rule string")


def test_url_rules(spark):
    found = sorted(rows(urls.filter_urls(pages(spark, [r[0] for r in RULED]))))
    for (_, host, path, rule, verdict), row in zip(RULED, found):
        assert row[1:4] == (host, path, rule)
        assert row[4] == verdict or verdict is None and row[4] in ("allow", "block")


def test_url_models(spark):
    good, bad = ([f"http://{w}.{t}/{i}" for i, w in enumerate(prose(s, 200, l).split())] for s, t, l in ((1, "org/fr", "abcd"), (2, "net", "vwxyz")))
    new = [f"http://{w}.edu/{i}" for i, w in enumerate(prose(3, 50, "abcd").split() + prose(4, 50, "vwxyz").split())]
    found = sorted(rows(urls.filter_urls(pages(spark, good + bad + new))))[400:]
    assert sum(r[4] == "allow" for r in found[:50]) >= 45
    assert sum(r[4] == "block" for r in found[50:]) >= 45


def test_urls_without_examples_and_empty(spark):
    assert {r[4:6] for r in rows(urls.filter_urls(pages(spark, ["http://a.edu/", None])))} == {("allow", None)}
    assert rows(urls.filter_urls(pages(spark, []))) == []
