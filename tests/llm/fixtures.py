"""Small tables with every awkward case, for the tests of this folder."""

from __future__ import annotations

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, size string"
LONG = "word " * 30_000
AWKWARD = [
    (1, None, "en", "a", None),
    (2, "", None, None, 0),
    (None, "the cat sat on the mat", "en", "a", 22),
    (4, LONG, "en", "b", len(LONG)),
    (4, LONG, "en", "b", len(LONG)),
    (5, "the cat sat on the mat", None, "a", 22),
    (6, "\t \n\x0b ", "fr", "", 5),
    (7, "日本語のテキスト 😀", "ja", "b", 10),
    (8, "12345 !!!", "en", "b", 9),
]


def documents(spark, rows=AWKWARD):
    """Documents with two further columns whose names clash with results."""
    return spark.createDataFrame([(*row, "x", "y") for row in rows], SCHEMA)


def prose(seed: int, words: int, letters: str = "abcdefgh") -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choices(letters, k=rng.randint(2, 6))) for _ in range(words))


def rows(df):
    return [tuple(row) for row in df.collect()]
