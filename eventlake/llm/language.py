"""Language identification by prediction by partial matching."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from eventlake.llm.common import Shipped, map_blocks, remainder, sample_texts
from eventlake.llm.grams import ByteModel

#: Bytes of context.
ORDER = 4
#: Bytes of text that a language is learned from, at most about; longer texts give pieces.
SAMPLE_BYTES = 1 << 20
UNDETERMINED = "und"
_NO_LETTERS = bytes(i for i in range(128) if not chr(i).isalpha())


def has_letters(text: bytes | None) -> bool:
    if not text:
        return False
    rest = text.translate(None, _NO_LETTERS)
    return bool(rest) and (rest[0] < 128 or not rest.isascii() and any(map(str.isalpha, text.decode())))


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", order: int = ORDER):
    """(languages, model) learned from a sample of the rows given, by hash of the text.

    A sample has about ``SAMPLE_BYTES`` of each language, pieces of longer texts, at every size of the
    table; only it comes to the driver. Null texts and languages teach nothing.
    """
    by_lang = sample_texts(docs.select(F.col(lang).alias("label"), F.col(text).alias("text")), SAMPLE_BYTES)
    if not by_lang:
        return [], None
    languages = sorted(by_lang)
    return languages, ByteModel([by_lang[name] for name in languages], order)


def identify(docs: DataFrame, languages: list[str], model: ByteModel | None, text: str = "text") -> DataFrame:
    """All columns of ``docs``, ``lang_pred``, ``score`` and ``bits_per_byte``.

    Each language's model gives the whole text's exact code length under its frozen
    counts; the shortest wins, ties to the smaller name. The score is the language's
    share of the probability, all languages being equally likely beforehand. Null texts
    and texts without letters are ``und`` with score 0, as all are if nothing was learned.
    ``docs`` must not have columns of these three names.
    """
    shared = Shipped(docs.sparkSession, (languages, model))

    def run(texts: list[bytes | None]) -> dict[str, pa.Array]:
        names, model = shared.value
        lettered = np.array([model is not None and has_letters(t) for t in texts], bool)
        pred, score, rate = [UNDETERMINED] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
        if lettered.any():
            at = np.flatnonzero(lettered)
            bits = model.bits([texts[i] for i in at])
            best = bits.argmin(axis=1)
            least = bits[np.arange(len(at)), best]
            score[at] = 1 / np.exp2(np.maximum(least[:, None] - bits, -1000)).sum(axis=1)
            rate[at] = least / np.array([len(texts[i]) for i in at])
            for i, j in zip(at.tolist(), best.tolist()):
                pred[i] = names[j]
        return {"lang_pred": pa.array(pred), "score": pa.array(score), "bits_per_byte": pa.array(rate)}

    return map_blocks(docs, text, run, "lang_pred string, score double, bits_per_byte double")


def predict_languages(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """(key, held_out, lang_pred, score, bits_per_byte) of every row.

    Learns from text and language of the rows whose crc32 of the key modulo 3 isn't 1. A null
    key is neither learned from nor held out.
    """
    rows = docs.select(F.col(key), F.col(text), F.col(lang))
    languages, model = learn(rows.filter(remainder(key, 3) != 1), text, lang)
    held = F.coalesce(remainder(key, 3) == 1, F.lit(False)).alias("held_out")
    found = identify(rows.select(key, held, text), languages, model, text)
    return found.drop(text)
