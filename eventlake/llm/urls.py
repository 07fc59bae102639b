"""URL filters: host and path rules, and a character model ratio where no rule fits."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from eventlake.llm.common import Shipped, map_blocks, sample_texts
from eventlake.llm.grams import ByteModel

#: (verdict, host and path)
RULES = (
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
)
ALLOW, BLOCK = "allow", "block"
ORDER = 5
#: Bytes of URLs that each model is learned from, at most about.
SAMPLE_BYTES = 1 << 20
#: One URL in so many of the sample serves to calibrate instead.
CALIBRATION = 5
_STEPS = 50


def split_url(url: str) -> tuple[Column, Column]:
    """Host and path: what follows the first ``://``. Both are empty if it is missing or null."""
    part = lambda group: F.coalesce(
        F.regexp_extract(F.col(url), r"(?s)^.*?://([^/?#]*)([^?#]*)", group), F.lit("")
    )
    return F.translate(part(1), ascii_uppercase, ascii_lowercase), part(2)


def matched_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule's text and verdict, or nulls; equally long ones in code-point order.

    A rule fits its host and all subdomains if the path starts with the rule's.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, text in sorted(rules, key=lambda r: (-len(r[1]), r[1]), reverse=True):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


@dataclass
class UrlModel:
    """Models of accepted and rejected URLs, and the calibration of their difference."""

    model: ByteModel
    slope: float = 1.0
    offset: float = 0.0

    def ratios(self, urls: Sequence[bytes]) -> np.ndarray:
        """Bits per byte that the rejected URLs' model saves over the accepted ones'."""
        bits = self.model.bits(urls)
        return (bits[:, 0] - bits[:, 1]) / np.maximum(1, [len(u) for u in urls])

    def rejected(self, ratios: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * ratios + self.offset, -500, 500)))


def learn(accepted: list[bytes], rejected: list[bytes], order: int = ORDER) -> UrlModel | None:
    """Learn both models on most URLs and calibrate on the rest; None if a kind is missing.

    The calibration is a logistic fit by Newton steps with a weak pull to slope 1, offset 0.
    """
    if not accepted or not rejected:
        return None
    held = lambda u: xxhash.xxh64_intdigest(u, 1) % CALIBRATION == 0
    parts = [[u for u in urls if not held(u)] or urls for urls in (accepted, rejected)]
    found = UrlModel(ByteModel(parts, order, blended=True))
    checks = [[u for u in urls if held(u)] for urls in (accepted, rejected)]
    y = np.repeat([0.0, 1.0], [len(c) for c in checks])
    x = np.stack([found.ratios(checks[0] + checks[1]), np.ones(len(y))], axis=1)
    prior, pull = np.array([1.0, 0.0]), 1.0
    w = prior.copy()
    for _ in range(_STEPS):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        slope = x.T @ (p - y) + pull * (w - prior)
        w = w - np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + pull * np.eye(2), slope)
    found.slope, found.offset = float(w[0]), float(w[1])
    return found


def filter_urls(
    pages: DataFrame,
    key: str = "page_id",
    url: str = "url",
    rules: Sequence[tuple[str, str]] = RULES,
    sample_bytes: int = SAMPLE_BYTES,
) -> DataFrame:
    """(key, host, path, rule, verdict, ratio, p_block) of every row.

    Where a rule fits, it decides. Other URLs are judged by two Witten-Bell smoothed byte
    models, learned from a bounded sample of the URLs that rules accept and reject: the
    difference of code lengths per byte, calibrated to a probability, blocks at one half or more.
    Null URLs count as empty ones, long ones are judged whole, repeated rows alike; other columns are ignored. The rules'
    verdicts are the labels, so the sample of labelled rows is bounded, by ``sample_bytes`` of each. Where the table holds no URL accepted by a rule, or none
    rejected, nothing can be learned and URLs without a rule are allowed, with null ``ratio``.
    """
    host, path = split_url(url)
    rows = pages.select(F.col(key), F.col(url).alias("url"), host.alias("host"), path.alias("path"))
    rule, verdict = matched_rule(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("rule", rule).withColumn("ruled", verdict)
    known = sample_texts(rows.select(F.col("ruled").alias("label"), F.col("url").alias("text")), sample_bytes)
    shared = Shipped(pages.sparkSession, learn(known.get(ALLOW, []), known.get(BLOCK, [])))

    def run(urls: list[bytes | None]) -> dict[str, pa.Array]:
        model, texts = shared.value, [u or b"" for u in urls]
        if model is None:
            nothing = pa.nulls(len(texts), pa.float64())
            return {"ratio": nothing, "p_block": nothing}
        ratios = model.ratios(texts)
        return {"ratio": pa.array(ratios), "p_block": pa.array(model.rejected(ratios))}

    judged = map_blocks(rows, "url", run, "ratio double, p_block double")
    own = F.when(F.col("p_block") >= 0.5, BLOCK).otherwise(ALLOW)
    return judged.select(
        key, "host", "path", "rule", F.coalesce("ruled", own).alias("verdict"), "ratio", "p_block"
    )
