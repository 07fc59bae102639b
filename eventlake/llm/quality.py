"""Quality scores: random-indexing word vectors, pooled, and a small calibrated network."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from eventlake.llm.common import Shipped, byte_blocks, hash_slot, map_batches, map_blocks, remainder, sampled_share

#: Words are hashed to so many rows of the word-vector table.
BUCKETS = 1 << 13
SIZE = 32
#: Signed ones in a word's random index vector.
ONES = 2
#: Neighbours up to this distance are a word's context.
WINDOW = 2
#: Labelled rows that the network is fitted on, at most about; one in five calibrates it.
FIT_ROWS = 6000
HIDDEN = 32
THRESHOLD = 0.3
_EPOCHS = 400
_PIECE = 1 << 20
_GATHER = 1 << 15
_SEED = 11
_FEATURES = 2 * SIZE + WINDOW + 1

_random = np.random.default_rng(_SEED)
_PLACES = _random.integers(0, SIZE, (BUCKETS, ONES))
_SIGNS = _random.choice([-1.0, 1.0], (BUCKETS, ONES))
_POWERS = np.cumprod(np.full(256, 0x100000001B3, np.uint64)) | np.uint64(1)
_MIX = np.uint64(0x9E3779B97F4A7C15)
#: Kinds of byte: 0 space, 1 of a word, 2 other signs.
_KIND = np.array([0 if i in b" \t\n\r\v\f" else 1 if i > 127 or chr(i).isalnum() else 2 for i in range(256)], np.uint8)


def index_vectors() -> np.ndarray:
    """The random index vector of every bucket: few signed ones."""
    table = np.zeros((BUCKETS, SIZE), np.float32)
    for j in range(ONES):
        np.add.at(table, (np.arange(BUCKETS), _PLACES[:, j]), _SIGNS[:, j])
    return table


def pieces(text: bytes) -> Iterator[bytes]:
    """A long text in parts of bounded size, cut at spaces where there are any."""
    start = 0
    while len(text) - start > _PIECE:
        cut = text.rfind(b" ", start, start + _PIECE)
        cut = start + _PIECE if cut <= start else cut
        yield text[start:cut]
        start = cut
    yield text[start:] if start else text


def words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each word or run of signs, and which text it is in. Case counts."""
    data = np.frombuffer(b"\n".join(texts), np.uint8)
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kind = _KIND[data]
    starts = np.flatnonzero(np.diff(kind, prepend=0) != 0)
    starts = np.concatenate(([0], starts)) if not len(starts) or starts[0] else starts
    place = np.arange(len(data)) - np.repeat(starts, np.diff(starts, append=len(data)))
    hashes = np.add.reduceat((data.astype(np.uint64) + np.uint64(1)) * _POWERS[place & 255], starts)
    real = kind[starts] > 0
    begins = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])])
    text = np.searchsorted(begins, starts[real], "right") - 1
    return ((hashes[real] * _MIX) >> np.uint64(51)).astype(np.int64), text


def word_vectors(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Context vectors of all buckets: the sum of the neighbours' index vectors over every text.

    Each task adds up a table of fixed size and hands on its rows; these are added by bucket,
    so the shuffle is a small share of the input and one table reaches the driver.
    """

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS * SIZE)
        for batch in batches:
            for block in byte_blocks(batch, 0):
                raw = block.column(0).cast(pa.large_binary()).to_pylist()
                bucket, of = words([p for t in raw if t for p in pieces(t)])
                for step in range(1, WINDOW + 1):
                    same = of[step:] == of[:-step]
                    a, b = bucket[:-step][same], bucket[step:][same]
                    for word, near in ((a, b), (b, a)):
                        for j in range(ONES):
                            cell = word * SIZE + _PLACES[near, j]
                            total += np.bincount(cell, _SIGNS[near, j], BUCKETS * SIZE)
        yield from rows(total.reshape(BUCKETS, SIZE))

    def rows(total: np.ndarray) -> Iterator[pa.RecordBatch]:
        used = np.flatnonzero(total.any(axis=1))
        if len(used):
            packed = [total[i].tobytes() for i in used]
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(packed)], names=["bucket", "v"])

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BUCKETS, SIZE))
        for batch in batches:
            values = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.float64).reshape(-1, SIZE)
            np.add.at(total, batch.column(0).to_numpy(), values)
        yield from rows(total)

    schema = "bucket int, v binary"
    summed = map_batches(map_batches(docs.select(text), count, schema).repartition("bucket"), add, schema)
    table = np.zeros((BUCKETS, SIZE), np.float32)
    for bucket, v in summed.collect():
        table[bucket] = np.frombuffer(v, np.float64)
    return table / np.maximum(1e-9, np.linalg.norm(table, axis=1, keepdims=True))


def features(texts: list[bytes | None], vectors: np.ndarray) -> np.ndarray:
    """Per text: mean word vector and mean index vector, how often words recur next to themselves, size."""
    out = np.zeros((len(texts), _FEATURES))
    parts = [(i, p) for i, t in enumerate(texts) if t for p in pieces(t)]
    bucket, part = words([p for _, p in parts])
    of = np.array([i for i, _ in parts], np.int64)[part]
    for start in range(0, len(bucket), _GATHER):
        mine = of[start : start + _GATHER]
        edges = np.flatnonzero(np.diff(mine, prepend=-1))
        out[mine[edges], : 2 * SIZE] += np.add.reduceat(vectors[bucket[start : start + _GATHER]], edges, axis=0)
    for step in range(1, WINDOW + 1):
        again = (part[step:] == part[:-step]) & (bucket[step:] == bucket[:-step])
        out[:, 2 * SIZE + step - 1] = np.bincount(of[step:][again], minlength=len(texts))
    n = np.bincount(of, minlength=len(texts))
    out[:, :-1] /= np.maximum(1, n)[:, None]
    out[:, -1] = np.log1p(n)
    return out


@dataclass
class Network:
    """Two layers over standardised features; ``temperature`` divides the log odds."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def odds(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.maximum(0, z @ self.w1 + self.b1) @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.odds(x) / self.temperature, -60, 60)))


def fit(x: np.ndarray, y: np.ndarray, calibrate: np.ndarray) -> Network | None:
    """Fit by Adam on the rows not in ``calibrate``, then the temperature on those. None without labels."""
    own = ~calibrate if (~calibrate).any() else np.ones(len(y), bool)
    if not len(y):
        return None
    rng = np.random.default_rng(_SEED)
    share = float(np.clip(y[own].mean(), 0.01, 0.99))
    net = Network(
        x[own].mean(axis=0),
        x[own].std(axis=0) + 1e-3,
        rng.normal(0, (2 / x.shape[1]) ** 0.5, (x.shape[1], HIDDEN)),
        np.zeros(HIDDEN),
        rng.normal(0, HIDDEN**-0.5, HIDDEN),
        float(np.log(share / (1 - share))),
    )
    z, t = np.clip((x[own] - net.mean) / net.scale, -8, 8), y[own]
    held = [net.w1, net.b1, net.w2, np.array([net.b2])]
    first, second = [np.zeros_like(p) for p in held], [np.zeros_like(p) for p in held]
    for epoch in range(1, _EPOCHS + 1):
        hidden = np.maximum(0, z @ held[0] + held[1])
        error = (1 / (1 + np.exp(-np.clip(hidden @ held[2] + held[3], -60, 60))) - t) / len(t)
        back = np.outer(error, held[2]) * (hidden > 0)
        slopes = [z.T @ back + 1e-4 * held[0], back.sum(axis=0), hidden.T @ error, np.array([error.sum()])]
        for p, g, m, v in zip(held, slopes, first, second):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= 0.01 * (m / (1 - 0.9**epoch)) / (np.sqrt(v / (1 - 0.999**epoch)) + 1e-8)
    net.w1, net.b1, net.w2, net.b2 = held[0], held[1], held[2], float(held[3][0])
    if calibrate.any():
        odds, truth = net.odds(x[calibrate]), y[calibrate]
        loss = lambda c: np.logaddexp(0, np.where(truth > 0, -odds, odds) / c).mean()
        net.temperature = float(min(np.geomspace(0.25, 8, 60), key=loss))
    return net


@dataclass
class Scorer:
    vectors: np.ndarray
    network: Network | None

    def __call__(self, texts: list[bytes | None]) -> np.ndarray:
        if self.network is None:
            return np.full(len(texts), 0.5)
        return self.network.scores(features(texts, self.vectors))


def learn(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality"
) -> Scorer:
    """Word vectors from all texts; the network from the labelled rows whose crc32 modulo 5 isn't 0.

    Of these about ``FIT_ROWS`` are taken by hash of the key at every size of the table.
    Only labels 0 and 1 count; of several labels of a key, the largest, of several texts the smallest.
    """
    tables = np.concatenate([word_vectors(docs, text), index_vectors()], axis=1)
    known = labels.filter(F.col(label).isin(0, 1) & (remainder(key, 5) != 0))
    known = known.groupBy(F.col(key).alias("key")).agg(F.max(label).cast("double").alias("label"))
    slot = hash_slot(F.col("key"), F.lit("fit"))
    # About FIT_ROWS rows of two numbers, whatever the size of the tables.
    few = known.filter(slot <= sampled_share(known.count(), FIT_ROWS))
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).join(F.broadcast(few), "key")
    rows = rows.groupBy("key", "label").agg(F.min("text").alias("text"))
    rows = rows.withColumn("calibrate", F.pmod(slot, F.lit(5)) == 0)
    shared = Shipped(docs.sparkSession, tables)

    def run(texts: list[bytes | None]) -> dict[str, pa.Array]:
        return {"x": pa.array(list(features(texts, shared.value)))}

    found = map_blocks(rows, "text", run, "x array<double>").drop("text").toPandas()
    found = found.sort_values("key")
    x = np.stack(found["x"].to_numpy()) if len(found) else np.zeros((0, _FEATURES))
    return Scorer(tables, fit(x, found["label"].to_numpy(float), found["calibrate"].to_numpy(bool)))


def score(docs: DataFrame, scorer: Scorer, text: str = "text") -> DataFrame:
    """All columns of ``docs`` and ``score``, the probability of label 1. No column may have this name.

    Null texts count as empty ones. If no labels were known every score is one half.
    """
    shared = Shipped(docs.sparkSession, scorer)
    return map_blocks(docs, text, lambda texts: {"score": pa.array(shared.value(texts))}, "score double")


def predict_quality(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, held_out, score, predicted) of every row; a null key isn't held out and teaches no label."""
    scorer = learn(docs, labels, key, text)
    held = F.coalesce(remainder(key, 5) == 0, F.lit(False)).alias("held_out")
    scored = score(docs.select(F.col(key), held, F.col(text)), scorer, text)
    return scored.select(key, "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
