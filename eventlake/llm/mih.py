"""Approximate nearest neighbours by multi-index hashing of learned binary codes."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import count as count_up

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from eventlake.llm import vectors
from eventlake.llm.common import Shipped, materialised, written
from eventlake.llm.vectors import best, matrix, prepared, sample, tiled_search

#: Rounds in which rotation and codes are fitted to each other.
ROUNDS = 25
#: The radius covers this share of the sample's true neighbours.
COVER = 0.96
#: Bits of a code, its first ones, that the index of all rows holds in substrings of ``SUBSTRING`` bits.
INDEXED = 64
SUBSTRING = 16
#: Queries whose floats go to a shard at once; a task compares ``TILE_QUERIES`` of them at a time.
BLOCK_QUERIES = 1 << 13
_SEED = 7
_PROBED = 200
_BITS = np.arange(256, dtype=np.uint8)
#: Lengths of a step, in parts of a vector's distance from the mean, at which flipped bits are counted.
_STEPS = np.geomspace(0.005, 1, 40)
#: Pairs that a task of the index compares at once, by their codes and by their floats.
_PAIRS = 1 << 20
_FLOATS = 1 << 21
_LAST = INDEXED // SUBSTRING - 1
_FOUND = {"query_id": np.int64, "vec_id": np.int64, "score": np.float64}


@dataclass
class Codes:
    """Learned codes of one dimension: a bit per rotated axis, in substrings of eight bits.

    ``reach`` is how far from a vector, in parts of its distance from the mean, the index finds others.
    """

    mean: np.ndarray
    rotation: np.ndarray
    radius: int
    reach: float = 0.0

    @property
    def bits(self) -> int:
        return len(self.mean)

    def widened(self, step: int) -> int:
        """The radius, doubled ``step`` times and at most all bits."""
        return min(self.bits, max(1, self.radius) << step) if step else self.radius

    def of(self, x: np.ndarray) -> np.ndarray:
        return np.packbits((x - self.mean) @ self.rotation > 0, axis=1)

    def indexed(self, x: np.ndarray) -> np.ndarray:
        """The first ``INDEXED`` bits as one number."""
        whole = np.zeros((len(x), INDEXED // 8), np.uint8)
        codes = self.of(x)[:, : INDEXED // 8]
        whole[:, : codes.shape[1]] = codes
        return whole.view(">u8").astype(np.uint64).reshape(-1)

    def distant(self, x: np.ndarray) -> np.ndarray:
        return np.sqrt(((x - self.mean) ** 2).sum(axis=1))


def substrings(dimension: int) -> int:
    return -(-min(dimension, INDEXED) // SUBSTRING)


def index_radius(dimension: int) -> int:
    """What probing all values at most one bit away covers: two flips in each substring but one flip in one."""
    return 2 * substrings(dimension) - 1


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hamming distances of all codes of ``a`` to all of ``b``."""
    total = np.zeros((len(a), len(b)), np.uint16)
    for i in range(a.shape[1]):
        total += np.bitwise_count(a[:, i, None] ^ b[None, :, i])
    return total


def fit_codes(x: np.ndarray, k: int, cover: float = COVER) -> Codes:
    """Rotate the principal axes so that signs lose least, and choose the radius.

    The radius is the ``cover`` quantile of the code distances of true neighbours within
    the sample. A full table has closer neighbours than its sample, so it covers more there.
    """
    mean = x.mean(axis=0)
    axes = np.linalg.svd(x - mean, full_matrices=True)[2].T
    y = (x - mean) @ axes
    turn = np.linalg.qr(np.random.default_rng(_SEED).normal(size=(x.shape[1],) * 2))[0]
    for _ in range(ROUNDS):
        u, _, vt = np.linalg.svd(np.where(y @ turn > 0, 1.0, -1.0).T @ y)
        turn = (u @ vt).T
    codes = Codes(mean, axes @ turn, 0)
    probes = x[: min(_PROBED, len(x))]
    squared = (x**2).sum(axis=1)[None] - 2 * probes @ x.T
    squared[np.arange(len(probes)), np.arange(len(probes))] = np.inf
    near = np.argsort(squared, axis=1)[:, : max(1, min(k, len(x) - 1))]
    apart = np.take_along_axis(distances(codes.of(probes), codes.of(x)), near, axis=1)
    codes.radius = int(np.quantile(apart, cover, method="higher"))
    codes.reach = _reach(codes, x, cover)
    return codes


def _reach(codes: Codes, x: np.ndarray, cover: float) -> float:
    """The longest step that ``cover`` of the sample's vectors take without leaving the index's radius.

    Steps go in directions between vectors of the sample, so flips are counted at distances that a
    sample of a large table doesn't hold.
    """
    rng = np.random.default_rng(_SEED)
    at = x[rng.integers(0, len(x), 2000)]
    along = x[rng.integers(0, len(x), 2000)] - x[rng.integers(0, len(x), 2000)]
    length = np.sqrt((along**2).sum(axis=1))
    at, along = at[length > 0], along[length > 0] / length[length > 0, None]
    if not len(at):
        return 0.0
    held, reach = codes.indexed(at), 0.0
    for step in _STEPS:
        flips = np.bitwise_count(held ^ codes.indexed(at + step * codes.distant(at)[:, None] * along))
        if np.quantile(flips, cover, method="higher") > index_radius(x.shape[1]):
            break
        reach = float(step)
    return reach


def within_radius(index: np.ndarray, asked: np.ndarray, radius: int) -> np.ndarray:
    """Which pairs (query, row) of codes are at most ``radius`` bits apart.

    Every substring has an index from its value to the rows that hold it. Of two codes
    within the radius, one substring differs in at most ``radius // substrings`` bits, so
    probing the values so near finds them all; what was found is compared in full.
    """
    found = np.zeros((len(asked), len(index)), bool)
    near = radius // index.shape[1]
    for s in range(index.shape[1]):
        order = np.argsort(index[:, s], kind="stable")
        edges = np.searchsorted(index[order, s], np.arange(257))
        for value in np.flatnonzero(np.diff(edges)):
            rows = order[edges[value] : edges[value + 1]]
            probing = np.flatnonzero(np.bitwise_count(asked[:, s] ^ _BITS[value]) <= near)
            if len(probing):
                found[probing[:, None], rows] |= distances(asked[probing], index[rows]) <= radius
    return found


def _few_of_equal(x: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Rows without those that more than ``k`` equal vectors of smaller id precede: they never rank."""
    order = np.argsort(ids, kind="stable")
    _, group = np.unique(x[order], axis=0, return_inverse=True)
    group = group.reshape(-1)
    by_group = np.argsort(group, kind="stable")
    sizes = np.bincount(group)
    place = np.arange(len(group)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return order[by_group[place <= k]]


def _measured(q: np.ndarray, qids: np.ndarray, x: np.ndarray, ids: np.ndarray, pairs: tuple) -> pd.DataFrame:
    """(query_id, vec_id, score) of pairs (place of query, place of row)."""
    at, of = pairs
    score = np.empty(len(at))
    step = max(1, _FLOATS // x.shape[1])
    for i in range(0, len(at), step):
        score[i : i + step] = np.sqrt(((x[of[i : i + step]] - q[at[i : i + step]]) ** 2).sum(axis=1))
    return pd.DataFrame({"query_id": qids[at], "vec_id": ids[of], "score": score})


def _first(found: pd.DataFrame, k: int) -> pd.DataFrame:
    found = found.sort_values(["query_id", "score", "vec_id"])
    return found[found.groupby("query_id").cumcount() < k]


def _meeting(apart: np.ndarray, dimension: int) -> np.ndarray:
    """The lowest substring in which codes that differ so are at most one bit apart, or -1."""
    meeting = np.full(len(apart), -1)
    for s in range(_LAST, _LAST - substrings(dimension), -1):
        part = (apart >> np.uint64(SUBSTRING * s)) & np.uint64((1 << SUBSTRING) - 1)
        meeting[np.bitwise_count(part) <= 1] = s
    return meeting


def _in_buckets(left: pd.DataFrame, right: pd.DataFrame, dimension: int, k: int) -> pd.DataFrame:
    """The ``k`` nearest of each query among rows of a bucket it probes, with codes within the index's radius.

    A pair that meets in several substrings is looked at in one of them.
    """
    radius = index_radius(dimension)
    _, place = np.unique(left["bucket"], return_inverse=True)
    if len(left):
        with_bucket = np.column_stack([place, matrix(left["v"])])
        left = left.iloc[_few_of_equal(with_bucket, left["vec_id"].to_numpy(), k)]
    left = left.sort_values("bucket", kind="stable")
    bucket, asked = left["bucket"].to_numpy(), right["bucket"].to_numpy()
    start, end = np.searchsorted(bucket, asked, "left"), np.searchsorted(bucket, asked, "right")
    hit = np.flatnonzero(end > start)
    out = pd.DataFrame({n: np.array([], t) for n, t in _FOUND.items()})
    if not len(hit):
        return out
    right, start, size = right.iloc[hit], start[hit], (end - start)[hit]
    x, ids, codes = matrix(left["v"]), left["vec_id"].to_numpy(), left["code"].to_numpy().view(np.uint64)
    q, qids, theirs = matrix(right["v"]), right["vec_id"].to_numpy(), right["code"].to_numpy().view(np.uint64)
    own = right["s"].to_numpy()
    part = np.cumsum(size) // _PAIRS
    for chunk in np.split(np.arange(len(size)), np.flatnonzero(np.diff(part)) + 1):
        n = size[chunk]
        at = np.repeat(chunk, n)
        of = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start[chunk], n)
        apart = theirs[at] ^ codes[of]
        near = (np.bitwise_count(apart) <= radius) & (qids[at] != ids[of])
        at, of, apart = at[near], of[near], apart[near]
        mine = _meeting(apart, dimension) == own[at]
        out = _first(pd.concat([out, _measured(q, qids, x, ids, (at[mine], of[mine]))]), k)
    return out


def _ranked(
    q: np.ndarray, qids: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int, found: np.ndarray
) -> list[pd.DataFrame]:
    """The ``k`` nearest of each query among the rows ``found`` for it, measured exactly where a rough distance allows."""
    out = []
    used = np.flatnonzero(found.any(axis=0))
    lengths = (x[used] ** 2).sum(axis=1)
    for i in range(len(q)):
        mine = np.flatnonzero(found[i, used])
        at = used[mine]
        if len(at) > k:
            rough = lengths[mine] - 2 * (x[at] @ q[i])
            worst = np.partition(rough, k - 1)[k - 1]
            slack = 1e-9 * (np.abs(rough).max() + (q[i] ** 2).sum())
            at = at[~(rough > worst + slack)]
        exact = np.sqrt(((x[at] - q[i]) ** 2).sum(axis=1))
        first = np.lexsort((ids[at], exact))[:k]
        out.append(pd.DataFrame({"query_id": qids[i], "vec_id": ids[at[first]], "score": exact[first]}))
    return out


def _coded(rows: DataFrame, fitted: dict[int, Codes]) -> DataFrame:
    """``rows`` with the number of the indexed bits and the distance that the index covers, without those of no code."""
    shared = Shipped(rows.sparkSession, fitted)

    def run(batches):
        fitted = shared.value
        for batch in batches:
            for d, part in batch.groupby("d"):
                codes = fitted.get(int(d))
                if codes is not None:
                    x = matrix(part["v"])
                    yield part.assign(code=codes.indexed(x).view(np.int64), reach=codes.reach * codes.distant(x))

    return rows.mapInPandas(run, "vec_id bigint, v array<double>, d int, code bigint, reach double")


def index_search(coded: DataFrame, every: int, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score) among the rows whose indexed bits are within the index's radius.

    The index is a table of (substring, value); a query probes each value at most one bit from its
    own, and by the pigeonhole every code within :func:`index_radius` meets it in one substring. A row is
    shuffled once a substring, whatever the number of queries, and only if its value is probed. Values are dealt to
    tasks; one of many rows or probes is split into shards of ``TILE_ROWS`` rows and blocks of ``BLOCK_QUERIES`` probes.
    """
    # The first bits of a code are its number's highest, so a short code has the last substrings.
    held = F.ceil(F.least(F.col("d"), F.lit(INDEXED)) / F.lit(SUBSTRING)).cast("int")
    last = F.lit(_LAST)
    entries = coded.withColumn("s", F.explode(F.sequence(last - held + 1, last)))
    low = F.call_function("shiftrightunsigned", F.col("code"), F.col("s") * SUBSTRING)
    entries = entries.withColumn("value", low.bitwiseAND(F.lit((1 << SUBSTRING) - 1)))
    masks = F.array(F.lit(0), *(F.lit(1 << i) for i in range(SUBSTRING))).cast("array<bigint>")
    probes = entries.filter(F.col("vec_id") % every == 0).withColumn("mask", F.explode(masks))
    probes = probes.withColumn("value", F.col("value").bitwiseXOR(F.col("mask"))).drop("mask")
    named = ["d", "s", "value"]
    parts = lambda n, size: F.ceil(F.col(n) / F.lit(size)).cast("int")
    sizes = (
        entries.groupBy(*named).agg(F.count("*").alias("rows"))
        .join(probes.groupBy(*named).agg(F.count("*").alias("probes")), named)
        .withColumn("shards", parts("rows", vectors.TILE_ROWS))
        .withColumn("blocks", parts("probes", BLOCK_QUERIES))
    )
    # A row for each probed value: at most 4 x 65,536 for vectors of one dimension.
    sizes = written(sizes)
    spread = F.sum(F.col("rows") * F.col("blocks")), F.sum(F.col("probes") * F.col("shards"))
    moved, asked = sizes.agg(*(F.coalesce(x, F.lit(0)) for x in spread)).first()
    cells = max(1, -(-moved // vectors.TILE_ROWS), -(-asked // BLOCK_QUERIES))
    own = lambda n: F.pmod(F.xxhash64("vec_id", F.lit(n)), F.col(n)).cast("int")
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    def dealt(df: DataFrame, shard, block) -> DataFrame:
        df = df.join(sizes, named).withColumn("shard", shard).withColumn("block", block)
        df = df.withColumn("bucket", F.xxhash64("s", "value", "shard", "block"))
        df = df.withColumn("cell", F.pmod("bucket", F.lit(cells)))
        # Both sides come of one table, so their columns need names of their own.
        return df.select(*(F.col(n).alias(n) for n in ("d", "vec_id", "v", "code", "s", "bucket", "cell")))

    def kernel(cell: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return _in_buckets(left, right, int(cell[0]), k)

    left = dealt(entries, own("shards"), all_of("blocks")).groupBy("d", "cell")
    right = dealt(probes, all_of("shards"), own("blocks")).groupBy("d", "cell")
    found = left.cogroup(right).applyInPandas(kernel, "query_id bigint, vec_id bigint, score double")
    return best(found, k, F.col("score"))


def mih_search(
    df: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    every: int = 100,
    k: int = 10,
    cover: float = COVER,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each query, by Euclidean distance.

    Queries are the rows whose key ``every`` divides; every row but the query's own is a
    candidate. Codes and radius are fitted on a bounded sample; every row is indexed. First all queries
    probe the index of a small radius; one whose ``k`` nearest found are all within the distance that this radius covers
    is done. The others go by the radius of the sample's neighbours, which may reach a good part of the table: shards
    index their rows where they are. What the probes find is ranked
    by the original vectors in double precision. Queries that find fewer than ``k`` probe again
    at twice the radius, up to all bits, until they have ``k`` or all candidates. Null, zero and non-finite vectors and
    null keys take no part, repeated keys count once, vectors of different dimensions
    are never compared. An empty table gives an empty result.
    """
    rows, queries, count, asked = prepared(df, key, vector, every, zero=False)
    fitted = {d: fit_codes(x, k, cover) for d, x in sample(rows, count).items() if len(x) > 1}

    at_once = vectors.TILE_QUERIES

    def probing(step: int):
        def kernel(tile: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            out = []
            if len(left) and len(right):
                x, ids = matrix(left["v"]), left["vec_id"].to_numpy()
                keep = _few_of_equal(x, ids, k)
                x, ids = x[keep], ids[keep]
                q, qids = matrix(right["v"]), right["vec_id"].to_numpy()
                codes = fitted.get(int(tile[0]))
                index, asked = (None, None) if codes is None else (codes.of(x), codes.of(q))
                for low in range(0, len(q), at_once):
                    part = slice(low, low + at_once)
                    found = np.ones((len(q[part]), len(x)), bool)
                    if codes is not None:
                        found = within_radius(index, asked[part], codes.widened(step))
                    found &= qids[part, None] != ids[None]
                    out += _ranked(q[part], qids[part], x, ids, k, found)
            return pd.concat(out) if out else pd.DataFrame({n: np.array([], t) for n, t in _FOUND.items()})

        return kernel

    coded = materialised(_coded(rows, fitted))
    found = materialised(index_search(coded, every, k))
    reach = coded.filter(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "reach")
    covered = (F.col("n") >= k) & (F.col("furthest") <= F.col("reach"))
    each = found.groupBy("query_id").agg(F.count("*").alias("n"), F.max("score").alias("furthest"))
    parts, done = [], each.join(reach, "query_id").filter(covered).select("query_id")
    for step in count_up():
        parts.append(found.join(done, "query_id", "left_semi"))
        queries = materialised(queries.join(done, F.col("vec_id") == F.col("query_id"), "left_anti"))
        asked = queries.count()
        if not asked:
            break
        found = tiled_search(rows, queries, count, asked, probing(step), "double", BLOCK_QUERIES)
        found = best(found, k, F.col("score"))
        if all(codes.widened(step) >= codes.bits for codes in fitted.values()):
            parts.append(found)
            break
        found = materialised(found)
        done = found.groupBy("query_id").count().filter(F.col("count") >= k).select("query_id")
    return reduce(DataFrame.unionByName, parts)
