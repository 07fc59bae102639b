"""Exact top-k inner products over vectors sorted by length, with residual bounds."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from eventlake.llm.common import materialised
from eventlake.llm.vectors import best, matrix, prepared, sample, tiled_search

SCALE = 256
#: The longest vectors, which give every query a first score to beat.
LONGEST = 2048
#: Rows taken at once in descending length.
STEP = 256
_LONG = 2**63


def scaled(x: np.ndarray) -> np.ndarray:
    return np.floor(SCALE * x)


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer inner products; those beyond a long are held at its limits."""
    largest = np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * max(1, q.shape[1])
    if largest < 2**53:
        return (q @ x.T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    exact = whole(q).dot(whole(x).T) if q.size and x.size else np.zeros((len(q), len(x)), object)
    return np.vectorize(lambda s: max(-_LONG, min(_LONG - 1, s)), otypes=[np.int64])(exact)


def rotation(x: np.ndarray) -> np.ndarray:
    """Principal axes of the scaled vectors, the strongest first."""
    with np.errstate(all="ignore"):
        usable = x[np.isfinite((x**2).sum(axis=1))]
    return np.linalg.svd(usable, full_matrices=True)[2].T if len(usable) else np.eye(x.shape[1])


class TopK:
    """The best ``k`` (score, id) of each query so far."""

    def __init__(self, queries: int, k: int):
        self.scores = np.zeros((queries, k), np.int64)
        self.ids = np.zeros((queries, k), np.int64)
        self.real = np.zeros((queries, k), bool)

    def add(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray, real: np.ndarray) -> None:
        k = self.scores.shape[1]
        s = np.concatenate([self.scores[rows], scores], axis=1)
        i = np.concatenate([self.ids[rows], np.broadcast_to(ids, scores.shape)], axis=1)
        r = np.concatenate([self.real[rows], real], axis=1)
        # ~s descends as s ascends, without overflow at the smallest long.
        order = np.lexsort((i, ~s, ~r), axis=1)[:, :k]
        for mine, all_ in ((self.scores, s), (self.ids, i), (self.real, r)):
            mine[rows] = np.take_along_axis(all_, order, axis=1)

    def least(self) -> np.ndarray:
        """The score that a further row must reach."""
        return np.where(self.real[:, -1], self.scores[:, -1].astype(np.float64), -np.inf)


def search(
    x: np.ndarray, ids: np.ndarray, q: np.ndarray, qids: np.ndarray, least: np.ndarray, turn: np.ndarray, k: int
) -> TopK:
    """Best ``k`` integer inner products of each query that reach ``least``.

    Rows come in descending length. By Cauchy-Schwarz a row scores at most the product of
    the lengths, which ends a query's search, and at most its partial sum over the first
    rotated axes plus the product of the residual lengths, which spares exact scores.
    """
    with np.errstate(all="ignore"):
        length = np.sqrt((x**2).sum(axis=1))
        order = np.argsort(-length, kind="stable")
        x, ids, length = x[order], ids[order], length[order]
        head = max(1, x.shape[1] // 4)
        xr, qr = x @ turn, q @ turn
        rest = lambda y: np.sqrt((y[:, head:] ** 2).sum(axis=1))
        x_rest, q_rest, q_length = rest(xr), rest(qr), np.sqrt((q**2).sum(axis=1))
        top = TopK(len(q), k)
        slack = 1e-9
        for i in range(0, len(x), STEP):
            block = slice(i, i + STEP)
            must = np.maximum(least, top.least())
            reach = q_length * length[i] * (1 + slack)
            active = np.flatnonzero(~(reach < must))
            if not len(active):
                break
            bound = qr[active, :head] @ xr[block, :head].T + np.outer(q_rest[active], x_rest[block])
            bound += slack * np.outer(q_length[active], length[block])
            can = ~(bound < must[active, None])
            some = can.any(axis=1)
            active, can = active[some], can[some]
            if not len(active):
                continue
            columns = np.flatnonzero(can.any(axis=0))
            scores = products(q[active], x[block][columns])
            mine = ids[block][columns]
            real = can[:, columns] & (qids[active, None] != mine[None]) & ~(scores < least[active, None])
            top.add(active, scores, mine, real)
    return top


def norm_topk(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", every: int = 50, k: int = 5
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` highest integer inner products, exactly.

    Components are scaled to ``floor(256 x)``. Queries are the rows whose key ``every``
    divides; every row but the query's own is a candidate. A first pass over the longest
    vectors, a bounded block, gives each query a score to beat, so that most shards are left
    early and return little. The rotation is fitted on a bounded sample and affects no
    result. Null vectors, null or non-finite components and null keys take no part, repeated
    keys count once, vectors of different dimensions are never compared. Scores beyond a
    long are held at its limits.
    """
    rows, queries, count, asked = prepared(df, key, vector, every, zero=True)
    turns = {d: rotation(scaled(x)) for d, x in sample(rows, count).items()}
    squared = F.aggregate("v", F.lit(0.0), lambda total, x: total + x * x)
    first = rows.orderBy(squared.desc(), "vec_id").limit(LONGEST).toPandas()
    longest = {int(d): (scaled(matrix(p["v"])), p["vec_id"].to_numpy()) for d, p in first.groupby("d")}

    def turn(d: int) -> np.ndarray:
        return turns.get(d, np.eye(d))

    def with_least(parts):
        for part in parts:
            part["least"] = -np.inf
            for d, mine in part.groupby("d"):
                if int(d) in longest:
                    x, ids = longest[int(d)]
                    q, none = scaled(matrix(mine["v"])), np.full(len(mine), -np.inf)
                    top = search(x, ids, q, mine["vec_id"].to_numpy(), none, turn(int(d)), k)
                    part.loc[mine.index, "least"] = top.least()
            yield part

    queries = queries.mapInPandas(with_least, "vec_id bigint, v array<double>, d int, least double")

    def kernel(tile: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({n: np.array([], np.int64) for n in ("query_id", "vec_id", "score")})
        x, q = scaled(matrix(left["v"])), scaled(matrix(right["v"]))
        ids, qids = left["vec_id"].to_numpy(), right["vec_id"].to_numpy()
        top = search(x, ids, q, qids, right["least"].to_numpy(), turn(int(tile[0])), k)
        i, j = np.nonzero(top.real)
        return pd.DataFrame({"query_id": qids[i], "vec_id": top.ids[i, j], "score": top.scores[i, j]})

    found = tiled_search(rows, materialised(queries), count, asked, kernel, "bigint")
    return best(found, k, F.col("score").desc())
