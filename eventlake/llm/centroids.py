"""Exact integer k-means; assignment searches centroids by equal average and equal variance."""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from eventlake.llm.common import map_batches, materialised

SCALE = 1024
DIMENSIONS = 64
CLUSTERS = 8
ROUNDS = 10
SEED = 3
#: Bounds are worked out in double precision; they reject only beyond this relative error.
SLACK = 1e-9
#: Rows of a batch that are searched at once.
_ROWS = 4096
_LONG = 2**63 - 1
#: The largest double that is a long.
_HELD = 2.0**63 - 1024


def vectors(column: pa.Array, dimensions: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the vectors that take part, and these as longs, a component ``floor(scale * x)``.

    Null vectors, those of another length, and those with null or non-finite components
    take no part. Components beyond a long are held at its limits.
    """
    lists = column.cast(pa.list_(pa.float64()))
    lengths = pc.fill_null(pc.list_value_length(lists), -1).to_numpy(zero_copy_only=False)
    places = np.flatnonzero(lengths == dimensions)
    flat = lists.take(pa.array(places)).flatten()
    x = pc.fill_null(flat, float("nan")).to_numpy(zero_copy_only=False).reshape(len(places), dimensions)
    whole = np.isfinite(x).all(axis=1)
    with np.errstate(over="ignore"):
        scaled = np.clip(np.floor(scale * x[whole]), -(2.0**63), _HELD)
    return places[whole], scaled.astype(np.int64)


def _deviation(x: np.ndarray) -> np.ndarray:
    return np.sqrt(((x - x.mean(axis=1, keepdims=True)) ** 2).sum(axis=1))


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of the nearest centroid of each row, ties to the smaller number.

    Centroids stand in order of their component mean. From a vector's own mean the search goes
    outward on both sides, the nearer mean first. With ``s`` the difference of the component sums
    and ``v`` that of the deviations' lengths, a squared distance is at least ``s ** 2 / dimensions``,
    which ends a vector's search, and at least that plus ``v ** 2``, which spares a
    centroid. What remains is measured in integers, beyond 64 bits in Python's.
    """
    (n, size), k = x.shape, len(centroids)
    largest = max(np.abs(a.astype(np.float64)).max(initial=0) for a in (x, centroids))
    kind = np.int64 if size * (2 * largest) ** 2 < 2**62 else object
    xf, cf = x.astype(np.float64), centroids.astype(np.float64)
    x, centroids = x.astype(kind), centroids.astype(kind)
    order = np.argsort(cf.sum(axis=1), kind="stable")
    sums, means = xf.sum(axis=1), cf.sum(axis=1)[order]
    noise = 1e-12 * (np.abs(xf).sum(axis=1) + np.abs(cf).sum(axis=1).max(initial=0))
    x_apart, c_apart = _deviation(xf), _deviation(cf)
    right = np.searchsorted(means, sums)
    left = right - 1
    cluster = np.zeros(n, np.int32)
    best = np.full(n, _LONG if kind is np.int64 else 1 << 200, kind)
    reach = np.full(n, np.inf)
    active = np.arange(n)
    while len(active):
        down, up = left[active], right[active]
        below = np.where(down >= 0, sums[active] - means[np.maximum(down, 0)], np.inf)
        above = np.where(up < k, means[np.minimum(up, k - 1)] - sums[active], np.inf)
        to_left = below <= above
        gap = np.minimum(below, above)
        bound = np.maximum(0, gap - noise[active]) ** 2 / size
        on = np.isfinite(gap) & ~(bound > reach[active])
        active, to_left, bound = active[on], to_left[on], bound[on]
        number = order[np.where(to_left, left[active], right[active])]
        left[active] -= to_left
        right[active] += ~to_left
        both = x_apart[active] + c_apart[number]
        apart = np.maximum(0, np.abs(x_apart[active] - c_apart[number]) - SLACK * both)
        may = ~(bound + apart**2 > reach[active])
        rows, number = active[may], number[may]
        step = x[rows] - centroids[number]
        squared = (step * step).sum(axis=1)
        better = (squared < best[rows]) | ((squared == best[rows]) & (number < cluster[rows]))
        rows, number, squared = rows[better], number[better], squared[better]
        best[rows], cluster[rows] = squared, number
        reach[rows] = squared.astype(np.float64) * (1 + SLACK) + 1
    return cluster, best


def _searched(batch: pa.RecordBatch, at: int, dimensions: int, scale: int, centroids: np.ndarray):
    """(places, vectors, clusters, squared distances) of a batch, some rows at a time."""
    for start in range(0, batch.num_rows, _ROWS):
        places, x = vectors(batch.column(at).slice(start, _ROWS), dimensions, scale)
        if len(places):
            yield (places + start, x, *nearest(x, centroids))


def _starts(rows: DataFrame, k: int, dimensions: int, scale: int, seed: int) -> np.ndarray:
    """The ``k`` vectors whose keys have the smallest hashes; a task returns so many at most."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first: list[tuple[str, list[int]]] = []
        for batch in batches:
            places, x = vectors(batch.column(1), dimensions, scale)
            keys = batch.column(0).take(pa.array(places)).to_pylist()
            hashes = [(sha256(f"{seed}:{key}".encode()).hexdigest(), i) for i, key in enumerate(keys) if key is not None]
            # Equal hashes are those of a repeated key; its smaller vectors come first.
            last = sorted(hashes)[k - 1][0] if len(hashes) >= k else None
            mine = [(h, x[i].tolist()) for h, i in hashes if last is None or h <= last]
            first = heapq.nsmallest(k, first + mine)
        if first:
            yield pa.RecordBatch.from_arrays(
                [pa.array([h for h, _ in first]), pa.array([v for _, v in first], pa.list_(pa.int64()))], ["hash", "v"]
            )

    found = map_batches(rows, run, "hash string, v array<bigint>").orderBy("hash", "v").limit(k).collect()
    return np.array([row["v"] for row in found], np.int64).reshape(len(found), dimensions)


def _moved(rows: DataFrame, centroids: np.ndarray, dimensions: int, scale: int) -> np.ndarray:
    """Centroids replaced by the floored means of their vectors, those without vectors kept.

    Tasks add up; so ``k`` times ``dimensions`` sums a task are shuffled, and as many in all come to the driver.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(centroids.shape, object)
        count = np.zeros(len(centroids), np.int64)
        for batch in batches:
            for _, x, cluster, _ in _searched(batch, 0, dimensions, scale, centroids):
                small = np.abs(x.astype(np.float64)).max(initial=0) < 2**50
                for number in np.unique(cluster).tolist():
                    mine = x[cluster == number]
                    totals[number] += mine.sum(axis=0) if small else mine.astype(object).sum(axis=0)
                    count[number] += len(mine)
        used = np.flatnonzero(count)
        if len(used):
            number, place = np.repeat(used, dimensions), np.tile(np.arange(dimensions), len(used))
            total = pa.array([str(int(t)) for t in totals[used].ravel()]).cast(pa.decimal128(38, 0))
            columns = [pa.array(number.astype(np.int32)), pa.array(place.astype(np.int32)), total]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(count[number])], ["cluster", "place", "total", "n"]
            )

    sums = map_batches(rows, run, "cluster int, place int, total decimal(38,0), n bigint")
    sums = sums.groupBy("cluster", "place").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    moved = centroids.copy()
    for row in sums.collect():
        moved[row["cluster"], row["place"]] = int(row["total"]) // row["n"]
    return moved


def cluster(
    df: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = CLUSTERS,
    rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS,
    scale: int = SCALE,
    seed: int = SEED,
) -> DataFrame:
    """(key, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector that takes part.

    Vectors are those of ``dimensions`` components, none null or non-finite, each taken as the long
    ``floor(scale * x)`` (held at the limits of a long). Centroids start as the ``k`` vectors with the smallest
    SHA-256 of ``seed:key``, or all if there are fewer. In each round every vector goes to its nearest
    centroid, ties to the smaller number, and a centroid with vectors becomes the floor of their exact
    mean; then vectors are assigned once more. Each round reads the vectors where they lie; only
    sums leave the tasks. Distances and inertias beyond a long are held at its limit.

    Null keys never start a centroid but are assigned and come back; repeated rows count as often as they
    come. Other columns are ignored. Without vectors the result is empty.
    """
    kind = df.schema[vector].dataType.simpleString()
    lists = F.col(vector) if kind in ("array<float>", "array<double>") else F.col(vector).cast("array<double>")
    rows = df.select(F.col(key).cast("long").alias("key"), lists.alias("v"))
    centroids = _starts(rows, k, dimensions, scale, seed)
    for _ in range(rounds if len(centroids) else 0):
        centroids = _moved(rows.select("v"), centroids, dimensions, scale)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for places, _, number, squared in _searched(batch, 1, dimensions, scale, centroids):
                held = [min(int(s), _LONG) for s in squared] if squared.dtype == object else squared
                columns = [batch.column(0).take(pa.array(places)), pa.array(number), pa.array(held, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["key", "cluster", "distance"])

    found = rows.limit(0).select("key", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
    if len(centroids):
        found = materialised(map_batches(rows, run, "key bigint, cluster int, distance bigint"))
    sums = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()
    total = min(_LONG, sum(int(row["s"]) for row in sums))
    digests = [sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    # One row a cluster, so this table is as small as ``k``.
    of = [(row["cluster"], min(_LONG, int(row["s"])), total, digests[row["cluster"]]) for row in sums]
    schema = "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    stats = F.broadcast(df.sparkSession.createDataFrame(of, schema))
    result = found.join(stats, "cluster")
    return result.select(
        F.col("key").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
