"""What the vector searches share: clean vectors, tiles of rows and queries, merging."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from eventlake.llm.common import hash_slot, materialised, sampled_share

#: A tile compares at most about so many rows with so many queries, which bounds a task's memory.
TILE_ROWS = 4096
TILE_QUERIES = 1024
#: Vectors that an index or a rotation is fitted on, at most about.
SAMPLE_ROWS = 5000


def clean_vectors(df: DataFrame, key: str, vector: str, zero: bool = True) -> DataFrame:
    """(vec_id, v, d): one row per key, without vectors that take no part.

    Left out are null keys, null vectors and those holding null or non-finite components,
    and zero vectors unless ``zero``. Of a key that repeats, the smallest vector stays.
    Other columns of ``df`` are ignored, whatever their names.
    """
    v = F.col(vector).cast("array<double>")
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    keep = F.col(key).isNotNull() & v.isNotNull() & ~odd
    if not zero:
        keep &= F.exists(v, lambda x: x != 0)
    rows = df.filter(keep).select(F.col(key).cast("long").alias("vec_id"), v.alias("v"))
    return rows.groupBy("vec_id").agg(F.min("v").alias("v")).withColumn("d", F.size("v"))


def sample(rows: DataFrame, count: int) -> dict[int, np.ndarray]:
    """About ``SAMPLE_ROWS`` vectors by hash of the key, as a matrix for each dimension."""
    share = sampled_share(count, SAMPLE_ROWS)
    found = rows.filter(hash_slot(F.col("vec_id"), F.lit("sample")) <= share).select("d", "v").toPandas()
    return {int(d): np.stack(part["v"].to_numpy()) for d, part in found.groupby("d") if d}


def matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def tiled_search(
    rows: DataFrame,
    queries: DataFrame,
    count: int,
    asked: int,
    kernel: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame],
    score: str,
    block_queries: int | None = None,
) -> DataFrame:
    """(query_id, vec_id, score) that ``kernel`` finds in each tile of rows and ``block_queries`` (``TILE_QUERIES``) queries.

    Rows are dealt evenly to shards by key, queries to blocks; each pair of a shard and a
    block of equal dimension is one task's group, of bounded size. With one block every
    row is shuffled once; beyond, once per block, as comparing all with all requires.
    """
    shards, blocks = max(1, -(-count // TILE_ROWS)), max(1, -(-asked // (block_queries or TILE_QUERIES)))
    part = lambda n: F.pmod(F.xxhash64("vec_id", F.lit("tile")), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = rows.select("*", part(shards).alias("shard"), every(blocks).alias("block"))
    right = queries.select("*", part(blocks).alias("block"), every(shards).alias("shard"))
    tiles = ["d", "shard", "block"]
    return (
        left.groupBy(*tiles)
        .cogroup(right.groupBy(*tiles))
        .applyInPandas(kernel, f"query_id bigint, vec_id bigint, score {score}")
    )


def best(found: DataFrame, k: int, order: Column) -> DataFrame:
    """The first ``k`` of each query by ``order``, ties to the smaller vec_id, with their rank."""
    window = Window.partitionBy("query_id").orderBy(order, "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def prepared(df: DataFrame, key: str, vector: str, every: int, zero: bool) -> tuple:
    """Clean rows (written once), queries, and how many there are of each."""
    rows = materialised(clean_vectors(df, key, vector, zero))
    queries = rows.filter(F.col("vec_id") % every == 0)
    asked = F.count_if(F.col("vec_id") % every == 0)
    count, asked = rows.agg(F.count("*"), asked).first()
    return rows, queries, count, asked
