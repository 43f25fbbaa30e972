"""Exact top-k search: tiled matrix products of queries and shards, merged as a tree."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabflow.llm.common import named
from tabflow.sources.shared import persist_state

PARTIAL = "query_id long, tile long, vec_id long, score long"
EXACT = float(1 << 53)
SMALLEST, LARGEST = -(1 << 63), (1 << 63) - 1


def whole_vectors(table: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """Rows (vec_id, v): floor(scale * x) of every component as a double holding a whole number.

    A null key or vector, and a null, NaN or infinite component, leave the row out.
    """
    rows = table.select(named(key).cast("long").alias("vec_id"), named(vector).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & finite)
    return rows.withColumn("v", F.transform("v", lambda x: F.floor(x * scale).cast("double")))


def products(queries: np.ndarray, shard: np.ndarray) -> np.ndarray:
    """All inner products as 64-bit integers: by float matrix product while every sum is exact there. A sum
    beyond 64 bits is the nearest of them."""
    if not queries.shape[1]:
        return np.zeros((len(queries), len(shard)), np.int64)
    bound = np.abs(queries).max(initial=0) * np.abs(shard).max(initial=0) * queries.shape[1]
    if bound < EXACT:
        return (queries @ shard.T).astype(np.int64)
    exact = np.frompyfunc(int, 1, 1)
    sums = exact(queries).astype(object) @ exact(shard).astype(object).T
    return np.maximum(np.minimum(sums, LARGEST), SMALLEST).astype(np.int64)


def tile_top(queries: pd.DataFrame, shard: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best candidates of one shard for each query of one tile; ties to the smaller vec_id."""
    found = []
    shard = shard.sort_values("vec_id")
    ids, tile = shard["vec_id"].to_numpy(), shard["tile"].iloc[0]
    scores = products(np.stack(queries["v"].to_numpy()), np.stack(shard["v"].to_numpy()))
    for query, row in zip(queries["vec_id"].to_numpy(), scores):
        other = np.flatnonzero(ids != query)
        values = row[other]
        if len(values) > k:
            least = np.partition(values, len(values) - k)[len(values) - k]
            other = other[values >= least]
        best = other[np.lexsort((ids[other], -row[other]))][:k]
        found.append(pd.DataFrame({"query_id": query, "tile": tile, "vec_id": ids[best], "score": row[best]}))
    return pd.concat(found)


def top_k(
    table: DataFrame,
    is_query: Column,
    k: int = 5,
    key: str = "vec_id",
    vector: str = "embedding",
    scale: int = 256,
    query_rows: int = 1024,
    shard_rows: int = 4096,
    fan_in: int = 16,
) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): each query's k largest inner products over all rows.

    `is_query` is a condition on `vec_id`. Queries and candidates are dealt into tiles of a stated
    size; a task multiplies one tile of queries by one shard and keeps k per query, and the partial
    lists are merged `fan_in` shards at a time, so no task holds more than two tiles or `fan_in` lists
    of a query. Components and products beyond 64 bits are the nearest number that 64 bits hold. Only vectors of equal length are compared. Rows with the query's own id are no
    candidates; an id given to several query rows is answered once, by its smallest vector. Fewer than
    k candidates give all of them, an empty table gives no rows.
    """
    rows = persist_state(whole_vectors(table, key, vector, scale).withColumn("dim", F.size("v")), "vectors")
    n = rows.count()
    queries = rows.filter(is_query).groupBy("vec_id", "dim").agg(F.min("v").alias("v"))
    tiles = max(1, -(-queries.count() // query_rows))
    shards = max(1, -(-n // shard_rows))
    tile = F.pmod(F.xxhash64("vec_id"), F.lit(tiles)).alias("query_tile")
    shard = F.pmod(F.xxhash64("vec_id"), F.lit(shards)).alias("tile")
    asked = queries.select("vec_id", "v", "dim", tile, F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("tile"))
    held = rows.select("vec_id", "v", "dim", shard, F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))).alias("query_tile"))
    pair = ["dim", "query_tile", "tile"]

    def best(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({c: pd.Series(dtype="int64") for c in ("query_id", "tile", "vec_id", "score")})
        return tile_top(left, right, k)

    asked = asked.withColumn("tile", F.col("tile").cast("long"))
    fresh = [F.col(c).alias(c) for c in ("vec_id", "v", "dim", "tile")]  # ids apart from those of `asked`
    held = held.select(*fresh, F.col("query_tile").cast("long").alias("query_tile"))
    found = asked.groupBy(*pair).cogroup(held.groupBy(*pair)).applyInPandas(best, PARTIAL)
    while True:
        found = found.withColumn("tile", F.floor(F.col("tile") / fan_in))
        order = Window.partitionBy("query_id", "tile").orderBy(F.col("score").desc(), "vec_id")
        found = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        shards = -(-shards // fan_in)
        if shards == 1:
            return found.select("query_id", "rank", "vec_id", "score")
