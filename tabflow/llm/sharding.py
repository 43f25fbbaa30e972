"""Sharding by jump consistent hashing: a key and the number of shards decide, without a ring table."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabflow.llm.common import named, picked
from tabflow.sources.shared import persist_state

# Fixed value: the multiplier of the published generator (Lamping and Veach, 2014).
MULTIPLIER = np.uint64(2862933555777941757)


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each 64-bit key; all keys jump together until each has passed the last shard."""
    state = keys.astype(np.uint64)
    shard, ahead = np.zeros(len(state), np.int64), np.zeros(len(state), np.int64)
    moving = np.arange(len(state))
    while len(moving):
        shard[moving] = ahead[moving]
        state[moving] = state[moving] * MULTIPLIER + np.uint64(1)
        divisor = ((state[moving] >> np.uint64(33)) + np.uint64(1)).astype(np.float64)
        ahead[moving] = ((shard[moving] + 1) * (float(1 << 31) / divisor)).astype(np.int64)
        moving = moving[ahead[moving] < shards]
    return shard


def shard_of(key: Column, shards: int) -> Column:
    """The shard of a key of any type, from its 64-bit hash; one more shard takes keys only into itself."""
    if shards < 1:
        raise ValueError("shards must be at least 1")

    @F.pandas_udf("int")
    def jumped(hashes: pd.Series) -> pd.Series:
        return pd.Series(jump(hashes.to_numpy(np.int64).view(np.uint64), shards).astype(np.int32))

    return jumped(F.xxhash64(key))


def numbered(rows: DataFrame, order: Column, bucket_rows: int = 20_000) -> DataFrame:
    """Adds `slot`: 0, 1, ... within each `shard`, in the order of a 64-bit hash.

    Rows are counted per shard and hash interval; intervals hold about `bucket_rows` rows whatever the
    size of the table, so no shard is put in order by one task. Rows with equal hashes are equal rows
    for the caller; their slots are dealt in any order.
    """
    rows = persist_state(rows.withColumn("order_hash", order), "shards")
    largest = rows.groupBy("shard").count().agg(F.max("count")).first()[0] or 0
    bits = max(0, math.ceil(math.log2(max(1, largest / bucket_rows))))
    bucket = F.shiftrightunsigned("order_hash", 64 - bits) if bits else F.lit(0).cast("long")
    rows = rows.withColumn("bucket", bucket)
    counts = rows.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("bucket")) - F.col("n")
    offsets = counts.select("shard", "bucket", before.alias("offset"))
    place = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("order_hash")) - 1
    placed = rows.withColumn("place", place).join(offsets, ["shard", "bucket"])
    return placed.withColumn("slot", F.col("offset") + F.col("place")).drop("order_hash", "bucket", "place", "offset")


def shards_by_key(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (key, size, text_crc32, shard, grown_shard, slot), one per document.

    Size is the UTF-8 length plus 1, a null text counts as empty, null keys share a shard, repeated
    rows keep a slot each, an empty table gives no rows. `grown_shard` is the shard with one shard more.
    """
    raw = F.coalesce(F.col("text"), F.lit(""))
    rows = picked(docs, key=key, text=text).select(
        "key",
        (F.octet_length(raw) + 1).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
    )
    rows = rows.withColumn("shard", shard_of(F.col("key"), shards))
    rows = rows.withColumn("grown_shard", shard_of(F.col("key"), shards + 1))
    return numbered(rows, F.xxhash64("key", "text_crc32", "size"))


def write_shards(
    docs: DataFrame, path: str, shards: int, key: str = "doc_id", files_per_shard: int = 1, folder: str = "shard_folder"
) -> None:
    """The documents in one folder per shard, `folder=0` and so on; a shard's rows are dealt over
    `files_per_shard` tasks. No column of the documents may have the name of `folder`."""
    if folder in docs.columns:
        raise ValueError(f"the documents have a column {folder!r}; name another folder")
    spread = F.pmod(F.xxhash64(*[named(c) for c in docs.columns]), F.lit(files_per_shard))
    rows = docs.withColumn(folder, shard_of(named(key), shards))
    rows.repartition(shards * files_per_shard, named(folder), spread).write.partitionBy(folder).parquet(path)
