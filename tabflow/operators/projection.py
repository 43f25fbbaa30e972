"""Projections, filters, set operations and samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabflow.functions.expressions import HASH_BUCKETS, hash_bucket, key_digest, present
from tabflow.functions.ordered import digest_quota
from tabflow.functions.state import scalar_row


def features_target(df: DataFrame, target: str, key: str) -> tuple[DataFrame, DataFrame]:
    """Features (all but the target) and target; both keep the key, so rows stay linked."""
    return df.drop(target), df.select(key, target)


def drop_present(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.drop(*columns)


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast the named columns that exist; a value that does not convert becomes NULL."""
    return df.withColumns({c: F.col(c).try_cast(types[c]) for c in present(df, list(types))})


def require(df: DataFrame, columns: list[str]) -> None:
    """Raise for absent columns; reads the schema only."""
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"missing columns: {absent}")


def in_range(c: Column, lower, upper) -> Column:
    return c.between(lower, upper)


def distinct_values(df: DataFrame, columns: list[str], name: str = "value") -> DataFrame:
    """Distinct values found in any of the columns, in one scan and one shuffle."""
    return df.select(F.explode(F.array(*[F.col(c) for c in columns])).alias(name)).distinct()


def without(df: DataFrame, taken: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of `df` whose key is not in `taken`; duplicates in `df` stay."""
    return df.join(taken.select(*keys), keys, "left_anti")


def sample_fraction(df: DataFrame, fraction: float, keys: list[str], seed: int = 42) -> DataFrame:
    """A sample that depends on the key only: the same rows for every partitioning."""
    return df.filter(hash_bucket(keys, seed) < round(fraction * HASH_BUCKETS))


def sample_rows(df: DataFrame, n: int, keys: list[str], seed: int = 42) -> DataFrame:
    """Exactly n rows (all, if there are fewer), chosen by the digest of a unique key.

    The digest of the n-th row is found from bucket counts, so nothing is sorted as a whole
    and any n works. Key columns must identify a row.
    """
    if n <= 0:
        return df.limit(0)
    digest = key_digest(keys, seed)
    rows = df.select(F.lit(0).alias("g"), digest.alias("digest"))
    last = scalar_row(digest_quota(rows, ["g"], lambda total: F.lit(n)).select("digest"))["digest"]
    return df.filter(digest <= last)
