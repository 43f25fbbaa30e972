"""Splits that depend on the row key only: stable for any partitioning, retry or engine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabflow.functions.expressions import HASH_BUCKETS, hash_bucket, key_digest, leading_number
from tabflow.functions.ordered import digest_quota
from tabflow.functions.state import null_safe_join
from tabflow.operators.projection import features_target
from tabflow.sources.shared import persist_state

SPLIT_COLUMN = "split"


def assign_random(df: DataFrame, keys: list[str], test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """Add `split` = train or test by the key's bucket; a row-wise expression without a shuffle."""
    is_test = hash_bucket(keys, seed) < round(test_size * HASH_BUCKETS)
    return df.withColumn(SPLIT_COLUMN, F.when(is_test, "test").otherwise("train"))


def assign_three_way(
    df: DataFrame, keys: list[str], test_size: float = 0.2, validation_size: float = 0.2, seed: int = 42
) -> DataFrame:
    """Add `split` = train, validation or test."""
    bucket = hash_bucket(keys, seed)
    test = round(test_size * HASH_BUCKETS)
    both = test + round(validation_size * HASH_BUCKETS)
    part = F.when(bucket < test, "test").when(bucket < both, "validation").otherwise("train")
    return df.withColumn(SPLIT_COLUMN, part)


def assign_folds(df: DataFrame, keys: list[str], folds: int = 5, seed: int | str = "fold", output: str = "fold"):
    """Add an integer fold number, usable as the fold column of cross-validation."""
    return df.withColumn(output, (leading_number(key_digest(keys, seed), 8) % folds).cast("int"))


def fit_stratified(
    df: DataFrame, stratum: str, keys: list[str], test_size: float = 0.2, seed: int = 42
) -> DataFrame:
    """Per class (NULL is a class): rows, test quota floor(rows * size), and the last test digest.

    Rows are counted per class and leading digits of the digest with map-side sums, so a class with
    a third of all rows is no hot task. Key columns must identify a row. The result is a written table.
    """
    digests = df.select(stratum, key_digest(keys, seed).alias("digest"))
    found = digest_quota(digests, [stratum], lambda total: F.floor(total * F.lit(float(test_size))))
    return persist_state(found.withColumnRenamed("digest", "last_digest"), "strata")


ON_SMALL_CLASS = ("random", "quota", "error")


def assign_stratified(
    df: DataFrame,
    state: DataFrame,
    stratum: str,
    keys: list[str],
    test_size: float = 0.2,
    seed: int = 42,
    on_small_class: str = "random",
) -> DataFrame:
    """Add `split` with the exact quota in every class, and `split_rule`, the rule that was used.

    A class with fewer than 1 / test_size rows has no test row by its quota. What happens then is
    `on_small_class`: "random" splits all rows by the random rule, "quota" keeps the quotas as they
    are, "error" fails the query.
    """
    if on_small_class not in ON_SMALL_CLASS:
        raise ValueError(f"unknown on_small_class {on_small_class!r}; known: {ON_SMALL_CLASS}")
    smallest = state.agg(F.min("rows").alias("rows")).scalar()
    feasible = smallest >= max(1, int(1 / test_size))
    digest = key_digest(keys, seed)
    by_quota = F.coalesce(digest <= F.col("last_digest"), F.lit(False))
    by_bucket = hash_bucket(keys, seed) < round(test_size * HASH_BUCKETS)
    if on_small_class == "quota":
        feasible = F.lit(True)
    elif on_small_class == "error":
        problem = F.raise_error(F.lit(f"a class of {stratum} is too small for its quota")).cast("boolean")
        feasible = F.when(feasible, F.lit(True)).otherwise(problem)
    is_test: Column = F.when(feasible, by_quota).otherwise(by_bucket)
    joined = null_safe_join(df, state.select(stratum, "last_digest"), [stratum], "left")
    rule = F.when(feasible, "quota").otherwise("random")
    split = joined.withColumns({SPLIT_COLUMN: F.when(is_test, "test").otherwise("train"), "split_rule": rule})
    return split.drop("last_digest")


def part(df: DataFrame, name: str) -> DataFrame:
    return df.filter(F.col(SPLIT_COLUMN) == name).drop(SPLIT_COLUMN)


def train_test(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return part(df, "train"), part(df, "test")


def four_way(df: DataFrame, target: str, key: str) -> dict[str, DataFrame]:
    """Features and target of both parts; every table keeps the key."""
    train, test = train_test(df)
    (x_train, y_train), (x_test, y_test) = features_target(train, target, key), features_target(test, target, key)
    return {"X_train": x_train, "X_test": x_test, "Y_train": y_train, "Y_test": y_test}


def split_native(df: DataFrame, test_size: float = 0.2, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Spark's own random split; its rows depend on the input's partitioning."""
    train, test = df.randomSplit([1 - test_size, test_size], seed)
    return train, test
