"""Fitted state: a one-row table read as a scalar, or a long table joined by its own size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def scalar_row(state: DataFrame) -> Column:
    """The single row of `state` as a struct column.

    It becomes an uncorrelated scalar subquery: no join, nothing on the driver, and equal
    subqueries of a plan run once. More than one row is an error.
    """
    return state.select(F.struct(*[F.col(f"`{c}`") for c in state.columns]).alias("row")).scalar()


STATE = "_state"


def with_state(df: DataFrame, state: DataFrame) -> DataFrame:
    """Add the single row of `state` as the struct column `_state`: one subquery to plan, however
    many of its fields the following projection uses and then drops."""
    return df.withColumn(STATE, scalar_row(state))


def entries(row: DataFrame, records: list[dict[str, Column]]) -> DataFrame:
    """One output row per record from a single aggregate row, without a shuffle."""
    structs = [F.struct(*[value.alias(name) for name, value in r.items()]) for r in records]
    return row.select(F.inline(F.array(*structs)))


def melt(df: DataFrame, columns: list[str], keep: list[str] = (), name="feature", value="value", kind="double"):
    """Long form (keep..., feature, value) of some columns, cast to one type, read in one scan."""
    cast = [F.col(c).cast(kind).alias(c) for c in columns]
    return df.select(*keep, *cast).unpivot(list(keep), columns, name, value)


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join in which a NULL key matches a NULL key; the right copies of the keys are dropped."""
    renamed = right.select(*[F.col(c).alias(f"__{c}") if c in keys else F.col(c) for c in right.columns])
    condition = None
    for k in keys:
        same = left[k].eqNullSafe(renamed[f"__{k}"])
        condition = same if condition is None else condition & same
    return left.join(renamed, condition, how).drop(*[f"__{k}" for k in keys])
