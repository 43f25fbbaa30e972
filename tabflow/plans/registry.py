"""The catalogue: each query is a callable (spark, folder) -> DataFrame with its SQL twin."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str | None


CATALOGUE: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    def register(run: Run) -> Run:
        if name in CATALOGUE:
            raise ValueError(f"query {name!r} is registered twice")
        CATALOGUE[name] = Query(run, sql)
        return run

    return register


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """All double columns rounded, so that engines can be compared."""
    return df.select(
        *[F.round(F.col(f"`{c}`"), digits).alias(c) if t == "double" else F.col(f"`{c}`") for c, t in df.dtypes]
    )
