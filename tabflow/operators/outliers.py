"""Outlier bounds, flags, removal and capping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabflow.functions.expressions import clip, known, outside
from tabflow.functions.ordered import exact_quantiles
from tabflow.functions.state import STATE, entries, with_state

IQR_FACTOR = 1.5
Z_LIMIT = 3.0


def _bounds(q1: Column, q3: Column, factor: float) -> Column:
    spread = (q3 - q1) * factor
    return F.struct(q1.alias("q1"), q3.alias("q3"), (q1 - spread).alias("lower"), (q3 + spread).alias("upper"))


def fit_iqr(df: DataFrame, columns: list[str], factor: float = IQR_FACTOR, exact: bool = False) -> DataFrame:
    """One row; per column a struct (q1, q3, lower, upper).

    Approximate quartiles come from one aggregate with a bounded summary; exact ones from
    distributed order statistics.
    """
    if exact:
        found = exact_quantiles(df, columns, [0.25, 0.75])
        at = lambda c, p: F.max(F.when((F.col("feature") == c) & (F.col("position") == p), F.col("value")))
        return found.agg(*[_bounds(at(c, 0), at(c, 1), factor).alias(c) for c in columns])
    quartiles = df.agg(
        *[F.percentile_approx(known(df, c).cast("double"), [0.25, 0.75], 10_000).alias(c) for c in columns]
    )
    return quartiles.select(*[_bounds(F.col(c)[0], F.col(c)[1], factor).alias(c) for c in columns])


def fit_zscore(df: DataFrame, columns: list[str], limit: float = Z_LIMIT) -> DataFrame:
    """One row; per column a struct (mean, std, lower, upper) for |x - mean| <= limit * std."""
    moments = df.agg(
        *[
            F.struct(F.avg(known(df, c)).alias("mean"), F.stddev_samp(known(df, c)).alias("std")).alias(c)
            for c in columns
        ]
    )
    return moments.select(
        *[
            F.struct(
                F.col(c)["mean"].alias("mean"),
                F.col(c)["std"].alias("std"),
                (F.col(c)["mean"] - limit * F.col(c)["std"]).alias("lower"),
                (F.col(c)["mean"] + limit * F.col(c)["std"]).alias("upper"),
            ).alias(c)
            for c in columns
        ]
    )


def bounds_table(state: DataFrame) -> DataFrame:
    """Long form (feature, lower, upper) of fitted bounds."""
    return entries(
        state,
        [{"feature": F.lit(c), "lower": F.col(c)["lower"], "upper": F.col(c)["upper"]} for c in state.columns],
    )


def flag(df: DataFrame, state: DataFrame) -> DataFrame:
    """Add a boolean `<column>_outlier` for every column of the state."""
    flags = {f"{c}_outlier": _is_outside(c) for c in state.columns}
    return with_state(df, state).withColumns(flags).drop(STATE)


def _is_outside(column: str) -> Column:
    bounds = F.col(STATE)[column]
    return outside(F.col(column), bounds["lower"], bounds["upper"])


def remove(df: DataFrame, state: DataFrame, min_outliers: int = 2) -> DataFrame:
    """Keep rows with fewer than `min_outliers` values outside the bounds."""
    flags = sum((_is_outside(c).cast("int") for c in state.columns), F.lit(0))
    return with_state(df, state).filter(flags < min_outliers).drop(STATE)


def cap(df: DataFrame, state: DataFrame) -> DataFrame:
    """Clamp every column of the state to its bounds."""
    row = F.col(STATE)
    capped = {c: clip(F.col(c), row[c]["lower"], row[c]["upper"]) for c in state.columns}
    return with_state(df, state).withColumns(capped).drop(STATE)


def handle(df: DataFrame, state: DataFrame, method: str = "remove", min_outliers: int = 2) -> DataFrame:
    if method == "remove":
        return remove(df, state, min_outliers)
    if method == "cap":
        return cap(df, state)
    raise ValueError(f"unknown outlier handling method {method!r}")
