"""Scaling of numeric columns and assembly of feature vectors."""

from __future__ import annotations

from pyspark.ml.feature import MinMaxScaler, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabflow.functions.expressions import known
from tabflow.functions.state import STATE, entries, with_state


def fit_moments(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row; per column a struct (min, max, mean, std) with the sample deviation, one pass."""
    parts = []
    for c in columns:
        value = known(df, c).cast("double")
        parts.append(
            F.struct(
                F.min(value).alias("min"),
                F.max(value).alias("max"),
                F.avg(value).alias("mean"),
                F.stddev_samp(value).alias("std"),
            ).alias(c)
        )
    return df.agg(*parts)


def moments_table(state: DataFrame) -> DataFrame:
    """Long form (feature, min, max, mean, std)."""
    return entries(
        state,
        [
            {"feature": F.lit(c), **{s: F.col(c)[s] for s in ("min", "max", "mean", "std")}}
            for c in state.columns
        ],
    )


def scale_minmax(df: DataFrame, state: DataFrame, low: float = 0.0, high: float = 1.0) -> DataFrame:
    """Scale to [low, high] by the fitted range; a constant column becomes the midpoint."""
    row = F.col(STATE)
    scaled = {}
    for c in state.columns:
        value, span = F.col(c).cast("double"), row[c]["max"] - row[c]["min"]
        scaled[c] = (
            F.when(value.isNull(), value)
            .when(span == 0, F.lit((low + high) / 2))
            .otherwise((value - row[c]["min"]) / span * (high - low) + low)
        )
    return with_state(df, state).withColumns(scaled).drop(STATE)


def scale_standard(df: DataFrame, state: DataFrame, with_mean: bool = True, with_std: bool = True) -> DataFrame:
    """Subtract the mean and divide by the sample deviation; a constant column becomes 0."""
    row = F.col(STATE)
    scaled = {}
    for c in state.columns:
        value = F.col(c).cast("double")
        centred = value - row[c]["mean"] if with_mean else value
        if with_std:
            centred = (
                F.when(value.isNull(), value).when(row[c]["std"] == 0, F.lit(0.0)).otherwise(centred / row[c]["std"])
            )
        scaled[c] = centred
    return with_state(df, state).withColumns(scaled).drop(STATE)


def assemble(df: DataFrame, columns: list[str], invalid: str = "keep", output: str = "features") -> DataFrame:
    """One vector column; invalid rows (NULL or NaN) are kept as NaN, skipped, or an error."""
    return VectorAssembler(inputCols=columns, outputCol=output, handleInvalid=invalid).transform(df)


def vector_scaler(source: str = "features_unscaled", output: str = "features") -> MinMaxScaler:
    return MinMaxScaler(inputCol=source, outputCol=output)
