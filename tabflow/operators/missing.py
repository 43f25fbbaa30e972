"""Dropping and filling missing values."""

from __future__ import annotations

from pyspark.ml.feature import Imputer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabflow.functions.expressions import is_missing, known, numeric_columns
from tabflow.functions.ordered import exact_quantiles
from tabflow.functions.state import STATE, entries, with_state

PLACEHOLDER = "MISSING"
METHODS = ("mean", "median", "mode")


def drop_missing(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Drop rows with NULL or NaN in the critical columns; in any column if none are named."""
    return df.dropna(subset=columns or None)


def column_modes(df: DataFrame, columns: list[str]) -> DataFrame:
    """Most frequent known value per column (feature, value, n); ties go to the smaller value.

    One scan and one count for all columns; `max_by` keeps one value per column.
    """
    pairs = [F.struct(F.lit(c).alias("feature"), known(df, c).cast("string").alias("value")) for c in columns]
    counts = df.select(F.inline(F.array(*pairs))).filter(F.col("value").isNotNull())
    counts = counts.groupBy("feature", "value").agg(F.count("*").alias("n"))
    best = F.min_by(F.struct("value", "n"), F.struct(-F.col("n"), F.col("value")))
    return counts.groupBy("feature").agg(best.alias("b")).select("feature", "b.value", "b.n")


def fit_fill(df: DataFrame, columns: list[str], method: str = "mean", exact: bool = False) -> DataFrame:
    """One row holding the fill value of each column.

    `exact` gives the lower median from distributed order statistics; otherwise the median
    is the approximate percentile with a bounded summary.
    """
    if method not in METHODS:
        raise ValueError(f"unknown fill method {method!r}")
    if method == "mean":
        return df.agg(*[F.avg(known(df, c)).alias(c) for c in columns])
    if method == "median" and not exact:
        return df.agg(*[F.percentile_approx(known(df, c), 0.5, 10_000).alias(c) for c in columns])
    if method == "median":
        found = exact_quantiles(df, columns, [0.5])
    else:
        found = column_modes(df, columns)
    kinds = dict(df.dtypes)
    picked = [F.max(F.when(F.col("feature") == c, F.col("value"))).cast(kinds[c]).alias(c) for c in columns]
    return found.agg(*picked)


def apply_fill(df: DataFrame, state: DataFrame) -> DataFrame:
    """Fill every column that the state holds; works on a stream too."""
    row = F.col(STATE)
    return with_state(df, state).withColumns({c: F.coalesce(known(df, c), row[c]) for c in state.columns}).drop(STATE)


def fill_constant(df: DataFrame, value, columns: list[str] | None = None) -> DataFrame:
    """Fill with a literal: the named columns, or all columns of the literal's type."""
    return df.fillna(value, subset=columns)


def fill_all_numeric(df: DataFrame, method: str = "mean") -> DataFrame:
    """Fill every numeric column from one aggregate; any method but median means mean."""
    method = "median" if method == "median" else "mean"
    return apply_fill(df, fit_fill(df, numeric_columns(df), method))


def imputer(df: DataFrame, method: str = "mean") -> Imputer:
    """The same as a pipeline stage that replaces the columns."""
    columns = numeric_columns(df)
    return Imputer(inputCols=columns, outputCols=columns, strategy="median" if method == "median" else "mean")


def placeholder(df: DataFrame, columns: list[str], text: str = PLACEHOLDER) -> DataFrame:
    """NULL in nominal columns becomes a category of its own."""
    return df.fillna(text, subset=columns)


def missing_counts(df: DataFrame, total: str = "TOTAL") -> DataFrame:
    """(column_name, missing_count) for every column and in total, from one pass."""
    counted = df.agg(*[F.count_if(is_missing(df, c)).alias(c) for c in df.columns])
    whole: Column = sum((F.col(f"`{c}`") for c in df.columns), F.lit(0).cast("long"))
    records = [{"column_name": F.lit(c), "missing_count": F.col(f"`{c}`")} for c in df.columns]
    return entries(counted, [*records, {"column_name": F.lit(total), "missing_count": whole}])
