"""Binning of numeric columns into labelled ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabflow.functions.expressions import first_match

# Tenure bins in months and the label outside all bins.
TENURE_BINS = {"New": [0, 24], "Established": [25, 48], "Loyal": [49, 72]}
INVALID = "Invalid"
UNKNOWN = "Unknown"


def bin_label(c: Column, bins: dict[str, list[float]], default: str = INVALID) -> Column:
    """First bin that holds the value, both ends included; one number means no upper end."""
    branches = []
    for label, ends in bins.items():
        inside = (c >= ends[0]) if len(ends) == 1 else c.between(ends[0], ends[1])
        # Spark orders NaN above all numbers, so an open end would hold it
        branches.append((inside & ~F.isnan(c.cast("double")), F.lit(label)))
    return first_match(branches, F.lit(default))


def bin_custom(
    df: DataFrame, column: str, bins: dict, default: str = INVALID, output: str | None = None, keep: bool = False
) -> DataFrame:
    """Add `<column>Bins`; the column itself goes unless `keep`. The same for train and score."""
    binned = df.withColumn(output or f"{column}Bins", bin_label(F.col(column), bins, default))
    return binned if keep else binned.drop(column)


def bucket_number(c: Column, splits: list[float]) -> Column:
    """Index of the half-open range [a, b) that holds the value, the last one closed, else NULL."""
    value = c.cast("double")
    last = len(splits) - 2
    branches = []
    for i in range(last + 1):
        upper = (value <= splits[i + 1]) if i == last else (value < splits[i + 1])
        branches.append(((value >= splits[i]) & upper, F.lit(float(i))))
    return first_match(branches, F.lit(None).cast("double"))


def bin_buckets(
    df: DataFrame,
    column: str,
    splits: list[float],
    labels: list[str] | None = None,
    handle_invalid: str = "keep",
    keep: bool = False,
) -> DataFrame:
    """Add `<column>Bins` by split points, as labels or as a bucket number.

    A value outside the splits, NULL or NaN: `keep` puts it into an extra bucket (label
    "Unknown"), `skip` drops the row, `error` fails the query.
    """
    if handle_invalid not in ("keep", "skip", "error"):
        raise ValueError(f"unknown handle_invalid {handle_invalid!r}")
    output = f"{column}Bins"
    extra = float(len(splits) - 1)
    number = bucket_number(F.col(column), splits)
    if handle_invalid == "error":
        message = F.concat(F.lit(f"{column} outside the splits: "), F.coalesce(F.col(column).cast("string"), F.lit("NULL")))
        number = F.coalesce(number, F.raise_error(message).cast("double"))
    elif handle_invalid == "skip":
        df = df.filter(number.isNotNull())
    else:
        number = F.coalesce(number, F.lit(extra))
    if labels:
        number = first_match([(number == float(i), F.lit(text)) for i, text in enumerate(labels)], F.lit(UNKNOWN))
    binned = df.withColumn(output, number)
    return binned if keep else binned.drop(column)
