"""Batch scoring: preprocessing by fitted state, model output columns, formats and bands."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabflow.functions.expressions import (
    blank_to_zero,
    confidence,
    numeric_text,
    percent,
    percent_text,
    prediction_label,
    risk_band,
    vector_get,
)
from tabflow.operators.binning import UNKNOWN, bin_custom
from tabflow.operators.encoding import encode_ordinal


def preprocess(
    df: DataFrame,
    charges: str,
    tenure: str,
    bins: dict,
    codes: dict[str, dict[str, int]],
    drop: list[str],
    blank_as_zero: bool = True,
    bin_output: str = "tenure_bin",
) -> DataFrame:
    """Text charges to double, tenure bin, ordinal codes (unmapped 0), and dropped columns."""
    number = blank_to_zero if blank_as_zero else numeric_text
    fixed = df.withColumn(charges, number(F.col(charges)))
    binned = bin_custom(fixed, tenure, bins, UNKNOWN, bin_output, keep=True)
    return encode_ordinal(binned, codes, unmapped="default", default=0).drop(*drop)


def output_columns(df: DataFrame, prediction: Column, probability: Column, stamp: bool = True) -> DataFrame:
    """Add label, probability and percentage, and the time of scoring."""
    columns = {
        "prediction_label": prediction_label(prediction),
        "churn_probability": probability,
        "confidence_percentage": percent(probability),
    }
    if stamp:
        columns["prediction_timestamp"] = F.current_timestamp()
    return df.withColumns(columns)


def score(df: DataFrame, model: PipelineModel, stamp: bool = True) -> DataFrame:
    """Apply a fitted model, with its preprocessing inside, to a table or a stream."""
    return output_columns(model.transform(df), F.col("prediction"), vector_get(F.col("probability"), 1), stamp)


def alias_output(df: DataFrame) -> DataFrame:
    """All columns, with prediction and probability once more under their output names."""
    return df.select(
        "*", F.col("prediction").alias("churn_prediction"), F.col("probability").alias("churn_probability")
    )


def formatted(df: DataFrame, prediction: Column, probability: Column) -> DataFrame:
    """Status, confidence text and both class percentages for every row."""
    return df.withColumns(
        {
            "status": prediction_label(prediction),
            "confidence_text": percent_text(probability),
            "retained_pct": percent(1 - probability),
            "churn_pct": percent(probability),
        }
    )


def risk_bands(df: DataFrame, probability: Column) -> DataFrame:
    return df.groupBy(risk_band(probability).alias("risk_band")).agg(F.count("*").alias("n"))


def with_confidence(df: DataFrame, probability: Column) -> DataFrame:
    return df.withColumn("confidence", confidence(probability))
