"""Scalar column expressions. All of them stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text accepted as a number, label texts, and the score cut-offs.
NUMERIC_TEXT = r"^[0-9.]+$"
POSITIVE_LABEL, NEGATIVE_LABEL = "Churn", "Retained"
HIGH_RISK, MEDIUM_RISK = 0.7, 0.5
CONFIDENT_DISTANCE = 0.3

FLOATING = (T.FloatType, T.DoubleType)
NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)

HASH_BUCKETS = 10_000


def present(df: DataFrame, columns: list[str]) -> list[str]:
    """The requested columns that the table has, in the requested order."""
    return [c for c in columns if c in df.columns]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def is_missing(df: DataFrame, column: str) -> Column:
    """NULL, an empty string, or NaN; each test only where the type has it."""
    c, kind = F.col(column), df.schema[column].dataType
    if isinstance(kind, FLOATING):
        return c.isNull() | F.isnan(c)
    if isinstance(kind, T.StringType):
        return c.isNull() | (c == "")
    return c.isNull()


def known(df: DataFrame, column: str) -> Column:
    """The value, with every kind of missing turned into NULL."""
    return F.when(~is_missing(df, column), F.col(column))


def numeric_text(c: Column, pattern: str = NUMERIC_TEXT) -> Column:
    """Text as double; NULL where the text is not a number."""
    text = F.trim(c)
    return F.when(text.rlike(pattern), text.try_cast("double"))


def blank_to_zero(c: Column) -> Column:
    """Text as double, reading a blank as 0.0 and any other non-number as NULL."""
    text = F.trim(c)
    return F.when(text == "", F.lit(0.0)).otherwise(text.try_cast("double"))


def outside(c: Column, lower: Column, upper: Column) -> Column:
    """Strictly outside the bounds; a NULL or NaN value is never outside."""
    value = c.cast("double")
    return F.coalesce(~F.isnan(value) & ((value < lower) | (value > upper)), F.lit(False))


def clip(c: Column, lower: Column, upper: Column) -> Column:
    """Clamp to the bounds, leaving NULL and NaN as they are."""
    value = c.cast("double")
    return (
        F.when(value.isNull() | F.isnan(value), value)
        .when(value < lower, lower)
        .when(value > upper, upper)
        .otherwise(value)
    )


def first_match(branches: list[tuple[Column, Column]], default: Column) -> Column:
    """CASE WHEN over the branches in order, with a default."""
    (condition, value), *rest = branches
    chain = F.when(condition, value)
    for condition, value in rest:
        chain = chain.when(condition, value)
    return chain.otherwise(default)


def prediction_label(prediction: Column) -> Column:
    return F.when(prediction == 1.0, POSITIVE_LABEL).otherwise(NEGATIVE_LABEL)


def percent(probability: Column) -> Column:
    return F.round(probability * 100, 2)


def percent_text(probability: Column) -> Column:
    return F.format_string("%d%%", F.round(probability * 100).cast("long"))


def confidence(probability: Column) -> Column:
    return F.when(F.abs(probability - 0.5) > CONFIDENT_DISTANCE, "high").otherwise("medium")


def risk_band(probability: Column) -> Column:
    return (
        F.when(probability.isNull(), F.lit(None).cast("string"))
        .when(probability > HIGH_RISK, "high")
        .when(probability > MEDIUM_RISK, "medium")
        .otherwise("low")
    )


def vector_get(vector: Column, position: int) -> Column:
    return vector_to_array(vector)[position]


def date_in_name(path: Column, prefix: str) -> Column:
    """The date of `<prefix>_YYYY-MM-DD.` inside a path; NULL where there is none."""
    return F.try_to_date(F.regexp_extract(path, prefix + r"_(\d{4}-\d{2}-\d{2})\.", 1), "yyyy-MM-dd")


def key_digest(keys: list[str], seed: int | str) -> Column:
    """md5 of the key, the same on every engine and for every partitioning.

    Every part is written with its length and NULL as a mark, so different keys have different texts.
    """
    texts = [F.col(k).cast("string") for k in keys]
    parts = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit("="), t), F.lit("~")) for t in texts]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *parts))


def leading_number(digest: Column, digits: int) -> Column:
    """The first hexadecimal digits as a number: uniform, and ordered like the digest."""
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("long")


def hash_bucket(keys: list[str], seed: int | str = 42, buckets: int = HASH_BUCKETS) -> Column:
    """A uniform bucket number that depends on the key alone."""
    return leading_number(key_digest(keys, seed), 8) % buckets
