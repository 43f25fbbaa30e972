"""Encoding of categories. Fitted codes are a dictionary table (feature, category, code)."""

from __future__ import annotations

from pyspark.ml.feature import IndexToString, OneHotEncoder, StringIndexer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabflow.functions.expressions import first_match
from tabflow.functions.ordered import numbered
from tabflow.functions.state import entries, melt
from tabflow.operators.missing import PLACEHOLDER
from tabflow.sources.shared import persist_state

# Codes of the ordered categories.
CONTRACT_CODES = {"Month-to-month": 0, "One year": 1, "Two year": 2}
TENURE_CODES = {"New": 0, "Established": 1, "Loyal": 2}


def category_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, category, n) of all columns from one scan; NULL is the placeholder category."""
    long = melt(df, columns, name="feature", value="category", kind="string")
    long = long.select("feature", F.coalesce("category", F.lit(PLACEHOLDER)).alias("category"))
    return long.groupBy("feature", "category").agg(F.count("*").alias("n"))


def fit_index(df: DataFrame, columns: list[str]) -> DataFrame:
    """Dictionary (feature, category, code), most frequent first, ties in text order.

    The categories are numbered by range partitions, so a column with very many of them is
    never sorted in one task. The result is a written table.
    """
    counts = category_counts(df, columns)
    order = [F.col("feature"), F.col("n").desc(), F.col("category")]
    ranked = numbered(counts, order, "feature")
    return persist_state(ranked.select("feature", "category", F.col("position").cast("int").alias("code")), "codes")


def apply_index(df: DataFrame, dictionary: DataFrame, columns: list[str], unseen: str = "keep") -> DataFrame:
    """Add `<column>_index`; an unseen category gets the next free code, or NULL.

    The dictionary is a written table: the planner broadcasts it when its size allows and
    otherwise joins by sort-merge, where frequent categories are split as skewed keys.
    """
    for c in columns:
        one = dictionary.filter(F.col("feature") == c)
        codes = one.select(F.col("category").alias(f"__{c}"), F.col("code").alias(f"{c}_index"))
        category = F.coalesce(F.col(c).cast("string"), F.lit(PLACEHOLDER))
        df = df.join(codes, category == F.col(f"__{c}"), "left").drop(f"__{c}")
        if unseen == "keep":
            free = one.agg((F.max("code") + 1).alias("free")).scalar()
            df = df.withColumn(f"{c}_index", F.coalesce(f"{c}_index", free))
    return df


def decode_index(df: DataFrame, dictionary: DataFrame, column: str, output: str) -> DataFrame:
    """The category text of `<column>_index`."""
    one = dictionary.filter(F.col("feature") == column)
    names = one.select(F.col("code").alias("__code"), F.col("category").alias(output))
    return df.join(names, df[f"{column}_index"] == F.col("__code"), "left").drop("__code")


def lookup(c: Column, codes: dict[str, int], default: int | None = None) -> Column:
    """Code of a category by a fixed map; an unmapped one gets the default."""
    missing = F.lit(default).cast("int")
    return first_match([(c == category, F.lit(code)) for category, code in codes.items()], missing)


def encode_ordinal(
    df: DataFrame, maps: dict[str, dict[str, int]], unmapped: str = "null", default: int = 0
) -> DataFrame:
    """Replace ordered categories by their codes; unmapped ones become NULL, a default or an error."""
    if unmapped not in ("null", "default", "error"):
        raise ValueError(f"unknown policy {unmapped!r}")
    encoded = {}
    for c, codes in maps.items():
        if c not in df.columns:
            continue
        code = lookup(F.col(c), codes, default if unmapped == "default" else None)
        if unmapped == "error":
            message = F.concat(F.lit(f"unmapped category in {c}: "), F.coalesce(F.col(c), F.lit("NULL")))
            code = F.coalesce(code, F.raise_error(message).cast("int"))
        encoded[c] = code
    return df.withColumns(encoded)


def fixed_dictionary(df: DataFrame, maps: dict[str, dict[str, int]]) -> DataFrame:
    """The fixed maps in dictionary form, to be saved next to fitted ones."""
    records = [
        {"feature": F.lit(f), "category": F.lit(category), "code": F.lit(code)}
        for f, codes in maps.items()
        for category, code in codes.items()
    ]
    return entries(df.sparkSession.range(1), records)


def one_hot(df: DataFrame, column: str, categories: list[str]) -> DataFrame:
    """One 0/1 column per category, and one for all others (NULL included)."""
    named = {f"{column}_{c}": F.coalesce((F.col(column) == c).cast("int"), F.lit(0)) for c in categories}
    other = ~F.coalesce(F.col(column).isin(categories), F.lit(False))
    return df.withColumns({**named, f"{column}_other": other.cast("int")})


def fit_one_hot(df: DataFrame, columns: list[str], bound: int = 1000) -> dict[str, list[str]]:
    """The categories of each column by code, as `one_hot` wants them.

    Each category becomes a column, so they must be few: more than `bound` are an error.
    """
    codes = fit_index(df, columns)
    found = codes.orderBy("feature", "code").take(bound * len(columns) + 1)
    fitted = {c: [r["category"] for r in found if r["feature"] == c] for c in columns}
    if over := [c for c, names in fitted.items() if len(names) > bound] or (columns if len(found) > bound * len(columns) else []):
        raise ValueError(f"more than {bound} categories for one-hot columns: {over}")
    return {c: [n for n in names if n != PLACEHOLDER] for c, names in fitted.items()}


def one_hot_stage(columns: list[str]) -> OneHotEncoder:
    return OneHotEncoder(
        inputCols=[f"{c}_index" for c in columns], outputCols=[f"{c}_encoded" for c in columns], handleInvalid="keep"
    )


def target_stage(target: str, output: str = "label") -> StringIndexer:
    """Target text to 0.0 / 1.0 in text order (No before Yes); an unknown value is an error."""
    return StringIndexer(inputCol=target, outputCol=output, handleInvalid="error", stringOrderType="alphabetAsc")


def target_label(c: Column, positive: str) -> Column:
    return F.when(c.isNotNull(), (c == positive).cast("double"))


def decode_stage(column: str, output: str, labels: list[str]) -> IndexToString:
    return IndexToString(inputCol=column, outputCol=output, labels=labels)
