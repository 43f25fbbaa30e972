"""Aggregates, profiles and quality checks: one pass over the table each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabflow.functions.expressions import NUMERIC, is_missing, known, numeric_columns
from tabflow.functions.ordered import exact_quantiles
from tabflow.functions.state import entries, melt
from tabflow.operators.scaling import fit_moments, moments_table

MISSING_SHARE_LIMIT = 0.5


def column_stats(df: DataFrame, column: str, exact: bool = True) -> DataFrame:
    """count, distinct count, min and max of a column."""
    distinct = F.countDistinct(column) if exact else F.approx_count_distinct(column, 0.02)
    return df.agg(
        F.count(column).alias("n"),
        distinct.alias("n_distinct"),
        F.min(column).alias("min_value"),
        F.max(column).alias("max_value"),
    )


def moments(df: DataFrame, columns: list[str]) -> DataFrame:
    return moments_table(fit_moments(df, columns))


def quantiles(df: DataFrame, columns: list[str], shares: list[float], exact: bool = False) -> DataFrame:
    """Long form (feature, position, value) of quantiles of all columns."""
    if exact:
        return exact_quantiles(df, columns, shares)
    found = df.agg(*[F.percentile_approx(known(df, c).cast("double"), shares, 10_000).alias(c) for c in columns])
    records = [
        {"feature": F.lit(c), "position": F.lit(i), "value": F.col(c)[i]}
        for c in columns
        for i in range(len(shares))
    ]
    return entries(found, records)


def describe(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Long form (feature, stat, value): count, mean, stddev, min and max of numeric columns."""
    columns = columns or numeric_columns(df)
    parts = []
    for c in columns:
        value = F.col(c).cast("double")
        parts += [
            F.count(value).cast("double").alias(f"{c}|count"),
            F.avg(value).alias(f"{c}|mean"),
            F.stddev_samp(value).alias(f"{c}|stddev"),
            F.min(value).alias(f"{c}|min"),
            F.max(value).alias(f"{c}|max"),
        ]
    stats = ("count", "mean", "stddev", "min", "max")
    return entries(
        df.agg(*parts),
        [
            {"feature": F.lit(c), "stat": F.lit(s), "value": F.col(f"`{c}|{s}`")}
            for c in columns
            for s in stats
        ],
    )


def share_of_total(counts: DataFrame, column: str = "n", output: str = "pct") -> DataFrame:
    """Add each row's percentage of the total; the total is a scalar subquery over the counts."""
    total = counts.agg(F.sum(column).alias("total")).scalar()
    return counts.withColumn(output, F.col(column).cast("double") * 100.0 / total)


def class_distribution(df: DataFrame, column: str) -> DataFrame:
    """(value, n, pct) of a column."""
    return share_of_total(df.groupBy(column).agg(F.count("*").alias("n")))


def bin_distribution(df: DataFrame, column: str, invalid: str = "Invalid") -> DataFrame:
    """Class distribution of a bin column, most frequent first, marking the invalid bin."""
    counted = class_distribution(df, column).withColumn("is_invalid", F.col(column) == invalid)
    return counted.orderBy(F.col("n").desc(), F.col(column))


def distinct_count(df: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, n_distinct) of several columns by one distinct over their long form."""
    long = melt(df, columns, kind="string").filter(F.col("value").isNotNull()).distinct()
    return long.groupBy("feature").agg(F.count("*").alias("n_distinct"))


def top_values(df: DataFrame, column: str, k: int = 10) -> DataFrame:
    """The k most frequent values; ties in value order. Each task keeps k rows only."""
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    return counts.orderBy(F.col("n").desc(), F.col(column)).limit(k)


# Timestamps to the microsecond, both kinds, so that rows that differ by one stay apart.
EXACT_JSON = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def row_digest(df: DataFrame) -> Column:
    """128-bit digest of a whole row; -0.0 equals 0.0 and NULL differs from empty text."""
    fields = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        fields.append((c + F.lit(0)).alias(f.name) if isinstance(f.dataType, NUMERIC) else c.alias(f.name))
    return F.unhex(F.md5(F.to_json(F.struct(*fields), EXACT_JSON)))


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row in all columns.

    Grouping by the digest shuffles 16 bytes per distinct row instead of the row; copies are
    merged before the shuffle.
    """
    counts = df.groupBy(row_digest(df).alias("digest")).agg(F.count("*").alias("n"))
    return counts.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"))


def profile_table(df: DataFrame) -> DataFrame:
    """Long form (feature, stat, value): rows, columns, and the numeric description."""
    columns = numeric_columns(df)
    described = describe(df, columns)
    shape = entries(
        df.agg(F.count("*").alias("n")),
        [
            {"feature": F.lit("*"), "stat": F.lit("rows"), "value": F.col("n").cast("double")},
            {"feature": F.lit("*"), "stat": F.lit("columns"), "value": F.lit(float(len(df.columns)))},
        ],
    )
    return shape.unionByName(described)


def table_types(df: DataFrame) -> DataFrame:
    """(position, column_name, type_name) from the schema; reads no rows."""
    records = [
        {"position": F.lit(i), "column_name": F.lit(name), "type_name": F.lit(kind)}
        for i, (name, kind) in enumerate(df.dtypes)
    ]
    return entries(df.sparkSession.range(1), records)


def profile_numeric(df: DataFrame, columns: list[str], exact: bool = False) -> DataFrame:
    """One row per column: NULLs, percentage, mean, stddev, min, max and quartiles."""
    parts = [F.count("*").alias("rows")]
    for c in columns:
        value = F.col(c).cast("double")
        parts.append(
            F.struct(
                F.count_if(F.col(c).isNull()).alias("nulls"),
                F.avg(value).alias("mean"),
                F.stddev_samp(value).alias("std"),
                F.min(value).alias("min"),
                F.max(value).alias("max"),
                *([] if exact else [F.percentile_approx(value, [0.25, 0.5, 0.75], 10_000).alias("q")]),
            ).alias(c)
        )
    records = []
    for c in columns:
        s = F.col(c)
        record = {
            "feature": F.lit(c),
            "dtype": F.lit(dict(df.dtypes)[c]),
            "null_count": s["nulls"],
            "null_pct": s["nulls"].cast("double") * 100.0 / F.col("rows"),
            "mean": s["mean"],
            "std": s["std"],
            "min": s["min"],
            "max": s["max"],
        }
        if not exact:
            record.update({name: s["q"][i] for i, name in enumerate(("q1", "median", "q3"))})
        records.append(record)
    profiled = entries(df.agg(*parts), records)
    if not exact:
        return profiled
    found = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    at = lambda p, name: F.max(F.when(F.col("position") == p, F.col("value"))).alias(name)
    wide = found.groupBy("feature").agg(at(0, "q1"), at(1, "median"), at(2, "q3"))
    return profiled.join(wide, "feature", "left")


def profile_categorical(df: DataFrame, column: str, k: int = 10) -> DataFrame:
    """The k most frequent values with the NULL count, its percentage and the distinct count.

    NULL counts as one distinct value. All of it comes from one count per value.
    """
    counts = df.groupBy(F.col(column).cast("string").alias("value")).agg(F.count("*").alias("n"))
    facts = counts.agg(
        F.struct(
            F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
            F.sum("n").alias("rows"),
            F.count("*").alias("distinct"),
        ).alias("facts")
    ).scalar()
    top = counts.orderBy(F.col("n").desc(), F.col("value")).limit(k)
    return top.select(
        F.lit(column).alias("feature"),
        F.lit(dict(df.dtypes)[column]).alias("dtype"),
        facts["nulls"].alias("null_count"),
        (facts["nulls"].cast("double") * 100.0 / facts["rows"]).alias("null_pct"),
        facts["distinct"].alias("n_distinct"),
        "value",
        "n",
    )


def quality_gate(df: DataFrame, target: str, share_limit: float = MISSING_SHARE_LIMIT) -> DataFrame:
    """Long form (metric, value) with rows, columns, missing, duplicates, class counts and verdict.

    The table fails when missing values exceed the share of rows; a missing target column is
    an error at plan time.
    """
    if target not in df.columns:
        raise ValueError(f"target column {target!r} not found")
    missing = sum((is_missing(df, c).cast("long") for c in df.columns), F.lit(0).cast("long"))
    cells = df.select(row_digest(df).alias("digest"), missing.alias("missing"), F.col(target).alias("target"))
    # one shuffle: distinct rows with their copies; everything else follows from these
    rows = cells.groupBy("digest").agg(
        F.count("*").alias("n"), F.sum("missing").alias("missing"), F.first("target").alias("target")
    )
    classes = rows.groupBy("target").agg(
        F.sum("n").alias("n"), F.sum("missing").alias("missing"), F.sum(F.col("n") - 1).alias("copies")
    )
    facts = classes.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("missing"), F.lit(0)).alias("missing"),
        F.coalesce(F.sum("copies"), F.lit(0)).alias("copies"),
    )
    passed = F.col("missing") <= F.col("rows") * share_limit
    summary = entries(
        facts,
        [
            {"metric": F.lit("total_rows"), "value": F.col("rows")},
            {"metric": F.lit("total_columns"), "value": F.lit(len(df.columns)).cast("long")},
            {"metric": F.lit("missing_values"), "value": F.col("missing")},
            {"metric": F.lit("duplicate_rows"), "value": F.col("copies")},
            {"metric": F.lit("passed"), "value": passed.cast("long")},
        ],
    )
    # reading every measure here lets both parts share one shuffle; the condition always holds
    per_class = classes.filter(F.col("n") + F.col("missing") + F.col("copies") > 0).select(
        F.concat(F.lit("target="), F.coalesce(F.col("target").cast("string"), F.lit("NULL"))).alias("metric"),
        F.col("n").alias("value"),
    )
    return summary.unionByName(per_class)


def stage_summary(
    df: DataFrame, dropped_missing: Column, dropped_outlier: Column, is_test: Column, target: str | None = None
) -> DataFrame:
    """Rows at each preparation step from one pass over the input, and the classes of both final parts.

    The steps are given as row predicates, so no step's table is counted by its own job.
    """
    kept = ~dropped_missing & ~dropped_outlier
    label = F.lit(None).cast("string") if target is None else F.coalesce(F.col(target).cast("string"), F.lit("NULL"))
    per_class = df.groupBy(label.alias("target")).agg(
        F.count("*").alias("initial"),
        F.count_if(dropped_missing).alias("missing"),
        F.count_if(~dropped_missing & dropped_outlier).alias("outliers"),
        F.count_if(kept & ~is_test).alias("train"),
        F.count_if(kept & is_test).alias("test"),
    )
    names = ("initial", "missing", "outliers", "train", "test")
    counted = per_class.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names])
    final = F.col("train") + F.col("test")
    ratio = F.when(final > 0, F.col("test").cast("double") / final)
    metrics = {
        "initial_rows": F.col("initial"),
        "rows_removed_missing": F.col("missing"),
        "rows_removed_outliers": F.col("outliers"),
        "final_train_rows": F.col("train"),
        "final_test_rows": F.col("test"),
        "test_split_ratio": ratio,
    }
    report = entries(counted, [{"metric": F.lit(n), "value": v.cast("double")} for n, v in metrics.items()])
    if target is None:
        return report
    # reading every count here lets both parts share one shuffle; the condition always holds
    seen = per_class.filter(sum(F.col(n) for n in names) > 0)
    cells = [
        F.struct(F.concat(F.lit(f"{part}_target="), F.col("target")).alias("metric"), F.col(part).cast("double").alias("value"))
        for part in ("train", "test")
    ]
    return report.unionByName(seen.select(F.inline(F.array(*cells))))


def inference_summary(df: DataFrame, prediction: str, probability: str) -> DataFrame:
    """One row: predictions, their mean, class counts, mean probability and risk bands."""
    p, y = F.col(probability), F.col(prediction)
    return df.agg(
        F.count("*").alias("num_predictions"),
        F.avg(y).alias("avg_prediction"),
        F.count_if(y == 1).alias("churn_count"),
        F.count_if(y != 1).alias("retain_count"),
        F.avg(p).alias("avg_probability"),
        F.count_if(p > 0.7).alias("high_risk"),
        F.count_if((p > 0.5) & (p <= 0.7)).alias("medium_risk"),
        F.count_if(p <= 0.5).alias("low_risk"),
    )
