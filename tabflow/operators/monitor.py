"""Monitoring: windows, performance against truth, reports, freshness and the run log."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabflow.functions.state import entries
from tabflow.operators.evaluate import area_roc, binary_from_counts, curve, limits
from tabflow.sources.files import save
from tabflow.sources.shared import persist_state

# Accepted performance, the window, and the allowed age of data.
PERFORMANCE_THRESHOLDS = {"accuracy": 0.85, "f1_score": 0.80, "precision": 0.78, "recall": 0.82}
WINDOW_DAYS, BASELINE_DAYS = 7, 30
FRESHNESS_HOURS = 24.0

# Recommendations (kind, priority, message, action).
DRIFT_ADVICE = (
    "data_drift",
    "high",
    "Significant data drift detected. Consider retraining the model with recent data.",
    "retrain_model",
)
PERFORMANCE_ADVICE = (
    "performance_degradation",
    "high",
    "Model performance has degraded below acceptable thresholds.",
    "investigate_and_retrain",
)
ALL_WELL = ("status", "info", "Model is performing within acceptable parameters.", "continue_monitoring")


def last_days(df: DataFrame, time: str, end: Column, days: int = WINDOW_DAYS) -> DataFrame:
    """Rows dated from `days` before the end date up to the end date.

    The end is a literal date, so on a table partitioned by it whole folders are pruned.
    """
    day = F.to_date(time)
    return df.filter(day.between(F.date_sub(end, days), end))


def baseline_days(
    df: DataFrame, time: str, end: Column, days: int = BASELINE_DAYS, window: int = WINDOW_DAYS
) -> DataFrame:
    """Rows of the `days` before the monitoring window that `last_days` reads: the two never overlap."""
    day, first = F.to_date(time), F.date_sub(end, window)
    return df.filter(day.between(F.date_sub(first, days), F.date_sub(first, 1)))


def with_truth(predictions: DataFrame, truth: DataFrame, keys: list[str]) -> DataFrame:
    """Predictions joined to ground truth by key; repeated keys multiply."""
    return predictions.join(truth, keys, "inner")


def truth_cells(
    predictions: DataFrame, truth: DataFrame, keys: list[str], label: str, prediction: str, score: str
) -> DataFrame:
    """(prediction, score, pos, neg): positive and negative truths per distinct prediction.

    Truth is first reduced to one row per key and written, so a repeated key adds counts and
    no pairs of rows are made; the planner then knows its size and broadcasts it or joins by
    sort-merge, where a key with very many predictions is split as skewed.
    """
    per_key = truth.groupBy(*keys).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg")
    )
    called = predictions.select(*keys, F.col(prediction).alias("prediction"), F.col(score).alias("score"))
    joined = called.join(persist_state(per_key, "truth"), keys, "inner")
    return joined.groupBy("prediction", "score").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def performance(
    predictions: DataFrame, truth: DataFrame, keys: list[str], label: str, prediction: str, score: str
) -> DataFrame:
    """Long form (metric, value): accuracy, positive-class metrics, auc and the sample count.

    All metrics come from one table of cells, so predictions and truth are joined once.
    """
    return performance_of_cells(persist_state(truth_cells(predictions, truth, keys, label, prediction, score), "cells"))


def bucketed_cells(
    predictions: DataFrame, truth: DataFrame, keys: list[str], label: str, prediction: str, score: str
) -> DataFrame:
    """`truth_cells` of two tables stored in equal buckets of the keys: no exchange before the cells.

    Truth is reduced to a row per key inside its buckets. A bucket is one task, so keys must identify a
    prediction about once; a key with very many predictions belongs into `truth_cells`.
    """
    per_key = truth.groupBy(*keys).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg")
    )
    called = predictions.select(*keys, F.col(prediction).alias("prediction"), F.col(score).alias("score"))
    joined = called.hint("merge").join(per_key, keys, "inner")
    return joined.groupBy("prediction", "score").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def performance_of_cells(cells: DataFrame) -> DataFrame:
    """The report of `performance` from a written table of cells."""
    row = binary_from_counts(cells)
    names = ("accuracy", "f1_score", "precision", "recall", "num_samples")
    report = entries(row, [{"metric": F.lit(n), "value": F.col(n).cast("double")} for n in names])
    ranked = lambda c: F.when(F.col("score").isNotNull(), F.col(c)).otherwise(0)
    counts = cells.groupBy(F.lit("model").alias("model"), "score")
    counts = counts.agg(F.sum(ranked("pos")).alias("pos"), F.sum(ranked("neg")).alias("neg"))
    area = area_roc(curve(counts)).select(F.lit("auc").alias("metric"), F.col("auc_roc").alias("value"))
    return report.unionByName(area)


def performance_issues(metrics: DataFrame, thresholds: dict[str, float] = PERFORMANCE_THRESHOLDS) -> DataFrame:
    """(metric, value, threshold, degradation, degraded) of the watched metrics."""
    joined = limits(metrics, thresholds).join(metrics, "metric")
    gap = F.col("threshold") - F.col("value")
    return joined.select(
        "metric",
        "value",
        "threshold",
        F.when(gap > 0, gap).alias("degradation"),
        (gap > 0).alias("degraded"),
    )


def report(drift: DataFrame, issues: DataFrame) -> DataFrame:
    """Recommendations with the alert level: critical (performance) over warning (drift) over info.

    `drift` is the one row of `drift_score`, `issues` the table of `performance_issues`.
    """
    drifted = drift.agg(F.coalesce(F.bool_or("overall_drift_detected"), F.lit(False)).alias("drifted"))
    degraded = issues.agg(F.coalesce(F.bool_or("degraded"), F.lit(False)).alias("degraded")).scalar()
    flags = drifted.select("drifted", degraded.alias("degraded"))
    names = ("type", "priority", "message", "action")
    advice = lambda texts: F.struct(*[F.lit(t).alias(n) for n, t in zip(names, texts)])
    level = F.when(F.col("degraded"), "critical").when(F.col("drifted"), "warning").otherwise("info")
    chosen = F.filter(
        F.array(
            F.when(F.col("drifted"), advice(DRIFT_ADVICE)),
            F.when(F.col("degraded"), advice(PERFORMANCE_ADVICE)),
            F.when(~F.col("drifted") & ~F.col("degraded"), advice(ALL_WELL)),
        ),
        lambda a: a.isNotNull(),
    )
    return flags.select(level.alias("alert_level"), F.inline(chosen))


def freshness(df: DataFrame, time: str, as_of: Column, keys: list[str] = (), hours: float = FRESHNESS_HOURS):
    """Latest time per key, its age in hours at `as_of`, and whether it is recent enough."""
    latest = df.groupBy(*keys).agg(F.max(time).alias("latest"))
    seconds = F.timestamp_diff("SECOND", F.col("latest"), as_of)
    age = seconds.cast("double") / 3600.0
    return latest.select(*keys, "latest", age.alias("age_hours"), (age <= hours).alias("is_fresh"))


def log_run(metrics: DataFrame, path: str, run_id: str, logged_at: datetime) -> None:
    """Append (run_id, logged_at, metric, value) rows of one run to the log table."""
    rows = metrics.select(
        F.lit(run_id).alias("run_id"),
        F.lit(logged_at).cast("timestamp").alias("logged_at"),
        "metric",
        F.col("value").cast("double").alias("value"),
    )
    save(rows, path, mode="append")


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("run_id string, logged_at timestamp, metric string, value double").parquet(path)


def compare_runs(log: DataFrame, first: str, second: str) -> DataFrame:
    """(metric, first, second, change) of two logged runs."""
    at = lambda run: F.max(F.when(F.col("run_id") == run, F.col("value")))
    pair = log.filter(F.col("run_id").isin(first, second)).groupBy("metric")
    pair = pair.agg(at(first).alias("first_value"), at(second).alias("second_value"))
    return pair.withColumn("change", F.col("second_value") - F.col("first_value"))
