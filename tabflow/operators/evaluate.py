"""Evaluation of predictions. Rankings use running totals over distinct scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabflow.functions.ordered import running_totals
from tabflow.functions.state import entries
from tabflow.sources.shared import persist_state

# Smallest accepted value of each metric, and the accuracy tiers.
GATE_THRESHOLDS = {"accuracy": 0.75, "f1_score": 0.70, "precision": 0.70, "recall": 0.70, "auc": 0.75}
ACCURACY_TIERS = {"excellent": 0.90, "good": 0.80}


def ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator as double; 0.0 on an empty denominator."""
    return F.when(denominator > 0, numerator.cast("double") / denominator).otherwise(F.lit(0.0))


def prediction_cells(df: DataFrame, label: str, prediction: str, score: str) -> DataFrame:
    """(label, prediction, score, n): all that the metrics need, after one scan and one shuffle."""
    return df.groupBy(
        F.col(label).alias("label"), F.col(prediction).alias("prediction"), F.col(score).cast("double").alias("score")
    ).agg(F.count("*").alias("n"))


def score_counts(df: DataFrame, label: str, score: str, model: Column | None = None, weight: Column | None = None):
    """(model, score, pos, neg) per distinct score; a row without label or score counts nothing.

    Such rows get zero weight instead of a filter, which the optimizer would move below the
    cells and so keep two metrics from sharing them.
    """
    weight = F.lit(1).cast("long") if weight is None else weight
    y, ranked = F.col(label), F.col(score).isNotNull()
    rows = df.select(
        (F.lit("model") if model is None else model).alias("model"),
        F.col(score).cast("double").alias("score"),
        F.when(ranked & (y == 1), weight).otherwise(0).alias("pos"),
        F.when(ranked & (y != 1), weight).otherwise(0).alias("neg"),
    )
    return rows.groupBy("model", "score").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def curve(counts: DataFrame) -> DataFrame:
    """Add to each distinct score the positives and negatives at or below it, and in all."""
    return running_totals(counts, ["model"], "score", ["pos", "neg"])


def area_roc(points: DataFrame) -> DataFrame:
    """(model, auc_roc): probability that a positive outranks a negative, ties count half."""
    below = F.col("neg_run") - F.col("neg") / 2.0
    pairs = F.max("pos_all").cast("double") * F.max("neg_all")
    area = F.when(pairs > 0, F.sum(F.col("pos") * below.cast("double")) / pairs)
    return points.groupBy("model").agg(area.alias("auc_roc"))


def area_pr(points: DataFrame) -> DataFrame:
    """(model, auc_pr): trapezoids under precision over recall, from the highest score down.

    The previous point of each step follows from the running totals, so no second window.
    """
    before_tp = (F.col("pos_all") - F.col("pos_run")).cast("double")
    before_all = before_tp + F.col("neg_all") - F.col("neg_run")
    now_tp = before_tp + F.col("pos")
    now_all = before_all + F.col("pos") + F.col("neg")
    precision = F.when(now_all > 0, now_tp / now_all).otherwise(F.lit(0.0))
    earlier = F.when(before_all > 0, before_tp / before_all).otherwise(precision)
    step = F.when(F.col("pos_all") > 0, F.col("pos") / F.col("pos_all").cast("double") * (precision + earlier) / 2.0)
    return points.groupBy("model").agg(F.sum(step).alias("auc_pr"))


def auc_roc(df: DataFrame, label: str, score: str, model: Column | None = None) -> DataFrame:
    """(model, auc_roc) of scored rows; models (or groups) are evaluated together."""
    return area_roc(curve(score_counts(df, label, score, model)))


def auc_pr(df: DataFrame, label: str, score: str, model: Column | None = None) -> DataFrame:
    """(model, auc_pr) of scored rows."""
    return area_pr(curve(score_counts(df, label, score, model)))


def confusion_counts(df: DataFrame, label: str, prediction: str, weight: str | None = None) -> DataFrame:
    """(label, prediction, n) of the cells that occur: the one shuffle of all class metrics."""
    n = F.count("*") if weight is None else F.sum(weight)
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(n.alias("n"))


def confusion_matrix(df: DataFrame, label: str, prediction: str, empty_cells: bool = False) -> DataFrame:
    """(label, prediction, n) of the cells that occur; `empty_cells` adds the others with 0.

    The zero-filled grid has the square of the classes as rows, so it is made on request only. Every
    class is put beside every other by the class list, never by joining rows with rows.
    """
    cells = confusion_counts(df, label, prediction).filter(F.col("label").isNotNull() & F.col("prediction").isNotNull())
    if not empty_cells:
        return cells
    # n > 0 always holds; reading n lets the classes and the counts share one shuffle
    kinds = cells.filter(F.col("n") > 0).select(F.explode(F.array("label", "prediction")).alias("label")).distinct()
    classes = kinds.agg(F.collect_set("label").alias("classes")).scalar()
    grid = kinds.select("label", F.explode(classes).alias("prediction"))
    return grid.join(cells, ["label", "prediction"], "left").select(
        "label", "prediction", F.coalesce("n", F.lit(0)).alias("n")
    )


def per_class(df: DataFrame, label: str, prediction: str, weight: str | None = None) -> DataFrame:
    """Per label class: tp, fp, fn, support, precision, recall and f1; 0.0 where undefined."""
    cells = confusion_counts(df, label, prediction, weight)
    zero = F.lit(0).cast("long")
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    both = cells.select(
        F.inline(
            F.array(
                F.struct(F.col("label").alias("class"), F.col("n").alias("actual"), zero.alias("predicted"), hit.alias("tp")),
                F.struct(F.col("prediction").alias("class"), zero.alias("actual"), F.col("n").alias("predicted"), zero.alias("tp")),
            )
        )
    )
    sums = both.groupBy("class").agg(
        F.sum("tp").alias("tp"), F.sum("predicted").alias("predicted"), F.sum("actual").alias("actual")
    )
    sums = sums.filter((F.col("actual") > 0) & F.col("class").isNotNull())
    precision, recall = ratio(F.col("tp"), F.col("predicted")), ratio(F.col("tp"), F.col("actual"))
    return sums.select(
        "class",
        "tp",
        (F.col("predicted") - F.col("tp")).alias("fp"),
        (F.col("actual") - F.col("tp")).alias("fn"),
        F.col("actual").alias("support"),
        precision.alias("precision"),
        recall.alias("recall"),
        ratio(2 * precision * recall, precision + recall).alias("f1"),
    )


def weighted_metrics(df: DataFrame, label: str, prediction: str, weight: str | None = None) -> DataFrame:
    """One row: accuracy and the class-weighted precision, recall and f1."""
    classes = per_class(df, label, prediction, weight)
    total = F.sum("support").cast("double")
    weighted = lambda c: (F.sum(F.col(c) * F.col("support")) / total)
    return classes.agg(
        (F.sum("tp").cast("double") / total).alias("accuracy"),
        weighted("precision").alias("precision"),
        weighted("recall").alias("recall"),
        weighted("f1").alias("f1_score"),
    )


def accuracy(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.agg(F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("accuracy"))


def evaluate(df: DataFrame, label: str, prediction: str, score: str | None = None, pr: bool = False) -> DataFrame:
    """Long form (metric, value): class metrics, and the areas where a score is given.

    With a score the cells are written once and all metrics read them, so a model scores its rows once.
    """
    if score is None:
        row = weighted_metrics(df, label, prediction)
    else:
        cells = persist_state(prediction_cells(df, label, prediction, score), "cells")
        row = weighted_metrics(cells, "label", "prediction", "n")
    names = ["accuracy", "precision", "recall", "f1_score"]
    report = entries(row, [{"metric": F.lit(n), "value": F.col(n)} for n in names])
    if score is None:
        return report
    points = curve(score_counts(cells, "label", "score", weight=F.col("n")))
    areas = {"auc_roc": area_roc(points), **({"auc_pr": area_pr(points)} if pr else {})}
    for name, area in areas.items():
        report = report.unionByName(area.select(F.lit(name).alias("metric"), F.col(name).alias("value")))
    return report


def binary_metrics(df: DataFrame, label: str, prediction: str, by: list[str] = ()) -> DataFrame:
    """Accuracy, and precision, recall and f1 of the positive class, in one pass (per group)."""
    one = F.lit(1).cast("long")
    rows = df.select(
        *by,
        F.col(prediction).alias("prediction"),
        F.when(F.col(label) == 1, one).otherwise(0).alias("pos"),
        F.when(F.col(label) != 1, one).otherwise(0).alias("neg"),
    )
    return binary_from_counts(rows, by)


def binary_from_counts(df: DataFrame, by: list[str] = ()) -> DataFrame:
    """The same from rows (prediction, pos, neg) that stand for so many labels each."""
    called = F.col("prediction") == 1
    counted = df.groupBy(*by).agg(
        F.sum(F.col("pos") + F.col("neg")).alias("num_samples"),
        F.sum(F.when(called, F.col("pos")).otherwise(0)).alias("tp"),
        F.sum(F.when(called, F.col("neg")).otherwise(0)).alias("fp"),
        F.sum(F.when(called, 0).otherwise(F.col("pos"))).alias("fn"),
        F.sum(F.when(called, 0).otherwise(F.col("neg"))).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counted.select(
        *by,
        ratio(tp + tn, F.col("num_samples")).alias("accuracy"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1_score"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        "num_samples",
    )


def limits(df: DataFrame, thresholds: dict[str, float]) -> DataFrame:
    """Thresholds as a table (metric, threshold)."""
    return entries(
        df.sparkSession.range(1), [{"metric": F.lit(m), "threshold": F.lit(t)} for m, t in thresholds.items()]
    )


def threshold_gate(metrics: DataFrame, thresholds: dict[str, float] = GATE_THRESHOLDS) -> DataFrame:
    """(metric, threshold, value, passed); a metric that is not there does not pass."""
    wanted = limits(metrics, thresholds)
    joined = wanted.join(metrics.select("metric", "value"), "metric", "left")
    return joined.select(
        "metric", "threshold", "value", F.coalesce(F.col("value") >= F.col("threshold"), F.lit(False)).alias("passed")
    )


def accuracy_tier(value: Column) -> Column:
    """excellent, good or needs improvement."""
    return (
        F.when(value > ACCURACY_TIERS["excellent"], "excellent")
        .when(value > ACCURACY_TIERS["good"], "good")
        .otherwise("needs improvement")
    )


def rank_models(metrics: DataFrame) -> DataFrame:
    """Rows (model, accuracy, ...) with `is_best`, best accuracy first, ties by name."""
    best = metrics.orderBy(F.col("accuracy").desc(), "model").limit(1).select("model")
    return metrics.withColumn("is_best", F.col("model") == best.scalar()).orderBy(F.col("accuracy").desc(), "model")


def best_trials(trials: DataFrame, group: str = "algorithm", score: str = "score") -> DataFrame:
    """Best trial per algorithm with the trial count, and which algorithm wins overall."""
    tie = F.struct(F.col(score), -F.col("trial"))
    best = trials.groupBy(group).agg(
        F.max_by(F.struct("trial", "params", score), tie).alias("b"), F.count("*").alias("trials")
    )
    best = best.select(group, "b.trial", "b.params", F.col(f"b.{score}").alias("best_score"), "trials")
    winner = best.orderBy(F.col("best_score").desc(), group).limit(1).select(group).scalar()
    return best.withColumn("is_best", F.col(group) == winner)
