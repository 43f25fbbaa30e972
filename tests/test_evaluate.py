import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from tabflow.operators import evaluate
from tests.conftest import counted, rows


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(5)
    label = rng.integers(0, 2, 800)
    score = np.clip(0.5 + 0.2 * (label - 0.5) + rng.normal(size=800) * 0.2, 0, 1).round(2)
    score[:270] = 0.5  # a third of the rows share one score
    data = [(float(y), float(s), float(s > 0.5)) for y, s in zip(label, score)]
    return spark.createDataFrame(data, "label double, score double, prediction double")


def by_hand_auc(pairs):
    positive = [s for y, s in pairs if y == 1]
    negative = [s for y, s in pairs if y != 1]
    wins = sum((p > n) + 0.5 * (p == n) for p in positive for n in negative)
    return wins / (len(positive) * len(negative))


def test_areas_equal_the_ml_evaluator_and_pair_counting(scored):
    pairs = [(r[0], r[1]) for r in rows(scored)]
    (_, roc), = rows(evaluate.auc_roc(scored, "label", "score"))
    assert roc == pytest.approx(by_hand_auc(pairs), abs=1e-12)
    ml = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0)
    assert roc == pytest.approx(ml.evaluate(scored), abs=1e-12)
    (_, pr), = rows(evaluate.auc_pr(scored, "label", "score"))
    assert pr == pytest.approx(ml.setMetricName("areaUnderPR").evaluate(scored), abs=1e-12)


def test_areas_of_several_models_at_once(scored):
    both = scored.withColumn("m", F.lit("a")).unionByName(
        scored.withColumn("m", F.lit("b")).withColumn("score", 1 - F.col("score"))
    )
    out = dict(rows(evaluate.auc_roc(both, "label", "score", F.col("m"))))
    assert out["a"] + out["b"] == pytest.approx(1.0)


def test_one_class_has_no_area(spark):
    df = spark.createDataFrame([(1.0, 0.2), (1.0, 0.9)], "label double, score double")
    assert rows(evaluate.auc_roc(df, "label", "score")) == [("model", None)]


def test_class_metrics_equal_the_ml_evaluator(scored):
    row = evaluate.weighted_metrics(scored, "label", "prediction").first()
    ml = MulticlassClassificationEvaluator()
    names = {"accuracy": "accuracy", "precision": "weightedPrecision", "recall": "weightedRecall", "f1_score": "f1"}
    for mine, theirs in names.items():
        assert row[mine] == pytest.approx(ml.setMetricName(theirs).evaluate(scored), abs=1e-12)


def test_report_reads_its_input_once(spark, smoke):
    lines = spark.read.parquet(f"{smoke}/lineitem.parquet").select(
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("label"),
        (F.col("l_quantity") > 25).cast("int").alias("prediction"),
        F.when(F.col("l_tax") > 0, F.col("l_extendedprice")).alias("score"),
    )
    watched, seen = counted(lines)
    values = dict(rows(evaluate.evaluate(watched, "label", "prediction", "score", pr=True)))
    assert seen.value == lines.count()
    assert set(values) == {"accuracy", "precision", "recall", "f1_score", "auc_roc", "auc_pr"}
    alone = dict(rows(evaluate.evaluate(lines, "label", "prediction")))
    assert all(values[m] == pytest.approx(v) for m, v in alone.items())
    ranked = lines.filter("score IS NOT NULL")
    assert values["auc_roc"] == pytest.approx(evaluate.auc_roc(ranked, "label", "score").first()["auc_roc"])
    assert values["auc_pr"] == pytest.approx(evaluate.auc_pr(ranked, "label", "score").first()["auc_pr"])


def test_scores_that_are_all_missing(spark):
    df = spark.createDataFrame([(1, 1, None), (0, 1, None)], "label int, prediction int, score double")
    out = dict(rows(evaluate.evaluate(df, "label", "prediction", "score", pr=True)))
    assert out["accuracy"] == 0.5 and out["auc_roc"] is None and out["auc_pr"] is None


def test_confusion_matrix_has_empty_cells_and_sums_to_the_rows(spark):
    df = spark.createDataFrame([("a", "b"), ("a", "b"), ("b", "b"), ("c", "a"), (None, "a")], "y string, p string")
    cells = {(r[0], r[1]): r[2] for r in rows(evaluate.confusion_matrix(df, "y", "p", empty_cells=True))}
    assert len(cells) == 9 and sum(cells.values()) == 4
    assert cells[("a", "b")] == 2 and cells[("c", "c")] == 0
    found = {(r[0], r[1]): r[2] for r in rows(evaluate.confusion_matrix(df, "y", "p"))}
    assert found == {k: n for k, n in cells.items() if n}


def test_areas_of_very_many_groups_and_of_the_null_group(spark):
    df = spark.range(6006).select(
        F.nullif(F.col("id") % 1001, F.lit(0)).alias("m"), (F.col("id") % 2).alias("y"), F.col("id").cast("double").alias("s")
    )
    areas = dict(rows(evaluate.auc_roc(df, "y", "s", F.col("m"))))
    assert len(areas) == 1001 and None in areas
    # ids of a group are 1001 apart, so labels alternate and 3 positives meet 3 negatives
    assert set(areas.values()) == {6 / 9, 3 / 9}


def test_per_class_is_zero_where_undefined(spark):
    df = spark.createDataFrame([("a", "b"), ("b", "b"), ("c", "b")], "y string, p string")
    out = {r["class"]: r for r in evaluate.per_class(df, "y", "p").collect()}
    assert (out["a"]["precision"], out["a"]["recall"], out["a"]["f1"]) == (0.0, 0.0, 0.0)
    assert (out["b"]["tp"], out["b"]["fp"], out["b"]["fn"], out["b"]["support"]) == (1, 2, 0, 1)


def test_gate_and_tiers(spark):
    metrics = spark.createDataFrame([("accuracy", 0.8), ("recall", 0.7), ("auc", None)], "metric string, value double")
    passed = {r["metric"]: r["passed"] for r in evaluate.threshold_gate(metrics).collect()}
    assert passed == {"accuracy": True, "f1_score": False, "precision": False, "recall": True, "auc": False}
    df = spark.createDataFrame([(0.95,), (0.85,), (0.8,)], "v double")
    tiers = [r[0] for r in rows(df.select(evaluate.accuracy_tier(F.col("v"))))]
    assert tiers == ["excellent", "good", "needs improvement"]


def test_ranking_breaks_ties_by_name(spark):
    metrics = spark.createDataFrame([("b", 0.9), ("a", 0.9), ("c", 0.95)], "model string, accuracy double")
    assert [tuple(r) for r in evaluate.rank_models(metrics).collect()] == [
        ("c", 0.95, True), ("a", 0.9, False), ("b", 0.9, False),
    ]
    trials = spark.createDataFrame(
        [("x", 1, "p=1", 0.5), ("x", 2, "p=2", 0.7), ("y", 1, "q=1", 0.7)],
        "algorithm string, trial int, params string, score double",
    )
    best = rows(evaluate.best_trials(trials), "algorithm")
    assert best == [("x", 2, "p=2", 0.7, 2, True), ("y", 1, "q=1", 0.7, 1, False)]
