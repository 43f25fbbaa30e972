import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabflow.operators import models, scoring, split
from tabflow.sources.shared import new_path
from tests.conftest import rows

NUMERIC, NOMINAL = ["x", "z"], ["s"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(9)
    x, z = rng.normal(size=600), rng.normal(size=600)
    s = rng.choice(["a", "b", "c"], 600)
    label = (x + (s == "b") + rng.normal(size=600) * 0.3 > 0.4).astype(float)
    rows_ = [(i, float(a), float(b), str(c), float(y)) for i, (a, b, c, y) in enumerate(zip(x, z, s, label))]
    return spark.createDataFrame(rows_, "id int, x double, z double, s string, label double")


@pytest.mark.parametrize(
    "name, params",
    [
        ("gbt_classifier", {"maxIter": 5, "maxDepth": 3}),
        ("randomforest", {"numTrees": 8, "maxDepth": 4}),
        ("logistic", {"maxIter": 30}),
        ("decisiontree", {"maxDepth": 4}),
    ],
)
def test_every_classifier_learns(data, name, params):
    train, test = split.train_test(split.assign_random(data, ["id"]))
    model = models.fit(train, name, NUMERIC, NOMINAL, scale=True, **params)
    metrics = {r["metric"]: r["value"] for r in models.fitted_metrics(model, test, name).collect()}
    assert metrics["auc_roc"] > 0.85 and metrics["accuracy"] > 0.75
    assert not train.is_cached


def test_names_and_defaults():
    assert models.kind_of("GBT_Classifier") == "gbt"
    with pytest.raises(ValueError, match="unknown classifier"):
        models.classifier("svm")


def test_default_parameters(spark):
    forest = models.classifier("random_forest")
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getSeed()) == (100, 10, 42)
    boosted = models.classifier("gbt", maxIter=3)
    assert (boosted.getMaxIter(), boosted.getMaxDepth(), boosted.getStepSize()) == (3, 10, 0.1)


def test_unseen_category_is_scored(spark, data):
    model = models.fit(data, "logistic", NUMERIC, NOMINAL, maxIter=20)
    new = spark.createDataFrame([(1, 0.5, 0.0, "zz")], "id int, x double, z double, s string")
    out = scoring.score(new, model).first()
    assert 0 <= out["churn_probability"] <= 1 and out["prediction_label"] in ("Churn", "Retained")
    assert out["confidence_percentage"] == round(out["churn_probability"] * 100, 2)


def test_importances_carry_one_hot_names(data):
    model = models.fit(data, "decision_tree", NUMERIC, NOMINAL, maxDepth=4)
    table = models.importances(model, data)
    names = [r["feature"] for r in table.collect()]
    assert names[:2] == ["x", "z"] and len(names) == 6 and "s_encoded_b" in names
    assert table.agg(F.sum("importance")).first()[0] == pytest.approx(1.0)
    assert models.top_importances(table, 1).first()["feature"] == "x"


def test_saved_model_predicts_the_same(spark, data):
    model = models.fit(data, "decision_tree", NUMERIC, NOMINAL, maxDepth=3)
    path = new_path(spark, "model")
    models.save_model(model, path)
    before = rows(models.probabilities(model, data).select("id", "score"), "id")
    assert before == rows(models.probabilities(models.load_model(path), data).select("id", "score"), "id")


def test_search_points():
    space = models.SEARCH_SPACES["logistic_regression"]
    assert len(models.trial_points(space)) == models.space_size(space) == 36
    assert len(models.trial_points(models.SEARCH_SPACES["gbt"])) == 256
    drawn = models.trial_points(models.SEARCH_SPACES["gbt"], 50)
    assert len(drawn) == 50 and drawn == models.trial_points(models.SEARCH_SPACES["gbt"], 50)
    assert len({tuple(sorted(p.items())) for p in drawn}) == 50
    assert {name: len(models.trial_points(g)) for name, g in models.GRIDS.items()} == {
        "random_forest": 9, "gbt": 6, "logistic_regression": 9, "decision_tree": 4,
    }


def test_tuning_and_comparison(spark, data):
    folded = split.assign_folds(data, ["id"], 2)
    trials = models.tune(folded, "decision_tree", NUMERIC, NOMINAL, {"maxDepth": [1, 4]}, folds=2, fold_column="fold")
    shallow, deep = [r["score"] for r in trials.orderBy("trial").collect()]
    assert deep > shallow
    drawn = models.tune(folded, "decision_tree", NUMERIC, NOMINAL, {"maxDepth": [1, 2, 4]}, 2, folds=2).collect()
    assert [(r["tried"], r["of_points"]) for r in drawn] == [(2, 3), (2, 3)]
    compared = models.compare(data, data, {"decision_tree": {"maxDepth": 3}, "nope": {}}, NUMERIC, NOMINAL).collect()
    assert [r["model"] for r in compared if r["error"]] == ["nope"]
    assert sum(r["model"] == "decision_tree" and r["metric"] == "accuracy" for r in compared) == 1


def test_rows_with_missing_inputs(data):
    gaps = data.withColumn("x", F.when(F.col("id") % 5 > 0, F.col("x")))
    model = models.fit(gaps, "logistic", NUMERIC, NOMINAL, invalid="skip")
    assert models.probabilities(model, gaps).count() == 480
    for name in ("logistic", "decision_tree"):
        kept = models.fit(gaps, name, NUMERIC, NOMINAL, invalid="keep")
        assert models.probabilities(kept, gaps).count() == 600
    with pytest.raises(ValueError, match="unknown rule"):
        models.fit(gaps, "logistic", NUMERIC, NOMINAL, invalid="other")
    with pytest.raises(Exception):
        models.fit(gaps, "logistic", NUMERIC, NOMINAL)


def test_early_stopping_and_fit_report(data):
    marked = data.withColumn("held", F.col("id") % 4 == 0)
    model, report = models.fit_report(marked, "gbt", NUMERIC, NOMINAL, validation="held", maxIter=40, maxDepth=2)
    assert model.stages[-1].getNumTrees < 40
    facts = dict(rows(report))
    assert facts["training_rows"] == 600 and facts["input_columns"] == 3 and facts["training_seconds"] > 0
    with pytest.raises(ValueError, match="stop early"):
        models.fit(marked, "decision_tree", NUMERIC, NOMINAL, validation="held")


def test_boosting_grid_scores_are_those_of_separate_fits(data):
    folded = split.assign_folds(data, ["id"], 2)
    points = models.trial_points({"maxIter": [1, 3, 6], "maxDepth": [2, 3]})
    for metric in ("areaUnderROC", "f1"):
        shared = models.cross_validate(folded, "gbt", NUMERIC, NOMINAL, points, metric, 2, "fold")
        for point, score in list(zip(points, shared.avgMetrics))[:: 2 if metric == "f1" else 1]:
            alone = models.cross_validate(folded, "gbt", NUMERIC, NOMINAL, [point], metric, 2, "fold")
            assert score == pytest.approx(alone.avgMetrics[0], abs=1e-12), point
    assert shared.bestModel.stages[-1].getNumTrees == shared.best["maxIter"]


def test_forest_grid_scores_are_those_of_its_first_trees(data):
    folded = split.assign_folds(data, ["id"], 2)
    points = models.trial_points({"numTrees": [1, 3, 9], "maxDepth": [3]})
    assert models.grown_groups("random_forest", points, "f1") == [{0: 1}, {1: 3, 2: 9}]
    shared = models.cross_validate(folded, "random_forest", NUMERIC, NOMINAL, points, folds=2, fold_column="fold")
    for place in (0, 2):  # a tree alone, and the forest that was grown
        alone = models.cross_validate(folded, "random_forest", NUMERIC, NOMINAL, [points[place]], folds=2, fold_column="fold")
        assert shared.avgMetrics[place] == pytest.approx(alone.avgMetrics[0], abs=1e-12)
    # whole forests of every size agree with the votes of their trees, row by row
    model = models.fit(data, "random_forest", NUMERIC, NOMINAL, numTrees=9, maxDepth=3)
    ready = model.transform(data)
    whole = ready.select("label", models.vector_get(F.col("rawPrediction"), 1).alias("raw"), "prediction")
    mine = models.grown_scores(model.stages[-1], ready, [9]).select("label", "raw_9", "prediction_9")
    assert [tuple(r) for r in mine.collect()] == [tuple(r) for r in whole.collect()]
    few = models.grown_scores(model.stages[-1], ready, [2]).collect()
    votes = np.zeros((600, 2))
    for tree in model.stages[-1].trees[:2]:
        tree.setProbabilityCol("p")
        votes += [r["p"].toArray() for r in tree.transform(ready.select("features")).collect()]
    assert np.allclose([r["raw_2"] for r in few], votes[:, 1])
    assert [r["prediction_2"] for r in few] == (votes[:, 1] > votes[:, 0]).astype(float).tolist()


def test_logloss_and_folds_of_equal_rows(data):
    points = [{"maxIter": 1, "maxDepth": 2}, {"maxIter": 4, "maxDepth": 2}]
    assert models.grown_groups("gbt", points, "logLoss") == [{0: 0}, {1: 0}]
    again = [models.cross_validate(d, "gbt", NUMERIC, NOMINAL, points, folds=2).avgMetrics for d in (data, data.repartition(7))]
    assert again[0] == pytest.approx(again[1], abs=0.02)


def test_regression_points_share_a_fit_that_settles(data, monkeypatch):
    folded = split.assign_folds(data, ["id"], 2)
    points = models.trial_points({"regParam": [0.01], "elasticNetParam": [0.0], "maxIter": [2, 3, 100, 200, 500]})
    assert models.grown_groups("logistic_regression", points, "f1") == [{0: 2, 1: 3, 2: 100, 3: 200, 4: 500}]
    alone = [models.cross_validate(folded, "logistic", NUMERIC, NOMINAL, [points[i]], "areaUnderROC", 2, "fold").avgMetrics[0] for i in (0, 3)]
    fits, fit = [], models.LogisticRegression.fit
    monkeypatch.setattr(models.LogisticRegression, "fit", lambda self, *a, **k: fits.append(self.getMaxIter()) or fit(self, *a, **k))
    shared = models.cross_validate(folded, "logistic", NUMERIC, NOMINAL, points, "areaUnderROC", 2, "fold")
    assert [shared.avgMetrics[i] for i in (0, 3)] == pytest.approx(alone, abs=1e-12)
    assert sorted(fits) == sorted([2, 3, 100] * 2 + [shared.best["maxIter"]])  # two folds, and the best on all rows


@pytest.mark.parametrize("name, space", [("gbt", {"maxIter": [2], "maxDepth": [1, 2]}), ("random_forest", {"numTrees": [2], "maxDepth": [1, 2]})])
def test_fits_of_all_folds_run_side_by_side(data, monkeypatch, name, space):
    folded, together, peak, lock = split.assign_folds(data, ["id"], 3), [], [], threading.Lock()
    real = models._group_scores

    def watched(*args):
        with lock:
            together.append(1)
            peak.append(len(together))
        try:
            return real(*args)
        finally:
            with lock:
                together.pop()

    monkeypatch.setattr(models, "_group_scores", watched)
    models.cross_validate(folded, name, NUMERIC, NOMINAL, models.trial_points(space), folds=3, fold_column="fold", parallelism=6)
    assert len(peak) == 6 and max(peak) > 2  # more than the two points of one fold
    assert not folded.is_cached


def test_compared_models_are_fitted_side_by_side(data, monkeypatch):
    met, real = threading.Barrier(2, timeout=60), models._fit_prepared

    def watched(*args, **params):
        met.wait()  # breaks where one fit waits for the other
        return real(*args, **params)

    monkeypatch.setattr(models, "_fit_prepared", watched)
    table = models.compare(data, data, {"decision_tree": {"maxDepth": 2}, "logistic": {"maxIter": 5}}, NUMERIC, NOMINAL).collect()
    assert len(table) == 12 and not any(r["error"] for r in table)
    assert list(dict.fromkeys(r["model"] for r in table)) == ["decision_tree", "logistic"]
