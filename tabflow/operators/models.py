"""Classifiers, fitting, tuning and comparison on MLlib."""

from __future__ import annotations

import itertools
import math
import random
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from dataclasses import dataclass
from functools import partial

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassificationModel,
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from tabflow.functions.expressions import vector_get
from tabflow.functions.state import entries
from tabflow.operators.encoding import one_hot_stage
from tabflow.operators.evaluate import evaluate
from tabflow.operators.nominal import TableIndexer, TableIndexerModel
from tabflow.operators.scaling import vector_scaler
from tabflow.operators.split import assign_folds

# Default parameters of each classifier.
DEFAULTS = {
    "gbt": {"maxIter": 100, "maxDepth": 10, "stepSize": 0.1, "seed": 42},
    "random_forest": {"numTrees": 100, "maxDepth": 10, "seed": 42, "featureSubsetStrategy": "auto"},
    "logistic_regression": {"maxIter": 1000, "regParam": 0.01, "elasticNetParam": 0.0, "family": "binomial"},
    "decision_tree": {"maxDepth": 10, "seed": 42, "impurity": "gini"},
}
# Default grids of cross-validation.
GRIDS = {
    "random_forest": {"numTrees": [10, 20, 50], "maxDepth": [5, 10, 15]},
    "gbt": {"maxIter": [10, 20, 50], "maxDepth": [5, 10]},
    "logistic_regression": {"regParam": [0.01, 0.1, 1.0], "elasticNetParam": [0.0, 0.5, 1.0]},
    "decision_tree": {"maxDepth": [5, 10, 15, 20]},
}
# Search spaces of the trial runs.
SEARCH_SPACES = {
    "gbt": {
        "maxDepth": [5, 7, 10, 15],
        "maxIter": [50, 100, 200, 300],
        "stepSize": [0.01, 0.05, 0.1, 0.2],
        "subsamplingRate": [0.7, 0.8, 0.9, 1.0],
    },
    "random_forest": {
        "maxDepth": [5, 10, 15, 20],
        "numTrees": [50, 100, 200, 500],
        "subsamplingRate": [0.7, 0.8, 0.9, 1.0],
        "featureSubsetStrategy": ["auto", "sqrt", "log2"],
    },
    "logistic_regression": {
        "regParam": [0.01, 0.1, 1.0, 10.0],
        "elasticNetParam": [0.0, 0.5, 1.0],
        "maxIter": [100, 200, 500],
    },
}
# What a row with a NULL or NaN input does. MLlib refuses NaN in a fit, so kept rows are filled.
INVALID = ("keep", "skip", "error")

CLASSES = {
    "gbt": GBTClassifier,
    "random_forest": RandomForestClassifier,
    "logistic_regression": LogisticRegression,
    "decision_tree": DecisionTreeClassifier,
}
ALIASES = {
    "gbt_classifier": "gbt",
    "random_forest_classifier": "random_forest",
    "randomforest": "random_forest",
    "logistic": "logistic_regression",
    "logisticregression": "logistic_regression",
    "decision_tree_classifier": "decision_tree",
    "decisiontree": "decision_tree",
}


def kind_of(name: str) -> str:
    kind = ALIASES.get(name.lower(), name.lower())
    if kind not in CLASSES:
        raise ValueError(f"unknown classifier {name!r}; known: {sorted(CLASSES)}")
    return kind


def classifier(name: str, **params) -> Estimator:
    """A classifier by name with the default parameters and the caller's on top."""
    kind = kind_of(name)
    return CLASSES[kind](featuresCol="features", labelCol="label", **{**DEFAULTS[kind], **params})


def stages(
    numeric: list[str], nominal: list[str], model: Estimator, scale: bool = False, invalid: str = "error"
) -> Pipeline:
    """Index, one-hot, assemble, optionally scale, classify: one fitted object for train and score.

    `invalid` is the rule for rows with missing numbers, in fitting and scoring alike: "keep" fills them
    with the training mean, "skip" leaves the rows out, "error" fails. Categories are a dictionary table; an
    unknown one is one of its own, and so is NULL where training rows have it.
    """
    if invalid not in INVALID:
        raise ValueError(f"unknown rule for incomplete rows {invalid!r}; known: {INVALID}")
    filled = [f"{c}_filled" for c in numeric] if invalid == "keep" else numeric
    fill = [Imputer(inputCols=numeric, outputCols=filled, strategy="mean")] if invalid == "keep" and numeric else []
    encode = [TableIndexer(nominal), one_hot_stage(nominal)] if nominal else []
    inputs = [*filled, *[f"{c}_encoded" for c in nominal]]
    assembled = "features_unscaled" if scale else "features"
    rule = "skip" if invalid == "skip" else "error"
    assembler = VectorAssembler(inputCols=inputs, outputCol=assembled, handleInvalid=rule)
    return Pipeline(stages=[*fill, *encode, assembler, *([vector_scaler(assembled)] if scale else []), model])


def prepared(train: DataFrame, numeric: list[str], nominal: list[str], extra: list[str] = ()) -> DataFrame:
    """The columns a fit reads, cached for its many passes; the caller releases it."""
    return train.select(*numeric, *nominal, *extra, F.col("label").cast("double").alias("label")).cache()


def fit(
    train: DataFrame,
    name: str,
    numeric: list[str],
    nominal: list[str],
    scale: bool = False,
    invalid: str = "error",
    validation: str | None = None,
    **params,
):
    """Fit the whole chain of stages on a table with a numeric `label`.

    `validation` names a boolean column of `train`; boosting stops early on its true rows.
    """
    data = prepared(train, numeric, nominal, [validation] if validation else [])
    try:
        return _fit_prepared(data, name, numeric, nominal, scale, invalid, validation, **params)
    finally:
        data.unpersist()


def _fit_prepared(data: DataFrame, name: str, numeric, nominal, scale=False, invalid="error", validation=None, **params):
    if validation:
        if kind_of(name) != "gbt":
            raise ValueError("only boosting can stop early")
        params = {**params, "validationIndicatorCol": validation}
    return stages(numeric, nominal, classifier(name, **params), scale, invalid).fit(data)


def side_by_side(spark: SparkSession, calls: list[Callable], parallelism: int) -> list:
    """Results of the calls in their order. A fit is a long row of short jobs, so several fill the cores; each
    thread has the session's properties and the workspace of the caller."""
    with ThreadPoolExecutor(max(1, min(parallelism, len(calls)))) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(copy_context().run), call) for call in calls]
        return [s.result() for s in started]


def fit_report(train: DataFrame, name: str, numeric: list[str], nominal: list[str], **options):
    """The fitted chain, and (metric, value) rows of its duration in seconds, rows, columns and stages."""
    started = time.perf_counter()
    model = fit(train, name, numeric, nominal, **options)
    seconds = time.perf_counter() - started
    facts = train.agg(F.count("*").cast("double").alias("rows"))
    values = {
        "training_seconds": F.lit(seconds),
        "training_rows": F.col("rows"),
        "input_columns": F.lit(float(len(numeric) + len(nominal))),
        "stages": F.lit(float(len(model.stages))),
    }
    return model, entries(facts, [{"metric": F.lit(n), "value": v} for n, v in values.items()])


def probabilities(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Model output as plain columns: label, prediction, probability of class 1."""
    out = model.transform(df)
    return out.withColumn("score", vector_get(F.col("probability"), 1))


def fitted_metrics(model: PipelineModel, df: DataFrame, name: str) -> DataFrame:
    """(model, metric, value) of a fitted model on a table."""
    scored = probabilities(model, df).select(F.col("label").cast("double").alias("label"), "prediction", "score")
    return evaluate(scored, "label", "prediction", "score", pr=True).select(F.lit(name).alias("model"), "metric", "value")


def evaluator(metric: str):
    if metric in ("areaUnderROC", "areaUnderPR"):
        return BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="rawPrediction", metricName=metric)
    return MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", metricName=metric)


def space_size(space: dict[str, list]) -> int:
    return math.prod(map(len, space.values()))


def trial_points(space: dict[str, list], trials: int | None = None, seed: int = 42) -> list[dict]:
    """All combinations of a search space, or a seeded sample of `trials` of them."""
    points = [dict(zip(space, values)) for values in itertools.product(*space.values())]
    if trials is None or len(points) <= trials:
        return points
    return random.Random(seed).sample(points, trials)


# What a fit is grown by: the first trees of a larger ensemble are a smaller one, and a regression that
# settles within its iterations is the same with more of them.
GROWN = {"gbt": "maxIter", "random_forest": "numTrees", "logistic_regression": "maxIter"}


@dataclass(frozen=True)
class Validated:
    """Scores of the tried points, averaged over the folds, and the best point fitted on all rows."""

    points: list[dict]
    avgMetrics: list[float]
    best: dict
    bestModel: PipelineModel


def grown_groups(name: str, points: list[dict], metric: str, **params) -> list[dict[int, int]]:
    """Places of the points that one fit serves, with their numbers of trees (0: a fit of its own).

    Points of an ensemble that differ in the number of trees alone share a fit, and so do points of a
    regression that differ in the most iterations. A forest of one tree draws neither rows nor columns as
    larger ones do, and logLoss needs more than a prefix's sums.
    """
    kind = kind_of(name)
    if kind not in GROWN or (metric == "logLoss" and kind != "logistic_regression"):
        return [{place: 0} for place in range(len(points))]
    size, groups = GROWN[kind], {}
    for place, point in enumerate(points):
        trees = {**DEFAULTS[kind], **params, **point}[size]
        rest = tuple(sorted((k, v) for k, v in point.items() if k != size))
        groups.setdefault((rest, kind == "random_forest" and trees == 1), {})[place] = trees
    return list(groups.values())


def grown_scores(model, df: DataFrame, sizes: list[int]) -> DataFrame:
    """(label, raw_<n>, prediction_<n>) of the ensemble's first n trees, for every n, in one pass over the rows.

    Boosting is sequential, so its first n rounds are the fit with n rounds. The first n trees of a forest
    are a forest of n trees, with other random draws than a fit of its own would make.
    """
    boosted, weights, trees = isinstance(model, GBTClassificationModel), model.treeWeights, model.trees
    held = df.select("label", "features")
    for i, tree in enumerate(trees):
        if not boosted:
            tree.setRawPredictionCol("").setProbabilityCol(f"tree_{i}")
        held = tree.setPredictionCol(f"tree_{i}" if boosted else "").transform(held)
    out, for_one, for_none, done = [F.col("label")], F.lit(0.0), F.lit(0.0), 0
    for n in sorted(set(sizes)):
        for i in range(done, min(n, len(trees))):
            share = F.col(f"tree_{i}")
            for_one = for_one + (share * weights[i] if boosted else vector_get(share, 1))
            for_none = F.lit(0.0) if boosted else for_none + vector_get(share, 0)
        done = n
        out += [for_one.alias(f"raw_{n}"), (for_one > for_none).cast("double").alias(f"prediction_{n}")]
    return held.select(*out)


def _group_scores(estimator: Estimator, name: str, points: list[dict], group: dict[int, int], metric: str, inside: DataFrame, outside: DataFrame):
    """Scores of one group of points on a fold, by place."""
    judge, sizes = evaluator(metric), list(group.values())
    fitted = lambda place: estimator.copy({estimator.getParam(k): v for k, v in points[place].items()}).fit(inside)
    if kind_of(name) == "logistic_regression":
        scores, settled = {}, False
        for place in sorted(group, key=group.get):
            if not settled:
                model = fitted(place)
                # steps are the same whatever their limit: one that was not reached changes nothing
                settled = len(model.summary.objectiveHistory) - 1 < group[place]
                score = judge.evaluate(model.transform(outside))
            scores[place] = score
        return scores
    largest = max(group, key=group.get)
    model = fitted(largest)
    if len(group) == 1:
        return {largest: judge.evaluate(model.transform(outside))}
    scored = grown_scores(model, outside, sizes).cache()
    try:
        return {
            place: judge.evaluate(
                scored.select("label", F.col(f"raw_{n}").alias("rawPrediction"), F.col(f"prediction_{n}").alias("prediction"))
            )
            for place, n in group.items()
        }
    finally:
        scored.unpersist()


def cross_validate(
    train: DataFrame,
    name: str,
    numeric: list[str],
    nominal: list[str],
    points: list[dict] | None = None,
    metric: str = "areaUnderROC",
    folds: int = 3,
    fold_column: str | None = None,
    parallelism: int = 6,
    **params,
) -> Validated:
    """Cross-validate parameter points (default: the classifier's grid).

    The stages before the classifier are fitted once per fold, and their output is cached for all points.
    An ensemble is grown once per fold for all points that differ in its number of trees, a regression is
    fitted once for all limits of its iterations that it does not reach. Fits of all folds run side by side,
    the last points of the grid first, as they are the largest. Without a fold column the folds follow from
    the rows' values, so they do not depend on partitioning.
    """
    estimator, spark = classifier(name, **params), train.sparkSession
    points = points if points is not None else trial_points(GRIDS[kind_of(name)])
    groups = grown_groups(name, points, metric, **params)
    if fold_column is None:
        fold_column = "fold_of_row"
        train = assign_folds(train, [*numeric, *nominal, "label"], folds, output=fold_column)
    data, held = prepared(train, numeric, nominal, [fold_column]), []

    def parts_of(fold: int) -> list[DataFrame]:
        out = F.col(fold_column) == fold
        chain = Pipeline(stages=stages(numeric, nominal, estimator).getStages()[:-1]).fit(data.filter(~out))
        parts = [chain.transform(data.filter(c)).select("label", "features").cache() for c in (~out, out)]
        held.extend(parts)
        return parts

    try:
        parts = side_by_side(spark, [partial(parts_of, fold) for fold in range(folds)], parallelism)
        tasks = [(group, fold) for group in reversed(groups) for fold in range(folds)]
        work = [partial(_group_scores, estimator, name, points, group, metric, *parts[fold]) for group, fold in tasks]
        totals = [0.0] * len(points)
        for scores in side_by_side(spark, work, parallelism):
            for place, score in scores.items():
                totals[place] += score / folds
        for part in held:
            part.unpersist()
        pick = max if evaluator(metric).isLargerBetter() else min
        best = points[pick(range(len(points)), key=totals.__getitem__)]
        return Validated(points, totals, best, stages(numeric, nominal, classifier(name, **{**params, **best})).fit(data))
    finally:
        for part in [*held, data]:
            part.unpersist()


def trial_table(
    spark: SparkSession, name: str, points: list[dict], scores: list[float], metric: str, of_points: int | None = None
) -> DataFrame:
    """(algorithm, trial, params, metric, score, tried, of_points), one row per tried point.

    `of_points` is the size of the space that the `tried` points come from.
    """
    rows = [
        (kind_of(name), i + 1, ", ".join(f"{k}={v}" for k, v in sorted(p.items())), metric, float(s), len(points), of_points or len(points))
        for i, (p, s) in enumerate(zip(points, scores))
    ]
    schema = "algorithm string, trial int, params string, metric string, score double, tried int, of_points int"
    return spark.createDataFrame(rows, schema)


def tune(
    train: DataFrame, name: str, numeric: list[str], nominal: list[str], space: dict[str, list], trials: int | None = None,
    metric: str = "f1", **options,
):
    """Trial table of a cross-validated search over a whole space, or over a seeded sample of `trials` points."""
    points = trial_points(space, trials)
    fitted = cross_validate(train, name, numeric, nominal, points, metric, **options)
    return trial_table(train.sparkSession, name, points, fitted.avgMetrics, metric, space_size(space))


def compare(
    train: DataFrame, test: DataFrame, kinds: dict[str, dict], numeric: list[str], nominal: list[str], parallelism: int = 4
) -> DataFrame:
    """Fit several classifiers side by side and return (model, metric, value, error); a failed fit is a row."""
    spark = train.sparkSession
    marks = sorted({p["validation"] for p in kinds.values() if p.get("validation")})
    data = prepared(train, numeric, nominal, marks)

    def judged(name: str, params: dict) -> DataFrame:
        try:
            model = _fit_prepared(data, name, numeric, nominal, **params)
            return fitted_metrics(model, test, name).withColumn("error", F.lit(None).cast("string"))
        except Exception as problem:  # recorded per model, as one bad model must not stop the rest
            text = f"{type(problem).__name__}: {problem}"
            return spark.range(1).select(
                F.lit(name).alias("model"),
                F.lit(None).cast("string").alias("metric"),
                F.lit(None).cast("double").alias("value"),
                F.lit(text).alias("error"),
            )

    try:
        tables = side_by_side(spark, [partial(judged, name, params) for name, params in kinds.items()], parallelism)
    finally:
        data.unpersist()
    united = tables[0]
    for t in tables[1:]:
        united = united.unionByName(t)
    return united


def feature_names(df: DataFrame, column: str = "features") -> list[str]:
    """Names of the vector's positions from the column's metadata, right for one-hot parts too."""
    attributes = df.schema[column].metadata["ml_attr"]["attrs"]
    named = sorted((a["idx"], a["name"]) for group in attributes.values() for a in group)
    return [name for _, name in named]


def importances(model: PipelineModel, df: DataFrame) -> DataFrame:
    """(feature, importance) of the last stage; for a linear model the absolute coefficients."""
    last = model.stages[-1]
    names = feature_names(model.transform(df))
    weights = last.featureImportances if hasattr(last, "featureImportances") else last.coefficients
    rows = [(i, n, abs(float(w))) for i, (n, w) in enumerate(zip(names, weights.toArray()))]
    table = df.sparkSession.createDataFrame(rows, "place int, feature string, importance double")
    for stage in model.stages:
        if isinstance(stage, TableIndexerModel):  # positions of one-hot parts carry codes
            table = table.join(stage.names("_encoded"), F.col("feature") == F.col("position"), "left")
            table = table.select("place", F.coalesce("name", "feature").alias("feature"), "importance")
    return table.orderBy("place").drop("place")


def top_importances(table: DataFrame, k: int = 10) -> DataFrame:
    return table.orderBy(F.col("importance").desc(), "feature").limit(k)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
