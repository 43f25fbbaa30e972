"""Queries: MLlib fits on the customer table, with the default parameters and grids of the models module.

A fit has no equal in SQL. Its twin states what must hold of every row that the query returns.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tabflow.operators import evaluate, models, scoring, split
from tabflow.plans.inputs import WITH_CUSTOMERS
from tabflow.plans.registry import query, rounded
from tabflow.plans.streams import drained
from tabflow.sources.shared import new_path, persist_state
from tabflow.sources.tables import customers
from tabflow.streaming import scoring as streaming

NUMERIC = ["c_acctbal", "order_count", "total_spend", "tenure_months"]
NOMINAL = ["c_mktsegment", "c_nationkey"]
CUSTOMERS = WITH_CUSTOMERS + "SELECT c_custkey"
FOLDS = 5


def whole(spark, root):
    """Customers joined once and written."""
    return persist_state(customers(spark, root).withColumn("label", F.col("churned").cast("double")), "customers")


def parts(spark, root):
    return split.train_test(split.assign_random(whole(spark, root), ["c_custkey"]))


METRICS = ["accuracy", "precision", "recall", "f1_score", "auc_roc", "auc_pr"]


def bounded(report):
    """(model, metric, in_bounds): a metric lies in [0, 1]; the area under ROC beats a blind guess."""
    value = F.col("value")
    floor = F.when(F.col("metric") == "auc_roc", 0.5).otherwise(0.0)
    return report.select("model", "metric", value.between(floor, 1.0).alias("in_bounds"))


def bounded_sql(kind: str) -> str:
    values = ", ".join(f"('{m}')" for m in METRICS)
    return f"SELECT '{kind}' AS model, m AS metric, true AS in_bounds FROM (VALUES {values}) v(m)"


def metrics_of(name):
    def run(spark, root):
        train, test = parts(spark, root)
        return bounded(models.fitted_metrics(models.fit(train, name, NUMERIC, NOMINAL), test, name))

    run.__doc__ = f"Test metrics of a {name.replace('_', ' ')} model with its default parameters."
    return run


for kind, key in {
    "gbt": "fit_gbt",
    "random_forest": "fit_random_forest",
    "logistic_regression": "fit_logistic",
    "decision_tree": "fit_decision_tree",
}.items():
    query(key, bounded_sql(kind))(metrics_of(kind))


TRAIN_SQL = "substr(md5('42:' || length(CAST(c_custkey AS VARCHAR)) || '=' || c_custkey), 1, 8)"
IS_TRAIN_SQL = f"CAST('0x' || {TRAIN_SQL} AS BIGINT) % 10000 >= 2000"


@query(
    "fit_stages",
    WITH_CUSTOMERS
    + f"""SELECT 'training_rows' AS metric, count(*)::DOUBLE AS value FROM cust WHERE {IS_TRAIN_SQL}
UNION ALL SELECT 'input_columns', 6 UNION ALL SELECT 'stages', 5 UNION ALL SELECT 'took_time', 1
UNION ALL SELECT 'metrics_in_bounds', 6""",
)
def fit_stages(spark, root):
    """The whole chain (index, one-hot, assemble, scale, classify) with its duration, sizes and metrics."""
    train, _ = parts(spark, root)
    model, report = models.fit_report(train, "logistic", NUMERIC, NOMINAL, scale=True)
    took = F.col("metric") == "training_seconds"
    report = report.select(
        F.when(took, "took_time").otherwise(F.col("metric")).alias("metric"),
        F.when(took, (F.col("value") > 0).cast("double")).otherwise(F.col("value")).alias("value"),
    )
    good = bounded(models.fitted_metrics(model, train, "logistic_regression")).agg(F.count_if("in_bounds").alias("n"))
    return report.unionByName(good.select(F.lit("metrics_in_bounds").alias("metric"), F.col("n").cast("double").alias("value")))


@query(
    "fit_early_stop",
    "SELECT true AS stopped_in_bounds, true AS scores_in_bounds",
)
def fit_early_stop(spark, root):
    """Boosting that may stop before its last round, judged on rows kept aside."""
    train, test = parts(spark, root)
    held = split.assign_random(train, ["c_custkey"], 0.2, seed=7)
    marked = held.withColumn("is_validation", F.col(split.SPLIT_COLUMN) == "test")
    model = models.fit(marked, "gbt", NUMERIC, NOMINAL, validation="is_validation")
    trees = model.stages[-1].getNumTrees
    rows = models.probabilities(model, test)
    return rows.agg(F.lit(1 <= trees <= 100).alias("stopped_in_bounds"), F.bool_and(F.col("score").between(0, 1)).alias("scores_in_bounds"))


@query(
    "fit_incomplete_rows",
    WITH_CUSTOMERS + """SELECT 'skip' AS rule, count(*) AS scored FROM cust WHERE c_custkey % 7 <> 0
UNION ALL SELECT 'keep', count(*) FROM cust""",
)
def fit_incomplete_rows(spark, root):
    """Rows without an input: skipped by a linear model, filled with the mean and kept by a tree."""
    gap = F.when(F.col("c_custkey") % 7 != 0, F.col("c_acctbal"))
    rows = whole(spark, root).withColumn("c_acctbal", gap)
    united = None
    for rule, name in (("skip", "logistic"), ("keep", "decision_tree")):
        model = models.fit(rows, name, NUMERIC, NOMINAL, invalid=rule)
        counted = models.probabilities(model, rows).agg(F.lit(rule).alias("rule"), F.count("*").alias("scored"))
        united = counted if united is None else united.unionByName(counted)
    return united


def trials_sql(kind: str, n: int, of: int) -> str:
    return f"SELECT '{kind}' AS algorithm, CAST(i AS INTEGER) AS trial, {n} AS tried, {of} AS of_points, true AS in_bounds FROM range(1, {n + 1}) t(i)"


def judged(trials):
    return trials.select("algorithm", "trial", "tried", "of_points", F.col("score").between(0, 1).alias("in_bounds"))


def grid_of(kind):
    def run(spark, root):
        train, _ = parts(spark, root)
        folded = split.assign_folds(train, ["c_custkey"], FOLDS)
        tried = models.cross_validate(folded, kind, NUMERIC, NOMINAL, folds=FOLDS, fold_column="fold")
        return judged(models.trial_table(spark, kind, tried.points, tried.avgMetrics, "areaUnderROC"))

    run.__doc__ = f"Cross-validation over the default grid of the {kind.replace('_', ' ')}, five folds by key."
    return run


for kind, key in {
    "decision_tree": "tune_cv_grid",
    "logistic_regression": "tune_cv_grid_regression",
    "random_forest": "tune_cv_grid_forest",
    "gbt": "tune_cv_grid_boosting",
}.items():
    size = models.space_size(models.GRIDS[kind])
    query(key, trials_sql(kind, size, size))(grid_of(kind))


@query("tune_grid_trials", trials_sql("logistic_regression", 36, 36))
def tune_grid_trials(spark, root):
    """Trials over the whole regression search space, scored by f1."""
    train, _ = parts(spark, root)
    space = models.SEARCH_SPACES["logistic_regression"]
    return judged(models.tune(train, "logistic_regression", NUMERIC, NOMINAL, space, folds=FOLDS))


@query("tune_random", trials_sql("logistic_regression", 20, 36))
def tune_random(spark, root):
    """A seeded sample of twenty points of a search space."""
    train, _ = parts(spark, root)
    space = models.SEARCH_SPACES["logistic_regression"]
    return judged(models.tune(train, "logistic_regression", NUMERIC, NOMINAL, space, trials=20, folds=FOLDS))


KINDS = ["gbt", "random_forest", "logistic_regression", "decision_tree"]


@query(
    "compare_models",
    " UNION ALL ".join(f"SELECT *, false AS failed FROM ({bounded_sql(k)})" for k in KINDS)
    + " UNION ALL SELECT 'unknown_kind', NULL, NULL, true",
)
def compare_models(spark, root):
    """All classifiers on the same parts; an unknown one is reported, not raised."""
    train, test = parts(spark, root)
    table = models.compare(train, test, {**{k: {} for k in KINDS}, "unknown_kind": {}}, NUMERIC, NOMINAL)
    floor = F.when(F.col("metric") == "auc_roc", 0.5).otherwise(0.0)
    return table.select("model", "metric", F.col("value").between(floor, 1.0).alias("in_bounds"), F.col("error").isNotNull().alias("failed"))


def summed(table):
    """One row: features, whether no importance is negative, and their sum."""
    return table.agg(
        F.countDistinct("feature").alias("features"),
        F.bool_and(F.col("importance") >= 0).alias("none_negative"),
        F.round(F.sum("importance"), 6).alias("total"),
    )


# four numbers, and one position per segment and nation of the training part and for others
NAMES_SQL = f"""names AS (SELECT 4 + (SELECT count(DISTINCT c_mktsegment) + 1 FROM cust WHERE {IS_TRAIN_SQL})
  + (SELECT count(DISTINCT c_nationkey) + 1 FROM cust WHERE {IS_TRAIN_SQL}) AS n)"""


@query(
    "feature_importance",
    WITH_CUSTOMERS.rstrip() + f", {NAMES_SQL} SELECT n AS features, true AS none_negative, 1.0::DOUBLE AS total FROM names",
)
def feature_importance(spark, root):
    train, _ = parts(spark, root)
    return summed(models.importances(models.fit(train, "random_forest", NUMERIC, NOMINAL), train))


@query("topk_importance", "SELECT CAST(i AS INTEGER) AS place, true AS in_order FROM range(1, 11) t(i)")
def topk_importance(spark, root):
    """Ten features, each with at least the importance of the next."""
    train, _ = parts(spark, root)
    table = models.importances(models.fit(train, "decision_tree", NUMERIC, NOMINAL), train)
    listed = models.top_importances(table, 10).agg(F.collect_list("importance").alias("w"))
    place = F.posexplode("w").alias("i", "weight")
    rows = listed.select("w", place)
    in_order = F.col("weight") >= F.coalesce(F.get("w", F.col("i") + 1), F.lit(0.0))
    return rows.select((F.col("i") + 1).alias("place"), in_order.alias("in_order"))


@query("model_save_load", CUSTOMERS + ", true AS same FROM cust")
def model_save_load(spark, root):
    """Predictions of the model before saving and after loading, for every customer."""
    rows = whole(spark, root)
    train, _ = split.train_test(split.assign_random(rows, ["c_custkey"]))
    model, path = models.fit(train, "decision_tree", NUMERIC, NOMINAL), new_path(spark, "model")
    models.save_model(model, path)
    before = models.probabilities(model, rows).select("c_custkey", F.col("score").alias("score_before"))
    after = models.probabilities(models.load_model(path), rows).select("c_custkey", F.col("score").alias("score_after"))
    return before.join(after, "c_custkey").select("c_custkey", (F.col("score_before") == F.col("score_after")).alias("same"))


@query(
    "eval_full",
    f"""{WITH_CUSTOMERS.rstrip()}, n AS (SELECT count(*) FILTER (WHERE {IS_TRAIN_SQL})::DOUBLE AS a, count(*) FILTER (WHERE NOT {IS_TRAIN_SQL})::DOUBLE AS b FROM cust)
SELECT metric, true AS agrees FROM (VALUES ('accuracy'), ('precision'), ('recall'), ('f1_score'), ('auc_roc'), ('auc_pr'), ('hits')) v(metric)
UNION ALL SELECT 'train_rows=' || CAST(a AS BIGINT), true FROM n UNION ALL SELECT 'test_rows=' || CAST(b AS BIGINT), true FROM n""",
)
def eval_full(spark, root):
    """All metrics of the written predictions, the sizes of both parts, and the accuracy counted anew."""
    train, test = parts(spark, root)
    model = models.fit(train, "logistic_regression", NUMERIC, NOMINAL)
    scored = persist_state(models.probabilities(model, test).select("label", "prediction", "score"), "scored")
    report = persist_state(evaluate.evaluate(scored, "label", "prediction", "score", pr=True), "report")
    checked = report.select("metric", F.col("value").between(0, 1).alias("agrees"))
    accuracy = report.filter("metric = 'accuracy'").select("value").scalar()
    hits = scored.agg(F.avg((F.col("label") == F.col("prediction")).cast("double")).alias("hits"))
    checked = checked.unionByName(hits.select(F.lit("hits").alias("metric"), (F.abs(F.col("hits") - accuracy) < 1e-9).alias("agrees")))
    for name, part in (("train_rows", train), ("test_rows", test)):
        size = part.agg(F.count("*").alias("n"))
        checked = checked.unionByName(size.select(F.concat(F.lit(f"{name}="), F.col("n").cast("string")).alias("metric"), F.lit(True).alias("agrees")))
    return checked


FORMAT_SQL = CUSTOMERS + ", true AS label_fits, true AS percentage_fits, true AS stamped FROM cust"


@query("score_batch", FORMAT_SQL)
def score_batch(spark, root):
    """Every customer scored; label and percentage follow from the probability."""
    rows = whole(spark, root)
    train, _ = split.train_test(split.assign_random(rows, ["c_custkey"]))
    out = scoring.score(rows, models.fit(train, "logistic_regression", NUMERIC, NOMINAL))
    p = F.col("churn_probability")
    return out.select(
        "c_custkey",
        (F.col("prediction_label") == F.when(p > 0.5, "Churn").otherwise("Retained")).alias("label_fits"),
        (F.col("confidence_percentage") == F.round(p * 100, 2)).alias("percentage_fits"),
        F.col("prediction_timestamp").isNotNull().alias("stamped"),
    )


@query("score_batch_saved", CUSTOMERS + ", true AS label_fits FROM cust")
def score_batch_saved(spark, root):
    """Every customer scored by a stored model with its preprocessing inside; nothing is fitted on the batch."""
    rows = whole(spark, root)
    train, _ = split.train_test(split.assign_random(rows, ["c_custkey"]))
    path = new_path(spark, "model")
    models.save_model(models.fit(train, "gbt", NUMERIC, NOMINAL), path)
    out = scoring.alias_output(models.load_model(path).transform(rows))
    p = models.vector_get(F.col("churn_probability"), 1)
    return out.select("c_custkey", (F.col("churn_prediction") == F.when(p > 0.5, 1.0).otherwise(0.0)).alias("label_fits"))


@query("stream_score_model", CUSTOMERS + ", true AS label_fits FROM cust")
def stream_score_model(spark, root):
    """A fitted model applied to a stream of all customers."""
    rows = whole(spark, root)
    train, _ = split.train_test(split.assign_random(rows, ["c_custkey"]))
    model = models.fit(train, "decision_tree", NUMERIC, NOMINAL)
    path, columns = new_path(spark, "customers"), ["c_custkey", *NUMERIC, *NOMINAL]
    rows.select(*columns).write.json(path)
    stream = streaming.json_stream(spark, path, rows.select(*columns).schema)
    scored = drained(scoring.score(stream, model, stamp=False).select("c_custkey", "prediction_label", "churn_probability"))
    label = F.when(F.col("churn_probability") > 0.5, "Churn").otherwise("Retained")
    return scored.select("c_custkey", (F.col("prediction_label") == label).alias("label_fits"))


# A target that the columns give exactly, with few values on each side of a split: trees must find it.
PLANTED_NATION, PLANTED_SEGMENT = 10, "BUILDING"
PLANTED_NUMERIC = [*NUMERIC, "c_nationkey"]
PLANTED_SQL = f"CASE WHEN c_nationkey < {PLANTED_NATION} AND c_mktsegment = '{PLANTED_SEGMENT}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"
PLANTED_KINDS = {"decision_tree": {}, "gbt": {"maxIter": 3}}


def planted(spark, root):
    """Customers whose label follows from nation and segment, and models fitted on all of them."""
    rule = (F.col("c_nationkey") < PLANTED_NATION) & (F.col("c_mktsegment") == PLANTED_SEGMENT)
    rows = whole(spark, root).withColumn("label", rule.cast("double"))
    return rows, {k: models.fit(rows, k, PLANTED_NUMERIC, ["c_mktsegment"], **p) for k, p in PLANTED_KINDS.items()}


def of_planted(select: str) -> str:
    kinds = ", ".join(f"('{k}')" for k in PLANTED_KINDS)
    return WITH_CUSTOMERS + f", planted AS (SELECT *, {PLANTED_SQL} AS label FROM cust) SELECT k AS model, {select} FROM planted, (VALUES {kinds}) m(k)"


@query("fit_planted", of_planted("c_custkey, label, label AS prediction"))
def fit_planted(spark, root):
    """What the models say of every customer: the planted label."""
    rows, fitted = planted(spark, root)
    parts = [models.probabilities(m, rows).select(F.lit(k).alias("model"), "c_custkey", "label", "prediction") for k, m in fitted.items()]
    return parts[0].unionByName(parts[1])


@query("eval_planted", of_planted("unnest(['accuracy', 'precision', 'recall', 'f1_score', 'auc_roc', 'auc_pr']) AS metric, 1.0::DOUBLE AS value") + " GROUP BY k")
def eval_planted(spark, root):
    """All metrics of models that separate the classes."""
    rows, fitted = planted(spark, root)
    parts = [models.fitted_metrics(m, rows, k) for k, m in fitted.items()]
    return rounded(parts[0].unionByName(parts[1]), 9)


@query("confusion_planted", of_planted("label, label AS prediction, count(*) AS n") + " GROUP BY k, label")
def confusion_planted(spark, root):
    """The cells of the confusion matrix: the class counts on the diagonal and nothing beside it."""
    rows, fitted = planted(spark, root)
    parts = [models.probabilities(m, rows).groupBy("label", "prediction").agg(F.count("*").alias("n")).withColumn("model", F.lit(k)) for k, m in fitted.items()]
    return parts[0].unionByName(parts[1]).select("model", "label", "prediction", "n")


@query(
    "importance_planted",
    f"SELECT f AS feature, 0.0::DOUBLE AS importance FROM (VALUES {', '.join(f'({chr(39)}{c}{chr(39)})' for c in NUMERIC)}) v(f) UNION ALL SELECT 'all', 1.0",
)
def importance_planted(spark, root):
    """Columns that the planted label does not depend on have no importance; all together have one."""
    rows, fitted = planted(spark, root)
    found = models.importances(fitted["decision_tree"], rows)
    total = found.agg(F.lit("all").alias("feature"), F.sum("importance").alias("importance"))
    return rounded(found.filter(F.col("feature").isin(NUMERIC)).unionByName(total), 9)


@query("score_planted", WITH_CUSTOMERS + f"SELECT c_custkey, CASE WHEN {PLANTED_SQL} = 1 THEN 'Churn' ELSE 'Retained' END AS prediction_label FROM cust")
def score_planted(spark, root):
    """Batch scoring by a stored model: the label text of every customer."""
    rows, fitted = planted(spark, root)
    path = new_path(spark, "model")
    models.save_model(fitted["decision_tree"], path)
    scored = scoring.score(rows.drop("label"), models.load_model(path))
    return scored.select("c_custkey", "prediction_label")
