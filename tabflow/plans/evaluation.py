"""Queries: evaluation of predictions and batch scoring formats."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabflow.operators import binning, evaluate, scoring
from tabflow.plans.inputs import EVENTS_SQL, WITH_GAPS, gapped_customers, scored_events
from tabflow.plans.profiling import TENURE_CASE
from tabflow.plans.registry import query, rounded
from tabflow.sources.tables import SCORED_SQL, scored_lines, table

CUT = 0.5


def calls(spark, root):
    """Scored line items with a 0/1 prediction."""
    return scored_lines(spark, root).withColumn("prediction", F.when(F.col("score") > CUT, 1).otherwise(0))


CALLS_SQL = f"""{SCORED_SQL},
calls AS (SELECT *, CASE WHEN score > {CUT} THEN 1 ELSE 0 END AS prediction FROM scored)"""

CURVE_STEPS_SQL = """per_score AS (SELECT score, CAST(sum(label) AS DOUBLE) AS pos, CAST(sum(1 - label) AS DOUBLE) AS neg FROM scored GROUP BY score),
curve AS (SELECT *, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp,
          sum(pos) OVER () AS p, sum(neg) OVER () AS n FROM per_score),
points AS (SELECT score, pos, neg, tp, fp, p, n, tp / (tp + fp) AS prec,
           lag(tp / (tp + fp)) OVER (ORDER BY score DESC) AS prec_before FROM curve)"""
CURVE_SQL = f"{SCORED_SQL}, {CURVE_STEPS_SQL}"


@query(
    "eval_auc_roc",
    f"WITH {CURVE_SQL} SELECT 'model' AS model, round(sum(pos * (n - fp + neg / 2)) / max(p) / max(n), 9) AS auc_roc FROM curve",
)
def eval_auc_roc(spark, root):
    return rounded(evaluate.auc_roc(scored_lines(spark, root), "label", "score"), 9)


@query(
    "eval_auc_pr",
    f"WITH {CURVE_SQL} SELECT 'model' AS model, round(sum(pos / p * (prec + coalesce(prec_before, prec)) / 2), 9) AS auc_pr FROM points",
)
def eval_auc_pr(spark, root):
    return rounded(evaluate.auc_pr(scored_lines(spark, root), "label", "score"), 9)


@query(
    "eval_auc_continuous",
    """WITH s AS (SELECT l_linestatus, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label, l_extendedprice AS score FROM lineitem),
per_score AS (SELECT l_linestatus, score, CAST(sum(label) AS DOUBLE) AS pos, CAST(sum(1 - label) AS DOUBLE) AS neg FROM s GROUP BY ALL),
curve AS (SELECT *, sum(neg) OVER (PARTITION BY l_linestatus ORDER BY score) AS below FROM per_score)
SELECT l_linestatus AS model, round(sum(pos * (below - neg / 2)) / sum(pos) / sum(neg), 9) AS auc_roc FROM curve GROUP BY 1""",
)
def eval_auc_continuous(spark, root):
    """Ranking by a nearly unique score, for two groups in one plan."""
    lines = table(spark, root, "lineitem").withColumn("label", F.when(F.col("l_returnflag") == "R", 1).otherwise(0))
    return rounded(evaluate.auc_roc(lines, "label", "l_extendedprice", F.col("l_linestatus")), 9)


@query(
    "eval_accuracy",
    f"WITH {CALLS_SQL} SELECT round(avg(CASE WHEN label = prediction THEN 1.0::DOUBLE ELSE 0 END), 9) AS accuracy FROM calls",
)
def eval_accuracy(spark, root):
    return rounded(evaluate.accuracy(calls(spark, root), "label", "prediction"), 9)


def class_calls(spark, root):
    """Three classes: the return flag, and a flag predicted from the score."""
    score = F.col("score")
    guess = F.when(score > 0.7, "R").when(score > 0.3, "N").otherwise("A")
    return scored_lines(spark, root).select(F.col("l_returnflag").alias("label"), guess.alias("prediction"))


CLASS_SQL = f"""{SCORED_SQL},
c AS (SELECT l_returnflag AS label, CASE WHEN score > 0.7 THEN 'R' WHEN score > 0.3 THEN 'N' ELSE 'A' END AS prediction FROM scored),
k AS (SELECT DISTINCT label AS class FROM c),
t AS (SELECT class, count(*) FILTER (WHERE label = class AND prediction = class) AS tp, count(*) FILTER (WHERE label <> class AND prediction = class) AS fp,
      count(*) FILTER (WHERE label = class AND prediction <> class) AS fn, count(*) FILTER (WHERE label = class) AS support FROM k, c GROUP BY class),
pr AS (SELECT *, coalesce(tp::DOUBLE / nullif(tp + fp, 0), 0) AS precision, coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0) AS recall FROM t),
f AS (SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1 FROM pr)"""
WEIGHTED = """sum(tp)::DOUBLE / sum(support) AS accuracy, sum(precision * support) / sum(support) AS precision,
sum(recall * support) / sum(support) AS recall, sum(f1 * support) / sum(support) AS f1_score"""


@query(
    "eval_weighted_prf",
    f"""WITH {CLASS_SQL}, w AS (SELECT {WEIGHTED} FROM f)
SELECT round(accuracy, 9) AS accuracy, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1_score, 9) AS f1_score FROM w""",
)
def eval_weighted_prf(spark, root):
    return rounded(evaluate.weighted_metrics(class_calls(spark, root), "label", "prediction"), 9)


@query(
    "eval_confusion_matrix",
    f"""WITH {CLASS_SQL}, a AS (SELECT label AS x FROM c UNION SELECT prediction FROM c)
SELECT r.x AS label, s.x AS prediction, (SELECT count(*) FROM c WHERE c.label = r.x AND c.prediction = s.x) AS n FROM a r, a s""",
)
def eval_confusion_matrix(spark, root):
    """The zero-filled grid of all classes."""
    return evaluate.confusion_matrix(class_calls(spark, root), "label", "prediction", empty_cells=True)


@query("eval_confusion_cells", f"WITH {CLASS_SQL} SELECT label, prediction, count(*) AS n FROM c GROUP BY ALL")
def eval_confusion_cells(spark, root):
    return evaluate.confusion_matrix(class_calls(spark, root), "label", "prediction")


@query(
    "eval_auc_groups",
    f"""WITH {SCORED_SQL}, s AS (SELECT nullif(o_custkey % 1500, 0) AS model, label, score FROM scored JOIN orders ON l_orderkey = o_orderkey),
per_score AS (SELECT model, score, CAST(sum(label) AS DOUBLE) AS pos, CAST(sum(1 - label) AS DOUBLE) AS neg FROM s GROUP BY ALL),
curve AS (SELECT *, sum(neg) OVER (PARTITION BY model ORDER BY score) AS below FROM per_score)
SELECT model, CASE WHEN sum(pos) * sum(neg) > 0 THEN round(sum(pos * (below - neg / 2)) / (sum(pos) * sum(neg)), 9) END AS auc_roc
FROM curve GROUP BY model""",
)
def eval_auc_groups(spark, root):
    """More groups than any limit, the NULL group among them."""
    orders = table(spark, root, "orders").select("o_orderkey", F.nullif(F.col("o_custkey") % 1500, F.lit(0)).alias("g"))
    rows = scored_lines(spark, root).join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return rounded(evaluate.auc_roc(rows, "label", "score", F.col("g")), 9)


@query(
    "eval_per_class",
    f"""WITH {CLASS_SQL} SELECT class, tp, fp, fn, support, round(precision, 9) AS precision, round(recall, 9) AS recall,
round(f1, 9) AS f1 FROM f""",
)
def eval_per_class(spark, root):
    return rounded(evaluate.per_class(class_calls(spark, root), "label", "prediction"), 9)


BINARY_CLASS_SQL = CLASS_SQL.replace(
    "l_returnflag AS label, CASE WHEN score > 0.7 THEN 'R' WHEN score > 0.3 THEN 'N' ELSE 'A' END AS prediction",
    f"label, CASE WHEN score > {CUT} THEN 1 ELSE 0 END AS prediction",
)
REPORT_SQL = f"""{BINARY_CLASS_SQL}, w AS (SELECT {WEIGHTED} FROM f),
{CURVE_STEPS_SQL},
report AS (SELECT 'accuracy' AS metric, accuracy AS value FROM w UNION ALL SELECT 'precision', precision FROM w
UNION ALL SELECT 'recall', recall FROM w UNION ALL SELECT 'f1_score', f1_score FROM w
UNION ALL SELECT 'auc_roc', sum(pos * (n - fp + neg / 2)) / max(p) / max(n) FROM curve)"""


@query("eval_from_predictions", f"WITH {REPORT_SQL} SELECT metric, round(value, 9) AS value FROM report")
def eval_from_predictions(spark, root):
    return rounded(evaluate.evaluate(calls(spark, root), "label", "prediction", "score"), 9)


@query(
    "eval_threshold_gate",
    f"""WITH {REPORT_SQL}, limits AS (SELECT * FROM (VALUES ('accuracy', 0.5::DOUBLE), ('precision', 0.7::DOUBLE),
  ('recall', 0.7::DOUBLE), ('auc_roc', 0.5::DOUBLE), ('lift', 1.0::DOUBLE)) v(metric, threshold))
SELECT l.metric, threshold, round(value, 9) AS value, coalesce(value >= threshold, false) AS passed
FROM limits l LEFT JOIN report r ON l.metric = r.metric""",
)
def eval_threshold_gate(spark, root):
    """A metric that was not measured does not pass."""
    report = evaluate.evaluate(calls(spark, root), "label", "prediction", "score")
    limits = {"accuracy": 0.5, "precision": 0.7, "recall": 0.7, "auc_roc": 0.5, "lift": 1.0}
    return rounded(evaluate.threshold_gate(report, limits), 9)


@query(
    "eval_verdict",
    f"""WITH {CALLS_SQL}, a AS (SELECT avg(CASE WHEN label = prediction THEN 1.0::DOUBLE ELSE 0 END) AS v FROM calls)
SELECT CASE WHEN v > 0.75 THEN 'PASSED' ELSE 'FAILED' END AS verdict,
CASE WHEN v > 0.90 THEN 'excellent' WHEN v > 0.80 THEN 'good' ELSE 'needs improvement' END AS tier FROM a""",
)
def eval_verdict(spark, root):
    accuracy = evaluate.accuracy(calls(spark, root), "label", "prediction")
    verdict = F.when(F.col("accuracy") > 0.75, "PASSED").otherwise("FAILED")
    return accuracy.select(verdict.alias("verdict"), evaluate.accuracy_tier(F.col("accuracy")).alias("tier"))


# --- scoring ---------------------------------------------------------------------------


@query(
    "score_preprocess",
    WITH_GAPS + f"""SELECT CASE WHEN trim(charges_text) = '' THEN 0.0::DOUBLE ELSE TRY_CAST(trim(charges_text) AS DOUBLE) END AS charges_text,
tenure_months, CASE segment WHEN 'AUTOMOBILE' THEN 2 WHEN 'BUILDING' THEN 1 ELSE 0 END AS segment,
replace({TENURE_CASE}, 'Invalid', 'Unknown') AS tenure_bin FROM gaps""",
)
def score_preprocess(spark, root):
    rows = gapped_customers(spark, root).select("c_custkey", "charges_text", "tenure_months", "segment")
    codes = {"segment": {"HOUSEHOLD": 0, "BUILDING": 1, "AUTOMOBILE": 2}}
    return scoring.preprocess(rows, "charges_text", "tenure_months", binning.TENURE_BINS, codes, ["c_custkey"])


@query(
    "score_batch_formula",
    f"""WITH {EVENTS_SQL} SELECT event_id, CASE WHEN prediction = 1.0 THEN 'Churn' ELSE 'Retained' END AS prediction_label,
round(probability, 4) AS churn_probability, round(probability * 100, 2) AS confidence_percentage FROM scored_events""",
)
def score_batch_formula(spark, root):
    """The output columns of batch scoring on a formula probability."""
    scored = scored_events(table(spark, root, "events"))
    out = scoring.output_columns(scored, F.col("prediction"), F.col("probability"), stamp=False)
    return rounded(out.select("event_id", "prediction_label", "churn_probability", "confidence_percentage"), 4)


@query(
    "score_format",
    f"""WITH {SCORED_SQL} SELECT l_orderkey, l_linenumber, CASE WHEN score > {CUT} THEN 'Churn' ELSE 'Retained' END AS status,
CAST(CAST(round(score * 100) AS BIGINT) AS VARCHAR) || '%' AS confidence_text,
round((1 - score) * 100, 2) AS retained_pct, round(score * 100, 2) AS churn_pct FROM scored""",
)
def score_format(spark, root):
    out = scoring.formatted(calls(spark, root), F.col("prediction"), F.col("score"))
    return out.select("l_orderkey", "l_linenumber", "status", "confidence_text", "retained_pct", "churn_pct")


@query(
    "score_risk_bands",
    f"""WITH {EVENTS_SQL} SELECT CASE WHEN probability > 0.7 THEN 'high' WHEN probability > 0.5 THEN 'medium' ELSE 'low' END AS risk_band,
count(*) AS n FROM scored_events GROUP BY 1""",
)
def score_risk_bands(spark, root):
    return scoring.risk_bands(scored_events(table(spark, root, "events")), F.col("probability"))


@query(
    "score_confidence",
    f"""WITH {SCORED_SQL} SELECT l_orderkey, l_linenumber, score,
CASE WHEN abs(score - 0.5) > 0.3 THEN 'high' ELSE 'medium' END AS confidence FROM scored""",
)
def score_confidence(spark, root):
    scored = scored_lines(spark, root).select("l_orderkey", "l_linenumber", "score")
    return scoring.with_confidence(scored, F.col("score"))
