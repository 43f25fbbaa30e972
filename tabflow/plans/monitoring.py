"""Queries: drift, performance against truth, reports, freshness and the run log."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tabflow.operators import drift, monitor, profile
from tabflow.plans.inputs import (
    EVENTS_SQL,
    PREDICTIONS_SQL,
    SPLIT_DAY,
    document_predictions,
    document_truth,
    event_halves,
    line_halves,
    moment,
    scored_events,
)
from tabflow.plans.registry import query, rounded
from tabflow.sources.buckets import write_buckets
from tabflow.sources.shared import new_path, persist_state
from tabflow.sources.tables import table

END_DAY = "2024-01-20"


@query(
    "monitor_window",
    f"""WITH {EVENTS_SQL} SELECT CAST(ts AS DATE) AS day, count(*) AS num_predictions, count(*) FILTER (WHERE prediction = 1) AS churn_count,
round(avg(probability), 6) AS avg_probability FROM scored_events
WHERE CAST(ts AS DATE) BETWEEN DATE '{END_DAY}' - INTERVAL 7 DAY AND DATE '{END_DAY}' GROUP BY 1""",
)
def monitor_window(spark, root):
    """Predictions per day of the window that ends on the run date."""
    recent = monitor.last_days(scored_events(table(spark, root, "events")), "ts", F.lit(END_DAY).cast("date"))
    daily = recent.groupBy(F.to_date("ts").alias("day")).agg(
        F.count("*").alias("num_predictions"),
        F.count_if(F.col("prediction") == 1).alias("churn_count"),
        F.avg("probability").alias("avg_probability"),
    )
    return rounded(daily)


@query(
    "monitor_baseline",
    f"""WITH {EVENTS_SQL}, w AS (SELECT DATE '{END_DAY}' - INTERVAL 7 DAY AS first)
SELECT 'baseline' AS part, count(*) AS n, round(avg(probability), 6) AS avg_probability FROM scored_events, w
WHERE CAST(ts AS DATE) BETWEEN first - INTERVAL 30 DAY AND first - INTERVAL 1 DAY
UNION ALL SELECT 'window', count(*), round(avg(probability), 6) FROM scored_events, w WHERE CAST(ts AS DATE) BETWEEN first AND DATE '{END_DAY}'""",
)
def monitor_baseline(spark, root):
    """The monitoring window beside the thirty days before it."""
    scored, end = scored_events(table(spark, root, "events")), F.lit(END_DAY).cast("date")
    united = None
    for name, rows in (("baseline", monitor.baseline_days(scored, "ts", end)), ("window", monitor.last_days(scored, "ts", end))):
        part = rows.agg(F.lit(name).alias("part"), F.count("*").alias("n"), F.avg("probability").alias("avg_probability"))
        united = part if united is None else united.unionByName(part)
    return rounded(united)


KS_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_orderkey"]


def ks_sql(column: str) -> str:
    return f"""(WITH c AS (SELECT CAST({column} AS DOUBLE) AS v, count(*) FILTER (WHERE l_shipdate < TIMESTAMP '1998-01-01') AS r,
  count(*) FILTER (WHERE l_shipdate >= TIMESTAMP '1998-01-01') AS k FROM lineitem GROUP BY 1),
t AS (SELECT sum(r)::DOUBLE AS nr, sum(k)::DOUBLE AS nk FROM c),
g AS (SELECT abs(sum(r) OVER (ORDER BY v) / nr - sum(k) OVER (ORDER BY v) / nk) AS gap, nr, nk FROM c, t),
d AS (SELECT max(gap) AS s, max(nr) AS nr, max(nk) AS nk FROM g),
p AS (SELECT s, CASE WHEN nr * nk / (nr + nk) * s * s < 0.01 THEN 1.0 ELSE (SELECT least(1.0, greatest(0.0,
   2 * sum(CASE WHEN i % 2 = 1 THEN 1 ELSE -1 END * exp(-2.0 * i * i * nr * nk / (nr + nk) * s * s)))) FROM range(1, 101) x(i)) END AS p FROM d)
SELECT '{column}' AS feature, round(s, 9) AS statistic, round(CAST(p AS DOUBLE), 9) AS p_value, s > 0.3 AS drift_detected,
  CASE WHEN s > 0.5 THEN 'high' WHEN s > 0.3 THEN 'medium' ELSE 'low' END AS magnitude FROM p)"""


@query("drift_ks", " UNION ALL ".join(ks_sql(c) for c in KS_COLUMNS))
def drift_ks(spark, root):
    reference, current = line_halves(spark, root)
    return rounded(drift.drift_ks(reference, current, KS_COLUMNS), 9)


EVENT_SIDES = f"""sides AS (SELECT event_type, count(*) FILTER (WHERE ts < TIMESTAMP '{SPLIT_DAY}') AS r, count(*) FILTER (WHERE ts >= TIMESTAMP '{SPLIT_DAY}') AS k
  FROM events GROUP BY 1)"""
# with five categories the tail of the chi-square distribution has a closed form
CHI2_SQL = f"""{EVENT_SIDES},
chi AS (SELECT sum((k - e) ** 2 / e) AS s, CAST(count(*) - 1 AS INTEGER) AS df
  FROM (SELECT k, r::DOUBLE / (SELECT sum(r) FROM sides) * (SELECT sum(k) FROM sides) AS e FROM sides)),
chi_p AS (SELECT s, df, exp(-s / 2) * (1 + s / 2) AS p FROM chi)"""


@query(
    "drift_chi2",
    f"""WITH {CHI2_SQL} SELECT 'event_type' AS feature, round(s, 6) AS statistic, df, round(p, 6) AS p_value, p < 0.05 AS drift_detected,
CASE WHEN p < 0.01 THEN 'high' WHEN p < 0.03 THEN 'medium' ELSE 'low' END AS magnitude FROM chi_p""",
)
def drift_chi2(spark, root):
    reference, current = event_halves(spark, root)
    return rounded(drift.drift_chi2(reference, current, ["event_type"]))


def psi_sql(column: str, bins: int) -> str:
    shares = ", ".join(str(i / bins) for i in range(1, bins))
    return f"""WITH q AS (SELECT quantile_disc({column}, [{shares}]) AS s FROM events WHERE ts < TIMESTAMP '{SPLIT_DAY}'),
b AS (SELECT len(list_filter(s, lambda x: x <= {column})) AS bin, count(*) FILTER (WHERE ts < TIMESTAMP '{SPLIT_DAY}') AS r,
      count(*) FILTER (WHERE ts >= TIMESTAMP '{SPLIT_DAY}') AS k FROM events, q GROUP BY 1),
sh AS (SELECT greatest(r::DOUBLE / (SELECT sum(r) FROM b), 0.0001) AS r, greatest(k::DOUBLE / (SELECT sum(k) FROM b), 0.0001) AS k FROM b)
SELECT '{column}' AS feature, round(sum((k - r) * ln(k / r)), 9) AS psi, sum((k - r) * ln(k / r)) > 0.2 AS drift_detected FROM sh"""


@query("drift_psi", psi_sql("value", 10))
def drift_psi(spark, root):
    reference, current = event_halves(spark, root)
    return rounded(drift.drift_psi(reference, current, ["value"], exact=True), 9)


@query("drift_psi_fine", psi_sql("value", 100))
def drift_psi_fine(spark, root):
    """A hundred bins."""
    reference, current = event_halves(spark, root)
    return rounded(drift.drift_psi(reference, current, ["value"], bins=100, exact=True), 9)


VALUE_KS = f"""vk AS (SELECT max(abs(rs / nr - ks / nk)) AS s FROM (SELECT sum(r) OVER (ORDER BY value) AS rs, sum(k) OVER (ORDER BY value) AS ks,
  sum(r) OVER ()::DOUBLE AS nr, sum(k) OVER ()::DOUBLE AS nk FROM (SELECT value, count(*) FILTER (WHERE ts < TIMESTAMP '{SPLIT_DAY}') AS r,
  count(*) FILTER (WHERE ts >= TIMESTAMP '{SPLIT_DAY}') AS k FROM events GROUP BY 1)))"""
ID_KS = VALUE_KS.replace("vk AS", "ik AS").replace("value", "event_id")


@query(
    "drift_score",
    f"""WITH {CHI2_SQL}, {VALUE_KS}, {ID_KS},
hits AS (SELECT s > 0.3 AS hit, s AS w FROM vk UNION ALL SELECT s > 0.3, s FROM ik UNION ALL SELECT p < 0.05, 1 - p FROM chi_p)
SELECT bool_or(hit) AS overall_drift_detected, count(*) FILTER (WHERE hit) AS drifted_features,
round(coalesce(sum(w) FILTER (WHERE hit), 0) / 3.0::DOUBLE, 6) AS drift_score FROM hits""",
)
def drift_score(spark, root):
    reference, current = event_halves(spark, root)
    ks = drift.drift_ks(reference, current, ["value", "event_id"])
    chi2 = drift.drift_chi2(reference, current, ["event_type"])
    return rounded(drift.drift_score(ks, chi2, 3))


FEATURE_KINDS = {"event_id": "numerical", "user_id": "numerical", "value": "numerical", "event_type": "categorical"}


@query(
    "drift_feature_types",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, '{kind}' AS kind, count({c}) FILTER (WHERE ts < TIMESTAMP '{SPLIT_DAY}') AS n_ref,
count({c}) FILTER (WHERE ts >= TIMESTAMP '{SPLIT_DAY}') AS n_cur FROM events"""
        for c, kind in FEATURE_KINDS.items()
    ),
)
def drift_feature_types(spark, root):
    """Columns that both sides have, by type, with their values; the reference lacks the properties."""
    reference, current = event_halves(spark, root)
    return drift.shared_feature_table(reference.drop("props"), current)


PERFORMANCE_SQL = f"""{PREDICTIONS_SQL},
m AS (SELECT count(*)::DOUBLE AS n, count(*) FILTER (WHERE label = 1 AND prediction = 1)::DOUBLE AS tp, count(*) FILTER (WHERE label = 0 AND prediction = 1)::DOUBLE AS fp,
  count(*) FILTER (WHERE label = 1 AND prediction = 0)::DOUBLE AS fn, count(*) FILTER (WHERE label = prediction)::DOUBLE AS hits FROM joined),
curve AS (SELECT pos, neg, sum(neg) OVER (ORDER BY score) AS below FROM (SELECT score, sum(label)::DOUBLE AS pos, sum(1 - label)::DOUBLE AS neg
  FROM joined GROUP BY score)),
report AS (SELECT 'accuracy' AS metric, hits / n AS value FROM m UNION ALL SELECT 'f1_score', 2 * tp / (2 * tp + fp + fn) FROM m
  UNION ALL SELECT 'precision', tp / (tp + fp) FROM m UNION ALL SELECT 'recall', tp / (tp + fn) FROM m UNION ALL SELECT 'num_samples', n FROM m
  UNION ALL SELECT 'auc', sum(pos * (below - neg / 2)) / sum(pos) / sum(neg) FROM curve),
limits AS (SELECT * FROM (VALUES ('accuracy', 0.85::DOUBLE), ('f1_score', 0.80::DOUBLE), ('precision', 0.78::DOUBLE), ('recall', 0.82::DOUBLE)) v(metric, threshold)),
issues AS (SELECT l.metric, value, threshold, CASE WHEN threshold - value > 0 THEN threshold - value END AS degradation,
  threshold - value > 0 AS degraded FROM limits l JOIN report r ON l.metric = r.metric)"""


def performance(spark, root):
    predictions, truth = document_predictions(spark, root), document_truth(spark, root)
    return monitor.performance(predictions, truth, ["doc_id"], "label", "prediction", "score")


@query("monitor_performance", f"WITH {PERFORMANCE_SQL} SELECT metric, round(value, 9) AS value FROM report")
def monitor_performance(spark, root):
    return rounded(performance(spark, root), 9)


BUCKETS = 8


def stored_sides(spark, root):
    """Predictions and truth written once in buckets of the key."""
    sides = document_predictions(spark, root), document_truth(spark, root)
    return [write_buckets(side, ["doc_id"], BUCKETS) for side in sides]


@query("join_pred_truth_bucketed", f"WITH {PREDICTIONS_SQL} SELECT doc_id, round(score, 9) AS score, prediction, label FROM joined")
def join_pred_truth_bucketed(spark, root):
    """The monitoring join of stored buckets: no exchange on either side."""
    predictions, truth = stored_sides(spark, root)
    return rounded(monitor.with_truth(predictions.hint("merge"), truth, ["doc_id"]), 9)


@query("monitor_performance_bucketed", f"WITH {PERFORMANCE_SQL} SELECT metric, round(value, 9) AS value FROM report")
def monitor_performance_bucketed(spark, root):
    predictions, truth = stored_sides(spark, root)
    cells = monitor.bucketed_cells(predictions, truth, ["doc_id"], "label", "prediction", "score")
    return rounded(monitor.performance_of_cells(persist_state(cells, "cells")), 9)


@query(
    "monitor_issues",
    f"WITH {PERFORMANCE_SQL} SELECT metric, round(value, 9) AS value, threshold, round(degradation, 9) AS degradation, degraded FROM issues",
)
def monitor_issues(spark, root):
    return rounded(monitor.performance_issues(performance(spark, root)), 9)


@query(
    "monitor_report",
    f"""WITH {PERFORMANCE_SQL}, {CHI2_SQL}, {VALUE_KS}, {ID_KS},
f AS (SELECT (SELECT bool_or(degraded) FROM issues) AS degraded, (SELECT s > 0.3 FROM vk) OR (SELECT s > 0.3 FROM ik) OR (SELECT p < 0.05 FROM chi_p) AS drifted),
lv AS (SELECT *, CASE WHEN degraded THEN 'critical' WHEN drifted THEN 'warning' ELSE 'info' END AS alert_level FROM f)
SELECT alert_level, 'data_drift' AS type, 'high' AS priority, 'Significant data drift detected. Consider retraining the model with recent data.' AS message,
  'retrain_model' AS action FROM lv WHERE drifted
UNION ALL SELECT alert_level, 'performance_degradation', 'high', 'Model performance has degraded below acceptable thresholds.', 'investigate_and_retrain' FROM lv WHERE degraded
UNION ALL SELECT alert_level, 'status', 'info', 'Model is performing within acceptable parameters.', 'continue_monitoring' FROM lv WHERE NOT degraded AND NOT drifted""",
)
def monitor_report(spark, root):
    reference, current = event_halves(spark, root)
    ks = drift.drift_ks(reference, current, ["value", "event_id"])
    chi2 = drift.drift_chi2(reference, current, ["event_type"])
    score = persist_state(drift.drift_score(ks, chi2, 3), "drift")
    issues = persist_state(monitor.performance_issues(performance(spark, root)), "issues")
    return monitor.report(score, issues)


@query(
    "freshness",
    """SELECT event_type, max(ts) AS latest, round(date_diff('second', date_trunc('second', max(ts)), TIMESTAMP '2024-01-30 18:00:00') / 3600.0::DOUBLE, 3) AS age_hours,
date_diff('second', date_trunc('second', max(ts)), TIMESTAMP '2024-01-30 18:00:00') <= 24 * 3600 AS is_fresh FROM events GROUP BY event_type""",
)
def freshness(spark, root):
    as_of = moment("2024-01-30 18:00:00")
    return rounded(monitor.freshness(table(spark, root, "events"), "ts", as_of, ["event_type"]), 3)


@query(
    "run_metrics_log",
    f"""WITH {EVENTS_SQL}, runs AS (SELECT CASE WHEN ts < TIMESTAMP '{SPLIT_DAY}' THEN 1 ELSE 2 END AS run, * FROM scored_events),
m AS (SELECT run, count(*)::DOUBLE AS rows, count(*) FILTER (WHERE prediction = 1)::DOUBLE AS churned, avg(probability) AS p FROM runs GROUP BY run),
l AS (SELECT run, 'rows' AS metric, rows AS value FROM m UNION ALL SELECT run, 'churned', churned FROM m UNION ALL SELECT run, 'avg_probability', p FROM m)
SELECT metric, round(max(value) FILTER (WHERE run = 1), 6) AS first_value, round(max(value) FILTER (WHERE run = 2), 6) AS second_value,
round(max(value) FILTER (WHERE run = 2) - max(value) FILTER (WHERE run = 1), 6) AS change FROM l GROUP BY metric""",
)
def run_metrics_log(spark, root):
    """Two runs appended to one log table, then compared."""
    path = new_path(spark, "runs")
    for number, half in enumerate(event_halves(spark, root), start=1):
        row = profile.inference_summary(scored_events(half), "prediction", "probability")
        metrics = {"rows": "num_predictions", "churned": "churn_count", "avg_probability": "avg_probability"}
        pairs = [F.struct(F.lit(m).alias("metric"), F.col(c).cast("double").alias("value")) for m, c in metrics.items()]
        monitor.log_run(row.select(F.inline(F.array(*pairs))), path, f"run-{number}", datetime(2024, 1, number))
    return rounded(monitor.compare_runs(monitor.read_log(spark, path), "run-1", "run-2"))
