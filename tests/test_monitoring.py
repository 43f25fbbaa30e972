from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabflow.operators import drift, monitor
from tabflow.sources.shared import new_path
from tests.conftest import counted, rows


def frame(spark, **columns):
    names = list(columns)
    kinds = ["string" if isinstance(next(x for x in v if x is not None), str) else "double" for v in columns.values()]
    data = list(zip(*[[x if x is None or isinstance(x, str) else float(x) for x in v] for v in columns.values()]))
    return spark.createDataFrame(data, ", ".join(f"{n} {k}" for n, k in zip(names, kinds)))


def ks_by_hand(a, b):
    points = np.unique(np.concatenate([a, b]))
    share = lambda x: np.searchsorted(np.sort(x), points, side="right") / len(x)
    return np.abs(share(a) - share(b)).max()


def test_ks_against_brute_force_with_a_hot_value(spark):
    rng = np.random.default_rng(3)
    ref = {"x": rng.normal(size=900).round(3), "y": rng.random(900)}
    cur = {"x": rng.normal(0.8, size=700).round(3), "y": rng.random(700)}
    ref["y"][:300] = 0.25
    cur["y"][:300] = 0.75
    out = {r["feature"]: r for r in drift.drift_ks(frame(spark, **ref), frame(spark, **cur), ["x", "y"]).collect()}
    for f in ("x", "y"):
        assert out[f]["statistic"] == pytest.approx(ks_by_hand(ref[f], cur[f]), abs=1e-12)
    assert out["x"]["drift_detected"] and out["x"]["p_value"] < 1e-6
    same = drift.drift_ks(frame(spark, **ref), frame(spark, **ref), ["x"]).first()
    assert (same["statistic"], same["p_value"], same["magnitude"]) == (0.0, 1.0, "low")


def test_ks_without_values_on_one_side(spark):
    ref, cur = frame(spark, x=[1, 2, 3], y=[1, 1, 1]), frame(spark, x=[1, 2, 3], y=[1, 1, 1]).withColumn("x", F.lit(None).cast("double"))
    assert [r["feature"] for r in drift.drift_ks(ref, cur, ["x", "y"]).collect()] == ["y"]


def test_chi_square(spark):
    ref = frame(spark, c=["a"] * 60 + ["b"] * 40)
    cur = frame(spark, c=["a"] * 20 + ["b"] * 30 + [None])
    out = drift.drift_chi2(ref, cur, ["c"]).first()
    assert out["statistic"] == pytest.approx((20 - 30) ** 2 / 30 + (30 - 20) ** 2 / 20)
    assert out["df"] == 1 and out["p_value"] == pytest.approx(0.0038924, abs=1e-6) and out["magnitude"] == "high"


def test_a_new_category_is_drift_and_smoothing_softens_it(spark):
    ref, cur = frame(spark, c=["a"] * 500 + ["b"] * 500), frame(spark, c=["a"] * 50 + ["b"] * 49 + ["new"])
    out = drift.drift_chi2(ref, cur, ["c"]).first()
    assert out["statistic"] == float("inf") and out["p_value"] == 0.0 and out["drift_detected"]
    soft = drift.drift_chi2(ref, cur, ["c"], smoothing=5.0).first()
    assert 0 < soft["statistic"] < 10 and not soft["drift_detected"]


def test_psi(spark):
    ref, cur = frame(spark, x=range(1000)), frame(spark, x=range(500, 1500))
    out = drift.drift_psi(ref, cur, ["x"], exact=True).first()
    splits = [sorted(range(1000))[int(p * 1000 / 10) - 1] for p in range(1, 10)]
    shares = lambda v: np.bincount(np.searchsorted(splits, v, side="right"), minlength=10) / len(v)
    r, c = np.maximum(shares(range(1000)), 1e-4), np.maximum(shares(range(500, 1500)), 1e-4)
    assert out["psi"] == pytest.approx(((c - r) * np.log(c / r)).sum()) and out["drift_detected"]
    near = drift.drift_psi(ref, cur, ["x"]).first()
    assert near["psi"] == pytest.approx(out["psi"], rel=0.05)
    assert drift.drift_psi(ref, ref, ["x"]).first()["psi"] == pytest.approx(0.0)


def test_drift_score_and_shared_features(spark):
    ks = spark.createDataFrame([("x", 0.4, True), ("y", 0.1, False)], "feature string, statistic double, drift_detected boolean")
    chi2 = spark.createDataFrame([("c", 0.01, True)], "feature string, p_value double, drift_detected boolean")
    assert rows(drift.drift_score(ks, chi2, 4)) == [(True, 2, pytest.approx((0.4 + 0.99) / 4))]
    assert rows(drift.drift_score(ks.limit(0), chi2.limit(0), 4)) == [(False, 0, 0.0)]
    a = frame(spark, x=[1], c=["u"], only=[2])
    b = frame(spark, x=[1], c=["u"], d=["v"])
    assert drift.shared_features(a, b) == (["x"], ["c"])


def test_aligned_counts_fill_both_sides(spark):
    ref, cur = frame(spark, c=["a", "a", "b"]), frame(spark, c=["b", "z"])
    assert rows(drift.aligned_counts(ref, cur, ["c"]), "value") == [("c", "a", 2, 0), ("c", "b", 1, 1), ("c", "z", 0, 1)]


def test_performance_counts_repeated_keys_like_a_join(spark):
    rng = np.random.default_rng(4)
    predictions = spark.createDataFrame(
        [(int(k), int(s > 0.5), float(s)) for k, s in zip(rng.integers(0, 60, 300), rng.random(300).round(2))],
        "id int, prediction int, score double",
    ).unionByName(spark.range(150).selectExpr("7 as id", "1 as prediction", "0.9D as score"))
    truth = spark.createDataFrame([(int(k), int(y)) for k, y in zip(rng.integers(0, 50, 120), rng.integers(0, 2, 120))], "id int, label int")
    watched, seen = counted(predictions)
    out = dict(rows(monitor.performance(watched, truth, ["id"], "label", "prediction", "score")))
    assert seen.value == 450
    joined = monitor.with_truth(predictions, truth, ["id"]).toPandas()
    y, p = joined.label == 1, joined.prediction == 1
    assert out["num_samples"] == len(joined)
    assert out["accuracy"] == pytest.approx((y == p).mean())
    assert out["precision"] == pytest.approx((y & p).sum() / p.sum())
    assert out["recall"] == pytest.approx((y & p).sum() / y.sum())
    pos, neg = joined.score[y].to_numpy(), joined.score[~y].to_numpy()
    wins = (pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()
    assert out["auc"] == pytest.approx(wins / len(pos) / len(neg))


@pytest.mark.parametrize(
    "drifted, degraded, level, kinds",
    [
        (False, False, "info", ["status"]),
        (True, False, "warning", ["data_drift"]),
        (False, True, "critical", ["performance_degradation"]),
        (True, True, "critical", ["data_drift", "performance_degradation"]),
    ],
)
def test_report_levels(spark, drifted, degraded, level, kinds):
    score = spark.range(1).select(F.lit(drifted).alias("overall_drift_detected"))
    value = 0.5 if degraded else 0.9
    metrics = spark.createDataFrame([(m, value) for m in monitor.PERFORMANCE_THRESHOLDS], "metric string, value double")
    out = monitor.report(score, monitor.performance_issues(metrics)).collect()
    assert [r["type"] for r in out] == kinds and {r["alert_level"] for r in out} == {level}


def test_window_and_freshness(spark):
    df = spark.createDataFrame(
        [("a", datetime(2024, 1, 1)), ("a", datetime(2024, 1, 8, 12)), ("b", datetime(2024, 1, 15, 23))], "k string, t timestamp_ntz"
    )
    end = F.lit("2024-01-15").cast("date")
    assert [r[0] for r in rows(monitor.last_days(df, "t", end, 7), "t")] == ["a", "b"]
    as_of = F.lit("2024-01-16 12:00:00").cast("timestamp_ntz")
    out = {r["k"]: (r["age_hours"], r["is_fresh"]) for r in monitor.freshness(df, "t", as_of, ["k"]).collect()}
    assert out == {"a": (192.0, False), "b": (13.0, True)}


def test_run_log(spark):
    path = new_path(spark, "log")
    for run, value in (("one", 1.0), ("two", 4.0), ("three", 9.0)):
        metrics = spark.createDataFrame([("rows", value)], "metric string, value double")
        monitor.log_run(metrics, path, run, datetime(2024, 1, 1))
    log = monitor.read_log(spark, path)
    assert log.count() == 3
    assert rows(monitor.compare_runs(log, "one", "three")) == [("rows", 1.0, 9.0, 8.0)]
