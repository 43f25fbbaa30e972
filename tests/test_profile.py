import pytest
from pyspark.sql import functions as F

from tabflow.operators import evaluate, missing, outliers, profile
from tests.conftest import counted, rows


def test_duplicates_tell_null_from_blank_and_merge_zero_signs(spark):
    df = spark.createDataFrame(
        [("a", 0.0), ("a", -0.0), (None, 1.0), ("", 1.0), (None, 1.0), ("null", None), (None, None)],
        "s string, x double",
    )
    assert rows(profile.duplicate_count(df)) == [(2,)]
    assert rows(profile.duplicate_count(df.limit(0))) == [(0,)]


def test_duplicates_with_a_hot_row(spark):
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("v"))
    assert rows(profile.duplicate_count(df)) == [(2999,)]


def test_quality_gate_verdicts(spark):
    good = spark.createDataFrame([(1, "a", 0), (2, "b", 1), (2, "b", 1)], "k int, s string, y int")
    out = dict(rows(profile.quality_gate(good, "y")))
    assert out == {
        "total_rows": 3, "total_columns": 3, "missing_values": 0, "duplicate_rows": 1, "passed": 1, "target=0": 1, "target=1": 2,
    }
    bad = spark.createDataFrame([(1, None, 0), (None, "", None)], "k int, s string, y int")
    out = dict(rows(profile.quality_gate(bad, "y")))
    assert out["missing_values"] == 4 and out["passed"] == 0 and out["target=NULL"] == 1
    with pytest.raises(ValueError):
        profile.quality_gate(good, "absent")


@pytest.mark.parametrize(
    "profiled",
    [
        lambda df: profile.quality_gate(df, "l_returnflag"),
        lambda df: profile.profile_categorical(df, "l_returnflag"),
        lambda df: profile.class_distribution(df, "l_returnflag"),
        lambda df: profile.profile_numeric(df, ["l_quantity", "l_tax"]),
        lambda df: profile.distinct_count(df, ["l_quantity", "l_returnflag"]),
        lambda df: missing.missing_counts(df),
        lambda df: missing.column_modes(df, ["l_quantity", "l_returnflag"]),
        lambda df: outliers.fit_iqr(df, ["l_quantity", "l_tax"]),
        lambda df: evaluate.confusion_matrix(df, "l_returnflag", "l_linestatus"),
    ],
)
def test_profiles_read_the_table_once(spark, smoke, profiled):
    lines = spark.read.parquet(f"{smoke}/lineitem.parquet").drop("l_shipdate")
    watched, seen = counted(lines)
    profiled(watched).collect()
    assert seen.value == lines.count()


def test_profile_numeric_exact_and_approximate(spark):
    df = spark.createDataFrame([(float(i), i) for i in range(1, 102)] + [(None, 0)], "x double, n int")
    exact = rows(profile.profile_numeric(df, ["x", "n"], exact=True), "feature")
    near = rows(profile.profile_numeric(df, ["x", "n"]), "feature")
    assert exact == near
    feature, dtype, nulls, share, mean, _, low, high, q1, median, q3 = exact[1]
    assert (feature, dtype, nulls, mean, low, high, q1, median, q3) == ("x", "double", 1, 51.0, 1.0, 101.0, 26.0, 51.0, 76.0)
    assert share == pytest.approx(100 / 102)


def test_profile_categorical_counts_null_as_a_value(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "s string")
    out = profile.profile_categorical(df, "s", k=2)
    assert rows(out.select("null_count", "null_pct", "n_distinct", "value", "n")) == [
        (1, 25.0, 3, "a", 2),
        (1, 25.0, 3, None, 1),
    ]


def test_class_distribution_and_describe_of_an_empty_table(spark):
    df = spark.createDataFrame([], "s string, x double")
    assert rows(profile.class_distribution(df, "s")) == []
    assert dict((r[1], r[2]) for r in rows(profile.describe(df)))["count"] == 0.0


def test_stage_summary(spark):
    df = spark.range(100)
    steps = profile.stage_summary(df, F.col("id") < 10, F.col("id") >= 95, F.col("id") % 5 == 0)
    out = dict(rows(steps))
    assert out["initial_rows"] == 100 and out["rows_removed_missing"] == 10 and out["rows_removed_outliers"] == 5
    assert out["final_train_rows"] + out["final_test_rows"] == 85 and out["test_split_ratio"] == pytest.approx(17 / 85)
    assert dict(rows(profile.stage_summary(df.limit(0), F.lit(True), F.lit(False), F.lit(True))))["test_split_ratio"] is None


def test_table_types_and_column_stats(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, "b")], "k int, s string")
    assert rows(profile.table_types(df), "position") == [(0, "k", "int"), (1, "s", "string")]
    assert rows(profile.column_stats(df, "s")) == [(2, 2, "a", "b")]
    assert rows(profile.column_stats(df, "k", exact=False)) == [(3, 2, 1, 2)]


def test_rows_a_microsecond_apart_are_no_copies(spark):
    texts = ["2024-01-01 00:00:00.000001", "2024-01-01 00:00:00.000002"]
    df = spark.createDataFrame([(t,) for t in texts + texts[:1]], "t string")
    for kind in ("timestamp", "timestamp_ntz"):
        rows_ = df.select(F.col("t").cast(kind).alias("t"), F.lit(1).alias("y"))
        assert profile.duplicate_count(rows_).first()[0] == 1
        gate = {r["metric"]: r["value"] for r in profile.quality_gate(rows_, "y").collect()}
        assert gate["duplicate_rows"] == 1
