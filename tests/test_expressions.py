import math

import pytest
from pyspark.sql import functions as F

from tabflow.functions import expressions as ex
from tabflow.functions import pvalues
from tests.conftest import rows


def test_missing_is_type_aware(spark):
    df = spark.createDataFrame(
        [(1, "a", 1.0), (None, "", float("nan")), (3, None, None)], "i int, s string, d double"
    )
    flags = rows(df.select(*[ex.is_missing(df, c).alias(c) for c in df.columns]))
    assert flags == [(False, False, False), (True, True, True), (False, True, True)]


@pytest.mark.parametrize(
    "text, strict, lenient",
    [
        (" 12.5 ", 12.5, 12.5),
        ("1.2.3", None, None),
        ("", None, 0.0),
        ("   ", None, 0.0),
        ("-4", None, -4.0),
        (None, None, None),
        ("x", None, None),
    ],
)
def test_numbers_in_text(spark, text, strict, lenient):
    df = spark.createDataFrame([(text,)], "t string")
    assert rows(df.select(ex.numeric_text(F.col("t")), ex.blank_to_zero(F.col("t")))) == [(strict, lenient)]


def test_clip_and_outside_leave_unknown_values(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (-5.0,), (5.0,), (50.0,)], "x double")
    low, high = F.lit(0.0), F.lit(10.0)
    clipped = [r[0] for r in rows(df.select(ex.clip(F.col("x"), low, high)))]
    assert clipped[0] is None and math.isnan(clipped[1]) and clipped[2:] == [0.0, 5.0, 10.0]
    assert [r[0] for r in rows(df.select(ex.outside(F.col("x"), low, high)))] == [False, False, True, False, True]


def test_labels_and_bands(spark):
    df = spark.createDataFrame([(0.95, 1.0), (0.7, 1.0), (0.5, 0.0), (0.1, 0.0), (None, 0.0)], "p double, y double")
    out = rows(df.select(ex.risk_band(F.col("p")), ex.confidence(F.col("p")), ex.prediction_label(F.col("y"))))
    assert [r[0] for r in out] == ["high", "medium", "low", "low", None]
    assert [r[1] for r in out[:4]] == ["high", "medium", "medium", "high"]
    assert [r[2] for r in out] == ["Churn", "Churn", "Retained", "Retained", "Retained"]
    assert rows(df.limit(1).select(ex.percent_text(F.col("p")), ex.percent(F.col("p")))) == [("95%", 95.0)]


@pytest.mark.parametrize(
    "name, found",
    [
        ("/x/predictions_2024-01-05.csv", "2024-01-05"),
        ("/x/predictions_2024-13-45.csv", None),
        ("/x/predictions_latest.csv", None),
        ("/x/ground_truth_2024-01-05.csv", None),
    ],
)
def test_date_in_name(spark, name, found):
    df = spark.createDataFrame([(name,)], "p string")
    (value,), = rows(df.select(ex.date_in_name(F.col("p"), "predictions").cast("string")))
    assert value == found


def test_hash_bucket_does_not_depend_on_partitioning(spark):
    df = spark.range(1000)
    one = rows(df.repartition(1).select("id", ex.hash_bucket(["id"]).alias("b")), "id")
    many = rows(df.repartition(7).select("id", ex.hash_bucket(["id"]).alias("b")), "id")
    assert one == many
    assert 120 < sum(b < 2000 for _, b in one) < 280


def chi_square_tail(x, df, steps=400_000, upper=400.0):
    """Midpoint integration of the density, as an independent value."""
    width = (upper - x) / steps
    scale = 1 / (2 ** (df / 2) * math.gamma(df / 2))
    return sum(
        scale * (t ** (df / 2 - 1)) * math.exp(-t / 2) * width
        for t in (x + (i + 0.5) * width for i in range(steps))
    )


@pytest.mark.parametrize("x, df", [(0.5, 1), (3.841459, 1), (5.991465, 2), (2.0, 3), (18.307, 10), (70.0, 5), (90.0, 101)])
def test_chi_square_tail(spark, x, df):
    value = spark.range(1).select(pvalues.chi_square_tail(F.lit(x), F.lit(df))).first()[0]
    assert value == pytest.approx(chi_square_tail(x, df), abs=1e-6)


def test_chi_square_tail_ends(spark):
    tail = lambda x, df: spark.range(1).select(pvalues.chi_square_tail(F.lit(x), F.lit(df))).first()[0]
    assert tail(0.0, 4) == 1.0
    assert tail(float("inf"), 4) == 0.0
    assert tail(3.0, 0) == 1.0
    assert 0.0 <= tail(5000.0, 3) < 1e-100


@pytest.mark.parametrize("argument, expected", [(1.0, 0.2699996), (1.36, 0.0494859), (0.05, 1.0), (3.0, 3.0459e-8)])
def test_kolmogorov_tail(spark, argument, expected):
    n = 1000
    d = argument / math.sqrt(n * n / (n + n))
    value = spark.range(1).select(pvalues.kolmogorov_tail(F.lit(d), F.lit(n), F.lit(n))).first()[0]
    assert value == pytest.approx(expected, abs=1e-5)


@pytest.mark.parametrize("df, x", [(2001, 2001.0), (2400, 2300.0), (5000, 5200.0), (20_000, 19_700.0), (100_000, 101_000.0)])
def test_chi_square_tail_of_many_degrees(spark, df, x):
    """Against the sum of Poisson terms for the even degrees beside it."""

    def even(n):
        y, log, total = x / 2, -x / 2, 0.0
        for k in range(n // 2):
            total += math.exp(log)
            log += math.log(y) - math.log(k + 1)
        return total

    expected = even(df) if df % 2 == 0 else (even(df - 1) + even(df + 1)) / 2
    value = spark.range(1).select(pvalues.chi_square_tail(F.lit(x), F.lit(df))).first()[0]
    assert value == pytest.approx(expected, abs=2e-5)


def test_keys_that_read_alike_have_different_digests(spark):
    pairs = [("a:b", "c"), ("a", "b:c"), (None, "c"), ("", "c"), ("~", "c"), ("1=a", ""), ("1", "=a")]
    df = spark.createDataFrame(pairs, "x string, y string")
    assert df.select(ex.key_digest(["x", "y"], 42)).distinct().count() == len(pairs)
