"""Order statistics and running totals against brute force, with hot values and tiny groups."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabflow.functions import ordered
from tests.conftest import counted, rows

SHARES = [0.5, 0.0, 0.1, 0.25, 0.75, 1.0, 0.99]


def quantile(values, p):
    """Smallest value whose cumulative share is at least p."""
    values = sorted(values)
    return next(v for i, v in enumerate(values, 1) if i >= max(p * len(values), 1.0))


def quantiles_of(spark, groups, accuracy=ordered.BRACKET_ACCURACY, parts=4):
    longest = max(map(len, groups.values()))
    padded = [list(v) + [None, float("nan")][: longest - len(v)] for v in groups.values()]
    padded = [v + [None] * (longest - len(v)) for v in padded]
    data = [tuple(None if x is None else float(x) for x in row) for row in zip(*padded)]
    df = spark.createDataFrame(data, ", ".join(f"{g} double" for g in groups)).repartition(parts)
    found = rows(ordered.exact_quantiles(df, list(groups), SHARES, accuracy), "feature", "position")
    assert found == [(g, i, quantile(groups[g], p)) for g in sorted(groups) for i, p in enumerate(SHARES)]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-5, 5) | st.floats(-1e9, 1e9), min_size=1, max_size=60))
def test_quantiles_of_small_groups(spark, values):
    quantiles_of(spark, {"a": [float(v) for v in values], "one": [7.0]})


def test_quantiles_with_a_hot_value(spark):
    rng = np.random.default_rng(1)
    hot = [3.25] * 4000 + list(rng.normal(size=6000).round(4))
    quantiles_of(spark, {"hot": hot, "flat": [1.0] * 500, "wide": list(np.exp(rng.normal(size=3000) * 5))})


@pytest.mark.parametrize("accuracy", [100, 1000])
def test_quantiles_hold_for_narrow_brackets_over_many_partitions(spark, accuracy):
    rng = np.random.default_rng(7)
    quantiles_of(spark, {"a": np.round(np.exp(rng.normal(size=20_000) * 3), 6).tolist()}, accuracy, 13)


def test_quantiles_skip_missing_and_unknown_columns(spark):
    df = spark.createDataFrame([(None, None), (float("nan"), None), (2.0, None), (1.0, None)], "a double, b double")
    assert rows(ordered.exact_quantiles(df, ["a", "b"], [0.5])) == [("a", 0, 1.0)]


def test_quantiles_read_the_input_twice(spark):
    watched, seen = counted(spark.range(3000).select(F.rand(1).alias("a"), F.rand(2).alias("b")))
    ordered.exact_quantiles(watched, ["a", "b"], [0.25, 0.75]).collect()
    assert seen.value == 2 * 3000


def test_brackets_that_miss_their_rank_are_an_error(spark):
    values = spark.range(1000).select(F.col("id").cast("double").alias("a"))
    for shift in (-100.0, 100.0):
        low = values.agg(F.array(F.lit(490.0 + shift), F.lit(510.0 + shift)).alias("a"))
        with pytest.raises(Exception, match="outside its bracket"):
            ordered.quantiles_in(values, low, ["a"], [0.5], [0]).collect()
    right = values.agg(F.array(F.lit(490.0), F.lit(510.0)).alias("a"))
    assert rows(ordered.quantiles_in(values, right, ["a"], [0.5], [0])) == [("a", 0, 499.0)]


def test_running_totals(spark):
    rng = np.random.default_rng(2)
    data = {("x", float(v)): int(n) for v, n in zip(rng.normal(size=2000).round(3), rng.integers(1, 9, 2000))}
    data.update({(None, float(i)): 1 for i in range(10)})
    data[("x", 0.5)] = 100_000
    counts = spark.createDataFrame([(k, v, n) for (k, v), n in data.items()], "key string, value double, n long")
    out = ordered.running_totals(counts, ["key"], "value", ["n"])
    total = {"x": 0, None: 0}
    whole = {k: sum(n for (g, _), n in data.items() if g == k) for k in total}
    for key, value, n, run, everything in rows(out, "key", "value"):
        total[key] += n
        assert (n, run, everything) == (data[(key, value)], total[key], whole[key])
    assert total == whole


def test_windows_run_inside_ranges(spark):
    long = spark.range(20_000).select(F.lit("f").alias("feature"), F.rand(3).alias("value"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r[1] for r in rows(ordered.in_ranges(long, [F.col("feature"), F.col("value")]).groupBy("_range").count())]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) == 4 and max(sizes) < 2 * 20_000 / 4


def test_running_totals_read_the_input_once(spark):
    watched, seen = counted(spark.range(5000).select(F.lit("f").alias("feature"), F.rand(3).alias("value")))
    counts = watched.groupBy("feature", "value").agg(F.count("*").alias("n"))
    ordered.running_totals(counts, ["feature"], "value", ["n"]).collect()
    assert seen.value == 5000


@pytest.mark.parametrize("sorted_rows", [50_000, 5])
def test_quotas_by_digest(spark, monkeypatch, sorted_rows):
    monkeypatch.setattr(ordered, "SORTED_ROWS", sorted_rows)
    df = spark.range(3000).select(F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("g"), F.md5(F.col("id").cast("string")).alias("digest"))
    df = df.unionByName(df.filter("g = 1").limit(1)).cache()
    found = {r[0]: r[1:] for r in rows(ordered.digest_quota(df, ["g"], lambda n: F.floor(n * 0.2)))}
    groups = {}
    for g, digest in rows(df):
        groups.setdefault(g, []).append(digest)
    assert found == {g: (len(d), len(d) // 5, sorted(d)[len(d) // 5 - 1]) for g, d in groups.items()}
    none = {r[0]: r[1:] for r in rows(ordered.digest_quota(df, ["g"], lambda n: F.lit(0)))}
    assert none == {g: (len(d), 0, None) for g, d in groups.items()}


def test_numbered_counts_from_zero_in_every_group(spark):
    df = spark.range(5000).select((F.col("id") % 3).alias("g"), F.col("id").alias("v")).repartition(6)
    out = ordered.numbered(df, [F.col("g"), F.col("v").desc()], "g")
    for g in range(3):
        members = sorted((v for v in range(5000) if v % 3 == g), reverse=True)
        found = rows(out.filter(F.col("g") == g).select("v", "position"), "position")
        assert found == [(v, i) for i, v in enumerate(members)]
