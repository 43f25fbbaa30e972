import math

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import Imputer, MinMaxScaler, StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import functions as F

from tabflow.operators import binning, encoding, missing, outliers, projection, scaling, split
from tabflow.operators.nominal import TableIndexer
from tabflow.plans import prepare
from tabflow.sources.shared import new_path
from tests.conftest import counted, planned, rows


# --- missing values ---


def test_fill_by_mean_median_and_mode(spark):
    df = spark.createDataFrame(
        [(1, 1.0, "a"), (2, None, "b"), (3, 3.0, None), (4, float("nan"), "b"), (5, 8.0, "a"), (6, 8.0, "")],
        "k int, x double, s string",
    )
    mean = missing.apply_fill(df, missing.fit_fill(df, ["x"], "mean"))
    assert [r[1] for r in rows(mean, "k")] == [1.0, 5.0, 3.0, 5.0, 8.0, 8.0]
    median = missing.apply_fill(df, missing.fit_fill(df, ["x"], "median", exact=True))
    assert [r[1] for r in rows(median, "k")] == [1.0, 3.0, 3.0, 3.0, 8.0, 8.0]
    near = missing.apply_fill(df, missing.fit_fill(df, ["x"], "median"))
    assert rows(near, "k") == rows(median, "k")
    mode = missing.apply_fill(df, missing.fit_fill(df, ["s", "x"], "mode"))
    assert [r[2] for r in rows(mode, "k")] == ["a", "b", "a", "b", "a", "a"]  # tie: the smaller value
    assert [r[1] for r in rows(mode, "k")] == [1.0, 8.0, 3.0, 8.0, 8.0, 8.0]


def test_fill_of_an_empty_column_changes_nothing(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "k int, x double")
    for method in ("mean", "mode"):
        assert rows(missing.apply_fill(df, missing.fit_fill(df, ["x"], method)), "k") == [(1, None), (2, None)]


def test_fill_all_numeric_equals_the_ml_imputer(spark):
    df = spark.createDataFrame([(1.0, 10), (None, 20), (float("nan"), None), (4.0, 40)], "x double, n int")
    for method in ("mean", "other"):
        stage = missing.imputer(df.select("x"), method)
        assert isinstance(stage, Imputer)
        expected = [r[0] for r in stage.fit(df).transform(df).collect()]
        assert [r[0] for r in rows(missing.fill_all_numeric(df, method))] == expected


def test_drop_and_constant_and_placeholder(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (2, None, 2.0), (3, "c", None)], "k int, s string, x double")
    assert [r[0] for r in rows(missing.drop_missing(df), "k")] == [1]
    assert [r[0] for r in rows(missing.drop_missing(df, ["x"]), "k")] == [1, 2]
    assert [r[2] for r in rows(missing.fill_constant(df, 0.0, ["x"]), "k")] == [1.0, 2.0, 0.0]
    assert [r[1] for r in rows(missing.placeholder(df, ["s"]), "k")] == ["a", "MISSING", "c"]
    with pytest.raises(ValueError):
        missing.fit_fill(df, ["x"], "guess")


def test_missing_counts(spark):
    df = spark.createDataFrame([("", None), ("a", float("nan")), (None, 1.0)], "s string, x double")
    assert dict(rows(missing.missing_counts(df))) == {"s": 2, "x": 2, "TOTAL": 4}


# --- outliers ---


@pytest.fixture()
def spiky(spark):
    data = [(i, float(i % 10), float(i % 7)) for i in range(100)]
    data += [(100, 500.0, 1.0), (101, 500.0, -400.0), (102, None, 3.0), (103, None, None)]
    return spark.createDataFrame(data, "k int, a double, b double")


def test_iqr_bounds_exact_and_approximate_agree(spiky):
    exact = rows(outliers.bounds_table(outliers.fit_iqr(spiky, ["a", "b"], exact=True)), "feature")
    near = rows(outliers.bounds_table(outliers.fit_iqr(spiky, ["a", "b"])), "feature")
    assert exact == near


def test_outlier_removal_needs_enough_flags_and_keeps_null(spiky):
    state = outliers.fit_iqr(spiky, ["a", "b"])
    gone = lambda n: {103 - i for i in range(104)} - {r[0] for r in rows(outliers.remove(spiky, state, n))}
    assert gone(2) == {101}
    assert gone(1) == {100, 101}
    flagged = rows(outliers.flag(spiky, state).filter("k >= 102"), "k")
    assert [r[3:] for r in flagged] == [(False, False), (False, False)]


def test_cap_and_unknown_method(spiky):
    state = outliers.fit_iqr(spiky, ["a", "b"])
    capped = outliers.handle(spiky, state, "cap")
    low, high = capped.agg(F.min("b"), F.max("a")).first()
    bounds = {r[0]: r[1:] for r in rows(outliers.bounds_table(state))}
    assert (low, high) == (bounds["b"][0], bounds["a"][1])
    assert capped.filter("a IS NULL").count() == 2
    with pytest.raises(ValueError):
        outliers.handle(spiky, state, "hide")


def test_zscore(spark):
    df = spark.createDataFrame([(float(x),) for x in [0] * 50 + [1] * 50 + [40]], "x double")
    flagged = outliers.flag(df, outliers.fit_zscore(df, ["x"]))
    assert rows(flagged.filter("x_outlier").select("x")) == [(40.0,)]


# --- binning ---


def test_custom_bins(spark):
    df = spark.createDataFrame([(x,) for x in (0.0, 24.0, 24.5, 25.0, 72.0, 73.0, -1.0, None)], "tenure double")
    out = binning.bin_custom(df, "tenure", binning.TENURE_BINS, keep=True)
    labels = ["New", "New", "Invalid", "Established", "Loyal", "Invalid", "Invalid", "Invalid"]
    assert [r[1] for r in rows(out)] == labels
    dropped = binning.bin_custom(df, "tenure", {"low": [0, 30], "all": [0]})
    assert dropped.columns == ["tenureBins"]
    assert [r[0] for r in rows(dropped)] == ["low"] * 4 + ["all", "all", "Invalid", "Invalid"]


def test_buckets(spark):
    df = spark.createDataFrame([(x,) for x in (0.0, 9.99, 10.0, 20.0, 21.0, None, float("nan"))], "x double")
    keep = binning.bin_buckets(df, "x", [0, 10, 20])
    assert [r[0] for r in rows(keep)] == [0.0, 0.0, 1.0, 1.0, 2.0, 2.0, 2.0]
    named = binning.bin_buckets(df, "x", [0, 10, 20], ["lo", "hi"])
    assert [r[0] for r in rows(named)] == ["lo", "lo", "hi", "hi", "Unknown", "Unknown", "Unknown"]
    assert binning.bin_buckets(df, "x", [0, 10, 20], handle_invalid="skip").count() == 4
    with pytest.raises(Exception, match="outside the splits"):
        binning.bin_buckets(df, "x", [0, 10, 20], handle_invalid="error").collect()


# --- encoding ---


def test_index_equals_the_ml_indexer(spark):
    data = [(i, s) for i, s in enumerate(["b", "a", "c", "c", "d", "d", "a", "b", "z"])]
    df = spark.createDataFrame(data, "k int, s string")
    mine = encoding.apply_index(df, encoding.fit_index(df, ["s"]), ["s"])
    theirs = StringIndexer(inputCol="s", outputCol="i").fit(df).transform(df)
    assert [r[2] for r in rows(mine, "k")] == [int(r[2]) for r in rows(theirs, "k")]


def test_unseen_and_null_categories(spark):
    train = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,), (None,)], "s string")
    codes = encoding.fit_index(train, ["s"])
    assert dict((r[1], r[2]) for r in rows(codes)) == {"MISSING": 0, "a": 1, "b": 2}
    test = spark.createDataFrame([(1, "a"), (2, "new"), (3, None)], "k int, s string")
    assert [r[2] for r in rows(encoding.apply_index(test, codes, ["s"]), "k")] == [1, 3, 0]
    assert [r[2] for r in rows(encoding.apply_index(test, codes, ["s"], unseen="null"), "k")] == [1, None, 0]


def test_a_hot_category_and_many_rare_ones(spark):
    df = spark.range(9000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id").cast("string"))).alias("s")
    )
    coded = encoding.apply_index(df, encoding.fit_index(df, ["s"]), ["s"])
    assert coded.filter("s = 'hot'").select("s_index").distinct().collect()[0][0] == 0
    assert coded.agg(F.countDistinct("s_index"), F.max("s_index"), F.count("*")).first() == (6001, 6000, 9000)


def test_a_dictionary_too_large_to_broadcast_joins_by_sort_merge(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 40).cast("string")).alias("s"))
    codes = encoding.fit_index(df, ["s"])
    small = rows(encoding.apply_index(df, codes, ["s"]), "id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = encoding.apply_index(df, codes, ["s"])
        assert "SortMergeJoin" in planned(joined)
        assert rows(joined, "id") == small
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_ordinal_policies(spark):
    df = spark.createDataFrame([("One year",), ("Never",), (None,)], "Contract string")
    maps = {"Contract": encoding.CONTRACT_CODES, "absent": {"x": 1}}
    assert rows(encoding.encode_ordinal(df, maps)) == [(1,), (None,), (None,)]
    assert rows(encoding.encode_ordinal(df, maps, "default", 0)) == [(1,), (0,), (0,)]
    with pytest.raises(Exception, match="unmapped category"):
        encoding.encode_ordinal(df, maps, "error").collect()
    saved = rows(encoding.fixed_dictionary(df, {"Contract": encoding.CONTRACT_CODES}), "code")
    assert saved == [("Contract", "Month-to-month", 0), ("Contract", "One year", 1), ("Contract", "Two year", 2)]


def test_one_hot_and_target_and_decode(spark):
    df = spark.createDataFrame([("a", "Yes"), ("b", "No"), (None, "No")], "s string, y string")
    assert rows(encoding.one_hot(df, "s", ["a", "b"]).drop("s", "y")) == [(1, 0, 0), (0, 1, 0), (0, 0, 1)]
    labels = encoding.target_stage("y").fit(df).transform(df)
    assert [r[2] for r in rows(labels)] == [1.0, 0.0, 0.0]
    assert [r[0] for r in rows(df.select(encoding.target_label(F.col("y"), "Yes")))] == [1.0, 0.0, 0.0]
    back = encoding.decode_stage("label", "text", ["No", "Yes"]).transform(labels)
    assert [r[0] for r in rows(back.select("text"))] == ["Yes", "No", "No"]


# --- scaling ---


def test_scalers_equal_the_ml_ones(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (4.0, 5.0)], "x double, c double")
    state = scaling.fit_moments(df, ["x", "c"])
    vectors = VectorAssembler(inputCols=["x", "c"], outputCol="v").transform(df)
    small = MinMaxScaler(inputCol="v", outputCol="o").fit(vectors).transform(vectors)
    assert rows(scaling.scale_minmax(df, state)) == [tuple(r["o"]) for r in small.collect()]
    standard = StandardScaler(inputCol="v", outputCol="o", withMean=True, withStd=True).fit(vectors).transform(vectors)
    for mine, theirs in zip(rows(scaling.scale_standard(df, state)), standard.collect()):
        assert mine == pytest.approx(tuple(theirs["o"]))
    wide = scaling.scale_minmax(df.select("x"), scaling.fit_moments(df, ["x"]), -1, 1)
    assert [r[0] for r in rows(wide)] == pytest.approx([-1.0, -1 / 3, 1.0])


def test_scaling_keeps_null_and_uses_the_fitted_range(spark):
    train = spark.createDataFrame([(0.0,), (10.0,)], "x double")
    test = spark.createDataFrame([(1, 5.0), (2, 20.0), (3, None)], "k int, x double")
    scaled = scaling.scale_minmax(test, scaling.fit_moments(train, ["x"]))
    assert [r[1] for r in rows(scaled, "k")] == [0.5, 2.0, None]


def test_assemble_policies(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 3.0)], "a double, b double")
    assert scaling.assemble(df, ["a", "b"], "skip").count() == 1
    kept = scaling.assemble(df, ["a", "b"], "keep").collect()
    assert math.isnan(kept[1]["features"][0])


# --- splits ---


def test_random_split_is_a_partition_of_the_rows(spark):
    df = spark.range(3000).withColumn("y", F.col("id") % 2)
    assigned = split.assign_random(df, ["id"])
    train, test = split.train_test(assigned)
    assert train.count() + test.count() == 3000 and train.join(test, "id").count() == 0
    again = split.part(split.assign_random(df.repartition(5), ["id"]), "test")
    assert rows(again, "id") == rows(test, "id")
    assert "Exchange" not in planned(assigned)


def test_stratified_split_meets_the_quota_in_every_class(spark):
    label = F.when(F.col("id") < 6000, "big").when(F.col("id") < 6100, "small").when(F.col("id") < 6507, None)
    df = spark.range(6507 + 41).select("id", F.when(F.col("id") < 6507, label).otherwise("tiny").alias("y"))
    state = split.fit_stratified(df, "y", ["id"], 0.2)
    out = split.assign_stratified(df, state, "y", ["id"], 0.2)
    counts = {(r[0], r[1]): r[2] for r in rows(out.groupBy("y", "split").count())}
    assert {y: counts[(y, "test")] for y in ("big", "small", "tiny", None)} == {"big": 1200, "small": 20, "tiny": 8, None: 81}
    assert out.count() == 6548 and out.select("id").distinct().count() == 6548


def test_stratified_state(spark):
    df = spark.range(1004).select("id", F.when(F.col("id") < 1000, "a").otherwise("b").alias("y"))
    watched, seen = counted(df)
    state = rows(split.fit_stratified(watched, "y", ["id"], 0.2).select("y", "rows", "quota"), "y")
    assert state == [("a", 1000, 200), ("b", 4, 0)]
    assert seen.value == 2 * 1004  # bucket counts, then the one bucket that holds the quota


def test_stratified_split_falls_back_for_a_tiny_class(spark):
    df = spark.range(1000).withColumn("y", F.when(F.col("id") < 2, 1).otherwise(0))
    state = split.fit_stratified(df, "y", ["id"], 0.2)
    out = split.assign_stratified(df, state, "y", ["id"], 0.2)
    assert rows(out.select("id", "split"), "id") == rows(split.assign_random(df, ["id"], 0.2).select("id", "split"), "id")
    assert rows(out.select("split_rule").distinct()) == [("random",)]
    quota = split.assign_stratified(df, state, "y", ["id"], 0.2, on_small_class="quota")
    assert dict(rows(quota.filter("split = 'test'").groupBy("y").count())) == {0: 199}
    with pytest.raises(Exception, match="too small"):
        split.assign_stratified(df, state, "y", ["id"], 0.2, on_small_class="error").collect()
    with pytest.raises(ValueError):
        split.assign_stratified(df, state, "y", ["id"], 0.2, on_small_class="other")


def test_samples_by_two_text_columns_are_exact(spark):
    df = spark.range(2000).select(
        F.when(F.col("id") % 3 > 0, F.concat(F.lit("a:"), F.col("id").cast("string"))).alias("x"),
        F.concat_ws(":", F.lit("b"), (F.col("id") / 2).cast("int").cast("string"), (F.col("id") % 2).cast("string")).alias("y"),
    )
    assert projection.sample_rows(df, 101, ["x", "y"]).count() == 101


def test_nan_lies_in_no_bin(spark):
    df = spark.createDataFrame([(80.0,), (float("nan"),), (None,)], "x double")
    out = binning.bin_custom(df, "x", {"low": [0, 10], "high": [73]}, keep=True)
    assert [r["xBins"] for r in out.collect()] == ["high", "Invalid", "Invalid"]


def test_one_hot_from_fitted_categories(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "s string")
    fitted = encoding.fit_one_hot(df, ["s"])
    assert fitted == {"s": ["a", "b"]}
    out = encoding.one_hot(df, "s", fitted["s"])
    assert [tuple(r)[1:] for r in out.collect()] == [(1, 0, 0), (0, 1, 0), (1, 0, 0), (0, 0, 1)]
    with pytest.raises(ValueError, match="more than 1"):
        encoding.fit_one_hot(df, ["s"], bound=1)


def test_folds_and_three_way(spark):
    df = spark.range(2000)
    folds = rows(split.assign_folds(df, ["id"], 4).groupBy("fold").count(), "fold")
    assert [f for f, _ in folds] == [0, 1, 2, 3] and all(400 < n < 600 for _, n in folds)
    parts = dict(rows(split.assign_three_way(df, ["id"]).groupBy("split").count()))
    assert set(parts) == {"train", "validation", "test"} and sum(parts.values()) == 2000
    train, test = split.split_native(df, 0.2)
    assert train.count() + test.count() == 2000


def test_sample_rows_gives_exactly_n(spark):
    df = spark.range(500).repartition(6)
    for n in (0, 1, 17, 499, 500, 900):
        assert projection.sample_rows(df, n, ["id"]).count() == min(n, 500)
    first = rows(projection.sample_rows(df, 20, ["id"]), "id")
    assert first == rows(projection.sample_rows(df.repartition(2), 20, ["id"]), "id")
    assert projection.sample_rows(df.limit(0), 5, ["id"]).count() == 0


def test_require_and_cast(spark):
    df = spark.createDataFrame([("1", "x")], "a string, b string")
    with pytest.raises(ValueError, match="c"):
        projection.require(df, ["a", "c"])
    assert rows(projection.cast_columns(df, {"a": "int", "b": "int", "zz": "int"})) == [(1, None)]


# --- the whole preparation ---

ROLES = prepare.Roles(
    key="k", target="y", numeric=["x"], nominal=["s"], capped=["x"], bins={"t": {"lo": [0, 4], "hi": [5]}},
    ordinal={"tBins": {"lo": 0, "hi": 1}}, drop=["k"],
)


def test_preparation_is_fitted_on_train_and_survives_saving(spark):
    data = [(i, float(i % 11) if i % 5 else None, "ab"[i % 2], i % 10, i % 2) for i in range(200)]
    df = spark.createDataFrame(data, "k int, x double, s string, t int, y int")
    train, other = df.filter("k < 150"), df.filter("k >= 150")
    fitted = prepare.fit(train, ROLES, exact=True)
    done = fitted.apply(train)
    assert done.columns == ["x", "s", "y", "tBins", "s_index"]
    assert done.agg(F.min("x"), F.max("x")).first() == (0.0, 1.0)
    path = new_path(spark, "preparation")
    fitted.save(path)
    restored = prepare.restore(spark, ROLES, path)
    columns = sorted(done.columns)
    assert rows(restored.apply(other), *columns) == rows(fitted.apply(other), *columns)
    one = other.limit(1)  # a single row is scaled by the training range, not by itself
    assert rows(fitted.apply(one))[0][0] not in (None, 0.5) or rows(one)[0][1] is None


def test_ml_pipeline_of_the_same_steps(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("a", 3.0)], "s string, x double")
    stages = [TableIndexer(["s"]), encoding.one_hot_stage(["s"])]
    out = Pipeline(stages=stages).fit(df).transform(df)
    assert [r["s_encoded"].size for r in out.collect()] == [3, 3, 3]
