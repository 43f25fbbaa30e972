from pyspark.sql import functions as F

from tabflow.operators import monitor
from tabflow.sources.buckets import write_buckets
from tests.conftest import executed, rows


def sides(spark):
    predictions = spark.range(2000).select("id", (F.col("id") % 2).alias("prediction"), (F.col("id") % 100 / 100).alias("score"))
    truth = spark.range(0, 3000, 3).select("id", (F.col("id") % 4 == 0).cast("int").alias("label"))
    again = truth.filter("id < 300").withColumn("label", 1 - F.col("label"))  # keys with two truths
    return predictions, truth.unionByName(again)


def test_a_join_of_equal_buckets_has_no_exchange(spark):
    predictions, truth = sides(spark)
    stored, known = write_buckets(predictions, ["id"], 6), write_buckets(truth, ["id"], 6)
    joined = monitor.with_truth(stored.hint("merge"), known, ["id"])
    plan = executed(joined)
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert rows(joined, "id", "label") == rows(monitor.with_truth(predictions, truth, ["id"]), "id", "label")
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("tabflow_")]


def test_cells_of_buckets_are_those_of_tables(spark):
    predictions, truth = sides(spark)
    args = (["id"], "label", "prediction", "score")
    cells = monitor.bucketed_cells(write_buckets(predictions, ["id"], 4), write_buckets(truth, ["id"], 4), *args)
    before_cells = executed(cells).split("SortMergeJoin")[1]
    assert "Exchange" not in before_cells
    plain = monitor.truth_cells(predictions, truth, *args)
    assert rows(cells, "prediction", "score") == rows(plain, "prediction", "score")


def test_other_numbers_of_buckets_still_join_right(spark):
    predictions, truth = sides(spark)
    joined = monitor.with_truth(write_buckets(predictions, ["id"], 4), write_buckets(truth, ["id"], 3), ["id"])
    assert joined.count() == monitor.with_truth(predictions, truth, ["id"]).count()


def test_empty_tables_are_stored(spark):
    predictions, truth = sides(spark)
    stored = write_buckets(predictions.limit(0), ["id"], 3)
    assert stored.count() == 0 and monitor.with_truth(stored, write_buckets(truth, ["id"], 3), ["id"]).count() == 0
