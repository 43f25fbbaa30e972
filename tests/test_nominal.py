import json
import subprocess
import sys

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from tabflow.operators import models
from tabflow.operators.nominal import TableIndexer
from tabflow.sources.shared import new_path
from tests.conftest import rows


@pytest.fixture(scope="module")
def colours(spark):
    data = [(i, c, float(i % 7)) for i, c in enumerate(["red", "red", "blue", "blue", "green", "red", "a b", ""] * 20)]
    return spark.createDataFrame(data, "id int, colour string, x double").withColumn("size", (F.col("id") % 3).cast("int"))


def test_codes_are_those_of_the_library_indexer(colours):
    columns = ["colour", "size"]
    theirs = StringIndexer(inputCols=columns, outputCols=["c", "s"], handleInvalid="keep").fit(colours).transform(colours)
    mine = TableIndexer(columns, ["c", "s"]).fit(colours).transform(colours)
    assert mine.columns == [*colours.columns, "c", "s"]
    assert rows(mine.select("id", "c", "s"), "id") == rows(theirs.select("id", "c", "s"), "id")


def test_unknown_and_missing_categories(spark, colours):
    new = spark.createDataFrame([(1, "red"), (2, "never"), (3, None)], "id int, colour string")
    coded = TableIndexer(["colour"]).fit(colours).transform(new)
    assert rows(coded.select("id", "colour_index"), "id") == [(1, 0.0), (2, 5.0), (3, 5.0)]
    with_null = colours.withColumn("colour", F.when(F.col("id") % 2 == 0, F.col("colour")))
    model = TableIndexer(["colour"]).fit(with_null)
    assert rows(model.transform(new).select("id", "colour_index"), "id")[2] == (3, 0.0)  # half of the rows
    nothing = TableIndexer(["colour"]).fit(colours.limit(0)).transform(new)
    assert {r["colour_index"] for r in nothing.collect()} == {0.0}


def test_metadata_holds_a_number_instead_of_the_categories(colours):
    coded = TableIndexer(["colour"]).fit(colours).transform(colours)
    assert coded.schema["colour_index"].metadata["ml_attr"] == {"type": "nominal", "name": "colour_index", "num_vals": 6}


def test_saved_stage_codes_alike_in_another_session(spark, colours):
    model = Pipeline(stages=[TableIndexer(["colour"])]).fit(colours)
    path = new_path(spark, "stage")
    model.save(path)
    expected = rows(model.transform(colours).select("id", "colour_index"), "id")
    assert rows(PipelineModel.load(path).transform(colours).select("id", "colour_index"), "id") == expected
    program = f"""
import json
from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
new = spark.createDataFrame([("red",), ("never",), ("blue",)], "colour string")
print(json.dumps([r["colour_index"] for r in PipelineModel.load({path!r}).transform(new).collect()]))
"""
    done = subprocess.run([sys.executable, "-c", program], capture_output=True, text=True, timeout=300, check=True)
    assert json.loads(done.stdout.strip().splitlines()[-1]) == [0.0, 5.0, 1.0]
    assert TableIndexer(["colour"]).getOutputCols() == ["colour_index"]


def test_estimator_is_saved_with_its_columns(spark):
    path = new_path(spark, "estimator")
    TableIndexer(["a"], ["b"]).save(path)
    assert TableIndexer.load(path).pairs() == [("a", "b")]


def test_stage_scores_a_stream(spark, colours):
    model = TableIndexer(["colour"]).fit(colours)
    path = new_path(spark, "colours")
    colours.write.json(path)
    stream = model.transform(spark.readStream.schema(colours.schema).json(path)).select("id", "colour_index")
    query = stream.writeStream.format("memory").queryName("coded_colours").trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert rows(spark.table("coded_colours"), "id") == rows(model.transform(colours).select("id", "colour_index"), "id")


def test_many_categories_fit_and_score(spark):
    ids = spark.range(200_000, numPartitions=8)
    wide = ids.select(
        F.concat(F.lit("user-"), F.col("id").cast("string")).alias("user"), (F.col("id") % 10).cast("double").alias("x")
    ).withColumn("label", (F.col("x") > 4).cast("double"))
    model = models.fit(wide, "logistic", ["x"], ["user"], maxIter=3)
    assert model.stages[0].getOrDefault("sizes") == [200_000]
    scored = models.probabilities(model, wide).groupBy("label").agg(F.avg("score").alias("p"))
    low, high = (r["p"] for r in scored.orderBy("label").collect())
    assert low < high
