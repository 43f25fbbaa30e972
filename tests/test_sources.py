import time
from datetime import date

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabflow.sources import files, shared
from tests.conftest import rows


def test_csv_defaults_and_overrides(spark, tmp_path):
    path = str(tmp_path / "in.csv")
    with open(path, "w") as f:
        f.write('name,charge,note\n  ann , 1.5 ,"say ""hi"", ok"\nbob,,x\n,NaN,\n')
    schema = "name string, charge double, note string"
    out = rows(files.scan_csv(spark, path, spark.createDataFrame([], schema).schema))
    assert out[0] == ("ann", 1.5, 'say "hi", ok') and out[1] == ("bob", None, "x")
    assert out[2][0] is None and out[2][1] != out[2][1] and out[2][2] is None
    inferred = files.scan_csv(spark, path)
    assert dict(inferred.dtypes) == {"name": "string", "charge": "double", "note": "string"}
    assert files.load(spark, path, "csv", header="false").count() == 4


def test_write_modes(spark, tmp_path):
    path, df = str(tmp_path / "t"), spark.range(3)
    files.save(df, path, mode="error")
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        files.save(df, path, mode="error")
    files.save(df, path, mode="append")
    files.save(spark.range(50), path, mode="ignore")
    assert spark.read.parquet(path).count() == 6
    files.save(df, path)
    assert spark.read.parquet(path).count() == 3


def test_reuse_builds_once_unless_forced(spark, tmp_path):
    path, calls = str(tmp_path / "t"), []

    def build():
        calls.append(1)
        return spark.range(len(calls))

    assert not files.is_written(spark, path)
    sizes = [files.reuse_or_build(spark, path, build, force=f).count() for f in (False, False, True)]
    assert sizes == [1, 1, 2] and len(calls) == 2 and files.is_written(spark, path)


def test_dated_files_outside_the_window_are_not_opened(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.IntegerType())])
    for name in ("2024-01-01", "2024-01-08", "2024-01-15", "2024-01-16", "latest"):
        (tmp_path / f"predictions_{name}.csv").write_text(f"id\n{len(name)}\n")
    (tmp_path / "ground_truth_2024-01-15.csv").write_text("id\n99\n")
    found = files.scan_dated(spark, f"{tmp_path}/*.csv", "predictions", schema, date(2024, 1, 15), 7)
    assert [str(r[1]) for r in rows(found, "prediction_date")] == ["2024-01-08", "2024-01-15"]
    truth = files.scan_dated(spark, f"{tmp_path}/*.csv", "ground_truth", schema, date(2024, 1, 15), 7, "truth_date")
    assert rows(truth) == [(99, date(2024, 1, 15))]
    # a file outside the window is unreadable as CSV rows of this schema but never touched
    plan = found._jdf.queryExecution().executedPlan()
    found.collect()
    scan = plan.collectLeaves().apply(0)
    assert scan.metrics().apply("numFiles").value() == 2


def test_vectors_leave_as_arrays(spark, tmp_path):
    df = spark.createDataFrame([(1, Vectors.dense(0.25, 0.75))], ["id", "probability"])
    files.save_predictions(df, str(tmp_path / "p"))
    back = files.load(spark, str(tmp_path / "p"), "json", "id int, probability array<double>")
    assert rows(back) == [(1, [0.25, 0.75])]


def test_export_keeps_the_row_link(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.0, "Yes"), (2, 3.0, "No")], "k int, x double, y string")
    files.export_split(df.filter("k = 1"), df.filter("k = 2"), "y", "k", str(tmp_path))
    assert rows(files.scan_csv(spark, f"{tmp_path}/csv/X_train")) == [(1, 2.0)]
    assert rows(files.scan_csv(spark, f"{tmp_path}/csv/Y_test")) == [(2, "No")]
    assert rows(spark.read.parquet(f"{tmp_path}/parquet/train")) == [(1, 2.0, "Yes")]


def test_state_is_written_to_the_shared_folder(spark):
    state = shared.persist_state(spark.range(5).agg(F.sum("id").alias("s")))
    assert rows(state) == [(10,)]
    folder = shared.shared_dir(spark)
    assert any(folder.rstrip("/") in f for f in state.inputFiles())
    assert shared.new_path(spark, "a") != shared.new_path(spark, "a")


def test_a_workspace_leaves_nothing_behind(spark):
    with shared.workspace(spark) as root:
        state = shared.persist_state(spark.range(5).toDF("x"))
        assert state.count() == 5 and state.inputFiles()[0].split(":")[-1].lstrip("/").startswith(root.split(":")[-1].lstrip("/"))
    folder = spark._jvm.org.apache.hadoop.fs.Path(root)
    assert not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)
    assert not shared.new_path(spark, "x").startswith(root)


def test_shuffles_of_a_block_are_freed_when_a_query_ends(spark):
    def held():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {f for f in found.mkString("|").split("|") if "shuffle_" in f}

    before, name = held(), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    shared.persist_state(spark.range(1000).repartition(3, "id"))
    assert held() - before
    with shared.shuffles_freed(spark):
        before = held()
        state = shared.persist_state(spark.range(1000).repartition(3, "id"))
        until = time.time() + 20
        while held() - before and time.time() < until:
            time.sleep(0.2)
        assert not held() - before and state.count() == 1000
    assert spark.conf.get(name) == "false"
