import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabflow.plans import streams
from tabflow.plans.catalogue import CATALOGUE
from tabflow.sources.shared import new_path
from tabflow.streaming import scoring as streaming
from tests.conftest import counted, rows

ONCE = {"availableNow": True}
SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("p", T.DoubleType())])


def put(path, name, lines):
    path.mkdir(exist_ok=True)
    (path / name).write_text("\n".join(lines) + "\n")


def scored(df):
    return df.withColumn("prediction", (F.col("p") > 0.5).cast("double"))


def test_batch_and_stream_agree_and_resume_adds_each_row_once(spark, tmp_path):
    source = tmp_path / "in"
    put(source, "a.json", ['{"id": 1, "p": 0.9}', '{"id": 2, "p": 0.1}'])
    sink, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")

    def run():
        stream = scored(streaming.json_stream(spark, str(source), SCHEMA, 1))
        streaming.drain(streaming.write_stream(stream, sink, checkpoint, trigger=ONCE))

    run()
    run()
    assert spark.read.parquet(sink).count() == 2
    put(source, "b.json", ['{"id": 3, "p": 0.6}'])
    run()
    batch = scored(spark.read.schema(SCHEMA).json(str(source)))
    assert rows(spark.read.parquet(sink), "id") == rows(batch, "id")


def test_a_replayed_batch_replaces_its_folder(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    put(source, "a.json", ['{"id": 1, "p": 0.9}', '{"id": 2, "p": 0.1}'])
    for checkpoint in ("one", "two"):  # a new checkpoint replays batch 0
        stream = streaming.json_stream(spark, str(source), SCHEMA)
        streaming.drain(streaming.write_batches(stream, scored, out, str(tmp_path / checkpoint), trigger=ONCE))
    assert spark.read.json(out).count() == 2


def test_empty_batches_write_nothing(spark, tmp_path):
    source, out = tmp_path / "in", tmp_path / "out"
    put(source, "a.json", ['{"id": 1, "p": 0.9}'])
    stream = streaming.json_stream(spark, str(source), SCHEMA).filter("id > 5")
    streaming.drain(streaming.write_batches(stream, scored, str(out), str(tmp_path / "cp"), trigger=ONCE))
    assert not out.exists()


def test_bad_fields_are_null_and_the_line_is_kept(spark, tmp_path):
    source, sink = tmp_path / "in", str(tmp_path / "out")
    put(source, "a.json", ['{"id": 1, "p": "x"}', '{"id": 2, "p": 0.5, "more": 1}', "not json"])
    stream = streaming.json_stream(spark, str(source), SCHEMA, bad_record="bad")
    streaming.drain(streaming.write_stream(stream, sink, str(tmp_path / "cp"), trigger=ONCE))
    out = rows(spark.read.parquet(sink))
    assert sorted(out, key=str) == sorted([(1, None, '{"id": 1, "p": "x"}'), (2, 0.5, None), (None, None, "not json")], key=str)


def test_a_failing_transform_is_raised(spark, tmp_path):
    put(tmp_path / "in", "a.json", ['{"id": 1, "p": 0.9}'])
    stream = streaming.json_stream(spark, str(tmp_path / "in"), SCHEMA)
    broken = lambda batch: batch.select("absent")
    with pytest.raises(Exception, match="absent"):
        streaming.drain(streaming.write_batches(stream, broken, str(tmp_path / "o"), str(tmp_path / "cp"), trigger=ONCE))


def test_windows_with_late_rows(spark, tmp_path):
    """One file per batch in name order: a row behind the watermark is dropped, a merely late one counts."""
    source = tmp_path / "in"
    schema = T.StructType([T.StructField("ts", T.TimestampType()), T.StructField("p", T.DoubleType())])
    line = lambda day, p: f'{{"ts": "2024-01-{day:02d}T10:00:00", "p": {p}}}'
    put(source, "1.json", [line(1, 0.9), line(2, 0.2)])
    put(source, "2.json", [line(6, 0.8), line(2, 0.6)])
    put(source, "3.json", [line(6, 0.1)])
    put(source, "4.json", [line(1, 0.9)])
    for i, name in enumerate(("1.json", "2.json", "3.json", "4.json")):
        os.utime(source / name, (1_700_000_000 + i * 10,) * 2)
    stream = scored(streaming.json_stream(spark, str(source), schema, 1))
    windows = streaming.windowed_metrics(stream, "ts", "prediction", "p", lateness="2 days")
    path = str(tmp_path / "out")
    streaming.drain(
        streaming.write_batches(windows, lambda b: b, path, str(tmp_path / "cp"), "parquet", "update", ONCE)
    )
    latest = streaming.latest_windows(spark.read.parquet(path))
    out = {str(r["window_start"])[:10]: (r["num_predictions"], r["churn_count"]) for r in latest.collect()}
    assert out == {"2024-01-01": (1, 1), "2024-01-02": (2, 1), "2024-01-06": (2, 1)}


def test_observed_metrics(spark, tmp_path):
    put(tmp_path / "in", "a.json", ['{"id": 1, "p": 0.9}', '{"id": 2, "p": 0.1}'])
    stream = streaming.observed(scored(streaming.json_stream(spark, str(tmp_path / "in"), SCHEMA)), "seen", "prediction", "p")
    query = streaming.write_stream(stream, str(tmp_path / "out"), str(tmp_path / "cp"), trigger=ONCE)
    streaming.drain(query)
    seen = [p.observedMetrics["seen"] for p in query.recentProgress if "seen" in p.observedMetrics]
    assert sum(m["num_predictions"] for m in seen) == 2 and sum(m["churn_count"] or 0 for m in seen) == 1


def test_batch_summary_per_micro_batch(spark, tmp_path):
    put(tmp_path / "in", "a.json", ['{"id": 1, "p": 0.9}', '{"id": 2, "p": 0.6}'])
    stream = scored(streaming.json_stream(spark, str(tmp_path / "in"), SCHEMA))
    path = new_path(spark, "summary")
    streaming.drain(
        streaming.write_batches(stream, streaming.batch_summary("prediction", "p"), path, str(tmp_path / "cp"), trigger=ONCE)
    )
    row = spark.read.json(path).first()
    assert (row["num_predictions"], row["high_risk"], row["medium_risk"], row["low_risk"]) == (2, 1, 1, 0)


def test_the_callers_schema_stays_as_it_is(spark, tmp_path):
    schema = T.StructType([T.StructField("a", T.LongType())])
    (tmp_path / "in").mkdir()
    for _ in range(2):
        stream = streaming.json_stream(spark, str(tmp_path / "in"), schema, bad_record="bad")
        assert stream.columns == ["a", "bad"] and schema.names == ["a"]


@pytest.mark.parametrize("name", ["stream_metrics", "stream_key_moments"])
def test_micro_batches_do_not_grow_with_the_files(spark, smoke, monkeypatch, name):
    plain, runs, drain = sorted(map(tuple, CATALOGUE[name].run(spark, smoke).collect()), key=repr), [], streaming.drain

    def watched(query):
        drain(query)
        runs.append(sum(p["numInputRows"] > 0 for p in query.recentProgress))

    monkeypatch.setattr(streams, "BATCH_ROWS", 20)
    monkeypatch.setattr(streaming, "drain", watched)
    assert sorted(map(tuple, CATALOGUE[name].run(spark, smoke).collect()), key=repr) == plain
    assert 1 < max(runs) <= streams.BATCHES


def test_updates_of_state_are_computed_once(spark, tmp_path):
    put(tmp_path / "in", "a.json", [f'{{"id": {i}, "p": 0.5}}' for i in range(50)])
    watched, seen = counted(streaming.json_stream(spark, str(tmp_path / "in"), SCHEMA))
    updates = watched.groupBy("id").agg(F.avg("p").alias("p"))
    out = str(tmp_path / "out")
    streaming.drain(streaming.write_batches(updates, lambda b: b, out, str(tmp_path / "cp"), "parquet", "update", ONCE))
    assert spark.read.parquet(out).count() == seen.value == 50
