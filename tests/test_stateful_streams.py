import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabflow.streaming import scoring as streaming
from tabflow.streaming import stateful

ONCE = {"availableNow": True}
P_SCHEMA, T_SCHEMA = "id long, ts timestamp, p double", "id long, known_at timestamp, label int"


class Folder:
    """Files of a stream in the order they are put there."""

    def __init__(self, path):
        self.path, self.n = path, 0
        path.mkdir()

    def put(self, *records):
        self.n += 1
        file = self.path / f"{self.n:03d}.json"
        file.write_text("".join(json.dumps(r) + "\n" for r in records))
        os.utime(file, (1_700_000_000 + self.n * 10,) * 2)


def pred(i, at):
    return {"id": i, "ts": f"2024-01-{at}", "p": 0.5}


def known(i, at, label=1):
    return {"id": i, "known_at": f"2024-01-{at}", "label": label}


@pytest.fixture
def joining(spark, tmp_path):
    predictions, truth = Folder(tmp_path / "p"), Folder(tmp_path / "t")
    sink, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")

    def run():
        left = streaming.json_stream(spark, str(predictions.path), spark.createDataFrame([], P_SCHEMA).schema, 1)
        right = streaming.json_stream(spark, str(truth.path), spark.createDataFrame([], T_SCHEMA).schema, 1)
        joined = stateful.with_late_truth(left, right, "id", "ts", "known_at", "24 hours", "2 days")
        query = streaming.write_stream(joined.select("id", "label"), sink, checkpoint, trigger=ONCE)
        streaming.drain(query)
        found = spark.read.schema("id long, label int").parquet(sink).collect()
        progress = query.recentProgress
        return sorted([(r.id, r.label) for r in found], key=repr), progress[-1].stateOperators[0].numRowsTotal if progress else None

    return predictions, truth, run


def test_truth_in_any_order_meets_its_prediction_and_the_rest_comes_out_after(joining):
    predictions, truth, run = joining
    truth.put(known(1, "01T12:00:00"), known(2, "03T00:00:00"))  # before its prediction's file; outside the range of 2
    predictions.put(pred(1, "01T10:00:00"), pred(2, "01T10:00:00"), pred(3, "01T11:00:00"))
    assert run()[0] == [(1, 1)]
    predictions.put(pred(4, "02T09:00:00"))
    truth.put(known(3, "01T20:00:00", 0), known(9, "02T00:00:00"))  # late, but inside the lateness; without prediction
    assert run()[0] == [(1, 1), (3, 0)]  # after a restart
    for day in ("10T00:00:00", "11T00:00:00", "12T00:00:00"):
        predictions.put(pred(100 + int(day[:2]), day))
        truth.put(known(-1, day))
    rows, held = run()
    assert [r for r in rows if r[0] < 100] == [(1, 1), (2, None), (3, 0), (4, None)]
    assert held <= 6  # only the rows of the last days wait


def test_repeated_keys_make_a_row_per_pair_and_null_keys_have_no_truth(joining):
    predictions, truth, run = joining
    predictions.put(pred(1, "01T10:00:00"), pred(1, "01T11:00:00"), pred(None, "01T10:00:00"))
    truth.put(known(1, "01T12:00:00"), known(1, "01T13:00:00", 0), known(None, "01T12:00:00"))
    for day in ("10T00:00:00", "11T00:00:00", "12T00:00:00"):
        predictions.put(pred(99, day))
        truth.put(known(-1, day))
    rows, _ = run()
    assert [r for r in rows if r[0] != 99] == [(1, 0), (1, 0), (1, 1), (1, 1), (None, None)]


def test_replayed_files_add_nothing_and_state_is_bounded(spark, tmp_path):
    folder, sink, checkpoint = Folder(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")
    schema = spark.createDataFrame([], P_SCHEMA).schema

    def run():
        stream = stateful.once_each(streaming.json_stream(spark, str(folder.path), schema, 1), ["id"], "ts", "1 day")
        query = streaming.write_stream(stream.select("id"), sink, checkpoint, trigger=ONCE)
        streaming.drain(query)
        states = [p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators]
        return sorted(r.id for r in spark.read.schema("id long").parquet(sink).collect()), states

    first = [pred(i, "01T10:00:00") for i in range(20)]
    folder.put(*first)
    folder.put(*reversed(first), pred(50, "01T11:00:00"))
    assert run()[0] == [*range(20), 50]
    folder.put(*first[:5])  # again, after a restart
    for day in range(2, 12):
        folder.put(*[pred(1000 * day + i, f"{day:02d}T10:00:00") for i in range(20)])
    ids, states = run()
    assert len(ids) == len(set(ids)) == 21 + 200
    assert max(states) <= 4 * 20 + 21  # days behind the watermark are forgotten


def moments_of(spark, folder, tmp_path, idle_ms=None, lateness="1 day"):
    path, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    schema = spark.createDataFrame([], "k string, ts timestamp, v double").schema
    with stateful.rocksdb_state(spark):
        stream = streaming.json_stream(spark, str(folder.path), schema, 1)
        updates = stateful.key_moments(stream, "k", "ts", "v", lateness, idle_ms)
        streaming.drain(streaming.write_batches(updates, lambda b: b, path, checkpoint, "parquet", "update", ONCE))
    return spark.read.schema(f"{stateful.MOMENTS}, batch_id long").parquet(path)


def test_moments_are_those_of_the_table_after_batches_and_a_restart(spark, tmp_path):
    chance, folder, every = np.random.default_rng(4), Folder(tmp_path / "in"), []
    for part in range(4):
        rows = [
            {"k": "hot" if chance.random() < 0.4 else f"k{chance.integers(5)}", "ts": f"2024-01-0{part + 1}T{i // 60:02d}:{i % 60:02d}:00", "v": round(float(chance.normal()), 3)}
            for i in range(300)
        ]
        rows += [{"k": None, "ts": "2024-01-01T00:00:00", "v": 2.0}, {"k": "hot", "ts": None, "v": 9e9}, {"k": "hot", "ts": "2024-01-09T00:00:00", "v": None}]
        every += rows
        folder.put(*rows)
        if part == 1:
            moments_of(spark, folder, tmp_path)
    found = {r.key: r for r in stateful.latest_of_keys(moments_of(spark, folder, tmp_path)).collect()}
    kept = [r for r in every if r["v"] is not None and r["ts"] is not None]
    assert set(found) == {r["k"] for r in kept}
    for key, r in found.items():
        values = np.array([x["v"] for x in kept if x["k"] == key])
        last = max((x["ts"], x["v"]) for x in kept if x["k"] == key)[1]
        assert (r.n, r.last, r.expired) == (len(values), last, False)
        assert r["mean"] == pytest.approx(values.mean()) and r["std"] == pytest.approx(values.std(ddof=1))


def test_idle_keys_expire_and_begin_anew(spark, tmp_path):
    folder = Folder(tmp_path / "in")
    line = lambda k, day, v: {"k": k, "ts": f"2024-01-{day:02d}T00:00:00", "v": v}
    folder.put(line("a", 1, 1.0), line("a", 1, 3.0), line("b", 1, 5.0))
    for day in range(2, 9):
        folder.put(line("b", day, 5.0))
    folder.put(line("a", 9, 10.0))
    rows = moments_of(spark, folder, tmp_path, idle_ms=2 * 86_400_000, lateness="1 hour").orderBy("batch_id").collect()
    of_a = [(r.n, r["mean"], r.expired) for r in rows if r.key == "a"]
    assert of_a == [(2, 2.0, False), (2, 2.0, True), (1, 10.0, False)]
    assert [r.n for r in rows if r.key == "b" and not r.expired][-1] == 8
    assert spark.conf.get(stateful.PROVIDER) != stateful.ROCKSDB


def test_moments_of_keys_that_stay_call_no_python(spark, tmp_path):
    (tmp_path / "in").mkdir()
    stream = streaming.json_stream(spark, str(tmp_path / "in"), spark.createDataFrame([], "k string, ts timestamp, v double").schema)
    plans = [stateful.key_moments(stream, "k", "ts", "v", idle_ms=i)._jdf.queryExecution().analyzed().toString() for i in (None, 1000)]
    assert ["InPandas" in p or "TransformWithState" in p for p in plans] == [False, True]
