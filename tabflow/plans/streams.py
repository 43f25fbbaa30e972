"""Queries: streams over the events, drained to the end and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabflow.operators import missing, outliers, scaling
from tabflow.plans.inputs import EVENTS_SQL, event_halves, scored_events
from tabflow.plans.preparation import FACTOR
from tabflow.plans.registry import query, rounded
from tabflow.sources.files import file_count
from tabflow.sources.shared import new_path, persist_state
from tabflow.sources.tables import table
from tabflow.streaming import scoring as streaming
from tabflow.streaming import stateful

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)
COLUMNS = EVENT_SCHEMA.fieldNames()
ONCE = {"availableNow": True}
BATCH_ROWS = 25_000  # rows of a file where a query wants several micro-batches
BATCHES = 4  # micro-batches that these files are read in, however many there are


def event_files(events: DataFrame, path: str, mode: str = "overwrite", per_file: int = 0) -> str:
    """Events as JSON files of a folder that a stream reads: as many as the input has parts, or more if
    `per_file` limits their rows."""
    writer = events.select(*COLUMNS).write.mode(mode).option("maxRecordsPerFile", per_file)
    writer.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(path)
    return path


def in_batches(spark: SparkSession, path: str) -> DataFrame:
    """The files of a folder as a stream of at most BATCHES micro-batches. Each has its jobs, its commit of the
    state and its task results, so their number does not grow with the files; their tasks do."""
    files = file_count(spark, path, ".json")
    return streaming.json_stream(spark, path, EVENT_SCHEMA, max(1, -(-files // BATCHES)))


def event_stream(spark: SparkSession, root: str) -> DataFrame:
    """The events as a stream of one micro-batch."""
    path = event_files(table(spark, root, "events"), new_path(spark, "events"))
    return streaming.json_stream(spark, path, EVENT_SCHEMA)


def drained(stream: DataFrame, fmt: str = "parquet") -> DataFrame:
    """Run the stream to the end into a file sink and read the sink."""
    spark = stream.sparkSession
    path, checkpoint = new_path(spark, "sink"), new_path(spark, "checkpoint")
    streaming.drain(streaming.write_stream(stream, path, checkpoint, fmt, ONCE))
    return spark.read.schema(stream.schema).format(fmt).load(path)


@query("stream_source_json", "SELECT event_id, user_id, event_type, value, epoch_us(ts) AS micros FROM events")
def stream_source_json(spark, root):
    rows = drained(event_stream(spark, root))
    return rows.select("event_id", "user_id", "event_type", "value", F.unix_micros("ts").alias("micros"))


SCORED_OUT = f"WITH {EVENTS_SQL} SELECT event_id, prediction, round(probability, 6) AS probability FROM scored_events"


@query("stream_score", SCORED_OUT)
def stream_score(spark, root):
    """Formula scoring of the stream into a file sink."""
    stream = scored_events(event_stream(spark, root)).select("event_id", "prediction", "probability")
    return rounded(drained(stream))


def batches(spark, root, transform, schema, fmt="json"):
    """Run `transform` per micro-batch and read all batch folders."""
    path, checkpoint = new_path(spark, "batches"), new_path(spark, "checkpoint")
    stream = event_stream(spark, root)
    streaming.drain(streaming.write_batches(stream, transform, path, checkpoint, fmt, trigger=ONCE))
    return spark.read.schema(schema).format(fmt).load(path)


SCORED_SCHEMA = "event_id long, prediction double, probability double, batch_id long"


def score_batch(batch: DataFrame) -> DataFrame:
    return scored_events(batch).select("event_id", "prediction", "probability")


@query("sink_stream_batch", SCORED_OUT)
def sink_stream_batch(spark, root):
    """One folder per micro-batch; running a batch again replaces its folder."""
    rows = batches(spark, root, score_batch, SCORED_SCHEMA)
    return rounded(rows.select("event_id", "prediction", "probability"))


@query(
    "stream_foreach_batch",
    f"""WITH {EVENTS_SQL} SELECT count(*) AS num_predictions, count(*) FILTER (WHERE prediction = 1) AS churn_count,
count(*) FILTER (WHERE probability > 0.7) AS high_risk FROM scored_events""",
)
def stream_foreach_batch(spark, root):
    """A summary row per micro-batch, added up."""
    summarise = streaming.batch_summary("prediction", "probability")
    schema = "num_predictions long, churn_count long, high_risk long, batch_id long"
    rows = batches(spark, root, lambda batch: summarise(scored_events(batch)), schema, "parquet")
    return rows.agg(*[F.sum(c).alias(c) for c in ("num_predictions", "churn_count", "high_risk")])


@query("stream_checkpoint_resume", SCORED_OUT)
def stream_checkpoint_resume(spark, root):
    """Drain, add files, drain again with the same checkpoint: every row exactly once."""
    early, late = event_halves(spark, root)
    source, sink, checkpoint = (new_path(spark, name) for name in ("events", "sink", "checkpoint"))
    for half, mode in ((early, "overwrite"), (late, "append")):
        event_files(half, source, mode)
        stream = scored_events(streaming.json_stream(spark, source, EVENT_SCHEMA, 1))
        stream = stream.select("event_id", "prediction", "probability")
        streaming.drain(streaming.write_stream(stream, sink, checkpoint, trigger=ONCE))
    return rounded(spark.read.schema("event_id long, prediction double, probability double").parquet(sink))


@query(
    "stream_schema_enforce",
    "SELECT event_id, CASE WHEN event_type = 'click' THEN NULL ELSE value END AS value, event_type = 'click' AS is_bad FROM events",
)
def stream_schema_enforce(spark, root):
    """Clicks carry text in a number field: the field is NULL and the line is kept aside."""
    events, path = table(spark, root, "events"), new_path(spark, "events")
    broken = F.when(F.col("event_type") == "click", "n/a").otherwise(F.col("value").cast("string"))
    line = F.concat(
        F.lit('{"event_id": '), F.col("event_id").cast("string"), F.lit(', "value": '),
        F.when(F.col("event_type") == "click", F.lit('"n/a"')).otherwise(broken), F.lit("}"),
    )
    events.select(line.alias("value")).write.text(path)
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("value", T.DoubleType())])
    rows = drained(streaming.json_stream(spark, path, schema, bad_record="bad_record"))
    return rows.select("event_id", "value", F.col("bad_record").isNotNull().alias("is_bad"))


@query(
    "stream_preprocess",
    f"""WITH gaps AS (SELECT event_id, CASE WHEN event_type <> 'view' THEN value END AS value FROM events),
m AS (SELECT avg(value) AS a FROM gaps), filled AS (SELECT event_id, coalesce(value, a) AS value FROM gaps, m),
q AS (SELECT quantile_disc(value, 0.25) AS q1, quantile_disc(value, 0.75) AS q3 FROM filled),
capped AS (SELECT event_id, least(greatest(value, q1 - {FACTOR} * (q3 - q1)), q3 + {FACTOR} * (q3 - q1)) AS value FROM filled, q),
r AS (SELECT min(value) AS lo, max(value) AS hi FROM capped)
SELECT event_id, round((value - lo) / (hi - lo), 6) AS value FROM capped, r""",
)
def stream_preprocess(spark, root):
    """Fill, cap and scale the stream by state fitted on the table: batch and stream agree."""
    gap = F.when(F.col("event_type") != "view", F.col("value")).alias("value")
    batch = table(spark, root, "events").select("event_id", gap)
    fill = persist_state(missing.fit_fill(batch, ["value"]), "fill")
    filled = missing.apply_fill(batch, fill)
    bounds = persist_state(outliers.fit_iqr(filled, ["value"], FACTOR, exact=True), "bounds")
    scale = persist_state(scaling.fit_moments(outliers.cap(filled, bounds), ["value"]), "scale")
    stream = event_stream(spark, root).select("event_id", gap)
    ready = scaling.scale_minmax(outliers.cap(missing.apply_fill(stream, fill), bounds), scale)
    return rounded(drained(ready))


@query(
    "stream_metrics",
    f"""WITH {EVENTS_SQL} SELECT CAST(ts AS DATE) AS day, count(*) AS num_predictions, count(*) FILTER (WHERE prediction = 1) AS churn_count,
round(avg(probability), 6) AS avg_probability, count(*) FILTER (WHERE probability > 0.7) AS high_risk FROM scored_events GROUP BY 1""",
)
def stream_metrics(spark, root):
    """Daily windows in update mode over several micro-batches; a window's last update is its result.

    The files mix all days, so the lateness spans the month and no row is late.
    """
    path, checkpoint = new_path(spark, "windows"), new_path(spark, "checkpoint")
    source = event_files(table(spark, root, "events"), new_path(spark, "events"), per_file=BATCH_ROWS)
    scored = scored_events(in_batches(spark, source))
    windows = streaming.windowed_metrics(scored, "ts", "prediction", "probability", lateness="40 days")
    query_ = streaming.write_batches(windows, lambda b: b, path, checkpoint, "parquet", "update", ONCE)
    streaming.drain(query_)
    latest = streaming.latest_windows(spark.read.parquet(path))
    return rounded(latest.withColumn("day", F.to_date("window_start")).drop("window_start"))


FAR = "2030-01-01 00:00:00"


def truth_rows(events: DataFrame) -> DataFrame:
    """What becomes known of an event: two of three, up to 29 hours after it, on another day's file."""
    known_at = F.col("ts") + F.make_dt_interval(hours=(F.col("event_id") % 30).cast("int"))
    rows = events.filter(F.col("event_id") % 3 != 0)
    return rows.select("event_id", known_at.alias("known_at"), (F.col("value") > 60).cast("int").alias("label"))


@query(
    "stream_monitor_join",
    f"""WITH {EVENTS_SQL} SELECT event_id, prediction,
CASE WHEN event_id % 3 <> 0 AND event_id % 30 <= 24 THEN CAST(value > 60 AS INTEGER) END AS label FROM scored_events""",
)
def stream_monitor_join(spark, root):
    """Predictions and their truth as two streams: truth that is known within a day meets its prediction,
    predictions without come out when their time has passed. The query is stopped and resumed twice; the
    lateness spans the month, as the files mix all days."""
    paths = {name: new_path(spark, name) for name in ("events", "truth", "sink", "checkpoint")}
    early, late = event_halves(spark, root)
    closing = spark.range(1).select(F.lit(-1).cast("long").alias("event_id"), F.lit(FAR).cast("timestamp_ntz").alias("ts"), F.lit(0.0).alias("value"))
    closing = closing.select("event_id", "ts", F.lit(0).cast("long").alias("user_id"), F.lit("").alias("event_type"), "value")
    truth_schema = "event_id long, known_at timestamp, label int"
    micros = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    # Truth of the late half comes first, that of the early half with the late predictions.
    for predicted, known in ((early, late), (late, early), (closing, None)):
        event_files(predicted, paths["events"], "append")
        known = truth_rows(known) if known is not None else closing.select("event_id", F.col("ts").alias("known_at"), F.lit(0).alias("label"))
        known.write.mode("append").option("timestampNTZFormat", micros).json(paths["truth"])
        stream = scored_events(streaming.json_stream(spark, paths["events"], EVENT_SCHEMA)).select("event_id", "ts", "prediction")
        told = spark.readStream.schema(truth_schema).json(paths["truth"])
        joined = stateful.with_late_truth(stream, told, "event_id", "ts", "known_at", "24 hours", "60 days")
        rows = joined.select("event_id", "prediction", "label")
        streaming.drain(streaming.write_stream(rows, paths["sink"], paths["checkpoint"], trigger=ONCE))
    found = spark.read.schema("event_id long, prediction double, label int").parquet(paths["sink"])
    return found.filter(F.col("event_id") >= 0)


@query("stream_replayed_files", SCORED_OUT)
def stream_replayed_files(spark, root):
    """All files come a second time under other names, in a later run: every event is there once."""
    source, sink, checkpoint = (new_path(spark, name) for name in ("events", "sink", "checkpoint"))
    for _ in range(2):
        event_files(table(spark, root, "events"), source, "append")
        events = stateful.once_each(streaming.json_stream(spark, source, EVENT_SCHEMA), ["event_id"], "ts", "60 days")
        stream = scored_events(events).select("event_id", "prediction", "probability")
        streaming.drain(streaming.write_stream(stream, sink, checkpoint, trigger=ONCE))
    return rounded(spark.read.schema("event_id long, prediction double, probability double").parquet(sink))


@query(
    "stream_key_moments",
    """SELECT CAST(user_id AS VARCHAR) AS key, count(*) AS n, round(avg(value), 9) AS mean, round(stddev_samp(value), 9) AS std,
round(max_by(value, struct_pack(ts, value)), 9) AS last FROM events GROUP BY user_id""",
)
def stream_key_moments(spark, root):
    """Moments and latest value per user kept in the state store over several micro-batches and a restart."""
    early, late = event_halves(spark, root)
    source, path, checkpoint = (new_path(spark, name) for name in ("events", "batches", "checkpoint"))
    with stateful.rocksdb_state(spark):
        for half in (early, late):
            event_files(half, source, "append", per_file=BATCH_ROWS)
            moments = stateful.key_moments(in_batches(spark, source), "user_id", "ts", "value")
            streaming.drain(streaming.write_batches(moments, lambda b: b, path, checkpoint, "parquet", "update", ONCE))
    schema = f"{stateful.MOMENTS}, batch_id long"
    latest = stateful.latest_of_keys(spark.read.schema(schema).parquet(path))
    return rounded(latest.select("key", "n", "mean", "std", "last"), 9)
