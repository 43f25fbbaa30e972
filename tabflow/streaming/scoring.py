"""Streaming sources, scoring, sinks and per-window metrics."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tabflow.operators.profile import inference_summary

Transform = Callable[[DataFrame], DataFrame]
TRIGGER = {"processingTime": "10 seconds"}


def json_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    max_files: int | None = None,
    bad_record: str | None = None,
) -> DataFrame:
    """JSON files of a folder as a stream with a fixed schema.

    A field that does not fit its type is NULL; with `bad_record` the whole text of such a
    line is kept in that column.
    """
    extra = [T.StructField(bad_record, T.StringType())] if bad_record and bad_record not in schema.names else []
    fields = T.StructType([*schema.fields, *extra])
    reader = spark.readStream.format("json").schema(fields).option("mode", "PERMISSIVE")
    if bad_record:
        reader = reader.option("columnNameOfCorruptRecord", bad_record)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def write_stream(
    stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", trigger: dict | None = None
) -> StreamingQuery:
    """Append to a file sink, exactly once through its commit log and the checkpoint."""
    writer = stream.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or TRIGGER)).start(path)


def batch_path(root: str, batch_id: int) -> str:
    return f"{root}/batch_id={batch_id}"


def write_batches(
    stream: DataFrame,
    transform: Transform,
    root: str,
    checkpoint: str,
    fmt: str = "json",
    mode: str = "append",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Call `transform` on every micro-batch and write it under its batch number.

    A replayed batch overwrites its own folder, so it never adds rows twice; an empty batch
    writes nothing. Updates of state are held while they are looked at and written, so the state is
    read and merged once per batch.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        held = batch if mode == "append" else batch.persist()
        try:
            if not held.isEmpty():
                transform(held).write.mode("overwrite").format(fmt).save(batch_path(root, batch_id))
        finally:
            if mode != "append":
                held.unpersist()

    writer = stream.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or TRIGGER)).start()


def drain(query: StreamingQuery) -> None:
    """Wait for a query that ends by itself and raise its error, if any."""
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def windowed_metrics(
    stream: DataFrame, time: str, prediction: str, probability: str, width: str = "1 day", lateness: str = "1 day"
) -> DataFrame:
    """Inference summary per tumbling window; rows later than `lateness` are dropped."""
    timed = stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, lateness)
    window = F.window(time, width).alias("window")
    p, y = F.col(probability), F.col(prediction)
    return timed.groupBy(window).agg(
        F.count("*").alias("num_predictions"),
        F.count_if(y == 1).alias("churn_count"),
        F.avg(p).alias("avg_probability"),
        F.count_if(p > 0.7).alias("high_risk"),
    )


def latest_windows(updates: DataFrame) -> DataFrame:
    """The last update of each window among the batches of an update-mode query."""
    values = [c for c in updates.columns if c not in ("window", "batch_id")]
    last = updates.groupBy("window").agg(F.max_by(F.struct(*values), "batch_id").alias("v"))
    return last.select(F.col("window.start").alias("window_start"), "v.*")


def observed(stream: DataFrame, name: str, prediction: str, probability: str) -> DataFrame:
    """Attach per-batch counts that a StreamingQueryListener receives; costs no extra pass."""
    p, y = F.col(probability), F.col(prediction)
    metrics: list[Column] = [
        F.count(F.lit(1)).alias("num_predictions"),
        F.sum((y == 1).cast("long")).alias("churn_count"),
        F.avg(p).alias("avg_probability"),
    ]
    return stream.observe(name, *metrics)


def batch_summary(prediction: str, probability: str) -> Transform:
    """A `write_batches` transform that writes one summary row per micro-batch."""
    return lambda batch: inference_summary(batch, prediction, probability)
