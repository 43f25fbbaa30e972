"""Streams with state: truth that comes later, events that come again, and moments kept per key."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def with_late_truth(
    predictions: DataFrame, truth: DataFrame, key: str, predicted_at: str, known_at: str,
    within: str = "30 days", lateness: str = "1 day",
) -> DataFrame:
    """Predictions with the truth of their key that becomes known up to `within` after them.

    Both sides have watermarks, so state is bounded: a prediction waits until no truth can meet it any
    more. Truth may come in any order, before or after its prediction, as long as it is not later than
    `lateness`. A prediction without truth comes out with NULLs once the watermark of both streams has
    passed its range. Repeated keys make a row per pair, as in the join of tables. The key's name in
    the result is that of the predictions; a NULL key has no truth.
    """
    asked = predictions.withWatermark(predicted_at, lateness)
    known = truth.withColumnRenamed(key, "__key").withWatermark(known_at, lateness)
    range_ = (F.col(known_at) >= F.col(predicted_at)) & (F.col(known_at) <= F.col(predicted_at) + F.expr(f"INTERVAL {within}"))
    return asked.join(known, (F.col(key) == F.col("__key")) & range_, "left_outer").drop("__key")


def once_each(stream: DataFrame, keys: list[str], time: str, lateness: str = "1 day") -> DataFrame:
    """Each key once, though the same events come again, in other files too, within `lateness`.

    A key is forgotten when the watermark passes its time plus the lateness, so state does not grow with
    the stream. Which of the repeated rows stays is not defined: they are the same event.
    """
    return stream.withWatermark(time, lateness).dropDuplicatesWithinWatermark(keys)


PARTIAL = "key string, n long, mean double, m2 double, last_at timestamp, last double"
MOMENTS = "key string, n long, mean double, std double, last_at timestamp, last double, expired boolean"
STATE = "n long, mean double, m2 double, last_micros long, last double"


def _partials(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Moments of the rows of each Arrow batch per key: what a task sends instead of its rows."""
    for rows in batches:
        rows = rows.sort_values(["at", "value"], kind="stable")
        grouped = rows.groupby("key", dropna=False)
        found = grouped["value"].agg(n="count", mean="mean", var=lambda v: v.var(ddof=0)).reset_index()
        tail = grouped[["at", "value"]].tail(1)
        last = rows.loc[tail.index, ["key", "at", "value"]].rename(columns={"at": "last_at", "value": "last"})
        found = found.merge(last, on="key")
        found["m2"] = found["var"] * found["n"]
        yield found[["key", "n", "mean", "m2", "last_at", "last"]]


class KeyMoments(StatefulProcessor):
    """Number, mean, spread and latest value per key, until it is idle for `idle_ms`."""

    def __init__(self, idle_ms: int) -> None:
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("moments", STATE)

    def _row(self, key, held, expired: bool) -> pd.DataFrame:
        n, mean, m2, micros, last = held
        std = (m2 / (n - 1)) ** 0.5 if n > 1 else None
        at = pd.Timestamp(micros, unit="us")
        columns = ["key", "n", "mean", "std", "last_at", "last", "expired"]
        return pd.DataFrame([[key[0], n, mean, std, at, last, expired]], columns=columns)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = self.state.get() if self.state.exists() else (0, 0.0, 0.0, -(1 << 62), 0.0)
        for part in rows:
            for n, mean, m2, at, last in part[["n", "mean", "m2", "last_at", "last"]].itertuples(index=False):
                old_n, old_mean, old_m2, micros, old_last = held
                both, gap = old_n + n, mean - old_mean
                # The moments of two sets of rows from those of each.
                merged = (both, old_mean + gap * n / both, old_m2 + m2 + gap * gap * old_n * n / both)
                at = int(at.value) // 1000
                newer = (at, last) >= (micros, old_last)
                held = (*merged, at if newer else micros, last if newer else old_last)
        held = (int(held[0]), float(held[1]), float(held[2]), int(held[3]), float(held[4]))
        self.state.update(held)
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(held[3] // 1000 + self.idle_ms)
        yield self._row(key, held, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.state.exists():
            held = self.state.get()
            self.state.clear()
            yield self._row(key, held, True)

    def close(self) -> None:
        pass


@contextmanager
def rocksdb_state(spark: SparkSession):
    """State with several variables per key lives in this store; the session's own choice comes back after.

    The choice of the first run is kept in a checkpoint, so start streams that resume inside, too.
    """
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before)


def key_moments(
    stream: DataFrame, key: str, time: str, value: str, lateness: str = "1 day", idle_ms: int | None = None
) -> DataFrame:
    """After each micro-batch a row (key, n, mean, std, last_at, last, expired) of every key in it.

    Rows with a NULL or NaN value or a NULL time are left out; a NULL key is a key. Keys that stay for good are
    an aggregate of the stream: tasks reduce their rows to one per key before the shuffle and state is merged
    without Python. With `idle_ms` a key whose latest row lies that far behind the watermark comes out once
    more, expired, and its state goes; rows behind the watermark count as long as their key is there. That
    needs a processor with timers, which Python calls once per key and micro-batch, after tasks have reduced their
    rows to one per key and Arrow batch: start it within `rocksdb_state`. Both run in update mode.
    """
    rows = stream.select(
        F.col(key).cast("string").alias("key"), F.col(time).cast("timestamp").alias("at"), F.col(value).cast("double").alias("value")
    )
    rows = rows.filter(F.col("at").isNotNull() & F.col("value").isNotNull() & ~F.isnan("value"))
    if idle_ms is None:
        kept = rows.groupBy("key").agg(
            F.count("*").alias("n"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
            F.max(F.struct("at", "value")).alias("latest"),
        )
        last = [F.col("latest.at").alias("last_at"), F.col("latest.value").alias("last")]
        return kept.select("key", "n", "mean", "std", *last, F.lit(False).alias("expired"))
    partial = rows.mapInPandas(_partials, PARTIAL).withWatermark("last_at", lateness)
    return partial.groupBy("key").transformWithStateInPandas(
        statefulProcessor=KeyMoments(idle_ms),
        outputStructType=MOMENTS,
        outputMode="Update",
        timeMode="EventTime",
    )


def latest_of_keys(updates: DataFrame) -> DataFrame:
    """The last update of each key among the batches written by `write_batches` in update mode."""
    values = [c for c in updates.columns if c not in ("key", "batch_id")]
    last = updates.groupBy("key").agg(F.max_by(F.struct(*values), F.struct("batch_id", "n")).alias("v"))
    return last.select("key", "v.*")
