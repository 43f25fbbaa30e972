"""The folder that all executors share, and small state tables written to it.

Everything written here belongs to a workspace, a folder of its own that is deleted when its owner is
done: the block of `workspace`, or else the application, at whose end its own workspace goes.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_inner: ContextVar[str | None] = ContextVar("workspace", default=None)
_of_application: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The cluster's spark.checkpoint.dir; a local session without one gets its own folder."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tabflow-"))
    return context.getCheckpointDir()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system it lies."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _new_root(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/tabflow/{uuid.uuid4().hex}"


def _application_root(spark: SparkSession) -> str:
    """The workspace of the running application; it goes when Python ends, if Spark is still there."""
    application = spark.sparkContext.applicationId
    if application not in _of_application:
        root = _of_application[application] = _new_root(spark)

        def clean() -> None:
            if spark.sparkContext._jsc is not None:
                remove(spark, root)

        atexit.register(clean)
    return _of_application[application]


@contextmanager
def workspace(spark: SparkSession) -> Iterator[str]:
    """All paths handed out inside lie in one new folder, which is deleted at the end.

    Results that read state from it must be consumed inside.
    """
    root = _new_root(spark)
    token = _inner.set(root)
    try:
        yield root
    finally:
        _inner.reset(token)
        remove(spark, root)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """What a query that runs inside has shuffled is deleted when it ends, and not when the driver happens to
    collect its garbage; a stage that is run again for a lost file makes it anew."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def new_path(spark: SparkSession, label: str) -> str:
    return f"{_inner.get() or _application_root(spark)}/{label}-{uuid.uuid4().hex}"


def persist_state(state: DataFrame, label: str = "state", path: str | None = None) -> DataFrame:
    """Write fitted state as Parquet and read it back.

    The plan after it starts at the written files, so it survives lost executors, a stream
    does not refit per batch, and the planner knows the true size: it broadcasts a small
    state and sort-merges (with skew splitting) a large one.
    """
    spark = state.sparkSession
    path = path or new_path(spark, label)
    state.write.mode("overwrite").parquet(path)
    return spark.read.schema(state.schema).parquet(path)
