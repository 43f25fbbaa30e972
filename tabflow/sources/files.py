"""Batch sources and sinks. Reads take an explicit schema and never count rows."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabflow.functions.expressions import date_in_name
from tabflow.operators.projection import features_target

# Default options of the CSV reader and writer.
CSV_READ = {
    "header": "true",
    "ignoreLeadingWhiteSpace": "true",
    "ignoreTrailingWhiteSpace": "true",
    "nullValue": "",
    "nanValue": "NaN",
    "quote": '"',
    "escape": '"',
}
CSV_WRITE = {
    "header": "true",
    "ignoreLeadingWhiteSpace": "true",
    "ignoreTrailingWhiteSpace": "true",
    "quote": '"',
    "escape": '"',
}
PARQUET_WRITE = {"compression": "snappy"}


def scan_csv(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None, **options) -> DataFrame:
    """CSV with a header; blank is NULL, both sides trimmed, and the caller's options win.

    Without a schema Spark infers one, which costs a further pass over the files.
    """
    chosen = {**CSV_READ, **({} if schema else {"inferSchema": "true"}), **options}
    reader = spark.read.options(**chosen)
    return (reader.schema(schema) if schema else reader).csv(path)


def load(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None, **options):
    """Read any format Spark knows; CSV gets the defaults of `scan_csv`."""
    if fmt == "csv":
        return scan_csv(spark, path, schema, **options)
    reader = spark.read.format(fmt).options(**options)
    return (reader.schema(schema) if schema else reader).load(path)


def save(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite", **options) -> None:
    """Write any format; mode is overwrite, append, ignore or error."""
    defaults = {"csv": CSV_WRITE, "parquet": PARQUET_WRITE}.get(fmt, {})
    df.write.format(fmt).mode(mode).options(**{**defaults, **options}).save(path)


def is_written(spark: SparkSession, path: str) -> bool:
    """Whether a finished Spark write lies at the path, on any file system."""
    marker = spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)


def file_count(spark: SparkSession, path: str, ending: str) -> int:
    """How many files of a folder end so, on any file system."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(path, f"*{ending}")
    return len(pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern))


def reuse_or_build(spark: SparkSession, path: str, build: Callable[[], DataFrame], force: bool = False) -> DataFrame:
    """Read the finished table at the path; build and write it only if absent or forced."""
    if force or not is_written(spark, path):
        save(build(), path)
    return spark.read.parquet(path)


def export_split(train: DataFrame, test: DataFrame, target: str, key: str, root: str) -> None:
    """Parquet train/test, and features and target apart as CSV (still one file per task)."""
    for name, part in (("train", train), ("test", test)):
        save(part, f"{root}/parquet/{name}")
        features, labels = features_target(part, target, key)
        save(features, f"{root}/csv/X_{name}", "csv")
        save(labels, f"{root}/csv/Y_{name}", "csv")


def plain_vectors(df: DataFrame) -> DataFrame:
    """Vector columns as arrays of double, the form JSON and SQL can read."""
    return df.select(
        *[
            vector_to_array(f.name).alias(f.name) if isinstance(f.dataType, VectorUDT) else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def save_predictions(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    save(plain_vectors(df), path, "json", mode)


def scan_dated(
    spark: SparkSession,
    pattern: str,
    prefix: str,
    schema: T.StructType,
    end: date,
    days: int = 7,
    date_column: str = "prediction_date",
    fmt: str = "csv",
) -> DataFrame:
    """Rows of the files `<prefix>_YYYY-MM-DD.*` dated in [end - days, end], tagged with the date.

    The filter uses only the file path, so files outside the window are dropped when the
    files are listed and never opened; names without a valid date are left out.
    """
    rows = load(spark, pattern, fmt, schema)
    tagged = rows.select("*", date_in_name(F.col("_metadata.file_path"), prefix).alias(date_column))
    last = F.lit(end)
    return tagged.filter(F.col(date_column).between(F.date_sub(last, days), last))
