"""Tables stored in buckets of a key, so that later joins and groupings by it move no rows."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from tabflow.sources.shared import new_path


def write_buckets(df: DataFrame, keys: list[str], buckets: int, path: str | None = None, moved: bool = True) -> DataFrame:
    """Write a table into a number of buckets of its keys, one file each, and return it as stored.

    If the rows are not to be moved, each task writes a file per bucket that it has rows of.

    Two tables with equal numbers of buckets of the same keys join and group by them without an exchange.
    The catalog knows the table only while it is opened; the files stay at `path`, by default in the
    workspace. A bucket is one task later: choose their number by the size of the table, and keys that no
    large share of the rows has in common.
    """
    spark = df.sparkSession
    name, path = f"tabflow_{uuid.uuid4().hex}", path or new_path(spark, "buckets")
    rows = df.repartition(buckets, *keys) if moved else df
    rows = rows.write.bucketBy(buckets, *keys).sortBy(*keys)
    rows.mode("overwrite").format("parquet").option("path", path).saveAsTable(name)
    try:
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")
