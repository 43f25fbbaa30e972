"""Queries: file sources and sinks, as round trips of the given tables through the shared folder."""

from __future__ import annotations

from datetime import date

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tabflow.operators import split
from tabflow.plans.inputs import EVENTS_SQL, WITH_CUSTOMERS, scored_events
from tabflow.plans.registry import query, rounded
from tabflow.plans.relational import bucket_sql
from tabflow.sources import files
from tabflow.sources.shared import new_path
from tabflow.sources.tables import customers, table


@query("scan_csv", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def scan_csv(spark, root):
    base, path = table(spark, root, "customer"), new_path(spark, "csv")
    files.save(base, path, "csv")
    return files.scan_csv(spark, path, base.schema)


@query("scan_csv_inferred", "SELECT p_partkey, p_brand, p_size, p_retailprice FROM part")
def scan_csv_inferred(spark, root):
    """Without a schema: types are inferred, as for a batch file of unknown make."""
    path = new_path(spark, "csv")
    files.save(table(spark, root, "part"), path, "csv")
    found = files.scan_csv(spark, path)
    return found.select(F.col("p_partkey").cast("long"), "p_brand", "p_size", "p_retailprice")


DAY_FILES = 4  # files that a day may be written to
FORMATS = ("csv", "json", "parquet", "orc")


@query(
    "scan_format",
    "SELECT f AS format, p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part, (VALUES ('csv'), ('json'), ('parquet'), ('orc')) v(f)",
)
def scan_format(spark, root):
    """The same table written to and loaded from every format."""
    part, united = table(spark, root, "part"), None
    for fmt in FORMATS:
        path = new_path(spark, fmt)
        files.save(part, path, fmt)
        loaded = files.load(spark, path, fmt, part.schema).withColumn("format", F.lit(fmt))
        united = loaded if united is None else united.unionByName(loaded)
    return united


@query(
    "scan_reuse_split",
    f"SELECT o_orderkey, CASE WHEN {bucket_sql('o_orderkey')} < 2000 THEN 'test' ELSE 'train' END AS split FROM orders",
)
def scan_reuse_split(spark, root):
    """The first call writes the split, the second finds it finished and only reads it."""
    path = new_path(spark, "split")
    build = lambda: split.assign_random(table(spark, root, "orders"), ["o_orderkey"]).select("o_orderkey", "split")
    files.reuse_or_build(spark, path, build)
    return files.reuse_or_build(spark, path, build)


@query(
    "scan_score_batch",
    f"WITH {EVENTS_SQL} SELECT event_id, round(probability, 6) AS probability, prediction FROM scored_events",
)
def scan_score_batch(spark, root):
    """A CSV batch read with its schema and scored by the formula."""
    batch, path = table(spark, root, "events").select("event_id", "event_type", "value"), new_path(spark, "batch")
    files.save(batch, path, "csv")
    scored = scored_events(files.scan_csv(spark, path, batch.schema))
    return rounded(scored.select("event_id", "probability", "prediction"))


@query(
    "scan_dated_files",
    f"""WITH {EVENTS_SQL} SELECT event_id, prediction, CAST(ts AS DATE) AS prediction_date FROM scored_events
WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-13' AND DATE '2024-01-20'""",
)
def scan_dated_files(spark, root):
    """Prediction files per day, and the days of a window read back by their names.

    A day is dealt over several tasks by a salt, so a day with very many rows has several files.
    """
    path = new_path(spark, "daily")
    scored = scored_events(table(spark, root, "events"))
    name = F.concat(F.lit("predictions_"), F.date_format("ts", "yyyy-MM-dd"), F.lit(".csv"))
    daily = scored.select("event_id", "prediction", name.alias("file"))
    salt = F.pmod(F.xxhash64("event_id"), F.lit(DAY_FILES))
    daily.repartition("file", salt).write.partitionBy("file").options(**files.CSV_WRITE).csv(path)
    schema = daily.drop("file").schema
    pattern = f"{path}/file=predictions_*.csv/*"
    return files.scan_dated(spark, pattern, "predictions", schema, date(2024, 1, 20), 7)


@query(
    "scan_dated_truth",
    """SELECT doc_id, CAST(quality AS INTEGER) AS actual, DATE '2024-01-10' + CAST(doc_id % 20 AS INTEGER) AS truth_date FROM labels
WHERE DATE '2024-01-10' + CAST(doc_id % 20 AS INTEGER) BETWEEN DATE '2024-01-13' AND DATE '2024-01-20'""",
)
def scan_dated_truth(spark, root):
    """The ground truth side: dated truth files of a window, tagged with their day and put together."""
    path = new_path(spark, "truth")
    day = F.date_add(F.lit("2024-01-10").cast("date"), (F.col("doc_id") % 20).cast("int"))
    name = F.concat(F.lit("ground_truth_"), F.date_format(day, "yyyy-MM-dd"), F.lit(".csv"))
    rows = table(spark, root, "labels").select("doc_id", F.col("quality").cast("int").alias("actual"), name.alias("file"))
    rows.repartition("file", F.pmod(F.xxhash64("doc_id"), F.lit(DAY_FILES))).write.partitionBy("file").options(**files.CSV_WRITE).csv(path)
    pattern = f"{path}/file=ground_truth_*.csv/*"
    return files.scan_dated(spark, pattern, "ground_truth", rows.drop("file").schema, date(2024, 1, 20), 7, "truth_date")


@query(
    "sink_format",
    "SELECT * FROM (SELECT 'overwrite' AS mode, count(*) AS n FROM supplier UNION ALL SELECT 'append', 2 * count(*) FROM supplier "
    "UNION ALL SELECT 'ignore', count(*) FROM supplier UNION ALL SELECT 'error', count(*) FROM supplier)",
)
def sink_format(spark, root):
    """Every write mode on a table that is already there, except `error`, which needs a new one."""
    supplier, united = table(spark, root, "supplier"), None
    for mode in ("overwrite", "append", "ignore", "error"):
        path = new_path(spark, "sink")
        if mode != "error":
            files.save(supplier, path)
        files.save(supplier, path, mode=mode)
        rows = spark.read.schema(supplier.schema).parquet(path).agg(F.count("*").alias("n"))
        rows = rows.select(F.lit(mode).alias("mode"), "n")
        united = rows if united is None else united.unionByName(rows)
    return united


@query(
    "sink_split_export",
    WITH_CUSTOMERS + f""", parts AS (SELECT c_custkey, total_spend, churned, CASE WHEN {bucket_sql('c_custkey')} < 2000 THEN 'test' ELSE 'train' END AS part FROM cust)
SELECT part, c_custkey, round(total_spend, 2) AS total_spend, churned FROM parts""",
)
def sink_split_export(spark, root):
    """Parquet parts and separated CSV, read back and linked again by the key."""
    path = new_path(spark, "export")
    base = customers(spark, root).select("c_custkey", "total_spend", "churned")
    train, test = split.train_test(split.assign_random(base, ["c_custkey"]))
    files.export_split(train, test, "churned", "c_custkey", path)
    parts = []
    for name in ("train", "test"):
        features = files.scan_csv(spark, f"{path}/csv/X_{name}", base.drop("churned").schema)
        target = files.scan_csv(spark, f"{path}/csv/Y_{name}", base.drop("total_spend").schema)
        parts.append(features.join(target, "c_custkey").withColumn("part", F.lit(name)))
    return rounded(parts[0].unionByName(parts[1]), 2)


@query(
    "sink_predictions_json",
    f"WITH {EVENTS_SQL} SELECT event_id, prediction, round(probability, 6) AS positive, round(1 - probability, 6) AS negative FROM scored_events",
)
def sink_predictions_json(spark, root):
    """Predictions with a probability vector, written as JSON arrays and read back."""
    path = new_path(spark, "predictions")
    scored = scored_events(table(spark, root, "events"))
    vector = array_to_vector(F.array(1 - F.col("probability"), F.col("probability")))
    files.save_predictions(scored.select("event_id", "prediction", vector.alias("probability")), path)
    back = files.load(spark, path, "json", "event_id long, prediction double, probability array<double>")
    return rounded(
        back.select(
            "event_id",
            "prediction",
            F.col("probability")[1].alias("positive"),
            F.col("probability")[0].alias("negative"),
        )
    )
