"""Inputs of the queries derived from the given tables, each with the same view in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabflow.sources.tables import CUSTOMERS_SQL, customers, table

WITH_CUSTOMERS = f"WITH {CUSTOMERS_SQL}\n"


def gapped_customers(spark: SparkSession, root: str) -> DataFrame:
    """Customers with NULL charges and segments and a text column that may be blank."""
    return customers(spark, root).select(
        "c_custkey",
        "c_nationkey",
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("charges"),
        F.when(F.col("c_nationkey") < 20, F.col("c_mktsegment")).alias("segment"),
        F.when(F.col("c_acctbal") > 9000, " ").otherwise(F.col("c_acctbal").cast("string")).alias("charges_text"),
        "order_count",
        "total_spend",
        "tenure_months",
        "churned",
    )


GAPS_SQL = f"""{CUSTOMERS_SQL},
gaps AS (
  SELECT c_custkey, c_nationkey,
         CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS charges,
         CASE WHEN c_nationkey < 20 THEN c_mktsegment END AS segment,
         CASE WHEN c_acctbal > 9000 THEN ' ' ELSE CAST(c_acctbal AS VARCHAR) END AS charges_text,
         order_count, total_spend, tenure_months, churned
  FROM cust)"""
WITH_GAPS = f"WITH {GAPS_SQL}\n"

SPLIT_DAY = "2024-01-16 00:00:00"


def moment(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def event_halves(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """Events before the split day as reference, the others as current."""
    events = table(spark, root, "events")
    return events.filter(F.col("ts") < moment(SPLIT_DAY)), events.filter(F.col("ts") >= moment(SPLIT_DAY))


def line_halves(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """Line items shipped before 1998 as reference, the others as current."""
    lines = table(spark, root, "lineitem")
    start = moment("1998-01-01 00:00:00")
    return lines.filter(F.col("l_shipdate") < start), lines.filter(F.col("l_shipdate") >= start)


def scored_events(events: DataFrame) -> DataFrame:
    """Events with a formula probability and prediction."""
    probability = F.col("value") / (F.col("value") + 100)
    return events.withColumns(
        {"probability": probability, "prediction": F.when(probability > 0.5, 1.0).otherwise(0.0)}
    )


EVENTS_SQL = """scored_events AS (
  SELECT event_id, ts, user_id, event_type, value,
         value / (value + 100) AS probability,
         CASE WHEN value / (value + 100) > 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction
  FROM events)"""


def document_predictions(spark: SparkSession, root: str) -> DataFrame:
    """A length-based score of every document, in the role of a production prediction."""
    score = F.col("n_chars") / (F.col("n_chars") + F.lit(2000.0))
    return table(spark, root, "documents").select(
        "doc_id", score.alias("score"), F.when(score > 0.5, 1).otherwise(0).alias("prediction")
    )


def document_truth(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "labels").select("doc_id", F.col("quality").cast("int").alias("label"))


PREDICTIONS_SQL = """preds AS (
  SELECT doc_id, n_chars / (n_chars + 2000.0::DOUBLE) AS score,
         CASE WHEN n_chars / (n_chars + 2000.0::DOUBLE) > 0.5 THEN 1 ELSE 0 END AS prediction
  FROM documents),
joined AS (
  SELECT p.doc_id, p.score, p.prediction, CAST(l.quality AS INTEGER) AS label
  FROM preds p JOIN labels l ON p.doc_id = l.doc_id)"""
