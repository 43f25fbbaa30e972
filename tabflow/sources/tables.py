"""The given tables, and the customer table derived from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def months_between_dates(first, last):
    return (F.year(last) - F.year(first)) * 12 + F.month(last) - F.month(first)


def customers(spark: SparkSession, root: str) -> DataFrame:
    """One row per customer with orders: segment, nation, charges, tenure and target.

    Orders are reduced to one row per customer before the join, so a customer with very many
    orders adds one row per map task to the shuffle.
    """
    last, first = F.max("o_orderdate"), F.min("o_orderdate")
    spend = (
        table(spark, root, "orders")
        .groupBy("o_custkey")
        .agg(
            F.count("*").alias("order_count"),
            F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total_spend"),
            months_between_dates(first, last).cast("int").alias("tenure_months"),
            F.when(last < F.lit("2001-03-01").cast("timestamp_ntz"), 1).otherwise(0).alias("churned"),
        )
    )
    base = table(spark, root, "customer").select("c_custkey", "c_mktsegment", "c_nationkey", "c_acctbal")
    return base.join(spend, base.c_custkey == spend.o_custkey).drop("o_custkey")


# The same table as a SQL view for the oracle.
CUSTOMERS_SQL = """cust AS (
  SELECT c_custkey, c_mktsegment, c_nationkey, c_acctbal,
         count(*) AS order_count,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_spend,
         CAST((year(max(o_orderdate)) - year(min(o_orderdate))) * 12
              + month(max(o_orderdate)) - month(min(o_orderdate)) AS INTEGER) AS tenure_months,
         CASE WHEN max(o_orderdate) < TIMESTAMP '2001-03-01 00:00:00' THEN 1 ELSE 0 END AS churned
  FROM customer JOIN orders ON c_custkey = o_custkey
  GROUP BY c_custkey, c_mktsegment, c_nationkey, c_acctbal)"""


def scored_lines(spark: SparkSession, root: str) -> DataFrame:
    """Line items with a label and a formula score in [0, 1] instead of a trained model."""
    return table(spark, root, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_returnflag",
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("label"),
        F.round((F.col("l_discount") * 10 + F.col("l_quantity") / 50) / 2, 4).alias("score"),
    )


SCORED_SQL = """scored AS (
  SELECT l_orderkey, l_linenumber, l_returnflag,
         CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label,
         round((l_discount * 10 + l_quantity / 50) / 2, 4) AS score
  FROM lineitem)"""
