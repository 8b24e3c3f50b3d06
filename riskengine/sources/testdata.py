"""The driver's generated tables in the shapes our operators take.

Transactions come from ``events``; the scored table and the truth labels are
derived from the same rows, so every query's work grows with the data.  The
SQL fragments are the DuckDB twins used by the oracle checks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --- the mapping from events, as fixed by the test plan ----------------------
# event_id -> transaction_id, user_id -> customer_id, ts -> timestamp,
# value -> amount, event_type -> merchant_category, is_fraud := value > 150,
# prob_1 := ($.k of props) / 100, prediction := prob_1 > 0.5
FRAUD_AMOUNT = 150
# ----------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw transactions: id, customer, timestamp, amount, category, label."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id").alias("transaction_id"),
        F.col("user_id").alias("customer_id"),
        F.col("ts").alias("timestamp"),
        F.col("value").alias("amount"),
        F.col("event_type").alias("merchant_category"),
        (F.col("value") > F.lit(FRAUD_AMOUNT)).alias("is_fraud"),
    )


def hot_customer_transactions(spark: SparkSession, sf_dir: str, hot_customer: int = -1,
                              parts: int = 3) -> DataFrame:
    """The transactions with every ``parts``-th row (by a hash of its id) moved to one
    customer: one key holding a third of all rows, for skew measurements."""
    tx = transactions(spark, sf_dir)
    hot = F.pmod(F.xxhash64("transaction_id"), F.lit(parts)) == F.lit(0)
    return tx.withColumn("customer_id",
                         F.when(hot, F.lit(hot_customer)).otherwise(F.col("customer_id")))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A scored table (as written by the scoring pipeline): id, customer, prob_0, prob_1, prediction."""
    ev = table(spark, sf_dir, "events")
    p1 = F.get_json_object("props", "$.k").cast("double") / F.lit(100.0)
    return ev.select(
        F.col("event_id").alias("transaction_id"),
        F.col("user_id").alias("customer_id"),
        (F.lit(1.0) - p1).alias("prob_0"),
        p1.alias("prob_1"),
        (p1 > F.lit(0.5)).cast("double").alias("prediction"),
    )


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ground-truth labels: transaction_id, is_fraud as 1.0 / 0.0."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id").alias("transaction_id"),
        (F.col("value") > F.lit(FRAUD_AMOUNT)).cast("double").alias("is_fraud"),
    )


# DuckDB twins (views over the pre-registered ``events`` table).
SQL_TRANSACTIONS = f"""transactions AS (
  SELECT event_id AS transaction_id, user_id AS customer_id, ts AS "timestamp",
         value AS amount, event_type AS merchant_category,
         value > {FRAUD_AMOUNT} AS is_fraud
  FROM events)"""

SQL_SCORED = """scored AS (
  SELECT event_id AS transaction_id, user_id AS customer_id,
         1.0 - CAST(json_extract_string(props, '$.k') AS DOUBLE) / 100.0 AS prob_0,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) / 100.0 AS prob_1,
         CAST(CAST(json_extract_string(props, '$.k') AS DOUBLE) / 100.0 > 0.5 AS DOUBLE)
           AS prediction
  FROM events)"""

SQL_TRUTH = f"""truth AS (
  SELECT event_id AS transaction_id, CAST(value > {FRAUD_AMOUNT} AS DOUBLE) AS is_fraud
  FROM events)"""
