"""Customer and transaction-type dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import mean_amount
from ..schema import MONEY, TYPE_ROWS


def dim_transaction_types(spark: SparkSession) -> DataFrame:
    """The five transaction codes with their risk weight; a fixed list, safe to broadcast."""
    rows = spark.createDataFrame(TYPE_ROWS, "type_id int, type_name string, risk_weight string, description string")
    return rows.withColumn("risk_weight", F.col("risk_weight").cast("decimal(3,2)"))


def type_usage(fact: DataFrame) -> DataFrame:
    """Every known type with its weight and the number of transactions that carry it."""
    used = fact.groupBy(F.col("transaction_type").alias("type_name")).agg(F.count(F.lit(1)).alias("txn_count"))
    types = dim_transaction_types(fact.sparkSession)
    return (
        types.join(used, "type_name", "left")
        .select("type_id", "type_name", "risk_weight", "description", F.coalesce("txn_count", F.lit(0)).alias("txn_count"))
        .orderBy(F.desc("risk_weight"))
    )


def dim_customers(fact: DataFrame) -> DataFrame:
    """One row per sender: counts, amounts, frauds and first and last step."""
    return fact.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.sum("amount").alias("total_amount"),
        mean_amount("amount").cast(MONEY).alias("avg_transaction"),
        F.max("amount").alias("max_transaction"),
        F.count_if(F.col("is_fraud") == 1).alias("fraud_count"),
        F.min("step").alias("first_seen_step"),
        F.max("step").alias("last_seen_step"),
    )


def replace_by_key(current: DataFrame, incoming: DataFrame, key: str | list[str]) -> DataFrame:
    """Upsert as a new snapshot: incoming rows win, the other current rows stay."""
    return current.join(incoming, key, "left_anti").unionByName(incoming)
