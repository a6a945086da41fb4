"""Pass-through pattern: money that arrives by transfer and leaves as cash soon after."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .skew import join_lines


def pass_through(fact: DataFrame, steps: int = 3) -> DataFrame:
    """Cash-outs within ``steps`` steps after the customer received transfers.

    Transfers are summed per (recipient, step) before they meet a cash-out, and each sum is carried
    forward to the steps it reaches. A cash-out therefore joins at most one row, whatever the
    number of transfers: no pairs are formed, and the range join becomes an equi-join.
    """
    inbound = (
        fact.filter(F.col("transaction_type") == "TRANSFER")
        .groupBy(F.col("recipient_id").alias("customer_id"), F.col("step").alias("from_step"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount"))
    )
    reach = (
        inbound.withColumn("step", F.explode(F.sequence(F.col("from_step"), F.col("from_step") + steps)))
        .groupBy("customer_id", "step")
        .agg(
            F.sum("n").alias("inbound_count"),
            F.sum("amount").alias("inbound_total"),
            F.max("from_step").alias("last_inbound_step"),
        )
    )
    cash = fact.filter(F.col("transaction_type") == "CASH_OUT").select("transaction_id", "customer_id", "step", "amount", "is_fraud")
    return join_lines(cash, reach, ["customer_id", "step"], "inner").select(
        "transaction_id",
        "customer_id",
        "step",
        "amount",
        "is_fraud",
        "inbound_count",
        "inbound_total",
        "last_inbound_step",
        (F.col("step") - F.col("last_inbound_step")).alias("steps_since_inbound"),
    )
