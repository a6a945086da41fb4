"""Column names, types and the fixed code lists of the star schema."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(15, 2)
RATIO = T.DecimalType(21, 4)  # wide enough for the largest amount over a balance of one cent

# --- fixed values: transaction codes and their risk weights -------------------------------
TYPE_ROWS = [
    (1, "CASH_IN", "0.20", "Customer deposits cash into account"),
    (2, "CASH_OUT", "0.80", "Customer withdraws cash from account"),
    (3, "DEBIT", "0.40", "Direct debit/automatic payment"),
    (4, "PAYMENT", "0.30", "Payment for goods or services"),
    (5, "TRANSFER", "0.90", "Transfer to another account - highest fraud risk"),
]
TRANSACTION_TYPES = ["CASH_IN", "CASH_OUT", "DEBIT", "PAYMENT", "TRANSFER"]
OUTFLOW_TYPES = ["TRANSFER", "CASH_OUT"]
FAN_OUT_TYPES = ["TRANSFER", "CASH_OUT", "PAYMENT"]

# --- fixed values: ordered labels ---------------------------------------------------------
LEVELS = ["CRITICAL", "HIGH", "MEDIUM", "LOW"]

# --- fixed values: CSV header of the raw log and the names used everywhere else ----------
CSV_TO_FACT = {
    "step": "step",
    "type": "transaction_type",
    "amount": "amount",
    "nameOrig": "customer_id",
    "oldbalanceOrg": "old_balance_orig",
    "newbalanceOrig": "new_balance_orig",
    "nameDest": "recipient_id",
    "oldbalanceDest": "old_balance_dest",
    "newbalanceDest": "new_balance_dest",
    "isFraud": "is_fraud",
    "isFlaggedFraud": "is_flagged_fraud",
}

RAW_CSV = T.StructType(
    [
        T.StructField("step", T.IntegerType()),
        T.StructField("type", T.StringType()),
        T.StructField("amount", MONEY),
        T.StructField("nameOrig", T.StringType()),
        T.StructField("oldbalanceOrg", MONEY),
        T.StructField("newbalanceOrig", MONEY),
        T.StructField("nameDest", T.StringType()),
        T.StructField("oldbalanceDest", MONEY),
        T.StructField("newbalanceDest", MONEY),
        T.StructField("isFraud", T.IntegerType()),
        T.StructField("isFlaggedFraud", T.IntegerType()),
    ]
)

BALANCES = ["old_balance_orig", "new_balance_orig", "old_balance_dest", "new_balance_dest"]

FACT = T.StructType(
    [
        T.StructField("transaction_id", T.LongType()),
        T.StructField("step", T.IntegerType()),
        T.StructField("transaction_type", T.StringType()),
        T.StructField("amount", MONEY),
        T.StructField("customer_id", T.StringType()),
        T.StructField("old_balance_orig", MONEY),
        T.StructField("new_balance_orig", MONEY),
        T.StructField("recipient_id", T.StringType()),
        T.StructField("old_balance_dest", MONEY),
        T.StructField("new_balance_dest", MONEY),
        T.StructField("is_fraud", T.IntegerType()),
        T.StructField("is_flagged_fraud", T.IntegerType()),
        T.StructField("transaction_hour", T.IntegerType()),
        T.StructField("balance_change", MONEY),
        T.StructField("amount_to_balance_ratio", RATIO),
        T.StructField("transaction_day", T.IntegerType()),
    ]
)

REPORT = T.StructType(
    [
        T.StructField("report_day", T.IntegerType()),
        T.StructField("total_txns", T.LongType()),
        T.StructField("total_volume", T.DecimalType(25, 2)),
        T.StructField("fraud_count", T.LongType()),
        T.StructField("fraud_rate", T.DoubleType()),
        T.StructField("avg_txn_amount", T.DoubleType()),
        T.StructField("max_txn_amount", MONEY),
        T.StructField("alert_count", T.LongType()),
        T.StructField("high_risk_customers", T.LongType()),
        T.StructField("report_generated_at", T.TimestampType()),
    ]
)

ALERT = T.StructType(
    [
        T.StructField("alert_id", T.LongType()),
        T.StructField("transaction_id", T.LongType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("alert_type", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("alert_description", T.StringType()),
        T.StructField("detection_method", T.StringType()),
        T.StructField("alert_timestamp", T.TimestampType()),
        T.StructField("reviewed", T.IntegerType()),
        T.StructField("false_positive", T.IntegerType()),
        T.StructField("reviewer_notes", T.StringType()),
        # copied from the transaction, so that reports need not look it up
        T.StructField("transaction_day", T.IntegerType()),
        T.StructField("transaction_type", T.StringType()),
        T.StructField("amount", MONEY),
        T.StructField("old_balance_orig", MONEY),
        T.StructField("new_balance_orig", MONEY),
    ]
)
