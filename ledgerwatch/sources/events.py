"""Transactions derived from an event stream table (event_id, ts, user_id, event_type, value, props).

All arithmetic is on whole cents so that any engine gives the same money values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.cleaning import derive_features
from ..schema import CSV_TO_FACT

ORIGIN = "2024-01-01"
CUSTOMER = "CASE WHEN event_id % 2 = 0 THEN concat('C', user_id) ELSE concat('C', user_id, '_', event_id % 37) END"
STEP = f"datediff(ts, DATE '{ORIGIN}') * 24 + hour(ts)"

# fixed values: the rules that turn an event into a transaction, one step after the other
EVENT_COLUMNS = [
    "event_id",
    "user_id",
    """CASE event_type WHEN 'view' THEN 'PAYMENT' WHEN 'click' THEN 'CASH_OUT' WHEN 'purchase' THEN 'TRANSFER'
                       WHEN 'signup' THEN 'CASH_IN' ELSE 'DEBIT' END AS transaction_type""",
    "CAST(round(value * 100) AS BIGINT) AS c",
    "CAST(get_json_object(props, '$.k') AS BIGINT) AS k",
    f"{STEP} AS step",
]
AMOUNT = """CASE WHEN event_id % 17 = 0
                 THEN (1 + c % 30) * CASE c % 3 WHEN 0 THEN 10000000 WHEN 1 THEN 1000000 ELSE 100000 END
                 ELSE greatest((c * c) div 2, 1L) END AS a"""
OLD_BALANCE = "CASE WHEN k % 10 <= 1 THEN 0L WHEN k % 10 <= 4 THEN a WHEN k % 10 = 5 THEN a + a div 9 ELSE 4 * a END AS ob"
NEW_BALANCE = """CASE WHEN event_id % 23 = 0 THEN ob WHEN transaction_type = 'CASH_IN' THEN ob + a
                      ELSE greatest(ob - a, 0L) END AS nb"""
FRAUD = "transaction_type IN ('TRANSFER', 'CASH_OUT') AND k % 10 = 3 AND event_id % 3 = 0"
MONEY_OF = "CAST(CAST({} AS DECIMAL(17,2)) / 100 AS DECIMAL(15,2))"
RAW_COLUMNS = [
    "event_id + 1 AS transaction_id",
    "step",
    "transaction_type",
    MONEY_OF.format("a") + " AS amount",
    f"{CUSTOMER} AS customer_id",
    MONEY_OF.format("ob") + " AS old_balance_orig",
    MONEY_OF.format("nb") + " AS new_balance_orig",
    """CASE WHEN transaction_type = 'PAYMENT' THEN concat('M', k)
            WHEN transaction_type = 'TRANSFER' AND k % 2 = 0 THEN concat('C', (user_id * 7 + k) % 15)
            ELSE concat('R', (event_id * 31 + user_id) % 500) END AS recipient_id""",
    "CAST(0 AS DECIMAL(15,2)) AS old_balance_dest",
    MONEY_OF.format("IF(transaction_type IN ('TRANSFER', 'CASH_OUT'), a, 0L)") + " AS new_balance_dest",
    f"CAST({FRAUD} AS INT) AS is_fraud",
    f"CAST(event_id % 499 = 0 OR ({FRAUD} AND a > 20000000) AS INT) AS is_flagged_fraud",
]


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def customer_of() -> Column:
    """Sender of an event: the user, split into many one-off senders for odd events."""
    return F.expr(CUSTOMER)


def raw_from_events(events: DataFrame, *kept: str) -> DataFrame:
    """transaction_id plus the eleven raw columns, under their fact names, and columns of the events that are ``kept``."""
    return (
        events.selectExpr(*kept, *EVENT_COLUMNS)
        .selectExpr("*", AMOUNT)
        .selectExpr("*", OLD_BALANCE)
        .selectExpr("*", NEW_BALANCE)
        .selectExpr(*kept, *RAW_COLUMNS)
    )


def fact_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive_features(raw_from_events(read_events(spark, sf_dir)))


def as_csv_columns(raw: DataFrame) -> DataFrame:
    """The raw columns under the names of the CSV header."""
    return raw.select(*[F.col(name).alias(csv) for csv, name in CSV_TO_FACT.items()])
