"""Transactions in the raw layout, derived from the ``events`` test table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallymill.operators.position import with_source_position

_RAW_FROM_EVENTS = [
    "CAST(hour(ts) + 24 * (dayofyear(ts) - 1) + 1 AS INT) AS step",
    "event_id AS transactionID",
    """CASE event_type WHEN 'click' THEN 'PAYMENT' WHEN 'view' THEN 'CASH_IN' WHEN 'purchase' THEN 'TRANSFER'
                       WHEN 'signup' THEN 'DEBIT' ELSE 'CASH_OUT' END AS type""",
    "value AS amount",
    "concat('C', user_id) AS nameOrig",
    "value * 2 AS oldbalanceOrg",
    "value AS newbalanceOrig",
    "concat('M', (user_id * 7) % 50) AS nameDest",
    "CAST(0 AS DOUBLE) AS oldbalanceDest",
    "value AS newbalanceDest",
    """CASE WHEN CAST(regexp_extract(props, '[0-9]+', 0) AS INT) % 25 = 24 THEN NULL
            WHEN CAST(regexp_extract(props, '[0-9]+', 0) AS INT) % 10 = 0 THEN 1 ELSE 0 END AS isFraud""",
    "CASE WHEN value > 150 THEN 1 ELSE 0 END AS isFlaggedFraud",
    "ts AS timestamp",
]


def tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw transactions, one for each event."""
    return spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr(*_RAW_FROM_EVENTS)


def positioned_tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw transactions with their position in the source file."""
    events = with_source_position(spark.read.parquet(f"{sf_dir}/events.parquet"))
    return events.selectExpr(*_RAW_FROM_EVENTS, "_file", "_block", "_row")
