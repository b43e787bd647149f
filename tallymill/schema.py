"""Columns and types of the transaction tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Table and column names, declared types and lengths that users of the tables rely on.
RAW_SCHEMA = T.StructType(
    [
        T.StructField("step", T.IntegerType()),
        T.StructField("transactionID", T.LongType()),
        T.StructField("type", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("nameOrig", T.StringType()),
        T.StructField("oldbalanceOrg", T.DoubleType()),
        T.StructField("newbalanceOrig", T.DoubleType()),
        T.StructField("nameDest", T.StringType()),
        T.StructField("oldbalanceDest", T.DoubleType()),
        T.StructField("newbalanceDest", T.DoubleType()),
        T.StructField("isFraud", T.IntegerType()),
        T.StructField("isFlaggedFraud", T.IntegerType()),
        T.StructField("timestamp", T.TimestampNTZType()),
    ]
)

PROTECTED_COLUMNS = ("nameOrig", "nameDest")
FLAG_COLUMNS = ("isFraud", "isFlaggedFraud")
LABEL_COLUMN = "isFraud"

#: As text files hold them: flags may be numbers, truth values or anything else, which only cleaning tells apart.
CSV_SCHEMA = T.StructType(
    [T.StructField(f.name, T.StringType() if f.name in FLAG_COLUMNS else f.dataType) for f in RAW_SCHEMA]
)

TRANSFORMED_DATA = "transformed_data"
FRAUD_BY_TYPE = "fraud_by_type"
FRAUD_STATS = "fraud_stats"
FLAGGED_FRAUD_ACCURACY = "flagged_fraud_accuracy"

BATCH_COUNT = 12
BATCH_SPAN = 2


@dataclass(frozen=True)
class ColumnRule:
    """Declared type of one served column, and what its values must satisfy."""

    name: str
    type: T.DataType
    required: bool = False
    max_length: int | None = None


_MONEY = T.DecimalType(15, 2)

CONTRACT_KEY = "transactionID"
CONTRACT = (
    ColumnRule("transactionID", T.LongType(), required=True),
    ColumnRule("transType", T.StringType(), required=True, max_length=50),
    ColumnRule("amount", _MONEY, required=True),
    ColumnRule("nameOrig", T.StringType(), required=True, max_length=50),
    ColumnRule("oldbalanceOrg", _MONEY),
    ColumnRule("newbalanceOrig", _MONEY),
    ColumnRule("nameDest", T.StringType(), required=True, max_length=50),
    ColumnRule("oldbalanceDest", _MONEY),
    ColumnRule("newbalanceDest", _MONEY),
    ColumnRule("isFraud", T.BooleanType(), required=True),
    ColumnRule("isFlaggedFraud", T.BooleanType(), required=True),
    ColumnRule("timestamp", T.TimestampNTZType(), required=True),
)
CONTRACT_COLUMNS = tuple(rule.name for rule in CONTRACT)

# What the scatter chart may put on each axis.
SCATTER_X = CONTRACT_COLUMNS
SCATTER_Y = ("transactionID", "transType", "amount", "isFraud", "isFlaggedFraud")
