"""Fraud metrics. One summary row per transaction type feeds all three tables, so the data is read once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def percent(part: Column, whole: Column) -> Column:
    """``part`` in percent of ``whole``; null where there is no whole."""
    return F.try_divide(part, whole) * 100


def fraud_rows(clean: DataFrame) -> DataFrame:
    return clean.filter(F.col("isFraud"))


def summarize(clean: DataFrame, *by: str) -> DataFrame:
    """Additive counts and sums per transaction type, optionally within further columns such as the batch."""
    flagged = F.col("isFlaggedFraud").cast("bigint")
    fraud = F.col("isFraud").cast("bigint")
    fraud_amount = F.when(F.col("isFraud"), F.col("amount"))
    return clean.groupBy(*by, "transType").agg(
        F.count(F.lit(1)).alias("transactions"),
        F.sum(fraud).alias("frauds"),
        F.sum(flagged).alias("flagged"),
        F.sum(flagged * fraud).alias("true_positives"),
        F.sum(fraud_amount).alias("fraud_amount"),
        F.count(fraud_amount).alias("fraud_amounts"),
        F.max(fraud_amount).alias("max_fraud_amount"),
    )


def add_up(summaries: DataFrame, *by: str) -> DataFrame:
    """One summary out of those of disjoint sets of rows."""
    added = ("transactions", "frauds", "flagged", "true_positives", "fraud_amount", "fraud_amounts")
    totals = [F.sum(name).alias(name) for name in added]
    return summaries.groupBy(*by, "transType").agg(*totals, F.max("max_fraud_amount").alias("max_fraud_amount"))


def fraud_by_type(summary: DataFrame, *by: str) -> DataFrame:
    """Transactions, frauds and fraud rate in percent of each transaction type."""
    return summary.select(
        *by,
        "transType",
        F.col("transactions").alias("total_transactions"),
        F.col("frauds").alias("fraudulent_transactions"),
        percent(F.col("frauds"), F.col("transactions")).alias("fraud_rate"),
    )


def fraud_stats(summary: DataFrame, *by: str) -> DataFrame:
    """Average and largest amount of fraudulent transactions; nulls if there are none."""
    average = F.try_divide(F.sum("fraud_amount").cast("double"), F.sum("fraud_amounts"))
    return summary.groupBy(*by).agg(
        average.alias("avg_fraud_amount"), F.max("max_fraud_amount").alias("max_fraud_amount")
    )


def flagged_fraud_accuracy(summary: DataFrame, *by: str) -> DataFrame:
    """How many transactions were flagged, and how many percent of them are frauds."""
    flagged, true_positives = F.sum("flagged"), F.sum("true_positives")
    return summary.groupBy(*by).agg(
        flagged.alias("total_flagged"),
        true_positives.alias("true_positive_flags"),
        percent(true_positives, flagged).alias("flag_accuracy"),
    )
