import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallymill.operators import metrics
from tallymill.operators.cleaning import cast_flags, clean, drop_null_labels, drop_step, rename_type
from tallymill.plans.transform import drop_duplicates_by_batch
from tallymill.schema import RAW_SCHEMA

LANDED = "type string, amount double, isFraud int, isFlaggedFraud int"


def landed(spark, *rows, schema=LANDED):
    return spark.createDataFrame(list(rows), schema)


def tables(cleaned):
    summary = metrics.summarize(cleaned)
    return (
        sorted(tuple(row) for row in metrics.fraud_by_type(summary).collect()),
        [tuple(row) for row in metrics.fraud_stats(summary).collect()],
        [tuple(row) for row in metrics.flagged_fraud_accuracy(summary).collect()],
    )


def test_copies_and_unlabelled_rows_go(spark):
    cleaned = clean(landed(spark, ("A", 1.0, 1, 0), ("A", 1.0, 1, 0), ("A", 2.0, None, 1), ("B", None, 0, None), ("B", None, 0, None)))
    assert cleaned.columns == ["transType", "amount", "isFraud", "isFlaggedFraud"]
    assert sorted(map(tuple, cleaned.collect()), key=str) == [("A", 1.0, True, False), ("B", None, False, None)]


def test_labels_that_are_not_a_number_go(spark):
    rows = landed(spark, ("A", float("nan")), ("B", None), ("C", 1.0), schema="type string, isFraud double")
    assert [row["type"] for row in drop_null_labels(rows).collect()] == ["C"]
    decimals = landed(spark, ("A", Decimal(1)), ("B", None), schema="type string, isFraud decimal(1,0)")
    assert [row["type"] for row in drop_null_labels(decimals).collect()] == ["A"]


def test_the_label_test_reaches_the_files(spark, tmp_path):
    landed(spark, ("A", 1.0, 1, 0)).write.parquet(str(tmp_path / "rows"))
    cleaned = clean(spark.read.parquet(str(tmp_path / "rows")))
    plan = cleaned._sc._jvm.PythonSQLUtils.explainString(cleaned._jdf.queryExecution(), "formatted")
    assert "PushedFilters: [IsNotNull(isFraud)]" in plan


def test_absent_columns_are_no_error(spark):
    rows = landed(spark, ("x",), schema="other string")
    assert drop_step(rows).columns == ["other"]
    assert rename_type(rows).columns == ["other"]


def test_numbers_as_flags(spark):
    rows = landed(spark, ("A", 1.0, 0, 1), ("A", 1.0, 7, -1), ("A", 1.0, None, None))
    assert [tuple(row)[2:] for row in cast_flags(rows).collect()] == [(False, True), (True, True), (None, None)]


def test_text_as_flags(spark):
    """Text that is no flag is not an error; its row stays, as its label is not null when rows are dropped."""
    rows = landed(spark, ("A", "1", "yes"), ("A", "maybe", "0"), ("A", None, "1"), schema="type string, isFraud string, isFlaggedFraud string")
    cleaned = cast_flags(drop_null_labels(rows))
    assert [tuple(row)[1:] for row in cleaned.collect()] == [(True, True), (None, False)]
    by_type = metrics.fraud_by_type(metrics.summarize(cleaned.withColumnRenamed("type", "transType").withColumn("amount", F.lit(1.0))))
    assert tuple(by_type.first()) == ("A", 2, 1, 50.0)


def test_metrics_of_some_rows(spark):
    rows = clean(landed(spark, ("A", 10.0, 1, 1), ("A", 30.0, 1, 0), ("A", 50.0, 0, 1), ("B", 7.0, 0, None)))
    by_type, stats, accuracy = tables(rows)
    assert by_type == [("A", 3, 2, pytest.approx(200 / 3)), ("B", 1, 0, 0.0)]
    assert stats == [(20.0, 30.0)]
    assert accuracy == [(2, 1, 50.0)]


def test_metrics_of_nothing(spark):
    for rows in (landed(spark), landed(spark, ("A", 1.0, None, 1))):
        assert tables(clean(rows)) == ([], [(None, None)], [(None, None, None)])


def test_nothing_flagged_gives_no_accuracy(spark):
    assert tables(clean(landed(spark, ("A", 1.0, 1, 0), ("B", 2.0, 0, 0))))[2] == [(0, 0, None)]


def test_unknown_flags_are_skipped(spark):
    assert tables(clean(landed(spark, ("A", 1.0, 1, None), ("B", 2.0, 1, 1))))[2] == [(1, 1, 100.0)]
    assert tables(clean(landed(spark, ("A", 1.0, 1, None))))[2] == [(None, None, None)]


def test_frauds_without_amount(spark):
    assert tables(clean(landed(spark, ("A", None, 1, 0), ("A", 4.0, 1, 0))))[1] == [(4.0, 4.0)]


def test_decimal_amounts(spark):
    rows = landed(spark, ("A", Decimal("0.10"), 1, 0), ("B", Decimal("0.25"), 1, 0), schema="type string, amount decimal(15,2), isFraud int, isFlaggedFraud int")
    stats = metrics.fraud_stats(metrics.summarize(clean(rows)))
    assert [field.simpleString() for field in stats.schema] == ["avg_fraud_amount:double", "max_fraud_amount:decimal(15,2)"]
    assert tuple(stats.first()) == (pytest.approx(0.175), Decimal("0.25"))


def test_one_pass_feeds_all_metrics(spark):
    """The summary is one aggregate whose shuffle carries a row per type, not per transaction."""
    summary = metrics.summarize(cast_flags(rename_type(landed(spark, ("A", 1.0, 1, 1)))))
    plan = summary._sc._jvm.PythonSQLUtils.explainString(summary._jdf.queryExecution(), "simple")
    assert plan.count("Exchange") == 1 and plan.count("partial_sum") >= 1


def test_copies_meet_across_segments_of_a_batch(spark):
    rows = [("x", 0), ("x", 0), ("x", 1), ("y", 2), ("z", 4), ("z", 0)]
    segmented = spark.createDataFrame(rows, "name string, segment int")
    found = sorted(map(tuple, drop_duplicates_by_batch(segmented, batches=4, span=2).collect()))
    expected = sorted({(name, batch) for name, segment in rows for batch in range(1, 5) if batch - 1 <= segment <= batch})
    assert found == expected


@pytest.mark.parametrize("span", [1, 2, 3, 100])
def test_any_number_of_batches(spark, span):
    """Copies within the batches of one number, across two numbers, and behind the last batch."""
    segments = (0, 0, 1, 59, 60, 61, 62, 63, 123, 124, 125, 199, 210)
    rows = [(name, segment) for name in "xy" for segment in segments if name == "x" or segment % 2]
    segmented = spark.createDataFrame(rows, "name string, segment int")
    found = sorted(map(tuple, drop_duplicates_by_batch(segmented, batches=200, span=span).collect()))
    assert found == sorted({(name, b) for name, segment in rows for b in range(1, 201) if b - 1 <= segment <= b + span - 2})

def test_raw_schema_takes_a_row(spark):
    row = (1, 2, "A", 3.5, "C1", 1.0, 2.0, "M1", 3.0, 4.0, None, 1, datetime.datetime(2024, 1, 1))
    assert clean(spark.createDataFrame([row], RAW_SCHEMA)).isEmpty()
