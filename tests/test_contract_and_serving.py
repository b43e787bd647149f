import datetime
from decimal import Decimal

import pytest

from tallymill.operators.contract import (
    ContractError,
    conform,
    duplicate_keys,
    enforce,
    require_columns,
    schema_report,
    violations,
)
from tallymill.operators.serving import fraud_type_bars, has_data, scatter_points
from tallymill.schema import CONTRACT_COLUMNS

SCHEMA = """transactionID bigint, transType string, amount double, nameOrig string, oldbalanceOrg double,
    newbalanceOrig double, nameDest string, oldbalanceDest double, newbalanceDest double, isFraud boolean,
    isFlaggedFraud boolean, timestamp timestamp_ntz"""
GOOD = dict(
    transactionID=1, transType="A", amount=1.005, nameOrig="C1", oldbalanceOrg=None, newbalanceOrig=2.0, nameDest="M1",
    oldbalanceDest=0.0, newbalanceDest=5.0, isFraud=True, isFlaggedFraud=False, timestamp=datetime.datetime(2024, 1, 1),
)


def table(spark, *changes):
    return spark.createDataFrame([tuple({**GOOD, **change}.values()) for change in changes], SCHEMA)


def broken(df):
    return {(row["rule"], row["column"]): row["violations"] for row in violations(df).collect() if row["violations"]}


def test_column_set_in_any_order(spark):
    good = table(spark, {})
    assert require_columns(good.select(*reversed(CONTRACT_COLUMNS))) is not None
    for changed in (good.drop("amount"), good.withColumn("step", good.amount), good.withColumnRenamed("isFraud", "isfraud")):
        with pytest.raises(ContractError):
            require_columns(changed)


def test_schema_report(spark):
    wrong = table(spark, {}, dict(amount=None)).drop("isFraud").withColumnRenamed("transType", "trans.type")
    report = {row["column"]: (row["status"], row["values"]) for row in schema_report(wrong).collect()}
    assert report.pop("isFraud") == ("missing", 0)
    assert report.pop("transType") == ("missing", 0)
    assert report.pop("trans.type") == ("extra", 2)
    assert report.pop("amount") == ("ok", 1)
    assert {status for status, _ in report.values()} == {"ok"}


def test_schema_report_is_case_sensitive(spark):
    renamed = table(spark, {}).withColumnRenamed("isFraud", "isfraud")
    wrong = {row["column"]: row["status"] for row in schema_report(renamed).collect() if row["status"] != "ok"}
    assert wrong == {"isFraud": "missing", "isfraud": "extra"}


def test_conform_gives_declared_types(spark):
    fitted = conform(table(spark, {}, dict(transactionID=2, amount=12345678901234.0)))
    assert dict(fitted.dtypes)["amount"] == "decimal(15,2)"
    assert {row["transactionID"]: row["amount"] for row in fitted.collect()} == {1: Decimal("1.01"), 2: None}


def test_each_rule_is_counted(spark):
    rows = table(
        spark, {}, dict(transactionID=None), dict(transType="t" * 51, nameDest=None), dict(nameOrig="n" * 50),
        dict(amount=1e13, oldbalanceOrg=-1e13), dict(isFraud=None, isFlaggedFraud=None), dict(timestamp=None),
        dict(amount=9999999999999.99),
    )
    assert broken(rows) == {
        ("not_null", "transactionID"): 1,
        ("max_length", "transType"): 1,
        ("not_null", "nameDest"): 1,
        ("type", "amount"): 1,
        ("type", "oldbalanceOrg"): 1,
        ("not_null", "isFraud"): 1,
        ("not_null", "isFlaggedFraud"): 1,
        ("not_null", "timestamp"): 1,
    }
    assert broken(table(spark, {})) == {}


def test_text_of_another_type_is_counted(spark):
    assert broken(table(spark, {}).selectExpr("* except (isFraud)", "'perhaps' AS isFraud")) == {("type", "isFraud"): 1}


def test_duplicate_keys(spark):
    rows = table(spark, {}, {}, dict(transactionID=2), dict(transactionID=3), dict(transactionID=3, amount=2.0))
    assert sorted(map(tuple, duplicate_keys(rows).collect())) == [(1, 2), (3, 2)]


def test_enforce(spark):
    good = table(spark, {}, dict(transactionID=2))
    assert enforce(good) is good
    with pytest.raises(ContractError, match="1 rows break not_null of amount"):
        enforce(table(spark, dict(amount=None)))
    with pytest.raises(ContractError, match="not unique"):
        enforce(table(spark, {}, {}))


def test_scatter_columns(spark):
    rows = table(spark, {})
    assert scatter_points(rows).columns == ["transactionID", "isFraud"]
    assert scatter_points(rows, "nameDest", "amount").columns == ["nameDest", "amount"]
    assert scatter_points(rows, "amount", "amount").columns == ["amount"]
    for x, y in (("step", "amount"), ("amount", "timestamp"), ("amount", "")):
        with pytest.raises(ValueError):
            scatter_points(rows, x, y)
    with pytest.raises(ValueError):
        scatter_points(rows.drop("amount"), "amount", "isFraud")


def test_bars_and_empty_tables(spark):
    by_type = spark.createDataFrame([("A", 5, 1, 20.0)], "transType string, total_transactions bigint, fraudulent_transactions bigint, fraud_rate double")
    assert fraud_type_bars(by_type).collect() == [("A", 1)]
    assert has_data(by_type) and not has_data(by_type.filter("transType = 'B'"))
