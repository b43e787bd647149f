"""Every query against DuckDB on the same files."""

import glob
import os

import duckdb
import pyarrow as pa
import pytest

import __spark_entry__ as entry_point

# Queries of the operators on training text have tests of their own.
QUERIES = {name: query for name, query in entry_point.queries().items() if not name.startswith(("op", "pipeline"))}
ORACLES = {name: sql for name, sql in entry_point.oracle_sql().items() if not name.startswith(("op", "pipeline"))}


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    yield connection
    connection.close()


def types(table: pa.Table) -> dict[str, str]:
    return {field.name: str(field.type).removeprefix("large_") for field in table.schema}


def rows(table: pa.Table) -> list[tuple]:
    names = sorted(table.column_names)
    return sorted(tuple(str(row[name]) for name in names) for row in table.to_pylist())


def test_each_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query_agrees_with_sql(spark, duck, sf_dir, name):
    actual = QUERIES[name](spark, sf_dir).toArrow()
    expected = duck.sql(ORACLES[name]).to_arrow_table()
    assert types(actual) == types(expected)
    assert actual.num_rows == expected.num_rows
    assert rows(actual) == rows(expected)


def test_entry_gives_the_golden_numbers(spark):
    found = {row["transType"]: tuple(row)[1:] for row in entry_point.entry(spark).collect()}
    assert {name: (total, frauds, round(rate, 6)) for name, (total, frauds, rate) in found.items()} == {
        "CASH_IN": (32, 3, 9.375),
        "CASH_OUT": (37, 5, 13.513514),
        "DEBIT": (44, 7, 15.909091),
        "PAYMENT": (37, 2, 5.405405),
        "TRANSFER": (39, 6, 15.384615),
    }
