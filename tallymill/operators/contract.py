"""Checks of the served table against its declared columns, types and rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tallymill.schema import CONTRACT, CONTRACT_COLUMNS, CONTRACT_KEY, ColumnRule


# Text columns with their declared length, as a database wants them.
TEXT_TYPES = ", ".join(f"{rule.name} VARCHAR({rule.max_length})" for rule in CONTRACT if rule.max_length)


class ContractError(ValueError):
    """The frame does not keep the contract."""


def column_status(columns: list[str]) -> dict[str, str]:
    """Each expected or present column with ``ok``, ``missing`` or ``extra``. Names are case-sensitive."""
    status = {name: "ok" if name in columns else "missing" for name in CONTRACT_COLUMNS}
    status.update({name: "extra" for name in columns if name not in CONTRACT_COLUMNS})
    return status


def schema_report(df: DataFrame) -> DataFrame:
    """Each expected or present column, its status, and how many values it holds."""
    status = column_status(df.columns)
    counts = df.agg(*[F.count(F.col(f"`{name}`")).alias(name) for name in df.columns])
    rows = [
        F.struct(
            F.lit(name).alias("column"),
            F.lit(found).alias("status"),
            (F.lit(0).cast("bigint") if found == "missing" else F.col(f"`{name}`")).alias("values"),
        )
        for name, found in sorted(status.items())
    ]
    return counts.select(F.inline(F.array(*rows)))


def require_columns(df: DataFrame) -> DataFrame:
    """The frame itself if its columns are the expected ones in any order."""
    wrong = {name: status for name, status in column_status(df.columns).items() if status != "ok"}
    if wrong:
        raise ContractError(f"columns differ from the contract: {wrong}")
    return df


def conform(df: DataFrame) -> DataFrame:
    """Bring the columns to their declared types and order; a value that does not fit becomes null."""
    return df.select(*[F.col(rule.name).try_cast(rule.type).alias(rule.name) for rule in CONTRACT])


def _checks(rule: ColumnRule) -> dict[str, Column]:
    value = F.col(rule.name)
    checks = {"type": value.isNotNull() & value.try_cast(rule.type).isNull()}
    if rule.required:
        checks["not_null"] = value.isNull()
    if rule.max_length is not None:
        checks["max_length"] = F.length(value) > rule.max_length
    return checks


def _broken() -> dict[tuple[str, str], Column]:
    return {(check, rule.name): when for rule in CONTRACT for check, when in _checks(rule).items()}


def _counts() -> list[Column]:
    return [F.count_if(when).alias(f"{check}_{name}") for (check, name), when in _broken().items()]


def violations(df: DataFrame) -> DataFrame:
    """How many rows break each rule, counted for all rules in one pass."""
    rows = [
        F.struct(
            F.lit(check).alias("rule"), F.lit(name).alias("column"), F.col(f"{check}_{name}").alias("violations")
        )
        for check, name in _broken()
    ]
    return df.agg(*_counts()).select(F.inline(F.array(*rows)))


class Watch:
    """The rules on values, counted while the frame is written, so that it is not read for them again.

    Write ``rows`` once and as they are, then ask.
    """

    def __init__(self, df: DataFrame):
        self._seen = Observation()
        self.rows = df.observe(self._seen, F.count(F.lit(1)).alias("rows"), *_counts())

    def row_count(self) -> int:
        return self._seen.get["rows"]

    def violations(self) -> dict[tuple[str, str], int]:
        """How many written rows break each rule of each column."""
        return {(check, name): self._seen.get[f"{check}_{name}"] for check, name in _broken()}

    def enforce(self) -> None:
        """Raise if a written row breaks a rule."""
        _refuse({key: rows for key, rows in self.violations().items() if rows})


def _refuse(broken: dict[tuple[str, str], int]) -> None:
    if broken:
        raise ContractError("; ".join(f"{rows} rows break {rule} of {column}" for (rule, column), rows in broken.items()))


def require_unique_keys(df: DataFrame, *within: str) -> None:
    """Raise if a key repeats, or repeats among rows with the same values of the columns ``within``. Reads those columns."""
    if not duplicate_keys(df, CONTRACT_KEY, *within).isEmpty():
        raise ContractError(f"{CONTRACT_KEY} is not unique")


def duplicate_keys(df: DataFrame, key: str = CONTRACT_KEY, *within: str) -> DataFrame:
    """Keys that occur more than once, or more than once with the same values of the columns ``within``."""
    return df.groupBy(*within, key).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)


def enforce(df: DataFrame, *within: str) -> DataFrame:
    """The frame itself if it keeps every rule; raises otherwise. Reads the frame twice; ``Watch`` spares one of them.

    Keys must be unique, or unique among rows with the same values of the further columns ``within``.
    """
    require_columns(df.drop(*within))
    broken = violations(df).filter(F.col("violations") > 0).collect()
    _refuse({(row["rule"], row["column"]): row["violations"] for row in broken})
    require_unique_keys(df, *within)
    return df
