"""Cleaning steps of a landed batch, each on its own and chained."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymill.functions.tokens import TokenKeys, decrypt_columns
from tallymill.schema import FLAG_COLUMNS, LABEL_COLUMN, PROTECTED_COLUMNS


def drop_step(df: DataFrame) -> DataFrame:
    return df.drop("step")


def drop_duplicates(df: DataFrame) -> DataFrame:
    """One row of each group of equal rows. Copies meet before the shuffle already."""
    return df.dropDuplicates()


def drop_null_labels(df: DataFrame) -> DataFrame:
    """Keep labelled rows. A plain null test, unlike ``dropna``, is pushed down to the files."""
    label = F.col(LABEL_COLUMN)
    labelled = label.isNotNull()
    if isinstance(df.schema[LABEL_COLUMN].dataType, (T.FloatType, T.DoubleType)):
        labelled &= ~F.isnan(label)
    return df.filter(labelled)


def rename_type(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("type", "transType")


def cast_flags(df: DataFrame) -> DataFrame:
    """Flags as booleans: 0 is false, other numbers true, also where they are text; text that is no flag is null."""

    def flag(name: str) -> Column:
        value = F.col(name).try_cast("boolean")
        if isinstance(df.schema[name].dataType, T.StringType):
            value = F.coalesce(value, F.col(name).try_cast("double").try_cast("boolean"))
        return value

    return df.withColumns({name: flag(name) for name in FLAG_COLUMNS})


def label_and_name(df: DataFrame) -> DataFrame:
    """The steps that follow the removal of copies."""
    return df.transform(drop_null_labels).transform(rename_type).transform(cast_flags)


def clean(df: DataFrame, keys: TokenKeys | None = None) -> DataFrame:
    """Decrypt if keys are given, then drop copies and unlabelled rows, rename and cast.

    Tokens of equal names differ, so copies can be found only after decryption.
    """
    if keys is not None:
        df = decrypt_columns(df, PROTECTED_COLUMNS, keys)
    return df.transform(drop_duplicates).transform(label_and_name)
