"""Datasets behind the charts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymill.schema import CONTRACT_KEY, SCATTER_X, SCATTER_Y


def scatter_points(transformed: DataFrame, x: str = "transactionID", y: str = "isFraud") -> DataFrame:
    """The two columns of a scatter chart over all transactions; ``scatter_sample`` bounds them for a chart to draw."""
    _check_axes(transformed, x, y)
    return transformed.select(*dict.fromkeys((x, y)))


def _check_axes(transformed: DataFrame, x: str, y: str) -> None:
    if x not in SCATTER_X or y not in SCATTER_Y:
        raise ValueError(f"no scatter chart of {x} against {y}")
    missing = [name for name in (x, y) if name not in transformed.columns]
    if missing:
        raise ValueError(f"the table lacks {missing}")


#: Cells that an axis is cut into.
CELLS = 16


def scatter_sample(
    transformed: DataFrame, x: str = "transactionID", y: str = "isFraud", points: int = 1024, cells: int = CELLS
) -> DataFrame:
    """At most ``points`` rows for a scatter chart: the two columns, and ``cell_rows``, how many rows each point's cell has.

    A grid of ``cells`` steps for each axis, with one more for nulls, keeps thin regions visible beside crowded ones. Within a
    cell, rows are dealt to slots by a hash of their key and each slot keeps the row with the smallest hash. Smallest hashes and counts
    merge, so tasks send a few numbers for each cell, and the choice depends on the rows alone, not on where they lie.
    Text has no order to cut: its hash chooses the step. A key that repeats is drawn as its smallest point.
    """
    _check_axes(transformed, x, y)
    steps = {name: 2 if isinstance(transformed.schema[name].dataType, T.BooleanType) else cells for name in (x, y)}
    slots = points // ((steps[x] + 1) * (steps[y] + 1))
    if slots < 1:
        raise ValueError(f"{points} points are fewer than the cells of the grid")
    key_hash = F.conv(F.substring(F.md5(F.coalesce(F.col(CONTRACT_KEY).cast("string"), F.lit(""))), 1, 15), 16, 10).cast("bigint")
    places = transformed.select(
        F.col(x).alias("x"),
        F.col(y).alias("y"),
        _place(transformed, x, cells).alias("x_place"),
        _place(transformed, y, cells).alias("y_place"),
        key_hash.alias("hash"),
    )
    ends = places.agg(*[f(f"{axis}_place").alias(f"{axis}_{f.__name__}") for axis in "xy" for f in (F.min, F.max)]).first()
    in_cells = places.select(
        "x",
        "y",
        "hash",
        (F.col("hash") % slots).alias("slot"),
        _cell("x_place", ends["x_min"], ends["x_max"], steps[x]).alias("x_cell"),
        _cell("y_place", ends["y_min"], ends["y_max"], steps[y]).alias("y_cell"),
    )
    cell = ["x_cell", "y_cell"]
    smallest = in_cells.groupBy(*cell, "slot").agg(F.min("hash").alias("hash"), F.count(F.lit(1)).alias("slot_rows"))
    counts = smallest.groupBy(*cell).agg(F.sum("slot_rows").alias("cell_rows"))
    # At most ``points`` rows each.
    chosen = smallest.join(F.broadcast(counts), cell).select(*cell, "slot", "hash", "cell_rows")
    found = in_cells.join(F.broadcast(chosen), [*cell, "slot", "hash"])
    point = F.min(F.struct("x", "y")).alias("point")
    drawn = found.groupBy(*cell, "slot", "cell_rows").agg(point)
    columns = {x: F.col("point.x")} | {y: F.col("point.y")}
    return drawn.select(*[value.alias(name) for name, value in columns.items()], "cell_rows")


def _place(df: DataFrame, name: str, cells: int) -> Column:
    """Where a value lies on its axis, as a number."""
    kind, value = df.schema[name].dataType, F.col(name)
    if isinstance(kind, T.StringType):
        return F.pmod(F.xxhash64(value), F.lit(cells)).cast("double") + F.when(value.isNotNull(), 0)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(value.cast("timestamp")).cast("double")
    return value.cast("int" if isinstance(kind, T.BooleanType) else "double").cast("double")


def _cell(place: str, low: float | None, high: float | None, steps: int) -> Column:
    """The step that a place is in, of equal ones between the two ends; -1 without a place."""
    if low is None:
        return F.lit(-1)
    width = (high - low) / steps
    step = F.least(F.floor((F.col(place) - low) / width), F.lit(steps - 1)) if width else F.when(F.col(place).isNotNull(), 0)
    return F.coalesce(step.cast("int"), F.lit(-1))


def fraud_type_bars(by_type: DataFrame) -> DataFrame:
    """Fraudulent transactions of each type."""
    return by_type.select("transType", "fraudulent_transactions")


def has_data(df: DataFrame) -> bool:
    """Whether there is anything to draw."""
    return not df.isEmpty()


def chart_status(df: DataFrame, charts: Mapping[str, Sequence[str]]) -> DataFrame:
    """``chart, status``: for each chart with its columns, ``ready``, ``missing column`` or ``empty``. Reads one row."""
    rows = [
        F.struct(
            F.lit(name).alias("chart"),
            F.lit("missing column").alias("status")
            if not set(columns) <= set(df.columns)
            else F.when(F.col("rows") > 0, "ready").otherwise("empty").alias("status"),
        )
        for name, columns in charts.items()
    ]
    return df.select(F.lit(1).alias("row")).limit(1).agg(F.count("row").alias("rows")).select(F.inline(F.array(*rows)))
