"""Cutting a key's ordered rows into cells that one task can hold.

A keyed window (``partitionBy(key).orderBy(t)``) sends a whole key to one task. That is the best
plan while every key is small, and a stall once one key owns a large share of the rows. A *cell* is
a stretch of one key's order: ``floor((t - origin) / width)``. Rows are then partitioned by
``(key, cell)``, and what a cell needs to know about the ones before it travels as one small row
(see :mod:`sparkstream.plans.scan`).

The width is measured, not guessed: the coarsest one whose fullest cell stays within the limit is
taken. If even equal values of the first order column overflow, the next order column is cut too.
Numbers, dates and times are cut by width, texts by the length of a common beginning, and values of any
other type by equality. The outcome is a :class:`Layout`, which several steps of one operator share.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS_PER_CELL = 4_000_000
ROWS_CONF = "spark.sparkstream.rowsPerCell"
#: Of one key's cells, which are one small row each, so many are carried forward by one task.
CELLS_CONF = "spark.sparkstream.cellsPerTask"
SETTLE_ROWS = 50_000_000
FAN_OUT = 16
CUTS_PER_PASS = 4


@dataclass(frozen=True, eq=False)
class Layout:
    """How keyed rows are spread: whole keys per task (no cells), or ``(key, *cells)``."""

    cells: tuple[Column, ...] = ()
    rows: int = 0

    @property
    def large(self) -> bool:
        """Whether an intermediate result used several times is worth writing down."""
        return bool(self.cells) or self.rows > SETTLE_ROWS


WHOLE_KEYS = Layout()


def rows_per_cell(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get(ROWS_CONF, str(ROWS_PER_CELL)))


def cells_per_task(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get(CELLS_CONF, str(ROWS_PER_CELL)))


def _number(kind: T.DataType, name: str) -> Column | None:
    """A column as a number that never falls where the column rises; None if its type has none."""
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(name)
    if isinstance(kind, T.DateType):
        return F.unix_date(name).cast("long")
    if isinstance(kind, T.TimestampNTZType):
        return F.unix_micros(F.col(name).cast("timestamp"))
    if isinstance(kind, T.IntegralType):
        return F.col(name).cast("long")
    if isinstance(kind, (T.FractionalType, T.DecimalType)):
        return F.col(name).cast("double")
    return None


def _finite(value: Column, kind: T.DataType) -> Column:
    """NaN and the infinities left out, for the ends of a range."""
    if not isinstance(kind, T.FractionalType) or isinstance(kind, T.DecimalType):
        return value
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def fullest(df: DataFrame, group: Sequence[Column]) -> int:
    """Rows of the largest group."""
    return group_sizes(df, group)[0]


def group_sizes(df: DataFrame, group: Sequence[Column]) -> tuple[int, int]:
    """Rows of the largest group, and of all groups."""
    counts = df.groupBy(*[c.alias(f"__g{i}") for i, c in enumerate(group)]).agg(F.count(F.lit(1)).alias("__rows"))
    largest, total = counts.agg(F.max("__rows"), F.sum("__rows")).first()
    return largest or 0, total or 0


def _stretches(kind: T.DataType, name: str, low, high) -> list[Column]:
    """Ways to cut a column, each finer than the one before; every piece of one lies in one piece of the other."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return [F.substring(name, 1, n) for n in (1, 2, 3, 4, 6, 8, 12, 16, 32)]
    value = _number(kind, name)
    if value is None or low is None or low == high:
        return []
    if isinstance(low, float):
        inside = F.greatest(F.least(value, F.lit(high)), F.lit(low)) - F.lit(low)
        return [F.floor(inside / F.lit((high - low) / FAN_OUT**k)) for k in range(1, 13)]
    widths, width = [], max(1, (high - low) // FAN_OUT)
    while width > 1:
        widths.append(width)
        width //= FAN_OUT
    # multiples of the finest width, so that one count at the finest gives all others
    finest = widths[-1] if widths else 1
    return [F.floor((value - F.lit(low)) / F.lit(finest * FAN_OUT**k)) for k in range(len(widths) - 1, -1, -1)]


def measure_cells(
    df: DataFrame, key: Sequence[str], order: Sequence[str], limit: int | None = None
) -> Layout:
    """A layout whose ``(key, *cells)`` groups stay within ``limit`` rows.

    No cells means that no key is too large, so plain ``partitionBy(key)`` is right: that costs one
    column-pruned, map-side combined count. Only when a key is too large are cuts counted, several in
    one pass over the rows.
    """
    limit = limit or rows_per_cell(df)
    group: list[Column] = [F.col(k) for k in key]
    largest, total = group_sizes(df, group)
    if largest <= limit:
        return Layout((), total)
    cells: list[Column] = []
    numbers = {n: v for n in order if (v := _number(df.schema[n].dataType, n)) is not None}
    ends = {}
    if numbers:
        bounds = [f(_finite(v, df.schema[n].dataType)) for n, v in numbers.items() for f in (F.min, F.max)]
        row = df.agg(*[b.alias(f"b{i}") for i, b in enumerate(bounds)]).first()
        ends = {n: (row[2 * i], row[2 * i + 1]) for i, n in enumerate(numbers)}
    for name in order:
        cuts = [*_stretches(df.schema[name].dataType, name, *ends.get(name, (None, None))), F.col(name)]
        for at in range(0, len(cuts), CUTS_PER_PASS):
            some = cuts[at : at + CUTS_PER_PASS]
            for cut, largest in zip(some, _fullest_by_cut(df, [*group, *cells], some)):
                if largest <= limit:
                    return Layout((*cells, cut), total)
        cells.append(F.col(name))
    return Layout(tuple(cells), total)


def _fullest_by_cut(df: DataFrame, group: Sequence[Column], cuts: Sequence[Column]) -> list[int]:
    """Rows of the largest ``(group, cut)`` for each cut, in one pass: every cut determines the ones before it."""
    columns = [*group, *cuts]
    names = [f"__g{i}" for i in range(len(columns))]
    sizes = df.select(*[c.alias(n) for c, n in zip(columns, names)]).rollup(*names).agg(
        F.count(F.lit(1)).alias("__rows"), F.grouping_id().alias("__left_out")
    )
    most = dict(map(tuple, sizes.groupBy("__left_out").agg(F.max("__rows")).collect()))
    return [most.get(2 ** (len(cuts) - 1 - j) - 1, 0) for j in range(len(cuts))]
