"""Running values per key in a total order: the engine of every ordered operator here.

``scan`` gives each row the running sum / count / max / min / last non-null value of its key. While
keys are small it is one window over ``partitionBy(key)``. When a key is too large for one task it
runs over ``partitionBy(key, cell)``: each cell's totals (a small, map-side combined aggregate) are
accumulated over the earlier cells of the key, and enter the cell as one extra row that sorts first.
Either way the rows are shuffled once, and no task holds a whole hot key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkstream.plans.cells import WHOLE_KEYS, Layout, cells_per_task, measure_cells
from sparkstream.session import scratch

CARRY = "__carry"
CELL = "__cell"
#: Cells of cells of cells: every level has fewer rows than the one before, so this many are never reached.
MAX_DEPTH = 8


@dataclass(frozen=True, eq=False)
class Running:
    """One running value: ``sum``, ``max``, ``min`` or ``last`` (latest non-null) of ``value``."""

    kind: str
    value: Column

    def over_rows(self, value: Column, window) -> Column:
        if self.kind == "last":
            return F.last(value, ignorenulls=True).over(window)
        return {"sum": F.sum, "max": F.max, "min": F.min}[self.kind](value).over(window)

    def cell_total(self, order: Sequence[str], reverse: bool) -> Column:
        """The value one cell hands to those after it."""
        if self.kind == "last":
            place = F.when(self.value.isNotNull(), F.struct(*[F.col(o) for o in order]))
            return F.min_by(self.value, place) if reverse else F.max_by(self.value, place)
        return {"sum": F.sum, "max": F.max, "min": F.min}[self.kind](self.value)


def running_sum(value: Column) -> Running:
    return Running("sum", value)


def running_count(when: Column | None = None) -> Running:
    one = F.lit(1).cast("long")
    return Running("sum", one if when is None else F.when(when, one).otherwise(F.lit(0).cast("long")))


def running_max(value: Column) -> Running:
    return Running("max", value)


def running_min(value: Column) -> Running:
    return Running("min", value)


def latest(value: Column) -> Running:
    return Running("last", value)


def scan(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    outs: Mapping[str, Running],
    *,
    reverse: bool = False,
    inclusive: bool = True,
    layout: Layout | None = None,
    depth: int = 0,
) -> DataFrame:
    """Add one running column per entry of ``outs``.

    ``order`` must be total within a key. ``reverse`` runs from the end of the order backwards;
    ``inclusive=False`` leaves the current row out, so it sees only rows before it. ``layout``
    takes the result of :func:`measure_cells` when several scans share it; ``None`` measures.
    """
    if layout is None:
        layout = measure_cells(df, key, order)
    direction = (lambda c: F.col(c).desc_nulls_last()) if reverse else (lambda c: F.col(c).asc_nulls_first())
    last_row = Window.currentRow if inclusive else -1
    if not layout.cells:
        window = (
            Window.partitionBy(*key)
            .orderBy(*[direction(o) for o in order])
            .rowsBetween(Window.unboundedPreceding, last_row)
        )
        return df.withColumns({name: r.over_rows(r.value, window) for name, r in outs.items()})

    cell_names = [f"{CELL}{i}" for i in range(len(layout.cells))]
    value_names = {name: f"__v_{i}" for i, name in enumerate(outs)}
    rows = df.withColumns(dict(zip(cell_names, layout.cells))).withColumns(
        {value_names[name]: r.value for name, r in outs.items()}
    )
    totals = rows.groupBy(*key, *cell_names).agg(
        *[
            Running(r.kind, F.col(value_names[name])).cell_total(order, reverse).alias(value_names[name])
            for name, r in outs.items()
        ]
    )
    # the cells of a key are a sequence again, and go through the same scan: if they are too many for one task, in
    # cells of their own
    totals = settled(totals, True, "carry").toDF(*key, *[f"{c}_{depth}" for c in cell_names], *value_names.values())
    placed = [f"{c}_{depth}" for c in cell_names]
    carried = {f"{v}_c": Running(outs[name].kind, F.col(v)) for name, v in value_names.items()}
    spread = WHOLE_KEYS if depth >= MAX_DEPTH else measure_cells(totals, key, placed, cells_per_task(totals))
    carries = (
        scan(totals, key, placed, carried, reverse=reverse, inclusive=False, layout=spread, depth=depth + 1)
        .select(*key, *[F.col(p).alias(c) for p, c in zip(placed, cell_names)], *[F.col(f"{v}_c").alias(v) for v in value_names.values()])
        .withColumn(CARRY, F.lit(0))
    )
    within = (
        Window.partitionBy(*key, *cell_names)
        .orderBy(F.col(CARRY), *[direction(o) for o in order])
        .rowsBetween(Window.unboundedPreceding, last_row)
    )
    return (
        rows.withColumn(CARRY, F.lit(1))
        .unionByName(carries, allowMissingColumns=True)
        .withColumns({name: outs[name].over_rows(F.col(v), within) for name, v in value_names.items()})
        .where(F.col(CARRY) == 1)
        .drop(CARRY, *cell_names, *value_names.values())
    )


def settled(df: DataFrame, when: bool, label: str = "scan") -> DataFrame:
    """``df``, written to the shared folder and read back ``when`` that pays.

    A scan over cells reads its input twice (rows and totals), so a chain of them would double the
    work at each link; and a large result used several times would be computed as often. A written
    table stops both, is read column by column, and outlives lost executors.
    """
    if not when:
        return df
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(
    df: DataFrame, key: Sequence[str], order: Sequence[str], name: str = "pos", layout: Layout | None = None
) -> DataFrame:
    """Each row's place in its key's order, counted from 1."""
    return scan(df, key, order, {name: running_count()}, layout=layout)


def next_row(
    df: DataFrame, key: Sequence[str], order: Sequence[str], outs: Mapping[str, Column],
    layout: Layout | None = None,
) -> DataFrame:
    """For each output, the first non-null value found on a later row of the key."""
    return scan(
        df, key, order, {n: latest(c) for n, c in outs.items()}, reverse=True, inclusive=False, layout=layout
    )
