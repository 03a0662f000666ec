"""Windows by time and by count, running dashboards and top-n."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from math import gcd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkstream.operators.aggregate import Agg
from sparkstream.plans.cells import WHOLE_KEYS, Layout, measure_cells, rows_per_cell
from sparkstream.plans.scan import numbered, scan

START, END = "window_start", "window_end"


def _named(aggs: Mapping[str, Column]) -> list[Column]:
    return [c.alias(n) for n, c in aggs.items()]


def _flat(df: DataFrame, key: Sequence[str], aggs: Mapping[str, Column]) -> DataFrame:
    return df.select(*key, F.col("w.start").alias(START), F.col("w.end").alias(END), *aggs)


def tumbling(
    df: DataFrame, key: Sequence[str], t: str, size: str, aggs: Mapping[str, Column],
    offset: str | None = None, delay: str | None = None,
) -> DataFrame:
    """Adjacent windows of ``size``. With ``delay``, a streaming input gets a watermark."""
    source = df.withWatermark(t, delay) if delay is not None else df
    window = F.window(t, size, size, offset) if offset else F.window(t, size)
    return _flat(source.groupBy(*key, window.alias("w")).agg(*_named(aggs)), key, aggs)


def sliding(
    df: DataFrame, key: Sequence[str], t: str, size: str, slide: str, aggs: Mapping[str, Column | Agg],
    delay: str | None = None,
) -> DataFrame:
    """Windows of ``size`` that start every ``slide``; a row belongs to size / slide of them.

    Mergeable aggregates (:class:`Agg`) of a batch go by panes, stretches that divide both: rows are aggregated once by
    pane, and the panes, not the rows, are handed to their windows. Others, and streams, take Spark's own window.
    """
    if not df.isStreaming and all(isinstance(a, Agg) for a in aggs.values()):
        return _of_panes(df, key, t, size, slide, aggs)
    source = df.withWatermark(t, delay) if delay is not None else df
    made = {n: a.of_rows() if isinstance(a, Agg) else a for n, a in aggs.items()}
    return _flat(source.groupBy(*key, F.window(t, size, slide).alias("w")).agg(*_named(made)), key, made)


def _of_panes(df: DataFrame, key: Sequence[str], t: str, size: str, slide: str, aggs: Mapping[str, Agg]) -> DataFrame:
    epoch = F.timestamp_micros(F.lit(0))
    length, step = df.sparkSession.range(1).select(*[F.unix_micros(epoch + F.expr(f"INTERVAL '{x}'")) for x in (size, slide)]).first()
    pane = gcd(length, step)
    at = F.unix_micros(t)
    panes = df.where(F.col(t).isNotNull()).groupBy(*key, (at - F.pmod(at, F.lit(pane))).alias("__pane")).agg(
        *[a.of_rows().alias(n) for n, a in aggs.items()]
    )
    latest = F.col("__pane") - F.pmod("__pane", F.lit(step))
    first = latest - F.expr(f"({length} - 1 - pmod(__pane, {step})) div {step}") * step
    copies = panes.where(F.pmod("__pane", F.lit(step)) < length).withColumn("__start", F.explode(F.sequence(first, latest, F.lit(step).cast("bigint"))))
    windows = copies.groupBy(*key, "__start").agg(*[a.of_parts(n).alias(n) for n, a in aggs.items()])
    return windows.select(
        *key, F.timestamp_micros("__start").alias(START), F.timestamp_micros(F.col("__start") + length).alias(END), *aggs
    )


def session(
    df: DataFrame, key: Sequence[str], t: str, gap: str, aggs: Mapping[str, Agg], layout: Layout | None = None
) -> DataFrame:
    """Windows closed by ``gap`` of silence; rows exactly one gap apart share a window.

    When a key is too large for one task its sessions are first built inside cells. Only the first
    and the last session of a cell can reach across its border, so only those are merged again.
    """
    if layout is None:
        layout = WHOLE_KEYS if df.isStreaming else measure_cells(df, key, [t])
    rows = {n: a.of_rows() for n, a in aggs.items()}
    if not layout.cells:
        return _flat(df.groupBy(*key, F.session_window(t, gap).alias("w")).agg(*_named(rows)), key, aggs)

    names = [f"__cell{i}" for i in range(len(layout.cells))]
    local = df.withColumns(dict(zip(names, layout.cells))).groupBy(*key, *names, F.session_window(t, gap).alias("w"))
    local = _flat(local.agg(*_named(rows)), [*key, *names], aggs)
    in_cell = Window.partitionBy(*key, *names)
    local = local.withColumns(
        {
            "__edge": (F.col(START) == F.min(START).over(in_cell)) | (F.col(START) == F.max(START).over(in_cell)),
        }
    )
    inner = local.where(~F.col("__edge")).select(*key, START, END, *aggs)

    by_start = Window.partitionBy(*key).orderBy(START, END)
    so_far = by_start.rowsBetween(Window.unboundedPreceding, -1)
    edges = local.where("__edge").withColumn(
        "__new", F.coalesce((F.col(START) > F.max(END).over(so_far)).cast("int"), F.lit(1))
    )
    edges = edges.withColumn("__session", F.sum("__new").over(by_start.rowsBetween(Window.unboundedPreceding, 0)))
    merged = edges.groupBy(*key, "__session").agg(
        F.min(START).alias(START), F.max(END).alias(END), *[a.of_parts(n).alias(n) for n, a in aggs.items()]
    )
    return inner.unionByName(merged.drop("__session"))


def count_tumbling(
    df: DataFrame, key: Sequence[str], order: Sequence[str], n: int, aggs: Mapping[str, Column],
    layout: Layout | None = None,
) -> DataFrame:
    """Every ``n`` rows of a key fire once and start over; an incomplete tail never fires."""
    placed = numbered(df, key, order, "__pos", layout)
    batch = F.floor((F.col("__pos") - 1) / n).alias("window_no")
    fired = placed.groupBy(*key, batch).agg(F.count(F.lit(1)).alias("__n"), *_named(aggs))
    return fired.where(F.col("__n") == n).select(*key, "window_no", *aggs)


def count_sliding(
    df: DataFrame, key: Sequence[str], order: Sequence[str], size: int, slide: int, aggs: Mapping[str, Column | Agg],
    layout: Layout | None = None,
) -> DataFrame:
    """After every ``slide``-th row of a key, its last ``size`` rows; early firings hold fewer rows.

    Mergeable aggregates (:class:`Agg`) go by blocks, see :func:`block_windows`. With others each row is copied to the
    firings it takes part in (at most size / slide, rounded up) and these are aggregated, so a firing is a small group
    even when its key is not.
    """
    placed = numbered(df, key, order, "__pos", layout)
    if all(isinstance(a, Agg) for a in aggs.values()):
        return block_windows(placed, key, "__pos", size, slide, aggs)
    first = F.ceil(F.col("__pos") / slide)
    last = F.floor((F.col("__pos") + size - 1) / slide)
    copies = placed.where(first <= last).withColumn("window_no", F.explode(F.sequence(first, last)))
    fired = copies.groupBy(*key, "window_no").agg(F.max("__pos").alias("__last"), *_named(aggs))
    return fired.where(F.col("__last") == F.col("window_no") * slide).select(*key, "window_no", *aggs)


def block_windows(
    placed: DataFrame, key: Sequence[str], pos: str, size: int, slide: int, aggs: Mapping[str, Agg], fires: Column | None = None
) -> DataFrame:
    """The last ``size`` rows at every ``slide``-th row, from rows that have their place ``pos`` (from 1) in their key.

    Rows are cut into blocks of ``size`` by their place. A window is a block from its first row to the end, and the next
    block up to its last row: one running value backwards and one forwards for each row, whatever the overlap. The two
    meet by an equality join of the rows where windows begin with those where they end, so no row is copied. Only
    windows whose last row ``fires`` are given; the ``size`` - 1 rows before it must be there.
    """
    rows = placed.withColumn("__block", F.expr(f"({pos} - 1) div {size}"))
    if fires is not None:
        rows = rows.withColumn("__fires", fires)
    names = {name: f"__w{i}" for i, name in enumerate(aggs)}
    # a block is no larger than a window, so only very large ones are cut into cells
    spread = WHOLE_KEYS if size <= rows_per_cell(placed) else None
    rows = scan(rows, [*key, "__block"], [pos], {names[n]: a.running() for n, a in aggs.items()}, layout=spread)
    back = {f"{names[n]}b": a.running() for n, a in aggs.items()}
    rows = scan(rows, [*key, "__block"], [pos], back, reverse=True, layout=spread)
    ends = rows.where(F.col(pos) % slide == 0)
    if fires is not None:
        ends = ends.where("__fires")
    # a window that ends with its block begins with it
    whole = F.col(pos) % size == 0
    ends = ends.select(*key, F.col(pos).alias("__end"), F.when(~whole, F.col(pos) - size + 1).alias("__from"), *names.values())
    begins = rows.where((F.col(pos) + size - 1) % slide == 0)
    begins = begins.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(key)], F.col(pos).alias("__at"), *back)
    same = F.col("__from") == F.col("__at")
    for i, k in enumerate(key):
        same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    both = ends.join(begins, same, "left")
    made = [a.of_two(F.col(f"{names[n]}b"), F.col(names[n])).alias(n) for n, a in aggs.items()]
    return both.select(*key, (F.col("__end") / slide).cast("bigint").alias("window_no"), *made)


def window_rows(df: DataFrame, key: Sequence[str], t: str, size: str) -> DataFrame:
    """What each window holds: one row per (key, window, time). Needs no shuffle."""
    return _flat(df.select(*key, F.window(t, size).alias("w"), F.col(t)), key, {t: F.col(t)})


def cumulative_ticks(
    df: DataFrame, key: Sequence[str], t: str, value: Column, tick: str = "1 second",
    utc_offset_hours: int = 0, out: str = "total",
) -> DataFrame:
    """Early results of a day window: at the end of every tick, each key's sum since local midnight.

    A key is carried from its first tick of the day to the last tick anyone has that day. Sums per
    tick come first (map-side combined) and are accumulated; only then is each one repeated over the
    silent ticks that follow it.
    """
    midnight = f"{-utc_offset_hours % 24} hours"
    step = F.expr(f"INTERVAL {tick}")

    def placed(cols: list[Column]) -> DataFrame:
        ticked = df.select(*cols, F.col(t), F.window(t, tick).end.alias("tick_end"))
        return ticked.select("*", F.window(t, "1 day", "1 day", midnight).start.alias("day_start"))

    per_tick = (
        placed([*map(F.col, key), value.alias("__v")])
        .groupBy(*key, "day_start", "tick_end")
        .agg(F.sum("__v").alias("__sum"))
    )
    day_end = placed([]).groupBy("day_start").agg(F.max("tick_end").alias("__day_last"))
    day = Window.partitionBy(*key, "day_start").orderBy("tick_end")
    running = per_tick.select(
        *key, "day_start", "tick_end",
        F.sum("__sum").over(day.rowsBetween(Window.unboundedPreceding, 0)).alias(out),
        F.lead("tick_end").over(day).alias("__next"),
    ).join(day_end, "day_start")
    until = F.coalesce(F.col("__next") - step, F.col("__day_last"))
    return running.select(*key, "day_start", F.explode(F.sequence("tick_end", until, step)).alias("tick_end"), out)


def top_n_per(df: DataFrame, by: Sequence[str], value: str, tie: Sequence[str], n: int, out: str = "rank"):
    """The ``n`` largest rows of each group; equal values are ordered by ``tie``.

    Spark cuts each task's rows to ``n`` per group before the shuffle.
    """
    window = Window.partitionBy(*by).orderBy(F.col(value).desc(), *[F.col(c).asc() for c in tie])
    return df.withColumn(out, F.row_number().over(window)).where(F.col(out) <= n)
