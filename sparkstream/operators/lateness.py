"""Watermarks row by row, windows that fire again for late rows, and rows that come too late."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkstream.plans.cells import measure_cells
from sparkstream.plans.scan import Running, running_count, running_max, scan, settled

ON_TIME, ALLOWED, LATE = "on_time", "allowed", "late"
MILLI = "INTERVAL 1 MILLISECOND"


def _span(text: str) -> Column:
    return F.expr(f"INTERVAL {text}")


def with_event_time(df: DataFrame, t: str, delay: str) -> DataFrame:
    """Bounded disorder: the watermark follows the largest time seen by ``delay``."""
    return df.withWatermark(t, delay)


def with_arrival_time(df: DataFrame, out: str = "arrived_at") -> DataFrame:
    """The current system time as event time, so that nothing is late."""
    return df.withColumn(out, F.current_timestamp()).withWatermark(out, "0 seconds")


def watermark_trace(
    df: DataFrame, t: str, arrival: Sequence[str], delay: str, out: str = "watermark", seen: Column | None = None
):
    """Each row with the watermark in force when it arrived: max earlier time - delay - 1 ms.

    ``seen`` is the largest time of rows before the first one, if there were any.

    The order is global, so the running maximum goes through cells of the arrival order whenever
    the rows are too many for one task. NULL until a first row has been seen.
    """
    layout = measure_cells(df, [], arrival)
    traced = scan(df, [], arrival, {out: running_max(F.col(t))}, inclusive=False, layout=layout)
    traced = settled(traced, layout.large)
    newest = F.col(out) if seen is None else F.greatest(F.col(out), seen)
    return traced.withColumn(out, watermark_at(newest, delay))


def watermark_at(newest: Column, delay: str) -> Column:
    return newest - _span(delay) - F.expr(MILLI)


def is_open(watermark: Column, lateness: str | None = None) -> Column:
    """Whether a window still takes rows at a watermark: on time, or within the allowed lateness."""
    last_instant = F.col("window_end") - F.expr(MILLI)
    return watermark.isNull() | (watermark < (last_instant if lateness is None else last_instant + _span(lateness)))


def classify(
    df: DataFrame, t: str, arrival: Sequence[str], size: str, delay: str, lateness: str, seen: Column | None = None
) -> DataFrame:
    """Window bounds and ``status`` of each row: on time, late but allowed, or too late."""
    traced = watermark_trace(df, t, arrival, delay, seen=seen)
    bounds = F.window(t, size)
    traced = traced.withColumns({"window_start": bounds.start, "window_end": bounds.end})
    open_ = is_open(F.col("watermark"))
    kept = is_open(F.col("watermark"), lateness)
    return traced.withColumn(
        "status", F.when(open_, F.lit(ON_TIME)).when(kept, F.lit(ALLOWED)).otherwise(F.lit(LATE))
    )


def tumbling_with_lateness(
    df: DataFrame, key: Sequence[str], t: str, arrival: Sequence[str], size: str, delay: str, lateness: str,
    value: Column, out: str = "total",
) -> tuple[DataFrame, DataFrame]:
    """``(firings, late)``.

    A window fires once when the watermark reaches its end, with the sum of its on-time rows, and
    again for every allowed late row, with the sum so far. ``firing`` counts from 0; a window that
    has only late rows has no firing 0. ``late`` holds the rows beyond the allowed lateness.
    """
    placed = classify(df, t, arrival, size, delay, lateness).withColumn("__v", value)
    group = [*key, "window_start", "window_end"]
    first = (
        placed.where(F.col("status") == ON_TIME)
        .groupBy(*group)
        .agg(F.sum("__v").alias("__v"))
        .withColumn("__first", F.lit(True))
    )
    revisions = placed.where(F.col("status") == ALLOWED).select(*group, *arrival, "__v").withColumn("__first", F.lit(False))
    fired = scan(
        revisions.unionByName(first, allowMissingColumns=True),
        group,
        list(arrival),
        {out: Running("sum", F.col("__v")), "firing": running_count(~F.col("__first"))},
    )
    return (
        fired.select(*group, "firing", out),
        placed.where(F.col("status") == LATE).drop("__v", "status"),
    )


def firing_counts(firings: DataFrame) -> Mapping[str, int]:
    """How many first firings and revisions there were: one small aggregate."""
    row = firings.agg(
        F.count_if(F.col("firing") == 0).alias("first"), F.count_if(F.col("firing") > 0).alias("revision")
    ).first()
    return row.asDict()
