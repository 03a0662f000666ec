"""Keys that hold a large share of the rows, found in one pass by a mergeable sketch."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkstream.plans.scan import settled

#: Of the share asked for, what the counts may be too low by.
ERROR = 0.5


def heavy_keys(df: DataFrame, key: str, share: float, error: float = ERROR) -> list[Row]:
    """The keys of ``share`` of the rows or more, as rows of the key, ``low`` and ``high``: bounds of its number of rows.

    Each task keeps at most 1 / (share x error) counters (Misra and Gries): when there are more, the largest one that
    does not fit is taken off all of them, and counters at zero go. What was taken off is the most a count can be too
    low by; the tasks' counters and errors add up, to at most ``share x error`` of all rows. So no heavy key is missed, every
    key returned holds (1 - error) of the share or more, and there are at most 1 / (share x (1 - error)) of them: a list
    for :func:`is_heavy` and :func:`~sparkstream.operators.routing.heavy_rule`, whatever the size of the data. One scan of
    the key's column; tasks send counters, not rows. Null keys are counted like others.
    """
    if not 0 < share <= 1 or not 0 < error < 1:
        raise ValueError("share must lie in (0, 1], error between 0 and 1")
    field = df.schema[key]
    size = math.ceil(1 / (share * error))
    schema = T.StructType([T.StructField("key", field.dataType), *T.StructType.fromDDL("low BIGINT, off BIGINT, n BIGINT").fields])
    parts = df.select(F.col(key).alias("key")).mapInArrow(_sketch(size), schema)
    counted = parts.groupBy("key").agg(F.sum("low").alias("low"), F.sum("off").alias("off"), F.sum("n").alias("n"))
    counted = settled(counted, True, "counters")
    off, n = counted.agg(F.sum("off"), F.sum("n")).first()
    high = F.col("low") + F.lit(off or 0)
    found = counted.where((F.col("low") > 0) & (high >= share * (n or 0)))
    return found.select(F.col("key").alias(key), "low", high.alias("high")).orderBy(F.desc("low"), key).collect()


def is_heavy(key: str, found: Sequence[Row]) -> Column:
    """Whether a row's key is one of those found."""
    known = [row[0] for row in found]
    listed = F.coalesce(F.col(key).isin([k for k in known if k is not None]), F.lit(False))
    return listed | F.col(key).isNull() if None in known else listed


def _sketch(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = counts = None
        off = n = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            n += batch.num_rows
            mine, many = pc.value_counts(batch.column(0)).flatten()
            if keys is not None:
                both = pa.table({"key": pa.concat_arrays([keys, mine]), "n": pa.concat_arrays([counts, many])})
                both = both.group_by("key").aggregate([("n", "sum")]).combine_chunks()
                mine, many = both.column("key").chunk(0), both.column("n_sum").chunk(0)
            keys, counts, less = _cut(mine, many, size)
            off += less
        if keys is not None:  # the task's error and rows go with its first counter, there is one at least
            first = pa.array(np.arange(len(keys)) == 0)
            yield pa.RecordBatch.from_arrays(
                [keys, counts, *[pc.if_else(first, pa.scalar(x, pa.int64()), pa.scalar(0, pa.int64())) for x in (off, n)]],
                names=["key", "low", "off", "n"],
            )

    return run


def _cut(keys: pa.Array, counts: pa.Array, size: int) -> tuple[pa.Array, pa.Array, int]:
    """At most ``size`` counters above zero, and what was taken off each."""
    if len(keys) <= size:
        return keys, counts, 0
    many = counts.to_numpy()
    less = int(np.partition(many, len(many) - size - 1)[len(many) - size - 1])
    left = many > less
    if not left.any():  # all the same: one counter at zero carries the error
        left[0] = True
    return keys.filter(pa.array(left)), pa.array(many[left] - less), less
