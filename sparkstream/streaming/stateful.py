"""Deadlines over streams, with Spark's own join state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def deadline_stream(
    opens: DataFrame, closes: DataFrame, key: Sequence[str], open_t: str, close_t: str, wait_ms: int, delay: str
) -> DataFrame:
    """Opened items answered within ``wait_ms`` of event time, or decided when it is up: a stream-stream outer join.

    ``key`` must name one item, which is answered at most once. An open that found no close is emitted when the watermark has passed its deadline. State and
    matching stay inside the JVM.
    """
    right = {k: f"__c_{k}" for k in key}
    asked = opens.select(*key, F.col(open_t).alias("__open")).withWatermark("__open", delay)
    answers = closes.select(*[F.col(k).alias(r) for k, r in right.items()], F.col(close_t).alias("__close"))
    answers = answers.withWatermark("__close", delay)
    cond = F.expr(f"__close >= __open AND __close <= __open + INTERVAL {wait_ms / 1000:f} SECONDS")
    for k, r in right.items():
        cond = cond & (F.col(k) == F.col(r))
    joined = asked.join(answers, cond, "left_outer")
    due = F.timestamp_micros(F.unix_micros("__open") + wait_ms * 1000)
    return joined.select(
        *key,
        F.when(F.col("__close").isNull(), F.lit("auto")).otherwise(F.lit("reviewed")).alias("status"),
        F.coalesce("__close", due).alias("decided_at"),
    )
