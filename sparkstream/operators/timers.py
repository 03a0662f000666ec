"""Deadlines: what was opened and not answered in time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkstream.plans.scan import next_row

DONE, AUTO = "reviewed", "auto"


def deadline_check(
    opens: DataFrame, closes: DataFrame, key: Sequence[str], open_t: str, close_t: str, wait_us: int,
    order: Sequence[str] = (),
) -> DataFrame:
    """Each opened item with the first answer inside ``[t, t + wait]``, or the automatic one.

    Opens and closes of a key pass through one reverse scan, which hands every open the nearest close
    at or after it; no pairs are formed however many rows a key has.
    """
    opened = opens.withColumns({"__t": F.col(open_t), "__kind": F.lit(0)})
    closed = closes.select(*key, F.col(close_t).alias("__t"), F.lit(1).alias("__kind"), F.col(close_t).alias("__c"))
    rows = opened.unionByName(closed, allowMissingColumns=True)
    seen = next_row(rows, key, ["__t", "__kind", *order], {"closed_at": F.col("__c")})
    in_time = F.coalesce(F.unix_micros("closed_at") - F.unix_micros(open_t) <= wait_us, F.lit(False))
    due = F.timestamp_micros(F.unix_micros(open_t) + wait_us)
    return (
        seen.where(F.col("__kind") == 0)
        .withColumn("status", F.when(in_time, F.lit(DONE)).otherwise(F.lit(AUTO)))
        .withColumn("decided_at", F.when(in_time, F.col("closed_at")).otherwise(due))
        .select(*opens.columns, "status", "decided_at")
    )
