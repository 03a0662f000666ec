"""Broadcast only what was measured and found small."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 << 20


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint when it has at most ``max_rows`` rows and ``max_bytes`` bytes, else unchanged.

    Rows are measured as JSON text, which is no shorter than what is sent by much. The check reads no more
    than ``max_rows + 1`` rows. Beyond the bounds the join stays a shuffle join, where adaptive execution
    splits skewed partitions.
    """
    size = F.octet_length(F.to_json(F.struct(*df.columns))) + 16
    rows, held = df.select(size.alias("size")).limit(max_rows + 1).agg(F.count("*"), F.sum("size")).first()
    return F.broadcast(df) if rows <= max_rows and (held or 0) <= max_bytes else df
