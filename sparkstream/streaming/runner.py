"""Running and restarting streaming queries."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery


def drain(writer: DataStreamWriter, checkpoint: str) -> StreamingQuery:
    """Process everything available now, then stop; a later call goes on from the checkpoint."""
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def run_stream(
    start: Callable[[], StreamingQuery], retries: int = 3, wait_seconds: float = 5.0
) -> StreamingQuery:
    """Keep a query running: start it again after a failure, at most ``retries`` times.

    Each start resumes at the positions and the state of its checkpoint.
    """
    attempt = 0
    while True:
        query = start()
        try:
            query.awaitTermination()
            return query
        except StreamingQueryException:
            if attempt >= retries:
                raise
            attempt += 1
            time.sleep(wait_seconds)


def write_every(df: DataFrame, mode: str, every: str, checkpoint: str) -> DataStreamWriter:
    """A writer with the output mode, trigger interval and checkpoint set."""
    return df.writeStream.outputMode(mode).trigger(processingTime=every).option("checkpointLocation", checkpoint)
