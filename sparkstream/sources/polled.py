"""A table that is read whole again at every trigger, with Spark's own readers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter


def ticks(spark: SparkSession, per_second: int = 1) -> DataFrame:
    """A stream that has something new whenever it is asked, to drive the polls."""
    return spark.readStream.format("rate").option("rowsPerSecond", per_second).load()


def polled(driver: DataFrame, read: Callable[[], DataFrame], handle: Callable[[DataFrame, int], None]) -> DataStreamWriter:
    """At every trigger of ``driver`` hand ``read()``, the table as it is now, to ``handle(table, batch_id)``.

    Trigger and checkpoint are set on the writer. A trigger that is repeated after a failure reads again under
    the same number, so a handler that writes by number (:func:`~sparkstream.streaming.sinks.write_batch`) stays exact.
    """
    return driver.writeStream.foreachBatch(lambda _, batch_id: handle(read(), batch_id))
