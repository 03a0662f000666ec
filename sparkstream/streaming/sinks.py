"""Where results go: console, text, topics, tables, exactly-once files, latest value per key."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from sparkstream.streaming import files

BATCH = "batch_id"
FOLD_EVERY = 50
FOLD_MARK = "_fold_every"


def show_sink(df: DataFrame, label: str = "", rows: int = 20) -> DataStreamWriter | None:
    """Print rows, with a label in front. A stream returns its writer, to be started by the caller."""
    shown = df.select(F.lit(label).alias("label"), "*") if label else df
    if df.isStreaming:
        return shown.writeStream.format("console").option("numRows", rows).option("truncate", False)
    shown.show(rows, truncate=False)
    return None


def write_text(df: DataFrame, path: str, writers: int, stamp: datetime | None = None) -> str:
    """One-column text by ``writers`` tasks, one file each; ``stamp`` adds a time suffix to the path."""
    target = f"{path}-{stamp:%Y%m%d%H%M%S}" if stamp else path
    df.repartition(writers).write.text(target)
    return target


def write_topic(df: DataFrame, options: dict[str, str], checkpoint: str | None = None):
    """Append the ``value`` column to a topic (at least once)."""
    if df.isStreaming:
        return df.writeStream.format("kafka").options(**options).option("checkpointLocation", checkpoint)
    return df.write.format("kafka").options(**options).save()


def insert_into(df: DataFrame, table: str, writers: int | None = None) -> None:
    """``INSERT INTO table SELECT ...``; ``writers`` deals the rows out in round-robin."""
    (df.repartition(writers) if writers else df).write.insertInto(table)


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """One micro-batch as its own partition. A batch that runs again replaces what it wrote before."""
    df.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")


def exactly_once(df: DataFrame, path: str, mode: str = "append") -> DataStreamWriter:
    """Each micro-batch exactly once: replayed batches overwrite their own partition.

    For append-only results Spark's file sink gives the same; this form also takes update mode.
    """

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, path, batch_id)

    return df.writeStream.outputMode(mode).foreachBatch(on_batch)


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("basePath", path).parquet(path)


def upsert(df: DataFrame, path: str, key: Sequence[str], order: Sequence[str], mode: str = "append") -> DataStreamWriter:
    """Latest row per key by ``order``, kept as a log of per-batch changes (see :func:`append_to_log`)."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        append_to_log(batch, path, key, order, batch_id)

    return df.writeStream.outputMode(mode).foreachBatch(on_batch)


def append_to_log(rows: DataFrame, path: str, key: Sequence[str], order: Sequence[str], batch_id: int) -> None:
    """One row per key of this batch, as partition ``batch_id`` of the log.

    The cost follows the batch and not the size of the store. Every ``FOLD_EVERY`` batches the
    partition holds all keys instead, so readers never look further back than the last such one. The
    number is kept with the log from its first batch: a changed default loses nothing.
    """
    if batch_id == 0:
        files.write_text(rows.sparkSession, f"{path}/{FOLD_MARK}", str(FOLD_EVERY))
    if batch_id and _folded(rows.sparkSession, path, batch_id) == batch_id:
        rows = log_before(rows.sparkSession, path, batch_id).drop(BATCH).unionByName(rows)
    write_batch(last_per_key(rows, key, order), path, batch_id)


def log_before(spark: SparkSession, path: str, batch_id: int) -> DataFrame:
    """The part of a log that describes the state just before a batch; other partitions are pruned."""
    folded = _folded(spark, path, batch_id - 1)
    return read_batches(spark, path).where((F.col(BATCH) >= folded) & (F.col(BATCH) < batch_id))


def latest_rows(spark: SparkSession, path: str, key: Sequence[str], order: Sequence[str] = (BATCH,)) -> DataFrame:
    """The current row of every key; by default the one of the latest batch."""
    log = read_batches(spark, path)
    last = log.agg(F.max(BATCH)).first()[0]
    return last_per_key(log.where(F.col(BATCH) >= _folded(spark, path, last)), key, order).drop(BATCH)


def _folded(spark: SparkSession, path: str, batch_id: int) -> int:
    """The last batch up to this one that holds all keys; the first batch if the log is not folded."""
    every = files.read_text(spark, f"{path}/{FOLD_MARK}")
    return batch_id // int(every) * int(every) if every else 0


def last_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    rest = [c for c in df.columns if c not in key]
    best = F.max_by(F.struct(*rest), F.struct(*order)).alias("__last")
    return df.groupBy(*key).agg(best).select(*key, "__last.*")


def per_connection(
    df: DataFrame, open_: Callable[[], object], invoke: Callable[[object, object], None], close: Callable[[object], None]
) -> DataStreamWriter:
    """A user-written sink: one connection per partition, each row handed to ``invoke``."""

    def write_partition(rows) -> None:
        connection = open_()
        try:
            for row in rows:
                invoke(connection, row)
        finally:
            close(connection)

    return df.writeStream.foreachBatch(lambda batch, _: batch.foreachPartition(write_partition))


def write_jdbc_stream(df: DataFrame, options: dict[str, str], columns: Sequence[str] | None = None) -> DataStreamWriter:
    """Append each micro-batch to a database table (at least once)."""
    from sparkstream.sources.jdbc import write_jdbc

    return df.writeStream.foreachBatch(lambda batch, _: write_jdbc(batch, options, columns))
