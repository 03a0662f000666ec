"""JDBC tables: partitioned scans, repeated reads, and scans cut into key ranges."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkstream.plans.scan import numbered
from sparkstream.sources.polled import polled as poll

EVEN_LOW, EVEN_HIGH = 0.05, 1000.0
CHUNK_SIZE, FETCH_SIZE = 8096, 1024


def read_jdbc(
    spark: SparkSession, options: dict[str, str], partition_col: str | None = None, partitions: int = 1,
    bounds: tuple[int, int] | None = None,
) -> DataFrame:
    """A table read by ``partitions`` tasks, each with its own range of ``partition_col``.

    The bounds are asked of the database when not given. Filters and columns are pushed down.
    """
    reader = spark.read.format("jdbc").option("fetchsize", FETCH_SIZE).options(**options)
    if partition_col is None or partitions <= 1:
        return reader.load()
    if bounds is None:
        bounds = key_span(spark, options, partition_col)[:2]
    if bounds[0] is None:
        return reader.load()
    return (
        reader.option("partitionColumn", partition_col)
        .option("lowerBound", bounds[0])
        .option("upperBound", bounds[1])
        .option("numPartitions", partitions)
        .load()
    )


def key_span(spark: SparkSession, options: dict[str, str], key: str) -> tuple:
    """Least and greatest key and the number of rows, asked of the database itself in one query."""
    asked = {k: v for k, v in options.items() if k not in ("dbtable", "query")}
    source = options["dbtable"] if "dbtable" in options else f"({options['query']}) AS asked"
    sql = f"SELECT min({key}) AS low, max({key}) AS high, count(*) AS n FROM {source}"
    return tuple(spark.read.format("jdbc").options(**asked).option("query", sql).load().first())


def polled(
    ticks: DataFrame, read: Callable[[], DataFrame], handle: Callable[[DataFrame, int], None], every: str, checkpoint: str
):
    """Read a whole table again at every trigger and hand it to ``handle(table, batch_id)``.

    ``ticks`` is the stream that drives the triggers (for example the ``rate`` source).
    """

    return poll(ticks, read, handle).trigger(processingTime=every).option("checkpointLocation", checkpoint).start()


def key_ranges(df: DataFrame, key: str, size: int = CHUNK_SIZE, span: tuple | None = None) -> DataFrame:
    """Half-open key ranges ``[low, high)`` of about ``size`` rows, the outer ends open (NULL).

    Evenly spread whole-number keys (span / rows between 0.05 and 1000) are cut by arithmetic, inside one
    range expression; others, and keys of any other type that has an order, at every ``size``-th key.
    ``span`` gives least key, greatest key and rows where they are known, as for a database table.
    """
    low, high, rows = span or df.agg(F.min(key), F.max(key), F.count(key)).first()
    spark = df.sparkSession
    ddl = f"chunk BIGINT, low {df.schema[key].dataType.simpleString()}, high {df.schema[key].dataType.simpleString()}"
    if rows == 0 or rows <= size:
        return spark.createDataFrame([(0, None, None)], ddl)
    kind = df.schema[key].dataType
    if isinstance(kind, T.IntegralType) and EVEN_LOW < (high - low + 1) / rows < EVEN_HIGH:
        factor = (high - low + 1) / rows
        step = max(int(factor * size), 1)
        cuts = (high - low) // step
        chunk = F.col("id")
        return spark.range(cuts + 1).select(
            chunk.alias("chunk"),
            F.when(chunk > 0, F.lit(low) + chunk * step).cast(kind).alias("low"),
            F.when(chunk < cuts, F.lit(low) + (chunk + 1) * step).cast(kind).alias("high"),
        )
    keys = df.where(F.col(key).isNotNull()).select(key).distinct()
    cuts = numbered(keys, [], [key], "__pos").where((F.col("__pos") > 1) & ((F.col("__pos") - 1) % size == 0))
    cuts = cuts.select(F.floor((F.col("__pos") - 1) / size).alias("chunk"), F.col(key).alias("low"))
    first = spark.range(1).select(F.col("id").alias("chunk"), F.lit(None).cast(kind).alias("low"))
    lows = first.unionByName(cuts)
    highs = lows.select((F.col("chunk") - 1).alias("chunk"), F.col("low").alias("high"))
    return lows.join(highs, "chunk", "left").select("chunk", "low", "high")


def range_predicates(ranges: DataFrame, key: str) -> list[str]:
    """One SQL predicate per range, for a JDBC read; each range becomes a task, so the driver names them all."""
    predicates = []
    for row in ranges.orderBy("chunk").toLocalIterator():
        parts = [] if row.low is None else [f"{key} >= {sql_literal(row.low)}"]
        if row.high is not None:
            parts.append(f"{key} < {sql_literal(row.high)}")
        predicates.append(" AND ".join(parts) or "1 = 1")
    return predicates


def sql_literal(value) -> str:
    """A bound as SQL: numbers as they are, dates, times and text in quotes."""
    if isinstance(value, (int, float, Decimal)):
        return str(value)
    text = value.isoformat(" ") if isinstance(value, datetime) else str(value)
    return "'" + text.replace("'", "''") + "'"


def chunked_read(spark: SparkSession, options: dict[str, str], key: str, size: int = CHUNK_SIZE) -> DataFrame:
    """A JDBC table read range by range, one task per range."""
    table = read_jdbc(spark, options)
    properties = {"fetchsize": str(FETCH_SIZE)}
    properties.update({k: v for k, v in options.items() if k not in ("url", "dbtable")})
    return spark.read.jdbc(
        options["url"], options["dbtable"],
        predicates=range_predicates(key_ranges(table, key, size, key_span(spark, options, key)), key),
        properties=properties,
    )


def write_jdbc(df: DataFrame, options: dict[str, str], columns: Sequence[str] | None = None) -> None:
    """Append rows; columns left out (a generated key) are filled by the database."""
    rows = df.select(*columns) if columns else df
    rows.write.format("jdbc").options(**options).mode("append").save()
