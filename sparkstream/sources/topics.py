"""Topics: option builders, JSON tables declared by DDL, and a file stand-in of the same schema.

The connector for a real broker is a separate jar. The builders produce its options; everything
after the read works on the ``value`` column, so the same job runs on the file stand-in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkstream.functions.scalars import parsed_once

TOPIC_DDL = "key STRING, value STRING, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP"


def topic_options(
    servers: str, topic: str, start: str = "latest", group: str | None = None, discovery_ms: int = 5000
) -> dict[str, str]:
    """Reader options; positions are kept in the query's checkpoint, so none are committed by timer."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": start,
        "kafka.metadata.max.age.ms": str(discovery_ms),
        "failOnDataLoss": "true",
    }
    if group:
        options["kafka.group.id"] = group
    return options


def topic_sink_options(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic}


def read_topic(spark: SparkSession, options: dict[str, str], streaming: bool = True) -> DataFrame:
    """Records of a topic with ``value`` as text."""
    reader = (spark.readStream if streaming else spark.read).format("kafka").options(**options)
    return reader.load().withColumn("value", F.col("value").cast("string"))


def read_topic_files(spark: SparkSession, directory: str, streaming: bool = True, per_batch: int = 100) -> DataFrame:
    """The stand-in: a directory of JSON files with a topic's columns."""
    if streaming:
        return spark.readStream.schema(TOPIC_DDL).option("maxFilesPerTrigger", per_batch).json(directory)
    return spark.read.schema(TOPIC_DDL).json(directory)


def json_rows(topic: DataFrame, ddl: str, on_bad: str = "fail") -> DataFrame:
    """``value`` parsed by a DDL schema; ``on_bad`` is ``fail`` or ``null``."""
    mode = {"fail": "FAILFAST", "null": "PERMISSIVE"}[on_bad]
    return topic.select(parsed_once(F.from_json("value", ddl, {"mode": mode})).alias("r")).select("r.*")


def declare_table(spark: SparkSession, name: str, ddl: str, topic: DataFrame) -> DataFrame:
    """A view over a topic of JSON records."""
    table = json_rows(topic, ddl)
    table.createOrReplaceTempView(name)
    return table


def json_values(df: DataFrame) -> DataFrame:
    """Rows as the ``value`` column a topic takes."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))
