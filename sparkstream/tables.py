"""Readers for the star-schema and event tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkstream.session import prepare

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

EVENTS_DDL = (
    "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
)


def path_of(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def zoned(df: DataFrame) -> DataFrame:
    """TIMESTAMP_NTZ columns as TIMESTAMP, which event-time operators require."""
    ntz = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampNTZType)]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in ntz}) if ntz else df


def unzoned(df: DataFrame) -> DataFrame:
    """TIMESTAMP columns back as TIMESTAMP_NTZ (zone-free results)."""
    zoned_cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned_cols}) if zoned_cols else df


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return zoned(prepare(spark).read.parquet(path_of(sf_dir, name)))


def stream_table(spark: SparkSession, sf_dir: str, name: str, ddl: str, files_per_batch: int = 100) -> DataFrame:
    """A table as a file stream, whether it is one file or a folder of files; a micro-batch takes ``files_per_batch`` of them.

    The path is given as a glob (the last letter in brackets), because a plain path to a single file
    is refused by the file stream source.
    """
    path = path_of(sf_dir, name)
    return zoned(prepare(spark).readStream.schema(ddl).option("maxFilesPerTrigger", files_per_batch).parquet(f"{path[:-1]}[{path[-1]}]"))


def stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream_table(spark, sf_dir, "events", EVENTS_DDL)


def as_views(spark: SparkSession, sf_dir: str, names: list[str] | None = None) -> None:
    for name in names or TABLES:
        load(spark, sf_dir, name).createOrReplaceTempView(name)
