"""Small files and folders of any store that Spark can write to: commit records, clean-up."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def read_text(spark: SparkSession, path: str) -> str | None:
    store, place = _at(spark, path)
    if not store.exists(place):
        return None
    stream = store.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Written beside the path and renamed, so a reader sees all of it or nothing."""
    store, place = _at(spark, path)
    beside = place.suffix(".part")
    stream = store.create(beside, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    store.delete(place, False)
    if not store.rename(beside, place):
        raise OSError(f"cannot rename {beside} to {place}")


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none if there is no such folder."""
    store, place = _at(spark, path)
    return sorted(f.getPath().getName() for f in store.listStatus(place)) if store.exists(place) else []


def size(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of all files in a folder."""
    store, place = _at(spark, path)
    return store.getContentSummary(place).getLength() if store.exists(place) else 0


def remove(spark: SparkSession, path: str) -> None:
    store, place = _at(spark, path)
    store.delete(place, True)
