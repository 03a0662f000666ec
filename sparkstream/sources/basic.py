"""Rows from literals, integer sequences, text lines, delimited records, views and catalog tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def from_rows(spark: SparkSession, rows: Sequence[Sequence], ddl: str) -> DataFrame:
    return spark.createDataFrame(rows, ddl)


def sequence(spark: SparkSession, first: int, last: int, out: str = "value") -> DataFrame:
    """Whole numbers from ``first`` to ``last``, both included."""
    return spark.range(first, last + 1).withColumnRenamed("id", out)


def read_lines(spark: SparkSession, path: str | Sequence[str], out: str = "line") -> DataFrame:
    """Lines of a file, of all files in a directory, or of compressed files (by extension)."""
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.text(paths).withColumnRenamed("value", out)


def stream_lines(spark: SparkSession, directory: str, files_per_batch: int = 100, out: str = "line") -> DataFrame:
    """Lines of files as they arrive in a directory."""
    reader = spark.readStream.format("text").option("maxFilesPerTrigger", files_per_batch)
    return reader.load(directory).withColumnRenamed("value", out)


def stream_socket(spark: SparkSession, host: str, port: int, out: str = "line") -> DataFrame:
    """Lines of a socket somebody else serves; for trials, since a socket cannot be replayed."""
    reader = spark.readStream.format("socket").option("host", host).option("port", port)
    return reader.load().withColumnRenamed("value", out)


def _fields(ddl: str) -> list[T.StructField]:
    return T.StructType.fromDDL(ddl).fields


BAD_LINE = "bad_line"


def parse_delimited(df: DataFrame, ddl: str, sep: str = ",", col: str = "line") -> DataFrame:
    """Delimited lines as typed columns; a missing field, or a value that does not parse, fails the job."""
    parts = F.split(col, _quoted(sep))
    short = F.raise_error(F.concat(F.lit("a field is missing: "), F.coalesce(F.col(col), F.lit("NULL"))))
    return df.select(
        *[
            F.when(F.coalesce(F.size(parts), F.lit(-1)) > i, F.get(parts, i).cast(f.dataType)).otherwise(short).alias(f.name)
            for i, f in enumerate(_fields(ddl))
        ]
    )


def parse_delimited_or_set_aside(
    df: DataFrame, ddl: str, sep: str = ",", col: str = "line"
) -> tuple[DataFrame, DataFrame]:
    """``(rows, bad)``: typed rows, and the lines in which a field is missing or does not parse.

    Each of the two reads the input; :func:`parse_delimited_marked` has both in one pass.
    """
    typed = parse_delimited_marked(df, ddl, sep, col)
    names = [f.name for f in _fields(ddl)]
    return typed.where(F.col(BAD_LINE).isNull()).select(*names), typed.where(F.col(BAD_LINE).isNotNull()).select(F.col(BAD_LINE).alias(col))


def parse_delimited_marked(df: DataFrame, ddl: str, sep: str = ",", col: str = "line") -> DataFrame:
    """Every line as typed columns and ``bad_line``: the line itself where a field is missing or does not parse, else null."""
    fields = _fields(ddl)
    split = df.select(F.col(col).alias(BAD_LINE), F.split(col, _quoted(sep)).alias("__parts"))
    typed = split.select(BAD_LINE, *[F.get("__parts", i).try_cast(f.dataType).alias(f.name) for i, f in enumerate(fields)])
    whole = F.lit(True)
    for f in fields:
        whole = whole & F.col(f.name).isNotNull()
    return typed.withColumn(BAD_LINE, F.when(~whole, F.coalesce(BAD_LINE, F.lit(""))))


def _quoted(sep: str) -> str:
    return rf"\Q{sep}\E"


def read_delimited_files(spark: SparkSession, path: str, ddl: str, sep: str = ",") -> DataFrame:
    return spark.read.schema(ddl).option("sep", sep).option("mode", "FAILFAST").csv(path)


def as_view(df: DataFrame, name: str, cols: Mapping[str, str] | Sequence[str] | None = None) -> DataFrame:
    """Register ``df`` for SQL, with its columns chosen and perhaps renamed (``{new: old}``)."""
    if isinstance(cols, Mapping):
        df = df.select(*[F.col(old).alias(new) for new, old in cols.items()])
    elif cols:
        df = df.select(*cols)
    df.createOrReplaceTempView(name)
    return df


def catalog_table(spark: SparkSession, name: str) -> DataFrame:
    """A table of the session's catalog (a metastore when the session was built with one)."""
    return spark.table(name)
