"""Change feeds: JSON records with the row before and after each change."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkstream.functions.scalars import parsed_once

SOURCE_DDL = "STRUCT<db: STRING, `table`: STRING, pos: BIGINT>"


class Feed(NamedTuple):
    """What a change feed holds: row changes, lines that are no change records, and schema events."""

    rows: DataFrame
    bad: DataFrame
    schema_events: DataFrame


def envelope(row_ddl: str, before: str | None = None) -> str:
    """The schema of a change record whose rows have the columns of ``row_ddl`` after a change, and those of ``before``
    (by default the same) before it. No columns, no such image."""
    ddl = "op STRING, ts_ms BIGINT, source " + SOURCE_DDL + ", ddl STRING"
    for image, columns in (("after", row_ddl), ("before", row_ddl if before is None else before)):
        if columns:
            row = ", ".join(part.strip().replace(" ", ": ", 1) for part in columns.split(","))
            ddl = f"{image} STRUCT<{row}>, {ddl}"
    return ddl


def parse_changes(lines: DataFrame, row_ddl: str, col: str = "value", before: str | None = None) -> tuple[DataFrame, DataFrame]:
    """``(changes, bad)``: typed change records, and lines that are not JSON objects.

    Only the columns named are parsed: those of ``row_ddl`` after a change, those of ``before`` (by default the same) before
    it; an empty text leaves the image out. A value of a wrong type makes a line bad only if its column is named.
    """
    ddl = envelope(row_ddl, before) + ", _bad STRING"
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    parsed = lines.withColumn("__r", parsed_once(F.from_json(col, ddl, options)))
    broken = F.col("__r").isNull() | F.col("__r._bad").isNotNull()
    good = parsed.where(~broken).select("__r.*").drop("_bad").withColumn("pos", F.col("source.pos"))
    return good, parsed.where(broken).select(*lines.columns)


def of_tables(changes: DataFrame, tables: Sequence[str]) -> DataFrame:
    """Records of the tables listed as ``db.table``."""
    name = F.concat_ws(".", F.col("source.db"), F.col("source.table"))
    return changes.where(name.isin(*tables))


def split_schema_changes(changes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(row changes, schema changes)``; the latter carry no operation."""
    return changes.where(F.col("op").isNotNull()), changes.where(F.col("op").isNull())


#: Changes of columns that a statement may make: pattern, and what it does.
COLUMN_CHANGES = (
    ("add", r"(?i)\badd\s+(?:column\s+)?[`\"]?(\w+)[`\"]?\s+([\w(), ]+?)\s*;?$"),
    ("rename", r"(?i)\brename\s+column\s+[`\"]?(\w+)[`\"]?\s+to\s+[`\"]?(\w+)[`\"]?\s*;?$"),
    ("drop", r"(?i)\bdrop\s+(?:column\s+)?[`\"]?(\w+)[`\"]?()\s*;?$"),
    ("retype", r"(?i)\b(?:modify|alter)\s+column\s+[`\"]?(\w+)[`\"]?\s+(?:type\s+)?([\w(), ]+?)\s*;?$"),
)
#: Column changes of one table that the driver will hold; more than that is no history of a table's columns.
MOST_COLUMN_CHANGES = 10_000


class Lineage(NamedTuple):
    """A column as it is at the end of a feed: its type, and from which position on it had which name."""

    name: str
    kind: str
    names: tuple[tuple[int | None, str], ...]


def column_changes(schema_events: DataFrame, ddl: str = "ddl") -> DataFrame:
    """Schema events as ``pos``, ``action``, ``name``, ``arg`` (new name or type); a statement that changes no column fails."""
    found = F.lit(None).cast("struct<action: string, name: string, arg: string>")
    for action, pattern in reversed(COLUMN_CHANGES):
        made = F.struct(
            F.lit(action).alias("action"), F.regexp_extract(ddl, pattern, 1).alias("name"), F.trim(F.regexp_extract(ddl, pattern, 2)).alias("arg")
        )
        found = F.when(F.col(ddl).rlike(pattern), made).otherwise(found)
    unread = F.raise_error(F.concat(F.lit("no change of a column: "), F.col(ddl)))
    return schema_events.select("pos", F.coalesce(found, F.when(F.col(ddl).isNotNull(), unread)).alias("c")).select("pos", "c.*")


def lineage(row_ddl: str, column_events: DataFrame) -> list[Lineage]:
    """The columns after all events on ``row_ddl``, the columns at the start. The same event twice counts once.

    The history of one table's columns is small and goes through the driver, checked against ``MOST_COLUMN_CHANGES``.
    """
    events = column_events.distinct().orderBy("pos").limit(MOST_COLUMN_CHANGES + 1).collect()
    if len(events) > MOST_COLUMN_CHANGES:
        raise ValueError(f"more than {MOST_COLUMN_CHANGES} column changes")
    columns = [Lineage(n, k, ((None, n),)) for n, k in (part.strip().split(" ", 1) for part in row_ddl.split(","))]
    for e in events:
        at = next((i for i, c in enumerate(columns) if c.name == e.name), None)
        if e.action == "add":
            if at is not None:
                raise ValueError(f"column {e.name} is added at {e.pos} and already there")
            columns.append(Lineage(e.name, e.arg, ((e.pos, e.name),)))
        elif at is None:
            raise ValueError(f"column {e.name} is changed at {e.pos} and not there")
        elif e.action == "drop":
            del columns[at]
        elif e.action == "rename":
            columns[at] = Lineage(e.arg, columns[at].kind, (*columns[at].names, (e.pos, e.arg)))
        else:
            columns[at] = columns[at]._replace(kind=e.arg)
    return columns


def parse_evolving(lines: DataFrame, columns: Sequence[Lineage], col: str = "value") -> DataFrame:
    """Change records of a table whose columns change, with both images in the columns of the end.

    An image is read by the names that were in force at the record's position, so a renamed column goes on, a dropped
    one is gone, an added one is null before, and a name that was dropped and added again starts anew. Values are cast
    to the type of the end; one that cannot be cast fails, as Spark's cast does.
    """
    ddl = f"before MAP<STRING, STRING>, after MAP<STRING, STRING>, op STRING, ts_ms BIGINT, source {SOURCE_DDL}"
    parsed = lines.select(parsed_once(F.from_json(col, ddl)).alias("r")).select("r.*").where("op is not null")

    def image(name: str) -> Column:
        values = []
        for c in columns:
            value = F.lit(None).cast("string")
            for start, called in c.names:
                here = F.try_element_at(name, F.lit(called))
                value = here if start is None else F.when(F.col("source.pos") >= start, here).otherwise(value)
            values.append(value.cast(c.kind).alias(c.name))
        return F.when(F.col(name).isNotNull(), F.struct(*values)).alias(name)

    return parsed.select(image("before"), image("after"), "op", "ts_ms", "source", F.col("source.pos").alias("pos"))


def starting(changes: DataFrame, start: str = "initial", at: int | None = None) -> DataFrame:
    """The part of a feed that a start-up mode reads.

    ``initial`` snapshot rows and the log; ``earliest`` and ``never`` the log only; ``timestamp``
    the log from ``at`` (ms) on; ``offset`` the log from position ``at`` on; ``latest`` the log
    after position ``at``, the end of the feed when the reader was attached.
    """
    logged: Column = F.coalesce(F.col("op") != "r", F.lit(True))
    if start == "initial":
        return changes
    if start in ("earliest", "never"):
        return changes.where(logged)
    if at is None:
        raise ValueError(f"start mode {start} needs a position or time")
    bound = {
        "timestamp": F.col("ts_ms") >= at,
        "offset": F.col("pos") >= at,
        "latest": F.col("pos") > at,
    }[start]
    return changes.where(logged & bound)


def read_changes(
    spark: SparkSession, path: str, row_ddl: str, tables: Sequence[str] | None = None, start: str = "initial",
    at: int | None = None, streaming: bool = False, files_per_batch: int = 100, before: str | None = None,
) -> Feed:
    """A change feed from a directory of JSON lines. Bad lines belong to no table and no time, so all are given."""
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(path) if streaming else spark.read.text(path)
    good, bad = parse_changes(lines, row_ddl, before=before)
    if tables:
        good = of_tables(good, tables)
    rows, schema_events = split_schema_changes(good)
    return Feed(starting(rows, start, at), bad, starting(schema_events, start, at))
