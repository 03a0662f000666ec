"""Numbers, money, times, map lookups and record guards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def guard(df: DataFrame, bad: Column, on: str = "fail", message: str = "bad record"):
    """Stop on a bad row, or set bad rows aside.

    ``on="fail"`` returns the DataFrame with a check that fails the task that meets a bad row;
    ``on="quarantine"`` returns ``(good, bad)``.
    """
    is_bad = F.coalesce(bad, F.lit(False))
    if on == "quarantine":
        return df.where(~is_bad), df.where(is_bad)
    if on != "fail":
        raise ValueError("on must be 'fail' or 'quarantine'")
    return df.where(F.when(is_bad, F.raise_error(F.lit(message)).cast("boolean")).otherwise(F.lit(True)))


def parsed_once(parse: Column) -> Column:
    """A costly expression as the single element of an exploded array.

    A filter on one of its fields is otherwise moved below the projection with its own copy of the
    expression, and the text would be parsed once per copy.
    """
    return F.explode(F.array(parse))


def lookup(col: str, name: str) -> Column:
    """A map entry; NULL when the key is missing."""
    return F.try_element_at(F.col(col), F.lit(name))


def millis_to_time(col: str) -> Column:
    return F.timestamp_millis(F.col(col))


def time_text(col: str, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """A time as text in the session time zone."""
    return F.date_format(col, fmt)


def money(col: str | Column) -> Column:
    """Money as an exact decimal, so that sums do not depend on the order of addition."""
    return (F.col(col) if isinstance(col, str) else col).cast("decimal(18,2)")


def money_round(col: Column) -> Column:
    """Two places, half up, in one rounding: the input is taken as a decimal with eighteen places."""
    return F.round(col.cast("decimal(38,18)"), 2).cast("decimal(38,2)")


def line_total(count: str, price: str) -> Column:
    """count x price in decimals."""
    return F.col(count).cast("decimal(10,0)") * F.col(price).cast("decimal(18,2)")


def is_even(col: str) -> Column:
    return F.col(col) % 2 == 0


def greater_than(df: DataFrame, col: str, bound) -> DataFrame:
    return df.where(F.col(col) > bound)


def local_day(t: str, utc_offset_hours: int) -> Column:
    """The ``[start, end)`` window of the local calendar day, for a fixed offset from UTC."""
    return F.window(t, "1 day", "1 day", f"{-utc_offset_hours % 24} hours")
