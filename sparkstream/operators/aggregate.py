"""Keyed aggregates, in their final form (one row per key) and running form (one row per input row)."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkstream.plans.cells import WHOLE_KEYS, fullest, measure_cells, rows_per_cell
from sparkstream.plans.scan import Running, numbered, running_max as max_so_far, running_sum as sum_so_far, scan

FOLD_BLOCK = 1000


@dataclass(frozen=True, eq=False)
class Agg:
    """An aggregate whose partial results can be merged: ``sum``, ``count``, ``min`` or ``max``."""

    kind: str
    value: Column

    def of_rows(self) -> Column:
        return {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}[self.kind](self.value)

    def of_parts(self, name: str) -> Column:
        return {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}[self.kind](name)

    def running(self) -> Running:
        """The partial result over the rows so far."""
        if self.kind == "count":
            return Running("sum", F.when(self.value.isNotNull(), 1).otherwise(0).cast("long"))
        return Running(self.kind, self.value)

    def of_two(self, a: Column, b: Column) -> Column:
        """Two partial results as one; a missing one (null) adds nothing."""
        if self.kind in ("min", "max"):
            return {"min": F.least, "max": F.greatest}[self.kind](a, b)
        return F.coalesce(a + b, a, b)


def keyed_sum(df: DataFrame, key: Sequence[str], value: Column, out: str = "total") -> DataFrame:
    return df.groupBy(*key).agg(F.sum(value).alias(out))


def running_sum(df: DataFrame, key: Sequence[str], value: Column, order: Sequence[str], out: str = "total"):
    """Every row with the sum of its key so far."""
    return scan(df, key, order, {out: sum_so_far(value)})


def running_max(df: DataFrame, key: Sequence[str], value: Column, order: Sequence[str], out: str = "max"):
    """Every row with the maximum of its key so far."""
    return scan(df, key, order, {out: max_so_far(value)})


def keyed_reduce(
    df: DataFrame,
    key: Sequence[str],
    value: str,
    step: Callable[[Column, Column], Column],
    order: Sequence[str],
    out: str = "reduced",
    block: int = FOLD_BLOCK,
) -> DataFrame:
    """Combine a key's values with an associative ``step``, in order.

    A tree: values are folded in blocks of at most ``block``, then the block results in blocks,
    until one value per key is left. No array holds more than ``block`` values, whatever the key.
    """
    remaining = fullest(df, [F.col(k) for k in key])
    layout = WHOLE_KEYS if remaining <= rows_per_cell(df) else measure_cells(df, key, order)
    level = numbered(df.where(F.col(value).isNotNull()), key, order, "__pos", layout).select(
        *key, F.col(value).alias(out), "__pos"
    )
    while True:
        items = F.array_sort(F.collect_list(F.struct("__pos", F.col(out).alias("v"))))
        values = F.transform(items, lambda item: item["v"])
        folded = F.aggregate(F.slice(values, 2, block), values[0], step)
        level = (
            level.withColumn("__block", F.floor((F.col("__pos") - 1) / block) + 1)
            .groupBy(*key, "__block")
            .agg(folded.alias(out))
            .withColumnRenamed("__block", "__pos")
        )
        remaining = -(-remaining // block)
        if remaining <= 1:
            return level.drop("__pos")


def keyed_max(df: DataFrame, key: Sequence[str], value: str, out: str = "max") -> DataFrame:
    """The maximum per key, and nothing that is not tied to it."""
    return df.groupBy(*key).agg(F.max(value).alias(out))


def descending(df: DataFrame, col: str) -> Column:
    """A value of any simple type that sorts the other way round; null stays null."""
    kind, value = df.schema[col].dataType, F.col(col)
    if isinstance(kind, T.IntegralType):
        return F.bitwise_not(value)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.when(value.isNotNull(), F.struct(~F.isnan(value), -value))  # NaN is the greatest number
    if isinstance(kind, T.DateType):
        return -F.unix_date(value)
    if isinstance(kind, T.TimestampType):
        return -F.unix_micros(value)
    if isinstance(kind, T.TimestampNTZType):
        return -F.unix_micros(value.cast("timestamp"))
    if isinstance(kind, T.BooleanType):
        return ~value
    if isinstance(kind, T.StringType):  # of two texts the one that goes on is now the lesser
        points = F.transform(F.filter(F.split(value, ""), lambda c: c != ""), lambda c: -F.ascii(c))
        return F.when(value.isNotNull(), F.concat(points, F.array(F.lit(1))))
    return -value


def keyed_max_by(df: DataFrame, key: Sequence[str], value: str, order: Sequence[str]) -> DataFrame:
    """The whole row of each key's maximum, the earliest one among equals; a null value or order comes first.

    Values and orders may be of any type that has an order, as Spark orders it: NaN is the greatest number. One
    aggregate with map-side partial results, so a large key is reduced before it is shuffled.
    """
    rest = [c for c in df.columns if c not in key]
    rank = [F.col(value).alias("r")]
    for i, o in enumerate(order):
        rank += [F.col(o).isNull().alias(f"n{i}"), descending(df, o).alias(f"o{i}")]
    best = F.max(F.struct(*rank, F.struct(*rest).alias("row"))).alias("__best")
    return df.groupBy(*key).agg(best).select(*key, "__best.row.*")


def keyed_aggregate(
    df: DataFrame, key: Sequence[str], accumulators: Mapping[str, Column], results: Mapping[str, Column]
) -> DataFrame:
    """A user aggregate: mergeable accumulators, then result expressions over them."""
    acc = df.groupBy(*key).agg(*[c.alias(n) for n, c in accumulators.items()])
    return acc.select(*key, *[c.alias(n) for n, c in results.items()])


def count_max_min(df: DataFrame, key: Sequence[str], counted: str, value: str) -> DataFrame:
    """Count of non-null ``counted`` and the extremes of ``value`` per key."""
    return df.groupBy(*key).agg(
        F.count(counted).alias("cnt"), F.max(value).alias("max_value"), F.min(value).alias("min_value")
    )


def having(df: DataFrame, cond: Column) -> DataFrame:
    """A filter on aggregated rows."""
    return df.where(cond)


def tick_total(per_group: DataFrame, tick: Sequence[str], value: str, out: str = "total") -> DataFrame:
    """The grand total over all groups at each tick."""
    return per_group.groupBy(*tick).agg(F.sum(value).alias(out))


def xor_diff(df: DataFrame, left: str, right: str, out: str = "missing") -> DataFrame:
    """XOR over two columns: the one value present in only one of them."""
    return df.agg(F.bit_xor(F.col(left).bitwiseXOR(F.col(right))).alias(out))
