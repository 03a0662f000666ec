"""Union, splitting, and where rows are placed."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REST = "other"


def union(left: DataFrame, right: DataFrame) -> DataFrame:
    """All rows of both inputs, duplicates kept, columns matched by name."""
    return left.unionByName(right)


def connect_map(left: DataFrame, right: DataFrame, left_value: Column, right_value: Column, out: str = "value"):
    """Two inputs of different types, each mapped to one common type."""
    return left.select(left_value.alias(out)).unionByName(right.select(right_value.alias(out)))


def tag_by(df: DataFrame, rules: Mapping[str, Column], out: str = "tag", rest: str = REST) -> DataFrame:
    """Name the first rule each row satisfies."""
    chain = None
    for name, cond in rules.items():
        chain = F.when(cond, F.lit(name)) if chain is None else chain.when(cond, F.lit(name))
    return df.withColumn(out, chain.otherwise(F.lit(rest)) if chain is not None else F.lit(rest))


def split_by(df: DataFrame, rules: Mapping[str, Column], rest: str = REST) -> dict[str, DataFrame]:
    """One DataFrame per tag; every row is in exactly one of them."""
    tagged = tag_by(df, rules, "__tag", rest)
    return {name: tagged.where(F.col("__tag") == name).drop("__tag") for name in [*rules, rest]}


def to_one(df: DataFrame) -> DataFrame:
    """All rows in one task: for small final results only. What comes before stays parallel."""
    return df.repartition(1)


def replicate(df: DataFrame, n: int, out: str = "copy") -> DataFrame:
    """Each of ``n`` partitions holds every row; ``out`` is the partition's number."""
    copies = df.withColumn(out, F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    return copies.repartitionById(n, F.col(out))


def shuffle(df: DataFrame, n: int, seed: int = 7) -> DataFrame:
    """Random placement over ``n`` partitions."""
    return df.repartition(n, F.rand(seed))


def rebalance(df: DataFrame, n: int) -> DataFrame:
    """Round-robin placement: partition sizes differ by at most the number of input tasks."""
    return df.repartition(n)


def forward(df: DataFrame) -> DataFrame:
    """Every row stays where it is."""
    return df


def rescale(df: DataFrame, n: int) -> DataFrame:
    """Fewer partitions without a shuffle."""
    return df.coalesce(n)


def route(df: DataFrame, partition: Column, n: int) -> DataFrame:
    """Rows to the partition number a rule gives them."""
    return df.repartitionById(n, F.pmod(partition, F.lit(n)).cast("int"))


def heavy_rule(key: str, heavy: Column, ways: int, n: int, salt: Column) -> Column:
    """Heavy keys share partitions ``0 .. ways-1`` by ``salt``; other keys are hashed over the rest.

    ``salt`` is taken from the row (an id), not drawn at random, so a task run again after a lost
    executor sends each row to the same place.
    """
    spread = F.pmod(F.xxhash64(salt), F.lit(ways))
    hashed = F.lit(ways) + F.pmod(F.xxhash64(key), F.lit(max(n - ways, 1)))
    return F.when(heavy, spread).otherwise(hashed).cast("int")


def partition_counts(df: DataFrame) -> DataFrame:
    """Rows per partition, numbered as the tasks are."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count(F.lit(1)).alias("n"))


def salted_sum(df: DataFrame, key: list[str], value: Column, salt: Column, ways: int, out: str) -> DataFrame:
    """Sum in two steps over salted keys, for keys whose partial sums are themselves many."""
    part = df.groupBy(*key, F.pmod(F.xxhash64(salt), F.lit(ways)).alias("__salt")).agg(F.sum(value).alias("__part"))
    return part.groupBy(*key).agg(F.sum("__part").alias(out))
