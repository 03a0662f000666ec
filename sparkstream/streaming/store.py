"""State of a stream by key, as files: buckets of keys, runs in levels, one commit record per micro-batch."""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from sparkstream.streaming import files

SEQ, BUCKET = "__seq", "__bucket"
BUCKETS, FAN = 1024, 4
#: Runs of up to so many bytes are on the lowest level.
SMALL = 1 << 18


class KeyedLog:
    """The latest rows of every key.

    A micro-batch writes the rows of its own keys as one run of files, sorted by buckets of keys. A look-up asks for the
    buckets of its keys, a filter that Parquet answers from the statistics of row groups and pages, so of a large run it
    reads the pages of these buckets. The level of a run follows from its size, each level ``fan`` times the one below. ``fan`` runs of a level are merged
    into one, so small runs never make a large one be written again, a row is written about once a level, and a look-up
    has a few runs to open. What a batch leaves is told by its commit record, written
    last: without it the batch has changed nothing, and a batch that runs again starts from the record before. Runs that
    neither the last record nor the one before names are removed.

    ``key`` tells whose rows replace each other: all rows a batch writes for a key replace the earlier ones. ``by`` (the
    key, or some columns of it) deals keys to buckets and is what look-ups ask for. The number of buckets is kept in the
    record, so a changed default does not lose what is stored. Null is a key like any other.
    """

    def __init__(
        self, spark: SparkSession, path: str, key: Sequence[str], by: Sequence[str] | None = None,
        buckets: int | None = None, fan: int | None = None,
    ) -> None:
        self.spark, self.path, self.key, self.by = spark, path, list(key), list(by or key)
        self.buckets, self.fan = buckets or BUCKETS, fan or FAN

    def record(self, batch_id: int) -> dict:
        """What the batch left: the runs that make up the state, and how they are laid out."""
        text = files.read_text(self.spark, self._record_path(batch_id)) if batch_id >= 0 else None
        if text is None and batch_id >= 0:
            raise FileNotFoundError(f"no commit record of batch {batch_id} in {self.path}")
        return json.loads(text) if text else {"buckets": self.buckets, "runs": [], "schema": None}

    def before(self, batch_id: int, rows: DataFrame) -> DataFrame | None:
        """What is stored, as of the batch before, under the look-up columns of ``rows``."""
        record = self.record(batch_id - 1)
        if not record["runs"]:
            return None
        wanted = sorted(r[0] for r in rows.select(self._bucket(record["buckets"])).distinct().collect())
        asked = rows.select(*[F.col(c).alias(f"__ask_{c}") for c in self.by]).distinct()
        held = self.held(record, wanted)
        known = held.join(asked, reduce(and_, [F.col(c).eqNullSafe(F.col(f"__ask_{c}")) for c in self.by]), "left_semi")
        return self._newest(known).drop(SEQ, BUCKET)

    def current(self, batch_id: int) -> DataFrame | None:
        """The whole state after a batch."""
        record = self.record(batch_id)
        return self._newest(self.held(record)).drop(SEQ, BUCKET) if record["runs"] else None

    def write(self, batch_id: int, rows: DataFrame) -> None:
        """Replace what is stored under the keys of ``rows``, and commit the batch."""
        record = self.record(batch_id - 1)
        rows = rows.withColumns({SEQ: F.lit(batch_id).cast("bigint"), BUCKET: self._bucket(record["buckets"])})
        runs = record["runs"] + self._run(rows, f"batch-{batch_id}")
        record = {"buckets": record["buckets"], "schema": rows.schema.json(), "runs": runs}
        level, merges = 0, 0
        while level <= max(map(self._level, record["runs"]), default=-1):
            some = [r for r in record["runs"] if self._level(r) == level]
            if len(some) >= self.fan:
                merges += 1
                merged = self._newest(self.held(record | {"runs": some}))
                made = self._run(merged, f"merged-{batch_id}-{merges}")
                record["runs"] = [r for r in record["runs"] if r not in some] + made
            level += 1
        files.write_text(self.spark, self._record_path(batch_id), json.dumps(record))
        self._clean(batch_id, record)

    def held(self, record: dict, buckets: Sequence[int] | None = None) -> DataFrame:
        """All versions of the rows in a record's runs, of some buckets or of all."""
        paths = [f"{self.path}/runs/{run['name']}" for run in record["runs"]]
        rows = self.spark.read.schema(T.StructType.fromJson(json.loads(record["schema"]))).parquet(*paths)
        return rows if buckets is None else rows.where(F.col(BUCKET).isin(list(buckets)))

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(*self.by), F.lit(buckets)).cast("int").alias(BUCKET)

    def _newest(self, rows: DataFrame) -> DataFrame:
        last = F.max(SEQ).over(Window.partitionBy(*self.key))
        return rows.withColumn("__last", last).where(F.col(SEQ) == F.col("__last")).drop("__last")

    def _level(self, run: dict) -> int:
        level, bytes_ = 0, run["bytes"]
        while bytes_ > SMALL:
            level, bytes_ = level + 1, bytes_ / self.fan
        return level

    def _run(self, rows: DataFrame, name: str) -> list[dict]:
        path = f"{self.path}/runs/{name}"
        rows.repartition(BUCKET).sortWithinPartitions(BUCKET, *self.key).write.mode("overwrite").parquet(path)
        some = any(n.endswith(".parquet") for n in files.names(self.spark, path))
        return [{"name": name, "bytes": files.size(self.spark, path)}] if some else []

    def _record_path(self, batch_id: int) -> str:
        return f"{self.path}/commits/{batch_id}.json"

    def _clean(self, batch_id: int, record: dict) -> None:
        """The record of the batch before stays, for this batch may run again; what only earlier ones name goes."""
        named = {r["name"] for r in record["runs"]} | {r["name"] for r in self.record(batch_id - 1)["runs"]}
        for name in files.names(self.spark, f"{self.path}/runs"):
            if name not in named:
                files.remove(self.spark, f"{self.path}/runs/{name}")
        if batch_id > 1:
            files.remove(self.spark, self._record_path(batch_id - 2))
