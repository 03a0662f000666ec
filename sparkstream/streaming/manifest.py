"""A table of files that readers see batch by batch: data first, then one commit record that names it."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from sparkstream.streaming import files
from sparkstream.streaming.sinks import BATCH

#: Folders of a level that are merged into one, bytes up to which a folder is on the lowest level, and from which it is left as it is.
FAN, SMALL, LARGE = 8, 1 << 22, 1 << 30
#: Large folders that a record names itself; more of them go to a page of their own.
PAGE = 1000
#: Bytes of a file when folders are merged.
FILE_BYTES = 128 << 20
#: Versions that can still be read.
KEPT = 20


class CommitTable:
    """Rows of micro-batches, each visible whole or not at all.

    A batch is written to a new folder, which no reader looks at, and becomes visible by a record ``commits/<version>.json``
    that names all folders of the table; it is put in place by a rename. A reader takes the folders of one record, so what
    it reads is one version, whatever is written meanwhile. A writer that dies before its record has left nothing but a
    folder that :meth:`vacuum` removes. A record keeps the last batch of every writer, and a batch that is already in it
    is not written again: replayed batches count once, also if their rows come out differently.

    ``fan`` folders of a level are merged into one, and the same record swaps them: no reader sees rows twice or misses
    any. A row is written about once a level; folders of ``LARGE`` bytes are left, and named in pages that later records
    refer to, so records stay short. The last ``kept`` versions can be read, older ones are removed with the folders that
    only they name. One writer commits at a time: a version that exists is an error, never replaced.
    """

    def __init__(
        self, spark: SparkSession, path: str, fan: int = FAN, small: int = SMALL, large: int = LARGE, kept: int = KEPT,
        page: int = PAGE,
    ) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.fan, self.small, self.large, self.kept, self.page = fan, small, large, kept, page

    def versions(self) -> list[int]:
        listed = files.names(self.spark, f"{self.path}/commits")
        return sorted(int(n[: -len(".json")]) for n in listed if n.endswith(".json"))

    def record(self, version: int | None = None) -> dict:
        """What a version holds, by default the last one; before the first commit, nothing."""
        if version is None:
            version = max(self.versions(), default=None)
        if version is None:
            return {"version": -1, "schema": None, "writers": {}, "pages": [], "folders": []}
        text = files.read_text(self.spark, self._commit(version))
        if text is None:
            raise FileNotFoundError(f"no version {version} in {self.path}")
        return json.loads(text)

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, each with the number of its batch."""
        record = self.record(version)
        if record["schema"] is None:
            raise FileNotFoundError(f"nothing is committed in {self.path}")
        paged = [n for page in record["pages"] for n in json.loads(files.read_text(self.spark, f"{self.path}/pages/{page}"))]
        return self._rows(record, [*paged, *[f["name"] for f in record["folders"]]])

    def write(self, rows: DataFrame, batch_id: int, writer: str = "") -> bool:
        """Add a batch. False if this writer has committed it before."""
        record = self.record()
        if record["writers"].get(writer, -1) >= batch_id:
            return False
        rows = rows.withColumn(BATCH, F.lit(batch_id).cast("bigint"))
        folder = self._folder(rows, "batch")
        self.commit({
            **record, "schema": json.loads(rows.schema.json()), "writers": {**record["writers"], writer: batch_id},
            "folders": [*record["folders"], *folder],
        })
        return True

    def commit(self, record: dict) -> None:
        """Merge what is due, and make the record the next version."""
        record = {**self._merged(record), "version": record["version"] + 1}
        sealed = [f["name"] for f in record["folders"] if f["bytes"] >= self.large]
        if len(sealed) > self.page:
            name = f"{uuid.uuid4().hex}.json"
            files.write_text(self.spark, f"{self.path}/pages/{name}", json.dumps(sealed))
            record["pages"] = [*record["pages"], name]
            record["folders"] = [f for f in record["folders"] if f["bytes"] < self.large]
        place = self._commit(record["version"])
        if files.read_text(self.spark, place) is not None:
            raise RuntimeError(f"{place} was committed by another writer")
        files.write_text(self.spark, place, json.dumps(record))
        self._clean()

    def _rows(self, record: dict, names: list[str]) -> DataFrame:
        schema = T.StructType.fromJson(record["schema"])
        if not names:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/data/{n}" for n in names])

    def _folder(self, rows: DataFrame, kind: str) -> list[dict]:
        name = f"{kind}-{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.path}/data/{name}")
        some = any(n.endswith(".parquet") for n in files.names(self.spark, f"{self.path}/data/{name}"))
        return [{"name": name, "bytes": files.size(self.spark, f"{self.path}/data/{name}")}] if some else []

    def _level(self, folder: dict) -> int:
        level, bound = 0, self.small
        while folder["bytes"] > bound:
            level, bound = level + 1, bound * self.fan
        return level

    def _merged(self, record: dict) -> dict:
        level, folders, dropped = 0, record["folders"], []
        while level <= max((self._level(f) for f in folders if f["bytes"] < self.large), default=-1):
            some = [f for f in folders if f["bytes"] < self.large and self._level(f) == level]
            if len(some) >= self.fan:
                parts = sum(f["bytes"] for f in some) // FILE_BYTES + 1
                rows = self._rows(record, [f["name"] for f in some]).coalesce(parts)
                folders = [f for f in folders if f not in some] + self._folder(rows, "merged")
                dropped += [f["name"] for f in some]
            level += 1
        return {**record, "folders": folders, "dropped": dropped}

    def _commit(self, version: int) -> str:
        return f"{self.path}/commits/{version}.json"

    def _clean(self) -> None:
        versions = self.versions()
        live, old = versions[-self.kept :], versions[: -self.kept]
        named = {f["name"] for v in live for f in self.record(v)["folders"]}
        gone = {f["name"] for v in old for f in self.record(v)["folders"]} | set(self.record()["dropped"])
        paged = {n for p in self.record()["pages"] for n in json.loads(files.read_text(self.spark, f"{self.path}/pages/{p}"))} if gone else set()
        for version in old:
            files.remove(self.spark, self._commit(version))
        for name in gone - named - paged:
            files.remove(self.spark, f"{self.path}/data/{name}")

    def vacuum(self) -> int:
        """Remove the folders that no kept version names (left by writers that died). Not while a batch is written."""
        records = [self.record(v) for v in self.versions()]
        named = {f["name"] for r in records for f in r["folders"]}
        for page in {p for r in records for p in r["pages"]}:
            named |= set(json.loads(files.read_text(self.spark, f"{self.path}/pages/{page}")))
        lost = [n for n in files.names(self.spark, f"{self.path}/data") if n not in named]
        for name in lost:
            files.remove(self.spark, f"{self.path}/data/{name}")
        return len(lost)


def committed(df: DataFrame, path: str, mode: str = "append", writer: str = "", **how) -> DataStreamWriter:
    """Each micro-batch exactly once, and visible to readers (:meth:`CommitTable.read`) only whole."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        CommitTable(batch.sparkSession, path, **how).write(batch, batch_id, writer)

    return df.writeStream.outputMode(mode).foreachBatch(on_batch)
