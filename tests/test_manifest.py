"""A table read next to its writer: whole versions only, whatever fails or is merged."""

import threading

import pytest
from pyspark.sql import functions as F

from sparkstream.streaming import files
from sparkstream.streaming.manifest import CommitTable, committed
from sparkstream.streaming.runner import run_stream


def rows(spark, n, batch):
    return spark.range(n).select("id", F.lit(f"b{batch}").alias("word"))


def test_versions_are_whole_and_stay_readable_while_folders_merge(spark, tmp_path):
    table = CommitTable(spark, f"{tmp_path}/t", fan=3, small=1 << 30, large=1 << 40)
    for batch in range(7):
        assert table.write(rows(spark, 10 + batch, batch), batch)
    for version in range(7):
        got = {r.batch_id: r["count"] for r in table.read(version).groupBy("batch_id").count().collect()}
        assert got == {b: 10 + b for b in range(version + 1)}
    assert len(table.record()["folders"]) < 4
    assert table.read().select("id", "word").distinct().count() == sum(range(10, 17))


def test_a_writer_that_dies_before_its_record_leaves_nothing(spark, tmp_path, monkeypatch):
    table = CommitTable(spark, f"{tmp_path}/t")
    with pytest.raises(FileNotFoundError):
        table.read()
    table.write(rows(spark, 5, 0), 0)
    monkeypatch.setattr(CommitTable, "commit", lambda self, record: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        table.write(rows(spark, 50, 1), 1)
    monkeypatch.undo()
    assert table.read().count() == 5 and table.versions() == [0]
    assert table.vacuum() == 1 and table.read().count() == 5
    assert table.write(rows(spark, 7, 1), 1) and not table.write(rows(spark, 9, 1), 1)
    assert table.read().count() == 12
    assert table.write(rows(spark, 1, 1), 1, writer="other") and table.read().count() == 13


def test_old_versions_go_and_large_folders_are_paged(spark, tmp_path):
    table = CommitTable(spark, f"{tmp_path}/t", fan=3, small=1, large=10, kept=2, page=2)
    for batch in range(6):
        table.write(rows(spark, 4, batch), batch)
    assert table.versions() == [4, 5] and len(table.record()["pages"]) == 2
    assert table.read().count() == 24 and table.vacuum() == 0 and table.read(4).count() == 20
    merging = CommitTable(spark, f"{tmp_path}/m", fan=2, small=1 << 30, large=1 << 40, kept=1)
    for batch in range(5):
        merging.write(rows(spark, 4, batch), batch)
    held = files.names(spark, f"{tmp_path}/m/data")
    assert sorted(f["name"] for f in merging.record()["folders"]) == held and merging.read().count() == 20


def test_no_rows_and_columns_that_come_later(spark, tmp_path):
    table = CommitTable(spark, f"{tmp_path}/t")
    table.write(rows(spark, 0, 0), 0)
    assert table.read().count() == 0
    table.write(rows(spark, 2, 1), 1)
    table.write(rows(spark, 3, 2).withColumn("extra", F.lit(1)), 2)
    assert sorted((r.batch_id, r.extra) for r in table.read().collect()) == [(1, None)] * 2 + [(2, 1)] * 3
    with pytest.raises(RuntimeError, match="another writer"):
        table.commit(table.record(1))


def test_a_reader_next_to_a_failing_stream_sees_whole_batches(spark, tmp_path, monkeypatch):
    spark.range(0, 600, 1, 6).write.parquet(f"{tmp_path}/in")
    plain, failures, seen = CommitTable.commit, [], []
    table = CommitTable(spark, f"{tmp_path}/t")

    def commit(self, record):
        if len(record["folders"]) == 3 and len(failures) < 2:
            failures.append(1)
            raise RuntimeError("lost between write and commit")
        plain(self, record)

    monkeypatch.setattr(CommitTable, "commit", commit)
    done = threading.Event()

    def look():
        while not done.is_set():
            if table.versions():
                seen.append({r["count"] for r in table.read().groupBy("batch_id").count().collect()})

    def start():
        stream = spark.readStream.schema("id BIGINT").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        return committed(stream, f"{tmp_path}/t").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()

    reader = threading.Thread(target=look)
    reader.start()
    try:
        run_stream(start, retries=3, wait_seconds=0.1)
    finally:
        done.set()
        reader.join()
    assert len(failures) == 2 and seen and all(s == {100} for s in seen)
    assert table.read().count() == 600 and table.read().select("id").distinct().count() == 600
