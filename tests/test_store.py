"""State by key: look-ups, replays, merges, and bytes that follow the batch."""

import random

import pytest
from pyspark.sql import functions as F

from sparkstream.streaming import files, store
from sparkstream.streaming.store import KeyedLog

DDL = "k INT, v INT"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str) if df is not None else []


def test_against_a_dict(spark, tmp_path):
    rng, want = random.Random(1), {}
    log = KeyedLog(spark, f"{tmp_path}/s", ["k"], buckets=5, fan=2)
    for batch in range(9):
        changed = {rng.choice([None, *range(12)]): [rng.randrange(99) for _ in range(rng.randint(1, 3))] for _ in range(rng.randrange(5))}
        df = spark.createDataFrame([(k, v) for k, vs in changed.items() for v in vs], DDL)
        assert rows_of(log.before(batch, df)) == sorted(((k, v) for k in changed for v in want.get(k, [])), key=str)
        log.write(batch, df)
        want |= changed
        assert rows_of(log.current(batch)) == sorted(((k, v) for k, vs in want.items() for v in vs), key=str)
    assert len(files.names(spark, f"{tmp_path}/s/commits")) == 2


def test_a_batch_that_runs_again_starts_from_the_record_before(spark, tmp_path):
    log = KeyedLog(spark, f"{tmp_path}/s", ["k"], fan=2)
    write = lambda batch, *rows: log.write(batch, spark.createDataFrame(rows, DDL))
    write(0, (1, 1), (2, 2))
    write(1, (1, 10))
    write(2, (2, 20), (3, 30))
    write(2, (2, 21))  # the same batch, with less
    assert rows_of(log.current(2)) == [(1, 10), (2, 21)]
    # files of a batch that was never committed are not part of the state
    spark.createDataFrame([(9, 9, 3, 0)], "k INT, v INT, __seq BIGINT, __bucket INT").write.parquet(f"{tmp_path}/s/runs/batch-3")
    assert rows_of(log.current(2)) == [(1, 10), (2, 21)]
    write(3, (4, 40))
    assert rows_of(log.current(3)) == [(1, 10), (2, 21), (4, 40)]
    with pytest.raises(FileNotFoundError):
        log.before(6, spark.createDataFrame([(1, 1)], DDL))


def test_layout_is_kept_with_the_state(spark, tmp_path):
    KeyedLog(spark, f"{tmp_path}/s", ["k"], buckets=7).write(0, spark.createDataFrame([(k, k) for k in range(20)], DDL))
    other = KeyedLog(spark, f"{tmp_path}/s", ["k"], buckets=3)
    assert rows_of(other.before(1, spark.createDataFrame([(4, 0), (5, 0)], DDL))) == [(4, 4), (5, 5)]


def test_look_up_by_a_part_of_the_key(spark, tmp_path):
    log = KeyedLog(spark, f"{tmp_path}/s", ["g", "k"], by=["g"])
    ddl = "g STRING, k INT, v INT"
    log.write(0, spark.createDataFrame([("a", 1, 1), ("a", 2, 2), ("b", 1, 3)], ddl))
    log.write(1, spark.createDataFrame([("a", 2, 20)], ddl))
    assert rows_of(log.before(2, spark.createDataFrame([("a", 9, 0)], ddl))) == [("a", 1, 1), ("a", 2, 20)]


def test_bytes_follow_the_batch(spark, tmp_path, monkeypatch):
    """A hundred batches of a few keys over a state of many: what is written does not grow with the state, runs stay few."""
    monkeypatch.setattr(store, "SMALL", 1 << 14)
    log = KeyedLog(spark, f"{tmp_path}/s", ["k"], fan=4)
    log.write(0, spark.range(40_000).select(F.col("id").cast("int").alias("k"), F.col("id").cast("int").alias("v")))
    whole = files.size(spark, f"{tmp_path}/s/runs/batch-0")
    written = []
    for batch in range(1, 101):
        log.write(batch, spark.range(1).select(F.lit(batch % 7).cast("int").alias("k"), F.lit(batch).alias("v")))
        mine = [n for n in files.names(spark, f"{tmp_path}/s/runs") if n.split("-")[1] == str(batch)]
        written.append(sum(files.size(spark, f"{tmp_path}/s/runs/{n}") for n in mine))
    assert max(written) < whole / 10 and sum(written) < whole
    assert len(log.record(100)["runs"]) <= 8 and len(files.names(spark, f"{tmp_path}/s/runs")) <= 16
    got = dict(map(tuple, log.current(100).where("k < 8").collect()))
    assert got == {k: max(b for b in range(1, 101) if b % 7 == k) for k in range(7)} | {7: 7}


def test_a_look_up_reads_the_pages_of_its_buckets(spark, tmp_path):
    log = KeyedLog(spark, f"{tmp_path}/s", ["k"], buckets=64)
    log.write(0, spark.range(300_000).select(F.col("id").cast("int").alias("k"), F.col("id").cast("int").alias("v")))
    some = log.held(log.record(0), [5])
    plan = some._jdf.queryExecution().executedPlan()
    want = spark.range(300_000).where(F.pmod(F.xxhash64(F.col("id").cast("int")), F.lit(64)) == 5).count()
    assert some.count() == want
    assert "PushedFilters: [IsNotNull(__bucket), EqualTo(__bucket,5)]" in plan.toString() or "In(__bucket" in plan.toString()
