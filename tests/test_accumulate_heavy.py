"""User accumulators against plain folds; heavy keys against full counts."""

import pickle
import random
from collections import Counter, defaultdict

import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from sparkstream.operators import accumulate as accumulate_
from sparkstream.operators import heavy as hv
from sparkstream.operators.accumulate import Accumulator, accumulate
from sparkstream.operators.routing import heavy_rule, route

PRIME = 1_000_003


def _times(start, values):
    for v in values:
        start = start * (v or 1) % PRIME
    return start


def _product():
    """A product in a ring, which no built-in aggregate gives, and the words seen."""

    def add(state, rows):
        made, words = state
        for v in rows.column(0).to_pylist():
            made = made * (v or 1) % PRIME
        return made, words | set(rows.column(1).to_pylist())

    return Accumulator(
        create=lambda: (1, frozenset()), add=add, merge=lambda a, b: (a[0] * b[0] % PRIME, a[1] | b[1]),
        result=lambda s: (s[0], ",".join(sorted(w for w in s[1] if w is not None)) or None, None),
        returns="product BIGINT, words STRING, nothing DATE",
    )


def _rows(rng, n):
    keys = [("hot", None)] * 6 + [(None, 1), ("", 2), ("é", None), ("b", 1)]
    return [(*rng.choice(keys), rng.choice([None, 2, 3, 5, 7_919]), rng.choice(["x", "y", None]), "clash") for _ in range(n)]


@pytest.mark.parametrize("held,ways", [(10_000, 32), (1, 2)])
def test_accumulator_folds_every_row_once(spark, held, ways):
    rows = _rows(random.Random(held), 3000)
    df = spark.createDataFrame(rows, "k STRING, j INT, v INT, w STRING, __state STRING").repartition(7)
    want = defaultdict(lambda: (1, set()))
    for k, j, v, w, _ in rows:
        product, words = want[k, j]
        want[k, j] = (_times(product, [v]), words | {w})
    got = accumulate(df, ["k", "j"], ["v", "w"], _product(), held, ways)
    assert got.dtypes == [("k", "string"), ("j", "int"), ("product", "bigint"), ("words", "string"), ("nothing", "date")]
    made = {(r.k, r.j): (r["product"], r.words) for r in got.collect()}
    assert made == {key: (p, ",".join(sorted(w for w in words if w)) or None) for key, (p, words) in want.items()}
    whole = accumulate(df, [], ["v", "w"], _product(), held, ways).collect()
    assert [r["product"] for r in whole] == [_times(1, [r[2] for r in rows])]


def test_accumulator_without_rows_and_refused_keys(spark):
    none = spark.createDataFrame([], "k STRING, v INT, w STRING, d DOUBLE")
    assert accumulate(none, ["k"], ["v", "w"], _product()).count() == 0
    assert accumulate(none, [], ["v", "w"], _product()).count() == 0
    with pytest.raises(TypeError, match="double"):
        accumulate(none, ["d"], ["v", "w"], _product())


def test_accumulator_ships_states_and_no_rows(spark):
    df = spark.range(200_000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"), F.lit("x").alias("w")).repartition(5)
    total = Accumulator(lambda: 0, lambda s, rows: s + pc.sum(rows.column(0)).as_py(), lambda a, b: a + b, lambda s: (s,), "total BIGINT")
    got = accumulate(df, ["k"], ["v"], total)
    assert sorted(map(tuple, got.collect())) == [(k, sum(range(k, 200_000, 3))) for k in range(3)]


@pytest.mark.parametrize("share,error", [(0.05, 0.5), (0.2, 0.9), (0.01, 0.2)])
def test_heavy_keys_are_all_found_within_their_bounds(spark, share, error):
    rng = random.Random(share)
    keys = [None] * 900 + ["third"] * 3000 + [f"k{i // 40}" for i in range(2000)] + [f"rare{i}" for i in range(3100)]
    rng.shuffle(keys)
    df = spark.createDataFrame([(k, 1) for k in keys], "key STRING, low INT").repartition(4)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "97")
    try:
        found = hv.heavy_keys(df, "key", share, error)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    counts = Counter(keys)
    assert {k for k, n in counts.items() if n >= share * len(keys)} <= {r.key for r in found}
    assert all(r.low <= counts[r.key] <= r.high for r in found)
    assert len(found) <= 1 / (share * (1 - error)) + 1
    assert all(counts[r.key] >= (1 - error) * share * len(keys) - 1 for r in found)
    assert df.where(hv.is_heavy("key", found)).count() == sum(counts[r.key] for r in found)


def test_heavy_keys_edges(spark):
    assert hv.heavy_keys(spark.createDataFrame([], "k INT"), "k", 0.1) == []
    assert [tuple(r) for r in hv.heavy_keys(spark.createDataFrame([(None,)] * 9, "k INT"), "k", 1.0)] == [(None, 9, 9)]
    assert hv.heavy_keys(spark.range(1000).repartition(3), "id", 0.1) == []
    with pytest.raises(ValueError):
        hv.heavy_keys(spark.range(3), "id", 0)


def test_found_keys_are_spread(spark):
    df = spark.range(9000).select(F.when(F.col("id") < 3000, -1).otherwise(F.col("id")).alias("k"), "id").repartition(3)
    found = hv.heavy_keys(df, "k", 0.1)
    assert [r.k for r in found] == [-1]
    placed = route(df, heavy_rule("k", hv.is_heavy("k", found), 3, 12, F.col("id")), 12)
    sizes = [r["count"] for r in placed.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 1300 and sum(sizes) == 9000


def test_rows_of_a_key_are_added_together_block_by_block(monkeypatch):
    made = pa.table({"__k0": [i % 3 for i in range(100)], "v": list(range(100))}).to_batches(max_chunksize=10)
    acc = Accumulator(lambda: (0, 0), lambda s, rows: (s[0] + 1, s[1] + sum(rows.column(0).to_pylist())), None, None, "")
    for block, calls in ((1_000, 1), (45, 2), (1, 10)):
        monkeypatch.setattr(accumulate_, "BLOCK_ROWS", block)
        states = pa.Table.from_batches(accumulate_._folder(["__k0"], ["v"], acc, 10)(iter(made))).to_pylist()
        assert {r["__k0"]: pickle.loads(r["__state"]) for r in states} == {k: (calls, sum(range(k, 100, 3))) for k in range(3)}
    monkeypatch.setattr(accumulate_, "BLOCK_BYTES", 1)
    (whole,) = accumulate_._folder([], ["v"], acc, 10)(iter(made))
    assert pickle.loads(whole.column("__state")[0].as_py()) == (10, 4950)
