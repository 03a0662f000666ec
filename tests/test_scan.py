"""The keyed scan: same answers with whole keys and with cells, whatever the skew."""

import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from sparkstream.plans.cells import CELLS_CONF, ROWS_CONF, fullest, measure_cells
from sparkstream.plans.scan import latest, next_row, numbered, running_count, running_max, running_sum, scan
from sparkstream.plans.sizes import broadcast_if_small


def skewed(spark, n=600, seed=1, burst=False):
    """A third of the rows on key 0; with ``burst`` all of those at one instant."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        hot = rng.random() < 0.34
        k = 0 if hot else rng.choice([1, 2, 3, None])
        t = 500 if hot and burst else rng.randrange(1000)
        rows.append((k, t, i, rng.choice([None, rng.randrange(50)])))
    return rows, spark.createDataFrame(rows, "k INT, t BIGINT, id BIGINT, v INT").withColumn("ts", F.timestamp_millis("t"))


def expected(rows, reverse, inclusive):
    out = {}
    for k in {r[0] for r in rows}:
        seq = sorted((r for r in rows if r[0] == k), key=lambda r: (r[1], r[2]), reverse=reverse)
        for i, r in enumerate(seq):
            seen = [x[3] for x in seq[: i + 1 if inclusive else i]]
            vals = [v for v in seen if v is not None]
            out[r[2]] = (sum(vals) if vals else None, max(vals, default=None), vals[-1] if vals else None, len(seen))
    return out


@pytest.mark.parametrize("burst", [False, True])
@pytest.mark.parametrize("reverse,inclusive", [(False, True), (False, False), (True, True), (True, False)])
def test_scan_against_plain_python(spark, layout, burst, reverse, inclusive):
    rows, df = skewed(spark, burst=burst)
    if layout == "cells":
        spark.conf.set(ROWS_CONF, "25")
    outs = {"s": running_sum(F.col("v")), "m": running_max(F.col("v")), "l": latest(F.col("v")), "n": running_count()}
    got = scan(df, ["k"], ["ts", "id"], outs, reverse=reverse, inclusive=inclusive).collect()
    want = expected(rows, reverse, inclusive)
    assert len(got) == len(rows)
    assert {r.id: (r.s, r.m, r.l, r.n or 0) for r in got} == want


@pytest.mark.parametrize("burst", [False, True])
def test_cells_keep_every_group_within_the_limit(spark, burst):
    _, df = skewed(spark, burst=burst)
    layout = measure_cells(df, ["k"], ["ts", "id"], 20)
    assert layout.cells and layout.rows == 600
    assert fullest(df, [F.col("k"), *layout.cells]) <= 20
    assert not measure_cells(df, ["k"], ["ts", "id"], 600).cells


def test_orders_of_any_type(spark, layout):
    """Texts, fractions with NaN and infinities, decimals, booleans: cut into cells where keys are large."""
    rng = random.Random(7)
    rows = []
    for i in range(120):
        text = "".join(rng.choice("ab") for _ in range(rng.randrange(6)))
        number = rng.choice([rng.random() * 1e6, 0.1, float("nan"), float("inf"), -float("inf"), -3.5])
        rows.append((rng.choice([0, 0, 1]), text, number, Decimal(rng.randrange(50)) / 4, rng.random() < 0.5, i))
    df = spark.createDataFrame(rows, "k INT, s STRING, f DOUBLE, d DECIMAL(10,2), b BOOLEAN, id INT")
    for name, at in (("s", 1), ("f", 2), ("d", 3), ("b", 4)):
        place = lambda r: (math.inf, 1) if r[at] != r[at] else (r[at], 0)
        key = (lambda r: (*place(r), r[5])) if name == "f" else (lambda r: (r[at], r[5]))
        got = {r.id: r.pos for r in numbered(df, ["k"], [name, "id"]).collect()}
        want = {}
        for k in (0, 1):
            want |= {r[5]: i + 1 for i, r in enumerate(sorted((r for r in rows if r[0] == k), key=key))}
        assert got == want, name


def test_carry_of_a_map_and_of_many_cells(spark):
    """A burst makes narrow cells: their totals are too many for one task as well, and are cut again."""
    rows = [(i, 1_000_000 + i % 40 if i < 400 else i * 5000) for i in range(1200)]
    df = spark.createDataFrame(rows, "id INT, t BIGINT").withColumn("m", F.when(F.col("id") % 3 == 0, F.create_map(F.lit("x"), F.col("id"))))
    spark.conf.set(ROWS_CONF, "15")
    spark.conf.set(CELLS_CONF, "15")
    try:
        layout = measure_cells(df, [], ["t", "id"])
        assert df.select(*layout.cells).distinct().count() > 15
        out = scan(df, [], ["t", "id"], {"n": running_count(), "m_": latest(F.col("m"))}, layout=layout)
        got = {r.id: (r.n, r.m_["x"] if r.m_ else None) for r in out.collect()}
    finally:
        spark.conf.unset(ROWS_CONF)
        spark.conf.unset(CELLS_CONF)
    want, last = {}, None
    for n, (i, _) in enumerate(sorted(rows, key=lambda r: (r[1], r[0])), 1):
        last = i if i % 3 == 0 else last
        want[i] = (n, last)
    assert got == want


def test_scan_over_cells_never_partitions_rows_by_the_key_alone(spark):
    _, df = skewed(spark)
    layout = measure_cells(df, ["k"], ["ts", "id"], 20)
    out = numbered(df, ["k"], ["ts", "id"], layout=layout)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(k" in plan and "__cell0" in plan


def test_global_order_without_a_key(spark, layout):
    rows, df = skewed(spark)
    got = {r.id: r.pos for r in numbered(df, [], ["ts", "id"]).collect()}
    order = sorted(rows, key=lambda r: (r[1], r[2]))
    assert got == {r[2]: i + 1 for i, r in enumerate(order)}


def test_next_row_skips_nulls(spark, layout):
    df = spark.createDataFrame([(1, 1, None), (1, 2, "a"), (1, 3, None), (1, 4, "b")], "k INT, o INT, v STRING")
    got = {r.o: r.nxt for r in next_row(df, ["k"], ["o"], {"nxt": F.col("v")}).collect()}
    assert got == {1: "a", 2: "b", 3: "b", 4: None}


def test_broadcast_only_below_the_bound(spark):
    def hinted(df):
        return "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()

    df = spark.range(100)
    assert hinted(broadcast_if_small(df, 100))
    assert not hinted(broadcast_if_small(df, 99))
    wide = df.withColumn("text", F.repeat(F.lit("x"), 1000))
    assert hinted(broadcast_if_small(wide, 100)) and not hinted(broadcast_if_small(wide, 100, max_bytes=50_000))
