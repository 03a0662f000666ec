"""Rules held as rows: the same matches as testing every rule on every row; many rules in one pass."""

import random

import pytest
from pyspark.sql import functions as F

from sparkstream.operators import rules as ru

DDL = f"rule_id BIGINT, equals {ru.EQUALS}, bounds {ru.BOUNDS}"
FIELDS = ("a", "b", "n")
OPS = {"<": lambda x, y: x < y, "<=": lambda x, y: x <= y, ">": lambda x, y: x > y, ">=": lambda x, y: x >= y, "<>": lambda x, y: x != y}


def brute(rows, rules):
    def number(x):
        try:
            return float(x)
        except (TypeError, ValueError):
            return None

    out = []
    for row in rows:
        have = dict(zip(FIELDS, row[1:]))
        for name, equals, bounds in rules:
            same = all(have[f] is not None and v is not None and str(have[f]) == v for f, v in equals or [])
            if same and all(number(have[f]) is not None and v is not None and o in OPS and OPS[o](number(have[f]), v) for f, o, v in bounds or []):
                out.append((row[0], name))
    return out


@pytest.mark.parametrize("small", [True, False])
def test_against_every_rule_on_every_row(spark, monkeypatch, small):
    if not small:
        monkeypatch.setattr(ru, "broadcast_if_small", lambda df: df)
    rng = random.Random(3)
    rows = [(i, rng.choice(["x", "y", "", None, "7"]), rng.choice([1, 2, None]), rng.choice([None, 0.0, 2.5, -1.0])) for i in range(80)]
    value = {"a": ["x", "y", "", "7", None], "b": ["1", "2"], "n": ["2.5", "0.0"]}
    rules = []
    for i in range(60):
        equals = [(f, rng.choice(value[f])) for f in rng.sample(FIELDS, rng.randint(0, 2))]
        bounds = [(rng.choice(FIELDS), rng.choice([*OPS, "?"]), rng.choice([0.0, 1.0, 2.5, None])) for _ in range(rng.choice([0, 0, 1, 2]))]
        rules.append((i % 50, equals or None, bounds or None))
    rules += [(90, [("a", "x"), ("a", "y")], None), (91, [("a", "x"), ("a", "x")], None), (None, [("b", "1")], None)]
    df = spark.createDataFrame(rows, "id INT, a STRING, b INT, n DOUBLE").withColumn("equals", F.lit("clash"))
    got = ru.match_indexed(df, spark.createDataFrame(rules, DDL), {f: F.col(f) for f in FIELDS})
    assert got.columns == [*df.columns, "rule_id"]
    assert sorted(((r["id"], r["rule_id"]) for r in got.collect()), key=str) == sorted(brute(rows, rules), key=str)


def test_nothing_and_odd_fields(spark):
    df = spark.createDataFrame([(1, "x")], "id INT, a STRING")
    none = spark.createDataFrame([], DDL)
    assert ru.match_indexed(df, none, {"a": F.col("a")}).count() == 0
    some = spark.createDataFrame([(1, [("zz", "x")], None)], DDL)
    with pytest.raises(ValueError):
        ru.match_indexed(df, some, {"a": F.col("a")})
    assert ru.match_indexed(df.limit(0), spark.createDataFrame([(1, [("a", "x")], None)], DDL), {"a": F.col("a")}).count() == 0


def test_a_hundred_thousand_rules_in_one_pass(spark):
    df = spark.range(20_000).select("id", (F.col("id") % 100_000).cast("string").alias("a"))
    rules = spark.range(100_000).select(
        F.col("id").alias("rule_id"),
        F.array(F.struct(F.lit("a").alias("field"), F.col("id").cast("string").alias("value"))).alias("equals"),
        F.lit(None).cast(ru.BOUNDS).alias("bounds"),
    )
    got = ru.match_indexed(df, rules, {"a": F.col("a")})
    assert got.count() == 20_000 and got.where("id <> rule_id").count() == 0
    assert got._jdf.queryExecution().executedPlan().toString().count("Range (0, 20000") <= 2  # once, or plan and final plan
