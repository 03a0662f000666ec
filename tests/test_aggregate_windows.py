"""Aggregates and windows on small inputs with known answers."""

import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from sparkstream.functions import scalars as sc
from sparkstream.functions import text as tx
from sparkstream.operators import aggregate as ag
from sparkstream.operators import routing as rt
from sparkstream.operators import windows as wn
from sparkstream.sources.basic import sequence



def keyed(spark, seed=17, n=60):
    """(number, key, value) with a third of the rows on one key."""
    rng = random.Random(seed)
    rows = [(i, rng.choice("xxyz"), rng.randrange(100)) for i in range(n)]
    return rows, spark.createDataFrame(rows, "n INT, k STRING, v BIGINT")


def test_word_count(spark):
    rng = random.Random(14)
    lines = [" ".join(rng.choice(["tea", "oak", "sun"]) for _ in range(rng.randint(1, 6))) for _ in range(30)]
    df = spark.createDataFrame([(x,) for x in lines], "line STRING")
    counts = ag.keyed_sum(tx.split_pairs(df, "line"), ["word"], F.col("cnt"), "cnt")
    assert {r.word: r.cnt for r in counts.collect()} == Counter(w for x in lines for w in x.split(" "))


def test_token_edges(spark):
    df = spark.createDataFrame([(0, "a b  "), (1, "a  b"), (2, ""), (3, "   "), (4, None)], "id INT, line STRING")
    got = defaultdict(list)
    for r in tx.tokenize(df, "line").collect():
        got[r.id].append(r.word)
    assert got == {0: ["a", "b"], 1: ["a", "", "b"], 2: [""]}


def test_exclude_keeps_null_and_takes_a_table(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "w STRING")
    assert sorted(str(r.w) for r in tx.exclude(df, "w", ["a"]).collect()) == ["None", "b"]
    banned = spark.createDataFrame([("a",)], "x STRING")
    assert sorted(str(r.w) for r in tx.exclude(df, "w", banned).collect()) == ["None", "b"]


def test_text_filters(spark):
    df = spark.createDataFrame([("warm rain",), ("grey fog",), ("hail 42 mm",)], "m STRING")
    assert tx.keep_containing(df, "m", "rain").count() == 1
    assert tx.has_match(df, "m", r"\d+").first().m == "hail 42 mm"
    assert tx.has_prefix(df, "m", "g").first().m == "grey fog"
    assert spark.range(5, 6).select(tx.binary_text("id").alias("b")).first().b == "101"


def test_max_and_whole_row_of_the_max(spark):
    rows, df = keyed(spark)
    assert {r.k: r["max"] for r in ag.keyed_max(df, ["k"], "v").collect()} == {k: max(v for _, x, v in rows if x == k) for k in "xyz"}
    tied = spark.createDataFrame([(2, "k", 5), (1, "k", 5), (3, "k", None), (4, "j", None)], "n INT, k STRING, v BIGINT")
    best = {r.k: r.n for r in ag.keyed_max_by(tied, ["k"], "v", ["n"]).collect()}
    assert best == {"k": 1, "j": 4}


def test_running_max_and_sum(spark, layout):
    rows, df = keyed(spark)
    tops = ag.running_max(df, ["k"], F.col("v"), ["n"]).collect()
    sums = ag.running_sum(df, ["k"], F.col("v"), ["n"]).collect()
    before = lambda r: [v for n, k, v in rows if k == r.k and n <= r.n]
    assert all(r["max"] == max(before(r)) for r in tops) and all(r.total == sum(before(r)) for r in sums)
    assert len(tops) == len(sums) == len(rows)


def test_tree_reduce_keeps_order(spark, layout):
    df = spark.createDataFrame([(i % 3, i, str(i % 10)) for i in range(200)], "k INT, n INT, v STRING")
    got = ag.keyed_reduce(df, ["k"], "v", lambda a, b: F.concat(a, b), ["n"], "s", block=4).collect()
    assert {r.k: r.s for r in got} == {k: "".join(str(i % 10) for i in range(k, 200, 3)) for k in range(3)}


def test_xor_finds_the_missing_value(spark):
    whole, gone = list(range(20, 51)), 33
    df = spark.createDataFrame(list(zip(whole, [*(x for x in whole if x != gone), 0])), "a INT, b INT")
    assert ag.xor_diff(df, "a", "b").first().missing == gone


def test_sequence_filter_and_rebalance(spark):
    kept = sc.greater_than(sequence(spark, 0, 100), "value", 10)
    assert kept.count() == 90
    counts = [r.n for r in rt.partition_counts(rt.rebalance(kept.coalesce(1), 4)).collect()]
    assert sum(counts) == 90 and len(counts) == 4 and max(counts) - min(counts) <= 1


def test_split_is_a_partition_of_the_input(spark):
    parts = rt.split_by(sequence(spark, 1, 10), {"even": sc.is_even("value")}, rest="odd")
    assert sorted(r.value for r in parts["even"].collect()) == [2, 4, 6, 8, 10]
    assert sorted(r.value for r in parts["odd"].collect()) == [1, 3, 5, 7, 9]
    nulls = spark.createDataFrame([(None,), (1,)], "value INT")
    assert sum(d.count() for d in rt.split_by(nulls, {"even": sc.is_even("value")}).values()) == 2


def test_union_and_connect(spark):
    words = spark.createDataFrame([("fir",), ("elm",)], "w STRING")
    assert rt.union(words, words).count() == 4
    mixed = rt.connect_map(words, sequence(spark, 7, 9), F.upper("w"), (F.col("value") * 2).cast("string"))
    assert sorted(r.value for r in mixed.collect()) == ["14", "16", "18", "ELM", "FIR"]


def test_placement(spark):
    df = spark.range(90)
    assert rt.replicate(df, 3).groupBy("copy", F.spark_partition_id()).count().count() == 3
    assert rt.shuffle(df, 4).rdd.getNumPartitions() == 4
    assert rt.rescale(df.repartition(6), 2).rdd.getNumPartitions() == 2
    assert rt.to_one(df).rdd.getNumPartitions() == 1
    rule = rt.heavy_rule("k", F.col("k") == 0, 5, 8, F.col("id"))
    cities_ = df.select("id", F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id")).alias("k"))
    placed = rt.route(cities_, rule, 8).select("k", F.spark_partition_id().alias("p")).collect()
    assert {r.p for r in placed if r.k == 0} == set(range(5))
    assert {r.p for r in placed if r.k != 0} <= {5, 6, 7}


def timed(spark, rows, ddl):
    return spark.createDataFrame(rows, ddl).withColumn("t", F.timestamp_seconds("s"))


def test_tumbling_against_plain_python(spark):
    rng = random.Random(41)
    rows = [(rng.randrange(4), rng.randrange(50), rng.randrange(60)) for _ in range(90)]
    df = timed(spark, rows, "k INT, c INT, s BIGINT")
    got = wn.tumbling(df, ["k"], "t", "7 seconds", {"total": F.sum("c")}).collect()
    want = Counter()
    for k, c, s in rows:
        want[k, s // 7 * 7] += c
    at = lambda r: int(r.window_start.timestamp())
    first = min(map(at, got))
    shift = (first - 0) % 7  # windows are counted from the epoch, which 7 seconds divide from 0 on
    assert shift == 0 and {(r.k, at(r)): r.total for r in got} == want


def test_sliding_covers_each_row_twice(spark):
    df = timed(spark, [(1, 10, 7), (1, 1, 12)], "k INT, c INT, s BIGINT")
    got = wn.sliding(df, ["k"], "t", "10 seconds", "5 seconds", {"total": F.sum("c")}).collect()
    assert sorted((int(r.window_start.timestamp()), r.total) for r in got) == [(0, 10), (5, 11), (10, 1)]


def test_panes_give_the_same_windows(spark):
    rng = random.Random(5)
    rows = [(rng.randrange(3), rng.choice([None, *range(9)]), rng.randrange(500)) for _ in range(300)]
    df = timed(spark, rows, "k INT, c INT, s BIGINT").withColumn("t", F.when(F.col("s") % 17 > 0, F.col("t")))
    plain = {"total": F.sum("c"), "top": F.max("c"), "low": F.min("c"), "n": F.count("c")}
    made = {name: ag.Agg(kind, F.col("c")) for name, kind in zip(plain, ("sum", "max", "min", "count"))}
    for size, slide in (("60 seconds", "1 second"), ("10 seconds", "4 seconds"), ("7 seconds", "7 seconds")):
        one, two = (wn.sliding(df, ["k"], "t", size, slide, aggs) for aggs in (plain, made))
        assert one.columns == two.columns and sorted(map(str, one.collect())) == sorted(map(str, two.collect()))


def test_blocks_give_the_same_windows(spark, layout):
    rng = random.Random(6)
    rows = [(i, rng.choice(["x", "x", "y", None]), rng.choice([None, *range(50)])) for i in range(90)]
    df = spark.createDataFrame(rows, "n INT, k STRING, v INT")
    plain = {"total": F.sum("v"), "top": F.max("v"), "low": F.min("v"), "c": F.count("v")}
    made = {name: ag.Agg(kind, F.col("v")) for name, kind in zip(plain, ("sum", "max", "min", "count"))}
    for size, slide in ((5, 5), (5, 3), (2, 3), (4, 1), (1, 1), (40, 7)):
        one, two = (wn.count_sliding(df, ["k"], ["n"], size, slide, aggs) for aggs in (plain, made))
        assert sorted(map(str, one.collect())) == sorted(map(str, two.select(one.columns).collect()))
    assert "Generate" not in wn.count_sliding(df, ["k"], ["n"], 40, 1, made)._jdf.queryExecution().toString()


def test_session_touching_rows_share_a_window(spark, layout):
    df = timed(spark, [(1, 0), (1, 10), (1, 21)], "k INT, s BIGINT")
    got = wn.session(df, ["k"], "t", "10 seconds", {"n": ag.Agg("count", F.col("k"))}).collect()
    spans = sorted((int(r.window_start.timestamp()), int(r.window_end.timestamp()), r.n) for r in got)
    assert spans == [(0, 20, 2), (21, 31, 1)]


def test_sessions_across_cells_against_plain_python(spark, layout):
    rng = random.Random(9)
    rows = [(rng.choice([0, 0, 1, 2]), rng.randrange(3000), rng.randrange(9)) for _ in range(400)]
    df = timed(spark, rows, "k INT, s BIGINT, v INT")
    aggs = {"n": ag.Agg("count", F.col("v")), "total": ag.Agg("sum", F.col("v")), "top": ag.Agg("max", F.col("v"))}
    got = sorted(
        (r.k, int(r.window_start.timestamp()), int(r.window_end.timestamp()), r.n, r.total, r.top)
        for r in wn.session(df, ["k"], "t", "7 seconds", aggs).collect()
    )
    want = []
    for k in {r[0] for r in rows}:
        seq, run = sorted((s, v) for kk, s, v in rows if kk == k), []
        for s, v in [*seq, (10**9, 0)]:
            if run and s - run[-1][0] > 7:
                vs = [x[1] for x in run]
                want.append((k, run[0][0], run[-1][0] + 7, len(run), sum(vs), max(vs)))
                run = []
            run.append((s, v))
    assert got == sorted(want)


def test_count_windows(spark, layout):
    rows, df = keyed(spark, 19)
    for size, slide in ((5, 5), (5, 3), (2, 3), (4, 1)):
        want = {}
        for k in "xyz":
            values = [v for _, x, v in rows if x == k]
            for w in range(1, len(values) // slide + 1):
                want[k, w] = sum(values[max(0, w * slide - size) : w * slide])
        fired = wn.count_sliding(df, ["k"], ["n"], size, slide, {"total": F.sum("v")}).collect()
        assert {(r.k, r.window_no): r.total for r in fired} == want
    whole = wn.count_tumbling(df, ["k"], ["n"], 4, {"total": F.sum("v")}).collect()
    want = {}
    for k in "xyz":
        values = [v for _, x, v in rows if x == k]
        want |= {(k, w): sum(values[w * 4 : w * 4 + 4]) for w in range(len(values) // 4)}
    assert {(r.k, r.window_no): r.total for r in whole} == want


def test_local_day_and_running_dashboard(spark):
    at = 1_558_430_842  # 2019-05-21 09:27:22 UTC
    df = timed(spark, [("a", 10, at), ("b", 5, at + 1), ("a", 1, at + 3), ("a", 7, at + 30_000)], "c STRING, v INT, s BIGINT")
    day = df.select(sc.local_day("t", 8).start.alias("d")).first().d
    assert day.isoformat() == "2019-05-20T16:00:00"
    ticks = wn.cumulative_ticks(df.where(F.col("s") < at + 10), ["c"], "t", F.col("v"), "1 second", 8)
    got = sorted((r.c, int(r.tick_end.timestamp()) - at, r.total) for r in ticks.collect())
    assert got == [("a", 1, 10), ("a", 2, 10), ("a", 3, 10), ("a", 4, 11), ("b", 2, 5), ("b", 3, 5), ("b", 4, 5)]
    top = wn.top_n_per(ticks, ["tick_end"], "total", ["c"], 1).orderBy("tick_end").collect()
    assert [r.c for r in top] == ["a"] * 4
    whole = wn.cumulative_ticks(df, ["c"], "t", F.col("v"), "1 hour", 8)
    assert whole.where("c = 'a'").agg(F.max("total")).first()[0] == 11  # the last row is on the next local day


def test_money_and_lookup(spark):
    df = spark.createDataFrame([("1.005",), ("2.675",)], "m STRING")
    got = df.select(sc.money_round(F.col("m").cast("decimal(10,3)")).alias("r")).collect()
    assert [str(r.r) for r in got] == ["1.01", "2.68"]
    near = spark.createDataFrame([(0.0049999999,), (0.005,), (-0.0149999,)], "m DOUBLE")
    assert [str(r[0]) for r in near.select(sc.money_round(F.col("m"))).collect()] == ["0.00", "0.01", "-0.01"]
    tags = spark.createDataFrame([({"a": "x"},)], "tags MAP<STRING, STRING>")
    assert tags.select(sc.lookup("tags", "a").alias("a"), sc.lookup("tags", "b").alias("b")).first() == ("x", None)


def test_max_by_of_any_type(spark):
    rows = [
        (1, 1.5, "b", "2024-01-02", 2.0, True), (1, float("nan"), "ab", "2024-03-01", 1.0, False), (1, None, "abc", None, 3.0, True),
        (1, float("nan"), "é", "2024-03-01", float("nan"), True), (2, None, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, "k INT, d DOUBLE, s STRING, t STRING, e DOUBLE, f BOOLEAN").withColumns(
        {"day": F.to_date("t"), "at": F.to_timestamp("t"), "local": F.to_timestamp("t").cast("timestamp_ntz"), "money": F.col("e").cast("string")}
    )
    best = lambda value, *order: {r.k: r.s for r in ag.keyed_max_by(df, ["k"], value, order).collect()}
    assert best("d", "s") == {1: "ab", 2: None}  # NaN is the maximum, of equals the least text
    assert best("s", "d")[1] == "é" and best("day", "e")[1] == "ab"  # NaN comes last as an order
    assert best("at", "f")[1] == "ab" and best("local", "local", "s")[1] == "ab" and best("t", "at", "day", "money")[1] == "ab"
    same_value = df.withColumn("one", F.lit(1))
    least = {r.k: r.s for r in ag.keyed_max_by(same_value, ["k"], "one", ["s"]).collect()}
    assert least == {1: "ab", 2: None}
