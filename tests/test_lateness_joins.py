"""Lateness, joins, deadlines and change logs against plain Python."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from sparkstream.functions import scalars as sc
from sparkstream.operators import changelog as cl
from sparkstream.operators import joins as jn
from sparkstream.operators import lateness as lt
from sparkstream.operators.timers import deadline_check
from sparkstream.plans.scan import running_count, running_sum

SEC = 1_000_000


def arrivals(spark, n=150, seed=4):
    rng = random.Random(seed)
    rows = [(i, rng.randrange(3), 1000 * i - 1000 * rng.randrange(20) + 100_000, rng.randrange(100)) for i in range(n)]
    return rows, spark.createDataFrame(rows, "n BIGINT, k INT, ms BIGINT, v INT").withColumn("t", F.timestamp_millis("ms"))


def simulate(rows, size, delay, lateness):
    """Rows one by one in arrival order, as a streaming engine with per-row watermarks would see them."""
    mark, held, fired, late, firings = None, defaultdict(int), set(), [], []
    revision = defaultdict(int)
    for n, k, ms, v in rows:
        start = ms // size * size
        end, w = start + size, (k, start)
        if mark is None or mark < end - 1:
            held[w] += v
        elif mark < end - 1 + lateness:
            held[w] += v
            revision[w] += 1
            firings.append((k, start, revision[w], held[w]))
        else:
            late.append(n)
        new = ms - delay - 1
        mark = new if mark is None else max(mark, new)
        for key in [x for x in held if x not in fired and mark >= x[1] + size - 1]:
            fired.add(key)
            if not revision[key]:
                firings.append((*key, 0, held[key]))
    for key in held:
        if key not in fired:
            firings.append((*key, 0, held[key]))
    return firings, late


def test_allowed_lateness_and_side_output(spark, layout):
    rows, df = arrivals(spark)
    firings, late = lt.tumbling_with_lateness(
        df, ["k"], "t", ["n"], "2 seconds", "2 seconds", "2 seconds", F.col("v")
    )
    want, want_late = simulate(rows, 2000, 2000, 2000)
    got = [(r.k, int(r.window_start.timestamp() * 1000), r.firing, r.total) for r in firings.collect()]
    assert sorted(got) == sorted(want)
    assert sorted(r.n for r in late.collect()) == sorted(want_late)
    counts = lt.firing_counts(firings)
    assert counts["first"] + counts["revision"] == len(want)


def test_watermark_trace(spark, layout):
    rows, df = arrivals(spark, 40)
    got = {r.n: r.watermark for r in lt.watermark_trace(df, "t", ["n"], "3 seconds").collect()}
    top = None
    for n, _, ms, _ in rows:
        assert (None if got[n] is None else round(got[n].timestamp() * 1000)) == (None if top is None else top - 3001)
        top = ms if top is None else max(top, ms)


def two_streams(spark, n=120, seed=8):
    rng = random.Random(seed)
    make = lambda: [(i, rng.choice([0, 0, 1, 2]), rng.randrange(300)) for i in range(n)]
    left, right = make(), make()
    ldf = spark.createDataFrame(left, "l INT, k INT, ls BIGINT").withColumn("lt", F.timestamp_seconds("ls"))
    rdf = spark.createDataFrame(right, "r INT, k INT, rs BIGINT").withColumn("rt", F.timestamp_seconds("rs"))
    return left, right, ldf, rdf


def test_interval_join_bounds_are_inclusive(spark):
    left, right, ldf, rdf = two_streams(spark)
    got = [(r.l, r.r) for r in jn.interval_join(ldf, rdf, ["k"], "lt", "rt", -2 * SEC, SEC).collect()]
    want = [(a, b) for a, k, s in left for b, k2, s2 in right if k == k2 and s - 2 <= s2 <= s + 1]
    assert sorted(got) == sorted(want)
    exact = [(r.l, r.r) for r in jn.interval_join(ldf, rdf, ["k"], "lt", "rt", 0, 0).collect()]
    assert sorted(exact) == sorted((a, b) for a, k, s in left for b, k2, s2 in right if k == k2 and s == s2)


def test_window_join(spark):
    left, right, ldf, rdf = two_streams(spark, seed=15)
    got = [(r.l, r.r) for r in jn.window_join(ldf, rdf, ["k"], "lt", "rt", "6 seconds").collect()]
    assert sorted(got) == sorted((a, b) for a, k, s in left for b, k2, s2 in right if k == k2 and s // 6 == s2 // 6)
    money = spark.createDataFrame([(3, "19.95")], "n INT, price STRING")
    assert str(money.select(sc.line_total("n", "price").alias("total")).first().total) == "59.85"


def test_enrichment(spark, layout):
    events = spark.createDataFrame([(1, "a", 5), (2, "a", 15), (3, "b", 5), (4, "c", 9)], "id INT, u STRING, s BIGINT")
    dim = spark.createDataFrame([("a", "Ann"), ("b", "Bo")], "u STRING, name STRING")
    assert {r.id: r.name for r in jn.enrich(events, dim, ["u"]).collect()} == {1: "Ann", 2: "Ann", 3: "Bo"}
    assert jn.enrich(events, dim, ["u"], "left").count() == 4
    versions = spark.createDataFrame([("a", 0, 30), ("a", 10, 31), ("b", 5, 40)], "u STRING, vs BIGINT, age INT")
    timed = events.withColumn("t", F.timestamp_seconds("s"))
    versions = versions.withColumn("vt", F.timestamp_seconds("vs")).drop("vs")
    got = jn.enrich_as_of(timed, versions, ["u"], "t", "vt", ["id"]).collect()
    assert {r.id: r.age for r in got} == {1: 30, 2: 31, 3: 40}
    twice = versions.unionByName(spark.createDataFrame([("b", 39)], "u STRING, age INT").withColumn("vt", F.timestamp_seconds(F.lit(5))))
    assert {r.id: r.age for r in jn.enrich_as_of(timed, twice, ["u"], "t", "vt", ["id"]).collect()} == {1: 30, 2: 31, 3: 40}
    kept = jn.enrich_as_of(timed, versions, ["u"], "t", "vt", ["id"], how="left").collect()
    assert {r.id: r.age for r in kept} == {1: 30, 2: 31, 3: 40, 4: None}


def test_deadlines(spark, layout):
    left, right, ldf, rdf = two_streams(spark)
    got = deadline_check(ldf, rdf, ["k"], "lt", "rt", 5 * SEC, ["l"]).collect()
    want = {}
    for a, k, s in left:
        answers = [s2 for _, k2, s2 in right if k2 == k and s <= s2 <= s + 5]
        want[a] = ("reviewed", min(answers)) if answers else ("auto", s + 5)
    assert {r.l: (r.status, int(r.decided_at.timestamp())) for r in got} == want


def test_changelog_of_a_sum(spark, layout):
    rng = random.Random(27)
    rows = [(i, rng.choice("gh"), rng.randint(1, 5)) for i in range(24)]
    df = spark.createDataFrame(rows, "n INT, word STRING, f INT")
    log = cl.to_changelog(df, ["word"], ["n"], {"total": running_sum(F.col("f"))})
    want, sums = [], {}
    for n, word, f in rows:
        if word in sums:
            want.append((n, False, word, sums[word]))
        sums[word] = sums.get(word, 0) + f
        want.append((n, True, word, sums[word]))
    assert sorted((r.n, r.is_add, r.word, r.total) for r in log.collect()) == sorted(want)
    assert {r.word: r.total for r in cl.replay(log, ["word", "total"]).collect()} == sums


def test_changelog_with_having_and_unchanged_rows(spark, layout):
    df = spark.createDataFrame([(i, "a", 1) for i in range(4)], "n INT, word STRING, f INT")
    log = cl.to_changelog(df, ["word"], ["n"], {"c": running_count()}, F.col("c").between(2, 3))
    assert [(r.is_add, r.c) for r in log.orderBy("n", "is_add").collect()] == [(True, 2), (False, 2), (True, 3), (False, 3)]
    zero = df.withColumn("f", F.lit(0))
    flat = cl.to_changelog(zero, ["word"], ["n"], {"total": running_sum(F.col("f"))})
    assert flat.count() == 1


def test_guard(spark):
    df = spark.createDataFrame([("ok",), ("bug",), (None,)], "line STRING")
    good, bad = sc.guard(df, F.col("line") == "bug", on="quarantine")
    assert good.count() == 2 and bad.count() == 1
    with pytest.raises(Exception, match="bad record"):
        sc.guard(df, F.col("line") == "bug").collect()
    assert sc.guard(good, F.col("line") == "bug").count() == 2
