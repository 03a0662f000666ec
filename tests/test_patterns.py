"""Pattern matching against plain searches, with whole keys and with keys cut into cells."""

import random
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from sparkstream.operators import rules as rl
from sparkstream.operators.patterns import Pattern, match

BASE = 1_700_000_000_000
SEC = 1_000_000


def timed(spark, rows, ddl):
    return spark.createDataFrame(rows, ddl).withColumn("t", F.timestamp_millis("ms"))


def seeded(spark, seed, kinds="pqrs", n=140, keys=3, step=4):
    """(number, key, kind, second, level) in time order, as rows and as a DataFrame."""
    rng = random.Random(seed)
    rows, now = [], 0
    for i in range(n):
        now += rng.randrange(step)
        rows.append((i, rng.randrange(keys), rng.choice(kinds), now, rng.randrange(10)))
    df = timed(spark, [(i, k, v, BASE + s * 1000, x) for i, k, v, s, x in rows], "n INT, k INT, v STRING, ms BIGINT, x INT")
    return rows, df


def per_key(rows):
    out = {}
    for row in rows:
        out.setdefault(row[1], []).append(row)
    return list(out.values())


def is_(kind):
    return F.col("v") == kind


def test_next_within(spark, layout):
    rows, df = seeded(spark, 21)
    found = match(df, Pattern.begin("a", is_("p")).next("b", is_("p")).within(5 * SEC), ["k"], ["t", "n"]).rows
    got = sorted((r.a_first.n, r.b_first.n) for r in found.collect())
    want = sorted(
        (a[0], b[0]) for seq in per_key(rows) for a, b in zip(seq, seq[1:]) if a[2] == b[2] == "p" and b[3] - a[3] < 5
    )
    assert got == want and want


def test_followed_by_and_timeouts(spark, layout):
    rows, df = seeded(spark, 22)
    found = match(df, Pattern.begin("a", is_("p")).followed_by("b", is_("q")).within(12 * SEC), ["k"], ["t", "n"])
    done, late = [], []
    for seq in per_key(rows):
        for i, a in enumerate(seq):
            if a[2] == "p":
                b = next((b for b in seq[i + 1 :] if b[2] == "q"), None)
                if b and b[3] - a[3] < 12:
                    done.append((a[0], b[0]))
                else:
                    late.append(a[0])
    assert sorted((r.a_first.n, r.b_first.n) for r in found.rows.collect()) == sorted(done) and done
    assert sorted(r.a_first.n for r in found.timeouts.collect()) == sorted(late) and late


def runs_of(rows, accepts, span, sizes=None, stop=None, strict=False):
    """(first, last, count) of all stretches of accepted rows of a key, among which no row that ends a run lies."""
    out = []
    for seq in per_key(rows):
        for i, a in enumerate(seq):
            if not accepts(a) or (stop and stop(a)):
                continue
            count = 0
            for b in seq[i:]:
                if (stop and stop(b)) or (strict and not accepts(b)) or b[3] - a[3] >= span:
                    break
                if accepts(b):
                    count += 1
                    if sizes is None or count in sizes:
                        out.append((a[0], b[0], count))
    return sorted(out)


def test_one_or_more_times_and_until(spark, layout):
    rows, df = seeded(spark, 23)
    accepts, high = (lambda r: r[2] == "p"), (lambda r: r[4] > 7)
    base = Pattern.begin("a", is_("p"))
    cases = [
        (base.one_or_more().within(20 * SEC), runs_of(rows, accepts, 20)),
        (base.times(3, 4).within(40 * SEC), runs_of(rows, accepts, 40, {3, 4})),
        (base.one_or_more().until(F.col("x") > 7).within(60 * SEC), runs_of(rows, accepts, 60, None, high)),
        (base.one_or_more().consecutive().within(30 * SEC), runs_of(rows, accepts, 30, None, None, True)),
    ]
    for pattern, want in cases:
        found = match(df, pattern, ["k"], ["t", "n"], keep=["x"])
        assert sorted((r.a_first.n, r.a_last.n, r.a_n) for r in found.rows.collect()) == want and want
    assert found.members().count() == sum(c for *_, c in want)


def test_run_between_two_events(spark, layout):
    rows, df = seeded(spark, 24, keys=2)
    p = (
        Pattern.begin("a", is_("p")).followed_by("m", is_("q")).one_or_more().consecutive()
        .followed_by("b", is_("r")).within(40 * SEC)
    )
    got = sorted((r.a_first.n, r.m_first.n, r.m_last.n, r.b_first.n) for r in match(df, p, ["k"], ["t", "n"]).rows.collect())
    want = []
    for seq in per_key(rows):
        for i, a in enumerate(seq):
            start = next((j for j in range(i + 1, len(seq)) if seq[j][2] == "q"), None) if a[2] == "p" else None
            if start is None:
                continue
            for last in range(start, len(seq)):
                if seq[last][2] != "q":
                    break
                end = next((b for b in seq[last + 1 :] if b[2] == "r"), None)
                if end and end[3] - a[3] < 40:
                    want.append((a[0], seq[start][0], seq[last][0], end[0]))
    assert got == sorted(want) and want


def test_payload_without_an_order(spark, layout):
    """A map can ride along with the rows, though maps have no order."""
    rows, df = seeded(spark, 25)
    tagged = df.withColumn("tags", F.create_map(F.lit("level"), F.col("x")))
    found = match(tagged, Pattern.begin("a", is_("p")).followed_by("b", is_("q")).within(30 * SEC), ["k"], ["t", "n"], keep=["tags"])
    level = {r[0]: r[4] for r in rows}
    got = found.rows.collect()
    assert got and all(r.a_first.tags["level"] == level[r.a_first.n] and r.b_first.tags["level"] == level[r.b_first.n] for r in got)


def test_combinations_against_brute_force(spark, layout):
    rng = random.Random(3)
    rows = sorted({(rng.randrange(60), rng.choice("ab")) for _ in range(40)})
    rows = [(i, 1, s, k) for i, (s, k) in enumerate(rows)]
    df = timed(spark, [(i, u, k, BASE + s * 1000) for i, u, s, k in rows], "n INT, id INT, v STRING, ms BIGINT")
    p = Pattern.begin("a", F.col("v") == "a").times(2, 3).allow_combinations().within(10 * SEC)
    found = match(df, p, ["id"], ["t", "n"])
    pool = [(s, i) for i, _, s, k in rows if k == "a"]
    want = sorted(
        tuple(x[1] for x in c) for size in (2, 3) for c in combinations(pool, size) if c[-1][0] - c[0][0] < 10
    )
    got = (
        found.members().groupBy("match_id").agg(F.array_sort(F.collect_list("ev.n")).alias("ns")).collect()
    )
    assert sorted(tuple(r.ns) for r in got) == want
    assert found.rows.count() == len(want)


def test_long_chain_against_brute_force(spark, layout):
    rng = random.Random(5)
    rows = [(i, rng.randrange(3), rng.choice("abc"), rng.randrange(5)) for i in range(120)]
    df = spark.createDataFrame(
        [(i, u, v, BASE + (i * 5 + s) * 1000) for i, u, v, s in rows], "n INT, id INT, v STRING, ms BIGINT"
    ).withColumn("t", F.timestamp_millis("ms"))
    p = Pattern.begin("a", is_("a")).followed_by("b", is_("b")).next("c", is_("c")).followed_by("d", is_("a")).within(200 * SEC)
    found = match(df, p, ["id"], ["t", "n"])
    got = sorted((r.a_first.n, r.b_first.n, r.c_first.n, r.d_first.n) for r in found.rows.collect())
    want, timed_out = [], 0
    for u in range(3):
        seq = [(i * 5 + s, i, v) for i, uu, v, s in rows if uu == u]
        for x, (t0, i0, v0) in enumerate(seq):
            if v0 != "a":
                continue
            at, path, state = x, [i0], "go"
            for v, strict in (("b", False), ("c", True), ("a", False)):
                later = [y for y in range(at + 1, len(seq)) if strict or seq[y][2] == v]
                if not later or seq[later[0]][0] - t0 >= 200:
                    state = "timeout"
                    break
                if seq[later[0]][2] != v:
                    state = "gone"
                    break
                at = later[0]
                path.append(seq[at][1])
            if state == "go":
                want.append(tuple(path))
            timed_out += state == "timeout"
    assert got == sorted(want)
    assert found.timeouts.count() == timed_out


def test_unbounded_repetition_is_refused(spark):
    df = seeded(spark, 26, n=5)[1]
    base = Pattern.begin("a", is_("p"))
    for pattern in (base.one_or_more(), base.one_or_more().until(F.col("x") > 5), base.one_or_more().consecutive()):
        with pytest.raises(ValueError):
            match(df, pattern, ["k"], ["t", "n"])
    with pytest.raises(ValueError):
        base.times(2, 7).allow_combinations().within(SEC).check()
    base.times(2, 7).allow_combinations(limit=7).within(SEC).check()


def test_rules_as_data(spark, monkeypatch):
    rng = random.Random(31)
    rows = [({"zone": rng.choice("uvw")} if rng.random() < 0.9 else {}, {"heat": float(rng.randrange(6))}) for _ in range(60)]
    df = spark.createDataFrame(rows, "tags MAP<STRING, STRING>, fields MAP<STRING, DOUBLE>")
    wanted = [(i, z, h) for i, (z, h) in enumerate((z, h) for z in "uvw" for h in range(6))]
    texts = [(i, f"try_element_at(tags, 'zone') = '{z}' AND try_element_at(fields, 'heat') = {h}") for i, z, h in wanted]
    rules = spark.createDataFrame(texts, "rule_id INT, predicate STRING")
    want = Counter(i for i, z, h in wanted for tags, fields in rows if tags.get("zone") == z and fields["heat"] == h)
    for per_pass in (2_000, 4):
        monkeypatch.setattr(rl, "RULES_PER_PASS", per_pass)
        assert {r.rule_id: r["count"] for r in rl.match_rules(df, rules).groupBy("rule_id").count().collect()} == want
    assert rl.match_rules(df, rules.limit(0)).count() == 0


def test_rules_that_reach_outside_are_refused(spark):
    call = 'java_method("java.lang.System", "getProperty", "user.name")'
    refused = [
        "java_method('x', 'y') = 1",
        f"'\\'' = '' OR {call} = {call} AND '' = ''",
        "k = 'a\\\\' OR x = 'b'",
        'k = "v"',
        "k = `v`",
        "k = 'open",
        "k = 'a' -- rest",
        "k = 'a' /* rest */",
        "k = r'a\\'",
        "x'41' = k",
        "k = (SELECT 1)",
        None,
    ]
    for predicate in refused:
        with pytest.raises(ValueError):
            rl.check_rule(predicate, ["k", "v"])
    rl.check_rule("k = 'it''s' AND v IN ('a; b', 'c')".replace(";", ","), ["k", "v"])
