"""Streams fed file by file give what the batch operators give; restarts neither lose nor repeat rows."""

import os
import random
import time

import pytest
from pyspark.sql import functions as F

from sparkstream.operators import aggregate as ag
from sparkstream.operators import joins as jn
from sparkstream.operators import windows as wn
from sparkstream.operators.changelog import to_changelog
from sparkstream.operators.lateness import tumbling_with_lateness, with_arrival_time, with_event_time
from sparkstream.operators.patterns import Pattern, match
from sparkstream.plans.cells import ROWS_CONF
from sparkstream.plans.scan import running_count, running_max, running_sum
from sparkstream.sources.basic import stream_lines
from sparkstream.sources.changes import read_changes
from sparkstream.sources.polled import polled, ticks
from sparkstream.sources.topics import read_topic_files
from sparkstream.streaming import batches as bt
from sparkstream.streaming import sinks as sk
from sparkstream.streaming import stateful as st
from sparkstream.streaming import store
from sparkstream.streaming.runner import drain, run_stream, write_every

DDL = "n BIGINT, k INT, kind STRING, v BIGINT, t TIMESTAMP"
SEC = 1_000_000


@pytest.fixture(scope="module")
def feed(spark, tmp_path_factory):
    """240 events in time order, written as six files one after the other, with one far-future row last."""
    folder = str(tmp_path_factory.mktemp("feed") / "events")
    rng = random.Random(11)
    rows = [(i, rng.choice([0, 0, 1, 2]), rng.choice("abc"), rng.randrange(50), i * 3 + rng.randrange(3)) for i in range(240)]
    df = spark.createDataFrame(rows, "n BIGINT, k INT, kind STRING, v BIGINT, s BIGINT").withColumn("t", F.timestamp_seconds("s")).drop("s")
    for part in range(6):
        df.where(F.col("n").between(part * 40, part * 40 + 39)).coalesce(1).write.mode("append").parquet(folder)
    return df, folder


def stream(spark, feed, per_batch=1):
    return spark.readStream.schema(DDL).option("maxFilesPerTrigger", per_batch).parquet(feed[1])


def run(df, tmp_path, name, mode="append"):
    drain(sk.exactly_once(df, f"{tmp_path}/{name}", mode), f"{tmp_path}/{name}-ckpt")
    return sk.read_batches(df.sparkSession, f"{tmp_path}/{name}").drop(sk.BATCH)


def same(left, right):
    cols = sorted(left.columns)
    assert sorted(cols) == sorted(right.columns)
    assert sorted(map(tuple, left.select(cols).collect())) == sorted(map(tuple, right.select(cols).collect()))


def test_windows_closed_by_the_watermark(spark, feed, tmp_path):
    aggs = {"total": F.sum("v")}
    got = run(wn.tumbling(stream(spark, feed), ["k"], "t", "20 seconds", aggs, delay="5 seconds"), tmp_path, "w")
    last = feed[0].agg(F.max("t")).first()[0]
    want = wn.tumbling(feed[0], ["k"], "t", "20 seconds", aggs)
    same(got, want.where(F.col("window_end") <= F.lit(last) - F.expr("INTERVAL 5 SECONDS")))


def test_sliding_and_sessions_in_complete_mode(spark, feed, tmp_path):
    aggs = {"total": F.sum("v")}
    sliding = wn.sliding(stream(spark, feed, 6), ["k"], "t", "20 seconds", "10 seconds", aggs)
    same(run(sliding, tmp_path, "s", "complete"), wn.sliding(feed[0], ["k"], "t", "20 seconds", "10 seconds", aggs))
    merged = {"n": ag.Agg("count", F.col("v"))}
    sessions = wn.session(stream(spark, feed, 6), ["k"], "t", "6 seconds", merged)
    same(run(sessions, tmp_path, "g", "complete"), wn.session(feed[0], ["k"], "t", "6 seconds", merged))


def halves(df):
    left = df.where("kind = 'a'").select("k", F.col("n").alias("a"), F.col("t").alias("at"))
    right = df.where("kind = 'b'").select("k", F.col("n").alias("b"), F.col("t").alias("bt"))
    return left, right


def test_stream_joins(spark, feed, tmp_path):
    left, right = halves(stream(spark, feed))
    bl, br = halves(feed[0])
    got = jn.interval_join_stream(left, right, ["k"], "at", "bt", "'-4' SECONDS", "'2' SECONDS", "10 seconds")
    same(run(got.select("k", "a", "b"), tmp_path, "i"), jn.interval_join(bl, br, ["k"], "at", "bt", -4 * SEC, 2 * SEC).select("k", "a", "b"))
    windowed = jn.window_join(left, right, ["k"], "at", "bt", "15 seconds", delay="10 seconds").select("k", "a", "b")
    same(run(windowed, tmp_path, "w"), jn.window_join(bl, br, ["k"], "at", "bt", "15 seconds").select("k", "a", "b"))


@pytest.fixture(params=["whole", "cells"])
def small_folds(request, spark, monkeypatch):
    """Few buckets and early merges of stored runs, with and without keys cut into cells."""
    monkeypatch.setattr(sk, "FOLD_EVERY", 2)
    monkeypatch.setattr(store, "FAN", 2)
    monkeypatch.setattr(store, "BUCKETS", 3)
    if request.param == "cells":
        spark.conf.set(ROWS_CONF, "10")
    yield
    spark.conf.unset(ROWS_CONF)


def test_count_windows_over_micro_batches(spark, feed, tmp_path, small_folds):
    aggs = {"total": ag.Agg("sum", F.col("v")), "top": ag.Agg("max", F.col("v"))}
    writer = bt.count_tumbling_batches(stream(spark, feed), ["k"], ["t", "n"], 7, aggs, f"{tmp_path}/o", f"{tmp_path}/s")
    drain(writer, f"{tmp_path}/ckpt")
    want = wn.count_tumbling(feed[0], ["k"], ["t", "n"], 7, {"total": F.sum("v"), "top": F.max("v")})
    same(sk.read_batches(spark, f"{tmp_path}/o").drop(sk.BATCH), want)


def test_changelog_over_micro_batches(spark, feed, tmp_path, small_folds):
    outs = {"c": running_count(), "total": running_sum(F.col("v"))}
    rows = stream(spark, feed, 2).select("k", "t", "n", "v")
    drain(bt.changelog_batches(rows, ["k"], ["t", "n"], outs, f"{tmp_path}/o", f"{tmp_path}/s"), f"{tmp_path}/ckpt")
    same(sk.read_batches(spark, f"{tmp_path}/o").drop(sk.BATCH), to_changelog(feed[0], ["k"], ["t", "n"], outs))


def test_scan_over_micro_batches(spark, feed, tmp_path, small_folds):
    outs = {"c": running_count(), "total": running_sum(F.col("v")), "top": running_max(F.col("v"))}
    writer = bt.scan_stream(stream(spark, feed, 2).select("k", "t", "n", "v"), ["k"], ["t", "n"], outs, f"{tmp_path}/o", f"{tmp_path}/s")
    drain(writer, f"{tmp_path}/ckpt")
    want = ag.scan(feed[0].select("k", "t", "n", "v"), ["k"], ["t", "n"], outs)
    same(sk.read_batches(spark, f"{tmp_path}/o").drop(sk.BATCH), want)


def item_streams(df):
    opens = df.where(F.col("n") % 2 == 0).select(F.floor(F.col("n") / 2).alias("item"), F.col("t").alias("o"))
    closes = df.where(F.col("n") % 2 == 1).select(F.floor(F.col("n") / 2).alias("item"), F.col("t").alias("c"))
    return opens, closes


def test_deadlines_as_an_outer_join(spark, feed, tmp_path):
    got = run(st.deadline_stream(*item_streams(stream(spark, feed, 3)), ["item"], "o", "c", 3000, "0 seconds"), tmp_path, "j")
    opens, closes = item_streams(feed[0])
    answers = {r.item: r.c for r in closes.collect()}
    want = {r.item: "auto" if (answers[r.item] - r.o).total_seconds() > 3 else "reviewed" for r in opens.collect()}
    rows = {r.item: r.status for r in got.collect()}
    assert len(rows) >= len(want) - 2 and all(want[i] == s for i, s in rows.items())


def is_(kind):
    return F.col("kind") == kind


PATTERNS = {
    "pair": lambda: Pattern.begin("x", is_("a")).followed_by("y", is_("b")).within(20 * SEC),
    "strict": lambda: Pattern.begin("x", is_("a")).next("y", is_("a")).within(12 * SEC),
    "runs": lambda: Pattern.begin("x", is_("c")).one_or_more().within(25 * SEC),
    "seq": lambda: Pattern.begin("x", is_("c")).followed_by("m", is_("a")).one_or_more().consecutive().followed_by("y", is_("b")).within(40 * SEC),
}


@pytest.mark.parametrize("name", list(PATTERNS))
def test_patterns_over_a_stream(spark, feed, tmp_path, name):
    pattern, keep = PATTERNS[name](), ["kind"]
    base = str(tmp_path / name)
    writer = bt.match_stream(stream(spark, feed, 2), pattern, ["k"], "t", ["n"], 4 * SEC, base, keep)
    query = drain(writer, f"{base}/ckpt")
    bt.flush_matches(spark, pattern, ["k"], "t", ["n"], base, query.lastProgress["batchId"], keep)
    want = match(feed[0], pattern, ["k"], ["t", "n"], keep)
    ends = [f"{s.name}_{e}" for s in pattern.stages for e in ("first", "last")]
    ids = lambda df: sorted(tuple(r[e].n for e in ends) for r in df.select(*ends).collect())
    assert ids(sk.read_batches(spark, f"{base}/matches")) == ids(want.rows)
    if want.timeouts is not None:
        late = sk.read_batches(spark, f"{base}/timeouts")
        first = lambda df: sorted(r.x_first.n for r in df.select("x_first").collect())
        assert first(late) == first(want.timeouts)
    assert sk.read_batches(spark, f"{base}/late").count() == 0


def test_rows_behind_the_pattern_watermark_are_set_aside(spark, tmp_path):
    drop, base = str(tmp_path / "drop"), str(tmp_path / "out")
    rows = [[(1, 100), (2, 101)], [(3, 50), (4, 102)]]
    pattern = Pattern.begin("x", F.col("n") > 0).next("y", F.col("n") > 0).within(10 * SEC)
    rows[0].append((9, None))  # without a time
    for part in rows:
        df = spark.createDataFrame(part, "n BIGINT, s BIGINT").select("n", F.lit(1).alias("k"), F.timestamp_seconds("s").alias("t"))
        df.coalesce(1).write.mode("append").parquet(drop)
        source = spark.readStream.schema("n BIGINT, k INT, t TIMESTAMP").parquet(drop)
        query = drain(bt.match_stream(source, pattern, ["k"], "t", ["n"], 0, base), f"{base}-ckpt")
    bt.flush_matches(spark, pattern, ["k"], "t", ["n"], base, query.lastProgress["batchId"])
    assert sorted(r.n for r in sk.read_batches(spark, f"{base}/late").collect()) == [3, 9]
    pairs = sorted((r.x_first.n, r.y_first.n) for r in sk.read_batches(spark, f"{base}/matches").collect())
    assert pairs == [(1, 2), (2, 4)]


def test_enrichment_reads_the_dimension_again(spark, feed, tmp_path):
    seen = []

    def users():
        seen.append(1)
        return spark.createDataFrame([(0, f"v{len(seen)}"), (1, "x"), (2, "y")], "k INT, name STRING")

    drain(bt.enrich_stream(stream(spark, feed, 3), users, ["k"], f"{tmp_path}/e"), f"{tmp_path}/ckpt")
    names = {r.name for r in sk.read_batches(spark, f"{tmp_path}/e").where("k = 0").select("name").distinct().collect()}
    assert names == {"v1", "v2"}


def test_a_batch_that_runs_again_reads_the_same_dimension(spark, feed, tmp_path):
    dim = {"rows": [(0, "old"), (1, "x"), (2, "y")]}
    read = lambda: spark.createDataFrame(dim["rows"], "k INT, name STRING")
    on_batch = bt.enrich_batches(read, ["k"], f"{tmp_path}/e", "left")
    on_batch(feed[0], 0)
    first = sorted(map(tuple, sk.read_batches(spark, f"{tmp_path}/e").collect()), key=str)
    dim["rows"] = [(0, "new")]
    on_batch(feed[0], 0)
    assert sorted(map(tuple, sk.read_batches(spark, f"{tmp_path}/e").collect()), key=str) == first
    dim["rows"] = []
    for batch_id in (1, 2):
        on_batch(feed[0], batch_id)
    assert sk.read_batches(spark, f"{tmp_path}/e").where("batch_id > 0 and name is not null").count() == 0
    assert sorted(os.listdir(f"{tmp_path}/e/_dims")) == ["1", "2"]


def test_rules_are_read_again(spark, feed, tmp_path):
    rules = [("r1", "kind = 'a' AND v > 25")]

    def read():
        out = spark.createDataFrame(rules, "rule_id STRING, predicate STRING")
        rules[:] = [("r2", "kind = 'b'")]
        return out

    drain(bt.rules_stream(stream(spark, feed, 3), read, f"{tmp_path}/r"), f"{tmp_path}/ckpt")
    got = {r.rule_id: r["count"] for r in sk.read_batches(spark, f"{tmp_path}/r").groupBy("rule_id").count().collect()}
    early, late = feed[0].where("n < 120"), feed[0].where("n >= 120")
    assert got == {"r1": early.where("kind = 'a' AND v > 25").count(), "r2": late.where("kind = 'b'").count()}


def test_top_n_of_changed_groups(spark, feed, tmp_path, small_folds):
    totals = wn.tumbling(stream(spark, feed), ["kind"], "t", "100 seconds", {"total": F.sum("v")}, delay="5 seconds")
    totals = totals.select("window_start", "kind", "total")
    drain(bt.top_n_stream(totals, ["window_start"], ["kind"], "total", ["kind"], 2, f"{tmp_path}/t"), f"{tmp_path}/ckpt")
    batch = wn.tumbling(feed[0], ["kind"], "t", "100 seconds", {"total": F.sum("v")})
    want = wn.top_n_per(batch, ["window_start"], "total", ["kind"], 2).select("window_start", "kind", "total", "rank")
    same(bt.current_ranks(spark, f"{tmp_path}/t", ["window_start"]), want)


def test_sliding_count_windows_over_micro_batches(spark, feed, tmp_path, small_folds):
    for size, slide in ((7, 3), (3, 7), (5, 1)):
        aggs = {"total": ag.Agg("sum", F.col("v")), "top": ag.Agg("max", F.col("v")), "n": ag.Agg("count", F.col("v"))}
        base = f"{tmp_path}/{size}"
        writer = bt.count_sliding_batches(stream(spark, feed), ["k"], ["t", "n"], size, slide, aggs, f"{base}/o", f"{base}/s")
        drain(writer, f"{base}/ckpt")
        plain = {"total": F.sum("v"), "top": F.max("v"), "n": F.count("v")}
        want = wn.count_sliding(feed[0], ["k"], ["t", "n"], size, slide, plain)
        same(sk.read_batches(spark, f"{base}/o").drop(sk.BATCH), want)


def test_allowed_lateness_over_micro_batches(spark, tmp_path, small_folds):
    """Rows up to 20 seconds out of order, by arrival: the same firings and late rows as over all rows at once."""
    rng = random.Random(29)
    rows = [(i, rng.randrange(3), 100 + i - rng.randrange(20), rng.randrange(50)) for i in range(150)]
    df = spark.createDataFrame([*rows], "n BIGINT, k INT, s BIGINT, v BIGINT").withColumn("t", F.timestamp_seconds("s")).drop("s")
    base = str(tmp_path)
    for part in range(5):
        df.where(F.col("n").between(part * 30, part * 30 + 29)).coalesce(1).write.mode("append").parquet(f"{base}/in")
    source = spark.readStream.schema("n BIGINT, k INT, v BIGINT, t TIMESTAMP").option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    how = (["k"], "t", ["n"], "4 seconds", "3 seconds", "5 seconds", F.col("v"))
    query = drain(bt.lateness_stream(source, *how, base), f"{base}/ckpt")
    bt.flush_windows(spark, ["k"], base, query.lastProgress["batchId"])
    firings, late = tumbling_with_lateness(df, *how)
    same(sk.read_batches(spark, f"{base}/firings").drop(sk.BATCH), firings)
    ids = lambda d: sorted(r.n for r in d.select("n").collect())
    assert ids(sk.read_batches(spark, f"{base}/late")) == ids(late) and ids(late)


def test_restart_resumes_without_loss_or_repeats(spark, feed, tmp_path):
    drop = str(tmp_path / "drop")
    for part in range(3):
        feed[0].where(F.col("n") % 3 == part).coalesce(1).write.mode("append").parquet(drop)
        rows = spark.readStream.schema(DDL).parquet(drop)
        drain(sk.exactly_once(rows, f"{tmp_path}/out"), f"{tmp_path}/ckpt")
        assert sk.read_batches(spark, f"{tmp_path}/out").count() == 80 * (part + 1)
    assert sk.read_batches(spark, f"{tmp_path}/out").select("n").distinct().count() == 240


def test_failed_query_is_started_again_and_output_stays_exact(spark, feed, tmp_path):
    failures = []

    def handle(batch, batch_id):
        sk.write_batch(batch, f"{tmp_path}/out", batch_id)
        if batch_id == 2 and len(failures) < 2:
            failures.append(batch_id)
            raise RuntimeError("worker lost after writing")

    def start():
        writer = stream(spark, feed).writeStream.foreachBatch(handle).option("checkpointLocation", f"{tmp_path}/ckpt")
        return writer.trigger(availableNow=True).start()

    run_stream(start, retries=3, wait_seconds=0.1)
    assert failures == [2, 2]
    out = sk.read_batches(spark, f"{tmp_path}/out")
    assert out.count() == 240 and out.select("n").distinct().count() == 240


def test_retries_are_limited(spark, feed, tmp_path):
    def start():
        def fail(batch, batch_id):
            raise RuntimeError("always")

        writer = stream(spark, feed).writeStream.foreachBatch(fail).option("checkpointLocation", f"{tmp_path}/ckpt")
        return writer.trigger(availableNow=True).start()

    with pytest.raises(Exception, match="always"):
        run_stream(start, retries=1, wait_seconds=0.1)


def test_update_mode_counts_and_upserts(spark, feed, tmp_path):
    counts = stream(spark, feed, 2).groupBy("k").agg(F.count("*").alias("c"))
    log = sk.exactly_once(counts, f"{tmp_path}/log", "update")
    drain(log, f"{tmp_path}/ckpt1")
    final = sk.latest_rows(spark, f"{tmp_path}/log", ["k"])
    same(final, feed[0].groupBy("k").agg(F.count("*").alias("c")))
    rows = stream(spark, feed, 2).select("k", "n", "v")
    drain(sk.upsert(rows, f"{tmp_path}/up", ["k"], ["n"]), f"{tmp_path}/ckpt2")
    same(sk.latest_rows(spark, f"{tmp_path}/up", ["k"], ["n"]), sk.last_per_key(feed[0].select("k", "n", "v"), ["k"], ["n"]))


def test_split_stream_writes_each_row_once(spark, feed, tmp_path):
    rules = {"even": F.col("n") % 2 == 0}
    drain(bt.split_stream(stream(spark, feed, 3), rules, f"{tmp_path}/o"), f"{tmp_path}/ckpt")
    got = {r.tag: r["count"] for r in sk.read_batches(spark, f"{tmp_path}/o").groupBy("tag").count().collect()}
    assert got == {"even": 120, "other": 120}


def test_user_sink_opens_one_connection_per_partition(spark, feed, tmp_path):
    folder = str(tmp_path)

    def open_():
        import tempfile

        return tempfile.NamedTemporaryFile("w", dir=folder, suffix=".rows", delete=False)

    writer = sk.per_connection(
        stream(spark, feed, 6).select("n").coalesce(2), open_, lambda c, row: c.write(f"{row.n}\n"), lambda c: c.close()
    )
    drain(writer, f"{tmp_path}/ckpt")
    files = list(tmp_path.glob("*.rows"))
    lines = [x for f in files for x in f.read_text().split()]
    assert len(files) <= 2 and sorted(map(int, lines)) == list(range(240))


def test_line_topic_and_change_streams(spark, tmp_path):
    lines = tmp_path / "lines"
    lines.mkdir()
    (lines / "a.txt").write_text("x y\nz\n")
    assert run(stream_lines(spark, str(lines)), tmp_path, "l").count() == 2
    topic = tmp_path / "topic"
    topic.mkdir()
    (topic / "a.json").write_text('{"value": "v1"}\n{"value": "v2"}\n')
    assert run(read_topic_files(spark, str(topic)).select("value"), tmp_path, "t").count() == 2
    changes = tmp_path / "changes"
    changes.mkdir()
    (changes / "a.json").write_text('{"before": null, "after": {"id": 1}, "op": "c", "ts_ms": 1, "source": {"db": "d", "table": "t", "pos": 1}}\n')
    got = run(read_changes(spark, str(changes), "id BIGINT", ["d.t"], "earliest", streaming=True).rows, tmp_path, "c")
    assert got.select("after.id").first().id == 1


def test_polled_table_reads_again_at_every_trigger(spark, tmp_path):
    path = str(tmp_path / "items")

    def read():
        return spark.read.schema("id INT").parquet(path)

    for n in (5, 3):
        spark.range(n).select(F.col("id").cast("int")).write.mode("append").parquet(path)
        handle = lambda rows, batch_id: sk.write_batch(rows, f"{tmp_path}/out", batch_id)
        time.sleep(1.2)
        drain(polled(ticks(spark), read, handle), f"{tmp_path}/ckpt")
    sizes = sk.read_batches(spark, f"{tmp_path}/out").groupBy(sk.BATCH).count().orderBy(sk.BATCH).collect()
    assert (sizes[0]["count"], sizes[-1]["count"]) == (5, 8)


def test_event_and_arrival_time_marks(spark, feed, tmp_path):
    marked = with_event_time(stream(spark, feed), "t", "2 seconds")
    assert "EventTimeWatermark" in marked._jdf.queryExecution().analyzed().toString()
    arrived = with_arrival_time(stream(spark, feed, 6), "seen_at").groupBy("kind").agg(F.count("*").alias("c"))
    assert run(arrived, tmp_path, "a", "complete").agg(F.sum("c")).first()[0] == 240


def test_console_sink_and_writer_settings(spark, feed, tmp_path):
    writer = write_every(stream(spark, feed, 6).groupBy("k").count(), "complete", "1 second", f"{tmp_path}/ckpt")
    query = writer.format("memory").queryName("counts_by_key").start()
    query.processAllAvailable()
    query.stop()
    assert spark.table("counts_by_key").agg(F.sum("count")).first()[0] == 240
    shown = sk.show_sink(stream(spark, feed, 6), "late:").trigger(availableNow=True).start()
    shown.awaitTermination()


def test_join_keeps_one_store_in_a_partition(spark, feed, tmp_path):
    run(st.deadline_stream(*item_streams(stream(spark, feed, 3)), ["item"], "o", "c", 3000, "0 seconds"), tmp_path, "one-store")
    stores = os.listdir(tmp_path / "one-store-ckpt/state/0/0")
    assert stores and not [s for s in stores if s.startswith(("left-", "right-"))]


@pytest.mark.parametrize("sizes,files", [((500, 400, 300), 3), ((500, 699, 1), 1), ((600, 600, 0), 1), ((50, 50, 50), 1)])
def test_deliveries_are_cut_for_all_slots(spark, monkeypatch, sizes, files):
    from sparkstream.queries import streams

    monkeypatch.setattr(streams, "SHARED_ROWS", 100)
    monkeypatch.setattr(streams, "LEAST_ROWS", 100)
    rows = [(f"{k}", k) for k, n in enumerate(sizes) for _ in range(n)]
    dealt = spark.createDataFrame(rows, "v STRING, delivery INT").repartition(5)
    path, made = streams.delivery_folder(spark, dealt, 3, len(rows), "parquet")
    assert made == files
    written = spark.read.parquet(path).withColumn("file", F.input_file_name()).groupBy("v").agg(F.count_distinct("file"), F.count("*"))
    assert sorted(map(tuple, written.collect())) == [(f"{k}", files, n) for k, n in enumerate(sizes) if n]


def _files(path):
    return [n for n in os.listdir(path) if n.endswith(".parquet")]


def test_the_largest_time_of_a_batch_is_one_file(spark, feed, tmp_path):
    base = str(tmp_path / "lateness")
    writer = bt.lateness_stream(stream(spark, feed, 3), ["k"], "t", ["n"], "20 seconds", "5 seconds", "5 seconds", F.col("v"), base)
    drain(writer, f"{base}/checkpoint")
    marks = [f"{base}/marks/{sk.BATCH}={i}" for i in (0, 1)]
    assert [len(_files(m)) for m in marks] == [1, 1]
    newest = [feed[0].where(F.col("n") < n).agg(F.max("t")).first()[0] for n in (120, 240)]
    assert [spark.read.parquet(m).first()[0] for m in marks] == newest


def test_no_late_rows_are_one_empty_file(spark, feed, tmp_path):
    base = str(tmp_path / "pairs")
    drain(bt.match_stream(stream(spark, feed, 3), PATTERNS["pair"](), ["k"], "t", ["n"], 5 * SEC, base, ["kind"]), f"{base}/checkpoint")
    assert len(_files(f"{base}/late/{sk.BATCH}=0")) == 1 and sk.read_batches(spark, f"{base}/late").count() == 0
