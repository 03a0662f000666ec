"""Streaming queries: each reads the tables as file streams, runs to the end of what is there, and
returns what it wrote."""

import uuid

from pyspark.sql import functions as F

from sparkstream.operators import joins as jn
from sparkstream.operators import windows as wn
from sparkstream.operators.aggregate import Agg
from sparkstream.operators.lateness import with_arrival_time
from sparkstream.operators.patterns import Pattern
from sparkstream.plans.scan import running_count, running_max, running_sum
from sparkstream.queries.basics import CENTS, cents
from sparkstream.queries.changes import CURRENT, ROW_DDL, feed_files
from sparkstream.queries.joins import HOUR
from sparkstream.queries.patterns import CLICKS, DAY, NEXT_PURCHASE, is_
from sparkstream.queries.registry import query
from sparkstream.queries.timewindows import FIRINGS, LATE_ROWS, arrivals
from sparkstream.session import scratch
from sparkstream.sources.basic import from_rows, read_lines, stream_lines
from sparkstream.sources.changes import read_changes
from sparkstream.sources.polled import polled, ticks
from sparkstream.streaming import batches as bt
from sparkstream.streaming import sinks as sk
from sparkstream.streaming import stateful as st
from sparkstream.streaming.manifest import CommitTable
from sparkstream.streaming.runner import drain, run_stream
from sparkstream.tables import load

#: Files the events are delivered in, one per micro-batch, and how much later than their time rows may come.
DELIVERIES, DISORDER = 6, 6
#: Rows of a delivered file; from the smaller number on a delivery is cut so that every task slot has a file to read.
FILE_ROWS, SHARED_ROWS = 1_000_000, 50_000
#: A delivery has this many rows for each of its files: none stays without a file, however the rows are read.
LEAST_ROWS = 1_000


def delivered(spark, sf_dir, in_order=False, events=None, t="ts"):
    """The events (or other rows with a time ``t``) as a stream of several micro-batches, every row in one of them.

    The table is written again as files that hold a stretch of delivery time each. A row is delivered up to six hours
    after its time, by its id, so files hold rows older than the newest of the file before; with ``in_order`` it is
    delivered at once. A watermark of six hours therefore loses nothing.
    """
    events = load(spark, sf_dir, "events") if events is None else events
    late = F.lit(0) if in_order else F.pmod("event_id", F.lit(DISORDER + 1)) * 3_600_000_000
    placed = events.withColumn("due", F.unix_micros(t) + late)
    low, high, n = placed.agg(F.min("due"), F.max("due"), F.count("*")).first()
    width = ((high or 0) - (low or 0)) // DELIVERIES + 1
    number = F.floor((F.col("due") - (low or 0)) / width).cast("int")
    dealt = placed.withColumn("delivery", F.coalesce(number, F.lit(0))).drop("due")  # no time: with the first
    path, files = delivery_folder(spark, dealt, DELIVERIES, n, "parquet")
    return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", files).parquet(path)


def delivery_folder(spark, dealt, deliveries, n, form):
    """Rows with a number ``delivery`` as a folder that deliveries come to one after another, and the files of each.

    The rows are dealt to their deliveries in one job, so the table is read once, by all tasks; each delivery is then
    copied from its own part. All have the same number of files, for a micro-batch takes that many: files of up to
    ``FILE_ROWS`` rows, and of fewer where task slots would stay idle, but no more than the smallest delivery can fill.
    """
    staged, path = scratch(spark, "staged"), scratch(spark, "delivered")
    dealt.write.partitionBy("delivery").format(form).save(staged)
    rows = dealt.drop("delivery").schema
    read = spark.read.schema(rows.add("delivery", "integer")).format(form).load(staged)
    slots = min(spark.sparkContext.defaultParallelism, n // (deliveries * SHARED_ROWS))
    files = max(-(-n // (deliveries * FILE_ROWS)), slots, 1)
    if files > 1:
        sizes = [r["count"] for r in read.groupBy("delivery").count().collect()]
        files = max(1, min(files, min(sizes) // LEAST_ROWS if len(sizes) == deliveries else 1))
    for k in range(deliveries):
        read.where(F.col("delivery") == k).drop("delivery").repartition(files).write.mode("append").format(form).save(path)
    return path, files


def ran(query, least=DELIVERIES):
    """The query, after a look at whether it really ran in several micro-batches."""
    if query.lastProgress["batchId"] < least - 1:
        raise AssertionError(f"{query.lastProgress['batchId'] + 1} micro-batches instead of {least}")
    return query


def collected(spark, label, df, mode="append", least=DELIVERIES):
    """Run a stream into an exactly-once file log and read the log back."""
    base = scratch(spark, label)
    ran(drain(sk.exactly_once(df, f"{base}/out", mode), f"{base}/checkpoint"), least)
    return sk.read_batches(spark, f"{base}/out")


def stream_of(rows, kind, cols):
    return rows.where(F.col("event_type") == kind).select(*[F.col(old).alias(new) for new, old in cols.items()])


@query(
    f"""SELECT event_type, time_bucket(INTERVAL '1 day', ts) AS window_start, CAST(count(*) AS BIGINT) AS n,
    CAST(sum({CENTS}) AS BIGINT) AS total FROM events GROUP BY 1, 2
    HAVING window_start + INTERVAL '1 day' <= (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL '6 hours' FROM events)"""
)
def stream_tumbling(spark, sf_dir):
    """Day windows with a watermark of six hours: those the watermark has closed."""
    sums = {"n": F.count("*"), "total": F.sum(cents())}
    windows = wn.tumbling(delivered(spark, sf_dir), ["event_type"], "ts", "1 day", sums, delay="6 hours")
    return collected(spark, "tumbling", windows).select("event_type", "window_start", "n", "total")


@query(
    """SELECT v.user_id, v.event_id AS view_id, c.event_id AS click_id FROM events v JOIN events c ON v.user_id = c.user_id
    AND time_bucket(INTERVAL '1 day', v.ts) = time_bucket(INTERVAL '1 day', c.ts)
    WHERE v.event_type = 'view' AND c.event_type = 'click'"""
)
def stream_window_join(spark, sf_dir):
    rows = delivered(spark, sf_dir)
    views = stream_of(rows, "view", {"user_id": "user_id", "view_id": "event_id", "view_ts": "ts"})
    clicks = stream_of(rows, "click", {"user_id": "user_id", "click_id": "event_id", "click_ts": "ts"})
    joined = jn.window_join(views, clicks, ["user_id"], "view_ts", "click_ts", "1 day", delay="6 hours")
    return collected(spark, "window-join", joined.select("user_id", "view_id", "click_id")).drop(sk.BATCH)


@query(
    """SELECT v.user_id, v.event_id AS view_id, c.event_id AS click_id FROM events v JOIN events c
    ON v.user_id = c.user_id AND c.ts BETWEEN v.ts - INTERVAL '2 hours' AND v.ts + INTERVAL '1 hour'
    WHERE v.event_type = 'view' AND c.event_type = 'click'"""
)
def stream_interval_join(spark, sf_dir):
    rows = delivered(spark, sf_dir)
    views = stream_of(rows, "view", {"user_id": "user_id", "view_id": "event_id", "view_ts": "ts"})
    clicks = stream_of(rows, "click", {"user_id": "user_id", "click_id": "event_id", "click_ts": "ts"})
    joined = jn.interval_join_stream(
        views, clicks, ["user_id"], "view_ts", "click_ts", "'-2' HOURS", "'1' HOURS", "6 hours"
    )
    return collected(spark, "interval-join", joined.select("user_id", "view_id", "click_id")).drop(sk.BATCH)


@query(
    f"""SELECT user_id, CAST((pos - 1) // 5 AS BIGINT) AS window_no, CAST(sum({CENTS}) AS BIGINT) AS total FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos FROM events)
    GROUP BY 1, 2 HAVING count(*) = 5"""
)
def stream_count_tumbling(spark, sf_dir):
    base = scratch(spark, "count-tumbling")
    rows = delivered(spark, sf_dir, in_order=True).select("user_id", "ts", "event_id", cents().alias("cents"))
    total = {"total": Agg("sum", F.col("cents"))}
    writer = bt.count_tumbling_batches(rows, ["user_id"], ["ts", "event_id"], 5, total, f"{base}/out", f"{base}/state")
    ran(drain(writer, f"{base}/checkpoint"))
    return sk.read_batches(spark, f"{base}/out").drop(sk.BATCH)


@query(
    """SELECT event_id, user_id, max(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS max_value FROM events"""
)
def stream_running_max(spark, sf_dir):
    base = scratch(spark, "running-max")
    rows = delivered(spark, sf_dir, in_order=True).select("user_id", "ts", "event_id", "value")
    outs = {"max_value": running_max(F.col("value"))}
    ran(drain(bt.scan_stream(rows, ["user_id"], ["ts", "event_id"], outs, f"{base}/out", f"{base}/state"), f"{base}/checkpoint"))
    return sk.read_batches(spark, f"{base}/out").select("event_id", "user_id", "max_value")


@query(
    f"""SELECT event_id, user_id, CAST(count(*) OVER w AS BIGINT) AS n, CAST(sum({CENTS}) OVER w AS BIGINT) AS total
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)"""
)
def stream_running_sum(spark, sf_dir):
    """Running values whose micro-batches go through the skew-safe scan."""
    rows = delivered(spark, sf_dir, in_order=True).select("user_id", "ts", "event_id", "value")
    base = scratch(spark, "running-sum")
    outs = {"n": running_count(), "total": running_sum(cents())}
    writer = bt.scan_stream(rows, ["user_id"], ["ts", "event_id"], outs, f"{base}/out", f"{base}/state")
    ran(drain(writer, f"{base}/checkpoint"))
    return sk.read_batches(spark, f"{base}/out").select("event_id", "user_id", "n", "total")


@query(
    f"""WITH r AS (SELECT user_id, ts, event_id, CAST(count(*) OVER w AS BIGINT) AS n, CAST(sum({CENTS}) OVER w AS BIGINT) AS total
      FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    b AS (SELECT *, lag(n) OVER w AS pn, lag(total) OVER w AS pt FROM r WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
    SELECT user_id, event_id, TRUE AS is_add, n, total FROM b
    UNION ALL SELECT user_id, event_id, FALSE AS is_add, pn, pt FROM b WHERE pn IS NOT NULL"""
)
def stream_changelog(spark, sf_dir):
    base = scratch(spark, "changelog")
    rows = delivered(spark, sf_dir, in_order=True).select("user_id", "ts", "event_id", "value")
    outs = {"n": running_count(), "total": running_sum(cents())}
    writer = bt.changelog_batches(rows, ["user_id"], ["ts", "event_id"], outs, f"{base}/out", f"{base}/state")
    ran(drain(writer, f"{base}/checkpoint"))
    return sk.read_batches(spark, f"{base}/out").drop(sk.BATCH, "ts")


@query(
    """WITH o AS (SELECT event_id // 2 AS item, ts FROM events WHERE event_id % 2 = 0),
    c AS (SELECT event_id // 2 AS item, ts AS done FROM events WHERE event_id % 2 = 1),
    j AS (SELECT o.item, o.ts, c.done FROM o LEFT JOIN c ON o.item = c.item AND c.done <= o.ts + INTERVAL '4 minutes'),
    marks AS (SELECT least(max(ts) FILTER (WHERE event_id % 2 = 0), max(ts) FILTER (WHERE event_id % 2 = 1)) AS mark FROM events)
    SELECT item, CASE WHEN done IS NULL THEN 'auto' ELSE 'reviewed' END AS status,
      coalesce(done, j.ts + INTERVAL '4 minutes') AS decided_at
    FROM j, marks WHERE done IS NOT NULL OR j.ts + INTERVAL '4 minutes' < mark - INTERVAL '6 hours'"""
)
def stream_deadlines(spark, sf_dir):
    """Items answered within four minutes or decided automatically; those still open have no row yet."""
    rows = delivered(spark, sf_dir).withColumn("item", F.expr("event_id div 2"))
    opens = rows.where(F.col("event_id") % 2 == 0).select("item", F.col("ts").alias("opened"))
    closes = rows.where(F.col("event_id") % 2 == 1).select("item", F.col("ts").alias("closed"))
    decided = st.deadline_stream(opens, closes, ["item"], "opened", "closed", 240_000, "6 hours")
    return collected(spark, "deadlines", decided).drop(sk.BATCH)


@query("SELECT user_id, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY user_id")
def exactly_once_counts(spark, sf_dir):
    """Events -> running counts -> a log in which every micro-batch appears once."""
    counts = delivered(spark, sf_dir).groupBy("user_id").agg(F.count("*").alias("n"))
    log = collected(spark, "counts", counts, "update")
    return sk.last_per_key(log, ["user_id"], [sk.BATCH]).select("user_id", "n")


@query(
    f"""SELECT user_id, CAST(count(*) AS BIGINT) AS n, CAST(sum({CENTS}) AS BIGINT) AS total FROM events GROUP BY user_id"""
)
def stream_committed_rows(spark, sf_dir):
    """Events in a table of committed batches; an attempt is lost between its files and its record, and is run again."""
    base, lost = scratch(spark, "committed"), []
    rows = delivered(spark, sf_dir).select("event_id", "user_id", "value")

    def on_batch(batch, batch_id):
        table = CommitTable(spark, f"{base}/table", fan=3)
        if batch_id == 2 and not lost:
            lost.append(batch_id)
            batch.write.parquet(f"{base}/table/data/batch-lost")
            raise RuntimeError("lost before the record")
        table.write(batch, batch_id)

    def start():
        writer = rows.writeStream.foreachBatch(on_batch).option("checkpointLocation", f"{base}/checkpoint")
        return writer.trigger(availableNow=True).start()

    ran(run_stream(start, retries=1, wait_seconds=0.1))
    return CommitTable(spark, f"{base}/table").read().groupBy("user_id").agg(
        F.count("*").alias("n"), F.sum(cents()).alias("total")
    )


@query(
    """SELECT user_id, event_id, event_type FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1"""
)
def upsert_latest(spark, sf_dir):
    """The latest event of every user, kept up to date batch by batch."""
    base = scratch(spark, "upsert")
    rows = delivered(spark, sf_dir).select("user_id", "event_id", "event_type", "ts")
    ran(drain(sk.upsert(rows, f"{base}/log", ["user_id"], ["ts", "event_id"]), f"{base}/checkpoint"))
    latest = sk.latest_rows(spark, f"{base}/log", ["user_id"], ["ts", "event_id"])
    return latest.select("user_id", "event_id", "event_type")


@query("SELECT user_id, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY user_id")
def resumable_counts(spark, sf_dir):
    """Counts over a drop folder, stopped and started again when more files arrive."""
    base = scratch(spark, "resumable")
    events = load(spark, sf_dir, "events").select("event_id", "user_id")
    for half in (0, 1):
        events.where(F.col("event_id") % 2 == half).write.mode("append").parquet(f"{base}/drop")
        stream = spark.readStream.schema("event_id BIGINT, user_id BIGINT").parquet(f"{base}/drop")
        counts = stream.groupBy("user_id").agg(F.count("*").alias("n"))
        drain(sk.exactly_once(counts, f"{base}/out", "update"), f"{base}/checkpoint")
    return sk.last_per_key(sk.read_batches(spark, f"{base}/out"), ["user_id"], [sk.BATCH]).select("user_id", "n")


def _matched(spark, sf_dir, pattern, label):
    base = scratch(spark, label)
    writer = bt.match_stream(
        delivered(spark, sf_dir), pattern, ["user_id"], "ts", ["event_id"], DISORDER * HOUR, base, keep=["event_type"]
    )
    run = ran(drain(writer, f"{base}/checkpoint"))
    bt.flush_matches(spark, pattern, ["user_id"], "ts", ["event_id"], base, run.lastProgress["batchId"], ["event_type"])
    return base


@query(
    f"""SELECT user_id, event_id, CASE WHEN paid_at - ts < INTERVAL '1 day' THEN 'paid' ELSE 'timeout' END AS outcome
    FROM ({NEXT_PURCHASE}) WHERE event_type = 'signup'"""
)
def stream_order_timeout(spark, sf_dir):
    pattern = Pattern.begin("a", is_("signup")).followed_by("b", is_("purchase")).within(DAY)
    base = _matched(spark, sf_dir, pattern, "order-timeout")
    outcome = [("matches", "paid"), ("timeouts", "timeout")]
    paid, late = (
        sk.read_batches(spark, f"{base}/{name}").select(
            "user_id", F.col("a_first.event_id").alias("event_id"), F.lit(label).alias("outcome")
        )
        for name, label in outcome
    )
    return paid.unionByName(late)


@query(
    f"""WITH {CLICKS} SELECT a.user_id, a.event_id AS first_id, b.event_id AS last_id
    FROM clicks a JOIN clicks b ON a.user_id = b.user_id AND b.r >= a.r WHERE b.ts - a.ts < INTERVAL '1 day'"""
)
def stream_malice_runs(spark, sf_dir):
    pattern = Pattern.begin("a", is_("click")).one_or_more().within(DAY)
    base = _matched(spark, sf_dir, pattern, "malice-runs")
    return sk.read_batches(spark, f"{base}/matches").select(
        "user_id", F.col("a_first.event_id").alias("first_id"), F.col("a_last.event_id").alias("last_id")
    )


@query("SELECT e.event_id, e.user_id, c.c_name AS name FROM events e JOIN customer c ON e.user_id = c.c_custkey")
def stream_enrich(spark, sf_dir):
    """The customer table is read again for every micro-batch."""
    base = scratch(spark, "enrich")

    def users():
        return load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("name"))

    events = delivered(spark, sf_dir).select("event_id", "user_id")
    ran(drain(bt.enrich_stream(events, users, ["user_id"], f"{base}/out"), f"{base}/checkpoint"))
    return sk.read_batches(spark, f"{base}/out").select("event_id", "user_id", "name")


#: The micro-batch that fails after it wrote its rows; the dimension changes before it runs again.
FAILING = 2


@query(
    f"""WITH s AS (SELECT min(epoch_us(ts)) AS low, (max(epoch_us(ts)) - min(epoch_us(ts))) // {DELIVERIES} + 1 AS width FROM events)
    SELECT e.event_id, e.user_id, c.c_name || CASE WHEN (epoch_us(e.ts) - low) // width > {FAILING} THEN ' moved' ELSE '' END AS name
    FROM events e JOIN customer c ON e.user_id = c.c_custkey, s"""
)
def stream_enrich_replayed(spark, sf_dir):
    """A micro-batch fails, the dimension changes, and the batch runs again: it gives the rows it gave before."""
    base, suffix = scratch(spark, "replayed"), [""]

    def users():
        name = F.concat("c_name", F.lit(suffix[0])).alias("name")
        return load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), name)

    on_batch = bt.enrich_batches(users, ["user_id"], f"{base}/out")

    def failing(batch, batch_id):
        on_batch(batch, batch_id)
        if batch_id == FAILING and not suffix[0]:
            suffix[0] = " moved"
            raise RuntimeError("lost before the batch was noted as done")

    events = delivered(spark, sf_dir, in_order=True).select("event_id", "user_id")

    def start():
        writer = events.writeStream.foreachBatch(failing).trigger(availableNow=True)
        return writer.option("checkpointLocation", f"{base}/checkpoint").start()

    run_stream(start, retries=1, wait_seconds=0.1)
    return sk.read_batches(spark, f"{base}/out").select("event_id", "user_id", "name")


@query(
    """SELECT event_id, 1 AS rule_id FROM events WHERE event_type = 'error' AND value > 10
    UNION ALL SELECT event_id, 2 AS rule_id FROM events WHERE event_type IN ('view', 'click') AND value < 1"""
)
def stream_rules(spark, sf_dir):
    base = scratch(spark, "rules")

    def rules():
        return from_rows(
            spark,
            [(1, "event_type = 'error' AND value > 10"), (2, "event_type IN ('view', 'click') AND value < 1")],
            "rule_id INT, predicate STRING",
        )

    events = delivered(spark, sf_dir).select("event_id", "event_type", "value")
    ran(drain(bt.rules_stream(events, rules, f"{base}/out"), f"{base}/checkpoint"))
    return sk.read_batches(spark, f"{base}/out").select("event_id", "rule_id")


@query(
    f"""SELECT day, event_type, total FROM (
      SELECT time_bucket(INTERVAL '1 day', ts) AS day, event_type, CAST(sum({CENTS}) AS BIGINT) AS total,
        row_number() OVER (PARTITION BY time_bucket(INTERVAL '1 day', ts) ORDER BY sum({CENTS}) DESC, event_type) AS rn
      FROM events GROUP BY 1, 2) WHERE rn <= 3"""
)
def stream_top3(spark, sf_dir):
    """Days whose totals changed are ranked again at every trigger; each day has its latest ranks."""
    base = scratch(spark, "top3")
    totals = wn.tumbling(delivered(spark, sf_dir), ["event_type"], "ts", "1 day", {"total": F.sum(cents())}, delay="6 hours")
    totals = totals.select(F.col("window_start").alias("day"), "event_type", "total")
    writer = bt.top_n_stream(totals, ["day"], ["event_type"], "total", ["event_type"], 3, base)
    ran(drain(writer, f"{base}/checkpoint"))
    return bt.current_ranks(spark, base, ["day"]).select("day", "event_type", "total")


@query(
    f"""SELECT event_type, time_bucket(INTERVAL '1 day', ts + INTERVAL '8 hours') - INTERVAL '8 hours' AS day_start,
    CAST(sum({CENTS}) AS BIGINT) AS total FROM events GROUP BY 1, 2"""
)
def stream_day_to_date(spark, sf_dir):
    """Each category's sum since local midnight, given again at every trigger in which it changed: the last ones given."""
    rows = delivered(spark, sf_dir).withWatermark("ts", "6 hours")
    day = F.window("ts", "1 day", "1 day", "16 hours")
    sums = rows.groupBy("event_type", day.alias("w")).agg(F.sum(cents()).alias("total"))
    log = collected(spark, "day-to-date", sums.select("event_type", F.col("w.start").alias("day_start"), "total"), "update")
    return sk.last_per_key(log, ["event_type", "day_start"], [sk.BATCH]).drop(sk.BATCH)


@query(
    f"""WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER w <= INTERVAL '12 hours' THEN 0 ELSE 1 END AS fresh
      FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
    s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS no FROM g)
    SELECT user_id, min(ts) AS first_ts, CAST(count(*) AS BIGINT) AS n, CAST(sum({CENTS}) AS BIGINT) AS total
    FROM s GROUP BY user_id, no
    HAVING max(ts) + INTERVAL '12 hours' <= (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL '6 hours' FROM events)"""
)
def stream_session(spark, sf_dir):
    """Sessions of a user, ended by twelve silent hours, as the watermark closes them."""
    rows = delivered(spark, sf_dir).withWatermark("ts", "6 hours")
    found = rows.groupBy("user_id", F.session_window("ts", "12 hours").alias("w")).agg(
        F.count("*").alias("n"), F.sum(cents()).alias("total")
    )
    return collected(spark, "session", found.select("user_id", F.col("w.start").alias("first_ts"), "n", "total")).drop(sk.BATCH)


@query(
    f"""WITH n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos FROM events),
    c AS (SELECT *, unnest(generate_series((pos + 1) // 2, (pos + 4) // 2)) AS window_no FROM n)
    SELECT user_id, window_no, CAST(sum({CENTS}) AS BIGINT) AS total FROM c GROUP BY user_id, window_no
    HAVING max(pos) = window_no * 2"""
)
def stream_count_sliding(spark, sf_dir):
    """The last five rows of a user, at every second row."""
    base = scratch(spark, "count-sliding")
    rows = delivered(spark, sf_dir, in_order=True).select("user_id", "ts", "event_id", cents().alias("cents"))
    total = {"total": Agg("sum", F.col("cents"))}
    writer = bt.count_sliding_batches(rows, ["user_id"], ["ts", "event_id"], 5, 2, total, f"{base}/out", f"{base}/state")
    ran(drain(writer, f"{base}/checkpoint"))
    return sk.read_batches(spark, f"{base}/out").drop(sk.BATCH)


@query("SELECT word, CAST(count(*) AS BIGINT) AS n FROM (SELECT unnest(string_split(o_orderpriority, '-')) AS word FROM orders) GROUP BY word")
def stream_line_words(spark, sf_dir):
    """Lines that arrive in a folder, split into words, counted as they come."""
    base = scratch(spark, "lines")
    orders = load(spark, sf_dir, "orders")
    dealt = orders.select(F.col("o_orderpriority").alias("value"), F.pmod("o_orderkey", F.lit(3)).cast("int").alias("delivery"))
    path, files = delivery_folder(spark, dealt, 3, orders.count(), "text")
    words = stream_lines(spark, path, files_per_batch=files).select(F.explode(F.split("line", "-")).alias("word"))
    log = collected(spark, "words", words.groupBy("word").agg(F.count("*").alias("n")), "update", 3)
    return sk.last_per_key(log, ["word"], [sk.BATCH]).drop(sk.BATCH)


@query("SELECT event_type, CAST(count(*) AS BIGINT) AS n, TRUE AS stamped FROM events GROUP BY event_type")
def stream_arrival_counts(spark, sf_dir):
    """Rows stamped as they arrive: nothing is late, whatever its own time says."""
    rows = with_arrival_time(delivered(spark, sf_dir), "seen_at")
    seen = rows.groupBy("event_type").agg(F.count("*").alias("n"), F.every(F.col("seen_at") >= F.col("ts")).alias("stamped"))
    log = collected(spark, "arrival", seen, "update")
    return sk.last_per_key(log, ["event_type"], [sk.BATCH]).drop(sk.BATCH)


@query("SELECT event_id, user_id FROM events")
def stream_restarted(spark, sf_dir):
    """A job that fails in its third micro-batch after writing, is started again, and has every row once."""
    base, failures = scratch(spark, "restarted"), []
    rows = delivered(spark, sf_dir).select("event_id", "user_id")

    def on_batch(batch, batch_id):
        sk.write_batch(batch, f"{base}/out", batch_id)
        if batch_id == 2 and not failures:
            failures.append(batch_id)
            raise RuntimeError("lost after writing")

    def start():
        writer = rows.writeStream.foreachBatch(on_batch).option("checkpointLocation", f"{base}/checkpoint")
        return writer.trigger(availableNow=True).start()

    ran(run_stream(start, retries=2, wait_seconds=0.1))
    return sk.read_batches(spark, f"{base}/out").drop(sk.BATCH)


def _late_stream(spark, sf_dir):
    base = scratch(spark, "lateness")
    rows = delivered(spark, sf_dir, True, arrivals(spark, sf_dir), "arrival")
    writer = bt.lateness_stream(
        rows, ["user_id"], "ts", ["arrival", "event_id"], "2 hours", "8 hours", "4 hours", F.col("cents"), base
    )
    run = ran(drain(writer, f"{base}/checkpoint"))
    bt.flush_windows(spark, ["user_id"], base, run.lastProgress["batchId"])
    return base


@query(FIRINGS)
def stream_lateness_firings(spark, sf_dir):
    """Windows of a stream that fire once and again for every allowed late row."""
    return sk.read_batches(spark, f"{_late_stream(spark, sf_dir)}/firings").drop(sk.BATCH)


@query(LATE_ROWS)
def stream_late_rows(spark, sf_dir):
    """Rows of a stream that came too late for their window."""
    late = sk.read_batches(spark, f"{_late_stream(spark, sf_dir)}/late")
    return late.select("event_id", "user_id", "ts", "arrival", "watermark")


@query(CURRENT)
def stream_cdc_current(spark, sf_dir):
    """A change feed merged batch by batch into the current rows; changes of a row may come in any order of files."""
    base = scratch(spark, "cdc")
    feed = read_changes(spark, feed_files(spark, sf_dir, DELIVERIES), ROW_DDL, streaming=True, files_per_batch=1)
    rows = feed.rows.select(
        F.coalesce("after.o_orderkey", "before.o_orderkey").alias("o_orderkey"), "op", "pos", "after.o_orderstatus", "after.cents"
    )
    ran(drain(sk.upsert(rows, f"{base}/log", ["o_orderkey"], ["pos"]), f"{base}/checkpoint"))
    latest = sk.latest_rows(spark, f"{base}/log", ["o_orderkey"], ["pos"]).where("op <> 'd'")
    return latest.select("o_orderkey", "o_orderstatus", "cents")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'even' ELSE 'odd' END AS tag FROM orders")
def stream_split(spark, sf_dir):
    """One stream written to one folder per tag."""
    base = scratch(spark, "split")
    orders = delivered(spark, sf_dir, True, load(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate")
    rules = {"even": F.col("o_orderkey") % 2 == 0, "odd": F.col("o_orderkey") % 2 != 0}
    ran(drain(bt.split_stream(orders.select("o_orderkey"), rules, f"{base}/out"), f"{base}/checkpoint"))
    return sk.read_batches(spark, f"{base}/out").select("o_orderkey", "tag")


@query("SELECT c_custkey, c_name FROM customer")
def polled_source(spark, sf_dir):
    """A table read again at every trigger; the last reading."""
    base = scratch(spark, "polled")

    def read():
        return load(spark, sf_dir, "customer").select("c_custkey", "c_name")

    writer = polled(ticks(spark), read, lambda rows, batch_id: sk.write_batch(rows, f"{base}/out", batch_id))
    run = drain(writer, f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/out/{sk.BATCH}={run.lastProgress['batchId']}")


@query("SELECT id, name, CAST(2 AS BIGINT) AS copies FROM (SELECT s_suppkey AS id, s_name AS name FROM supplier)")
def insert_select(spark, sf_dir):
    """INSERT INTO a table from itself: every row is there twice."""
    table = f"person_{uuid.uuid4().hex[:10]}"
    people = load(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    where = scratch(spark, table)
    spark.sql(f"CREATE TABLE {table} (id BIGINT, name STRING) USING parquet LOCATION '{where}'")
    sk.insert_into(people, table, writers=2)
    spark.sql(f"INSERT INTO {table} SELECT * FROM {table}")
    stored = spark.read.schema("id BIGINT, name STRING").parquet(where)
    spark.sql(f"DROP TABLE {table}")
    return stored.groupBy("id", "name").agg(F.count("*").alias("copies"))


@query("SELECT CAST(3 AS BIGINT) AS files, CAST(count(*) AS BIGINT) AS n, min(c_name) AS first_line FROM customer")
def text_sink(spark, sf_dir):
    """Text written by three tasks and read back: files, lines."""
    path = sk.write_text(load(spark, sf_dir, "customer").select("c_name"), scratch(spark, "text"), 3)
    lines = read_lines(spark, path).withColumn("file", F.input_file_name())
    return lines.agg(F.count_distinct("file").alias("files"), F.count("*").alias("n"), F.min("line").alias("first_line"))
