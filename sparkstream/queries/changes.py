"""Change-log, change-data and key-range queries."""

import uuid

from pyspark.sql import functions as F

from sparkstream.operators import changelog as cl
from sparkstream.plans.scan import running_count, running_sum, settled
from sparkstream.queries.basics import CENTS, cents
from sparkstream.queries.registry import query
from sparkstream.sources import changes as ch
from sparkstream.sources import topics
from sparkstream.sources.basic import as_view
from sparkstream.sources.jdbc import key_ranges
from sparkstream.session import scratch
from sparkstream.tables import load

RUNNING = f"""running AS (SELECT user_id, event_id, CAST(count(*) OVER w AS BIGINT) AS n, CAST(sum({CENTS}) OVER w AS BIGINT) AS total
      FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
    both_ AS (SELECT *, lag(n) OVER w AS pn, lag(total) OVER w AS pt FROM running WINDOW w AS (PARTITION BY user_id ORDER BY event_id))"""


@query(
    f"""WITH {RUNNING}
    SELECT user_id, event_id, TRUE AS is_add, n, total FROM both_
    UNION ALL SELECT user_id, event_id, FALSE AS is_add, pn, pt FROM both_ WHERE pn IS NOT NULL"""
)
def changelog_counts(spark, sf_dir):
    """Every change of a per-user count and sum: the old row withdrawn, the new one added."""
    events = load(spark, sf_dir, "events").select("user_id", "event_id", "value")
    return cl.to_changelog(events, ["user_id"], ["event_id"], {"n": running_count(), "total": running_sum(cents())})


@query(
    f"""WITH {RUNNING}
    SELECT user_id, event_id, TRUE AS is_add, n FROM both_ WHERE n BETWEEN 3 AND 5
    UNION ALL SELECT user_id, event_id, FALSE AS is_add, pn FROM both_ WHERE pn BETWEEN 3 AND 5"""
)
def changelog_having(spark, sf_dir):
    """The change log of ``HAVING count BETWEEN 3 AND 5``: a count that leaves the range is withdrawn."""
    events = load(spark, sf_dir, "events").select("user_id", "event_id")
    keep = F.col("n").between(3, 5)
    return cl.to_changelog(events, ["user_id"], ["event_id"], {"n": running_count()}, keep)


@query("SELECT user_id, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY user_id")
def changelog_replayed(spark, sf_dir):
    """A change log played back gives the final table."""
    events = load(spark, sf_dir, "events").select("user_id", "event_id")
    return cl.replay(cl.to_changelog(events, ["user_id"], ["event_id"], {"n": running_count()}), ["user_id", "n"])


ROW_DDL = "o_orderkey BIGINT, o_orderstatus STRING, cents BIGINT"

FEED = """base AS (SELECT o_orderkey, o_orderstatus, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders),
    feed AS (
      SELECT 'r' AS op, 1 AS ts_ms, o_orderkey, NULL AS b_status, NULL AS b_cents, o_orderstatus AS a_status, cents AS a_cents FROM base
      UNION ALL SELECT 'u', 2, o_orderkey, o_orderstatus, cents, 'X', cents + 1 FROM base WHERE o_orderkey % 3 = 0
      UNION ALL SELECT 'u', 3, o_orderkey, 'X', cents + 1, 'Y', cents + 2 FROM base WHERE o_orderkey % 6 = 0
      UNION ALL SELECT 'd', 4, o_orderkey, CASE WHEN o_orderkey % 6 = 0 THEN 'Y' WHEN o_orderkey % 3 = 0 THEN 'X' ELSE o_orderstatus END,
        cents + CASE WHEN o_orderkey % 6 = 0 THEN 2 WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END, NULL, NULL FROM base WHERE o_orderkey % 7 = 0)"""


def feed_lines(spark, sf_dir):
    """Change records of the order table as JSON text: snapshot, up to two updates, some deletes."""
    base = load(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", F.round(F.col("o_totalprice") * 100).cast("long").alias("cents")
    )
    key = F.col("o_orderkey")

    def row(status, cents_):
        return F.struct(key, status.alias("o_orderstatus"), cents_.alias("cents"))

    first = row(F.col("o_orderstatus"), F.col("cents"))
    second, third = row(F.lit("X"), F.col("cents") + 1), row(F.lit("Y"), F.col("cents") + 2)
    none = F.lit(None).cast("struct<o_orderkey: bigint, o_orderstatus: string, cents: bigint>")
    last = F.when(key % 6 == 0, third).when(key % 3 == 0, second).otherwise(first)

    def record(op, ms, before, after):
        return F.struct(
            before.alias("before"), after.alias("after"), F.lit(op).alias("op"), F.lit(ms).cast("long").alias("ts_ms"),
            F.struct(
                F.lit("shop").alias("db"), F.concat(F.lit("orders_"), key % 2).alias("table"),
                (key * 10 + ms).alias("pos"),
            ).alias("source"),
        )

    records = F.array(
        record("r", 1, none, first),
        F.when(key % 3 == 0, record("u", 2, first, second)),
        F.when(key % 6 == 0, record("u", 3, second, third)),
        F.when(key % 7 == 0, record("d", 4, last, none)),
    )
    exploded = base.select(F.explode(F.filter(records, lambda r: r.isNotNull())).alias("r"))
    return exploded.select(F.to_json("r", {"ignoreNullFields": "false"}).alias("value"))


KEY_DDL = "o_orderkey BIGINT"


def _feed(spark, sf_dir, after=ROW_DDL, before=None):
    return ch.split_schema_changes(ch.parse_changes(feed_lines(spark, sf_dir), after, before=before)[0])[0]


@query(
    f"""WITH {FEED}, last_ AS (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY ts_ms DESC) AS rn FROM feed)
    SELECT o_orderkey, a_status AS o_orderstatus, a_cents AS cents FROM last_ WHERE rn = 1 AND op <> 'd'"""
)
def cdc_current(spark, sf_dir):
    """Snapshot rows and the logged changes since, folded into the current table."""
    snapshot = load(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", F.round(F.col("o_totalprice") * 100).cast("long").alias("cents")
    )
    return cl.apply_changes(snapshot, ch.starting(_feed(spark, sf_dir, before=KEY_DDL), "earliest"), ["o_orderkey"])


@query(
    f"""WITH {FEED}
    SELECT ts_ms, TRUE AS is_add, o_orderkey, a_status AS o_orderstatus, a_cents AS cents FROM feed WHERE op <> 'd'
    UNION ALL SELECT ts_ms, FALSE, o_orderkey, b_status, b_cents FROM feed WHERE op IN ('u', 'd')"""
)
def cdc_changelog(spark, sf_dir):
    changes = cl.changes_to_changelog(_feed(spark, sf_dir))
    return changes.select(F.col("ts_ms").cast("int").alias("ts_ms"), "is_add", "o_orderkey", "o_orderstatus", "cents")


@query(f"WITH {FEED} SELECT op, CAST(count(*) AS BIGINT) AS n FROM feed WHERE ts_ms >= 3 AND o_orderkey % 2 = 0 GROUP BY op")
def cdc_table_from_time(spark, sf_dir):
    """One table of the feed, read from a point in time on."""
    part = ch.starting(ch.of_tables(_feed(spark, sf_dir, "", ""), ["shop.orders_0"]), "timestamp", 3)
    return part.groupBy("op").agg(F.count("*").alias("n"))


@query(f"WITH {FEED} SELECT max(o_orderkey * 10 + ts_ms) AS last_pos, o_orderkey FROM feed GROUP BY o_orderkey")
def cdc_last_change(spark, sf_dir):
    rows = _feed(spark, sf_dir, KEY_DDL, KEY_DDL).withColumn("o_orderkey", F.coalesce("after.o_orderkey", "before.o_orderkey"))
    return cl.current_rows(rows, ["o_orderkey"]).select("o_orderkey", F.col("pos").alias("last_pos"))


@query(
    """WITH s AS (SELECT min(o_orderkey) AS lo, max(o_orderkey) AS hi, count(*) AS c FROM orders),
    p AS (SELECT lo, hi, CAST(floor((hi - lo + 1) / c * 1000) AS BIGINT) AS step FROM s)
    SELECT i AS chunk, CASE WHEN i > 0 THEN lo + i * step END AS low,
      CASE WHEN i < (hi - lo) // step THEN lo + (i + 1) * step END AS high
    FROM p, LATERAL (SELECT unnest(generate_series(0, (hi - lo) // step)) AS i)"""
)
def key_chunks(spark, sf_dir):
    return key_ranges(load(spark, sf_dir, "orders"), "o_orderkey", 1000)


@query(
    """WITH k AS (SELECT o_orderkey * o_orderkey AS key, row_number() OVER (ORDER BY o_orderkey) AS r FROM orders),
    c AS (SELECT (r - 1) // 1000 AS chunk, key AS low FROM k WHERE r > 1 AND (r - 1) % 1000 = 0
      UNION ALL SELECT 0, NULL)
    SELECT CAST(chunk AS BIGINT) AS chunk, low, lead(low) OVER (ORDER BY chunk) AS high FROM c"""
)
def key_chunks_uneven(spark, sf_dir):
    """Keys too unevenly spread for arithmetic: ranges of 1000 keys each."""
    sparse = load(spark, sf_dir, "orders").select((F.col("o_orderkey") * F.col("o_orderkey")).alias("key"))
    return key_ranges(sparse, "key", 1000)


@query(
    """WITH k AS (SELECT c_name AS name, row_number() OVER (ORDER BY c_name) AS r FROM (SELECT DISTINCT c_name FROM customer)),
    c AS (SELECT (r - 1) // 100 AS chunk, name AS low FROM k WHERE r > 1 AND (r - 1) % 100 = 0 UNION ALL SELECT 0, NULL)
    SELECT CAST(chunk AS BIGINT) AS chunk, low, lead(low) OVER (ORDER BY chunk) AS high FROM c"""
)
def key_chunks_text(spark, sf_dir):
    """Ranges of a text key."""
    return key_ranges(load(spark, sf_dir, "customer"), "c_name", 100)


#: What a feed holds besides row changes: a line cut short, and a change of a table's columns.
CUT_SHORT = '{"before": null, "after": {"o_orderkey": '
COLUMN_ADDED = '{"source": {"db": "shop", "table": "orders_0", "pos": %d}, "ts_ms": %d, "ddl": "ALTER TABLE orders_0 ADD COLUMN note TEXT"}'


def feed_files(spark, sf_dir, files=None):
    """The feed written as text once, dealt to ``files`` files; every hundredth order key adds a cut line and, if even, a schema event."""
    orders = load(spark, sf_dir, "orders").where(F.col("o_orderkey") % 100 == 0)
    cut = orders.select(F.concat(F.lit(CUT_SHORT), "o_orderkey").alias("value"))
    added = orders.where(F.col("o_orderkey") % 200 == 0).select(
        F.format_string(COLUMN_ADDED, F.col("o_orderkey") * 10 + 2, F.lit(2)).alias("value")
    )
    path = scratch(spark, "feed")
    lines = feed_lines(spark, sf_dir).unionByName(cut).unionByName(added)
    (lines.repartition(files) if files else lines).write.text(path)
    return path


CURRENT = f"""WITH {FEED}, last_ AS (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY ts_ms DESC) AS rn FROM feed)
    SELECT o_orderkey, a_status AS o_orderstatus, a_cents AS cents FROM last_ WHERE rn = 1 AND op <> 'd'"""


@query(CURRENT)
def cdc_files_current(spark, sf_dir):
    """A feed of text files, snapshot rows included, folded into the current table."""
    feed = ch.read_changes(spark, feed_files(spark, sf_dir), ROW_DDL)
    none = load(spark, sf_dir, "orders").where(F.lit(False)).select(
        "o_orderkey", "o_orderstatus", F.lit(0).cast("long").alias("cents")
    )
    return cl.apply_changes(none, feed.rows, ["o_orderkey"])


@query(f"SELECT '{CUT_SHORT}' || o_orderkey AS line FROM orders WHERE o_orderkey % 100 = 0")
def cdc_bad_lines(spark, sf_dir):
    """Lines of a feed that are no change records."""
    return ch.read_changes(spark, feed_files(spark, sf_dir), ROW_DDL).bad.select(F.col("value").alias("line"))


@query("SELECT 'orders_0' AS tab, o_orderkey * 10 + 2 AS pos FROM orders WHERE o_orderkey % 200 = 0")
def cdc_schema_events(spark, sf_dir):
    """Changes of table columns, as an output of their own."""
    feed = ch.read_changes(spark, feed_files(spark, sf_dir), ROW_DDL, ["shop.orders_0"], "earliest")
    return feed.schema_events.select(F.col("source.table").alias("tab"), F.col("source.pos").alias("pos"))


#: How often a feed position counts a key: all changes of one time lie before those of the next.
TIMES = 10_000_000_000


def _timed_feed(spark, sf_dir, before=None):
    """The row changes with positions in order of time."""
    feed = _feed(spark, sf_dir, before=before).withColumn("o_orderkey", F.coalesce("after.o_orderkey", "before.o_orderkey"))
    return feed.withColumn("pos", F.col("ts_ms") * TIMES + F.col("o_orderkey"))


@query(CURRENT)
def cdc_chunked_snapshot(spark, sf_dir):
    """A snapshot read range by range, each range at another time and not at one moment, brought together with the log.

    Range ``c`` is read between time ``1 + c % 4`` and the next; of its rows the even keys show the later state.
    """
    # read by several passes (snapshot, cells of the ordered pass, the pass itself): the text is made and parsed for all of them once
    feed = settled(_timed_feed(spark, sf_dir, KEY_DDL).select("o_orderkey", "op", "ts_ms", "pos", "before", "after"), True, "feed")
    chunks = key_ranges(load(spark, sf_dir, "orders"), "o_orderkey", 1000)
    at = 1 + F.col("chunk") % 4
    ranges = chunks.withColumns({"low_pos": (at + 1) * TIMES - 1, "high_pos": (at + 2) * TIMES - 1})
    first, step = chunks.where("low is not null").agg(F.min("low"), F.min(F.col("high") - F.col("low"))).first()
    chunk = F.lit(0) if first is None else F.floor((F.col("o_orderkey") - first) / (step or 1)) + 1
    chunk = F.least(F.greatest(chunk, F.lit(0)), F.lit(chunks.count() - 1))
    seen = feed.where(F.col("ts_ms") <= 1 + chunk % 4 + F.when(F.col("o_orderkey") % 2 == 0, 1).otherwise(0))
    snapshot = cl.current_rows(seen.select("o_orderkey", "op", "pos", "after"), ["o_orderkey"], ["pos"]).where("op <> 'd'").select("after.*")
    return cl.reconcile_chunks(snapshot, ranges, feed.where("op <> 'r'").drop("o_orderkey"), "o_orderkey")


@query(
    f"""WITH {FEED}, last_ AS (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY ts_ms DESC) AS rn FROM feed)
    SELECT o_orderkey, CAST(a_cents AS DECIMAL(20, 0)) AS amount, CASE WHEN ts_ms >= 2 THEN 'note ' || ts_ms END AS note
    FROM last_ WHERE rn = 1 AND op <> 'd'"""
)
def cdc_schema_applied(spark, sf_dir):
    """A feed whose table gains a column, has one renamed and retyped and loses one, folded into the table of the end."""
    feed = _timed_feed(spark, sf_dir)

    def image(name):
        row, key, late = F.col(name), F.col("o_orderkey"), F.col("ts_ms") >= 3
        fields = F.struct(
            key.alias("o_orderkey"), F.when(~late, row["o_orderstatus"]).alias("o_orderstatus"), F.when(~late, row["cents"]).alias("cents"),
            F.when(late, row["cents"]).alias("amount"), F.when(F.col("ts_ms") >= 2, F.format_string("note %d", "ts_ms")).alias("note"),
        )
        return F.when(row.isNotNull(), fields).alias(name)

    source = F.struct("source.db", "source.table", "pos").alias("source")
    rows = feed.select(image("before"), image("after"), "op", "ts_ms", source).select(F.to_json(F.struct("*")).alias("value"))
    statements = {
        2: "ADD COLUMN note STRING", 3: "RENAME COLUMN cents TO amount", 4: "DROP COLUMN o_orderstatus",
    }
    line = '{"source": {"db": "shop", "table": "orders", "pos": %d}, "ts_ms": %d, "ddl": "ALTER TABLE orders %s"}'
    events = [line % (ms * TIMES, ms, what) for ms, what in statements.items()]
    events.append(line % (4 * TIMES + 1, 4, "ALTER COLUMN amount TYPE DECIMAL(20, 0)"))
    lines = rows.unionByName(spark.createDataFrame([(e,) for e in events], "value STRING"))
    changes, _ = ch.parse_changes(lines.where(F.col("value").contains('"ddl"')), ROW_DDL)
    columns = ch.lineage(ROW_DDL, ch.column_changes(ch.split_schema_changes(changes)[1]))
    last = cl.current_rows(
        ch.parse_evolving(lines, columns).withColumn("o_orderkey", F.coalesce("after.o_orderkey", "before.o_orderkey")), ["o_orderkey"], ["pos"]
    )
    return last.where("op <> 'd'").select("after.*")


STARTS = {"initial": None, "earliest": None, "never": None, "timestamp": 3, "offset": 20_003, "latest": 20_003}


@query(
    f"""WITH {FEED}, log_ AS (SELECT *, o_orderkey * 10 + ts_ms AS pos FROM feed)
    SELECT 'initial' AS start, CAST(count(*) AS BIGINT) AS n FROM log_
    UNION ALL SELECT 'earliest', count(*) FROM log_ WHERE op <> 'r' UNION ALL SELECT 'never', count(*) FROM log_ WHERE op <> 'r'
    UNION ALL SELECT 'timestamp', count(*) FROM log_ WHERE op <> 'r' AND ts_ms >= 3
    UNION ALL SELECT 'offset', count(*) FROM log_ WHERE op <> 'r' AND pos >= 20003
    UNION ALL SELECT 'latest', count(*) FROM log_ WHERE op <> 'r' AND pos > 20003"""
)
def cdc_start_modes(spark, sf_dir):
    """How many row changes each start mode reads of the same feed, two tables by name."""
    path, counts = feed_files(spark, sf_dir), None
    for start, at in STARTS.items():
        rows = ch.read_changes(spark, path, ROW_DDL, ["shop.orders_0", "shop.orders_1"], start, at).rows
        one = rows.agg(F.count("*").alias("n")).select(F.lit(start).alias("start"), "n")
        counts = one if counts is None else counts.unionByName(one)
    return counts


@query("SELECT user_id, event_id AS page_id, event_type AS status FROM events WHERE event_type = 'purchase'")
def json_topic_filter(spark, sf_dir):
    """A table declared by DDL over JSON messages, filtered in SQL."""
    events = load(spark, sf_dir, "events").select("user_id", F.col("event_id").alias("page_id"), F.col("event_type").alias("status"))
    name = f"page_status_{uuid.uuid4().hex[:10]}"
    topics.declare_table(spark, name, "user_id BIGINT, page_id BIGINT, status STRING", topics.json_values(events))
    bought = spark.sql(f"SELECT user_id, page_id, status FROM {name} WHERE status = 'purchase'")
    spark.catalog.dropTempView(name)
    return bought


@query("SELECT c_custkey AS id, c_name AS name FROM customer WHERE c_acctbal > 9000")
def view_over_table(spark, sf_dir):
    name = f"buyers_{uuid.uuid4().hex[:10]}"
    as_view(load(spark, sf_dir, "customer"), name, {"id": "c_custkey", "name": "c_name", "balance": "c_acctbal"})
    rich = spark.sql(f"SELECT id, name FROM {name} WHERE balance > 9000")
    spark.catalog.dropTempView(name)
    return rich
