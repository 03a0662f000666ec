"""Text, scalar, routing and aggregate queries."""

import uuid

from pyspark.sql import functions as F

from sparkstream.functions import scalars as sc
from sparkstream.functions import text as tx
from sparkstream.operators import aggregate as ag
from sparkstream.operators import heavy as hv
from sparkstream.operators import routing as rt
from sparkstream.operators.accumulate import Accumulator, accumulate
from sparkstream.plans.scan import settled
from sparkstream.queries.registry import query
from sparkstream.sources import basic as src
from sparkstream.streaming import sinks as sk
from sparkstream.tables import load, path_of

BANNED = ["the", "of", "and", "la", "le"]

WORDS = "SELECT unnest(string_split(rtrim(text, ' '), ' ')) AS word FROM documents"


@query(f"SELECT word, CAST(count(*) AS BIGINT) AS cnt FROM ({WORDS}) GROUP BY word")
def word_count(spark, sf_dir):
    pairs = tx.split_pairs(load(spark, sf_dir, "documents"), "text")
    return ag.keyed_sum(pairs, ["word"], F.col("cnt"), "cnt")


@query(
    f"""SELECT word, CAST(count(*) AS BIGINT) AS cnt FROM ({WORDS})
    WHERE word NOT IN ('the', 'of', 'and', 'la', 'le') GROUP BY word"""
)
def word_count_excluding(spark, sf_dir):
    words = tx.exclude(tx.tokenize(load(spark, sf_dir, "documents"), "text"), "word", BANNED)
    return ag.keyed_sum(tx.pair_one(words), ["word"], F.col("cnt"), "cnt")


@query(
    f"""SELECT word, CAST(count(*) AS BIGINT) AS cnt FROM ({WORDS}) w
    WHERE NOT EXISTS (SELECT 1 FROM nation n WHERE n.n_name = w.word) AND word <> '' GROUP BY word"""
)
def word_count_excluding_table(spark, sf_dir):
    """The banned words come from a table; the list is broadcast only when it is counted and small."""
    words = tx.tokenize(load(spark, sf_dir, "documents"), "text").where(F.col("word") != "")
    kept = tx.exclude(words, "word", load(spark, sf_dir, "nation").select("n_name"))
    return ag.keyed_sum(tx.pair_one(kept), ["word"], F.col("cnt"), "cnt")


@query("SELECT doc_id, n_chars FROM documents WHERE contains(text, 'license')")
def contains_filter(spark, sf_dir):
    return tx.keep_containing(load(spark, sf_dir, "documents"), "text", "license").select("doc_id", "n_chars")


@query(r"SELECT doc_id, lang FROM documents WHERE regexp_matches(text, '[0-9]+')")
def regex_digits(spark, sf_dir):
    return tx.has_match(load(spark, sf_dir, "documents"), "text", "[0-9]+").select("doc_id", "lang")


@query("SELECT doc_id, lang FROM documents WHERE substr(text, 1, 1) = 'T'")
def prefix_filter(spark, sf_dir):
    return tx.has_prefix(load(spark, sf_dir, "documents"), "text", "T").select("doc_id", "lang")


@query("SELECT n_name || ':::' || CAST(n_regionkey AS VARCHAR) AS pair FROM nation")
def format_pairs(spark, sf_dir):
    return load(spark, sf_dir, "nation").select(tx.format_pair("n_name", "n_regionkey").alias("pair"))


@query("SELECT o_orderkey, bin(o_custkey) AS bits FROM orders")
def binary_text(spark, sf_dir):
    return load(spark, sf_dir, "orders").select("o_orderkey", tx.binary_text("o_custkey").alias("bits"))


@query("SELECT p_partkey, p_size FROM part WHERE p_size > 10")
def numeric_filter(spark, sf_dir):
    return sc.greater_than(load(spark, sf_dir, "part"), "p_size", 10).select("p_partkey", "p_size")


@query(
    """SELECT event_id, CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS BIGINT) AS k,
    CAST(NULL AS BIGINT) AS missing FROM events"""
)
def map_lookup(spark, sf_dir):
    tags = load(spark, sf_dir, "events").withColumn("tags", F.from_json("props", "MAP<STRING, BIGINT>"))
    return tags.select("event_id", sc.lookup("tags", "k").alias("k"), sc.lookup("tags", "absent").alias("missing"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at FROM events")
def millis_as_text(spark, sf_dir):
    events = load(spark, sf_dir, "events").withColumn("ms", F.unix_millis("ts"))
    return events.withColumn("t", sc.millis_to_time("ms")).select("event_id", sc.time_text("t").alias("at"))


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey,
    CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2)), 2) AS DOUBLE) AS saved
    FROM lineitem"""
)
def money_rounding(spark, sf_dir):
    saved = sc.money_round(sc.money("l_extendedprice") * F.col("l_discount").cast("decimal(4,2)"))
    return load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", saved.cast("double").alias("saved")
    )


@query(
    """SELECT p_brand, CAST(sum(CAST(l_quantity AS DECIMAL(10,0)) * CAST(p_retailprice AS DECIMAL(18,2))) AS DOUBLE)
    AS total FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand"""
)
def line_totals(spark, sf_dir):
    lines = load(spark, sf_dir, "lineitem").join(
        load(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")
    )
    totals = lines.withColumn("line_total", sc.line_total("l_quantity", "p_retailprice"))
    return ag.keyed_sum(totals, ["p_brand"], F.col("line_total")).select(
        "p_brand", F.col("total").cast("double").alias("total")
    )


@query(
    """SELECT CAST(time_bucket(INTERVAL '1 day', ts + INTERVAL '8 hours') - INTERVAL '8 hours' AS TIMESTAMP) AS day_start,
    CAST(count(*) AS BIGINT) AS n FROM events GROUP BY 1"""
)
def local_days(spark, sf_dir):
    """Events per calendar day of the zone UTC+8."""
    days = load(spark, sf_dir, "events").groupBy(sc.local_day("ts", 8).alias("w")).agg(F.count("*").alias("n"))
    return days.select(F.col("w.start").alias("day_start"), "n")


LINES = """SELECT CAST(user_id AS VARCHAR) || ',' ||
    CASE WHEN event_id % 10 = 0 THEN 'bug' ELSE regexp_extract(props, '"k": ([0-9]+)', 1) END AS line FROM events"""


def _lines(spark, sf_dir):
    number = F.when(F.col("event_id") % 10 == 0, F.lit("bug")).otherwise(
        F.regexp_extract("props", '"k": ([0-9]+)', 1)
    )
    return load(spark, sf_dir, "events").select(F.concat_ws(",", "user_id", number).alias("line"))


@query(
    f"""SELECT CAST(split_part(line, ',', 1) AS BIGINT) AS sensor, CAST(sum(CAST(split_part(line, ',', 2) AS INT)) AS BIGINT)
    AS total FROM ({LINES}) WHERE line NOT LIKE '%bug' GROUP BY 1"""
)
def parse_delimited(spark, sf_dir):
    clean, _ = sc.guard(_lines(spark, sf_dir), F.col("line").endswith("bug"), on="quarantine")
    rows = src.parse_delimited(clean, "sensor BIGINT, amount INT")
    return ag.keyed_sum(rows, ["sensor"], F.col("amount"))


@query(
    f"""SELECT CASE WHEN TRY_CAST(split_part(line, ',', 2) AS INT) IS NULL THEN 'bad' ELSE 'good' END AS kind,
    line AS detail, CAST(count(*) AS BIGINT) AS n FROM ({LINES}) GROUP BY 1, 2"""
)
def quarantine(spark, sf_dir):
    """Good rows and the lines set aside."""
    marked = src.parse_delimited_marked(_lines(spark, sf_dir), "sensor BIGINT, amount INT")
    bad = F.col(src.BAD_LINE)
    both = marked.select(
        F.when(bad.isNull(), "good").otherwise("bad").alias("kind"), F.coalesce(bad, F.concat_ws(",", "sensor", "amount")).alias("detail")
    )
    return both.groupBy("kind", "detail").agg(F.count("*").alias("n"))


@query(
    """SELECT s_suppkey AS id, s_name AS name FROM supplier WHERE s_acctbal > 5000
    UNION ALL SELECT c_custkey AS id, c_name AS name FROM customer WHERE c_acctbal < 100"""
)
def union_all_sql(spark, sf_dir):
    return spark.sql(
        "SELECT s_suppkey AS id, s_name AS name FROM {sellers} WHERE s_acctbal > 5000 "
        "UNION ALL SELECT c_custkey AS id, c_name AS name FROM {buyers} WHERE c_acctbal < 100",
        sellers=load(spark, sf_dir, "supplier"), buyers=load(spark, sf_dir, "customer"),
    )


@query("SELECT r_name AS name FROM region UNION ALL SELECT n_name AS name FROM nation UNION ALL SELECT r_name AS name FROM region")
def union_same_type(spark, sf_dir):
    regions = load(spark, sf_dir, "region").select(F.col("r_name").alias("name"))
    nations = load(spark, sf_dir, "nation").select(F.col("n_name").alias("name"))
    return rt.union(rt.union(regions, nations), regions)


@query(
    """SELECT 'String:' || c_name AS value FROM customer
    UNION ALL SELECT 'Long:' || CAST(s_suppkey AS VARCHAR) AS value FROM supplier"""
)
def connect_map(spark, sf_dir):
    return rt.connect_map(
        load(spark, sf_dir, "customer"), load(spark, sf_dir, "supplier"),
        F.concat(F.lit("String:"), "c_name"), F.concat(F.lit("Long:"), F.col("s_suppkey").cast("string")),
    )


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'even' ELSE 'odd' END AS tag FROM orders")
def split_even_odd(spark, sf_dir):
    orders = load(spark, sf_dir, "orders").select("o_orderkey")
    parts = rt.split_by(orders, {"even": sc.is_even("o_orderkey")}, rest="odd")
    return rt.union(*[part.withColumn("tag", F.lit(tag)) for tag, part in parts.items()])


@query(
    """SELECT CAST(CASE WHEN l_suppkey % 10 = 0 THEN l_orderkey % 3 ELSE 3 + l_suppkey % 5 END AS INT) AS partition,
    CAST(count(*) AS BIGINT) AS n FROM lineitem GROUP BY 1"""
)
def route_counts(spark, sf_dir):
    """Heavy suppliers over three partitions, the others over five: rows per partition."""
    rule = F.when(F.col("l_suppkey") % 10 == 0, F.col("l_orderkey") % 3).otherwise(3 + F.col("l_suppkey") % 5)
    return rt.partition_counts(rt.route(load(spark, sf_dir, "lineitem"), rule, 8))


REACH = 10_000


@query(
    f"""SELECT reach, CAST(count(*) AS BIGINT) AS n, TRUE AS within, CAST(4 AS BIGINT) AS partitions
    FROM (SELECT {REACH} // (1 + l_partkey % {REACH}) AS reach FROM lineitem)
    GROUP BY reach HAVING count(*) * 50 >= (SELECT count(*) FROM lineitem)"""
)
def heavy_spread(spark, sf_dir):
    """The keys that hold a fiftieth of the rows, found by a sketch and spread over four partitions each; the others are
    hashed. Their rows, whether the sketch's bounds hold, and the partitions they are in."""
    rows = load(spark, sf_dir, "lineitem").select(
        F.expr(f"{REACH} div (1 + l_partkey % {REACH})").alias("reach"), F.struct("l_orderkey", "l_linenumber").alias("id")
    )
    found = hv.heavy_keys(rows, "reach", 0.02)
    routed = rt.route(rows, rt.heavy_rule("reach", hv.is_heavy("reach", found), 4, 16, F.xxhash64("id")), 16)
    counts = routed.groupBy("reach", F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"))
    per_key = counts.groupBy("reach").agg(F.sum("n").alias("n"), F.count("*").alias("partitions"))
    bounds = spark.createDataFrame([tuple(f) for f in found], "reach BIGINT, low BIGINT, high BIGINT")
    return per_key.join(F.broadcast(bounds), "reach").where(F.col("n") * 50 >= rows.count()).select(
        "reach", "n", F.col("n").between(F.col("low"), F.col("high")).alias("within"), "partitions"
    )


@query("SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(4 AS BIGINT) AS partitions, TRUE AS even FROM lineitem WHERE l_quantity > 10")
def rebalance_skew(spark, sf_dir):
    """After a filter, rows are dealt out again; sizes differ by no more than the tasks that dealt."""
    kept = sc.greater_than(load(spark, sf_dir, "lineitem"), "l_quantity", 10)
    counts = rt.partition_counts(rt.rebalance(kept.select("l_orderkey"), 4))
    return counts.agg(
        F.sum("n").alias("n_rows"), F.count("*").alias("partitions"),
        (F.max("n") - F.min("n") <= 0.01 * F.sum("n") + 8).alias("even"),
    )


@query("SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(1 AS BIGINT) AS partitions FROM lineitem")
def global_placement(spark, sf_dir):
    """A small result in one partition: the counts of all tasks."""
    counts = rt.to_one(rt.partition_counts(load(spark, sf_dir, "lineitem")))
    return counts.groupBy(F.spark_partition_id()).agg(F.sum("n").alias("n")).agg(
        F.sum("n").alias("n_rows"), F.count("*").alias("partitions")
    )


@query("SELECT CAST(count(*) AS BIGINT) AS n_rows, TRUE AS unmoved FROM lineitem")
def forward_rows(spark, sf_dir):
    """Rows that stay in the partitions they are read in."""
    before = load(spark, sf_dir, "lineitem").withColumn("was", F.spark_partition_id())
    after = rt.forward(before).select((F.spark_partition_id() == F.col("was")).alias("same"))
    return after.agg(F.count("*").alias("n_rows"), F.every("same").alias("unmoved"))


@query("SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(4 AS BIGINT) AS partitions, TRUE AS mixed FROM lineitem")
def shuffle_random(spark, sf_dir):
    """Random placement: all partitions get about the same share."""
    counts = rt.partition_counts(rt.shuffle(load(spark, sf_dir, "lineitem").select("l_orderkey"), 4))
    share = F.max(F.abs(F.col("n") * 4 - F.lit(0)))
    return counts.agg(
        F.sum("n").alias("n_rows"), F.count("*").alias("partitions"), (share <= 1.2 * F.sum("n") + 8).alias("mixed")
    )


@query("SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(2 AS BIGINT) AS partitions FROM lineitem")
def rescale_rows(spark, sf_dir):
    """Eight partitions brought to two without another shuffle."""
    dealt = rt.rebalance(load(spark, sf_dir, "lineitem").select("l_orderkey"), 8)
    counts = rt.partition_counts(rt.rescale(dealt, 2))
    return counts.agg(F.sum("n").alias("n_rows"), F.count("*").alias("partitions"))


@query(
    """SELECT o_orderkey, o_orderstatus IS NOT NULL AS taken, o_orderstatus
    FROM (SELECT unnest(range(min(o_orderkey), max(o_orderkey) + 1)) AS o_orderkey FROM orders) LEFT JOIN orders USING (o_orderkey)"""
)
def sequence_range(spark, sf_dir):
    """Whole numbers from the first order key to the last, both included, looked up as order keys."""
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    low, high = orders.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    keys = src.sequence(spark, low, high, "o_orderkey") if low is not None else orders.select("o_orderkey")
    return keys.join(orders, "o_orderkey", "left").select(
        "o_orderkey", F.col("o_orderstatus").isNotNull().alias("taken"), "o_orderstatus"
    )


@query("SELECT o_orderstatus, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY 1")
def catalog_counts(spark, sf_dir):
    """A table of the session's catalog, declared over the data where it lies."""
    name = f"orders_{uuid.uuid4().hex[:10]}"
    spark.catalog.createTable(name, path=path_of(sf_dir, "orders"), source="parquet", schema=load(spark, sf_dir, "orders").schema)
    counts = kept_rows(src.catalog_table(spark, name).groupBy("o_orderstatus").agg(F.count("*").alias("n")))
    spark.sql(f"DROP TABLE {name}")
    return counts


def kept_rows(df):
    return settled(df, True, "counts")


@query("SELECT CAST(count(*) AS BIGINT) AS n, max(o_totalprice) AS top FROM orders")
def shown_table(spark, sf_dir):
    """Rows printed with a label in front; what was printed first is part of the whole."""
    orders = load(spark, sf_dir, "orders")
    top = orders.agg(F.count("*").alias("n"), F.max("o_totalprice").alias("top"))
    sk.show_sink(top, "orders: ")
    return top


@query("SELECT CAST(i AS INT) AS copy, CAST(count(*) AS BIGINT) AS n FROM nation, range(3) AS r(i) GROUP BY i")
def replicate_rows(spark, sf_dir):
    return rt.replicate(load(spark, sf_dir, "nation"), 3).groupBy("copy").agg(F.count("*").alias("n"))


@query(
    """SELECT l_suppkey, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS qty FROM lineitem GROUP BY l_suppkey"""
)
def salted_two_step_sum(spark, sf_dir):
    """A sum in two steps over salted keys, for keys too heavy for one reducer."""
    return rt.salted_sum(
        load(spark, sf_dir, "lineitem"), ["l_suppkey"], F.col("l_quantity").cast("long"), F.col("l_orderkey"), 8, "qty"
    )


@query(
    """SELECT l_returnflag, l_linestatus, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS qty
    FROM lineitem GROUP BY l_returnflag, l_linestatus"""
)
def keyed_sum(spark, sf_dir):
    lines = load(spark, sf_dir, "lineitem")
    return ag.keyed_sum(lines, ["l_returnflag", "l_linestatus"], F.col("l_quantity").cast("long"), "qty")


@query(
    """SELECT o_custkey, string_agg(o_orderstatus, '' ORDER BY o_orderdate, o_orderkey) AS history
    FROM orders GROUP BY o_custkey"""
)
def keyed_reduce(spark, sf_dir):
    """A user-written associative step (joining texts), applied in order."""
    return ag.keyed_reduce(
        load(spark, sf_dir, "orders"), ["o_custkey"], "o_orderstatus", lambda a, b: F.concat(a, b),
        ["o_orderdate", "o_orderkey"], "history",
    )


@query("SELECT o_custkey, max(o_totalprice) AS max_price FROM orders GROUP BY o_custkey")
def keyed_max(spark, sf_dir):
    return ag.keyed_max(load(spark, sf_dir, "orders"), ["o_custkey"], "o_totalprice", "max_price")


@query(
    """SELECT o_custkey, o_orderkey, o_totalprice, o_orderpriority FROM (
      SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders)
    WHERE rn = 1"""
)
def keyed_max_by(spark, sf_dir):
    orders = load(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderpriority")
    return ag.keyed_max_by(orders, ["o_custkey"], "o_totalprice", ["o_orderkey"])


CENTS = "CAST(round(value * 100) AS BIGINT)"


def cents():
    return F.round(F.col("value") * 100).cast("long")


@query(
    f"""SELECT event_id, user_id, CAST(sum({CENTS}) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS total
    FROM events"""
)
def running_sum(spark, sf_dir):
    events = load(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    return ag.running_sum(events, ["user_id"], cents(), ["ts", "event_id"]).select("event_id", "user_id", "total")


@query(
    """SELECT event_id, user_id, value, max(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS max_value
    FROM events"""
)
def running_max(spark, sf_dir):
    events = load(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    best = ag.running_max(events, ["user_id"], F.col("value"), ["ts", "event_id"], "max_value")
    return best.select("event_id", "user_id", "value", "max_value")


@query(
    """SELECT o_orderpriority, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total,
    CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS mean FROM orders GROUP BY o_orderpriority"""
)
def custom_aggregate(spark, sf_dir):
    return ag.keyed_aggregate(
        load(spark, sf_dir, "orders"), ["o_orderpriority"],
        {"s": F.sum(sc.money("o_totalprice")).cast("double"), "n": F.count("*")},
        {"total": F.col("s"), "mean": F.col("s") / F.col("n")},
    )


def _largest(state, batch):
    prices = batch.column(0).drop_null().unique().to_pylist()
    return state[0] + batch.num_rows, sorted({*state[1], *prices}, reverse=True)[:3]


#: Rows, and the three largest different values.
LARGEST = Accumulator(
    create=lambda: (0, []), add=_largest,
    merge=lambda a, b: (a[0] + b[0], sorted({*a[1], *b[1]}, reverse=True)[:3]),
    result=lambda state: (state[0], state[1][0] if state[1] else None, state[1][-1] if state[1] else None),
    returns="n BIGINT, first_price DOUBLE, third_price DOUBLE",
)


@query(
    """SELECT l_returnflag, l_suppkey, CAST(count(*) AS BIGINT) AS n, max(p) AS first_price, min(p) FILTER (r <= 3) AS third_price
    FROM (SELECT *, l_extendedprice AS p, dense_rank() OVER (PARTITION BY l_returnflag, l_suppkey ORDER BY l_extendedprice DESC) AS r FROM lineitem)
    GROUP BY 1, 2"""
)
def user_accumulator(spark, sf_dir):
    """An accumulator of the user's own: the first and the third of each group's different prices."""
    return accumulate(load(spark, sf_dir, "lineitem"), ["l_returnflag", "l_suppkey"], ["l_extendedprice"], LARGEST)


@query(
    """SELECT o_custkey, CAST(count(*) AS BIGINT) AS frequency FROM orders
    GROUP BY o_custkey HAVING count(*) = 12"""
)
def having_filter(spark, sf_dir):
    counts = load(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("frequency"))
    return ag.having(counts, F.col("frequency") == 12)


@query(
    """SELECT o_custkey, CAST(count(o_orderkey) AS BIGINT) AS cnt, max(o_totalprice) AS max_value,
    min(o_totalprice) AS min_value FROM orders GROUP BY o_custkey"""
)
def count_max_min(spark, sf_dir):
    return ag.count_max_min(load(spark, sf_dir, "orders"), ["o_custkey"], "o_orderkey", "o_totalprice")


@query("SELECT o_orderstatus, CAST(count(*) AS BIGINT) AS cnt FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1")
def sql_group(spark, sf_dir):
    return spark.sql(
        "SELECT o_orderstatus, count(*) AS cnt FROM {placed} WHERE o_orderpriority = '1-URGENT' GROUP BY o_orderstatus",
        placed=load(spark, sf_dir, "orders"),
    )


@query("SELECT bit_xor(xor(o_orderkey, o_custkey)) AS missing FROM orders")
def xor_diff(spark, sf_dir):
    return ag.xor_diff(load(spark, sf_dir, "orders"), "o_orderkey", "o_custkey")
