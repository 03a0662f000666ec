"""Readers, change feeds, key ranges and batch sinks."""

import gzip
import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sparkstream.operators import changelog as cl
from sparkstream.sources import basic as src
from sparkstream.sources import changes as ch
from sparkstream.sources import jdbc, topics
from sparkstream.streaming import sinks as sk


def test_rows_sequence_and_views(spark):
    assert src.sequence(spark, 1, 10).agg(F.min("value"), F.max("value"), F.count("*")).first() == (1, 10, 10)
    rows = src.from_rows(spark, [(1, "beer", 3), (2, "pen", 1)], "user BIGINT, product STRING, amount INT")
    src.as_view(rows, "orders_a", {"buyer": "user", "what": "product"})
    assert spark.sql("SELECT buyer FROM orders_a WHERE what = 'pen'").first().buyer == 2
    src.as_view(rows, "orders_b", ["user", "amount"])
    assert src.catalog_table(spark, "orders_b").columns == ["user", "amount"]


def test_lines_from_file_directory_and_gzip(spark, tmp_path):
    folder = tmp_path / "dir"
    folder.mkdir()
    (folder / "one.txt").write_text("a b\n")
    (folder / "two.txt").write_text("c\nd\n")
    packed = tmp_path / "words.txt.gz"
    with gzip.open(packed, "wt") as out:
        out.write("x\ny\n")
    assert src.read_lines(spark, str(folder / "one.txt")).count() == 1
    assert src.read_lines(spark, str(folder)).count() == 3
    assert src.read_lines(spark, str(packed)).count() == 2
    assert src.read_lines(spark, [str(folder), str(packed)]).count() == 5


def test_delimited_lines(spark, tmp_path):
    df = spark.createDataFrame([("9,3",), ("4,9",)], "line STRING")
    assert src.parse_delimited(df, "sensor STRING, n INT").collect() == [("9", 3), ("4", 9)]
    broken = spark.createDataFrame([("9,x",), ("4",), ("1,2",)], "line STRING")
    for one in (broken.where("line = '9,x'"), broken.where("line = '4'")):
        with pytest.raises(Exception):
            src.parse_delimited(one, "sensor STRING, n INT").collect()
    good, bad = src.parse_delimited_or_set_aside(broken, "sensor STRING, n INT")
    assert good.collect() == [("1", 2)] and sorted(r.line for r in bad.collect()) == ["4", "9,x"]
    piped = spark.createDataFrame([("a|1",)], "line STRING")
    assert src.parse_delimited(piped, "k STRING, n INT", "|").collect() == [("a", 1)]
    (tmp_path / "cars.csv").write_text("9,3\n4,9\n")
    assert src.read_delimited_files(spark, str(tmp_path / "cars.csv"), "sensor STRING, n INT").count() == 2


def test_topic_options_and_stand_in(spark, tmp_path):
    options = topics.topic_options("host:9092", "t1", group="g")
    assert options["startingOffsets"] == "latest" and options["subscribe"] == "t1" and options["kafka.group.id"] == "g"
    assert topics.topic_sink_options("host:9092", "t2")["topic"] == "t2"
    values = [json.dumps({"user_id": i, "page_id": i * 2, "status": "success" if i % 2 else "fail"}) for i in range(4)]
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "0.json").write_text("".join(json.dumps({"value": v, "topic": "t1"}) + "\n" for v in values))
    topic = topics.read_topic_files(spark, str(tmp_path / "t"), streaming=False)
    topics.declare_table(spark, "pages_in", "user_id BIGINT, page_id BIGINT, status STRING", topic)
    assert sorted(r.page_id for r in spark.sql("SELECT * FROM pages_in WHERE status = 'success'").collect()) == [2, 6]
    bad = spark.createDataFrame([("not json",)], "value STRING")
    assert topics.json_rows(bad, "a INT", "null").first().a is None
    with pytest.raises(Exception):
        topics.json_rows(bad, "a INT").collect()


ROW = "id BIGINT, name STRING"


def record(op, ms, before, after, pos, table="people", db="shop"):
    row = lambda r: None if r is None else {"id": r[0], "name": r[1]}
    source = {"db": db, "table": table, "pos": pos}
    return json.dumps({"before": row(before), "after": row(after), "op": op, "ts_ms": ms, "source": source})


FEED = [
    record("r", 1, None, (1, "a"), 1), record("r", 1, None, (2, "b"), 2), record("u", 5, (1, "a"), (1, "c"), 3),
    record("d", 6, (2, "b"), None, 4), record("c", 7, None, (3, "z"), 5), record("c", 7, None, (9, "q"), 6, "other"),
    record("u", 7, (3, "z"), (3, "y"), 7), record(None, 8, None, None, 8), "{broken",
]


def feed(spark):
    return ch.parse_changes(spark.createDataFrame([(x,) for x in FEED], "value STRING"), ROW)


def test_change_feed_parsing_and_choice(spark):
    good, bad = feed(spark)
    assert good.count() == 8 and [r.value for r in bad.collect()] == ["{broken"]
    rows, schema_changes = ch.split_schema_changes(good)
    assert rows.count() == 7 and schema_changes.count() == 1
    people = ch.of_tables(rows, ["shop.people"])
    assert people.count() == 6
    count = lambda mode, at=None: ch.starting(people, mode, at).count()
    assert (count("initial"), count("earliest"), count("never")) == (6, 4, 4)
    assert (count("timestamp", 6), count("offset", 4), count("latest", 5)) == (3, 3, 1)
    with pytest.raises(ValueError):
        ch.starting(people, "timestamp")


def test_changes_applied_to_a_snapshot(spark):
    people = ch.of_tables(ch.split_schema_changes(feed(spark)[0])[0], ["shop.people"])
    snapshot = people.where("op = 'r'").select("after.*")
    now = cl.apply_changes(snapshot, ch.starting(people, "earliest"), ["id"])
    assert sorted(tuple(r) for r in now.collect()) == [(1, "c"), (3, "y")]
    log = cl.changes_to_changelog(people)
    assert sorted((r.is_add, r.id, r.name) for r in log.collect()) == [
        (False, 1, "a"), (False, 2, "b"), (False, 3, "z"),
        (True, 1, "a"), (True, 1, "c"), (True, 2, "b"), (True, 3, "y"), (True, 3, "z"),
    ]
    assert sorted(tuple(r) for r in cl.replay(log, ["id", "name"]).collect()) == [(1, "c"), (3, "y")]


def test_update_that_moves_a_key(spark):
    lines = [record("u", 2, (1, "a"), (5, "a"), 1), record("u", 3, (7, "k"), (7, "m"), 2)]
    good, _ = ch.parse_changes(spark.createDataFrame([(x,) for x in lines], "value STRING"), ROW)
    snapshot = spark.createDataFrame([(1, "a"), (7, "k")], ROW)
    now = cl.apply_changes(snapshot, cl.moved_keys(good, ["id"]), ["id"])
    assert sorted(tuple(r) for r in now.collect()) == [(5, "a"), (7, "m")]


def ranges(df, size):
    return [(r.low, r.high) for r in jdbc.key_ranges(df, "id", size).orderBy("chunk").collect()]


def test_key_ranges(spark):
    assert ranges(spark.range(1, 11), 3) == [(None, 4), (4, 7), (7, 10), (10, None)]
    assert ranges(spark.range(1, 4), 8) == [(None, None)]
    sparse = spark.range(1, 11).select((F.col("id") * 100_000).alias("id"))
    assert ranges(sparse, 4) == [(None, 500_000), (500_000, 900_000), (900_000, None)]


def test_ranges_cover_every_key_once(spark, layout):
    keys = spark.range(0, 300).select((F.col("id") * F.col("id") * 7).alias("id"))
    cuts = jdbc.key_ranges(keys, "id", 40)
    inside = (F.col("low").isNull() | (F.col("id") >= F.col("low"))) & (F.col("high").isNull() | (F.col("id") < F.col("high")))
    per_chunk = keys.join(F.broadcast(cuts), inside).groupBy("chunk").count().collect()
    assert sum(r["count"] for r in per_chunk) == 300 and max(r["count"] for r in per_chunk) <= 40
    texts = jdbc.range_predicates(cuts, "id")
    assert texts[0].startswith("id < ") and texts[-1].startswith("id >= ")
    assert sum(keys.where(p).count() for p in texts) == 300


def test_ranges_of_other_key_types(spark, layout):
    texts = spark.range(50).select(F.format_string("key'%03d", "id").alias("id"))
    times = spark.range(50).select(F.timestamp_seconds(F.col("id") * 1000).alias("id"))
    for keys in (texts, times):
        cuts = jdbc.key_ranges(keys, "id", 20)
        assert cuts.count() == 3
        assert [keys.where(p).count() for p in jdbc.range_predicates(cuts, "id")] == [20, 20, 10]
    many = spark.range(10_500).select(F.col("id").alias("chunk"), F.col("id").alias("low"), (F.col("id") + 1).alias("high"))
    assert len(jdbc.range_predicates(many, "k")) == 10_500


def test_feed_with_bad_lines_and_schema_events(spark, tmp_path):
    (tmp_path / "feed.json").write_text("\n".join(FEED))
    feed_ = ch.read_changes(spark, str(tmp_path), ROW, ["shop.people"], "offset", 4)
    assert sorted(r.pos for r in feed_.rows.collect()) == [4, 5, 7]
    assert [r.value for r in feed_.bad.collect()] == ["{broken"] and [r.pos for r in feed_.schema_events.collect()] == [8]


def test_text_sink_writer_count(spark, tmp_path):
    lines = spark.createDataFrame([("one two",), ("three",), ("four",), ("five",)], "line STRING")
    for n in (1, 2):
        target = sk.write_text(lines, str(tmp_path / f"out{n}"), n)
        assert len([f for f in os.listdir(target) if f.startswith("part-")]) == n
        assert sorted(r.line for r in src.read_lines(spark, target).collect()) == ["five", "four", "one two", "three"]
    stamped = sk.write_text(lines, str(tmp_path / "out"), 1, datetime(2021, 5, 6, 7, 8, 9))
    assert stamped.endswith("out-20210506070809")


def test_only_the_columns_named_are_parsed(spark):
    lines = spark.createDataFrame([(x,) for x in FEED], "value STRING")
    whole = ch.parse_changes(lines, ROW)[0]
    some, bad = ch.parse_changes(lines, ROW, before="id BIGINT")
    assert some.schema["before"].dataType.names == ["id"] and some.columns == whole.columns
    same = whole.withColumn("before", F.when(F.col("before").isNotNull(), F.struct("before.id")))
    assert sorted(map(str, some.collect())) == sorted(map(str, same.collect())) and bad.count() == ch.parse_changes(lines, ROW)[1].count()
    none = ch.parse_changes(lines, "", before="")[0]
    assert not {"before", "after"} & set(none.columns) and none.count() == whole.count()


def test_insert_from_itself_doubles_rows(spark):
    spark.sql("CREATE TABLE people (id BIGINT, name STRING) USING parquet")
    sk.insert_into(spark.createDataFrame([(1, "a"), (2, "b")], ROW), "people", writers=2)
    spark.sql("INSERT INTO people SELECT * FROM people")
    assert src.catalog_table(spark, "people").count() == 4


def test_log_is_folded_and_keeps_the_latest(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sk, "FOLD_EVERY", 3)
    log = str(tmp_path / "log")
    batches = [[("a", 1)], [("b", 5)], [("a", 2)], [("c", 3)], [("b", 4)], [("d", 9)]]
    for batch, rows in enumerate(batches):
        sk.append_to_log(spark.createDataFrame(rows, "k STRING, v INT"), log, ["k"], ["v"], batch)
    monkeypatch.setattr(sk, "FOLD_EVERY", 5)  # the log keeps the number it was begun with
    got = sk.latest_rows(spark, log, ["k"], ["v"])
    assert sorted(tuple(r) for r in got.collect()) == [("a", 2), ("b", 5), ("c", 3), ("d", 9)]
    assert spark.read.parquet(f"{log}/batch_id=3").count() == 3
    assert sorted(r.k for r in sk.log_before(spark, log, 5).select("k").distinct().collect()) == ["a", "b", "c"]


def test_a_log_that_is_not_folded_is_read_whole(spark, tmp_path):
    log = str(tmp_path / "log")
    for batch, rows in {0: [("a", 1)], 49: [("b", 5)], 50: [("c", 2)]}.items():
        sk.write_batch(spark.createDataFrame(rows, "k STRING, v INT"), log, batch)
    assert sorted(tuple(r) for r in sk.latest_rows(spark, log, ["k"]).collect()) == [("a", 1), ("b", 5), ("c", 2)]


def test_show_sink_prints_a_label(spark, capsys):
    sk.show_sink(spark.range(1), "odd:")
    assert "odd:" in capsys.readouterr().out


def test_chunks_read_while_changes_arrive(spark):
    """Every range is read at its own time; the log decides what changed since, in all orders of reading and changing."""
    ddl = "k BIGINT, v STRING"
    row = "STRUCT<k: BIGINT, v: STRING>"
    log = [
        ("u", (1, "a"), (1, "b"), 5), ("d", (2, "a"), None, 6), ("c", None, (3, "new"), 7), ("u", (12, "a"), (12, "b"), 8),
        ("d", (13, "a"), None, 15), ("c", None, (14, "new"), 16), ("u", (15, "a"), (15, "b"), 25), ("u", (4, "a"), (16, "moved"), 30),
        ("d", (21, "a"), None, 35),
    ]
    changes = spark.createDataFrame(log, f"op STRING, before {row}, after {row}, pos BIGINT")
    # range ..10 is read in 4 .. 7, before and after its changes; range 10 .. 20 in 10 .. 20; range 20 .. in 40 .. 41, after all
    ranges = spark.createDataFrame(
        [(0, None, 10, 4, 7), (1, 10, 20, 10, 20), (2, 20, None, 40, 41)], "chunk BIGINT, low BIGINT, high BIGINT, low_pos BIGINT, high_pos BIGINT"
    )
    read = [(1, "b"), (2, "a"), (4, "a"), (5, "a"), (12, "b"), (13, "a"), (14, "new"), (15, "a"), (20, "a")]
    got = cl.reconcile_chunks(spark.createDataFrame(read, ddl), ranges, changes, "k")
    want = {(1, "b"), (3, "new"), (5, "a"), (12, "b"), (14, "new"), (15, "b"), (16, "moved"), (20, "a")}
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)
    one = spark.createDataFrame([(0, None, None, 0, 40)], ranges.schema)
    whole = cl.reconcile_chunks(spark.createDataFrame([(1, "a"), (5, "a")], ddl), one, changes, "k")
    assert ("d" not in whole.columns) and {(1, "b"), (5, "a"), (16, "moved")} <= {tuple(r) for r in whole.collect()}
    none = cl.reconcile_chunks(spark.createDataFrame([], ddl), one, changes.limit(0), "k")
    assert none.columns == ["k", "v"] and none.count() == 0


def test_column_changes_are_applied(spark):
    def line(op, pos, before, after):
        return json.dumps({"op": op, "before": before, "after": after, "ts_ms": pos, "source": {"db": "d", "table": "t", "pos": pos}})

    def ddl(pos, text):
        return json.dumps({"ddl": text, "ts_ms": pos, "source": {"db": "d", "table": "t", "pos": pos}})

    lines = [
        line("c", 1, None, {"id": 1, "a": "7", "b": "x"}), ddl(2, "ALTER TABLE t ADD COLUMN `n` INT"),
        line("c", 3, None, {"id": 2, "a": "8", "b": "y", "n": 5}), ddl(4, "alter table t rename column a to c;"),
        ddl(5, "ALTER TABLE t ALTER COLUMN c TYPE BIGINT"), ddl(6, "ALTER TABLE t DROP COLUMN b"),
        line("u", 7, {"id": 1, "c": 7, "n": None}, {"id": 1, "c": 9, "n": 1}), ddl(8, "ALTER TABLE t ADD COLUMN b DATE"),
        line("c", 9, None, {"id": 3, "c": 1, "n": 2, "b": "2024-01-02"}), ddl(8, "ALTER TABLE t ADD COLUMN b DATE"),
    ]
    text = spark.createDataFrame([(v,) for v in lines], "value STRING")
    rows, events = ch.split_schema_changes(ch.parse_changes(text, "id BIGINT, a STRING, b STRING")[0])
    assert events.count() == 6
    columns = ch.lineage("id BIGINT, a STRING, b STRING", ch.column_changes(events))
    assert [(c.name, c.kind) for c in columns] == [("id", "BIGINT"), ("c", "BIGINT"), ("n", "INT"), ("b", "DATE")]
    got = {r.pos: r for r in ch.parse_evolving(text, columns).collect()}
    assert tuple(got[1].after) == (1, 7, None, None) and tuple(got[3].after) == (2, 8, 5, None)
    assert tuple(got[7].before) == (1, 7, None, None) and tuple(got[7].after) == (1, 9, 1, None)
    assert str(got[9].after.b) == "2024-01-02" and got[9].before is None
    with pytest.raises(ValueError, match="not there"):
        ch.lineage("id BIGINT", ch.column_changes(events))
    odd = ch.parse_changes(spark.createDataFrame([(ddl(1, "TRUNCATE TABLE t"),)], "value STRING"), "id BIGINT")[0]
    with pytest.raises(Exception, match="no change of a column"):
        ch.column_changes(odd).collect()
