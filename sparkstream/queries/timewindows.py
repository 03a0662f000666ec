"""Window, dashboard and lateness queries over the event table."""

from pyspark.sql import functions as F

from sparkstream.operators import lateness as lt
from sparkstream.operators import windows as wn
from sparkstream.operators.aggregate import Agg, tick_total
from sparkstream.queries.basics import CENTS, cents
from sparkstream.queries.registry import query
from sparkstream.tables import load

DAY_SUMS = f"""SELECT event_type, time_bucket(INTERVAL '1 day', ts) AS window_start,
    time_bucket(INTERVAL '1 day', ts) + INTERVAL '1 day' AS window_end,
    CAST(count(*) AS BIGINT) AS n, CAST(sum({CENTS}) AS BIGINT) AS total FROM events GROUP BY 1, 2, 3"""


def _sums():
    return {"n": F.count("*"), "total": F.sum(cents())}


@query(DAY_SUMS)
def tumbling(spark, sf_dir):
    return wn.tumbling(load(spark, sf_dir, "events"), ["event_type"], "ts", "1 day", _sums())


@query(
    f"""SELECT user_id, s AS window_start, s + INTERVAL '12 hours' AS window_end, CAST(count(*) AS BIGINT) AS n,
    CAST(sum({CENTS}) AS BIGINT) AS total FROM (
      SELECT user_id, value, unnest([time_bucket(INTERVAL '6 hours', ts),
        time_bucket(INTERVAL '6 hours', ts) - INTERVAL '6 hours']) AS s FROM events)
    GROUP BY 1, 2, 3"""
)
def sliding(spark, sf_dir):
    sums = {"n": Agg("count", F.lit(1)), "total": Agg("sum", cents())}
    return wn.sliding(load(spark, sf_dir, "events"), ["user_id"], "ts", "12 hours", "6 hours", sums)


@query(
    f"""SELECT event_type, s AS window_start, s + INTERVAL '60 hours' AS window_end, CAST(count(*) AS BIGINT) AS n,
    CAST(sum({CENTS}) AS BIGINT) AS total, max(value) AS top FROM (
      SELECT event_type, value, time_bucket(INTERVAL '1 hour', ts) - INTERVAL '1 hour' * back AS s
      FROM events, range(60) AS r(back))
    GROUP BY 1, 2, 3"""
)
def sliding_panes(spark, sf_dir):
    """Sixty windows over each row: rows are aggregated by the hour, hours are handed to their windows."""
    aggs = {"n": Agg("count", F.lit(1)), "total": Agg("sum", cents()), "top": Agg("max", F.col("value"))}
    return wn.sliding(load(spark, sf_dir, "events"), ["event_type"], "ts", "60 hours", "1 hour", aggs)


@query(
    f"""WITH marked AS (
      SELECT *, CASE WHEN ts - lag(ts) OVER w <= INTERVAL '6 hours' THEN 0 ELSE 1 END AS fresh FROM events
      WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    grouped AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS g FROM marked)
    SELECT user_id, min(ts) AS window_start, max(ts) + INTERVAL '6 hours' AS window_end,
    CAST(count(*) AS BIGINT) AS n, CAST(sum({CENTS}) AS BIGINT) AS total FROM grouped GROUP BY user_id, g"""
)
def session(spark, sf_dir):
    aggs = {"n": Agg("count", F.col("event_id")), "total": Agg("sum", cents())}
    return wn.session(load(spark, sf_dir, "events"), ["user_id"], "ts", "6 hours", aggs)


@query(
    f"""SELECT user_id, CAST((pos - 1) // 5 AS BIGINT) AS window_no, CAST(sum({CENTS}) AS BIGINT) AS total FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos FROM events)
    GROUP BY 1, 2 HAVING count(*) = 5"""
)
def count_tumbling(spark, sf_dir):
    return wn.count_tumbling(
        load(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], 5, {"total": F.sum(cents())}
    )


@query(
    f"""SELECT user_id, CAST(pos // 3 AS BIGINT) AS window_no, CAST(total AS BIGINT) AS total FROM (
      SELECT user_id, row_number() OVER w AS pos,
      sum({CENTS}) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS 4 PRECEDING) AS total
      FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) WHERE pos % 3 = 0"""
)
def count_sliding(spark, sf_dir):
    return wn.count_sliding(
        load(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], 5, 3, {"total": Agg("sum", cents())}
    )


@query(
    f"""SELECT event_type, CAST(pos AS BIGINT) AS window_no, CAST(total AS BIGINT) AS total, top, CAST(n AS BIGINT) AS n FROM (
      SELECT event_type, row_number() OVER w AS pos, sum({CENTS}) OVER last60 AS total, max(value) OVER last60 AS top,
        count(value) OVER last60 AS n
      FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id),
        last60 AS (PARTITION BY event_type ORDER BY ts, event_id ROWS 59 PRECEDING))"""
)
def count_sliding_blocks(spark, sf_dir):
    """Sum, maximum and count of the last sixty rows at every row."""
    aggs = {"total": Agg("sum", cents()), "top": Agg("max", F.col("value")), "n": Agg("count", F.col("value"))}
    return wn.count_sliding(load(spark, sf_dir, "events"), ["event_type"], ["ts", "event_id"], 60, 1, aggs)


@query(
    """SELECT user_id, time_bucket(INTERVAL '1 day', ts) AS window_start,
    time_bucket(INTERVAL '1 day', ts) + INTERVAL '1 day' AS window_end, ts FROM events"""
)
def window_rows(spark, sf_dir):
    return wn.window_rows(load(spark, sf_dir, "events"), ["user_id"], "ts", "1 day")


@query(
    """SELECT user_id, time_bucket(INTERVAL '5 days', ts, TIMESTAMP '1970-01-01') AS window_start,
    CAST(count(event_id) AS BIGINT) AS cnt, max(value) AS max_value, min(value) AS min_value FROM events GROUP BY 1, 2"""
)
def sql_tumble(spark, sf_dir):
    return spark.sql(
        "SELECT user_id, window.start AS window_start, count(event_id) AS cnt, max(value) AS max_value, "
        "min(value) AS min_value FROM {seen} GROUP BY user_id, window(ts, '5 days')",
        seen=load(spark, sf_dir, "events"),
    )


@query(
    """SELECT user_id, time_bucket(INTERVAL '6 hours', ts) AS window_start,
    time_bucket(INTERVAL '6 hours', ts) + INTERVAL '6 hours' AS window_end, CAST(count(event_id) AS BIGINT) AS cnt,
    max(value) AS max_value, min(value) AS min_value FROM events GROUP BY 1, 2, 3"""
)
def dsl_tumble(spark, sf_dir):
    aggs = {"cnt": F.count("event_id"), "max_value": F.max("value"), "min_value": F.min("value")}
    return wn.tumbling(load(spark, sf_dir, "events"), ["user_id"], "ts", "6 hours", aggs)


TICKS = f"""per_tick AS (
      SELECT event_type, time_bucket(INTERVAL '1 day', ts + INTERVAL '8 hours') - INTERVAL '8 hours' AS day_start,
        time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' AS tick_end, sum({CENTS}) AS s
      FROM events GROUP BY 1, 2, 3),
    first_tick AS (SELECT event_type, day_start, min(tick_end) AS f FROM per_tick GROUP BY 1, 2),
    last_tick AS (SELECT day_start, max(tick_end) AS l FROM per_tick GROUP BY 1),
    spine AS (SELECT event_type, day_start, unnest(generate_series(f, l, INTERVAL '1 hour')) AS tick_end
      FROM first_tick JOIN last_tick USING (day_start)),
    running AS (SELECT event_type, day_start, tick_end,
      CAST(sum(coalesce(s, 0)) OVER (PARTITION BY event_type, day_start ORDER BY tick_end) AS BIGINT) AS total
      FROM spine LEFT JOIN per_tick USING (event_type, day_start, tick_end))"""


def _ticks(spark, sf_dir):
    return wn.cumulative_ticks(load(spark, sf_dir, "events"), ["event_type"], "ts", cents(), "1 hour", 8)


@query(f"WITH {TICKS} SELECT event_type, day_start, tick_end, total FROM running")
def day_to_date(spark, sf_dir):
    """Each category's sum since local midnight at every tick."""
    return _ticks(spark, sf_dir)


@query(
    f"""WITH {TICKS} SELECT tick_end, event_type, total, CAST(rank AS BIGINT) AS rank FROM (
      SELECT *, row_number() OVER (PARTITION BY tick_end ORDER BY total DESC, event_type) AS rank FROM running)
    WHERE rank <= 3"""
)
def day_to_date_top3(spark, sf_dir):
    top = wn.top_n_per(_ticks(spark, sf_dir), ["tick_end"], "total", ["event_type"], 3)
    return top.select("tick_end", "event_type", "total", F.col("rank").cast("long").alias("rank"))


@query(f"WITH {TICKS} SELECT tick_end, CAST(sum(total) AS BIGINT) AS total FROM running GROUP BY tick_end")
def day_to_date_total(spark, sf_dir):
    return tick_total(_ticks(spark, sf_dir), ["tick_end"], "total")


ARRIVALS = f"""arrivals AS (
      SELECT event_id, user_id, ts, {CENTS} AS cents, ts + INTERVAL 1 HOUR * ((event_id * 37) % 20) AS arrival FROM events),
    traced AS (SELECT *, max(ts) OVER (ORDER BY arrival, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
      - INTERVAL '8 hours' - INTERVAL '1 millisecond' AS watermark,
      time_bucket(INTERVAL '2 hours', ts) AS window_start,
      time_bucket(INTERVAL '2 hours', ts) + INTERVAL '2 hours' AS window_end FROM arrivals),
    placed AS (SELECT *, CASE
      WHEN watermark IS NULL OR watermark < window_end - INTERVAL '1 millisecond' THEN 'on_time'
      WHEN watermark < window_end - INTERVAL '1 millisecond' + INTERVAL '4 hours' THEN 'allowed'
      ELSE 'late' END AS status FROM traced)"""


def arrivals(spark, sf_dir):
    """Events with an arrival time derived from their id, so that many come out of order."""
    hours = (F.col("event_id") * 37) % 20
    return load(spark, sf_dir, "events").select(
        "event_id", "user_id", "ts", cents().alias("cents"),
        F.timestamp_micros(F.unix_micros("ts") + hours * 3_600_000_000).alias("arrival"),
    )


@query(f"WITH {ARRIVALS} SELECT event_id, watermark FROM placed")
def watermark_trace(spark, sf_dir):
    traced = lt.watermark_trace(arrivals(spark, sf_dir), "ts", ["arrival", "event_id"], "8 hours")
    return traced.select("event_id", "watermark")


@query(f"WITH {ARRIVALS} SELECT event_id, window_start, status FROM placed")
def lateness_status(spark, sf_dir):
    placed = lt.classify(arrivals(spark, sf_dir), "ts", ["arrival", "event_id"], "2 hours", "8 hours", "4 hours")
    return placed.select("event_id", "window_start", "status")


def _with_lateness(spark, sf_dir):
    return lt.tumbling_with_lateness(
        arrivals(spark, sf_dir), ["user_id"], "ts", ["arrival", "event_id"], "2 hours", "8 hours", "4 hours", F.col("cents")
    )


FIRINGS = f"""WITH {ARRIVALS},
    first AS (SELECT user_id, window_start, window_end, sum(cents) AS s FROM placed WHERE status = 'on_time' GROUP BY 1, 2, 3),
    again AS (SELECT p.user_id, p.window_start, p.window_end,
      row_number() OVER w AS firing, coalesce(f.s, 0) + sum(p.cents) OVER w AS total
      FROM placed p LEFT JOIN first f USING (user_id, window_start) WHERE status = 'allowed'
      WINDOW w AS (PARTITION BY p.user_id, p.window_start ORDER BY p.arrival, p.event_id))
    SELECT user_id, window_start, window_end, CAST(0 AS BIGINT) AS firing, CAST(s AS BIGINT) AS total FROM first
    UNION ALL SELECT user_id, window_start, window_end, CAST(firing AS BIGINT), CAST(total AS BIGINT) FROM again"""


@query(FIRINGS)
def lateness_firings(spark, sf_dir):
    return _with_lateness(spark, sf_dir)[0]


LATE_ROWS = f"WITH {ARRIVALS} SELECT event_id, user_id, ts, arrival, watermark FROM placed WHERE status = 'late'"


@query(LATE_ROWS)
def late_rows(spark, sf_dir):
    return _with_lateness(spark, sf_dir)[1].select("event_id", "user_id", "ts", "arrival", "watermark")
