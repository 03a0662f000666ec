"""Join, enrichment and deadline queries."""

from pyspark.sql import functions as F

from sparkstream.functions.scalars import line_total
from sparkstream.operators import joins as jn
from sparkstream.operators.timers import deadline_check
from sparkstream.queries.registry import query
from sparkstream.tables import load

HOUR = 3_600_000_000


def of_type(spark, sf_dir, kind, cols):
    """Events of one type with their columns renamed: ``{new: old}``."""
    events = load(spark, sf_dir, "events").where(F.col("event_type") == kind)
    return events.select(*[F.col(old).alias(new) for new, old in cols.items()])


@query(
    """SELECT v.user_id, v.event_id AS view_id, c.event_id AS click_id, time_bucket(INTERVAL '1 day', v.ts) AS window_start,
    CAST(CAST(1 + v.event_id % 5 AS DECIMAL(10,0)) * CAST(c.value AS DECIMAL(18,2)) AS DOUBLE) AS total
    FROM events v JOIN events c ON v.user_id = c.user_id
    AND time_bucket(INTERVAL '1 day', v.ts) = time_bucket(INTERVAL '1 day', c.ts)
    WHERE v.event_type = 'view' AND c.event_type = 'click'"""
)
def window_join(spark, sf_dir):
    views = of_type(spark, sf_dir, "view", {"user_id": "user_id", "view_id": "event_id", "view_ts": "ts"})
    clicks = of_type(
        spark, sf_dir, "click", {"user_id": "user_id", "click_id": "event_id", "click_ts": "ts", "price": "value"}
    )
    joined = jn.window_join(views, clicks, ["user_id"], "view_ts", "click_ts", "1 day")
    counted = joined.withColumn("cnt", 1 + F.col("view_id") % 5)
    return counted.select(
        "user_id", "view_id", "click_id", "window_start", line_total("cnt", "price").cast("double").alias("total")
    )


@query(
    """SELECT v.user_id, v.event_id AS view_id, c.event_id AS click_id FROM events v JOIN events c
    ON v.user_id = c.user_id AND c.ts BETWEEN v.ts - INTERVAL '2 hours' AND v.ts + INTERVAL '1 hour'
    WHERE v.event_type = 'view' AND c.event_type = 'click'"""
)
def interval_join(spark, sf_dir):
    views = of_type(spark, sf_dir, "view", {"user_id": "user_id", "view_id": "event_id", "view_ts": "ts"})
    clicks = of_type(spark, sf_dir, "click", {"user_id": "user_id", "click_id": "event_id", "click_ts": "ts"})
    joined = jn.interval_join(views, clicks, ["user_id"], "view_ts", "click_ts", -2 * HOUR, HOUR)
    return joined.select("user_id", "view_id", "click_id")


@query(
    """SELECT e.event_id, e.user_id, c.c_name AS name, c.c_mktsegment AS segment, e.ts, e.event_type
    FROM events e JOIN customer c ON e.user_id = c.c_custkey"""
)
def enrich_users(spark, sf_dir):
    users = load(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    events = load(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    return jn.enrich(events, users, ["user_id"])


@query(
    """SELECT e.event_id, e.user_id, c.c_name AS name FROM events e
    LEFT JOIN customer c ON e.user_id = c.c_custkey AND c.c_custkey % 3 = 0"""
)
def enrich_users_keep_unknown(spark, sf_dir):
    users = load(spark, sf_dir, "customer").where(F.col("c_custkey") % 3 == 0)
    users = users.select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("name"))
    return jn.enrich(load(spark, sf_dir, "events").select("event_id", "user_id"), users, ["user_id"], "left")


@query(
    """SELECT p.event_id, p.user_id, s.value AS plan FROM events p ASOF JOIN
    (SELECT user_id, ts, value FROM events WHERE event_type = 'signup') s ON p.user_id = s.user_id AND p.ts >= s.ts
    WHERE p.event_type = 'purchase'"""
)
def enrich_as_of(spark, sf_dir):
    """Purchases with the value of the user's latest sign-up at that time."""
    purchases = of_type(spark, sf_dir, "purchase", {"event_id": "event_id", "user_id": "user_id", "ts": "ts"})
    plans = of_type(spark, sf_dir, "signup", {"user_id": "user_id", "valid_from": "ts", "plan": "value"})
    joined = jn.enrich_as_of(purchases, plans, ["user_id"], "ts", "valid_from", ["event_id"])
    return joined.select("event_id", "user_id", "plan")


@query(
    """WITH o AS (SELECT * FROM events WHERE event_type = 'purchase'),
    r AS (SELECT user_id, ts FROM events WHERE event_type = 'view'),
    hit AS (SELECT o.event_id, min(r.ts) AS at FROM o JOIN r ON o.user_id = r.user_id
      AND r.ts BETWEEN o.ts AND o.ts + INTERVAL '12 hours' GROUP BY 1)
    SELECT o.event_id, o.user_id, CASE WHEN hit.at IS NULL THEN 'auto' ELSE 'reviewed' END AS status,
    coalesce(hit.at, o.ts + INTERVAL '12 hours') AS decided_at FROM o LEFT JOIN hit USING (event_id)"""
)
def deadlines(spark, sf_dir):
    """Purchases the user looks at again within 12 hours, and those decided automatically."""
    opens = of_type(spark, sf_dir, "purchase", {"event_id": "event_id", "user_id": "user_id", "ts": "ts"})
    closes = of_type(spark, sf_dir, "view", {"user_id": "user_id", "view_ts": "ts"})
    checked = deadline_check(opens, closes, ["user_id"], "ts", "view_ts", 12 * HOUR, ["event_id"])
    return checked.select("event_id", "user_id", "status", "decided_at")
