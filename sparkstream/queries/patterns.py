"""Event-pattern queries over the event table, keyed by user."""

from pyspark.sql import functions as F

from sparkstream.operators.patterns import Pattern, match
from sparkstream.operators.rules import match_indexed, match_rules
from sparkstream.queries.joins import HOUR
from sparkstream.queries.registry import query
from sparkstream.sources.basic import from_rows
from sparkstream.tables import load

DAY = 24 * HOUR


def is_(kind):
    return F.col("event_type") == kind


def found(spark, sf_dir, pattern, key=("user_id",), order=("ts", "event_id"), keep=("event_type",)):
    return match(load(spark, sf_dir, "events"), pattern, list(key), list(order), list(keep), t="ts")


@query("SELECT user_id, event_id FROM events WHERE event_type = 'error'")
def single_event(spark, sf_dir):
    rows = found(spark, sf_dir, Pattern.begin("a", is_("error"))).rows
    return rows.select("user_id", F.col("a_first.event_id").alias("event_id"))


@query(
    """SELECT user_id, event_id AS first_id, next_id AS second_id FROM (
      SELECT *, lead(event_type) OVER w AS next_type, lead(event_id) OVER w AS next_id, lead(ts) OVER w AS next_ts
      FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
    WHERE event_type = 'error' AND next_type = 'error' AND next_ts - ts < INTERVAL '12 hours'"""
)
def login_fail_next(spark, sf_dir):
    """Two errors in a row within 12 hours."""
    rows = found(spark, sf_dir, Pattern.begin("a", is_("error")).next("b", is_("error")).within(12 * HOUR)).rows
    return rows.select(
        "user_id", F.col("a_first.event_id").alias("first_id"), F.col("b_first.event_id").alias("second_id")
    )


@query(
    """SELECT event_id AS first_id, next_id AS second_id FROM (
      SELECT *, lead(event_type) OVER w AS next_type, lead(event_id) OVER w AS next_id
      FROM events WINDOW w AS (ORDER BY event_id)) WHERE event_type = 'error' AND next_type = 'signup'"""
)
def whole_stream_next(spark, sf_dir):
    """One sequence over the whole table, in arrival order, without a key."""
    rows = found(
        spark, sf_dir, Pattern.begin("a", is_("error")).next("b", is_("signup")), key=(), order=("event_id",)
    ).rows
    return rows.select(F.col("a_first.event_id").alias("first_id"), F.col("b_first.event_id").alias("second_id"))


NEXT_PURCHASE = """SELECT user_id, event_id, ts, min(CASE WHEN event_type = 'purchase' THEN ts END) OVER (
      PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS paid_at,
      event_type FROM events"""


def _timeout(spark, sf_dir):
    return found(
        spark, sf_dir, Pattern.begin("a", is_("signup")).followed_by("b", is_("purchase")).within(DAY)
    )


@query(
    f"""SELECT user_id, event_id, paid_at FROM ({NEXT_PURCHASE})
    WHERE event_type = 'signup' AND paid_at - ts < INTERVAL '1 day'"""
)
def order_timeout(spark, sf_dir):
    """Sign-ups followed by a purchase within a day."""
    rows = _timeout(spark, sf_dir).rows
    return rows.select("user_id", F.col("a_first.event_id").alias("event_id"), F.col("b_first.ts").alias("paid_at"))


@query(
    f"""SELECT user_id, event_id FROM ({NEXT_PURCHASE})
    WHERE event_type = 'signup' AND (paid_at IS NULL OR paid_at - ts >= INTERVAL '1 day')"""
)
def order_timeout_open(spark, sf_dir):
    """Sign-ups that ran out of time."""
    late = _timeout(spark, sf_dir).timeouts
    return late.select("user_id", F.col("a_first.event_id").alias("event_id"))


CLICKS = """clicks AS (SELECT user_id, event_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r
      FROM events WHERE event_type = 'click')"""


@query(
    f"""WITH {CLICKS} SELECT a.user_id, a.event_id AS first_id, b.event_id AS last_id, CAST(b.r - a.r + 1 AS BIGINT) AS n
    FROM clicks a JOIN clicks b ON a.user_id = b.user_id AND b.r - a.r + 1 BETWEEN 2 AND 3
    WHERE b.ts - a.ts < INTERVAL '1 day'"""
)
def malice_times(spark, sf_dir):
    """Two to three clicks within a day."""
    rows = found(spark, sf_dir, Pattern.begin("a", is_("click")).times(2, 3).within(DAY)).rows
    return rows.select(
        "user_id", F.col("a_first.event_id").alias("first_id"), F.col("a_last.event_id").alias("last_id"),
        F.col("a_n").alias("n"),
    )


@query(
    f"""WITH {CLICKS} SELECT a.user_id, a.event_id AS first_id, b.event_id AS last_id, CAST(b.r - a.r + 1 AS BIGINT) AS n
    FROM clicks a JOIN clicks b ON a.user_id = b.user_id AND b.r >= a.r WHERE b.ts - a.ts < INTERVAL '1 day'"""
)
def malice_runs(spark, sf_dir):
    """One or more clicks within a day, every length."""
    rows = found(spark, sf_dir, Pattern.begin("a", is_("click")).one_or_more().within(DAY)).rows
    return rows.select(
        "user_id", F.col("a_first.event_id").alias("first_id"), F.col("a_last.event_id").alias("last_id"),
        F.col("a_n").alias("n"),
    )


@query(
    f"""WITH {CLICKS},
    pairs AS (SELECT a.user_id, a.event_id AS first_id, b.event_id AS last_id, a.r AS fr, b.r AS lr FROM clicks a
      JOIN clicks b ON a.user_id = b.user_id AND b.r >= a.r WHERE b.ts - a.ts < INTERVAL '1 day')
    SELECT p.user_id, p.first_id, p.last_id, c.event_id AS member_id FROM pairs p
    JOIN clicks c ON c.user_id = p.user_id AND c.r BETWEEN p.fr AND p.lr"""
)
def malice_members(spark, sf_dir):
    """The clicks inside each of those matches, one row each."""
    matches = found(spark, sf_dir, Pattern.begin("a", is_("click")).one_or_more().within(DAY))
    ends = matches.rows.select(
        "user_id", "match_id", F.col("a_first.event_id").alias("first_id"), F.col("a_last.event_id").alias("last_id")
    )
    members = matches.members().select("user_id", "match_id", F.col("ev.event_id").alias("member_id"))
    return ends.join(members, ["user_id", "match_id"]).drop("match_id")


@query(
    """WITH runs AS (SELECT *, sum(CASE WHEN value > 20 THEN 1 ELSE 0 END) OVER (
        PARTITION BY user_id ORDER BY ts, event_id) AS run FROM events),
    hits AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r FROM runs
      WHERE event_type = 'click' AND value <= 20)
    SELECT a.user_id, a.event_id AS first_id, b.event_id AS last_id, CAST(b.r - a.r + 1 AS BIGINT) AS n
    FROM hits a JOIN hits b ON a.user_id = b.user_id AND a.run = b.run AND b.r >= a.r
    WHERE b.ts - a.ts < INTERVAL '5 days'"""
)
def until_runs(spark, sf_dir):
    """One or more clicks within five days, until any event with a value above 20."""
    pattern = Pattern.begin("a", is_("click")).one_or_more().until(F.col("value") > 20).within(5 * DAY)
    rows = found(spark, sf_dir, pattern).rows
    return rows.select(
        "user_id", F.col("a_first.event_id").alias("first_id"), F.col("a_last.event_id").alias("last_id"),
        F.col("a_n").alias("n"),
    )


@query(
    """WITH e AS (SELECT user_id, event_id, ts, event_type, row_number() OVER w AS pos,
        count(CASE WHEN event_type <> 'view' THEN 1 END) OVER w AS run,
        min(CASE WHEN event_type = 'view' THEN event_id END) OVER later AS next_view,
        min(CASE WHEN event_type = 'purchase' THEN event_id END) OVER later AS next_purchase
      FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id),
        later AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
    v AS (SELECT * FROM e WHERE event_type = 'view')
    SELECT s.user_id, s.event_id AS signup_id, n.event_id AS first_view, m.event_id AS last_view,
      CAST(m.pos - n.pos + 1 AS BIGINT) AS n_views, m.next_purchase AS purchase_id
    FROM e s JOIN v n ON n.user_id = s.user_id AND n.event_id = s.next_view
    JOIN v m ON m.user_id = n.user_id AND m.run = n.run AND m.pos >= n.pos
    JOIN e p ON p.user_id = s.user_id AND p.event_id = m.next_purchase
    WHERE s.event_type = 'signup' AND p.ts - s.ts < INTERVAL '4 days'"""
)
def consecutive_seq(spark, sf_dir):
    """A sign-up, an unbroken run of views, then a purchase, within four days."""
    pattern = (
        Pattern.begin("c", is_("signup")).followed_by("a", is_("view")).one_or_more().consecutive()
        .followed_by("b", is_("purchase")).within(4 * DAY)
    )
    rows = found(spark, sf_dir, pattern).rows
    return rows.select(
        "user_id", F.col("c_first.event_id").alias("signup_id"), F.col("a_first.event_id").alias("first_view"),
        F.col("a_last.event_id").alias("last_view"), F.col("a_n").alias("n_views"),
        F.col("b_first.event_id").alias("purchase_id"),
    )


@query(
    """WITH x AS (SELECT user_id, event_id, ts FROM events WHERE event_type = 'error')
    SELECT a.user_id, a.event_id AS first_id, b.event_id AS last_id, CAST(2 AS BIGINT) AS n FROM x a
      JOIN x b ON a.user_id = b.user_id AND b.event_id > a.event_id WHERE b.ts - a.ts < INTERVAL '2 days'
    UNION ALL SELECT a.user_id, a.event_id, c.event_id, CAST(3 AS BIGINT) FROM x a
      JOIN x b ON a.user_id = b.user_id AND b.event_id > a.event_id
      JOIN x c ON a.user_id = c.user_id AND c.event_id > b.event_id WHERE c.ts - a.ts < INTERVAL '2 days'"""
)
def combinations(spark, sf_dir):
    """Any two or three errors within two days, rows in between allowed to be left out."""
    pattern = Pattern.begin("a", is_("error")).times(2, 3).allow_combinations().within(2 * DAY)
    rows = found(spark, sf_dir, pattern).rows
    return rows.select(
        "user_id", F.col("a_first.event_id").alias("first_id"), F.col("a_last.event_id").alias("last_id"),
        F.col("a_n").alias("n"),
    )


@query(
    """SELECT event_id, 1 AS rule_id FROM events WHERE event_type = 'error' AND regexp_extract(props, '"k": ([0-9]+)', 1) = '3'
    UNION ALL SELECT event_id, 2 AS rule_id FROM events WHERE event_type = 'click' AND value > 20
    UNION ALL SELECT event_id, 3 AS rule_id FROM events WHERE value > 40 AND FALSE"""
)
def rule_matches(spark, sf_dir):
    """Rules kept as rows of SQL conditions on an event's tags and fields."""
    rules = from_rows(
        spark,
        [
            (1, "try_element_at(tags, 'kind') = 'error' AND try_element_at(fields, 'k') = 3"),
            (2, "try_element_at(tags, 'kind') = 'click' AND try_element_at(fields, 'value') > 20"),
            (3, "try_element_at(tags, 'absent') = 'x' AND try_element_at(fields, 'value') > 40"),
        ],
        "rule_id INT, predicate STRING",
    )
    k = F.from_json("props", "MAP<STRING, DOUBLE>")
    events = load(spark, sf_dir, "events").select(
        "event_id",
        F.create_map(F.lit("kind"), "event_type").alias("tags"),
        F.map_concat(k, F.create_map(F.lit("value"), "value")).alias("fields"),
    )
    return match_rules(events, rules).select("event_id", "rule_id")


CUSTOMER_RULES = """SELECT c_custkey AS rule_id, c_custkey AS user_id,
      CASE c_custkey % 3 WHEN 0 THEN 'view' WHEN 1 THEN 'click' ELSE 'purchase' END AS event_type, c_nationkey AS least FROM customer"""


@query(
    f"""SELECT e.event_id, r.rule_id FROM events e JOIN ({CUSTOMER_RULES}) r
      ON e.user_id = r.user_id AND e.event_type = r.event_type AND e.value > r.least
    UNION ALL SELECT e.event_id, -1 - n_nationkey AS rule_id FROM events e JOIN nation
      ON e.event_type = 'error' AND e.value >= 4 * n_nationkey AND e.value < 4 * n_nationkey + 4"""
)
def rules_from_tables(spark, sf_dir):
    """A rule for each customer (user, kind and a least value) and one for each nation (a range of values of errors)."""
    number = "named_struct('field', 'value', 'op', '{}', 'value', cast({} as double))"
    customers = load(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("rule_id"),
        F.expr("""array(named_struct('field', 'user_id', 'value', cast(c_custkey as string)), named_struct('field', 'event_type',
          'value', CASE c_custkey % 3 WHEN 0 THEN 'view' WHEN 1 THEN 'click' ELSE 'purchase' END))""").alias("equals"),
        F.expr(f"array({number.format('>', 'c_nationkey')})").alias("bounds"),
    )
    nations = load(spark, sf_dir, "nation").select(
        F.expr("cast(-1 - n_nationkey as bigint)").alias("rule_id"),
        F.expr("array(named_struct('field', 'event_type', 'value', 'error'))").alias("equals"),
        F.expr(f"array({number.format('>=', '4 * n_nationkey')}, {number.format('<', '4 * n_nationkey + 4')})").alias("bounds"),
    )
    events = load(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    fields = {name: F.col(name) for name in ("user_id", "event_type", "value")}
    rules = customers.withColumn("rule_id", F.col("rule_id").cast("bigint")).unionByName(nations)
    return match_indexed(events, rules, fields).select("event_id", "rule_id")
