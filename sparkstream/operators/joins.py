"""Window joins, interval joins and enrichment from a changing dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkstream.plans.scan import latest, scan
from sparkstream.plans.sizes import broadcast_if_small


def window_join(
    left: DataFrame, right: DataFrame, key: Sequence[str], left_t: str, right_t: str, size: str,
    delay: str | None = None,
) -> DataFrame:
    """Pairs with the same key whose times fall in the same tumbling window.

    The window start is part of the join key, so a key is spread over its windows. With ``delay``
    both sides get a watermark on the window, which bounds the state of a streaming join.
    """
    lefts, rights = left, right
    if delay is not None:
        lefts, rights = left.withWatermark(left_t, delay), right.withWatermark(right_t, delay)
    lefts = lefts.withColumn("__w", F.window(left_t, size))
    rights = rights.withColumn("__w", F.window(right_t, size))
    joined = lefts.join(rights, [*key, "__w"])
    return joined.withColumns({"window_start": F.col("__w.start"), "window_end": F.col("__w.end")}).drop("__w")


def interval_join(
    left: DataFrame, right: DataFrame, key: Sequence[str], left_t: str, right_t: str, low_us: int, high_us: int
) -> DataFrame:
    """Pairs with the same key and ``right_t`` in ``[left_t + low, left_t + high]``, both ends included.

    Time is cut into stretches as long as the interval: a right row lies in one stretch, a left row
    reaches into at most two, so the equality key is (key, stretch) and a busy key is not one task.
    """
    width = max(high_us - low_us, 1)
    at = F.unix_micros(left_t)
    reach = F.sequence(F.floor((at + low_us) / width), F.floor((at + high_us) / width))
    lefts = left.withColumn("__b", F.explode(reach))
    rights = right.withColumn("__b", F.floor(F.unix_micros(right_t) / width))
    gap = F.unix_micros(right_t) - F.unix_micros(left_t)
    return lefts.join(rights, [*key, "__b"]).where(gap.between(low_us, high_us)).drop("__b")


def interval_join_stream(
    left: DataFrame, right: DataFrame, key: Sequence[str], left_t: str, right_t: str, low: str, high: str, delay: str,
    stretch_us: int = 3_600_000_000,
) -> DataFrame:
    """The streaming form: Spark's own stream-stream join, with watermarks to drop old state.

    ``low`` and ``high`` are interval texts such as ``'-2' SECONDS`` and ``'1' SECOND``. The key is joined together
    with the stretch of time the right row lies in, so a busy key is spread; a left row is held once for each stretch
    that its interval reaches.
    """
    width = F.lit(stretch_us)
    ends = [F.floor(F.unix_micros(F.expr(f"{left_t} + INTERVAL {x}")) / width) for x in (low, high)]
    left = left.withColumn("__b", F.explode(F.sequence(*ends)))
    right = right.withColumn("__rb", F.floor(F.unix_micros(right_t) / width))
    right_key = {k: f"__r_{k}" for k in key}
    lefts = left.withWatermark(left_t, delay)
    rights = right.withColumnsRenamed(right_key).withWatermark(right_t, delay)
    same: Column = F.col("__b") == F.col("__rb")
    for k, r in right_key.items():
        same = same & (F.col(k) == F.col(r))
    inside = F.expr(f"{right_t} BETWEEN {left_t} + INTERVAL {low} AND {left_t} + INTERVAL {high}")
    return lefts.join(rights, same & inside).drop("__b", "__rb", *right_key.values())


def enrich(events: DataFrame, dim: DataFrame, key: Sequence[str], how: str = "inner") -> DataFrame:
    """Events with the columns of a dimension; ``how="left"`` keeps events that have no match.

    A dimension counted and found small is broadcast; a larger one is joined by shuffle.
    """
    return events.join(broadcast_if_small(dim), list(key), how)


def enrich_as_of(
    events: DataFrame, versions: DataFrame, key: Sequence[str], t: str, valid_from: str, order: Sequence[str],
    how: str = "inner",
) -> DataFrame:
    """Events with the dimension version that was valid at their time.

    Versions and events run through one ordered scan per key, so each event picks up the latest
    version at or before it without any pair being formed.
    """
    fields = [c for c in versions.columns if c not in key and c != valid_from]
    version = F.struct(*fields)
    # of versions with the same start the one with the greatest fields counts
    versions = versions.groupBy(*key, valid_from).agg(F.max_by(version, F.to_json(version)).alias("__v")).select(
        *key, valid_from, "__v.*"
    )
    marks = versions.select(*key, F.col(valid_from).alias(t), version.alias("__dim"), F.lit(0).alias("__is_event"))
    rows = events.withColumn("__is_event", F.lit(1)).unionByName(marks, allowMissingColumns=True)
    seen = scan(rows, key, [t, "__is_event", *order], {"__seen": latest(F.col("__dim"))})
    out = seen.where(F.col("__is_event") == 1)
    if how == "inner":
        out = out.where(F.col("__seen").isNotNull())
    return out.select(*events.columns, *[F.col("__seen")[f].alias(f) for f in fields])
