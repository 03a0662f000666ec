"""Streaming forms that run a batch operator on every micro-batch and keep their state as files.

What a micro-batch leaves for the next one is written under its batch number; a batch that runs again
after a failure reads the same input and overwrites the same output, so results stay exact. State by key is a
:class:`~sparkstream.streaming.store.KeyedLog`: a batch reads and writes the buckets of its own keys.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.window import Window

from sparkstream.operators.aggregate import Agg
from sparkstream.operators.changelog import IS_ADD, to_changelog
from sparkstream.operators.joins import enrich
from sparkstream.operators.lateness import ALLOWED, LATE, ON_TIME, classify, is_open, watermark_at
from sparkstream.operators.patterns import Matches, Pattern, match
from sparkstream.operators.rules import match_rules
from sparkstream.operators.windows import block_windows, top_n_per
from sparkstream.plans.scan import Running, running_count, scan
from sparkstream.streaming import files
from sparkstream.streaming.sinks import BATCH, last_per_key, read_batches, write_batch
from sparkstream.streaming.store import BUCKET, BUCKETS, KeyedLog


def enrich_stream(
    events: DataFrame, read_dim: Callable[[], DataFrame], key: Sequence[str], path: str, how: str = "inner"
) -> DataStreamWriter:
    """Events joined with a dimension that is read again for every micro-batch (replace-all update)."""
    return events.writeStream.foreachBatch(enrich_batches(read_dim, key, path, how))


def enrich_batches(
    read_dim: Callable[[], DataFrame], key: Sequence[str], path: str, how: str = "inner"
) -> Callable[[DataFrame, int], None]:
    """What :func:`enrich_stream` does with a micro-batch.

    The rows of the dimension that the batch asks for are kept under the batch number before they are used, so a batch
    that runs again gives the same rows, whatever has become of the dimension. Kept rows follow the batch in number and
    go two batches later.
    """

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark, here = batch.sparkSession, f"{path}/_dims/{batch_id}"
        kept = files.read_text(spark, f"{here}/schema.json")
        if kept is None:
            asked = read_dim().join(batch.select(*key).distinct(), list(key), "left_semi")
            asked.write.mode("overwrite").parquet(f"{here}/rows")
            kept = asked.schema.json()
            files.write_text(spark, f"{here}/schema.json", kept)
        dim = spark.read.schema(T.StructType.fromJson(json.loads(kept))).parquet(f"{here}/rows")
        write_batch(enrich(batch, dim, key, how), path, batch_id)
        if batch_id > 1:
            files.remove(spark, f"{path}/_dims/{batch_id - 2}")

    return on_batch


def rules_stream(events: DataFrame, read_rules: Callable[[], DataFrame], path: str) -> DataStreamWriter:
    """Rules read again for every micro-batch."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        write_batch(match_rules(batch, read_rules()), path, batch_id)

    return events.writeStream.foreachBatch(on_batch)


def split_stream(df: DataFrame, rules: Mapping[str, object], path: str) -> DataStreamWriter:
    """Every micro-batch written once, partitioned by tag: one folder per output."""
    from sparkstream.operators.routing import tag_by

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        target = f"{path}/{BATCH}={batch_id}"
        tag_by(batch, rules).write.mode("overwrite").partitionBy("tag").parquet(target)

    return df.writeStream.foreachBatch(on_batch)


def top_n_stream(
    totals: DataFrame, by: Sequence[str], key: Sequence[str], value: str, tie: Sequence[str], n: int, path: str
) -> DataStreamWriter:
    """Ranks within the groups ``by`` whose totals changed (ranking is not allowed on the stream itself).

    ``totals`` has one current value per ``by`` and ``key``. Each trigger hands over the changed ones; the stored values
    of the groups they touch are read, and only these groups are ranked again (``ranks``, by trigger).
    """

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        values = KeyedLog(batch.sparkSession, f"{path}/values", [*by, *key], by)
        changed = _landed(batch, f"{path}/changed", batch_id).withColumn(ORDER, F.lit(1))
        known = values.before(batch_id, changed)
        rows = changed if known is None else changed.unionByName(known.withColumn(ORDER, F.lit(0)))
        current = last_per_key(rows, [*by, *key], [ORDER]).drop(ORDER)
        write_batch(top_n_per(current, by, value, tie, n), f"{path}/ranks", batch_id)
        values.write(batch_id, changed.drop(ORDER))
        files.remove(batch.sparkSession, f"{path}/changed")

    return totals.writeStream.outputMode("update").foreachBatch(on_batch)


def current_ranks(spark, path: str, by: Sequence[str]) -> DataFrame:
    """The latest ranks of every group that :func:`top_n_stream` has ranked."""
    ranks = read_batches(spark, f"{path}/ranks")
    last = ranks.groupBy(*by).agg(F.max(BATCH).alias(BATCH))
    return ranks.join(last, [*by, BATCH]).drop(BATCH)


FIRST = "__first"
ORDER = "__order"


def _with_carried(batch: DataFrame, outs: Mapping[str, Running], stored: DataFrame | None) -> DataFrame:
    """The batch's rows with their values in columns named like the outputs' inputs, and for every key
    of the batch that is known from earlier batches one row before the first, holding its last values."""
    rows = batch.withColumns({_value(n): r.value for n, r in outs.items()}).withColumn(FIRST, F.lit(1))
    if stored is None:
        return rows
    return rows.unionByName(stored.withColumn(FIRST, F.lit(0)), allowMissingColumns=True)


def _value(name: str) -> str:
    return f"__s_{name}"


def _of_values(outs: Mapping[str, Running]) -> dict[str, Running]:
    return {n: Running(r.kind, F.col(_value(n))) for n, r in outs.items()}


def _last(done: DataFrame, key, order, outs) -> DataFrame:
    """The last values of every key, as they enter the next batch."""
    last = last_per_key(done.select(*key, *order, *outs), key, order)
    return last.select(*key, *[F.col(n).alias(_value(n)) for n in outs])


def _written(spark, path: str, batch_id: int) -> DataFrame:
    return spark.read.parquet(f"{path}/{BATCH}={batch_id}")


def _landed(batch: DataFrame, path: str, batch_id: int) -> DataFrame:
    """The micro-batch written down once, so that its several uses do not read the source each time."""
    write_batch(batch, path, batch_id)
    return _written(batch.sparkSession, path, batch_id)


def scan_stream(
    df: DataFrame, key: Sequence[str], order: Sequence[str], outs: Mapping[str, Running], path: str, state: str
) -> DataStreamWriter:
    """Running values over a stream, one output row per input row, for keys of any size.

    Each micro-batch goes through the skew-safe :func:`scan`; each key's last values enter it as a row
    before the first. Only keys present in the batch are looked up in the stored state.
    """

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        last = KeyedLog(batch.sparkSession, f"{state}/last", key)
        batch = _landed(batch, f"{state}/arrived", batch_id)
        rows = _with_carried(batch, outs, last.before(batch_id, batch))
        done = scan(rows, key, [FIRST, *order], _of_values(outs)).where(F.col(FIRST) == 1)
        write_batch(done.select(*batch.columns, *outs), path, batch_id)
        last.write(batch_id, _last(_written(batch.sparkSession, path, batch_id), key, order, outs))
        files.remove(batch.sparkSession, f"{state}/arrived")

    return df.writeStream.foreachBatch(on_batch)


def changelog_batches(
    df: DataFrame, key: Sequence[str], order: Sequence[str], outs: Mapping[str, Running], path: str, state: str
) -> DataStreamWriter:
    """The change log of running aggregates over a stream, for keys of any size."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        last = KeyedLog(batch.sparkSession, f"{state}/last", key)
        batch = _landed(batch, f"{state}/arrived", batch_id)
        rows = _with_carried(batch, outs, last.before(batch_id, batch))
        log = to_changelog(rows, key, [FIRST, *order], _of_values(outs)).where(F.col(FIRST) == 1).drop(FIRST)
        write_batch(log, path, batch_id)
        adds = _written(batch.sparkSession, path, batch_id).where(F.col(IS_ADD))
        last.write(batch_id, _last(adds, key, order, outs))
        files.remove(batch.sparkSession, f"{state}/arrived")

    return df.writeStream.foreachBatch(on_batch)


def _placed(batch: DataFrame, key, order, stored: DataFrame | None, state: str, batch_id: int) -> DataFrame:
    """The batch's rows with their place ``pos`` in their key's order, counted on from earlier batches."""
    count = {"pos": running_count()}
    rows = _with_carried(batch, count, stored if stored is None else stored.select(*key, _value("pos")).distinct())
    placed = scan(rows, key, [FIRST, *order], _of_values(count)).where(F.col(FIRST) == 1)
    write_batch(placed.select(*batch.columns, "pos"), f"{state}/rows", batch_id)
    return _written(batch.sparkSession, f"{state}/rows", batch_id)


def count_tumbling_batches(
    df: DataFrame, key: Sequence[str], order: Sequence[str], n: int, aggs: Mapping[str, Agg], path: str, state: str
) -> DataStreamWriter:
    """Count windows over a stream, for keys of any size.

    Rows are numbered across micro-batches. The state of a key is one row: how many rows it had, and the partial
    aggregates of its window that is not full yet. A batch reads and writes it for the keys it brings.
    """

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        open_ = KeyedLog(spark, f"{state}/open", key)
        batch = _landed(batch, f"{state}/arrived", batch_id)
        stored = open_.before(batch_id, batch)
        placed = _placed(batch, key, order, stored, state, batch_id)
        parts = placed.groupBy(*key, F.floor((F.col("pos") - 1) / n).alias("window_no")).agg(
            F.count(F.lit(1)).alias("__n"), *[a.of_rows().alias(name) for name, a in aggs.items()]
        )
        if stored is not None:
            waiting = stored.where(F.col("window_no").isNotNull()).drop(_value("pos"))
            parts = parts.unionByName(waiting).groupBy(*key, "window_no").agg(
                F.sum("__n").alias("__n"), *[a.of_parts(name).alias(name) for name, a in aggs.items()]
            )
        parts = _landed(parts, f"{state}/parts", batch_id)
        write_batch(parts.where(F.col("__n") == n).drop("__n"), path, batch_id)
        ends = placed.groupBy(*key).agg(F.max("pos").alias(_value("pos")))
        both = ends.unionByName(parts.where(F.col("__n") < n), allowMissingColumns=True)
        rest = [c for c in both.columns if c not in key]
        open_.write(batch_id, both.groupBy(*key).agg(*[F.first(c, ignorenulls=True).alias(c) for c in rest]))
        for name in ("arrived", "rows", "parts"):
            files.remove(spark, f"{state}/{name}")

    return df.writeStream.foreachBatch(on_batch)


def count_sliding_batches(
    df: DataFrame, key: Sequence[str], order: Sequence[str], size: int, slide: int, aggs: Mapping[str, Agg], path: str, state: str
) -> DataStreamWriter:
    """The last ``size`` rows of a key at every ``slide``-th row, over a stream.

    Rows are numbered across micro-batches. The state of a key is what windows of later rows still need, its last
    ``size`` rows; a batch reads and writes it for the keys it brings.
    """
    names = list(dict.fromkeys([*key, *order, *[f"__a{i}" for i in range(len(aggs))]]))

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        tails = KeyedLog(spark, f"{state}/tail", key)
        batch = batch.withColumns({f"__a{i}": a.value for i, a in enumerate(aggs.values())}).select(*names)
        batch = _landed(batch, f"{state}/arrived", batch_id)
        stored = tails.before(batch_id, batch)
        ends = None if stored is None else stored.groupBy(*key).agg(F.max("pos").alias(_value("pos")))
        new = _placed(batch, key, order, ends, state, batch_id).withColumn("__new", F.lit(True))
        if stored is not None:
            new = new.unionByName(stored.withColumn("__new", F.lit(False)))
        made = {name: Agg(a.kind, F.col(f"__a{i}")) for i, (name, a) in enumerate(aggs.items())}
        write_batch(block_windows(new, key, "pos", size, slide, made, fires=F.col("__new")), path, batch_id)
        # of every key of the batch the rows that lie behind its last one by less than size
        end = F.max("pos").over(Window.partitionBy(*key))
        tail = new.withColumn("__end", end).where(F.col("pos") > F.col("__end") - size)
        tails.write(batch_id, tail.select(*names, "pos"))
        for name in ("arrived", "rows"):
            files.remove(spark, f"{state}/{name}")

    return df.writeStream.foreachBatch(on_batch)


def lateness_stream(
    df: DataFrame, key: Sequence[str], t: str, arrival: Sequence[str], size: str, delay: str, lateness: str, value: Column,
    path: str, out: str = "total",
) -> DataStreamWriter:
    """Tumbling windows that fire again for allowed late rows, and rows that come too late, over a stream.

    The same results as :func:`~sparkstream.operators.lateness.tumbling_with_lateness` over all rows in arrival order;
    micro-batches must follow that order. Under ``path``: ``firings`` and ``late`` hold the outputs; ``windows`` the sums
    of windows that wait for the watermark, or may be revised; ``marks`` the largest time seen. Rows without a time
    go to ``late``. Windows are dropped from the state when no allowed row can come any more.
    """
    group = [*key, "window_start", "window_end"]

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = _written(spark, f"{path}/marks", batch_id - 1).first()[0] if batch_id else None
        rows = _landed(batch.withColumn("__v", value), f"{path}/arrived", batch_id)
        newest = rows.agg(F.max(t)).first()[0]
        mark = max((m for m in (before, newest) if m is not None), default=None)
        one = spark.range(0, 1, 1, 1).select(F.lit(mark).cast("timestamp").alias("mark"))
        write_batch(one, f"{path}/marks", batch_id)
        timed = rows.where(F.col(t).isNotNull())
        placed = classify(timed, t, arrival, size, delay, lateness, F.lit(before).cast("timestamp"))
        placed = _landed(placed, f"{path}/placed", batch_id)
        late = placed.where(F.col("status") == LATE).drop("__v", "status")
        untimed = rows.where(F.col(t).isNull()).drop("__v")
        write_batch(late.unionByName(untimed, allowMissingColumns=True), f"{path}/late", batch_id)
        held = _written(spark, f"{path}/windows", batch_id - 1) if batch_id else None
        watermark = watermark_at(F.lit(mark).cast("timestamp"), delay)
        _fire(placed, held, group, arrival, watermark, lateness, out, path, batch_id)

    return df.writeStream.foreachBatch(on_batch)


def flush_windows(spark, key: Sequence[str], path: str, last_batch: int, out: str = "total") -> None:
    """End of the stream: windows that still wait for the watermark fire."""
    waiting = _written(spark, f"{path}/windows", last_batch).where(F.col("__firing").isNull())
    fired = waiting.select(*key, "window_start", "window_end", F.lit(0).cast("long").alias("firing"), F.col("__v").alias(out))
    write_batch(fired, f"{path}/firings", last_batch + 1)


def _fire(placed, held, group, arrival, watermark, lateness, out, path, batch_id) -> None:
    sums = placed.where(F.col("status") == ON_TIME).groupBy(*group).agg(F.sum("__v").alias("__v"))
    if held is not None:
        waiting = held.where(F.col("__firing").isNull()).select(*group, "__v")
        sums = sums.unionByName(waiting).groupBy(*group).agg(F.sum("__v").alias("__v"))
    sums = sums.withColumn("__open", is_open(watermark))
    first = sums.where(~F.col("__open")).select(*group, "__v", F.lit(0).cast("long").alias("__inc"), F.lit(True).alias("__said"))
    again = placed.where(F.col("status") == ALLOWED).select(
        *group, *arrival, "__v", F.lit(1).cast("long").alias("__inc"), F.lit(True).alias("__said")
    )
    rows = again.unionByName(first, allowMissingColumns=True)
    if held is not None:  # what was fired before enters as the row before the first
        known = held.where(F.col("__firing").isNotNull()).select(*group, "__v", F.col("__firing").alias("__inc"), F.lit(False).alias("__said"))
        rows = rows.unionByName(known, allowMissingColumns=True)
    outs = {out: Running("sum", F.col("__v")), "firing": Running("sum", F.col("__inc"))}
    fired = _landed(scan(rows, group, list(arrival), outs), f"{path}/fired", batch_id)
    write_batch(fired.where("__said").select(*group, "firing", out), f"{path}/firings", batch_id)
    last = fired.groupBy(*group).agg(F.max_by(out, "firing").alias("__v"), F.max("firing").alias("__firing"))
    waiting = sums.where(F.col("__open")).select(*group, "__v", F.lit(None).cast("long").alias("__firing"))
    write_batch(waiting.unionByName(last.where(is_open(watermark, lateness))), f"{path}/windows", batch_id)


def match_stream(
    events: DataFrame, pattern: Pattern, key: Sequence[str], t: str, tie: Sequence[str], delay_us: int, path: str,
    keep: Sequence[str] = (), select: Callable[[DataFrame], DataFrame] | None = None,
) -> DataStreamWriter:
    """Patterns over a stream, in event time, with rows up to ``delay_us`` out of order.

    Rows wait until the watermark (largest time seen - delay) has passed them. Each row is written once, in the slice of
    its micro-batch; the commit record names the slices with their times. A micro-batch looks at the keys that have rows
    between the last watermark and this one, or a start whose time ran out between them, and matches only their rows,
    from the slices that reach into the time a match can take. Slices older than watermark - within are removed. Under
    ``path``: ``matches``, ``timeouts`` and ``late`` hold the outputs, ``slices`` and ``commits`` the state.
    """
    if pattern.within_us is None:
        raise ValueError("a pattern over a stream needs within")
    order = [t, *tie]
    cols = list(dict.fromkeys([*key, *order, *keep]))

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        held = _slices(spark, path, batch_id - 1)
        before = held["mark"]
        at = F.unix_micros(t)
        # a row without a time can never be released: it is set aside with the late ones
        late = at.isNull() if before is None else F.coalesce(at <= before, F.lit(True))
        here = f"{path}/slices/{batch_id}"
        bucket = F.pmod(F.xxhash64(*key), F.lit(BUCKETS)) if key else F.lit(0)
        sorted_ = batch.select(*cols, bucket.cast("int").alias(BUCKET), late.alias("__late")).sortWithinPartitions(BUCKET)
        sorted_.write.mode("overwrite").partitionBy("__late").parquet(here)
        schema = batch.select(*cols).schema
        found = files.names(spark, here)
        slices, mark = list(held["slices"]), before
        if "__late=false" in found:
            low, high = spark.read.schema(schema).parquet(f"{here}/__late=false").agg(F.min(at), F.max(at)).first()
            slices.append({"name": f"{batch_id}/__late=false", "low": low, "high": high})
            mark = max(m for m in (before, high - delay_us) if m is not None)
        if "__late=true" in found:
            write_batch(spark.read.schema(schema).parquet(f"{here}/__late=true"), f"{path}/late", batch_id)
        elif batch_id == 0:
            write_batch(spark.createDataFrame([], schema).coalesce(1), f"{path}/late", batch_id)
        if mark is not None:
            _advance(_young(spark, path, slices, schema, pattern, key, t, before, mark), pattern, key, order, keep, t, before, mark, path, batch_id, select)
        young = [x for x in slices if mark is None or x["high"] > mark - pattern.within_us]
        record = {"mark": mark, "slices": young, "schema": schema.json()}
        files.write_text(spark, f"{path}/commits/{batch_id}.json", json.dumps(record))
        named = {x["name"].split("/")[0] for x in [*held["slices"], *young]}
        for name in files.names(spark, f"{path}/slices"):
            if name not in named:
                files.remove(spark, f"{path}/slices/{name}")

    return events.writeStream.foreachBatch(on_batch)


def _slices(spark, path: str, batch_id: int) -> dict:
    text = files.read_text(spark, f"{path}/commits/{batch_id}.json") if batch_id >= 0 else None
    return json.loads(text) if text else {"mark": None, "slices": [], "schema": None}


def _young(spark, path: str, slices: list[dict], schema, pattern: Pattern, key, t: str, before: int | None, mark: int | None) -> DataFrame:
    """Rows up to ``mark`` (all when None) that matches or timeouts after ``before`` can hold, of the keys that have any."""
    at = F.unix_micros(t)
    least = None if before is None else before - pattern.within_us

    def between(low: int | None, high: int | None) -> DataFrame:
        some = [x["name"] for x in slices if (low is None or x["high"] > low) and (high is None or x["low"] <= high)]
        wide = T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])
        rows = spark.read.schema(wide).parquet(*[f"{path}/slices/{n}" for n in some]) if some else spark.createDataFrame([], wide)
        if low is not None:
            rows = rows.where(at > low)
        return rows if high is None else rows.where(at <= high)

    rows = between(least, mark)
    if not key or before is None:
        return rows.drop(BUCKET)
    due = between(least, None if mark is None else mark - pattern.within_us)
    if pattern.stages[0].cond is not None:
        due = due.where(pattern.stages[0].cond)
    touched = between(before, mark).select(*key, BUCKET).unionByName(due.select(*key, BUCKET)).distinct()
    return rows.join(touched, [*key, BUCKET], "left_semi").drop(BUCKET)


def flush_matches(
    spark, pattern: Pattern, key, t: str, tie, path: str, last_batch: int, keep=(), select=None
) -> None:
    """End of the stream: treat everything still waiting as released, and open starts as timed out."""
    held = _slices(spark, path, last_batch)
    if held["schema"] is None:
        return
    schema = T.StructType.fromJson(json.loads(held["schema"]))
    rows = _young(spark, path, held["slices"], schema, pattern, key, t, held["mark"], None)
    _advance(rows, pattern, key, [t, *tie], keep, t, held["mark"], None, path, last_batch + 1, select)


def _advance(rows, pattern, key, order, keep, t, before, mark, path, batch_id, select) -> None:
    """Match the rows up to ``mark`` (all when None) and write what became final after ``before``."""
    at = F.unix_micros(t)
    released = rows if mark is None else rows.where(at <= mark)
    result: Matches = match(released, pattern, key, order, keep, t=t, settle=False)
    last_stage = pattern.stages[-1].name
    done = result.rows
    if before is not None:
        done = done.where(F.unix_micros(F.col(f"{last_stage}_last.{t}")) > before)
    done = done.drop("match_id", *[c for c in done.columns if c.startswith("__")])
    write_batch(select(done) if select else done, f"{path}/matches", batch_id)
    if result.timeouts is None:
        return
    due = F.unix_micros(F.col(f"{pattern.stages[0].name}_first.{t}")) + pattern.within_us
    expired = result.timeouts
    if mark is not None:
        expired = expired.where(due <= mark)
    if before is not None:
        expired = expired.where(due > before)
    write_batch(expired, f"{path}/timeouts", batch_id)
