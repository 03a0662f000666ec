"""Change logs of queries, and change records of database tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkstream.plans.cells import measure_cells
from sparkstream.plans.scan import Running, latest, scan, settled

IS_ADD = "is_add"


def to_changelog(
    df: DataFrame, key: Sequence[str], order: Sequence[str], outs: Mapping[str, Running],
    keep: Column | None = None,
) -> DataFrame:
    """The changes a running aggregate makes to its result table, input row by input row.

    Every change withdraws the key's previous row (``is_add`` false) and adds the new one. An
    unchanged result emits nothing. With ``keep`` (a condition on the outputs), a row that stops
    satisfying it is only withdrawn.
    """
    shown = F.lit(True) if keep is None else F.coalesce(keep, F.lit(False))
    state = F.struct(shown.alias("shown"), F.struct(*outs).alias("row"))
    layout = measure_cells(df, key, order)
    now = settled(scan(df, key, order, outs, layout=layout), bool(layout.cells)).withColumn("__now", state)
    both = scan(now, key, order, {"__prev": latest(F.col("__now"))}, inclusive=False, layout=layout).withColumns(
        {
            "__before": F.when(F.col("__prev.shown"), F.col("__prev.row")),
            "__after": F.when(F.col("__now.shown"), F.col("__now.row")),
        }
    )
    changed = ~F.col("__before").eqNullSafe(F.col("__after"))
    pair = F.filter(
        F.array(
            F.struct(F.lit(False).alias(IS_ADD), F.col("__before").alias("row")),
            F.struct(F.lit(True).alias(IS_ADD), F.col("__after").alias("row")),
        ),
        lambda change: change["row"].isNotNull(),
    )
    return (
        both.where(changed)
        .select(*key, *order, F.explode(pair).alias("__change"))
        .select(*key, *order, f"__change.{IS_ADD}", "__change.row.*")
    )


def replay(log: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The table a change log leaves behind: rows added more often than withdrawn."""
    net = log.groupBy(*cols).agg(F.sum(F.when(F.col(IS_ADD), 1).otherwise(-1)).alias("__n"))
    return net.where(F.col("__n") > 0).select(*cols)


def current_rows(
    changes: DataFrame, key: Sequence[str], order: Sequence[str] = ("ts_ms", "pos")
) -> DataFrame:
    """Each key's last change record.

    A maximum over (order, record) with map-side partial results: a key changed very often is
    reduced to one row per task before the shuffle.
    """
    rest = [c for c in changes.columns if c not in key]
    last = F.max_by(F.struct(*rest), F.struct(*order)).alias("__last")
    return changes.groupBy(*key).agg(last).select(*key, "__last.*")


def apply_changes(snapshot: DataFrame, changes: DataFrame, key: Sequence[str], order: Sequence[str] = ("ts_ms", "pos")):
    """The table after a snapshot and the changes logged since it.

    ``snapshot`` has the row columns; ``changes`` has ``op``, ``before``, ``after`` and the order
    columns. A key's last change wins; a deleted key is gone.
    """
    row_key = [F.coalesce(F.col("after")[k], F.col("before")[k]).alias(k) for k in key]
    cols = snapshot.columns
    logged = changes.where(F.col("op").isNotNull()).select(*row_key, *order, "op", "after")
    start = snapshot.select(
        *key, *[F.lit(None).cast(changes.schema[o].dataType).alias(o) for o in order],
        F.lit("r").alias("op"), F.struct(*cols).cast(changes.schema["after"].dataType).alias("after"),
    )
    ranked = [F.col(o).isNotNull().alias(f"k{i}") for i, o in enumerate(order)] + [F.col(o) for o in order]
    last = F.max_by(F.struct("op", "after"), F.struct(*ranked)).alias("__last")
    merged = logged.unionByName(start).groupBy(*key).agg(last)
    return merged.where(F.col("__last.op") != "d").select("__last.after.*").select(*cols)


def reconcile_chunks(
    snapshot: DataFrame, ranges: DataFrame, changes: DataFrame, key: str, pos: str = "pos"
) -> DataFrame:
    """The current table from a snapshot that was read range by range while changes arrived.

    ``ranges`` are half-open key ranges (``low``, ``high``, as :func:`~sparkstream.sources.jdbc.key_ranges` gives them)
    with ``low_pos`` and ``high_pos``: where the log stood before and after the range was read. A row of ``snapshot``
    shows its key at some position between these two. Changes up to the low position are in the snapshot and fall away;
    a key that was changed after it, also while the range was read, is what its last change says. All other rows stand
    as read.

    Each change takes the low position of its range from one ordered pass over changes and range starts; nothing is
    compared range by range. Then one aggregate by key with partial results.
    """
    cols = snapshot.columns
    moved = moved_keys(changes.where(F.col("op").isNotNull()), [key])
    named = moved.select(F.coalesce(F.col("after")[key], F.col("before")[key]).alias(key), pos, "op", "after")
    first = ranges.where(F.col("low").isNull()).select("low_pos").first()
    starts = ranges.where(F.col("low").isNotNull()).select(
        F.col("low").alias(key), F.lit(0).alias("__is_change"), F.lit(0).cast("long").alias("__pos"), F.col("low_pos").alias("__low")
    )
    logged = named.withColumns({"__is_change": F.lit(1), "__pos": F.col(pos)})
    placed = scan(
        logged.unionByName(starts, allowMissingColumns=True), [], [key, "__is_change", "__pos"], {"__from": latest(F.col("__low"))}
    )
    before = F.coalesce(F.col("__from"), F.lit(first.low_pos if first else None))
    later = placed.where(F.col("__is_change") == 1).where(F.col(pos) > before)
    read = snapshot.select(
        key, F.lit(None).cast(changes.schema[pos].dataType).alias(pos), F.lit("r").alias("op"),
        F.struct(*cols).cast(changes.schema["after"].dataType).alias("after"),
    )
    last = F.max_by(F.struct("op", "after"), F.struct(F.col(pos).isNotNull(), F.col(pos), F.col("op") != "d")).alias("__last")
    merged = later.select(key, pos, "op", "after").unionByName(read).groupBy(key).agg(last)
    return merged.where(F.col("__last.op") != "d").select("__last.after.*").select(*cols)


def moved_keys(changes: DataFrame, key: Sequence[str]) -> DataFrame:
    """Updates that change the key itself, rewritten as a delete of the old and an insert of the new."""
    same: Column = F.lit(True)
    for k in key:
        same = same & F.col("before")[k].eqNullSafe(F.col("after")[k])
    moved = (F.col("op") == "u") & F.col("before").isNotNull() & ~same
    none = F.lit(None)
    rest = [c for c in changes.columns if c not in ("op", "before", "after")]
    pieces = F.when(
        moved,
        F.array(
            F.struct(F.lit("d").alias("op"), F.col("before"), none.cast(changes.schema["after"].dataType).alias("after")),
            F.struct(F.lit("c").alias("op"), none.cast(changes.schema["before"].dataType).alias("before"), F.col("after")),
        ),
    ).otherwise(F.array(F.struct("op", "before", "after")))
    return changes.withColumn("__p", F.explode(pieces)).select(*rest, "__p.op", "__p.before", "__p.after")


def changes_to_changelog(changes: DataFrame, order: Sequence[str] = ("ts_ms", "pos")) -> DataFrame:
    """Change records as withdraw / add rows: the before image is withdrawn, the after image added."""
    pair = F.filter(
        F.array(
            F.struct(F.lit(False).alias(IS_ADD), F.col("before").alias("row")),
            F.struct(F.lit(True).alias(IS_ADD), F.col("after").alias("row")),
        ),
        lambda change: change["row"].isNotNull()
        & F.when(change[IS_ADD], F.col("op").isin("c", "r", "u")).otherwise(F.col("op").isin("u", "d")),
    )
    return changes.select(*order, F.explode(pair).alias("__c")).select(*order, f"__c.{IS_ADD}", "__c.row.*")
