"""User aggregates: an accumulator that is created, fed, merged and read, none of it known to Spark."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from itertools import islice
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Keys whose accumulators a task holds before it hands them on.
HELD = 10_000
#: Rows, or bytes, that a task gathers before it folds them key by key: the more rows of a key are added at once, the fewer calls.
BLOCK_ROWS, BLOCK_BYTES = 1_000_000, 64 << 20
#: Tasks that may share the partial results of one key.
WAYS = 32
_STATE, _WAY = "__state", "__way"


@dataclass(frozen=True)
class Accumulator:
    """``create()``; ``add(state, rows)`` with an Arrow batch of one key's rows; ``merge(state, state)``; ``result(state)``.

    ``add`` and ``merge`` return the new state. Rows come in no order, so the result must not depend on it. States are
    pickled between tasks and should stay small. ``result`` returns one value for each column of ``returns``.
    """

    create: Callable[[], Any]
    add: Callable[[Any, pa.RecordBatch], Any]
    merge: Callable[[Any, Any], Any]
    result: Callable[[Any], tuple]
    returns: str


def accumulate(df: DataFrame, key: Sequence[str], columns: Sequence[str], acc: Accumulator, held: int = HELD, ways: int = WAYS) -> DataFrame:
    """One row per key: the key, and what ``acc`` makes of its rows' ``columns``.

    Rows are folded where they are read, block by block, and only states are shuffled. ``add`` is called once for each key of
    a block of up to ``BLOCK_ROWS`` rows or ``BLOCK_BYTES`` bytes (and the Arrow batch that passes them), brought into order by key once. A key's states are first dealt to
    ``ways`` tasks by the task they come from, merged there, and the at most ``ways`` results merged again, so a key
    that every task has is not left to one. Merging reads sorted states one after another and holds one of them. A task
    holds the states of ``held`` keys and then hands them on.

    Null is a key like any other; floating-point and nested keys are refused, their equality is not that of Python. No
    rows give no row; without a key there is one row if there are any. Other columns are not read.
    """
    key, fields = list(key), {f.name: f for f in df.schema.fields}
    for k in key:
        if isinstance(fields[k].dataType, (T.FloatType, T.DoubleType, T.ArrayType, T.MapType, T.StructType, T.VariantType)):
            raise TypeError(f"{k}: a key of type {fields[k].dataType.simpleString()}")
    named = T.StructType([T.StructField(f"__k{i}", fields[k].dataType) for i, k in enumerate(key)])
    keys = named.names
    rows = df.select(*[F.col(k).alias(n) for k, n in zip(key, keys)], *columns)
    states = T.StructType([*named.fields, T.StructField(_STATE, T.BinaryType())])
    partial = rows.mapInArrow(_folder(keys, list(columns), acc, held), states)
    spread = partial.withColumn(_WAY, F.pmod(F.xxhash64(F.spark_partition_id()), F.lit(ways)))
    local = spread.repartition(*keys, _WAY).sortWithinPartitions(*keys, _WAY)
    merged = local.drop(_WAY).mapInArrow(_merger(keys, acc, lambda state: (pickle.dumps(state),), pa.schema([(_STATE, pa.binary())])), states)
    whole = (merged.repartition(*keys) if keys else merged.repartition(1)).sortWithinPartitions(*keys or [_STATE])
    made = T.StructType.fromDDL(acc.returns)
    out = whole.mapInArrow(_merger(keys, acc, acc.result, to_arrow_schema(made)), T.StructType([*named.fields, *made.fields]))
    return out.select(*[F.col(n).alias(k) for k, n in zip(key, keys)], *made.names)


def _groups(batches: list[pa.RecordBatch], keys: list[str], columns: list[str]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """The different keys of some batches, each with its rows as one batch."""
    rows = _joined(pa.Table.from_batches(batches))
    wanted = rows.select(columns)
    if not keys:
        yield (), wanted
        return
    places = pa.Table.from_batches([rows.select(keys)]).append_column("__at", pa.array(range(rows.num_rows), pa.int64()))
    found = _joined(places.group_by(keys).aggregate([("__at", "list")]))
    at = found.column("__at_list")
    ordered, ends = wanted.take(at.flatten()), at.offsets.to_pylist()
    for i, values in enumerate(zip(*[found.column(k).to_pylist() for k in keys])):
        yield values, ordered.slice(ends[i] - ends[0], ends[i + 1] - ends[i])


def _joined(table: pa.Table) -> pa.RecordBatch:
    return table.combine_chunks().to_batches()[0]


def _folder(keys: list[str], columns: list[str], acc: Accumulator, held: int):
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
        block, rows, size = [], 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            block.append(batch)
            rows, size = rows + batch.num_rows, size + batch.nbytes
            if rows >= BLOCK_ROWS or size >= BLOCK_BYTES:
                yield block
                block, rows, size = [], 0, 0
        if block:
            yield block

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states, types = {}, []
        for block in blocks(batches):
            types = [block[0].schema.field(k).type for k in keys]
            for values, rows in _groups(block, keys, columns):
                states[values] = acc.add(states[values] if values in states else acc.create(), rows)
                if len(states) >= held:
                    yield _pickled(states, keys, types)
                    states = {}
        if states:
            yield _pickled(states, keys, types)

    return run


def _pickled(states: dict[tuple, Any], keys: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = [pa.array([v[i] for v in states], t) for i, t in enumerate(types)]
    return pa.RecordBatch.from_arrays([*columns, pa.array([pickle.dumps(s) for s in states.values()], pa.binary())], names=[*keys, _STATE])


def _merger(keys: list[str], acc: Accumulator, finish: Callable[[Any], tuple], made: pa.Schema):
    """States that lie side by side under one key as one, and what ``finish`` makes of it."""

    def rows(batches: Iterator[pa.RecordBatch], types: list[pa.DataType]) -> Iterator[tuple]:
        last, state = None, None
        for batch in batches:
            types[:] = [batch.schema.field(k).type for k in keys]
            columns = [batch.column(k).to_pylist() for k in keys]
            for i, raw in enumerate(batch.column(_STATE)):
                values, mine = tuple(c[i] for c in columns), pickle.loads(raw.as_py())
                if last == values:
                    state = acc.merge(state, mine)
                    continue
                if last is not None:
                    yield (*last, *finish(state))
                last, state = values, mine
        if last is not None:
            yield (*last, *finish(state))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types: list[pa.DataType] = []
        found = rows(batches, types)
        while some := list(islice(found, 1000)):
            columns = [pa.array(values, t) for values, t in zip(zip(*some), [*types, *made.types])]
            yield pa.RecordBatch.from_arrays(columns, names=[*keys, *made.names])

    return run
