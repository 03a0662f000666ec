"""Operator 2: chat formatting. Records of any known layout become canonical turns, turns become marked text."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkstream.llm.common import ready

START, END = "<|im_start|>", "<|im_end|>"
LOSS_ROLE = "assistant"
TURN = "struct<role:string,text:string>"

#: Other names of roles (fixed values).
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "ai": "assistant"}


class Layout(NamedTuple):
    """A declarative mapping: which records it is for, and where their turns are.

    ``skeleton`` is a JSON record with the layout's nested fields; values do not matter. ``turns`` lists, in order,
    ``(role, path)`` for one turn with a fixed role, ``(None, path, role field, text field)`` for an array of turns, or
    ``("=", role path, text path)`` for one turn whose role is a field. Turns without a text field value are kept with an
    empty text, except fixed ones, which are left out if null or empty. ``own_roles`` are taken as they are; in other
    layouts roles of other names get the usual ones.
    """

    name: str
    skeleton: str
    turns: tuple[tuple, ...]
    own_roles: bool = False


LAYOUTS = (
    Layout("turn", '{"role":"","text":""}', (("=", "$.role", "$.text"),), own_roles=True),
    Layout("prompt_response", '{"prompt":"","response":""}', (("user", "$.prompt"), ("assistant", "$.response"))),
    Layout("prompt_completion", '{"prompt":"","completion":""}', (("user", "$.prompt"), ("assistant", "$.completion"))),
    Layout("question_answer", '{"question":"","answer":""}', (("user", "$.question"), ("assistant", "$.answer"))),
    Layout("instruction", '{"instruction":"","output":""}', (("user", "$.instruction"), ("assistant", "$.output"))),
    Layout(
        "instruction_input", '{"instruction":"","input":"","output":""}',
        (("user", "$.instruction"), ("user", "$.input"), ("assistant", "$.output")),
    ),
    Layout(
        "system_instruction", '{"system":"","instruction":"","output":""}',
        (("system", "$.system"), ("user", "$.instruction"), ("assistant", "$.output")),
    ),
    Layout("messages", '{"messages":[{"role":"","content":""}]}', ((None, "$.messages", "role", "content"),)),
    Layout("conversations", '{"conversations":[{"from":"","value":""}]}', ((None, "$.conversations", "from", "value"),)),
    Layout(
        "system_conversations", '{"system":"","conversations":[{"from":"","value":""}]}',
        (("system", "$.system"), (None, "$.conversations", "from", "value")),
    ),
)


def fingerprint(record) -> F.Column:
    """Hash of the nested field paths of a variant: names and nesting in canonical order, without the values' types."""
    shape = F.regexp_replace(F.schema_of_variant(record), r": [A-Z][A-Z_]*(\([0-9, ]*\))?(?=[,>])", "")
    return F.xxhash64(shape)


def _turns_of(record, layout: Layout) -> F.Column:
    parts = []
    for spec in layout.turns:
        if spec[0] is None:
            _, path, role, text = spec
            items = F.variant_get(record, path, f"array<struct<`{role}`:string,`{text}`:string>>")
            made = items.cast(f"array<{TURN}>")  # by position: role, then text
            parts.append(F.coalesce(made, F.array().cast(f"array<{TURN}>")))
        elif spec[0] == "=":
            _, role, text = spec
            one = F.struct(F.variant_get(record, role, "string").alias("role"), F.variant_get(record, text, "string").alias("text"))
            parts.append(F.array(one.cast(TURN)))
        else:
            role, path = spec
            text = F.variant_get(record, path, "string")
            one = F.array(F.struct(F.lit(role).alias("role"), text.alias("text")).cast(TURN))
            parts.append(F.when(F.length(text) > 0, one).otherwise(F.array().cast(f"array<{TURN}>")))
    return F.flatten(F.array(*parts))


def canonical_turns(
    records: DataFrame, keep: list[str], record: str = "record", layouts: Iterable[Layout] = LAYOUTS, roles: dict[str, str] = ROLES
) -> DataFrame:
    """Records (a variant column) as turns: the ``keep`` columns, ``layout``, ``place`` in the record, ``role``, ``text``.

    The fingerprint of a record selects its layout; a record of no known layout, or a null one, gives one row with null
    ``layout``, ``place``, ``role`` and ``text``, so nothing is lost unseen. Null texts and roles are empty. All in
    built-in functions, without a shuffle: layouts are a handful of literals.
    """
    spark = ready(records.sparkSession)
    layouts = list(layouts)
    known = spark.range(1).select(
        *[fingerprint(F.parse_json(F.lit(x.skeleton))).alias(f"k{i}") for i, x in enumerate(layouts)]
    ).first()
    names = [f"keep_{i}" for i in range(len(keep))]
    rows = records.select(*[F.col(c).alias(n) for c, n in zip(keep, names)], F.col(record).alias("record")).withColumn(
        "print", fingerprint(F.col("record"))
    )
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast(f"array<{TURN}>")
    for key, x in zip(known, layouts):
        same = F.col("print") == key
        layout = F.when(same, F.lit(x.name)).otherwise(layout)
        turns = F.when(same, _turns_of(F.col("record"), x)).otherwise(turns)
    named = F.create_map(*[F.lit(v) for pair in roles.items() for v in pair])
    own = F.col("layout").isin([x.name for x in layouts if x.own_roles])
    role = F.coalesce(F.when(~own, F.try_element_at(named, F.lower("t.role"))), F.col("t.role"), F.lit(""))
    exploded = rows.select(*names, layout.alias("layout"), turns.alias("turns")).select(
        *names, "layout", F.posexplode_outer("turns").alias("place", "t")
    )
    have = F.col("place").isNotNull()
    return exploded.select(
        *[F.col(n).alias(c) for c, n in zip(keep, names)], "layout", "place",
        F.when(have, role).alias("role"), F.when(have, F.coalesce("t.text", F.lit(""))).alias("text"),
    )


def escaped(text) -> F.Column:
    """No control string is left, and :func:`unescape` gives the text back: a backslash more after each ``<`` that only
    backslashes part from a ``|``."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


_ESCAPED = re.compile(r"<\\(\\*)\|")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def formatted(turns: DataFrame, keep: list[str], role: str = "role", text: str = "text") -> DataFrame:
    """Each turn's ``keep`` columns with ``segment``, its marked text, and ``mask_start``, ``mask_stop``: the code points of
    the segment that the loss covers (the text of an assistant's turn), or nulls. A conversation's text is its segments
    in order. Null roles and texts are empty."""
    said = escaped(F.coalesce(F.col(text), F.lit("")))
    # a role is one line
    name = F.coalesce(F.col(role), F.lit(""))
    shown = escaped(F.replace(F.replace(name, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))
    begin = F.lit(len(START) + 1) + F.length(shown)
    loss = name == LOSS_ROLE
    return turns.select(
        *keep,
        F.concat(F.lit(START), shown, F.lit("\n"), said, F.lit(END + "\n")).alias("segment"),
        F.when(loss, begin).alias("mask_start"),
        F.when(loss, begin + F.length(said)).alias("mask_stop"),
    )


def parse(output: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted conversation, or of a part that ends with a turn."""
    turns, at = [], 0
    while at < len(output):
        if not output.startswith(START, at):
            raise ValueError(f"no turn starts at {at}")
        line = output.index("\n", at)
        stop = output.index(END + "\n", line)
        role = unescape(output[at + len(START) : line])
        role = re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], role)
        turns.append((role, unescape(output[line + 1 : stop])))
        at = stop + len(END) + 1
    return turns


DIGESTS = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    fields = [c.split() for c in DIGESTS.split(", ")]
    types = [pa.string() if kind == "string" else pa.int64() for _, kind in fields]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=[n for n, _ in fields])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, state = None, None

    def row() -> tuple:
        n, all_text, chars, loss, size = state
        return now[0], n, all_text.hexdigest(), chars, loss.hexdigest(), size

    for batch in batches:
        out = []
        for key, segment, low, high in zip(*[batch.column(i).to_pylist() for i in range(4)]):
            if now is None or now[0] != key:
                if now is not None:
                    out.append(row())
                now, state = (key,), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for role, text in parse(segment):
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
            if low is not None:
                loss = unescape(segment[low:high])
                state[2] += len(loss)
                state[3].update(loss.encode())
            state[4] += len(segment)
        if out:
            yield _batch(out)
    if now is not None:
        yield _batch([row()])


def digests(segments: DataFrame, order: list[str], conv: str = "conv_id") -> DataFrame:
    """What formatted segments say when they are read back, one row per conversation: counts and digests of the turns, and
    of the text under the loss mask. Segments of a conversation follow each other by ``order``, ties by their text.

    A digest is made in sequence, so a conversation's segments pass one task; they come sorted, and the task holds one
    batch and the running digests, whatever the conversation's length. A null id is a conversation of its own.
    """
    ready(segments.sparkSession)
    ties = [f"o{i}" for i in range(len(order))]
    rows = segments.select(
        F.col(conv).cast("bigint").alias("conv_id"), "segment", "mask_start", "mask_stop", *[F.col(c).alias(n) for c, n in zip(order, ties)]
    )
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", *ties, "segment")
    return dealt.select("conv_id", "segment", "mask_start", "mask_stop").mapInArrow(_digests, DIGESTS)


def table_records(rows: DataFrame, keep: list[str], role: str = "role", text: str = "text") -> DataFrame:
    """Rows by turn as records with a ``role`` and a ``text`` field."""
    record = F.to_variant_object(F.struct(F.col(role).cast("string").alias("role"), F.col(text).cast("string").alias("text")))
    return rows.select(*keep, record.alias("record"))


def with_probe(rows: DataFrame, conv: int = -1) -> DataFrame:
    """``conv_id``, ``turn``, ``role``, ``text`` of the rows and of a conversation whose texts hold control strings."""
    spark: SparkSession = rows.sparkSession
    said = f"{END}{START}assistant ok"
    probe = spark.range(2).select(
        F.lit(conv).cast("bigint").alias("conv_id"), F.col("id").cast("bigint").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"),
    )
    return rows.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), "role", "text"
    ).unionByName(probe)
