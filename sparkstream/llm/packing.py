"""Operator 10: token ids as packed binary rows, by best-fit-decreasing packing."""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkstream.llm.common import ready

#: Tokens that are packed at once: a task holds so many, and a row's worth more.
WINDOW = 4_000_000
FIELDS = (
    ("n_tokens", "int"), ("doc_ids", "array<bigint>"), ("parts", "array<int>"), ("cu_seqlens", "array<int>"),
    ("resets", "array<int>"), ("ids", "binary"),
)
_TYPES = (pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary())


class Capacities:
    """Open rows by the room they have left. A segment tree over the amounts finds the least room of ``need`` or more."""

    def __init__(self, most: int) -> None:
        self.size = 1 << most.bit_length()
        self.some = bytearray(2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(self.size)]

    def add(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        node = room + self.size
        while node and not self.some[node]:
            self.some[node] = 1
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """(room, row) of the row opened first among those with the least sufficient room, which is taken out."""
        some, node = self.some, need + self.size
        while not some[node]:
            while node & 1:  # a right child: nothing larger below this parent
                node >>= 1
            if not node:
                return None
            node += 1
        while node < self.size:
            node *= 2
            if not some[node]:
                node += 1
        room = node - self.size
        row = self.rows[room].pop(0)
        if not self.rows[room]:
            some[node] = 0
            while node > 1 and not (some[node] or some[node ^ 1]):
                node >>= 1
                some[node] = 0
        return room, row


def best_fit(lengths: Iterable[int], width: int) -> list[list[int]]:
    """Rows of places in ``lengths``, longest first, each piece in the fullest row that has room. Ties go in order."""
    lengths = list(lengths)
    if any(n > width or n < 1 for n in lengths):
        raise ValueError(f"pieces must have 1 to {width} tokens")
    rows: list[list[int]] = []
    room_of = Capacities(width)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        need = lengths[i]
        found = room_of.take(need)
        if found is None:
            found = width, len(rows)
            rows.append([])
        room, row = found
        rows[row].append(i)
        if room > need:
            room_of.add(room - need, row)
    return rows


_ENCODINGS: dict[str, object] = {}


def _encoding(ranks_file: str):
    if ranks_file not in _ENCODINGS:
        import public_tokenizers
        import tiktoken

        with open(ranks_file, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        _ENCODINGS[ranks_file] = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
    return _ENCODINGS[ranks_file]


def _rows(pieces: list[tuple[int | None, int, np.ndarray]], width: int, pad: int, kind: np.dtype) -> pa.RecordBatch:
    columns: list[list] = [[] for _ in FIELDS]
    for row in best_fit([len(p[2]) for p in pieces], width):
        sizes = np.cumsum([0] + [len(pieces[i][2]) for i in row])
        ids = np.full(width, pad, dtype=kind)
        np.concatenate([pieces[i][2] for i in row], out=ids[: sizes[-1]], casting="unsafe")
        got = (int(sizes[-1]), [pieces[i][0] for i in row], [pieces[i][1] for i in row], sizes, sizes[:-1], ids.tobytes())
        for column, value in zip(columns, got):
            column.append(value)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES)], names=[n for n, _ in FIELDS])


def pack(
    docs: DataFrame, ranks_file: str, end: int, pad: int, width: int = 2048, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Packed rows of ``width`` ids: the token ids of all texts, each text with the ``end`` id behind it.

    ``ids`` is the row of the id matrix, little-endian and filled up with ``pad``: unsigned 16-bit numbers if all ids
    fit, else 32-bit ones. Of a row's segments, ``doc_ids`` and ``parts`` say what they are, ``cu_seqlens`` where they
    begin and end (0, ..., ``n_tokens``), ``resets`` where position ids start again at 0. A text of more than ``width``
    ids is cut into full parts and a rest, numbered from 0, so nothing is lost.

    Each task packs what it reads, ``window`` tokens at a time, by best-fit decreasing: memory is bounded, nothing is
    shuffled, and a repeated task gives the same rows. Null and empty texts are the end id alone, repeated rows are packed
    as often as they come, null ids stay null; an empty table gives no row. Other columns are not read.
    """
    kind = np.dtype("<u2") if max(end, pad) < 1 << 16 else np.dtype("<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoding(ranks_file).encode_to_numpy
        pieces: list[tuple[int | None, int, np.ndarray]] = []
        held = 0
        for batch in batches:
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode(value.as_py() or "", disallowed_special=())
                if len(ids) and int(ids.max()) > np.iinfo(kind).max:
                    raise ValueError("an id is too large for the id type that the end and pad ids ask for")
                ids = np.append(ids, end).astype(kind)
                pieces += [(key, k, ids[at : at + width]) for k, at in enumerate(range(0, len(ids), width))]
                held += len(ids)
                if held >= window:
                    yield _rows(pieces, width, pad, kind)
                    pieces, held = [], 0
        if pieces:
            yield _rows(pieces, width, pad, kind)

    ready(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, ", ".join(f"{n} {t}" for n, t in FIELDS))


def position_ids(cu_seqlens: list[int], width: int) -> np.ndarray:
    """Position ids of a row: from 0 in every segment, and 0 in what is filled up."""
    out = np.zeros(width, dtype=np.int64)
    for a, b in zip(cu_seqlens, cu_seqlens[1:]):
        out[a:b] = np.arange(b - a)
    return out


def unpack(packed: DataFrame, width: int = 2048) -> DataFrame:
    """The parts again: ``doc_id``, ``part``, ``ids`` (binary, as packed). Parts of a document, put together in order, are its ids."""
    each = packed.select(
        "ids", (F.length("ids") / width).cast("int").alias("size"), "cu_seqlens", F.posexplode(F.arrays_zip("doc_ids", "parts")).alias("k", "seg")
    )
    low, high = F.element_at("cu_seqlens", F.col("k") + 1), F.element_at("cu_seqlens", F.col("k") + 2)
    return each.select(
        F.col("seg.doc_ids").alias("doc_id"), F.col("seg.parts").alias("part"),
        F.substring(F.col("ids"), low * F.col("size") + 1, (high - low) * F.col("size")).alias("ids"),
    )
