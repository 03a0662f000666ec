"""Operator 3: benchmark decontamination by the q-gram lemma in diagonal bands, verified by banded alignment."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkstream.llm.common import fresh, mix, ready

SCHEMA = "doc_id bigint, item_id bigint, start bigint, stop bigint, edits bigint"
#: Characters of benchmark text that one pass over the documents takes along.
BLOCK_CHARS = 4_000_000
#: Items longer than this are searched by windows of this length, half overlapping.
WINDOW = 120
#: Parts of items are found by windows of this length, one every so many characters.
PART, STEP = 60, 10
#: Characters between texts that are searched as one: more than a window with its band.
GAP = 4 * WINDOW
GROUP_CHARS = 1_500_000
_P = 0x9E3779B97F4A7C15


def plain(text: str | None) -> str:
    """Lower case, runs of white space and NUL as one blank, trimmed."""
    return " ".join((text or "").lower().replace("\0", " ").split())


def budget_of(length: int, rate: float) -> int:
    return int(length * rate)


def gram_size(length: int, edits: int, most: int = 12) -> int:
    """The largest q up to ``most`` for which the lemma still asks for sixteen shared q-grams, or for short texts a
    sixth of their length; long q-grams are rare by chance, and many of them close to each other are rarer still."""
    least = min(16, max(1, length // 6))
    return max((q for q in range(1, min(most, length) + 1) if length + 1 - q * (edits + 1) >= least), default=1)


def banded_edits(pattern: str, text: str, low: int, high: int, most: int) -> tuple[int, int, int] | None:
    """Best alignment of the whole pattern with a stretch of ``text`` whose diagonals (text position minus pattern
    position) lie in [low, high]: (edits, start, stop), or None beyond ``most`` edits. Of equals the first stop."""
    whole = text.find(pattern, max(0, low), max(0, high) + len(pattern))
    if whole >= 0:
        return 0, whole, whole + len(pattern)
    letters = np.array(list(map(ord, text)), dtype=np.int64)
    wide = high - low + 1
    far = len(pattern) + wide
    diagonal = np.arange(low, high + 1)
    steps = np.arange(wide)
    # cost[d]: edits up to pattern row i on diagonal d; begin[d]: where that path starts in the text
    inside = (diagonal >= 0) & (diagonal <= len(text))
    cost, begin = np.where(inside, 0, far), diagonal.copy()
    for i, c in enumerate(map(ord, pattern), 1):
        at = diagonal + i  # text characters used so far
        able = (at >= 1) & (at <= len(text))
        miss = np.ones(wide, dtype=np.int64)
        miss[able] = letters[at[able] - 1] != c
        step = np.where(able, cost + miss, far)
        source = begin.copy()
        skip = np.append(cost[1:], far) + 1  # a pattern character without partner comes from the next diagonal
        better = (skip < step) & (at >= 0) & (at <= len(text))
        step = np.where(better, skip, step)
        source = np.where(better, np.append(begin[1:], 0), source)
        # text characters without partner move along the row: a running minimum
        run = np.minimum.accumulate((step - steps) * (1 << 20) + steps)
        left = run & ((1 << 20) - 1)
        cost, begin = (run >> 20) + steps, source[left]
        cost = np.where((at >= 0) & (at <= len(text)), cost, far)
        if cost.min() > most:
            return None
    best = int(cost.argmin())
    return (int(cost[best]), int(begin[best]), int(diagonal[best] + len(pattern))) if cost[best] <= most else None


class Strip(NamedTuple):
    """An item's text and its windows: their length, where they start, the edits each may have."""

    item: int
    text: str
    size: int
    starts: np.ndarray
    edits: int


def _starts(length: int, size: int, step: int) -> np.ndarray:
    return np.append(np.arange(0, length - size, step), length - size)


def strips(item: int, text: str, rate: float) -> list[Strip]:
    """What is searched of an item: the whole or its long windows, and its parts, all by the same rate."""
    length = len(text)
    size = min(length, WINDOW)
    out = [Strip(item, text, size, _starts(length, size, WINDOW // 2), budget_of(size, rate))] if length else []
    if length > PART:
        out.append(Strip(item, text, PART, _starts(length, PART, STEP), budget_of(PART, rate)))
    return out


class Index:
    """Strips of benchmark items with the positions of their q-grams, for one block of items."""

    def __init__(self, items: list[tuple[int, str]], rate: float) -> None:
        self.strips = [x for item, text in items for x in strips(item, text, rate)]
        sizes = np.array([x.size for x in self.strips], dtype=np.int64)
        edits = np.array([x.edits for x in self.strips], dtype=np.int64)
        grams = [gram_size(x.size, budget_of(x.size, rate)) for x in self.strips]
        self.by_q: dict[int, tuple] = {}
        for q in sorted(set(grams)):
            mine = [i for i, g in enumerate(grams) if g == q]
            codes = [gram_codes(self.strips[i].text, q) for i in mine]
            code = np.concatenate(codes)
            owner = np.repeat(mine, [len(c) for c in codes])
            place = np.concatenate([np.arange(len(c)) for c in codes])
            order = np.argsort(code, kind="stable")
            code, owner, place = code[order], owner[order], place[order]
            value, first = np.unique(code, return_index=True)
            flags = np.zeros(1 << 20, dtype=bool)
            flags[(value >> np.uint64(44)).astype(np.int64)] = True
            self.by_q[q] = flags, value, np.append(first, len(code)), owner, place
        self.need = np.array([max(1, m + 1 - q * (k + 1)) for m, k, q in zip(sizes, edits, grams)], dtype=np.int64)
        #: Bands are two budgets wide and overlap by one, so every stretch within the budget lies in one band.
        self.band = np.maximum(1, 2 * edits + 1)

    def candidates(self, text: str) -> list[tuple[int, int, int, int]]:
        """(strip, start of the window in it, lowest and highest diagonal of the window) where a band shares as many
        q-grams with a window as the lemma asks for; long windows first."""
        letters = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        found: set[tuple[int, int, int, int]] = set()
        for q, (flags, value, first, owner, place) in self.by_q.items():
            codes = rolling(letters, q)
            at = np.flatnonzero(flags[(codes >> np.uint64(44)).astype(np.int64)])
            if not len(at):
                continue
            row = np.searchsorted(value, codes[at])
            row[row == len(value)] = 0
            hit = value[row] == codes[at]
            at, row = at[hit], row[hit]
            if not len(at):
                continue
            count = first[row + 1] - first[row]
            spot = np.repeat(first[row], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            strip, where = owner[spot], np.repeat(at, count)
            inside = place[spot]
            diagonal = where - inside
            width = self.band[strip]
            for shift in (0, 1):  # two layers of bands, each shifted by half a width
                layer = (diagonal + shift * (width // 2)) // width
                packed = strip.astype(np.int64) * (1 << 40) + (layer + (1 << 38))
                bands, n = np.unique(packed, return_counts=True)
                bands = bands[n >= self.need[bands >> 40]]
                if not len(bands):
                    continue
                row = np.searchsorted(bands, packed)
                row[row == len(bands)] = 0
                mine = np.flatnonzero(bands[row] == packed)
                mine = mine[np.lexsort((inside[mine], row[mine]))]
                cuts = np.searchsorted(row[mine], np.arange(len(bands) + 1))
                for j, band in enumerate(bands.tolist()):
                    w = band >> 40
                    places, starts = inside[mine[cuts[j] : cuts[j + 1]]], self.strips[w].starts
                    shared = np.searchsorted(places, starts + self.strips[w].size - q + 1) - np.searchsorted(places, starts)
                    wide = int(self.band[w])
                    low = ((band & ((1 << 40) - 1)) - (1 << 38)) * wide - shift * (wide // 2)
                    for s in starts[shared >= self.need[w]].tolist():
                        found.add((w, s, low + s, low + s + wide - 1))
        return sorted(found, key=lambda x: (-self.strips[x[0]].size, x))

    def search(self, texts: list[str]) -> list[tuple[int, int, int, int, int]]:
        """(place in ``texts``, item, start, stop, edits): of each item the verified stretches, overlapping ones as one
        with the fewest edits of its longest windows. The texts are searched as one, with gaps that no band can bridge."""
        gap = "\0" * GAP
        whole = gap + gap.join(texts) + gap
        begin = np.cumsum([GAP] + [len(t) + GAP for t in texts])
        spots: dict[tuple[int, int], set[tuple[int, int, int, int]]] = {}
        for strip, s, low, high in self.candidates(whole):
            item, text, size, _, most = self.strips[strip]
            pattern = text[s : s + size]
            low, high = low - most, high + most
            middle = (low + high + size) // 2
            place = int(np.searchsorted(begin, middle + GAP // 2, side="right")) - 1
            place = min(max(place, 0), len(texts) - 1)
            first = int(begin[place])
            here = spots.get((place, item), ())
            if any(size < m and start + first - most <= low + most and high - most + size <= stop + first + most for start, stop, m, _ in here):
                continue  # inside a stretch that a longer window has given
            # the stretch of this text that the band covers
            a, b = max(0, low - first), min(len(texts[place]), high - first + size)
            if a >= b:
                continue
            got = banded_edits(pattern, texts[place][a:b], low - first - a, high - first - a, most)
            if got:
                spots.setdefault((place, item), set()).add((got[1] + a, got[2] + a, size, got[0]))
        out = []
        for (place, item), found in spots.items():
            now = None
            for start, stop, size, edits in sorted(found):
                if now and start <= now[1]:
                    now = [now[0], max(now[1], stop), min(now[2], (-size, edits))]
                else:
                    if now:
                        out.append((place, item, now[0], now[1], now[2][1]))
                    now = [start, stop, (-size, edits)]
            out.append((place, item, now[0], now[1], now[2][1]))
        return out


def rolling(letters: np.ndarray, q: int) -> np.ndarray:
    """Hashes of all stretches of q characters, built by doubling."""
    n = len(letters) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    part, size = letters.astype(np.uint64) * np.uint64(_P) + np.uint64(1), 1
    out, done, rest = None, 0, q
    while True:
        if rest & 1:
            piece = part[done : done + n]
            out = piece if out is None else out * np.uint64(pow(_P, size, 1 << 64)) + piece
            done += size
        rest >>= 1
        if not rest:
            return mix(out)
        part = part[: len(part) - size] * np.uint64(pow(_P, size, 1 << 64)) + part[size:]
        size *= 2


def gram_codes(text: str, q: int) -> np.ndarray:
    return rolling(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32), q)


def find(docs: DataFrame, benchmark: DataFrame, rate: float = 0.08, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Where documents hold benchmark items: ``doc_id``, ``item_id``, ``start``, ``stop``, ``edits``.

    Both sides are compared in lower case with white space as single blanks; ``start`` and ``stop`` count code points
    of that form. An item is found if a stretch of the document is within ``rate`` edits a character of it, or of one of
    its windows of 120 characters, which overlap by half, or of one of its parts of 60. A part begins every 10 characters,
    so each excerpt of 69 characters holds one, whatever the length of the item. ``edits`` are those of the longest
    windows found.

    The benchmark is the query set: its items are held against all documents in blocks of at most ``BLOCK_CHARS``
    characters, one pass without a shuffle each; an item longer than that is a block of its own. Items or documents
    without text match nothing, a null id is carried as it is, repeated rows give repeated rows. Of the same item's
    matches in one document, overlapping ones are one row.
    """
    ready(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    found = None
    for texts in _blocks(benchmark):
        got = rows.mapInArrow(_searcher(texts, rate), SCHEMA)
        found = got if found is None else found.unionByName(got)
    return found


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int | None, str]]]:
    """The different items in plain form, in blocks of a bounded number of characters; one empty block if there is none."""
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item"), F.col("text").cast("string").alias("text")).where(
        "text is not null"
    )
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(2 * chars / BLOCK_CHARS))
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block)
        yield sorted({(r["item"], plain(r["text"])) for r in part.toLocalIterator()}, key=str)


#: The index a worker has built last; the name tells whether it belongs to the running search.
_BUILT: dict[str, Index] = {}


def groups(texts: Iterator[str]) -> Iterator[tuple[int, list[str]]]:
    """Texts in turn, as many at a time as ``GROUP_CHARS`` allows, with the place of the first."""
    low, some, size = 0, [], 0
    for text in texts:
        if some and size + len(text) > GROUP_CHARS:
            yield low, some
            low, some, size = low + len(some), [], 0
        some.append(text)
        size += len(text) + GAP
    if some:
        yield low, some


def _indexed(name: str, items: list[tuple[int | None, str]], rate: float) -> Index:
    if name not in _BUILT:
        _BUILT.clear()
        _BUILT[name] = Index(items, rate)
    return _BUILT[name]


def _searcher(items: list[tuple[int | None, str]], rate: float):
    name = uuid.uuid4().hex
    # an id that no item has stands for null
    none = min((i for i, _ in items if i is not None), default=0) - 1
    items = [(none if i is None else i, text) for i, text in items]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _indexed(name, items, rate)
        for batch in batches:
            keys, out = batch.column(0).to_pylist(), []
            for low, texts in groups(plain(value.as_py()) for value in batch.column(1)):
                for place, item, *row in index.search(texts):
                    out.append((keys[low + place], None if item == none else item, *row))
            columns = list(zip(*out)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], names=["doc_id", "item_id", "start", "stop", "edits"]
            )

    return run


def _clear(items: list[tuple[int | None, str]], rate: float):
    name = uuid.uuid4().hex
    items = [(i, text) for i, (_, text) in enumerate(items)]

    @F.pandas_udf("boolean")
    def clear(texts: pd.Series) -> pd.Series:
        index, hit = _indexed(name, items, rate), set()
        for low, some in groups(plain(t if isinstance(t, str) else None) for t in texts):
            hit |= {low + place for place, *_ in index.search(some)}
        return pd.Series([i not in hit for i in range(len(texts))], dtype=bool)

    return clear


def without_leaks(docs: DataFrame, benchmark: DataFrame, rate: float = 0.08, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text holds no benchmark item, with their columns unchanged. Each row is judged by its own
    text, where it is: ids play no part, and nothing is shuffled."""
    ready(docs.sparkSession)
    mark = fresh(docs, "__clear")
    for items in _blocks(benchmark):
        docs = docs.withColumn(mark, _clear(items, rate)(F.col(text).cast("string"))).where(F.col(mark)).drop(mark)
    return docs
