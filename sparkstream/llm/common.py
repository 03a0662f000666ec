"""Helpers the operators of this package share: table access, scratch tables, text arrays, batched Viterbi."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkstream.session import prepare, scratch
from sparkstream.tables import path_of

#: Rows handed to Python at once. Texts can be long, so batches are short.
ARROW_ROWS = 500


def ready(spark: SparkSession) -> SparkSession:
    """The runtime settings of the library, with short Arrow batches."""
    prepare(spark)
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") != str(ARROW_ROWS):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(path_of(sf_dir, name))


def kept(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = scratch(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` has not got, in any case."""
    have = {c.lower() for c in df.columns}
    while stem.lower() in have:
        stem = f"{stem}_{uuid.uuid4().hex[:6]}"
    return stem


def held_out(doc_id) -> F.Column:
    """Whether crc32 of the id as text leaves 2 when divided by 4; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
#: An odd multiplier and its inverse modulo 2**64.
_P = 0x9E3779B97F4A7C15
_P_INV = pow(_P, -1, 1 << 64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out) if n else out


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words (runs without ASCII white space) of all texts, and word counts by text."""
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    # one blank after each text, so that no word crosses two texts
    data = np.frombuffer(b" ".join([*raw, b""]), dtype=np.uint8)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    inside = ~_SPACE[data]
    step = np.diff(inside.astype(np.int8), prepend=0)
    starts = np.flatnonzero(step == 1)
    ends = np.flatnonzero(step == -1)
    # sum of byte codes times powers, from prefix sums: one pass over the batch
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTES[data] * _powers(_P, len(data)), out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * _powers(_P_INV, len(data))[starts])
    bounds = np.cumsum([len(r) + 1 for r in raw])
    before = np.searchsorted(starts, np.concatenate([[0], bounds]))
    return hashes, np.diff(before)


def ngram_hashes(words: np.ndarray, counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the word n-grams of each text, with repeats; a text of 1 to n-1 words has one, the whole text."""
    total = len(words)
    offsets = np.concatenate([[0], np.cumsum(counts)])
    if not total:
        return words, np.zeros(len(counts), np.int64)
    width = np.minimum(counts, n)
    grams = np.where(counts >= n, counts - n + 1, (counts > 0).astype(np.int64))
    # position of each gram's first word
    owner = np.repeat(np.arange(len(counts)), grams)
    first = np.arange(len(owner)) - np.repeat(np.cumsum(grams) - grams, grams) + offsets[:-1][owner]
    out = np.zeros(len(owner), dtype=np.uint64)
    size = width[owner]
    for j in range(n):
        take = size > j
        at = np.minimum(first + j, total - 1)
        out = np.where(take, mix(out * np.uint64(_P) + words[at] + np.uint64(j + 1)), out)
    return out, grams


def viterbi(scores: np.ndarray, lengths: np.ndarray, move: np.ndarray, chunk: int = 256) -> np.ndarray:
    """Best label sequence of every text. ``scores``: one row per item and one column per label, texts after each other.

    ``move[k, l]`` is added on a step from k to l. Texts are cut into chunks that are solved side by side once for
    every label a chunk can be entered from; chaining the chunks then gives the exact best path, in memory and steps
    that do not depend on the longest text. Of equal paths the one with the smaller last label wins.
    """
    n, labels = scores.shape
    if not n:
        return np.zeros(0, np.int64)
    lengths = lengths[lengths > 0]
    starts = np.cumsum(lengths) - lengths
    pieces = -(-lengths // chunk)
    owner = np.repeat(np.arange(len(lengths)), pieces)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    first = starts[owner] + nth * chunk
    size = np.minimum(chunk, lengths[owner] - nth * chunk)
    order = np.argsort(-size, kind="stable")
    first, size, owner, nth = first[order], size[order], owner[order], nth[order]
    longest = int(size[0])
    # best[c, k, l]: best score of chunk c, entered from label k, with l as the label of its latest item
    best = move[None, :, :] + scores[first][:, None, :]
    opening = nth == 0
    best[opening] = scores[first[opening]][:, None, :]
    back = np.zeros((longest, len(first), labels, labels), dtype=np.uint8)
    for t in range(1, longest):
        live = int(np.searchsorted(-size, -t, side="left"))  # chunks with more than t items
        step = best[:live, :, :, None] + move[None, None, :, :]
        back[t, :live] = step.argmax(axis=2)
        best[:live] = step.max(axis=2) + scores[first[:live] + t][:, None, :]
    # chain the chunks of each text
    rank = np.lexsort((nth, owner))
    enter = np.zeros(len(first), dtype=np.int64)
    leave = np.zeros(len(first), dtype=np.int64)
    at = 0
    for count in pieces:
        mine = rank[at : at + count]
        at += count
        total = best[mine[0], 0]
        came = []
        for c in mine[1:]:
            step = total[:, None] + best[c]
            came.append(step.argmax(axis=0))
            total = step.max(axis=0)
        label = int(total.argmax())
        for c, k in zip(mine[:0:-1], reversed(came)):
            leave[c], enter[c] = label, k[label]
            label = int(k[label])
        leave[mine[0]] = label
    out = np.zeros(n, dtype=np.int64)
    label = leave.copy()
    every = np.arange(len(first))
    for t in range(longest - 1, -1, -1):
        live = int(np.searchsorted(-size, -t, side="left"))
        out[first[:live] + t] = label[:live]
        if t:
            label[:live] = back[t, every[:live], enter[:live], label[:live]]
    return out
