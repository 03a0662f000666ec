"""Operator 11: SimHash near duplicates by meet-in-the-middle ball hashing."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkstream.llm.common import kept, ready
from sparkstream.llm.graph import components

SEED = 42
SHINGLE = 3
RADIUS = 3
#: A fingerprint is 4 blocks of 16 bits. One block is set aside (it takes the odd bit of the radius), and the other 48
#: bits are varied by up to half the radius, one bit.
BLOCKS, BLOCK, REST = 4, 16, 48
#: Shingles hashed at once, and about so many variants read before they are linked.
CHUNK = 1 << 16
_REST_MASK = np.uint64((1 << REST) - 1)
_ONE = np.array([1 << i for i in range(BLOCK)], dtype=np.int64)
_TWO_THREE = np.array([sum(c) for n in (2, 3) for c in combinations(_ONE.tolist(), n)], dtype=np.int64)


def fingerprint(raw: bytes | None) -> int:
    """The 64 majority bits of the XXH64 hashes of a text's word shingles; 0 for a text without a word."""
    words = (raw or b"").lower().split()  # on bytes both only know ASCII
    if not words:
        return 0
    if len(words) < SHINGLE:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    total = len(words) - SHINGLE + 1
    counts = np.zeros(64, dtype=np.int64)
    for low in range(0, total, CHUNK):
        some = words[low : low + CHUNK + SHINGLE - 1]
        shingles = map(b" ".join, zip(*(some[j:] for j in range(SHINGLE))))
        hashes = np.array([xxhash.xxh64_intdigest(s, SEED) for s in shingles], dtype="<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > total, bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bits = np.array([fingerprint(v.as_py()) for v in batch.column(1)], dtype=np.uint64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits.view(np.int64))], names=["doc_id", "bits"])


def variants(marks: DataFrame, bits: str = "bits") -> DataFrame:
    """(key, bits): each fingerprint under the 4 * 49 variants of its 48 bits outside one block, at most one bit turned.

    The key is the number of the block in the upper 16 bits and the variant below. Two fingerprints that differ in at
    most 3 bits, one of them inside the block, differ in at most 2 outside it, so their balls of radius 1 meet.
    """
    block = F.explode(F.array(*[F.lit(b) for b in range(BLOCKS)]))
    turn = F.explode(F.array(F.lit(0).cast("bigint"), *[F.lit(1 << i).cast("bigint") for i in range(REST)]))
    left = F.expr(f"shiftleft({bits}, block * {BLOCK})")
    right = F.expr(f"CASE WHEN block = 0 THEN 0L ELSE shiftrightunsigned({bits}, 64 - block * {BLOCK}) END")
    rest = left.bitwiseOR(right).bitwiseAND(F.lit((1 << REST) - 1))
    return (
        marks.select(bits, block.alias("block"))
        .select(bits, F.expr(f"shiftleft(CAST(block AS BIGINT), {REST})").alias("top"), rest.alias("rest"))
        .select(bits, "top", "rest", turn.alias("turn"))
        .select(F.col("top").bitwiseOR(F.col("rest").bitwiseXOR(F.col("turn"))).alias("key"), bits)
    )


def links_of(keys: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Links among fingerprints that share a key, given in the order of their keys; enough of them to connect what is
    within 3 bits, one row (a, b) each.

    Two fingerprints of one key differ in at most 2 bits outside the block. If they differ in at most one inside it,
    they are linked; so each member is linked to one of its own block value and one of each of the 16 neighbouring
    values, never to all. Fingerprints that are equal outside the block may differ in 2 or 3 bits inside it.
    """
    edge = np.flatnonzero(keys[1:] == keys[:-1])
    shared = np.zeros(len(keys), dtype=bool)
    shared[edge] = shared[edge + 1] = True
    keys, marks = keys[shared], marks[shared]
    if not len(keys):
        return np.zeros((0, 2), dtype=np.uint64)
    block = keys >> np.uint64(REST)
    by = block * np.uint64(BLOCK)
    turned = (marks << by) | np.where(block == 0, np.uint64(0), marks >> ((np.uint64(64) - by) & np.uint64(63)))
    inside = (turned >> np.uint64(REST)).astype(np.int64)
    group = np.cumsum(np.concatenate([[0], (keys[1:] != keys[:-1]).astype(np.int64)]))
    cell = (group << BLOCK) | inside
    order = np.argsort(cell, kind="stable")
    cell, marks = cell[order], marks[order]
    found = [np.stack([marks[:-1], marks[1:]], axis=1)[cell[1:] == cell[:-1]]]
    first = np.concatenate([[True], cell[1:] != cell[:-1]])
    found += _across(cell[first], marks[first], _ONE)
    own = ((turned ^ keys) & _REST_MASK == 0)[order]
    if own.any():
        cell, marks = cell[own], marks[own]
        mates = np.concatenate([[False], cell[1:] >> BLOCK == cell[:-1] >> BLOCK])
        mates[:-1] |= mates[1:]
        found += _across(cell[mates], marks[mates], _TWO_THREE)
    pairs = np.concatenate(found)
    apart = np.unpackbits((pairs[:, 0] ^ pairs[:, 1]).view(np.uint8).reshape(-1, 8), axis=1).sum(axis=1) if len(pairs) else []
    pairs = pairs[(np.asarray(apart) <= RADIUS) & (pairs[:, 0] != pairs[:, 1])]
    return np.unique(np.sort(pairs, axis=1), axis=0)


def _across(cell: np.ndarray, marks: np.ndarray, turns: np.ndarray) -> list[np.ndarray]:
    """Pairs of cells of one group whose block values differ by one of ``turns``."""
    out = []
    for turn in turns.tolist() if len(cell) else ():
        at = np.searchsorted(cell, cell ^ turn)
        at[at == len(cell)] = 0
        hit = (cell[at] == cell ^ turn) & (cell < cell ^ turn)
        out.append(np.stack([marks[hit], marks[at[hit]]], axis=1))
    return out


def _linker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come in the order of their keys; what is read of the last key waits for the rest of it."""
    waiting, rows = [], 0
    for batch in chain(batches, [None]):
        if batch is not None:
            waiting.append([batch.column(j).to_numpy(zero_copy_only=False).view(np.uint64) for j in (0, 1)])
            rows += batch.num_rows
        if rows < CHUNK and batch is not None or not rows:
            continue
        keys, marks = (np.concatenate(part) for part in zip(*waiting))
        cut = len(keys) if batch is None else int(np.searchsorted(keys, keys[-1]))
        pairs = links_of(keys[:cut], marks[:cut])
        waiting, rows = [[keys[cut:], marks[cut:]]], 0
        if len(pairs):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.ascontiguousarray(pairs[:, j]).view(np.int64)) for j in (0, 1)], names=["a", "b"]
            )


def links(marks: DataFrame, bits: str = "bits") -> DataFrame:
    """Verified links (a, b) that connect all fingerprints within 3 bits of each other. ``marks``: distinct fingerprints.

    A key has at most 49 * 65 536 fingerprints, whatever the input, because they agree outside a block but for one bit;
    a task goes through its keys one after the other.
    """
    dealt = variants(marks, bits).repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(_linker, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``doc_id``, ``fingerprint`` (16 hex digits), ``component_id``.

    A text is put into lower case (A-Z only) and cut into words at ASCII white space; a bit of its fingerprint is 1 if
    it is set in more than half of the XXH64 hashes (seed 42) of its 3-word shingles, repeats included. A text of one or
    two words has one shingle, itself; one without a word (null, empty, white space) has the fingerprint zero, which is
    linked like any other. Fingerprints within 3 bits are linked, ``component_id`` is the smallest id that links lead to.

    Rows with a null id link others as any row does, and get the smallest id of the others, or null if there is none.
    Repeated rows and ids give repeated rows. Other columns are not read. Equal fingerprints become one before variants
    are made, so copies cost nothing; links are made within a key by block value, so a large group makes no pairs.
    """
    ready(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").cast("binary").alias("text"))
    signed = kept(rows.mapInArrow(_fingerprints, "doc_id bigint, bits bigint"), "fingerprints")
    marks = kept(signed.groupBy("bits").agg(F.min("doc_id").alias("least")), "marks")
    roots = components(links(marks.select("bits")))
    owned = marks.join(roots.withColumnRenamed("node", "bits"), "bits", "left").withColumn("root", F.coalesce("root", "bits"))
    least = owned.groupBy("root").agg(F.min("least").alias("component_id"))
    named = owned.select("bits", "root").join(least, "root").select("bits", "component_id")
    return signed.join(named, "bits").select(
        "doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id"
    )
