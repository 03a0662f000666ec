"""Operator 5: near-duplicate documents by MinHash banding over word n-grams, verified on full n-gram sets."""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkstream.llm.common import fresh, kept, mix, ngram_hashes, ready, word_hashes
from sparkstream.llm.graph import components

#: A block of a bucket has about so many texts, and about so many n-grams, at most; a task verifies two blocks at once.
BLOCK_TEXTS, BLOCK_GRAMS = 1024, 400_000


class Banding(NamedTuple):
    bands: int
    rows: int


def banding(threshold: float, recall: float, noise: float = 0.02, max_rows: int = 16) -> Banding:
    """Bands and rows for which a pair at ``threshold`` collides in some band with probability ``recall`` or more.

    Of the row counts, the smallest is taken whose bands let a pair at half the threshold collide with probability
    ``noise`` times the number of bands at most; fewer rows mean fewer hashes, more rows fewer useless candidates.
    """
    if not 0 < threshold <= 1 or not 0 < recall < 1:
        raise ValueError("threshold must be in (0, 1], recall in (0, 1)")
    for rows in range(1, max_rows + 1):
        miss = 1 - threshold**rows
        bands = 1 if miss <= 0 else max(1, math.ceil(math.log(1 - recall) / math.log(miss)))
        if (threshold / 2) ** rows <= noise + 1e-12 or rows == max_rows:
            return Banding(bands, rows)
    raise AssertionError


def _signatures(n: int, plan: Banding):
    hashes = plan.bands * plan.rows
    spread = mix(np.arange(1, hashes + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1)
    shift = mix(spread)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, counts = word_hashes(batch.column(2).to_pylist())
            grams, per_text = ngram_hashes(words, counts, n)
            some = np.flatnonzero(per_text)
            out = np.zeros((len(some), plan.bands), dtype=np.uint64)
            if len(some):
                first = (np.cumsum(per_text) - per_text)[some]
                for b in range(plan.bands):
                    key = np.full(len(some), b + 1, dtype=np.uint64)
                    for r in range(plan.rows):
                        k = b * plan.rows + r
                        least = np.minimum.reduceat((grams * spread[k] + shift[k]) >> np.uint64(16), first)
                        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + least)
                    out[:, b] = key
            offsets = np.concatenate([[0], np.cumsum((per_text > 0) * plan.bands)]).astype(np.int32)
            bands = pa.ListArray.from_arrays(pa.array(offsets), pa.array(out.ravel().view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(per_text.astype(np.int64)), bands],
                names=["doc_id", "copy", "n_grams", "bands"],
            )

    return run


def _gram_sets(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, counts = word_hashes(batch.column(1).to_pylist())
            grams, per_text = ngram_hashes(words, counts, n)
            sets = [np.unique(g) for g in np.split(grams, np.cumsum(per_text)[:-1])] if len(per_text) else []
            offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
            flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64))), batch.column(2)],
                names=["rep", "grams", "bands"],
            )

    return run


def _shared(flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets, by one matrix product per stretch of their common elements."""
    k = len(sizes)
    owner = np.repeat(np.arange(k), sizes)
    order = np.argsort(flat, kind="stable")
    value, owner = flat[order], owner[order]
    new = np.concatenate([[True], value[1:] != value[:-1]])
    group = np.cumsum(new) - 1
    common = np.bincount(group)[group] > 1  # an element of one set adds to no intersection
    group, owner = group[common], owner[common]
    out = np.zeros((k, k), dtype=np.float64)
    if len(group):
        group = np.cumsum(np.concatenate([[0], (group[1:] != group[:-1]).astype(np.int64)]))
        width = max(256, (1 << 22) // k)
        for low in range(0, int(group[-1]) + 1, width):
            part = slice(*np.searchsorted(group, [low, low + width]))
            dense = np.zeros((k, width), dtype=np.float32)
            dense[owner[part], group[part] - low] = 1
            out += dense @ dense.T
    return out


def _verify(threshold: float):
    """Counts links of one task's texts. A pair is counted in the task of the first band the two share, once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            band = batch.column("band").to_numpy(zero_copy_only=False)
            same = batch.column("same").to_numpy(zero_copy_only=False)
            for i in range(batch.num_rows):
                sides = batch.column("members")[i].values
                side = np.repeat(np.arange(len(sides)), np.diff(sides.offsets.to_numpy()))
                found += _links_of(sides.flatten(), side, int(band[i]), bool(same[i]), threshold)
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x).astype(np.int64)) for x in zip(*found)], names=["rep", "root", "links"]
                )

    return run


def _links_of(rows: pa.StructArray, side: np.ndarray, band: int, same: bool, threshold: float) -> list[tuple]:
    """(texts, the smallest text that links lead to from each, number of links of each) of one task's block or two."""
    keys = rows.field("bands").flatten().to_numpy(zero_copy_only=False).reshape(len(rows), -1)
    open_pairs = np.ones((len(rows), len(rows)), dtype=bool) if same else side[:, None] != side[None, :]
    np.fill_diagonal(open_pairs, False)
    for b in range(band):  # counted where an earlier band brought the two together
        open_pairs &= keys[:, None, b] != keys[None, :, b]
    live = np.flatnonzero(open_pairs.any(axis=1))
    if not len(live):
        return []
    rows, open_pairs = rows.take(pa.array(live)), open_pairs[np.ix_(live, live)]
    rep = rows.field("rep").to_numpy(zero_copy_only=False)
    sets = rows.field("grams")
    sizes = np.diff(sets.offsets.to_numpy())
    both = _shared(sets.flatten().to_numpy(zero_copy_only=False), sizes)
    linked = open_pairs & (both >= threshold * (sizes[:, None] + sizes[None, :] - both) - 1e-9)
    got = np.flatnonzero(linked.any(axis=1))
    if not len(got):
        return []
    order = np.argsort(rep, kind="stable")
    root = np.empty(len(rep), dtype=np.int64)
    root[order] = np.arange(len(rep))
    near = linked | np.eye(len(rep), dtype=bool)
    while True:  # smallest text that links lead to within this task
        lower = np.where(near, root[None, :], len(rep)).min(axis=1)
        if (lower == root).all():
            break
        root = lower
    return [(rep[got], rep[order[root[got]]], linked.sum(axis=1)[got])]


class Classes(NamedTuple):
    rows: DataFrame
    texts: DataFrame


def classes(docs: DataFrame, n: int, threshold: float, recall: float, doc_id: str, text: str) -> Classes:
    """``rows``: (doc_id, copy) of every input row, copy being the digest of its text. ``texts``: each different text
    with a word and an id, (copy, root, least, class_id, n_links), least being the smallest id that has it. Texts of a
    class have one root; two classes may have the same class_id if ids repeat."""
    spark = ready(docs.sparkSession)
    plan = banding(threshold, recall)
    rows = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"),
        F.unhex(F.md5(F.col(text).cast("string").cast("binary"))).alias("copy"),
        F.col(text).cast("string").alias("text"),
    )
    signed = kept(
        rows.mapInArrow(_signatures(n, plan), "doc_id bigint, copy binary, n_grams bigint, bands array<bigint>"), "signed"
    )
    # one row for each different text; its number is the node of buckets, links and components
    reps = signed.where("n_grams > 0 and doc_id is not null").groupBy("copy").agg(
        F.min("doc_id").alias("least"), F.first("n_grams").alias("n_grams"), F.first("bands").alias("bands")
    )
    reps = kept(reps.withColumn("rep", F.monotonically_increasing_id()), "reps")
    keyed = reps.select("rep", "n_grams", F.posexplode("bands").alias("band", "key"))
    mark = F.xxhash64("rep")
    buckets = keyed.groupBy("band", "key").agg(
        F.count("*").alias("n"), F.sum("n_grams").alias("size"), F.bit_xor(mark).alias("x"), F.sum(mark.cast("decimal(20,0)")).alias("y")
    ).where("n > 1")
    # of buckets with the same members, the one of the first band stays
    buckets = buckets.groupBy("n", "size", "x", "y").agg(F.min(F.struct("band", "key")).alias("first")).select(
        "first.band",
        "first.key",
        F.greatest(F.ceil(F.col("n") / BLOCK_TEXTS), F.least(F.col("n"), F.ceil(F.col("size") / BLOCK_GRAMS))).cast("int").alias("blocks"),
    )
    members = keyed.join(buckets, ["band", "key"]).select(
        "band", "key", "blocks", "rep", F.pmod(F.xxhash64("rep", F.lit(7)), F.col("blocks")).cast("int").alias("block")
    )
    members = kept(members, "members")
    # full n-gram sets of the texts that share a bucket
    wanted = reps.select("rep", "copy", "least", "bands").join(members.select("rep").distinct(), "rep")
    texts = rows.withColumnRenamed("doc_id", "least").join(wanted, ["copy", "least"])
    texts = texts.groupBy("rep").agg(F.first("text").alias("text"), F.first("bands").alias("bands"))
    sets = kept(
        texts.mapInArrow(_gram_sets(n), "rep bigint, grams array<bigint>, bands array<bigint>"), "sets"
    )
    # each set goes once to its block; the blocks of a bucket meet two by two, as rows of many texts
    held = members.join(sets, "rep").groupBy("band", "key", "blocks", "block").agg(
        F.collect_list(F.struct("rep", "grams", "bands")).alias("texts")
    )
    alone = held.where("blocks = 1").select("band", F.lit(True).alias("same"), F.array("texts").alias("members"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    pairs = (
        held.where("blocks > 1")
        .select("band", "key", "block", other, "texts")
        .groupBy("band", "key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
        .agg(F.collect_list("texts").alias("members"))
        .select("band", (F.col("i") == F.col("j")).alias("same"), "members")
    )
    tasks = alone.unionByName(pairs)
    found = kept(tasks.mapInArrow(_verify(threshold), "rep bigint, root bigint, links bigint"), "found")
    links = found.groupBy("rep").agg(F.sum("links").alias("n_links"))
    roots = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    owned = reps.select("copy", "least", "rep").join(links, "rep", "left").join(roots.withColumnRenamed("node", "rep"), "rep", "left")
    owned = owned.withColumn("root", F.coalesce("root", "rep"))
    least = owned.groupBy("root").agg(F.min("least").alias("class_id"))
    return Classes(
        signed.select("doc_id", "copy"),
        owned.join(least, "root").select("copy", "root", "least", "class_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links")),
    )


def near_duplicates(
    docs: DataFrame,
    n: int = 5,
    threshold: float = 0.8,
    recall: float = 0.9999,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per input row: ``doc_id``, ``class_id``, ``copy_id``, ``n_links``.

    ``copy_id`` is the smallest id with the very same text. Texts are linked if the Jaccard similarity of their sets
    of word n-grams (words: runs without ASCII white space; a text of fewer than n words has one n-gram, itself) is at
    least ``threshold``. ``n_links`` counts the different texts that a row's text is linked to. ``class_id`` is the
    smallest id that copies and links lead to.

    Texts without a word (null, empty, white space) are linked to nothing and keep their own id as class; rows with a
    null id have a null class, and no links. Repeated rows give repeated rows. Different texts of one id are different
    texts, each with its own links and class. Other columns are not read.

    Copies are reduced to one text by an aggregate with partial results. Band hashes are shuffled for one text of each
    class only. A band bucket of many texts is cut into blocks; a set goes to its block once, every two blocks are one
    task, and a task gives a count and a root for each of its texts, so no list of pairs exists anywhere. Buckets with
    the same members are checked once, and pairs that an earlier band has brought together are left out.
    """
    rows, texts = classes(docs, n, threshold, recall, doc_id, text)
    return rows.join(texts, "copy", "left").select(
        "doc_id",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id")).alias("class_id"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id")).alias("copy_id"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("n_links", F.lit(0))).otherwise(F.lit(0)).cast("bigint").alias("n_links"),
    )


def one_of_each(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = 5, threshold: float = 0.8, recall: float = 0.9999
) -> DataFrame:
    """``docs`` with one row of each class: the one with the smallest id.

    A row is judged by its id and its text, so different texts of one id stay or go on their own; of texts of a class
    that share the smallest id the one with the smallest digest stays, of rows that repeat both, one. Rows with a null id,
    and rows whose text has no word, are in no class and stay. Columns are unchanged.
    """
    rows, texts = classes(docs, n, threshold, recall, doc_id, text)
    first = texts.groupBy("root").agg(F.min(F.struct("least", "copy")).alias("first"))
    copies = texts.join(first, "root").select("copy", F.expr("struct(least, copy) = first").alias("stays"), "least")
    # ids and texts that go, and those that stay in one of several rows
    judged = rows.where("doc_id is not null").groupBy("doc_id", "copy").agg(F.count("*").alias("n")).join(copies, "copy").select(
        "doc_id", "copy", F.when(F.col("stays") & (F.col("doc_id") == F.col("least")), F.when(F.col("n") > 1, "one")).otherwise("go").alias("say")
    ).where("say is not null")
    judged = kept(judged, "judged")
    names = {c: fresh(docs, f"__{c}") for c in ("doc_id", "copy", "rank")}
    marked = docs.withColumns({
        names["doc_id"]: F.col(doc_id).cast("bigint"), names["copy"]: F.unhex(F.md5(F.col(text).cast("string").cast("binary")))
    })
    # the same plan at every size: rows go once to their id and digest, for both joins
    to = judged.select(F.col("doc_id").alias(names["doc_id"]), F.col("copy").alias(names["copy"]), "say")
    on = [names["doc_id"], names["copy"]]
    alone = marked.join(to.drop("say").hint("merge"), on, "left_anti").select(*docs.columns)
    several = marked.join(to.where("say = 'one'").drop("say").hint("merge"), on, "left_semi")
    rank = F.row_number().over(Window.partitionBy(*on).orderBy(names["doc_id"]))
    one = several.withColumn(names["rank"], rank).where(F.col(names["rank"]) == 1).select(*docs.columns)
    return alone.unionByName(one)
