"""Operator 12: phrase collocations by SETM, set-oriented mining over sorted occurrence relations."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkstream.llm.common import _P, _P_INV, _powers, kept, mix, ready
from sparkstream.plans.sizes import BROADCAST_BYTES

LONGEST = 4
SCALE = 2_000_000
#: Stands between two pieces in a list of words.
BREAK = ""
#: Words looked at together in a task.
BATCH_WORDS = 1 << 20
RELATION = "lang string, words array<string>"
#: The relation once its words are numbered.
NUMBERED = "lang string, words array<int>"
#: Most words that are numbered. Tasks hold them as one flat array.
WORD_ROWS = 4_000_000
#: Bits of a sieve for each phrase, and of the largest one (32 MB), however many phrases there are.
SIEVE_EACH = 16
SIEVE_MOST = 1 << 28
#: Bits of Spark's bitmaps, of which a sieve is made.
_BITMAP = 1 << 15
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Lists of the first rows of each lang before they are ranked together.
SALTS = 64
_ENDS = b".,;:!?\n\x0b\x0c\r"
_CUT = bytes(0xFF if i in _ENDS else i for i in range(256))


def words_of(raw: bytes) -> list[bytes]:
    """Words in lower case (A-Z), an empty one after each piece."""
    out: list[bytes] = []
    for piece in raw.lower().translate(_CUT).split(b"\xff"):
        words = piece.split()  # blank and tab are the only white space left
        if words:
            out += words
            out.append(b"")
    return out


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = [words_of(v.as_py() or b"") for v in batch.column(1)]
        offsets = np.concatenate([[0], np.cumsum([len(w) for w in lists])]).astype(np.int32)
        words = pa.array([w for some in lists for w in some], pa.binary()).cast(pa.string())
        counts = np.array([len(w) - w.count(b"") for w in lists], dtype=np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), words), pa.array(counts)], names=["lang", "words", "n"]
        )


class Joined:
    """The merge join of a stretch of the relation with itself at adjacent positions of a piece: its phrases of k words."""

    gap: str | int = BREAK

    def __init__(self, batch: pa.RecordBatch, k: int) -> None:
        lists = batch.column(1)
        self.lang, self.words, self.k = batch.column(0).cast(pa.string()), lists.flatten(), k
        self.bounds = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        size = len(self.words)
        # every list ends with a break, and a phrase lies in one piece if there is none in its stretch
        breaks = pc.equal(self.words, self.gap).to_numpy(zero_copy_only=False)
        seen = np.concatenate([[0], np.cumsum(breaks)])
        self.at = np.flatnonzero(seen[k:] == seen[: size - k + 1]) if size >= k else np.zeros(0, np.int64)

    def keys(self) -> Iterator[pa.Array]:
        """lang, tab and phrase of each occurrence, in the order of positions, some at a time. No word holds a tab."""
        for low in range(0, len(self.at), BATCH_WORDS):
            at = self.at[low : low + BATCH_WORDS]
            key = self.lang.take(pa.array(np.searchsorted(self.bounds, at, side="right") - 1))
            for j in range(self.k):
                key = pc.binary_join_element_wise(key, self.words.take(pa.array(at + j)), " " if j else "\t")
            yield key


class Coded(Joined):
    """The same for words that are numbers. A phrase is one 64-bit number for every two words of the longest ones."""

    gap = -1

    def codes(self, longest: int) -> list[np.ndarray]:
        """Of each occurrence."""
        words = self.words.to_numpy(zero_copy_only=False).astype(np.int64)
        out = []
        for mine in _shares(self.k, longest):
            code = words[self.at + mine[0]] if mine else np.zeros(len(self.at), np.int64)
            out.append(code << 32 | words[self.at + mine[1]] if len(mine) > 1 else code)
        return out


def _shares(k: int, longest: int) -> list[list[int]]:
    """The words of a phrase of k words that each of its numbers holds, two at most."""
    size = (longest + 1) // 2
    return [[j for j in range(k) if j * size // k == i] for i in range(size)]


def _names(longest: int) -> list[str]:
    """Columns of the numbers of a phrase."""
    return [f"code{i}" for i in range((longest + 1) // 2)]


def _places(values: pa.Array, known: pa.Array) -> np.ndarray:
    """Where each value stands in what is known, or -1. Only the values are hashed, not what is known."""
    values = values.dictionary_encode()
    hits = pc.index_in(known, value_set=values.dictionary)
    place = np.full(len(values.dictionary), -1, dtype=np.int64)
    place[hits.drop_null().to_numpy()] = np.flatnonzero(hits.is_valid().to_numpy(zero_copy_only=False))
    return place[values.indices.to_numpy()]


def _code_hashes(codes: list[np.ndarray]) -> np.ndarray:
    out = np.zeros(len(codes[0]), dtype=np.uint64)
    for code in codes:
        out = mix(out * np.uint64(_P) + code.astype(np.uint64) + np.uint64(1))
    return out


def _key_hashes(keys: pa.Array) -> np.ndarray:
    out = [np.zeros(0, np.uint64)]
    for low in range(0, len(keys), 1 << 16):
        part = keys.slice(low, 1 << 16).cast(pa.large_binary())
        ends = np.frombuffer(part.buffers()[1], np.int64)[part.offset : part.offset + len(part) + 1]
        data = np.frombuffer(part.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
        ends = ends - ends[0]
        # sum of bytes times powers, from prefix sums
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(_P, len(data)), out=sums[1:])
        out.append(mix((sums[ends[1:]] - sums[ends[:-1]]) * _powers(_P_INV, len(data) + 1)[ends[:-1]]))
    return np.concatenate(out)


def _passes(hashes: np.ndarray, sieve: np.ndarray) -> np.ndarray:
    """Whether the sieve (bits in bytes, a power of 2) has the bit of each hash."""
    bit = hashes & np.uint64(len(sieve) * 8 - 1)
    return (sieve[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def _spelled(keys: pa.Array) -> pa.Array:
    """The words of keys of one word (a lang may hold a tab)."""
    return pc.list_element(pc.split_pattern(keys, "\t", max_splits=1, reverse=True), 1)


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A few batches as one, up to about ``BATCH_WORDS`` words."""
    some, size = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        some.append(batch)
        size += len(batch.column(1).flatten())
        if size >= BATCH_WORDS:
            yield _one(some)
            some, size = [], 0
    if some:
        yield _one(some)


def _one(some: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(some).combine_chunks().to_batches()[0] if len(some) > 1 else some[0]


def _counter(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _stretches(batches):
            for keys in Joined(batch, k).keys():
                values, counts = pc.value_counts(keys).flatten()
                for low in range(0, len(values), 1 << 16):
                    yield pa.RecordBatch.from_arrays([values.slice(low, 1 << 16), counts.slice(low, 1 << 16)], names=["key", "f"])

    return run


def _code_counter(k: int, longest: int):
    names = _names(longest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _stretches(batches):
            codes = pa.table(Coded(batch, k).codes(longest), names=names)
            yield from codes.group_by(names, use_threads=False).aggregate([([], "count_all")]).to_batches(1 << 16)

    return run


def _namer(k: int, longest: int, known):
    """Phrases of k words with their keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = []
            for code, mine in zip(batch.columns, _shares(k, longest)):
                code = code.to_numpy(zero_copy_only=False)
                numbers += [code >> 32, code & 0xFFFFFFFF] if len(mine) > 1 else [code] * len(mine)
            first, *rest = [known.value.take(pa.array(n)) for n in numbers]
            key = pc.binary_join_element_wise(first, *[_spelled(x) for x in rest], " ")
            yield pa.RecordBatch.from_arrays([*batch.columns, key], names=[*batch.schema.names, "key"])

    return run


def _runs(joined: Joined, frequent: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Of a stretch, the words of frequent phrases of k words with a frequent neighbour, a break after each run; and
    the new bounds of the lists."""
    size = len(joined.words)
    on = np.zeros(size + 1, dtype=bool)
    on[joined.at[frequent]] = True
    # an occurrence stays if the one before or after it, in its piece, is frequent too
    edge = on[:-1] & on[1:]
    stays = edge.copy()
    stays[1:] |= edge[:-1]
    first = np.flatnonzero(stays & ~np.concatenate([[False], edge[:-1]]))
    last = np.flatnonzero(stays & ~edge)
    length = last - first + joined.k + 1  # the words of the run, and a break
    total = int(length.sum())
    begin = np.cumsum(length) - length
    source = np.arange(total) - np.repeat(begin - first, length)
    source[begin + length - 1] = size  # the break
    words = pa.concat_arrays([joined.words, pa.array([joined.gap], joined.words.type)]).take(pa.array(source))
    return words, np.concatenate([[0], np.cumsum(length)])[np.searchsorted(first, joined.bounds)]


def _cutter(k: int, sieve):
    """The relation cut to runs of phrases that pass the sieve."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _stretches(batches):
            joined = Joined(batch, k)
            hits = [_passes(_key_hashes(keys), sieve.value) for keys in joined.keys()]
            yield from _relation(batch.column(0), *_runs(joined, np.concatenate(hits) if hits else np.zeros(0, bool)))

    return run


def _word_numberer(known):
    """The relation cut to runs of frequent words, as numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _stretches(batches):
            joined = Joined(batch, 1)
            found = [_places(keys, known.value) for keys in joined.keys()]
            numbers = np.full(len(joined.words), Coded.gap, np.int32)
            numbers[joined.at] = np.concatenate(found) if found else []
            frequent = numbers[joined.at] >= 0
            joined.words, joined.gap = pa.array(numbers), Coded.gap
            yield from _relation(batch.column(0), *_runs(joined, frequent))

    return run


def _code_cutter(k: int, longest: int, sieve):
    """The numbered relation cut to runs of phrases of k words that pass the sieve."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _stretches(batches):
            joined = Coded(batch, k)
            yield from _relation(batch.column(0), *_runs(joined, _passes(_code_hashes(joined.codes(longest)), sieve.value)))

    return run


def _relation(lang: pa.Array, words: pa.Array, bounds: np.ndarray) -> Iterator[pa.RecordBatch]:
    for low in range(0, len(lang), 256):
        mine = bounds[low : low + 257]
        part = words.slice(mine[0], mine[-1] - mine[0])
        lists = pa.ListArray.from_arrays(pa.array((mine - mine[0]).astype(np.int32)), part)
        out = pa.RecordBatch.from_arrays([lang.slice(low, 256), lists], names=["lang", "words"])
        yield out.filter(pc.greater(pc.list_value_length(lists), 0))


def _written(df: DataFrame, label: str) -> DataFrame:
    """``kept`` in little space: compressed, and the shuffle files of the write go when it is done, not when the driver
    happens to collect its garbage."""
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, None)
    conf.set(_CLEANUP, "true")
    try:
        return kept(df, label, compression="zstd")
    finally:
        conf.unset(_CLEANUP) if before is None else conf.set(_CLEANUP, before)


def _fitting(frequent: DataFrame, max_rows: int, max_bytes: int) -> pa.Array | None:
    """The keys of frequent words, the most frequent first, if they are measured to be few enough to be with every task."""
    size = F.octet_length("key") + 8
    rows, held = frequent.select(size.alias("size")).limit(max_rows + 1).agg(F.count("*"), F.sum("size")).first()
    if rows > max_rows or (held or 0) > max_bytes:
        return None
    return frequent.select("key", "f").toArrow().sort_by([("f", "descending")]).column("key").combine_chunks().cast(pa.string())


def _sieve(frequent: DataFrame, columns: list[str]) -> np.ndarray:
    """Bits of the hashes of frequent phrases: all of them pass it, and by chance a few others (1 in 16 at most, more only
    if there are too many phrases for the largest size).

    Its size is bounded, so it goes to every task however many phrases there are. What passes by chance is counted in
    the next round like the rest, so counts stay exact.
    """
    bits = min(SIEVE_MOST, max(_BITMAP, 1 << (SIEVE_EACH * frequent.count()).bit_length()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = columns == ["key"]
            hashes = _key_hashes(batch.column(0)) if text else _code_hashes([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            at = (hashes & np.uint64(bits - 1)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at // _BITMAP), pa.array(at % _BITMAP)], names=["part", "at"])

    places = frequent.select(*columns).mapInArrow(run, "part bigint, at bigint")
    parts = _written(places.groupBy("part").agg(F.bitmap_construct_agg("at").alias("bits")), "sieve")
    out = np.zeros((bits // _BITMAP, _BITMAP // 8), dtype=np.uint8)
    for batch in parts.toArrow().to_batches():
        for part, some in zip(batch.column(0), batch.column(1)):
            out[part.as_py()] = np.frombuffer(some.as_buffer(), np.uint8)
    return out.reshape(-1)


def frequencies(
    docs: DataFrame, least: int, longest: int = LONGEST, text: str = "text", lang: str = "lang",
    max_rows: int = WORD_ROWS, max_bytes: int = BROADCAST_BYTES,
) -> tuple[DataFrame, DataFrame]:
    """Phrases of up to ``longest`` words that occur ``least`` times or more in a lang (``key``: lang, tab, phrase;
    ``f``; ``k`` words), and the words of each lang (``lang``, ``n``).

    The occurrence relation holds one row for each text, its words in the order of piece and position, and is written to
    the shared folder. In each round the relation is joined with itself at adjacent positions of a piece, the phrases are
    counted in groups with partial counts in the tasks, and the relation is semi-joined with the frequent ones, by a sieve
    of bounded size: what is left, written again, are runs of occurrences that can still grow by a word.

    If the frequent words are few enough to be with every task (``max_rows``, ``max_bytes``, measured), words go by their
    number, and a phrase by the numbers of its words, two in 64 bits, instead of text. That does not depend on how many
    phrases are frequent.
    """
    spark = ready(docs.sparkSession)
    share = spark.sparkContext.broadcast
    rows = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
        F.col(text).cast("string").cast("binary").alias("text"),
    )
    relation = _written(rows.mapInArrow(_occurrences, f"{RELATION}, n bigint"), "occurrences")
    totals = relation.groupBy("lang").agg(F.sum("n").alias("n"))
    relation = relation.select("lang", "words")
    found, words = None, None
    for k in range(1, longest + 1):
        if words is not None:
            names = _names(longest)
            fields = ", ".join(f"{c} bigint" for c in [*names, "f"])
            counted = relation.mapInArrow(_code_counter(k, longest), fields).groupBy(*names).agg(F.sum("f").alias("f"))
            keys = counted.where(F.col("f") >= least).mapInArrow(_namer(k, longest, words), f"{fields}, key string")
        else:
            names = ["key"]
            counted = relation.mapInArrow(_counter(k), "key string, f bigint").groupBy("key").agg(F.sum("f").alias("f"))
            keys = counted.where(F.col("f") >= least)
        frequent = _written(keys.withColumn("k", F.lit(k)), "frequent")
        found = frequent.select("key", "f", "k") if found is None else found.unionByName(frequent.select("key", "f", "k"))
        if k == longest:
            break
        few = _fitting(frequent, max_rows, max_bytes) if k == 1 else None
        if few is not None:
            words = share(few)
            relation = _written(relation.mapInArrow(_word_numberer(words), NUMBERED), "occurrences")
            continue
        sieve = share(_sieve(frequent, names))
        cut, kind = (_cutter(k, sieve), RELATION) if words is None else (_code_cutter(k, longest, sieve), NUMBERED)
        relation = _written(relation.mapInArrow(cut, kind), "occurrences")
        sieve.unpersist()
    return found, totals


def _part(first: Column, count: Column) -> Column:
    """Key of the stretch of ``count`` words from word ``first`` (from 0)."""
    return F.concat("lang", F.lit("\t"), F.array_join(F.slice("words", first + 1, count), " "))


def collocations(
    docs: DataFrame, least: int = 30, top: int = 2000, cover: int = 80, longest: int = LONGEST, text: str = "text",
    lang: str = "lang", **how,
) -> DataFrame:
    """The first ``top`` phrases of each lang: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``.

    Texts are put into lower case (A-Z), cut into pieces at ``.,;:!?`` and line ends, pieces into words at blanks and
    tabs. Phrases are 2 to ``longest`` words of one piece, all occurrences count, also overlapping ones. ``a`` is a phrase's count
    in its lang, ``l`` and ``r`` those of its parts at the cut with the lowest score (of equals the first cut), ``score``
    is floor(2 000 000 a / (l + r)), ``n`` the number of words of the lang. A phrase goes if a longer one that holds it
    occurs at least ``cover`` percent as often. Order: score and ``a`` descending, phrase by its bytes.

    A null lang is ``und``. Null texts, and texts without a word, add nothing; repeated rows count as often as they come;
    a lang without a phrase, or an empty table, gives no row. Other columns are not read.
    """
    found, totals = frequencies(docs, least, longest, text, lang, **how)
    phrase = F.substring_index("key", "\t", -1)
    found = found.withColumns({
        "phrase": phrase, "lang": F.expr("left(key, length(key) - length(substring_index(key, '\t', -1)) - 1)"),
        "words": F.split(phrase, " "),
    })
    counts = found.select("key", "f")
    named = found.where("k > 1").select("key", "lang", "phrase", "words", "k", F.col("f").alias("a"))
    # every cut with the counts of both parts, which are as frequent at least
    cuts = named.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1)))
    cuts = cuts.select(
        "key", "a", "cut", _part(F.lit(0), F.col("cut")).alias("left"), _part(F.col("cut"), F.col("k") - F.col("cut")).alias("right")
    )
    cuts = cuts.join(counts.select(F.col("key").alias("left"), F.col("f").alias("l")), "left")
    cuts = cuts.join(counts.select(F.col("key").alias("right"), F.col("f").alias("r")), "right")
    score = F.expr(f"(cast({SCALE} as decimal(7,0)) * cast(a as decimal(19,0))) div (cast(l as decimal(19,0)) + cast(r as decimal(19,0)))")
    worst = cuts.withColumn("score", score.cast("bigint")).groupBy("key").agg(
        F.min(F.struct("score", "cut", "l", "r")).alias("worst")
    )
    # what longer phrases hold
    spans = [(i, c) for c in range(2, longest) for i in range(0, longest - c + 1)]
    held = named.where("k > 2").withColumn(
        "span", F.explode(F.filter(
            F.array(*[F.struct(F.lit(i).alias("i"), F.lit(c).alias("c")) for i, c in spans]),
            lambda s: (s["i"] + s["c"] <= F.col("k")) & (s["c"] < F.col("k")),
        ))
    )
    held = held.select(_part(F.col("span.i"), F.col("span.c")).alias("key"), "a").groupBy("key").agg(F.max("a").alias("longer"))
    kept_ones = named.join(worst, "key").join(held, "key", "left").where(
        f"longer IS NULL OR cast(100 as decimal(3,0)) * cast(longer as decimal(19,0)) < cast({cover} as decimal(3,0)) * cast(a as decimal(19,0))"
    )
    rows = kept_ones.select("lang", "phrase", "a", F.col("worst.l").alias("l"), F.col("worst.r").alias("r"), F.col("worst.score").alias("score"))
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    some = rows.withColumn("place", F.row_number().over(Window.partitionBy("lang", salt).orderBy(*best))).where(F.col("place") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("bigint")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
