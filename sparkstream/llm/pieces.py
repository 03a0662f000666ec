"""Operator 8: SentencePiece BPE encoding by prefix tokens, and decoding."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkstream.llm.common import ready

BLANK = "▁"
#: Entries a worker remembers of pairs, and of chunks in each of two generations: when the younger is full it becomes
#: the older, whose entries move over as they are met again, so that common words stay.
PAIRS, CHUNKS = 1_000_000, 350_000
#: Bits of a token id in the key of a pair.
SHIFT = 24
SCHEMA = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


class PrefixEncoder:
    """Encodes as the merge procedure of a BPE model does, in one pass over the text.

    Every prefix of a text has exactly one last token in its encoding. A piece that ends at a position is that token
    if it fits behind the last token of the prefix before it, which holds if merging the two pieces' text on its own
    gives the same two pieces. So the last tokens of all prefixes follow from the automaton's matches and a test of
    pairs; the encoding of the whole text is then read backwards, from the last token to the first.
    """

    def __init__(self, model_file: str, add_end: bool = True) -> None:
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=model_file)
        lib = self.library
        self.end = [lib.eos_id()] if add_end else []
        self.unknown = lib.unk_id()
        self.ids: dict[str, int] = {}
        self.bytes: dict[int, int] = {}
        for i in range(lib.get_piece_size()):
            if lib.is_byte(i):
                self.bytes[int(lib.id_to_piece(i)[3:-1], 16)] = i
            elif not (lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i)):
                self.ids[lib.id_to_piece(i)] = i
        self.text = {i: p for p, i in self.ids.items()}
        # merges happen by falling score: equal scores share a rank, single characters were never merged
        scores = {i: lib.get_score(i) for p, i in self.ids.items() if len(p) > 1}
        places = {s: r for r, s in enumerate(sorted(set(scores.values()), reverse=True))}
        self.rank = {i: places[scores[i]] if i in scores else -1 for i in self.text}
        self.alphabet = {p for p in self.ids if len(p) == 1}
        loose = {c for p in self.ids for c in p} - self.alphabet
        if loose:
            raise ValueError(f"pieces with characters that are no pieces: {sorted(loose)[:5]}")
        self.halves: dict[int, tuple[int, int]] = {}
        for piece, i in self.ids.items():
            if len(piece) > 1:
                self.halves[i] = self._last_merge(piece)
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            if self._whole(piece):  # a piece no merge leads to is never an output
                self.automaton.add_word(piece, (len(piece), i))
        self.automaton.make_automaton()
        inner = any(BLANK in p.lstrip(BLANK) for p in self.ids)
        # no piece has a blank behind another character, so a text falls apart there
        self.chunks = re.compile(".+" if inner else f"{BLANK}*[^{BLANK}]+|{BLANK}+", re.DOTALL)
        self.sizes = {i: len(p) for i, p in self.text.items()}
        self.decimals = [str(i) for i in range(lib.get_piece_size())]
        self.pairs: dict[int, bool] = {}
        self.seen: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}

    def _merged(self, piece: str) -> list[tuple[str, str, str]]:
        """The merges, in order, that the model's procedure makes on a short text, and what is left of it."""
        parts, done = list(piece), []
        while len(parts) > 1:
            options = [(self.rank[self.ids[a + b]], k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.ids]
            if not options:
                break
            _, k = min(options)
            done.append((parts[k], parts[k + 1], parts[k] + parts[k + 1]))
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        self._left = parts
        return done

    def _last_merge(self, piece: str) -> tuple[int, int]:
        done = self._merged(piece)
        if self._left != [piece]:
            return (-1, -1)
        a, b, _ = done[-1]
        return self.ids[a], self.ids[b]

    def _whole(self, piece: str) -> bool:
        return len(piece) == 1 or self.halves[self.ids[piece]] != (-1, -1)

    def fits(self, a: int, b: int) -> bool:
        """Whether ``b`` can follow ``a``: no merge across the border would have come before one inside a or b.

        Undoes the merges of both sides at the border from the latest to the earliest. ``before`` is the rank of the
        merge undone last; a border merge of that rank still comes first if it lies to the left of it.
        """
        key, before, verdict = a << SHIFT | b, 1 << 60, True
        rank, ids, text, halves = self.rank, self.ids, self.text, self.halves
        while True:
            joined = ids.get(text[a] + text[b])
            if joined is not None and rank[joined] < before:
                verdict = False
                break
            if rank[a] > rank[b]:
                before, a = rank[a], halves[a][1]
            elif rank[b] >= 0:
                before, b = rank[b] + 1, halves[b][0]
            else:
                break
        if len(self.pairs) >= PAIRS:
            self.pairs.clear()
        self.pairs[key] = verdict
        return verdict

    def _run(self, chunk: str) -> list[int]:
        """Ids of a chunk whose characters are all pieces."""
        # last[i]: last token of the encoding of the prefix that ends with character i; the last entry, which is also
        # entry -1, stands for the start of the chunk
        last = [-1] * len(chunk) + [-2]
        pairs, fits = self.pairs, self.fits
        for stop, (size, token) in self.automaton.iter(chunk):
            if last[stop] == -1:
                behind = last[stop - size]
                if behind == -2:
                    last[stop] = token
                else:
                    fit = pairs.get(behind << SHIFT | token)
                    if fit or (fit is None and fits(behind, token)):
                        last[stop] = token
        out, at, sizes = [], len(chunk) - 1, self.sizes
        while at >= 0:
            token = last[at]
            out.append(token)
            at -= sizes[token]
        out.reverse()
        return out

    def _chunk(self, chunk: str) -> tuple[int, ...]:
        out = self.older.get(chunk)
        if out is None:
            out = tuple(self._pieces(chunk))
        if len(chunk) <= 48:
            if len(self.seen) >= CHUNKS:
                self.older = self.seen.copy()
                self.seen.clear()
            self.seen[chunk] = out
        return out

    def _pieces(self, chunk: str) -> list[int]:
        known = self.alphabet
        if known.issuperset(chunk):
            return self._run(chunk)
        out, begin = [], 0
        for k, c in enumerate([*chunk, ""]):
            if c not in known:
                if k > begin:
                    out += self._run(chunk[begin:k])
                begin = k + 1
                if self.bytes:
                    out += [self.bytes[x] for x in c.encode()]
                elif c:
                    out.append(self.unknown)
        return out

    def encode(self, text: str | None) -> list[int]:
        """The ids. Null and empty: the end id alone."""
        ids: list[int] = []
        if text:
            # the library reads UTF-8, where lone surrogates cannot be
            text = text.encode("utf-8", "replace").decode()
            get, chunk = self.seen.get, self._chunk
            for part in self.chunks.findall(BLANK + text.replace(" ", BLANK)):
                ids += get(part) or chunk(part)
        return ids + self.end

    def shown(self, ids: list[int]) -> str:
        """The ids as decimals with one blank between."""
        decimals = self.decimals
        return " ".join([decimals[i] for i in ids])

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids)


_ENCODERS: dict[str, PrefixEncoder] = {}


def encoder(model_file: str) -> PrefixEncoder:
    """One encoder per worker process and model."""
    if model_file not in _ENCODERS:
        _ENCODERS[model_file] = PrefixEncoder(model_file)
    return _ENCODERS[model_file]


def encode_column(docs: DataFrame, model_file: str, text: str = "text", into: str = "ids") -> DataFrame:
    """``docs`` with the ids of ``text`` in an array column. Null and empty texts get the end id alone."""

    @F.pandas_udf("array<int>")
    def ids(texts: pd.Series) -> pd.Series:
        enc = encoder(model_file)
        return texts.map(lambda t: enc.encode(t if isinstance(t, str) else None))

    ready(docs.sparkSession)
    return docs.withColumn(into, ids(F.col(text)))


def decode_column(docs: DataFrame, model_file: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``docs`` with the text of an id array; null and empty arrays give an empty text."""

    @F.pandas_udf("string")
    def text(values: pd.Series) -> pd.Series:
        enc = encoder(model_file)
        return values.map(lambda v: enc.decode([int(x) for x in v]) if v is not None and len(v) else "")

    ready(docs.sparkSession)
    return docs.withColumn(into, text(F.col(ids)))


def digests(docs: DataFrame, model_file: str, doc_id: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per input row: id, number of ids, digest of the ids, digest of the decoded text; the ids if asked for. No shuffle.

    Null and empty texts: the end id alone, which decodes to an empty text. Repeated rows give repeated rows; other
    columns are not read. Texts are encoded whole, whatever their length.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(model_file)
        sha = hashlib.sha256
        for batch in batches:
            counts, first, second, every = [], [], [], []
            for value in batch.column(1):
                ids = enc.encode(value.as_py())
                counts.append(len(ids))
                if with_ids:
                    every.append(ids)
                first.append(sha(enc.shown(ids).encode()).hexdigest())
                second.append(sha(enc.decode(ids).encode()).hexdigest())
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(first, pa.string()), pa.array(second, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                columns, names = [*columns, pa.array(every, pa.list_(pa.int32()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    ready(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, SCHEMA + ", ids array<int>" * with_ids)
