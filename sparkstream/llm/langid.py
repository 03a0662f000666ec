"""Operator 9: language of texts. Scripts narrow the candidates, a Viterbi pass over word scores labels spans."""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkstream.llm.common import fresh, held_out, mix, ready, viterbi

LETTERS = re.compile(r"[^\W\d_]+")
UNKNOWN = "und"
#: Documents per language that the model is fitted on, at most about so many.
SAMPLE = 600
#: Character n-grams are counted in so many bins.
BINS = 1 << 16
#: What a change of language costs, in natural logarithms of likelihood.
SWITCH = 12.0
#: A text is surely of its language if its letters exceed the background by this share of what is usual, and surely not
#: by that one or less; in between the score falls in a straight line.
SURE, STRANGE = 0.75, 0.25
#: First code points of script ranges, and the scripts (fixed values of the Unicode block list, coarsened).
RANGES = (
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0780, "other"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "other"),
    (0x0B80, "tamil"), (0x0C00, "telugu"), (0x0C80, "other"), (0x0E00, "thai"), (0x0E80, "other"),
    (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"), (0x1380, "other"), (0x1E00, "latin"),
    (0x1F00, "greek"), (0x2000, "latin"), (0x2E80, "han"), (0x3040, "kana"), (0x3100, "han"),
    (0x3130, "hangul"), (0x3190, "han"), (0xA000, "other"), (0xA720, "latin"), (0xA800, "other"),
    (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "latin"), (0xFB1D, "hebrew"),
    (0xFB50, "arabic"), (0xFE00, "other"), (0xFF21, "latin"), (0xFF66, "kana"), (0xFFA0, "hangul"),
    (0x10000, "other"), (0x20000, "han"), (0x323B0, "other"),
)
SCRIPTS = sorted({name for _, name in RANGES})
_STARTS = np.array([low for low, _ in RANGES])
_SCRIPT_OF = np.array([SCRIPTS.index(name) for _, name in RANGES])


class Model(NamedTuple):
    """Languages in order, log-likelihoods by bin and language, and which scripts each language is written in. ``letters``
    are log-likelihoods of single characters by bin, whatever the language: the background, in which a character says
    nothing about the next one. ``usual`` is by how much a letter of a language's own texts is likelier than there."""

    languages: list[str]
    scores: np.ndarray
    scripts: np.ndarray
    letters: np.ndarray
    usual: np.ndarray


def _lettered(word: str) -> bool:
    """Whether there is a letter at all: the pattern takes superscript and Roman numerals, too."""
    return word.isalpha() or any(map(str.isalpha, word))


def words_of(text: str | None) -> list[str]:
    """Lower-cased runs of letters."""
    return [w for w in LETTERS.findall(text.lower()) if _lettered(w)] if text else []


def _grams(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bins of the character trigrams and bigrams of bordered words, by word; the script of each first letter; and the
    bins of the characters of all these n-grams, as rows of five: those of a trigram and of the bigram it begins with."""
    raw = np.frombuffer(" ".join(["", *words, ""]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    begin = np.cumsum(sizes + 1) - sizes  # each word's first letter; the blank before it is its border
    two = mix(raw[:-1] * np.uint64(0x1F123BB5) + raw[1:])
    three = mix(two[:-1] + raw[2:] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))
    # a word of n letters has n trigrams and n + 1 bigrams, border blanks included
    at = np.repeat(begin - 1, sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    bins = np.concatenate([three[at], two[at]]) % np.uint64(BINS)
    owner = np.repeat(np.arange(len(words)), sizes)
    script = _SCRIPT_OF[np.searchsorted(_STARTS, raw[begin].astype(np.int64), side="right") - 1]
    one = (mix(raw + np.uint64(1)) % np.uint64(BINS)).astype(np.int64)
    chars = np.stack([one[at], one[at + 1], one[at + 2], one[at], one[at + 1]], axis=1)
    return bins.astype(np.int64), np.concatenate([owner, owner]), script, chars


def learn(docs: DataFrame, train: F.Column, sample: int = SAMPLE, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """Counts character n-grams by language over the chosen rows of ``docs`` with a text and a language.

    ``train`` is a condition on ``docs``. Of each language about ``sample`` rows are taken by a hash of their ids (all,
    if they are fewer), whole texts. Only counts by bin and language reach the driver: bins times languages.
    """
    ready(docs.sparkSession)
    rows = docs.where(train).select(
        F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"),
        F.pmod(F.xxhash64(F.col(doc_id).cast("string"), F.lit(9)), F.lit(1 << 31)).alias("draw"),
    ).where("lang is not null and text is not null")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros((BINS, 0)), np.zeros((len(SCRIPTS), 0), dtype=bool), np.zeros(BINS), np.zeros(0))
    bound = F.lit(0)
    for name in languages:
        bound = F.when(F.col("lang") == name, int((1 << 31) * min(1.0, sample / sizes[name]))).otherwise(bound)
    place = {name: i for i, name in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((len(languages), 2 * BINS + len(SCRIPTS)), dtype=np.int64)
        for batch in batches:
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = words_of(value)
                if words:
                    bins, _, script, chars = _grams(words)
                    totals[place[name], :BINS] += np.bincount(bins, minlength=BINS)
                    totals[place[name], BINS : 2 * BINS] += np.bincount(chars.ravel(), minlength=BINS)
                    totals[place[name], 2 * BINS :] += np.bincount(script, minlength=len(SCRIPTS))
        language, item = np.nonzero(totals)
        yield pa.RecordBatch.from_arrays(
            [pa.array(language.astype(np.int64)), pa.array(item.astype(np.int64)), pa.array(totals[language, item])],
            names=["language", "item", "n"],
        )

    chosen = rows.where(F.col("draw") < bound).select("lang", "text")
    counted = chosen.mapInArrow(count, "language bigint, item bigint, n bigint")
    table = counted.groupBy("language", "item").agg(F.sum("n").alias("n")).toArrow()
    totals = np.zeros((len(languages), 2 * BINS + len(SCRIPTS)))
    totals[table["language"].to_numpy(), table["item"].to_numpy()] = table["n"].to_numpy()
    seen, chars, scripts = totals[:, :BINS], totals[:, BINS : 2 * BINS] + 0.5, totals[:, 2 * BINS :]
    grams = seen + 0.5
    scores = np.log(grams / grams.sum(axis=1, keepdims=True)).T
    letters = np.log((chars / chars.sum(axis=1, keepdims=True)).mean(axis=0))
    used = scripts >= 0.01 * np.maximum(scripts.sum(axis=1, keepdims=True), 1)
    model = Model(languages, np.ascontiguousarray(scores), used.T & (scripts.T > 0), letters, np.zeros(len(languages)))

    def margins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """By how much the letters of the sample's texts are likelier than the background, each text by the counts of
        the others."""
        size, excess = np.zeros(len(languages), dtype=np.int64), np.zeros(len(languages))
        for batch in batches:
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words, k = words_of(value), place[name]
                if words:
                    bins, *_, chars = _grams(words)
                    others = seen[k, bins] - np.bincount(bins, minlength=BINS)[bins]
                    own = np.log(np.maximum(others, 0) + 0.5) - np.log(grams[k].sum() - len(bins))
                    size[k] += len(chars)
                    excess[k] += own.sum() - _background(chars, model).sum()
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(languages))), pa.array(size), pa.array(excess)], names=["language", "size", "excess"]
        )

    found = chosen.mapInArrow(margins, "language bigint, size bigint, excess double").groupBy("language")
    for r in found.agg(F.sum("size").alias("size"), F.sum("excess").alias("excess")).collect():
        model.usual[r["language"]] = r["excess"] / max(r["size"], 1)
    return model


def _background(chars: np.ndarray, model: Model) -> np.ndarray:
    """Log-likelihood of a trigram and its bigram for each row of their characters, drawn one by one. An n-gram that no
    text of a language holds is never likelier in that language than here, whatever its characters."""
    one = model.letters[chars]
    least = model.scores.min(axis=0).max()
    half = np.log(0.5)
    return np.maximum(one[:, :3].sum(axis=1) + half, least) + np.maximum(one[:, 3:].sum(axis=1) + half, least)


def word_scores(words: list[str], model: Model) -> np.ndarray:
    """Log-likelihood of each word by language. Languages not written in the word's script are ruled out; a word in a
    script of no language speaks for none."""
    return _judged(words, model)[0]


def _judged(words: list[str], model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The scores of words, their log-likelihood by the background, and whether a language is written in their script."""
    bins, owner, script, chars = _grams(words)
    out = np.stack([np.bincount(owner, column[bins], len(words)) for column in model.scores.T], axis=1)
    able = model.scripts[script]
    out = np.where(able, out, -1e4)
    known = able.any(axis=1)
    out[~known] = 0
    return out, np.bincount(owner[: len(chars)], _background(chars, model), len(words)), known


def _labels(texts: list[str | None], model: Model, switch: float) -> tuple[list[list[str]], np.ndarray, np.ndarray, np.ndarray]:
    """Words of every text; and of every word, texts after each other: the label, by how much it is likelier with it
    than by the background, and whether a language is written in its script."""
    words = [words_of(t) for t in texts]
    counts = np.array([len(w) for w in words], dtype=np.int64)
    code, distinct = pd.factorize(np.array([w for ws in words for w in ws], dtype=object))
    if not len(code):
        return words, code, np.zeros(0), np.zeros(0, dtype=bool)
    move = -switch * (1 - np.eye(len(model.languages)))
    scores, plain, known = _judged(list(distinct), model)
    labels = viterbi(scores[code], counts, move)
    return words, labels, scores[code, labels] - plain[code], known[code]


def predict(docs: DataFrame, model: Model, switch: float = SWITCH, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``doc_id``, ``held_out``, ``lang_pred``, ``score``. No shuffle; texts are read whole.

    ``lang_pred`` is the language with the most letters in its words on the best path (of equals the first by name).
    Words in a script of no learned language belong to none. ``score`` is the language's share of all letters, times a
    factor for how well they fit it: by how much they are likelier than letters drawn one by one, as a share of what is
    usual for the language, 1 from ``SURE`` and 0 up to ``STRANGE``. Letters in no learned script alone
    give the first language by name, and 0. A null text, one without letters, and any text under a model of no language
    give ``und`` and 0. Repeated rows give repeated rows;
    other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, score = _documents(batch.column(2).to_pylist(), model, switch)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.string()), pa.array(score)],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    ready(docs.sparkSession)
    rows = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"), held_out(F.col(doc_id)).alias("held_out"), F.col(text).cast("string").alias("text")
    )
    return rows.mapInArrow(run, "doc_id bigint, held_out boolean, lang_pred string, score double")


def _documents(texts: list[str | None], model: Model, switch: float) -> tuple[list[str], np.ndarray]:
    if not model.languages:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    words, labels, margin, known = _labels(texts, model, switch)
    counts = np.array([len(w) for w in words], dtype=np.int64)
    size = np.array([len(w) for ws in words for w in ws], dtype=np.float64)
    n = len(model.languages)
    owner = np.repeat(np.arange(len(words)), counts)
    cell = (owner * n + labels)[known]
    letters = np.bincount(cell, size[known], len(words) * n).reshape(-1, n)
    excess = np.bincount(cell, margin[known], len(words) * n).reshape(-1, n)
    best = letters.argmax(axis=1)
    row = np.arange(len(words))
    most = letters[row, best]
    share = most / np.maximum(np.bincount(owner, size, len(words)), 1)
    fit = excess[row, best] / np.maximum(most, 1) / np.maximum(model.usual[best], 1e-9)
    score = share * np.clip((fit - STRANGE) / (SURE - STRANGE), 0, 1)
    # letters in no learned script leave the first language, with a score of 0
    return [model.languages[b] if n else UNKNOWN for b, n in zip(best, counts)], score


def spans(docs: DataFrame, model: Model, switch: float = SWITCH, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Stretches of one language: ``doc_id``, ``start`` and ``stop`` (code points), ``lang``. Texts without letters have none,
    and words in a script of no learned language lie in none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, starts, stops, names = [], [], [], []
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                places = [m.span() for m in LETTERS.finditer(value or "") if _lettered(m[0])]
                if not places or not model.languages:
                    continue
                found = [value[a:b].lower() for a, b in places]
                move = -switch * (1 - np.eye(len(model.languages)))
                scores, _, known = _judged(found, model)
                labels = np.where(known, viterbi(scores, np.array([len(found)]), move), -1)
                cuts = np.flatnonzero(np.diff(labels, prepend=-2))
                for a, b in zip(cuts, [*cuts[1:], len(labels)]):
                    if labels[a] < 0:
                        continue
                    ids.append(key)
                    starts.append(places[a][0])
                    stops.append(places[b - 1][1])
                    names.append(model.languages[labels[a]])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(starts, pa.int64()), pa.array(stops, pa.int64()), pa.array(names, pa.string())],
                names=["doc_id", "start", "stop", "lang"],
            )

    ready(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, start bigint, stop bigint, lang string")


def keep_known(docs: DataFrame, model: Model, least: float = 0.5, switch: float = SWITCH, text: str = "text") -> DataFrame:
    """The rows whose text has a language with a score of at least ``least``; columns are unchanged, nothing is shuffled.
    Texts in a script or a language that was not learned, and letters at random, score low and go."""

    @F.pandas_udf("boolean")
    def clear(texts: pd.Series) -> pd.Series:
        found, share = _documents([t if isinstance(t, str) else None for t in texts], model, switch)
        return pd.Series((share >= least) & (np.array(found, dtype=object) != UNKNOWN), dtype=bool)

    ready(docs.sparkSession)
    mark = fresh(docs, "__clear")
    return docs.withColumn(mark, clear(F.col(text).cast("string"))).where(F.col(mark)).drop(mark)
