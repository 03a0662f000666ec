"""Operator 4: quality rules. A linear-chain CRF marks lines as content or boilerplate; the content share decides."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkstream.llm.common import fresh, ready, viterbi

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = "#*$%&|<>"
SCHEMA = (
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "base_failed boolean, kept boolean, content_share double"
)
#: Labelled documents the model is fitted on, at most about so many; everything else covers all rows.
SAMPLE = 600
#: The fit takes sampled texts of up to so many characters, and of each at most so many stretches of so many lines, spread
#: evenly over the text. Rows are judged on all of their lines, whatever their length.
FIT_CHARS, FIT_STRETCHES, STRETCH = 200_000, 8, 256
FEATURES = ("bias", "symbols", "capitals", "repeats", "marks", "digits", "length", "word_length", "copied", "lone_words")
BOILERPLATE, CONTENT = 0, 1


class Crf(NamedTuple):
    """Weights of line features for the content label, and the scores of label changes ``move[from, to]``."""

    weights: np.ndarray
    move: np.ndarray


def line_features(line: str, copied: bool) -> list[float]:
    """Features of one line that has a word; all but the length lie between 0 and 1."""
    words = WORD.findall(line)
    chars = sum(map(len, words))
    letters = sum(map(str.isalpha, line))
    symbols = sum(map(line.count, SYMBOLS))
    upper = sum(map(str.isupper, line))
    marks = sum(map(line.count, "!?;:"))
    digits = sum(map(str.isdigit, line))
    windows = max(1, len(words) - 2)
    repeats = 1 - len(set(zip(words, words[1:], words[2:]))) / windows if windows > 1 else 0.0
    return [
        1.0,
        min(1.0, 20 * symbols / chars),
        upper / letters if letters else 0.0,
        repeats,
        min(1.0, 20 * marks / chars),
        digits / chars,
        min(8.0, np.log1p(len(words))) / 8,
        min(1.0, chars / len(words) / 20),
        float(copied),
        float(len(words) == 1),
    ]


def lines_of(text: str | None) -> tuple[list[str], list[bool]]:
    """The lines with a word, and whether each equals an earlier one."""
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    seen: set[str] = set()
    copied = []
    for line in lines:
        copied.append(line in seen)
        seen.add(line)
    return lines, copied


def matrix(lines: list[str], copied: list[bool]) -> np.ndarray:
    return np.array([line_features(a, b) for a, b in zip(lines, copied)], dtype=np.float64).reshape(-1, len(FEATURES))


def repeated_words(words: list[str]) -> int:
    """Words that lie in a three-word window found twice or more in the text."""
    if len(words) < 4:
        return 0
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    often = Counter(windows)
    hit = bytearray(len(words))
    for i, window in enumerate(windows):
        if often[window] > 1:
            hit[i : i + 3] = b"\1\1\1"
    return sum(hit)


def stretches(n: int, size: int = STRETCH, most: int = FIT_STRETCHES) -> list[tuple[int, int]]:
    """``(from, to)`` of the lines that the fit takes of a text of ``n`` lines: all of them, or ``most`` stretches."""
    starts = range(0, n, size)
    if len(starts) > most:
        starts = [starts[k * (len(starts) - 1) // (most - 1)] for k in range(most)]
    return [(a, min(a + size, n)) for a in starts]


def fit_crf(texts: list[str | None], good: list[bool], rounds: int = 300, penalty: float = 1e-5) -> Crf:
    """Fits the CRF to line labels that follow from the labels of documents, by gradient ascent on its likelihood.

    A line of a good document is content. A line of another document is boilerplate, unless a good document has the
    same line. With no text at all, every line counts as content. Long texts enter as stretches of lines
    (:func:`stretches`), so the memory follows the number of texts and not the longest one.
    """
    known = {line for t, g in zip(texts, good) if g for line in (t or "").split("\n")}
    rows, labels, lengths = [], [], []
    for text, fine in zip(texts, good):
        lines, copied = lines_of(text)
        for a, b in stretches(len(lines)):
            rows.append(matrix(lines[a:b], copied[a:b]))
            labels.append(np.array([fine or line in known for line in lines[a:b]], dtype=np.int64))
            lengths.append(b - a)
    weights, move = np.zeros(len(FEATURES)), np.zeros((2, 2))
    if not rows:
        weights[0] = 1.0
        return Crf(weights, move)
    order = np.argsort([-n for n in lengths], kind="stable")
    size = np.array(lengths)[order]
    longest, count = int(size[0]), len(size)
    live = [int(np.searchsorted(-size, -t, side="left")) for t in range(longest)]
    x = np.zeros((longest, count, len(FEATURES)))
    y = np.zeros((longest, count), dtype=np.int64)
    for column, i in enumerate(order):
        x[: lengths[i], column], y[: lengths[i], column] = rows[i], labels[i]
    inside = np.arange(longest)[:, None] < size[None, :]
    total = size.sum()
    first, second = np.zeros(len(FEATURES) + 4), np.zeros(len(FEATURES) + 4)
    pairs = np.zeros((2, 2))
    for t in range(1, longest):
        n = live[t]
        np.add.at(pairs, (y[t - 1, :n], y[t, :n]), 1.0)
    for step in range(1, rounds + 1):
        emit = np.zeros((longest, count, 2))
        emit[:, :, CONTENT] = x @ weights
        ahead = np.zeros((longest, count, 2))
        ahead[0] = emit[0]
        for t in range(1, longest):
            n = live[t]
            ahead[t, :n] = emit[t, :n] + np.logaddexp.reduce(ahead[t - 1, :n, :, None] + move, axis=1)
        after = np.zeros((longest, count, 2))
        expected = np.zeros((2, 2))
        for t in range(longest - 1, 0, -1):
            n = live[t]
            after[t - 1, :n] = np.logaddexp.reduce(move + (emit[t, :n] + after[t, :n])[:, None, :], axis=2)
            both = ahead[t - 1, :n, :, None] + move + (emit[t, :n] + after[t, :n])[:, None, :]
            both -= np.logaddexp.reduce(both.reshape(n, 4), axis=1)[:, None, None]
            expected += np.exp(both).sum(0)
        belief = ahead + after
        belief = np.exp(belief[:, :, 1] - np.logaddexp(belief[:, :, 0], belief[:, :, 1]))
        slope = np.einsum("tc,tcf->f", inside * (y - belief), x) / total - penalty * weights
        turn = (pairs - expected) / total - penalty * move
        grad = np.concatenate([slope, turn.ravel()])
        first = 0.9 * first + 0.1 * grad
        second = 0.99 * second + 0.01 * grad**2
        change = 0.3 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
        weights, move = weights + change[: len(FEATURES)], move + change[len(FEATURES) :].reshape(2, 2)
    return Crf(weights, move)


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, doc_id: str = "doc_id", text: str = "text") -> Crf:
    """Fits the CRF on about ``sample`` labelled documents, chosen by a hash of their ids (all, if they are fewer).

    Both quality labels get half of the sample. Documents with contradicting labels are left out, and so are texts of
    more than ``FIT_CHARS`` characters, which do not travel to the driver.
    """
    ready(docs.sparkSession)
    marks = (
        labels.where("doc_id is not null and quality is not null")
        .groupBy(F.col("doc_id").cast("bigint").alias("key"))
        .agg(F.min("quality").alias("low"), F.max("quality").alias("high"))
        .where("low = high")
        .select("key", (F.col("low") > 0).alias("good"), F.pmod(F.xxhash64("key", F.lit(4)), F.lit(1 << 31)).alias("draw"))
    )
    counts = {r["good"]: r["n"] for r in marks.groupBy("good").agg(F.count("*").alias("n")).collect()}
    bound = F.lit(0)
    for value, n in counts.items():
        bound = F.when(F.col("good") == value, int((1 << 31) * min(1.0, sample / 2 / n))).otherwise(bound)
    chosen = marks.where(F.col("draw") < bound).orderBy("draw").limit(2 * sample)
    rows = docs.select(F.col(doc_id).cast("bigint").alias("key"), F.col(text).cast("string").alias("text")).join(
        F.broadcast(chosen), "key"
    ).where(F.coalesce(F.length("text"), F.lit(0)) <= FIT_CHARS)
    got = sorted({(r["key"], r["text"] or "", r["good"]) for r in rows.select("key", "text", "good").collect()})
    return fit_crf([t for _, t, _ in got], [g for _, _, g in got])


def measure(texts: list[str | None], model: Crf, share: float) -> tuple[list[list[int]], np.ndarray, np.ndarray, np.ndarray]:
    """Of every text: the five base counts (as columns), whether the base rules fail, the verdict, the content share."""
    counts: list[list[int]] = [[] for _ in range(5)]
    failed, sizes, lengths, features = [], [], [], []
    for text in texts:
        text = text or ""
        words = WORD.findall(text)
        repeats = repeated_words(words)
        lines, copied = lines_of(text)
        failed.append(len(words) < 50 or 100 * repeats > 50 * len(words))
        got = (len(words), sum(map(len, words)), sum(map(text.count, SYMBOLS)), sum(copied), repeats)
        for column, value in zip(counts, got):
            column.append(value)
        lengths.append(len(lines))
        if lines:
            features.append(matrix(lines, copied))
            sizes += [len(WORD.findall(line)) for line in lines]
    shares = np.zeros(len(texts))
    if features:
        emit = np.zeros((len(sizes), 2))
        emit[:, CONTENT] = np.concatenate(features) @ model.weights
        content = viterbi(emit, np.array(lengths, dtype=np.int64), model.move) == CONTENT
        owner = np.repeat(np.arange(len(texts)), lengths)
        size = np.array(sizes, dtype=np.float64)
        every = np.bincount(owner, size, len(texts))
        shares = np.bincount(owner, size * content, len(texts)) / np.maximum(every, 1)
    failed = np.array(failed, dtype=bool)
    return counts, failed, ~failed & (shares >= share), shares


def judge(docs: DataFrame, model: Crf, share: float = 0.5, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Base counts, content share and verdict of every row, in one pass without a shuffle.

    The best label sequence of a text's lines is found by Viterbi decoding; ``content_share`` is the share of its
    words in content lines (0 without words). A text is kept if it passes the base rules and the share is at least
    ``share``. Null and empty texts have no words, so the base rules fail; repeated rows give repeated rows; columns
    other than id and text are not read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, failed, keep, shares = measure(batch.column(1).to_pylist(), model, share)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, pa.int64()) for c in counts], pa.array(failed), pa.array(keep), pa.array(shares)],
                names=[c.split()[0] for c in SCHEMA.split(", ")],
            )

    ready(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, SCHEMA)


def keep_good(docs: DataFrame, model: Crf, share: float = 0.5, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that :func:`judge` keeps, with their columns unchanged; no shuffle, rows are judged alone."""

    @F.pandas_udf("boolean")
    def verdict(texts: pd.Series) -> pd.Series:
        return pd.Series(measure([t if isinstance(t, str) else None for t in texts], model, share)[2], dtype=bool)

    ready(docs.sparkSession)
    mark = fresh(docs, "__kept")
    return docs.withColumn(mark, verdict(F.col(text).cast("string"))).where(F.col(mark)).drop(mark)
