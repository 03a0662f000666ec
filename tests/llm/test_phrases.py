"""Phrase collocations against counts of all phrases in one place."""

import glob
import os
import random
import re
import uuid
from collections import Counter

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from sparkstream.llm import common, phrases

SCHEMA = "key string, text string, lang string, n int, k string"
ASCII_LOWER = {i: i + 32 for i in range(65, 91)}


def brute(rows, least, top, longest=4, cover=80):
    out = []
    by_lang = {}
    for text, lang in rows:
        by_lang.setdefault(lang if lang is not None else "und", []).append((text or "").translate(ASCII_LOWER))
    for lang, texts in by_lang.items():
        f = Counter()
        n = 0
        for text in texts:
            for piece in re.split("[.,;:!?\n-\r]", text):
                words = [w for w in re.split("[ \t]", piece) if w]
                n += len(words)
                for k in range(1, longest + 1):
                    f.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
        named = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        found = []
        for p, a in named.items():
            if any(len(q) > len(p) and 100 * b >= cover * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in named.items()):
                continue
            score, _, l, r = min((2_000_000 * a // (f[p[:c]] + f[p[c:]]), c, f[p[:c]], f[p[c:]]) for c in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n, -score))
    return sorted(out)


def texts(rng, n):
    words = ["a", "B", "b", "the", "of", "é", "É", "ÉA", "x'", "new", "york", " ", "#"]
    rows = []
    for _ in range(n):
        text = ""
        for _ in range(rng.choice([0, 1, 5, 60])):
            text += rng.choice([*words, "New York City", "the new york", "a a a a a"]) + rng.choice([" ", " ", " ", "\t", "  ", ". ", "\n", ",", "\r\n"])
        rows.append((text, rng.choice(["en", "en", "en", None, "und", "d\te", ""])))
    return rows


@pytest.mark.parametrize("max_rows", [500_000, 100, 0])  # numbers, numbers then text, text
def test_against_all_phrases(spark, monkeypatch, max_rows):
    rng = random.Random(max_rows)
    rows = texts(rng, 400) + [(None, "en"), ("", None), (" \t\n", "en"), ("lone", "xx"), ("new york " * 20_000, "en")]
    rows += rows[:20]
    df = spark.createDataFrame([("clash", t, lang, 1, "clash") for t, lang in rows], SCHEMA).repartition(3)
    for least, top in ((3, 50), (30, 2000)):
        got = phrases.collocations(df, least, top, max_rows=max_rows)
        assert sorted(tuple(r) for r in got.collect()) == brute(rows, least, top)
    three = phrases.collocations(df, 5, 2000, longest=3, max_rows=max_rows)
    assert sorted(tuple(r) for r in three.collect()) == brute(rows, 5, 2000, longest=3)


def test_nothing(spark):
    got = phrases.collocations(spark.createDataFrame([], SCHEMA))
    assert got.count() == 0
    assert got.dtypes == [("lang", "string"), ("rank", "bigint"), ("phrase", "string"), ("a", "bigint"), ("l", "bigint"), ("r", "bigint"), ("n", "bigint"), ("score", "bigint")]


def test_words_and_pieces():
    assert phrases.words_of("A b.\tÉa\x0b;c  d".encode()) == [b"a", b"b", b"", "Éa".encode(), b"", b"c", b"d", b""]
    assert phrases.words_of(b" .;\n") == []


def shuffled(spark):
    """Bytes of shuffle files on the disk."""
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return sum(os.path.getsize(f) for d in dirs for f in glob.glob(f"{d}/*/shuffle_*.data"))


def test_many_phrases_stay_numbers(spark, monkeypatch, tmp_path):
    # 40 words, 1 600 phrases of 2 words, all frequent: more phrases than words may be numbered
    rng = random.Random(1)
    rows = [(" ".join(f"w{rng.randrange(40)}" for _ in range(400)), "en") for _ in range(300)]
    df = spark.createDataFrame([("", t, lang, 1, "") for t, lang in rows], SCHEMA).repartition(3)
    monkeypatch.setattr(common, "scratch", lambda _, label: f"{tmp_path}/{label}-{uuid.uuid4().hex}")
    before = shuffled(spark)
    found, _ = phrases.frequencies(df, 2, max_rows=100)
    left = shuffled(spark)
    got = {r.key: r.f for r in found.collect()}
    texts = [t.split() for t, _ in rows]
    counts = Counter(f"en\t{' '.join(w[i : i + k])}" for w in texts for k in range(1, 5) for i in range(len(w) - k + 1))
    assert got == {p: a for p, a in counts.items() if a >= 2}
    kinds = [pq.read_schema(glob.glob(f"{d}/*.parquet")[0]).field("words").type.value_type for d in glob.glob(f"{tmp_path}/occurrences-*")]
    assert sorted(map(str, kinds)) == ["int32", "int32", "int32", "string"]
    assert not glob.glob(f"{tmp_path}/listed-*")  # the relation is not written twice to join it by shuffles
    assert left <= before + 10_000  # a round's shuffle files go with the round
    assert spark.conf.get(phrases._CLEANUP) == "false"


@pytest.mark.parametrize("max_rows", [4_000_000, 0])
def test_a_full_sieve(spark, monkeypatch, max_rows):
    monkeypatch.setattr(phrases, "SIEVE_MOST", 1 << 15)
    monkeypatch.setattr(phrases, "_sieve", lambda *_, f=phrases._sieve: f(*_) | 0x55)  # half of all others pass as well
    rows = texts(random.Random(5), 200)
    df = spark.createDataFrame([("clash", t, lang, 1, "clash") for t, lang in rows], SCHEMA).repartition(3)
    got = phrases.collocations(df, 3, 200, max_rows=max_rows)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 3, 200)
    if max_rows:
        six = phrases.collocations(df, 3, 200, longest=6)  # three numbers a phrase
        assert sorted(tuple(r) for r in six.collect()) == brute(rows, 3, 200, longest=6)


def test_places_and_hashes():
    known = pa.array(["c", "a", "b"])
    assert phrases._places(pa.array(["a", "x", "a", "c"]), known).tolist() == [1, -1, 1, 0]
    assert phrases._places(pa.array([], pa.string()), known).tolist() == []
    keys = pa.array(["", "a", "aa", "ab", "ba", "é", "a", "en\tnew york"] * 20_000)
    hashes = phrases._key_hashes(keys)
    assert len(set(hashes.tolist())) == 7 and hashes[1] == hashes[6]
    assert phrases._key_hashes(keys.slice(3, 90_000)).tolist() == hashes[3:90_003].tolist()
