"""Operators on the whole corpus: near duplicates, decontamination, the pipeline."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sparkstream.llm import leaks, neardup
from sparkstream.llm.common import kept, table

SCHEMA = "doc_id bigint, text string, class_id string, rep bigint, bands string"


def grams(text, n=5):
    words = (text or "").split()
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else {tuple(words)} if words else set()


def brute(rows, threshold=0.8):
    """(class, copy, links) of every id, by comparing all texts."""
    copies = {}
    for key, text in rows:
        if key is not None and grams(text):
            copies[text] = min(copies.get(text, key), key)
    sets = {k: grams(t) for t, k in copies.items()}
    root, links = {k: k for k in sets}, {k: 0 for k in sets}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]) - 1e-9:
                links[a] += 1
                links[b] += 1
                x, y = top(a), top(b)
                root[max(x, y)] = min(x, y)
    out = {}
    for key, text in rows:
        if key is None:
            out[key] = (None, None, 0)
        elif text in copies:
            out[key] = (top(copies[text]), copies[text], links[copies[text]])
        else:
            out[key] = (key, key, 0)
    return out


def near_copies(rng, n_texts=12, copies=14):
    words = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(n_texts):
        base = [rng.choice(words) for _ in range(rng.choice([4, 12, 60, 120]))]
        for _ in range(rng.randint(1, copies)):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                text[rng.randrange(len(text))] = rng.choice(words)
            rows.append((len(rows) * 3 % 1000, rng.choice([" ", "  "]).join(text)))
    return rows


@pytest.mark.parametrize("small", [False, True])
def test_near_duplicates_against_all_pairs(spark, monkeypatch, small):
    if small:  # every bucket is cut into blocks
        monkeypatch.setattr(neardup, "BLOCK_TEXTS", 2)
        monkeypatch.setattr(neardup, "BLOCK_GRAMS", 150)
    rows = near_copies(random.Random(11 + small))
    rows += [rows[0], (5001, None), (5002, ""), (5003, " \n"), (5004, rows[3][1]), (None, rows[3][1]), (5005, "word " * 9000)]
    df = spark.createDataFrame([(*r, "clash", 1, "clash") for r in rows], SCHEMA)
    got = neardup.near_duplicates(df).collect()
    assert len(got) == len(rows)
    want = brute(rows)
    assert {r["doc_id"]: (r["class_id"], r["copy_id"], r["n_links"]) for r in got} == want
    left = neardup.one_of_each(df).collect()
    assert left[0].asDict().keys() == set(df.columns)
    ids = [r["doc_id"] for r in left]
    assert sorted(i for i in ids if i is not None) == sorted({c[0] for k, c in want.items() if k is not None})
    assert ids.count(None) == 1


def test_different_texts_of_one_id(spark):
    a, b, near = "alpha beta gamma delta epsilon zeta eta theta", "one two three four five six seven", "alpha beta gamma delta epsilon zeta eta theta iota"
    rows = [(7, a), (7, b), (1, a), (9, b), (9, b), (3, near), (None, a), (None, a), (8, " "), (8, " ")]
    df = spark.createDataFrame([(*r, "clash", 1, "clash") for r in rows], SCHEMA)
    got = sorted((r["doc_id"], r["class_id"], r["copy_id"], r["n_links"]) for r in neardup.near_duplicates(df).collect() if r["doc_id"] is not None)
    assert got == sorted([(7, 1, 1, 1), (7, 7, 7, 0), (1, 1, 1, 1), (9, 7, 7, 0), (9, 7, 7, 0), (3, 1, 3, 1), (8, 8, 8, 0), (8, 8, 8, 0)])
    left = sorted(((r["doc_id"], r["text"]) for r in neardup.one_of_each(df).collect()), key=str)
    assert left == sorted([(7, b), (1, a), (None, a), (None, a), (8, " "), (8, " ")], key=str)
    two = spark.createDataFrame([(7, a, "", 1, ""), (7, b, "", 1, ""), (7, b, "", 1, "")], SCHEMA)
    assert sorted(r["text"] for r in neardup.one_of_each(two).collect()) == [a, b]


def test_near_duplicates_of_nothing(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert neardup.near_duplicates(df).count() == 0 and neardup.one_of_each(df).count() == 0


def test_banding_meets_the_recall():
    for threshold in (0.5, 0.8, 0.9, 1.0):
        for recall in (0.9, 0.9999):
            plan = neardup.banding(threshold, recall)
            assert 1 - (1 - threshold**plan.rows) ** plan.bands >= recall - 1e-12
    with pytest.raises(ValueError):
        neardup.banding(0, 0.9)


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(1, 30)] + [(rng.randint(40, 90), rng.randint(40, 90)) for _ in range(25)] + [(7, 7)]
    root = {}
    find = lambda x: x if root.setdefault(x, x) == x else find(root[x])
    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r["node"]: r["root"] for r in neardup.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {x: find(x) for x in got} and {x for e in edges if e[0] != e[1] for x in e} == set(got)
    assert neardup.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_registered_near_duplicates(spark, sf_dir):
    from sparkstream.llm.queries import op5_ngram_jaccard_join

    rows = [(r["doc_id"], r["text"]) for r in table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    got = op5_ngram_jaccard_join(spark, sf_dir).collect()
    assert {r["doc_id"]: (r["class_id"], r["copy_id"], r["n_links"]) for r in got} == brute(rows)


# ---------------------------------------------------------------- decontamination


def edits(pattern, text):
    """Fewest edits between the pattern and any stretch of the text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        now = [i] + [0] * len(text)
        for j, d in enumerate(text, 1):
            now[j] = min(row[j - 1] + (c != d), row[j] + 1, now[j - 1] + 1)
        row = now
    return min(row)


def test_banded_alignment():
    rng = random.Random(1)
    for _ in range(250):
        pattern = "".join(rng.choice("abc") for _ in range(rng.randint(1, 12)))
        text = "".join(rng.choice("abc") for _ in range(rng.randint(0, 14)))
        found = leaks.banded_edits(pattern, text, -len(pattern), len(text), len(pattern))
        assert found[0] == edits(pattern, text)
        assert edits(pattern, text[found[1] : found[2]]) == found[0]


def altered(rng, text, n):
    out = list(text)
    for _ in range(n):
        at, kind = rng.randrange(len(out)), rng.random()
        out[at : at + 1] = ["q"] if kind < 0.4 else [] if kind < 0.7 else [out[at], "q"]
    return "".join(out)


def test_leaks_against_a_plain_search(spark):
    """Short items, each one window and its parts: a row exactly where some stretch is within a budget."""
    rng = random.Random(12)
    prose = lambda n: "".join(rng.choice("abcdefgh tion the ") for _ in range(n))
    items = [(i, leaks.plain(prose(rng.randint(30, 118)))) for i in range(12)]
    docs = []
    for i, item in items * 3:
        n = rng.choice([0, 1, 2, 4, 6, 8, 12])
        docs.append(leaks.plain(prose(80)) + " " + altered(rng, item, n) + " " + leaks.plain(prose(60)))
    docs += [None, "", items[0][1].upper().replace(" ", "\n\t"), items[1][1][:20], prose(60) * 500]
    df = spark.createDataFrame([(k, d, "clash", k) for k, d in enumerate(docs)], "doc_id bigint, text string, item_id string, start bigint")
    bench = spark.createDataFrame([*items, (50, None), (51, "")], "item_id bigint, text string")
    got = {(r["doc_id"], r["item_id"]): r for r in leaks.find(df, bench).collect()}
    for k, doc in enumerate(docs[:-1]):
        text = leaks.plain(doc)
        for i, item in items:
            fewest, size = edits(item, text), leaks.PART
            parts = [item[a : a + size] for a in leaks._starts(len(item), size, leaks.STEP)] if len(item) > size else []
            near = fewest <= leaks.budget_of(len(item), 0.08)
            assert ((k, i) in got) == (near or any(edits(p, text) <= leaks.budget_of(size, 0.08) for p in parts)), (k, i, fewest, len(item))
            if near:
                assert got[k, i]["edits"] == fewest
    clean = leaks.without_leaks(df, bench)
    assert clean.columns == df.columns
    assert {r["doc_id"] for r in clean.collect()} == set(range(len(docs))) - {k for k, _ in got}


def test_one_rule_for_excerpts_of_items_of_any_length(spark):
    rng = random.Random(21)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8)))
    items = [(n, leaks.plain(" ".join(word() for _ in range(80)))[:n].strip().ljust(n, "z")) for n in (100, 118, 119, 120, 121, 122, 200)]
    docs = [(n, "q " * 30 + t[10:50] + "Q" + t[51:90] + " r" * 30) for n, t in items]  # 80 characters with one typo
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r["doc_id"], r["item_id"]) for r in leaks.find(df, bench).collect()}
    assert got == {(n, n) for n, _ in items}


def test_rows_are_judged_by_their_own_text(spark):
    leak = "this passage is part of the benchmark and nobody is meant to train on any of it at all"
    rows = [(None, leak, 1), (None, "clean", 2), (3, "clean", 3), (3, "so it goes: " + leak, 4), (3, None, 5), (3, "", 6)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, __clear int")
    bench = spark.createDataFrame([(None, leak), (-1, "another item that is long enough to be found if it is there")], "item_id bigint, text string")
    assert sorted(r["__clear"] for r in leaks.without_leaks(df, bench).collect()) == [2, 3, 5, 6]
    assert {(r["doc_id"], r["item_id"]) for r in leaks.find(df, bench).collect()} == {(None, None), (3, None)}
    assert leaks.without_leaks(df, bench.limit(0)).count() == 6


def test_leaks_of_parts_blocks_and_nothing(spark, monkeypatch):
    rng = random.Random(5)
    items = [(i, "".join(rng.choice("abcdefghij klmnop") for _ in range(400))) for i in range(6)]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    docs = [(i, "x " * 50 + t[90:310] + " y" * 40) for i, t in items] + [(None, items[0][1]), (99, "nothing of this"), (99, "nothing of this")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    whole = sorted(map(str, leaks.find(df, bench).collect()))
    assert len(whole) == 7
    monkeypatch.setattr(leaks, "BLOCK_CHARS", 900)  # several passes give the same rows
    assert sorted(map(str, leaks.find(df, bench).collect())) == whole
    assert leaks.find(df.limit(0), bench).count() == 0 and leaks.find(df, bench.limit(0)).count() == 0
    assert leaks.without_leaks(df, bench).count() == 2


def test_leaks_of_excerpts_at_every_offset(spark):
    rng = random.Random(15)
    prose = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    items = [(i, leaks.plain("x" + prose(n) + "x")) for i, n in enumerate((95, 117, 200, 388))]
    docs = []
    for i, item in items:
        for n in (70, 85, 100, 119, 150):
            docs += [(i, prose(90) + " " + item[at : at + n] + " " + prose(90)) for at in range(len(item) - n + 1)]
    # of a long item, an excerpt with an edit in every twenty characters is one, too
    for at in range(0, 300, 7):
        part = items[3][1][at : at + 80]
        docs.append((3, prose(90) + "".join("#" if k % 20 == 10 else c for k, c in enumerate(part)) + prose(90)))
    docs.append((-1, prose(90) + items[3][1][100:145] + prose(90)))  # too little of it
    df = spark.createDataFrame([(k, t) for k, (_, t) in enumerate(docs)], "doc_id bigint, text string")
    got = {(r["doc_id"], r["item_id"]) for r in leaks.find(df, spark.createDataFrame(items, "item_id bigint, text string")).collect()}
    assert got == {(k, i) for k, (i, _) in enumerate(docs) if i >= 0}


def test_registered_leaks_hold_every_exact_passage(spark, sf_dir):
    from sparkstream.llm.queries import op3_decontamination

    docs = {r["doc_id"]: leaks.plain(r["text"]) for r in table(spark, sf_dir, "documents").collect()}
    items = {r["item_id"]: leaks.plain(r["text"]) for r in table(spark, sf_dir, "benchmark").collect()}
    got = {(r["doc_id"], r["item_id"]) for r in op3_decontamination(spark, sf_dir).collect()}
    assert {(d, i) for d, t in docs.items() for i, x in items.items() if x in t} <= got


# ---------------------------------------------------------------- pipeline


def test_pipeline_stages(spark, sf_dir):
    docs = first = table(spark, sf_dir, "documents")
    texts = {r["doc_id"]: r["text"] for r in first.collect()}
    items = [leaks.plain(r["text"]) for r in table(spark, sf_dir, "benchmark").collect()]
    before = set(texts)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), name)
        assert docs.columns == first.columns
        now = [r["doc_id"] for r in docs.select("doc_id").collect()]
        assert len(now) == len(set(now)) and set(now) <= before
        if name == "near_duplicates":
            classes = brute([(k, texts[k]) for k in before])
            assert set(now) == {c for c, _, _ in classes.values()}
        if name == "decontamination":
            held = {k for k in before if any(x in leaks.plain(texts[k]) for x in items)}
            assert not held & set(now) and len(before - held - set(now)) <= 0.02 * len(before)
        before = set(now)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    assert {r["doc_id"] for r in last} == before and all(r["n_tokens"] == len(r["ids"]) for r in last)
    assert sorted(r["ids_sha256"] for r in corpus_pipeline.run(spark, sf_dir).collect()) == sorted(r["ids_sha256"] for r in last)


def test_pipeline_keeps_clean_documents(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    good = docs.join(labels.where("quality = 1"), "doc_id", "left_semi").where(F.size(F.split("text", r"\s+")) >= 60)
    left = corpus_pipeline.quality(spark, docs, sf_dir).join(good, "doc_id", "left_semi")
    assert left.count() >= 0.95 * good.count()
    assert corpus_pipeline.language(spark, good, sf_dir).count() >= 0.95 * good.count()


def test_pipeline_odd_rows(spark, sf_dir):
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (2, "text", None, None, 4), (2, "text", None, None, 4)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    for docs in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        for name, stage in corpus_pipeline.STAGES:
            assert kept(stage(spark, docs, sf_dir), name).count() <= docs.count()
