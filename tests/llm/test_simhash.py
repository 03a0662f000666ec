"""SimHash fingerprints and their components, against all pairs."""

import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from sparkstream.llm import simhash
from sparkstream.llm.common import table


def plain_fingerprint(text):
    words = "".join(c.lower() if c.isascii() else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hashes) > len(hashes))


def brute_roots(marks):
    root = {m: m for m in marks}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in marks:
        for b in marks:
            if a < b and (a ^ b).bit_count() <= 3:
                x, y = top(a), top(b)
                root[max(x, y)] = min(x, y)
    return {m: top(m) for m in marks}


def brute(rows):
    marks = {t: plain_fingerprint(t) for _, t in rows}
    root = brute_roots(set(marks.values()))
    least = {}
    for key, text in rows:
        if key is not None:
            r = root[marks[text]]
            least[r] = min(least.get(r, key), key)
    return sorted(
        ((k, f"{marks[t]:016x}", least.get(root[marks[t]])) for k, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1])
    )


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("seed", [8, 9])
def test_balls_connect_what_all_pairs_connect(spark, seed):
    rng = random.Random(seed)
    marks = {0, (1 << 64) - 1}
    for _ in range(25):
        centre = rng.getrandbits(64)
        marks.add(centre)
        for _ in range(rng.choice([1, 2, 30])):
            low = rng.choice([None, 0, 16, 32, 48])  # all turned bits in one block, or anywhere
            bits = [rng.randrange(64) if low is None else low + rng.randrange(16) for _ in range(rng.randint(1, 5))]
            marks.add(centre ^ sum({1 << b for b in bits}))
    df = spark.createDataFrame([(signed(m),) for m in marks], "bits bigint")
    edges = [(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in simhash.links(df).collect()]
    assert edges and all((a ^ b).bit_count() <= 3 for a, b in edges)
    root = {m: m for m in marks}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    assert root == brute_roots(marks)


def test_every_pair_within_three_bits_meets():
    for bits in [(0, 1, 2), (0, 15, 16), (3, 20, 40), (47, 48, 63), (5, 6), (0, 63), (17,)]:
        base = 0x123456789ABCDEF0
        marks = np.array([base, base ^ sum(1 << b for b in bits)], dtype=np.uint64)
        found = []
        for block in range(4):
            turned = [((int(m) << 16 * block) | (int(m) >> (64 - 16 * block) if block else 0)) & ((1 << 64) - 1) for m in marks]
            rows = sorted(
                ((block << 48) | ((t & ((1 << 48) - 1)) ^ f), int(m)) for t, m in zip(turned, marks) for f in [0, *(1 << i for i in range(48))]
            )
            got = simhash.links_of(*(np.array(x, dtype=np.uint64) for x in zip(*rows)))
            found += got.tolist()
        assert found, bits


def test_keys_across_batches(monkeypatch):
    rng = random.Random(2)
    rows = sorted((k, rng.getrandbits(3)) for k in (5, 6, 7) for _ in range(40))
    whole = simhash.links_of(*(np.array(x, dtype=np.uint64) for x in zip(*rows)))
    for size in (1, 3, 50):
        monkeypatch.setattr(simhash, "CHUNK", size)
        batches = [pa.RecordBatch.from_pydict({"key": [k for k, _ in rows[i : i + 7]], "bits": [b for _, b in rows[i : i + 7]]}) for i in range(0, len(rows), 7)]
        got = {tuple(p.values()) for b in simhash._linker(iter(batches)) for p in b.to_pylist()}
        assert got == {tuple(p) for p in whole.tolist()}
    assert list(simhash._linker(iter([]))) == []


def test_rows_of_every_kind(spark):
    rng = random.Random(4)
    words = [f"W{i}é" for i in range(60)]
    rows = [(900, None), (901, ""), (902, " \t\n"), (903, "one"), (904, "One two"), (905, "ONE TWO"), (906, "x " * 40_000), (None, "x " * 40_000), (None, "only here")]
    for i in range(30):
        base = [rng.choice(words) for _ in range(rng.choice([3, 40, 200]))]
        rows.append((i, " ".join(base)))
        for j in range(rng.randint(0, 4)):
            near = list(base)
            if rng.random() < 0.6:
                near[rng.randrange(len(near))] = rng.choice(words)
            rows.append((100 + 10 * i + j, " ".join(near)))
    rows += [rows[9], (rows[9][0], "another text of the same id")]
    df = spark.createDataFrame([(*r, 7, "clash", "clash") for r in rows], "doc_id bigint, text string, bits int, key string, component_id string")
    got = sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(df).collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert got == brute(rows)
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_registered_simhash(spark, sf_dir):
    from sparkstream.llm.queries import op11_simhash

    rows = [(r["doc_id"], r["text"]) for r in table(spark, sf_dir, "documents").collect()]
    got = op11_simhash(spark, sf_dir)
    assert got.dtypes == [("doc_id", "bigint"), ("fingerprint", "string"), ("component_id", "bigint")]
    assert sorted((tuple(r) for r in got.collect()), key=lambda r: r[0]) == brute(rows)
