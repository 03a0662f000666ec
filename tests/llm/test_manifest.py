"""The Merkle manifest against a tree built in one place."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from sparkstream.llm import manifest

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string, tree int, IDX string, node string, root int"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    said = ("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[0], row[1], row[2], row[3], row[4]))
    return h("".join(said))


def tree(nodes):
    """Root and, for each node, the (place, siblings) of every level."""
    paths, below = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        up, held = [], []
        for low in range(0, len(nodes), 8):
            run = nodes[low : low + 8]
            for place in range(len(run)):
                for i in below[low + place]:
                    paths[i].append((place, run[:place] + run[place + 1 :]))
            up.append(h(*run))
            held.append(sum(below[low : low + 8], []))
        nodes, below = up, held
    return nodes[0], paths


def brute(rows):
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    groups = [sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for lang in langs]
    trees = [tree([leaf(r) for r in g]) for g in groups]
    root, tops = tree([t[0] for t in trees])
    out = []
    for group, (subroot, paths), top in zip(groups, trees, tops):
        for row, path in zip(group, paths):
            text = row[4]
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0 and text is not None:
                text = "".join(c.lower() if c.isascii() else c for c in text)
            node = leaf((*row[:4], text))
            for place, others in path + top:
                node = h(*others[:place], node, *others[place:])
            siblings = [s for _, others in path + top for s in others]
            out.append((row[0], leaf(row), subroot, root, h(*siblings), node, node == root))
    return out


def key(row):
    return tuple((x is not None, x if x is not None else 0) for x in row)


def rows_of(rng, n, langs):
    made = []
    for i in range(n):
        text = rng.choice([None, "", "Ünï " * 3, f"Text {i} Of Words", "lower only", "LONG " * 5000 if i % 97 == 0 else "Short"])
        made.append((rng.choice([None, i, i, i, -i, i // 2]), rng.choice([None, "web", "a:b"]), rng.choice(langs), rng.choice([None, i]), text))
    return made


@pytest.mark.parametrize("n, langs, levels", [
    (1, ["en"], 4), (9, ["en"], 4), (64, ["en"], 1), (65, [None, "en"], 1), (700, [None, "", "de", "en", "é", "z"], 1),
    (600, ["en"] * 9 + ["de"], 2), (90, [f"l{i}" for i in range(80)], 1), (300, ["en", "fr"], 4),
])
def test_against_one_tree(spark, n, langs, levels):
    rows = rows_of(random.Random(n), n, langs)
    rows += rows[: n // 10] * 2  # rows that are alike
    df = spark.createDataFrame([(*r, 1, "clash", "clash", 2) for r in rows], SCHEMA).repartition(5)
    got = [tuple(r) for r in manifest.audit(df, levels).collect()]
    assert sorted(got, key=key) == sorted(brute(rows), key=key)


def test_nothing(spark):
    assert manifest.audit(spark.createDataFrame([], SCHEMA)).count() == 0


def test_witnesses_grow_with_each_sibling():
    grown = manifest.Append()
    for i in range(10):
        grown.append(h(str(i)))
    assert [len(w) for w in grown.witness] == [1] * 8 + [0, 0]  # the run of the last two is open
    top = grown.root(2)
    assert [len(w) for w in grown.witness] == [2] * 10
    assert top == tree([h(str(i)) for i in range(10)])[0]


def test_a_changed_row_does_not_fold(spark):
    rows = [(i, "s", "en", i, f"text {i}") for i in range(20)]
    df = spark.createDataFrame([(*r, 1, "", "", 2) for r in rows], SCHEMA)
    other = {f: F.col(f) for f in manifest.FIELDS} | {"n_chars": F.when(F.col("doc_id") == 7, 99).otherwise(F.col("n_chars"))}
    found = manifest.manifest(df, {"shown": manifest.leaf_of(other)})
    bad = found.where(manifest.folded("shown") != F.col("root")).select("doc_id").collect()
    assert [r["doc_id"] for r in bad] == [7]
