"""Operator 13: a Merkle manifest of a dataset, with a witness for every row, by aligned streaming append."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkstream.llm.common import kept, ready

#: Nodes of one run, and levels that a task adds above its nodes: blocks are 8 ** 4 consecutive nodes.
ARITY, LEVELS = 8, 4
HEX = 64
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPERS, LOWERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(*hexes: str) -> str:
    return hashlib.sha256("".join(hexes).encode()).hexdigest()


def leaf_of(values: Mapping[str, Column | str]) -> Column:
    """H of the fields in order: ``-`` for null, else UTF-8 byte count, colon, value."""
    said = []
    for value in values.values():
        text = (F.col(value) if isinstance(value, str) else value).cast("string")
        said.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*said).cast("binary"), 256)


class Append:
    """A tree that grows at its right end.

    Level k holds the open run of nodes there, each with the stretch of leaves below it. A run that is full, or last,
    becomes its H: at that moment every leaf below one of its nodes learns the node's place and siblings, so its
    witness always reaches the root of the subtree that it lies in.
    """

    def __init__(self) -> None:
        self.open: list[list[tuple[str, int, int]]] = [[]]
        self.witness: list[list[tuple[int, str]]] = []

    def append(self, node: str) -> None:
        at = len(self.witness)
        self.witness.append([])
        self.open[0].append((node, at, at + 1))
        level = 0
        while len(self.open[level]) == ARITY:
            self._close(level)
            level += 1

    def _close(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        hexes = [node for node, _, _ in run]
        for place, (_, first, last) in enumerate(run):
            step = place, "".join(hexes[:place] + hexes[place + 1 :])
            for leaf in range(first, last):
                self.witness[leaf].append(step)
        if len(self.open) == level + 1:
            self.open.append([])
        self.open[level + 1].append((digest(*hexes), run[0][1], run[-1][2]))

    def root(self, levels: int) -> str:
        """The node ``levels`` above the leaves; runs that are still open are last ones."""
        for level in range(levels):
            if self.open[level]:
                self._close(level)
        return self.open[levels][0][0]


def levels_of(nodes: int, most: int) -> int:
    """Levels that a block of a tree with so many nodes goes up, ``most`` at a time."""
    levels = 0
    while nodes > 1 and levels < most:
        nodes = -(-nodes // ARITY)
        levels += 1
    return levels


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Rows by tree and block; they come sorted."""
    rows: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if rows and (row["tree"], row["block"]) != (rows[0]["tree"], rows[0]["block"]):
                yield rows
                rows = []
            rows.append(row)
    if rows:
        yield rows


def _grown(nodes: list[dict], levels: int) -> tuple[Append, str]:
    tree = Append()
    for row in nodes:
        tree.append(row["node"])
    return tree, tree.root(levels_of(nodes[0]["n"], levels))


NODES = pa.schema([("tree", pa.int64()), ("idx", pa.int64()), ("n", pa.int64()), ("node", pa.string())])
WITNESSES = pa.schema(
    [("tree", pa.int64()), ("idx", pa.int64()), ("places", pa.list_(pa.int32())), ("siblings", pa.list_(pa.string()))]
)


def _roots(levels: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _blocks(batches):
            at, n = rows[0]["block"], -(-rows[0]["n"] // ARITY**levels)
            yield pa.RecordBatch.from_pylist(
                [{"tree": rows[0]["tree"], "idx": at, "n": n, "node": _grown(rows, levels)[1]}], schema=NODES
            )

    return run


def _witnesses(levels: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for head, *nodes in _blocks(batches):  # the witness of the block's root goes on where those of its nodes end
            tree, _ = _grown(nodes, levels)
            for low in range(0, len(nodes), 512):
                out = []
                for row, steps in zip(nodes[low : low + 512], tree.witness[low : low + 512]):
                    places, siblings = ([s[j] for s in steps] for j in (0, 1))
                    out.append({
                        "tree": row["tree"], "idx": row["idx"], "places": places + head["places"], "siblings": siblings + head["siblings"]
                    })
                yield pa.RecordBatch.from_pylist(out, schema=WITNESSES)

    return run


def _dealt(nodes: DataFrame, *more: str) -> DataFrame:
    return nodes.repartition("tree", "block").sortWithinPartitions("tree", "block", "idx").select(
        "tree", "block", "idx", "n", "node", *more
    )


def grow(nodes: DataFrame, levels: int) -> list[DataFrame]:
    """Nodes (tree, idx, n, node), the block roots above them, those above the block roots, up to one node a tree."""
    grown = [nodes]
    most = nodes.agg(F.max("n")).first()[0] or 0
    while True:
        blocks = grown[-1].withColumn("block", F.expr(f"idx div {ARITY**levels}"))
        roots = _dealt(blocks).mapInArrow(_roots(levels), "tree bigint, idx bigint, n bigint, node string")
        grown.append(kept(roots, "roots"))
        most = -(-most // ARITY**levels)
        if most <= 1:
            return grown


def descend(grown: list[DataFrame], above: DataFrame, levels: int) -> DataFrame:
    """Witnesses (tree, idx, places, siblings) of the first nodes, given those of the last (tree, idx 0)."""
    for nodes in reversed(grown[:-1]):
        rows = nodes.select("tree", F.expr(f"idx div {ARITY**levels}").alias("block"), "idx", "n", "node")
        heads = above.select("tree", F.col("idx").alias("block"), F.lit(-1).cast("bigint").alias("idx"), "places", "siblings")
        both = rows.unionByName(heads, allowMissingColumns=True)
        above = _dealt(both, "places", "siblings").mapInArrow(
            _witnesses(levels), "tree bigint, idx bigint, places array<int>, siblings array<string>"
        )
        if nodes is not grown[0]:
            above = kept(above, "witnesses")
    return above


def numbered(df: DataFrame, key: list[str], order: list[str], label: str) -> DataFrame:
    """``df`` with ``idx``, the place of a row among those of its key, and ``n``, their number; written to the shared
    folder. Rows are dealt by ranges of key and order, each range numbers its own, and the sizes of the ranges before
    are added; so a key of any size is spread. Nulls come first, equal rows in the order read."""
    by = [F.asc_nulls_first(c) for c in [*key, *order, "tie"]]
    rows = df.withColumn("tie", F.monotonically_increasing_id())
    dealt = rows.repartitionByRange(*by).sortWithinPartitions(*by).drop("tie")
    dealt = kept(dealt.withColumn("at", F.monotonically_increasing_id()), label)
    part = F.shiftright("at", 33)
    sizes = dealt.groupBy(*key, part.alias("part")).agg(F.min("at").alias("first"), F.count("*").alias("here"))
    whole = Window.partitionBy(*key)
    before = F.sum("here").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.withColumns({"before": F.coalesce(before, F.lit(0)), "n": F.sum("here").over(whole)})
    sizes = sizes.select(*[F.col(k).alias(f"{k}_of") for k in key], "part", "first", "before", "n")
    same = part == F.col("part")
    for k in key:
        same = same & F.col(k).eqNullSafe(F.col(f"{k}_of"))
    joined = dealt.join(sizes, same)
    return joined.select(*df.columns, (F.col("before") + F.col("at") - F.col("first")).alias("idx"), "n")


def manifest(docs: DataFrame, keep: Mapping[str, Column] | None = None, levels: int = LEVELS) -> DataFrame:
    """One row per input row: ``doc_id``, ``lang``, ``leaf``, ``subroot``, ``root``, ``witness`` and the columns ``keep``.

    ``docs`` has doc_id and n_chars (integers), source, lang and text; other columns are not read but by ``keep``. A
    row's leaf is H (lowercase hex SHA-256) of its fields. The leaves of a lang are in the order of doc_id, null first,
    then of the leaf; rows that are alike in all fields are interchangeable, each has its own place. While a lang has
    several nodes, every 8 consecutive ones, and the rest, become the H of their digests; a lang with one leaf has it as
    its ``subroot``. Subroots in the order of lang, null first, by UTF-8 bytes, give ``root`` in the same way.
    ``witness`` lists from the leaf up to the root each level's place in its run and the digests of the others of the
    run, joined. An empty table gives no rows.

    Leaves are numbered without gathering a lang. Blocks of 8 ** ``levels`` consecutive leaves are appended in order by
    one task each, which gives the block's root; the roots are appended to the trees above in the same way until one is left.
    On the way back a block's root hands its witness on to the nodes below it.
    """
    ready(docs.sparkSession)
    keep = dict(keep or {})
    leaves = kept(
        docs.select(
            F.col("doc_id").cast("bigint").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
            leaf_of({f: f for f in FIELDS}).alias("node"), *[c.alias(f"keep_{name}") for name, c in keep.items()],
        ),
        "leaves",
    )
    langs = kept(numbered(leaves.select("lang").distinct(), [], ["lang"], "langs"), "langs")
    placed = numbered(leaves, ["lang"], ["doc_id", "node"], "placed")
    tree = langs.select(F.col("lang").alias("of"), F.col("idx").alias("tree"))
    placed = kept(placed.join(tree, F.col("lang").eqNullSafe(F.col("of"))).drop("of"), "nodes")
    grown = grow(placed.select("tree", "idx", "n", "node"), levels)
    subroots = grown[-1].join(langs.select(F.col("idx").alias("tree"), F.col("n").alias("langs")), "tree")
    subroots = subroots.select(F.lit(0).cast("bigint").alias("tree"), F.col("tree").alias("idx"), F.col("langs").alias("n"), "node")
    upper = grow(subroots, levels)
    nothing = {"places": F.array().cast("array<int>"), "siblings": F.array().cast("array<string>")}
    top = descend(upper, upper[-1].select("tree", "idx", *[c.alias(n) for n, c in nothing.items()]), levels)
    above = top.select(F.col("idx").alias("tree"), F.lit(0).cast("bigint").alias("idx"), "places", "siblings")
    found = descend(grown, above, levels)
    ends = grown[-1].select("tree", F.col("node").alias("subroot")).crossJoin(
        F.broadcast(upper[-1].select(F.col("node").alias("root")))  # one row
    )
    rows = placed.select("tree", "idx", "doc_id", "lang", F.col("node").alias("leaf"), *[f"keep_{name}" for name in keep])
    steps = F.transform(
        F.arrays_zip("places", "siblings"), lambda s: F.struct(s["places"].alias("place"), s["siblings"].alias("siblings"))
    )
    return found.join(rows, ["tree", "idx"]).join(ends, "tree").select(
        "doc_id", "lang", "leaf", "subroot", "root", steps.alias("witness"), *[F.col(f"keep_{name}").alias(name) for name in keep]
    )


def folded(leaf: Column | str, witness: Column | str = "witness") -> Column:
    """The root that a leaf and its witness lead to."""
    leaf = F.col(leaf) if isinstance(leaf, str) else leaf

    def up(node: Column, step: Column) -> Column:
        before = step["place"] * HEX
        run = F.concat(F.substring(step["siblings"], F.lit(1), before), node, F.substring(step["siblings"], before + 1, F.length(step["siblings"])))
        return F.sha2(run.cast("binary"), 256)

    return F.aggregate(witness, leaf, up)


def proof(witness: Column | str = "witness") -> Column:
    """H of all siblings of a witness, from the leaf up."""
    return F.sha2(F.array_join(F.transform(witness, lambda s: s["siblings"]), "").cast("binary"), 256)


def tampered(doc_id: Column, text: Column) -> Column:
    """The text in lower case (A-Z only) where 3 divides the CRC32 of the id, else as it is."""
    hit = F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 0, F.lit(False))
    return F.when(hit, F.translate(text, UPPERS, LOWERS)).otherwise(text)


def audit(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """The manifest of ``docs`` as digests, and whether each row's tampered text still leads to the root: ``doc_id``,
    ``leaf``, ``subroot``, ``root``, ``proof_sha256``, ``folded_root``, ``verified``. A null id is never tampered with."""
    other = {f: F.col(f) for f in FIELDS} | {"text": tampered(F.col("doc_id"), F.col("text").cast("string"))}
    found = manifest(docs, {"presented": leaf_of(other)}, levels)
    found = found.withColumns({"proof_sha256": proof(), "folded_root": folded("presented")})
    return found.select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")
    )
