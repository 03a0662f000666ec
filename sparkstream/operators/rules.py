"""Rules held as data: SQL conditions on tags and fields, evaluated in one pass over the rows."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Mapping
from itertools import batched

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkstream.plans.sizes import broadcast_if_small

RULES_PER_PASS = 2_000
# Words a rule may use besides the columns of its input.
ALLOWED = frozenset(
    "and or not is null in like between true false element_at try_element_at "
    "abs lower upper length coalesce cast as double bigint int string".split()
)


def check_rule(predicate: str, columns: Iterable[str]) -> None:
    """Refuse a rule that names anything but the input's columns and the allowed words.

    Backslashes and double quotes are refused inside literals as well: with them the end of a literal is where SQL sees
    it and nowhere else, and what lies outside of the literals is all that SQL reads as names.
    """
    if predicate is None:
        raise ValueError("a rule has no predicate")
    if re.search(r'[\\"`;]|--|/\*', predicate) or predicate.count("'") % 2:
        raise ValueError(f"rule has characters that are not allowed: {predicate}")
    bare = re.sub(r"'[^']*'", " ", predicate)
    names = {w.lower() for w in re.findall(r"[A-Za-z_][A-Za-z_0-9]*", bare)}
    unknown = names - ALLOWED - {c.lower() for c in columns}
    if unknown:
        raise ValueError(f"rule uses names that are not allowed: {sorted(unknown)}")


def tag_condition(tags: str, name: str) -> str:
    return f"try_element_at({tags}, '{name}')"


def match_rules(df: DataFrame, rules: DataFrame, rule_id: str = "rule_id", predicate: str = "predicate") -> DataFrame:
    """One row per (input row, rule it satisfies); a missing tag or field satisfies nothing.

    The rule set is configuration: conditions become part of the plan. Input rows are read once for every
    ``RULES_PER_PASS`` rules, however many rules there are.
    """
    kind = rules.schema[rule_id].dataType
    found = None
    for some in batched(_checked(rules.select(rule_id, predicate), df.columns), RULES_PER_PASS):
        hits = F.array(*[F.when(F.expr(text), F.lit(name).cast(kind)) for name, text in some])
        part = df.withColumn(rule_id, F.explode(F.filter(hits, lambda hit: hit.isNotNull())))
        found = part if found is None else found.unionByName(part)
    return df.withColumn(rule_id, F.lit(None).cast(kind)).where(F.lit(False)) if found is None else found


def _checked(rules: DataFrame, columns: list[str]) -> Iterator[tuple]:
    for row in rules.toLocalIterator():
        check_rule(row[1], columns)
        yield row[0], row[1]


#: Sets of fields that the equality conditions of indexed rules may use.
SHAPES = 1_000
EQUALS = "array<struct<field: string, value: string>>"
BOUNDS = "array<struct<field: string, op: string, value: double>>"


def match_indexed(df: DataFrame, rules: DataFrame, fields: Mapping[str, Column], rule_id: str = "rule_id") -> DataFrame:
    """One row per (input row, rule it satisfies), for rules held as rows, in any number and from any table.

    ``rules`` has ``rule_id``, ``equals`` (:data:`EQUALS`: all must hold) and ``bounds`` (:data:`BOUNDS`, op one of
    ``< <= > >= <>``: all must hold as well); a null list holds nothing. ``fields`` gives each field's value in a row;
    values are compared as text by ``equals``, as doubles by ``bounds``. A null, or what is no number, satisfies nothing.

    The rules are indexed by the set of fields that their equalities use (a few sets, at most ``SHAPES``) and the values
    asked for. A row is looked up once for each set, by a hash join on its own values, so it meets only rules whose
    equalities all hold, and only their bounds are evaluated. The input is read once, however many rules there are; a
    measured small rule set is broadcast, a larger one joined by shuffle. Repeated rules are found as often as they come.
    """
    asked = F.array_sort(F.coalesce(F.col("equals").cast(EQUALS), F.array().cast(EQUALS)))
    indexed = rules.select(
        F.col(rule_id).alias("__rule"), asked.alias("__asked"), F.coalesce(F.col("bounds").cast(BOUNDS), F.array().cast(BOUNDS)).alias("__bounds")
    ).select(
        "__rule", "__bounds", F.transform("__asked", lambda c: c["field"]).alias("__shape"), F.transform("__asked", lambda c: c["value"]).alias("__key")
    )
    used = F.flatten(F.array("__shape", F.transform("__bounds", lambda b: b["field"])))
    odd = indexed.select(F.explode(used).alias("f")).where(~F.col("f").isin(list(fields)) | F.col("f").isNull()).limit(1).collect()
    if odd:
        raise ValueError(f"a rule asks for a field that is not there: {odd[0][0]}")
    shapes = [r[0] for r in indexed.select("__shape").distinct().limit(SHAPES + 1).collect()]
    if len(shapes) > SHAPES:
        raise ValueError(f"rules use more than {SHAPES} different sets of fields")
    texts = {f: c.cast("string") for f, c in fields.items()}
    probes = []
    for shape in shapes:
        values = F.array(*[texts[f] for f in shape]) if shape else F.array().cast("array<string>")
        have = F.lit(True)
        for f in shape:
            have = have & texts[f].isNotNull()
        named = F.array(*[F.lit(f) for f in shape]) if shape else F.array().cast("array<string>")
        probes.append(F.when(have, F.struct(named.alias("shape"), values.alias("key"))))
    if not probes:
        return df.withColumn(rule_id, F.lit(None).cast(rules.schema[rule_id].dataType)).where(F.lit(False))
    numbers = {f: c.try_cast("double") for f, c in fields.items()}
    probed = df.withColumns({
        "__numbers": F.create_map(*[x for f, c in numbers.items() for x in (F.lit(f), c)]),
        "__probe": F.explode(F.filter(F.array(*probes), lambda p: p.isNotNull())),
    })
    small = broadcast_if_small(indexed)
    found = probed.join(small, (F.col("__probe.shape") == F.col("__shape")) & (F.col("__probe.key") == F.col("__key")))

    def holds(b: Column) -> Column:
        have, op = F.col("__numbers")[b["field"]], b["op"]
        said = (
            F.when(op == "<", have < b["value"]).when(op == "<=", have <= b["value"]).when(op == ">", have > b["value"])
            .when(op == ">=", have >= b["value"]).when(op == "<>", have != b["value"])
        )
        return F.coalesce(said, F.lit(False))

    return found.where(F.forall("__bounds", holds)).select(*df.columns, F.col("__rule").alias(rule_id))
