"""Operator 6: URL filters as a sort-merge range join, with DataFrame functions only."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkstream.llm.common import ready


def host_of(url) -> F.Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty without ``://``."""
    rest = F.when(url.contains("://"), F.substring(url, F.locate("://", url) + 3, F.length(url)))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lower, F.lit(""))


def path_of_url(url) -> F.Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    rest = F.when(url.contains("://"), F.substring(url, F.locate("://", url) + 3, F.length(url)))
    return F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host) -> F.Column:
    """Labels in reverse order, each followed by a dot: the keys of a host and its subdomains are those that begin
    with its own, so they form one interval, which ends where that last dot is replaced by the character after it."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def rule_table(spark, rules: Iterable[tuple[str, str, str]]) -> DataFrame:
    """Rules as rows: ``host``, ``path``, ``verdict``."""
    rows = [F.struct(*[F.lit(x).cast("string").alias(n) for x, n in zip(r, ("host", "path", "verdict"))]) for r in rules]
    return spark.range(1).select(F.inline(F.array(*rows)))


def judge(
    urls: DataFrame, rules: DataFrame, keep: list[str], url: str = "url", default: str = "allow", salts: int | None = None
) -> DataFrame:
    """Each row's ``keep`` columns with ``host``, ``path``, ``rule`` and ``verdict``.

    A rule (``host``, ``path``, ``verdict``) fits its host and all its subdomains, if the url's path starts with the
    rule's path. Of the rules that fit, the one with the longest host and path wins, of equal ones ``block`` before
    others; ``rule`` is its host and path. Without one, ``rule`` is null and ``verdict`` is ``default``. A null url, or
    one without ``://``, has an empty host and path. Rules with a null host, path or verdict are left out; repeated
    rows give repeated rows.

    Rules and urls are sorted together by host key and swept once. Intervals of host keys nest or are apart, so the
    rules open at a key are a stack: each rule row carries the stack at its own start, found by a sweep over the rules
    alone, and a url takes over the stack of the rule row last passed, without the intervals that ended before it. Urls are dealt to salts
    by their own hash, so no host or domain is hot, and every salt sweeps its urls along a copy of the rules. ``salts``
    is the number of shuffle partitions unless given.
    """
    spark = ready(urls.sparkSession)
    salts = salts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    clean = (
        rules.where("host is not null and path is not null and verdict is not null")
        .select(
            host_key(F.translate("host", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).alias("key"),
            "path", F.concat("host", "path").alias("rule"), "verdict",
        )
        .distinct()
    )
    # all rules of one host open and close together
    starts = clean.groupBy("key").agg(F.collect_list(F.struct("path", "rule", "verdict")).alias("rules"))
    # the stack at a start: the labels of a key name all keys that can hold it
    labels = F.split("key", r"\.")
    parts = F.slice(labels, 1, F.size(labels) - 1)
    holder = F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda n: F.concat(F.array_join(F.slice(parts, 1, n), "."), F.lit("."))
    )
    outer = starts.select("key", F.explode(holder).alias("outer")).join(
        starts.select(F.col("key").alias("outer"), F.col("rules").alias("held")), "outer"
    )
    stacks = outer.groupBy("key").agg(F.collect_list(F.struct("outer", "held")).alias("stack"))
    salt = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    names = [f"keep_{i}" for i in range(len(keep))]
    value = F.col(url).cast("string")
    left = urls.select(*[F.col(c).alias(n) for c, n in zip(keep, names)], value.alias("raw")).select(
        *names, host_of(F.col("raw")).alias("host"), path_of_url(F.col("raw")).alias("path"),
        F.pmod(F.xxhash64("raw", *names), F.lit(salts)).cast("int").alias("salt"),
    ).withColumn("key", host_key(F.col("host")))
    opened = stacks.select(salt.alias("salt"), "key", F.lit(0).alias("kind"), "stack")
    events = opened.unionByName(left.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    sweep = Window.partitionBy("salt").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = events.withColumn("open", F.last("stack", ignorenulls=True).over(sweep)).where("kind = 1")
    # intervals that still hold the key, then their rules whose path fits; the longest wins
    holding = F.filter("open", lambda s: F.startswith(F.col("key"), s["outer"]))
    fitting = F.filter(
        F.flatten(F.transform(holding, lambda s: s["held"])), lambda r: F.startswith(F.col("path"), r["path"])
    )
    best = F.reduce(
        fitting,
        F.lit(None).cast("struct<path:string,rule:string,verdict:string>"),
        lambda a, b: F.when(
            a.isNull()
            | (F.length(b["rule"]) > F.length(a["rule"]))
            | ((F.length(b["rule"]) == F.length(a["rule"])) & (b["verdict"] == "block") & (a["verdict"] != "block")),
            b,
        ).otherwise(a),
    )
    return swept.withColumn("best", best).select(
        *[F.col(n).alias(c) for c, n in zip(keep, names)],
        "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
