"""Event patterns per key: sequences, repetitions, time limits, timeouts.

A pattern is matched set-wise. For each stage a reverse scan hands every row the next row that can
continue there; a repetition is a stretch of ranks among the rows that satisfy its condition. A match
is then built stage by stage with equality joins on ``(key, order)`` or ``(key, rank)``, so the work
follows the number of matches, no group is gathered in one task, and no pairs are tried and thrown
away. A pattern of two single events needs one scan and no join. All matches are returned.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkstream.plans.cells import WHOLE_KEYS, Layout, measure_cells
from sparkstream.plans.scan import latest, next_row, running_count, running_max, scan, settled


@dataclass(frozen=True, eq=False)
class Stage:
    name: str
    cond: Column
    link: str = "begin"
    least: int = 1
    most: int | None = 1
    strict: bool = False
    combine: bool = False
    stop: Column | None = None
    limit: int = 5

    @property
    def repeated(self) -> bool:
        return self.most != 1 or self.stop is not None

    @property
    def accepts(self) -> Column:
        ok = F.coalesce(self.cond, F.lit(False))
        return ok if self.stop is None else ok & ~F.coalesce(self.stop, F.lit(False))

    @property
    def breaks(self) -> Column | None:
        """Rows that end a run of the repetition."""
        if self.strict:
            return ~self.accepts
        return None if self.stop is None else F.coalesce(self.stop, F.lit(False))


@dataclass(frozen=True, eq=False)
class Pattern:
    """``Pattern.begin("a", cond).next("b", cond).followed_by("c", cond).one_or_more().within(us)``."""

    stages: tuple[Stage, ...]
    within_us: int | None = None

    @staticmethod
    def begin(name: str, cond: Column) -> Pattern:
        return Pattern((Stage(name, cond),))

    def next(self, name: str, cond: Column) -> Pattern:
        """The very next row of the key."""
        return replace(self, stages=(*self.stages, Stage(name, cond, "next")))

    def followed_by(self, name: str, cond: Column) -> Pattern:
        """The first later row that satisfies ``cond``; rows in between are ignored."""
        return replace(self, stages=(*self.stages, Stage(name, cond, "followed_by")))

    def _last(self, **changes) -> Pattern:
        return replace(self, stages=(*self.stages[:-1], replace(self.stages[-1], **changes)))

    def one_or_more(self) -> Pattern:
        return self._last(least=1, most=None)

    def times(self, least: int, most: int | None = None) -> Pattern:
        return self._last(least=least, most=least if most is None else most)

    def consecutive(self) -> Pattern:
        """No other row of the key inside the repetition."""
        return self._last(strict=True)

    def allow_combinations(self, limit: int = 5) -> Pattern:
        """Rows of the repetition may be left out: every increasing choice of up to ``limit`` rows is a match."""
        return self._last(combine=True, limit=limit)

    def until(self, stop: Column) -> Pattern:
        """The repetition ends before a row that satisfies ``stop``."""
        return self._last(stop=stop)

    def within(self, microseconds: int) -> Pattern:
        """First and last row less than this apart."""
        return replace(self, within_us=microseconds)

    def check(self) -> None:
        for s in self.stages:
            if s.combine and (s.most is None or s.most > s.limit):
                raise ValueError(f"allow_combinations needs times(n, m) with m <= {s.limit}; give a larger limit if that is meant")
            if self.within_us is None and ((s.repeated and s.most is None) or s.combine):
                raise ValueError(f"stage {s.name} needs within or an upper count: a run has quadratically many matches")


@dataclass(frozen=True)
class Matches:
    """``rows``: one per match, with ``<stage>_first`` and ``<stage>_last`` (structs of the events) and
    ``<stage>_n``. ``timeouts``: starts that ran out of time, for patterns of single events."""

    rows: DataFrame
    timeouts: DataFrame | None
    events: DataFrame
    key: tuple[str, ...]
    pattern: Pattern

    def members(self) -> DataFrame:
        """Every event of every match: key, ``match_id``, stage, and the event struct ``ev``."""
        picked = []
        for i, s in enumerate(self.pattern.stages):
            one = self.rows.select(*self.key, "match_id", F.lit(s.name).alias("stage"), f"__m{i}")
            if not s.repeated:
                picked.append(one.select(*self.key, "match_id", "stage", F.col(f"__m{i}.ev").alias("ev")))
                continue
            each = F.col(f"__m{i}.ranks") if s.combine else F.sequence(f"__m{i}.from", f"__m{i}.to")
            ranks = one.select(*self.key, "match_id", "stage", F.explode(each).alias("__rank"))
            pool = self.events.where(F.col(f"__ok{i}")).select(*self.key, F.col(f"__rank{i}").alias("__rank"), "ev")
            picked.append(ranks.join(pool, [*self.key, "__rank"]).drop("__rank"))
        out = picked[0]
        for more in picked[1:]:
            out = out.unionByName(more)
        return out


def _micros(col: Column) -> Column:
    return F.unix_micros(col)


def _prepared(df: DataFrame, pattern: Pattern, key, order, keep, layout, settle) -> DataFrame:
    """Events with each repetition's rank and run end, and the row that continues each stage."""
    oks = {f"__ok{i}": s.accepts for i, s in enumerate(pattern.stages)}
    breaks = {f"__brk{i}": s.breaks for i, s in enumerate(pattern.stages) if s.repeated and s.breaks is not None}
    rows = df.select(*dict.fromkeys([*key, *order, *keep]), *[c.alias(n) for n, c in {**oks, **breaks}.items()])
    repeated = [i for i, s in enumerate(pattern.stages) if s.repeated]
    several_uses = bool(repeated) or len(pattern.stages) > 2
    if repeated:
        ranks = {f"__rank{i}": running_count(F.col(f"__ok{i}")) for i in repeated}
        rows = settled(scan(rows, key, order, ranks, layout=layout), bool(layout.cells), "pattern")
        ahead = {f"__top{i}": running_max(F.col(f"__rank{i}")) for i in repeated}
        for name in breaks:
            i = name.removeprefix("__brk")
            ahead[f"__end{i}"] = latest(F.when(F.col(name), F.col(f"__rank{i}")))
        rows = scan(rows, key, order, ahead, reverse=True, inclusive=False, layout=layout)
        known = {i: [F.col(f"__end{i}")] if f"__brk{i}" in breaks else [] for i in repeated}
        rows = rows.withColumns({f"__top{i}": F.coalesce(*known[i], f"__top{i}", f"__rank{i}") for i in repeated})
        rows = settled(rows, bool(layout.cells), "pattern")
    rows = rows.withColumn("ev", F.struct(*dict.fromkeys([*order, *keep])))
    found = {}
    for i, s in enumerate(pattern.stages[1:], start=1):
        here = _step(i, s, F.col(f"__ok{i}"))
        found[f"__next{i}"] = here if s.link == "next" else F.when(F.col(f"__ok{i}"), here)
    if found:
        rows = next_row(rows, key, order, found, layout)
    return settled(rows, several_uses and (settle or layout.large), "pattern")


def _step(i: int, stage: Stage, hit: Column) -> Column:
    extra = [F.col(f"__rank{i}").alias("rank"), F.col(f"__top{i}").alias("top")] if stage.repeated else []
    return F.struct(F.col("ev"), hit.alias("hit"), *extra)


def _ranks_before(partials: DataFrame, events: DataFrame, key, t: str, i: int, limit: Column, layout) -> DataFrame:
    """Add ``__reach``: the rank of the last row of stage ``i`` that lies before ``limit``.

    Starts of the first stage are no more than the rows of their key, so small keys stay whole.
    """
    probes = partials.withColumns({"__at": _micros(limit), "__kind": F.lit(0)})
    marks = events.where(F.col(f"__ok{i}")).select(
        *key, _micros(F.col(t)).alias("__at"), F.lit(1).alias("__kind"), F.col(f"__rank{i}").alias("__mark")
    )
    both = probes.unionByName(marks, allowMissingColumns=True)
    layout = WHOLE_KEYS if i == 0 and not layout.cells else None
    reached = scan(both, key, ["__at", "__kind"], {"__reach": running_max(F.col("__mark"))}, layout=layout)
    return reached.where(F.col("__kind") == 0).drop("__at", "__kind", "__mark")


def _relevant(stages) -> Column:
    """Rows that some stage takes or that end a repetition; no others matter to relaxed patterns."""
    conds = [c for s in stages for c in (s.cond, s.stop) if c is not None]
    return reduce(lambda a, b: a | b, conds)


def match(
    df: DataFrame, pattern: Pattern, key: Sequence[str], order: Sequence[str], keep: Sequence[str] = (),
    t: str | None = None, layout: Layout | None = None, settle: bool = True,
) -> Matches:
    """All matches of ``pattern`` in each key's rows taken in ``order``.

    ``order`` is a total order: event time with an id, or an arrival number. ``t`` (by default the
    first order column) is what ``within`` measures. Rows without a key or an order take no part. ``keep`` names further columns to carry into the
    event structs. ``key=[]`` matches over the whole input as one sequence. A pattern that uses its events
    several times writes them to the shared folder once, so that the input is read once; ``settle=False`` leaves
    that out where the input is small and already written, as in a micro-batch.
    """
    pattern.check()
    key, order, keep = list(key), list(order), list(keep)
    t = t or order[0]
    if t not in order and t not in keep:
        keep = [t, *keep]
    stages = pattern.stages
    for name in [*key, *order]:
        df = df.where(F.col(name).isNotNull())
    if all(s.link != "next" and not s.strict for s in stages):
        df = df.where(_relevant(stages))
    if layout is None:
        ordered = len(stages) > 1 or stages[0].repeated
        layout = measure_cells(df, key, order) if ordered else WHOLE_KEYS
    events = _prepared(df, pattern, key, order, keep, layout, settle)
    limit = pattern.within_us
    nexts = [f"__next{i}" for i in range(1, len(stages))]

    def in_time(ev: str) -> Column:
        if limit is None:
            return F.lit(True)
        return _micros(F.col(f"{ev}.{t}")) - _micros(F.col("__t0")) < limit

    chain = all(not s.repeated for s in stages)
    expired: list[DataFrame] = []
    starts = events.where(F.col("__ok0")).withColumns({"__t0": F.col(t), "__f": _step(0, stages[0], F.lit(True))})
    partial = starts.select(*key, "__t0", "__f", *nexts)
    for i, s in enumerate(stages):
        done = [f"__m{j}" for j in range(i)]
        if i:
            nxt = F.col(f"__next{i}")
            if chain and limit is not None:
                late = nxt.isNull() | ~in_time(f"__next{i}.ev")
                expired.append(partial.where(late).select(*key, "__t0", *done))
            hit = nxt.isNotNull() & F.col(f"__next{i}.hit") & in_time(f"__next{i}.ev")
            partial = partial.where(hit).select(*key, "__t0", *done, nxt.alias("__f"))
        if not s.repeated:
            partial = partial.withColumn(f"__m{i}", F.struct("__f.ev", F.col("__f.ev").alias("last"), F.lit(1).cast("long").alias("n")))
            if 0 < i < len(stages) - 1:
                place = {f"__at_{o}": F.col(f"__m{i}.ev.{o}") for o in order}
                here = events.select(*key, *[F.col(o).alias(f"__at_{o}") for o in order], *nexts)
                partial = partial.withColumns(place).join(here, [*key, *place])
            partial = partial.select(*key, "__t0", *done, f"__m{i}", *[c for c in nexts if c in partial.columns])
        else:
            partial = _repeat(partial, events, s, i, key, t, limit, done, nexts, layout)
            if limit is not None:
                partial = partial.where(in_time(f"__m{i}.last"))
    rows = partial.withColumn(
        "match_id", F.concat_ws("-", *[c for i in range(len(stages)) for c in _id_parts(stages[i], i, order)])
    )
    named = [c for i, s in enumerate(stages) for c in _stage_columns(s, i)]
    rows = rows.select(*key, "match_id", *named, *[f"__m{i}" for i in range(len(stages))])
    timeouts = None
    if chain and limit is not None and len(stages) > 1:
        for i, part in enumerate(expired, start=1):
            cols = [c for j in range(i) for c in _stage_columns(stages[j], j)]
            part = part.select(*key, *cols)
            timeouts = part if timeouts is None else timeouts.unionByName(part, allowMissingColumns=True)
    return Matches(rows, timeouts, events, tuple(key), pattern)


def _id_parts(s: Stage, i: int, order) -> list[Column]:
    """What tells a stage's events apart within a key: their order values, or their ranks."""
    if s.combine:
        return [F.concat_ws(".", F.transform(f"__m{i}.ranks", lambda r: r.cast("string")))]
    ends = ("ev", "last") if s.repeated else ("ev",)
    return [F.col(f"__m{i}.{end}.{o}").cast("string") for end in ends for o in order]


def _stage_columns(s: Stage, i: int) -> list[Column]:
    return [
        F.col(f"__m{i}.ev").alias(f"{s.name}_first"),
        F.col(f"__m{i}.last").alias(f"{s.name}_last"),
        F.col(f"__m{i}.n").alias(f"{s.name}_n"),
    ]


def _repeat(partial, events, s: Stage, i: int, key, t: str, limit: int | None, done, nexts, layout) -> DataFrame:
    """Partial matches standing on the first row of a repetition -> one row per way to end it."""
    first, top = F.col("__f.rank"), F.col("__f.top")
    base = partial.select(*key, "__t0", *done, "__f")
    if limit is not None and (s.most is None or s.combine):
        end = F.timestamp_micros(_micros(F.col("__t0")) + limit)
        base = _ranks_before(base, events, key, t, i, end, layout)
        top = F.least(top, F.col("__reach"))
    if s.combine:
        base = base.withColumns({"__top": top, "__ranks": F.array(first)})
        sized = [base]
        for _ in range(1, s.most):
            more = sized[-1].where(F.element_at("__ranks", -1) < F.col("__top"))
            step = F.explode(F.sequence(F.element_at("__ranks", -1) + 1, F.col("__top")))
            more = more.withColumn("__r", step).withColumn("__ranks", F.concat("__ranks", F.array("__r"))).drop("__r")
            sized.append(more)
        grown = sized[s.least - 1]
        for more in sized[s.least:]:
            grown = grown.unionByName(more)
        grown = grown.withColumn("__end", F.element_at("__ranks", -1))
    else:
        low = first + (s.least - 1)
        high = top if s.most is None else F.least(top, first + (s.most - 1))
        grown = base.where(low <= high).withColumn("__end", F.explode(F.sequence(low, high)))
    pool = events.where(F.col(f"__ok{i}")).select(
        *key, F.col(f"__rank{i}").alias("__end"), F.col("ev").alias("__last"), *nexts[i:]
    )
    joined = grown.join(pool, [*key, "__end"])
    if s.combine:
        picked = [F.size("__ranks").cast("long").alias("n"), F.col("__ranks").alias("ranks")]
    else:
        picked = [(F.col("__end") - first + 1).alias("n"), first.alias("from"), F.col("__end").alias("to")]
    stage = F.struct(F.col("__f.ev").alias("ev"), F.col("__last").alias("last"), *picked)
    return joined.select(*key, "__t0", *done, stage.alias(f"__m{i}"), *nexts[i:])
