"""Operator 1: main text of web pages by two passes of block rules."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkstream.llm.common import ready

OPENING = re.compile(r"<(?:(?P<comment>!--)|(?P<raw>!\[CDATA\[)|(?P<end>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)|[!?/])")
MARK = re.compile(r"[>\"']")
NUMBER = re.compile(r"&#(?:0*([0-9]+)|([xX])0*([0-9a-fA-F]+))")
ATTRIBUTE = re.compile(r"([a-zA-Z_:-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")

# Element names of HTML, by what they mean for a block.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)
DROPPED = frozenset(  # contents are no text of the page
    "script style noscript template iframe object svg math canvas audio video select option button textarea map head title".split()
)
RAW = frozenset("script style textarea title iframe noscript template".split())  # contents are not parsed
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CHROME = frozenset("nav header footer aside form menu dialog fieldset".split())  # around the article
MAIN = frozenset("article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

# Words in class, id and role names that say what a container is for.
CHROME_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs byline-share comment comments commentlist "
    "respond disqus cookie cookies consent gdpr copyright footer foot header masthead menu menubar nav navbar navigation "
    "newsletter subscribe signup login notice notices notification alert pager pagination popup modal overlay promo promoted promotion "
    "related recommended recommendations share sharing sharebar social sidebar side-bar sponsor sponsored sponsors skyscraper "
    "toolbar widget widgets sitemap skip complementary contentinfo search searchbox reply replies disclaimer paywall outbrain taboola".split()
)

# Parts of such names that say what is beside or around a container, or in which state it is.
AROUND_WORDS = frozenset("has no not with without fixed sticky open closed active visible enabled result results".split())

# Frequent words of the languages at hand.
STOP_WORDS = frozenset(
    "the of and to in a is that for it as was with on be by this are from or an which at not have but has they were will "
    "der die das und in zu den von mit ist des im für auf dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei "
    "de la le et les des en un du une que est pour qui dans par plus pas au sur ne se ce il sont avec ou elle "
    "el y los se del las por con no una su para al lo como más o pero sus le ha me si sin sobre este ya".split()
)
WORD = re.compile(r"\w+")


class Rules(NamedTuple):
    """Bounds of the first pass."""

    link_density: float = 0.4
    short: int = 70
    stop_high: float = 0.25
    #: A page is judged by stop words if so much of its running text has many of them.
    known: float = 0.25


class Block(NamedTuple):
    text: str
    zone: str  # main, chrome, named (chrome by a class or id) or page
    zone_id: int
    links: int  # characters inside links
    heading: bool


BAD, UNSURE, GOOD = 0, 1, 2


def _is_chrome(name: str, rest: str, parts: bool = True) -> str:
    """Why a container is none of the text: ``state`` if it is hidden or its role says so, ``name`` if a class or id does,
    or the first or last part of one if ``parts`` count; else an empty string."""
    why = ""
    for key, *values in ATTRIBUTE.findall(rest):
        key, value = key.lower(), "".join(values).lower()
        if key == "role":
            if CHROME_WORDS.intersection(value.split()):
                return "state"
        elif key in ("class", "id"):
            for token in value.split():
                pieces = [x for x in re.split(r"[-_]+", token) if x]
                if token in CHROME_WORDS:
                    why = "name"
                elif parts and pieces and not AROUND_WORDS.intersection(pieces) and (pieces[0] in CHROME_WORDS or pieces[-1] in CHROME_WORDS):
                    why = "name"
        elif key == "hidden" or (key == "aria-hidden" and value == "true"):
            return "state"
        elif key == "style" and "display:none" in value.replace(" ", ""):
            return "state"
    return why


class Tag(NamedTuple):
    """Markup from ``start`` to ``end``; comments and declarations have no name. ``raw`` is text that stands as it is."""

    start: int
    end: int
    name: str | None = None
    closing: bool = False
    rest: str = ""
    raw: str | None = None


class Tags:
    """The markup of a page from any place on, in time that follows the length of the page, whatever is in it.

    A quoted attribute may hold ``>``. A quote that is never closed is a mark like any other. A tag whose ``>`` all lie in
    quotes ends at the first of them, and so does every tag behind it. Without any ``>`` behind it, ``<`` is text.
    """

    def __init__(self, page: str) -> None:
        self.page, self.unclosed, self.plain = page, set(), False

    def next(self, at: int) -> Tag | None:
        page = self.page
        found = OPENING.search(page, at)
        if not found:
            return None
        start, inside = found.span()
        if found["comment"]:
            end = page.find("-->", inside)
            return Tag(start, end + 3 if end >= 0 else len(page))
        if found["raw"]:
            end = page.find("]]>", inside)
            return Tag(start, end + 3 if end >= 0 else len(page), raw=page[inside : end if end >= 0 else len(page)])
        if not found["name"]:
            end = page.find(">", inside)
            return Tag(start, end + 1 if end >= 0 else len(page))
        end = self._end(inside)
        return Tag(start, end + 1, found["name"].lower(), bool(found["end"]), page[inside:end]) if end >= 0 else None

    def _end(self, at: int) -> int:
        """Where the ``>`` of a tag is, or -1."""
        first = self.page.find(">", at)
        if first < 0 or self.plain:
            return first
        if not self.page.count("'", at, first) and self.page.count('"', at, first) % 2 == 0:
            return first
        while mark := MARK.search(self.page, at):
            at = mark.end()
            if mark[0] == ">":
                return mark.start()
            if mark[0] not in self.unclosed:
                close = self.page.find(mark[0], at)
                if close < 0:
                    self.unclosed.add(mark[0])
                else:
                    at = close + 1
        self.plain = True
        return first


def unescaped(text: str) -> str:
    """Character references decoded; numbers beyond any character, of any length, give the replacement character."""

    def short(found: re.Match) -> str:
        digits = found[1] or found[3]
        return f"&#{found[2] or ''}{digits if len(digits) < 10 else '9999999'}"

    return html.unescape(NUMBER.sub(short, text) if "&#" in text else text)


def blocks_of(page: str, parts_count: bool = True) -> list[Block]:
    """The text blocks of a page in order. A block ends at any tag that is not inline; white space inside is one space.

    A main element is never chrome by its own name or that of a container, nor is an article that lies in no other. An
    article inside a container that is chrome by its name has a zone below zero: it is the text if the page has no other.
    ``parts_count`` says whether parts of class and id names make a container chrome."""
    out: list[Block] = []
    # open containers: (name, zone, zone id, inside main)
    stack: list[tuple[str, str, int]] = [("", "page", 0)]
    parts: list[str] = []
    links, in_link, heading, zones, at, size = 0, 0, False, 0, 0, len(page)
    tags, opened = Tags(page), Counter()

    def close() -> None:
        nonlocal parts, links, heading
        if parts:
            text = " ".join(unescaped("".join(parts)).split())
            if text:
                _, zone, zone_id = stack[-1]
                if zone == "lead":  # of a header inside the article only the headings belong to it
                    zone = "main" if heading else "chrome"
                out.append(Block(text, zone, zone_id, min(links, len(text)), heading))
        parts, links = [], 0

    while at < size:
        tag = tags.next(at)
        text = page[at : tag.start if tag else size]
        if text:
            parts.append(text)
            if in_link:
                links += len(" ".join(text.split()))
        if not tag:
            break
        at, name = tag.end, tag.name
        if tag.raw is not None:
            parts.append(html.escape(tag.raw))
            continue
        if name is None:
            continue
        if name in HEADINGS and not tag.closing:
            close()
            heading = True
            continue
        if name in INLINE:
            if name == "a":
                in_link = 0 if tag.closing else 1
            continue
        close()
        heading = False
        if tag.closing:
            while opened[name]:
                last = stack.pop()[0]
                opened[last] -= 1
                if last == name:
                    break
            continue
        if name in VOID:
            continue
        rest = tag.rest
        if name in RAW:
            found = re.compile(rf"</{name}\s*>", re.IGNORECASE).search(page, at)
            at = found.end() if found else size
            continue
        if rest.endswith("/") and name in DROPPED:
            continue
        _, zone, zone_id = stack[-1]
        depth = len(stack)
        if name == "body":
            stack, opened = [("", "page", 0)], Counter()
        elif name in DROPPED:
            zones += 1
            stack.append((name, "dropped", zones))
        elif zone == "dropped":
            stack.append((name, zone, zone_id))
        elif name != "html" and (why := _is_chrome(name, rest, parts_count)) and not (
            why == "name" and (name == "main" or (name == "article" and not opened["article"]))
        ):
            zones += 1
            stack.append((name, "chrome" if why == "state" or zone == "chrome" else "named", zones))
        elif name == "header" and zone == "main":
            stack.append((name, "lead", zone_id))
        elif name in CHROME:
            zones += 1
            stack.append((name, "soft" if name in ("form", "header") and zone not in ("chrome", "named") else "chrome", zones))
        elif name in MAIN and zone in ("page", "soft", "main", "named"):
            if zone == "main":
                stack.append((name, zone, zone_id))
            elif zone == "named" and any(opened[x] for x in MAIN):  # a comment, or what else is named inside the text
                stack.append((name, zone, zone_id))
            else:
                zones += 1
                stack.append((name, "main", -zones if zone == "named" and name == "article" else zones))
        elif name not in ("p", "li", "dt", "dd", "tr", "td", "th", "html"):
            stack.append((name, zone, zone_id))
        if len(stack) > depth:
            opened[name] += 1
    close()
    return [b for b in out if b.zone != "dropped"]


def _stops(block: Block) -> float:
    words = WORD.findall(block.text.lower())
    return sum(w in STOP_WORDS for w in words) / max(1, len(words))


def first_pass(block: Block, rules: Rules, known: bool = True) -> int:
    """What a block's own figures say: containers around the article and link lists are out, running text with enough
    stop words is in, the rest is unsure, also long text without any stop word (code, tables of figures, lists of
    names). On a page in no ``known`` language length and links alone decide, and all running text is in."""
    if block.zone in ("chrome", "named", "soft"):
        return BAD
    length = len(block.text)
    dense = block.links / length
    if length >= rules.short:
        if dense > rules.link_density:
            return BAD
        stops = _stops(block)
        if stops >= rules.stop_high or not known:
            return GOOD
        return UNSURE
    if dense > rules.link_density and block.zone != "main":
        return BAD
    return UNSURE


def labels_of(blocks: list[Block], rules: Rules) -> list[int]:
    """The first pass over a page. Its language is known if enough of its running text has many stop words."""
    labels = [first_pass(b, rules) for b in blocks]
    long = [
        (len(b.text), label == GOOD)
        for b, label in zip(blocks, labels)
        if b.zone in ("page", "main") and len(b.text) >= rules.short and b.links <= rules.link_density * len(b.text)
    ]
    if sum(n for n, good in long if good) >= rules.known * sum(n for n, _ in long):
        return labels
    return [first_pass(b, rules, False) for b in blocks]


def second_pass(blocks: list[Block], labels: list[int]) -> list[bool]:
    """Unsure blocks take the label of the nearest decided blocks before and after them in the same container; where
    these differ the nearer one counts, at equal distance the good one. Without a decided block a container is kept if
    it is the article, or the page itself."""
    keep = [label == GOOD for label in labels]
    n = len(blocks)
    before: list[tuple[int, int] | None] = [None] * n
    after: list[tuple[int, int] | None] = [None] * n
    for order, near in ((range(n), before), (range(n - 1, -1, -1), after)):
        last: dict[int, tuple[int, int]] = {}
        for i in order:
            zone = blocks[i].zone_id
            if labels[i] == UNSURE:
                near[i] = last.get(zone)
            else:
                last[zone] = (i, labels[i])
    for i in range(n):
        if labels[i] == UNSURE:
            a, b = before[i], after[i]
            if a and b and a[1] != b[1]:
                keep[i] = (a if i - a[0] < b[0] - i else b)[1] == GOOD if i - a[0] != b[0] - i else True
            elif a or b:
                keep[i] = (a or b)[1] == GOOD
            else:
                keep[i] = blocks[i].zone in ("main", "page")
    return keep


def main_text(page: str | None, rules: Rules = Rules()) -> str:
    """The main text: kept blocks in page order with one space between. Null and empty pages give an empty text."""
    blocks = blocks_of(page or "")
    kept = _kept(blocks, rules)
    lost = any(b.zone == "named" and len(b.text) >= rules.short for b in blocks)
    if lost and not any(b.zone == "main" or len(b.text) >= rules.short for b in kept):  # then parts of names are no ground to drop running text
        kept = _kept(blocks_of(page or "", False), rules) or kept
    return " ".join(b.text for b in kept)


def _kept(blocks: list[Block], rules: Rules) -> list[Block]:
    article = [b for b in blocks if b.zone == "main"]  # a page that names its article has the rest around it
    blocks = [b for b in article if b.zone_id > 0] or article or blocks
    keep = second_pass(blocks, labels_of(blocks, rules))
    return [b for b, k in zip(blocks, keep) if k]


def extract(pages: DataFrame, keep: list[str], markup: str = "html", rules: Rules = Rules()) -> DataFrame:
    """Each row's ``keep`` columns with ``text``, its main text, and ``n_chars``, the length in code points.

    No shuffle; pages are parsed whole and alone. Null, empty and textless pages give an empty text and 0. Repeated rows
    give repeated rows; columns that are not kept are not read.
    """
    names = [f"keep_{i}" for i in range(len(keep))]
    rows = pages.select(*[F.col(c).alias(n) for c, n in zip(keep, names)], F.col(markup).cast("string").alias("markup"))
    fields = ", ".join(f"{n} {t}" for n, t in rows.dtypes if n != "markup")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(value.as_py(), rules) for value in batch.column(len(names))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(names)], pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                names=[*names, "text", "n_chars"],
            )

    ready(pages.sparkSession)
    out = rows.mapInArrow(run, f"{fields}, text string, n_chars bigint" if fields else "text string, n_chars bigint")
    return out.select(*[F.col(n).alias(c) for c, n in zip(keep, names)], "text", "n_chars")
