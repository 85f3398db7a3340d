"""Main text of web pages by consensus of their host.

Every page scores its containers: the share of the page's good text (outside menus, notices and other
furniture) that a container holds, and how deep it lies. It votes for its best one, with that score. In
Spark, the votes are summed by host and generalised path (tags and classes, digits left out); the path with
the most votes wins, and every page of the host is extracted again from the containers at that path. A page
without them uses its own best container. Either is extended outwards while that adds good text of the article.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.store import Spool

# What tags are, by name.
#: The text of raw elements runs to their end tag or, as HTML has it, to the page's end.
_RAW = frozenset("script style textarea iframe title".split())
#: Left out with what they hold, but only up to an end tag of their own.
_SKIPPED = frozenset("noscript template svg".split())
_CONTAINERS = frozenset(
    "html body main article section div nav header footer aside form table tbody thead tfoot ul ol dl "
    "fieldset figure dialog details menu center select button head".split()
)
_BLOCKS = _CONTAINERS | frozenset(
    "p h1 h2 h3 h4 h5 h6 li dt dd tr td th blockquote pre address figcaption caption hr summary legend option".split()
)
#: Their classes say what a page has ("has-sidebar"), not what they are.
_FRAMES = frozenset("html body main".split())
_FURNITURE_TAGS = frozenset("nav header footer aside dialog menu select button head".split())
_FURNITURE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar "
    "navigation menu breadcrumb breadcrumbs sidebar side header masthead footer foot cookie cookies consent "
    "notice notices alert popup modal overlay newsletter subscribe subscription signup login social share "
    "sharing related recommended recommendations pagination pager comment comments reply replies responses disqus "
    "widget toolbar copyright disclaimer gdpr skip".split()
)
_FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements and classes that say where the article is.
_ARTICLE_TAGS = frozenset("article main".split())
_ARTICLE_WORDS = frozenset("article main content post entry story text".split())

_NAME = re.compile(r"[a-z][a-z0-9:-]*", re.I)
_STOP = re.compile("[>=]")
_WHITE = re.compile(r"\s*")
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*>|</{tag}\Z", re.I) for tag in _RAW}
#: What may stand beside a word of furniture in one class name: "share-buttons" is furniture, "image-share" is not.
_NEUTRAL_WORDS = frozenset(
    "area bar block body bottom box btn button buttons center col column container content fixed global group holder "
    "icon icons inner item items left link links list main nav news outer page panel pane posts primary region right "
    "row secondary section site sticky text title top unit wrap wrapper module slot zone form fields list"
    .split()
)
#: Nothing is tried twice, so a tag of any length is read in one pass.
_ATTR = re.compile(r"(?<![a-z-])([a-z-]++)\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++))|\b(hidden)\b", re.I)
#: Containers that are nested deeper count as the one at this depth, as in browsers.
DEEPEST = 512
#: Inline elements that may hide their text, and the attributes that may say so.
_INLINE = frozenset("span a b i em strong small u s sub sup abbr label code mark font big cite q".split())
_MAY_HIDE = re.compile(r"hidden|display|role", re.I)
#: A container is a candidate from this share of the good text on; a level deeper is worth so much.
SHARE, LEVEL = 0.5, 0.05


class _Container:
    __slots__ = ("article", "depth", "doubt", "furniture", "good", "headings", "heads", "named", "own", "parent", "path", "said", "seen", "tag")

    def __init__(
        self, tag: str, path: str, parent: _Container | None, furniture: bool, doubtful: bool = False, named: bool = False
    ):
        self.tag, self.path, self.parent, self.furniture = tag, path, parent, furniture
        # the nearest one, from here outwards, that may be furniture; that is an article; that is named like one
        self.doubt = self if doubtful else parent.doubt if parent else None
        self.article = self if tag in _ARTICLE_TAGS else parent.article if parent else None
        self.named = self if named else parent.named if parent else None
        # of its good blocks with few links: characters, headings, h1, and how many have no container between
        self.said = self.headings = self.heads = self.own = 0
        self.depth = parent.depth + 1 if parent else 0
        self.good = 0
        self.seen = False


def _attributes(said: str) -> dict[str, str]:
    found = {}
    for name, double, single, bare, hidden in _ATTR.findall(said):
        found.setdefault((name or hidden).lower(), html.unescape(double or single or bare))
    return found


def _furniture(tag: str, attrs: dict[str, str]) -> bool:
    """Whether an element is furniture or hidden, whatever it holds."""
    if tag in _FURNITURE_TAGS or "hidden" in attrs or attrs.get("role", "").lower() in _FURNITURE_ROLES:
        return True
    return bool(re.search(r"display\s*:\s*none", attrs.get("style", ""), re.I)) or attrs.get("aria-hidden") == "true"


def _class_names(attrs: dict[str, str]) -> list[list[str]]:
    """The words of each class and of the id."""
    names = f"{attrs.get('class', '')} {attrs.get('id', '')}".split()
    return [re.findall("[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", name).lower()) for name in names]


def _furniture_name(words: list[str]) -> bool:
    """Whether a class name says furniture: by one of its words, where the others say no other thing."""
    said = [w for w in words if len(w) > 1 or w not in "abcdefghijklmnopqrstuvwxyz"]
    named = [w in _FURNITURE_WORDS for w in said]
    return any(named) and all(n or w in _NEUTRAL_WORDS for n, w in zip(named, said, strict=True))


def _doubtful(tag: str, attrs: dict[str, str], names: list[list[str]]) -> bool:
    """Whether an element looks like furniture, unless it holds the page."""
    if tag == "form" or attrs.get("role", "").lower() == "form":
        return True
    return tag not in _FRAMES and any(map(_furniture_name, names))


class _Tag:
    """A tag, or with an empty name a comment, a raw element or a skipped one."""

    __slots__ = ("attrs", "closing", "end", "name", "start")

    def __init__(self, start: int, end: int, name: str = "", closing: bool = False, attrs: str = ""):
        self.start, self.end, self.name, self.closing, self.attrs = start, end, name, closing, attrs

    @property
    def empty(self) -> bool:
        return self.attrs.endswith("/")


def _tag_end(page: str, at: int) -> int:
    """Where the tag ends whose attributes begin at `at`, or -1.

    As in HTML, a quote opens a value only behind an equals sign; one that is never closed opens none.
    """
    while stop := _STOP.search(page, at):
        at = stop.end()
        if stop[0] == ">":
            return at
        at = _WHITE.match(page, at).end()
        quote = page[at : at + 1]
        if quote in ("'", '"'):
            closed = page.find(quote, at + 1)
            at = closed + 1 if closed >= 0 else at + 1
    return -1


def _next(page: str, at: int, svg: bool) -> _Tag | None:
    """The first tag, comment or raw element from `at` on.

    Each character is passed once: what is never closed runs to the page's end.
    """
    size = len(page)
    while (start := page.find("<", at)) >= 0:
        after = page[start + 1 : start + 2]
        closing = after == "/"
        name = _NAME.match(page, start + 1 + closing)
        if name:
            end = _tag_end(page, name.end())
            if end < 0:
                return _Tag(start, size)
            tag, attrs = name[0].lower(), page[name.end() : end - 1]
            # inside svg a slash closes raw elements too
            if tag in _RAW and not closing and not (svg and attrs.endswith("/")):
                over = _RAW_END[tag].search(page, end)
                return _Tag(start, over.end() if over else size)
            return _Tag(start, end, tag, closing, attrs)
        if page.startswith("<!--", start):
            first = ">" if page[start + 4 : start + 5] == ">" else "->" if page.startswith("->", start + 4) else "-->"
        elif page.startswith("<![CDATA[", start):
            first = "]]>"
        elif after and after in "!?/":
            first = ">"
        else:
            at = start + 1
            continue
        over = page.find(first, start + (4 if page.startswith("<!--", start) else 2))
        return _Tag(start, over + len(first) if over >= 0 else size)
    return None


def _tokens(page: str) -> list[_Tag]:
    """The tags, comments and raw elements of a page, without those inside skipped elements."""
    found: list[_Tag] = []
    opened: dict[str, list[int]] = {tag: [] for tag in _SKIPPED}
    cuts: list[tuple[int, int]] = []
    foreign, token = 0, _next(page, 0, False)
    while token:
        tag = token.name
        if tag in _SKIPPED:
            if token.closing:
                if opened[tag]:
                    cuts.append((opened[tag].pop(), len(found)))
            elif not token.empty:
                opened[tag].append(len(found))
        elif tag == "foreignobject" and opened["svg"]:
            foreign = max(0, foreign + (-1 if token.closing else not token.empty))
        elif tag in _BLOCKS and opened["svg"] and not foreign:
            opened["svg"] = []  # as in HTML, a block ends an svg that was left open
        foreign = foreign if opened["svg"] else 0
        found.append(token)
        token = _next(page, token.end, bool(opened["svg"]))
    if not cuts:
        return found
    kept, at = [], 0
    for first, last in sorted(cuts):
        if first >= at:
            kept += [*found[at:first], _Tag(found[first].start, found[last].end)]
            at = last + 1
    return kept + found[at:]


_Block = tuple[_Container, str, int, str]


def blocks(page: str) -> list[_Block]:
    """(container, text, characters in links, tag or "") of each block of a page, in order."""
    top = here = _Container("", "", None, False)
    found: list[_Block] = []
    parts: list[str] = []
    linked, in_link, block = 0, False, ""
    # blocks that are furniture by themselves, such as a paragraph of class "notice"
    hidden = ""
    # an inline element that is not shown, and how many of its name are open in it
    unseen, inner = "", 0
    # open containers by tag, and how many are too deep to count
    open_tags: Counter = Counter()
    deep = 0

    def close() -> None:
        nonlocal parts, linked
        said = " ".join("".join(parts).split())
        if said and not hidden:
            found.append((here, said, linked, block))
        parts, linked = [], 0

    def text(said: str) -> None:
        nonlocal linked
        if unseen:
            return
        said = html.unescape(said)
        parts.append(said)
        linked += len(said) if in_link else 0

    at = 0
    for token in _tokens(page):
        if token.start > at:
            text(page[at : token.start])
        at = token.end
        tag = token.name
        if not tag:
            continue
        if tag == "a":
            in_link = not token.closing
        elif tag == "br":
            parts.append(" ")
        if tag not in _BLOCKS:
            if unseen == tag:
                inner += -1 if token.closing else not token.empty
                unseen = tag if inner else ""
            elif not unseen and not token.closing and tag in _INLINE and _MAY_HIDE.search(token.attrs):
                if not token.empty and _furniture(tag, _attributes(token.attrs)):
                    unseen, inner = tag, 1
            continue
        close()
        unseen = ""  # a block ends what was left open
        block = "" if token.closing or tag in _CONTAINERS else tag
        if tag in _CONTAINERS:
            hidden = ""
            if not token.closing:
                if token.empty:
                    continue
                if here.depth >= DEEPEST:
                    deep += 1
                    continue
                attrs = _attributes(token.attrs)
                classes = sorted(set(re.sub(r"\d+", "", attrs.get("class", "")).lower().split()))
                path = f"{here.path}>{'.'.join([tag, *classes])}"
                names = _class_names(attrs)
                named = tag in _ARTICLE_TAGS or any(not _ARTICLE_WORDS.isdisjoint(words) for words in names)
                furniture = here.furniture or _furniture(tag, attrs)
                here = _Container(tag, path, here, furniture, _doubtful(tag, attrs, names), named)
                open_tags[tag] += 1
            elif deep:
                deep -= 1
            elif open_tags[tag]:
                while here.tag != tag:
                    open_tags[here.tag] -= 1
                    here = here.parent
                open_tags[tag] -= 1
                here = here.parent
        elif token.closing:
            hidden = "" if tag == hidden else hidden
        else:
            attrs = _attributes(token.attrs)
            hidden = tag if _furniture(tag, attrs) or _doubtful(tag, attrs, _class_names(attrs)) else ""
    if at < len(page):
        text(page[at:])
    close()
    return found


def _above(container: _Container) -> Iterator[_Container]:
    """A container and all around it, from the inside."""
    up: _Container | None = container
    while up:
        yield up
        up = up.parent


def _doubts(container: _Container) -> Iterator[_Container]:
    """The doubtful ones among a container and all around it, from the inside."""
    doubt = container.doubt
    while doubt:
        yield doubt
        doubt = doubt.parent.doubt if doubt.parent else None


def _good(found: list[_Block]) -> list[_Block]:
    """The blocks outside furniture.

    A doubtful container counts as furniture unless it wraps the page: it holds most of the text and, where the
    rest has an article, main or h1, or without one itself a container named like an article, it does not.
    """
    shown = [b for b in found if not b[0].furniture]
    held: dict[_Container, int] = {}
    # by nearest doubtful container: whether there is an h1, and the nearest articles and containers so named
    marks: dict[_Container | None, tuple[list[bool], set, set]] = {}
    for container, said, _, tag in shown:
        heads, articles, named = marks.setdefault(container.doubt, ([False], set(), set()))
        heads[0] |= tag == "h1"
        articles.add(container.article)
        named.add(container.named)
        for doubt in _doubts(container):
            held[doubt] = held.get(doubt, 0) + len(said)
    if not held:
        return shown
    total = sum(len(said) for _, said, _, _ in shown)
    clear: dict[_Container | None, bool] = {None: True}
    for doubt in sorted(held, key=lambda c: c.depth):
        outer = doubt.parent.doubt if doubt.parent else None
        clear[doubt] = False
        if clear[outer] and held[doubt] >= SHARE * total:
            around = {None, *_above(doubt)}
            heads, articles, _ = marks.get(doubt, ([False], set(), set()))
            inside = heads[0] or not articles <= around - {doubt}
            beside = [marks[d] for d in (*_doubts(doubt), None) if d is not doubt and d in marks]
            marked = any(heads[0] or not articles <= around for heads, articles, _ in beside)
            clear[doubt] = not marked and (inside or all(named <= around for _, _, named in beside))
    return [b for b in shown if clear[b[0].doubt]] or shown


def _scored(page: str) -> tuple[list[_Block], dict[_Container, float]]:
    """The good blocks of a page, and the score of each container that holds enough of them."""
    good = _good(blocks(page))
    for container, said, linked, tag in good:
        worth = max(0, len(said) - 2 * linked)
        container.good += worth
        if worth:
            container.own += 1
            container.said += len(said)
            container.headings += tag in _HEADINGS
            container.heads += tag == "h1"
    # from the deepest outwards, so that each container is added to the one around it once
    every = list(dict.fromkeys(up for container in dict.fromkeys(c for c, *_ in good) for up in _unseen(container)))
    for container in sorted(every, key=lambda c: -c.depth):
        around = container.parent
        if around:
            around.good += container.good
            around.said += container.said
            around.headings += container.headings
            around.heads += container.heads
    total = max((c.good for c in every if not c.parent), default=0)
    scores = {c: c.good / total + LEVEL * min(c.depth, 10) for c in every if total and c.good >= SHARE * total}
    return good, scores


def _unseen(container: _Container) -> Iterator[_Container]:
    """A container and all around it up to the first that was given before."""
    up: _Container | None = container
    while up and not up.seen:
        up.seen = True
        yield up
        up = up.parent


def _whole(container: _Container) -> _Container:
    """The outermost container that this one may be extended to, level by level, while good text comes in.

    An article or main takes in whatever it has; html and body only an h1 or blocks that lie directly in them;
    others a heading, a block of their own, or no more text than there was.
    """
    best = container
    for around in _above(container):
        more = around.said - best.said
        if not more:
            continue
        joined = around.own or around.heads > best.heads
        if around.tag in _BLOCKS and around.tag not in ("html", "body"):
            joined = joined or around.article is around or around.headings > best.headings or more <= best.said
        if not joined:
            break
        best = around
    return best


def _best(scores: dict[_Container, float]) -> tuple[_Container, float] | None:
    """A page's best container, extended to the whole article, and its score."""
    if not scores:
        return None
    best = max(scores, key=lambda c: (scores[c], c.path))
    return _whole(best), scores[best]


def best_path(page: str | None) -> tuple[str, float] | None:
    """The path of a page's best container and its score; nothing for a page without good text."""
    best = _best(_scored(page or "")[1])
    return best and (best[0].path, best[1])


def extract(page: str | None, path: str | None) -> str:
    """The good blocks in containers at `path`, extended to the whole article; without any, in the page's best."""
    good, scores = _scored(page or "")
    held = list(dict.fromkeys(c for c, *_ in good))
    roots = {up for c in held for up in _above(c) if path is not None and up.path == path}
    if not roots and (best := _best(scores)):
        roots = {best[0]}
    roots = {_whole(c) for c in roots}
    inside = {c for c in held if not roots or not roots.isdisjoint(_above(c))}
    return "\n".join(said for c, said, *_ in good if c in inside)


def _votes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        sums: dict[tuple[str, str], float] = {}
        for host, page in zip(batch["host"], batch["html"], strict=True):
            if best := best_path(page):
                path, score = best
                sums[host, path] = sums.get((host, path), 0.0) + score
        if sums:
            yield pd.DataFrame(
                {"host": [h for h, _ in sums], "path": [p for _, p in sums], "score": list(sums.values())}
            )


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, path): the path with the most votes of each host of `pages(host, html)`.

    Scores are rounded before they are summed, so the order of rows does not decide; ties go to the
    greater path.
    """
    return (
        pages.select("host", "html")
        .mapInPandas(_votes, "host string, path string, score double")
        .groupBy("host", "path")
        .agg(F.sum(F.round(F.col("score") * 1_000_000).cast("long")).alias("score"))
        .groupBy("host")
        .agg(F.max(F.struct("score", "path")).alias("best"))
        .select("host", F.col("best.path").alias("path"))
    )


def main_text(pages: DataFrame, source: str = "html", url: str = "url") -> DataFrame:
    """`doc` (the columns of `pages` as a struct) with `path` and `text`.

    Blocks are joined by a line feed, white space inside a block is one space, character references are
    decoded. A null page counts as empty and has an empty text; pages without a host share one vote. Repeated
    rows vote and are extracted alike; an empty table gives no rows. The winners are written, so pages of a
    very frequent host can be split over tasks in the join.
    """
    spool = Spool(pages.sparkSession, "pages")
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    rows = pages.select(F.struct(*pages.columns).alias("doc"), host.alias("host"), F.col(source).alias("html"))
    paths = spool.write(host_paths(rows))

    @F.pandas_udf("string")
    def extracted(sources: pd.Series, paths: pd.Series) -> pd.Series:
        return pd.Series([extract(x, p) for x, p in zip(sources, paths, strict=True)], dtype=object)

    return rows.join(paths, "host", "left").select("doc", "path", extracted("html", "path").alias("text"))
