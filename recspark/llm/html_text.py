"""Main text of web pages by consensus of their host: score, vote, extract.

Each page's containers (blocks that hold other blocks) get a score: the length of prose inside,
less by `DECAY` for each container between, and half the length of link text against it; parts
that name themselves boilerplate do not count. Where `article` and `main` hold half of a page's
prose, only these and what is around them are candidates, by prose alone. A page votes
for the path of its best container: tags with their classes from the root, digits
generalised. Votes are counted per host in Spark, and the path with most votes wins (of
equal ones that with more prose, then the alphabetically first). Pages are then read
again: the topmost containers on the winning path give the text, where they hold at least half
of the prose that the page's own best one has; else that one does.

Text: character references are decoded, white space inside a block becomes one space, blocks are
trimmed and joined by one space in page order; a line break is white space. Left out: comments,
scripts, styles, form controls, head, and parts inside the container whose tag, role, class
or id says menu, header, footer, sidebar, notice, advert or reader comments (`_TAGS`, `_NAMES`).
Nothing is left out for its length, and no text is cut.

Defined cases: null or empty html gives an empty text, so does a page without prose; a null url
or one without a host does not vote and uses its own best container; end tags without a start
are skipped, open elements end with the page or their parent; repeated rows are read alike; input
columns named like the new ones are replaced, others are kept.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from ..operators.skew import attach
from ..storage import materialize
from .url_filter import host_and_path

# Tags of HTML by their role.
_BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead tr ul br".split()
)
_IN_HEAD = frozenset("base link meta title script style noscript template".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template svg math".split())
_CONTAINERS = frozenset("article blockquote body center div dl fieldset html main ol section table tbody td ul".split())
_CLOSE_P = _BLOCKS - {"br", "html", "body", "td", "th", "tr", "tbody", "thead", "tfoot"}
_SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
_MARKED = frozenset(("article", "main"))
# a container's score reaches the one around it by this share; what link text costs
DECAY, LINK_COST = 0.9, 0.5
# What names boilerplate.
_TAGS = frozenset("nav header footer aside form button select option input label menu dialog head".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar alert dialog toolbar".split())
_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments commentlist "
    "cookie cookies consent disqus footer gdpr header masthead menu menus modal nav navbar navigation newsletter notice "
    "notices notification pager pagination popup popups promo promoted promotion related replies respond share sharing "
    "sidebar sidebars signup social sponsor sponsored subscribe toolbar".split()
)
# a comment, a declaration, or a tag with its attributes, where quotes count behind "=" only
_TAG = re.compile(
    r"""<(?:!--(?:-?>|.*?(?:--!?>|\Z))|\?[^>]*(?:>|\Z)|[!/](?=[^a-zA-Z])[^>]*(?:>|\Z)|!(?=[a-zA-Z])[^>]*(?:>|\Z)"""
    r"""|(/?)([a-zA-Z][^\s/>]*)((?:=\s*(?:"[^"]*"|'[^']*')|[^>])*+)(?:>|\Z))""",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s\"'>]+))")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_DIGITS = re.compile(r"[0-9a-f]*[0-9][0-9a-f]*")


@dataclass(slots=True)
class Element:
    tag: str
    parent: int
    step: str
    dull: bool
    linked: bool
    prose: int = 0
    score: float = 0.0
    end: int = 0


@dataclass
class Page:
    """Elements in page order, and runs (element, text) between tags; None is a block's edge."""

    apart: bool = False
    elements: list[Element] = field(default_factory=list)
    runs: list[tuple[int, str | None]] = field(default_factory=list)


@lru_cache(4096)
def _described(tag: str, rest: str) -> tuple[str, bool]:
    """The tag's step in a path, and whether it names itself boilerplate."""
    attributes = {k.lower(): html.unescape(a or b or c) for k, a, b, c in reversed(_ATTRIBUTE.findall(rest))}
    classes = {_DIGITS.sub("#", c.lower()) for c in attributes.get("class", "").split()}
    dull = tag in _TAGS
    if not dull and tag not in ("html", "body", "main", "article"):
        dull = attributes.get("role", "").lower() in _ROLES
    if not dull and tag not in ("html", "body"):
        names = _WORDS.findall(f"{attributes.get('class', '')} {attributes.get('id', '')}")
        own = {"comment", "comments", "notice", "related", "promo"} if tag in ("main", "article") else _NAMES
        dull = any(n.lower() in own for n in names)
    return ".".join([tag, *sorted(classes)]).replace(">", "#"), dull


def parse(source: str) -> Page:
    page = Page()
    elements, runs, stack = page.elements, page.runs, []

    def close(depth: int) -> None:
        while len(stack) > depth:
            number = stack.pop()
            elements[number].end = len(elements)
            if elements[number].tag in _BLOCKS:
                runs.append((number, None))

    def leave_head() -> None:
        if elements[stack[-1]].tag == "head":
            close(len(stack) - 1)

    def text(value: str) -> None:
        if value:
            if elements[stack[-1]].tag == "head" and value.strip():
                leave_head()
            runs.append((stack[-1], value))

    def opened(tag: str, rest: str) -> None:
        if tag in _SIBLINGS or tag in _CLOSE_P:
            ends, within = _SIBLINGS.get(tag, (frozenset(), frozenset()))
            for depth in range(len(stack) - 1, -1, -1):
                name = elements[stack[depth]].tag
                if name in ends:
                    close(depth)
                elif name == "p" and tag in _CLOSE_P:
                    close(depth)
                elif name in within or name in _CONTAINERS or name == "html":
                    break
        above = stack[-1] if stack else -1
        step, dull = _described(tag, rest)
        linked = tag == "a" or (above >= 0 and elements[above].linked)
        elements.append(Element(tag, above, step, dull, linked))
        number = len(elements) - 1
        if tag in _BLOCKS:
            runs.append((number, None))
        if tag in _VOID:
            elements[number].end = len(elements)
        else:
            stack.append(number)

    opened("html", "")
    at = 0
    while True:
        found = _TAG.search(source, at)
        if not found:
            text(source[at:])
            break
        text(source[at : found.start()])
        at = found.end()
        slash, tag, rest = found.groups()
        if not tag:
            continue
        tag = tag.lower()
        if slash:
            for depth in range(len(stack) - 1, 0, -1):
                if elements[stack[depth]].tag == tag:
                    close(depth)
                    break
            else:
                if tag == "p":
                    runs.append((stack[-1], None))
            continue
        if tag not in _IN_HEAD:
            leave_head()
        if tag in _RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(source, at)
            at = end.end() if end else len(source)
        elif tag == "html":
            continue
        else:
            opened(tag, rest)
    close(0)
    _score(page)
    return page


def _score(page: Page) -> None:
    """Give each element the length of prose inside, and the score."""
    elements = page.elements
    hidden: list[bool] = []
    marked: list[bool] = []
    for element in elements:
        above = element.parent
        hidden.append(element.dull or (above >= 0 and hidden[above]))
        marked.append(element.tag in _MARKED or (above >= 0 and marked[above]))
    plain = [(n, len(v.strip())) for n, v in page.runs if v and not hidden[n]]
    inside = sum(size for n, size in plain if marked[n] and not elements[n].linked)
    page.apart = inside > 0 and 2 * inside >= sum(size for n, size in plain if not elements[n].linked)
    for number, size in plain:
        if elements[number].linked:
            elements[number].score -= LINK_COST * size
        elif marked[number] or not page.apart:
            elements[number].prose += size
            elements[number].score += size
    for element in reversed(elements):
        if element.parent >= 0:
            above = elements[element.parent]
            above.prose += element.prose
            above.score += element.score * (DECAY if element.tag in _CONTAINERS else 1)


def best(page: Page) -> int | None:
    """The container with the greatest score; of equal ones the innermost that comes first.
    Where the page marks its prose, that around all of it, or the article or main with most."""
    found, most = None, 0.0
    around: set[int] = set()
    if page.apart:
        for number in range(len(page.elements) - 1, -1, -1):
            element = page.elements[number]
            if element.tag in _MARKED or number in around:
                around |= {number, element.parent}
    for number, element in enumerate(page.elements):
        if element.tag not in _CONTAINERS or not element.prose or (page.apart and number not in around):
            continue
        score = element.prose if page.apart else element.score
        if found is None or score > most or (score == most and number < page.elements[found].end):
            found, most = number, score
    return found


def _path(page: Page, number: int) -> str:
    """The containers from the root to this one."""
    steps = []
    while number >= 0:
        if page.elements[number].tag in _CONTAINERS:
            steps.append(page.elements[number].step)
        number = page.elements[number].parent
    return ">".join(reversed(steps))


def _on_path(page: Page, path: str) -> list[int]:
    """The topmost containers on a path."""
    steps, found = path.split(">"), []
    reached: list[int] = []  # steps of the path above and at an element, or -1
    for number, element in enumerate(page.elements):
        level = reached[element.parent] if element.parent >= 0 else 0
        if element.tag in _CONTAINERS:
            level = level + 1 if 0 <= level < len(steps) and steps[level] == element.step else -1
            if level == len(steps) and not (found and number < page.elements[found[-1]].end):
                found.append(number)
        reached.append(level)
    return found


def text_of(page: Page, roots: list[int]) -> str:
    blocks, part, chosen = [], [], {}
    for number, value in page.runs:
        if number not in chosen:
            trail, at = [], number
            while at >= 0 and at not in chosen:
                trail.append(at)
                at = page.elements[at].parent
            inside = chosen[at] if at >= 0 else False
            for at in reversed(trail):
                # a container named like boilerplate counts when it is the one chosen
                inside = at in roots or (inside and not page.elements[at].dull)
                chosen[at] = inside
        if value is None:
            blocks.append("".join(part))
            part = []
        elif chosen[number]:
            part.append(html.unescape(value))
    blocks.append("".join(part))
    return " ".join(" ".join(b.split()) for b in blocks if b.strip())


def vote(source: str | None) -> tuple[str, int] | None:
    """(path, prose) of the page's best container."""
    page = parse(source or "")
    number = best(page)
    return None if number is None else (_path(page, number), page.elements[number].prose)


def main_text(source: str | None, winner: str | None) -> str:
    page = parse(source or "")
    own = best(page)
    if own is None:
        return ""
    roots = _on_path(page, winner) if winner else []
    if 2 * sum(page.elements[r].prose for r in roots) < page.elements[own].prose:
        roots = [own]
    return text_of(page, roots)


def winners(pages: DataFrame, host: str, source: str) -> DataFrame:
    """(host, winner, n): the path with most votes per host, and the pages that voted."""
    kind = pa.struct([("path", pa.string()), ("prose", pa.int64())])

    @arrow_udf("struct<path:string,prose:bigint>")
    def voted(sources: pa.Array) -> pa.Array:
        votes = (vote(s.as_py()) for s in sources)
        return pa.array([v and {"path": v[0], "prose": v[1]} for v in votes], kind)

    votes = pages.where(F.col(host) != "").select(host, voted(source).alias("vote")).where("vote IS NOT NULL")
    counted = votes.groupBy(host, "vote.path").agg(F.count(F.lit(1)).alias("votes"), F.sum("vote.prose").alias("prose"))
    # the least struct: most votes, most prose, first path
    place = F.struct(-F.col("votes"), -F.col("prose"), F.col("path"))
    return counted.groupBy(host).agg(F.min_by("path", place).alias("winner"), F.sum("votes").alias("n"))


def with_main_text(pages: DataFrame, url: str = "url", source: str = "html") -> DataFrame:
    """Add `text` and `n_chars`, its code points."""
    named = pages.withColumn("_host_", host_and_path(url)[0])
    fitted = materialize(winners(named, "_host_", source), "host-paths")
    fitted = fitted.withColumnsRenamed({"winner": "_winner_", "n": "_n_"})
    joined = attach(named, fitted, ["_host_"], "_n_")

    @arrow_udf("string")
    def extracted(sources: pa.Array, paths: pa.Array) -> pa.Array:
        return pa.array([main_text(s.as_py(), p.as_py()) for s, p in zip(sources, paths)], pa.string())

    found = joined.withColumn("text", extracted(source, "_winner_"))
    return found.withColumn("n_chars", F.length("text").cast("long")).drop("_host_", "_winner_")
