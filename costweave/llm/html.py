"""Main text of HTML pages by tag-path ratios.

A page is cut into blocks of text, each with the path of block-level tags from the
root to it. For every path the length of its text and its punctuation are summed
over its blocks and divided by their number; along the page the ratios are
smoothed, multiplied and weakened by the share of linked text, and paths whose mean
reaches a part of the page's spread are content. That is done twice. The smallest
elements that hold most of what the first pass found weigh as a further signal in
the second, so short paragraphs, lists and headings beside the content stay; an
<article> around them weighs less, and by itself neither <article> nor <main> counts.
Parts that are named as menus, adverts and the like keep a hundredth of their ratio,
unless such an element holds most of the page's text.

Every page is one row: nothing is shuffled.

Defined results: a null or empty page, or one without content, gives an empty text;
broken markup (open tags, cut tags and references at the end) is read as far as it
goes; an element in ``DEPTH`` others replaces the innermost one, as browsers do, and after
``STRAY`` tags with a quote that is never closed quotes no longer hide the end of a tag, so
time grows with the length of a page only; repeated rows are each returned; columns named like the results are replaced.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

SMOOTHING = (0.05, 0.25, 0.4, 0.25, 0.05)
THRESHOLD = 0.2
# a content path reaches this part of the highest ratio, too
LEAST = 0.05
MOST = 0.8
PART = 0.15
# what the place of a block adds to its ratio: inside an element that holds the content, or in the article around it
IN_HOME = 1000.0
IN_ARTICLE = 10.0
# what a part named as a menu, an advert and the like keeps of its ratio
IN_NAMED = 0.01
# what a path loses when all its text is linked
LINKED = 0.95

DEPTH = 256
STRAY = 64

# Elements by their role.
SKIPPED = {"script", "style", "noscript", "template", "svg", "math", "iframe", "object", "head", "title",
           "select", "textarea", "button", "canvas", "audio", "video", "map"}
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "template"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i",
          "ins", "kbd", "label", "mark", "nobr", "q", "ruby", "rt", "rp", "s", "samp", "small", "span", "strike",
          "strong", "sub", "sup", "time", "tt", "u", "var"}
BOILERPLATE = {"nav", "footer", "aside", "form", "header", "menu", "dialog"}
BOILERPLATE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert"}
BOILERPLATE_NAMES = re.compile(
    r"(?:^|[-_ ])(?:ads?|adverts?|advertisement|advertising|sponsor(?:ed)?|promo(?:tion)?s?|banners?|cookies?|consent"
    r"|notices?|gdpr|popups?|modal|overlay|newsletter|subscribe|sidebars?|side|widgets?|nav(?:bar|igation)?|menus?"
    r"|breadcrumbs?|pagination|pager|footers?|masthead|topbar|toolbar|share|sharing|social|related|recommended"
    r"|recommendations|comments?|commentlist|replies|reply|respond|disqus|login|search|tags|copyright|legal"
    r"|disclaimer|skip)(?:$|[-_ ])",
    re.I,
)
# a name after one of these tells how a page is laid out
STATES = re.compile(r"(?:has|no|not|with|without)[-_]", re.I)
# opening one of the first closes an open one of the second
CLOSES = {
    **dict.fromkeys(["li"], {"li", "p"}),
    **dict.fromkeys(["dt", "dd"], {"dt", "dd", "p"}),
    **dict.fromkeys(["tr"], {"tr", "td", "th", "p"}),
    **dict.fromkeys(["td", "th"], {"td", "th", "p"}),
    **dict.fromkeys(["tbody", "thead", "tfoot"], {"tbody", "thead", "tfoot", "tr", "td", "th", "p"}),
    **dict.fromkeys(["option"], {"option"}),
}
BARRIER = {"ul", "ol", "dl", "table", "div", "section", "article", "main", "body", "html", "blockquote"}

PUNCTUATION = re.compile(r"[.,;:!?…。，；：！？、]")
_SPACES = re.compile(r"\s+")
_TAG = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?:(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>)|(?P<open>[^>]*(?:>|\Z)))",
    re.S,
)
_LOOSE_TAG = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<[!?][^>]*(?:>|\Z)|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>)(?P<open>[^>]*(?:>|\Z))", re.S
)
_ATTRIBUTE = re.compile(r"([^\s=\"'>/]+)(?:\s*=\s*(\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z)|[^\s>]+))?")
_RAW_ENDS = {name: re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I) for name in RAW}


# what an element is: text, out of sight, a part of the page beside its text, or one by its name only
PLAIN, UNSEEN, BESIDE, NAMED = range(4)


@dataclass
class Block:
    path: tuple[int, ...]
    names: tuple[str, ...]
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    dropped: bool = False
    beside: bool = False
    named: tuple[int, ...] = ()
    text: str = ""


@dataclass
class _Open:
    name: str
    number: int
    role: int


def _is_named(name: str, value: str) -> bool:
    tokens = [t for t in value.split() if not STATES.match(t)]
    # an article may carry the names of its subjects: there a name counts where it stands first
    find = BOILERPLATE_NAMES.match if name == "article" else BOILERPLATE_NAMES.search
    return any(find(t) for t in tokens)


def _role(name: str, attributes: str, inside_article: bool) -> int:
    if name in SKIPPED:
        return UNSEEN
    role = PLAIN
    if name in BOILERPLATE and not (name == "header" and inside_article):
        # a form may be around the whole page
        role = NAMED if name == "form" else BESIDE
    if name in ("html", "body", "main") or len(attributes) < 3:
        return role
    for label, value in _ATTRIBUTE.findall(attributes):
        label, value = label.lower(), value.strip("\"'").lower()
        if label == "hidden" or (label == "aria-hidden" and value == "true"):
            return UNSEEN
        if label == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return UNSEEN
        if role == PLAIN and (
            (label == "role" and value in BOILERPLATE_ROLES) or (label in ("id", "class") and _is_named(name, value))
        ):
            role = NAMED
    return role


def blocks(page: str) -> list[Block]:
    """The blocks of text of a page, in page order, each with its path."""
    out: list[Block] = []
    stack: list[_Open] = []
    numbers = 0
    links = 0
    stray = 0
    known: dict[tuple[str, ...], tuple[str, ...]] = {}
    current: Block | None = None

    def add(raw: str) -> None:
        nonlocal current
        if not raw:
            return
        text = html.unescape(raw)
        if current is None:
            if not text.strip():
                return
            outer = [o for o in stack if o.name not in INLINE]
            names = tuple(o.name for o in outer)
            current = Block(
                tuple(o.number for o in outer),
                known.setdefault(names, names),
                dropped=any(o.role == UNSEEN for o in stack),
                beside=any(o.role == BESIDE for o in stack),
                named=tuple(o.number for o in stack if o.role == NAMED),
            )
            out.append(current)
        current.parts.append(text)
        if links:
            current.linked += len(text.strip())

    def close(names: set[str], until: set[str]) -> None:
        """Close the innermost of ``names``, and all in it, unless something of ``until`` is in between."""
        nonlocal links, current
        for at in range(len(stack) - 1, -1, -1):
            if stack[at].name in names:
                links -= sum(o.name == "a" for o in stack[at:])
                # what follows is no longer of the closed element
                if any(o.role != PLAIN for o in stack[at:]):
                    current = None
                del stack[at:]
                return
            if stack[at].name in until:
                return

    at = 0
    while True:
        tag = (_TAG if stray < STRAY else _LOOSE_TAG).search(page, at)
        if tag is None:
            add(page[at:])
            break
        add(page[at : tag.start()])
        at = tag.end()
        name = (tag["name"] or "").lower()
        if not name:
            continue
        # to know that a quote stays open, the page was read to its end
        stray += tag["open"] is not None
        block = name not in INLINE
        if name == "br":
            if current is not None:
                current.parts.append(" ")
            continue
        if block and name not in ("wbr", "img", "input", "embed", "source", "track", "param"):
            current = None
        if name in VOID:
            continue
        if tag["close"]:
            close({name}, set() if block else BARRIER)
            continue
        if block:
            if name in CLOSES:
                for _ in range(3):
                    close(CLOSES[name], BARRIER)
            else:
                close({"p"}, BARRIER)
        rest = tag["rest"] or tag["open"] or ""
        if rest.rstrip(">").endswith("/") and name not in BARRIER:
            continue
        numbers += 1
        inside = any(o.name in ("article", "main") for o in stack)
        role = _role(name, rest, inside)
        if name in RAW:
            end = _RAW_ENDS[name].search(page, at)
            at = end.end() if end else len(page)
            continue
        if role != PLAIN and not block:
            current = None
        if len(stack) == DEPTH:
            close({stack[-1].name}, set())
        if name == "a":
            links += 1
        stack.append(_Open(name, numbers, role))
    for b in out:
        b.text = _SPACES.sub(" ", "".join(b.parts)).strip()
    return [b for b in out if b.text]


def _paths(page_blocks: list[Block], *apart: np.ndarray) -> np.ndarray:
    """The number of every block's path; ``apart`` tells paths of one name from each other."""
    number: dict[tuple, int] = {}
    keys = [(b.names, *(x[i] for x in apart)) for i, b in enumerate(page_blocks)]
    return np.array([number.setdefault(k, len(number)) for k in keys])


def _ratios(page_blocks: list[Block], of: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The fused, smoothed and weighted ratio of every block's path, ``of`` being its number."""
    size = np.array([len(b.text) for b in page_blocks])
    count = np.bincount(of)
    total = np.bincount(of, size)
    text = (total / count)[of]
    marks = ((np.bincount(of, [len(PUNCTUATION.findall(b.text)) for b in page_blocks]) + 1) / count)[of]
    linked = np.bincount(of, np.minimum([b.linked for b in page_blocks], size))
    free = (1 - LINKED * linked / total)[of]
    kernel = np.array(SMOOTHING)

    def smooth(x):
        weight = np.convolve(np.ones(x.size), kernel, "same" if x.size >= kernel.size else "full")
        value = np.convolve(x, kernel, "same" if x.size >= kernel.size else "full")
        if x.size < kernel.size:
            cut = kernel.size // 2
            weight, value = weight[cut : cut + x.size], value[cut : cut + x.size]
        return value / weight

    # weighted before, too, so that what weighs little does not lift its neighbours
    return smooth(text * weights) * smooth(marks * weights) * free * weights


def _means(values: np.ndarray, of: np.ndarray) -> np.ndarray:
    """For every block the mean of its path."""
    return (np.bincount(of, values) / np.bincount(of))[of]


def _homes(found: list[Block], content: np.ndarray) -> set[int]:
    """The smallest elements that together hold most of the content."""
    leaves = {b.path[-1] for b in found if b.path}
    start = [b for b, c in zip(found, content) if c]
    whole = sum(len(b.text) for b in start)
    homes: set[int] = set()
    open_: list[tuple[int | None, int, list[Block]]] = [(None, 0, start)]
    while open_:
        home, depth, within = open_.pop()
        inside: dict[int, list[Block]] = {}
        for b in within:
            if len(b.path) > depth:
                inside.setdefault(b.path[depth], []).append(b)
        size = {e: sum(len(b.text) for b in own) for e, own in inside.items()}
        # a block of text is no container: its neighbours belong to it
        parts = [e for e in size if size[e] >= PART * whole and e not in leaves]
        if parts and sum(size[e] for e in parts) >= MOST * sum(len(b.text) for b in within):
            open_ += [(e, depth + 1, inside[e]) for e in parts]
        elif home is not None:
            homes.add(home)
    return homes


def _places(found: list[Block], content: np.ndarray) -> np.ndarray:
    """The weight of every block by where it stands to the content that was found first."""
    homes = _homes(found, content)
    articles = [[e for e, name in zip(b.path, b.names) if name == "article"] for b in found]
    holding = {e for own, c in zip(articles, content) if c for e in own}
    around = {e for b, own in zip(found, articles) for e in own if homes.intersection(b.path[b.path.index(e) :])}
    out = np.ones(len(found))
    for i, (b, own) in enumerate(zip(found, articles)):
        # an article of its own, without content, is a card beside the content
        if homes.intersection(b.path) and holding.issuperset(own):
            out[i] = IN_HOME
        elif own and own[-1] in around:
            out[i] = IN_ARTICLE
    return out


def _weights(found: list[Block]) -> np.ndarray:
    """The weight of every block by the names around it.

    A name counts for nothing on an element that holds most of the page's text, unless
    only others have a title or an article.
    """
    mass = [0 if b.beside else len(b.text) - min(b.linked, len(b.text)) for b in found]
    anchor = ["article" in b.names or "main" in b.names or b.names[-1:] == ("h1",) for b in found]
    inside: dict[int, int] = {}
    anchored: set[int] = set()
    for b, m, a in zip(found, mass, anchor):
        for e in b.named:
            inside[e] = inside.get(e, 0) + m
            if a:
                anchored.add(e)
    elsewhere = any(a and not b.named and not b.beside for b, a in zip(found, anchor))
    lifted = {e for e, m in inside.items() if 2 * m > sum(mass) and (e in anchored or not elsewhere)}
    return np.array([IN_NAMED if b.beside or not lifted.issuperset(b.named) else 1.0 for b in found])


def main_text(page: str | None) -> str:
    """The article of a page: the blocks on its content paths, joined by line ends."""
    if not page:
        return ""
    found = [b for b in blocks(page) if not b.dropped]
    weights = _weights(found)
    if not (weights == 1).any():
        return ""
    of = _paths(found, weights)
    fused = _ratios(found, of, weights)
    threshold = max(THRESHOLD * fused.std(), LEAST * fused.max())
    places = np.where(weights < 1, 1.0, _places(found, _means(fused, of) >= threshold))
    of = _paths(found, weights, places)
    content = _means(_ratios(found, of, weights) * places, of) >= threshold
    return "\n".join(b.text for b, c in zip(found, content) if c)


_RESULT = T.StructType([T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])


def _extracted(batches: Iterator[pa.RecordBatch], column: str, keep: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            piece = batch.slice(start, 256)
            texts = [main_text(p.as_py()) for p in piece.column(column)]
            yield pa.RecordBatch.from_arrays(
                [
                    *[piece.column(k) for k in keep],
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                names=[*keep, *_RESULT.names],
            )


def extract(pages: DataFrame, column: str = "html") -> DataFrame:
    """All other columns of ``pages`` with ``text`` and ``n_chars``."""
    keep = [c for c in pages.columns if c not in (column, *_RESULT.names)]
    schema = T.StructType([*[pages.schema[c] for c in keep], *_RESULT.fields])
    return pages.select(*keep, column).mapInArrow(lambda batches: _extracted(batches, column, keep), schema)
