"""Main text of web pages by tree scoring.

Paragraphs pass points for their length and commas to the elements above them,
less with each level.  An element's points are discounted by the share of its
text that stands in links.  The best element is kept with its siblings, or, if
it lies in an article or main element, that one with those of its siblings that
look like it; boilerplate inside them goes.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names of HTML by how their text is laid out.
_BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search section select summary table tbody td tfoot th thead tr ul".split()
)
_RAW = frozenset("script style noscript template textarea title iframe object svg math canvas audio video noembed noframes select datalist xmp".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_ENDS_P = _BLOCKS - {"body", "html", "tr", "td", "th", "tbody", "thead", "tfoot", "caption", "option"}
#: Element -> elements it closes when they are still open, and those that stop the search.
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
_SPACED = frozenset(("br", "img"))

# Elements, roles and names that mark what is not the article.
_ASIDE = frozenset("nav footer aside form fieldset button menu dialog search header".split())
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
_MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adslot adbox banner banners breadcrumb breadcrumbs byline captcha comment comments "
    "commentlist consent cookie cookies copyright cta disclaimer discussion disqus donate footer footnav gdpr header masthead menu menus modal nav navbar "
    "navigation newsletter notice notices notification overlay pager pagination paywall popup promo promoted promotion recommended related remark replies "
    "reply respond rss search share sharing shoutbox sidebar sidenav signup skip social sponsor sponsored subscribe subscription tags toc toolbar topbar "
    "tracking widget widgets".split()
)
# Words that stand beside a mark in a name without changing what it says.
_BESIDE = frozenset(
    "area article articles bar block blog body bottom box buttons container content entry first form global group header inner item items last left link links list main outer "
    "page panel post posts primary right second secondary section site slot story text thread title top unit widget wrap wrapper".split()
)
#: Marks that count on an article element, too, and however much of the page's text an element holds.
_NOT_ARTICLES = frozenset("ad ads advert advertisement comment comments promo related remark replies reply sponsored teaser".split())
_GOOD = frozenset("article body content entry main page post story text blog".split())

_TAG = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?>[^'\">]+|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"(?:^|[\s/])(class|id|role|hidden|aria-hidden|style|itemprop)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?(?=[\s/]|$)", re.I)
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_HEADINGS = frozenset(("h1", "h2", "h3"))

_LISTS = frozenset(("ul", "ol", "table"))
_LINK_BOXES = _LISTS | {"div", "section"}

#: Share of points that elements above a paragraph get, from the parent upwards.
_SHARES = (1.0, 0.5, 1 / 6, 1 / 9, 1 / 12)
#: Bonus of article and main elements.
_ARTICLE = 25.0
#: Siblings of an article are kept from this share of the best score on.
SIBLING = 0.2
#: Lists and boxes with more than this share of their text in links are menus.
LINKED = 0.7


class Element:
    __slots__ = ("tag", "parent", "barred", "marked", "firm", "bonus", "points", "chars", "linked", "plain")

    def __init__(self, tag: str, parent: Element | None, barred: bool, marked: bool, firm: bool, bonus: float) -> None:
        self.tag, self.parent, self.barred, self.marked, self.firm, self.bonus = tag, parent, barred, marked, firm, bonus
        self.points, self.chars, self.linked, self.plain = 0.0, 0, 0, 0

    @property
    def aside(self) -> bool:
        return any(x.barred or x.marked for x in _up(self))

    @property
    def score(self) -> float:
        return (self.points + (self.bonus if self.points else 0.0)) * (1 - self.linked / max(self.chars, 1))


def _says(name: str, marks: frozenset[str]) -> bool:
    """Whether a class name or id as a whole names one of ``marks``: no other word in it but numbers and such as "left" or "box"."""
    words = [w.lower() for w in _TOKEN.findall(name)]
    return any(w in marks for w in words) and all(w in marks or w in _MARKS or w in _BESIDE or w.isdigit() for w in words)


def _judge(tag: str, attributes: str) -> tuple[bool, bool, bool, float]:
    """Whether an element is aside from the article by its kind, whether by its names, whether firmly so, and its bonus."""
    aside, marked, firm, bonus = tag in _ASIDE, False, False, 0.0
    if tag in ("article", "main"):
        bonus = _ARTICLE
    if attributes:
        for name, *values in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), values[0] or values[1] or values[2]
            if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                aside = True
            elif name == "role":
                aside = aside or value.lower() in _ROLES
                bonus = _ARTICLE if value.lower() in ("main", "article") else bonus
            elif name in ("class", "id", "itemprop"):
                words = {w.lower() for w in _TOKEN.findall(value)}
                if words & _GOOD:
                    bonus = max(bonus, 10.0)
                if tag not in ("main", "body", "html"):
                    firm = firm or any(_says(n, _NOT_ARTICLES) for n in value.split())
                    marked = firm or marked or tag != "article" and any(_says(n, _MARKS) for n in value.split())
    return aside, marked, firm, bonus


def _blocks(page: str) -> tuple[list[tuple[Element, str, int]], list[Element]]:
    """Text blocks in page order as ``(element, text, characters in links)``, and all elements."""
    root = Element("html", None, False, False, False, 0.0)
    elements = [root]
    here = root
    blocks: list[tuple[Element, str, int]] = []
    parts: list[tuple[str, bool]] = []
    in_link = False
    at, end = 0, len(page)

    def flush() -> None:
        nonlocal parts
        if parts:
            text = " ".join(html.unescape("".join(p for p, _ in parts)).split())
            if text:
                linked = sum(len(" ".join(html.unescape(p).split())) for p, link in parts if link)
                blocks.append((here, text, min(linked, len(text))))
            parts = []

    def close(tags: set[str], stops: set[str] | frozenset[str]) -> None:
        nonlocal here
        node = here
        while node is not root and node.tag not in stops:
            if node.tag in tags:
                flush()
                here = node.parent
                return
            node = node.parent

    while at < end:
        found = _TAG.search(page, at)
        if found is None:
            parts.append((page[at:], in_link))
            break
        if found.start() > at:
            parts.append((page[at : found.start()], in_link))
        at = found.end()
        tag = found[2] or found[5]
        if not tag:
            if page.startswith("<![CDATA[", found.start()):
                parts.append((found[0][9:].removesuffix("]]>").replace("&", "&amp;"), in_link))
            continue
        tag, closing, attributes = tag.lower(), bool(found[1] or found[4]), found[3] or found[6] or ""
        if closing:
            if tag == "a":
                in_link = False
            elif tag in _BLOCKS:
                close({tag}, frozenset(("table",)) if tag not in ("table", "body", "html", "article", "main", "section") else frozenset())
                in_link = False
            continue
        if tag in _RAW:
            if not attributes.endswith("/"):
                stop = re.compile(rf"</{re.escape(tag)}\s*[^>]*>", re.I).search(page, at)
                at = stop.end() if stop else end if tag in ("script", "style", "title", "textarea") else at
            continue
        if tag == "a":
            in_link = not attributes.endswith("/")
        if tag in _SPACED:
            parts.append((" ", in_link))
        if tag not in _BLOCKS:
            continue
        if tag in _ENDS_P:
            close({"p"}, frozenset(("table", "button")))
        if tag in _CLOSES:
            close(*_CLOSES[tag])
        flush()
        if tag in _VOID or tag in ("html", "body") and here is not root:
            continue
        barred, marked, firm, bonus = _judge(tag, attributes)
        if tag == "header" and any(x.tag in ("article", "main") for x in _up(here)):
            barred = False
        if tag in ("article", "main") and not (barred or marked):
            for above in _up(here):  # a box around the article is no sidebar, whatever its name
                above.marked = False
        here = Element(tag, here, barred, marked, firm, bonus)
        elements.append(here)
    flush()
    return blocks, elements


def _up(node: Element | None) -> Iterator[Element]:
    while node is not None:
        yield node
        node = node.parent


def _unmark(blocks: list[tuple[Element, str, int]], elements: list[Element]) -> None:
    """No name marks what holds most of a page's text outside links, but for comments, adverts and the like."""
    total = 0
    for node, text, linked in blocks:
        if any(x.barred or x.firm and x.marked for x in _up(node)):
            continue
        total += len(text) - linked
        for above in _up(node):
            above.plain += len(text) - linked
    for element in elements:
        if element.marked and not element.firm and 2 * element.plain > total:
            element.marked = False


def main_text(page: str | None) -> str:
    """The article of a page; empty if it has none."""
    if not page:
        return ""
    blocks, elements = _blocks(page)
    _unmark(blocks, elements)
    blocks = [b for b in blocks if not b[0].aside]
    for node, text, linked in blocks:
        for above in _up(node):
            above.chars += len(text)
            above.linked += linked
        # An article's own header names it and its author; it scores no points.
        points = (len(text) / 100 + text.count(",") + text.count("、") + text.count("，") + (1 if len(text) >= 25 else 0.1)) * (1 - linked / len(text))
        start = node.parent if node.tag in ("p", "pre", "h1", "h2", "h3", "h4", "h5", "h6", "li", "blockquote", "dd", "dt", "td") and node.parent else node
        for share, above in zip(_SHARES, _up(start)):
            above.points += points * share
    best = max(elements, key=lambda e: (e.score, e.bonus), default=None)
    if best is None or not blocks or best.score <= 0:
        return ""
    # Whatever its best part, an article is kept whole.
    top = best.score
    best = next((x for x in _up(best) if x.bonus >= _ARTICLE and not x.aside), best)
    article = best.bonus >= _ARTICLE
    kept = {id(best)}
    for other in elements:
        if other is best or other.parent is not best.parent or other.aside or best.parent is None:
            continue
        density = other.linked / max(other.chars, 1)
        if not article or other.score >= max(1.0, SIBLING * top) or other.tag in _HEADINGS or other.tag == "p" and other.chars > 80 and density < 0.25:
            kept.add(id(other))
    # Text that stands in the parent itself, between the kept children.
    loose = None if article else best.parent
    out = []
    for node, text, linked in blocks:
        inside, menu, heading = node is loose, False, False
        for above in _up(node):
            heading = heading or above.tag in _HEADINGS
            if above.tag == "header" and not heading:
                menu = True
            if above.tag in _LINK_BOXES and above.chars and above.linked > LINKED * above.chars and above is not best:
                # An article's lists of links are its own.
                menu = menu or not (article and (best.tag == "article" or above.tag in _LISTS))
            if id(above) in kept:
                inside = True
                break
        if inside and not menu:
            out.append(text)
    return "\n".join(out)


def extract(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars)``, one row per row of ``pages``.

    ``pages`` needs ``page_id``, ``url`` and ``html``; other columns are
    ignored.  Character references are decoded, white space inside a block is
    one space, blocks are joined by a line feed.  Defined results: a null or
    empty page and one without text has an empty text and 0; repeated rows give
    repeated rows; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Surrogates can come from character references; they are no text.
            texts = [main_text(p).encode("utf-8", "replace").decode() for p in batch["html"].to_pylist()]
            sizes = [len(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch["page_id"], batch["url"], pa.array(texts, pa.string()), pa.array(sizes, pa.int64())], ["page_id", "url", "text", "n_chars"]
            )

    chosen = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return chosen.mapInArrow(run, "page_id long, url string, text string, n_chars long")
