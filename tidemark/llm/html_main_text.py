"""Main text of web pages by tree scoring.

A page becomes a tree of block elements. Each paragraph passes points, for its length and its
commas, to the elements around it, less the farther away they are. An element's points are
discounted by the share of its text that is links. The element with the most points is the article's
container; it is kept with those siblings that read like parts of the article. Blocks whose tag,
role, class or id says that they are no part of an article (menus, footers, adverts, forms, reader
comments and so on) are left out before the scoring and inside the container.

Null and empty pages, and pages without text, give an empty text. Markup is read as browsers read it:
unclosed and stray tags, comments, raw script text and a cut off end need no repair. Each page is
worked on alone and whole; rows are neither joined nor shuffled, so repeated rows and ties need
nothing. Of two elements with equal points the first on the page wins.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.frames import with_results

# HTML elements by what they mean for the text.
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p "
    "pre section summary table tbody td tfoot th thead tr ul".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements whose content is not markup, and never text of an article.
_RAW = frozenset("iframe noembed noframes noscript script style textarea title xmp".split())
#: Other elements that are left out with all they hold.
_OUT = frozenset("aside button canvas dialog footer form head menu nav object select svg "
                 "template video audio".split())
_OUT_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar "
                       "navigation search toolbar".split())
#: A start tag closes an open element of the second kind, up to one of the third.
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr"}, {"table", "tbody", "thead", "tfoot"}),
    "tbody": ({"tbody", "thead", "tfoot"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot"}, {"table"}),
}
#: End tags do not reach across these.
_WALLS = frozenset("table td th caption html".split())
#: Words in a class or id that say what a block is, in any case, singular or plural.
_OUT_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense adbox alert alerts banner breadcrumb "
    "breadcrumbs captcha comment comments commentlist consent cookie cookies disclaimer disqus "
    "dropdown footer gdpr login masthead menu menus modal nav navbar navigation newsletter notice "
    "notices notification pager pagination paywall popup promo promoted promotion recommended "
    "related replies reply respond rss search share sharing shoutbox sidebar signup skip "
    "skyscraper social sponsor sponsored subscribe subscription toolbar tracking trending widget "
    "widgets".split())
#: Words after these are about another block: "has-sidebar".
_ABOUT_OTHERS = frozenset("with without has no".split())
#: Elements without content, which are never open.
_EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)"
    r"(?P<rest>(?>\s*=\s*\"[^\"]*\"|\s*=\s*'[^']*'|[^>])*?)>", re.S)
_ATTRIBUTE = re.compile(
    r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_COMMAS = re.compile("[,،、，]")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_SENTENCE_END = re.compile(r"[.!?…。！？][\"'”’»)\]]*\Z")

#: Shares of a paragraph's points that its container and the elements around that get.
SHARES = (1.0, 1 / 2, 1 / 6, 1 / 9, 1 / 12)
#: Characters of a paragraph that are worth as much as one comma.
CHARS_A_POINT = 100
#: A sibling is kept if it has this share of the container's points.
SIBLING_SHARE = 0.2
#: Sibling paragraphs are kept if at most this share of them is links.
SIBLING_LINKS = 0.25
#: Shorter sibling paragraphs must also end as a sentence does.
SIBLING_CHARS = 80
#: Without an article element, lists of at least three links, and blocks right below the body, are
#: menus if this share of their text is links.
MENU_LINKS = 0.8


def _named_out(name: str, rest: str, in_article: bool) -> bool:
    """Whether tag and attributes say that a block is no part of an article."""
    if name in _OUT or (name == "header" and not in_article):
        return True
    if not rest or name in ("html", "body", "main"):
        return False
    for key, *values in _ATTRIBUTE.findall(rest):
        key, value = key.lower(), values[0] or values[1] or values[2]
        if key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
            return True
        if key == "style" and _HIDDEN.search(value):
            return True
        if key == "role" and value.strip().lower() in _OUT_ROLES:
            return True
        if key in ("class", "id"):
            for label in value.split():
                words = [w.lower() for w in _WORD.findall(label)]
                if "".join(words) in _OUT_WORDS:
                    return True
                for word in words:
                    if word in _ABOUT_OTHERS:
                        break
                    if word in _OUT_WORDS or (word == "header" and not in_article):
                        return True
    return False


class _Page:
    """Block elements of a page, in page order, and the runs of text that they hold directly."""

    def __init__(self, source: str):
        self.tags, self.parents, self.out = ["page"], [-1], [False]
        self.semantic = [False]  # inside an article or main element
        self.runs: list[tuple[int, list[tuple[str, bool]]]] = []
        self._open, self._places = [0], {}  # open elements; where each tag is open
        self._link: int | None = None  # the element in which a link was opened
        self._fresh = True  # the next text begins a run
        self._read(source)

    def _start(self, name: str, rest: str) -> None:
        closes, walls = _CLOSES.get(name, ((), ()))
        if name in _BLOCKS:
            self._end("p")
            self._end("head")
        for place in range(len(self._open) - 1 if closes else 0, 0, -1):
            tag = self.tags[self._open[place]]
            if tag in walls:
                break
            if tag in closes:
                self._cut(place)
                break
        parent = self._open[-1]
        number = len(self.tags)
        self.tags.append(name)
        self.parents.append(parent)
        inside = self.semantic[parent]
        self.out.append(self.out[parent] or _named_out(name, rest, inside))
        self.semantic.append(inside or name in ("article", "main"))
        self._fresh = True
        if name not in _EMPTY:
            self._places.setdefault(name, []).append(len(self._open))
            self._open.append(number)

    def _end(self, name: str) -> None:
        places = self._places.get(name)
        if not places:
            return
        place = places[-1]
        if name not in _WALLS:
            for wall in _WALLS:
                held = self._places.get(wall)
                if held and held[-1] > place:
                    return
        self._cut(place)

    def _cut(self, place: int) -> None:
        """Close the open elements from a place on."""
        while len(self._open) > place:
            number = self._open.pop()
            self._places[self.tags[number]].pop()
            if self._link is not None and self._link == number:
                self._link = None
        self._fresh = True

    def _text(self, raw: str) -> None:
        if not raw:
            return
        if self._fresh:
            if raw.isspace():
                return
            self.runs.append((self._open[-1], []))
            self._fresh = False
        self.runs[-1][1].append((html.unescape(raw) if "&" in raw else raw,
                                 self._link is not None))

    def _read(self, source: str) -> None:
        at, last = 0, source.rfind(">")
        while True:
            found = _TOKEN.search(source, at, last + 1)
            if found is None:
                break
            self._text(source[at:found.start()])
            at = found.end()
            name = found["name"]
            if name is None:
                continue
            name = name.lower()
            if found["close"]:
                if name == "a":
                    self._link = None
                else:
                    self._end(name)
            elif name in _RAW:
                end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.I).search(source, at)
                at = end.end() if end else len(source)
            elif name == "br":
                self._text(" ")
            elif name in _BLOCKS or (name not in _EMPTY and not found["rest"].endswith("/")
                                     and _named_out(name, found["rest"], True)):
                self._start(name, found["rest"])
            elif name == "a":
                self._link = self._open[-1]
        rest = source[at:]
        cut = re.search(r"<[a-zA-Z/!?]", rest)  # a tag that the end of the page cuts off
        self._text(rest[:cut.start()] if cut else rest)


def _passers(page: _Page, block: int) -> Iterator[int]:
    """The elements that get points from a paragraph in ``block``, the nearest first."""
    if page.tags[block] not in ("div", "section", "article", "main", "body", "html", "page",
                                "center", "fieldset", "details", "figure"):
        block = page.parents[block]
    for _ in SHARES:
        if block < 0:
            return
        yield block
        block = page.parents[block]


def main_text(source: str | None) -> str:
    """The article of a page, its blocks joined by one space; empty if it has none."""
    page = _Page(source or "")
    count = len(page.tags)
    points, chars, linked, links = [0.0] * count, [0] * count, [0] * count, [0] * count
    runs = []  # block, text, linked characters
    for block, pieces in page.runs:
        if page.out[block]:
            continue
        text = " ".join("".join(p for p, _ in pieces).split())
        if not text:
            continue
        in_links = sum(len(" ".join(p.split())) for p, is_link in pieces if is_link)
        runs.append((block, text, min(in_links, len(text))))
        chars[block] += len(text)
        linked[block] += runs[-1][2]
        links[block] += sum(is_link and not p.isspace() for p, is_link in pieces)
        if page.tags[block] not in _HEADINGS:
            worth = len(text) / CHARS_A_POINT + len(_COMMAS.findall(text))
            worth *= 1 - runs[-1][2] / len(text)
            for share, around in zip(SHARES, _passers(page, block), strict=False):
                points[around] += share * worth
    if not runs:
        return ""
    for block in range(count - 1, 0, -1):  # children stand behind their parents
        parent = page.parents[block]
        chars[parent] += chars[block]
        linked[parent] += linked[block]
        links[parent] += links[block]

    def links_of(block: int) -> float:
        return linked[block] / chars[block] if chars[block] else 0.0

    scores = [p * (1 - links_of(b)) for b, p in enumerate(points)]
    best = max(range(count), key=lambda b: (scores[b], -b))
    whole = _whole_article(page, best)
    kept = {best if whole is None else whole}
    if whole is None:
        kept |= _siblings(page, runs, best, scores, links_of)
    # children stand behind their parents, so one pass marks all that the kept elements hold
    inside = [False] * count
    for block in range(count):
        parent = page.parents[block]
        inside[block] = block in kept or (parent >= 0 and inside[parent])
        if whole is None and inside[block] and links_of(block) >= MENU_LINKS and (
                page.tags[parent] in ("body", "html", "page")
                or (page.tags[block] in ("ul", "ol") and links[block] >= 3)):
            inside[block] = False
    own = -1 if whole is not None else page.parents[best]
    return " ".join(text for block, text, in_links in runs
                    if inside[block] or (block == own and page.tags[own] != "page"
                                         and _reads_on(text, in_links / len(text))))


def _whole_article(page: _Page, best: int) -> int | None:
    """The article element around the best one, or else the main element; None without either."""
    main, block = None, best
    while block >= 0:
        if page.tags[block] == "article":
            return block
        if page.tags[block] == "main" and main is None:
            main = block
        block = page.parents[block]
    return main


def _reads_on(text: str, links: float) -> bool:
    """Whether a paragraph beside the container reads like a part of the article."""
    return links < SIBLING_LINKS and (
        len(text) > SIBLING_CHARS or (not links and bool(_SENTENCE_END.search(text))))


def _siblings(page: _Page, runs: list, best: int, scores: list[float], links_of) -> set[int]:
    parent = page.parents[best]
    if parent < 0:
        return set()
    texts: dict[int, list[str]] = {}
    for block, text, _ in runs:
        texts.setdefault(block, []).append(text)
    kept = set()
    for block in range(parent + 1, len(page.tags)):
        if page.parents[block] != parent or page.out[block]:
            continue
        tag, text = page.tags[block], " ".join(texts.get(block, ()))
        if scores[block] >= SIBLING_SHARE * scores[best] > 0:
            kept.add(block)
        elif tag in _HEADINGS:
            if block < best and links_of(block) < SIBLING_LINKS:
                kept.add(block)
        elif text and tag in ("p", "pre", "blockquote") and _reads_on(text, links_of(block)):
            kept.add(block)
    return kept


def extract(pages: DataFrame, text: str = "html", keep: Sequence[str] | None = None) -> DataFrame:
    """``pages``' columns ``keep`` (default: all), the main ``text`` and its number of characters.
    Columns of ``pages`` named ``text`` or ``n_chars`` give way."""

    def make():
        def of(sources: list[str | None]) -> list[pa.Array]:
            texts = [main_text(source) for source in sources]
            return [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
        return of

    return with_results(pages, text, "text string, n_chars bigint", make, keep)
