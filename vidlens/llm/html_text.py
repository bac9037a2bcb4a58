"""HTML extraction: line-block distribution."""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names of HTML by their role on a page.
RAW = frozenset("script style textarea noscript template svg iframe object select option canvas audio video "
                "head title".split())
BOILERPLATE = frozenset("nav header footer aside form button menu dialog fieldset label input".split())
MAIN = frozenset("article main".split())
LAYOUT_ELEMENTS = frozenset("article main nav header footer aside".split())
BLOCKS = frozenset("address article aside blockquote body br caption center dd details dialog div dl dt fieldset "
                   "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre "
                   "section summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that hold a word or two: the next block ends them.
SMALL = frozenset("button label".split())
#: Head nouns of a class or id that mark a part beside the article.
BESIDE = re.compile(r"ads?|advert\w*|banner|breadcrumbs?|comments?|cookies?|consent|copyright|disqus|"
                    r"footer|gdpr|header|hidden|login|masthead|menu|modal|nav|navbar|navigation|newsletter|notice|"
                    r"pagination|popup|promo\w*|related|replies|reply|respond|search|share|sharing|sidebar|signup|"
                    r"social|sponsor\w*|subscribe|toolbar|widget", re.I)
#: Parts of a name that say only how its noun is laid out: "comment-list" is about comments.
LAYOUT = frozenset("area bar block body bottom box button buttons center col column container content form group inner item "
                   "items left link links list outer panel posts right row section slot thread top unit wrap wrapper zone".split())
#: Parts before a noun that speak of another element ("has-sidebar"), and those that keep a header beside.
ABOUT = frozenset("has have with without no not is show hide hides toggle".split())
SITE = frozenset("site page global main top".split())
_NAME_PART = re.compile(r"[\s_-]+")
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())

#: First words of a line that is a notice, where the page doesn't name its article.
NOTICE = re.compile(r"(?:©|\(c\)|copyright\b|all rights reserved)", re.I)

_MARK = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)", re.S)
#: What ends a tag, or opens a quoted value in it.
_IN_TAG = re.compile(r">|=\s*([\"'])")
_HEAD_END = re.compile(r"</head\s*>|<body[\s>]", re.I)
_ATTR = re.compile(r"\b(class|id|role|style|aria-hidden|hidden)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
_SPACE = re.compile(r"\s+")


@dataclass(frozen=True)
class LineBlocks:
    """Parameters: windows of ``window`` lines; a surge needs ``surge``
    characters in a window or ``part`` of the fullest, whichever is less.  Beside
    article elements, text outside them needs ``surge``; of elements and outside
    parts, what has ``piece`` of the longest belongs to the article."""

    window: int = 3
    surge: int = 80
    part: float = 0.2
    piece: float = 0.5
    over: float = 4.0


def _noun_beside(token: str) -> bool:
    """Does the class or id name a part beside the article?

    By its whole or its head noun: the last part but for layout words and
    numbers ("site-footer", "comment-list", "sidebar-2", not "search-term").
    "no-sidebar" and "has-sidebar" speak of another element; a header is
    beside by itself or as the site's ("entry-header" is the article's).
    """
    parts = [p for p in _NAME_PART.split(token) if p]
    while len(parts) > 1 and (parts[-1] in LAYOUT or parts[-1].isdigit()):
        parts.pop()
    if not parts or not BESIDE.fullmatch(parts[-1]) or len(parts) > 1 and parts[0] in ABOUT:
        return False
    return parts[-1] != "header" or len(parts) == 1 or parts[-2] in SITE


def _beside(name: str, attributes: str) -> bool:
    if name in BOILERPLATE:
        return True
    if not attributes or "=" not in attributes and "hidden" not in attributes.lower():
        return False
    for key, value in _ATTR.findall(attributes):
        key, value = key.lower(), value.strip("\"'").lower()
        if key in ("class", "id") and name not in ("html", "body", "main"):
            if any(map(_noun_beside, value.split())):
                return True
        if key == "role" and value in ROLES:
            return True
        if key == "hidden" or key == "aria-hidden" and value == "true":
            return True
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
    return False


class _Tags:
    """Where the tags of a page end.

    Only quotes after "=" hide a ">"; an unclosed quote hides none.  Where
    every later ">" seems to stand in quotes, quotes are no longer believed for
    the rest of the page, so a page is scanned a bounded number of times.
    """

    def __init__(self, page: str):
        self.page, self.quoted = page, True
        self.last = {q: page.rfind(q) for q in "\"'>"}

    def end(self, at: int) -> int:
        """Place of the ">" of the tag whose attributes begin at ``at``, or -1."""
        if at > self.last[">"]:
            return -1
        place = at
        while self.quoted:
            m = _IN_TAG.search(self.page, place)
            if m is None:
                self.quoted = False
            elif m[1] is None:
                return m.start()
            else:
                place = m.end()
                if place <= self.last[m[1]]:
                    place = self.page.find(m[1], place) + 1
        return self.page.find(">", at)


@dataclass
class _Open:
    """An open element; ``mark`` numbers it if it stands beside the article, ``article`` if it is one."""

    name: str
    mark: int = 0
    article: int = 0


@dataclass
class Line:
    """A line of a page: its text, the outermost article element around it (or 0) and the elements
    around it that stand beside the article, those outside the article element first."""

    text: str
    article: int
    outside: tuple[int, ...]
    inside: tuple[int, ...]


def lines_of(page: str) -> tuple[list[Line], dict[int, bool]]:
    """The page's lines, and which of the elements beside the article may yet hold it.

    These are elements that hold an article element, elements that nothing
    closes, and forms; False for a form that shows no other sign of wrapping a
    page (a part of the page's layout within it).

    Markup is stripped; every block element begins a new line.  Raw elements
    (scripts, styles ...) are left out whole.
    """
    out: list[Line] = []
    text: list[str] = []
    open_: list[_Open] = []
    numbered = 0
    doubtful: dict[int, bool] = {}
    count: Counter[str] = Counter()
    marks: list[tuple[int, bool]] = []   # open elements beside the article, inside the article element or not
    article = depth = articles = 0   # number of the article element, how many are open, how many there were
    tags, head_ends = _Tags(page), True
    at, end = 0, len(page)

    def close_line() -> None:
        if text:
            line = _SPACE.sub(" ", entities.unescape("".join(text))).strip()
            if line:
                out.append(Line(line, article if depth else 0, tuple(m for m, i in marks if not i), tuple(m for m, i in marks if i)))
            text.clear()

    def close(k: int) -> None:
        nonlocal depth
        for e in reversed(open_[k:]):
            count[e.name] -= 1
            if e.mark:
                marks.pop()
            depth -= e.article
        del open_[k:]

    while at < end:
        lt = page.find("<", at)
        if lt < 0:
            text.append(page[at:])
            break
        text.append(page[at:lt])
        m = _MARK.match(page, lt)
        if m is not None and m[2] is None:  # a comment or declaration
            at = m.end()
            continue
        gt = -1 if m is None else tags.end(m.end())
        if gt < 0:  # a bare sign
            text.append("<")
            at = lt + 1
            continue
        at = gt + 1
        name, closing, attributes = m[2].lower(), m[1] == "/", page[m.end():gt]
        if name in BLOCKS or name in RAW or name in BOILERPLATE:
            close_line()
        if closing:
            if count[name]:
                # what was left open inside ends with it
                k = len(open_) - 1
                while open_[k].name != name:
                    k -= 1
                close(k)
            continue
        empty = attributes.rstrip().endswith("/")
        if name in RAW and not empty:
            if name == "head":
                shut = _HEAD_END.search(page, at) if head_ends else None
                head_ends = shut is not None
                at = at if shut is None else shut.end() if shut[0][1] == "/" else shut.start()
            else:
                shut = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
                at = end if shut is None else shut.end()
            continue
        if name in VOID or empty:
            continue
        if open_ and (name in ("p", "li") and open_[-1].name == name or name in BLOCKS and open_[-1].name in SMALL):
            close(len(open_) - 1)
        is_beside, is_main = _beside(name, attributes), name in MAIN
        # an article keeps its own heading block; a comment list inside it is beside it
        if is_beside and name == "header" and depth:
            is_beside = False
        if is_beside or is_main or name in BLOCKS:
            e = _Open(name, 0, int(is_main))
            if is_main and not depth:
                articles += 1
                article = articles
                if not is_beside:
                    doubtful.update((m, True) for m, _ in marks)
            if name in LAYOUT_ELEMENTS:
                doubtful.update((m, True) for m, _ in marks if m in doubtful)
            if is_beside:
                numbered += 1
                e.mark = numbered
                if name == "form":
                    doubtful[numbered] = False
                # an article element that is itself a comment or a card stands beside
                marks.append((e.mark, depth > 0 or is_main))
            depth += is_main
            open_.append(e)
            count[name] += 1
    close_line()
    doubtful.update((m, True) for m, _ in marks)
    return out, doubtful


def _parts(length: list[int], window: int, least: int | None, params: LineBlocks) -> list[tuple[int, int]]:
    """Where the windows surge to ``least`` (or the page's own threshold) until they have fallen to 0."""
    blocks = [sum(length[i:i + window]) for i in range(len(length))]
    if least is None:
        least = max(1, min(params.surge, int(params.part * max(blocks, default=0))))
    parts, i = [], 0
    while i < len(blocks):
        if blocks[i] < least:
            i += 1
            continue
        j = i
        while j < len(blocks) and blocks[j] > 0:
            j += 1
        parts.append((i, j))
        i = j
    return parts


def _chosen(lines: list[Line], freed: set[int], params: LineBlocks) -> list[str]:
    """The lines between surges and dives, where those beside the article count 0."""
    beside = [any(m not in freed for m in x.outside + x.inside) for x in lines]
    outer = [0 if b or x.article or NOTICE.match(x.text) else len(x.text) for x, b in zip(lines, beside)]
    inner = [len(x.text) if x.article and not b else 0 for x, b in zip(lines, beside)]
    length, least = outer, None
    if any(inner):
        element: Counter[int] = Counter()
        for x, n in zip(lines, inner):
            element[x.article] += n
        outside = [(i, j, sum(outer[i:j])) for i, j in _parts(outer, params.window, params.surge, params)]
        longest, fullest = max(element.values()), max((n for _, _, n in outside), default=0)
        if fullest <= longest:
            length, least = list(inner), 1
            for i, j, n in outside:
                if n >= params.piece * longest:
                    length[i:j] = map(max, inner[i:j], outer[i:j])
        else:
            length = [n if element[x.article] < params.piece * fullest else max(n, m) for x, n, m in zip(lines, outer, inner)]
    return [lines[k].text for i, j in _parts(length, params.window, least, params) for k in range(i, j) if length[k]]


def main_text(page: str | None, params: LineBlocks = LineBlocks()) -> str:
    """The article: lines between the points where the line-block lengths surge and dive.

    The length of a line counts in every window of ``window`` lines that holds
    it; lines beside the article count 0.  A part begins where a window reaches
    the threshold and ends where the windows have fallen to 0; lines of length
    0 inside a part are left out, all others are kept.

    Article elements are a hint that the windows confirm.  If no part outside
    them is longer than the longest element, a line inside begins a part
    whatever its length, and outside lines count only in parts of ``piece`` of
    that length.  Otherwise the outside is the article, and elements shorter
    than ``piece`` of its longest part are cards or comments and count 0.

    A form, an element that nothing closes, or one that holds an article
    element is no longer beside the article where it alone holds text that
    surges (a form without any of a page's layout: as much as surges in each
    line of a window) and is ``over`` times as long as all that the windows find without
    it: a page wrapped in a form, or an article behind an unclosed sidebar.
    """
    if not page:
        return ""
    lines, doubtful = lines_of(page)
    freed: set[int] = set()
    while True:
        text = " ".join(_chosen(lines, freed, params))
        held: Counter[int] = Counter()
        for x in lines:
            own = {m for m in x.outside + x.inside if m not in freed}
            if own and own <= doubtful.keys():
                held.update(dict.fromkeys(own, len(x.text)))
        most = max(held, key=lambda m: (held[m], -m), default=None)
        if most is None or held[most] < max(params.surge * (1 if doubtful[most] else params.window), params.over * len(text)):
            return text
        freed.add(most)


def _extract(params: LineBlocks):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            texts = [main_text(h, params).encode("utf-8", "ignore").decode("utf-8") for h in f["html"]]
            yield pd.DataFrame({"page_id": f["page_id"], "url": f["url"], "text": texts, "n_chars": list(map(len, texts))})
    return run


def extract_text(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                 params: LineBlocks = LineBlocks()) -> DataFrame:
    """``id_col, url_col, text, n_chars`` of every page; each page on its own.

    Character references are decoded, white space inside a block becomes one
    space, and blocks are joined in page order by one space.  Defined cases: a
    null, empty or textless page gives an empty text with 0 characters; markup
    that is never closed ends with the page; null and repeated ids and other
    columns play no part; an empty table gives an empty result.
    """
    # ids travel as text: a null among long numbers would make them floating
    rows = df.select(F.col(id_col).cast("string").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                     F.col(html_col).alias("html"))
    out = rows.mapInPandas(_extract(params), "page_id string, url string, text string, n_chars long")
    return out.select(F.col("page_id").cast("long").alias(id_col), F.col("url").alias(url_col), "text", "n_chars")
