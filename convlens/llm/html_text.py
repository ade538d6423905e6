"""Main text of web pages by line-block distribution.

Markup is stripped to lines, one per block element. Lines of menus, page headers and footers, sidebars, notices, adverts, forms and
reader comments (known by element, role, class or id, or, outside an article, by consisting of links) are blanked, so
they stay as valleys, but for clutter between two text blocks of its own container or of containers inside that, which leaves none. The text lengths are
summed over a sliding window of lines. A text region begins where the window sum leaves zero and surges, and ends where
it dives back to zero; of the regions those are kept whose peak is not far below the page's median block. Between surge
and dive every line is kept, however short. Where a page marks its article (or main part) and the marked part holds at
least a third of the text, only regions inside it compete and marked clutter inside it leaves no valley.

Outside an article, a line that is mostly link text is clutter if it is no heading, and no paragraph that stands alone among others.
If what is left is a small part of one blanked element that is not the readers' comments (a page wrapped in a form or a widget, or in
a menu that is never closed), that element is opened and the page is read again.

Clutter is named by whole tokens of class and id: a clutter word, or one joined only with words of layout. An id alone never
drops a heading or an article, nor a section in an article, nor anything by a word that also titles a section.

Defined results: null, empty and text-free pages give an empty text; an element that is never closed ends with the page (or, for
paragraphs and list items, with the next block); a ``<`` that opens no tag is text; other columns are carried along.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructType

# fixed values: element names and words in class, id and role that name clutter
_RAW = "script|style|noscript|template|svg|math|iframe|object|canvas|title|textarea|select|audio|video"
CLUTTER_ELEMENTS = frozenset("nav footer aside form menu dialog button fieldset datalist head".split())
CLUTTER_WORDS = frozenset((
    "ad ads advert adverts advertisement adsense advertising banner sponsor sponsored promo promotion sidebar side comment comments "
    "respond reply replies discussion disqus cookie cookies consent notice notices alert warning gdpr menu nav navbar navigation topnav "
    "breadcrumb breadcrumbs share sharing social related recommended newsletter subscribe subscription signup login popup modal overlay "
    "footer footnav header masthead topbar toolbar pagination pager copyright legal disclaimer widget hidden").split())
CLUTTER_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())
BLOCKS = frozenset((
    "address article aside blockquote body center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul "
    "dir caption dialog").split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# elements that hold blocks of their own; open ones tell which blocks are neighbours
CONTAINERS = BLOCKS - HEADINGS - frozenset("p li dd dt hr option summary legend figcaption caption address pre".split())
# words of layout, which joined with a clutter word name clutter still, and clutter words that title sections as well
LAYOUT_WORDS = frozenset((
    "area bar bars block blocks bottom box boxes button buttons container content form global group holder inner item items left "
    "link links list main outer page panel primary right secondary section site slot text thread title top unit wrap wrapper").split())
COMPOUNDS = frozenset("visually-hidden disqus_thread".split())
TITLE_WORDS = frozenset((
    "alert banner copyright discussion disclaimer legal notice notices recommended related replies reply respond share sharing "
    "social warning").split())
COMMENT_WORDS = frozenset("comment comments respond reply replies discussion disqus disqus_thread".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({_RAW})\b[^>]*+>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|<[!?][^>]*+>|<[!/a-zA-Z][^>]*+\Z",
    re.DOTALL | re.IGNORECASE)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_PARTS, _CAMEL = re.compile(r"[^a-z0-9]+"), re.compile(r"(?<=[a-z])(?=[A-Z])")

Line = tuple[str, bool, int]  # text, inside the article, its container


def _attributes(raw: str) -> dict[str, str]:
    """Names and values; of a name given twice the first counts."""
    out: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(raw):
        out.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    return out


def _names_clutter(token: str, but: frozenset[str]) -> bool:
    whole = token.lower()
    if whole in CLUTTER_WORDS or whole in COMPOUNDS:
        return whole not in but
    parts = [w for w in _PARTS.split(_CAMEL.sub("-", token).lower()) if w]
    words = [w for w in parts if w in CLUTTER_WORDS and w != "hidden"]
    return any(w not in but for w in words) and all(w in CLUTTER_WORDS - {"hidden"} or w in LAYOUT_WORDS or w.isdigit() for w in parts)


def _is_clutter(name: str, attributes: str, inside: bool) -> bool:
    if name in CLUTTER_ELEMENTS or (name == "header" and not inside):
        return True
    if not attributes or name in ("html", "body", "main"):
        return False
    values = _attributes(attributes)
    if "hidden" in values or values.get("aria-hidden", "").lower() == "true":
        return True
    if any(x in CLUTTER_ROLES for x in values.get("role", "").lower().split()):
        return True
    # an article's own header holds its title
    but = frozenset(("header",)) if inside else frozenset()
    if any(_names_clutter(x, but) for x in values.get("class", "").split()):
        return True
    if name == "article" or name in HEADINGS or (inside and name == "section"):
        return False
    return any(_names_clutter(x, but | TITLE_WORDS) for x in values.get("id", "").split())


class Reading:
    """One pass over a page. ``found``: its lines, where a number is a line of clutter, by its container, or -1 the edge of an article; ``parent``: the
    container around each container; ``blanked``: by its place, how much text in paragraphs each
    blanked element holds, if it may be opened."""

    def __init__(self, page: str, open_: frozenset[int] = frozenset()):
        self.found: list[Line | int] = []
        self.parent = [0]
        self.blanked: dict[int, int] = {}
        self._read(page, open_)

    def inside(self, container: int, outer: int) -> bool:
        while container > outer:  # a container is opened after those around it
            container = self.parent[container]
        return container == outer

    def _read(self, page: str, open_: frozenset[int]) -> None:
        out = self.found
        path: list[tuple[str, int]] = [("", 0)]
        places: dict[str, list[int]] = {}  # of each name, where it is in the path
        text: list[str] = []
        linked = total = 0
        in_link, article, skip, skipped, skip_at, prose, block = False, 0, "", 0, -1, False, ""
        linky: list[tuple[int, Line, bool]] = []  # lines of links: place, line, whether it is a paragraph

        def flush() -> None:
            nonlocal linked, total
            line = " ".join(html.unescape("".join(text)).split())
            if line:
                row = (line, article > 0, path[-1][1])
                if not article and 2 * linked > total and block not in HEADINGS:
                    linky.append((len(out), row, block == "p"))
                    out.append(path[-1][1])
                else:
                    out.append(row)
            text.clear()
            linked = total = 0

        def add(piece: str) -> None:
            nonlocal linked, total
            text.append(piece)
            n = len(piece) - piece.count(" ")
            total += n
            linked += n if in_link else 0

        at = 0
        for m in _TOKEN.finditer(page):
            if m.start() > at:
                if not skip:
                    add(page[at:m.start()])
                elif prose and skip_at in self.blanked:
                    self.blanked[skip_at] += m.start() - at
            at = m.end()
            name = (m[3] or m[6] or "").lower()
            if not name:
                continue
            closing, attributes = bool(m[2] or m[5]), m[4] or m[7] or ""
            if skip:
                if name in BLOCKS:
                    prose = name == "p" and not closing
                if name == skip:
                    skipped += -1 if closing else (0 if name in ("p", "li") else 1)
                    if not closing and name in ("p", "li"):
                        skipped = 0
                elif skip == "p" and name in BLOCKS or skip == "li" and closing and name in ("ul", "ol"):
                    skipped = 0
                if skipped > 0:
                    continue
                was, skip = skip, ""
                if closing and name == was:
                    continue
            if (name not in VOID and not closing and m.start() not in open_ and _is_clutter(name, attributes, article > 0)
                    and not attributes.rstrip().endswith("/")):
                flush()
                if not article:
                    out.append(path[-1][1])
                skip, skipped, skip_at, prose = name, 1, m.start(), False
                if not COMMENT_WORDS & set(_PARTS.split(attributes.lower())):
                    self.blanked[skip_at] = 0
                continue
            if name == "a":
                in_link = not closing
            elif name == "br":
                text.append(" ")
            elif name in BLOCKS:
                flush()
                in_link = False
                block = "" if closing else name
                if name in ("article", "main"):
                    was_in, article = article, max(0, article + (-1 if closing else 1))
                    if not (was_in and article):  # the outermost one's edge
                        out.append(-1)
                if name in CONTAINERS:
                    if not closing:
                        self.parent.append(path[-1][1])
                        places.setdefault(name, []).append(len(path))
                        path.append((name, len(self.parent) - 1))
                    elif places.get(name):
                        k = places[name][-1]
                        while len(path) > k:
                            places[path.pop()[0]].pop()
        if not skip and at < len(page):
            add(page[at:])
        elif skip and prose and skip_at in self.blanked:
            self.blanked[skip_at] += len(page) - at
        flush()
        # a paragraph of links that stands alone is text
        spots = {i for i, _, _ in linky}
        for i, row, paragraph in linky:
            if paragraph and not {i - 1, i + 1} & spots:
                out[i] = row


def main_text(page: str | None, window: int = 3, share: float = 0.3, part: float = 0.2) -> str:
    """The page's main text, its blocks joined by line feeds."""
    page, open_ = page or "", frozenset()
    while True:
        read = Reading(page, open_)
        text = _text(read, window, share)
        largest = max(read.blanked, key=read.blanked.get, default=-1)
        # the text in between is little beside the element: it holds the page
        if largest < 0 or len(text) >= part * read.blanked[largest] or not read.blanked[largest] or len(open_) >= 8:
            return text
        open_ |= {largest}


def _text(read: Reading, window: int, share: float) -> str:
    found = read.found
    size = [0, 0]
    for x in found:
        if isinstance(x, tuple):
            size[x[1]] += len(x[0])
    if size[1] and 2 * size[1] >= size[0]:
        found = [x if isinstance(x, tuple) and x[1] else -1 for x in found]
    # a valley is as wide as the window, so that window sums reach zero in it
    spread: list[str] = []
    before, valley = -1, []
    for x in found:
        if not isinstance(x, tuple):
            valley.append(x)
            continue
        if any(v < 0 or before < 0 or not (read.inside(before, v) and read.inside(x[2], v)) for v in valley):
            spread.extend([""] * window)
        valley.clear()
        spread.append(x[0])
        before = x[2]
    length = [len(x) for x in spread]
    sums = [sum(length[i:i + window]) for i in range(len(length))]
    regions, start = [], None
    for i, n in enumerate(length + [0] * window):
        dive = sum(length[i:i + window]) == 0
        if start is None and n:
            start = i
        elif start is not None and dive:
            regions.append((max(sums[start:i]), start, i))
            start = None
    if not regions:
        return ""
    block = sorted(n for n in length if n)
    least = share * block[(len(block) - 1) // 2]
    return "\n".join(x for peak, a, b in regions if peak >= least for x in spread[a:b] if x)


def extract(df: DataFrame, html_col: str = "html", text_col: str = "text", chars_col: str = "n_chars", window: int = 3,
            share: float = 0.3) -> DataFrame:
    """``df`` without the markup, with the main text of the whole page and its length in code points."""
    rest = [c for c in df.columns if c != html_col]
    if clash := {text_col.lower(), chars_col.lower()} & {c.lower() for c in rest}:
        raise ValueError(f"columns {sorted(clash)} exist already; pass other names")
    at = df.columns.index(html_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py(), window, share) for x in batch.column(at)]
            kept = [c for i, c in enumerate(batch.columns) if i != at]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                                             [*rest, text_col, chars_col])

    return df.mapInArrow(run, StructType(list(df.drop(html_col).schema.fields)).add(text_col, StringType()).add(chars_col, LongType()))
