"""Main text of web pages by line-block distribution.

Markup is stripped so that every block-level element gives a line.  A line
weighs as much as its text is long: marked boilerplate weighs nothing, links
count in paragraphs and headings only, and where the page marks an article,
lines outside weigh less the more the article outweighs them.  The main text
lies where the weights of three lines together surge above a level set by the
page's own distribution until they dive below it.  Paragraphs and headings are
text wherever they stand, as are the lines of an article that outweighs the rest.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Lines of one window.
WINDOW = 3
#: The level of a surge: this share of the window that half of the page's text lies in or above, SURGE characters at most.
SURGE_SHARE, SURGE = 0.25, 80

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"""
    r"""|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
    r"""|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*+)(?P<attrs2>[^>]*+)(?:>|\Z)""", re.S)
ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea template noscript iframe noembed noframes xmp".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
    figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre
    search section select summary table tbody td tfoot th thead tr ul""".split())
#: Elements whose end tag may be left out: opening one closes an open one of the group.
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
            "option": {"option"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}
SECTIONS = frozenset("article section main div body".split())
BOILER_TAGS = frozenset("nav footer aside form menu dialog button select object svg canvas head search".split())
BOILER_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
BOILER_NAMES = frozenset("""ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion cookie
    cookies consent gdpr notice notices notification popup modal overlay newsletter subscribe subscription signup login nav navbar
    navigation menu breadcrumb breadcrumbs sidebar aside widget related recommended share sharing social comment comments
    disqus reply replies respond footer copyright header masthead toolbar pagination pager""".split())
#: Class names that say what a page has, or that are the article's own, though a word of theirs names boilerplate.
FLAGS = frozenset("has with without no is not js".split())
OWN_PARTS = frozenset("article post entry story section".split())      # article-header: its title
FRAMES = frozenset("sidebar header nav widget banner masthead".split())     # sidebar-layout: all of the page
WHOLES = frozenset("layout page template article post entry".split())
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 pre blockquote".split())


class Line(NamedTuple):
    text: str
    marked: bool        # inside the marked article
    boiler: bool
    links: int          # characters in links
    paragraph: bool     # in a paragraph or heading


def _names_boiler(word: str) -> bool:
    """Does a class or id name boilerplate?  As a whole first, then by its parts."""
    if word in BOILER_NAMES:
        return True
    parts = [p for p in re.split(r"[^a-z]+", word) if p]
    if len(parts) > 1:
        if parts[0] in FLAGS or parts[-1] == "header" and parts[0] in OWN_PARTS or parts[0] in FRAMES and parts[-1] in WHOLES:
            return False
    return any(p in BOILER_NAMES for p in parts)


def _boiler(name: str, attrs: str, in_article: bool) -> bool:
    if name in BOILER_TAGS or name == "header" and not in_article:
        return True
    if not attrs or name in ("html", "body", "article", "main"):
        return False
    for key, a, b, c in ATTR.findall(attrs):
        key, value = key.lower(), (a or b or c).lower()
        if key == "hidden" or key == "role" and value in BOILER_ROLES:
            return True
        if key in ("class", "id") and any(map(_names_boiler, value.split())):
            return True
    return False


def lines(page: str) -> list[Line]:
    """The page's blocks in order, each with its text in single spaces."""
    out: list[Line] = []
    text: list[str] = []
    stack: list[tuple[str, bool, bool]] = []    # name, boilerplate, article
    places: dict[str, list[int]] = {}           # where in the stack elements of a name are
    links = depth_boiler = depth_article = 0
    in_link = depth_paragraph = 0

    def close_line():
        nonlocal links
        if text:
            t = " ".join(entities.unescape("".join(text)).split())
            if t:
                out.append(Line(t, depth_article > 0, depth_boiler > 0, links, depth_paragraph > 0))
            text.clear()
        links = 0

    def pop(n: int):
        nonlocal depth_boiler, depth_article, in_link, depth_paragraph
        while len(stack) > n:
            name, boiler, article = stack.pop()
            places[name].pop()
            depth_paragraph -= name in PARAGRAPHS
            depth_boiler -= boiler
            depth_article -= article
            in_link -= name == "a"

    def last(names) -> int:
        return max((p[-1] for x in names if (p := places.get(x))), default=-1)

    def find(names, stop=frozenset()) -> int | None:
        i = last(names)
        return i if i >= 0 and i >= last(stop) else None

    def add(s: str):
        nonlocal links
        text.append(s)
        if in_link:
            links += len(s)

    at, n = 0, len(page)
    while at < n:
        m = TOKEN.search(page, at)
        if m is None:
            add(page[at:])
            break
        if m.start() > at:
            add(page[at:m.start()])
        at = m.end()
        name = m["name"] or m["name2"]
        if name is None:
            continue
        name = name.lower()
        if m["end"] or m["end2"]:
            if name in BLOCK:
                close_line()
            i = find({name})
            if i is not None:
                pop(i)
            continue
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else n
            continue
        if name == "br" or name == "wbr":
            add(" " if name == "br" else "")
            continue
        if name in BLOCK:
            close_line()
            i = find({"p"}, SECTIONS | {"button", "table", "td", "th"})
            if i is not None:
                pop(i)
            if name in SIBLINGS and (i := find(SIBLINGS[name], SCOPES[name])) is not None:
                pop(i)
        if name in VOID:
            continue
        attrs = m["attrs"] or m["attrs2"] or ""
        if attrs.endswith("/") and name not in BLOCK:
            continue
        article = name in ("article", "main")
        boiler = _boiler(name, attrs, depth_article > 0)
        places.setdefault(name, []).append(len(stack))
        stack.append((name, boiler, article))
        depth_paragraph += name in PARAGRAPHS
        depth_boiler += boiler
        depth_article += article
        in_link += name == "a"
    close_line()
    return out


def _windows(weight: list[float]) -> list[float]:
    return [sum(weight[max(0, i):i + WINDOW]) for i in range(1 - WINDOW, len(weight))]


def _level(weight: list[float]) -> float:
    """The level of a surge: by the windows' sums, each line counting by its weight."""
    sums = _windows(weight)
    best = sorted((max(sums[i:i + WINDOW]), w) for i, w in enumerate(weight) if w)
    half, total = sum(w for _, w in best) / 2, 0.0
    for s, w in best:
        total += w
        if total >= half:
            return min(SURGE, SURGE_SHARE * s)
    return 0.0


def main_text(page: str | None) -> str:
    """The page's main text, one block per line; empty if there is none.
    An article marked inside boilerplate (an advert's) doesn't count as one;
    marked articles lighter than the text outside them (teasers) are lines like
    any other."""
    if not page:
        return ""
    rows = lines(page)
    plain = [0 if r.boiler else len(r.text) if r.paragraph else max(0, len(r.text) - r.links) for r in rows]
    inside = sum(len(r.text) for r in rows if r.marked and not r.boiler)
    outside = sum(w for w, r in zip(plain, rows) if not r.marked)
    scale = min(1.0, outside / inside) if inside else 1.0
    article = [r.marked and not r.boiler and scale < 1 for r in rows]
    weight = [0 if a else scale * w for w, a in zip(plain, article)]
    level = _level([len(r.text) if a else w for w, a, r in zip(weight, article, rows)])
    text = [False] * len(rows)
    for i, s in enumerate(_windows(weight)):        # from each surge to the dive
        if s >= level:
            for k in range(max(0, i + 1 - WINDOW), min(i + 1, len(rows))):
                text[k] = True
    return "\n".join(r.text for r, t, a, w in zip(rows, text, article, weight) if a or w and (t or r.paragraph and scale == 1))


@F.arrow_udf(T.StringType())
def _texts(pages: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in pages:
        yield pa.array([main_text(x.as_py()) for x in batch], pa.string())


def extract(df: DataFrame, html: str = "html", out: str = "text") -> DataFrame:
    """Adds ``out``: the main text of the whole page.

    A null or empty page and one without main text give an empty text, never
    null.  White space inside a block becomes one space, blocks are joined by
    a line feed, character references are decoded (as HTML 5 does without a
    semicolon, too).  Unclosed comments and scripts reach to the page's end.
    Repeated rows stay; an input column called ``out``, in any case, is
    replaced; no rows give no rows.
    """
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() != out.lower()]
    return df.select(*kept, _texts(F.col(f"`{html}`")).alias(out))
