"""Main text of web pages by composite text density.

A tolerant tokeniser builds the tree of a page (implied ends of p, li, td and the like; raw text elements are skipped whole).
Elements that are page furniture by their tag, role or `hidden`, and those whose class or id consists of names of other voices
(comments, notices, adverts, sidebars, ...), are set aside, as such text can be as dense as an article.
For every remaining node the composite text density is characters per tag, times a logarithm that falls to zero as characters
and tags are links and whose base grows with the share of linked characters. The node with the largest sum of its children's
densities is the core. Walking from the body down to it, the least density on the path is the threshold: parts beside the path
belong to the article if they are as dense, headings also where a lighter container holds them. An <article> or <main> around the
core is taken whole, and further <article>s that are as dense. Inside what is taken density decides again: parts below the threshold
(or without links far below it) whose names hint at furniture (share, related, menu, ...) are left out, and so are parts that are
links for the most part, inside <article> and <main> only with or within such a name: an article's references and linked words are
its own. Inside an <article> an id is a place to link to and names another voice only if that is the readers'; headings are
never judged by name, and a header stays that holds the first heading of its article.

Blocks (p, li, h1, tr, ...) become lines: character references decoded, white space of any kind turned into single spaces,
trimmed; br and table cells separate words, not blocks. Nothing is dropped or cut by length. One pass without a shuffle.

Edge cases: null and empty pages and pages of furniture only give an empty text; unclosed, crossed or stray tags, unclosed
comments, attributes with > in quotes and bare < are read as browsers do, or nearly so; nesting of any depth works; plain text
is its own article; repeated rows repeat; other columns are ignored, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TOKEN = re.compile(
    r"""<!--(?:.*?-->|.*\Z)|<[!?][^>]*+(?:>|\Z)|</(?P<end>[a-zA-Z][^\s/>]*+)[^>]*+(?:>|\Z)"""
    r"""|<(?P<start>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)(?:>|\Z)|<(?P<loose>[a-zA-Z][^\s/>]*+)[^>]*+(?:>|\Z)""",
    re.S,
)
ATTR = re.compile(r"""([a-zA-Z][\w:-]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template svg math".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html "
    "legend li main menu nav ol optgroup option p pre section select summary table tbody tfoot thead tr ul video audio canvas object".split()
)
CLOSES_P = BLOCKS - {"option", "optgroup", "tr", "tbody", "thead", "tfoot", "caption", "body", "html", "head", "legend", "video", "audio", "canvas", "object"}
#: A start tag ends these open elements, searched up to the given borders.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
    "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot"}, {"table"}), "tfoot": ({"tbody", "thead", "tfoot"}, {"table"}),
}
P_BORDERS = frozenset("td th table caption button object html body".split())
FURNITURE = frozenset("head nav footer aside form button select input dialog menu header".split())
WHOLE = frozenset("html body main article".split())
ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar toolbar status".split())
#: Names, as parts of a class or id, of text that others wrote or that is about the site, dense or not.
OTHERS = re.compile(
    r"ads?|advert\w*|sponsor\w*|promo\w*|sidebars?|nav|navbar|navigation|menus?|breadcrumbs?|footer|header|masthead|cookies?|notices?|alerts?|consent|gdpr|popup|modal"
    r"|newsletter|subscri\w*|comments?|commentlist|disqus|respond|replies|login|signup|disclaimer|copyright"
)
#: Those of them that are readers' voices.
READERS = re.compile(r"comments?|commentlist|disqus|respond|replies")
#: Names that hint at furniture; these parts go only if they are less dense than the article.
HINTS = re.compile(OTHERS.pattern + r"|banner|more|share|sharing|social|related|recommend\w*|reply|widgets?|pagination|pager|toolbar|skip")
#: Parts of names that say nothing.
PLAIN_PARTS = frozenset("list box container wrapper wrap section bar area block item items link links button buttons top bottom left right inner outer form post posts page site global content body text thread panel unit slot group row col column main".split())
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
#: Below this share of the threshold a part with links is a list of links, and one with a furniture name is furniture.
LINKED = 0.1
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())


class Page:
    """The tree: parallel lists by node number, parents before children; texts hold (node, text) and block borders in page order."""

    def __init__(self, html: str):
        self.tag, self.parent, self.attrs = ["#root"], [-1], [""]
        self.pieces: list[tuple[int, str | None]] = []  # None: a border between words
        self._read(html)

    def _open(self, name: str, attrs: str, at: int) -> int:
        self.tag.append(name)
        self.parent.append(at)
        self.attrs.append(attrs)
        return len(self.tag) - 1

    def _read(self, html: str) -> None:
        stack, opened, pos = [0], {}, 0

        def close_to(depth: int) -> None:
            while len(stack) > depth:
                opened[self.tag[stack.pop()]] -= 1

        def close_nearest(names, borders) -> None:
            if not any(opened.get(n) for n in names):
                return
            for depth in range(len(stack) - 1, 0, -1):
                name = self.tag[stack[depth]]
                if name in names:
                    return close_to(depth)
                if name in borders:
                    return

        while pos < len(html):
            m = TOKEN.search(html, pos)
            text = html[pos : m.start() if m else len(html)]
            if text:
                self.pieces.append((stack[-1], unescape(text) if "&" in text else text))
            if not m:
                break
            pos = m.end()
            if end := m["end"]:
                end = end.lower()
                if opened.get(end):
                    for depth in range(len(stack) - 1, 0, -1):
                        if self.tag[stack[depth]] == end:
                            close_to(depth)
                            break
                elif end in ("br", "p"):
                    self.pieces.append((stack[-1], None))
                continue
            name = m["start"] or m["loose"]
            if not name:
                continue
            name, attrs = name.lower(), m["attrs"] or ""
            if name in CLOSES_P:
                close_nearest({"p"}, P_BORDERS)
            if name in HEADINGS and self.tag[stack[-1]] in HEADINGS:
                close_to(len(stack) - 1)
            if name in IMPLIED:
                close_nearest(*IMPLIED[name])
            if name in VOID:
                node = self._open(name, attrs, stack[-1])
                if name in ("br", "hr"):
                    self.pieces.append((node if name == "hr" else stack[-1], None))
            elif name in RAW:
                end = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(html, pos)
                pos = end.end() if end else len(html)
                self._open(name, attrs, stack[-1])
            elif name in ("html", "body") and opened.get(name):
                continue
            elif not attrs.endswith("/") or name in BLOCKS:
                node = self._open(name, attrs, stack[-1])
                stack.append(node)
                opened[name] = opened.get(name, 0) + 1
                if name in ("td", "th"):
                    self.pieces.append((node, None))


def _names(attrs: str, in_article: bool) -> tuple[bool, bool]:
    """Whether one of the classes or the id consists of names of other voices, and whether one has a part that hints at furniture."""
    others = hint = False
    for name, value in ATTR.findall(attrs):
        if name.lower() in ("class", "id"):
            voices = READERS if in_article and name.lower() == "id" else OTHERS
            for token in value.strip("\"'").split():
                parts = [p.lower() for p in NAME_PART.findall(token)]
                named = [p for p in parts if voices.fullmatch(p)]
                others |= bool(named) and all(p in PLAIN_PARTS or HINTS.fullmatch(p) for p in parts)
                hint |= any(HINTS.fullmatch(p) for p in parts)
    return others, hint


def _titled(page: Page) -> set[int]:
    """Headers that hold the first heading of the <article> or <main> they stand in."""
    n = len(page.tag)
    article, first = [0] * n, {}
    for i in range(1, n):
        up = page.parent[i]
        article[i] = up if page.tag[up] in ("article", "main") else article[up]
        if page.tag[i] in HEADINGS and article[i]:
            first.setdefault(article[i], i)
    out = set()
    for i in first.values():
        while page.tag[i] not in ("article", "main"):
            if page.tag[i] == "header":
                out.add(i)
            i = page.parent[i]
    return out


def _set_aside(page: Page) -> tuple[list[bool], list[bool]]:
    """Whether a node is page furniture or lies in some, and whether its name hints at that."""
    n = len(page.tag)
    has_h1, in_article, inside = [False] * n, [False] * n, [False] * n
    for i in range(n - 1, 0, -1):
        has_h1[i] |= page.tag[i] == "h1"
        has_h1[page.parent[i]] |= has_h1[i]
    out, hints, titled = [False] * n, [False] * n, _titled(page)
    for i in range(1, n):
        up, tag = page.parent[i], page.tag[i]
        in_article[i] = in_article[up] or tag in ("article", "main")
        inside[i] = inside[up] or tag == "article"
        if out[up] or tag in RAW:
            out[i] = True
            continue
        own_header = tag == "header" and in_article[up] and (has_h1[i] or i in titled)
        bad = tag in FURNITURE and not own_header
        if page.attrs[i] and tag not in WHOLE and not bad:
            if tag not in HEADINGS:
                others, hints[i] = _names(page.attrs[i], inside[up])
                bad = others and not has_h1[i]
            for name, value in ATTR.findall(page.attrs[i]):
                name, value = name.lower(), value.strip("\"'")
                if name == "role":
                    bad |= value.lower() in ROLES
                elif name == "hidden" or name == "aria-hidden" and value.lower() == "true":
                    bad = True
            hints[i] &= not has_h1[i]
        out[i] = bad
    return out, hints


def densities(page: Page, aside: list[bool]) -> tuple[list[float], list[float], list[bool]]:
    """Composite density of each node, the sum of its children's, and whether a node has linked characters."""
    n = len(page.tag)
    chars, tags, link_chars, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
    linked = [False] * n
    for i in range(1, n):
        linked[i] = linked[page.parent[i]] or page.tag[i] == "a"
    for node, text in page.pieces:
        if text and not aside[node]:
            c = len(" ".join(text.split()))
            chars[node] += c
            link_chars[node] += c * linked[node]
    for i in range(n - 1, 0, -1):
        if not aside[i]:
            up = page.parent[i]
            chars[up] += chars[i]
            link_chars[up] += link_chars[i]
            tags[up] += tags[i] + 1
            link_tags[up] += link_tags[i] + linked[i]
    body = next((i for i in range(n) if page.tag[i] == "body"), 0)
    body_share = link_chars[body] / max(1, chars[body])
    own, sums = [0.0] * n, [0.0] * n
    for i in range(n - 1, -1, -1):
        if chars[i] and not aside[i]:
            c, t, lc, lt = chars[i], max(1, tags[i]), max(1, link_chars[i]), max(1, link_tags[i])
            base = math.log(c / max(1, c - lc) * lc + body_share * c + math.e)  # above 1
            own[i] = c / t * max(0.0, math.log(c / lc * t / lt)) / math.log(base)
            if i:
                sums[page.parent[i]] += own[i]
    return own, sums, [x > 0 for x in link_chars]


def content_nodes(page: Page, aside: list[bool], hints: list[bool]) -> list[bool]:
    own, sums, links = densities(page, aside)
    n = len(page.tag)
    core = max(range(n), key=lambda i: (sums[i], own[i], -i)) if any(sums) else 0
    path = [core]
    while path[-1]:
        path.append(page.parent[path[-1]])
    threshold = min((own[i] for i in path if own[i] and page.tag[i] not in ("#root", "html")), default=0.0)
    semantic = [i for i in path if page.tag[i] in ("article", "main")]
    taken, hinted = [False] * n, hints[:]
    taken[semantic[-1] if semantic else core] = True
    on_path = set(path)
    for i in range(1, n):
        up = page.parent[i]
        inside = taken[up]
        taken[i] |= inside
        hinted[i] |= hinted[up]
        if i in on_path or aside[i]:
            aside[i] |= aside[up]
            continue
        if not semantic and up in on_path and not inside:
            taken[i] = page.tag[i] in HEADINGS or own[i] >= threshold
        elif semantic and not inside and page.tag[i] == "article":
            taken[i] = own[i] >= threshold > 0
        listed = links[i] and page.tag[i] in BLOCKS and page.tag[i] not in HEADINGS and (hinted[i] or not semantic)
        if taken[i] and (hints[i] and own[i] < (1 if links[i] else LINKED) * threshold or listed and own[i] < LINKED * threshold):
            taken[i], aside[i] = False, True
    return taken


def main_text(html: str | None) -> str:
    """The article's text, one block a line."""
    if not html:
        return ""
    page = Page(html)
    aside, hints = _set_aside(page)
    taken = content_nodes(page, aside, hints)
    block = [0] * len(page.tag)  # the block that a node's text belongs to
    for i in range(1, len(page.tag)):
        block[i] = i if page.tag[i] in BLOCKS else block[page.parent[i]]
    lines: list[str] = []
    parts: list[str] = []
    last = -1

    def end_block() -> None:
        if line := " ".join("".join(parts).split()):
            lines.append(line)
        parts.clear()

    for node, text in page.pieces:
        if block[node] != last:
            end_block()
            last = block[node]
        if taken[node] and not aside[node]:
            parts.append(" " if text is None else text)
    end_block()
    return "\n".join(lines)


@F.arrow_udf(T.StringType())
def extract(html: pa.Array) -> pa.Array:
    return pa.array((main_text(x.as_py()) for x in html), pa.string())


def page_texts(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", "url", extract(F.col("html")).alias("text")).withColumn("n_chars", F.length("text").cast("long"))
