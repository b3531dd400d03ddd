"""Files of many formats to markdown.

A document is a list of chapters, a chapter a title and blocks, and one renderer writes them all. Office and e-book formats are
read from their zip archives with the standard library. A converter sees bytes and a name, so executors need no local files;
files that cannot be read become rows with an error and never stop a job.

`parity` in html_blocks keeps an older behaviour in which the texts of list items are lost (see there)."""

from __future__ import annotations

import csv
import io
import os
import re
import shutil
import subprocess
import tempfile
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser
from itertools import groupby
from posixpath import dirname, join, normpath

from pyspark.sql import DataFrame


@dataclass
class Block:
    kind: str  # h1..h4, p, li, quote, code, rule, caption, th, tr
    text: str = ""
    level: int = 0
    order: int = 0  # of a numbered item, 0 for a bullet
    cells: list[str] = field(default_factory=list)


@dataclass
class Chapter:
    title: str
    blocks: list[Block] = field(default_factory=list)


@dataclass
class Document:
    title: str
    form: str
    name: str
    chapters: list[Chapter] = field(default_factory=list)
    author: str = ""
    description: str = ""
    language: str = ""

    def open(self, title: str) -> Chapter:
        self.chapters.append(Chapter(title))
        return self.chapters[-1]


# ---- rendering


def clean(text: str) -> str:
    text = re.sub(r"\n{3,}", "\n\n", re.sub(r"\r\n|\r", "\n", text or ""))
    return re.sub(r"[ \t]+", " ", text).strip().replace("|", "\\|")


def yaml_text(text: str) -> str:
    return text.replace('"', '\\"').replace("\n", " ")


def render_table(rows: list[Block]) -> str:
    """A markdown table; without a header row the first row is the header. Short rows are filled up."""
    rows = sorted(rows, key=lambda b: b.kind != "th")
    wide = max((len(r.cells) for r in rows), default=0)
    heads = [r for r in rows if r.kind == "th"]
    lines = [[clean(c) for c in r.cells] + [""] * (wide - len(r.cells)) for r in [*(heads[:1] or []), *(r for r in rows if r.kind == "tr")]]
    lines.insert(1, ["---"] * wide)
    return "\n".join("| " + " | ".join(x) + " |" for x in lines)


def render_block(b: Block) -> str:
    t = clean(b.text)
    if b.kind[0] == "h" and b.kind[1:].isdigit():
        return "#" * int(b.kind[1:]) + " " + t
    if b.kind == "li":
        return "  " * b.level + (f"{b.order}. " if b.order else "- ") + t
    return {"p": t, "quote": "\n".join(f"> {x}" for x in t.splitlines()), "code": f"```\n{b.text}\n```", "rule": "---", "caption": f"*{t}*"}[b.kind]


def render(doc: Document, contents: bool = True, fields: bool = True) -> str:
    parts = []
    if fields:
        named = {"title": doc.title, "author": doc.author, "language": doc.language}
        head = [f'{k}: "{yaml_text(v)}"' for k, v in named.items() if v]
        head += [f"chapters: {len(doc.chapters)}", f'source_file: "{doc.name}"', f'source_format: "{doc.form}"']
        parts.append("\n".join(["---", *head, *([f"description: >\n  {doc.description[:300]}"] if doc.description else []), "---"]))
    if contents and len(doc.chapters) > 2:
        anchor = lambda t: re.sub(r"[\s_]+", "-", re.sub(r"[^\w\s-]", "", t.lower())).strip("-")
        parts.append("## Inhaltsverzeichnis\n\n" + "\n".join(f"{i}. [{c.title}](#{anchor(c.title)})" for i, c in enumerate(doc.chapters, 1)))
    for chapter in doc.chapters:
        if chapter.title:
            parts.append(f"# {chapter.title}")
        rows: list[Block] = []
        for b in [*chapter.blocks, None]:
            if b and b.kind in ("th", "tr"):
                rows.append(b)
                continue
            if rows:
                parts.append(render_table(rows))
                rows = []
            if b and (text := render_block(b)):
                parts.append(text)
    return "\n\n".join(parts).strip() + "\n"


# ---- HTML


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.children = tag, attrs, []

    def walk(self) -> Iterator[Node | str]:
        todo = list(reversed(self.children))
        while todo:
            x = todo.pop()
            yield x
            if isinstance(x, Node):
                todo += reversed(x.children)

    def all(self, *tags: str) -> Iterator[Node]:
        return (x for x in self.walk() if isinstance(x, Node) and x.tag in tags)

    def text(self) -> str:
        return " ".join(" ".join(x for x in self.walk() if isinstance(x, str)).split())


EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ENDS_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
DEEPEST = 200


class Tree(HTMLParser):
    """A tolerant tree: p ends at block elements, li and table cells at their like, stray ends are ignored."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.root = Node("#root", {})
        self.stack = [self.root]
        self.feed(html)
        self.close()

    def _close(self, tags: set[str], stop: set[str]) -> None:
        for k in range(len(self.stack) - 1, 0, -1):
            if self.stack[k].tag in tags:
                del self.stack[k:]
                return
            if self.stack[k].tag in stop:
                return

    def handle_starttag(self, tag, attrs):
        if tag in ENDS_P:
            self._close({"p"}, {"td", "th", "table", "body"})
        if tag == "li":
            self._close({"li"}, {"ul", "ol"})
        elif tag in ("td", "th"):
            self._close({"td", "th"}, {"tr", "table"})
        elif tag == "tr":
            self._close({"tr"}, {"table"})
        node = Node(tag, {k: v or "" for k, v in attrs})
        self.stack[-1].children.append(node)
        if tag not in EMPTY and len(self.stack) < DEEPEST:
            self.stack.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in EMPTY:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self._close({tag}, set())

    def handle_data(self, data):
        self.stack[-1].children.append(data)


DROPPED = frozenset("nav aside footer header script style".split())
HEADS = {"h1": "h1", "h2": "h2", "h3": "h3", "h4": "h4", "h5": "h4", "h6": "h4"}
BOLD, SLANTED = frozenset(("strong", "b")), frozenset(("em", "i"))
APART = frozenset("ul ol table pre code".split())


def rich(node: Node, own: bool = False, parity: bool = False) -> str:
    """Text with bold and italic marks; lists, tables and code inside are left out. With own the node's direct list does not
    count as inside (parity: it does, and an item's text is lost)."""
    out: list[str] = []

    def visit(n: Node, bold: bool, slanted: bool) -> None:
        for c in n.children:
            if isinstance(c, str):
                if t := c.strip():
                    out.append(f"**{t}**" if bold else f"*{t}*" if slanted else t)
            elif c.tag not in APART and c.tag not in DROPPED:
                visit(c, bold or c.tag in BOLD, slanted or c.tag in SLANTED)

    if own and parity:
        return ""
    visit(node, node.tag in BOLD, node.tag in SLANTED)
    return re.sub(r"\s+", " ", " ".join(out)).strip()


def html_blocks(root: Node, parity: bool = False) -> list[Block]:
    """Blocks in page order; page furniture is dropped; short paragraph pieces without an end mark are joined."""
    out: list[Block] = []

    def loose(text: str) -> None:
        if out and out[-1].kind == "p":
            out[-1].text += " " + text
        else:
            out.append(Block("p", text))

    def items(node: Node, level: int) -> None:
        n = 0
        for li in (c for c in node.children if isinstance(c, Node) and c.tag == "li"):
            n += 1
            if text := rich(li, own=True, parity=parity):
                out.append(Block("li", text, level, n if node.tag == "ol" else 0))
            for sub in (c for c in li.children if isinstance(c, Node) and c.tag in ("ul", "ol")):
                items(sub, level + 1)

    def rows(node: Node) -> None:
        head = next(node.all("thead"), None)
        every = list(node.all("tr"))
        heads = list(head.all("tr")) if head else [r for r in every[:1] if any(r.all("th"))]
        for r in every:
            cells = [c.text() for c in r.all("td", "th")]
            if r in heads:
                out.append(Block("th", cells=cells))
            elif any(cells) and (head or not any(r.all("th"))):
                out.append(Block("tr", cells=cells))

    def visit(node: Node) -> None:
        for c in node.children:
            if isinstance(c, str):
                if t := c.strip():
                    loose(t)
            elif c.tag in DROPPED or c.tag == "head":
                continue
            elif c.tag in HEADS:
                if t := c.text():
                    out.append(Block(HEADS[c.tag], t))
            elif c.tag in ("p", "blockquote"):
                if t := rich(c):
                    out.append(Block("p" if c.tag == "p" else "quote", t))
            elif c.tag in ("ul", "ol"):
                items(c, 0)
            elif c.tag in ("pre", "code"):
                if (t := "".join(x for x in c.walk() if isinstance(x, str))).strip():
                    out.append(Block("code", t))
            elif c.tag == "hr":
                out.append(Block("rule"))
            elif c.tag == "table":
                rows(c)
            elif c.tag in ("figcaption", "caption"):
                if t := c.text():
                    out.append(Block("caption", t))
            elif c.tag in ("span", "a") or c.tag in BOLD or c.tag in SLANTED:
                if t := rich(c):
                    loose(t)
            elif c.tag == "br":
                if out and out[-1].kind == "p":
                    out[-1].text += "\n"
            else:
                visit(c)

    visit(root)
    joined: list[Block] = []
    for b in out:
        if b.kind == "p" and joined and joined[-1].kind == "p" and len(joined[-1].text) < 200 and not joined[-1].text.endswith((".", "!", "?", ":", '"', "»")):
            joined[-1].text += " " + b.text
        else:
            joined.append(b)
    return joined


def by_headings(doc: Document, blocks: list[Block], first: str) -> Document:
    """The first top heading names the first chapter, each later one opens another."""
    chapter, named = doc.open(first), False
    for b in blocks:
        if b.kind != "h1":
            chapter.blocks.append(b)
        elif named:
            chapter = doc.open(b.text)
        else:
            chapter.title, named = b.text, True
    return doc


def stem_of(name: str) -> str:
    return re.sub(r"\.[^.]*$", "", name.rpartition("/")[2])


def decoded(data: bytes) -> str:
    return data.decode("utf-8-sig", "replace")


def from_html(data: bytes, name: str, parity: bool = False) -> Document:
    root = Tree(decoded(data)).root
    title = next((n.text() for n in root.all("title")), "") or stem_of(name)

    def meta(key: str) -> str:
        return next((n.attrs.get("content", "").strip() for n in root.all("meta") if n.attrs.get("name") == key or n.attrs.get("property") == f"og:{key}"), "")

    doc = Document(title, "HTML", name, author=meta("author"), description=meta("description"))
    body = next(root.all("body"), root)
    return by_headings(doc, html_blocks(body, parity), title)


# ---- plain formats


def from_csv(data: bytes, name: str) -> Document:
    text = decoded(data)
    try:
        dialect: type[csv.Dialect] | csv.Dialect = csv.Sniffer().sniff(text[:4096], delimiters=",;\t|")
    except csv.Error:
        dialect = csv.excel
    rows = [[c.strip() for c in r] for r in csv.reader(io.StringIO(text), dialect)]
    doc = Document(stem_of(name), "CSV", name)
    doc.open(doc.title or "Data").blocks += table_blocks(rows) or [Block("p", "No rows found.")]
    return doc


def table_blocks(rows: list[list[str]]) -> list[Block]:
    return [Block("tr" if i else "th", cells=r) for i, r in enumerate(rows)]


# Lines that are chapter headings in plain text.
CHAPTER_LINES = [
    re.compile(r"^(KAPITEL|CHAPTER|TEIL|PART|ABSCHNITT|SECTION)\s+[\dIVXivx]+", re.I),
    re.compile(r"^[\dIVXivx]+\.\s+[A-ZÄÖÜ\d].{5,80}$"),
    re.compile(r"^[A-ZÄÖÜ][A-ZÄÖÜ\s]{4,60}$"),
]


# How a list item and a heading line of plain text look, and what a heading does not end in.
TEXT_ITEM = re.compile(r"([-*•·]|(\d+)[.)]) +(.+)")
HEADING_MARKS = re.compile(r"(#{1,4})\s+(?=\S)")
LONGEST_HEADING, NO_HEADING_END = 60, tuple(".,;:?!")


def text_block(line: str) -> Block:
    """A stripped line by itself: a heading, a list item, text, or nothing."""
    marks, item = HEADING_MARKS.match(line), TEXT_ITEM.match(line)
    short = len(line) < LONGEST_HEADING and line[:1].isupper() and not line.endswith(NO_HEADING_END)
    level = len(marks[1]) if marks else 1 if any(p.match(line) for p in CHAPTER_LINES) else 2 * short
    if level:
        return Block(f"h{level}", line.lstrip("#").strip())
    return Block("li", item[3].strip(), order=int(item[2] or 0)) if item else Block("p", line)


def from_text(data: bytes, name: str) -> Document:
    """Lines of text that follow each other are a paragraph; blank lines only part them."""
    doc = Document(stem_of(name), name.rpartition(".")[2].upper() or "TXT", name)
    chapter = doc.open("Inhalt")
    blocks = [text_block(line) if line else None for line in map(str.strip, decoded(data).splitlines())]
    for kind, run in groupby(blocks, key=lambda b: b.kind if b else ""):
        if kind == "p":
            chapter.blocks.append(Block("p", " ".join(b.text for b in run)))
        elif kind == "h1":
            for head in run:
                chapter = doc.open(head.text)
        elif kind:
            chapter.blocks += run
    return doc


def from_markdown(data: bytes, name: str) -> Document:
    doc = Document(stem_of(name), "Markdown", name)
    chapter = doc.open("Inhalt")
    for line in decoded(data).splitlines():
        m = re.match(r"(#{1,4})\s+(.*)", line)
        if m and len(m[1]) == 1:
            chapter = doc.open(m[2].strip())
        elif m:
            chapter.blocks.append(Block(f"h{len(m[1])}", m[2].strip()))
        elif line.strip():
            chapter.blocks.append(Block("p", line.strip()))
    return doc


# ---- XML

# Element names by what they hold.
XML_HEADS = frozenset("title heading head h1 h2 h3 h4 section chapter".split())
XML_TEXTS = frozenset("p para paragraph text".split())
XML_LISTS, XML_ITEMS = frozenset("ul ol list".split()), frozenset("li item".split())
XML_ROWS, XML_CELLS = frozenset("tr row".split()), frozenset("td th cell".split())


def bare(tag: object) -> str:
    """An element or attribute name without its namespace."""
    return str(tag).rpartition("}")[2]


def local(tag: object) -> str:
    return bare(tag).lower()


def xml_text(node: ET.Element) -> str:
    return " ".join("".join(node.itertext()).split())


def xml_markdown(data: bytes, name: str) -> str:
    """Known elements by their meaning, unknown leaves as fenced XML; headings one level deeper with each level of nesting."""
    parts = [f"# {stem_of(name).replace('_', ' ').replace('-', ' ').strip()}"]
    todo = [(parse_xml(data), 0)]
    while todo:
        node, depth = todo.pop()
        tag, text = local(node.tag), xml_text(node)
        if tag in XML_HEADS and text:
            parts.append("#" * min(4, max(2, depth + 2)) + " " + text)
        elif tag in XML_TEXTS and text:
            parts.append(text)
        elif tag in XML_LISTS:
            parts.append("\n".join(f"- {xml_text(c)}" for c in node if local(c.tag) in XML_ITEMS and xml_text(c)))
        elif tag == "table":
            rows = [[xml_text(c) for c in r if local(c.tag) in XML_CELLS] for r in node.iter() if local(r.tag) in XML_ROWS]
            rows = [r for r in rows if r]
            if rows:
                wide = max(map(len, rows))
                filled = [r + [""] * (wide - len(r)) for r in rows]
                parts.append("\n".join("| " + " | ".join(r) + " |" for r in [filled[0], ["---"] * wide, *filled[1:]]))
        elif text and not len(node):
            parts.append("```xml\n" + ET.tostring(node, encoding="unicode").strip() + "\n```")
        else:
            todo += [(c, depth + 1) for c in reversed(node)]
    return "\n\n".join(p for p in parts if p) + "\n"


def parse_xml(data: bytes) -> ET.Element:
    """Refuses entity declarations, which can blow up."""
    if b"<!ENTITY" in data:
        raise ValueError("XML with entity declarations")
    return ET.fromstring(data)


# ---- zip formats

#: An archive that unpacks to more than so many bytes, and so many times its size, is a bomb and no document.
BOMB_BYTES, BOMB_TIMES = 512 << 20, 200


class Archive:
    def __init__(self, data: bytes):
        self.zip = zipfile.ZipFile(io.BytesIO(data))
        if sum(i.file_size for i in self.zip.infolist()) > max(BOMB_BYTES, BOMB_TIMES * len(data)):
            raise ValueError("archive unpacks to too much")
        self.names = set(self.zip.namelist())

    def xml(self, name: str) -> ET.Element | None:
        return parse_xml(self.zip.read(name)) if name in self.names else None

    def links(self, part: str) -> dict[str, str]:
        """Relation id -> part that it names."""
        root = self.xml(f"{dirname(part)}/_rels/{part.rpartition('/')[2]}.rels".lstrip("/"))
        return {} if root is None else {r.get("Id", ""): normpath(join("/" + dirname(part), r.get("Target", ""))).lstrip("/") for r in root}


def first(node: ET.Element | None, *path: str) -> ET.Element | None:
    for tag in path:
        node = next((c for c in node if bare(c.tag) == tag), None) if node is not None else None
    return node


def attr(node: ET.Element | None, name: str, default: str = "") -> str:
    return default if node is None else next((v for k, v in node.attrib.items() if bare(k) == name), default)


def under(node: ET.Element | None, tag: str) -> Iterator[ET.Element]:
    return (c for c in (node.iter() if node is not None else ()) if bare(c.tag) == tag)


#: Parts of the names of fonts for code.
MONOSPACED = ("courier", "mono", "consolas", "code")


def from_docx(data: bytes, name: str) -> Document:
    """Headings by style or outline level, lists by numbering, runs with bold, italic and code marks, tables."""
    z = Archive(data)
    core, root = z.xml("docProps/core.xml"), z.xml("word/document.xml")
    doc = Document(xml_text(t) if (t := next(under(core, "title"), None)) is not None and xml_text(t) else stem_of(name), "DOCX", name)
    doc.author = xml_text(a) if (a := next(under(core, "creator"), None)) is not None else ""
    styles = {attr(s, "styleId"): attr(first(s, "name"), "val").lower() for s in under(z.xml("word/styles.xml"), "style")}

    def runs(p: ET.Element) -> str:
        out = []
        for r in under(p, "r"):
            text = "".join("\t" if bare(c.tag) == "tab" else "\n" if bare(c.tag) == "br" else c.text or "" for c in r if bare(c.tag) in ("t", "tab", "br"))
            marks = first(r, "rPr")
            on = lambda k: (m := first(marks, k)) is not None and attr(m, "val", "true") not in ("0", "false")  # noqa: B023, E731
            if text.strip():
                font = attr(first(marks, "rFonts"), "ascii").lower()
                stars = "*" * (2 * on("b") + on("i"))
                text = f"`{text}`" if any(x in font for x in MONOSPACED) else f"{stars}{text.strip()}{stars} " if stars else text
            out.append(text)
        return "".join(out).strip()

    blocks: list[Block] = []
    counted: dict[tuple[str, int], int] = {}  # ordered items so far by list and level
    body = next(under(root, "body"), None)
    for part in body if body is not None else ():
        tag = bare(part.tag)
        if tag == "tbl":
            blocks += table_blocks([[" ".join(xml_text(p) for p in under(c, "p")).strip() for c in r if bare(c.tag) == "tc"] for r in part if bare(r.tag) == "tr"])
        elif tag == "p" and (text := runs(part)):
            props = first(part, "pPr")
            style = styles.get(attr(first(props, "pStyle"), "val"), attr(first(props, "pStyle"), "val").lower())
            outline = attr(first(props, "outlineLvl"), "val")
            level = m[1] if (m := re.match(r"(?:heading|überschrift|titre|título)\s*(\d)", style)) else "1" if style == "title" else str(int(outline) + 1) if outline.isdigit() else ""
            number = first(props, "numPr")
            if level:
                blocks.append(Block(f"h{min(4, int(level))}", re.sub(r"[*`]", "", text)))
            elif number is not None or style.startswith("list"):
                level = int(attr(first(number, "ilvl"), "val", "0") or 0)
                place = (attr(first(number, "numId"), "val"), level)
                if ordered := "number" in style or "numeri" in style:
                    counted[place] = counted.get(place, 0) + 1
                blocks.append(Block("li", text, level, counted[place] if ordered else 0))
            else:
                blocks.append(Block("quote" if "quote" in style else "caption" if style == "caption" else "code" if "code" in style else "p", text))
    return by_headings(doc, blocks, doc.title)


def from_odt(data: bytes, name: str) -> Document:
    root = Archive(data).xml("content.xml")
    blocks: list[Block] = []

    def visit(node: ET.Element, level: int) -> None:
        for c in node:
            tag = bare(c.tag)
            if tag == "h":
                blocks.append(Block(f"h{min(4, int(attr(c, 'outline-level', '1') or 1))}", xml_text(c)))
            elif tag == "p" and xml_text(c):
                blocks.append(Block("li" if level else "p", xml_text(c), max(0, level - 1)))
            elif tag == "table":
                blocks.extend(table_blocks([[xml_text(x) for x in under(r, "table-cell")] for r in under(c, "table-row")]))
            else:
                visit(c, level + (tag == "list"))

    visit(next(under(root, "text"), ET.Element("none")), 0)
    return by_headings(Document(stem_of(name), "ODT", name), blocks, stem_of(name))


def column_number(ref: str) -> int:
    n = 0
    for c in re.match(r"[A-Z]*", ref)[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


def from_xlsx(data: bytes, name: str) -> Document:
    """A chapter per sheet; blank rows are dropped; the first row is the header."""
    z = Archive(data)
    strings = ["".join(t.text or "" for t in under(s, "t")) for s in under(z.xml("xl/sharedStrings.xml"), "si")]
    links, doc = z.links("xl/workbook.xml"), Document(stem_of(name), "XLSX", name)
    for sheet in under(z.xml("xl/workbook.xml"), "sheet"):
        rows = []
        for r in under(z.xml(links.get(attr(sheet, "id"), "")), "row"):
            cells: dict[int, str] = {}
            for c in under(r, "c"):
                kind, v = attr(c, "t"), first(c, "v")
                text = "".join(t.text or "" for t in under(c, "t")) if kind == "inlineStr" else v.text or "" if v is not None else ""
                cells[column_number(attr(c, "r")) if attr(c, "r") else len(cells)] = strings[int(text)] if kind == "s" and text else text
            row = [cells.get(i, "").strip() for i in range(max(cells, default=-1) + 1)]
            if any(row):
                rows.append(row)
        doc.open(attr(sheet, "name") or "Sheet").blocks += table_blocks(rows) or [Block("p", "No rows found.")]
    return doc


def pptx_markdown(data: bytes, name: str) -> str:
    """A heading per slide, a bullet per paragraph by level, notes as quotes."""
    z, lines = Archive(data), [f"# {stem_of(name).replace('_', ' ').replace('-', ' ').strip()}"]
    links = z.links("ppt/presentation.xml")
    slides = [links.get(next((v for k, v in s.attrib.items() if k.endswith("}id")), ""), "") for s in under(z.xml("ppt/presentation.xml"), "sldId")]
    text = lambda p: "".join(t.text or "" for t in under(p, "t")).strip()
    for i, part in enumerate(slides, 1):
        title, points = "", []
        for shape in under(z.xml(part), "sp"):
            is_title = attr(next(under(shape, "ph"), None), "type") in ("title", "ctrTitle")
            body = next((b for b in shape if bare(b.tag) == "txBody"), None)
            found = [(int(attr(first(p, "pPr"), "lvl", "0") or 0), text(p)) for p in under(body, "p") if text(p)]
            if is_title and not title:
                title = " ".join(t for _, t in found)
            else:
                points += [f"{'  ' * level}- {t}" for level, t in found]
        lines += ["", f"## Slide {i}: {title or f'Slide {i}'}", *points]
        for note in (p for p in z.links(part).values() if "notesSlide" in p):
            said = [text(p) for s in under(z.xml(note), "sp") if attr(next(under(s, "ph"), None), "type") == "body" for p in under(s, "p") if text(p)]
            if said:
                lines += ["", "### Speaker Notes", *(f"> {t}" for t in said)]
    return "\n".join([*lines, ""])


def from_epub(data: bytes, name: str) -> Document:
    """A chapter per page of the spine, named by its first heading."""
    z = Archive(data)
    container = z.xml("META-INF/container.xml")
    opf = attr(next(under(container, "rootfile"), None), "full-path")
    package = z.xml(opf)
    said = lambda k: xml_text(n) if (n := next(under(package, k), None)) is not None else ""
    doc = Document(said("title") or stem_of(name), "EPUB", name, author=said("creator"), language=said("language"))
    files = {attr(i, "id"): (normpath(join(dirname(opf), attr(i, "href"))), attr(i, "media-type")) for i in under(package, "item")}
    for ref in under(package, "itemref"):
        path, kind = files.get(attr(ref, "idref"), ("", ""))
        if path in z.names and "html" in kind:
            root = Tree(decoded(z.zip.read(path))).root
            blocks = html_blocks(next(root.all("body"), root))
            head = next((b for b in blocks[:5] if b.kind in ("h1", "h2")), None)
            if blocks:
                doc.open(head.text if head else stem_of(path)).blocks += [b for b in blocks if not (b is head and b.kind == "h1")]
    return doc


def from_pdf(data: bytes, name: str) -> Document:
    """Through PyMuPDF where it is installed: heading sizes from a histogram of sizes weighted by text, margins left out."""
    try:
        import fitz
    except ImportError:
        raise ValueError("no PDF library installed") from None
    spans = []
    with fitz.open(stream=data, filetype="pdf") as pdf:
        for page in pdf:
            high = page.rect.height
            for b in page.get_text("dict")["blocks"]:
                for line in b.get("lines", ()):
                    if high * 0.07 < line["bbox"][1] < high * 0.93:
                        text = " ".join(s["text"].strip() for s in line["spans"]).strip()
                        if text and not re.fullmatch(r"[-–\s]*\d+[-–\s]*", text):
                            spans.append((round(max(s["size"] for s in line["spans"]), 1), all(s["flags"] & 16 for s in line["spans"]), text))
    return by_headings(Document(stem_of(name), "PDF", name), sized_blocks(spans), stem_of(name))


def heading_sizes(spans: list[tuple[float, bool, str]]) -> tuple[float, list[float]]:
    """Body size, the mode by length of text, and the three largest sizes above it (or fixed steps above it)."""
    weight: dict[float, int] = {}
    for size, _, text in spans:
        weight[size] = weight.get(size, 0) + len(text)
    body = max(weight, key=lambda s: (weight[s], -s), default=11.0)
    larger = sorted((s for s in weight if s > body + 0.5), reverse=True)[:3]
    return body, larger or [body + 6, body + 3, body + 1]


def sized_blocks(spans: list[tuple[float, bool, str]]) -> list[Block]:
    _, steps = heading_sizes(spans)
    out: list[Block] = []
    for size, bold, text in spans:
        level = 0
        if len(text) <= 120:
            level = next((k for k, s in enumerate(steps, 1) if size >= s), 0)
            if not level and bold and len(text) < 80 and not text.endswith("."):
                level = 4
        if level:
            out.append(Block(f"h{level}", text))
        elif m := re.match(r"([-•–*]|\d+[.)])\s+(.+)", text):
            out.append(Block("li", m[2]))
        elif out and out[-1].kind == "p" and out[-1].text[-1] not in ".!?:":
            out[-1].text += " " + text
        else:
            out.append(Block("p", text))
    return out


def through(program: tuple[str, ...], into: str, read: Callable[[bytes, str], Document], seconds: int = 120) -> Callable[[bytes, str], Document]:
    """A converter that has a program of the executor's PATH turn the file into a format that is read here. `{file}`, `{folder}` and
    `{made}` stand for paths in a folder that lives as long as the call; no other task sees it. Without the program: an error."""
    def convert(data: bytes, name: str) -> Document:
        found = shutil.which(program[0])
        if not found:
            raise ValueError(f"this format needs {program[0]}, which is not installed")
        with tempfile.TemporaryDirectory() as folder:
            ending = name.rpartition(".")[2]
            paths = {"file": f"{folder}/in.{ending}", "folder": f"{folder}/out", "made": f"{folder}/out/in.{into}"}
            os.mkdir(paths["folder"])
            with open(paths["file"], "wb") as f:
                f.write(data)
            ran = subprocess.run([found, *(a.format(**paths) for a in program[1:])], capture_output=True, timeout=seconds, check=False)
            if ran.returncode or not os.path.exists(paths["made"]):
                raise ValueError(f"{program[0]} failed: {ran.stderr.decode('utf-8', 'replace')[:500]}")
            with open(paths["made"], "rb") as f:
                doc = read(f.read(), name)
        doc.form = ending.upper()
        return doc

    return convert


def office(into: str) -> tuple[str, ...]:
    return ("soffice", "--headless", "--convert-to", into, "--outdir", "{folder}", "{file}")


EBOOK = through(("ebook-convert", "{file}", "{made}", "--no-default-epub-cover"), "epub", from_epub)

CONVERTERS: dict[str, Callable[[bytes, str], Document | str]] = {
    "html": from_html, "htm": from_html, "xhtml": from_html, "csv": from_csv, "txt": from_text, "text": from_text, "rst": from_text, "md": from_markdown, "xml": xml_markdown,
    "docx": from_docx, "docm": from_docx, "odt": from_odt, "xlsx": from_xlsx, "pptx": pptx_markdown, "epub": from_epub, "pdf": from_pdf,
    "doc": through(office("docx"), "docx", from_docx), "xls": through(office("xlsx"), "xlsx", from_xlsx),
    "mobi": EBOOK, "azw": EBOOK, "azw3": EBOOK, "lit": EBOOK, "fb2": EBOOK, "lrf": EBOOK, "pdb": EBOOK, "cbz": EBOOK, "cbr": EBOOK,
}


def markdown_of(data: bytes, name: str, ext: str, converters: dict | None = None) -> tuple[str | None, str | None]:
    """(markdown, error)."""
    known = CONVERTERS | (converters or {})
    convert = known.get(ext.lower().lstrip("."))
    try:
        if convert is None:
            raise ValueError(f"unknown format {ext}")
        made = convert(data or b"", name)
        return (made if isinstance(made, str) else render(made)), None
    except Exception as e:  # one bad file is one row with an error
        return None, f"{type(e).__name__}: {e}"


def to_markdown(raw: DataFrame, converters: dict | None = None) -> DataFrame:
    """raw: rel_path, ext, content. Adds markdown and error, and drops the content. converters adds or replaces formats. Rows leave
    Python in small batches (see planned)."""
    from strataforge.operators.stages import planned

    def plan(content: bytes | None, name: str | None, ext: str | None) -> list[tuple]:
        return [markdown_of(content, (name or "").rpartition("/")[2], ext or "", converters)]

    return planned(raw, ["content", "rel_path", "ext"], plan, "markdown string, error string", drop=("content",))
