"""Stateful text planners: front matter, body normalising, chapters, blocks and chunks.

These are pure Python over one document at a time, since their state (fences, budgets that reset) has no declarative form, and
run in Arrow batches. All are linear in the text. `parity` switches to behaviour that older outputs have (see each function).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

# How sentences end, and how lists, headings, fields and fences begin.
SENTENCE_END = re.compile(r"(?<=[.!?])\s+")
LIST_START = re.compile(r"\s*(?:[-*+]|\d+[.)])\s+")
HEADING = re.compile(r"#{1,6}\s+")
CHAPTER_HEADING = re.compile(r"(#{1,4})\s+(.+)")
KEY_LINE = re.compile(r"([A-Za-z0-9_\-]+):\s*(.*)$")
FENCES = ("```", "~~~")


def front_matter(text: str) -> tuple[dict[str, str], str]:
    """Flat `key: value` fields between two --- lines, and the body. Keys with dots or indents are skipped; of repeated keys
    the last counts; an unterminated block is body."""
    lines = text.splitlines()
    if not lines or lines[0].strip() != "---":
        return {}, text
    for end in range(1, len(lines)):
        if lines[end].strip() == "---":
            fields = (KEY_LINE.match(x) for x in lines[1:end])
            return {m[1]: m[2].strip().strip("\"'") for m in fields if m}, "\n".join(lines[end + 1 :])
    return {}, text


def normalise_body(body: str, title: str) -> tuple[str, list[str]]:
    """One top heading (inserted if missing, later ones lowered), spaced heading marks, no trailing blanks, two blank lines at
    most; nothing changes inside code fences but trailing and surplus blank lines. Returns warnings too."""
    out, fenced, tops = [], False, 0
    for raw in body.replace("\r\n", "\n").replace("\r", "\n").split("\n"):
        line = raw.rstrip()
        if line.lstrip().startswith("```"):
            fenced = not fenced
        elif not fenced:
            line = re.sub(r"^(#{1,6})(?=[^\s#])", r"\1 ", line)
            if line.startswith("# "):
                tops += 1
                line = line if tops == 1 else "#" + line
        out.append(line)
    warnings = []  # fixed values: their texts
    if not tops:
        out[:0] = [f"# {title}", ""]
        warnings.append("Inserted missing H1 heading.")
    result = re.sub(r"\n{4,}", "\n\n\n", "\n".join(x if x.strip() else "" for x in out)).strip() + "\n"
    if not re.search(r"\[source|source_id", result, re.I):
        warnings.append("No source markers found in body.")
    return result, warnings


@dataclass
class Chapter:
    number: int
    level: int
    title: str
    lines: list[str]

    @property
    def words(self) -> int:
        return sum(len(x.split()) for x in self.lines)

    @property
    def body(self) -> str:
        inner = re.sub(r"\n{3,}", "\n\n", "\n".join(self.lines).strip())
        return f"{'#' * self.level} {self.title}\n" + (f"\n{inner}\n" if inner else "")


def headings(lines: list[str], parity: bool = False) -> Iterator[tuple[int, int, str]]:
    """(line number, level, title) of headings of level 1 to 4; outside code fences unless parity asks for all."""
    fence = None
    for i, line in enumerate(lines):
        mark = line.strip()[:3]
        if not parity and mark in FENCES and (fence is None or fence == mark):
            fence = None if fence else mark
        elif fence is None and (m := CHAPTER_HEADING.match(line)):
            yield i, len(m[1]), m[2].strip()


def split_level(levels: list[int]) -> int:
    """The first level with several headings, else the first with one, else 1."""
    for enough in (2, 1):
        for level in (1, 2, 3, 4):
            if levels.count(level) >= enough:
                return level
    return 1


def chapters(body: str, level: int | None = None, parity: bool = False) -> tuple[list[str], list[Chapter], int]:
    """Preamble lines, chapters and the level that was split at. A heading above that level ends a chapter and is preamble."""
    lines = body.splitlines()
    found = {i: (deep, title) for i, deep, title in headings(lines, parity)}
    level = level or split_level([deep for deep, _ in found.values()])
    preamble: list[str] = []
    out: list[Chapter] = []
    into = preamble
    for i, line in enumerate(lines):
        deep, title = found.get(i, (9, ""))
        if deep == level:
            out.append(Chapter(len(out) + 1, level, title, []))
            into = out[-1].lines
        elif deep < level:
            into = preamble
            into.append(line)
        else:
            into.append(line)
    return preamble, out, level


@dataclass(frozen=True)
class Block:
    kind: str
    text: str
    start: int
    end: int


def is_table(line: str) -> bool:
    stripped = line.strip()
    return "|" in stripped and len(stripped) > 2


def kind_of(line: str) -> str:
    """What a non-blank line starts, outside any block."""
    stripped = line.strip()
    if HEADING.match(stripped):
        return "heading"
    if stripped.startswith(FENCES):
        return "code"
    if stripped.startswith(">"):
        return "blockquote"
    if is_table(stripped):
        return "table"
    return "list" if LIST_START.match(line) else "paragraph"


def blocks(markdown: str) -> list[Block]:
    """Blocks with running numbers; a heading has the number of the block that follows it."""
    out: list[Block] = []
    number, lines, i = 1, markdown.splitlines(), 0
    while i < len(lines):
        if not lines[i].strip():
            i += 1
            continue
        kind, begin = kind_of(lines[i]), i
        i += 1
        if kind == "code":
            fence = lines[begin].strip()[:3]
            while i < len(lines) and not lines[i].strip().startswith(fence):
                i += 1
            i = min(i + 1, len(lines))
        elif kind != "heading":
            while i < len(lines) and lines[i].strip() and _goes_on(kind, lines[i]):
                i += 1
        out.append(Block(kind, "\n".join(lines[begin:i]), number, number))
        number += kind != "heading"
    return out


def _goes_on(kind: str, line: str) -> bool:
    """Whether a non-blank line belongs to a block of this kind that is open."""
    if kind == "blockquote":
        return line.strip().startswith(">")
    if kind == "table":
        return is_table(line)
    if kind == "list":
        return bool(LIST_START.match(line)) or line[0] in " \t"
    return kind_of(line) == "paragraph"


@dataclass(frozen=True)
class Rules:
    """Budgets in tokens. Tables and code above the maximum stay whole unless they may be split."""

    target: int = 300
    maximum: int = 500
    keep_headings: bool = True
    split_tables: bool = False
    split_code: bool = False
    parity: bool = False


@dataclass(frozen=True)
class Chunk:
    content: str
    start: int
    end: int
    tokens: int


Part = tuple[int, str]


def _parts(text: str) -> list[Part]:
    """A text's sentences with their numbers of words, or all of it where it has one."""
    found = [(len(s.split()), s.strip()) for s in SENTENCE_END.split(text.strip()) if s.strip()]
    return found if len(found) > 1 else [(len(text.split()), text)]


def _filled(parts: list[Part], most: int) -> Iterator[list[Part]]:
    """Neighbouring parts as groups of at most `most` words; a part above it is a group alone."""
    group: list[Part] = []
    for part in parts:
        if group and sum(n for n, _ in group) + part[0] > most:
            yield group
            group = []
        group.append(part)
    if group:
        yield group


def pieces(block: Block, rules: Rules) -> list[Block]:
    """A block within the maximum as it is; else groups of sentences, and windows of words of sentences that are too long. Pieces
    keep the block's number. With parity they count on from it, and so may overlap the next block's, and a long sentence comes
    before the shorter ones that were waiting."""
    splittable = {"paragraph", "list", "blockquote"} | ({"table"} if rules.split_tables and not rules.parity else set()) | ({"code"} if rules.split_code and not rules.parity else set())
    if len(block.text.split()) <= rules.maximum or block.kind not in splittable:
        return [block]
    texts = (_parity_pieces if rules.parity else _pieces)(_parts(block.text), rules.maximum)
    return [Block("paragraph", text, block.start + n, block.start + n) for n, text in texts]


def _windows(text: str, most: int) -> list[str]:
    words = text.split()
    return [" ".join(words[k : k + most]) for k in range(0, len(words), most)]


def _pieces(parts: list[Part], most: int) -> Iterator[tuple[int, str]]:
    for group in _filled(parts, most):
        yield from ((0, x) for x in (_windows(group[0][1], most) if group[0][0] > most else [" ".join(text for _, text in group)]))


def _parity_pieces(parts: list[Part], most: int) -> Iterator[tuple[int, str]]:
    """Groups leave out long sentences, which stand where they were met; numbers count pieces, those of a long sentence from its own."""
    if len(parts) == 1:
        yield from enumerate(_windows(parts[0][1], most))
        return
    groups = [" ".join(text for _, text in group) for group in _filled([p for p in parts if p[0] <= most], most)]
    number, size, done = 0, 0, 0
    for n, text in parts:
        if n > most:
            yield from ((number + k, x) for k, x in enumerate(_windows(text, most)))
            number += 1
        elif size and size + n > most:
            yield number, groups[done]
            number, size, done = number + 1, n, done + 1
        else:
            size += n
    if done < len(groups):
        yield number, groups[done]


def plan_chunks(markdown: str, rules: Rules = Rules()) -> list[Chunk]:
    """Packs blocks greedily: a chunk closes when it has reached the target, or before it would exceed the maximum. Token counts
    add up over blocks, so one running sum does."""
    out: list[Chunk] = []
    texts: list[str] = []
    spans: list[tuple[int, int]] = []
    size = 0

    def close() -> None:
        nonlocal size
        text = "\n\n".join(t for t in texts if t.strip()).strip()
        if text:
            out.append(Chunk(text + "\n", spans[0][0], spans[-1][1], size))
        texts.clear()
        spans.clear()
        size = 0

    for block in blocks(markdown):
        head = block.kind == "heading" and rules.keep_headings
        for piece in [block] if head else pieces(block, rules):
            n = len(piece.text.split())
            if texts and (size >= rules.target if head else size + n > rules.maximum):
                close()
            texts.append(piece.text)
            spans.append((piece.start, piece.end))
            size += n
            if not head and size >= rules.target and piece.kind != "heading":
                close()
    close()
    return out


def sections(markdown: str) -> list[tuple[str, str]]:
    """(title, text) of the parts that top headings begin; what stands before the first has an empty title."""
    out: list[tuple[str, list[str]]] = []
    for line in markdown.splitlines():
        if line.startswith("# "):
            out.append((line[2:].strip(), [line]))
        elif out:
            out[-1][1].append(line)
        elif line.strip():
            out.append(("", [line]))
    return [(title, "\n".join(lines).strip() + "\n") for title, lines in out]
