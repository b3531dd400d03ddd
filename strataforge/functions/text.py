"""Text functions: tokens, slugs, previews, sentences, windows, cleaning and field aliases."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space and letters as Unicode has them; Java's classes are ASCII without the flag.
SPACE, NOT_SPACE = "(?U)\\s+", "(?U)\\S+"


def nonempty(*columns: Column | str, default: str = "") -> Column:
    """The first column that is neither null nor empty: how field aliases are read."""
    return F.coalesce(*(F.nullif(F.col(c) if isinstance(c, str) else c, F.lit("")) for c in columns), F.lit(default))


def token_count(text: Column) -> Column:
    """White-space separated tokens; 0 for null and blank texts."""
    return F.coalesce(F.regexp_count(text, F.lit(NOT_SPACE)), F.lit(0))


def word_list(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def slug(text: Column, empty: str = "na") -> Column:
    """Letters and digits in lower case, all else one underscore."""
    plain = F.regexp_replace(F.regexp_replace(F.lower(text), "[^\\p{L}\\p{N}]+", "_"), "^_+|_+$", "")
    return F.coalesce(F.nullif(plain, F.lit("")), F.lit(empty))


def toc_slug(text: Column) -> Column:
    """Anchor of a heading: words joined by hyphens."""
    kept = F.regexp_replace(F.lower(text), "(?U)[^\\w\\s-]", "")
    return F.regexp_replace(F.regexp_replace(kept, "(?U)[\\s_]+", "-"), "^-+|-+$", "")


def safe_title(title: Column, number: Column) -> Column:
    """A title as part of a file name, 60 characters at most."""
    kept = F.regexp_replace(title, "(?U)[^\\w\\s-]", "")
    joined = F.regexp_replace(F.regexp_replace(F.regexp_replace(kept, "(?U)^\\s+|\\s+$", ""), SPACE, "_"), "_+", "_")
    cut = F.regexp_replace(F.substring(joined, 1, 60), "^_+|_+$", "")
    return F.coalesce(F.nullif(cut, F.lit("")), F.concat(F.lit("Kapitel_"), number.cast("string")))


def yaml_escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit('"'), F.lit('\\"')), F.lit("\n"), F.lit(" "))


def clean(text: Column) -> Column:
    """Line ends and blanks made regular, trimmed, pipes escaped for tables."""
    x = F.regexp_replace(F.coalesce(text, F.lit("")), "\r\n|\r", "\n")
    x = F.regexp_replace(F.regexp_replace(x, "\n{3,}", "\n\n"), "[ \t]+", " ")
    return F.replace(F.regexp_replace(x, "(?U)^\\s+|\\s+$", ""), F.lit("|"), F.lit("\\|"))


def preview(text: Column, length: int = 400) -> Column:
    return F.substring(text, 1, length)


def display_preview(text: Column, length: int = 180) -> Column:
    """One line of a text for a listing."""
    return F.substring(F.trim(F.replace(text, F.lit("\n"), F.lit(" "))), 1, length)


def sentences(text: Column) -> Column:
    """Sentences end in . ! or ? before white space; blank ones are left out."""
    parts = F.split(F.regexp_replace(text, "(?U)^\\s+|\\s+$", ""), "(?<=[.!?])(?U)\\s+")
    return F.filter(F.transform(parts, lambda s: F.regexp_replace(s, "(?U)^\\s+|\\s+$", "")), lambda s: s != "")


def windows(text: Column, size: int) -> Column:
    """Consecutive windows of `size` words, joined by single spaces."""
    def cut(words: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.greatest(F.size(words) - 1, F.lit(0)), F.lit(size)), lambda i: i < F.size(words))
        return F.transform(starts, lambda i: F.array_join(F.slice(words, i + 1, size), " "))

    return F.transform(F.array(word_list(text)), cut)[0]


def is_table_line(line: Column) -> Column:
    stripped = F.trim(line)
    return F.contains(stripped, F.lit("|")) & (F.length(stripped) > 2)


def is_list_line(line: Column) -> Column:
    return line.rlike("^(\\s*[-*+]\\s+|\\s*\\d+[.)]\\s+)")


def is_fence_line(line: Column) -> Column:
    return F.trim(line).rlike("^(```|~~~)")


def is_heading_line(line: Column, deepest: int = 6) -> Column:
    return line.rlike(f"^#{{1,{deepest}}}\\s+\\S")


def parse_int(text: Column, default: int = 0) -> Column:
    return F.coalesce(text.try_cast("int"), F.lit(default))


def chapter_key(chapter: Column) -> Column:
    """`7` and `07` become ch07, anything else its slug; one key for a chapter in every layer."""
    text = F.trim(chapter.cast("string"))
    number = text.cast("int").cast("string")
    return F.when(text.rlike("^\\d+$"), F.concat(F.lit("ch"), F.lpad(number, F.greatest(F.lit(2), F.length(number)), F.lit("0")))).otherwise(slug(text))


def json_scalar(text: Column) -> Column:
    """The value of a JSON scalar as text; what is no JSON loses its quotes."""
    value = F.try_variant_get(F.try_parse_json(text), "$", "string")
    return F.coalesce(value, F.regexp_replace(F.trim(text), "^[\"']+|[\"']+$", ""))
