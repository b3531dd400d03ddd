"""Links and titles: wiki text, markdown, HTML, URLs and stored paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Link prefixes that are not articles.
NAMESPACES = ("file:", "category:", "talk:", "template:", "wikipedia:", "help:", "portal:", "draft:", "module:", "special:", "mediawiki:")


def wiki_title(title: Column) -> Column:
    """Trimmed, underscores as spaces, first letter upper."""
    x = F.trim(F.replace(F.trim(title), F.lit("_"), F.lit(" ")))
    return F.concat(F.upper(F.substring(x, 1, 1)), F.substring(x, 2, 1 << 30))


def redirect_target(wikitext: Column) -> Column:
    """The normalised target of a redirect, without section and label; null if the text is none."""
    found = F.regexp_extract(wikitext, "(?i)#redirect\\s*\\[\\[([^\\]|#]*)[^\\]]*\\]\\]", 1)
    return F.nullif(wiki_title(found), F.lit(""))


def wiki_links(wikitext: Column, namespaces: tuple[str, ...] = NAMESPACES) -> Column:
    """Targets of [[target#section|label]] in order of first occurrence; links into namespaces are left out."""
    found = F.transform(F.regexp_extract_all(wikitext, F.lit("\\[\\[([^\\]|#]+)(?:#[^\\]|]*)?(?:\\|[^\\]]*)?\\]\\]"), F.lit(1)), wiki_title)
    outside = lambda t: F.lower(t).rlike("^(" + "|".join(namespaces) + ")")
    return F.array_distinct(F.filter(found, lambda t: (t != "") & ~outside(t)))


def markdown_links(text: Column) -> Column:
    """Targets of [..](..), then of <http..>, without repeats."""
    inline = F.regexp_extract_all(text, F.lit("\\[[^\\]]+\\]\\(([^)]+)\\)"), F.lit(1))
    bare = F.regexp_extract_all(text, F.lit("<(https?://[^>]+)>"), F.lit(1))
    return F.array_distinct(F.filter(F.transform(F.concat(inline, bare), lambda x: F.trim(x)), lambda x: x != ""))


def html_links(html: Column) -> Column:
    """href values in order of first occurrence."""
    return F.array_distinct(F.regexp_extract_all(html, F.lit('href="([^"]*)"'), F.lit(1)))


def is_external(link: Column) -> Column:
    return link.rlike("^(?i)https?://")


def is_ignored(link: Column) -> Column:
    """Anchors, mail, phone numbers and inline data are no files."""
    return link.rlike("^(?i)(#|mailto:|tel:|data:)")


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def link_path(link: Column) -> Column:
    """The decoded path of a link without query and anchor."""
    return F.try_url_decode(F.regexp_extract(link, "^[^?#]*", 0))


def meta_path(path: Column) -> Column:
    """A stored path as key: forward slashes, no leading ./ and lower case."""
    return F.regexp_replace(F.lower(F.replace(path, F.lit("\\"), F.lit("/"))), "^[./]+", "")


def resolve_path(folder: Column, link: Column) -> Column:
    """A link's path from a folder, `.` and `..` resolved; what would leave the root stays at it."""
    joined = F.when(F.startswith(link, F.lit("/")), link).otherwise(F.concat(folder, F.lit("/"), link))
    parts = F.filter(F.split(joined, "/"), lambda p: ~p.isin("", "."))
    empty = F.array().cast("array<string>")
    kept = F.aggregate(parts, empty, lambda a, p: F.when(p == "..", F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0)))).otherwise(F.array_append(a, p)))
    return F.array_join(kept, "/")
