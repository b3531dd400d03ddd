"""Scoring and naming of papers. Weights and study types are fixed values; topics are input."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weights of the score's parts.
WEIGHTS = {"keyword_match": 0.30, "boost_term_match": 0.25, "study_type_bonus": 0.20, "recency_bonus": 0.15, "open_access_bonus": 0.10}
# Scores of study types, best first.
STUDY_SCORES = {
    "meta-analysis": 1.0,
    "systematic review": 0.9,
    "randomized controlled trial": 0.85,
    "cohort study": 0.7,
    "cross-sectional": 0.5,
    "case-control": 0.5,
    "review": 0.4,
    "case report": 0.2,
}
# Patterns that tell a study type, the first that matches counts.
STUDY_PATTERNS = [
    ("meta-analysis", "\\bmeta.analy"),
    ("systematic review", "\\bsystematic review\\b"),
    ("randomized controlled trial", "\\brandomized controlled trial\\b|\\brct\\b"),
    ("cohort study", "\\bcohort study\\b|\\bprospective cohort\\b"),
    ("cross-sectional", "\\bcross.sectional\\b"),
    ("case-control", "\\bcase.control\\b"),
    ("review", "\\breview\\b"),
    ("case report", "\\bcase report\\b"),
]
DECAY_YEARS = 10
# Patterns of library and site names that file names carry in brackets.
NOISE = [
    r"z[-\s]?lib(?:rary)?(?:\.\w+)*",
    r"1lib(?:\.\w+)*",
    r"zlibrary(?:\.\w+)*",
    r"b-ok(?:\.\w+)*",
    r"bookfi(?:\.\w+)*",
    r"libgen(?:\.\w+)*",
    r"library\s*genesis",
    r"sci[-\s]?hub(?:\.\w+)*",
    r"epub\.pub",
    r"pdfdrive(?:\.\w+)*",
    r"pdfroom(?:\.\w+)*",
    r"freepdfbook(?:\.\w+)*",
    r"booksc(?:\.\w+)*",
    r"anyflip(?:\.\w+)*",
    r"dokumen\.pub",
    r"[\w.-]+\.(?:sk|org|com|net|io|ru|cc|to)\b",
]
OTHER = 0.3


def paper_text(title: Column, abstract: Column, journal: Column) -> Column:
    return F.lower(F.concat_ws(" ", *(F.nullif(c, F.lit("")) for c in (title, abstract, journal))))


def keyword_share(text: Column, keywords: Column, boost: bool = False) -> Column:
    """Share of the keywords that the text contains; boosted by half, 1 at most. 0 without keywords."""
    hits = F.size(F.filter(keywords, lambda k: F.contains(text, F.lower(k))))
    share = F.when(F.size(keywords) > 0, hits / F.size(keywords)).otherwise(F.lit(0.0))
    return F.least(share * 1.5, F.lit(1.0)) if boost else share


def penalised(text: Column, terms: Column) -> Column:
    """A penalty term is in the text and `adult` is not."""
    return F.exists(terms, lambda t: F.contains(text, F.lower(t))) & ~F.contains(text, F.lit("adult"))


def study_type(text: Column) -> Column:
    """From title and abstract in lower case; a column, so that it is not made anew for each pattern."""
    out = F
    for name, pattern in STUDY_PATTERNS:
        out = out.when(text.rlike(pattern), name)
    return out.otherwise("unknown")


def study_type_score(text: Column, detected: Column) -> Column:
    """The detected type's score, else that of the best type which the text names."""
    known, named = F, F
    for name, score in STUDY_SCORES.items():
        known = known.when(detected == name, F.lit(score))
        named = named.when(F.contains(text, F.lit(name)), F.lit(score))
    return F.coalesce(known, named.otherwise(F.lit(OTHER)))


def recency(year: Column, as_of_year: int) -> Column:
    """1 for two years, down to 0.5 after ten, then slowly to 0.1."""
    age = F.lit(as_of_year) - year
    late = F.greatest(F.lit(0.1), 0.5 - (age - DECAY_YEARS) * 0.02)
    return F.when(year.isNull() | (year == 0), F.lit(OTHER)).when(age <= 2, F.lit(1.0)).when(age <= DECAY_YEARS, 1.0 - age / DECAY_YEARS * 0.5).otherwise(late)


def fixed_part(text: Column, detected: Column, year: Column, open_access: Column, as_of_year: int) -> Column:
    """What a paper scores whatever the topic."""
    parts = {"study_type_bonus": study_type_score(text, detected), "recency_bonus": recency(year, as_of_year), "open_access_bonus": F.when(open_access, F.lit(1.0)).otherwise(F.lit(0.0))}
    return sum((parts[k] * F.lit(WEIGHTS[k]) for k in parts), F.lit(0.0))


def raw_score(text: Column, fixed: Column, keywords: Column, boosts: Column, penalties: Column) -> Column:
    """The weighted score for a topic, not yet rounded."""
    total = keyword_share(text, keywords) * F.lit(WEIGHTS["keyword_match"]) + keyword_share(text, boosts, boost=True) * F.lit(WEIGHTS["boost_term_match"]) + fixed
    return F.when(penalised(text, penalties), F.lit(0.0)).otherwise(F.least(total / F.lit(sum(WEIGHTS.values())), F.lit(1.0)))


def year_in(text: Column) -> Column:
    """The first year from 1800 to 2029; null if there is none."""
    return F.nullif(F.regexp_extract(text, "(?<!\\d)(1[89]\\d{2}|20[0-2]\\d)(?!\\d)", 1), F.lit("")).cast("int")


def surname(author: Column) -> Column:
    """`Doe, Jane` and `Jane Doe` are Doe."""
    name = F.trim(author)
    return F.when(F.contains(name, F.lit(",")), F.trim(F.split(name, ",")[0])).otherwise(F.element_at(F.split(name, "\\s+"), -1))


def author_label(authors: Column, most: int = 2) -> Column:
    """Surnames of the first authors, with `et al.` if there are more."""
    names = F.filter(F.transform(authors, surname), lambda n: F.length(n) > 1)
    return F.concat(F.array_join(F.slice(names, 1, most), ", "), F.when(F.size(names) > most, " et al.").otherwise(""))


def without_noise(text: Column) -> Column:
    """A name without bracketed names of libraries and sites."""
    one = "(?:" + "|".join(NOISE) + ")"
    return F.trim(F.regexp_replace(F.regexp_replace(text, f"(?i)\\(\\s*{one}(?:\\s*,\\s*{one})*\\s*\\)", ""), "\\s{2,}", " "))


def cut_at_word(text: Column, length: int | Column) -> Column:
    """At most length characters, the last word whole where there are several."""
    size = length if isinstance(length, Column) else F.lit(length)
    cut = F.regexp_replace(F.substr(text, F.lit(1), size), " [^ ]*$", "")
    return F.when(F.length(text) <= size, text).otherwise(F.regexp_replace(cut, "[ \\-_,]+$", ""))


def safe_name(text: Column) -> Column:
    """A file name without characters that file systems forbid."""
    x = F.regexp_replace(F.regexp_replace(text, '[<>:"/\\\\|?*\\x00-\\x1f]', "_"), "_+", "_")
    return F.regexp_replace(F.regexp_replace(x, "\\s+", " "), "^[ _]+|[ _]+$", "")


def paper_file_name(title: Column, authors: Column, year: Column, length: int = 120) -> Column:
    """`title - authors (year).pdf`; the title is cut so that the rest fits."""
    named = F.nullif(author_label(authors), F.lit(""))
    rest = F.concat(F.coalesce(F.concat(F.lit(" - "), named), F.lit("")), F.coalesce(F.concat(F.lit(" ("), year.cast("string"), F.lit(")")), F.lit("")))
    return F.concat(safe_name(F.concat(cut_at_word(without_noise(title), F.greatest(F.lit(10), F.lit(length) - F.length(rest))), rest)), F.lit(".pdf"))


# What ends a list of authors, and how a bracket with authors looks.
AND_OTHERS = "(?i)\\s*(?:etc\\.?|u\\.a\\.?|and others|et al\\.?)$"
AUTHOR_BRACKET = "(?i)\\(([a-zäöüÄÖÜ][^()]{2,120}?(?:,\\s*[a-zäöüÄÖÜ][^()]{2,80}?)*)\\)"


def author_names(text: Column, most: int = 2) -> Column:
    """Surnames of a list of authors in one text, parted by commas or semicolons; a text of single letters stays as it is."""
    plain = F.trim(F.regexp_replace(text, AND_OTHERS, ""))
    names = F.filter(F.transform(F.split(plain, "[;,]"), F.trim), lambda n: F.length(n) > 1)
    last = F.transform(names, lambda n: F.element_at(F.split(n, "\\s+"), -1))
    joined = F.concat(F.array_join(F.slice(last, 1, most), ", "), F.when(F.size(last) > most, " et al.").otherwise(""))
    return F.when(F.size(names) == 0, plain).otherwise(joined)


def pdf_name(stem: Column, title: Column, author: Column, length: int = 120, most: int = 2) -> Column:
    """A PDF's new name without ending, `title - authors (year)`: from its metadata, and where they say nothing from its old name, whose
    bracketed sites, year and authors are taken off. The year is always the old name's."""
    clean = without_noise(stem)
    undated = F.trim(F.regexp_replace(clean, "\\(\\s*\\d{4}\\s*\\)", ""))
    bracket = F.regexp_extract(undated, AUTHOR_BRACKET, 1)
    bare = F.trim(F.regexp_replace(undated, "^(.*?)" + AUTHOR_BRACKET, "$1"))
    parsed = F.regexp_replace(F.regexp_replace(bare, "\\(\\s*\\)", ""), "^[ \\-_]+|[ \\-_]+$", "")
    stated, people = (F.nullif(without_noise(F.coalesce(c, F.lit(""))), F.lit("")) for c in (title, author))
    found = F.coalesce(stated, F.nullif(parsed, F.lit("")), stem)
    by = F.nullif(author_names(F.coalesce(people, F.when(stated.isNull(), F.nullif(bracket, F.lit(""))), F.lit("")), most), F.lit(""))
    year = F.nullif(F.regexp_extract(clean, "\\b(1[89]\\d{2}|20[0-2]\\d)\\b", 1), F.lit(""))
    rest = F.concat(F.coalesce(F.concat(F.lit(" - "), by), F.lit("")), F.coalesce(F.concat(F.lit(" ("), year, F.lit(")")), F.lit("")))
    whole = safe_name(F.concat(cut_at_word(found, F.greatest(F.lit(10), F.lit(length) - F.length(rest))), rest))
    return F.when(F.length(whole) > length, safe_name(cut_at_word(whole, length))).otherwise(whole)


def download_name(year: Column, identifier: Column, title: Column) -> Column:
    """Year, id and title as one word; 0000 without a year."""
    plain = F.substring(F.regexp_replace(identifier, "(?U)[^\\w]", ""), 1, 15)
    words = F.regexp_replace(F.trim(F.regexp_replace(F.substring(title, 1, 50), "(?U)[^\\w\\s-]", "")), "\\s+", "_")
    return F.concat_ws("_", F.coalesce(year.cast("string"), F.lit("0000")), plain, words)


def download_path(source: Column, year: Column, identifier: Column, title: Column, ending: Column) -> Column:
    """Where a download goes: a folder by source, the name by year, id and title."""
    return F.concat(F.coalesce(F.nullif(source, F.lit("")), F.lit("unknown")), F.lit("/"), download_name(year, identifier, title), ending)


#: Fixed value: bytes that a download has at least.
LEAST_BYTES = 1024


def download_urls(pdf: Column, fulltext: Column, doi: Column) -> Column:
    """The addresses to try, in order: PDF, full text, DOI's resolver."""
    resolver = F.when(F.length(F.coalesce(doi, F.lit(""))) > 0, F.concat(F.lit("https://doi.org/"), doi))
    return F.array_compact(F.array(F.nullif(pdf, F.lit("")), F.nullif(fulltext, F.lit("")), resolver))


def best_url(pdf: Column, fulltext: Column, doi: Column) -> Column:
    """The PDF, else the full text, else the DOI's resolver."""
    resolver = F.when(F.length(F.coalesce(doi, F.lit(""))) > 0, F.concat(F.lit("https://doi.org/"), doi))
    return F.coalesce(F.nullif(pdf, F.lit("")), F.nullif(fulltext, F.lit("")), resolver)
