"""Quality rules of documents and, on top, of hosts. DataFrame functions only.

Every document gets counts from its whole text and a failure flag per rule. Failures are summed by host (one row per host and
task reaches the shuffle, so a host with a third of the rows costs nothing), host rates are shrunk towards a beta prior that is
fitted to the rates of all hosts by moments, and a host is rejected where the shrunk rate of any rule, or that of documents
failing one rule or another, exceeds HOST_LIMIT, so that more of its documents are expected to fail than to pass; its
documents are not kept, nor those that fail a base rule themselves. Verdicts by document come from counts that are
computed once and written, without texts. The hosts' verdicts, of which only rejections are joined, are broadcast up to MOST_HOSTS and otherwise joined by a shuffle that Spark can split.

Words in repeated windows are found by comparing 64-bit hashes of 8-word windows within one text.

Edge cases: a null or empty text has no words (and so fails); a null host has no host verdict; repeated rows count each; other
columns are carried if asked for, also with names that are used here; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataforge.llm.common import broadcast_if_small, free_name, let, words, written

SYMBOLS = "[#*$%&|<>]"
WINDOW = 8
LEAST_WORDS = 20
HOST_LIMIT = 0.5
MOST_HOSTS = 100_000
#: Bounds of the prior's strength in documents, and its value where the hosts' rates do not vary.
WEAKEST, STRONGEST, UNVARIED = 2.0, 10_000.0, 10.0
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Rules by name; F. is the struct of counts.
RULES = {
    "few_words": f"F.n_words < {LEAST_WORDS}",
    "repeated_words": "100 * F.n_repeat_words > 30 * F.n_words",
    "symbols": "10 * F.n_symbols > F.n_words",
    "word_length": "F.word_chars < 2 * F.n_words OR F.word_chars > 12 * F.n_words",
    "repeated_lines": "10 * F.n_dup_lines > 3 * F.n_lines",
}
BASE = ["few_words", "repeated_words"]
#: What hosts are judged by.
JUDGED = RULES | {"any_rule": " OR ".join(f"({sql})" for sql in RULES.values())}


def _repeated(w: Column) -> Column:
    """Words of w that lie in a window of WINDOW words found twice or more."""
    def covered(places: Column) -> Column:
        reach = F.transform(places, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(places, k + 1) - p, F.lit(WINDOW))))
        return F.aggregate(reach, F.lit(0).cast("long"), lambda a, x: a + x)

    def twice(ordered: Column) -> Column:
        same = F.filter(ordered, lambda e, k: e["h"].eqNullSafe(F.get(ordered, k - 1)["h"]) | e["h"].eqNullSafe(F.get(ordered, k + 1)["h"]))
        return let(F.sort_array(F.transform(same, lambda e: e["i"])), covered)

    def of(hashes: Column) -> Column:
        ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(let(ordered, twice))

    windows = F.transform(F.sequence(F.lit(1), F.size(w) - WINDOW + 1), lambda i: F.xxhash64(F.slice(w, i, WINDOW)))
    return F.when(F.size(w) < WINDOW + 1, F.lit(0).cast("long")).otherwise(let(windows, of))


def counts(text: Column) -> Column:
    """The counts of a whole text as a struct of longs."""
    whole = F.coalesce(text, F.lit(""))

    def of_words(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.aggregate(w, F.lit(0).cast("long"), lambda a, x: a + F.length(x)).alias("word_chars"),
            (F.size(F.split(whole, SYMBOLS)) - 1).cast("long").alias("n_symbols"),
            _repeated(w).alias("n_repeat_words"),
        )

    def of_lines(lines: Column) -> Column:
        return F.struct(F.size(lines).cast("long").alias("n_lines"), (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"))

    lines = F.filter(F.split(whole, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    both = F.struct(let(words(text), of_words).alias("w"), let(lines, of_lines).alias("l"))
    return let(both, lambda b: F.struct(*(b["w"][c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_repeat_words")), b["l"]["n_lines"].alias("n_lines"), b["l"]["n_dup_lines"].alias("n_dup_lines")))


def _rule(sql: str, counted: str) -> Column:
    return F.expr(sql.replace("F.", f"{counted}."))


def rejected_hosts(counted: DataFrame, host: str, column: str, limit: float = HOST_LIMIT) -> DataFrame:
    """counted: rows with a host and the struct of counts. Returns the hosts whose shrunk failure rate of some rule is above limit."""
    sums = written(
        counted.filter(F.col(host).isNotNull()).groupBy(F.col(host).alias("bad_host")).agg(F.count("*").alias("n"), *(F.sum(_rule(sql, column).cast("long")).alias(r) for r, sql in JUDGED.items())),
        "hosts",
    )
    rates = sums.agg(*(F.struct(F.avg(F.col(r) / F.col("n")).alias("m"), F.var_pop(F.col(r) / F.col("n")).alias("v")).alias(r) for r in JUDGED)).first()
    bad = F.lit(False)
    for r in JUDGED:
        m, v = rates[r].m or 0.0, rates[r].v or 0.0
        strength = min(max(m * (1 - m) / v - 1, WEAKEST), STRONGEST) if v > 0 else UNVARIED
        bad = bad | ((F.col(r) + m * strength) / (F.col("n") + strength) > limit)
    return sums.filter(bad).select("bad_host")


def apply_rules(docs: DataFrame, text: str = "text", host: str = "source", keep: list[str] | None = None) -> DataFrame:
    """Returns the kept columns (all by default), counts_of_text (struct), base_failed and kept for each row of docs."""
    names = docs.columns if keep is None else keep
    counted = written(docs.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"), F.col(host).alias("host"), counts(F.col(text)).alias("counts_of_text")), "rules")
    bad = rejected_hosts(counted, "host", "counts_of_text")
    failed = F.lit(False)
    for r in BASE:
        failed = failed | _rule(RULES[r], "counts_of_text")
    joined = counted.join(broadcast_if_small(bad, MOST_HOSTS), F.col("host") == F.col("bad_host"), "left")
    return joined.select("row", "counts_of_text", failed.alias("base_failed"), (~failed & F.col("bad_host").isNull()).alias("kept"))


def document_verdicts(docs: DataFrame) -> DataFrame:
    out = apply_rules(docs.select("doc_id", "source", "text"), keep=["doc_id"])
    return out.select("row.doc_id", *(f"counts_of_text.{c}" for c in COUNTS), "base_failed", "kept")


def keep_by_rules(docs: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """The rows of docs that are kept, with the columns of docs. Counting costs more than writing: every text is counted once,
    and the rows that pass the base rules are read again from a written copy without the counts."""
    counted, base = (free_name(docs, x) for x in ("counts_of_text", "base_failed"))
    failed = F.lit(False)
    for r in BASE:
        failed = failed | _rule(RULES[r], counted)
    names = [F.col(f"`{c}`") for c in docs.columns]
    # rows that fail are kept without their columns, for the hosts' sums
    shell = [F.when(~F.col(base), c).alias(c_name) for c, c_name in zip(names, docs.columns, strict=True)]
    whole = docs.withColumn(counted, counts(F.col(f"`{text}`"))).withColumn(base, failed)
    flags = F.struct(*(F.col(counted)[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")))
    copy = written(whole.select(F.struct(*shell).alias("row"), F.col(f"`{host}`").alias("host"), flags.alias("counts_of_text"), F.col(base).alias("base_failed")), "ruled")
    bad = rejected_hosts(copy, "host", "counts_of_text")
    fine = copy.filter(~F.col("base_failed"))
    return fine.join(broadcast_if_small(bad, MOST_HOSTS), F.col("host") == F.col("bad_host"), "left_anti").select("row.*")


def document_verdicts_sql() -> str:
    flags = ", ".join(f"sum(({sql.replace('F.', '')})::INT) AS {r}" for r, sql in JUDGED.items())
    fits = ", ".join(f"avg({r} / n) AS m_{r}, var_pop({r} / n) AS v_{r}" for r in JUDGED)
    strength = lambda r: f"CASE WHEN v_{r} > 0 THEN least(greatest(m_{r} * (1 - m_{r}) / v_{r} - 1, {WEAKEST}), {STRONGEST}) ELSE {UNVARIED} END"
    bad = " OR ".join(f"({r} + m_{r} * ({strength(r)})) / (n + ({strength(r)})) > {HOST_LIMIT}" for r in JUDGED)
    base = " OR ".join(f"({RULES[r].replace('F.', '')})" for r in BASE)
    return f"""
    WITH d AS (SELECT row_number() OVER () AS rn, doc_id, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
    wins AS (SELECT rn, unnest(range(1, len(w) - {WINDOW - 2})) AS i, w FROM d WHERE len(w) >= {WINDOW}),
    named AS (SELECT rn, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS g FROM wins),
    twice AS (SELECT rn, i FROM (SELECT rn, i, count(*) OVER (PARTITION BY rn, g) AS k FROM named) WHERE k > 1),
    covered AS (SELECT rn, count(*) AS n_repeat_words FROM (SELECT DISTINCT rn, unnest(range(i, i + {WINDOW})) AS p FROM twice) GROUP BY rn),
    lines AS (SELECT rn, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup_lines FROM (SELECT rn, unnest(string_split(t, chr(10))) AS l FROM d)
              WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]') GROUP BY rn),
    c AS (SELECT doc_id, source, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
                 len(regexp_extract_all(t, '{SYMBOLS}'))::BIGINT AS n_symbols, coalesce(n_lines, 0)::BIGINT AS n_lines,
                 coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
          FROM d LEFT JOIN covered USING (rn) LEFT JOIN lines USING (rn)),
    hosts AS (SELECT source AS host, count(*)::DOUBLE AS n, {flags} FROM c WHERE source IS NOT NULL GROUP BY 1),
    prior AS (SELECT {fits} FROM hosts),
    bad AS (SELECT host FROM hosts, prior WHERE {bad})
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, ({base}) AS base_failed,
           NOT ({base}) AND (source IS NULL OR source NOT IN (SELECT host FROM bad)) AS kept FROM c"""
