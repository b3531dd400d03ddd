"""Papers: scoring against topics, ranking, greedy de-duplication, the store and its statistics."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataforge.functions.papers import fixed_part, paper_text, raw_score, study_type
from strataforge.operators.rounds import dropped, kept


TERMS = "array<struct<topic:string,keywords:array<string>,boost_terms:array<string>,penalty_terms:array<string>>>"


def score_papers(papers: DataFrame, topics: DataFrame, as_of_year: int, most_topics: int = 10_000, digits: int | None = 3, least: float | None = None, own: str | None = None) -> DataFrame:
    """Papers against topics (topic, keywords, boost_terms, penalty_terms). Topics are a configuration: checked to be few, they become
    one constant, and a paper's scores are made inside its row. Only topics of a score of `least` or more (all if None), or the one
    that the column `own` names, become rows. digits None leaves the score unrounded."""
    known = [r.asDict() for r in topics.select("topic", "keywords", "boost_terms", "penalty_terms").limit(most_topics + 1).collect()]
    if len(known) > most_topics:
        raise ValueError(f"more than {most_topics} topics")
    about = F.lower(F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("abstract", F.lit(""))))
    text = papers.withColumn("study_text", about).withColumn("paper_text", paper_text(F.col("title"), F.col("abstract"), F.col("journal")))
    typed = text.withColumn("study_type", study_type(F.col("study_text"))).drop("study_text")
    fixed = typed.withColumn("fixed_part", fixed_part(F.col("paper_text"), F.col("study_type"), F.col("year"), F.col("is_open_access"), as_of_year))

    def scored(paper: Column, topic: Column) -> Column:
        score = raw_score(paper["text"], paper["fixed"], topic["keywords"], topic["boost_terms"], topic["penalty_terms"])
        return F.struct(topic["topic"].alias("topic"), (score if digits is None else F.bround(score, digits)).alias("relevance_score"))

    terms = F.from_json(F.lit(json.dumps(known)), TERMS)
    if own is not None:
        terms = F.filter(terms, lambda t: t["topic"] == F.col(own))
    # the paper is bound to a variable, so that its text is made once and not for every topic
    found = F.flatten(F.transform(F.array(F.struct(F.col("paper_text").alias("text"), F.col("fixed_part").alias("fixed"))), lambda p: F.transform(terms, lambda t: scored(p, t))))
    if least is not None:
        found = F.filter(found, lambda s: s["relevance_score"] >= least)
    rest = [c for c in fixed.columns if c not in ("paper_text", "fixed_part")]
    return fixed.select(*rest, F.inline(found))


def rank(scored: DataFrame, least: float = 0.4, most: int = 20, key: str = "paper_id") -> DataFrame:
    """The best papers of each topic; Spark keeps `most` rows a topic and task before the shuffle."""
    place = F.row_number().over(Window.partitionBy("topic").orderBy(F.desc("relevance_score"), key))
    return scored.filter(F.col("relevance_score") >= least).withColumn("rank", place).filter(F.col("rank") <= most)


def short_title(title: Column) -> Column:
    return F.substring(F.lower(F.regexp_replace(title, "(?U)^\\s+|\\s+$", "")), 1, 80)


def paper_keys(doi: str = "doi", title: str = "title") -> Column:
    """What a paper shares with its doubles: DOI and title, in lower case and without blanks around; empty ones are none."""
    clean = F.lower(F.regexp_replace(F.col(doi), "(?U)^\\s+|\\s+$", ""))
    named = lambda kind, value: F.when(value != "", F.concat(F.lit(kind), value))
    return F.array_compact(F.array(named("d", clean), named("t", short_title(F.col(title)))))


def dedup_greedy(papers: DataFrame, group: str = "topic", order: str = "arrival") -> DataFrame:
    """In order of arrival a paper stays unless its DOI or title (80 characters) stayed before; dropped papers register nothing."""
    return first_wins(papers, paper_keys(), [group], [order])


def first_wins(rows: DataFrame, keys: Column, groups: list[str], order: list[str], rounds: int = 1000) -> DataFrame:
    """In order, a row stays unless one of its keys belongs to a row of its group that stayed before it.

    Each round decides all rows whose turn does not depend on an undecided one: a row that comes first on every key it has
    stays, and rows that share a key with it go. Finding the first of a key is an aggregation that combines in the tasks, so a key
    that most rows share costs no more than another; a row that is first on all its keys is a second one, by row. The keys of
    rows that stay are written before they are joined, so Spark can split a hot key. Decided rows leave, and a round's state is written.
    The rounds needed are the longest chain of rows that each wait for another; raises if `rounds` do not do."""
    numbered = kept(rows.withColumn("_row", F.monotonically_increasing_id()))
    at = F.struct(*order, "_row")
    held = numbered.select("_row", at.alias("at"), F.struct(*groups).alias("where"), F.array_distinct(keys).alias("keys"))
    done = [held.filter(F.size("keys") == 0).select("_row")]
    left = kept(held.select("_row", "at", "where", F.size("keys").alias("n"), F.explode("keys").alias("key")))
    for _ in range(rounds):
        if left.isEmpty():
            break
        first = left.groupBy("where", "key").agg(F.min(F.struct("at", "n")).alias("f")).select("where", "key", F.col("f.at._row").alias("_row"), "f.n")
        first = kept(first)
        stays = kept(first.groupBy("_row", "n").agg(F.count("*").alias("wins")).filter("wins = n").select("_row"))
        done.append(stays)
        taken = kept(first.join(stays, "_row", "left_semi").select("where", "key"))
        gone = left.join(taken, ["where", "key"], "left_semi").select("_row").distinct()
        before, left = left, kept(left.join(gone, "_row", "left_anti"))
        dropped(before, first, taken)
    else:
        raise RuntimeError(f"rows are not decided after {rounds} rounds")
    return numbered.join(reduce(DataFrame.unionByName, done), "_row", "left_semi").drop("_row")


def has_topic(topics: Column, topic: str) -> Column:
    return F.array_contains(topics, topic)


def pending_downloads(papers: DataFrame, most: int | None = None) -> DataFrame:
    """Open-access papers that are not downloaded yet, the best first."""
    out = papers.filter(F.col("is_open_access") & ~F.coalesce("downloaded", F.lit(False))).orderBy(F.desc("relevance_score"), "paper_id")
    return out.limit(most) if most is not None else out


def source_stats(papers: DataFrame) -> DataFrame:
    """Papers, downloads and open-access papers by source."""
    return papers.groupBy("source").agg(F.count("*").alias("papers"), F.count_if("downloaded").alias("downloaded"), F.count_if("is_open_access").alias("open_access"))


def totals(papers: DataFrame) -> DataFrame:
    """All papers, downloads and open-access papers in one row."""
    return papers.agg(F.count("*").alias("papers"), F.count_if("downloaded").alias("downloaded"), F.count_if("is_open_access").alias("open_access"))


def log_searches(found: DataFrame, topic: str, query: str, at: str) -> DataFrame:
    """Rows for the search log: papers found by source; to be appended."""
    return found.groupBy("source").agg(F.count("*").alias("result_count")).select("source", F.lit(topic).alias("topic"), F.lit(query).alias("query"), "result_count", F.lit(at).alias("searched_at"))


def update_store(store: DataFrame, found: DataFrame, topics: DataFrame, as_of_year: int, least: float = 0.4, most: int = 20, digits: int | None = 3) -> DataFrame:
    """The whole way of fetched papers (topic, arrival and paper fields) into the store: doubles out, scored against their own
    topic, the best of each kept, then inserted or, where better, updated. Columns are those of the store."""
    from strataforge.operators.incremental import upsert_if_better

    single = dedup_greedy(found)
    scored = score_papers(single.withColumnRenamed("topic", "own_topic"), topics, as_of_year, digits=digits, least=least, own="own_topic").drop("own_topic")
    ranked = rank(scored, least, most)
    listed = ranked.groupBy("paper_id").agg(F.collect_set("topic").alias("topics"), *(F.max_by(c, F.struct("relevance_score", "topic")).alias(c) for c in store.columns if c not in ("paper_id", "topics", "relevance_score")), F.max("relevance_score").alias("relevance_score"))
    return upsert_if_better(store, listed.select(*store.columns), "paper_id", "relevance_score")


def best(papers: DataFrame, k: int, topic: str | None = None, least: float = 0.0) -> DataFrame:
    rows = papers.filter(F.col("relevance_score") >= least)
    rows = rows.filter(has_topic(F.col("topics"), topic)) if topic is not None else rows
    return rows.orderBy(F.desc("relevance_score"), "paper_id").limit(k)


def listing(papers: DataFrame) -> DataFrame:
    """Papers as people read them, one line each: score, title of 70 characters, source, type of study and year."""
    known = lambda c, other: F.coalesce(F.col(c).cast("string"), F.lit(other)) if c in papers.columns else F.lit(other)
    line = F.format_string("[%.2f] %s | %s | %s | %s", F.coalesce(F.col("relevance_score").cast("double"), F.lit(0.0)), F.substring(known("title", ""), 1, 70), known("source", ""), known("study_type", "?"), known("year", "?"))
    return papers.select("paper_id", "relevance_score", line.alias("line"))


#: Columns of the CSV export.
EXPORT = ("paper_id", "title", "authors", "year", "journal", "doi", "source", "topics", "study_type", "relevance_score", "is_open_access")


def export(papers: DataFrame, path: str, form: str = "csv", force: bool = False) -> None:
    """CSV or JSON; refuses to overwrite without force."""
    flat = papers.select(*(F.array_join(c, "; ").alias(c) if c in ("authors", "topics") else F.col(c) for c in EXPORT if c in papers.columns))
    writer = (flat if form == "csv" else papers).write.mode("overwrite" if force else "errorifexists")
    writer.csv(path, header=True) if form == "csv" else writer.json(path)
