"""Offline encyclopedia pages as a graph: redirects, breadth-first expansion, refresh of stored articles."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strataforge.functions.links import redirect_target, wiki_links, wiki_title
from strataforge.operators.rounds import kept

LOOKUPS = 8


def index_pages(raw: DataFrame) -> DataFrame:
    """raw: ns, title, page_id, revision_id, updated_at, wikitext, source_path. Articles with normalised titles, links and
    redirects; of a title that repeats the greatest revision counts."""
    target = redirect_target(F.col("wikitext"))
    rows = raw.filter((F.coalesce("ns", F.lit(0)) == 0) & (F.trim(F.coalesce("title", F.lit(""))) != "") & (F.trim(F.coalesce("wikitext", F.lit(""))) != ""))
    rows = rows.select(wiki_title(F.col("title")).alias("title"), "page_id", "revision_id", "updated_at", "wikitext", wiki_links(F.col("wikitext")).alias("links"), target.alias("redirect_target"), target.isNotNull().alias("is_redirect"), "source_path")
    rest = [c for c in rows.columns if c != "title"]
    return rows.groupBy("title").agg(F.max_by(F.struct(*rest), F.struct("revision_id", "page_id")).alias("p")).select("title", "p.*")


def edges(pages: DataFrame) -> DataFrame:
    return pages.select(F.col("title").alias("src"), F.posexplode("links").alias("pos", "dst"))


def resolve_redirects(titles: DataFrame, pages: DataFrame, lookups: int = LOOKUPS) -> DataFrame:
    """titles: title. Adds `canonical`, the page that up to `lookups` lookups reach; null for missing titles, cycles and longer
    chains. One frame goes through all rounds, a join with a narrow page table in each."""
    hops = pages.select(F.col("title").alias("page"), F.when(F.col("is_redirect"), F.col("redirect_target")).alias("next"))
    now = titles.select("title").distinct().select("title", F.col("title").alias("at"), F.lit(None).cast("string").alias("canonical"))
    for _ in range(lookups):  # `at` is null once a title is resolved or lost
        met = now.join(hops, F.col("at") == F.col("page"), "left")
        now = met.select("title", F.col("next").alias("at"), F.coalesce("canonical", F.when(F.col("next").isNull(), F.col("page"))).alias("canonical"))
    return titles.join(now.drop("at"), "title", "left")


def expand(seeds: DataFrame, pages: DataFrame, depth: int, most: int | None = None) -> DataFrame:
    """Breadth first from seeds (title, in order of `pos`) over links, redirects resolved: canonical title, depth and parent of
    each page reached, parents being the first by order of discovery. A round is a join and an anti-join; with `most` see crawl."""
    if most is not None:
        return crawl(seeds, pages, depth, most).select("title", "depth", "parent")
    resolve = lambda t: resolve_redirects(t.select("title").distinct(), pages)
    first = lambda df: df.groupBy("title").agg(F.min_by(F.struct("parent", "pos"), "pos").alias("f")).select("title", "f.parent", "f.pos")
    start = seeds.select(wiki_title(F.col("title")).alias("title"), F.lit("").alias("parent"), F.array(F.col("pos").cast("long")).alias("pos"))
    level = start.join(resolve(start), "title").filter("canonical is not null").select(F.col("canonical").alias("title"), "parent", "pos")
    seen = kept(first(level).withColumn("depth", F.lit(0)))
    front = seen
    for d in range(1, depth + 1):
        links = front.select(F.col("title").alias("src"), F.col("pos").alias("path")).join(edges(pages).withColumnRenamed("pos", "nth"), "src").select(wiki_title(F.col("dst")).alias("title"), F.col("src").alias("parent"), F.concat("path", F.array(F.col("nth").cast("long"))).alias("pos"))
        reached = links.join(resolve(links), "title").filter("canonical is not null").select(F.col("canonical").alias("title"), "parent", "pos")
        front = kept(first(reached).join(seen.select("title"), "title", "left_anti").withColumn("depth", F.lit(d)))
        if front.isEmpty():
            break
        seen = seen.unionByName(front)  # each front is written once
    return seen.select("title", "depth", "parent")


#: Waiting titles, as a multiple of the pages wanted, from which on links are no longer followed.
WAITING = 3


def crawl(seeds: DataFrame, pages: DataFrame, depth: int, most: int, waiting: int = WAITING) -> DataFrame:
    """The pages that a queue would visit that stops at `most` pages and takes links only while visited and waiting titles are
    fewer than `waiting` times as many: title, depth, parent and `number`, the place in the order of visits.

    A level is the queue's titles of one depth, numbered in the order in which they were appended, which is that in which they are taken.
    Visits are first occurrences of pages not seen on earlier levels; running counts over the level give how many were visited and
    how many titles had been appended when each was taken, and from them how many of its links still fitted: with L links each, at most
    T titles appended in all (T grows by one with every title that was no visit), S the running sum of L and A titles before,
    A' = S + min(A, least T - S so far). Counts end inside the level where `most` is reached, and no level beyond is read.
    The level's running counts are one sorted pass over numbers; its rows are bounded by the bounds of the crawl, not by the pages."""
    resolve = lambda t: resolve_redirects(t.select("title").filter("title <> ''").distinct(), pages)
    links = pages.select(F.col("title").alias("page"), F.size(F.coalesce("links", F.array().cast("array<string>"))).cast("long").alias("has"))
    order = Window.orderBy("at")
    level = kept(seeds.select(wiki_title(F.coalesce("title", F.lit(""))).alias("title"), F.lit("").alias("parent"), F.row_number().over(Window.orderBy("pos")).cast("long").alias("at")))
    appended, visited, seen = level.count(), 0, None
    for d in range(depth + 1):
        named = level.join(resolve(level), "title", "left")
        fresh = named if seen is None else named.join(seen.select(F.col("title").alias("canonical"), F.lit(True).alias("old")), "canonical", "left").withColumn("canonical", F.when(F.col("old").isNull(), F.col("canonical")))
        firsts = fresh.filter("canonical is not null").groupBy("canonical").agg(F.min("at").alias("at")).select("at", F.lit(1).alias("visit"))
        counted = fresh.join(firsts, "at", "left").withColumn("visit", F.coalesce("visit", F.lit(0))).withColumn("number", F.lit(visited) + F.sum("visit").over(order))
        taken = kept(counted.filter((F.col("visit") == 1) & (F.col("number") <= most)).join(links, F.col("canonical") == F.col("page")).select(F.col("canonical").alias("title"), F.lit(d).alias("depth"), "parent", "number", "at", "has"))
        seen = taken if seen is None else seen.unionByName(taken)
        reached = taken.agg(F.max("number")).first()[0] or visited
        if reached == visited or reached >= most or d == depth:
            break
        visited = reached
        limit = F.lit(waiting * most) + F.col("at") - F.col("number")
        fits = taken.withColumn("limit", limit).withColumn("offered", F.when(limit > appended, F.col("has")).otherwise(0)).withColumn("sum", F.sum("offered").over(order))
        least = F.min(F.when(F.col("limit") > appended, F.col("limit") - F.col("sum"))).over(order)
        total = fits.withColumn("total", F.col("sum") + F.least(F.lit(appended), F.coalesce(least, F.lit(appended))))
        room = total.withColumn("before", F.coalesce(F.lag("total").over(order), F.lit(appended))).filter("total > before").select(F.col("title").alias("page"), "before", (F.col("total") - F.col("before")).cast("int").alias("take"))
        found = room.join(pages.select(F.col("title").alias("page"), "links"), "page").select("page", "before", F.posexplode(F.slice("links", F.lit(1), F.col("take"))).alias("nth", "dst"))
        level = kept(found.select(wiki_title(F.col("dst")).alias("title"), F.col("page").alias("parent"), (F.col("before") + F.col("nth") + 1).alias("at")))
        appended = level.agg(F.max("at")).first()[0]
        if appended is None:
            break
    return seen.select("title", "depth", "parent", F.col("number").cast("long").alias("number"))


def refresh(articles: DataFrame, pages: DataFrame, force: bool = False) -> DataFrame:
    """articles: title, text, revision_id, updated_at. Status of each against the dump: changed, unchanged or missing."""
    known = pages.select("title", F.col("wikitext").alias("new_text"), F.col("revision_id").alias("new_revision"), F.col("updated_at").alias("new_updated"))
    named = resolve_redirects(articles.select("title"), pages)
    both = articles.join(named, "title").join(known.withColumnRenamed("title", "page"), F.col("canonical") == F.col("page"), "left")
    same = (F.col("text").eqNullSafe(F.col("new_text"))) & F.col("revision_id").eqNullSafe(F.col("new_revision")) & F.col("updated_at").eqNullSafe(F.col("new_updated")) & F.col("title").eqNullSafe(F.col("page"))
    status = F.when(F.col("page").isNull(), "missing").when(same & ~F.lit(force), "unchanged").otherwise("changed")
    return both.select("title", "canonical", status.alias("status"))
