"""Wiki audit: which evidence the wiki uses anywhere in its text, broken lineage, links that lead nowhere."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataforge.functions.links import is_external, is_ignored, link_path, markdown_links, resolve_path
from strataforge.functions.text import chapter_key
from strataforge.operators.rounds import kept

#: Ids of an evidence record, from the record itself to its source.
IDS = ("evidence_id", "chunk_id", "chapter_id", "document_id", "source_id")
HEAD = 4
#: Characters of a stretch that is cut from longer runs.
STRETCH = 1000


def filled(column: str) -> Column:
    """An id as text without blanks around it; a missing one is empty."""
    return F.regexp_replace(F.coalesce(F.col(column).cast("string"), F.lit("")), "(?U)^\\s+|\\s+$", "")


def contained(ids: DataFrame, pages: DataFrame, text: str = "page") -> DataFrame:
    """ids: id. Those that occur anywhere in a page, inside longer words too.

    An occurrence lies within a run of characters that ids are made of, so pages shrink to their distinct runs first. At each
    place of a run the first characters tell which lengths an id could have there; what stands there in such a length either
    is an id or not, which is a join on equality. Neither side is compared with all of the other."""
    wanted = kept(ids.select(F.col("id").cast("string").alias("id")).filter("id <> ''").distinct())
    sizes = wanted.agg(F.min(F.length("id")).alias("least"), F.max(F.length("id")).alias("most")).first()
    if sizes.least is None:
        return wanted
    letters = wanted.select(F.explode(F.regexp_extract_all("id", F.lit("(?s)."), F.lit(0))).alias("c")).distinct().collect()  # one row a character in use
    alphabet = "".join(f"\\x{{{ord(r.c):x}}}" for r in letters)
    runs = pages.select(F.explode(F.array_distinct(F.regexp_extract_all(text, F.lit(f"[{alphabet}]{{{sizes.least},}}"), F.lit(0)))).alias("run")).distinct()
    starts = F.sequence(F.lit(1), F.length("run"), F.lit(STRETCH))
    runs = runs.select(F.explode(F.transform(starts, lambda i: F.substr("run", i, F.lit(STRETCH + sizes.most - 1)))).alias("run")).filter(F.length("run") >= sizes.least)
    head = min(HEAD, sizes.least)
    shapes = wanted.groupBy(F.substring("id", 1, head).alias("head")).agg(F.collect_set(F.length("id")).alias("sizes"))
    places = runs.select("run", F.explode(F.sequence(F.lit(1), F.length("run") - sizes.least + 1)).alias("at")).withColumn("head", F.substr("run", "at", F.lit(head)))
    fits = places.join(shapes, "head").select("run", "at", F.explode("sizes").alias("size")).filter(F.col("at") + F.col("size") - 1 <= F.length("run"))
    found = fits.select(F.substr("run", "at", "size").alias("id")).distinct()
    return wanted.join(found, "id", "left_semi")


def integration(evidence: DataFrame, pages: DataFrame, text: str = "page") -> DataFrame:
    """Per evidence record: which of its ids the wiki has in its text, and so what layers it refers to. Empty ids are never found.
    source_key: source, document, evidence or chunk id, whichever is there first."""
    rows = evidence.select(*(filled(c).alias(c) for c in IDS))
    found = kept(contained(rows.select(F.explode(F.array(*IDS)).alias("id")), pages, text))
    out = rows
    for key in IDS:
        ids = found.select(F.col("id").alias(f"w_{key}"))
        out = out.join(ids, out[key] == ids[f"w_{key}"], "left").withColumn(f"in_{key}", F.col(f"w_{key}").isNotNull()).drop(f"w_{key}")
    layer10 = F.col("in_document_id") | F.col("in_source_id")
    named = F.coalesce(*(F.nullif(F.col(c), F.lit("")) for c in ("source_id", "document_id", "evidence_id", "chunk_id")), F.lit("unknown_source"))
    out = out.withColumns({"source_key": named, "layer30": F.col("in_chunk_id"), "layer20": F.col("in_chapter_id"), "layer10": layer10})
    return out.withColumn("integrated", F.col("in_evidence_id") | F.col("layer30") | F.col("layer20") | F.col("layer10"))


def source_rollup(records: DataFrame) -> DataFrame:
    """Per source: records and whether any is used, and at what layer."""
    return records.groupBy("source_key").agg(F.count("*").alias("records"), *(F.bool_or(c).alias(c) for c in ("integrated", "layer30", "layer20", "layer10")))


def broken_lineage(evidence: DataFrame, chunks: DataFrame, chapters: DataFrame, documents: DataFrame) -> DataFrame:
    """evidence_id, layer, id and problem of every id of a record that its layer does not have. Empty ids refer to nothing; chapters are
    compared in one spelling. All kinds go through one join."""
    chapter = lambda c: F.when(filled(c) != "", chapter_key(F.col(c))).otherwise("")
    kinds = {"chunk_id": ("30", filled("chunk_id")), "chapter_id": ("20", chapter("chapter_id")), "document_id": ("10", filled("document_id")), "source_id": ("10", filled("source_id"))}
    ask = F.array(*(F.struct(F.lit(k).alias("kind"), F.lit(layer).alias("layer"), ident.alias("key"), filled(k).alias("id")) for k, (layer, ident) in kinds.items()))
    asked = evidence.select(filled("evidence_id").alias("evidence_id"), F.inline(ask)).filter("id <> ''")
    has = {"chunk_id": chunks.select(filled("chunk_id")), "chapter_id": chapters.select(chapter("chapter")), "document_id": documents.select(filled("document_id")), "source_id": documents.select(filled("source_id"))}
    known = reduce(DataFrame.unionAll, (rows.toDF("key").select(F.lit(k).alias("kind"), "key") for k, rows in has.items())).distinct()
    missing = asked.join(known, ["kind", "key"], "left_anti")
    return missing.select("evidence_id", "layer", "id", F.concat(F.regexp_replace("kind", "_id$", ""), F.lit("_missing")).alias("problem"))


def page_links(pages: DataFrame, text: str = "page") -> DataFrame:
    """Links of pages, each external, ignored or internal."""
    links = pages.select("topic", F.posexplode(markdown_links(F.col(text))).alias("pos", "link"))
    kind = F.when(is_ignored(F.col("link")), "ignored").when(is_external(F.col("link")), "external").otherwise("internal")
    return links.withColumn("kind", kind)


def broken_links(links: DataFrame, files: DataFrame, folder: Column | None = None) -> DataFrame:
    """Internal links to no file, and those without a path. files: name, from the wiki's root; folder: of the page that a link stands on.
    A target without an ending may also be a page."""
    names = files.select(F.regexp_replace("name", "^/+", "").alias("file")).distinct()
    target = resolve_path(folder if folder is not None else F.lit(""), link_path(F.col("link")))
    inner = links.filter("kind = 'internal'").withColumn("target", F.when(link_path(F.col("link")) != "", target))
    bare = ~F.element_at(F.split("target", "/"), -1).rlike("[^.].*\\.[^.]+$")
    asked = inner.withColumn("other", F.when(bare, F.concat("target", F.lit(".md"))))
    direct = asked.join(names, F.col("target") == F.col("file"), "left_anti")
    return direct.join(names, F.col("other") == F.col("file"), "left_anti").drop("target", "other")


def stale(external: DataFrame, as_of: str, days: int = 730) -> DataFrame:
    """external: link, last_modified (date). Links whose target is older than `days`."""
    age = F.datediff(F.lit(as_of).cast("date"), F.col("last_modified").cast("date"))
    return external.withColumn("age_days", age).filter(F.col("age_days") > days)


def external_findings(links: DataFrame, checks: DataFrame, as_of: str, days: int = 730) -> DataFrame:
    """External links with what a request for them gave. checks: link, http_status (null: no answer), last_modified (date or null).
    status: error, stale, ok, or skipped where a link was not requested."""
    told = checks.groupBy("link").agg(F.max_by(F.struct("http_status", "last_modified"), F.coalesce("last_modified", F.lit("1970-01-01").cast("date"))).alias("told"))
    both = links.filter("kind = 'external'").join(told, "link", "left")
    code, age = F.col("told.http_status"), F.datediff(F.lit(as_of).cast("date"), F.col("told.last_modified"))
    status = F.when(F.col("told").isNull(), "skipped").when(code.isNull() | (code >= 400), "error").when(age > days, "stale").otherwise("ok")
    return both.select("topic", "pos", "link", status.alias("status"))


def audit_summary(records: DataFrame, pages: DataFrame, lineage: DataFrame, links: DataFrame, broken: DataFrame, external: DataFrame) -> DataFrame:
    """The counters of an audit in one row; each side is aggregated to one row first."""
    lacking = lambda c: F.count_if(~F.col(c))
    parts = [
        records.agg(F.count("*").alias("index_records")),
        pages.agg(F.count("*").alias("wiki_files")),
        source_rollup(records).agg(
            F.count("*").alias("sources_total"), F.count_if("integrated").alias("sources_integrated"), lacking("integrated").alias("sources_missing"),
            *(lacking(f"layer{n}").alias(f"sources_missing_layer{n}_ref") for n in (30, 20, 10)),
        ),
        lineage.agg(F.count("*").alias("lineage_missing_links")),
        links.agg(F.count_if(F.col("kind") == "internal").alias("internal_links_checked")),
        broken.agg(F.count("*").alias("internal_links_broken")),
        external.agg(*(F.count_if(c).alias(f"external_links_{name}") for name, c in (("checked", F.col("status") != "skipped"), ("broken", F.col("status") == "error"), ("stale", F.col("status") == "stale")))),
    ]
    return reduce(lambda a, b: a.join(b, F.lit(True)), parts)


def id_sets(layers: dict[str, DataFrame], kinds: tuple[str, ...] = ("document_id", "source_id", "chapter_id", "chunk_id", "evidence_id")) -> DataFrame:
    """layer, kind and id of all ids that layers have, each once; a layer is read once, however many kinds it has."""
    parts = []
    for name, rows in layers.items():
        own = [k for k in kinds if k in rows.columns]
        pairs = F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), F.col(k).cast("string").alias("id")) for k in own)))
        parts.append(rows.select(pairs.alias("x")).filter("x.id is not null and x.id <> ''").select(F.lit(name).alias("layer"), "x.kind", "x.id").distinct())
    return reduce(DataFrame.unionByName, parts)
