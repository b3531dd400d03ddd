"""Offline encyclopedia dumps: Spark's XML reader splits them by page element (plain and bz2); of xz, which it does not read, tasks
take the blocks (see xz)."""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataforge.operators.rounds import kept
from strataforge.sources import xz

SCHEMA = "title string, ns int, id bigint, redirect struct<_title:string>, revision struct<id:bigint,timestamp:string,text:struct<_VALUE:string>>"


FLAT = "ns int, title string, page_id long, revision_id long, updated_at string, wikitext string, redirect string"


BEGINS, ENDS = re.compile(rb"<page[\s>]"), b"</page>"
#: Compressed bytes of the blocks that a task owns.
PART = 32 << 20


def page_of(record: bytes) -> tuple:
    """The fields of a page element."""
    node = ET.fromstring(record)

    def at(*path: str) -> ET.Element | None:
        found = node
        for tag in path:
            found = next((c for c in found if c.tag == tag), None) if found is not None else None
        return found

    said = lambda *path: (x.text or "") if (x := at(*path)) is not None else None
    whole = lambda text: int(text) if (text or "").strip().isdigit() else None
    redirect = at("redirect")
    return whole(said("ns")), said("title"), whole(said("id")), whole(said("revision", "id")), said("revision", "timestamp"), said("revision", "text") or None, None if redirect is None else redirect.get("title")


def xz_pages(spark: SparkSession, path: str, part: int = PART, batch: int = 500) -> DataFrame:
    """Pages of xz files (a name or a pattern): a file of many blocks in several tasks, one of a single block in one."""
    names = [x.split()[0] for x in FLAT.split(", ")]
    kinds = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for given in batches:
            for p in given.column(0).to_pylist():
                with xz.opened(p) as file:
                    found = xz.ranges(file, part)
                if found:
                    first, behind = zip(*found, strict=True)
                    yield pa.record_batch([pa.array([p] * len(found)), pa.array(first, pa.int64()), pa.array(behind, pa.int64())], ["path", "first", "behind"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = lambda rows: pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)
        for given in batches:
            for p, first, behind in zip(*(c.to_pylist() for c in given.columns), strict=True):
                rows = []
                with xz.opened(p) as file:
                    for record in xz.records(file, first, behind, BEGINS, ENDS):
                        rows.append(page_of(record))
                        if len(rows) == batch:
                            yield made(rows)
                            rows = []
                if rows:
                    yield made(rows)

    files = spark.read.format("binaryFile").load(path).select("path")
    parts = kept(files.mapInArrow(plan, "path string, first long, behind long"))
    return parts.repartition(max(1, parts.count()), "path", "first").mapInArrow(read, FLAT)


def read_dump(spark: SparkSession, path: str) -> DataFrame:
    """ns, title, page_id, revision_id, updated_at, wikitext and source_path of each page. A page that only names its redirect
    in an attribute gets the text that says so."""
    if path.lower().endswith(".xz"):
        stub = F.concat(F.lit("#REDIRECT [["), "redirect", F.lit("]]"))
        return xz_pages(spark, path).select("ns", "title", "page_id", "revision_id", "updated_at", F.coalesce("wikitext", stub).alias("wikitext"), F.lit(path).alias("source_path"))
    rows = spark.read.format("xml").option("rowTag", "page").option("ignoreSurroundingSpaces", "false").schema(SCHEMA).load(path)
    text = F.coalesce(F.nullif("revision.text._VALUE", F.lit("")), F.concat(F.lit("#REDIRECT [["), "redirect._title", F.lit("]]")))
    return rows.select("ns", "title", F.col("id").alias("page_id"), F.col("revision.id").alias("revision_id"), F.col("revision.timestamp").alias("updated_at"), text.alias("wikitext"), F.lit(path).alias("source_path"))


def article_text(pages: DataFrame, domain: str) -> DataFrame:
    """Pages as files with front matter: file name and text."""
    from strataforge.functions.text import slug

    name = slug(F.col("title"))
    url = F.concat(F.lit("https://en.wikipedia.org/wiki/"), F.replace("title", F.lit(" "), F.lit("_")))
    fields = {"source": F.lit("wikipedia_offline_dump"), "source_url": url, "title": F.col("title"), "page_id": F.col("page_id").cast("string"), "revision_id": F.col("revision_id").cast("string"), "updated_at": F.col("updated_at"), "lineage_source_id": F.concat(F.lit("wiki_en_"), name), "lineage_document_id": F.concat(F.lit(f"{domain}_wiki_"), name)}
    lines = [F.concat(F.lit(f"{k}: "), F.to_json(F.struct(F.coalesce(v, F.lit("")).alias("v"))).substr(F.lit(6), F.lit(1 << 30))) for k, v in fields.items()]
    head = F.concat(F.lit("---\n"), F.array_join(F.transform(F.array(*lines), lambda x: F.regexp_replace(x, "\\}$", "")), "\n"), F.lit("\n---\n\n"))
    return pages.select("title", F.concat(F.lit("wikipedia_"), name, F.lit(".txt")).alias("file_name"), F.concat(head, F.trim("wikitext"), F.lit("\n")).alias("text"))


def stored_articles(files: DataFrame) -> DataFrame:
    """files: file_name, text, legacy (title from old metadata or null). The title from the front matter, else from old metadata, else from the name."""
    stated = F.nullif(F.regexp_extract("text", '(?m)^title:\\s*"?([^"\n]*)"?', 1), F.lit(""))
    named = F.regexp_replace(F.regexp_replace("file_name", "^wikipedia_|\\.txt$", ""), "_", " ")
    return files.withColumn("title", F.coalesce(stated, F.nullif("legacy", F.lit("")), named))
