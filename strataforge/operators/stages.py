"""The stages from raw markdown to topic pages: documents, chapters, chunks, evidence, embeddings, wiki.

Each stage is one projection or one Arrow pass that explodes; only numbering and topic pages shuffle. Keys are ids, never file
names, so chapters of one document cannot overwrite each other."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from strataforge.functions.text import chapter_key, nonempty, preview, safe_title, slug, token_count, windows, yaml_escape
from strataforge.functions.vectors import MODEL, hash_vector
from strataforge.operators import textplan


#: Characters and bytes that `planned` reads and makes before it hands rows on: Spark's batches are as large as 64 MB or 10,000 rows.
AT_ONCE = 1 << 20


def planned(df: DataFrame, args: list[str], plan: Callable[..., Iterable[tuple]], made: str, drop: tuple[str, ...] = ()) -> DataFrame:
    """Applies a planner to the args of each row; every tuple that it returns becomes a row with the made columns beside the
    row's others (args in drop excepted). One Arrow pass: nothing is joined back, nothing shuffled. Rows leave in small batches, so
    Python holds the objects of about AT_ONCE characters, or of one row that is larger, whatever a batch has."""
    fields = T.StructType.fromDDL(made)
    kept = [c for c in df.columns if c not in drop and c not in fields.names]
    kinds = to_arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = lambda values: sum(len(x) for x in values if isinstance(x, (str, bytes)))

        def rows_of(batch: pa.RecordBatch, index: list[int], rows: list[tuple]) -> pa.RecordBatch:
            old = [batch.column(c).take(pa.array(index, pa.int64())) for c in kept]
            return pa.RecordBatch.from_arrays([*old, *(pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True), kinds, strict=True))], [*kept, *fields.names])

        for batch in batches:
            index, rows, held = [], [], 0
            for i, scalars in enumerate(zip(*(batch.column(a) for a in args), strict=True)):
                values = [x.as_py() for x in scalars]
                held += size(values)
                for row in plan(*values):
                    rows.append(row)
                    index.append(i)
                    held += size(row)
                    if held >= AT_ONCE:
                        yield rows_of(batch, index, rows)
                        index, rows, held = [], [], 0
            if rows:
                yield rows_of(batch, index, rows)

    return df.mapInArrow(run, T.StructType([*(df.schema[c] for c in kept), *fields.fields]))


def document_names(raw: DataFrame) -> DataFrame:
    """raw: rel_path. Adds source_slug, doc_stem and document_id; stems that collide within a source get the extension."""
    parts = F.split("rel_path", "/")
    name = F.element_at(parts, -1)
    stem, ext = F.regexp_replace(name, "\\.[^.]*$", ""), F.lower(F.regexp_extract(name, "\\.([^.]*)$", 1))
    parent = F.when(F.size(parts) > 1, F.element_at(parts, -2)).otherwise("source")
    named = raw.withColumns({"source_slug": slug(parent, "source"), "doc_stem": slug(stem, ""), "ext": ext})
    # counted on names alone, so files' bytes need not move and a name that many files have is no large group
    same = named.groupBy(F.col("source_slug").alias("_slug"), F.col("doc_stem").alias("_stem")).agg(F.count("*").alias("_n")).filter("_n > 1")
    both = named.join(same, (F.col("source_slug") == F.col("_slug")) & (F.col("doc_stem") == F.col("_stem")), "left")
    suffix = F.when(F.col("_n").isNotNull(), F.concat(F.lit("_"), F.col("ext"))).otherwise("")
    return both.withColumn("document_id", F.concat("source_slug", F.lit("_"), "doc_stem", suffix)).drop("_slug", "_stem", "_n")


def normalise_documents(raw: DataFrame, domain: str, topic: str = "general") -> DataFrame:
    """raw: document_id, rel_path, ext, mtime (ISO text), sha256, markdown. Front matter filled in and overwritten where the
    source decides, bodies made regular, warnings kept; `changed` tells whether the text was already regular."""
    def plan(ident: str, text: str | None) -> list[tuple]:
        fields, old = textplan.front_matter(text or "")
        body, warnings = textplan.normalise_body(old, ident)
        return [(list(fields.items()), body, warnings if fields else ["Missing frontmatter; created new frontmatter block.", *warnings], body.strip() != old.strip())]

    made = planned(raw, ["document_id", "markdown"], plan, "fields map<string,string>, body string, warnings array<string>, body_changed boolean", drop=("markdown",))
    f = F.col("fields")
    new = {
        "document_id": nonempty(f["document_id"], F.col("document_id")),
        "source_id": nonempty(f["source_id"], F.col("document_id")),
        "domain": F.lit(domain),
        "topic": F.lit(topic or "general"),
        "source_file": F.element_at(F.split("rel_path", "/"), -1),
        "source_format": F.lower("ext"),
        "created_at": nonempty(f["created_at"], F.col("mtime")),
        "updated_at": F.col("mtime"),
        "hash_sha256": F.col("sha256"),
    }
    differs = F.col("body_changed")
    for name, value in new.items():
        differs = differs | ~f[name].eqNullSafe(value)
    extra = F.map_filter(f, lambda k, _: ~k.isin(*new))
    return made.select(*(v.alias(k) for k, v in new.items()), F.col("rel_path").alias("lineage"), extra.alias("extra"), "body", "warnings", differs.alias("changed"))


def document_text(documents: DataFrame) -> Column:
    """A document as markdown with front matter: required fields in their order, then the others by name."""
    line = lambda k, v: F.concat(k, F.lit(': "'), yaml_escape(v), F.lit('"'))
    first = [line(F.lit(c), F.coalesce(F.col(c), F.lit(""))) for c in ("document_id", "source_id", "domain", "topic", "source_file", "source_format", "created_at", "updated_at", "hash_sha256")]
    rest = F.transform(F.array_sort(F.map_entries("extra")), lambda e: line(e["key"], e["value"]))
    lines = F.concat(F.array(*first, line(F.lit("lineage.layer00_path"), F.coalesce("lineage", F.lit("")))), rest)
    return F.concat(F.lit("---\n"), F.array_join(lines, "\n"), F.lit("\n---\n\n"), "body")


def split_chapters(documents: DataFrame, level: int | None = None, min_words: int = 30, parity: bool = False) -> DataFrame:
    """A row per chapter with at least min_words words; numbers and totals count all chapters of the document."""
    def plan(body: str | None) -> Iterator[tuple]:
        before, found, deep = textplan.chapters(body or "", level, parity)
        intro = "\n".join(before).strip()
        return ((c.number, len(found), deep, c.title, c.body, c.words, intro) for c in found if c.words >= min_words)

    rows = documents.drop("warnings", "changed", "extra")
    cut = planned(rows, ["body"], plan, "chapter int, chapters_total int, split_level int, title string, body string, word_count int, preamble string")
    wide = F.greatest(F.lit(3), F.length(F.col("chapters_total").cast("string")))
    name = F.concat("document_id", F.lit("_"), F.lpad(F.col("chapter").cast("string"), wide, F.lit("0")), F.lit("_"), safe_title(F.col("title"), F.col("chapter")), F.lit(".md"))
    return cut.withColumn("file_name", name)


def chapter_toc(chapters: DataFrame) -> DataFrame:
    """A table of contents per document: numbered links with word counts."""
    line = F.format_string("%3d. [%s](%s)  _%,d Wörter_", "chapter", "title", "file_name", "word_count")
    lines = F.array_sort(F.collect_list(F.struct("chapter", line.alias("line"))))
    return chapters.groupBy("document_id").agg(F.max("chapters_total").alias("chapters_total"), F.array_join(F.transform(lines, lambda x: x["line"]), "\n").alias("toc"))


#: What Spark's own planner leaves to Python: fences, quotes, lists, line ends other than \\n and blanks other than space and tab.
NOT_PLAIN = "(?m)^[ \\t]*(?:```|~~~|>)|^\\s*(?:[-*+]|\\d+[.)])\\s+|[\\r\\x0B\\x0C\\x1C-\\x1F\\x85\\xA0\\u1680\\u2000-\\u200A\\u2028\\u2029\\u202F\\u205F\\u3000]"
BLANKS = " \t\n"


def plain_blocks(body: Column) -> Column:
    """Headings, tables and paragraphs of a text as an array of (heading, table, text, n tokens, number); a heading has the number of
    the block behind it. Lines that stand together make a block if they are of one kind; a heading is one alone."""
    def kind(line: Column) -> Column:
        def of(t: Column) -> Column:
            return F.when(t == "", "").when(F.startswith(t, F.lit("#")) & t.rlike("^#{1,6}\\s+"), "h").when(F.contains(t, F.lit("|")) & (F.length(t) > 2), "t").otherwise("p")

        return F.transform(F.array(F.btrim(line, F.lit(BLANKS))), of)[0]

    def cut(lines: Column, kinds: Column) -> Column:
        places = F.sequence(F.lit(1), F.size(lines))
        at = lambda k: F.element_at(kinds, k)
        before = lambda k: F.when(k > 1, F.element_at(kinds, F.greatest(k - 1, F.lit(1)))).otherwise("")
        begins = F.filter(places, lambda k: (at(k) != "") & ((at(k) == "h") | (at(k) != before(k))))
        after = F.filter(places, lambda k: (at(k) != "") & ((k == F.size(lines)) | (at(k) == "h") | (F.element_at(kinds, F.least(k + 1, F.size(lines))) != at(k)) | (F.element_at(kinds, F.least(k + 1, F.size(lines))) == "h")))
        block = lambda i, j: F.struct((at(i) == "h").alias("heading"), (at(i) == "t").alias("table"), F.array_join(F.slice(lines, i, j - i + 1), "\n").alias("text"))
        return F.zip_with(begins, after, block)

    lines = F.split(body, "\n")
    found = F.transform(F.array(F.struct(lines.alias("lines"), F.transform(lines, kind).alias("kinds"))), lambda x: cut(x["lines"], x["kinds"]))[0]
    return F.transform(found, lambda b: F.struct(b["heading"].alias("heading"), b["table"].alias("table"), b["text"].alias("text"), F.regexp_count(b["text"], F.lit("[^ \t\n]+")).alias("n")))


def folded(blocks: Column, target: int, maximum: int) -> Column:
    """Places behind the last block of each chunk. The state is the open chunk's tokens and first block, and starts anew when it closes:
    at a heading that finds the target reached, before a block that would exceed the maximum, behind one that reaches the target."""
    state = "struct<at:int,first:int,size:int,ends:array<int>>"
    begin = F.struct(F.lit(0).alias("at"), F.lit(0).alias("first"), F.lit(0).alias("size"), F.array().cast("array<int>").alias("ends")).cast(state)

    def add(s: Column, b: Column) -> Column:
        shut = (s["at"] > s["first"]) & F.when(b["heading"], s["size"] >= target).otherwise(s["size"] + b["n"] > maximum)
        size = F.when(shut, b["n"]).otherwise(s["size"] + b["n"])
        reached = ~b["heading"] & (size >= target)
        ends = F.concat(s["ends"], F.when(shut, F.array(s["at"])).otherwise(F.array().cast("array<int>")), F.when(reached, F.array(s["at"] + 1)).otherwise(F.array().cast("array<int>")))
        first = F.when(reached, s["at"] + 1).when(shut, s["at"]).otherwise(s["first"])
        return F.struct((s["at"] + 1).alias("at"), first.alias("first"), F.when(reached, F.lit(0)).otherwise(size).alias("size"), ends.alias("ends")).cast(state)

    return F.aggregate(blocks, begin, add, lambda s: F.when(s["at"] > s["first"], F.concat(s["ends"], F.array(s["at"]))).otherwise(s["ends"]))


def chunks_of_blocks(blocks: Column, ends: Column) -> Column:
    """(content, token_count, paragraph_start, paragraph_end) of each chunk."""
    numbers = lambda k: F.size(F.filter(F.slice(blocks, 1, k), lambda b: ~b["heading"]))

    def chunk(end: Column, place: Column) -> Column:
        start = F.when(place > 0, F.element_at(ends, F.greatest(place, F.lit(1)))).otherwise(0)
        own = F.slice(blocks, start + 1, end - start)
        text = F.btrim(F.array_join(F.transform(own, lambda b: b["text"]), "\n\n"), F.lit(BLANKS))
        last = numbers(end) + F.when(F.element_at(blocks, end)["heading"], 1).otherwise(0)
        return F.struct(F.concat(text, F.lit("\n")).alias("content"), F.aggregate(own, F.lit(0), lambda n, b: n + b["n"]).alias("token_count"), (numbers(start) + 1).alias("paragraph_start"), last.alias("paragraph_end"))

    return F.transform(ends, chunk)


def plan_chunks(chapters: DataFrame, rules: textplan.Rules = textplan.Rules()) -> DataFrame:
    """A row per chunk of each chapter (document_id, chapter, body and the chapter's other fields).

    Chapters of headings, tables and paragraphs within the maximum, which most are, are planned by expressions; only bodies of the
    others go to Python, and come back as the same array of chunks."""
    made = "array<struct<content:string,token_count:int,paragraph_start:int,paragraph_end:int>>"

    @F.arrow_udf(made)
    def planned_chunks(bodies: pa.Array) -> pa.Array:
        rows = [None if b is None else [{"content": c.content, "token_count": c.tokens, "paragraph_start": c.start, "paragraph_end": c.end} for c in textplan.plan_chunks(b, rules)] for b in bodies.to_pylist()]
        return pa.array(rows, pa.list_(pa.struct([("content", pa.string()), ("token_count", pa.int32()), ("paragraph_start", pa.int32()), ("paragraph_end", pa.int32())])))

    body, kept = F.coalesce("body", F.lit("")), [c for c in chapters.columns if c not in ("word_count", "preamble", "body")]
    rows = chapters.select(*kept, body.alias("body"))
    plain = ~F.col("body").rlike(NOT_PLAIN) if rules.keep_headings and not rules.split_tables and not rules.parity else F.lit(False)
    rows = rows.withColumn("_blocks", F.when(plain, plain_blocks(F.col("body"))))
    rows = rows.withColumn("_blocks", F.when(~F.exists("_blocks", lambda b: ~b["heading"] & ~b["table"] & (b["n"] > rules.maximum)), F.col("_blocks")))
    by_python = planned_chunks(F.when(F.col("_blocks").isNull(), F.col("body")))
    own = F.transform(F.array(folded(F.col("_blocks"), rules.target, rules.maximum)), lambda ends: chunks_of_blocks(F.col("_blocks"), ends))[0]
    found = rows.withColumn("_python", by_python).select(*kept, F.posexplode(F.when(F.col("_blocks").isNotNull(), own.cast(made)).otherwise(F.col("_python"))).alias("_at", "_chunk"))
    return chunk_fields(found.select(*kept, (F.col("_at") + 1).alias("sequence"), "_chunk.*"))


def chunk_id(document_id: Column, chapter_id: Column, sequence: Column) -> Column:
    number = sequence.cast("string")
    return F.concat_ws("_", F.lit("chunk"), document_id, chapter_id, F.lpad(number, F.greatest(F.lit(4), F.length(number)), F.lit("0")))


def chunk_fields(cut: DataFrame) -> DataFrame:
    """Ids, hash and lineage of chunks."""
    chapter = chapter_key(F.col("chapter"))
    lineage = F.struct(F.col("file_name").alias("layer20_file"), F.col("document_id").alias("layer10_document"), F.col("source_file").alias("layer00_source"), F.col("title").alias("chapter_heading"), "paragraph_start", "paragraph_end")
    return cut.select(
        chunk_id(F.col("document_id"), chapter, F.col("sequence")).alias("chunk_id"), "document_id", chapter.alias("chapter_id"), "source_id", "domain", "topic", "sequence", "token_count",
        "source_file", "created_at", "updated_at", F.sha2("content", 256).alias("hash_sha256"), "content", lineage.alias("lineage"),
    )


def fixed_chunks(documents: DataFrame, size: int = 500) -> DataFrame:
    """document_id, topic, text -> windows of `size` words, numbered from 1; one chapter per document. Expressions only."""
    cut = documents.select("document_id", "topic", F.posexplode(windows(F.col("text"), size)).alias("pos", "content"))
    sequence = F.col("pos") + 1
    return cut.select(chunk_id(F.col("document_id").cast("string"), F.lit("ch01"), sequence).alias("chunk_id"), "document_id", F.lit("ch01").alias("chapter_id"), "topic", sequence.alias("sequence"), token_count(F.col("content")).alias("token_count"), "content")


def evidence_score(tokens: Column) -> Column:
    return F.round(F.least(F.lit(1.0), tokens / F.lit(500.0)), 4)


def build_evidence(chunks: DataFrame, text: Column | None = None, parity: bool = False) -> DataFrame:
    """One evidence record per chunk. With parity the text has the heading line that chunk files begin with."""
    body = text if text is not None else F.col("content")
    if parity:
        body = F.concat(F.lit("# Chunk\n\n"), F.trim(body))
    kept = [c for c in chunks.columns if c not in ("content", "hash_sha256", "sequence", "created_at", "updated_at")]
    return chunks.select(
        F.concat(F.lit("evidence_"), "chunk_id").alias("evidence_id"), *kept, evidence_score(F.col("token_count")).alias("score"), F.array().cast("array<string>").alias("limitations"),
        preview(body).alias("content_preview"), F.sha2(body, 256).alias("hash_sha256"),
    )


def build_embeddings(evidence: DataFrame, kept: tuple[str, ...] = ()) -> DataFrame:
    """One hash vector per evidence record, from its preview; kept: further columns of the evidence."""
    return evidence.select(
        F.concat(F.lit("emb_"), nonempty("chunk_id", "evidence_id")).alias("embedding_id"), "chunk_id", "evidence_id", *kept, *[c for c in ("domain", "topic") if c in evidence.columns],
        F.lit(MODEL).alias("model_version"), hash_vector(F.coalesce("content_preview", F.lit(""))).alias("vector"), F.col("hash_sha256").alias("source_hash"),
    )


def chunk_manifest(chunks: DataFrame) -> DataFrame:
    return chunks.select("chunk_id", F.concat("document_id", F.lit("/"), "chunk_id", F.lit(".md")).alias("output_file"), F.col("lineage.layer20_file").alias("chapter_file"), "token_count")


def chunk_stats(chunks: DataFrame) -> DataFrame:
    """Counts and token statistics, zeros without chunks; the average is rounded half to even."""
    zero = lambda c: F.coalesce(c, F.lit(0))
    return chunks.agg(
        F.count("*").alias("chunks"), F.countDistinct("document_id").alias("documents"), F.countDistinct("document_id", "chapter_id").alias("chapters"),
        F.coalesce(F.bround(F.avg("token_count"), 2), F.lit(0.0)).alias("avg_tokens"), zero(F.max("token_count")).alias("max_tokens"), zero(F.min("token_count")).alias("min_tokens"),
    )


def wiki_sections(evidence: DataFrame, kept: tuple[str, ...] = ()) -> DataFrame:
    """The entries of topic pages as rows, a form that no topic outgrows; kept: further columns of the evidence."""
    text = F.regexp_replace(F.coalesce("content_preview", F.lit("")), "(?U)^\\s+|\\s+$", "")
    lines = [F.concat(F.lit("## "), "evidence_id"), F.lit(""), *(F.concat(F.lit(f"- {c}: "), F.col(c).cast("string")) for c in ("chunk_id", "document_id", "chapter_id", "token_count")), F.lit(""), text, F.lit("")]
    return evidence.select("topic", "evidence_id", *kept, F.concat_ws("\n", *lines).alias("section"))


def wiki_pages(evidence: DataFrame, domain: str) -> DataFrame:
    """A page per topic, entries in order of evidence_id."""
    entries = F.array_sort(F.collect_list(F.struct("evidence_id", "section")))
    pages = wiki_sections(evidence).groupBy("topic").agg(F.count("*").alias("entries"), entries.alias("all"))
    head = F.concat(F.lit("# Topic "), "topic", F.lit(f"\n\nDomain: {domain}\nEntries: "), F.col("entries").cast("string"), F.lit("\n\n"))
    return pages.select("topic", "entries", F.concat(head, F.array_join(F.transform("all", lambda x: x["section"]), "\n")).alias("page"))


def page_lines(evidence: DataFrame, domain: str) -> DataFrame:
    """Topic pages as rows of topic, place and value: a head, then an entry a row in order of evidence_id."""
    sections = wiki_sections(evidence)
    head = F.concat(F.lit("# Topic "), "topic", F.lit(f"\n\nDomain: {domain}\nEntries: "), F.count("*").cast("string"), F.lit("\n"))
    heads = sections.groupBy("topic").agg(head.alias("value")).select("topic", F.lit("").alias("place"), "value")
    return heads.unionByName(sections.select("topic", F.col("evidence_id").alias("place"), F.col("section").alias("value")))


def write_pages(evidence: DataFrame, domain: str, path: str) -> None:
    """A text file a topic, below path/topic=...: written row by row from sorted entries, so no row or memory holds a page."""
    lines = page_lines(evidence, domain).repartition("topic").sortWithinPartitions("topic", "place")
    lines.select("topic", "value").write.mode("overwrite").partitionBy("topic").text(path)


def wiki_readme(evidence: DataFrame, domain: str) -> DataFrame:
    """The page that lists all topics."""
    topics = F.array_sort(F.collect_set("topic"))
    return evidence.select("topic").distinct().agg(F.concat(F.lit(f"# Wiki {domain}\n\n## Topics\n\n"), F.array_join(F.transform(topics, lambda t: F.concat(F.lit("- ["), t, F.lit("]("), t, F.lit(".md)"))), "\n")).alias("page"))


def chunk_file(chunk: dict) -> str:
    """A chunk as a file: its fields by name, nested ones indented, every scalar quoted; then the content."""
    def lines(fields: dict, indent: str) -> list[str]:
        out = []
        for k in sorted(fields):
            v = fields[k]
            if isinstance(v, dict):
                out += [f"{indent}{k}:", *lines(v, indent + "  ")]
            elif v is not None:
                text = str(v).lower() if isinstance(v, bool) else str(v)
                out.append(f'{indent}{k}: "{text.replace(chr(92), chr(92) * 2).replace(chr(34), chr(92) + chr(34))}"' if isinstance(v, str) else f"{indent}{k}: {text}")
        return out

    content = chunk.pop("content")
    return "\n".join(["---", *lines(chunk, ""), "---", "", "# Chunk", "", content.strip(), ""])


def run_summary(reports: DataFrame) -> DataFrame:
    """reports: stage, created, updated, skipped, warnings (array), errors (array). Totals of a run."""
    return reports.agg(F.count("*").alias("stages"), *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("created", "updated", "skipped")), *(F.coalesce(F.sum(F.size(c)), F.lit(0)).alias(c) for c in ("warnings", "errors")))


def ordered_evidence(evidence: DataFrame) -> DataFrame:
    return evidence.orderBy("document_id", "chapter_id", "chunk_id")


def ordered_embeddings(embeddings: DataFrame) -> DataFrame:
    return embeddings.orderBy("domain", "topic", "chunk_id")


def write_embeddings(embeddings: DataFrame, path: str, form: str = "parquet") -> None:
    """Parquet by domain and topic, or JSON with vectors as arrays."""
    if form == "json":
        embeddings.write.mode("overwrite").json(path)
    else:
        embeddings.write.mode("overwrite").partitionBy("domain", "topic").parquet(path)


def write_evidence(evidence: DataFrame, path: str) -> None:
    """Parquet by topic: a reader that filters on topic prunes to its folder."""
    evidence.write.mode("overwrite").partitionBy("topic").parquet(path)
