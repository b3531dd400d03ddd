"""Raw files, layer folders and sinks. All paths go through Spark, so any store that it reads will do."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataforge.sources.convert import CONVERTERS

SUPPORTED = frozenset(CONVERTERS)


def parse_formats(text: str | None) -> frozenset[str] | None:
    """`.PDF, txt` -> {pdf, txt}; empty means all."""
    found = frozenset(x.strip().lower().lstrip(".") for x in (text or "").split(",") if x.strip(" ."))
    return found or None


def relative(path: str, base: str) -> Column:
    """A path below base, whichever way scheme and slashes are written."""
    plain = lambda p: F.regexp_replace(p, "^[A-Za-z0-9]+:/*|^/+", "")
    return F.substr(plain(F.col(path)), F.length(plain(F.lit(base))) + 2)


def discover(spark: SparkSession, folder: str, formats: str | None = None, recursive: bool = True, content: bool = True, digests: bool = True) -> DataFrame:
    """Files of supported formats: rel_path, ext, length, mtime (ISO text), sha256 and content. Without content only names and
    sizes are read; without digests contents are not hashed."""
    base = folder.rstrip("/")
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    kinds = SUPPORTED & (parse_formats(formats) or SUPPORTED)
    files = reader.load(base).withColumn("ext", F.lower(F.regexp_extract("path", "\\.([^./]+)$", 1))).filter(F.col("ext").isin(*sorted(kinds)))
    rel = relative("path", base)
    meta = files.select("path", rel.alias("rel_path"), "ext", "length", F.date_format("modificationTime", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("mtime"), *(["content"] if content else []))
    return meta.withColumn("sha256", F.sha2("content", 256)) if content and digests else meta


def chapter_files(files: DataFrame) -> DataFrame:
    """Markdown files that are chapters: no indexes and no tables of contents."""
    name = F.lower(F.element_at(F.split("rel_path", "/"), -1))
    return files.filter(name.endswith(".md") & (name != "index.md") & ~name.endswith("_toc.md") & ~F.lower("rel_path").rlike("(^|/)index/"))


def unsplit_files(files: DataFrame) -> DataFrame:
    """Markdown files that are not the splitter's own output."""
    stem = F.regexp_replace(F.element_at(F.split("rel_path", "/"), -1), "\\.md$", "")
    return files.filter(F.col("rel_path").endswith(".md") & ~stem.rlike("_TOC$") & ~stem.rlike("_\\d{3,}(_|$)"))


def in_path_order(files: DataFrame) -> DataFrame:
    """By path whatever the case; paths that differ by case alone stay in a fixed order."""
    return files.orderBy(F.lower("rel_path"), "rel_path")


def read_markdown_layer(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """Records of a layer of markdown files (10, 20, 30): `file`, the columns of schema from the front matter (null where there is
    none or it is not of the type), `body` and `load_error`. Indexes and tables of contents are left out; a file that is no
    UTF-8 is a row with load_error. Files of no bytes have no row, as Spark's file scan leaves them out."""
    from strataforge.operators import textplan
    from strataforge.operators.stages import planned

    def plan(content: bytes | None) -> list[tuple]:
        try:
            fields, body = textplan.front_matter((content or b"").decode("utf-8-sig"))
        except UnicodeDecodeError:
            return [([], None, True)]
        return [(list(fields.items()), body, False)]

    base = folder.rstrip("/")
    name = F.element_at(F.split("file", "/"), -1)
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.md").load(base)
    wanted = found.select(relative("path", base).alias("file"), "content").filter((name != "INDEX.md") & ~F.lower(name).endswith("_toc.md"))
    made = planned(wanted, ["content"], plan, "fields map<string,string>, body string, load_error boolean", drop=("content",))
    own = [f for f in T.StructType.fromDDL(schema) if f.name not in ("file", "body", "load_error")]
    return made.select("file", *(F.col("fields")[f.name].try_cast(f.dataType).alias(f.name) for f in own), "body", "load_error")


def read_layer(spark: SparkSession, path: str, layer: int, schema: str) -> DataFrame:
    """A layer's records: Parquet where it was written by this engine, else JSON arrays (40, 50), whose broken records become rows
    with `load_error`."""
    if layer in (40, 50):
        return spark.read.schema(f"{schema}, load_error string").option("multiLine", "true").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "load_error").json(path)
    return spark.read.schema(schema).parquet(path)


def read_vectors(spark: SparkSession, path: str, domain: str, topic: str | None = None) -> DataFrame:
    """Embeddings of a domain (and topic); both filters reach the scan."""
    rows = spark.read.parquet(path).filter(F.col("domain") == domain)
    return rows.filter(F.col("topic") == topic) if topic is not None else rows


def create_only(new: DataFrame, old: DataFrame, key: str) -> DataFrame:
    """Rows whose key has not been written yet."""
    return new.join(old.select(key).distinct(), key, "left_anti")


def write_sections(documents: DataFrame) -> DataFrame:
    """One row per top-level section: document_id, number, file name and text."""
    from strataforge.functions.text import slug

    starts = F.split(F.concat(F.lit("\n"), "body"), "\n(?=# )")
    parts = documents.select("document_id", F.posexplode(F.filter(F.transform(starts, lambda s: F.trim(s)), lambda s: s != "")).alias("pos", "text"))
    title = F.regexp_extract("text", "^# (.*)", 1)
    name = F.concat(F.lpad((F.col("pos") + 1).cast("string"), 2, "0"), F.lit("_"), F.substring(slug(title), 1, 80), F.lit(".md"))
    return parts.select("document_id", (F.col("pos") + 1).alias("number"), name.alias("file_name"), "text")


def layer_listing(files: DataFrame, layers: dict[str, DataFrame], key: str = "stem") -> DataFrame:
    """Files with a flag for each layer that has something of them; layers: name -> rows with the key."""
    out = files
    for name, rows in layers.items():
        ids = rows.select(F.col(key).alias(f"has_{name}")).distinct()
        out = out.join(ids, F.col(key) == F.col(f"has_{name}"), "left").withColumn(f"in_{name}", F.col(f"has_{name}").isNotNull()).drop(f"has_{name}")
    return out


def write_report(spark: SparkSession, path: str, **values) -> None:
    """A run's figures as one JSON row, appended."""
    spark.createDataFrame([tuple(str(v) for v in values.values())], list(values)).write.mode("append").json(path)


def rename_plan(files: DataFrame) -> DataFrame:
    """files: rel_path, new_name. The log of a renaming: `original` and `renamed` of each file whose name changes. A name that a file
    of the folder has, or that an earlier file takes, gets the next free number (`_2`, `_3`, ...)."""
    cut = lambda c: (F.regexp_replace(c, "\\.[^./]*$", ""), F.regexp_extract(c, "(\\.[^./]*)$", 1))
    folder = F.regexp_extract("rel_path", "^(.*/)?[^/]*$", 1)
    target = F.concat(folder, "new_name")
    stem, ending = cut(target)
    wanted = files.filter(target != F.col("rel_path")).select("rel_path", stem.alias("stem"), ending.alias("ending"))
    nth = F.row_number().over(Window.partitionBy("stem", "ending").orderBy(F.lower("rel_path"), "rel_path"))
    stem, ending = cut(F.col("rel_path"))
    number = F.regexp_extract(stem, "_([1-9]\\d{0,8})$", 1)
    as_is = files.select(stem.alias("stem"), ending.alias("ending"), F.lit(1).alias("taken"))
    numbered = files.filter(number != "").select(F.regexp_replace(stem, "_\\d+$", "").alias("stem"), ending.alias("ending"), number.cast("int").alias("taken"))
    taken = as_is.unionByName(numbered.filter("taken > 1")).groupBy("stem", "ending").agg(F.sort_array(F.collect_set("taken")).alias("taken"))
    both = wanted.withColumn("nth", nth).join(taken, ["stem", "ending"], "left")
    free = F.aggregate(F.coalesce("taken", F.array().cast("array<int>")), F.col("nth"), lambda n, used: F.when(used <= n, n + 1).otherwise(n))
    name = F.concat("stem", F.when(free > 1, F.concat(F.lit("_"), free.cast("string"))).otherwise(""), "ending")
    return both.select(F.col("rel_path").alias("original"), name.alias("renamed"))


def apply_renames(log: DataFrame, folder: str) -> DataFrame:
    """Renames the files of a log below folder, in the tasks; original, renamed and error (null if done). A task that runs again
    finds what is already renamed and leaves it; nothing is overwritten."""
    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder)
        there = lambda p: store.get_file_info(p).type != fs.FileType.NotFound
        for batch in batches:
            errors = []
            for old, new in zip(*(batch.column(c).to_pylist() for c in ("original", "renamed")), strict=True):
                a, b = (f"{base.rstrip('/')}/{x}" for x in (old, new))
                try:
                    state = there(a), there(b)
                    if state == (True, False):
                        store.move(a, b)
                    errors.append(None if state in ((True, False), (False, True)) else "target exists" if state[1] else "no such file")
                except OSError as e:
                    errors.append(str(e))
            yield pa.record_batch([batch.column("original"), batch.column("renamed"), pa.array(errors, pa.string())], ["original", "renamed", "error"])

    return log.select("original", "renamed").mapInArrow(move, "original string, renamed string, error string")
