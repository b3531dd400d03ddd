"""Finding the raw file of a document, and removing what depends on files that are gone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataforge.functions.links import meta_path
from strataforge.functions.text import nonempty


#: What a match is called, in the order in which matches are tried.
MATCHES = {"rel": "lineage.layer00_path", "name": "source_file(name)", "hash": "hash_sha256", "stem": "source_file(stem)"}


def raw_catalogue(files: DataFrame) -> DataFrame:
    """The four keys of raw files: path, name, stem (all lower case) and hash."""
    name = F.lower(F.element_at(F.split("rel_path", "/"), -1))
    return files.select(F.col("rel_path").alias("raw_path"), meta_path(F.col("rel_path")).alias("by_rel"), name.alias("by_name"), F.regexp_replace(name, "\\.[^.]*$", "").alias("by_stem"), F.col("sha256").alias("by_hash"))


def unique_keys(catalogue: DataFrame, key: str) -> DataFrame:
    """Keys that exactly one raw file has, with that file; combined before the shuffle."""
    return catalogue.filter(F.col(key) != "").groupBy(F.col(key).alias(f"key_{key}")).agg(F.count("*").alias("n"), F.min("raw_path").alias(f"path_{key}")).filter("n = 1").drop("n")


def match_sources(documents: DataFrame, raw: DataFrame) -> DataFrame:
    """documents: source_id, source_file, lineage, hash_sha256. The raw file by path, else by a name, hash or stem that only
    one raw file has; else the source is missing."""
    files = raw_catalogue(raw)
    name = F.lower(nonempty("source_file"))
    docs = documents.withColumns({"want_rel": meta_path(nonempty("lineage")), "want_name": name, "want_hash": nonempty("hash_sha256"), "want_stem": F.regexp_replace(name, "\\.[^.]*$", "")})
    paths = files.groupBy(F.col("by_rel").alias("key_by_rel")).agg(F.min("raw_path").alias("path_by_rel"))
    for key, table in (("rel", paths), *((k, unique_keys(files, f"by_{k}")) for k in ("name", "hash", "stem"))):
        docs = docs.join(table, (F.col(f"want_{key}") == F.col(f"key_by_{key}")) & (F.col(f"want_{key}") != ""), "left").drop(f"key_by_{key}")
    found = {k: F.col(f"path_by_{k}").isNotNull() for k in ("rel", "name", "hash", "stem")}
    status = F.when(found["rel"], "ok").when(found["name"] | found["hash"] | found["stem"], "renamed_or_moved").otherwise("missing")
    detail = F
    for key, label in MATCHES.items():
        detail = detail.when(found[key], label)
    detail = detail.otherwise("not_found")
    path = F.coalesce("path_by_rel", "path_by_name", "path_by_hash", "path_by_stem")
    return docs.select(*documents.columns, status.alias("status"), detail.alias("match"), path.alias("raw_path"))


def without(rows: DataFrame, gone: DataFrame, key: str, gone_key: str | None = None) -> DataFrame:
    ids = gone.select(F.col(gone_key or key).alias("gone")).distinct()
    return rows.join(ids, rows[key] == ids.gone, "left_anti")


def orphans(rows: DataFrame, gone: dict[str, DataFrame]) -> DataFrame:
    """Rows any of whose keys is gone: a left join and a flag for each key, so no join has an OR."""
    flagged, flag = rows, F.lit(False)
    for key, table in gone.items():
        ids = table.select(F.col(key).alias(f"gone_{key}")).distinct()
        flagged = flagged.join(ids, flagged[key] == ids[f"gone_{key}"], "left")
        flag = flag | F.col(f"gone_{key}").isNotNull()
    return flagged.filter(flag).select(*(rows[c] for c in rows.columns))


def cascade(missing: DataFrame, documents: DataFrame, chapters: DataFrame, chunks: DataFrame, evidence: DataFrame, embeddings: DataFrame) -> dict[str, DataFrame]:
    """Rows to remove by layer, from sources that are missing: documents by source_id, chapters and chunks by document_id,
    evidence by source, chunk or its own id, and embeddings of which neither chunk nor evidence stays."""
    docs = documents.join(missing.select("source_id").distinct(), "source_id", "left_semi")
    chaps = chapters.join(docs.select("document_id").distinct(), "document_id", "left_semi")
    gone_chunks = chunks.join(docs.select("document_id").distinct(), "document_id", "left_semi")
    gone_evidence = orphans(evidence, {"source_id": missing, "chunk_id": gone_chunks})
    kept = without(evidence, gone_evidence, "evidence_id")
    gone_embeddings = kept_by_either(embeddings, kept, keep=False)
    return {"documents": docs, "chapters": chaps, "chunks": gone_chunks, "evidence": gone_evidence, "embeddings": gone_embeddings}


def kept_by_either(embeddings: DataFrame, kept: DataFrame, keep: bool = True) -> DataFrame:
    """Embeddings whose chunk or evidence is among kept (or, with keep false, the others)."""
    a = kept.select(F.col("chunk_id").alias("kept_chunk")).distinct()
    b = kept.select(F.col("evidence_id").alias("kept_evidence")).distinct()
    both = embeddings.join(a, F.col("chunk_id") == F.col("kept_chunk"), "left").join(b, F.col("evidence_id") == F.col("kept_evidence"), "left")
    hit: Column = F.col("kept_chunk").isNotNull() | F.col("kept_evidence").isNotNull()
    return both.filter(hit if keep else ~hit).drop("kept_chunk", "kept_evidence")


def stale_topics(existing: DataFrame, kept: DataFrame) -> DataFrame:
    """Topic partitions that no kept record belongs to."""
    return existing.select("topic").distinct().join(kept.select("topic").distinct(), "topic", "left_anti")
