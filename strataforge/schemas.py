"""Schemas of the layers, from raw files to embeddings, of papers and of offline encyclopedia pages."""

from __future__ import annotations

from pyspark.sql import types as T


def schema(text: str) -> T.StructType:
    """A schema from `name type, ...`."""
    return T.StructType.fromDDL(text)


RAW_FILES = "path string, rel_path string, ext string, length bigint, mtime timestamp, content binary, sha256 string"
DOCUMENTS = "document_id string, source_id string, domain string, topic string, source_file string, source_format string, created_at string, updated_at string, hash_sha256 string, lineage string, extra map<string,string>, body string, warnings array<string>"
CHAPTERS = "document_id string, source_id string, domain string, topic string, chapter int, chapters_total int, split_level int, title string, parent_title string, author string, source_format string, source_file string, body string, word_count int, file_name string"
LINEAGE = "struct<layer20_file:string,layer10_document:string,layer00_source:string,chapter_heading:string,paragraph_start:int,paragraph_end:int>"
CHUNKS = f"chunk_id string, document_id string, chapter_id string, source_id string, domain string, topic string, sequence int, token_count int, source_file string, created_at string, updated_at string, hash_sha256 string, content string, lineage {LINEAGE}"
EVIDENCE = "evidence_id string, chunk_id string, document_id string, chapter_id string, source_id string, domain string, topic string, token_count int, source_file string, score double, limitations array<string>, content_preview string, hash_sha256 string"
EMBEDDINGS = "embedding_id string, chunk_id string, evidence_id string, domain string, topic string, model_version string, vector array<double>, source_hash string"
MESSAGES = "transition string, validator string, identifier string, file string, rule string, description string, severity string"
PAPERS = "paper_id string, title string, abstract string, journal string, year int, authors array<string>, topics array<string>, doi string, source string, study_type string, is_open_access boolean, downloaded boolean, relevance_score double, pdf_url string, fulltext_url string, file_path string"
DUMP_PAGES = "title string, page_id bigint, revision_id bigint, updated_at string, wikitext string, links array<string>, redirect_target string, is_redirect boolean, source_path string"
