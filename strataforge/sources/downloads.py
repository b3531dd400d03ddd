"""Papers' files: the addresses of each are tried in order, the first answer that is a paper is stored, every outcome is a row."""

from __future__ import annotations

import time
import urllib.error
import urllib.request
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataforge.functions.links import host
from strataforge.functions.papers import LEAST_BYTES, download_path, download_urls

Answer = tuple[int, str, bytes]
OUT = "paper_id string, url string, path string, error string"


def answered(url: str, seconds: int = 60) -> Answer:
    """Status, type and content of an address; status 0 where it cannot be reached."""
    try:
        with urllib.request.urlopen(url, timeout=seconds) as r:
            return r.status, r.headers.get("Content-Type", ""), r.read()
    except urllib.error.HTTPError as e:
        return e.code, "", b""
    except (OSError, ValueError):
        return 0, "", b""


def ending_of(url: str, answer: Answer) -> tuple[str | None, str]:
    """.pdf or .html for an answer that is a paper, else what is wrong with it."""
    status, kind, data = answer
    if status != 200:
        return None, f"status {status}"
    ending = ".pdf" if "pdf" in kind or url.lower().endswith(".pdf") else ".html" if "html" in kind else None
    if ending is None:
        return None, f"type {kind or 'unknown'}"
    return (ending, "") if len(data) >= LEAST_BYTES else (None, f"{len(data)} bytes")


def downloads(papers: DataFrame, folder: str, per_second: float = 1.0, ask: Callable[[str], Answer] = answered) -> DataFrame:
    """papers: paper_id, source, external_id, title, year, pdf_url, fulltext_url, doi. A row for each: the address and path below folder of
    what was stored, or the error of each address. A host's papers are in one task, whose clock spaces requests to it; a task that
    runs again finds what is stored and asks for nothing twice. Feed `mark` with the rows that have a path."""
    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)
        last: dict[str, float] = {}

        def spaced(url: str) -> Answer:
            where = url.split("/")[2] if url.count("/") > 1 else url
            wait = last.get(where, 0.0) + 1 / per_second - time.monotonic()
            if wait > 0:
                time.sleep(wait)
            last[where] = time.monotonic()
            return ask(url)

        def one(urls: list[str], path: str) -> tuple[str | None, str | None, str | None]:
            for ending in (".pdf", ".html"):
                if store.get_file_info(f"{base}/{path}{ending}").type == fs.FileType.File:
                    return None, path + ending, None
            errors = []
            for url in urls:
                answer = spaced(url)
                ending, error = ending_of(url, answer)
                if ending:
                    name = f"{base}/{path}{ending}"
                    store.create_dir(name.rpartition("/")[0], recursive=True)
                    part = f"{name}.{uuid.uuid4().hex[:8]}.part"
                    with store.open_output_stream(part) as out:
                        out.write(answer[2])
                    store.move(part, name)
                    return url, path + ending, None
                errors.append(f"{url}: {error}")
            return None, None, "; ".join(errors) or "no address"

        for batch in batches:
            rows = [one(u, p) for u, p in zip(batch.column("urls").to_pylist(), batch.column("path").to_pylist(), strict=True)]
            columns = list(zip(*rows, strict=True)) or [(), (), ()]
            yield pa.record_batch([batch.column("paper_id"), *(pa.array(c, pa.string()) for c in columns)], ["paper_id", "url", "path", "error"])

    c = F.col
    rows = papers.select(c("paper_id").cast("string").alias("paper_id"), download_urls(c("pdf_url"), c("fulltext_url"), c("doi")).alias("urls"), download_path(c("source"), c("year"), c("external_id"), c("title"), F.lit("")).alias("path"))
    dealt = rows.withColumn("host", F.coalesce(host(F.get("urls", F.lit(0))), F.lit(""))).repartition("host")
    return dealt.select("paper_id", "urls", "path").mapInArrow(load, OUT)
