"""WARC archives: a writer with identical-payload revisits and a splittable reader.

Writing: payload digests are grouped (only digests and ids are shuffled, combined before), which names the smallest id of each
payload that occurs twice; that table meets the pages again by digest, broadcast up to MOST_REPEATED payloads and else by a
shuffle that Spark can split. Every task writes gzip members, one a record, into archives of its own in the shared folder, under
names that no other attempt uses, and returns their paths; archives of lost or repeated attempts are thus never read.

Reading: archives are cut into byte ranges. A task scans its range for the gzip magic, takes a candidate for a record's start
only if it decodes to a WARC header with a whole record, and owns every record that starts inside its range, reading on past the
end for the last one. Records follow each other without a new scan. Payload digests are verified against the stored ones.

Archives are opened through pyarrow's file systems, by the URI of the shared folder.

Edge cases: a null page is an empty payload; payloads below LEAST_REVISIT bytes are never revisits; every row that carries the
smallest id of its payload is a response, so repeated rows stay responses; a null id is never a smallest one and comes back null
(and if all ids of a payload are null, all are responses); a null URL has no target; line breaks in URLs are escaped; damaged
members are skipped by the reader, and page_records raises where fewer records come back than were written; an empty table gives no archive and an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataforge.llm.common import broadcast_if_small, new_path, written

LEAST_REVISIT = 100
MOST_REPEATED = 100_000
SPLIT = 4 << 20
READ = 1 << 18
LEVEL = 5
MAGIC = b"\x1f\x8b\x08"
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record, uncompressed. A revisit has the HTTP header with the full payload's length, and no payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    name = f"urn:page:{page_id}" if page_id is not None else f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{digest} {url}')}"
    head = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", f"<{name}>"), ("WARC-Date", DATE)]
    if url is not None:
        head.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    if refers_to is not None:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    head += [("WARC-Payload-Digest", f"sha256:{digest}"), ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return "".join(["WARC/1.1\r\n", *(f"{k}: {v}\r\n" for k, v in head), "\r\n"]).encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields in lower case, block) of the records in a decoded member; ValueError if it isn't made of whole records."""
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if not data.startswith(b"WARC/", at) or end < 0:
            raise ValueError("no WARC header")
        fields = {}
        for line in data[at:end].decode("utf-8", "replace").split("\r\n")[1:]:
            k, colon, v = line.partition(":")
            if colon:
                fields[k.strip().lower()] = v.strip()
        n = int(fields["content-length"]) if fields.get("content-length", "").isdigit() else -1
        begin = end + 4
        if n < 0 or data[begin + n : begin + n + 4] != b"\r\n\r\n":
            raise ValueError("no whole record")
        yield fields, data[begin : begin + n]
        at = begin + n + 4


def members(f, start: int, end: int, size: int) -> Iterator[bytes]:
    """Decoded members of f that start in [start, end) and hold whole WARC records."""
    base, held, pos = start, b"", start  # held are the bytes from base on; pos is the next place to look at

    def need(until: int) -> None:
        nonlocal held
        while base + len(held) < min(until, size):
            got = f.read(max(READ, until - base - len(held)))
            if not got:
                break
            held += got

    f.seek(start)
    while pos < end:
        if pos - base > READ:
            held, base = held[pos - base :], pos
        need(min(pos + READ, end + len(MAGIC) - 1))
        found = held.find(MAGIC, pos - base, max(0, end + len(MAGIC) - 1 - base))
        if found < 0:
            pos = min(end, base + max(len(held) - len(MAGIC) + 1, pos - base + 1))
            if base + len(held) >= size:
                return
            continue
        pos = base + found
        data, parts, fed, seen = zlib.decompressobj(31), [], pos, 0
        try:
            while not data.eof:
                need(fed + READ)
                chunk = held[fed - base : fed - base + READ]
                if not chunk:
                    raise ValueError("cut off")
                parts.append(data.decompress(chunk))
                fed += len(chunk)
                seen += len(parts[-1])
                if seen >= 5 and not b"".join(parts[:3])[:5].startswith(b"WARC/"):
                    raise ValueError("no WARC header")
            whole = b"".join(parts)
            list(parse(whole))
        except (ValueError, zlib.error):
            pos += 1
            continue
        yield whole
        pos = fed - len(data.unused_data)


def read_split(uri: str, start: int, end: int) -> Iterator[tuple]:
    """Records (as RECORD) that start within a byte range of an archive."""
    fs, path = open_fs(uri)
    size = fs.get_file_info(path).size
    page = lambda x: int(x[10:-1]) if x.startswith("<urn:page:") else None
    with fs.open_input_file(path) as f:
        for whole in members(f, start, min(end, size), size):
            for fields, block in parse(whole):
                http, _, payload = block.partition(b"\r\n\r\n")
                length = next((int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")), len(payload))
                digest, kind = fields.get("warc-payload-digest", "").removeprefix("sha256:"), fields.get("warc-type", "")
                if kind == "response" and (hashlib.sha256(payload).hexdigest() != digest or len(payload) != length):
                    raise OSError(f"{uri}: the payload of {fields.get('warc-record-id')} is damaged")
                yield page(fields.get("warc-record-id", "")), fields.get("warc-target-uri"), length, digest, kind, page(fields.get("warc-refers-to", "")), payload


def _digests(html) -> tuple:
    payload = F.coalesce(html, F.lit(""))
    return F.sha2(payload, 256), F.octet_length(payload)


def write_warc(pages: DataFrame, folder: str) -> DataFrame:
    """Writes page_id, url, html as archives below folder; returns the written table of path, length and records."""
    digest, length = _digests(F.col("html"))
    pages = pages.select("page_id", "url", "html", digest.alias("digest"), length.alias("n"))
    repeated = pages.filter(F.col("n") >= LEAST_REVISIT).groupBy(F.col("digest").alias("of")).agg(F.min("page_id").alias("first"), F.count("*").alias("copies"))
    repeated = written(repeated.filter("copies > 1 and first is not null").select("of", "first"), "repeated-payloads")
    rows = pages.join(broadcast_if_small(repeated, MOST_REPEATED), F.col("digest") == F.col("of"), "left")
    rows = rows.select("page_id", "url", "html", "digest", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f, n = None, 0
        for batch in batches:
            for i, url, html, sha, to in zip(*batch.columns, strict=True):
                if f is None:
                    fs, path = open_fs(f"{folder}/part-{uuid.uuid4().hex}.warc.gz")
                    fs.create_dir(path.rpartition("/")[0], recursive=True)
                    f = fs.open_output_stream(path, compression=None)
                f.write(member(record(i.as_py(), url.as_py(), (html.as_py() or "").encode("utf-8", "surrogatepass"), sha.as_py(), to.as_py())))
                n += 1
        if f is not None:
            f.close()
            yield pa.record_batch([pa.array([f"{folder}/{path.rpartition('/')[2]}"]), pa.array([fs.get_file_info(path).size]), pa.array([n])], ["path", "length", "records"])

    return written(rows.mapInArrow(write, "path string, length long, records long"), "archives")


def read_warc(archives: DataFrame, payloads: bool = True, split: int = SPLIT) -> DataFrame:
    """archives: path and length of each. Returns a row for each record, as RECORD (payload null unless asked for)."""
    spark = archives.sparkSession
    ranges = archives.filter("length > 0").select("path", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(split).cast("long"))).alias("start"))
    n = archives.agg(F.coalesce(F.sum(F.ceil(F.col("length") / split)), F.lit(0))).first()[0]
    tasks = max(spark.sparkContext.defaultParallelism, int(n))  # about one range each
    schema = RECORD.split(", ")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def table(rows):
            cols = list(zip(*rows, strict=True))
            kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
            return pa.record_batch([pa.array(c, kinds[s.split()[1]]) for c, s in zip(cols, schema, strict=True)], [s.split()[0] for s in schema])

        for batch in batches:
            for path, length, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows, held = [], 0
                for *head, payload in read_split(path, start, min(start + split, length)):
                    rows.append((*head, payload if payloads else None))
                    held += len(payload) * payloads + 200
                    if held > 8 << 20:
                        yield table(rows)
                        rows, held = [], 0
                if rows:
                    yield table(rows)

    return ranges.repartition(tasks, F.xxhash64("path", "start")).mapInArrow(read, RECORD)


def archives_in(spark: SparkSession, folder: str) -> DataFrame:
    """The archives of a folder by path and length, whoever wrote them."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").option("recursiveFileLookup", "true").load(folder).select("path", "length")


def page_records(pages: DataFrame) -> DataFrame:
    archives = write_warc(pages.select("page_id", "url", "html"), new_path(pages.sparkSession, "warc"))
    records = written(read_warc(archives, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"), "records")
    check_whole(archives, records)
    return records


def check_whole(archives: DataFrame, records: DataFrame) -> None:
    """Raises if the records are not as many as the writer put into its archives."""
    wrote, read = archives.agg(F.coalesce(F.sum("records"), F.lit(0))).first()[0], records.count()
    if wrote != read:
        raise OSError(f"{wrote} records were written and {read} read: members of an archive are damaged")


def page_records_sql() -> str:
    return f"""
    WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
    d AS (SELECT page_id, strlen(h) AS n, sha256(h) AS s FROM p),
    f AS (SELECT *, CASE WHEN n >= {LEAST_REVISIT} THEN min(page_id) OVER (PARTITION BY s) ELSE page_id END AS first FROM d)
    SELECT page_id, n::BIGINT AS payload_bytes, s AS payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> first THEN first END AS refers_to FROM f"""
