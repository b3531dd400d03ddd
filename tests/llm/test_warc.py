import gzip
import random

import pytest
from llm_oracle import same

from strataforge.llm import warc as W


def test_sql(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    same(W.page_records(pages), W.page_records_sql(), sf)


def test_round_trip_whatever_the_split(spark, sf, tmp_path):
    pages = spark.read.parquet(f"{sf}/pages.parquet").limit(60)
    pages = pages.unionByName(pages.limit(10).withColumn("page_id", pages.page_id + 10_000))
    archives = W.write_warc(pages, f"file://{tmp_path}/a")
    want = {r.page_id: (r.url, r.html or "") for r in pages.collect()}
    for split in (997, 50_000, 1 << 30):
        rows = W.read_warc(archives, split=split).collect()
        assert sorted(r.page_id for r in rows) == sorted(want)
        bodies = {r.page_id: bytes(r.payload).decode() for r in rows if r.record_type == "response"}
        for r in rows:
            assert (r.url, bodies[r.refers_to if r.record_type == "revisit" else r.page_id]) == want[r.page_id]
    listed = W.archives_in(spark, f"file://{tmp_path}/a")
    assert W.read_warc(listed).count() == len(want)


def test_false_magic_and_damage(tmp_path):
    rng = random.Random(3)
    records, data = [], b"\x1f\x8b\x08garbage\x1f\x8b"
    for i in range(40):
        payload = bytes(rng.choice([*W.MAGIC, 65]) for _ in range(rng.randrange(3000))) + gzip.compress(b"not a record") + b"\x1f\x8b\x08" * 50
        z = W.zlib.compressobj(0, W.zlib.DEFLATED, 31)  # stored: the magic bytes stay in the file
        raw = W.record(i, f"http://x/{i}", payload, W.hashlib.sha256(payload).hexdigest(), None)
        data += z.compress(raw) + z.flush()
        if i % 7 == 0:
            data += gzip.compress(b"WARC/1.1 but no record")[: rng.randrange(5, 40)]
        records.append((i, payload))
    path = tmp_path / "x.warc.gz"
    path.write_bytes(data)
    for split in (1, 64, 333, 4096, len(data)):
        if split == 1:
            starts = range(0, min(len(data), 400))
            got = [r for s in starts for r in W.read_split(f"file://{path}", s, s + 1)]
            assert [r[0] for r in got] == [0]
            continue
        got = [r for s in range(0, len(data), split) for r in W.read_split(f"file://{path}", s, s + split)]
        assert [(r[0], r[-1]) for r in got] == records


def test_edge_cases(spark):
    long = "é" * 60
    rows = [(5, "u", long, 1), (3, None, long, 1), (3, "v\r\nw", long, 1), (None, "n", long, 1), (7, "s", "short", 1), (8, "s", "short", 1), (9, None, None, 1), (None, None, "x" * 200, 1), (None, None, "x" * 200, 1), (11, "b", "y" * 3_000_000, 2), (12, "b", "y" * 3_000_000, 2)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, DIGEST int")
    got = sorted(((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in W.page_records(pages).collect()), key=repr)
    want = [(5, 120, "revisit", 3), (3, 120, "response", None), (3, 120, "response", None), (None, 120, "revisit", 3), (7, 5, "response", None), (8, 5, "response", None), (9, 0, "response", None), (None, 200, "response", None), (None, 200, "response", None), (11, 3_000_000, "response", None), (12, 3_000_000, "revisit", 11)]
    assert got == sorted(want, key=repr)
    assert W.page_records(pages.limit(0)).count() == 0


def test_a_damaged_payload_is_reported(tmp_path):
    path = tmp_path / "y.warc.gz"
    path.write_bytes(W.member(W.record(1, "u", b"abc", "0" * 64, None)))
    with pytest.raises(OSError, match="damaged"):
        list(W.read_split(f"file://{path}", 0, 10_000))


def test_a_lost_member_is_reported(spark, tmp_path):
    pages = spark.createDataFrame([(i, "u", f"page {i} " * 40) for i in range(30)], "page_id long, url string, html string").coalesce(1)
    archives = W.write_warc(pages, f"file://{tmp_path}/a")
    W.check_whole(archives, W.read_warc(archives))
    path = archives.first().path.removeprefix("file://")
    data = bytearray(open(path, "rb").read())
    at = data.index(W.MAGIC, 2000)
    data[at + 30 : at + 40] = b"x" * 10
    open(path, "wb").write(data)
    with pytest.raises(OSError, match="30 records were written"):
        W.check_whole(archives, W.read_warc(archives))


def test_a_very_long_page(spark):
    pages = spark.createDataFrame([(1, "u", "ab" * 20_000_000), (2, "u", "x" * 200)], "page_id long, url string, html string")
    assert sorted((r.page_id, r.payload_bytes) for r in W.page_records(pages).collect()) == [(1, 40_000_000), (2, 200)]
