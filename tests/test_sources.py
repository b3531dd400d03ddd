import http.server
import json
import lzma
import os
import stat
import struct
import threading
import time
import urllib.parse
import zlib

import pytest

from strataforge.operators import wikigraph
from strataforge.sources import convert, dump, files, papers, sqlite, xz


@pytest.fixture
def service():
    """Literature services that have 250 papers. The second request of all fails once with 429; what is in `broken` always does."""
    asked, broken = [], set()

    class Answer(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            where = urllib.parse.urlparse(self.path)
            query = dict(urllib.parse.parse_qsl(where.query))
            asked.append((where.path, query))
            if len(asked) == 2 or any(x in self.path for x in broken):
                self.send_error(429)
                return
            if where.path == "/esearch.fcgi":
                first = int(query["retstart"])
                text = json.dumps({"esearchresult": {"idlist": [str(i) for i in range(first, min(250, first + int(query["retmax"])))]}})
            elif where.path == "/oa":
                text = f"<OA><records><record id='{query['id']}'><link format='pdf' href='ftp://h/{query['id']}.pdf'/></record></records></OA>"
            elif where.path.startswith("/search/articles/"):
                first = (int(query["page"]) - 1) * int(query["pageSize"])
                text = json.dumps({"results": [{"id": str(i), "bibjson": {"title": urllib.parse.unquote(where.path.rpartition("/")[2])}} for i in range(first, min(250, first + int(query["pageSize"])))]})
            elif where.path == "/search":
                text = json.dumps({"response": {"docs": [{"id": str(i), "title_display": query["q"]} for i in range(int(query["start"]), min(250, int(query["start"]) + int(query["rows"])))]}})
            elif where.path == "/odd":
                text = query["text"]
            else:
                one = "<PubmedArticle><MedlineCitation><PMID>%s</PMID><Article><ArticleTitle>T</ArticleTitle></Article></MedlineCitation></PubmedArticle>"
                text = f"<S>{''.join(one % i for i in query['id'].split(','))}</S>"
            self.send_response(200)
            self.end_headers()
            self.wfile.write(text.encode())

        def log_message(self, *_):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Answer)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_address[1]}", asked, broken
    server.shutdown()


FAST = {"perSecond": "1000", "pause": "0.01"}


def test_search_and_details(spark, service):
    base, asked, _ = service
    papers.register(spark)
    rows = spark.read.format("papers").options(service="pubmed", query="sleep AND age", most="250", base=base, email="a@b", **FAST).load().collect()
    assert sorted(int(r.external_id) for r in rows) == list(range(250)) and all(r.error is None for r in rows)
    assert [(p, q.get("retstart"), len(q.get("id", "").split(","))) for p, q in asked] == [
        ("/esearch.fcgi", "0", 1), ("/efetch.fcgi", None, 100), ("/efetch.fcgi", None, 100), ("/esearch.fcgi", "100", 1), ("/efetch.fcgi", None, 100), ("/esearch.fcgi", "200", 1), ("/efetch.fcgi", None, 50)]  # one is asked again
    assert asked[0][1]["term"] == "sleep AND age" and asked[0][1]["retmax"] == "100" and asked[0][1]["filter"] == "lang.english" and asked[3][1]["email"] == "a@b"


@pytest.mark.parametrize("kind", ["doaj", "plos"])
def test_searches_by_query_take_all_pages(spark, service, kind):
    base, asked, broken = service
    papers.register(spark)
    read = lambda most: spark.read.format("papers").options(service=kind, query="a/b c", most=most, base=base, **FAST).load().collect()
    assert sorted(int(r.external_id) for r in read("130")) == list(range(130))
    rows = read("1000")
    assert sorted(int(r.external_id) for r in rows) == list(range(250)) and {r.title for r in rows} == {"a/b c"}
    broken.add("page=2" if kind == "doaj" else "start=100")
    rows = read("1000")
    assert sorted(int(r.external_id) for r in rows if r.error is None) == [*range(100), *range(200, 250)]
    assert ["no answer" in r.error for r in rows if r.error] == [True]


def test_a_search_as_a_stream(spark, service, tmp_path):
    base, asked, broken = service
    papers.register(spark)
    broken.add("start=100")
    source = spark.readStream.format("papers").options(service="plos", query="x", most="220", base=base, attempts="1", retries="2", **FAST).load()
    run = source.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(processingTime="0 seconds").start()
    for _ in range(200):
        run.processAllAvailable()
        if any(q.get("start") == "200" for _, q in asked):
            break
        time.sleep(0.1)
    run.processAllAvailable()
    run.stop()
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted(int(r.external_id) for r in rows if r.error is None) == [*range(100), *range(200, 220)]
    assert len([r for r in rows if r.error]) == 1 and sum(q.get("start") == "100" for _, q in asked) >= 3
    stream = papers.PaperStream({"service": "plos", "query": "x", "most": "220", "base": base, **FAST})
    broken.clear()
    assert len(list(stream.readBetweenOffsets({"start": 0}, {"start": 300}))) == 220
    first, offset = stream.read(stream.initialOffset())
    assert len(list(first)) == 100 and offset == {"start": 100, "tries": 0, "done": False}
    assert stream.read({"start": 300, "tries": 0, "done": False})[1]["start"] == 300


def test_full_text_links_and_refusals(spark, service):
    base, _, broken = service
    papers.register(spark)
    broken.add("PMC9")
    urls = [*papers.pmc_urls(["PMC1", "PMC9", "PMC2"], f"{base}/oa"), f"{base}/odd?text=%3Cbroken"]
    rows = spark.read.format("papers").options(service="pmc", urls=json.dumps(urls), **FAST).load().collect()
    assert {(r.pmcid, r.pdf_url) for r in rows if not r.error} == {("PMC1", "https://h/PMC1.pdf"), ("PMC2", "https://h/PMC2.pdf")}
    assert sorted(r.error.split(" from ")[0] for r in rows if r.error) == ["cannot read the answer", "no answer"] and {r.source for r in rows} == {"pmc"}
    assert papers.pmc("<") == [] and papers.detail_urls([]) == []
    assert papers.fetched("http://127.0.0.1:9/none")[0] == 0
    with pytest.raises(Exception, match="no such search"):
        spark.read.format("papers").options(service="pmc", query="x").load().collect()


DUMP = """<mediawiki xmlns="http://x/"><siteinfo><ns>9</ns></siteinfo>%s</mediawiki>"""
PAGE = "<page><title>%s</title><ns>0</ns><id>%d</id>%s<revision><id>%d</id><parentid>1</parentid><contributor><id>77</id></contributor><timestamp>t</timestamp><text>%s</text></revision></page>"


def test_xz_dump_equals_plain(spark, tmp_path):
    xml = DUMP % "".join([PAGE % ("A", 1, "", 10, "to [[B]]"), PAGE % ("B", 2, "", 11, "[[A]] &amp; x"), PAGE % ("C", 3, '<redirect title="A"/>', 12, "")])
    (tmp_path / "d.xml").write_text(xml)
    (tmp_path / "d.xml.xz").write_bytes(lzma.compress(xml.encode()))
    plain, packed = (dump.read_dump(spark, str(tmp_path / n)) for n in ("d.xml", "d.xml.xz"))
    key = lambda df: sorted(tuple(r) for r in df.drop("source_path").collect())
    assert plain.dtypes == packed.dtypes and key(plain) == key(packed)
    assert [r.wikitext for r in packed.orderBy("page_id").collect()] == ["to [[B]]", "[[A]] & x", "#REDIRECT [[A]]"]
    assert {r.title: r.redirect_target for r in wikigraph.index_pages(packed).collect()}["C"] == "A"


def number(n):
    out = bytearray()
    while n >= 0x80:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def one_stream(parts):
    """The blocks of several streams as the blocks of one, as a compressor with block sizes writes them."""
    packed, records = b"", []
    for part in parts:
        stream = lzma.compress(part, check=lzma.CHECK_CRC64)
        length = (struct.unpack("<I", stream[-8:-4])[0] + 1) * 4
        _, at = xz.varint(stream[-12 - length :], 1)
        size, _ = xz.varint(stream[-12 - length :], at)
        packed += stream[12 : -12 - length]
        records.append((size, len(part)))
    index = b"\0" + number(len(records)) + b"".join(number(a) + number(b) for a, b in records)
    index += b"\0" * (-len(index) % 4)
    index += struct.pack("<I", zlib.crc32(index))
    tail = struct.pack("<I", len(index) // 4 - 1) + stream[6:8]
    return stream[:12] + packed + index + struct.pack("<I", zlib.crc32(tail)) + tail + b"YZ"


@pytest.mark.parametrize("cut", [1, 7, 64, 1000, 5000])
def test_xz_blocks_are_read_in_parts(spark, tmp_path, cut):
    import random

    rnd = random.Random(cut)
    page = lambda i: PAGE % (f"Ü{i}", i, "", i, "".join(rnd.choices("ab <é&", k=rnd.randrange(3000))).replace("&", "&amp;").replace("<", "&lt;page>"))
    xml = (DUMP % "\n".join(page(i) for i in range(12))).encode()
    size = max(cut, len(xml) // 400)
    parts = [xml[k : k + size] for k in range(0, len(xml), size)]
    packed = one_stream(parts[:-1]) + lzma.compress(parts[-1]) + b"\0" * 8
    assert lzma.decompress(packed[:-8]) == xml
    path = tmp_path / "d.xml.xz"
    path.write_bytes(packed)
    with xz.opened(str(path)) as file:
        every = xz.blocks(file)
        assert len(every) == len(parts) and b"".join(b"".join(xz.decoded(file, b)) for b in every) == xml
        for most in (1, 500, 10_000_000):
            got = [r for first, behind in xz.ranges(file, most) for r in xz.records(file, first, behind, dump.BEGINS, dump.ENDS)]
            assert got == dump.re.findall(rb"(?s)<page>.*?</page>", xml)
    rows = dump.xz_pages(spark, str(path), part=300)
    assert rows.rdd.getNumPartitions() > 1 if len(parts) > 20 else True
    (tmp_path / "plain.xml").write_bytes(xml)
    plain = dump.read_dump(spark, str(tmp_path / "plain.xml"))
    assert sorted((r.page_id, r.title, r.wikitext) for r in rows.collect()) == sorted((r.page_id, r.title, r.wikitext) for r in plain.collect())


def test_broken_xz_is_refused(tmp_path):
    whole = lzma.compress(b"x" * 1000)
    for bad in (whole[:-1], b"no xz file at all, not even near", whole[20:], whole[:-12] + b"\0" * 11 + b"Z"):
        (tmp_path / "b.xz").write_bytes(bad)
        with xz.opened(str(tmp_path / "b.xz")) as file, pytest.raises(lzma.LZMAError):
            xz.blocks(file)
    (tmp_path / "e.xz").write_bytes(lzma.compress(b""))
    with xz.opened(str(tmp_path / "e.xz")) as file:
        assert xz.ranges(file, 10) == [] or list(xz.records(file, 0, 1, dump.BEGINS, dump.ENDS)) == []


def vectors(spark, rows):
    return spark.createDataFrame(rows, "embedding_id string, chunk_id string, evidence_id string, domain string, topic string, model_version string, vector array<double>, source_hash string")


def test_sqlite_store(spark, tmp_path):
    import sqlite3

    path = str(tmp_path / "store")
    row = lambda i, domain="a", h="h", v=None: (f"e{i}", f"c{i}", f"v{i}", domain, "t", "m", v or [float(i), 0.5], h)
    sqlite.write_vectors(vectors(spark, [row(i, "ab"[i % 2]) for i in range(100)]), path, shards=4)
    assert len(os.listdir(path)) == 4
    key = lambda df: {r.embedding_id: (r.domain, r.vector) for r in df.collect()}
    assert key(sqlite.read_vectors(spark, path, rows_per_task=7)) == {f"e{i}": ("ab"[i % 2], [float(i), 0.5]) for i in range(100)}
    found = sqlite.read_vectors(spark, path, domain="b")
    assert set(key(found)) == {f"e{i}" for i in range(1, 100, 2)} and "domain" not in found._jdf.queryExecution().executedPlan().toString().split("Filter")[-1].split("\n")[0]
    reader = sqlite.VectorReader({"path": path})
    left = list(reader.pushFilters([sqlite.EqualTo(("domain",), "a"), sqlite.EqualTo(("source_hash",), "h")]))
    assert len(left) == 1 and reader.where() == (" AND domain = ?", ["a"]) and sum(b.num_rows for p in reader.partitions() for b in reader.read(p)) == 50

    sqlite.write_vectors(vectors(spark, [row(1, "z", "h1"), row(1, "y", "h0"), row(500, "z")]), path, shards=9)
    now = key(sqlite.read_vectors(spark, path))
    assert len(now) == 101 and now["e1"][0] == "z" and len(os.listdir(path)) == 4, "the number of shards stays"
    con = sqlite3.connect(f"{path}/{sorted(os.listdir(path))[0]}")
    con.execute("UPDATE embeddings SET vector_json = 'no'")
    con.commit()
    con.close()
    assert sqlite.read_vectors(spark, path).filter("vector is null").count() > 0

    one = tmp_path / "one.sqlite"
    con = sqlite3.connect(one)
    con.execute(sqlite.TABLE)
    con.executemany("INSERT INTO embeddings VALUES (?, 'c', 'v', 'd', 't', 'm', '[1, 2]', 'h')", [(f"x{i}",) for i in range(30)])
    con.commit()
    con.close()
    rows = sqlite.read_vectors(spark, str(one), rows_per_task=7)
    assert rows.count() == 30 and rows.rdd.getNumPartitions() == 5
    with pytest.raises(ValueError, match="read only"):
        sqlite.write_vectors(rows, str(one))
    sqlite.write_vectors(rows.limit(3), path, shards=2, overwrite=True)
    assert sqlite.read_vectors(spark, path).count() == 3
    assert sqlite.read_vectors(spark, str(tmp_path / "none")).count() == 0


def test_a_failed_write_leaves_the_store_as_it_was(spark, tmp_path):
    path = str(tmp_path / "store")
    sqlite.write_vectors(vectors(spark, [(f"e{i}", "c", "v", "d", "t", "m", [1.0], "h") for i in range(20)]), path, shards=3)
    before = {n: (tmp_path / "store" / n).read_bytes() for n in os.listdir(path)}
    bad = vectors(spark, [("e1", "c", "v", "d", "t", "m", [2.0], "h")]).withColumn("topic", sqlite.F.raise_error(sqlite.F.lit("no more")).cast("string"))
    with pytest.raises(Exception, match="no more"):
        sqlite.write_vectors(bad, path)
    writer = sqlite.VectorWriter({"path": path, "shards": "3"}, False)
    (tmp_path / "store" / f".part-00000-of-00003.sqlite.{writer.run}.x").write_bytes(b"left behind")
    writer.abort([])
    assert {n: (tmp_path / "store" / n).read_bytes() for n in os.listdir(path)} == before


def test_downloads(spark, tmp_path):
    from strataforge.sources import downloads as D

    big, asked = b"x" * 2000, tmp_path / "asked"
    asked.mkdir()
    answers = {"http://a/1.PDF": (200, "application/octet-stream", big), "http://a/2": (200, "text/html; charset=x", big), "http://a/short.pdf": (200, "application/pdf", b"x"), "http://b/4": (404, "", b""), "https://doi.org/10/4": (200, "image/png", big)}

    def ask(url):
        import uuid

        (asked / uuid.uuid4().hex).write_text(url)
        return answers.get(url, (0, "", b""))

    rows = [(1, "pubmed", "PMC-1", "First one!", 2020, "http://a/1.PDF", None, None), (2, "", "x", "Second", None, "", "http://a/2", None), (3, "doaj", "y", "Third", 2019, "http://a/short.pdf", "http://a/2", None), (4, "plos", "z", "Fourth", 2018, "http://b/4", None, "10/4"), (5, "plos", "n", "None", 2018, None, None, None)]
    papers_ = spark.createDataFrame(rows, "paper_id long, source string, external_id string, title string, year int, pdf_url string, fulltext_url string, doi string")
    got = {r.paper_id: tuple(r)[1:] for r in D.downloads(papers_, str(tmp_path / "raw"), 1000.0, ask).collect()}
    assert got["1"] == ("http://a/1.PDF", "pubmed/2020_PMC1_First_one.pdf", None) and got["2"] == ("http://a/2", "unknown/0000_x_Second.html", None) and got["3"] == ("http://a/2", "doaj/2019_y_Third.html", None)
    assert got["4"] == (None, None, "http://b/4: status 404; https://doi.org/10/4: type image/png") and got["5"] == (None, None, "no address")
    assert (tmp_path / "raw" / "pubmed" / "2020_PMC1_First_one.pdf").read_bytes() == big and not list((tmp_path / "raw").rglob("*.part"))
    before = len(list(asked.iterdir()))
    again = {r.paper_id: r.path for r in D.downloads(papers_, str(tmp_path / "raw"), 1000.0, ask).collect()}
    assert again == {k: v[1] for k, v in got.items()} and len(list(asked.iterdir())) == before + 2, "only what failed is asked for again"
    assert D.answered("http://127.0.0.1:9/none")[0] == 0 and D.answered("nonsense")[0] == 0
    assert D.downloads(papers_.limit(0), str(tmp_path / "raw")).count() == 0


def test_markdown_layer(spark, tmp_path):
    folder = tmp_path / "30" / "sub"
    folder.mkdir(parents=True)
    (folder / "b.md").write_text('---\nchunk_id: "c1"\ntoken_count: 12\n---\n\nbody\n')
    (folder / "a.md").write_text("---\nchunk_id: c2\ntoken_count: many\n---\nx")
    (folder / "bad.md").write_bytes(b"\xff\xfe\xff")
    (folder / "INDEX.md").write_text("no")
    (folder / "x_TOC.md").write_text("no")
    (folder / "empty.md").write_text("")
    rows = {r.file: r for r in files.read_markdown_layer(spark, str(tmp_path / "30"), "chunk_id string, token_count int").collect()}
    assert set(rows) == {"sub/a.md", "sub/b.md", "sub/bad.md"}
    assert (rows["sub/b.md"].chunk_id, rows["sub/b.md"].token_count, rows["sub/b.md"].body.strip(), rows["sub/b.md"].load_error) == ("c1", 12, "body", False)
    assert rows["sub/a.md"].token_count is None and rows["sub/bad.md"].load_error and rows["sub/bad.md"].chunk_id is None


def test_path_order(spark):
    rows = spark.createDataFrame([("b",), ("C",), ("a",), ("A",)], "rel_path string")
    assert [r.rel_path for r in files.in_path_order(rows).collect()] == ["A", "a", "b", "C"]


def test_renames(spark, tmp_path):
    names = {"d/x.pdf": "T.pdf", "d/y.pdf": "T.pdf", "d/Z.pdf": "T.pdf", "d/T_2.pdf": "T_2.pdf", "e/q.pdf": "T.pdf", "e/T.pdf": "T.pdf", "same.pdf": "same.pdf", "top.pdf": "new.pdf"}
    for n in names:
        (tmp_path / n).parent.mkdir(exist_ok=True)
        (tmp_path / n).write_text(n)
    plan = files.rename_plan(spark.createDataFrame(list(names.items()), "rel_path string, new_name string"))
    want = {"d/x.pdf": "d/T.pdf", "d/y.pdf": "d/T_3.pdf", "d/Z.pdf": "d/T_4.pdf", "e/q.pdf": "e/T_2.pdf", "top.pdf": "new.pdf"}
    assert {r.original: r.renamed for r in plan.collect()} == want
    log = spark.createDataFrame([*want.items(), ("gone.pdf", "g.pdf"), ("e/T.pdf", "same.pdf")], "original string, renamed string")
    for _ in range(2):  # a task that runs again does no harm
        got = {r.original: r.error for r in files.apply_renames(log, str(tmp_path)).collect()}
        assert got == {**dict.fromkeys(want), "gone.pdf": "no such file", "e/T.pdf": "target exists"}
    assert all((tmp_path / new).read_text() == old for old, new in want.items()) and (tmp_path / "e/T.pdf").read_text() == "e/T.pdf"
    empty = spark.createDataFrame([], "rel_path string, new_name string")
    assert files.rename_plan(empty).count() == 0


def test_converter_programs(tmp_path, monkeypatch):
    text, error = convert.markdown_of(b"x", "a.doc", "doc")
    assert text is None and "soffice" in error
    program = tmp_path / "ebook-convert"
    program.write_text('#!/bin/sh\n[ "$(cat "$1")" = bad ] && { echo broken >&2; exit 3; }\ncp "$BOOK" "$2"\n')
    program.chmod(program.stat().st_mode | stat.S_IEXEC)
    import zipfile

    with zipfile.ZipFile(tmp_path / "b.epub", "w") as z:
        z.writestr("META-INF/container.xml", '<c><rootfiles><rootfile full-path="p.opf"/></rootfiles></c>')
        z.writestr("p.opf", '<package><metadata><title>Book</title></metadata><manifest><item id="a" href="a.xhtml" media-type="application/xhtml+xml"/></manifest><spine><itemref idref="a"/></spine></package>')
        z.writestr("a.xhtml", "<html><body><h1>Ch</h1><p>text</p></body></html>")
    monkeypatch.setenv("PATH", f"{tmp_path}:{os.environ['PATH']}")
    monkeypatch.setenv("BOOK", str(tmp_path / "b.epub"))
    text, error = convert.markdown_of(b"good", "a.mobi", "mobi")
    assert error is None and "# Ch\n\ntext" in text and "MOBI" in text
    assert "broken" in convert.markdown_of(b"bad", "a.azw3", "azw3")[1]


def test_docx_numbers_and_marks():
    from tests.test_convert import W, archive, body

    num = lambda n, lvl: f'<w:pStyle w:val="N"/><w:numPr><w:ilvl w:val="{lvl}"/><w:numId w:val="{n}"/></w:numPr>'
    p = lambda text, props="", run="": f"<w:p><w:pPr>{props}</w:pPr><w:r><w:rPr>{run}</w:rPr><w:t>{text}</w:t></w:r></w:p>"
    parts = [p("a", num(1, 0)), p("b", num(1, 1)), p("c", num(1, 0)), p("d", num(2, 0)), p("both", "", "<w:b/><w:i/>"), p("code", "", '<w:rFonts w:ascii="DejaVu Sans Mono"/>')]
    styles = f'<w:styles {W}><w:style w:styleId="N"><w:name w:val="List Number"/></w:style></w:styles>'
    got = body(archive(**{"word/document.xml": f"<w:document {W}><w:body>{''.join(parts)}</w:body></w:document>", "word/styles.xml": styles}), "d.docx")
    assert [x for x in got.splitlines() if x][1:] == ["1. a", "  1. b", "2. c", "1. d", "***both***", "`code`"]


def test_files_are_tracked_and_papers_listed(spark, tmp_path, capsys):
    from strataforge.__main__ import main
    from strataforge.plans.runner import tracked

    raw, work, store = tmp_path / "raw", str(tmp_path / "w"), str(tmp_path / "store")
    (raw / "s").mkdir(parents=True)
    (raw / "s" / "a.md").write_text("# A\n\n" + "Some words stand here. " * 120)
    assert [r.in_documents for r in tracked(spark, str(raw), work).collect()] == [False]
    assert main(["run", work, str(raw), "--domain", "demo"]) == 0
    (raw / "s" / "b.md").write_text("# B\n\nlater")
    got = {r.rel_path: (r.in_documents, r.in_chapters, r.in_chunks) for r in tracked(spark, str(raw), work).collect()}
    assert got == {"s/a.md": (True,) * 3, "s/b.md": (False,) * 3}
    capsys.readouterr()
    assert main(["files", work, str(raw)]) == 0
    assert json.loads(capsys.readouterr().out) == {"files": 2, "in_documents": 1, "in_chapters": 1, "in_chunks": 1}
    rows = [(1, "One", "plos", 2020, 0.5, True, False, ["t"]), (2, "Two", "doaj", None, 0.75, True, True, ["t", "u"]), (3, "Three", "doaj", 2001, 0.1, False, False, ["u"])]
    spark.createDataFrame(rows, "paper_id int, title string, source string, year int, relevance_score double, is_open_access boolean, downloaded boolean, topics array<string>").write.parquet(store)
    assert main(["papers", store, "--topic", "t", "--export", str(tmp_path / "x")]) == 0
    out = capsys.readouterr().out.splitlines()
    assert json.loads(out[0]) == {"papers": 3, "downloaded": 1, "open_access": 2} and len(out) == 5
    assert out[3:] == ["[0.75] Two | doaj | ? | ?", "[0.50] One | plos | ? | 2020"]
    assert spark.read.option("header", True).csv(str(tmp_path / "x")).count() == 2
    assert main(["papers", store, "--export", str(tmp_path / "x")]) == 1
