import datetime
import json

import pytest

from strataforge.operators import audit, cleanup, incremental, literature, retrieval, stages, textplan, validate, wikigraph
from strataforge.plans import bootstrap, registry
from strataforge.plans.runner import Blocked, Settings, Workspace, run
from strataforge.sources import dump, files, papers
from strataforge.streaming import events, ingest

LONG = " ".join(f"Sentence {i} has some words in it." for i in range(60))


@pytest.fixture
def raw(tmp_path):
    folder = tmp_path / "raw" / "src"
    folder.mkdir(parents=True)
    (folder / "a.md").write_text(f"# A\n\n{LONG}\n\n# B\n\n{LONG}\n")
    (folder / "b.csv").write_text("x,y\n" + "\n".join(f"{i},{LONG[:200]}" for i in range(8)))
    (folder / "c.html").write_text(f"<h1>C</h1><p>{LONG}</p>")
    (folder / "skip.bin").write_text("x")
    return tmp_path / "raw"


def test_full_then_incremental(spark, raw, tmp_path):
    work, settings = str(tmp_path / "w"), Settings("corpus", least_tokens=1)
    first = run(spark, str(raw), work, settings)
    assert first["ran"] == registry.order(registry.STAGES) and first["rows"]["documents"] == 3
    assert all(not set(m) & {"ERROR", "FATAL"} for m in first["messages"].values()), first["messages"]
    state = Workspace(spark, work).state()
    w = Workspace(spark, work)
    assert w.read("evidence", state).filter("topic = 'general'").count() == first["rows"]["evidence"] == first["rows"]["embeddings"]
    assert w.read("wiki", state).count() == first["rows"]["evidence"] and w.read("wiki", state).first().section.startswith("## ")
    assert first["rows"]["ingest_errors"] == 0 and w.read("analysis", state).first().topics == 1
    assert run(spark, str(raw), work, settings)["status"] == "no_changes"
    (raw / "src" / "c.html").write_text(f"<h1>C2</h1><p>{LONG}</p>")
    (raw / "src" / "b.csv").unlink()
    assert run(spark, str(raw), work, settings, dry_run=True)["rows"] == {}
    again = run(spark, str(raw), work, settings)
    assert again["changes"]["modified"] == 1 and again["changes"]["removed"] == 1 and again["rows"]["documents"] == 2
    found = retrieval.search(w.read("embeddings", w.state()), w.read("evidence", w.state()), "lorem ipsum", 2, "corpus")
    assert found.count() == 2 and retrieval.search(w.read("embeddings", w.state()), w.read("evidence", w.state()), "x", 2, "other").count() == 0


def layers_of(spark, folder):
    work = Workspace(spark, folder)
    state = work.state()
    return {name: sorted(repr(sorted(r.asDict(recursive=True).items())) for r in work.read(name, state).collect()) for name in state["layers"] if not name.startswith("messages_")}


def test_a_changed_file_touches_its_own_rows_only(spark, tmp_path, monkeypatch):
    """Incremental runs by document: what they leave equals a full run, whatever changes."""
    import os

    from strataforge.plans import runner

    monkeypatch.setattr(runner, "PER_BUCKET", 4)
    folder, work, settings = tmp_path / "raw" / "src", str(tmp_path / "w"), Settings("corpus", least_tokens=1)
    folder.mkdir(parents=True)
    for i in range(40):
        (folder / f"f{i}.md").write_text(f"# T{i}\n\n{LONG}\n\n# U\n\nfile {i} {LONG}\n")
    first = run(spark, str(tmp_path / "raw"), work, settings)
    assert first["mode"] == "full" and first["rows"]["documents"] == 40
    before = Workspace(spark, work).state()
    assert before["buckets"] == 10
    assert run(spark, str(tmp_path / "raw"), work, settings)["status"] == "no_changes"

    (folder / "f7.md").write_text(f"# New\n\nnow other {LONG}\n")
    one = run(spark, str(tmp_path / "raw"), work, settings)
    assert one["mode"] == "changed" and one["documents_changed"] == 1 and one["buckets"] == 1 and set(one["fresh"].values()) == {1}
    after = Workspace(spark, work).state()
    moved = {b for b, r in after["layers"]["chunks"]["buckets"].items() if before["layers"]["chunks"]["buckets"].get(b) != r}
    assert len(moved) == 1, "one bucket has a new version, the others are the files of the run before"

    (folder / "f8.md").unlink()
    (folder / "f9.txt").write_text("A text beside f9.md, so both are named by their endings. " + LONG)
    (folder / "odd [1] {a} *.md").write_text(f"# Odd\n\n{LONG}\n")
    os.utime(folder / "f10.md", (1, 1))
    (folder / "bad.docx").write_bytes(b"no zip")
    many = run(spark, str(tmp_path / "raw"), work, settings)
    assert many["mode"] == "changed" and many["rows"]["ingest_errors"] == 1 and many["rows"]["documents"] == 41
    full = str(tmp_path / "again")
    run(spark, str(tmp_path / "raw"), full, settings)
    assert layers_of(spark, work) == layers_of(spark, full)

    run(spark, str(tmp_path / "raw"), full, settings, full=True)
    assert layers_of(spark, work) == layers_of(spark, full)
    state = Workspace(spark, work).state()
    assert Workspace(spark, work).clean() and Workspace(spark, work).state() == state and layers_of(spark, work) == layers_of(spark, full)
    assert Workspace(spark, work).clean() == []


def test_stages_left_out_are_made_up_for(spark, raw, tmp_path):
    work, settings = str(tmp_path / "w"), Settings("corpus", least_tokens=1)
    run(spark, str(raw), work, settings)
    (raw / "src" / "c.html").write_text(f"<h1>C2</h1><p>{LONG}</p>")
    some = run(spark, str(raw), work, settings, only=("discover_sources", "ingest", "chapter_splitter"))
    assert "chunk_builder" in some["skipped"] and Workspace(spark, work).state()["behind"]
    rest = run(spark, str(raw), work, settings)
    assert "chunk_builder" in rest["ran"] and Workspace(spark, work).state()["behind"] == []
    run(spark, str(raw), str(tmp_path / "full"), settings)
    assert layers_of(spark, work) == layers_of(spark, str(tmp_path / "full"))


def test_a_check_blocks(spark, raw, tmp_path):
    with pytest.raises(Blocked, match="20_to_30"):
        run(spark, str(raw), str(tmp_path / "w"), Settings("corpus", most_tokens=10))
    with pytest.raises(ValueError, match="domain"):
        Settings("Not A Name")


def test_registry():
    order = registry.order(registry.STAGES)
    assert order.index("embedding_builder") < order.index("wiki_builder") < order.index("analysis_builder")
    with pytest.raises(ValueError, match="each other"):
        registry.order({"a": ("b",), "b": ("a",)})
    with pytest.raises(ValueError, match="unknown"):
        registry.order({"a": ("zz",)})
    assert registry.affected(registry.STAGES, {"embedding_builder"}) == {"embedding_builder"}


def test_bootstrap(spark, tmp_path):
    made = dict(bootstrap.create(spark, str(tmp_path), "demo", seeds=True))
    assert set(made.values()) == {"created"} and (tmp_path / "30_chunk_demo" / "INDEX.md").exists()
    (tmp_path / "personas" / "default_persona.md").write_text("mine")
    again = dict(bootstrap.create(spark, str(tmp_path), "demo", seeds=True, force=True))
    assert again["personas/default_persona.md"] == "kept" and again["30_chunk_demo/INDEX.md"] == "replaced"
    assert bootstrap.missing_sections((tmp_path / "30_chunk_demo" / "INDEX.md").read_text()) == []
    assert bootstrap.missing_sections("# x\n## Purpose") == ["## Input", "## Output", "## Upstream", "## Downstream", "## Quality Checklist"]
    assert bootstrap.plan_rows(spark, "demo").count() == 22


def test_sources(spark, raw, tmp_path):
    got = {r.rel_path: r for r in files.discover(spark, str(raw)).collect()}
    assert set(got) == {"src/a.md", "src/b.csv", "src/c.html"}
    assert {r.rel_path for r in files.discover(spark, f"file://{raw}", ".MD, html", content=False).collect()} == {"src/a.md", "src/c.html"}
    names = spark.createDataFrame([("d/a.md",), ("d/INDEX.md",), ("d/x_TOC.md",), ("index/y.md",), ("d/a_001_t.md",)], "rel_path string")
    assert {r.rel_path for r in files.chapter_files(names).collect()} == {"d/a.md", "d/a_001_t.md"}
    assert {r.rel_path for r in files.unsplit_files(names).collect()} == {"d/a.md", "d/INDEX.md", "index/y.md"}
    docs = spark.createDataFrame([("d", "# A b\n1\n# C\n2")], "document_id string, body string")
    assert sorted((r.number, r.file_name) for r in files.write_sections(docs).collect()) == [(1, "01_a_b.md"), (2, "02_c.md")]
    path = tmp_path / "layer.json"
    path.write_text(json.dumps([{"evidence_id": "e", "score": 0.5}]))
    assert files.read_layer(spark, str(path), 40, "evidence_id string, score double").first().score == 0.5


XML = """<mediawiki><page><title>cat animal</title><ns>0</ns><id>1</id><revision><id>11</id><timestamp>t</timestamp><text>[[Dog]] [[File:x]] [[dog|d]] [[Fur#s|f]]</text></revision></page>
<page><title>Talk</title><ns>1</ns><id>2</id><revision><id>12</id><text>x</text></revision></page>
<page><title>Dog</title><ns>0</ns><id>3</id><revision><id>13</id><timestamp>t</timestamp><text>#REDIRECT [[hound#x]]</text></revision></page>
<page><title>Hound</title><ns>0</ns><id>4</id><revision><id>14</id><timestamp>t</timestamp><text>a [[Cat animal]]</text></revision></page></mediawiki>"""


def test_dump_and_crawl(spark, tmp_path):
    (tmp_path / "d.xml").write_text(XML)
    pages = wikigraph.index_pages(dump.read_dump(spark, str(tmp_path / "d.xml")))
    got = {r.title: r for r in pages.collect()}
    assert set(got) == {"Cat animal", "Dog", "Hound"} and got["Cat animal"].links == ["Dog", "Fur"] and got["Dog"].redirect_target == "Hound"
    seeds = spark.createDataFrame([("cat_animal", 0), ("nowhere", 1)], "title string, pos long")
    assert {(r.title, r.depth, r.parent) for r in wikigraph.expand(seeds, pages, 2).collect()} == {("Cat animal", 0, ""), ("Hound", 1, "Cat animal")}
    assert wikigraph.expand(seeds, pages, 2, most=1).count() == 1
    text = {r.title: r for r in dump.article_text(pages, "d").collect()}["Cat animal"]
    assert text.file_name == "wikipedia_cat_animal.txt" and '\npage_id: "1"\n' in text.text and text.text.startswith("---\nsource: ")
    stored = spark.createDataFrame([("wikipedia_a_b.txt", "x", None), ("y.txt", 'title: "T"', None), ("z.txt", "", "L")], "file_name string, text string, legacy string")
    assert sorted(r.title for r in dump.stored_articles(stored).collect()) == ["L", "T", "a b"]


def test_redirect_limits(spark):
    rows = [(f"n{i}", f"n{i + 1}" if i < 9 else None) for i in range(10)] + [("a", "b"), ("b", "a")]
    pages = spark.createDataFrame([(t, r, r is not None) for t, r in rows], "title string, redirect_target string, is_redirect boolean")
    got = {r.title: r.canonical for r in wikigraph.resolve_redirects(pages.select("title"), pages).collect()}
    assert got["n2"] == "n9" and got["n1"] is None and got["a"] is None and got["n9"] == "n9"


PUBMED = "<s><PubmedArticle><MedlineCitation><PMID>7</PMID><Article><ArticleTitle>T</ArticleTitle><Abstract><AbstractText>x</AbstractText><AbstractText>y</AbstractText></Abstract><AuthorList><Author><LastName>Doe</LastName><ForeName>J</ForeName></Author></AuthorList><Journal><Title>J</Title><PubDate><Year>2020</Year></PubDate></Journal></Article></MedlineCitation><PubmedData><ArticleIdList><ArticleId IdType='doi'>10/x</ArticleId><ArticleId IdType='pmc'>PMC1</ArticleId></ArticleIdList></PubmedData></PubmedArticle></s>"


def test_paper_sources(spark):
    answers = [("pubmed", PUBMED), ("pubmed", "<broken"), ("doaj", json.dumps({"results": [{"id": "d", "bibjson": {"title": "D", "year": "2019", "identifier": [{"type": "doi", "id": "10/d"}], "author": [{"name": "A"}]}}]})), ("plos", json.dumps({"response": {"docs": [{"id": "p", "title_display": "P", "abstract": ["a", "b"], "publication_date": "2018-02", "doi": "10/p"}]}})), ("other", "x")]
    got = {r.source: r for r in papers.parse_answers(spark.createDataFrame(answers, "service string, answer string")).collect()}
    assert got["pubmed"].abstract == "x y" and got["pubmed"].authors == ["Doe, J"] and got["pubmed"].is_open_access and got["pubmed"].year == 2020
    assert got["doaj"].url == "https://doi.org/10/d" and got["plos"].abstract == "a b" and got["plos"].year == 2018
    assert papers.pmc_pdf("<r><link format='pdf' href='ftp://h/x.pdf'/></r>") == "https://h/x.pdf"
    papers.register(spark)
    waits, replies = [], iter([(429, ""), (500, ""), (200, "ok")])
    assert papers.polite(lambda url: next(replies), 1000.0, sleep=waits.append)("u") == "ok" and [w for w in waits if w > 1] == [5.0, 4.0]


def test_greedy_dedup_drops_register_nothing(spark):
    rows = [("t", 1, "d1", "one"), ("t", 2, "d2", "one"), ("t", 3, "d2", "three"), ("u", 4, "d1", "one"), ("t", 5, None, None), ("t", 6, None, None), ("t", 7, "", "ONE")]
    df = spark.createDataFrame(rows, "topic string, arrival int, doi string, title string")
    assert sorted(r.arrival for r in literature.dedup_greedy(df).collect()) == [1, 3, 4, 5, 6]


def test_first_wins_equals_a_walk(spark):
    import random

    rnd = random.Random(4)
    rows = [(rnd.choice("ab"), i, rnd.choice([None, "", " D1 ", *(f"d{k}" for k in range(60))]), rnd.choice(["Editorial", "editorial ", None, *(f"title {k}" for k in range(80))])) for i in range(400)]
    rows += [("chain", i, f"c{(i + 1) // 2}", f"x{i // 2}") for i in range(30)]
    want, seen = [], set()
    for g, i, doi, title in rows:
        keys = {(g, "d", doi.strip().lower()) for _ in [0] if doi and doi.strip()} | {(g, "t", title.strip().lower()[:80]) for _ in [0] if title and title.strip()}
        if not keys & seen:
            want.append(i if g != "chain" else -i)
            seen |= keys
    df = spark.createDataFrame(rows, "topic string, arrival int, doi string, title string").repartition(7)
    assert sorted(r.arrival if r.topic != "chain" else -r.arrival for r in literature.dedup_greedy(df).collect()) == sorted(want)
    with pytest.raises(RuntimeError, match="not decided"):
        literature.first_wins(df, literature.paper_keys(), ["topic"], ["arrival"], rounds=2)


def by_queue(graph, seeds, depth, most):
    """The queue itself, one title after the other; graph: title -> (redirect, links)."""
    def page_of(title):
        for _ in range(wikigraph.LOOKUPS):
            if title not in graph or not graph[title][0]:
                return title if title in graph else None
            title = graph[title][0]
        return None

    waiting, visited, out = [(s, 0, "") for s in seeds], {}, []
    while waiting and len(visited) < most:
        title, d, parent = waiting.pop(0)
        page = page_of(title)
        if page is None or page in visited:
            continue
        visited[page] = True
        out.append((page, d, parent, len(visited)))
        if d < depth:
            for x in graph[page][1]:
                if len(visited) + len(waiting) >= 3 * most:
                    break
                waiting.append((x, d + 1, page))
    return out


@pytest.mark.parametrize("most", [1, 3, 17, 60, 400])
def test_crawl_equals_a_queue(spark, most):
    import random

    rnd = random.Random(most)
    names = [f"N{i}" for i in range(300)]
    graph = {n: (rnd.choice(names) if rnd.random() < 0.15 else None, [rnd.choice([*names, "Gone", "Lost"]) for _ in range(rnd.randrange(12))]) for n in names}
    rows = [(n, links, target is not None, target) for n, (target, links) in graph.items()]
    pages = spark.createDataFrame(rows, "title string, links array<string>, is_redirect boolean, redirect_target string")
    seeds = ["Gone", "N1", "N1", "N2", *names[5:25]]
    got = wikigraph.crawl(spark.createDataFrame([(s, i) for i, s in enumerate(seeds)], "title string, pos long"), pages, 4, most)
    assert sorted(map(tuple, got.collect()), key=lambda r: r[3]) == by_queue(graph, seeds, 4, most)


def test_export(spark, tmp_path):
    df = spark.createDataFrame([("p", "T", ["A", "B"], 0.5)], "paper_id string, title string, authors array<string>, relevance_score double")
    literature.export(df, str(tmp_path / "x"))
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        literature.export(df, str(tmp_path / "x"))
    literature.export(df, str(tmp_path / "x"), force=True)
    assert spark.read.csv(str(tmp_path / "x"), header=True).first().authors == "A; B"


def test_validators_are_silent_on_clean_data_and_fire_on_each_fault(spark):
    docs = spark.createDataFrame([("d1", "s1", "dom", "h", "l")], "document_id string, source_id string, domain string, hash_sha256 string, lineage string")
    chap = spark.createDataFrame([("d1", "s1", 1, "T", "text", "f.md")], "document_id string, source_id string, chapter int, title string, body string, file_name string")
    assert validate.validate("10_to_20", docs, chap).count() == 0
    bad = chap.unionByName(chap).unionByName(spark.createDataFrame([("zz", "", 1, "", "", "g.md")], chap.schema))
    rules = {(r.validator, r.rule, r.description) for r in validate.validate("10_to_20", docs, bad).collect()}
    assert {x[2] for x in rules} >= {"duplicate chapter_id within document", "missing source_id", "document_id not found in layer10", "document reference unresolved", "chapter body is empty", "layer20: missing required field heading"}
    chunk = spark.createDataFrame([("c1", "ch01", "d1", 200, 1)], "chunk_id string, chapter_id string, document_id string, token_count int, sequence int")
    assert validate.validate("20_to_30", chap, chunk).count() == 0
    assert validate.validate("20_to_30", chap, chunk.selectExpr("chunk_id", "'ch02' chapter_id", "document_id", "600 token_count", "sequence")).filter("severity in ('FATAL', 'ERROR')").count() == 2
    ev = spark.createDataFrame([("e1", "c1", 0.5, "f", "d", "text")], "evidence_id string, chunk_id string, score double, source_file string, domain string, content_preview string")
    em = spark.createDataFrame([("m1", "c1", "e1", "d", "hash-v1", [0.5, 1.0])], "embedding_id string, chunk_id string, evidence_id string, domain string, model_version string, vector array<double>")
    assert validate.validate("40_to_50", ev, em).count() == 0
    worse = em.unionByName(spark.createDataFrame([("m2", "zz", "zz", "d", "other", [float("nan")])], em.schema))
    assert {r.rule for r in validate.validate("40_to_50", ev, worse).collect()} == {"reference_chunk", "reference_evidence", "embedding_model_version_consistency", "embedding_vector_dimension_consistency", "embedding_vector_finite"}
    assert {r.rule for r in validate.validate("40_to_50", ev, em.limit(0)).collect()} == {"coverage_chunk", "coverage_evidence"}
    messages = validate.validate("40_to_50", ev, worse)
    assert validate.blocks(messages) and not validate.blocks(messages, stop_on_error=False)


def test_cleanup_and_incremental_edges(spark):
    raw = spark.createDataFrame([("a/x.md", "1"), ("b/y.md", "2"), ("c/y.txt", "3")], "rel_path string, sha256 string")
    docs = spark.createDataFrame([(1, "x.md", ".\\A/X.md", "9"), (2, "gone.md", "", "2"), (3, "Y.pdf", None, None), (4, "y.md", "z/y.md", None)], "source_id int, source_file string, lineage string, hash_sha256 string")
    got = {r.source_id: (r.status, r.match) for r in cleanup.match_sources(docs, raw).collect()}
    assert got == {1: ("ok", "lineage.layer00_path"), 2: ("renamed_or_moved", "hash_sha256"), 3: ("missing", "not_found"), 4: ("renamed_or_moved", "source_file(name)")}
    old = spark.createDataFrame([("k", "a")], "rel_path string, sha256 string")
    assert incremental.change_summary(incremental.manifest_diff(old, old)).first().asDict() == {"total": 1, "new": 0, "removed": 0, "modified": 0, "unchanged": 1, "changed": False}
    assert incremental.write_status(old, old.selectExpr("rel_path", "'b' sha256"), "rel_path", "sha256", force=False).first().status == "skipped"
    assert files.create_only(raw, old.selectExpr("'a/x.md' rel_path"), "rel_path").count() == 2
    links = audit.stale(spark.createDataFrame([("l", datetime.date(2020, 1, 1))], "link string, last_modified date"), "2024-01-01")
    assert links.first().age_days == 1461


def test_streams(spark, sf, raw, tmp_path):
    table = spark.read.parquet(f"{sf}/events.parquet")
    a, b = events.hourly(table), events.streamed_hourly(spark, f"{sf}/events.parquet")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    out, mark = str(tmp_path / "docs"), str(tmp_path / "mark")
    ingest.ingest_new(spark, str(raw), out, mark, "corpus")
    assert spark.read.parquet(out).count() == 3
    (raw / "src" / "new.txt").write_text("some text here.")
    ingest.ingest_new(spark, str(raw), out, mark, "corpus")
    assert spark.read.parquet(out).count() == 4


def test_sql_functions(spark):
    from strataforge.functions import sql
    from strataforge.functions.text import slug
    from strataforge.functions.vectors import hash_vector
    from pyspark.sql import functions as F

    sql.register(spark)
    r = spark.sql("SELECT slug('Ä b!') s, token_count(' a  b ') n, hash_vector('x') v, cosine(array(1D, 0D), array(1D, 0D)) c").first()
    same = spark.range(1).select(slug(F.lit("Ä b!")).alias("s"), hash_vector(F.lit("x")).alias("v")).first()
    assert (r.s, r.n, r.c) == (same.s, 2, 1.0) and r.v == same.v and len(r.v) == 64
    assert spark.sql("SELECT * FROM plan_chunks('# A\n\ntext')").first().content == "# A\n\ntext\n"
    assert spark.sql("SELECT * FROM split_chapters('# A\nx\n# B\ny')").count() == 2


def test_hash_vector_and_toc(spark):
    import hashlib

    from strataforge.functions.vectors import hash_vector
    from pyspark.sql import functions as F

    one = hashlib.sha256("é x".encode()).digest()
    want = [round(b / 255, 6) for b in one + hashlib.sha256(one).digest()]
    assert spark.range(1).select(hash_vector(F.lit("é x"))).first()[0] == want
    docs = spark.createDataFrame([("d", "s", "dom", "t", "f.md", f"# A\n{LONG}\n# B\n{LONG}")], "document_id string, source_id string, domain string, topic string, source_file string, body string")
    toc = stages.chapter_toc(stages.split_chapters(docs)).first().toc
    assert toc == "  1. [A](d_001_A.md)  _420 Wörter_\n  2. [B](d_002_B.md)  _420 Wörter_"


class Caught:
    """A DataFrame whose Arrow pass is given back as a function."""

    def __init__(self, df):
        self.columns, self.schema = df.columns, df.schema

    def mapInArrow(self, run, schema):
        return run


def test_planners_hand_on_rows_before_a_batch_ends(spark):
    import pyarrow as pa

    texts, seen = ["x" * 10_000 + str(i) for i in range(1_000)] + [None, ""], []

    def plan(text):
        seen.append(text)
        return [(k, text) for k in range(len(text or "") % 3)]

    run = stages.planned(Caught(spark.createDataFrame([], "id long, body string")), ["body"], plan, "k int, body string")
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], ["id", "body"])
    made = run(iter([batch]))
    parts = [next(made)]
    assert len(seen) < 200
    parts += made
    assert max(p.nbytes for p in parts) < 2 * stages.AT_ONCE and seen == texts
    rows = [tuple(r.values()) for p in parts for r in p.to_pylist()]
    assert rows == [(i, k, t) for i, t in enumerate(texts) for k in range(len(t or "") % 3)]


def test_chapters_of_one_document_leave_in_parts(spark):
    import pyarrow as pa

    names = ["document_id", "source_id", "domain", "topic", "source_file", "body"]
    body = f"# T\n{'intro ' * 20_000}\n" + "".join(f"## C{i}\n{'word ' * 30}\n" for i in range(100))
    docs = Caught(spark.createDataFrame([], ", ".join(f"{c} string" for c in names)))
    kinds = "chapter int, body string, preamble string"
    run = stages.planned(docs, ["body"], lambda b: ((c.number, c.body, "\n".join(before)) for before, found, _ in [textplan.chapters(b)] for c in found), kinds)
    parts = list(run(iter([pa.RecordBatch.from_arrays([pa.array([body if c == "body" else "d"]) for c in names], names)])))
    assert len(parts) > 5 and [n for p in parts for n in p.column("chapter").to_pylist()] == list(range(1, 101))


def test_document_and_chunk_files(spark):
    raw = spark.createDataFrame([("d", "s/a.md", "md", "t", "h", "---\ntopic: \"old\"\nz: 1\nb: x\n---\n# A\n\n[source 1]\n")], "document_id string, rel_path string, ext string, mtime string, sha256 string, markdown string")
    docs = stages.normalise_documents(raw, "dom")
    row = docs.first()
    assert row.changed and row.extra == {"z": "1", "b": "x"} and row.topic == "general"
    text = docs.select(stages.document_text(docs).alias("t")).first().t
    assert text.startswith('---\ndocument_id: "d"\nsource_id: "d"\n') and text.index('\nb: "x"') < text.index('\nz: "1"') and text.endswith("---\n\n# A\n\n[source 1]\n")
    again = stages.normalise_documents(raw.drop("markdown").crossJoin(docs.select(stages.document_text(docs).alias("markdown"))), "dom").first()
    assert not again.changed and again.body == row.body
    made = stages.chunk_file({"chunk_id": "c", "content": " text\n", "sequence": 1, "lineage": {"b": 'q"', "a": 2}})
    assert made == '---\nchunk_id: "c"\nlineage:\n  a: 2\n  b: "q\\""\nsequence: 1\n---\n\n# Chunk\n\ntext\n'


def test_update_store(spark):
    topics = spark.createDataFrame([("a", ["cat"], [], []), ("b", ["dog"], [], [])], "topic string, keywords array<string>, boost_terms array<string>, penalty_terms array<string>")
    rows = [("p1", "Cat review", "cat", "j", 2023, "x1", "s", True, "a", 1), ("p1b", "other", "cat", "j", 2023, "x1", "s", True, "a", 2), ("p2", "Dog", "dog", "j", 2023, "x2", "s", True, "b", 3), ("p3", "nothing", "n", "j", 1990, "x3", "s", False, "b", 4)]
    found = spark.createDataFrame(rows, "paper_id string, title string, abstract string, journal string, year int, doi string, source string, is_open_access boolean, topic string, arrival int")
    store = spark.createDataFrame([("p2", "Old", ["z"], 0.99)], "paper_id string, title string, topics array<string>, relevance_score double")
    got = {r.paper_id: r for r in literature.update_store(store, found, topics, 2024).collect()}
    assert set(got) == {"p1", "p2"} and got["p1"].topics == ["a"] and got["p2"].title == "Old"


def test_command_line(spark, raw, tmp_path, capsys):
    from strataforge.__main__ import main

    work = str(tmp_path / "w")
    assert main(["bootstrap", work, "--domain", "demo"]) == 0 and "created 00_raw_demo" in capsys.readouterr().out
    assert main(["run", work, str(raw), "--domain", "demo"]) == 0
    assert main(["run", work, str(raw), "--domain", "demo"]) == 3
    capsys.readouterr()
    assert main(["search", work, "words", "--domain", "demo", "-k", "2"]) == 0
    rows = [json.loads(x) for x in capsys.readouterr().out.splitlines()]
    assert len(rows) == 2 and rows[0]["score"] >= rows[1]["score"]


def test_repeated_events_in_a_stream_count_once(spark, tmp_path):
    rows = [(i % 5, datetime.datetime(2024, 1, 1, 0, i)) for i in range(10)]
    df = spark.createDataFrame(rows, "event_id long, ts timestamp")
    for k in range(2):
        df.write.mode("append").parquet(str(tmp_path / "in"))
    stream = events.deduplicated(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")))
    run_ = stream.writeStream.format("memory").queryName("once").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    run_.awaitTermination()
    assert spark.table("once").count() == 5


def test_files_that_fail_are_kept_and_counted(spark, raw, tmp_path):
    (raw / "src" / "broken.docx").write_bytes(b"no zip at all")
    out = run(spark, str(raw), str(tmp_path / "w"), Settings("corpus", least_tokens=1))
    w = Workspace(spark, str(tmp_path / "w"))
    (row,) = w.read("ingest_errors", w.state()).collect()
    assert out["rows"]["ingest_errors"] == 1 and row.rel_path.endswith("broken.docx") and row.error and out["rows"]["documents"] == 3


def test_chunk_sizes_fall_back_to_the_text(spark):
    rows = spark.createDataFrame([("a", None, "one two"), ("b", "many", "one two three"), ("c", "200", "x"), ("d", "900", "x")], "chunk_id string, token_count string, content string")
    got = {(r.identifier, r.rule, r.description) for r in validate.sizes("20_to_30", rows).collect()}
    low = "chunk below minimum token threshold ({} < 100)"
    assert got == {("a", "size_chunk_min", low.format(2)), ("b", "size_chunk_min", low.format(3)), ("d", "size_chunk_max", "chunk above maximum token threshold (900 > 500)")}
