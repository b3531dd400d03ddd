"""Plans are the ones that scale: pruned and filtered scans, heaps instead of sorts, no nested loops over large sides."""

import pytest

from strataforge import queries as Q
from strataforge.operators import audit, retrieval, stages
from strataforge.sources import files


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    rows = spark.createDataFrame([("d", "t", "e", "c", "m", [1.0, 2.0])], "domain string, topic string, embedding_id string, chunk_id string, evidence_id string, vector array<double>")
    rows.write.parquet(str(tmp_path / "e"))
    text = plan(files.read_vectors(spark, str(tmp_path / "e"), "d", "t").select("embedding_id"))
    assert "EqualTo(domain,d)" in text and "EqualTo(topic,t)" in text
    assert "vector" not in text.partition("ReadSchema")[2].partition("\n")[0]
    stages.write_embeddings(rows, str(tmp_path / "p"))
    text = plan(files.read_vectors(spark, str(tmp_path / "p"), "d"))
    assert "PartitionFilters: [isnotnull(domain" in text


def test_top_k_is_a_heap_and_enriches_k_rows(spark, sf):
    text = plan(Q.scored_vectors(spark, sf).transform(lambda df: retrieval.top_k(df, 3, "vec_id")))
    assert "TakeOrderedAndProject" in text and "Sort [" not in text


@pytest.mark.parametrize("name", ["audit_rollup", "pair_reference", "manifest_diff", "cleanup_cascade", "source_match_waterfall", "unresolved_reference", "upsert_last_wins", "mark_downloaded"])
def test_no_nested_loops(spark, sf, name):
    text = plan(Q.QUERIES[name](spark, sf))
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_topics_are_scored_inside_the_row(spark, sf):
    text = plan(Q.paper_score(spark, sf))
    assert "Join" not in text and "hashpartitioning" not in text  # the one exchange is that of `spread`
    assert plan(Q.rank_topn(spark, sf)).count("Exchange hashpartitioning") == 1


def test_no_text_is_shuffled_for_change_detection(spark, sf):
    old, new = Q.states(spark, sf)
    from strataforge.operators.incremental import manifest_diff

    lines = [x for x in plan(manifest_diff(old, new, key="doc_id")).split("\n") if "Exchange" in x]
    assert lines and not any("text" in x for x in lines)


def test_planners_do_not_join_back(spark, sf):
    text = plan(Q.chunk_plan_full(spark, sf))
    assert "Join" not in text and text.count("MapInArrow") == 1 and text.count("ArrowEvalPython") == 1


def test_plain_chapters_are_planned_without_python(spark):
    """Bodies that need no Python reach it as nulls, and both ways agree."""
    import random

    from strataforge.operators import stages, textplan

    rnd = random.Random(5)
    words = lambda n: " ".join(rnd.choices(["one", "two.", "three", "a|b", "vier", "\tx"], k=n))
    parts = [lambda: f"## {words(3)}", lambda: words(rnd.randrange(1, 260)), lambda: f"{words(9)}\n{words(5)}", lambda: "| a | b |\n| - | - |\n| c | d |", lambda: f"text before\n| a | {words(40)} |\ntext after\n# Head\nmore", lambda: " " * 3, lambda: f"   {words(30)}  "]
    odd = [lambda: "- item\n  more", lambda: "> quote", lambda: "```\n# no\n```", lambda: words(700), lambda: "a\u2028b", lambda: "x\ry", lambda: "\u00a0x\u3000"]
    bodies = ["", "\n\n", "one", "# h", "# h\n## i"] + ["\n\n".join(rnd.choice(parts if k % 3 else [*parts, *odd])() for _ in range(rnd.randrange(1, 25))) for k in range(150)]
    df = spark.createDataFrame([(f"d{i}", 1, b) for i, b in enumerate(bodies)], "document_id string, chapter int, body string")
    df = df.selectExpr("*", "'s' AS source_id", "'d' AS domain", "'t' AS topic", "'f' AS source_file", "'f' AS file_name", "'x' AS title", "'' AS created_at", "'' AS updated_at", "1 AS word_count", "'' AS preamble")
    for rules in (textplan.Rules(), textplan.Rules(target=20, maximum=30), textplan.Rules(keep_headings=False), textplan.Rules(parity=True)):
        got = {}
        for r in stages.plan_chunks(df, rules).orderBy("document_id", "sequence").collect():
            got.setdefault(r.document_id, []).append((r.content, r.lineage.paragraph_start, r.lineage.paragraph_end, r.token_count))
        want = {f"d{i}": [(c.content, c.start, c.end, c.tokens) for c in textplan.plan_chunks(b, rules)] for i, b in enumerate(bodies)}
        assert got == {k: v for k, v in want.items() if v}
    blocks = df.select(stages.F.when(~stages.F.col("body").rlike(stages.NOT_PLAIN), stages.plain_blocks(stages.F.col("body"))).alias("b"))
    assert blocks.filter("b is not null").count() > 100


def test_ids_are_found_anywhere_by_an_equi_join(spark):
    pages = spark.createDataFrame([("see (evidence_12), a\nb",), (None,), ("",), ("x" * 5000 + "needle" + "y" * 5000,)], "page string")
    ids = ["evidence_1", "evidence_12", "evidence_123", "dence", "e", "z", "", " ", "a\nb", "needle", "needles", "x" * 1200, "x" * 5001, "👧"]
    got = audit.contained(spark.createDataFrame([(i,) for i in ids + ids], "id string"), pages)
    whole = "\n".join(r.page or "" for r in pages.collect())
    assert sorted(r.id for r in got.collect()) == sorted(i for i in ids if i and i in whole)
    assert "NestedLoop" not in plan(got) and "Cartesian" not in plan(got)
    ev = spark.createDataFrame([("evidence_1", "", None, "d", " "), ("q", "", "", "", "")], "evidence_id string, chunk_id string, chapter_id string, document_id string, source_id string")
    first, second = sorted(audit.integration(ev, pages).collect())
    assert first.integrated and first.layer10 and not (first.layer20 or first.layer30) and first.source_key == "d"
    assert not second.integrated and second.source_key == "q"
    assert audit.contained(ids_none(spark), pages).count() == 0


def ids_none(spark):
    return spark.createDataFrame([("",)], "id string")


def test_links_are_resolved_from_their_folder(spark):
    links = spark.createDataFrame([(t, i, x, "internal") for t in ("a/b/p.md",) for i, x in enumerate(("../q.md", "../q", "r", "/a/q.md#z", "?x=1", "s.txt", "q.v2", "%C3%BC"))], "topic string, pos int, link string, kind string")
    files = spark.createDataFrame([("a/q.md",), ("a/b/r.md",), ("a/b/q.v2.md",), ("a/b/ü.md",)], "name string")
    broken = audit.broken_links(links, files, audit.F.regexp_extract("topic", "^(.*)/[^/]*$", 1))
    assert sorted(r.link for r in broken.collect()) == ["?x=1", "q.v2", "s.txt"]


def test_lineage_takes_one_join_and_skips_empty_ids(spark):
    ev = spark.createDataFrame([("e1", "", None, "", " "), ("e2", "c", "1", "d", "s"), ("e3", "x", "02", "y", "z")], "evidence_id string, chunk_id string, chapter_id string, document_id string, source_id string")
    chunks, chapters = spark.createDataFrame([("c",)], "chunk_id string"), spark.createDataFrame([(1,), (None,)], "chapter int")
    docs = spark.createDataFrame([("d", "s")], "document_id string, source_id string")
    out = audit.broken_lineage(ev, chunks, chapters, docs)
    assert sorted((r.evidence_id, r.layer, r.id, r.problem) for r in out.collect()) == [("e3", "10", "y", "document_missing"), ("e3", "10", "z", "source_missing"), ("e3", "20", "02", "chapter_missing"), ("e3", "30", "x", "chunk_missing")]
    assert _plan(out).count("Join LeftAnti") == 1


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_redirects_join_once_a_lookup(spark):
    from strataforge.operators import wikigraph

    pages = spark.createDataFrame([("A", True, "B"), ("B", True, "C"), ("C", False, None), ("X", True, "Y"), ("Y", True, "X"), ("G", True, "Gone")], "title string, is_redirect boolean, redirect_target string")
    titles = spark.createDataFrame([(t,) for t in ("A", "C", "X", "G", "No", "A")], "title string")
    out = wikigraph.resolve_redirects(titles, pages)
    assert sorted((r.title, r.canonical) for r in out.collect()) == sorted([("A", "C"), ("A", "C"), ("C", "C"), ("X", None), ("G", None), ("No", None)], key=str)
    assert _plan(out).count("Join LeftOuter") <= wikigraph.LOOKUPS + 1


def test_names_are_found_without_moving_contents(spark):
    from strataforge.operators import stages

    raw = spark.createDataFrame([("s/a.md", b"x"), ("s/a.txt", b"y"), ("s/b.md", b"z"), ("t/a.md", b"w")], "rel_path string, content binary")
    out = stages.document_names(raw)
    assert sorted(r.document_id for r in out.collect()) == ["s_a_md", "s_a_txt", "s_b", "t_a"]
    assert "Window" not in _plan(out)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not any("Exchange" in line and "content" in line for line in plan.split("\n"))
