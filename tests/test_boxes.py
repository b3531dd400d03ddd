"""Tables from word boxes, and upserts on streams."""

import pytest

from strataforge.operators import boxes
from strataforge.streaming import upsert

WORDS = "page int, x0 double, x1 double, y0 double, y1 double, text string"


def words(spark, rows):
    return spark.createDataFrame([tuple(float(v) if 0 < i < 5 and v is not None else v for i, v in enumerate(r)) for r in rows], WORDS)


def test_cells_and_lines(spark):
    rows = [(1, 0, 20, 0, 10, "two"), (1, 24, 50, 1, 11, "words"), (1, 80, 90, 0, 10, "b"), (1, 0, 30, 14, 24, "next"), (1, 5, 5, 0, 10, "flat"), (1, 5, 9, 0, None, "unknown"), (2, 0, 10, 0, 10, "other")]
    got = sorted((r.page, r.line, r.cell, r.text) for r in boxes.cells(words(spark, rows), ["page"]).collect())
    assert got == [(1, 1, 1, "two words"), (1, 1, 2, "b"), (1, 2, 1, "next"), (2, 1, 1, "other")]


def test_tables_with_gaps_and_text_between(spark):
    line = lambda page, y, cells: [(page, x, x + 6 * len(t), y, y + 10, t) for x, t in cells]
    rows = line(1, 0, [(0, "Title of the page")]) + line(1, 20, [(0, "name"), (100, "size"), (200, "price")]) + line(1, 34, [(0, "a|b"), (204, "1")]) + line(1, 48, [(3, "c"), (103, "2"), (210, "3")])
    rows += line(1, 70, [(0, "text between")]) + line(1, 90, [(0, "x"), (300, "y")]) + line(1, 104, [(0, "z"), (300, "w")]) + line(1, 130, [(0, "alone"), (300, "once")]) + line(1, 160, [(0, "end")]) + line(1, 190, [(0, "one"), (90, "row")])
    got = {(r.table, r.row): r.cells for r in boxes.tables(words(spark, rows), ["page"]).collect()}
    assert got == {(1, 1): ["name", "size", "price"], (1, 2): ["a|b", "", "1"], (1, 3): ["c", "2", "3"], (2, 1): ["x", "y"], (2, 2): ["z", "w"], (2, 3): ["alone", "once"]}
    marked = {r.table: r.markdown for r in boxes.markdown_tables(boxes.tables(words(spark, rows), ["page"]), ["page"]).collect()}
    assert marked[1] == "| name | size | price |\n| --- | --- | --- |\n| a\\|b |  | 1 |\n| c | 2 | 3 |"
    assert boxes.tables(words(spark, rows).limit(0), ["page"]).count() == 0


def test_stream_upsert_keeps_the_better_row(spark, tmp_path):
    batches = [
        [(1, 1, 5.0, "a", "x"), (2, 2, None, "n", None), (1, 3, 5.0, "same", "y")],
        [(1, 4, 4.0, "worse", "z"), (2, 5, 1.0, None, "w"), (3, 6, 2.0, "c", None)],
        [(1, 7, 9.0, None, "better"), (3, 8, 3.0, "d", None), (2, 9, 0.5, "late", "late")],
    ]
    schema = "k int, at int, score double, name string, note string"
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    got = {r.k: tuple(r)[1:] for r in upsert.streamed_upsert(stream, "k", "score", ["at"]).collect()}
    assert got == {1: (7, 9.0, "a", "better"), 2: (5, 1.0, "n", "w"), 3: (8, 3.0, "d", None)}


def test_idle_keys_are_forgotten():
    """The timer is moved with every better row, and clears what is known when it rings."""
    import pandas as pd
    from pyspark.sql import types as T

    class Value:
        now = None
        def exists(self): return self.now is not None  # noqa: E704
        def get(self): return self.now  # noqa: E704
        def update(self, row): self.now = row  # noqa: E704
        def clear(self): self.now = None  # noqa: E704

    class Handle:
        timers: list[int] = []
        def getValueState(self, name, schema): return Value()  # noqa: E704
        def listTimers(self): return iter(self.timers)  # noqa: E704
        def deleteTimer(self, at): self.timers.remove(at)  # noqa: E704
        def registerTimer(self, at): self.timers.append(at)  # noqa: E704

    class Clock:
        def __init__(self, now): self.now = now  # noqa: E704
        def getCurrentProcessingTimeInMs(self): return self.now  # noqa: E704

    kept = T.StructType.fromDDL("at int, score double")
    better, handle = upsert.Better(kept, "k", "score", ["at"], 100), Handle()
    better.init(handle)
    frame = lambda *rows: iter([pd.DataFrame(rows, columns=["k", "at", "score"])])
    assert [f.values.tolist() for f in better.handleInputRows((1,), frame((1, 2, 3.0), (1, 1, 2.0)), Clock(0))] == [[[1, 2, 3.0]]] and handle.timers == [100]
    assert list(better.handleInputRows((1,), frame((1, 3, 3.0)), Clock(50))) == [] and handle.timers == [100]
    assert len(list(better.handleInputRows((1,), frame((1, 4, 4.0)), Clock(60)))) == 1 and handle.timers == [160]
    list(better.handleExpiredTimer((1,), Clock(160), None))
    assert len(list(better.handleInputRows((1,), frame((1, 5, 0.5)), Clock(200)))) == 1


def test_heading_sizes_equal_the_converter(spark):
    import random

    from strataforge.sources.convert import heading_sizes

    rnd = random.Random(6)
    docs = {k: [(rnd.choice([9.0, 10.0, 10.4, 11.0, 14.0, 18.0, 24.0][: 1 + k % 7]), False, "x" * rnd.randrange(1, 40)) for _ in range(rnd.randrange(1, 30))] for k in range(40)}
    lines = spark.createDataFrame([(k, s, len(t)) for k, spans in docs.items() for s, _, t in spans], "doc int, size double, weight int")
    got = {r.doc: (r.body, r.headings) for r in boxes.heading_sizes(lines, ["doc"]).collect()}
    assert got == {k: heading_sizes(spans) for k, spans in docs.items()}


def test_pages_are_written_row_by_row(spark, tmp_path):
    from strataforge.operators import stages

    ev = spark.createDataFrame([("t", f"e{i}", f"c{i}", "d", "ch01", 3, f"text {i}") for i in range(20)] + [("u", "e", "c", "d", "ch01", 1, " x ")], "topic string, evidence_id string, chunk_id string, document_id string, chapter_id string, token_count int, content_preview string")
    stages.write_pages(ev, "dom", str(tmp_path / "wiki"))
    whole = {r.topic: r.page for r in stages.wiki_pages(ev, "dom").collect()}
    for topic in "tu":
        found = list((tmp_path / "wiki" / f"topic={topic}").glob("*.txt"))
        assert len(found) == 1 and found[0].read_text() == whole[topic] + "\n"
    assert "collect_list" not in stages.page_lines(ev, "dom")._jdf.queryExecution().optimizedPlan().toString()


def test_pdf_names_and_downloads(spark):
    from strataforge.functions import papers as P

    cases = {
        ("Deep Work (Jane Doe, Max Roe, Ada Poe) (2016) (z-lib.org)", None, None): "Deep Work - Doe, Roe et al. (2016)",
        ("scan 1999", "A title (libgen)", "Ann Lee; Bo Chi etc."): "A title - Lee, Chi (1999)",
        ("A title (Ann Lee) 1850-1999", "", "Someone Else"): "A title 1850-1999 - Else (1850)",
        ("name_only", "", ""): "name_only",
        ("(sci-hub)", None, "X"): "(sci-hub) - X",
        ('a<b>:c "d"', None, None): "a_b_c _d",
        ("word " * 40, None, None): "word " * 23 + "word",
    }
    df = spark.createDataFrame([(*k, i) for i, k in enumerate(cases)], "stem string, title string, author string, i int")
    got = {r.i: r.n for r in df.select("i", P.pdf_name(P.F.col("stem"), P.F.col("title"), P.F.col("author")).alias("n")).collect()}
    assert [got[i] for i in range(len(cases))] == list(cases.values())
    row = spark.range(1).select(P.download_urls(P.F.lit(""), P.F.lit("f"), P.F.lit("10/x")).alias("u"), P.download_path(P.F.lit(None).cast("string"), P.F.lit(2020), P.F.lit("PMC-1"), P.F.lit("A b!"), P.F.lit(".pdf")).alias("p")).first()
    assert row.u == ["f", "https://doi.org/10/x"] and row.p == "unknown/2020_PMC1_A_b.pdf"


@pytest.mark.parametrize("parts", [1, 7])
def test_box_tables_do_not_depend_on_partitions(spark, sf, parts):
    from strataforge import queries as Q

    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        assert Q.box_tables(spark, sf).agg({"table": "max"}).first()[0] == 2
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
