import io
import zipfile

import pytest

from strataforge.sources import convert as C


def body(data, name):
    text, error = C.markdown_of(data, name, name.rpartition(".")[2])
    assert error is None, error
    return text.partition("---\n\n")[2] if text.startswith("---") else text


def test_csv():
    assert body(b"a;b\n1;x\n2;y\n3;z\n", "t.csv") == "# t\n\n| a | b |\n| --- | --- |\n| 1 | x |\n| 2 | y |\n| 3 | z |\n"
    assert C.render_table([C.Block("tr", cells=["a|b", "c"]), C.Block("tr", cells=["d"])]) == "| a\\|b | c |\n| --- | --- |\n| d |  |"
    assert "No rows found." in body(b"", "t.csv")
    assert "| a | b |" in body('"a","b"\n"multi\nline",2'.encode(), "t.csv")


def test_text():
    got = body("Intro words that go on for a while and end with a stop, as text does.\nmore.\n\nCHAPTER 1\n\nA short heading\n- one\n2. two\n\nlower line.".encode(), "t.txt")
    assert got == "# Inhalt\n\nIntro words that go on for a while and end with a stop, as text does. more.\n\n# CHAPTER 1\n\n## A short heading\n\n- one\n\n2. two\n\nlower line.\n"


def test_markdown():
    assert body(b"# A\nx\n## B\ny\n# C\nz", "t.md") == "## Inhaltsverzeichnis\n\n1. [Inhalt](#inhalt)\n2. [A](#a)\n3. [C](#c)\n\n# Inhalt\n\n# A\n\nx\n\n## B\n\ny\n\n# C\n\nz\n"


HTML = """<html><head><title>T</title><meta name="author" content="Jo"><meta property="og:description" content="D"></head><body><nav>menu</nav><h1>Title</h1><p>One <b>bold</b> and <i>thin</i>.<p>Two
<ul><li>a<ul><li>b</li></ul></li><li>c</ul><ol><li>x<li>y</ol><table><tr><th>h<th>i<tr><td>1<td>2</table><pre>code
 here</pre><hr><blockquote>said</blockquote><h1>Next</h1>loose<br>text<script>no</script></body></html>"""


def test_html():
    text = C.markdown_of(HTML.encode(), "t.html", "html")[0]
    assert 'author: "Jo"' in text and "description: >\n  D" in text and "menu" not in text and "no\n" not in text
    want = ["# Title", "One **bold** and *thin* .", "Two", "- a", "  - b", "- c", "1. x", "2. y", "| h | i |\n| --- | --- |\n| 1 | 2 |", "```\ncode\n here\n```", "---", "> said", "# Next", "loose\n text"]
    assert body(HTML.encode(), "t.html").strip().split("\n\n") == want
    parity = C.html_blocks(next(C.Tree(HTML).root.all("body")), parity=True)
    assert not [b for b in parity if b.kind == "li"]


def test_xml():
    got = body(b'<r xmlns="u"><title>Head</title><s><p>text  here</p><list><item>a</item></list><table><row><cell>1</cell><cell>2</cell></row><row><cell>3</cell></row></table><odd>x</odd></s></r>', "my_file.xml")
    assert got.startswith("# my file\n\n### Head\n\ntext here\n\n- a\n\n| 1 | 2 |\n| --- | --- |\n| 3 |  |\n\n```xml\n")
    assert C.markdown_of(b'<!DOCTYPE r [<!ENTITY a "b">]><r>&a;</r>', "x.xml", "xml")[1].startswith("ValueError")


def archive(**parts):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, text in parts.items():
            z.writestr(name.replace("__", "/"), text)
    return out.getvalue()


W = 'xmlns:w="w"'


def test_docx():
    p = lambda text, style="", more="": f'<w:p><w:pPr>{f"<w:pStyle w:val={chr(34)}{style}{chr(34)}/>" if style else ""}{more}</w:pPr><w:r>{text}</w:r></w:p>'
    doc = f'<w:document {W}><w:body>{p("<w:t>One</w:t>", "H1")}{p("<w:rPr><w:b/></w:rPr><w:t>bold</w:t>")}{p("<w:t>item</w:t>", "", "<w:numPr><w:ilvl w:val=%s1%s/></w:numPr>" % (chr(34), chr(34)))}<w:tbl><w:tr><w:tc><w:p><w:r><w:t>a</w:t></w:r></w:p></w:tc><w:tc><w:p><w:r><w:t>b</w:t></w:r></w:p></w:tc></w:tr></w:tbl>{p("<w:t>Two</w:t>", "H1")}</w:body></w:document>'
    styles = f'<w:styles {W}><w:style w:styleId="H1"><w:name w:val="heading 1"/></w:style></w:styles>'
    data = archive(**{"word/document.xml": doc, "word/styles.xml": styles})
    assert body(data, "d.docx") == "# One\n\n**bold**\n\n  - item\n\n| a | b |\n| --- | --- |\n\n# Two\n"


def test_xlsx():
    book = '<workbook xmlns:r="r"><sheets><sheet name="S1" r:id="rId1"/></sheets></workbook>'
    rels = '<Relationships><Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>'
    sheet = '<worksheet><sheetData><row><c r="A1" t="s"><v>0</v></c><c r="C1"><v>5</v></c></row><row/><row><c r="B3" t="inlineStr"><is><t>x</t></is></c></row></sheetData></worksheet>'
    data = archive(**{"xl/workbook.xml": book, "xl/_rels/workbook.xml.rels": rels, "xl/worksheets/sheet1.xml": sheet, "xl/sharedStrings.xml": "<sst><si><t>head</t></si></sst>"})
    assert body(data, "b.xlsx") == "# S1\n\n| head |  | 5 |\n| --- | --- | --- |\n|  | x |  |\n"


def test_pptx():
    pres = '<p:presentation xmlns:p="p" xmlns:r="http://x/relationships"><p:sldIdLst><p:sldId id="256" r:id="rId2"/></p:sldIdLst></p:presentation>'
    slide = '<p:sld xmlns:p="p" xmlns:a="a"><p:sp><p:nvPr><p:ph type="title"/></p:nvPr><p:txBody><a:p><a:r><a:t>Hello</a:t></a:r></a:p></p:txBody></p:sp><p:sp><p:txBody><a:p><a:pPr lvl="1"/><a:r><a:t>point</a:t></a:r></a:p></p:txBody></p:sp></p:sld>'
    notes = '<p:notes xmlns:p="p" xmlns:a="a"><p:sp><p:ph type="body"/><p:txBody><a:p><a:r><a:t>say this</a:t></a:r></a:p></p:txBody></p:sp></p:notes>'
    data = archive(**{"ppt/presentation.xml": pres, "ppt/_rels/presentation.xml.rels": '<R><r Id="rId2" Target="slides/slide1.xml"/></R>', "ppt/slides/slide1.xml": slide, "ppt/slides/_rels/slide1.xml.rels": '<R><r Id="rId1" Target="../notesSlides/notesSlide1.xml"/></R>', "ppt/notesSlides/notesSlide1.xml": notes})
    assert body(data, "my_deck.pptx") == "# my deck\n\n## Slide 1: Hello\n  - point\n\n### Speaker Notes\n> say this\n"


def test_epub_and_odt():
    opf = '<package><metadata><title>Book</title></metadata><manifest><item id="a" href="a.xhtml" media-type="application/xhtml+xml"/></manifest><spine><itemref idref="a"/></spine></package>'
    data = archive(**{"META-INF/container.xml": '<c><rootfiles><rootfile full-path="OPS/p.opf"/></rootfiles></c>', "OPS/p.opf": opf, "OPS/a.xhtml": "<html><body><h1>Ch</h1><p>text</p></body></html>"})
    assert body(data, "b.epub") == "# Ch\n\ntext\n"
    odt = archive(**{"content.xml": '<d xmlns:t="t"><t:text><t:h t:outline-level="1">H</t:h><t:p>x</t:p><t:list><t:item><t:p>li</t:p></t:item></t:list></t:text></d>'})
    assert body(odt, "o.odt") == "# H\n\nx\n\n- li\n"


def test_pdf_layout_rules():
    spans = [(18.0, False, "Title"), (10.0, False, "body text that"), (10.0, False, "goes on."), (14.0, False, "Section"), (10.0, True, "Bold line"), (10.0, False, "- item")]
    assert [(b.kind, b.text) for b in C.sized_blocks(spans)] == [("h1", "Title"), ("p", "body text that goes on."), ("h2", "Section"), ("h4", "Bold line"), ("li", "item")]
    assert C.heading_sizes([(9.0, False, "x")]) == (9.0, [15.0, 12.0, 10.0])


@pytest.mark.parametrize(("data", "name"), [(b"junk", "x.docx"), (b"x", "x.mobi"), (b"x", "x.zzz"), (b"<a", "x.xml")])
def test_bad_files_are_rows_with_errors(data, name):
    text, error = C.markdown_of(data, name, name.rpartition(".")[2])
    assert text is None and error


def test_spark(spark):
    raw = spark.createDataFrame([("s/a.csv", "csv", b"a,b\n1,2"), ("s/b.docx", "docx", b"junk"), ("s/c.html", "html", None)], "rel_path string, ext string, content binary")
    got = {r.rel_path: r for r in C.to_markdown(raw).collect()}
    assert "| 1 | 2 |" in got["s/a.csv"].markdown and got["s/b.docx"].error and got["s/c.html"].markdown
    assert C.to_markdown(raw, {"zzz": lambda d, n: "own"}).columns == ["rel_path", "ext", "markdown", "error"]


def test_files_leave_python_before_a_batch_ends(spark):
    import pyarrow as pa

    class Caught:
        """A DataFrame whose Arrow pass is given back as a function."""

        columns, schema = ["rel_path", "ext", "content"], spark.createDataFrame([], "rel_path string, ext string, content binary").schema

        def mapInArrow(self, run, schema):
            return run

    seen = []

    def own(data, name):
        seen.append(name)
        return f"{name} {len(data)}"

    data = [b"x" * 10_000] * 1_000 + [None]
    names = [f"s/{i}.zzz" for i in range(len(data))]
    batch = pa.RecordBatch.from_arrays([pa.array(names), pa.array(["zzz"] * len(data)), pa.array(data)], Caught.columns)
    made = C.to_markdown(Caught(), {"zzz": own})(iter([batch]))
    parts = [next(made)]
    assert len(seen) < 200
    parts += made
    assert [tuple(r.values()) for p in parts for r in p.to_pylist()] == [(n, "zzz", f"{n[2:]} {len(d or b'')}", None) for n, d in zip(names, data)]
    assert "ArrowEvalPython" not in C.to_markdown(spark.createDataFrame([], Caught.schema))._jdf.queryExecution().toString()
