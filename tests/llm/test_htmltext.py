import re
from html import unescape

from strataforge.llm import htmltext
from strataforge.llm.htmltext import densities, main_text, page_texts, Page, _set_aside

SIMPLE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href="/a">Menu</a></li></ul></nav>
<!-- ad --><div class="ad">Buy this now, it is very cheap.</div><article><h1>Head&amp;line</h1><p><b>First   words.<br><p>Second
paragraph with <i>some</i> text &copy; and more of it.</p><p>Be.</p></article><footer>&copy; nobody</footer></body></html>"""


def test_supplied_kind_of_page():
    assert main_text(SIMPLE) == "Head&line\nFirst words.\nSecond paragraph with some text © and more of it.\nBe."


def brute(html):
    """For the supplied pages: what stands in <article>, split at the tags of blocks."""
    inside = re.search(r"<article>(.*?)</article>", html, re.S)[1]
    blocks = re.split(r"</?(?:h1|p)>", inside)
    return "\n".join(x for b in blocks if (x := " ".join(unescape(re.sub(r"<[^>]*>", " ", b)).split())))


def test_all_supplied_pages_against_brute_force(spark, sf):
    rows = spark.read.parquet(f"{sf}/pages.parquet")
    html = {r.page_id: r.html for r in rows.collect()}
    got = page_texts(rows).collect()
    assert page_texts(rows).columns == ["page_id", "url", "text", "n_chars"]
    assert len(got) == len(html)
    for r in got:
        assert r.text == brute(html[r.page_id])
        assert r.n_chars == len(r.text)


WORDS = "A long enough sentence of the article that goes on for some time, with a second clause. "
PLAIN = f"""<body><div id=top><a href=x>Home</a> <a href=y>News</a> <a href=z>About us</a></div><div><div><h1>Title</h1><p>{WORDS * 3}</p><p>{WORDS * 2}</p><p>Short.</p>
<ul><li>one<li>two</ul><table><tr><td>a<td>b</tr></table></div></div><div><a href=1>Other story one</a><a href=2>Other story two</a></div><div class="comments"><p>{WORDS * 5}</p></div>
<form><p>{WORDS * 4}</p></form><aside>{WORDS}</aside><div class="cookie-notice">{WORDS}</div><div role="complementary">{WORDS}</div></body>"""


def test_density_finds_an_article_that_does_not_name_itself():
    want = ["Title", (WORDS * 3).strip(), (WORDS * 2).strip(), "Short.", "one", "two", "a b"]
    assert main_text(PLAIN).split("\n") == want


def test_links_have_no_density():
    page = Page("<body><div><a href=x>some link text</a><a href=y>some more</a></div><div>some plain text</div></body>")
    own, _, links = densities(page, _set_aside(page)[0])
    assert sum(links) == 5  # the links, their div, the body and the root
    first, second = (i for i, t in enumerate(page.tag) if t == "div")
    assert own[first] < own[second] / 10


def test_sections_of_equal_density_belong_together():
    html = "<body><div><section><p>{0}</p><p>{0}</p><p>{0}</p></section><section><p>{0}</p><p>{0}</p></section></div><div><a>x</a></div></body>".format(WORDS)
    assert main_text(html).count(WORDS.strip()) == 5


def test_odd_pages():
    assert main_text(None) == main_text("") == main_text("<nav>x</nav>") == main_text("<script>x") == main_text("<!-- open") == ""
    assert main_text("just text, a < b &lt; c") == "just text, a < b < c"
    assert main_text('<p title="a > b">x</p>') == "x"
    assert main_text("<p>x</div></b></p>y") == "x\ny"
    assert main_text("<article>" + "<div>" * 30000 + "deep" + "</i>" * 1000) == "deep"
    assert main_text("<article><p>a&nbsp;&#8195; b</p>\r\n<pre>c\n\n d</pre></article>") == "a b\nc d"
    assert len(main_text("<article><p>" + "word " * 300000 + "</p></article>")) == 300000 * 5 - 1
    assert main_text("<article><header><h1>T</h1></header><p>x</p><footer>by</footer><div class='comments'>c</div></article>") == "T\nx"


def test_edge_cases(spark):
    pages = spark.createDataFrame([(1, "u", None, 1), (1, "u", None, 1), (None, None, "<p>x</p>", 2)], "page_id long, url string, html string, TEXT int")
    assert sorted((r.text, r.n_chars) for r in page_texts(pages).collect()) == [("", 0), ("", 0), ("x", 1)]
    assert page_texts(pages.limit(0)).count() == 0


LINKS = "".join(f'<li><a href="/{i}">Another story with a long headline of its own, number {i}</a></li>' for i in range(30))
UNNAMED = [
    # a long link list beside a shorter article
    (f"<body><div><ul>{LINKS}</ul></div><div><h1>Title</h1><p>{WORDS * 2}</p><p>{WORDS}</p></div></body>", ["Title", (WORDS * 2).strip(), WORDS.strip()]),
    # a link list between paragraphs
    (f"<body><div id=x><p>{WORDS * 2}</p><ul>{LINKS}</ul><p>{WORDS * 3}</p></div></body>", [(WORDS * 2).strip(), (WORDS * 3).strip()]),
    # layout tables
    (f"<body><table><tr><td><a href=a>One</a><br><a href=b>Two</a><td><p>{WORDS * 3}</p><p>{WORDS}</p><td><a href=c>Three</a></table></body>", [(WORDS * 3).strip(), WORDS.strip()]),
]


def test_density_decides_on_pages_without_article(monkeypatch):
    for html, want in UNNAMED:
        assert main_text(html).split("\n") == want
    real = densities

    def flat(page, aside):
        own, sums, links = real(page, aside)
        return [float(x > 0) for x in own], [float(x > 0) for x in sums], links

    monkeypatch.setattr(htmltext, "densities", flat)
    assert all(main_text(html).split("\n") != want for html, want in UNNAMED)


def test_density_decides_inside_an_article(monkeypatch):
    html = f'<body><article><h1>T</h1><p>{WORDS}</p><div class="more"><ul>{LINKS}</ul></div><div class="share"><a href=x>Tweet</a> this</div><p>With <a href=y>a link</a> inside.</p></article></body>'
    want = ["T", WORDS.strip(), "With a link inside."]
    assert main_text(html).split("\n") == want
    monkeypatch.setattr(htmltext, "densities", lambda page, aside: ([1.0] * len(page.tag), [1.0] * len(page.tag), [True] * len(page.tag)))
    assert main_text(html).split("\n") != want


def test_dense_parts_stay_whatever_they_are_called():
    html = f'<article><h1>T</h1><p class="notice-period">{WORDS}</p><label>Label.</label><section class="social history"><p>{WORDS * 2}</p></section><div id="reply-effect">{WORDS * 3}</div><div class="comments-area"><p>{WORDS * 4}</p></div></article>'
    assert main_text(html).split("\n") == ["T", WORDS.strip(), "Label.", (WORDS * 2).strip(), (WORDS * 3).strip()]


REFERENCES = '<ul><li><a href="/1">Doe: On sleep</a></li><li><a href="/2">Roe: On age</a></li></ul>'
INSIDE = {
    '<h2 id="copyright">Copyright law</h2>': ["Copyright law"],
    f'<section id="navigation"><h2>Navigation at sea</h2><p>{WORDS * 3}</p></section>': ["Navigation at sea", (WORDS * 3).strip()],
    '<p>See <a href=x>the first study</a> and <a href=y>the second study</a>.</p>': ["See the first study and the second study."],
    REFERENCES: ["Doe: On sleep", "Roe: On age"],
    '<p><a href="/whole">The whole text of the study is here</a></p>': ["The whole text of the study is here"],
    '<h3 class="related">Related work</h3>': ["Related work"],
    f'<div id="comments"><p>{WORDS * 4}</p></div>': [],
    f'<div class="related">{REFERENCES}</div>': [],
    f'<section class="navigation"><p>{WORDS * 3}</p></section>': [],
    '<div id="share-buttons"><a href=x>Tweet</a> <a href=y>Post</a></div>': [],
    f'<div class="more"><div>{REFERENCES}</div></div>': [],
}


def test_what_stands_between_two_paragraphs_of_an_article():
    for part, want in INSIDE.items():
        for tag in ("article", "main"):
            if tag == "main" and 'id="navigation"' in part:
                continue  # outside articles an id names a part of the page
            html = f"<body><nav>n</nav><{tag}><h1>Title</h1><p>{WORDS * 2}</p>{part}<p>{WORDS}</p></{tag}><footer>f</footer></body>"
            assert main_text(html).split("\n") == ["Title", (WORDS * 2).strip(), *want, WORDS.strip()], (tag, part)


def test_headers_and_several_articles():
    html = f"<body><header><h2>Site</h2></header><article><header><h2>The Title</h2></header><p>{WORDS}</p><header><h2>Not the first</h2></header><p>Be.</p></article></body>"
    assert main_text(html).split("\n") == ["The Title", WORDS.strip(), "Be."]
    teaser = '<article><a href=x><h3>Another story</h3></a><a href=y>Read it</a></article>'
    html = f"<body><article><h2>One</h2><p>{WORDS * 2}</p></article>{teaser}<div><article><h2>Two</h2><p>{WORDS * 2}</p></article></div><article class='comment'><p>{WORDS * 3}</p></article></body>"
    assert main_text(html).split("\n")[:2] == ["One", (WORDS * 2).strip()] and "Two" in main_text(html) and "Another" not in main_text(html)


def test_density_chooses_inside_articles(monkeypatch):
    """The cases above that density decides come out otherwise without it."""
    html = f'<body><article><h1>T</h1><p>{WORDS}</p><section id="navigation"><p>{WORDS * 3}</p></section><div id="share"><a href=x>Tweet</a></div></article></body>'
    want = ["T", WORDS.strip(), (WORDS * 3).strip()]
    assert main_text(html).split("\n") == want
    monkeypatch.setattr(htmltext, "densities", lambda page, aside: ([1.0] * len(page.tag), [1.0] * len(page.tag), [True] * len(page.tag)))
    assert main_text(html).split("\n") != want
