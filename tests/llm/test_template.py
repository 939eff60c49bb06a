"""Main text of pages: by hand, against the plain article of the test pages, and host templates."""

from __future__ import annotations

import html
import re

from riskloom.llm.template import deduce, extract, main_text, occurrences, parse

SF = "/root/testdata/sf0.01"


def test_page_by_hand():
    page = """<!doctype html><html><head><title>T</title><style>p{}</style></head><body class="post"><header>Site</header>
    <nav><ul><li><a href="/">Home</a><li><a>More</a></ul></nav><div class="cookie-notice">We use cookies</div>
    <main><h1>A &amp; B</h1><p>One<b>two</b>
      three<p>four&nbsp;five<br>six<div class='ad-box'>buy</div><script>var a = "<p>no</p>";</script><!-- <p>no --> <ul><li>x<li>y</ul>
    <table><tr><td>1<td>2</table><form><p>name</p></form><div hidden>h</div><div style="display: none">h</div></main>
    <aside>s</aside><section id="comments"><p>great</p></section><footer>&copy;</footer></body></html>"""
    assert extract(page, {}) == "A & B Onetwo three four five six x y 1 2"
    assert extract("", {}) == "" and extract("just text &lt;", {}) == "just text <" and extract("<p>a<p", {}) == "a"
    assert extract("<div><p>a</p><a title='x>y' href=\"b>c\">link</a></div>", {}) == "a link"
    assert extract("<p>" * 3000 + "deep", {}) == "deep" and extract("<div>" * 3000 + "deep", {}) == "deep"
    assert extract("1 < 2 <3 </> <!x> a", {}) == "1 < 2 <3 a"


def test_pages_of_the_test_data(spark):
    """The article element, cut out by patterns, is what these pages hold."""
    got = {r.page_id: r for r in main_text(spark.read.parquet(f"{SF}/pages.parquet")).collect()}
    rows = spark.read.parquet(f"{SF}/pages.parquet").collect()
    assert len(got) == len(rows)
    for r in rows:
        article = re.search(r"<article>(.*?)(?:</article>|<footer|$)", r.html, re.S)[1]
        want = " ".join(html.unescape(re.sub(r"</?b>", "", re.sub(r"<(?!/?b>)[^>]*>", " ", article))).split())
        assert got[r.page_id].text == want and got[r.page_id].n_chars == len(want) and got[r.page_id].url == r.url


def _pages(n, links=6):
    return [
        f"<body><div class=x><div class=m>{''.join(f'<a>menu {i} entry</a>' for i in range(links))}</div><div class=t><p>Text {i} of page.<p>And more words.</div></div></body>"
        for i in range(n)
    ]


def test_template_finds_menus_without_names(spark):
    rows = [(i, f"http://Host.example/{i}", p, "x", 1) for i, p in enumerate(_pages(5))]
    rows += [(10, "http://user@other.example:80/", _pages(1)[0], "x", 1), (11, None, None, "x", 1), (12, "no url", "<p>a", "x", 1), (None, None, "<p>b", "x", 1), (0, "http://host.example/", _pages(1)[0], "x", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string, n int").repartition(3)
    got = sorted((str(r.page_id), r.text) for r in main_text(pages).collect())
    want = [(str(i), f"Text {i} of page. And more words.") for i in range(5)] + [("0", "Text 0 of page. And more words.")]
    menu = "".join(f"menu {i} entry" for i in range(6))
    want += [("10", f"{menu} Text 0 of page. And more words."), ("11", ""), ("12", "a"), ("None", "b")]
    assert got == sorted(want)
    assert main_text(pages.limit(0)).count() == 0


def test_classes_nest():
    tokens = []
    for path, vector, chars, links in (("/body", (4, 4, 1, 1), 0, 0), ("/body/div", (4, 4, 1, 1), 10, 0), ("/body/ul/li", (4, 9, 2, 2), 50, 50), ("/body/ul", (4, 4, 1, 1), 0, 0), ("/body/x/y", (3, 3, 3, 3), 5, 0), ("/body/z", (1, 1, 4, 4), 5, 0)):
        tokens.append((path, *vector, chars, links))
    assert deduce(4, tokens) == {"": False, "/body": False, "/body/div": False, "/body/ul": False, "/body/ul/li": True}
    assert deduce(1, tokens) == {}
    assert occurrences("<div class='b a'>x<a>y z</a></div>") == {"/div.a.b": [1, 1, 0], "/div.a.b/a": [1, 2, 2]}
    assert [k for k, *_ in parse("<br>")] == ["break", "open"]
