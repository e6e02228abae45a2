"""Operator 2: pages with known articles."""

import html
import re

from larder.llm import html_text

PAGES = "page_id long, url string, html string, host string, text string, dropped string"
SF = "/root/testdata/sf0.001"


def texts(spark, pages):
    df = spark.createDataFrame([(*p, "h", "t", "d") for p in pages], PAGES)
    return {r.page_id: r.text for r in html_text.extract(df).collect()}


def article(source):
    inner = re.search(r"<article>(.*?)</article>", source, re.S).group(1)
    inner = re.sub(r"</?b>", "", re.sub(r"</?(p|h\d|br)>", "\x00", inner))
    lines = (re.sub(r"\s+", " ", html.unescape(x)).strip() for x in inner.split("\x00"))
    return "\n".join(x for x in lines if x)


def test_articles_of_the_table(spark):
    df = spark.read.parquet(f"{SF}/pages.parquet")
    source = {r.page_id: r for r in df.collect()}
    got = html_text.extract(df).collect()
    assert len(got) == len(source)
    for r in got:
        assert r.text == article(source[r.page_id].html) and r.n_chars == len(r.text) and r.url == source[r.page_id].url


def test_template_of_a_host_without_article_elements(spark):
    def page(i):
        return (f"<html><head><title>T{i}</title></head><body><div class=top><a href=/>Home</a> <a href=/a>About us</a></div>"
                f"<div id=x><span>Daily Gazette, since 1901</span><h1>Story {i}</h1><p>Body of {i}, part one.</p>"
                f"{'<p>More on ' + str(i) + '.</p>' if i % 2 else ''}</div>"
                f"<div class=box>Call us at 555</div></body></html>")

    got = texts(spark, [(i, "http://news.example/" + str(i), page(i)) for i in range(8)])
    for i in range(8):
        assert got[i] == f"Story {i}\nBody of {i}, part one." + (f"\nMore on {i}." if i % 2 else "")


def test_a_repeated_block_inside_articles_is_template(spark):
    def page(i):
        box = "<div class=x1><p>Read our other stories.</p></div>" if i % 5 else ""
        return (f"<html><body><article><h1>Story {i}</h1><p>Body of {i}.</p><p>Was this clear?</p>{box}"
                f"<p>End of {i}.</p></article></body></html>")

    got = texts(spark, [(i, f"http://unmarked.example/{i}", page(i)) for i in range(10)])
    assert got == {i: f"Story {i}\nBody of {i}.\nEnd of {i}." for i in range(10)}


def test_classes_are_nested(spark):
    """The optional box's tags and text are one class, inside that of all pages."""
    pages = [(i, "http://n/", f"<body><div class=a>{i}</div>" + "<div class=b><p>x</p></div>" * (i % 3 > 0) + "</body>") for i in range(9)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {(r.kind, r.token): r for r in html_text.deduce_templates(df).collect()}
    body, box, p = (got[1, html_text._signed(html_text._key("tag", x))] for x in ("/body", "/body/div.b", "/body/div.b/p"))
    text = got[2, html_text._signed(html_text._key("text", "/body/div.b/p", "x"))]
    assert box["class"] == p["class"] == text["class"] and box.valid and box.outer == body["class"] and body.outer is None
    assert text.dropped


def test_elements_of_other_purpose_and_markup():
    page = """<!doctype html><html><head><title>no</title><style>p{}</style></head><body>
    <header>Site name</header><nav>Menu</nav><div class="cookie-notice"><p>We use cookies</p></div>
    <main><article class="post"><header><h1>A &amp; B</h1></header>
    <p>One <b>bo</b>ld&nbsp;&#8212;   two
    lines<p>Next<script>var x = "<p>no</p>";</script> one<br>broken</p><ul><li>a<li>b</ul>
    <!-- <p>no</p> --><aside>Related</aside><div class="ad-slot">Buy</div><form><input value="x">Mail <button>Go</button></form>
    <table><tr><td>1<td>2</tr></table><pre> x   y </pre></article>
    <section id="comments"><p>Nice post</p></section></main><footer>&copy; me</footer></body></html>"""
    assert html_text.main_text(page) == "A & B\nOne bold — two lines\nNext one\nbroken\na\nb\n1\n2\nx y"


def test_odd_pages(spark):
    pages = [(1, "http://a/", None), (2, None, ""), (3, "no host", "just text"), (4, "http://a/", "<p>cut <b>sho"), (None, "http://a/", "<p>x &lt; y &am"),
             (5, "http://b/", "a < b and <c"), (6, "http://c/", "<article><p>é</article>"), (6, "http://c/", "<article><p>é</article>"),
             (7, "http://d/", "<div>" * 3000 + "deep" + "</div>" * 3000), (8, "http://e/", "<p>" + "w " * 100_000),
             (9, "http://f/", "</p></div></article>end"), (10, "http://f/", "<a title='x>y'>link</a> tail")]
    got = texts(spark, pages)
    assert got == {1: "", 2: "", 3: "just text", 4: "cut sho", None: "x < y &am", 5: "a < b and", 6: "é", 7: "deep",
                   8: ("w " * 100_000).strip(), 9: "end", 10: "link tail"}
    assert texts(spark, []) == {}


def test_identical_pages_keep_their_text(spark):
    got = texts(spark, [(i, "http://same/", "<body><div>Only text</div></body>") for i in range(6)])
    assert set(got.values()) == {"Only text"}


def test_a_page_of_nothing_but_template_is_empty(spark):
    def page(i):
        body = f"<p>Body of {i}.</p>" if i else ""
        return f"<body><div class=t><a href=/>Home</a> <a href=/a>About us</a></div><div class=u>Since 1901</div>{body}</body>"

    got = texts(spark, [(i, f"http://front.example/{i}", page(i)) for i in range(10)])
    assert got == {0: ""} | {i: f"Body of {i}." for i in range(1, 10)}


def test_vectors_tell_classes_apart(spark):
    pages = [(i, "http://v/", "<body><div class=a></div><div class=b></div>" + "<p>x</p>" * (i % 3) + "</body>") for i in range(9)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {(r.kind, r.token): r for r in html_text.deduce_templates(df).collect()}
    tag = {label: got[1, html_text._signed(html_text._key("tag", f"/body{label}"))] for label in ("", "/div.a", "/div.b", "/p")}
    assert tag[""]["class"] == tag["/div.a"]["class"] == tag["/div.b"]["class"] != tag["/p"]["class"]
    assert tag[""].class_size == 3 and tag["/p"].pages == 6 and tag[""].host_pages == 9


def test_states_and_heads_do_not_hide_the_article():
    page = """<body class="no-sidebar menu-open"><header class=site-header>S</header><main class="content has-sidebar"><p>teaser</p>
    <article class="post with-comments"><div class="article-header"><h1>Title</h1></div><p>Text</p>
    <div class=legal>small print</div></article><article class=comment><p>me too</p></article></main></body>"""
    assert html_text.main_text(page) == "Title\nText"
    assert html_text.main_text("<main><header><h1>T</h1></header><p>x</p></main><p>y</p>") == "T\nx"
    assert html_text.main_text("<div class=header><p>S</p></div><div role=main><p>x</p></div>") == "x"


def test_the_template_alone_finds_the_articles_of_the_table(spark):
    """No tag, class or article element is consulted; every host of this table
    has the pages that a template takes."""
    df = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    source = {r.page_id: r for r in df.select("page_id", "html", html_text._host("url").alias("host")).collect()}
    pages = {}
    for r in source.values():
        pages[r.host] = pages.get(r.host, 0) + 1
    got = html_text.extract(df, markup=False).collect()
    judged = [r for r in got if pages[source[r.page_id].host] >= html_text.LEAST_PAGES]
    right = sum(r.text == article(source[r.page_id].html) for r in judged)
    assert len(judged) >= 100 and right == len(judged), (right, len(judged))


def test_slots_of_unmarked_layouts(spark):
    """Menu, varying teasers and reader's notes around a plain container; a page
    with an article element elsewhere still gives the host's slot."""
    def page(i):
        extra = f"<div class=qe><article>Teaser {i}</article></div>" if i == 3 else ""
        return (f"<body><div class=qa><a href=/>Home</a> <a href=/{i}>Number {i} of today</a></div>{extra}<div class=qb>"
                f"<div class=qc><h2>Story {i}</h2><p>It was day {i}, and long.</p><p>So it went on, {i} times.</p></div></div>"
                f"<div class=qd><a href=/{i}/x>More of {i}</a> Note {i}</div></body>")

    rows = [(i, f"http://plain.example/{i}", page(i)) for i in range(12)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    want = {i: f"Story {i}\nIt was day {i}, and long.\nSo it went on, {i} times." for i in range(12)}
    assert {r.page_id: r.text for r in html_text.extract(df, markup=False).collect()} == want
    got = {r.page_id: r.text for r in html_text.extract(df).collect()}
    assert got == want


def test_few_pages_use_the_markup(spark):
    html = "<body><p>Top</p><article><p>Text {0}</p></article></body>"
    got = texts(spark, [(i, "http://two.example/", html.format(i)) for i in range(2)])
    assert got == {0: "Text 0", 1: "Text 1"}
