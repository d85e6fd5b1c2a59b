"""Main text extraction: noise, broken markup, host consensus."""

import html
import re

import pytest

from tierflow.llm import html_text, registry

NOISE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>"</p>"</script></head>
<body class="has-sidebar"><header>Site</header><nav><ul><li><a href="/a">Menu</a></li></ul></nav>
<div class="ad">Buy</div><div class="cookie-notice">Cookies</div><!-- gone --><article><h1>Head &amp; line</h1>
<p><b>First<br>part.</b><p>Second\n  part&nbsp;here <a href="x">link</a>.</p><ul><li>one</li><li>two</li></ul>
<div class="share-buttons">Share</div><aside>Aside</aside><form>Form<input></form></article>
<div class="sidebar">Side</div><section id="comments"><p>Nice article, thanks a lot!</p></section>
<footer>&copy; foot</footer></body></html>"""


def text_of(source):
    page = html_text.read_page(source)
    return page.text(page.best()[0])


def test_noise_goes_and_blocks_stay_in_order():
    assert text_of(NOISE) == "Head & line\nFirst part.\nSecond part here link.\none\ntwo"


@pytest.mark.parametrize("source, text", [
    ("", ""), ("<p>", ""), ("plain text", "plain text"), ("<p>a<p>b", "a\nb"),
    ("a < b & c > d", "a < b & c > d"), ("<p>a</b>b</p></div>c", "ab\nc"),
    ("<div><p>x &lt;b&gt; &#233;&eacute;</p>", "x <b> éé"), ("<p>a<!-- b", "a"),
    ("<script>x", ""), ("<p title='a>b'>c</p>", "c"), ('<p title="a>c</p>', "c"),
    ("<article><p>a</p><div class='comment'>no</div><p>b</p></article>", "a\nb"),
    ("<div hidden>no</div><p>yes</p>", "yes"),
])
def test_odd_markup(source, text):
    assert text_of(source) == text


LONG, SHORT = "word " * 399 + "word", "Lead " * 7 + "Lead"


@pytest.mark.parametrize("source, text", [
    (f"<article><h1>{SHORT}</h1><div class='entry-content'>{LONG}</div></article>", f"{SHORT}\n{LONG}"),
    (f"<article><section class='a'>{LONG}</section><section class='b'>{SHORT}</section></article>",
     f"{LONG}\n{SHORT}"),
    (f"<article><p>{SHORT}</p><table><tr><td>{LONG}</td></tr></table></article>", f"{SHORT}\n{LONG}"),
    (f"<main><h1>{SHORT}</h1><div><article><div class='c'>{LONG}</div></article></div></main>",
     f"{SHORT}\n{LONG}"),
    (f"<div class='post'><h1>{SHORT}</h1><div><div class='c'><p>{LONG}</p></div></div></div>"
     "<div class='x'>box</div>", f"{SHORT}\n{LONG}"),
    (f"<body><section>{LONG}</section><section>{SHORT}</section><div>box</div></body>", f"{LONG}\n{SHORT}\nbox"),
    (f"<body><h1>{SHORT}</h1><div class='c'>{LONG}</div></body>", f"{SHORT}\n{LONG}"),
    (f"<div><div class='c'>{LONG}</div><ul><li><a href='x'>{SHORT}</a></li></ul></div>", LONG),
    (f"<div class='x'><p>box</p></div><article><br>{LONG}</article>", LONG),
])
def test_whole_article_around_the_best_container(frame, source, text):
    assert text_of(source) == text
    rows = [(i, "http://h/" + str(i), source) for i in range(3)]
    assert {r.text for r in html_text.extract_pages(
        frame("page_id long, url string, html string", *rows)).collect()} == {text}


@pytest.mark.parametrize("end", ["<body>", "<div>", "", "</head><body>", "</head>"])
def test_head_without_end_tag(end):
    head = "<html><head><meta charset='u'><title>no</title><style>no</style>\n<script>no</script>"
    assert text_of(f"{head}{end}wanted <b>text</b><p>more</p>") == "wanted text\nmore"


@pytest.mark.parametrize("source, text", [
    (f"<div class='site sidebar-right'><div class='c'>{LONG}</div><div class='sidebar'>side</div></div>", LONG),
    (f"<div class='menu-open'><div id='page-widget'><article>{SHORT}</article></div><div class='ad'>{LONG}</div>"
     "</div>", SHORT),
    (f"<main><h1>{SHORT}</h1><div class='nav-top'><p>{LONG}</p></div></main>", f"{SHORT}\n{LONG}"),
    (f"<div class='comments-open'><article>{LONG}</article></div>", LONG),
    ("<div class='menu'><p>a b</p></div><div class='banner'><p>c</p></div><div class='share'>d e</div>", "a b\nc\nd e"),
    # Words still decide over everything beside an article, and over comments.
    (f"<article>{SHORT}</article><div class='cookie-notice'>{LONG}</div>", SHORT),
    (f"<main><article>{SHORT}</article><div class='related'><article>{LONG}</article></div></main>", SHORT),
    (f"<div class='p'>{SHORT}</div><div id='comments'><p>{LONG}</p></div>", SHORT),
    ("<p>one <span class='share'>two</span> three</p>", "one three"),
])
def test_words_do_not_drop_the_main_part(source, text):
    assert text_of(source) == text


def test_host_path_of_inner_containers_keeps_other_pages_whole(frame):
    inner = f"<div class='post'><div class='c'>{LONG}</div></div>"
    rows = [(i, "http://h/" + str(i), inner) for i in range(3)]
    rows.append((3, "http://h/3", inner.replace("<div class='c'>", f"<h1>{SHORT}</h1><div class='c'>")))
    got = {r.page_id: r.text for r in html_text.extract_pages(
        frame("page_id long, url string, html string", *rows)).collect()}
    assert got == {0: LONG, 1: LONG, 2: LONG, 3: f"{SHORT}\n{LONG}"}


def test_host_path_wins_over_a_page_of_its_own(frame):
    def page(body):
        return f"<body>{body}</body>"

    main = "<div class='main-12'><p>" + "wanted text " * 20 + "</p></div>"
    other = "<div class='box'><p>" + "long other text " * 60 + "</p></div>"
    rows = [(i, "http://h.example/" + str(i), page(main.replace("12", str(i)))) for i in range(3)]
    rows.append((3, "http://H.example:80/x", page(main + other)))
    got = {r.page_id: r.text for r in html_text.extract_pages(
        frame("page_id long, url string, html string", *rows)).collect()}
    assert set(got.values()) == {("wanted text " * 20).strip()}


def test_edge_rows(frame):
    schema = "page_id long, url string, html string, host int, text string"
    rows = [(1, None, "<p>a</p>", 1, "q"), (2, "no url", None, 1, "q"), (None, "http://a/", "", 1, "q"),
            (3, "http://a/", "<p>b</p>", 1, "q"), (3, "http://a/", "<p>b</p>", 1, "q"),
            (4, "http://a/", "<p>" + "x" * 300000 + "</p>", 1, "q")]
    got = sorted((str(r.page_id), r.text[:3], r.n_chars) for r in html_text.page_texts(
        frame(schema, *rows)).collect())
    assert got == [("1", "a", 1), ("2", "", 0), ("3", "b", 1), ("3", "b", 1), ("4", "xxx", 300000),
                   ("None", "", 0)]
    assert html_text.page_texts(frame(schema)).collect() == []


def test_query_on_the_test_table(spark):
    pages = {r.page_id: r for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()}
    rows = registry.QUERIES["op9_html_extraction"](spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == len(pages)
    for r in rows:
        article = re.search("<article>(.*?)</article>", pages[r.page_id].html, re.DOTALL)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]+>", "", b)).split())
                  for b in re.split("</?(?:p|h1)>", article.replace("<br>", " "))]
        assert r.text == "\n".join(b for b in blocks if b)
        assert (r.url, r.n_chars) == (pages[r.page_id].url, len(r.text))
