"""Main text of written pages, and of the registered table against its one template."""

import html
import re

from custodia.llm import article, catalog

A, B, C = "First, some words of the article, long enough.", "Second paragraph, with more & more words, in it.", "Third."


def test_containers_and_what_is_dropped():
    body = (
        "<header><h1>Site</h1></header><nav><ul><li><a href='/'>Home</a></ul></nav><div class='cookie-notice'>We use cookies, sorry, really.</div>"
        "<div id=wrap class='has-sidebar'><div class='content'><h1>Title</h1><p>%s<p>%s</p><div class=ad-box><p>Buy, buy, buy this long, long advert.</p></div>"
        "<form><p>Your name, please, and your address, here.</p></form><p>%s</div>"
        "<div class='sidebar'><p>Side, side, side text that is long, too.</p></div></div>"
        "<section id='comments'><p>I like it, a lot, really, a lot, yes.</p></section><footer>(c) 2020</footer>"
    ) % (A, B.replace("&", "&amp;"), C)
    page = f"<!doctype html><html><head><title>T</title><style>p{{}}</style></head><body>{body}</body></html>"
    assert article.main_text(page) == "\n\n".join(["Title", A, B, C])


def test_markup():
    page = "<article><h1>a&nbsp;&lt;b&gt; &eacute;&#233;&#xe9;</h1>\n<p>x <b>bold</b>  <i>it<br>al</i>\t.<!-- no <p> --><script>var t='</p>';</script> y<p>z<ul><li>one<li>two</ul>"
    assert article.main_text(page) == "a <b> ééé\n\nx bold it al . y\n\nz\n\none\n\ntwo"
    assert article.main_text("<article><header><h1>Head</h1></header><p>Text, here.</article>") == "Head\n\nText, here."
    assert article.main_text("plain text, no markup") == "plain text, no markup"
    assert article.main_text("<p>only <a title='x>y' href=\"/q\">one</a> paragraph") == "only one paragraph"
    assert article.main_text("<div><p>a < b and c > d, 3 <4</p></div>") == "a < b and c > d, 3 <4"
    assert article.main_text("<article><p>one</p><article class='comment'><p>reader</p></article></article>") == "one"
    assert article.main_text("<body><div style='display: none'>no</div><div hidden>no</div><p>yes, this.</p></body>") == "yes, this."


def test_empty_and_broken():
    for page in (None, "", "   ", "<html></html>", "<nav>a</nav>", "<script>x", "<!-- open", "<p", "<a title='"):
        assert article.main_text(page) == ""
    deep = "<div>" * 3000 + "deep, text" + "</div>" * 10
    assert article.main_text(deep) == "deep, text"
    assert article.main_text("<article>" + "<p>w, w</p>" * 20_000 + "</article>").count("w, w") == 20_000


def test_odd_rows(spark):
    rows = [(1, None, None, 1), (1, "u", "<p>x</p>", 2), (None, "u", "", 3), (2, "u", "<p>x</p>", None)]
    out = article.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text int")).collect()
    assert sorted(map(str, out)) == sorted(
        map(str, [article_row(1, None, ""), article_row(1, "u", "x"), article_row(None, "u", ""), article_row(2, "u", "x")])
    )
    assert article.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def article_row(page_id, url, text):
    from pyspark.sql import Row

    return Row(page_id=page_id, url=url, text=text, n_chars=len(text))


def test_query(spark):
    """All pages of the table keep their text in one article element."""
    pages = {r.page_id: r.html or "" for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()}
    out = catalog.op7_article(spark, "/root/testdata/sf0.01").collect()
    assert len(out) == len(pages)
    for r in out:
        inner = re.search(r"<article>(.*)</article>", pages[r.page_id], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"</?b>|<br>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
        want = "\n\n".join(b for b in blocks if b)
        assert (r.text, r.n_chars) == (want, len(want))
