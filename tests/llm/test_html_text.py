import html
import random
import re
import time

import duckdb
import pytest

from sectile.llm import html_text as ht
from sectile.llm import queries

D = "/root/testdata/sf0.01"


def texts(spark, rows, **kw):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {r.page_id: r.text for r in ht.extract(df, **kw).collect()}


def alone(page):
    """Text of a page of a host of its own."""
    return "\n".join(t for t, f, _ in ht.pieces(page) if not f)


def test_query_against_the_marked_articles(spark):
    got = {r.page_id: r for r in queries.op12_html_extraction(spark, D).collect()}
    rows = duckdb.sql(f"SELECT page_id, url, html FROM '{D}/pages.parquet'").fetchall()
    assert len(got) == len(rows)
    for i, url, page in rows:
        inner = re.search("<article>(.*)</article>", page, re.S)[1]
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", "", re.sub("<br>", " ", x))).split()) for x in re.split("</?(?:p|h1)>", inner)]
        want = "\n".join(x for x in parts if x)
        assert (got[i].url, got[i].text, got[i].n_chars) == (url, want, len(want))


def test_the_counts_find_most_of_the_given_templates(spark):
    """On the busiest host of the larger table, menus, adverts and footers go because they recur."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").filter("url LIKE '%blog.tionsh.example.com%'")
    out = ht.extract(pages).collect()
    assert len(out) > 300 and sum(r.n_template > 0 for r in out) > 0.9 * len(out)
    assert sum(r.n_template for r in out) > 10 * sum(r.n_furniture for r in out)


def test_unnamed_template_goes_once_it_recurs(spark):
    def page(i, box="Follow us <b>now</b>"):
        return f"<body><div class=x1>{box}</div><article><p>Text {i}.</p><p>Shared line.</p></article><div><p>Only here {i}</p></div></body>"

    rows = [(i, "http://a.org/x", page(i)) for i in range(5)] + [(10 + i, "https://B.org:80/y", page(i)) for i in range(2)] + [(20, None, page(0)), (21, "http://a.org/z", page(9, "Follow them"))]
    got = texts(spark, rows)
    for i in range(5):
        assert got[i] == f"Text {i}.\nShared line.\nOnly here {i}"
    for i in (10, 11, 20):
        assert got[i].startswith("Follow us now\nText")
    assert got[21].startswith("Follow them\nText 9.")


def test_copies_of_a_page_count_once_and_articles_stay(spark):
    page = "<div>Not template</div><article><p>Same text.</p></article>"
    near = [(100 + i, "http://n.org/", f"<article><p>Same text.</p><p>Same too.</p><p>{i}</p></article>") for i in range(30)]
    got = texts(spark, [(i, "http://c.org/", page) for i in range(30)] + near)
    assert all(got[i] == "Not template\nSame text." for i in range(30))
    assert all(got[100 + i] == f"Same text.\nSame too.\n{i}" for i in range(30))


@pytest.mark.parametrize("page, want", [
    ("", ""),
    ("plain &amp; text", "plain & text"),
    ("<p>a<p>b<div>c</div>d", "a\nb\nc\nd"),
    ("<article><h1> T  1\n</h1><p>a<b>b</b>c<br>d&nbsp;e</p></article>", "T 1\nabc d e"),
    ("<article>x<script>var a='</p>';</script>y<style>p{}</style><!-- no --><noscript>n</noscript></article>", "xy"),
    ("<nav><ul><li>Menu</li></ul></nav><main><p>m</p><aside>side</aside></main><footer>f</footer>", "m"),
    ("<header><h1>Site</h1></header><article><header><h1>Title</h1></header><p>b</p><section class='comments'><article class='comment'>c</article></section></article>", "Title\nb"),
    ("<article><p>a</p></article><div id='cookie-notice'>We use cookies</div><form><p>Mail</p></form><div class='ad-box ad'>buy</div>", "a"),
    ("<form id=aspnet><article><p>in a form</p></article></form>", "in a form"),
    ("<ul><li>a<li>b</ul><table><tr><td>1<td>2<tr><th>3</table>", "a\nb\n1\n2\n3"),
    ("<p title='a>b'>q</p><p data-x=it's>r</p>", "q\nr"),
    ("<p>1 < 2 &lt; 3 &am &copy; &#233;&#x41;</p>", "1 < 2 < 3 &am © éA"),
    ("<p>cut <b", "cut"),
    ("<p>a</p><!-- open", "a"),
    ("</div></p>x</span>", "x"),
    ("<div class=loading><p>text</p></div><div class=Ad>n</div>", "text"),
    ("<body class='with-sidebar ads'><div><p>long text of the page</p></div></body>", "long text of the page"),
])
def test_markup(page, want):
    assert alone(page) == want


def test_odd_rows(spark):
    rows = [(1, None, None), (1, None, None), (None, "http://x/", "<p>n</p>"), (2, "", "<article>" + "<div>" * 5000 + "deep" + "</div>" * 5000 + "<p>" + "é" * 100_000)]
    df = spark.createDataFrame([(*r, "c", 1) for r in rows], "page_id long, url string, html string, text string, page int")
    out = ht.extract(df).collect()
    assert sorted((r.page_id or 0, r.n_chars) for r in out) == [(0, 1), (1, 0), (1, 0), (2, 100_005)]
    assert ht.extract(df.toDF("page_id", "url", "html", "HTML", "gone")).count() == 4
    assert ht.extract(df.limit(0)).count() == 0


def test_time_is_linear():
    r = random.Random(1)
    for part in ("<div>", "<p>x", "<a href=\"", "<a b='c", "<!--", "</", "<a ", "a=b<", "&amp", "<script>", "<li>x<ul>"):
        took = []
        for n in (10_000, 40_000):
            page = part * n + r.choice("xy")
            began = time.time()
            ht.pieces(page)
            took.append(time.time() - began)
        assert took[1] < 12 * took[0] + 1, part
