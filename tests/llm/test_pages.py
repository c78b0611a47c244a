"""Page texts against hand-made pages and the article markup of the given ones."""

import html
import re

import pytest

from churnmart.llm import pages

WHOLE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><article>x</article>";</script></head>
<body><header><h1>Site</h1></header><nav><ul><li><a href="/a">Menu</a></ul></nav><div class="cookie-notice">We use cookies</div>
<article><h1>Head &amp; line</h1><p><b>One  two<br>three<p>Four&nbsp;five &lt;tag&gt;</p><div class="share">Share</div><ul><li>A<li>B</ul>
<p>six <a href=x>seven</a> <span class="ad">buy</span> eight</p><section id="comments"><article><p>first!</p></article></section>
</article><aside>side</aside><form>Name <input></form><footer>&copy; x</footer></body></html>"""


@pytest.mark.parametrize("source, text", [
    ("", ""), ("plain  text", "plain text"), ("<p>a<p>b", "a\nb"), ("<!-- x --><p>a</p><!-- y", "a"), ("<p>a</p><a hre", "a"),
    ("<p>a &am b &amp c</p>", "a &am b & c"), ("<script>var a='<p>'", ""), ("<p>1 < 2</p>", "1 < 2"),
    ("<div>a<div>b</div>c</div>", "a\nb\nc"), ("<table><tr><td>x<td>y</table>", "x\ny"), ("<p title='a>b'>t</p>", "t"),
    ("<p>x</p><nav>menu", "x"), (WHOLE, "Head & line\nOne two three\nFour five <tag>\nA\nB\nsix seven eight"),
])
def test_one_page(source, text):
    assert pages.read_page(source) == text


@pytest.mark.parametrize("source, text", [
    ("<body class='single has-sidebar'><p>a</p><div class=sidebar>b</div></body>", "a"),
    ("<main class='content nav-open'><p>a</p></main>", "a"), ("<article class='post comments-open'><p>a</p></article>", "a"),
    ("<div class='content has-sidebar'><p>a</p></div><div class='cookie-notice'>b</div><div id='site-nav'>c</div>", "a"),
    ("<article><h2 id='search'>a</h2><p id='related-work'>b <span class='notice'>c</span></p><section id='cookies'>d</section></article>", "a\nb c\nd"),
    ("<article><p data-id='ad'>a</p><div class='share-buttons'>b</div><p>c <span class='ad'>d</span></p><div id='comments'>e</div></article>", "a\nc"),
    ("<h1 class='page-header'>a</h1><div class='site-header'>b</div>", "a"), ("<html class='modal-open'><p>a</p></html>", "a"),
])
def test_names_mark_parts_and_no_states(source, text):
    assert pages.read_page(source) == text


def test_given_pages(spark, folder):
    rows = spark.read.parquet(f"{folder}/pages.parquet")
    got = {r.page_id: r for r in pages.extract(rows).collect()}
    for row in rows.collect():
        article = re.search(r"<article>(.*?)(</article>|\Z)", row.html, re.S)[1]
        parts = re.split(r"</?(?:p|h1)\b[^>]*>", article)
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", p)).split()) for p in parts]
        assert got[row.page_id].text == "\n".join(b for b in blocks if b)
        assert got[row.page_id].n_chars == len(got[row.page_id].text) and got[row.page_id].url == row.url
    assert len(got) == rows.count()


def test_repeated_branches_of_a_site_go(spark):
    page = "<body><div class=top>Welcome to us</div><div class=text><p>story number {0}</p></div><div class=low>Call us</div></body>"
    rows = [(i, f"http://a.example/{i}", page.format(i)) for i in range(40)]
    rows += [(100 + i, f"http://b{i}.example/", page.format(i)) for i in range(3)]
    rows += [(200 + i, f"http://c.example/{i}", page.format("same")) for i in range(30)]
    got = {r.page_id: r.text for r in pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"story number {i}" for i in range(40))
    # One page of a host, and a host whose pages do not differ, show nothing to cut.
    assert got[100] == "Welcome to us\nstory number 0\nCall us" and got[205] == "Welcome to us\nstory number same\nCall us"


def test_small_hosts_are_judged_too(spark):
    page = "<body><div class=top>Welcome</div><div class=text><p>story {0}</p></div><div class=low>Call us</div></body>"
    rows = [(10 * n + i, f"http://h{n}.example/{i}", page.format(i)) for n in (2, 3, 9) for i in range(n)]
    # Two copies and another page: the copies are one page, and few have their node.
    other = "<body><div class=top>Welcome</div><div class=kind>{0}</div></body>"
    rows += [(500 + i, f"http://c.example/{i}", other.format("the same text").replace("kind", "kind-a")) for i in range(2)]
    rows += [(502, "http://c.example/2", other.format("one more"))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in pages.extract(df).collect()}
    assert all(got[10 * n + i] == f"story {i}" for n in (2, 3, 9) for i in range(n))
    assert got[500] == got[501] == "the same text" and got[502] == "one more"


def extracted(spark, rows):
    df = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(rows)], "page_id long, url string, html string")
    return [r.text for r in pages.extract(df).orderBy("page_id").collect()]


@pytest.mark.parametrize("story", [
    "<article><h1>Head</h1><p>a long story of some words</p></article>", "<main><h1>Head</h1><p>a long story of some words</p></main>",
    "<div class=top><h1>Head</h1></div><div class=story><p>a long story of some words</p></div>",
])
def test_one_article_under_two_addresses(spark, story):
    page = "<body>{0}<div class=count>visits {1}</div></body>"
    got = extracted(spark, [(f"http://x.example/a{q}", page.format(story, n)) for n, q in enumerate(("", "?print=1"))])
    assert all(t.startswith("Head\na long story of some words") for t in got)


@pytest.mark.parametrize("same, hosts_pages", [
    ("<blockquote><p>to be or not</p></blockquote>", 30), ("<ul><li>flour<li>eggs</ul>", 2), ("<ul><li>flour<li>eggs</ul>", 7),
])
@pytest.mark.parametrize("box", ["article", "main"])
def test_what_two_articles_share_stays(spark, same, hosts_pages, box):
    page = f"<body><div class=low>Call us</div><{box}><h1>Head {{0}}</h1><p>story number {{0}} of this site</p>{{1}}</{box}></body>"
    got = extracted(spark, [(f"http://x.example/{i}", page.format(i, same if i < 2 else "")) for i in range(hosts_pages)])
    words = "to be or not" if "quote" in same else "flour\neggs"
    assert got[0] == f"Head 0\nstory number 0 of this site\n{words}" and got[1].endswith(words)


def test_repeats_inside_articles_go_if_most_pages_have_them(spark):
    page = "<body><article><h1>Head {0}</h1><p>story number {0} of this site</p><div class=k>Read on, dear reader</div></article></body>"
    got = extracted(spark, [(f"http://x.example/{i}", page.format(i)) for i in range(12)])
    assert got == [f"Head {i}\nstory number {i} of this site" for i in range(12)]


def test_what_holds_an_article_is_never_cut(spark):
    page = "<body><div class=w><section><main><p>same text</p></main></section></div><div class=n>{0}</div></body>"
    got = extracted(spark, [(f"http://x.example/{i}", page.format("other words here %d" % i)) for i in range(30)])
    assert got == ["same text"] * 30


def test_importance_is_entropy(spark):
    nodes = spark.createDataFrame(
        [("h", 1, 5, i, False) for i in range(8)] + [("h", 2, 5, 7, False)] * 8, "host string, path long, shape long, content long, root boolean"
    )
    got = {r.path: r.importance for r in pages.importance(nodes).collect()}
    assert got[1] == pytest.approx(0.9) and got[2] == pytest.approx(0.0)


def test_odd_rows(spark):
    rows = [(None, "http://x/", "<p>a", 1), (1, None, None, 1), (2, "::bad[", "", 1), (3, "http://x/", "<p>" + "w " * 200_000, 1), (3, "http://x/", "<p>b", 1)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host int")
    got = pages.extract(df).collect()
    assert sorted(r.n_chars for r in got) == [0, 0, 1, 1, 399_999]
    assert pages.extract(df.limit(0)).count() == 0
