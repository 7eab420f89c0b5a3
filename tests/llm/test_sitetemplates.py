"""HTML extraction: markup, templates of hosts, damaged and odd pages."""

import html
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from kinetable.llm import sitetemplates as st
from kinetable.llm.common import table
from kinetable.llm.queries import QUERIES

SCHEMA = "page_id LONG, url STRING, html STRING"


def _text(source, templates=()):
    return st.main_text(st.parse(source), set(templates))[0]


@pytest.mark.parametrize(
    ("source", "text"),
    [
        ("<nav>Menu</nav><article><h1>A &amp; B</h1><p>One\n two<p>Three<br>four</article><footer>&copy;</footer>", "A & B\nOne two\nThree four"),
        ("<p>plain<div>next</div>tail", "plain\nnext\ntail"),
        ("no markup at all", "no markup at all"),
        ("", ""),
        ("<article><p>a<b>b</b>c <i>d</i></p><aside>side</aside><form>f<input></form><p>e</p></article>", "abc d\ne"),
        ("<head><title>T</title><p>body text", "body text"),
        ("<script>if (a < b) document.write('<p>x</p>')</script><p>y</p>", "y"),
        ("<p>a<!-- <p>hidden</p> -->b</p><!-- open", "ab"),
        ("<div class='page has-sidebar'><div class=content><p>text</p></div><div class='sidebar left'>no</div></div>", "text"),
        ("<div class='page-with-menu'><article><p>text</p></article></div>", "text"),
        ("<article><p>text</p><section class=comments><article class=comment><p>nice</p></article></section></article>", "text"),
        ("<div id=cookie-banner>accept</div><main><p>text</p><div role=navigation>nav</div></main>", "text"),
        ("<article class='post tag-ad category-notices'><p>text</p></article>", "text"),
        ("<form action=x><main><p>text</p></main><select><option>one</select></form>", "text"),
        ("<table><tr><td>a<td>b<tr><td><div>c</table><p>d", "a\nb\nc\nd"),
        ("<ul><li>one<li>two<ul><li>in</ul><li>three</ul>", "one\ntwo\nin\nthree"),
        ("<p title='a > b'>text</p><p title='open>more</p><p>last", "text\nmore\nlast"),
        ("<article><p>cut &am", "cut &am"),
        ("<article><p>cut</p><div cl", "cut"),
        ("<p>x &lt; y &#65;&#x42;&nbsp;z 3 < 4</p>", "x < y AB z 3 < 4"),
        ("<div hidden>no</div><div style='display: none'>no</div><p>yes", "yes"),
        ("<header>site</header><p>text</p>", "text"),
        ("<article><header><h1>Title</h1></header><p>text</p><footer>tags</footer></article>", "Title\ntext"),
        ("</p></div></x><p>a</p></p>b", "a\nb"),
        ("<svg><text>no</text></svg><svg/><p>a", "a"),
    ],
)
def test_main_text(source, text):
    assert _text(source) == text


def test_deep_and_long_pages_take_linear_time():
    deep = "<div>" * 60_000 + "x" + "</div>" * 60_000
    assert _text(deep) == "x"
    assert _text("<p>word </p>" * 30_000) == "\n".join(["word"] * 30_000)
    assert _text("<b><i>" * 30_000 + "</x>" * 30_000 + "y") == "y"
    assert _text("a < " * 60_000 + "<p>b") == " ".join(["a <"] * 60_000) + "\nb"
    assert _text("<a '" * 20_000) == ""


def _sites():
    """Pages without an article: only their recurring parts tell what is the site's."""
    rows = []
    for i in range(12):
        rows.append((i, f"https://one.example/{i}", f"<div><a href=/{i}>Home</a> <a>News</a></div><div>Site of one</div><p>Story {i} of one.</p><div>Bye</div>"))
    for i in range(12, 15):
        rows.append((i, f"http://two.example/{i}", f"<div>Site of one</div><p>Story {i}</p>"))
    # copies of one page: its text is no template
    rows += [(20 + i, f"http://three.example/{i}", "<div>Same</div><p>The one story</p>") for i in range(9)]
    # prose that recurs in articles stays, lists of links go
    for i in range(30, 42):
        rows.append((i, "https://FOUR.example:80?x", f"<article><p>Often quoted words.</p><p>Text {i}</p><ul><li><a>Read</a> <a>more</a></li></ul></article>"))
    rows += [(50, None, "<div>Site of one</div>"), (51, "no host", "<p>x</p>"), (None, "https://one.example/", None), (52, "https://one.example/e", ""), (0, rows[0][1], rows[0][2])]
    return rows


def _brute(rows, min_pages=st.MIN_PAGES, min_share=st.MIN_SHARE):
    bodies, holders = defaultdict(set), defaultdict(set)
    host_of = lambda u: m[1].lower() if u and (m := re.match(r".*?://([^/?#]+)", u)) else None
    parsed = [(i, host_of(u), u, st.parse(h or "")) for i, u, h in rows]
    for _, host, _, page in parsed:
        if host:
            bodies[host].add(page.digest[0])
            for d in st.subtrees(page):
                holders[host, d].add(page.digest[0])
    out = []
    for i, host, u, page in parsed:
        common = {d for d in st.subtrees(page) if len(holders[host, d]) >= max(min_pages, min_share * len(bodies[host]))}
        text, blocks, deleted = st.main_text(page, common)
        out.append((i, u, text, len(text), blocks, deleted))
    return sorted(out, key=str)


def test_templates_are_counted_per_host(spark):
    rows = _sites()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumns({c: F.lit(1) for c in ("host", "key", "_key", "text", "body", "subtree", "_html")})
    got = [tuple(r) for r in st.extract(df, ["page_id", "url"]).collect()]
    assert sorted(got, key=str) == _brute(rows)
    texts = {r[0]: r[2] for r in got}
    assert texts[3] == "Story 3 of one."
    assert texts[12] == "Site of one\nStory 12"
    assert texts[20] == "Same\nThe one story"
    assert texts[31] == "Often quoted words.\nText 31"
    assert texts[50] == "Site of one" and texts[None] == "" and texts[52] == ""
    assert st.extract(df, ["host", "key", "page_id"]).columns[:3] == ["host", "key", "page_id"]


def test_share_of_the_host_counts(spark):
    rows = _sites()
    got = [tuple(r) for r in st.extract(spark.createDataFrame(rows, SCHEMA), ["page_id", "url"], min_pages=2, min_share=0.95).collect()]
    assert sorted(got, key=str) == _brute(rows, 2, 0.95)


def test_empty_table(spark):
    assert st.extract(spark.createDataFrame([], SCHEMA), ["page_id"]).collect() == []


def test_query_equals_brute_force_and_the_articles(spark, sf):
    rows = [tuple(r) for r in table(spark, sf, "pages").select("page_id", "url", "html").collect()]
    got = [tuple(r) for r in QUERIES["op11_site_templates"](spark, sf).collect()]
    assert sorted(got, key=str) == _brute(rows)
    texts = {r[0]: r[2] for r in got}
    for i, _, source in rows:
        article = re.search("<article>(.*)</article>", source, re.S)[1]
        parts = [" ".join(html.unescape(re.sub("<br>", " ", re.sub("</?b>", "", p))).split()) for p in re.split("</?(?:p|h1)>", article)]
        assert texts[i] == "\n".join(p for p in parts if p)
