import html
import re

import pytest
from pyspark.sql import functions as F

from signpost.llm.html_extract import main_text, page_blocks


def text(page):
    return " ".join(page_blocks(page)[0])


@pytest.mark.parametrize(("page", "want"), [
    (None, ""), ("", ""), ("<p>", ""), ("plain &amp; simple\n text", "plain & simple text"),
    ("<html><head><title>t</title><style>p{}</style></head><body><nav>menu</nav><div id=top>One<p>Two<p>Three<br>four</div><footer>f</footer>", "One Two Three four"),
    ("<body><header>site</header><article><header><h1>Head</h1></header><p>Bo<b>d</b>y &eacute;&#33;<script>var a='</p>'</script></p></article><aside>x</aside></body>", "Head Body é!"),
    ("<div class='cookie-notice'>We use</div><div class=content>Text</div><div class='ad'>buy</div><ul class=menu><li>x</ul>", "Text"),
    ("<div class='page with-sidebar'><article>kept</article><div class=sidebar>no</div></div>", "kept"),
    ("<main><p>kept</p><section id=comments><article>reader</article></section></main>", "kept"),
    ("<form id=aspnet><main>kept<form>field</form></main></form>", "kept"),
    ("<article>a <!-- x > y --> b <![CDATA[c]]> d<div hidden>no</div><p style='display: none'>no</p></article>", "a b d"),
    ("<ul><li>one<li>two<ul><li>in</ul><li>three</ul><table><tr><td>x<td>y<tr><td>z</table>", "one two in three x y z"),
    ("1 < 2 and <b>bold</b>er <a href='x>y'>link</a> <div class=\"cut", "1 < 2 and bolder link"),
    ("<article>one</article><nav>n</nav><article>two</article>", "one two"),
    ("<script>never closed <p>x</p>", ""), ("</p></div>after", "after"), ("<DIV CLASS=AD>x</DIV><P>Y</P>", "Y"),
])
def test_pages(page, want):
    assert text(page) == want


@pytest.mark.parametrize(("page", "want"), [
    ("<main><h1>Title</h1><p>body</p><section class=cards><article>teaser</article></section></main>", "Title body teaser"),
    ("<main><p>Crumb</p><article><p>most of the text</p></article></main>", "most of the text"),
    ("<main><p>body</p></main><div><article>teaser</article></div>", "body teaser"),
])
def test_articles_stand_for_a_main_element_only_if_they_hold_half_of_it(page, want):
    assert text(page) == want


def test_deep_and_long_pages():
    assert text("<div>" * 20_000 + "deep" + "</div>" * 20_000) == "deep"
    assert text("<p>word " * 50_000) == "word " * 49_999 + "word"
    assert text("<!--" * 20_000) == "" and text("<a \"" * 2000).startswith("")


def test_query_equals_the_articles(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    want = {}
    for r in pages.collect():
        inner = r.html[r.html.index("<article>") + 9 : r.html.index("</article>")]
        inner = re.sub(r"</?b>", "", inner)
        want[r.page_id] = " ".join(html.unescape(re.sub(r"<[^>]*>", " ", inner)).split())
    got = main_text(pages).collect()
    assert len(got) == len(want)
    assert {r.page_id: r.text for r in got} == want and all(r.n_chars == len(r.text) for r in got)


@pytest.mark.parametrize("sent", [4_000_000, 0])
def test_templates_of_a_host_go(spark, sent):
    def page(i, host):
        story = " ".join(f"{host}{i}w{k}" for k in range(30))
        unique = f"<div><p>{story}</p><p>That.</p></div>" if i % 4 == 0 else f"<div><p>{story}</p></div>"
        return f"<body><div><p>Welcome to {host}</p><ul><li>Home<li>About</ul></div>{unique}<div><p>All rights of {host}</p></div></body>"

    rows = [(i, f"http://{h}.net/{i}", page(i, h)) for h in ("one", "two") for i in range(20)]
    rows += [(100 + i, "http://few.net/x", page(i, "few")) for i in range(3)]  # too few pages to tell
    rows += [(200 + i, f"http://copy.net/{i}", "<body><p>same story on every page of it</p><p>and its end</p></body>") for i in range(30)]
    rows += [(300, None, page(1, "none")), (301, "http://one.net/301", None), (301, "http://one.net/301", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"host": F.lit(1), "lines": F.lit(2), "_gone": F.lit(3)})
    got = main_text(pages, sent=sent).collect()
    assert len(got) == len(rows)
    for r in got:
        host = re.search(r"//(\w+)", r.url)[1] if r.url else "none"
        story = " ".join(f"{host}{r.page_id % 100}w{k}" for k in range(30))
        if host in ("one", "two") and r.page_id < 100:
            assert r.text == story + (" That." if r.page_id % 4 == 0 else "")
        elif host == "few":
            assert r.text.startswith("Welcome to few Home About few0w0"[:26]) and r.text.endswith("All rights of few")
        elif host == "copy":
            assert r.text == "same story on every page of it and its end"
    assert main_text(pages.limit(0), sent=sent).collect() == []


def test_equal_texts_under_two_markups_are_judged_by_their_own_subtrees(spark):
    """60 pages of a host, 20 texts in two markups; only one of them has the box that stands on all other pages."""
    box = "<section><b>Read</b> our offer of the week</section>"
    plain = "<p>Read our offer of the week</p>"
    rows = []
    for i in range(60):
        text = f"<p>Story number {i if i < 40 else i - 20} has words of its own, and more of them than the box</p>"
        rows.append((i, f"https://h.example/{i}", f"<html><body><article>{text}{box if i < 40 else plain}</article></body></html>"))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    sent = {r.page_id: r.text for r in main_text(pages).collect()}
    joined = {r.page_id: r.text for r in main_text(pages, sent=0).collect()}
    assert sent == joined
    assert all(("offer" in sent[i]) == ("offer" in sent[40]) for i in range(40, 60)) and not any("offer" in sent[i] for i in range(40))
