"""Main text of pages: structure, templates, odd input."""

import os
import time

import pytest
from pyspark.sql import functions as F

from panewise.llm import page_text

PAGES = "page_id bigint, url string, html string, key string, host string, blocks int"
SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def pages(spark):
    def make(rows):
        return spark.createDataFrame([(*row, "x", "y", 1) for row in rows], PAGES)

    return make


def kept(html):
    page = page_text.Page(html)
    left, _ = page.judged()
    return [text for text, element in page.blocks if left[element]]


@pytest.mark.parametrize(
    ("html", "blocks"),
    [
        ("", []),
        ("plain &lt;b&gt; text", ["plain <b> text"]),
        ("<p>a<b>b<br>c</b> d<p>e&nbsp;f\n g", ["ab c d", "e f g"]),
        ("<ul><li>one<li>two</ul>three<table><tr><td>x<td>y</table>", ["one", "two", "three", "x", "y"]),
        ("<nav>n</nav><header>h</header><main><h1>T</h1><p>x</main><footer>f</footer>", ["T", "x"]),
        ("<article><header class='entry-header'><h1>T</h1></header><p>x<aside>s</aside></article>", ["T", "x"]),
        ("<div class=sidebar>s</div><div id='cookieNotice'>c</div><div class='content with-sidebar'>x</div>", ["x"]),
        ("<article><p>x</article><section id=comments><article><p>no</article></section>", ["x"]),
        ("<div class='notice page'><main><h1>T</h1>x</main></div>", ["T", "x"]),
        ("<p>x</p><form>f<input>g</form><div hidden>h</div><div style='display: none'>i</div><div role=banner>b</div>", ["x"]),
        ("<p>x<script>if (a < b) '</p>'</script> y<style>p{}</style><!-- <p>z --> w", ["x y w"]),
        ("x <3 & y < z", ["x <3 & y < z"]),
        ('cut <a href="x>off <p>here', ["cut off", "here"]),
        ("<p>x</p><scr", ["x"]),
        ("<title>t", []),
    ],
)
def test_blocks_of_a_page(html, blocks):
    assert kept(html) == blocks


@pytest.mark.parametrize(
    "piece", ["<", "<a ", '<a "', "<!--", "<div>", "<ul><li>", "<svg>", "</x>", "<p>w ", "&", "<a \"><b '>", "<td><li>", "x "]
)
def test_reading_is_linear(piece):
    start = time.perf_counter()
    kept(piece * (1_000_000 // len(piece)))
    assert time.perf_counter() - start < 30


def site(host, count, template, article):
    body = "<html><body>{t}<div><p>{a}</p></div></body></html>"
    return [(k, f"https://{host}/{k}", body.format(t=template(k), a=article(k))) for k in range(count)]


def test_what_a_host_repeats_is_deleted(spark, pages):
    plain = lambda k: "<div><p>Site links</p><p>and more</p></div>"  # noqa: E731  no name, class or role tells what it is
    own = site("a.example", 6, plain, lambda k: f"article {k}")
    other = [(100 + k, f"https://b{k}.example/", html) for k, _, html in own]  # each on a host of its own
    found = {r["page_id"]: r["text"] for r in page_text.page_text(pages(own + other)).collect()}
    assert all(found[k] == f"article {k}" for k in range(6))
    assert all(found[100 + k] == f"Site links\nand more\narticle {k}" for k in range(6))
    left = page_text.page_text(pages(own), templates=False).collect()
    assert {r["text"] for r in left} == {f"Site links\nand more\narticle {k}" for k in range(6)}


def test_an_article_at_many_addresses_stays(pages):
    # The same page under many addresses; articles that share a paragraph; one whose container is shared too.
    same = [(k, f"https://a.example/{k}", "<body><div><p>always the same</p></div></body>") for k in range(9)]
    shared = [
        (50 + k, f"https://c.example/{k}", f"<body><article><h1>T{k}</h1><div><p>licence line</p></div><p>licence line</p></article></body>")
        for k in range(9)
    ]
    found = {r["page_id"]: r["text"] for r in page_text.page_text(pages(same + shared)).collect()}
    assert {found[k] for k in range(9)} == {"always the same"}
    assert {found[50 + k] for k in range(9)} == {f"T{k}\nlicence line" for k in range(9)}


def test_odd_pages(pages):
    rows = [(None, None, None), (1, "", ""), (2, "no address", "<p>x"), (3, "http://h/", "<p>y"), (3, "http://h/", "<p>y")]
    rows.append((4, "http://h/long", "<p>" + "word " * 300_000))
    found = page_text.page_text(pages(rows))
    assert found.columns == ["page_id", "url", "text"]
    by_id = sorted((r["page_id"] or 0, r["text"]) for r in found.collect())
    assert [(i, t[:4]) for i, t in by_id] == [(0, ""), (1, ""), (2, "x"), (3, "y"), (3, "y"), (4, "word")]
    assert len(by_id[-1][1]) == 5 * 300_000 - 1
    assert page_text.page_text(pages([])).count() == 0


def test_pages_of_the_tables_against_what_their_articles_hold(spark):
    """The articles of these tables are plain, so cutting them out by pattern gives the same text."""
    import re
    from html import unescape

    table = spark.read.parquet(f"{SF_DIR}/pages.parquet")

    def plain(html):
        article = html.partition("<article>")[2].partition("</article>")[0]
        blocks = [unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", b))) for b in re.split(r"</?(?:p|h1)>", article)]
        return "\n".join(" ".join(b.split()) for b in blocks if b.split())

    want = {r["page_id"]: plain(r["html"]) for r in table.collect()}
    found = {r["page_id"]: r["text"] for r in page_text.page_text(table).collect()}
    assert found == want and all(found.values())


def test_templates_alone_find_what_recurs(spark):
    """Without the rules, text that stays on a page beside its article stands on few pages of its host."""
    table = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    host = page_text.host_of(F.col("url"))
    large = table.withColumn("h", host).groupBy("h").count().orderBy(F.desc("count")).first()["h"]
    of_host = table.where(host == large)
    plain = {r["page_id"]: r["text"] for r in page_text.page_text(of_host, templates=False, rules=False).collect()}
    taken = {r["page_id"]: r["text"] for r in page_text.page_text(of_host, min_share=0.0, rules=False).collect()}
    assert all(len(taken[k]) <= len(plain[k]) for k in plain)
