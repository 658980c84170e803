"""Extraction on hand-made pages, template removal, and the pages table."""

import html
import re

import pytest

import __spark_entry__ as entry
from conftest import SF01
from loadlens.llm.html_text import Page, extract_text

CASES = [
    (None, ""), ("", ""), ("plain text", "plain text"), ("<p>a<p>b", "a b"), ("<p>a<b>b</b>c", "abc"), ("a<br>b", "a b"),
    ("<script>var t='</p>';</script><p>x", "x"), ("<style>p{}</style>x", "x"), ("<script>never ends <p>x</p>", ""),
    ("<article><h1>T &amp; &lt;U&gt;</h1><p>x&nbsp;y\n\n z</p></article><footer>f</footer>", "T & <U> x y z"),
    ("<body><nav>menu</nav><header>h</header><div class='side-bar sidebar'>s</div><div id=comments>c</div><p>text</p><aside>a</aside>", "text"),
    ("<main><div>in</div></main><div>out</div>", "in"), ("<article>a<form><input>f</form><div role='navigation'>n</div> b</article>", "a b"),
    ("1 < 2 and 3 > 2", "1 < 2 and 3 > 2"), ("<!-- x --><p title='a>b'>q</p><!-- open", "q"), ("<ul><li>a<li>b</ul>", "a b"),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "a b c"), ("<p>x</b></i>y</div></p>", "xy"), ("<article><section class='Comments-List'>no</section>yes</article>", "yes"),
    ("<article>one</article><div>no</div><article>two</article>", "one two"), ("<div hidden>no</div><div style='display: none'>no</div>yes", "yes"),
    ("<p>caf&eacute; &#233; &#x41; &copy; &bogus;", "café é A © &bogus;"), ("<div", ""), ("<div class='ad'>a</div>b", "b"), ("<p class='readable'>keep</p>", "keep")]


def text_of(page):
    return " ".join("".join(t for t, _ in Page(page or "").main_runs()).split())


@pytest.mark.parametrize("page, want", CASES)
def test_cases(page, want):
    assert text_of(page) == want


def test_templates(spark):
    pages = [(i, f"http://Host.example/{i}", f"<div><div>Subscribe <b>now</b></div><p>own text {i}</p><p>{'often' if i % 2 else 'seldom'}</p></div>") for i in range(20)]
    pages += [(100 + i, f"http://small.example/{i}", "<div>Subscribe <b>now</b></div><p>x</p>") for i in range(3)] + [(200, None, "<div>Subscribe <b>now</b></div>"), (201, "x", None)]
    got = {r["page_id"]: r["text"] for r in extract_text(spark.createDataFrame(pages, "page_id bigint, url string, html string").repartition(4)).collect()}
    for i in range(20):
        assert got[i] == f"own text {i} {'often' if i % 2 else 'seldom'}"
    assert got[100] == "Subscribe now x" and got[200] == "Subscribe now" and got[201] == ""


def test_whole_table_and_edges(spark):
    name = next(q for q in entry.queries() if q.startswith("op6_"))
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in entry.queries()[name](spark, SF01).collect()}
    for r in spark.read.parquet(f"{SF01}/pages.parquet").collect():
        article = re.search(r"<article>(.*)</article>", r["html"], re.S)[1]
        want = " ".join(html.unescape(re.sub(r"</?[a-zA-Z][^>]*>", " ", article)).split())
        assert got[r["page_id"]] == (want, len(want))
    empty = spark.createDataFrame([], "page_id bigint, url string, html string, text string, host string, runs string")
    assert extract_text(empty).collect() == []
    twice = spark.createDataFrame([(1, "http://a/", CASES[9][0], "t", "h", "r")] * 3, empty.schema)
    assert [r["text"] for r in extract_text(twice).collect()] == [CASES[9][1]] * 3


@pytest.mark.parametrize("page, want", [
    ("<div class='has-sidebar'><article>text</article><div class='sidebar'>s</div></div>", "text"), ("<div id=header-fixed><main>text</main></div>", "text"),
    ("<article class='social-policy'><p>text</p><div class=comments>c</div></article>", "text"), ("<body><div class='no-sidebar'><p>long text</p><p>more</p></div>x", "long text more x"),
    ("<main><h1>h</h1><div class='with-comments'><article>the long text</article></div></main>", "the long text"),
    ("<article>text</article><div class=comments><article class=comment>a longer comment</article></div>", "text"),
    ("<div class='has-sidebar'><article>text</article><div class=comments><article>a longer comment</article></div></div>", "text"),
    ("<main>the text<div class=related><article>other</article></div></main>", "the text"),
    ("<header><h1>Site</h1></header><article><header class=entry-header><p>by A</p><h1>The <b>title</b></h1><nav><h2>menu</h2></nav></header><p>text</p></article>", "The title text"),
    ("<article><header hidden><h1>no</h1></header><header><div><h2>yes</h2>no</div></header> text</article>", "yes text")])
def test_wrappers_with_telling_words(page, want):
    assert text_of(page) == want


def test_copies_of_one_article_stay(spark):
    pages = [(i, f"http://m.example/?q={i}", f"<div>Subscribe</div><article><h1>T</h1><p>one</p><p>two</p></article><a href='/{i}'>x</a>") for i in range(30)]
    pages += [(100 + i, f"http://n.example/{i}", f"<div><div>Subscribe</div><p>text {i % 10}</p></div>") for i in range(30)]
    got = {r["page_id"]: r["text"] for r in extract_text(spark.createDataFrame(pages, "page_id bigint, url string, html string").repartition(4)).collect()}
    assert all(got[i] == "T one two" for i in range(30)) and all(got[100 + i] == f"text {i % 10}" for i in range(30))


def test_templates_of_sections(spark):
    pages = [(i, f"http://s.example/{i}", f"<div><div>Section {i % 4}</div><p>text {i}</p><p>{'now and then' if i % 8 == 0 else i}</p></div>") for i in range(120)]
    got = {r["page_id"]: r["text"] for r in extract_text(spark.createDataFrame(pages, "page_id bigint, url string, html string").repartition(4)).collect()}
    assert got == {i: f"text {i} " + ("now and then" if i % 8 == 0 else str(i)) for i in range(120)}


def test_titles_in_headers_are_no_template(spark):
    pages = [(i, f"http://t.example/{i}", f"<article><div><header><h1>Title {i}</h1><p>by A</p></header></div><p>text {i}</p></article>") for i in range(30)]
    got = {r["page_id"]: r["text"] for r in extract_text(spark.createDataFrame(pages, "page_id bigint, url string, html string").repartition(4)).collect()}
    assert got == {i: f"Title {i} text {i}" for i in range(30)}
