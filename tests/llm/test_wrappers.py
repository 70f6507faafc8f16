import html as entities
import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.llm import wrappers
from millrace.llm.queries import QUERIES
from millrace.llm.wrappers import SlotText, fold, main_slots, match, from_text, places, read_page, to_text

SMALL = "/root/testdata/sf0.001"
SCHEMA = "page_id long, url string, html string"


def article(page):
    """The blocks of the one article of a page of the given tables, by patterns."""
    inside = re.search(r"(?s)<article>(.*?)(</article>|$)", page or "")
    blocks = re.split(r"</?(?:p|h\d|div|article)[^>]*>", inside[1]) if inside else []
    texts = (" ".join(entities.unescape(re.sub(r"<[^>]*>", " ", b) if "<br" in b else re.sub(r"<[^>]*>", "", b)).split()) for b in blocks)
    return "\n".join(filter(None, texts))


def texts(spark, *pages, **options):
    frame = spark.createDataFrame([(i, url, page) for i, (url, page) in enumerate(pages)], SCHEMA)
    return [row.text for row in wrappers.main_text(frame, **options).orderBy("page_id").collect()]


@pytest.mark.parametrize("folder", [SMALL, "/root/testdata/sf0.01"])
def test_query_equals_articles_by_patterns(spark, folder):
    pages = {row.page_id: row for row in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    found = QUERIES["op13_main_text"](spark, folder).collect()
    assert len(found) == len(pages)
    for row in found:
        assert (row.url, row.text, row.n_chars) == (pages[row.page_id].url, article(pages[row.page_id].html), len(row.text))


SENTENCES = [f"Sentence {i} about {word} and its many uses in the field." for i, word in enumerate("iron wood glass paper stone cloth water".split())]


def plain_page(i, extra=""):
    """A page whose elements have no names: only other pages tell what is template."""
    return (
        f"<html><body><div><ul><li><a href=/a>Home</a><li><a href=/b>About us</a></ul></div>"
        f"<div><h1>Title {i}</h1><p>{SENTENCES[i]}</p><p>Read by many.</p><p>{SENTENCES[i + 1]} More.</p>{extra}</div>"
        f"<div>All rights reserved by the house of pages, wherever you may read them, in print or not.</div></body></html>"
    )


def test_template_of_plain_pages(spark):
    pages = [(f"http://plain.example/{i}", plain_page(i)) for i in range(5)]
    assert texts(spark, *pages) == [f"Title {i}\n{SENTENCES[i]}\n{SENTENCES[i + 1]} More." for i in range(5)]


def test_equal_pages_are_no_evidence(spark):
    pages = [("http://one.example/x", "<h1>A</h1><p>Some text here.</p><p>And more of it.</p>")] * 6
    assert texts(spark, *pages) == ["A\nSome text here.\nAnd more of it."] * 6


def test_few_pages_have_no_template(spark):
    pages = [(f"http://two.example/{i}", f"<h1>Same</h1><p>{SENTENCES[i]}</p>") for i in range(2)]
    assert texts(spark, *pages) == [f"Same\n{SENTENCES[i]}" for i in range(2)]
    assert texts(spark, *pages, least_pages=2) == SENTENCES[:2]


def test_hosts_are_apart_and_a_null_url_is_a_host(spark):
    pages = [(f"http://h{i}.example/", plain_page(i)) for i in range(4)] + [(None, plain_page(4)), (None, "<p>Other.</p>"), ("no scheme", None)]
    found = texts(spark, *pages)
    assert all(f"Title {i}" in found[i] and "Read by many." in found[i] for i in range(5))
    assert found[5:] == ["Other.", ""]


NAMED = """<!DOCTYPE html><html><head><title>Site</title><style>p {{}}</style></head><body class="has-sidebar">
<header><h1>The Site</h1><p>Daily words</p></header><nav><a href=/>Home</a></nav>
<div class="cookie-notice">We use cookies.</div><div id="ad-top">Buy now!</div>
<main><article class="post"><header class="entry-header"><h1>Title {0}</h1></header>
<p>Start&nbsp;of  {0} &amp; <b>bold</b> &lt;text&gt; &#233;<br>next line</p><script>var x = "<p>no</p>";</script>
<!-- <p>no</p> --><form><p>Your mail</p><input></form><h2>Part</h2><ul><li>One {0}<li>Two <a href=x>linked</a></ul>
<table><tr><td>cell {0}<td>other</table><blockquote>Quoted {0}.</blockquote><aside>Aside</aside><pre>a
  b</pre></article></main>
<div class="sidebar"><p>Related</p></div><section id="comments"><article class="comment"><p>I like it {0}.</p></article></section>
<footer><p>Imprint</p></footer></body></html>"""


def test_parts_that_are_no_main_text(spark):
    pages = [("http://named.example/", NAMED.format(i)) for i in range(2)]
    expected = "Title {0}\nStart of {0} & bold <text> é next line\nPart\nOne {0}\nTwo linked\ncell {0}\nother\nQuoted {0}.\na b"
    assert texts(spark, *pages) == [expected.format(i) for i in range(2)]


def test_broken_and_empty_pages(spark):
    pages = ["", None, "plain words", "<p>a<p>b", "<article><h1>T</h1><p>cut off in a <b", "<div><div>", "<p>1 < 2 & 3</p>", "<!-- open", "<script>never ends",
             "<p>x</p><p title='a>b'>y</p>", "</p></div>tail", "<p>&bogus; &amp;amp; \x00</p>", "<nav>menu", "<article><nav>menu</nav><p>kept</p>"]
    found = texts(spark, *((f"http://b{i}.example", page) for i, page in enumerate(pages)))
    assert found == ["", "", "plain words", "a\nb", "T\ncut off in a", "", "1 < 2 & 3", "", "", "x\ny", "tail", "&bogus; &amp; \x00", "", "kept"]


def test_extra_columns_repeated_ids_and_no_rows(spark):
    frame = spark.createDataFrame([(1, "http://a.example", "<p>x</p>"), (1, "http://a.example", "<p>x</p>"), (None, None, "<p>y</p>")], SCHEMA)
    frame = frame.withColumns({"host": F.lit("own"), "tree": F.lit(1), "text": F.lit("t")})
    assert sorted(row.text for row in wrappers.main_text(frame).collect()) == ["x", "x", "y"]
    assert wrappers.main_text(frame.limit(0)).count() == 0


def test_many_trees_are_folded_in_groups(spark, monkeypatch):
    monkeypatch.setattr(wrappers, "FOLD", 2)
    trees = [f"page ( {' '.join(f'h{k}' for k in range(1, 7) if i >> k & 1)} )".replace("(  )", "").strip() for i in range(0, 128, 2)]
    trees = [tree if "(" in tree else "page" for tree in trees]
    frame = spark.createDataFrame([("host", tree) for tree in trees], "host string, tree string")
    found = wrappers.wrappers(frame).collect()
    assert len(found) == 1
    held = {node.sign for node in wrappers.numbered(from_text(found[0].wrapper))}
    assert held == {"page", *(f"h{k}" for k in range(1, 7))}
    for tree in trees:
        assert len(set(places(tree, found[0].wrapper))) == len(places(tree, found[0].wrapper))


def test_simple_tree_matching():
    a, b = from_text("page ( div ( h1 p ) ul ( li ) div.foot )"), from_text("page ( ul ( li ) div ( p ) div.foot )")
    score, pairs = match(a, b)
    assert score == 4 and [x.sign for x, _ in pairs] == [y.sign for _, y in pairs]
    assert match(from_text("div ( p )"), from_text("ul ( p )")) == (0, [])
    assert to_text(from_text("page ( div ( h1 p ) ul )")) == "page ( div ( h1 p ) ul )"
    assert fold(["page ( p )", "page ( h1 p ul ( li ) )"]) == "page ( h1 p ul ( li ) )"


def test_region_without_articles():
    wrapper = "page ( div ( ul ( li ) ) div ( h1 p ) div )"
    assert main_slots(wrapper, {3: SlotText(50, 50), 5: SlotText(20, 0), 6: SlotText(400, 10), 7: SlotText(30, 0)}) == [4, 5, 6]


MARKUP = st.lists(st.sampled_from("<p> </p> <div> </div> <b> <article> </article> <td> <li> <ul> </ul> <a> </a> <h1> <br> <!-- --> < & x word <nav> </nav>".split()), max_size=40)


@settings(max_examples=200, deadline=None)
@given(MARKUP)
def test_any_markup_is_read(parts):
    page = read_page(" ".join(parts))
    size = len(places(page.tree, page.tree))
    assert all(0 <= slot < size for slot in page.slots) and places(page.tree, page.tree) == list(range(size))


@pytest.mark.parametrize("part", ["<", "<!--", "<a ", "<div>", "<p>x", "&", "</", "<b>", "<article><div class=ad>", "<a href=\"", "<td>", "<li><a>x", "</i><b>"])
def test_reading_is_linear(part):
    started = time.perf_counter()
    read_page(part * 20_000)
    assert time.perf_counter() - started < 10
