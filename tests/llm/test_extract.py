"""Main text: the given pages against a plain reading of their markup, and other page shapes."""

import html as entities
import re
import time

import pytest

from skywell.llm import extract
from skywell.llm.extract import main_text
from tests.compare import database


def plain(page):
    """The article of the given pages: its heading and paragraphs, by splitting at the known tags."""
    body = re.search(r"<article>(.*?)</article>", page, re.S).group(1)
    blocks = re.split(r"</?(?:h1|p)>", re.sub(r"</?b>", "", body.replace("<br>", " ")))
    return "\n".join(x for x in (" ".join(entities.unescape(b).split()) for b in blocks) if x)


def test_query_equals_plain_reading(spark):
    sf = "/root/testdata/sf0.01"
    pages = dict(database(sf).execute("select page_id, html from pages").fetchall())
    got = extract.op7_extract(spark, sf).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r.text == plain(pages[r.page_id]) and r.n_chars == len(r.text)


WORDS = "Some sentence of ordinary prose that goes on for a while, as articles do. " * 3
SHAPES = [
    (f"<body><div id='menu'><a href=/>Home</a> <a href=/b>B</a></div><div class='post'><h1>Title</h1><p>{WORDS}</p><p>Short.</p><p>{WORDS}</p></div>"
     "<div class='sidebar'>Also read</div><div>(c) site</div></body>", ["Title", WORDS, "Short.", WORDS]),
    (f"<body><header><h1>Site</h1></header><main><h2>T</h2><p>a&nbsp;&lt;b&gt;\n c<p>{WORDS}<section class=comments><p>{WORDS}</p></section></main>"
     f"<form><p>{WORDS}</p></form><footer>{WORDS}</footer>", ["T", "a <b> c", WORDS]),
    (f"<div class=ad>never closed<nav><ul><li>x<article><h1>A</h1><p>one<br>two</p><div class='cookie-notice'>We use</div><p>{WORDS}</p></article>",
     ["A", "one two", WORDS]),
    (f"<div role=banner>{WORDS}</div><article><p style='display:none'>{WORDS}</p><script>var a='<p>{WORDS}';</script><p>Only</p></article>", ["Only"]),
    ("<p>alone</p>", ["alone"]), ("no markup at all", ["no markup at all"]), ("", []), (None, []), ("a < b <p>&amp;&#x41;", ["a < b", "&A"]),
    (f"<body><a href=/>x</a><h2>Head</h2><p>{WORDS}</p><p>End.</p><p>{WORDS}</p><p><a href=/>all links</a></p>", ["Head", WORDS, "End.", WORDS]),
    ("<script>x", []), ("<div><!-- only a comment --></div>", []),
]


@pytest.mark.parametrize("page, want", SHAPES)
def test_shapes(page, want):
    assert main_text(page).split("\n") == ([" ".join(w.split()) for w in want] or [""])


def test_rows(spark):
    long = "<article>" + f"<p>{WORDS}</p>" * 20_000 + "</article>"
    rows = [(1, "u", None, "x"), (2, None, "", "x"), (3, "u", long, "x"), (3, "u", long, "x"), (None, "u", "<p>a", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string").repartition(2)
    got = extract.extract(df).collect()
    assert len(got) == 5 and sorted(len(r.text) for r in got)[:3] == [0, 0, 1]
    assert all(r.text.count("\n") == 19_999 for r in got if r.page_id == 3)
    assert extract.extract(df.limit(0)).count() == 0


PAGES = [
    # all of the page in a form, a wrapper with an unlucky name
    (f"<body><form action=x><div><h1>T</h1><p>{WORDS}</p><p>{WORDS}</p></div><div><input name=a><select><option>o</select></div></form></body>", ["T", WORDS, WORDS]),
    (f"<form><p>{WORDS}</p></form>", [WORDS]),
    (f"<div class='article-login'><div><h1>T</h1><p>{WORDS}</p><p>End.</p></div></div><div class=footer>{WORDS}</div>", ["T", WORDS, "End."]),
    # the lead beside the inner article, the end in a sibling container
    (f"<main><p>Lead: {WORDS}</p><article><h1>T</h1><p>{WORDS}</p><p>{WORDS}</p></article></main>", [f"Lead: {WORDS}", "T", WORDS, WORDS]),
    (f"<div><div><h1>T</h1><p>{WORDS}</p><p>{WORDS}</p></div><div><p>Last: {WORDS}</p></div></div><div>(c)</div>", ["T", WORDS, WORDS, f"Last: {WORDS}"]),
    # links in an article under a name that no list has
    (f"<article><h1>T</h1><p>{WORDS}</p><ul class=xyz><li><a href=/a>One thing</a><li><a href=/b>Another</a></ul><p>{WORDS}</p><p>Bye.</p></article>", ["T", WORDS, WORDS, "Bye."]),
    # comments that are longer than the article
    (f"<article><h1>T</h1><p>{WORDS}</p></article><section id=comments>" + f"<article><p>{WORDS}</p></article>" * 9 + "</section>", ["T", WORDS]),
    (f"<footer><p>{WORDS}</p></footer>", []),
]


@pytest.mark.parametrize("page, want", PAGES)
def test_names_don_t_decide_against_the_article(page, want):
    assert main_text(page).split("\n") == ([" ".join(w.split()) for w in want] or [""])


@pytest.mark.parametrize("tags", ["<div>", "<p>", "<div><p>", "<div class=ad>", "<li>", "<b>"])
def test_deep_nesting_takes_no_square_of_time(tags):
    started = time.time()
    assert main_text(f"<article><p>{WORDS}</p></article>" + tags * 50_000 + "x").startswith("Some sentence")
    assert main_text(tags.replace(" class=ad", "") * 50_000 + WORDS).startswith("Some sentence")
    assert time.time() - started < 6
