"""Parsing, decoding and extraction of whole pages."""

import html
import random
import re
from itertools import product

import numpy as np
import pytest

from waybill.llm import extract, queries
from waybill.llm.dom import parse


def article_of(source):
    inner = re.search(r"<article[^>]*>(.*?)</article>", source, re.S)[1]
    blocks = re.split(r"</?(?:p|h1|div)[^>]*>", inner)
    lines = (" ".join(html.unescape(re.sub(r"<[^>]+>", " ", b)).split()) for b in blocks)
    return "\n".join(line for line in lines if line)


@pytest.fixture(scope="module")
def pages(spark, sf_dir):
    return queries.read(spark, sf_dir, "pages").collect()


@pytest.fixture(scope="module")
def trees(pages):
    return extract.learnt([r["html"] for r in pages[:100]])


def test_query_extracts_every_article(spark, sf_dir, pages):
    got = {r["page_id"]: r for r in queries.op7_html_extraction(spark, sf_dir).collect()}
    assert len(got) == len(pages)
    for r in pages:
        assert got[r["page_id"]]["text"] == article_of(r["html"])
        assert got[r["page_id"]]["n_chars"] == len(article_of(r["html"]))


def test_other_templates(pages, trees):
    rng = random.Random(9)
    fill = ["Buy our shoes now", "Thanks, I liked this one a lot and will come back", "Home", "Log in"]
    right = 0
    for r in pages[100:200]:
        source = extract.altered(r["html"], fill, rng)
        for old, new in (("article", "post-content"), ("nav", "menu"), ("footer", "site-footer")):
            source = source.replace(f"<{old}>", f'<div class="{new}">').replace(f"</{old}>", "</div>")
        right += extract.texts([source], trees)[0] == article_of(r["html"])
    assert right >= 97


def test_lenient_parsing():
    page = parse("<ul><li>a<li>b<ul><li>c</ul></ul><p>x<b>y<p>z<!-- <p> --><script>if(a<b){'</p>'}</script>&lt;w <tr><td>1<td>2")
    texts = [(page.tags[e], t) for e, t, _, _ in page.pieces]
    assert texts == [("li", "a"), ("li", "b"), ("li", "c"), ("p", "x"), ("p", "y"), ("p", "z"), ("p", "&lt;w "),
                     ("td", "1"), ("td", "2")]
    assert len({b for *_, b in page.pieces}) == 7  # x and y, and z and w, are one block each
    for source in ("", "<", "<<<", "</", "<p", "<!-- open", "<p a='x>y", "</nothing>", "<script>never", "<a" * 3000):
        parse(source)
    deep = parse("<div>" * 5000 + "x")
    assert deep.parents[-1] == 4999 and deep.ends[1] == 5001


def test_decoding_is_the_best_consistent_labelling():
    rng = random.Random(1)
    for _ in range(60):
        source = "<div>"
        for _ in range(rng.randrange(2, 7)):
            source += rng.choice(["<div>", "<p>", "</div>"]) + rng.choice(["", "word " * rng.randrange(1, 5)])
        page = parse(source)
        nodes = extract.Nodes(page)
        n = len(page.tags)
        odds = np.array([rng.uniform(-3, 3) for _ in range(n)])
        value = np.clip(odds, -extract.SURE, extract.SURE) * (nodes.weight * extract.WEIGHT + 0.05)
        best = -np.inf
        for states in product(range(3), repeat=n - 1):
            state = (0, *states)
            steps = [(state[page.parents[i]], state[i]) for i in range(1, n)]
            if all((a, b) in {(0, 0), (0, 1), (1, 1), (1, 2), (2, 2)} for a, b in steps):
                best = max(best, sum(value[i] if state[i] == 1 else -value[i] for i in range(1, n)))
        main = extract.decide(nodes, odds)
        got = sum(value[i] if main[i] else -value[i] for i in range(1, n))
        assert got == pytest.approx(best)


def test_nulls_and_odd_pages(spark, pages):
    rows = [(r["page_id"], r["url"], r["html"], "x") for r in pages[:40]]
    rows += [(None, None, None, "x"), (1, "u", "", "x"), (1, "u", "<article><p>a&nbsp;&amp; b</article>" + "<p>" * 20_000, "x")]
    table = spark.createDataFrame(rows, "page_id long, url string, html string, text_of string")
    got = extract.extract(table, extract.fit(table), ["page_id", "url", "text_of"]).collect()
    assert len(got) == len(rows)
    odd = [r["text"] for r in got if r["url"] in (None, "u")]
    assert odd == ["", "", "a & b"]
    empty = table.limit(0)
    assert extract.extract(empty, extract.fit(empty), ["page_id"]).count() == 0


def test_text_outside_of_blocks(spark, sf_dir):
    pages = queries.read(spark, sf_dir, "pages")
    trees = extract.fit(pages)
    sources = {
        "just plain text": "just plain text", "<b>bold</b> and <a href=x>a link</a><br>next": "bold and a link next",
        "<html><body>bare body &amp; text</body></html>": "bare body & text", "<nav>Home</nav>tail": "tail",
        "<nav><a href=x>Home</a></nav>": "", "": "",
    }
    assert extract.texts(list(sources), trees) == list(sources.values())


def test_the_sample_is_of_marked_pages(spark, monkeypatch):
    """However rare they are."""
    monkeypatch.setattr(extract, "TRAIN_PAGES", 3)
    marked = "<body><nav><p>menu</p></nav><article><p>" + "words of the story " * 9 + "</p></article></body>"
    rows = [(i, f"<p>plain {i}</p>") for i in range(200)] + [(500, marked)]
    pages = spark.createDataFrame(rows, "page_id long, html string")
    assert extract.fit(pages) is not None
    assert extract.fit(pages.filter("page_id < 200")) is None
    with pytest.raises(ValueError):
        extract.extract(pages.withColumn("text", pages.html), None, ["page_id", "text"])
