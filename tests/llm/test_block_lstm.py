"""Main text of pages: the parser on odd markup, the gradient, labels on the table's pages and on pages of other plans."""

import html
import re

import numpy as np
import pyarrow.parquet as pq
import pytest

from sparkfolio.llm import block_lstm as bl
from sparkfolio.llm import queries
from sparkfolio.llm.html_blocks import leaves
from tests.conftest import SF_MID, SF_SMALL

SCHEMA = "page_id long, url string, html string, text string, n_chars int, blocks int, n_blocks int, `a.b` int"


@pytest.fixture(scope="module")
def model(spark):
    return bl.train(spark.read.parquet(f"{SF_MID}/pages.parquet"))


def plain(page):
    """The article of the table's own plan, by hand: each of its paragraphs is a line."""
    inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    blocks = [" ".join(html.unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", b))).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
    return "\n".join(b for b in blocks if b)


def test_parser():
    def texts(page):
        return [b.text for b in leaves(page)]

    assert texts(None) == texts("") == texts("  <p> </p><!-- x -->") == []
    assert texts("a &amp; b&nbsp;&#65; &amp c &am") == ["a & b A & c &am"]
    assert texts("<p>one<br>two <b>three</b>four<p>five") == ["one two threefour", "five"]
    assert texts("<SCRIPT>var a='<p>x</p>';</script >t<style>p{}</STYLE><title>no</title><script>open <p>z") == ["t"]
    assert texts("x <!-- <p>c</p> --> y<!-- open <p>z") == ["x y"]
    assert texts('<div title="a > b" class=\'c\'>in</div><a href="x>y">l</a>') == ["in", "l"]
    assert texts('<p class="open>still</p><p>next</p>') == ["still", "next"]
    assert texts("1 < 2 <3 a<b>c</b> </nope> <") == ["1 < 2 <3 ac <"]
    assert texts("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>") == ["a", "b", "c", "d"]
    assert texts("<table><tr><td>1<td>2<tr><td>3</table>") == ["1", "2", "3"]
    assert [round(b.links, 1) for b in leaves("<p><a>four</a>four</p><p>none</p>")] == [0.5, 0.0]
    deep = "<div>" * 50_000 + "x" + "</div>" * 50_000
    assert texts(deep) == ["x"] and texts("<p>" * 20_000 + "y") == ["y"] and len(texts("<b>w</b><p>" * 20_000)) == 20_000
    long = "word " * 200_000
    assert texts(f"<p>{long}</p>") == [long.strip()]


def test_paths_close():
    nav, free = leaves("<nav><p>a</nav><div>b</div>")
    assert (bl.named([nav])[0].label, bl.named([free])[0].label) == ("0", "")


def test_gradient():
    """Against differences, for some numbers of each parameter."""
    plans = bl.Plans(["some words. and more"], ["link"], seed=1)
    pages = sorted((leaves(plans.page()) for _ in range(4)), key=len, reverse=True)
    coded, m = bl.encode(pages), bl.Labeller(seed=2)
    m.p = {k: v.astype(np.float64) for k, v in m.p.items()}
    rng = np.random.default_rng(0)
    n = int(coded.first[-1])
    y, weight = (rng.random(n) > 0.5).astype(float), np.ones(n)
    chosen = np.arange(len(pages))
    _, g = m.gradients(coded, chosen, y, weight)
    for name, value in m.p.items():
        flat, grad = value.reshape(-1), np.asarray(g[name]).reshape(-1)
        for i in np.argsort(-np.abs(grad))[:3]:
            keep, step = flat[i], 1e-2
            flat[i] = keep + step
            up, _ = m.gradients(coded, chosen, y, weight)
            flat[i] = keep - step
            down, _ = m.gradients(coded, chosen, y, weight)
            flat[i] = keep
            assert abs((up - down) / (2 * step) - grad[i]) < 2e-3 + 0.05 * abs(grad[i]), name


def test_order_of_pages_does_not_matter(model):
    plans = bl.Plans(["some words. and more"], ["link"], seed=3)
    pages = [leaves(plans.page()) for _ in range(30)] + [[]]
    together = model.scores(bl.encode(pages))
    apart = np.concatenate([model.scores(bl.encode([p])) for p in pages])
    assert np.allclose(together, apart, atol=1e-4)


def test_table(spark):
    pages = {r["page_id"]: r for r in pq.read_table(f"{SF_MID}/pages.parquet").to_pylist()}
    rows = queries.op11_block_labeller(spark, SF_MID).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r.text == plain(pages[r.page_id]["html"]) and r.n_chars == len(r.text) and r.url == pages[r.page_id]["url"]


def test_held_out_plans(model):
    """Other texts in plans that the model has not seen: nearly all blocks are right."""
    rows = pq.read_table(f"{SF_SMALL}/pages.parquet").to_pylist()
    blocks = [b for r in rows for b in bl.named(leaves(r["html"]))]
    plans = bl.Plans([b.text for b in blocks if b.label == "1"], [b.text for b in blocks if b.label == "0"], seed=77)
    pages = [leaves(plans.page()) for _ in range(200)]
    labels = np.array([b.label == "1" for p in pages for b in p])
    assert ((model.scores(bl.encode(pages)) >= 0.5) == labels).mean() > 0.97


def test_page_by_hand(spark, model):
    page = """<html><head><title>T</title></head><body><div id="cookie-bar">We use cookies <button>OK</button></div>
    <header><h1>Site</h1><nav><ul><li><a href=/>Home</a><li><a href=/n>News</a></ul></nav></header>
    <aside class=sidebar><h3>Popular</h3><p>A teaser about a thing in town.</p></aside>
    <main><article><h1>Title &amp; more</h1><p>First   paragraph of
    the article, with several words in it.</p><ul><li>one item</li><li>two items of it</li></ul>
    <p>Second paragraph<b> with bold</b> text.<blockquote>Quoted text stands here.</blockquote></article>
    <section class="comments"><h2>2 comments</h2><div class=comment><b>Joe</b><p>I liked this article very much.</p></div></section></main>
    <footer><p>All rights reserved.</p></footer><script>x("<p>no</p>")</script></body></html>"""
    want = ["Title & more", "First paragraph of the article, with several words in it.", "one item", "two items of it",
            "Second paragraph with bold text.", "Quoted text stands here."]
    df = spark.createDataFrame([(1, "u", page, "t", 1, 2, 3, 4)], SCHEMA)
    assert bl.main_text(df, model).first().text.split("\n") == want
    blocks = bl.labelled_blocks(df, model).first().blocks
    assert [b.text for b in blocks if b.main] == want and len(blocks) > len(want)


def test_odd_rows(spark, model):
    long = "<article>" + "<p>some words of a paragraph.</p>" * 30_000 + "</article>"
    rows = [(1, None, None), (2, "u", ""), (None, None, "<article><p>text</p></article>"), (3, "u", "no markup at all"), (3, "u", "no markup at all"),
            (4, "u", long), (5, "u", "<nav><a>x</a></nav>"), (6, "u", "\x00<p>� 🙂</p>")]
    df = spark.createDataFrame([(*r, "t", 1, 2, 3, 4) for r in rows], SCHEMA).repartition(3)
    got = sorted(((r.page_id, r.url, r.n_blocks, r.n_chars == len(r.text)) for r in bl.main_text(df, model).collect()), key=repr)
    assert got == sorted(((i, u, len(leaves(h)), True) for i, u, h in rows), key=repr)
    assert {r.page_id: r.text for r in bl.main_text(df, model).collect()}[4].count("\n") == 29_999
    assert [r.text for r in bl.main_text(df, model).filter("page_id in (1, 2, 5)").collect()] == ["", "", ""]
    none = spark.createDataFrame([], SCHEMA)
    assert bl.main_text(none).collect() == [] and bl.labelled_blocks(none, model).collect() == []
