import html
import itertools
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegauge.llm import html_extract
from tidegauge.llm.html_extract import CONTENT, Forest, Model, default_model, extract, fit, main_texts
from tidegauge.llm.html_tree import tree_of
from tidegauge.llm.page_samples import labelled_pages
from tidegauge.llm.queries import op11_html_tree_extraction


@pytest.fixture(scope="module")
def model():
    return default_model()


def blocks(page):
    return [t for t in tree_of(page).text if t]


@pytest.mark.parametrize(
    "page,expected",
    [
        (None, []),
        ("", []),
        ("just text &amp; &lt;b&gt; &eacute;&#233;&#x1F600;", ["just text & <b> éé😀"]),
        ("<p>one<p>two</p></p>three", ["one", "two", "three"]),
        ("<p>a <b>bold</b> <i>word</i><br>next\n\t line </p>", ["a bold word next line"]),
        ("<div>head<p>in</p>tail</div>", ["head", "in", "tail"]),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", ["a", "b", "c", "d"]),
        ("<dl><dt>a<dd>b<dt>c</dl>", ["a", "b", "c"]),
        ("<table><tr><td>a<td>b<tr><th>c</table>d", ["a", "b", "c", "d"]),
        ("<script>var t='</p>';</SCRIPT>x<style>p{}</style >y", ["xy"]),
        ("x<script>never closed <p>y", ["x"]),
        ("<!-- <p>no</p> -->a<!-- open", ["a"]),
        ("<!DOCTYPE html><head><title>t</title></head><body>b</body></html>late", ["blate"]),
        ("<svg><text>s</text><svg></svg>t</svg>a<noscript><p>n</p></noscript><button>k</button>", ["a"]),
        ('<a href="x>y">in</a> 1 < 2 <3 </3 x>z', ["in 1 < 2 <3 z"]),
        ("<a title=don't>b</a> it's <p class='u", ["b it's"]),
        ("<b>x<p>y</b>z</p>w", ["x", "yz", "w"]),
        ("<h1>a<h2>b</h2>", ["a", "b"]),
        ("\x00 a b&nbsp;c", ["\x00 a b c"]),
        ("text <span class=advert>buy</span> more", ["text", "buy", "more"]),
    ],
)
def test_blocks_of_odd_pages(page, expected):
    assert blocks(page) == expected


def test_deep_and_long_pages(model):
    deep = "<div>" * 3000 + "x" + "</div>" * 3000
    assert blocks(deep) == ["x"]
    long = "<article><h1>t</h1>" + "".join(f"<p>paragraph {k} of many words here</p>" for k in range(20_000)) + "</article>"
    assert main_texts([long], model)[0].count("\n\n") == 20_000
    assert len(main_texts([deep, "<a>" * 5000, "</p>" * 5000, "<" * 5000, "<p " * 5000], model)) == 5


def test_marginals_are_sums_over_all_states():
    pages = ["<div><p>a</p><nav>b</nav></div>c", "", "<ul><li>x<li>y<p>z</ul>"]
    forest = Forest.of([tree_of(p) for p in pages])
    random = np.random.default_rng(2)
    model = Model(random.normal(size=(html_extract.N_FEATURES, 3)), random.normal(size=(4, 3, 3)))
    own, pairs = model.marginals(forest)
    score = forest.features @ model.own
    for page in (0, 2):
        nodes = np.flatnonzero(forest.page == page)
        at = {n: k for k, n in enumerate(nodes)}
        total, expected, both = 0.0, np.zeros((len(nodes), 3)), np.zeros((len(nodes), 3, 3))
        for states in itertools.product(range(3), repeat=len(nodes)):
            if any(forest.leaf[n] and states[at[n]] == 2 for n in nodes):
                continue
            up = [states[at[forest.parent[n]]] if forest.parent[n] >= 0 else None for n in nodes]
            tie = sum(model.tie[forest.kind[n], p, s] for n, p, s in zip(nodes, up, states) if p is not None)
            weight = np.exp(sum(score[n, s] for n, s in zip(nodes, states)) + tie)
            total += weight
            for k, s in enumerate(states):
                expected[k, s] += weight
                if up[k] is not None:
                    both[k, up[k], s] += weight
        assert np.allclose(own[nodes], expected / total, atol=1e-9)
        assert np.allclose(pairs[nodes], both / total, atol=1e-9)


def test_held_out_pages(model):
    pages = labelled_pages(200, seed=7)
    got = main_texts([p for p, _ in pages], model)
    assert sum(g == t for g, (_, t) in zip(got, pages)) >= 190


PAGE = """<html><body><header><a href=/>Site</a></header><nav><ul><li><a href=/a>A</a></li><li><a href=/b>B</a></li></ul></nav>
<div class="cookie-banner"><p>We use cookies. Please agree to them all.</p></div>
<div id="content"><h1>The title</h1><p>First paragraph, with some words &amp; signs.</p><div class="ad">Buy this now!</div>
<h2>Part</h2><p>Second.</p><ul><li>point one</li><li>point two</li></ul></div>
<aside class="sidebar"><h3>More</h3><p>Some other text of the sidebar.</p></aside>
<form><label>Mail</label><input name=m></form>
<section id="comments"><h3>Comments</h3><div class="comment"><b>Ann</b><p>I liked this very much. It is a long text too.</p></div></section>
<footer>&copy; 2024 Site</footer></body></html>"""


def test_page_with_everything(model):
    text = "The title\n\nFirst paragraph, with some words & signs.\n\nPart\n\nSecond.\n\npoint one\n\npoint two"
    assert main_texts([PAGE], model) == [text]


def test_operator_on_odd_tables(spark, model):
    rows = [(1, "u", PAGE, 1), (1, "u", PAGE, 1), (None, None, None, 2), (2, "", "", 3)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text long").withColumn("k0", F.lit(1))
    got = extract(df, model).collect()
    text = main_texts([PAGE], model)[0]
    found = sorted((r["page_id"] or 0, r["url"] or "", r["text"]) for r in got)
    assert found == [(0, "", ""), (1, "u", text), (1, "u", text), (2, "", "")]
    assert extract(df.limit(0), model).count() == 0
    assert extract(df, model, keep=()).columns == ["text"]


def test_fit_on_a_table(spark, monkeypatch):
    monkeypatch.setattr(html_extract, "TRAIN_PAGES", 60)
    rows = [*labelled_pages(80, seed=3), ("<p>x", None), (None, "y"), ("z" * 300_000, "")]
    own = fit(spark.createDataFrame(rows, "html string, text string"))
    pages = labelled_pages(60, seed=8)
    got = main_texts([p for p, _ in pages], own)
    assert sum(g == t for g, (_, t) in zip(got, pages)) >= 40
    empty = fit(spark.createDataFrame([], "html string, text string"))
    assert empty.marginals(Forest.of([tree_of("<p>x")]))[0][:, CONTENT].tolist() != []


def expected_text(page):
    article = re.search(r"(?s)<article>(.*?)(</article>|<footer>|\Z)", page)[1]
    parts = [" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
    return "\n\n".join(p for p in parts if p)


def test_query_on_pages(spark, sf):
    rows = op11_html_tree_extraction(spark, sf).collect()
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    assert len(rows) == len(pages)
    for r in rows:
        assert (r["url"], r["text"]) == (pages[r["page_id"]]["url"], expected_text(pages[r["page_id"]]["html"]))
        assert r["n_chars"] == len(r["text"])
