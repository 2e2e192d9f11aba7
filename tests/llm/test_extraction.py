import html
import itertools
import math
import random
import re

import numpy as np
import pytest

from revline.llm import extraction, labelled_pages
from revline.llm.dom import Page

SCHEMA = "page_id long, url string, html string, text string, _html string, _k0 string"


@pytest.fixture(scope="module")
def model():
    return extraction.train()


def tree(page):
    return [(page.tag[v], page.parent[v]) for v in range(1, len(page.tag))]


def read(page):
    return " ".join("".join(t for _, t in Page(page).runs).split())


def test_messages_give_the_marginals_of_all_labelings():
    rng = random.Random(2)
    for _ in range(20):
        pages = [Page("".join(rng.choice(("<div>", "<p>", "</div>", "<b>", "x, y.", "<main>", "</b>"))
                              for _ in range(9))) for _ in range(2)]
        ids = {s: i for i, s in enumerate(sorted({s for p in pages for d in extraction.describe(p) for s in d}))}
        forest = extraction.Forest(pages, ids)
        weights = np.array([rng.uniform(-2, 2) for _ in ids])
        edge = np.array([rng.uniform(-2, 2) for _ in range(extraction.KINDS * 4)]).reshape(-1, 2, 2)
        score = forest.scores(weights)
        marginal, pair = extraction.sum_product(forest, score, edge)
        for a, b in itertools.pairwise(forest.first):
            total, ones, pairs = 0.0, np.zeros(b - a), np.zeros((b - a, 2, 2))
            for labels in itertools.product((0, 1), repeat=b - a):
                e = sum(score[a + v] * y for v, y in enumerate(labels))
                e += sum(edge[forest.kind[a + v], labels[forest.parent[a + v] - a], labels[v]]
                         for v in range(1, b - a))
                w = math.exp(e)
                total += w
                ones += w * np.array(labels)
                for v in range(1, b - a):
                    pairs[v, labels[forest.parent[a + v] - a], labels[v]] += w
            assert np.allclose(marginal[a:b], ones / total)
            assert np.allclose(pair[a + 1:b], pairs[1:] / total)


def test_training_raises_the_likelihood_until_moments_meet(model):
    """At the optimum expected and labelled counts differ by the penalty alone."""
    marked = labelled_pages.pages()
    pages = [Page(h, mark="y") for h, _ in marked]
    ids = {s: i for i, s in enumerate(model.weights)}
    forest = extraction.Forest(pages, ids)
    weights = np.array(list(model.weights.values()))
    marginal, _ = extraction.sum_product(forest, forest.scores(weights),
                                         np.array(model.edges).reshape(-1, 2, 2))
    truth = np.array([y for p, (_, b) in zip(pages, marked, strict=True) for y in extraction._labels(p, b)])
    gap = (np.bincount(forest.col, truth[forest.row]) - np.bincount(forest.col, marginal[forest.row])
           - 0.2 * weights)
    assert np.abs(gap).max() < 0.02 * len(pages)
    assert ((marginal >= 0.5) == truth).mean() > 0.97


def test_unseen_pages_of_the_layouts(model):
    marked = labelled_pages.pages(3, seed=987)
    pages = [Page(h, mark="y") for h, _ in marked]
    ids = {s: i for i, s in enumerate(model.weights)}
    forest = extraction.Forest(pages, ids)
    marginal, _ = extraction.sum_product(forest, forest.scores(np.array(list(model.weights.values()))),
                                         np.array(model.edges).reshape(-1, 2, 2))
    truth = np.array([y for p, (_, b) in zip(pages, marked, strict=True) for y in extraction._labels(p, b)])
    assert ((marginal >= 0.5) == truth).mean() > 0.93


@pytest.mark.parametrize("page, want", [
    ("<p>a<p>b<div>c</div>d", [("p", 0), ("p", 0), ("div", 0)]),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", [("ul", 0), ("li", 1), ("li", 1), ("ul", 3), ("li", 4), ("li", 1)]),
    ("<table><tr><td>a<td>b<tr><td>c</table>x", [("table", 0), ("tr", 1), ("td", 2), ("td", 2), ("tr", 1), ("td", 5)]),
    ("<div><b>x</div></b><i>y", [("div", 0), ("b", 1), ("i", 0)]),
    ("<html><head><title>t</title><p>x", [("html", 0), ("p", 1)]),
    ("<html><body><p>x</body></html><p>y", [("html", 0), ("body", 1), ("p", 2), ("p", 2)]),
    ("<h1>a<h2>b</h1>c", [("h1", 0), ("h2", 0)]),
    ("<a>x<a>y</a>", [("a", 0), ("a", 0)]),
    ("<td><p>x</td></p>", [("td", 0), ("p", 1)]),
    ("<dl><dt>a<dd>b<dt>c</dl>", [("dl", 0), ("dt", 1), ("dd", 1), ("dt", 1)]),
])
def test_trees_of_untidy_pages(page, want):
    assert tree(Page(page)) == want


@pytest.mark.parametrize("page, want", [
    ("a<b>b</b>c<p>d<br>e</p>f", "abc d e f"),
    ("x &amp; y &lt;b&gt; &#233;&nbsp;&#x4e2d; &am &copy", "x & y <b> é 中 &am ©"),
    ("<script>var a='</p>'</script>x<style>p{}</style>y<!-- <p>no</p> -->z", "xyz"),
    ("<SCRIPT>a</scripty></SCRIPT >b", "b"),
    ("a<!-->b<!--->c<!-- d --!>e<!x>f<?php g ?>h</>i", "abcefhi"),
    ("a < b <1 <a href='x>y' title=\"</a>\">c</a>", "a < b <1 c"),
    ("x<textarea><p>no</textarea><select><option>no</select><svg><text>no</text></svg>y", "xy"),
    ("x<a href=\"never closed>y<p>z", "x"),
    ("x<!-- never closed <p>y", "x"),
    ("x<p", "x"),
    ("x<script>y", "x"),
    ("  \n ", ""),
])
def test_text_of_untidy_pages(page, want):
    assert read(page) == want


def main_text(spark, model, pages):
    rows = [(k, None if k == 3 else f"u{k}", h, "clash", "clash", "clash") for k, h in enumerate(pages)]
    got = extraction.extract_main_text(spark.createDataFrame(rows, SCHEMA), model).collect()
    assert all(r.n_chars == len(r.text) for r in got)
    assert sorted((r.page_id, r.url) for r in got if r.url) == sorted(r[:2] for r in rows if r[1])
    return [r.text for r in sorted(got, key=lambda r: r.page_id)]


def test_parts_that_are_not_the_article(spark, model):
    page = ("<!DOCTYPE html><html><head><title>T</title></head><body><header><h1>Site</h1><p>Its motto, here.</p></header>"
            "<nav><a href=1>Home</a></nav><div class='sidebar'><p>Things to read, now.</p></div><article><h1>Title</h1>"
            "<p>First words, of some length.</p><div class='ad'>Buy this, now.</div><p>Short.</p><ul><li>one</li></ul></article>"
            "<section class='comments'><p>I liked it, very much.</p></section><div class='cookie'>We use cookies, sorry.</div>"
            "<form><p>Subscribe to our mail.</p></form><footer>&copy; us</footer></body></html>")
    texts = main_text(spark, model, [
        page, None, "", "<nav><a href=1>x</a></nav>", "no markup at all, but some words to read.",
        "<article><p>" + "long text, of words. " * 40_000 + "</p></article>", "<div>" * 20_000 + "x", page])
    whole = "Title First words, of some length. Short. one"
    assert texts[0] == texts[7] == whole
    assert texts[1:5] == ["", "", "", "no markup at all, but some words to read."]
    assert texts[5] == ("long text, of words. " * 40_000).strip()


def test_every_article_of_the_table(spark, model):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r.page_id: r.text for r in extraction.extract_main_text(pages, model).collect()}
    for r in pages.collect():
        body = re.search(r"<article>(.*)</article>", r.html, re.S).group(1)
        body = re.sub(r"</?b>", "", re.sub(r"</?(?:p|h1|br)>", " ", body))
        assert got[r.page_id] == " ".join(html.unescape(body).split())


def test_empty_table(spark, model):
    assert main_text(spark, model, []) == []
