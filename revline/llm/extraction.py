"""Main text of web pages by a tree-structured graphical model.

Every element of a page's DOM is a binary variable: is its own text content? A node
potential weighs what the element says of itself (name, class words, how much text
and how much of it in links), a parent-child potential how labels go together along
an edge, by the kind of the child. On a tree the marginals are exact: messages pass
upward from the leaves, then downward from the page, and the text of the elements
with a marginal of one half or more is the main text. Weights maximise the
likelihood of labelled pages; its gradient is what the labels say less what the
marginals expect.

All pages of a batch are one forest: a step of a pass takes all elements of one depth.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revline.llm import labelled_pages, textvec
from revline.llm.dom import BLOCK, Page

#: kinds of children with a potential of their own
INLINE, TEXT_BLOCK, PARTS, BESIDE, MAIN, CONTAINER = range(6)
KINDS = 6
_KIND = ({t: CONTAINER for t in BLOCK}
         | dict.fromkeys("p h1 h2 h3 h4 h5 h6 li blockquote pre dd dt td th figcaption caption summary".split(),
                         TEXT_BLOCK)
         | dict.fromkeys("ul ol dl table tbody thead tfoot tr figure".split(), PARTS)
         | dict.fromkeys("header footer aside nav form".split(), BESIDE)
         | dict.fromkeys("article main".split(), MAIN))


@dataclass(frozen=True)
class Model:
    """Weights by feature, and of an edge by (kind of child, parent's label, child's label)."""

    weights: dict[str, float]
    edges: tuple


def _level(n: int, limits: tuple[int, ...]) -> int:
    return sum(n >= k for k in limits)


def describe(page: Page) -> list[list[str]]:
    """Features of every element of a page."""
    n = len(page.tag)
    own, linked = [0] * n, [0] * n
    commas, stops = [False] * n, [False] * n
    in_link = [False] * n
    for v in range(1, n):
        in_link[v] = page.tag[v] == "a" or in_link[page.parent[v]]
    for v, text in page.runs:
        if v >= 0:
            words = len(text.split())
            own[v] += words
            linked[v] += words if in_link[v] else 0
            commas[v] = commas[v] or "," in text
            stops[v] = stops[v] or "." in text or "!" in text or "?" in text
    below, below_linked = own[:], linked[:]
    for v in range(n - 1, 0, -1):
        below[page.parent[v]] += below[v]
        below_linked[page.parent[v]] += below_linked[v]
    whole = max(1, below[0] - below_linked[0])  # words of the page outside links
    out = []
    for v in range(n):
        said = ["all", "tag " + page.tag[v], f"own {_level(own[v], (1, 5, 15, 40))}"]
        if below[v]:
            said.append(f"links {_level(100 * below_linked[v] // below[v], (1, 25, 50, 80))}")
            if _KIND.get(page.tag[v], INLINE) >= BESIDE:
                plain = below[v] - below_linked[v]
                said.append(f"share {_level(100 * plain // whole, (3, 15, 40, 70))}")
        if own[v]:
            said.append(f"commas {commas[v]}")
            said.append(f"stops {stops[v]}")
        if in_link[v]:
            said.append("in a link")
        for w in page.words[v]:
            said.append("word " + w)
            if len(w) > 5:
                said.append("start " + w[:5])
        out.append(said)
    return out


class Forest:
    """Elements of several pages, by depth, with their features as rows of a sparse matrix."""

    def __init__(self, pages: list[Page], ids: dict[str, int]):
        self.first = np.cumsum([0] + [len(p.tag) for p in pages])
        self.size = int(self.first[-1])
        parent, kind, depth, row, col = [], [], [], [], []
        for page, base in zip(pages, self.first.tolist(), strict=False):
            at = len(depth)
            for v, (p, tag) in enumerate(zip(page.parent, page.tag, strict=True)):
                parent.append(base + p if p >= 0 else -1)
                kind.append(_KIND.get(tag, INLINE))
                depth.append(depth[at + p] + 1 if p >= 0 else 0)
            for v, said in enumerate(describe(page)):
                known = [ids[s] for s in said if s in ids]
                col += known
                row += [base + v] * len(known)
        self.parent, self.kind = np.array(parent, np.int64), np.array(kind, np.int64)
        self.row, self.col = np.array(row, np.int64), np.array(col, np.int64)
        depth = np.array(depth, np.int64)
        order = np.argsort(depth, kind="stable")
        cuts = np.flatnonzero(np.diff(depth[order])) + 1
        self.levels = np.split(order, cuts) if order.size else []

    def scores(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights[self.col], minlength=self.size)


def sum_product(forest: Forest, score: np.ndarray, edge: np.ndarray):
    """Marginal of label 1 of every element and, of every edge, of the label pairs.

    ``score``: log potential of label 1 against 0; ``edge``: log potentials by kind
    of child, parent's label and child's. Messages are log ratios.
    """
    e = edge[forest.kind]
    up, sent = score.copy(), np.zeros(forest.size)
    for level in forest.levels[:0:-1]:
        u, k = up[level], e[level]
        sent[level] = (np.logaddexp(k[:, 1, 0], k[:, 1, 1] + u)
                       - np.logaddexp(k[:, 0, 0], k[:, 0, 1] + u))
        np.add.at(up, forest.parent[level], sent[level])
    down, beside = np.zeros(forest.size), np.zeros(forest.size)
    for level in forest.levels[1:]:
        p, k = forest.parent[level], e[level]
        c = beside[level] = up[p] + down[p] - sent[level]  # the parent without this child
        down[level] = np.logaddexp(k[:, 0, 1], k[:, 1, 1] + c) - np.logaddexp(k[:, 0, 0], k[:, 1, 0] + c)
    marginal = 1 / (1 + np.exp(-np.clip(up + down, -700, 700)))
    pair = e.copy()
    pair[:, 1, :] += beside[:, None]
    pair[:, :, 1] += up[:, None]
    pair = np.exp(pair - pair.max((1, 2), keepdims=True))
    return marginal, pair / pair.sum((1, 2), keepdims=True)


def _labels(page: Page, bare: bool) -> list[int]:
    """An element has its own mark, or else its parent's label."""
    out: list[int] = []
    for v, p in enumerate(page.parent):
        out.append(int(page.marks[v]) if v in page.marks else int(bare) if p < 0 else out[p])
    return out


def train(marked: list[tuple[str, bool]] | None = None, steps: int = 400, penalty: float = 0.2,
          rate: float = 0.1) -> Model:
    """A model from labelled pages (``labelled_pages.pages`` by default), the same at every run.

    ``marked``: (page with ``y`` marks, whether text outside any element is content).
    """
    marked = labelled_pages.pages() if marked is None else marked
    pages = [Page(html, mark="y") for html, _ in marked]
    truth = np.array([y for p, (_, bare) in zip(pages, marked, strict=True) for y in _labels(p, bare)], float)
    ids: dict[str, int] = {}
    for page in pages:
        for said in describe(page):
            for s in said:
                ids.setdefault(s, len(ids))
    forest = Forest(pages, ids)
    weights, edge = np.zeros(len(ids)), np.zeros((KINDS, 2, 2))
    inner = np.flatnonzero(forest.parent >= 0)
    above, below = truth[forest.parent[inner]].astype(int), truth[inner].astype(int)
    seen = np.zeros((KINDS, 2, 2))
    np.add.at(seen, (forest.kind[inner], above, below), 1)
    said = np.bincount(forest.col, truth[forest.row], minlength=len(ids))
    moments = [np.zeros_like(weights), np.zeros_like(weights), np.zeros_like(edge), np.zeros_like(edge)]
    for t in range(1, steps + 1):
        marginal, pair = sum_product(forest, forest.scores(weights), edge)
        expected = np.zeros((KINDS, 2, 2))
        np.add.at(expected, forest.kind[inner], pair[inner])
        gradients = (said - np.bincount(forest.col, marginal[forest.row], minlength=len(ids))
                     - penalty * weights,
                     seen - expected - penalty * edge)
        for k, (theta, g) in enumerate(zip((weights, edge), gradients, strict=True)):
            first, second = moments[2 * k], moments[2 * k + 1]
            first += 0.1 * (g - first)
            second += 0.001 * (g * g - second)
            theta += rate * (first / (1 - 0.9 ** t)) / (np.sqrt(second / (1 - 0.999 ** t)) + 1e-9)
    return Model({s: float(weights[i]) for s, i in ids.items()}, tuple(edge.ravel().tolist()))


def _extract(model: Model, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = {s: i for i, s in enumerate(model.weights)}
        weights = np.fromiter(model.weights.values(), float, len(ids))
        edge = np.array(model.edges).reshape(KINDS, 2, 2)
        for batch in textvec.small_batches(batches, "_html", 2 * textvec.MAX_BYTES):
            pages = [Page(h) for h in batch.column("_html").to_pylist()]
            forest = Forest(pages, ids)
            marginal, _ = sum_product(forest, forest.scores(weights), edge)
            taken = marginal >= least
            texts = []
            for page, base in zip(pages, forest.first.tolist(), strict=False):
                said = [text for v, text in page.runs if v < 0 or taken[base + v]]
                texts.append(" ".join("".join(said).split()))
            names = [c for c in batch.schema.names if c != "_html"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())],
                [*names, "text", "n_chars"])
    return run


def extract_main_text(pages: DataFrame, model: Model, keys: tuple[str, ...] = ("page_id", "url"),
                      html_col: str = "html", least: float = 0.5) -> DataFrame:
    """Main text of every page: its blocks in page order, joined by one space.

    Columns: ``keys``, text, n_chars (code points). Character references are decoded,
    white space is one space.

    Defined cases: null or empty html, and pages without content, have an empty text;
    tags that are not closed, or closed in the wrong order, are read as browsers
    do, an unfinished tag or comment ends the page; rows that repeat give equal rows;
    very long pages are read whole, deep nesting costs a step a level. Other columns
    are ignored, keys may be null; no rows give no rows.
    """
    fields = [pages.schema[k] for k in keys]
    rows = pages.select(*(F.col(f.name).alias(f"_k{i}") for i, f in enumerate(fields)),
                        F.coalesce(F.col(html_col), F.lit("")).alias("_html"))
    schema = "".join(f"_k{i} {f.dataType.simpleString()}, " for i, f in enumerate(fields))
    out = rows.mapInArrow(_extract(model, least), schema + "text string, n_chars bigint")
    return out.select(*(F.col(f"_k{i}").alias(f.name) for i, f in enumerate(fields)), "text", "n_chars")
