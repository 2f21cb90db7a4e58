"""Main text of web pages by a tree-structured graphical model over their elements.

A page is a tree of block elements with blocks of text as leaves (``html_tree``); branches without text
are cut off. Each node is in one of three states: boilerplate, content, or mixed (both kinds of text below
it; not for leaves). The model is a conditional random field on this tree: a node's potential is linear in
what it is (tag, what its class, id or role says, length and links of the text below it and its
share of the page), and potentials of parent and child tie their states, by the kind of child.
Sum-product message passing, once from the leaves up and once from the root down, gives exact
marginals. A block is main text if it is content with probability ``CUT`` or more.

Weights are trained on labelled pages, ``(html, main text)``, by the gradient of their likelihood:
features of the labelled states less those expected under the marginals. Labels are aligned with blocks by
order. Training reads at most ``TRAIN_PAGES`` pages of at most ``TRAIN_CHARS`` characters, which is the
only bound; the default labelled pages are those of ``page_samples``.

Messages run over all pages of a slice at once, one level of depth after the other, in numpy.

Text: character references are decoded, white space (of Unicode) within a block is one space, ``<br>``
is white space, blocks are trimmed and joined by two line breaks. Each table cell, list item and
heading is a block.

Defined cases: a null or empty page, or one without main text, has the empty text; equal marginals count as
content; pages of any length and depth are read whole; repeated rows and null ids are returned like others;
an empty table gives no rows. Of the input only the named columns are read, so others never clash.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.html_tree import HINT_KINDS, Tree, tree_of
from tidegauge.llm.page_samples import labelled_pages
from tidegauge.llm.textbytes import map_texts, sliced, text_of

BOILER, CONTENT, MIXED = range(3)
CUT = 0.5
TRAIN_PAGES, TRAIN_CHARS = 300, 200_000
ROUNDS, STEP, SHRINK = 200, 0.2, 1e-3
NEVER = -1e6

TAGS = (
    "article main section div p li ul ol h1 h2 h3 nav header footer aside form table tr td blockquote figure"
    " figcaption pre dl dd body"
).split()
TAG_AT = {tag: k for k, tag in enumerate(TAGS)}
HINT_AT = {kind: k for k, kind in enumerate((*HINT_KINDS, "hidden"))}
WORDS_FROM = np.array([1, 3, 6, 12, 25, 60, 200])
SHARE_FROM = np.array([0.02, 0.1, 0.3, 0.6, 0.95])
LINKED_FROM = np.array([0.001, 0.2, 0.6, 0.95])
#: Kinds of child, each with its own potentials of parent and child.
LEAF, TEXT_BLOCK, BOX, HINTED = range(4)
MAIN = frozenset({"main"})
TEXT_BLOCKS = frozenset("p li h1 h2 h3 h4 h5 h6 td th dt dd pre figcaption caption address legend summary".split())
N_FEATURES = 2 + 1 + len(TAGS) + len(HINT_AT) + len(WORDS_FROM) + len(SHARE_FROM) + 2 * len(LINKED_FROM) + 1


@dataclass
class Forest:
    """The nodes of several pages, without branches that hold no text."""

    page: np.ndarray
    parent: np.ndarray
    levels: list[np.ndarray]
    kind: np.ndarray
    features: np.ndarray
    texts: list[str]
    leaf: np.ndarray

    @classmethod
    def of(cls, trees: list[Tree]) -> Forest:
        page, parent, depth, tag, hint, text, linked = [], [], [], [], [], [], []
        for k, tree in enumerate(trees):
            used = [bool(t) for t in tree.text]
            for node in range(len(used) - 1, 0, -1):
                if used[node]:
                    used[tree.parent[node]] = True
            at = {}
            for node in range(len(used)):
                if used[node]:
                    up = at.get(tree.parent[node], -1)
                    at[node] = len(page)
                    page.append(k)
                    parent.append(up)
                    depth.append(depth[up] + 1 if up >= 0 else 0)
                    tag.append(tree.tag[node])
                    hint.append(tree.hints[node])
                    text.append(tree.text[node])
                    linked.append(tree.linked[node])
        page, parent, depth = (np.array(x, np.int64) for x in (page, parent, depth))
        order = np.argsort(depth, kind="stable")
        levels = np.split(order, np.flatnonzero(np.diff(depth[order])) + 1) if len(order) else []
        leaf = np.array([not t for t in tag], bool)
        kind = np.array(
            [LEAF if not t else HINTED if h - MAIN else TEXT_BLOCK if t in TEXT_BLOCKS else BOX for t, h in zip(tag, hint, strict=True)],
            np.int64,
        )
        features = described(parent, levels, tag, hint, text, np.array(linked, float), page, len(trees))
        return cls(page, parent, levels, kind, features, text, leaf)


def described(parent, levels, tag, hint, text, linked, page, pages) -> np.ndarray:
    """One row of features for each node."""
    n = len(tag)
    chars = np.array([len(t) for t in text], float)
    count = np.array([t.count(" ") + 1 if t else 0 for t in text], float)
    below = np.column_stack([chars, count, linked]).reshape(n, 3)
    for level in reversed(levels[1:]):
        np.add.at(below, parent[level], below[level])
    chars, count, linked = below.T
    total = np.zeros(pages)
    if n:
        total[page[levels[0]]] = chars[levels[0]]
    out = np.zeros((n, N_FEATURES))
    leaf = np.array([not t for t in tag], bool)
    out[:, 0], out[:, 1], out[:, 2] = leaf, ~leaf, [bool(h - MAIN) for h in hint] if n else 0
    at = 3
    for k, t in enumerate(tag):
        if t in TAG_AT:
            out[k, at + TAG_AT[t]] = 1
        for h in hint[k]:
            out[k, at + len(TAGS) + HINT_AT[h]] = 1
    at += len(TAGS) + len(HINT_AT)

    def steps(values: np.ndarray, bounds: np.ndarray, where: np.ndarray | None = None) -> None:
        nonlocal at
        reached = values[:, None] >= bounds
        out[:, at : at + len(bounds)] = reached if where is None else reached & where[:, None]
        at += len(bounds)

    steps(count, WORDS_FROM)
    steps(chars / np.maximum(total[page], 1), SHARE_FROM)
    for where in (leaf, ~leaf):
        steps(linked / np.maximum(chars, 1), LINKED_FROM, where)
    out[:, at] = ["©" in t for t in text]
    return out


def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


@dataclass
class Model:
    """``own[f, s]``: weight of a feature in a state; ``tie[kind, parent state, child state]``."""

    own: np.ndarray
    tie: np.ndarray

    def marginals(self, forest: Forest) -> tuple[np.ndarray, np.ndarray]:
        """Of each node's state, and of the states of each node and its parent."""
        up = forest.features @ self.own
        up[forest.leaf, MIXED] = NEVER
        message = np.zeros_like(up)
        for level in reversed(forest.levels[1:]):  # from the leaves
            tied = self.tie[forest.kind[level]] + up[level][:, None, :]
            message[level] = log_sum(tied, 2)
            np.add.at(up, forest.parent[level], message[level])
        down = np.zeros_like(up)
        pairs = np.zeros((len(up), 3, 3))
        for level in forest.levels[1:]:  # from the root
            parent = forest.parent[level]
            rest = up[parent] + down[parent] - message[level]
            tied = self.tie[forest.kind[level]] + rest[:, :, None]
            down[level] = log_sum(tied, 1)
            tied = tied + up[level][:, None, :]
            tied -= tied.max(axis=(1, 2), keepdims=True)
            pairs[level] = np.exp(tied)
            pairs[level] /= pairs[level].sum(axis=(1, 2), keepdims=True)
        both = up + down
        both -= both.max(axis=1, keepdims=True, initial=NEVER)
        own = np.exp(both)
        return own / own.sum(axis=1, keepdims=True), pairs


def labelled_states(forest: Forest, wanted: list[str]) -> np.ndarray:
    """Each node's labelled state: a block is content if it is the next block of its page's main text."""
    left = [[b for b in t.split("\n\n") if b][::-1] for t in wanted]
    content, boiler = np.zeros(len(forest.page), bool), np.zeros(len(forest.page), bool)
    for k in np.flatnonzero(forest.leaf).tolist():
        rest = left[forest.page[k]]
        if rest and rest[-1] == forest.texts[k]:
            rest.pop()
            content[k] = True
        else:
            boiler[k] = True
    for level in reversed(forest.levels[1:]):
        np.logical_or.at(content, forest.parent[level], content[level])
        np.logical_or.at(boiler, forest.parent[level], boiler[level])
    return np.where(content & boiler, MIXED, np.where(content, CONTENT, BOILER))


def trained(pages: list[tuple[str, str]], rounds: int = ROUNDS) -> Model:
    """The weights under which the labelled states are most likely, by Adam steps along the gradient."""
    forest = Forest.of([tree_of(page) for page, _ in pages])
    state = labelled_states(forest, [text for _, text in pages])
    # A page counts as much as the root of its size, so that long pages do not drown the others.
    weight = 1 / np.sqrt(np.bincount(forest.page, minlength=len(pages)))[forest.page]
    weight = (weight / max(1.0, weight.sum()))[:, None]
    described_by = (forest.features * weight).T
    seen_own = described_by @ np.eye(3)[state]
    child = np.flatnonzero(forest.parent >= 0)
    seen_tie = np.zeros((4, 3, 3))
    np.add.at(seen_tie, (forest.kind[child], state[forest.parent[child]], state[child]), weight[child, 0])
    model = Model(np.zeros((N_FEATURES, 3)), np.zeros((4, 3, 3)))
    moments = [[np.zeros_like(x), np.zeros_like(x)] for x in (model.own, model.tie)]
    for t in range(1, rounds + 1):
        own, pairs = model.marginals(forest)
        met_tie = np.zeros((4, 3, 3))
        np.add.at(met_tie, forest.kind[child], pairs[child] * weight[child, :, None])
        for x, seen, met, (m, v) in zip(
            (model.own, model.tie), (seen_own, seen_tie), (described_by @ own, met_tie), moments, strict=True
        ):
            slope = seen - met - SHRINK * x / 100
            m += 0.1 * (slope - m)
            v += 0.01 * (slope * slope - v)
            x += STEP * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return model


def fit(labelled: DataFrame, html_col: str = "html", text_col: str = "text") -> Model:
    """A model from labelled pages; of more than ``TRAIN_PAGES``, those of the smallest hashes."""
    fits = labelled.where(F.length(html_col) <= TRAIN_CHARS).select(html_col, F.coalesce(text_col, F.lit("")))
    rows = fits.orderBy(F.xxhash64(*fits.columns), *fits.columns).limit(TRAIN_PAGES).collect()
    return trained([(r[0], r[1]) for r in rows])


def default_model() -> Model:
    """Trained on the pages of ``page_samples``."""
    return trained(labelled_pages(TRAIN_PAGES))


def main_texts(pages: Sequence[str | None], model: Model, cut: float = CUT) -> list[str]:
    forest = Forest.of([tree_of(page) for page in pages])
    own, _ = model.marginals(forest)
    kept: list[list[str]] = [[] for _ in pages]
    for k in np.flatnonzero(forest.leaf & (own[:, CONTENT] >= cut)).tolist():
        kept[forest.page[k]].append(forest.texts[k])
    return ["\n\n".join(blocks) for blocks in kept]


def extract(
    pages: DataFrame, model: Model, keep: Sequence[str] = ("page_id", "url"), html_col: str = "html", cut: float = CUT
) -> DataFrame:
    """The ``keep`` columns of every page and its main text, ``text``."""
    own = pages.select(*(F.col(c).alias(f"k{i}") for i, c in enumerate(keep)), F.col(html_col).alias("page"))
    shared = pages.sparkSession.sparkContext.broadcast(model)  # some kB

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "page"):
            texts = main_texts(text_of(batch, "page").to_pylist(), shared.value, cut)
            columns = [*batch.columns[:-1], pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], "text"])

    kinds = ", ".join(f"k{i} {own.schema[i].dataType.simpleString()}" for i in range(len(keep)))
    found = map_texts(own, work, f"{kinds}, text string" if keep else "text string")
    return found.select(*(F.col(f"k{i}").alias(c) for i, c in enumerate(keep)), "text")
