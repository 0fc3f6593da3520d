"""Main text of web pages by a tree-structured graphical model over DOM nodes.

Every block element and every text block of a page is a variable with three
states: ``S`` structure (holds content and other things side by side), ``C``
content, ``B`` boilerplate. A node's own potential is a log-linear function of
its features (element, words in class, id and role, text length, share of
linked text, place on the page); parent-child potentials say how states go
together (nothing under boilerplate is content, an article may hold an
advert). On a tree, sum-product messages passed up to the root and down again
give exact marginals; a text block is content if its marginal of ``C`` is over
one half. Weights are fitted by maximum likelihood on labelled pages, whose
gradient is observed minus expected counts from the same two passes.

Messages run level by level over all pages of a batch at once. Pages are
independent: one map over the table, no shuffle, and the model is a few
hundred numbers.

The labelled pages are written by ``labelled_pages`` from page parts whose
state is known; ``fit`` takes any other ``(html, states)`` pages as well.

Null or empty html gives empty text. White space inside a block becomes one
space; blocks are joined by an empty line in page order; repeated pages give
equal texts; nothing is cut, however long. A block whose marginal is exactly one
half is left out. An empty table gives an empty result; only the html column is
read, so others may have any name.
"""

from __future__ import annotations

import itertools
import re
from dataclasses import dataclass
from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee.llm.html_tree import Page, attributes

STATES = ("S", "C", "B")
_MARK = "data-state"
_NODES = 200_000  # nodes whose messages run together
_RIDGE, _STEPS, _RATE = 0.02, 250, 0.3

# Words in class, id or role that hint at a part of a page.
CUES = {
    "content": "article articlebody body content entry main post story text prose richtext",
    "navigation": "nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager toc tabs topbar toolbar skip",
    "header": "header head masthead branding logo hero banner top",
    "footer": "footer foot bottom copyright legal colophon imprint contentinfo",
    "sidebar": "sidebar side aside widget widgets rail complementary panel col secondary",
    "advert": "ad ads adv advert adverts advertisement advertising adsbygoogle sponsor sponsored sponsors promo "
              "promotion promoted banner adbox adslot commercial dfp",
    "notice": "notice notices cookie cookies consent gdpr alert alerts warning popup modal overlay dialog message "
              "disclaimer paywall announcement toast",
    "comment": "comment comments commentlist reply replies respond disqus discussion reviews feedback",
    "form": "form search login signin signup register subscribe subscription newsletter contact input",
    "related": "related recommended recommendations more also share sharing social follow tags tag meta byline author "
               "bio popular trending latest teaser",
    "hidden": "hidden hide none sr visually screen",
}
# The same in German, French and Spanish, as they stand in ASCII class names.
CUES_ELSEWHERE = {
    "content": "inhalt hauptinhalt beitrag artikel contenu contenido articulo",
    "navigation": "menue hauptmenue navigationsleiste navegacion",
    "header": "kopf kopfzeile kopfbereich entete cabecera encabezado",
    "footer": "fuss fusszeile fussbereich impressum pied",
    "sidebar": "seitenleiste randspalte laterale lateral",
    "advert": "werbung anzeige anzeigen publicite publicidad anuncio anuncios",
    "notice": "hinweis hinweise meldung avis avertissement aviso avisos",
    "comment": "kommentar kommentare leserkommentare leserbriefe commentaire commentaires comentario comentarios",
    "form": "suche anmeldung formular recherche formulaire connexion buscar formulario",
    "related": "weitere empfehlungen teilen partager compartir relacionado relacionados",
}
_CUE_OF: dict[str, list[str]] = {}
for _kind, _words in [*CUES.items(), *CUES_ELSEWHERE.items()]:
    for _word in _words.split():
        _CUE_OF.setdefault(_word, []).append(_kind)
_SPLIT = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


def _cues(raw: str) -> set[str]:
    if not raw.strip():
        return set()
    found = attributes(raw)
    words = _SPLIT.findall(" ".join(found.get(k, "") for k in ("class", "id", "role", "itemprop")))
    kinds = {k for w in words for k in _CUE_OF.get(w.lower(), ())}
    if "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", ""):
        kinds.add("hidden")
    return kinds


def node_features(page: Page) -> list[list[str]]:
    """Names of the features that each node has."""
    n = len(page.tag)
    length, linked = [0] * n, [0] * n
    for i in range(n - 1, 0, -1):  # children follow their parents
        if page.tag[i] == "#text":
            length[i] += len(page.text[i])
            linked[i] += page.linked[i]
        length[page.parent[i]] += length[i]
        linked[page.parent[i]] += linked[i]
    out = []
    for i in range(n):
        tag = page.tag[i]
        share = linked[i] / length[i] if length[i] else 0.0
        link = "none" if share < 0.05 else "some" if share < 0.5 else "most"
        if tag == "#text":
            words = page.text[i].count(" ") + 1
            size = "1" if words < 4 else "4" if words < 12 else "12" if words < 30 else "30"
            names = ["text", f"words:{size}", f"text link:{link}", f"under:{page.tag[page.parent[i]]}"]
            if "©" in page.text[i]:
                names.append("copyright sign")
        else:
            names = ["element", f"tag:{tag}", f"link:{link}"]
            names += [f"cue:{c}" for c in sorted(_cues(page.attrs[i]))]
        out.append(names)
    return out


class Forest:
    """Many pages' trees as flat arrays, for messages level by level."""

    def __init__(self, pages: list[Page], feature_ids: dict[str, int], learn: bool = False):
        parent, kind, ids, edges, first = [], [], [], [0], 0
        self.offsets = [0]
        for page in pages:
            parent += [p + first if p >= 0 else -1 for p in page.parent]
            kind += [t == "#text" for t in page.tag]
            for names in node_features(page):
                if learn:
                    for name in names:
                        feature_ids.setdefault(name, len(feature_ids))
                ids += [feature_ids[x] for x in names if x in feature_ids]
                edges.append(len(ids))
            first += len(page.tag)
            self.offsets.append(first)
        self.parent, self.kind = np.array(parent, np.int64), np.array(kind, np.int64)
        self.node = np.repeat(np.arange(first), np.diff(edges))
        self.feature = np.array(ids, np.int64)
        depth = np.zeros(first, np.int64)
        for i, p in enumerate(parent):
            if p >= 0:
                depth[i] = depth[p] + 1
        order = np.argsort(depth, kind="stable")
        cuts = np.searchsorted(depth[order], np.arange(1, (depth.max(initial=0)) + 2))
        self.levels = [order[a:b] for a, b in zip([0, *cuts], cuts)]

    def own(self, weights: np.ndarray) -> np.ndarray:
        return np.column_stack([np.bincount(self.node, weights[self.feature, s], len(self.parent))
                                for s in range(len(STATES))])

    def marginals(self, weights: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """Node marginals, expected state pairs by kind of child, and the log partition sum."""
        own = self.own(weights)
        up = own.copy()                     # own potential and all messages from below
        message = np.zeros_like(own)        # of each node to its parent
        for level in self.levels[:0:-1]:
            message[level] = _log_sum(pair[self.kind[level]] + up[level][:, None, :], 2)
            np.add.at(up, self.parent[level], message[level])
        roots = self.levels[0]
        belief = up.copy()
        total = float(_log_sum(up[roots], 1).sum())
        expected = np.zeros_like(pair)
        for level in self.levels[1:]:
            above = belief[self.parent[level]] - message[level]   # parent without this child
            joint = above[:, :, None] + pair[self.kind[level]] + up[level][:, None, :]
            joint -= _log_sum(joint.reshape(len(level), -1), 1)[:, None, None]
            belief[level] = _log_sum(above[:, :, None] + pair[self.kind[level]], 1) + up[level]
            np.add.at(expected, self.kind[level], np.exp(joint))
        return np.exp(belief - _log_sum(belief, 1)[:, None]), expected, total


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


@dataclass
class Model:
    features: dict[str, int]
    weights: np.ndarray  # (features, states)
    pair: np.ndarray     # (element or text child, parent state, child state)

    def content(self, pages: list[Page]) -> list[np.ndarray]:
        """Per page, the marginal of content of each node."""
        forest = Forest(pages, self.features)
        found, _, _ = forest.marginals(self.weights, self.pair)
        return [found[a:b, 1] for a, b in zip(forest.offsets, forest.offsets[1:])]


def _states(page: Page) -> list[int]:
    """States of a labelled page: from the marks, else inherited; text under structure is boilerplate."""
    out: list[int] = []
    for i, tag in enumerate(page.tag):
        above = out[page.parent[i]] if page.parent[i] >= 0 else 0
        marked = attributes(page.attrs[i]).get(_MARK) if page.attrs[i] else None
        state = STATES.index(marked) if marked else above
        out.append(2 if tag == "#text" and state == 0 else state)
    return out


def fit(labelled: list[str]) -> Model:
    """Maximum-likelihood weights from pages whose elements carry their states in ``data-state``."""
    pages = [Page(source) for source in labelled]
    ids: dict[str, int] = {}
    forest = Forest(pages, ids, learn=True)
    state = np.array([s for p in pages for s in _states(p)], np.int64)
    seen = np.zeros((len(ids), len(STATES)))
    np.add.at(seen, (forest.feature, state[forest.node]), 1)
    seen_pair = np.zeros((2, len(STATES), len(STATES)))
    child = np.flatnonzero(forest.parent >= 0)
    np.add.at(seen_pair, (forest.kind[child], state[forest.parent[child]], state[child]), 1)
    weights, pair = np.zeros_like(seen), np.zeros_like(seen_pair)
    steps_w, steps_p = np.full_like(weights, 1e-8), np.full_like(pair, 1e-8)
    for _ in range(_STEPS):  # gradient ascent with a step size for each weight
        found, expected, _ = forest.marginals(weights, pair)
        expected_w = np.column_stack([np.bincount(forest.feature, found[forest.node, s], len(ids))
                                      for s in range(len(STATES))])
        g_w, g_p = seen - expected_w - _RIDGE * weights, seen_pair - expected - _RIDGE * pair
        steps_w += g_w ** 2
        steps_p += g_p ** 2
        weights += _RATE * g_w / np.sqrt(steps_w)
        pair += _RATE * g_p / np.sqrt(steps_p)
    return Model(ids, weights, pair)


def labelled_pages() -> list[str]:
    """Training pages put together from parts of known state, in many arrangements."""
    words = "lorem ipsum dolor sit amet consetetur sadipscing elitr sed diam nonumy eirmod tempor invidunt ut".split()
    turn = itertools.count()

    def say(n: int, stop: str = ".") -> str:
        k = next(turn)
        return " ".join(words[(k * 7 + j) % len(words)] for j in range(n)).capitalize() + stop

    def links(n: int) -> str:
        return "".join(f'<li><a href="/{j}">{say(1 + j % 2, "")}</a></li>' for j in range(n))

    def paragraphs(*sizes: int) -> str:
        return "".join(f"<p>{say(n)}</p>" for n in sizes)

    bodies = [  # content, by what holds it
        lambda: f"<article {_MARK}=C><h1>{say(5, '')}</h1>{paragraphs(30, 3, 18, 60)}</article>",
        lambda: f"<main {_MARK}=S><article {_MARK}=C><h1>{say(4, '')}</h1><p><b>{say(9)}<br><p>{say(40)}</p>"
                f"<h2>{say(3, '')}</h2><ul><li>{say(6)}</li><li>{say(2)}</li></ul>{paragraphs(12)}</article></main>",
        lambda: f'<div class="content" {_MARK}=C><h1>{say(3, "")}</h1>{paragraphs(25, 40, 2)}'
                f"<blockquote><p>{say(14)}</p></blockquote><pre>{say(8)}</pre></div>",
        lambda: f'<div class="post-body" {_MARK}=C><h2>{say(6, "")}</h2><div>{say(50)}</div><div>{say(5)}</div></div>',
        lambda: f'<div id="x1" {_MARK}=C><h1>{say(7, "")}</h1>{paragraphs(35, 28, 44)}<table><tr><td>{say(2, "")}</td>'
                f"<td>{say(3, '')}</td></tr></table></div>",
        lambda: f"<section {_MARK}=C><h1>{say(4, '')}</h1>{paragraphs(22, 1, 33)}<figure><figcaption>{say(8)}"
                f"</figcaption></figure><p>{say(20)} <a href=/y>{say(2, '')}</a> {say(9)}</p></section>",
        lambda: f"<h1 {_MARK}=C>{say(5, '')}</h1>" + "".join(f"<p {_MARK}=C>{say(n)}</p>" for n in (40, 26, 3)),
        lambda: f'<article class="story" {_MARK}=C><h1>{say(4, "")}</h1>{paragraphs(24)}<div class="advertisement" '
                f'{_MARK}=B><p>{say(12)}</p></div>{paragraphs(31, 6)}<div class="share" {_MARK}=B><ul>{links(3)}</ul>'
                f"</div><aside {_MARK}=B><p>{say(16)}</p></aside></article>",
        lambda: f"<article {_MARK}=C><p>{say(2)}</p></article>",
        lambda: f"<article {_MARK}=C><h1>{say(3, '')}</h1><p>{say(150)}</p>{paragraphs(80)}"
                f'<p class="cookie-notice" {_MARK}=B>{say(11)}</p><form {_MARK}=B><p>{say(4)}</p></form></article>',
    ]
    before = [
        lambda: f"<nav {_MARK}=B><ul>{links(5)}</ul></nav><div class=ad {_MARK}=B>{say(8)}</div>",
        lambda: f"<header {_MARK}=B><h1>{say(2, '')}</h1><p>{say(7)}</p><nav><ul>{links(4)}</ul></nav></header>",
        lambda: f'<div class="top-menu" {_MARK}=B><ul>{links(6)}</ul></div><div class="cookie-banner" {_MARK}=B>'
                f"<p>{say(22)}</p><button>{say(1, '')}</button></div>",
        lambda: f'<div id="masthead" {_MARK}=B><div>{say(3, "")}</div></div><ul class="breadcrumbs" {_MARK}=B>'
                f"{links(3)}</ul>",
        lambda: f'<div role="alert" class="notice" {_MARK}=B>{say(18)}</div><form class="search" {_MARK}=B><p>{say(3)}</p>'
                f"</form>",
        lambda: f'<aside {_MARK}=B><h3>{say(2, "")}</h3>{paragraphs(25, 30)}<ul>{links(4)}</ul></aside>',
        lambda: "",
    ]
    after = [
        lambda: f"<footer {_MARK}=B>© {say(4, '')} · {say(12)}</footer>",
        lambda: f'<section id="comments" {_MARK}=B><h2>{say(2, "")}</h2><article class="comment">{paragraphs(28)}</article>'
                f'<article class="comment"><p>{say(15)}</p></article></section><footer {_MARK}=B><p>{say(20)}</p></footer>',
        lambda: f'<div class="sidebar" {_MARK}=B><div class="widget"><h3>{say(2, "")}</h3><p>{say(26)}</p></div></div>'
                f'<div class="footer" {_MARK}=B><p>{say(9)}</p><ul>{links(4)}</ul></div>',
        lambda: f'<ol class="commentlist" {_MARK}=B><li><p>{say(33)}</p><p>{say(12)}</p></li><li><p>{say(8)}</p></li></ol>'
                f"<form {_MARK}=B><p>{say(10)}</p></form>",
        lambda: f'<div class="related-posts" {_MARK}=B><h3>{say(2, "")}</h3><ul>{links(5)}</ul></div>'
                f'<div class="newsletter" {_MARK}=B><p>{say(17)}</p></div><footer {_MARK}=B>{say(25)}</footer>',
        lambda: f'<div class="sponsored" {_MARK}=B>{paragraphs(30, 21)}</div><div class="comments" {_MARK}=B>'
                f"<div>{say(35)}</div><div>{say(5)}</div></div>",
        lambda: f"<div {_MARK}=B>" + " | ".join(f"<a href=/{j}>{say(1 + j % 2, '')}</a>" for j in range(4)) + "</div>",
    ]
    wraps = [lambda inside: f"<body {_MARK}=S>{inside}</body>",
             lambda inside: f'<body {_MARK}=S><div id="page" {_MARK}=S>{inside}</div></body>',
             lambda inside: f'<body {_MARK}=S><div {_MARK}=S><div {_MARK}=S>{inside}</div></div></body>']
    out = []
    for i, (b, a) in enumerate(itertools.product(range(len(before)), range(len(after)))):
        body = bodies[i % len(bodies)]
        inside = before[b]() + body() + after[a]()
        out.append(f"<html {_MARK}=S><head {_MARK}=B></head>{wraps[i % len(wraps)](inside)}</html>")
        other = bodies[(i * 3 + 1) % len(bodies)]
        out.append(f"<html {_MARK}=S>{wraps[(i + 1) % len(wraps)](before[b]() + before[(b + 1) % 7]() + other() + after[a]())}</html>")
    return out


def extract(model: Model, sources: list[str]) -> list[str]:
    """Main text of each page."""
    out, pages, nodes = [], [], 0

    def done() -> None:
        for page, marginal in zip(pages, model.content(pages)):
            out.append("\n\n".join(t for t, m, tag in zip(page.text, marginal, page.tag) if tag == "#text" and m > 0.5))

    for source in sources:
        pages.append(Page(source))
        nodes += len(pages[-1].tag)
        if nodes > _NODES:
            done()
            pages, nodes = [], 0
    if pages:
        done()
    return out


def extract_column(spark, model: Model, source: Column) -> Column:
    """Main text of an html column; empty where there is none."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("string")
    def main_text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(extract(shared.value, [s or "" for s in batch]), index=batch.index, dtype=object)

    return main_text(source.cast("string"))
