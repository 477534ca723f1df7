"""Main text of web pages by a tree-structured graphical model.

A page is parsed into its tree of block elements (inline elements belong to the
block they stand in).  Every node has a hidden label, content or not; a parent
and a child are tied by a potential (one for parents that frame a page, such as
menus and comments, one for others), a node and its features (tag kind, words
of class and id, text length, share of link text, punctuation, children) by
another.  Sum-product messages, first from the leaves to the root, then back,
give every node's exact marginal; the text of nodes of 0.5 or more is the
page's main text.

The potentials are trained from labelled pages: pages of the table whose author
marked the article (one <article> or <main>) label their own nodes by it, and
pages made of their texts add what a table's pages may not show: articles of
lists, tables, captions and bare text, plain text, and boilerplate inside the
article.  No label looks at class names.  At most SAMPLE pages (smallest salted
hash of the id, one row each) are used.  Extraction is one Arrow pass over every
whole page.
"""

from __future__ import annotations

import html
import math
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaystats.llm.common import hash_sample

SAMPLE = 300            # labelled pages in the fit, at most
MADE_BLOCKS = 40        # blocks of an article that made pages take, at most
STEPS, RATE, DECAY = 400, 0.3, 1e-3

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<!\[CDATA\[.*?\]\]>|"
                    r"<(/?)([A-Za-z][^\s/>]*)([^>\"']*(?:(?:\"[^\"]*\"|'[^']*')[^>\"']*)*)>", re.DOTALL)
_NAMES = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
#: Kinds of tags and words of class, id and role.
_RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "template", "xmp"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font",
           "i", "ins", "kbd", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time",
           "tt", "u", "var"}
_KIND = {"article": "article", "main": "article", "p": "prose", "blockquote": "prose", "pre": "prose",
         "h1": "heading", "h2": "heading", "h3": "heading", "h4": "heading", "h5": "heading", "h6": "heading",
         "ul": "list", "ol": "list", "li": "list", "dl": "list", "dt": "list", "dd": "list",
         "nav": "frame", "header": "frame", "footer": "frame", "aside": "frame", "menu": "frame", "dialog": "frame",
         "form": "frame", "button": "frame", "select": "frame", "option": "frame", "fieldset": "frame",
         "label": "frame", "head": "frame", "figure": "other", "table": "other"}
#: Words that class, id and role use for what frames an article; whole words only.
_FRAME_WORDS = set("""nav navbar navigation menu menus footer sidebar aside ad ads advert adverts advertisement
    advertising banner banners promo promos sponsor sponsored sponsors cookie cookies consent notice notices popup modal
    overlay share sharing shares social comment comments commenter discussion reply replies related recommended
    recommendations newsletter subscribe subscription login signup search breadcrumb breadcrumbs pagination pager widget
    widgets copyright legal toolbar masthead complementary contentinfo""".split())
_HEADER_WORDS = {"header", "head"}
_CONTENT_WORDS = {"article", "content", "entry", "main", "post", "story", "body", "text"}
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_NEVER = {"script", "style", "template", "noscript", "iframe", "textarea", "title", "head", "select", "option",
          "button", "xmp"}
_KINDS = ("article", "prose", "heading", "list", "frame", "other")
_N_FEATURES = len(_KINDS) + 14


class Node:
    __slots__ = ("tag", "names", "parent", "text", "links", "children", "inside")

    def __init__(self, tag: str, names: str, parent: int, inside: bool = False):
        self.tag, self.names, self.parent, self.inside = tag, names, parent, inside     # inside: of an article
        self.text, self.links, self.children = 0, 0, 0


def parse(page: str | None) -> tuple[list[Node], list[tuple[int, str]]]:
    """Block nodes in document order (a parent before its children; node 0 is
    the page) and the pieces of text with the node each stands in."""
    page = page or ""
    nodes, pieces = [Node("#page", "", -1)], []
    stack, inline, at, links = [(0, "#page")], [], 0, 0

    def add(text: str) -> None:
        nonlocal links
        if text:
            here = stack[-1][0]
            text = html.unescape(text)
            pieces.append((here, text))
            size = len(text.split())
            nodes[here].text += size
            if links:
                nodes[here].links += size

    def close(depth: int) -> None:
        del stack[depth:]
        pieces.append((stack[-1][0], "\n"))

    pos = 0
    while True:
        m = _TOKEN.search(page, pos)
        if m is None:
            add(page[at:])
            return nodes, pieces
        add(page[at:m.start()])
        at = pos = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if tag in _INLINE:
            if tag == "a":
                links = 0 if m[1] else 1
            continue
        pieces.append((stack[-1][0], "\n"))
        if tag in _VOID:
            continue
        if m[1]:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][1] == tag:
                    close(depth)
                    links = 0
                    break
            continue
        open_tags = [t for _, t in stack]
        if "p" in open_tags and tag not in ("#page",):
            close(len(open_tags) - 1 - open_tags[::-1].index("p"))
        if tag in ("li", "dt", "dd", "option", "tr", "td", "th") and stack[-1][1] == tag:
            close(len(stack) - 1)
        parent = stack[-1][0]
        names = " ".join(a or b or c for a, b, c in _NAMES.findall(m[3])) if m[3] else ""
        nodes.append(Node(tag, names, parent, nodes[parent].inside or nodes[parent].tag in ("article", "main")))
        nodes[parent].children += 1
        here = len(nodes) - 1
        if tag in _RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, pos)
            at = pos = end.end() if end else len(page)
        elif not m[3].rstrip().endswith("/") or tag in _KIND:
            stack.append((here, tag))


def words_of(names: str) -> set[str]:
    """Words of class, id and role, split at hyphens and capitals; neighbours
    also as one word (``side-bar``)."""
    words = [w.lower() for w in _WORD.findall(names)]
    return {*words, *map("".join, zip(words, words[1:]))}


def frames(n: Node) -> bool:
    """Whether tag, class, id or role say that a node frames the page.  A
    header that names the article is part of it."""
    words = words_of(n.names) if n.names else set()
    if words & _FRAME_WORDS:
        return True
    if n.tag == "header" or words & _HEADER_WORDS:
        return not (words & _CONTENT_WORDS or n.inside)
    return _KIND.get(n.tag) == "frame"


def features(nodes: list[Node]) -> np.ndarray:
    """A row per node."""
    out = np.zeros((len(nodes), _N_FEATURES))
    k = len(_KINDS)
    prose = sum(n.text - n.links for n in nodes) or 1
    framing: list[bool] = []        # by node, and whether it stands below such a node
    below: list[bool] = []
    for row, n in zip(out, nodes):
        row[_KINDS.index(_KIND.get(n.tag, "other"))] = 1
        frame = frames(n)
        row[k] = 3.0 * frame
        row[k + 1] = bool(n.names and not frame and words_of(n.names) & _CONTENT_WORDS)
        row[k + 2] = min(math.log1p(n.text), 6) / 3
        row[k + 3] = n.links / n.text if n.text else 0
        row[k + 4] = n.text == 0
        row[k + 5] = min(math.log1p(n.children), 4) / 2
        row[k + 6] = n.text > 0 and n.links == n.text
        row[k + 7] = n.tag in ("#page", "html", "body")
        row[k + 8] = n.tag in _NEVER
        row[k + 9] = 1
        row[k + 10] = (n.text - n.links) / prose
        row[k + 11] = 3.0 * (n.text > 0 and bool(row[k + 7]))
        row[k + 12] = 3.0 * (n.tag == "#page" and len(nodes) == 1)
        below.append(n.parent >= 0 and (below[n.parent] or framing[n.parent]))
        framing.append(frame)
        row[k + 13] = 3.0 * below[-1]
    return out


@dataclass(frozen=True)
class Model:
    """Node weights (log-odds less the prior), root prior and parent-child tables."""

    weights: np.ndarray
    root: float
    tables: tuple       # for other and framing parents: P(child label | parent label)

    def marginals(self, nodes: list[Node]) -> np.ndarray:
        """P(content) of every node by sum-product messages on the tree."""
        z = np.clip(features(nodes) @ self.weights, -30, 30)
        z[[n.tag in _NEVER for n in nodes]] = -30
        odds = np.exp(z).tolist()
        n = len(nodes)
        tied = [self.tables[frames(x)] for x in nodes]      # by parent
        # upward: (a, b) = evidence below a node for labels 0 and 1, its own included
        a, b = [1.0] * n, odds[:]
        up: list[tuple[float, float]] = [(1.0, 1.0)] * n
        for i in range(n - 1, 0, -1):
            s = a[i] + b[i]
            x, y = a[i] / s, b[i] / s
            t = tied[nodes[i].parent]
            u = (t[0][0] * x + t[0][1] * y, t[1][0] * x + t[1][1] * y)
            up[i] = u
            p = nodes[i].parent
            a[p] *= u[0]
            b[p] *= u[1]
            if a[p] + b[p] < 1e-200:
                a[p], b[p] = a[p] * 1e200, b[p] * 1e200
        # downward: belief of the parent without this child, through the table
        out = [0.0] * n
        for i in range(n):
            if i == 0:
                x, y = (1 - self.root) * a[0], self.root * b[0]
            else:
                p = nodes[i].parent
                t, u, q = tied[p], up[i], out[p]
                e, f = (1 - q) / u[0], q / u[1]
                s = e + f
                e, f = e / s, f / s
                x = (t[0][0] * e + t[1][0] * f) * a[i]
                y = (t[0][1] * e + t[1][1] * f) * b[i]
            out[i] = y / (x + y)
        return np.array(out)

    def extract(self, page: str | None) -> str:
        nodes, pieces = parse(page)
        keep = self.marginals(nodes) >= 0.5
        return " ".join("".join(x if keep[i] else " " for i, x in pieces).split())


def own_labels(nodes: list[Node]) -> list[int] | None:
    """Labels of a page that marks its article: what stands in it, but for
    elements that never hold text of it.  None for any other page."""
    marked = [i for i, n in enumerate(nodes) if n.tag in ("article", "main")]
    if len(marked) != 1:
        return None
    labels = [0] * len(nodes)
    for i in range(marked[0], len(nodes)):
        n = nodes[i]
        labels[i] = int(i == marked[0] or (bool(labels[n.parent]) and n.tag not in _APART))
    return labels


#: Elements inside an article that are no part of it whatever they say.
_APART = _NEVER | {"nav", "aside", "footer", "form", "menu", "dialog", "fieldset", "label"}
#: Names for made pages: of parts of an article, and of what frames it.
_PLAIN_NAMES = ("", "lead", "research-findings", "shareholders", "section", "box2", "col-md-8", "story-header", "intro",
                "abstract", "wrapper", "text", "adaptive", "navigate-far", "headline")
_FRAME_NAMES = ("comments", "comment-list", "share-bar", "socialLinks", "ad", "ad-slot", "related", "sidebar", "main-nav",
                "newsletter-signup", "cookie-notice", "search-box", "breadcrumbs", "promo", "page-footer", "userComments")


def made_pages(blocks: list[str], others: list[str], r: random.Random) -> list[tuple[str, bool]]:
    """Pages made of an article's blocks with known labels, beyond what pages
    happen to hold: (page, whether its root holds the article).  Elements of
    the article have the class ``y1``; text of ``others`` frames it."""
    def own(tag: str, inner: str, name: str = "") -> str:
        return f'<{tag} class="y1 {name}">{inner}</{tag}>'

    def frame() -> str:
        name, text = r.choice(_FRAME_NAMES), r.choice(others)
        links = "".join(f'<li><a href="/">{w}</a></li>' for w in text.split()[:6])
        return r.choice([
            f'<div class="{name}"><p>{text}</p></div>', f'<div id="{name}">{text}</div>', f"<aside>{text}</aside>",
            f'<section class="{name}"><div><p>{text}</p></div><div><p>{r.choice(others)}</p></div></section>',
            f'<div class="{name}"><ul>{links}</ul></div>', f'<form>{text}<button>ok</button></form>'])

    def block(text: str) -> str:
        half = len(text) // 2
        return r.choice([
            own("p", text), own("ul", own("li", text[:half]) + own("li", text[half:])), own("ol", own("li", text)),
            own("table", own("tr", own("td", text[:half]) + own("td", text[half:]))), own("blockquote", text),
            own("figure", own("figcaption", text)), own("dl", own("dt", text[:30]) + own("dd", text)),
            own("div", text, r.choice(_PLAIN_NAMES)), own("section", own("p", text), r.choice(_PLAIN_NAMES)),
            own("header", own("h2", text[:60])), own("pre", text)])

    def page(body: str) -> str:
        menu = "".join(f'<li><a href="/">{w}</a></li>' for w in r.choice(others).split()[:8])
        return (f"<html><head><title>{blocks[0][:40]}</title></head><body><nav><ul>{menu}</ul></nav>{frame()}{body}{frame()}"
                f"<footer>{r.choice(others)}</footer></body></html>")

    mixed = "".join(block(b) + (frame() if r.random() < 0.3 else "") for b in blocks)
    holder = r.choice(("article", "main", "div"))
    return [
        (page(own(holder, mixed, r.choice(("content", "post-body", "")))), False),
        (page(own("article", "".join(block(b) for b in blocks))), False),
        (page(own("div", "<br>".join(blocks), r.choice(_PLAIN_NAMES))), False),
        ("\n".join(blocks), True), (f"<div class=y1>{' '.join(blocks)}</div>", False),
        (f"<html><body class=y1>{'<br>'.join(blocks)}</body></html>", False)]


def made_labels(nodes: list[Node], root: bool) -> list[int]:
    return [int(root), *(int("y1" in n.names.split()) for n in nodes[1:])]


def article_blocks(nodes: list[Node], pieces: list[tuple[int, str]], labels: list[int]) -> list[str]:
    texts: dict[int, list[str]] = {}
    for i, x in pieces:
        if labels[i]:
            texts.setdefault(i, []).append(x)
    out = [html.escape(" ".join("".join(x).split())) for x in texts.values()]
    return [x for x in out if x][:MADE_BLOCKS]


def train(pages: list[str]) -> Model:
    """Parent-child table by counts (one added to each), node weights by
    logistic regression with the label shares taken out again, from pages that
    mark their article and from pages made of their texts."""
    rows, ys, firsts, counts, articles = [], [], [], np.ones((2, 2, 2)), []

    def learn(nodes: list[Node], labels: list[int]) -> None:
        rows.append(features(nodes))
        ys.extend(labels)
        firsts.append(labels[:1])
        for i in range(1, len(nodes)):
            counts[int(frames(nodes[nodes[i].parent])), labels[nodes[i].parent], labels[i]] += 1

    for page in pages:
        nodes, pieces = parse(page)
        labels = own_labels(nodes)
        if labels is None:
            continue
        learn(nodes, labels)
        if blocks := article_blocks(nodes, pieces, labels):
            articles.append(blocks)
    r = random.Random(11)
    short = [" ".join(b.split()[:30]) for blocks in articles for b in blocks] or ["more"]
    for blocks in articles:
        for page, root in made_pages(blocks, short, r):
            nodes, _ = parse(page)
            learn(nodes, made_labels(nodes, root))
    if not rows or len(set(ys)) < 2:
        return Model(_DEFAULT, 0.02, (((0.9, 0.1), (0.1, 0.9)), ((0.998, 0.002), (0.5, 0.5))))
    x, y = np.concatenate(rows), np.asarray(ys, float)
    weight = np.where(y == 1, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    w, m, v = np.zeros(x.shape[1]), 0.0, 0.0
    for step in range(1, STEPS + 1):
        g = x.T @ (weight * (1 / (1 + np.exp(-np.clip(x @ w, -30, 30))) - y)) + DECAY * w
        m = 0.9 * m + 0.1 * g
        v = 0.999 * v + 0.001 * g * g
        w = w - RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    tables = np.clip(counts / counts.sum(axis=2, keepdims=True), 0.002, 0.998)
    tables[0] = np.clip(tables[0], 0.02, 0.98)
    roots = np.array([y[0] for y in firsts])
    return Model(w, float(np.clip(roots.mean(), 0.02, 0.5)), tuple(tuple(map(tuple, t)) for t in (tables / tables.sum(axis=2, keepdims=True)).tolist()))


#: Weights where no page of a table marks its article: by kind, then the other features.
_DEFAULT = np.array([3, 1.5, 1, -0.5, -2, 0, -1, 1, 1, -2, 0, 0, -2, -3, -9, -0.5, 2, 1, 1, -1], float)


def fit(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> Model:
    """Model from a bounded sample of the pages that mark their article; with
    none (or an empty table) a fixed one."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(html_col).alias("html"))
    marked = rows.where(F.col("page_id").isNotNull() & F.col("html").rlike("(?i)<(article|main)[\\s>]"))
    chosen = hash_sample(marked.select("page_id").distinct(), "page_id", SAMPLE, 19)
    got = marked.join(F.broadcast(chosen), "page_id", "left_semi").groupBy("page_id").agg(F.min("html").alias("html"))
    return train([r.html for r in sorted(got.collect(), key=lambda r: r.page_id)])


def extract(pages: DataFrame, model: Model, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html") -> DataFrame:
    """page_id, url, text and n_chars of every row, repeated rows included.
    Null and empty pages, and pages without main text, have an empty text;
    null ids and urls stay null; other columns are left out."""
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                texts = [model.extract(h) for h in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(fn, "page_id long, url string, text string, n_chars long")
