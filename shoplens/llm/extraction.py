"""Main text of web pages: boosted trees over DOM nodes, decoded over the tree.

Every block element is a node with features of its subtree (text and link
density, tags, controls), its attribute tokens and those of its ancestors, its
depth and its siblings.  Gradient-boosted trees give the probability that a
node's text is main text.  The choices are then made together: a node is kept
whole, dropped whole, or mixed, and only below a mixed node may choices differ,
so no ancestor contradicts a descendant (a dynamic programme over the tree).

There are no labels for pages, so the trees learn from a bounded sample of
``max_pages`` pages (the smallest by a hash of their id): the blocks of an
``article`` or ``main`` element are main text, other blocks are not, and each
page is also laid out anew, from its own blocks, in other common forms
(without semantic tags, with side bars, notices, forms and reader comments).
Of a page and of each new layout about ``max_nodes`` nodes are learned from, and a
new layout holds the first ``max_blocks`` blocks at most.  If no sampled page has
such an element, new layouts are made of the pages' paragraphs alone.

Defined cases: null or empty html has empty text; pages without any markup are
one block of text; null ids and repeated rows give a row each.  Only the named
columns are read.
"""

from __future__ import annotations

import math
import random
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm import dom
from shoplens.llm.common import text_or_empty
from shoplens.session import ship_package

# Attribute words (fixed values) that name the parts of a page.
MAIN_WORDS = set("article content main post story entry body text prose blog page news".split())
REST_WORDS = set("nav navigation menu header masthead footer sidebar side aside ad ads advert advertisement sponsor sponsored banner promo cookie "
                 "consent notice alert comment comments reply replies disqus share social related recommended form login signup subscribe "
                 "newsletter breadcrumb breadcrumbs widget toolbar pagination popup modal copyright legal tags meta search".split())
REST_TAGS = set("nav header footer aside form menu fieldset dialog".split())


def features(nodes: list[dom.Node]) -> list[list[float]]:
    """One row per node; page totals make sizes relative."""
    n = len(nodes)
    chars, links, marks, size, fields, stops, blocks = ([0.0] * n for _ in range(7))
    for k, x in enumerate(nodes):
        own = "".join(p for p in x.parts if isinstance(p, str))
        words = own.strip()
        chars[k], links[k], marks[k], fields[k] = len(words), x.links, x.marks, x.fields
        stops[k] = words.count(". ") + words.count(".") + words.count(",")
        blocks[k], size[k] = bool(words), 1
    own_chars = list(chars)
    for k in range(n - 1, 0, -1):
        p = nodes[k].parent
        for total in (chars, links, marks, size, fields, stops, blocks):
            total[p] += total[k]
    rows, above_rest, above_main = [], [0] * n, [0] * n
    whole = max(1.0, chars[0])
    place, of = [0] * n, [1] * n
    alike = [1.0] * n
    for x in nodes:
        kids = x.children()
        tags = Counter(nodes[c].tag for c in kids)
        for i, c in enumerate(kids):
            place[c], of[c] = i, len(kids)
            alike[c] = tags[nodes[c].tag] / len(kids)
    for k, x in enumerate(nodes):
        rest = sum(t in REST_WORDS for t in x.tokens) + (x.tag in REST_TAGS)
        main = sum(t in MAIN_WORDS for t in x.tokens) + (x.tag in ("article", "main"))
        if k:
            above_rest[k] = above_rest[x.parent]
            above_main[k] = above_main[x.parent]
        rows.append([
            math.log1p(chars[k]), chars[k] / whole, links[k] / max(1.0, chars[k]), chars[k] / size[k],
            marks[k] / max(1.0, chars[k]), fields[k], stops[k] / max(1.0, chars[k]), math.log1p(own_chars[k]), blocks[k] / size[k],
            x.depth, place[k], of[k], place[k] / of[k], alike[k], rest, main, above_rest[k], above_main[k],
            x.tag == "p", x.tag in ("h1", "h2", "h3", "h4", "h5", "h6"), x.tag in ("li", "ul", "ol"), x.tag in ("div", "section"), k == 0,
        ])
        above_rest[k] += rest
        above_main[k] += main
    return rows


# --- training pages -------------------------------------------------------

def labelled(nodes: list[dom.Node]) -> list[int] | None:
    """1 for nodes whose text is mostly inside the article; None without one."""
    n = len(nodes)
    inside, main, total = [False] * n, [0] * n, [0] * n
    for k, x in enumerate(nodes):
        marked = x.tag in ("article", "main") or "truth" in x.tokens
        rest = k and (x.tag in REST_TAGS or any(t in REST_WORDS for t in x.tokens))
        inside[k] = marked or (k > 0 and inside[x.parent] and not rest)
        total[k] = sum(len(p.strip()) for p in x.parts if isinstance(p, str))
        main[k] = total[k] if inside[k] else 0
    if not any(inside):
        return None
    for k in range(n - 1, 0, -1):
        main[nodes[k].parent] += main[k]
        total[nodes[k].parent] += total[k]
    return [int(2 * m > t) for m, t in zip(main, total)]


def laid_out(blocks: list[str], rest: list[str], rng: random.Random) -> str:
    """A page of other form from a page's own blocks; ``truth`` marks the main part."""
    def short() -> str:
        words = rng.choice(blocks + rest).split() or ["x"]
        k = rng.randrange(len(words))
        return " ".join(words[k:k + rng.randint(1, 14)])

    def menu(n: int) -> str:
        return "<ul>" + "".join(f'<li><a href="/{i}">{short()}</a></li>' for i in range(n)) + "</ul>"

    def wrap(names: list[str], tags: list[str], inner: str) -> str:
        tag, name = rng.choice(tags), rng.choice([*names, ""])
        if not name and tag in ("div", "section"):
            name = names[0]
        return f'<{tag} class="{name}">{inner}</{tag}>' if name else f"<{tag}>{inner}</{tag}>"

    parts = {
        "menu": lambda: wrap(["menu", "navbar nav", "site-navigation", "breadcrumbs"], ["nav", "div"], menu(rng.randint(3, 9))),
        "top": lambda: wrap(["header", "masthead", "site-header"], ["header", "div"], f"<p>{short()}</p>"),
        "foot": lambda: wrap(["footer", "site-footer", "copyright legal"], ["footer", "div"], f"<p>{short()}</p>" + menu(rng.randint(0, 3))),
        "side": lambda: wrap(["sidebar", "side", "widget", "related"], ["aside", "div"], f"<h3>{short()}</h3>" + menu(rng.randint(2, 6))),
        "advert": lambda: wrap(["ad", "ads", "advert", "sponsored", "promo banner"], ["div", "section"], rng.choice([short(), f"<p>{short()}</p>"])),
        "notice": lambda: wrap(["cookie-notice", "notice", "alert", "newsletter subscribe"], ["div", "section"], f"<p>{short()} {short()}</p>"),
        "form": lambda: f"<form>{short()}<input name=q><button>{short()}</button></form>",
        "comments": lambda: wrap(["comments", "comment-list", "replies"], ["div", "section"], "".join(
            f'<div class="comment"><p>{short()} {short()} {short()}</p></div>' for _ in range(rng.randint(1, 5)))),
    }
    kinds = ["", "<h2>{}</h2>", "<ul><li>{}</li></ul>", "<blockquote>{}</blockquote>"]
    body = "".join((rng.choice(kinds[1:]) if rng.random() < 0.12 else "<p>{}</p>").format(b) for b in blocks)
    if rng.random() < 0.3:
        body += parts[rng.choice(["advert", "notice", "side"])]()
    if rng.random() < 0.5:
        body = f"<h1>{short()}</h1>" + body
    tag = rng.choice(["div", "div", "article", "main", "section"])
    name = rng.choice(["content", "post", "entry-content", "story", "main", "x", ""])
    main = f'<{tag} class="{name} truth">{body}</{tag}>'
    if rng.random() < 0.4:
        main = f"<div>{main}</div>"
    before = [parts[p]() for p in rng.sample(["menu", "top", "advert", "notice", "form"], rng.randint(1, 3))]
    after = [parts[p]() for p in rng.sample(["foot", "side", "advert", "comments", "notice", "form", "menu"], rng.randint(1, 4))]
    return "".join([*before, main, *after])


def training_rows(pages: list[str], copies: int, seed: int, max_nodes: int = 80, max_blocks: int = 40) -> tuple[list[list[float]], list[int]]:
    """Features and labels of about ``max_nodes`` nodes of each page and of each of
    its ``copies`` new layouts, which hold ``max_blocks`` of its blocks at most."""
    rng = random.Random(seed)
    rows, marks = [], []

    def add(nodes: list[dom.Node]) -> None:
        got = labelled(nodes)
        if got is not None:
            for x in nodes:
                x.tokens = [t for t in x.tokens if t != "truth"]
            some = [k for k in range(len(nodes)) if len(nodes) < max_nodes or rng.random() < max_nodes / len(nodes)]
            f = features(nodes)
            rows.extend(f[k] for k in some)
            marks.extend(got[k] for k in some)

    parsed = [dom.parse(p) for p in pages]
    marked = any(labelled(nodes) is not None for nodes in parsed)
    for nodes in parsed:
        got = labelled(nodes)
        if not marked:  # no page says what its article is: paragraphs stand for it
            got = [int(x.tag == "p" or len(nodes) == 1) for x in nodes]
        else:
            add(nodes)
        texts = [(" ".join(t for t in dom.runs(x) if t), bool(got and got[k])) for k, x in enumerate(nodes)]
        blocks, rest = ([t for t, m in texts if t and m is side] for side in (True, False))
        if blocks:
            for _ in range(copies):
                some = blocks[:rng.randint(1, min(len(blocks), max_blocks))]
                add(dom.parse(laid_out(some, rest, rng)))
    return rows, marks


# --- boosted trees --------------------------------------------------------

@dataclass
class Trees:
    """Trees as level-order arrays: feature (-1 for a leaf), bound, value."""

    start: float
    trees: list[tuple]

    def probability(self, x):
        import numpy as np

        z = np.full(len(x), self.start)
        for feature, bound, value in self.trees:
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(int(math.log2(len(feature) + 1))):
                f = feature[at]
                inner = f >= 0
                right = x[np.arange(len(x)), np.maximum(f, 0)] > bound[at]
                at = np.where(inner, 2 * at + 1 + right, at)
            z += value[at]
        return 1 / (1 + np.exp(-np.clip(z, -20, 20)))


def boost(rows: list[list[float]], marks: list[int], rounds: int = 40, depth: int = 4, rate: float = 0.3, bins: int = 32,
          leaf: float = 5.0) -> Trees:
    """Newton boosting of the logistic loss on quantile bins."""
    import numpy as np

    x, y = np.array(rows, dtype=float), np.array(marks, dtype=float)
    if not len(y) or y.min() == y.max():
        return Trees(20.0 if len(y) and y.max() == 1 else -20.0, [])
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1)
    start = math.log(y.mean() / (1 - y.mean()))
    z, trees = np.full(len(y), start), []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-z))
        g, h = y - p, p * (1 - p)
        size = 2 ** (depth + 1) - 1
        feature, bound, value = np.full(size, -1), np.zeros(size), np.zeros(size)
        member = {0: np.arange(len(y))}
        for node in range(size):
            if node not in member:
                continue
            at = member.pop(node)
            total_g, total_h = g[at].sum(), h[at].sum()
            best = (1e-6, -1, 0)
            if node < 2 ** depth - 1:
                for j in range(x.shape[1]):
                    if not len(edges[j]):
                        continue
                    gs = np.cumsum(np.bincount(binned[at, j], g[at], len(edges[j]) + 1))[:-1]
                    hs = np.cumsum(np.bincount(binned[at, j], h[at], len(edges[j]) + 1))[:-1]
                    gain = gs ** 2 / (hs + 1) + (total_g - gs) ** 2 / (total_h - hs + 1) - total_g ** 2 / (total_h + 1)
                    gain[(hs < leaf) | (total_h - hs < leaf)] = 0
                    k = int(gain.argmax())
                    if gain[k] > best[0]:
                        best = (gain[k], j, k)
            if best[1] < 0:
                value[node] = rate * total_g / (total_h + 1)
                z[at] += value[node]
                continue
            _, j, k = best
            feature[node], bound[node] = j, edges[j][k]
            right = binned[at, j] > k
            member[2 * node + 1], member[2 * node + 2] = at[~right], at[right]
        trees.append((feature, bound, value))
    return Trees(start, trees)


# --- decoding -------------------------------------------------------------

def decode(nodes: list[dom.Node], probability) -> list[bool]:
    """Most likely consistent choice: each subtree whole, dropped or mixed."""
    n = len(nodes)
    weight = [min(4.0, 0.2 + math.log1p(sum(len(p.strip()) for p in x.parts if isinstance(p, str))) / 2) for x in nodes]
    yes = [w * math.log(max(1e-6, p)) for w, p in zip(weight, probability)]
    no = [w * math.log(max(1e-6, 1 - p)) for w, p in zip(weight, probability)]
    whole, none, mixed = list(yes), list(no), [0.0] * n
    own = [max(a, b) for a, b in zip(yes, no)]
    best = [0.0] * n
    for k in range(n - 1, -1, -1):
        # A mixed node pays a little, so that whole subtrees are preferred.
        mixed[k] += own[k] - 0.7
        best[k] = max(whole[k], none[k], mixed[k]) if nodes[k].children() else max(whole[k], none[k])
        if k:
            p = nodes[k].parent
            whole[p] += whole[k]
            none[p] += none[k]
            mixed[p] += best[k]
    keep, state = [False] * n, [""] * n
    for k in range(n):
        above = state[nodes[k].parent] if k else "mixed"
        if above != "mixed":
            state[k] = above
        elif best[k] == whole[k]:
            state[k] = "keep"
        elif best[k] == none[k]:
            state[k] = "drop"
        else:
            state[k] = "mixed"
        keep[k] = state[k] == "keep" or (state[k] == "mixed" and yes[k] > no[k])
    return keep


def extract(pages: list[str], model: Trees) -> list[str]:
    import numpy as np

    parsed = [dom.parse(p) for p in pages]
    rows = [features(nodes) for nodes in parsed]
    p = model.probability(np.array([r for f in rows for r in f], dtype=float))
    out, at = [], 0
    for nodes in parsed:
        out.append(dom.collect(nodes, decode(nodes, p[at:at + len(nodes)].tolist())))
        at += len(nodes)
    return out


def train(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", max_pages: int = 200, copies: int = 4, seed: int = 7) -> Trees:
    """Fits the trees on at most ``max_pages`` pages; those are all the driver sees."""
    ship_package(pages.sparkSession)
    chosen = (pages.filter(F.col(html_col).isNotNull()).select(F.xxhash64(F.col(id_col)).alias("h"), F.col(id_col).alias("i"))
              .orderBy("h", "i").limit(max_pages))
    texts = (pages.select(F.col(id_col).alias("pid"), F.col(html_col).alias("page"))
             .join(F.broadcast(chosen), F.col("pid") == F.col("i")).orderBy("h", "i", "page").limit(max_pages).select("page"))
    return boost(*training_rows([r["page"] for r in texts.collect()], copies, seed))


def extractor(model: Trees) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = extract(part.column(2).to_pylist(), model)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()),
                                                  pa.array([len(t) for t in texts], pa.int64())],
                                                 names=["page_id", "url", "text", "n_chars"])

    return run


def main_text(pages: DataFrame, model: Trees, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    d = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), text_or_empty(html_col).alias("html"))
    return d.mapInArrow(extractor(model), "page_id long, url string, text string, n_chars long")
