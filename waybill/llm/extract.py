"""The main text of web pages, by boosted trees over their elements.

Every block element gets features: its tag and attribute words, those of what it
stands in, depth, place among its siblings, and how much text, link text and markup
its subtree has.  Boosted trees give each element's log-odds of being main text.

Decoding takes the whole tree.  Along any way down, elements are first outside, then
main, then (an advert in an article) excluded, and never turn back, so a kept element
can't stand in a dropped one.  The labelling with the highest sum of text-weighted
log-odds is found exactly, from the leaves up.

Pages have no labels.  The trees learn from at most TRAIN_PAGES pages (the ids that
hash lowest) where markup says what is main (an article or main element), each also in
altered copies: telling tags replaced by plain ones with usual class names, and
notices, adverts, comments, forms and side columns put in.  So neither one template's
tags nor the text itself decides.
"""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waybill.llm.dom import Page, decoded, parse, words_of
from waybill.llm.store import only

TRAIN_PAGES = 200
ROUNDS = 60
DEPTH = 4
RATE = 0.3
BINS = 32
SEED = 5
WEIGHT = 1.0  # of a unit of log text length in decoding
SURE = 6.0  # largest log-odds that one element can bring in

# Words that pages use in class names and ids, by what they stand for.
ROLES = {
    "main": "article articlebody body content entry main post story text maincontent postcontent page",
    "menu": "menu menus nav navbar navigation breadcrumb breadcrumbs tabs toc topbar pagination pager",
    "header": "banner header masthead branding logo",
    "footer": "bottom copyright footer colophon legal",
    "side": "aside sidebar side related recommended widget widgets rail popular trending teaser",
    "notice": "alert consent cookie cookies gdpr modal newsletter notice notification popup subscribe toast paywall",
    "advert": "ad ads adsense advert advertisement advertising promo promoted sponsor sponsored",
    "form": "form login search signup register contact",
    "comment": "comment comments disqus discussion reply replies respond feedback commentlist",
    "share": "share sharing social tags meta byline toolbar",
}
ROLE_OF = {w: i for i, words in enumerate(ROLES.values()) for w in words.split()}
GROUPS = [  # tags as features
    {"article"}, {"main"}, {"section"}, {"div"}, {"p"}, {"h1"}, {"h2", "h3", "h4", "h5", "h6"}, {"ul", "ol", "dl"},
    {"li", "dt", "dd"}, {"table", "tr", "td", "th"}, {"blockquote", "pre", "figure", "figcaption"}, {"header"},
    {"footer"}, {"nav"}, {"aside"}, {"form", "fieldset", "button"}, {"body", "html", "#root"},
]
GROUP_OF = {t: i for i, g in enumerate(GROUPS) for t in g}
N_GROUPS, N_ROLES = len(GROUPS) + 1, len(ROLES)
MARKED = [GROUP_OF[t] for t in ("header", "footer", "nav", "aside", "form")] + list(range(N_GROUPS, N_GROUPS + N_ROLES))


class Nodes:
    """Features and text weights of one page's elements."""

    def __init__(self, page: Page):
        n = len(page.tags)
        self.page = page
        own = np.zeros(n)
        linked = np.zeros(n)
        for element, text, link, _ in page.pieces:
            size = len(text) - text.count(" ") if len(text) < 40 else len(text)
            if not page.hidden[element] and not text.isspace():
                own[element] += size
                if link:
                    linked[element] += size
        ends, parents = np.array(page.ends), np.array(page.parents)
        at = np.arange(n)

        def subtree(x: np.ndarray) -> np.ndarray:
            total = np.append(0, np.cumsum(x))
            return total[ends] - total[at]

        groups = np.array([GROUP_OF.get(t, len(GROUPS)) for t in page.tags])
        group = np.zeros((n, N_GROUPS))
        group[at, groups] = 1
        roles = np.zeros((n, N_ROLES))
        for i, tokens in enumerate(page.tokens):
            if tokens:
                for word in words_of(tokens):
                    if word in ROLE_OF:
                        roles[i, ROLE_OF[word]] = 1
        # what stands above: parents come first, so one pass down does
        above = np.zeros((n, N_GROUPS + N_ROLES))
        depth = np.zeros(n)
        both = np.hstack([group, roles])
        for i in range(1, n):
            p = parents[i]
            depth[i] = depth[p] + 1
            above[i] = np.maximum(above[p], both[p])
        text, links = subtree(own), subtree(linked)
        tags = subtree(np.array(page.tag_count) + 1)
        paragraphs = subtree(group[:, GROUP_OF["p"]])
        siblings = np.bincount(np.maximum(parents, 0), minlength=n)[np.maximum(parents, 0)]
        first = np.zeros(n)
        seen: dict[int, int] = {}
        for i, p in enumerate(page.parents):
            first[i] = seen.get(p, 0)
            seen[p] = int(first[i]) + 1
        whole = max(text[0], 1)
        position = np.append(0, np.cumsum(own)[:-1]) / whole
        parent_text = text[np.maximum(parents, 0)]
        self.features = np.column_stack([
            group, roles, above, depth, np.minimum(siblings, 50), np.minimum(first, 50), first / np.maximum(siblings, 1),
            np.log1p(own), np.log1p(text), links / np.maximum(text, 1), text / tags, text / whole,
            text / np.maximum(parent_text, 1), np.log1p(paragraphs), position,
        ]).astype(np.float32)
        self.weight = np.log1p(own)
        marks = np.maximum(both, above)
        marks[:, N_GROUPS + list(ROLES).index("main")] = 0
        self.plain = (own > 0) & (linked <= own / 2) & ~marks[:, MARKED].any(axis=1) & ~np.array(page.hidden)


def _main_of(page: Page) -> np.ndarray | None:
    """What the markup says is main text; None if it doesn't say."""
    n = len(page.tags)
    roots = [i for i, t in enumerate(page.tags) if t == "article"] or [i for i, t in enumerate(page.tags) if t == "main"]
    if not roots:
        return None
    out = np.zeros(n, bool)
    for r in roots:
        out[r:page.ends[r]] = True
    main = ROLE_OF["main"]
    for i in range(n):
        names = {ROLE_OF[w] for w in words_of(page.tokens[i]) if w in ROLE_OF} if page.tokens[i] else set()
        if page.hidden[i] or page.tags[i] in ("nav", "aside", "form", "footer") or names - {main}:
            out[i:page.ends[i]] = False
    return out


MADE_UP = [
    ("div", "advert"), ("div", "ad"), ("aside", ""), ("aside", "related"), ("div", "sidebar"), ("section", "comments"),
    ("div", "comment-list"), ("div", "cookie-notice"), ("div", "newsletter"), ("form", ""), ("form", "search"),
    ("div", "share"), ("nav", ""), ("div", "menu"), ("footer", ""), ("header", ""), ("div", "footer"),
    ("div", "promo"), ("ul", "breadcrumb"), ("div", "banner"), ("section", "related"), ("div", "popup"),
]
PLAIN = ["content", "post", "story", "entry-content", "article-body", "main-content"]


def altered(source: str, fill: list[str], rng: random.Random) -> str:
    """The page with made-up parts put into and around its main text."""

    def part(inside: bool) -> str:
        tag, name = rng.choice([m for m in MADE_UP if not inside or m[0] != "header"])
        texts = [rng.choice(fill) for _ in range(rng.randint(1, 3))]
        shape = rng.choice(["<p>{}</p>", "<div>{}</div>", "<li>{}</li>", "<p><a href=#>{}</a></p>", "{}"])
        attribute = f' class="{name}"' if name else ""
        return f"<{tag}{attribute}>" + "".join(shape.format(t) for t in texts) + f"</{tag}>"

    inner = re.search(r"(<(?:article|main)\b[^>]*>)(.*)(</(?:article|main)>)", source, re.S | re.I)
    if inner:
        body = inner[2]
        cuts = [m.start() for m in re.finditer(r"<p\b", body)]
        for cut in sorted(rng.sample(cuts, min(len(cuts), rng.randint(0, 2))), reverse=True):
            body = body[:cut] + part(True) + body[cut:]
        if rng.random() < 0.5:
            body += part(True)
        before = "".join(part(False) for _ in range(rng.randint(0, 2)))
        after = "".join(part(False) for _ in range(rng.randint(0, 2)))
        source = source[:inner.start()] + before + inner[1] + body + inner[3] + after + source[inner.end():]
    return source


def _plain_tags(page: Page, rng: random.Random) -> None:
    """Telling tags become div with a usual class name, or with none."""
    names = {"article": PLAIN, "main": PLAIN, "nav": ["menu", "navbar"], "aside": ["sidebar", "side"],
             "footer": ["footer", "site-footer"], "header": ["header", "masthead"], "form": ["form"]}
    named = rng.random() < 0.8
    for i, tag in enumerate(page.tags):
        if tag in names:
            page.tags[i] = "div"
            if not page.tokens[i] and (named or tag not in ("article", "main")):
                page.tokens[i] = rng.choice(names[tag])


class Trees:
    """Boosted trees over binned features; each tree is a full one of DEPTH levels."""

    def __init__(self, edges: np.ndarray, feature: np.ndarray, cut: np.ndarray, leaf: np.ndarray, base: float):
        self.edges, self.feature, self.cut, self.leaf, self.base = edges, feature, cut, leaf, base

    @staticmethod
    def binned(x: np.ndarray, edges: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, f], "right") for f, e in enumerate(edges)], axis=1).astype(np.int16)

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Trees:
        quantiles = np.linspace(0, 1, BINS + 1)[1:-1]
        edges = np.quantile(x, quantiles, axis=0).T.astype(np.float32)
        # few values: cuts between them, so that each is a bin
        for f in range(x.shape[1]):
            values = np.unique(x[:, f])
            if len(values) <= BINS:
                middle = (values[1:] + values[:-1]) / 2
                edges[f] = np.append(middle, np.full(BINS - 1 - len(middle), np.inf))
        bins = cls.binned(x, edges)
        n, width = bins.shape
        base = float(np.log((weight[y].sum() + 1) / (weight[~y].sum() + 1)))
        odds = np.full(n, base)
        nodes = (1 << DEPTH) - 1
        feature, cut = np.zeros((ROUNDS, nodes), np.int16), np.full((ROUNDS, nodes), BINS, np.int16)
        leaf = np.zeros((ROUNDS, 1 << DEPTH), np.float32)
        flat = bins.astype(np.int64) + np.arange(width) * BINS
        for r in range(ROUNDS):
            p = 1 / (1 + np.exp(-odds))
            g, h = weight * (y - p), weight * p * (1 - p)
            at = np.zeros(n, np.int64)  # node of the level
            for level in range(DEPTH):
                count = 1 << level
                place = (at[:, None] * (width * BINS) + flat).ravel()
                shape = (count, width, BINS)
                gs = np.bincount(place, np.repeat(g, width), count * width * BINS).reshape(shape).cumsum(axis=2)
                hs = np.bincount(place, np.repeat(h, width), count * width * BINS).reshape(shape).cumsum(axis=2)
                gt, ht = gs[:, :, -1:], hs[:, :, -1:]
                gain = gs ** 2 / (hs + 1) + (gt - gs) ** 2 / (ht - hs + 1) - gt ** 2 / (ht + 1)
                gain = gain[:, :, :-1].reshape(count, -1)
                best = gain.argmax(axis=1)
                f, c = best // (BINS - 1), best % (BINS - 1)
                c = np.where(gain[np.arange(count), best] > 1e-6, c, BINS)
                feature[r, count - 1:2 * count - 1], cut[r, count - 1:2 * count - 1] = f, c
                at = 2 * at + (bins[np.arange(n), f[at]] > c[at])
            gs, hs = np.bincount(at, g, 1 << DEPTH), np.bincount(at, h, 1 << DEPTH)
            leaf[r] = RATE * gs / (hs + 1)
            odds += leaf[r][at]
        return cls(edges, feature, cut, leaf, base)

    def odds(self, x: np.ndarray) -> np.ndarray:
        bins = self.binned(x, self.edges)
        rows = np.arange(len(x))
        out = np.full(len(x), self.base)
        for f, c, leaf in zip(self.feature, self.cut, self.leaf):
            at = np.zeros(len(x), np.int64)
            for level in range(DEPTH):
                node = at + (1 << level) - 1
                at = 2 * at + (bins[rows, f[node]] > c[node])
            out += leaf[at]
        return out


def learnt(sources: list[str]) -> Trees | None:
    """Trees from pages whose markup says what is main; None if none does."""
    rng = random.Random(SEED)
    fill = []
    for s in sources:
        fill += [" ".join(t.split()) for t in re.findall(r"<(?:p|li|div)\b[^>]*>([^<>]{3,400})<", s)[:20]]
    fill = fill or ["text"]
    xs, ys, ws = [], [], []
    for s in sources:
        for copy in range(4):
            page = parse(s if copy == 0 else altered(s, fill, rng))
            main = _main_of(page)
            if main is None:
                break
            if copy >= 2:
                _plain_tags(page, rng)
            nodes = Nodes(page)
            shown = ~np.array(page.hidden)
            # what only holds parts of both says nothing about main text
            mixed = np.array([main[i:e].any() and not main[i] for i, e in enumerate(page.ends)])
            take = shown & ~mixed
            xs.append(nodes.features[take]), ys.append(main[take])
            ws.append((0.2 + nodes.weight[take]) / max(1.0, nodes.weight[take].sum() / 50))
    if not xs:
        return None
    y = np.concatenate(ys)
    weight = np.concatenate(ws)
    weight = np.where(y, weight / max(weight[y].sum(), 1e-9), weight / max(weight[~y].sum(), 1e-9)) * len(y) / 2
    return Trees.fit(np.concatenate(xs), y, weight)


def decide(nodes: Nodes, odds: np.ndarray) -> np.ndarray:
    """Which elements are main: outside, main, excluded along every way down."""
    page = nodes.page
    n = len(odds)
    value = np.clip(odds, -SURE, SURE) * (nodes.weight * WEIGHT + 0.05)
    value[np.array(page.hidden)] = -1e9
    # best sum of a subtree whose top is outside, main or excluded
    outside, inside, excluded = -value, value.copy(), -value
    outside[0], inside[0], excluded[0] = 0.0, -1e9, 0.0
    children: list[list[int]] = [[] for _ in range(n)]
    for i in range(n - 1, 0, -1):
        p = page.parents[i]
        children[p].append(i)
        # a child of something outside may open main text; one of main may end it
        outside[p] += max(outside[i], inside[i])
        inside[p] += max(inside[i], excluded[i])
        excluded[p] += excluded[i]
    state = np.zeros(n, np.int8)  # 0 outside, 1 main, 2 excluded
    for i in range(1, n):
        above = state[page.parents[i]]
        if above == 0:
            state[i] = 1 if inside[i] > outside[i] else 0
        elif above == 1:
            state[i] = 1 if inside[i] >= excluded[i] else 2
        else:
            state[i] = 2
    return state == 1


def main_of(nodes: Nodes, odds: np.ndarray) -> np.ndarray:
    """The elements to take: those decided on, or where these have no text, as on a page of
    bare text, all that is neither marked as something else nor mostly links."""
    main = decide(nodes, odds)
    return main if (main & (nodes.weight > 0)).any() else nodes.plain


def text_of(page: Page, main: np.ndarray) -> str:
    """The main elements' texts: one line for each block that has any."""
    lines: list[str] = []
    block, parts = -1, []
    for element, text, _, b in page.pieces:
        if not main[element]:
            continue
        if b != block:
            lines.append("".join(parts))
            block, parts = b, []
        parts.append(text)
    lines.append("".join(parts))
    clean = (" ".join(decoded(line).split()) for line in lines)
    return "\n".join(line for line in clean if line)


def texts(sources: list[str | None], trees: Trees | None) -> list[str]:
    pages = [parse(s or "") for s in sources]
    nodes = [Nodes(p) for p in pages]
    if trees is None:  # nothing was learnt: everything that shows
        return [text_of(p, ~np.array(p.hidden)) for p in pages]
    odds = trees.odds(np.concatenate([x.features for x in nodes])) if nodes else np.zeros(0)
    ends = np.cumsum([len(x.features) for x in nodes])
    return [text_of(p, main_of(x, odds[e - len(x.features):e])) for p, x, e in zip(pages, nodes, ends.tolist())]


def fit(pages: DataFrame, page_id: str = "page_id", html: str = "html") -> Trees | None:
    """The trees learnt, in one task, from TRAIN_PAGES of the pages that have an article or
    main element; None if no page has one."""
    sample = only(pages, page_id, html).filter(F.col(html).rlike(r"(?i)<(article|main)[\s>/]")).orderBy(
        F.xxhash64(F.col(page_id), F.lit(SEED)), page_id, html
    ).limit(TRAIN_PAGES).select(F.col(page_id).alias("page_id"), F.col(html).alias("html"))

    def learn(batches):
        rows = [(i, h) for b in batches for i, h in zip(b.column("page_id").to_pylist(), b.column("html").to_pylist())]
        trees = learnt([h for _, h in sorted(rows, key=lambda r: (r[0] is None, r))])
        if trees is not None:
            yield pa.RecordBatch.from_pydict({
                "base": [trees.base],
                **{k: pa.array([getattr(trees, k).tobytes()], pa.binary()) for k in ("edges", "feature", "cut", "leaf")},
            })

    made = sample.repartition(1).mapInArrow(
        learn, "base double, edges binary, feature binary, cut binary, leaf binary"
    ).first()
    if made is None:
        return None
    nodes = (1 << DEPTH) - 1
    return Trees(
        np.frombuffer(made["edges"], np.float32).reshape(-1, BINS - 1),
        np.frombuffer(made["feature"], np.int16).reshape(-1, nodes),
        np.frombuffer(made["cut"], np.int16).reshape(-1, nodes),
        np.frombuffer(made["leaf"], np.float32).reshape(-1, 1 << DEPTH),
        made["base"],
    )


def extract(pages: DataFrame, trees: Trees | None, keep: list[str], html: str = "html", text: str = "text") -> DataFrame:
    """Columns ``keep`` and the main text of each page.

    Null and empty pages have an empty text, and so have those of menus and the like
    alone.  Rows that repeat stay; an empty table gives no rows.
    """
    only(pages, *keep, html)
    if text in keep:
        raise ValueError(f"the table has a column {text} already")
    shared = pages.sparkSession.sparkContext.broadcast(trees)
    schema = T.StructType([*pages.select(*keep).schema.fields, T.StructField(text, T.StringType())])
    rows = pages.select(*keep, F.col(html).alias("page_source"))

    def each(batches):
        for whole in batches:
            for begin in range(0, whole.num_rows, 200):
                batch = whole.slice(begin, 200)
                made = texts(batch.column("page_source").to_pylist(), shared.value)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:-1], pa.array(made, pa.string())], names=[*batch.schema.names[:-1], text]
                )

    return rows.mapInArrow(each, schema)
