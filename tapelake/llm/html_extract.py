"""Main text of web pages: gradient-boosted trees over the page's nodes, decoded along the tree.

Each block element is a node with features of its tag, its class and id words, its depth and place among its siblings, and of
the text below it: amount, density, links, sentence ends, forms. Boosted trees score how likely the node belongs to the
article. They learn from a bounded sample of the pages themselves: where a page says what is what (article, main, nav, footer,
aside, form, telling class words), its nodes are labelled by that. The blocks of each such page are also set anew in pages of
random layout, whose parts are known: other wrappers, class words or none, with menus, notices, adverts, forms, sidebars and
comments around and inside the article. So the trees learn what tags and words mean and what the shape of the text shows
without them.

Decoding keeps the choices of ancestors and descendants consistent. On every path from the root the nodes are first outside the
article, then inside, then in something cut out of it (either part may be missing); dynamic programming over the tree finds the
assignment with the highest total score, where each change costs something. So a short paragraph inside the article stays, and
nothing inside a removed menu comes back.

Text: references are decoded, white space inside a block becomes one space, blocks are joined in page order by a line end.
Scripts, styles, comments, hidden elements, buttons and other elements that show no text of their own have none.

Defined results: a null or empty page, or one without article text, gives an empty text; repeated rows each get theirs; without
any page that says what is what, a page's nodes are all taken but those that class words and tags speak against. An empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import html
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapelake.llm.boosting import Boosted, fit_boosted
from tapelake.llm.common import map_batches
from tapelake.llm.dom import Page, read
from tapelake.llm.hashing import mix

SAMPLE_PAGES = 400
SAMPLE_NODES = 100_000
RESET = 3
SWITCH_COST = 4.0
MOST_LOGIT = 4.0

TAGS = [
    {"p"}, {"h1"}, {"h2", "h3", "h4", "h5", "h6"}, {"li", "dd", "dt"}, {"ul", "ol", "menu", "dl"}, {"div"}, {"section"}, {"article", "main"}, {"nav", "menu"},
    {"header"}, {"footer"}, {"aside"}, {"form", "fieldset"}, {"table", "tr", "td", "th", "tbody"}, {"blockquote", "pre", "figure", "figcaption"}, {"body", "html"},
]
# Words of class, id and role that tell what an element is for.
WORDS = {
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs sitemap toc pagination pager skip",
    "edge": "header masthead topbar footer foot copyright legal colophon bottom contentinfo",
    "side": "sidebar aside side rail widget related recommended recommendations more trending popular complementary",
    "notice": "cookie cookies consent gdpr notice alert banner popup modal overlay paywall message announcement",
    "advert": "ad ads adv advert advertisement advertising sponsor sponsored promo promotion promoted affiliate outbrain taboola",
    "comment": "comment comments disqus respond reply replies discussion reader feedback review reviews",
    "form": "form login signup signin subscribe subscription newsletter search register share sharing social follow tools",
    "hidden": "hidden invisible",
    "article": "article content main post entry story body text prose hentry articlebody",
}
_KINDS = {w: k for k, words in enumerate(WORDS.values()) for w in words.split()}
_ARTICLE, _HIDDEN = list(WORDS).index("article"), list(WORDS).index("hidden")
_N_TELLING = 2 * (len(TAGS) + len(WORDS))
_AGAINST = {"nav", "footer", "aside", "form", "fieldset", "menu", "dialog"}
_STOPS = re.compile(r"[.!?。…][\"'”’)]*(?:\s|$)")


def _telling(page: Page) -> np.ndarray:
    """Tag groups and word kinds of each node."""
    out = np.zeros((len(page.nodes), len(TAGS) + len(WORDS)))
    for i, node in enumerate(page.nodes):
        for k, group in enumerate(TAGS):
            out[i, k] = node.tag in group
        for word in node.attributes.split():
            if (kind := _KINDS.get(word)) is not None:
                out[i, len(TAGS) + kind] = 1
    return out


def features(page: Page) -> np.ndarray:
    """A row for each node: first the telling features of it and its parent, then those of shape."""
    nodes, n = page.nodes, len(page.nodes)
    telling = _telling(page)
    parents = np.array([max(x.parent, 0) for x in nodes])
    own = np.array([[sum(len(page.texts[t]) for t in x.texts), x.links, len(x.texts), sum(len(_STOPS.findall(page.texts[t])) for t in x.texts), x.inputs, 1, x.tag == "p", x.tag == "li"] for x in nodes], float)
    below = own.copy()
    for i in range(n - 1, 0, -1):  # children come after their parents
        below[parents[i]] += below[i]
    chars, links, blocks, stops, inputs, elements, paragraphs, items = below.T
    siblings = np.array([len(nodes[p].children) for p in parents], float)
    tags = Counter((x.parent, x.tag) for x in nodes)
    alike = np.array([tags[p, x.tag] for x, p in zip(nodes, parents.tolist(), strict=True)], float)
    total = max(chars[0], 1)
    here = np.cumsum(own[:, 0]) - own[:, 0]
    shape = np.stack(
        [
            np.log1p(chars), np.log1p(own[:, 0]), links / np.maximum(chars, 1), chars / np.maximum(elements, 1), chars / np.maximum(blocks, 1), stops / np.maximum(blocks, 1),
            np.log1p(paragraphs), np.log1p(items), np.log1p(inputs), chars / total, here / total, np.array([x.depth for x in nodes], float),
            np.array([x.place for x in nodes]) / np.maximum(siblings, 1), np.log1p(siblings), alike / np.maximum(siblings, 1),
            chars[parents] / total, links[parents] / np.maximum(chars[parents], 1), np.log1p(paragraphs[parents]), stops[parents] / np.maximum(blocks[parents], 1),
        ],
        1,
    )
    return np.concatenate((telling, telling[parents], shape), 1)


def spoken_against(page: Page, i: int, telling: np.ndarray, in_article: bool) -> bool:
    node = page.nodes[i]
    words = telling[i, len(TAGS) :]
    return node.tag in _AGAINST or (node.tag == "header" and not in_article) or (words.any() and not words[_ARTICLE]) or bool(words[_HIDDEN])


def labels(page: Page) -> np.ndarray:
    """1 inside the article, 0 outside, -1 where the page does not say."""
    telling = _telling(page)
    out = np.full(len(page.nodes), -1)
    says = any(x.tag in ("article", "main") for x in page.nodes)
    for i, node in enumerate(page.nodes):
        if i and out[node.parent] == 0 and node.tag not in ("article", "main"):
            out[i] = 0
        elif spoken_against(page, i, telling, i > 0 and out[node.parent] == 1):
            out[i] = 0
        elif i and out[node.parent] == 1 or node.tag in ("article", "main"):
            out[i] = 1
        elif says and node.texts:
            out[i] = 0
    return out


_NEUTRAL = ["", "", "wrap", "container", "row", "col", "box", "home page", "inner", "block", "x1"]
# Words of class that mark a part of a page set anew; no feature reads them.
_IN, _OUT = "zzin", "zzout"


def reset(page: Page, random: np.random.Generator) -> str | None:
    """A page of random layout made of the blocks of a labelled one; None where it has no article text."""
    known = labels(page)
    inside = [t for t, o in zip(page.texts, page.owners, strict=True) if known[o] == 1]
    if not inside:
        return None
    other = [t for t, o in zip(page.texts, page.owners, strict=True) if known[o] == 0] or inside
    pick = lambda options: options[random.integers(len(options))]
    e = html.escape

    def element(tags: list[str], content: str, label: str, kinds=(), sure: bool = False) -> str:
        tag, word = pick(tags), pick(_NEUTRAL)
        if kinds and (sure or random.random() < 0.75):
            word = f"{pick(['', 'main ', 'top ', 'x '] if not kinds == ['article'] else ['', 'x '])}{pick(WORDS[pick(kinds)].split())}"
        return f'<{tag} class="{word} {label}">{content}</{tag}>'

    def menu() -> str:
        items = "".join(f'<li><a href="/">{e(pick(other + inside)[: random.integers(4, 40)])}</a></li>' for _ in range(random.integers(2, 9)))
        return element(["nav", "div", "div", "section"], f"<ul>{items}</ul>", _OUT, ["menu", "edge"])

    def prose(n: int) -> str:
        return "".join(f"<p>{e(pick(inside))}</p>" if random.random() < 0.7 else f"<div>{e(pick(inside))}</div>" for _ in range(n))

    def aside(kinds: list[str], tags: list[str]) -> str:
        text = e(pick(other + inside)[: random.integers(10, 200)])
        body = text if random.random() < 0.4 else prose(random.integers(1, 4))
        body += pick(["", "", '<button>OK</button>', '<input name="q">', '<a href="/">more</a>'])
        return element(tags, body, _OUT, kinds, sure=True)

    def boilerplate() -> str:
        return pick(
            [
                menu,
                lambda: aside(["notice"], ["div", "section", "p"]),
                lambda: aside(["advert"], ["div", "section", "aside", "p"]),
                lambda: aside(["side", "form"], ["div", "aside", "section"]),
                lambda: aside(["comment"], ["div", "section", "ul"]),
                lambda: element(["form"], f'<input name="q"> {e(pick(other)[:30])}', _OUT, ["form"]),
            ]
        )()

    parts = [f"<{t}>{e(x)}</{t}>" for k, x in enumerate(inside) for t in [pick(["h1", "h2", "p"]) if k == 0 else pick(["p"] * 8 + ["h2", "li", "blockquote", "div"])]]
    for _ in range(random.integers(0, 3)):
        parts.insert(random.integers(len(parts) + 1), boilerplate())
    article = element(["article", "main", "div", "div", "section"], "".join(parts), _IN, ["article"])
    around = [article]
    for _ in range(random.integers(0, 4)):
        around.insert(random.integers(len(around) + 1), boilerplate())
    body = "".join(around)
    for _ in range(random.integers(0, 3)):
        body = f'<div class="{pick(_NEUTRAL)}">{body}</div>'
    top = element(["header", "div"], e(pick(other)[:60]) + pick(["", menu()]), _OUT, ["edge"]) if random.random() < 0.6 else menu()
    foot = element(["footer", "div"], f"&copy; {e(pick(other)[:80])}", _OUT, ["edge"])
    return f'<body class="{pick(_NEUTRAL)}">{top}{pick(["", boilerplate()])}{body}{pick(["", boilerplate()])}{foot}</body>'


def reset_labels(page: Page) -> np.ndarray:
    """The labels of a page set anew: those of the innermost marked part."""
    out = np.full(len(page.nodes), -1)
    for i, node in enumerate(page.nodes):
        words = node.attributes.split()
        out[i] = 1 if _IN in words else 0 if _OUT in words else out[node.parent] if i else -1
    return out


def decode(page: Page, logit: np.ndarray) -> list[str]:
    """The text blocks of the nodes that are inside the article by the best consistent assignment."""
    nodes, n = page.nodes, len(page.nodes)
    weight = np.array([0.5 if not x.texts else 1 + np.log1p(sum(len(page.texts[t]) for t in x.texts)) / 4 for x in nodes])
    gain = np.clip(logit, -MOST_LOGIT, MOST_LOGIT) * weight
    best = np.stack((-gain, gain, -gain), 1)  # before, inside, cut out
    choice = np.zeros((n, 3), np.int8)
    for i in range(n - 1, 0, -1):
        before, inside, cut = best[i]
        options = ((before, inside - SWITCH_COST), (inside, cut - SWITCH_COST), (cut, -np.inf))
        for state in range(3):
            choice[i, state] = state + (options[state][1] > options[state][0])
            best[nodes[i].parent, state] += max(options[state])
    state = np.zeros(n, np.int8)
    for i in range(n):
        state[i] = choice[i, state[nodes[i].parent]] if i else int(best[0, 1] > best[0, 0])
    return [text for text, owner in zip(page.texts, page.owners, strict=True) if state[owner] == 1]


def fit(pages: DataFrame, sample_pages: int = SAMPLE_PAGES, sample_nodes: int = SAMPLE_NODES) -> Boosted:
    """Trees from about ``sample_pages`` pages chosen by hash, and ``sample_nodes`` nodes of them at most."""
    every = max(1, -(-pages.count() // sample_pages))
    some = pages.filter(F.pmod(F.xxhash64("page_id", "url"), F.lit(every)) == 0).select("html")

    def measure(batch: pa.RecordBatch) -> dict:
        x, y, h = [], [], []
        for source in batch.column("html").to_pylist():
            page = read(source)
            random = np.random.default_rng(len(source or ""))
            again = [p for p in (reset(page, random) for _ in range(RESET)) if p]
            for one, label in [(page, labels(page)), *((p, reset_labels(p)) for p in map(read, again))]:
                known = label >= 0
                x.append(features(one)[known])
                y.append(label[known])
                start = np.uint64(zlib.crc32((source or "").encode()) << 20)
                h.append(mix(start + np.arange(len(label), dtype=np.uint64)[known]).view(np.int64))
        return {"x": list(np.concatenate(x)), "y": np.concatenate(y), "h": np.concatenate(h)}

    # Which nodes are taken depends on pages and nodes alone, not on which task is first.
    measured = map_batches(some, measure, "x array<double>, y int, h long", text="html")
    rows = measured.orderBy("h", "y", "x").limit(sample_nodes).toPandas()
    width = _N_TELLING + len(_SHAPE)
    x = np.stack(rows["x"].to_numpy()) if len(rows) else np.zeros((0, width))
    y = rows["y"].to_numpy(float) if len(rows) else np.zeros(0)
    order = np.lexsort((*x.T[::-1], y))  # the same model whatever order the rows come in
    return fit_boosted(x[order], y[order], trees=80)


_SHAPE = [
    "chars", "own_chars", "link_share", "chars_per_element", "chars_per_block", "stops_per_block", "paragraphs", "items", "inputs", "page_share", "before_share",
    "depth", "place", "siblings", "alike", "parent_share", "parent_links", "parent_paragraphs", "parent_stops",
]


def extract(pages: DataFrame, model: Boosted | None = None) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    shared = pages.sparkSession.sparkContext.broadcast(model or fit(pages))

    def run(batch: pa.RecordBatch) -> dict:
        model, found = shared.value, [read(x) for x in batch.column("html").to_pylist()]
        if model.trees:
            logit = model.logit(np.concatenate([features(p) for p in found]))
        else:
            logit = np.concatenate([_by_rule(p) for p in found])
        texts, at = [], 0
        for page in found:
            texts.append("\n".join(decode(page, logit[at : at + len(page.nodes)])))
            at += len(page.nodes)
        return {"page_id": batch.column("page_id"), "url": batch.column("url"), "text": texts, "n_chars": [len(t) for t in texts]}

    return map_batches(pages.select("page_id", "url", "html"), run, "page_id long, url string, text string, n_chars long", text="html", most_bytes=1_000_000)


def _by_rule(page: Page) -> np.ndarray:
    telling = _telling(page)
    return np.array([-MOST_LOGIT if spoken_against(page, i, telling, False) else 1.0 for i in range(len(page.nodes))])
