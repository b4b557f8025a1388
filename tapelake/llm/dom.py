"""A page as a list of nodes: a forgiving HTML reader that keeps block elements and the text right inside them."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

# Elements without text of their own. What stands in noscript, object or math is text like any other.
RAW = {"script", "style", "template", "iframe", "svg", "select", "textarea", "button", "title", "head"}
# Elements whose content is not markup.
_OPAQUE = {"script", "style", "textarea", "title", "iframe", "xmp", "noembed", "noframes"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset",
    "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "html", "legend", "li", "main",
    "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
# An opening tag that ends elements which are still open, and where the search for them stops.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}), "option": ({"option"}, {"select"}), "body": ({"head"}, set()),
}
_CLOSES_P = BLOCKS - {"body", "html", "caption", "dd", "dt", "li", "tbody", "td", "tfoot", "th", "thead", "tr", "legend", "summary"}
# A paragraph is sought no further than the innermost of these.
_P_SCOPE = BLOCKS - {"p"}

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([A-Za-z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|style|itemprop|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_SPACE = re.compile(r"\s+")


@dataclass
class Node:
    tag: str
    attributes: str
    parent: int
    depth: int
    place: int  # among the parent's block children
    children: list[int] = field(default_factory=list)
    texts: list[int] = field(default_factory=list)  # numbers of the page's text blocks right inside
    links: int = 0  # characters of direct text inside links
    inputs: int = 0


@dataclass
class Page:
    nodes: list[Node]
    texts: list[str]  # text blocks in page order
    owners: list[int]  # the node that each lies in


def read(source: str | None) -> Page:
    nodes = [Node("html", "", -1, 0, 0)]
    page = Page(nodes, [], [])
    stack: list[tuple[str, int]] = [("html", 0)]  # open elements; the node each lies in or is
    parts: list[str] = []
    link_chars = anchors = 0
    skipped: list[str] = []

    def flush() -> None:
        nonlocal link_chars
        if parts:
            text = _SPACE.sub(" ", html.unescape("".join(parts))).strip()
            parts.clear()
            if text:
                owner = stack[-1][1]
                nodes[owner].texts.append(len(page.texts))
                nodes[owner].links += min(link_chars, len(text))
                page.texts.append(text)
                page.owners.append(owner)
            link_chars = 0

    def close(k: int) -> None:
        nonlocal anchors
        if any(t in BLOCKS for t, _ in stack[k:]):
            flush()
        for tag, _ in stack[k:]:
            anchors -= tag == "a"
            if tag in RAW:
                skipped.pop()
        del stack[k:]

    source = source or ""
    at = 0
    while True:
        m = _TOKEN.search(source, at)
        text = source[at : m.start() if m else len(source)]
        if text and not skipped:
            parts.append(text)
            if anchors:
                link_chars += len(text)
        if not m:
            break
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if m[1] or m[4]:
            stop = next((k for k in range(len(stack) - 1, 0, -1) if stack[k][0] == tag or (tag not in BLOCKS and tag not in RAW and stack[k][0] in BLOCKS)), 0)
            if stop and stack[stop][0] == tag:
                close(stop)
            continue
        if tag in _VOID:
            if tag in ("br", "hr", "img"):
                parts.append(" ")
            if tag == "hr":
                flush()
            if tag == "input":
                nodes[stack[-1][1]].inputs += 1
            continue
        if tag == "html":
            continue
        ends, scope = _ENDS.get(tag, (None, None))
        if ends:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in scope:
                    break
                if stack[k][0] in ends:
                    close(k)
        if tag in _CLOSES_P:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == "p":
                    close(k)
                    break
                if stack[k][0] in _P_SCOPE:
                    break
        attributes = m[3] or m[6] or ""
        if tag in RAW:
            if tag in ("select", "textarea", "button"):
                nodes[stack[-1][1]].inputs += 1
            if tag in _OPAQUE:
                end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(source, at)
                at = end.end() if end else len(source)
                continue
            skipped.append(tag)
            stack.append((tag, stack[-1][1]))
        elif tag in BLOCKS:
            flush()
            owner = stack[-1][1]
            if tag == "body" and any(n.tag == "body" for n in nodes[:3]):
                continue
            nodes.append(Node(tag, _words(attributes), owner, nodes[owner].depth + 1, len(nodes[owner].children)))
            nodes[owner].children.append(len(nodes) - 1)
            stack.append((tag, len(nodes) - 1))
        else:
            anchors += tag == "a"
            stack.append((tag, stack[-1][1]))
    flush()
    return page


def _words(attributes: str) -> str:
    """Class, id and role in lower case; camel case, hyphens and underscores are word ends."""
    if not attributes.strip():
        return ""
    out = []
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value)):
            out.append("hidden")
        elif name in ("class", "id", "role", "itemprop"):
            out.append(re.sub(r"([a-z])([A-Z])", r"\1 \2", value))
    return " ".join(re.split(r"[^a-z]+", " ".join(out).lower())).strip()
