"""Main text of web pages by composite text density.

For every node of a page's tree: characters per tag, adjusted by the share of link text. A
node's density sum adds the densities of its children; the node with the largest sum is the
core of the text, in an ``article`` or not. Nodes beside the path from the core to ``body``
belong to the text if they are at least as dense as the thinnest node on that path, or are
headings, paragraphs or quotes; all below a kept node is kept.

Navigation, headers, footers, sidebars, forms, adverts, notices, reader comments, scripts and
styles never count: they are known by element, role, or the name in a class or id, and lists
outside an article that are nearly all links are menus. A name is a whole token ("sidebar", not
"has-sidebar") or the first or last part of one ("site-footer"); it does not count on a node
that holds most of the page's text, unless an article stands elsewhere.
"""

from __future__ import annotations

import html
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"""
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+|[^>]*+)>""", re.S)
_RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "noembed", "noframes", "xmp"}
_RAW_END = {t: re.compile(rf"</{t}[\s/>]", re.I) for t in _RAW}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source",
         "track", "wbr"}
_BLOCK = {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details",
          "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1",
          "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu",
          "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead",
          "tr", "ul"}
_DROP = _RAW | {"head", "nav", "header", "footer", "aside", "form", "template", "object", "svg", "canvas",
                "math", "button", "select", "menu", "dialog", "audio", "video", "map"}
_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert",
          "alertdialog", "dialog", "menu", "menubar", "toolbar"}
_NAMES = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb",
          "breadcrumbs", "comment", "comments", "consent", "cookie", "cookies", "copyright", "disqus",
          "footer", "header", "login", "masthead", "menu", "modal", "nav", "navbar", "navigation",
          "newsletter", "notice", "popup", "promo", "promoted", "related", "replies", "respond", "share",
          "sharing", "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe", "toolbar"}
# elements whose start ends an open element of the same group
_SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
             "th": {"td", "th"}, "option": {"option"}}
_SCOPE = {"ul", "ol", "dl", "table", "tbody", "thead", "tfoot", "tr", "div", "article", "section", "main", "body"}
_ATTR = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))|\b(hidden)\b""")


#: A first part that says what a node has or is like, not what it is.
_ABOUT = {"has", "with", "no", "without", "is", "not", "hide", "show", "below", "above", "before", "after"}
_TITLES = {"header", "masthead", "banner"}  # inside an article they hold its title


def _named(token: str, in_article: bool) -> bool:
    """Whether a token of a class or id names a part that is no main text."""
    parts = [p for p in re.split(r"[^a-z]+", token) if p]
    if not parts or parts[0] in _ABOUT:
        return False
    return any(p in _NAMES and not (in_article and p in _TITLES) for p in (parts[0], parts[-1]))


_HARD, _SOFT = 1, 2


def _dropped(tag: str, attrs: str, in_article: bool) -> int:
    """_HARD: dropped by element or role; _SOFT: by a name; 0: not dropped."""
    if tag in _DROP and not (tag == "header" and in_article):
        return _HARD
    if not attrs.strip() or tag in ("html", "body", "article", "main"):
        return 0
    soft = 0
    for m in _ATTR.finditer(attrs):
        name, value = (m[1] or m[5]).lower(), (m[2] or m[3] or m[4] or "").lower()
        if name == "hidden" or name == "role" and value in _ROLES or name == "aria-hidden" and value == "true":
            return _HARD
        if name in ("class", "id") and any(_named(t, in_article) for t in value.split()):
            soft = _SOFT
    return soft


class _Open:
    """The open elements. Places of the innermost element of each kind, and of the innermost
    one that bounds a search, are kept, so that a tag costs the same at any depth."""

    def __init__(self):
        self.nodes, self.tags, self.scopes = [0], ["#root"], [0]
        self.at: dict[str, list[int]] = {}

    def push(self, node: int, tag: str) -> None:
        place = len(self.nodes)
        self.at.setdefault(tag, []).append(place)
        self.scopes.append(place if tag in _SCOPE else self.scopes[-1])
        self.nodes.append(node)
        self.tags.append(tag)

    def close(self, tags, bounded: bool) -> None:
        """End the innermost element of ``tags`` and all inside it, if there is one (bounded:
        within the innermost scope)."""
        place = max((self.at[t][-1] for t in tags if self.at.get(t)), default=0)
        if place and (not bounded or place >= self.scopes[-1]):
            for tag in self.tags[place:]:
                self.at[tag].pop()
            del self.nodes[place:], self.tags[place:], self.scopes[place:]


class _Page:
    """Nodes in the order of their start tags, so a node comes after its parent."""

    def __init__(self):
        self.tag, self.parent, self.drop = ["#root"], [-1], [0]
        self.link, self.article = [False], [False]  # inside an anchor, inside an article
        self.texts: list[tuple[int, int, str]] = []  # node, block, text

    def read(self, source: str) -> None:
        opened, block, at = _Open(), 0, 0
        nodes = opened.nodes
        hard = [False]  # inside a node that is dropped in any case

        def text(a: int, b: int) -> None:
            if b > a and not hard[nodes[-1]]:
                self.texts.append((nodes[-1], block, source[a:b]))

        while True:
            m = _TAG.search(source, at)
            if m is None:
                text(at, len(source))
                return
            text(at, m.start())
            at = m.end()
            if m[2] is None:
                continue
            tag = m[2].lower()
            if tag in _BLOCK:
                block += 1
            if m[1]:
                if tag not in _VOID:
                    opened.close((tag,), tag not in _BLOCK)
                continue
            if tag == "br":
                if not hard[nodes[-1]]:
                    self.texts.append((nodes[-1], block, " "))
                continue
            ends = _SIBLINGS.get(tag, set()) | ({"p"} if tag in _BLOCK else set())
            if ends:
                opened.close(ends, True)
            top, own = nodes[-1], m[3] or ""
            within = self.article[top]
            dropped = _dropped(tag, own, within)
            self.tag.append(tag)
            self.parent.append(top)
            self.link.append(self.link[top] or tag == "a")
            self.article.append(within or tag in ("article", "main"))
            self.drop.append(dropped)
            hard.append(hard[top] or dropped == _HARD)
            if tag in _RAW:
                end = _RAW_END[tag].search(source, at)
                at = end.start() if end else len(source)
            if tag not in _VOID and not own.endswith("/"):
                opened.push(len(self.tag) - 1, tag)

    def settle(self, sizes: list[int]) -> None:
        """Decide which nodes are dropped; ``sizes``: characters of each node's own texts."""
        n = len(self.tag)
        whole, article = list(sizes), [s if a else 0 for s, a in zip(sizes, self.article)]
        for i in range(n - 1, 0, -1):
            whole[self.parent[i]] += whole[i]
            article[self.parent[i]] += article[i]
        for i in range(1, n):
            most = 2 * whole[i] > whole[0] and article[i] == article[0]
            own = self.drop[i] == _HARD or self.drop[i] == _SOFT and not most
            self.drop[i] = bool(self.drop[self.parent[i]] or own)


def main_text(source: str | None) -> str:
    """Blocks of the article in page order, parted by an empty line; "" if there are none."""
    if not source:
        return ""
    page = _Page()
    page.read(source)
    n = len(page.tag)
    chars, linked, tags, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
    pieces = []
    for node, block, raw in page.texts:
        piece = html.unescape(raw) if "&" in raw else raw
        size = len(piece) if piece.strip() else 0
        pieces.append((node, block, piece))
        chars[node] += size
    page.settle(chars)
    for i in range(n):
        chars[i] = 0 if page.drop[i] else chars[i]
        linked[i] = chars[i] if page.link[i] else 0
    for i in range(n - 1, 0, -1):
        up = page.parent[i]
        if not page.drop[i]:
            chars[up] += chars[i]
            linked[up] += linked[i]
            tags[up] += tags[i] + 1
            link_tags[up] += link_tags[i] + (page.tag[i] == "a")
    if not chars[0]:
        return ""
    body_links = linked[0] / chars[0]

    def density(i: int) -> float:
        """Characters per tag times the logarithm of characters per linked character and tags
        per link, to a base that grows with the node's own and the page's links."""
        c, t, lc, lt = chars[i], max(tags[i], 1), max(linked[i], 1), max(link_tags[i], 1)
        if not c:
            return 0.0
        base = c / max(c - linked[i], 1) * linked[i] + body_links * c + math.e
        return c / t * math.log(max(c * t / (lc * lt), 1.0)) / math.log(base)

    dense = [0.0 if page.drop[i] else density(i) for i in range(n)]
    sums, leaf = [0.0] * n, [True] * n
    for i in range(1, n):
        if not page.drop[i]:
            sums[page.parent[i]] += dense[i]
            leaf[page.parent[i]] = False
    for i in range(n):
        if leaf[i]:
            sums[i] = dense[i]
    core = max((i for i in range(n) if not page.drop[i]), key=lambda i: (sums[i], -i))
    path = [core]
    while path[-1] and page.tag[path[-1]] != "body":
        path.append(page.parent[path[-1]])
    keep = [False] * n
    on_path = set(path)
    least = min(dense[i] for i in path)
    for i in range(n):
        if page.drop[i]:
            continue
        up = page.parent[i]
        if i == core or i and keep[up]:
            keep[i] = True
        elif up in on_path and i not in on_path and chars[i]:
            keep[i] = dense[i] >= least or page.tag[i] in ("h1", "h2", "h3", "p", "pre", "blockquote")
        if keep[i] and page.tag[i] in ("ul", "ol", "table", "div", "section") and link_tags[i] >= 3 \
                and linked[i] >= 0.8 * chars[i] and i not in on_path and not page.article[i]:
            keep[i] = False
            page.drop[i] = True
    blocks: dict[int, list[str]] = {}
    for node, block, piece in pieces:
        if keep[node]:
            blocks.setdefault(block, []).append(piece)
    lines = (" ".join("".join(parts).split()) for parts in blocks.values())
    return "\n\n".join(line for line in lines if line)


def _extract(batches):
    for batch in batches:
        texts = [main_text(x.as_py()) for x in batch.column("html")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
             pa.array([len(t) for t in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"])


def extract_main_text(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages`` (page_id, url, html): page_id, url, text, n_chars.

    NULL and empty pages, and pages without text, give the empty text; broken markup is read
    as far as it goes; NULL ids and urls and repeated rows are passed through; extra columns
    are ignored; an empty table gives no rows.
    """
    narrow = pages.selectExpr("cast(page_id as bigint) as page_id", "cast(url as string) as url",
                              "cast(html as string) as html")
    return narrow.mapInArrow(_extract, "page_id bigint, url string, text string, n_chars bigint")
