"""Main text of a web page by tree scoring.

A page becomes a tree of elements. Every paragraph passes points for its length and its commas to its ancestors, less the
farther up; a container's points are discounted by the share of its text that stands in links. The best container is kept,
with its siblings in page order. Scripts, styles, menus, headers, footers, sidebars, forms and elements one of whose classes or
whose id names an advert, notice, share bar or comment are cut off before scoring; what holds the page's main or largest article
element, and a form around most of the page's text, is not; words that an article may use for its own parts (SOFT_WORDS) cut inside an
article or main element only what is mostly links and controls. Without such an element the result climbs from the best container to the highest
ancestor whose other children score as well.

Defined results: null or empty html gives empty text; pages without paragraphs fall back on the body's own blocks; unclosed
and wrongly nested tags are closed as browsers do for paragraphs, list items and table cells; repeated rows and null ids give
one row each; of equally good containers the first found stays; a very long page costs its own tree in one task; an empty table gives no
rows; other columns are ignored. White space is what Unicode says is white space.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame

# Element names of HTML, by their part in a page.
SKIPPED = {"script", "style", "noscript", "template", "svg", "math", "iframe", "object", "embed", "canvas", "audio", "video",
           "nav", "footer", "aside", "form", "button", "select", "textarea", "input", "label", "fieldset", "dialog", "menu", "head", "title"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"script", "style", "noscript", "template", "iframe", "textarea", "title"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "center", "dd", "details", "div", "dl", "dt", "fieldset", "figcaption",
         "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html", "legend", "li", "main", "nav", "ol", "p",
         "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul", "caption", "br"}
CLOSES_P = BLOCK - {"br", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "html", "body", "legend", "summary"}
SIBLING_CLOSE = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
                 "option": {"option"}}
SCOPE = {"table", "ul", "ol", "dl", "article", "section", "main", "div", "body", "html", "blockquote", "td", "th"}
# Elements that never hold article text, whatever is in them.
DROPPED = {"script", "style", "noscript", "template", "svg", "math", "iframe", "object", "embed", "canvas", "audio", "video", "head", "title",
           "select", "textarea"}
# Whole classes or ids that mark what is not the article, and first parts of longer ones that do.
CUT_WORDS = frozenset((
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices "
    "alert popup modal overlay newsletter subscribe subscription signup login nav navbar navigation menu menus breadcrumb breadcrumbs "
    "pagination pager sidebar aside footer masthead topbar toolbar skip comment comments commentlist disqus replies reply respond "
    "discussion share sharing social related recommended recommendations widget widgets tags meta byline copyright legal disclaimer "
    "outbrain taboola footnotes site-header site-footer page-footer site-nav main-nav main-navigation site-navigation entry-meta post-meta "
    "post-tags entry-tags social-share share-buttons top-ad").split())
CUT_PREFIXES = frozenset("ad ads advert advertisement sponsored promo cookie cookies gdpr newsletter popup modal breadcrumb comments related share outbrain taboola".split())
# Last parts of longer classes or ids that mark the same, and first parts that make them mere layout flags.
CUT_SUFFIXES = frozenset("comment comments commentlist menu nav navbar navigation breadcrumb breadcrumbs sidebar footer newsletter ad ads advert promo".split())
FLAGS = frozenset("has with no without is show hide open".split())
# Marks that an article may give to its own parts.
SOFT_WORDS = frozenset("discussion legal meta tags footnotes copyright disclaimer respond reply replies related social overlay skip banner header share byline".split())
CUT_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "menu", "menubar", "alertdialog"}

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
_ATTR = re.compile(r"([^\s=\"'>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_PART = re.compile(r"[-_]")
#: Points, less links, from which on a container beside the way up to the root belongs to the article: a comma or a hundred characters.
BESIDE = 2.0


class Node:
    __slots__ = ("name", "parent", "children", "points", "marked")

    def __init__(self, name: str, parent: Node | None) -> None:
        self.name, self.parent, self.children, self.points, self.marked = name, parent, [], 0.0, NONE


#: How an element is marked: not at all, cut, or cut where it is mostly links and controls.
NONE, FIRM, SOFT = 0, 1, 2


def _names_mark(names: list[str], in_article: bool) -> int:
    level = NONE
    for name in names:
        parts = _PART.split(name)
        long = len(parts) > 1
        cut = name in CUT_WORDS or name == "header" or (long and (parts[0] in CUT_PREFIXES or (parts[-1] in CUT_SUFFIXES and parts[0] not in FLAGS)))
        if cut and not (in_article and name in SOFT_WORDS):
            return FIRM
        level = SOFT if cut else level
    return level


def _mark(attributes: str, in_article: bool) -> int:
    """The mark that the attributes give, each of them read by itself."""
    level = NONE
    if "=" not in attributes and "hidden" not in attributes:
        return level
    for found in _ATTR.finditer(attributes):
        name = found[1].lower()
        value = (found[2] or found[3] or found[4] or "").lower()
        if name in ("class", "id"):
            now = _names_mark(value.split(), in_article)
            if now == FIRM:
                return now
            level = level or now
        elif (name == "role" and value in CUT_ROLES) or name == "hidden" or (name == "aria-hidden" and value == "true") or (
                name == "style" and "display:none" in value.replace(" ", "")):
            return FIRM
    return level


def parse(page: str) -> Node:
    """The tree of what may be article; cut-off elements leave nothing behind."""
    root = node = Node("html", None)
    skipping: list[str] = []  # open elements inside one that was cut off
    at, size = 0, len(page)
    while at < size:
        found = _TOKEN.search(page, at)
        start = found.start() if found else size
        if start > at and not skipping:
            node.children.append(page[at:start])
        if not found:
            break
        at = found.end()
        name = found[2] or found[5]
        if name is None:
            continue
        name, closing, attributes = name.lower(), found[1] or found[4], (found[3] if found[2] else found[6]) or ""
        if closing:
            if skipping:
                if name in skipping:
                    while skipping.pop() != name:
                        pass
                elif name in ("article", "main", "body", "html") and _open(node, name):
                    skipping.clear()  # an unclosed element that was cut off ends with what holds it
                    node = _close(node, name)
                continue
            node = _close(node, name)
            continue
        if name in RAW and not attributes.endswith("/"):
            end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            at = end.end() if end else size
            continue
        if name in VOID:
            if name in ("br", "hr") and not skipping:
                node.children.append(Node(name, node))
            continue
        if skipping:
            if name == "article" and skipping[0] in ("label", "button", "p"):
                skipping.clear()
            else:
                if not attributes.endswith("/"):
                    skipping.append(name)
                continue
        if name in CLOSES_P and _open(node, "p", SCOPE):
            node = _close(node, "p")
        if name in SIBLING_CLOSE:
            while node.parent is not None and node.name in SIBLING_CLOSE[name]:
                node = node.parent
        if name in DROPPED:
            if not attributes.endswith("/"):
                skipping.append(name)
            continue
        if name == "html":
            continue
        child = Node(name, node)
        inside = _open(node, "article") or _open(node, "main")
        if name in SKIPPED or (name == "header" and not inside):
            child.marked = FIRM
        elif name != "body" and attributes:
            child.marked = _mark(attributes, inside)
        node.children.append(child)
        if not attributes.endswith("/") or name in BLOCK:
            node = child
    _prune(root)
    return root


def _prune(root: Node) -> None:
    """Cuts marked elements off, except around the page's main or largest article and forms around most of the text."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(c for c in node.children if isinstance(c, Node))
    whole: dict[Node, int] = {}  # all text below
    free: dict[Node, int] = {}  # text below that is in no marked element but forms
    busy: dict[Node, int] = {}  # text below that is in links and marked elements
    for node in reversed(order):
        own = sum(len(c.strip()) for c in node.children if isinstance(c, str))
        below = [c for c in node.children if isinstance(c, Node)]
        whole[node] = own + sum(whole[c] for c in below)
        busy[node] = whole[node] if node.name == "a" else sum(whole[c] if c.marked == FIRM else busy[c] for c in below)
        if node.marked == SOFT:
            node.marked = FIRM if 2 * busy[node] > whole[node] else NONE
        free[node] = own + sum(0 if c.marked and c.name != "form" else free[c] for c in below)
    spared: set[Node] = set()
    found = [n for n in order if n.name == "main"] or [n for n in order if n.name == "article"]
    if found:
        node = max(found, key=whole.__getitem__)
        # an article among comments or teasers is not the page's: it has less text than what no mark holds
        if node.name == "article" and whole[node] < free[root]:
            node = None
        while node is not None:
            spared.add(node)
            node = node.parent
    spared.update(n for n in order if n.name == "form" and 2 * free[n] > free[root])
    for node in order:
        if any(isinstance(c, Node) and c.marked for c in node.children):
            node.children = [c for c in node.children if isinstance(c, str) or not c.marked or c in spared]


def _open(node: Node | None, name: str, stop: set[str] = frozenset()) -> bool:
    while node is not None:
        if node.name == name:
            return True
        if node.name in stop:
            return False
        node = node.parent
    return False


def _close(node: Node, name: str) -> Node:
    return_to = node
    while return_to is not None and return_to.name != name:
        return_to = return_to.parent
    return node if return_to is None or return_to.parent is None else return_to.parent


def _measure(root: Node) -> tuple[dict[Node, float], dict[Node, float]]:
    """Characters of text, and of text in links, below every element."""
    total: dict[Node, float] = {}
    linked: dict[Node, float] = {}
    order, stack = [], [(root, False)]
    while stack:
        node, in_link = stack.pop()
        in_link = in_link or node.name == "a"
        order.append((node, in_link))
        stack.extend((c, in_link) for c in node.children if isinstance(c, Node))
    for node, in_link in reversed(order):
        text = sum(len(c.strip()) for c in node.children if isinstance(c, str))
        total[node] = text + sum(total[c] for c in node.children if isinstance(c, Node))
        linked[node] = total[node] if in_link else sum(linked[c] for c in node.children if isinstance(c, Node))
    return total, linked


def _score(root: Node) -> list[Node]:
    """Pass every paragraph's points up: all to the parent, half to the next, less beyond; returns the containers."""
    containers: dict[Node, None] = {}
    stack = [root]
    while stack:
        node = stack.pop()
        stack.extend(c for c in node.children if isinstance(c, Node))
        inline = [c for c in node.children if isinstance(c, str) or c.name not in BLOCK]
        text = "".join(c if isinstance(c, str) else _flat(c) for c in inline).strip()
        if not text or (node.name not in BLOCK and node.parent is not None):
            continue
        points = 1 + text.count(",") + min(len(text) / 100, 3)
        up, share = (node.parent if node.name in ("p", "pre", "td", "li", "blockquote", "h1", "h2", "h3", "h4", "h5", "h6", "dd", "dt") and node.parent
                     is not None else node), 1.0
        level = 1
        while up is not None:
            up.points += points * share
            containers[up] = None
            level += 1
            up, share = up.parent, 0.5 if level == 2 else 1 / (3 * level)
    return list(containers)


def _flat(node: Node) -> str:
    out, stack = [], [node]
    while stack:
        item = stack.pop()
        if isinstance(item, str):
            out.append(item)
        else:
            stack.extend(reversed(item.children))
    return "".join(out)


def _blocks(nodes: list[Node]) -> list[str]:
    """Texts of the blocks below the nodes, in page order, references decoded and white space squeezed."""
    out: list[str] = []
    run: list[str] = []

    def flush() -> None:
        text = " ".join(html.unescape("".join(run)).split())
        run.clear()
        if text:
            out.append(text)

    stack: list = list(reversed(nodes))
    while stack:
        item = stack.pop()
        if item is None:
            flush()
        elif isinstance(item, str):
            run.append(item)
        elif item.name == "br":
            run.append("\n")
        elif item.name in BLOCK:
            flush()
            stack.append(None)
            stack.extend(reversed(item.children))
        else:
            stack.extend(reversed(item.children))
    flush()
    return out


def _runs(children: list) -> list[list]:
    """Every block alone; text and inline elements that stand together as one."""
    out: list[list] = []
    inline = False
    for child in children:
        block = isinstance(child, Node) and child.name in BLOCK and child.name != "br"
        if block or not inline:
            out.append([])
        out[-1].append(child)
        inline = not block
    return out


def main_text(page: str | None) -> str:
    if not page:
        return ""
    root = parse(page)
    containers = _score(root)
    if not containers:
        return " ".join(_blocks([root]))
    total, linked = _measure(root)
    value = {c: c.points * (1 - linked[c] / total[c] if total[c] else 0) for c in containers}
    best = max(containers, key=lambda c: value[c])
    # an article element around the best container is the article as its author marked it
    outer = best
    while outer is not None and outer.name not in ("article", "main"):
        outer = outer.parent
    best = outer or _climbed(best, value)
    kept = [best]
    if best.parent is not None:
        kept = []
        for whole in _runs(best.parent.children):
            text = sum(len(c.strip()) if isinstance(c, str) else total[c] for c in whole)
            in_links = sum(0 if isinstance(c, str) else linked[c] for c in whole)
            if best in whole or 2 * in_links < text:
                kept += whole
    return " ".join(_blocks(kept))


def _climbed(best: Node, value: dict[Node, float]) -> Node:
    """The child, on the way up from the best container, of the highest ancestor of which another child scores as well."""
    top, node = best, best
    while node.parent is not None:
        if any(isinstance(c, Node) and c is not node and value.get(c, 0.0) >= BESIDE for c in node.parent.children):
            top = node
        node = node.parent
    return top


def extract(pages: DataFrame, html_column: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The kept columns, `text` and `n_chars`, one row per page."""
    columns = pages.select(*keep, html_column)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns.schema.fields[:-1])

    def run(batches):
        for batch in batches:
            texts = [main_text(p) for p in batch.column(len(keep)).to_pylist()]
            arrays = [batch.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays(
                [*arrays, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[*keep, "text", "n_chars"])

    return columns.mapInArrow(run, f"{fields}, text string, n_chars long")
