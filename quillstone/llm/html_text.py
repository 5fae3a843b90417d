"""HTML extraction by composite text density.

A tolerant scanner, which looks at each character once, builds a small tree. Every node gets a density:
its characters per tag, lowered where much of its text is links. The lowest density on the path from the
densest node up to the body is the threshold; among the nodes at or above it, the one whose children's
densities sum to most is chosen. What is boilerplate by tag, role or name goes then: from inside the
choice, and if there was some, densities choose again in what is left of it; if the choice lies in
boilerplate itself, in what is left of the page. The result is widened to the article it is in. Of two articles beside each
other, the one of the larger density sum is the main text.

Names only advise. A name that says boilerplate by one of several parts must say so as its noun (post-comments, ad-box), not as what
qualifies another (has-sidebar, comment-article); it takes away no more than half of the page's text that isn't links. A heading is never dropped for its
name, other small elements only for names of adverts and notices, or if they are mostly links. If nothing would be left, names are not heard.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.llm.common import ship, text_or_empty

# Element names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split())
IN_HEAD = frozenset("base head link meta noscript script style template title".split())
CLOSES_P = BLOCK - frozenset("body caption dd dt html li tbody td tfoot th thead tr".split())
#: Elements whose end tag may be left out, and the open elements that their start ends.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"thead", "tbody", "tr", "td", "th"}}
SCOPE = frozenset("table ul ol dl select html body article section div td th".split())
#: Never main text; a header is, in an article or main element.
DROPPED = frozenset("head nav footer aside form script style noscript template iframe object embed svg canvas button select option textarea title menu dialog audio video map noembed noframes xmp input".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
#: Class names and ids that name boilerplate; those among them that name adverts and notices.
NAMES = frozenset(
    "ad ads adv advert advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright disqus footer form gdpr header login masthead menu modal nav navbar navigation newsletter notice pagination pager paywall popup promo related replies respond share sharing sidebar signup social sponsor sponsored subscribe subscription toolbar widget widgets".split()
)
ADVERTS = frozenset("ad ads adv advert advertisement advertising banner consent cookie cookies copyright gdpr newsletter notice paywall popup promo sponsor sponsored subscribe".split())
PARTS = NAMES - frozenset("form header notice related share sharing social login".split())
#: What stands behind a name in a compound without changing what it names, and what before it takes it back.
LAYOUT = frozenset("area bar block body bottom box button buttons column container content icons inner item items left links list outer panel right section slot top unit wrap wrapper zone".split())
NEGATING = frozenset("has have hide hidden is layout no non not without with".split())
CONTAINERS = frozenset("div section ul ol dl table center details figure".split())
#: What bears a name out: that the element has no more than half of the page's text that isn't links, or that it is mostly links.
FEW, LINKS = 1, 2
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_TURN = re.compile(r"=\s*+[\"']|>")
_NAME = re.compile(r"[a-zA-Z][^\s/>]*+")
_ATTR = re.compile(r"([^\s=\"'/>]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"?|'([^']*+)'?|([^\s\"']*+)))?")
_HIDDEN = re.compile(r"display\s*+:\s*+none|visibility\s*+:\s*+hidden", re.I)
_PART = re.compile(r"[a-z0-9]++")
_HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])")


class Node:
    __slots__ = ("advice", "boilerplate", "chars", "children", "density", "dropped", "link_chars", "link_tags", "parent", "sum", "tag", "tags")

    def __init__(self, tag: str, parent: Node | None = None, boilerplate: bool = False, advice: int = 0):
        self.tag, self.parent, self.boilerplate, self.advice = tag, parent, boilerplate, advice
        self.dropped = False
        self.children: list[Node | str] = []


def _advice(name: str) -> int:
    """What a compound name's noun, words of layout aside, says: FEW if it names boilerplate, LINKS if it also names other things, else 0."""
    parts = _PART.findall(_HUMP.sub(" ", name).lower())
    while len(parts) > 1 and (parts[-1] in LAYOUT or parts[-1].isdigit()):
        parts.pop()
    if not parts or parts[-1] not in NAMES or not NEGATING.isdisjoint(parts[:-1]):
        return 0
    return FEW if parts[-1] in PARTS else LINKS


def _judged(tag: str, attributes: str, in_article: bool, names: bool = True) -> tuple[bool, int]:
    """Whether an element is boilerplate; and, if its names only advise so, what must bear them out."""
    if tag in DROPPED or (tag == "header" and not in_article):
        return True, 0
    if not attributes or tag in ("html", "body", "article", "main"):
        return False, 0
    found: dict[str, str] = {}
    for m in _ATTR.finditer(attributes):
        found.setdefault(m[1].lower(), unescape(m[2] or m[3] or m[4] or ""))
    if "hidden" in found or found.get("role", "").lower() in ROLES or found.get("aria-hidden") == "true" or _HIDDEN.search(found.get("style", "")):
        return True, 0
    advice = 0
    if names and tag not in HEADINGS:
        for name in f"{found.get('class', '')} {found.get('id', '')}".split():
            if name.lower() in (NAMES if tag in CONTAINERS else ADVERTS):
                return True, 0
            advice = advice or (_advice(name) if tag in CONTAINERS else LINKS if name.lower() in NAMES else 0)
    return False, advice


def _tag_end(html: str, at: int, last: dict[str, int]) -> int:
    """The place of the > that ends a tag, -1 if none does. A quote that is never closed is a character like any other."""
    while (m := _TURN.search(html, at)) is not None:
        if m[0] == ">":
            return m.start()
        quote, at = m[0][-1], m.end()
        if at <= last[quote]:
            at = html.index(quote, at) + 1
    return -1


def parse(html: str, names: bool = True) -> Node:
    """The body as a tree, of which only tags, roles and hidden parts are judged if not ``names``. Misnested and unclosed tags are closed where the next block or end tag requires it.

    A < that begins no tag is text, and so is all from a tag that is never ended. Every character is looked at a bounded
    number of times: the open elements are a stack, with the places of each name in it.
    """
    root = Node("body")
    stack, places = [root], {}
    last = {q: html.rfind(q) for q in "\"'"}

    def close(tag: str, stops: frozenset[str] = frozenset()) -> None:
        """Close the nearest open tag and what is open inside it, unless a stop comes first."""
        if not places.get(tag):
            return
        at = places[tag][-1]
        if any(places[s][-1] > at for s in stops if s != tag and places.get(s)):
            return
        while len(stack) > at:
            places[stack.pop().tag].pop()

    def add(text: str) -> None:
        if text:
            stack[-1].children.append(unescape(text))

    at, end, text_from = 0, len(html), 0
    while (lt := html.find("<", at)) >= 0:
        after = html[lt + 1 : lt + 2]
        if after in ("!", "?"):
            add(html[text_from:lt])
            over = html.find("-->", lt + 4) if html.startswith("<!--", lt) else html.find(">", lt)
            at = text_from = end if over < 0 else over + (3 if html.startswith("<!--", lt) else 1)
            continue
        ending = after == "/"
        m = _NAME.match(html, lt + 1 + ending)
        if m is None:
            at = lt + 1
            continue
        gt = _tag_end(html, m.end(), last)
        if gt < 0:
            break
        add(html[text_from:lt])
        tag, attributes = m[0].lower(), html[m.end() : gt]
        at = text_from = gt + 1
        if not ending and tag not in IN_HEAD:
            close("head")
        if tag in ("html", "body"):
            continue
        if tag in ("br", "wbr"):
            stack[-1].children.append(" " if tag == "br" else "")
            continue
        if ending:
            close(tag)
            continue
        if tag in RAW:
            over = re.compile(rf"</{tag}[\s/>]", re.I).search(html, at)
            at = text_from = over.start() if over else end
            continue
        if tag in CLOSES_P:
            close("p", frozenset(("table", "td", "th", "button", "object")))
        for other in ENDS.get(tag, ()):
            close(other, SCOPE - {other, "div"} if tag in ("li", "dt", "dd", "option") else frozenset(("table",)))
        node = Node(tag, stack[-1], *_judged(tag, attributes, bool(places.get("article") or places.get("main")), names))
        stack[-1].children.append(node)
        if tag not in VOID and not (attributes.endswith("/") and tag in ("svg", "path")):
            places.setdefault(tag, []).append(len(stack))
            stack.append(node)
    add(html[text_from:])
    return root


def _walk(root: Node) -> list[Node]:
    """Nodes that aren't dropped, parents first, without recursion: pages can nest deeply."""
    out, left = [], [root]
    while left:
        node = left.pop()
        out.append(node)
        left.extend(c for c in reversed(node.children) if isinstance(c, Node) and not c.dropped)
    return out


def _measure(nodes: list[Node]) -> None:
    """Density and sum of every node; the first is the whole."""
    for n in reversed(nodes):
        n.chars = n.tags = n.link_chars = n.link_tags = 0
        n.density = 0.0
        for c in n.children:
            if isinstance(c, str):
                n.chars += len("".join(c.split()))
            elif not c.dropped:
                n.chars += c.chars
                n.tags += c.tags + 1
                n.link_chars += c.link_chars
                n.link_tags += c.link_tags
        if n.tag == "a":
            n.link_chars, n.link_tags = n.chars, n.tags + 1
    whole = nodes[0]
    for n in nodes:
        if n.chars:
            tags, links, free = max(n.tags, 1), max(n.link_chars, 1), max(n.chars - n.link_chars, 1)
            base = math.log(n.chars / free * n.link_chars + whole.link_chars / max(whole.chars, 1) * n.chars + math.e)
            n.density = n.chars / tags * max(math.log(n.chars / links * tags / max(n.link_tags, 1)) / math.log(base) if base > 1.0001 else math.log(n.chars * tags + math.e), 0.0)
    for n in nodes:
        n.sum = sum(c.density for c in n.children if isinstance(c, Node) and not c.dropped)


def densest_subtree(root: Node) -> Node | None:
    """The subtree of the largest density sum at or above the threshold; None if there is no text."""
    nodes = _walk(root)
    _measure(nodes)
    if not root.chars:
        return None
    densest = max(nodes, key=lambda n: n.density)
    threshold, at = densest.density, densest
    while at is not root:
        at = at.parent
        threshold = min(threshold, at.density)
    return max((n for n in nodes if n.density >= threshold), key=lambda n: (n.sum, n.chars))


def _weigh_advice(root: Node) -> None:
    """Hear the advice of names where densities bear it out; what remains boilerplate is so by now."""
    nodes = _walk(root)
    advised = [n for n in nodes if n.advice]
    if not advised:
        return
    for n in nodes:
        n.dropped = n.boilerplate
    left = _walk(root)
    _measure(left)
    page = root.chars - root.link_chars
    reached = set(map(id, left))
    for n in advised:
        if id(n) in reached:
            own = n.chars - n.link_chars
            n.boilerplate = 2 * own <= page if n.advice == FEW else 2 * n.link_chars >= n.chars
    for n in nodes:
        n.dropped = False


def _chosen(root: Node) -> Node | None:
    """The subtree that densities choose once boilerplate is gone, widened to its article; None if nothing is left."""
    best = densest_subtree(root)
    if best is None:
        return None
    at, inside = best, False
    while at is not None:
        inside, at = inside or at.boilerplate, at.parent
    top = root if inside else best
    found = [n for n in _walk(top) if n.boilerplate]
    for n in found:
        n.dropped = True
    if found:
        best = densest_subtree(top)
    if best is None and top is not root:  # nothing but boilerplate
        for n in _walk(root):
            n.dropped = n.boilerplate
        best = densest_subtree(root)
    widest = at = best
    while at is not None:
        if at.tag in ("article", "main"):
            widest = at
        at = at.parent
    if widest is not best:
        for n in _walk(widest):
            n.dropped = n.boilerplate
    return widest


def main_node(html: str) -> Node | None:
    """The subtree that holds the main text, with what is boilerplate in it dropped; None if the page has none."""
    root = parse(html)
    _weigh_advice(root)
    best = _chosen(root)
    if best is None:
        best = _chosen(parse(html, names=False))  # names may be why nothing is left
    return best


def blocks(node: Node) -> list[str]:
    """Texts of the blocks of a subtree in page order, white space made single, empty ones left out."""
    out: list[str] = []
    run: list[str] = []

    def flush() -> None:
        if text := " ".join("".join(run).split()):
            out.append(text)
        run.clear()

    left: list[Node | str | None] = [node]
    while left:
        x = left.pop()
        if x is None:
            flush()
        elif isinstance(x, str):
            run.append(x)
        elif not x.dropped:
            if x.tag in BLOCK:
                flush()
                left.append(None)
            left.extend(reversed(x.children))
    flush()
    return out


def main_text(html: str) -> str:
    node = main_node(html)
    return "" if node is None else "\n\n".join(blocks(node))


def extract_text(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """All columns of pages but html_col, plus text and n_chars (its code points).

    A null html counts as empty; text is empty if a page has none. Repeated rows give repeated rows.
    Columns named text or n_chars are replaced.
    """
    ship(pages.sparkSession)

    @F.pandas_udf("string")
    def text_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            yield pd.Series([main_text(x) for x in b], dtype="object")

    own = [c for c in pages.columns if c not in (html_col, "text", "n_chars")]
    return pages.select(*own, text_of(text_or_empty(html_col)).alias("text")).withColumn("n_chars", F.length("text").cast("long"))
