"""Main text of web pages by composite text density.

A forgiving reader builds the element tree. Elements whose tag or class says nothing but menu,
header, footer, sidebar, notice, advert, form, script or comments go. For every node left
the density is its characters per tag, weighed down by the share of its text and tags that
are links; a node's density sum adds up its children's. The subtree with the largest sum is
the core of the text. The lowest density on the path from it up to the body is the threshold that
other parts beside the path need in order to belong to it; lists of links go from what was chosen.

An article or main element is a hint, no more: the core grows to the article that it lies in, and
other articles and the parts of a main element stay unless they are mostly links. A heading
stays if something after it does. An id is a hint beside the path only.
"""

from __future__ import annotations

import html
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimtide.llm.common import chosen, per_batch

# Fixed values of HTML: how elements nest and what they are.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template svg".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section "
    "summary table tbody td tfoot th thead tr ul".split()
)
ENDS_PARAGRAPH = BLOCKS - frozenset("body html td th tr tbody thead tfoot caption option optgroup legend".split())
SIBLINGS = {  # a start tag ends an open element of these, up to the container
    "li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
    "tbody": (("tbody", "thead", "tfoot", "tr", "td", "th"), ("table",)), "option": (("option",), ("select",)),
    "p": (("p",), ("td", "th", "table", "button", "object", "caption")),
}

# What an article is not, by tag and by the words of class, id and role.
DROPPED_TAGS = frozenset("nav footer aside form button select menu dialog head object canvas".split()) | RAW
DROPPED_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation "
    "menu breadcrumb breadcrumbs sidebar aside complementary footer contentinfo masthead comment comments respond reply "
    "replies discussion disqus cookie cookies consent gdpr notice notices alert popup modal newsletter subscribe signup "
    "login share sharing social related recommended recommendations pagination pager toolbar search form".split()
)
HEADERS = frozenset(("header", "topbar"))
# What a label may also say without saying what an element holds.
NEUTRAL_WORDS = frozenset(
    "box bar block area section container wrapper wrap inner outer widget unit slot panel row col item items list links link "
    "main site page top bottom left right primary secondary global the js".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
LINK_LIST = 3  # links from which on a part that is mostly links is a list of them
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
_LABEL = re.compile(r"""(?i)(?<![\w-])(class|id|role|aria-hidden|style|hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)|(?=[\s/]|$))""")
_NAME = re.compile(r"/?[A-Za-z][^\s/>]*")


class Node:
    __slots__ = ("tag", "parent", "parts", "hint", "aside", "chars", "tags", "link_chars", "link_tags", "density", "total", "inside")

    def __init__(self, tag: str, parent: Node | None, attributes: str = "") -> None:
        self.tag, self.parent, self.parts = tag, parent, []
        self.hint, self.aside = _hints(tag, attributes)
        self.inside = parent is not None and (parent.inside or parent.tag in ("article", "main") and not parent.hint)
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0
        if parent is not None:
            parent.parts.append(self)


def _says(value: str) -> str:
    """What labels say an element is, if one of them says nothing else: "label", "header" or nothing."""
    for label in value.split():
        words = {w.lower() for w in _WORD.findall(label)} - NEUTRAL_WORDS
        joined = re.sub(r"[^a-z0-9]+", "", label.lower())
        if joined in DROPPED_WORDS or words and words <= DROPPED_WORDS:
            return "label"
        if joined in HEADERS or words and words <= HEADERS:
            return "header"
    return ""


def _hints(tag: str, attributes: str) -> tuple[str, bool]:
    """Why an element may not belong to the article ("tag", "label", "header" or nothing), and
    whether its id speaks against it."""
    if tag in DROPPED_TAGS:
        return "tag", True
    aside, hint = False, "header" if tag == "header" else ""
    if attributes and tag not in ("html", "body", "main") and tag not in HEADINGS:
        for name, value in _LABEL.findall(attributes):
            name, value = name.lower(), value.strip("\"'")
            if name == "hidden" or name == "aria-hidden" and value == "true":
                return "tag", True
            if name == "style":
                if re.search(r"display\s*:\s*none", value):
                    return "tag", True
            elif name == "id":
                aside = aside or bool(_says(value))
            else:
                hint = hint or _says(value)
    return hint, aside


def tree(page: str) -> list[Node]:
    """All nodes in page order, the root first; time is linear in the page."""
    root = Node("#root", None)
    nodes, open_, at, quotes = [root], [root], 0, {'"': True, "'": True}

    def close(upto: int) -> None:
        del open_[upto:]

    while at < len(page):
        begin = page.find("<", at)
        if begin < 0:
            begin = len(page)
        if begin > at:
            open_[-1].parts.append(page[at:begin])
        if begin == len(page):
            break
        if page.startswith("<!--", begin):
            end = page.find("-->", begin + 4)
            at = len(page) if end < 0 else end + 3
            continue
        name = _NAME.match(page, begin + 1)
        end = page.find(">", begin + 1)
        if not name:
            if page[begin + 1:begin + 2] in ("!", "?", "/"):
                at = len(page) if end < 0 else end + 1
            else:  # a lone "<" is text
                open_[-1].parts.append("<")
                at = begin + 1
            continue
        if end < 0:
            break  # an unfinished tag at the end
        scan = name.end()
        while True:  # a ">" in a quoted value doesn't end the tag
            opened = min((k for q in quotes if quotes[q] and 0 <= (k := page.find(q, scan, end))), default=-1)
            if opened < 0:
                break
            closed = page.find(page[opened], opened + 1)
            if closed < 0:
                quotes[page[opened]] = False  # never closed from here on
                break
            scan = closed + 1
            if scan > end:
                end = page.find(">", scan)
                if end < 0:
                    end = len(page) - 1
                    break
        tag, attributes, at = name[0].lower(), page[name.end():end], end + 1
        if tag[0] == "/":
            tag = tag[1:]
            for k in range(len(open_) - 1, 0, -1):
                if open_[k].tag == tag:
                    close(k)
                    break
                if tag not in BLOCKS and open_[k].tag in BLOCKS:
                    break  # an inline end tag doesn't end a block
            continue
        if tag in RAW:
            stop = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.IGNORECASE).search(page, at)
            at = len(page) if stop is None else stop.start()
        for rule in (("p",) if tag in ENDS_PARAGRAPH else ()) + ((tag,) if tag in SIBLINGS and tag != "p" else ()):
            ended, limits = SIBLINGS[rule]
            low = len(open_)
            for k in range(len(open_) - 1, 0, -1):
                if open_[k].tag in limits:
                    break
                if open_[k].tag in ended:
                    low = k
                    if rule == "p":
                        break
            close(low)
        node = Node(tag, open_[-1], attributes)
        nodes.append(node)
        if tag not in VOID and not attributes.endswith("/") or tag in BLOCKS and tag not in VOID:
            open_.append(node)
    return nodes


def _kept(nodes: list[Node]) -> list[Node]:
    """The nodes without those that their hints drop, and all below them."""
    holds = set()  # elements with an article or a main of their own inside are no mere label
    for node in reversed(nodes):
        if node.parent is not None and (id(node) in holds or node.tag in ("article", "main") and not node.hint):
            holds.add(id(node.parent))
    gone, kept = set(), []
    for node in nodes:
        up = node.parent
        drop = up is not None and id(up) in gone
        drop = drop or node.hint == "tag" and id(node) not in holds
        drop = drop or node.hint == "label" and id(node) not in holds
        drop = drop or node.hint == "header" and not node.inside and id(node) not in holds
        if drop:
            gone.add(id(node))
            if up is not None and id(up) not in gone:
                up.parts = ["\n" if p is node and node.tag in BLOCKS else p for p in up.parts if p is not node or node.tag in BLOCKS]
        else:
            kept.append(node)
    return kept


def densities(nodes: list[Node]) -> None:
    """Fills in counts, composite densities and density sums, from the leaves up."""
    for node in nodes:
        node.chars = node.tags = node.link_chars = node.link_tags = 0
        node.density = node.total = 0.0
    for node in reversed(nodes):
        node.chars += sum(len(" ".join(p.split())) for p in node.parts if isinstance(p, str))
        if node.tag == "a":
            node.link_chars, node.link_tags = node.chars, node.link_tags + 1
        up = node.parent
        if up is not None:
            up.chars += node.chars
            up.tags += node.tags + 1
            up.link_chars += node.link_chars
            up.link_tags += node.link_tags
    body = next((n for n in nodes if n.tag == "body"), nodes[0])
    links = body.link_chars / max(1, body.chars)
    for node in reversed(nodes):
        if node.chars:
            plain = max(1, node.chars - node.link_chars)
            base = math.log(node.chars / plain * node.link_chars + links * node.chars + math.e)
            ratio = node.chars / max(1, node.link_chars) * max(1, node.tags) / max(1, node.link_tags)
            node.density = node.chars / max(1, node.tags) * max(0.0, math.log(ratio)) / math.log(max(base, 1.1))
        if node.parent is not None:
            node.parent.total += node.density


def _core(nodes: list[Node]) -> tuple[list[Node], Node]:
    """The path from the subtree with the largest density sum up to the body, and the body."""
    densities(nodes)
    body = next((n for n in nodes if n.tag == "body"), nodes[0])
    best_below: dict[int, Node] = {}
    for node in reversed(nodes):  # children come after their parents
        best = max((best_below.get(id(node), node), node), key=lambda n: n.total)
        best_below[id(node)] = best
        if node.parent is not None:
            other = best_below.get(id(node.parent))
            if other is None or best.total >= other.total:
                best_below[id(node.parent)] = best
    path = [best_below[id(body)]]
    while path[-1] is not body:
        path.append(path[-1].parent)
    return path, body


def article(nodes: list[Node]) -> list[Node]:
    """The nodes whose whole subtrees make up the main text, in page order."""
    kept = _kept(nodes)
    path, _ = _core(kept)
    # Lists of links beside the path would lower the densities on it.
    path, body = _core(_without_link_lists(kept, {id(n) for n in path}))
    if path[0].total <= 0:
        return [body]
    threshold = min(n.density for n in path)
    core = next((n for n in reversed(path) if n.tag == "article"), path[0])
    return _beside(path[path.index(core):], threshold)


def _is_links(node: Node) -> bool:
    return 2 * node.link_chars > node.chars


def _beside(path: list[Node], threshold: float) -> list[Node]:
    """The core, the first of the path, and what belongs to it beside the path up to the body."""
    chosen_: list[Node] = [path[0]]
    for below, node in zip(path, path[1:]):
        after, before, seen = [], [], False
        for part in node.parts:
            if part is below:
                seen = True
            elif isinstance(part, Node):
                (after if seen else before).append(part)
            elif len(" ".join(part.split())) >= max(threshold, 1):  # loose text counts like a part of its own
                (after if seen else before).append(_loose(part))

        def belongs(part: Node, later: bool) -> bool:
            if part.tag in HEADINGS:
                return later and not _is_links(part)
            if part.aside or not part.chars:
                return False
            if "main" in (node.tag, part.tag) or part.tag == "article":
                return not _is_links(part)
            return part.density >= threshold

        first: list[Node] = []
        for part in reversed(before):
            if belongs(part, True):
                first.append(part)
        last: list[Node] = []
        for part in reversed(after):
            if belongs(part, bool(last)):
                last.append(part)
        chosen_ = first[::-1] + chosen_ + last[::-1]
    return chosen_


def _loose(text: str) -> Node:
    node = Node("#text", None)
    node.parts.append(text)
    node.chars = len(" ".join(text.split()))
    node.density = float(node.chars)
    return node


def _without_link_lists(nodes: list[Node], path: set[int]) -> list[Node]:
    """The nodes without blocks beside the path that are lists of links, and all below them."""
    gone, kept = set(), []
    for node in nodes:
        up = node.parent
        if up is not None and id(up) in gone:
            gone.add(id(node))
        elif (up is not None and node.link_tags >= LINK_LIST and 10 * node.link_chars > 7 * node.chars
                and node.tag in BLOCKS and id(node) not in path):
            gone.add(id(node))
            up.parts = ["\n" if p is node else p for p in up.parts]
        else:
            kept.append(node)
    return kept


def blocks(node: Node) -> list[str]:
    """The text blocks of a subtree: references decoded, white space turned into one space."""
    found, held = [], []
    work: list[Node | str | None] = [node]

    def end_block() -> None:
        text = " ".join("".join(held).split())
        held.clear()
        if text:
            found.append(text)

    while work:
        part = work.pop()
        if part is None:
            end_block()
        elif isinstance(part, str):
            held.append(html.unescape(part))
        else:
            if part.tag == "br":
                held.append(" ")
            if part.tag in BLOCKS:
                end_block()
                work.append(None)
            work += reversed(part.parts)
    end_block()
    return found


def main_text(page: str) -> str:
    return "\n\n".join(block for node in article(tree(page)) for block in blocks(node))


def _extracted(batch: pa.RecordBatch) -> pa.RecordBatch:
    texts = [main_text(page) for page in batch.column("html").to_pylist()]
    return pa.RecordBatch.from_arrays(
        [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])


def extract_text(frame: DataFrame) -> DataFrame:
    """Per page (page_id, url, html): page_id, url, text, n_chars (code points).

    Blocks are joined by an empty line. A null or empty page, or one without text, has an
    empty text; null ids and urls stay null; repeated rows give a row each; other columns
    are ignored.
    """
    pages = chosen(frame, page_id="long", url="string", html="string").withColumn(
        "html", F.coalesce(F.col("html"), F.lit("")))
    texts = pages.mapInArrow(per_batch(_extracted, "html"), "page_id long, url string, text string")
    return texts.withColumn("n_chars", F.length("text").cast("long"))
