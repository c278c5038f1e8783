"""Main text of web pages by composite text density."""

from __future__ import annotations

import math
import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructField

from tidemark.llm.rows import map_rows, texts_of

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary "
    "table tbody td tfoot th thead tr ul".split())
# a start tag of the left kind ends an open element of the right kinds, up to the nearest of SCOPES
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"},
    "tfoot": {"thead", "tbody", "tr", "td", "th"}, "body": {"head"},
}
ENDS_PARAGRAPH = BLOCKS - {"html", "body", "option", "caption", "legend", "td", "th", "tr", "tbody", "thead", "tfoot"}
SCOPES = {"li": {"ul", "ol", "menu", "dir"}, "dt": {"dl"}, "dd": {"dl"}}
TABLE_SCOPE = {"table"}
# elements that never hold main text
DROPPED = frozenset(
    "script style noscript template nav footer aside button select textarea iframe object svg canvas menu dialog "
    "audio video map head title input label fieldset noembed noframes".split())
# words of a class, id or role that name what stands beside the article
BESIDE = frozenset(
    "ad ads advert adverts advertisement advertising adbox adslot sponsor sponsored promo promotion banner sidebar "
    "sidenav comment comments disqus respond cookie cookies consent gdpr notice notices alert popup modal overlay "
    "nav navbar navigation navigator menu breadcrumb breadcrumbs pagination pager footer masthead topbar toolbar share "
    "sharing social subscribe subscription newsletter signup login related recommended recirculation complementary "
    "contentinfo search form widget skip disclaimer reply replies commentlist".split())
# elements of running text, whose names within an article say how they look
TEXTUAL = frozenset("p blockquote pre h1 h2 h3 h4 h5 h6 span b i em strong a li td th q cite code".split())
RIGHTS = re.compile(r"\s*(?:©|\(c\)|copyright\b)[^.]*\b\d{4}\b", re.IGNORECASE)
# words behind such a name that only say what kind of box it is
BOX = frozenset("container wrapper wrap area box inner outer left right top bottom section block".split())
# words that say what an element has, not what it is
HAS = frozenset("has have with without no".split())
ARTICLE = frozenset(("article", "main"))

TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^'\">]|\"[^\"]*\"|'[^']*')*)>")
BROKEN_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
NAMED = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
WORD = re.compile(r"[a-z]+|[A-Z][a-z]*")
HIDDEN = re.compile(r"(?:^|\s)hidden(?:$|[\s=])|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.IGNORECASE)


class Node:
    __slots__ = ("tag", "parent", "parts", "beside", "named", "chars", "tags", "link_chars", "link_tags", "density", "plain",
                 "sums", "blocky", "titled")

    def __init__(self, tag: str, parent: Node | None, beside: bool, named: bool) -> None:
        self.tag, self.parent, self.beside, self.named = tag, parent, beside or named, named and not beside
        self.parts: list[Node | str] = []


def _is_beside(tag: str, attributes: str, parent: Node) -> bool:
    if tag in DROPPED:
        return True
    if tag == "header":
        # the head of an article belongs to it, that of a page does not
        node: Node | None = parent
        while node is not None and node.tag not in ARTICLE:
            node = node.parent
        return node is None
    return tag not in ("html", "body") and tag not in ARTICLE and HIDDEN.search(attributes) is not None


def _is_named_beside(tag: str, attributes: str, parent: Node) -> bool:
    """Whether a class, id or role, as a whole or by its last word, names what stands beside the article. A form is
    named so by its tag."""
    if tag == "form":
        return True
    if not attributes or tag in ("html", "body") or tag in ARTICLE:
        return False
    if tag in TEXTUAL:
        node: Node | None = parent
        while node is not None and node.tag not in ARTICLE:
            node = node.parent
        if node is not None:
            return False
    for _, a, b, c in NAMED.findall(attributes):
        for value in (a or b or c).split():
            words = [w.lower() for w in WORD.findall(value)]
            if "".join(words) in BESIDE or words in (["header"], ["site", "header"], ["page", "header"]):
                return True
            while len(words) > 1 and words[-1] in BOX:
                words.pop()
            if words and words[-1] in BESIDE and words[0] not in HAS:
                return True
    return False


def _clear(root: Node) -> None:
    """A box that holds most of the page's text is the page, whatever its name says; but not where an article
    stands outside of named boxes, unless the box has the page's title or main element."""
    order, stack = [], [(root, False)]
    article = False
    while stack:
        node, within = stack.pop()
        within = within or node.named
        article = article or not within and node.tag in ARTICLE
        order.append(node)
        stack.extend((p, within) for p in node.parts if not isinstance(p, str) and (p.named or not p.beside))
    if not any(node.named for node in order):
        return
    for node in reversed(order):
        inner = [p for p in node.parts if not isinstance(p, str) and (p.named or not p.beside)]
        node.chars = sum(len(" ".join(p.split())) for p in node.parts if isinstance(p, str)) + sum(c.chars for c in inner)
        node.blocky = any(c.tag in BLOCKS or c.blocky for c in inner)
        node.titled = node.tag in ("h1", "main") or any(c.titled for c in inner)
    for node in order:
        if node.named and node.blocky and 2 * node.chars > root.chars and (node.titled or not article):
            node.beside = node.named = False


def parse(html: str) -> Node:
    """A tree of the page; missing end tags are put where a following tag asks for them."""
    root = open_ = Node("#root", None, False, False)
    at, size = 0, len(html)
    while at < size:
        less = html.find("<", at)
        if less < 0:
            open_.parts.append(html[at:])
            break
        if less > at:
            open_.parts.append(html[at:less])
        at = less
        following = html[at + 1:at + 2]
        if following == "!" or following == "?":
            if html.startswith("<!--", at):
                end = html.find("-->", at + 4)
                at = size if end < 0 else end + 3
            elif html.startswith("<![CDATA[", at):
                end = html.find("]]>", at)
                at = size if end < 0 else end + 3
            else:
                end = html.find(">", at)
                at = size if end < 0 else end + 1
            continue
        match = TAG.match(html, at) or BROKEN_TAG.match(html, at)
        if match is None:
            if following != "/" and not (following.isascii() and following.isalpha()):
                open_.parts.append("<")
                at += 1
                continue
            end = html.find(">", at)
            if end < 0:
                break  # the page ends within a tag
            at = end + 1  # an end tag without a name is a comment
            continue
        at = match.end()
        closing, tag, attributes = match.group(1), match.group(2).lower(), match.group(3)
        if closing:
            node = open_
            while node is not root and node.tag != tag:
                node = node.parent
            if node is not root:
                open_ = node.parent
            continue
        ends = {"p"} if tag in ENDS_PARAGRAPH else ENDS.get(tag)
        if ends:
            scope = SCOPES.get(tag, TABLE_SCOPE)
            for kinds in (ends, ENDS.get(tag)) if tag in ("li", "dt", "dd") else (ends,):
                node = open_
                while node is not root and node.tag not in kinds and node.tag not in scope and (
                        kinds is not ends or "p" not in ends or node.tag not in BLOCKS):
                    node = node.parent
                if node is not root and node.tag in kinds:
                    open_ = node.parent
        node = Node(tag, open_, _is_beside(tag, attributes, open_), _is_named_beside(tag, attributes, open_))
        open_.parts.append(node)
        if tag in RAW:
            end = re.compile(f"</{tag}[^>]*>", re.IGNORECASE).search(html, at)
            if end is None:
                node.parts.append(html[at:])
                break
            node.parts.append(html[at:end.start()])
            at = end.end()
        elif tag not in VOID and not attributes.endswith("/"):
            open_ = node
    return root


def _measure(root: Node) -> list[Node]:
    """Characters and tags, those of links apart, of each node that may hold main text; deepest last."""
    order, stack = [], [(root, False)]
    linked = {}
    while stack:
        node, in_link = stack.pop()
        in_link = in_link or node.tag == "a"
        linked[id(node)] = in_link
        order.append(node)
        stack.extend((part, in_link) for part in node.parts if not isinstance(part, str) and not part.beside)
    for node in reversed(order):
        text = sum(len(" ".join(part.split())) for part in node.parts if isinstance(part, str))
        inner = [part for part in node.parts if not isinstance(part, str) and not part.beside]
        node.chars = text + sum(c.chars for c in inner)
        node.blocky = node.tag in BLOCKS or any(c.blocky for c in inner)
        node.tags = len(inner) + sum(c.tags for c in inner)
        if linked[id(node)]:
            node.link_chars, node.link_tags = node.chars, node.tags
        else:
            node.link_chars = sum(c.link_chars for c in inner)
            node.link_tags = sum(c.link_tags + (c.tag == "a") for c in inner)
    return order


def density(chars: int, tags: int, link_chars: int, link_tags: int, ratio: float) -> float:
    """Characters per tag, scaled down where links hold much of the text; ``ratio`` is the page's share of links."""
    tags = max(tags, 1)
    plain = max(chars - link_chars, 1)
    base = math.log(chars / plain * link_chars + ratio * chars + math.e)
    scale = math.log(max(chars / max(link_chars, 1) * tags / max(link_tags, 1), 1.0))
    return chars / tags * scale / math.log(max(base, 1.0 + 1e-9)) if base > math.e else chars / tags * scale


def _densities(order: list[Node], body: Node) -> float:
    """The density of each node, what it would be without links, and the sum of its children's; gives the page's
    share of links."""
    ratio = body.link_chars / max(body.chars, 1)
    for node in reversed(order):
        node.density = density(node.chars, node.tags, node.link_chars, node.link_tags, ratio)
        node.plain = density(node.chars, node.tags, 0, 0, 0.0)
        node.sums = sum(c.density for c in node.parts if not isinstance(c, str) and not c.beside)
    return ratio


def _blocks(node: Node, out: list[list[str]]) -> None:
    """Text of the node, a list of strings for each block, in page order."""
    stack: list[tuple[Node, int]] = [(node, 0)]
    while stack:
        node, k = stack.pop()
        if k == 0 and node.tag in BLOCKS:
            out.append([])
        while k < len(node.parts):
            part = node.parts[k]
            k += 1
            if isinstance(part, str):
                out[-1].append(part)
            elif part.tag in VOID:
                out[-1].append(" ") if part.tag in ("br", "wbr") else out.append([]) if part.tag == "hr" else None
            elif not part.beside:
                stack.append((node, k))
                stack.append((part, 0))
                break
        else:
            if node.tag in BLOCKS:
                out.append([])


def main_text(html: str) -> str:
    """The page's main text, a line for each block; empty if there is none.

    The subtree with the largest sum of its children's densities is the core and stays whole. On the path from it to the
    body the least density is taken. What stands beside the path stays if its density reaches that, or, as short paragraphs
    are never dense, the share ``LINKED`` of what it would be without links; of what does not, the parts are looked
    at alike. What is named as standing beside the article is never counted, unless it holds most of the page's text.
    """
    root = parse(html)
    _clear(root)
    order = _measure(root)
    body = next((n for n in order if n.tag == "body"), root)
    if not body.chars:
        body = root
    if not body.chars:
        return ""
    ratio = _densities(order, body)

    core, stack = body, [body]
    while stack:
        node = stack.pop()
        if node.sums > core.sums:
            core = node
        stack.extend(p for p in reversed(node.parts) if not isinstance(p, str) and not p.beside)
    path, node, border = set(), core.parent, [core]
    while node is not None:
        path.add(id(node))
        if node is body or node.parent is not None and id(body) not in path:
            border.append(node)
        node = node.parent
    _prune(root, core, path, min(n.density for n in border), ratio)
    out: list[list[str]] = [[]]
    _blocks(root, out)
    lines = (" ".join(unescape("".join(block)).split()) for block in out)
    return "\n".join(line for line in lines if line)


LINKED = 0.12  # share of a density that links leave where they are about a third of a longer text
HEADINGS = frozenset("h2 h3 h4 h5 h6".split())


def passes(own: float, plain: float, least: float) -> bool:
    """Whether a density reaches the body path's threshold, or enough of what it would be without links."""
    return own > 0 and (own >= least or own >= LINKED * plain)


def _prune(root: Node, core: Node, path: set[int], least: float, ratio: float) -> None:
    """Take out what stands beside the core and does not pass the thresholds: branches, and runs of text between them.
    Of such a branch, parts that pass stay, but not headings alone. Every other branch stays whole."""
    stack = [root] if id(root) in path else []
    opened = []
    while stack:
        node = stack.pop()
        opened.append(node)
        kept: list[Node | str] = []
        run: list[Node | str] = []
        for part in [*node.parts, None]:
            if part is not None and (isinstance(part, str) or part.tag in VOID or not part.beside and not part.blocky
                                     and part is not core and id(part) not in path):
                run.append(part)
                continue
            if run and _run_passes(run, least, ratio):
                kept += run
            run = []
            if part is None or part.beside:
                continue
            if part is core or id(part) in path:
                kept.append(part)
                if part is not core:
                    stack.append(part)
            elif part.tag == "h1" or passes(part.density, part.plain, least) and not RIGHTS.match(_words(part)):
                kept.append(part)
            elif part.blocky:
                kept.append(part)
                stack.append(part)
        node.parts = kept
    # parts come behind their parents
    for node in reversed(opened):
        if id(node) not in path and not any(
                p.strip() if isinstance(p, str) else p.tag not in HEADINGS and p.tag not in VOID and p.chars
                for p in node.parts):
            node.parts, node.chars = [], 0


def _words(node: Node) -> str:
    """The start of the node's text, enough to tell a line of rights."""
    out: list[list[str]] = [[]]
    if node.chars <= 300:
        _blocks(node, out)
    return unescape("".join("".join(block) for block in out))


def _run_passes(run: list[Node | str], least: float, ratio: float) -> bool:
    """As for a branch, of text and inline elements that stand side by side."""
    inline = [r for r in run if not isinstance(r, str) and r.tag not in VOID]
    chars = sum(len(" ".join(r.split())) for r in run if isinstance(r, str)) + sum(r.chars for r in inline)
    tags = len(inline) + sum(r.tags for r in inline)
    link_chars = sum(r.link_chars for r in inline)
    link_tags = sum(r.link_tags + (r.tag == "a") for r in inline)
    text = "".join(r for r in run if isinstance(r, str)) if chars <= 300 else ""
    return not RIGHTS.match(unescape(text)) and passes(
        density(chars, tags, link_chars, link_tags, ratio), density(chars, tags, 0, 0, 0.0), least)


def extract_text(df: DataFrame, html: str = "html", keep: list[str] | None = None) -> DataFrame:
    """Append the main ``text`` of each page and its length in code points, ``n_chars``.

    Null and empty pages, and pages without main text, give the empty text. Each row gives one row,
    repeated rows too; an input column named ``text`` or ``n_chars`` is replaced. Pages are read whole;
    one page is held in memory at a time as a tree. An empty table gives an empty one.
    """

    def start():
        def work(column: pa.Array) -> list[pa.Array]:
            found = [main_text(page) for page in texts_of(column)]
            return [pa.array(found, pa.string()), pa.array(map(len, found), pa.int64())]

        return work

    return map_rows(df, [html], [StructField("text", StringType()), StructField("n_chars", LongType())], start, keep)
