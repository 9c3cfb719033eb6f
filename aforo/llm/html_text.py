"""Main text of web pages by tree scoring."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aforo.llm.common import in_bytes, table

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is not markup, and of those the ones whose content is text of no article.
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
#: Elements that never hold main text, whatever their attributes.
DROPPED = frozenset(
    "head script style textarea title iframe noembed noframes noscript template svg canvas math object applet audio video "
    "nav footer aside form button select input label fieldset datalist dialog menu map".split())
BLOCKS = frozenset(
    "html body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd pre blockquote table caption thead tbody tfoot "
    "tr td th figure figcaption header footer nav aside address details summary hgroup center hr form fieldset search".split())
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
#: What a start tag closes, and the elements beyond which it does not look.
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
    "tbody": (("thead", "tbody", "tfoot", "tr", "td", "th"), ("table",)), "tfoot": (("thead", "tbody", "tr", "td", "th"), ("table",)),
    "option": (("option",), ("select", "datalist")),
}
#: An end tag does not close anything outside of the table cell or object it stands in.
WALLS = frozenset("td th caption table object template body html".split())
ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar toolbar form".split())
#: Words of class and id. What follows an article, or interrupts it, goes even where it looks like one.
APART = frozenset(
    "comment comments commentlist disqus replies respond responses reader readers sidebar sidebars aside rail related recommended "
    "recommendations teaser teasers trending outbrain taboola cookie cookies consent gdpr newsletter subscribe subscription "
    "breadcrumb breadcrumbs pagination pager share sharing social popup modal overlay ad ads advert adverts advertisement "
    "advertising advertorial adsense adslot adbox sponsor sponsored sponsors promo promos promotion promoted footer colophon "
    "nav navbar navigation login signup paywall toast hidden".split())
#: Words that also name parts of a layout; they count unless the element holds the article.
PERHAPS = frozenset(
    "header masthead topbar banner menu menus submenu toolbar notice notices notification alert widget widgets search tabs "
    "skip copyright legal disclaimer side tools links logo".split())
#: Words next to which one of the above names a part of the article or the layout round it.
OWN_HEAD = frozenset("article entry post story content page".split())
LAYOUT = frozenset("has with without no layout wrapper container".split())
#: Headings above the discussion of an article or above other articles.
AFTER = re.compile(
    r"(\d+\s+)?((reader|user)\s+)?(comments?|kommentare?|leserkommentare|commentaires|comentarios|discussion|replies|responses|"
    r"related(\s+(articles|posts|stories))?|leave\s+a\s+(comment|reply))(\s*\(\d+\))?\s*:?", re.I)
GOOD = re.compile(r"\b(article|body|content|entry|main|page|post|text|blog|story)\b", re.I)

#: Stands for the whole page, also where a page is a mere fragment.
ROOT = "#root"
_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<[!?][^>]*(?:>|\Z)|</\s*([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|<([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)|<[a-zA-Z/][^>]*(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Node:
    __slots__ = ("tag", "attrs", "parent", "items", "size", "linked", "commas", "links", "score")

    def __init__(self, tag: str, attrs: str, parent: Node | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.items: list[Node | str] = []  # children and texts in page order
        self.size = self.linked = self.commas = self.links = 0  # characters, characters in links, commas, links
        self.score = 0.0

    def attribute(self, *names: str) -> str:
        return " ".join(
            html.unescape(next((v for v in m.groups()[1:] if v), ""))
            for m in _ATTRIBUTE.finditer(self.attrs) if m.group(1).lower() in names) if self.attrs else ""


def parse(page: str) -> Node:
    """The tree of a page. End tags may be missing; those that match nothing open are ignored."""
    root = top = Node(ROOT, "", None)
    opened: dict[str, int] = {}
    at = 0

    def close(to: Node) -> Node:
        """Close everything from the innermost open element up to and with ``to``."""
        nonlocal top
        while top is not to:
            opened[top.tag] -= 1
            top = top.parent
        opened[to.tag] -= 1
        top = to.parent
        return top

    def enclosing(tags: tuple[str, ...], walls) -> Node | None:
        node = top
        while node is not root:
            if node.tag in tags:
                return node
            if node.tag in walls:
                return None
            node = node.parent
        return None

    while True:
        found = _TOKEN.search(page, at)
        text = page[at:found.start() if found else len(page)]
        if text:
            top.items.append(html.unescape(text) if "&" in text else text)
        if not found:
            return root
        at = found.end()
        end, start = found.group(1), found.group(2)
        if end:
            tag = end.lower()
            if tag == "br":
                top.items.append(Node("br", "", top))
            elif opened.get(tag):
                walls = WALLS - {tag} if tag in BLOCKS else BLOCKS
                match = enclosing((tag,), walls)
                if match is not None:
                    close(match)
        elif start:
            tag, attrs = start.lower(), found.group(3)
            if tag in BLOCKS and opened.get("p"):
                open_p = enclosing(("p",), WALLS | {"button"})
                if open_p is not None:
                    close(open_p)
            if tag in CLOSES:
                tags, walls = CLOSES[tag]
                while any(opened.get(t) for t in tags) and (match := enclosing(tags, walls)) is not None:
                    close(match)
            elif tag == "a" and opened.get("a") and (match := enclosing(("a",), WALLS)) is not None:
                close(match)
            elif tag in HEADINGS and top.tag in HEADINGS:
                close(top)
            node = Node(tag, attrs, top)
            top.items.append(node)
            if tag in RAW:
                over = re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I).search(page, at)
                at = over.start() if over else len(page)
                last = page.find(">", at)
                at = last + 1 if over and last >= 0 else len(page)
            elif tag not in VOID and not (attrs.rstrip().endswith("/") and tag not in BLOCKS):
                opened[tag] = opened.get(tag, 0) + 1
                top = node


def names(node: Node) -> set[str]:
    """The words in class and id: ``siteNav-top`` has site, nav and top."""
    return {w.lower() for w in _NAME_PART.findall(node.attribute("class", "id"))}


def walk(root: Node) -> list[Node]:
    """All elements in page order."""
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        out.append(node)
        stack.extend(i for i in reversed(node.items) if type(i) is Node)
    return out


def _holds(node: Node, tags: tuple[str, ...]) -> bool:
    return any(n.tag in tags for n in walk(node))


def _is_apart(node: Node, whole: int) -> bool:
    """Whether an element and all in it is no part of an article."""
    if node.tag in DROPPED:
        return True
    if not node.attrs:
        return node.tag == "header" and not _holds(node, HEADINGS)
    bare = {m.group(1).lower() for m in _ATTRIBUTE.finditer(node.attrs)}
    if "hidden" in bare or node.attribute("aria-hidden").lower() == "true" or _HIDDEN.search(node.attribute("style")):
        return True
    if node.tag in ("html", "body", "main"):
        return False
    if ROLES.intersection(node.attribute("role").lower().split()):
        return True
    own = names(node)
    if own & APART and not own & LAYOUT:
        return not _holds(node, ("main",))
    if (own & PERHAPS or node.tag == "header") and not own & LAYOUT and node.tag != "article":
        if own & OWN_HEAD or node.size * 2 > whole:
            return False
        return not _holds(node, ("main", "article", *(HEADINGS if node.tag == "header" else ())))
    return False


def _measure(order: list[Node]) -> None:
    """Characters, linked characters, commas and links of every element, from the leaves up."""
    for node in reversed(order):
        size = commas = linked = links = 0
        for item in node.items:
            if type(item) is Node:
                size, commas, linked, links = size + item.size, commas + item.commas, linked + item.linked, links + item.links
            else:
                size += len(item.strip()) if len(item) < 3 else len(" ".join(item.split()))
                commas += item.count(",") + item.count("、") + item.count("，")
        node.size, node.commas = size, commas
        node.linked, node.links = (size, links + 1) if node.tag == "a" else (linked, links)


def prune(root: Node) -> None:
    """Take out of the tree what belongs to no article."""
    _measure(walk(root))
    whole = root.size
    stack = [root]
    while stack:
        node = stack.pop()
        kept: list[Node | str] = []
        for item in node.items:
            if type(item) is Node:
                if _is_apart(item, whole):
                    continue
                stack.append(item)
            kept.append(item)
        for k, item in enumerate(kept):
            if type(item) is Node and item.tag in HEADINGS and AFTER.fullmatch(" ".join(text_of(item).split())):
                if node.tag in ("section", "div") and not any(type(i) is Node and i.size for i in kept[:k]):
                    kept = []  # a section of its own
                else:
                    kept = kept[:k] if node.tag not in ("body", "html", ROOT) else kept
                break
        node.items = kept
    _measure(walk(root))
    # Lists of links inside the article: menus without a name.
    for node in walk(root):
        node.items = [i for i in node.items if not (
            type(i) is Node and i.tag in ("ul", "ol", "div", "table", "section", "dl") and i.links >= 3 and i.linked > 0.66 * i.size)]
    _measure(walk(root))


def text_of(root: Node) -> str:
    """The text of an element, its children's in page order."""
    out, stack = [], [root]
    while stack:
        item = stack.pop()
        if type(item) is Node:
            stack.extend(reversed(item.items))
        else:
            out.append(item)
    return "".join(out)


def density(node: Node) -> float:
    return node.linked / node.size if node.size else 0.0


def _paragraphs(order: list[Node]) -> Iterator[Node]:
    """Elements that hold text of their own: paragraphs, and other blocks with text beside their child blocks."""
    for node in order:
        if (node.tag in BLOCKS or node.tag == ROOT) and node.size and node.tag not in HEADINGS:
            if node.tag in ("p", "pre", "blockquote") and not any(type(i) is Node and i.tag in BLOCKS for i in node.items):
                yield node
            elif any(i.strip() if type(i) is not Node else i.tag not in BLOCKS and i.size for i in node.items):
                yield node


def score(order: list[Node]) -> None:
    """Every paragraph passes points for its length and commas to its ancestors, less with each step."""
    for node in order:
        node.score = 0.0
    for paragraph in _paragraphs(order):
        own = sum(len(i.strip()) if type(i) is not Node else i.size for i in paragraph.items if type(i) is not Node or i.tag not in BLOCKS)
        points = (min(own / 25, 1) + paragraph.commas + min(own / 100, 3)) * (1 - density(paragraph))
        ancestor = paragraph.parent if paragraph.tag in ("p", "pre", "blockquote", "li", "td", "dd", "dt") else paragraph
        for step in range(5):
            if ancestor is None:
                break
            ancestor.score += points / (1 if step == 0 else 2 if step == 1 else 3 * step)
            ancestor = ancestor.parent
    for node in order:
        if node.score:
            node.score += 5 * (node.tag in ("article", "main")) + 2 * bool(node.attrs and GOOD.search(node.attribute("class", "id")))
            node.score *= 1 - density(node)


def main_parts(root: Node) -> list[Node]:
    """The best container and those of its siblings that look like more of the same article, in page order."""
    order = walk(root)
    score(order)
    best = max(order, key=lambda n: n.score)  # the first of equal ones
    if best.score <= 0:
        return []
    # An article in sections: its best section stands for all of it.
    node = best
    while node is not None:
        if node.tag in ("article", "main") or "articlebody" in node.attribute("itemprop").lower():
            best = node
            if node.tag != "main":
                break
        node = node.parent
    if best.parent is None:
        return [best]
    # A container that holds most of what its parent has is one of several parts.
    while best.tag not in ("article", "main", "body") and best.parent.tag in ("div", "section", "td", "article", "main") and (
            best.parent.score >= 0.75 * best.score):
        best = best.parent
    threshold = max(10.0, best.score * 0.2)
    parts, siblings = [], [i for i in best.parent.items if type(i) is Node]
    own = siblings.index(best)
    for k, node in enumerate(siblings):
        if node is best:
            parts.append(node)
        elif best.tag == "main" or not node.size:
            continue
        elif node.tag in HEADINGS:
            if k < own and all(s.tag in HEADINGS or not s.size for s in siblings[k:own]):
                parts.append(node)
        elif node.score + 0.2 * best.score * bool(best.attrs and names(node) == names(best)) >= threshold:
            parts.append(node)
        elif node.tag == "p" and density(node) < 0.25 and (node.size > 80 or (density(node) == 0 and text_of(node).rstrip().endswith((".", "!", "?")))):
            parts.append(node)
    return parts


def blocks(part: Node) -> list[str]:
    """The text of each block of an element; two line breaks in a row part blocks as well."""
    out: list[str] = []
    current: list[str] = []
    breaks = 0

    def flush() -> None:
        text = " ".join("".join(current).split())
        current.clear()
        if text:
            out.append(text)

    stack: list[Node | str | None] = [part]  # None: the end of a block
    while stack:
        item = stack.pop()
        if item is None:
            flush()
            breaks = 0
        elif type(item) is not Node:
            if item.strip():
                breaks = 0
            current.append(item)
        elif item.tag == "br":
            breaks += 1
            current.append(" ")
            if breaks == 2:
                flush()
        else:
            if item.tag in BLOCKS:
                flush()
                breaks = 0
                stack.append(None)
            stack.extend(reversed(item.items))
    flush()
    return out


def main_text(page: str | None) -> str:
    """Blocks of the article of a page, joined by line feeds; empty if there is none."""
    root = parse(page or "")
    prune(root)
    return "\n".join(b for part in main_parts(root) for b in blocks(part))


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in in_bytes(batches, "html"):
        found = [main_text(page).encode("utf-8", "replace") for page in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(found, pa.binary()).cast(pa.string())],
                                         names=["page_id", "url", "text"])


def extract_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page: its article without menus, notices, adverts, forms and comments.

    Elements that belong to no article by their tag, role or name are taken out.
    What is left is scored: paragraphs pass points for length and commas to
    their ancestors, less with each step and the more of a text is links. The
    best container, widened to the article or main element it stands in, is
    kept with those siblings that score enough. Nothing is shuffled and a task
    holds about two megabytes of pages, or one page that is longer.

    A missing or empty page, and one that holds nothing but the above, has an
    empty text. Repeated rows give repeated rows, no rows give none, other
    columns are ignored; page_id and url may be missing.
    """
    fields = T.StructType([pages.schema["page_id"], pages.schema["url"], T.StructField("text", T.StringType())])
    return pages.select("page_id", "url", "html").mapInArrow(_texts, fields).withColumn("n_chars", F.char_length("text").cast("long"))


def op12_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))
