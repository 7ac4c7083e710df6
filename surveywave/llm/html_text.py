"""Main text of web pages by composite text density.

A small parser builds the element tree (void and raw-text elements, implied
end tags, stray and missing tags).  Subtrees that are boilerplate by element or
role are taken out, but a form or page header that holds most of the page's text,
with a paragraph or heading among it, wraps the page and stays.

A class or id names a container, never a heading, a paragraph or text markup.  Of
a name's words the last one says what the container is, and the first one does if
it is plain (PLAIN_WORDS: `footer-left`, not `menu-description`).  Reader comments
(COMMENT_WORDS) go in any case.  Other named containers go unless they hold an
<article> or <main>, or most of the page's text with no such element beside them.
Names that may be topics (TOPIC_WORDS, and first words that are not plain) are
evidence only: the container goes if half of its text is links or, outside an
article, if its density is below the threshold.

For every element left, with C characters, T tags, LC characters in links, LT
link tags, and the body's C_b, LC_b, the composite text density is

    C / T * log(C / LC * T / LT) / log(log(C / (C - LC) * LC + LC_b / C_b * C + e))

(zero counts count as 1, the lower logarithm as 1 at least).  The element with
the largest sum of its children's densities is the main subtree; the least
density on its path to the body is the threshold, and subtrees beside that path
whose density reaches it are kept as well, and so are headings that lead up to it
with nothing between.  A main subtree inside <article> or <main> extends to that
element.  Nothing inside what is kept is dropped.

One pass over the pages, no shuffle.  The parser knows the places of the open
elements of each kind, so a tag that closes nothing costs one look: all of it is
linear in a page's length.

Edge cases.  NULL, empty and all-boilerplate pages give an empty text.  Of equal
density sums the first subtree in page order is the main one.  Repeated rows get
a result each; a page is read whole, however long; an empty table gives none.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th "
    "thead tr ul br".split())
CLOSES_P = BLOCK - frozenset("br option body html caption td th tr tbody thead tfoot legend".split())
# an opening tag ends the open element of one of these kinds, up to a border
ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "option": ({"option"}, {"select"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
        "th": ({"td", "th"}, {"tr", "table"}), "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
        "tfoot": ({"thead", "tbody", "tr", "td", "th"}, {"table"}), "a": ({"a"}, {"div", "table", "section", "article"})}
DROPPED = frozenset("head title script style noscript template svg math iframe object canvas video audio map nav footer aside "
                    "button select textarea input dialog menu embed noframes".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
DROPPED_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner menu nav navbar navigation "
    "breadcrumb breadcrumbs sidebar aside footer masthead cookie cookies consent notice notices popup modal overlay newsletter "
    "subscribe signup social share sharing related recommended comment comments commentlist disqus respond replies widget "
    "toolbar pagination pager login alert disclaimer discussion topnav subnav sidenav submenu topbar leftbar rightbar adbox adslot".split())
COMMENT_WORDS = frozenset("comment comments commentlist disqus replies respond".split())
TOPIC_WORDS = frozenset("aside discussion disclaimer login overlay promotion recommended related share sharing social".split())
# as the first word of a name they already say what the container is
PLAIN_WORDS = COMMENT_WORDS | frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo breadcrumb breadcrumbs sidebar footer masthead cookie cookies "
    "consent newsletter subscribe signup navbar pagination pager popup topnav subnav sidenav submenu topbar leftbar rightbar adbox adslot nav".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
LABELS = frozenset({"label", "legend"})
AROUND = frozenset("has with no without".split())
COMMENT, SURE, TOPIC = "comment", "sure", "topic"  # what a name makes of a container
NEVER_BY_WORD = frozenset(
    "html body main article h1 h2 h3 h4 h5 h6 p pre blockquote figure figcaption table thead tbody tfoot tr td th caption dt dd span b i em strong u s "
    "small mark sub sup code kbd samp var q cite abbr time font".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>?|"
    r"<(/?)([a-zA-Z][^\s/>]*+)((?:=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|[^>])*+)>?", re.S)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]++)(?:\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?|\"[^\"]*\"|'[^']*'")
_WORD_CUT = re.compile(r"[^a-zA-Z0-9]+|(?<=[a-z])(?=[A-Z])")


class _Node:
    __slots__ = ("tag", "parent", "children", "drop", "chars", "tags", "link_chars", "link_tags", "own", "first", "last", "density", "total", "named", "in_article", "head_chars", "label_chars")

    def __init__(self, tag: str, parent: "_Node | None", drop: bool, named: str = "", in_article: bool = False):
        self.tag, self.parent, self.drop, self.children = tag, parent, drop, []
        self.named, self.in_article = named, in_article
        self.clear()

    def clear(self) -> None:
        self.chars = self.tags = self.link_chars = self.link_tags = self.own = self.head_chars = self.label_chars = 0
        self.density = self.total = 0.0


def _boilerplate(tag: str, attributes: str, inside_article: bool) -> tuple[bool, str]:
    """Whether an element is boilerplate, and else what its names make of it."""
    if tag in DROPPED:
        return True, ""
    if tag == "form" or tag == "header" and not inside_article:
        return False, SURE
    if not attributes or attributes.isspace() or tag in ("html", "body", "main", "article"):
        return False, ""
    found: dict[str, str] = {}
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        found.setdefault(name.lower(), a or b or c)
    if found.get("role", "").lower() in DROPPED_ROLES or found.get("aria-hidden", "").lower() == "true" or "hidden" in found:
        return True, ""
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", found.get("style", ""), re.I):
        return True, ""
    named = ""
    for name in f"{found.get('class', '')} {found.get('id', '')}".split() if tag not in NEVER_BY_WORD else ():
        words = [w.lower() for w in _WORD_CUT.split(name) if w]
        # the first or last word names what an element is; has-sidebar, page-with-ads and no-comments name its surroundings
        words = words[:next((k for k, w in enumerate(words) if w in AROUND), None)]
        if words and words[0] not in ("is", "js"):
            for word, plain in ((words[-1], words[-1] not in TOPIC_WORDS), (words[0], words[0] in PLAIN_WORDS)):
                if word in DROPPED_WORDS and (not named or plain and named == TOPIC):
                    named = (COMMENT if word in COMMENT_WORDS else SURE) if plain else TOPIC
    return False, named


def _parse(page: str) -> tuple[_Node, list[tuple[_Node, str | None]]]:
    """The tree and the events in page order: a text of a node, or None for a
    block's border.  Events of a subtree are consecutive: first to last."""
    root = _Node("html", None, False)
    root.first = 0
    events: list[tuple[_Node, str | None]] = []
    stack = [root]
    place, article = 0, 0
    # places in the stack of the open elements of each kind, of blocks, and of
    # what a paragraph can't be closed through
    opened: dict[str, list[int]] = {}
    blocks, borders = [0], [0]

    def push(node: _Node) -> None:
        nonlocal article
        opened.setdefault(node.tag, []).append(len(stack))
        if node.tag in BLOCK:
            blocks.append(len(stack))
        if node.tag != "p" and node.tag in BLOCK or node.tag == "button":
            borders.append(len(stack))
        stack.append(node)
        article += node.tag in ("article", "main")

    def pop() -> None:
        nonlocal article
        node = stack.pop()
        if stack:
            opened[node.tag].pop()
            if blocks[-1] == len(stack):
                blocks.pop()
            if borders[-1] == len(stack):
                borders.pop()
        article -= node.tag in ("article", "main")
        if node.tag in BLOCK:
            events.append((node, None))
        node.last = len(events)

    def close(at: int) -> None:
        while len(stack) > at:
            pop()

    def last(tags) -> int:
        return max((opened[t][-1] for t in tags if opened.get(t)), default=0)

    def text(value: str) -> None:
        if value:
            events.append((stack[-1], entities.unescape(value)))

    while place < len(page):
        found = _TAG.search(page, place)
        if not found:
            text(page[place:])
            break
        if found.start() > place:
            text(page[place:found.start()])
        place = found.end()
        name = found[2]
        if name is None:
            if found[0].startswith("<![CDATA["):
                text(found[0][9:].removesuffix("]]>"))
            continue
        tag = name.lower()
        if found[1]:
            if tag in ("html", "body"):
                continue
            if tag == "br":
                events.append((stack[-1], None))
                continue
            at = opened[tag][-1] if opened.get(tag) else 0
            # an inline end tag does not close a block
            if at and (tag in BLOCK or at > blocks[-1]):
                close(at)
            continue
        if tag == "html":
            continue
        if tag in CLOSES_P and opened.get("p") and opened["p"][-1] > borders[-1]:
            close(opened["p"][-1])
        if tag in ENDS:
            kinds, border = ENDS[tag]
            while last(kinds) > last(border):
                close(last(kinds))
                if tag not in ("tr", "tbody", "tfoot"):
                    break
        if tag == "body" or tag != "head" and tag not in RAW and tag not in VOID and stack[-1].tag == "head":
            close(1)
        parent = stack[-1]
        drop, named = (True, "") if parent.drop else _boilerplate(tag, found[3], article > 0)
        node = _Node(tag, parent, drop, named, article > 0)
        parent.children.append(node)
        if tag in BLOCK:
            events.append((node, None))
        node.first = node.last = len(events)
        if tag in VOID or found[3].endswith("/") and tag not in BLOCK and tag not in RAW and tag != "a":
            continue
        push(node)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(page, place)
            place = end.start() if end else len(page)
    while stack:
        pop()
    return root, events


def _measure(root: _Node, events: list[tuple[_Node, str | None]]) -> list[_Node]:
    """Counts and densities; the nodes that stay, parents first."""
    order, walk = [], [root]
    while walk:
        node = walk.pop()
        node.drop = node.drop or node.parent is not None and node.parent.drop
        node.clear()
        if not node.drop:
            order.append(node)
        walk += reversed(node.children)
    for node, value in events:
        if value is not None and not node.drop:
            node.own += sum(map(len, value.split()))
    for node in reversed(order):
        node.chars += node.own
        if node.tag == "a":
            node.link_chars, node.link_tags = node.chars, node.link_tags + 1
        if node.parent:
            up = node.parent
            up.chars += node.chars
            up.tags += node.tags + 1
            up.link_chars += node.link_chars
            up.link_tags += node.link_tags
            up.head_chars += node.chars if node.tag in HEADINGS else node.head_chars
            up.label_chars += node.chars if node.tag in LABELS else node.label_chars
    page_share = root.link_chars / max(1, root.chars)

    def density(chars: int, tags: int, link_chars: int, link_tags: int) -> float:
        if not chars:
            return 0.0
        tags = max(1, tags)
        base = math.log(chars / max(1, chars - link_chars) * link_chars + page_share * chars + math.e)
        inner = max(1.0, chars / max(1, link_chars) * tags / max(1, link_tags))
        return chars / tags * math.log(inner) / max(1.0, math.log(base))

    for node in order:
        node.density = density(node.chars, node.tags, node.link_chars, node.link_tags)
        if node.parent:
            node.parent.total += node.density
    return order


def _body_path(order: list[_Node]) -> tuple[list[_Node], float]:
    """The main subtree with the elements above it, and the least density there."""
    path = [max(order, key=lambda n: n.total)]
    while path[-1].parent:
        path.append(path[-1].parent)
    return path, min(n.density for n in path if n.chars)


def _drop_named(root: _Node, events: list[tuple[_Node, str | None]], order: list[_Node]) -> list[_Node]:
    """Takes out what is boilerplate by name and measures what is left: first
    the names that say so alone, then topics by their links and density."""
    inside = dict.fromkeys(map(id, order), 0)  # articles in a node
    for node in reversed(order):
        if node.parent:
            inside[id(node.parent)] += inside[id(node)] + (node.tag in ("article", "main"))
    articles = inside[id(root)]
    for node in order:
        if node.named == COMMENT:
            node.drop = True
        elif node.named == SURE:
            holds = inside[id(node)] or node.chars * 2 > root.chars and (node.in_article or not articles)
            # a form that only asks something has most of its text in labels
            node.drop = not holds or node.tag == "form" and node.label_chars * 2 >= node.chars
    order = _measure(root, events)
    if not root.chars or not any(n.named == TOPIC for n in order):
        return order
    path, threshold = _body_path(order)
    on_path = set(map(id, path))
    for node in order:
        if node.named == TOPIC and id(node) not in on_path:
            node.drop = node.link_chars * 2 >= node.chars or not node.in_article and node.density < threshold
    return _measure(root, events)


def _leading(children: list[_Node], below: _Node) -> Iterator[_Node]:
    """The headings before an element on the path, with nothing between."""
    for node in reversed(children[:children.index(below)]):
        if node.drop or node.chars and (node.chars > (node.chars if node.tag in HEADINGS else node.head_chars) or node.link_chars * 2 >= node.chars):
            return
        if node.chars:
            yield node


def main_text(page: str | None) -> str:
    """The main text; empty for NULL, empty and all-boilerplate pages."""
    if not page:
        return ""
    root, events = _parse(page)
    order = _measure(root, events)
    if any(n.named for n in order):
        order = _drop_named(root, events, order)
    if not root.chars:
        return ""
    path, threshold = _body_path(order)
    best = path[0]
    semantic = next((n for n in reversed(path) if n.tag in ("article", "main")), None)
    if semantic is not None:
        best = semantic
        path = path[path.index(best):]
    kept = [best]
    for below, node in zip(path, path[1:]):
        kept += [c for c in node.children if c is not below and not c.drop and c.chars and c.density >= threshold
                 and c.link_chars * 2 < c.chars]
        kept += [c for c in _leading(node.children, below) if c.density < threshold]
    blocks: list[str] = []
    parts: list[str] = []
    for node in sorted(kept, key=lambda n: n.first):
        for owner, value in [*events[node.first:node.last], (node, None)]:
            if value is None:
                block = " ".join("".join(parts).split())
                parts = []
                if block:
                    blocks.append(block)
            elif not owner.drop:
                parts.append(value)
    return "\n".join(blocks)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    # a batch may hold 64 MB: some pages at a time
    for batch in (b.slice(low, 128) for b in batches for low in range(0, b.num_rows, 128)):
        texts = [main_text(page) for page in batch.column("_html").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("_row"), pa.array(texts, pa.string()),
                                          pa.array([len(t) for t in texts], pa.int64())], ["_row", "text", "n_chars"])


def extract_main_text(pages: DataFrame, html_col: str = "html", carry: list[str] | None = None) -> DataFrame:
    """The columns `carry` of pages (all but the html if not given) with text
    and n_chars; columns named text or n_chars are replaced.  A row per row.
    """
    names = [c for c in carry or pages.columns if c not in (html_col, "text", "n_chars")]
    packed = pages.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), F.col(html_col).cast("string").alias("_html"))
    schema = T.StructType([packed.schema["_row"], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    return packed.mapInArrow(_extract, schema).select("_row.*", "text", "n_chars")
