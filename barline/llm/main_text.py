"""Main text of web pages by tree scoring.

A page becomes a tree of elements and text blocks (runs of text between block elements).
Elements that a page shows around its article by their kind are left out at once: scripts,
styles, forms and their controls, menus, asides, footers, page headers, hidden parts, and
parts whose class, id or role says so (adverts, notices, sidebars, reader comments, ...).
Each block that is left passes points to its ancestors: one, plus one a comma, plus up to three
for length; all points go to its container, half to the next, then less by level (``SHARES``).
An element's score is its sum discounted by its link density, the share of its characters
inside links.  The best container is taken, widened to the ``article`` or ``main`` it lies in;
around it, siblings stay that score a fifth of it, headings, and plain paragraphs of few links.  All blocks in what stays make the text, whatever their length, but for lists and
boxes that are mostly links.

Where no block scored (an article that ends after its heading), the ``article`` or ``main``
itself is the text.

Defined cases: null, empty and text-free pages give an empty text; broken markup is read as
browsers do (unclosed elements end with their container, an unfinished tag at the end is
dropped, an unknown ``&`` stays); nesting of any depth is kept in lists, not in the call stack;
repeated rows each give a row; columns other than the three named play no part.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pages converted to Python strings at a time.
ROWS = 64

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup html legend li main menu nav ol optgroup option p pre search section summary table "
    "tbody td tfoot th thead tr ul".split())
#: Their content reaches up to their own end tag and is never shown as text.
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp template svg".split())
DROPPED = frozenset("head nav aside footer dialog menu search form button select datalist object video audio canvas applet".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that points go to.
CONTAINERS = frozenset("article main section div body td center form blockquote #root".split())
#: Open elements that a start tag ends, and the elements beyond which it ends none.
P_ENDERS = BLOCKS - frozenset("tbody thead tfoot tr td th option optgroup caption legend body html head".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
          "tbody": ("tbody", "thead", "tr", "td", "th"), "tfoot": ("tbody", "thead", "tr", "td", "th"), "option": ("option",), "a": ("a",)}
CELLS = frozenset("td th table caption body html article main section div button object li blockquote #root".split())
BOUNDS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table", "tr"), "th": ("table", "tr"),
          "tbody": ("table",), "tfoot": ("table",), "option": ("select",), "a": CELLS}

#: Words of a class or id that name what stands around an article.
FURNITURE = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense adslot adbox banner banners promo promos promotion "
    "sponsor sponsored sponsors cookie cookies consent gdpr notice notices notification notifications alert popup popover modal overlay "
    "lightbox paywall newsletter subscribe subscription signup sidebar sidebars aside rail menu menus nav navbar navigation topnav subnav "
    "breadcrumb breadcrumbs pagination pager header footer colophon masthead topbar toolbar skiplink share sharing sharebar social socials "
    "related recommended recommendations recirculation trending outbrain taboola teasers login signin search searchbox copyright tagcloud".split())
COMMENTS = frozenset("comment comments commentlist disqus respond reply replies".split())
#: Those that also count for an article or a paragraph, and for an element inside a line.
ARTICLE_FURNITURE = COMMENTS | {"ad", "ads", "advert", "advertisement", "related", "recommended", "sponsored", "promo", "teasers"}
LINE_FURNITURE = frozenset("ad ads advert advertisement sponsored share sharing social".split())
ROLES = frozenset("navigation banner contentinfo complementary dialog alertdialog alert search form menu menubar toolbar tablist tooltip".split())
#: Beside one of these words, a name speaks of something the element lacks or merely stands with.
BEFORE = frozenset("has with no without show hide is js not can allow enable disable".split())
AFTER = frozenset("open closed enabled disabled on off".split())
#: What a header of these names heads is the article.
HEADED = frozenset("post entry article page content story".split())

_TOKEN = re.compile(r"""<(?:!--(?P<comment>-?>|.*?(?:--!?>|\Z))
    |(?P<end>/)?(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>"']|"[^"]*"|'[^']*')*+)(?P<close>>|\Z)
    |(?P<end2>/)?(?P<name2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)(?P<close2>>|\Z)
    |[!?/][^>]*(?:>|\Z))""", re.S | re.X)
_ATTR = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'=<>`]+)))?""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")
_ENDS = {n: re.compile(rf"</{n}(?=[\s/>])[^>]*>|\Z", re.I) for n in RAW}
COMMAS = ",،、，"
#: What the containers of a block get of its points, from the inside out.
SHARES = (1, 1 / 2, 1 / 6, 1 / 9, 1 / 12, 1 / 15)
#: Left out where they are mostly links.
LINK_LISTS = frozenset("ul ol dl div section table".split())


class Node:
    """An element that holds blocks; ``parts`` has its elements and blocks of text in page order."""

    __slots__ = ("tag", "parent", "parts", "names", "hidden", "dropped", "points", "chars", "linked")

    def __init__(self, tag: str, parent: "Node | None", names: tuple = (), hidden: bool = False):
        self.tag, self.parent, self.parts, self.names, self.hidden = tag, parent, [], names, hidden


class Block(str):
    """A block's text; ``linked`` is the number of its characters in links."""

    linked = 0


def _attributes(attrs: str) -> tuple[bool, tuple]:
    """Whether the element is hidden; the words of each of its class, id and role names."""
    hidden, names = False, []
    for key, a, b, c in _ATTR.findall(attrs):
        key, value = key.lower(), a or b or c
        if key in ("class", "id"):
            names += [tuple(w.lower() for w in _WORD.findall(x)) for x in value.split()]
        elif key == "role" and value.lower() in ROLES:
            names.append(("sidebar",))
        elif key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "style" and _HIDDEN.search(value.lower()):
            hidden = True
    return hidden, tuple(n for n in names if n)


def _named(names: tuple, words: frozenset) -> bool:
    """Whether a word of ``words`` stands in a name and speaks of the element itself."""
    for name in names:
        for k, w in enumerate(name):
            if w in words and not (k and name[k - 1] in BEFORE) and not (k + 1 < len(name) and name[k + 1] in AFTER) \
                    and not (w == "header" and k and name[k - 1] in HEADED):
                return True
    return False


class _Reader:
    """Builds the tree.  ``tags`` are the open elements; for each, ``nodes`` has the node that its
    text goes to and ``quiet`` whether the element silences its text."""

    def __init__(self):
        self.root = Node("#root", None)
        self.tags, self.nodes, self.quiet = ["#root"], [self.root], [False]
        self.buffer, self.link_parts, self.links, self.silent = [], [], 0, 0

    def text(self, raw: str) -> None:
        if raw and not self.silent:
            raw = html.unescape(raw) if "&" in raw else raw
            self.buffer.append(raw)
            if self.links:
                self.link_parts.append(raw)

    def flush(self) -> None:
        """Ends a block."""
        if self.buffer:
            text = " ".join("".join(self.buffer).split())
            if text:
                block = Block(text)
                if self.link_parts:
                    block.linked = min(len(text), sum(len(" ".join(x.split())) for x in self.link_parts))
                self.nodes[-1].parts.append(block)
            self.buffer, self.link_parts = [], []

    def close(self, k: int) -> None:
        """Ends the open elements from place ``k`` on."""
        if not BLOCKS.isdisjoint(self.tags[k:]):
            self.flush()
        self.links -= self.tags[k:].count("a")
        self.silent -= sum(self.quiet[k:])
        del self.tags[k:], self.nodes[k:], self.quiet[k:]

    def nearest(self, wanted, bounds) -> int:
        """Place of the innermost open element of ``wanted`` inside ``bounds``; 0 if there is none."""
        for k in range(len(self.tags) - 1, 0, -1):
            if self.tags[k] in wanted:
                return k
            if self.tags[k] in bounds:
                break
        return 0

    def end(self, tag: str) -> None:
        if tag in ("br", "body", "html"):
            self.text(" ")
            return
        table = tag in ("table", "tbody", "thead", "tfoot", "tr", "td", "th", "caption")
        k = self.nearest((tag,), () if table else ("td", "th", "table") if tag in BLOCKS else CELLS)
        if k:
            self.close(k)
        elif tag == "p":
            self.flush()

    def start(self, tag: str, attrs: str) -> None:
        if tag == "br":
            self.text(" ")
        if tag in VOID and tag != "hr" or tag in ("html", "body") and tag in self.tags:
            return
        if tag in CLOSES and (k := self.nearest(CLOSES[tag], BOUNDS[tag])):
            # of several nested ones (a cell and its row), the outermost ends
            while self.tags[k - 1] in CLOSES[tag]:
                k -= 1
            self.close(k)
        if (tag in P_ENDERS or tag == "hr") and (k := self.nearest(HEADINGS | {"p"} if tag in HEADINGS else ("p",), CELLS)):
            self.close(k)
        if tag in BLOCKS and "head" in self.tags[1:3]:
            self.close(self.tags.index("head"))
        if tag == "hr":
            self.flush()
            return
        hidden, names = _attributes(attrs) if attrs and not attrs.isspace() else (False, ())
        if tag in BLOCKS:
            self.flush()
            node, quiet = Node(tag, self.nodes[-1], names, hidden), False
            self.nodes[-1].parts.append(node)
        else:
            node, quiet = self.nodes[-1], hidden or tag in DROPPED or bool(names) and _named(names, LINE_FURNITURE)
        self.tags.append(tag)
        self.nodes.append(node)
        self.quiet.append(quiet)
        self.links += tag == "a"
        self.silent += quiet


def parse(page: str) -> Node:
    """The tree of a page."""
    reader, at, size = _Reader(), 0, len(page)
    while at < size:
        lt = page.find("<", at)
        m = _TOKEN.match(page, lt) if lt >= 0 else None
        if m is None:  # no tag: up to the end, or to a "<" that starts none
            after = lt + 1 if lt >= 0 else size
            reader.text(page[at:after])
            at = after
            continue
        reader.text(page[at:lt])
        at = m.end()
        name = m["name"] or m["name2"]
        if name is None:
            continue
        if not (m["close"] or m["close2"]):
            break  # an unfinished tag at the end
        name, attrs = name.lower(), m["attrs"] or m["attrs2"] or ""
        if m["end"] or m["end2"]:
            reader.end(name)
        elif name not in RAW:
            reader.start(name, attrs)
        elif not (name == "svg" and attrs.endswith("/")):
            at = _ENDS[name].search(page, at).end()
    reader.flush()
    return reader.root


def _elements(root: Node) -> list[Node]:
    """All elements, containers before what they hold."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo.extend(x for x in reversed(node.parts) if isinstance(x, Node))
    return out


def _drop(elements: list[Node]) -> None:
    """Marks what stands around an article; containers come first, so marks go down the tree."""
    size, holds = {}, set()  # characters in an element; elements around an article
    for node in reversed(elements):
        size[node] = size.get(node, 0) + sum(len(x) for x in node.parts if isinstance(x, Block))
        if node.parent is not None:
            size[node.parent] = size.get(node.parent, 0) + size[node]
            if node in holds or node.tag == "main" or node.tag == "article" and not _named(node.names, ARTICLE_FURNITURE):
                holds.add(node.parent)
    inside = set()  # an article or main
    elements[0].dropped = False
    for node in elements[1:]:
        up, tag = node.parent, node.tag
        if up in inside or tag in ("article", "main"):
            inside.add(node)
        if up.dropped or node.hidden:
            gone = True
        elif tag in DROPPED:
            # a form around an article or most of a page is the page's own
            gone = tag != "form" or node not in holds and 2 * size[node] <= size[elements[0]]
        elif tag == "header":
            gone = up not in inside
        elif up.tag == "header":  # the article's: its headings
            gone = tag not in HEADINGS and not any(isinstance(x, Node) and x.tag in HEADINGS for x in node.parts)
        elif not node.names or tag in HEADINGS or tag in ("html", "body", "main"):
            gone = False
        elif tag in ("article", "p", "td", "tr", "tbody", "table", "blockquote", "pre"):
            gone = _named(node.names, ARTICLE_FURNITURE)
        else:
            gone = _named(node.names, COMMENTS) or _named(node.names, FURNITURE) and node not in holds
        node.dropped = gone


def _score(elements: list[Node]) -> None:
    for node in elements:
        node.points, node.chars, node.linked = 0.0, 0, 0
    for node in elements:
        if node.dropped:
            continue
        for block in node.parts:
            if not isinstance(block, Block):
                continue
            node.chars += len(block)
            node.linked += block.linked
            if node.tag in HEADINGS or 2 * block.linked > len(block):
                continue
            points, level, up = 1 + sum(map(block.count, COMMAS)) + min(len(block) / 100, 3), 0, node
            while up is not None and level < len(SHARES):
                if up.tag in CONTAINERS:
                    up.points += points * SHARES[level]
                    level += 1
                up = up.parent
    for node in reversed(elements):
        if node.parent is not None and not node.dropped:
            node.parent.chars += node.chars
            node.parent.linked += node.linked


def _density(node: Node) -> float:
    return node.linked / node.chars if node.chars else 0.0


def _value(node: Node) -> float:
    return node.points * (1 - _density(node))


def _above(node: Node) -> Iterator[Node]:
    """The node and what it lies in."""
    while node is not None:
        yield node
        node = node.parent


def _kept(elements: list[Node]) -> list[Node]:
    """The best container and those of its siblings that belong to it, in page order."""
    live = [n for n in elements if not n.dropped]
    best = max(live, key=_value)  # the first in page order among equals
    if _value(best) <= 0:
        return [n for n in live if n.tag in ("article", "main") and not any(up.tag in ("article", "main") for up in _above(n.parent))]
    for whole in ("article", "main"):  # one text, also where it is cut into sections
        if (found := next((n for n in _above(best) if n.tag == whole), None)) is not None:
            best = found
            break
    if best.parent is None or best.tag == "body":
        return [best]
    fifth, bare = _value(best) / 5, best.tag not in ("article", "main")

    def belongs(x: Node) -> bool:
        density, score = _density(x), _value(x)
        if x.tag in HEADINGS or x.tag == "p":
            return bare and density < 0.25
        alike = fifth if x.tag == best.tag and x.names and x.names == best.names else 0
        return score > 0 and score + alike >= max(fifth, 1) and density < 0.5

    return [x for x in best.parent.parts if x is best or isinstance(x, Node) and not x.dropped and x.chars and belongs(x)]


def _blocks(kept: list[Node]) -> list[str]:
    out, tops = [], set(kept)
    todo: list[Node | Block] = list(reversed(kept))
    while todo:
        x = todo.pop()
        if isinstance(x, Block):
            out.append(str(x))
        elif not x.dropped and (x in tops or x.tag not in LINK_LISTS or _density(x) <= 0.6):
            todo.extend(reversed(x.parts))
    return out


def main_text(page: str | None) -> str:
    """The article of a page: its blocks in page order, joined by an empty line."""
    if not page:
        return ""
    elements = _elements(parse(page))
    _drop(elements)
    _score(elements)
    return "\n\n".join(_blocks(_kept(elements)))


def extract_main_text(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per page: ``page_id, url, text, n_chars``."""
    rows = pages.select(F.col(f"`{id_col}`").cast("bigint").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"),
                        F.col(f"`{html_col}`").cast("string").alias("html"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, ROWS):
                batch = whole.slice(lo, ROWS)
                texts = [main_text(p) for p in batch.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                                                 names=["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
