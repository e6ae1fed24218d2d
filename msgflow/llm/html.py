"""Main text of web pages by composite text density.

A page becomes a tree of its elements. Labelled boilerplate (navigation, page headers and footers, asides, adverts, notices,
forms, scripts, reader comments, hidden parts) is cut off. Every remaining node has its characters per tag, lowered by the share of
link text and link tags in it, and the sum of its children's densities. The subtree of the largest sum is the article's core; the
least density on its way up to the body is the threshold. From the body down, every node that reaches the threshold
contributes its own subtree of the largest sum, and a core within ``article`` or ``main`` stands for all of that element.

Pages are read one after the other within a task, in time that is linear in their length: nesting beyond ``DEPTH`` is flattened, and
no rule looks further than that.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from .tables import add_columns

#: Elements below this depth become siblings, as in browsers; their text stays.
DEPTH = 512

# Names of elements and roles of the HTML and ARIA standards.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes plaintext".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody tfoot thead tr ul".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span strike strong sub sup time tt u var".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CELLS = frozenset("td th caption".split())
#: Closing a tag does not reach beyond these.
WALLS = frozenset("html td th caption table button object template".split())
#: A start tag ends an open element of these names, up to the container of such elements.
ENDS = {
    "li": (frozenset({"li"}), frozenset({"ul", "ol", "menu", "dir"})),
    "dt": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "dd": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "option": (frozenset({"option"}), frozenset({"select", "datalist", "optgroup"})),
    "td": (frozenset({"td", "th", "caption"}), frozenset({"tr", "table"})),
    "th": (frozenset({"td", "th", "caption"}), frozenset({"tr", "table"})),
    "tr": (frozenset({"tr", "caption"}), frozenset({"table"})),
    "tbody": (frozenset({"tbody", "thead", "tfoot", "caption"}), frozenset({"table"})),
    "thead": (frozenset({"tbody", "thead", "tfoot", "caption"}), frozenset({"table"})),
    "tfoot": (frozenset({"tbody", "thead", "tfoot", "caption"}), frozenset({"table"})),
}
NO_TEXT = frozenset(
    "head script style template noscript textarea title xmp iframe noembed noframes object svg math canvas audio video map button select "
    "datalist input nav aside menu dialog".split()
)
NO_TEXT_ROLES = frozenset(
    "navigation banner contentinfo complementary search alert alertdialog dialog menu menubar toolbar status tooltip".split()
)

#: Words in class names and ids that mark what is not the article.
LABELS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising advertorial adsense adslot adbox banner banners "
    "sponsor sponsors sponsored promo promos promoted promotion promotions "
    "comment comments commentlist disqus respond reply replies responses reactions discussion feedback "
    "nav navbar navigation menu menus submenu breadcrumb breadcrumbs pagination pager topbar "
    "header masthead footer colophon copyright sidebar sidebars sidenav rail widget widgets related recommended recommendations trending "
    "share sharing social cookie cookies consent gdpr notice notices notification notifications "
    "newsletter subscribe subscription paywall signup login signin popup popups modal overlay toolbar".split()
)
#: With one of these a class name tells a state of the whole, as in "has-sidebar" or "comments-open".
STATES = frozenset("has with no without is open closed enabled disabled on off left right".split())
#: Words for the readers' part of a page.
COMMENTS = frozenset("comment comments commentlist disqus reply replies responses reactions discussion feedback".split())
#: The header of one of these is that of the article, not of the page.
OWN_HEADERS = frozenset("article post entry story content".split())
#: Headings of the readers' part of a page.
READERS = re.compile(
    r"(?:\d+\s+)?(?:(?:reader|user)\s+)?(?:comments?|responses?|replies|leave a (?:comment|reply)|kommentare?|commentaires?|comentarios?)"
    r"(?:\s*\(\d+\))?:?",
    re.I,
)

_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)"
    r"(?:(?P<attrs>(?:[\s/]++|[^\s/>=][^\s/>=]*+(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"'][^\s>]*+))?+|=)*+)>|(?P<broken>[^>]*+)>)"
    r"|<(?:[!?]|/(?!\Z))[^>]*+>",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s/>=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_WANTED = ("class", "id", "role", "hidden", "aria-hidden", "style", "itemprop")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_ZEROS = re.compile(r"&#0+(?=[0-9])")
_LONG_NUMBER = re.compile(r"&#[0-9]{8,};?")  # beyond all code points
_TAG_START = re.compile(r"<[a-zA-Z/!?]")
_MENUS = frozenset("ul ol table div dl".split())
_P = frozenset("p")


class Node(NamedTuple):
    name: str
    parent: int
    attrs: dict[str, str]


class Page(NamedTuple):
    nodes: list[Node]  # a parent comes before its children; the first two are html and body
    texts: list[tuple[int, int, str]]  # node, block and text, in page order


def _decoded(text: str) -> str:
    return html.unescape(_LONG_NUMBER.sub("\ufffd", _ZEROS.sub("&#", text))) if "&" in text else text


def _attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(text) if text else ():
        if (key := name.lower()) in _WANTED and key not in found:
            found[key] = _decoded(values[0] or values[1] or values[2])
    return found


class _Builder:
    """Nodes and texts from tags; missing and crossed end tags are mended as browsers do where it matters for text."""

    def __init__(self) -> None:
        self.nodes = [Node("html", -1, {}), Node("body", 0, {})]
        self.texts: list[tuple[int, int, str]] = []
        self.stack = [0, 1]
        self.open: dict[str, int] = {}
        self.flat: dict[str, int] = {}  # start tags beyond the depth, whose end tags close nothing
        self.block = 0

    def text(self, text: str) -> None:
        if text:
            self.texts.append((self.stack[-1], self.block, _decoded(text)))

    def leave(self, depth: int) -> None:
        for node in self.stack[depth:]:
            self.open[self.nodes[node].name] -= 1
        del self.stack[depth:]

    def innermost(self, names: frozenset[str], walls: frozenset[str]) -> int:
        """Depth of the innermost open element of these names that no wall hides, or 0."""
        if any(self.open.get(name) for name in names):
            for depth in range(len(self.stack) - 1, 1, -1):
                name = self.nodes[self.stack[depth]].name
                if name in names:
                    return depth
                if name in walls:
                    return 0
        return 0

    def start(self, name: str, attrs: dict[str, str]) -> None:
        if name in ("html", "body"):
            self.nodes[name == "body"].attrs.update(attrs)
            return
        if name in ("head", "frameset"):
            return
        ended = ((_P, WALLS),) if name in BLOCKS else ()
        ended += ((ENDS[name],) if name in ENDS else ()) + (((HEADINGS, BLOCKS - HEADINGS),) if name in HEADINGS else ())
        for names, walls in ended:
            if depth := self.innermost(names, walls):
                self.leave(depth)
        self.block += name in BLOCKS
        if name == "br" or name in CELLS:
            self.text(" ")
        if name in VOID:
            return
        self.nodes.append(Node(name, self.stack[-1], attrs))
        if name in RAW:
            return
        if len(self.stack) < DEPTH:
            self.stack.append(len(self.nodes) - 1)
            self.open[name] = self.open.get(name, 0) + 1
        else:
            self.flat[name] = self.flat.get(name, 0) + 1

    def end(self, name: str) -> None:
        if self.flat.get(name):
            self.flat[name] -= 1
        elif name not in ("html", "body"):
            names = HEADINGS if name in HEADINGS else frozenset((name,))
            if depth := self.innermost(names, WALLS | BLOCKS if name in INLINE else WALLS):
                self.leave(depth)
        self.block += name in BLOCKS
        if name in CELLS:
            self.text(" ")


def parse(source: str) -> Page:
    """The elements and texts of a page. What follows a script, title or comment that never ends belongs to it."""
    page = _Builder()
    at, last = 0, source.rfind(">") + 1
    while match := _TOKEN.search(source, at, last):
        page.text(source[at : match.start()])
        at, name = match.end(), (match["name"] or "").lower()
        if match["close"]:
            page.end(name)
        elif name:
            page.start(name, _attributes(match["attrs"] or match["broken"] or ""))
            if name in RAW:
                found = re.compile(rf"</{name}(?=[\s/>])", re.I).search(source, at, last)
                if not found or name == "plaintext":
                    return Page(page.nodes, page.texts)
                at = source.index(">", found.end()) + 1
        elif match[0].startswith("<!--") and not match[0].endswith(("-->", "--!>", "<!-->")):
            return Page(page.nodes, page.texts)
    rest = source[at:]
    cut = _TAG_START.search(rest)  # a tag that never ends
    page.text(rest[: cut.start()] if cut else rest)
    return Page(page.nodes, page.texts)


def _names(attrs: dict[str, str]) -> Iterator[set[str]]:
    """The words of each class name and of the id."""
    for name in f"{attrs.get('class', '')} {attrs.get('id', '')}".split():
        yield {word.lower() for word in _WORD.findall(name)}


def _label(attrs: dict[str, str]) -> str:
    """What the class names and the id say: "cut" for boilerplate, "header" for an article's own header, or nothing."""
    said = ""
    for words in _names(attrs):
        if (found := words & LABELS) and not words & STATES:
            if found == {"header"} and words & OWN_HEADERS:
                said = said or "header"
            else:
                return "cut"
    return said


def _articles(page: Page, readers: list[bool]) -> list[bool]:
    """For each node whether it is an explicit article; those of readers, by their own label or that of an element around them, are not."""
    nodes = page.nodes
    found, theirs = [False] * len(nodes), list(readers)
    for i in range(2, len(nodes)):
        node, attrs = nodes[i], nodes[i].attrs
        theirs[i] |= theirs[node.parent] or any(words & COMMENTS and not words & STATES for words in _names(attrs))
        named = node.name in ("article", "main") or attrs.get("role") in ("main", "article") or attrs.get("itemprop") == "articleBody"
        found[i] = named and not theirs[i]
    return found


class Sizes(NamedTuple):
    """For every node: characters without white space, those of link text, tags and link tags below it, and whether it holds a p, a main heading
    and how many articles."""

    chars: list[int]
    link_chars: list[int]
    tags: list[int]
    link_tags: list[int]
    paragraphs: list[int]
    titles: list[int]
    articles: list[int]


def sizes(page: Page, silent: list[bool], articles: list[bool]) -> Sizes:
    """Counts without the silent nodes."""
    nodes, n = page.nodes, len(page.nodes)
    out = Sizes(*([0] * n for _ in Sizes._fields))
    link = [False] * n
    for i in range(1, n):
        link[i] = link[nodes[i].parent] or nodes[i].name == "a"
    for node, _, text in page.texts:
        if not silent[node]:
            size = sum(map(len, text.split()))
            out.chars[node] += size
            out.link_chars[node] += size * link[node]
    for i in range(n - 1, 0, -1):
        node, up = nodes[i], nodes[i].parent
        if out.chars[i]:
            out.paragraphs[i] += node.name == "p"
            out.titles[i] += node.name == "h1"
            out.articles[i] += articles[i]
        for counts in out:
            counts[up] += counts[i]
        if not silent[i]:
            out.tags[up] += 1
            out.link_tags[up] += node.name == "a"
    return out


def boilerplate(page: Page) -> tuple[list[bool], list[bool], list[bool]]:
    """For each node whether it is cut off with all below it, whether its own text is left out, and whether it is an explicit article."""
    nodes, n = page.nodes, len(page.nodes)
    readers = _readers(page)
    article = _articles(page, readers)
    size = sizes(page, [False] * n, article)
    cut, header, inside, quoted, titled = ([False] * n for _ in range(5))
    own_text = [False] * n  # of articles: paragraphs outside of the articles in them
    nearest = [0] * n
    for i in range(1, n):
        nearest[i] = i if article[i] else nearest[nodes[i].parent]
        own_text[nearest[i]] |= nodes[i].name == "p"
    for i in range(2, n):
        node, up = nodes[i], nodes[i].parent
        name, attrs, role = node.name, node.attrs, node.attrs.get("role")
        inside[i] = inside[up] or article[i]
        quoted[i] = quoted[up] or name == "blockquote"
        titled[i] = titled[up] or name in HEADINGS
        header[i] = header[up]
        label = _label(attrs)
        # An element that holds every article there is, or a title and most of the text, is no boilerplate whatever its label says.
        whole = size.articles[i] and size.articles[i] == size.articles[1] and name != "footer"
        whole = whole or (size.titles[i] and not size.articles[1] and 2 * size.chars[i] > size.chars[1])
        if cut[up] or (name in NO_TEXT and (name != "menu" or not inside[i])):
            cut[i] = True
        elif "hidden" in attrs or attrs.get("aria-hidden") == "true" or _HIDDEN.search(attrs.get("style", "")):
            cut[i] = True
        elif article[i]:
            cut[i] = name == "article" and nearest[up] > 0 and nodes[nearest[up]].name == "article" and own_text[nearest[up]]
        elif name == "article" or name == "main":
            cut[i] = True  # a reader's comment
        elif whole:
            pass
        elif name == "footer":
            cut[i] = not quoted[i]
        elif name == "form":
            cut[i] = not (size.paragraphs[i] and 2 * size.chars[i] > size.chars[1])
        elif name == "header" or role == "banner" or label == "header":
            header[i] = inside[i] or label == "header"
            cut[i] = not header[i]
        else:
            cut[i] = role in NO_TEXT_ROLES or label == "cut" or readers[i]
    return cut, [cut[i] or (header[i] and not titled[i]) for i in range(n)], article


def _readers(page: Page) -> list[bool]:
    """For each node whether it is a section whose first heading announces the readers' comments."""
    nodes = page.nodes
    heads: dict[int, list[str]] = {}
    for node, _, text in page.texts:
        while nodes[node].name in INLINE:
            node = nodes[node].parent
        if nodes[node].name in HEADINGS:
            heads.setdefault(node, []).append(text)
    found, seen = [False] * len(nodes), set()
    for node, parts in heads.items():
        up = nodes[node].parent
        if up not in seen and nodes[up].name in ("section", "div"):
            found[up] = READERS.fullmatch(" ".join("".join(parts).split())) is not None
        seen.add(up)
    return found


def densities(page: Page, cut: list[bool], size: Sizes) -> tuple[list[float], list[float]]:
    """Composite text density of every node, and the sum of its children's densities (of a leaf: its own)."""
    nodes, n = page.nodes, len(page.nodes)
    share = size.link_chars[1] / max(1, size.chars[1])
    density, sums, leaf = [0.0] * n, [0.0] * n, [True] * n
    for i in range(1, n):
        c, t = size.chars[i], max(1, size.tags[i])
        if c and not cut[i]:
            linked, plain = max(1, size.link_chars[i]), max(1, c - size.link_chars[i])
            base = math.log(c / plain * linked + share * c + math.e)
            density[i] = c / t * math.log(max(1.0, c / linked * t / max(1, size.link_tags[i]))) / math.log(base)
    for i in range(1, n):
        if not cut[i]:
            sums[nodes[i].parent] += density[i]
            leaf[nodes[i].parent] = False
    return density, [density[i] if leaf[i] else sums[i] for i in range(n)]


def article_nodes(page: Page, cut: list[bool], size: Sizes, explicit: list[bool]) -> list[bool]:
    """For each node whether it belongs to the article."""
    nodes, n = page.nodes, len(page.nodes)
    density, sums = densities(page, cut, size)
    best = list(range(n))  # of each subtree, the node of the largest sum; of equal ones the outermost, then the first
    for i in range(n - 1, 1, -1):
        up = nodes[i].parent
        if not cut[i] and (sums[best[i]] > sums[best[up]] or (sums[best[i]] == sums[best[up]] and best[up] != up)):
            best[up] = best[i]
    core = best[1]
    path = [core]
    while path[-1] != 1:
        path.append(nodes[path[-1]].parent)
    threshold = min(density[i] for i in path)
    chosen = [False] * n
    article = next((i for i in path if explicit[i]), 0)
    if article:
        root = article
    else:
        root = _whole(page, cut, size, path)
        reached = [i == 1 for i in range(n)]
        for i in range(1, n):
            reached[i] = reached[i] or (reached[nodes[i].parent] and not cut[i] and 0 < density[i] >= threshold)
            if reached[i]:
                chosen[best[i]] = True
    chosen[root] = True
    if not size.titles[root]:
        above = set(path[path.index(root) + 1 :])
        for i in range(2, root):  # the title stands before the article, in an element around it
            chosen[i] |= nodes[i].name == "h1" and nodes[i].parent in above
    for i in range(1, n):
        linked = nodes[i].name in _MENUS and size.link_tags[i] >= 3 and 10 * size.link_chars[i] >= 9 * size.chars[i]
        chosen[i] = (chosen[i] or chosen[nodes[i].parent]) and not cut[i] and (article > 0 or not linked)
    return chosen


def _whole(page: Page, cut: list[bool], size: Sizes, path: list[int]) -> int:
    """The core, or the element around it that is split into parts of which the core is one: parts with paragraphs, a fifth of its size or more."""
    nodes, at = page.nodes, 0
    parts: dict[int, list[int]] = {}
    for i in range(2, len(nodes)):
        if not cut[i] and size.paragraphs[i]:
            parts.setdefault(nodes[i].parent, []).append(i)
    while at + 2 < len(path) and any(
        i != path[at] and 5 * (size.chars[i] - size.link_chars[i]) >= size.chars[path[at]] for i in parts.get(path[at + 1], ())
    ):
        at += 1
    return path[at]


def main_text(source: str | None) -> str:
    """The article of a page: its blocks, white space turned into one space, joined by an empty line."""
    page = parse(source or "")
    cut, silent, explicit = boilerplate(page)
    size = sizes(page, silent, explicit)
    if not size.chars[1]:
        return ""
    chosen = article_nodes(page, cut, size, explicit)
    blocks: dict[int, list[str]] = {}
    for node, block, text in page.texts:
        if chosen[node] and not silent[node]:
            blocks.setdefault(block, []).append(text)
    found = (" ".join("".join(parts).split()) for parts in blocks.values())
    return "\n\n".join(text for text in found if text)


def with_main_text(pages: DataFrame, html_col: str = "html", drop: tuple[str, ...] = ()) -> DataFrame:
    """``pages`` with ``text`` and ``n_chars`` (code points) of the article of each page.

    A null or empty page, or one without any article, has the empty text and 0. Pages may have any length; a task holds one page's tree at a
    time. Repeated rows stay repeated, an empty table gives an empty result, null values of other columns are kept, and
    columns of ``pages`` named ``text`` or ``n_chars`` are replaced. Of equal subtrees the outermost, then the first, is the core.
    """

    def compute(batch: pa.RecordBatch) -> dict[str, object]:
        pages = batch.column(batch.schema.get_field_index(html_col))
        texts = [main_text(page.as_py()) for page in pages]
        return {"text": pa.array(texts, pa.string()), "n_chars": pa.array(map(len, texts), pa.int64())}

    return add_columns(pages, compute, "text string, n_chars long", drop=drop)
