"""Main text of web pages by wrapper induction.

Pages of one host share a layout. For each host the page whose length is nearest to the mean is the *reference*; the
trees of block elements of all its other pages are aligned with it by simple tree matching (the largest set of node
pairs that keeps labels, order and ancestry). A text of the reference that never differs and that half of the host's
different pages have is *template*; any other is a *slot*. Copies of a page, by the digest of its html, count as one, so
a group of them is no evidence of a template. Text of nodes that nothing matches counts as varying
for the nearest matched ancestor. The *core* is the deepest node that holds most of the varying text. Inside an
``article`` or ``main``, the outermost of these is the host's content node; elsewhere it is the lowest node that holds
all varying text. A page's main text is what lies below the node aligned with it, except the parts whose tag, role or
class says menu, header, footer, sidebar, notice, advert, form or reader comment. Where most of the varying text lies in
several articles, only these are taken. Template text outside ``article`` and ``main`` is left out too, unless nothing
would remain.

Classes and ids count as whole names, or as pairs of what is held and a container; ids only of plain containers, for
those of headings and sections are made of their words, and of sections where the id names a container. No mark reaches a ``main`` below it, nor an ``article``, unless another article or main of the page has
text: then articles in a sidebar go with it. Those among readers' comments always do. A form that holds half of the page's text is layout.
Where nothing but marked text is left, names and forms stop counting, and if need be all marks.

Where no wrapper can be learned (one page, nothing varies, or the content node has no partner in the page), the page's
own ``article`` or ``main`` elements are taken, or else its body.

Statistics are sums, least and greatest hashes per host and node, so a host with a large part of all pages is counted
in every task; wrappers are broadcast while they are small, and beyond that only those of large hosts are.

Results in odd cases: a null or empty html gives an empty text; a null url belongs to the host without a name; markup
that is never closed is closed where HTML closes it or at the end; a tag that never ends takes the rest of the page;
blocks nested deeper than 256 are one; time grows with the length of the page, however broken it is; rows may repeat; an empty table gives no rows; other
columns are ignored, so their names cannot clash.
"""

from __future__ import annotations

import html as markup
import re
from collections.abc import Callable, Iterable, Iterator
from uuid import uuid4

import pandas as pd
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cloakframe.llm.common import stored
from cloakframe.llm.files import kept
from cloakframe.operators.hot_keys import left_lookup

# Element names by what they mean to a reader of HTML.
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
BLOCK = frozenset(
    "html head body article section main div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th "
    "caption pre blockquote figure figcaption address header footer nav aside form fieldset details summary hr hgroup "
    "menu dialog search center".split()
)
CLOSES_P = BLOCK - frozenset("td th tr thead tbody tfoot caption".split())
SIBLINGS = {  # a start tag ends an open element of these names
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "body": {"head"},
}
SCOPES = frozenset("ul ol table dl body html article section div main".split())
CHROME_TAGS = frozenset("nav header footer aside form menu dialog search button select head".split())
CHROME_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar".split())
CHROME_WORDS = frozenset(
    "ad ads advert adverts advertisement sponsor sponsored promo sidebar nav navbar navigation menu breadcrumb breadcrumbs "
    "footer masthead cookie cookies consent notice popup modal newsletter subscribe share sharing social related comment "
    "comments disqus replies respond pagination pager widget toolbar skip site-header page-header".split()
)
# A name of two parts is chrome if it is made of what an element holds and a word for a container, or of a word for a
# place and what it holds: comment-thread, commentlist, post-comments. Other parts of names say nothing.
_HOLDS = (
    "ad ads advert sponsor promo sidebar side nav navigation menu breadcrumb breadcrumbs footer cookie cookies consent popup "
    "modal newsletter subscribe share social related comment comments disqus reply replies pagination widget skip banner".split()
)
_CONTAINERS = (
    "list area section thread threads block box bar banner container wrapper wrap holder form group item items body inner "
    "content links link buttons button panel notice policy overlay slot unit nav menu posts articles media icons signup "
    "ad left right top bottom feed".split()
)
_PLACES = "site page main post article entry story blog user reader left right top bottom social fb facebook global sticky".split()
_PLACED = "nav navigation menu sidebar footer comment comments ads ad share related replies cookie newsletter banner".split()
CHROME_PAIRS = frozenset(f"{x}{dash}{y}" for x in _HOLDS for y in _CONTAINERS for dash in ("-", "")[: 2 - (len(x) < 4 or y == "holder")]) | frozenset(
    f"{x}-{y}" for x in _PLACES for y in _PLACED
)
# Ids of headings and the like are the slugs of their texts. That of a section is one unless it names a container.
ID_TAGS = frozenset("div ul ol dl table center".split())
SECTION_IDS = CHROME_PAIRS | {"comment", "comments", "disqus", "replies", "respond"}
CONTENT_TAGS = frozenset({"article", "main"})
NEVER_CHROME = CONTENT_TAGS | {"html", "body"}

TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
# A whole tag whose quotes are closed; all others are read by hand.
PLAIN_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"'=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\"'\s>]))*+)>")
TAG_STOP = re.compile(r">|=\s*([\"'])")
ATTRIBUTE = re.compile(r"([^\s=\"'>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?")
TALK = re.compile("comment|disqus|repl(?:y|ies)", re.I)
CASES = re.compile("(?<=[a-z0-9])(?=[A-Z])")
HIDING = frozenset("button select object canvas svg video audio".split())
DEEPEST = 256  # blocks inside so many others are not told apart from the one around them
HOLDS_MOST = 0.8
MIN_PAGES, MIN_SHARE = 3, 0.5  # of different pages
WHOLE_PAGE, WHOLE_CHAR = 1 << 32, 1 << 20  # what a page and a character weigh; a page's copies share it
SMALL_BYTES = 32 << 20
COPIES_SHIPPED = 100_000


class Node:
    __slots__ = ("tag", "label", "chrome", "named", "talk", "within", "depth", "children", "runs", "order", "parent", "shape", "size", "end")

    def __init__(self, tag: str, label: str, chrome: bool, parent: Node | None, named: bool = False, talk: bool = False):
        self.tag, self.label, self.chrome, self.parent = tag, label, chrome, parent
        self.named = named  # whether only its class or id says that it is chrome
        self.talk = talk  # whether that is because it holds readers' comments
        self.within = parent is not None and (parent.within or parent.tag in CONTENT_TAGS)  # article or main
        self.depth = parent.depth + 1 if parent is not None else 0
        self.children: list[Node] = []
        self.runs: list[str] = []  # texts between child elements
        self.order: list = []  # runs and children as they come


def names_chrome(token: str) -> bool:
    """Whether a class says that its element is no content; of ``block__element--variant`` the element decides."""
    plain = CASES.sub("-", token).lower().split("--")[0]
    for part in {plain, plain.rsplit("__", 1)[-1]}:
        part = part.strip("_-").replace("__", "-").replace("_", "-")
        if part in CHROME_WORDS or part in CHROME_PAIRS:
            return True
    return False


def _judged(tag: str, attributes: str, inside: bool) -> tuple[str, bool, bool, bool]:
    """(label, chrome, named, talk) of an element, which stands in an article or main or not."""
    label, chrome, named = tag, tag in CHROME_TAGS, False
    if tag == "header":
        chrome = not inside  # the header of an article is its headline
    if "=" not in attributes:
        return label, chrome, False, False
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), next((v for v in values if v), "")
        if name == "role":
            chrome = chrome or value.lower() in CHROME_ROLES
        elif name == "class":
            named = named or any(map(names_chrome, value.split()))
            label += f".{value.lower()}"
        elif name == "id" and tag in ID_TAGS:
            named = named or names_chrome(value.strip())
        elif name == "id" and tag == "section":
            named = named or CASES.sub("-", value.strip()).lower().replace("_", "-") in SECTION_IDS
    talk = named and TALK.search(attributes) is not None
    named = named and not chrome and (tag not in NEVER_CHROME or tag == "article" and (inside or talk))
    return label, chrome or named, named, named and talk


def _node(tag: str, attributes: str, parent: Node) -> Node:
    key = tag, attributes, parent.within or parent.tag in CONTENT_TAGS
    if len(attributes) > 200:
        judged = _judged(*key)
    else:
        known = kept().setdefault("elements", {})
        judged = known.get(key)
        if judged is None:
            if len(known) >= 20_000:
                known.clear()
            judged = known[key] = _judged(*key)
    label, chrome, named, talk = judged
    return Node(tag, label, chrome, parent, named, talk)


def _tag_end(text: str, at: int) -> int:
    """Where the tag that is open at a place ends; a quote after an equals sign hides what it holds, if it is closed."""
    while True:
        stop = TAG_STOP.search(text, at)
        if stop is None:
            return len(text)
        if stop[1] is None:
            return stop.end()
        close = text.find(stop[1], stop.end())
        if close < 0:
            return text.find(">", stop.end()) + 1 or len(text)
        at = close + 1


def _hidden_end(text: str, at: int, tag: str) -> int:
    """Where an element ends whose content is no text; other than raw text, it may hold elements of its own name."""
    depth = 1
    for found in re.compile(rf"<(/?){tag}(?![^\s/>])[^>]*>?", re.I).finditer(text, at):
        if found[1] or tag not in RAW:
            depth += -1 if found[1] else int(not found[0].endswith("/>"))
        if not depth:
            return found.end()
    return len(text)


def parse(text: str) -> Node:
    """The tree of block elements; inline elements only contribute their text. One pass: no place is looked at again
    however the markup is broken."""
    root = Node("", "", False, None)
    here, piece, at, size = root, [], 0, len(text)
    opened: dict[str, int] = {}  # open elements by name
    flat: dict[str, int] = {}  # those of them that are too deep to be nodes

    def flush() -> None:
        if not piece:
            return
        run = " ".join("".join(piece).split())
        piece.clear()
        if run:
            here.runs.append(run)
            here.order.append(run)

    def close_to(node: Node) -> None:
        nonlocal here
        while here is not node:
            opened[here.tag] -= 1
            here = here.parent

    while at < size:
        place = text.find("<", at)
        if place < 0:
            piece.append(markup.unescape(text[at:]))
            break
        if place > at:
            said = text[at:place]
            piece.append(markup.unescape(said) if "&" in said else said)
        found = PLAIN_TAG.match(text, place)
        if found is not None:
            close, tag, attributes = found.groups()
            at = found.end()
        elif text.startswith("<!--", place):
            at = text.find("-->", place + 4) + 3
            at = size if at < 3 else at
            continue
        elif text.startswith(("<!", "<?"), place):
            at = text.find(">", place) + 1 or size
            continue
        else:
            found = TAG.match(text, place)
            if found is None:
                piece.append("<")
                at = place + 1
                continue
            at = _tag_end(text, found.end())
            close, tag = found.groups()
            attributes = text[found.end() : at - 1]
        tag = tag.lower()
        if close:
            if tag not in BLOCK:
                continue
            flush()
            if flat.get(tag):
                flat[tag] -= 1
            elif opened.get(tag):
                up = here
                while up.tag != tag:
                    up = up.parent
                close_to(up.parent)
            continue
        if tag in RAW or tag in HIDING and not attributes.endswith("/"):
            at = _hidden_end(text, at, tag)
        elif tag == "br":
            piece.append(" ")
        elif tag in BLOCK:
            flush()
            ends = SIBLINGS.get(tag, ())
            if any(opened.get(e) for e in ends) or opened.get("p") and tag in CLOSES_P:
                up = here
                while up is not root and up.tag not in SCOPES and up.tag not in ends and not (up.tag == "p" and tag in CLOSES_P):
                    up = up.parent
                if up is not root and (up.tag in ends or up.tag == "p" and tag in CLOSES_P):
                    close_to(up.parent)
                    while here is not root and here.tag in ends:
                        close_to(here.parent)
            if tag == "hr":
                continue
            if here.depth >= DEEPEST:
                flat[tag] = flat.get(tag, 0) + 1
                continue
            node = _node(tag, attributes, here)
            here.children.append(node)
            here.order.append(node)
            here = node
            opened[tag] = opened.get(tag, 0) + 1
    flush()
    return root


def number(root: Node, shapes: dict) -> list[Node]:
    """The nodes in document order, each with the number of its subtree's shape, its size and its end in the list."""
    listed: list[Node] = []
    stack: list[tuple[Node, bool]] = [(root, False)]
    while stack:
        node, done = stack.pop()
        if done:
            key = (node.label, *(c.shape for c in node.children))
            node.shape = shapes.setdefault(key, len(shapes))
            node.size = 1 + sum(c.size for c in node.children)
            node.end = len(listed)
        else:
            listed.append(node)
            stack.append((node, True))
            stack.extend((c, False) for c in reversed(node.children))
    return listed


class Matcher:
    """Simple tree matching against one reference; weights are remembered by shape."""

    def __init__(self, reference: str):
        self.shapes: dict = {}
        self.root = parse(reference)
        self.nodes = number(self.root, self.shapes)
        self.place = {id(n): i for i, n in enumerate(self.nodes)}
        self.weights: dict[tuple[int, int], int] = {}
        self.wrapper = None

    def weight(self, a: Node, b: Node) -> int:
        """The size of the largest matching of two subtrees."""
        if a.label != b.label:
            return 0
        if a.shape == b.shape:
            return a.size
        key = (a.shape, b.shape)
        known = self.weights.get(key)
        if known is None:
            pairs, table = self._children(a.children, b.children)
            known = self.weights[key] = 1 + sum(x.size for x, _ in pairs) + (table[-1][-1] if table else 0)
        return known

    def _children(self, x: list[Node], y: list[Node]):
        """Pairs of equal shape at both ends, which some largest matching always has, and the table of the rest."""
        low, n, m = 0, len(x), len(y)
        while low < n and low < m and x[low].shape == y[low].shape:
            low += 1
        pairs = list(zip(x[:low], y[:low], strict=True))
        while n > low and m > low and x[n - 1].shape == y[m - 1].shape:
            n, m = n - 1, m - 1
            pairs.append((x[n], y[m]))
        if n == low or m == low:
            return pairs, None
        table = [[0] * (m - low + 1)]
        for a in x[low:n]:
            row, above = [0], table[-1]
            for j, b in enumerate(y[low:m]):
                row.append(max(row[j], above[j + 1], above[j] + self.weight(a, b)))
            table.append(row)
        return pairs, table

    def align(self, root: Node) -> dict[int, int]:
        """The reference's node number for each matched node (by ``id``) of a numbered tree."""
        matched: dict[int, int] = {}
        todo = [(root, self.root)]
        while todo:
            a, b = todo.pop()
            if a.shape == b.shape:
                pairs = [(a, b)]
                while pairs:
                    p, q = pairs.pop()
                    matched[id(p)] = self.place[id(q)]
                    pairs.extend(zip(p.children, q.children, strict=True))
                continue
            matched[id(a)] = self.place[id(b)]
            pairs, table = self._children(a.children, b.children)
            todo.extend(pairs)
            if table:
                x, y = self._rest_of(a.children, b.children)
                i, j = len(x), len(y)
                while i and j:
                    if table[i][j] == table[i - 1][j]:
                        i -= 1
                    elif table[i][j] == table[i][j - 1]:
                        j -= 1
                    else:
                        i, j = i - 1, j - 1
                        todo.append((x[i], y[j]))
        return matched

    @staticmethod
    def _rest_of(x: list[Node], y: list[Node]) -> tuple[list[Node], list[Node]]:
        low, n, m = 0, len(x), len(y)
        while low < n and low < m and x[low].shape == y[low].shape:
            low += 1
        while n > low and m > low and x[n - 1].shape == y[m - 1].shape:
            n, m = n - 1, m - 1
        return x[low:n], y[low:m]

    def page(self, text: str) -> tuple[Node, dict[int, int]]:
        root = parse(text)
        if len(self.shapes) > 200_000:  # forget the shapes of pages gone by
            self.shapes.clear()
            self.weights.clear()
            number(self.root, self.shapes)
        number(root, self.shapes)
        return root, self.align(root)


def _marked(root: Node) -> Iterator[tuple[Node, int, str, bool, bool, bool]]:
    """(node, number of the run in it, text, inside chrome, the same without names and forms, the same if articles
    are never reached) in page order."""
    sizes: dict[int, int] = {}  # characters of the forms and of the whole page
    if any(x.tag == "form" for x in _nodes(root)):
        _size(root, sizes)
    half = sizes.get(id(root), 0) / 2

    stack: list = [(root, (False, False, False, False, False), iter(root.order), [0])]
    while stack:
        node, marks, rest, count = stack[-1]
        for part in rest:
            if isinstance(part, str):
                yield node, count[0], part, *marks[:3]
                count[0] += 1
                continue
            chrome, strong, free, hidden, talk = marks
            if part.tag == "main":
                chrome = strong = free = hidden = talk = False
            elif part.tag == "article":
                # A form around an article never hides it; what else does, only if the page has another.
                chrome, strong, free = hidden, strong and hidden, talk
            if part.chrome:
                form = part.tag == "form"
                if not (form and sizes[id(part)] >= half):
                    chrome = free = True
                    strong = strong or not (form or part.named)
                    hidden = hidden or not form
                    talk = talk or part.talk
            stack.append((part, (chrome, strong, free, hidden, talk), iter(part.order), [0]))
            break
        else:
            stack.pop()


def _nodes(root: Node) -> Iterator[Node]:
    stack = [root]
    while stack:
        node = stack.pop()
        yield node
        stack.extend(node.children)


def _size(root: Node, sizes: dict[int, int]) -> None:
    """Characters of text below each node."""
    order = list(_nodes(root))
    for node in reversed(order):  # children before parents
        sizes[id(node)] = sum(map(len, node.runs)) + sum(sizes[id(c)] for c in node.children)


def runs(root: Node) -> list[tuple[Node, int, str, bool]]:
    """(node, number of the run in it, text, inside chrome) in page order."""
    found = list(_marked(root))

    def in_content(node: Node) -> bool:
        return node.within or node.tag in CONTENT_TAGS

    # Articles below a mark are content if no other article or main has text.
    if any(x[3] and not x[5] for x in found) and not any(not x[3] and in_content(x[0]) for x in found):
        return [(*x[:3], x[5]) for x in found]
    for mark in (3, 4):
        if not all(x[mark] for x in found):
            return [(*x[:3], x[mark]) for x in found]
    return [(*x[:3], False) for x in found]


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "replace")) - (1 << 63)


def observe(matcher: Matcher, text: str) -> list[tuple[int, int, int, int]]:
    """(reference node, run, hash, characters) of the texts of one page that are outside chrome; run -1 says that
    the node holding the text has no partner."""
    root, matched = matcher.page(text)
    out = []
    for node, run, said, chrome in runs(root):
        if not chrome:
            place = matched.get(id(node))
            if place is None:
                up = node
                while id(up) not in matched:
                    up = up.parent
                out.append((matched[id(up)], -1, _hash(said), len(said)))
            else:
                out.append((place, run, _hash(said), len(said)))
    return out


def induce(matcher: Matcher, stats: list, different: int = 0) -> tuple[int | None, set[tuple[int, int]], bool]:
    """The content node, the (node, run) of template texts, and whether only articles below the content node count,
    from rows (node, run, pages, least, greatest, chars) and the number of the host's different pages."""
    template, varying = set(), [0] * (len(matcher.nodes) + 1)
    for place, run, pages, least, greatest, chars in stats:
        if run >= 0 and least == greatest and pages >= MIN_SHARE * different:
            if pages >= MIN_PAGES:
                template.add((place, run))
        else:
            varying[place] += chars
    total = sum(varying)
    if not total:
        return None, template, False
    sums = [0]
    for v in varying:
        sums.append(sums[-1] + v)

    def deepest(least: float) -> Node:
        best = 0
        for i, node in enumerate(matcher.nodes):  # later nodes that hold enough lie deeper
            if sums[node.end] - sums[i] >= least:
                best = i
        return matcher.nodes[best]

    up, around = deepest(HOLDS_MOST * total), None
    while up is not None:
        around = up if up.tag in CONTENT_TAGS else around
        up = up.parent
    if around is not None:
        return matcher.place[id(around)], template, False
    # Single blocks are parts of the content; it is the element around them.
    node = deepest(total)
    while node.parent is not None and node.tag in ("p", "h1", "h2", "h3", "li", "blockquote", "pre"):
        node = node.parent
    inside, end = 0, 0
    for i, x in enumerate(matcher.nodes):
        if i >= end and x.tag in CONTENT_TAGS:
            inside, end = inside + sums[x.end] - sums[i], x.end
    return matcher.place[id(node)], template, inside >= HOLDS_MOST * total


def main_text(matcher: Matcher, text: str) -> str:
    content, template, articles = matcher.wrapper[1]
    root, matched = matcher.page(text)
    tops: set[int] = {k for k, place in matched.items() if place == content} if content is not None else set()
    own: dict[int, tuple[bool, bool]] = {}  # below the content node, inside article or main

    def state(node: Node | None) -> tuple[bool, bool]:
        path = []
        while node is not None and id(node) not in own:
            path.append(node)
            node = node.parent
        below, inside = own[id(node)] if node is not None else (False, False)
        for x in reversed(path):
            below, inside = below or id(x) in tops, inside or x.tag in CONTENT_TAGS
            own[id(x)] = below, inside
        return below, inside

    listed = [(*state(n), (matched.get(id(n)), r) in template, said) for n, r, said, chrome in runs(root) if not chrome]
    marked = [x for x in listed if x[1]]
    if tops and any(x[0] for x in listed):
        held = [x for x in listed if x[0]]
        # A content node around articles keeps to them.
        held = [x for x in held if x[1]] or held if articles else held
    else:
        held = marked or listed
    plain = [x for x in held if x[1] or not x[2]] or held
    return "\n\n".join(x[3] for x in plain)


def _matcher(reference: str | None) -> Matcher:
    """The matcher of a reference, remembered between batches and tasks."""
    held = kept().setdefault("wrappers", {})
    key = xxhash.xxh64_intdigest((reference or "").encode("utf-8", "replace"))
    if key not in held:
        if len(held) >= 200:
            held.clear()
        held[key] = Matcher(reference or "")
    return held[key]


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]*)", 1))


def references(pages: DataFrame) -> DataFrame:
    """(host, reference): per host the page whose length is nearest to the mean, then the least id and text."""
    sizes = pages.select("host", "page_id", F.length("html").cast("long").alias("n")).where("n > 0")
    mean = sizes.groupBy("host").agg((F.sum("n") / F.count("*")).cast("long").alias("mean"))
    near = sizes.join(_broadcast_if_small(mean), "host").withColumn("away", F.abs(F.col("n") - F.col("mean")))
    best = near.groupBy("host").agg(F.min(F.struct("away", "page_id", "n")).alias("b")).select("host", "b.page_id", "b.n")
    rows = pages.withColumn("n", F.length("html").cast("long"))
    found = rows.join(
        _broadcast_if_small(best.select(F.col("host").alias("h"), F.col("page_id").alias("p"), F.col("n").alias("m"))),
        (F.col("host") == F.col("h")) & F.col("page_id").eqNullSafe(F.col("p")) & (F.col("n") == F.col("m")),
    )
    return found.groupBy("host").agg(F.min("html").alias("reference"))


def _broadcast_if_small(df: DataFrame, rows: int = 100_000) -> DataFrame:
    return F.broadcast(df) if df.count() <= rows else df


def _by_host(spark: SparkSession, lookup: DataFrame, size: Column) -> Broadcast | None:
    """host -> the other columns of its row, as one value for all tasks of a worker, if all rows are small."""
    if (lookup.agg(F.sum(size)).first()[0] or 0) > SMALL_BYTES:
        return None
    return spark.sparkContext.broadcast({r[0]: tuple(r[1:]) for r in lookup.collect()})


def copies(pages: DataFrame) -> DataFrame:
    """(host, digest, copies) of the pages with text."""
    return pages.where("html <> ''").select("host", _digest().alias("digest")).groupBy("host", "digest").agg(F.count("*").alias("copies"))


def _digest() -> Column:
    return F.md5(F.concat("host", F.lit("\n"), "html"))


def _with_copies(pages: DataFrame, counts: DataFrame) -> DataFrame:
    """Pages with the number of their copies; only pages that have some are looked up."""
    repeated = counts.where("copies > 1").select("digest", "copies")
    keyed = pages.withColumn("digest", _digest())
    if repeated.count() <= COPIES_SHIPPED:
        found = keyed.join(F.broadcast(repeated), "digest", "left")
    else:
        found = left_lookup(keyed, repeated, "digest", "digest")
    return found.drop("digest").withColumn("copies", F.coalesce("copies", F.lit(1)))


def wrappers(pages: DataFrame) -> DataFrame:
    """(host, reference, stats, different) for pages (page_id, url, html, host)."""
    chosen = stored(references(pages), "references")
    counts = stored(copies(pages), "copies")

    shape = "array<struct<node:int,run:int,hash:long,chars:long>>"

    def seen_in(texts: pd.Series, chosen: Iterable[str | None]) -> pd.Series:
        out = []
        for text, reference in zip(texts, chosen, strict=True):
            found = observe(_matcher(reference), text or "") if reference else []
            out.append([dict(zip(("node", "run", "hash", "chars"), x, strict=True)) for x in found])
        return pd.Series(out)

    weighed = _with_copies(pages.select("host", "html"), counts)
    shipped = _by_host(pages.sparkSession, chosen, F.octet_length("reference"))
    if shipped:
        @F.pandas_udf(shape)
        def seen(texts: pd.Series, hosts: pd.Series) -> pd.Series:
            return seen_in(texts, [shipped.value.get(h, (None,))[0] for h in hosts])

        parts = weighed.select("host", "copies", seen("html", "host").alias("x"))
    else:
        @F.pandas_udf(shape)
        def seen(texts: pd.Series, chosen: pd.Series) -> pd.Series:
            return seen_in(texts, chosen)

        parts = left_lookup(weighed, chosen, "host", "host").select("host", "copies", seen("html", "reference").alias("x"))
    found = parts.select("host", "copies", F.explode("x").alias("x")).select("host", "copies", "x.*")
    # Whole numbers, so that the order of the sums decides nothing.
    sums = found.groupBy("host", "node", "run").agg(
        F.round(F.sum(F.expr(f"{WHOLE_PAGE}L div copies")) / WHOLE_PAGE).cast("long").alias("pages"),
        F.min("hash").alias("least"), F.max("hash").alias("greatest"),
        F.sum(F.expr(f"greatest(1L, chars * {WHOLE_CHAR}L div copies)")).alias("chars"),
    )
    row = F.struct("node", "run", "pages", "least", "greatest", "chars")
    # One row per node of a reference page.
    stats = sums.groupBy("host").agg(F.sort_array(F.collect_list(row)).alias("stats"))
    different = counts.groupBy("host").agg(F.count("*").alias("different"))
    return stored(chosen.join(stats, "host", "left").join(different, "host", "left"), "wrappers")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: id, url and text, the main text."""
    rows = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.coalesce(html_col, F.lit("")).alias("html"),
        host(F.col(url_col)).alias("host"),
    )
    learned = wrappers(rows)

    def text_by(text: str, reference: str | None, stats: Callable[[], list], n: int, version: object) -> str:
        matcher = _matcher(reference)
        if matcher.wrapper is None or matcher.wrapper[0] != version:
            matcher.wrapper = (version, induce(matcher, stats(), n))
        return main_text(matcher, text)

    def rows_of(stats: Iterable | None) -> list[tuple]:
        return [tuple(r.values() if isinstance(r, dict) else r) for r in stats] if stats is not None else []

    size = F.octet_length("reference") + 48 * F.coalesce(F.size("stats"), F.lit(0))
    learned = learned.withColumn("different", F.coalesce("different", F.lit(0)))
    shipped = _by_host(pages.sparkSession, learned, size)
    if shipped:
        version = uuid4().hex

        @F.pandas_udf("string")
        def text_of(texts: pd.Series, hosts: pd.Series) -> pd.Series:
            out = []
            for text, name in zip(texts, hosts, strict=True):
                reference, stats, n = shipped.value.get(name, (None, None, 0))
                out.append(text_by(text, reference, lambda s=stats: rows_of(s), n, (version, name)))
            return pd.Series(out)

        found = rows.withColumn("text", text_of("html", "host"))
    else:
        @F.pandas_udf("string")
        def text_of(texts: pd.Series, chosen: pd.Series, stats: pd.Series, different: pd.Series) -> pd.Series:
            out = []
            for text, reference, some, n in zip(texts, chosen, stats, different, strict=True):
                seen = rows_of(some)
                out.append(text_by(text, reference, lambda s=seen: s, n, (seen, n)))
            return pd.Series(out)

        joined = left_lookup(rows, learned, "host", "host")
        found = joined.withColumn("text", text_of("html", "reference", "stats", F.coalesce("different", F.lit(0))))
    return found.select(F.col("page_id").alias(id_col), F.col("url").alias(url_col), "text")
