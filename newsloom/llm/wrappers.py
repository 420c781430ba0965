"""Main text of web pages by wrapper induction.

Pages of a host with the same layout share a wrapper. Every page is read into a tree of containers
(``div``, ``nav``, ``article``, lists, tables ...); what stands between containers is a leaf of text.
The tree of one page of each group, the first by a hash, is its reference. All distinct pages are
aligned with it by simple tree matching: the largest set of pairs of nodes with equal labels that
keeps ancestors and the order of siblings. Over all pages of the group the counts of a reference
node are summed: on how many it is there, on how many its text is the same, how much text and how
much of it in links it has. These sums are formed in every task before they are shuffled.

Nodes whose text is the same on ``SAME`` of the pages that have them are template, if the group has
``MIN_PAGES`` distinct pages and less than half of its text is the same (else they are copies of one
another and show nothing). The others are slots. From the root down the wrapper follows the slot
that holds most of the varying text outside links over all pages, and that node is the place of the
main text. Slots that HTML or their names call something else (``nav``, ``footer``, ``class="ad"``,
comments, forms ...) don't count and are left out, as varying menus and adverts would not show
otherwise. A page is aligned with its wrapper again and gives the blocks of the main node and of what
is below it, but for template and such slots. Where it has no such node, it is a group of its own.

Text: character references decoded, white space of a block (``br`` too) one space, blocks in page
order joined by a line feed. Defined cases: a null or empty page and one without main text give an
empty text; a null URL, or one without ``://``, belongs to the host without a name; repeated rows come
back as often, copies count once in the wrapper; an empty table gives an empty result; columns but
``page_id, url, html`` are not read. Unclosed elements end where HTML lets them end or at their
parent's end, what is cut off within a tag is dropped. A page is read whole, in memory that follows
its length; its tree for the alignment has at most ``MAX_NODES`` nodes, below which text is kept
together but not lost.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.lineage import materialize
from newsloom.operators.joins import lookup

#: Pages that show what is template, and the share of them on which it is the same.
MIN_PAGES, SAME = 3, 0.9

#: The share of the varying text that leads down to a child.
MOST = 0.8

#: Text in links above this share is a menu.
LINKED = 0.5

#: Main nodes count so many times, and a name that calls a node something else is overruled for nodes with so much text.
MAIN_WEIGHT, LARGE = 3, 500

#: Nodes and siblings of a page's tree, and its depth.
MAX_NODES, MAX_WIDTH, MAX_DEPTH = 400, 48, 200

#: Wrappers that a worker remembers, and groups whose sums a task holds.
REMEMBERED = 2000

TOKEN = re.compile(
    r"""<!--.*?(?:--!?>|\Z)|<(/?)([a-zA-Z][^\s/<>]*)((?:[^<>"']|"[^"]*"|'[^']*')*+)>|<[!?/][^<>]*>""", re.S
)
CUT_OFF = re.compile(r"<[a-zA-Z/!?][^>]*\Z")
ATTRIBUTE = re.compile(r"""(class|id|role|hidden|style|aria-hidden)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is not text of the page.
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
CONTAINERS = frozenset(
    "article aside blockquote center details dialog div dl fieldset figure footer form header main menu nav ol section table ul".split()
)
BLOCKS = CONTAINERS | frozenset(
    "address body caption dd dt figcaption h1 h2 h3 h4 h5 h6 hgroup hr legend li p pre summary tbody td tfoot th thead tr".split()
)
#: What an element of a kind ends, up to the element that holds the kind.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
#: Elements that are never main text, and names that say so (fixed values).
OTHER_TAGS = frozenset("aside button dialog footer form head menu nav noscript select svg template".split())
OTHER_NAMES = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent contentinfo cookie cookies "
    "disqus footer gdpr masthead menu modal nav navbar navigation newsletter notice notices overlay pager pagination popup "
    "promo promoted promotion recommended related replies reply search share sharing sidebar signup social sponsor sponsored "
    "subscribe subscription toolbar topbar widget".split()
)
#: Names that only say where other things stand.
PLACES = frozenset({"has", "no", "with", "without"})
MAIN = frozenset({"article", "main"})


class Node:
    """A container or, without a tag, a leaf of text."""

    __slots__ = ("children", "heading", "label", "linked", "other", "size", "tag", "text")

    def __init__(self, tag: str, label: str, other: bool):
        self.tag, self.label, self.other = tag, label, other
        self.children: list[Node] = []
        self.text: list[str] = []
        self.size = self.linked = 0
        self.heading = False


def _label(tag: str, attributes: str, in_article: bool) -> tuple[str, bool]:
    """The label that nodes are matched by, and whether the node is called something other than main text."""
    other = tag in OTHER_TAGS or (tag == "header" and not in_article)
    if not attributes:
        return tag, other
    names = []
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), unescape(value.strip("\"'"))
        if name in ("class", "id", "role"):
            names += value.split()
        elif name == "hidden" or (name == "aria-hidden" and value == "true"):
            other = True
        elif name == "style" and re.search(r"display\s*:\s*none", value):
            other = True
    if tag not in MAIN:
        for name in names:
            words = [w.lower() for w in WORDS.findall(name)]
            other = other or (not OTHER_NAMES.isdisjoint(words) and PLACES.isdisjoint(words))
    return (f"{tag}.{re.sub('[0-9]+', '#', names[0])}" if names else tag), other


class Page:
    """A page's tree and its blocks, each with the leaf it belongs to."""

    def __init__(self, html: str | None):
        self.root = Node("body", "body", False)
        self.blocks: list[tuple[Node, str]] = []
        self._held: list[str] = []
        self._links = 0
        # Open elements: tag, the container that takes their text, and whether text in them is dropped or linked.
        self._open: list[tuple[str, Node, bool, bool]] = [("body", self.root, False, False)]
        self._read(html or "")
        self._end_block()
        self._fold()

    def _read(self, html: str) -> None:
        at, match = 0, TOKEN.search(html)
        while match:
            if match.start() > at:
                self._add(html[at : match.start()])
            at = match.end()
            tag = match[2]
            if tag:
                tag = tag.lower()
                if match[1]:
                    self._close(tag)
                else:
                    self._start(tag, match[3])
                    if tag in RAW:
                        end = re.compile(f"</{tag}(?=[\\s/>])", re.I).search(html, at)
                        at = end.start() if end else len(html)
                        self._open.append((tag, *self._open[-1][1:])) if end else None
            match = TOKEN.search(html, at)
        rest = html[at:]
        self._add(CUT_OFF.sub("", rest) if "<" in rest else rest)

    def _add(self, text: str) -> None:
        _, _, dropped, linked = self._open[-1]
        if not dropped:
            text = unescape(text) if "&" in text else text
            self._held.append(text)
            if linked:
                self._links += len(text)

    def _end_block(self) -> None:
        """What was read since the last block is one, in a leaf of the open container."""
        text = " ".join("".join(self._held).split())
        if text:
            owner = self._open[-1][1]
            if not owner.children or owner.children[-1].tag:
                owner.children.append(Node("", "#text", False))
            leaf = owner.children[-1]
            leaf.size += len(text)
            leaf.linked += min(self._links, len(text))
            leaf.text.append(text)
            self.blocks.append((leaf, text))
        self._held.clear()
        self._links = 0

    def _start(self, tag: str, attributes: str) -> None:
        if tag in ("html", "body"):
            self._leave({"head"}, set())
            return
        if tag in BLOCKS:
            self._leave({"head"}, set())
            if tag != "p" or self._open[-1][0] == "p" or any(t == "p" for t, *_ in self._open):
                self._leave({"p"}, CONTAINERS | {"td", "th", "caption"})
        if tag in ENDS:
            self._leave(*ENDS[tag])
        if tag == "br":
            self._held.append(" ")
        if tag in VOID:
            if tag == "hr":
                self._end_block()
            return
        _, owner, dropped, linked = self._open[-1]
        if tag in BLOCKS:
            self._end_block()
        if tag in CONTAINERS and len(self._open) < MAX_DEPTH:
            label, other = _label(tag, attributes, any(t in MAIN for t, *_ in self._open))
            owner.children.append(node := Node(tag, label, other))
            owner = node
        elif tag in OTHER_TAGS:
            dropped = True
        if tag not in RAW:
            self._open.append((tag, owner, dropped, linked or tag == "a"))
        if tag == "h1":
            owner.heading = True

    def _close(self, tag: str) -> None:
        if tag in ("html", "body"):
            return
        if tag == "br":
            self._held.append(" ")
        # An inline element ends nothing around it; a block ends all that is open in it.
        stops = set() if tag in BLOCKS or tag in RAW else BLOCKS
        self._leave({tag}, stops, last=False)

    def _leave(self, tags: set[str], stops: set[str], last: bool = True) -> None:
        """End the innermost of these elements, or with ``last`` the outermost, if it is open below the stops."""
        found = None
        for i in range(len(self._open) - 1, 0, -1):
            name = self._open[i][0]
            if name in tags:
                found = i
                if not last:
                    break
            elif name in stops:
                break
        if found is not None:
            if any(name in BLOCKS for name, *_ in self._open[found:]):
                self._end_block()
            del self._open[found:]

    def _fold(self) -> None:
        """Keep the tree small: deep containers become leaves, many siblings of one label one node."""
        moved: dict[int, Node] = {}
        for depth in (12, 6, 4, 3, 2, 1):
            if _count(self.root, MAX_NODES) <= MAX_NODES:
                break
            _flatten(self.root, depth, moved)
        todo = [self.root]
        while todo:
            node = todo.pop()
            if len(node.children) > MAX_WIDTH:
                _merge(node, moved)
            todo += node.children
        if moved:
            self.blocks = [(_last(moved, leaf), text) for leaf, text in self.blocks]

    def nodes(self) -> list[Node]:
        """The nodes in page order."""
        found, todo = [], [self.root]
        while todo:
            node = todo.pop()
            found.append(node)
            todo += reversed(node.children)
        return found


def _last(moved: dict[int, Node], leaf: Node) -> Node:
    while id(leaf) in moved:
        leaf = moved[id(leaf)]
    return leaf


def _count(node: Node, most: int) -> int:
    n, todo = 0, [node]
    while todo and n <= most:
        node = todo.pop()
        n += 1
        todo += node.children
    return n


def _take(target: Node, leaf: Node, moved: dict[int, Node]) -> None:
    target.size += leaf.size
    target.linked += leaf.linked
    target.text += leaf.text
    moved[id(leaf)] = target


def _flatten(node: Node, depth: int, moved: dict[int, Node]) -> None:
    """Below ``depth`` the text of a container is one leaf; other kinds of content stay apart from main text."""
    if depth:
        for child in node.children:
            _flatten(child, depth - 1, moved)
        return
    leaves: dict[bool, Node] = {}
    todo = [(child, False) for child in reversed(node.children)]
    while todo:
        child, other = todo.pop()
        other = other or child.other
        if child.tag:
            todo += [(c, other) for c in reversed(child.children)]
        else:
            if other not in leaves:
                leaves[other] = Node("", "#text" if not other else "#other", other)
            _take(leaves[other], child, moved)
    node.children = list(leaves.values())


def _merge(node: Node, moved: dict[int, Node]) -> None:
    """Siblings of one label become one node; of one tag, if labels are as many as siblings."""
    for of in (lambda c: (c.label, c.other), lambda c: (c.tag, c.other)):
        kept: dict[tuple, Node] = {}
        for child in node.children:
            first = kept.setdefault(of(child), child)
            if first is not child:
                first.children += child.children
                first.heading |= child.heading
                if not child.tag:
                    _take(first, child, moved)
        node.children = list(kept.values())
        if len(kept) <= MAX_WIDTH:
            break


def layout(root: Node) -> str:
    """A hash of the labels of the upper containers, but for those that aren't main text."""
    upper = [c for c in root.children if c.tag and not c.other]
    labels = {c.label for c in upper} | {f"{c.label}>{d.label}" for c in upper for d in c.children if d.tag and not d.other}
    return xxhash.xxh3_64_hexdigest("\n".join(sorted(labels)).encode())


def packed(node: Node) -> list:
    """The tree as lists: label, tag, other, heading, hash of the text, its length, linked length, children."""
    digest = xxhash.xxh3_64_hexdigest("\n".join(node.text).encode()) if node.text else ""
    children = [packed(c) for c in node.children]
    return [node.label, node.tag, int(node.other), int(node.heading), digest, node.size, node.linked, children]


LABEL, TAG, OTHER, HEADING, DIGEST, SIZE, LINKS, CHILDREN = range(8)


def preorder(tree: list) -> list[list]:
    found, todo = [], [tree]
    while todo:
        node = todo.pop()
        found.append(node)
        todo += reversed(node[CHILDREN])
    return found


def matched(a: list, b: list) -> list[tuple[list, list]]:
    """Simple tree matching: the pairs of the largest match of two trees with equal root labels."""
    held: dict[tuple[int, int], tuple[int, list]] = {}

    def match(x: list, y: list) -> tuple[int, list]:
        """The size of the largest match and the pairs of children in it."""
        if x[LABEL] != y[LABEL]:
            return 0, []
        key = id(x), id(y)
        if key not in held:
            left, right = x[CHILDREN], y[CHILDREN]
            best = [[0] * (len(right) + 1) for _ in range(len(left) + 1)]
            for i, p in enumerate(left, 1):
                for j, q in enumerate(right, 1):
                    size = match(p, q)[0] if p[LABEL] == q[LABEL] else 0
                    best[i][j] = max(best[i - 1][j], best[i][j - 1], best[i - 1][j - 1] + size)
            pairs, i, j = [], len(left), len(right)
            while i and j:
                if best[i][j] == best[i - 1][j]:
                    i -= 1
                elif best[i][j] == best[i][j - 1]:
                    j -= 1
                else:
                    i, j = i - 1, j - 1
                    pairs.append((left[i], right[j]))
            held[key] = 1 + best[-1][-1], pairs
        return held[key]

    found, todo = [], [(a, b)] if match(a, b)[0] else []
    while todo:
        x, y = todo.pop()
        found.append((x, y))
        todo += match(x, y)[1]
    return found


class Wrapper:
    """A reference tree with the sums of its nodes: where the main text is, and what in it is not."""

    def __init__(self, tree: list, sums: dict[int, list[int]]):
        """``sums``: of each node, by its place, the pages that have it, those with the same text, its text and links."""
        self.tree = tree
        self.nodes = preorder(tree)
        self.place = {id(n): i for i, n in enumerate(self.nodes)}
        none = [0, 0, 0, 0]
        self.sums = [sums.get(i, none) for i in range(len(self.nodes))]
        self.template = self._template()
        self.weight: list[float] = [0.0] * len(self.nodes)
        self.main_below = [False] * len(self.nodes)
        for i in range(len(self.nodes) - 1, -1, -1):
            node, below = self.nodes[i], [self.place[id(c)] for c in self.nodes[i][CHILDREN]]
            self.main_below[i] = node[TAG] in MAIN or any(self.main_below[c] for c in below)
            self.weight[i] = sum(self.weight[c] for c in below)
            if not node[TAG] and i not in self.template:
                self.weight[i] += max(self.sums[i][2] - self.sums[i][3], 0)
        pages = max(self.sums[0][0], 1)
        total = self.weight[0]
        #: Called something else, and not overruled as what holds all the text.
        self.other = {
            i
            for i, n in enumerate(self.nodes)
            if n[OTHER]
            and not (
                n[TAG] in ("div", "section", "form", "header")
                and (self.main_below[i] or (self.weight[i] >= 0.9 * total and self.weight[i] >= LARGE * pages))
            )
        }
        self.main = self._main()

    def _template(self) -> set[int]:
        same, all_text = set(), 0
        for i, (node, (n, n_same, size, _)) in enumerate(zip(self.nodes, self.sums, strict=True)):
            if not node[TAG]:
                all_text += size
                if n >= MIN_PAGES and n_same >= SAME * n:
                    same.add(i)
        if 2 * sum(self.sums[i][2] for i in same) > all_text:
            return set()
        return same

    def menu(self, i: int) -> bool:
        """Whether most text of a container is linked, over all pages."""
        if not self.nodes[i][TAG] or self.nodes[i][TAG] in MAIN:
            return False
        leaves = [self.place[id(n)] for n in preorder(self.nodes[i]) if not n[TAG]]
        size, linked = (sum(self.sums[k][c] for k in leaves) for c in (2, 3))
        return linked > LINKED * size

    def _worth(self, i: int) -> float:
        if i in self.other or i in self.template or self.menu(i):
            return 0.0
        own = [self.place[id(c)] for c in self.nodes[i][CHILDREN]]
        worth = sum(map(self._worth, own)) if self.nodes[i][TAG] else self.weight[i]
        return worth * (MAIN_WEIGHT if self.nodes[i][TAG] in MAIN else 1)

    def _main(self) -> int:
        at = 0
        while self.nodes[at][TAG] not in MAIN:
            below = [self.place[id(c)] for c in self.nodes[at][CHILDREN]]
            worth = {i: self._worth(i) for i in below}
            best = max(worth, key=worth.get, default=None)
            if best is None or not self.nodes[best][TAG] or worth[best] < MOST * sum(worth.values()) or not worth[best]:
                break
            if self.nodes[at][HEADING] and not self.main_below[best]:
                break
            at = best
        return at

    def chosen(self, page: Page) -> list[str] | None:
        """The blocks of the main text of a page; none if the page has no such place."""
        tree = packed(page.root)
        own = preorder(tree)
        of = {id(y): self.place[id(x)] for x, y in matched(self.tree, tree)}
        if self.main not in of.values():
            return None
        leaves: set[int] = set()
        nodes = page.nodes()
        strict = self.nodes[self.main][TAG] not in MAIN
        todo = [(0, False)]
        sizes = _sizes(own)
        while todo:
            i, inside = todo.pop()
            place = of.get(id(own[i]))
            inside = inside or place == self.main
            dropped = False
            if inside and place != self.main:
                dropped = bool(own[i][OTHER]) if place is None else place in self.other or place in self.template
                dropped = dropped or (strict and place is not None and self.menu(place))
            if dropped:
                continue
            if inside and not own[i][TAG]:
                leaves.add(id(nodes[i]))
            k = i + 1
            for _ in own[i][CHILDREN]:
                todo.append((k, inside))
                k += sizes[k]
        return [text for leaf, text in page.blocks if id(leaf) in leaves]


def _sizes(nodes: list[list]) -> list[int]:
    """Of each node in page order how many there are from it down."""
    at = {id(n): i for i, n in enumerate(nodes)}
    sizes = [1] * len(nodes)
    for i in range(len(nodes) - 1, -1, -1):
        sizes[i] += sum(sizes[at[id(c)]] for c in nodes[i][CHILDREN])
    return sizes


def alone(tree: list) -> Wrapper:
    """The wrapper of a page that is aligned with no other."""
    return Wrapper(tree, {i: [1, 1, n[SIZE], n[LINKS]] for i, n in enumerate(preorder(tree))})


def main_text(page: Page, wrapper: Wrapper | None) -> str:
    blocks = wrapper.chosen(page) if wrapper else None
    if blocks is None:
        blocks = alone(packed(page.root)).chosen(page) or []
    return "\n".join(blocks)


def host_of(url: Column) -> Column:
    """What stands behind the first ``://``, ASCII letters in lower case; empty without it."""
    found = F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def trees(pages: DataFrame) -> DataFrame:
    """``grp, page, tree``: the distinct pages of each group, written. Copies leave a task once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = {}
            for host, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                page = Page(html)
                text = xxhash.xxh3_64_hexdigest("\n".join(t for _, t in page.blocks).encode())
                found.setdefault((f"{host}\n{layout(page.root)}", text), page.root)
            columns = [[g for g, _ in found], [t for _, t in found], [json.dumps(packed(r)) for r in found.values()]]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], names=["grp", "page", "tree"])

    read = pages.select(host_of(F.col("url").cast("string")).alias("host"), F.col("html").cast("string"))
    each = read.mapInArrow(run, "grp string, page string, tree string")
    return materialize(each.groupBy("grp", "page").agg(F.min("tree").alias("tree")), "page-trees")


def wrappers(pages: DataFrame) -> DataFrame:
    """``grp, wrapper``: the reference tree of each group with the sums of its nodes, written."""
    found = trees(pages)
    first = F.min(F.struct("page", "tree"))["tree"].alias("reference")
    references = materialize(found.groupBy("grp").agg(first), "references")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[list, dict[int, int], dict[int, Counter]]] = {}

        def out() -> pa.RecordBatch:
            rows = [(g, i, *(c[k] for k in range(4))) for g, (_, _, sums) in held.items() for i, c in sums.items()]
            held.clear()
            kinds = [pa.string(), *[pa.int64()] * 5]
            columns = zip(*rows, strict=True) if rows else [()] * 6
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=SUMS)

        for batch in batches:
            for grp, tree, reference in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                if grp not in held:
                    nodes = json.loads(reference)
                    held[grp] = nodes, {id(n): i for i, n in enumerate(preorder(nodes))}, {}
                nodes, place, sums = held[grp]
                for x, y in matched(nodes, json.loads(tree)):
                    counted = sums.setdefault(place[id(x)], Counter())
                    counted.update({0: 1, 1: int(x[DIGEST] == y[DIGEST]), 2: y[SIZE], 3: y[LINKS]})
                if len(held) > REMEMBERED:
                    yield out()
        yield out()

    joined = lookup(found.select("grp", "tree"), references, "grp").select("grp", "tree", "reference")
    sums = joined.mapInArrow(run, "grp string, node bigint, n bigint, same bigint, size bigint, linked bigint")
    per_node = sums.groupBy("grp", "node").agg(*[F.sum(c).alias(c) for c in SUMS[2:]])
    # At most MAX_NODES nodes of each group.
    per_group = per_node.groupBy("grp").agg(F.to_json(F.collect_list(F.struct(*SUMS[1:]))).alias("sums"))
    both = per_group.join(references, "grp")
    return materialize(both.select("grp", F.to_json(F.struct("reference", "sums")).alias("wrapper")), "wrappers")


SUMS = ["grp", "node", "n", "same", "size", "linked"]


def unpacked(wrapper: str) -> Wrapper:
    held = json.loads(wrapper)
    sums = {s["node"]: [s[c] for c in SUMS[2:]] for s in json.loads(held["sums"])}
    return Wrapper(json.loads(held["reference"]), sums)


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars``: the main text of every row of ``pages (page_id, url, html)``."""

    def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, html = batch.column("_host").to_pylist(), batch.column("html").to_pylist()
            groups = [f"{h}\n{layout(Page(x).root)}" for h, x in zip(hosts, html, strict=True)]
            columns = [*batch.columns[:3], pa.array(groups, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "html", "grp"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Wrapper] = {}
        for batch in batches:
            texts = []
            for html, grp, wrapper in zip(*[batch.column(c).to_pylist() for c in ("html", "grp", "wrapper")], strict=True):
                if grp not in known:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[grp] = unpacked(wrapper)
                texts.append(main_text(Page(html), known[grp]))
            columns = [*batch.columns[:2], pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(
        F.col("page_id").cast("bigint"),
        F.col("url").cast("string"),
        F.col("html").cast("string"),
        host_of(F.col("url").cast("string")).alias("_host"),
    )
    grouped = rows.mapInArrow(group, "page_id bigint, url string, html string, grp string")
    joined = lookup(grouped, wrappers(pages), "grp", "left", costly=True).select("page_id", "url", "html", "grp", "wrapper")
    return joined.mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
