"""Main text of web pages by wrapper induction.

1. Every page is parsed into blocks: runs of inline text with the path of elements they
   stand in. The page's element tree, without its texts, is its *skeleton*.
2. The set of label paths of a page is its *shape*. The shapes of a host (one page
   of each) fall into *layouts* of shapes that are alike, the most frequent first, and each layout's pages are merged
   into one model that has the nodes of all. A page goes to the layout of its shape. Layouts are made of
   ``SHAPES`` shapes at once, and the layouts of as many such parts are then put together, until a host has one part. Simple tree
   matching aligns its skeleton with the model: two trees match if their roots have the same
   tag, and children are matched in order so that the most nodes pair up.
3. Over all pages of a layout (not those without text), Spark counts for each node of the model how many pages have a
   partner for it and how many distinct texts stand there. A node that most pages have, with
   the same words in nearly all of them, is template; where the words vary it is a slot.
4. A page's content is the text of its slots, and of nodes the model lacks, inside the
   part that the mark-up names as the article (else the whole body). Slots that the
   mark-up names as something else (menus, adverts, forms, comments, ...) are
   dropped; they vary from page to page as the article does. Names that an article's own
   parts may have as well (notice, legal, reviews, ...) drop a part of the article only if
   the pages do not show that its words vary.
   Pages of a host with the same article text have one vote together, so copies of one
   article on many pages make none of it template.

Skeletons and counts are small; the texts are shuffled once, compressed, to meet their
host's template. The pages of a hot host are dealt over several tasks, each with a copy of its models.

Defined results: a missing page or one without text gives the empty text; a missing url is
a host of its own; truncated pages are read as far as they go; repeated rows are pages of
their own; an empty table gives an empty table; other columns of the input do not take part.
"""

from __future__ import annotations

import hashlib
import html as entities
import json
import re
import sys
import zlib
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Pages of a host that must have a node before it can be template, and their shares.
MIN_PAGES, PRESENT, CONSTANT = 3, 0.6, 0.8

# Shapes of a host that are put into layouts at once, those of a layout that others are compared with, and how
# alike shapes of one layout are.
SHAPES, COMPARED, ALIKE = 64, 8, 0.5

# Pages of one host a task takes, and the share of all pages below which no host is cut. So at most
# 10,000 hosts are cut, and their numbers can go to every task.
PAGES_PER_TASK, LEAST_SHARE = 1024, 10_000

# Fixed values of the mark-up language.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
RAW = frozenset("script style textarea title noscript template iframe noembed xmp".split())
CLOSED_BY = {
    "p": frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()),
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "option": frozenset(["option"]),
    "tr": frozenset(["tr", "tbody", "tfoot"]), "td": frozenset(["td", "th", "tr", "tbody"]), "th": frozenset(["td", "th", "tr", "tbody"]),
}
CLOSES = {tag: [o for o, closers in CLOSED_BY.items() if tag in closers] for tag in frozenset().union(*CLOSED_BY.values())}
HOLDS_OPEN = frozenset("ul ol table dl select div article section body".split())
# What the mark-up itself calls something other than the article.
OTHER_TAGS = frozenset(
    "head nav footer aside form script style noscript template iframe svg button select textarea input dialog menu object canvas audio video title".split()
)
OTHER_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
OTHER_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adbox adslot banner banners breadcrumb breadcrumbs "
    "comment comments commentlist commentary disqus consent cookie cookies gdpr notice notices popup modal overlay promo "
    "promotion sponsor sponsored sidebar sidebars side nav navbar navigation menu menus footer header masthead topbar "
    "toolbar pagination pager related recommended share sharing social subscribe subscription newsletter signup login "
    "search widget widgets responses replies feedback reviews alert disclaimer copyright legal skip".split()
)
# Of these, names that parts of an article have too: there the votes decide.
WEAK_NAMES = frozenset(
    "side notice notices overlay share sharing search widget widgets feedback reviews alert disclaimer copyright legal skip".split()
)
MAIN_TAGS = frozenset(["article", "main"])
# An element of the article's kind that one of these names is none.
NOT_MAIN_NAMES = frozenset("ad ads advert advertisement comment comments promo related recommended sponsored".split())
MAIN_NAMES = frozenset(
    "articlebody article-body entry-content post-content post-body article-content content-body story-body main-content page-content".split()
)
# One after the other: a comment, a declaration, an end tag, a start tag with its attributes.
TOKEN = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<[!?][^>]*+(?:>|\Z)|</([A-Za-z][^\s/>]*+)[^>]*+(?:>|\Z)"
    r"|<([A-Za-z][^\s/>]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+'|[\"'])*?)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"(class|id|role|itemprop|hidden|aria-hidden|style)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
RAW_END = {tag: re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I) for tag in RAW}


class Node:
    __slots__ = ("children", "doubt", "label", "main", "other", "tag", "texts")

    def __init__(self, tag: str, label: str, main: bool, other: bool, doubt: Node | None = None) -> None:
        self.tag, self.label, self.main, self.other = tag, label, main, other
        # The outermost element of the article around it whose name leaves it to the votes.
        self.doubt = doubt
        self.children: list[Node] = []
        self.texts: list[int] = []


class Page(NamedTuple):
    root: Node
    blocks: list[str]  # in page order
    owners: list[Node]  # of the blocks


def _names(value: str) -> set[str]:
    """Class and id names, and their parts; not those that say what an element goes with."""
    names = set(re.split(r"\s+", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", value).lower()))
    names = {name for name in names if not name.startswith(("has-", "with-", "no-", "without-"))}
    return names | {part for name in names for part in re.split(r"[-_]+", name)}


def _kind(tag: str, attributes: str, inside_main: bool) -> tuple[str, bool, bool, bool]:
    """``label, main, other, doubt``: what the mark-up says the element is."""
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attributes)} if attributes.strip() else {}
    names = _names(f"{found.get('class', '')} {found.get('id', '')}") if found else set()
    main = tag in MAIN_TAGS or found.get("role") == "main" or bool(
        MAIN_NAMES & (names | {found.get("itemprop", "").lower()})
    )
    other = tag in OTHER_TAGS or found.get("role", "") in OTHER_ROLES or "hidden" in found or found.get("aria-hidden") == "true"
    other = other or bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", found.get("style", "")))
    # A header element is the page's, or the article's own with its title.
    other = other or (tag == "header" and not inside_main)
    named = OTHER_NAMES & names
    if inside_main:
        named -= {"header"}
    if main:
        named &= NOT_MAIN_NAMES
    weak = bool(named) and inside_main and named <= WEAK_NAMES and not other
    other = other or bool(named and not weak and tag not in ("html", "body"))
    return f"{tag}.{found.get('class', '')}" if found.get("class") else tag, main, other, weak


def parse(source: str) -> Page:
    """The element tree and the blocks of text of a page, however broken its mark-up."""
    root = Node("#", "#", False, False)
    stack, blocks, owners = [root], [], []
    # For each open element the block it stands in, and how many of each tag are open.
    around, opened = [root], defaultdict(int)
    kinds: dict[tuple[str, str, bool], tuple[str, bool, bool, bool]] = {}
    held: list[str] = []

    def flush() -> None:
        if not held:
            return
        text = " ".join(entities.unescape("".join(held)).split())
        held.clear()
        if text:
            owner = around[-1]
            owner.texts.append(len(blocks))
            blocks.append(text)
            owners.append(owner)

    def close(down_to: int) -> None:
        if any(n.tag not in INLINE or n.other or n.doubt for n in stack[down_to:]):
            flush()
        for node in stack[down_to:]:
            opened[node.tag] -= 1
        del stack[down_to:], around[down_to:]

    at, end = 0, len(source)
    while at < end:
        tag_at = source.find("<", at)
        if tag_at < 0:
            held.append(source[at:])
            break
        if tag_at > at:
            held.append(source[at:tag_at])
        m = TOKEN.match(source, tag_at)
        if not m:
            held.append("<")
            at = tag_at + 1
            continue
        at = m.end()
        if m[1]:
            tag = m[1].lower()
            for depth in range(len(stack) - 1, 0, -1) if opened[tag] else ():
                if stack[depth].tag == tag:
                    close(depth)
                    break
                # An inline end tag does not reach out of its block.
                if tag in INLINE and stack[depth].tag not in INLINE:
                    break
        elif m[2]:
            tag = m[2].lower()
            for open_tag in CLOSES.get(tag, ()):
                for depth in range(len(stack) - 1, 0, -1) if opened[open_tag] else ():
                    if stack[depth].tag == open_tag:
                        close(depth)
                        break
                    if stack[depth].tag in HOLDS_OPEN:
                        break
            above = stack[-1]
            what = (tag, m[3], above.main or above.tag in MAIN_TAGS)
            if what not in kinds:
                kinds[what] = _kind(*what)
            label, main, other, weak = kinds[what]
            apart = other or weak
            if tag not in INLINE or apart:
                flush()
            if tag in VOID:
                continue
            if tag in RAW:
                closing = RAW_END[tag].search(source, at)
                at = closing.end() if closing else end
                continue
            node = Node(tag, label, main or above.main, other or above.other, above.doubt)
            if weak and not node.doubt:
                node.doubt = node
            if tag not in INLINE or apart:
                around[-1].children.append(node)
            stack.append(node)
            around.append(around[-1] if tag in INLINE else node)
            opened[tag] += 1
    flush()
    return Page(root, blocks, owners)


def _ordered(root: Node) -> list[Node]:
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo.extend(reversed(node.children))
    return out


def skeleton(page: Page) -> list[tuple[str, int, int]]:
    """The tree in page order as ``(label, number of children, hash of its own texts)``."""
    def words(node: Node) -> int:
        if not node.texts:
            return 0
        digest = hashlib.blake2b("\n".join(page.blocks[t] for t in node.texts).encode(), digest_size=7).digest()
        return int.from_bytes(digest, "big") | 1

    return [(n.label, len(n.children), words(n)) for n in _ordered(page.root)]


class _Tree:
    __slots__ = ("children", "form", "label", "place", "size")

    def __init__(self, label: str, place: int) -> None:
        self.label, self.place, self.children, self.size = label, place, [], 1


def _tree(flat: list, forms: dict) -> _Tree:
    """The tree of a skeleton; ``form`` is equal for subtrees of equal labels."""
    root = None
    open_nodes: list[tuple[_Tree, int]] = []
    nodes = []
    for place, (label, n, _) in enumerate(flat):
        node = _Tree(label, place)
        nodes.append(node)
        if open_nodes:
            open_nodes[-1][0].children.append(node)
            open_nodes[-1] = (open_nodes[-1][0], open_nodes[-1][1] - 1)
        else:
            root = node
        open_nodes.append((node, n))
        while open_nodes and open_nodes[-1][1] == 0:
            open_nodes.pop()
    for node in reversed(nodes):
        node.size = 1 + sum(c.size for c in node.children)
        node.form = forms.setdefault((node.label, tuple(c.form for c in node.children)), len(forms))
    return root


def _matched(a: _Tree, b: _Tree, known: dict) -> int:
    """Nodes that pair up in the best matching of two trees, by simple tree matching; ``known`` has
    the numbers of trees that differ, by their forms."""
    if a.label != b.label:
        return 0
    return a.size if a.form == b.form else known[a.form, b.form]


def _ends(x: list[_Tree], y: list[_Tree]) -> tuple[int, int]:
    """How many equal subtrees two lists of children begin and end with."""
    head = 0
    while head < min(len(x), len(y)) and x[head].form == y[head].form:
        head += 1
    tail = 0
    while tail < min(len(x), len(y)) - head and x[-1 - tail].form == y[-1 - tail].form:
        tail += 1
    return head, tail


def _match(a: _Tree, b: _Tree, known: dict) -> None:
    """Fill ``known`` for two trees and all that their matching asks for, from the leaves up. The
    stack is a list, since pages may be nested deeper than calls can be."""
    todo = [(a, b, False)]
    while todo:
        u, v, ready = todo.pop()
        if u.label != v.label or u.form == v.form or (u.form, v.form) in known:
            continue
        if ready:
            known[u.form, v.form] = 1 + sum(s for _, _, s in _pair_children(u, v, known))
            continue
        todo.append((u, v, True))
        x, y = u.children, v.children
        head, tail = _ends(x, y)
        inside = {c.form: c for c in x[head : len(x) - tail]}, {c.form: c for c in y[head : len(y) - tail]}
        todo.extend((c, d, False) for c in inside[0].values() for d in inside[1].values() if c.label == d.label)


def _pair_children(a: _Tree, b: _Tree, known: dict) -> list[tuple[_Tree, _Tree, int]]:
    """The children paired in order so that most nodes match. Equal subtrees at both ends
    are paired at once, which loses nothing; the middle is aligned by dynamic programming."""
    x, y = a.children, b.children
    head, tail = _ends(x, y)
    pairs = [(x[i], y[i], x[i].size) for i in range(head)]
    p, q = x[head : len(x) - tail], y[head : len(y) - tail]
    if p and q:
        best = [[0] * (len(q) + 1)]
        for i, u in enumerate(p):
            above, row = best[-1], [0]
            for j, v in enumerate(q):
                row.append(max(above[j + 1], row[j], above[j] + _matched(u, v, known)))
            best.append(row)
        i, j, middle = len(p), len(q), []
        while i and j:
            if best[i][j] == best[i - 1][j]:
                i -= 1
            elif best[i][j] == best[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                middle.append((p[i], q[j], _matched(p[i], q[j], known)))
        pairs += middle[::-1]
    return pairs + [(x[len(x) - k], y[len(y) - k], x[len(x) - k].size) for k in range(tail, 0, -1)]


def align(model: list, page: list) -> list[tuple[int, int]]:
    """Places ``(in model, in page)`` of the nodes that simple tree matching pairs."""
    forms: dict = {}
    known: dict = {}
    a, b = _tree(model, forms), _tree(page, forms)
    _match(a, b, known)
    out, todo = [], [(a, b)]
    while todo:
        u, v = todo.pop()
        if u.label != v.label:
            continue
        out.append((u.place, v.place))
        todo.extend((c, d) for c, d, s in _pair_children(u, v, known) if s)
    return out


def shape(flat: list) -> set[int]:
    """Hashes of the label paths of a skeleton's nodes that have text in or below them."""
    parents, open_nodes, paths = [-1] * len(flat), [], []
    for at, (label, n, _) in enumerate(flat):
        while open_nodes and open_nodes[-1][1] == 0:
            open_nodes.pop()
        if open_nodes:
            parents[at] = open_nodes[-1][0]
            open_nodes[-1][1] -= 1
        open_nodes.append([at, n])
        above = paths[parents[at]] if at else b""
        paths.append(hashlib.blake2b(above + label.encode(), digest_size=7).digest())
    holds = [bool(words) for _, _, words in flat]
    for at in range(len(flat) - 1, 0, -1):
        holds[parents[at]] = holds[parents[at]] or holds[at]
    return {int.from_bytes(path, "big") for path, held in zip(paths, holds, strict=True) if held}


def _alike(x: set[int], y: set[int]) -> float:
    return len(x & y) / max(1, len(x | y))


def merged(model: list, page: list) -> list:
    """The model with the nodes of the page that it lacks, each after what it follows there."""
    a, b = _tree(model, {}), _tree(page, {})
    trees = [a], [b]
    for nodes in trees:
        for node in nodes:
            nodes.extend(node.children)
    old = {node.place: node for node in trees[0]}
    partner = {v: old[u] for u, v in align(model, page)}
    for node in trees[1]:
        if node.place not in partner:
            continue
        # Partners of a node's children are children of its partner, in the same order.
        children, at = partner[node.place].children, 0
        for child in node.children:
            if child.place in partner:
                at = next(k for k, c in enumerate(children) if c is partner[child.place]) + 1
            else:
                children.insert(at, child)
                at += 1
    out, todo = [], [a]
    while todo:
        node = todo.pop()
        out.append((node.label, len(node.children), 0))
        todo.extend(reversed(node.children))
    return out


def shape_hash(own: set[int]) -> int:
    return int.from_bytes(hashlib.blake2b(repr(sorted(own)).encode(), digest_size=8).digest(), "big", signed=True)


# A layout: its model, its first shapes, and the hashes of all its shapes.
Layout = tuple[list, list[set[int]], list[int]]


def joined(layouts: list[Layout]) -> list[Layout]:
    """Each layout joins the one before that is most like it, if one is alike."""
    made: list[Layout] = []
    for model, shapes, hashes in layouts:
        like = [max(_alike(own, other) for own in shapes for other in known) for _, known, _ in made]
        if like and max(like) >= ALIKE:
            at = like.index(max(like))
            old, known, before = made[at]
            made[at] = (merged(old, model), [*known, *shapes][:COMPARED], before + hashes)
        else:
            made.append((model, shapes, hashes))
    return made


def layouts(pages: list[list]) -> list[Layout]:
    """The layouts of pages of different shapes, the most frequent first."""
    single = [(page, shape(page)) for page in pages]
    return joined([(merged(page, page), [own], [shape_hash(own)]) for page, own in single])


class Models:
    """A host's layouts, read once for all its pages that come one after the other."""

    def __init__(self) -> None:
        self.data: bytes | None = None
        self.known: list[list] = []
        self.of: dict[int, int] = {}

    def find(self, data: bytes, page: list) -> tuple[int, list]:
        """The number of the layout of the page's shape, and its model; the first for a page without text."""
        if data != self.data:
            layouts = _unpack(data)
            self.data, self.known = data, [model for model, _, _ in layouts]
            self.of = {own: at for at, (_, _, hashes) in enumerate(layouts) for own in hashes}
        at = self.of.get(shape_hash(shape(page)), 0) if len(self.known) > 1 else 0
        return at, self.known[at]


def main_text(page: Page, template: set[int], slots: set[int] | frozenset[int] = frozenset()) -> str:
    """The article's blocks, joined by a space; ``template`` holds places of constant nodes,
    ``slots`` places of nodes whose words vary from page to page."""
    nodes = _ordered(page.root)
    varied = {id(nodes[at].doubt) for at in slots if nodes[at].doubt}

    def own(node: Node) -> bool:
        return not node.other and (node.doubt is None or id(node.doubt) in varied)

    has_main = any(o.main and own(o) for o in page.owners)
    place = {id(n): at for at, n in enumerate(nodes)}
    kept = [
        text
        for text, owner in zip(page.blocks, page.owners, strict=True)
        if own(owner) and (owner.main or not has_main) and place[id(owner)] not in template
    ]
    return " ".join(kept)


def article_hash(page: Page) -> int | None:
    """A hash of all text in what the mark-up names as the article; none if nothing is named."""
    texts = [text for text, owner in zip(page.blocks, page.owners, strict=True) if owner.main and not owner.other and not owner.doubt]
    if not texts:
        return None
    return int.from_bytes(hashlib.blake2b("\n".join(texts).encode(), digest_size=8).digest(), "big", signed=True)


def _pack(value: object) -> bytes:
    return zlib.compress(json.dumps(value, ensure_ascii=False).encode(), 1)


def _unpack(data: bytes) -> object:
    return json.loads(zlib.decompress(data))


def _skeletons(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parsed = [parse(h or "") for h in batch.column("html").to_pylist()]
        made = pa.array([_pack(skeleton(page)) for page in parsed], pa.binary())
        article = pa.array([article_hash(page) for page in parsed], pa.int64())
        shapes = [shape_hash(shape(skeleton(page))) if page.blocks else None for page in parsed]
        yield pa.RecordBatch.from_arrays(
            [batch.column("host"), article, pa.array(shapes, pa.int64()), made], names=["host", "article", "shape", "skeleton"]
        )


def _layouts_packed(made: list[Layout]) -> bytes:
    return _pack([(model, [sorted(own) for own in shapes], hashes) for model, shapes, hashes in made])


def _layouts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The layouts of a part of a host's shapes."""
    for batch in batches:
        made = [_layouts_packed(layouts([_unpack(s) for s in pages])) for pages in batch.column("pages").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("host"), batch.column("part"), pa.array(made, pa.binary())], names=["host", "part", "model"])


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The layouts of several parts of a host, put together."""
    for batch in batches:
        made = []
        for parts in batch.column("parts").to_pylist():
            known = [(model, [set(own) for own in shapes], hashes) for part in parts for model, shapes, hashes in _unpack(part)]
            made.append(_layouts_packed(joined(known)))
        yield pa.RecordBatch.from_arrays([batch.column("host"), batch.column("part"), pa.array(made, pa.binary())], names=["host", "part", "model"])


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each page and aligned node of its model that holds text: the hash of the page's text
    there; and a row of place -1 for the page itself."""
    models = Models()
    for batch in batches:
        rows: list[tuple] = []
        for host, voter, page_bytes, data in zip(*[batch.column(c).to_pylist() for c in ("host", "voter", "skeleton", "model")], strict=True):
            page = _unpack(page_bytes)
            layout, model = models.find(data, page)
            rows.append((host, layout, -1, voter, 0))
            rows += [(host, layout, u, voter, page[v][2]) for u, v in align(model, page) if page[v][2]]
        types = (pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
        arrays = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(types)]
        yield pa.RecordBatch.from_arrays(arrays, names=["host", "layout", "place", "voter", "words"])


def host_of(url: str) -> F.Column:
    return F.coalesce(F.lower(F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))


def _hot(hosts: DataFrame) -> DataFrame:
    """``host, parts`` of the hosts with more pages than a task should take."""
    least = max(PAGES_PER_TASK, hosts.count() // LEAST_SHARE)
    sizes = hosts.groupBy("host").agg(F.count("*").alias("n"))
    return F.broadcast(sizes.filter(F.col("n") > least).select("host", F.ceil(F.col("n") / least).alias("parts")).checkpoint())


def _dealt(rows: DataFrame, hot: DataFrame) -> DataFrame:
    """The rows with their ``part`` of the host."""
    numbered = rows.withColumn("part", F.monotonically_increasing_id()).join(hot, "host", "left")
    return numbered.withColumn("part", F.pmod("part", F.coalesce("parts", F.lit(1)))).drop("parts")


def _copied(models: DataFrame, hot: DataFrame) -> DataFrame:
    """The models once for every ``part`` of their host."""
    parts = F.sequence(F.lit(0).cast("bigint"), F.coalesce("parts", F.lit(1)) - 1)
    return models.join(hot, "host", "left").withColumn("part", F.explode(parts)).drop("parts")


def templates(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``host, model, template, slots``: each host's models, by layout and place its template
    nodes with the hash of their words, and the nodes whose words vary; and the hot hosts."""
    made = pages.select(host_of("url").alias("host"), "html").mapInArrow(
        _skeletons, "host string, article bigint, shape bigint, skeleton binary"
    )
    # Pages of one article vote once; a page without a named one votes for itself.
    voter = F.coalesce("article", F.xxhash64(F.monotonically_increasing_id())).alias("voter")
    made = made.select("host", voter, "shape", "skeleton").withColumn("h", F.xxhash64("skeleton")).checkpoint()
    hot = _hot(made.select("host"))
    # Pages without text say nothing of a template.
    made = made.filter("shape is not null")
    # Of each shape the page of the smallest hash, found before any skeleton is moved.
    counted = made.groupBy("host", "shape").agg(F.count("*").alias("n"), F.min("h").alias("h"))
    chosen = counted.withColumn("rank", F.row_number().over(Window.partitionBy("host").orderBy(F.desc("n"), "h"))).drop("n")
    part = F.floor((F.col("rank") - 1) / SHAPES).alias("part")
    kinds = "host string, part bigint, model binary"
    models = (
        made.select("host", "shape", "h", "skeleton").join(chosen, ["host", "shape", "h"])
        .dropDuplicates(["host", "rank"])
        .groupBy("host", part).agg(F.sort_array(F.collect_list(F.struct("rank", "skeleton")))["skeleton"].alias("pages"))
        .mapInArrow(_layouts, kinds).checkpoint()
    )
    while models.agg(F.max("part")).first()[0]:
        # The parts of a host, several at a time, until each host has one.
        few = models.groupBy("host", F.floor(F.col("part") / SHAPES).alias("next")).agg(
            F.sort_array(F.collect_list(F.struct("part", "model")))["model"].alias("parts")
        )
        models = few.withColumnRenamed("next", "part").mapInArrow(_joined, kinds).checkpoint()
    models = models.select("host", "model")
    votes = _dealt(made.select("host", "voter", "skeleton"), hot).join(_copied(models, hot), ["host", "part"]).mapInArrow(
        _votes, "host string, layout int, place int, voter bigint, words bigint"
    )
    node = ["host", "layout", "place"]
    single = votes.groupBy(*node, "voter").agg(F.min("words").alias("words"))
    # Per node the voters with each text, then the most frequent text against all of them.
    counted = single.groupBy(*node, "words").agg(F.count("*").alias("n"))
    nodes = counted.groupBy(*node).agg(F.sum("n").alias("present"), F.max(F.struct("n", "words")).alias("most"))
    one = F.struct("place", "present", F.col("most.n").alias("n"), F.col("most.words").alias("words"))
    whole = nodes.groupBy("host", "layout").agg(F.max(F.when(F.col("place") == -1, F.col("present"))).alias("pages"), F.collect_list(one).alias("all"))
    nodes = whole.select("host", "layout", "pages", F.inline("all")).filter("place >= 0")
    same = F.col("n") >= CONSTANT * F.col("present")
    constant = same & (F.col("pages") >= MIN_PAGES) & (F.col("present") >= PRESENT * F.col("pages"))
    template = F.when(constant, F.struct("layout", "place", "words"))
    slot = F.when(~same & (F.col("present") >= MIN_PAGES), F.struct("layout", "place"))
    decided = nodes.groupBy("host").agg(F.collect_list(template).alias("template"), F.collect_list(slot).alias("slots"))
    return models.join(decided, "host"), hot


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    models, decided = Models(), None
    for batch in batches:
        out = []
        for data, model_bytes, constant, varying in zip(*[batch.column(c) for c in ("data", "model", "template", "slots")], strict=True):
            page = parse(zlib.decompress(data.as_py()).decode())
            template: set[int] = set()
            slots: set[int] = set()
            if model_bytes.is_valid:
                host_model = model_bytes.as_py()
                # The model may be that of another host too, its decisions are not.
                if decided is None or decided[:3] != (host_model, constant, varying):
                    fixed = {(c["layout"], c["place"]): c["words"] for c in constant.as_py()}
                    decided = (host_model, constant, varying, fixed, {(c["layout"], c["place"]) for c in varying.as_py()})
                flat = skeleton(page)
                at, model = models.find(host_model, flat)
                pairs = align(model, flat)
                # Only where the page says what most pages say is it template.
                template = {v for u, v in pairs if flat[v][2] and decided[3].get((at, u)) == flat[v][2]}
                slots = {v for u, v in pairs if (at, u) in decided[4]}
            out.append(main_text(page, template, slots))
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(out, pa.string())], names=["page_id", "url", "text"])


def _compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data = pa.array([zlib.compress((h or "").encode(), 1) for h in batch.column("html").to_pylist()], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("page_id", "url", "host")] + [data], names=["page_id", "url", "host", "data"])


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text`` for every page."""
    types = {f.name: f.dataType.simpleString() for f in pages.schema}
    keys = f"page_id {types['page_id']}, url {types['url']}"
    packed = pages.select("page_id", "url", host_of("url").alias("host"), "html").mapInArrow(_compress, f"{keys}, host string, data binary")
    models, hot = templates(pages)
    return _dealt(packed, hot).join(_copied(models, hot), ["host", "part"], "left").mapInArrow(_extract, f"{keys}, text string")
