"""Main text of web pages by wrapper induction.

Pages of a host are built from few templates. Every page becomes a tree whose runs of alike siblings are
folded into one node, and trees of the same host are aligned by simple tree matching, which keeps the
order of siblings and maximises matched nodes. The merged tree of a host counts, for each node, the
pages that have it and the different texts seen there. A node whose text stays the same while the
pages differ is template, a node whose text varies is a slot. Slots are content unless the tags or
names on their path say that they are navigation, notices, forms and the like; where a page marks
its article, the slots of all its outermost marked parts are the content, in page order. Names are often those of a layout ("right-sidebar" on
the frame of a page), so a part named like that stays where it holds the article or most of the
page's varying text (``reopened``).

Trees are merged per task first and then by host in two steps, so a host with a third of the pages
is spread; merged trees keep every node, so they are as large as the host's templates differ. Pages then get the tree of
their host by a join.

Defined cases: null or empty html gives an empty text; pages without a host form one host; a node that
fewer than ``MIN_PAGES`` different pages have is no constant, so tags and names decide alone; a page that aligns badly
keeps its unmatched nodes as slots; markup errors are read leniently, an element open at the end is closed there;
repeated rows give equal rows; an empty table gives no rows.
"""

from __future__ import annotations

import html as entities
import json
import re
import zlib
from collections import OrderedDict
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.stage import staged
from .common import sliced, table

#: Different pages that must have a node before its text, the same in all, counts as template.
MIN_PAGES = 10
#: Depth from which on elements are not nested any further: their texts belong to the last open one.
DEPTH = 150
#: Digests kept per node to count its different texts, and the different pages that have it.
SKETCH = 16
#: Partial trees per host before the last merge.
FAN = 32

#: HTML rules (fixed values): elements without end tag, with raw text, that break lines.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp template".split())
BLOCKS = frozenset("address article aside blockquote body br canvas caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
                   "frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th "
                   "thead title tr ul".split())
#: Which open elements a start tag ends (fixed values).
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
        "thead": {"tr", "td", "th"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"}}
STOPS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "option": {"select"}}
#: Elements that never hold an article's text, and words in class, id or role that mark other parts (fixed values).
NEVER = frozenset("head script style noscript template nav header footer aside form button select textarea iframe object canvas svg math dialog menu".split())
OTHER = frozenset("ad ads advert adverts advertisement advertising adsbygoogle sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb "
                  "breadcrumbs sidebar aside header masthead footer foot cookie cookies consent gdpr notice notices alert alerts popup modal overlay newsletter "
                  "subscribe subscription signup login search searchbox form social share shares sharing related recommended recommendations comment comments "
                  "commentlist respond reply replies disqus pagination pager copyright legal widget widgets toolbar skip complementary contentinfo hidden".split())
#: Words that turn such a name around when they come first ("no-sidebar") or last ("comments-open"), and words that
#: make a header or a form part of the article ("entry-header").
NOT_FIRST = frozenset("no has with without not is hide show".split())
NOT_LAST = frozenset("open closed enabled disabled on off".split())
OF_ARTICLE = frozenset("article entry post story content main headline".split())
#: Elements that repeat whatever they hold (fixed values); other neighbours are alike if their children are.
REPEATS = frozenset("p li dt dd tr td th option a b i em strong span br img source h1 h2 h3 h4 h5 h6".split())
#: Names of an article element itself that tell it is none.
NOT_ARTICLE = frozenset("comment reply related teaser promo ad advert sponsored".split())
ARTICLE = frozenset("article post entry story content postcontent articlebody storybody maincontent".split())


#: Words behind the head of a name: they say what holds the part, how it is built or where it stands (fixed values).
HOLDERS = frozenset("area bar block body bottom box btn button buttons center col column container content desktop fixed group holder icon icons inner item items "
                    "label left link links list main mobile outer panel place placeholder primary region right row secondary section slot space sticky text "
                    "title toggle top unit wrap wrapper zone".split())
#: Words that say it of whatever they stand before ("related-posts"), and words that name a part with articles of its
#: own, readers' or other pages' (fixed values).
BEFORE = frozenset("advertisement sponsor sponsored promo related recommended comment comments cookie cookies share sharing newsletter breadcrumb skip".split())
APART = frozenset("comment comments commentlist respond reply replies disqus related recommended ad ads advert adverts advertisement advertising adsbygoogle "
                  "sponsor sponsored promo promotion".split())


@lru_cache(maxsize=20_000)
def name_words(name: str) -> tuple[str, ...]:
    """The words of one class, id or role, without a layout's ("content-with-sidebar")."""
    words = [w for w in re.split(r"[^a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", name).lower()) if w]
    return tuple(words[:next((i for i, w in enumerate(words) if w in NOT_FIRST), None)])


@lru_cache(maxsize=20_000)
def name_kind(name: str) -> int:
    """What one class, id or role says: 1 other part, 2 article, 0 nothing.

    A name is that of its head, the last word but ``HOLDERS``: "share-buttons" is other, "legal-news" is not.
    """
    words = name_words(name)
    if not words or words[-1] in NOT_LAST:
        return 0
    last = len(words) - 1
    while last and words[last] in HOLDERS:
        last -= 1
    other = {w for w in words if w in OTHER}
    if other and (words[last] in OTHER or words[0] in BEFORE) and not (words[0] in OF_ARTICLE and other <= {"header", "form"}):
        return 1
    if not NOT_ARTICLE.isdisjoint(words):
        return 0
    return 2 if words[0] in ARTICLE or (words[0] in OF_ARTICLE and words[-1] in ("content", "body", "text")) else 0


# a quote opens a string only right behind the sign of equality; elsewhere it is a character like others
_MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]+|=\s*(?:\"[^\"]*\"|'[^']*')|=)*)(?:>|\Z)", re.S)
_NAMES = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)


class Node:
    """An element: its label (tag and names without digits), flags, children and own text in order."""

    __slots__ = ("tag", "label", "other", "article", "gone", "own", "apart", "parts")

    def __init__(self, tag: str, names: str = "", gone: bool = False) -> None:
        self.tag = tag
        self.label = f"{tag} {re.sub(r'[0-9]+', '', names).strip().lower()}".strip() if names else tag
        kinds = [name_kind(n) for n in names.split()] if names else ()
        if tag in ("body", "html", "main"):
            self.other = gone
        elif tag == "article":
            self.other = gone or bool(kinds) and not NOT_ARTICLE.isdisjoint(names.lower().split())
        else:
            self.other = gone or tag in NEVER and not (tag == "header" and 2 in kinds) or 1 in kinds
        self.gone = gone
        self.apart = 1 in kinds and any(k == 1 and not APART.isdisjoint(name_words(n)) for n, k in zip(names.split(), kinds, strict=True))
        #: an article or main part wherever it stands, also in a part that is other
        if tag == "article":
            self.own = not any(not NOT_ARTICLE.isdisjoint(name_words(n)) for n in names.split())
        else:
            self.own = tag == "main" or 2 in kinds and not self.apart and tag not in NEVER and tag not in REPEATS
        self.article = not self.other and (tag in ("article", "main") or 2 in kinds)
        self.parts: list[Node | str] = []

    @property
    def children(self) -> list[Node]:
        return [p for p in self.parts if not isinstance(p, str)]


def tree(source: str) -> Node:
    """Lenient tree of a page; its texts are still encoded."""
    root = Node("#page")
    open_, at, lower = [root], 0, None
    flat: dict[str, int] = {}  # open elements beyond the depth
    while True:
        found = _MARKUP.search(source, at)
        if found is None:
            break
        if found.start() > at:
            open_[-1].parts.append(source[at:found.start()])
        at = found.end()
        tag = found[2]
        if tag is None:
            continue
        tag = tag.lower()
        if found[1]:
            if flat.get(tag):
                flat[tag] -= 1
                continue
            if tag in ("p", "br"):  # a stray end tag of these still breaks the block
                if tag == "br" or not any(n.tag == tag for n in open_):
                    open_[-1].parts.append(Node(tag))
                    continue
            for depth in range(len(open_) - 1, 0, -1):
                if open_[depth].tag == tag:
                    del open_[depth:]
                    break
                if open_[depth].tag in ("article", "main", "nav", "aside", "table", "form") and tag not in BLOCKS:
                    break  # a stray end of an inline element stays inside
            continue
        names, gone = "", False
        if found[3].strip():
            for name, one, two, three in _NAMES.findall(found[3]):
                name, value = name.lower(), one or two or three
                if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
                    gone = True
                elif name != "aria-hidden":
                    names += " " + value
        if tag in BLOCKS and tag != "br":  # a block ends an open paragraph
            for depth in range(len(open_) - 1, 0, -1):
                if open_[depth].tag == "p":
                    del open_[depth:]
                    break
                if open_[depth].tag in BLOCKS:
                    break
        if tag in ENDS:
            for depth in range(len(open_) - 1, 0, -1):
                if open_[depth].tag in STOPS.get(tag, {"table"}):
                    break
                if open_[depth].tag in ENDS[tag]:
                    del open_[depth:]
                    if tag not in ("tr", "thead", "tbody", "tfoot"):
                        break
        node = Node(tag, entities.unescape(names), gone)
        open_[-1].parts.append(node)
        if tag in RAW:
            lower = source.lower() if lower is None else lower
            end = lower.find(f"</{tag}", at)
            end = len(source) if end < 0 else end
            node.parts.append(source[at:end])
            close = source.find(">", end)
            at = len(source) if close < 0 else close + 1
        elif tag not in VOID and not found[0].endswith("/>"):
            if len(open_) < DEPTH:
                open_.append(node)
            else:
                flat[tag] = flat.get(tag, 0) + 1
    if at < len(source):
        open_[-1].parts.append(source[at:])
    return root


def reopened(root: Node, fixed: set[int] | None = None) -> Node:
    """Undo ``other`` of nodes that hold the page's article, so that it is not cut with them.

    Of the topmost other nodes (hidden ones apart) those are opened that hold

    - an article, if none stands outside of other nodes or none there is twice as long; nodes named as comments,
      advertisements or links to other pages only if the page has no article elsewhere;
    - more than half of the text that is not in ``fixed``, if there is no article at all and a name or a
      form alone made them other; not those of comments, advertisements and the like. Without ``fixed``, before it
      is known what varies, each of them is opened.

    What is other inside of an opened node is looked at in the same way.
    """
    size: dict[int, int] = {}  # varying text of a node
    longest: dict[int, int] = {}  # and that of the longest article in it, -1 if there is none

    def measure(node: Node) -> None:
        own = 0 if fixed and id(node) in fixed else sum(len(p.strip()) for p in node.parts if isinstance(p, str))
        best = -1
        for child in node.children:
            measure(child)
            if not child.gone and child.tag not in RAW:
                own += size[id(child)]
                best = max(best, longest[id(child)])
        size[id(node)], longest[id(node)] = own, max(best, own) if node.own and own else best

    def closed(node: Node, found: list[Node]) -> tuple[int, int]:
        """Text outside of other nodes, and that of the longest article there, -1 if there is none; other nodes are gathered."""
        if node.other:
            if not node.gone and node.tag not in RAW:
                found.append(node)
            return 0, -1
        own, best = 0 if fixed and id(node) in fixed else sum(len(p.strip()) for p in node.parts if isinstance(p, str)), -1
        for child in node.children:
            text, article = closed(child, found)
            own, best = own + text, max(best, article)
        return own, max(best, own) if node.article and own else best

    measure(root)
    while True:
        shut: list[Node] = []
        outside = closed(root, shut)[1]
        holding = [n for n in shut if longest[id(n)] >= 0]
        open_ = [n for n in holding if not n.apart and 2 * longest[id(n)] >= outside and (outside < 0 or n.tag not in NEVER or n.tag == "form")]
        if outside < 0 and not open_:
            open_ = holding or [n for n in shut if not n.apart and (n.tag not in NEVER or n.tag == "form") and (fixed is None or 2 * size[id(n)] > size[id(root)])]
        if not open_:
            return root
        for node in open_:
            node.other, node.article = False, node.own


# ---- folded trees: what is aligned ----------------------------------------------------------------

class Fold:
    """A node of a folded tree: alike neighbours as one; ``sources`` are the page's nodes behind it."""

    __slots__ = ("label", "children", "sources")

    def __init__(self, label: str, sources: list[Node]) -> None:
        self.label, self.sources = label, sources
        self.children: list[Fold] = []


def form(node: Node) -> tuple:
    if node.tag in REPEATS:
        return (node.label,)
    return (node.label, *dict.fromkeys(c.label for c in node.children))


def alike(one: Node, two: Node) -> bool:
    return one.label == two.label and form(one) == form(two)


def folded(nodes: list[Node]) -> Fold:
    """Fold a run of alike nodes: their children are taken together, neighbours of one label become one."""
    out = Fold(nodes[0].label, nodes)
    runs: list[list[Node]] = []
    for node in nodes:
        for child in node.children:
            if runs and alike(runs[-1][-1], child):
                runs[-1].append(child)
            else:
                runs.append([child])
    if len(nodes) > 1:  # what repeats node by node, as the cells of rows do, is gathered
        by_form: dict[tuple, list[Node]] = {}
        for run in runs:
            by_form.setdefault(form(run[0]), []).extend(run)
        runs = list(by_form.values())
    out.children = [folded(run) for run in runs]
    return out


class Slot:
    """A node of a host's merged tree: pages that have it, digests of their contents and of the node's
    own texts, children in order."""

    __slots__ = ("label", "pages", "bodies", "texts", "children")

    def __init__(self, label: str, pages: int, bodies: list[int], texts: list[int], children: list[Slot]) -> None:
        self.label, self.pages, self.bodies, self.texts, self.children = label, pages, bodies, texts, children

    def dump(self) -> list:
        return [self.label, self.pages, self.bodies, self.texts, [c.dump() for c in self.children]]

    @classmethod
    def load(cls, data: list) -> Slot:
        return cls(*data[:4], [cls.load(c) for c in data[4]])

    def count(self) -> int:
        return 1 + sum(c.count() for c in self.children)


def matched(one, two, memo: dict | None = None) -> int:
    """Simple tree matching: most node pairs with equal labels, keeping parents and the order of siblings."""
    if one.label != two.label:
        return 0
    memo = {} if memo is None else memo
    key = (id(one), id(two))
    if key not in memo:
        memo[key] = 1 + _table(one.children, two.children, memo)[-1][-1]
    return memo[key]


def _table(one: list, two: list, memo: dict) -> list[list[int]]:
    rows = [[0] * (len(two) + 1)]
    for a in one:
        last, row = rows[-1], [0]
        for j, b in enumerate(two):
            best = max(last[j + 1], row[j])
            if a.label == b.label:
                best = max(best, last[j] + matched(a, b, memo))
            row.append(best)
        rows.append(row)
    return rows


def alignment(one: list, two: list, memo: dict) -> list[tuple[int, int]]:
    """Pairs of places that a best matching of two lists of siblings matches."""
    rows, out, i, j = _table(one, two, memo), [], len(one), len(two)
    while i and j:
        if rows[i][j] == rows[i - 1][j]:
            i -= 1
        elif rows[i][j] == rows[i][j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            out.append((i, j))
    return out[::-1]


def merged(slot: Slot, other: Slot, memo: dict | None = None) -> Slot:
    """Merge ``other`` into ``slot``; unmatched children go behind the match before them."""
    memo = {} if memo is None else memo
    slot.pages += other.pages
    slot.bodies = sorted({*slot.bodies, *other.bodies})[:SKETCH]
    slot.texts = sorted({*slot.texts, *other.texts})[:SKETCH]
    pairs = alignment(slot.children, other.children, memo)
    kept, at = list(slot.children), {j: i for i, j in pairs}
    children, taken = [], 0
    for j, child in enumerate(other.children):
        if j in at:
            children += kept[taken:at[j] + 1]
            taken = at[j] + 1
        else:
            children.append(child)
    children += kept[taken:]
    for i, j in pairs:
        merged(kept[i], other.children[j], memo)
    slot.children = children
    return slot


def own_text(nodes: list[Node]) -> str:
    return " ".join(p for n in nodes for p in n.parts if isinstance(p, str))


def body_digest(root: Node) -> int:
    """Digest of the texts outside of navigation, scripts and the like: copies of an article agree in it."""
    mark = 0

    def walk(node: Node) -> None:
        nonlocal mark
        for part in () if node.other else node.parts:
            if isinstance(part, str):
                mark = zlib.crc32(part.encode(), mark)
            else:
                walk(part)

    walk(root)
    return mark


def page_slots(page: Fold, body: int) -> Slot:
    """A page as a merged tree of itself."""
    text = " ".join(own_text(page.sources).split())
    return Slot(page.label, 1, [body], [zlib.crc32(text.encode())] if text else [], [page_slots(c, body) for c in page.children])


# ---- verdicts and text ----------------------------------------------------------------------------

def constants(slot: Slot) -> list:
    """The tree with a flag per node: 1 where one and the same text stands in all of enough different pages."""
    return [slot.label, int(len(slot.bodies) >= MIN_PAGES and len(slot.texts) == 1), [constants(c) for c in slot.children]]


class Flag:
    """A node of the tree that pages are aligned with."""

    __slots__ = ("label", "fixed", "children")

    def __init__(self, data: list) -> None:
        self.label, self.fixed, self.children = data[0], data[1], [Flag(c) for c in data[2]]


def fixed_nodes(page: Fold, wrapper: Flag) -> set[int]:
    """Ids of the page's nodes that align with constants of the wrapper."""
    out: set[int] = set()
    memo: dict = {}

    def walk(one: Fold, two: Flag) -> None:
        if two.fixed:
            out.update(id(n) for n in one.sources)
        for i, j in alignment(one.children, two.children, memo):
            walk(one.children[i], two.children[j])

    if page.label == wrapper.label:
        walk(page, wrapper)
    return out


def main_text(source: str | None, wrapper: Flag | None) -> str:
    """Content of a page under the wrapper of its host."""
    if not source:
        return ""
    root = tree(source)
    fixed = fixed_nodes(folded([root]), wrapper) if wrapper is not None else set()
    reopened(root, fixed)

    def words(node: Node) -> int:
        if node.other:
            return 0
        return sum(len(p) if isinstance(p, str) else words(p) for p in node.parts)

    def marked(node: Node) -> list[Node]:
        """Outermost marked parts in page order; all of their slots are content."""
        if node.other:
            return []
        return [node] if node.article else [n for c in node.children for n in marked(c)]

    frames = marked(root)
    # a marked headline or paragraph alone does not tell where the rest of the article is
    chosen = frames if any(n.tag not in REPEATS and words(n) for n in frames) else [root]
    out: list[str] = []

    def gather(node: Node) -> None:
        if node.other:
            return
        block = node.tag in BLOCKS
        if block:
            out.append("\n")
        keep = id(node) not in fixed
        for part in node.parts:
            if isinstance(part, str):
                if keep:
                    out.append(part)
            else:
                gather(part)
        if block:
            out.append("\n")

    for node in chosen:
        gather(node)
        out.append("\n")
    return " ".join(entities.unescape("".join(out)).split())


# ---- Spark ----------------------------------------------------------------------------------------

def host_of(url: Column) -> Column:
    """Host of a URL in lower case, empty if there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def wrappers(pages: DataFrame, host: str = "host", html: str = "html") -> DataFrame:
    """One merged and judged tree per host: ``host``, ``wrapper`` (JSON)."""
    kind = "host string, tree string"

    def flush(trees: dict[str, Slot]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(trees), pa.string()), pa.array([json.dumps(t.dump(), separators=(",", ":")) for t in trees.values()], pa.string())],
                                          ["host", "tree"])

    def held(items: Iterator[tuple[str, Slot]]) -> Iterator[pa.RecordBatch]:
        trees: dict[str, Slot] = {}
        for name, page in items:
            trees[name] = merged(trees[name], page) if name in trees else page
            if len(trees) >= 2000:  # partial trees leave early; they meet again behind the shuffle
                yield flush(trees)
                trees = {}
        if trees:
            yield flush(trees)

    def induce(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def read() -> Iterator[tuple[str, Slot]]:
            for part in parts:
                for piece in sliced(part, 2 << 20):
                    for name, source in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist(), strict=True):
                        root = reopened(tree(source))
                        yield name, page_slots(folded([root]), body_digest(root))
        yield from held(read())

    def join(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from held((n, Slot.load(json.loads(t))) for part in parts for n, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True))

    def judge(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            out = [json.dumps(constants(Slot.load(json.loads(t))), separators=(",", ":")) for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(out, pa.string())], ["host", "wrapper"])

    first = pages.where(F.length(html) > 0).select(host, html).mapInArrow(induce, kind)
    halfway = first.repartition("host", F.pmod(F.spark_partition_id(), F.lit(FAN))).mapInArrow(join, kind)
    # a task of this shuffle may flush a host more than once only beyond 2000 hosts; the sort keeps a host's trees together
    whole = halfway.repartition("host").sortWithinPartitions("host").mapInArrow(_by_host, kind)
    return whole.mapInArrow(judge, "host string, wrapper string")


def _by_host(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge the trees of each host; rows come sorted by host, one tree is held at a time."""
    name, tree_ = None, None
    for part in parts:
        for host, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
            slot = Slot.load(json.loads(text))
            if host == name:
                merged(tree_, slot)
            else:
                if tree_ is not None:
                    yield _tree_row(name, tree_)
                name, tree_ = host, slot
    if tree_ is not None:
        yield _tree_row(name, tree_)


def _tree_row(host: str, slot: Slot) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([host]), pa.array([json.dumps(slot.dump(), separators=(",", ":"))])], ["host", "tree"])


def extracted(pages: DataFrame, url: str = "url", html: str = "html", out: str = "main_text") -> DataFrame:
    """Append the main text of every page; a column of that name is replaced."""
    kept = [c for c in pages.columns if c.lower() != out.lower()]
    prefix = "_" * (1 + max(map(len, kept)))
    host, wrapper, body = f"{prefix}host", f"{prefix}wrapper", f"{prefix}html"
    rows = pages.select(*[F.col(f"`{c}`") for c in kept], host_of(F.col(f"`{url}`")).alias(host), F.coalesce(F.col(f"`{html}`"), F.lit("")).alias(body))
    # written first, so that the size of the small side is known when the join is planned and pages need not move
    known = staged(wrappers(rows.select(F.col(host).alias("host"), F.col(body).alias("html"))), "wrappers")
    both = rows.join(known.select(F.col("host").alias(host), F.col("wrapper").alias(wrapper)), host, "left").select(*[F.col(f"`{c}`") for c in kept], body, wrapper)
    schema = T.StructType([*[f for f in pages.schema if f.name in kept], T.StructField(out, T.StringType())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        recent: OrderedDict[str, Flag] = OrderedDict()

        def flags(text: str | None) -> Flag | None:
            if text is None:
                return None
            if text not in recent:
                recent[text] = Flag(json.loads(text))
                if len(recent) > 200:
                    recent.popitem(last=False)
            return recent[text]

        for part in parts:
            for piece in sliced(part, 8 << 20):
                texts = [main_text(s, flags(w)) for s, w in zip(piece.column(len(kept)).to_pylist(), piece.column(len(kept) + 1).to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([*piece.columns[:len(kept)], pa.array(texts, pa.string())], [*kept, out])

    return both.mapInArrow(run, schema)


def op2_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extracted(pages, out="text").select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
