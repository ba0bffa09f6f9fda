"""Main text of web pages by wrapper induction.

1. Skeleton: a page's DOM tree with children of one label (tag, role, classes) merged under their
   parent, so a list of any length is one node.
2. References: the REFERENCES most frequent skeletons of a host, counted over all its pages.
3. Alignment: each page's skeleton is aligned to the reference it fits best by simple tree matching:
   roots match, children of matched nodes match if their labels are equal, in order, and as many
   nodes as possible. A node that no reference has is aligned with pages of the same skeleton only.
4. Template: an aligned node whose whole text is the same on at least CONSTANT of the host's pages
   that have the node, and on LEAST pages, is template; the others are slots. Support is counted over
   all pages, whatever the host's size. Pages with one title count once, so near copies do not turn
   their text into template.
5. Text: the slots in page order; a page without host, or of a host with few pages, is all slots.

Never content, in any wrapper: menus, headers and footers of the page, sidebars, notices, adverts,
forms, scripts, styles, comments of readers and comments of the markup, told by tag, role, id and
class names. Names that may as well name a part of an article (search, legal, related ...) count
outside of it only. Names remove no element that holds the page's main article or a large part of its
text: such an element is a wrapper that is named after what stands beside the article. What stands
inside the container and is none of these is kept.

Skeletons and support are counted by partial aggregation, so a host with a third of all pages costs
no task more than others. A null or empty html has an empty text; a null URL has no host; repeated
rows are read each. Unclosed, crossed and cut-off tags are mended as browsers do in the usual cases;
trees of any depth are walked without recursion.
"""

from __future__ import annotations

import bisect
import html as html_lib
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leadflow.llm.common import checkpointed, returning, sliced, small_batches, text_or_empty

LEAST, CONSTANT, REFERENCES = 3, 0.8, 4
BROADCAST_BYTES = 16 << 20
RAW = ("script", "style", "noscript", "template", "textarea", "svg", "iframe", "object", "xmp")
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(" + "|".join(RAW) + r""")\b(?:"[^"]*"|'[^']*'|[^>"'])*>.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][\w:-]*)((?:"[^"]*"|'[^']*'|[^>"'])*)>|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z][^>]*\Z""",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden|itemprop|style)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul head title".split()
)
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
BARRIER = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "option": {"select"}}
ENDS_PARAGRAPHS = frozenset(("td", "th", "div", "section", "article", "li", "body", "blockquote", "button"))
NEVER_TAGS = frozenset("head title nav footer aside form button select dialog menu label input".split())
NEVER_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
_NAME = r"(?i)(?:^|[\s_-])(?:%s)(?:$|[\s_-])"
_NEVER = r"ads?|advert\w*|adsense|sponsor\w*|promo\w*|sidebar|side-bar|menu|nav|navbar|navigation|breadcrumbs?|footer|cookies?|consent|gdpr|notices?|popup|modal|newsletter|subscri\w*|signup|login|comments?|commentlist|disqus|respond|replies|pagination|pager|paywall"
_OUTSIDE = r"banner|rail|foot|header|masthead|topbar|toolbar|alerts?|overlay|share|sharing|social|related|recommend\w*|widgets?|skip|copyright|legal|disclaimer|search|form"
NEVER_INSIDE, NEVER_OUTSIDE = re.compile(_NAME % _NEVER), re.compile(_NAME % f"{_NEVER}|{_OUTSIDE}")
CONTENT_NAME = re.compile(r"(?i)(entry|post|article|main|page)[_-]?(content|body|text|header|title)")


# Names of an element with comments in it, not of one that says something of them (no-comments).
COMMENT_NAME = re.compile(r"(?i)(?:[a-z]+[_-])?(?<!no.)(?:comments?|commentlist|disqus\w*|respond|replies)(?:[_-]+(?:area|list|section|body|content|wrap\w*|container|box|thread|form|item|[0-9]+))*")
# An element's names tell that it is no content only if it holds less than this share of the page's text;
# a wrapper around the article holds more. Readers' comments may be longer than what they comment on.
SHARE, COMMENT_SHARE, ARTICLE_SHARE = 0.5, 0.9, 0.25


class Node:
    __slots__ = ("tag", "label", "never", "named", "kids", "parent", "para")

    def __init__(self, tag: str, label: str, never: bool, parent, named: str = ""):
        self.tag, self.label, self.never, self.parent = tag, label, never, parent
        self.named = named  # by its names no content: "part", or "comment"
        self.kids: list = []  # nodes and strings in order
        # the open paragraph that a block here ends, if any
        self.para = self if tag == "p" else None if parent is None or tag in ENDS_PARAGRAPHS else parent.para


def _node(tag: str, attributes: str, parent: Node, in_article: bool) -> Node:
    role, names, hidden = "", [], False
    if attributes and attributes != "/":
        for m in ATTRIBUTE.finditer(attributes):
            name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if name in ("class", "id"):
                names += value.split()
            elif name == "role":
                role = value.lower()
            elif name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and re.search(r"display\s*:\s*none", value)):
                hidden = True
    never = hidden or tag in NEVER_TAGS or role in NEVER_ROLES or (tag == "header" and not in_article)
    named = ""
    if names and not never and tag not in ("html", "body", "main") and not any(CONTENT_NAME.fullmatch(n) for n in names):
        if any(COMMENT_NAME.fullmatch(n) for n in names):
            named = "comment"
        elif tag != "article" and any((NEVER_INSIDE if in_article else NEVER_OUTSIDE).search(n) for n in names):
            named = "part"
    return Node(tag, f"{tag}.{role}.{' '.join(sorted(set(re.sub(r'[0-9]+', '', n) for n in names)))}" if names or role else tag, never, parent, named)


def judge_names(root: Node) -> None:
    """Decide which elements their names remove. On a page with an article or main element (the largest
    one that is no comment) all but the elements that hold it, provided it is a good part of the text
    where a name stands around it. On a page without one, those that hold too much of the text to be a
    part beside it stay. An article named as a comment is one."""
    order, todo = [], [root]
    while todo:
        n = todo.pop()
        order.append(n)
        todo.extend(k for k in n.kids if not isinstance(k, str) and not k.never)
    named = [n for n in order if n.named]
    if not named:
        return
    size: dict[int, int] = {}
    for n in reversed(order):  # children first
        size[id(n)] = sum(len("".join(k.split())) if isinstance(k, str) else size.get(id(k), 0) for k in n.kids)
    total = size[id(root)]
    articles = [n for n in order if n.tag in ("article", "main") and n.named != "comment" and size[id(n)]]
    main = at = max(articles, key=lambda n: size[id(n)], default=None)
    holders = set()
    while at is not None:
        holders.add(id(at))
        at = at.parent
    if main is not None and any(id(n) in holders for n in named) and size[id(main)] < ARTICLE_SHARE * total:
        main, holders = None, set()
    for n in named:
        beside = size[id(n)] <= (COMMENT_SHARE if n.named == "comment" else SHARE) * total
        n.never = id(n) not in holders and (main is not None or beside)


def parse(text: str) -> Node:
    """The tree of a page; strings are decoded. Each node is opened and closed once, and a closing tag
    of which none is open is passed over, so the time grows with the page's length."""
    root = at = Node("", "", False, None)
    opened: dict[str, int] = {}
    end = 0

    def close_to(node: Node) -> Node:
        nonlocal at
        while at is not node:
            opened[at.tag] -= 1
            at = at.parent
        return at

    for m in TOKEN.finditer(text):
        if m.start() > end:
            at.kids.append(html_lib.unescape(text[end : m.start()]))
        end = m.end()
        tag = m[3]
        if not tag:
            continue
        tag = tag.lower()
        if m[2]:
            if opened.get(tag):
                up = at
                while up.tag != tag:
                    up = up.parent
                close_to(up.parent)
            continue
        if tag == "br" or tag == "hr":
            at.kids.append(" " if tag == "br" else Node(tag, tag, False, at))
            continue
        if tag in VOID:
            continue
        if tag in BLOCK and at.para is not None:  # a block ends an open paragraph
            close_to(at.para.parent)
        if tag in CLOSES and any(opened.get(t) for t in CLOSES[tag]):
            up = at
            while up.parent is not None and up.tag not in CLOSES[tag] and up.tag not in BARRIER[tag]:
                up = up.parent
            if up.tag in CLOSES[tag]:
                close_to(up.parent)
                if tag == "tr" and at.tag == "tr":
                    close_to(at.parent)
        new = _node(tag, m[4], at, bool(opened.get("article") or opened.get("main")))
        at.kids.append(new)
        if not (m[4] or "").endswith("/") or tag in BLOCK:
            opened[tag] = opened.get(tag, 0) + 1
            at = new
    if end < len(text):
        at.kids.append(html_lib.unescape(text[end:]))
    judge_names(root)
    return root


def _hash(*parts: int) -> int:
    """A signed 64-bit hash of a few of them."""
    return int.from_bytes(xxhash.xxh3_64_digest(b"".join(p.to_bytes(8, "big", signed=True) for p in parts)), "big", signed=True)


_text_hash = lambda text: int.from_bytes(xxhash.xxh3_64_digest(text.encode("utf-8", "surrogatepass")), "big", signed=True)


def shape_of(root: Node) -> bytes:
    """The skeleton in preorder: hash of the label and number of children of each merged node."""
    out: list[int] = []
    todo = [[root]]
    while todo:
        nodes = todo.pop()
        runs: dict[str, list[Node]] = {}
        for n in nodes:
            for k in n.kids:
                if not isinstance(k, str) and not k.never:
                    runs.setdefault(k.label, []).append(k)
        out += (_text_hash(nodes[0].label), len(runs))
        todo.extend(reversed(runs.values()))
    return np.array(out, np.int64).tobytes()


class Skeleton:
    """A shape as a tree: labels, paths and children by place in preorder."""

    def __init__(self, shape: bytes):
        pairs = np.frombuffer(shape, np.int64).reshape(-1, 2).tolist()
        self.labels = [label for label, _ in pairs]
        self.kids: list[list[int]] = [[] for _ in pairs]
        self.paths = [0] * len(pairs)
        open_: list[list[int]] = []  # node and number of children still to come
        for k, (label, count) in enumerate(pairs):
            if k:
                while not open_[-1][1]:
                    open_.pop()
                up = open_[-1]
                up[1] -= 1
                self.kids[up[0]].append(k)
                self.paths[k] = _hash(self.paths[up[0]], label)
            open_.append([k, count])


def heaviest_increasing(pairs: list[tuple[int, int]]) -> list[int]:
    """Indexes of a heaviest subsequence of (place, weight) whose places increase."""
    ends: list[tuple[int, int, int]] = []  # (place, total weight, index), both increasing
    before: list[int] = []
    for k, (place, weight) in enumerate(pairs):
        i = bisect.bisect_left(ends, (place,))
        before.append(ends[i - 1][2] if i else -1)
        total = weight + (ends[i - 1][1] if i else 0)
        stop = i
        while stop < len(ends) and ends[stop][1] <= total:
            stop += 1
        ends[i:stop] = [(place, total, k)]
    out, k = [], ends[-1][2] if ends else -1
    while k >= 0:
        out.append(k)
        k = before[k]
    return out[::-1]


def match_trees(a: Skeleton, b: Skeleton) -> list[tuple[int, int]]:
    """Simple tree matching: the pairs of the largest matching of the two trees in which roots match,
    children of matched nodes match in order, and labels are equal. Siblings have different labels."""
    if a.labels[0] != b.labels[0]:
        return []
    order, inner = [(0, 0)], []
    for x, y in order:  # grows while it is read
        at = {b.labels[k]: place for place, k in enumerate(b.kids[y])}
        found = [(k, at[a.labels[k]]) for k in a.kids[x] if a.labels[k] in at]
        inner.append([(len(order) + n, place) for n, (_, place) in enumerate(found)])
        order += [(k, b.kids[y][place]) for k, place in found]
    size = [1] * len(order)
    for k in range(len(order) - 1, -1, -1):  # children come behind their parents
        chosen = heaviest_increasing([(place, size[n]) for n, place in inner[k]])
        inner[k] = [inner[k][i] for i in chosen]
        size[k] += sum(size[n] for n, _ in inner[k])
    out, todo = [], [0]
    while todo:
        k = todo.pop()
        out.append(order[k])
        todo.extend(n for n, _ in inner[k])
    return out


class Aligner:
    """Aligns skeletons to the references of their hosts; equal skeletons are aligned once."""

    def __init__(self):
        self.known: dict[tuple, frozenset[int]] = {}
        self.trees: dict[bytes, Skeleton] = {}

    def tree(self, shape: bytes) -> Skeleton:
        if len(self.trees) > 500:
            self.trees.clear()
        if shape not in self.trees:
            self.trees[shape] = Skeleton(shape)
        return self.trees[shape]

    def paths(self, shape: bytes, references: list[bytes]) -> frozenset[int]:
        """Paths of the nodes that the best reference has, too."""
        key = (xxhash.xxh3_128_digest(shape), *map(xxhash.xxh3_64_digest, references))
        if key not in self.known:
            if len(self.known) > 2_000:
                self.known.clear()
            own = self.tree(shape)
            best = own.paths if shape in references else max((([own.paths[x] for x, _ in match_trees(own, self.tree(r))]) for r in references), key=len, default=[])
            self.known[key] = frozenset(best)
        return self.known[key]


def entries(root: Node, aligned: frozenset[int] = frozenset(), apart: int = 0) -> dict[int, tuple[int, int]]:
    """By id of each block that may be content and has text: hashes of its aligned node, and of node
    and whole text. Nodes that are not aligned are told from others by `apart`."""
    order: list[tuple[Node, int]] = []
    todo = [(root, 0)]
    while todo:
        n, path = todo.pop()
        order.append((n, path))
        todo.extend((k, _hash(path, _text_hash(k.label))) for k in n.kids if not isinstance(k, str) and not k.never)
    texts: dict[int, int] = {}
    out = {}
    for n, path in reversed(order):  # children first
        parts = []
        for k in n.kids:
            if isinstance(k, str):
                if text := " ".join(k.split()):
                    parts.append(_text_hash(text))
            elif id(k) in texts:
                parts.append(texts[id(k)])
        if parts:
            texts[id(n)] = _hash(*parts)
            if n.tag in BLOCK:
                node = path if path in aligned else _hash(path, apart)
                out[id(n)] = node, _hash(node, texts[id(n)])
    return out


def blocks(node: Node, template: frozenset = frozenset(), known: dict[int, tuple[int, int]] | None = None) -> list[str]:
    """Texts of the blocks of a subtree in order; template: those of the known entries to leave out."""
    known = known or {}
    out: list[str] = []
    line: list[str] = []

    def flush():
        if line:
            text = " ".join("".join(line).split())
            line.clear()
            if text:
                out.append(text)

    todo = [(iter(node.kids), False)]
    while todo:
        kids, block = todo[-1]
        for k in kids:
            if isinstance(k, str):
                line.append(k)
            elif not k.never:
                if id(k) in known and known[id(k)][1] in template:
                    continue
                inner = k.tag in BLOCK or k.tag == "hr"
                if inner:
                    flush()
                todo.append((iter(k.kids), inner))
                break
        else:
            todo.pop()
            if block:
                flush()
    flush()
    return out


def plain(node: Node, limit: int = 400) -> str:
    """Text of a small subtree, white space in one; long ones by their start and length."""
    parts, todo, size = [], [node], 0
    while todo:
        n = todo.pop()
        if isinstance(n, str):
            parts.append(n)
            size += len(n)
        else:
            todo.extend(reversed(n.kids))
    text = " ".join("".join(parts).split())
    return text if len(text) <= limit else f"{text[:limit]}+{len(text)}"


def name_of(root: Node) -> int:
    """What tells a page from its near copies: the title and the first heading, or else all its text."""
    found: dict[str, str] = {}
    todo = [root]
    while todo and len(found) < 2:
        n = todo.pop()
        if n.tag in ("title", "h1"):
            found.setdefault(n.tag, plain(n))
        todo.extend(k for k in reversed(n.kids) if not isinstance(k, str))
    names = [found.get(t, "") for t in ("title", "h1")]
    return _text_hash("\n".join(names if any(names) else blocks(root)))


def with_host(pages: DataFrame) -> DataFrame:
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][\w+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return pages.withColumn("host", host)


def host_references(pages: DataFrame, most: int = REFERENCES) -> DataFrame:
    """(host, refs array<binary>): the most frequent skeletons of each host, at most `most`."""
    hosted = with_host(pages).filter("host <> '' and html is not null").select("host", "html")

    def run(batches):
        for b in sliced(batches):
            shapes = [shape_of(parse(page)) for page in b.column(1).to_pylist()]
            keys = [_shape_key(x) for x in shapes]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(keys, pa.int64()), pa.array(shapes, pa.binary())], names=["host", "key", "shape"])

    seen = hosted.mapInArrow(returning(run), "host string, key bigint, shape binary").groupBy("host", "key").agg(F.count("*").alias("n"), F.min("shape").alias("shape"))
    rank = F.row_number().over(W.partitionBy("host").orderBy(F.desc("n"), "key"))  # cut to `most` before the shuffle
    best = seen.withColumn("rank", rank).filter(F.col("rank") <= most)
    return best.groupBy("host").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "shape"))), lambda x: x["shape"]).alias("refs"))


def by_host(pages: DataFrame, hosts: DataFrame, column: str) -> DataFrame:
    """pages with a column of their host; a small table of hosts is broadcast, a larger one joined by
    shuffle, where Spark splits large hosts."""
    size = hosts.agg(F.sum(F.length(F.to_json(F.struct(F.col(column)))) + F.length("host"))).head()[0] or 0
    return pages.join(F.broadcast(hosts) if size <= BROADCAST_BYTES else hosts.hint("merge"), "host", "left")


def induce_wrappers(pages: DataFrame, references: DataFrame) -> DataFrame:
    """(host, template array<bigint>) of hosts with template nodes."""
    hosted = by_host(with_host(pages).filter("host <> '' and html is not null").select("host", "html"), references, "refs")

    def run(batches):
        aligner = Aligner()
        for b in sliced(batches):
            rows, counts = [], []
            for page, refs in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                root = parse(page)
                name = name_of(root)
                shape = shape_of(root)
                found = set(entries(root, aligner.paths(shape, refs or []), _shape_key(shape)).values())
                seen = [(node, entry, name) for node, entry in found] + [(node, 0, name) for node in {p for p, _ in found}]
                rows += seen
                counts.append(len(seen))
            index = pa.array(np.repeat(np.arange(b.num_rows), counts), pa.int64())
            columns = np.array(rows, np.int64).reshape(-1, 3).T
            yield pa.RecordBatch.from_arrays([b.column(0).take(index), *map(pa.array, columns)], names=["host", "node", "entry", "name"])

    # entry 0 stands for any text at the node
    seen = hosted.select("host", "html", "refs").mapInArrow(returning(run), "host string, node bigint, entry bigint, name bigint")
    per = seen.distinct().groupBy("host", "node", "entry").agg(F.count("*").alias("n")).filter(F.col("n") >= LEAST)
    per = checkpointed(per)
    pages_of = per.filter("entry = 0").select("host", "node", F.col("n").alias("pages"))
    same = per.filter("entry <> 0").join(pages_of, ["host", "node"]).filter(F.col("n") >= CONSTANT * F.col("pages"))
    return same.groupBy("host").agg(F.collect_set("entry").alias("template"))


def _shape_key(shape: bytes) -> int:
    return int.from_bytes(xxhash.xxh3_64_digest(shape), "big", signed=True)


def extract_main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) of every page."""
    small_batches(pages.sparkSession)
    references = checkpointed(host_references(pages))
    templates = induce_wrappers(pages, references)
    wrappers = checkpointed(references.join(templates, "host").select("host", F.struct("refs", "template").alias("wrapper")))
    src = with_host(pages.select("page_id", "url", text_or_empty("html").alias("html")))
    src = by_host(src, wrappers, "wrapper").select("page_id", "url", "html", "wrapper.refs", "wrapper.template")
    id_type = pages.schema["page_id"].dataType.simpleString()

    def run(batches):
        aligner = Aligner()
        for b in sliced(batches):
            out = []
            for page, refs, template in zip(*(b.column(i).to_pylist() for i in (2, 3, 4)), strict=True):
                root, known = parse(page), None
                if template:
                    shape = shape_of(root)
                    known = entries(root, aligner.paths(shape, refs), _shape_key(shape))
                out.append("\n".join(blocks(root, frozenset(template or ()), known)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.string())], names=["page_id", "url", "text"])

    return src.mapInArrow(returning(run), f"page_id {id_type}, url string, text string")


def op2_query(pages: DataFrame) -> DataFrame:
    return extract_main_text(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
