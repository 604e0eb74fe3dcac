"""Main text of web pages by wrapper induction.

1. Every page becomes a tree of its elements. Pages are grouped by host; the pages of hosts with one
   distinct page are grouped by the last two labels of their host, those that are still alone by
   nothing. The reference page of a group is the one with the least hash of its id.
2. Each page's tree is aligned with the reference tree of its group by simple tree matching. For each
   reference node it is counted how many pages have a node that is matched to it and has the
   same text (digits aside), and how much text the nodes matched to it hold. Pages of a group whose texts are
   equal before a template is applied (copies, mirrors, one article under many urls) count once.
3. Nodes that stay constant are template; nodes that vary, and those that the reference lacks, are slots.
4. The group's content slot is found by descending the reference tree from its root: while a node holds
   nothing but boxes, and one of them has at least half of the varying text that all pages have in the node,
   that box is next. A node that holds headings, paragraphs, lists or bare text that vary is the slot.
5. A page's text is what its node that is matched to the slot holds, without the template nodes in it (headings, cells, list items
   and inline elements are no such nodes by themselves: they belong to what varies around them), without
   elements that HTML itself gives another role (navigation, asides, footers, forms, scripts and the like, ARIA
   roles, hidden ones), and without captioned records: a box in the slot whose first text is constant and the
   rest of which is a list of alike records of several parts, or of links only (reader comments, related links).
   A page without such a node gets its slot by the same descent over its own text.

No names of classes or ids are interpreted; they only tell which nodes may be matched. So an advert inside the
article that varies from page to page and has no element or role of its own stays.

Constancy is a share of the pages other than the reference, to which half a page without the node is added, so
that few pages prove less: for the descent half of them is enough (1 of 1, 2 of 2, 2 of 3 others), inside the slot
`article_share` (0.9 by 5 of 5 and 9 of 9, not by 4 of 4).

Reference pages and templates are one row a group. They are broadcast if their measured size is at most
`max_broadcast_bytes`, else joined, where a hot group is split by the adaptive skew join, its other side being
a single row.

Blocks are the texts of block-level elements in page order. Character references are
decoded, white space in a block becomes one space, blocks are joined by a line feed.

Cases: null or empty html gives an empty text. Null and odd urls have no host: their pages are one group.
Ids may be null or repeat: pages are handled one by one. Markup that never closes is closed by what follows. Very
long and very deep pages are read whole. An empty table gives an empty result. Other columns aren't read.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quirelake.llm.common import cut, text_of

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|</([a-zA-Z][^\s/>]*)[^>]*>?|<([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)>?|[^<]+|<", re.S)
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s>]+)))?")
RAW = frozenset("script style textarea title noscript iframe template svg xmp noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "html body head address article aside blockquote center details dialog dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section summary table caption thead tbody tfoot tr td th ul".split()
)
#: What an opening element closes, up to the nearest of the elements that hold it.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
}
#: Elements and roles that HTML and ARIA define as something else than the text of a page.
DROP_TAGS = frozenset("nav aside footer form button select option input textarea script style noscript iframe template svg head title menu dialog object embed canvas audio video".split())
DROP_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar toolbar".split())
SECTIONS = frozenset("article section main".split())  # a header in one of these is its own, else the page's
BOXES = frozenset("#root html body div section article main center".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: What can be template inside the slot; a constant heading, cell, list item or inline element belongs to what varies around it.
CLOSED = BLOCK - HEADINGS - frozenset("#root html body caption thead tbody tfoot tr td th li dt dd figcaption summary".split())


class Node:
    __slots__ = ("tag", "key", "kids", "parts", "drop", "inside", "shape", "sum", "loose", "size")

    def __init__(self, tag: str, key: str = "", drop: bool = False, inside: bool = False):
        self.tag, self.key, self.drop, self.inside = tag, key, drop, inside  # inside: lies in a section
        self.kids: list[Node] = []  # without dropped ones
        self.parts: list = []  # strings and elements in page order
        self.sum, self.loose, self.size = 0, 0, 0  # checksums of the text, as it is and with digits aside, and its length


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): entities.unescape(m[2] or m[3] or m[4] or "") for m in _ATTR.finditer(raw)} if raw.strip() else {}


def parse(html: str) -> Node:
    """The element tree of a page. Texts are decoded; scripts, styles and the like have none."""
    root = Node("#root", "#root")
    stack = [root]
    at, n = 0, len(html)
    while at < n:
        m = _TOKEN.match(html, at)
        at = m.end()
        closing, opening = m[1], m[2]
        if closing:
            tag = closing.lower()
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
                if stack[k].tag in BLOCK and tag not in BLOCK:
                    break  # a stray inline end doesn't close a block
        elif opening:
            tag = opening.lower()
            attrs = _attributes(m[3])
            words = sorted(set(f"{attrs.get('class', '')} {attrs.get('id', '')}".split()))
            role = attrs.get("role", "").lower()
            node = Node(tag, " ".join([tag, *words]))
            node.drop = tag in DROP_TAGS or role in DROP_ROLES or "hidden" in attrs or attrs.get("aria-hidden") == "true"
            if tag in BLOCK:  # a block ends an open paragraph and what is open in it
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag == "p":
                        del stack[k:]
                        break
                    if stack[k].tag in BLOCK:
                        break
            if tag in CLOSES:
                ends, holders = CLOSES[tag]
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag in holders:
                        break
                    if stack[k].tag in ends:
                        del stack[k:]
                        if tag != "tr":
                            break
            top = stack[-1]
            node.inside = top.inside or tag in SECTIONS
            node.drop = node.drop or tag == "header" and not node.inside
            if not node.drop:
                top.kids.append(node)
            top.parts.append(node)
            if tag in RAW:
                end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(html, at)
                at = end.end() if end else n
            elif tag not in VOID and not m[0].endswith("/>") or tag in BLOCK and tag != "hr":
                stack.append(node)
        elif html[m.start()] != "<" or m[0] == "<":
            stack[-1].parts.append(entities.unescape(m[0]))
    _measure(root)
    return root


_DIGITS = re.compile(r"\d+")


def _measure(root: Node) -> None:
    """Checksums of elements and texts, white space aside, and lengths of texts; from the leaves up, dropped elements left out."""
    for x in reversed(numbered(root)):
        c = d = zlib.crc32(x.tag.encode())
        n = 0
        for p in x.parts:
            if isinstance(p, str):
                if t := " ".join(p.split()):
                    c = zlib.crc32(t.encode("utf-8", "replace"), c)
                    d = zlib.crc32(_DIGITS.sub("0", t).encode("utf-8", "replace"), d)
                    n += len(t)
            elif not p.drop:
                c = zlib.crc32(p.sum.to_bytes(4, "little"), c)
                d = zlib.crc32(p.loose.to_bytes(4, "little"), d)
                n += p.size
        x.sum, x.loose, x.size = c, d, n


def blocks(node: Node, skip=lambda node: node.drop) -> list[str]:
    """Texts of the blocks under a node, without what skip tells."""
    out: list[str] = []
    line: list[str] = []

    def end() -> None:
        text = " ".join("".join(line).split())
        if text:
            out.append(text)
        line.clear()

    todo: list = [node]
    while todo:
        x = todo.pop()
        if x is None:
            end()
        elif isinstance(x, str):
            line.append(x)
        elif x.tag == "br":
            line.append(" ")
        elif not skip(x):
            if x.tag in BLOCK or x.tag == "#root":
                end()
                todo.append(None)
            todo += reversed(x.parts)
    end()
    return out


def numbered(root: Node) -> list[Node]:
    """Nodes in page order; a node's number is its place."""
    out, todo = [], [root]
    while todo:
        x = todo.pop()
        out.append(x)
        todo += reversed(x.kids)
    return out


def match(page: Node, ref: Node, most_cells: int = 1 << 20) -> list[tuple[Node, Node]]:
    """Matched pairs of the two trees by simple tree matching: roots must have the same label, children are
    matched in order so that most nodes match. Lists of children are aligned whole, however long they are:
    a table of more than most_cells is made again in halves of its rows as its way back is followed, so that about
    that many cells and a row for each halving are held. Equal subtrees at the end of both lists and equal leaves at
    their start are matched at once, which loses nothing. Weights are made by generators that ask for the weights below
    them, so that depth costs no call stack."""
    ids: dict = {}
    tags: list[str] = []
    kids: list[tuple] = []  # of each shape: labels of a subtree, without texts
    size: list[int] = []
    memo: dict = {}

    def shape(root: Node) -> None:
        for x in reversed(numbered(root)):
            key = x.key, tuple(k.shape for k in x.kids)
            if key not in ids:
                ids[key] = len(ids)
                tags.append(x.key)
                kids.append(key[1])
                size.append(1 + sum(size[k] for k in key[1]))
            x.shape = ids[key]

    def ends(a: tuple, b: tuple) -> tuple[int, int]:
        n = min(len(a), len(b))
        i = j = 0
        while i < n and a[i] == b[i] and not kids[a[i]]:
            i += 1
        while j < n - i and a[-1 - j] == b[-1 - j]:
            j += 1
        return i, j

    def weights(b: tuple):
        """By shape its weights against all of b."""
        kinds, at = np.unique(np.array(b, np.int64), return_inverse=True)
        rows: dict = {}

        def row(s: int):
            if s not in rows:
                if (len(rows) + 1) * len(b) > most_cells:
                    rows.clear()
                found = []
                for t in kinds.tolist():
                    w = known(s, t)
                    found.append((yield s, t) if w is None else w)
                rows[s] = np.array(found, np.int64)[at]
            return rows[s]

        return row

    def below(best: np.ndarray, w: np.ndarray) -> np.ndarray:
        out = best.copy()
        np.maximum(out[1:], best[:-1] + w, out=out[1:])
        return np.maximum.accumulate(out)

    def total(a: tuple, b: tuple):
        i, j = ends(a, b)
        out = i + sum(size[s] for s in a[len(a) - j :])
        a, b = a[i : len(a) - j], b[i : len(b) - j]
        if a and b:
            row, best = weights(b), np.zeros(len(b) + 1, np.int64)
            for s in a:
                best = below(best, (yield from row(s)))
            out += int(best[-1])
        return out

    def known(s: int, t: int) -> int | None:
        """The weight of two shapes, if it needn't be worked out."""
        if tags[s] != tags[t]:
            return 0
        if s == t:
            return size[s]
        return memo.get((s, t)) if kids[s] and kids[t] else 1

    def answer(asker):
        """Runs a generator, and those for the weights that it and they ask for."""
        stack, value = [(None, asker)], None
        while True:
            try:
                pair = stack[-1][1].send(value)
                stack.append((pair, total(kids[pair[0]], kids[pair[1]])))
                value = None
            except StopIteration as done:
                pair, _ = stack.pop()
                if pair is None:
                    return done.value
                value = 1 + done.value
                if len(memo) >= most_cells:
                    memo.clear()
                memo[pair] = value

    def aligned(a: tuple, b: tuple):
        i, j = ends(a, b)
        out = [(k, k) for k in range(i)] + [(len(a) - k, len(b) - k) for k in range(1, j + 1)]
        a, b = a[i : len(a) - j], b[i : len(b) - j]
        if not a or not b:
            return out
        row, n = weights(b), len(b)
        todo = [(0, len(a), np.zeros(n + 1, np.int64))]  # rows from, to, the best of the row before them
        while todo and n:
            lo, hi, best = todo.pop()
            best = best[: n + 1]
            if hi - lo > 1 and (hi - lo) * (n + 1) > most_cells:
                mid, first = (lo + hi) // 2, best
                for k in range(lo, mid):
                    best = below(best, (yield from row(a[k]))[:n])
                todo += [(lo, mid, first), (mid, hi, best)]
                continue
            table = [best]
            for k in range(lo, hi):
                table.append(below(table[-1], (yield from row(a[k]))[:n]))
            k = hi
            while k > lo and n:
                w = (yield from row(a[k - 1]))[n - 1]
                if w and table[k - lo][n] == table[k - lo - 1][n - 1] + w:
                    out.append((i + k - 1, i + n - 1))
                    k, n = k - 1, n - 1
                elif table[k - lo][n] == table[k - lo - 1][n]:
                    k -= 1
                else:
                    n -= 1
        return out

    if page.key != ref.key:
        return []
    shape(page)
    shape(ref)
    out, todo = [], [(page, ref)]
    while todo:
        x, y = todo.pop()
        out.append((x, y))
        if x.shape == y.shape:
            todo += zip(x.kids, y.kids, strict=True)
        elif x.kids and y.kids:
            todo += [(x.kids[i], y.kids[j]) for i, j in answer(aligned(kids[x.shape], kids[y.shape]))]
    return out


FRAME = frozenset("#root html body".split())


class Wrapper:
    """A group's reference page with what its pages have in common: by id() of a node of the reference
    the share of pages in which it is constant, captions that are constant, and the slot."""

    def __init__(self, tree: Node, tally: list[tuple[int, int, int, int, int]], pages: int, article_share: float):
        """tally: of each reference node its number, the pages that have it, those where its text is the same but for
        digits, those where it is the same, and the characters that all pages have in it."""
        nodes = numbered(tree)
        held = {id(k): x for x in nodes for k in x.kids}
        others = pages - 0.5
        self.tree, self.template, self.captions = tree, set(), set()
        met, loose, equal, mass = ({id(nodes[row[0]]): row[k] for row in tally} for k in range(1, 5))
        constant = set()
        for x in nodes:
            if pages < 2 or x.tag in FRAME or not x.size or id(x) not in equal:
                continue
            share = (equal[id(x)] - 1) / others
            if share >= 0.5:
                constant.add(id(x))
            if share >= article_share and x.tag in CLOSED:
                self.template.add(id(x))
            if (loose[id(x)] - 1) / max(met.get(id(held[id(x)]), pages) - 0.5, 0.5) >= 0.5:  # of the pages that have the box
                self.captions.add(id(x))
        self.fixed = {x.sum for x in nodes if id(x) in constant}
        self.slot = content_slot(tree, mass, constant, equal)


def content_slot(root: Node, mass: dict[int, float], constant: set[int], times: dict[int, int]) -> Node:
    """mass: by id() of a box all the text in it; of that the constant nodes under it, as often as they are met, are
    taken off. Other nodes count with their own text."""
    left: dict[int, float] = {}
    for x in reversed(numbered(root)):
        fixed = sum(left[~id(k)] for k in x.kids)
        if id(x) in constant:
            fixed = float(x.size * times.get(id(x), 1))
        left[~id(x)] = fixed  # constant text in x
        left[id(x)] = 0.0 if id(x) in constant else max(0.0, mass.get(id(x), x.size) - fixed)
    x = root
    while True:
        kids = [k for k in x.kids if left[id(k)] > 0]
        bare = any(isinstance(p, str) and p.strip() for p in x.parts)
        if not kids or bare or any(k.tag not in BOXES for k in kids):
            return x
        most = max(kids, key=lambda k: left[id(k)])
        if 2 * left[id(most)] < left[id(x)]:
            return x
        x = most


def _captioned_records(x: Node, captions: set[int]) -> bool:
    """x starts with a constant caption; the rest, if any, are alike records without headings, of several parts each or of one link."""
    kids = [k for k in x.kids if k.size]
    if not kids or id(kids[0]) not in captions or any(isinstance(p, str) and p.strip() for p in x.parts):
        return False
    rest = kids[1:]
    inner = [k for k in rest[0].kids if k.size] if len(rest) == 1 and rest[0].tag in ("ul", "ol", "div") else []
    return _alike_records(rest) or bool(inner) and _alike_records(inner)


def _alike_records(rest: list[Node]) -> bool:
    def record(y: Node) -> bool:
        parts = [k for k in y.kids if k.size]
        linked = len(parts) == 1 and parts[0].tag == "a" and parts[0].size == y.size
        return linked or len(parts) > 1 and not any(k.tag in HEADINGS for k in numbered(y))

    return len({k.key for k in rest}) < 2 and all(y.tag in ("li", "div", "article") and record(y) for y in rest)


def main_text(root: Node, wrapper: Wrapper | None = None, pairs: list[tuple[Node, Node]] = ()) -> str:
    """pairs: nodes of the page with those of the wrapper's reference."""
    template, captions, top = set(), set(), None
    for x, y in pairs:
        if id(y) in wrapper.template and x.sum == y.sum:
            template.add(id(x))
        if id(y) in wrapper.captions and x.loose == y.loose:
            captions.add(id(x))
        if y is wrapper.slot and x.sum not in wrapper.fixed:  # labels alone may match a node to one that is template elsewhere
            top = x
    if top is None or top.tag in FRAME:
        top = content_slot(root, {}, template, {})
    return "\n".join(blocks(top, lambda x: x.drop or id(x) in template or x.tag in BOXES and x is not top and _captioned_records(x, captions)))


HOST = r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)"


def _with(rows: DataFrame, side: DataFrame, key: str, max_broadcast_bytes: int, size: Column) -> DataFrame:
    """rows joined by key with side, which has one row a key; broadcast only below a measured size."""
    total = side.agg(F.sum(size + 64)).first()[0] or 0
    return rows.join(F.broadcast(side) if total <= max_broadcast_bytes else side, key)


class _Trees:
    """Parsed reference pages of the last groups."""

    def __init__(self, make, most: int = 256):
        self.make, self.most, self.kept = make, most, {}

    def of(self, key: str, *given):
        if key not in self.kept:
            if len(self.kept) >= self.most:
                self.kept.clear()
            self.kept[key] = self.make(*given)
        return self.kept[key]


def _evidence(most_seen: int = 1 << 18):
    """A row for each page: its group, a hash of its text without a template, and of the reference nodes that it has those that are boxes or
    have the same text; node -1 is the page. What a task still remembers of the same group with the same nodes is left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = _Trees(lambda ref: (lambda tree: (tree, {id(x): k for k, x in enumerate(numbered(tree))}))(parse(ref)))
        seen: dict = {}
        for b in batches:
            rows = []
            for key, page, ref in zip(b.column(0).to_pylist(), b.column(1), b.column(2), strict=True):
                tree, number = trees.of(key, ref.as_py())
                root = parse(page.as_py())
                text = int.from_bytes(hashlib.blake2b(main_text(root).encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)
                nodes = [(-1, 2, 0)]
                for x, y in match(root, tree):
                    same = 2 if x.sum == y.sum else int(x.loose == y.loose)
                    if y.tag in BOXES or same and y.size:
                        nodes.append((number[id(y)], same, x.size))
                nodes.sort()
                if seen.get((key, text)) != nodes:
                    if len(seen) >= most_seen:
                        seen.clear()
                    seen[key, text] = nodes
                    rows.append((key, text, [{"node": n, "same": s, "chars": c} for n, s, c in nodes]))
            kinds = (pa.string(), pa.int64(), pa.list_(pa.struct([("node", pa.int32()), ("same", pa.int32()), ("chars", pa.int64())])))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kinds[k]) for k in range(3)], names=["grp", "content", "nodes"])

    return run


def _extract(article_share: float):
    def wrapper(ref: str, tally: list[dict], pages: int) -> Wrapper:
        return Wrapper(parse(ref), [(x["node"], x["met"], x["loose"], x["equal"], x["chars"]) for x in tally], pages, article_share)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = _Trees(wrapper)
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                out = []
                for key, page, ref, tally, pages in zip(part.column("grp").to_pylist(), *(part.column(c) for c in ("html", "ref", "tally", "pages")), strict=True):
                    root = parse(page.as_py())
                    w = trees.kept.get(key) or trees.of(key, ref.as_py(), tally.as_py(), pages.as_py())
                    out.append(main_text(root, w, match(root, w.tree)))
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("url"), pa.array(out, pa.string())], names=["id", "url", "text"])

    return run


def _groups(rows: DataFrame) -> DataFrame:
    """host, grp, and the host's page with the least hash of its id (h, id, url): a row a host."""
    html = F.xxhash64("html")
    hosts = rows.groupBy("host").agg(F.min(html).alias("lo"), F.max(html).alias("hi"), F.min(F.struct(F.xxhash64("id", "url").alias("h"), "id", "url")).alias("first"))
    hosts = cut(hosts.withColumn("suffix", F.regexp_extract("host", r"([^.]+\.[^.]+)\.?$", 1)))
    alone = F.col("lo") == F.col("hi")
    wide = hosts.where(alone).groupBy("suffix").agg((F.min("lo") < F.max("hi")).alias("several"))
    grp = F.when(~alone, F.concat(F.lit("h:"), "host")).when(F.coalesce("several", F.lit(False)), F.concat(F.lit("s:"), "suffix")).otherwise(F.lit("*"))
    return cut(hosts.join(wide, "suffix", "left").select("host", grp.alias("grp"), "first"))


def extract_main_text(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", article_share: float = 0.9, max_broadcast_bytes: int = 16 << 20) -> DataFrame:
    """id, url, text of every page."""
    host = F.lower(F.coalesce(F.regexp_extract(F.col(url_col), HOST, 1), F.lit("")))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), text_of(html_col).alias("html"), host.alias("host"))
    groups = _groups(rows)
    keyed = _with(rows, groups.select("host", "grp"), "host", max_broadcast_bytes, F.octet_length("host") + F.octet_length("grp"))
    least = groups.groupBy("grp").agg(F.min("first").alias("first")).select("grp", F.col("first.id").alias("rid"), F.col("first.url").alias("rurl"))
    refs = _with(keyed, least, "grp", max_broadcast_bytes, F.octet_length("grp") + F.coalesce(F.octet_length("rurl"), F.lit(0)) + 16)
    refs = refs.where(F.col("id").eqNullSafe(F.col("rid")) & F.col("url").eqNullSafe(F.col("rurl")))
    refs = cut(refs.groupBy("grp").agg(F.max("html").alias("ref")))  # a row a group
    seen = _with(keyed, refs, "grp", max_broadcast_bytes, F.octet_length("ref")).select("grp", "html", "ref")
    seen = seen.mapInArrow(_evidence(), "grp string, content long, nodes array<struct<node: int, same: int, chars: long>>")
    # copies of a text are one piece of evidence; of their nodes the most are taken, for the reference all of its own
    different = seen.groupBy("grp", "content").agg(F.max(F.struct(F.size("nodes"), "nodes")).getField("nodes").alias("nodes"))
    tally = different.select("grp", F.explode("nodes").alias("x")).groupBy("grp", "x.node").agg(
        F.count(F.lit(1)).alias("met"), F.count_if(F.col("x.same") > 0).alias("loose"), F.count_if(F.col("x.same") > 1).alias("equal"), F.sum("x.chars").alias("chars")
    )
    tally = tally.groupBy("grp").agg(F.max(F.when(F.col("node") < 0, F.col("met"))).alias("pages"), F.collect_list(F.when(F.col("node") >= 0, F.struct("node", "met", "loose", "equal", "chars"))).alias("tally"))
    template = cut(refs.join(tally, "grp"))
    joined = _with(keyed, template, "grp", max_broadcast_bytes, F.octet_length("ref") + 40 * F.size("tally")).select("grp", "id", "url", "html", "ref", "tally", "pages")
    kind = pages.schema[id_col].dataType.simpleString()
    return joined.mapInArrow(_extract(article_share), f"id {kind}, url string, text string").withColumnRenamed("id", id_col).withColumnRenamed("url", url_col)


def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = extract_main_text(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))
    return out.withColumn("n_chars", F.char_length("text").cast("long"))
