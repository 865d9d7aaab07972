"""HTML extraction by wrapper induction over the pages of a host."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from html import unescape
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import map_batches, sent_if_small, stored

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<[!?/][^>]*>|<[a-zA-Z!/][^<>]*\Z", re.S
)
_ATTRIBUTE = re.compile(r"(class|id|role|style|hidden|aria-hidden)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
_BLOCK = re.compile(r"<(?:/?(?:p|div|article|section|main|body|html|head|h[1-6]|ul|ol|table|header|footer|nav)\b)", re.I)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr "
    # formulas are read with the text they stand in
    "math mi mo mn ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom msub msup msubsup munder mover munderover "
    "mmultiscripts mprescripts mtable mtr mtd maction menclose semantics".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea noscript iframe object template svg title annotation annotation-xml".split())
#: Of these, "/>" ends the element as in XML.
CLOSABLE = frozenset("svg object iframe annotation annotation-xml".split())
_CLOSED = re.compile(r"(?:^|[\s\"'])/\s*\Z")
#: Elements that are never part of an article, and words in class, id or role that mark such parts.
OUTSIDE = frozenset("nav footer aside form button select dialog menu head title fieldset figure-menu".split()) | RAW
TALK = frozenset("comment comments reply replies respond disqus discussion".split())
THREAD, HIDDEN = 2, 3
#: Words that say what an element is without, has, or is next to, so that the mark after them does not name it.
BESIDE = frozenset("no not non without hide hides hidden has have having with".split())
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar side menu nav navbar navigation "
    "breadcrumb breadcrumbs footer cookie cookies consent notice notices alert popup modal overlay newsletter subscribe subscription "
    "signup share sharing social related recommended recommendations comment comments reply replies respond disqus discussion widget "
    "login search skip toolbar pagination pager copyright complementary contentinfo".split()
)
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
SCOPES = frozenset("ul ol dl table body article section div main td nav".split())
#: Raw elements whose content is never text.
CODE = frozenset("script style".split())
DEEPEST = 100
#: A text is template if it fills its place in so many of the host's pages, and in so many at least.
SHARE, LEAST_PAGES = 0.8, 5
#: An element that holds so much of a page's varying text is a wrapper, whatever its name; these never are.
WRAPS = 0.9
NEVER = frozenset("nav footer button select dialog menu head title".split()) | RAW


class Node:
    __slots__ = ("tag", "parent", "kids", "outside", "place")

    def __init__(self, tag: str, parent: "Node | None", outside: int):
        # outside: by its own tag or attributes, whatever it stands in; THREAD for comments
        self.tag, self.parent, self.kids, self.outside, self.place = tag, parent, [], outside, 0


def _outside(tag: str, attributes: str, node: Node | None) -> int:
    if tag in OUTSIDE:
        return True
    if tag == "header":
        while node is not None and node.tag not in ("article", "main"):
            node = node.parent
        return node is None
    if tag in ("article", "body", "html", "main") and "omment" not in attributes:
        return False
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return HIDDEN
        if name == "style":
            if re.search(r"display\s*:\s*none", value):
                return HIDDEN
        elif mark := max(map(_marked, value.split()), default=0):
            return mark
    return 0


def _marked(token: str) -> int:
    """A class, id or role that names a part outside the article; one like no-sidebar or has-comments does not."""
    for word in re.split(r"[^a-z]+", token):
        if word in BESIDE:
            return 0
        if word in MARKS:
            return THREAD if word in TALK else 1
    return 0


def _raw_end(html: str, tag: str, at: int, ends: dict[str, list[tuple[int, int]]]) -> int:
    """Where a raw element that begins before `at` ends: after its end tag, or at once if the page has none left."""
    if tag not in ends:
        found = re.compile(f"</{re.escape(tag)}(?=[\\s/>])[^>]*>?", re.I).finditer(html)
        ends[tag] = [(m.start(), m.end()) for m in found]
    later = bisect_left(ends[tag], (at, 0))
    if later < len(ends[tag]):
        start, end = ends[tag][later]
        # As in browsers, a block of the page ends a drawing that has not been closed.
        block = _BLOCK.search(html, at, start) if tag == "svg" else None
        return block.start() if block and "<foreignobject" not in html[at : block.start()].lower() else end
    if tag in CODE:
        # Code is not text: it ends where markup of the page goes on, if it does.
        again = _BLOCK.search(html, at)
        return again.start() if again else len(html)
    return at


def parse(html: str) -> tuple[Node, list[tuple[Node, str]]]:
    """Tree of block elements, and the text blocks in page order with the element that holds each.

    Inline elements belong to the text of their block; br counts as white space. Elements nested deeper than
    DEEPEST become siblings. Unclosed and cut-off markup ends with the page.
    """
    root = node = Node("html", None, False)
    depth = 0
    blocks: list[tuple[Node, str]] = []
    pieces: list[str] = []
    ends: dict[str, list[tuple[int, int]]] = {}  # per raw element, where its end tags begin and end

    def flush() -> None:
        if pieces:
            text = " ".join(unescape("".join(pieces)).split())
            if text:
                blocks.append((node, text))
            pieces.clear()

    at, size = 0, len(html)
    while at < size:
        match = _TOKEN.search(html, at)
        if match is None:
            pieces.append(html[at:])
            break
        if match.start() > at:
            pieces.append(html[at : match.start()])
        at = match.end()
        tag = match.group(2)
        if tag is None:
            continue
        tag = tag.lower()
        if tag in INLINE:
            continue
        if tag == "br":
            pieces.append(" ")
            continue
        flush()
        if match.group(1):
            up, steps = node, 0
            while up is not None and up.tag != tag:
                up, steps = up.parent, steps + 1
            if up is not None and up.parent is not None:
                node, depth = up.parent, depth - steps - 1
            continue
        if tag in RAW:
            if tag in CLOSABLE and _CLOSED.search(match.group(3)):
                continue
            at = _raw_end(html, tag, at, ends)
            continue
        if tag in VOID or tag in ("html", "body") and node is not root:
            continue
        if node.tag == "p":
            node, depth = node.parent, depth - 1
        elif tag in CLOSES:
            up, steps = node, 0
            while up is not None and up.tag not in SCOPES and up.tag not in CLOSES[tag]:
                up, steps = up.parent, steps + 1
            if up is not None and up.tag in CLOSES[tag]:
                node, depth = up.parent, depth - steps - 1
        if tag == "html":
            continue
        if depth >= DEEPEST:
            node, depth = node.parent, depth - 1
        fresh = Node(tag, node, _outside(tag, match.group(3), node))
        node.kids.append(fresh)
        node, depth = fresh, depth + 1
    flush()
    return root, blocks


def _weight(x: Node, y: Node, memo: dict) -> int:
    """Nodes in the largest order-preserving match of two trees with equal root tags."""
    if not x.kids or not y.kids:
        return 1
    key = (id(x), id(y))
    if key in memo:
        return memo[key][0]
    a, b, head = x.kids, y.kids, 0
    # Equal leaves at both ends are matched at once.
    while head < len(a) and head < len(b) and a[head].tag == b[head].tag and not a[head].kids and not b[head].kids:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail].tag == b[-1 - tail].tag and not a[-1 - tail].kids and not b[-1 - tail].kids:
        tail += 1
    a, b = a[head : len(a) - tail], b[head : len(b) - tail]
    table = [[0] * (len(b) + 1)]
    for i, p in enumerate(a):
        last, row = table[-1], [0]
        for j, q in enumerate(b):
            best = last[j + 1] if last[j + 1] >= row[j] else row[j]
            if p.tag == q.tag:
                found = last[j] + _weight(p, q, memo)
                if found > best:
                    best = found
            row.append(best)
        table.append(row)
    memo[key] = (1 + head + tail + table[-1][-1], head, tail, table)
    return memo[key][0]


def align(page: Node, reference: Node) -> dict[int, int]:
    """Place in the reference tree of every matched node of the page, by simple tree matching."""
    memo: dict = {}
    _weight(page, reference, memo)
    placed, waiting = {}, [(page, reference)]
    while waiting:
        x, y = waiting.pop()
        placed[id(x)] = y.place
        if (id(x), id(y)) not in memo:
            continue
        _, head, tail, table = memo[id(x), id(y)]
        waiting += zip(x.kids[:head], y.kids[:head])
        if tail:
            waiting += zip(x.kids[-tail:], y.kids[-tail:])
        i, j = len(table) - 1, len(table[0]) - 1
        while i and j:
            if table[i][j] == table[i - 1][j]:
                i -= 1
            elif table[i][j] == table[i][j - 1]:
                j -= 1
            else:
                waiting.append((x.kids[head + i - 1], y.kids[head + j - 1]))
                i, j = i - 1, j - 1
    return placed


def number(root: Node) -> Node:
    waiting, n = [root], 0
    while waiting:
        node = waiting.pop()
        node.place, n = n, n + 1
        waiting += reversed(node.kids)
    return root


def text_mark(text: str) -> int:
    data = text.encode("utf-8", "surrogatepass")
    return crc32(data) << 24 | len(data) & 0xFFFFFF


def inside_blocks(blocks: list[tuple[Node, str]], template: list[bool]) -> list[int]:
    """Blocks in no element that is outside.

    An element that holds nearly all varying text of a page without any other article is a wrapper and not outside;
    comments count as one only if nothing that varies is left without them.
    """
    held: dict[int, int] = {}
    total, article = 0, False
    for (node, text), fixed in zip(blocks, template):
        if fixed:
            continue
        total += len(text)
        within = marked = False
        while node is not None:
            if node.outside:
                held[id(node)] = held.get(id(node), 0) + len(text)
                marked = True
            within = within or node.tag in ("article", "main")
            node = node.parent
        article = article or within and not marked

    def out(node: Node | None, most: int) -> bool:
        while node is not None:
            wraps = node.outside <= most and node.tag not in NEVER and held.get(id(node), 0) >= WRAPS * total > 0
            if node.outside and not wraps:
                return True
            node = node.parent
        return False

    for most in (0,) if article else (1, THREAD):
        inside = [i for i, (node, _) in enumerate(blocks) if not out(node, most)]
        if any(not template[i] for i in inside):
            break
    return inside


def main_text(root: Node, blocks: list[tuple[Node, str]], template: list[bool]) -> str:
    """Blocks of the main slot: the largest article or main element, else the lowest element with most of the text that varies.

    Template blocks inside the slot go, unless they are most of it: then pages of the host repeat one article.
    """
    inside = inside_blocks(blocks, template)
    weigh: dict[int, int] = {}
    nodes: dict[int, Node] = {}
    total = 0
    for i in inside:
        node, text = blocks[i]
        size = len(text) * (0 if template[i] else 16) + len(text)
        total += size
        while node is not None:
            weigh[id(node)] = weigh.get(id(node), 0) + size
            nodes[id(node)] = node
            node = node.parent
    slot = root
    for tag in ("article", "main"):
        found = [k for k, n in nodes.items() if n.tag == tag]
        if found:
            slot = nodes[max(found, key=weigh.__getitem__)]
            break
    else:
        while True:
            lower = [k for k in slot.kids if weigh.get(id(k), 0) >= 0.8 * total and k.kids]
            if not lower:
                break
            slot = lower[0]
    kept = []
    for i in inside:
        node = blocks[i][0]
        while node is not None and node is not slot:
            node = node.parent
        if node is slot:
            kept.append(i)
    varying = [i for i in kept if not template[i]]
    if 2 * sum(len(blocks[i][1]) for i in varying) >= sum(len(blocks[i][1]) for i in kept):
        kept = varying
    return "\n\n".join(blocks[i][1] for i in kept)


class References:
    """Parsed reference trees of the hosts of one task; the last few hundred are kept."""

    def __init__(self):
        self.known: dict[str, Node] = {}

    def get(self, host: str, html: str) -> Node:
        if host not in self.known:
            if len(self.known) >= 256:
                self.known.clear()
            self.known[host] = number(parse(html)[0])
        return self.known[host]


def extract_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) of every row of pages (page_id, url, html): the main text, blocks joined by two line feeds.

    Each page's tree is aligned with that of a reference page of its host, the one with the lowest hash. A text
    that fills its place in at least SHARE of the host's aligned pages, and in LEAST_PAGES at least, is template;
    the counts are over all pages. Varying slots outside navigation, headers, footers, asides, forms, adverts,
    notices and comments (by element, class, id or role) are content, and so is what holds nearly all varying text
    of a page whatever its name, as a form around the page. A class like no-sidebar or has-comments marks nothing. Null and empty html give an empty text; a
    null or odd url is a host of its own; repeated rows and ids stay as they are; other columns are passed over.

    What is counted per host is one row per place and text, added up before the shuffle; what a page is given is
    the reference page and the template of its host. While these are small together they are sent to the pages;
    beyond that both are shuffled by host, and adaptive execution splits a host with a third of all pages.
    """
    host = F.lower(F.coalesce(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1), F.lit("")))
    rows = pages.select("page_id", "url", F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"), host.alias("host"))
    rows = rows.withColumn("mark", F.xxhash64("html"))
    lowest = stored(rows.groupBy("host").agg(F.min("mark").alias("mark")))
    references = rows.join(sent_if_small(lowest, F.length("host") + 32), ["host", "mark"], "left_semi").select("host", "html").dropDuplicates(["host"])
    references = stored(references.withColumnRenamed("html", "reference"))

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = References()
        for batch in batches:
            hosts, at, texts = [], [], []
            for host, html, reference in zip(*(batch.column(i).to_pylist() for i in range(3))):
                root, blocks = parse(html)
                placed = align(root, known.get(host, reference))
                seen = {(placed[id(n)], text_mark(t)) for n, t in blocks if id(n) in placed}
                for place, text in seen:
                    hosts.append(host)
                    at.append(place)
                    texts.append(text)
            yield pa.RecordBatch.from_pydict({"host": pa.array(hosts, pa.string()), "place": pa.array(at, pa.int64()), "text": pa.array(texts, pa.int64())})

    paired = rows.select("host", "html").join(sent_if_small(references, F.octet_length("reference") + 64), "host")
    counted = paired.mapInArrow(places, "host string, place bigint, text bigint").groupBy("host", "place", "text").agg(F.count(F.lit(1)).alias("n"))
    sizes = stored(rows.groupBy("host").agg(F.count(F.lit(1)).alias("pages")))
    frequent = counted.where(F.col("n") >= LEAST_PAGES).join(sizes, "host").where(F.col("n") >= F.col("pages") * F.lit(SHARE))
    template = frequent.groupBy("host").agg(F.collect_list(F.struct("place", "text")).alias("template"))
    wrapped = stored(references.join(stored(template), "host", "left"))

    def extract(batch: pa.RecordBatch) -> pa.RecordBatch:
        known, marks, texts = References(), {}, []
        for html, host, reference, found in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4, 5))):
            root, blocks = parse(html)
            if host not in marks:
                marks[host] = {(m["place"], m["text"]) for m in found or []}
            constant = marks[host]
            if constant:
                placed = align(root, known.get(host, reference))
                fixed = [(placed.get(id(n)), text_mark(t)) in constant for n, t in blocks]
            else:
                fixed = [False] * len(blocks)
            texts.append(main_text(root, blocks, fixed))
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    size = F.octet_length("reference") + 64 + 32 * F.coalesce(F.size("template"), F.lit(0))
    dealt = rows.select("page_id", "url", "html", "host").join(sent_if_small(wrapped, size), "host").select("page_id", "url", "html", "host", "reference", "template")
    kind = pages.schema["page_id"].dataType.simpleString()
    return map_batches(dealt, extract, f"page_id {kind}, url string, text string")


def query(pages: DataFrame) -> DataFrame:
    return extract_pages(pages).withColumn("n_chars", F.char_length("text").cast("bigint"))
