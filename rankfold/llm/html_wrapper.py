"""Main text of web pages by wrapper induction over pages of one host.

Every page is parsed once, into the texts of its block elements. Texts whose element is a menu,
header, footer, sidebar, notice, advert, form or comment section by its tag, role or class are no
content; classes do not drop the article (see ``_drop``). On pages with an ``article`` or ``main``
element only what lies inside it is content. Among the content that is left, the wrapper is found by
aligning the pages of a host:

1. Texts that stand under the same path of elements on nearly all different pages of the host, counted
   exactly, are candidates. For each one the page with most candidates, then fewest texts, is a reference page.
2. The trees of the reference pages, cut to their candidates, are merged along their Simple Tree
   Matching (the order-preserving matching of children that joins most nodes; a text joins only an
   equal text) into the template of the host. Candidates stand on three quarters of the pages, so
   a template is no larger than 4/3 of an average page, whatever number of pages the host has.
3. Every page is aligned with the template. A text that is joined to a node of the template stands in
   that slot; all others vary. A slot filled on nearly all pages, counted after alignment, is constant.
   So a wrapper text that an article repeats at another place stays there.
4. Near copies are one page: pages count by the smallest hash of the five-word shingles of their
   varying texts. If the constant slots hold more than three fifths of all words of the host's content
   (half, where articles are marked), its pages are taken for near copies and nothing is removed.
5. Constant texts go (see ``removed``). Inside an article they go only at its two ends or if a whole
   box of it is constant, and a heading goes only if what it heads goes.

Pages are never collected by host: only hashes are shuffled, summed in the tasks first, and the small
templates and slot lists are joined to the pages, broadcast only when their counted rows are few.

A host with fewer than ``MIN_PAGES`` different pages has no constant texts. A wrapper text that fewer
than three quarters of the pages hold because the others are near copies of one page is not found.
Nulls: a null html is an empty page with empty text; pages without a host are one group. Repeated rows
each get their row; ties between reference pages go to the larger hash. Very long pages are parsed in time
linear in their length. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
from collections.abc import Iterator
from typing import Any

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankfold.llm.common import broadcast_if_small, ship_by_value, written
from rankfold.llm.url_redirects import host

ship_by_value(__name__)

MIN_PAGES = 3  # of two pages none shows which of their common texts is content
CONSTANT = 0.75  # share of the pages
DEPTH = 40
SHINGLE = 5
NEAR_COPY, NEAR_COPY_ARTICLE = (3, 5), (1, 2)  # constant share of the words from which pages are near copies
BROADCAST_HOSTS = 50_000
BROADCAST_TEXTS = 200_000

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
                   r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
SPACE = re.compile(r"[\x20\x09-\x0D\xA0]+")

# Element names by their role in HTML.
RAW = set("script style textarea title noscript template iframe xmp noembed noframes".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span strike strong "
             "sub sup time tt u var nobr ruby rt rp center".split())
DROPPED = set("head nav header footer aside form button select option optgroup datalist fieldset legend label output "
              "dialog menu svg math canvas audio video object applet map progress meter".split())
ENDED_BY = {  # an open element that a start tag ends
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"},
}
ENDS_P = set("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 "
             "h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
SCOPE = set("table ul ol dl article section div body html main".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
BOXES = set("div section aside".split())
ROLES = set("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar".split())
# Class and id words of what is not the article.
MARKS = set("ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner menu nav navbar "
            "navigation topnav subnav breadcrumb breadcrumbs sidebar aside widget footer header masthead cookie cookies consent gdpr "
            "notice notices alert popup modal overlay newsletter subscribe subscription signup login share sharing social "
            "related recommended comment comments commentlist disqus replies reply respond pagination pager toolbar "
            "copyright legal disclaimer skip search form".split())


STATES = set("no not has have with without hide is".split())


class Node:
    __slots__ = ("key", "tag", "children", "texts", "dropped", "marked", "main", "holds", "parent", "depth", "place", "header")

    def __init__(self, key, tag, parent, dropped, marked, main):
        self.key, self.tag, self.parent, self.dropped, self.marked, self.main = key, tag, parent, dropped, marked, main
        self.children, self.texts, self.depth, self.holds = [], [], parent.depth + 1 if parent else 0, False
        self.place = self  # the element of the tree that holds its texts
        self.header = tag == "header" or parent is not None and parent.header
        if main and not parent.main:  # the elements around an article
            while parent is not None and not parent.holds:
                parent.holds, parent = True, parent.parent


def _mark(attributes: dict[str, str]) -> int:
    """2 if a whole class or id is one of ``MARKS``, 1 if a word of one is, else 0. A class
    that tells a state ("has-sidebar", "no-comments") is no mark."""
    names = [w.lower() for a in ("class", "id") for w in attributes.get(a, "").split()]
    if not MARKS.isdisjoint(names):
        return 2
    words = [re.split("[_-]+", w) for w in names]
    return int(any(w[0] not in STATES and not MARKS.isdisjoint(w) for w in words))


def _drop(nodes: list[Node]) -> None:
    """Apply the marks to the elements of a page, in page order, and hand drops down.

    An article is not dropped by its own marks, nor what lies around it by a word of a class
    or id; by a whole one only if the page has another article. Headings and sections of an
    article go by a whole class or id only."""
    fixed = [n.dropped for n in nodes]
    for whole_around in (True, False):
        for n, own in zip(nodes, fixed):
            if n.main and not n.parent.main:
                marked = False
            elif n.holds:
                marked = whole_around and n.marked == 2
            elif n.main and (n.tag == "section" or n.tag in HEADINGS):
                marked = n.marked == 2
            else:
                marked = n.marked > 0
            n.dropped = n.parent.dropped or own or marked
        if any(n.main and not n.dropped for n in nodes):
            return


def _role(tag: str, attributes: dict[str, str], parent: Node) -> tuple[str, bool, int, bool]:
    """(key, dropped by tag or role, mark, main) of an element."""
    first = re.sub(r"\d+", "", attributes.get("class", "").split(" ")[0])[:40]
    key = f"{tag}.{first}" if first else tag
    role = attributes.get("role", "").lower()
    marked = 0 if tag in ("html", "body", "main") else _mark(attributes)
    hidden = "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true" or "display:none" in attributes.get("style", "").replace(" ", "").lower()
    own = tag in DROPPED and not (tag == "header" and parent.main)
    main = parent.main or tag in ("article", "main") or role in ("main", "article")
    return key, own or hidden or role in ROLES, marked, main


def parse(page: str) -> tuple[Node, list[tuple[Node, str, float]]]:
    """The tree of block elements and, in page order, (element, text, share in links)."""
    root = top = Node("", "", None, False, 0, False)
    nodes: list[Node] = []
    open_: list[tuple[str, Node | None]] = []  # None: an inline element
    named: dict[str, list[int]] = {}  # places in open_ by name, of blocks, and of those that end a search
    blocks, scopes = [-1], [-1]
    pieces: list[str] = []
    linked = links = 0
    found: list[tuple[Node, str, float]] = []

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = SPACE.sub(" ", html.unescape("".join(pieces))).strip()
            if text:
                found.append((top, text, linked / max(1, sum(map(len, pieces)))))
                top.place.texts.append(text)
            pieces.clear()
        linked = 0

    def close(to: int) -> None:
        nonlocal top, links
        while len(open_) > to:
            name, node = open_.pop()
            named[name].pop()
            if name in SCOPE:
                scopes.pop()
            if node is not None:
                blocks.pop()
                flush()
                top = node.parent
            elif name == "a":
                links = max(0, links - 1)

    def opened(name: str, node: Node | None) -> None:
        named.setdefault(name, []).append(len(open_))
        if name in SCOPE:
            scopes.append(len(open_))
        if node is not None:
            blocks.append(len(open_))
        open_.append((name, node))

    def last(name: str) -> int:
        return named[name][-1] if named.get(name) else -1

    def add(text: str) -> None:
        nonlocal linked
        if text:
            pieces.append(text)
            if links:
                linked += len(text)

    at, n = 0, len(page)
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            add(page[at:])
            break
        add(page[at:lt])
        m = TOKEN.match(page, lt)
        if not m:
            add("<")
            at = lt + 1
            continue
        at = m.end()
        name = m[2] or m[5]
        if not name:
            continue
        if not m[0].endswith(">"):
            break  # the page ends inside a tag
        tag, ends = name.lower(), bool(m[1] or m[4])
        if ends:
            k = last(tag)
            if k > (blocks[-1] if tag in INLINE else -1):  # a stray end tag does not leave its block
                close(k)
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = end.end() if end else n
            continue
        if tag in VOID:
            add(" ") if tag in ("br", "wbr", "img") else flush() if tag == "hr" else None
            continue
        if tag in INLINE:
            opened(tag, None)
            links += tag == "a"
            continue
        if tag in ENDS_P and last("p") > scopes[-1]:
            close(last("p"))
        k = max(map(last, ENDED_BY.get(tag, ())), default=-1)
        if k > scopes[-1]:
            close(k)
        flush()
        attributes = {a[0].lower(): html.unescape(a[1] or a[2] or a[3]) for a in ATTRIBUTE.findall(m[3] or m[6] or "")}
        key, dropped, marked, main = _role(tag, attributes, top)
        node = Node(key, tag, top, dropped, marked, main)
        if top.depth < DEPTH:
            top.children.append(node)
        else:  # deeper elements are lines of the last one
            node.depth, node.place = DEPTH, top.place
        opened(tag, node)
        top = node
        nodes.append(node)
    close(0)
    flush()
    _drop(nodes)
    return root, found


def text_hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def path_of(node: Node) -> str:
    path, node = "", node.place
    while node is not None:
        path = f"/{node.key}{path}"
        node = node.parent
    return path


# A tree node is [key, pages, texts of the page with most, children]; a text is a leaf
# [hash, pages, 1, [], its number]; in a template, VARYING stands for what lies between candidates.
VARYING = "*"

def template_of(node: Node) -> list:
    """The elements of one page as a tree in which children of one key are one node."""
    out = [node.key, 1, len(node.texts), []]
    at = {}
    for child in node.children:
        c = template_of(child)
        if c[0] in at:
            merge(at[c[0]], c, same_page=True)
        else:
            at[c[0]] = c
            out[3].append(c)
    return out


def matching(a: list, b: list) -> int:
    """Simple Tree Matching: nodes in the largest order-preserving common top of two trees.
    Two nodes with children of which none match do not match."""
    if a[0] != b[0]:
        return 0
    below = _align(a[3], b[3])[-1][-1]
    return 0 if a[3] and b[3] and not below else 1 + below


def _align(xs: list, ys: list) -> list[list[int]]:
    best = [[0] * (len(ys) + 1) for _ in range(len(xs) + 1)]
    for i, x in enumerate(xs):
        for j, y in enumerate(ys):
            w = matching(x, y) if x[0] == y[0] else 0
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + w)
    return best


def joined(xs: list, ys: list) -> list[tuple[list | None, list | None]]:
    """The children of two nodes in order: matched ones as pairs, the others with None. Of equal
    matchings, those after the last varying place of ``xs`` are joined as late as possible, the
    others as early, so that a text that recurs between them belongs to the varying place."""
    best = _align(xs, ys)
    out, i, j = [], len(xs), len(ys)
    late = any(x[0] == VARYING for x in xs)
    while i or j:
        late = late and i > 0 and xs[i - 1][0] != VARYING
        if i and j and xs[i - 1][0] == ys[j - 1][0] and (
                late and best[i][j] == best[i - 1][j - 1] + (matching(xs[i - 1], ys[j - 1]) or -1)
                or best[i][j] > max(best[i - 1][j], best[i][j - 1])):
            i, j = i - 1, j - 1
            out.append((xs[i], ys[j]))
        elif j and (not i or best[i][j - 1] >= best[i - 1][j]):
            j -= 1
            out.append((None, ys[j]))
        else:
            i -= 1
            out.append((xs[i], None))
    return out[::-1]


def merge(a: list, b: list, same_page: bool = False) -> None:
    """Merge tree ``b`` into ``a`` along their matching; unmatched children are kept."""
    if not same_page:
        a[1] += b[1]
        a[2] = max(a[2], b[2])
    else:
        a[2] += b[2]
    children = []
    for x, y in joined(a[3], b[3]):
        if x and y:
            merge(x, y, same_page)
        children.append(x or y)
    a[3] = children


def slots(template: list, page: list) -> Iterator[tuple[int, int]]:
    """(number in the template, number in the page) of the texts that the matching joins."""
    if len(template) == 5:
        yield template[4], page[4]
    for x, y in joined(template[3], page[3]):
        if x and y:
            yield from slots(x, y)


def shape_of(entries: list[tuple[Node, str]]) -> tuple[list, list[int]]:
    """[[parent, key], ...] of the elements around the texts, parents first, and each text's element."""
    index: dict[Node, int] = {}
    elements, at = [], []
    for node, _ in entries:
        chain, node = [], node.place
        place = node
        while node is not None and node not in index:
            chain.append(node)
            node = node.parent
        for n in reversed(chain):
            index[n] = len(elements)
            elements.append([index[n.parent] if n.parent is not None else -1, n.key])
        at.append(index[place])
    return elements, at


def tree_of(elements: list, at: list[int], hashes: list[int], kept: set[int], varying: bool = False) -> list:
    """The tree of a page's elements, cut to the texts whose hash is in ``kept``; with ``varying``,
    the other texts leave one ``VARYING`` node between them in the deepest element they share with
    a kept text."""
    root = ["", 1, 0, []]
    nodes: dict[int, list] = {0: root}

    def node(i: int) -> list:
        if i not in nodes:
            parent, key = elements[i]
            nodes[i] = [key, 1, 0, []]
            node(parent)[3].append(nodes[i])
        return nodes[i]

    around = {0}  # elements with a kept text
    for i, h in zip(at, hashes):
        while h in kept and i not in around:
            around.add(i)
            i = elements[i][0]
    for number, (i, h) in enumerate(zip(at, hashes)):
        if h in kept:
            node(i)[3].append([h, 1, 1, [], number])
        elif varying:
            while i not in around:
                i = elements[i][0]
            children = node(i)[3]
            if not children or children[-1][0] != VARYING:
                children.append([VARYING, 1, 0, []])
    return root


def leaves(tree: list) -> Iterator[list]:
    if len(tree) == 5:
        yield tree
    for child in tree[3]:
        yield from leaves(child)


def content(found: list[tuple[Node, str, float]]) -> Iterator[tuple[Node, str]]:
    """The (element, text) of a parsed page that are content by their elements: those of the
    article, or of the page if it has none."""
    open_ = [(node, text, share) for node, text, share in found if not node.dropped]
    inside = [x for x in open_ if x[0].main]
    for node, text, share in inside or open_:
        if node.tag not in HEADINGS and node.header:
            continue  # of a header of the article itself only headings are content
        if not inside and share > 0.8:
            continue  # a menu entry
        yield node, text


def main_text(page: str | None, wrapper: set[str]) -> str:
    """One page's content without the (path, text) hashes of ``wrapper``."""
    _, found = parse(page or "")
    return " ".join(text for node, text in content(found)
                    if not wrapper or f"{text_hash(path_of(node))} {text_hash(text)}" not in wrapper)


def in_batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 512) -> Iterator[pa.RecordBatch]:
    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += sum(len(v) for v in row if isinstance(v, str)) + sum(map(len, row[-1]))
        if len(held) >= size or chars > 4_000_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, chars = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


BLOCKS = "url string, host string, mark long, article boolean, tree string, nodes array<long>, hashes array<long>, texts array<string>"


def blocks(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, host, a hash of its content, whether an article is marked, and the
    content in page order (elements as JSON, and each text's path hash, hash and text)."""
    kind = pages.schema["page_id"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            id_type = b.schema.field("page_id").type
            long_list = pa.list_(pa.int64())
            schema = pa.schema([("page_id", id_type), ("url", pa.string()), ("host", pa.string()), ("mark", pa.int64()), ("article", pa.bool_()),
                                ("tree", pa.string()), ("nodes", long_list), ("hashes", long_list), ("texts", pa.list_(pa.string()))])

            def rows():
                for i, url, h, page in zip(*(b.column(c).to_pylist() for c in ("page_id", "url", "host", "html"))):
                    _, found = parse(page or "")
                    entries = list(content(found))
                    paths: dict[Node, int] = {}
                    for node, _ in entries:
                        if node not in paths:
                            paths[node] = text_hash(path_of(node))
                    texts = [t for _, t in entries]
                    yield (i, url, h, text_hash("\n".join(texts)), any(node.main for node, _ in entries), json.dumps(shape_of(entries)),
                           [paths[node] for node, _ in entries], [text_hash(t) for t in texts], texts)

            yield from in_batches(rows(), schema)

    rows = pages.select("page_id", "url", host(F.coalesce("url", F.lit(""))).alias("host"), "html")
    return rows.mapInArrow(read, f"page_id {kind}, {BLOCKS}")


def induce(rows: DataFrame) -> DataFrame:
    """(host, template) of ``blocks``: the template as JSON. Hosts without candidates have none."""
    # of pages with the same text one counts, whatever its markup
    different = written(rows.groupBy("host", "mark").agg(F.min(F.struct("nodes", "hashes")).alias("s")).select("host", "mark", "s.*"),
                        "wrapper-different")
    hosts = different.groupBy("host").agg(F.count(F.lit(1)).alias("pages")).filter(F.col("pages") >= MIN_PAGES)
    texts = (different.select("host", "mark", F.size("nodes").alias("length"), F.explode(F.array_distinct(F.arrays_zip("nodes", "hashes"))).alias("s"))
             .select("host", "mark", "length", "s.*"))
    counts = texts.groupBy("host", "nodes", "hashes").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= MIN_PAGES)
    candidates = written(counts.join(hosts, "host").filter(F.col("n") >= CONSTANT * F.col("pages")).select("host", "nodes", "hashes"),
                         "wrapper-candidates")
    side = broadcast_if_small(candidates, candidates.count(), BROADCAST_TEXTS)
    held = texts.join(side, ["host", "nodes", "hashes"]).groupBy("host", "mark", "length").agg(F.collect_list(F.struct("nodes", "hashes")).alias("held"))
    best = (held.select("host", F.struct(F.size("held").alias("size"), (-F.col("length")).alias("shorter"), "mark").alias("page"), F.explode("held").alias("s"))
            .groupBy("host", "s").agg(F.max("page").alias("page")).select("host", F.col("page.mark").alias("mark")).distinct())
    wanted = written(best.join(candidates.groupBy("host").agg(F.collect_set("hashes").alias("kept")), "host"), "wrapper-references")
    side = broadcast_if_small(wanted, wanted.count(), BROADCAST_HOSTS)
    references = (rows.select("host", "mark", "nodes", "hashes", "tree").join(side, ["host", "mark"])
                  .groupBy("host", "mark").agg(F.min(F.struct("nodes", "hashes", "tree", "kept")).alias("s"))
                  .select("host", "mark", "s.hashes", "s.tree", "s.kept"))

    def template(key: tuple[Any, ...], pdf: pd.DataFrame) -> pd.DataFrame:
        out = None
        for hashes, tree, kept in pdf.sort_values("mark")[["hashes", "tree", "kept"]].itertuples(index=False):
            new = tree_of(*json.loads(tree), [int(h) for h in hashes], set(map(int, kept)), varying=True)
            if out is None:
                out = new
            else:
                merge(out, new)
        for number, leaf in enumerate(leaves(out)):
            leaf[4] = number
        return pd.DataFrame({"host": [key[0]], "template": [json.dumps(out)]})

    return references.groupBy("host").applyInPandas(template, "host string, template string")


def residue_key(texts: list[str]) -> int:
    """The smallest hash of the five-word shingles of varying texts; near copies mostly share it."""
    words = " ".join(texts).split(" ")
    runs = (" ".join(words[i:i + SHINGLE]) for i in range(max(1, len(words) - SHINGLE + 1)))
    return min(xxhash.xxh3_64_intdigest(r.encode("utf-8", "surrogatepass")) for r in runs) - (1 << 63)


def align(rows: DataFrame, templates: DataFrame) -> DataFrame:
    """The ``blocks`` of hosts with a template, with each text's slot in it (-1: none), the words
    of each text and the key by which near copies count once."""
    kind = rows.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[list, set[int]]] = {}
        for b in batches:
            placed, sizes, keys = [], [], []
            for t, tree, hashes, texts in zip(*(b.column(c).to_pylist() for c in ("template", "tree", "hashes", "texts"))):
                if t not in known:
                    if len(known) > 1000:
                        known.clear()
                    template = json.loads(t)
                    known[t] = template, {leaf[0] for leaf in leaves(template)}
                template, kept = known[t]
                own = [-1] * len(texts)
                for slot, number in slots(template, tree_of(*json.loads(tree), hashes, kept)):
                    own[number] = slot
                placed.append(own)
                sizes.append([len(x.split(" ")) for x in texts])
                keys.append(residue_key([x for x, slot in zip(texts, own) if slot < 0]))
            columns = [b.column(c) for c in ("page_id", "url", "host", "mark", "article", "tree", "texts")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(placed, pa.list_(pa.int32())), pa.array(sizes, pa.list_(pa.int64())), pa.array(keys, pa.int64())],
                names=["page_id", "url", "host", "mark", "article", "tree", "texts", "slots", "words", "key"])

    side = broadcast_if_small(templates, templates.count(), BROADCAST_HOSTS)
    return rows.drop("nodes").join(side, "host").mapInArrow(
        run, f"page_id {kind}, url string, host string, mark long, article boolean, tree string, texts array<string>, "
             "slots array<int>, words array<long>, key long")


def constant_slots(aligned: DataFrame) -> DataFrame:
    """(host, constant): the slots of a host that nearly all its different pages fill."""
    page = F.struct("key", "article", "slots", "words")
    pages = aligned.groupBy("host", "mark").agg(F.min(page).alias("s")).select("host", "s.*")
    total = F.aggregate("words", F.lit(0).cast("long"), lambda a, w: a + w)
    hosts = pages.groupBy("host").agg(
        F.count_distinct("key").alias("pages"), F.sum(total).alias("total"), F.count(F.lit(1)).alias("all"),
        F.count_if("article").alias("articles"))
    filled = (pages.select("host", "key", F.explode(F.arrays_zip("slots", "words")).alias("s")).filter("s.slots >= 0")
              .groupBy("host", F.col("s.slots").alias("slot")).agg(F.count_distinct("key").alias("n"), F.sum("s.words").alias("words")))
    found = (filled.join(hosts, "host").filter((F.col("pages") >= MIN_PAGES) & (F.col("n") >= CONSTANT * F.col("pages")))
             .groupBy("host", "total", "all", "articles").agg(F.sort_array(F.collect_list("slot")).alias("constant"), F.sum("words").alias("words")))

    def below(share: tuple[int, int]):
        return F.col("words") * share[1] <= F.col("total") * share[0]

    return found.filter(F.when(F.col("articles") * 2 >= F.col("all"), below(NEAR_COPY_ARTICLE)).otherwise(below(NEAR_COPY))).select("host", "constant")


def removed(elements: list, at: list[int], constant: list[bool], article: bool) -> list[bool]:
    """Which constant texts of a page go. Outside an article all do; inside one those before the first
    and after the last varying text, and those of a box (``BOXES``) of two texts or more that are all
    constant. A heading goes only if the text after it does, or none follows."""
    n = len(at)
    out = list(constant)
    if article:
        texts, same = [0] * len(elements), [0] * len(elements)
        for i, c in zip(at, constant):
            while i >= 0:
                texts[i] += 1
                same[i] += c
                i = elements[i][0]
        varying = [k for k in range(n) if not constant[k]] or [n]

        def boxed(i: int) -> bool:
            while i >= 0 and same[i] == texts[i]:
                if texts[i] > 1 and elements[i][1].split(".")[0] in BOXES:
                    return True
                i = elements[i][0]
            return False

        out = [c and (k < varying[0] or k > varying[-1] or boxed(at[k])) for k, c in enumerate(constant)]
    for k in range(n - 2, -1, -1):
        if out[k] and not out[k + 1] and elements[at[k]][1].split(".")[0] in HEADINGS:
            out[k] = False
    return out


def extract(aligned: DataFrame, constant: DataFrame) -> DataFrame:
    """(page_id, url, text) of aligned pages without the texts of constant slots."""
    kind = aligned.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for tree, article, texts, own, same in zip(*(b.column(c).to_pylist() for c in ("tree", "article", "texts", "slots", "constant"))):
                if same:
                    chosen = set(same)
                    gone = removed(*json.loads(tree), [s in chosen for s in own], article)
                    texts = [t for t, g in zip(texts, gone) if not g]
                out.append(" ".join(texts))
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(out, pa.string())], names=["page_id", "url", "text"])

    constant = written(constant, "wrapper-slots")
    side = broadcast_if_small(constant, constant.count(), BROADCAST_HOSTS)
    return aligned.join(side, "host", "left").mapInArrow(run, f"page_id {kind}, url string, text string")


def page_text(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text and n_chars (code points), with the wrappers of all hosts induced."""
    rows = written(blocks(pages), "wrapper-blocks")
    templates = written(induce(rows), "wrapper-templates")
    aligned = written(align(rows, templates), "wrapper-aligned")
    side = broadcast_if_small(templates.select("host"), templates.count(), BROADCAST_HOSTS)
    plain = rows.join(side, "host", "left_anti").select("page_id", "url", F.array_join("texts", " ").alias("text"))
    return plain.unionByName(extract(aligned, constant_slots(aligned))).withColumn("n_chars", F.length("text").cast("long"))
