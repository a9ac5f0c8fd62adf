"""Main text of web pages through wrappers inferred per host.

A page is a tree of elements. The wrapper of a host is a union-free pattern
over such trees: pages are folded into it one by one, aligning the children of
equal elements; where they mismatch, a run of equal groups becomes a repeated
group, an element only some pages have becomes optional, and text that differs
becomes a slot. Slots remember how much text they held, how much of it in
links, and whether it is the same on every page. From the wrapper follows the
host's main region: where text differs from page to page and stands in no link.
A page's text is what stands in that region; elements and class names of
menus, adverts and the like only cut pieces out of it.

Wrappers are folded per task first and the few partial wrappers of a host are
folded then, so a host with very many pages is no large group. No step recurses,
so the depth of a page does not matter.
"""

from __future__ import annotations

import html as references
import json
import re
from bisect import bisect_left
from collections import Counter, deque
from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import required, struct
from tessera.session import write_table

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>script|style|noscript|template|textarea|svg|iframe|title)\b(?:\"[^\"]*\"|'[^']*'|[^'\">])*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|</(?P<close>[a-z][a-z0-9:-]*)[^>]*>|<(?P<open>[a-z][a-z0-9:-]*)(?P<attributes>(?:\"[^\"]*\"|'[^']*'|[^'\">])*)>|<[!?][^>]*>|(?P<text>[^<]+|<)",
    re.S | re.I)
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span "
             "strike strong sub sup time tt u var wbr".split())
#: What an opening tag closes, if it is open inside the nearest of the containers.
CLOSES = {"p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"},
          "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"}}
BLOCKS = set("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol pre section table ul".split())
CONTAINERS = set("html body article section div main table ul ol dl nav aside header footer form blockquote fieldset tbody thead".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
#: Elements, and words of class, id or role, that are no part of an article.
OUTSIDE = set("nav header footer aside form button select head dialog menu input object".split())
OUTSIDE_WORDS = set("ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments cookie cookies "
                    "disqus footer header masthead menu nav navbar navigation newsletter notice notices popup promo related "
                    "replies share sharing sidebar social sponsored subscribe widget".split())
#: Words beside which those above only speak of a layout ("no-sidebar").
LAYOUT_WORDS = set("has layout no non not with without".split())
#: Regions of more text than this are joined, not broadcast.
BROADCAST_BYTES = 32 << 20
#: Partial wrappers that a task holds before it gives them out.
HOSTS_HELD = 1000


class Node:
    """An element of a page or a wrapper. ``quant``: "1", "?" (optional), "+"
    (repeated) or "*" (both). ``key`` is the tag and the words of class, id and
    role, after "~" if these name something outside an article. ``fixed`` is a
    hash of the text that a slot has on all of its ``pages``, None if it differs.
    Text is kept by pages only."""

    __slots__ = ("key", "children", "quant", "chars", "linked", "parts", "fixed", "pages")

    def __init__(self, key: str):
        self.key, self.children, self.quant, self.chars, self.linked, self.parts, self.fixed, self.pages = key, [], "1", 0, 0, [], None, 1

    @property
    def tag(self) -> str:
        return self.key.lstrip("~").partition(".")[0]


@lru_cache(1 << 16)
def key_of(tag: str, attributes: str) -> str:
    values = [(m[1].lower(), (m[2] or m[3] or m[4] or "").lower()) for m in ATTRIBUTE.finditer(attributes)]
    words = {w for _, value in values for w in re.split(r"[^a-z]+", value) if w}
    return "~" * names_outside(tag, values) + ".".join([tag, *sorted(words)])


def names_outside(tag: str, values: list[tuple[str, str]]) -> bool:
    """True if a whole word of class, id or role is one of ``OUTSIDE_WORDS``,
    or a compound ("cookie-bar") has one and none of ``LAYOUT_WORDS``. Headings,
    paragraphs, articles and main elements are told by whole classes and roles
    alone: an id or a compound there speaks of what they are about."""
    if tag in ("html", "body"):
        return False
    prose = tag in HEADINGS or tag in ("p", "article", "main")
    for name, value in values:
        for word in value.split():
            if word in OUTSIDE_WORDS:
                if not prose or name != "id":
                    return True
            elif not prose:
                parts = set(re.split(r"[^a-z]+", word))
                if not parts.isdisjoint(OUTSIDE_WORDS) and parts.isdisjoint(LAYOUT_WORDS):
                    return True
    return False


def outside(key: str) -> bool:
    return key[0] == "~" or key.partition(".")[0] in OUTSIDE


def digest(text: str) -> str:
    return blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).hexdigest()


@lru_cache(1 << 16)
def step(path: str, key: str) -> str:
    """Name of the path that goes on from ``path`` to a child ``key``."""
    return digest(path + key)


ROOT = ""


def parse(page: str | None) -> Node:
    """The page as a tree; text pieces stay in their element's ``parts`` in
    order with its children."""
    root = Node("#root")
    stack, opened = [root], Counter()

    def shut_from(depth: int) -> None:
        opened.subtract(n.tag for n in stack[depth:])
        del stack[depth:]

    for m in TOKEN.finditer(page or ""):
        kind = m.lastgroup
        if kind == "text":
            stack[-1].parts.append(m["text"])
        elif m["open"]:
            tag = m["open"].lower()
            shut = CLOSES.get(tag) or ({"p"} if tag in BLOCKS else None)
            if shut:
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth].tag in shut:
                        shut_from(depth)
                        break
                    if stack[depth].tag in CONTAINERS:
                        break
            node = Node(key_of(tag, m["attributes"]))
            stack[-1].parts.append(node)
            if tag not in VOID and not m["attributes"].rstrip().endswith("/"):
                stack.append(node)
                opened[tag] += 1
        elif m["close"]:
            tag = m["close"].lower()
            if not opened[tag]:
                continue
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    shut_from(depth)
                    break
                if tag in INLINE and stack[depth].tag not in INLINE:
                    break
    return root


def skeleton(page: Node) -> Node:
    """The pattern of one page: inline elements are part of the text, white
    space is left out, repeated groups are folded."""
    root = Node(page.key)
    made = [root]
    stack = [(iter(page.parts), root, False)]
    while stack:
        parts, out, linked = stack[-1]
        for part in parts:
            if isinstance(part, str):
                size = len(part) - part.count(" ")
                if size and not part.isspace():
                    slot = Node("#text")
                    slot.chars, slot.linked, slot.fixed = size, size * linked, digest(" ".join(part.split()))
                    out.children.append(slot)
                continue
            inner = out
            if part.tag not in INLINE:
                inner = Node(part.key)
                out.children.append(inner)
                made.append(inner)
            stack.append((iter(part.parts), inner, linked or part.tag == "a"))
            break
        else:
            stack.pop()
    for node in reversed(made):
        todo: deque = deque()
        node.children = fold_repeats(node.children, todo)
        merge_all(todo)
    return root


def fold_repeats(nodes: list[Node], todo: deque) -> list[Node]:
    """Runs of equal neighbours, and of equal groups of up to four different
    neighbours, as one repeated group; what is to be merged goes to ``todo``.
    Elements that begin with different things are not equal."""
    def equal(a: Node, b: Node) -> bool:
        return a.key == b.key and (not a.children or not b.children or a.children[0].key == b.children[0].key)

    for period in (1, 2, 3, 4):
        out: list[Node] = []
        for node in nodes:
            out.append(node)
            while len(out) >= 2 * period and all(equal(a, b) for a, b in zip(out[-2 * period:-period], out[-period:])):
                for a, b in zip(out[-2 * period:-period], out[-period:]):
                    todo.append((a, b, False))
                    a.quant = "*" if "?" in (a.quant, b.quant) or "*" in (a.quant, b.quant) else "+"
                del out[-period:]
        nodes = out
    return nodes


def merge(into: Node, other: Node) -> None:
    """Aligns the pattern ``other`` of further pages with the wrapper ``into``."""
    merge_all(deque([(into, other, True)]))


def merge_all(todo: deque) -> None:
    """Merges pairs (into, other, of other pages), outer ones first: a node
    has taken in all it is merged with before it is merged itself."""
    while todo:
        into, other, across = todo.popleft()
        into.chars, into.linked = into.chars + other.chars, into.linked + other.linked
        if into.fixed is None or other.fixed is None:
            into.fixed = None
        elif not across:
            into.fixed = digest(into.fixed + other.fixed)
        elif into.fixed != other.fixed:
            into.fixed = None
        into.pages = into.pages + other.pages if across else max(into.pages, other.pages)
        if into.children or other.children:
            into.children = align(into.children, other.children, todo, across)


def common(left: list[str], right: list[str]) -> list[tuple[int, int]]:
    """Places (i, j) of a common subsequence of two key lists: equal ends
    first, then the keys that either side has once, in their longest common
    order (the longest subsequence of all where no key repeats), and between
    these the same again; where no key stands once, the next equal key that
    skips no more of the right than is left over. Time grows like the lists."""
    out = []
    work = [(0, len(left), 0, len(right))]
    while work:
        a, b, c, d = work.pop()
        while a < b and c < d and left[a] == right[c]:
            out.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and left[b - 1] == right[d - 1]:
            b, d = b - 1, d - 1
            out.append((b, d))
        if a == b or c == d:
            continue
        times, other = Counter(left[a:b]), Counter(right[c:d])
        place = {right[j]: j for j in range(c, d) if other[right[j]] == 1}
        once = [(i, place[left[i]]) for i in range(a, b) if times[left[i]] == 1 and left[i] in place]
        if once:
            tops: list[int] = []
            held: list[int] = []
            back = []
            for n, (_, j) in enumerate(once):
                at = bisect_left(tops, j)
                back.append(held[at - 1] if at else -1)
                tops[at:at + 1], held[at:at + 1] = [j], [n]
            n, anchors = held[-1], []
            while n >= 0:
                anchors.append(once[n])
                n = back[n]
            for i, j in [*anchors, (a - 1, c - 1)]:
                work.append((i + 1, b, j + 1, d))
                if i >= a:
                    out.append((i, j))
                b, d = i, j
            continue
        spots: dict[str, deque] = {}
        for j in range(c, d):
            spots.setdefault(right[j], deque()).append(j)
        for i in range(a, b):
            queue = spots.get(left[i])
            while queue and queue[0] < c:
                queue.popleft()
            if queue and queue[0] - c <= max(0, (d - c) - (b - i)) + 1:
                c = queue.popleft()
                out.append((i, c))
                c += 1
    return sorted(out)


def align(left: list[Node], right: list[Node], todo: deque, across: bool) -> list[Node]:
    """Alignment of two child patterns by key; a child that one side lacks
    becomes optional."""
    out, i, j = [], 0, 0
    for x, y in [*common([n.key for n in left], [n.key for n in right]), (len(left), len(right))]:
        for node in left[i:x] + right[j:y]:
            node.quant = _both(node.quant, "?")
            out.append(node)
        if x < len(left):
            left[x].quant = _both(left[x].quant, right[y].quant)
            todo.append((left[x], right[y], across))
            out.append(left[x])
        i, j = x + 1, y + 1
    return fold_repeats(out, todo)


def _both(a: str, b: str) -> str:
    optional, repeated = any(x in "?*" for x in (a, b)), any(x in "+*" for x in (a, b))
    return "*" if optional and repeated else "?" if optional else "+" if repeated else "1"


def dump(root: Node) -> str:
    """The wrapper as JSON: its nodes in order, each with its number of children."""
    out, stack = [], [root]
    while stack:
        n = stack.pop()
        out.append([n.key, n.quant, n.chars, n.linked, n.fixed, n.pages, len(n.children)])
        stack += reversed(n.children)
    return json.dumps(out)


def load(text: str) -> Node:
    open_nodes: list[tuple[Node, int]] = []
    root = None
    for key, *held, count in json.loads(text):
        node = Node(key)
        node.quant, node.chars, node.linked, node.fixed, node.pages = held
        while open_nodes and len(open_nodes[-1][0].children) == open_nodes[-1][1]:
            open_nodes.pop()
        if open_nodes:
            open_nodes[-1][0].children.append(node)
        root = root or node
        open_nodes.append((node, count))
    return root


def main_region(wrapper: Node) -> tuple[list[str], list[str], list[str]]:
    """Paths of the elements of the host's main region, of the elements on
    the way there, and hashes of the fixed texts of other elements that stand
    on the same path as the region (plain elements without names of their own).

    A slot weighs what it holds outside links, nothing if it is the same on
    two or more pages and the host has others. The region is the smallest
    element with more than half of the weight; an article or main element on
    the way to it is taken whole, articles inside it that hold more than half
    of its weight are taken alone, and a heading beside it belongs to it. An
    element whose name speaks of something else still counts if it holds more
    than half of the text with an article, a main element or a first heading.
    """
    nodes, parent, path = [wrapper], [-1], [ROOT]
    for at, node in enumerate(nodes):  # grows on the way: by levels
        for c in node.children:
            if c.key != "#text":
                nodes.append(c)
                parent.append(at)
                path.append(step(path[at], c.key))

    def weigh(fixed_too: bool, chrome: list[bool]) -> list[int]:
        weight = [sum(max(0, c.chars - 2 * c.linked) for c in n.children
                      if c.key == "#text" and (fixed_too or c.fixed is None or c.pages < 2)) for n in nodes]
        for at in range(len(nodes) - 1, -1, -1):
            if chrome[at]:
                weight[at] = 0
            if at:
                weight[parent[at]] += weight[at]
        return weight

    tags = [n.tag for n in nodes]
    hard = [t in OUTSIDE and t != "form" for t in tags]
    holds = [t in ("article", "main", "h1") and n.key[0] != "~" for t, n in zip(tags, nodes)]
    for at in range(len(nodes) - 1, 0, -1):
        holds[parent[at]] |= holds[at] and not hard[at]
    text = weigh(True, [h or outside(n.key) and not held for h, n, held in zip(hard, nodes, holds)])
    chrome = [h or outside(n.key) and not (held and 2 * w > text[0]) for h, n, held, w in zip(hard, nodes, holds, text)]
    weight = weigh(False, chrome)
    if not weight[0]:
        weight = weigh(True, chrome)
    inner: dict[int, list[int]] = {}
    cut = [False] * len(nodes)
    for at in range(1, len(nodes)):
        cut[at] = chrome[at] or cut[parent[at]]
        inner.setdefault(parent[at], []).append(at)
    articles = [at for at, t in enumerate(tags) if t == "article" and not cut[at]]
    way = [0]
    while True:
        top = max((c for c in inner.get(way[-1], ()) if not cut[c]), key=weight.__getitem__, default=None)
        if top is None or 2 * weight[top] <= weight[0] or nodes[top].quant in "+*":
            break
        way.append(top)
    region = next((at for tag in ("article", "main") for at in way if tags[at] == tag), way[-1])
    found = [region]
    if tags[region] != "article":
        below = {region}
        for at in range(region + 1, len(nodes)):
            if parent[at] in below:
                below.add(at)
        own = [at for at in articles if at in below and (tags[parent[at]] != "article")]
        if own and 2 * sum(weight[at] for at in own) >= weight[region]:
            found = own
    if found == [region] and region and tags[region] != "article":
        found += [c for c in inner[parent[region]] if tags[c] == "h1" and not cut[c]]
    through = set()
    for at in found:
        while at > 0 and at not in through:
            through.add(at)
            at = parent[at]
    fixed = set()
    if len(found) == 1 and tags[region] != "article":
        like = {at for at in range(1, len(nodes)) if path[at] == path[region] and at != region}
        fixed |= {""} if like else set()
        for at in range(min(like, default=len(nodes)), len(nodes)):
            if at in like or parent[at] in like:
                like.add(at)
                fixed |= {c.fixed for c in nodes[at].children if c.key == "#text" and c.fixed and c.pages > 1}
    return [path[at] for at in found], [path[at] for at in sorted(through)], sorted(fixed)


def only_fixed(element: Node, fixed: set[str]) -> bool:
    """True if the element has text, and all of it is in links or among the
    given hashes."""
    some, stack = False, [element]
    while stack:
        for part in stack.pop().parts:
            if not isinstance(part, str):
                if part.tag != "a":
                    stack.append(part)
                some |= part.tag == "a"
            elif not part.isspace():
                if digest(" ".join(part.split())) not in fixed:
                    return False
                some = True
    return some


def text_of(page: Node, regions: list[str], through: list[str], fixed: list[str]) -> str | None:
    """Text blocks of a page's elements on the given paths; None if it has
    none of them. Of several elements on one path, those with nothing but links
    and the ``fixed`` texts are none of the region."""
    blocks: list[str] = []
    open_block: list[str] = []

    def close() -> None:
        text = " ".join(references.unescape("".join(open_block)).split())
        if text:
            blocks.append(text)
        open_block.clear()

    wanted, passed, known = set(regions), set(through), set(fixed)
    found = ROOT in wanted
    stack = [(iter(page.parts), ROOT, found, True)]
    while stack:
        parts, path, inside, block = stack[-1]
        for part in parts:
            if isinstance(part, str):
                if inside:
                    open_block.append(part)
                continue
            tag = part.tag
            if tag in INLINE:
                if not outside(part.key):
                    if tag == "br" and inside:
                        open_block.append(" ")
                    stack.append((iter(part.parts), path, inside, False))
                    break
                continue
            here = step(path, part.key)
            if outside(part.key) and here not in passed:
                continue
            if inside:
                close()
            now = inside or here in wanted and (tag in ("article", "main") or not known or not only_fixed(part, known))
            found |= now
            stack.append((iter(part.parts), here, now, now))
            break
        else:
            if block:
                close()
            stack.pop()
    return "\n".join(blocks) if found else None


def page_text(html: str | None, regions: list[str], through: list[str], fixed: list[str]) -> str:
    """The main text of a page by its host's regions; a page laid out in
    another way goes by the pattern of its own."""
    page = parse(html)
    text = text_of(page, regions, through, fixed)
    if text is None:
        text = text_of(page, *main_region(skeleton(page)))
    return text if text is not None else text_of(page, [ROOT], [], [])


def _wrappers(pages: DataFrame) -> DataFrame:
    """(host, regions): the main region of each host, as JSON."""
    partial, final = struct(host="string", wrapper="string"), struct(host="string", regions="string")

    def infer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Node] = {}

        def given() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array([dump(n) for n in held.values()], pa.string())],
                                             names=partial.names)
            held.clear()
            return out

        for batch in batches:
            for host, page in zip(batch.column(0).to_pylist(), batch.column(1)):
                tree = skeleton(parse(page.as_py()))
                if host in held:
                    merge(held[host], tree)
                else:
                    held[host] = tree
                if len(held) >= HOSTS_HELD:
                    yield given()
        yield given()

    def fold(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        texts = sorted(rows["wrapper"])
        whole = load(texts[0])
        for t in texts[1:]:
            merge(whole, load(t))
        return pd.DataFrame({"host": [key[0]], "regions": [json.dumps(main_region(whole))]})

    return pages.select("host", "html").mapInArrow(infer, partial).groupBy("host").applyInPandas(fold, final)


def main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars): the main text of each page.

    Blocks are separated by one newline; white space in a block is one space.
    Null and empty html give an empty text; pages without a host in their url
    share a wrapper. Repeated rows stay; an empty table gives none. Extra
    columns of any name are left out. Elements may be nested to any depth.
    """
    pages = required(pages, {"page_id": "long", "url": "string", "html": "string"})
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    pages = pages.withColumn("host", host)
    schema = struct(page_id="long", url="string", text="string", n_chars="long")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list] = {}
        for batch in batches:
            texts = []
            for page, regions in zip(batch.column(2), batch.column(3).to_pylist()):
                if regions not in known:
                    if len(known) > 10_000:
                        known.clear()
                    known[regions] = json.loads(regions)
                texts.append(page_text(page.as_py(), *known[regions]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())], names=schema.names)

    wrappers = write_table(_wrappers(pages), "wrappers")
    size = wrappers.agg(F.sum(F.octet_length("host") + F.octet_length("regions") + F.lit(64))).first()[0] or 0
    if size <= BROADCAST_BYTES:  # pages stay where they are; else the hosts meet in a join that splits hot ones
        wrappers = F.broadcast(wrappers)
    return pages.join(wrappers, "host").select("page_id", "url", "html", "regions").mapInArrow(extract, schema)
