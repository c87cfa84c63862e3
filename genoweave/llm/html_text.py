"""Main text of web pages by wrapper induction (operator 4).

A page is parsed into a tree of its block elements; runs of like siblings count as one list node. The wrapper of a host is
induced in two steps. Its tree is the alignment, by simple tree matching, of some of the host's pages. All pages are then
aligned with it, by the same matching, so that each of their elements has a slot; what stays alone has a slot by its path
below the last one that is aligned. For each slot all pages are counted, with the text they have there: a text that is on
most of the pages which have the slot is template, whatever its tag; the rest varies. The content is the smallest region
of the tree around the varying text that is not in links, and a page's text is what it has there without template.

Names (classes, roles) are hints only: they weigh in the choice of the region, and inside it a named advert or menu goes
unless it holds most of the text. Elements that are never text (scripts, forms, navigation) go by their tags.
"""

from __future__ import annotations

import html
import json
import re
from bisect import bisect_left
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genoweave.llm.common import cut

# fixed values: kinds of elements
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math object canvas select".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr input".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
LIKE = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
HOLDS = frozenset("ul ol dl table tbody thead tfoot div section article main body html nav aside header footer form".split())
NOT_TEXT = frozenset("nav header footer aside form menu button dialog head".split())
STORY = frozenset("article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PROSE = HEADINGS | frozenset("p li blockquote pre td th dd dt".split())
# fixed values: whole names that say that an element is not the story
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo sidebar side menu nav navbar navigation breadcrumb breadcrumbs header masthead footer comment comments respond replies disqus cookie "
    "cookies consent notice alert popup modal overlay newsletter subscribe signup login search share sharing social related recommended widget toolbar pagination pager copyright complementary contentinfo".split()
)

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^"'>]|"[^"]*"|'[^']*')*+)>""")
_MARK = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_DIGITS = re.compile(r"\d+")


@dataclass(frozen=True)
class WrapperParams:
    tree_pages: int = 16  # pages at most, each the first by a hash in its part, whose trees are aligned to a host's tree; all pages are counted on it
    constant_pages: int = 5  # a text is template if so many pages have it in a slot, not all of them copies,
    constant_share: float = 0.5  # and at least this share of the pages that have the slot
    share: float = 0.75  # of the varying text around it, which the region must hold
    named: float = 0.1  # weight of elements with a name of NAMES in the choice of the region
    story: float = 4.0  # weight of article and main
    depth: int = 120  # elements nested deeper are siblings
    cells: int = 250_000  # pairs of children beyond which two lists are aligned by their keys from the left
    entries: int = 200_000  # counts a task keeps before it hands them on
    broadcast_bytes: int = 32_000_000  # of wrappers; above it they travel by host, to where the pages are shuffled
    broadcast_rows: int = 100_000  # hashes of pages for the trees; above it they are joined by a shuffle
    salts: int = 64  # of a host, then


class Node:
    __slots__ = ("anchor", "digest", "key", "links", "marked", "parts", "size", "skip", "slot", "tag")

    def __init__(self, tag: str, key: str, skip: bool, marked: bool):
        self.tag, self.key, self.skip, self.marked, self.parts, self.links = tag, key, skip, marked, [], 0
        self.slot = self.anchor = self.digest = self.size = 0

    def kids(self) -> list[Node]:
        return [p for p in self.parts if p.__class__ is Node]

    def text(self) -> str:
        return " ".join("".join(p for p in self.parts if p.__class__ is str).split())


def tags(source: str) -> Iterator[tuple[int, int, re.Match | None]]:
    """begin, end and, but for comments and declarations, the match of each tag. send() a place to go on from there.

    Reads on in one direction only: a quotation mark that is never closed ends with its tag, a tag that is never closed
    with the page.
    """
    at = source.find("<")
    while at >= 0:
        end, found = at + 1, None
        if source.startswith("<!--", at):
            end = source.find("-->", at + 4)
            end = len(source) if end < 0 else end + 3
        elif source.startswith(("<!", "<?"), at):
            end = source.find(">", at)
            end = len(source) if end < 0 else end + 1
        elif re.match(r"/?[a-zA-Z]", source[at + 1 : at + 3]):
            close = source.find(">", at)
            if close < 0:
                end = len(source)
            else:
                found = _TAG.match(source, at) or _TAG.match(source[at:close].replace('"', " ").replace("'", " ") + ">")
                end = found.end() if found and found.string is source else close + 1
        else:  # a mark of less
            at = source.find("<", end)
            continue
        moved = yield at, end, found
        at = source.find("<", max(end, moved or 0))


def parse(source: str, depth: int = 120) -> Node:
    """The tree of the block elements; text of inline elements belongs to the block around them."""
    root = Node("#", "#", False, False)
    stack: list[Node] = [root]
    opened: dict[str, int] = {}
    links = at = 0
    lower = None

    def pop(i: int) -> None:
        for node in stack[i:]:
            opened[node.tag] -= 1
        del stack[i:]

    def close_up_to(kinds: set | frozenset) -> None:
        """Closes the nearest open element of these kinds, unless one that holds others is in between."""
        if any(opened.get(k) for k in kinds):
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in kinds:
                    pop(i)
                    break
                if stack[i].tag in HOLDS:
                    break

    scanner = tags(source)
    step = next(scanner, None)
    while step is not None:
        begin, end, m = step
        node, go_on = stack[-1], None
        if begin > at:
            piece = html.unescape(source[at:begin])
            node.parts.append(piece)
            if links:
                node.links += len(piece)
        at = end
        if m is not None:
            tag = m[2].lower()
            if m[1]:
                if tag == "a":
                    links = max(0, links - 1)
                elif tag not in INLINE and opened.get(tag):
                    pop(next(i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag))
                    links = 0
            elif tag in RAW:
                if not m[3].endswith("/"):
                    lower = source.lower() if lower is None else lower
                    found = lower.find(f"</{tag}", at) if len(lower) == len(source) else re.compile(f"</{tag}", re.I).search(source, at)
                    found = found if isinstance(found, int) else found.start() if found else -1
                    close = source.find(">", found) if found >= 0 else -1
                    at = go_on = len(source) if close < 0 else close + 1
            elif tag in VOID:
                if tag == "br":
                    node.parts.append(" ")
            elif tag in INLINE:
                links += tag == "a"
            else:
                links = 0
                if tag in CLOSES_P:
                    close_up_to(_P)
                if tag in LIKE:
                    close_up_to(LIKE[tag])
                names = [x for _, *v in _MARK.findall(m[3]) for x in "".join(v).split()] if "=" in m[3] else []
                key = ".".join([tag, *(_DIGITS.sub("", x) for x in names)])
                inside = any(opened.get(x) for x in STORY)
                marked = not NAMES.isdisjoint(map(str.lower, names)) and tag not in ("body", "html", "article", "main")
                child = Node(tag, key, tag in NOT_TEXT and not (tag == "header" and inside), marked)
                stack[min(len(stack), depth) - 1].parts.append(child)
                stack.append(child)
                opened[tag] = opened.get(tag, 0) + 1
        try:
            step = scanner.send(go_on)
        except StopIteration:
            step = None
    if at < len(source):
        stack[-1].parts.append(html.unescape(source[at:]))
    return root


_P = frozenset(["p"])

# --- trees and their alignment: a tree is [key, children] ------------------------------------------------------------------


def runs(nodes: list[Node]) -> list[list[Node]]:
    """Like siblings in a row, together."""
    out: list[list[Node]] = []
    for node in nodes:
        if out and out[-1][0].key == node.key:
            out[-1].append(node)
        else:
            out.append([node])
    return out


def tree_of(nodes: list[Node], p: WrapperParams) -> list:
    """The tree of like siblings, aligned with one another."""
    kids: list | None = None
    for node in nodes:
        own = [tree_of(group, p) for group in runs(node.kids())]
        kids = own if kids is None else merged(kids, own, p)
    return [nodes[0].key, kids]


#: Pairs of children up to which matches() tries all.
SMALL = 4_096


def matches(a: list, b: list) -> int:
    """Simple tree matching: the most nodes that two trees with equal roots can pair, in order and parent by parent.
    Long lists of children are paired by key from the left."""
    x, y = a[1], b[1]
    if not x or not y:
        return 1
    if len(x) * len(y) > SMALL:
        return 1 + sum(matches(x[i], y[j]) for i, j in by_key(x, y) if i is not None and j is not None)
    row = [0] * (len(y) + 1)
    for q in x:
        above, row = row, [0]
        for j, r in enumerate(y):
            row.append(max(above[j + 1], row[j], above[j] + matches(q, r) if q[0] == r[0] else 0))
    return 1 + row[-1]


def by_key(x: list, y: list) -> list[tuple[int | None, int | None]]:
    """Two lists of trees, in order, each of x with the next of y that has its key."""
    places: dict[str, list[int]] = {}
    for k, r in enumerate(y):
        places.setdefault(r[0], []).append(k)
    out: list[tuple[int | None, int | None]] = []
    j = 0
    for i, q in enumerate(x):
        at = places.get(q[0], [])
        k = bisect_left(at, j)
        if k < len(at):
            out += [(None, n) for n in range(j, at[k])] + [(i, at[k])]
            j = at[k] + 1
        else:
            out.append((i, None))
    return out + [(None, k) for k in range(j, len(y))]


def by_weight(x: list, y: list) -> list[tuple[int | None, int | None]]:
    """Two lists of trees, in order, in the pairing with most nodes."""
    n, m = len(x), len(y)
    weight = [[matches(q, r) if q[0] == r[0] else 0 for r in y] for q in x]
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = max(best[i + 1][j], best[i][j + 1], best[i + 1][j + 1] + weight[i][j] if weight[i][j] else 0)
    out: list[tuple[int | None, int | None]] = []
    i = j = 0
    while i < n and j < m:
        if weight[i][j] and best[i][j] == best[i + 1][j + 1] + weight[i][j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif best[i][j] == best[i + 1][j]:
            out.append((i, None))
            i += 1
        else:
            out.append((None, j))
            j += 1
    return out + [(k, None) for k in range(i, n)] + [(None, k) for k in range(j, m)]


def aligned(x: list, y: list, p: WrapperParams) -> list[tuple[int | None, int | None]]:
    """The pairing of two lists of trees that simple tree matching finds, with those that stay alone, in order.

    Equal beginnings and ends are paired as they are. Lists with more than `cells` pairs between them are paired by key
    from the left.
    """
    most = min(len(x), len(y))
    first = last = 0
    while first < most and x[first][0] == y[first][0]:
        first += 1
    while last < most - first and x[-1 - last][0] == y[-1 - last][0]:
        last += 1
    n, m = len(x) - last, len(y) - last
    between = by_key if (n - first) * (m - first) > p.cells else by_weight
    middle = [(None if i is None else first + i, None if j is None else first + j) for i, j in between(x[first:n], y[first:m])]
    return [(i, i) for i in range(first)] + middle + [(n + k, m + k) for k in range(last)]


def merged(x: list, y: list, p: WrapperParams) -> list:
    """Two lists of trees as one, in which aligned ones are merged in turn."""
    return [x[i] if j is None else y[j] if i is None else [x[i][0], merged(x[i][1], y[j][1], p)] for i, j in aligned(x, y, p)]


# --- slots --------------------------------------------------------------------------------------------------------------


class Slots:
    """A host's tree, its nodes numbered from 0 in order."""

    def __init__(self, tree: list):
        self.key, self.parent, self.kids, self.trees = [], [], [], []
        walk = [(tree, -1)]
        while walk:
            t, parent = walk.pop()
            number = len(self.key)
            self.key.append(t[0])
            self.parent.append(parent)
            self.kids.append([])
            self.trees.append(t[1])
            if parent >= 0:
                self.kids[parent].append(number)
            walk += [(k, number) for k in reversed(t[1])]

    def place(self, root: Node, p: WrapperParams) -> None:
        """Gives every element of a page its slot, and as anchor the slot of the last one above it that is aligned."""
        walk: list[tuple[list[Node], int | None, int, int]] = [([root], 0, 0, 0)]
        while walk:
            nodes, number, slot, anchor = walk.pop()
            for node in nodes:
                node.slot, node.anchor = slot, anchor
                groups = runs(node.kids())
                numbers: dict[int, int] = {}
                if number is not None and (kids := self.kids[number]) and groups:
                    if len(groups) == len(kids) and all(g[0].key == self.key[k] for g, k in zip(groups, kids, strict=True)):
                        numbers = dict(enumerate(kids))
                    else:
                        pairs = aligned([tree_of(g, p) for g in groups], self.trees[number], p)
                        numbers = {i: kids[j] for i, j in pairs if i is not None and j is not None}
                for i, g in enumerate(groups):
                    if (k := numbers.get(i)) is not None:
                        walk.append((g, k, k, k))
                    else:  # by its path; below 0, so that it is no number
                        walk.append((g, None, -1 - (xxhash.xxh64_intdigest(f"{slot}/{g[0].key}") >> 1), anchor))


def weigh(node: Node) -> None:
    """digest (of all text below; 0 for none) and size (its characters) of an element and of all below."""
    own = node.text()
    size, below = len(own), [own]
    for k in node.kids():
        weigh(k)
        if k.digest and not k.skip:
            size += k.size
            below.append(str(k.digest))
    node.size = size
    node.digest = (xxhash.xxh64_intdigest("\n".join(below)) >> 1 or 1) if size else 0


def live(root: Node) -> Iterator[Node]:
    """All elements but those that are never text and what is below them."""
    walk = [root]
    while walk:
        node = walk.pop()
        if not node.skip:
            yield node
            walk += node.kids()


def region(slots: Slots, mass: dict[int, float], p: WrapperParams) -> int:
    """The slot that is the smallest region around the varying text; mass: that of each slot itself."""
    n = len(slots.key)
    tag = [k.split(".")[0] for k in slots.key]
    story = [False] * n
    for i in range(1, n):
        story[i] = story[slots.parent[i]] or tag[i] in STORY
    within, whole = [0.0] * n, [0.0] * n
    for i in range(n - 1, -1, -1):
        within[i] = max(0.0, mass.get(i, 0.0)) + sum(whole[k] for k in slots.kids[i])
        skip = tag[i] in NOT_TEXT and not (tag[i] == "header" and story[i])
        named = tag[i] not in ("body", "html", "article", "main") and not NAMES.isdisjoint(slots.key[i].lower().split(".")[1:])
        whole[i] = 0.0 if skip else within[i] * (p.named if named else p.story if tag[i] in STORY else 1.0)
    at = 0
    while slots.kids[at]:
        best = max(slots.kids[at], key=lambda k: (whole[k], -k))
        if whole[best] <= 0 or whole[best] < p.share * within[at] or tag[best] in PROSE:
            break
        if any(tag[k] in HEADINGS and whole[k] > 0 for k in slots.kids[at]):
            break  # the headline belongs to the story
        at = best
    return at


def blocks(nodes: list[Node], template: set[tuple[int, int]]) -> list[str]:
    """The blocks of text below nodes, in page order, without template, what is no text, and named elements that hold less
    than half of it."""
    out: list[str] = []
    half = sum(n.size for n in nodes) / 2

    def visit(node: Node) -> None:
        line: list[str] = []

        def end() -> None:
            if text := " ".join("".join(line).split()):
                out.append(text)
            line.clear()

        for part in node.parts:
            if part.__class__ is str:
                line.append(part)
                continue
            end()
            if not (part.skip or (part.slot, part.digest) in template or part.marked and part.size < half):
                visit(part)
        end()

    for node in nodes:
        if (node.slot, node.digest) not in template:
            visit(node)
    return out


@dataclass
class Wrapper:
    slots: Slots
    region: int
    template: set[tuple[int, int]]


def main_text(source: str | None, wrapper: Wrapper | None, p: WrapperParams = WrapperParams()) -> str:
    """The page's text: in the region of its host's wrapper, or, if it has no text there, in that of its own tree."""
    if not source:
        return ""
    root = parse(source, p.depth)
    weigh(root)
    template: set[tuple[int, int]] = set()
    if wrapper is not None:
        wrapper.slots.place(root, p)
        template = wrapper.template
        if found := blocks([n for n in in_order(root) if n.slot == wrapper.region], template):
            return "\n".join(found)
        dropped = [n for n in live(root) if (n.slot, n.digest) in template and n.digest]
        for n in dropped:
            n.skip = True
    own = Slots(tree_of([root], p))
    own.place(root, p)
    mass: dict[int, float] = {}
    for n in live(root):
        mass[n.anchor] = mass.get(n.anchor, 0.0) + max(0, len(n.text()) - 2 * n.links)
    at = region(own, mass, p)
    return "\n".join(blocks([n for n in in_order(root) if n.slot == at], set()))


def in_order(root: Node) -> list[Node]:
    """The elements of live() in page order."""
    out, walk = [], [root]
    while walk:
        node = walk.pop()
        if not node.skip:
            out.append(node)
            walk += reversed(node.kids())
    return out


# --- over tables ---------------------------------------------------------------------------------------------------------


def _with_hosts(pages: DataFrame, known: DataFrame, run: Callable, schema: str, p: WrapperParams) -> DataFrame:
    """run(pages of a host and its wrapper, as an iterator of (wrapper text, batch of id, url, html, host)) over all pages.

    known (host, wrapper) is sent to all tasks if it is small enough in bytes; else pages and wrappers are dealt by host
    and salt and sorted, wrappers first, so that neither a task nor the driver ever holds many of them.
    """
    size = known.agg(F.coalesce(F.sum(F.octet_length("wrapper") + F.octet_length("host") + 64), F.lit(0)).alias("n")).first()["n"]
    if size <= p.broadcast_bytes:
        sent = pages.sparkSession.sparkContext.broadcast({r["host"]: r["wrapper"] for r in known.select("host", "wrapper").collect()})

        def near(batches):
            wrappers = sent.value
            yield from run((b, lambda h: wrappers.get(h)) for b in batches)

        return pages.mapInArrow(near, schema)
    kinds = {f.name: f.dataType for f in pages.schema}
    own = pages.withColumn("salt", F.pmod(F.xxhash64("id", "url", "html"), F.lit(p.salts))).withColumn("kind", F.lit(1)).withColumn("wrapper", F.lit(None).cast("string"))
    copies = known.select(*(F.lit(None).cast(kinds[c]).alias(c) if c != "host" else F.col("host") for c in pages.columns), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(p.salts - 1).cast("long"))).alias("salt"), F.lit(0).alias("kind"), "wrapper")
    dealt = own.unionByName(copies).repartition("host", "salt").sortWithinPartitions("host", "salt", "kind")

    def far(batches):
        last: list = [None, None]

        def each():
            for b in batches:
                kind = b.column("kind").to_numpy(zero_copy_only=False)
                hosts = {}
                if last[0] is not None:
                    hosts[last[0]] = last[1]
                for i in (kind == 0).nonzero()[0].tolist():
                    hosts[b.column("host")[i].as_py()] = last[1] = b.column("wrapper")[i].as_py()
                    last[0] = b.column("host")[i].as_py()
                yield b.filter(pa.array(kind == 1)), hosts.get

        yield from run(each())

    return dealt.mapInArrow(far, schema)


def wrappers(pages: DataFrame, params: WrapperParams = WrapperParams()) -> DataFrame:
    """host, wrapper (JSON: tree, region, template) of pages (id, url, html, host): one row per host.

    The tree is made of up to tree_pages different pages of each host, chosen by a hash; the counts behind template and
    region are those of all pages. Neither depends on how the pages are dealt to tasks.
    """
    p = params
    some = pages.filter("html <> ''").withColumn("hash", F.xxhash64("html"))
    chosen = cut(some.groupBy("host", F.pmod("hash", F.lit(p.tree_pages)).alias("part")).agg(F.min("hash").alias("hash")).select("host", "hash"))
    chosen = F.broadcast(chosen) if chosen.count() <= p.broadcast_rows else chosen
    sample = some.join(chosen, ["host", "hash"], "left_semi").groupBy("host", "hash").agg(F.first("html").alias("html"))

    def trees(table: pa.Table) -> pa.Table:
        whole = None
        for source in table.sort_by("hash")["html"].to_pylist():
            own = tree_of([parse(source, p.depth)], p)
            whole = own if whole is None else merged([whole], [own], p)[0]
        return pa.table({"host": table["host"][:1], "wrapper": [json.dumps(whole)]})

    tree = cut(sample.groupBy("host").applyInArrow(trees, "host string, wrapper string"))
    schema = "host string, slot long, anchor long, digest long, n long, chars long, links long, low long, high long"
    names = [c.split()[0] for c in schema.split(", ")]

    def count(batches):
        counts: dict[tuple, list] = {}
        slots: dict[str, Slots] = {}

        def rows():
            columns = list(zip(*((*k, *v) for k, v in counts.items()), strict=True)) or [()] * len(names)
            counts.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.string() if x == "host" else pa.int64()) for x, c in zip(names, columns, strict=True)], names=names)

        for b, wrapper in batches:
            for source, host in zip(b.column("html"), b.column("host").to_pylist(), strict=True):
                if not (source := source.as_py()):
                    continue
                if host not in slots:
                    if len(slots) > 500:
                        slots.clear()
                    slots[host] = Slots(json.loads(wrapper(host)))
                root = parse(source, p.depth)
                weigh(root)
                slots[host].place(root, p)
                seen = set()
                for node in live(root):
                    if not node.digest:
                        continue
                    own = len(node.text())
                    for digest, chars, links in ((0, 0, 0), (node.digest, own, min(node.links, own))):
                        key = (host, node.slot, node.anchor, digest)
                        c = counts.get(key)
                        if c is None:
                            c = counts[key] = [0, 0, 0, root.digest, root.digest]
                        c[1] += chars
                        c[2] += links
                        if key not in seen:
                            seen.add(key)
                            c[0] += 1
                            c[3], c[4] = min(c[3], root.digest), max(c[4], root.digest)
                if len(counts) > p.entries:
                    yield rows()
        yield rows()

    counted = _with_hosts(pages, tree, count, schema, p).groupBy("host", "slot", "anchor", "digest")
    counted = cut(counted.agg(F.sum("n").alias("n"), F.sum("chars").alias("chars"), F.sum("links").alias("links"), F.min("low").alias("low"), F.max("high").alias("high")))
    every = counted.filter("digest = 0").select("host", "slot", "anchor", F.col("n").alias("pages"))
    often = counted.filter((F.col("digest") != 0) & (F.col("n") >= p.constant_pages) & (F.col("low") < F.col("high")))
    template = cut(often.join(every, ["host", "slot", "anchor"]).filter(F.col("n") >= p.constant_share * F.col("pages")).select("host", "slot", "anchor", "digest", "chars", "links"))
    gone = template.groupBy("host", "anchor").agg(F.sum("chars").alias("less"), F.sum("links").alias("less_links"))
    held = counted.filter("slot = anchor OR chars > 0").groupBy("host", "anchor").agg(F.sum("chars").alias("chars"), F.sum("links").alias("links"))
    mass = (F.col("chars") - F.coalesce("less", F.lit(0))) - 2 * (F.col("links") - F.coalesce("less_links", F.lit(0)))
    masses = held.join(gone, ["host", "anchor"], "left").groupBy("host").agg(F.collect_list(F.struct("anchor", mass.cast("double").alias("mass"))).alias("masses"))  # one for each node of the tree
    fixed = template.groupBy("host").agg(F.collect_list(F.struct("slot", "digest")).alias("template"))  # of a slot no more than two pages have texts
    whole = tree.join(masses, "host", "left").join(fixed, "host", "left")

    def decide(batches):
        for b in batches:
            out = []
            for tree, masses, template in zip(b.column("wrapper").to_pylist(), b.column("masses").to_pylist(), b.column("template").to_pylist(), strict=True):
                tree = json.loads(tree)
                at = region(Slots(tree), {m["anchor"]: m["mass"] for m in masses or ()}, p)
                out.append(json.dumps({"tree": tree, "region": at, "template": sorted([t["slot"], t["digest"]] for t in template or ())}))
            yield pa.RecordBatch.from_arrays([b.column("host"), pa.array(out, pa.string())], names=["host", "wrapper"])

    return whole.select("host", "wrapper", "masses", "template").mapInArrow(decide, "host string, wrapper string")


def read_wrapper(value: str | None) -> Wrapper | None:
    if value is None:
        return None
    w = json.loads(value)
    return Wrapper(Slots(w["tree"]), w["region"], {tuple(t) for t in w["template"]})


def extract_text(pages: DataFrame, params: WrapperParams = WrapperParams(), id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars: one row per page, from the whole page.

    Defined edge cases: null and empty pages have an empty text; a null url is a host of its own; pages of any length are
    read whole; tags left open end with the page, and a tag that the page's end cuts off is markup; elements nested deeper
    than `depth` are siblings there; repeated rows are read each; copies of one page tell nothing about template; an empty
    table gives no rows; only the three columns are read.
    """
    host = F.coalesce(F.lower(F.regexp_extract(F.col(url_col).cast("string"), r"^(?:[a-zA-Z][\w+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))
    own = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"), host.alias("host"))
    found = cut(wrappers(own, params))
    kind = dict(own.dtypes)["id"]

    def run(batches):
        known: dict[str, Wrapper | None] = {}
        for b, wrapper in batches:
            texts = []
            for source, host in zip(b.column("html"), b.column("host").to_pylist(), strict=True):
                if host not in known:
                    if len(known) > 500:
                        known.clear()
                    known[host] = read_wrapper(wrapper(host))
                texts.append(main_text(source.as_py(), known[host], params))
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return _with_hosts(own, found, run, f"page_id {kind}, url string, text string, n_chars long", params)
