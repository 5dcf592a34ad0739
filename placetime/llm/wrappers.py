"""Main text of web pages by wrapper induction.

Pages of one host are filled into the same layout. Their trees of block elements are aligned
by simple tree matching: two nodes with the same label match, and the children of matching
nodes are paired in order so that as many nodes as possible match. Alignment merges pages
into one template tree per host. A node of it whose text is the same on all its pages is
part of the layout; a node whose text varies is a slot. Menus, headers, footers, adverts,
forms and the like are known by their element, class, id or role; their slots hold no
content, nor do slots that are mostly links. The content root is the lowest node above all
content slots. A page's text is what stands below its host's content root, without the
unwanted nodes; there a name counts if all its words are of that kind (``cookie-banner``, not ``related-work``),
for containers by class, role or id, for paragraphs as adverts or comments by class. Elements more than 200 deep belong to no template; their text is read like all other. A host whose pages do not differ is served by the template of all hosts.

A template has one node per run of equal siblings, so it has the size of a layout, not of a
page or a host. Tasks merge the pages they read by host; only templates are shuffled,
and those of one host meet in a few rounds. The html is joined with the wrappers' short
table, by broadcast where that is small, and else by shuffle.

Definitions for odd input: a null html is empty and has an empty text. Pages without a host
(null or odd url) form one group. Repeated rows are pages like any other. Broken markup is read
as far as it goes: unclosed elements end with their parent. A page that lacks the content
root is read below the root of all hosts, or else as a whole. An empty table gives an empty
result. Other columns play no part.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placetime.session import checkpointed, fresh_path

# fixed values: elements of HTML by their role here
BLOCKS = frozenset("html body main article section div h1 h2 h3 h4 h5 h6 p ul ol li dl dt dd pre blockquote figure figcaption table thead tbody tfoot tr td th caption address center details summary hgroup fieldset".split())
UNWANTED = frozenset("head title nav header footer aside form script style noscript template iframe object embed button select option textarea svg canvas audio video menu dialog input label map applet search".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES_P = BLOCKS - {"html", "body"} | {"nav", "header", "footer", "aside", "form", "hr", "menu"}
#: what an element closes when it starts, and the elements that this stops at
CLOSED_BY = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
NAMES = re.compile(
    r"(?:^|[\s_-])(?:nav|navbar|navigation|menu|header|masthead|topbar|footer|sidebar|side|aside|notice|notices|cookie|cookies|consent|gdpr|banner|ad|ads|adv|advert|adverts|advertisement|advertising|sponsor|sponsored|promo|promotion|popup|modal|overlay|comment|comments|commentlist|disqus|respond|replies|share|sharing|social|related|recommended|breadcrumb|breadcrumbs|newsletter|subscribe|subscription|signup|login|search|pagination|pager|widget|toolbar|complementary|contentinfo)(?:[\s_-]|\d*$)",
    re.IGNORECASE,
)
#: fixed values: below a content root, the words that mark readers' comments, notices, adverts and the like ...
INNER_WORDS = frozenset(
    "nav navbar navigation menu masthead topbar footer sidebar side aside notice notices cookie cookies consent gdpr banner ad ads adv advert adverts advertisement"
    " advertising sponsor sponsored promo promotion popup modal overlay comment comments commentlist disqus respond replies share sharing social related recommended"
    " breadcrumb breadcrumbs newsletter subscribe subscription signup login search pagination pager widget toolbar complementary contentinfo".split()
)
#: ... those that may stand beside them in a name, and those that make a header the site's and not the article's
BESIDE_WORDS = frozenset(
    "box wrapper wrap container section list area block inner outer top bottom left right main content form links link posts post items item bar panel row col column"
    " group holder unit slot title heading text message msg alert header module region entry entries thread reply count toggle button buttons icon icons page site js is has".split()
)
#: those of the first that also count for a paragraph
ADVERT_WORDS = frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies consent newsletter subscribe comment comments".split())
SITE_WORDS = frozenset("site masthead topbar global".split())
KEPT_TAGS = frozenset({"html", "body", "article", "main"})
ROOTS = ("article", "main")
TEXTUAL = frozenset("h1 h2 h3 h4 h5 h6 p li dl dt dd pre blockquote figure figcaption table thead tbody tfoot tr td th caption address summary hgroup".split())
INNER_TAGS = frozenset({"header", "label", "object"})  # content where they stand below a content root
MOST_RUNS = 64  # a node with more runs of children groups them by label
HOSTS = 2_000  # templates a task holds before it gives them out
SALTS = 32


def parts_of(name: str) -> list[str]:
    """Words of a class, id or role in lower case: cut at signs, digits and capitals."""
    return re.findall(r"[a-z]+", re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "-", name).lower())


def marks_unwanted(names: str, kinds: frozenset = INNER_WORDS) -> bool:
    """Whether one of the names says nothing but that its element is unwanted below a content root."""
    for name in names.split():
        words = parts_of(name)
        if any(w in kinds for w in words) and all(w in INNER_WORDS or w in BESIDE_WORDS for w in words):
            return True
    return False


class Node:
    """An element of a page: label, whether it is unwanted, also below a content root, and its texts and elements in order."""

    __slots__ = ("items", "label", "tag", "unwanted", "within")

    def __init__(self, tag: str, label: str, unwanted: bool, within: bool = False) -> None:
        self.tag, self.label, self.unwanted, self.within, self.items = tag, label, unwanted, within, []


class _Reader(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("", "", False)
        self.stack, self.links = [self.root], 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "br":
            self.stack[-1].items.append((" ", False))
            return
        if tag == "hr":
            self.close_p()
            self.stack[-1].items.append(Node("hr", "hr", True, True))
            return
        names = dict(attrs)
        marks = re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "-", " ".join(str(names.get(k) or "") for k in ("class", "id", "role"))).strip()
        unseen = "hidden" in names or names.get("aria-hidden") == "true"
        odd = tag in UNWANTED or (bool(marks) and tag not in KEPT_TAGS and bool(NAMES.search(marks))) or unseen
        within = unseen or tag in UNWANTED - INNER_TAGS or self.marked(tag, f"{names.get('class') or ''} {names.get('role') or ''}", str(names.get("id") or ""))
        if tag in VOID:
            return
        if tag in CLOSES_P:
            self.close_p()
        if tag in CLOSED_BY:
            closed, stop = CLOSED_BY[tag]
            self.close(closed, stop)
        if tag == "a":
            self.links += 1
        if tag in BLOCKS or odd:
            if tag in ("html", "body") and any(n.tag == tag for n in self.stack):
                return
            label = tag + re.sub(r"[\d\s]+", ".", f" {names['class']}") if names.get("class") else tag
            node = Node(tag, label, odd, within)
            self.stack[-1].items.append(node)
            self.stack.append(node)

    @staticmethod
    def marked(tag: str, roles: str, name: str) -> bool:
        """Unwanted below a content root by name: containers by class, role or id, paragraphs and items as adverts or comments, headers as the site's."""
        if tag == "header":
            return any(w in SITE_WORDS for w in parts_of(f"{roles} {name}")) or marks_unwanted(roles)
        if tag in BLOCKS - TEXTUAL - KEPT_TAGS or tag in ("ul", "ol", "dl", "table"):
            return marks_unwanted(f"{roles} {name}") or {"site", "header"} <= set(parts_of(f"{roles} {name}"))
        return tag in ("p", "li", "dd", "figure", "blockquote") and marks_unwanted(roles, ADVERT_WORDS)

    def close_p(self) -> None:
        if self.stack[-1].tag == "p":
            self.stack.pop()

    def close(self, closed: set | None = None, stop: set | None = None) -> None:  # type: ignore[override]
        if closed is None:
            super().close()
            return
        for k in range(len(self.stack) - 1, 0, -1):
            if self.stack[k].tag in stop:
                return
            if self.stack[k].tag in closed:
                del self.stack[k:]
                return

    def handle_endtag(self, tag: str) -> None:
        if tag == "a":
            self.links = max(0, self.links - 1)
        for k in range(len(self.stack) - 1, 0, -1):
            if self.stack[k].tag == tag:
                del self.stack[k:]
                return

    def handle_data(self, data: str) -> None:
        self.stack[-1].items.append((data, self.links > 0))


_CUT_TAG = re.compile(r"<[/!?]?[A-Za-z!?-][^>]*$")


def parse(html: str | None) -> Node:
    reader = _Reader()
    text = html or ""
    last = text.rfind("<")
    if last > text.rfind(">") and _CUT_TAG.match(text, last):
        text = text[:last]  # a tag that the end of the page cuts
    reader.feed(text)
    reader.close()
    return reader.root


def blocks(node: Node, rooted: bool = False) -> list[str]:
    """Texts of the blocks below a node in page order, white space made single, unwanted nodes left out.

    Below a content root (``rooted``) containers are unwanted by a class, role or id that says nothing else,
    paragraphs by one of adverts or comments, headers as those of the site; headings and inline elements never by a name.
    """
    out: list[str] = []
    run: list[str] = []

    def end() -> None:
        text = " ".join("".join(run).split())
        run.clear()
        if text:
            out.append(text)

    todo: list = [node]
    while todo:
        item = todo.pop()
        if item is None:
            end()
        elif isinstance(item, tuple):
            run.append(item[0])
        elif (item.within if rooted else item.unwanted) and item is not node:
            if item.tag in BLOCKS or item.tag in CLOSES_P:
                end()
        elif rooted and item.tag not in BLOCKS and item.tag not in CLOSES_P:
            todo += item.items[::-1]
        else:
            end()
            todo.append(None)
            todo += item.items[::-1]
    end()
    return out


# A template node is a list: label, pages, least and greatest hash of the own text, its
# characters, those in links, unwanted, children.
LABEL, PAGES, LOW, HIGH, CHARS, LINKED, ODD, CHILDREN = range(8)


def template(node: Node, depth: int = 0, rooted: bool = False) -> list:
    """The template of one page: equal siblings that follow each other are one node; ``rooted`` below an article."""
    rooted = rooted or node.tag in ROOTS
    own = "".join(t for t, _ in (i for i in node.items if isinstance(i, tuple)))
    text = " ".join(own.split())
    mark = xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) >> 1 if text else 0
    linked = sum(len(t.strip()) for t, a in (i for i in node.items if isinstance(i, tuple)) if a)
    children: list[list] = []
    if depth < 200:
        for item in node.items:
            if isinstance(item, Node):
                made = template(item, depth + 1, rooted) if not (item.within if rooted else item.unwanted) else [item.label, 1, 0, 0, 0, 0, True, []]
                if children and children[-1][LABEL] == made[LABEL]:
                    children[-1] = _one(children[-1], made)
                else:
                    children.append(made)
        if len(children) > MOST_RUNS:
            by: dict[str, list] = {}
            for c in children:
                by[c[LABEL]] = _one(by[c[LABEL]], c) if c[LABEL] in by else c
            children = list(by.values())
    return [node.label, 1, mark, mark, len(text), linked, node.within if rooted else node.unwanted, children]


def _one(a: list, b: list) -> list:
    """Two equal siblings of one page as one node."""
    mark = (a[LOW] * 31 + b[LOW]) & (2**62 - 1)
    return [a[LABEL], 1, mark, mark, a[CHARS] + b[CHARS], a[LINKED] + b[LINKED], a[ODD] or b[ODD], _aligned(a[CHILDREN], b[CHILDREN], _one)]


def merge(a: list, b: list) -> list:
    """Two templates whose roots match as one."""
    low, high = min(a[LOW], b[LOW]), max(a[HIGH], b[HIGH])
    return [a[LABEL], a[PAGES] + b[PAGES], low, high, a[CHARS] + b[CHARS], a[LINKED] + b[LINKED], a[ODD] and b[ODD], _aligned(a[CHILDREN], b[CHILDREN], merge)]


def matching(a: list, b: list, known: dict | None = None) -> int:
    """Simple tree matching: how many nodes two trees have in common, in order and below each other."""
    if a[LABEL] != b[LABEL]:
        return 0
    known = {} if known is None else known
    key = (id(a), id(b))
    if key not in known:
        known[key] = 1 + _table(a[CHILDREN], b[CHILDREN], known)[-1][-1]
    return known[key]


def _table(xs: list, ys: list, known: dict) -> list[list[int]]:
    rows = [[0] * (len(ys) + 1)]
    for x in xs:
        above, row = rows[-1], [0]
        for j, y in enumerate(ys):
            best = max(above[j + 1], row[j])
            if x[LABEL] == y[LABEL]:
                best = max(best, above[j] + matching(x, y, known))
            row.append(best)
        rows.append(row)
    return rows


def _aligned(xs: list, ys: list, join) -> list:
    """Children of two matching nodes: pairs of the best matching joined, the others kept in order."""
    if [x[LABEL] for x in xs] == [y[LABEL] for y in ys]:
        return [join(x, y) for x, y in zip(xs, ys, strict=True)]
    known: dict = {}
    rows = _table(xs, ys, known)
    i, j, out = len(xs), len(ys), []
    while i or j:
        if i and j and xs[i - 1][LABEL] == ys[j - 1][LABEL] and rows[i][j] == rows[i - 1][j - 1] + matching(xs[i - 1], ys[j - 1], known):
            i, j = i - 1, j - 1
            out.append(join(xs[i], ys[j]))
        elif i and rows[i][j] == rows[i - 1][j]:
            i -= 1
            out.append(xs[i])
        else:
            j -= 1
            out.append(ys[j])
    return out[::-1]


def content_root(tree: list) -> list[str] | None:
    """Labels from below the tree's root to the lowest node above all content slots; None without slots."""
    def mass(node: list) -> int:
        """Characters of the content slots at and below a node."""
        if node[ODD]:
            return 0
        slot = node[LOW] != node[HIGH] and 2 * node[LINKED] < node[CHARS]
        return node[CHARS] * slot + sum(mass(c) for c in node[CHILDREN])

    def named(node: list, path: list[str]) -> Iterator[tuple[int, list[str]]]:
        for c in node[CHILDREN]:
            if not c[ODD]:
                if c[LABEL].split(".")[0].split(" ")[0] in ROOTS:
                    yield mass(c), [*path, c[LABEL]]
                yield from named(c, [*path, c[LABEL]])

    whole, path, node = mass(tree), [], tree
    if not whole:
        return None
    best = max(named(tree, []), default=(0, []), key=lambda x: (x[0], -len(x[1])))
    if 2 * best[0] > whole:
        return best[1]
    while True:
        lower = [c for c in node[CHILDREN] if mass(c) == whole and c[LABEL].split(".")[0].split(" ")[0] in ("html", "body", "div", "section", "td", "tr", "table", "tbody")]
        if not lower:
            return path
        node = lower[0]
        path.append(node[LABEL])


def below(root: Node, path: list[str]) -> list[Node]:
    """Nodes that the labels lead to, in page order."""
    level = [root]
    for label in path:
        level = [c for n in level for c in n.items if isinstance(c, Node) and c.label == label]
    return level


def main_text(html: str | None, paths: list[list[str] | None]) -> str:
    """Text of a page below the first of the paths that it has, or of the whole page."""
    page = parse(html)
    for path in paths:
        found = below(page, path) if path else []
        if found:
            return "\n\n".join(b for n in found for b in blocks(n, True))
    return "\n\n".join(blocks(page))


def host(url):
    """Host of a url column in lower case; empty where there is none."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def _merge_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, list] = {}

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"host": list(held), "tree": [json.dumps(t) for t in held.values()]}, schema=pa.schema([("host", pa.string()), ("tree", pa.string())]))

    for b in batches:
        for name, html in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            made = template(parse(html))
            held[name] = merge(held[name], made) if name in held else made
            if len(held) >= HOSTS:
                yield out()
                held.clear()
    if held:
        yield out()


def _merge_trees(key: tuple, rows: pa.Table) -> pa.Table:
    merged = None
    for tree in map(json.loads, rows["tree"].to_pylist()):
        merged = tree if merged is None else merge(merged, tree)
    return pa.table({"host": pa.array([key[0].as_py()], pa.string()), "tree": pa.array([json.dumps(merged)], pa.string())})


def templates(pages: DataFrame) -> DataFrame:
    """(host, tree): the merged template of each host, as JSON."""
    trees = pages.select(host(F.col("url")).alias("host"), "html").mapInArrow(_merge_pages, "host string, tree string")
    trees = checkpointed(trees)
    salted = trees.groupBy("host", (F.xxhash64("tree") % SALTS).alias("salt")).applyInArrow(_merge_trees, "host string, tree string")
    return salted.groupBy("host").applyInArrow(_merge_trees, "host string, tree string")


def _overall(trees: DataFrame) -> list[str] | None:
    """Content root of the template of all hosts, merged in rounds."""
    for parts in (SALTS * SALTS, SALTS, 1):
        trees = trees.select(F.when(F.lit(parts) > 1, F.pmod(F.xxhash64("host", F.lit(parts)), F.lit(parts)).cast("string")).otherwise("").alias("host"), "tree").groupBy("host").applyInArrow(_merge_trees, "host string, tree string")
    row = trees.first()
    return content_root(json.loads(row.tree)) if row else None


def _roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = [content_root(json.loads(t)) for t in b.column(1).to_pylist()]
        yield pa.RecordBatch.from_pydict({"host": b.column(0), "root": pa.array([None if f is None else json.dumps(f) for f in found], pa.string())})


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url and text of every row of ``pages`` (page_id, url, html)."""
    spark, path = pages.sparkSession, fresh_path(pages.sparkSession, "wrappers")
    trees = checkpointed(templates(pages))
    overall = _overall(trees)
    trees.mapInArrow(_roots, "host string, root string").write.parquet(path)
    wrappers = spark.read.parquet(path)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(html, [json.loads(root) if root else None, overall]) for html, root in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_pydict({"page_id": b.column(0), "url": b.column(1), "text": pa.array(texts, pa.string())})

    keyed = pages.select("page_id", "url", "html", host(F.col("url")).alias("host"))
    joined = keyed.join(wrappers, "host", "left").select("page_id", "url", "html", "root")
    return joined.mapInArrow(read, f"page_id {dict(pages.dtypes)['page_id']}, url string, text string")
