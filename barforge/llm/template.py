"""Main text of web pages: site template removal, with the page's own structure.

Every page is parsed into an element tree. Each block element's subtree is hashed (tags
and white-space-normalised text, no attributes); Spark counts under how many different
pages of a host each hash occurs, and the subtrees that recur are deleted from the
host's pages: menus, notices, footers and whatever else a site prints on many pages.
Pages with equal title and heading are one page in that count, so copies of an article
do not make its text a template.

What the structure says is used as well: elements whose tag, role, id or class marks
them as menu, header, footer, sidebar, notice, advert, form, comment or code go, and
where a page marks its article, only that is kept. Inside a marked article only whole
sections can be template, not its paragraphs, which sites quote from each other. On a
page without such marks a paragraph goes only if ``prose_share`` of the host's pages
hold it, and lists that are mostly links go.

A host's list of templates is bounded by the number of subtrees of a page over ``share``. Lists are
broadcast while they have at most ``BROADCAST_HASHES`` hashes in all; beyond that pages
and lists are joined by (host, salt), so that a host with a third of all pages is spread.

Text: character references decoded, white space in a block as one space, blocks trimmed
and joined by one line feed. Blocks are the elements that start a new line; table rows
are one block. ``br`` is white space.

Defined cases: null html is empty and gives empty text; pages without a host (null or odd
urls) are cleaned by their structure alone; rows that repeat a page count once and are
each returned; unclosed, misnested and cut-off tags are closed as browsers do; very
long and very deep pages are read whole, without recursion; an empty table gives no rows.
Only the id, url and html columns are read, whatever else there is.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barforge.llm.common import staged

BROADCAST_HASHES = 2_000_000
SALTS = 32

HOST = r"^\s*[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)"

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: elements that start a new line; all but those of the last line end an open paragraph
BLOCKS = HEADINGS | frozenset(
    """address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form header
       hgroup hr main menu nav ol p pre search section summary table ul li dd dt
       html head body tr caption thead tbody tfoot legend option optgroup noscript template""".split())
CLOSES_P = BLOCKS - frozenset("html head body tr caption thead tbody tfoot legend option optgroup noscript template".split())
PROSE = HEADINGS | frozenset("p li dd dt blockquote pre tr summary figcaption caption hr address".split())
#: start tag -> (what it closes, where the search ends)
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}),
    "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot"}, {"table"}), "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}),
    "option": ({"option"}, {"select"}), "body": ({"head"}, {"html"}),
}
P = frozenset(["p"])
TABLE = frozenset(["table"])
INLINE_STOP = BLOCKS | {"td", "th"}
#: their end tags close whatever is open inside
WRAPPERS = frozenset("html body div article main section".split())
EMPTY_DRAWN = frozenset("svg path rect circle line use g".split())
SCOPE = frozenset("table td th caption html template object button".split())

GONE_TAGS = frozenset("""script style noscript template head iframe object embed audio video canvas svg map form button
    select option textarea input nav aside footer dialog menu xmp noembed noframes title""".split())
GONE_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar form".split())
#: whole words of an id or class
GONE_WORDS = frozenset("""ad ads advert adverts advertisement advertisements advertising adsbygoogle sponsor sponsored sponsors
    promo promos promotion banner banners nav navbar navigation menu menus submenu breadcrumb breadcrumbs pager pagination
    header masthead topbar footer foot sidebar aside widget widgets toolbar cookie cookies consent gdpr notice notices
    alert popup modal overlay lightbox newsletter subscribe subscription signup login search share sharing social
    comment comments commentlist disqus respond reply replies related recommended recommendations teaser teasers skip""".split())
MAIN_WORDS = frozenset("article post entry story content main maincontent".split())

TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+[^>]*)>|<[!?/][^>]*>", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
CUT_TAG = re.compile(r"<[A-Za-z/!?]")
RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I) for tag in RAW}


class Node:
    __slots__ = ("tag", "attributes", "children", "parent", "hash", "size", "linked", "gone")

    def __init__(self, tag: str, attributes: str = "", parent: Node | None = None):
        self.tag, self.attributes, self.parent = tag, attributes, parent
        self.children: list[Node | str] = []
        self.hash, self.size, self.linked, self.gone = 0, 0, 0, None

    def marks(self) -> dict[str, str]:
        return {k.lower(): unescape(a or b or c) for k, a, b, c in ATTRIBUTE.findall(self.attributes)}


class _Parser:
    """Where the parser is: the open element, and how many of each tag are open."""

    def __init__(self):
        self.root = self.here = Node("html")
        self.open: Counter[str] = Counter()

    def push(self, node: Node) -> None:
        self.here = node
        self.open[node.tag] += 1

    def pop_to(self, above: Node | None) -> None:
        while above is not None and self.here is not above:
            self.open[self.here.tag] -= 1
            self.here = self.here.parent

    def find(self, tags: set | frozenset, stop: set | frozenset) -> Node | None:
        """The innermost open element with one of the tags, unless one of ``stop`` lies between."""
        if not any(self.open[t] for t in tags):
            return None
        node = self.here
        while node is not None and node.tag not in tags:
            if node.tag in stop:
                return None
            node = node.parent
        return node

    def end_implied(self, tag: str) -> None:
        """Close what a start tag ends."""
        if tag in CLOSES_P and (p := self.find(P, SCOPE)):
            self.pop_to(p.parent)
        if tag in HEADINGS and self.here.tag in HEADINGS:
            self.pop_to(self.here.parent)
        if tag in IMPLIED:
            closes, stop = IMPLIED[tag]
            if found := self.find(closes, stop):
                self.pop_to(found.parent)

    def close(self, tag: str) -> None:
        if tag in HEADINGS:
            found = self.find(HEADINGS, SCOPE)
        elif tag in BLOCKS or tag in ("td", "th", "a"):
            found = self.find({tag}, frozenset() if tag in WRAPPERS else TABLE - {tag})
        else:
            found = self.find({tag}, INLINE_STOP)
        if found:
            self.pop_to(found.parent)


def parse(html: str) -> Node:
    """Element tree of a page; text is decoded."""
    state = _Parser()
    at, end = 0, html.rfind(">") + 1
    if cut := CUT_TAG.search(html, end):
        html = html[:cut.start()]  # a tag that never ends is no text
    size = len(html)
    while at < size:
        token = TOKEN.search(html, at)
        text = html[at:token.start() if token else size]
        if text:
            state.here.children.append(unescape(text) if "&" in text else text)
        if not token:
            break
        at = token.end()
        closing, name, attributes = token.groups()
        if not name:
            continue
        tag = name.lower()
        if closing:
            state.close(tag)
            continue
        if tag == "html" or (tag == "body" and state.open["body"]):
            continue
        state.end_implied(tag)
        node = Node(tag, attributes, state.here)
        state.here.children.append(node)
        if tag in RAW:
            stop = RAW_END[tag].search(html, at)
            raw = html[at:stop.start() if stop else size]
            node.children.append(unescape(raw) if tag in ("title", "textarea") else raw)
            close = html.find(">", stop.end()) if stop else -1
            at = close + 1 if close >= 0 else size
        elif tag not in VOID and not (attributes.endswith("/") and tag in EMPTY_DRAWN):
            state.push(node)
    return state.root


def ordered(root: Node) -> list[Node]:
    """All elements, each before what it holds."""
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        out.append(node)
        stack.extend(c for c in reversed(node.children) if c.__class__ is Node)
    return out


def measure(nodes: list[Node]) -> None:
    """Hash, text size and linked text size of every element, from the leaves up."""
    for node in reversed(nodes):
        form, size, linked = [node.tag], 0, 0
        for child in node.children:
            if child.__class__ is Node:
                form.append(f"<{child.hash:x}>")
                size += child.size
                linked += child.linked
            elif words := " ".join(child.split()):
                form.append(words)
                size += len(words)
        if node.tag in RAW:
            size = 0
        node.hash = xxhash.xxh64_intdigest(" ".join(form))
        node.size, node.linked = size, size if node.tag == "a" else linked


def _marked(node: Node) -> bool:
    """Does the element say that it is no main text?"""
    if node.tag in GONE_TAGS:
        return True
    if not node.attributes or node.tag in ("html", "body"):
        return False
    marks = node.marks()
    if "hidden" in marks or marks.get("aria-hidden") == "true" or "display:none" in marks.get("style", "").replace(" ", ""):
        return True
    if marks.get("role", "").lower() in GONE_ROLES:
        return True
    named = {w.lower() for w in WORDS.findall(f"{marks.get('class', '')} {marks.get('id', '')}")}
    return not named.isdisjoint(GONE_WORDS)


def main_elements(nodes: list[Node]) -> list[Node]:
    """The elements that hold the article as the page marks it; none if it marks nothing.

    Sets ``gone`` for every element: marked as no main text, or inside such an element.
    """
    articles, mains, named = [], [], []
    for node in nodes:
        above = node.parent
        node.gone = bool(above and above.gone) or _marked(node)
        if node.gone or not node.size:
            continue
        if node.tag == "article":
            articles.append(node)
        elif node.tag == "main":
            mains.append(node)
        elif node.attributes and node.tag not in PROSE and node.tag not in ("html", "body"):
            marks = node.marks()
            if marks.get("role", "").lower() == "main" or marks.get("itemprop") == "articleBody":
                mains.append(node)
            elif node.tag in ("div", "section", "td") and not MAIN_WORDS.isdisjoint(
                    w.lower() for w in WORDS.findall(f"{marks.get('class', '')} {marks.get('id', '')}")):
                named.append(node)
    if articles:
        outer = _outermost(articles)
        most = max(n.size for n in outer)
        return [n for n in outer if 3 * n.size >= most]  # not the teasers beside the article
    if mains:
        return _outermost(mains)
    return [max(named, key=lambda n: n.size)] if named else []


def _outermost(nodes: list[Node]) -> list[Node]:
    inside, out = set(map(id, nodes)), []
    for node in nodes:
        above = node.parent
        while above is not None and id(above) not in inside:
            above = above.parent
        if above is None:
            out.append(node)
    return out


class Page:
    """A parsed page: its elements and the ones that hold its article."""

    def __init__(self, html: str):
        self.root = parse(html)
        self.nodes = ordered(self.root)
        measure(self.nodes)
        self.mains = main_elements(self.nodes)

    def places(self) -> Iterator[tuple[Node, bool, bool]]:
        """(element, in the article, holds the article) for all block elements with text."""
        mains = set(map(id, self.mains))
        above = set()
        for main in self.mains:
            node = main.parent
            while node is not None and id(node) not in above:
                above.add(id(node))
                node = node.parent
        inside: set[int] = set()
        for node in self.nodes:
            key = id(node)
            if key in mains or (node.parent is not None and id(node.parent) in inside):
                inside.add(key)
            if node.size and node.tag in BLOCKS:
                yield node, key in inside, key in above or key in mains

    def key(self) -> int:
        """The same for pages with equal title and heading."""
        first = {}
        for node in self.nodes:
            if node.tag in ("title", "h1") and node.tag not in first:
                first[node.tag] = node.hash
        return xxhash.xxh64_intdigest(str(sorted(first.items())) if first else f"{self.root.hash}")

    def subtrees(self) -> dict[int, bool]:
        """Hash -> is it prose, for the block elements that may be template."""
        return {node.hash: node.tag in PROSE for node, inside, holds in self.places()
                if not holds and node.tag not in ("html", "body", "head") and not (inside and node.tag in PROSE)}

    def text(self, template: frozenset[int] | set[int]) -> str:
        """The main text without the subtrees in ``template``."""
        cut = set()
        for node, inside, holds in self.places():
            if holds or node.tag in ("html", "body"):
                continue
            if node.hash in template and not (inside and node.tag in PROSE):
                cut.add(id(node))
            elif not self.mains and node.tag in ("ul", "ol", "dl", "div", "table", "section", "p", "center") and 3 * node.linked > 2 * node.size:
                cut.add(id(node))
        out: list[str] = []
        for main in self.mains or [self.root]:
            _blocks(main, cut, out)
        return "\n".join(out)


def _blocks(main: Node, cut: set[int], out: list[str]) -> None:
    words: list[str] = []

    def flush() -> None:
        if text := " ".join("".join(words).split()):
            out.append(text)
        words.clear()

    stack: list[Node | str | None] = [main]
    while stack:
        item = stack.pop()
        if item is None:
            flush()
        elif item.__class__ is str:
            words.append(item)
        elif item.tag in ("br", "td", "th"):
            words.append(" ")
            stack.extend(reversed(item.children))
        elif not (item is not main and (item.gone or id(item) in cut)):
            if item.tag in BLOCKS:
                flush()
                stack.append(None)
            stack.extend(reversed(item.children))
    flush()


def site_templates(pages: DataFrame, min_pages: int = 5, share: float = 0.005, prose_share: float = 0.3) -> DataFrame:
    """(host, hashes array<bigint>): the subtrees that recur on a host, from rows (id, url, html, host).

    A subtree recurs if it is on ``min_pages`` different pages and on ``share`` of the host's
    different pages; a paragraph or heading outside an article if it is on ``prose_share`` of them.
    """

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            host, page, subtree, prose = [], [], [], []
            for name, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                parsed = Page(html)
                found = parsed.subtrees()
                key = _signed(parsed.key())
                found_keys = [None, *map(_signed, found)]  # null: the page itself
                host += [name] * len(found_keys)
                page += [key] * len(found_keys)
                subtree += found_keys
                prose += [False, *found.values()]
            yield pa.RecordBatch.from_arrays([pa.array(host, pa.string()), pa.array(page, pa.int64()), pa.array(subtree, pa.int64()),
                                              pa.array(prose, pa.bool_())], ["host", "page", "subtree", "prose"])

    rows = (pages.where("host is not null").select("host", "html")
            .mapInArrow(hashed, "host string, page bigint, subtree bigint, prose boolean").distinct())
    counts = staged(rows.groupBy("host", "subtree", "prose").agg(F.count("*").alias("n"))
                    .where(F.col("subtree").isNull() | (F.col("n") >= min_pages)), "subtree-counts")
    sizes = counts.where(f"subtree is null and n >= {min_pages}").select("host", F.col("n").alias("pages"))
    often = (counts.where("subtree is not null").join(sizes, "host")
             .where((F.col("n") >= F.when(F.col("prose"), prose_share).otherwise(share) * F.col("pages"))))
    return staged(often.groupBy("host").agg(F.collect_set("subtree").alias("hashes")), "templates")


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def main_texts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", *, min_pages: int = 5,
               share: float = 0.005, prose_share: float = 0.3) -> DataFrame:
    """(id, url, text): the main text of every page."""
    host = F.lower(F.regexp_extract(F.col(url_col).cast("string"), HOST, 1))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"),
                        F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"), F.when(host != "", host).alias("host"))
    templates = site_templates(rows, min_pages, share, prose_share)
    held = templates.agg(F.coalesce(F.sum(F.size("hashes") + 8), F.lit(0))).first()[0]
    if held <= BROADCAST_HASHES:
        joined = rows.join(F.broadcast(templates), "host", "left")
    else:
        salted = templates.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = rows.withColumn("salt", F.pmod(F.xxhash64("url", "html"), F.lit(SALTS)).cast("int")).join(salted, ["host", "salt"], "left")

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [Page(html).text({h % (1 << 64) for h in hashes or ()}) for html, hashes in
                     zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["id", "url", "text"])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    return joined.select("id", "url", "html", "hashes").mapInArrow(extracted, f"id {kinds['id']}, url {kinds['url']}, text string")
