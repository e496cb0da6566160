"""Main text of web pages by removal of what the pages of a site share.

Every page is read into blocks of text and elements over them. Elements that lay out a page
(not those of prose: paragraphs, headings, list items, table cells, quotations) are hashed
with all they hold, and each host's hashes are counted in Spark: one that recurs in
`MOST_OWN` + 1 or more different articles of its host is part of the site's template, and
its text goes. Copies of an article count once, so an article that a site has many times
is not taken for a template, and prose stays however often it recurs.

Elements that say themselves what they are go on any page, as no count can find them on a
site of few pages: menus, footers, sidebars, forms, adverts, notices and comments, by tag,
role, or a word of their class or id. Scripts, styles and the like are never read. What
remains is the text of the page's articles; without any, of its main element, or else of
its body.

The hashes of a host with a third of all pages are counted in parts on every task before
they meet, and a template reaches its pages by (host, hash), of which none has more than
one row; Spark broadcasts templates only below its own limit, by the size written. Texts
stay where they were read unless a template was found in them.

Defined cases: a missing page is empty, and an empty text is a row as any other. Without
a host in the URL, or without URL, nothing is counted. Repeated rows are rows of their own.
Elements left open end where the element around them ends. A page of any length is read
whole; nesting may have any depth. Character references are decoded as browsers do.
Other columns are not looked at.
"""

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewtide.llm.tables import store, text_of

# More different articles of a host than this hold an element: it is template.
MOST_OWN = 4

# Elements by their use in HTML.
UNREAD = frozenset("head title script style noscript template iframe object svg canvas select textarea button audio video".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img input ins kbd label mark q s samp small span "
    "strike strong sub sup time tt u var wbr br".split()
)
LAYOUT = frozenset(
    "div section nav aside header footer form ul ol dl table menu center fieldset address details figure dialog search hgroup".split()
)
ASIDE = frozenset("nav aside footer form menu dialog search".split())
MAIN = frozenset("article main".split())
CLOSED_BY_NEXT = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "body": {"head"},
}
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar".split())
ASIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo banner sidebar menu navbar nav navigation "
    "breadcrumb breadcrumbs footer masthead cookie cookies consent gdpr notice notices alert popup modal overlay newsletter "
    "subscribe signup login share sharing social related recommended comment comments respond replies disqus pagination "
    "widget widgets toolbar".split()
)

_SCHEMA = (
    "page_id bigint, url string, host string, article binary, blocks array<string>, "
    "elements array<struct<hash:bigint,first:int,last:int>>"
)


def parsed(pages: DataFrame) -> DataFrame:
    """Per page: host, a digest of its text, its blocks and the elements that may be template.

    `first` and `last` are the element's first block and the one behind its last.
    """
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", text_of("html").alias("html"))
    return rows.mapInArrow(_parse, _SCHEMA)


def templates(pages: DataFrame, most_own: int = MOST_OWN) -> DataFrame:
    """host and hash of the elements in more than `most_own` different articles of the host."""
    found = pages.filter("host is not null").select("host", "article", F.explode("elements.hash").alias("hash"))
    each = found.groupBy("host", "hash", "article").agg(F.lit(1).alias("once"))
    return each.groupBy("host", "hash").agg(F.count("*").alias("articles")).filter(F.col("articles") > most_own).select("host", "hash")


def extract(pages: DataFrame, most_own: int = MOST_OWN) -> DataFrame:
    """page_id, url, text and its number of code points."""
    read = store(parsed(pages).withColumn("row", F.monotonically_increasing_id()), "pages")
    shared = store(templates(read, most_own), "templates")
    # Only elements with main text in them change a page.
    holding = F.filter("elements", lambda e: e.first < e.last)
    held = read.filter("host is not null").select("row", "host", F.explode(holding).alias("element"))
    gone = (
        held.select("row", "host", "element", F.col("element.hash").alias("hash")).join(shared, ["host", "hash"])
        .groupBy("row").agg(F.collect_set(F.struct("element.first", "element.last")).alias("gone"))
    )
    marked = read.join(store(gone, "gone"), "row", "left")
    covered = lambda at: F.exists("gone", lambda g: (g.first <= at) & (at < g.last))
    stays = F.when(F.col("gone").isNull(), F.col("blocks")).otherwise(F.filter("blocks", lambda _, at: ~covered(at)))
    text = F.array_join(stays, " ")
    return marked.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.char_length("text").cast("bigint"))


def host_of(url: str | None) -> str | None:
    found = re.match(r"\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:\s]+)", url or "")
    return found[1].lower().rstrip(".") if found else None


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([
        ("page_id", pa.int64()), ("url", pa.string()), ("host", pa.string()), ("article", pa.binary()),
        ("blocks", pa.list_(pa.string())),
        ("elements", pa.list_(pa.struct([("hash", pa.int64()), ("first", pa.int32()), ("last", pa.int32())]))),
    ])
    for batch in batches:
        urls = batch.column("url").to_pylist()
        found = [read_page(html.as_py()) for html in batch.column("html")]
        yield pa.RecordBatch.from_arrays([
            batch.column("page_id"), batch.column("url").cast(pa.string()), pa.array(map(host_of, urls), pa.string()),
            pa.array([_digest(*blocks) for blocks, _ in found], pa.binary()),
            pa.array([blocks for blocks, _ in found], schema.field("blocks").type),
            pa.array([[dict(zip(("hash", "first", "last"), e)) for e in elements] for _, elements in found],
                     schema.field("elements").type),
        ], schema=schema)


def read_page(html: str) -> tuple[list[str], list[tuple[int, int, int]]]:
    """The blocks of the page's main text, and (hash, first block, last block) of its layout elements.

    An element outside of the main text covers no block; its hash counts all the same.
    """
    reader = _Reader()
    reader.feed(html)
    reader.close()
    reader.end()
    return reader.main_text()


def _digest(*parts: str) -> bytes:
    return hashlib.blake2b("\n".join(parts).encode("utf-8", "surrogatepass"), digest_size=16).digest()


@dataclass
class _Element:
    tag: str
    first: int
    aside: bool = False
    after_main: bool = False
    holds_main: bool = False
    hash: "hashlib.blake2b" = field(default_factory=lambda: hashlib.blake2b(digest_size=8))


class _Reader(HTMLParser):
    """Blocks of text in page order, and where elements begin and end among them."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[str] = []
        self.buffer: list[str] = []
        self.open: list[_Element] = [_Element("", 0)]
        # How many elements that are never read are open, by tag of the outermost.
        self.unread, self.depth = None, 0
        self.articles, self.begun = 0, False
        self.dropped: list[tuple[int, int]] = []
        self.found: dict[str, list[tuple[int, int]]] = {"article": [], "main": []}
        self.layout: list[tuple[int, int, int]] = []

    def handle_starttag(self, tag: str, attributes: list[tuple[str, str | None]]) -> None:
        if self.unread:
            self.depth += tag == self.unread
            return
        if tag in VOID:
            if tag in INLINE:
                self.buffer.append(" " if tag == "br" else "")
            else:
                self._flush()
            return
        if tag in UNREAD:
            self.unread, self.depth = tag, 1
            return
        block = tag not in INLINE
        if block:
            self._flush()
            self._close_before(tag)
        named = dict(attributes)
        # The first article is the page's own, whatever it is called.
        aside = _is_aside(tag, named, self.articles > 0) and (tag != "article" or self.begun)
        element = _Element(tag, len(self.blocks), aside, self.begun)
        element.hash.update(f"<{tag} {named.get('class')} {named.get('id')}>".encode("utf-8", "surrogatepass"))
        if element.aside and not block:
            self._flush()
            element.first = len(self.blocks)
        self.open.append(element)
        if tag == "article" and not element.aside:
            self.articles += 1
            self.begun = True

    def handle_startendtag(self, tag: str, attributes: list[tuple[str, str | None]]) -> None:
        # Browsers ignore the slash, but for elements without content.
        self.handle_starttag(tag, attributes)

    def handle_endtag(self, tag: str) -> None:
        if self.unread:
            self.depth -= tag == self.unread
            if not self.depth:
                self.unread = None
            return
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at].tag == tag:
                self._close_to(at)
                return
            if (tag in INLINE or tag == "p") and self.open[at].tag not in INLINE:
                return

    def handle_data(self, data: str) -> None:
        if not self.unread:
            self.buffer.append(data)

    def end(self) -> None:
        self._close_to(1)
        self._flush()

    def main_text(self) -> tuple[list[str], list[tuple[int, int, int]]]:
        chosen = self.found["article"] or self.found["main"] or [(0, len(self.blocks))]
        # Running sums over the borders: how many chosen and dropped spans cover a block.
        borders = [0] * (len(self.blocks) + 1)
        outside = [0] * (len(self.blocks) + 1)
        for first, last in chosen:
            borders[first] += 1
            borders[last] -= 1
        for first, last in self.dropped:
            outside[first] += 1
            outside[last] -= 1
        kept, place, inside, beside = [], [0], 0, 0
        for block, border, out in zip(self.blocks, borders, outside):
            inside += border
            beside += out
            if inside and not beside:
                kept.append(block)
            place.append(len(kept))
        return kept, [(value, place[first], place[last]) for value, first, last in self.layout]

    def _flush(self) -> None:
        text = " ".join("".join(self.buffer).split())
        self.buffer.clear()
        if text:
            self.blocks.append(text)
            self.open[-1].hash.update(text.encode("utf-8", "surrogatepass"))

    def _close_before(self, tag: str) -> None:
        """End a paragraph, and what an element of this kind does not go into."""
        ends = CLOSED_BY_NEXT.get(tag, frozenset())
        for at in range(len(self.open) - 1, 0, -1):
            name = self.open[at].tag
            if name == "p" or name in ends:
                self._close_to(at)
                return
            if name not in INLINE:
                return

    def _close_to(self, at: int) -> None:
        if any(e.tag not in INLINE or e.aside for e in self.open[at:]):
            self._flush()
        while len(self.open) > at:
            element = self.open.pop()
            around, last = self.open[-1], len(self.blocks)
            value = element.hash.digest()
            around.hash.update(value)
            if element.tag == "article" and not element.aside:
                self.articles -= 1
            if element.tag in LAYOUT and not element.holds_main and last > element.first:
                self.layout.append((int.from_bytes(value, "little", signed=True), element.first, last))
            # What looks like an aside but holds the first article is a frame around it.
            if element.aside and (element.after_main or not element.holds_main):
                self.dropped.append((element.first, last))
                continue
            around.holds_main |= element.holds_main
            if element.tag in MAIN:
                self.found[element.tag].append((element.first, last))
                around.holds_main = True


def _is_aside(tag: str, attributes: dict[str, str | None], in_article: bool) -> bool:
    if tag in ("html", "body", "main"):
        return False
    if tag in ASIDE or (tag == "header" and not in_article):
        return True
    if (attributes.get("role") or "").strip().lower() in ASIDE_ROLES:
        return True
    names = f"{attributes.get('class') or ''} {attributes.get('id') or ''}"
    return any(word in ASIDE_WORDS for word in re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", names).lower()))
