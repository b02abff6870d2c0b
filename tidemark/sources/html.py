"""HTML pages as rows of elements, parsed next to the scan in Arrow batches, which a worker returns in parts of bounded size.

A page gives one row with an array of the elements that were asked for, in document order, so all that
looks at one page stays in its row and nothing shuffles.  Unclosed p, li, option, dt, dd, td, th and tr
end where the next of their kind begins or their container ends; void elements have no content; script
and style hold text that isn't markup and isn't part of any element's text; comments are dropped;
character references are decoded.

Each element: pos (its place among all elements of the page), last (the place of the last one inside
it), parent (its parent's place, -1 for the page), tag, attrs, text (its strings, each stripped, put
together), spaced (the same with single spaces between).  The page itself is the element with pos -1
and tag ''.  Texts are kept for the tags asked for, for parents of links, and for the page.

Null pages count as empty ones: the page's element alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.runtime import importable

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Start tags that end an open element, and where the search for it stops.
ENDED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "option": ({"option"}, {"select"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
}
#: Blocks end an open paragraph.
BLOCKS = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
#: Paragraphs are looked for up to one of these.
CLOSED_IN = frozenset("div article section td th li body button".split())
TAGS = ("title", "h1", "h2", "h3", "a", "p", "li", "td", "tr", "time", "div", "main", "article", "fin-streamer")
ELEMENT = "struct<pos: int, last: int, parent: int, tag: string, attrs: map<string, string>, text: string, spaced: string>"
ARROW = pa.list_(pa.struct([(n, pa.int32()) for n in ("pos", "last", "parent")] + [("tag", pa.string()), ("attrs", pa.map_(pa.string(), pa.string())), ("text", pa.string()), ("spaced", pa.string())]))
#: A worker holds the elements of pages until their strings and objects come to about this many bytes; a larger page stands alone.
PART_BYTES, ELEMENT_BYTES = 4_000_000, 1_000


class _Tree(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows: list[list] = []  # last, parent, tag, attrs, first string, end of strings
        self.open: list[int] = []
        self.strings: list[str] = []

    def _close(self, depth: int) -> None:
        """Ends all open elements from this depth on."""
        for i in reversed(self.open[depth:]):
            self.rows[i][0], self.rows[i][5] = len(self.rows) - 1, len(self.strings)
        del self.open[depth:]

    def _close_open(self, tags: set, stops: frozenset | set) -> None:
        for depth in range(len(self.open) - 1, -1, -1):
            tag = self.rows[self.open[depth]][2]
            if tag in tags:
                self._close(depth)
                if tag not in ("td", "th") or "tr" not in tags:
                    return
            elif tag in stops:
                return

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in BLOCKS:
            self._close_open({"p"}, CLOSED_IN)
        if tag in ENDED_BY:
            self._close_open(*ENDED_BY[tag])
        held: dict[str, str] = {}
        for name, value in attrs:
            held.setdefault(name, value or "")
        self.rows.append([len(self.rows), self.open[-1] if self.open else -1, tag, held, len(self.strings), len(self.strings)])
        if tag not in VOID:
            self.open.append(len(self.rows) - 1)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)  # a slash closes nothing but void elements

    def handle_endtag(self, tag: str) -> None:
        for depth in range(len(self.open) - 1, -1, -1):
            if self.rows[self.open[depth]][2] == tag:
                self._close(depth)
                return

    def handle_data(self, data: str) -> None:
        if self.open and self.rows[self.open[-1]][2] in ("script", "style"):
            return
        if data := data.strip():
            self.strings.append(data)


def parsed(html: str | None, tags: frozenset[str]) -> list[dict]:
    tree = _Tree()
    tree.feed(html or "")
    tree.close()
    tree._close(0)
    linked = {r[1] for r in tree.rows if r[2] == "a"}
    out = [{"pos": -1, "last": len(tree.rows) - 1, "parent": -1, "tag": "", "attrs": {}, "text": "".join(tree.strings), "spaced": " ".join(tree.strings)}]
    for i, (last, parent, tag, attrs, a, b) in enumerate(tree.rows):
        if tag in tags or i in linked:
            some = tree.strings[a:b]
            out.append({"pos": i, "last": last, "parent": parent, "tag": tag, "attrs": attrs, "text": "".join(some), "spaced": " ".join(some)})
    return out


def parts(pages: Iterator[pa.Array], tags: frozenset[str]) -> Iterator[pa.Array]:
    """The pages' elements, in order, in arrays of about PART_BYTES whatever the batches hold."""
    for some in pages:
        rows, held = [], 0
        for page in some:
            rows.append(found := parsed(page.as_py(), tags))
            for e in found:
                held += ELEMENT_BYTES + len(e["text"]) + len(e["spaced"]) + sum(map(len, e["attrs"].values()))
                e["attrs"] = list(e["attrs"].items())
            if held >= PART_BYTES:
                yield pa.array(rows, ARROW)
                rows, held = [], 0
        if rows:
            yield pa.array(rows, ARROW)


def elements(pages: DataFrame, html: str = "html", tags: tuple[str, ...] = TAGS) -> DataFrame:
    """pages with a column `elements` in place of the HTML."""
    importable(pages.sparkSession)
    wanted = frozenset(tags)

    @F.arrow_udf(f"array<{ELEMENT}>")
    def parse(pages: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from parts(pages, wanted)

    return pages.select(*[c for c in pages.columns if c != html], parse(html).alias("elements"))


# Expressions over the array of a page's elements.


def page_text(found: Column) -> Column:
    """The page's text with single spaces."""
    return F.get(found, F.lit(0))["spaced"]


def tagged(found: Column, *tags: str) -> Column:
    return F.filter(found, lambda e: e["tag"].isin(*tags))


def inside(found: Column, container: Column) -> Column:
    """Those that stand within the container."""
    return F.filter(found, lambda e: (e["pos"] > container["pos"]) & (e["pos"] <= container["last"]))


def first(found: Column, test) -> Column:
    """The first element that passes, or null."""
    return F.get(F.filter(found, test), F.lit(0))


def has_class(e: Column, name: str) -> Column:
    return F.array_contains(F.split(F.coalesce(e["attrs"]["class"], F.lit("")), r"\s+"), name)


def parent_text(found: Column, e: Column) -> Column:
    return first(found, lambda x: (x["pos"] == e["parent"]) & (x["pos"] >= 0))["spaced"]


def later_sibling(found: Column, e: Column, tag: str) -> Column:
    """The next element of this tag with the same parent."""
    return first(found, lambda x: (x["tag"] == tag) & (x["pos"] > e["pos"]) & (x["parent"] == e["parent"]))


def next_one(found: Column, e: Column, tag: str) -> Column:
    """The next element of this tag anywhere later in the page, inside e included."""
    return first(found, lambda x: (x["tag"] == tag) & (x["pos"] > e["pos"]))


def firsts(rows: Column, key: str) -> Column:
    """Of structs with one key the first stays."""
    keys = F.transform(rows, lambda x: x[key])
    return F.filter(rows, lambda x, i: F.array_position(keys, x[key]) == i + 1)
