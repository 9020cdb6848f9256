"""Flat view of an HTML page.

``page_nodes`` turns a page into arrays that stay in the page's row, so
extraction needs no shuffle. Elements carry the range of positions they span
(``pre`` to ``post``) and where their text lies: ``n`` entries of the visible
texts from number ``first`` on, so the text of an element is a slice. A ``dt``
also knows the text of the next ``dd`` beside it. Only elements that extraction
can ask for are listed.
"""

from __future__ import annotations

from collections.abc import Callable
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

NODES = (
    "struct<elements:array<struct<pre:int,post:int,parent:int,tag:string,attrs:map<string,string>,text:string,"
    "first:int,n:int,dd_first:int,dd_n:int>>,visible:array<string>,texts:array<string>>"
)
KEPT_ATTRIBUTES = {
    "id", "class", "property", "name", "content", "src", "type", "aria-label", "data-rating",
    "data-lat", "data-lng", "data-latitude", "data-longitude",
}
KEPT_TAGS = {"h1", "h2", "h3", "dt", "dd", "li", "span", "article", "meta", "img", "script", "button"}
RAW_TEXT = {"script", "style"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
CONTAINERS = {"div", "article", "section", "main", "ul", "ol", "dl", "table", "td", "body", "html", "nav", "aside"}
# a start tag of the first kind ends an open element of the second kind
IMPLIED_END = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}} | {
    t: {"p"} for t in ["p", "div", "article", "section", "ul", "ol", "dl", "table", "h1", "h2", "h3", "h4", "form"]
}


class _Outline(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.count = 0
        self.open = []  # elements, innermost last
        self.elements = []
        self.visible = []  # texts a reader sees
        self.texts = []  # those and comments

    def _next(self):
        self.count += 1
        return self.count

    def _close(self, depth):
        for element in self.open[depth:]:
            element["post"], element["n"] = self.count, len(self.visible) - element["first"]
        del self.open[depth:]

    def _find(self, tags, stop):
        for depth in range(len(self.open) - 1, -1, -1):
            tag = self.open[depth]["tag"]
            if tag in tags:
                return depth
            if tag in stop:
                return None
        return None

    def handle_starttag(self, tag, attrs):
        ends = IMPLIED_END.get(tag)
        depth = self._find(ends, CONTAINERS) if ends else None
        if depth is not None:
            self._close(depth)
        pre = self._next()
        kept = {k: v or "" for k, v in reversed(attrs) if k in KEPT_ATTRIBUTES}
        if "class" in kept:
            kept["class"] = f" {' '.join(kept['class'].split())} "
        parent = self.open[-1]["pre"] if self.open else 0
        element = {"pre": pre, "post": pre, "parent": parent, "tag": tag, "attrs": kept, "text": None, "first": len(self.visible), "n": 0}
        self.elements.append(element)
        if tag not in VOID:
            self.open.append(element)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        depth = self._find({tag}, set() if tag in CONTAINERS else CONTAINERS)
        if depth is not None:
            self._close(depth)

    def handle_data(self, data):
        if self.open and self.open[-1]["tag"] in RAW_TEXT:
            self.open[-1]["text"] = (self.open[-1]["text"] or "") + data
        elif data.strip():
            self._next()
            self.visible.append(data.strip())
            self.texts.append(data.strip())

    def handle_comment(self, data):
        if data.strip():
            self._next()
            self.texts.append(data.strip())

    def result(self):
        self._close(0)
        parents = {e["parent"] for e in self.elements if e["tag"] in ("h2", "h3")}
        keep = [e for e in self.elements if e["attrs"] or e["tag"] in KEPT_TAGS or e["pre"] in parents]
        following = {}  # by parent, the next dd from here on
        for e in reversed(keep):
            e["attrs"] = list(e["attrs"].items())
            if e["tag"] == "dd":
                following[e["parent"]] = e
            elif e["tag"] == "dt" and (dd := following.get(e["parent"])):
                e["dd_first"], e["dd_n"] = dd["first"], dd["n"]
        return {"elements": keep, "visible": self.visible, "texts": self.texts}


def outline(page: str | None) -> dict | None:
    if page is None:
        return None
    parser = _Outline()
    parser.feed(page)
    parser.close()
    return parser.result()


_ELEMENT = pa.struct(
    [("pre", pa.int32()), ("post", pa.int32()), ("parent", pa.int32()), ("tag", pa.string()),
     ("attrs", pa.map_(pa.string(), pa.string())), ("text", pa.string()),
     ("first", pa.int32()), ("n", pa.int32()), ("dd_first", pa.int32()), ("dd_n", pa.int32())]
)
_OUTLINE = pa.struct([("elements", pa.list_(_ELEMENT)), ("visible", pa.list_(pa.string())), ("texts", pa.list_(pa.string()))])


def _outlines(pages: pa.Array) -> pa.Array:
    return pa.array([outline(p) for p in pages.to_pylist()], type=_OUTLINE)


def page_nodes(page: Column) -> Column:
    # marked so that the optimizer never evaluates it twice for one page
    return F.arrow_udf(_outlines, NODES).asNondeterministic()(page)


# ---- queries over the arrays ---------------------------------------------


def attr(element: Column, name: str) -> Column:
    return F.try_element_at(element["attrs"], F.lit(name))


def has_class(element: Column, name: str) -> Column:
    return F.coalesce(F.contains(attr(element, "class"), F.lit(f" {name} ")), F.lit(False))


def has_id(element: Column, name: str) -> Column:
    return F.coalesce(attr(element, "id") == name, F.lit(False))


def inside(node: Column, element: Column) -> Column:
    return (node["pre"] > element["pre"]) & (node["pre"] <= element["post"])


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, not once per use or per array entry."""
    return F.get(F.transform(F.array(value), body), 0)


def text_at(first: Column, n: Column, visible: Column, sep: str = " ") -> Column:
    return F.array_join(F.slice(visible, first + 1, n), sep)


def text_of(element: Column, visible: Column, sep: str = " ") -> Column:
    """Visible text of an element, its pieces joined by ``sep``; NULL for a NULL element."""
    return let(element, lambda e: F.when(e.isNotNull(), text_at(e["first"], e["n"], visible, sep)))


def first(elements: Column) -> Column:
    return F.get(elements, 0)


def under(elements: Column, container: str, tag: str) -> Column:
    """Elements of a tag below any element of a class."""
    holders = F.filter(elements, lambda e: has_class(e, container))
    return let(holders, lambda hs: F.filter(elements, lambda e: (e["tag"] == tag) & F.exists(hs, lambda h: inside(e, h))))
