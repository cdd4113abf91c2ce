"""Text blocks and links of HTML pages, read with the standard parser in one Arrow function."""

from __future__ import annotations

from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK_TAGS = {"p", "h1", "h2", "h3", "h4", "h5", "h6"}
# Elements without content.
VOID_TAGS = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track",
             "wbr"}
SILENT_TAGS = {"script", "style", "template"}
# What is taken out before reading, one element per rule: the first of a tag, or the one with an id.
BOILERPLATE = ["footer", "header", "nav", "#mw-head", "#mw-panel"]
# The legacy rules: a second footer in place of the header, and everything done twice.
LEGACY_BOILERPLATE = ["footer", "footer", "nav", "#mw-head", "#mw-panel"] * 2

LINK = pa.struct([("href", pa.string()), ("anchor", pa.string())])
PARSED = pa.struct([("blocks", pa.list_(pa.string())), ("links", pa.list_(LINK)), ("references", pa.list_(LINK)),
                    ("all_links", pa.list_(LINK))])
PAGES_AT_ONCE = 64  # pages whose results are held as Python objects
_LINKS = T.ArrayType(T.StructType([T.StructField("href", T.StringType()), T.StructField("anchor", T.StringType())]))
PARSED_TYPE = T.StructType([T.StructField("blocks", T.ArrayType(T.StringType())), T.StructField("links", _LINKS),
                            T.StructField("references", _LINKS), T.StructField("all_links", _LINKS)])


class Element:
    def __init__(self, tag: str, attrs: dict, parent: Element | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list = []
        self.removed = False

    def matches(self, rule: str) -> bool:
        return self.attrs.get("id") == rule[1:] if rule.startswith("#") else self.tag == rule


class Comment(str):
    """Stands in the tree but is no text."""


class TreeReader(HTMLParser):
    """The page as a tree. An end tag closes the latest open element of its name and all inside it."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.place = Element("", {}, None)
        self.open: dict[str, int] = {}

    def handle_starttag(self, tag, attrs):
        element = Element(tag, dict(attrs), self.place)  # of a repeated attribute the last counts
        self.place.children.append(element)
        if tag not in VOID_TAGS:
            self.place = element
            self.open[tag] = self.open.get(tag, 0) + 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        self.handle_endtag(tag)

    def handle_endtag(self, tag):
        while self.open.get(tag):
            closed, self.place = self.place, self.place.parent
            self.open[closed.tag] -= 1
            if closed.tag == tag:
                break

    def handle_data(self, data):
        children = self.place.children
        if children and type(children[-1]) is str:
            children[-1] += data
        else:
            children.append(data)

    def handle_comment(self, data):
        self.place.children.append(Comment(data))


def elements_in_order(root: Element) -> list[Element]:
    """All elements in document order, without those under a removed one."""
    found, waiting = [], [root]
    while waiting:
        element = waiting.pop()
        if element.removed:
            continue
        found.append(element)
        waiting.extend(c for c in reversed(element.children) if isinstance(c, Element))
    return found


def texts_under(element: Element, own_only: bool) -> list[str]:
    """Text pieces in order; with ``own_only`` those of inner blocks are left to them."""
    pieces, waiting = [], list(reversed(element.children))
    while waiting:
        child = waiting.pop()
        if isinstance(child, Element):
            if not (child.removed or child.tag in SILENT_TAGS or (own_only and child.tag in BLOCK_TAGS)):
                waiting.extend(reversed(child.children))
        elif not isinstance(child, Comment):
            pieces.append(child)
    return pieces


def only_string(element: Element) -> str | None:
    """The text of an element with a single child, through single children; else nothing."""
    while len(element.children) == 1:
        child = element.children[0]
        if not isinstance(child, Element):
            return str(child)
        element = child
    return None


def parse_page(html: str, rules: list[str], nested: str) -> dict:
    reader = TreeReader()
    reader.feed(html)
    reader.close()
    for rule in rules:
        first = next((e for e in elements_in_order(reader.root) if e.matches(rule)), None)
        if first is not None:
            first.removed = True
            first.parent.children.remove(first)
            release(first)
    blocks, links, references, all_links = [], [], [], []
    inside = {id(reader.root): (False, False)}
    for element in elements_in_order(reader.root)[1:]:
        in_block, in_references = inside[id(element.parent)]
        if element.tag == "a" and element.attrs.get("href") is not None:
            link = {"href": element.attrs["href"], "anchor": only_string(element)}
            all_links.append(link)
            if in_block:
                links.append(link)
            if in_references:
                references.append(link)
        if element.tag in BLOCK_TAGS:
            pieces = (piece.strip() for piece in texts_under(element, nested == "once"))
            blocks.append(" ".join(piece for piece in pieces if piece))
            in_block = True
        if element.tag == "ol" and "references" in (element.attrs.get("class") or "").split():
            in_references = True
        inside[id(element)] = in_block, in_references
    release(reader.root)
    return {"blocks": blocks, "links": links, "references": references, "all_links": all_links}


def release(root: Element) -> None:
    """Take a tree apart, so that it goes at once: parents and children hold each other."""
    waiting = [root]
    while waiting:
        element = waiting.pop()
        waiting.extend(c for c in element.children if isinstance(c, Element))
        element.parent, element.children = None, []


def parse_batch(pages: pa.Array, rules: list[str], nested: str) -> pa.Array:
    """The pages of a batch, read a few at a time; of the others only the Arrow form is held."""
    parts = []
    for start in range(0, len(pages), PAGES_AT_ONCE):
        few = (p.as_py() for p in pages.slice(start, PAGES_AT_ONCE))
        parts.append(pa.array([None if p is None else parse_page(p, rules, nested) for p in few], PARSED))
    return pa.concat_arrays(parts) if parts else pa.array([], PARSED)


def decoded(text: Column) -> Column:
    """Character references of every kind replaced by what they stand for."""

    @F.arrow_udf("string")
    def decode(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else unescape(t) for t in texts.to_pylist()], pa.string())

    # texts without a reference stay where they are
    return F.when(F.contains(text, F.lit("&")), decode(text)).otherwise(text)


def read_markup(html: Column, rules: list[str] = BOILERPLATE, nested: str = "once") -> Column:
    """Struct ``blocks, links, references, all_links`` of a page.

    ``nested`` says what an unclosed paragraph does to the blocks after it: ``once`` gives each text
    to its innermost block, ``repeat`` gives it to every block around it as well.
    """
    rules = list(rules)

    @F.arrow_udf(PARSED_TYPE)
    def parse(pages: pa.Array) -> pa.Array:
        return parse_batch(pages, rules, nested)

    # not for its results: Spark would push filters on them below and parse every page again
    return parse.asNondeterministic()(html)
