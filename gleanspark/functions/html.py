"""HTML and XML text as Column functions, plus one small tree reader for what patterns cannot tell."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator, Mapping, Sequence
from html.entities import html5
from html.parser import HTMLParser
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F

from .text import constant, let, strip_space

BREAK = "\x01"
# comments, declarations and elements whose text is not page text
# all forms start with one bracket, named once, so that other characters are passed over in one step
HIDDEN = r"(?is)<(?:!--.*?-->|(script|style|template|rt|rp)\b[^>]*>.*?</\1\s*>|[!?][^>]*>)"
TAG = r"""</?[A-Za-z](?:(?:[^>"']++|"[^"]*+"|'[^']*+')*+>|[^>]*>)"""
# tags are read attribute by attribute, so each takes few steps and quoted values may hold anything
GAP = r"""[\s/"'=]*+"""
ATTRIBUTE = r"""[^\s=>"'/]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"']++))?"""
HREF = rf"""(?is)<a(?=[\s/])(?:{GAP}(?!href[\s=]){ATTRIBUTE})*+{GAP}href\s*+=\s*+("[^"]*"|'[^']*'|[^\s>"']+)"""
# an anchor that is not closed ends where the next one starts
ANCHOR = rf"""(?is)<a(?=[\s/])(?:{GAP}{ATTRIBUTE})*+{GAP}>.*?(?:</a\s*>|(?=<a[\s/>])|$)"""
META = r"""(?is)<meta(?=[\s"'/])(?:[^>"']++|"[^"]*+"|'[^']*+')*+>"""
ENTITY = r"^(#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"
# in page text a reference may also end before any other character
BARE_ENTITY = r"^(#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]{1,31})(?=[^A-Za-z0-9])"

# The five most common entities are tried before the full table.
COMMON_ENTITIES = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "nbsp": " "}


def _entity_table() -> Column:
    """All named entities of HTML 5, and the numbers 128-159 that mean Windows-1252 characters."""
    table = {name[:-1]: value for name, value in html5.items() if name.endswith(";")}
    table.update({f"#{n}": bytes([n]).decode("cp1252", "replace") for n in range(128, 160)})
    return constant(table, "map<string,string>")


def _character(code: Column) -> Column:
    """One character by its number; an impossible number gives the replacement character."""
    valid = (code > 0) & (code <= 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    safe = F.when(valid, code).otherwise(F.lit(0xFFFD))
    return F.decode(F.unhex(F.lpad(F.hex(safe), 8, "0")), "UTF-32")


def decode_entities(text: Column, bare: bool = False) -> Column:
    """Character references replaced by their characters; unknown ones stay. With `bare` they need no semicolon."""
    table = _entity_table()

    def character(name: Column) -> Column:
        code = (
            F.when(name.rlike("^#[xX]"), F.conv(F.substr(name, F.lit(3)), 16, 10))
            .when(name.startswith("#"), F.substr(name, F.lit(2)))
            .try_cast("bigint")
        )
        value = F.try_element_at(table, name)
        value = F.when(name.startswith("#"), F.coalesce(value, let(code, _character))).otherwise(value)
        for common, text_value in COMMON_ENTITIES.items():
            value = F.when(name == common, text_value).otherwise(value)
        return value

    def piece(part: Column, index: Column) -> Column:
        def replaced(name: Column) -> Column:
            tail = F.substr(part, F.length(name) + (F.when(F.substr(part, F.length(name) + 1, F.lit(1)) == ";", 2).otherwise(1) if bare else 2))
            return F.coalesce(F.concat(F.when(name != "", character(name)), tail), F.concat(F.lit("&"), part))

        return F.when(index == 0, part).otherwise(let(F.regexp_extract(part, BARE_ENTITY if bare else ENTITY, 1), replaced))

    decoded = F.array_join(F.transform(F.split(text, "&", -1), piece), "")
    return F.when(text.contains("&"), decoded).otherwise(text)


# references that XML itself knows, and what cannot be markup
XML_REFERENCE = r"&(?=(?:amp|lt|gt|quot|apos|#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6});)"
BARE_AMPERSAND = r"&(?!(?:amp|lt|gt|quot|apos|#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6});)"
BARE_BRACKET = r"<(?![A-Za-z/!?])"
NOT_XML = r"[\x00-\x08\x0B\x0C\x0E-\x1F]"


def repaired_xml(markup: Column) -> Column:
    """Markup with what XML cannot read made text: characters it forbids go, named references become their characters,
    bare ampersands and brackets are escaped. Sections marked as character data become escaped text as they are."""

    def outside(part: Column) -> Column:
        named = decode_entities(F.regexp_replace(part, XML_REFERENCE, "&amp;"))
        return F.regexp_replace(F.regexp_replace(named, BARE_AMPERSAND, "&amp;"), BARE_BRACKET, "&lt;")

    def escaped(data: Column) -> Column:
        return F.replace(F.replace(F.replace(data, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))

    def piece(part: Column, index: Column) -> Column:
        end = F.instr(part, "]]>")
        data = F.concat(escaped(F.substr(part, F.lit(1), end - 1)), outside(F.substr(part, end + 3)))
        return F.when((index == 0) | (end == 0), outside(part)).otherwise(data)

    parts = F.split(F.regexp_replace(markup, NOT_XML, ""), r"<!\[CDATA\[", -1)
    return F.array_join(F.transform(parts, piece), "")


def _text_nodes(html: Column) -> Column:
    visible = F.regexp_replace(html, HIDDEN, BREAK)
    # decoding names its text several times
    marked = let(F.regexp_replace(visible, TAG, BREAK), lambda m: decode_entities(m, bare=True))
    return F.split(marked, BREAK, -1)


def html_to_text(html: Column) -> Column:
    """Text nodes, each trimmed, joined by a space."""
    nodes = F.transform(_text_nodes(html), strip_space)
    return F.array_join(F.filter(nodes, lambda n: n != ""), " ")


def html_to_plain(html: Column) -> Column:
    """Text nodes joined as they are, the ends trimmed; for titles that carry markup."""
    return strip_space(F.array_join(_text_nodes(html), ""))


def anchor_text(html: Column) -> Column:
    """Text nodes, each trimmed, joined without a space."""
    return F.array_join(F.transform(_text_nodes(html), strip_space), "")


def _attribute_value(raw: Column) -> Column:
    return strip_space(decode_entities(F.regexp_replace(raw, r"""^["']|["']$""", "")))


def hrefs(html: Column) -> Column:
    """Link targets of all anchors in document order."""
    shown = F.regexp_replace(html, HIDDEN, BREAK)
    return F.transform(F.regexp_extract_all(shown, F.lit(HREF), F.lit(1)), _attribute_value)


def anchors(html: Column) -> Column:
    """S7, links and texts only: array of (href, text) in document order."""
    shown = F.regexp_replace(html, HIDDEN, BREAK)
    whole = F.filter(F.regexp_extract_all(shown, F.lit(ANCHOR), F.lit(0)), lambda a: a.rlike(HREF))
    return F.transform(whole, lambda a: F.struct(
        _attribute_value(F.regexp_extract(a, HREF, 1)).alias("href"),
        anchor_text(a).alias("text"),
    ))


def first_external_link(html: Column, accept, own_link: Column | None = None) -> Column:
    """The first link that passes `accept` (a function of Column), else the entry's own link."""
    found = F.try_element_at(F.filter(hrefs(html), accept), F.lit(1))
    own = F.lit(None).cast("string") if own_link is None else F.nullif(own_link, F.lit(""))
    return F.coalesce(found, own)


def meta_content(html: Column, prop: str) -> Column:
    """Content of the first <meta property=...>, attributes in any order; null when absent or empty."""
    named = rf"""(?is)[\s"'/]property\s*=\s*["']?{prop}["'\s/>]"""
    tags = F.filter(F.regexp_extract_all(html, F.lit(META), F.lit(0)), lambda tag: tag.rlike(named))
    raw = F.regexp_extract(F.coalesce(F.try_element_at(tags, F.lit(1)), F.lit("")), r"""(?is)[\s"'/]content\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)""", 1)
    return F.nullif(_attribute_value(raw), F.lit(""))


VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = {"p", "li"}
# bytes of pages whose trees a task holds at a time
PAGE_BYTES = 1 << 20
HIDDEN_TAGS = {"script", "style", "template", "rt", "rp"}


class _Tree(HTMLParser):
    """Elements in document order, read in one pass, each with its attributes and range of text nodes.

    An end tag closes everything up to the nearest open element of its name and
    is ignored when there is none; unclosed elements run to the end. What a
    caller asks of ancestors is carried along: how many elements of a name are
    open, the nearest paragraph or list item, whether the container is open,
    and which open rows still lack a child.
    """

    def __init__(self, html: str, container: str | None = None, row_class: str | None = None, children: Mapping[str, str] | None = None):
        super().__init__(convert_charrefs=True)
        self.container, self.row_class, self.children = container, row_class, children or {}
        self.elements: list[dict] = []
        self.texts: list[str] = []
        self.open: list[int] = []
        self.counts: Counter = Counter()
        self.buffer: list[str] = []
        self.root: int | None = None
        self.rows: list[dict] = []
        # per child: open rows that have none yet, innermost last
        self.lacking: dict[str, list[dict]] = {out: [] for out in self.children}
        self.feed(html)
        self.close()
        self._flush()
        for index in self.open:
            self.elements[index]["end"] = len(self.texts)
        shown = [bool(t) for t in self.texts]
        # how many text nodes that show come before each, and where they stand in all text joined
        self.before = list(accumulate(shown, initial=0))
        self.shown = [t for t in self.texts if t]
        self.joined: dict[str, tuple[str, list[int]]] = {}

    def _flush(self):
        if self.buffer:
            hidden = any(self.elements[i]["tag"] in HIDDEN_TAGS for i in self.open[-1:])
            self.texts.append("" if hidden else "".join(self.buffer).strip())
            self.buffer.clear()

    def handle_data(self, data):
        self.buffer.append(data)

    def handle_comment(self, data):
        self._flush()

    def handle_starttag(self, tag, attrs):
        self._flush()
        values: dict = {}
        for name, value in attrs:
            values[name] = value or ""
        index = len(self.elements)
        element = {"tag": tag, "attrs": values, "start": len(self.texts), "end": len(self.texts), "block": None, "inside": False}
        if self.open:
            parent = self.elements[self.open[-1]]
            element["block"] = parent if parent["tag"] in BLOCKS else parent["block"]
            element["inside"] = parent["inside"] or self.open[-1] == self.root
        self.elements.append(element)
        classes = values.get("class", "").split()
        if self.root is None and self.container in classes:
            self.root = index
        for out, rows in self.lacking.items():
            if rows and self.children[out] in classes:
                for row in rows:
                    row["children"][out] = element
                rows.clear()
        if self.row_class in classes:
            element["children"] = {}
            self.rows.append(element)
            if tag not in VOID:
                for rows in self.lacking.values():
                    rows.append(element)
        if tag not in VOID:
            self.open.append(index)
            self.counts[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self._flush()
        while self.counts[tag]:
            element = self.elements[self.open.pop()]
            element["end"] = len(self.texts)
            self.counts[element["tag"]] -= 1
            if "children" in element:
                for rows in self.lacking.values():
                    if rows and rows[-1] is element:
                        rows.pop()
            if element["tag"] == tag:
                break

    def text(self, element: dict, separator: str) -> str:
        """Text nodes of an element that show, joined: a stretch of all of them joined once."""
        if separator not in self.joined:
            starts = list(accumulate((len(t) + len(separator) for t in self.shown), initial=0))
            self.joined[separator] = separator.join(self.shown), starts
        whole, starts = self.joined[separator]
        first, last = self.before[element["start"]], self.before[element["end"]]
        return whole[starts[first]:starts[last] - len(separator)] if last > first else ""


def _slices(pages: pa.Array, size: int = PAGE_BYTES) -> Iterator[pa.Array]:
    """All pages in order, about `size` bytes at a time; a longer page comes alone."""
    total = np.cumsum(pc.fill_null(pc.binary_length(pages), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(pages):
        end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + size, side="right")))
        yield pages.slice(at, end - at)
        at = end


def _per_page(html: Column, fields: Sequence[str], read: Callable[[str], list[dict]]) -> Column:
    """What `read` finds in each page, an array of structs of strings; null counts as an empty page.

    Arrow hands over many pages at once. Their trees and what is found in them are held
    for one slice of pages only, so a task's memory doesn't grow with its batches.
    """
    shape = pa.list_(pa.struct([(f, pa.string()) for f in fields]))

    @F.arrow_udf(f"array<struct<{', '.join(f'{f}: string' for f in fields)}>>")
    def extract(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for pages in batches:
            for part in _slices(pages):
                yield pa.array([read(page or "") for page in part.to_pylist()], shape)

    return extract(html)


def _context_anchors(html: str, container: str | None) -> list[dict]:
    tree = _Tree(html, container)
    if container is not None and tree.root is None:
        return []
    out, contexts = [], {}
    for element in tree.elements:
        if element["tag"] != "a" or "href" not in element["attrs"] or container is not None and not element["inside"]:
            continue
        block = element["block"]
        if block is not None and id(block) not in contexts:
            contexts[id(block)] = tree.text(block, " ")
        out.append({
            "href": element["attrs"]["href"].strip(),
            "text": tree.text(element, ""),
            "context": contexts[id(block)] if block is not None else "",
        })
    return out


def context_anchors(html: Column, container: str | None = None) -> Column:
    """S7 with context: array of (href, text, context) inside the first element of class `container`.

    The context is the text of the nearest enclosing paragraph or list item,
    which needs the page's tree, so pages go to Python in Arrow batches.
    """

    return _per_page(html, ["href", "text", "context"], lambda page: _context_anchors(page, container))


def classed_rows(html: Column, row_class: str, attributes: dict[str, str], children: dict[str, str]) -> Column:
    """One struct per element of class `row_class`, with attribute values and child texts.

    `attributes` maps output names to attribute names, `children` maps output
    names to the class of the first descendant that holds the text.
    """
    def rows(page: str) -> list[dict]:
        tree = _Tree(page, row_class=row_class, children=children)
        found = []
        for row in tree.rows:
            record = {out: row["attrs"].get(attr) for out, attr in attributes.items()}
            for out in children:
                child = row["children"].get(out)
                record[out] = tree.text(child, "") if child else ""
            found.append(record)
        return found

    return _per_page(html, [*attributes, *children], rows)
