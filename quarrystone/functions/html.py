"""HTML to text, Markdown and links in one Arrow pass, on a small tree built by the standard parser."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

# Elements without content, elements dropped from text, and from Markdown.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
DROPPED = frozenset("script style nav footer header aside".split())
DROPPED_MARKDOWN = frozenset("script style nav footer header".split())
_BODY = re.compile("content|post|article|entry", re.I)
_PROSE = re.compile("markdown|prose|content", re.I)
_BLOCK = frozenset("post entry hentry".split())
SLICE_PAGES, SLICE_CHARS = 256, 4 << 20


class Node:
    __slots__ = ("attributes", "children", "name", "parent")

    def __init__(self, name: str, attributes: dict[str, str], parent: "Node | None"):
        self.name, self.attributes, self.parent = name, attributes, parent
        self.children: list[Node | str] = []

    def walk(self) -> Iterator["Node"]:
        """Elements below this one in document order, without recursion."""
        stack = [c for c in reversed(self.children) if isinstance(c, Node)]
        while stack:
            node = stack.pop()
            yield node
            stack += [c for c in reversed(node.children) if isinstance(c, Node)]

    def strings(self) -> Iterator[str]:
        stack: list[Node | str] = list(reversed(self.children))
        while stack:
            item = stack.pop()
            if isinstance(item, str):
                yield item
            else:
                stack += reversed(item.children)

    def lines(self, separator: str = "\n") -> str:
        return separator.join(s for s in (x.strip() for x in self.strings()) if s)

    def first(self, test) -> "Node | None":
        return next((n for n in self.walk() if test(n)), None)

    def within(self, names: frozenset[str] | set[str]) -> bool:
        node = self.parent
        while node:
            if node.name in names:
                return True
            node = node.parent
        return False

    def unlink(self) -> None:
        """Take the tree apart: its parents and children name each other, which only the collector would find."""
        for node in [self, *self.walk()]:
            node.parent = None
            node.children = []

    def drop(self, names: frozenset[str]) -> None:
        for node in [self, *self.walk()]:
            node.children = [c for c in node.children if isinstance(c, str) or c.name not in names]


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {}, None)

    def handle_starttag(self, tag, attributes):
        node = Node(tag, {k: v or "" for k, v in attributes}, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag, attributes):
        self.handle_starttag(tag, attributes)
        if tag not in VOID:
            self.at = self.at.parent

    def handle_endtag(self, tag):
        node = self.at
        while node.parent and node.name != tag:
            node = node.parent
        if node.parent:
            self.at = node.parent

    def handle_data(self, data):
        self.at.children.append(data)


def parse(html: str | None) -> Node:
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    return builder.root


def main_content(root: Node, telling: re.Pattern = _BODY, by_id: bool = True) -> Node:
    """main, else article, else an element of a telling class or id, else the body, else all."""
    tests = [lambda n: n.name == "main", lambda n: n.name == "article", lambda n: telling.search(n.attributes.get("class", ""))]
    if by_id:
        tests.append(lambda n: telling.search(n.attributes.get("id", "")))
    tests.append(lambda n: n.name == "body")
    return next((found for t in tests if (found := root.first(t))), root)


def text_of(root: Node) -> str:
    return "\n".join(line for line in (x.strip() for x in main_content(root).lines().split("\n")) if line)


def markdown_of(root: Node, nested_twice: bool = False) -> str:
    """Headings, paragraphs, list items, code and quotations; a block inside another block is
    written once unless ``nested_twice``."""
    blocks = {"p", "li", "pre", "code", "blockquote"}
    out = []
    for node in main_content(root, _PROSE, by_id=False).walk():
        if not nested_twice and node.within(blocks):
            continue
        text = node.lines("")
        if not text:
            continue
        if node.name in ("h1", "h2", "h3", "h4"):
            out.append(f"\n{'#' * int(node.name[1])} {text}\n")
        elif node.name == "p":
            out.append(f"\n{text}\n")
        elif node.name == "li":
            out.append(f"- {text}")
        elif node.name in ("pre", "code"):
            code = "".join(node.strings())
            out.append(f"\n```\n{code}\n```\n" if "\n" in code else f"`{code}`")
        elif node.name == "blockquote":
            out += [f"> {line}" for line in text.split("\n")]
    return re.sub(r"\n{3,}", "\n\n", "\n".join(out)).strip()


def title_of(root: Node) -> str:
    for name in ("h1", "title"):
        node = root.first(lambda n, name=name: n.name == name)
        if node and (text := node.lines("")):
            return text
    return ""


#: A link with what the site-specific filters look at: where it stands, and the heading around it.
LINK = "struct<pos:int,href:string,text:string,block:int,heading:string,heading_class:string,under:string,in_nav:boolean>"
PAGE = f"title string, content string, markdown string, links array<{LINK}>, pdf_links array<string>, next_href string, section_ids array<string>"


def links_of(root: Node) -> list[dict]:
    blocks: dict[int, int] = {}
    out = []
    for node in root.walk():
        if node.name != "a" or not node.attributes.get("href"):
            continue
        block, heading, under = None, None, None
        at = node.parent
        while at:
            under = under or (at.name if at.name in ("h1", "h2", "h3", "h4") else None)
            if block is None and (at.name == "article" or _BLOCK & set(at.attributes.get("class", "").split())):
                block = blocks.setdefault(id(at), len(blocks))
                heading = at.first(lambda n: n.name in ("h1", "h2", "h3"))
            at = at.parent
        heading = heading or node.parent.first(lambda n: n.name in ("h1", "h2", "h3"))
        out.append({
            "pos": len(out), "href": node.attributes["href"].strip(), "text": node.lines(""), "block": block,
            "heading": heading.lines("") if heading else None, "heading_class": heading.attributes.get("class", "") if heading else None,
            "under": under, "in_nav": node.within({"nav", "header", "footer", "aside"}),
        })
    return out


def extract(html: str | None, strip_first: bool = True, nested_twice: bool = False) -> dict:
    """All of a page's fields. ``strip_first`` reads Markdown and PDF links from the tree that has
    already lost navigation, so links inside it are gone; site links are read before."""
    root = parse(html)
    links, title = links_of(root), title_of(root)
    follow = root.first(lambda n: n.name in ("a", "link") and "next" in n.attributes.get("rel", "").split())
    sections = [n.attributes["id"] for n in root.walk() if n.name in ("h1", "h2", "h3", "section") and n.attributes.get("id")]
    if not strip_first:
        root.drop(DROPPED_MARKDOWN)
        markdown = markdown_of(root, nested_twice)
        pdfs = [x["href"] for x in links]
        root.drop(DROPPED)
        content = text_of(root)
    else:
        root.drop(DROPPED)
        content, markdown = text_of(root), markdown_of(root, nested_twice)
        pdfs = [x["href"] for x in links_of(root)]
    fields = {
        "title": title, "content": content, "markdown": markdown, "links": links,
        "pdf_links": sorted({p for p in pdfs if p.lower().endswith(".pdf")}),
        "next_href": follow.attributes.get("href") if follow else None, "section_ids": sections,
    }
    root.unlink()
    return fields


def slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """A batch in runs of rows of at most ``SLICE_PAGES`` pages and some ``SLICE_CHARS`` bytes of ``column``: a page's fields are many times the page."""
    sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0).to_pylist()
    begin = held = 0
    for i, size in enumerate(sizes):
        if i > begin and (held + size > SLICE_CHARS or i - begin >= SLICE_PAGES):
            yield batch.slice(begin, i - begin)
            begin, held = i, 0
        held += size
    if begin < len(sizes):
        yield batch.slice(begin)


def with_page_fields(pages: DataFrame, strip_first: bool = True, nested_twice: bool = False) -> DataFrame:
    """``pages(url, html)`` plus the ``PAGE`` columns; null html gives empty fields."""
    frame = pages.sparkSession.createDataFrame([], PAGE).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        kind = to_arrow_schema(frame)
        for whole in batches:
            for batch in slices(whole, "html"):
                got = [extract(h.as_py(), strip_first, nested_twice) for h in batch.column(batch.schema.get_field_index("html"))]
                new = pa.RecordBatch.from_pylist(got, schema=kind)
                yield pa.RecordBatch.from_arrays([*batch.columns, *new.columns], [*batch.schema.names, *new.schema.names])

    return pages.mapInArrow(run, type(frame)([*pages.schema, *frame]))
