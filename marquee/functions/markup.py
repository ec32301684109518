"""Fields of stored pages by selectors: one pass per page, elements end where their nesting ends.

A selector is a chain of ``tag.class.class`` steps, each inside the one before; ``@name`` at the end asks for an
attribute instead of the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


class Field(NamedTuple):
    """The first match of the first selector that has any, or all matches when ``many``."""

    selectors: tuple[str, ...]
    many: bool = False


class Group(NamedTuple):
    """One struct of fields for each element the selector finds."""

    selector: str
    fields: dict[str, Field]


class Element:
    __slots__ = ("tag", "attrs", "classes", "parent", "children")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Element | None):
        self.tag, self.attrs, self.parent, self.children = tag, attrs, parent, []
        self.classes = set((attrs.get("class") or "").split())

    def inside(self) -> Iterator[Element | str]:
        """Elements and texts below, in document order."""
        waiting = self.children[::-1]
        while waiting:
            node = waiting.pop()
            yield node
            if isinstance(node, Element):
                waiting += node.children[::-1]

    def text(self) -> str:
        return "".join(node for node in self.inside() if isinstance(node, str)).strip()


class _Reader(HTMLParser):
    def __init__(self, ignored: frozenset[str]):
        super().__init__(convert_charrefs=True)
        self.top = self.at = Element("", {}, None)
        self.ignored = ignored

    def handle_starttag(self, tag, attrs):
        found = Element(tag, {name: value or "" for name, value in attrs}, self.at)
        if not found.classes & self.ignored:
            self.at.children.append(found)
        if tag not in VOID:
            self.at = found

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.at = self.at.parent

    def handle_endtag(self, tag):
        open_tag = self.at
        while open_tag is not None and open_tag.tag != tag:
            open_tag = open_tag.parent
        if open_tag is not None and open_tag.parent is not None:
            self.at = open_tag.parent

    def handle_data(self, data):
        self.at.children.append(data)


def parsed(html: str, ignored: frozenset[str] = frozenset()) -> Element:
    reader = _Reader(ignored)
    reader.feed(html)
    reader.close()
    return reader.top


def _steps(selector: str) -> tuple[list[tuple[str, set[str]]], str]:
    path, _, attribute = selector.partition("@")
    steps = [(step.split(".")[0], set(step.split(".")[1:])) for step in path.split()]
    return steps, attribute


def _fits(element: Element, step: tuple[str, set[str]]) -> bool:
    return step[0] in ("", element.tag) and step[1] <= element.classes


def elements(top: Element, steps: list[tuple[str, set[str]]]) -> Iterator[Element]:
    for node in top.inside():
        if isinstance(node, Element) and _fits(node, steps[-1]):
            left, above = steps[:-1], node.parent
            while left and above is not None and above is not top:
                if _fits(above, left[-1]):
                    left = left[:-1]
                above = above.parent
            if not left:
                yield node


def value(top: Element, field: Field) -> str | list[str] | None:
    for selector in field.selectors:
        steps, attribute = _steps(selector)
        found = (element.attrs.get(attribute) if attribute else element.text() for element in elements(top, steps))
        kept = [one for one in found if one] if field.many else next((one for one in found if one), None)
        if kept:
            return kept
    return [] if field.many else None


def values(top: Element, spec: dict[str, Field | Group]) -> dict:
    return {
        name: [values(element, wanted.fields) for element in elements(top, _steps(wanted.selector)[0])]
        if isinstance(wanted, Group)
        else value(top, wanted)
        for name, wanted in spec.items()
    }


def _type(wanted: Field | Group) -> pa.DataType:
    if isinstance(wanted, Group):
        return pa.list_(pa.struct([(name, _type(field)) for name, field in wanted.fields.items()]))
    return pa.list_(pa.string()) if wanted.many else pa.string()


def _name(kind: pa.DataType) -> str:
    if pa.types.is_list(kind):
        return f"array<{_name(kind.value_type)}>"
    if pa.types.is_struct(kind):
        return f"struct<{', '.join(f'{field.name}: {_name(field.type)}' for field in kind)}>"
    return "string"


def extract(pages: DataFrame, spec: dict[str, Field | Group], ignore: tuple[str, ...] = ("label",)) -> DataFrame:
    """(page_id, url) and the spec's fields of every page; a missing page text has none.

    Elements of an ignored class are left out with all they hold. Python sees a partition's pages batch by batch.
    """
    kinds = {name: _type(wanted) for name, wanted in spec.items()}
    ignored = frozenset(ignore)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), *kinds.items()])
        for batch in batches:
            rows = [values(parsed(html or "", ignored), spec) for html in batch.column("html").to_pylist()]
            columns = [pa.array([row[name] for row in rows], kind) for name, kind in kinds.items()]
            yield pa.RecordBatch.from_arrays([batch.column("page_id").cast(pa.int64()), batch.column("url").cast(pa.string()), *columns], schema=schema)

    ddl = ", ".join(["page_id long", "url string", *(f"`{name}` {_name(kind)}" for name, kind in kinds.items())])
    return pages.select("page_id", "url", "html").mapInArrow(run, ddl)
