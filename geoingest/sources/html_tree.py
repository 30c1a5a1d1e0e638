"""Pages as rows of a repaired element tree."""

from __future__ import annotations

import re
import sys
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoingest.functions.expr import compute_once
from geoingest.functions.html import strip_space, unescape_entities
from geoingest.sources.html import page_text

# The executors get these functions by value, they need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed values of the markup language: which elements have no content, hold text only, are no page text.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_TEXT_ONLY = frozenset("script style textarea title".split())
_HIDDEN = frozenset("script style template rt rp".split())
_FORMATTING = frozenset("a b big code em font i nobr s small strike strong tt u".split())
_MOST_ALIKE = 3  # of one formatting element that was left open are opened again
_HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
_LISTS = ("ul", "ol", "menu", "dl")
_CELLS = ("td", "th", "caption", "table", "button", "object", "template")
_BLOCKS = frozenset(
    "address article aside blockquote center details dialog dir div fieldset figcaption figure footer form header hgroup hr "
    "main nav p pre search section summary".split()
) | {*_HEADINGS, *_LISTS, *_CELLS, "li", "dt", "dd", "tr", "thead", "tbody", "tfoot"}
_SECTIONS = ("article", "aside", "blockquote", "nav", "section")
# What a start tag ends, and the elements it does not look beyond. Besides, every block ends a paragraph.
_ENDS = {
    **{name: (_HEADINGS, (*_CELLS, *_SECTIONS, *_LISTS, "div", "li")) for name in _HEADINGS},
    "li": (("li",), (*_LISTS, *_CELLS, *_SECTIONS)),
    **{name: (("dt", "dd"), (*_LISTS, *_CELLS, *_SECTIONS)) for name in ("dt", "dd")},
    **{name: (("td", "th", "caption"), ("tr", "table")) for name in ("td", "th")},
    "tr": (("tr", "td", "th", "caption", "colgroup"), ("table",)),
    **{name: (("thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"), ("table",)) for name in ("thead", "tbody", "tfoot")},
    "option": (("option",), ("select", "datalist", "optgroup")),
    "optgroup": (("option", "optgroup"), ("select",)),
    "a": (("a",), tuple(_BLOCKS)),
}
# What an end tag does not look beyond; any other inline element stays open around an open block.
_BOUNDS = {
    "table": (),
    **{name: ("table",) for name in ("tr", "td", "th", "thead", "tbody", "tfoot", "caption")},
    "li": (*_LISTS, *_CELLS),
    **{name: _CELLS for name in _BLOCKS - {*_CELLS, "li", "tr", "thead", "tbody", "tfoot"}},
    **{name: () for name in ("button", "object", "template", "select", "svg", "math")},
}
_INLINE_BOUNDS = tuple(_BLOCKS)

# A quote opens a value only behind an equals sign and if it is closed. A tag or comment that the page ends in is none.
_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][^\s/>]*+)((?:[^>=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|=)*+)(?:>|\Z)|<[/!?][^>]*+(?:>|\Z)""", re.S
)
_CHUNK = 8192


class _Tree:
    """Open elements of a page while its tokens go by; work and memory per token do not grow with the page."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, int]] = []
        self.places: dict[str, list[int]] = defaultdict(list)
        self.again: list[str] = []
        self.count = 0

    def row(self, tag: str | None, text: str | None = None) -> tuple:
        parent = self.stack[-1][1] if self.stack else None
        self.count += 1
        return self.count - 1, parent, len(self.stack), tag, text

    def open(self, name: str) -> tuple:
        told = self.row(name)
        self.places[name].append(len(self.stack))
        self.stack.append((name, told[0]))
        return told

    def outermost(self, names: tuple[str, ...], bounds: tuple[str, ...]) -> int | None:
        """Place of the outermost of the latest open ``names`` that no later one of ``bounds`` holds."""
        bound = max((self.places[b][-1] for b in bounds if b not in names and self.places[b]), default=-1)
        found = [self.places[n][-1] for n in names if self.places[n] and self.places[n][-1] > bound]
        return min(found, default=None)

    def close(self, place: int) -> None:
        """End the element at ``place`` and all in it; formatting that was left open in it goes on behind it."""
        closed = [name for name, _ in self.stack[place:]]
        del self.stack[place:]
        for name in closed:
            self.places[name].pop()
        if not any(name in _CELLS for name in closed):
            for name in closed[1:]:
                if name in _FORMATTING and self.again.count(name) < _MOST_ALIKE:
                    self.again.append(name)

    def reopen(self) -> Iterator[tuple]:
        names, self.again = self.again, []
        for name in names:
            yield self.open(name)

    def start(self, name: str, empty: bool) -> Iterator[tuple]:
        for names, bounds in (_ENDS.get(name, ((), ())), (("p",) if name in _BLOCKS else (), _CELLS)):
            place = self.outermost(names, bounds)
            if place is not None:
                self.close(place)
        if name not in _BLOCKS:
            yield from self.reopen()
        if name in _VOID or (empty and (self.places["svg"] or self.places["math"])):
            yield self.row(name)
        else:
            yield self.open(name)

    def end(self, name: str) -> None:
        place = self.outermost((name,), _BOUNDS.get(name, _INLINE_BOUNDS))
        if place is not None:
            self.close(place)
        elif name in self.again:
            self.again.remove(name)

    def text(self, text: str) -> Iterator[tuple]:
        if text and not text.isspace() and not any(self.places[name] for name in _HIDDEN):
            yield from self.reopen()
            yield self.row(self.stack[-1][0] if self.stack else None, text)


def _nodes(page: str) -> Iterator[tuple]:
    tree, at = _Tree(), 0
    while token := _TOKEN.search(page, at):
        yield from tree.text(page[at : token.start()])
        at = token.end()
        closing, name, rest = token.groups()
        if name is None or (at == len(page) and page[-1] != ">"):
            continue
        name = name.lower()
        if closing:
            tree.end(name)
            continue
        yield from tree.start(name, rest.endswith("/"))
        if name in _TEXT_ONLY and tree.places[name]:
            finish = re.compile(rf"</{name}(?=[\s/>])", re.I).search(page, at)
            until = finish.start() if finish else len(page)
            yield from tree.text(page[at:until])
            at = until
    yield from tree.text(page[at:])


def html_nodes(pages: DataFrame, *keys: str, body: str = "body") -> DataFrame:
    """Elements and text nodes of every page in page order: ``keys``, then ``node_pos, parent_pos, depth, tag, text``.

    ``tag`` names the element, or, beside a ``text``, the innermost element that holds it. Broken markup is
    repaired: elements whose end tag may be left out end where the next one starts (``p``, ``li``, ``dt``, ``dd``,
    table rows and cells, options, links in links, headings in headings); an end tag without its element is passed
    over, one that crosses a table cell or, for inline elements, a block too; formatting left open in a block or by
    misnested end tags is opened again for what follows, up to three elements of a name; a quote that is never closed is no quote; scripts,
    styles, titles and comments without an end run to the end of the page; a tag that the page ends in is none.
    ``html``, ``body`` or ``tbody`` elements that are not written are not added, rows without an open table are
    kept. Texts are stripped, blank ones left out, as are those of scripts, styles, templates and ruby annotations.

    Null and empty pages have no rows. A page is held by its task as one text, its rows leave it in chunks.
    """
    names = ["node_pos", "parent_pos", "depth", "tag", "text"]
    if set(keys) & set(names):
        raise ValueError(f"keys may not be named {sorted(set(keys) & set(names))}")
    source = compute_once(pages, "_page", page_text(pages, body)).select(*keys, "_page").where("_page IS NOT NULL")
    kinds = [T.IntegerType(), T.IntegerType(), T.IntegerType(), T.StringType(), T.StringType()]
    schema = T.StructType([*source.select(*keys).schema.fields, *map(T.StructField, names, kinds)])
    types = [pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.string()]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told(batch: pa.RecordBatch, owners: list[int], found: list[tuple]) -> pa.RecordBatch:
            kept = batch.select(list(keys)).take(pa.array(owners, pa.int64())).columns if keys else []
            cells = [pa.array(cell, kind) for cell, kind in zip(zip(*found), types)]
            return pa.RecordBatch.from_arrays([*kept, *cells], names=[*keys, *names])

        for batch in batches:
            owners, found = [], []
            for i, page in enumerate(batch.column(len(keys))):
                for node in _nodes(page.as_py()):
                    owners.append(i)
                    found.append(node)
                    if len(found) == _CHUNK:
                        yield told(batch, owners, found)
                        owners, found = [], []
            if found:
                yield told(batch, owners, found)

    nodes = source.mapInArrow(rows, schema)
    nodes = compute_once(nodes.withColumnRenamed("text", "_raw"), "text", strip_space(unescape_entities(F.col("_raw"))))
    return nodes.where("_raw IS NULL OR text <> ''").drop("_raw")
