"""Lenient HTML parsing: one page in, its element tree as flat arrays out.

This is the only step that reads markup. It runs once per page as an Arrow
function, without a shuffle; everything after it works on its columns.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.batches import pieces
from ..schemas import DOM
from ..vocab import LIST_ATTRS_ANY_TAG, LIST_ATTRS_BY_TAG, TEXTLESS_TAGS, VOID_TAGS

_VOID = frozenset(VOID_TAGS)
_TEXTLESS = frozenset(TEXTLESS_TAGS)
_LIST_ANY = frozenset(LIST_ATTRS_ANY_TAG)
_LIST_BY_TAG = {tag: frozenset(names) for tag, names in LIST_ATTRS_BY_TAG.items()}


class _Columns:
    """Value buffers of one output batch."""

    def __init__(self):
        self.parent, self.end, self.depth = [], [], []
        self.s_from, self.s_to, self.tag = [], [], []
        self.attr_name, self.attr_is_list, self.attr_offsets = [], [], [0]
        self.value, self.value_offsets = [], [0]
        self.node_id, self.node_offsets = [], [0]
        self.string_node, self.string_text, self.string_offsets = [], [], [0]
        self.error, self.present = [], []

    def cut(self, mark: tuple[int, ...]) -> None:
        """Drop everything a failed page appended after ``mark``."""
        for buffer, size in zip(self._buffers(), mark):
            del buffer[size:]

    def mark(self) -> tuple[int, ...]:
        return tuple(len(b) for b in self._buffers())

    def _buffers(self):
        return (
            self.parent, self.end, self.depth, self.s_from, self.s_to, self.tag,
            self.attr_name, self.attr_is_list, self.attr_offsets,
            self.value, self.value_offsets, self.node_id, self.string_node, self.string_text,
        )

    def to_arrow(self) -> pa.Array:
        ints, text = pa.int32(), pa.string()
        values = pa.ListArray.from_arrays(pa.array(self.value_offsets, ints), pa.array(self.value, text))
        attr = pa.StructArray.from_arrays(
            [pa.array(self.attr_name, text), pa.array(self.attr_is_list, pa.bool_()), values],
            names=["name", "is_list", "values"],
        )
        node = pa.StructArray.from_arrays(
            [
                pa.array(self.node_id, ints), pa.array(self.parent, ints),
                pa.array(self.end, ints), pa.array(self.depth, ints),
                pa.array(self.s_from, ints), pa.array(self.s_to, ints),
                pa.array(self.tag, text),
                pa.ListArray.from_arrays(pa.array(self.attr_offsets, ints), attr),
            ],
            names=["node_id", "parent_id", "end_id", "depth", "s_from", "s_to", "tag", "attrs"],
        )
        string = pa.StructArray.from_arrays(
            [pa.array(self.string_node, ints), pa.array(self.string_text, text)],
            names=["node_id", "text"],
        )
        return pa.StructArray.from_arrays(
            [
                pa.ListArray.from_arrays(pa.array(self.node_offsets, ints), node),
                pa.ListArray.from_arrays(pa.array(self.string_offsets, ints), string),
                pa.array(self.error, text),
            ],
            names=["nodes", "strings", "error"],
            mask=pa.array([not p for p in self.present], pa.bool_()),
        )


class _Tree(HTMLParser):
    """Builds the tree of one page.

    Void tags close at once, an end tag closes up to the nearest open element of
    its name, an end tag without an open element is ignored, and no end tag is
    implied. Elements in ``drop`` vanish with all they hold; the texts on both
    sides of one become a single string.
    """

    def __init__(self, out: _Columns, drop: frozenset[str]):
        super().__init__(convert_charrefs=True)
        self.out, self.drop = out, drop
        self.base = len(out.node_id)
        self.string_base = len(out.string_node)
        self.stack: list[tuple[str, int]] = []
        self.ancestors: list[int] = []
        self.open: dict[str, int] = {}
        self.muted_at: int | None = None
        self.textless = 0
        self.buffer: list[str] = []

    def handle_starttag(self, tag, attrs):
        self.start(tag, attrs, closed=tag in _VOID)

    def handle_startendtag(self, tag, attrs):
        self.start(tag, attrs, closed=True)

    def start(self, tag, attrs, closed):
        muted = self.muted_at is not None
        if muted or tag in self.drop:
            if not closed:
                if not muted:
                    self.muted_at = len(self.stack)
                self._push(tag, -1)
            return
        self._flush()
        out = self.out
        node_id = len(out.node_id) - self.base
        ancestors = self.ancestors
        out.node_id.append(node_id)
        out.parent.append(ancestors[-1] if ancestors else None)
        out.end.append(node_id)
        out.depth.append(len(ancestors))
        count = len(out.string_node) - self.string_base
        out.s_from.append(count)
        out.s_to.append(count)
        out.tag.append(tag)
        if attrs:
            by_tag = _LIST_BY_TAG.get(tag, ())
            for name, value in dict(attrs).items():
                is_list = name in _LIST_ANY or name in by_tag
                out.attr_name.append(name)
                out.attr_is_list.append(is_list)
                out.value.extend((value or "").split() if is_list else [value or ""])
                out.value_offsets.append(len(out.value))
        out.attr_offsets.append(len(out.attr_name))
        if not closed:
            self._push(tag, node_id)

    def _push(self, tag, node_id):
        self.stack.append((tag, node_id))
        if node_id >= 0:
            self.ancestors.append(node_id)
        self.open[tag] = self.open.get(tag, 0) + 1
        self.textless += tag in _TEXTLESS

    def handle_endtag(self, tag):
        if not self.open.get(tag):
            return
        at = len(self.stack) - 1
        while self.stack[at][0] != tag:
            at -= 1
        if self.muted_at is None or at < self.muted_at:
            if self.muted_at is not None:
                self._pop_to(self.muted_at)
            self._flush()
        self._pop_to(at)

    def _pop_to(self, size):
        out = self.out
        last = len(out.node_id) - self.base - 1
        strings = len(out.string_node) - self.string_base
        while len(self.stack) > size:
            tag, node_id = self.stack.pop()
            self.open[tag] -= 1
            self.textless -= tag in _TEXTLESS
            if node_id >= 0:
                self.ancestors.pop()
                out.end[self.base + node_id] = last
                out.s_to[self.base + node_id] = strings
        if self.muted_at is not None and size <= self.muted_at:
            self.muted_at = None

    def handle_data(self, data):
        if self.muted_at is None and not self.textless:
            self.buffer.append(data)

    def handle_comment(self, data):
        if self.muted_at is None:
            self._flush()

    handle_decl = handle_pi = unknown_decl = handle_comment

    def _flush(self):
        if not self.buffer:
            return
        text = "".join(self.buffer)
        self.buffer.clear()
        if text.isspace():
            text = "\n" if "\n" in text else " "
        if text:
            self.out.string_node.append(self.stack[-1][1] if self.stack else -1)
            self.out.string_text.append(text)

    def finish(self):
        if self.muted_at is not None:
            self._pop_to(self.muted_at)
        self._flush()
        self._pop_to(0)


_BLANK = "[\\t\\n\\r\\f ]"
_ATTRIBUTE = re.compile(
    rf"{_BLANK}+([a-zA-Z_:][-a-zA-Z0-9_:.]*)"
    rf"(?:{_BLANK}*={_BLANK}*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'=<>`/]+)))?"
)
_MARKUP = re.compile(
    rf"<(?:([a-zA-Z][a-zA-Z0-9]*)((?:{_BLANK}+[a-zA-Z_:][-a-zA-Z0-9_:.]*"
    rf"(?:{_BLANK}*={_BLANK}*(?:\"[^\"]*\"|'[^']*'|[^\s\"'=<>`/]+))?)*){_BLANK}*(/?)>"
    rf"|/([a-zA-Z][a-zA-Z0-9]*){_BLANK}*>|(!--)|(![dD][oO][cC][tT][yY][pP][eE]{_BLANK}[^<>\\[]*>))"
)
#: Elements whose content is not markup for the parser.
_RAW_TEXT = frozenset(["script", "style"])
_OPAQUE = frozenset(["title", "textarea", "xmp", "iframe", "noembed", "noframes", "plaintext"])


def _feed_plain(tree: _Tree, html: str) -> bool:
    """Feed a page made of well-formed tags, comments and text.

    Several times faster than the general parser and the same for such pages.
    Gives up (False) at the first construct it is not sure about.
    """
    at, size = 0, len(html)
    while at < size:
        opened = html.find("<", at)
        if opened != at:
            text = html[at:] if opened < 0 else html[at:opened]
            if opened < 0 and "&" in text:
                return False
            tree.handle_data(unescape(text) if "&" in text else text)
            if opened < 0:
                return True
        found = _MARKUP.match(html, opened)
        if found is None:
            return False
        at = found.end()
        tag, attrs, slash, end_tag, comment, _ = found.groups()
        if end_tag is not None:
            tree.handle_endtag(end_tag.lower())
        elif tag is not None:
            tag = tag.lower()
            pairs = None
            if attrs:
                pairs = []
                for name, double, single, bare in _ATTRIBUTE.findall(attrs):
                    value = double or single or bare
                    pairs.append((name.lower(), unescape(value) if "&" in value else value))
            if tag in _OPAQUE or tag in _RAW_TEXT:
                if slash:
                    return False
                closing = html.find("</", at)
                if tag in _RAW_TEXT:
                    closed = re.compile(rf"</{tag}{_BLANK}*>", re.IGNORECASE).search(html, at)
                    closing = closed.start() if closed else -1
                inner = html[at:closing]
                if closing < 0 or "<!--" in inner or (tag in _OPAQUE and (
                    "<" in inner or ("&" in inner and tag != "title")
                    or not html.startswith(tag, closing + 2)
                )):
                    return False
                tree.start(tag, pairs, closed=False)
                if tag in _RAW_TEXT:
                    at = closing
            else:
                tree.start(tag, pairs, closed=bool(slash) or tag in _VOID)
        elif comment is not None:
            closing = html.find("-->", at)
            inner = html[at:closing]
            if closing < 0 or "--" in inner or inner.startswith((">", "->")) or inner.endswith("-"):
                return False
            tree.handle_comment(inner)
            at = closing + 3
        else:
            tree.handle_decl("")
    return True


def _read_page(out: _Columns, html: str, drop: frozenset[str]) -> str | None:
    """Append one page to the batch; a message if it cannot be read."""
    mark = out.mark()
    tree = _Tree(out, drop)
    if not _feed_plain(tree, html):
        out.cut(mark)
        tree = _Tree(out, drop)
        try:
            tree.feed(html)
            tree.close()
        except (AssertionError, ValueError, IndexError) as problem:
            out.cut(mark)
            return f"{type(problem).__name__}: {problem}"
    tree.finish()
    return None


def _parse_batch(pages: pa.Array, drop: frozenset[str]) -> pa.Array:
    out = _Columns()
    for html in pages.to_pylist():
        error = None if html is None else _read_page(out, html, drop)
        out.node_offsets.append(len(out.node_id))
        out.string_offsets.append(len(out.string_node))
        out.error.append(error)
        out.present.append(html is not None)
    return out.to_arrow()


def _parse_batches(batches: Iterator[pa.Array], drop: frozenset[str]) -> Iterator[pa.Array]:
    for pages in batches:
        for piece in pieces(pages):
            yield _parse_batch(piece, drop)


def parse_html(html: Column, drop_tags: list[str] | tuple[str, ...] = ()) -> Column:
    """Parsed page as a struct (see ``schemas.DOM``); null for a null page.

    A page the parser cannot read has no nodes and a message in ``error``. A task holds
    the trees of one piece of a batch at a time.
    """
    drop = frozenset(drop_tags)

    def parse(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return _parse_batches(batches, drop)

    return F.arrow_udf(parse, DOM)(html)
