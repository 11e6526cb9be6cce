"""The element stage: HTML text -> array of element structs, one row per page.

This is the single Python step of the page operators.  It runs as one
``mapInArrow`` pass (Arrow batches in and out), so every page is tokenised once and all
downstream operators work on the ``elements`` array with JVM-side
higher-order functions (``filter``/``transform``/``exists``) -- no shuffle and
no second Python hop.

Tree rule (the one a permissive, non-correcting HTML tree builder applies):
a start tag opens an element unless it is void; an end tag closes the most
recently opened element of the same name together with everything opened after
it, and is ignored when no such element is open.  There is no implied closing,
so ``<p><p>`` nests.  ``script``/``style`` bodies are raw text.
"""

from __future__ import annotations

import json
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Elements that never hold children.
VOID_TAGS = frozenset((
    "area", "base", "basefont", "bgsound", "br", "col", "command", "embed",
    "frame", "hr", "image", "img", "input", "isindex", "keygen", "link",
    "menuitem", "meta", "nextid", "param", "source", "spacer", "track", "wbr",
))
RAW_TEXT_TAGS = frozenset(("script", "style"))
LD_JSON = "application/ld+json"
REJECTED = "markup could not be parsed"

DEFAULT_TAGS = ("title", "meta", "link", "h1", "h2", "img", "a", "script")
ATTRS = ("name", "content", "rel", "href", "alt", "type")

ELEMENT = T.StructType([
    T.StructField("pos", T.IntegerType()),
    T.StructField("tag", T.StringType()),
    *[T.StructField(a, T.StringType()) for a in ATTRS],
    # All descendant text (script/style bodies and comments excluded), or the
    # raw body for script/style elements.
    T.StructField("text", T.StringType()),
    # The text of the element's only child, down through only children; else null.
    T.StructField("string", T.StringType()),
    # Distinct names of the open elements around it (outermost first).
    T.StructField("ancestors", T.ArrayType(T.StringType())),
])
ELEMENTS = T.ArrayType(ELEMENT)
# The same type on the Arrow side of the stage.
ELEMENTS_ARROW = pa.list_(pa.struct(
    [("pos", pa.int32()), ("tag", pa.string())] + [(a, pa.string()) for a in ATTRS]
    + [("text", pa.string()), ("string", pa.string()), ("ancestors", pa.list_(pa.string()))]))


def last_keys(text):
    """JSON text in which no object repeats a key: the last value counts, as Python's parser has it.

    Text without repeated keys, and text that is no JSON, is returned as it is.
    Spark's JSON parsers take or refuse repeated keys by session settings, and
    some keep the first.
    """
    repeated = []

    def pairs(items):
        found = dict(items)
        if len(found) < len(items):
            repeated.append(True)
        return found

    try:
        value = json.loads(text, object_pairs_hook=pairs)
        return json.dumps(value, ensure_ascii=False, allow_nan=False) if repeated else text
    except (ValueError, RecursionError):
        return text


class _Tree(HTMLParser):
    """Builds the kept elements in one pass; O(1) work per parser event.

    Text outside script/style goes to one chunk list; an element remembers
    the chunk range it spans (start at open, end at close) and, at both ends,
    how many nodes had got a second child by then.  Such a node is always the
    innermost open one, so an equal count means that the element and all below
    it are a chain of only children.
    """

    def __init__(self, keep, ancestors_for, want_text):
        super().__init__(convert_charrefs=True)
        self.keep = keep
        self.ancestors_for = ancestors_for
        self.stack = []          # (tag, element index or -1)
        self.children = [0]      # child nodes of the page and of each open element
        self.in_text = False     # the last node is text that more data would extend
        self.elements = []
        self.spans = []          # per kept element: [chunk start, chunk end, splits at open, at close]
        self.raw = {}            # script/style element index -> raw body chunks
        self.chunks = []         # all text outside script/style and comments
        self.want_text = want_text
        self.splits = 0          # nodes that have got a second child
        self.pos = 0

    def handle_starttag(self, tag, attrs):
        self._start(tag, attrs, void=tag in VOID_TAGS)

    def handle_startendtag(self, tag, attrs):
        self._start(tag, attrs, void=False)
        self.handle_endtag(tag)

    def _child(self, is_text=False):
        self.in_text = is_text
        self.children[-1] += 1
        if self.children[-1] == 2:
            self.splits += 1

    def _start(self, tag, attrs, void):
        self.pos += 1
        self._child()
        idx = -1
        if tag in self.keep:
            values = {}
            for k, v in attrs:
                values[k] = "" if v is None else v   # last duplicate wins
            el = {"pos": self.pos, "tag": tag}
            for a in ATTRS:
                el[a] = values.get(a)
            # distinct ancestor tag names, innermost-last order of first
            # occurrence: membership is all callers need, and it bounds the
            # output of deeply nested pages
            el["ancestors"] = (list(dict.fromkeys(t for t, _ in self.stack))
                               if tag in self.ancestors_for else None)
            idx = len(self.elements)
            self.elements.append(el)
            n = len(self.chunks)
            self.spans.append([n, n, self.splits, self.splits])
        if not void:
            self.stack.append((tag, idx))
            self.children.append(0)
        # a void kept element is closed at once (its span stays empty)

    def handle_endtag(self, tag):
        self.in_text = False
        stack = self.stack
        for j in range(len(stack) - 1, -1, -1):
            if stack[j][0] == tag:
                n, splits = len(self.chunks), self.splits
                for _, i in stack[j:]:
                    if i >= 0:
                        self.spans[i][1] = n
                        self.spans[i][3] = splits
                del stack[j:], self.children[j + 1:]
                return

    def handle_data(self, data):
        if self.stack and self.stack[-1][0] in RAW_TEXT_TAGS:
            # raw body of script/style: belongs to that element only
            if self.stack[-1][1] >= 0:
                self.raw.setdefault(self.stack[-1][1], []).append(data)
            return
        if not self.in_text:
            self._child(is_text=True)
        self.chunks.append(data)

    def handle_comment(self, data):
        self._child()

    # declarations and processing instructions are child nodes too (no text)
    handle_decl = handle_pi = unknown_decl = handle_comment

    def result(self):
        n, splits = len(self.chunks), self.splits
        for tag, i in self.stack:              # still open at the end
            if i >= 0:
                self.spans[i][1] = n
                self.spans[i][3] = splits
        for i, el in enumerate(self.elements):
            start, end, at_open, at_close = self.spans[i]
            if i in self.raw or el["tag"] in RAW_TEXT_TAGS:
                text = "".join(self.raw.get(i, ()))
                mixed = False
            else:
                text = "".join(self.chunks[start:end])
                mixed = at_close > at_open
            if el["tag"] == "script" and el["type"] == LD_JSON:
                text = last_keys(text)
            el["text"] = text
            el["string"] = text if (text and not mixed) else None
        return self.elements, ("".join(self.chunks) if self.want_text else None)


def parse_html(html, keep=DEFAULT_TAGS, ancestors_for=("a",), want_text=False):
    """Parse one page; returns (elements, page_text).

    No HTML gives no elements; markup that the tokeniser rejects gives null,
    so that callers drop or report the page instead of judging half of it.
    """
    if html is None:
        return [], ""
    tree = _Tree(frozenset(keep), frozenset(ancestors_for), want_text)
    try:
        tree.feed(html)
        tree.close()
    except Exception:  # malformed markup
        return None, None
    return tree.result()


def with_elements(df: DataFrame, html_col: str = "html", keep=DEFAULT_TAGS,
                  ancestors_for=("a",), with_text: bool = False) -> DataFrame:
    """Replace ``html_col`` by ``elements`` (and optionally ``page_text``).

    ``elements`` is null where the markup could not be parsed, and empty where
    there is no HTML.
    Pages are parsed where they lie: as many tasks as ``df`` has partitions.
    """
    keep = tuple(keep)
    ancestors_for = tuple(ancestors_for)
    fields = [f for f in df.schema.fields if f.name != html_col]
    schema = T.StructType(fields + [T.StructField("elements", ELEMENTS)]
                          + ([T.StructField("page_text", T.StringType())] if with_text else []))

    def run(batches):
        # Arrow batches in and out: pass-through columns are never converted
        for batch in batches:
            names = batch.schema.names
            htmls = batch.column(names.index(html_col)).to_pylist()
            parsed = [parse_html(h, keep, ancestors_for, with_text) for h in htmls]
            cols = [batch.column(i) for i, n in enumerate(names) if n != html_col]
            out_names = [n for n in names if n != html_col] + ["elements"]
            cols.append(pa.array([p[0] for p in parsed], type=ELEMENTS_ARROW))
            if with_text:
                cols.append(pa.array([p[1] for p in parsed], type=pa.string()))
                out_names.append("page_text")
            yield pa.RecordBatch.from_arrays(cols, names=out_names)

    return df.mapInArrow(run, schema)


def page_error() -> Column:
    """``fetch_error``, or an error of its own for an answered page that could not be parsed."""
    rejected = F.col("elements").isNull() & F.col("status").eqNullSafe(200)
    return F.coalesce("fetch_error", F.when(rejected, F.lit(REJECTED))).alias("fetch_error")


def _ship_by_value() -> None:
    """Pickle this module's functions by value, so Python workers need no
    copy of the package on their path (only the standard library and pyarrow)."""
    import sys
    try:
        from pyspark import cloudpickle
        cloudpickle.register_pickle_by_value(sys.modules[__name__])
    except Exception:  # older cloudpickle: fall back to shipping by reference
        pass


_ship_by_value()
