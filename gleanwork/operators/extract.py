"""Record extraction from HTML pages.

Only the `html` column crosses into Python: a vectorised UDF turns a batch of pages into arrays
of structs, and Spark explodes them. What to pull out is data (`RecordSpec`), so each page kind
is a spec and not a parser of its own.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Sequence
from dataclasses import dataclass, field
from html.parser import HTMLParser
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanwork.functions.text import decode_entities

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset(("script", "style", "template"))

#: Pages whose records are in Python at a time; a batch of Arrow holds many more.
_PAGES = 256
_TAGS = re.compile(r"(<[^<>]*>)")
# Tags that no parser reads in another way than they stand there: quoted attributes, one blank before each, no references.
_PLAIN_TAG = re.compile(r"""<(/?)([a-zA-Z][a-zA-Z0-9]*)((?:[ ][a-zA-Z][a-zA-Z0-9-]*=(?:"[^"<>]*"|'[^'<>]*'))*)>""")
_ATTRIBUTE = re.compile(r"""[ ]([a-zA-Z0-9-]+)=(?:"([^"]*)"|'([^']*)')""")
# Elements whose content a parser may read in another way.
_RAW = frozenset("script style textarea title iframe noembed noframes noscript xmp plaintext".split())


@dataclass(frozen=True)
class El:
    """Condition on one element. `inside` must match an ancestor, `under` the direct parent."""

    tag: str | None = None
    classes: tuple[str, ...] = ()
    equals: tuple[tuple[str, str], ...] = ()
    contains: tuple[tuple[str, str], ...] = ()
    starts: tuple[tuple[str, str], ...] = ()
    text: str | None = None
    single_text: bool = False
    inside: El | None = None
    under: El | None = None
    plain: bool = field(init=False)

    def __post_init__(self):
        """Plain: by tag and classes alone."""
        more = (self.equals, self.contains, self.starts, self.text, self.single_text, self.inside, self.under)
        object.__setattr__(self, "plain", not any(more))


@dataclass(frozen=True)
class Take:
    """One output field.

    at: cascade of elements (none: the container itself), the first one present is used (`rule="existing"`) or the first one
    whose value is not empty (`rule="non_empty"`) or holds a dot and a slash (`rule="url"`).
    then: descendant of that element (or the element itself) that carries the value.
    many: all matching descendants, joined with this separator.
    value: `text` (stripped), `pieces` (every text piece stripped), `words` (blanks collapsed)
    or the name of an attribute.
    filled: an empty value counts as missing.
    """

    name: str
    at: tuple[El, ...]
    value: str = "text"
    rule: str = "existing"
    default: str | None = None
    then: El | None = None
    many: str | None = None
    prefix: str = ""
    page_level: bool = False
    filled: bool = False


@dataclass(frozen=True)
class RecordSpec:
    """Container cascade (first kind present on the page wins; none: the page is one record)."""

    fields: tuple[Take, ...]
    containers: tuple[El, ...] = ()
    ddl: str = field(init=False)

    def __post_init__(self):
        ddl = ", ".join(f"{f.name}: STRING" for f in self.fields)
        object.__setattr__(self, "ddl", f"array<struct<{ddl}>>")


class _Node:
    __slots__ = ("tag", "attrs", "classes", "parent", "children", "at", "end")

    def __init__(self, tag, attrs, classes, parent, at):
        self.tag, self.attrs, self.classes, self.parent, self.children = tag, attrs, classes, parent, []
        self.at = self.end = at

    def pieces(self) -> list[str]:
        if len(self.children) == 1 and isinstance(self.children[0], str):
            return self.children
        out, stack = [], [self]
        while stack:
            node = stack.pop()
            if isinstance(node, str):
                out.append(node)
            elif node is self or node.tag not in UNSEEN:
                stack.extend(reversed(node.children))
        return out


def _named(tag: str, attrs) -> tuple[str, dict[str, str], tuple[str, ...], tuple[str, ...]]:
    """Tag, attributes (the last of a name counts), classes and distinct classes."""
    last = {k: v or "" for k, v in attrs}
    classes = tuple(last["class"].split()) if "class" in last else ()
    return tag, last, classes, tuple(dict.fromkeys(classes))


def _plain_tag(text: str):
    """As `_named`, without attributes for an end tag; None if the tag or its content is not plain."""
    found = _PLAIN_TAG.fullmatch(text)
    if found is None or found[2].lower() in _RAW or (found[1] and found[3]):
        return None
    tag = found[2].lower()
    return (tag, None, (), ()) if found[1] else _named(tag, [(k.lower(), a or b) for k, a, b in _ATTRIBUTE.findall(found[3])])


#: Tags read so far, and what stands around the values of others, as pages of one kind repeat them: not the long ones, and at most so many.
_KNOWN_TAGS: dict[str, tuple | None] = {}
_KNOWN_FRAMES: dict[str, tuple | None] = {}
_KNOWN_MOST, _KNOWN_CHARS = 4096, 200


def _remembered(known: dict[str, tuple | None], text: str, found: tuple | None) -> tuple | None:
    if len(text) < _KNOWN_CHARS:
        if len(known) >= _KNOWN_MOST:
            known.clear()
        known[text] = found
    return found


def _frame(frame: str) -> tuple | None:
    """Tag and attribute names of a tag whose values are left out, each between two quotes."""
    empty = _plain_tag(frame)
    return _remembered(_KNOWN_FRAMES, frame, empty and (empty[0], empty[1] and tuple(n.lower() for n, _, _ in _ATTRIBUTE.findall(frame))))


def _read_tag(text: str):
    """As `_plain_tag`: tags without values and class names are remembered whole, of others what stands around their values."""
    if '"' not in text or text.count('"') == 2 and ' class="' in text:
        return _remembered(_KNOWN_TAGS, text, _plain_tag(text))
    pieces = text.split('"')
    frame = '""'.join(pieces[::2])
    if len(pieces) % 2 == 0 or "'" in frame:
        return _plain_tag(text)
    found = _KNOWN_FRAMES.get(frame) or _frame(frame)
    if not found:
        return None
    attrs = dict(zip(found[1], pieces[1::2]))
    classes = tuple(attrs["class"].split()) if "class" in attrs else ()
    return found[0], attrs, classes, classes if len(classes) < 2 else tuple(dict.fromkeys(classes))


class _Page(HTMLParser):
    """Lenient tree: an end tag closes the nearest open element of that name, or nothing.

    Plain pages are cut at their tags, all others are read by the parser of the library.
    `nodes` is in document order; the descendants of a node are nodes[node.at + 1 : node.end].
    `by_tag` and `by_class` hold the places of the nodes of each element name and class, ascending.
    """

    def __init__(self, html: str):
        self.root = self.here = _Node("", {}, (), None, -1)
        self.nodes: list[_Node] = []
        self.by_tag: dict[str, list[int]] = {}
        self.by_class: dict[str, list[int]] = {}
        if not self._read_plain(html):
            super().__init__(convert_charrefs=True)
            self.feed(html)
            self.close()
        self._close_up_to(None)

    def _read_plain(self, html: str) -> bool:
        """Read a page of plain markup; of any other page nothing is read."""
        if "&" in html or "\0" in html:
            return False
        parts = _TAGS.split(html)  # text, tag, text, ...
        if html.count("<") != len(parts) // 2:
            return False
        tags = [_KNOWN_TAGS.get(t) or _read_tag(t) for t in parts[1::2]]
        if None in tags:
            return False
        for data, (tag, attrs, classes, distinct) in zip(parts[::2], tags):
            if data:
                self.handle_data(data)
            if attrs is not None:
                self._open(tag, attrs, classes, distinct)
            elif self.here.tag == tag:
                self.here.end = len(self.nodes)
                self.here = self.here.parent
            else:
                self.handle_endtag(tag)
        if parts[-1]:
            self.handle_data(parts[-1])
        return True

    def updatepos(self, i, j):
        return j  # line numbers are not needed

    def _close_up_to(self, node: _Node | None) -> None:
        while self.here is not node:
            self.here.end = len(self.nodes)
            self.here = self.here.parent

    def handle_starttag(self, tag, attrs):
        self._open(*_named(tag, attrs))

    def _open(self, tag, attrs, classes, distinct):
        at = len(self.nodes)
        node = _Node(tag, attrs, classes, self.here, at)
        self.here.children.append(node)
        self.by_tag.setdefault(tag, []).append(at)
        for c in distinct:
            self.by_class.setdefault(c, []).append(at)
        self.nodes.append(node)
        if tag in VOID:
            node.end = at + 1
        else:
            self.here = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        self.handle_endtag(tag)

    def handle_endtag(self, tag):
        node = self.here
        while node.parent is not None and node.tag != tag:
            node = node.parent
        if node.parent is not None:
            self._close_up_to(node.parent)

    def handle_data(self, data):
        beside = self.here.children
        if beside and isinstance(beside[-1], str):
            beside[-1] += data
        else:
            beside.append(data)

    def handle_comment(self, data):
        # Not an element, but it parts the text around it.
        self.here.children.append(_Node("", {}, (), self.here, -1))

    def _places(self, scope: _Node, el: El) -> Sequence[int]:
        """Where nodes of the element's class or name stand within the scope."""
        first, end = scope.at + 1, scope.end
        if el.classes:
            known = self.by_class.get(el.classes[0])
        elif el.tag:
            known = self.by_tag.get(el.tag)
        else:
            return range(first, end)
        if known is None or known[0] >= end or known[-1] < first:
            return ()
        return known[bisect_left(known, first):bisect_left(known, end)]

    def all_in(self, scope: _Node, el: El) -> list[_Node]:
        return [self.nodes[i] for i in self._places(scope, el) if _matches(self.nodes[i], el)]

    def first_in(self, scope: _Node, el: El) -> _Node | None:
        for i in self._places(scope, el):
            if _matches(self.nodes[i], el):
                return self.nodes[i]
        return None


def _only_text(node: _Node) -> bool:
    """One piece of text, possibly wrapped in single elements."""
    while not isinstance(node, str):
        if len(node.children) != 1:
            return False
        node = node.children[0]
    return True


def _matches(node: _Node, el: El) -> bool:
    if el.tag and node.tag != el.tag:
        return False
    for c in el.classes:
        if c not in node.classes:
            return False
    return el.plain or _matches_more(node, el)


def _matches_more(node: _Node, el: El) -> bool:
    a = node.attrs
    for k, v in el.equals:
        if a.get(k) != v:
            return False
    for k, v in el.contains:
        if v not in a.get(k, ""):
            return False
    for k, v in el.starts:
        if not a.get(k, "").startswith(v):
            return False
    if el.single_text and not _only_text(node):
        return False
    if el.text and el.text.lower() not in " ".join("".join(node.pieces()).split()).lower():
        return False
    if el.under and not (node.parent.tag and _matches(node.parent, el.under)):
        return False
    if el.inside:
        up = node.parent
        while up.tag and not _matches(up, el.inside):
            up = up.parent
        return bool(up.tag)
    return True


def _value(node: _Node, kind: str) -> str | None:
    if kind == "text":
        return "".join(node.pieces()).strip()
    if kind == "pieces":
        return "".join(p.strip() for p in node.pieces())
    if kind == "words":
        return " ".join("".join(node.pieces()).split())
    return node.attrs.get(kind)


def _take(page: _Page, scope: _Node, spec: Take) -> str | None:
    got = None
    for el in spec.at or (None,):
        node = scope if el is None else page.first_in(scope, el)
        if node is None:
            continue
        if spec.many is not None:
            found = [_value(n, spec.value) for n in page.all_in(node, spec.then)]
            return spec.many.join(found) or spec.default
        if spec.then is not None:
            node = page.first_in(node, spec.then) or (node if _matches(node, spec.then) else None)
        got = _value(node, spec.value) if node is not None else None
        if spec.filled and not got:
            got = None
        if spec.rule == "existing" or (spec.rule == "non_empty" and got):
            break
        if spec.rule == "url":
            if got and "." in got and "/" in got:
                break
            got = None
    return spec.default if got is None else spec.prefix + got


def _records(html: str | None, spec: RecordSpec) -> list[list[str | None]]:
    """The values of all records of one page, in the order of the fields."""
    if html is None:
        return []
    page = _Page(html)
    scopes = [page.root] if not spec.containers else []
    for el in spec.containers:
        scopes = page.all_in(page.root, el)
        if scopes:
            break
    shared = {f.name: _take(page, page.root, f) for f in spec.fields if f.page_level} if scopes else {}
    return [[shared[f.name] if f.page_level else _take(page, s, f) for f in spec.fields] for s in scopes]


def page_records(html: str | None, spec: RecordSpec) -> list[dict[str, str | None]]:
    """All records of one page."""
    names = [f.name for f in spec.fields]
    return [dict(zip(names, values)) for values in _records(html, spec)]


def _record_arrays(pages: pa.Array, spec: RecordSpec) -> pa.Array:
    """The records of pages as a list array of structs. A few pages are Python objects at a time."""
    counts: list[int] = []
    columns: list[list[pa.Array]] = [[pa.array([], pa.string())] for _ in spec.fields]
    for start in range(0, len(pages), _PAGES):
        found = [_records(h, spec) for h in pages.slice(start, _PAGES).to_pylist()]
        counts += map(len, found)
        rows = [values for records in found for values in records]
        for i, column in enumerate(columns):
            column.append(pa.array([values[i] for values in rows], pa.string()))
    whole = []
    while columns:
        whole.append(pa.concat_arrays(columns.pop(0)))
    offsets = pa.array(accumulate(counts, initial=0), pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(whole, [f.name for f in spec.fields]))


def records_column(html: Column, spec: RecordSpec) -> Column:
    """array<struct> of the records of each page. A few pages are Python objects at a time, however many a batch holds."""

    @F.arrow_udf(spec.ddl)
    def parse(batch: pa.Array) -> pa.Array:
        return _record_arrays(batch, spec)

    return parse(F.when(_may_hold(html, spec), html))


def _may_hold(html: Column, spec: RecordSpec) -> Column:
    """False only for pages that cannot have a container, so they never reach the tree.

    What a container's attributes must hold stands literally in its page, unless it is written
    with references to single characters; those that can stand for a letter, a digit, `_` or
    `-` are looked for. Element names alone are not tested.
    """
    if not spec.containers:
        return F.lit(True)
    possible = F.contains(html, F.lit("&")) & F.rlike(html, F.lit("&(#|fjlig|lowbar|UnderBar)"))
    for el in spec.containers:
        marks = [*el.classes, *(v for part in (el.equals, el.contains, el.starts) for _, v in part)]
        here = F.lit(True)
        for mark in marks:
            if re.fullmatch(r"[A-Za-z0-9_-]+", mark):
                here = here & F.contains(html, F.lit(mark))
        possible = possible | here
    return possible


def extract_records(pages: DataFrame, spec: RecordSpec, html: str = "html") -> DataFrame:
    """One row per record with the page's other columns and its position on the page."""
    keep = [c for c in pages.columns if c != html]
    found = pages.select(*keep, F.posexplode(records_column(F.col(html), spec)).alias("pos", "__r"))
    return found.select(*keep, "pos", "__r.*")


def flatten_success(fetches: DataFrame, status: str, records: str) -> DataFrame:
    """Drop failed fetches, then one row per record."""
    keep = [c for c in fetches.columns if c not in (status, records)]
    ok = fetches.filter(F.col(status) == "success")
    return ok.select(*keep, F.explode(records).alias("__r")).select(*keep, "__r.*")


def links_column(html: Column) -> Column:
    """href and raw inner HTML of every anchor, without leaving the JVM. Values may stand in double, single or no quotes; the basic
    references in them are decoded."""
    clean = F.regexp_replace(html, r"(?is)<(script|style)[^>]*>.*?</\1>|<!--.*?-->", "")
    pattern = r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))[^>]*>(.*?)</a>"""
    found = [F.regexp_extract_all(clean, F.lit(pattern), F.lit(i)) for i in (1, 2, 3, 4)]
    zipped = F.arrays_zip(*[f.alias(n) for f, n in zip(found, ("double", "single", "bare", "text"))])
    # Of the three ways one is not empty, if any.
    return F.transform(zipped, lambda x: F.struct(decode_entities(F.concat(x["double"], x["single"], x["bare"])).alias("href"), x["text"].alias("text")))
