"""Fields out of stored HTML pages by a declared rule set.

Spark splits the pages over tasks; the Python below only walks one page at a time and hands
raw strings back through Arrow. All choices on those strings are made with Spark functions.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql import types as T

# The parser travels inside the task, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Elements without an end tag, and elements whose text is not page text.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
NOT_TEXT = frozenset(("script", "style", "template"))


@dataclass(frozen=True)
class Step:
    """One descent: an element by tag, id, exact class tokens, or a part of a class token."""

    tag: str | None = None
    classes: tuple[str, ...] = ()
    class_part: str | None = None
    id: str | None = None


@dataclass(frozen=True)
class Take:
    """What to read at the end of a path of steps.

    kind: text (joined runs, trimmed), tight (each run trimmed), lines (trimmed runs, one per
    line), raw, attribute, count, or all (the `tight`/`text` of every match, as a list).
    With `any_branch` a path may pass through any match of each step, as CSS selectors do;
    otherwise it follows the first match only.
    """

    path: tuple[Step, ...]
    kind: str = "text"
    attribute: str = ""
    any_branch: bool = False

    @property
    def type(self) -> T.DataType:
        if self.kind == "count":
            return T.IntegerType()
        return T.ArrayType(T.StringType()) if self.kind.startswith("all") else T.StringType()


@dataclass(frozen=True)
class PageRules:
    """The rows of a page (the page itself when `rows` is empty) and the fields of each row."""

    fields: dict[str, Take] = field(default_factory=dict)
    rows: tuple[Step, ...] = ()

    @property
    def type(self) -> T.ArrayType:
        return T.ArrayType(T.StructType([T.StructField(n, t.type) for n, t in self.fields.items()]))


# Tags and comments in the common forms; a page with any other form is read by the standard parser.
_VALUE = r"""(?:"[^"<>]*"|'[^'<>]*'|[-\w.]+)"""
_ATTRIBUTES = rf"((?:\s+[a-zA-Z][-\w:.]*={_VALUE})*)"
_TAG = re.compile(rf"<(?:([a-zA-Z][a-zA-Z0-9]*){_ATTRIBUTES}\s*(/?)>|/([a-zA-Z][a-zA-Z0-9]*)\s*>|!--[^<>-]*(?:-[^<>-]+)*-->)", re.ASCII)
_ATTRIBUTE = re.compile(rf"([-\w:.]+)=({_VALUE})", re.ASCII)
_MOST_TAGS = 50_000
# Rows kept as Python objects; pages can have many.
_MOST_ROWS = 5_000
# What a tag of a common form does; any other form is left to the standard parser.
_START, _EMPTY, _END, _BREAK, _OTHER = range(5)


class _Tag:
    """A tag as its text says it, with what it adds to each state that it was met in."""

    __slots__ = ("kind", "name", "source", "rows", "fields")

    def __init__(self, kind: int, name: str = "", source: str | tuple = ""):
        self.kind, self.name, self.source = kind, name, source
        self.rows: dict[int, tuple[tuple[int, int], ...]] = {}
        self.fields: dict[int, tuple[tuple[int, int], ...]] = {}


def _read_tag(text: str) -> _Tag:
    """The tag between < and >."""
    found = _TAG.fullmatch(f"<{text}>")
    if found is None:
        return _Tag(_OTHER)
    name, source, closed, ended = found.groups()
    if ended:
        return _Tag(_END, ended.lower())
    if not name:
        return _Tag(_BREAK)
    tag = name.lower()
    if tag in HTMLParser.CDATA_CONTENT_ELEMENTS or (closed and source and found[0][-3] not in "\"' \t\n\r\f\v"):
        return _Tag(_OTHER)
    return _Tag(_EMPTY if closed else _START, tag, source)


def _attributes(source: str | tuple) -> dict[str, str]:
    """Attributes by name, out of a tag's text or of the standard parser's pairs."""
    if isinstance(source, tuple):
        return {k: v or "" for k, v in source}
    return {k.lower(): unescape(v[1:-1] if v[0] in "\"'" else v) for k, v in _ATTRIBUTE.findall(source)}


def _fits(step: Step, tag: str, attrs: dict[str, str]) -> bool:
    if (step.tag is not None and step.tag != tag) or (step.id is not None and step.id != attrs.get("id")):
        return False
    classes = frozenset(attrs.get("class", "").split())
    if step.class_part is not None and not any(step.class_part in c for c in classes):
        return False
    return classes.issuperset(step.classes)


class _Automaton:
    """Paths as one automaton over the stack of open elements.

    The state of an element is the set of (path, steps done) that it and the elements around it
    have reached. What a tag adds to a state is worked out once per state and text of the tag (and
    kept with the tag), so a tag costs one look-up however many fields there are.
    """

    def __init__(self, paths: Sequence[Sequence[Step]]):
        self.paths = paths
        self.states: list[frozenset[tuple[int, int]]] = []
        self.numbers: dict[frozenset[tuple[int, int]], int] = {}
        self.start = self._number(frozenset((p, 0) for p in range(len(paths))))
        self.after: dict[tuple, int] = {}

    def _number(self, state: frozenset[tuple[int, int]]) -> int:
        if state not in self.numbers:
            self.numbers[state] = len(self.states)
            self.states.append(state)
        return self.numbers[state]

    def reached(self, state: int, tag: _Tag) -> tuple[tuple[int, int], ...]:
        """(path, steps done) that a tag adds to the state around it."""
        attrs = _attributes(tag.source)
        return tuple((p, done + 1) for p, done in sorted(self.states[state]) if _fits(self.paths[p][done], tag.name, attrs))

    def joined(self, state: int, added: Sequence[tuple[int, int]]) -> int:
        """The state inside an element that adds to the state around it."""
        key = (state, *added)
        found = self.after.get(key)
        if found is None:
            open_ended = [(p, done) for p, done in added if done < len(self.paths[p])]
            found = self.after[key] = self._number(self.states[state].union(open_ended)) if open_ended else state
        return found


class _Stretch:
    """The nodes of the page inside one element."""

    __slots__ = ("start", "end")

    def __init__(self, start: int):
        self.start = self.end = start


class _Row:
    """What is found for the fields of one row."""

    __slots__ = ("found", "passed")

    def __init__(self, fields: int):
        self.found: list[list] = [[] for _ in range(fields)]
        self.passed: set[tuple[int, int]] = set()


class _Compiled:
    """A rule set's automata; one per rule set in a worker, with the tags of its pages."""

    _known: dict[PageRules, _Compiled] = {}

    def __init__(self, rules: PageRules):
        self.takes = list(rules.fields.values())
        self.row_steps = len(rules.rows)
        self.rows = _Automaton([rules.rows] if rules.rows else [])
        self.fields = _Automaton([t.path for t in self.takes])
        self.last = [len(t.path) for t in self.takes]
        self.tags: dict[str | tuple, _Tag] = {}

    def tag(self, text: str) -> _Tag:
        """The tag between < and >, read once."""
        found = self.tags.get(text)
        return found if found is not None else self._keep(text, _read_tag(text))

    def started(self, name: str, source: str | tuple) -> _Tag:
        """The start tag that the standard parser met."""
        found = self.tags.get((name, source))
        return found if found is not None else self._keep((name, source), _Tag(_START, name, source))

    def _keep(self, key: str | tuple, tag: _Tag) -> _Tag:
        if len(self.tags) >= _MOST_TAGS:
            self.tags.clear()
        self.tags[key] = tag
        return tag

    @classmethod
    def of(cls, rules: PageRules) -> _Compiled:
        key = (tuple(rules.fields.items()), rules.rows)
        if key not in cls._known:
            cls._known[key] = cls(rules)
        return cls._known[key]


class _Walk:
    """One pass over a page: every tag moves the automata, and rows collect what their fields need.

    An open element is (tag, state of the row path, (row, field state) of each open row, stretches
    that end with it). An end tag closes up to its nearest open element, if there is one. Text is
    kept while a row is open.
    """

    def __init__(self, compiled: _Compiled):
        self.compiled = compiled
        self.nodes: list[str | _Stretch | None] = []
        self.rows: list[_Row] = []
        rows = () if compiled.row_steps else ((self._row(), compiled.fields.start),)
        self.open: list[tuple] = [("", compiled.rows.start, rows, ())]

    def _row(self) -> _Row:
        self.rows.append(_Row(len(self.compiled.takes)))
        return self.rows[-1]

    def start(self, tag: _Tag) -> None:
        compiled, nodes, name = self.compiled, self.nodes, tag.name
        _, row_state, rows, _ = self.open[-1]
        ends: Sequence[_Stretch] = ()
        if rows:
            if nodes and nodes[-1].__class__ is str:
                nodes.append(None)
            if name in NOT_TEXT:
                ends = [_Stretch(len(nodes) + 1)]
                nodes.append(ends[0])
            moved, known = None, tag.fields
            for k, (row, state) in enumerate(rows):
                added = known.get(state)
                if added is None:
                    added = known[state] = compiled.fields.reached(state, tag)
                if added:
                    after, stretch = self._take(row, state, added, tag.source)
                    if stretch is not None:
                        ends = (*ends, stretch)
                    if after != state:
                        moved = moved or list(rows)
                        moved[k] = (row, after)
            if moved:
                rows = tuple(moved)
        if compiled.row_steps:
            added = tag.rows.get(row_state)
            if added is None:
                added = tag.rows[row_state] = compiled.rows.reached(row_state, tag)
            if added:
                row_state = compiled.rows.joined(row_state, added)
                if added[-1][1] == compiled.row_steps:
                    rows = (*rows, (self._row(), compiled.fields.start))
        if name not in VOID:
            self.open.append((name, row_state, rows, ends))

    def _take(self, row: _Row, state: int, added: Sequence[tuple[int, int]], source: str | tuple) -> tuple[int, _Stretch | None]:
        """Note what a tag is to a row; the state inside it, and the stretch to close with it."""
        takes, last = self.compiled.takes, self.compiled.last
        kept, stretch = [], None
        for p, done in added:
            take, found = takes[p], row.found[p]
            if done < last[p]:
                # only the first match of a step leads on, unless any branch may
                if take.any_branch or (p, done) not in row.passed:
                    row.passed.add((p, done))
                    kept.append((p, done))
            elif take.kind == "count":
                found.append(None)
            elif take.kind.startswith("all") or not found:
                if take.kind == "attribute":
                    found.append(_attributes(source).get(take.attribute))
                    continue
                stretch = stretch or _Stretch(len(self.nodes))
                found.append(stretch)
        return (self.compiled.fields.joined(state, kept) if kept else state), stretch

    def end(self, tag: str) -> None:
        stack = self.open
        if stack[-1][0] == tag and len(stack) > 1:
            for stretch in stack.pop()[3]:
                stretch.end = len(self.nodes)
        else:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == tag:
                    self.close_from(depth)
                    break
        nodes = self.nodes
        if nodes and nodes[-1].__class__ is str:
            nodes.append(None)

    def close_from(self, depth: int) -> None:
        for element in self.open[depth:]:
            for stretch in element[3]:
                stretch.end = len(self.nodes)
        del self.open[depth:]

    def text(self, data: str) -> None:
        if self.open[-1][2]:
            nodes = self.nodes
            if nodes and nodes[-1].__class__ is str:
                nodes[-1] += data
            else:
                nodes.append(data)

    def break_run(self) -> None:
        """What follows is a text run of its own."""
        if self.nodes and isinstance(self.nodes[-1], str):
            self.nodes.append(None)

    def _runs(self, inside: _Stretch) -> Iterator[str]:
        """Text runs of a stretch, without scripts, styles and templates in it."""
        i = inside.start
        while i < inside.end:
            node = self.nodes[i]
            i += 1
            if isinstance(node, str):
                yield node
            elif node is not None:
                i = max(i, node.end)

    def _string(self, inside: _Stretch, kind: str) -> str:
        if kind == "raw":
            return "".join(self._runs(inside))
        if kind == "text":
            return "".join(self._runs(inside)).strip()
        tight = [run for run in (r.strip() for r in self._runs(inside)) if run]
        return ("\n" if kind == "lines" else "").join(tight)

    def value(self, found: list, kind: str) -> str | int | list[str] | None:
        if kind == "count":
            return len(found)
        if kind.startswith("all"):
            return [self._string(e, kind.removeprefix("all ")) for e in found]
        if not found or kind == "attribute":
            return found[0] if found else None
        return self._string(found[0], kind)


class _Standard(HTMLParser):
    """Any page at all, handed to a walk piece by piece."""

    def __init__(self, walk: _Walk):
        super().__init__(convert_charrefs=True)
        self.walk = walk

    def updatepos(self, i, j):  # line numbers are not needed
        return j

    def parse_starttag(self, i):
        found = _TAG.match(self.rawdata, i)
        tag = found[1].lower() if found and found[1] and not found[3] else ""
        if not tag or tag in self.CDATA_CONTENT_ELEMENTS:
            return super().parse_starttag(i)
        self.lasttag = tag
        self.walk.start(self.walk.compiled.started(tag, found[2]))
        return found.end()

    def handle_starttag(self, tag, attrs):
        self.walk.start(self.walk.compiled.started(tag, tuple(attrs)))

    def handle_endtag(self, tag):
        self.walk.end(tag)

    def handle_data(self, data):
        self.walk.text(data)

    def _break(self, _=None):
        self.walk.break_run()

    handle_comment = handle_decl = handle_pi = _break

    def unknown_decl(self, data):
        self._break()
        if data.upper().startswith("CDATA["):
            self.walk.text(data[len("CDATA[") :])
            self._break()


def _walk_plain(html: str, walk: _Walk) -> bool:
    """Walk a page made of common forms only; False, at some place, for any other page.

    No common tag has a < or > inside, so a page is cut at these."""
    known, read = walk.compiled.tags, walk.compiled.tag
    start, close, stack, nodes = walk.start, walk.end, walk.open, walk.nodes
    pieces = html.split("<")
    if pieces[0]:
        walk.text(unescape(pieces[0]))
    for k in range(1, len(pieces)):
        text, closing, data = pieces[k].partition(">")
        if not closing:
            return False
        tag = known.get(text) or read(text)
        kind = tag.kind
        if kind == _START:
            _, row_state, rows, _ = stack[-1]
            if tag.rows.get(row_state) == () and (not rows or (len(rows) == 1 and tag.fields.get(rows[0][1]) == ())) and tag.name not in NOT_TEXT:
                # the tag is nothing to the rows, nor to the fields of the one open row
                if rows and nodes and nodes[-1].__class__ is str:
                    nodes.append(None)
                if tag.name not in VOID:
                    stack.append((tag.name, row_state, rows, ()))
            else:
                start(tag)
        elif kind == _END:
            top = stack[-1]
            if top[0] == tag.name and len(stack) > 1:
                stack.pop()
                for stretch in top[3]:
                    stretch.end = len(nodes)
                if nodes and nodes[-1].__class__ is str:
                    nodes.append(None)
            else:
                close(tag.name)
        elif kind == _EMPTY:
            start(tag)
            close(tag.name)
        elif kind == _BREAK:
            walk.break_run()
        else:
            return False
        if data and stack[-1][2]:
            if "&" in data:
                data = unescape(data)
            if nodes and nodes[-1].__class__ is str:
                nodes[-1] += data
            else:
                nodes.append(data)
    return True


def read_page(html: str | None, rules: PageRules) -> list[dict]:
    """The rows of one page."""
    compiled = _Compiled.of(rules)
    walk = _Walk(compiled)
    if not _walk_plain(html or "", walk):
        walk = _Walk(compiled)
        parser = _Standard(walk)
        parser.feed(html or "")
        parser.close()
    walk.close_from(0)
    kinds = [t.kind for t in compiled.takes]
    return [{n: walk.value(f, k) for n, f, k in zip(rules.fields, row.found, kinds)} for row in walk.rows]


def page_rows(html: Column, rules: PageRules) -> Column:
    """array<struct<...>>: one struct per row of the page, in page order."""
    arrow_type = to_arrow_type(rules.type)

    def parse(pages: pa.Array) -> pa.Array:
        done, found, rows = [], [], 0
        for page in pages:
            found.append(read_page(page.as_py(), rules))
            rows += len(found[-1])
            if rows >= _MOST_ROWS:
                done.append(pa.array(found, type=arrow_type))
                found, rows = [], 0
        return pa.concat_arrays([*done, pa.array(found, type=arrow_type)])

    # Called non-deterministic so that no filter on its result is pushed below it, which
    # would parse every page twice.
    return F.arrow_udf(parse, rules.type).asNondeterministic()(html)
