"""HTML to typed columns: ``from_html`` turns a page into a struct of text arrays.

This is the only code that runs row by row in Python.  It finds tags, keeps the open-element
stack, and copies out the text or attributes a rule names, always in document order.  What the
values mean is decided later, by expressions on the struct.
"""

from __future__ import annotations

import gc
import re
import sys
from bisect import bisect_left, bisect_right
from functools import cached_property, lru_cache
from html import unescape
from operator import itemgetter
from typing import NamedTuple

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Executors get this module inside the task closure, so nothing has to be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Elements without content, elements with raw text.
VOID = {"area", "base", "br", "col", "embed", "frame", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = frozenset(["script", "style"])

# An open element (key) ends when one of the listed elements starts.
_CELL = ["td", "th", "tr", "tbody", "thead", "tfoot"]
ENDS_BEFORE = {
    "p": ["address", "blockquote", "body", "caption", "center", "dd", "dir", "div", "dl", "dt", "fieldset", "form", "h1", "h2", "h3", "h4", "h5", "h6", "hr",
          "li", "menu", "ol", "p", "pre", "table", "ul", *_CELL],
    "li": ["li"], "dt": ["dt", "dd"], "dd": ["dt", "dd"], "option": ["option", "optgroup"], "a": ["a"],
    "td": _CELL, "th": _CELL, "tr": ["tr", "tbody", "thead", "tfoot"],
    "tbody": ["tbody", "thead", "tfoot"], "thead": ["tbody", "tfoot"], "tfoot": ["tbody"],
    "b": ["center", "p", "td", "th"], "big": ["p"],
    **{h: ["fieldset", "form", "li", "p", "table"] for h in ("h1", "h2", "h3", "h4", "h5", "h6")},
}
ENDS_BEFORE = {k: frozenset(v) for k, v in ENDS_BEFORE.items()}

# An end tag does not reach past an open element of higher rank.
RANK = {"div": 150, "td": 160, "th": 160, "tr": 170, "thead": 180, "tbody": 180, "tfoot": 180, "table": 190,
        "head": 200, "body": 200, "html": 220}

_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_RAW_END = {t: re.compile(rf"</{t}\s*>", re.I) for t in RAW}
_NO_ATTRS: dict[str, str] = {}  # shared by all elements without attributes


class Page:
    """Elements and text chunks numbered in document order.

    ``index`` lists the elements of each key (kind, name) in ``wanted``, where kind is tag, attr, id or class.
    """

    def __init__(self, html: str, wanted: frozenset[tuple[str, str]] = frozenset()):
        self.html = html
        self.tag, self.parent, self.end, self.attrs, self.value = [], [], [], [], []
        self.start, self.stop = [], []
        self.texts: list[int] = []
        self.own: dict[int, list[int]] = {}
        self.index: dict[tuple[str, str], list[int]] = {}
        self.classes: dict[int, frozenset[str]] = {}
        self.found: dict[tuple[str, int], list[int]] = {}  # what a selector found below an element, for rules that share it
        self._read(html, wanted)

    def _add(self, tag, parent, attrs, value, start, stop):
        i = len(self.tag)
        self.tag.append(tag)
        self.parent.append(parent)
        self.end.append(i)
        self.attrs.append(attrs)
        self.value.append(value)
        self.start.append(start)
        self.stop.append(stop)
        if not tag:
            self.texts.append(i)
            if parent in self.own:
                self.own[parent].append(i)
            else:
                self.own[parent] = [i]
        return i

    def _note(self, key, i):
        if key in self.index:
            self.index[key].append(i)
        else:
            self.index[key] = [i]

    def _read(self, html, wanted):
        open_, pos, size, tag, search = [], 0, len(html), self.tag, _TOKEN.search

        def close(at):
            i = open_.pop()
            self.end[i], self.stop[i] = len(tag) - 1, at

        while pos < size:
            at = html.find("<", pos)  # every token starts with it
            m = search(html, at) if at >= 0 else None
            stop = m.start() if m else size
            if stop > pos:
                raw = html[pos:stop]
                self._add(None, open_[-1] if open_ else -1, _NO_ATTRS, unescape(raw) if "&" in raw else raw, pos, pos)
            if not m:
                break
            pos = m.end()
            ends, name, inner, ends_too, name_too, inner_too = m.groups()
            name = (name or name_too or "").lower()
            if not name:
                continue
            if ends or ends_too:
                rank = RANK.get(name, 100)
                for depth in range(len(open_) - 1, -1, -1):
                    other = tag[open_[depth]]
                    if other == name:
                        while len(open_) > depth + 1:
                            close(stop)
                        close(pos)
                        break
                    if RANK.get(other, 100) > rank:
                        break
                continue
            while open_ and name in ENDS_BEFORE.get(tag[open_[-1]], ()):
                close(stop)
            inner, attrs = inner or inner_too, _NO_ATTRS
            if inner:
                attrs = {}
                for key, a, b, c in _ATTR.findall(inner):
                    raw = a or b or c
                    attrs.setdefault(key.lower(), unescape(raw) if "&" in raw else raw)
            i = self._add(name, open_[-1] if open_ else -1, attrs, None, stop, pos)
            if ("tag", name) in wanted:
                self._note(("tag", name), i)
            for key in attrs:
                if ("attr", key) in wanted:
                    self._note(("attr", key), i)
                if key == "id" and ("id", attrs["id"]) in wanted:
                    self._note(("id", attrs["id"]), i)
                elif key == "class":
                    self.classes[i] = names = frozenset(attrs["class"].split())
                    for c in names:
                        if ("class", c) in wanted:
                            self._note(("class", c), i)
            if name in VOID:
                continue
            open_.append(i)
            if name in RAW:
                done = _RAW_END[name].search(html, pos)
                until = done.start() if done else size
                if until > pos:
                    self._add(None, i, _NO_ATTRS, html[pos:until], pos, pos)
                pos = done.end() if done else size
                close(pos)
        while open_:
            close(size)

    @cached_property
    def siblings(self):
        """Of each element the one before it, the one after it and its place among its parent's elements, and each parent's last; few pages ask."""
        prev, nth, after, last = [], [], {}, {}
        for i, tag in enumerate(self.tag):
            before = last.get(self.parent[i], -1) if tag else -1
            prev.append(before)
            nth.append(nth[before] + 1 if before >= 0 else 1)
            if tag:
                last[self.parent[i]] = i
                if before >= 0:
                    after[before] = i
        return Siblings(prev, after, nth, last)

    def ancestors(self, i, root=-1):
        i = self.parent[i]
        while i >= 0 and i >= root:
            yield i
            i = self.parent[i]

    def deep(self, i):
        lo, hi = bisect_left(self.texts, i), bisect_right(self.texts, self.end[i])
        return self.texts[lo:hi]


class Siblings(NamedTuple):
    prev: list[int]
    after: dict[int, int]
    nth: list[int]
    last: dict[int, int]


class Compound:
    """One simple selector, such as ``td.key:first-child`` or ``a[href*="x"]``."""

    _PART = re.compile(r"\.([\w-]+)|#([\w-]+)|\[([\w-]+)(?:(\*?=)\"([^\"]*)\")?\]|:([a-z-]+)(?:\(\"?([^)\"]*)\"?\))?|(\w+)")

    def __init__(self, text, before=None):
        self.tag, self.id, self.classes, self.tests, self.pseudo, self.before = None, None, [], [], [], before
        for cls, id_, attr, op, val, pseudo, arg, tag in self._PART.findall(text):
            if cls:
                self.classes.append(cls)
            elif id_:
                self.id = id_
            elif attr:
                self.tests.append((attr, op, val))
            elif pseudo:
                self.pseudo.append((pseudo, arg))
            else:
                self.tag = tag
        # The one thing asked for, when it is a tag or a class and nothing else.
        plain = not (self.id or self.tests or self.pseudo or self.before)
        self.only_tag = self.tag if plain and not self.classes else None
        self.only_class = self.classes[0] if plain and not self.tag and len(self.classes) == 1 else None

    def key(self):
        """Where the page's index lists the elements this can match; None when it could be any."""
        if self.id:
            return ("id", self.id)
        if self.classes:
            return ("class", self.classes[0])
        if self.tag:
            return ("tag", self.tag)
        return ("attr", self.tests[0][0]) if self.tests else None

    def needs(self):
        """Keys that a page with a match has in its index."""
        return [k for k in (self.key(),) if k] + (self.before.needs() if self.before else [])

    def matches(self, page, i):
        if self.only_tag:
            return page.tag[i] == self.only_tag
        if self.only_class:
            return self.only_class in page.classes.get(i, ())
        attrs = page.attrs[i]
        if self.tag and page.tag[i] != self.tag or self.id and attrs.get("id") != self.id:
            return False
        if self.classes and not page.classes.get(i, frozenset()).issuperset(self.classes):
            return False
        for name, op, val in self.tests:
            have = attrs.get(name)
            if have is None or op == "=" and have != val or op == "*=" and val not in have:
                return False
        if self.before:
            prev = page.siblings.prev[i]
            if prev < 0 or not self.before.matches(page, prev):
                return False
        return not self.pseudo or all(self._is(page, i, p, arg) for p, arg in self.pseudo)

    @staticmethod
    def _is(page, i, pseudo, arg):
        if pseudo == "first-child":
            return page.siblings.nth[i] == 1
        if pseudo == "last-child":
            return page.siblings.last.get(page.parent[i]) == i
        if pseudo == "nth-child":
            return page.siblings.nth[i] == int(arg)
        if pseudo == "contains":
            return arg in "".join(page.value[t] for t in page.deep(i))
        if pseudo == "heading":  # the first own text chunk mentions it
            own = page.own.get(i)
            return own is not None and arg in page.value[own[0]]
        if pseudo == "outside":
            return all(page.tag[a] != arg for a in page.ancestors(i))
        raise ValueError(pseudo)


class Path:
    """Descendant chain plus what to copy: ``::text``, ``::deep(skipped tags)``, ``::attr(x)``, ``::html``."""

    def __init__(self, text):
        text, _, take = text.strip().partition("::")
        self.take, _, self.arg = (take or "node").rstrip(")").partition("(")
        self.skip = frozenset(t.strip() for t in self.arg.split(",")) if self.arg else frozenset()
        self.selector, self.steps, before, adjacent = text, [], None, False
        for part in re.findall(r"(?:\[[^\]]*\]|\([^)]*\)|[^\s\[(])+", text):
            if part == "+":
                before, adjacent = self.steps.pop(), True
                continue
            self.steps.append(Compound(part, before if adjacent else None))
            adjacent = False
        self.needs = frozenset(k for s in self.steps for k in s.needs())
        self.last, self.outer, self.key = self.steps[-1], self.steps[:-1], self.steps[-1].key()
        last = self.last
        # What the index lists is a match as it is when the selector asks for nothing but the index's key.
        self.listed = self.key is not None and not (last.tests or last.pseudo or last.before) and bool(last.tag) + bool(last.id) + len(last.classes) == 1
        self.any = self.key is None and not (last.pseudo or last.before)
        self.kind = self.arg if self.take == "attr" else self.take == "html"  # hits of one kind at one place are the same

    def elements(self, page, root):
        """Matches below ``root``, itself included; the page's index has all that the path needs."""
        found = page.found.get((self.selector, root))
        if found is None:
            found = page.found[self.selector, root] = self._find(page, root)
        return found

    def _find(self, page, root):
        index, last, outer = page.index, self.last, self.outer
        low, high = (root, page.end[root]) if root >= 0 else (0, len(page.tag) - 1)
        if self.key:
            found = index[self.key]
        elif last.before and last.before.key():  # any element after a certain one
            firsts = [i for i in index[last.before.key()] if last.before.matches(page, i)]
            found = sorted(page.siblings.after[i] for i in firsts if i in page.siblings.after)
        else:  # any element: only those inside the step before, when that one is narrower
            inside = [(max(i + 1, low), min(page.end[i], high)) for i in index[outer[-1].key()]] if outer and outer[-1].key() else [(low, high)]
            found = [i for a, b in inside for i in range(a, b + 1) if page.tag[i]]
            if len(inside) > 1:
                found = sorted(set(found))
        if root >= 0:
            found = found[bisect_left(found, low):bisect_right(found, high)]
        if not (self.listed or self.any):
            found = [i for i in found if last.matches(page, i)]
        return [i for i in found if self._inside(page, i, outer, root)] if outer else found

    @staticmethod
    def _inside(page, i, outer, root):
        want, parent = len(outer) - 1, page.parent
        a = parent[i]
        while a >= 0 and a >= root:
            if outer[want].matches(page, a):
                if want == 0:
                    return True
                want -= 1
            a = parent[a]
        return False

    def hits(self, page, root):
        """(position, value) pairs; the position orders and identifies a value."""
        found = self.elements(page, root)
        if not found:
            return ()
        if self.take == "text":
            return [(t, page.value[t]) for i in found for t in page.own.get(i, ())]
        if self.take == "deep":
            out, read = [], -1
            for i in found:
                if i > read:  # else inside an element whose texts are read
                    read = page.end[i]
                    out += [(t, page.value[t]) for t in page.deep(i)
                            if not (self.skip and any(page.tag[a] in self.skip for a in page.ancestors(t)))]
            return out
        if self.take == "attr":
            return [(i, page.attrs[i][self.arg]) for i in found if self.arg in page.attrs[i]]
        if self.take == "html":
            return [(i, page.html[page.start[i]:page.stop[i]]) for i in found]
        return [(i, i) for i in found]


def split_union(text):
    return [p for p in re.split(r",(?![^(\[]*[)\]])", text) if p.strip()]


class Values:
    """A comma union of paths: every hit once, in document order."""

    def __init__(self, paths):
        self.paths = [Path(p) for p in split_union(paths)] if isinstance(paths, str) else paths

    @property
    def type(self):
        return T.ArrayType(T.StringType())

    def needs(self):
        return frozenset().union(*[p.needs for p in self.paths])

    def narrowed(self, have):
        """The same without paths that find nothing in a page whose index has these keys; None when none is left."""
        paths = [p for p in self.paths if p.needs <= have]
        return Values(paths) if paths else None

    def read(self, page, root=-1):
        if len(self.paths) == 1:
            return [v for _, v in sorted(self.paths[0].hits(page, root))]
        seen = {}
        for path in self.paths:
            for at, value in path.hits(page, root):
                seen.setdefault((at, path.kind), value)
        return [seen[k] for k in sorted(seen, key=itemgetter(0))] if len(seen) > 1 else list(seen.values())


class Groups:
    """One struct of fields per matched element, in document order."""

    def __init__(self, paths, fields):
        self.paths = [Path(p) for p in split_union(paths)] if isinstance(paths, str) else paths
        self.fields = {k: Values(v) if isinstance(v, str) else v for k, v in fields.items()}

    @property
    def type(self):
        return T.ArrayType(T.StructType([T.StructField(k, f.type) for k, f in self.fields.items()]))

    def needs(self):
        return frozenset().union(*[p.needs for p in self.paths], *[f.needs() for f in self.fields.values()])

    def narrowed(self, have):
        paths = [p for p in self.paths if p.needs <= have]
        return Groups(paths, {k: f.narrowed(have) for k, f in self.fields.items()}) if paths else None

    def read(self, page, root=-1):
        found = self.paths[0].elements(page, root) if len(self.paths) == 1 else sorted({i for p in self.paths for i in p.elements(page, root)})
        return [{k: f.read(page, i) if f else [] for k, f in self.fields.items()} for i in found]


class Reader:
    """Rules read from one page after the other.  Which of them can match depends on the keys that a page's index has, and is kept by those."""

    def __init__(self, fields):
        self.wanted = frozenset().union(*[f.needs() for f in fields.values()])
        self.nothing = {k: [] for k in fields}  # its lists are shared by all pages, and never written to
        self.narrowed = lru_cache(maxsize=4096)(lambda have: [(k, f) for k, f in ((k, f.narrowed(have)) for k, f in fields.items()) if f])

    def __call__(self, html: str) -> dict[str, list]:
        page = Page(html, self.wanted)
        return self.nothing | {k: f.read(page) for k, f in self.narrowed(frozenset(page.index))}


def from_html(html: Column, rules: dict[str, str | Groups]) -> Column:
    """Struct with one field per rule: ``ARRAY<STRING>`` for a selector, array of structs for ``Groups``."""
    fields = {k: Values(v) if isinstance(v, str) else v for k, v in rules.items()}
    schema = T.StructType([T.StructField(k, f.type) for k, f in fields.items()])

    def shred(pages: pa.Array) -> pa.Array:
        reader, collects = Reader(fields), gc.isenabled()
        gc.disable()  # pages and rows hold no cycles, and the collector would look through all of a batch again and again
        try:
            return pa.array([reader(html_text or "") for html_text in pages.to_pylist()], type=arrow_schema())
        finally:
            if collects:
                gc.enable()

    def arrow_schema():
        from pyspark.sql.pandas.types import to_arrow_type
        return to_arrow_type(schema)

    # Non-deterministic on paper only: keeps the optimizer from evaluating it twice for a pushed filter.
    return F.arrow_udf(shred, returnType=schema).asNondeterministic()(html)
