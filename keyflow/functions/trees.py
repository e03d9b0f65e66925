"""State as a tree of maps, lists and values, and what sets and appends do to it.

A set gives the value at a path, whatever was there; an append adds to the list at a path, or makes one of the value alone
where there is no list. Both make maps of what stands above the path and is none. An empty or null path does nothing.

A patch says what changes do to a value that is not known yet: ``("set", value)``, ``("append", items)`` or
``("in", {name: patch})``. Any two that follow each other are one patch (``then``), so parts of a log can be folded apart
and put together in order, and only what still counts is kept.
"""

from __future__ import annotations

import json


def patch(kind: str, path: list[str], value) -> tuple:
    out = ("append", [value]) if kind == "append" else ("set", value)
    for name in reversed(path):
        out = ("in", {name: out})
    return out


def apply(value, change: tuple):
    """The value after a patch; maps and lists are changed where they are."""
    kind, what = change
    if kind == "set":
        return what
    if kind == "append":
        if not isinstance(value, list):
            return list(what)
        value.extend(what)
        return value
    out = value if isinstance(value, dict) else {}
    for name, inner in what.items():
        out[name] = apply(out.get(name), inner)
    return out


def then(a: tuple, b: tuple) -> tuple:
    """One patch for a and then b. a is used up."""
    if b[0] == "set":
        return b
    if a[0] == "set":
        return ("set", apply(a[1], b))
    if a[0] == "append" and b[0] == "append":
        a[1].extend(b[1])
        return a
    if a[0] != b[0]:  # a list that becomes a map, or a map that becomes a list
        return ("set", apply(None, b))
    for name, inner in b[1].items():
        a[1][name] = then(a[1][name], inner) if name in a[1] else inner
    return a


def text(tree) -> str:
    """JSON with sorted names."""
    return json.dumps(tree, sort_keys=True, ensure_ascii=False, separators=(",", ":"))


class Latest:
    """The log of one key cut down to what still counts: for each path its last set or its list, with its number.

    ``entries`` maps a path to (number, kind, value): kind "set" with a value, or "append" with a list that may go on one
    that a map above has. Applied in order of their numbers they give what the whole log gives. ``changed`` and ``gone``
    say which paths differ from those it was made of.
    """

    def __init__(self, entries: dict[tuple[str, ...], tuple[int, str, object]]):
        self.entries, self.changed, self.gone = dict(entries), set(), set()
        self.next = max((n for n, _, _ in entries.values()), default=-1) + 1
        self.tree: dict = {}
        for path, (_, kind, value) in sorted(entries.items(), key=lambda e: e[1][0]):
            self._apply(path, kind, value)

    def _apply(self, path: tuple[str, ...], kind: str, value) -> None:
        # the tree must not share lists with the entries, which are written on their own
        change = ("append", list(value)) if kind == "append" else ("set", json.loads(json.dumps(value)))
        for name in reversed(path):
            change = ("in", {name: change})
        self.tree = apply(self.tree, change)

    def _drop(self, path: tuple[str, ...]) -> None:
        del self.entries[path]
        self.changed.discard(path)
        self.gone.add(path)

    def add(self, kind: str, path: list[str] | None, value) -> None:
        if not path:
            return
        path = tuple(path)
        below = [p for p in self.entries if len(p) > len(path) and p[: len(path)] == path]
        for p in [path[:n] for n in range(1, len(path))]:
            if p in self.entries and not isinstance(self.entries[p][2], dict):
                self.entries[p] = (self.entries[p][0], "set", {})  # becomes a map, whatever a map above it may have there
                self.changed.add(p)
        if kind == "append":
            old = self.entries.get(path)
            if below or (old and not isinstance(old[2], list)):
                kind, value, grown = "set", [value], [value]  # there was a map or a value: a new list
            else:
                kind, value, grown = (old[1], [*old[2], value], [value]) if old else ("append", [value], [value])
                self._apply(path, "append", grown)
                grown = None
        else:
            grown = value
        for p in below:
            self._drop(p)
        if grown is not None or kind == "set" and value is None:
            self._apply(path, "set", value)
        self.entries[path] = (self.next, kind, value)
        self.next += 1
        self.gone.discard(path)
        self.changed.add(path)
