"""Validation of XML against a schema, with the place of what is wrong.

A schema file is read once into plain tables: for each type its content (sequences and choices with how often a part may
stand), attributes, and for text the checks of its simple type. A document is then one pass of a parser that knows lines
and columns. The first violation of a document is its error, as ``[severity] line L, col C: text``; 2 is an error, 3 says
that the document is not XML.

Of XML Schema this reads global and local elements and types, references, sequences, choices, minOccurs and maxOccurs,
attributes with use and fixed, restrictions with facets, unions, lists, and extensions of simple content. What it does
not know (all, groups, substitution, wildcards, keys, imports) is refused when the schema is read, not passed over.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from datetime import date, datetime
from decimal import Decimal, InvalidOperation
from xml.etree import ElementTree
from xml.parsers import expat

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

XS = "{http://www.w3.org/2001/XMLSchema}"
_INSTANCE, _XML = "http://www.w3.org/2001/XMLSchema-instance", "http://www.w3.org/XML/1998/namespace"
ERROR, FATAL = 2, 3


class SchemaError(ValueError):
    """A schema that cannot be read."""


def _integer(low: int | None = None, high: int | None = None) -> Callable[[str], bool]:
    return lambda x: bool(re.fullmatch(r"[+-]?\d+", x)) and (low is None or int(x) >= low) and (high is None or int(x) <= high)


def _made(make: Callable[[str], object]) -> Callable[[str], bool]:
    def ok(x: str) -> bool:
        try:
            make(x)
        except (ValueError, InvalidOperation):
            return False
        return True

    return ok


def _moment(x: str) -> datetime:
    if not re.fullmatch(r"-?\d{4,}-\d\d-\d\dT\d\d:\d\d:\d\d(\.\d+)?(Z|[+-]\d\d:\d\d)?", x):
        raise ValueError(x)
    return datetime.fromisoformat(re.sub(r"(\.\d{6})\d+", r"\1", x))


def _day(x: str) -> date:
    return date.fromisoformat(re.sub(r"(Z|[+-]\d\d:\d\d)$", "", x))


#: Built-in types: what a text has to be.
BUILT_IN: dict[str, Callable[[str], bool]] = {
    "string": lambda x: True, "anyType": lambda x: True, "anySimpleType": lambda x: True, "normalizedString": lambda x: True, "token": lambda x: True, "anyURI": lambda x: True,
    "boolean": lambda x: x in ("true", "false", "0", "1"),
    "decimal": lambda x: bool(re.fullmatch(r"[+-]?(\d+(\.\d*)?|\.\d+)", x)),
    "double": lambda x: x in ("INF", "-INF", "NaN") or bool(re.fullmatch(r"[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?", x)),
    "integer": _integer(), "int": _integer(-(1 << 31), (1 << 31) - 1), "long": _integer(-(1 << 63), (1 << 63) - 1), "short": _integer(-(1 << 15), (1 << 15) - 1), "byte": _integer(-128, 127),
    "nonNegativeInteger": _integer(0), "positiveInteger": _integer(1), "unsignedInt": _integer(0, (1 << 32) - 1), "unsignedLong": _integer(0, (1 << 64) - 1),
    "dateTime": _made(_moment), "date": _made(_day), "time": lambda x: bool(re.fullmatch(r"([01]\d|2[0-3]):[0-5]\d:[0-5]\d(\.\d+)?(Z|[+-]\d\d:\d\d)?", x)),
    "NMTOKEN": lambda x: bool(re.fullmatch(r"[\w.:-]+", x)), "NCName": lambda x: bool(re.fullmatch(r"[^\W\d][\w.-]*", x)), "ID": lambda x: bool(re.fullmatch(r"[^\W\d][\w.-]*", x)),
}
BUILT_IN["float"] = BUILT_IN["double"]
KEEPS_SPACE = {"string", "normalizedString", "anyType", "anySimpleType"}


class Schema:
    """Tables of a schema file: elements and types by name, and what has to be checked of each."""

    def __init__(self, text: str):
        try:
            root = ElementTree.fromstring(text)
        except ElementTree.ParseError as e:
            raise SchemaError(f"the schema is no XML: {e}") from e
        if root.tag != f"{XS}schema":
            raise SchemaError("the file is no schema")
        self.target = root.get("targetNamespace", "")
        self.qualified = root.get("elementFormDefault") == "qualified"
        self.simple: dict[str, dict] = {}
        self.complex: dict[str, dict] = {}
        self.elements: dict[str, dict] = {}
        self._made, self._contents, self._matched = 0, {}, {}
        for part in root:
            name = part.get("name")
            if part.tag == f"{XS}element":
                self.elements[name] = self._element(part, True)
            elif part.tag == f"{XS}complexType":
                self.complex[name] = self._complex(part)
            elif part.tag == f"{XS}simpleType":
                self.simple[name] = self._simple(part)
            elif part.tag != f"{XS}annotation":
                raise SchemaError(f"{_local(part.tag)} is not supported")
        for kind in [x["type"] for x in [*self.elements.values(), *(e for c in self.complex.values() for e in _elements(c["content"]))] if "ref" not in x]:
            self._known(kind)
        for s in self.simple.values():
            for kind in [s["base"], *s["union"], *([s["list"]] if s["list"] else [])]:
                self._known(kind)
        for kind in self.complex:
            self.content(kind)

    def content(self, kind: str) -> dict | None:
        """Elements that may stand in a type by (namespace, name), each with a character of its own, and a pattern of these; None: text only."""
        if kind not in self.complex or self.complex[kind]["text"]:
            return None
        if kind not in self._contents:
            found: dict[tuple[str, str], dict] = {}
            self._contents[kind] = {"pattern": self._sequence(self.complex[kind]["content"], found), "elements": found}
        return self._contents[kind]

    def _sequence(self, part: dict | None, found: dict) -> str:
        if part is None:
            return ""
        if "parts" in part:
            inner = [self._sequence(p, found) for p in part["parts"]]
            one = "|".join(inner) if part["kind"] == "choice" else "".join(inner)
        else:
            e = self.elements.get(part["ref"]) if "ref" in part else part
            if e is None:
                raise SchemaError(f"unknown element {part['ref']}")
            at = (e["space"], e["name"])
            one = found.setdefault(at, {"type": e["type"], "nil": e["nil"], "char": chr(0xE000 + len(found))})["char"]
        return f"(?:{one}){{{part['min']},{'' if part['max'] is None else part['max']}}}"

    def goes_on(self, kind: str, children: str) -> bool:
        """Whether children can be the first ones of a valid element."""
        return self._matches(kind, children, True)

    def is_whole(self, kind: str, children: str) -> bool:
        return self._matches(kind, children, False)

    def _matches(self, kind: str, children: str, partial: bool) -> bool:
        at = (kind, children, partial)
        if at not in self._matched:
            if len(self._matched) > 50_000:
                self._matched.clear()  # documents of one form have few different answers
            self._matched[at] = regex.fullmatch(self.content(kind)["pattern"], children, partial=partial) is not None
        return self._matched[at]

    def has_text(self, kind: str) -> bool:
        return self.text_type(kind) is not None or self.complex[kind]["mixed"]

    def text_type(self, kind: str) -> str | None:
        return self.complex[kind]["text"] if kind in self.complex else kind

    def _known(self, kind: str) -> None:
        if kind not in self.simple and kind not in self.complex and kind not in BUILT_IN:
            raise SchemaError(f"unknown type {kind}")

    def _own(self, kind: str, table: dict, value: dict) -> str:
        """A name for a type that has none."""
        self._made += 1
        name = f"{kind}#{self._made}"
        table[name] = value
        return name

    def _element(self, node, top: bool = False) -> dict:
        often = {"min": int(node.get("minOccurs", 1)), "max": None if node.get("maxOccurs") == "unbounded" else int(node.get("maxOccurs", 1))}
        if node.get("ref"):
            return {"ref": _local_name(node.get("ref"))} | often
        kind, inner = node.get("type"), [x for x in node if x.tag != f"{XS}annotation"]
        if kind is not None:
            kind = _local_name(kind)
        elif inner and inner[0].tag == f"{XS}complexType":
            kind = self._own(node.get("name"), self.complex, self._complex(inner[0]))
        elif inner and inner[0].tag == f"{XS}simpleType":
            kind = self._own(node.get("name"), self.simple, self._simple(inner[0]))
        elif inner:
            raise SchemaError(f"{_local(inner[0].tag)} in an element is not supported")
        else:
            kind = "anyType"
        spaced = top or node.get("form", "qualified" if self.qualified else "unqualified") == "qualified"
        return {"name": node.get("name"), "space": self.target if spaced else "", "type": kind, "nil": node.get("nillable") == "true"} | often

    def _complex(self, node) -> dict:
        out = {"content": None, "attributes": {}, "text": None, "mixed": node.get("mixed") == "true"}
        for x in node:
            if x.tag in (f"{XS}sequence", f"{XS}choice"):
                out["content"] = self._group(x)
            elif x.tag == f"{XS}attribute":
                out["attributes"] |= self._attribute(x)
            elif x.tag == f"{XS}simpleContent":
                inner = next((y for y in x if y.tag in (f"{XS}extension", f"{XS}restriction")), None)
                if inner is None:
                    raise SchemaError("simple content without a base")
                out["text"] = _local_name(inner.get("base"))
                for y in inner:
                    if y.tag == f"{XS}attribute":
                        out["attributes"] |= self._attribute(y)
            elif x.tag != f"{XS}annotation":
                raise SchemaError(f"{_local(x.tag)} in a complex type is not supported")
        return out

    def _attribute(self, node) -> dict:
        kind = _local_name(node.get("type", "string"))
        inner = node.find(f"{XS}simpleType")
        if inner is not None:
            kind = self._own(node.get("name"), self.simple, self._simple(inner))
        return {node.get("name"): {"type": kind, "needed": node.get("use") == "required", "barred": node.get("use") == "prohibited", "fixed": node.get("fixed")}}

    def _group(self, node) -> dict:
        often = {"min": int(node.get("minOccurs", 1)), "max": None if node.get("maxOccurs") == "unbounded" else int(node.get("maxOccurs", 1))}
        parts = []
        for x in node:
            if x.tag == f"{XS}element":
                parts.append(self._element(x))
            elif x.tag in (f"{XS}sequence", f"{XS}choice"):
                parts.append(self._group(x))
            elif x.tag != f"{XS}annotation":
                raise SchemaError(f"{_local(x.tag)} in a group is not supported")
        return {"kind": _local(node.tag), "parts": parts} | often

    def _simple(self, node) -> dict:
        out = {"base": "string", "union": [], "list": None, "facets": []}
        for x in node:
            if x.tag == f"{XS}restriction":
                inner = x.find(f"{XS}simpleType")
                out["base"] = self._own("base", self.simple, self._simple(inner)) if inner is not None else _local_name(x.get("base"))
                for f in x:
                    if f.tag not in (f"{XS}simpleType", f"{XS}annotation"):
                        out["facets"].append((_local(f.tag), _pattern(f.get("value")) if f.tag == f"{XS}pattern" else f.get("value")))
            elif x.tag == f"{XS}union":
                out["union"] = [_local_name(m) for m in x.get("memberTypes", "").split()] + [self._own("member", self.simple, self._simple(m)) for m in x if m.tag == f"{XS}simpleType"]
            elif x.tag == f"{XS}list":
                inner = x.find(f"{XS}simpleType")
                out["list"] = self._own("item", self.simple, self._simple(inner)) if inner is not None else _local_name(x.get("itemType"))
            elif x.tag != f"{XS}annotation":
                raise SchemaError(f"{_local(x.tag)} in a simple type is not supported")
        return out

    def wrong_text(self, kind: str, text: str) -> str | None:
        """What is wrong with a text of a simple type; None: nothing."""
        if kind in BUILT_IN and kind not in self.simple:
            x = text if kind in KEEPS_SPACE else text.strip()
            return None if BUILT_IN[kind](x) else f"'{x}' is no {kind}"
        s = self.simple[kind]
        if s["union"]:
            if all(self.wrong_text(m, text) for m in s["union"]):
                return f"'{text.strip()}' is of none of the types {', '.join(m.split('#')[0] for m in s['union'])}"
        elif s["list"]:
            found = next((w for x in text.split() if (w := self.wrong_text(s["list"], x))), None)
            if found:
                return found
        else:
            found = self.wrong_text(s["base"], text)
            if found:
                return found
        x = text if self._spaced(kind) else text.strip()
        allowed = [v for f, v in s["facets"] if f == "enumeration"]
        if allowed and x not in allowed:
            return f"'{x}' is not one of {', '.join(allowed)}"
        patterns = [v for f, v in s["facets"] if f == "pattern"]
        if patterns and not any(re.fullmatch(p, x) for p in patterns):
            return f"'{x}' does not match the pattern"
        size = len(x.split()) if s["list"] else len(x)
        for facet, value in s["facets"]:
            if not _FACETS.get(facet, lambda *_: True)(x, size, value):
                return f"'{x}' does not fit {facet} {value}"
        return None

    def _spaced(self, kind: str) -> bool:
        while kind in self.simple:
            if self.simple[kind]["union"] or self.simple[kind]["list"]:
                return False
            kind = self.simple[kind]["base"]
        return kind in KEEPS_SPACE


def _number(x: str) -> Decimal:
    return Decimal({"INF": "Infinity", "-INF": "-Infinity"}.get(x, x))


def _compared(test: Callable) -> Callable[[str, int, str], bool]:
    """Numbers by size; moments and days, which are written largest part first, by their text."""
    def ok(x: str, _: int, value: str) -> bool:
        try:
            return test(_number(x), _number(value))
        except InvalidOperation:
            return test(x, value)

    return ok


_FACETS: dict[str, Callable[[str, int, str], bool]] = {
    "length": lambda x, n, v: n == int(v),
    "minLength": lambda x, n, v: n >= int(v),
    "maxLength": lambda x, n, v: n <= int(v),
    "minInclusive": _compared(lambda x, v: x >= v),
    "maxInclusive": _compared(lambda x, v: x <= v),
    "minExclusive": _compared(lambda x, v: x > v),
    "maxExclusive": _compared(lambda x, v: x < v),
    "totalDigits": lambda x, n, v: len(re.sub(r"[^\d]", "", x).lstrip("0")) <= int(v),
    "fractionDigits": lambda x, n, v: len(x.partition(".")[2].rstrip("0")) <= int(v),
}


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def _local_name(name: str) -> str:
    return name.rpartition(":")[2]


def _pattern(text: str) -> str:
    """A schema's pattern as one of Python's: name characters are classes of their own, ^ and $ are plain characters."""
    text = re.sub(r"\\i", r"[A-Za-z_:]", re.sub(r"\\c", r"[\\w.:-]", text))
    return re.sub(r"(?<![\[\\])([\^$])", r"\\\1", text)


def _elements(group: dict | None) -> list[dict]:
    return [] if group is None else [e for p in group["parts"] for e in (_elements(p) if "parts" in p else [p])]


class _Found(Exception):  # noqa: N818  ends the parse of a document at its first violation
    pass


def violation(schema: Schema, text: str | None) -> str | None:
    """The first violation of a document as ``[severity] line L, col C: text``; None where it is valid, or null."""
    if text is None:
        return None
    parser = expat.ParserCreate("utf-8", "}")
    stack: list[dict] = []

    def found(what: str, severity: int = ERROR, at: tuple[int, int] | None = None) -> None:
        line, column = at or (parser.CurrentLineNumber, parser.CurrentColumnNumber + 1)
        raise _Found(f"[{severity}] line {line}, col {column}: {what}")

    def attributes_of(kind: str | None, name: str, given: dict) -> None:
        known = schema.complex[kind]["attributes"] if kind in schema.complex else {}
        for full, value in given.items():
            space, _, local = full.rpartition("}")
            if space in (_INSTANCE, _XML):
                continue
            if local not in known or known[local]["barred"] or space not in ("", schema.target):
                found(f"attribute {local} is not allowed in element {name}")
            if known[local]["fixed"] not in (None, value):
                found(f"attribute {local} has to be '{known[local]['fixed']}'")
            if wrong := schema.wrong_text(known[local]["type"], value):
                found(f"attribute {local}: {wrong}")
        for local, a in known.items():
            if a["needed"] and not any(_local(full) == local for full in given):
                found(f"attribute {local} is missing in element {name}")

    def start(full: str, given: dict) -> None:
        space, _, name = full.rpartition("}")
        if stack and stack[-1]["any"]:
            stack.append({"any": True})
            return
        if not stack:
            e = schema.elements.get(name)
            if e is None or space != schema.target:
                found(f"element {name} is not declared")
        else:
            above = stack[-1]
            content = schema.content(above["type"])
            if above["nil"] or content is None:
                found(f"element {name} is not allowed in element {above['name']}, which has no elements")
            e = content["elements"].get((space, name))
            if e is None or not schema.goes_on(above["type"], above["children"] + e["char"]):
                found(f"element {name} is not expected here in element {above['name']}")
            above["children"] += e["char"]
        kind = e["type"]
        if kind == "anyType":
            stack.append({"any": True})
            return
        attributes_of(kind, name, given)
        nil = given.get(f"{_INSTANCE}}}nil") in ("true", "1")
        if nil and not e["nil"]:
            found(f"element {name} must not be nil")
        stack.append({"any": False, "name": name, "type": kind, "children": "", "text": [], "nil": nil})

    def chars(data: str) -> None:
        top = stack[-1]
        if not top["any"]:
            top["text"].append(data)
            if data.strip() and (top["nil"] or not schema.has_text(top["type"])):
                found(f"text is not allowed in element {top['name']}")

    def end(_: str) -> None:
        top = stack.pop()
        if top["any"] or top["nil"]:
            return
        if schema.content(top["type"]) is not None and not schema.is_whole(top["type"], top["children"]):
            found(f"element {top['name']} is not complete")
        kind = schema.text_type(top["type"])
        if kind and (wrong := schema.wrong_text(kind, "".join(top["text"]))):
            found(f"element {top['name']}: {wrong}")

    def doctype(*_) -> None:
        found("document type", FATAL)

    parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler, parser.StartDoctypeDeclHandler = start, end, chars, doctype
    parser.buffer_text = True
    try:
        parser.Parse(text.encode(), True)
    except _Found as e:
        return str(e)
    except expat.ExpatError as e:
        return f"[{FATAL}] line {e.lineno}, col {e.offset + 1}: {expat.ErrorString(e.code)}"
    return None


def validate_xml(df: DataFrame, xsd: str, raw: str = "raw_value", errors: str = "errors") -> DataFrame:
    """df with its errors and, behind them, the first violation of each document of column raw; null texts have none.

    xsd is the text of the schema; one that cannot be read is a SchemaError here, before any row is.
    """
    schema = Schema(xsd)

    @F.arrow_udf(T.StringType())
    def first(texts: pa.Array) -> pa.Array:
        return pa.array([violation(schema, x) for x in texts.to_pylist()], pa.string())

    none = F.expr("cast(array() as array<string>)")
    before = F.coalesce(F.col(errors), none) if errors in df.columns else none
    rows = df.withColumn("__violation", first(F.col(raw)))
    return rows.withColumn(errors, F.concat(before, F.when(F.col("__violation").isNotNull(), F.array("__violation")).otherwise(none))).drop("__violation")


def read_schema(spark, path: str) -> str:
    """The text of a schema file on any file system that Spark reads."""
    rows = spark.read.text(path, wholetext=True).take(1)
    if not rows:
        raise SchemaError(f"{path} is empty or not there")
    return rows[0][0]
