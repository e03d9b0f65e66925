"""Walking and changing trees: XML and JSON parsing, path access, codecs."""

from __future__ import annotations

from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MALFORMED = "malformed or invalid XML"


def parse_xml(df: DataFrame, schema: str, raw: str = "raw_value", xsd: str | None = None) -> DataFrame:
    """df with message (struct) and errors. Prefixes are dropped, text is trimmed; bad documents get an error and a null message.

    With ``xsd`` documents that the schema file rejects are bad too.
    """
    options = {"ignoreNamespace": "true", "attributePrefix": "attr_", "valueTag": "text", "columnNameOfCorruptRecord": "__bad", "mode": "PERMISSIVE"}
    if xsd:
        options["rowValidationXSDPath"] = xsd
    parsed = df.withColumn("__m", F.from_xml(raw, f"{schema}, __bad string", options))
    bad = F.col("__m.__bad").isNotNull() | F.col("__m").isNull() | F.lower(raw).rlike("<!(doctype|entity)")
    return parsed.select("*", F.when(~bad, F.col("__m").dropFields("__bad")).alias("message"), F.when(bad, F.array(F.lit(MALFORMED))).otherwise(F.expr("cast(array() as array<string>)")).alias("errors")).drop("__m")


def _first(text: str, path: list[str]) -> tuple[str | None, str | None]:
    """(text, error) of the first element below each other as in path, with others between, in one parse of a whole document."""
    parser, open_, inside, found = expat.ParserCreate("utf-8"), [], 0, None

    def refused(*_):
        raise ValueError("document type")

    def start(name: str, _: dict) -> None:
        nonlocal inside, found
        open_.append(name.rpartition(":")[2])
        if inside:
            inside += 1
        elif found is None and open_[-1] == path[-1]:
            above = iter(open_)
            if all(p in above for p in path):
                inside, found = 1, []

    def end(_: str) -> None:
        nonlocal inside
        open_.pop()
        inside -= inside > 0

    def chars(data: str) -> None:
        if inside:
            found.append(data)

    parser.StartDoctypeDeclHandler = refused
    if path:
        parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = start, end, chars
    try:
        parser.Parse(text.encode(), True)
    except (expat.ExpatError, ValueError):
        return None, "no path" if not path else MALFORMED
    if not path:
        return None, "no path"
    value = "".join(found or ()).strip(" ")
    return (value, None) if value else (None, "not found" if found is None else "empty")


def extract_id(raw: str, path: list[str]) -> Column:
    """Struct (id, error): trimmed text of the first match of an element path in XML text, elements between allowed.

    Names are compared without prefixes. Each text is parsed once, to its end, so what is not one whole document without a
    document type has an error of its own.
    """

    @F.arrow_udf(T.StructType().add("id", "string").add("error", "string"))
    def found(texts: pa.Array) -> pa.Array:
        rows = [_first(x, path) if x is not None and x.strip(" ") else (None, "no xml") for x in texts.to_pylist()]
        return pa.StructArray.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in (0, 1)], ["id", "error"])

    return found(F.col(raw))


def at_path(value: Column, path: list[str]) -> Column:
    """The VARIANT at a path of names, whatever characters they have; null where it ends early."""
    for name in path:
        quote = "'" if "'" not in name else '"'
        if quote in name:  # no literal can name it: look it up in a map
            value = F.try_element_at(F.try_variant_get(value, "$", "map<string, variant>"), F.lit(name))
        else:
            value = F.try_variant_get(value, f"$[{quote}{name}{quote}]", "variant")
    return value


def path_get(value: str, path: list[str]) -> Column:
    """Value at a path of a variant column as text; null where it ends early."""
    return F.try_variant_get(at_path(F.col(value), path), "$", "string")


def path_get_string(value: str, path: list[str]) -> Column:
    """As path_get, but null where the value is not a string."""
    at = at_path(F.col(value), path)
    return F.when(F.schema_of_variant(at) == "STRING", at.cast("string"))


def encode_lines(items: str) -> Column:
    return F.array_join(items, "\n")


def decode_lines(text: str) -> Column:
    """Lines of a text; a line end at its end makes no further one, an empty text none."""
    body = F.regexp_replace(F.regexp_replace(F.col(text), "\r\n", "\n"), "\n$", "")
    return F.when(F.coalesce(F.col(text), F.lit("")) == "", F.expr("cast(array() as array<string>)")).otherwise(F.split(body, "\n"))


def decode_tagged(raw: str, schemas: dict[str, str]) -> tuple[dict[str, Column], Column]:
    """Columns by tag and an error column for JSON of the form {"type": tag, "payload": {...}}."""
    tag = F.get_json_object(raw, "$.type")
    found = {t: F.when(tag == t, F.from_json(F.get_json_object(raw, "$.payload"), s)).alias(t) for t, s in schemas.items()}
    error = F.when(tag.isNull(), F.lit("no type")).when(~tag.isin(list(schemas)), F.concat(F.lit("unknown type "), tag))
    return found, error


EVENT_LOG = "type string, path array<string>, value string"


def encode_log(type_: Column, path: Column, value: Column) -> Column:
    return F.to_json(F.struct(type_.alias("type"), path.alias("path"), value.alias("value")))


def decode_log(raw: str) -> Column:
    return F.from_json(F.col(raw), EVENT_LOG)


def explode_out(df: DataFrame, out: str = "out") -> DataFrame:
    """One row for each record of a rule's result, with its place."""
    return df.select("*", F.posexplode(out).alias("out_at", "record")).drop(out)


def with_parameters(df: DataFrame, defaults: dict[str, Column], per_event: dict[str, dict[str, Column]] | None = None, event: str = "event_type") -> DataFrame:
    """df with parameters (array), param_key (joined by ':') and param_errors: by event's own column, else the default's."""
    values = []
    for name, default in defaults.items():
        value = default
        for e, own in (per_event or {}).items():
            if name in own:
                value = F.when(F.col(event) == e, own[name]).otherwise(value)
        values.append(value.cast("string"))
    errors = F.filter(F.array(*[F.when(v.isNull(), F.lit(f"no value for {n}")) for n, v in zip(defaults, values, strict=True)]), lambda x: x.isNotNull())
    return df.withColumns({"parameters": F.array(*values), "param_errors": errors}).withColumn("param_key", F.when(F.size("param_errors") == 0, F.array_join("parameters", ":")))


def _within(value: Column, path: list[str], change) -> Column:
    """A struct column with the field at a path replaced, or taken out where change gives None."""
    name, rest = path[0], path[1:]
    new = _within(value.getField(name), rest, change) if rest else change(value.getField(name))
    return value.dropFields(name) if new is None else value.withField(name, new)


def normalize_repeating(df: DataFrame, path: list[str], column: str = "message") -> DataFrame:
    """df in whose field at a path a value that is no list is a list of one, in place.

    A field that stands once in a document is a value in the tree and a list if repeated. The last part of the path is a
    name in a VARIANT, those before it are fields of structs down to that variant, whose other names stay as they are. A
    variant that is no object, as an empty element gives, becomes null; one without the name, or with null, stays.
    """

    def listed(v: Column) -> Column:
        inner = at_path(v, path[-1:])
        names = F.try_variant_get(v, "$", "map<string, variant>")
        single = inner.isNotNull() & ~F.is_variant_null(inner) & ~F.schema_of_variant(inner).startswith("ARRAY")
        made = F.to_variant_object(F.transform_values(names, lambda k, x: F.when(k == path[-1], F.to_variant_object(F.array(x))).otherwise(x)))
        return F.when(F.schema_of_variant(v).startswith("OBJECT"), F.when(single, made).otherwise(v))

    return df.withColumn(column, _within(F.col(column), path[:-1], listed))


def unwrap_pair(df: DataFrame, value: str = "message") -> DataFrame:
    """df of variants {"test": {"input": ..., "output": ...}} with message (the input), expected (list of outputs) and errors.

    An output that is no list becomes a list of one. A missing part is an error; the message is null then.
    """
    given = F.try_variant_get(value, "$.test.input", "variant")
    wanted = F.try_variant_get(value, "$.test.output", "variant")
    expected = F.when(F.schema_of_variant(wanted).startswith("ARRAY"), F.try_variant_get(wanted, "$", "array<variant>")).when(wanted.isNotNull(), F.array(wanted))
    errors = F.filter(F.array(F.when(given.isNull(), F.lit("no test.input")), F.when(wanted.isNull(), F.lit("no test.output"))), lambda x: x.isNotNull())
    return df.withColumns({"expected": expected, "errors": errors, value: F.when(given.isNotNull() & wanted.isNotNull(), given)})


def after_parse(df: DataFrame, hooks: list) -> DataFrame:
    """df after each hook, a function from DataFrame to DataFrame, in order; rows and their errors are the hook's to keep."""
    for hook in hooks:
        df = df.transform(hook)
    return df
