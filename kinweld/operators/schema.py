"""Rules given as a JSON Schema, compiled to column expressions.

``check_schema`` refuses schemas that are wrong or use what can't be checked;
``errors`` turns one into an expression over a row that lists all it breaks.
Values are judged as the JSON that the row would be written as: a null member
is null, every member of a struct is there, a map has the keys that it has.
As in that standard, a keyword binds only values of its own type, and
``format`` binds none.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from typing import Any

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: An error: the way to the value (numbers of items, names of members), the
#: names that the schema itself has on that way, and what is wrong.
ERROR = "struct<path:array<struct<at:bigint,name:string>>,rule:string,message:string>"
TYPES = ("string", "number", "integer", "boolean", "array", "object", "null")
#: Keywords that bind nothing.
NOTES = ("$schema", "$id", "$comment", "$defs", "title", "description", "default", "examples", "deprecated", "readOnly", "writeOnly", "format")


class SchemaError(ValueError):
    """A schema that is wrong, or that can't be checked on columns."""


def _number(v: Any) -> bool:
    return isinstance(v, (int, float)) and not isinstance(v, bool)


def _size(v: Any) -> bool:
    return _number(v) and v >= 0 and v == int(v)


def _names(v: Any) -> bool:
    return isinstance(v, list) and all(isinstance(x, str) for x in v) and len(set(v)) == len(v)


def _pattern(v: Any) -> bool:
    try:
        return isinstance(v, str) and bool(re.compile(v))
    except re.error:
        return False


def _scalar(v: Any) -> bool:
    return v is None or isinstance(v, (str, bool)) or _number(v)


def _types(v: Any) -> bool:
    return v in TYPES if isinstance(v, str) else _names(v) and bool(v) and set(v) <= set(TYPES)


VALUES: dict[str, Callable[[Any], bool]] = {
    "type": _types,
    "enum": lambda v: isinstance(v, list) and all(map(_scalar, v)),
    "const": _scalar,
    "pattern": _pattern,
    "required": _names,
    "uniqueItems": lambda v: isinstance(v, bool),
    "$ref": lambda v: isinstance(v, str) and v.startswith("#"),
    **dict.fromkeys(("minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum"), _number),
    **dict.fromkeys(("minLength", "maxLength", "minItems", "maxItems", "minProperties", "maxProperties"), _size),
}
#: Keywords that hold a schema, a list of schemas, or schemas by name.
ONE, MANY, NAMED = ("items", "additionalProperties", "not"), ("anyOf", "allOf", "oneOf"), ("properties", "$defs")


def resolve(root: dict, ref: str) -> Any:
    """What a reference within the schema points to."""
    at: Any = root
    for part in filter(None, ref[1:].split("/")):
        key = part.replace("~1", "/").replace("~0", "~")
        try:
            at = at[int(key)] if isinstance(at, list) else at[key]
        except (KeyError, IndexError, ValueError, TypeError):
            raise SchemaError(f"schema: nothing at {ref}") from None
    return at


def _faults(schema: Any, path: str) -> Iterator[str]:
    if isinstance(schema, bool):
        return
    if not isinstance(schema, dict):
        yield f"{path or '#'}: must be an object or a boolean"
        return
    for key, value in schema.items():
        here = f"{path}/{key}"
        if key in ONE:
            yield from _faults(value, here)
        elif key in MANY:
            if not isinstance(value, list) or not value:
                yield f"{here}: must be a list of schemas"
                continue
            for k, one in enumerate(value):
                yield from _faults(one, f"{here}/{k}")
        elif key in NAMED:
            if not isinstance(value, dict):
                yield f"{here}: must be schemas by name"
                continue
            for name, one in value.items():
                yield from _faults(one, f"{here}/{name}")
        elif key in VALUES:
            if not VALUES[key](value):
                yield f"{here}: wrong value {json.dumps(value)}"
        elif key not in NOTES:
            yield f"{here}: is not supported"


def _loops(root: dict, schema: Any, seen: tuple[int, ...]) -> None:
    """Raise for references that lead back without going into a value."""
    if not isinstance(schema, dict):
        return
    if id(schema) in seen:
        raise SchemaError("schema: references run in a circle")
    seen = (*seen, id(schema))
    if "$ref" in schema:
        _loops(root, resolve(root, schema["$ref"]), seen)
    for key in MANY:
        for one in schema.get(key, ()):
            _loops(root, one, seen)
    _loops(root, schema.get("not"), seen)


def _parts(schema: Any) -> Iterator[dict]:
    if isinstance(schema, dict):
        yield schema
        for key, value in schema.items():
            if key in ONE:
                yield from _parts(value)
            elif key in MANY:
                for one in value:
                    yield from _parts(one)
            elif key in NAMED:
                for one in value.values():
                    yield from _parts(one)


def check_schema(schema: Any) -> None:
    """Raise if a schema is wrong; the message has all faults."""
    if found := list(_faults(schema, "")):
        raise SchemaError("schema: " + "; ".join(found))
    for part in _parts(schema):
        _loops(schema, part, ())


def load_schema(spark: SparkSession, path: str) -> dict:
    """The schema in a file of any file system that Spark reads, checked."""
    text = spark.read.text(path, wholetext=True).first()
    try:
        schema = json.loads(text["value"] if text else "")
    except json.JSONDecodeError as wrong:
        raise SchemaError(f"schema: {path} is not JSON: {wrong}") from None
    check_schema(schema)
    if not isinstance(schema, dict):
        raise SchemaError("schema: must be an object")
    return schema


def java_pattern(pattern: str) -> str:
    """A pattern whose ``$`` is the end of the text, not also before a line end."""
    return re.sub(r"(\\.)|(\[\^?\]?(?:\\.|[^\]\\])*\])|\$", lambda m: m[0] if m[1] or m[2] else r"\z", pattern, flags=re.DOTALL)


def _json_type(kind: T.DataType) -> str:
    if isinstance(kind, (T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BinaryType)):
        return "string"
    if isinstance(kind, T.BooleanType):
        return "boolean"
    if isinstance(kind, T.IntegralType):
        return "integer"
    if isinstance(kind, T.NumericType):
        return "number"
    if isinstance(kind, T.ArrayType):
        return "array"
    if isinstance(kind, (T.StructType, T.MapType)):
        return "object"
    if isinstance(kind, T.NullType):
        return "null"
    raise SchemaError(f"schema: can't judge values of type {kind.simpleString()}")


def _comparable(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _comparable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_comparable(f.dataType) for f in kind)
    return not isinstance(kind, (T.MapType, T.VariantType))


class Compiler:
    """Errors of values under the schemas within ``root``. If ``partial``,
    members that a struct type doesn't have aren't missed."""

    def __init__(self, root: dict, partial: bool = False) -> None:
        self.root, self.partial = root, partial

    def errors(self, schema: Any, value: Column, kind: T.DataType, path: Column, rule: str) -> list[Column]:
        """Arrays of ERROR; all of them together are the errors of a value."""
        if schema is True or isinstance(schema, dict) and not set(schema) - set(NOTES):
            return []
        if schema is False:
            return [self.one(F.lit(True), path, rule, "is not allowed")]
        if isinstance(kind, T.VariantType):
            raise SchemaError(f"schema: can't judge variants, at {rule}")
        out = [self.one(b, path, rule, m) for b, m in self.own(schema, value, kind)]
        if "$ref" in schema:
            out += self.errors(resolve(self.root, schema["$ref"]), value, kind, path, rule)
        for one in schema.get("allOf", ()):
            out += self.errors(one, value, kind, path, rule)
        if "anyOf" in schema:
            out += self.any_of(schema["anyOf"], value, kind, path, rule)
        if "oneOf" in schema:
            fit = sum((self.fits(s, value, kind, path, rule).cast("int") for s in schema["oneOf"]), F.lit(0))
            out.append(self.one(fit != 1, path, rule, "must fit exactly one of the alternatives"))
        if "not" in schema:
            out.append(self.one(self.fits(schema["not"], value, kind, path, rule), path, rule, "fits what it must not"))
        return out + [F.when(value.isNotNull(), e).otherwise(none()) for e in self.inner(schema, value, kind, path, rule)]

    def fits(self, schema: Any, value: Column, kind: T.DataType, path: Column, rule: str) -> Column:
        return F.size(joined(self.errors(schema, value, kind, path, rule))) == 0

    def any_of(self, schemas: list, value: Column, kind: T.DataType, path: Column, rule: str) -> list[Column]:
        rest = [s for s in schemas if s != {"type": "null"}]
        if len(rest) == 1 and len(schemas) > 1:  # a value or null: say what is wrong with the value
            return [F.when(value.isNotNull(), e).otherwise(none()) for e in self.errors(rest[0], value, kind, path, rule)]
        fit = F.lit(False)
        for s in schemas:
            fit |= self.fits(s, value, kind, path, rule)
        return [self.one(~fit, path, rule, "must fit one of the alternatives")]

    def one(self, broken: Column, path: Column, rule: str, message: str) -> Column:
        found = F.array(F.struct(path.alias("path"), F.lit(rule).alias("rule"), F.lit(message).alias("message")))
        return F.when(F.coalesce(broken, F.lit(False)), found).otherwise(none())

    def own(self, schema: dict, value: Column, kind: T.DataType) -> Iterator[tuple[Column, str]]:
        """(broken, message) of the keywords that bind the value itself."""
        own = _json_type(kind)
        if "type" in schema:
            allowed = [schema["type"]] if isinstance(schema["type"], str) else schema["type"]
            wrong = F.lit(own not in allowed and not (own == "integer" and "number" in allowed))
            if own == "number" and "integer" in allowed and "number" not in allowed:
                wrong = value != F.floor(value)
            yield F.when(value.isNull(), F.lit("null" not in allowed)).otherwise(wrong), "must be " + " or ".join(allowed)
        for key in ("enum", "const"):
            if key in schema:
                listed = schema[key] if key == "enum" else [schema[key]]
                alike = {"string": lambda v: isinstance(v, str), "boolean": lambda v: isinstance(v, bool), "integer": _number, "number": _number}.get(own, lambda v: False)
                same = F.lit(False)
                for v in filter(alike, listed):
                    same |= value == F.lit(v)
                yield F.when(value.isNull(), F.lit(None not in listed)).otherwise(~same), "must be one of " + json.dumps(listed, ensure_ascii=False)
        if own in ("integer", "number"):
            bounds = (("minimum", lambda a, b: a < b, "at least"), ("maximum", lambda a, b: a > b, "at most"), ("exclusiveMinimum", lambda a, b: a <= b, "more than"), ("exclusiveMaximum", lambda a, b: a >= b, "less than"))
            for key, off, words in bounds:
                if key in schema:
                    yield off(value, F.lit(schema[key])), f"must be {words} {schema[key]}"
        if own == "string" and "pattern" in schema:
            yield ~value.cast("string").rlike(java_pattern(schema["pattern"])), f"must match {schema['pattern']}"
        sizes = {"string": ("Length", lambda: F.char_length(value.cast("string"))), "array": ("Items", lambda: F.size(value)), "object": ("Properties", lambda: F.size(F.map_keys(value)) if isinstance(kind, T.MapType) else F.lit(len(kind.fields)))}
        if own in sizes:
            suffix, size = sizes[own]
            if f"min{suffix}" in schema:
                yield value.isNotNull() & (size() < schema[f"min{suffix}"]), f"must have at least {schema[f'min{suffix}']}"
            if f"max{suffix}" in schema:
                yield value.isNotNull() & (size() > schema[f"max{suffix}"]), f"must have at most {schema[f'max{suffix}']}"
        if own == "array" and schema.get("uniqueItems"):
            if not _comparable(kind.elementType):
                raise SchemaError("schema: uniqueItems of values that can't be compared")
            yield F.size(F.array_distinct(value)) < F.size(value), "must not repeat values"

    def inner(self, schema: dict, value: Column, kind: T.DataType, path: Column, rule: str) -> Iterator[Column]:
        """Errors inside a list or object that isn't null."""
        if isinstance(kind, T.ArrayType) and "items" in schema:
            item = lambda x, k: joined(self.errors(schema["items"], x, kind.elementType, step(path, at=k), rule))
            yield F.flatten(F.transform(value, item))
        elif isinstance(kind, T.StructType):
            yield from self.members(schema, {f.name: (value[f.name], f.dataType) for f in kind}, path, rule)
        elif isinstance(kind, T.MapType):
            named, more = schema.get("properties", {}), schema.get("additionalProperties", True)
            for name in schema.get("required", ()):
                yield self.one(~F.map_contains_key(value, name), path, rule, f"must have {name}")
            for name, one in named.items():
                found = joined(self.errors(one, F.try_element_at(value, F.lit(name)), kind.valueType, step(path, name=F.lit(name)), under(rule, name)))
                yield F.when(F.map_contains_key(value, name), found).otherwise(none())
            if more is not True:
                rest = F.filter(F.map_entries(value), lambda e: ~e["key"].isin(*named)) if named else F.map_entries(value)
                yield F.flatten(F.transform(rest, lambda e: joined(self.errors(more, e["value"], kind.valueType, step(path, name=e["key"]), rule))))

    def members(self, schema: dict, found: dict[str, tuple[Column, T.DataType]], path: Column, rule: str) -> Iterator[Column]:
        """Errors of the members of an object, whose names are known."""
        named = schema.get("properties", {})
        if not self.partial:
            for name in schema.get("required", ()):
                if name not in found:
                    yield self.one(F.lit(True), path, rule, f"must have {name}")
        for name, (value, kind) in found.items():
            one = named[name] if name in named else schema.get("additionalProperties", True)
            yield from self.errors(one, value, kind, step(path, name=F.lit(name)), under(rule, name))


def none() -> Column:
    return F.array().cast(f"array<{ERROR}>")


def under(rule: str, name: str) -> str:
    return f"{rule}/{name}" if rule else name


def step(path: Column, at: Column | None = None, name: Column | None = None) -> Column:
    number = F.lit(None).cast("bigint") if at is None else at.cast("bigint")
    return F.concat(path, F.array(F.struct(number.alias("at"), (F.lit(None).cast("string") if name is None else name).alias("name"))))


def joined(errors: list[Column]) -> Column:
    return F.concat(*errors) if errors else none()


def errors(schema: dict, columns: T.StructType, partial: bool = False) -> Column:
    """All errors of a row as an array of ERROR, where ``schema`` is that of a
    list of rows (or of one). If ``partial``, what the table doesn't have isn't
    missed, and columns that the schema doesn't know don't count."""
    check_schema(schema)
    item = schema.get("items", {}) if schema.get("type") == "array" else schema
    while isinstance(item, dict) and "$ref" in item:
        item = resolve(schema, item["$ref"])
    if not isinstance(item, dict):
        raise SchemaError("schema: rows must be objects")
    if others := set(item) - {"type", "properties", "additionalProperties", "required", *NOTES}:
        raise SchemaError(f"schema: not supported for rows: {', '.join(sorted(others))}")
    if "object" not in ([item["type"]] if isinstance(item.get("type"), str) else item.get("type", ["object"])):
        raise SchemaError("schema: rows must be objects")
    known = item.get("properties", {})
    found = {f.name: (F.col(f"`{f.name}`"), f.dataType) for f in columns if not partial or f.name in known}
    start = F.array().cast("array<struct<at:bigint,name:string>>")
    return joined(list(Compiler(schema, partial).members(item, found, start, "")))


def shown(path: Column) -> Column:
    """A path as text, steps divided by ``/``."""
    return F.array_join(F.transform(path, lambda s: F.coalesce(s["name"], s["at"].cast("string"))), "/")
