"""Constraint documents (JSON Schema) compiled into column expressions: rows are validated where they lie, inside whole-stage code.

    errors = compile_schema(json.load(open("bullet.schema.json")), docs.schema)
    docs.withColumn("errors", errors)

The result is an array of struct<path, rule, message>, in order of the document, empty where a row is valid. The keywords are those that say something about
typed columns: type, required, properties, items, enum, const, pattern, minLength, maxLength, minimum, maximum, exclusiveMinimum,
exclusiveMaximum, multipleOf, minItems, maxItems, uniqueItems, additionalProperties (false), minProperties, maxProperties, propertyNames, allOf, anyOf, oneOf, not, if/then/else, dependentRequired, and $ref to
definitions of the same document. Keywords that only describe are passed over; any other one is an error when the document is compiled, not silence.

A null column is an absent property: it breaks ``required`` alone. Properties that the row's type does not have are absent in every row. Objects are
structs or maps from strings; where a map stands for an object, its keys are the properties.
"""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

DESCRIBING = {"$schema", "$id", "$comment", "title", "description", "default", "examples", "definitions", "$defs", "format", "deprecated", "readOnly", "writeOnly", "contentMediaType"}
ERROR = "array<struct<path: string, rule: string, message: string>>"
_KINDS = {
    "object": (T.StructType, T.MapType), "array": (T.ArrayType,), "string": (T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType),
    "integer": (T.IntegralType,), "number": (T.NumericType,), "boolean": (T.BooleanType,), "null": (),
}


class SchemaError(ValueError):
    """A constraint document that cannot be compiled."""


def _none() -> Column:
    return F.array().cast(ERROR)


def _when(broken: Column, path: Column, rule: str, message: str) -> Column:
    """One error where ``broken`` holds; null (nothing to say) is no error."""
    return F.when(broken, F.array(F.struct(path.alias("path"), F.lit(rule).alias("rule"), F.lit(message).alias("message")))).otherwise(_none())


def _join(errors: list[Column]) -> Column:
    return F.concat(*errors) if len(errors) > 1 else errors[0] if errors else _none()


def _literal(value: object, kind: T.DataType) -> Column | None:
    """The value as a column of the kind; None if no such column can equal it."""
    if isinstance(kind, T.StringType):
        return F.lit(value) if isinstance(value, str) else None
    if isinstance(kind, T.BooleanType):
        return F.lit(value) if isinstance(value, bool) else None
    if isinstance(kind, T.NumericType):
        return F.lit(value) if isinstance(value, int | float) and not isinstance(value, bool) else None
    return F.from_json(F.lit(json.dumps(value)), kind) if isinstance(value, dict | list) and isinstance(kind, T.StructType | T.ArrayType) else None


class _Compiler:
    def __init__(self, document: dict) -> None:
        self.document = document
        self.open: list[str] = []

    def resolve(self, ref: str) -> dict | bool:
        if not ref.startswith("#"):
            raise SchemaError(f"$ref {ref}: only definitions of the same document can be meant")
        at: object = self.document
        for step in [s.replace("~1", "/").replace("~0", "~") for s in ref[1:].split("/") if s]:
            if not isinstance(at, dict) or step not in at:
                raise SchemaError(f"$ref {ref}: there is no such definition")
            at = at[step]
        return at

    def errors(self, schema: dict | bool, value: Column, kind: T.DataType, path: Column) -> Column:
        """Errors of a value that is not null."""
        if schema is True or schema == {}:
            return _none()
        if schema is False:
            return _when(value.isNotNull(), path, "false", "nothing is allowed here")
        found = []
        if "$ref" in schema:
            if schema["$ref"] in self.open:
                raise SchemaError(f"$ref {schema['$ref']}: a type of a column cannot hold itself")
            self.open.append(schema["$ref"])
            found.append(self.errors(self.resolve(schema["$ref"]), value, kind, path))
            self.open.pop()
        for rule in schema:
            if rule in DESCRIBING or rule in ("$ref", "then", "else"):
                continue
            make = getattr(self, "rule_" + rule, None)
            if make is None:
                raise SchemaError(f"keyword {rule} is not known")
            found.append(make(schema[rule], value, kind, path, schema))
        return F.when(value.isNotNull(), _join(found)).otherwise(_none()) if found else _none()

    def broken(self, schema: dict | bool, value: Column, kind: T.DataType) -> Column:
        return F.size(self.errors(schema, value, kind, F.lit(""))) > 0

    # --- any value -------------------------------------------------------------------------------------------------------

    def rule_type(self, wanted: str | list, value: Column, kind: T.DataType, path: Column, schema: dict) -> Column:
        names = [wanted] if isinstance(wanted, str) else wanted
        if unknown := set(names) - set(_KINDS):
            raise SchemaError(f"type {unknown.pop()} is not known")
        fits = any(isinstance(kind, _KINDS[n]) for n in names)
        if not fits and "integer" in names and isinstance(kind, T.FractionalType):
            return _when(value != F.floor(value), path, "type", "is not integer")
        return _when(F.lit(not fits), path, "type", f"is not {' or '.join(names)}")

    def rule_enum(self, values: list, value: Column, kind: T.DataType, path: Column, schema: dict) -> Column:
        known = [x for v in values if (x := _literal(v, kind)) is not None]
        inside = F.lit(False)
        for x in known:
            inside = inside | (value == x)
        return _when(~(value.isin(*known) if known and isinstance(kind, T.AtomicType) else inside), path, "enum", "is not in the enumeration")

    def rule_const(self, wanted: object, value: Column, kind: T.DataType, path: Column, schema: dict) -> Column:
        x = _literal(wanted, kind)
        return _when(F.lit(True) if x is None else value != x, path, "const", f"is not {json.dumps(wanted)}")

    # --- strings and numbers ---------------------------------------------------------------------------------------------

    def _text(self, rule: str, broken: Column, kind: T.DataType, path: Column, message: str) -> Column:
        return _when(broken, path, rule, message) if isinstance(kind, T.StringType) else _none()

    def rule_pattern(self, pattern: str, value: Column, kind: T.DataType, path: Column, schema: dict) -> Column:
        return self._text("pattern", ~value.rlike(pattern), kind, path, "has the wrong form") if isinstance(kind, T.StringType) else _none()

    def rule_minLength(self, n: int, value: Column, kind: T.DataType, path: Column, schema: dict) -> Column:  # noqa: N802
        return self._text("minLength", F.length(value) < n, kind, path, f"is shorter than {n}")

    def rule_maxLength(self, n: int, value: Column, kind: T.DataType, path: Column, schema: dict) -> Column:  # noqa: N802
        return self._text("maxLength", F.length(value) > n, kind, path, f"is longer than {n}")

    def _number(self, rule: str, broken: Column, kind: T.DataType, path: Column, message: str) -> Column:
        return _when(broken, path, rule, message) if isinstance(kind, T.NumericType) else _none()

    def rule_minimum(self, x: float, value: Column, kind: T.DataType, path: Column, schema: dict) -> Column:
        return self._number("minimum", value < x, kind, path, f"is less than {x}")

    def rule_maximum(self, x: float, value: Column, kind: T.DataType, path: Column, schema: dict) -> Column:
        return self._number("maximum", value > x, kind, path, f"is more than {x}")

    def rule_exclusiveMinimum(self, x: float, value: Column, kind: T.DataType, path: Column, schema: dict) -> Column:  # noqa: N802
        return self._number("exclusiveMinimum", value <= x, kind, path, f"is not more than {x}")

    def rule_exclusiveMaximum(self, x: float, value: Column, kind: T.DataType, path: Column, schema: dict) -> Column:  # noqa: N802
        return self._number("exclusiveMaximum", value >= x, kind, path, f"is not less than {x}")

    def rule_multipleOf(self, x: float, value: Column, kind: T.DataType, path: Column, schema: dict) -> Column:  # noqa: N802
        return self._number("multipleOf", value % x != 0, kind, path, f"is no multiple of {x}")

    # --- arrays ----------------------------------------------------------------------------------------------------------

    def _array(self, rule: str, broken: Column, kind: T.DataType, path: Column, message: str) -> Column:
        return _when(broken, path, rule, message) if isinstance(kind, T.ArrayType) else _none()

    def rule_minItems(self, n: int, value: Column, kind: T.DataType, path: Column, schema: dict) -> Column:  # noqa: N802
        return self._array("minItems", F.size(value) < n, kind, path, f"has fewer than {n} items") if isinstance(kind, T.ArrayType) else _none()

    def rule_maxItems(self, n: int, value: Column, kind: T.DataType, path: Column, schema: dict) -> Column:  # noqa: N802
        return self._array("maxItems", F.size(value) > n, kind, path, f"has more than {n} items") if isinstance(kind, T.ArrayType) else _none()

    def rule_uniqueItems(self, on: bool, value: Column, kind: T.DataType, path: Column, schema: dict) -> Column:  # noqa: N802
        return self._array("uniqueItems", F.size(F.array_distinct(value)) < F.size(value), kind, path, "repeats an item") if on and isinstance(kind, T.ArrayType) else _none()

    def rule_items(self, schema: dict | bool, value: Column, kind: T.DataType, path: Column, whole: dict) -> Column:
        if not isinstance(kind, T.ArrayType):
            return _none()
        return F.flatten(F.transform(value, lambda x, i: self.errors(schema, x, kind.elementType, F.concat(path, F.lit("/"), i.cast("string")))))

    # --- objects ---------------------------------------------------------------------------------------------------------

    def _child(self, name: str, value: Column, kind: T.DataType) -> tuple[Column, T.DataType] | None:
        """A property's column and type; None if rows cannot have it."""
        if isinstance(kind, T.StructType):
            return (value.getField(name), kind[name].dataType) if name in kind.names else None
        if isinstance(kind, T.MapType) and isinstance(kind.keyType, T.StringType):
            return F.element_at(value, F.lit(name)), kind.valueType
        return None

    def rule_required(self, names: list[str], value: Column, kind: T.DataType, path: Column, schema: dict) -> Column:
        if not isinstance(kind, T.StructType | T.MapType):
            return _none()
        own = {n: self._child(n, value, kind) for n in names}
        return _join([_when(F.lit(True) if c is None else c[0].isNull(), F.concat(path, F.lit(f"/{n}")), "required", "is missing") for n, c in own.items()])

    def rule_properties(self, parts: dict, value: Column, kind: T.DataType, path: Column, schema: dict) -> Column:
        own = {n: self._child(n, value, kind) for n in parts}
        return _join([self.errors(parts[n], c[0], c[1], F.concat(path, F.lit(f"/{n}"))) for n, c in own.items() if c is not None])

    def rule_additionalProperties(self, rest: dict | bool, value: Column, kind: T.DataType, path: Column, schema: dict) -> Column:  # noqa: N802
        known = list(schema.get("properties", {}))
        if isinstance(kind, T.StructType):
            return _join([self.errors(rest, value.getField(n), kind[n].dataType, F.concat(path, F.lit(f"/{n}"))) for n in kind.names if n not in known])
        if not isinstance(kind, T.MapType):
            return _none()
        left = F.map_entries(F.map_filter(value, lambda k, v: ~k.isin(*known) if known else F.lit(True)))
        return F.flatten(F.transform(left, lambda e: self.errors(rest, e["value"], kind.valueType, F.concat(path, F.lit("/"), e["key"]))))

    def _present(self, value: Column, kind: T.DataType) -> Column:
        if isinstance(kind, T.MapType):
            return F.size(value)
        return sum((value.getField(n).isNotNull().cast("int") for n in kind.names), F.lit(0))

    def rule_minProperties(self, n: int, value: Column, kind: T.DataType, path: Column, schema: dict) -> Column:  # noqa: N802
        return _when(self._present(value, kind) < n, path, "minProperties", f"has fewer than {n} properties") if isinstance(kind, T.StructType | T.MapType) else _none()

    def rule_maxProperties(self, n: int, value: Column, kind: T.DataType, path: Column, schema: dict) -> Column:  # noqa: N802
        return _when(self._present(value, kind) > n, path, "maxProperties", f"has more than {n} properties") if isinstance(kind, T.StructType | T.MapType) else _none()

    def rule_propertyNames(self, names: dict | bool, value: Column, kind: T.DataType, path: Column, schema: dict) -> Column:  # noqa: N802
        if not isinstance(kind, T.MapType):
            return _none()
        return F.flatten(F.transform(F.map_keys(value), lambda k: self.errors(names, k, kind.keyType, F.concat(path, F.lit("/"), k))))

    def rule_dependentRequired(self, needs: dict, value: Column, kind: T.DataType, path: Column, schema: dict) -> Column:  # noqa: N802
        own = {n: self._child(n, value, kind) for n in needs}
        return _join([F.when(c[0].isNotNull(), self.rule_required(needs[n], value, kind, path, schema)).otherwise(_none()) for n, c in own.items() if c is not None])

    # --- combinations ----------------------------------------------------------------------------------------------------

    def rule_allOf(self, parts: list, value: Column, kind: T.DataType, path: Column, schema: dict) -> Column:  # noqa: N802
        return _join([self.errors(p, value, kind, path) for p in parts])

    def _fitting(self, parts: list, value: Column, kind: T.DataType) -> Column:
        return sum(((~self.broken(p, value, kind)).cast("int") for p in parts), F.lit(0))

    def rule_anyOf(self, parts: list, value: Column, kind: T.DataType, path: Column, schema: dict) -> Column:  # noqa: N802
        return _when(self._fitting(parts, value, kind) == 0, path, "anyOf", "fits no alternative")

    def rule_oneOf(self, parts: list, value: Column, kind: T.DataType, path: Column, schema: dict) -> Column:  # noqa: N802
        return _when(self._fitting(parts, value, kind) != 1, path, "oneOf", "does not fit just one alternative")

    def rule_not(self, part: dict | bool, value: Column, kind: T.DataType, path: Column, schema: dict) -> Column:
        return _when(~self.broken(part, value, kind), path, "not", "fits what is excluded")

    def rule_if(self, part: dict | bool, value: Column, kind: T.DataType, path: Column, schema: dict) -> Column:
        then, other = (self.errors(schema[k], value, kind, path) if k in schema else _none() for k in ("then", "else"))
        return F.when(self.broken(part, value, kind), other).otherwise(then)


def compile_schema(document: dict, kind: T.StructType, row: Column | None = None) -> Column:
    """The errors of a row with the columns of ``kind`` (or of the struct ``row`` of that type) under the constraint document."""
    whole = F.struct(*[F.col(f"`{n}`").alias(n) for n in kind.names]) if row is None else row
    return _Compiler(document).errors(document, whole, kind, F.lit(""))
