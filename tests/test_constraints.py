"""Compiled constraint documents on typed rows, keyword by keyword, and on entity documents beside the hand-written checks."""

from __future__ import annotations

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tessera.constraints import SchemaError, compile_schema
from tessera.schemas import CATEGORIES, ENTITY, LEVELS, violations

ROW = "id string, n long, x double, ok boolean, tags array<string>, sub struct<a: string, b: array<struct<c: long, d: string>>>, m map<string, long>"


@pytest.fixture(scope="module")
def check(spark):
    def errors(document: dict, **values: object) -> list[tuple[str, str]]:
        df = spark.createDataFrame([{**dict.fromkeys(("id", "n", "x", "ok", "tags", "sub", "m")), **values}], ROW)
        return [(e["path"], e["rule"]) for e in df.select(compile_schema(document, df.schema).alias("e")).first()["e"]]

    return errors


def prop(**rules: object) -> dict:
    return {"type": "object", "properties": rules}


CASES = [
    (prop(id={"type": "string", "pattern": "^A[0-9]+$", "minLength": 3, "maxLength": 4}), {"id": "B1"}, [("/id", "pattern"), ("/id", "minLength")]),
    (prop(id={"maxLength": 4}), {"id": "éééé"}, []),
    (prop(id={"type": ["integer", "null"]}), {"id": "x"}, [("/id", "type")]),
    (prop(x={"type": "integer"}), {"x": 2.5}, [("/x", "type")]), (prop(x={"type": "integer"}), {"x": 2.0}, []),
    ({"required": ["id", "n", "none"]}, {"n": 1}, [("/id", "required"), ("/none", "required")]),
    (prop(n={"minimum": 2, "maximum": 5, "multipleOf": 2}, x={"exclusiveMinimum": 1, "exclusiveMaximum": 2}), {"n": 7, "x": 1.0}, [("/n", "maximum"), ("/n", "multipleOf"), ("/x", "exclusiveMinimum")]),
    (prop(id={"enum": ["a", "b", 3]}, n={"const": 4}, ok={"const": True}), {"id": "c", "n": 4, "ok": False}, [("/id", "enum"), ("/ok", "const")]),
    (prop(tags={"minItems": 1, "uniqueItems": True, "items": {"minLength": 2}}), {"tags": ["ab", "c", "ab", None]}, [("/tags", "uniqueItems"), ("/tags/1", "minLength")]),
    (prop(tags={"minItems": 1, "maxItems": 3}), {"tags": []}, [("/tags", "minItems")]),
    (prop(sub={"required": ["a"], "properties": {"b": {"items": {"$ref": "#/$defs/item"}}}}) | {"$defs": {"item": {"required": ["c"], "properties": {"c": {"minimum": 0}}}}},
     {"sub": Row(a=None, b=[Row(c=1, d="x"), Row(c=None, d="y"), Row(c=-1, d=None)])}, [("/sub/a", "required"), ("/sub/b/1/c", "required"), ("/sub/b/2/c", "minimum")]),
    (prop(m={"properties": {"p": {"minimum": 5}}, "additionalProperties": False, "required": ["q"], "propertyNames": {"maxLength": 1}, "maxProperties": 1}), {"m": {"p": 1, "zz": 2}},
     [("/m/p", "minimum"), ("/m/zz", "false"), ("/m/q", "required"), ("/m/zz", "maxLength"), ("/m", "maxProperties")]),
    ({"anyOf": [{"required": ["id"]}, {"required": ["n"]}]}, {}, [("", "anyOf")]), ({"oneOf": [{"required": ["id"]}, {"required": ["n"]}]}, {"id": "a", "n": 1}, [("", "oneOf")]),
    ({"not": {"required": ["id"]}}, {"id": "a"}, [("", "not")]), ({"allOf": [{"required": ["id"]}, {"required": ["n"]}]}, {"id": "a"}, [("/n", "required")]),
    ({"if": {"properties": {"n": {"const": 1}}, "required": ["n"]}, "then": {"required": ["id"]}, "else": {"required": ["x"]}}, {"n": 1}, [("/id", "required")]),
    ({"if": {"properties": {"n": {"const": 1}}, "required": ["n"]}, "then": {"required": ["id"]}, "else": {"required": ["x"]}}, {"n": 2}, [("/x", "required")]),
    ({"dependentRequired": {"id": ["n"]}}, {"id": "a"}, [("/n", "required")]), ({"dependentRequired": {"id": ["n"]}}, {}, []),
    ({"title": "t", "description": "d", "$schema": "s"}, {}, []), ({"minProperties": 1}, {}, [("", "minProperties")]),
]


@pytest.mark.parametrize(("document", "values", "want"), CASES)
def test_keywords(check, document, values, want):
    assert check(document, **values) == want


@pytest.mark.parametrize("document", [{"minimun": 1}, {"type": "text"}, {"$ref": "#/none"}, {"$ref": "http://x"}, {"properties": {"id": {"$ref": "#/properties/id"}}}])
def test_documents_that_cannot_be_compiled(spark, document):
    with pytest.raises(SchemaError):
        compile_schema(document, spark.createDataFrame([], ROW).schema)


def test_as_the_checks_of_entity_documents(spark):
    document = {
        "required": ["schema_version", "fbgn", "symbol", "bullets"],
        "properties": {
            "schema_version": {"const": "1.2"}, "fbgn": {"pattern": "^FBgn[0-9]{7}$"}, "symbol": {"minLength": 1}, "model": {"required": ["provider"]},
            "bullets": {"items": {"required": ["id", "category", "phenotype"], "properties": {
                "id": {"pattern": "^FBgn[0-9]{7}:b[0-9]{2,}$"}, "category": {"enum": list(CATEGORIES)}, "phenotype": {"minLength": 5}, "confidence": {"enum": list(LEVELS)}}}},
        },
    }
    rows = [
        '{"schema_version": "1.2", "fbgn": "FBgn0000001", "symbol": "a", "model": {"provider": "p"}, "bullets": [{"id": "FBgn0000001:b01", "category": "behavior", "phenotype": "sleeps", "direction": "either"}]}',
        '{"schema_version": "1.1", "fbgn": "x", "symbol": "a", "model": {"provider": "p"}, "bullets": [{"id": "q", "category": "no", "phenotype": "abc", "direction": "either", "confidence": "most"}]}',
        '{"fbgn": "FBgn0000001", "symbol": "", "model": {"harness": "h"}, "bullets": []}',
    ]
    docs = spark.createDataFrame([(r,) for r in rows], "j string").select(F.from_json("j", ENTITY).alias("d")).select("d.*")
    got = docs.select(F.size(compile_schema(document, docs.schema)).alias("n"), F.size(violations()).alias("m")).collect()
    assert [r["n"] for r in got] == [r["m"] for r in got] == [0, 6, 3]
    assert "Python" not in docs.select(compile_schema(document, docs.schema))._jdf.queryExecution().toString()
