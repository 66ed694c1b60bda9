from __future__ import annotations

import json
import random
import unicodedata

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docpipe.functions import text as T
from docpipe.operators import apispec as A
from docpipe.plans import fixtures


@pytest.mark.parametrize(("raw", "want"), [('{"key": "value",}', {"key": "value"}), ('{"arr": [1, 2,]}', {"arr": [1, 2]}), ("{\"a\": 'x \"y\"'}", {"a": 'x "y"'}), ('{"a": "b\r\nc"}', {"a": "b\nc"})])
def test_repair(raw, want):
    assert A.parse_lenient(raw) == want


def test_no_json():
    with pytest.raises(ValueError):
        A.parse_lenient("not json at all")


@pytest.mark.parametrize(("spec", "form"), [({"openapi": "3.0.0"}, "openapi3"), ({"swagger": "2.0"}, "swagger2"), ({"components": {"schemas": {"A": {}}}}, "openapi3"), ({"definitions": {"A": {}}}, "swagger2"), ({}, "openapi3")])
def test_format(spec, form):
    assert A.spec_format(spec) == form


def test_refs():
    root = {"components": {"schemas": {"A": {"type": "string"}, "B": {"x": {"$ref": "#/components/schemas/B"}}, "a/b": 1}}}
    r = A.Resolver(root)
    assert r.ref("#/components/schemas/A") == {"type": "string"}
    assert r.ref("#/components/schemas/Z") == {"_unresolved": "#/components/schemas/Z"}
    assert r.ref("other.json#/A") == {"_unresolved": "other.json#/A"}
    assert r.ref("#/components/schemas/B") == {"x": {"_unresolved": "circular:#/components/schemas/B"}}
    assert r.ref("#/components/schemas/a~1b") == 1


@pytest.mark.parametrize(
    ("schema", "label"),
    [({"enum": ["a", 1]}, "enum (a, 1)"), ({"type": "array", "items": {"type": "string"}}, "array of string"), ({"type": "array"}, "array"), ({"type": "string", "format": "date"}, "string (date)"), ({"type": "boolean", "format": "x"}, "boolean"), ({"anyOf": [{}]}, "object"), ({}, "any"), (None, "any")],
)
def test_labels(schema, label):
    assert A.type_label(schema) == label


def test_properties():
    names = lambda s, *a: [(p["name"], p["required"]) for p in A.properties_of(s, *a)]
    assert names({"properties": {"name": {}, "age": {}}}, ["name"]) == [("age", False), ("name", True)]
    nested = {"properties": {"data": {"type": "object", "required": ["id"], "properties": {"id": {"type": "string"}}}}}
    assert names(nested) == [("data", False), ("data.id", True)]
    items = {"properties": {"rows": {"type": "array", "items": {"type": "object", "properties": {"x": {}}}}}}
    assert names(items) == [("rows", False), ("rows[].x", False)]
    both = {"allOf": [{"properties": {"a": {}}, "required": ["a"]}, {"example": 1}, {"properties": {"b": {}}}]}
    assert names(both) == [("a", True), ("b", False)]
    assert names({"oneOf": [{"properties": {"a": {}}}, {"properties": {"a": {}}}]}) == [("a", False)] * 2
    assert names(None) == []


def test_examples_and_descriptions():
    assert A.example_of({"example": None}) is None
    assert A.example_of({"allOf": [{}, {"example": 2}]}) == 2
    assert A.example_of({}) is A.MISSING
    assert A.clean_description("<h2>Hello</h2> <p>World</p>") == "Hello World"
    assert A.clean_description(None) == ""


def test_stable_json():
    assert A.stable_json({"b": 1, "10": 2, "9": 3, "a": {"d": 1, "c": []}}, None) == '{"9":3,"10":2,"a":{"c":[],"d":1},"b":1}'


def test_parameters_merge_and_group():
    shared = [{"name": "a", "in": "query"}, {"name": "z", "in": "path"}]
    op = {"parameters": [{"name": "a", "in": "query", "required": True}, {"name": "b", "in": "body"}]}
    e = A._endpoint("/x", "get", op, shared, "openapi3")
    assert [(p["name"], p["required"]) for p in e["parameters"]] == [("a", True), ("z", False), ("b", False)]
    assert [p["name"] for p in A.grouped_parameters(e["parameters"])] == ["z", "a"]


def test_whole_specs():
    small = A.parse_spec(fixtures.openapi(2, 5))
    (path, text, tokens), = A.output_files(small, "payments", "small")
    assert path == "payments/small.md" and tokens < 6000
    assert "**Base URL:** `https://api.example.com`" in text and text.endswith("- spec_version: openapi3\n")
    assert "- `X-Rate` (integer)" in text and "`Date`" not in text
    assert text.index("### Response 200") < text.index("### Response 404")
    large = A.output_files(A.parse_spec(fixtures.openapi(60, 150)), "payments", "large")
    assert len(large) == 60 and large[0][0] == "payments/large.create-order0.md"
    old = A.parse_spec(A.parse_lenient(fixtures.SWAGGER))
    assert old["baseUrl"] == "http://old.example.com/v1"
    assert [p["name"] for p in old["endpoints"][0]["requestBody"]["properties"]] == ["a", "b"]


def test_broken_files_are_reported(spark):
    got = {r.path: r.error for r in A.spec_files(fixtures.specs(spark)).select("path", "error").distinct().collect()}
    assert got["data/broken.json"] and not got["data/old.json"]


def test_names_are_in_the_order_of_the_collation(spark):
    """5,000 random names beyond ASCII come out as Spark's UNICODE collation has them; no other order is in use."""
    rng = random.Random(5)
    signs = "aAbBzZ09_-.äÄéßøñçœı–—“”’½ªΑωЖж字あ한́"
    names = sorted({"".join(rng.choice(signs) for _ in range(rng.randint(1, 6))) for _ in range(8000)})[:5000]
    rng.shuffle(names)
    spec = {
        "openapi": "3.0.0", "info": {"title": "T", "version": "1"},
        "paths": {
            "/p": {"post": {
                "parameters": [{"name": n, "in": "query"} for n in names[:500]],
                "requestBody": {"content": {"application/json": {"schema": {"type": "object", "properties": {n: {"type": "string"} for n in names}}}}},
                "responses": {"200": {"description": "ok"}},
            }},
            "/é": {"get": {"responses": {}}}, "/f": {"get": {"responses": {}}}, "/E": {"get": {"responses": {}}}, "/d": {"get": {"responses": {}}},
        },
    }
    df = spark.createDataFrame([("a/b.json", json.dumps(spec)), ("a/c.json", json.dumps(spec, ensure_ascii=False)), ("a/bad.json", "{")], "path string, text string")
    rows = {(r.path, r.route): r for r in A.endpoint_table(df).collect()}
    assert [r.route for r in sorted(rows.values(), key=lambda r: r.seq) if r.path == "a/b.json"] == ["/d", "/E", "/é", "/f", "/p"]
    key = lambda x: unicodedata.normalize("NFC", x)  # noqa: E731  (spellings that are canonically equal tie)
    want = [key(r.n) for r in spark.createDataFrame([(n,) for n in names], "n string").orderBy(F.collate("n", "UNICODE")).collect()]
    for path in ("a/b.json", "a/c.json"):
        got = [key(p.name) for p in rows[path, "/p"].body_properties]
        assert got == want
    assert A.spec_files(df).where("error is not null").count() == 1


def test_names_that_are_sorted():
    """Keys of objects that hold names, and all keys if such an object stands behind a reference; schemas that nothing leads to are not resolved."""
    plain = {"paths": {"/b": {"get": {"responses": {"200": {"headers": {"H": {"schema": {"type": "x"}}}}}}}}, "components": {"schemas": {"S": {"properties": {"q": {"name": "n"}}}}}, "title": "no"}
    found = {"": None}
    assert A._names_in(plain, found) and list(found) == ["", "/b", "200", "H", "q", "n"]
    behind = {"paths": {"/b": {"get": {"responses": {"200": {"content": {"application/json": {"schema": {"properties": {"$ref": "#/x"}}}}}}}}}, "x": {"z": {}, "Y": {}}}
    text = A.names_of.func(pa.array([json.dumps(behind), None, "{", "3"])).to_pylist()
    assert {"z", "Y", "/b"} <= set(text[0]) and text[1:] == [[], [], [""]]
    order = A.ranked(sorted(text[0], key=str.lower))
    assert [p["name"] for p in A.parse_spec(behind, order)["endpoints"][0]["responses"][0]["properties"]] == ["Y", "z"]
    loose = {"a": [{"$ref": "#/paths"}] * 3, "paths": {"/a": {"get": {}}}, "components": {"schemas": {"S": 1}, "securitySchemes": {"k": {"$ref": "#/k"}}}, "k": {"type": "t"}}
    assert A.Resolver(loose).document() == {"paths": {"/a": {"get": {}}}, "components": {"securitySchemes": {"k": {"type": "t"}}}}


def test_footer_is_read_once(spark):
    """The last of a key holds, and the lines of the list are not read again for each pair."""
    page = "# T\n\n## RAG Metadata\n- a: 1\n- b: 2\n- a: 3 \n- B: no\n"
    df = spark.createDataFrame([(page,), ("none",), (None,)], "t string")
    found = df.select(T.rag_metadata(F.col("t")).alias("m"))
    assert [r.m for r in found.collect()] == [{"a": "3", "b": "2"}, {}, {}]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1
