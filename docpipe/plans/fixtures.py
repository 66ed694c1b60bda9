"""Small specifications of our own, for the specification queries and tests."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession


def _operation(name: str, words: int) -> dict:
    return {
        "operationId": name,
        "summary": f"Do {name}",
        "description": "word " * words,
        "tags": ["b", "a"],
        "parameters": [{"name": "id", "in": "path", "required": True, "schema": {"type": "string"}}, {"name": "X-Trace", "in": "header", "schema": {"type": "string"}}],
        "requestBody": {"required": True, "content": {"application/json": {"schema": {"$ref": "#/components/schemas/Order"}}}},
        "responses": {
            "404": {"description": "Missing"},
            "200": {"description": "Done", "headers": {"X-Rate": {"schema": {"type": "integer"}}, "Date": {}}, "content": {"application/json": {"schema": {"$ref": "#/components/schemas/Order"}, "example": {"b": 1, "a": [1, 2]}}}},
        },
    }


def openapi(operations: int, words: int) -> dict:
    order = {
        "type": "object",
        "required": ["id"],
        "properties": {
            "id": {"type": "string", "format": "uuid", "description": "key"},
            "lines": {"type": "array", "items": {"type": "object", "properties": {"sku": {"type": "string"}}}},
            "parent": {"$ref": "#/components/schemas/Order"},
        },
    }
    paths = {f"/orders/{i}/{{id}}": {"post": _operation(f"createOrder{i}", words)} for i in range(operations)}
    return {"openapi": "3.0.1", "info": {"title": "Orders", "version": "1", "description": "<b>All</b> orders"}, "servers": [{"url": "https://api.example.com"}], "paths": paths, "components": {"schemas": {"Order": order}, "securitySchemes": {"key": {"type": "apiKey", "in": "header"}}}}


SWAGGER = """{
  "swagger": "2.0", "host": "old.example.com", "basePath": "/v1", "schemes": ["http"],
  "info": {"title": "Old", "description": 'single "quoted" value'},
  "securityDefinitions": {"basic": {"type": "basic"}},
  "paths": {"/pay": {"post": {"parameters": [{"name": "body", "in": "body", "schema": {"type": "object", "required": ["a"], "properties": {"b": {"type": "number"}, "a": {"type": "string"}}}}],
    "responses": {"200": {"description": "line one
line two"}},}}},
}"""


def specs(spark: SparkSession) -> DataFrame:
    rows = [
        ("payments/small.json", json.dumps(openapi(2, 5))),
        ("payments/large.json", json.dumps(openapi(60, 150))),
        ("data/old.json", SWAGGER),
        ("data/broken.json", "not json at all"),
    ]
    return spark.createDataFrame(rows, "path string, text string")
