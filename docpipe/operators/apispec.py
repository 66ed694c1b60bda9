"""API descriptions (OpenAPI 3, Swagger 2) to typed endpoint rows and Markdown files.

References and schemas are recursive and keep the order of their keys, so one
specification is read by one Python function; everything after it (splitting by
size, slugs, footers) is rows.
"""

from __future__ import annotations

import json
import re
import urllib.parse
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from .. import config as C
from ..shipping import ship
from .chunking import regex_tokens

# Verbs in the order they are read, headers that carry no meaning, places of parameters.
METHODS = ("get", "post", "put", "patch", "delete", "head", "options")
TRANSPORT_HEADERS = (
    "date",
    "content-length",
    "content-type",
    "server",
    "connection",
    "keep-alive",
    "transfer-encoding",
    "accept-ranges",
    "vary",
    "etag",
    "last-modified",
    "expires",
    "age",
)
PLACES = ("path", "header", "query", "cookie", "other")
REF_DEPTH, SCHEMA_DEPTH = 20, 2
READ = ("info", "host", "schemes", "basePath", "servers", "paths", "securityDefinitions", "components")
NAMED = frozenset({"paths", "responses", "headers", "properties", "securitySchemes", "securityDefinitions"})  # objects whose keys are names that get sorted


Order = Callable[[str], object]  # the sort key of a name


def ranked(names: list[str]) -> Order:
    """The order of names that Spark has sorted; see `with_order`."""
    rank = {n: i for i, n in enumerate(names)}
    return lambda name: rank.get(name, len(rank))


# --- reading ----------------------------------------------------------------


def _escape_newlines(text: str) -> str:
    """Raw line ends inside strings become \\n."""
    parts = re.split(r'("(?:[^"\\]|\\.)*"?)', text, flags=re.S)
    return "".join(re.sub(r"\r\n|\r|\n", r"\\n", p) if i % 2 else p for i, p in enumerate(parts))


def parse_lenient(text: str):
    """JSON, else JSON after repair of trailing commas, single-quoted values and raw line ends; ValueError if neither."""
    try:
        return json.loads(text)
    except ValueError:
        fixed = re.sub(r",\s*([}\]])", r"\1", text)
        fixed = re.sub(r":\s*'((?:[^'\\]|\\.)*)'", lambda m: ': "' + m[1].replace('"', '\\"') + '"', fixed)
        return json.loads(_escape_newlines(fixed))


def spec_format(spec: dict) -> str:
    if isinstance(spec.get("openapi"), str) and spec["openapi"]:
        return "openapi3"
    if isinstance(spec.get("swagger"), str) and spec["swagger"]:
        return "swagger2"
    if (spec.get("components") or {}).get("schemas"):
        return "openapi3"
    return "swagger2" if spec.get("definitions") else "openapi3"


def is_reference(node: dict) -> bool:
    return isinstance(node.get("$ref"), str) and node["$ref"] != ""


class Resolver:
    """Replaces local references by what they point to, with cycles and depth marked."""

    def __init__(self, root):
        self.root = root

    def pointer(self, ref: str):
        node = self.root
        for part in ref[2:].split("/"):
            name = urllib.parse.unquote(part.replace("~1", "/").replace("~0", "~"))
            if isinstance(node, list) and name.isdigit() and int(name) < len(node):
                node = node[int(name)]
            elif isinstance(node, dict):
                node = node.get(name)
            else:
                return None
        return node

    def ref(self, ref: str, seen: frozenset = frozenset(), depth: int = 0):
        if depth > REF_DEPTH or not ref.startswith("#/"):
            return {"_unresolved": ref}
        if ref in seen:
            return {"_unresolved": f"circular:{ref}"}
        target = self.pointer(ref)
        return {"_unresolved": ref} if target is None else self.deep(target, seen | {ref}, depth + 1)

    def deep(self, node, seen: frozenset = frozenset(), depth: int = 0):
        if depth > REF_DEPTH or not isinstance(node, (dict, list)):
            return node
        if isinstance(node, list):
            return [self.deep(x, seen, depth) if isinstance(x, (dict, list)) else x for x in node]
        if is_reference(node):
            return self.ref(node["$ref"], seen, depth)
        return {k: self.deep(v, seen, depth + 1) if isinstance(v, (dict, list)) else v for k, v in node.items()}

    def document(self) -> dict:
        """The root with what is read of it resolved; schemas and the like only where references lead to them."""
        if is_reference(self.root):
            return self.deep(self.root)
        parts, components = {k: self.root[k] for k in READ if k in self.root}, self.root.get("components")
        if isinstance(components, dict) and not is_reference(components):
            parts["components"] = {k: v for k, v in components.items() if k == "securitySchemes"}
        return self.deep(parts)


# --- schemas ----------------------------------------------------------------


def _word(value) -> str:
    """A value as it reads inside a label."""
    return "" if value is None else str(value).lower() if isinstance(value, bool) else str(value)


def type_label(schema) -> str:
    if not isinstance(schema, dict) or not schema:
        return "any"
    kind, form = schema.get("type"), schema.get("format")
    if schema.get("enum"):
        return "enum (" + ", ".join(map(_word, schema["enum"])) + ")"
    if kind == "array":
        return f"array of {type_label(schema['items'])}" if schema.get("items") else "array"
    if kind:
        return f"{kind} ({form})" if form and kind in ("string", "integer", "number") else kind
    return "object" if any(schema.get(k) for k in ("allOf", "anyOf", "oneOf")) else "any"


def _merged(schema: dict, required: list[str]) -> dict | None:
    """allOf as one schema with properties; None if no part has any."""
    properties, rest, needed = {}, {}, list(required)
    for part in schema["allOf"]:
        if part.get("example") and not any(part.get(k) for k in ("type", "properties", "$ref", "allOf")):
            continue
        properties |= part.get("properties") or {}
        needed += part.get("required") or []
        if part.get("type"):
            rest["type"] = part["type"]
        if not any(part.get(k) for k in ("properties", "type", "required", "example")):
            rest |= part
    properties = (rest.get("properties") or {}) | properties if properties else rest.get("properties") or {}
    return rest | {"properties": properties, "required": needed} if properties else None


def properties_of(schema, required: list[str] | None = None, prefix: str = "", depth: int = 0, order: Order = str) -> list[dict]:
    """Flat property rows: dotted names, [] for items, two levels down, by name at each level."""
    if not isinstance(schema, dict) or depth > SCHEMA_DEPTH:
        return []
    required = required or []
    if isinstance(schema.get("allOf"), list):
        schema = _merged(schema, required) or schema
    variants = schema.get("anyOf") or schema.get("oneOf")
    if variants:
        return [row for v in variants for row in properties_of(v, required, prefix, depth, order)]
    fields = schema.get("properties")
    if not isinstance(fields, dict):
        return []
    needed = set(schema["required"] if schema.get("required") is not None else required)
    rows: list[dict] = []
    for name in sorted(fields, key=order):
        value = fields[name] if isinstance(fields[name], dict) else {}
        full = f"{prefix}.{name}" if prefix else name
        rows.append({"name": full, "type": type_label(value), "required": name in needed, "description": value.get("description") or ""})
        items = value.get("items") if value.get("type") == "array" else None
        inner, mark = (items, "[]") if isinstance(items, dict) else (value, "")
        if inner.get("type") == "object" and inner.get("properties") and depth < SCHEMA_DEPTH:
            rows += properties_of(inner, inner.get("required") or [], full + mark, depth + 1, order)
    return rows


MISSING = object()


def example_of(schema):
    """A schema's own example, or the first of its allOf parts; MISSING if none."""
    if not isinstance(schema, dict):
        return MISSING
    parts = schema["allOf"] if isinstance(schema.get("allOf"), list) else []
    return next((p["example"] for p in (schema, *parts) if isinstance(p, dict) and "example" in p), MISSING)


def _json_media(content) -> dict:
    if not isinstance(content, dict) or not content:
        return {}
    return content.get("application/json") or content.get("*/*") or next(iter(content.values())) or {}


def clean_description(text: str | None) -> str:
    return re.sub(r"<[^>]+>", "", text or "").strip()


# --- endpoints --------------------------------------------------------------


def _parameter(p: dict) -> dict:
    kind = type_label(p["schema"]) if p.get("schema") else p.get("type") or "string"
    return {"name": p.get("name") or "", "in": p.get("in") or "", "required": bool(p.get("required")), "type": kind, "description": p.get("description") or ""}


def _body(raw: dict, schema, example, order: Order) -> dict:
    schema = schema or {}
    rows = properties_of(schema, schema.get("required") or [], order=order)
    return {"description": raw.get("description") or "", "required": bool(raw.get("required")), "properties": rows, "example": example}


def _response(code: str, raw: dict, form: str, order: Order) -> dict:
    media = _json_media(raw.get("content")) if form == "openapi3" else raw
    schema = media.get("schema") or {}
    example = MISSING
    if form == "openapi3":
        first = next(iter((media.get("examples") or {}).values()), None)
        example = first["value"] if isinstance(first, dict) and "value" in first else media.get("example", MISSING)
    else:
        example = (raw.get("examples") or {}).get("application/json") or MISSING
    headers = [
        {"name": n, "description": h.get("description") or "", "type": (h.get("schema") or {}).get("type") or h.get("type") or "string"}
        for n, h in sorted((raw.get("headers") or {}).items(), key=lambda x: order(x[0]))
        if n.lower() not in TRANSPORT_HEADERS
    ]
    return {
        "statusCode": code,
        "description": raw.get("description") or "",
        "properties": properties_of(schema, schema.get("required") or [], order=order),
        "example": example_of(schema) if example is MISSING else example,
        "headers": headers,
    }


def _endpoint(path: str, method: str, op: dict, shared: list, form: str, order: Order = str) -> dict:
    by_key = {f"{p.get('name')}:{p.get('in')}": p for p in (*shared, *(op.get("parameters") or []))}  # first place, last value
    in_body = [p for p in by_key.values() if form == "swagger2" and p.get("in") == "body"]
    body = None
    if in_body:
        body = _body(in_body[-1], in_body[-1].get("schema"), example_of(in_body[-1].get("schema")), order)
    elif op.get("requestBody"):
        media = _json_media(op["requestBody"].get("content"))
        example = example_of(media.get("schema"))
        body = _body(op["requestBody"], media.get("schema"), (media.get("example", example) if example is MISSING or not example else example), order)
    responses = sorted((op.get("responses") or {}).items(), key=lambda x: order(str(x[0])))
    return {
        "method": method.upper(),
        "path": path,
        "summary": op.get("summary") or "",
        "description": op.get("description") or "",
        "operationId": op.get("operationId") or "",
        "tags": sorted(op.get("tags") or []),
        "parameters": [_parameter(p) for p in by_key.values() if p not in in_body],
        "requestBody": body,
        "responses": [_response(str(c), r or {}, form, order) for c, r in responses],
        "deprecated": bool(op.get("deprecated")),
    }


def endpoints_of(resolved: dict, form: str, order: Order = str) -> list[dict]:
    found = [
        _endpoint(path, method, item[method], item.get("parameters") or [], form, order)
        for path, item in (resolved.get("paths") or {}).items()
        if isinstance(item, dict)
        for method in METHODS
        if item.get(method)
    ]
    return sorted(found, key=lambda e: (order(e["path"]), e["method"]))


def security_of(resolved: dict, form: str, order: Order = str) -> list[dict]:
    schemes = resolved.get("securityDefinitions") if form == "swagger2" else (resolved.get("components") or {}).get("securitySchemes")
    return [
        {"name": n, "type": s.get("type") or ""} | {k: s.get(k) for k in ("scheme", "in", "description")}
        for n, s in sorted((schemes or {}).items(), key=lambda x: order(x[0]))
    ]


def parse_spec(raw: dict, order: Order = str) -> dict:
    form = spec_format(raw)
    spec = Resolver(raw).document()
    info = spec.get("info") or {}
    if form == "swagger2":
        host = spec.get("host") or ""
        base = f"{(spec.get('schemes') or ['https'])[0]}://{host}{spec.get('basePath') or ''}" if host else ""
    else:
        base = ((spec.get("servers") or [{}])[0]).get("url") or ""
    return {
        "title": info.get("title") or "Untitled API",
        "description": clean_description(info.get("description")),
        "version": info.get("version") or "",
        "baseUrl": base,
        "format": form,
        "endpoints": endpoints_of(spec, form, order),
        "securitySchemes": security_of(spec, form, order),
    }


# --- Markdown ---------------------------------------------------------------


def stable_json(value, indent: int | None = 2) -> str:
    """Keys sorted at all levels, those that are whole numbers first and by value."""

    def order(v):
        if isinstance(v, dict):
            number = lambda k: (0, int(k), "") if re.fullmatch(r"0|[1-9]\d{0,9}", k) else (1, 0, k)
            return {k: order(v[k]) for k in sorted(v, key=number)}
        return [order(x) for x in v] if isinstance(v, list) else v

    separators = None if indent else (",", ":")
    return json.dumps(order(value), indent=indent, ensure_ascii=False, separators=separators)


def json_text(column: Column) -> Column:
    """Lenient JSON as compact text in the stable order; null for null and for what can't be read."""

    def one(text: str) -> str | None:
        try:
            return stable_json(parse_lenient(text), None)
        except ValueError:
            return None

    return F.pandas_udf(lambda texts: texts.map(one, na_action="ignore"), StringType())(column)


def _bullet(name: str, facts: list[str], description: str) -> str:
    return f"- `{name}` ({', '.join(facts)})" + (f" — {description}" if description else "")


def _need(row: dict) -> str:
    return "**required**" if row["required"] else "optional"


def property_bullets(rows: list[dict]) -> str:
    return "\n".join(_bullet(r["name"], [r["type"], _need(r)], r["description"]) for r in rows)


def _block(title: str, *parts: list[str]) -> list[str]:
    """A titled block: parts follow each other with a blank line between."""
    out = [title]
    for part in parts:
        if part:
            out += ["", *part]
    return out


def _example_lines(example) -> list[str]:
    return [] if example is MISSING else ["**Example:**", "```json", stable_json(example), "```"]


def _auth(schemes: list[dict]) -> list[str]:
    lines = ["### Authentication"] if schemes else []
    for s in schemes:
        how = f" ({s['scheme']})" if s["scheme"] else f" (in {s['in']})" if s["in"] else ""
        lines.append(f"- **{s['name']}**: {s['type']}{how}")
        lines += [f"  {s['description']}"] if s["description"] else []
    return lines


def render_header(spec: dict) -> str:
    version, base = spec["version"], spec["baseUrl"]
    paragraphs = [
        f"# {spec['title']}",
        spec["description"],
        version and f"**Version:** {version}",
        base and f"**Base URL:** `{base}`",
        "\n".join(_auth(spec["securitySchemes"])),
    ]
    return "\n".join(line for p in paragraphs if p for line in (p, ""))


def grouped_parameters(params: list[dict], order: Order = str) -> list[dict]:
    """Parameters by place in the fixed order, then by name; other places are left out."""
    known = [p | {"in": p["in"] or "other"} for p in params]
    return sorted((p for p in known if p["in"] in PLACES), key=lambda p: (PLACES.index(p["in"]), order(p["name"])))


def render_endpoint(e: dict, order: Order = str) -> str:
    rows = [_bullet(p["name"], [p["in"], p["type"], _need(p)], p["description"]) for p in grouped_parameters(e["parameters"], order)]
    body = e["requestBody"]
    paragraphs = [
        f"## {e['method']} {e['path']}" + (" (DEPRECATED)" if e["deprecated"] else ""),
        e["summary"],
        e["description"] if e["description"] != e["summary"] else "",
        e["tags"] and f"**Tags:** {', '.join(e['tags'])}",
        "\n".join(["### Parameters", *rows]) if e["parameters"] else "",
    ]
    if body:
        head = ["### Request Body", *([body["description"]] if body["description"] else [])]
        bullets = [b for b in [property_bullets(body["properties"])] if b]
        paragraphs.append("\n".join(_block("\n".join(head), bullets, _example_lines(body["example"]))))
    for r in e["responses"]:
        title = f"### Response {r['statusCode']}" + (f" — {r['description']}" if r["description"] else "")
        headers = [_bullet(h["name"], [h["type"]], h["description"]) for h in r["headers"]]
        bullets = [b for b in [property_bullets(r["properties"])] if b]
        paragraphs.append("\n".join(_block(title, ["**Headers:**", *headers] if headers else [], bullets, _example_lines(r["example"]))))
    return "\n".join(line for p in paragraphs if p for line in (p, ""))


def render_footer(product: str, category: str, form: str) -> str:
    facts = {"source_type": "api-spec", "product": product, "category": category, "spec_version": form}
    return "\n".join(["---", "## RAG Metadata", *(f"- {k}: {v}" for k, v in facts.items()), ""])


def endpoint_slug(e: dict) -> str:
    if e["operationId"]:
        text = re.sub(r"([a-z])([A-Z])", r"\1-\2", e["operationId"])
        return re.sub(r"-+", "-", re.sub(r"[^a-zA-Z0-9-]", "-", text)).removeprefix("-").removesuffix("-").lower()
    path = re.sub(r"-+", "-", re.sub(r"[^a-zA-Z0-9]", "-", e["path"])).removeprefix("-").removesuffix("-")
    return f"{e['method'].lower()}-{path}"


def output_files(spec: dict, category: str, product: str, count: Callable[[str], int] = regex_tokens, limit: int = C.SPEC_FILE_LIMIT, order: Order = str) -> list[tuple[str, str, int]]:
    """(path, Markdown, tokens): one file, or one an endpoint if that is above the limit."""
    head, foot = render_header(spec), render_footer(product, category, spec["format"])
    page = lambda parts: f"{head}\n" + "\n".join(parts) + f"\n{foot}"
    bodies = [render_endpoint(e, order) for e in spec["endpoints"]]
    whole = page(bodies)
    size = count(whole)
    if size <= limit:
        return [(f"{category}/{product}.md", whole, size)]
    pages = ((f"{category}/{product}.{endpoint_slug(e)}.md", page([b])) for e, b in zip(spec["endpoints"], bodies))
    return [(path, text, count(text)) for path, text in pages]


# --- tables -----------------------------------------------------------------

FILE_SCHEMA = "path string, out_path string, markdown string, token_count int, error string"
ENDPOINT_SCHEMA = (
    "path string, seq int, method string, route string, summary string, operation_id string, tags array<string>, "
    "parameters array<struct<name:string,place:string,required:boolean,type:string,description:string>>, "
    "body_properties array<struct<name:string,type:string,required:boolean,description:string>>, "
    "statuses array<string>, deprecated boolean, slug string"
)


def _names_in(node, found: dict[str, None], named: bool = False, every: bool = False) -> bool:
    """Add the keys of NAMED objects (with `every` those of all objects) and the values of `name`; False if a NAMED object stands behind a reference."""
    if isinstance(node, list):
        return all([_names_in(v, found, False, every) for v in node if isinstance(v, (dict, list))])
    here = not named or not is_reference(node)
    for k, v in node.items():
        if named or every:
            found[k] = None
        if isinstance(v, (dict, list)):
            here &= _names_in(v, found, k in NAMED and isinstance(v, dict), every)
        elif k == "name" and isinstance(v, str):
            found[v] = None
    return here


@F.arrow_udf(ArrayType(StringType()))
def names_of(texts: pa.Array) -> pa.Array:
    """The distinct names of each specification that may have to be sorted; none if it can't be read."""

    def one(text: str | None) -> list[str]:
        found = {"": None}
        try:
            spec = parse_lenient(text or "")
            if isinstance(spec, (dict, list)) and not _names_in(spec, found):
                _names_in(spec, found, every=True)  # any object may be one of names
        except (ValueError, RecursionError):
            return []
        return list(found)

    return pa.array([one(t) for t in texts.to_pylist()], pa.list_(pa.string()))


def with_order(specs: DataFrame) -> DataFrame:
    """path, text and the names of each specification that may have to be sorted, in the UNICODE collation: Spark sorts, in the row; Python only looks ranks up."""
    names = F.array_sort(F.transform(names_of(F.col("text")), lambda n: F.collate(n, "UNICODE")))
    return specs.select("path", "text", F.transform(names, lambda n: F.collate(n, "UTF8_BINARY")).alias("names"))


def _files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = pa.string(), pa.string(), pa.string(), pa.int32(), pa.string()
    for batch in batches:
        rows: list[tuple] = []
        for path, text, names in zip(*(batch.column(c).to_pylist() for c in ("path", "text", "names"))):
            order = ranked(names)
            category, *rest = path.removesuffix(".json").split("/")
            try:
                files = output_files(parse_spec(parse_lenient(text or ""), order), category, "/".join(rest) or category, order=order)
                rows += [(path, *f, None) for f in files]
            except (ValueError, AttributeError, TypeError) as e:  # a broken file is reported, not fatal
                rows.append((path, None, None, None, f"{type(e).__name__}: {e}"[:200]))
        columns = zip(*rows) if rows else [()] * len(kinds)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["path", "out_path", "markdown", "token_count", "error"])


def spec_files(specs: DataFrame) -> DataFrame:
    """Markdown files of specs (path, text); a specification that cannot be read gives one row with error."""
    ship(specs.sparkSession)
    return with_order(specs).mapInArrow(_files, FILE_SCHEMA)


def _endpoints(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [c.split()[0] for c in re.split(r", (?=[a-z_]+ )", ENDPOINT_SCHEMA)]
    for pdf in batches:
        rows = []
        for path, text, in_order in zip(pdf.path, pdf.text, pdf.names):
            try:
                found = parse_spec(parse_lenient(text or ""), ranked(in_order))["endpoints"]
            except (ValueError, AttributeError, TypeError):
                continue
            for i, e in enumerate(found):
                params = [{"place": p["in"], **{k: p[k] for k in ("name", "required", "type", "description")}} for p in e["parameters"]]
                body = (e["requestBody"] or {}).get("properties", [])
                statuses = [r["statusCode"] for r in e["responses"]]
                rows.append((path, i, e["method"], e["path"], e["summary"], e["operationId"], e["tags"], params, body, statuses, e["deprecated"], endpoint_slug(e)))
        yield pd.DataFrame(rows, columns=names)


def endpoint_table(specs: DataFrame) -> DataFrame:
    """One row an endpoint of specs (path, text)."""
    ship(specs.sparkSession)
    return with_order(specs).mapInPandas(_endpoints, ENDPOINT_SCHEMA)
