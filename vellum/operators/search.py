"""JSON schemas as index definitions of a search engine: one small tree, rewritten on the driver."""

from __future__ import annotations

from typing import Any

#: Types of schemas in an index, by type and format.
TYPES = {("string", None): "text", ("string", "date-time"): "date", ("string", "date"): "date", ("string", "uri"): "keyword",
         ("integer", None): "integer", ("number", None): "float", ("boolean", None): "boolean"}
PREFIX = "x-es-"
DROPPED = {"title", "description", "required", "additionalProperties", "format", "examples", "default", "enum", "const",
           "minimum", "maximum", "pattern", "minLength", "maxLength", "minItems", "maxItems", "uniqueItems", "discriminator"}


def es_field(**settings: Any) -> dict[str, Any]:
    """Settings as keys that a schema may carry."""
    return {PREFIX + k.replace("_", "-"): v for k, v in settings.items()}


def _resolved(node: Any, definitions: dict, seen: tuple[str, ...] = ()) -> Any:
    if isinstance(node, list):
        return [_resolved(x, definitions, seen) for x in node]
    if not isinstance(node, dict):
        return node
    ref = node.get("$ref")
    if isinstance(ref, str):
        name = ref.rsplit("/", 1)[-1]
        if name in seen:
            return {}
        rest = {k: v for k, v in node.items() if k != "$ref"}
        return _resolved({**definitions.get(name, {}), **rest}, definitions, (*seen, name))
    return {k: _resolved(v, definitions, seen) for k, v in node.items() if k not in ("$defs", "definitions")}


def _merged(node: dict) -> dict:
    """Unions as one: their branches' keys, properties of all of them, nulls left out."""
    out = {k: v for k, v in node.items() if k not in ("anyOf", "oneOf", "allOf")}
    for union in ("anyOf", "oneOf", "allOf"):
        for branch in node.get(union, ()):
            branch = _merged(branch) if isinstance(branch, dict) else {}
            if branch.get("type") == "null":
                continue
            properties = {**out.get("properties", {}), **branch.get("properties", {})}
            out = {**branch, **out, **({"properties": properties} if properties else {})}
    return out


def _mapped(node: Any) -> Any:
    if not isinstance(node, dict):
        return node
    node = _merged(node)
    if node.get(PREFIX + "suppress"):
        return None
    if node.get("type") == "array" and isinstance(node.get("items"), dict):
        kept = {k: v for k, v in node.items() if k.startswith(PREFIX)}
        return _mapped({**node["items"], **kept})
    own = {k[len(PREFIX) :].replace("-", "_"): v for k, v in node.items() if k.startswith(PREFIX) and k != PREFIX + "suppress"}
    if "properties" in node:
        properties = {k: m for k, v in node["properties"].items() if (m := _mapped(v))}
        return {**({"properties": properties} if properties else {}), **own}
    kind = TYPES.get((node.get("type"), node.get("format"))) or TYPES.get((node.get("type"), None))
    return {**({"type": kind} if kind else {}), **own}


def index_definition(schema: dict, *, shards: int = 1, replicas: int = 0, extra: dict | None = None) -> dict:
    """Settings and mappings for the rows that ``schema`` describes."""
    definitions = {**schema.get("definitions", {}), **schema.get("$defs", {})}
    mapping = _mapped(_resolved(schema, definitions)) or {}
    mapping = {k: v for k, v in mapping.items() if k not in DROPPED}
    if extra:
        mapping.setdefault("properties", {}).update(extra)
    return {"settings": {"number_of_shards": shards, "number_of_replicas": replicas}, "mappings": mapping}
