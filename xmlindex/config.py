"""Index configuration: what to select from documents and how to name and type it.

A configuration belongs to a collection path and covers the whole tree below it unless a
deeper collection has its own. It can be written as a nested dict or as an XML collection
configuration. Path expressions are compiled here, on the driver, to plain step tuples.
"""

from __future__ import annotations

import re
import xml.etree.ElementTree as ElementTree
from dataclasses import dataclass, field

# Literal types a field may have.
LITERAL_TYPES = ("string", "integer", "float", "boolean", "date", "dateTime")

# Comparison operators of an attribute predicate.
PREDICATE_OPERATORS = ("eq", "ne", "=")

DEFAULT_BATCH_SIZE = 1000

XML_NAMESPACE = "http://www.w3.org/XML/1998/namespace"

_NAME = r"(?:[\w.-]+:)?[\w.-]+"
_PREDICATE = rf"\[@({_NAME})\s*(eq|ne|=)\s*'([^'\"]*)'\]"
_STEP = re.compile(rf"(//|/)?(?:@({_NAME})|(\*|{_NAME})((?:{_PREDICATE})*))")
_PREDICATE_RE = re.compile(_PREDICATE)


@dataclass(frozen=True)
class Predicate:
    """`[@attribute operator 'value']`; the attribute is a Clark name."""

    attribute: str
    operator: str
    value: str


@dataclass(frozen=True)
class Step:
    """One step of a path: an element test, or as the last step an attribute."""

    name: str
    descendant: bool = False
    attribute: bool = False
    predicates: tuple[Predicate, ...] = ()


def clark_name(qname: str, namespaces: dict[str, str]) -> str:
    """`prefix:local` to `{uri}local`; a prefix without mapping stands for no namespace."""
    prefix, colon, local = qname.partition(":")
    if not colon:
        return qname
    uri = namespaces.get(prefix, "")
    return f"{{{uri}}}{local}" if uri else local


def compile_path(path: str, namespaces: dict[str, str] | None = None) -> tuple[Step, ...]:
    """Compile a path expression; `ValueError` if it is not one."""
    namespaces = namespaces or {}
    steps: list[Step] = []
    position = 0
    while position < len(path):
        match = _STEP.match(path, position)
        if match is None or match.end() == position or (steps and match.group(1) is None):
            raise ValueError(f"not a path expression: {path!r}, at {position}")
        if steps and steps[-1].attribute:
            raise ValueError(f"an attribute must be the last step: {path!r}")
        separator, attribute, element, predicates = match.group(1, 2, 3, 4)
        descendant = separator == "//"
        if attribute:
            steps.append(Step(clark_name(attribute, namespaces), descendant, True))
        else:
            name = "*" if element == "*" else clark_name(element, namespaces)
            found = tuple(
                Predicate(clark_name(left, namespaces), operator, right)
                for left, operator, right in _PREDICATE_RE.findall(predicates or "")
            )
            steps.append(Step(name, descendant, False, found))
        position = match.end()
    if not steps:
        raise ValueError("empty path expression")
    return tuple(steps)


def alignments(steps: tuple[Step, ...], path: tuple[str, ...]) -> list[tuple[int, ...]]:
    """Every way the element steps cover the whole element path, as positions in `path`.

    An attribute step is not part of `path`; the caller checks it against the attributes of
    the last element. With a descendant attribute step (`//@a`) any deeper element will do.
    """
    elements = tuple(step for step in steps if not step.attribute)
    open_end = bool(steps) and steps[-1].attribute and steps[-1].descendant

    def cover(index: int, start: int) -> list[tuple[int, ...]]:
        if index == len(elements):
            return [()] if open_end or start == len(path) else []
        step = elements[index]
        last = len(path) - 1 if step.descendant else min(start, len(path) - 1)
        found = []
        for position in range(start, last + 1):
            if step.name == "*" or step.name == path[position]:
                found += [(position, *rest) for rest in cover(index + 1, position + 1)]
        return found

    return cover(0, 0)


def path_predicates(steps: tuple[Step, ...]) -> list[tuple[int, Predicate]]:
    """(element step number, predicate) in order."""
    elements = [step for step in steps if not step.attribute]
    return [(i, p) for i, step in enumerate(elements) for p in step.predicates]


@dataclass(frozen=True)
class FieldConfig:
    """A field of a record. Several paths may feed one field of the same kind."""

    name: str
    paths: tuple[tuple[Step, ...], ...]
    kind: str = "attribute"  # or "object"
    type: str = "string"


@dataclass(frozen=True)
class RootConfig:
    """What becomes one record: the whole document (no steps) or each matching element."""

    steps: tuple[Step, ...]
    fields: tuple[FieldConfig, ...]
    node_id: tuple[Step, ...] | None = None
    node_id_path: str | None = None
    path: str = "/"


@dataclass(frozen=True)
class IndexConfig:
    name: str
    roots: tuple[RootConfig, ...]
    document_id: tuple[Step, ...] | None = None
    visible_by: tuple[Step, ...] | None = None
    batch_size: int | None = None


@dataclass(frozen=True)
class CollectionConfig:
    """The indexes fed by the documents of one collection tree."""

    collection: str
    indexes: tuple[IndexConfig, ...]
    namespaces: dict[str, str] = field(default_factory=dict, hash=False)


def _fields(specs: list[dict], namespaces: dict[str, str]) -> tuple[FieldConfig, ...]:
    merged: dict[str, FieldConfig] = {}
    # Objects come before attributes, as the record writes them when one node feeds both.
    for spec in sorted(specs, key=lambda s: s.get("kind", "attribute") != "object"):
        kind = spec.get("kind", "attribute")
        literal = spec.get("type") or "string"
        if kind not in ("attribute", "object"):
            raise ValueError(f"unknown field kind {kind!r}")
        if literal not in LITERAL_TYPES:
            raise ValueError(f"unknown literal type {literal!r}")
        steps = compile_path(spec["path"], namespaces)
        known = merged.get(spec["name"])
        if known is None:
            merged[spec["name"]] = FieldConfig(spec["name"], (steps,), kind, literal)
        elif known.kind != kind:
            raise ValueError(f"field {spec['name']!r} is both an attribute and an object")
        else:
            merged[spec["name"]] = FieldConfig(known.name, (*known.paths, steps), kind, known.type)
    return tuple(merged.values())


def load_config(source: dict | str, collection: str | None = None) -> CollectionConfig:
    """A configuration from a dict, or from the text of an XML collection configuration.

    dict form::

        {"collection": "/db/x", "namespaces": {"p": "uri"}, "indexes": [
          {"name": "i", "documentId": "/a/@id", "visibleBy": "/a/v", "batchSize": 500, "roots": [
            {"path": "/a/b", "nodeId": "@id", "fields": [
              {"name": "f", "path": "/c", "type": "integer"},
              {"name": "o", "path": "/d", "kind": "object"}]}]}]}
    """
    spec = _from_xml(source) if isinstance(source, str) else source
    namespaces = {"xml": XML_NAMESPACE, **spec.get("namespaces", {})}

    def optional(path: str | None) -> tuple[Step, ...] | None:
        return compile_path(path, namespaces) if path else None

    indexes = []
    for index in spec["indexes"]:
        roots = []
        for root in index["roots"]:
            path = root.get("path") or "/"
            node_id = optional(root.get("nodeId"))
            if node_id and not (len(node_id) == 1 and node_id[0].attribute):
                raise ValueError("nodeId names an attribute of the root element")
            roots.append(
                RootConfig(
                    steps=() if path == "/" else compile_path(path, namespaces),
                    fields=_fields(root.get("fields", []), namespaces),
                    node_id=node_id,
                    node_id_path=root.get("nodeId"),
                    path=path,
                )
            )
            if roots[-1].steps and roots[-1].steps[-1].attribute:
                raise ValueError("a root object is an element, not an attribute")
        batch_size = index.get("batchSize")
        indexes.append(
            IndexConfig(
                name=index["name"],
                roots=tuple(roots),
                document_id=optional(index.get("documentId")),
                visible_by=optional(index.get("visibleBy")),
                batch_size=int(batch_size) if batch_size and int(batch_size) > 0 else None,
            )
        )
    where = collection or spec.get("collection")
    if not where:
        raise ValueError("a configuration needs the path of its collection")
    return CollectionConfig(where, tuple(indexes), namespaces)


def _local(element: ElementTree.Element) -> str:
    return element.tag.rpartition("}")[2]


def _from_xml(text: str) -> dict:
    """Read by local names, so that neither prefixes nor the wrapping elements matter."""
    root = ElementTree.fromstring(text)
    namespaces = {}
    indexes = []
    for element in root.iter():
        if _local(element) == "namespaceMapping":
            parts = {_local(child): (child.text or "").strip() for child in element}
            namespaces[parts["prefix"]] = parts["namespace"]
        elif _local(element) == "index" and element.get("name"):
            roots = []
            for child in element:
                if _local(child) != "rootObject":
                    continue
                fields = [
                    {**entry.attrib, "kind": _local(entry)}
                    for entry in child
                    if _local(entry) in ("attribute", "object")
                ]
                roots.append({**child.attrib, "fields": fields})
            indexes.append({**element.attrib, "roots": roots})
    return {"namespaces": namespaces, "indexes": indexes}
