"""Mapping compiler: values -> read schema, values -> Column expressions.

Every element is read as ``struct<#text array<string>, @attr string..., child array<struct...>...>``. Each child is
an array even when it occurs once: a plain field would keep only one of several repeats, and a string field would
return the inner markup. ``#`` and ``@`` cannot start an XML name, so the prefixes never collide with data.
"""

from __future__ import annotations

from collections.abc import Mapping as MappingABC
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions.text import join_chunks, strip
from feedloom.plans.mapping import MappingError, ValueSpec, ValueType, XmlSpec

TEXT = "#text"
ATTRIBUTE_PREFIX = "@"


@dataclass
class _Element:
    attributes: set[str] = field(default_factory=set)
    text: bool = False
    children: dict[str, _Element] = field(default_factory=dict)

    def at(self, path: tuple[str, ...]) -> _Element:
        element = self
        for name in path:
            element = element.children.setdefault(name, _Element())
        return element

    def add(self, value: ValueSpec) -> None:
        if value.type is ValueType.ATTRIBUTE:
            self.at(value.path[:-1]).attributes.add(value.path[-1])
        elif value.type is ValueType.CONTENT:
            self.at(value.path).text = True
        else:
            takes_all = value.type is ValueType.JSON_ARRAY and not value.path
            for path in [(name,) for name in value.children] if takes_all else [value.path]:
                target = self.at(path)
                for inner in value.structure.values():
                    target.add(inner)

    def struct(self, case_sensitive: bool, path: str = "") -> T.StructType:
        fields = []
        # An element that is only tested for presence still needs one field.
        if self.text or not (self.attributes or self.children):
            fields.append(T.StructField(TEXT, T.ArrayType(T.StringType())))
        fields += [T.StructField(ATTRIBUTE_PREFIX + name, T.StringType()) for name in sorted(self.attributes)]
        for name, child in sorted(self.children.items()):
            fields.append(T.StructField(name, T.ArrayType(child.struct(case_sensitive, f"{path}/{name}"))))
        folded = [f.name.lower() for f in fields]
        if not case_sensitive and len(set(folded)) < len(folded):
            raise MappingError(
                f"names that differ only in case at '{path or '/'}': set spark.sql.caseSensitive=true to read them"
            )
        return T.StructType(fields)


def record_schema(spec: XmlSpec, case_sensitive: bool = True) -> T.StructType:
    """Read schema of one record element, holding nothing but what the values need."""
    root = _Element()
    for value in spec.values.values():
        root.add(value)
    return root.struct(case_sensitive)


def document_schema(spec: XmlSpec, case_sensitive: bool = True) -> T.StructType:
    """Read schema of a whole document whose root element is the first segment of the root path."""
    schema = record_schema(spec, case_sensitive)
    for name in reversed(spec.root_path[1:]):
        schema = T.StructType([T.StructField(name, T.ArrayType(schema))])
    return schema


def document_records(document: Column, spec: XmlSpec) -> Column:
    """All record nodes of a document node at exactly the root path, in document order."""
    if len(spec.root_path) == 1:
        return F.array(document)
    nodes = document.getField(spec.root_path[1])
    for name in spec.root_path[2:]:
        # A parent without such children gives NULL, and one NULL would empty the flattened array.
        nodes = F.flatten(F.filter(F.transform(nodes, lambda n: n.getField(name)), lambda a: a.isNotNull()))  # noqa: B023
    return nodes


def _pick(nodes: Column, on_repeat: str) -> Column:
    return F.get(nodes, F.lit(0)) if on_repeat == "first" else F.try_element_at(nodes, F.lit(-1))


def _node_at(node: Column, path: tuple[str, ...], on_repeat: str) -> Column:
    for name in path:
        node = _pick(node.getField(name), on_repeat)
    return node


def _attribute(node: Column, path: tuple[str, ...], on_repeat: str) -> Column:
    return strip(_node_at(node, path[:-1], on_repeat).getField(ATTRIBUTE_PREFIX + path[-1]))


def _content(node: Column, path: tuple[str, ...], on_repeat: str) -> Column:
    return join_chunks(_node_at(node, path, on_repeat).getField(TEXT))


def _structure(node: Column, structure: MappingABC[str, ValueSpec], on_repeat: str) -> Column:
    fields = []
    for key, value in structure.items():
        if value.type is ValueType.ATTRIBUTE:
            column = _attribute(node, value.path, on_repeat)
        elif value.type is ValueType.CONTENT:
            column = _content(node, value.path, on_repeat)
        else:
            column = _json_value(node, value, on_repeat)
        fields.append(column.alias(key))
    return F.struct(*fields)


def _json_value(node: Column, value: ValueSpec, on_repeat: str) -> Column:
    """The nested value as struct or array; NULL when the node is missing. Turned into text once, at the outside."""
    if value.type is ValueType.JSON_OBJECT:
        target = _node_at(node, value.path, on_repeat)
        built = _structure(target, value.structure, on_repeat)
        return F.when(target.isNotNull(), built) if value.path else built
    if value.path:
        parent = _node_at(node, value.path[:-1], on_repeat)
        nodes = parent.getField(value.path[-1])
        built = F.transform(nodes, lambda item: _structure(item, value.structure, on_repeat))
        return F.when(F.size(nodes) > 0, built)
    parts = [
        F.transform(node.getField(name), lambda item: _structure(item, value.structure, on_repeat))
        for name in value.children
    ]
    joined = F.flatten(F.filter(F.array(*parts), lambda part: part.isNotNull()))
    return F.when(F.size(joined) > 0, joined)


def extract(node: Column, value: ValueSpec, on_repeat: str = "first") -> Column:
    """The text of one value, NULL when it is missing or blank."""
    if value.type is ValueType.ATTRIBUTE:
        return F.nullif(_attribute(node, value.path, on_repeat), F.lit(""))
    if value.type is ValueType.CONTENT:
        return _content(node, value.path, on_repeat)
    return F.to_json(_json_value(node, value, on_repeat), {"ignoreNullFields": "true"})
