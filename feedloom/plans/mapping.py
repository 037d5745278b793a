"""The mapping document: which files form a feed, what a record is, which values go to which tables.

A mapping document is a JSON list. Everything here runs on the driver and is checked before any Spark job starts.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Mapping as MappingABC
from dataclasses import dataclass, field
from enum import Enum
from functools import cached_property
from pathlib import Path
from typing import Any

MAX_NAME_LENGTH = 63
DEFAULT_BATCH_SIZE = 500


class MappingError(ValueError):
    """The mapping document is not usable."""


class ValueType(str, Enum):
    ATTRIBUTE = "ATTRIBUTE"
    CONTENT = "CONTENT"
    JSON_OBJECT = "JSON_OBJECT"
    JSON_ARRAY = "JSON_ARRAY"

    @property
    def is_json(self) -> bool:
        return self in (ValueType.JSON_OBJECT, ValueType.JSON_ARRAY)


@dataclass(frozen=True)
class ValueSpec:
    """One extracted value. ``path`` is relative to the record element (or to the node of the enclosing structure).

    ``children`` is only for a ``JSON_ARRAY`` with an empty path, which takes every child of the node: a read schema
    needs the child names, so they are listed here. The array holds them grouped by name, in the listed order.
    """

    path: tuple[str, ...] = ()
    type: ValueType = ValueType.ATTRIBUTE
    required: bool = False
    not_for_save: bool = False
    default_value: str | None = None
    structure: MappingABC[str, ValueSpec] | None = None
    children: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        if self.type is ValueType.ATTRIBUTE and not self.path:
            raise MappingError("an ATTRIBUTE value needs a path that ends with the attribute name")
        if self.type.is_json and self.structure is None:
            raise MappingError(f"a {self.type.value} value needs a 'structure'")
        if self.type is ValueType.JSON_ARRAY and not self.path and not self.children:
            raise MappingError("a JSON_ARRAY with an empty path needs 'children': the element names to take")
        if any(not part for part in self.path):
            raise MappingError(f"empty segment in path {list(self.path)}")

    @staticmethod
    def from_json(raw: MappingABC[str, Any]) -> ValueSpec:
        structure = raw.get("structure")
        return ValueSpec(
            path=tuple(raw.get("path") or ()),
            type=ValueType(raw.get("type", "ATTRIBUTE")),
            required=bool(raw.get("required", False)),
            not_for_save=bool(raw.get("not_for_save", False)),
            default_value=raw.get("default_value"),
            structure=None if structure is None else {k: ValueSpec.from_json(v) for k, v in structure.items()},
            children=tuple(raw.get("children") or ()),
        )


@dataclass(frozen=True)
class XmlSpec:
    """How records are found and what is taken from them. Needs no table side: enough for reading and validating."""

    root_path: tuple[str, ...]
    values: MappingABC[str, ValueSpec]
    files: tuple[str, ...] = (".*",)
    enums: MappingABC[str, frozenset[str]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if not self.root_path:
            raise MappingError("the root path must not be empty")
        if any(not part for part in self.root_path):
            raise MappingError(f"empty segment in root path {list(self.root_path)}")
        if not self.values:
            raise MappingError("'values' must not be empty")
        if any(not key for key in self.values):
            raise MappingError("an output key must not be empty")
        if not self.files or any(not pattern.strip() for pattern in self.files):
            raise MappingError("'files' needs at least one pattern, none of them blank")

    @property
    def saved_keys(self) -> list[str]:
        return [key for key, value in self.values.items() if not value.not_for_save]

    @property
    def validation_only_keys(self) -> list[str]:
        return [key for key, value in self.values.items() if value.not_for_save]

    @staticmethod
    def from_json(raw: MappingABC[str, Any]) -> XmlSpec:
        root_path = raw.get("root_path", raw.get("rootPath"))
        return XmlSpec(
            root_path=tuple(root_path or ()),
            values={k: ValueSpec.from_json(v) for k, v in (raw.get("values") or {}).items()},
            files=tuple(dict.fromkeys(raw.get("files") or ())),
            enums={k: frozenset(v) for k, v in (raw.get("enums") or {}).items()},
        )


@dataclass(frozen=True)
class TableId:
    name: str
    schema: str = "public"

    def __post_init__(self) -> None:
        if not self.name.strip():
            raise MappingError("a table name must not be blank")
        if len(self.name) > MAX_NAME_LENGTH or len(self.schema) > MAX_NAME_LENGTH:
            raise MappingError(f"table and schema names are limited to {MAX_NAME_LENGTH} characters: {self}")

    @staticmethod
    def parse(text: str, default_schema: str = "public") -> TableId:
        parts = text.split(".")
        return TableId(parts[0], default_schema) if len(parts) == 1 else TableId(parts[1], parts[0])

    def __str__(self) -> str:
        return f"{self.schema}.{self.name}" if self.schema else self.name


@dataclass(frozen=True)
class ColumnId:
    table: TableId
    name: str

    def __post_init__(self) -> None:
        if not self.name.strip():
            raise MappingError("a column name must not be blank")

    @staticmethod
    def parse(text: str, default_schema: str = "public") -> ColumnId:
        parts = text.split(".")
        if len(parts) < 2:
            raise MappingError(f"'{text}' is not of the form [schema.]table.column")
        if len(parts) == 2:
            return ColumnId(TableId(parts[0], default_schema), parts[1])
        return ColumnId(TableId(parts[1], parts[0]), parts[2])


@dataclass(frozen=True)
class TableSpec:
    unique_columns: tuple[str, ...] = ()
    batch_size: int = DEFAULT_BATCH_SIZE
    filename_groups_to_columns: MappingABC[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.batch_size <= 0:
            raise MappingError(f"batch_size must be positive, got {self.batch_size}")
        repeated = [c for c, n in Counter(self.filename_groups_to_columns.values()).items() if n > 1]
        if repeated:
            raise MappingError(f"columns named more than once in filename_groups_to_columns: {repeated}")

    @staticmethod
    def from_json(raw: MappingABC[str, Any]) -> TableSpec:
        return TableSpec(
            unique_columns=tuple(dict.fromkeys(raw.get("unique_columns") or ())),
            batch_size=int(raw.get("batch_size", DEFAULT_BATCH_SIZE)),
            filename_groups_to_columns=dict(raw.get("filename_groups_to_columns") or {}),
        )


@dataclass(frozen=True)
class Mapping:
    xml: XmlSpec
    db: MappingABC[TableId, TableSpec]
    default_schema: str = "public"

    def __post_init__(self) -> None:
        if not self.db:
            raise MappingError("the db section must not be empty")
        undefined = {c.table for c in self.columns.values()} - set(self.db)
        if undefined:
            raise MappingError(f"tables used in 'values' but missing from 'db': {sorted(map(str, undefined))}")
        known = {name for pattern in self.xml.files for name in named_groups(pattern)}
        wanted = {group for table in self.db.values() for group in table.filename_groups_to_columns}
        if wanted - known:
            raise MappingError(f"file name groups that no pattern of the mapping defines: {sorted(wanted - known)}")

    @cached_property
    def columns(self) -> dict[str, ColumnId]:
        """Output key -> target column, for the values that are saved."""
        only_table = next(iter(self.db)) if len(self.db) == 1 else None
        resolved = {}
        for key in self.xml.saved_keys:
            if "." in key:
                resolved[key] = ColumnId.parse(key, self.default_schema)
            elif only_table is None:
                raise MappingError(f"'{key}' names no table, but the mapping has several: use [schema.]table.column")
            else:
                resolved[key] = ColumnId(only_table, key)
        return resolved

    @cached_property
    def loaded_tables(self) -> list[TableId]:
        """The tables that receive values. A table with filename columns only is never loaded."""
        return list(dict.fromkeys(column.table for column in self.columns.values()))

    def target_columns(self, table: TableId) -> list[str]:
        names = [c.name for c in self.columns.values() if c.table == table]
        return list(dict.fromkeys([*names, *self.db[table].filename_groups_to_columns.values()]))

    @staticmethod
    def from_json(raw: MappingABC[str, Any], default_schema: str = "public") -> Mapping:
        return Mapping(
            xml=XmlSpec.from_json(raw["xml"]),
            db={TableId.parse(k, default_schema): TableSpec.from_json(v) for k, v in (raw.get("db") or {}).items()},
            default_schema=default_schema,
        )


def _reject_repeated_keys(pairs: list[tuple[str, Any]]) -> dict[str, Any]:
    repeated = [key for key, n in Counter(key for key, _ in pairs).items() if n > 1]
    if repeated:
        raise MappingError(f"keys given more than once: {repeated}")
    return dict(pairs)


def load_mappings(source: str | Path | list, default_schema: str = "public") -> list[Mapping]:
    """Mappings from a JSON file, a JSON text or the parsed list. Unknown properties are ignored."""
    if isinstance(source, list):
        raw = source
    else:
        text = str(source) if str(source).lstrip().startswith("[") else Path(source).read_text(encoding="utf-8")
        raw = json.loads(text, object_pairs_hook=_reject_repeated_keys)
    return [Mapping.from_json(item, default_schema) for item in raw]


def named_groups(pattern: str) -> dict[str, int]:
    """Group name -> group number of a Java regular expression, for ``regexp_extract`` knows numbers only."""
    groups: dict[str, int] = {}
    number, depth, i = 0, 0, 0
    while i < len(pattern):
        char = pattern[i]
        if char == "\\":
            if pattern.startswith("\\Q", i):
                end = pattern.find("\\E", i)
                i = len(pattern) if end < 0 else end
            i += 2
            continue
        if char == "[":
            depth += 1
        elif char == "]" and depth:
            depth -= 1
        elif char == "(" and not depth:
            is_named = pattern.startswith("(?<", i) and pattern[i + 3 : i + 4] not in ("=", "!")
            if is_named or not pattern.startswith("(?", i):
                number += 1
            if is_named:
                groups[pattern[i + 3 : pattern.index(">", i)]] = number
        i += 1
    return groups
